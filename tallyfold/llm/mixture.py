"""Language identification of mixed texts: expectation-maximisation over word likelihoods."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm import kernel
from tallyfold.session import cut_lineage

#: Three bytes of context are folded to 2**13 contexts, the next byte to 2**6 classes.
CONTEXT_BITS = 13
NEXT_BITS = 6
CELLS = 1 << (CONTEXT_BITS + NEXT_BITS)
#: Largest model that is broadcast: languages * CELLS * 4 bytes.
MODEL_BYTES = 1 << 30
SMOOTHING = 0.05
STEPS = 12
#: Cost of one more language, in units of half the logarithm of the number of words.
PENALTY = 4.0
UNDETERMINED = "und"
#: Languages whose counts a task holds at once.
HELD = 32


def word_cells(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each letter byte its model cell; where each word begins among them; the row of each word.

    A word is a run of ASCII letters and bytes of non-ASCII characters; its first bytes see
    a blank and nothing before that.
    """
    data, bounds = kernel.utf8(batch.column("text"))
    data = kernel.LOWER[data]
    starts, ends, rows = kernel.spans(data, bounds, kernel.LETTER)
    if len(starts) == 0:
        none = np.empty(0, dtype=np.int64)
        return none, none, none
    lengths = ends - starts
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    within = np.arange(int(lengths.sum())) - np.repeat(begins, lengths)
    at = within + np.repeat(starts, lengths)
    letters = data[at].astype(np.uint64)
    context = np.zeros(len(at), dtype=np.uint64)
    for j in (3, 2, 1):
        previous = np.zeros(len(at), dtype=np.uint64)
        previous[j:] = letters[:-j]
        previous = np.where(within >= j, previous, np.where(within == j - 1, np.uint64(32), np.uint64(0)))
        context = context * np.uint64(256) + previous
    folded = (context * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - CONTEXT_BITS)
    return ((folded << np.uint64(NEXT_BITS)) | (letters & np.uint64((1 << NEXT_BITS) - 1))).astype(np.int64), begins, rows


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for name, table in held.items():
            cells = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(cells), type=pa.string()), pa.array(cells), pa.array(table[cells])], names=["lang", "cell", "n"]
            )

    for batch in kernel.slices(batches, "text", kernel.SLICE // 2):
        cells, begins, rows = word_cells(batch)
        if len(cells) == 0:
            continue
        codes = batch.column("lang").dictionary_encode()
        of_word = codes.indices.to_numpy(zero_copy_only=False)[rows]
        of_cell = np.repeat(of_word, np.diff(np.append(begins, len(cells))))
        for k, name in enumerate(codes.dictionary.to_pylist()):
            mine = cells[of_cell == k]
            if len(mine) == 0:
                continue
            if name not in held and len(held) >= HELD:
                yield from out()
                held.clear()
            held.setdefault(name, np.zeros(CELLS, dtype=np.int64))
            held[name] += np.bincount(mine, minlength=CELLS)
    yield from out()


class LanguageModel:
    """Log probability of the next byte class after a context, for each learned language."""

    def __init__(self, languages: list[str], tables: np.ndarray):
        self.languages = languages
        self.tables = tables

    def word_likelihoods(self, cells: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """languages x words, as log likelihoods."""
        return np.stack([np.add.reduceat(table[cells], begins) for table in self.tables])


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Counts the byte 4-grams of all rows with a language and text, by language."""
    rows = docs.select(F.lower(F.col(text)).alias("text"), F.col(lang).cast("string").alias("lang")).dropna()
    counted = cut_lineage(
        rows.mapInArrow(_counts, "lang string, cell bigint, n bigint").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    )
    languages = [r[0] for r in counted.select("lang").distinct().orderBy("lang").collect()]
    if len(languages) * CELLS * 4 > MODEL_BYTES:
        raise ValueError(f"{len(languages)} languages are more than a shared model holds; raise MODEL_BYTES")
    tables = np.zeros((len(languages), CELLS), dtype=np.float32)
    if languages:
        per_context = counted.groupBy("lang", F.shiftright("cell", NEXT_BITS).alias("context")).agg(F.sum("n").alias("total"))
        joined = counted.withColumn("context", F.shiftright("cell", NEXT_BITS)).join(per_context, ["lang", "context"])
        width = 1 << NEXT_BITS
        at = joined.select("lang", "cell", "n", "total").toArrow()
        row = np.searchsorted(np.array(languages, dtype=object), np.array(at.column("lang").to_pylist(), dtype=object))
        cell, n, total = (at.column(c).to_numpy().astype(np.int64) for c in ("cell", "n", "total"))
        totals = np.zeros((len(languages), CELLS >> NEXT_BITS))
        totals[row, cell >> NEXT_BITS] = total
        tables[:] = np.repeat(np.log(SMOOTHING / (totals + SMOOTHING * width)), width, axis=1)
        tables[row, cell] = np.log((n + SMOOTHING) / (total + SMOOTHING * width))
    return LanguageModel(languages, tables)


def _climb(likelihood: np.ndarray, allowed: np.ndarray, begins: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (languages x documents) and log likelihood of each document after STEPS rounds.

    likelihood: languages x words, scaled so that the best of a word is 1; the words of a
    document lie together from begins, counts of them.
    """
    share = allowed / allowed.sum(axis=0)
    for _ in range(STEPS):
        weight = np.repeat(share, counts, axis=1)
        weight *= likelihood
        weight /= np.maximum(weight.sum(axis=0), 1e-30)
        share = np.add.reduceat(weight, begins, axis=1) / counts
    total = np.log(np.maximum((np.repeat(share, counts, axis=1) * likelihood).sum(axis=0), 1e-30))
    return share, np.add.reduceat(total, begins)


def proportions(log_likelihood: np.ndarray, begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """languages x documents: the mixture of each document over its selected set of languages.

    All languages are fitted first. Sets then grow in the order of those proportions, and a
    document takes the next language while PENALTY * log(words) / 2 is gained by it.
    """
    n_languages = len(log_likelihood)
    scaled = np.exp(np.maximum(log_likelihood - log_likelihood.max(axis=0), -60.0))
    full, _ = _climb(scaled, np.ones((n_languages, len(begins)), dtype=scaled.dtype), begins, counts)
    rank = np.argsort(np.argsort(-full, axis=0, kind="stable"), axis=0, kind="stable")
    # One language: nothing to fit.
    alone = np.add.reduceat(np.log(scaled), begins, axis=1)
    best = np.zeros_like(full)
    best[alone.argmax(axis=0), np.arange(len(begins))] = 1.0
    kept = alone.max(axis=0)
    active = np.arange(len(begins))
    for size in range(2, n_languages + 1):
        words = np.repeat(begins[active] - np.concatenate([[0], np.cumsum(counts[active])[:-1]]), counts[active]) + np.arange(counts[active].sum())
        own_begins = np.concatenate([[0], np.cumsum(counts[active])[:-1]])
        share, value = _climb(scaled[:, words], (rank[:, active] < size).astype(scaled.dtype), own_begins, counts[active])
        value = value - PENALTY * (size - 1) * np.log(counts[active] + 1.0) / 2
        better = value > kept[active]
        active = active[better]
        if len(active) == 0:
            break
        best[:, active], kept[active] = share[:, better], value[better]
    return best


def _predict(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    model = LanguageModel(*shared.value)
    names = np.array([*model.languages, UNDETERMINED], dtype=object)
    limit = max(kernel.SLICE // 16, kernel.SLICE * 8 // max(8, len(model.languages)))
    for batch in kernel.slices(batches, "text", limit):
        n = batch.num_rows
        mix = np.zeros((n, len(model.languages)))
        cells, begins, rows = word_cells(batch)
        if len(cells) and model.languages:
            found, first, counts = np.unique(rows, return_index=True, return_counts=True)
            mix[found] = proportions(model.word_likelihoods(cells, begins), first, counts).T
        lettered = batch.column("lettered").to_numpy(zero_copy_only=False) & (mix.sum(axis=1) > 0)
        top = np.where(lettered, mix.argmax(axis=1) if model.languages else 0, len(model.languages))
        score = np.where(lettered, mix.max(axis=1, initial=0.0), 0.0)
        parts = [[(names[k], float(m[k])) for k in np.flatnonzero(m > 0)] if ok else [] for m, ok in zip(mix, lettered, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row_key"),
                pa.array(names[top], type=pa.string()),
                pa.array(np.clip(score, 0.0, 1.0)),
                pa.array(parts, type=pa.map_(pa.string(), pa.float64())),
            ],
            names=["row_key", "lang_pred", "score", "shares"],
        )


def identify(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score, shares) for each row.

    Every word of the whole text is one draw from one language of the document's mixture;
    its likelihood under a language is that of its bytes after three bytes of context.
    shares are the mixture over the selected languages; lang_pred has the largest (ties:
    the first by name), score is that share.

    Null or empty text, or text without a letter: lang_pred 'und', score 0, no shares; the
    same when nothing was learned. Repeated rows are predicted each, null keys are kept.
    """
    source = docs.select(
        F.col(key).alias("row_key"), F.lower(F.col(text)).alias("text"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("lettered")
    )
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.tables))
    schema = f"row_key {dict(source.dtypes)['row_key']}, lang_pred string, score double, shares map<string,double>"
    return source.mapInArrow(lambda it: _predict(it, shared), schema).withColumnRenamed("row_key", key)
