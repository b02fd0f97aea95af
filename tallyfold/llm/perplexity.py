"""Quality by n-gram perplexity: a modified Kneser-Ney model counted by Spark, with bands by language."""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm import kernel
from tallyfold.session import cut_lineage

ORDER = 5
#: `gram` has the low 11 bits of each symbol and 8 of the language, `high` the other 10 bits of each symbol (zero for
#: most scripts): with the whole `language` they are the full key, and no two n-grams share one.
SYMBOL_BITS, HIGH_BITS = 11, 10
LANGUAGE_BITS = 8
KEY = ["gram", "high", "language"]
#: A model of at most so many n-grams goes to all workers (16 bytes each); a larger one is joined to the texts' blocks.
LOCAL = 4_000_000
#: Bytes of text in a block of the join.
BLOCK = 4 << 20
#: Distinct n-grams a counting task holds before it hands them on.
HELD = 2_000_000
#: A document is rejected this many robust deviations from its language's median.
BAND = 6.0
#: Least robust deviation of the log perplexity; it only keeps a language of near equal scores from a band of no width.
SPREAD = 0.01
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_LANGUAGE_SHIFT = ORDER * SYMBOL_BITS


def _symbol_table() -> np.ndarray:
    """Code points to symbols: 0 pad, 1 white space, others as they are."""
    table = np.maximum(np.arange(0x110000, dtype=np.int64), 2)
    table[list(kernel.SPACES)] = 1
    return table


_TABLE: list[np.ndarray] = []


def gram_keys(data: np.ndarray, bounds: np.ndarray, language: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ORDER-gram that ends at each character of the rows as gram and high, and the row of each.

    White space runs are one boundary symbol, one stands before each row, and contexts
    before that are padded. Rows without a word have no n-grams.
    """
    if not _TABLE:
        _TABLE.append(_symbol_table())
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    symbols = _TABLE[0][points]
    n_rows = len(bounds) - 1
    ends = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[bounds]
    rows = np.repeat(np.arange(n_rows), np.diff(ends))
    # The characters without repeated, leading or trailing white space.
    white = symbols == 1
    fresh = np.ones(len(rows), dtype=bool)
    fresh[1:] = rows[1:] != rows[:-1]
    behind = fresh.copy()
    behind[1:] |= white[:-1]
    keep = ~(white & behind)
    symbols, rows = symbols[keep], rows[keep]
    last = np.ones(len(rows), dtype=bool)
    last[:-1] = rows[1:] != rows[:-1]
    inner = ~(last & (symbols == 1))
    symbols, rows = symbols[inner], rows[inner]
    # Before each row stand ORDER - 2 pads and its boundary, so no window looks into the row before.
    gap = ORDER - 1
    at = np.arange(len(rows)) + gap * (rows + 1)
    boundary = np.searchsorted(rows, np.arange(n_rows)) + gap * np.arange(1, n_rows + 1) - 1

    def joined(symbols: np.ndarray, bits: int, first: int) -> np.ndarray:
        line = np.zeros(len(rows) + gap * n_rows, dtype=np.int64)
        line[at], line[boundary] = symbols, first
        keys = line.copy()
        for j in range(1, ORDER):
            keys[j:] += line[:-j] << (bits * j)
        return keys[at]

    high = symbols >> SYMBOL_BITS
    gram = joined(symbols & ((1 << SYMBOL_BITS) - 1), SYMBOL_BITS, 1) + ((language & ((1 << LANGUAGE_BITS) - 1)) << _LANGUAGE_SHIFT)[rows]
    return gram, joined(high, HIGH_BITS, 0) if high.any() else np.zeros(len(rows), dtype=np.int64), rows


def fingerprints(gram: np.ndarray, high: np.ndarray, language: np.ndarray) -> np.ndarray:
    """64 bits of each full key; a task or a block tells its n-grams apart by them."""
    rest = language.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    if high.any():
        rest = rest + kernel.mix(high.view(np.uint64) + np.uint64(1))
    return kernel.mix(gram.view(np.uint64) + kernel.mix(rest))


def _merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Parts are fingerprints, counts and columns of the key; equal fingerprints are summed."""
    prints, counts, *columns = (np.concatenate(p) for p in zip(*parts, strict=True))
    order = np.argsort(prints)
    prints, counts = prints[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], prints[1:] != prints[:-1]]))
    return prints[first], np.add.reduceat(counts, first), *(c[order[first]] for c in columns)


def _tallied(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct prints in order, where one of each stands, and how many there are.

    Sorting values is much cheaper than sorting places: a place for each comes from a table by
    the leading bits, and only prints that lost their cell to another are sorted by place.
    """
    ordered = np.sort(prints)
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    distinct, counts = ordered[starts], np.diff(np.append(starts, len(ordered)))
    shift = np.uint64(63 - math.ceil(math.log2(len(prints) + 1)))
    cells = (prints >> shift).astype(np.int64)
    table = np.empty(1 << (64 - int(shift)), dtype=np.int32)
    table[cells] = np.arange(len(prints), dtype=np.int32)
    places = table[(distinct >> shift).astype(np.int64)].astype(np.int64)
    lost = np.flatnonzero(prints[places] != distinct)
    if len(lost):
        rest = np.flatnonzero(prints[table[cells]] != prints)
        rest = rest[np.argsort(prints[rest])]
        places[lost] = rest[np.searchsorted(prints[rest], distinct[lost])]
    return distinct, places, counts.astype(np.int64)


def _longs(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def _distinct(batch: pa.RecordBatch) -> tuple[np.ndarray, ...] | None:
    """fingerprint, count, gram, high, language and fold of the n-grams of a batch; one without folds is all of fold 0."""
    data, bounds = kernel.utf8(batch.column("text"))
    if len(data) == 0:
        return None
    languages = _longs(batch, "language")
    folds = _longs(batch, "fold") if "fold" in batch.schema.names else np.zeros(batch.num_rows, dtype=np.int64)
    gram, high, rows = gram_keys(data, bounds, languages)
    if len(gram) == 0:
        return None
    prints = fingerprints(gram, high, languages[rows]) + folds.astype(np.uint64)[rows]
    prints, first, n = _tallied(prints)
    rows = rows[first]
    return prints, n, gram[first], high[first], languages[rows], folds[rows]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the n-grams by full key and fold; rows without a fold are counted by `gram` only."""
    held: list[tuple[np.ndarray, ...]] = []
    folded = True

    def out() -> Iterator[pa.RecordBatch]:
        _, n, *columns = _merged(held)
        arrays = dict(zip([*KEY, "fold"], columns, strict=True)) if folded else {"gram": columns[0]}
        arrays["n"] = n
        for at in range(0, len(n), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(a[at : at + (1 << 16)]) for a in arrays.values()], names=list(arrays))

    for batch in kernel.slices(batches, "text"):
        folded = "fold" in batch.schema.names
        found = _distinct(batch)
        if found is None:
            continue
        held.append(found)
        if sum(len(k[0]) for k in held) > HELD:
            held = [_merged(held)]
            if len(held[0][0]) > HELD // 2:
                yield from out()
                held = []
    if held:
        yield from out()


def _tail(order: int, skip: int = 0) -> list[Column]:
    """The key of the last `order` symbols, in SQL, without the last `skip` of them."""

    def cut(name: str, bits: int) -> Column:
        return F.shiftright(F.col(name).bitwiseAND(F.lit((1 << (bits * order)) - 1)), bits * skip)

    return [cut("gram", SYMBOL_BITS).alias("gram"), cut("high", HIGH_BITS).alias("high"), F.col("language")]


def _discounts(grams: DataFrame, models: list[str]) -> DataFrame:
    """Modified Kneser-Ney discounts of one order by language and model, from the counts of counts; n_grams counts the language's n-grams."""
    of = [F.sum((F.col(f"c{m}") == k).cast("double")).alias(f"t{k}{m}") for m in models for k in (1, 2, 3, 4)]
    t = grams.groupBy("language").agg(F.count(F.lit(1)).alias("n_grams"), *of)
    out = [F.col("language").alias("discount_language"), F.col("n_grams")]
    for m in models:
        ready = (F.col(f"t1{m}") > 0) & (F.col(f"t2{m}") > 0) & (F.col(f"t3{m}") > 0)
        y = F.col(f"t1{m}") / F.expr(f"nullif(t1{m} + 2 * t2{m}, 0)")
        for k in (1, 2, 3):
            d = F.lit(float(k)) - (k + 1) * y * F.col(f"t{k + 1}{m}") / F.expr(f"nullif(t{k}{m}, 0)")
            out.append(F.when(ready & (d > 0.05) & (d < k), d).otherwise(F.lit(0.5 * k)).alias(f"d{k}{m}"))
    return t.select(*out)


def kneser_ney(counts: DataFrame) -> DataFrame:
    """(gram, high, language, and c<m>, logp<m> for each model m): interpolated modified Kneser-Ney log probabilities.

    counts has the key of n-grams of the highest order, and a column n<m> for each model; an
    n-gram that a model has not counted (n<m> is 0) gets what its back-off gives. Without
    `language`, the bits in gram are the language; without `high` it is 0. Lower orders count
    the distinct left extensions. A context has at most as many successors as its language has
    symbols, so its window is bounded.
    """
    models = [name[1:] for name in counts.columns if name.startswith("n")]
    absent = {"high": F.lit(0).cast("bigint"), "language": F.shiftright("gram", _LANGUAGE_SHIFT)}
    counts = counts.withColumns({k: v for k, v in absent.items() if k not in counts.columns})
    grams = {ORDER: counts.select(*KEY, *(F.col(f"n{m}").alias(f"c{m}") for m in models))}
    for order in range(ORDER - 1, 0, -1):
        seen = [F.sum((F.col(f"c{m}") > 0).cast("bigint")).alias(f"c{m}") for m in models]
        grams[order] = cut_lineage(grams[order + 1].groupBy(*_tail(order)).agg(*seen))
    lower = None
    for order in range(1, ORDER + 1):
        # A row for each language; without the hint the window below could be dealt by language alone.
        g = grams[order].join(F.broadcast(_discounts(grams[order], models)), F.col("language") == F.col("discount_language"))
        over = Window.partitionBy(*_tail(order, 1))
        if lower is None:
            below = {m: 1.0 / F.greatest(F.col("n_grams"), F.lit(1 << SYMBOL_BITS)) for m in models}
        else:
            below = {m: F.col(f"below{m}") for m in models}
        added = {}
        for m in models:
            c = F.col(f"c{m}")
            discount = F.when(c == 0, 0.0).when(c == 1, F.col(f"d1{m}")).when(c == 2, F.col(f"d2{m}")).otherwise(F.col(f"d3{m}"))
            added |= {f"total{m}": F.sum(c).over(over), f"freed{m}": F.sum(discount).over(over), f"own{m}": c - discount}
        g = g.withColumns(added)
        if lower is not None:
            keys = zip(_tail(order - 1), KEY, strict=True)
            g = g.join(lower, functools.reduce(operator.and_, (a == F.col(f"shorter_{k}") for a, k in keys)))
        p = []
        for m in models:
            total = F.col(f"total{m}")
            p.append(F.when(total > 0, F.col(f"own{m}") / total + F.col(f"freed{m}") / total * below[m]).otherwise(below[m]).alias(f"p{m}"))
        g = g.select(*KEY, *(f"c{m}" for m in models), *p)
        lower = g.select(*(F.col(k).alias(f"shorter_{k}") for k in KEY), *(F.col(f"p{m}").alias(f"below{m}") for m in models))
    return g.select(*KEY, *(f"c{m}" for m in models), *(F.log(f"p{m}").alias(f"logp{m}") for m in models))


class Lookup:
    """Log probabilities of both models by fingerprint: sorted, with an index by the leading bits."""

    def __init__(self, gram: np.ndarray, high: np.ndarray, language: np.ndarray, logp: np.ndarray):
        prints = fingerprints(gram, high, language)
        order = np.argsort(prints, kind="stable")
        self.prints, self.logp = prints[order], np.ascontiguousarray(logp[order]).ravel()
        bits = max(1, math.ceil(math.log2(len(prints) + 2)))
        self.shift = np.uint64(64 - bits)
        self.starts = np.searchsorted(self.prints, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)

    @classmethod
    def of(cls, table: pa.Table) -> Lookup:
        key = [table.column(k).to_numpy() for k in KEY]
        return cls(*key, np.stack([table.column(f"logp{m}").to_numpy() for m in (0, 1)], axis=1).astype(np.float32))

    def __call__(self, prints: np.ndarray, model: np.ndarray) -> np.ndarray:
        """All texts were counted, so every fingerprint is there."""
        at = self.starts[(prints >> self.shift).astype(np.int64)].astype(np.int64)
        behind = np.flatnonzero(self.prints[at] != prints)
        while len(behind):
            at[behind] += 1
            behind = behind[self.prints[at[behind]] != prints[behind]]
        return self.logp[2 * at + model]


def _base(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """The plain counts of each row."""
    n = len(bounds) - 1
    zero = np.zeros(n, dtype=np.int64)
    if len(data) == 0:
        return {k: zero for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
    starts, ends, rows = kernel.spans(data, bounds, kernel.WORD)

    def per_row(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[bounds[1:]] - sums[bounds[:-1]]

    out = {"n_words": np.bincount(rows, minlength=n)}
    out["word_chars"] = per_row(kernel.WORD[data] & ((data & 0xC0) != 0x80))
    out["n_symbols"] = per_row(_SYMBOLS[data])

    hashes = kernel.span_hashes(data, starts, ends)
    grams, first = kernel.windows(hashes, rows, 3)
    repeated = first[_repeats(grams, rows[first], every=True)]
    covered = np.zeros(len(rows), dtype=bool)
    for j in range(3):
        covered[repeated + j] = True
    out["n_repeat_words"] = np.bincount(rows[covered], minlength=n)

    line_starts, line_ends, line_rows = kernel.spans(data, bounds, _NOT_NEWLINE)
    words_before = np.concatenate([[0], np.cumsum(kernel.WORD[data], dtype=np.int64)])
    worded = words_before[line_ends] > words_before[line_starts]
    line_starts, line_ends, line_rows = line_starts[worded], line_ends[worded], line_rows[worded]
    again = _repeats(kernel.span_hashes(data, line_starts, line_ends), line_rows, every=False)
    out["n_dup_lines"] = np.bincount(line_rows[again], minlength=n)
    return out


_SYMBOLS = kernel.byte_class(*(ord(c) for c in "#*$%&|<>"))
_NOT_NEWLINE = kernel.byte_class(0x0A, inverse=True)


def _repeats(hashes: np.ndarray, rows: np.ndarray, every: bool) -> np.ndarray:
    """Which entries have an equal one in the same row; without `every`, all but one of the equal ones."""
    marked = np.zeros(len(hashes), dtype=bool)
    if len(hashes) < 2:
        return marked
    own = kernel.mix(hashes ^ (rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(own)
    same = own[order][1:] == own[order][:-1]
    marked[order[1:][same]] = True
    if every:
        marked[order[:-1][same]] = True
    return marked


_LOOKUP: dict[int, Lookup] = {}


class _Shared:
    """A broadcast with a name that is the same in all workers."""

    def __init__(self, broadcast, id_: int):
        self.broadcast, self.id = broadcast, id_

    @property
    def value(self):
        return self.broadcast.value


def _lookup(shared) -> Lookup:
    if shared.id not in _LOOKUP:
        _LOOKUP.clear()
        _LOOKUP[shared.id] = Lookup(*shared.value)
    return _LOOKUP[shared.id]


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _scored(batch: pa.RecordBatch, lookup: Lookup | None) -> pa.RecordBatch:
    data, bounds = kernel.utf8(batch.column("text"))
    base = _base(data, bounds)
    n = batch.num_rows
    total, size = np.zeros(n), np.zeros(n, dtype=np.int64)
    if len(data):
        languages, other = _longs(batch, "language"), 1 - _longs(batch, "fold")
        gram, high, rows = gram_keys(data, bounds, languages)
        if len(gram):
            logp = lookup(fingerprints(gram, high, languages[rows]), other[rows])
            total, size = np.bincount(rows, weights=logp, minlength=n), np.bincount(rows, minlength=n)
    log_perplexity = pa.array(-total / np.maximum(size, 1), mask=size == 0)
    arrays = [batch.column("row_key"), batch.column("lang"), *(pa.array(base[k].astype(np.int64)) for k in _COUNTS)]
    return pa.RecordBatch.from_arrays([*arrays, log_perplexity], names=["row_key", "lang", *_COUNTS, "log_perplexity"])


def _score(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    for batch in kernel.slices(batches, "text"):
        yield _scored(batch, _lookup(shared))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with the number of their block: at most BLOCK bytes of text, or one row."""
    first = TaskContext.get().partitionId() << 32
    for k, batch in enumerate(kernel.slices(batches, "text", BLOCK)):
        yield batch.append_column("block", pa.array(np.full(batch.num_rows, first + k)))


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, gram, high, language): the n-grams of each block."""
    for batch in kernel.slices(batches, "text"):
        blocks = _longs(batch, "block")
        for block in np.unique(blocks):
            found = _distinct(batch.filter(pa.array(blocks == block)))
            if found is not None:
                columns = [np.full(len(found[0]), block), *found[2:5]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["block", *KEY])


def _score_block(rows: pa.Table, model: pa.Table) -> pa.Table:
    lookup = Lookup.of(model) if model.num_rows else None
    out = [_scored(batch, lookup) for batch in kernel.slices(iter(rows.combine_chunks().to_batches()), "text")]
    return pa.Table.from_batches(out)


def _by_blocks(source: DataFrame, model: DataFrame, schema: str) -> DataFrame:
    """The scores with a model of any size: joined by full key to the n-grams of each block of texts."""
    stored = cut_lineage(source.mapInArrow(_blocks, ", ".join(f"{n} {t}" for n, t in [*source.dtypes, ("block", "bigint")])))
    wanted = stored.select("text", "language", "block").mapInArrow(_wanted, "block bigint, gram bigint, high bigint, language bigint").distinct()
    found = wanted.join(model.select(*KEY, "logp0", "logp1"), KEY)
    return stored.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(_score_block, schema)


def quality(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", band: float = BAND) -> DataFrame:
    """(key, lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    log_perplexity, lower, upper, kept) for each row.

    The model is a character 5-gram over whole texts (white space runs are one boundary),
    one for each language, counted over all rows in two folds by the hash of the text: a row
    is scored by the fold that it and its exact copies are not in, unseen n-grams by back-off.
    Perplexity is per character, under the model of the row's language. The bands are the
    median of log perplexity over the language's rows that pass the base rules, minus and plus
    `band` robust deviations (1.4826 times the median absolute deviation, at least SPREAD).

    The model's size follows the input: no n-gram is merged with another. Up to LOCAL n-grams
    are looked up in each worker; more are joined to the texts, block by block, for the same
    scores. A language whose rows all lie in one fold has no model; its rows score alike.

    Null or empty text, or text without a word: no words, base_failed, log_perplexity
    null. A null language is a group of its own. Repeated rows count and are scored each;
    a null key is kept as it is. No rows in, no rows out. Other columns are not read.
    """
    spark = docs.sparkSession
    language = F.col(lang).cast("string")
    source = docs.select(
        F.col(key).alias("row_key"), F.col(text).alias("text"), language.alias("lang"),
        F.when(language.isNull(), F.lit(0)).otherwise(F.xxhash64(language)).alias("language"),
        F.coalesce(F.pmod(F.xxhash64(text), F.lit(2)), F.lit(0)).cast("bigint").alias("fold"),
    )
    partial = source.select("text", "language", "fold").mapInArrow(_count, "gram bigint, high bigint, language bigint, fold bigint, n bigint")
    by_fold = [F.sum(F.when(F.col("fold") == m, F.col("n")).otherwise(F.lit(0))).alias(f"n{m}") for m in (0, 1)]
    counts = cut_lineage(partial.groupBy(*KEY).agg(*by_fold))
    schema = f"row_key {dict(source.dtypes)['row_key']}, lang string, " + ", ".join(f"{c} bigint" for c in _COUNTS) + ", log_perplexity double"
    model = kneser_ney(counts)
    if counts.count() <= LOCAL:
        found = model.select(*KEY, *(F.col(f"logp{m}").cast("float").alias(f"logp{m}") for m in (0, 1))).toArrow()
        key_columns = [found.column(k).to_numpy() for k in KEY]
        arrays = spark.sparkContext.broadcast((*key_columns, np.stack([found.column(f"logp{m}").to_numpy() for m in (0, 1)], axis=1)))
        shared = _Shared(arrays, id(arrays))
        scored = source.mapInArrow(lambda it: _score(it, shared), schema)
    else:
        scored = _by_blocks(source, model, schema)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    scored = cut_lineage(scored.withColumn("base_failed", failed))
    return within_bands(scored, band).withColumnRenamed("row_key", key)


def within_bands(scored: DataFrame, band: float) -> DataFrame:
    """Adds lower, upper and kept; see quality(). Medians come from mergeable sketches (rank error 1e-4)."""
    sound = scored.filter("NOT base_failed AND log_perplexity IS NOT NULL").select(F.col("lang").alias("of"), "log_perplexity")
    middle = sound.groupBy("of").agg(F.percentile_approx("log_perplexity", 0.5, 10000).alias("middle"))
    away = sound.join(middle.withColumnRenamed("of", "of2"), F.col("of").eqNullSafe(F.col("of2")))
    spread = away.groupBy("of").agg(
        F.first("middle").alias("middle"),
        F.percentile_approx(F.abs(F.col("log_perplexity") - F.col("middle")), 0.5, 10000).alias("mad"),
    )
    reach = band * F.greatest(1.4826 * F.col("mad"), F.lit(SPREAD))
    bands = spread.select("of", (F.col("middle") - reach).alias("lower"), (F.col("middle") + reach).alias("upper"))
    ok = ~F.col("base_failed") & F.col("log_perplexity").between(F.col("lower"), F.col("upper"))
    return (
        scored.join(bands, F.col("lang").eqNullSafe(F.col("of")), "left").drop("of").withColumn("kept", F.coalesce(ok, F.lit(False)))
    )
