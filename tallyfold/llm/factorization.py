"""Toxicity by a factorization machine over hashed terms."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm import kernel
from tallyfold.session import cut_lineage

HASH_BITS = 18
FACTORS = 8
#: At most about so many labelled rows are used to fit, chosen by a hash of their key.
SAMPLE = 16_000
EPOCHS = 30
RATE = 0.1
PENALTY = 1e-4
BATCH = 128
#: A term takes part when its presence differs between the classes by so many deviations ...
DEVIATIONS = 3.0
#: ... and it lies in so many labelled rows.
MIN_ROWS = 5
#: Terms without a difference of their own take part when a pair of them differs by so many deviations from what its
#: terms say alone; the pairs are those of the most frequent terms.
PAIR_DEVIATIONS = 6.0
FREQUENT = 1024


def terms(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed terms (runs of letters, lower case) of each row: slots and rows, by row."""
    data, bounds = kernel.utf8(batch.column("text"))
    data = kernel.LOWER[data]
    starts, ends, rows = kernel.spans(data, bounds, kernel.LETTER)
    slots = (kernel.span_hashes(data, starts, ends) >> np.uint64(64 - HASH_BITS)).astype(np.int64)
    both = np.unique((rows << HASH_BITS) | slots)
    return both & ((1 << HASH_BITS) - 1), both >> HASH_BITS


#: A step of this size goes on with the next number.
_ON = (1 << 16) - 1


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts as their distinct hashed terms: 16-bit steps from one slot to the next, a fraction of the text."""
    for batch in kernel.slices(batches, "text"):
        slots, rows = terms(batch)
        steps = np.diff(slots, prepend=0)
        fresh = np.flatnonzero(np.diff(rows, prepend=-1))
        steps[fresh] = slots[fresh]
        ends = np.concatenate([[0], np.cumsum(steps // _ON + 1)])
        out = np.full(ends[-1], _ON, dtype="<u2")
        out[ends[1:] - 1] = steps % _ON
        bounds = ends[np.searchsorted(rows, np.arange(batch.num_rows + 1))] * 2
        packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(out.tobytes())])
        others = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in others), packed.cast(pa.binary())], names=[*others, "slots"])


def _unhashed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Slots and rows of steps, see _hashed."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    steps = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]].view("<u2").astype(np.int64) if raw is not None else np.empty(0, dtype=np.int64)
    begins = (offsets - offsets[0]) // 2
    sums = np.concatenate([[0], np.cumsum(steps)])
    rows = np.repeat(np.arange(len(column)), np.diff(begins))
    whole = steps != _ON
    return (sums[1:] - sums[begins[:-1]][rows])[whole], rows[whole]


class Machine:
    """score = sigmoid(bias + sum w x + sum over pairs <v_i, v_j> x_i x_j) over terms that are present."""

    def __init__(self, bias: float, weights: np.ndarray, factors: np.ndarray):
        self.bias, self.weights, self.factors = bias, weights, factors

    def margins(self, index: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
        out = self.bias + np.bincount(rows, weights=self.weights[index], minlength=n_rows)
        for f in range(self.factors.shape[1]):
            v = self.factors[index, f]
            out += 0.5 * (np.bincount(rows, weights=v, minlength=n_rows) ** 2 - np.bincount(rows, weights=v * v, minlength=n_rows))
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


Tally = tuple[np.ndarray, np.ndarray, np.ndarray, int, int]


def _own_gap(present: np.ndarray, positive: np.ndarray, n: int, n_positive: int) -> np.ndarray:
    """Terms whose presence differs between the classes by itself."""
    rate = n_positive / max(n, 1)
    expected = present * rate
    gap = np.abs(positive - expected) / np.sqrt(np.maximum(expected * (1 - rate), 1e-9))
    return (present >= MIN_ROWS) & (gap >= DEVIATIONS)


def _paired(rows: np.ndarray, index: np.ndarray, labels: np.ndarray, n_terms: int) -> np.ndarray:
    """Terms in a pair whose share of label 1 is not the one that its terms' own shares add up to (in log odds).

    Rows of the FREQUENT most frequent terms are counted by products of 0/1 matrices, so that
    terms which are neutral alone, like a group and an insult that only hits beside it, are kept.
    """
    out = np.zeros(n_terms, dtype=bool)
    rate = labels.mean() if len(labels) else 0.0
    if not 0 < rate < 1:
        return out
    present = np.bincount(index, minlength=n_terms)
    top = np.argsort(-present, kind="stable")[:FREQUENT]
    number = np.full(n_terms, -1)
    number[top] = np.arange(len(top))
    use = number[index] >= 0
    rows, index = rows[use], number[index[use]]
    both, hit = np.zeros((len(top), len(top))), np.zeros((len(top), len(top)))
    for at in range(0, len(labels), 2048):
        span = slice(*np.searchsorted(rows, (at, at + 2048)))
        x = np.zeros((min(2048, len(labels) - at), len(top)), dtype=np.float32)
        x[rows[span] - at, index[span]] = 1
        both += x.T @ x
        hit += x.T @ (x * labels[at : at + 2048, None].astype(np.float32))
    own = (np.diag(hit) + rate) / (np.diag(both) + 1.0)
    odds = np.log(own / (1 - own))
    share = _sigmoid(odds[:, None] + odds[None, :] - np.log(rate / (1 - rate)))
    expected = both * share
    enough = (expected >= 5) & (both - expected >= 5)
    gap = np.abs(hit - expected) / np.sqrt(np.maximum(expected * (1 - share), 1e-9))
    np.fill_diagonal(gap, 0.0)
    out[top] = (enough & (gap >= PAIR_DEVIATIONS)).any(axis=1)
    return out


def fit(features: list[np.ndarray], labels: np.ndarray, seed: int = 1, tally: Tally | None = None) -> tuple[np.ndarray, Machine]:
    """The used slots (sorted) and the machine over them, by AdaGrad on the logistic loss.

    Terms take part that differ between the classes by themselves, counted over `tally` (slots,
    rows with each, those of label 1, all rows, all of label 1) or else over the rows given,
    and terms that do so in pairs, counted over the rows given.
    """
    n = len(labels)
    rows = np.repeat(np.arange(n), [len(f) for f in features])
    flat = np.concatenate([*features, np.empty(0, dtype=np.int64)]).astype(np.int64)
    slots, index, present = np.unique(flat, return_inverse=True, return_counts=True)
    rate = labels.mean() if n else 0.0
    if tally is None:
        positive = np.bincount(index, weights=labels[rows].astype(float), minlength=len(slots))
        chosen = _own_gap(present, positive, n, int(labels.sum()))
    else:
        known, *counts = tally
        chosen = np.isin(slots, known[_own_gap(*counts)])
    chosen |= _paired(rows, index, labels, len(slots)) & (present >= MIN_ROWS)
    slots, renumber = slots[chosen], np.cumsum(chosen) - 1
    use = chosen[index]
    rows, index = rows[use], renumber[index[use]]
    rng = np.random.default_rng(seed)
    rate = min(max(rate, 1e-6), 1 - 1e-6)
    machine = Machine(float(np.log(rate / (1 - rate))), np.zeros(len(slots)), rng.normal(0, 0.01, (len(slots), FACTORS)))
    if len(slots) == 0 or labels.min() == labels.max():
        return slots, machine
    begins = np.searchsorted(rows, np.arange(n + 1))
    seen_w, seen_v, seen_b = np.full(len(slots), 1e-6), np.full((len(slots), FACTORS), 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            own = order[at : at + BATCH]
            pick = np.concatenate([np.arange(begins[r], begins[r + 1]) for r in own])
            i = index[pick]
            r = np.repeat(np.arange(len(own)), begins[own + 1] - begins[own])
            error = (_sigmoid(machine.margins(i, r, len(own))) - labels[own]) / len(own)
            used, j = np.unique(i, return_inverse=True)
            grad_w = np.bincount(j, weights=error[r]) + PENALTY * machine.weights[used]
            seen_w[used] += grad_w**2
            machine.weights[used] -= RATE * grad_w / np.sqrt(seen_w[used])
            for f in range(FACTORS):
                v = machine.factors[i, f]
                sums = np.bincount(r, weights=v, minlength=len(own))
                grad = np.bincount(j, weights=error[r] * (sums[r] - v)) + PENALTY * machine.factors[used, f]
                seen_v[used, f] += grad**2
                machine.factors[used, f] -= RATE * grad / np.sqrt(seen_v[used, f])
            grad_b = error.sum()
            seen_b += grad_b**2
            machine.bias -= RATE * grad_b / np.sqrt(seen_b)
    return slots, machine


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(slot, rows, positive) of a task's rows; slot -1 counts all of them."""
    total = np.zeros((2, (1 << HASH_BITS) + 1), dtype=np.int64)
    for batch in batches:
        slots, rows = _unhashed(batch.column("slots"))
        labels = (batch.column("label").to_numpy() == 1).astype(np.int64)
        total[0, :-1] += np.bincount(slots, minlength=1 << HASH_BITS)
        total[1, :-1] += np.bincount(slots, weights=labels[rows], minlength=1 << HASH_BITS).astype(np.int64)
        total[:, -1] += batch.num_rows, labels.sum()
    used = np.flatnonzero(total[0])
    numbers = np.where(used == 1 << HASH_BITS, -1, used)
    yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(total[0, used]), pa.array(total[1, used])], names=["slot", "n", "positive"])


def learn(
    rows: DataFrame, text: str = "text", label: str = "label", key: str = "doc_id", sample: int = SAMPLE, labels: DataFrame | None = None
) -> tuple[np.ndarray, Machine]:
    """Fits on the labelled rows, or on a hash sample of about `sample` of them when there are more.

    `labels` has (key, label) where rows have no label; texts become hashed terms before they
    are joined to it. The counts that choose terms by their own difference are those of all
    labelled rows. Only these counts (2^HASH_BITS at most) and hashed terms and labels of the
    sample reach the driver. Rows without a label are left out; no rows, or one class only,
    gives a machine that returns the class share.
    """
    source = rows.select(F.col(key).alias("row_key"), F.col(text).alias("text"), *([] if labels is not None else [F.col(label).cast("double").alias("label")]))
    if labels is None:
        source = source.filter("label IS NOT NULL")
    types = [f"{n} {t}" for n, t in source.dtypes if n != "text"]
    hashed = source.mapInArrow(_hashed, ", ".join([*types, "slots binary"]))
    if labels is not None:
        marks = labels.select(F.col(key).alias("of"), F.col(label).cast("double").alias("label")).filter("label IS NOT NULL")
        hashed = hashed.join(marks.hint("merge"), F.col("row_key") == F.col("of")).drop("of")
    labelled = cut_lineage(hashed)
    counts = labelled.select("label", "slots").mapInArrow(_tally, "slot bigint, n bigint, positive bigint")
    found = counts.groupBy("slot").agg(F.sum("n").alias("n"), F.sum("positive").alias("positive")).orderBy("slot").toArrow()
    slot, n, positive = (found.column(c).to_numpy() for c in ("slot", "n", "positive"))
    total, hits = (int(n[0]), int(positive[0])) if len(slot) else (0, 0)
    if total > sample:
        labelled = labelled.filter(F.pmod(F.xxhash64("row_key"), F.lit(1 << 30)) < int(sample / total * (1 << 30)))
    # In a fixed order, so that a fit can be repeated.
    features = labelled.orderBy(F.xxhash64("row_key"), "label", "slots").select("label", "slots").toArrow()
    lists = []
    for batch in filter(len, features.to_batches()):
        slots, owner = _unhashed(batch.column("slots"))
        lists += np.split(slots, np.searchsorted(owner, np.arange(1, batch.num_rows)))
    return fit(lists, features.column("label").to_numpy(), tally=(slot[1:], n[1:], positive[1:], total, hits))


def _scores(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    slots, *parts = shared.value
    machine = Machine(*parts)
    number = np.full(1 << HASH_BITS, -1, dtype=np.int64)
    number[slots] = np.arange(len(slots))
    for batch in kernel.slices(batches, "text"):
        found, rows = terms(batch)
        index = number[found]
        used = index >= 0
        margins = machine.margins(index[used], rows[used], batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column("row_key"), pa.array(_sigmoid(margins))], names=["row_key", "score"])


def score(docs: DataFrame, model: tuple[np.ndarray, Machine], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) for each row: the probability of label 1 from the distinct terms of the whole text.

    Null, empty and unknown texts get the bias alone. Repeated rows are scored each, null
    keys are kept, other columns are not read.
    """
    source = docs.select(F.col(key).alias("row_key"), F.lower(F.col(text)).alias("text"))
    slots, machine = model
    shared = docs.sparkSession.sparkContext.broadcast((slots, machine.bias, machine.weights, machine.factors))
    schema = f"row_key {dict(source.dtypes)['row_key']}, score double"
    return source.mapInArrow(lambda it: _scores(it, shared), schema).withColumnRenamed("row_key", key)
