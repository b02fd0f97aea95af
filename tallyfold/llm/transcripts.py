"""Chat formatting: a hidden Markov model over lines recovers speaker roles by Viterbi."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.session import cut_lineage

ROLES = ["system", "user", "assistant"]
#: Other names of the roles, in role columns and as speaker markers.
ALIASES = {
    "system": "system", "instruction": "system", "instructions": "system",
    "user": "user", "human": "user", "customer": "user", "question": "user", "prompt": "user", "me": "user", "q": "user",
    "assistant": "assistant", "ai": "assistant", "bot": "assistant", "model": "assistant", "agent": "assistant",
    "answer": "assistant", "response": "assistant", "gpt": "assistant", "a": "assistant",
}
MARKER = re.compile(
    r"^\s*(?:<\|im_start\|>\s*|<\|start_header_id\|>\s*|<\|?|#+\s*|\*\*|\[|>\s*)?(" + "|".join(sorted(ALIASES, key=len, reverse=True)) + r")"
    r"(?:\s*(?:\*\*|\]|\|?>|<\|end_header_id\|>))?\s*(?::\s*(?:\*\*)?|(?<=[\]>])|$)",
    re.IGNORECASE,
)
#: Rows of one block; a long conversation is decoded in blocks.
BLOCK_ROWS = 20_000
RENDERED = "<|{role}|>\n{content}\n<|end|>"

#: Features of a line: (name, number of values). Value 0 of marker is no marker, of size no new message.
FEATURES = [("marker", 1 + len(ROLES)), ("size", 22), ("words", 12), ("ending", 5), ("opening", 3)]
_ENDINGS = {".": 1, "?": 2, "!": 3, ":": 4}
#: Counts that stand for what markers mean: tables seldom hold any.
_MARKER_PRIOR, _PRIOR = 200.0, 0.5
_STAY = 0.999
_NEVER = -1e9


def line_features(text: str | None) -> tuple[list[str], np.ndarray]:
    """The lines of a message, and lines x FEATURES."""
    lines = (text or "").split("\n")
    out = np.zeros((len(lines), len(FEATURES)), dtype=np.int64)
    for k, line in enumerate(lines):
        plain = line.strip()
        marker = MARKER.match(line)
        if marker:
            out[k, 0] = 1 + ROLES.index(ALIASES[marker[1].lower()])
        out[k, 2] = min(11, len(plain.split()).bit_length())
        out[k, 3] = _ENDINGS.get(plain[-1:], 0)
        out[k, 4] = 0 if not plain else 1 if plain[0].isupper() else 2
    out[0, 1] = 1 + min(20, len(text or "").bit_length())
    return lines, out


def _index(features: np.ndarray) -> np.ndarray:
    """Features as indices into one table of all values."""
    return features + np.cumsum([0] + [n for _, n in FEATURES[:-1]])


_VALUES = sum(n for _, n in FEATURES)


class RoleModel:
    """Log probabilities: START -> role, role -> role between messages, role -> feature value."""

    def __init__(self, start: np.ndarray, moves: np.ndarray, emissions: np.ndarray):
        self.start, self.moves, self.emissions = start, moves, emissions

    def emitted(self, features: np.ndarray) -> np.ndarray:
        """lines x roles."""
        return self.emissions[:, _index(features)].sum(axis=2).T

    def steps(self, features: np.ndarray) -> np.ndarray:
        """For each line (states x states) of log probabilities; state 0 is START, then the roles.

        A first line of a message, or one with a marker, may change the speaker; others
        seldom do.
        """
        n, s = len(features), len(ROLES)
        stay = np.full((s, s), np.log((1 - _STAY) / (s - 1)))
        np.fill_diagonal(stay, np.log(_STAY))
        out = np.full((n, s + 1, s + 1), _NEVER)
        out[:, 0, 1:] = self.start
        fresh = (features[:, 1] > 0) | (features[:, 0] > 0)
        out[:, 1:, 1:] = np.where(fresh[:, None, None], self.moves, stay)
        out[:, :, 1:] += self.emitted(features)[:, None, :]
        return out


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((len(ROLES), _VALUES), dtype=np.int64)
    for batch in batches:
        for text, role in zip(batch.column("text").to_pylist(), batch.column("role").to_pylist(), strict=True):
            _, features = line_features(text)
            counts[role] += np.bincount(_index(features).ravel(), minlength=_VALUES)
    role, value = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(role), pa.array(value), pa.array(counts[role, value])], names=["role", "value", "n"])


def _role_number(column: str):
    out = F.lit(None).cast("int")
    name = F.lower(F.trim(F.col(column)))
    for alias, role in ALIASES.items():
        out = F.when(name == alias, F.lit(ROLES.index(role))).otherwise(out)
    return out


def learn(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> RoleModel:
    """Counts features by role, and moves between turn k and turn k + 1, over all rows with a known role.

    Roles are counted by (conversation, turn) before the two sides meet, so repeated turns
    do not multiply.
    """
    known = turns.select(
        F.col(conversation).alias("c"), F.col(turn).cast("bigint").alias("t"), F.col(text).alias("text"), _role_number(role).alias("role")
    ).filter("role IS NOT NULL")
    s = len(ROLES)
    emissions = np.full((s, _VALUES), _PRIOR)
    for r in range(s):
        emissions[r, 1 + r] += _MARKER_PRIOR
        emissions[r, 0] += _MARKER_PRIOR
    found = known.select("text", "role").mapInArrow(_feature_counts, "role bigint, value bigint, n bigint")
    for row in found.groupBy("role", "value").agg(F.sum("n").alias("n")).collect():
        emissions[row["role"], row["value"]] += row["n"]
    at = 0
    for _, n in FEATURES:
        emissions[:, at : at + n] = np.log(emissions[:, at : at + n] / emissions[:, at : at + n].sum(axis=1, keepdims=True))
        at += n
    moves, start = np.full((s, s), 1.0), np.full(s, 1.0)
    cells = cut_lineage(known.filter("t IS NOT NULL AND c IS NOT NULL").groupBy("c", "t", "role").agg(F.count(F.lit(1)).alias("n")))
    previous = cells.select("c", (F.col("t") + 1).alias("t"), F.col("role").alias("before"), F.col("n").alias("m"))
    paired = cells.join(previous, ["c", "t"], "left").groupBy("before", "role").agg(F.sum("n").alias("n"))
    for row in paired.collect():
        if row["before"] is None:
            start[row["role"]] += row["n"]
        else:
            moves[row["before"], row["role"]] += row["n"]
    return RoleModel(np.log(start / start.sum()), np.log(moves / moves.sum(axis=1, keepdims=True)), emissions)


def _pieces(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[tuple, list[list]]]:
    """The rows of each (block, conversation) of a sorted partition."""
    key, rows = None, [[] for _ in columns]
    for batch in batches:
        listed = [batch.column(c).to_pylist() for c in columns]
        for k, own in enumerate(zip(batch.column("block").to_pylist(), batch.column("chat").to_pylist(), strict=True)):
            if own != key:
                if key is not None:
                    yield key, rows
                key, rows = own, [[] for _ in columns]
            for held, values in zip(rows, listed, strict=True):
                held.append(values[k])
    if key is not None:
        yield key, rows


def _products(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """The best log probability from each state before a piece to each state at its end."""
    model = RoleModel(*shared.value)
    blocks, chats, cells = [], [], []
    for (block, chat), (texts,) in _pieces(batches, ["text"]):
        total = None
        for text in texts:
            for step in model.steps(line_features(text)[1]):
                total = step if total is None else (total[:, :, None] + step[None, :, :]).max(axis=1)
        blocks.append(block)
        chats.append(chat)
        cells.append(total.ravel().tolist())
    yield pa.RecordBatch.from_arrays(
        [pa.array(blocks, type=pa.int32()), pa.array(chats, type=pa.string()), pa.array(cells, type=pa.list_(pa.float64()))], names=["block", "chat", "cells"]
    )


def _carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block of one conversation: what reaches it from before, and what follows it."""
    rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: r["block"])
    s = len(ROLES) + 1
    steps = [np.array(r["cells"]).reshape(s, s) for r in rows]
    before = [np.array([0.0] + [_NEVER] * (s - 1))]
    for m in steps[:-1]:
        before.append((before[-1][:, None] + m).max(axis=0))
    after = [np.zeros(s)]
    for m in reversed(steps[1:]):
        after.append((m + after[-1][None, :]).max(axis=1))
    kind = pa.list_(pa.float64())
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([r["block"] for r in rows], type=pa.int32()),
            pa.array([r["chat"] for r in rows], type=pa.string()),
            pa.array([b.tolist() for b in before], type=kind),
            pa.array([a.tolist() for a in reversed(after)], type=kind),
        ],
        names=["block", "chat", "before", "after"],
    )


def viterbi(steps: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The best role of each line (ties: the first role)."""
    score, back = before, []
    for step in steps:
        reach = score[:, None] + step
        back.append(reach.argmax(axis=0))
        score = reach.max(axis=0)
    state = int((score + after).argmax())
    out = np.empty(len(steps), dtype=np.int64)
    for k in range(len(steps) - 1, -1, -1):
        out[k] = state
        state = int(back[k][state])
    return out - 1


def _decoded(batches: Iterator[pa.RecordBatch], shared, turn_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    model = RoleModel(*shared.value)
    kinds = [("chat_key", None), ("turn", None), ("part", pa.int64()), ("role", pa.string()), ("content", pa.string()), ("rendered", pa.string())]

    def out(rows: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in kinds]
        types = [key_type, turn_type, *(t for _, t in kinds[2:])]
        return pa.RecordBatch.from_arrays([pa.array(list(c), type=t) for c, t in zip(columns, types, strict=True)], names=[n for n, _ in kinds])

    held: list[tuple] = []
    key_type = None

    def watched() -> Iterator[pa.RecordBatch]:
        nonlocal key_type
        for batch in batches:
            key_type = batch.schema.field("chat_key").type
            yield batch

    for _, (keys, turns, texts, before, after) in _pieces(watched(), ["chat_key", "turn", "text", "before", "after"]):
        read = [line_features(t) for t in texts]
        s = len(ROLES) + 1
        entering = np.array(before[0]) if before[0] is not None else np.array([0.0] + [_NEVER] * (s - 1))
        leaving = np.array(after[0]) if after[0] is not None else np.zeros(s)
        roles = viterbi(np.concatenate([model.steps(f) for _, f in read]), entering, leaving)
        at = 0
        for key, turn, (lines, features) in zip(keys, turns, read, strict=True):
            own = roles[at : at + len(lines)]
            at += len(lines)
            cuts = [0, *(k for k in range(1, len(lines)) if own[k] != own[k - 1] or features[k, 0]), len(lines)]
            for part, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                first = lines[a][MARKER.match(lines[a]).end() :] if features[a, 0] else lines[a]
                content = "\n".join([first, *lines[a + 1 : b]]).strip()
                role = ROLES[own[a]]
                held.append((key, turn, part, role, content, RENDERED.format(role=role, content=content)))
        if len(held) >= 5000:
            yield out(held, key_type)
            held = []
    if held:
        yield out(held, key_type)


def recover(turns: DataFrame, model: RoleModel, conversation: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """(conversation, turn, part, role, content, rendered): the canonical turns of each transcript.

    A transcript is the rows of a conversation by turn (ties by text); its lines are the
    observations. A row whose lines change the speaker, or hold speaker markers, gives
    several parts; markers are cut from the content.

    Rows are range partitioned by conversation and turn, so a conversation of any size is
    spread evenly. One that spans blocks is solved exactly: each block's (states x states)
    product of best log probabilities is taken, the small products are passed along the
    conversation both ways, and each block is decoded between its two borders.

    Null text is one empty line. Null conversations are one conversation, null turns come
    first. Repeated rows are turns of their own. No rows in, no rows out; other columns
    (the role too) are not read.
    """
    spark = turns.sparkSession
    shared = spark.sparkContext.broadcast((model.start, model.moves, model.emissions))
    source = turns.select(F.col(conversation).alias("chat_key"), F.col(turn).alias("turn"), F.col(text).alias("text"))
    types = dict(source.dtypes)
    source = source.withColumn("chat", F.coalesce(F.concat(F.lit("="), F.col("chat_key").cast("string")), F.lit("")))
    n = max(1, -(-source.count() // BLOCK_ROWS))
    order = ["chat", "turn", "tie"]
    spread = source.withColumn("tie", F.xxhash64("text")).repartitionByRange(int(n), *order)
    stored = cut_lineage(spread.withColumn("block", F.spark_partition_id()))
    several = stored.groupBy("chat").agg(F.min("block").alias("a"), F.max("block").alias("b")).filter("a < b").select("chat")

    def sorted_blocks(df: DataFrame) -> DataFrame:
        return df.repartition(int(n), "block").sortWithinPartitions("block", *order)

    products = sorted_blocks(stored.join(several, "chat", "left_semi")).select("block", "chat", "text").mapInArrow(
        lambda it: _products(it, shared), "block int, chat string, cells array<double>"
    )
    borders = products.groupBy("chat").applyInArrow(_carried, "block int, chat string, before array<double>, after array<double>")
    ready = sorted_blocks(stored.join(borders, ["block", "chat"], "left")).select("block", "chat", "chat_key", "turn", "text", "before", "after")
    turn_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}.get(types["turn"], pa.int64())
    if types["turn"] not in ("bigint", "int", "string"):
        ready = ready.withColumn("turn", F.col("turn").cast("bigint"))
        types["turn"] = "bigint"
    schema = f"chat_key {types['chat_key']}, turn {types['turn']}, part bigint, role string, content string, rendered string"
    out = ready.mapInArrow(lambda it: _decoded(it, shared, turn_type), schema)
    return out.withColumnsRenamed({"chat_key": conversation, "turn": turn})
