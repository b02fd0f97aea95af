"""Prefix trie of conversations from padded matrices of turn ids, over range shards whose shared nodes are recombined."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.mixing import n_words
from tallyfold.session import cut_lineage

#: Bytes of a turn's id: the md5 of its role and text.
ID = 16
#: Turns by which conversations are dealt to shards, and the columns of one padded matrix.
COLUMNS = 32
#: Turns in a shard, about.
SHARD = 1 << 18

_EMPTY = hashlib.sha256(b"").hexdigest()


def turn_id(role: Column, text: Column) -> Column:
    """32 hex digits; null is empty, and the length of the role keeps role and text apart."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))


def rebuilt(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", span: int = 20, heads: int = 4) -> DataFrame:
    """(conv, path, words): each conversation's turn ids, concatenated, and the words of each turn.

    Conversation c starts with the first crc32(c) mod heads turns of conversation c - c % span
    and goes on with its own turns behind as many.
    """
    told = turns.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("conv"),
        F.struct(F.col(turn).alias("turn"), turn_id(F.col(role), F.col(text)).alias("id"), n_words(F.col(text)).alias("words")).alias("t"),
    )
    own = cut_lineage(told.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("ts")).select("conv", F.transform("ts", lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("ts")))
    bases = own.filter(F.col("conv") % span == 0).select(F.col("conv").alias("base"), F.slice("ts", 1, heads - 1).alias("first"))
    n_first = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(heads)).cast("int")
    none = F.array().cast("array<struct<id:string,words:bigint>>")
    joined = own.withColumn("h", n_first).join(bases, F.col("conv") - F.col("conv") % span == F.col("base"), "left")
    # F.slice takes no length 0 of an array that may be null.
    head = F.when(F.col("h") > 0, F.slice(F.coalesce("first", none), F.lit(1), F.greatest("h", F.lit(1)))).otherwise(none)
    whole = F.concat(head, F.slice("ts", F.col("h") + 1, F.size("ts")))
    ids = F.array_join(F.transform(whole, lambda t: t["id"]), "")
    return joined.select("conv", F.unhex(ids).alias("path"), F.transform(whole, lambda t: t["words"]).alias("words"))


def _gather(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """conv, where each row's turns begin, ids as big-endian halves, words."""
    convs, sizes, ids, words = [], [], [], []
    for batch in batches:
        path = batch.column("path").cast(pa.large_binary())
        offsets = np.frombuffer(path.buffers()[1], dtype=np.int64)[path.offset : path.offset + len(path) + 1]
        convs.append(batch.column("conv").to_numpy())
        sizes.append(np.diff(offsets) // ID)
        if offsets[-1] > offsets[0]:
            ids.append(np.frombuffer(path.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]].copy())
        words.append(batch.column("words").flatten().to_numpy())
    if not convs:
        return (np.empty(0, dtype=np.int64),) * 4
    flat = np.concatenate(ids) if ids else np.empty(0, dtype=np.uint8)
    begins = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
    return np.concatenate(convs), begins, flat.view(">u8").reshape(-1, 2), np.concatenate(words)


def _codes(ids: np.ndarray) -> np.ndarray:
    """Turn ids as 1, 2, ... in their order; 0 is left for padding."""
    if len(ids) == 0:
        return np.empty(0, dtype=np.int32)
    high, low = ids[:, 0].astype(np.uint64), ids[:, 1].astype(np.uint64)
    order = np.lexsort((low, high))
    new = np.ones(len(order), dtype=np.int32)
    new[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
    codes = np.empty(len(order), dtype=np.int32)
    codes[order] = np.cumsum(new)
    return codes


class Trie:
    """The nodes of one shard, in order of depth; node 0 is the root.

    Rows are sorted by padded matrices of COLUMNS turns at a time; only rows that reach a
    matrix's columns are in it. Columns' changes between neighbours are or-ed from left to
    right: where the sum is set, a node starts, and reduceat over the starts sums up a depth.
    """

    def __init__(self, conv: np.ndarray, begins: np.ndarray, codes: np.ndarray, words: np.ndarray):
        sizes = np.diff(begins)
        rows = np.argsort(conv, kind="stable")
        node = np.zeros(len(rows), dtype=np.int64)
        depths = [[np.zeros(1, np.int64), np.array([len(conv)]), conv[rows[:1]], np.zeros(1, np.int64), np.zeros(1, np.int64), np.ones(1, bool)]]
        self.ends = [(0, conv[rows[sizes[rows] == 0]])]
        turnless = bool((sizes == 0).any())
        made, is_open = 1, [np.ones(1, bool)]
        for first in range(0, int(sizes.max(initial=0)), COLUMNS):
            go_on = sizes[rows] > first
            rows, node = rows[go_on], node[go_on]
            width = min(COLUMNS, int(sizes[rows].max()) - first)
            matrix = np.zeros((len(rows), width), dtype=np.int32)
            for j in range(width):
                there = np.flatnonzero(sizes[rows] > first + j)
                matrix[there, j] = codes[begins[rows[there]] + first + j]
            order = np.lexsort((conv[rows], *matrix.T[::-1], node))
            rows, node, matrix = rows[order], node[order], matrix[order]
            changed = np.ones(len(rows), dtype=bool)
            changed[1:] = node[1:] != node[:-1]
            for j in range(width):
                changed[1:] |= matrix[1:, j] != matrix[:-1, j]
                there = np.flatnonzero(matrix[:, j])
                starts = np.flatnonzero(changed[there])
                n = np.diff(np.append(starts, len(there)))
                tops = there[starts]
                parent = node[tops]
                if first == 0:
                    # Other shards may hold nodes on the way to the first or the last row, and what is below the last matrix column on it.
                    shared = np.zeros(len(starts), dtype=bool)
                    shared[0] |= there[0] == 0 and not turnless
                    shared[-1] |= there[-1] == len(rows) - 1
                else:
                    shared = np.concatenate(is_open)[parent] if j == 0 else is_open[-1][parent - (made - len(is_open[-1]))]
                numbers = made + np.arange(len(starts))
                node[there] = np.repeat(numbers, n)
                at = begins[rows[tops]] + first + j
                depths.append([parent, n, np.minimum.reduceat(conv[rows[there]], starts), words[at], at, shared])
                is_open.append(shared)
                made += len(starts)
                done = there[sizes[rows[there]] == first + j + 1]
                if len(done):
                    of = node[done]
                    cuts = np.flatnonzero(np.diff(of)) + 1
                    self.ends += zip(of[np.concatenate([[0], cuts])].tolist(), np.split(conv[rows[done]], cuts), strict=True)
        self.parent, self.n_convs, self.conv, self.words, self.at, self.open = (np.concatenate(c) for c in zip(*depths, strict=True))
        self.begins = np.concatenate([[0], np.cumsum([len(d[0]) for d in depths])])
        self.depth = np.repeat(np.arange(len(depths)), np.diff(self.begins))
        self.children = np.bincount(self.parent[1:], minlength=made)

    def subtree(self, own: np.ndarray) -> np.ndarray:
        """Sums over each node and all below it, from the deepest up."""
        return subtree_sums(own, self.parent, self.begins)


def subtree_sums(own: np.ndarray, parent: np.ndarray, begins: np.ndarray) -> np.ndarray:
    total = own.astype(np.int64)
    for d in range(len(begins) - 2, 0, -1):
        part = slice(begins[d], begins[d + 1])
        np.add.at(total, parent[part], total[part])
    return total


def _joined(convs: np.ndarray) -> str:
    return ",".join(map(str, convs.tolist()))


_SHARD_SCHEMA = (
    "shard bigint, key binary, parent_key binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved_tokens bigint, words bigint, first_end bigint, ends string"
)


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of a shard. Nodes that other shards may share have a key; their counts are this shard's part,
    n_leaves and saved_tokens those of the closed nodes below, ends the ids themselves. Others are whole, ends is hashed."""
    conv, begins, ids, words = _gather(batches)
    if len(conv) == 0:
        return
    trie = Trie(conv, begins, _codes(ids), words)
    n, is_open = len(trie.parent), trie.open
    closed = ~is_open
    leaves = trie.subtree((trie.children == 0) & closed)
    saved = trie.subtree(np.where(closed, (trie.n_convs - 1) * trie.words, 0))
    inner = np.bincount(trie.parent[1:][closed[1:]], minlength=n)
    keys: list[bytes | None] = [None] * n
    keys[0] = bytes(ID)
    raw = ids.view(np.uint8).reshape(-1, ID) if len(ids) else np.empty((0, ID), np.uint8)
    for k in np.flatnonzero(is_open)[1:]:
        keys[k] = hashlib.blake2b(keys[trie.parent[k]] + raw[trie.at[k]].tobytes(), digest_size=ID).digest()
    parent_keys = [None if k == 0 else keys[p] for k, p in enumerate(trie.parent.tolist())]
    first_end: list[int | None] = [None] * n
    ends = [None if o else _EMPTY for o in is_open.tolist()]
    for k, members in trie.ends:
        if len(members):
            text = _joined(members)
            first_end[k] = int(members[0])
            ends[k] = text if is_open[k] else hashlib.sha256(text.encode()).hexdigest()
    parent_conv = pa.array(trie.conv[trie.parent], mask=is_open[trie.parent])
    shard = TaskContext.get().partitionId()
    columns = [
        np.full(n, shard), pa.array(keys, pa.binary()), pa.array(parent_keys, pa.binary()), trie.conv, trie.depth, parent_conv, trie.n_convs,
        np.where(closed, trie.children, inner), leaves, saved, trie.words, pa.array(first_end, pa.int64()), pa.array(ends, pa.string()),
    ]
    batch = pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=[c.split()[0] for c in _SHARD_SCHEMA.split(", ")])
    for at in range(0, n, 1 << 13):
        yield batch.slice(at, 1 << 13)


def _below(rows: pa.Table) -> pa.Table:
    """Subtree sums of what the shared nodes add themselves, over the shared nodes of one shard."""
    rows = rows.sort_by("depth")
    keys, parents = rows.column("key").to_pylist(), rows.column("parent_key").to_pylist()
    number = {k: i for i, k in enumerate(keys)}
    parent = np.array([0 if p is None else number[p] for p in parents], dtype=np.int64)
    depth = rows.column("depth").to_numpy()
    begins = np.searchsorted(depth, np.arange(depth[-1] + 2))
    sums = [subtree_sums(rows.column(c).to_numpy(), parent, begins) for c in ("own_leaves", "own_saved")]
    return pa.table([rows.column("key"), *map(pa.array, sums)], names=["key", "own_leaves", "own_saved"])


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a key follow each other in order of their ids; a hash takes them in one after the other."""
    key, state = None, None
    for batch in batches:
        keys, hashes = [], []
        for k, text in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            if k != key:
                if state is not None:
                    keys.append(key)
                    hashes.append(state.hexdigest())
                key, state = k, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(hashes, pa.string())], names=["key", "hash"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], names=["key", "hash"])


_RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def nodes(paths: DataFrame, n_shards: int | None = None) -> DataFrame:
    """The nodes of (conv, path, words) rows, which are stored; see prefix_trie().

    Shards are ranges of (first COLUMNS turns, hash of all turns, conv), so equal conversations
    lie in a row, in order of conv, and may fill many shards.
    """
    spark = paths.sparkSession
    if n_shards is None:
        turns = paths.agg(F.sum(F.size("words"))).first()[0] or 0
        n_shards = max(spark.sparkContext.defaultParallelism, -(-turns // SHARD))
    dealt = paths.repartitionByRange(n_shards, F.substring("path", 1, ID * COLUMNS), F.md5("path"), "conv")
    found = cut_lineage(dealt.mapInArrow(_shard, _SHARD_SCHEMA))
    shared = found.filter(F.col("key").isNotNull())
    merged = shared.groupBy("key").agg(
        F.first("parent_key").alias("parent_key"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("inner"), F.sum("n_leaves").alias("leaves_below"), F.sum("saved_tokens").alias("saved_below"),
        F.first("words").alias("words"), F.min("shard").alias("home"),
    )
    merged = cut_lineage(merged)
    outer = merged.groupBy(F.col("parent_key").alias("of")).agg(F.count(F.lit(1)).alias("outer"))
    counted = merged.join(outer, F.col("key") == F.col("of"), "left").withColumn("n_children", F.col("inner") + F.coalesce("outer", F.lit(0)))
    counted = cut_lineage(
        counted.select(
            "key", "parent_key", "depth", "conv_id", "n_convs", "n_children", "leaves_below", "saved_below", "home",
            (F.col("n_children") == 0).cast("bigint").alias("own_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("own_saved"),
        )
    )
    # What a shared node adds itself goes to one of its shards, which sums it up for all its shared nodes above.
    at_home = counted.select(F.col("key").alias("home_key"), "home", "own_leaves", "own_saved")
    here = shared.select("shard", "key", "parent_key", "depth")
    zero = F.lit(0).cast("bigint")
    local = here.join(at_home, (F.col("key") == F.col("home_key")) & (F.col("shard") == F.col("home")), "left").select(
        "shard", "key", "parent_key", "depth", F.coalesce("own_leaves", zero).alias("own_leaves"), F.coalesce("own_saved", zero).alias("own_saved")
    )
    below = local.groupBy("shard").applyInArrow(_below, "key binary, own_leaves bigint, own_saved bigint")
    sums = below.groupBy(F.col("key").alias("sum_key")).agg(F.sum("own_leaves").alias("own_leaves"), F.sum("own_saved").alias("own_saved"))
    parts = shared.filter(F.col("ends").isNotNull()).select("key", "first_end", "ends")
    hashed = parts.repartition("key").sortWithinPartitions("key", "first_end").select("key", "ends").mapInArrow(_hash_ends, "key binary, hash string")
    wide = cut_lineage(
        counted.drop("own_leaves", "own_saved", "home")
        .join(sums, F.col("key") == F.col("sum_key"))
        .join(hashed.withColumnRenamed("key", "hash_key"), F.col("key") == F.col("hash_key"), "left")
        .select(
            "key", "parent_key", "depth", "conv_id", "n_convs", "n_children", (F.col("leaves_below") + F.col("own_leaves")).alias("n_leaves"),
            (F.col("saved_below") + F.col("own_saved")).alias("saved_tokens"), F.coalesce("hash", F.lit(_EMPTY)).alias("ends_sha256"),
        )
    )
    least = wide.select(F.col("key").alias("up_key"), F.col("conv_id").alias("up_conv"))
    joints = wide.join(least, F.col("parent_key") == F.col("up_key"), "left").withColumn("parent_conv_id", F.col("up_conv"))
    # The parent of a closed node is looked up by shard and key, so a parent of very many children is many small keys.
    by_shard = here.select(F.col("shard").alias("up_shard"), F.col("key").alias("shard_key")).join(least, F.col("shard_key") == F.col("up_key"))
    by_shard = by_shard.select("up_shard", "shard_key", "up_conv")
    lone = found.filter(F.col("key").isNull()).join(by_shard, (F.col("shard") == F.col("up_shard")) & (F.col("parent_key") == F.col("shard_key")), "left")
    lone = lone.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "up_conv")).withColumnRenamed("ends", "ends_sha256")
    return joints.select(_RESULT).unionByName(lone.select(_RESULT))


def prefix_trie(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), a row a node.

    Conversations are rebuilt first, see rebuilt(). A node is a distinct sequence of first
    turns (role, text); conv_id is its smallest member. saved_tokens sums, over a node's
    subtree, the words of the last turn for every member but one. ends_sha256 is over the ids,
    ascending, of the members that end there. Turns are told apart by their 128-bit md5.

    A shard's turns and ids of 16 bytes each are held by its task, and one conversation's are
    one row; texts are not. Shards share only the nodes on the way to their first and last
    conversations, which are combined by key.

    Turns are ordered by `turn`, null first, equal ones by their md5. Null role or text is
    empty. Rows without a conv_id belong to no conversation and are left out. A repeated row
    is a turn of its own. No rows in, no rows out. Other columns are not read.
    """
    return nodes(cut_lineage(rebuilt(turns, conv, turn, role, text)))
