"""Sequence packing by lexical retrieval: a sharded BM25 index fills each window with neighbours."""

from __future__ import annotations

import string
import zlib
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm import kernel
from tallyfold.session import cut_lineage

WINDOW = 4096
END = 2
#: Tokens of one shard, about.
SHARD_TOKENS = 1_000_000
#: Documents of one shard, at most about.
SHARD_DOCUMENTS = 1_500
#: Terms of a seed document that are looked up: those with the largest weight.
QUERY_TERMS = 48
K1 = 1.2
B = 0.75
#: Words that are not plain whose ids a worker remembers before it starts anew.
REMEMBERED = 150_000
#: Plain words that a worker remembers, some 50 bytes each.
REMEMBERED_PLAIN = 400_000
#: Bytes of text that are tokenized at once: the more, the fewer distinct words in all.
TOKENIZE_SLICE = 4 << 20

_PUNCTUATION = string.punctuation


#: Byte values as the characters that byte-level vocabularies use for them.
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_SIGNS = {b: chr(b) for b in _VISIBLE} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _VISIBLE)}
#: The bytes of joined words as UTF-16 code units of those characters; the line feed between words stays.
_UNITS = np.array([b if b == 10 else ord(_BYTE_SIGNS[b]) for b in range(256)], dtype="<u2")


class WordTokens:
    """Token ids by white-space separated word: the pre-tokenizer never joins across white space.

    Plain words (Latin letters) are cut from the ASCII signs after them, one token run of their own, and given to the merge
    model directly, since normalisation only lowers them; all other words take the whole
    way. Plain words are remembered in arrays, so words met before are found together; others are remembered when met in a
    second batch.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.known: dict[str, bytes] = {}
        self.met: set[int] = set()
        #: Remembered plain words, their ids in a row, and where each one's ids begin (one entry more).
        self.words = pa.array([], type=pa.large_string())
        self.flat, self.begins = np.empty(0, dtype=np.uint32), np.zeros(1, dtype=np.int64)

    def _merged(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of plain words in a row, and how many each has."""
        merge, ids, sizes = self.merge, array("I"), []
        if len(words):
            data, bounds = kernel.utf8(words)
            signs = _UNITS[np.insert(data, bounds[1:-1], 10)].tobytes().decode("utf-16-le")
            for word in signs.split("\n"):
                tokens = merge(word)
                ids.extend([t.id for t in tokens])
                sizes.append(len(tokens))
        return np.array(ids, dtype=np.uint32), np.array(sizes, dtype=np.int64)

    def _other(self, word: str) -> bytes:
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def plain(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For distinct plain words in lower case: ids in a row, where each word's begin there, and how many each has."""
        words = words.cast(pa.large_string())
        at = pc.index_in(words, value_set=self.words)
        fresh = words.filter(pc.is_null(at))
        ids, own = self._merged(fresh)
        place = pc.fill_null(at, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        place[place < 0] = len(self.words) + np.arange(len(own))
        self.words = pa.concat_arrays([self.words, fresh])
        self.begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum(own)])
        self.flat = np.concatenate([self.flat, ids])
        flat, begins, sizes = found = self.flat, self.begins[place], np.diff(self.begins)[place]
        if len(self.words) > REMEMBERED_PLAIN:
            # Frequent words are in every slice: the last one's stay.
            if len(words) > REMEMBERED_PLAIN:
                words, begins, sizes = words.slice(0, REMEMBERED_PLAIN // 2), begins[: REMEMBERED_PLAIN // 2], sizes[: REMEMBERED_PLAIN // 2]
            self.words, self.begins = words, np.concatenate([[0], np.cumsum(sizes)])
            self.flat = np.empty(self.begins[-1], dtype=np.uint32)
            _copy(flat, begins, self.flat, self.begins[:-1], sizes)
        return found

    def lookup(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words that take the whole way in a row, and how many each has."""
        known, met = self.known, self.met
        out = []
        for word in words:
            ids = known.get(word)
            if ids is None:
                ids = self._other(word)
                mark = hash(word)
                if mark in met:
                    known[word] = ids
                else:
                    met.add(mark)
            out.append(ids)
        if len(known) > REMEMBERED:
            self.known = dict(islice(known.items(), len(known) // 2, None))
        if len(met) > 3 * REMEMBERED:
            met.clear()
        sizes = np.fromiter(map(len, out), dtype=np.int64, count=len(out)) // 4
        return np.frombuffer(b"".join(out), dtype=np.uint32), sizes

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's ids begin (one entry more)."""
        data, bounds = kernel.utf8(texts)
        starts, ends, rows = kernel.spans(data, bounds, kernel.WORD)
        if len(starts) == 0:
            return np.empty(0, dtype=np.uint32), np.zeros(len(texts) + 1, dtype=np.int64)
        # Words as an Arrow array over the same bytes: each value runs to the next word, blanks are cut.
        offsets = np.append(starts, ends[-1])
        words = pc.ascii_rtrim_whitespace(pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data)))
        coded = words.dictionary_encode()
        ids, begins = self._by_word(coded.dictionary)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        # A slice has fewer than 2**31 ids, so narrow numbers do.
        begins = begins.astype(np.int32)
        lengths = np.diff(begins)[codes]
        total = np.zeros(len(codes) + 1, dtype=np.int32)
        np.cumsum(lengths, out=total[1:])
        at = np.repeat(begins[codes] - total[:-1], lengths)
        at += np.arange(total[-1], dtype=np.int32)
        out = ids[at]
        return out, total[np.searchsorted(rows, np.arange(len(texts) + 1))].astype(np.int64)

    def _by_word(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of each distinct word, and where they begin (one entry more)."""
        core = pc.ascii_rtrim(words, _PUNCTUATION)
        # Letters whose lower case is one letter of the same set; others go the whole way.
        plain = pc.match_substring_regex(core, "^[A-Za-zÀ-ÖØ-öø-ÿ]+$")
        is_plain = plain.to_numpy(zero_copy_only=False)
        sizes = np.zeros(len(words), dtype=np.int64)
        parts = []
        cores = pc.utf8_lower(core.filter(plain)).dictionary_encode()
        tails = _tails(words.filter(plain), core.filter(plain)).dictionary_encode()
        others = words.filter(pc.invert(plain))
        flat, starts, own = self.plain(cores.dictionary)
        parts.append((flat, starts, own, cores.indices.to_numpy(zero_copy_only=False)))
        flat, own = self.lookup(tails.dictionary.to_pylist())
        parts.append((flat, np.cumsum(own) - own, own, tails.indices.to_numpy(zero_copy_only=False)))
        flat, own = self.lookup(others.to_pylist())
        sizes[is_plain] = parts[0][2][parts[0][3]] + parts[1][2][parts[1][3]]
        sizes[~is_plain] = own
        begins = np.concatenate([[0], np.cumsum(sizes)])
        out = np.empty(begins[-1], dtype=np.uint32)
        to = begins[:-1][is_plain]
        for found, starts, own_sizes, codes in parts:
            n = own_sizes[codes]
            _copy(found, starts[codes], out, to, n)
            to = to + n
        _copy(flat, np.cumsum(own) - own, out, begins[:-1][~is_plain], own)
        return out, begins


def _copy(source: np.ndarray, at: np.ndarray, target: np.ndarray, to: np.ndarray, n: np.ndarray) -> None:
    """target[to[k] : to[k] + n[k]] = source[at[k] : at[k] + n[k]] for all k."""
    within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    target[np.repeat(to, n) + within] = source[np.repeat(at, n) + within]


def _tails(words: pa.Array, core: pa.Array) -> pa.Array:
    """What follows the core of each word."""
    sizes = pc.subtract(pc.binary_length(words), pc.binary_length(core)).to_numpy(zero_copy_only=False).astype(np.int64)
    data, bounds = kernel.utf8(words)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    take = np.repeat(bounds[1:] - sizes - begins[:-1], sizes) + np.arange(begins[-1])
    raw = pa.py_buffer(np.ascontiguousarray(data[take]).tobytes())
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(begins.astype(np.int64).tobytes()), raw)


_TOKENS: dict[str, WordTokens] = {}


def _tokenize(batches: Iterator[pa.RecordBatch], path: str, end: int) -> Iterator[pa.RecordBatch]:
    """A row for each document, and at the end of the task one for each token that it met.

    Rows of documents have ids; the others have the token as n_tokens and the number of
    documents with it as sketch. So the counting needs no second pass over the ids.
    """
    if path not in _TOKENS:
        _TOKENS[path] = WordTokens(path)
    tokens = _TOKENS[path]
    totals = np.zeros(1 << 16, dtype=np.int64)
    key_type = None
    for batch in kernel.slices(batches, "text", TOKENIZE_SLICE):
        n, key_type = batch.num_rows, batch.column("row_key").type
        ids, begins = tokens.ids(batch.column("text"))
        place = begins + np.arange(n + 1)
        out = np.full(place[-1], end, dtype=np.uint32)
        inner = np.ones(len(out), dtype=bool)
        inner[place[1:] - 1] = False
        out[inner] = ids
        row, token, _ = _distinct(np.repeat(np.arange(n, dtype=np.int32), np.diff(place)), out)
        found = np.bincount(token, minlength=len(totals))
        totals = found + np.pad(totals, (0, len(found) - len(totals)))
        size = 4 if out.max(initial=0) >= 1 << 16 else 2
        raw = out.astype(f"<u{size}")
        data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer((place * size).tobytes()), pa.py_buffer(raw.tobytes())])
        yield pa.RecordBatch.from_arrays(
            [batch.column("row_key"), pa.array(np.diff(place)), pa.array(_sketches(row, token, n)), data.cast(pa.binary())],
            names=["row_key", "n_tokens", "sketch", "ids"],
        )
        del ids, out, inner, row, token, raw, data
        kernel.release()
    if key_type is not None:
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(used), key_type), pa.array(used), pa.array(totals[used]), pa.nulls(len(used), pa.binary())], names=["row_key", "n_tokens", "sketch", "ids"]
        )


def _distinct(rows: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, tokens and counts of the distinct tokens of each row, by row and token."""
    narrow = rows[-1:].max(initial=0) < 1 << 16 and tokens.max(initial=0) < 1 << 16
    kind, shift = (np.uint32, 16) if narrow else (np.int64, 32)
    both = rows.astype(kind)
    both <<= kind(shift)
    both |= tokens.astype(kind)
    both, counts = np.unique(both, return_counts=True)
    return (both >> kind(shift)).astype(np.int64), (both & kind((1 << shift) - 1)).astype(np.int64), counts


def _sketches(row: np.ndarray, token: np.ndarray, n: int) -> np.ndarray:
    """Documents with many common tokens often share it: the least of three hashes over the distinct tokens."""
    begins = np.searchsorted(row, np.arange(n))
    out = np.zeros(n, dtype=np.uint64)
    for seed in (11, 22, 33):
        hashes = kernel.mix(np.arange(int(token.max()) + 1, dtype=np.uint64) + np.uint64(seed << 40)) >> np.uint64(43)
        out = (out << np.uint64(21)) | np.minimum.reduceat(hashes[token], begins)
    return out.view(np.int64)


def _unpacked(raw, n: int) -> np.ndarray:
    data = np.frombuffer(raw, dtype=np.uint8)
    return data.view("<u4" if len(data) == 4 * n else "<u2")


class Shard:
    """A BM25 inverted index of one shard's documents, with corpus-wide document frequencies."""

    def __init__(self, documents: list[np.ndarray], idf: np.ndarray, mean_length: float):
        self.size = len(documents)
        lengths = np.array([len(d) for d in documents])
        owner, term, counts = _distinct(np.repeat(np.arange(self.size, dtype=np.int32), lengths), np.concatenate(documents))
        norm = K1 * (1 - B + B * lengths / mean_length)
        weight = (idf[term] * counts * (K1 + 1) / (counts + norm[owner])).astype(np.float32)
        first = np.searchsorted(owner, np.arange(self.size + 1))
        self.query = []
        for k in range(self.size):
            t, w = term[first[k] : first[k + 1]], weight[first[k] : first[k + 1]]
            self.query.append(t[np.argpartition(-w, QUERY_TERMS)[:QUERY_TERMS]] if len(t) > QUERY_TERMS else t)
        # Numbers of 16 bits are sorted by radix.
        order = np.argsort(term.astype(np.uint16) if term.max(initial=0) < 1 << 16 else term, kind="stable")
        self.owner, self.weight = owner[order], weight[order]
        self.begin = np.searchsorted(term[order], np.arange(len(idf) + 1))

    def neighbours(self, seed: int, unused: np.ndarray, most: int = 64) -> list[int]:
        """The `most` best unused documents that share a query term with the seed, worst first (ties: by place)."""
        lists = [slice(self.begin[t], self.begin[t + 1]) for t in self.query[seed]]
        owner = np.concatenate([self.owner[s] for s in lists])
        score = np.bincount(owner, weights=np.concatenate([self.weight[s] for s in lists]), minlength=self.size)
        found = np.flatnonzero((score > 0) & unused)
        if len(found) > most:
            found = found[np.argpartition(-score[found], most)[:most]]
        return found[np.lexsort((found, -score[found]))][::-1].tolist()


def pack_shard(documents: list[np.ndarray], idf: np.ndarray, mean_length: float, window: int) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece.

    The seed of a window is what was cut off in the window before, else the first unused
    document. Unused neighbours follow by score until the window is full, and the index is
    asked again when they run out; the one that does not fit is cut, and its rest seeds the
    next window. When no neighbour is left the first unused document follows, so only the
    last window of a shard can stay short.
    """
    index = Shard(documents, idf, mean_length)
    unused = np.ones(index.size, dtype=bool)
    pieces = []
    sequence = offset = first = seed = 0
    rest: tuple[int, int] | None = None
    queue: list[int] = []
    while True:
        if rest is not None:
            doc, start = rest
        else:
            if offset and not queue:
                queue = index.neighbours(seed, unused)
            if offset and queue:
                doc = queue.pop()
            else:
                while first < index.size and not unused[first]:
                    first += 1
                if first == index.size:
                    return pieces
                doc = first
            start = 0
            unused[doc] = False
        if offset == 0:
            seed, queue = doc, []
        length = min(window - offset, len(documents[doc]) - start)
        pieces.append((doc, start, length, sequence, offset))
        offset += length
        rest = (doc, start + length) if start + length < len(documents[doc]) else None
        if offset == window:
            sequence, offset = sequence + 1, 0


def _packed(batches: Iterator[pa.RecordBatch], shared, window: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    # Tokenizing is over; its words would only take memory from the index.
    _TOKENS.clear()
    kernel.release()
    idf, mean_length = shared.value
    keys, documents, places, shard, n_tokens, part = [], [], [], None, 0, 0

    def out() -> pa.RecordBatch:
        # Rows arrive in any order; the same shard is packed alike whenever its task runs again.
        order = np.lexsort(np.array(places, dtype=np.int64).T[::-1])
        keys[:], documents[:] = [keys[k] for k in order], [documents[k] for k in order]
        pieces = pack_shard(documents, idf, mean_length, window)
        crc = [zlib.crc32(documents[d][s : s + n].astype("<u4").tobytes()) for d, s, n, _, _ in pieces]
        at = np.array(pieces, dtype=np.int64).reshape(-1, 5)
        sizes = np.array([len(d) for d in documents])
        ids = [documents[d][s : s + n].astype("<u4").tobytes() if with_ids else None for d, s, n, _, _ in pieces]
        columns = [
            pa.concat_arrays(keys).take(pa.array(at[:, 0])), pa.array(at[:, 1]), pa.array(at[:, 2]), pa.array(crc, type=pa.int64()),
            pa.array(sizes[at[:, 0]]), pa.array((np.int64(shard) << 40) + (np.int64(part) << 24) + at[:, 3]), pa.array(at[:, 4]), pa.array(ids, type=pa.binary()),
        ]
        names = ["row_key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
        return pa.RecordBatch.from_arrays(columns, names=names)

    for batch in batches:
        shards = batch.column("shard").to_pylist()
        where = list(zip(batch.column("sketch").to_pylist(), batch.column("tie").to_pylist(), strict=True))
        for r, (raw, n) in enumerate(zip(batch.column("ids"), batch.column("n_tokens").to_pylist(), strict=True)):
            if shard != shards[r]:
                if documents:
                    yield out()
                    kernel.release()
                keys, documents, places, n_tokens, part, shard = [], [], [], 0, 0, shards[r]
            elif n_tokens > 2 * SHARD_TOKENS or len(documents) >= 2 * SHARD_DOCUMENTS:
                yield out()
                keys, documents, places, n_tokens, part = [], [], [], 0, part + 1
            keys.append(batch.column("row_key").slice(r, 1))
            documents.append(_unpacked(raw.as_buffer(), n))
            places.append(where[r])
            n_tokens += n
    if documents:
        yield out()
    # The worker is used again: the last shard's arrays go before its next stage begins.
    keys, documents, places = [], [], []
    batch = raw = shards = where = None
    kernel.release()


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", window: int = WINDOW, end: int = END, with_ids: bool = True) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids): the pieces of all documents.

    Documents are tokenized once into a stored table (ids and a short lexical sketch) with
    the document frequencies of all tokens. Its rows are range partitioned by sketch and
    key: lexically close documents come together, and a large group of copies is cut evenly
    over shards, each of about SHARD_TOKENS tokens. Each shard is indexed and packed by
    itself (pack_shard). ids are little-endian unsigned 32-bit, or null unless with_ids.

    Null and empty texts are the end id alone. Every id of every row lies in one piece;
    repeated rows and null keys are packed like others. No rows in, no rows out. Other
    columns are not read. tokenizer: path of a tokenizers file, the same on all executors.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(key).alias("row_key"), F.col(text).alias("text"))
    key_type = dict(source.dtypes)["row_key"]
    schema = f"row_key {key_type}, n_tokens bigint, sketch bigint, ids binary"
    stored = cut_lineage(source.mapInArrow(lambda it: _tokenize(it, tokenizer, end), schema))
    tokens = stored.filter("ids IS NOT NULL")
    n, total = tokens.agg(F.count(F.lit(1)), F.sum("n_tokens")).first()
    counted = stored.filter("ids IS NULL").groupBy(F.col("n_tokens").alias("token")).agg(F.sum("sketch").alias("n")).toArrow()
    token = counted.column("token").to_numpy()
    idf = np.zeros(int(token.max(initial=0)) + 1)
    frequency = counted.column("n").to_numpy()
    idf[token] = np.log1p((n - frequency + 0.5) / (frequency + 0.5))
    shared = spark.sparkContext.broadcast((idf, float(total or 0) / max(n, 1)))
    shards = max(1, -(-(total or 0) // SHARD_TOKENS), -(-n // SHARD_DOCUMENTS))
    placed = tokens.repartitionByRange(int(shards), "sketch", "row_key").withColumn("shard", F.spark_partition_id())
    out = f"row_key {key_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
    return placed.select("row_key", "n_tokens", "ids", "sketch", F.xxhash64("row_key").alias("tie"), "shard").mapInArrow(lambda it: _packed(it, shared, window, with_ids), out).withColumnRenamed("row_key", key)
