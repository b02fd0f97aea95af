"""Secret scans: fixed patterns, and Shannon entropy in a sliding window over candidate strings."""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.scalar import let

WINDOW = 20

#: The base kinds in their order, with the least length of what counts; "group" is of the assigned value.
KINDS = ["assign", "access", "hex", "entropy"]
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LENGTH, ACCESS_LENGTH = 6, 20
_KEYWORDS = ["password", "passwd", "secret", "token", "apikey", "api_key"]

#: Candidates for the entropy test: whole runs of key characters with a digit in them.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{20,}"
#: Lower-case words joined by separators: a slug or path, or a key behind a prefix.
JOINED = r"^[a-z0-9]++(?:[_/-][a-z0-9]++)++$"
#: Character class of a candidate (the first that fits) and the entropy of a window that it must reach.
CLASSES = [
    ("hex", r"^[0-9a-f]+$|^[0-9A-F]+$", 3.0),
    ("base32", r"^[A-Z2-7]+=*$", 3.4),
    ("word", rf"^[a-z]+[0-9]+$|{JOINED}", 4.1),
    ("base64", r"^.*$", 3.75),
]
#: Candidates that fit one of these are no secrets.
ALLOWED = [
    r"^[0-9+/_=-]+$",
    r"^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"(?i)example|sample|placeholder|dummy|changeme|redacted",
    r"(.)\1{5}",
    r"0123456789|12345678|(?i:abcdefgh)",
    r"^(?:[A-Za-z]++[/_-])++[0-9]{1,4}$",
]

#: Symbols that are counted each by itself: those of candidates.
ALPHABET = string.ascii_letters + string.digits + "+/_=-"
COUNT_BITS, PER_WORD = 5, 12

_OPEN, _SHUT, _OTHER = "\ue000", "\ue001", "\ue002"
_CHUNK = 64


def _found(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> of the leftmost non-overlapping matches, in code points.

    Matches are fenced with two private signs (those of the text itself are replaced by a
    third, which no pattern here knows), the text is split at them, and lengths are summed up.
    The sums run in chunks, so the work stays near linear when a text has very many matches.
    """
    fenced = F.regexp_replace(F.translate(text, _OPEN + _SHUT, _OTHER * 2), pattern, f"{_OPEN}$0{_SHUT}")
    parts = F.split(fenced, _OPEN, -1)
    # The head stands before the first match; an opening sign is no character of the text.
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / _CHUNK).cast("int")), lambda c: F.slice(parts, c * _CHUNK + 1, _CHUNK))

    def width(part: Column) -> Column:
        return F.length(part) - F.instr(part, _SHUT).cast("boolean").cast("int")

    sizes = F.transform(chunks, lambda chunk: F.aggregate(chunk, F.lit(0), lambda acc, p: acc + width(p)))
    begins = F.aggregate(
        sizes,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all")),
        lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")),
        lambda acc: acc["all"],
    )

    def spans(chunk: Column, begin: Column) -> Column:
        empty = F.array().cast("array<struct<start:int,end:int,value:string>>")

        def step(acc: Column, part: Column) -> Column:
            value = F.substring_index(part, _SHUT, 1)
            span = F.struct(acc["at"].alias("start"), (acc["at"] + F.length(value)).alias("end"), value.alias("value"))
            return F.struct(
                (acc["at"] + width(part)).alias("at"),
                F.when(F.instr(part, _SHUT) > 0, F.concat(acc["all"], F.array(span))).otherwise(acc["all"]).alias("all"),
            )

        return F.aggregate(chunk, F.struct(begin.alias("at"), empty.alias("all")), step, lambda acc: acc["all"])

    return F.flatten(F.zip_with(chunks, begins, spans))


def _none() -> Column:
    return F.array().cast("array<struct<start:int,end:int,value:string>>")


def _where(test: Column, text: Column, pattern: str) -> Column:
    return F.when(test, _found(text, pattern)).otherwise(_none())


def window_entropy(value: Column, width: int = WINDOW, enough: Column | None = None) -> Column:
    """The largest Shannon entropy, in bits, of `width` consecutive characters; 0 for shorter values.

    The counts of the window are kept while it moves, PER_WORD to a long: the character that
    enters and the one that leaves change two of them, and the sum of n * log2(n) by two
    differences. Characters are looked up once, so the work is linear in the length; from the
    first window that has `enough` on, the rest is not looked at. Characters other than
    ALPHABET's are one symbol. width is at most 31.
    """
    term = [n * math.log2(n) if n else 0.0 for n in range(width + 1)]
    growth = F.array(*[F.lit(term[n + 1] - term[n]) for n in range(width)])
    words = -(-(len(ALPHABET) + 1) // PER_WORD)
    places = F.array(
        *[F.struct(F.lit(c // PER_WORD).alias("word"), F.lit(c % PER_WORD * COUNT_BITS).alias("shift"), F.lit(1 << c % PER_WORD * COUNT_BITS).cast("bigint").alias("unit")) for c in range(len(ALPHABET) + 1)]
    )
    start = F.struct(F.array_repeat(F.lit(0).cast("bigint"), words).alias("n"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"), F.lit(0).alias("at"))

    def count(n: Column, place: Column) -> Column:
        return F.call_function("shiftright", F.get(n, place["word"]), place["shift"]).bitwiseAND(F.lit((1 << COUNT_BITS) - 1)).cast("int")

    def step(acc: Column, pair: Column) -> Column:
        new, old = pair["new"], pair["old"]
        full = old.isNotNull()
        same = full & (old["unit"] == new["unit"]) & (old["word"] == new["word"])
        less = F.when(full, F.get(growth, count(acc["n"], old) - 1)).otherwise(F.lit(0.0))
        total = acc["sum"] - less + F.get(growth, count(acc["n"], new) - same.cast("int"))
        now = F.when(acc["at"] >= width - 1, F.lit(math.log2(width)) - total / width).otherwise(F.lit(0.0))

        def moved(n: Column, k: Column) -> Column:
            entered = F.when(new["word"] == k, n + new["unit"]).otherwise(n)
            return F.when(old["word"] == k, entered - old["unit"]).otherwise(entered)

        after = F.struct(F.transform(acc["n"], moved).alias("n"), total.alias("sum"), F.greatest(acc["best"], now).alias("best"), (acc["at"] + 1).alias("at"))
        return after if enough is None else F.when(acc["best"] >= enough, acc).otherwise(after)

    found = F.transform(F.slice(F.split(value, ""), 1, F.length(value)), lambda c: F.get(places, F.instr(F.lit(ALPHABET), c)))
    pairs = let(found, lambda p: F.transform(p, lambda new, i: F.struct(new.alias("new"), F.get(p, i - width).alias("old"))))
    return F.aggregate(pairs, start, step, lambda acc: acc["best"])


def _least(value: Column) -> Column:
    """The entropy that a candidate's class asks for."""
    out = F.lit(99.0)
    for _, pattern, least in reversed(CLASSES):
        out = F.when(value.rlike(pattern), F.lit(least)).otherwise(out)
    return out


def _strong(value: Column) -> Column:
    """Whether a candidate reaches its class's entropy, or one part of joined words does by itself.

    A part counts when it fills a window and mixes letters and digits; it has the class that
    it would have as a candidate, so a prefix does not raise what is asked of the key behind it.
    """
    mixed = F.filter(F.split(value, "[_/-]", -1), lambda p: (F.length(p) >= WINDOW) & p.rlike("[a-z]") & p.rlike("[0-9]"))

    def reaches(v: Column) -> Column:
        return let(_least(v), lambda least: window_entropy(v, enough=least) >= least)

    part = F.when(value.rlike(JOINED), F.exists(mixed, reaches)).otherwise(F.lit(False))
    return reaches(value) | part


def _allowed(value: Column) -> Column:
    out = F.lit(False)
    for pattern in ALLOWED:
        out = out | value.rlike(pattern)
    return out


def _texts(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(F.array(*map(F.lit, KINDS)), s["kind"]), s["start"], s["end"])), ",")


def _tagged(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end")))


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_assign, n_access, n_hex, base, spans, values) for each row.

    base and spans are arrays of (start, kind, end) in order, kind counting in KINDS; spans
    has the base spans and those of the entropy test, which leaves out candidates that touch
    a base span or are allowed. values has the strings of spans' entropy kind. Offsets are
    code points, ends exclusive. Only DataFrame functions are used, row by row: no shuffle.

    Null and empty texts: no spans. Every row gives one row; null keys are kept.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    lowered = F.lower("t")
    has_word = F.lit(False)
    for word in _KEYWORDS:
        has_word = has_word | F.contains(lowered, F.lit(word))
    found = docs.select(F.col(key).alias(key), t.alias("t")).select(
        key,
        "t",
        F.filter(_where(has_word, F.col("t"), ASSIGN), lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= ASSIGN_LENGTH).alias("assign"),
        F.filter(_where(F.contains("t", F.lit("AKIA")), F.col("t"), ACCESS), lambda s: s["end"] - s["start"] >= ACCESS_LENGTH).alias("access"),
        _where(F.col("t").rlike(HEX), F.col("t"), HEX).alias("hex"),
        _where(F.col("t").rlike(CANDIDATE), F.col("t"), CANDIDATE).alias("candidates"),
    )
    based = found.withColumn("base", F.array_sort(F.concat(_tagged(F.col("assign"), "assign"), _tagged(F.col("access"), "access"), _tagged(F.col("hex"), "hex"))))
    free = F.filter("candidates", lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])) & ~_allowed(c["value"]) & c["value"].rlike("[A-Za-z]"))
    strong = F.filter(free, lambda c: _strong(c["value"]))
    out = based.withColumn("strong", F.when(F.size("candidates") > 0, strong).otherwise(_none()))
    return out.select(
        key,
        *(F.size(k).cast("bigint").alias(f"n_{k}") for k in ("assign", "access", "hex")),
        "base",
        F.array_sort(F.concat("base", _tagged(F.col("strong"), "entropy"))).alias("spans"),
        F.transform("strong", lambda s: s["value"]).alias("values"),
    )


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """The spans as text (kind:start:end, comma-joined) and the SHA-256 of the base spans' text."""
    base = _texts(F.col("base"))
    return found.select(key, "n_assign", "n_access", "n_hex", F.sha2(base, 256).alias("base_sha256"), _texts(F.col("spans")).alias("spans"))
