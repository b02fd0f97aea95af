"""Terms, spelling, masking, prompts and replies."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.scalar import edit_distance, running_sum
from tallyfold.operators.matching import near_pairs

TERM = r"\p{L}+"


def terms(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, position, term, start): every term of every text with its 1-based character offset.

    A text is cut into pieces that end with a term; offsets are running piece lengths within
    the row, so whole texts are parsed without a shuffle.
    """
    pieces = F.regexp_extract_all(text, F.lit(r"[^\p{L}]*\p{L}+"), F.lit(0))
    cut = df.select(key, pieces.alias("_p"))
    zipped = cut.select(key, "_p", running_sum(F.transform("_p", F.length)).alias("_o"))
    rows = zipped.select(key, F.posexplode(F.arrays_zip("_p", "_o")).alias("_pos", "_z"))
    term = F.regexp_extract(F.col("_z._p"), TERM, 0)
    return rows.select(
        key,
        (F.col("_pos") + 1).alias("position"),
        F.lower(term).alias("term"),
        (F.col("_z._o") + F.length("_z._p") - F.length(term) + 1).alias("start"),
    )


def term_counts(df: DataFrame, text: str) -> DataFrame:
    found = F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))
    return df.select(F.explode(found).alias("term")).groupBy("term").agg(F.count("*").alias("n"))


def spelling(counts: DataFrame, rare: int, frequent: int) -> DataFrame:
    """Rare terms one edit away from a frequent one; the most frequent parent wins."""
    common = counts.filter(F.col("n") >= frequent)
    near = near_pairs(counts.filter(F.col("n") <= rare), "term", common, "term", 1)
    parents = near.join(common.select(F.col("term").alias("b"), F.col("n").alias("parent_n")), "b")
    best = F.min_by(F.struct("b", "parent_n"), F.struct(-F.col("parent_n"), F.col("b")))
    return parents.groupBy("a").agg(best.alias("_b")).select(
        F.col("a").alias("term"), F.col("_b.b").alias("parent"), F.col("_b.parent_n").alias("parent_n")
    )


def correct_name(df: DataFrame, column: str, reference: str, most: int = 2) -> DataFrame:
    """Replace near-misses of a reference name; keep the distance and the revised value."""
    distance = edit_distance(F.col(column), F.lit(reference))
    return df.withColumns(
        {f"{column}_lev": distance, f"{column}_rev": F.when(distance <= most, reference).otherwise(F.col(column))}
    )


SPANS = "array<struct<start:int,end:int>>"


def mask_spans(text: Column, spans_json: Column, mark: str = "*") -> Column:
    """Overwrite annotated spans (1-based, both ends included) given as JSON."""
    spans = F.from_json(spans_json, SPANS)

    def overwrite(acc: Column, s: Column) -> Column:
        end = F.least(s["end"], F.length(acc))
        width = end - s["start"] + 1
        covered = F.overlay(acc, F.repeat(F.lit(mark), width), s["start"], width)
        return F.when((width > 0) & (s["start"] >= 1), covered).otherwise(acc)

    return F.when(spans.isNull(), text).otherwise(F.aggregate(spans, text, overwrite))


# Entity patterns, applied in this order.
ENTITY_PATTERNS = (
    ("EMAIL", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"),
    ("IP", r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}"),
    ("PHONE", r"(\+?[0-9] )?\([0-9]{3}\) [0-9]{3}-[0-9]{4}"),
    ("ID", r"[0-9]{13,16}"),
)


def mask_entities(text: str | Column) -> Column:
    out = F.col(text) if isinstance(text, str) else text
    for name, pattern in ENTITY_PATTERNS:
        out = F.regexp_replace(out, pattern, f"[{name}]")
    return out


def prompt(system: str, user: str | Column) -> Column:
    """Chat messages as JSON: a system and a user message; a missing text is empty."""
    content = F.coalesce(F.col(user) if isinstance(user, str) else user, F.lit(""))
    return F.to_json(
        F.array(
            F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")),
            F.struct(F.lit("user").alias("role"), content.alias("content")),
        )
    )


REPLY_FIELDS = ("driver_at_fault", "vehicles_involved", "damage_to_each_vehicle")


class Busy(Exception):
    """The endpoint asked to come back later (429 or 5xx)."""


def call_with_retry(
    client: Callable[[str], str], message: str, retries: int = 3, first_wait: float = 1.0, longest: float = 8.0
) -> str:
    """Try up to `retries` times with doubling waits; a final failure is a reply of ERRORs."""
    wait = first_wait
    for attempt in range(1, retries + 1):
        try:
            return client(message)
        except Busy:
            if attempt == retries:
                break
            time.sleep(wait)
            wait = min(wait * 2, longest)
        except Exception:
            break
    return json.dumps(dict.fromkeys(REPLY_FIELDS, "ERROR"))


def map_model(
    df: DataFrame, key: str, text: str, system: str, client: Callable[[str], str], deployment: str,
    allowed: Sequence[str], parallel: int | None = None, first_wait: float = 1.0, out: str = "reply",
) -> DataFrame:
    """One endpoint call per row with text; an empty text gets an empty reply.

    `parallel` bounds the calls in flight. Calls can repeat when a task is retried, so write
    the replies (keyed) before using them.
    """
    if deployment not in allowed:
        raise ValueError(f"deployment {deployment} is not allowed")
    messages = df.select(
        key, F.when(F.coalesce(F.length(text), F.lit(0)) > 0, prompt(system, text)).alias("_message")
    )
    if parallel is not None:
        messages = messages.repartition(parallel)
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            replies = ["" if m is None else call_with_retry(client, m, first_wait=first_wait) for m in pdf["_message"]]
            yield pd.DataFrame({key: pdf[key], out: replies})

    return messages.mapInPandas(run, f"{key} {kind}, {out} string")


REPLY_SCHEMA = (
    "driver_at_fault array<string>, vehicles_involved array<string>, damage_to_each_vehicle array<string>, "
    "_corrupt string"
)


def parse_replies(df: DataFrame, key: str, reply: str) -> DataFrame:
    """One row per vehicle with its damage; a reply that breaks the contract is one bad row."""
    parsed = df.select(
        key,
        F.from_json(reply, REPLY_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("r"),
    )
    zipped = F.arrays_zip(
        F.col("r.vehicles_involved").alias("vehicle"), F.col("r.damage_to_each_vehicle").alias("damage")
    )
    rows = parsed.select(
        key,
        (F.col("r._corrupt").isNotNull() | F.col("r.vehicles_involved").isNull()).alias("bad"),
        F.element_at("r.driver_at_fault", 1).alias("driver"),
        F.posexplode_outer(zipped).alias("pos", "z"),
    )
    return rows.select(key, "bad", "driver", "pos", F.col("z.vehicle").alias("vehicle"), F.col("z.damage").alias("damage"))
