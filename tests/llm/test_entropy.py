"""Sliding-window entropy: exact, linear in the length, and safe on long joined words."""

from __future__ import annotations

import collections
import math
import random
import string
import time

from pyspark.sql import functions as F

from tallyfold.llm import secrets


def brute(value, width=20):
    best = 0.0
    for i in range(len(value) - width + 1):
        counts = collections.Counter(value[i : i + width]).values()
        best = max(best, -sum(n / width * math.log2(n / width) for n in counts))
    return best


def test_window_entropy_is_exact(spark):
    draw = random.Random(1)
    values = ["".join(draw.choices(secrets.ALPHABET[: draw.randint(1, 67)], k=draw.randint(0, 90))) for _ in range(200)]
    got = spark.createDataFrame([(v,) for v in values], "v string").select("v", secrets.window_entropy(F.col("v")).alias("e")).collect()
    assert all(abs(r["e"] - brute(r["v"])) < 1e-12 for r in got)


def test_enough_gives_the_same_verdict(spark):
    draw = random.Random(2)
    values = ["".join(draw.choices(secrets.ALPHABET[: draw.randint(5, 40)], k=60)) for _ in range(100)]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = df.select("v", (secrets.window_entropy(F.col("v"), enough=F.lit(3.6)) >= 3.6).alias("strong")).collect()
    assert {r["v"]: r["strong"] for r in got} == {v: brute(v) >= 3.6 for v in values}


def test_a_megabyte_in_one_string(spark):
    """Data URIs and long paths end, in time that does not grow with the square of their length."""
    draw = random.Random(3)
    base64 = "".join(draw.choices(string.ascii_letters + string.digits + "+/", k=1_000_000))
    path = "/".join(draw.choice(["ab", "c1"]) for _ in range(100_000))
    small = spark.createDataFrame([(0, "x")], "doc_id long, text string")
    secrets.find_secrets(small).collect()
    started = time.perf_counter()
    secrets.find_secrets(small).collect()
    idle = time.perf_counter() - started
    started = time.perf_counter()
    rows = spark.createDataFrame([(1, "data:image/png;base64," + base64), (2, path)], "doc_id long, text string")
    out = {r["doc_id"]: r["spans"] for r in secrets.find_secrets(rows).collect()}
    assert time.perf_counter() - started - idle < 20
    assert [(s["start"], s["end"]) for s in out[1]] == [(22, 1_000_022)]
    assert out[2] == []
