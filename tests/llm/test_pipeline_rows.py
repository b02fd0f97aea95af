"""The pipeline's stages on nulls, repeated ids, clashing columns and empty tables."""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyfold.llm import packing

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
KEPT = 10**9


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage keeps of the documents and odd rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(COLUMNS)
    clean = docs.filter("lang = 'en' AND n_chars BETWEEN 400 AND 3000").orderBy("doc_id").limit(40).collect()
    # New texts of the words of two documents, so that they are near copies of neither.
    pair = [r["text"].split() for r in clean if "\n" not in r["text"]][:2]
    mixed = [" ".join(w for k in range(0, 60, 6) for part in order for w in part[k : k + 3]) for order in (pair, pair[::-1])]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy(F.desc(F.length("text"))).first()["text"]
    odd = [
        (None, mixed[0], None, None, None),
        (KEPT, mixed[1], "en", None, 7),
        (KEPT, mixed[1], "en", None, 7),
        (KEPT + 1, None, "en", "s", 0),
        (KEPT + 2, "", None, "s", 0),
        (KEPT + 3, "12 34 ?! 56", "de", "s", None),
        (KEPT + 4, mixed[0] + " " + item, None, None, None),
        (KEPT + 5, item, "xx", "s", 1),
    ]
    rows = docs.unionByName(spark.createDataFrame(odd, docs.schema)).withColumn("row", F.lit("clash")).withColumn("key", F.lit(1))
    held = {"documents": rows}
    for name, stage in corpus_pipeline.STAGES:
        rows = corpus_pipeline.cut_lineage(stage(spark, rows, SF))
        held[name] = rows
    return held


def test_odd_rows_go_through_all_stages(stages):
    ids = {name: [r[0] for r in df.select("doc_id").collect()] for name, df in stages.items()}
    assert all(stages[name].columns == COLUMNS for name in ("language_id", "line_dedup", "near_dedup", "decontaminate"))
    assert not {KEPT + 1, KEPT + 2, KEPT + 3} & set(ids["language_id"])
    assert ids["language_id"].count(None) == 1 and ids["language_id"].count(KEPT) == 2
    assert sorted(ids["line_dedup"], key=str) == sorted(ids["language_id"], key=str)
    assert {None, KEPT} <= set(ids["near_dedup"])
    assert not {KEPT + 4, KEPT + 5} & set(ids["decontaminate"]) and {None, KEPT} <= set(ids["decontaminate"])
    assert set(ids["pack"]) == set(ids["decontaminate"])


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_empty_tables(spark, name):
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    out = dict(corpus_pipeline.STAGES)[name](spark, empty, SF)
    assert out.count() == 0
    assert name == "pack" or out.columns == COLUMNS


def test_packing_hands_its_memory_back_at_the_end_of_a_task(monkeypatch):
    """Workers are used again by the next stage, which must not find the last shard's arrays still held."""
    calls = []
    monkeypatch.setattr(packing.kernel, "release", lambda: calls.append("released"))
    ids = [np.array([5, 6, 2], dtype="<u2").tobytes(), np.array([2], dtype="<u2").tobytes()]
    columns = {"row_key": [1, 2], "n_tokens": [3, 1], "ids": ids, "sketch": [0, 0], "tie": [1, 2], "shard": [0, 0]}
    shared = SimpleNamespace(value=(np.ones(8), 2.0))
    for made in packing._packed(iter([pa.RecordBatch.from_pydict(columns)]), shared, 4096, True):
        calls.append(made.num_rows)
    assert calls == ["released", 2, "released"]
