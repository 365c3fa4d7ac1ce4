"""Each stage of the pipeline on its own input."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerpulse.llm import pieces
from ledgerpulse.sources import workspace
from ledgerpulse.sources.workspace import materialize


def test_stages_follow_each_other(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(materialize(stage(spark, seen[-1], tables), "stage"))
    start, clean, lined, single, mixed, coded = seen
    assert all(df.columns == docs.columns for df in seen[:-1])
    labels = spark.read.parquet(f"{tables}/labels.parquet")
    gone = start.join(clean, "doc_id", "left_anti").join(labels, "doc_id")
    assert gone.filter("toxic = 0").count() <= 1
    assert lined.count() == clean.count() and lined.filter("length(text) <> n_chars").count() == 0
    assert 0 < single.count() <= lined.count() and single.join(lined, docs.columns, "left_anti").count() == 0
    assert mixed.join(single, docs.columns, "left_anti").count() == 0
    restored = pieces.decode(coded).select("doc_id", "decoded").distinct()
    texts = mixed.select("doc_id", mixed.text.alias("decoded")).distinct()
    assert restored.exceptAll(texts).isEmpty() and texts.exceptAll(restored).isEmpty()


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_a_stage_takes_odd_rows_and_an_empty_table(spark, tables, docs, none, name, stage):
    odd = materialize(docs.filter("length(text) < 9000 OR text IS NULL"))
    out = materialize(stage(spark, odd, tables))
    if name != "piece ids":
        assert out.columns == odd.columns
        assert out.dtypes == odd.dtypes
    if name in ("toxicity", "line dedup"):
        assert out.filter("text IS NULL").count() == odd.filter("text IS NULL").count()
    if name != "source mixture":
        assert out.count() <= odd.count()
    if name == "line dedup":
        # Rows that repeat an id and a text stay, with the same lines.
        assert out.count() == odd.count()
        assert out.filter("doc_id = 12").select("text").distinct().count() == 1
    if name == "near duplicates":
        assert out.filter(F.col("text").startswith("w")).count() < odd.filter(F.col("text").startswith("w")).count()
    assert stage(spark, none, tables).count() == 0


def test_what_a_stage_stored_goes_with_the_next_one(spark):
    rows = spark.range(5)
    with workspace.owner("test"):
        a, b = materialize(rows, "a"), materialize(rows, "b")
    outside = materialize(rows, "c")
    paths = {df: df.__dict__["stored_at"] for df in (a, b, outside)}
    assert workspace.release(spark, "test", b) == 1
    assert not os.path.exists(paths[a]) and b.count() == outside.count() == 5
    assert workspace.release(spark, "test") == 1 and not os.path.exists(paths[b])
    workspace.drop_stored(outside)
    assert not os.path.exists(paths[outside])
