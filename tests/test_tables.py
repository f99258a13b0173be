"""Replacing stored tables in one step; bounded files; measured broadcasts; buckets."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from claimlens import sinks, sources, tables
from claimlens.operators import common
from claimlens.operators import sampling as sa


def _values(df):
    return sorted(r.id for r in df.collect())


def test_a_failed_job_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(5), path)

    def fail(batches):
        for i, b in enumerate(batches):
            yield b
            raise ValueError("midway")

    with pytest.raises(Exception, match="midway"):
        sinks.write_table(spark.range(1000).repartition(3).mapInArrow(fail, "id bigint"), path)
    assert _values(sources.read_table(spark, path)) == list(range(5))
    sinks.write_table(spark.range(7), path)     # and the next write works
    assert _values(sources.read_table(spark, path)) == list(range(7))


def test_a_version_without_its_marker_is_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(3), path)
    spark.range(9).write.parquet(f"{path}/_v00000099-dead")
    assert _values(sources.read_table(spark, path)) == [0, 1, 2]
    sinks.write_table(spark.range(4), path)
    assert _values(sources.read_table(spark, path)) == [0, 1, 2, 3]


def test_a_query_may_replace_the_table_it_reads(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(10), path)
    first = sources.read_table(spark, path)
    sinks.write_table(first.where("id % 2 = 0"), path)
    second = sources.read_table(spark, path)
    assert _values(second) == [0, 2, 4, 6, 8]
    assert _values(first) == list(range(10))        # the version before is kept
    sinks.write_table(second.where("id > 4"), path)
    assert _values(sources.read_table(spark, path)) == [6, 8]
    assert len(glob.glob(f"{path}/_v*")) == 2


def test_plain_files_are_replaced_and_appended_to(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    assert tables.current(spark, path) == path
    sinks.write_table(sources.read_table(spark, path).where("id < 2"), path)
    assert _values(sources.read_table(spark, path)) == [0, 1]
    sinks.write_table(spark.range(50, 51), path, mode="append")
    assert _values(sources.read_table(spark, path)) == [0, 1, 50]
    for n in (1, 2):
        sinks.write_table(spark.range(n), path)
    assert not glob.glob(f"{path}/*.parquet") and _values(sources.read_table(spark, path)) == [0, 1]


def test_files_go_with_bytes_not_with_tasks(spark, tmp_path):
    """40 tasks and 12 cells; one cell holds most rows."""
    df = spark.range(60_000).select(
        F.md5(F.col("id").cast("string")).alias("x"),
        F.when(F.col("id") % 10 > 0, 0).otherwise(F.col("id") % 120 / 10).cast("int").alias("cluster"),
        F.lit(0).alias("label")).repartition(40)
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "400k")
    try:
        path = str(tmp_path / "cells")
        sinks.write_partitioned(df, path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = {d: len(glob.glob(f"{path}/{d}/label=0/*.parquet")) for d in os.listdir(path) if d.startswith("cluster=")}
    assert len(files) == 12 and sum(files.values()) <= 40       # 480 would be tasks times cells
    assert files["cluster=0"] > 3                               # the hot cell is still dealt out
    assert spark.read.parquet(path).count() == 60_000


def test_wide_texts_are_not_broadcast(spark, monkeypatch):
    wide = spark.range(6).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 1 << 20).alias("text"))
    big = spark.range(100).selectExpr("id % 6 AS k", "id")
    monkeypatch.setattr(common, "MAX_BROADCAST_BYTES", 4 << 20)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = common.join_small(big, wide, "k")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        plan = common.join_small(big, wide.limit(2), "k")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan
        nested = wide.select("k", F.array("text").alias("a"))
        assert "broadcast" not in common.broadcast_checked(nested)._jdf.queryExecution().toString().lower()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sets_of_bucketed_tables_do_not_shuffle(spark):
    """With broadcasts off, neither the features nor the clusters are exchanged."""
    feats = spark.createDataFrame([(f"p{i}", int(i % 9 == 0), i) for i in range(300)], "id string, review int, x int")
    clustered = spark.createDataFrame([(f"p{i}", i % 2, int(i % 9 == 0)) for i in range(0, 300, 2)] + [("p2", 0, 0)],
                                      "patient_id string, cluster int, label int")
    f = common.store_bucketed(feats, "id", 4, "f")
    c = common.store_bucketed(clustered, "patient_id", 4, "c", ("cluster", "label"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scoring = sa.scoring_set(f, c, 0, max_broadcast_rows=0)
        plan = scoring._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert sorted(r.id for r in scoring.collect()) == sorted(
            r.id for r in sa.scoring_set(feats, clustered, 0).collect())
        train = sorted(r.id for r in sa.training_set(f, c, 0, 50, 3, max_broadcast_rows=0).collect())
        assert train == sorted(r.id for r in sa.training_set(feats, clustered, 0, 50, 3).collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
