"""Catalog namespaces with month partitions, written results, positions."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from tablero.plans.standins import REGISTRY
from tablero.sources import (Staging, from_catalog, publish, receipt, replace_result, with_position, within)

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_months_of_both_namespaces_are_pruned_by_a_range(spark):
    df = REGISTRY["catalog_months"](spark, SF)
    plan = plan_of(df)
    scans = {m[1]: m[2] for m in re.finditer(r"FileScan parquet spark_catalog\.(\S+?)\[.*?PartitionFilters: \[(.*?), PushedFilters", plan)}
    assert {name.rsplit(".")[-1] for name in scans} == {"rents", "listings"}
    for name, filters in scans.items():
        month = "created_at_month" if name.endswith("rents") else "date_in_month"
        assert month in filters and ">= 199" in filters  # the plan's text is cut after some characters
    files = {re.search(r"(\w+_month)=([^/]+)", f).groups() for f in spark.table(next(n for n in scans if n.endswith("listings")))
             .filter(within("date_in", "1995-04-05 00:00:00", "1995-07-15 12:00:00")).inputFiles()}
    assert {m for _, m in files} <= {"1995-04-01", "1995-05-01", "1995-06-01", "1995-07-01"}


def test_months_are_pruned_by_the_rows_of_another_table(spark):
    df = REGISTRY["catalog_quarter"](spark, SF)
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", plan_of(df))
    df.collect()
    scan = [m for m in re.findall(r"number of partitions read: ([\d,]+)", df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))]
    assert not scan or int(scan[0].replace(",", "")) <= 3


def test_publish_and_resolve(spark, tmp_path):
    times = [dt.datetime(2024, 1, 31, 23), dt.datetime(2024, 2, 1), None, dt.datetime(2024, 2, 29, 12), dt.datetime(2024, 3, 1)]
    log = spark.createDataFrame(list(enumerate(times)), "id int, at timestamp_ntz")
    plain = spark.createDataFrame([(1, "x")], "id int, name string")
    where = {"web": "t_publish_web"}
    for _ in range(2):  # a second run replaces the first
        publish({"log": log, "web.plain": plain}, str(tmp_path / "w"), "t_publish", where, months={"log": "at"})
    t = from_catalog(spark, ["log", "web.plain"], "t_publish", where)
    assert sorted(r.id for r in t["log"].collect()) == [0, 1, 2, 3, 4]
    assert t["web.plain"].collect() == plain.collect()
    got = t["log"].filter(within("at", "2024-01-31 23:00:00", "2024-03-01 00:00:00"))
    assert sorted(r.id for r in got.collect()) == [0, 1, 3]
    with pytest.raises(KeyError):
        t["other"]


def test_a_rerun_replaces_its_partitions_and_a_failed_run_none(spark, tmp_path):
    path = str(tmp_path / "result")
    first = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, None, 3.0), (3, None, 3.0)], "id int, part string, v double")
    told = replace_result(first, path, ["part"])
    back = spark.read.schema(first.schema).parquet(path)
    assert (told.rows, receipt(back.select(*first.columns))) == (4, told)
    second = spark.createDataFrame([(9, "b", 9.0), (10, "c", None)], first.schema)
    for _ in range(2):
        replace_result(second, path, ["part"])
        rows = sorted(map(tuple, spark.read.schema(first.schema).parquet(path).select(*first.columns).collect()), key=repr)
        assert rows == sorted([(1, "a", 1.0), (3, None, 3.0), (3, None, 3.0), (9, "b", 9.0), (10, "c", None)], key=repr)
    broken = second.withColumn("v", F.expr("CASE WHEN id = 10 THEN raise_error('no') ELSE v END").cast("double"))
    with pytest.raises(Exception, match="no"):
        replace_result(broken, path, ["part"])
    assert spark.read.parquet(path).count() == 5
    assert [f.name for f in tmp_path.iterdir()] == ["result"]  # nothing staged is left


def test_an_unpartitioned_result_is_swapped_whole(spark, tmp_path):
    path = str(tmp_path / "result")
    a, b = spark.range(10).toDF("id"), spark.range(5, 25).toDF("id")
    assert replace_result(a, path).rows == 10
    assert replace_result(b, path) == receipt(spark.read.parquet(path))
    with pytest.raises(Exception, match="no"):
        replace_result(a.withColumn("id", F.expr("IF(id = 9, raise_error('no'), id)").cast("long")), path)
    assert spark.read.parquet(path).count() == 20
    assert replace_result(a.limit(0), path) == receipt(spark.read.parquet(path))
    assert [f.name for f in tmp_path.iterdir()] == ["result"]


def test_positions_are_those_of_the_sort(spark):
    """A third of the sort values is NULL and a third one value: their rows still come from several ranges."""
    rng = random.Random(4)
    rows = [(i, None if i % 3 == 0 else 7 if i % 3 == 1 else rng.randrange(100)) for i in range(6000)]
    df = spark.createDataFrame(rows, "`row id` int, v int").repartition(5)
    path = Staging(spark, "positions").root
    got = with_position(df, [F.col("v").desc_nulls_first(), F.col("row id")], path).collect()
    want = sorted(rows, key=lambda r: (r[1] is not None, -(r[1] or 0), r[0]))
    assert [(r["row id"], r.v) for r in sorted(got, key=lambda r: r.position)] == want
    assert [r.position for r in sorted(got, key=lambda r: r.position)] == list(range(1, 6001))
    plan = plan_of(with_position(df, [F.col("v")], Staging(spark, "positions").root))
    assert "Window" not in plan and "SinglePartition" not in plan
    assert with_position(df.limit(0), [F.col("v")], Staging(spark, "positions").root).count() == 0


def test_bloom_filter_drops_non_members_at_the_scan(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    kept = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        lines = plan_of(REGISTRY["join_semi_membership"](spark, SF)).splitlines()
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    exchange = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning(c_custkey" in x)
    below = lines[exchange + 1:exchange + 4]
    assert any("might_contain" in x for x in below), below
