"""Scale properties: hot keys are spread, picks combine map-side, windows
on logs are split by day."""

import datetime as dt
import random

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tablero.operators import (entered, first_per_key, latest_per_key, moved, number_rows, transition_summary,
                               with_previous)

SF = "/root/testdata/sf0.001"


def _hot_log(spark, n=4000, seed=3):
    """Key 0 holds 60% of the rows, spread over 30 days."""
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = [(0 if rnd.random() < 0.6 else rnd.randint(1, 50), i,
             base + dt.timedelta(minutes=rnd.randint(0, 30 * 24 * 60)),
             rnd.choice(["published", "canceled", "in_progress", "pending_approval", "rented"]))
            for i in range(n)]
    return spark.createDataFrame(rows, "k int, id int, ts timestamp_ntz, s string")


def test_hot_key_is_spread_over_tasks_by_the_day_bucket(spark):
    log = _hot_log(spark)
    plain = with_previous(log, "k", ["ts"], ["s"], tie_break=["id"])
    split = with_previous(log, "k", ["ts"], ["s"], tie_break=["id"], bucket=F.to_date("ts"))

    def tasks_holding_hot_key(df):
        # The partition id is taken before filtering (a filter is not pushed
        # below a nondeterministic column), so it is the window's partition.
        # The final aggregate reads the LAG column, so the window is not pruned.
        tagged = df.select("k", "previous_s", F.spark_partition_id().alias("p"))
        per_task = tagged.filter(F.col("k") == 0).groupBy("p").agg(F.count("previous_s").alias("n"))
        return per_task.filter(F.col("n") > 0).count()

    # AQE would merge this small test's shuffle partitions into one
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert tasks_holding_hot_key(plain) == 1
        assert tasks_holding_hot_key(split) >= 6
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_picks_combine_map_side(spark):
    log = _hot_log(spark)
    for df in (latest_per_key(log, "k", ["ts"], tie_break=["id"]), first_per_key(log, "k", ["ts"], tie_break=["id"])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "partial_max_by" in plan or "partial_min_by" in plan


def test_transition_summary_equals_separate_picks(spark):
    log = with_previous(_hot_log(spark), "k", ["ts"], ["s"], tie_break=["id"])
    pub = entered("s", "previous_s", ["published"])
    pend = moved("s", "previous_s", ["in_progress"], ["pending_approval"])
    summary = {r.k: (r.first_pub_id, r.last_pub_id, r.pend_ts) for r in transition_summary(
        log, "k", ["ts"], tie_break=["id"], specs={"first_pub": (pub, "first", ["id"]),
                                                   "last_pub": (pub, "last", ["id"]),
                                                   "pend": (pend, "last", ["ts"])}).collect()}
    first = {r.k: r.id for r in first_per_key(log.filter(pub), "k", ["ts"], tie_break=["id"], columns=["id"]).collect()}
    last = {r.k: r.id for r in latest_per_key(log.filter(pub), "k", ["ts"], tie_break=["id"], columns=["id"]).collect()}
    pending = {r.k: r.ts for r in latest_per_key(log.filter(pend), "k", ["ts"], tie_break=["id"],
                                                 columns=["ts"]).collect()}
    assert summary == {k: (first.get(k), last.get(k), pending.get(k)) for k in summary}


def test_log_windows_are_split_by_day(spark):
    for name in ("prev_state", "home_history", "report_homes"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        for line in plan.splitlines():
            if "Window [" in line and "_wp_" in line and "lag(" in line:
                spec = line.split("windowspecdefinition(")[1]
                assert "_wp_bn0" in spec and "_wp_bv0" in spec, f"{name}: {line[:200]}"


def test_rows_without_an_order_value_are_shared(spark):
    """A third of the order values is NULL: ranges of the id split them, and the rank is the plain one."""
    d = spark.range(9000).select(F.col("id"), F.when(F.col("id") % 3 > 0, F.col("id") % 50).alias("v"))
    bucket = [F.floor(F.col("v") / 10), F.when(F.col("v").isNull(), F.floor(F.col("id") / 1000))]
    got = number_rows(d, [], ["v"], tie_break=["id"], name="n", bucket=bucket, descending=True)
    want = {r.id: n for n, r in enumerate(sorted(d.collect(), key=lambda r: (r.v is None, r.v or 0, r.id), reverse=True), 1)}
    assert {r.id: r.n for r in got.collect()} == want
    tasks = {r.p for r in got.filter("v is null").select(F.spark_partition_id().alias("p")).collect()}
    assert len(tasks) >= 4
