"""Shapes of the plans with broadcasts off: what the reports cost when no side is small."""

import re

import pytest

from tablero.plans.standins import REGISTRY

SF = "/root/testdata/sf0.001"

#: (hash exchanges, scans of events, scans of lineitem) at most.
CEILINGS = {"report_homes": (41, 3, 3), "report_payments": (20, 0, 12), "report_active_rents": (34, 0, 9), "report_rents": (27, 0, 1),
            "report_applications": (23, 0, 1), "prev_state": (2, 1, 0), "home_history": (4, 1, 0), "reactivation_gap": (2, 0, 0),
            "carried_publication": (2, 1, 0), "join_key_ts": (6, 0, 0), "hierarchy_rollup": (11, 0, 3)}


@pytest.fixture
def plan_of(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield lambda name: REGISTRY[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


@pytest.mark.parametrize("name", sorted(CEILINGS))
def test_exchanges_and_scans(plan_of, name):
    plan = plan_of(name)
    found = (len(re.findall("Exchange hashpartitioning", plan)), *(len(re.findall(rf"FileScan parquet.*{t}\.parquet", plan)) for t in ("events", "lineitem")))
    assert all(f <= c for f, c in zip(found, CEILINGS[name])), found


@pytest.mark.parametrize("name", ["sort_desc_nulls", "sort_expression", "sort_multi_case"])
def test_single_partition_windows_take_totals(plan_of, name):
    """The one task sees totals per leading bucket, never rows: an aggregate stands right below its exchange."""
    lines = plan_of(name).splitlines()
    single = [i for i, x in enumerate(lines) if "Exchange SinglePartition" in x]
    assert len(single) == 1 and "HashAggregate(keys=[_nr_bn0" in lines[single[0] + 1]


def test_null_keys_are_dropped_below_the_window(plan_of):
    lines = plan_of("report_homes").splitlines()
    log = [i for i, x in enumerate(lines) if "FileScan" in x and "events.parquet" in x and "event_type" in x and "value" in x]
    assert log and any("isnotnull" in x and "user_id" in x for i in log for x in lines[i - 2:i + 1])


@pytest.mark.parametrize("name,table", [("homes", "mongo_home_logs"), ("homes", "mongo_home_logs_previous_values_price"),
                                        ("payments", "mongo_rental_month_dispersions"), ("payments", "mongo_payment_reference_requests")])
def test_shared_parts_of_a_report_are_read_once(spark, name, table):
    """One read of the log, the prices, the dispersions and the references, whatever the engine then reuses."""
    from fixtures import make_tables
    from tablero.plans.reports import report
    from tablero.sources import from_frames
    tables = make_tables(spark, {})
    tables[table].createOrReplaceTempView("read_once")
    frames = from_frames({**tables, table: spark.table("read_once")})
    plan = report(name, frames, "2024-01-01 00:00:00")._jdf.queryExecution().analyzed().toString()
    assert len(re.findall("SubqueryAlias read_once", plan)) == 1


@pytest.mark.parametrize("name,most", [("report_rents", 7), ("report_active_rents", 5)])
def test_rents_are_shuffled_once_for_each_of_their_keys(spark, name, most):
    """What hangs on a home, a user, a fee or an application is joined there, not to the rents."""
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    kept = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        plan = REGISTRY[name](spark, SF)._jdf.queryExecution().executedPlan()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)

    def walk(node):
        below = node.children()
        own = node.nodeName() == "Exchange" and "hashpartitioning" in node.simpleString(100) and "rent_price#" in node.output().mkString(",")
        return own + sum(walk(below.apply(i)) for i in range(below.size()))
    assert walk(plan) <= most


@pytest.mark.parametrize("name,frames", [
    ("payments", {"mongo_rents": [dict(_id="R1")], "mongo_rental_months": [dict(_id=f"M{i}", rent_id="R1", _status="paid") for i in range(600)]}),
    ("contracts", {"mongo_rents": [dict(_id=f"R{i}") for i in range(600)], "mongo_rent_contracts": [dict(_id=f"C{i}", rent_id=f"R{i}") for i in range(600)]})])
def test_rows_without_a_date_or_a_parent_are_dealt_over_tasks(spark, name, frames):
    from fixtures import make_tables
    from pyspark.sql import functions as F
    from tablero.plans.reports import report
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    kept = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        out = report(name, make_tables(spark, frames), "2024-01-01 00:00:00")
        parts = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert sum(parts) == 600 and max(parts) <= 300
