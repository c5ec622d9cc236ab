"""Operators that carry, spread, multiply and double, each against plain code."""

import datetime as dt
import random
from collections import Counter, defaultdict
from itertools import product

import pytest
from pyspark.sql import functions as F

from tablero.operators import (entered, hot_keys, list_join, lookup, rollup_ancestors, slot_join, slot_product, spread_join,
                               with_last_match, with_previous)
from tablero.sources import Staging


def same(a, b) -> bool:
    return Counter(tuple(r) for r in a.collect()) == Counter(tuple(r) for r in b.collect())


def log_rows(n=2500, seed=9):
    """Key 0 holds a third of the rows; NULL keys, NULL and tied times; buckets of one row and buckets that start with a match."""
    rng, base = random.Random(seed), dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        r = rng.random()
        key = 0 if r < 0.34 else None if r < 0.4 else rng.randint(1, 60)
        at = None if rng.random() < 0.03 else base + dt.timedelta(hours=rng.randint(0, 24 * 80))
        rows.append((key, i, at, rng.choice(["a", "b", "b", "c", None]), rng.choice([None, 1.5, i / 2])))
    return rows


@pytest.mark.parametrize("bucket", [None, "day", "month", "two"])
def test_last_match_equals_a_walk_over_the_log(spark, bucket):
    rows = log_rows()
    log = spark.createDataFrame(rows, "k int, id int, `the at` timestamp_ntz, s string, v double")
    at = F.col("the at")
    by = {None: None, "day": F.to_date(at), "month": F.trunc(at, "month"), "two": [F.trunc(at, "month"), F.to_date(at)]}[bucket]
    got = with_last_match(log, "k", ["the at"], "s", lambda s, p: entered(s, p, ["b"]), ["the at", "v"], previous=["v"],
                          tie_break=["id"], bucket=by, name="is b", match_prefix="last ")
    assert got.columns == [*log.columns, "previous_s", "previous_v", "is b", "last the at", "last v"]
    per = defaultdict(list)
    for r in rows:
        per[r[0]].append(r)
    want = Counter()
    for group in per.values():
        before, last = (None,) * 5, (None, None)
        for r in sorted(group, key=lambda r: (r[2] is None, r[2] or dt.datetime.min, r[1])):
            match = r[3] == "b" and (before[3] is None or before[3] != "b")
            want[(*r, before[3], before[4], match, *(last if match else (None, None)))] += 1
            before, last = r, ((r[2], r[4]) if match else last)
    assert Counter(tuple(r) for r in got.collect()) == want
    lagged = with_previous(log, "k", ["the at"], ["s"], tie_break=["id"], bucket=by)
    assert same(got.select("id", "previous_s"), lagged.select("id", "previous_s"))


def test_last_match_is_one_pass(spark):
    """One read of the log and two shuffles of it, by (key, bucket) and for the bucket edges."""
    log = spark.range(1000).selectExpr("id % 7 AS k", "id", "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(id % 50) AS at", "string(id % 3) AS s")
    df = with_last_match(log, "k", ["at"], "s", lambda s, p: s == "1", ["at"], tie_break=["id"], bucket=F.to_date("at"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Range (") == 1 and "Join" not in plan


def test_slot_product_equals_successive_joins(spark):
    rng = random.Random(1)
    roles = ["a", "b", "c", "d", None]
    rows = [(rng.choice([None, *range(40)]), rng.choice(roles), rng.choice([None, 1, 2, 3]), rng.choice("xyz")) for _ in range(160)]
    rows += [(99, "a", i, "h") for i in range(30)] + [(99, "b", i, "h") for i in range(5)]
    df = spark.createDataFrame(rows, "k int, role string, amount int, mail string")
    left = spark.createDataFrame([(k,) for k in [*range(45), 99, None, 3]], "id int")
    role = F.col("role")
    slots = {"one": role == "a", "two": role == "b", "rest": ~role.isin("a", "b")}
    want = left
    for name, cond in slots.items():
        want = slot_join(want, "id", df, "k", cond, {f"{name}_amount": "amount", f"{name}_mail": "mail"})
    folded = slot_product(df, "k", slots, ["amount", "mail"])
    assert same(left.join(folded, F.col("k") == F.col("id"), "left").drop("k"), want)
    plan = folded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Scan ExistingRDD") == 1


def keyed(spark, n=9000):
    """A third of the keys NULL, a third one value."""
    return spark.range(n).select("id", F.when(F.col("id") % 3 == 1, 7).when(F.col("id") % 3 == 2, F.col("id") % 500).cast("int").alias("fk"))


@pytest.mark.parametrize("hot", [False, True])
def test_spread_join_equals_the_plain_join(spark, hot):
    facts = keyed(spark, 900)
    dims = spark.createDataFrame([(i, f"n{i}") for i in range(0, 400, 2)] + [(7, "first"), (7, "second"), (None, "none")], "k int, name string")
    more = spark.createDataFrame([(7, 1.0), (4, 2.0)], "k2 int, w double")
    many = hot_keys(facts, "fk", 100) if hot else None
    if hot:
        assert [r.hot_key for r in many.collect()] == [7]
    got = spread_join(facts, "fk", [(dims, "k"), (more, "k2")], salts=5, hot=many, spread_by=["id"])
    want = facts.join(dims, F.col("fk") == F.col("k"), "left").join(more, F.col("fk") == F.col("k2"), "left")
    assert got.columns == want.columns and same(got, want)
    plain = lookup(facts, dims, "fk", "k", {"label": "name"})
    assert same(lookup(facts, dims, "fk", "k", {"label": "name"}, salts=4, hot=many), plain)
    with pytest.raises(ValueError):
        lookup(facts, dims, "fk", "k", {"label": "name"}, how="inner", salts=4)


def test_null_and_hot_keys_make_even_tasks(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    kept = {k: spark.conf.get(k) for k in conf}
    facts, dims = keyed(spark), spark.range(500).selectExpr("int(id) AS k", "id AS name")

    def largest(df):
        sizes = [r["count"] for r in df.select(F.spark_partition_id().alias("p"), "name").groupBy("p").count().collect()]
        return max(sizes) / sum(sizes), len(sizes)
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        many = hot_keys(facts, "fk", 1000)
        plain, _ = largest(lookup(facts, dims, "fk", "k", {"name": "name"}))
        spread, tasks = largest(lookup(facts, dims, "fk", "k", {"name": "name"}, salts=64, hot=many, spread_by=["id"]))
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert plain > 0.35 and spread < 0.2 and tasks == 8


def ancestors(parents, values, key):
    total, seen, at = values.get(key) or 0, {key}, parents.get(key)
    while at is not None:
        if at in seen:
            return None
        seen.add(at)
        total, at = total + (values.get(at) or 0), parents.get(at)
    return total


def test_all_ancestors_equal_a_walk(spark):
    rng = random.Random(6)
    parents = {i: (rng.randrange(i) if rng.random() < 0.9 else None) for i in range(1, 200)}
    parents |= {i: i - 1 for i in range(1001, 1300)}                      # a chain of 300
    parents |= {2000: 2001, 2001: 2002, 2002: 2000, 2003: 2002, 2004: 2004}  # cycles, and a way into one
    values = {i: (None if rng.random() < 0.1 else i % 11) for i in [*range(200), *range(1000, 1300), *range(2000, 2006)]}
    tree = spark.createDataFrame(list(parents.items()), "node int, parent int")
    vals = spark.createDataFrame(list(values.items()), "k int, v int")
    got = rollup_ancestors(vals, "k", "v", tree, "node", "parent", depth=None, cut=Staging(spark, "t").cut).collect()
    assert {r.k: (None if r.v is None else int(r.v)) for r in got} == {k: ancestors(parents, values, k) for k in values}
    empty = rollup_ancestors(vals, "k", "v", tree.limit(0), "node", "parent", depth=None, cut=Staging(spark, "t").cut).collect()
    assert {r.k: r.v for r in empty} == {k: v or 0 for k, v in values.items()}


def test_bucketed_list_equals_the_plain_one(spark):
    """One key holds half the rows; no sorted array holds more than a bucket of it."""
    rng = random.Random(2)
    rows = [(0 if i % 2 else rng.randrange(30), None if rng.random() < 0.05 else i, rng.choice(["p", "q", None, "r" * 5])) for i in range(4000)]
    df = spark.createDataFrame(rows, "k int, n int, item string")
    plain = list_join(df, "k", "item", order_by=["n", "item"], sep=" / ", name="x")
    split = list_join(df, "k", "item", order_by=["n", "item"], sep=" / ", name="x", bucket=F.floor(F.col("n") / 50))
    two = list_join(df, "k", "item", order_by=["n", "item"], sep=" / ", name="x",
                    bucket=[F.floor(F.col("n") / 1000), F.floor(F.col("n") / 50)])
    assert same(plain, split) and same(plain, two)
    none = list_join(df.filter("item is null"), "k", "item", name="x", bucket=F.col("n")).collect()
    assert none and all(r.x is None for r in none)


def test_products_of_digits_cover_every_combination(spark):
    """Three, two and one rows: six places, each combination once."""
    df = spark.createDataFrame([(1, "a", i) for i in range(3)] + [(1, "b", i) for i in range(2)] + [(1, "c", 0)], "k int, r string, v int")
    got = slot_product(df, "k", {x: F.col("r") == x for x in "abcd"}, ["v"]).collect()
    assert Counter((r.a_v, r.b_v, r.c_v, r.d_v) for r in got) == Counter(product(range(3), range(2), [0], [None]))
