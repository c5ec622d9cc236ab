import datetime as dt
import random
from collections import Counter

from pyspark.sql import Window
from pyspark.sql import functions as F

from tablero.operators import (any_one_per_key, count_when, duplicate_keys, first_and_last, first_per_key,
                               latest_per_key, list_join, number_rows, population, role_pivot, rollup_ancestors,
                               with_previous)


def same(a, b) -> bool:
    return Counter(tuple(r) for r in a.collect()) == Counter(tuple(r) for r in b.collect())


def _skewed_log(spark, n=3000, seed=7):
    """A log where key 0 holds about a third of the rows, with NULL keys and NULL / tied times."""
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        r = rnd.random()
        k = 0 if r < 0.34 else (None if r < 0.37 else rnd.randint(1, 40))
        ts = None if rnd.random() < 0.02 else base + dt.timedelta(hours=rnd.randint(0, 24 * 60))
        rows.append((k, i, ts, rnd.choice(["a", "b", "c", None])))
    return spark.createDataFrame(rows, "k int, id int, ts timestamp_ntz, s string")


def test_bucketed_previous_equals_plain_window(spark):
    log = _skewed_log(spark)
    plain = with_previous(log, "k", ["ts"], ["s", "ts"], tie_break=["id"])
    split = with_previous(log, "k", ["ts"], ["s", "ts"], tie_break=["id"], bucket=F.to_date("ts"))
    assert same(plain, split)


def test_bucketed_numbering_equals_plain_window(spark):
    log = _skewed_log(spark)
    for desc in (False, True):
        plain = number_rows(log, "k", ["ts"], tie_break=["id"], descending=desc)
        split = number_rows(log, "k", ["ts"], tie_break=["id"], bucket=F.to_date("ts"), descending=desc)
        assert same(plain, split)
    w = Window.partitionBy("k").orderBy(F.col("ts").asc_nulls_last(), "id")
    expected = log.withColumn("row_number", F.row_number().over(w))
    assert same(expected, number_rows(log, "k", ["ts"], tie_break=["id"]))


def test_latest_and_first_match_row_number_with_dialect_nulls(spark):
    log = _skewed_log(spark)
    w_desc = Window.partitionBy("k").orderBy(F.col("ts").desc_nulls_first(), F.col("id").desc())
    w_asc = Window.partitionBy("k").orderBy(F.col("ts").asc_nulls_last(), F.col("id").asc())
    exp_last = log.withColumn("rn", F.row_number().over(w_desc)).filter("rn = 1").drop("rn")
    exp_first = log.withColumn("rn", F.row_number().over(w_asc)).filter("rn = 1").drop("rn")
    got_last = latest_per_key(log, "k", ["ts"], tie_break=["id"]).select(*log.columns)
    got_first = first_per_key(log, "k", ["ts"], tie_break=["id"]).select(*log.columns)
    assert same(exp_last, got_last)
    assert same(exp_first, got_first)
    fl = first_and_last(log, "k", ["ts"], tie_break=["id"], columns=["id"]).collect()
    assert {r.k: (r.first_id, r.last_id) for r in fl} == \
        {r.k: (f.id, r.id) for r in exp_last.collect() for f in exp_first.collect() if f.k == r.k}


def test_latest_per_key_output_is_unique_per_key(spark):
    log = _skewed_log(spark)
    out = latest_per_key(log, "k", ["ts"], tie_break=["id"])
    assert out.count() == out.select("k").distinct().count() == log.select("k").distinct().count()


def test_any_one_is_deterministic(spark):
    df = spark.createDataFrame([(1, "b", "x"), (1, "a", None), (1, "a", "y"), (2, None, "z")],
                               "k int, name string, email string")
    out = {r.k: (r.name, r.email) for r in any_one_per_key(df, "k", columns=["name", "email"]).collect()}
    assert out == {1: ("a", "y"), 2: (None, "z")}


def test_list_join_order_and_nulls(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (1, None, 0), (2, None, 1), (3, "c", None),
                                (3, "d", 5)], "k int, v string, o int")
    by_value = {r.k: r.items for r in list_join(df, "k", "v", sep=" & ").collect()}
    by_order = {r.k: r.items for r in list_join(df, "k", "v", order_by=["o"], sep="/").collect()}
    assert by_value == {1: "a & b", 2: None, 3: "c & d"}
    assert by_order == {1: "a/b", 2: None, 3: "d/c"}   # NULL order sorts last


def test_role_pivot_and_count_when(spark):
    df = spark.createDataFrame([(1, "owner", 10), (1, "advisor", 5), (2, "other", 7)], "k int, role string, v int")
    r = role_pivot(df, "k", "role", {"owner": "owner", "advisor": "advisor",
                                     "rest": ~F.col("role").isin("owner", "advisor")}, ["v"])
    assert sorted(r.collect()) == [(1, 10, 5, None), (2, None, None, 7)]
    c = count_when(df, "k", {"owners": F.col("role") == "owner"}).collect()
    assert sorted((x.k, x.n, x.owners) for x in c) == [(1, 2, 1), (2, 1, 0)]


def test_rollup_ancestors_two_levels(spark):
    values = spark.createDataFrame([("a", 1), ("b", 10), ("c", 100), ("d", None)], "k string, v int")
    tree = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("d", "x")], "id string, parent string")
    out = dict(rollup_ancestors(values, "k", "v", tree, "id", "parent", depth=2).collect())
    assert out == {"a": 1, "b": 11, "c": 111, "d": 0}


def test_population_and_duplicates(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "u int")
    b = spark.createDataFrame([(2,), (3,)], "user_id int")
    assert sorted(population((a, "u"), (b, "user_id"), name="id").collect(), key=str) == \
        sorted([(1,), (2,), (3,), (None,)], key=str)
    dups = duplicate_keys(spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "k int, v string"), "k")
    assert sorted(r.v for r in dups.collect()) == ["x", "y"]


def test_multi_column_buckets_equal_plain_window(spark):
    log = _skewed_log(spark)
    buckets = [F.to_date("ts"), F.hour("ts")]
    assert same(number_rows(log, "k", ["ts"], tie_break=["id"]),
                number_rows(log, "k", ["ts"], tie_break=["id"], bucket=buckets))
    assert same(with_previous(log, "k", ["ts"], ["s"], tie_break=["id"]),
                with_previous(log, "k", ["ts"], ["s"], tie_break=["id"], bucket=buckets))


def test_operators_take_column_names_literally(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "`home.id` int, `t s` int, `st.x` string")
    last = latest_per_key(df, "home.id", ["t s"])
    assert sorted(tuple(r) for r in last.collect()) == [(1, 2, "b"), (2, 1, "c")]
    prev = with_previous(df, "home.id", ["t s"], ["st.x"], bucket=F.col("`t s`"))
    assert sorted(tuple(r) for r in prev.collect()) == [(1, 1, "a", None), (1, 2, "b", "a"), (2, 1, "c", None)]
    numbered = number_rows(df, "home.id", ["t s"], bucket=F.col("`t s`"))
    assert sorted(tuple(r) for r in numbered.collect()) == [(1, 1, "a", 1), (1, 2, "b", 2), (2, 1, "c", 1)]
