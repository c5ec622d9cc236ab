import datetime as dt

from pyspark.sql import functions as F

from tablero.functions import (day_boundaries, full_name, has_bit, initcap_words, is_false, is_true, join_parts,
                               label_map, month_boundaries, month_label, month_start, not_in, parse_month, prefixed,
                               split_part, to_local, year_boundaries, yes_no)


def one(spark, *cols, data=None, schema=None):
    df = spark.createDataFrame(data or [(1,)], schema or "x int")
    return df.select(*cols).collect()


def test_to_local_honours_dst_history(spark):
    rows = one(spark, to_local(F.lit(dt.datetime(2021, 7, 1, 12)).cast("timestamp_ntz")).alias("a"),
               to_local(F.lit(dt.datetime(2023, 7, 1, 12)).cast("timestamp_ntz")).alias("b"))
    assert rows[0].a == dt.datetime(2021, 7, 1, 7)   # UTC-5 with daylight saving
    assert rows[0].b == dt.datetime(2023, 7, 1, 6)   # UTC-6, no daylight saving since late 2022


def test_boundaries_count_crossings_not_elapsed_time(spark):
    r = spark.createDataFrame([(dt.datetime(2020, 12, 31, 23), dt.datetime(2021, 1, 1, 1))],
                              "a timestamp_ntz, b timestamp_ntz").select(
        month_boundaries("a", "b").alias("m"), year_boundaries("a", "b").alias("y"),
        day_boundaries("a", "b").alias("d"), month_boundaries("b", "a").alias("neg")).first()
    assert (r.m, r.y, r.d, r.neg) == (1, 1, 1, -1)


def test_initcap_breaks_at_any_non_alphanumeric(spark):
    df = spark.createDataFrame([("garcia-lopez de la CRUZ",), ("o'brien",), (None,), ("",)], "s string")
    out = [r.c for r in df.select(initcap_words("s").alias("c")).collect()]
    assert out == ["Garcia-Lopez De La Cruz", "O'Brien", None, ""]


def test_full_name_nvl_styles(spark):
    df = spark.createDataFrame([("ana", None, "ruiz")], "a string, b string, c string")
    r = df.select(full_name("a", "b", "c", null_as="").alias("empty"),
                  full_name("a", "b", "c", null_as=" ").alias("space"),
                  join_parts("a", "b", "c").alias("raw")).first()
    assert r.empty == "Ana  Ruiz"
    assert r.space == "Ana   Ruiz"
    assert r.raw is None


def test_prefixed_and_split_part(spark):
    df = spark.createDataFrame([("3", "x. Razón: no fotos: mal"), (None, "sin razón"), (None, None)],
                               "floor string, reason string")
    body = split_part("reason", ". Razón: ", 2)
    rows = df.select(prefixed("Piso ", "floor").alias("p"), split_part(body, ": ", 1).alias("r"),
                     split_part(body, ": ", 2).alias("c")).collect()
    assert [(r.p, r.r, r.c) for r in rows] == [("Piso 3", "no fotos", "mal"), (None, "", ""), (None, None, None)]


def test_parse_month_and_month_start(spark):
    df = spark.createDataFrame([("january", "2020"), ("JULY", "2021"), ("sept", "2021"), (None, "2021")],
                               "m string, y string")
    rows = df.select(parse_month("m", "y").alias("d")).collect()
    assert [r.d for r in rows] == [dt.date(2020, 1, 1), dt.date(2021, 7, 1), None, None]
    assert one(spark, month_start(F.lit(dt.date(2021, 7, 19))).alias("s"))[0].s == dt.date(2021, 7, 1)


def test_month_label(spark):
    df = spark.createDataFrame([("march", "2021"), ("foo", "2021"), (None, "2021"), ("may", None)],
                               "m string, y string")
    assert [r.l for r in df.select(month_label("m", "y").alias("l")).collect()] == \
        ["marzo/2021", "foo/2021", None, None]


def test_truth_tests_and_not_in_three_valued(spark):
    df = spark.createDataFrame([(True, "a"), (False, "b"), (None, None)], "b boolean, s string")
    rows = df.select(is_true("b").alias("t"), is_false("b").alias("f"), not_in("s", ["a"]).alias("n"),
                     yes_no(F.col("b")).alias("y")).collect()
    assert [(r.t, r.f, r.n, r.y) for r in rows] == [(True, False, False, "Si"), (False, True, True, "No"),
                                                    (False, False, None, "No")]
    assert df.filter(not_in("s", ["a"])).count() == 1   # NULL rows drop out


def test_bits_and_labels(spark):
    df = spark.createDataFrame([(32,), (33,), (None,)], "x int")
    rows = df.select(has_bit("x", 5).alias("b5"), has_bit("x", 0).alias("b0"),
                     label_map(F.col("x").cast("string"), {"32": "a"}).alias("l")).collect()
    assert [(r.b5, r.b0, r.l) for r in rows] == [(True, False, "a"), (True, True, None), (None, None, None)]


def test_calendar_helpers_match_a_python_reference_on_random_pairs(spark):
    import random
    import re
    rnd = random.Random(11)
    base = dt.datetime(2019, 1, 1)
    pairs = [(base + dt.timedelta(minutes=rnd.randint(0, 4 * 365 * 24 * 60)),
              base + dt.timedelta(minutes=rnd.randint(0, 4 * 365 * 24 * 60))) for _ in range(400)]
    words = ["josé-maría", "o'neil", "ANA  luz", "x1y2 z", "ñandú_(ok)", "", "3er piso-b"]
    df = spark.createDataFrame([(a, b, words[i % len(words)]) for i, (a, b) in enumerate(pairs)],
                               "a timestamp_ntz, b timestamp_ntz, w string")
    got = df.select("a", "b", "w", month_boundaries("a", "b").alias("m"), year_boundaries("a", "b").alias("y"),
                    day_boundaries("a", "b").alias("d"), month_boundaries("b", "a").alias("m_rev"),
                    initcap_words("w").alias("ic")).collect()

    def initcap_ref(s):
        return "".join(p[:1].upper() + p[1:].lower() for p in re.findall(r"[^\W_]+|[\W_]+", s))

    for r in got:
        assert r.m == (r.b.year * 12 + r.b.month) - (r.a.year * 12 + r.a.month)
        assert r.y == r.b.year - r.a.year
        assert r.d == (r.b.date() - r.a.date()).days
        assert r.m_rev == -r.m
        assert r.ic == initcap_ref(r.w)
