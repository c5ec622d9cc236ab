"""Scalar functions F1..F9, D1..D7, M1..M5, and the composite units built
from them (deferred deposit, current tenant, state-dependent durations)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablero.functions import (as_of_date, as_of_lit, day_boundaries, first_match, full_name, has_bit,
                               initcap_words, is_true, join_parts, month_boundaries, month_start,
                               parse_month, prefixed, split_part, to_local, year_boundaries, yes_no)
from tablero.operators import latest_per_key
from tablero.plans.standins.common import (AS_OF, EVENTS_AS_OF, initcap, loc, months, query,
                                           round_div_sql, table, ts_lit)


# -- F1..F9: strings ------------------------------------------------------------------
@query("str_concat_nulls", """
SELECT c_custkey AS user_id, c_name || ' ' || nullif(c_mktsegment, 'BUILDING') || ' ' || c_nationkey AS tenant
FROM customer""")
def str_concat_nulls(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(F.col("c_custkey").alias("user_id"),
                    join_parts("c_name", F.nullif("c_mktsegment", F.lit("BUILDING")),
                               F.col("c_nationkey").cast("string")).alias("tenant"))


@query("str_full_name", f"""
SELECT c_custkey AS user_id,
       {initcap("COALESCE(lower(split_part(c_name, '#', 1)), '') || ' ' || "
                "COALESCE(nullif(lower(c_mktsegment), 'building'), '') || ' ' || COALESCE(split_part(c_name, '#', 2), '')")}
         AS full_name,
       {initcap("COALESCE(nullif(lower(c_mktsegment), 'building'), ' ') || ' ' || COALESCE(lower(c_name), ' ')")}
         AS full_name_space
FROM customer""")
def str_full_name(spark, sf):
    c = table(spark, sf, "customer")
    seg = F.nullif(F.lower("c_mktsegment"), F.lit("building"))
    return c.select(F.col("c_custkey").alias("user_id"),
                    full_name(F.lower(split_part("c_name", "#", 1)), seg, split_part("c_name", "#", 2),
                              null_as="").alias("full_name"),
                    initcap_words(join_parts(seg, F.lower("c_name"), null_as=" ")).alias("full_name_space"))


@query("str_initcap", f"""
SELECT p_partkey AS home_id, {initcap("p_name || '-' || lower(p_type) || ' ' || lower(p_brand)")} AS title
FROM part""")
def str_initcap(spark, sf):
    p = table(spark, sf, "part")
    return p.select(F.col("p_partkey").alias("home_id"),
                    initcap_words(F.concat("p_name", F.lit("-"), F.lower("p_type"), F.lit(" "),
                                           F.lower("p_brand"))).alias("title"))


@query("str_split_part", """
SELECT o_orderkey AS rent_id, split_part(p, '-', 1) AS part1, split_part(p, '-', 2) AS part2,
       split_part(p, '-', 3) AS part3, split_part(split_part(p, '-', 2), ' ', 1) AS nested
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS p FROM orders)""")
def str_split_part(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("p"))
    return o.select(F.col("o_orderkey").alias("rent_id"), split_part("p", "-", 1).alias("part1"),
                    split_part("p", "-", 2).alias("part2"), split_part("p", "-", 3).alias("part3"),
                    split_part(split_part("p", "-", 2), " ", 1).alias("nested"))


@query("str_address", """
SELECT c.c_custkey AS user_id,
       CASE WHEN nullif(c.c_mktsegment, 'BUILDING') IS NULL
            THEN COALESCE(c.c_name, ' ') || ' ' || COALESCE('Piso ' || CAST(nullif(c.c_nationkey, 0) AS VARCHAR), ' ')
                 || ' ' || COALESCE(n.n_name, ' ')
            ELSE c.c_mktsegment END AS address
FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""")
def str_address(spark, sf):
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    j = c.join(n, n.n_nationkey == c.c_nationkey, "left")
    seg = F.nullif("c_mktsegment", F.lit("BUILDING"))
    built = join_parts("c_name", prefixed("Piso ", F.nullif("c_nationkey", F.lit(0))), "n_name", null_as=" ")
    return j.select(F.col("c_custkey").alias("user_id"),
                    F.when(seg.isNull(), built).otherwise(F.col("c_mktsegment")).alias("address"))


# -- D1..D7: dates and zones ------------------------------------------------------------
@query("tz_local", f"""
SELECT event_id, {loc('ts')} AS local_at FROM events""")
def tz_local(spark, sf):
    return table(spark, sf, "events").select("event_id", to_local("ts").alias("local_at"))


@query("tz_double", f"""
SELECT o_orderkey AS rent_id, {loc('o_orderdate')} AS local_once, {loc(loc('o_orderdate'))} AS local_twice
FROM orders""")
def tz_double(spark, sf):
    # A value already converted to local time converted again (shifted twice).
    o = table(spark, sf, "orders")
    return o.select(F.col("o_orderkey").alias("rent_id"), to_local("o_orderdate").alias("local_once"),
                    to_local(to_local("o_orderdate")).alias("local_twice"))


@query("datediff_day", f"""
SELECT event_id,
       date_diff('day', CAST(ts AS DATE), CAST({ts_lit(EVENTS_AS_OF)} AS DATE)) AS days_utc,
       date_diff('day', CAST({loc('ts')} AS DATE), CAST({ts_lit(EVENTS_AS_OF)} AS DATE)) AS days_local
FROM events""")
def datediff_day(spark, sf):
    e = table(spark, sf, "events")
    now = as_of_lit(EVENTS_AS_OF)
    return e.select("event_id", day_boundaries("ts", now).alias("days_utc"),
                    day_boundaries(to_local("ts"), now).alias("days_local"))


@query("datediff_month", f"""
SELECT l.l_orderkey AS rent_id, l.l_linenumber AS month_no, l.l_partkey AS home_id, l.l_suppkey AS owner_id,
       {months('o.o_orderdate', 'l.l_shipdate')} AS months_elapsed
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey""")
def datediff_month(spark, sf):
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    j = li.join(o, o.o_orderkey == li.l_orderkey, "inner")
    return j.select(F.col("l_orderkey").alias("rent_id"), F.col("l_linenumber").alias("month_no"),
                    F.col("l_partkey").alias("home_id"), F.col("l_suppkey").alias("owner_id"),
                    month_boundaries("o_orderdate", "l_shipdate").alias("months_elapsed"))


@query("datediff_year_age", f"""
SELECT o_orderkey AS rent_id, year(CAST({ts_lit(AS_OF)} AS DATE)) - year(o_orderdate) AS age
FROM orders""")
def datediff_year_age(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(F.col("o_orderkey").alias("rent_id"),
                    year_boundaries("o_orderdate", as_of_date(AS_OF)).alias("age"))


_M_SQL = "replace(lower(strftime(o_orderdate, '%B')), 'september', 'sept')"
_PARSED_SQL = f"CAST(try_strptime('1-' || {_M_SQL} || ' ' || CAST(year(o_orderdate) AS VARCHAR), '%d-%B %Y') AS DATE)"


def _month_text():
    return F.replace(F.lower(F.date_format("o_orderdate", "MMMM")), F.lit("september"), F.lit("sept"))


@query("parse_month_name", f"""
SELECT o_orderkey AS rent_id, {_PARSED_SQL} AS month_date FROM orders""")
def parse_month_name(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(F.col("o_orderkey").alias("rent_id"),
                    parse_month(_month_text(), F.year("o_orderdate")).alias("month_date"))


@query("current_month", f"""
SELECT o_orderkey AS rent_id, o_orderdate AS created_at FROM orders
WHERE {_PARSED_SQL} = date_trunc('month', CAST({ts_lit(AS_OF)} AS DATE))""")
def current_month(spark, sf):
    o = table(spark, sf, "orders")
    return (o.filter(parse_month(_month_text(), F.year("o_orderdate")) == month_start(as_of_date(AS_OF)))
             .select(F.col("o_orderkey").alias("rent_id"), F.col("o_orderdate").alias("created_at")))


@query("days_until", f"""
SELECT o_orderkey AS rent_id,
       CASE WHEN {loc('o_orderdate')} >= {ts_lit(AS_OF)}
            THEN date_diff('day', CAST({ts_lit(AS_OF)} AS DATE), CAST({loc('o_orderdate')} AS DATE)) END
         AS days_to_next
FROM orders""")
def days_until(spark, sf):
    # The local time is compared with the UTC clock, as the report does.
    o = table(spark, sf, "orders")
    local = to_local("o_orderdate")
    return o.select(F.col("o_orderkey").alias("rent_id"),
                    F.when(local >= as_of_lit(AS_OF), day_boundaries(as_of_date(AS_OF), local)).alias("days_to_next"))


@query("state_dependent_duration", f"""
WITH span AS (SELECT l_orderkey, min(l_shipdate) AS canceled_at, max(l_shipdate) AS ends_at
              FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderkey AS rent_id,
       CASE WHEN o.o_orderstatus = 'O' THEN {months('o.o_orderdate', f'CAST({ts_lit(AS_OF)} AS DATE)')}
            WHEN o.o_orderstatus IN ('P') THEN {months('o.o_orderdate', 's.canceled_at')}
            WHEN o.o_orderstatus = 'F' THEN {months('o.o_orderdate', 's.ends_at')} END AS months_elapsed
FROM orders o LEFT JOIN span s ON s.l_orderkey = o.o_orderkey""")
def state_dependent_duration(spark, sf):
    span = (table(spark, sf, "lineitem").groupBy("l_orderkey")
            .agg(F.min("l_shipdate").alias("canceled_at"), F.max("l_shipdate").alias("ends_at")))
    o = table(spark, sf, "orders")
    j = o.join(span, span.l_orderkey == o.o_orderkey, "left")
    st = F.col("o_orderstatus")
    elapsed = first_match((st == "O", month_boundaries("o_orderdate", as_of_date(AS_OF))),
                          (st.isin("P"), month_boundaries("o_orderdate", "canceled_at")),
                          (st == "F", month_boundaries("o_orderdate", "ends_at")))
    return j.select(F.col("o_orderkey").alias("rent_id"), elapsed.alias("months_elapsed"))


# -- M1..M5: arithmetic ------------------------------------------------------------------
_CENTS = "CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT)"


@query("arith_nulls", f"""
SELECT o.o_orderkey AS rent_id,
       CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) + CAST(CASE WHEN c.c_acctbal < 0 THEN NULL ELSE c.c_acctbal END
            AS DECIMAL(18,2)) AS DOUBLE) AS received,
       {round_div_sql(_CENTS, 'c.c_nationkey')} AS per_month,
       o.o_totalprice * 2 AS doubled
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey""")
def arith_nulls(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    j = o.join(c, c.c_custkey == o.o_custkey, "left")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    bal = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).cast("decimal(18,2)")
    return j.select(F.col("o_orderkey").alias("rent_id"), (price + bal).cast("double").alias("received"),
                    F.round(F.try_divide(price, F.col("c_nationkey")), 2).cast("double").alias("per_month"),
                    (F.col("o_totalprice") * 2).alias("doubled"))


@query("round_money", """
SELECT l_orderkey AS rent_id,
       CAST(round(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2))), 2) AS DOUBLE)
         AS discount_2,
       CAST(round(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2)))) AS DOUBLE)
         AS discount_0
FROM lineitem GROUP BY l_orderkey""")
def round_money(spark, sf):
    li = table(spark, sf, "lineitem")
    prod = F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_discount").cast("decimal(18,2)")
    s = li.groupBy(F.col("l_orderkey").alias("rent_id")).agg(F.sum(prod).alias("d"))
    return s.select("rent_id", F.round("d", 2).cast("double").alias("discount_2"),
                    F.round("d").cast("double").alias("discount_0"))


@query("greatest_nulls", """
WITH dep AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) / 10 AS deposit
             FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderkey AS rent_id, CAST(greatest(d.deposit, CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS estimate
FROM orders o LEFT JOIN dep d ON d.l_orderkey = o.o_orderkey""")
def greatest_nulls(spark, sf):
    dep = (table(spark, sf, "lineitem").groupBy("l_orderkey")
           .agg((F.sum(F.col("l_extendedprice").cast("decimal(18,2)")) / F.lit(10)).alias("deposit")))
    o = table(spark, sf, "orders")
    j = o.join(dep, dep.l_orderkey == o.o_orderkey, "left")
    return j.select(F.col("o_orderkey").alias("rent_id"),
                    F.greatest("deposit", F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("estimate"))


@query("bit_flags", """
SELECT p_partkey AS home_id,
       CASE WHEN (nullif(p_size, 50) & 32) > 0 THEN 'Si' ELSE 'No' END AS furnished_label,
       CASE WHEN (p_size & 1) > 0 THEN 'Si' ELSE 'No' END AS pets,
       CASE WHEN ((nullif(p_size, 50) & 32) > 0) IS NULL THEN p_retailprice > 1500
            ELSE (nullif(p_size, 50) & 32) > 0 END AS furnished
FROM part""")
def bit_flags(spark, sf):
    p = table(spark, sf, "part")
    extras = F.nullif("p_size", F.lit(50))
    furnished_bit = has_bit(extras, 5)
    return p.select(F.col("p_partkey").alias("home_id"), yes_no(furnished_bit).alias("furnished_label"),
                    yes_no(has_bit("p_size", 0)).alias("pets"),
                    F.when(furnished_bit.isNull(), F.col("p_retailprice") > 1500).otherwise(furnished_bit)
                    .alias("furnished"))


_DEF_COND = (f"(CASE WHEN o.o_orderstatus = 'P' THEN NULL ELSE o.o_orderstatus = 'F' END) IS TRUE "
             f"AND ({months('o.o_orderdate', 'l.l_shipdate')} < l.l_linenumber OR l.l_linenumber = 1)")


@query("deferred_deposit", f"""
SELECT l.l_orderkey AS rent_id, l.l_linenumber AS month_no, l.l_partkey AS home_id, l.l_suppkey AS owner_id,
       CASE WHEN {_DEF_COND} THEN TRUE ELSE FALSE END AS is_deferred,
       CASE WHEN {_DEF_COND} THEN {round_div_sql(_CENTS, 'l.l_linenumber')} END AS deferred_amount
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey""")
def deferred_deposit(spark, sf):
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    j = li.join(o, o.o_orderkey == li.l_orderkey, "inner")
    allow = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "F")
    cond = is_true(allow) & ((month_boundaries("o_orderdate", "l_shipdate") < F.col("l_linenumber"))
                             | (F.col("l_linenumber") == 1))
    amount = F.round(F.try_divide(F.col("o_totalprice").cast("decimal(18,2)"), F.col("l_linenumber")), 2)
    return j.select(F.col("l_orderkey").alias("rent_id"), F.col("l_linenumber").alias("month_no"),
                    F.col("l_partkey").alias("home_id"), F.col("l_suppkey").alias("owner_id"),
                    F.when(cond, F.lit(True)).otherwise(F.lit(False)).alias("is_deferred"),
                    F.when(cond, amount).cast("double").alias("deferred_amount"))


@query("current_tenant", f"""
WITH months AS (
  SELECT l.l_partkey AS home_id, o.o_orderkey AS rent_id, o.o_orderdate, l.l_linenumber, l.l_suppkey,
         {initcap("COALESCE(lower(split_part(c.c_name, '#', 1)), '') || ' ' || COALESCE(lower(c.c_mktsegment), '')")}
           AS tenant_name,
         o.o_orderstatus AS status,
         row_number() OVER (PARTITION BY l.l_partkey
                            ORDER BY o.o_orderdate DESC NULLS FIRST, o.o_orderkey DESC, l.l_linenumber DESC,
                                     l.l_suppkey DESC) AS rn
  FROM lineitem l
  LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  WHERE lower(strftime(l.l_shipdate, '%B')) IS NOT NULL
    AND (o.o_orderstatus NOT IN ('P') OR l.l_linestatus != 'O')
    AND l.l_returnflag != 'A'
    AND CAST(try_strptime('01 ' || lower(strftime(l.l_shipdate, '%B')) || ' ' || CAST(year(l.l_shipdate) AS VARCHAR),
                          '%d %B %Y') AS DATE) = date_trunc('month', CAST({ts_lit(AS_OF)} AS DATE))
    AND o.o_orderpriority IS NOT NULL)
SELECT home_id, rent_id, tenant_name, status FROM months WHERE rn = 1""")
def current_tenant(spark, sf):
    li, o, c = table(spark, sf, "lineitem"), table(spark, sf, "orders"), table(spark, sf, "customer")
    j = (li.join(o, o.o_orderkey == li.l_orderkey, "left").join(c, c.c_custkey == o.o_custkey, "left"))
    month_name = F.lower(F.date_format("l_shipdate", "MMMM"))
    month_date = F.try_to_date(F.concat(F.lit("01 "), month_name, F.lit(" "), F.year("l_shipdate").cast("string")),
                               "dd MMMM yyyy")
    cond = (month_name.isNotNull()
            & (~F.col("o_orderstatus").isin("P") | (F.col("l_linestatus") != "O"))
            & (F.col("l_returnflag") != "A")
            & (month_date == month_start(as_of_date(AS_OF)))
            & F.col("o_orderpriority").isNotNull())
    rows = j.filter(cond).select(
        F.col("l_partkey").alias("home_id"), F.col("o_orderkey").alias("rent_id"), "o_orderdate", "l_linenumber",
        "l_suppkey",
        initcap_words(join_parts(F.lower(split_part("c_name", "#", 1)), F.lower("c_mktsegment"),
                                 null_as="")).alias("tenant_name_raw"),
        F.col("o_orderstatus").alias("status"))
    latest = latest_per_key(rows, "home_id", ["o_orderdate"], tie_break=["rent_id", "l_linenumber", "l_suppkey"],
                            columns=["rent_id", "tenant_name_raw", "status"])
    return latest.select("home_id", "rent_id", F.col("tenant_name_raw").alias("tenant_name"), "status")
