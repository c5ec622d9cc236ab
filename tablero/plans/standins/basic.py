"""Scans, projections, predicates, CASE forms and final sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablero.functions import (as_of_lit, first_match, flag_int, is_false, is_true, label_map,
                               month_label, not_in, to_local, yes_no)
from tablero.operators import clean_listings, count_when, number_rows
from tablero.plans.standins.common import AS_OF, loc, query, table, ts_lit


# -- S1/P1/P2: labelled projection ------------------------------------------------
@query("scan_project", """
SELECT o_orderkey AS "Id de Renta", o_custkey AS "Id de Usuario", o_orderstatus AS "Status de Renta",
       o_totalprice AS "Precio de Renta", o_orderdate AS "Fecha de Creacion"
FROM orders""")
def scan_project(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(F.col("o_orderkey").alias("Id de Renta"), F.col("o_custkey").alias("Id de Usuario"),
                    F.col("o_orderstatus").alias("Status de Renta"),
                    F.col("o_totalprice").alias("Precio de Renta"),
                    F.col("o_orderdate").alias("Fecha de Creacion"))


# -- S5: single-use CTE (pre-aggregate, then join) ---------------------------------
@query("cte_single", """
WITH orders_by_customer AS (SELECT o_custkey, count(*) AS orders FROM orders GROUP BY o_custkey)
SELECT c.c_custkey AS customer_id, c.c_name AS name, obc.orders
FROM customer c LEFT JOIN orders_by_customer obc ON obc.o_custkey = c.c_custkey""")
def cte_single(spark, sf):
    c = table(spark, sf, "customer")
    per = count_when(table(spark, sf, "orders"), "o_custkey", {}, total="orders")
    return (c.join(per, c.c_custkey == per.o_custkey, "left")
             .select(c.c_custkey.alias("customer_id"), c.c_name.alias("name"), "orders"))


# -- C1: casts ---------------------------------------------------------------------
@query("casts", """
SELECT o_orderkey AS rent_id,
       CAST(o_orderkey AS VARCHAR) AS rent_text,
       CAST(o_totalprice AS DECIMAL(18,2)) AS price_money,
       CAST(CAST(o_totalprice AS DECIMAL(18,0)) AS BIGINT) AS price_numeric,
       CAST(o_orderdate AS DATE) AS created_date,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS price_float
FROM orders""")
def casts(spark, sf):
    o = table(spark, sf, "orders")
    money = F.col("o_totalprice").cast("decimal(18,2)")
    return o.select(F.col("o_orderkey").alias("rent_id"),
                    F.col("o_orderkey").cast("string").alias("rent_text"),
                    money.alias("price_money"),
                    F.col("o_totalprice").cast("decimal(18,0)").cast("bigint").alias("price_numeric"),
                    F.to_date("o_orderdate").alias("created_date"),
                    money.cast("double").alias("price_float"))


# -- P12..P23: predicates ----------------------------------------------------------
@query("filter_basic", """
SELECT o_orderkey AS rent_id, o_orderpriority AS priority FROM orders
WHERE o_orderstatus = 'F' AND o_orderpriority != '1-URGENT'""")
def filter_basic(spark, sf):
    o = table(spark, sf, "orders")
    return (o.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") != "1-URGENT"))
             .select(F.col("o_orderkey").alias("rent_id"), F.col("o_orderpriority").alias("priority")))


@query("filter_in", """
SELECT o_orderkey AS rent_id, o_orderpriority AS priority FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def filter_in(spark, sf):
    o = table(spark, sf, "orders")
    return (o.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
             .select(F.col("o_orderkey").alias("rent_id"), F.col("o_orderpriority").alias("priority")))


@query("filter_not_in_nulls", """
SELECT rent_id, status FROM (SELECT o_orderkey AS rent_id, nullif(o_orderstatus, 'P') AS status FROM orders)
WHERE status NOT IN ('F')""")
def filter_not_in_nulls(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("rent_id"),
                                           F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    return o.filter(not_in("status", ["F"]))


@query("filter_any_all", """
SELECT rent_id, status, priority
FROM (SELECT o_orderkey AS rent_id, nullif(o_orderstatus, 'P') AS status, o_orderpriority AS priority FROM orders)
WHERE status NOT IN ('F') AND priority IN ('1-URGENT', '5-LOW')""")
def filter_any_all(spark, sf):
    # != ALL(ARRAY[..]) and = ANY(ARRAY[..]) are NOT IN / IN lists.
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("rent_id"),
                                           F.nullif("o_orderstatus", F.lit("P")).alias("status"),
                                           F.col("o_orderpriority").alias("priority"))
    return o.filter(not_in("status", ["F"]) & F.col("priority").isin(["1-URGENT", "5-LOW"]))


@query("filter_nulls", """
SELECT o_orderkey AS rent_id, o_orderpriority AS priority FROM orders
WHERE nullif(o_orderstatus, 'P') IS NULL AND o_orderpriority IS NOT NULL""")
def filter_nulls(spark, sf):
    o = table(spark, sf, "orders")
    return (o.filter(F.nullif("o_orderstatus", F.lit("P")).isNull() & F.col("o_orderpriority").isNotNull())
             .select(F.col("o_orderkey").alias("rent_id"), F.col("o_orderpriority").alias("priority")))


_BIG_SQL = "CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_totalprice > 200000 THEN TRUE ELSE FALSE END"


def _big():
    return (F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("boolean"))
             .when(F.col("o_totalprice") > 200000, F.lit(True)).otherwise(F.lit(False)))


@query("truth_tests", f"""
SELECT rent_id, big IS TRUE AS is_true, big IS FALSE AS is_false, big = TRUE AS eq_true
FROM (SELECT o_orderkey AS rent_id, {_BIG_SQL} AS big FROM orders)""")
def truth_tests(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("rent_id"), _big().alias("big"))
    return o.select("rent_id", is_true("big").alias("is_true"), is_false("big").alias("is_false"),
                    (F.col("big") == F.lit(True)).alias("eq_true"))


@query("filter_compound", """
SELECT rent_id, status FROM (SELECT o_orderkey AS rent_id, nullif(o_orderstatus, 'O') AS status,
                                    o_orderpriority AS priority FROM orders)
WHERE (status IS NULL OR status != 'F') AND priority = '1-URGENT'""")
def filter_compound(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("rent_id"),
                                           F.nullif("o_orderstatus", F.lit("O")).alias("status"),
                                           F.col("o_orderpriority").alias("priority"))
    return (o.filter((F.col("status").isNull() | (F.col("status") != "F")) & (F.col("priority") == "1-URGENT"))
             .select("rent_id", "status"))


@query("filter_date_range", f"""
SELECT o_orderkey AS rent_id, o_orderdate AS created_at FROM orders
WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate <= {ts_lit(AS_OF)}""")
def filter_date_range(spark, sf):
    o = table(spark, sf, "orders")
    return (o.filter((F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
                     & (F.col("o_orderdate") <= as_of_lit(AS_OF)))
             .select(F.col("o_orderkey").alias("rent_id"), F.col("o_orderdate").alias("created_at")))


@query("like_prefix", """
SELECT p_partkey AS home_id,
       CASE WHEN nullif(p_name, 'red widget') IS NULL THEN 'No'
            WHEN nullif(p_name, 'red widget') LIKE 'red%' THEN 'Si' ELSE 'No' END AS red_link
FROM part""")
def like_prefix(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.nullif("p_name", F.lit("red widget")).alias("link"))
    return p.select(F.col("p_partkey").alias("home_id"),
                    first_match((F.col("link").isNull(), F.lit("No")),
                                (F.col("link").startswith("red"), F.lit("Si")),
                                default=F.lit("No")).alias("red_link"))


@query("status_change_filter", """
SELECT rent_id, customer_id, status, previous_status FROM (
  SELECT o_orderkey AS rent_id, o_custkey AS customer_id, o_orderstatus AS status,
         lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS previous_status
  FROM orders)
WHERE status != previous_status""")
def status_change_filter(spark, sf):
    from tablero.operators import with_previous
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("rent_id"),
                                           F.col("o_custkey").alias("customer_id"),
                                           F.col("o_orderstatus").alias("status"), "o_orderdate")
    w = with_previous(o, "customer_id", ["o_orderdate"], ["status"], tie_break=["rent_id"],
                      bucket=F.to_date("o_orderdate"))
    return w.filter(F.col("status") != F.col("previous_status")).drop("o_orderdate")


@query("geo_bounds", """
SELECT vec_id AS listing_id, lat, lon FROM (
  SELECT vec_id, CAST(embedding[1] AS DOUBLE) * 150 AS lat, CAST(embedding[2] AS DOUBLE) * 300 AS lon
  FROM embeddings)
WHERE lat IS NOT NULL AND lon IS NOT NULL AND abs(lat) <= 90 AND abs(lon) <= 180""")
def geo_bounds(spark, sf):
    e = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("listing_id"),
        (F.element_at("embedding", 1).cast("double") * 150).alias("lat"),
        (F.element_at("embedding", 2).cast("double") * 300).alias("lon"))
    return clean_listings(e, required=[], lat="lat", lon="lon")


# -- P4..P11: CASE forms -----------------------------------------------------------
# Priority labels used by the CASE stand-ins.
PRIORITY_LABELS = {"1-URGENT": "Urgente", "2-HIGH": "Alta", "3-MEDIUM": "Media"}


@query("case_label", """
SELECT o_orderkey AS rent_id,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'Urgente' WHEN o_orderpriority = '2-HIGH' THEN 'Alta'
            WHEN o_orderpriority = '3-MEDIUM' THEN 'Media' END AS priority_label
FROM orders""")
def case_label(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(F.col("o_orderkey").alias("rent_id"),
                    label_map("o_orderpriority", PRIORITY_LABELS).alias("priority_label"))


@query("case_ladder", """
WITH open_lines AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_linestatus = 'O')
SELECT o.o_orderkey AS rent_id,
       CASE WHEN ol.l_orderkey IS NOT NULL THEN 'Rentado'
            WHEN ol.l_orderkey IS NULL AND o.o_orderstatus IN ('F') THEN 'Baja'
            WHEN ol.l_orderkey IS NULL AND o.o_orderstatus = 'O' THEN 'En progreso'
            WHEN ol.l_orderkey IS NULL AND o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Publicado'
       END AS status_label
FROM orders o LEFT JOIN open_lines ol ON ol.l_orderkey = o.o_orderkey""")
def case_ladder(spark, sf):
    o = table(spark, sf, "orders")
    open_lines = (table(spark, sf, "lineitem").filter(F.col("l_linestatus") == "O")
                  .select("l_orderkey").distinct())
    j = o.join(open_lines, o.o_orderkey == open_lines.l_orderkey, "left")
    none = F.col("l_orderkey").isNull()
    label = first_match(
        (F.col("l_orderkey").isNotNull(), F.lit("Rentado")),
        (none & F.col("o_orderstatus").isin("F"), F.lit("Baja")),
        (none & (F.col("o_orderstatus") == "O"), F.lit("En progreso")),
        (none & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("Publicado")))
    return j.select(F.col("o_orderkey").alias("rent_id"), label.alias("status_label"))


@query("flag_yes_no", """
SELECT p_partkey AS home_id,
       CASE WHEN p_size > 25 THEN 'Si' ELSE 'No' END AS is_large,
       CASE WHEN nullif(p_size, 1) > 40 THEN 'Si' ELSE 'No' END AS is_huge
FROM part""")
def flag_yes_no(spark, sf):
    p = table(spark, sf, "part")
    return p.select(F.col("p_partkey").alias("home_id"), yes_no(F.col("p_size") > 25).alias("is_large"),
                    yes_no(F.nullif("p_size", F.lit(1)) > 40).alias("is_huge"))


@query("flag_bool", """
SELECT o_orderkey AS rent_id,
       CASE WHEN nullif(o_orderstatus, 'P') IS NOT NULL THEN TRUE END AS is_renewal,
       CASE WHEN o_orderstatus = 'F' THEN TRUE ELSE FALSE END AS is_archived
FROM orders""")
def flag_bool(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(F.col("o_orderkey").alias("rent_id"),
                    F.when(F.nullif("o_orderstatus", F.lit("P")).isNotNull(), F.lit(True)).alias("is_renewal"),
                    F.when(F.col("o_orderstatus") == "F", F.lit(True)).otherwise(F.lit(False)).alias("is_archived"))


@query("flag_int", """
SELECT o_orderkey AS rent_id, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS approved
FROM orders""")
def flag_int_q(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(F.col("o_orderkey").alias("rent_id"), flag_int(F.col("o_orderstatus") == "F").alias("approved"))


@query("null_default", """
SELECT p_partkey AS home_id,
       CASE WHEN nullif(p_size, 1) IS NULL THEN 0 ELSE nullif(p_size, 1) END AS parkings,
       COALESCE(nullif(p_brand, 'Brand#1'), 'sin marca') AS brand
FROM part""")
def null_default(spark, sf):
    p = table(spark, sf, "part")
    return p.select(F.col("p_partkey").alias("home_id"),
                    F.coalesce(F.nullif("p_size", F.lit(1)), F.lit(0)).alias("parkings"),
                    F.coalesce(F.nullif("p_brand", F.lit("Brand#1")), F.lit("sin marca")).alias("brand"))


@query("fallback_column", """
SELECT c_custkey AS customer_id,
       CASE WHEN nullif(c_mktsegment, 'BUILDING') IS NULL THEN c_name ELSE c_mktsegment END AS label
FROM customer""")
def fallback_column(spark, sf):
    c = table(spark, sf, "customer")
    seg = F.nullif("c_mktsegment", F.lit("BUILDING"))
    return c.select(F.col("c_custkey").alias("customer_id"),
                    F.when(seg.isNull(), F.col("c_name")).otherwise(seg).alias("label"))


@query("gated_value", """
SELECT o_orderkey AS rent_id, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS advance_amount
FROM orders""")
def gated_value(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(F.col("o_orderkey").alias("rent_id"),
                    F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("advance_amount"))


_MONTH_NAME_SQL = "replace(lower(strftime(o_orderdate, '%B')), 'september', 'sept')"


def _month_name():
    return F.replace(F.lower(F.date_format("o_orderdate", "MMMM")), F.lit("september"), F.lit("sept"))


@query("month_label", f"""
SELECT o_orderkey AS rent_id,
       CASE m WHEN 'january' THEN 'enero' WHEN 'february' THEN 'febrero' WHEN 'march' THEN 'marzo'
              WHEN 'april' THEN 'abril' WHEN 'may' THEN 'mayo' WHEN 'june' THEN 'junio'
              WHEN 'july' THEN 'julio' WHEN 'august' THEN 'agosto' WHEN 'september' THEN 'septiembre'
              WHEN 'october' THEN 'octubre' WHEN 'november' THEN 'noviembre' WHEN 'december' THEN 'diciembre'
              ELSE m END || '/' || y AS month_paid
FROM (SELECT o_orderkey, {_MONTH_NAME_SQL} AS m, CAST(year(o_orderdate) AS VARCHAR) AS y FROM orders)""")
def month_label_q(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(F.col("o_orderkey").alias("rent_id"),
                    month_label(_month_name(), F.year("o_orderdate").cast("string")).alias("month_paid"))


# -- O1..O3: final sorts (the rank is emitted because result hashes ignore order) --
@query("sort_desc_nulls", """
SELECT rent_id, created_at,
       row_number() OVER (ORDER BY created_at DESC NULLS FIRST, rent_id DESC) AS sort_rank
FROM (SELECT o_orderkey AS rent_id,
             CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS created_at FROM orders)""")
def sort_desc_nulls(spark, sf):
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("rent_id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("created_at"))
    # numbered inside buckets that sort like the order (year, then month, or
    # ranges of the rent id among the rows without a date), offset by the sizes
    # of the earlier buckets
    no_date = F.when(F.col("created_at").isNull(), F.floor(F.col("rent_id") / 1000))
    ranked = number_rows(o, [], ["created_at"], tie_break=["rent_id"], name="sort_rank",
                         bucket=[F.year("created_at"), F.month("created_at"), no_date], descending=True)
    return ranked.orderBy(F.col("created_at").desc_nulls_first(), F.col("rent_id").desc())


@query("sort_expression", f"""
SELECT supplier_id, registered_local,
       row_number() OVER (ORDER BY registered_local DESC NULLS FIRST, supplier_id DESC) AS sort_rank
FROM (SELECT s.s_suppkey AS supplier_id, {loc('min(l.l_shipdate)')} AS registered_local
      FROM supplier s LEFT JOIN lineitem l ON l.l_suppkey = s.s_suppkey GROUP BY s.s_suppkey)""")
def sort_expression(spark, sf):
    s = table(spark, sf, "supplier")
    first = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.min("l_shipdate").alias("first_ship"))
    j = (s.join(first, s.s_suppkey == first.l_suppkey, "left")
          .select(F.col("s_suppkey").alias("supplier_id"), to_local("first_ship").alias("registered_local")))
    ranked = number_rows(j, [], ["registered_local"], tie_break=["supplier_id"], name="sort_rank",
                         bucket=[F.year("registered_local"), F.month("registered_local"),
                                 F.when(F.col("registered_local").isNull(), F.floor(F.col("supplier_id") / 1000))],
                         descending=True)
    return ranked.orderBy(F.col("registered_local").desc_nulls_first(), F.col("supplier_id").desc())


_FEE_SQL = "round(CAST(o_totalprice AS DECIMAL(18,2)) / 1000000, 2)"


@query("sort_multi_case", f"""
SELECT rent_id, y, m, status, fee_bucket, price,
       row_number() OVER (ORDER BY y, m, status, fee_bucket, price, rent_id) AS sort_rank
FROM (SELECT o_orderkey AS rent_id, CAST(year(o_orderdate) AS VARCHAR) AS y,
             lower(strftime(o_orderdate, '%B')) AS m, o_orderstatus AS status,
             CASE WHEN {_FEE_SQL} NOT IN (0.05, 0.25, 0.09) THEN 'otros'
                  ELSE printf('%.2f', {_FEE_SQL}) END AS fee_bucket,
             o_totalprice AS price FROM orders)""")
def sort_multi_case(spark, sf):
    o = table(spark, sf, "orders")
    fee = F.round(F.col("o_totalprice").cast("decimal(18,2)") / F.lit(1000000), 2)
    bucket_txt = F.when(~fee.isin(0.05, 0.25, 0.09), F.lit("otros")).otherwise(F.to_char(fee, F.lit("0D99")))
    d = o.select(F.col("o_orderkey").alias("rent_id"), F.year("o_orderdate").cast("string").alias("y"),
                 F.lower(F.date_format("o_orderdate", "MMMM")).alias("m"),
                 F.col("o_orderstatus").alias("status"), bucket_txt.alias("fee_bucket"),
                 F.col("o_totalprice").alias("price"))
    keys = ["y", "m", "status", "fee_bucket", "price"]
    # buckets = the leading sort keys and a wide price band: together they sort
    # like the full order
    bucket = ["y", "m", "status", "fee_bucket", F.floor(F.col("price") / 100000)]
    ranked = number_rows(d, [], keys, tie_break=["rent_id"], name="sort_rank", bucket=bucket)
    return ranked.orderBy(*keys, "rent_id")
