"""Tables of two catalog namespaces, written results and their read-back."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from tablero.operators import lookup, rollup_ancestors
from tablero.plans.standins.common import query, table
from tablero.plans.standins.joins import RENT_TREE_SQL, rent_tree
from tablero.sources import Staging, from_catalog, publish, replace_result, within
from tablero.sources.catalog import month_of


def catalog(spark, sf):
    """The rents in the default namespace and the listings and their quarters
    in ``webscraping``, partitioned by month: published once per application."""
    own = "standin_" + hashlib.md5(f"{spark.sparkContext.applicationId} {sf}".encode()).hexdigest()[:12]
    namespaces = {"webscraping": f"{own}_webscraping"}
    names = ["rents", "webscraping.listings", "webscraping.quarters"]
    tables = from_catalog(spark, names, database=own, namespaces=namespaces)
    if not spark.catalog.databaseExists(namespaces["webscraping"]) or not spark.catalog.tableExists(f"{namespaces['webscraping']}.quarters"):
        rents = table(spark, sf, "orders").select(F.col("o_orderkey").alias("rent_id"), F.col("o_custkey").alias("user_id"),
                                                  F.col("o_totalprice").alias("price"), F.col("o_orderdate").alias("created_at"))
        listings = table(spark, sf, "lineitem").select(
            F.col("l_orderkey").alias("rent_id"), F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("visits"),
            F.nullif("l_shipdate", F.lit("1995-06-17").cast("timestamp_ntz")).alias("date_in"))
        month = F.trunc("l_shipdate", "month")
        quarters = table(spark, sf, "lineitem").select(month.alias("month")).distinct().select(
            "month", F.concat(F.year("month"), F.lit("-Q"), F.quarter("month")).alias("quarter"))
        frames = {"rents": rents, "webscraping.listings": listings, "webscraping.quarters": quarters}
        publish(frames, Staging(spark, "catalog").root, own, namespaces, months={"rents": "created_at", "webscraping.listings": "date_in"})
    return tables


# -- S1/S2/P19: both namespaces, months pruned by a literal range ------------------------
@query("catalog_months", """
SELECT o_orderkey AS rent_id, o_custkey AS user_id, l_linenumber AS line, l_quantity AS visits, l_shipdate AS listed_at
FROM orders JOIN lineitem ON l_orderkey = o_orderkey
WHERE o_orderdate >= TIMESTAMP '1995-03-10 00:00:00' AND o_orderdate < TIMESTAMP '1995-06-01 00:00:00'
  AND l_shipdate >= TIMESTAMP '1995-04-05 00:00:00' AND l_shipdate < TIMESTAMP '1995-07-15 12:00:00'
  AND l_shipdate != TIMESTAMP '1995-06-17 00:00:00'""")
def catalog_months(spark, sf):
    t = catalog(spark, sf)
    rents = t["rents"].filter(within("created_at", "1995-03-10 00:00:00", "1995-06-01 00:00:00"))
    listings = t["webscraping.listings"].filter(within("date_in", "1995-04-05 00:00:00", "1995-07-15 12:00:00"))
    return listings.join(rents, "rent_id").select("rent_id", "user_id", "line", "visits", F.col("date_in").alias("listed_at"))


# -- S2/P20: months pruned by another table's rows at run time -----------------------------
@query("catalog_quarter", """
SELECT date_trunc('month', l_shipdate)::DATE AS month, count(*) AS listings, CAST(sum(l_quantity) AS DOUBLE) AS visits,
       count(o_orderkey) AS rented
FROM (SELECT nullif(l_shipdate, TIMESTAMP '1995-06-17 00:00:00') AS l_shipdate, l_quantity, l_orderkey FROM lineitem) l
LEFT JOIN orders ON o_orderkey = l_orderkey AND o_totalprice > 100000
WHERE year(l_shipdate) = 1995 AND quarter(l_shipdate) = 2
GROUP BY ALL""")
def catalog_quarter(spark, sf):
    t = catalog(spark, sf)
    month = month_of("date_in")
    now = t["webscraping.quarters"].filter(F.col("quarter") == "1995-Q2")
    listings = t["webscraping.listings"].join(now, F.col(month) == F.col("month"))
    big = t["rents"].filter(F.col("price") > 100000)
    j = lookup(listings, big, "rent_id", "rent_id", {"rented_id": "rent_id"})
    return j.groupBy("month").agg(F.count(F.lit(1)).alias("listings"), F.sum("visits").cast("double").alias("visits"),
                                  F.count("rented_id").alias("rented"))


# -- S7: a written result, rerun for one partition --------------------------------------------
@query("sink_rerun", """
SELECT o_orderkey AS rent_id, o_orderstatus AS status, CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS price,
       o_orderdate AS created_at
FROM orders""")
def sink_rerun(spark, sf):
    rents = table(spark, sf, "orders").select(F.col("o_orderkey").alias("rent_id"), F.col("o_orderstatus").alias("status"),
                                              F.col("o_totalprice").alias("price"), F.col("o_orderdate").alias("created_at"))
    path = f"{Staging(spark, 'sink').root}/rents"
    replace_result(rents, path, ["status"])
    changed = rents.filter(F.col("status") == "F").withColumn("price", F.col("price") * 2)
    replace_result(changed, path, ["status"])  # the other partitions stay
    return spark.read.schema(rents.schema).parquet(path).select(*rents.columns)


# -- J12/B15: all ancestors ---------------------------------------------------------------------
@query("hierarchy_rollup_all", f"""
WITH RECURSIVE {RENT_TREE_SQL},
dep AS (SELECT l_orderkey AS rent_id, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS deposit
        FROM lineitem GROUP BY l_orderkey),
up AS (SELECT rent_id, rent_id AS at FROM rent_tree
       UNION ALL SELECT up.rent_id, t.parent_rent_id FROM up JOIN rent_tree t ON t.rent_id = up.at WHERE t.parent_rent_id IS NOT NULL),
sums AS (SELECT up.rent_id, sum(d.deposit) AS deposit FROM up JOIN dep d ON d.rent_id = up.at GROUP BY up.rent_id)
SELECT dep.rent_id, CAST(sums.deposit AS DOUBLE) AS historic_deposit FROM dep JOIN sums ON sums.rent_id = dep.rent_id""")
def hierarchy_rollup_all(spark, sf):
    dep = (table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("rent_id"))
           .agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("deposit")))
    rolled = rollup_ancestors(dep, "rent_id", "deposit", rent_tree(spark, sf), "rent_id", "parent_rent_id", depth=None,
                              name="historic_deposit", cut=Staging(spark, "ancestors").cut)
    return rolled.select("rent_id", F.col("historic_deposit").cast("double").alias("historic_deposit"))
