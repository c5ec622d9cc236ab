"""Join classes J1..J15, role slots, renewal chains, populations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablero.functions import yes_no
from tablero.operators import (duplicate_keys, latest_per_key, lookup, members, population, reactivations,
                               role_pivot, rollup_ancestors, slot_join, with_previous)
from tablero.plans.standins.common import months, query, table

# -- shared derived tables ---------------------------------------------------------
RENT_TREE_SQL = """rent_tree AS (
  SELECT o_orderkey AS rent_id, o_custkey AS user_id, o_orderstatus AS status, o_orderdate AS created_at,
         lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS parent_rent_id
  FROM orders)"""


def rent_tree(spark, sf):
    """orders as rents; a customer's previous order is the rent it renews."""
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("rent_id"), F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("created_at"))
    t = with_previous(o, "user_id", ["created_at"], ["rent_id"], tie_break=["rent_id"],
                      bucket=F.floor(F.year("created_at") / 4))
    return t.withColumnRenamed("previous_rent_id", "parent_rent_id")


FLAG_TOTALS_SQL = """flag_totals AS (
  SELECT l_orderkey, l_returnflag, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount,
         count(*) AS lines
  FROM lineitem GROUP BY l_orderkey, l_returnflag)"""


def flag_totals(spark, sf):
    li = table(spark, sf, "lineitem")
    return (li.groupBy("l_orderkey", "l_returnflag")
              .agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("amount"),
                   F.count(F.lit(1)).alias("lines")))


LATEST_ORDER_SQL = """latest_order AS (
  SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC) AS rn
    FROM orders) WHERE rn = 1)"""


def latest_order(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return latest_per_key(o, "o_custkey", ["o_orderdate"], tie_break=["o_orderkey"])


# -- J1..J5 --------------------------------------------------------------------------
@query("join_inner", """
SELECT l.l_orderkey AS rent_id, l.l_linenumber AS month_no, o.o_custkey AS user_id, l.l_extendedprice AS amount
FROM lineitem l INNER JOIN orders o ON o.o_orderkey = l.l_orderkey""")
def join_inner(spark, sf):
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    return (li.join(o, o.o_orderkey == li.l_orderkey, "inner")
              .select(F.col("l_orderkey").alias("rent_id"), F.col("l_linenumber").alias("month_no"),
                      F.col("o_custkey").alias("user_id"), F.col("l_extendedprice").alias("amount")))


@query("join_inner_filtered", """
SELECT o.o_orderkey AS lead_id, t.l_partkey AS tag_id
FROM orders o INNER JOIN lineitem t ON t.l_orderkey = o.o_orderkey AND t.l_returnflag = 'R'""")
def join_inner_filtered(spark, sf):
    o = table(spark, sf, "orders")
    t = table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R")
    return (o.join(t, t.l_orderkey == o.o_orderkey, "inner")
             .select(F.col("o_orderkey").alias("lead_id"), F.col("l_partkey").alias("tag_id")))


@query("join_semi_membership", """
SELECT c.c_custkey AS user_id, c.c_name AS name
FROM customer c INNER JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F') t
  ON t.o_custkey = c.c_custkey""")
def join_semi_membership(spark, sf):
    c = table(spark, sf, "customer")
    finished = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select("o_custkey")
    return members(c, "c_custkey", finished, "o_custkey").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"))


@query("join_left", """
SELECT o.o_orderkey AS rent_id, c.c_name AS tenant, n.n_name AS country
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""")
def join_left(spark, sf):
    o = table(spark, sf, "orders")
    j = lookup(o, table(spark, sf, "customer"), "o_custkey", "c_custkey",
               {"tenant": "c_name", "tenant_nation": "c_nationkey"})
    j = lookup(j, table(spark, sf, "nation"), "tenant_nation", "n_nationkey", {"country": "n_name"})
    return j.select(F.col("o_orderkey").alias("rent_id"), "tenant", "country")


@query("join_child", """
SELECT o.o_orderkey AS rent_id, l.l_linenumber AS month_no, l.l_quantity AS quantity
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey""")
def join_child(spark, sf):
    o, li = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    return (o.join(li, li.l_orderkey == o.o_orderkey, "left")
             .select(F.col("o_orderkey").alias("rent_id"), F.col("l_linenumber").alias("month_no"),
                     F.col("l_quantity").alias("quantity")))


@query("join_multi_role", """
SELECT l.l_orderkey AS rent_id, l.l_linenumber AS month_no, cn.n_name AS tenant_country, sn.n_name AS owner_country
FROM lineitem l
LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN nation cn ON cn.n_nationkey = c.c_nationkey
LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey
LEFT JOIN nation sn ON sn.n_nationkey = s.s_nationkey""")
def join_multi_role(spark, sf):
    nation = table(spark, sf, "nation")
    j = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    j = lookup(j, table(spark, sf, "orders"), "l_orderkey", "o_orderkey", {"custkey": "o_custkey"})
    j = lookup(j, table(spark, sf, "customer"), "custkey", "c_custkey", {"c_nat": "c_nationkey"})
    j = lookup(j, nation, "c_nat", "n_nationkey", {"tenant_country": "n_name"})
    j = lookup(j, table(spark, sf, "supplier"), "l_suppkey", "s_suppkey", {"s_nat": "s_nationkey"})
    j = lookup(j, nation, "s_nat", "n_nationkey", {"owner_country": "n_name"})
    return j.select(F.col("l_orderkey").alias("rent_id"), F.col("l_linenumber").alias("month_no"),
                    "tenant_country", "owner_country")


@query("join_chain", """
SELECT l.l_orderkey AS rent_id, l.l_linenumber AS month_no, r.r_name AS region
FROM lineitem l
LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey""")
def join_chain(spark, sf):
    j = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    j = lookup(j, table(spark, sf, "orders"), "l_orderkey", "o_orderkey", {"custkey": "o_custkey"})
    j = lookup(j, table(spark, sf, "customer"), "custkey", "c_custkey", {"nat": "c_nationkey"})
    j = lookup(j, table(spark, sf, "nation"), "nat", "n_nationkey", {"reg": "n_regionkey"})
    j = lookup(j, table(spark, sf, "region"), "reg", "r_regionkey", {"region": "r_name"})
    return j.select(F.col("l_orderkey").alias("rent_id"), F.col("l_linenumber").alias("month_no"), "region")


@query("join_effective_inner", """
SELECT o.o_orderkey AS rent_id, l.l_linenumber AS month_no
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
WHERE l.l_returnflag = 'R'""")
def join_effective_inner(spark, sf):
    # A WHERE on the nullable side rejects the padded rows: written as inner.
    o = table(spark, sf, "orders")
    li = table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R")
    return (o.join(li, li.l_orderkey == o.o_orderkey, "inner")
             .select(F.col("o_orderkey").alias("rent_id"), F.col("l_linenumber").alias("month_no")))


# -- J6/J7/A8/S6: role slots -----------------------------------------------------
_SLOT_COLS = {"amount": "amount", "lines": "lines"}


@query("join_role_slots", f"""
WITH {FLAG_TOTALS_SQL}
SELECT o.o_orderkey AS rent_id, r.amount AS returned_amount, r.lines AS returned_lines,
       a.amount AS accepted_amount, a.lines AS accepted_lines
FROM orders o
LEFT JOIN flag_totals r ON r.l_orderkey = o.o_orderkey AND r.l_returnflag = 'R'
LEFT JOIN flag_totals a ON a.l_orderkey = o.o_orderkey AND a.l_returnflag = 'A'""")
def join_role_slots(spark, sf):
    ft = flag_totals(spark, sf)
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("rent_id"))
    j = slot_join(o, "rent_id", ft, "l_orderkey", F.col("l_returnflag") == "R",
                  {"returned_amount": "amount", "returned_lines": "lines"})
    return slot_join(j, "rent_id", ft, "l_orderkey", F.col("l_returnflag") == "A",
                     {"accepted_amount": "amount", "accepted_lines": "lines"})


@query("join_other_slot", f"""
WITH {FLAG_TOTALS_SQL}
SELECT o.o_orderkey AS rent_id, x.amount AS other_amount, x.l_returnflag AS other_flag
FROM orders o
LEFT JOIN flag_totals x ON x.l_orderkey = o.o_orderkey AND x.l_returnflag NOT IN ('R', 'A')""")
def join_other_slot(spark, sf):
    ft = flag_totals(spark, sf)
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("rent_id"))
    return slot_join(o, "rent_id", ft, "l_orderkey", ~F.col("l_returnflag").isin("R", "A"),
                     {"other_amount": "amount", "other_flag": "l_returnflag"})


@query("role_pivot", f"""
WITH {FLAG_TOTALS_SQL}
SELECT o.o_orderkey AS rent_id, r.amount AS returned_amount, r.lines AS returned_lines,
       a.amount AS accepted_amount, a.lines AS accepted_lines, x.amount AS other_amount, x.lines AS other_lines
FROM orders o
LEFT JOIN flag_totals r ON r.l_orderkey = o.o_orderkey AND r.l_returnflag = 'R'
LEFT JOIN flag_totals a ON a.l_orderkey = o.o_orderkey AND a.l_returnflag = 'A'
LEFT JOIN flag_totals x ON x.l_orderkey = o.o_orderkey AND x.l_returnflag NOT IN ('R', 'A')""")
def role_pivot_q(spark, sf):
    # (order, flag) is unique after the pre-aggregation, so one grouped pivot
    # replaces three filtered joins of the same input.
    ft = flag_totals(spark, sf)
    flag = F.col("l_returnflag")
    piv = role_pivot(ft, "l_orderkey", flag,
                     {"returned": flag == "R", "accepted": flag == "A", "other": ~flag.isin("R", "A")},
                     ["amount", "lines"])
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("rent_id"))
    return (o.join(piv, o.rent_id == piv.l_orderkey, "left")
             .select("rent_id", "returned_amount", "returned_lines", "accepted_amount", "accepted_lines",
                     "other_amount", "other_lines"))


@query("cte_reuse_pivot", """
WITH step_counts AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type)
SELECT c.c_custkey AS user_id, v.n AS views, k.n AS clicks, e.n AS errors
FROM customer c
LEFT JOIN step_counts v ON v.user_id = c.c_custkey AND v.event_type = 'view'
LEFT JOIN step_counts k ON k.user_id = c.c_custkey AND k.event_type = 'click'
LEFT JOIN step_counts e ON e.user_id = c.c_custkey AND e.event_type = 'error'""")
def cte_reuse_pivot(spark, sf):
    counts = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    piv = role_pivot(counts, "user_id", "event_type", {"views": "view", "clicks": "click", "errors": "error"},
                     ["n"])
    c = table(spark, sf, "customer")
    return (c.join(piv, c.c_custkey == piv.user_id, "left")
             .select(F.col("c_custkey").alias("user_id"), F.col("views_n").alias("views"),
                     F.col("clicks_n").alias("clicks"), F.col("errors_n").alias("errors")))


# -- J8/J9/J10 ------------------------------------------------------------------------
@query("join_left_pred", f"""
WITH {LATEST_ORDER_SQL}
SELECT c.c_custkey AS user_id, lo.o_orderkey AS last_rent_id
FROM customer c LEFT JOIN latest_order lo ON lo.o_custkey = c.c_custkey AND c.c_acctbal > 0""")
def join_left_pred(spark, sf):
    # The left-side predicate stays in the join condition: rows failing it are
    # kept, with NULLs on the right.
    c, lo = table(spark, sf, "customer"), latest_order(spark, sf)
    return (c.join(lo, (lo.o_custkey == c.c_custkey) & (c.c_acctbal > 0), "left")
             .select(F.col("c_custkey").alias("user_id"), F.col("o_orderkey").alias("last_rent_id")))


@query("join_range_residual", f"""
WITH {LATEST_ORDER_SQL}
SELECT c.c_custkey AS user_id, lo.o_orderkey AS big_rent_id
FROM customer c LEFT JOIN latest_order lo
  ON lo.o_custkey = c.c_custkey AND lo.o_totalprice >= c.c_acctbal * 30""")
def join_range_residual(spark, sf):
    c, lo = table(spark, sf, "customer"), latest_order(spark, sf)
    return (c.join(lo, (lo.o_custkey == c.c_custkey) & (lo.o_totalprice >= c.c_acctbal * 30), "left")
             .select(F.col("c_custkey").alias("user_id"), F.col("o_orderkey").alias("big_rent_id")))


@query("join_key_ts", f"""
WITH {LATEST_ORDER_SQL},
gaps AS (SELECT o_custkey, o_orderdate,
                lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev_date
         FROM orders),
react AS (SELECT o_custkey, o_orderdate AS reactivated_at FROM gaps
          WHERE (year(o_orderdate) - year(prev_date)) * 12 + {months('prev_date', 'o_orderdate')} >= 2)
SELECT c.c_custkey AS user_id, lo.o_orderdate AS last_rent_at,
       CASE WHEN r.reactivated_at IS NOT NULL THEN 'Si' ELSE 'No' END AS reactivated
FROM customer c
LEFT JOIN latest_order lo ON lo.o_custkey = c.c_custkey
LEFT JOIN react r ON r.o_custkey = c.c_custkey AND r.reactivated_at = lo.o_orderdate""")
def join_key_ts(spark, sf):
    c, lo = table(spark, sf, "customer"), latest_order(spark, sf)
    o = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    react = (reactivations(o, "o_custkey", "o_orderdate", min_gap=2, tie_break=["o_orderkey"],
                           bucket=F.floor(F.year("o_orderdate") / 4))
             .select(F.col("o_custkey").alias("r_cust"), F.col("o_orderdate").alias("reactivated_at")))
    j = c.join(lo, lo.o_custkey == c.c_custkey, "left")
    j = j.join(react, (F.col("r_cust") == F.col("c_custkey")) & (F.col("reactivated_at") == F.col("o_orderdate")),
               "left")
    return j.select(F.col("c_custkey").alias("user_id"), F.col("o_orderdate").alias("last_rent_at"),
                    yes_no(F.col("reactivated_at").isNotNull()).alias("reactivated"))


# -- J11/J12: renewal chains ----------------------------------------------------------
@query("self_join_parent", f"""
WITH {RENT_TREE_SQL}
SELECT t.rent_id, t.parent_rent_id, p.status AS parent_status,
       CASE WHEN t.parent_rent_id IS NOT NULL THEN 'Si' ELSE 'No' END AS renewal
FROM rent_tree t LEFT JOIN rent_tree p ON p.rent_id = t.parent_rent_id""")
def self_join_parent(spark, sf):
    t = rent_tree(spark, sf)
    parents = t.select(F.col("rent_id").alias("p_id"), F.col("status").alias("parent_status"))
    return (t.join(parents, F.col("p_id") == F.col("parent_rent_id"), "left")
             .select("rent_id", "parent_rent_id", "parent_status",
                     yes_no(F.col("parent_rent_id").isNotNull()).alias("renewal")))


@query("self_join_children", f"""
WITH {RENT_TREE_SQL}
SELECT t.rent_id, CASE WHEN t.rent_id = ch.parent_rent_id AND t.status = 'F' THEN TRUE END AS renewed
FROM rent_tree t LEFT JOIN rent_tree ch ON ch.parent_rent_id = t.rent_id""")
def self_join_children(spark, sf):
    t = rent_tree(spark, sf)
    children = t.select(F.col("parent_rent_id").alias("c_parent"))
    j = t.join(children, F.col("c_parent") == F.col("rent_id"), "left")
    return j.select("rent_id", F.when((F.col("rent_id") == F.col("c_parent")) & (F.col("status") == "F"),
                                      F.lit(True)).alias("renewed"))


@query("hierarchy_rollup", f"""
WITH {RENT_TREE_SQL},
line AS (SELECT DISTINCT l_orderkey AS rent_id, l_orderkey AS source FROM lineitem
         UNION ALL SELECT rent_id, parent_rent_id FROM rent_tree
         UNION ALL SELECT c.rent_id, p.parent_rent_id FROM rent_tree c JOIN rent_tree p ON p.rent_id = c.parent_rent_id)
SELECT rent_id, CAST(round(sum(CAST(l_extendedprice AS DECIMAL(18,2)))) AS DOUBLE) AS historic_deposit
FROM line JOIN lineitem ON l_orderkey = source
WHERE rent_id IN (SELECT l_orderkey FROM lineitem) GROUP BY rent_id""")
def hierarchy_rollup(spark, sf):
    dep = (table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("rent_id"))
           .agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("deposit")))
    rolled = rollup_ancestors(dep, "rent_id", "deposit", rent_tree(spark, sf), "rent_id", "parent_rent_id",
                              depth=2, name="historic_deposit")
    return rolled.select("rent_id", F.round("historic_deposit").cast("double").alias("historic_deposit"))


# -- U1/U2/A12 ----------------------------------------------------------------------
@query("union_distinct", """
SELECT DISTINCT user_id FROM (
  SELECT user_id FROM events UNION ALL SELECT o_custkey FROM orders
  UNION ALL SELECT nullif(c_custkey, 0) FROM customer)""")
def union_distinct(spark, sf):
    c = table(spark, sf, "customer").select(F.nullif("c_custkey", F.lit(0)).alias("k"))
    return population((table(spark, sf, "events"), "user_id"), (table(spark, sf, "orders"), "o_custkey"),
                      (c, "k"), name="user_id")


@query("duplicate_keys", """
SELECT l_orderkey AS rent_id, l_suppkey AS owner_id, l_linenumber AS line
FROM lineitem WHERE (l_orderkey, l_suppkey) IN (SELECT (l_orderkey, l_suppkey) FROM lineitem
                                                GROUP BY l_orderkey, l_suppkey HAVING count(*) > 1)""")
def duplicate_keys_q(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("rent_id"), F.col("l_suppkey").alias("owner_id"),
                                             F.col("l_linenumber").alias("line"))
    return duplicate_keys(li, ["rent_id", "owner_id"])
