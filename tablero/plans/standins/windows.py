"""Windows W1..W10 over the status log and the per-key pickers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tablero.functions import as_of_lit, day_boundaries, first_match, split_part, to_local, yes_no
from tablero.operators import (any_one_per_key, entered, first_and_last, first_per_key, latest_per_key,
                               lookup, moved, transition_summary, transitions, with_last_match, with_previous)
from tablero.operators.history import boundary_gap_months
from tablero.plans.standins.common import (EVENTS_AS_OF, STATUS_LOG_SQL, loc, months, query, status_log,
                                           table, ts_lit)

DAY = F.to_date  # bucket of a log row: its UTC day


def _history(spark, sf):
    """Status log with the previous status (LAG over the UTC time, as the log
    CTE does) and the local time."""
    log = status_log(spark, sf)
    h = with_previous(log, "home_id", ["created_at"], ["status", "created_at"], tie_break=["log_id"],
                      bucket=DAY("created_at"))
    return h.withColumn("local_at", to_local("created_at"))


HISTORY_SQL = f"""{STATUS_LOG_SQL},
history AS (SELECT home_id, log_id, created_at, {loc('created_at')} AS local_at, status, changed_by_id, reason,
                   value,
                   lag(status) OVER (PARTITION BY home_id ORDER BY created_at, log_id) AS previous_status,
                   lag(created_at) OVER (PARTITION BY home_id ORDER BY created_at, log_id) AS previous_created_at
            FROM status_log)"""

PUBLISHED_SQL = """published AS (SELECT home_id, log_id, local_at AS published_at, changed_by_id FROM history
              WHERE (previous_status IS NULL OR previous_status != 'published') AND status = 'published')"""


def _published(spark, sf):
    h = _history(spark, sf)
    return (h.filter(entered("status", "previous_status", ["published"]))
             .select("home_id", "log_id", F.col("local_at").alias("published_at"), "changed_by_id"))


@query("prev_state", f"""
WITH {HISTORY_SQL}
SELECT home_id, log_id, local_at AS created_at, status, previous_status,
       previous_created_at AS previous_published_at
FROM history""")
def prev_state(spark, sf):
    # The previous time is the source (UTC) column, as in the log CTE where
    # the converted alias does not shadow the LAG argument.
    h = _history(spark, sf)
    return h.select("home_id", "log_id", F.col("local_at").alias("created_at"), "status", "previous_status",
                    F.col("previous_created_at").alias("previous_published_at"))


@query("transition_into", f"""
WITH {HISTORY_SQL}, {PUBLISHED_SQL}
SELECT home_id, log_id, published_at, changed_by_id FROM published""")
def transition_into(spark, sf):
    into = transitions(status_log(spark, sf), "home_id", ["created_at"], "status",
                       lambda now, before: entered(now, before, ["published"]), tie_break=["log_id"],
                       bucket=DAY("created_at"))
    return into.select("home_id", "log_id", to_local("created_at").alias("published_at"), "changed_by_id")


@query("transition_from_to", f"""
WITH {HISTORY_SQL},
fp AS (SELECT home_id, local_at FROM (
         SELECT home_id, local_at, row_number() OVER (PARTITION BY home_id ORDER BY local_at, log_id) AS rn
         FROM history WHERE previous_status = 'in_progress' AND status = 'pending_approval') WHERE rn = 1),
lp AS (SELECT home_id, local_at FROM (
         SELECT home_id, local_at,
                row_number() OVER (PARTITION BY home_id ORDER BY local_at DESC NULLS FIRST, log_id DESC) AS rn
         FROM history WHERE previous_status IN ('in_progress', 'rented') AND status = 'pending_approval')
       WHERE rn = 1)
SELECT c.c_custkey AS home_id, fp.local_at AS first_pending_at, lp.local_at AS last_pending_at
FROM customer c LEFT JOIN fp ON fp.home_id = c.c_custkey LEFT JOIN lp ON lp.home_id = c.c_custkey""")
def transition_from_to(spark, sf):
    h = _history(spark, sf)
    picks = transition_summary(h, "home_id", ["local_at"], tie_break=["log_id"], specs={
        "first_pending": (moved("status", "previous_status", ["in_progress"], ["pending_approval"]), "first",
                          ["local_at"]),
        "last_pending": (moved("status", "previous_status", ["in_progress", "rented"], ["pending_approval"]),
                         "last", ["local_at"]),
    })
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("home_id"))
    return (c.join(picks, "home_id", "left")
             .select("home_id", F.col("first_pending_local_at").alias("first_pending_at"),
                     F.col("last_pending_local_at").alias("last_pending_at")))


@query("first_last_transition", f"""
WITH {HISTORY_SQL}, {PUBLISHED_SQL},
ranked AS (SELECT *, row_number() OVER (PARTITION BY home_id ORDER BY published_at, log_id) AS rn_first,
                  row_number() OVER (PARTITION BY home_id ORDER BY published_at DESC NULLS FIRST, log_id DESC) AS rn_last
           FROM published)
SELECT f.home_id, f.published_at AS first_published_at, uf.c_name AS first_agent,
       l.published_at AS last_published_at, ul.c_name AS last_agent
FROM ranked f JOIN ranked l ON l.home_id = f.home_id AND l.rn_last = 1
LEFT JOIN customer uf ON uf.c_custkey = f.changed_by_id
LEFT JOIN customer ul ON ul.c_custkey = l.changed_by_id
WHERE f.rn_first = 1""")
def first_last_transition(spark, sf):
    fl = first_and_last(_published(spark, sf), "home_id", ["published_at"], tie_break=["log_id"],
                        columns=["published_at", "changed_by_id"])
    users = table(spark, sf, "customer")
    fl = lookup(fl, users, "first_changed_by_id", "c_custkey", {"first_agent": "c_name"})
    fl = lookup(fl, users, "last_changed_by_id", "c_custkey", {"last_agent": "c_name"})
    return fl.select("home_id", "first_published_at", "first_agent", "last_published_at", "last_agent")


@query("reactivation_gap", f"""
WITH pubs AS (SELECT o_custkey, o_orderkey, o_orderdate,
                     lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS previous_at
              FROM orders WHERE o_orderstatus = 'F')
SELECT o_custkey AS home_id, o_orderkey AS rent_id, o_orderdate AS reactivated_at, previous_at,
       (year(o_orderdate) - year(previous_at)) * 12 + {months('previous_at', 'o_orderdate')} AS gap
FROM pubs
WHERE (year(o_orderdate) - year(previous_at)) * 12 + {months('previous_at', 'o_orderdate')} >= 2""")
def reactivation_gap(spark, sf):
    # the last order with this status before each such order, carried through all orders in one pass
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    h = with_last_match(o, "o_custkey", ["o_orderdate"], "o_orderstatus", lambda status, before: status == "F", ["o_orderdate"],
                        tie_break=["o_orderkey"], bucket=F.floor(F.year("o_orderdate") / 4), match_prefix="prev_")
    r = h.filter(F.col("matches") & (boundary_gap_months("prev_o_orderdate", "o_orderdate") >= 2))
    return r.select(F.col("o_custkey").alias("home_id"), F.col("o_orderkey").alias("rent_id"),
                    F.col("o_orderdate").alias("reactivated_at"), F.col("prev_o_orderdate").alias("previous_at"),
                    boundary_gap_months("prev_o_orderdate", "o_orderdate").alias("gap"))


# -- W3/B3 on the log itself: the last publication, whose own rule needs the LAG --------
@query("carried_publication", f"""
WITH {HISTORY_SQL}, {PUBLISHED_SQL},
before AS (SELECT *, lag(published_at) OVER w AS last_published_at, lag(changed_by_id) OVER w AS last_changed_by
           FROM published WINDOW w AS (PARTITION BY home_id ORDER BY published_at, log_id))
SELECT home_id, log_id, published_at, last_published_at, last_changed_by,
       date_diff('day', CAST(last_published_at AS DATE), CAST(published_at AS DATE)) AS days_between FROM before""")
def carried_publication(spark, sf):
    log = status_log(spark, sf).withColumn("local_at", to_local("created_at"))
    h = with_last_match(log, "home_id", ["created_at"], "status", lambda now, before: entered(now, before, ["published"]),
                        ["local_at", "changed_by_id"], tie_break=["log_id"], bucket=DAY("created_at"))
    return h.filter("matches").select(
        "home_id", "log_id", F.col("local_at").alias("published_at"), F.col("last_match_local_at").alias("last_published_at"),
        F.col("last_match_changed_by_id").alias("last_changed_by"),
        day_boundaries("last_match_local_at", "local_at").alias("days_between"))


TAKEDOWN_STATES = ["canceled", "unpublished", "temporarily_canceled"]


@query("latest_takedown", f"""
WITH {HISTORY_SQL},
down AS (SELECT home_id, local_at, status, reason FROM (
           SELECT *, row_number() OVER (PARTITION BY home_id ORDER BY local_at DESC NULLS FIRST, log_id DESC) AS rn
           FROM history
           WHERE status != previous_status AND status IN ('canceled', 'unpublished', 'temporarily_canceled'))
         WHERE rn = 1)
SELECT home_id, local_at AS taken_down_at, status,
       split_part(split_part(reason, '{{', 2), ': ', 1) AS takedown_reason,
       split_part(split_part(reason, '{{', 2), ': ', 2) AS takedown_comment
FROM down""")
def latest_takedown(spark, sf):
    h = _history(spark, sf)
    down = latest_per_key(h.filter(entered("status", "previous_status", TAKEDOWN_STATES, first_row_counts=False)),
                          "home_id", ["local_at"], tie_break=["log_id"], columns=["local_at", "status", "reason"])
    body = split_part("reason", "{", 2)
    return down.select("home_id", F.col("local_at").alias("taken_down_at"), "status",
                       split_part(body, ": ", 1).alias("takedown_reason"),
                       split_part(body, ": ", 2).alias("takedown_comment"))


@query("previous_value_at_latest", f"""
WITH {STATUS_LOG_SQL},
priced AS (SELECT home_id, log_id, created_at, value,
                  lag(value) OVER (PARTITION BY home_id ORDER BY created_at, log_id) AS previous_price
           FROM status_log
           WHERE value IS NOT NULL AND {loc('created_at')} >= DATE '2024-01-05'
             AND {loc('created_at')} <= {ts_lit(EVENTS_AS_OF)}),
latest AS (SELECT *, row_number() OVER (PARTITION BY home_id ORDER BY created_at DESC NULLS FIRST, log_id DESC) AS rn
           FROM priced)
SELECT home_id, previous_price, value AS current_price, {loc('created_at')} AS change_date
FROM latest WHERE rn = 1""")
def previous_value_at_latest(spark, sf):
    log = status_log(spark, sf)
    local = to_local("created_at")
    # the raw bounds, a day wider than any zone's offset, reach the scan
    window = (F.col("home_id").isNotNull() & F.col("value").isNotNull()
              & (F.col("created_at") >= F.lit("2024-01-04").cast("timestamp_ntz"))
              & (F.col("created_at") <= as_of_lit(EVENTS_AS_OF + dt.timedelta(days=1)))
              & (local >= F.lit("2024-01-05").cast("timestamp_ntz"))
              & (local <= as_of_lit(EVENTS_AS_OF)))
    priced = with_previous(log.filter(window), "home_id", ["created_at"], ["value"], tie_break=["log_id"],
                           bucket=DAY("created_at"))
    latest = latest_per_key(priced, "home_id", ["created_at"], tie_break=["log_id"],
                            columns=["previous_value", "value", "created_at"])
    return latest.select("home_id", F.col("previous_value").alias("previous_price"),
                         F.col("value").alias("current_price"), to_local("created_at").alias("change_date"))


# -- W5..W8: one row per key ------------------------------------------------------
@query("first_per_key", """
SELECT o_custkey AS user_id, o_orderkey AS rent_id, o_orderdate AS created_at, o_totalprice AS price FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
WHERE rn = 1""")
def first_per_key_q(spark, sf):
    o = table(spark, sf, "orders")
    f = first_per_key(o, "o_custkey", ["o_orderdate"], tie_break=["o_orderkey"],
                      columns=["o_orderkey", "o_orderdate", "o_totalprice"])
    return f.select(F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("rent_id"),
                    F.col("o_orderdate").alias("created_at"), F.col("o_totalprice").alias("price"))


@query("latest_per_key", """
SELECT user_id, rent_id, created_at FROM (
  SELECT o_custkey AS user_id, o_orderkey AS rent_id,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS created_at,
         row_number() OVER (PARTITION BY o_custkey
                            ORDER BY CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END DESC NULLS FIRST,
                                     o_orderkey DESC) AS rn
  FROM orders)
WHERE rn = 1""")
def latest_per_key_q(spark, sf):
    o = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("rent_id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("created_at"))
    return latest_per_key(o, "user_id", ["created_at"], tie_break=["rent_id"])


@query("latest_per_composite_key", """
SELECT l_orderkey AS rent_id, l_returnflag AS flag, l_linenumber AS month_no, l_shipdate AS paid_at,
       l_extendedprice AS amount FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_returnflag
            ORDER BY l_shipdate DESC NULLS FIRST, l_linenumber DESC, l_partkey DESC, l_suppkey DESC,
                     l_extendedprice DESC) AS rn
  FROM lineitem)
WHERE rn = 1""")
def latest_per_composite_key(spark, sf):
    li = table(spark, sf, "lineitem")
    p = latest_per_key(li, ["l_orderkey", "l_returnflag"], ["l_shipdate"],
                       tie_break=["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"],
                       columns=["l_linenumber", "l_shipdate", "l_extendedprice"])
    return p.select(F.col("l_orderkey").alias("rent_id"), F.col("l_returnflag").alias("flag"),
                    F.col("l_linenumber").alias("month_no"), F.col("l_shipdate").alias("paid_at"),
                    F.col("l_extendedprice").alias("amount"))


@query("any_one_per_key", """
SELECT s_nationkey AS country_id, s_name AS advisor, s_acctbal AS balance, s_suppkey AS advisor_id FROM (
  SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_name, s_acctbal, s_suppkey) AS rn FROM supplier)
WHERE rn = 1""")
def any_one_per_key_q(spark, sf):
    s = table(spark, sf, "supplier")
    a = any_one_per_key(s, "s_nationkey", columns=["s_name", "s_acctbal", "s_suppkey"])
    return a.select(F.col("s_nationkey").alias("country_id"), F.col("s_name").alias("advisor"),
                    F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("advisor_id"))


# -- flagship: home history summary (entry) -----------------------------------------
@query("home_history", f"""
WITH {HISTORY_SQL}, {PUBLISHED_SQL},
pub AS (SELECT home_id,
               min(published_at) AS first_published_at, max(published_at) AS last_published_at,
               count(*) AS publications FROM published GROUP BY home_id),
latest_state AS (SELECT home_id, status FROM (
    SELECT home_id, status,
           row_number() OVER (PARTITION BY home_id ORDER BY created_at DESC NULLS FIRST, log_id DESC) AS rn
    FROM history) WHERE rn = 1),
down AS (SELECT home_id, local_at FROM (
    SELECT *, row_number() OVER (PARTITION BY home_id ORDER BY local_at DESC NULLS FIRST, log_id DESC) AS rn
    FROM history WHERE status != previous_status AND status IN ('canceled', 'unpublished', 'temporarily_canceled'))
  WHERE rn = 1)
SELECT c.c_custkey AS home_id,
       CASE WHEN s.status = 'rented' THEN 'Rentado' WHEN s.status = 'in_progress' THEN 'En progreso'
            WHEN s.status = 'published' THEN 'Publicado' WHEN s.status = 'canceled' THEN 'Baja temporal'
            WHEN s.status = 'pending_approval' THEN 'Pendiente por aprobar' END AS status_label,
       p.first_published_at, p.last_published_at, CAST(p.publications AS BIGINT) AS publications,
       d.local_at AS taken_down_at,
       CASE WHEN s.status = 'published' THEN date_diff('day', CAST(p.last_published_at AS DATE),
                                                       CAST({ts_lit(EVENTS_AS_OF)} AS DATE))
            WHEN s.status = 'canceled' THEN date_diff('day', CAST(p.last_published_at AS DATE), CAST(d.local_at AS DATE))
            ELSE 0 END AS days_online,
       CASE WHEN p.publications > 1 THEN 'Si' ELSE 'No' END AS republished
FROM customer c
LEFT JOIN latest_state s ON s.home_id = c.c_custkey
LEFT JOIN pub p ON p.home_id = c.c_custkey
LEFT JOIN down d ON d.home_id = c.c_custkey""")
def home_history(spark, sf):
    h = _history(spark, sf)
    pub = entered("status", "previous_status", ["published"])
    # publications counted and every pick taken in one aggregation over the log
    picks = transition_summary(h, "home_id", ["created_at"], tie_break=["log_id"], specs={
        "state": (F.lit(True), "last", ["status"]),
        "down": (entered("status", "previous_status", TAKEDOWN_STATES, first_row_counts=False), "last",
                 ["local_at"], ["local_at"]),
    }, extra={"first_published_at": F.min(F.when(pub, F.col("local_at"))),
              "last_published_at": F.max(F.when(pub, F.col("local_at"))),
              "n_pub": F.count(F.when(pub, F.lit(1)))})
    picks = picks.select("home_id", F.col("state_status").alias("status"),
                         F.col("down_local_at").alias("taken_down_at"), "first_published_at", "last_published_at",
                         F.when(F.col("n_pub") > 0, F.col("n_pub")).alias("publications"))
    homes = table(spark, sf, "customer").select(F.col("c_custkey").alias("home_id"))
    j = homes.join(picks, "home_id", "left")
    st = F.col("status")
    label = first_match((st == "rented", F.lit("Rentado")), (st == "in_progress", F.lit("En progreso")),
                        (st == "published", F.lit("Publicado")), (st == "canceled", F.lit("Baja temporal")),
                        (st == "pending_approval", F.lit("Pendiente por aprobar")))
    days = first_match((st == "published", day_boundaries("last_published_at", as_of_lit(EVENTS_AS_OF))),
                       (st == "canceled", day_boundaries("last_published_at", "taken_down_at")),
                       default=F.lit(0))
    return j.select("home_id", label.alias("status_label"), "first_published_at", "last_published_at",
                    "publications", "taken_down_at", days.alias("days_online"),
                    yes_no(F.col("publications") > 1).alias("republished"))
