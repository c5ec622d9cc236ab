"""R12 promotion codes: one row per code (by its six display columns) with
the numbered use trail."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablero import DEFAULT_TZ
from tablero.functions import is_true, to_local
from tablero.operators import list_join, number_rows
from tablero.plans.reports._common import sort_then_label, time_bucket

# Output labels, in report order.
LABELS = [
    ("code", "Codigo"),
    ("created_at", "Fecha de Creación"),
    ("due_date", "Fecha de Vencimiento"),
    ("agency", "Agencia"),
    ("is_used", "Es usado"),
    ("used_times", "Cantidad de usos"),
    ("uses", "Usos"),
]

GROUP = ["code", "created_at", "due_date", "agency", "is_used", "used_times"]


def build(tables: Mapping[str, DataFrame], as_of=None, tz: str = DEFAULT_TZ, ordered: bool = True,
          bucket_unit: str = "day") -> DataFrame:
    codes = tables["mongo_promotion_codes"]
    agencies = tables["mongo_agencies"].select(F.col("_id").alias("agency_key"), F.col("name").alias("agency_name"))
    logs = tables["mongo_promotion_code_logs"]
    promos = codes.join(agencies, F.col("agency_key") == codes.agency_id, "left").select(
        codes.code, to_local(codes.created_at, tz).alias("created_at"), to_local(codes.due_date, tz).alias("due_date"),
        F.when(codes.agency_id.isNotNull(), F.col("agency_name")).otherwise(F.lit("homie")).alias("agency"),
        codes.is_used, F.when(is_true(codes.is_used), codes.used_times).otherwise(F.lit(0)).alias("used_times"),
        codes._id.alias("use_promo"))
    # Uses are numbered per code (promos sharing a code share one sequence), by
    # use time; equal times are ordered by application, promo id and columns. As
    # in the source each pair of a use and a promotion row has its own number, so
    # the pairs carry their promotion's columns and are not joined to it again;
    # a use without a time is never printed.
    pairs = (logs.filter(F.col("used_at").isNotNull())
                 .select(F.col("promotion_code_id").alias("use_promo"), "used_at", "home_application_id").join(promos, "use_promo"))
    numbered = number_rows(pairs, "code", ["used_at"], tie_break=["home_application_id", "use_promo", *GROUP[1:]], name="n",
                           bucket=time_bucket("used_at", bucket_unit))
    uses = numbered.select(*GROUP, "n", F.concat(F.col("n").cast("string"), F.lit(".- "), to_local("used_at", tz).cast("string"),
                                                 F.lit(", "), F.col("home_application_id")).alias("use"))
    none = promos.select(*GROUP, F.lit(None).cast("bigint").alias("n"), F.lit(None).cast("string").alias("use"))
    rows = uses.unionByName(none)  # every promotion, used or not
    # a code's uses are sorted and joined a thousand numbers at a time
    grouped = list_join(rows, GROUP, "use", order_by=["n"], sep=" / ", name="uses", bucket=F.floor(F.col("n") / 1000))
    return sort_then_label(grouped, LABELS, [F.col("created_at").desc_nulls_first()], ordered)
