"""R7 / R10 scraped listings, cleansed, with their feature lists."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablero.operators import clean_listings, list_join
from tablero.plans.reports._common import sort_then_label

# Output columns of the main-site listing report, in order.
RENTS_COLUMNS = [
    ("id", "id"), ("date_in", "created_at"), ("site", "site"), ("title", "title"), ("content", "description"),
    ("url", "url"), ("state", "state"), ("city", "city"), ("neighborhood", "neighborhood"), ("price", "price"),
    ("price_maintenance", "price_maintenance"), ("covered_area", "covered_area"), ("land_area", "land_area"),
    ("rooms", "rooms"), ("bathrooms", "bathrooms"), ("parking", "parking"), ("half_bathrooms", "half_bathrooms"),
    ("antiquity", "antiquity"), ("price_x_mt2", "price_x_mt2"), ("post_age", "post_age"),
    ("pictures", "pictures"), ("latitude", "latitude"), ("longitude", "longitude"),
    ("extra_features", "extra_features"),
]

# Output columns of the second-site listing report, in order.
I24_COLUMNS = [
    ("id", "id"), ("date_in", "created_at"), ("title", "title"), ("description", "description"), ("url", "url"),
    ("state", "state"), ("city", "city"), ("neighborhood", "neighborhood"), ("price", "price"),
    ("price_maintenance", "price_maintenance"), ("price_no_maint", "price_no_maint"),
    ("covered_area", "covered_area"), ("land_area", "land_area"), ("rooms", "rooms"), ("bathrooms", "bathrooms"),
    ("parking", "parking"), ("half_bathrooms", "half_bathrooms"), ("antiquity", "antiquity"),
    ("post_age", "post_age"), ("latitude", "latitude"), ("longitude", "longitude"),
    ("query_search", "query_search"), ("extra_features", "extra_features"),
]


def build_rents(tables: Mapping[str, DataFrame], as_of=None, ordered: bool = True) -> DataFrame:
    """R7: main-site listings with response text and features."""
    rents = clean_listings(tables["webscraping.postgres_rents"], required=["state", "city"])
    response = tables["webscraping.postgres_rents_response"]
    features = list_join(tables["webscraping.postgres_rents_extra_features"], "postgres_rents_id", "value",
                         sep=", ", name="extra_features").withColumnRenamed("postgres_rents_id", "f_id")
    j = (rents.join(response, rents.id == response.postgres_rents_id, "left")
              .join(features, rents.id == F.col("f_id"), "left"))
    out = j.select(*[rents[c] if c in rents.columns else F.col(c) for c, _ in RENTS_COLUMNS])
    return sort_then_label(out, RENTS_COLUMNS, [F.col("date_in").desc_nulls_first()], ordered)


def build_i24(tables: Mapping[str, DataFrame], as_of=None, ordered: bool = True) -> DataFrame:
    """R10: second-site listings with a positive price without maintenance."""
    rents = clean_listings(tables["webscraping.postgres_rents_i24"], required=["state", "city"],
                           positive=["price_no_maint"])
    features = list_join(tables["webscraping.postgres_rents_i24_extra_features"], "postgres_rents_i24_id", "value",
                         sep=", ", name="extra_features").withColumnRenamed("postgres_rents_i24_id", "f_id")
    j = rents.join(features, rents.id == F.col("f_id"), "left")
    out = j.select(*[c for c, _ in I24_COLUMNS])
    return sort_then_label(out, I24_COLUMNS, [F.col("date_in").desc_nulls_first()], ordered)
