"""Fan-out diagnostics.

The reports keep the duplicate rows a one-to-many lookup produces, as the
source does. These checks say where that happens: the lookup keys the
reports join on, with every key value that occurs more than once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values: (table, key column) pairs the reports look rows up by.
LOOKUP_KEYS = [
    ("mongo_users", "_id"),
    ("mongo_users", "id"),
    ("mongo_owners", "_id"),
    ("mongo_homes", "_id"),
    ("mongo_homes", "id"),
    ("mongo_home_advisors", "_id"),
    ("mongo_home_advisors", "user_id"),
    ("mongo_home_features", "home_id"),
    ("mongo_homes_recommended_price", "mongo_homes_id"),
    ("mongo_rents", "_id"),
    ("mongo_rent_contracts", "rent_id"),
    ("mongo_rental_months", "_id"),
    ("mongo_rental_months", "id"),
    ("mongo_rental_months_payment_method_fee", "mongo_rental_months_id"),
    ("mongo_home_applications", "_id"),
    ("mongo_home_applications_home_application_income", "mongo_home_applications_id"),
    ("mongo_guarantee_deposit_schemes", "_id"),
    ("mongo_agencies", "_id"),
    ("postgres_users", "id"),
    ("postgres_countries", "id"),
    ("webscraping.postgres_rents_response", "postgres_rents_id"),
]


def lookup_key_duplicates(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, key_column, key, rows) for every lookup key value held by more
    than one row: each such value multiplies the report rows that join it.
    One aggregation per table (combined map-side), no rows collected."""
    parts = []
    for table, key in LOOKUP_KEYS:
        if table not in tables:
            continue
        counted = (tables[table].groupBy(F.col(key).cast("string").alias("key"))
                   .agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1))
        parts.append(counted.select(F.lit(table).alias("table"), F.lit(key).alias("key_column"), "key", "rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
