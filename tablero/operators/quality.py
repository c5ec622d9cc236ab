"""Data-quality operators: uniqueness diagnostics and listing cleansing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablero.operators._cols import as_list


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Rows whose key occurs more than once (the rows a lookup on this key
    would fan out on). Returned as a DataFrame; nothing is collected."""
    keys = as_list(keys)
    dups = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_dk_n")).filter(F.col("_dk_n") > 1)
              .select(*[F.col(k).alias(f"_dk_{i}") for i, k in enumerate(keys)]))
    cond = [F.col(k) == F.col(f"_dk_{i}") for i, k in enumerate(keys)]
    return df.join(dups, on=cond, how="left_semi")


def clean_listings(df: DataFrame, required: Sequence[str], lat: str = "latitude",
                   lon: str = "longitude", positive: Sequence[str] = ()) -> DataFrame:
    """Keep listings with every required field present, coordinates within
    |lat| <= 90 and |lon| <= 180, and each ``positive`` column > 0."""
    cond = F.lit(True)
    for c in list(required) + [lat, lon]:
        cond = cond & F.col(c).isNotNull()
    cond = cond & (F.abs(F.col(lat)) <= 90) & (F.abs(F.col(lon)) <= 180)
    for c in positive:
        cond = cond & (F.col(c) > 0)
    return df.filter(cond)
