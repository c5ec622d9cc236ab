"""Inputs and outputs: schemas, table catalogs, sinks."""

from tablero.sources.catalog import (Tables, driver_table, from_catalog, from_frames, from_parquet, month_of, publish,
                                     within)
from tablero.sources.schemas import SCHEMAS
from tablero.sources.sinks import Receipt, receipt, replace_result, with_position, write_parquet
from tablero.sources.staging import Staging, shared_dir

__all__ = ["SCHEMAS", "Receipt", "Staging", "Tables", "driver_table", "from_catalog", "from_frames", "from_parquet", "month_of",
           "publish", "receipt", "replace_result", "shared_dir", "with_position", "within", "write_parquet"]
