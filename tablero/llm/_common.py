"""Shared pieces of the training-data operators: table reading, Arrow text
access and tables written to the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that ends a word in every contract of this package: space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``. Only a local-mode session
    that names none (tests) gets a temporary one; a cluster must name it."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="tablero-shared-")
        sc.setCheckpointDir(named)
    return named


class Scratch:
    """Tables written as Parquet under the shared folder: they cut lineage, so
    a lost executor only repeats work since the last written table."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete a table that no later step reads."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_key(col) -> F.Column:
    """128-bit digest of a text (null as empty) as binary."""
    return F.unhex(F.substring(F.sha2(F.coalesce(col, F.lit("")), 256), 1, 32))


def lower_ascii(col) -> F.Column:
    """A-Z in lower case and no other letter changed; null as empty."""
    text = F.coalesce(col, F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    # lower() is the faster of the two and the same on texts of ASCII only
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def fresh(taken, name: str) -> str:
    """``name``, lengthened until no column of ``taken`` has it (case ignored)."""
    have = {c.lower() for c in taken}
    while name.lower() in have:
        name += "_"
    return name


def others(columns, *names: str) -> list[F.Column]:
    """Columns by their exact names, dots included, but those called like one of
    ``names`` in any case."""
    gone = {n.lower() for n in names}
    return [F.col("`" + c.replace("`", "``") + "`") for c in columns if c.lower() not in gone]


def texts_of(col: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each value; null as empty."""
    if pa.types.is_string_view(col.type):
        col = col.cast(pa.string())
    binary = col.cast(pa.large_binary() if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else pa.binary())
    return [b"" if v is None else v for v in binary.to_pylist()]


def slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20):
    """The batch in zero-copy slices of about ``most`` bytes of text (one row at
    least), so that Python copies of long texts stay bounded."""
    col = batch.column(batch.schema.get_field_index(column))
    sizes = np.asarray(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def local_env() -> None:
    """One thread for native libraries inside a task."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
