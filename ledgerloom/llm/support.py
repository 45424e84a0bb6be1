"""Small helpers that the operators of this package share."""

from __future__ import annotations

import base64
import ctypes
import gc
import io
import os
import zipfile
from collections.abc import Iterable
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import new_path

#: Rows of one Arrow batch.
BATCH_ROWS = 500
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


def release_memory() -> None:
    """Give back what a worker still holds from earlier tasks: workers are used again, and neither the
    allocator nor Arrow's pool returns free pages by itself."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark so that any store will do."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def unused(columns: Iterable[str], base: str) -> str:
    """`base`, with underscores added until no column has that name (case ignored)."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col(f"`{name}`")


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo `folds`; a null key is in fold 0."""
    return F.coalesce(F.crc32(key.cast("string")) % folds, F.lit(0))


@lru_cache(maxsize=2)
def letter_table(size: int = 1 << 16):
    """For each code point below `size`, whether it is a letter. A rule, not a stored table."""
    return np.fromiter((chr(i).isalpha() for i in range(size)), dtype=bool, count=size)


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def range_bounds(df: DataFrame, key: str, descending: bool = False, parts: int | None = None) -> list:
    """The first key of each of `parts` ranges of about equal row counts, in order; nulls belong
    to the end of the last range. Only the key column is read and shuffled, and one value per
    range reaches the driver. Ranges are whole: equal keys never stand in two of them."""
    order = col(key).desc_nulls_last() if descending else col(key).asc_nulls_last()
    parts = parts or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = F.max(col(key)) if descending else F.min(col(key))
    rows = (
        df.select(col(key)).where(col(key).isNotNull()).repartitionByRange(parts, order)
        .groupBy(F.spark_partition_id().alias("_part")).agg(first.alias("_first")).collect()
    )
    return sorted((r["_first"] for r in rows), reverse=descending)


def range_of(key: Column, bounds: list, descending: bool = False) -> Column:
    """The position of the range that a key belongs to; a null key belongs to the last one."""
    return F.pandas_udf(lambda keys: range_positions(keys, bounds, descending), "int")(key)


def range_positions(keys: pd.Series, bounds: list, descending: bool = False) -> pd.Series:
    """The same on a column that is at hand."""
    edges = sorted(bounds)
    last = max(len(edges) - 1, 0)
    found = np.full(len(keys), last)
    known = keys.notna().to_numpy()
    if known.any() and edges:
        values = keys[known].to_numpy().astype(np.asarray(edges).dtype)
        if descending:
            found[known] = len(edges) - 1 - (np.searchsorted(edges, values, side="left"))
        else:
            found[known] = np.searchsorted(edges, values, side="right") - 1
    return pd.Series(np.clip(found, 0, last).astype("int32"))


def ship_file(spark: SparkSession, path: str) -> str:
    """Hand a driver's file to all executors; `shipped` finds it there by the name returned."""
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def shipped(name: str) -> str:
    """Where a file that `ship_file` handed out lies on this machine. A path stays as it is."""
    return name if os.path.isabs(name) else SparkFiles.get(name)


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors, which need not have it installed. Its zip file is
    written to the shared folder and added to the application once."""
    context = spark.sparkContext
    # whole texts go to Python: fewer of them at a time than of narrow rows
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if getattr(context, "_ledgerloom_shipped", False):
        return
    root = Path(__file__).resolve().parent.parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, path.relative_to(root.parent))
    target = new_path(spark, "package") + "/ledgerloom.zip"
    place = spark._jvm.org.apache.hadoop.fs.Path(target)
    stream = place.getFileSystem(context._jsc.hadoopConfiguration()).create(place)
    stream.write(bytearray(packed.getvalue()))
    stream.close()
    context.addPyFile(target)
    context._ledgerloom_shipped = True
