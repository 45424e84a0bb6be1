"""Tables that are replaced as a whole: new files first, then one manifest that names them.

Below a folder lie `data/<load>/<table>` and `manifests/<number>`. A load writes all its tables, and
the manifest appears last, by one rename that fails if another load took the number. Readers follow
the newest manifest, so a load that dies half way leaves the tables of the load before it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def _system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def manifests(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of the finished loads, ascending."""
    system, place = _system(spark, f"{folder}/manifests")
    if not system.exists(place):
        return []
    names = (s.getPath().getName() for s in system.listStatus(place))
    return sorted(int(n) for n in names if n.isdigit())


def _manifest(spark: SparkSession, folder: str, number: int) -> dict:
    text = spark.read.option("wholetext", True).text(f"{folder}/manifests/{number}").first()["value"]
    return json.loads(text)


def write_tables(tables: Mapping[str, DataFrame], folder: str, keep: int = 2) -> int:
    """Write a load of one or more tables and make it the current one. The last `keep` loads stay
    readable, the files of older and of unfinished loads before them are removed. Returns its number."""
    spark = next(iter(tables.values())).sparkSession
    load = uuid.uuid4().hex
    for name, df in tables.items():
        df.write.parquet(f"{folder}/data/{load}/{name}")
    number = (manifests(spark, folder) or [0])[-1] + 1
    system, new = _system(spark, f"{folder}/manifests/.{load}")
    out = system.create(new)
    out.write(bytearray(json.dumps({"load": load, "tables": sorted(tables)}).encode()))
    out.close()
    _, target = _system(spark, f"{folder}/manifests/{number}")
    if system.exists(target) or not system.rename(new, target):
        raise RuntimeError(f"another load of {folder} finished first; load again")
    _remove_old(spark, folder, keep)
    return number


def _remove_old(spark: SparkSession, folder: str, keep: int) -> None:
    numbers = manifests(spark, folder)
    for number in numbers[:-keep]:
        load = _manifest(spark, folder, number)["load"]
        for path in (f"{folder}/manifests/{number}", f"{folder}/data/{load}"):
            system, place = _system(spark, path)
            system.delete(place, True)


def read_table(spark: SparkSession, folder: str, name: str, number: int | None = None) -> DataFrame:
    """A table of the current load, or of the load of that number."""
    found = manifests(spark, folder)
    if not found:
        raise FileNotFoundError(f"no load of {folder} has finished")
    manifest = _manifest(spark, folder, number or found[-1])
    if name not in manifest["tables"]:
        raise KeyError(f"the load has no table {name}: {manifest['tables']}")
    return spark.read.parquet(f"{folder}/data/{manifest['load']}/{name}")
