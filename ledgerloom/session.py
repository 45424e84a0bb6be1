"""Session settings and durable hand-over between the passes of one job."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Spark then removes what a query shuffled when the query ends, not when the driver next collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_scope: ContextVar[str] = ContextVar("staging-scope", default="")


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; cluster settings come from spark-submit."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local-mode session without the setting gets a temporary folder of its own; on a
    cluster a machine-local folder would be lost together with the machine.
    """
    path = spark.conf.get(CHECKPOINT_DIR, None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="ledgerloom-")
    spark.conf.set(CHECKPOINT_DIR, path)
    return path


def _root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/staged/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{_root(spark)}{_scope.get()}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Each action inside gives its shuffle files back when it ends. For writes and counts, whose
    plans are not run again; the results of a shared plan would be shuffled anew."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[Callable]:
    """What is staged inside is removed at the end, also if the work failed. Nothing that is read
    later may depend on it: write results elsewhere, or stage them in the context it yields, which
    belongs to the scope around. Scopes may lie within one another."""
    outer = _scope.get()
    token = _scope.set(f"{outer}/scope-{uuid.uuid4().hex}")
    inner = f"{_root(spark)}{_scope.get()}"

    @contextmanager
    def outside() -> Iterator[None]:
        back = _scope.set(outer)
        try:
            yield
        finally:
            _scope.reset(back)

    try:
        yield outside
    finally:
        _scope.reset(token)
        _delete(spark, inner)


def stage(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """Write `df` once to the shared folder and continue from the written table.

    This cuts the lineage (a lost executor re-reads files instead of replaying the plan, and
    row positions can no longer move), and gives Catalyst the true size of the result, so a
    later join broadcasts it only when it really is small. What the write shuffled is removed.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    with shuffles_removed(spark):
        df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def stage_from(spark: SparkSession, build: Callable[[], DataFrame], label: str, codec: str = "zstd") -> DataFrame:
    """Stage what `build` returns; what it staged on the way is removed."""
    with staging_scope(spark) as outside:
        df = build()
        with outside():
            return stage(df, label, codec)


def stage_in_slices(df: DataFrame, by: str, slices: int, label: str, codec: str = "zstd") -> DataFrame:
    """Stage `df` as so many parts of about equal size, one after the other, each with the rows whose
    `by` has one hash: what one part shuffled is removed before the next one begins. The source is
    read once a part, so this is for joins that would move all rows of a large table at once."""
    spark = df.sparkSession
    path = new_path(spark, label)
    part = F.pmod(F.xxhash64(by), F.lit(slices))
    for i in range(slices):
        with shuffles_removed(spark):
            (df.where(part == i) if slices > 1 else df).write.mode("append").parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def stage_sorted(df: DataFrame, by: str, label: str, group_bytes: int = 1 << 18) -> DataFrame:
    """Stage with each file sorted by one column, in small row groups: their statistics then let a
    scan with a condition on that column skip most of them. Rows stay in the task they are in."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.sortWithinPartitions(by).write.option("parquet.block.size", group_bytes).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def discard_staged(spark: SparkSession) -> None:
    """Remove what this application staged. Call it after the last result is written."""
    _delete(spark, _root(spark))


def at_most(df: DataFrame, rows: int) -> bool:
    """True if `df` has no more than `rows` rows. Meant for staged or narrow tables: the tasks
    count their own rows, which for staged files needs no column."""
    return df.count() <= rows
