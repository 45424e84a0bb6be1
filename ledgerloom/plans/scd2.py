"""A type-2 dimension from a current master and a change log, and the checks it must pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom import rules
from ledgerloom.operators.keyed import keep_first
from ledgerloom.operators.sequence import dense_key


def collapse_same_day(
    changes: DataFrame, key: str = "employee_id", effective: str = "effective_date",
    sequence: str = "row_seq",
) -> DataFrame:
    """The last change per key and day, in file order: the state at the end of that day."""
    return keep_first(changes, [key, effective], [F.col(sequence).desc()])


def build_versions(
    master: DataFrame,
    changes: DataFrame,
    *,
    tracked: Mapping[str, str],
    carried: Sequence[str],
    key: str = "employee_id",
    effective: str = "effective_date",
    start: str = "hire_date",
    metadata: Sequence[str] = ("change_type", "change_reason"),
) -> DataFrame:
    """Half-open versions per key of `master`, from one collapsed row per key and day.

    `tracked` maps an attribute of the master to its column in the change log. Every change
    opens a version that ends at the next one. The newest version takes the attributes of the
    master, and a key without changes gets one version from `start`. Master and log meet in one
    left join. After the collapse a key has at most one change per day, which bounds the window.
    """
    in_time = W.partitionBy(key).orderBy(effective)
    log = changes.select(
        F.col(key).alias("_key"),
        F.col(effective).cast("date").alias("_from"),
        F.lead(F.col(effective).cast("date")).over(in_time).alias("_next"),
        *[F.col(source).alias(f"_new_{name}") for name, source in tracked.items()],
        *[F.col(m).alias(f"_log_{m}") for m in metadata],
    )
    joined = master.join(log, F.col(key) == F.col("_key"), "left")
    closed = F.col("_next").isNotNull()
    logged = F.col("_key").isNotNull()
    fallback = dict(zip(metadata, (rules.INITIAL_CHANGE, rules.INITIAL_REASON), strict=True))
    begins = F.coalesce(F.col(start).cast("date"), F.lit(rules.UNKNOWN_START))
    return joined.select(
        F.col(key),
        *[F.col(c) for c in carried],
        *[
            F.when(closed, F.col(f"_new_{name}")).otherwise(F.col(name))
            .cast(master.schema[name].dataType).alias(name)
            for name in tracked
        ],
        F.when(logged, F.col("_from")).otherwise(begins).alias("valid_from"),
        F.coalesce("_next", F.lit(rules.OPEN_END)).alias("valid_to"),
        (~closed).alias("is_current"),
        *[
            F.when(logged, F.col(f"_log_{m}")).otherwise(F.lit(fallback[m])).alias(m)
            for m in metadata
        ],
    )


def dim_employee(employees: DataFrame, history: DataFrame, sequence: str = "row_seq") -> DataFrame:
    """Employee versions by role, level and salary, with a dense surrogate key."""
    versions = build_versions(
        employees,
        collapse_same_day(history, sequence=sequence),
        tracked={"role": "new_role", "level": "new_level", "salary": "new_salary"},
        carried=[
            "full_name", "email", "department", "hire_date", "manager_id", "region", "status",
            "years_experience",
        ],
    )
    return dense_key(versions, "employee_key", ["employee_id", "valid_from"])


# --- checks: each result is empty for a sound dimension ----------------------------------------

def several_current(dim: DataFrame) -> DataFrame:
    counted = dim.filter("is_current").groupBy("employee_id").agg(
        F.count("*").alias("current_count")
    )
    return counted.filter("current_count > 1")


def no_current(dim: DataFrame) -> DataFrame:
    ids = dim.select("employee_id").distinct()
    return ids.join(dim.filter("is_current").select("employee_id"), "employee_id", "left_anti")


def overlaps(dim: DataFrame) -> DataFrame:
    """Versions that start before an earlier version of the same key has ended.

    One pass per key in time order instead of comparing all pairs of versions; each offender is
    reported with the earlier version that ends last.
    """
    earlier = (
        W.partitionBy("employee_id").orderBy("valid_from", "employee_key")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    ends_last = F.max(F.struct("valid_to", "employee_key", "valid_from")).over(earlier)
    marked = dim.select(
        "employee_id", "employee_key", "valid_from", "valid_to", ends_last.alias("_e")
    )
    clash = (F.col("_e.valid_to") > F.col("valid_from")) & (
        F.col("_e.valid_from") < F.col("valid_to")
    )
    return marked.filter(clash).select(
        "employee_id",
        F.col("_e.employee_key").alias("key_a"),
        F.col("employee_key").alias("key_b"),
        F.col("_e.valid_from").alias("a_from"),
        F.col("_e.valid_to").alias("a_to"),
        F.col("valid_from").alias("b_from"),
        F.col("valid_to").alias("b_to"),
    )


def gaps(dim: DataFrame) -> DataFrame:
    """Closed versions whose end is not the start of the next version."""
    following = F.lead("valid_from").over(W.partitionBy("employee_id").orderBy("valid_from"))
    marked = dim.withColumn("next_starts", following).filter(~F.col("is_current"))
    broken = F.col("next_starts").isNull() | (F.col("valid_to") != F.col("next_starts"))
    return marked.filter(broken).select(
        "employee_id", F.col("valid_to").alias("ends"), "next_starts"
    )


def version_counts(dim: DataFrame, n: int = 10) -> DataFrame:
    """The `n` keys with the most versions."""
    counted = dim.groupBy("employee_id").agg(F.count("*").alias("version_count"))
    return counted.orderBy(F.col("version_count").desc(), "employee_id").limit(n)


def most_versioned(dim: DataFrame) -> DataFrame:
    """All versions of the key with the most versions."""
    top = version_counts(dim, 1).select("employee_id").scalar()
    return dim.filter(F.col("employee_id") == top).orderBy("valid_from")


def row_balance(dim: DataFrame, collapsed: DataFrame, master: DataFrame) -> DataFrame:
    """Rows of the dimension against an independent count."""
    without = master.join(collapsed.select("employee_id"), "employee_id", "left_anti")
    actual = dim.agg(F.count("*").alias("actual_rows"))
    logged = collapsed.agg(F.count("*")).scalar()
    alone = without.agg(F.count("*")).scalar()
    return actual.withColumn("expected_rows", logged + alone)


def version_summary(dim: DataFrame) -> DataFrame:
    """Versions, distinct keys and current rows."""
    per_key = dim.groupBy("employee_id").agg(
        F.count("*").alias("n"), F.count_if("is_current").alias("c")
    )
    return per_key.agg(
        F.sum("n").alias("versions"),
        F.count("*").alias("employees"),
        F.sum("c").alias("current_rows"),
    )


def validation(dim: DataFrame, collapsed: DataFrame, master: DataFrame) -> DataFrame:
    """One row per check with the number of violations; all must be zero."""
    checks = {
        "more than one current version": several_current(dim),
        "no current version": no_current(dim),
        "overlapping versions": overlaps(dim),
        "gaps between versions": gaps(dim),
    }
    balance = row_balance(dim, collapsed, master).select(
        F.lit("row balance").alias("check"),
        F.abs(F.col("actual_rows") - F.col("expected_rows")).alias("violations"),
    )
    result = balance
    for name, offenders in checks.items():
        result = result.unionByName(
            offenders.agg(F.lit(name).alias("check"), F.count("*").alias("violations"))
        )
    return result
