"""Data policy as views: classification tags, persona access, retention, anonymisation."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Class per column. PII+ marks personal data that is confidential as well.
CLASSIFICATION = {
    "projects": {
        "Internal": [
            "project_id", "project_name", "department", "region", "status", "priority",
            "start_date", "end_date", "project_manager_id", "status_category", "risk_level",
            "duration_days", "is_over_budget",
        ],
        "Confidential": ["budget", "actual_cost", "budget_variance", "budget_utilisation_pct"],
    },
    "employees": {
        "Internal": [
            "employee_id", "manager_id", "department", "role", "level", "region", "status",
            "years_experience", "dq_flags",
        ],
        "PII": ["full_name", "email", "hire_date"],
        "PII + Confidential": ["salary"],
    },
    "transactions": {
        "Internal": [
            "transaction_id", "invoice_ref", "project_id", "category", "payment_status",
            "currency", "notes",
        ],
        "Confidential": ["vendor_id", "vendor_name", "amount", "transaction_date"],
        "PII": ["approved_by", "approver_name"],
    },
    "employees_salary_history": {
        "Internal": ["employee_id"],
        "PII": [
            "previous_role", "new_role", "previous_level", "new_level", "effective_date",
        ],
        "PII + Confidential": [
            "previous_salary", "new_salary", "change_type", "change_reason",
        ],
    },
}

# What each persona sees of each dataset.
ACCESS = {
    "data_engineer": {
        "projects": "full", "employees": "masked", "transactions": "full",
        "employees_salary_history": "none",
    },
    "bi_analyst": {
        "projects": "full", "employees": "masked", "transactions": "full",
        "employees_salary_history": "none",
    },
    "finance": {
        "projects": "full", "employees": "none", "transactions": "full",
        "employees_salary_history": "none",
    },
    "hr": {
        "projects": "none", "employees": "full", "transactions": "none",
        "employees_salary_history": "full",
    },
    "executive": {
        "projects": "full", "employees": "aggregated", "transactions": "aggregated",
        "employees_salary_history": "none",
    },
}

# Years until archive and until disposal.
RETENTION_YEARS = {"projects": (3, 7), "transactions": (2, 7)}
LEAVER_YEARS = {"employees": 5, "employees_salary_history": 10}


class AccessDenied(PermissionError):
    """The persona has no access to the dataset."""


def classification_of(dataset: str) -> dict[str, str]:
    return {c: kind for kind, columns in CLASSIFICATION[dataset].items() for c in columns}


def tag_columns(df: DataFrame, dataset: str) -> DataFrame:
    """Attach the class of every known column as column metadata."""
    classes = classification_of(dataset)
    return df.select(*[
        F.col(c).alias(c, metadata={"classification": classes[c]}) if c in classes else F.col(c)
        for c in df.columns
    ])


def classification_table(spark: SparkSession) -> DataFrame:
    """One row per classified column."""
    rows = [
        F.struct(
            F.lit(d).alias("dataset"), F.lit(c).alias("column_name"), F.lit(k).alias("classification")
        )
        for d in CLASSIFICATION for c, k in classification_of(d).items()
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def personal_columns(df: DataFrame) -> list[str]:
    """Columns tagged as personal data."""
    return [
        f.name for f in df.schema if f.metadata.get("classification", "").startswith("PII")
    ]


def _masked(df: DataFrame, column: str) -> Column:
    """Names and addresses keep their shape, every other personal value is removed."""
    kind = df.schema[column].dataType
    if kind.simpleString() == "string":
        return F.mask(F.col(column)).alias(column)
    return F.lit(None).cast(kind).alias(column)


def masked_view(df: DataFrame, dataset: str) -> DataFrame:
    """All rows, personal columns masked."""
    classes = classification_of(dataset)
    return df.select(*[
        _masked(df, c) if classes.get(c, "").startswith("PII") else F.col(c) for c in df.columns
    ])


def pseudonym(column: Column, salt: str) -> Column:
    """Stable salted hash, for joins between masked views."""
    return F.sha2(F.concat(F.lit(salt), column.cast("string")), 256)


AGGREGATES = {
    "employees": (
        ["department", "level"],
        {"people": F.count, "average_experience": F.avg},
        {"people": "*", "average_experience": "years_experience"},
    ),
    "transactions": (
        ["category", "payment_status"],
        {"transactions": F.count, "total_amount": F.sum},
        {"transactions": "*", "total_amount": "amount"},
    ),
}


def aggregated_view(df: DataFrame, dataset: str) -> DataFrame:
    keys, functions, columns = AGGREGATES[dataset]
    return df.groupBy(*keys).agg(
        *[function(columns[name]).alias(name) for name, function in functions.items()]
    )


def persona_view(df: DataFrame, dataset: str, persona: str) -> DataFrame:
    """What `persona` may see of `dataset`."""
    level = ACCESS[persona][dataset]
    if level == "none":
        raise AccessDenied(f"{persona} has no access to {dataset}")
    if level == "masked":
        return masked_view(df, dataset)
    return aggregated_view(df, dataset) if level == "aggregated" else df


def retention_state(
    day: Column, as_of: dt.date, archive_years: int, delete_years: int
) -> Column:
    """keep, archive or delete by age; rows without a date are kept."""
    cut = lambda years: F.add_months(F.lit(as_of), -12 * years)
    return (
        F.when(day <= cut(delete_years), "delete")
        .when(day <= cut(archive_years), "archive")
        .otherwise("keep")
    )


def split_by_retention(
    df: DataFrame, dataset: str, day: str, as_of: dt.date,
    years: Mapping[str, tuple] = RETENTION_YEARS,
) -> DataFrame:
    """Add `retention`; written with that partition column the parts can be moved or dropped."""
    return df.withColumn("retention", retention_state(F.col(day), as_of, *years[dataset]))


def anonymise_leavers(
    employees: DataFrame, left_on: str, as_of: dt.date, years: int = LEAVER_YEARS["employees"]
) -> DataFrame:
    """Remove the personal columns of people who left at least `years` years ago."""
    expired = F.coalesce(F.col(left_on) <= F.add_months(F.lit(as_of), -12 * years), F.lit(False))
    classes = classification_of("employees")
    personal = [c for c in employees.columns if classes.get(c, "").startswith("PII")]
    blank = {c: F.when(~expired, F.col(c)) for c in personal}
    return employees.withColumns({**blank, "anonymised": expired})


def salary_bands(history: DataFrame, width: int = 5000) -> DataFrame:
    """Pay history without persons: changes per salary band, level and year."""
    band = (F.floor(F.col("new_salary").cast("double") / width) * width).cast("long")
    return history.groupBy(
        band.alias("salary_band"), F.col("new_level").alias("level"),
        F.year("effective_date").alias("year"),
    ).agg(F.count("*").alias("changes"))
