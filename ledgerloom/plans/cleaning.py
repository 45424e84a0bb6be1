"""Rule-based cleaning of projects, employees and transactions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import rules
from ledgerloom.functions import dates, numbers, text
from ledgerloom.operators.heavy import heavy_join
from ledgerloom.operators.joins import lookup_join
from ledgerloom.operators.keyed import keep_first
from ledgerloom.operators.profile import long_form
from ledgerloom.operators.quantile import quantiles_by
from ledgerloom.session import stage


# --- projects ---------------------------------------------------------------------------------

def clean_projects(projects: DataFrame) -> DataFrame:
    """Six derived columns, a normalised status, and unknown money as zero.

    The derived columns use the money as delivered: an unknown input leaves variance and
    utilisation unknown and proves no overspend.
    """
    budget, cost = F.col("budget"), F.col("actual_cost")
    derived = projects.withColumns({
        "budget_variance": cost - budget,
        "is_over_budget": numbers.known(cost > budget),
        "duration_days": dates.days_between(F.col("start_date"), F.col("end_date")),
        "budget_utilisation_pct": numbers.utilisation(cost, budget),
        "status": text.normalise_label(F.col("status")),
    })
    high = (F.col("priority") == "Critical") | F.col("is_over_budget")
    medium = (F.col("priority") == "High") | (F.col("budget_utilisation_pct") > 90)
    zero = F.lit(0)
    return derived.withColumns({
        "status_category": text.recode(F.col("status"), rules.STATUS_CATEGORY, "Unknown"),
        "risk_level": F.when(high, "High").when(medium, "Medium").otherwise("Low"),
        "budget": F.coalesce(budget, zero.cast(projects.schema["budget"].dataType)),
        "actual_cost": F.coalesce(cost, zero.cast(projects.schema["actual_cost"].dataType)),
    })


def project_fixes(projects: DataFrame) -> DataFrame:
    """Rows touched per fix of `clean_projects`, from the raw table."""
    status = text.normalise_label(F.col("status"))
    # Names of the fixes.
    counted = {
        "null budget -> 0": F.count_if(F.col("budget").isNull()),
        "null actual_cost -> 0": F.count_if(F.col("actual_cost").isNull()),
        "status without category -> Unknown": F.count_if(
            text.recode(status, rules.STATUS_CATEGORY).isNull()
        ),
    }
    one = projects.agg(*[agg.alias(name) for name, agg in counted.items()])
    return long_form(one, list(counted), "fix", "rows")


# --- employees --------------------------------------------------------------------------------

REQUIRED_TEXT = ("employee_id", "full_name", "department", "role", "level", "status")
TRIMMED_TEXT = ("full_name", "department", "role", "level", "region", "status")


@dataclass(frozen=True)
class EmployeeRules:
    """Limits and conventions of the employee clean-up."""

    as_of: dt.date
    email_domain: str = "example.com"
    email_strategy: str = "derive"  # or "constant"
    email_constant: str = "unknown@example.com"
    salary_bands: Mapping[str, tuple] = field(default_factory=lambda: rules.SALARY_BANDS)
    experience_bands: Mapping[str, tuple] = field(default_factory=lambda: rules.EXPERIENCE_BANDS)
    salary_range: tuple = rules.SALARY_RANGE
    experience_range: tuple = rules.EXPERIENCE_RANGE
    earliest_hire: dt.date = rules.EARLIEST_HIRE
    keying_factor: int = rules.SALARY_KEYING_FACTOR
    sequence: str = "row_seq"  # file order; decides which copy of an id is the first


def check_employees(
    employees: DataFrame, history: DataFrame | None, limits: EmployeeRules
) -> DataFrame:
    """Every input row with repaired values, `dq_flags` and one `bad_*` marker per rule.

    The input is staged once, as medians, hire records, addresses and managers are all looked up in
    it. `finish_employees` and `employee_detections` read the result; stage it when both are needed.
    """
    employees = stage(employees, "employees")
    marked = _mark_blanks(employees)
    with_email = _derive_emails(marked, limits)
    dated = _repair_hire_dates(with_email, employees, history, limits)
    measured = _repair_numbers(dated, employees, limits)
    linked = _repair_managers(measured, employees)
    return _attach_trail(linked)


def _mark_blanks(df: DataFrame) -> DataFrame:
    markers = {f"bad_blank_{c}": text.is_blank(F.col(c)) for c in (*REQUIRED_TEXT, "email")}
    return df.withColumns(markers)


def _derive_emails(df: DataFrame, limits: EmployeeRules) -> DataFrame:
    """Fill blank emails as `first.last@domain`, with the employee id where that is taken.

    Only the rows without email are joined; all others pass through unmoved.
    """
    if limits.email_strategy == "constant":
        filled = F.when(F.col("bad_blank_email"), F.lit(limits.email_constant))
        return df.withColumn("email", filled.otherwise(F.col("email")))

    present = df.filter(~F.col("bad_blank_email"))
    mailbox = text.name_to_mailbox(F.col("full_name"))
    blank = df.filter("bad_blank_email").withColumn("_mailbox", mailbox)
    at_domain = F.concat(F.col("_mailbox"), F.lit(f"@{limits.email_domain}"))

    # One row per derived address: how many rows share it and whether an employee owns it.
    wanted = blank.groupBy("_mailbox").agg(F.count("*").alias("_sharing"))
    wanted = wanted.withColumn("_address", at_domain)
    owned = present.select(F.col("email").alias("_address")).join(
        wanted.select("_address"), "_address", "left_semi"
    ).distinct()
    clashes = (
        wanted.join(owned.withColumn("_owned", F.lit(True)), "_address", "left")
        .filter((F.col("_sharing") > 1) | F.col("_owned"))
        .select(F.col("_mailbox").alias("_clash"))
    )
    with_id = F.concat_ws(
        "", F.col("_mailbox"), F.lit("."), F.lower(F.col("employee_id")),
        F.lit(f"@{limits.email_domain}"),
    )
    derived = F.when(F.col("_clash").isNull(), at_domain).when(
        F.col("_mailbox").isNotNull() & F.col("employee_id").isNotNull(), with_id
    )
    filled = (
        blank.join(clashes, F.col("_mailbox").eqNullSafe(F.col("_clash")), "left")
        .withColumn("email", derived)
        .drop("_mailbox", "_clash")
    )
    return present.unionByName(filled)


def _date_problems(limits: EmployeeRules) -> tuple[Column, Column, Column]:
    parsed = dates.parse_day(F.col("hire_date"))
    return parsed, parsed.isNull(), dates.outside(parsed, limits.earliest_hire, limits.as_of)


def _repair_hire_dates(
    df: DataFrame, raw: DataFrame, history: DataFrame | None, limits: EmployeeRules
) -> DataFrame:
    parsed, unreadable, implausible = _date_problems(limits)
    df = df.withColumns({
        "_parsed": parsed, "bad_date_format": unreadable, "bad_date_range": implausible,
    })
    bad = F.col("bad_date_format") | F.col("bad_date_range")
    if history is None:
        df = df.withColumn("_hired", F.lit(None).cast("date"))
    else:
        # Staged, so its size is known: hire records of the few rows that need one.
        evidence = stage(_hire_evidence(raw, history, limits), "hire-evidence")
        on = bad & (F.col("employee_id") == F.col("_hire_id"))
        df = df.join(evidence, on, "left").drop("_hire_id")
    recovered = F.when(bad, F.col("_hired")).otherwise(F.col("_parsed"))
    return df.withColumns({
        "hire_date": recovered,
        "bad_date_recovered": bad & F.col("_hired").isNotNull(),
    }).drop("_parsed", "_hired")


def _hire_evidence(raw: DataFrame, history: DataFrame, limits: EmployeeRules) -> DataFrame:
    """First hire record per employee whose own hire date is unusable."""
    _, unreadable, implausible = _date_problems(limits)
    wanted = raw.filter(unreadable | implausible).select("employee_id").distinct()
    hires = history.filter(F.col("change_type") == "Hire").join(wanted, "employee_id", "left_semi")
    first = keep_first(
        hires.select("employee_id", "effective_date", limits.sequence),
        ["employee_id"], [F.col(limits.sequence)],
    )
    return first.select(
        F.col("employee_id").alias("_hire_id"),
        F.col("effective_date").try_cast("date").alias("_hired"),
    )


def _repair_numbers(df: DataFrame, raw: DataFrame, limits: EmployeeRules) -> DataFrame:
    salary, years = F.col("salary"), F.col("years_experience")
    typical = _level_medians(raw, limits)
    # The medians are staged, so their size is known and Catalyst broadcasts them when small.
    df = df.join(typical, F.col("level") == F.col("_level"), "left")
    df = df.withColumns({
        "bad_absolute": numbers.off_range(salary, limits.salary_range)
        | numbers.off_range(years, limits.experience_range),
        "bad_years_negative": numbers.known(years < 0),
        "bad_salary": numbers.off_band(salary, F.col("level"), limits.salary_bands),
    })
    whole_years = numbers.half_even(F.col("_typical_years")).cast(raw.schema["years_experience"].dataType)
    df = df.withColumn(
        "years_experience", F.when(F.col("bad_years_negative"), whole_years).otherwise(years)
    )
    scaled = salary.cast("double") / F.lit(limits.keying_factor)
    money = raw.schema["salary"].dataType
    repaired = F.when(
        numbers.in_band(scaled, F.col("level"), limits.salary_bands),
        numbers.half_even(scaled).cast(money),
    ).otherwise(numbers.half_even(F.col("_typical_salary")).cast(money))
    return df.withColumns({
        "bad_years_band": numbers.off_band(
            F.col("years_experience"), F.col("level"), limits.experience_bands
        ),
        "salary": F.when(F.col("bad_salary"), repaired).otherwise(salary),
    }).drop("_level", "_typical_years", "_typical_salary")


def _level_medians(raw: DataFrame, limits: EmployeeRules) -> DataFrame:
    """Median experience of non-negative rows and median salary of in-band rows, per level."""
    years, salary = F.col("years_experience"), F.col("salary")
    usable_years = F.when(~numbers.known(years < 0), years.cast("double"))
    off = numbers.off_band(salary, F.col("level"), limits.salary_bands)
    measures = {
        "_typical_years": usable_years, "_typical_salary": F.when(~off, salary.cast("double")),
    }
    values = raw.select(F.inline(F.array(*[
        F.struct(F.struct("level", F.lit(name).alias("measure")).alias("of"), value.alias("value"))
        for name, value in measures.items()
    ])))
    medians = quantiles_by(values, "of", "value", [0.5], "_q")
    per_level = medians.groupBy(F.col("of.level").alias("_level")).agg(*[
        F.max(F.when(F.col("of.measure") == name, F.col("_q")[0])).alias(name)
        for name in measures
    ])
    return stage(per_level, "level-medians")


def _repair_managers(df: DataFrame, raw: DataFrame) -> DataFrame:
    """Null managers that do not exist; mark active staff under an inactive manager.

    Many people may have one manager, or none: see `heavy_join`."""
    people = raw.where(F.col("employee_id").isNotNull()).groupBy(F.col("employee_id").alias("_manager")).agg(
        F.max(numbers.known(F.col("status") == "Inactive")).alias("_manager_left")
    )
    active = numbers.known(F.col("status") == "Active")
    linked = heavy_join(stage(df, "measured"), people, "manager_id", "_manager")
    found = F.col("_manager_left").isNotNull()
    return linked.withColumns({
        "bad_no_date_active": F.col("hire_date").isNull() & active,
        "bad_manager": F.col("manager_id").isNotNull() & ~found,
        "bad_manager_left": numbers.known(F.col("_manager_left")) & active,
        "manager_id": F.when(found, F.col("manager_id")),
    }).drop("_manager_left")


def _attach_trail(df: DataFrame) -> DataFrame:
    """Trim the text columns last and join the labels of the rules that fired."""
    hits = [
        F.col("bad_blank_email"),
        F.col("bad_date_format") | F.col("bad_date_range"),
        F.col("bad_years_negative"),
        F.col("bad_years_band"),
        F.col("bad_salary"),
        F.col("bad_no_date_active"),
        F.col("bad_manager"),
        F.col("bad_manager_left"),
    ]
    trail = text.audit_trail(dict(zip(rules.AUDIT_LABELS, hits, strict=True)))
    changed = [
        numbers.known(text.strip(F.col(c)) != F.col(c)).cast("int") for c in TRIMMED_TEXT
    ]
    cells = changed[0]
    for one in changed[1:]:
        cells = cells + one
    df = df.withColumns({"dq_flags": trail, "trimmed_cells": cells})
    return df.withColumns({c: text.strip(F.col(c)) for c in TRIMMED_TEXT})


def finish_employees(checked: DataFrame, limits: EmployeeRules) -> DataFrame:
    """The first row per employee id, without the rule markers."""
    first = keep_first(checked, ["employee_id"], [F.col(limits.sequence)])
    markers = [c for c in first.columns if c.startswith("bad_")]
    return first.drop(*markers, "trimmed_cells", limits.sequence)


def clean_employees(
    employees: DataFrame, history: DataFrame | None, limits: EmployeeRules
) -> DataFrame:
    return finish_employees(check_employees(employees, history, limits), limits)


#: Columns that cleaning may change, and what the raw ones are called beside them.
COMPARED = {
    "email": "raw_email", "hire_date": "raw_hire_date", "salary": "raw_salary",
    "years_experience": "raw_years",
}


def raw_beside_clean(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """The employees that some rule flagged, raw values beside the clean ones. `raw` has one row per
    employee."""
    before = raw.select("employee_id", *[F.col(c).alias(name) for c, name in COMPARED.items()])
    after = clean.filter("dq_flags <> ''").select("employee_id", *COMPARED, "dq_flags")
    return before.join(after, "employee_id")


def _per_employee(checked: DataFrame, measures: Mapping[str, object]) -> DataFrame:
    """Sum the markers per id, then over ids: one shuffle also yields the duplicate count."""
    per_id = checked.groupBy("employee_id").agg(
        F.count("*").alias("_rows"), *[m.alias(n) for n, m in measures.items()]
    )
    return per_id.agg(
        F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("_duplicates"),
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in measures],
    )


def employee_detections(checked: DataFrame) -> DataFrame:
    """Rows per kind of issue, in one pass."""
    blank = F.col("bad_blank_email")
    for c in REQUIRED_TEXT:
        blank = blank | F.col(f"bad_blank_{c}")
    # Names of the issues.
    issues = {
        "Missing values": blank,
        "Invalid date formats": F.col("bad_date_format"),
        "Implausible dates": F.col("bad_date_range"),
        "Numeric out-of-range": F.col("bad_absolute"),
        "Logical inconsistencies (salary/experience vs level)": F.col("bad_salary")
        | F.col("bad_years_band"),
        "Status conflicts": F.col("bad_no_date_active") | F.col("bad_manager_left"),
        "Referential issues (manager_id)": F.col("bad_manager"),
    }
    one = _per_employee(checked, {n: F.count_if(hit) for n, hit in issues.items()})
    one = one.withColumnRenamed("_duplicates", "Duplicates")
    return long_form(one, [*issues, "Duplicates"], "issue", "rows")


def employee_fixes(checked: DataFrame) -> DataFrame:
    """Rows (for trimming: cells) touched per fix, in one pass."""
    bad_date = F.col("bad_date_format") | F.col("bad_date_range")
    # Names of the fixes.
    fixes = {
        f"missing {c} (unfixable)": F.count_if(F.col(f"bad_blank_{c}")) for c in REQUIRED_TEXT
    }
    fixes |= {
        "missing email -> derived from name": F.count_if(F.col("bad_blank_email")),
        "invalid hire_date format -> NULL": F.count_if(F.col("bad_date_format")),
        "implausible hire_date -> NULL": F.count_if(F.col("bad_date_range")),
        "hire_date recovered from salary history": F.count_if(
            bad_date & F.col("bad_date_recovered")
        ),
        "negative years_experience -> level median": F.count_if(F.col("bad_years_negative")),
        "years_experience outside level band (flagged only)": F.count_if(F.col("bad_years_band")),
        "salary outside level band -> corrected": F.count_if(F.col("bad_salary")),
        "Active without verifiable hire_date (flagged for review)": F.count_if(
            F.col("bad_no_date_active")
        ),
        "manager_id placeholder (no such employee) -> NULL": F.count_if(F.col("bad_manager")),
        "Active staff with Inactive manager (flagged)": F.count_if(F.col("bad_manager_left")),
        "whitespace trimmed": F.sum("trimmed_cells"),
    }
    one = _per_employee(checked, fixes)
    last = "duplicate employee_id dropped"
    return long_form(one.withColumnRenamed("_duplicates", last), [*fixes, last], "fix", "rows")


# --- transactions -----------------------------------------------------------------------------

def _file_order(reference: DataFrame) -> list | None:
    """Of several copies of a key the first in the file counts, where the order is known."""
    return [F.col("row_seq")] if "row_seq" in reference.columns else None


def enrich_transactions(
    transactions: DataFrame, projects: DataFrame, employees: DataFrame
) -> DataFrame:
    """Project and approver names, approval flag, amount without nulls, month."""
    named = lookup_join(
        transactions, projects, {"project_id": "project_id"},
        {"project_name": "project_name", "department": "department"}, _file_order(projects),
    )
    named = lookup_join(
        named, employees, {"approved_by": "employee_id"}, {"full_name": "approver_name"},
        _file_order(employees),
    )
    amount = transactions.schema["amount"].dataType
    return named.withColumns({
        "is_approved": F.col("approved_by").isNotNull(),
        "amount_aed": F.coalesce(F.col("amount"), F.lit(0).cast(amount)),
        "transaction_year_month": dates.year_month(F.col("transaction_date")),
    })
