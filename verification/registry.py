"""One query per operator of the inventory, over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import rules
from ledgerloom.functions import text
from ledgerloom.operators import grouping, joins, keyed, profile, quality, quantile, sequence
from ledgerloom.plans import cleaning, dashboard, events, jobs, policy, questions, scd2, star
from ledgerloom.session import new_path, stage
from ledgerloom.sources import readers, writers
from ledgerloom.streaming import feed, ledger, live
from verification import views as v

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register under the function's name; decimals leave as doubles, short integers as ints."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(function(spark, sf_dir))

    QUERIES[function.__name__] = run
    return function


def plain(df: DataFrame) -> DataFrame:
    columns = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double").alias(f.name)
        elif isinstance(f.dataType, T.ShortType):
            c = c.cast("int").alias(f.name)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz").alias(f.name)
        columns.append(c)
    return df.select(*columns)


# --- shared inputs ----------------------------------------------------------------------------

def clean_projects(spark, sf):
    return cleaning.clean_projects(v.projects(spark, sf))


def project_money(spark, sf):
    """Clean projects without the columns that need their place in the organisation."""
    columns = [c for c in v.PROJECT_COLUMNS if c not in ("department", "region")]
    return cleaning.clean_projects(v.projects(spark, sf, *columns))


def project_keys(spark, sf):
    """The keys of `dim_project`, for loads that look nothing else up."""
    return sequence.dense_key(v.projects(spark, sf, "project_id"), "project_key", ["project_id"])


def checked_employees(spark, sf):
    return cleaning.check_employees(v.employees(spark, sf), v.history(spark, sf), v.LIMITS)


def clean_employees(spark, sf):
    return cleaning.finish_employees(checked_employees(spark, sf), v.LIMITS)


def spend(spark, sf, *columns):
    """Transactions with the amount that counts a missing one as zero."""
    t = v.transactions(spark, sf, "amount", *columns)
    return t.withColumn("amount_aed", F.coalesce("amount", F.lit(0).cast(v.MONEY)))


def enriched(spark, sf):
    """Transactions as the star schema loads them."""
    names = [c for c in v.TRANSACTION_COLUMNS if c != "amount"]
    return spend(spark, sf, *names).withColumn("is_approved", F.col("approved_by").isNotNull())


def named_projects(spark, sf):
    rows = v.projects(spark, sf, "project_id", "project_name", "department", "status")
    return rows.withColumn("status", text.normalise_label(F.col("status")))


def pending_columns(spark, sf):
    return v.transactions(
        spark, sf, "project_id", "amount", "category", "payment_status", "transaction_date"
    )


def people(spark, sf):
    """One row per employee: the first copy, unrepaired."""
    return keyed.keep_first(v.employees(spark, sf), ["employee_id"], [F.col("row_seq")])


def masters(spark, sf):
    """Employees for the version dimension: one row per id, hire date parsed."""
    return people(spark, sf).withColumn("hire_date", F.try_to_date("hire_date", "yyyy-MM-dd"))


def employee_versions(spark, sf):
    master = masters(spark, sf)
    return scd2.dim_employee(master, v.history(spark, sf))


def clean_events(spark, sf):
    return events.add_date_parts(v.events(spark, sf))


def counted(measurements: DataFrame) -> DataFrame:
    return measurements.filter("metric <> 'configured'").select(
        "dataset", "check", "column_name", "metric", F.round("value", 6).alias("value"), "failed"
    )


# --- business questions -----------------------------------------------------------------------

@query
def monthly_spend_trend(spark, sf):
    return questions.monthly_spend_trend(spend(spark, sf, "category", "transaction_date"))


@query
def monthly_spend_last_year(spark, sf):
    rows = spend(spark, sf, "category", "transaction_date")
    return questions.monthly_spend_trend(rows, last_months=282, as_of=v.AS_OF)


@query
def monthly_spend_last_12_months(spark, sf):
    """The last year of the data; `monthly_spend_last_year` counts back from a later day."""
    rows = spend(spark, sf, "category", "transaction_date")
    return questions.monthly_spend_trend(rows, last_months=12, as_of=v.dt.date(1998, 12, 1))


@query
def category_trend(spark, sf):
    return questions.category_trend(spend(spark, sf, "category", "transaction_date"), "ECONOMY")


@query
def dept_budget_performance(spark, sf):
    return questions.department_budget_performance(clean_projects(spark, sf), over_pct=50)


@query
def manager_workload(spark, sf):
    return questions.manager_workload(project_money(spark, sf), people(spark, sf), more_than=6)


@query
def manager_workload_of_current_versions(spark, sf):
    """The same question over the version dimension."""
    current = employee_versions(spark, sf).where("is_current")
    return questions.manager_workload(project_money(spark, sf), current, more_than=6)


@query
def vendor_concentration(spark, sf):
    return questions.vendor_concentration(spend(spark, sf, "vendor_name"))


@query
def open_financial_issues(spark, sf):
    rows = spend(spark, sf, "project_id", "payment_status")
    return questions.open_financial_issues(rows, named_projects(spark, sf))


@query
def largest_increases(spark, sf):
    return questions.largest_increases(employee_versions(spark, sf))


@query
def above_avg_pending(spark, sf):
    return questions.above_average_pending(
        pending_columns(spark, sf), project_money(spark, sf), people(spark, sf)
    )


@query
def above_avg_pending_comma_join(spark, sf):
    return questions.above_average_pending_filtered(
        pending_columns(spark, sf), project_money(spark, sf), people(spark, sf)
    )


@query
def had_issue(spark, sf):
    return questions.had_issue(
        v.projects(spark, sf, "project_id", "department"),
        v.transactions(spark, sf, "project_id", "payment_status"),
        v.events(spark, sf), rules.RAISED,
    )


@query
def issue_share(spark, sf):
    return questions.issue_share(had_issue(spark, sf))


# --- cleaning ---------------------------------------------------------------------------------

@query
def projects_clean(spark, sf):
    return clean_projects(spark, sf)


@query
def project_fixes(spark, sf):
    return cleaning.project_fixes(v.projects(spark, sf))


@query
def employees_clean(spark, sf):
    return clean_employees(spark, sf)


@query
def employee_detection_report(spark, sf):
    return cleaning.employee_detections(checked_employees(spark, sf))


@query
def employee_fix_report(spark, sf):
    return cleaning.employee_fixes(checked_employees(spark, sf))


@query
def raw_clean_compare(spark, sf):
    return cleaning.raw_beside_clean(people(spark, sf), clean_employees(spark, sf))


@query
def audit_label_counts(spark, sf):
    return keyed.label_counts(clean_employees(spark, sf), "dq_flags")


@query
def transactions_enriched(spark, sf):
    return cleaning.enrich_transactions(
        v.transactions(spark, sf), v.projects(spark, sf), v.employees(spark, sf)
    )


@query
def join_grain(spark, sf):
    t = v.transactions(spark, sf)
    joined = joins.lookup_join(
        t, v.employees(spark, sf), {"approved_by": "employee_id"}, {"full_name": "approver_name"},
        order_by=[F.col("row_seq")],
    )
    return joins.grain_check(t, joined, "approver_name")


# --- reports on tables ------------------------------------------------------------------------

@query
def status_risk_crosstab(spark, sf):
    return grouping.cross_table(
        clean_projects(spark, sf), "status_category", "risk_level", ["High", "Low", "Medium"]
    )


@query
def level_quantile_screen(spark, sf):
    screened = quantile.above_quantile(v.employees(spark, sf), "level", "salary", 0.99, share=0.95)
    odd = screened.filter(F.col("_above") | (F.col("years_experience") < 0))
    return odd.select("row_seq", "employee_id", "level", "salary", "years_experience")


@query
def level_medians(spark, sf):
    return quantile.quantile_by(v.employees(spark, sf), "level", "salary", 0.5, "median_salary")


@query
def level_medians_by_rank(spark, sf):
    """The same medians on the path taken when a task cannot hold all distinct values."""
    return quantile.quantile_by(
        v.employees(spark, sf), "level", "salary", 0.5, "median_salary", in_one_task=0
    )


@query
def numeric_summary(spark, sf):
    return profile.numeric_summary(
        clean_projects(spark, sf), ["budget_variance", "budget_utilisation_pct", "duration_days"]
    )


@query
def table_profile(spark, sf):
    return profile.table_profile(v.transactions(spark, sf))


@query
def value_frequencies(spark, sf):
    return keyed.value_counts(v.employees(spark, sf), "hire_date")


@query
def duplicate_ids(spark, sf):
    return keyed.duplicate_rows(v.employees(spark, sf), ["employee_id"])


@query
def dangling_managers(spark, sf):
    staff = v.employees(spark, sf)
    return keyed.dangling(staff, "manager_id", staff, "employee_id")


# --- data quality -----------------------------------------------------------------------------

def _project_checks(spark, sf, *only):
    return quality.run_checks(
        clean_projects(spark, sf), "projects", as_of=v.AS_OF, only=list(only),
        references={"employees": people(spark, sf)},
    )


TEST_RULES = {
    **rules.QUALITY_RULES,
    "employees": {
        **rules.QUALITY_RULES["employees"],
        "numeric_ranges": {
            "salary": {"min": 0, "max": 9000}, "years_experience": {"min": 0, "max": 25},
        },
        "consistency_rules": [
            {"type": "non_negative", "column": "salary"},
            {
                "type": "level_salary_band", "level_column": "level", "salary_column": "salary",
                "bands": v.LIMITS.salary_bands,
            },
        ],
        "distribution_max_share": {"threshold": 0.15, "columns": ["level", "role"]},
        "outlier_zscore": {"threshold": 1.5, "columns": ["salary", "years_experience"]},
    },
}


def _employee_checks(spark, sf, *only):
    return quality.run_checks(
        v.employees(spark, sf), "employees", config=TEST_RULES, as_of=v.AS_OF, only=list(only)
    )


def _transaction_checks(spark, sf, only, *columns):
    return quality.run_checks(
        v.transactions(spark, sf, *columns), "transactions", config=TEST_RULES, as_of=v.AS_OF,
        only=[only],
        references={
            "projects": v.projects(spark, sf, "project_id"), "employees": v.employees(spark, sf),
        },
    )


@query
def dq_completeness(spark, sf):
    return counted(_employee_checks(spark, sf, "completeness"))


@query
def dq_uniqueness(spark, sf):
    return counted(
        _employee_checks(spark, sf, "uniqueness").unionByName(
            _transaction_checks(spark, sf, "uniqueness", "transaction_id")
        )
    )


@query
def dq_validity_numeric(spark, sf):
    return counted(_employee_checks(spark, sf, "validity_numeric"))


@query
def dq_validity_date(spark, sf):
    return counted(_employee_checks(spark, sf, "validity_date"))


@query
def dq_consistency(spark, sf):
    return counted(
        _employee_checks(spark, sf, "consistency").unionByName(
            _project_checks(spark, sf, "consistency")
        )
    )


@query
def dq_referential(spark, sf):
    return counted(
        _employee_checks(spark, sf, "referential_integrity").unionByName(
            _transaction_checks(
                spark, sf, "referential_integrity", "project_id", "approved_by"
            )
        )
    )


@query
def dq_distribution(spark, sf):
    return counted(_employee_checks(spark, sf, "distribution"))


@query
def dq_freshness(spark, sf):
    return counted(_transaction_checks(spark, sf, "freshness", "transaction_date"))


@query
def dq_outliers(spark, sf):
    return counted(_employee_checks(spark, sf, "outliers"))


def _datasets(spark, sf):
    return {
        "projects": v.projects(spark, sf),
        "employees": v.employees(spark, sf),
        "transactions": v.transactions(spark, sf),
        "employees_salary_history": v.history(spark, sf).drop("row_seq"),
    }


@query
def dq_report(spark, sf):
    # Many checks read the same rows: write them once, then each check reads its columns only.
    datasets = {name: stage(df, name) for name, df in _datasets(spark, sf).items()}
    measured = quality.run_all(datasets, config=TEST_RULES, as_of=v.AS_OF)
    return quality.check_status(measured)


@query
def dq_critical(spark, sf):
    measured = quality.run_all(
        _datasets(spark, sf), config=TEST_RULES, as_of=v.AS_OF, only=["completeness"]
    )
    return quality.critical_failures(measured, TEST_RULES, limit=0.975)


# --- version dimension and star ---------------------------------------------------------------

@query
def history_dedup(spark, sf):
    return scd2.collapse_same_day(v.history(spark, sf)).drop("previous_salary")


@query
def dim_employee_scd2(spark, sf):
    return employee_versions(spark, sf)


@query
def scd2_validation(spark, sf):
    return scd2.validation(
        employee_versions(spark, sf), scd2.collapse_same_day(v.history(spark, sf)), people(spark, sf)
    )


@query
def scd2_findings(spark, sf):
    """The checks on a dimension with planted faults: people with several current versions or none,
    versions that start a day late or a day early."""
    person = F.col("employee_id")
    days = F.when(person % 11 == 5, 1).when(person % 11 == 6, -1).otherwise(0)
    broken = employee_versions(spark, sf).withColumns({
        "is_current": F.when(person % 13 == 4, True).when(person % 7 == 3, False).otherwise(F.col("is_current")),
        "valid_from": F.date_add("valid_from", days),
    })
    return scd2.validation(
        stage(broken, "broken"), scd2.collapse_same_day(v.history(spark, sf)), people(spark, sf))


@query
def scd2_row_balance(spark, sf):
    return scd2.row_balance(
        employee_versions(spark, sf), scd2.collapse_same_day(v.history(spark, sf)),
        people(spark, sf),
    )


@query
def scd2_version_counts(spark, sf):
    return scd2.version_counts(employee_versions(spark, sf))


@query
def scd2_version_summary(spark, sf):
    return scd2.version_summary(employee_versions(spark, sf))


@query
def version_history_top(spark, sf):
    return scd2.most_versioned(employee_versions(spark, sf))


@query
def dim_date(spark, sf):
    """The calendar over the days that occur on transactions."""
    span = v.table(spark, sf, "lineitem").agg(
        F.min("l_shipdate").cast("date").alias("a"), F.max("l_shipdate").cast("date").alias("b")
    ).first()
    return star.dim_date(spark, span["a"], span["b"])


@query
def dim_project(spark, sf):
    return star.dim_project(stage(clean_projects(spark, sf), "projects"))


@query
def dim_vendor(spark, sf):
    return star.dim_vendor(v.transactions(spark, sf, "vendor_id", "vendor_name"))


def _dimensions(spark, sf):
    """Dense keys are staged already, so the dimensions are read back, not computed again."""
    return (
        project_keys(spark, sf),
        star.dim_vendor(v.transactions(spark, sf, "vendor_id", "vendor_name")),
        employee_versions(spark, sf),
    )


@query
def bridge_employee_project(spark, sf):
    project_dim, employee_dim = project_keys(spark, sf), employee_versions(spark, sf)
    links = v.transactions(spark, sf, "project_id", "approved_by", "transaction_date")
    managed = v.projects(
        spark, sf, "project_id", "project_manager_id", "start_date", "end_date"
    )
    return star.bridge_employee_project(managed, links, project_dim, employee_dim)


@query
def fact_transactions(spark, sf):
    project_dim, vendor_dim, employee_dim = _dimensions(spark, sf)
    return star.fact_transactions(enriched(spark, sf), project_dim, vendor_dim, employee_dim)


@query
def star_reconciliation(spark, sf):
    project_dim, vendor_dim, employee_dim = _dimensions(spark, sf)
    managed = v.projects(
        spark, sf, "project_id", "project_manager_id", "start_date", "end_date"
    )
    rows = enriched(spark, sf)
    bridge = star.bridge_employee_project(managed, rows, project_dim, employee_dim)
    fact = star.fact_rows(rows, project_dim, vendor_dim, employee_dim)
    return star.row_counts(project_dim, employee_dim, vendor_dim, bridge, fact)


def _as_of(spark, sf, **options):
    versions = stage(
        scd2.build_versions(
            masters(spark, sf),
            scd2.collapse_same_day(v.history(spark, sf)),
            tracked={"salary": "new_salary"}, carried=["full_name"],
        ),
        "versions",
    )
    facts = v.transactions(spark, sf, "transaction_id", "approved_by", "transaction_date")
    return joins.as_of_join(
        facts, versions, key="approved_by", day="transaction_date",
        version_key="employee_id", value="salary", name="salary_then", **options,
    )


@query
def as_of_join(spark, sf):
    return _as_of(spark, sf)


@query
def as_of_join_merge(spark, sf):
    """The same join on the path taken when the versions are too large to broadcast."""
    return _as_of(spark, sf, broadcast_rows=0)


@query
def surrogate_keys(spark, sf):
    orders = v.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    return sequence.dense_key(orders, "order_key", ["o_custkey", "o_orderkey"])


@query
def star_constraints(spark, sf):
    """Keys and references of the built facts, as a database would enforce them."""
    dims = {
        "dim_project": project_keys(spark, sf),
        "dim_vendor": star.dim_vendor(v.transactions(spark, sf)),
        "dim_employee": employee_versions(spark, sf),
    }  # like the facts, they are written when they get their keys
    facts = star.fact_transactions(
        enriched(spark, sf), dims["dim_project"], dims["dim_vendor"], dims["dim_employee"])
    config = {"fact": {
        "pk_columns": ["transaction_key"],
        "foreign_keys": {
            "project_key": ("dim_project", "project_key"), "vendor_key": ("dim_vendor", "vendor_key"),
            "employee_key": ("dim_employee", "employee_key"),
        },
    }}
    return counted(quality.run_checks(
        facts, "fact", config=config, references=dims, as_of=v.AS_OF,
        only=["uniqueness", "referential_integrity"]))


# --- sources ----------------------------------------------------------------------------------

@query
def transactions_from_json(spark, sf):
    """Transactions written as JSON and read again, cut into records by several tasks."""
    path = new_path(spark, "json")
    writers.write_json(v.transactions(spark, sf), path, "gzip")
    return readers.read_transactions(spark, path).select(
        "transaction_id", "project_id", "amount", "transaction_date", "category")


@query
def events_from_json_lines(spark, sf):
    path = new_path(spark, "jsonl")
    v.events(spark, sf).write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ssX").json(path)
    return readers.read_events(spark, path).select(
        "event_id", "event_type", "project_id", F.col("payload")["severity"].alias("severity"),
        F.to_date("timestamp").alias("event_date"))


@query
def notes_through_csv(spark, sf):
    """Documents as free-text cells with line breaks, quotes and delimiters, written and read again."""
    path = new_path(spark, "notes")
    docs = v.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), "text")
    writers.write_csv(docs, path)
    back = readers.read_csv(spark, path, docs.schema)
    return back.select(F.col("id").cast("long").alias("doc_id"), F.md5("text").alias("digest"))


# --- events -----------------------------------------------------------------------------------

@query
def events_clean(spark, sf):
    return events.clean_events(v.events_delivered_twice(spark, sf)).drop("payload")


@query
def event_cleaning_counts(spark, sf):
    return events.cleaning_counts(v.events_delivered_twice(spark, sf))


@query
def project_activity_summary(spark, sf):
    return events.project_activity_summary(clean_events(spark, sf))


@query
def user_activity_summary(spark, sf):
    return events.user_activity_summary(clean_events(spark, sf))


@query
def escalation_log(spark, sf):
    return events.escalation_log(clean_events(spark, sf))


@query
def escalation_stats(spark, sf):
    return events.escalation_stats(events.escalation_log(clean_events(spark, sf)))


@query
def daily_event_volume(spark, sf):
    return events.daily_event_volume(clean_events(spark, sf))


@query
def events_per_day(spark, sf):
    return events.events_per_day(events.daily_event_volume(clean_events(spark, sf)))


@query
def peak_usage_analysis(spark, sf):
    return events.peak_usage_analysis(clean_events(spark, sf))


@query
def event_job(spark, sf):
    """The whole event job; rows of every table it wrote."""
    folder = new_path(spark, "event-job")
    jobs.event_tables(v.events_delivered_twice(spark, sf), folder)
    counts = [
        spark.read.parquet(f"{folder}/{name}").agg(
            F.lit(name).alias("table_name"), F.count("*").alias("rows")
        )
        for name in events.EVENT_TABLES
    ]
    result = counts[0]
    for one in counts[1:]:
        result = result.unionByName(one)
    return result


@query
def foundations_job(spark, sf):
    """Raw files in, clean files and summaries out; everything the run counted."""
    folder = new_path(spark, "foundations")
    raw = {
        "projects": v.projects(spark, sf),
        "employees": v.employees(spark, sf).orderBy("row_seq").drop("row_seq"),
        "history": v.history(spark, sf).orderBy("row_seq").drop("row_seq").withColumns({
            "previous_role": F.lit(None).cast("string"),
            "previous_level": F.lit(None).cast("string"),
        }),
    }
    for name, df in raw.items():
        writers.write_csv(df, f"{folder}/raw/{name}")
    inputs = jobs.Inputs(*[f"{folder}/raw/{name}" for name in raw])
    run = jobs.foundations(spark, inputs, f"{folder}/out", v.LIMITS)
    return jobs.metrics_table(spark, run)


@query
def full_etl_job(spark, sf):
    """Raw CSV and JSON files in; clean, enriched and checked tables, reports and summaries out."""
    folder = new_path(spark, "full-etl")
    raw = {
        "projects": v.projects(spark, sf),
        "employees": v.employees(spark, sf).orderBy("row_seq").drop("row_seq"),
        "history": v.history(spark, sf).orderBy("row_seq").drop("row_seq").withColumns({
            "previous_role": F.lit(None).cast("string"),
            "previous_level": F.lit(None).cast("string"),
        }),
    }
    for name, df in raw.items():
        writers.write_csv(df, f"{folder}/raw/{name}", "gzip")
    writers.write_json(v.transactions(spark, sf), f"{folder}/raw/transactions", "gzip")
    inputs = jobs.Inputs(
        f"{folder}/raw/projects", f"{folder}/raw/employees", f"{folder}/raw/history",
        f"{folder}/raw/transactions")
    run = jobs.full_etl(spark, inputs, f"{folder}/out", v.LIMITS, compression="gzip")
    return jobs.metrics_table(spark, run)


# --- dashboard --------------------------------------------------------------------------------

@query
def kpi_cards(spark, sf):
    return dashboard.kpi_cards(
        clean_projects(spark, sf), v.transactions(spark, sf, "transaction_id")
    )


@query
def kpi_cards_sliced(spark, sf):
    projects = dashboard.slice_projects(clean_projects(spark, sf), region="ASIA", status="Completed")
    rows = v.transactions(spark, sf, "project_id", "transaction_date")
    return dashboard.kpi_cards(projects, dashboard.slice_transactions(rows, projects, year=1997))


@query
def dept_budget_vs_actual(spark, sf):
    return dashboard.budget_vs_actual(clean_projects(spark, sf))


@query
def trend_top_categories(spark, sf):
    rows = spend(spark, sf, "category", "transaction_date")
    return dashboard.trend_of_top_categories(rows)


@query
def top_budget_variance(spark, sf):
    return dashboard.top_budget_variance(clean_projects(spark, sf))


@query
def vendor_top5_other(spark, sf):
    return dashboard.vendor_split(spend(spark, sf, "vendor_name"))


@query
def vendor_share(spark, sf):
    sums = spend(spark, sf, "vendor_name").groupBy("vendor_name").agg(
        F.sum("amount_aed").alias("spend")
    )
    shares = grouping.share_of_total(sums, "spend", "pct")
    return shares.select("vendor_name", F.round("pct", 2).alias("pct")).orderBy(
        F.col("pct").desc(), "vendor_name"
    ).limit(8)


# --- streams ----------------------------------------------------------------------------------

def _event_stream(spark, sf):
    schema = v.table(spark, sf, "events").schema
    raw = feed.file_events(spark, f"{sf}/events*.parquet", schema, format="parquet")
    return v.as_events(raw)


@query
def stream_event_counts(spark, sf):
    path = new_path(spark, "counts")
    feed.count_to_snapshot(_event_stream(spark, sf), path)
    return feed.read_snapshot(spark, path, feed.COUNTS)


@query
def stream_critical_route(spark, sf):
    path = new_path(spark, "critical")
    feed.route_critical(_event_stream(spark, sf), feed.file_sink(path))
    routed = spark.read.schema("key string, value string").parquet(path)
    event = F.from_json("value", feed.MESSAGE)
    return routed.select("key", event.alias("e")).select(
        "key", F.col("e.event_id").cast("long").alias("event_id"),
        F.col("e.project_id").cast("long").alias("project_id"),
        F.col("e.payload")["severity"].alias("severity"),
    )


@query
def stream_publish(spark, sf):
    path = new_path(spark, "topic")
    feed.publish(_event_stream(spark, sf), feed.file_sink(path))
    raw = spark.read.schema("key string, value string").parquet(path)
    return feed.decode(raw).select(
        F.col("event_id").cast("long").alias("event_id"), "event_type",
        F.col("produced_at").isNotNull().alias("stamped"),
    )


@query
def stream_totals(spark, sf):
    """The ledger of a run: messages, critical, late and malformed rows by type."""
    path = new_path(spark, "totals")
    feed.totals(_event_stream(spark, sf), path)
    return ledger.newest(spark, path, ledger.TOTALS).where("event_type is not null").select(
        "event_type", "messages", "forwarded", "late", "malformed")


@query
def stream_publish_in_order(spark, sf):
    path, state = new_path(spark, "ordered"), new_path(spark, "sequences")
    feed.publish_in_order(_event_stream(spark, sf), path, state)
    sent = spark.read.schema("key string, value string, sequence long").parquet(path)
    event_id = F.get_json_object("value", "$.event_id").cast("long")
    return sent.select("key", event_id.alias("event_id"), "sequence")


@query
def stream_dedup_window(spark, sf):
    path = new_path(spark, "live-events")
    clean = live.clean_live_events(_event_stream(spark, sf))
    feed.run(clean, feed.file_sink(path), name="clean")
    schema = "event_id long, event_type string, event_date date, event_hour int"
    return spark.read.schema(schema).parquet(path)


# --- policy -----------------------------------------------------------------------------------

@query
def pii_masked_view(spark, sf):
    return policy.persona_view(people(spark, sf), "employees", "bi_analyst")


@query
def executive_view(spark, sf):
    rows = v.transactions(spark, sf, "category", "payment_status", "amount")
    return policy.persona_view(rows, "transactions", "executive")


@query
def retention_split(spark, sf):
    split = policy.split_by_retention(
        v.transactions(spark, sf, "transaction_date"), "transactions", "transaction_date", v.AS_OF,
        years={"transactions": (23, 26)},
    )
    return split.groupBy("retention").agg(
        F.count("*").alias("rows"), F.min("transaction_date").alias("first_day"),
        F.max("transaction_date").alias("last_day"),
    )


@query
def anonymised_leavers(spark, sf):
    staff = people(spark, sf).withColumn(
        "left_on",
        F.when(F.col("status") == "Inactive", F.date_add(F.lit(v.dt.date(2015, 1, 1)),
                                                        (F.col("employee_id") % 3000).cast("int"))),
    )
    return policy.anonymise_leavers(staff, "left_on", v.AS_OF).drop("row_seq")


@query
def anonymised_bands(spark, sf):
    return policy.salary_bands(v.history(spark, sf), width=50000)
