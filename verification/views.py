"""The driver's tables seen as projects, employees, pay history, transactions and events.

Every row of the source tables stays in; only values are blanked or spoiled. The same views are
written in SQL in `oracles.py`.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import rules
from ledgerloom.plans.cleaning import EmployeeRules

AS_OF = dt.date(2024, 6, 30)
MONEY = "decimal(18,2)"
LEVELS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
LIMITS = EmployeeRules(
    as_of=AS_OF,
    salary_bands={level: (0, 8000) for level in LEVELS},
    experience_bands={level: (0, 20) for level in LEVELS},
    salary_range=(-500, 9500),
    experience_range=(0, 27),
)


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is read from the file footers once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def projects(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Orders as projects, their lines as cost; `columns` prunes as in `transactions`."""
    wanted = set(columns) or set(_PROJECT)
    df = table(spark, sf_dir, "orders")
    if wanted & {"department", "region"}:
        df = df.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    if "region" in wanted:
        nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
        df = df.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        df = df.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    if wanted & {"actual_cost", "end_date"}:
        cost = (
            table(spark, sf_dir, "lineitem")
            .groupBy("l_orderkey")
            .agg(
                F.sum(F.col("l_extendedprice").cast(MONEY)).cast(MONEY).alias("_cost"),
                F.max("l_shipdate").cast("date").alias("_last_ship"),
            )
        )
        df = df.join(cost, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return df.select(*[_PROJECT[c]().alias(c) for c in _PROJECT if c in wanted])


def _status():
    status = F.col("o_orderstatus")
    return F.when(status == "F", " completed").when(status == "O", "in   progress").otherwise(
        "ON HOLD "
    )


def _priority():
    priority = F.col("o_orderpriority")
    return F.when(priority == "1-URGENT", "Critical").when(priority == "2-HIGH", "High").otherwise(
        priority
    )


_PROJECT = {
    "project_id": lambda: F.col("o_orderkey"),
    "project_name": lambda: F.concat(F.lit("Project "), F.col("o_orderkey").cast("string")),
    "department": lambda: F.col("c_mktsegment"),
    "status": _status,
    "start_date": lambda: F.col("o_orderdate").cast("date"),
    "end_date": lambda: F.when(F.col("o_orderstatus") == "F", F.col("_last_ship")),
    "budget": lambda: F.when(F.col("o_orderkey") % 17 != 0, F.col("o_totalprice").cast(MONEY)),
    "actual_cost": lambda: F.col("_cost"),
    "project_manager_id": lambda: F.col("o_custkey"),
    "priority": _priority,
    "region": lambda: F.col("r_name"),
}
PROJECT_COLUMNS = tuple(_PROJECT)


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as employees; suppliers are a second file whose ids repeat customer ids."""
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.lit(0).alias("file"), F.col("c_mktsegment").alias("level"),
        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("bal"),
    )
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.lit(1).alias("file"), F.lit("BUILDING").alias("level"),
        F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("bal"),
    )
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    i = F.col("id")
    letters = F.translate(i.cast("string"), "0123456789", "abcdefghij")
    previous = F.translate((i - 1).cast("string"), "0123456789", "abcdefghij")
    name = F.when(i % 150 == 0, F.lit("Pat Common")).otherwise(F.concat(F.lit("Pat "), letters))
    email = (
        F.when(i % 75 == 0, F.when(i % 2 == 0, F.lit("  ")))
        .when(i % 300 == 76, F.concat(F.lit("pat."), previous, F.lit("@example.com")))
        .otherwise(F.concat(F.lit("user"), i.cast("string"), F.lit("@example.com")))
    )
    day = F.date_add(F.lit(dt.date(2000, 1, 1)), (i % 5000).cast("int"))
    hired = (
        F.when(i % 200 == 0, "-999")
        .when(i % 333 == 0, "99999-01-01")
        .when(i % 250 == 0, "1980-01-01")
        .when(i % 410 == 0, "2031-2-5")
        .otherwise(day.cast("string"))
    )
    both = customer.unionByName(supplier)
    return (
        both.join(nation, F.col("nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            i.alias("employee_id"),
            F.when(i % 50 == 0, F.concat(name, F.lit(" "))).otherwise(name).alias("full_name"),
            email.alias("email"),
            F.col("n_name").alias("department"),
            F.concat(F.lit("Role "), (i % 5).cast("string")).alias("role"),
            "level",
            hired.alias("hire_date"),
            F.col("bal").cast(MONEY).alias("salary"),
            F.when(i % 500 == 0, F.lit(-1)).when(i > 9, F.floor(i / 10)).cast("long")
            .alias("manager_id"),
            F.col("r_name").alias("region"),
            F.when(i % 7 == 0, "Inactive").otherwise("Active").alias("status"),
            (i % 30 - 1).cast("int").alias("years_experience"),
            (i * 2 + F.col("file")).alias("row_seq"),
        )
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as pay changes. Every twentieth customer's go to the neighbour before, so that some
    people have no history."""
    person = F.col("o_custkey")
    change = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "Hire")
        .when(F.col("o_orderpriority") == "2-HIGH", "Promotion")
        .otherwise("Annual Raise")
    )
    return (
        table(spark, sf_dir, "orders")
        .select(
            F.when(person % 20 == 0, person - 1).otherwise(person).alias("employee_id"),
            F.when(change != "Hire", (F.col("o_totalprice") / 2).cast(MONEY))
            .alias("previous_salary"),
            F.col("o_totalprice").cast(MONEY).alias("new_salary"),
            F.concat(F.lit("Role "), F.col("o_orderpriority")).alias("new_role"),
            F.col("o_orderpriority").alias("new_level"),
            F.col("o_orderdate").cast("date").alias("effective_date"),
            change.alias("change_type"),
            F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("change_reason"),
            F.col("o_orderkey").alias("row_seq"),
        )
    )


def transactions(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Lines as transactions with their vendors, categories and approvers.

    Every line has its order, part and supplier, so a query that names its `columns` joins only
    the tables they come from.
    """
    wanted = set(columns) or set(_TRANSACTION)
    df = table(spark, sf_dir, "lineitem")
    if "category" in wanted:
        df = df.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if "vendor_name" in wanted:
        df = df.join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    if "approved_by" in wanted:  # last, so that the rows lie by project for who looks that up next
        df = df.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return df.select(*[_TRANSACTION[c]().alias(c) for c in _TRANSACTION if c in wanted])


def _transaction_id():
    identity = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return F.concat_ws("-", *[F.col(c).cast("string") for c in identity])


def _payment_status():
    flag = F.col("l_returnflag")
    return F.when(flag == "N", "Pending").when(flag == "R", "Disputed").otherwise("Paid")


_TRANSACTION = {
    "transaction_id": _transaction_id,
    "project_id": lambda: F.col("l_orderkey"),
    "vendor_id": lambda: F.col("l_suppkey"),
    "vendor_name": lambda: F.concat(F.lit("Group "), F.col("s_nationkey").cast("string")),
    "category": lambda: F.col("p_type"),
    "amount": lambda: F.when(F.col("l_quantity") != 1, F.col("l_extendedprice").cast(MONEY)),
    "currency": lambda: F.lit("AED"),
    "transaction_date": lambda: F.col("l_shipdate").cast("date"),
    "approved_by": lambda: F.when(F.col("l_linenumber") != 7, F.col("o_custkey")),
    "payment_status": _payment_status,
    "invoice_ref": lambda: F.concat(F.lit("INV-"), F.col("l_partkey").cast("string")),
    "notes": lambda: F.when(F.col("l_discount") > 0, F.lit("discounted")),
}
TRANSACTION_COLUMNS = tuple(_TRANSACTION)


_EVENT_NAMES = {
    "error": rules.RAISED,
    "purchase": rules.RESOLVED,
    "signup": "login",
    "view": "logout",
    "click": rules.TASK_DONE,
}


def as_events(rows: DataFrame) -> DataFrame:
    """Web events as project events; works on a stream as well."""
    mapping = F.create_map(*[F.lit(x) for pair in _EVENT_NAMES.items() for x in pair])
    k = F.get_json_object("props", "$.k").cast("int")
    severity = (
        F.when(k >= 90, "Critical").when(k >= 60, "High").when(k >= 30, "Medium")
    )
    payload = F.create_map(
        F.lit("severity"), severity, F.lit("resolved_by"), F.col("user_id").cast("string")
    )
    return rows.select(
        "event_id",
        mapping[F.col("event_type")].alias("event_type"),
        F.when(F.col("event_type") != "signup", F.col("user_id") % 20).alias("project_id"),
        "user_id",
        F.col("ts").cast("timestamp").alias("timestamp"),
        payload.alias("payload"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_events(table(spark, sf_dir, "events"))


def events_delivered_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event once more an hour later, as at-least-once delivery may do."""
    once = events(spark, sf_dir)
    again = once.withColumn("timestamp", F.col("timestamp") + F.expr("interval 1 hour"))
    return once.unionByName(again)
