"""Schemas of the raw inputs. Suspect columns stay text so that bad values can be counted."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_text, _date, _money, _int = T.StringType(), T.DateType(), T.DoubleType(), T.IntegerType()

PROJECTS = _struct(
    project_id=_text, project_name=_text, department=_text, status=_text,
    start_date=_date, end_date=_date, budget=_money, actual_cost=_money,
    project_manager_id=_text, priority=_text, region=_text,
)

EMPLOYEES = _struct(
    employee_id=_text, full_name=_text, email=_text, department=_text, role=_text, level=_text,
    hire_date=_text, salary=_money, manager_id=_text, region=_text, status=_text,
    years_experience=_int,
)

SALARY_HISTORY = _struct(
    employee_id=_text, previous_salary=_money, new_salary=_money, previous_role=_text,
    new_role=_text, previous_level=_text, new_level=_text, effective_date=_date,
    change_type=_text, change_reason=_text,
)

TRANSACTIONS = _struct(
    transaction_id=_text, project_id=_text, vendor_id=_text, vendor_name=_text, category=_text,
    amount=_money, currency=_text, transaction_date=_date, approved_by=_text,
    payment_status=_text, invoice_ref=_text, notes=_text,
)

EVENTS = _struct(
    event_id=_text, event_type=_text, project_id=_text, user_id=_text,
    timestamp=T.TimestampType(), payload=T.MapType(_text, _text),
)



def _extended(base: T.StructType, **fields: T.DataType) -> T.StructType:
    """`base` with columns added or retyped."""
    kept = [T.StructField(f.name, fields.pop(f.name, f.dataType)) for f in base]
    return T.StructType([*kept, *_struct(**fields)])


_flag = T.BooleanType()

CLEAN = {
    "projects": _extended(
        PROJECTS, budget_variance=_money, is_over_budget=_flag, duration_days=_int,
        budget_utilisation_pct=_money, status_category=_text, risk_level=_text,
    ),
    "employees": _extended(EMPLOYEES, hire_date=_date, dq_flags=_text),
    "transactions": _extended(
        TRANSACTIONS, project_name=_text, department=_text, approver_name=_text,
        is_approved=_flag, amount_aed=_money, transaction_year_month=_text,
    ),
}

MONEY = T.DecimalType(18, 2)
SALARY = T.DecimalType(12, 2)
PERCENT = T.DecimalType(9, 2)
