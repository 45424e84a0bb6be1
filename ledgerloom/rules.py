"""Business rules. Every table here is a fixed value of the workload, kept as plain data."""

from __future__ import annotations

import datetime as dt

# Plausible monthly salary per level.
SALARY_BANDS = {
    "Junior": (12000, 20000),
    "Mid": (17000, 24000),
    "Senior": (25000, 36000),
    "Lead": (38000, 50000),
    "Director": (50000, 70000),
}

# Plausible years of experience per level.
EXPERIENCE_BANDS = {
    "Junior": (0, 3),
    "Mid": (0, 6),
    "Senior": (0, 12),
    "Lead": (8, 18),
    "Director": (12, 25),
}

# Ranges that hold whatever the level is.
SALARY_RANGE = (10000, 100000)
EXPERIENCE_RANGE = (0, 50)
EARLIEST_HIRE = dt.date(1990, 1, 1)
SALARY_KEYING_FACTOR = 5

# Project status to reporting category.
STATUS_CATEGORY = {
    "In Progress": "Active",
    "Completed": "Closed",
    "Not Started": "Pending",
    "On Hold": "Pending",
}

# Labels of the audit trail, in the order the rules run.
AUDIT_LABELS = [
    "email_derived",
    "hire_date_invalid",
    "experience_imputed",
    "experience_level_mismatch",
    "salary_corrected",
    "active_without_hire_date_REVIEW",
    "manager_placeholder_nulled",
    "manager_inactive_REVIEW",
]

# Sentinels and labels of the version dimension.
OPEN_END = dt.date(9999, 12, 31)
UNKNOWN_START = dt.date(1900, 1, 1)
INITIAL_CHANGE = "Initial"
INITIAL_REASON = "No salary history — single version from employee master"

# Event types the event tables count by name.
RAISED = "escalation_raised"
RESOLVED = "escalation_resolved"
TASK_DONE = "task_completed"
UPLOADED = "document_uploaded"
SESSION_EVENTS = ("login", "logout")

# Calendar range of the date dimension.
CALENDAR = (dt.date(2000, 1, 1), dt.date(2030, 12, 31))

# Quality rules per dataset.
QUALITY_RULES = {
    "projects": {
        "completeness_threshold": 0.90,
        "completeness_optional": [
            "end_date", "duration_days", "budget_variance", "budget_utilisation_pct",
        ],
        "pk_columns": ["project_id"],
        "numeric_ranges": {
            "budget": {"min": 0, "max": 10000000},
            "actual_cost": {"min": 0, "max": 10000000},
        },
        "date_columns": {
            "start_date": {"allow_future": True},
            "end_date": {"allow_future": True},
        },
        "consistency_rules": [
            {"type": "before", "columns": ["start_date", "end_date"]},
            {"type": "non_negative", "column": "actual_cost"},
        ],
        "foreign_keys": {"project_manager_id": ("employees", "employee_id")},
        "distribution_max_share": {
            "threshold": 0.30, "columns": ["project_manager_id", "department"],
        },
        "outlier_zscore": {"threshold": 3, "columns": ["budget", "actual_cost"]},
    },
    "employees": {
        "completeness_threshold": 0.85,
        "completeness_optional": ["dq_flags", "manager_id"],
        "pk_columns": ["employee_id"],
        "numeric_ranges": {
            "salary": {"min": 10000, "max": 100000},
            "years_experience": {"min": 0, "max": 50},
        },
        "date_columns": {"hire_date": {"allow_future": False}},
        "consistency_rules": [
            {"type": "non_negative", "column": "salary"},
            {
                "type": "level_salary_band", "level_column": "level",
                "salary_column": "salary", "bands": SALARY_BANDS,
            },
        ],
        "foreign_keys": {"manager_id": ("employees", "employee_id")},
        "distribution_max_share": {"threshold": 0.30, "columns": ["department", "role"]},
        "outlier_zscore": {"threshold": 3, "columns": ["salary"]},
    },
    "transactions": {
        "completeness_threshold": 0.90,
        "completeness_optional": ["notes", "approver_name"],
        "pk_columns": ["transaction_id"],
        "numeric_ranges": {"amount": {"min": 0, "max": 5000000}},
        "date_columns": {"transaction_date": {"allow_future": False}},
        "consistency_rules": [{"type": "non_negative", "column": "amount"}],
        "foreign_keys": {
            "project_id": ("projects", "project_id"),
            "approved_by": ("employees", "employee_id"),
        },
        "distribution_max_share": {
            "threshold": 0.30, "columns": ["vendor_id", "category", "project_id"],
        },
        "freshness": {"date_column": "transaction_date", "max_age_days": 30},
        "outlier_zscore": {"threshold": 3, "columns": ["amount"]},
    },
    "employees_salary_history": {
        "completeness_threshold": 0.90,
        "completeness_optional": ["previous_salary", "previous_role", "previous_level"],
        "pk_columns": ["employee_id", "effective_date"],
        "numeric_ranges": {"new_salary": {"min": 10000, "max": 100000}},
        "date_columns": {"effective_date": {"allow_future": False}},
        "consistency_rules": [{"type": "non_negative", "column": "new_salary"}],
        "foreign_keys": {"employee_id": ("employees", "employee_id")},
    },
}

DEFAULT_COMPLETENESS = 0.9
CRITICAL_COMPLETENESS = 0.80
