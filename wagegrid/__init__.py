"""wagegrid: labour-cost analytics on Spark.

Attendance records and an employee table become average pay per worked
hour by branch and month. Three rule sets (policies A, B, C/D) run over one
set of DataFrame operators; see README.md.
"""

from .operators.dedupe import keep_last, latest_employee
from .operators.merge import append_new_keys, load_counts, upsert
from .operators.quality import describe, duplicate_check, quality_report
from .operators.rates import (branch_rates, employee_rates, gross_hours, monthly_attendance,
                              shift_hours)
from .policies import POLICIES, POLICY_A, POLICY_B, POLICY_C, POLICY_D, Policy, get_policy

__all__ = [
    "POLICIES", "POLICY_A", "POLICY_B", "POLICY_C", "POLICY_D", "Policy", "get_policy",
    "append_new_keys", "branch_rates", "describe", "duplicate_check", "employee_rates",
    "gross_hours", "keep_last", "latest_employee", "load_counts", "monthly_attendance",
    "quality_report", "shift_hours", "upsert",
]
