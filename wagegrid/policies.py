"""The three rule sets of the pay-rate job as explicit, frozen policies.

The workload exists in four forms that give different answers on the same
input. Each difference is one field here; the operators read the policy and
never branch on a variant name.

* ``POLICY_A`` – SQL pipeline: 08:00 fill boundary, 17:00 duration chain,
  raw employee table (duplicates double the days), 0 salaries kept, NULL
  group keys kept, result rounded to 2 places in the query, full refresh.
* ``POLICY_B`` – SQL notebook: noon-only fill, noon duration chain, latest
  employee record with NULLs first, rounding only on load, full refresh.
* ``POLICY_C`` – Python pipeline: as B but NULL/unparseable times give 9 h,
  latest record with NULLs last, zero salaries and NULL keys dropped, no
  rounding, keyed upsert of the result.
* ``POLICY_D`` – Python notebook: transform of C, result appended by new key.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Policy:
    name: str
    # "morning": 08:00 boundary both ways; "noon": only 0 < t < 12:00 fills.
    fill: str
    # "evening" (17:00 chain, NULL possible), "noon" (12:00 chain),
    # "noon_default" (NULL/unparseable -> 9 h first, then the 12:00 chain).
    duration: str
    # None: raw employees; "nulls_first"/"nulls_last": latest record per id
    # ordered by join_date DESC, salary DESC with that NULL placement.
    latest_employee: str | None
    drop_zero_salary: bool
    drop_null_keys: bool
    # "query": round(x, 2) in the query; "load": cast to DECIMAL(10,2) when
    # loaded; None: never rounded.
    rounding: str | None
    # Ordering of the result rows (empty: none).
    order_by: tuple[str, ...]
    # Load of the result: "full_refresh", "upsert" or "append_new_keys".
    load: str
    # Time columns arrive as text and unparseable values become NULL.
    coerce_times: bool


POLICY_A = Policy(
    name="a", fill="morning", duration="evening", latest_employee=None,
    drop_zero_salary=False, drop_null_keys=False, rounding="query",
    order_by=("branch_id", "year", "month"), load="full_refresh",
    coerce_times=False,
)
POLICY_B = Policy(
    name="b", fill="noon", duration="noon", latest_employee="nulls_first",
    drop_zero_salary=False, drop_null_keys=False, rounding="load",
    order_by=(), load="full_refresh", coerce_times=False,
)
POLICY_C = Policy(
    name="c", fill="noon", duration="noon_default", latest_employee="nulls_last",
    drop_zero_salary=True, drop_null_keys=True, rounding=None,
    order_by=("branch_id", "year", "month"), load="upsert", coerce_times=True,
)
POLICY_D = Policy(
    name="d", fill="noon", duration="noon_default", latest_employee="nulls_last",
    drop_zero_salary=True, drop_null_keys=True, rounding=None,
    order_by=("branch_id", "year", "month"), load="append_new_keys",
    coerce_times=True,
)

POLICIES = {p.name: p for p in (POLICY_A, POLICY_B, POLICY_C, POLICY_D)}


def get_policy(policy: Policy | str) -> Policy:
    if isinstance(policy, Policy):
        return policy
    try:
        return POLICIES[policy.lower()]
    except KeyError:
        raise ValueError(f"unknown policy {policy!r}; expected one of {sorted(POLICIES)}") from None
