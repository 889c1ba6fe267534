"""Fill of missing check-in/check-out times and the shift duration rule.

Inputs are BIGINT seconds of day. Each rule is written in its effective form
(conditions no time of day can satisfy are left out) and keeps the
workload's quirks: no wrap over midnight, negative or mirrored durations.

The rules are Spark SQL ``CASE`` expressions over column names (or any SQL
operand): one parse in the JVM instead of one Python call per node. The
``*_sql`` functions return that text.
"""

from __future__ import annotations

from ..schemas import DEFAULT_SHIFT_SECONDS, EVENING_END, MORNING_START, NOON


def fill_checkin_sql(checkin: str = "checkin", checkout: str = "checkout", rule: str = "noon",
                     checkin_missing: str | None = None) -> str:
    """Check-in with a missing value filled from the check-out.

    ``checkin_missing`` tells whether the *raw* value was absent; it differs
    from ``checkin IS NULL`` only for text input that failed to parse, which
    is never filled.

    * ``morning``: out > 08:00 -> 08:00; out < 08:00 -> 17:00; else stays NULL.
    * ``noon``: 0 < out < 12:00 -> 17:00; else stays NULL.
    """
    missing = checkin_missing or f"({checkin}) IS NULL"
    if rule == "morning":
        return (f"CASE WHEN {missing} AND ({checkout}) > {MORNING_START} THEN {MORNING_START}L "
                f"WHEN {missing} AND ({checkout}) < {MORNING_START} THEN {EVENING_END}L "
                f"ELSE CAST({checkin} AS BIGINT) END")
    if rule == "noon":
        return (f"CASE WHEN {missing} AND ({checkout}) > 0 AND ({checkout}) < {NOON} "
                f"THEN {EVENING_END}L ELSE CAST({checkin} AS BIGINT) END")
    raise ValueError(f"unknown fill rule {rule!r}")


def fill_checkout_sql(checkin: str = "checkin", checkout: str = "checkout", rule: str = "noon",
                      checkout_missing: str | None = None) -> str:
    """Check-out with a missing value filled from the (raw) check-in.

    * ``morning``: in > 08:00 -> 17:00; in < 08:00 -> 08:00; else stays NULL.
    * ``noon``: 0 < in < 12:00 -> 17:00; else stays NULL.
    """
    missing = checkout_missing or f"({checkout}) IS NULL"
    if rule == "morning":
        return (f"CASE WHEN {missing} AND ({checkin}) > {MORNING_START} THEN {EVENING_END}L "
                f"WHEN {missing} AND ({checkin}) < {MORNING_START} THEN {MORNING_START}L "
                f"ELSE CAST({checkout} AS BIGINT) END")
    if rule == "noon":
        return (f"CASE WHEN {missing} AND ({checkin}) > 0 AND ({checkin}) < {NOON} "
                f"THEN {EVENING_END}L ELSE CAST({checkout} AS BIGINT) END")
    raise ValueError(f"unknown fill rule {rule!r}")


def shift_seconds_sql(checkin: str = "checkin_new", checkout: str = "checkout_new",
                      rule: str = "noon") -> str:
    """Worked seconds of one day, first matching branch wins.

    * ``evening``: in < 17:00 -> out-in; in > 17:00 -> in-out;
      out < 17:00 -> in-out; out > 17:00 -> out-in; else 9 h. A NULL operand
      in the chosen branch gives NULL (the day still counts).
    * ``noon``: 0 < in < 12:00 -> out-in; 0 < out < 12:00 -> in-out; else 9 h.
    * ``noon_default``: either NULL -> 9 h; 0 < in < 12:00 -> out-in;
      in >= 12:00 -> in-out; out > 12:00 -> out-in; 0 < out < 12:00 -> in-out;
      else 9 h.
    """
    i, o = f"({checkin})", f"({checkout})"
    fwd, bwd, default = f"{o} - {i}", f"{i} - {o}", f"{DEFAULT_SHIFT_SECONDS}L"
    if rule == "evening":
        body = (f"WHEN {i} < {EVENING_END} THEN {fwd} WHEN {i} > {EVENING_END} THEN {bwd} "
                f"WHEN {o} < {EVENING_END} THEN {bwd} WHEN {o} > {EVENING_END} THEN {fwd}")
    elif rule == "noon":
        body = (f"WHEN {i} > 0 AND {i} < {NOON} THEN {fwd} "
                f"WHEN {o} > 0 AND {o} < {NOON} THEN {bwd}")
    elif rule == "noon_default":
        body = (f"WHEN {i} IS NULL OR {o} IS NULL THEN {default} "
                f"WHEN {i} > 0 AND {i} < {NOON} THEN {fwd} WHEN {i} >= {NOON} THEN {bwd} "
                f"WHEN {o} > {NOON} THEN {fwd} WHEN {o} > 0 AND {o} < {NOON} THEN {bwd}")
    else:
        raise ValueError(f"unknown duration rule {rule!r}")
    return f"CAST(CASE {body} ELSE {default} END AS BIGINT)"

