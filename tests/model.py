"""Plain-Python statement of the shift rules, written from their description,
used as brute force against the Spark expressions on small unit tables."""

from __future__ import annotations

H8, H12, H17, NINE = 28800, 43200, 61200, 32400


def fill(ci, co, policy):
    """(checkin_new, checkout_new) from raw seconds (None = missing)."""
    if policy == "a":
        new_ci = ci
        if ci is None and co is not None:
            if co > H8:
                new_ci = H8
            elif co < H8:
                new_ci = H17
        new_co = co
        if co is None and ci is not None:
            if ci > H8:
                new_co = H17
            elif ci < H8:
                new_co = H8
        return new_ci, new_co
    # b, c: only the morning test can fire
    new_ci = H17 if (ci is None and co is not None and 0 < co < H12) else ci
    new_co = H17 if (co is None and ci is not None and 0 < ci < H12) else co
    return new_ci, new_co


def _sub(x, y):
    return None if x is None or y is None else x - y


def duration(ci, co, policy):
    """Worked seconds from filled times (None = NULL)."""
    if policy == "a":
        if ci is not None and ci < H17:
            return _sub(co, ci)
        if ci is not None and ci > H17:
            return _sub(ci, co)
        if co is not None and co < H17:
            return _sub(ci, co)
        if co is not None and co > H17:
            return _sub(co, ci)
        return NINE
    if policy == "b":
        if ci is not None and 0 < ci < H12:
            return _sub(co, ci)
        if co is not None and 0 < co < H12:
            return _sub(ci, co)
        return NINE
    # c
    if ci is None or co is None:
        return NINE
    if 0 < ci < H12:
        return co - ci
    if ci >= H12:
        return ci - co
    if co > H12:
        return co - ci
    if 0 < co < H12:
        return ci - co
    return NINE


def prorate(days: int, salary):
    """Exact decimal proration: > 22 days -> salary, else round(days/22, 2) * salary."""
    from decimal import ROUND_HALF_UP, Decimal

    if days > 22:
        return Decimal(salary)
    ratio = (Decimal(days) / Decimal(22)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    return ratio * Decimal(salary)
