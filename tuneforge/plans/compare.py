"""Order-insensitive comparison of a Spark result with an oracle result (columns by name)."""

from __future__ import annotations

import datetime
import decimal


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def same_result(cols_a, rows_a, cols_b, rows_b) -> tuple[bool, str]:
    ca, ra = canon(cols_a, rows_a)
    cb, rb = canon(cols_b, rows_b)
    if ca != cb:
        return False, f"columns {ca} vs {cb}"
    if ra != rb:
        sb = set(rb)
        only_a = [r for r in ra if r not in sb][:2]
        return False, f"rows {len(ra)} vs {len(rb)}; first differing {str(only_a)[:300]}"
    return True, "ok"
