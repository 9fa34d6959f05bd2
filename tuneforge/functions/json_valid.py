"""JSON validity (F2) with the semantics of Python's ``json.loads``.

Any JSON value is valid (scalars, ``NaN``/``Infinity``, duplicate keys); trailing text, single
quotes, unquoted keys and raw control characters inside strings are not. Spark's JSON functions
accept trailing text, so the check runs in an Arrow UDF on the executors; the
extraction afterwards uses the built-in JSON functions.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def _valid(v) -> bool | None:
    if v is None:
        return None
    try:
        json.loads(v)
        return True
    except (ValueError, RecursionError):
        return False


def _json_valid_batch(v: pa.Array) -> pa.Array:
    return pa.array([_valid(x) for x in v.to_pylist()], type=pa.bool_())


def json_valid(c) -> Column:
    """True when ``json.loads`` accepts the text, False when it raises, null for null."""
    udf = F.arrow_udf(_json_valid_batch, "boolean")  # built per call: executors import this module too
    return udf(F.col(c) if isinstance(c, str) else c)
