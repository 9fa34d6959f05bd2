"""Row identity and seeded hash order.

Every permutation in the library is the order of ``md5(seed ':' salt ':' row_key)`` with the
row key as tie-break. md5 is available in Spark and in DuckDB, so an oracle can rebuild the
exact same order. A hex prefix of the hash is a uniform bucket id, which lets exact cuts run
without a global window (see ``operators.split``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hex digits of the hash used as the bucket id: 16**5 = 1,048,576 buckets. A per-group count
# table then has at most that many rows, and a boundary bucket holds ~n/1M rows.
BUCKET_HEX = 5


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_key(*parts) -> Column:
    """Provenance key as a string: parts joined by ':' (e.g. file, sheet, row)."""
    cols = [_col(p).cast("string") for p in parts]
    return cols[0] if len(cols) == 1 else F.concat_ws(":", *cols)


def shuffle_hash(key, seed, salt: str = "") -> Column:
    """Lower-case hex md5 of ``seed:salt:key``; ``seed`` may be an int or a Column."""
    seed_col = seed if isinstance(seed, Column) else F.lit(int(seed))
    return F.md5(F.concat_ws(":", seed_col.cast("string"), F.lit(salt), _col(key).cast("string")))


def hash_bucket(h, hex_digits: int = BUCKET_HEX) -> Column:
    """Integer bucket from the first ``hex_digits`` hex characters of a hash column."""
    return F.conv(F.substring(_col(h), 1, hex_digits), 16, 10).cast("int")
