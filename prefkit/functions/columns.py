"""Column-level building blocks.

Every function returns a ``Column`` made of built-in expressions, so it stays inside
whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The genre separator of the items file and the split thresholds on the
# timestamp's last digit (bucket < 6 train, 6..8 validation, 9 test), as the reference's code has them.
GENRE_SEPARATOR = "|"
TRAIN_BELOW = 6
VALIDATION_UPTO = 8


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def genre_list(genres="genres") -> Column:
    """Split a pipe-separated genre string into ``array<string>``.

    Empty entries are dropped wherever they occur (rule D5): ``'A||B'`` -> ``[A, B]``,
    ``'A|B||'`` -> ``[A, B]``. A repeated genre (``'A|A'``) is kept twice, as the reference's
    flat-map emits one row per listed entry. NULL genres give NULL.
    """
    parts = F.split(_col(genres), "[" + GENRE_SEPARATOR + "]")
    return F.filter(parts, lambda g: g != F.lit(""))


def java_remainder(c, m: int) -> Column:
    """``c % m`` with the sign of the dividend (Java/SQL remainder, not ``pmod``)."""
    return _col(c) % F.lit(m)


def timestamp_bucket(ts="ts") -> Column:
    """Last decimal digit of the epoch timestamp; negative for negative timestamps (rule P8)."""
    return java_remainder(ts, 10)


def split_label(bucket, train_below: int = TRAIN_BELOW, validation_upto: int = VALIDATION_UPTO) -> Column:
    """train / validation / test from a bucket. Follows the code (60/30/10), not its 60/20/20 comment."""
    b = _col(bucket)
    return (
        F.when(b < train_below, F.lit("train"))
        .when(b <= validation_upto, F.lit("validation"))
        .otherwise(F.lit("test"))
    )


def safe_div(num, den) -> Column:
    """``num / den`` with NULL for a zero denominator (ANSI mode raises on ``/0``)."""
    return _col(num) / F.nullif(_col(den), F.lit(0))


def tab_line(*cols) -> Column:
    """Tab-joined text of the given columns (the reference's record ``toString`` layout)."""
    return F.concat_ws("\t", *[_col(c).cast("string") for c in cols])
