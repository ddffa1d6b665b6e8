"""Join helper for hot keys.

Which side is broadcast is left to Spark: by the estimated size when a plan is made, by the measured
bytes of a shuffle when it runs (adaptive execution). What that cannot see is a join whose *output*
is skewed, or one whose other side is an aggregate; for these a hot key is split explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Hot keys that are split at most: their table is broadcast (a key and a number each, some tens of MB).
# Keys beyond it are joined unsplit; a join of N rows has at most N / rows_per_task hot keys.
MAX_HOT_KEYS = 1_000_000

# A key of the big side holding more rows than this is split over several join tasks.
DEFAULT_ROWS_PER_TASK = 2_000_000


def hot_keys(key_counts: DataFrame, key: str, rows_per_task: int, max_hot_keys: int = MAX_HOT_KEYS) -> DataFrame:
    """``key, _nsalt`` of the keys with more than ``rows_per_task`` rows: the hottest
    ``max_hot_keys`` of them in a total order, so every use sees the same table; broadcast."""
    hot = key_counts.filter(F.col("n") > rows_per_task).select(
        key, F.ceil(F.col("n") / F.lit(rows_per_task)).cast("int").alias("_nsalt")
    )
    return F.broadcast(hot.orderBy(F.col("_nsalt").desc(), F.col(key).asc()).limit(max_hot_keys))


def skew_safe_join(
    big: DataFrame,
    small: DataFrame,
    key: str,
    key_counts: DataFrame,
    salt_cols: list[str],
    how: str = "inner",
    rows_per_task: int = DEFAULT_ROWS_PER_TASK,
    max_hot_keys: int = MAX_HOT_KEYS,
) -> DataFrame:
    """Equi-join ``big`` and ``small`` on ``key`` with hot keys split across tasks.

    ``key_counts`` (``key``, ``n``) gives (an upper bound of) the work per key: its rows of ``big``, or
    the rows that its join gives. A key
    with ``n > rows_per_task`` is hot and gets ``s = ceil(n / rows_per_task)`` salts: each
    of its ``big`` rows takes salt ``pmod(xxhash64(salt_cols), s)``, a deterministic value
    (a retried task recomputes the same salt), and each of its ``small`` rows is replicated
    once per salt. The join then runs on (key, salt), so a key holding a third of all rows is
    spread over ``s`` tasks and every (big, small) match is still produced exactly once.

    The hot-key table is broadcast with a bound by construction: it holds the
    ``max_hot_keys`` hottest keys in a total order (most rows first, then key), so both
    sides see the same table even if it is recomputed. There are at most
    total_rows / rows_per_task hot keys, so normally all of them fit; any beyond the bound keep
    salt 0 and take the plain path. Results are exact either way; no extra job runs.
    ``how`` may be ``inner`` or ``left`` (big preserved).
    """
    hot_b = hot_keys(key_counts, key, rows_per_task, max_hot_keys)
    nsalt = F.coalesce(F.col("_nsalt"), F.lit(1))
    b = big.join(hot_b, on=key, how="left").withColumn("_salt", F.pmod(F.xxhash64(*salt_cols), nsalt).cast("int"))
    s = small.join(hot_b, on=key, how="left").withColumn("_salt", F.explode(F.sequence(F.lit(0), nsalt - 1)))
    return b.drop("_nsalt").join(s.drop("_nsalt"), on=[key, "_salt"], how=how).drop("_salt")
