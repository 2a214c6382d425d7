"""Joins against small, derived tables (group statistics, verdict lists).

The small side is computed once and fetched with a hard row bound (``limit(n + 1)``).
If it fits, it becomes a local relation that is broadcast (exactly what a broadcast
join does internally, with the size proven first), so the big side is never shuffled
and the small side is not recomputed inside the main job. If it does not fit, the join
shuffles; rows whose key is NULL can never match an equi-join, so they bypass that
shuffle instead of all hashing into one task, and AQE skew-join splitting covers any
remaining hot key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest small side (rows) we broadcast. Group-statistics tables hold one row per
# group and verdict lists one short row per file, so this stays far below executor and
# driver memory.
BROADCAST_MAX_ROWS = 100_000


def fetch_small(small: DataFrame, max_rows: int = BROADCAST_MAX_ROWS):
    """The rows of ``small`` if there are at most ``max_rows`` of them, else ``None``."""
    head = small.limit(max_rows + 1).collect()
    return None if len(head) > max_rows else head


def checked_small(small: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> tuple[DataFrame, bool]:
    """Fetch at most ``max_rows + 1`` rows of ``small``. Returns a local (literal) copy
    when it fits, else the original plan and ``False``."""
    head = small.limit(max_rows + 1).collect()
    if len(head) > max_rows:
        return small, False
    return small.sparkSession.createDataFrame(head, small.schema), True


def join_small(
    big: DataFrame,
    small: DataFrame,
    keys: list[str],
    how: str = "left",
    null_safe: bool = False,
    max_rows: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """``big JOIN small USING (keys)``. ``small`` must be derived and low-cardinality.

    ``null_safe`` makes NULL keys match each other (``<=>``), which a window
    ``PARTITION BY`` would also do.
    """
    small, fits = checked_small(small, max_rows)
    renamed = small.select(
        *[F.col(k).alias(f"__key_{i}") for i, k in enumerate(keys)],
        *[F.col(c) for c in small.columns if c not in keys],
    )
    key_cols = [f"__key_{i}" for i in range(len(keys))]

    def condition():
        parts = [
            big[k].eqNullSafe(F.col(kc)) if null_safe else big[k] == F.col(kc)
            for k, kc in zip(keys, key_cols)
        ]
        return reduce(lambda a, b: a & b, parts)

    if fits:
        return big.join(F.broadcast(renamed), condition(), how).drop(*key_cols)
    if null_safe or how not in ("left", "inner", "left_semi", "left_anti"):
        return big.join(renamed, condition(), how).drop(*key_cols)

    has_keys = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    keyed = big.where(has_keys)
    joined = keyed.join(renamed, condition(), how).drop(*key_cols)
    if how in ("inner", "left_semi"):
        return joined
    unkeyed = big.where(~has_keys)
    return joined.unionByName(unkeyed, allowMissingColumns=True)
