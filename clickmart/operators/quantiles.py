"""Exact discrete percentiles with bounded memory, distributed.

The p-th percentile of n values is the k-th smallest, k = max(1, ceil(p * n)), which is
what an exact ``percentile_disc`` returns. A sketch cannot give that for every n with
bounded memory, and sorting a whole group in one task does not scale, so:

1. one pass per group: count and ``percentile_approx`` at p ± 4ε (ε = 1/accuracy). The
   sketch's rank error is at most ε·n, so the k-th value lies inside [lo, hi];
2. one aggregation: every value below ``lo`` falls into a single "below" bucket and
   every value inside the bracket into its own bucket (values above are dropped), with
   map-side partial counts, so a hot group costs nothing extra;
3. a two-level running count over the buckets of each (group, p), about 8ε·n rows at most:
   they are dealt over tasks by range of (group, p, value) and stored with the number of
   their range; the ranges' totals are summed up in order, which names the one range the
   k-th value lies in, and only that range's buckets are summed up one by one. No task
   holds more of a group than one range.

If the bracket ever missed (not expected within the sketch's guarantee), the query fails
with a message instead of returning an estimate.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmart.plans.joins import fetch_small, join_small
from clickmart.session import scratch_dir

DEFAULT_ACCURACY = 10000


def exact_percentiles(
    df: DataFrame,
    value: str,
    by: list[str],
    probs: list[float],
    names: list[str] | None = None,
    accuracy: int = DEFAULT_ACCURACY,
    extra: dict[str, Column] | None = None,
    keep_empty: bool = False,
) -> DataFrame:
    """One row per group of ``by`` that has a non-NULL ``value`` (with ``keep_empty`` per
    group at all, its percentiles NULL): the exact percentiles named ``names`` (default
    ``q0``, ``q1`` …). NULL keys form their own group. ``extra`` are more aggregates of the
    group, taken in the first pass."""
    names = names or [f"q{i}" for i in range(len(probs))]
    eps = 1.0 / accuracy
    m = len(probs)
    extra = extra or {}
    rows = df.withColumn("__x", F.col(value).cast("double"))
    if not keep_empty:
        rows = rows.where(F.col("__x").isNotNull())
    marks = [max(0.0, p - 4 * eps) for p in probs] + [min(1.0, p + 4 * eps) for p in probs]
    sketch = rows.groupBy(*by).agg(
        F.count("__x").alias("__n"),
        F.percentile_approx("__x", F.array(*[F.lit(q) for q in marks]), accuracy).alias("__b"),
        *[c.alias(name) for name, c in extra.items()],
    )
    rows = rows.select(*by, "__x").where(F.col("__x").isNotNull())
    bounds = sketch.select(
        *by, *extra, "__n",
        *[F.col("__b")[i].alias(f"__lo{i}") for i in range(m)],
        *[F.col("__b")[m + i].alias(f"__hi{i}") for i in range(m)],
        *[F.greatest(F.lit(1), F.ceil(F.col("__n") * F.lit(p))).cast("long").alias(f"__k{i}")
          for i, p in enumerate(probs)],
    )
    if not by:
        bounds = bounds.withColumn("__one", F.lit(1))
        rows = rows.withColumn("__one", F.lit(1))
        keys = ["__one"]
    else:
        keys = list(by)
    # One row per group: fetch it once (size-checked) and reuse the local copy in every
    # join below, so the sketch pass is not recomputed.
    fetched = fetch_small(bounds)
    if fetched is not None:
        bounds = df.sparkSession.createDataFrame(fetched, bounds.schema)
    tagged = join_small(rows, bounds.select(*keys, *[f"__lo{i}" for i in range(m)],
                                            *[f"__hi{i}" for i in range(m)]),
                        keys, "inner", null_safe=True)
    entries = F.array(*[
        F.when(
            F.col("__x") <= F.col(f"__hi{i}"),
            F.struct(
                F.lit(i).alias("i"),
                F.when(F.col("__x") < F.col(f"__lo{i}"), F.lit(-math.inf)).otherwise(F.col("__x")).alias("v"),
            ),
        )
        for i in range(m)
    ])
    hist = (
        tagged.select(*keys, F.explode(entries).alias("__e"))
        .where(F.col("__e").isNotNull())
        .groupBy(*keys, F.col("__e.i").alias("__i"), F.col("__e.v").alias("__v"))
        .agg(F.count(F.lit(1)).alias("__c"))
    )
    need = bounds.select(*keys, F.array(*[F.col(f"__k{i}") for i in range(m)]).alias("__ks"))
    hits = _kth_buckets(hist, need, keys)
    wide = hits.groupBy(*keys).agg(
        *[F.max(F.when(F.col("__i") == i, F.col("__q"))).alias(f"__e{i}") for i in range(m)]
    )
    missed = F.raise_error(F.lit("percentile bracket missed; use a higher accuracy")).cast("double")
    out = join_small(bounds.select(*keys, *extra, "__n"), wide, keys, "left", null_safe=True).select(
        *keys, *extra,
        *[F.when(F.col("__n") == 0, F.lit(None).cast("double")).when(F.col(f"__e{i}").isNull(), missed)
          .otherwise(F.col(f"__e{i}")).alias(names[i]) for i in range(m)],
    )
    return out.drop("__one") if not by else out


def _kth_buckets(hist: DataFrame, need: DataFrame, keys: list[str]) -> DataFrame:
    """Per group and percentile number ``__i`` the value ``__q`` of the first bucket inside of the
    bracket whose running count reaches the k-th row (``__ks`` of ``need``); a group without
    one has no row."""
    spark, each = hist.sparkSession, [*keys, "__i"]
    # The number of a range holds for one run of the shuffle only, so it is stored with its rows.
    slabs = (
        hist.repartitionByRange(*each, "__v")
        .withColumn("__slab", F.spark_partition_id())
    )
    path = scratch_dir(spark, "percentile-buckets")
    slabs.write.parquet(path)
    slabs = spark.read.schema(slabs.schema).parquet(path)
    totals = slabs.groupBy(*each, "__slab").agg(F.sum("__c").alias("__t"))
    totals = join_small(totals, need, keys, "inner", null_safe=True)
    earlier = Window.partitionBy(*each).orderBy("__slab").rowsBetween(Window.unboundedPreceding, -1)
    k = F.element_at("__ks", F.col("__i") + 1)
    found = (
        totals.withColumn("__before", F.coalesce(F.sum("__t").over(earlier), F.lit(0)))
        .where((F.col("__before") < k) & (F.col("__before") + F.col("__t") >= k))
        .select(*each, "__slab", k.alias("__k"), "__before")
    )
    running = Window.partitionBy(*each).orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    return (
        join_small(slabs, found, [*each, "__slab"], "inner", null_safe=True)
        .withColumn("__cum", F.col("__before") + F.sum("__c").over(running))
        .where(F.col("__cum") >= F.col("__k"))
        .groupBy(*each)
        .agg(F.min("__v").alias("__q"))
        .where(F.col("__q") > F.lit(-math.inf))
    )
