"""Sharding (operator 8): consistent-hash ring with virtual nodes and bounded loads.

The ring has ``cells`` equal arcs. Each shard owns ``vnodes`` of them, placed by hash, and a
row starts in the arc of its id's hash. It goes to the first shard clockwise that isn't
full; rows overflowing a full shard continue clockwise. Rows enter in ring order (arc, salt,
hash, id, text checksum, size), so the result depends on the rows alone, not on how they
are partitioned.

Equal rows (id, checksum, size) are counted first, so one that holds a third of all rows is
one entry. Only counts by arc and salt are gathered on the driver (``cells * salts`` numbers
at most, whatever the size of the input). They give each arc its segments: so many rows to
this shard, from this slot on. The entries find their ranks inside (arc, salt) with a running
sum, are cut into runs of at most ``RUN`` rows, dealt out, and unfolded to rows; a row's
segment is the one of its arc that holds its rank. The salt comes from the whole entry, so one
id with many texts is spread over ``salts`` tasks.

``law="rows"``: with no slack (the default) the capacities are n div shards, one more for the
first n mod shards of them, so counts are at most one apart; ``slack`` above 0 trades balance
for less movement when shards come or go. Null ids hash as a value of their own; null texts
count as empty; repeated rows are placed one by one; an empty table gives an empty result.
No Python runs on the executors.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickmart.llm.common import plain_text, stored

CELLS, VNODES, SALTS, RUN = 2048, 64, 32, 10_000


def _mix(x: int) -> int:
    """splitmix64 finaliser, for the places of virtual nodes."""
    x = (x + 0x9E3779B97F4A7C15) & (2**64 - 1)
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & (2**64 - 1)
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & (2**64 - 1)
    return x ^ (x >> 31)


def ring(shards: int, cells: int = CELLS, vnodes: int = VNODES) -> list[int]:
    """Owner of each arc, -1 where no virtual node lies. Where two nodes meet, the one with
    the smaller full hash has the arc, so a new shard takes arcs only into itself."""
    best: dict[int, tuple[int, int]] = {}
    for shard in range(shards):
        for v in range(vnodes):
            h = _mix(_mix(shard + 1) ^ (v * 0x632BE59BD9B4E019))
            best[h % cells] = min(best.get(h % cells, (2**64, 0)), (h, shard))
    return [best[c][1] if c in best else -1 for c in range(cells)]


def capacities(n: int, shards: int, slack: float = 0.0) -> list[int]:
    if slack <= 0:
        return [n // shards + (s < n % shards) for s in range(shards)]
    return [math.ceil((1 + slack) * n / shards)] * shards


def segments(counts: dict[int, int], shards: int, slack: float = 0.0,
             cells: int = CELLS, vnodes: int = VNODES) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, end rank, shard, slot of the first rank) for all arcs with rows."""
    owner = ring(shards, cells, vnodes)
    left = capacities(sum(counts.values()), shards, slack)
    used = [0] * shards
    # The next virtual node at or after each arc; full shards are left out as they fill up.
    at = [c for c in range(cells) if owner[c] >= 0]
    out = []
    place = 0
    for cell in sorted(counts):
        while place < len(at) and at[place] < cell:
            place += 1
        done, n, step = 0, counts[cell], place
        while done < n:
            shard = owner[at[step % len(at)]]
            take = min(n - done, left[shard])
            if take:
                out.append((cell, done, done + take, shard, used[shard]))
                left[shard] -= take
                used[shard] += take
                done += take
            step += 1
    return out


def shard_rows(
    docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
    slack: float = 0.0, cells: int = CELLS, vnodes: int = VNODES, salts: int = SALTS,
) -> DataFrame:
    """One row per document: id, ``size``, ``text_crc32``, ``shard``, ``slot``."""
    spark = docs.sparkSession
    key = ("h", "id", "text_crc32", "size")
    values = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(plain_text(text_col)).cast("long") + 1).alias("size"),
        F.crc32(plain_text(text_col).cast("binary")).alias("text_crc32"),
    ).withColumn("h", F.xxhash64("id"))
    values = values.groupBy(
        F.pmod("h", F.lit(cells)).cast("int").alias("cell"),
        F.pmod(F.xxhash64("id", "text_crc32", "size"), F.lit(salts)).cast("int").alias("salt"), *key,
    ).agg(F.count(F.lit(1)).alias("m"))
    values = stored(values, "llm-shards")
    found = values.groupBy("cell", "salt").agg(F.sum("m").alias("n")).collect()  # cells * salts rows at most
    counts: dict[int, int] = {}
    starts = []
    for r in sorted(found, key=lambda r: (r["cell"], r["salt"])):
        starts.append((r["cell"], r["salt"], counts.get(r["cell"], 0)))
        counts[r["cell"]] = counts.get(r["cell"], 0) + r["n"]
    parts = spark.createDataFrame(
        segments(counts, shards, slack, cells, vnodes), "cell int, lo long, hi long, shard int, first_slot long"
    )
    offsets = spark.createDataFrame(starts, "cell int, salt int, start long")
    before = Window.partitionBy("cell", "salt").orderBy(*key).rowsBetween(Window.unboundedPreceding, -1)
    ranked = values.withColumn("before", F.coalesce(F.sum("m").over(before), F.lit(0)))
    # the broadcast sides have cells * salts and about cells + shards rows at most
    runs = ranked.join(F.broadcast(offsets), ["cell", "salt"]).select(
        "cell", *key, "m", (F.col("start") + F.col("before")).alias("first"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1, F.lit(RUN).cast("long"))).alias("at"),
    )
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = runs.repartition(n, "h", "id", "text_crc32", "at")
    last = F.least(F.col("at") + RUN, F.col("m")) - 1
    rows = runs.select("cell", *key, F.explode(F.sequence(F.col("first") + F.col("at"), F.col("first") + last)).alias("rank"))
    placed = rows.alias("r").join(
        F.broadcast(parts).alias("p"),
        (F.col("r.cell") == F.col("p.cell")) & (F.col("r.rank") >= F.col("p.lo")) & (F.col("r.rank") < F.col("p.hi")),
    )
    return placed.select(
        F.col("r.id").alias(id_col), "r.size", "r.text_crc32", "p.shard",
        (F.col("p.first_slot") + F.col("r.rank") - F.col("p.lo")).alias("slot"),
    )
