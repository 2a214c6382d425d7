"""SimHash near-dedup (operator 6): bit-sliced comparison of 64-bit fingerprints.

1. Fingerprints of whole texts (word shingles, XXH64 with seed 42, majority of each bit).
2. Equal fingerprints collapse to one. The 64 bits are cut into ``blocks`` pieces; two
   fingerprints that differ in at most ``radius`` bits agree in ``blocks - radius`` pieces,
   so every choice of that many pieces is a table whose buckets hold all pairs to look at.
3. A bucket is compared by bit planes: plane k holds bit k of 64 fingerprints in one word.
   A carry-save counter adds the 64 difference planes for 64 distances at once, and a block
   is abandoned as soon as all its distances exceed the radius. Buckets above ``tile``
   fingerprints are cut into tiles by hash and every two tiles are compared in a task of
   their own, so a hot bucket is spread, and no pair is left out.
4. A task reports a spanning forest of the links it found, not the pairs; the components
   follow from those edges.

Defined results: null and empty texts have fingerprint zero and are linked like any other;
fewer words than a shingle make one shingle; documents with equal fingerprints are always
linked; a component's id is its smallest non-null id (null if it has none); repeated rows
and ids are rows like any other; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart.llm.common import LOCATOR, plain_text, spread_join, stored, with_locator
from clickmart.llm.components import components

SEED, BITS = 42, 64
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: str, shingle: int = 3) -> int:
    """64-bit SimHash of one text: ASCII lower case, words between ASCII white space."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    total = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, n, SHINGLES_AT_ONCE):
        part = words[start:start + SHINGLES_AT_ONCE + shingle - 1]
        if len(part) < shingle:
            grams = [b" ".join(part)]
        else:
            grams = map(b" ".join, zip(*(part[i:] for i in range(shingle)), strict=False))
        h = np.array([digest(g, SEED) for g in grams], dtype="<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, locator, fp): fp is the fingerprint as a signed 64-bit number."""
    rows = with_locator(docs).select(F.col(id_col).alias("id"), *LOCATOR, plain_text(text_col).alias("text"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column("text")], dtype=np.uint64)
            cols = [b.column(c) for c in ("id", *LOCATOR)] + [pa.array(fps.view(np.int64))]
            yield pa.RecordBatch.from_arrays(cols, names=["id", *LOCATOR, "fp"])

    out = rows.select("id", *LOCATOR, F.lit(0).cast("long").alias("fp")).schema
    return rows.mapInArrow(of, out)


def block_masks(blocks: int, radius: int) -> list[int]:
    """One mask of compared-for-equality bits per table."""
    cuts = [round(i * BITS / blocks) for i in range(blocks + 1)]
    pieces = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:], strict=False)]
    return [sum(c) for c in combinations(pieces, blocks - radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def near_links(fps: np.ndarray, starts: np.ndarray, radius: int, rows_at_once: int = 1 << 15) -> np.ndarray:
    """For each fingerprint, the index of the smallest member of its forest: members of one
    unit (``starts`` marks where units begin) are joined when they differ in <= radius bits.
    """
    n = len(fps)
    label = np.arange(n)
    ends = np.append(starts[1:], n)
    sizes = ends - starts
    unit = np.repeat(np.arange(len(starts)), sizes)
    pos = np.arange(n) - starts[unit]
    per_unit = -(-sizes // 64)  # words of 64 lanes
    first_word = np.concatenate([[0], np.cumsum(per_unit)])
    word = first_word[unit] + pos // 64
    lane = (pos % 64).astype(np.uint64)
    word_starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if n else np.zeros(0, dtype=np.int64)
    one = np.uint64(1)
    valid = np.bitwise_or.reduceat(one << lane, word_starts) if n else np.zeros(0, np.uint64)
    # Bits that all fingerprints of the batch share can't differ; their planes are skipped.
    varying = [k for k in range(BITS) if n and np.ptp((fps >> np.uint64(k)) & one)]
    planes = {k: np.bitwise_or.reduceat(((fps >> np.uint64(k)) & one) << lane, word_starts) for k in varying}

    # Each member against its own word and the later words of its unit.
    todo = per_unit[unit] - pos // 64
    ask_from = np.concatenate([[0], np.cumsum(todo)])
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(ask_from, ask_from[low] + rows_at_once, "right")) - 1)
        who = np.repeat(np.arange(low, high), todo[low:high])
        at = word[who] + (np.arange(ask_from[low], ask_from[high]) - ask_from[who])
        lanes = valid[at]
        own = at == word[who]
        later = ~((one << lane[who]) | ((one << lane[who]) - one))
        lanes = np.where(own, lanes & later, lanes)  # in its own word only the lanes after it
        counter = [np.zeros(len(who), np.uint64) for _ in range(int(radius).bit_length())]
        over = np.zeros(len(who), np.uint64)
        for step, k in enumerate(varying):
            bit = (fps[who] >> np.uint64(k)) & one
            carry = planes[k][at] ^ (np.uint64(0) - bit)
            for c in counter:  # carry-save: add one bit to 64 counters
                c_old = c.copy()
                c ^= carry
                carry = c_old & carry
            over |= carry
            if radius + 1 < 1 << len(counter):  # radius isn't one below a power of two
                over |= _above(counter, radius)
            if step % 8 == 7:
                alive = (~over & lanes) != 0
                if alive.mean() < 0.75:  # abandon the blocks in which all distances exceed the radius
                    who, at, lanes, over = who[alive], at[alive], lanes[alive], over[alive]
                    counter = [c[alive] for c in counter]
                    if not len(who):
                        break
        hit = ~over & lanes
        rows = np.flatnonzero(hit)
        if len(rows):
            bits = np.unpackbits(hit[rows].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            r, ln = np.nonzero(bits)
            a = who[rows[r]]
            b = starts[unit[a]] + (at[rows[r]] - first_word[unit[a]]) * 64 + ln
            _union(label, a, b)
        low = high
    return label


def _above(counter: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter holds more than ``radius``."""
    more, same = np.zeros_like(counter[0]), ~np.zeros_like(counter[0])
    for i in reversed(range(len(counter))):
        if radius >> i & 1:
            same &= counter[i]
        else:
            more |= same & counter[i]
            same &= ~counter[i]
    return more


def _union(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of a[i] and b[i] for all i, smallest index as the root, in place."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while not np.array_equal(up := label[label], label):
            label[:] = up


def _forest(batches: Iterator[pa.RecordBatch], radius: int, rows_at_once: int = 1 << 17) -> Iterator[pa.RecordBatch]:
    """Edges of each unit's forest. Rows come sorted by unit (u1, u2); a unit that crosses
    batches is carried over, so memory follows the largest unit, not the partition."""
    held: list[np.ndarray] = []

    def edges(rows: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.r_[True, np.any(rows[1:, :2] != rows[:-1, :2], axis=1)])
        fps = np.ascontiguousarray(rows[:, 2]).view(np.uint64)
        root = near_links(fps, starts, radius)
        child = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays(
            [pa.array(rows[child, 2]), pa.array(rows[root[child], 2])], names=["u", "v"]
        )

    for b in batches:
        if not b.num_rows:
            continue
        held.append(np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in ("u1", "u2", "fp")], axis=1))
        if sum(map(len, held)) >= rows_at_once:
            rows = np.concatenate(held)
            same = np.all(rows[:, :2] == rows[-1, :2], axis=1)
            cut = len(rows) - int(np.argmin(same[::-1])) if not same.all() else 0
            held = [rows[cut:]]
            if cut:
                yield edges(rows[:cut])
    if held and sum(map(len, held)):
        yield edges(np.concatenate(held))


def link_edges(fps: DataFrame, radius: int = 3, blocks: int = 5, tile: int = 1024) -> DataFrame:
    """Edges (u, v) whose components are those of all links within ``radius`` bits between
    the distinct fingerprints of ``fps`` (column fp)."""
    if not 0 < radius < blocks:
        raise ValueError("need 0 < radius < blocks")
    masks = [_signed(m) for m in block_masks(blocks, radius)]
    keyed = fps.select("fp").distinct().select(
        "fp", F.explode(F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(masks)])).alias("key")
    )
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    tiles = F.ceil(F.col("n") / F.lit(tile)).cast("int")
    own = F.pmod(F.xxhash64(F.lit("tile"), "fp"), tiles.cast("long")).cast("int")
    members = keyed.join(sizes, "key").select("key", "fp", tiles.alias("tiles"), own.alias("own"))
    other = F.explode(F.expr("sequence(0, tiles - 1)")).alias("other")
    units = members.select("key", "fp", "tiles", "own", other).where("tiles = 1 or own != other")
    units = units.select(
        F.col("key").alias("u1"),
        (F.least("own", "other").cast("long") * F.lit(1 << 31) + F.greatest("own", "other")).alias("u2"), "fp",
    )
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = units.repartition(n, "u1", "u2").sortWithinPartitions("u1", "u2")
    return units.mapInArrow(lambda it: _forest(it, radius), "u long, v long")


def simhash_dedup(
    docs: DataFrame, shingle: int = 3, radius: int = 3, blocks: int = 5, tile: int = 1024,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: id, locator, ``fp``, ``component_id`` and ``kept`` (true for the
    one row of each component that stays: smallest id, then smallest locator)."""
    base = with_locator(docs)
    fps = stored(fingerprints(base, shingle, id_col, text_col), "llm-simhash-fps")
    roots = components(link_edges(fps, radius, blocks, tile))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", *LOCATOR))
    distinct = fps.groupBy("fp").agg(first.alias("first"))
    distinct = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    heads = distinct.groupBy("root").agg(F.min("first").alias("head"))
    named = distinct.join(heads, "root").select("fp", "head")
    place = F.struct(*LOCATOR)
    return spread_join(fps, named, ["fp"]).select(
        F.col("id").alias(id_col), *LOCATOR, "fp", F.col("head.id").alias("component_id"),
        place.eqNullSafe(F.struct(*[F.col(f"head.{c}").alias(c) for c in LOCATOR])).alias("kept"),
    )


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` with one document of each near-duplicate group; columns as they came."""
    base = with_locator(docs)
    dropped = simhash_dedup(base, shingle, radius).where("not kept").select(*LOCATOR)
    return base.join(dropped, list(LOCATOR), "left_anti").drop(*LOCATOR)


def hex16(fp: str = "fp"):
    return F.lpad(F.lower(F.hex(fp)), BITS // 4, "0")


__all__ = ["fingerprint", "fingerprints", "link_edges", "simhash_dedup", "keep_one", "hex16"]
