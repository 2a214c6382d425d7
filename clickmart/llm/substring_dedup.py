"""Substring dedup (operator 3): content-defined chunks by a gear rolling hash.

*Chunks.* The UTF-8 bytes of a text get a gear hash of the last 16 bytes at every place. A chunk
ends where the hash is the smallest of the ``reach`` places before and after (the first of equals), and
after ``longest`` bytes without such a place. Ends depend on the bytes nearby alone, so an
insertion moves none but those beside it; chunks have 50 bytes on average and, but for a
text's first and last, more than ``reach``.

*Digests.* Chunks of at least ``reach`` bytes are deduplicated by digest: its place with the smallest
(id, locator, start) is the first, and each later place is matched with that first place.

*Matches.* A digest only proposes. From each matched pair of places the two texts' bytes are
compared both ways until they differ, or a text ends; nothing else decides. A match of at
least ``least`` bytes goes from the later text, trimmed to whole characters; shorter ones
stay, also if several of them touch. So what is cut stands byte for byte, in one piece,
in an earlier text or place, and a passage of ``least`` bytes that stands in an earlier place is cut to
its very ends if one of its chunks has its first place there.

Steps: digests are counted (partial aggregate); those seen twice make a bitmap, sized from their
count, 32 MB at most (fuller beyond 10^8 of them: more chunks pass, none is lost). Chunks that
pass are stored with their places; first places are joined by digest, partners' bytes by
locator, both with hot keys dealt over tasks (``spread_join``). Of a partner's text only the
bytes that can face the later text are sent. A task compares one text at a time with its partners,
which come sorted behind it. Texts without a match are neither shuffled nor rewritten.

Defined results: null counts as empty; texts that hold no match come back unchanged; a text
that repeats another as a whole ends up empty if it has ``least`` bytes; a text that repeats itself
keeps the first occurrence; repeated rows are rows like any other, the first by locator stays; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.llm.common import FILE, LOCATOR, ROW, plain_text, spread_join, stored, with_locator

REACH, LONGEST, LEAST = 24, 512, 96
GRAM = 16  # bytes that a hash covers
WORD = 1 << 15  # bits of one bitmap row
BITS = (15, 28)  # fewest and most bits of a bitmap, as powers of two


def gear_table() -> np.ndarray:
    """One 16-bit number for each byte, by a fixed rule (splitmix64 of the byte)."""
    x = (np.arange(1, 257, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) & np.uint64(0xFFFF)).astype(np.uint16)


GEAR = gear_table()


def rolled(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte."""
    # h = (h << 1) + GEAR[byte] in 16 bits is the sum over the last 16 bytes of GEAR << age;
    # doubling the span four times gives it for all places at once.
    h = GEAR[data]
    for span in (1, 2, 4, 8):
        h = h + np.concatenate([np.zeros(min(span, len(h)), np.uint16), h[:-span] << np.uint16(span)])
    return h


def lowest(h: np.ndarray, width: int) -> np.ndarray:
    """Smallest of ``width`` hashes in a row, from each place."""
    low, span = h, 1
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    return np.minimum(low[:span - width], low[width - span:]) if span < width else low


def chunk_ends(raw: bytes, reach: int = REACH, longest: int = LONGEST) -> np.ndarray:
    """Ends of the chunks of ``raw``; the last is its length. None for empty texts."""
    n = len(raw)
    if not n:
        return np.zeros(0, dtype=np.int64)
    h = rolled(np.frombuffer(raw, dtype=np.uint8))
    edge = np.full(reach, 0xFFFF, np.uint16)
    low = lowest(np.concatenate([edge, h, edge]), reach)
    ends = np.flatnonzero((h < low[:n]) & (h <= low[reach + 1:])) + 1
    ends = np.append(ends[ends < n], n)
    gaps = np.diff(ends, prepend=0)
    if gaps.max() <= longest:
        return ends
    extra = [np.arange(e - g + longest, e, longest) for e, g in zip(ends, gaps, strict=True) if g > longest]
    return np.union1d(ends, np.concatenate(extra))


def chunks(raw: bytes, reach: int = REACH, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, digest) of the chunks that have ``reach`` bytes or more."""
    import xxhash

    ends = chunk_ends(raw, reach, longest)
    starts = np.append(np.zeros(min(1, len(ends)), np.int64), ends[:-1])
    long = ends - starts >= reach
    starts, ends = starts[long], ends[long]
    h = xxhash.xxh3_64_intdigest
    digest = [h(raw[s:e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
    return starts, ends, np.array(digest, dtype=np.uint64).view(np.int64)


def bitmap_of(keys: DataFrame, column: str, bits: tuple[int, int] = BITS) -> np.ndarray:
    """Bitmap over the low bits of all keys (64-bit hashes), of a size fit for their count."""
    n = keys.count()
    size = min(max((16 * n).bit_length(), bits[0]), bits[1])
    place = F.col(column).bitwiseAND(F.lit((1 << size) - 1))
    words = keys.groupBy(F.floor(place / F.lit(WORD)).alias("word")).agg(
        F.bitmap_construct_agg(place % F.lit(WORD)).alias("bits"))
    out = np.zeros((1 << size) // WORD * (WORD // 8), dtype=np.uint8)
    for r in words.toLocalIterator():  # 2**bits / 2**15 rows of 4 KB at most
        out[r["word"] * (WORD // 8):(r["word"] + 1) * (WORD // 8)] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out


def among(flags: np.ndarray, keys: np.ndarray) -> np.ndarray:
    p = keys & (8 * len(flags) - 1)
    return (flags[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool)


def _row_filter(spark, rows: DataFrame, bits: tuple[int, int]) -> Column:
    """Condition that holds for the rows named by locator in ``rows``, and for few others."""
    keys = rows.select(F.xxhash64(FILE, ROW).alias("k")).distinct()
    flags = spark.sparkContext.broadcast(bitmap_of(keys, "k", bits))

    @F.pandas_udf("boolean")
    def held(k):
        import pandas as pd

        return pd.Series(among(flags.value, k.to_numpy()))

    return held(F.xxhash64(FILE, ROW))


def places(rows: DataFrame, reach: int, longest: int, bits: tuple[int, int]) -> DataFrame:
    """Stored (id, locator, ``size`` of the text, ``start``, ``end``, ``digest``) of the chunks
    whose digest is held twice (and a few others)."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in _slices(b.column("text"), 500):
                found = [chunks(t.as_py(), reach, longest)[2] for t in part]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], names=["digest"])

    seen = rows.select("text").mapInArrow(digests, "digest long")
    twice = seen.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest")
    spark = rows.sparkSession
    flags = spark.sparkContext.broadcast(bitmap_of(stored(twice, "llm-digests"), "digest", bits))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            empty = np.zeros(0, np.int64)
            who, size, start, end, digest = [empty], [empty], [empty], [empty], [empty]
            for i, text in enumerate(b.column("text")):
                raw = text.as_py()
                found = chunks(raw, reach, longest)
                hit = among(flags.value, found[2])
                for out, x in zip((start, end, digest), found, strict=True):
                    out.append(x[hit])
                who.append(np.full(len(start[-1]), i))
                size.append(np.full(len(start[-1]), len(raw)))
            at = pa.array(np.concatenate(who))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c).take(at) for c in ("id", *LOCATOR)),
                 *(pa.array(np.concatenate(x)) for x in (size, start, end, digest))],
                names=["id", *LOCATOR, "size", "start", "end", "digest"])

    longs = [T.StructField(c, T.LongType()) for c in ("size", "start", "end", "digest")]
    schema = T.StructType([*rows.select("id", *LOCATOR).schema.fields, *longs])
    return stored(rows.mapInArrow(of, schema), "llm-chunks")


def _slices(column: pa.Array, step: int) -> Iterator[pa.Array]:
    for at in range(0, len(column), step):
        yield column.slice(at, step)


def partners(found: DataFrame) -> DataFrame:
    """Stored (locator, partner's locator ``p_file``, ``p_row``, ``seeds``, ``low``, ``high``): chunks
    (start, start at the partner) that a later text shares with first places in a partner,
    and the partner's bytes that can face the later text."""
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", *LOCATOR, "start")).alias("first")
    firsts = found.groupBy("digest").agg(first, F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first")
    pairs = spread_join(found, firsts, ["digest"]).where(
        ~F.struct(*LOCATOR, "start").eqNullSafe(F.struct(*[F.col(f"first.{c}").alias(c) for c in (*LOCATOR, "start")]))
    ).select(*LOCATOR, "size", F.col(f"first.{FILE}").alias("p_file"), F.col(f"first.{ROW}").alias("p_row"),
             "start", F.col("first.start").alias("at"))
    # at most one seed for each chunk of the later text
    grouped = pairs.groupBy(*LOCATOR, "size", "p_file", "p_row").agg(
        F.array_sort(F.collect_list(F.struct("start", "at"))).alias("seeds"),
        F.greatest(F.min(F.col("at") - F.col("start")), F.lit(0)).alias("low"),
        F.max(F.col("at") - F.col("start") + F.col("size")).alias("high"))
    return stored(grouped.drop("size"), "llm-partners")


def agreement(a: np.ndarray, b: np.ndarray, back: bool) -> int:
    """How many bytes agree from the start (from the end, if ``back``)."""
    n, done, size = min(len(a), len(b)), 0, 256
    while done < n:
        size = min(size, n - done)
        if back:
            x, y = a[len(a) - done - size:len(a) - done], b[len(b) - done - size:len(b) - done]
        else:
            x, y = a[done:done + size], b[done:done + size]
        differ = np.flatnonzero(x != y)
        if len(differ):
            return done + (size - 1 - int(differ[-1]) if back else int(differ[0]))
        done, size = done + size, 2 * size
    return n


def matches(text: np.ndarray, other: np.ndarray, low: int, seeds: list[tuple[int, int]], least: int) -> list[list[int]]:
    """[start, end) of the stretches of ``text`` around the seeds that equal ``other``, which
    begins at byte ``low`` of the partner."""
    out, reached = [], {}
    for start, at in seeds:
        if start < reached.get(at - start, 0):
            continue
        end = start + agreement(text[start:], other[at - low:], back=False)
        begin = start - agreement(text[:start], other[:at - low], back=True)
        reached[at - start] = max(end, start + 1)
        if end - begin >= least:
            out.append([begin, end])
    return out


def merged(spans: list[list[int]], raw: np.ndarray) -> list[dict[str, int]]:
    """Spans without overlaps, trimmed to whole characters."""
    out: list[list[int]] = []
    borders = np.append((raw & 0xC0) != 0x80, True)
    for start, end in sorted(spans):
        while not borders[start]:
            start += 1
        while not borders[end]:
            end -= 1
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        elif start < end:
            out.append([start, end])
    return [{"start": s, "end": e} for s, e in out]


def repeated_spans(
    docs: DataFrame, reach: int = REACH, longest: int = LONGEST, least: int = LEAST, bits: tuple[int, int] = BITS,
    id_col: str = "doc_id", text_col: str = "text",
) -> tuple[DataFrame, Column]:
    """(locator, ``spans``): byte ranges that repeat earlier text, for each row that has any;
    and a condition that holds for the rows that may have any."""
    spark = docs.sparkSession
    text = plain_text(text_col).cast("binary").alias("text")
    rows = with_locator(docs).select(F.col(id_col).alias("id"), *LOCATOR, text)
    pairs = partners(places(rows, reach, longest, bits))
    own = (F.col("p_file") == F.col(FILE)) & (F.col("p_row") == F.col(ROW))
    asked = _row_filter(spark, pairs.where(~own).select(F.col("p_file").alias(FILE), F.col("p_row").alias(ROW)), bits)
    partner = rows.where(asked).select(F.col(FILE).alias("p_file"), F.col(ROW).alias("p_row"), "text")
    faced = F.substring("text", F.col("low").cast("int") + 1, (F.col("high") - F.col("low")).cast("int"))
    others = spread_join(pairs.where(~own), partner, ["p_file", "p_row"]).select(
        *LOCATOR, F.lit(2).alias("kind"), faced.alias("text"), "low", "seeds")
    selves = pairs.where(own).select(
        *LOCATOR, F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("text"), F.lit(0).cast("long").alias("low"), "seeds")
    later = _row_filter(spark, pairs, bits)
    nothing = F.lit(None).cast(pairs.schema["seeds"].dataType)
    texts = rows.where(later).select(
        *LOCATOR, F.lit(0).alias("kind"), "text", F.lit(0).cast("long").alias("low"), nothing.alias("seeds"))
    work = texts.unionByName(selves).unionByName(others).repartition(*LOCATOR).sortWithinPartitions(*LOCATOR, "kind")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, raw, spans = None, np.zeros(0, np.uint8), []
        found: list[tuple[tuple, list]] = []

        def done() -> None:
            if spans:
                found.append((key, merged(spans, raw)))

        for b in batches:
            column = {c: b.column(c) for c in (*LOCATOR, "kind", "text", "low", "seeds")}
            for i in range(b.num_rows):
                at = (column[FILE][i].as_py(), column[ROW][i].as_py())
                kind, data = column["kind"][i].as_py(), column["text"][i].as_buffer()
                if kind == 0:  # the text itself comes before its partners
                    done()
                    key, raw, spans = at, np.frombuffer(data, np.uint8).copy() if data else np.zeros(0, np.uint8), []
                    continue
                assert at == key
                seeds = [(s["start"], s["at"]) for s in column["seeds"][i].as_py()]
                other = raw if kind == 1 else np.frombuffer(data, np.uint8)
                spans += matches(raw, other, column["low"][i].as_py(), seeds, least)
            if found:
                yield _found_batch(found)
                found = []
        done()
        if found:
            yield _found_batch(found)

    schema = T.StructType([*rows.select(*LOCATOR).schema.fields, T.StructField("spans", T.ArrayType(SPAN))])
    return work.mapInArrow(of, schema), later


SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def _found_batch(found: list[tuple[tuple, list]]) -> pa.RecordBatch:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k, _ in found], pa.int64()), pa.array([k[1] for k, _ in found], pa.int64()),
         pa.array([s for _, s in found], span)], names=[*LOCATOR, "spans"])


def substring_dedup(
    docs: DataFrame, reach: int = REACH, longest: int = LONGEST, least: int = LEAST, bits: tuple[int, int] = BITS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``docs`` with repeated stretches cut from the text, plus ``removed_spans`` (byte ranges of
    the text as it was; null if there are none)."""
    base = with_locator(docs)
    spans, may_change = repeated_spans(base, reach, longest, least, bits, id_col, text_col)
    spans = spans.withColumnRenamed("spans", "removed_spans")
    base = base.drop("removed_spans")
    # What stays: from the end of each removed range to the start of the next.
    raw, cut = plain_text(text_col).cast("binary"), F.col("removed_spans")

    def between(start, end):
        return F.decode(F.substring(raw, start.cast("int") + 1, (end - start).cast("int")), "UTF-8")

    head = between(F.lit(0), F.get(cut, F.lit(0))["start"])
    rest = F.transform(cut, lambda s, i: between(
        s["end"], F.coalesce(F.get(cut, i + 1)["start"], F.octet_length(raw).cast("long"))))
    left = F.concat(head, F.array_join(rest, ""))
    out = F.when(cut.isNull(), F.col(text_col)).otherwise(left).alias(text_col)
    kept = [out if c == text_col else F.col(c) for c in docs.columns if c != "removed_spans"]
    changed = base.where(may_change).join(spans, list(LOCATOR), "left").select(*kept, "removed_spans")
    same = base.where(~may_change).withColumn("removed_spans", F.lit(None).cast(T.ArrayType(SPAN)))
    return changed.unionByName(same.select(*changed.columns))


def cut_repeats(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with repeated passages removed from the text (and its length set anew where a
    length column is there); columns as they came."""
    spans = "__spans"  # an own column may be called removed_spans
    names = {c: f"__own_{i}" for i, c in enumerate(docs.columns) if c == "removed_spans"}
    out = substring_dedup(docs.withColumnsRenamed(names), text_col=text_col).withColumnRenamed("removed_spans", spans)
    out = out.withColumnsRenamed({v: k for k, v in names.items()})
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        out = out.withColumn(length_col, F.when(F.col(spans).isNull(), F.col(length_col)).otherwise(
            F.char_length(text_col).cast(kind)))
    return out.select(*docs.columns)
