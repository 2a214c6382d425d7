"""Ranked lexical search (operator 13): presence-mask grouping.

Every item's terms are looked for in every document. Two passes:

*Index.* Documents are taken in blocks of at most ``BLOCK`` documents. A block's row holds its
ids and lengths and, for each term that some item uses, the list of documents with the number
of occurrences. The blocks are written to the shared folder; the corpus statistics (documents
with a term, all terms, document frequencies) are sums over them.

*Search.* For each block and item, the terms' presence bitmaps over the block's documents are
turned into one mask of matched terms for each document, and documents are grouped by mask.
A mask's score is at most the sum of its terms' best parts in the block, taken at the length
of the mask's shortest document. Masks are evaluated by descending maximum, each with all its documents,
until the next maximum is below the score of the k-th best document so far. So no document that
could be among the k best is left out. The blocks' best are merged by a window over k rows a
block and item, which Spark cuts down before the shuffle.

Items are read in groups of at most ``ITEMS`` items or ``ITEM_BYTES`` of text (a longer one is a
group of its own), each with its own two passes, so what the driver and the tasks hold of
the items is bounded whatever their number; documents and postings never reach the driver.

Defined results: null, empty and term-less documents match nothing and don't count; null or
term-less items have no rows; each row of ``items`` is ranked by itself, also if its id is null or
repeated; repeated documents are ranked one by one; ties go to the smaller id, null ids last;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.llm.common import plain_text, stored

TOP = 10
BLOCK, BLOCK_TERMS = 8192, 1 << 21
ITEMS, ITEM_BYTES = 1000, 1 << 22
TERMS = re.compile(rb"[0-9a-z\x80-\xff]+")  # of lower-cased UTF-8: all but ASCII's other signs
UNIT, SATURATION, LENGTH_PART, FLAT_PART = 1_000_000_000, 8, 90, 10


class Items(NamedTuple):
    """A group of items: the row of each in ``ids``, and its terms as numbers."""

    ids: list
    terms: list[np.ndarray]
    vocabulary: dict[bytes, int]


def terms_of(text: str) -> list[bytes]:
    return TERMS.findall(text.encode("utf-8").lower())  # bytes.lower() changes A-Z alone


def item_groups(items: DataFrame, id_col: str, text_col: str) -> Iterator[Items]:
    rows = items.select(F.col(id_col).alias("id"), plain_text(text_col).alias("text"))
    group, size = Items([], [], {}), 0
    for r in rows.toLocalIterator():
        if group.ids and (len(group.ids) >= ITEMS or size + len(r["text"]) > ITEM_BYTES):
            yield group
            group, size = Items([], [], {}), 0
        found = dict.fromkeys(terms_of(r["text"]))
        numbers = [group.vocabulary.setdefault(t, len(group.vocabulary)) for t in found]
        group.ids.append(r["id"])
        group.terms.append(np.array(numbers, dtype=np.int64))
        size += len(r["text"])
    if group.ids:
        yield group


INDEX = (
    "docs array<struct<id:{id}>>, lengths binary, terms binary, bounds binary, places binary, counts binary, "
    "n_docs bigint, n_terms bigint, frequencies array<struct<term:int,n:int>>"
)


def index_blocks(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """One row per block: documents with a term, and the postings of the vocabulary."""
    rows = docs.select(F.col(id_col).alias("id"), plain_text(text_col).cast("binary").alias("text"))

    def block_of(ids: pa.Array, lengths: list[int], numbers: list[np.ndarray]) -> pa.RecordBatch:
        n = np.array(lengths, dtype=np.int64)
        some = np.flatnonzero(n)
        at = np.repeat(np.cumsum(n > 0) - 1, [len(x) for x in numbers])
        flat = np.concatenate(numbers)
        keys, counts = np.unique(flat * len(n) + at, return_counts=True)
        of, places = keys // len(n), keys % len(n)
        terms, first = np.unique(of, return_index=True)
        bounds = np.append(first, len(of))
        parts = [x.astype("<u4").tobytes() for x in (n[some], terms, bounds, places, counts)]
        frequencies = [{"term": t, "n": c} for t, c in zip(terms.tolist(), np.diff(bounds).tolist(), strict=True)]
        held = pa.StructArray.from_arrays([ids.take(pa.array(some))], names=["id"])
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), held),
             *(pa.array([x], pa.binary()) for x in parts), pa.array([len(some)], pa.int64()),
             pa.array([int(n.sum())], pa.int64()),
             pa.array([frequencies], pa.list_(pa.struct([("term", pa.int32()), ("n", pa.int32())])))],
            names=["docs", "lengths", "terms", "bounds", "places", "counts", "n_docs", "n_terms", "frequencies"],
        )

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.get
        ids, lengths, numbers, size = [], [], [], 0
        for b in batches:
            first = 0
            for i, text in enumerate(b.column("text")):
                found = TERMS.findall(text.as_py().lower())
                known = np.fromiter(map(number, found, repeat(-1)), np.int64, len(found))
                lengths.append(len(found))
                numbers.append(known[known >= 0])
                size += len(numbers[-1])
                if len(lengths) == BLOCK or size >= BLOCK_TERMS:
                    ids.append(b.column("id").slice(first, i + 1 - first))
                    yield block_of(pa.concat_arrays(ids), lengths, numbers)
                    ids, lengths, numbers, size, first = [], [], [], 0, i + 1
            ids.append(b.column("id").slice(first))
        if lengths:
            yield block_of(pa.concat_arrays(ids), lengths, numbers)

    return rows.mapInArrow(of, INDEX.format(id=rows.schema["id"].dataType.simpleString()))


class Block:
    """Postings of one block, with their parts of a score."""

    def __init__(self, row: dict, ids: pa.Array, n_docs: int, n_terms: int):
        self.lengths, self.terms, self.bounds, self.places, counts = (
            np.frombuffer(row[c], dtype="<u4").astype(np.int64) for c in ("lengths", "terms", "bounds", "places", "counts")
        )
        # A document's m: 100 at the mean length.
        self.m = FLAT_PART + (LENGTH_PART * self.lengths * n_docs) // n_terms
        self.parts = part(counts, self.m[self.places])
        self.most = np.maximum.reduceat(counts, self.bounds[:-1]) if len(self.terms) else counts
        self.best = np.maximum.reduceat(self.parts, self.bounds[:-1]) if len(self.terms) else counts
        self.bits: dict[int, np.ndarray] = {}
        self.by_id = np.empty(len(ids), dtype=np.int64)  # place of each document in order of ids
        self.by_id[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))

    def bitmap(self, k: int) -> np.ndarray:
        """Presence of the block's k-th term, one bit for each document."""
        if k not in self.bits:
            held = np.zeros(len(self.lengths), dtype=np.uint8)
            held[self.places[self.bounds[k]:self.bounds[k + 1]]] = 1
            self.bits[k] = np.packbits(held)
        return self.bits[k]


def part(count, m):
    """A term's share of a score before its weight."""
    return (UNIT * count) // (1000 * count + SATURATION * m)


def masks_of(bitmaps: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group documents by matched terms. (order, starts, present): documents in the order of
    their groups, the groups' first places in it, the groups' matched terms (groups x terms).
    Documents without a match are in no group."""
    packed = np.packbits(np.unpackbits(bitmaps, axis=1, count=n), axis=0)
    wide = np.zeros((n, -(-len(packed) // 8) * 8), dtype=np.uint8)
    wide[:, :len(packed)] = packed.T
    words = wide.view("<u8")
    order = np.flatnonzero(words.any(axis=1))
    words = words[order]
    sort = np.argsort(words[:, 0], kind="stable") if words.shape[1] == 1 else np.lexsort(words.T)
    order, words = order[sort], words[sort]
    starts = np.flatnonzero(np.append(len(order) > 0, (words[1:] != words[:-1]).any(axis=1)))
    return order, starts, np.unpackbits(wide[order[starts]], axis=1, count=len(bitmaps))


def best_of(block: Block, terms: np.ndarray, weights: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The item's ``top`` best (documents, scores) of the block, scores above 0."""
    k = np.searchsorted(block.terms, terms)
    k = np.minimum(k, max(len(block.terms) - 1, 0))
    held = (block.terms[k] == terms) & (weights > 0) if len(block.terms) else np.zeros(len(terms), bool)
    k, weights = k[held], weights[held]
    if not len(k):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order, starts, present = masks_of(np.stack([block.bitmap(i) for i in k.tolist()]), len(block.lengths))
    sizes = np.diff(np.append(starts, len(order)))
    # A mask's terms score at most their best in the block, and at most what the highest
    # count gives in the mask's shortest document.
    shortest = np.minimum.reduceat(block.m[order], starts)
    caps = np.minimum(part(block.most[k][None, :], shortest[:, None]), block.best[k][None, :])
    most = (present * caps) @ weights
    rank = np.argsort(-most, kind="stable")
    most, ends = most[rank], np.cumsum(sizes[rank])
    docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    done, least = 0, 1
    while done < len(rank) and most[done] >= least:
        # The next masks that aren't safely out, with as many documents as were seen so far.
        seen = int(ends[done - 1]) if done else 0
        upto = int(np.searchsorted(ends, max(2 * seen, top))) + 1
        upto = min(upto, int(np.searchsorted(-most, -least, "right")))
        some = np.sort(np.concatenate([order[starts[g]:starts[g] + sizes[g]] for g in rank[done:upto].tolist()]))
        score = np.zeros(len(some), np.int64)
        for i, w in zip(k.tolist(), weights.tolist(), strict=True):
            a, b = block.bounds[i], block.bounds[i + 1]
            at = a + np.minimum(np.searchsorted(block.places[a:b], some), b - a - 1)
            score += np.where(block.places[at] == some, w * block.parts[at], 0)
        docs, scores = np.append(docs, some), np.append(scores, score)
        if len(scores) >= top:
            least = max(1, int(np.partition(scores, -top)[-top]))
        done = upto
    first = np.lexsort((block.by_id[docs], -scores))[:top]
    first = first[scores[first] > 0]
    return docs[first], scores[first]


def _ranked(docs: DataFrame, group: Items, top: int, id_col: str, text_col: str) -> DataFrame:
    """(item (its place in the group), doc, score, rank) for a group of items."""
    blocks = stored(index_blocks(docs, group.vocabulary, id_col, text_col), "llm-postings")
    whole = blocks.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms")).first()
    n_docs, n_terms = whole["docs"] or 0, whole["terms"] or 0
    df = np.zeros(len(group.vocabulary), dtype=np.int64)  # as long as the group's vocabulary
    for r in blocks.select(F.explode("frequencies").alias("f")).groupBy("f.term").agg(F.sum("f.n").alias("n")).collect():
        df[r["term"]] = r["n"]
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)
    terms = [np.sort(t) for t in group.terms]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                row = b.slice(r, 1)
                ids = row.column("docs").flatten().field("id")
                block = Block(row.drop_columns(["docs"]).to_pylist()[0], ids, n_docs, n_terms)
                item, place, score = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for i, t in enumerate(terms):
                    d, s = best_of(block, t, weight[t], top)
                    item.append(np.full(len(d), i, np.int64))
                    place.append(d)
                    score.append(s)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(item)), ids.take(pa.array(np.concatenate(place))),
                     pa.array(np.concatenate(score))], names=["item", "doc", "score"])

    id_type = blocks.schema["docs"].dataType.elementType["id"].dataType
    schema = T.StructType([
        T.StructField("item", T.LongType()), T.StructField("doc", id_type), T.StructField("score", T.LongType())])
    found = blocks.select("docs", "lengths", "terms", "bounds", "places", "counts").mapInArrow(search, schema)
    w = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def ranked_search(
    docs: DataFrame, items: DataFrame, top: int = TOP,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """Per row of ``items`` its ``top`` highest-scoring documents with a score above 0: item id,
    ``rank`` (from 1), document id, ``score``."""
    spark, found = docs.sparkSession, []
    item_type, doc_type = items.schema[item_col].dataType, docs.schema[id_col].dataType
    for group in item_groups(items, item_col, item_text_col):
        if group.vocabulary:
            key = T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", item_type)])
            names = spark.createDataFrame(list(enumerate(group.ids)), key)
            found.append(_ranked(docs, group, top, id_col, text_col).join(F.broadcast(names), "item"))
    if not found:
        empty = [T.StructField("item_id", item_type), T.StructField("rank", T.IntegerType()),
                 T.StructField("doc", doc_type), T.StructField("score", T.LongType())]
        found = [spark.createDataFrame([], T.StructType(empty))]
    return reduce(DataFrame.union, [
        f.select(F.col("item_id").alias(item_col), F.col("rank").cast("int").alias("rank"),
                 F.col("doc").alias(id_col), "score") for f in found])
