"""Packing (operator 10): Karmarkar-Karp multiway differencing.

Documents become token ids plus an end id, are cut into pieces, and the pieces are packed
into sequences of at most ``window`` tokens. A document's whole windows stand alone; its rest
is cut into pieces of at most ``piece`` tokens, so that a group of pieces can be balanced
finely. A task takes its pieces in groups of ``group`` and splits each group into the least
number of windows that could hold it by multiway differencing: partial partitions with the
largest spreads are merged, the fullest part of one with the emptiest of the other. If the
fullest window exceeds the capacity, the number of windows rises by one and the group is
split again.

Pieces are hash-partitioned by id, start and their other columns (ids may be null or repeated) and sorted in their partition, so a task that
runs again gives the same sequences; ids of sequences are partition number and a running
number. Nothing is gathered beyond one group of a task.

Defined results: null counts as empty (one end id); equal documents are packed one by one;
very long texts are cut like any other; an empty table gives an empty result. Ids are those
of the tokenizers library (see ``words``).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.llm.common import ceil_div, plain_text, tokenizer_path
from clickmart.llm.words import encoder_of

END_ID = 1
WINDOW, PIECE, GROUP = 2048, 512, 1024


def cuts(n: int, window: int = WINDOW, piece: int = PIECE) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole windows, then the rest in equal parts
    of at most ``piece`` tokens."""
    out = [(s, window) for s in range(0, n - n % window, window)]
    rest, at = n % window, n - n % window
    parts = ceil_div(rest, piece)
    for i in range(parts):
        length = rest // parts + (i < rest % parts)
        out.append((at, length))
        at += length
    return out


def tokenize(
    docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, piece: int = PIECE,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pieces: id, ``start``, ``length``, ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``."""
    rows = docs.select(F.col(id_col).alias("id"), plain_text(text_col).alias("text"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer or tokenizer_path())
        end = np.array([END_ID], dtype="<u4").tobytes()
        for b in batches:
            who, start, length, ids, total = [], [], [], [], []
            for i, text in enumerate(b.column("text")):
                raw = encoder.ids_bytes(text.as_py()) + end
                n = len(raw) // 4
                for s, k in cuts(n, window, piece):
                    who.append(i)
                    start.append(s)
                    length.append(k)
                    ids.append(raw[4 * s:4 * (s + k)])
                    total.append(n)
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array(who, pa.int64())), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(ids, pa.binary()), pa.array(total, pa.int64())],
                names=["id", "start", "length", "ids", "doc_tokens"],
            )

    schema = T.StructType([
        T.StructField("id", rows.schema["id"].dataType), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()),
    ])
    return rows.mapInArrow(of, schema).withColumnRenamed("id", id_col)


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Split item numbers into ``k`` parts of near-equal sums by multiway differencing."""
    if k == 1:
        return [list(range(len(sizes)))]
    # A partial partition: the sums of its parts that aren't empty, largest first, and their
    # members as nested pairs; the other parts are zero.
    heap = [(-s, i, [s], [i]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        _, _, sa, ma = heapq.heappop(heap)
        _, _, sb, mb = heapq.heappop(heap)
        if len(sa) < len(sb):
            sa, ma, sb, mb = sb, mb, sa, ma
        clear = k - len(sa)  # empty parts of the longer one meet the largest of the other
        sums, members = list(sa), list(ma)
        sums += sb[:clear]
        members += mb[:clear]
        for j, (s, m) in enumerate(zip(sb[clear:], mb[clear:], strict=True)):
            at = len(sa) - 1 - j  # the smallest parts meet the next largest
            sums[at] += s
            members[at] = (members[at], m)
        order = sorted(range(len(sums)), key=sums.__getitem__, reverse=True)
        sums, members = [sums[i] for i in order], [members[i] for i in order]
        low = sums[-1] if len(sums) == k else 0
        if low:  # only differences count from now on; an empty difference is still a part
            spread = sums[0] - low
        else:
            spread = sums[0]
        heapq.heappush(heap, (-spread, serial, sums, members))
        serial += 1
    return [_flat(m) for m in heap[0][3]] if heap else []


def _flat(tree) -> list[int]:
    out, stack = [], [tree]
    while stack:
        x = stack.pop()
        if isinstance(x, tuple):
            stack.extend(x)
        else:
            out.append(x)
    return out


def windows(sizes: list[int], capacity: int = WINDOW) -> list[list[int]]:
    """The fewest windows that differencing can fill without exceeding ``capacity``."""
    k = max(1, ceil_div(sum(sizes), capacity))
    while True:
        parts = differencing(sizes, k)
        if max((sum(sizes[i] for i in p) for p in parts), default=0) <= capacity:
            return parts
        k += 1


def pack(pieces: DataFrame, window: int = WINDOW, group: int = GROUP, id_col: str = "doc_id") -> DataFrame:
    """``pieces`` (id, start, length and any other columns) plus ``sequence_id`` and ``offset``."""
    n = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    others = [c for c in pieces.columns if c not in (id_col, "start", "sequence_id", "offset")]
    # the other columns too: many rows may share an id, or have none
    plain = [c for c in others if not isinstance(pieces.schema[c].dataType, T.MapType)]
    dealt = pieces.drop("sequence_id", "offset").repartition(n, F.xxhash64(id_col, "start", *plain))
    dealt = dealt.sortWithinPartitions(id_col, "start", *others)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        next_id = TaskContext.get().partitionId() << 40
        held: list[pa.RecordBatch] = []

        def packed(t: pa.Table) -> Iterator[pa.RecordBatch]:
            nonlocal next_id
            length = t.column("length").to_numpy()
            seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            whole = np.flatnonzero(length >= window)
            seq[whole] = next_id + np.arange(len(whole))
            next_id += len(whole)
            rest = np.flatnonzero(length < window)
            for part in windows(length[rest].tolist(), window) if len(rest) else []:
                rows = rest[np.sort(part)]
                seq[rows] = next_id
                off[rows] = np.cumsum(length[rows]) - length[rows]
                next_id += 1
            t = t.append_column("sequence_id", pa.array(seq)).append_column("offset", pa.array(off))
            yield from t.combine_chunks().to_batches()

        for b in batches:
            held.append(b)
            t = pa.Table.from_batches(held)
            while t.num_rows >= group:
                yield from packed(t.slice(0, group))
                t = t.slice(group)
            held = t.to_batches()
        if held and sum(b.num_rows for b in held):
            yield from packed(pa.Table.from_batches(held))

    schema = T.StructType([*dealt.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])
    return dealt.mapInArrow(of, schema)
