"""Quality classifier (operator 1): a byte-level convolutional network in numpy.

A text is its UTF-8 bytes, cut into chunks of ``chunk`` bytes that overlap by the width of a
filter, so every place of the whole document is seen; the last chunk reaches back to its full
length, so an ending of a few bytes doesn't count as much as a whole chunk. Learned filters over six bytes in a
row (byte embeddings, three pairs) start at every byte; their activations are max-pooled over
each chunk, and the pooled vectors of a document are averaged and combined by a logistic layer
into one probability. For scoring, embeddings and filters are multiplied out to one table per
pair of bytes, so a chunk costs three look-ups and two additions for each byte: once for the
pairs that begin at even places, once for those at odd places.

Learning takes at most ``most_rows`` labelled rows of the learnable folds (those with the
smallest hash of their id and label, a sample that doesn't depend on partitioning). Longer
texts than ``most_bytes`` bytes give a training step chunks of that many bytes together, one
at a hashed place in each of as many equal parts of the whole text; both are parameters, and
bound the fit whatever the size of the corpus. Scores cover whole texts.
Training runs Adam for a fixed number of steps with a fixed seed.

Defined results: null and empty texts are one empty chunk and get that chunk's score; with
no labelled row the network is untrained and scores the prior, 0.5; rows with a null id can't
match a label; repeated labels, and labelled rows with a repeated id, count once (the smallest
text, or sample of a text); repeated rows get equal scores; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.llm.common import crc_mod, plain_text

PAIRS = 3  # a filter spans three pairs of bytes
CHUNK, DIM, FILTERS = 512, 8, 16
MOST_ROWS, MOST_BYTES = 4000, 16_384
THRESHOLD = 0.3


def to_pairs(raw: bytes) -> np.ndarray:
    """The bytes as little-endian pairs, those that begin at even places and, as second row,
    those at odd places; padded with zeros to at least one filter in both."""
    size = max(2 * PAIRS + 1, len(raw) + (len(raw) + 1) % 2)
    padded = raw.ljust(size, b"\0")
    return np.stack([np.frombuffer(padded[p:p + size - 1], dtype="<u2") for p in (0, 1)])


@dataclass
class Net:
    emb: np.ndarray  # (256, DIM)
    filt: np.ndarray  # (2 * PAIRS, DIM, FILTERS)
    bias: np.ndarray  # (FILTERS,)
    out: np.ndarray  # (FILTERS,)
    out_bias: np.ndarray  # (1,)

    @classmethod
    def fresh(cls, seed: int = 7, dim: int = DIM, filters: int = FILTERS) -> Net:
        r = np.random.default_rng(seed)
        return cls(
            r.normal(0, 0.5, (256, dim)).astype(np.float32),
            r.normal(0, 0.5, (2 * PAIRS, dim, filters)).astype(np.float32),
            np.zeros(filters, np.float32), np.zeros(filters, np.float32), np.zeros(1, np.float32),
        )

    def params(self) -> list[np.ndarray]:
        return [self.emb, self.filt, self.bias, self.out, self.out_bias]

    def tables(self) -> list[np.ndarray]:
        """Filter responses by pair of bytes: (65536, FILTERS) for each of the three pairs."""
        pair = np.arange(65536)
        byte = [self.emb @ self.filt[j] for j in range(2 * PAIRS)]
        out = [byte[2 * p][pair & 255] + byte[2 * p + 1][pair >> 8] for p in range(PAIRS)]
        out[0] = out[0] + self.bias
        return [np.ascontiguousarray(t, dtype=np.float32) for t in out]


def pooled(tables: list[np.ndarray], pairs: np.ndarray, step: int) -> np.ndarray:
    """(chunks, FILTERS): rectified maxima of each chunk's activations, over both rows."""
    n = pairs.shape[1] - PAIRS + 1
    out = []
    for start in range(0, n, step):
        start = min(start, max(0, n - step))
        k = min(step, n - start)
        a = tables[0].take(pairs[:, start:start + k], axis=0)
        for p in range(1, PAIRS):
            a += tables[p].take(pairs[:, start + p:start + p + k], axis=0)
        out.append(a.max(axis=(0, 1)))
    return np.maximum(np.stack(out), 0)


def score_text(net: Net, tables: list[np.ndarray], text: str, chunk: int = CHUNK) -> float:
    v = pooled(tables, to_pairs(text.encode("utf-8")), chunk // 2).mean(axis=0)
    return float(1.0 / (1.0 + np.exp(-np.clip(v @ net.out + net.out_bias[0], -30, 30))))


def train(
    texts: list[bytes], labels: np.ndarray, steps: int = 800, batch: int = 48, per_text: int = 4,
    rate: float = 0.02, chunk: int = CHUNK, seed: int = 7,
) -> Net:
    """Adam on the log loss. A step draws ``batch`` texts, half of each label, and ``per_text``
    chunks of each, so scores are probabilities for evenly mixed labels."""
    net = Net.fresh(seed)
    if not len(texts):
        return net
    r = np.random.default_rng(seed)
    by_label = [np.flatnonzero(labels == y) for y in (0, 1)]
    if not all(map(len, by_label)):
        share = (labels.sum() + 1) / (len(labels) + 2)
        net.out_bias[:] = np.log(share / (1 - share))
        return net
    pairs = [to_pairs(t) for t in texts]
    step = chunk // 2
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.params()]
    for it in range(1, steps + 1):
        who = np.concatenate([r.choice(x, batch // 2) for x in by_label])
        y = labels[who].astype(np.float32)
        # Windows of each drawn chunk; short texts give shorter chunks, padded with -1.
        grid = np.full((batch * per_text, 2 * step), -1, dtype=np.int64)
        flat, at = [], 0
        for i, w in enumerate(who):
            width = pairs[w].shape[1]
            n = width - PAIRS + 1
            flat.append(pairs[w].ravel())
            for j in range(per_text):
                start = min(int(r.integers(0, -(-n // step))) * step, max(0, n - step))
                k = min(step, n - start)
                grid[i * per_text + j, :k] = at + start + np.arange(k)
                grid[i * per_text + j, step:step + k] = at + width + start + np.arange(k)
            at += 2 * width
        stream = np.concatenate(flat)
        tables = net.tables()
        real = grid >= 0
        spots = np.where(real, grid, 0)
        a = tables[0].take(stream[spots], axis=0)
        for p in range(1, PAIRS):
            a += tables[p].take(stream[spots + p], axis=0)
        a[~real] = -np.inf
        best = a.argmax(axis=1)  # (chunks, FILTERS)
        top = np.take_along_axis(a, best[:, None, :], axis=1)[:, 0, :]
        act = np.maximum(top, 0)
        v = act.reshape(batch, per_text, -1).mean(axis=1)
        z = v @ net.out + net.out_bias[0]
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / batch
        d_out, d_out_bias = v.T @ g, np.array([g.sum()], np.float32)
        d_act = np.repeat(g[:, None] * net.out / per_text, per_text, axis=0) * (top > 0)
        place = np.take_along_axis(spots, best, axis=1)  # stream index of each winner's window
        d_emb, d_filt = np.zeros_like(net.emb), np.zeros_like(net.filt)
        column = np.broadcast_to(np.arange(net.filt.shape[2]), place.shape).ravel()
        d = d_act.ravel().astype(np.float32)
        for j in range(2 * PAIRS):
            byte = (stream[place + j // 2] >> (8 * (j % 2)) & 255).ravel()
            hits = np.zeros((256, net.filt.shape[2]), np.float32)  # gradient by byte and filter
            np.add.at(hits, (byte, column), d)
            d_emb += hits @ net.filt[j].T
            d_filt[j] = net.emb.T @ hits
        grads = [d_emb, d_filt, d_act.sum(axis=0), d_out, d_out_bias]
        slow = min(1.0, 2 * (1 - it / (steps + 1)))  # the second half slows down to a stop
        for p, gr, (m, s) in zip(net.params(), grads, moments, strict=True):
            m += 0.1 * (gr - m)
            s += 0.01 * (gr * gr - s)
            p -= slow * rate * (m / (1 - 0.9 ** it)) / (np.sqrt(s / (1 - 0.99 ** it)) + 1e-8)
    return net


def spread(raw: Column, most_bytes: int, seed: Column, chunk: int = CHUNK) -> Column:
    """``raw``, or chunks of it of at most ``most_bytes`` bytes together: one at a place hashed
    from ``seed`` in each of as many equal parts of the whole."""
    size = min(chunk, most_bytes)
    parts = most_bytes // size
    total = F.ceil(F.octet_length(raw) / F.lit(size))

    def piece(j: Column) -> Column:
        shift = F.pmod(F.xxhash64(seed, j), F.lit(1 << 20)) / F.lit(1 << 20)
        return F.substring(raw, (F.floor((j + shift) * total / F.lit(parts)) * size + 1).cast("int"), F.lit(size))

    pieces = F.aggregate(F.sequence(F.lit(0), F.lit(parts - 1)), F.lit(b""), lambda out, j: F.concat(out, piece(j)))
    return F.when(F.octet_length(raw) <= most_bytes, raw).otherwise(pieces)


def training_rows(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, folds: int, held_fold: int,
    most_rows: int, most_bytes: int,
) -> tuple[list[bytes], np.ndarray]:
    known = labels.select(F.col(id_col).alias("id"), F.col("quality").cast("int").alias("y"))
    known = known.where(F.col("y").isin(0, 1) & (crc_mod("id", folds) != held_fold))
    known = known.distinct().orderBy(F.xxhash64("id", "y"), "id", "y").limit(most_rows)
    rows = docs.select(F.col(id_col).alias("id"), plain_text(text_col).alias("text"))
    rows = rows.join(F.broadcast(known), "id").select(
        "id", "y", spread(F.col("text").cast("binary"), most_bytes, F.col("id")).alias("raw"))
    # one row for each label, also where an id is repeated: at most most_rows * most_bytes
    found = rows.groupBy("id", "y").agg(F.min("raw").alias("raw"))
    found = found.toArrow().sort_by([("id", "ascending"), ("y", "ascending")])
    return [bytes(x) for x in found.column("raw").to_pylist()], np.array(found.column("y").to_pylist(), dtype=np.int64)


def classify(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    folds: int = 5, held_fold: int = 0, threshold: float = THRESHOLD,
    most_rows: int = MOST_ROWS, most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """``docs`` plus ``held_out``, ``score`` and ``predicted``."""
    net = train(*training_rows(docs, labels, id_col, text_col, folds, held_fold, most_rows, most_bytes))
    return scored(docs, net, id_col, text_col, folds, held_fold, threshold)


def scored(
    docs: DataFrame, net: Net, id_col: str = "doc_id", text_col: str = "text",
    folds: int = 5, held_fold: int = 0, threshold: float = THRESHOLD,
) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(net)  # fixed size
    base = docs.drop("held_out", "score", "predicted")
    rows = base.select("*", plain_text(text_col).alias("__plain"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        tables = net.tables()
        for b in batches:
            score = [score_text(net, tables, t.as_py()) for t in b.column("__plain")]
            keep = [c for c in b.schema.names if c != "__plain"]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in keep), pa.array(score, pa.float64())], names=[*keep, "score"])

    schema = T.StructType([*base.schema.fields, T.StructField("score", T.DoubleType())])
    out = rows.mapInArrow(of, schema)
    return out.select(
        *[F.col(c) for c in base.columns], (crc_mod(id_col, folds) == held_fold).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that the classifier rejects; columns as they came."""
    return classify(docs, labels).where("predicted = 1").select(*docs.columns)
