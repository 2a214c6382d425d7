"""Periodic runs (operator 11): string synchronising sets over the words of a text.

A run is a stretch of words with smallest period q, at least ``max(least, exponent * q)``
words long, that no neighbouring word extends. Periods are found scale by scale; scale t
(4, 8, 16, ...) is for the periods in [t, 2t).

*Synchronising set.* Every stretch of t words has a hash, built from the two halves' hashes.
A place i belongs to the set of scale t if the smallest hash among the stretches at i to i + t
is that at i or that at i + t. Whether it does depends on the 2t words from i alone, so equal
contexts agree, and every t places in a row hold one, wherever the text isn't highly periodic.

*Pairs.* Two members with equal contexts, one right after the other, propose their distance as
a period, if it is in [t, 2t). In a run of period q at least one pair proposes q: the first t
places hold a member, the context after it recurs q words later (4q >= 3t + q words), and
not before, since a context of 2t > q words that recurs earlier would give a smaller period.
A proposal is extended both ways word by word, which finds its exact ends.

*Highly periodic regions.* Stretches of t words with a period of t / 4 or less are left out of
the minima, else every place of such a region would be a member. They lie in runs of smaller
periods, which smaller scales have found; the periods 1, 2 and 3 are found by comparing the
words with those 1, 2 and 3 places on.

Texts are handled in groups of about ``GROUP`` words, one after another in one array, parted
by numbers that occur once; a longer text is a group of its own. Scales stop where no text of
the group is long enough. A task holds one group; there is no shuffle, and a lost task just
runs again. Words are compared by exact numbers, hashes only propose.

Defined results: null and empty texts and texts without a word have no runs and an empty
collapsed text; runs may overlap; repeated rows are rows like any other; an empty table
gives an empty result; other columns are neither read nor in the way.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.llm.common import plain_text

LEAST, EXPONENT = 6, 4
GROUP = 1 << 18
SMALL = 3  # periods below the first scale
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)

RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64's finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def joined_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mixed(left * np.uint64(0x9E3779B97F4A7C15) + right)


def small_period(words: np.ndarray, q: int) -> list[tuple[int, int, int]]:
    """(start, length, q) of the maximal stretches of smallest period ``q`` (a prime, or 1) and
    ``EXPONENT * q`` words or more."""
    same = np.zeros(len(words) - q + 2, dtype=np.int8)
    same[1:-1] = words[:-q] == words[q:]
    turns = np.diff(same)
    start, end = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
    long = end - start >= (EXPONENT - 1) * q
    start, end = start[long], end[long]
    if q > 1:  # a stretch of one repeated word has period 1
        varied = np.zeros(len(start), dtype=bool)
        for k in range(1, q):
            varied |= words[start] != words[start + k]
        start, end = start[varied], end[varied]
    return [(s, e - s + q, q) for s, e in zip(start.tolist(), end.tolist(), strict=True)]


def matches_on(words: np.ndarray, at: int, q: int) -> int:
    """How many words from ``at`` on equal the word ``q`` places later."""
    n, size, done = len(words) - q - at, 4 * q, 0
    while done < n:
        size = min(size, n - done)
        a = at + done
        differ = np.flatnonzero(words[a:a + size] != words[a + q:a + q + size])
        if len(differ):
            return done + int(differ[0])
        done, size = done + size, 2 * size
    return done


def matches_back(words: np.ndarray, at: int, q: int) -> int:
    """How many words right before ``at`` equal the word ``q`` places later."""
    size, done = 4 * q, 0
    while done < at:
        size = min(size, at - done)
        a = at - done - size
        differ = np.flatnonzero(words[a:a + size] != words[a + q:a + q + size])
        if len(differ):
            return done + size - 1 - int(differ[-1])
        done, size = done + size, 2 * size
    return done


def synchronising(h: np.ndarray, t: int, periodic: np.ndarray) -> np.ndarray:
    """Members of the set of scale ``t``. ``h``: hash of the t words from each place;
    ``periodic``: places whose t words are highly periodic."""
    h = np.where(periodic[:len(h)], NEVER, h)
    low, span = h, 1
    while span < t:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    low = np.minimum(low[:-1], low[1:])  # t + 1 hashes in a row
    return np.flatnonzero((low != NEVER) & ((low == h[:len(low)]) | (low == h[t:])))


def periodic_stretches(words: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int, int]]:
    """All maximal (start, length, period) of ``EXPONENT`` periods or more. ``words``: the texts'
    word numbers, each text followed by a number that occurs once; ``lengths``: with that."""
    found = [s for q in range(1, SMALL + 1) if len(words) > q for s in small_period(words, q)]
    place, size = np.arange(len(words)), np.repeat(lengths, lengths)
    h = mixed(words.astype(np.uint64))
    t = 1
    while True:
        if len(h) <= t:
            return found
        h, t = joined_hash(h[:-t], h[t:]), 2 * t
        if t <= SMALL:
            continue
        # Only texts that can hold a run of this scale go on (a single end mark is no word).
        stay = size > EXPONENT * t
        if not stay.any():
            return found
        if 2 * np.count_nonzero(stay) < len(stay):
            h = np.append(h, np.zeros(t - 1, np.uint64))[stay]  # over the end: in no context
            place, size = place[stay], size[stay]
            h = h[:len(h) - t + 1]
        if len(h) <= 2 * t:
            return found
        level = np.zeros(len(words) + 1, dtype=np.int32)
        for s, n, q in found:
            if 4 * q <= t <= n:
                level[s] += 1
                level[s + n - t + 1] -= 1
        members = synchronising(h, t, (np.cumsum(level[:-1]) > 0)[place])
        members = members[members + t < len(h)]
        context = joined_hash(h[members], h[members + t])
        order = np.argsort(context, kind="stable")
        context, at = context[order], members[order]
        gap = at[1:] - at[:-1]
        near = (context[1:] == context[:-1]) & (gap >= t) & (gap < 2 * t)
        at, gap = place[at[:-1][near]], gap[near]
        order = np.lexsort((at, gap))
        done_q, done_end = 0, -1
        for i, q in zip(at[order].tolist(), gap[order].tolist(), strict=True):
            if q == done_q and i + q < done_end:
                continue
            back = matches_back(words, i, q)
            length = back + matches_on(words, i, q) + q
            done_q, done_end = q, i - back + length
            if length >= EXPONENT * q:
                found.append((i - back, length, q))


def runs_of(texts: list[list[bytes]], least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """For each text (its words) its runs (start, length, period) by start, then period."""
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    lengths = np.array([len(words) + 1 for words in texts], dtype=np.int64)
    ends = np.cumsum(lengths)
    flat = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.int64)
    for words, end in zip(texts, ends.tolist(), strict=True):
        flat[end - 1 - len(words):end - 1] = list(map(number.__getitem__, words))
    flat[ends - 1] = -1 - np.arange(len(texts))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    found = [s for s in periodic_stretches(flat, lengths) if s[1] >= least]
    owner = np.searchsorted(ends, [s for s, _, _ in found], "right").tolist()
    for (s, n, q), text in zip(found, owner, strict=True):
        out[text].append((s - int(ends[text] - lengths[text]), n, q))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    level = np.zeros(len(words) + 1, dtype=np.int32)
    for s, n, q in runs:
        level[s + q] += 1
        level[s + n] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(level[:-1]) == 0).tolist()])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``runs`` (array of start, length, period in words, by start,
    then period) and ``collapsed`` (the words outside of repeated periods, joined by a space)."""
    rows = docs.select(F.col(id_col).alias("id"), plain_text(text_col).cast("binary").alias("text"))
    run_type = pa.list_(pa.struct([(c, pa.int64()) for c in RUN.names]))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, first, size = [], 0, 0
            for i, text in enumerate(b.column("text")):
                texts.append(WORDS.findall(text.as_py()))
                size += len(texts[-1])
                if size < GROUP and i + 1 < b.num_rows:
                    continue
                runs = runs_of(texts)
                rest = [collapsed(w, r) for w, r in zip(texts, runs, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").slice(first, len(texts)),
                     pa.array([[dict(zip(RUN.names, r, strict=True)) for r in rs] for rs in runs], run_type),
                     pa.array(rest, pa.binary()).cast(pa.string())],
                    names=["id", "runs", "collapsed"],
                )
                texts, first, size = [], i + 1, 0

    schema = T.StructType([
        rows.schema["id"], T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType()),
    ])
    return rows.mapInArrow(of, schema).withColumnRenamed("id", id_col)
