"""Language ID (operator 4): interpolated Kneser-Ney character models, one per language.

A text is its letter runs in lower case; each run is read with three start marks and one end
mark, and a model predicts every letter and the end mark from up to three characters before.
Highest order: counts. Lower orders: number of different characters seen before
(continuation counts). Each order has its own absolute discount per language, from its counts
of one and two, and passes the freed mass on to the next lower order; the lowest is
interpolated with a uniform distribution.

Learning is a Spark job over all learnable rows: tasks count the character 4-grams of their
rows, Spark sums them and derives the lower orders. The model is kept as sorted hash arrays:
a gram is known by its whole XXH64 (seed 42; fewer bits by ``bits``, then grams that share a
slot share its numbers). The model has an entry for each distinct gram and each distinct
context of the corpus, so it grows with what there is to learn; that is what the driver
collects and broadcasts.

A text gets the language with the lowest cross-entropy per predicted character. ``score`` is
the softmax of the negative cross-entropies. Rejection is calibrated: ``accepted`` is false
where the cross-entropy lies above the 0.995 quantile of the learnable rows of the predicted
language that were recognised rightly.

Defined results: ``und`` with score 0 if the text is null or has no letter, or no language
was learned; ties go to the language that sorts first; null ids count as the empty text for
the fold; repeated rows count as often as they come; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.llm.common import crc_mod, plain_text, stored
from clickmart.session import clear_scratch, scratch_mark

ORDER, BITS = 4, 64
START, END = "\x02", "\x03"
RUNS = re.compile(r"[^\W\d_]+")
UNKNOWN_LETTERS = 64  # letters that no training text holds share this much of the alphabet
QUANTILE = 0.995


def letter_runs(text: str) -> list[str]:
    """Runs of letters. Python's word characters hold other numbers than digits (², Ⅷ) too: they part runs."""
    runs = RUNS.findall(text.lower())
    if all(map(str.isalpha, runs)):
        return runs
    return "".join(c if c.isalpha() else " " for c in " ".join(runs)).split()


def grams(run: str) -> list[str]:
    s = START * (ORDER - 1) + run + END
    return [s[i:i + ORDER] for i in range(len(run) + 1)]


def gram_counts(learnable: DataFrame, most: int = 200_000) -> DataFrame:
    """(lang, gram, n) over all texts of ``learnable`` (lang, text)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[str, Counter] = {}

        def flush() -> pa.RecordBatch:
            lang, gram, n = [], [], []
            for name, counter in runs.items():
                total: Counter = Counter()
                same: dict[int, list[str]] = {}  # runs by how often they came: most came once
                for run, k in counter.items():
                    same.setdefault(k, []).append(run)
                for k, once in same.items():
                    part = Counter(g for run in once for g in grams(run))
                    for g in part:
                        part[g] *= k
                    total.update(part)
                lang += [name] * len(total)
                gram += total.keys()
                n += total.values()
            runs.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), pa.array(gram, pa.string()), pa.array(n, pa.int64())],
                names=["lang", "gram", "n"])

        for b in batches:
            for lang, text in zip(b.column("lang"), b.column("text"), strict=True):
                runs.setdefault(lang.as_py(), Counter()).update(letter_runs(text.as_py()))
                if sum(map(len, runs.values())) > most:
                    yield flush()
        yield flush()

    return learnable.select("lang", "text").mapInArrow(of, "lang string, gram string, n long").groupBy(
        "lang", "gram").agg(F.sum("n").alias("n"))


def _slot(gram, bits: int):
    h = F.xxhash64(gram)
    return h if bits >= 64 else h.bitwiseAND(F.lit((1 << bits) - 1))


def _orders(counts: DataFrame) -> list[DataFrame]:
    """Highest order first: (lang, gram, n); below it continuation counts."""
    out = [counts]
    for _ in range(ORDER - 1):
        out.append(out[-1].groupBy("lang", F.expr("substring(gram, 2)").alias("gram")).agg(
            F.count(F.lit(1)).alias("n")))
    return out


@dataclass
class Model:
    """For each order (1 to ORDER) sorted hash arrays over all languages' grams and contexts."""

    langs: list[str]
    bits: int = BITS
    grams: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)  # slots; n by lang
    contexts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)  # slots; total, types
    discount: list[np.ndarray] = field(default_factory=list)
    letters: np.ndarray | None = None

    def slots(self, items: list[str]) -> np.ndarray:
        import xxhash

        mask = (1 << min(self.bits, 64)) - 1
        h = [xxhash.xxh64_intdigest(x.encode("utf-8"), 42) & mask for x in items]
        return np.array(h, dtype=np.uint64).view(np.int64)

    def log_prob(self, items: list[str]) -> np.ndarray:
        """log P(last character | the others) of each gram, one column per language."""
        p = np.broadcast_to(1.0 / self.letters, (len(items), len(self.langs)))
        for order in range(1, ORDER + 1):
            tails = [x[-order:] for x in items]
            n = _look(*self.grams[order - 1], self.slots(tails))
            heads = self.slots([x[:-1] for x in tails])
            keys, total, types = self.contexts[order - 1]
            total, types = _look(keys, total, heads), _look(keys, types, heads)
            d = self.discount[order - 1]
            seen = total > 0
            free = np.where(seen, d * types / np.where(seen, total, 1), 1.0)
            own = np.where(seen, np.maximum(n - d, 0) / np.where(seen, total, 1), 0.0)
            p = own + free * p
        return np.log(p)


def _look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Rows of ``values`` at ``wanted``, zero where ``keys`` hasn't got them."""
    if not len(keys):
        return np.zeros((len(wanted), values.shape[1]))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where((keys[at] == wanted)[:, None], values[at], 0.0)


def learn(learnable: DataFrame, bits: int = BITS) -> Model:
    """The model of the languages of ``learnable`` (lang, text; no nulls)."""
    spark = learnable.sparkSession
    mark = scratch_mark(spark)
    counts = stored(gram_counts(learnable), "llm-grams")
    orders = [stored(o, "llm-grams") if i else o for i, o in enumerate(_orders(counts))][::-1]
    tables, figures = [], []
    for order, df in enumerate(orders, 1):
        kind = F.lit(order).alias("grade")
        tables.append(df.groupBy(kind, F.lit("gram").alias("kind"), "lang", _slot(F.col("gram"), bits).alias("slot")).agg(
            F.sum("n").cast("double").alias("x"), F.lit(0.0).alias("y")))
        head = F.expr("substring(gram, 1, char_length(gram) - 1)")
        tables.append(df.groupBy(kind, F.lit("head").alias("kind"), "lang", _slot(head, bits).alias("slot")).agg(
            F.sum("n").cast("double").alias("x"), F.count(F.lit(1)).cast("double").alias("y")))
        figures.append(df.groupBy(kind, F.lit("once").alias("kind"), "lang", F.lit(0).cast("long").alias("slot")).agg(
            F.count_if(F.col("n") == 1).cast("double").alias("x"), F.count_if(F.col("n") == 2).cast("double").alias("y")))
    rows = tables[0]
    for t in [*tables[1:], *figures]:
        rows = rows.unionByName(t)
    # a row per language for each distinct gram and context of each order
    found = rows.toArrow().to_pandas()
    clear_scratch(spark, mark)
    langs = sorted(found["lang"].unique())
    model = Model(langs, bits)
    column = {name: i for i, name in enumerate(langs)}
    for order in range(1, ORDER + 1):
        of = found[found["grade"] == order]

        def table(kind: str, values: tuple[str, ...], of=of) -> list[np.ndarray]:
            part = of[of["kind"] == kind]
            keys, at = np.unique(part["slot"].to_numpy(np.int64), return_inverse=True)
            out = []
            for v in values:
                grid = np.zeros((len(keys), len(langs)))
                grid[at, part["lang"].map(column).to_numpy(np.int64)] = part[v].to_numpy()
                out.append(grid)
            return [keys, *out]

        model.grams.append(tuple(table("gram", ("x",))))
        model.contexts.append(tuple(table("head", ("x", "y"))))
        once = of[of["kind"] == "once"].set_index("lang").reindex(langs)[["x", "y"]].fillna(0).to_numpy(float)
        n1, n2 = once[:, 0], once[:, 1]
        model.discount.append(np.where(n1 > 0, n1 / np.maximum(n1 + 2 * n2, 1), 0.5))
    model.letters = model.contexts[0][2].sum(axis=0) + UNKNOWN_LETTERS
    return model


class Scorer:
    """Cross-entropies of texts. Keeps the log probabilities of the grams and the sums of the
    letter runs that it has seen; both tables are emptied at a fixed size."""

    def __init__(self, model: Model, most: int = 800_000):
        self.model, self.most = model, most
        self.runs = _Rows(len(model.langs) + 1)  # sum by language; predicted characters
        self.grams = _Rows(len(model.langs))

    def entropies(self, texts: list[str]) -> list[np.ndarray | None]:
        """Cross-entropy per language of each text; None without a letter."""
        found = [letter_runs(t) for t in texts]
        flat = [r for runs in found for r in runs]
        if not flat:
            return [None] * len(texts)
        new = {r for r in flat if r not in self.runs.place}
        if new:
            if len(self.runs.place) + len(new) > self.most:
                self.runs.clear()
                new = set(flat)
            self._add(list(new))
        at = np.fromiter(map(self.runs.place.__getitem__, flat), dtype=np.int64, count=len(flat))
        sizes = np.array([len(runs) for runs in found])
        some = np.flatnonzero(sizes)
        starts = np.concatenate([[0], np.cumsum(sizes[some])[:-1]])
        sums = np.add.reduceat(self.runs.rows[at], starts)
        out: list[np.ndarray | None] = [None] * len(texts)
        for i, row in zip(some.tolist(), sums, strict=True):
            out[i] = -row[:-1] / row[-1]
        return out

    def _add(self, runs: list[str], at_once: int = 50_000) -> None:
        for start in range(0, len(runs), at_once):
            part = runs[start:start + at_once]
            lists = [grams(r) for r in part]
            sizes = np.array([len(x) for x in lists])
            flat = [g for x in lists for g in x]
            new = list({g for g in flat if g not in self.grams.place})
            if len(self.grams.place) + len(new) > self.most:
                self.grams.clear()
                new = list(set(flat))
            if new:
                self.grams.add(new, self.model.log_prob(new))
            at = np.fromiter(map(self.grams.place.__getitem__, flat), dtype=np.int64, count=len(flat))
            sums = np.add.reduceat(self.grams.rows[at], np.concatenate([[0], np.cumsum(sizes)[:-1]]))
            self.runs.add(part, np.column_stack([sums, sizes]))


class _Rows:
    """Rows of numbers by name."""

    def __init__(self, width: int):
        self.width = width
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.rows = np.zeros((1 << 12, self.width))

    def add(self, names: list[str], values: np.ndarray) -> None:
        first = len(self.place)
        while first + len(names) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[first:first + len(names)] = values
        self.place.update(zip(names, range(first, first + len(names)), strict=True))


_SCORERS: dict[str, Scorer] = {}


def _scorer(key: str, model: Model) -> Scorer:
    """One scorer for all tasks of a worker process that use the same model."""
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = Scorer(model)
    return _SCORERS[key]


def _scored(scorer: Scorer, texts: pa.Array, most: int = 4_000_000) -> Iterator[np.ndarray | None]:
    """Cross-entropies of each text, in groups of about ``most`` characters."""
    group, size = [], 0
    for t in texts:
        group.append(t.as_py())
        size += len(group[-1])
        if size >= most:
            yield from scorer.entropies(group)
            group, size = [], 0
    yield from scorer.entropies(group)


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    folds: int = 3, held_fold: int = 1, bits: int = BITS,
) -> DataFrame:
    """One row per document: id, ``held_out``, ``lang_pred``, ``score``, ``cross_entropy``,
    ``accepted``. Learned from the rows whose fold isn't ``held_fold``."""
    spark = docs.sparkSession
    held = crc_mod(id_col, folds) == held_fold
    rows = docs.select(
        F.col(id_col).alias("id"), held.alias("held_out"), plain_text(text_col).alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    )
    model = learn(rows.where("not held_out and lang is not null"), bits)
    shared = spark.sparkContext.broadcast(model)
    key = uuid.uuid4().hex

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = shared.value.langs
        scorer = _scorer(key, shared.value)
        for b in batches:
            pred, score, entropy = [], [], []
            for h in _scored(scorer, b.column("text")):
                if h is None or not langs:
                    pred.append("und")
                    score.append(0.0)
                    entropy.append(None)
                    continue
                best = int(np.argmin(h))
                pred.append(langs[best])
                score.append(float(1.0 / np.exp(h[best] - h).sum()))
                entropy.append(float(h[best]))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("held_out"), b.column("lang"), pa.array(pred, pa.string()),
                 pa.array(score, pa.float64()), pa.array(entropy, pa.float64())],
                names=["id", "held_out", "lang", "lang_pred", "score", "cross_entropy"])

    schema = T.StructType([
        *rows.select("id", "held_out", "lang").schema.fields, T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()), T.StructField("cross_entropy", T.DoubleType()),
    ])
    scored = stored(rows.mapInArrow(of, schema), "llm-languages")
    limits = scored.where("not held_out and lang = lang_pred").groupBy("lang_pred").agg(
        F.percentile_approx("cross_entropy", QUANTILE).alias("limit"))
    named = scored.join(F.broadcast(limits), "lang_pred", "left")  # one row per language
    return named.select(
        F.col("id").alias(id_col), "held_out", "lang_pred", "score", "cross_entropy",
        F.coalesce(F.col("cross_entropy") <= F.col("limit"), F.lit(False)).alias("accepted"),
    )
