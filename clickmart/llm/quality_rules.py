"""Quality rules (operator 5): learned decision lists over document statistics.

Statistics of each whole text come from array and string functions. A decision list is then
learned from the labelled documents by sequential covering: a rule for bad documents grows
one threshold condition at a time (largest information gain on the grow part of the labels),
loses its last conditions again where that helps on the prune part, and the documents it
covers are taken away before the next rule. Each step is one Spark aggregate: counts by
feature, quantile bin, label and part, at most ``features * (bins + 1) * 4`` rows. The rules
are emitted in order as one conditional expression; a document that no rule covers is kept.

The labelled rows of all documents are used (grow part: crc32 of the id mod 3 is not 0).

Defined results: null counts as empty (all statistics 0, base_failed); without labels, or
with one label only, the list is empty and only the base rules decide; rows with a null id
match no label; repeated rows get equal results; an empty table gives an empty result. No
Python runs on the executors.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.llm.common import crc_mod, let, plain_text, stored
from clickmart.session import clear_scratch, scratch_mark

SPACE = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]"
SYMBOLS = "[#*$%&|<>]"
BLANKS = " \t\n\x0b\x0c\r"
SPAN = 8  # words of a repeated window
BINS, MOST_RULES, MOST_CONDITIONS = 32, 12, 4
LEAST_PRECISION, LEAST_COVERED = 0.9, 3

#: Ratios the rules may use, from the statistics.
FEATURES = {
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "mark_share": "n_marks / greatest(word_chars, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "distinct_share": "n_distinct_words / greatest(n_words, 1)",
    "n_words": "cast(n_words as double)",
}


def _pair(array: Column, ahead: int) -> Column:
    """Hashes of each element and the one ``ahead`` places on."""

    def zipped(a: Column) -> Column:
        n = F.greatest(F.size(a) - ahead, F.lit(0))
        return F.zip_with(F.slice(a, F.lit(1), n), F.slice(a, F.lit(ahead + 1), n), lambda x, y: F.xxhash64(x, y))

    return let(array, zipped)


def _covered(windows: Column) -> Column:
    """Words in windows that occur twice or more: the union of those windows' spans."""
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(s: Column) -> Column:  # beyond the ends get() is null
        return F.filter(s, lambda x, k: F.get(s, k - 1)["h"].eqNullSafe(x["h"]) | F.get(s, k + 1)["h"].eqNullSafe(x["h"]))

    def spans(q: Column) -> Column:
        return F.aggregate(
            F.transform(q, lambda i, k: F.least(F.lit(SPAN), F.coalesce(F.get(q, k + 1) - i, F.lit(SPAN)))),
            F.lit(0), lambda total, x: total + x)

    return let(placed, lambda s: let(F.array_sort(F.transform(repeated(s), lambda x: x["i"])), spans))


def _repeat_words(hashes: Column) -> Column:
    """``n_repeat_words`` from the words' hashes; windows are hashed by doubling."""
    windows = _pair(_pair(_pair(hashes, 1), 2), 4)
    return let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(_covered(w)))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and the counts of every whole text."""
    text = plain_text(text_col)
    bare = F.btrim(text, F.lit(BLANKS))
    words = F.when(F.length(bare) == 0, F.array().cast("array<string>")).otherwise(F.split(bare, SPACE))
    of_words = let(words, lambda w: let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.size(F.array_distinct(h)).cast("long").alias("n_distinct_words"),
        F.when(F.size(w) < SPAN, 0).otherwise(_repeat_words(h)).cast("long").alias("n_repeat_words"),
    )))
    lines = F.filter(F.split(text, "\n"), lambda s: s.rlike(WORD))
    of_lines = let(lines, lambda s: F.struct(
        F.size(s).cast("long").alias("n_lines"),
        (F.size(s) - F.size(F.array_distinct(s))).cast("long").alias("n_dup_lines"),
    ))
    rows = docs.select(
        F.col(id_col).alias("id"), of_words.alias("w"), of_lines.alias("l"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit("[!?]")).cast("long").alias("n_marks"),
        F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("n_upper"),
    )
    return rows.select("id", "w.*", "l.*", "n_symbols", "n_marks", "n_upper")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        return self.of(F.expr(FEATURES[self.feature]))

    def of(self, value: Column) -> Column:
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _all(rule: Rule) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column()
    return out


def _gain(p: float, n: float, p0: float, n0: float) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p and p0 else 0.0


class _Counts:
    """Counts of bad (p) and good (n) rows of the grow and the prune part under a rule."""

    def __init__(self, table: DataFrame, edges: dict[str, list[float]]):
        self.names = [f for f in FEATURES if edges[f]]
        self.edges = edges
        pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(f"bin_{f}").alias("bin"))
                                    for i, f in enumerate(self.names)])).alias("x")
        self.rows = [(r["f"], r["bin"], r["bad"], r["grow"], r["n"]) for r in table.select("bad", "grow", pairs).groupBy(
            "x.f", "x.bin", "bad", "grow").agg(F.count(F.lit(1)).alias("n")).collect()]

    def total(self, grow: bool) -> tuple[int, int]:
        of = [(bad, n) for f, _, bad, g, n in self.rows if f == 0 and g == grow]
        return sum(n for bad, n in of if bad), sum(n for bad, n in of if not bad)

    def best(self) -> Condition | None:
        """The condition with the largest gain on the grow part; the first of equals."""
        p0, n0 = self.total(True)
        found, most = None, 1e-9
        for i, name in enumerate(self.names):
            cells = len(self.edges[name]) + 1
            bad, good = [0] * cells, [0] * cells
            for f, b, is_bad, grow, n in self.rows:
                if f == i and grow:
                    (bad if is_bad else good)[b] += n
            p = n = 0
            for b, edge in enumerate(self.edges[name]):  # bin b holds values <= edge b
                p, n = p + bad[b], n + good[b]
                for above, x, y in ((False, p, n), (True, p0 - p, n0 - n)):
                    if (gain := _gain(x, y, p0, n0)) > most:
                        found, most = Condition(name, above, edge), gain
        return found


def learn(stats: DataFrame, labels: DataFrame, folds: int = 3) -> list[Rule]:
    """The ordered rules for bad documents from ``stats`` and ``labels`` (doc_id, quality)."""
    mark = scratch_mark(stats.sparkSession)
    rules = _learn(stats, labels, folds)
    clear_scratch(stats.sparkSession, mark)
    return rules


def _learn(stats: DataFrame, labels: DataFrame, folds: int) -> list[Rule]:
    known = labels.select(F.col("doc_id").alias("id"), F.col("quality").alias("y")).where("id is not null and y in (0, 1)")
    rows = stats.where(~base_failed()).join(known, "id").select(
        (F.col("y") == 0).alias("bad"), (crc_mod("id", folds) != 0).alias("grow"),
        *[F.expr(x).alias(f) for f, x in FEATURES.items()],
    )
    rows = stored(rows, "llm-rules")
    shares = [i / BINS for i in range(1, BINS)]
    # quantiles of all rows and of the bad ones: junk is rare, its thresholds lie in the tails
    cut = rows.agg(*[F.percentile_approx(F.when(which, F.col(f)), shares, 100_000).alias(f"{f}_{j}")
                     for f in FEATURES for j, which in enumerate((F.lit(True), F.col("bad")))]).first()
    edges = {f: sorted({*(cut[f"{f}_0"] or []), *(cut[f"{f}_1"] or [])}) for f in FEATURES}

    def bin_of(name: str) -> Column:  # how many edges lie below the value
        return F.size(F.filter(F.array(*[F.lit(e) for e in edges[name]]), lambda e: e < F.col(name)))

    binned = [bin_of(f).alias(f"bin_{f}") for f in FEATURES if edges[f]]
    left = stored(rows.select("*", *binned), "llm-rules")
    names = [f for f in FEATURES if edges[f]]
    rules: list[Rule] = []
    if not names:
        return rules

    def under(table: DataFrame, rule: Rule) -> DataFrame:
        for c in rule:
            table = table.where(c.of(F.col(c.feature)))
        return table

    counts = _Counts(left, edges)
    while len(rules) < MOST_RULES:
        rule: Rule = ()
        now, steps = counts, []  # prune-part counts of each prefix of the rule
        while len(rule) < MOST_CONDITIONS and now.total(True)[1] and (c := now.best()):
            rule = (*rule, c)
            now = _Counts(under(left, rule), edges)
            steps.append(now.total(False))
        if not rule:
            break
        worth = [(p - n) / (p + n) if p + n else -1.0 for p, n in steps]
        keep = max(range(len(rule)), key=lambda i: (worth[i], -i))
        p, n = steps[keep]
        if p + n < LEAST_COVERED or p / (p + n) < LEAST_PRECISION:
            break
        rules.append(rule[:keep + 1])
        left = left.where(~_inside(rules[-1]))
        counts = _Counts(left, edges)
    return rules


def _inside(rule: Rule) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.of(F.col(c.feature))
    return out


def decide(rules: list[Rule]) -> Column:
    """Number of the first rule that holds, from 1 on; null if none does."""
    out = F.lit(None).cast("int")
    for i in reversed(range(len(rules))):
        out = F.when(_all(rules[i]), F.lit(i + 1)).otherwise(out)
    return out


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, the statistics, ``base_failed``, ``rule`` (first rule that rejects) and ``kept``."""
    stats = stored(statistics(docs, id_col, text_col), "llm-statistics")
    rules = learn(stats, labels)
    rule = decide(rules)
    return stats.select(
        F.col("id").alias(id_col), *[c for c in stats.columns if c != "id"], base_failed().alias("base_failed"),
        rule.alias("rule"), (~base_failed() & rule.isNull()).alias("kept"),
    )
