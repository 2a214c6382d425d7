"""Line dedup (operator 2): winnowing over line hashes.

The lines of a text that hold a word are hashed in order. Of every ``window`` lines in a row the
one with the smallest hash (the last of equals) is a fingerprint. It is recorded with the hashes
of the window that chose it, so a fingerprint stands for its surroundings too: two places have
one in common if, and only if, they share a window.

Places are joined by fingerprint and window with the first place of that key (smallest id, then
locator, then line). A match has a diagonal, the distance between the two places. On its diagonal
it is extended both ways as long as the next lines' windows match the same partner; windows next to
it that first occur elsewhere are matches of their own. The lines of all runs go from the later
place. So exactly those lines go that belong to ``window`` lines or more in a row which stand, as
such a run, in an earlier place; a deleted line always has an equal line in an earlier place.

A key gives one match for each place, not one for each pair of places; keys that many
places hold are dealt over tasks (``spread_join``).

Defined results: null counts as empty; lines without a word are never compared or deleted;
texts shorter than a window of lines come back unchanged; single repeated lines stay;
a text that repeats another as a whole may end up empty; repeated rows are rows like any
other (the first by locator stays); an empty table gives an empty result. No Python runs on
the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmart.llm.common import LOCATOR, let, plain_text, spread_join, stored, with_locator

WINDOW = 2
WORD = "[^\\x20\\x09-\\x0D]"


def _sequences(base: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, locator, ``hashes``, ``at``): hashes of the lines with a word, and their places
    among all lines."""
    lines = F.split(plain_text(text_col), "\n")
    kept = F.filter(
        F.transform(lines, lambda s, i: F.struct(F.when(s.rlike(WORD), F.xxhash64(s)).alias("h"), i.alias("i"))),
        lambda x: x["h"].isNotNull(),
    )
    rows = base.select(F.col(id_col).alias("id"), *LOCATOR, kept.alias("kept"))
    return rows.select("id", *LOCATOR, F.col("kept.h").alias("hashes"), F.col("kept.i").alias("at"))


def _fingerprints(window: int) -> Column:
    """One for each ``window`` lines in a row: ``pos`` (of the line chosen), ``key`` (its hash and those
    of the window that chose it) and ``start`` (of that window)."""
    last = F.size("hashes") - F.lit(window)
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))

    def chosen(i):
        return let(F.slice("hashes", i + 1, F.lit(window)), lambda around: let(F.array_min(around), lambda least: F.struct(
            (i + F.lit(window) - F.array_position(F.reverse(around), least).cast("int")).alias("pos"),
            F.struct(least.alias("fingerprint"), around.alias("around")).alias("key"), i.alias("start"))))

    return F.transform(starts, chosen)


def repeated_runs(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(locator, ``partner`` (locator of the earlier place), ``diagonal``, ``lines``): maximal runs of
    repeated lines, as line numbers of the later text."""
    seqs = stored(_sequences(with_locator(docs), id_col, text_col), "llm-lines")
    marks = seqs.select(F.col("id").isNull().alias("none"), "id", *LOCATOR, F.explode(_fingerprints(window)).alias("w"))
    marks = marks.select("none", "id", *LOCATOR, "w.*")
    firsts = marks.groupBy("key").agg(
        F.min(F.struct("none", "id", *LOCATOR, "pos")).alias("first"), F.count(F.lit(1)).alias("n")
    ).where("n > 1").select("key", "first")
    met = spread_join(marks, firsts, ["key"]).where(
        ~F.struct(*LOCATOR, "pos").eqNullSafe(F.struct(*[F.col(f"first.{c}").alias(c) for c in (*LOCATOR, "pos")])))
    met = met.select(
        *LOCATOR, F.struct(*[F.col(f"first.{c}").alias(c) for c in LOCATOR]).alias("partner"),
        (F.col("pos") - F.col("first.pos")).alias("diagonal"), "start")
    # Both ways along the diagonal: windows that touch or overlap are one run.
    along = Window.partitionBy(*LOCATOR, "partner", "diagonal").orderBy("start")
    apart = F.coalesce(F.col("start") - F.lag("start").over(along) > window, F.lit(True))
    runs = met.withColumn("run", F.sum(apart.cast("int")).over(along))
    runs = runs.groupBy(*LOCATOR, "partner", "diagonal", "run").agg(
        F.min("start").alias("begin"), (F.max("start") + window).alias("end"))
    at = seqs.select(*LOCATOR, "at")
    return runs.join(at, list(LOCATOR)).select(
        *LOCATOR, "partner", "diagonal", F.slice("at", F.col("begin") + 1, F.col("end") - F.col("begin")).alias("lines"))


def repeated_lines(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(locator, ``lines``): numbers of the lines of a document that belong to repeated runs."""
    runs = repeated_runs(docs, window, id_col, text_col)
    return runs.groupBy(*LOCATOR).agg(F.array_distinct(F.flatten(F.collect_list("lines"))).alias("lines"))


def line_dedup(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` without repeated runs of lines, plus ``n_lines`` (before) and
    ``n_removed_lines``."""
    base = with_locator(docs)
    gone = repeated_lines(base, window, id_col, text_col)
    base = base.drop("n_lines", "n_removed_lines", "__gone").join(
        gone.withColumnRenamed("lines", "__gone"), list(LOCATOR), "left")
    lines = F.split(plain_text(text_col), "\n")
    left = let(lines, lambda ls: F.array_join(
        F.transform(F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col("__gone")), lambda i: F.get(ls, i)), "\n"))
    return base.select(
        *[F.when(F.col("__gone").isNull(), F.col(c)).otherwise(left).alias(c) if c == text_col else F.col(c)
          for c in docs.columns if c not in ("n_lines", "n_removed_lines", "__gone")],
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_removed_lines"),
    )
