"""CSV records from physical lines.

A quoted cell may hold line breaks, so a record can be several lines, and a line may lie in another
split than the record's first line. Whether a line starts inside a quoted cell depends on all
lines before it. What a line does to that state is a map of two states (outside, inside) to two:
it leaves the state as it is, turns it, or fixes it. Such maps compose, so the state before each
line is a prefix computation in two levels: running states inside of each split, then over one
row for each split of a file. No task holds more lines in order than one split has.

Quotes open a cell only at its beginning and are literal elsewhere, as in other CSV readers; the
fold over a line's quotes is an array aggregate (no regular expression: those recurse with the
number of quotes). Cells are cut by Spark's own CSV parser.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmart.plans.joins import join_small

#: Fixed value: characters that a quoted cell may have in usual CSV readers. A record that is
#: longer (a quote that never closes) is read as its first line alone.
CELL_LIMIT = 131_072

QUOTE = '"'
OUT, IN, CLOSING = 0, 1, 2
RECORD = ("source_file", "block_start", "row_id")


def end_state(line: Column, start: int) -> Column:
    """State after a line that starts outside (0) or inside (1) of a quoted cell."""
    parts = F.split(line, QUOTE)
    head = F.element_at(parts, 1)

    def quote_then(acc, part):
        met = (
            F.when(acc["state"] == OUT, F.when(acc["fresh"], F.lit(IN)).otherwise(F.lit(OUT)))
            .when(acc["state"] == IN, F.lit(CLOSING)).otherwise(F.lit(IN))  # a doubled quote
        )
        state = F.when((met == CLOSING) & (part != ""), F.lit(OUT)).otherwise(met)
        return F.struct(state.alias("state"), part.endswith(",").alias("fresh"))

    first = F.struct(F.lit(start).alias("state"), ((head == "") | head.endswith(",")).alias("fresh"))
    rest = F.slice(parts, F.lit(2), F.size(parts))
    last = F.aggregate(rest, first, quote_then, lambda acc: acc["state"])
    return F.when(F.contains(line, F.lit(QUOTE)), F.when(last == IN, 1).otherwise(0)).otherwise(start)


def with_moves(lines: DataFrame) -> DataFrame:
    """``lines`` plus the state after each line, from outside and from inside."""
    return lines.withColumn("from_out", end_state(F.col("value"), 0)).withColumn("from_in", end_state(F.col("value"), 1))


def _running(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``rows`` plus the state before each row, as ``fixed`` (null: that before the first row) and ``turns``."""
    upto = Window.partitionBy(*keys).orderBy(*order)
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    turn = (F.col("from_out") > F.col("from_in")).cast("int")
    rows = rows.withColumn("__turns", F.coalesce(F.sum(turn).over(before), F.lit(0)))
    fixes = F.when(F.col("from_out") == F.col("from_in"), F.struct(F.col("from_out").alias("to"), F.col("__turns").alias("at")))
    rows = rows.withColumn("__last", F.last(fixes, ignorenulls=True).over(before))
    since = F.col("__turns") - F.coalesce("__last.at", F.lit(0))
    return rows.withColumn("fixed", F.col("__last.to")).withColumn("turns", since % 2).drop("__turns", "__last")


def _state(start: Column) -> Column:
    return F.coalesce("fixed", start).bitwiseXOR(F.col("turns").cast("int"))


def records(lines: DataFrame) -> DataFrame:
    """Lines with ``with_moves`` joined to records (one row each, at the place of its first line);
    blank lines between records go. Only files with a quote left open at a line's end are
    sorted; where there is none, nothing is shuffled."""
    out = [c for c in lines.columns if c not in ("from_out", "from_in")]
    filled = F.length(F.trim("value")) > 0
    torn = lines.where("from_out = 1").select("source_file", F.lit(True).alias("torn")).distinct()
    if torn.isEmpty():
        return lines.where(filled).select(*out)
    marked = join_small(lines, torn, ["source_file"], "left")
    whole = marked.where(F.col("torn").isNull() & filled).select(*out)

    split = ["source_file", "block_start"]
    rows = _running(marked.where("torn").drop("torn"), split, ["row_id"])

    def after(start: int) -> Column:
        return F.when(_state(F.lit(start)) == 1, F.col("from_in")).otherwise(F.col("from_out"))

    blocks = rows.groupBy(*split).agg(
        F.max_by(after(0), "row_id").alias("from_out"), F.max_by(after(1), "row_id").alias("from_in"))
    blocks = _running(blocks, ["source_file"], ["block_start"]).select(*split, _state(F.lit(0)).alias("entry"))
    rows = join_small(rows, blocks, split, "inner").withColumn("inside", _state(F.col("entry")))
    first = F.when(F.col("inside") == 0, F.struct("block_start", "row_id"))
    rows = rows.withColumn("__own", F.last(first, ignorenulls=True).over(Window.partitionBy(*split).orderBy("row_id")))
    earlier = Window.partitionBy("source_file").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy(*split).agg(F.max(first).alias("last")).select(
        *split, F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    rows = join_small(rows, carried, split, "inner").withColumn("__first", F.coalesce("__own", "carried"))
    rows = rows.withColumn("__is_first", F.struct("block_start", "row_id") == F.col("__first"))

    sizes = rows.groupBy("source_file", "__first").agg(
        F.count(F.lit(1)).alias("__lines"), F.sum(F.length("value") + 1).alias("__chars"))
    sized = rows.join(sizes, ["source_file", "__first"])
    single = F.col("__is_first") & ((F.col("__lines") == 1) | (F.col("__chars") > CELL_LIMIT))
    alone = sized.where(single & filled).select(*out)
    rest = [c for c in out if c not in (*RECORD, "value")]
    joined = sized.where((F.col("__lines") > 1) & (F.col("__chars") <= CELL_LIMIT)).groupBy("source_file", "__first").agg(
        *[F.first(c).alias(c) for c in rest],
        F.array_sort(F.collect_list(F.struct("block_start", "row_id", "value"))).alias("__parts"))
    joined = joined.withColumn("value", F.array_join(F.transform("__parts", lambda p: p["value"]), "\n")).select(
        *[F.col(f"__first.{c}").alias(c) if c in ("block_start", "row_id") else F.col(c) for c in out])
    return whole.unionByName(alone).unionByName(joined)


def cells(record: Column, width: int) -> Column:
    """The first ``width`` cells of a record, by Spark's CSV parser where there is a quote."""
    names = [f"c{i}" for i in range(width)]
    options = {"quote": QUOTE, "escape": QUOTE, "emptyValue": "", "mode": "PERMISSIVE"}
    row = F.from_csv(record, ", ".join(f"{n} string" for n in names), options)
    return F.when(F.contains(record, F.lit(QUOTE)), F.array(*[row[n] for n in names])).otherwise(F.split(record, ","))
