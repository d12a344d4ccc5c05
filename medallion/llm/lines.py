"""Line dedup: a suffix array over line ids, by prefix doubling. DataFrame functions only.

Suffixes of all documents' lines are ranked by their first line, then by 2, 4, ... lines: a suffix's
pair of its own rank and that of the suffix as many lines on is ranked anew, rank being the number of
suffixes that sort before. Suffixes that share no line run with another leave at once, so a step
handles repeated lines only. When the ranks tell ``min_lines`` lines apart, the suffixes of one rank are
the interval of the suffix array whose common prefixes have at least that length. Deeper ranks would
split intervals but not change which lines repeat, so the doubling ends there; maximal runs are the
stretches of neighbouring suffixes in such intervals.

Of an interval the first suffix, by doc_id, row and line, stays whole: its ``min_lines`` lines are
kept. Lines that a later suffix covers and no first one does are deleted.

Ranks are prefix sums in two steps, within and over ranges of the second rank, so that a line that a
third of all suffixes start with is not one task.

* lines end at a line feed; the empty text has one empty line; a carriage return is part of the line
* null text: stays null, no lines; null doc_id: sorts before all others
* rows that repeat a doc_id or a whole row: documents of their own
* empty table: no rows; fewer lines than ``min_lines``: kept; columns of any name are passed through
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from medallion.llm.store import numbered, stored

#: Ranges of a prefix sum.
RANGES = 1024


def _ranked(groups: DataFrame, first: list[str], second: list[str], part: Column) -> DataFrame:
    """``groups`` (first, second, n) with rank: the sum of n of all that sort before, plus that of ``first`` itself.

    ``first`` is a rank already (or empty); ``part`` cuts the order of ``second`` into ranges.
    """
    marked = groups.withColumn("part", part)
    sums = marked.groupBy(*first, "part").agg(F.sum("n").alias("total"))
    before = lambda name, w: F.coalesce(F.sum(name).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = sums.withColumn("base", before("total", Window.partitionBy(*first).orderBy("part"))).drop("total")
    inside = before("n", Window.partitionBy(*first, "part").orderBy(*second))
    start = F.col(first[0]) if first else F.lit(0)
    return marked.withColumn("inside", inside).join(bases, [*first, "part"]).withColumn("rank", start + F.col("base") + F.col("inside"))


def intervals(lines: DataFrame, min_lines: int) -> DataFrame:
    """row, doc_id, no and rank of all suffixes that share their first ``min_lines`` lines with another, from
    ``lines`` (row, doc_id, no, h1, h2)."""
    repeated = lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1")
    first = stored(_ranked(repeated, [], ["h1", "h2"], F.shiftright("h1", 54)).select("h1", "h2", "rank"), "line-order")
    now = stored(lines.join(first, ["h1", "h2"]).select("row", "doc_id", "no", "rank"), "line-ranks")
    depth = 1
    while depth < min_lines:
        step = min(depth, min_lines - depth)
        on = now.select("row", (F.col("no") - step).alias("no"), F.col("rank").alias("b"))
        pairs = now.withColumnRenamed("rank", "a").join(on, ["row", "no"])
        width = max(1, -(-(now.agg(F.max("rank").alias("size")).first()["size"] or 0) // RANGES))
        groups = pairs.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1")
        ranks = _ranked(groups, ["a"], ["b"], F.floor(F.col("b") / width)).select("a", "b", "rank")
        now = stored(pairs.join(stored(ranks, "line-order"), ["a", "b"]).select("row", "doc_id", "no", "rank"), "line-ranks")
        depth += step
    return now


def line_dedup(docs: DataFrame, min_lines: int = 2) -> tuple[DataFrame, DataFrame]:
    """The documents without later copies of line runs, and the runs.

    Documents: all columns as struct ``doc`` with the new text, n_lines and n_deleted. Runs: doc_id, row, start (first
    deleted line), lines.
    """
    held = numbered(docs)
    split = F.split("doc.text", "\n")
    lines = held.select("row", F.col("doc.doc_id").alias("doc_id"), F.posexplode(split).alias("no", "line")).select(
        "row", "doc_id", "no", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")
    )
    suffixes = intervals(lines, min_lines)
    firsts = stored(suffixes.groupBy("rank").agg(F.min(F.struct("doc_id", "row", "no")).alias("first")), "line-firsts")
    covered = suffixes.join(firsts, "rank").select(
        "row",
        "doc_id",
        ((F.col("row") == F.col("first.row")) & (F.col("no") == F.col("first.no"))).alias("stays"),
        F.explode(F.sequence(F.col("no"), F.col("no") + (min_lines - 1))).alias("no"),
    )
    gone = stored(covered.groupBy("row", "no").agg(F.first("doc_id").alias("doc_id"), F.max("stays").alias("stays")).where("NOT stays"), "line-gone")
    per_doc = gone.groupBy("row").agg(F.collect_set("no").alias("gone"))
    count = F.coalesce(F.size(split), F.lit(0))
    left = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), "gone")
    text = F.when(F.col("gone").isNull(), F.col("doc.text")).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(split, i)), "\n")
    )
    cleaned = (
        held.join(per_doc.withColumnRenamed("row", "of").hint("merge"), F.col("row") == F.col("of"), "left")
        .withColumn("n_lines", F.when(F.col("doc.text").isNull(), 0).otherwise(count).cast("long"))
        .withColumn("n_deleted", F.coalesce(F.size("gone"), F.lit(0)).cast("long"))
        .select(F.col("doc").withField("text", text).alias("doc"), "n_lines", "n_deleted")
    )
    island = F.col("no") - F.row_number().over(Window.partitionBy("row").orderBy("no"))
    runs = gone.withColumn("island", island).groupBy("row", "island").agg(
        F.first("doc_id").alias("doc_id"), F.min("no").alias("start"), F.count("*").alias("lines")
    )
    return cleaned, runs.select("doc_id", "row", "start", "lines")
