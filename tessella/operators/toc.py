"""Tables of contents as flat rows with ancestor arrays, and the lines that their sections cover."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranges import key_of_label
from ..sources.markup import note_references


def find_subtree(toc: DataFrame, target: str) -> DataFrame:
    """The first node of each work whose title holds the target, and its descendants."""
    first = toc.filter(F.col("title").contains(target)).groupBy("work").agg(F.min("pre").alias("root"))
    return toc.join(first, "work").filter((F.col("pre") == F.col("root")) | F.array_contains("ancestors", F.col("root"))).drop("root")


def toc_next_boundary(toc: DataFrame) -> DataFrame:
    """Adds n_descendants and the lb of the next node that is no descendant (null at the end). Nodes are numbered without gaps."""
    counts = toc.select("work", F.explode("ancestors").alias("pre")).groupBy("work", "pre").agg(F.count("*").alias("n"))
    counted = toc.join(counts, ["work", "pre"], "left").withColumn("n_descendants", F.coalesce("n", F.lit(0))).drop("n")
    following = toc.select("work", F.col("pre").cast("long").alias("next_pre"), F.col("lb").alias("next_lb"), F.col("juan").alias("next_juan"))
    return counted.withColumn("next_pre", F.col("pre") + 1 + F.col("n_descendants")).join(following, ["work", "next_pre"], "left").drop("next_pre")


def toc_section_slices(toc: DataFrame, lines: DataFrame, bucket: int = 3000) -> DataFrame:
    """work, pre, juan, line_key, line_id, text: lines from a node's start up to the next node that is no descendant, over all volumes.

    A volume that begins before the start, but does not have the start line, is left out; one without the end line goes on to its end. Keys rise
    over a work, so nodes and lines meet on buckets of keys and the open end is cut at the work's last key.
    """
    bounded = toc_next_boundary(toc).withColumn("start_key", key_of_label(F.col("lb"))).withColumn("end_key", key_of_label(F.col("next_lb")))
    spans = lines.groupBy("work", "juan").agg(F.min("line_key").alias("first_key"), F.max("line_key").alias("last_key"))
    keys = lines.select("work", "juan", F.col("line_key").alias("k")).distinct()
    ends = spans.groupBy("work").agg(F.max("last_key").alias("work_end"))
    touched = lambda low, high: F.explode(F.when(low <= high, F.sequence(F.floor(low / bucket), F.floor(high / bucket)))).alias("bucket")
    nodes = bounded.select("work", "pre", "start_key", "end_key").join(ends, "work").select("work", "pre", "start_key", "end_key", touched(F.col("start_key"), F.least(F.col("end_key") - 1, F.col("work_end"))))
    pairs = nodes.join(spans.select("*", touched(F.col("first_key"), F.col("last_key"))), ["work", "bucket"]).filter("last_key >= start_key AND (end_key IS NULL OR first_key < end_key)").drop("bucket").distinct()
    started = pairs.join(keys.select("work", "juan", F.col("k").alias("start_key"), F.lit(True).alias("has_start")), ["work", "juan", "start_key"], "left")
    ended = started.join(keys.select("work", "juan", F.col("k").alias("end_key"), F.lit(True).alias("has_end")), ["work", "juan", "end_key"], "left")
    usable = ended.filter("start_key <= first_key OR has_start").withColumns({"low": F.greatest("start_key", "first_key"), "high": F.when(F.col("has_end"), F.col("end_key") - 1).otherwise(F.col("last_key"))})
    cut = usable.filter("low <= high").withColumn("bucket", F.explode(F.sequence(F.floor(F.col("low") / bucket), F.floor(F.col("high") / bucket))))
    dealt = lines.withColumn("bucket", F.floor(F.col("line_key") / bucket))
    return cut.join(dealt, ["work", "juan", "bucket"]).filter("line_key BETWEEN low AND high").select("work", "pre", "juan", "line_key", "line_id", "text")


def section_notes_join(fragments: DataFrame, notes: DataFrame) -> DataFrame:
    """fragments (work, pre, html) and notes (work, juan, note_id, html) -> work, pre, rank, note_id, html.

    Note ids in the order of their first reference, each once; the html is that of the first volume that has the id.
    """
    first = notes.groupBy("work", "note_id").agg(F.min_by("html", "juan").alias("note_html"))
    refs = fragments.select("work", "pre", F.posexplode(note_references(F.col("html"))).alias("pos", "note_id")).groupBy("work", "pre", "note_id").agg(F.min("pos").alias("pos"))
    joined = refs.join(first, ["work", "note_id"])
    rank = F.row_number().over(Window.partitionBy("work", "pre").orderBy("pos"))
    return joined.select("work", "pre", rank.alias("rank"), "note_id", F.col("note_html").alias("html"))
