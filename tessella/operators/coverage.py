"""Lines, segments and range coverage. Everything is partitioned by (work, juan); line keys do not hold the file's prefix."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranges import line_key

VOLUME = ["work", "juan"]


def _in_order():
    return Window.partitionBy(*VOLUME).orderBy("idx")


def segment_source_join(lines: DataFrame, segments: DataFrame, bucket: int = 1000) -> DataFrame:
    """Adds source to segments: their non-empty lines in key order, joined by line feeds, "" if there are none.

    An equi-join on volume and key bucket, then the range test: a segment goes to the buckets that it touches, so a huge
    volume is spread over tasks and no pair outside the buckets is made. Ranges may overlap. Segments within one bucket, which most are, are put
    together where they were joined, so their texts are shuffled once; only those of several buckets meet again.
    """
    others = [c for c in segments.columns if c not in (*VOLUME, "number")]
    numbered = segments.select(*VOLUME, "number", F.monotonically_increasing_id().alias("row"), F.struct(*others).alias("others"))
    first, last = F.floor(F.col("others.start_key") / bucket), F.floor(F.col("others.end_key") / bucket)
    ordered, across = F.col("others.start_key") <= F.col("others.end_key"), F.coalesce(last > first, F.lit(False))
    dealt = lines.filter("text != ''").select(*VOLUME, "line_key", "text", F.floor(F.col("line_key") / bucket).alias("bucket"))
    within = _with_lines(numbered.filter(~across).withColumn("bucket", F.when(ordered, first)), dealt)
    pieces = _with_lines(numbered.filter(across).withColumn("bucket", F.explode(F.sequence(first, last))), dealt)
    joined = pieces.groupBy(*VOLUME, "number", "row").agg(F.first("others").alias("others"), F.flatten(F.collect_list("list")).alias("list"))
    both = within.select(joined.columns).union(joined)
    return both.select(*VOLUME, "number", "others.*", F.array_join(F.sort_array("list").t, "\n").alias("source")).select(*segments.columns, "source")


def _with_lines(cut: DataFrame, dealt: DataFrame) -> DataFrame:
    """The segments of each bucket with a list of their lines there, (key, text) in no order."""
    met = cut.join(dealt, [cut[c] == dealt[c] for c in (*VOLUME, "bucket")] + [dealt.line_key.between(cut["others.start_key"], cut["others.end_key"])], "left")
    line = F.when(dealt.line_key.isNotNull(), F.struct(dealt.line_key.alias("o"), dealt.text.alias("t")))
    rows = met.select(*(cut[c] for c in (*VOLUME, "bucket", "number", "row", "others")), line.alias("line"))
    return rows.groupBy(*VOLUME, "bucket", "number", "row").agg(F.first("others").alias("others"), F.collect_list("line").alias("list"))


def ordered_concat(rows: DataFrame, group: list[str], order: str, text: str, separator: str = "\n") -> DataFrame:
    """group, value: the group's texts in order, joined."""
    listed = rows.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t")))).alias("list"))
    return listed.select(*group, F.array_join("list.t", separator).alias("value"))


def volume_bounds(lines: DataFrame) -> DataFrame:
    """work, juan, first_id, last_id of the non-empty lines by key; volumes without any are left out."""
    return lines.filter("text != ''").groupBy(*VOLUME).agg(F.min_by("line_id", F.struct("line_key", "line_id")).alias("first_id"), F.max_by("line_id", F.struct("line_key", "line_id")).alias("last_id"))


def range_monotonic(sections: DataFrame) -> DataFrame:
    """Adds previous_key and monotonic: whether a section starts at or after the start of the one before."""
    keyed = sections.withColumn("start_key", line_key(F.col("start_id"))).withColumn("previous_key", F.lag("start_key").over(_in_order()))
    return keyed.withColumn("monotonic", F.coalesce(F.col("start_key") >= F.col("previous_key"), F.lit(True)))


def range_endpoints(sections: DataFrame, bounds: DataFrame) -> DataFrame:
    """work, juan, first_start, last_end, starts_right, ends_right against the bounds."""
    ends = sections.groupBy(*VOLUME).agg(F.min_by("start_id", "idx").alias("first_start"), F.max_by("end_id", "idx").alias("last_end"))
    return ends.join(bounds, VOLUME).select(*VOLUME, "first_start", "last_end", (F.col("first_start") == F.col("first_id")).alias("starts_right"), (F.col("last_end") == F.col("last_id")).alias("ends_right"))


def line_membership_check(sections: DataFrame, universe: DataFrame) -> DataFrame:
    """work, juan, idx, title, line_id: ends of ranges that are no known lines. A range of one line is tested, and reported, twice."""
    ends = sections.select(*VOLUME, "idx", "title", F.explode(F.array("start_id", "end_id")).alias("line_id"))
    return ends.join(universe.select(*VOLUME, "line_id"), [*VOLUME, "line_id"], "left_anti").select(*VOLUME, "idx", "title", "line_id")


def range_gaps_overlaps(sections: DataFrame, lines: DataFrame) -> DataFrame:
    """work, juan, idx, gap, overlap: lines between a section and the furthest end before it, and lines that it shares with that.

    Counted in line ordinals, as keys jump at column ends; lines are those of the volume, empty ones included.
    """
    ordinal = F.dense_rank().over(Window.partitionBy(*VOLUME).orderBy("line_key"))
    numbered = lines.select(*VOLUME, "line_id", ordinal.alias("ordinal"))
    start, end = (numbered.select(*VOLUME, F.col("line_id").alias(f"{side}_id"), F.col("ordinal").alias(side)) for side in ("start", "end"))
    placed = sections.select(*VOLUME, "idx", "start_id", "end_id").join(start, [*VOLUME, "start_id"]).join(end, [*VOLUME, "end_id"])
    before = F.max("end").over(_in_order().rowsBetween(Window.unboundedPreceding, -1))
    measured = placed.withColumn("before", before).filter("before IS NOT NULL")
    return measured.select(*VOLUME, "idx", F.greatest(F.col("start") - F.col("before") - 1, F.lit(0)).alias("gap"), F.greatest(F.least("before", "end") - F.col("start") + 1, F.lit(0)).alias("overlap"))


def coverage_report(sections: DataFrame, universe: DataFrame, bounds: DataFrame) -> DataFrame:
    """work, juan, idx, rule_no, issue: all that is wrong with the ranges of each volume that has bounds.

    Rules: 0 no sections, 1 first start, 2 last end, 3 end before start, 4 start before the previous start, 5 unknown end, 6 outside the bounds.
    """
    expected = bounds.select(*VOLUME, "first_id", "last_id")
    keyed = range_monotonic(sections).withColumn("end_key", line_key(F.col("end_id")))
    rows = keyed.join(expected, VOLUME)
    last = F.max("idx").over(Window.partitionBy(*VOLUME))
    rows = rows.withColumn("last_idx", last)
    outside = (F.col("start_key") < line_key(F.col("first_id"))) | (F.col("end_key") > line_key(F.col("last_id")))
    issue = lambda no, when, text: F.when(when, F.struct(F.lit(no).alias("rule_no"), text.alias("issue")))
    say = lambda *parts: F.concat(*(F.lit(p[1:]) if p.startswith("=") else F.col(p) for p in parts))
    tested = F.array_compact(F.array(
        issue(1, (F.col("idx") == 0) & (F.col("start_id") != F.col("first_id")), say("=first range starts at ", "start_id", "=, expected ", "first_id")),
        issue(2, (F.col("idx") == F.col("last_idx")) & (F.col("end_id") != F.col("last_id")), say("=last range ends at ", "end_id", "=, expected ", "last_id")),
        issue(3, F.col("end_key") < F.col("start_key"), say("title", "=: range end precedes start")),
        issue(4, ~F.col("monotonic"), say("title", "=: ranges are not monotonic")),
        issue(6, outside, say("title", "=: range is outside expected coverage")),
    ))
    own = rows.select(*VOLUME, "idx", F.inline(tested))
    unknown = line_membership_check(sections.join(expected, VOLUME, "left_semi"), universe).select(*VOLUME, "idx", F.lit(5).alias("rule_no"), F.concat("title", F.lit(": "), "line_id", F.lit(" is not present in data file")).alias("issue"))
    none = expected.join(sections.select(*VOLUME).distinct(), VOLUME, "left_anti").select(*VOLUME, F.lit(0).alias("idx"), F.lit(0).alias("rule_no"), F.lit("Translation source has no entries").alias("issue"))
    return reduce(DataFrame.unionByName, (own, unknown, none))


def validate_segmentation(segments: DataFrame, lines: DataFrame) -> DataFrame:
    """work, juan, rule_no, issue: a proposed segmentation that does not start or end with the volume, or that names unknown lines."""
    bounds = volume_bounds(lines)
    ends = segments.groupBy(*VOLUME).agg(F.min_by("start_id", "number").alias("first_start"), F.max_by("end_id", "number").alias("last_end")).join(bounds, VOLUME)
    first = ends.filter("first_start != first_id").select(*VOLUME, F.lit(1).alias("rule_no"), F.concat(F.lit("first segment must start at "), "first_id").alias("issue"))
    last = ends.filter("last_end != last_id").select(*VOLUME, F.lit(2).alias("rule_no"), F.concat(F.lit("last segment must end at "), "last_id").alias("issue"))
    unknown = line_membership_check(segments.withColumnRenamed("number", "idx"), lines)
    return first.unionByName(last).unionByName(unknown.select(*VOLUME, F.lit(3).alias("rule_no"), F.concat("title", F.lit(": "), "line_id", F.lit(" not in juan")).alias("issue")))
