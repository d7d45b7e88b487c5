"""Line ids and ranges of them: <prefix>_p<page, 4 digits><column a, b or c><line, 2 digits>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The forms of labels and line ids.
LABEL = r"\d{4}[abc]\d{2}"
LOOSE = rf"[A-Za-z0-9._-]+_p{LABEL}"
STRICT_PREFIX = r"[A-Z]+\d+n\d+[A-Za-z]?"
STRICT = rf"{STRICT_PREFIX}_p{LABEL}"


def _key(label: Column) -> Column:
    page, column, line = (F.substring(label, at, n) for at, n in ((1, 4), (5, 1), (6, 2)))
    return page.cast("int") * 300 + (F.instr(F.lit("abc"), column) - 1) * 100 + line.cast("int")


def key_of_label(label: Column) -> Column:
    """A sortable int for page, column and line; null for what is no label."""
    return F.when(label.rlike(rf"^{LABEL}\z"), _key(label))


def line_key(line_id: Column, form: str = LOOSE) -> Column:
    """The key of a line id of the given form; the prefix does not count. Null for other strings."""
    return F.when(line_id.rlike(rf"^(?:{form})\z"), _key(F.right(line_id, F.lit(7))))


def parse_range(raw: Column) -> Column:
    """struct(start_id, end_id) of A, A-B, A-p<label> or A-<label>, an end without prefix taking that of the start; null if invalid."""
    start = F.split_part(raw, F.lit("-"), F.lit(1))
    rest = F.when(raw.contains("-"), F.substr(raw, F.instr(raw, "-") + 1)).otherwise("")
    prefix = F.split_part(start, F.lit("_p"), F.lit(1))
    short = F.concat(prefix, F.lit("_p"), F.regexp_replace(rest, "^p", ""))
    end = F.when(rest == "", start).when(rest.rlike(rf"^{LOOSE}\z"), rest).when(short.rlike(rf"^{LOOSE}\z"), short)
    return F.when(start.rlike(rf"^{LOOSE}\z") & end.isNotNull(), F.struct(start.alias("start_id"), end.alias("end_id")))


def parse_range_strict(raw: Column) -> Column:
    """As parse_range, for the form that the coverage check accepts: an end's own prefix must be that of the start."""
    form = rf"^(({STRICT_PREFIX})_p{LABEL})(?:-(?:\2_)?p?({LABEL}))?\z"
    start, prefix, label = (F.regexp_extract(raw, form, i) for i in (1, 2, 3))
    end = F.when(label == "", start).otherwise(F.concat(prefix, F.lit("_p"), label))
    return F.when(raw.rlike(form), F.struct(start.alias("start_id"), end.alias("end_id")))


def compact_range(start: Column, end: Column) -> Column:
    """The shortest range label: A, A-p<label> within a prefix, or A-B."""
    prefix = F.concat(F.split_part(start, F.lit("_p"), F.lit(1)), F.lit("_p"))
    tail = F.substr(end, F.instr(end, "_p") + 2)
    return F.when(start == end, start).when(F.startswith(end, prefix), F.concat(start, F.lit("-p"), tail)).otherwise(F.concat(start, F.lit("-"), end))
