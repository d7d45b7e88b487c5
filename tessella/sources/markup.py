"""Tables from HTML and from tables of contents. Links and nested contents are parsed row by row in small Arrow batches; the rest are built-in columns."""

from __future__ import annotations

import json
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranges import LOOSE, STRICT, line_key
from ..functions.text import trim_u, unescaped

BLOCK_PIECES = 4_096  # tags and runs of text of a volume that are walked together
# The marks that notes and the copyright begin with.
_NOTE_STARTS = ("<div class='footnote'", '<div class="footnote"', "<div id='cbeta-copyright'", '<div id="cbeta-copyright"')
_SPAN_NOTES = ("<span class='footnote", '<span class="footnote')
_PIECE = r"(?s)<!--.*?-->|<[^>]*>|[^<]+|<"


def _attribute(tag: Column, name: str) -> Column:
    """An attribute's value in a start tag; "" if it has none."""
    value = rf"""(?i)[\s"']{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return unescaped(F.concat(*(F.regexp_extract(tag, value, i) for i in (1, 2, 3))))


def _walked(pieces: DataFrame) -> DataFrame:
    """pieces (work, juan, block, at, own, place, step) with their line_id, depth `down` and its lowest point `lowest` so far, of the whole volume.

    A block carries over the sum of its steps, the lowest point of that sum, its last prefix and its last opened line; all of these compose.
    """
    keys = ["work", "juan", "block"]
    here = Window.partitionBy(*keys).orderBy("at")
    local = pieces.withColumns({"down": F.sum("step").over(here), "prefix": F.last(F.split_part("own", F.lit("_p"), F.lit(1)), ignorenulls=True).over(here)})
    local = local.withColumn("lowest", F.min("down").over(here))
    opens = F.col("own").isNotNull() | F.col("place").isNotNull()
    ends = local.groupBy(*keys).agg(
        F.sum("step").alias("step"), F.min("down").alias("low"), F.max_by("prefix", "at").alias("prefix"), F.max_by(F.struct("own", "place", "prefix"), F.when(opens, F.col("at"))).alias("opened"),
    )
    before = Window.partitionBy("work", "juan").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumns({"down_0": F.coalesce(F.sum("step").over(before), F.lit(0)), "prefix_0": F.last("prefix", ignorenulls=True).over(before)})
    line = F.coalesce("opened.own", F.concat(F.coalesce("opened.prefix", "prefix_0"), F.lit("_p"), "opened.place"))
    carried = carried.withColumn("line", line)
    low = F.coalesce(F.min(F.col("down_0") + F.col("low")).over(before), F.lit(0))
    carried = carried.select(*keys, "down_0", "prefix_0", low.alias("low_0"), F.last("line", ignorenulls=True).over(before).alias("line_0"))
    both = local.join(carried, keys)
    opened = F.coalesce("own", F.concat(F.coalesce("prefix", "prefix_0"), F.lit("_p"), "place"))
    line_id = F.coalesce(F.last(opened, ignorenulls=True).over(here), "line_0")
    lowest = F.least(F.lit(0), F.col("low_0"), F.col("down_0") + F.col("lowest"))
    return both.withColumns({"line_id": line_id, "lowest": lowest, "down": F.col("down_0") + F.col("down")})


def extract_lines(volumes: DataFrame) -> DataFrame:
    """(work, juan, html) -> work, juan, line_id, line_key, text; lines without text stay as empty ones.

    The html up to the first note is cut into tags and runs of text, in order. Line marks, and text spans once a mark has given the prefix,
    open a line, which the text after them belongs to. What is in a mark is skipped: a mark goes one level down, and any end tag one level
    up, also one that ends something else. How deep a piece lies is a running sum with a floor of 0, the sum less its lowest point so far.
    Running values are taken within blocks of pieces, and blocks are put together from what they carry over, so a volume is many tasks.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    body = F.substring(html, F.lit(1), F.coalesce(_first(html, _NOTE_STARTS) - 1, F.char_length(html)))
    pieces = volumes.select("work", "juan", F.posexplode(F.regexp_extract_all(body, F.lit(_PIECE), F.lit(0))).alias("at", "piece"))
    piece = F.col("piece")
    tag = F.lower(F.regexp_extract(piece, r"^<([A-Za-z][^\s/>]*)", 1))
    pieces = pieces.withColumns({"tag": tag, "ends": piece.rlike(r"^</[A-Za-z]") | ((tag != "") & piece.endswith("/>"))})
    kinds = F.when(F.col("tag").isin("a", "span"), F.split(_attribute(piece, "class"), r"\s+"))
    pieces = pieces.withColumn("kinds", kinds).withColumn("mark", F.coalesce(F.arrays_overlap("kinds", F.array(F.lit("lb"), F.lit("lineInfo"))), F.lit(False)))
    own = F.when(F.col("mark"), _attribute(piece, "id"))
    place = F.when(~F.col("mark") & (F.col("tag") == "span") & F.array_contains("kinds", "t"), F.nullif(_attribute(piece, "l"), F.lit("")))
    whole = rf"^(?:{LOOSE})\z"
    pieces = pieces.withColumns({"own": F.when(own.rlike(whole), own), "place": place, "step": F.col("mark").cast("int") - F.col("ends").cast("int")})
    walked = _walked(pieces.withColumn("block", F.expr(f"at div {BLOCK_PIECES}"))).filter("line_id IS NOT NULL")
    run = F.when((F.col("down") == F.col("lowest")) & ~piece.rlike(r"^<[A-Za-z/!?]"), trim_u(unescaped(piece)))
    kept = walked.withColumn("run", run).withColumn("run", F.when(~F.col("run").rlike(whole), F.col("run")))
    lines = kept.groupBy("work", "juan", "line_id").agg(F.array_sort(F.collect_list(F.when(F.col("run") != "", F.struct("at", "run")))).alias("runs"))
    return lines.select("work", "juan", "line_id", line_key(F.col("line_id")).alias("line_key"), trim_u(F.array_join("runs.run", "")).alias("text"))


def line_id_universe(volumes: DataFrame) -> DataFrame:
    """(work, juan, html) -> the distinct work, juan, line_id anywhere in the html."""
    ids = F.regexp_extract_all("html", F.lit(f"({STRICT})"), F.lit(1))
    return volumes.select("work", "juan", F.explode(ids).alias("line_id")).distinct()


class _Links(HTMLParser):
    def __init__(self):
        super().__init__()
        self.links: list[str] = []

    def handle_starttag(self, tag, attrs):
        self.links += [value for name, value in attrs if name in ("href", "src") and value]


def links_of_html(html: str) -> list[str]:
    parser = _Links()
    parser.feed(html)
    return parser.links


def extract_links(pages: DataFrame) -> DataFrame:
    """(path, html) -> path, pos from 0, link: href and src values in document order, not from comments, scripts or styles."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(path, pos, link) for path, html in zip(batch.path, batch.html, strict=True) for pos, link in enumerate(links_of_html(html or ""))]
            yield pd.DataFrame(out, columns=["path", "pos", "link"])

    return pages.select("path", "html").mapInPandas(rows, "path string, pos int, link string")


def _first(html: Column, markers: tuple[str, ...]) -> Column:
    """The earliest place of any marker, from 1; null if there is none."""
    return F.least(*(F.nullif(F.instr(html, m), F.lit(0)) for m in markers))


def split_html_parts(volumes: DataFrame) -> DataFrame:
    """(work, juan, html) -> work, juan, main, copyright, error: the text from the body to the first note or copyright, and the copyright tail."""
    html = F.col("html")
    body = F.coalesce(F.nullif(F.instr(html, "<div id='body'"), F.lit(0)), F.nullif(F.instr(html, '<div id="body"'), F.lit(0)))
    end = F.coalesce(_first(html, (*_NOTE_STARTS, *_SPAN_NOTES)), F.char_length(html) + 1)
    tail = F.coalesce(F.nullif(F.instr(html, _NOTE_STARTS[2]), F.lit(0)), F.nullif(F.instr(html, _NOTE_STARTS[3]), F.lit(0)))
    return volumes.select(
        "work", "juan", F.substring(html, body, F.greatest(end - body, F.lit(0))).alias("main"),
        F.coalesce(F.substr(html, tail), F.lit("")).alias("copyright"), F.when(body.isNull(), "no body").alias("error"),
    )


def footnotes(volumes: DataFrame) -> DataFrame:
    """(work, juan, html) -> work, juan, note_id, html: the last element of each note id in the volume."""
    element = r"""(?s)<(div|span)\s+class=['"]footnote(?: add)?['"]\s+id=['"]([^'"]+)['"][^>]*>.*?</\1>"""
    whole, ids = F.regexp_extract_all("html", F.lit(element), F.lit(0)), F.regexp_extract_all("html", F.lit(element), F.lit(2))
    each = volumes.select("work", "juan", F.posexplode(F.arrays_zip(whole.alias("html"), ids.alias("note_id"))).alias("pos", "n"))
    return each.groupBy("work", "juan", "n.note_id").agg(F.max_by("n.html", "pos").alias("html"))


def note_references(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r"""href=['"]#([^'"]+)['"]"""), F.lit(1))


def toc_rows(text: str | None) -> list[tuple]:
    """(pre, level, title, juan, lb, ancestors, parent_titles, error) of a table of contents in document order; one row with an error if it cannot be read."""
    out: list[tuple] = []
    try:
        stack = [(node, [], []) for node in reversed(json.loads(text or ""))]
        while stack:
            node, ancestors, titles = stack.pop()
            out.append((len(out), len(ancestors), str(node["title"]), int(node["juan"]), str(node["lb"]), ancestors, titles, None))
            path = ([*ancestors, len(out) - 1], [*titles, str(node["title"])])
            stack += [(child, *path) for child in reversed(node.get("children") or [])]
    except (ValueError, TypeError, KeyError, AttributeError) as e:
        return [(None, None, None, None, None, None, None, f"{type(e).__name__}: {e}")]
    return out


def flatten_toc(tocs: DataFrame) -> DataFrame:
    """(work, toc JSON list of nodes with title, juan, lb and children) -> work, pre, level, title, juan, lb, ancestors, parent_titles, error.

    A contents that is no such list becomes one row with an error and nulls.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(work, *row) for work, toc in zip(batch.work, batch.toc, strict=True) for row in toc_rows(toc)]
            frame = pd.DataFrame(out, columns=["work", "pre", "level", "title", "juan", "lb", "ancestors", "parent_titles", "error"])
            yield frame.astype({"pre": "Int64", "level": "Int64", "juan": "Int64"})

    return tocs.select("work", "toc").mapInPandas(rows, "work string, pre int, level int, title string, juan int, lb string, ancestors array<int>, parent_titles array<string>, error string")
