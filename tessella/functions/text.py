"""Text columns with the Unicode rules of the data: white space beyond ASCII, line feeds as the only line ends, code-point lengths."""

from __future__ import annotations

from functools import reduce
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

_REFERENCE = r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"
#: All characters that Unicode calls white space, and the line ends among them and beside them that are no line feeds.
WHITE = "\t\n\x0b\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_ENDS = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
_NAMED = {"apos": "'"} | {name: chr(code) for name, code in name2codepoint.items()}


def trim_u(x: Column) -> Column:
    """Strip white space of any script from both ends."""
    return F.btrim(x, F.lit(WHITE))


def lines_of(x: Column) -> Column:
    """The lines of a text; every kind of line end counts as a line feed, and a final one starts no line."""
    # looking for each rare line end is much faster than a regex over all characters; the array keeps x from being computed for each
    def cut(t: Column) -> Column:
        rare = reduce(Column.__or__, (t.contains(end) for end in _ENDS))
        t = F.when(rare, F.regexp_replace(t, f"\r\n|[{_ENDS}]", "\n")).otherwise(t)
        return F.split(F.regexp_replace(t, r"\n\z", ""), "\n", -1)

    return F.get(F.transform(F.array(x), cut), F.lit(0))


def found(x: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, or null if nothing matches."""
    return F.get(F.regexp_extract_all(x, F.lit(pattern), F.lit(group)), F.lit(0))


def unescaped(x: Column) -> Column:
    """Text with its character references resolved: numeric ones, and the named ones of HTML 4. Others stay as they are."""
    named = F.map_from_arrays(F.array(*map(F.lit, _NAMED)), F.array(*map(F.lit, _NAMED.values())))

    def char(reference: Column) -> Column:
        body = F.substring(reference, 2, F.char_length(reference) - 2)
        code = F.when(body.rlike("^#[xX]"), F.conv(F.substr(body, F.lit(3)), 16, 10)).otherwise(F.substr(body, F.lit(2))).try_cast("int")
        coded = F.when(code.between(1, 0x10FFFF), F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise("\ufffd")
        return F.when(body.startswith("#"), coded).otherwise(F.coalesce(F.element_at(named, body), reference))

    parts, references = F.split(x, _REFERENCE, -1), F.transform(F.regexp_extract_all(x, F.lit(_REFERENCE), F.lit(0)), char)
    return F.when(x.contains("&"), F.array_join(F.zip_with(parts, references, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")).otherwise(x)


def html_escaped(x: Column) -> Column:
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        x = F.replace(x, F.lit(char), F.lit(name))
    return x


def html_paragraphs(x: Column) -> Column:
    """A paragraph per block of lines between blank lines; lines stripped, escaped and joined by breaks. Empty text gives one empty paragraph."""
    blocks = F.split(trim_u(x), r"(?U)\n\s*\n", -1)

    def paragraph(block: Column) -> Column:
        lines = F.filter(F.transform(lines_of(block), trim_u), lambda line: line != "")
        return F.concat(F.lit("<p>"), F.array_join(F.transform(lines, html_escaped), "<br>\n"), F.lit("</p>"))

    return F.array_join(F.transform(blocks, paragraph), "\n")


def chinese_number(n: Column) -> Column:
    """Numbers from 1 to 100 in Chinese digits; others in decimal ones."""
    digits = F.array(*map(F.lit, "一二三四五六七八九"))
    tens, ones = F.floor(n / 10).cast("int"), F.pmod(n, F.lit(10)).cast("int")
    last = F.when(ones > 0, F.get(digits, ones - 1)).otherwise("")
    return (
        F.when(n.between(1, 9), last)
        .when(n.between(10, 19), F.concat(F.lit("十"), last))
        .when(n.between(20, 99), F.concat(F.get(digits, tens - 1), F.lit("十"), last))
        .when(n == 100, F.lit("一百"))
        .otherwise(n.cast("string"))
    )


def slugify(index: Column, title: Column) -> Column:
    """A file name: the index in three digits and the title without characters that file names cannot have."""
    clean = F.regexp_replace(title, r'(?U)[\\/:*?"<>|()\s]+', "-")
    return F.concat(F.format_string("%03d", index), F.lit("-"), F.regexp_replace(clean, r"^-+|-+\z", ""), F.lit(".html"))


def volume_title(text: Column, work_title: Column, juan: Column) -> Column:
    """The title in the first line if it names a vernacular edition, without the word for draft; else one from the work's title."""
    first = trim_u(F.regexp_replace(F.get(lines_of(text), F.lit(0)), r"^#+", ""))
    named = trim_u(F.replace(first, F.lit("來源稿"), F.lit("")))
    return F.when(first.contains("白話"), named).otherwise(F.concat(work_title, F.lit("卷第"), juan.cast("string"), F.lit("白話對照")))


def expand_volume_spec(spec: Column) -> Column:
    """`13-15,20` as a sorted array of distinct ints. A descending range adds nothing; null marks a part that is no number, or no volume at all, and also a range that is too large for an array: jobs.spec_volumes() gives rows for ranges of any size, and errors."""
    parts = F.filter(F.transform(F.split(spec, ","), trim_u), lambda p: p != "")
    low = lambda p: F.split_part(p, F.lit("-"), F.lit(1)).try_cast("int")
    high = lambda p: F.when(p.contains("-"), F.substring_index(F.substr(p, F.instr(p, "-") + 1), ",", 1)).otherwise(p).try_cast("int")
    bad = F.exists(parts, lambda p: low(p).isNull() | high(p).isNull() | (high(p).cast("long") - low(p) >= 100_000))
    numbers = F.flatten(F.transform(parts, lambda p: F.when((low(p) <= high(p)) & (high(p).cast("long") - low(p) < 100_000), F.sequence(low(p), high(p))).otherwise(F.array().cast("array<int>"))))
    return F.when(~bad & (F.size(numbers) > 0), F.array_sort(F.array_distinct(numbers)))


def parse_reading_link(link: Column) -> Column:
    """struct(work, juan) from the tail of a reading address; null if there is none."""
    tail = r"/([A-Za-z][A-Za-z0-9.-]*)(?:_(\d{1,3}))?/?\z"
    link = trim_u(link)
    juan = F.nullif(F.regexp_extract(link, tail, 2), F.lit("")).cast("int")
    return F.when(link.rlike(tail), F.struct(F.regexp_extract(link, tail, 1).alias("work"), juan.alias("juan")))


def estimate_output_chars(source: Column) -> Column:
    return (F.char_length(source) * F.lit(1.9) + F.lit(0.999)).cast("int")
