"""Batch-inference jobs: packing sections, prompts, the pluggable model call, checking replies, merging drafts, splicing results."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.replies import SECTION as SECTION_REPLY
from ..functions.replies import parse_model_blocks
from ..functions.text import estimate_output_chars, trim_u

VOLUME = ["work", "juan"]
SECTION = [*VOLUME, "idx"]
BLOCK = 128  # numbers of sections that are folded together
MAX_SOURCE_CHARS, MAX_OUTPUT_CHARS, MAX_SECTIONS = 4_200, 8_000, 12


def pending_sections(sections: DataFrame) -> DataFrame:
    """Sections whose translation is blank; only these are ever drafted."""
    return sections.filter(trim_u(F.col("translation")) == "")


def _block_steps(max_sections: int, full: str) -> str:
    """For each place in a block where a batch may begin: how many batches begin in the block, and how far into the next rows the first one after it begins.

    A batch that is open at the block's start ends within max_sections rows, so there are as many places; the volume's first block has one.
    """
    state = lambda n, s, o, count, end: f"named_struct('n', {n}, 's', {s}, 'o', {o}, 'i', a.i + 1, 'count', {count}, 'end', {end})"
    return f"""transform(sequence(0, if(first, 0, {max_sections})), e -> if(e >= size(list), named_struct('end', e - size(list), 'count', 0L),
        aggregate(slice(concat(list, ahead), e + 1, size(list) + size(ahead)), named_struct('n', 0L, 's', 0L, 'o', 0L, 'i', e, 'count', 0L, 'end', -1),
            (a, x) -> CASE WHEN a.end >= 0 THEN a
                WHEN a.n > 0 and not ({full}) THEN {state("a.n + 1", "a.s + x.s", "a.o + x.o", "a.count", "-1")}
                WHEN a.i < size(list) THEN {state("1L", "x.s", "x.o", "a.count + 1", "-1")}
                ELSE {state("a.n", "a.s", "a.o", "a.count", "a.i - size(list)")} END,
            a -> named_struct('end', if(a.end >= 0, a.end, size(ahead)), 'count', a.count))))"""


def _chained(frame: pd.DataFrame) -> pd.DataFrame:
    """Where the first batch begins in each block of a volume, and how many begin before it."""
    frame = frame.sort_values("block")
    place, before, out = 0, 0, []
    for steps in frame.steps:
        out.append((place, before))
        place, before = steps[place]["end"], before + steps[place]["count"]
    return frame[[*VOLUME, "block"]].assign(place=[o[0] for o in out], before=[o[1] for o in out])


def draft_batches(sections: DataFrame, chars: Column, output: Column | None = None, max_source: int = MAX_SOURCE_CHARS, max_output: int = MAX_OUTPUT_CHARS, max_sections: int = MAX_SECTIONS) -> DataFrame:
    """work, juan, idx, batch from 0: sections packed in order; one that does not fit opens a batch, an oversized one stands alone.

    Where a batch begins depends on all before it, but a block of sections is a small function: from the place of the first batch in it to the place of the
    first one after it. Blocks are folded into these functions in parallel; only the functions of volumes with several blocks are chained, and then each block
    numbers its own sections. So a volume of any size is many tasks. chars and output are the sections' sizes.
    """
    output = (chars * F.lit(1.9) + F.lit(0.999)).cast("int") if output is None else output
    sized = sections.select(*VOLUME, "idx", F.expr(f"idx div {BLOCK}").alias("block"), chars.cast("long").alias("s"), output.cast("long").alias("o"))
    lists = sized.groupBy(*VOLUME, "block").agg(F.array_sort(F.collect_list(F.struct("idx", "s", "o"))).alias("list"))
    order = Window.partitionBy(*VOLUME).orderBy("block")
    # a block of one section at least, so as many blocks hold the next sections
    head = F.slice("list", 1, max_sections)
    next_heads = F.collect_list("head").over(order.rowsBetween(1, max_sections))
    edges = lists.select(*VOLUME, "block", head.alias("head")).select(
        *VOLUME, "block", F.slice(F.flatten(next_heads), 1, max_sections).alias("ahead"), F.lag("block").over(order).isNull().alias("first"), F.lead("block").over(order).isNull().alias("last"),
    )
    full = f"a.n >= {max_sections} or a.s + x.s > {max_source} or a.o + x.o > {max_output}"
    blocks = lists.join(edges, [*VOLUME, "block"])
    several = blocks.filter("not (first and last)").select(*VOLUME, "block", F.expr(_block_steps(max_sections, full)).alias("steps"))
    kinds = {name: sections.schema[name].dataType.simpleString() for name in VOLUME}
    chained = several.groupBy(*VOLUME).applyInPandas(_chained, f"work {kinds['work']}, juan {kinds['juan']}, block long, place int, before long")
    alone = blocks.filter("first and last").select(*VOLUME, "block", "list", F.lit(0).alias("place"), F.lit(0).cast("long").alias("before"))
    placed = alone.unionByName(blocks.filter("not (first and last)").select(*VOLUME, "block", "list").join(chained, [*VOLUME, "block"]))
    number = f"""aggregate(list, named_struct('n', 0L, 's', 0L, 'o', 0L, 'b', before - 1, 'i', 0, 'out', cast(array() as array<bigint>)),
        (a, x) -> CASE WHEN a.i < place THEN named_struct('n', a.n, 's', a.s, 'o', a.o, 'b', a.b, 'i', a.i + 1, 'out', concat(a.out, array(a.b)))
            WHEN a.n = 0 or {full} THEN named_struct('n', 1L, 's', x.s, 'o', x.o, 'b', a.b + 1, 'i', a.i + 1, 'out', concat(a.out, array(a.b + 1)))
            ELSE named_struct('n', a.n + 1, 's', a.s + x.s, 'o', a.o + x.o, 'b', a.b, 'i', a.i + 1, 'out', concat(a.out, array(a.b))) END,
        a -> a.out)"""
    packed = placed.select(*VOLUME, F.explode(F.arrays_zip(F.col("list.idx").alias("idx"), F.expr(number).alias("batch"))).alias("p"))
    return packed.select(*VOLUME, "p.idx", "p.batch")


def estimated(sections: DataFrame) -> DataFrame:
    return sections.withColumn("source_chars", F.char_length("source")).withColumn("output_chars", estimate_output_chars(F.col("source")))


def build_section_prompts(sections: DataFrame, subsets: DataFrame, template: str) -> DataFrame:
    """work, juan, idx, prompt: the template's $work, $juan, $title, $note, $source and $glossary filled in; a blank note is （無）."""
    joined = sections.join(subsets, SECTION, "left")
    note = F.coalesce(F.nullif(F.col("note"), F.lit("")), F.lit("（無）"))
    values = {"work": F.col("work"), "juan": F.col("juan").cast("string"), "title": F.col("title"), "note": note, "source": F.col("source"), "glossary": F.coalesce("glossary", F.lit("[]"))}
    parts: list[Column] = []
    rest = template
    while rest:  # split once, so that a value which looks like a placeholder stays as it is
        names = [n for n in values if f"${n}" in rest]
        name = min(names, key=lambda n: (rest.index(f"${n}"), -len(n)), default=None)
        head, _, rest = rest.partition(f"${name}") if name else (rest, "", "")
        parts += [F.lit(head), *([values[name]] if name else [])]
    return joined.select(*SECTION, F.concat(*parts).alias("prompt"))


def build_batch_prompts(sections: DataFrame, batches: DataFrame, subsets: DataFrame) -> DataFrame:
    """work, juan, batch, prompt: the batch's sections as numbered blocks, in order, with blank lines between."""
    joined = sections.join(batches, SECTION).join(subsets, SECTION, "left")
    number = (F.col("idx") + 1).cast("string")
    note = F.coalesce(F.nullif(F.col("note"), F.lit("")), F.lit("（無）"))
    block = F.concat(
        F.lit("<<<SOURCE_SECTION "), number, F.lit(">>>\nTitle: "), "title", F.lit("\nExisting note: "), note, F.lit("\nGlossary JSON:\n"), F.coalesce("glossary", F.lit("[]")),
        F.lit("\nSource:\n"), "source", F.lit("\n<<<END_SOURCE_SECTION "), number, F.lit(">>>"),
    )
    listed = joined.groupBy(*VOLUME, "batch").agg(F.array_sort(F.collect_list(F.struct("idx", block.alias("block")))).alias("list"))
    return listed.select(*VOLUME, "batch", F.array_join("list.block", "\n\n").alias("prompt"))


def build_segment_prompts(lines: DataFrame) -> DataFrame:
    """work, juan, lines, range_example: the volume's non-empty lines with their ids, and a range from the first to the fourth (or last)."""
    listed = lines.filter("text != ''").groupBy(*VOLUME).agg(F.array_sort(F.collect_list(F.struct("line_key", "line_id", "text"))).alias("list"))
    first, fourth = F.get("list", F.lit(0))["line_id"], F.get("list", F.least(F.lit(3), F.size("list") - 1))["line_id"]
    text = F.array_join(F.transform("list", lambda x: F.concat_ws("\t", x["line_id"], x["text"])), "\n")
    return listed.select(*VOLUME, text.alias("lines"), F.concat(first, F.lit("-p"), F.substr(fourth, F.instr(fourth, "_p") + 2)).alias("range_example"))


def echo_batch(prompt: Column) -> Column:
    """The offline model: each source section of a batch prompt comes back as its own translation."""
    block = r"(?s)<<<SOURCE_SECTION (\d+)>>>.*?\nSource:\n(.*?)\n<<<END_SOURCE_SECTION \1>>>"
    numbers, sources = F.regexp_extract_all(prompt, F.lit(block), F.lit(1)), F.regexp_extract_all(prompt, F.lit(block), F.lit(2))
    reply = lambda n, s: F.concat(F.lit("<<<SECTION "), n, F.lit(">>>\n<<<TRANSLATION\n"), s, F.lit("\n>>>\n<<<NOTE\n\n>>>\n<<<END_SECTION "), n, F.lit(">>>"))
    return F.array_join(F.zip_with(numbers, sources, reply), "\n")


def translate_batches(prompts: DataFrame, model: Callable[[list[str]], list[str]] | None = None, partitions: int | None = None) -> DataFrame:
    """Adds reply. Without a model the echo answers, in built-in columns; a model gets lists of prompts in Arrow batches.

    Batches hold about the same number of characters, so partitions are dealt round robin and not by volume.
    """
    dealt = prompts.repartition(partitions) if partitions else prompts
    if model is None:
        return dealt.withColumn("reply", echo_batch(F.col("prompt")))

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(reply=model(batch.prompt.tolist()))

    schema = ", ".join(f"`{c}` {t}" for c, t in dealt.dtypes)
    return dealt.mapInPandas(call, f"{schema}, reply string")


def parse_batch_replies(replies: DataFrame) -> DataFrame:
    """(batch_id, raw, expected array<int>) -> batch_id, number, expected, translation, note, error: each numbered section of a reply.

    A number that is too long to be one is null, and an error.
    """
    numbers, bodies = F.regexp_extract_all("raw", F.lit(SECTION_REPLY), F.lit(1)), F.regexp_extract_all("raw", F.lit(SECTION_REPLY), F.lit(2))
    each = replies.select("batch_id", "expected", F.explode(F.arrays_zip(numbers.alias("number"), bodies.alias("body"))).alias("s"))
    number = F.col("s.number").try_cast("int")
    read = each.select("batch_id", number.alias("number"), F.coalesce(F.array_contains("expected", number), F.lit(False)).alias("expected"), parse_model_blocks(F.col("s.body")).alias("b"))
    return read.select("batch_id", "number", "expected", "b.translation", "b.note", F.when(F.col("number").isNull(), "no section number").otherwise(F.col("b.error")).alias("error"))


def batch_reply_check(replies: DataFrame) -> DataFrame:
    """batch_id, accepted, duplicates, missing, bad: a batch is rejected whole for any issue, and its sections then go one by one.

    Unexpected numbers are ignored; duplicates are expected numbers that come again.
    """
    parsed = parse_batch_replies(replies).filter("expected")
    counts = parsed.groupBy("batch_id", "number").agg(F.count("*").alias("n"), F.max(F.col("error").isNotNull()).alias("bad"))
    got = counts.groupBy("batch_id").agg(F.array_sort(F.collect_list("number")).alias("numbers"), F.array_sort(F.collect_list(F.when(F.col("n") > 1, F.col("number")))).alias("duplicates"), F.array_sort(F.collect_list(F.when(F.col("bad"), F.col("number")))).alias("bad"))
    none = F.array().cast("array<int>")
    joined = replies.select("batch_id", "expected").join(got, "batch_id", "left")
    missing = F.array_sort(F.array_except("expected", F.coalesce("numbers", none)))
    checked = joined.select("batch_id", F.coalesce("duplicates", none).alias("duplicates"), missing.alias("missing"), F.coalesce("bad", none).alias("bad"))
    return checked.select("batch_id", (F.size("duplicates") + F.size("missing") + F.size("bad") == 0).alias("accepted"), "duplicates", "missing", "bad")


def draft_merge_inputs(sections: DataFrame, draft_a: DataFrame, draft_b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pending sections with draft_a and draft_b by position, volumes whose section counts differ).

    A volume without any draft B uses A twice; blank draft text is （缺稿）.
    """
    count = lambda df, name: df.groupBy(*VOLUME).agg(F.count("*").alias(name))
    counts = count(sections, "n").join(count(draft_a, "n_a"), VOLUME, "left").join(count(draft_b, "n_b"), VOLUME, "left").withColumn("n_b", F.coalesce("n_b", "n_a"))
    same = (F.col("n") == F.coalesce("n_a", F.lit(-1))) & (F.col("n") == F.coalesce("n_b", F.lit(-1)))
    text = lambda df, name: df.select(*SECTION, F.col("translation").alias(name))
    given = lambda x: F.coalesce(F.nullif(x, F.lit("")), F.lit("（缺稿）"))
    joined = pending_sections(sections).join(counts.filter(same).select(*VOLUME), VOLUME, "left_semi").join(text(draft_a, "a"), SECTION, "left").join(text(draft_b, "b"), SECTION, "left")
    merged = joined.select(*SECTION, "title", "source", "note", given(F.col("a")).alias("draft_a"), given(F.coalesce("b", "a")).alias("draft_b"))
    return merged, counts.filter(~same).select(*VOLUME, "n", "n_a", "n_b")


def splice_sections(sections: DataFrame, updates: DataFrame, keep_note_if_empty: bool, keep_text: bool = False) -> DataFrame:
    """sections with the translations and notes of updates (work, juan, idx, translation, note) by position.

    A null note keeps the old one, and so does an empty one for drafts and repairs (keep_note_if_empty). keep_text never overwrites text.
    """
    new = updates.select(*SECTION, trim_u(F.col("translation")).alias("new"), trim_u(F.col("note")).alias("new_note"))
    joined = sections.join(new, SECTION, "left")
    hit = F.col("new").isNotNull() & (F.lit(not keep_text) | (trim_u(F.col("translation")) == ""))
    noted = hit & F.col("new_note").isNotNull() & (F.lit(not keep_note_if_empty) | (F.col("new_note") != ""))
    spliced = {"translation": F.when(hit, F.col("new")).otherwise(F.col("translation")), "note": F.when(noted, F.col("new_note")).otherwise(F.col("note"))}
    return joined.withColumns(spliced).drop("new", "new_note")


def volume_check_report(coverage: DataFrame, glossary_issues: DataFrame, term_issues: DataFrame, volumes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(all issues, work, juan, n_issues, passed). Term issues count only for works whose glossary has no issues of its own.

    Issues are (work, juan, source, idx, rule_no, issue), so their order can be told. Works without terms have neither kind.
    """
    own = coverage.select(*VOLUME, F.lit("coverage").alias("source"), "idx", "rule_no", "issue")
    shape = glossary_issues.filter("rule_no > 0").join(volumes.select(*VOLUME).distinct(), "work").select(*VOLUME, F.lit("glossary").alias("source"), F.col("pos").alias("idx"), "rule_no", "issue")
    terms = term_issues.join(glossary_issues.select("work").distinct(), "work", "left_anti").select(*VOLUME, F.lit("terms").alias("source"), "idx", F.col("pos").alias("rule_no"), "issue")
    issues = own.unionByName(shape).unionByName(terms)
    counts = volumes.select(*VOLUME).distinct().join(issues.groupBy(*VOLUME).agg(F.count("*").alias("n")), VOLUME, "left")
    return issues, counts.select(*VOLUME, F.coalesce("n", F.lit(0)).alias("n_issues"), F.col("n").isNull().alias("passed"))


def repair_targets(issues: DataFrame) -> DataFrame:
    """work, juan, titles, hint: the distinct texts before the first colon of issues, and the first ten issues."""
    order = ["source", "idx", "rule_no", "issue"]
    title = F.when(F.col("issue").contains(":"), trim_u(F.split_part("issue", F.lit(":"), F.lit(1))))
    # one pass over the issues, as computing them takes longest
    ranked = issues.select(*VOLUME, "issue", title.alias("title"), F.row_number().over(Window.partitionBy(*VOLUME).orderBy(*order)).alias("rank"))
    first = F.collect_list(F.when(F.col("rank") <= 10, F.struct("rank", "issue")))
    found = ranked.groupBy(*VOLUME).agg(F.array_sort(F.collect_set("title")).alias("titles"), F.array_sort(first).alias("first"))
    return found.select(*VOLUME, "titles", F.array_join("first.issue", "；").alias("hint"))


def translation_progress(sections: DataFrame) -> DataFrame:
    """work, juan, total, done: per volume, and per work (juan null)."""
    done = F.count_if(trim_u(F.col("translation")) != "")
    return sections.rollup(*VOLUME).agg(F.count("*").alias("total"), done.alias("done")).filter("work IS NOT NULL")


def needs_reprocess_approval(requested: DataFrame, sections: DataFrame) -> DataFrame:
    """The requested volumes (work, juan) that have any translation."""
    have = sections.filter(trim_u(F.col("translation")) != "").select(*VOLUME).distinct()
    return requested.select(*VOLUME).distinct().join(have, VOLUME, "left_semi")
