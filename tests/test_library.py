"""Operators on small hand-made tables: the rules that the given tables cannot show."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tessella.functions import ranges, replies, text
from tessella.operators import coverage, glossary, inference, jobs, matching, publish, toc
from tessella.sources import markup, volumes
from tessella.streaming import jobs as streams


def one(spark, *values):
    """A row with columns a, b, ..."""
    return spark.createDataFrame([values], ", ".join(f"{c} {'int' if isinstance(v, int) else 'string'}" for c, v in zip("abcdef", values)))


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.r for r in df.select("i", f(F.col("v")).alias("r")).orderBy("i").collect()]


def test_unicode_text(spark):
    assert column(spark, ["　奉　詔\xa0\n", "", None], text.trim_u) == ["奉　詔", "", None]
    assert column(spark, ["a\r\nb\x85c\n", "", "a\n\nb"], text.lines_of) == [["a", "b", "c"], [""], ["a", "", "b"]]
    assert column(spark, ["a <b\n  c\n \n d & 'e'", ""], text.html_paragraphs) == ["<p>a &lt;b<br>\nc</p>\n<p>d &amp; &#x27;e&#x27;</p>", "<p></p>"]
    assert column(spark, [1, 10, 19, 20, 35, 100, 101, 0], text.chinese_number, "int") == ["一", "十", "十九", "二十", "三十五", "一百", "101", "0"]
    assert column(spark, ["13-15,20, 14", "5-3", "", "x", "5-3,2"], text.expand_volume_spec) == [[13, 14, 15, 20], None, None, None, [2]]
    assert column(spark, ["http://x/zh/T1579_011/", "x/T1/", "http://x/1"], text.parse_reading_link) == [("T1579", 11), ("T1", None), None]
    assert column(spark, ["a" * 10, ""], text.estimate_output_chars) == [19, 0]
    assert column(spark, ["#  X 白話對照來源稿\nrest", "plain"], lambda v: text.volume_title(v, F.lit("W"), F.lit(3))) == ["X 白話對照", "W卷第3白話對照"]
    assert column(spark, ['-a/b  "c"?', "　x"], lambda v: text.slugify(F.lit(7), v)) == ["007-a-b-c.html", "007-x.html"]


def test_ranges(spark):
    a, b = "T30n1579_p0328c02", "T30n1579_p0329a10"
    assert column(spark, [a, "x_p0001d01", "p0001a01", "0001a01"], ranges.line_key) == [328 * 300 + 202, None, None, None]
    got = column(spark, [a, f"{a}-{b}", f"{a}-p0329a10", f"{a}-0329a10", f"{a}-x", "x", f"{a}-Q1n1_p0001a01"], ranges.parse_range)
    assert got == [(a, a), (a, b), (a, b), (a, b), None, None, (a, "Q1n1_p0001a01")]
    assert column(spark, [f"{a}-p0329a10", f"{a}-Q1n1_p0001a01", "x.y_p0001a01"], ranges.parse_range_strict) == [(a, b), None, None]
    pairs = spark.createDataFrame([(a, a), (a, b), (a, "Q1n1_p0001a01")], "s string, e string")
    assert [r.r for r in pairs.select(ranges.compact_range(F.col("s"), F.col("e")).alias("r")).collect()] == [a, f"{a}-p0329a10", f"{a}-Q1n1_p0001a01"]


VOLUME = "# head\n\n## 01 First\nRange: A1n1_p0001a01-p0001a05\n\nSource:\n<<<\n　text \n>>>\n\nTranslation:\n<<<\n\n>>>\n\n## 02 Second\nRange: A1n1_p0001a06\nSource:\n<<<\ns\n>>>\nTranslation:\n<<<\nt\n>>>\nNote:\n<<<\nn\n>>>\n## 03 Bad\nSource:\n<<<\ns\n>>>\n"


def test_reading_volumes_and_segments(spark, tmp_path):
    (tmp_path / "A1-001-baihua.md").write_text(VOLUME)
    (tmp_path / "other.md").write_text(VOLUME)
    rows = volumes.read_sections(spark, str(tmp_path)).orderBy("idx").collect()
    assert [(r.work, r.juan, r.idx, r.title, r.source, r.translation, r.note, r.error) for r in rows] == [
        ("A1", 1, 0, "01 First", "text", "", "", None), ("A1", 1, 1, "02 Second", "s", "t", "n", None), ("A1", 1, 2, "03 Bad", "s", None, "", "missing Range, Translation"),
    ]
    assert rows[0].end_id == "A1n1_p0001a05" and rows[1].start_id == rows[1].end_id
    table = "# title\trange\tnote\n\n t \tA_p0001a01 \nbad\nu\tA_p0001a02-p0001a03\tn\tmore\nv\tx\n"
    got = volumes.parse_segments(spark.createDataFrame([("A", 1, table)], "work string, juan int, value string")).orderBy("number").collect()
    assert [(r.number, r.title, r.start_id, r.end_id, r.note, r.error) for r in got] == [
        (1, "t", "A_p0001a01", "A_p0001a01", "", None), (2, "bad", None, None, "", "fewer than two columns"), (3, "u", "A_p0001a02", "A_p0001a03", "n", None), (4, "v", None, None, "", "invalid range x"),
    ]
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "A1-002.json").write_text(json.dumps({"results": ["<p>", "no"]}))
    assert [tuple(r) for r in volumes.read_raw_volumes(spark, str(tmp_path / "raw")).collect()] == [("A1", 2, "<p>")]


def test_trimming_and_lines_against_regexes(spark):
    from tessella.functions import text

    odd = [chr(c) for c in (*range(0x21), 0x7F, 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF)]
    texts = [f"{c}a{c}b{c}" for c in odd] + ["", "\n", "a\r\nb\r", "a\n\n", "\u3000\u2028x\t ", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    slow = F.split(F.regexp_replace(F.regexp_replace("t", "\\r\\n|[\\r\\x0B\\f\\x1C-\\x1E\\x85\u2028\u2029]", "\n"), r"\n\z", ""), "\n", -1)
    for r in df.select("t", text.trim_u(F.col("t")).alias("a"), F.regexp_replace("t", r"(?U)^\s+|\s+\z", "").alias("b"), text.lines_of(F.col("t")).alias("c"), slow.alias("d")).collect():
        assert (r.a, r.c) == (r.b, r.d), ascii(r.t)


def test_batches_of_texts_are_taken_in_slices():
    import pyarrow as pa

    from tessella.operators import matching

    batch = pa.RecordBatch.from_pydict({"work": ["A"] * 1000, "html": [f"t{i}" for i in range(1000)]})
    parts = list(matching.sliced(iter([batch, batch.slice(0, 0)])))
    assert [p.num_rows for p in parts] == [256, 256, 256, 232] and pa.Table.from_batches(parts).to_pydict() == batch.to_pydict()


def test_many_volumes_share_files(spark, tmp_path):
    n = 200
    rows = spark.range(n, numPartitions=2).selectExpr("'A' AS work", "int(id) AS juan", "1 AS pos", "concat('t', id, '\\tA_p0001a01\\tn') AS line")
    volumes.write_segments(rows, str(tmp_path / "segments"))
    got = volumes.read_segments(spark, str(tmp_path / "segments"), packed=True).collect()
    assert sorted((r.juan, r.number, r.title, r.note) for r in got) == [(i, 1, f"t{i}", "n") for i in range(n)]
    assert volumes.segment_tables(spark, str(tmp_path / "segments")).filter("juan = 7").first().value == "# title\trange\tnote\nt7\tA_p0001a01\tn\n"
    raw = spark.range(n, numPartitions=2).selectExpr("concat('A-', lpad(id, 3, '0'), '.json') AS name", "array(concat('<p>', char(10), id), 'no') AS results")
    volumes.write_raw_volumes(raw.union(raw.limit(1).selectExpr("'other'", "results")), str(tmp_path / "raw"))
    assert sorted(map(tuple, volumes.read_raw_volumes(spark, str(tmp_path / "raw"), packed=True).collect())) == [("A", i, f"<p>\n{i}") for i in range(n)]
    assert all(len(list((tmp_path / kind).glob("part-*"))) <= 8 for kind in ("segments", "raw"))


def test_round_trip_of_a_volume(spark):
    lines = spark.createDataFrame([("A", 1, f"A_p0001a{i:02d}", 300 + i, t) for i, t in ((1, "x"), (2, ""), (3, "y"))], "work string, juan int, line_id string, line_key int, text string")
    segments = spark.createDataFrame([("A", 1, 1, "t", "A_p0001a01", "A_p0001a03", 301, 303, "n"), ("A", 1, 2, "u", "A_p0001a02", "A_p0001a02", 302, 302, "")], "work string, juan int, number int, title string, start_id string, end_id string, start_key int, end_key int, note string")
    rendered = volumes.render_volume_markdown(coverage.segment_source_join(lines, segments), spark.createDataFrame([("A", "經")], "work string, work_title string"))
    assert rendered.first().value.startswith("# 經卷第一白話對照來源稿\n\n底本：A《經》卷第一。範圍為 `A_p0001a01` 至 `A_p0001a03`。\n\n## 01 t\nRange: A_p0001a01-p0001a03\n")
    back = volumes.parse_sections(rendered).orderBy("idx").collect()
    assert [(r.title, r.source, r.translation, r.note) for r in back] == [("01 t", "x\ny", "", "n"), ("02 u", "", "", "")]


def test_html_lines_notes_and_parts(spark):
    html = (
        "<span class='t' l='0001a01'>early</span><div id='body'><span class='lb' id='A_p0001a02'>A_p0001a02</span><span class='t' l='0001a02'> text <span class='pc'>。</span></span>"
        "<a class='lineInfo' id='A_p0001a03'>skip</a>A_p0001a03<b>in</b> out<span class='t' l='0001a04'></span></div><div class='footnote' id='n1'>one</div><span class=\"footnote add\" id='n2'>two</span><div id='cbeta-copyright'>c</div>"
    )
    df = spark.createDataFrame([("A", 1, html)], "work string, juan int, html string")
    got = {r.line_id: r.text for r in markup.extract_lines(df).collect()}
    assert got == {"A_p0001a02": "text。", "A_p0001a03": "inout", "A_p0001a04": ""}
    parts = markup.split_html_parts(df).first()
    assert parts.main.startswith("<div id='body'>") and parts.main.endswith("</div>") and parts.copyright == "<div id='cbeta-copyright'>c</div>"
    assert {(r.note_id, r.html) for r in markup.footnotes(df).collect()} == {("n1", "<div class='footnote' id='n1'>one</div>"), ("n2", "<span class=\"footnote add\" id='n2'>two</span>")}
    fragments = spark.createDataFrame([("A", 0, "<a href='#n2'></a><a href=\"#n1\"></a><a href='#n2'></a><a href='#n9'></a>")], "work string, pre int, html string")
    assert [(r.rank, r.note_id) for r in toc.section_notes_join(fragments, markup.footnotes(df)).orderBy("rank").collect()] == [(1, "n2"), (2, "n1")]


def test_coverage_rules(spark):
    schema = "work string, juan int, idx int, title string, start_id string, end_id string"
    line = lambda n: f"A1n1_p0001a{n:02d}"
    sections = spark.createDataFrame([("A", 1, 0, "a", line(2), line(5)), ("A", 1, 1, "b", line(1), line(9)), ("A", 1, 2, "c", line(6), line(4))], schema)
    universe = spark.createDataFrame([("A", 1, line(n), 300 + n, "x") for n in range(1, 9)] + [("A", 2, line(1), 301, "x")], "work string, juan int, line_id string, line_key int, text string")
    got = {(r.juan, r.idx, r.rule_no) for r in coverage.coverage_report(sections, universe, coverage.volume_bounds(universe)).collect()}
    assert got == {(1, 0, 1), (1, 2, 2), (1, 2, 3), (1, 1, 4), (1, 1, 5), (1, 1, 6), (2, 0, 0)}
    gaps = coverage.range_gaps_overlaps(sections.filter("idx != 1"), universe).collect()
    assert [(r.idx, r.gap, r.overlap) for r in gaps] == [(2, 0, 0)]


def terms(spark):
    rows = [("A", 0, "t1", "甲乙", "one", ["甲乙"], ["A"]), ("A", 1, "t2", "乙", "two words", ["乙", "丙"], ["B", "C"]), ("B", 0, "t3", "x", "y", ["甲"], ["Z"])]
    df = spark.createDataFrame(rows, "work string, pos int, id string, xuanzang string, plain string, source_terms array<string>, translation_patterns array<string>")
    return df.withColumns({"sanskrit": F.array(F.lit("s")), "english": F.lit(None).cast("array<string>"), "json": F.concat(F.lit('{"id":"'), "id", F.lit('"}'))})


def test_terms_overlap_in_checks_and_not_in_marks(spark):
    sections = spark.createDataFrame([("A", 1, 0, "s", "x甲乙x", "has A"), ("A", 1, 1, "u", "丙", "has C"), ("A", 1, 2, "v", "甲", "")], "work string, juan int, idx int, title string, source string, translation string")
    assert [(r.idx, r.pos, r.issue) for r in glossary.term_check(sections, terms(spark)).collect()] == [(0, 1, "s: source has 乙 but translation lacks one of B, C")]
    subset = {r.idx: r.glossary for r in glossary.glossary_subset(sections, terms(spark)).collect()}
    assert subset == {0: '[{"id":"t1"}, {"id":"t2"}]', 1: '[{"id":"t2"}]', 2: "[]"}
    tips = glossary.tooltip_terms(terms(spark))
    assert [(r.word, r.tip) for r in tips.filter("work = 'A'").orderBy("rank").collect()] == [("two words", "乙｜two words\n梵 s"), ("one", "甲乙｜one\n梵 s"), ("甲乙", "甲乙｜one\n梵 s")]
    html = spark.createDataFrame([("A", "<p title='one'>one 甲乙</p>"), ("C", "one")], "work string, html string")
    marked = {r.work: r.html for r in glossary.mark_terms(html, tips).collect()}
    span = lambda w: f'<span class="term" tabindex="0" data-tip="甲乙｜one\n梵 s">{w}</span>'
    assert marked == {"A": f"<p title='one'>{span('one')} {span('甲乙')}</p>", "C": "one"}


@pytest.mark.parametrize("limit", [matching.SMALL_GLOSSARIES, 0])
def test_words_of_any_number_are_found_and_marked(spark, monkeypatch, limit):
    """Few words travel to the texts, many are joined: the same rows, and those of plain loops."""
    import random

    monkeypatch.setattr(matching, "SMALL_GLOSSARIES", limit)
    rng = random.Random(6)
    make = lambda n: "".join(rng.choice("ab甲<") for _ in range(n))
    words = {work: {make(rng.randint(1, 5)) for _ in range(12)} for work in "AB"}
    texts = [(rng.choice("ABC"), i, 0, make(rng.randint(0, 40))) for i in range(60)] + [("A", 99, 0, ""), ("A", 98, 0, None)]
    df = spark.createDataFrame(texts, "work string, juan int, idx int, text string")
    given = spark.createDataFrame([(work, w) for work, some in words.items() for w in some] + [("B", "")], "work string, word string")
    hits = {tuple(r) for r in glossary.term_hits(df, "text", given).select("work", "juan", "word").collect()}
    assert hits == {(work, j, w) for work, j, _, t in texts for w in words.get(work, ()) if t and w in t} | {(work, j, "") for work, j, _, t in texts if work == "B"}

    def spans(text, some):
        at = 0
        while at < len(text):
            found = max((w for w in some if len(w) >= 2 and text.startswith(w, at)), key=len, default=None)
            if found:
                yield found
            at += len(found) if found else 1

    tips = given.filter("word != ''").withColumn("tip", F.lit("t"))
    got = {(r.work, r.juan, r.word): r.n for r in glossary.term_mentions(df, tips).collect()}
    want: dict = {}
    for work, juan, _, text in texts:
        for w in spans(text or "", words.get(work, ())):
            want[work, juan, w] = want.get((work, juan, w), 0) + 1
    assert got == want
    html = df.select("work", "juan", F.concat(F.lit("<p a='ab'>"), F.translate("text", "<", "b"), F.lit("</p>")).alias("html"))
    marked = {r.juan: r.html for r in glossary.mark_terms(html, tips.filter("word NOT LIKE '%<%'")).collect()}
    for work, juan, _, text in texts:
        if text is None:
            assert marked[juan] is None
            continue
        plain = text.replace("<", "b")
        out, at = "", 0
        for w in spans(plain, [w for w in words.get(work, ()) if "<" not in w]):
            start = plain.index(w, at)
            out, at = out + plain[at:start] + f'<span class="term" tabindex="0" data-tip="t">{w}</span>', start + len(w)
        assert marked[juan] == f"<p a='ab'>{out}{plain[at:]}</p>"


def test_packing(spark):
    def packed(sizes):
        df = spark.createDataFrame([("W", 1, i, n) for i, n in enumerate(sizes)], "work string, juan int, idx int, n int")
        return [r.batch for r in inference.draft_batches(df, F.col("n")).orderBy("idx").collect()]

    assert packed([1500] * 3) == [0, 0, 1]
    assert packed([5000, 100]) == [0, 1]
    assert packed([1] * 13) == [0] * 12 + [1]
    assert packed([0, 0, 5000]) == [0, 0, 1]


def test_replies(spark):
    raws = ["<<<TRANSLATION\n a\nb \n>>>\n<<<NOTE\n>>>", "<<<TRANSLATION\nx\n>>>", "<<<TRANSLATION\n \n>>>", "<<<TRANSLATION\n<<<y\n>>>", ""]
    assert column(spark, raws, replies.parse_model_blocks) == [("a\nb", "", None), ("x", None, None), (None, None, "no translation block"), (None, None, "nested markers"), (None, None, "no translation block")]
    reviews = column(spark, [" OK ", "<<<TRANSLATION\nx\n>>>\nNEW_TERMS: [1]", "hm"], replies.parse_review_reply)
    assert [(r.verdict, r.translation, r.new_terms) for r in reviews] == [("keep", None, None), ("revise", "x", "[1]"), ("keep", None, None)]
    assert column(spark, ["a <TSV>\nx\ty\n\nz\n</TSV>", "none"], replies.parse_segment_reply) == [["x\ty", "z"], None]


@pytest.mark.parametrize(
    ("message", "want"),
    [
        ("usage limit reached|1751721600", dt.datetime(2025, 7, 5, 13, 20)),
        ('"resets_at":"2026-07-05T21:00:00Z"', dt.datetime(2026, 7, 5, 21)),
        ("2026-07-05T21:00:00+0800", dt.datetime(2026, 7, 5, 13)),
        ("will reset at 2026-07-06 06:10:27", dt.datetime(2026, 7, 6, 6, 10, 27)),
        ("resets 3pm", dt.datetime(2026, 7, 5, 15)),
        ("Try again at 3:45 A.M.", dt.datetime(2026, 7, 6, 3, 45)),
        ("available at 12 am", dt.datetime(2026, 7, 6)),
        ("resets 14:30", dt.datetime(2026, 7, 5, 14, 30)),
        ("resets 09:30", dt.datetime(2026, 7, 6, 9, 30)),
        ("try again in 2 hours 15 minutes", dt.datetime(2026, 7, 5, 14, 15)),
        ("resets in 45 min", dt.datetime(2026, 7, 5, 12, 45)),
        ("no time", None),
    ],
)
def test_reset_times(spark, message, want):
    now = F.lit("2026-07-05 12:00:00").cast("timestamp")
    assert one(spark, message).select(replies.parse_reset_time(F.col("a"), now).cast("timestamp_ntz").alias("r")).first().r == want


def test_outcomes_and_clamping(spark):
    now = F.lit("2026-07-05 12:00:00").cast("timestamp")
    rows = [(0, "Rate limit hit", ""), (1, "x", " boom "), (1, "", ""), (0, " ", ""), (0, " fine ", "")]
    df = spark.createDataFrame(rows, "c int, o string, e string").select(replies.classify_model_output(F.col("c"), F.col("o"), F.col("e"), now).alias("r"))
    assert [(r.r.outcome, r.r.text, r.r.error) for r in df.collect()] == [("limit", None, "Rate limit hit"), ("error", None, "x\n boom"), ("error", None, "exit 1"), ("error", None, "empty output"), ("ok", "fine", None)]
    hours = spark.createDataFrame([(1, 0), (7, 1), (-1, 9), (None, 0)], "h int, n int")
    at = F.when(F.col("h").isNotNull(), now + F.make_dt_interval(F.lit(0), F.col("h")))
    got = hours.select(replies.clamp_resume_time(at, now, F.col("n")).cast("timestamp_ntz").alias("r")).collect()
    assert [(r.r.hour, r.r.minute) for r in got] == [(13, 0), (12, 30), (13, 0), (12, 15)]


def test_drafts_and_splicing(spark):
    schema = "work string, juan int, idx int, title string, source string, translation string, note string"
    sections = spark.createDataFrame([("A", 1, 0, "t", "s", "", "old"), ("A", 1, 1, "u", "s", "kept", "old"), ("A", 2, 0, "v", "s", "", "")], schema)
    draft_a = sections.filter("juan = 1").withColumn("translation", F.expr("if(idx = 0, '', 'a')"))
    merged, wrong = inference.draft_merge_inputs(sections, draft_a, draft_a.limit(0))
    assert [(r.juan, r.idx, r.draft_a, r.draft_b) for r in merged.collect()] == [(1, 0, "（缺稿）", "（缺稿）")]
    assert [(r.juan, r.n, r.n_a) for r in wrong.collect()] == [(2, 1, None)]
    updates = spark.createDataFrame([("A", 1, 0, " new ", None), ("A", 1, 1, "over", ""), ("A", 2, 0, "x", "")], "work string, juan int, idx int, translation string, note string")
    got = lambda **how: [(r.translation, r.note) for r in inference.splice_sections(sections, updates, **how).orderBy("juan", "idx").collect()]
    assert got(keep_note_if_empty=True) == [("new", "old"), ("over", "old"), ("x", "")]
    assert got(keep_note_if_empty=False, keep_text=True) == [("new", "old"), ("kept", "old"), ("x", "")]


def test_a_model_answers_batches(spark):
    prompts = spark.createDataFrame([(i, f"p{i}") for i in range(5)], "batch int, prompt string")
    got = inference.translate_batches(prompts, lambda texts: [t.upper() for t in texts], partitions=2).collect()
    assert sorted(r.reply for r in got) == [f"P{i}" for i in range(5)]


def test_links(spark):
    pages = spark.createDataFrame([("a/b/p.html", '<a href="../x.css?v#f"><!-- <a href="c"> --><script src=\'s.js\'>"<a href=d>"</script><img src="no%20.png"/><a href="#f"><a href="//h/x"><a href="mailto:x"><a href="/r"><a href="..">&<a href="a&amp;b"><a href="">')], "path string, html string")
    links = markup.extract_links(pages)
    assert [r.link for r in links.orderBy("pos").collect()] == ["../x.css?v#f", "s.js", "no%20.png", "#f", "//h/x", "mailto:x", "/r", "..", "a&b"]
    files = spark.createDataFrame([("a/x.css",), ("a/b/no .png",)], "path string")
    assert [r.link for r in publish.broken_links(links, files).orderBy("pos").collect()] == ["s.js", "/r", "a&b"]
    assert column(spark, ["a+b%zz", "x;y/z;w", "%41?q"], publish.local_target) == ["a+b%zz", "x;y/z", "A"]


def test_contents(spark):
    contents = json.dumps([{"title": "a", "juan": 1, "lb": "0001a01", "children": [{"title": "b", "juan": 1, "lb": "0001a03", "children": None}]}, {"title": "c", "juan": 2, "lb": "0002a02", "children": []}])
    flat = markup.flatten_toc(spark.createDataFrame([("W", contents)], "work string, toc string"))
    assert [(r.pre, r.level, r.title, r.ancestors, r.parent_titles) for r in flat.orderBy("pre").collect()] == [(0, 0, "a", [], []), (1, 1, "b", [0], ["a"]), (2, 0, "c", [], [])]
    assert [r.next_lb for r in toc.toc_next_boundary(flat).orderBy("pre").collect()] == ["0002a02", "0002a02", None]
    assert sorted(r.title for r in toc.find_subtree(flat, "a").collect()) == ["a", "b"]
    keys = [(1, 301), (1, 302), (1, 303), (2, 601), (2, 602), (2, 603)]
    lines = spark.createDataFrame([("W", j, k, f"l{k}", "x") for j, k in keys], "work string, juan int, line_key int, line_id string, text string")
    got: dict = {}
    for r in toc.toc_section_slices(flat, lines, bucket=2).orderBy("line_key").collect():
        got.setdefault(r.pre, []).append(r.line_key)
    assert got == {0: [301, 302, 303, 601], 1: [303, 601], 2: [602, 603]}


def test_jobs(spark):
    at = dt.datetime(2026, 1, 1)
    rows = [(1, 1, "held", at), (1, 2, "held", at - dt.timedelta(hours=1)), (2, 1, "held", at), (2, 2, "failed", None), (3, 1, "cancelled", None), (3, 2, "done", None), (4, 1, "failed", None)]
    df = spark.createDataFrame(rows, "job_id long, juan int, state string, resume_at timestamp_ntz")
    got = {r.job_id: (r.state, r.resume_at) for r in jobs.job_rollup(df, df.filter("job_id = 4")).collect()}
    assert got == {1: ("waiting_model", at - dt.timedelta(hours=1)), 2: ("failed", None), 3: ("done", None), 4: ("cancelled", None)}


def test_log_ring_over_micro_batches(spark, tmp_path):
    schema = "job_id long, ts timestamp, seq long, message string"
    folder = str(tmp_path / "log")
    for part in range(3):
        rows = [(1, dt.datetime(2026, 1, 1, part, i), part * 10 + i, f"m{part}{i}") for i in range(4)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    stream = streams.stream_log_tail(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder), 5)
    out: list = []
    stream.writeStream.outputMode("update").foreachBatch(lambda b, _: out.extend(b.collect())).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert out[-1].seqs == [13, 20, 21, 22, 23] and len(out) == 3


def test_a_search_reads_what_its_postings_name(spark, tmp_path):
    rows = [("A", f"title {j}", j, "u", f"text of {j} and more\n" + ("rare" if j == 700 else ""), j % 2, j) for j in range(0, 1000, 5)] + [("B", "rare", 1, "u", "x", 0, 0), ("A", "rare", 3, "u", None, 0, 7), ("A", "rare", 3, "u", None, 0, 7)]
    records = spark.createDataFrame(rows, "work string, t string, j int, u string, x string, part int, idx int")
    path = str(tmp_path / "index")
    publish.write_postings(records, path)
    queries = spark.createDataFrame([("A", " rare "), ("A", "of 5"), ("A", "r"), ("B", "nowhere"), ("A", "d mo")], "work string, q string")
    found = publish.indexed_search(spark, path, queries)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, publish.substring_search(records, queries, ["part", "j", "idx"]).collect()), key=str)
    rare = publish.indexed_search(spark, path, queries.limit(1))
    assert {(r.j, r.work) for r in rare.collect()} == {(700, "A"), (3, "A")}
    import re

    shelves = re.search(r"PartitionFilters: \[[^\]]*shelf#\d+ IN \(([^)]*)\)", rare._jdf.queryExecution().optimizedPlan().toString() + rare._jdf.queryExecution().sparkPlan().toString())[1]
    assert len(shelves.split(",")) == 2 < spark.read.parquet(f"{path}/records").select("shelf").distinct().count()


@pytest.mark.parametrize("scanned", [publish.SCANNED, 0])
def test_a_search_by_scan_and_by_bigrams_finds_the_same(spark, monkeypatch, scanned):
    monkeypatch.setattr(publish, "SCANNED", scanned)
    rows = [("A", "t" if i % 2 else None, i, "u", f"ab {i} 𠀀𠀁\nq{'b' * i}", 0, i) for i in range(40)] + [("B", "ab", 1, "u", None, 1, 1), (None, "ab", 1, "u", "ab", 0, 1)]
    records = spark.createDataFrame(rows, "work string, t string, j int, u string, x string, part int, idx int")
    queries = spark.createDataFrame([("A", " ab\u3000"), ("A", "ab"), ("A", "𠀀𠀁"), ("A", "bbb"), ("A", "b"), ("A", None), ("B", "ab"), ("C", "ab")], "work string, q string")
    found = publish.substring_search(records, queries, ["part", "j", "idx"])
    if scanned:  # no bigrams of whole texts
        assert "regexp_extract_all" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.work, r.q, r["rank"]): (r.j, r.excerpt) for r in found.collect()}
    want = {("A", q, n + 1): (i, f"ab {i} 𠀀𠀁 q{'b' * i}"[max(0, (at := f"ab {i} 𠀀𠀁 q{'b' * i}".index(q)) - 20) : at + 40]) for q, first in (("ab", 0), ("𠀀𠀁", 0), ("bbb", 3)) for n, i in enumerate(range(first, min(40, first + 30)))}
    assert got == want | {("B", "ab", 1): (1, "")}


def test_postings_are_lists_and_a_query_with_many_false_candidates_is_read_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(publish, "TRIED", 1)
    # each bigram of abc is in all records, but abc only in the last ones
    rows = [("A", f"t{i}", 5, "u", "bc 𠀀𠀁 ab" if i < 90 else "abc", 0, i) for i in range(95)] + [("A", "zz", 5, "u", "", 1, 0)]
    records = spark.createDataFrame(rows, "work string, t string, j int, u string, x string, part int, idx int")
    publish.write_postings(records, f"{tmp_path}/index")
    postings = spark.read.parquet(f"{tmp_path}/index/postings")
    assert postings.filter("gram = 'ab'").count() < 10
    queries = spark.createDataFrame([("A", q) for q in ("abc", "ab", "𠀀𠀁", "zz", "t9")], "work string, q string")
    got = sorted(map(tuple, publish.indexed_search(spark, f"{tmp_path}/index", queries, limit=4).collect()))
    assert got == sorted(map(tuple, publish.substring_search(records, queries, ["part", "j", "idx"], limit=4).collect()))
    assert [r[5] for r in got if r[1] == "abc"] == [90, 91, 92, 93]
    monkeypatch.setattr(publish, "_AT_ONCE", 20)
    publish.write_postings(records, f"{tmp_path}/in-parts")
    assert sorted(map(tuple, publish.indexed_search(spark, f"{tmp_path}/in-parts", queries, limit=4).collect())) == got


def test_segments_within_and_across_buckets_are_put_together_once(spark):
    lines = spark.createDataFrame([("A", 1, k, f"l{k}") for k in range(30)] + [("A", 1, 7, ""), ("A", None, 3, "x")], "work string, juan int, line_key int, text string")
    ranges_ = [(1, 2, 4), (2, 2, 4), (2, 2, 4), (3, 8, 12), (4, 0, 29), (5, 9, 3), (6, None, 4), (7, 40, 60), (8, 5, 5)]
    segments = spark.createDataFrame([("A", 1, n, a, b, f"t{n}") for n, a, b in ranges_] + [("B", 1, 1, 0, 5, "none")], "work string, juan int, number int, start_key int, end_key int, title string")
    found = coverage.segment_source_join(lines.repartition(3), segments, bucket=10)
    assert found.columns == [*segments.columns, "source"]
    want = [("A", 1, n, a, b, f"t{n}", "\n".join(f"l{k}" for k in range(30) if a is not None and a <= k <= b)) for n, a, b in ranges_] + [("B", 1, 1, 0, 5, "none", "")]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)


def test_unknown_ends_are_looked_up_without_counting_all_lines(spark):
    sections = spark.createDataFrame([("A", 1, 0, "t", "a", "b"), ("A", 1, 1, "u", "b", "c"), ("B", 1, 0, "v", "a", "a")], "work string, juan int, idx int, title string, start_id string, end_id string")
    universe = spark.createDataFrame([("A", 1, x) for x in "aabb"], "work string, juan int, line_id string")
    found = coverage.line_membership_check(sections, universe)
    assert sorted(map(tuple, found.collect())) == [("A", 1, 1, "u", "c"), ("B", 1, 0, "v", "a"), ("B", 1, 0, "v", "a")]
    assert "Aggregate" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_repair_targets_take_the_issues_once(spark):
    rows = [("A", 1, "terms", i, 0, f" t{i % 3} : b{i:02}") for i in range(12)] + [("A", 1, "coverage", 9, 1, "first"), ("B", 2, "coverage", 0, 2, "last")]
    issues = spark.createDataFrame(rows, "work string, juan int, source string, idx int, rule_no int, issue string")
    found = inference.repair_targets(issues)
    assert {r.work: (r.titles, r.hint) for r in found.collect()} == {"A": (["t0", "t1", "t2"], "；".join(["first", *(f" t{i % 3} : b{i:02}" for i in range(9))])), "B": ([], "last")}
    assert found._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1


def test_a_search_index_is_written_compressed(spark, tmp_path):
    records = spark.createDataFrame([("A", f"t{i}", i, "u", "多字\n" * 200) for i in range(50)] + [("B", "t", 1, "u", None)], "work string, t string, j int, u string, x string")
    volumes.write_search_index(records, f"{tmp_path}/index")
    files = list((tmp_path / "index").rglob("part-*"))
    assert files and all(f.name.endswith(".json.gz") for f in files) and sum(f.stat().st_size for f in files) < 10_000
    back = spark.read.schema("t string, j int, u string, x string, work string").json(f"{tmp_path}/index")
    assert sorted(map(str, back.select(records.columns).collect())) == sorted(map(str, records.collect()))


def test_packing_over_blocks(spark, monkeypatch):
    import random

    monkeypatch.setattr(inference, "BLOCK", 4)
    rng = random.Random(5)
    rows, want = [], {}
    for juan in range(40):
        numbers = sorted(rng.sample(range(200), rng.randint(1, 90)))  # with gaps
        count = size = chars = batch = 0
        for idx in numbers:
            s = rng.choice([0, 1, 50, 400, 900, 3000, 5000] if juan % 2 else [0, 1, 2])
            o = int(s * 1.9 + 0.999)
            if count and (count >= 12 or size + s > 4200 or chars + o > 8000):
                count = size = chars = 0
                batch += 1
            count, size, chars = count + 1, size + s, chars + o
            rows.append(("W", juan, idx, s))
            want[juan, idx] = batch
    df = spark.createDataFrame(rows, "work string, juan int, idx int, n int").repartition(5)
    got = {(r.juan, r.idx): r.batch for r in inference.draft_batches(df, F.col("n")).collect()}
    assert got == want
    assert inference.draft_batches(df.limit(0), F.col("n")).collect() == []


def test_rows_that_cannot_be_read_become_errors(spark):
    now = dt.datetime(2026, 1, 1)
    texts = spark.createDataFrame([("try again in 99999999999 hours", now), ("try again in 2 hours", now), (None, now)], "t string, n timestamp")
    got = [r.at for r in texts.select(replies.parse_reset_time(F.col("t"), F.col("n")).cast("string").alias("at")).collect()]
    assert got == [None, "2026-01-01 02:00:00", None]
    long = spark.createDataFrame([("try again in 1000000 hours", now), ("resets in 0000002 h 1234567 minutes", now), ("retry in " + "9" * 40 + " hours", now), ("try again in 00 hours", now)], "t string, n timestamp")
    waits = [r.at for r in long.select(replies.parse_reset_time(F.col("t"), F.col("n")).cast("string").alias("at")).collect()]
    assert waits == [str(now + dt.timedelta(hours=1_000_000)), str(now + dt.timedelta(hours=2, minutes=1_234_567)), None, None]
    specs = spark.createDataFrame([(1, "13-15,20, 14"), (2, "5-3"), (3, "x,2"), (4, None), (5, "1-250000"), (6, "7,7"), (6, "8")], "k int, spec string")
    found = jobs.spec_volumes(specs, "spec").groupBy("k").agg(F.count("juan").alias("n"), F.min("juan").alias("a"), F.max("juan").alias("b"), F.max("error").alias("e")).orderBy("k").collect()
    assert [tuple(r) for r in found] == [(1, 4, 13, 20, None), (2, 0, None, None, "no volumes"), (3, 0, None, None, "invalid volume number: x"), (4, 0, None, None, "no volumes"), (5, 250000, 1, 250000, None), (6, 2, 7, 8, None)]
    raw = "<<<SECTION 99999999999>>>\n<<<TRANSLATION\nx\n>>>\n<<<END_SECTION 99999999999>>>\n<<<SECTION 1>>>\n<<<TRANSLATION\ny\n>>>\n<<<END_SECTION 1>>>"
    batch = spark.createDataFrame([("b", raw, [1])], "batch_id string, raw string, expected array<int>")
    assert [(r.number, r.translation, r.error) for r in inference.parse_batch_replies(batch).collect()] == [(None, "x", "no section number"), (1, "y", None)]
    assert inference.batch_reply_check(batch).first().accepted
    tocs = [("ok", '[{"title": "a", "juan": "1", "lb": "0001a01", "children": null}]'), ("no json", "{"), ("no juan", '[{"title": "a"}]'), ("no number", '[{"title": "a", "juan": "x", "lb": ""}]'), ("null", None), ("number", "3")]
    rows = {r.work: r for r in markup.flatten_toc(spark.createDataFrame(tocs, "work string, toc string")).collect()}
    assert len(rows) == 6 and [w for w in rows if rows[w].error is None] == ["ok"] and rows["ok"].juan == 1 and rows["null"].pre is None
    assert column(spark, ["1-2000000000", "-2147483648-2147483647"], text.expand_volume_spec) == [None, None]
    assert column(spark, ["a&lt;b &#x6F22;&#233;&eacute;&nope; &amp;lt; &#99999999999;", None, "&"], text.unescaped) == ["a<b 漢éé&nope; &lt; �", None, "&"]


def plain_lines(html):
    """The rule for lines in html, piece by piece."""
    import re
    from html import unescape

    whole = re.compile(ranges.LOOSE)
    cut = [i for i in map(html.find, ("<div class='footnote'", '<div class="footnote"', "<div id='cbeta-copyright'", '<div id="cbeta-copyright"')) if i >= 0]
    depth, here, before, out = 0, None, None, {}
    for piece in re.findall(r"<!--.*?-->|<[^>]*>|[^<]+|<", html[: min(cut, default=len(html))], re.S):
        start = re.match(r"<([A-Za-z][^\s/>]*)", piece)
        if start:
            given = {k.lower(): unescape(a or b or c) for k, a, b, c in re.findall(r"""[\s"']([\w-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", piece)}
            kinds, tag = given.get("class", "").split(), start[1].lower()
            if tag in ("a", "span") and {"lb", "lineInfo"} & set(kinds):
                depth += 1
                if whole.fullmatch(given.get("id", "")):
                    here, before = given["id"], given["id"].split("_p")[0]
            elif tag == "span" and "t" in kinds and given.get("l") and before:
                here = f"{before}_p{given['l']}"
            if here:
                out.setdefault(here, "")
        if piece.startswith("</") or (start and piece.endswith("/>")):
            depth = max(0, depth - 1)
        text = unescape(piece).strip()
        if not piece.startswith("<") and here and not depth and text and not whole.fullmatch(text):
            out[here] += text
    return {k: v.strip() for k, v in out.items()}


@pytest.mark.parametrize("block", [1, 5, 4096])
def test_lines_of_html_against_a_plain_walk(spark, monkeypatch, block):
    import random

    monkeypatch.setattr(markup, "BLOCK_PIECES", block)

    rng = random.Random(4)
    pieces = ["<span class='lb' id='A_p0001a0{}'>", '<a class="x lineInfo" id="A_p0001b0{}">', "<a class='lb' id='bad'/>", "</span>", "</a>", "</b>", "<b>", "<br/>", "<span class='t' l='0001c0{}'>", "<span class='t'>", " text{} ", "A_p0001a0{}", "&lt;{}&#x6F22;", "<!-- c{} -->", "<p>", "　", "<span class='pc'>", "x"]
    rows = [("A", i, "".join(rng.choice(pieces).format(rng.randint(1, 5)) for _ in range(rng.randint(0, 60)))) for i in range(60)] + [("A", 60, None), ("A", 61, "")]
    got = {}
    for r in markup.extract_lines(spark.createDataFrame(rows, "work string, juan int, html string").repartition(3)).collect():
        got.setdefault(r.juan, {})[r.line_id] = r.text
    assert got == {i: lines for _, i, html in rows if (lines := plain_lines(html or ""))}


def test_sections_with_marks_in_their_texts(spark):
    import re

    value = "# t\n## 01 a\nRange: A1n1_p0001a01\n\nSource:\n<<<\n## not a title?\nx\n>>>\n\nTranslation:\n<<<\na > b >>> c\n>>>\n\nNote:\n<<<\n#1\n>>>\n\n## 02 b\nRange: A1n1_p0001a02\n\nSource:\n<<<\n>>>\n\n>>>\n\nTranslation:\n<<<\n\n>>>\n"
    got = volumes.parse_sections(spark.createDataFrame([("A", 1, value)], "work string, juan int, value string")).orderBy("idx").collect()
    want = []
    for i, part in enumerate(re.split(r"(?m)^##\s+", value)[1:]):
        block = lambda name, part=part: (m := re.search(rf"{name}:\n<<<\n(.*?)\n>>>", part.split("\n", 1)[-1], re.S)) and m[1].strip()
        want.append((i, part.split("\n")[0].strip(), block("Source"), block("Translation"), block("Note") or ""))
    assert [(r.idx, r.title, r.source, r.translation, r.note) for r in got] == want
    assert [r.error is None for r in got] == [False, False, True]
