"""Queries over packing, prompts, replies and drafts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import replies as r
from ..operators import glossary as g
from ..operators import inference as inf
from ..sources.shared import written
from . import bindings as b
from . import oracle as o
from .registry import query


@query("""WITH RECURSIVE i AS (SELECT l_orderkey AS juan, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS k, CAST(l_quantity * 60 AS BIGINT) AS s FROM lineitem),
x AS (SELECT juan, k, s, CAST(floor(s * 1.9::DOUBLE + 0.999::DOUBLE) AS BIGINT) AS o FROM i),
p AS (SELECT juan, k, s, o, CAST(1 AS BIGINT) AS n, CAST(0 AS BIGINT) AS batch FROM x WHERE k = 1
UNION ALL SELECT x.juan, x.k, CASE WHEN p.n >= 12 OR p.s + x.s > 4200 OR p.o + x.o > 8000 THEN x.s ELSE p.s + x.s END,
 CASE WHEN p.n >= 12 OR p.s + x.s > 4200 OR p.o + x.o > 8000 THEN x.o ELSE p.o + x.o END,
 CASE WHEN p.n >= 12 OR p.s + x.s > 4200 OR p.o + x.o > 8000 THEN 1 ELSE p.n + 1 END,
 CASE WHEN p.n >= 12 OR p.s + x.s > 4200 OR p.o + x.o > 8000 THEN p.batch + 1 ELSE p.batch END FROM p JOIN x ON x.juan = p.juan AND x.k = p.k + 1)
SELECT juan, CAST(k - 1 AS INTEGER) AS idx, batch FROM p""")
def draft_batches(spark, sf_dir):
    items = b.table(spark, sf_dir, "lineitem").withColumn("chars", (F.col("l_quantity") * 60).cast("long"))
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "chars")
    listed = items.groupBy(F.col("l_orderkey").alias("juan")).agg(F.array_sort(F.collect_list(order)).alias("list"))
    numbered = listed.select(F.lit("W").alias("work"), "juan", F.posexplode("list").alias("idx", "x")).select("work", "juan", "idx", "x.chars")
    return inf.draft_batches(numbered, F.col("chars")).select("juan", "idx", "batch")


_RAW = "CASE turn % 6 WHEN 0 THEN '<<<TRANSLATION' || chr(10) || ' ' || text || chr(10) || '>>>' || chr(10) || '<<<NOTE' || chr(10) || 'n' || chr(10) || '>>>' WHEN 1 THEN '<<<TRANSLATION' || chr(10) || text || '>>>' WHEN 2 THEN '<<<TRANSLATION' || chr(10) || '  ' || chr(10) || '>>>' WHEN 3 THEN text WHEN 4 THEN '<<<TRANSLATION' || chr(10) || 'a <<<b' || chr(10) || '>>>' ELSE ' OK' || chr(10) END"
_TEXT_TRIM = "regexp_replace(text, '^\\s+|\\s+$', '', 'g')"


def _raw(spark, sf_dir):
    return b.table(spark, sf_dir, "conversations").withColumn("raw", F.expr(_RAW))


@query(f"SELECT conv_id, turn, CASE WHEN turn % 6 < 2 THEN {_TEXT_TRIM} END AS translation, CASE turn % 6 WHEN 0 THEN 'n' END AS note, CASE WHEN turn % 6 IN (2, 3, 5) THEN 'no translation block' WHEN turn % 6 = 4 THEN 'nested markers' END AS error FROM conversations")
def parse_model_blocks(spark, sf_dir):
    return _raw(spark, sf_dir).select("conv_id", "turn", r.parse_model_blocks(F.col("raw")).alias("p")).select("conv_id", "turn", "p.*")


@query(f"SELECT conv_id, turn, CASE WHEN turn % 6 IN (0, 1, 2, 4) THEN 'revise' ELSE 'keep' END AS verdict, CASE WHEN turn % 6 < 2 THEN {_TEXT_TRIM} END AS translation, CASE turn % 6 WHEN 0 THEN 'n' END AS note, CASE WHEN turn % 6 = 2 THEN 'no translation block' WHEN turn % 6 = 4 THEN 'nested markers' END AS error, CASE WHEN conv_id % 2 = 0 THEN '[{{\"id\":' || turn || '}}]' END AS new_terms FROM conversations")
def parse_review_reply(spark, sf_dir):
    raw = _raw(spark, sf_dir).withColumn("raw", F.when(F.col("conv_id") % 2 == 0, F.concat("raw", F.lit('\nNEW_TERMS: [{"id":'), F.col("turn").cast("string"), F.lit("}]  "))).otherwise(F.col("raw")))
    return raw.select("conv_id", "turn", r.parse_review_reply(F.col("raw")).alias("p")).select("conv_id", "turn", "p.*")


@query("SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') END AS rows FROM conversations")
def parse_segment_reply(spark, sf_dir):
    raw = F.when(F.col("turn") % 2 == 0, F.concat(F.lit("x <TSV>\n"), "text", F.lit("\n</TSV> y"))).otherwise(F.col("text"))
    return b.table(spark, sf_dir, "conversations").select("conv_id", "turn", r.parse_segment_reply(raw).alias("rows"))


_EVENT_TEXT = "CASE event_type WHEN 'error' THEN 'Usage limit reached|17' || lpad(CAST(event_id % 100000000 AS STRING), 8, '0') WHEN 'click' THEN 'rate-limit, try again in 2 hours 15 minutes' WHEN 'view' THEN ' fine ' WHEN 'signup' THEN 'quota: resets at 3:45 PM.' ELSE '' END"


@query("""WITH e AS (SELECT *, CAST(event_id % 3 AS INTEGER) AS code FROM events) SELECT event_id,
CASE WHEN event_type IN ('error', 'click', 'signup') THEN 'limit' WHEN code <> 0 OR event_type = 'purchase' THEN 'error' ELSE 'ok' END AS outcome,
CASE WHEN event_type = 'view' AND code = 0 THEN 'fine' END AS text,
CASE event_type WHEN 'error' THEN 'Usage limit reached|17' || lpad(CAST(event_id % 100000000 AS VARCHAR), 8, '0') WHEN 'click' THEN 'rate-limit, try again in 2 hours 15 minutes' WHEN 'signup' THEN 'quota: resets at 3:45 PM.'
 WHEN 'view' THEN CASE WHEN code <> 0 THEN 'fine' END ELSE CASE WHEN code <> 0 THEN 'exit ' || code ELSE 'empty output' END END AS error FROM e""")
def classify_model_output(spark, sf_dir):
    events = b.table(spark, sf_dir, "events").withColumn("code", (F.col("event_id") % 3).cast("int"))
    found = r.classify_model_output(F.col("code"), F.expr(_EVENT_TEXT), F.lit(""), F.col("ts"))
    return events.select("event_id", found.alias("p")).select("event_id", "p.outcome", "p.text", "p.error")


_RESET = """CASE event_id % 5 WHEN 0 THEN concat('limit reached|17', lpad(event_id % 100000000, 8, '0')) WHEN 1 THEN 'try again in 2 hours 15 minutes' WHEN 2 THEN 'will reset at 2026-07-06 06:10:27'
    WHEN 3 THEN 'resets 14:30' ELSE 'nothing' END"""


@query("""SELECT event_id, CASE event_id % 5 WHEN 0 THEN to_timestamp(1700000000 + event_id % 100000000)::TIMESTAMP WHEN 1 THEN ts + INTERVAL 135 MINUTE WHEN 2 THEN TIMESTAMP '2026-07-06 06:10:27'
WHEN 3 THEN date_trunc('day', ts) + INTERVAL 870 MINUTE + CASE WHEN date_trunc('day', ts) + INTERVAL 870 MINUTE <= ts THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END END AS resume_at FROM events""")
def parse_reset_time(spark, sf_dir):
    return b.table(spark, sf_dir, "events").select("event_id", r.parse_reset_time(F.expr(_RESET), F.col("ts")).cast("timestamp_ntz").alias("resume_at"))


@query("""SELECT event_id, CASE WHEN floor(value * 60) > 0 AND value <= 6 THEN ts + to_minutes(CAST(floor(value * 60) AS BIGINT)) ELSE ts + to_minutes(CAST([15, 30, 45, 60][least(event_id % 6, 3) + 1] AS BIGINT)) END AS resume_at FROM events""")
def clamp_resume_time(spark, sf_dir):
    events = b.table(spark, sf_dir, "events")
    at = F.expr("ts + make_dt_interval(0, 0, int(floor(value * 60)))")
    asked = F.when(F.col("value") <= 6, at).otherwise(F.expr("ts + interval 7 hours"))
    return events.select("event_id", r.clamp_resume_time(asked, F.col("ts"), (F.col("event_id") % 6).cast("int")).cast("timestamp_ntz").alias("resume_at"))


def _draft_sections(spark, sf_dir):
    return b.drafts(spark, sf_dir).select("work", "juan", "idx", F.concat(F.lit("T"), F.col("idx").cast("string")).alias("title"), "source", F.when(F.col("idx") % 4 == 2, "done").otherwise("").alias("translation"), F.lit("").alias("note"), "draft")


@query(o.DRAFTS_SQL + ", f AS (SELECT juan FROM drafts GROUP BY juan) SELECT d.work, d.juan, d.idx, d.source, coalesce(nullif(d.draft, ''), '（缺稿）') AS draft_a, coalesce(nullif(CASE WHEN d.juan % 3 = 0 THEN translate(d.draft, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') ELSE d.draft END, ''), '（缺稿）') AS draft_b FROM drafts d WHERE d.idx % 4 <> 2")
def draft_merge_inputs(spark, sf_dir):
    """Draft B exists for a third of the volumes; sections with text are settled."""
    sections = _draft_sections(spark, sf_dir)
    a = sections.select("work", "juan", "idx", F.col("draft").alias("translation"))
    second = a.filter("juan % 3 = 0").withColumn("translation", b.capitals("translation"))
    return inf.draft_merge_inputs(sections, a, second)[0].select("work", "juan", "idx", "source", "draft_a", "draft_b")


@query(o.DRAFTS_SQL + "SELECT work, juan, idx, CASE WHEN idx % 4 = 2 THEN 'done' WHEN juan % 2 = 0 THEN regexp_replace(draft, '^\\s+|\\s+$', '', 'g') ELSE '' END AS translation, CASE WHEN idx % 4 <> 2 AND juan % 4 = 0 THEN 'n' ELSE 'old' END AS note FROM drafts")
def splice_sections(spark, sf_dir):
    sections = _draft_sections(spark, sf_dir).withColumn("note", F.lit("old"))
    note = F.expr("CASE juan % 4 WHEN 0 THEN 'n' WHEN 2 THEN '' END")
    updates = sections.filter("juan % 2 = 0").select("work", "juan", "idx", F.col("draft").alias("translation"), note.alias("note"))
    return inf.splice_sections(sections, updates, keep_note_if_empty=True, keep_text=True).select("work", "juan", "idx", "translation", "note")


def _subsets(spark, sf_dir, sections):
    """The glossary subset of each section, with its terms' JSON."""
    return g.glossary_subset(sections, written(b.draft_terms(spark, sf_dir)))


_SUBSETS = """, begun AS (SELECT DISTINCT substr(w, 1, 5) AS w FROM (SELECT unnest(regexp_split_to_array(lower(text), '[\\s.,]+')) AS w FROM benchmark WHERE item_id % 4 = 0) WHERE length(w) >= 8),
subsets AS (SELECT d.juan, d.idx, '[' || coalesce(string_agg('{"id":' || to_json(w) || ',"status":"ok"}', ', ' ORDER BY w), '') || ']' AS glossary FROM drafts d LEFT JOIN begun ON contains(d.source, w) GROUP BY d.juan, d.idx) """


@query(o.DRAFTS_SQL + _SUBSETS + "SELECT work, d.juan, d.idx, 'W C V ' || d.juan || ' [T' || d.idx || '] （無）: ' || source || ' / ' || glossary AS prompt FROM drafts d JOIN subsets s ON s.juan = d.juan AND s.idx = d.idx")
def build_section_prompts(spark, sf_dir):
    sections = _draft_sections(spark, sf_dir)
    return inf.build_section_prompts(sections, _subsets(spark, sf_dir, sections), "W $work V $juan [$title] $note: $source / $glossary")


def _batches(spark, sf_dir):
    sections = _draft_sections(spark, sf_dir)
    batches = inf.draft_batches(sections, F.char_length("source"))
    return sections, batches, inf.build_batch_prompts(sections, batches, _subsets(spark, sf_dir, sections))


_OPENS = "p.n >= 12 OR p.s + x.s > 4200 OR p.o + x.o > 8000"
_PACKED = o.DRAFTS_SQL.replace("WITH", "WITH RECURSIVE", 1) + f""", x AS (SELECT juan, idx, source, row_number() OVER (PARTITION BY juan ORDER BY idx) AS k, CAST(length(source) AS BIGINT) AS s, CAST(floor(length(source) * 1.9::DOUBLE + 0.999::DOUBLE) AS BIGINT) AS o FROM drafts),
p AS (SELECT juan, idx, k, s, o, CAST(1 AS BIGINT) AS n, CAST(0 AS BIGINT) AS batch FROM x WHERE k = 1
UNION ALL SELECT x.juan, x.idx, x.k, CASE WHEN {_OPENS} THEN x.s ELSE p.s + x.s END, CASE WHEN {_OPENS} THEN x.o ELSE p.o + x.o END, CASE WHEN {_OPENS} THEN 1 ELSE p.n + 1 END, CASE WHEN {_OPENS} THEN p.batch + 1 ELSE p.batch END
 FROM p JOIN x ON x.juan = p.juan AND x.k = p.k + 1) """


@query(_PACKED + _SUBSETS + """SELECT 'C' AS work, p.juan, batch, string_agg('<<<SOURCE_SECTION ' || (p.idx + 1) || '>>>' || chr(10) || 'Title: T' || p.idx || chr(10) || 'Existing note: （無）' || chr(10) || 'Glossary JSON:' || chr(10) || s.glossary || chr(10) || 'Source:' || chr(10) || x.source || chr(10) || '<<<END_SOURCE_SECTION ' || (p.idx + 1) || '>>>', chr(10) || chr(10) ORDER BY p.idx) AS prompt
FROM p JOIN x ON x.juan = p.juan AND x.idx = p.idx JOIN subsets s ON s.juan = p.juan AND s.idx = p.idx GROUP BY p.juan, batch""")
def build_batch_prompts(spark, sf_dir):
    return _batches(spark, sf_dir)[2].select("work", "juan", "batch", "prompt")


@query(o.DRAFTS_SQL + "SELECT juan, CAST(idx + 1 AS INTEGER) AS number, regexp_replace(source, '^\\s+|\\s+$', '', 'g') AS translation FROM drafts WHERE trim(source) <> ''")
def translate_batches(spark, sf_dir):
    """The echo's replies to all batches, read section by section."""
    prompts = _batches(spark, sf_dir)[2]
    replies = inf.translate_batches(prompts).select(F.struct("juan", "batch").alias("batch_id"), F.col("reply").alias("raw"), F.array().cast("array<int>").alias("expected"))
    return inf.parse_batch_replies(replies).filter("error IS NULL").select("batch_id.juan", "number", "translation")


@query("""WITH t AS (SELECT conv_id, CAST(turn + 1 AS INTEGER) AS number, CAST((conv_id + turn) % 7 AS INTEGER) AS k FROM conversations), n AS (SELECT DISTINCT conv_id, number, k FROM t)
SELECT conv_id AS batch_id, count(*) FILTER (WHERE k IN (1, 2, 3)) = 0 AS accepted, list_sort(coalesce(list(number) FILTER (WHERE k = 1), []::INTEGER[])) AS duplicates, list_sort(coalesce(list(number) FILTER (WHERE k = 2), []::INTEGER[])) AS missing, list_sort(coalesce(list(number) FILTER (WHERE k = 3), []::INTEGER[])) AS bad FROM n GROUP BY conv_id""")
def batch_reply_check(spark, sf_dir):
    """A reply per conversation, with a section for each of its turns; some turns come twice, not at all or without a block, and some with a number that nobody asked for."""
    turns = b.table(spark, sf_dir, "conversations").select("conv_id", "turn", "text", ((F.col("conv_id") + F.col("turn")) % 7).alias("k")).dropDuplicates(["conv_id", "turn"])
    section = lambda n, body: F.concat(F.lit("<<<SECTION "), n.cast("string"), F.lit(">>>\n"), body, F.lit("\n<<<END_SECTION "), n.cast("string"), F.lit(">>>\n"))
    number = F.col("turn") + 1
    good = section(number, F.concat(F.lit("<<<TRANSLATION\nx "), F.translate("text", "<>", "()"), F.lit("\n>>>")))
    k = F.col("k")
    part = F.when(k == 1, F.concat(good, good)).when(k == 2, "").when(k == 3, section(number, F.lit("none"))).when(k == 4, F.concat(good, section(number + 100_000, F.lit("?")))).otherwise(good)
    listed = turns.groupBy(F.col("conv_id").alias("batch_id")).agg(F.array_sort(F.collect_list(F.struct("turn", part.alias("part")))).alias("l"))
    replies = listed.select("batch_id", F.array_join("l.part", "").alias("raw"), F.transform("l.turn", lambda t: (t + 1).cast("int")).alias("expected"))
    return inf.batch_reply_check(replies)


@query(o.LINES_SQL + """, o AS (SELECT *, row_number() OVER (PARTITION BY work, juan ORDER BY line_key) AS r, count(*) OVER (PARTITION BY work, juan) AS c FROM lines WHERE text <> '')
SELECT work, juan, string_agg(line_id || chr(9) || text, chr(10) ORDER BY line_key) AS lines, max(line_id) FILTER (WHERE r = 1) || '-p' || max(right(line_id, 7)) FILTER (WHERE r = least(4, c)) AS range_example FROM o GROUP BY work, juan""")
def build_segment_prompts(spark, sf_dir):
    return inf.build_segment_prompts(b.lines(spark, sf_dir))
