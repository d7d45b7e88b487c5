"""Queries over glossaries and their terms."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.text import html_escaped
from ..operators import glossary as g
from ..operators import inference as inf
from ..sources import volumes as vol
from ..sources.shared import written
from . import bindings as b
from . import oracle as o
from .corpus import ISSUES
from .registry import query

_HITS = ", hits AS (SELECT s.work, s.juan, s.idx, s.title, s.source, s.translation, t.pos, t.id, t.pattern FROM sections s JOIN terms t ON t.work = s.work AND contains(s.source, t.id))"


def _texts(spark, sf_dir, column):
    return b.sections(spark, sf_dir).select("work", "juan", "idx", column)


@query(o.TERMS_SQL + _HITS + " SELECT work, juan, CAST(idx AS INTEGER) AS idx, pos, title, title || ': source has ' || id || ' but translation lacks one of ' || pattern AS issue FROM hits WHERE NOT contains(translation, pattern)")
def term_check(spark, sf_dir):
    return g.term_check(written(b.sections(spark, sf_dir)), written(b.terms(spark, sf_dir)))


@query(o.TERMS_SQL + _HITS + ", subset AS (SELECT work, juan, idx, string_agg(id, ',' ORDER BY pos) AS ids FROM hits GROUP BY work, juan, idx) SELECT s.work, s.juan, CAST(s.idx AS INTEGER) AS idx, coalesce(ids, '') AS ids FROM sections s LEFT JOIN subset h ON h.work = s.work AND h.juan = s.juan AND h.idx = s.idx")
def glossary_subset(spark, sf_dir):
    """The ids in each section's JSON subset, in order."""
    subset = g.glossary_subset(written(b.sections(spark, sf_dir)), written(b.terms(spark, sf_dir)))
    ids = F.transform(F.variant_get(F.parse_json("glossary"), "$", "array<variant>"), lambda t: F.variant_get(t, "$.id", "string"))
    return subset.select("work", "juan", "idx", F.array_join(ids, ",").alias("ids"))


def _files(spark, sf_dir, keep="true"):
    """work, value: the glossary of each work as the text of its file; works whose number is divisible by 3 have none."""
    terms = b.terms(spark, sf_dir).filter(keep)
    listed = terms.groupBy("work").agg(F.array_sort(F.collect_list(F.struct("pos", "json"))).alias("t"))
    return listed.filter(r"int(regexp_extract(work, '(\\d+)$', 1)) % 3 > 0").select("work", F.concat(F.lit('{"terms":['), F.array_join("t.json", ","), F.lit("]}")).alias("value"))


def _works(spark, sf_dir):
    return b.table(spark, sf_dir, "documents").select(F.col("source").alias("work")).distinct()


_NUMBERED = "WITH " + o.TERMS + ", numbered AS (SELECT work, CAST(regexp_extract(work, '([0-9]+)$', 1) AS INTEGER) AS number FROM works)"


@query(_NUMBERED + " SELECT n.work, CAST(count(t.id) AS INTEGER) AS n_terms, string_agg(t.id, ',' ORDER BY t.pos) AS ids FROM numbered n LEFT JOIN terms t ON t.work = n.work AND number % 3 > 0 GROUP BY n.work")
def read_glossary(spark, sf_dir):
    """The terms of each work's glossary file; a third of the works have no file, and so no terms."""
    found = vol.read_glossary(_works(spark, sf_dir), _files(spark, sf_dir))
    terms = F.variant_get("glossary", "$.terms", "array<variant>")
    ids = F.array_join(F.transform(terms, lambda t: F.variant_get(t, "$.id", "string")), ",")
    return found.select("work", F.size(terms).alias("n_terms"), F.nullif(ids, F.lit("")).alias("ids"))


@query(_NUMBERED + """, t AS (SELECT work, pos, CASE WHEN pos % 13 = 5 THEN lag(id) OVER (PARTITION BY work ORDER BY pos) ELSE id END AS id FROM terms JOIN numbered USING (work) WHERE number % 3 > 0),
whole AS (SELECT *, row_number() OVER (PARTITION BY work, id ORDER BY pos) AS nth FROM t WHERE pos % 11 <> 3 AND pos % 23 <> 8)
SELECT work, CAST(0 AS INTEGER) AS pos, CAST(0 AS INTEGER) AS rule_no, 'Glossary must contain a non-empty terms list' AS issue FROM numbered WHERE number % 3 = 0
UNION ALL SELECT work, pos, 1, 'Each term must be an object' FROM t WHERE pos % 23 = 8
UNION ALL SELECT work, pos, 2, id || ' missing fields: plain, rule' FROM t WHERE pos % 11 = 3 AND pos % 23 <> 8
UNION ALL SELECT work, pos, 3, 'Duplicate term id: ' || id FROM whole WHERE nth > 1
UNION ALL SELECT work, pos, 4, id || ' field source_terms must be a list of strings' FROM whole WHERE pos % 17 = 6
UNION ALL SELECT work, pos, 5, id || ' field translation_patterns must not be empty' FROM whole WHERE pos % 19 = 7""")
def validate_glossary(spark, sf_dir):
    """Glossaries of all works, where by their places some terms repeat the id before, lack fields, are no objects, or have lists that are wrong or empty."""
    given = b.terms(spark, sf_dir).select("work", "pos", F.when(F.col("pos") % 13 == 5, F.lag("id").over(Window.partitionBy("work").orderBy("pos"))).otherwise(F.col("id")).alias("id"), "source_terms", "translation_patterns")
    mixed = F.when(F.col("pos") % 17 == 6, F.parse_json(F.lit('["s", 1]'))).otherwise(F.parse_json(F.to_json("source_terms")))
    patterns = F.when(F.col("pos") % 19 == 7, F.array().cast("array<string>")).otherwise(F.col("translation_patterns"))
    some = ["id", F.col("id").alias("xuanzang"), F.col("id").alias("display"), F.lit("ok").alias("status"), mixed.alias("source_terms"), patterns.alias("translation_patterns")]
    term = F.when(F.col("pos") % 23 == 8, F.to_json(F.array("id"))).when(F.col("pos") % 11 == 3, F.to_json(F.struct(*some))).otherwise(F.to_json(F.struct(*some, F.lit("").alias("plain"), F.lit("").alias("rule"))))
    listed = given.withColumn("term", term).groupBy("work").agg(F.array_sort(F.collect_list(F.struct("pos", "term"))).alias("t"))
    files = listed.filter(r"int(regexp_extract(work, '(\\d+)$', 1)) % 3 > 0").select("work", F.concat(F.lit('{"terms":['), F.array_join("t.term", ","), F.lit("]}")).alias("value"))
    return g.validate_glossary(written(vol.read_glossary(_works(spark, sf_dir), files)))


@query(_NUMBERED + """, old AS (SELECT work, pos, id FROM terms JOIN numbered USING (work) WHERE pos % 2 = 0 AND number % 3 > 0),
new AS (SELECT work, pos, id FROM terms t JOIN numbered USING (work) WHERE pos % 3 = 0 AND number % 5 > 0 AND NOT EXISTS (SELECT 1 FROM old WHERE old.work = t.work AND old.id = t.id)),
joint AS (SELECT work, 0 AS part, pos, id FROM old UNION ALL SELECT work, 1, pos, id FROM new)
SELECT n.work, CAST(count(b.id) FILTER (WHERE part = 1) AS INTEGER) AS n_added, coalesce(string_agg(b.id, ',' ORDER BY part, b.pos), '') AS ids FROM numbered n LEFT JOIN joint b ON b.work = n.work GROUP BY n.work""")
def merge_new_terms(spark, sf_dir):
    """Every third term proposed to glossaries that hold every second one; the proposals to a fifth of the works are no list, or have a term without fields."""
    glossaries = written(vol.read_glossary(_works(spark, sf_dir), _files(spark, sf_dir, keep="pos % 2 = 0")))
    listed = b.terms(spark, sf_dir).filter("pos % 3 = 0").groupBy("work").agg(F.array_sort(F.collect_list(F.struct("pos", "json"))).alias("t"))
    number = F.regexp_extract("work", r"(\d+)$", 1).cast("int")
    whole = F.array_join("t.json", ",")
    raw = F.when(number % 5 > 0, F.concat(F.lit("["), whole, F.lit("]"))).when(number % 2 == 0, F.concat(F.lit('{"terms":['), whole, F.lit("]}"))).otherwise(F.concat(F.lit("["), whole, F.lit(',{"id":"lone"}]')))
    merged = g.merge_new_terms(glossaries, written(listed.select("work", raw.alias("raw"))))
    ids = F.transform(F.variant_get(F.parse_json("value"), "$.terms", "array<variant>"), lambda t: F.variant_get(t, "$.id", "string"))
    return merged.select("work", "n_added", F.array_join(ids, ",").alias("ids"))


@query(o.TERMS_SQL + """, tip_words AS (SELECT work, id AS word, id || '｜plain ' || id AS tip, pos FROM terms UNION ALL SELECT work, 'plain ' || id, id || '｜plain ' || id, pos FROM terms)
SELECT work, word, tip, CAST(row_number() OVER (PARTITION BY work ORDER BY length(word) DESC, pos, word) AS INTEGER) AS rank FROM tip_words""")
def tooltip_terms(spark, sf_dir):
    return g.tooltip_terms(b.terms(spark, sf_dir))


def _short_tips(spark, sf_dir):
    """Tips of words that the drafts hold: the first and last part of a sentence."""
    words = ["tion", "the", "ther", "eau", "sch"]
    rows = F.explode(F.array(*(F.struct(F.lit(w).alias("word"), F.lit(f"t<{i}").alias("tip"), F.lit(i).alias("rank")) for i, w in enumerate(sorted(words, key=len, reverse=True)))))
    return b.table(spark, sf_dir, "documents").select(F.col("source").alias("work")).distinct().select("work", rows.alias("r")).select("work", "r.*")


_PATTERN = "ther|tion|eau|sch|the"


@query(f"""SELECT doc_id, regexp_replace(replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;'), '({_PATTERN})', '[\\1]', 'g') AS marked FROM documents""")
def mark_terms(spark, sf_dir):
    """Texts as escaped html, with the spans around marked words shown as brackets."""
    docs = b.table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("work"), html_escaped(F.col("text")).alias("html"))
    marked = g.mark_terms(docs, _short_tips(spark, sf_dir))
    return marked.select("doc_id", F.regexp_replace("html", r'<span class="term" tabindex="0" data-tip="t&lt;\d">([^<]*)</span>', "[$1]").alias("marked"))


@query(f"""WITH w AS (SELECT source AS work, CAST(doc_id AS INTEGER) AS juan, unnest(regexp_extract_all(text, '({_PATTERN})', 1)) AS word FROM documents)
SELECT work, juan, CAST(0 AS INTEGER) AS idx, word, count(*) AS n FROM w GROUP BY work, juan, word""")
def term_mentions(spark, sf_dir):
    docs = b.table(spark, sf_dir, "documents").select(F.col("source").alias("work"), F.col("doc_id").cast("int").alias("juan"), F.lit(0).alias("idx"), "text")
    return g.term_mentions(docs, _short_tips(spark, sf_dir))


@query(o.CHECK_SQL.rstrip() + ", " + o.TERMS + """, k AS (SELECT s.*, lag(start_key) OVER (PARTITION BY work, juan ORDER BY idx) AS pk, max(idx) OVER (PARTITION BY work, juan) AS li FROM sections s),
kb AS (SELECT k.*, first_id, last_id FROM k JOIN bounds USING (work, juan)), ke AS (SELECT work, juan, idx, title, unnest([start_id, end_id]) AS line_id FROM kb),
found AS (SELECT work, juan FROM kb WHERE idx = 0 AND start_id <> first_id UNION ALL SELECT work, juan FROM kb WHERE idx = li AND end_id <> last_id
UNION ALL SELECT work, juan FROM kb WHERE end_key < start_key UNION ALL SELECT work, juan FROM kb WHERE start_key < pk
UNION ALL SELECT work, juan FROM ke WHERE NOT EXISTS (SELECT 1 FROM lines l WHERE l.work = ke.work AND l.juan = ke.juan AND l.line_id = ke.line_id)
UNION ALL SELECT work, juan FROM kb WHERE start_key < """ + o.key("first_id") + " OR end_key > " + o.key("last_id") + """
UNION ALL SELECT s.work, s.juan FROM sections s JOIN terms t ON t.work = s.work AND contains(s.source, t.id) WHERE NOT contains(s.translation, t.pattern)),
n AS (SELECT work, juan, count(*) AS n FROM found GROUP BY work, juan)
SELECT v.work, v.juan, coalesce(n.n, 0) AS n_issues, n.n IS NULL AS passed FROM (SELECT DISTINCT work, juan FROM sections) v LEFT JOIN n ON n.work = v.work AND n.juan = v.juan""")
def volume_check_report(spark, sf_dir):
    return _checks(spark, sf_dir)[1]


def _checks(spark, sf_dir):
    from ..operators import coverage as cov

    sections, terms = written(b.sections(spark, sf_dir)), written(b.terms(spark, sf_dir))
    coverage = cov.coverage_report(sections, b.lines(spark, sf_dir), b.bounds(spark, sf_dir))
    return inf.volume_check_report(coverage, g.validate_glossary(b.terms_json(terms)), g.term_check(sections, terms), sections)


@query(o.CHECK_SQL.rstrip() + ", " + o.TERMS + ISSUES + """, found AS (SELECT work, juan, 'coverage' AS source, idx, rule_no, issue FROM issues
UNION ALL SELECT s.work, s.juan, 'terms', s.idx, t.pos, s.title || ': source has ' || t.id || ' but translation lacks one of ' || t.pattern FROM sections s JOIN terms t ON t.work = s.work AND contains(s.source, t.id) WHERE NOT contains(s.translation, t.pattern)),
r AS (SELECT *, row_number() OVER (PARTITION BY work, juan ORDER BY source, idx, rule_no, issue) AS rank FROM found),
h AS (SELECT work, juan, string_agg(issue, '；' ORDER BY rank) AS hint FROM r WHERE rank <= 10 GROUP BY work, juan),
t AS (SELECT work, juan, list_sort(list_distinct(list(split_part(issue, ':', 1)))) AS titles FROM found WHERE contains(issue, ':') GROUP BY work, juan)
SELECT work, juan, coalesce(titles, []::VARCHAR[]) AS titles, hint FROM h LEFT JOIN t USING (work, juan)""")
def repair_targets(spark, sf_dir):
    """The titles to repair in each volume with issues, and its first ten issues."""
    return inf.repair_targets(_checks(spark, sf_dir)[0])
