"""Glossary terms against texts: containment (overlaps count) and marking (leftmost, longest first)."""

from __future__ import annotations

from collections import Counter
from functools import reduce
from html import escape

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import written
from ..sources.volumes import GLOSSARY_FIELDS
from .matching import Walk, contained_words, few_words, mapped_texts, marked

SECTION = ["work", "juan", "idx"]


def typed_terms(glossaries: DataFrame) -> DataFrame:
    """(work, glossary variant) that validates -> a row per term: work, pos, id, xuanzang, display, plain, sanskrit, english, source_terms, translation_patterns."""
    terms = glossaries.select("work", F.posexplode(F.variant_get("glossary", "$.terms", "array<variant>")).alias("pos", "term"))
    text = lambda name: F.try_variant_get("term", f"$.{name}", "string").alias(name)
    many = lambda name: F.try_variant_get("term", f"$.{name}", "array<string>").alias(name)
    return terms.select("work", "pos", *map(text, ("id", "xuanzang", "display", "plain")), *map(many, ("sanskrit", "english", "source_terms", "translation_patterns")), F.to_json("term").alias("json"))


def term_hits(texts: DataFrame, text: str, words: DataFrame) -> DataFrame:
    """(keys, text) and words (work, word, more) -> the distinct keys and words with the word anywhere in the text.

    Few words travel to the texts, in an automaton for each work. Of more, the beginnings, as long as the work's shortest word and at most eight
    characters, are joined with the texts' distinct n-grams of that length; contains() then decides. So there is neither a cross join nor a scan per word,
    and overlapping words are all found. Empty words are in every text of their work.
    """
    keys = [c for c in texts.columns if c != text]
    if few_words(words, "work", "word"):
        hits = contained_words(texts, text, words).join(F.broadcast(words), ["work", "word"])
    else:
        hits = _hits_by_grams(texts, text, words)
    empty = texts.drop(text).join(words.filter("word = ''"), "work")
    return hits.select(*keys, *(c for c in words.columns if c != "work")).unionByName(empty).distinct()


def _hits_by_grams(texts: DataFrame, text: str, words: DataFrame) -> DataFrame:
    keys = [c for c in texts.columns if c != text]
    size = words.filter("word != ''").groupBy("work").agg(F.least(F.min(F.char_length("word")), F.lit(8)).alias("q"))
    begun = words.filter("word != ''").join(size, "work").withColumn("gram", F.expr("substring(word, 1, q)")).drop("q")
    # a look-ahead takes all n-grams in one pass; substring() would count from the start of the text each time
    all_grams = F.array_distinct(F.regexp_extract_all(text, F.concat(F.lit("(?s)(?=(.{"), F.col("q").cast("string"), F.lit("}))")), F.lit(1)))
    cut = texts.join(size, "work").filter(F.char_length(text) >= F.col("q"))
    grams = cut.select(*keys, F.explode(all_grams).alias("gram"))
    candidates = grams.join(begun, ["work", "gram"]).drop("gram").distinct()
    return candidates.join(texts, keys).filter(F.col(text).contains(F.col("word"))).drop(text)


def _variants(terms: DataFrame, column: str) -> DataFrame:
    return terms.select("work", F.explode(column).alias("word"), "pos").distinct()


def source_terms_in(sections: DataFrame, terms: DataFrame) -> DataFrame:
    """work, juan, idx, pos: the terms of the work that a section's source holds."""
    return term_hits(sections.select(*SECTION, "source"), "source", _variants(terms, "source_terms")).select(*SECTION, "pos").distinct()


def term_check(sections: DataFrame, terms: DataFrame) -> DataFrame:
    """work, juan, idx, pos, title, issue: the source holds a term, and the translation none of the term's patterns."""
    needed = source_terms_in(sections, terms)
    given = term_hits(sections.select(*SECTION, "translation"), "translation", _variants(terms, "translation_patterns")).select(*SECTION, "pos").distinct()
    lacking = needed.join(given, [*SECTION, "pos"], "left_anti")
    named = lacking.join(terms.select("work", "pos", "xuanzang", "translation_patterns"), ["work", "pos"]).join(sections.select(*SECTION, "title"), SECTION)
    issue = F.concat("title", F.lit(": source has "), "xuanzang", F.lit(" but translation lacks one of "), F.array_join("translation_patterns", ", "))
    return named.select(*SECTION, "pos", "title", issue.alias("issue"))


def glossary_subset(sections: DataFrame, terms: DataFrame) -> DataFrame:
    """work, juan, idx, glossary: the section's terms in glossary order as a JSON list with all their fields."""
    hits = source_terms_in(sections, terms).join(terms.select("work", "pos", "json"), ["work", "pos"])
    listed = hits.groupBy(*SECTION).agg(F.array_sort(F.collect_list(F.struct("pos", "json"))).alias("t"))
    whole = F.concat(F.lit("["), F.coalesce(F.array_join("t.json", ", "), F.lit("")), F.lit("]"))
    return sections.select(*SECTION).join(listed, SECTION, "left").select(*SECTION, whole.alias("glossary"))


def validate_glossary(glossaries: DataFrame) -> DataFrame:
    """(work, glossary variant) -> work, pos, rule_no, issue. A term with missing fields is not tested further, and its id does not count as seen."""
    terms = F.try_variant_get("glossary", "$.terms", "array<variant>")
    empty = glossaries.filter(terms.isNull() | (F.size(terms) == 0)).select("work", F.lit(0).alias("pos"), F.lit(0).alias("rule_no"), F.lit("Glossary must contain a non-empty terms list").alias("issue"))
    each = glossaries.select("work", F.posexplode(terms).alias("pos", "term"))
    fields = F.try_variant_get("term", "$", "map<string, variant>")
    each = each.withColumn("fields", F.map_keys(fields)).withColumn("id", F.coalesce(F.try_variant_get("term", "$.id", "string"), F.lit("<unknown>")))
    missing = F.array_except(F.array(*map(F.lit, sorted(GLOSSARY_FIELDS))), F.col("fields"))
    no_object = each.filter("fields IS NULL").select("work", "pos", F.lit(1).alias("rule_no"), F.lit("Each term must be an object").alias("issue"))
    objects = each.filter("fields IS NOT NULL").withColumn("missing", missing)
    lacking = objects.filter(F.size("missing") > 0).select("work", "pos", F.lit(2).alias("rule_no"), F.concat("id", F.lit(" missing fields: "), F.array_join("missing", ", ")).alias("issue"))
    whole = objects.filter(F.size("missing") == 0)
    seen = F.row_number().over(Window.partitionBy("work", "id").orderBy("pos"))
    again = whole.withColumn("nth", seen).filter("nth > 1").select("work", "pos", F.lit(3).alias("rule_no"), F.concat(F.lit("Duplicate term id: "), "id").alias("issue"))

    def listed(name: str, no: int) -> DataFrame:
        items = F.try_variant_get("term", f"$.{name}", "array<variant>")
        strings = F.coalesce(F.forall(items, lambda x: F.schema_of_variant(x) == "STRING"), F.lit(False))
        wrong = F.when(~strings, F.concat("id", F.lit(f" field {name} must be a list of strings"))).when(F.size(items) == 0, F.concat("id", F.lit(f" field {name} must not be empty")))
        return whole.select("work", "pos", F.lit(no).alias("rule_no"), wrong.alias("issue")).filter("issue IS NOT NULL")

    return reduce(DataFrame.unionByName, (empty, no_object, lacking, again, listed("source_terms", 4), listed("translation_patterns", 5)))


def merge_new_terms(glossaries: DataFrame, proposals: DataFrame) -> DataFrame:
    """glossaries (work, glossary variant) and proposals (work, raw JSON list) -> work, n_added, value: the glossary with the new terms, or as it was.

    Proposed terms whose ids are known, and items that are no objects, are left out. A proposal is dropped whole if it is no list, or if the glossary with it does not validate.
    """
    items = F.try_variant_get(F.try_parse_json("raw"), "$", "array<variant>")
    known = glossaries.select("work", F.explode(F.try_variant_get("glossary", "$.terms", "array<variant>")).alias("t")).select("work", F.try_variant_get("t", "$.id", "string").alias("id")).filter("id IS NOT NULL").distinct()
    proposed = proposals.select("work", F.posexplode(items).alias("pos", "t")).filter(F.try_variant_get("t", "$", "map<string, variant>").isNotNull()).withColumn("id", F.try_variant_get("t", "$.id", "string"))
    new = proposed.join(known, ["work", "id"], "left_anti").groupBy("work").agg(F.array_sort(F.collect_list(F.struct("pos", F.to_json("t").alias("j")))).alias("new"))
    old = glossaries.select("work", F.transform(F.coalesce(F.try_variant_get("glossary", "$.terms", "array<variant>"), F.array().cast("array<variant>")), lambda t: F.to_json(t)).alias("old"))
    both = old.join(new, "work", "left").select("work", "old", F.coalesce(F.col("new.j"), F.array().cast("array<string>")).alias("added"))
    value = lambda parts: F.concat(F.lit('{"work":"'), "work", F.lit('","terms":['), F.array_join(parts, ","), F.lit("]}"))
    both = both.withColumn("candidate", value(F.concat("old", "added")))
    wrong = validate_glossary(both.filter(F.size("added") > 0).select("work", F.parse_json("candidate").alias("glossary"))).select("work", F.lit(True).alias("wrong")).distinct()
    judged = both.join(wrong, "work", "left").withColumn("take", F.col("wrong").isNull())
    return judged.select("work", F.when(F.col("take"), F.size("added")).otherwise(0).alias("n_added"), F.when(F.col("take"), F.col("candidate")).otherwise(value("old")).alias("value"))


def tooltip_terms(terms: DataFrame) -> DataFrame:
    """work, word, tip, rank: words of two characters or more; the first term has a word; longest word first."""
    line = lambda mark, name: F.when(F.size(name) > 0, F.concat(F.lit(f"\n{mark} "), F.array_join(name, " / "))).otherwise("")
    tip = F.concat(F.concat_ws("｜", "xuanzang", "plain"), F.coalesce(line("梵", "sanskrit"), F.lit("")), F.coalesce(line("英", "english"), F.lit("")))
    words = terms.select("work", "pos", F.explode(F.array_distinct(F.array("xuanzang", "plain"))).alias("word"), tip.alias("tip")).filter(F.char_length("word") >= 2)
    first = words.groupBy("work", "word").agg(F.min_by("tip", "pos").alias("tip"), F.min("pos").alias("pos"))
    rank = F.row_number().over(Window.partitionBy("work").orderBy(F.desc(F.char_length("word")), "pos", "word"))
    return first.select("work", "word", "tip", rank.alias("rank"))


def _with_words(frame: DataFrame, text: str, tips: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The frame, and the tips if they are few. If not, each row gets the words that its text holds in a column `words`."""
    if few_words(tips, "work", "word", "tip"):
        return frame, tips.select("work", "word", "tip")
    numbered = written(frame.withColumn("row", F.monotonically_increasing_id()))
    hits = term_hits(numbered.select("work", "row", text), text, tips.select("work", "word").filter("char_length(word) >= 2")).join(tips, ["work", "word"])
    words = hits.groupBy("row").agg(F.collect_list(F.struct("word", "tip")).alias("words"))
    return numbered.join(words, "row", "left").drop("row"), None


def _span(word: str, tip: str | None) -> str:
    return f'<span class="term" tabindex="0" data-tip="{escape(tip or "")}">{word}</span>'


def mark_terms(fragments: DataFrame, tips: DataFrame) -> DataFrame:
    """(work, html, more) and tips (work, word, tip) -> the same with every leftmost longest word in text nodes put into a span with its tip.

    Words of two characters or more are marked; null html stays null, and a work without tips stays as it is.
    """
    frame, given = _with_words(fragments, "html", tips)
    made = mapped_texts(frame, "html", lambda html, walk: marked(html, walk, _span), T.StructField("marked", T.StringType()), given)
    return made.withColumn("html", F.col("marked")).select(*fragments.columns)


def _counted(text: str, walk: Walk) -> list[dict]:
    return [{"word": word, "n": n} for word, n in Counter(text[a:b] for a, b in walk.spans(text)).items()]


def term_mentions(texts: DataFrame, tips: DataFrame) -> DataFrame:
    """(work, juan, idx, text) -> work, juan, idx, word, n: how often the marker would mark each word."""
    frame, given = _with_words(texts.select(*SECTION, "text"), "text", tips)
    kind = T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())]))
    made = mapped_texts(frame, "text", _counted, T.StructField("mentions", kind), given)
    return made.select(*SECTION, F.inline("mentions")).groupBy(*SECTION, "word").agg(F.sum("n").alias("n"))
