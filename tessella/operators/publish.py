"""Publishing: section fragments, search records and search, catalogs, versions, links."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import html_escaped, html_paragraphs, trim_u
from ..sources.shared import written
from .matching import few_words

VOLUME = ["work", "juan"]
BUCKETS, SHELVES = 64, 256  # parts of the postings and of the records that a search reads or leaves
ON_SHELF = 64  # volumes
BLOCK = 4096  # records whose places a list of postings holds
TRIED = 4  # times the limit: candidates of each query that are read first
SCANNED = 32  # queries of a work that are looked for in each of its records
_AT_ONCE = 1 << 21  # characters


def section_html(start: Column, end: Column, title: Column, range_label: Column, translation_html: Column, source_html: Column, note: Column) -> Column:
    """A section's parallel block; the note only if there is one."""
    e = html_escaped
    noted = F.when(note != "", F.concat(F.lit('\n<p class="translation-note">'), e(note), F.lit("</p>"))).otherwise("")
    return F.concat(
        F.lit('<section class="parallel-pair" id="'), e(start), F.lit('" data-source-start="'), e(start), F.lit('" data-source-end="'), e(end), F.lit('">\n<h2>'), e(title),
        F.lit('</h2>\n<div class="translation-text">\n'), translation_html, F.lit('\n</div>\n<div class="source-text">\n<span class="line-range">'), e(range_label), F.lit("</span>\n"), source_html, F.lit("\n</div>"), noted, F.lit("\n</section>"),
    )


def sections_html(sections: DataFrame) -> DataFrame:
    fragment = section_html(*(F.col(c) for c in ("start_id", "end_id", "title", "range_label")), html_paragraphs(F.col("translation")), html_paragraphs(F.col("source")), F.col("note"))
    return sections.select("work", "juan", "idx", fragment.alias("html"))


def search_records(sections: DataFrame, toc: DataFrame) -> DataFrame:
    """work, t, j, u, x, part, idx: section records, then table-of-contents records with no text."""
    stem = F.concat_ws("-", "work", F.lpad(F.col("juan").cast("string"), F.greatest(F.lit(3), F.length(F.col("juan").cast("string"))), F.lit("0")), F.lit("baihua"))
    own = sections.select("work", F.col("title").alias("t"), F.col("juan").alias("j"), F.concat(F.lit("translations/"), stem, F.lit(".html#"), "start_id").alias("u"), F.concat_ws("\n", "translation", "source").alias("x"), F.lit(0).alias("part"), "idx")
    return own.unionByName(toc.select("work", F.col("title").alias("t"), F.col("juan").alias("j"), F.col("url").alias("u"), F.lit("").alias("x"), F.lit(1).alias("part"), F.col("pre").alias("idx")))


def _excerpt(x: Column, q: Column) -> Column:
    at = F.instr(x, q)
    return F.when(at > 0, F.replace(F.substr(x, F.greatest(at - 20, F.lit(1)), F.lit(39) + at - F.greatest(at - 20, F.lit(1)) + 1), F.lit("\n"), F.lit(" "))).otherwise("")


def _asked(queries: DataFrame) -> DataFrame:
    return queries.select("work", trim_u(F.col("q")).alias("q")).filter(F.char_length("q") >= 2).distinct()


def _first_hits(hits: DataFrame, order: list[str], limit: int) -> DataFrame:
    """The first hits of each query with their excerpts. These are cut before the ranking, as else whole texts would be sorted."""
    cut = hits.select("work", "q", *[c for c in order if c != "work"], "t", _excerpt(F.col("x"), F.col("q")).alias("excerpt"))
    rank = F.row_number().over(Window.partitionBy("work", "q").orderBy(*order))
    return cut.withColumn("rank", rank).filter(F.col("rank") <= limit).select("work", "q", "rank", *[c for c in cut.columns if c not in ("work", "q")])


def _holds(q: Column) -> Column:
    return F.col("t").contains(q) | F.col("x").contains(q)


def substring_search(records: DataFrame, queries: DataFrame, order: list[str], limit: int = 30) -> DataFrame:
    """queries (work, q) -> work, q, rank, the record's order columns, t, excerpt: the first `limit` records of the work that hold q in title or text.

    Queries are trimmed, and those under two characters find nothing. If they are few, and few for each work, they travel to the records, and each is looked for where
    the text lies. Else records and queries meet on one bigram of the query. contains() decides. For the first hits per query a bounded heap is enough, so a frequent query is no large group.
    """
    asked = written(_asked(queries))
    most = asked.groupBy("work").count().agg(F.max("count")).first()[0] or 0
    if most <= SCANNED and few_words(asked, "work", "q"):
        given = F.broadcast(asked.groupBy("work").agg(F.collect_list("q").alias("qs")))
        hits = records.join(given, "work").withColumn("q", F.explode(F.filter("qs", _holds))).drop("qs")
        return _first_hits(hits, order, limit)
    asked = asked.withColumn("gram", F.expr("substring(q, 1, 2)"))
    wanted = asked.groupBy("work").agg(F.collect_set("gram").alias("grams"))
    both = F.concat_ws("\0", "t", "x")
    grams = F.array_distinct(F.regexp_extract_all("tx", F.lit("(?s)(?=(..))"), F.lit(1)))
    dealt = records.withColumn("tx", both).join(wanted, "work").withColumn("gram", F.explode(F.array_intersect(grams, "grams"))).drop("tx", "grams")
    return _first_hits(dealt.join(asked, ["work", "gram"]).filter(_holds(F.col("q"))), order, limit)


def _bigrams(text: Column) -> Column:
    """The distinct bigrams of a short text of two characters or more."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.char_length(text) - 1), lambda i: F.substr(text, i, F.lit(2))))


def _pairs(texts: list[str], places: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct bigrams of the texts, where the list of each begins and the last one ends, and the lists: the places of the texts that hold it."""
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    of = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)))
    # two characters of 21 bits, and the text
    key = (code[:-1] << 33 | code[1:] << 12 | of[1:])[of[1:] == of[:-1]]
    key.sort()
    key = key[np.r_[True, key[1:] != key[:-1]][: len(key)]]
    gram = key >> 12
    begins = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]][: len(gram)])
    names = [chr(g >> 21) + chr(g & 0x1FFFFF) for g in gram[begins].tolist()]
    return names, np.r_[begins, len(key)].astype(np.int32), places[key & 0xFFF]


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """shelf, work, row, text -> work, gram, shelf, block, places: for each bigram of a work the records of a block that hold it."""
    for batch in batches:
        shelves, works, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_numpy()
        sizes = pc.fill_null(pc.utf8_length(batch.column(3)), 0).to_numpy()
        # some texts of one shelf, work and block together, and of no more characters than fit the memory of a task
        keys = list(zip(shelves, works, (rows // BLOCK).tolist(), ((np.cumsum(sizes) - sizes) // _AT_ONCE).tolist(), strict=True))
        for (shelf, work, block, _), some in groupby(range(len(keys)), keys.__getitem__):
            at = list(some)
            texts = batch.column(3).slice(at[0], len(at)).to_pylist()
            names, offsets, places = _pairs(texts, (rows[at[0] : at[-1] + 1] % BLOCK).astype(np.int16))
            n, lists = len(names), pa.ListArray.from_arrays(pa.array(offsets), pa.array(places))
            yield pa.RecordBatch.from_arrays([pa.array([work] * n, pa.string()), pa.array(names, pa.string()), pa.array([shelf] * n, pa.int32()), pa.array([block] * n, pa.int64()), lists], ["work", "gram", "shelf", "block", "places"])


def write_postings(records: DataFrame, path: str) -> None:
    """The index of a search: numbered records by shelf, a shelf being some neighbouring volumes of a work, and by bucket for each bigram of a work, and each block of records, those that hold it.

    A list of places in a block stands for as many rows. A shelf or bucket with most records is dealt to several files by rebalancing.
    """
    shelf = F.pmod(F.hash("work", F.expr(f"j div {ON_SHELF}")), F.lit(SHELVES))
    dealt = records.withColumn("shelf", shelf).hint("rebalance", "shelf").sortWithinPartitions("shelf", "work")
    dealt.withColumn("row", F.monotonically_increasing_id()).write.partitionBy("shelf").option("compression", "zstd").parquet(f"{path}/records")
    stored = records.sparkSession.read.parquet(f"{path}/records")
    lists = stored.select("shelf", "work", "row", F.concat_ws("\0", "t", "x").alias("text")).mapInArrow(_postings, "work string, gram string, shelf int, block long, places array<smallint>")
    postings = lists.withColumn("bucket", F.pmod(F.hash("work", "gram"), F.lit(BUCKETS)))
    postings.hint("rebalance", "bucket").sortWithinPartitions("bucket", "work", "gram").write.partitionBy("bucket").option("compression", "zstd").parquet(f"{path}/postings")


def _read_records(spark: SparkSession, path: str, named: DataFrame) -> DataFrame:
    """The named records (shelf, row, more) of which title or text hold q. The driver takes in the numbers of the shelves, which are fixed."""
    shelves = [r.shelf for r in named.select("shelf").distinct().collect()]
    records = spark.read.parquet(f"{path}/records").filter(F.col("shelf").isin(shelves))
    return named.select("shelf", "row", "q").join(records, ["shelf", "row"]).filter(_holds(F.col("q")))


def indexed_search(spark: SparkSession, path: str, queries: DataFrame, limit: int = 30) -> DataFrame:
    """What substring_search() finds, from the index at path: work, q, rank, part, j, idx, t, excerpt.

    Only the buckets of the queries' bigrams are read, and lists of the same block give the records that hold all bigrams of a query. Of these the first ones in the order of the
    result are read, a few times the limit; contains() decides. A query with more of them and less than `limit` hits among these has all of its records read.
    """
    grams = _bigrams(F.col("q"))
    asked = written(_asked(queries).select("work", "q", F.explode(grams).alias("gram"), F.size(grams).alias("n_grams")).withColumn("bucket", F.pmod(F.hash("work", "gram"), F.lit(BUCKETS))))
    buckets = [r.bucket for r in asked.select("bucket").distinct().collect()]
    postings = spark.read.parquet(f"{path}/postings").filter(F.col("bucket").isin(buckets))
    met = postings.join(asked, ["bucket", "work", "gram"]).groupBy("work", "q", "n_grams", "shelf", "block").agg(F.sort_array(F.flatten(F.collect_list("places"))).alias("all"))
    # a record is in the list of a bigram once, so one that holds all n is there n times
    held = F.filter("all", lambda place, i: F.get("all", i + F.col("n_grams") - 1) == place)
    named = met.select("work", "q", "shelf", "block", F.explode(held).alias("place"))
    named = written(named.select("work", "q", "shelf", (F.col("block") * BLOCK + F.col("place")).alias("row")))
    order = ["part", "j", "idx"]
    rank = F.row_number().over(Window.partitionBy("work", "q").orderBy(*order))
    placed = named.join(spark.read.parquet(f"{path}/records").select("shelf", "row", *order), ["shelf", "row"])
    first = written(placed.withColumn("rank", rank).filter(F.col("rank") <= TRIED * limit).select("work", "q", "shelf", "row"))
    found = _read_records(spark, path, first)
    full = found.groupBy("work", "q").count().filter(F.col("count") >= limit)
    more = named.groupBy("work", "q").count().filter(F.col("count") > TRIED * limit)
    short = written(more.join(full, ["work", "q"], "left_anti").select("work", "q"))
    if not short.isEmpty():
        found = _read_records(spark, path, written(first.join(short, ["work", "q"], "left_anti").union(named.join(short, ["work", "q"]).select(first.columns))))
    return _first_hits(found, order, limit)


def works_with_index(works: DataFrame, published: DataFrame) -> DataFrame:
    """work, title, link: a link for works with a published index; null marks one in preparation."""
    have = published.select("work").distinct().withColumn("link", F.concat("work", F.lit("/index.html")))
    return works.select("work", "title").join(have, "work", "left")


def work_volume_index(sections: DataFrame) -> DataFrame:
    """work, volumes: the sorted volumes with any translation."""
    done = sections.filter(trim_u(F.col("translation")) != "").select(*VOLUME).distinct()
    return done.groupBy("work").agg(F.array_sort(F.collect_list("juan")).alias("volumes"))


def volume_neighbors(volumes: DataFrame) -> DataFrame:
    """work, juan, previous, next among a work's volumes."""
    w = Window.partitionBy("work").orderBy("juan")
    return volumes.select(*VOLUME).distinct().select(*VOLUME, F.lag("juan").over(w).alias("previous"), F.lead("juan").over(w).alias("next"))


def next_version(volumes: DataFrame, versions: DataFrame) -> DataFrame:
    """work, juan, version: one more than the highest archived version, or 1."""
    top = versions.groupBy(*VOLUME).agg(F.max("version").alias("top"))
    return volumes.select(*VOLUME).distinct().join(top, VOLUME, "left").select(*VOLUME, (F.coalesce("top", F.lit(0)) + 1).alias("version"))


def version_list(versions: DataFrame) -> DataFrame:
    """work, juan, version, latest: versions in numeric order, the highest one marked."""
    top = F.max("version").over(Window.partitionBy(*VOLUME))
    return versions.select(*VOLUME, "version", (F.col("version") == top).alias("latest"))


def local_target(link: Column) -> Column:
    """The decoded path of a link without scheme and host that is no fragment; null for other links and for empty paths."""
    local = ~link.rlike(r"^(?i)[a-z][a-z0-9+.-]*:") & ~link.startswith("//") & ~link.startswith("#")
    path = F.regexp_replace(F.regexp_extract(link, r"^[^?#]*", 0), r";[^/]*\z", "")
    decoded = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    return F.when(local, F.nullif(decoded, F.lit("")))


def local_links(links: DataFrame) -> DataFrame:
    return links.withColumn("target", local_target(F.col("link"))).filter("target IS NOT NULL")


def resolved(path: Column, target: Column) -> Column:
    """A target against the directory of a page, without . and .. parts. A target from the root stays one from the root."""
    base = F.when(target.startswith("/"), F.lit("")).otherwise(F.regexp_replace(path, r"[^/]*\z", ""))
    parts = F.filter(F.split(F.concat(base, target), "/", -1), lambda p: (p != "") & (p != "."))
    walked = F.aggregate(parts, F.array().cast("array<string>"), lambda done, p: F.when(p == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.concat(done, F.array(p))))
    return F.concat(F.when(F.concat(base, target).startswith("/"), "/").otherwise(""), F.array_join(walked, "/"))


def with_directories(files: DataFrame) -> DataFrame:
    """The distinct paths of files and of all directories above them."""
    parts = F.split("path", "/", -1)
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    return files.select(F.explode(above).alias("path")).distinct()


def broken_links(links: DataFrame, files: DataFrame) -> DataFrame:
    """path, pos, link of local links whose target is no file and no directory; repeated links are all reported.

    Targets are made distinct before they are looked up, as sites link to the same few files from every page.
    """
    placed = local_links(links).withColumn("resolved", resolved(F.col("path"), F.col("target")))
    missing = placed.select("resolved").distinct().join(with_directories(files).withColumnRenamed("path", "resolved"), "resolved", "left_anti")
    return placed.join(missing, "resolved", "left_semi").select("path", "pos", "link")
