"""Volume files that people edit, read again when they change.

Spark's file source never reads a path twice, so the stream is not one of files but of a ledger: a poll lists the folder, compares path,
time and length with the ledger, reads what differs, and appends an entry with digest and text for each file whose content is new. The
stream reads entries, keeps the last one of each volume in a micro-batch, and overwrites that volume's partition.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.volumes import HEADING, parse_sections, work_juan_from_path

ENTRY = "path string, modified timestamp, length long, digest string, poll long, work string, juan int, value string"
VOLUME = ["work", "juan"]
MAX_FILES = 10_000  # that one poll reads; the next poll takes up where it ends


def _listing(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    return files.select("path", F.col("modificationTime").alias("modified"), "length", "content")


def _ledger(spark: SparkSession, ledger: str) -> DataFrame:
    try:
        return spark.read.schema(ENTRY).parquet(ledger)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        # before the first poll
        return spark.createDataFrame([], ENTRY)


def poll_volumes(spark: SparkSession, folder: str, ledger: str, by_folder: bool = False, by_digest: bool = False, max_files: int = MAX_FILES) -> int:
    """Append entries for the volume files under a folder that are new or changed, oldest first; how many files this poll read.

    A file counts as changed if its time or length differs from its last entry; by_digest reads every file and compares contents as well. A
    file that was only touched has an entry without text. Files whose names name no volume are skipped; by_folder: the name is in the file's path.
    At most max_files are read, so poll until it returns less. Only the ledger's narrow columns are read, not its texts.
    """
    name = F.regexp_extract("path", r"([^/=]+)/[^/]*\z", 1) if by_folder else F.regexp_extract("path", r"[^/]*\z", 0)
    entries = _ledger(spark, ledger)
    known = entries.groupBy("path").agg(F.max_by(F.struct("modified", "length", "digest"), "poll").alias("known"))
    listed = _listing(spark, folder).drop("content").filter(work_juan_from_path(name).isNotNull())
    seen = known.select("path", "known.modified", "known.length")
    fresh = listed if by_digest else listed.join(seen, ["path", "modified", "length"], "left_anti")
    paths = [re.sub(r"([\[\]{}*?\\])", r"\\\1", r.path) for r in fresh.orderBy("modified", "path").limit(max_files).collect()]
    if not paths:
        return 0
    poll = 1 + (entries.agg(F.max("poll")).first()[0] or 0)
    read = _listing(spark, paths).withColumn("v", work_juan_from_path(name)).withColumn("digest", F.sha2("content", 256)).join(known, "path", "left")
    changed = ~F.col("digest").eqNullSafe(F.col("known.digest"))
    new = changed | ~F.struct("modified", "length").eqNullSafe(F.struct("known.modified", "known.length"))
    value = F.when(changed, F.make_valid_utf8(F.col("content").cast("string")))
    read.filter(new).select("path", "modified", "length", "digest", F.lit(poll).cast("long").alias("poll"), "v.work", "v.juan", value.alias("value")).write.mode("append").option("compression", "zstd").parquet(ledger)
    return len(paths)


def append_volumes(volumes: DataFrame, ledger: str) -> None:
    """Append entries for the volumes (work, juan, value) whose text differs from their last entry: a poll of a table of volumes, for more of them than one wants files.

    Null texts count as no volume. The entry's path is the volume's own.
    """
    spark = volumes.sparkSession
    entries = _ledger(spark, ledger)
    known = entries.groupBy("path").agg(F.max_by("digest", "poll").alias("known"))
    poll = 1 + (entries.agg(F.max("poll")).first()[0] or 0)
    named = volumes.filter("value IS NOT NULL").select(F.concat_ws("/", "work", F.col("juan").cast("string")).alias("path"), *VOLUME, "value", F.octet_length("value").cast("long").alias("length"), F.sha2("value", 256).alias("digest"))
    new = named.join(known, "path", "left").filter(~F.col("digest").eqNullSafe(F.col("known")))
    new.select("path", F.current_timestamp().alias("modified"), "length", "digest", F.lit(poll).cast("long").alias("poll"), *VOLUME, "value").write.mode("append").option("compression", "zstd").parquet(ledger)


def sections_of_entries(entries: DataFrame) -> DataFrame:
    """The sections of the last changed entry of each volume, and a row without idx for a volume that has none left."""
    last = F.row_number().over(Window.partitionBy(*VOLUME).orderBy(F.desc("poll"), F.desc("modified"), F.desc("path")))
    volumes = entries.filter("value IS NOT NULL").withColumn("nth", last).filter("nth = 1").select(*VOLUME, "value")
    bare = volumes.filter(~F.col("value").rlike(HEADING)).select(*VOLUME)
    return parse_sections(volumes).unionByName(bare, allowMissingColumns=True)


def overwrite_volumes(path: str) -> Callable[[DataFrame, int], None]:
    """A sink that replaces only the work and volume partitions that a micro-batch touches; to run one again changes nothing."""

    def write(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*VOLUME).parquet(path)

    return write


def current_sections(spark: SparkSession, path: str) -> DataFrame:
    """The sections in the partitions of overwrite_volumes()."""
    return spark.read.parquet(path).filter("idx IS NOT NULL")


def append_batches(path: str) -> Callable[[DataFrame, int], None]:
    """A sink that adds each micro-batch as a folder of its own, many volumes to a file; to run one again changes nothing."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def sections_of_batches(spark: SparkSession, path: str) -> DataFrame:
    """The sections in the folders of append_batches(), those of the last micro-batch that a volume is in."""
    batches = spark.read.parquet(path)
    last = batches.groupBy(*VOLUME).agg(F.max("batch").alias("batch"))
    return batches.filter("idx IS NOT NULL").join(last, [*VOLUME, "batch"], "left_semi").drop("batch")


def stream_sections(spark: SparkSession, ledger: str, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hand the sections of each micro-batch of ledger entries to sink. It ends when there are no more; start it after a poll, with the same checkpoint."""
    entries = spark.readStream.schema(ENTRY).parquet(ledger)
    return entries.writeStream.foreachBatch(lambda batch, number: sink(sections_of_entries(batch), number)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
