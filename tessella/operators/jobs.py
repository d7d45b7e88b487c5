"""Job records: states, roll-ups and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import trim_u

PIECE = 10_000  # numbers of a range that one row becomes at once


def runnable_volumes(jobs: DataFrame, progress: DataFrame) -> DataFrame:
    """jobs (job_id, juans) and progress (job_id, juan, step, cancelled) -> job_id, juan, step of volumes that are neither cancelled nor done."""
    each = jobs.select("job_id", F.explode("juans").alias("juan")).join(progress, ["job_id", "juan"], "left")
    step = F.coalesce("step", F.lit("queued"))
    return each.filter(~F.coalesce("cancelled", F.lit(False)) & ~step.isin("cancelled", "done")).select("job_id", "juan", step.alias("step"))


def job_state_counts(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("state").agg(F.count("*").alias("n"))


def job_rollup(volumes: DataFrame, cancelled_jobs: DataFrame) -> DataFrame:
    """volumes (job_id, juan, state, resume_at) -> job_id, state, resume_at, failed, held.

    A cancelled job is cancelled; else any failed volume fails it, any held one makes it wait for the earliest resume time, else it is done.
    A volume that is cancelled alone does not fail its job.
    """
    of = lambda state: F.array_sort(F.collect_set(F.when(F.col("state") == state, F.col("juan"))))
    grouped = volumes.groupBy("job_id").agg(of("failed").alias("failed"), of("held").alias("held"), F.min(F.when(F.col("state") == "held", F.col("resume_at"))).alias("earliest"))
    joined = grouped.join(cancelled_jobs.select("job_id").distinct().withColumn("gone", F.lit(True)), "job_id", "left")
    state = F.when(F.col("gone"), "cancelled").when(F.size("failed") > 0, "failed").when(F.size("held") > 0, "waiting_model").otherwise("done")
    return joined.select("job_id", state.alias("state"), F.when(state == "waiting_model", F.col("earliest")).alias("resume_at"), "failed", "held")


def earliest_resume(volumes: DataFrame) -> DataFrame:
    return volumes.groupBy("job_id").agg(F.min("resume_at").alias("resume_at"))


def log_tail(log: DataFrame, n: int = 50) -> DataFrame:
    """The last n rows (job_id, ts, seq, message) of each job, newest first."""
    rank = F.row_number().over(Window.partitionBy("job_id").orderBy(F.desc("ts"), F.desc("seq")))
    return log.withColumn("rank", rank).filter(F.col("rank") <= n)


def model_switches(events: DataFrame, n: int = 3) -> DataFrame:
    """events (job_id, juan, stage, ts, seq, model) -> job_id, juan, rank, stage, ts, seq, before, after: the last n changes of model of each volume, newest first.

    A change is where a stage of a volume goes on with another model than it had; events without a model are no change. Only changes are ranked.
    """
    stage = Window.partitionBy("job_id", "juan", "stage").orderBy("ts", "seq")
    changes = events.filter("model IS NOT NULL").withColumn("before", F.lag("model").over(stage)).filter("before IS NOT NULL AND before != model")
    rank = F.row_number().over(Window.partitionBy("job_id", "juan").orderBy(F.desc("ts"), F.desc("seq"), "stage"))
    return changes.withColumn("rank", rank).filter(F.col("rank") <= n).select("job_id", "juan", "rank", "stage", "ts", "seq", "before", F.col("model").alias("after"))


def first_errors(errors: DataFrame, n: int = 4) -> DataFrame:
    """errors (job_id, juan, ts, seq, error) -> job_id, errors: the first n distinct texts among the job's own error (juan null) and then its volumes' latest ones, by volume.

    An event without an error clears its volume's. Texts are made distinct before they are ranked, so a job whose volumes all fail alike is no large group.
    """
    latest = errors.groupBy("job_id", "juan").agg(F.max_by("error", F.struct("ts", "seq")).alias("error")).filter("error IS NOT NULL AND error != ''")
    place = F.coalesce(F.col("juan").cast("long"), F.lit(-(1 << 62)))
    texts = latest.groupBy("job_id", "error").agg(F.min(place).alias("place"))
    ranked = texts.withColumn("rank", F.row_number().over(Window.partitionBy("job_id").orderBy("place", "error"))).filter(F.col("rank") <= n)
    return ranked.groupBy("job_id").agg(F.array_sort(F.collect_list(F.struct("rank", "error"))).alias("list")).select("job_id", F.col("list.error").alias("errors"))


def spec_volumes(specs: DataFrame, spec: str) -> DataFrame:
    """specs with a column of specs like `13-15,20` -> its other columns, juan, error: a row per distinct number, ranges of any size.

    A range is cut into pieces before it becomes rows, so it is no array. A part that is no number, and a spec without volumes, give a row with an error.
    """
    keys = [c for c in specs.columns if c != spec]
    row = next(name for name in ("row", "row_", "row__") if name not in keys)
    numbered = specs.select(*keys, F.monotonically_increasing_id().alias(row), F.filter(F.transform(F.split(F.coalesce(spec, F.lit("")), ","), trim_u), lambda p: p != "").alias("parts"))
    part = lambda p: F.regexp_extract(p, r"^(-?\d+)(?:-(-?\d+))?\z", 1).try_cast("int")
    end = lambda p: F.when(p.rlike(r"^-?\d+\z"), p).otherwise(F.regexp_extract(p, r"^(-?\d+)-(-?\d+)\z", 2)).try_cast("int")
    ranges = F.transform("parts", lambda p: F.struct(p.alias("p"), part(p).cast("long").alias("low"), end(p).cast("long").alias("high")))
    read = numbered.withColumn("ranges", ranges)
    bad = F.filter("ranges", lambda r: r["low"].isNull() | r["high"].isNull())
    some = F.exists("ranges", lambda r: r["low"] <= r["high"])
    error = F.when(F.size(bad) > 0, F.concat(F.lit("invalid volume number: "), F.get(bad, F.lit(0))["p"])).when(~some, "no volumes")
    read = read.withColumn("error", error)
    wrong = read.filter("error IS NOT NULL").select(*keys, F.lit(None).cast("int").alias("juan"), "error")
    pieces = read.filter("error IS NULL").select(*keys, row, F.inline("ranges")).filter("low <= high").select(*keys, row, "high", F.explode(F.sequence("low", "high", F.lit(PIECE).cast("long"))).alias("low"))
    each = pieces.select(*keys, row, F.explode(F.sequence("low", F.least(F.col("low") + (PIECE - 1), F.col("high")))).alias("juan")).distinct()
    return each.select(*keys, F.col("juan").cast("int").alias("juan"), F.lit(None).cast("string").alias("error")).unionByName(wrong)
