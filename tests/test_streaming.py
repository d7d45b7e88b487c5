"""Streams over several micro-batches and restarts, against the batch forms."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from tessella.operators import jobs
from tessella.streaming import jobs as streams
from tessella.streaming import volumes as v


def volume(*texts):
    return "# head\n" + "".join(f"## {i} T\nRange: A1n1_p0001a0{i}\nSource:\n<<<\n{t}\n>>>\nTranslation:\n<<<\n\n>>>\n" for i, t in enumerate(texts, 1))


def put(path, text, second):
    """A file with a time of its own, as edits within a clock tick would look alike."""
    path.write_text(text)
    os.utime(path, (1_760_000_000 + second,) * 2)


def sections(spark, out):
    return sorted((r.work, r.juan, r.source) for r in v.current_sections(spark, out).collect())


def test_changed_volumes_are_read_again(spark, tmp_path):
    files, ledger, out, checkpoint = tmp_path / "files", *(str(tmp_path / n) for n in ("ledger", "out", "checkpoint"))
    files.mkdir()

    def run(**more):
        n = v.poll_volumes(spark, str(files), ledger, **more)
        v.stream_sections(spark, ledger, v.overwrite_volumes(out), checkpoint).awaitTermination()
        return n

    put(files / "A1-001-baihua.md", volume("a", "b"), 1)
    put(files / "A1-002-baihua.md", volume("c"), 1)
    put(files / "other.md", volume("x"), 1)
    assert run() == 2 and sections(spark, out) == [("A1", 1, "a"), ("A1", 1, "b"), ("A1", 2, "c")]
    kept = {p: os.stat(os.path.join(d, p)).st_mtime_ns for d, _, names in os.walk(f"{out}/work=A1/juan=2") for p in names}
    put(files / "A1-001-baihua.md", volume("a", "changed", "new"), 2)  # the same path
    (files / "x[1]{y}").mkdir()
    put(files / "x[1]{y}" / "B-001-baihua.md", volume("odd folder"), 2)
    assert run() == 2
    assert sections(spark, out) == [("A1", 1, "a"), ("A1", 1, "changed"), ("A1", 1, "new"), ("A1", 2, "c"), ("B", 1, "odd folder")]
    assert kept == {p: os.stat(os.path.join(d, p)).st_mtime_ns for d, _, names in os.walk(f"{out}/work=A1/juan=2") for p in names}  # untouched
    assert run() == 0
    put(files / "A1-002-baihua.md", volume("c"), 3)  # touched only
    assert run() == 1 and run() == 0
    assert v._ledger(spark, ledger).filter("juan = 2 AND value IS NOT NULL").count() == 1
    put(files / "A1-002-baihua.md", volume("d"), 3)  # as long and as old as before
    assert run() == 0 and run(by_digest=True) == 3 and ("A1", 2, "d") in sections(spark, out)
    put(files / "A1-001-baihua.md", "# nothing left\n", 4)
    assert run() == 1 and [s for s in sections(spark, out) if s[1] == 1 and s[0] == "A1"] == []


def test_polls_take_up_where_the_last_ended(spark, tmp_path):
    files, ledger = tmp_path / "files", str(tmp_path / "ledger")
    files.mkdir()
    for i in range(5):
        put(files / f"A-{i:03d}-baihua.md", volume(str(i)), 9 - i)
    assert [v.poll_volumes(spark, str(files), ledger, max_files=2) for _ in range(4)] == [2, 2, 1, 0]
    got = [(r.poll, r.juan) for r in v._ledger(spark, ledger).orderBy("poll", "juan").collect()]
    assert got == [(1, 3), (1, 4), (2, 1), (2, 2), (3, 0)]


def test_the_last_entry_of_a_micro_batch_counts(spark, tmp_path):
    files, ledger, out = tmp_path / "files", str(tmp_path / "ledger"), str(tmp_path / "out")
    files.mkdir()
    for i in range(3):
        put(files / "A-001-baihua.md", volume(f"v{i}"), i)
        assert v.poll_volumes(spark, str(files), ledger) == 1
    v.stream_sections(spark, ledger, v.overwrite_volumes(out), str(tmp_path / "c")).awaitTermination()
    assert sections(spark, out) == [("A", 1, "v2")]


EVENT = "job_id long, juan int, state string, ts timestamp, seq long, resume_at timestamp"


def batch_rollup(spark, rows):
    """job_rollup() of all events so far."""
    latest = spark.createDataFrame(rows, EVENT).filter("ts IS NOT NULL").groupBy("job_id", "juan").agg(F.max_by(F.struct("state", "resume_at"), F.struct("ts", "seq")).alias("s")).select("job_id", "juan", "s.*")
    gone = latest.filter("juan IS NULL AND state = 'cancelled'")
    volumes = latest.withColumn("state", F.when(F.col("juan").isNotNull(), F.col("state")))
    return {r.job_id: (r.state, r.resume_at, r.failed, r.held) for r in jobs.job_rollup(volumes, gone).collect()}


def test_job_states_equal_the_rollup_after_each_micro_batch(spark, tmp_path):
    rng = random.Random(8)
    folder, start = str(tmp_path / "events"), dt.datetime(2026, 1, 1)
    rows, now = [], {}

    def sink(batch, _):
        now.update({r.job_id: (r.state, r.resume_at, r.failed, r.held) for r in batch.collect()})

    for part in range(4):  # each part is a run of its own, so the state is read back from the checkpoint
        new = []
        for i in range(40):
            state = rng.choice(["running", "queued", "done", "done", "failed", "held", "held"])
            ts = start + dt.timedelta(minutes=rng.randrange(0, 200))
            new.append((rng.randrange(6), rng.randrange(4), state, ts, part * 100 + i, ts + dt.timedelta(hours=1) if state == "held" else None))
        new += [(9, None, "cancelled" if part % 2 else "running", start + dt.timedelta(days=part), 1000 + part, None), (9, 1, "failed", start, part, None), (8, 1, "done", None, 1, None)]
        spark.createDataFrame(new, EVENT).coalesce(1).write.mode("append").parquet(folder)
        rows += new
        stream = streams.stream_job_rollup(spark.readStream.schema(EVENT).parquet(folder))
        stream.writeStream.outputMode("append").foreachBatch(sink).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
        assert now == batch_rollup(spark, rows)
    assert "failed" in {state for state, *_ in now.values()} and now[9][0] == "cancelled"


def test_log_tail_after_a_restart(spark, tmp_path):
    rng = random.Random(3)
    folder, start = str(tmp_path / "log"), dt.datetime(2026, 1, 1)
    rows, now = [], {}
    for part in range(3):
        new = [(rng.randrange(3), start + dt.timedelta(minutes=rng.randrange(50)), part * 50 + i, rng.choice([None, "m"])) for i in range(30)] + [(None, start, 1, "x"), (1, None, 2, "x")]
        spark.createDataFrame(new, "job_id long, ts timestamp, seq long, message string").coalesce(2).write.mode("append").parquet(folder)
        rows += new
        stream = streams.stream_log_tail(spark.readStream.schema("job_id long, ts timestamp, seq long, message string").option("maxFilesPerTrigger", 1).parquet(folder), 7)
        stream.writeStream.outputMode("update").foreachBatch(lambda b, _: now.update({r.job_id: (r.seqs, r.messages) for r in b.collect()})).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
        for job in range(3):
            want = sorted((r[1:] for r in rows if r[0] == job and r[1] is not None), key=lambda r: r[:2])[-7:]
            assert now[job] == ([w[1] for w in want], [w[2] for w in want])


def test_no_files(spark, tmp_path):
    (tmp_path / "files").mkdir()
    assert v.poll_volumes(spark, str(tmp_path / "files"), str(tmp_path / "ledger")) == 0


def test_a_job_of_many_volumes_takes_a_key_per_block(spark, tmp_path):
    folder, start, seen = str(tmp_path / "events"), dt.datetime(2026, 1, 1), {}
    for part, state in enumerate(("failed", "done")):
        new = [(1, i, state if i % 200 else "held", start + dt.timedelta(days=part), i, start if i % 200 == 0 else None) for i in range(-300, 300)]
        spark.createDataFrame(new, EVENT).coalesce(1).write.mode("append").parquet(folder)
        stream = streams.stream_job_rollup(spark.readStream.schema(EVENT).parquet(folder))
        query = stream.writeStream.outputMode("append").foreachBatch(lambda b, _: seen.update({r.job_id: (r.state, r.resume_at, r.failed, r.held) for r in b.collect()})).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        query.awaitTermination()
        held = [-200, 0, 200]
        assert seen[1] == (("failed", None, [i for i in range(-300, 300) if i % 200], held) if part == 0 else ("waiting_model", start, [], held))
        assert max(o.numRowsTotal for p in query.recentProgress for o in p.stateOperators) < 20


def test_a_table_of_volumes_is_read_again_without_a_file_for_each(spark, tmp_path):
    ledger, out = str(tmp_path / "ledger"), str(tmp_path / "out")

    def run(rows):
        v.append_volumes(spark.createDataFrame(rows, "work string, juan int, value string").coalesce(1), ledger)
        v.stream_sections(spark, ledger, v.append_batches(out), str(tmp_path / "c")).awaitTermination()
        return sorted((r.work, r.juan, r.source) for r in v.sections_of_batches(spark, out).collect())

    many = [("A", i, volume(f"v{i}", "w")) for i in range(50)]
    assert len(run([*many, ("B", 1, None)])) == 100
    n_files = sum(name.endswith(".parquet") for _, _, names in os.walk(out) for name in names)
    assert n_files <= 8
    got = run([("A", 0, volume("new")), ("A", 1, "# nothing left\n"), *many[2:]])
    assert got == sorted([("A", 0, "new"), *(("A", i, t) for i in range(2, 50) for t in (f"v{i}", "w"))])
    assert v._ledger(spark, ledger).filter("poll = 2").count() == 2
