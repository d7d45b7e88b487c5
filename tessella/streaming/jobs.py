"""Incremental forms of the batch transforms on Structured Streaming.

State is kept in RocksDB: a value per job and block of volumes, a map of open blocks per job, a list of log rows per job. The functions that need that
store set it for the session, as Spark asks for it when a query starts; queries that were started before keep the one of their checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

BLOCKS = "job_id long, block long, failed array<int>, held array<int>, resume_at long, gone boolean"
ROLLUP = "job_id long, state string, resume_at long, failed array<int>, held array<int>"
BLOCK = 128  # neighbouring volumes of a job whose states are one value
WHOLE = -(2**31)  # the block of events that speak of the whole job, below those of all volumes


def _in_rocks(events: DataFrame) -> DataFrame:
    events.sparkSession.conf.set(STORE, ROCKS)
    return events


def _none(x):
    return None if x is None or x is pd.NaT or x != x else x


def _instant(x):
    """A pandas time as what the state store takes; null stays null."""
    x = _none(x)
    return None if x is None else pd.Timestamp(x).to_pydatetime()


class _Latest(StatefulProcessor):
    """Per job and block of volumes: the state with the greatest (ts, seq) of each volume. Gives what is failed and held in the block where a volume changed."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", "juans array<int>, states array<string>, ts array<long>, seqs array<long>, resumes array<long>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self.latest.get()
        best = {juan: rest for juan, *rest in zip(*known, strict=True)} if known else {}
        changed = False
        for _, _, juan, state, ts, seq, resume in rows:
            last = best.get(juan)
            if last is None or (ts, seq) > (last[1], last[2]):
                best[juan] = (state, ts, seq, resume)
                changed = True
        if changed:
            self.latest.update((list(best), *map(list, zip(*best.values(), strict=True))))
            volumes = {juan: (state, resume) for juan, (state, _, _, resume) in best.items() if juan is not None}
            failed, held = (sorted(juan for juan, (state, _) in volumes.items() if state == of) for of in ("failed", "held"))
            resume = min((r for state, r in volumes.values() if state == "held" and r is not None), default=None)
            gone = best[None][0] == "cancelled" if None in best else None
            yield Row(job_id=key[0], block=key[1], failed=failed, held=held, resume_at=resume, gone=gone)

    def close(self) -> None:
        pass


class _Rollup(StatefulProcessor):
    """Per job: its blocks with failed or held volumes, and whether it was cancelled. Other blocks take no state. Gives the job's row whenever one of its volumes changed."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getMapState("open", "block long", "failed array<int>, held array<int>, resume_at long")
        self.gone = handle.getValueState("gone", "gone boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        for _, block, failed, held, resume, gone in rows:
            if gone is not None:
                self.gone.update((gone,))
            elif failed or held:
                self.open.updateValue((block,), (failed, held, resume))
            elif self.open.containsKey((block,)):
                self.open.removeKey((block,))
        blocks = [v for _, v in sorted(self.open.iterator())]
        failed, held = ([juan for v in blocks for juan in v[i]] for i in (0, 1))
        gone = self.gone.get()
        state = "cancelled" if gone and gone[0] else "failed" if failed else "waiting_model" if held else "done"
        resume = min((v[2] for v in blocks if v[2] is not None), default=None) if state == "waiting_model" else None
        yield Row(job_id=key[0], state=state, resume_at=resume, failed=failed, held=held)

    def close(self) -> None:
        pass


class _Tail(StatefulProcessor):
    """Per job: its last n log rows, as a list. Gives the list whenever it grew."""

    n = 50

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getListState("rows", "ts timestamp, seq long, message string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        kept = [(_instant(ts), seq, message) for ts, seq, message in self.rows.get()] if self.rows.exists() else []
        for frame in rows:
            kept += [(_instant(ts), int(seq), _none(message)) for ts, seq, message in zip(frame.ts, frame.seq, frame.message, strict=True)]
            kept = sorted(kept, key=lambda r: r[:2])[-self.n :]
        self.rows.put(kept)
        yield pd.DataFrame({"job_id": [key[0]], "seqs": [[r[1] for r in kept]], "messages": [[r[2] for r in kept]]})

    def close(self) -> None:
        pass


def stream_job_status(events: DataFrame) -> DataFrame:
    """Streaming events (job_id, juan, state, ts, seq) -> the latest state per job and volume; one row of state per key."""
    latest = F.max_by(F.struct("state", "ts"), F.struct("ts", "seq"))
    return events.groupBy("job_id", "juan").agg(latest.alias("s")).select("job_id", "juan", "s.state", "s.ts")


def stream_job_rollup(events: DataFrame) -> DataFrame:
    """Streaming events (job_id, juan, state, ts, seq, resume_at) -> job_id, state, resume_at, failed, held: what job_rollup() gives, for each job with a change, after each micro-batch.

    Two stateful steps in one stream: the latest states of each block of volumes, so a job with very many volumes is many keys, and the failed and held
    volumes of each job, from changes only. Both take a call of the state store per key and micro-batch, not per volume. Of events with equal (ts, seq) the first
    to come counts. Events without job, ts or seq are left out. An event without juan speaks of the whole job: it is cancelled from one in state cancelled until
    a later one in another state. To be written in append mode.
    """
    placed = events.filter("job_id IS NOT NULL AND ts IS NOT NULL AND seq IS NOT NULL")
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp")).alias(c)
    block = F.coalesce(F.floor(F.col("juan") / BLOCK), F.lit(WHOLE)).cast("long")
    named = placed.select(F.col("job_id").cast("long").alias("job_id"), block.alias("block"), F.col("juan").cast("int").alias("juan"), "state", micros("ts"), F.col("seq").cast("long").alias("seq"), micros("resume_at"))
    latest = _in_rocks(named).groupBy("job_id", "block").transformWithState(_Latest(), BLOCKS, "Append", "None")
    rollup = latest.groupBy("job_id").transformWithState(_Rollup(), ROLLUP, "Append", "None")
    return rollup.select("job_id", "state", F.timestamp_micros("resume_at").alias("resume_at"), "failed", "held")


def stream_log_tail(log: DataFrame, n: int = 50) -> DataFrame:
    """Streaming log (job_id, ts, seq, message) -> job_id, seqs, messages: after each micro-batch the last n rows of each job with new ones. Rows without job, ts or seq are left out. To be written in update mode."""
    tail = _Tail()
    tail.n = n
    placed = log.select("job_id", "ts", "seq", "message").filter(F.col("job_id").isNotNull() & F.col("ts").isNotNull() & F.col("seq").isNotNull())
    return _in_rocks(placed).groupBy("job_id").transformWithStateInPandas(tail, "job_id long, seqs array<long>, messages array<string>", "Update", "None")
