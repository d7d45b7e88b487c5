"""Hard negatives of anchors by Fagin's threshold algorithm.

Every row is scored in its own partition, in blocks with a sorted list of their components for each dimension. An anchor reads each list
from the end that its component's sign favours, some rows deeper at each step; rows that turn up for the first time are scored in full by
integer inner products (the random access). No row still unseen can score above the threshold, the sum over dimensions of the anchor's
component times the one last read. An anchor leaves a block when that is strictly below the k-th best score of each of its windows, or
below the window's least score. The k best of a window go on from block to block, so later blocks start with a high bar; a block
whose largest components cannot reach it is not read at all.

First the positives: one window, the rows of the anchor's label. Their scores bound a second search's windows over other labels.
Anchors travel to the tasks in chunks of bounded bytes, one search per chunk; the rows themselves are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .textkit import checkpointed

SCALE = 256
BEST = 5
LOW, HIGH = 80, 100  # percent of the positive's score
CHUNK_BYTES = 16 << 20  # of anchors that one search holds
_BLOCK_ROWS = 8_192
_TILE = 256  # anchors that read a block's lists together
_STEPS = (64, 16, 4, 1)  # parts of a block that are read by then

SAME, OTHER = "same", "other"
FOUND = "anchor long, window int, row_id long, score long"


@dataclass
class Chunk:
    """Anchors of one vector length: their key, id, label, vectors, and each window's least and largest score (inf and -inf where there is none)."""

    key: np.ndarray
    row_id: np.ndarray
    label: np.ndarray
    x: np.ndarray
    low: np.ndarray
    high: np.ndarray


def inner(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-numbered rows: in doubles while those hold them, else as integers of any size."""
    if np.abs(a).max(initial=0) * np.abs(x).max(initial=0) * a.shape[1] < 2**53:
        return a @ x.T
    whole = np.vectorize(int, otypes=[object])
    return whole(a) @ whole(x).T


class Best:
    """The k best rows of each anchor's windows so far: by score, then the smaller id, rows without one last."""

    def __init__(self, chunk: Chunk, k: int) -> None:
        self.k, self.windows = k, chunk.low.shape[1]
        self.bar = chunk.low.copy()  # a row must reach this
        self.slot, self.row_id, self.null, self.score = np.empty(0, int), np.empty(0, np.int64), np.empty(0, bool), np.empty(0)

    def add(self, slot: np.ndarray, row_id: np.ndarray, null: np.ndarray, score: np.ndarray) -> None:
        slot, row_id, null, score = (np.concatenate(x) for x in ((self.slot, slot), (self.row_id, row_id), (self.null, null), (self.score, score)))
        order = np.lexsort((row_id, null, -score, slot))
        slot = slot[order]
        first = np.searchsorted(slot, slot)
        keep = np.arange(len(slot)) - first < self.k
        order, slot, first = order[keep], slot[keep], first[keep]
        self.slot, self.row_id, self.null, self.score = slot, row_id[order], null[order], score[order]
        last = np.searchsorted(slot, slot) + self.k - 1 == np.arange(len(slot))
        if self.score.dtype == object:
            self.bar = self.bar.astype(object)  # doubles would round it
        bar = self.bar.ravel()
        bar[slot[last]] = self.score[last]  # what was added had reached the bar before

    def open(self) -> np.ndarray:
        """For each anchor, the least score that could still enter one of its windows."""
        return self.bar.min(1)


def search_block(chunk: Chunk, best: Best, row_id: np.ndarray, null: np.ndarray, label: np.ndarray, x: np.ndarray, rule: str) -> int:
    """Let the chunk's anchors search a block; the number of inner products taken."""
    lists = np.argsort(x, axis=0, kind="stable")
    ordered = np.take_along_axis(x, lists, 0)
    size, taken = len(x), 0
    for first in range(0, len(chunk.key), _TILE):
        tile = np.arange(first, min(first + _TILE, len(chunk.key)))
        a = chunk.x[tile]
        up, down = np.maximum(a, 0), np.minimum(a, 0)
        threshold = inner(np.hstack([up, down]), np.hstack([ordered[-1:], ordered[:1]]))[:, 0]
        seen, depth = np.zeros(size, bool), 0
        for part in _STEPS:
            active = tile[threshold >= best.open()[tile]]
            if not len(active):
                break
            reach = max(depth, -(-size // part))
            now = chunk.x[active]
            turned_up = np.zeros(size, bool)
            turned_up[lists[size - reach : size - depth, (now > 0).any(0)]] = True
            turned_up[lists[depth:reach, (now < 0).any(0)]] = True
            if not a.any() or part == 1:
                turned_up[:] = True  # where all components are zero no list is read, yet each row scores zero
            rows = np.flatnonzero(turned_up & ~seen)
            seen |= turned_up
            _score(chunk, best, active, row_id[rows], null[rows], label[rows], x[rows], rule)
            taken += len(active) * len(rows)
            depth = reach
            if part == 1:
                break
            threshold = inner(np.hstack([up, down]), np.hstack([ordered[size - depth][None], ordered[depth - 1][None]]))[:, 0]
    return taken


def _score(chunk: Chunk, best: Best, active: np.ndarray, row_id: np.ndarray, null: np.ndarray, label: np.ndarray, x: np.ndarray, rule: str) -> None:
    if not len(row_id):
        return
    scores = inner(chunk.x[active], x)
    if chunk.high.dtype == object:
        scores = scores.astype(object)
    same = chunk.label[active][:, None] == label
    fits = same & ((chunk.row_id[active][:, None] != row_id) | null) if rule == SAME else ~same
    for window in range(best.windows):
        bar, high = best.bar[active, window], chunk.high[active, window]
        at, row = np.nonzero(fits & (scores >= bar[:, None]) & ~(scores > high[:, None]))
        if len(at):
            best.add(active[at] * best.windows + window, row_id[row], null[row], scores[at, row])


def _searched(batches: Iterator[pa.RecordBatch], chunks: Broadcast, rule: str, k: int) -> Iterator[pa.RecordBatch]:
    """The k best of each window among the rows of a partition."""
    by_length: dict[int, Chunk] = chunks.value
    best = {d: Best(chunk, k) for d, chunk in by_length.items()}
    held: dict[int, list] = {d: [] for d in by_length}
    count = dict.fromkeys(by_length, 0)

    def search(d: int) -> None:
        if held[d]:
            search_block(by_length[d], best[d], *(np.concatenate(part) for part in zip(*held[d], strict=True)), rule)
            held[d], count[d] = [], 0

    for batch in batches:
        lengths = batch.column(2).value_lengths().to_numpy()
        null = batch.column(0).is_null().to_numpy(zero_copy_only=False)
        row_id, label = batch.column(0).fill_null(0).to_numpy(), batch.column(1).to_numpy()
        for d in by_length:
            of = np.flatnonzero(lengths == d)
            for part in (of[i : i + _BLOCK_ROWS] for i in range(0, len(of), _BLOCK_ROWS)):
                vectors = batch.column(2).take(pa.array(part)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(part), d)
                held[d].append((row_id[part], null[part], label[part], np.floor(SCALE * vectors)))
                count[d] += len(part)
                if count[d] >= _BLOCK_ROWS:
                    search(d)
    for d, chunk in by_length.items():
        search(d)
        b = best[d]
        anchor, window = np.divmod(b.slot, b.windows)
        score = pa.array([max(-(1 << 63), min((1 << 63) - 1, int(s))) for s in b.score], pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(chunk.key[anchor]), pa.array(window.astype(np.int32)), pa.array(b.row_id, pa.int64(), mask=b.null), score], ["anchor", "window", "row_id", "score"])


def _bounds(rows: pd.DataFrame, rule: str) -> list[np.ndarray]:
    """The least and largest scores of the anchors' windows: one without bounds for positives, one for each positive for negatives."""
    if rule == SAME:
        return [np.full((len(rows), 1), -np.inf), np.full((len(rows), 1), np.inf)]
    out = [np.array([[none if v is None or v != v else int(v) for v in row] for row in rows[c]], object) for c, none in (("lows", np.inf), ("highs", -np.inf))]
    large = any(abs(v) >= 2**53 for v in out[1].ravel() if v != -np.inf)
    return out if large else [x.astype(float) for x in out]


def _chunks(anchors: DataFrame, chunk: int, rule: str) -> dict[int, Chunk]:
    """The anchors of a chunk, by the length of their vectors."""
    found = anchors.filter(F.col("chunk") == chunk).toPandas()
    out = {}
    for d, rows in found.groupby(found["vector"].map(len)):
        bounds = _bounds(rows, rule)
        out[int(d)] = Chunk(rows["anchor"].to_numpy(), rows["vec_id"].to_numpy(), rows["label"].to_numpy(), np.floor(SCALE * np.stack(rows["vector"]).astype(float)).reshape(len(rows), int(d)), *bounds)
    return out


def search(rows: DataFrame, anchors: DataFrame, n_chunks: int, rule: str, k: int) -> DataFrame:
    """rows (vec_id, label, vector) and anchors (anchor, vec_id, label, vector, chunk; lows, highs for negatives) -> anchor, window, rank, row_id, score."""
    sc = rows.sparkSession.sparkContext
    found = None
    for chunk in range(n_chunks):
        part = rows.mapInArrow(partial(_searched, chunks=sc.broadcast(_chunks(anchors, chunk, rule)), rule=rule, k=k), FOUND)
        found = part if found is None else found.union(part)
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.asc_nulls_last("row_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(embeddings: DataFrame, every: int = 100, k: int = BEST, vector: str = "embedding", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """embeddings (vec_id, label, vector) -> anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose vec_id is divisible by `every`; rows repeated in all columns are one anchor, but count as candidates as
    often as they occur. Rows with the anchor's vec_id are not its positives. Rows with a null label or vector, or any null or non-finite
    component, take no part; rows without vec_id may be found and come last among equal scores. Vectors score with those of their own length; empty ones
    score 0. A window without rows returns none; scores beyond a long are returned as the nearest long. Other columns are not read.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    rows = rows.filter(F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    anchors = checkpointed(rows.filter(F.col("vec_id") % every == 0).distinct().withColumn("anchor", F.monotonically_increasing_id()))
    size = anchors.agg(F.sum(F.size("vector") * 8 + 64 * (k + 1))).first()[0] or 0
    n_chunks = 1 + size // chunk_bytes
    anchors = anchors.withColumn("chunk", F.pmod(F.xxhash64("anchor"), F.lit(n_chunks)))
    positives = checkpointed(search(rows, anchors, n_chunks, SAME, k))
    slots = F.sequence(F.lit(1), F.lit(k))
    bounds = positives.groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("rank", "score"))).alias("scores"))
    least = lambda s: F.ceil(s.cast("decimal(24,0)") * LOW / HIGH).cast("long")
    score = lambda r: F.try_element_at("scores", r)
    windows = anchors.join(bounds, "anchor").withColumns({"lows": F.transform(slots, lambda r: least(score(r))), "highs": F.transform(slots, score)})
    negatives = search(rows, checkpointed(windows.drop("scores")), n_chunks, OTHER, k).withColumn("window", F.col("window") + 1)
    named = anchors.select("anchor", F.col("vec_id").alias("anchor_id")).join(positives.select("anchor", F.col("rank").alias("window"), F.col("row_id").alias("positive_id"), F.col("score").alias("positive_score")), "anchor")
    out = negatives.join(named, ["anchor", "window"])
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("row_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
