"""Repeated byte strings by a depth-limited radix sort of suffixes.

A suffix is ordered only through its first `threshold` bytes, by passes of rising depth; a group that a
pass leaves with one member holds no repeat and drops out. The passes, each a Spark grouping:

1. first digit, 64 bytes: suffixes start at anchors, the places that hold the least digit of some window of `threshold` bytes, where
   a digit is a hash of the next 64 bytes (a power of two, up to half the threshold). Equal windows hold
   equal anchors at equal offsets, so no repeat is missed.
2. all bytes of the windows that have this anchor: anchors with equal surroundings are settled whole.
3. other members of a group of the first pass: the bytes common to half of the possible window starts, then to an eighth.
4. the same block, start by start, to the full depth: equal groups are exactly the repeated windows.

Each pass takes the groups of the one before it apart by further bytes, up to the threshold: the bytes of a half block lie around the first digit, those of
an eighth around those of the half, and the window around all of them. Where the groups after the second pass have one kind of surroundings, no further bytes are looked at.

Windows through one anchor overlap, so what repeats around it is one run of bytes from the first to the last.
No pass collects a group: each is a count per key and a join back, so a hot key can be split.
Digits beyond the first pass are 64-bit hashes.

Null and empty texts have no bytes. Rows with the same doc_id but other texts stay apart by their text's 64-bit
hash, rows without doc_id by 128 bits; a repeated row counts as another document. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkit import bitmap_of, checkpointed, in_bitmap, mix, sliding_min, small_side, window_hashes

BLOCKS = 8
_CHUNK = 1 << 22  # bytes looked at together in a long text; the low bits of a sort key hold the place
_ANCHORS = pa.schema([("row", pa.int64()), ("copy", pa.int64()), ("pos", pa.int64()), ("low", pa.int16()), ("high", pa.int16()), ("digit", pa.int64()), ("around", pa.int64())])


def depth_log(threshold: int) -> int:
    """The logarithm of the number of bytes in the first digit."""
    return int(threshold // 2).bit_length() - 1


def anchor_places(data: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The anchors of one text: places, digits, and the first and last start of the windows that have this anchor."""
    width = threshold - (1 << depth_log(threshold)) + 1
    out: tuple[list, ...] = ([], [], [], [])
    for first in range(0, max(0, len(data) - threshold + 1), _CHUNK):
        h = window_hashes(data[first : first + _CHUNK + threshold - 1], depth_log(threshold))
        key = (mix(h) >> np.uint64(24) << np.uint64(24)) | np.arange(len(h), dtype=np.uint64)
        of_window = (sliding_min(key, width) & np.uint64((1 << 24) - 1)).astype(np.int64)
        at, start, n = np.unique(of_window, return_index=True, return_counts=True)
        for column, values in zip(out, (at + first, h[at], start + first, start + first + n - 1), strict=True):
            column.append(values)
    if not out[0]:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    at, digits, starts, ends = map(np.concatenate, out)
    # an anchor with windows on both sides of a border is one
    at, first = np.unique(at, return_index=True)
    return at, digits[first], np.minimum.reduceat(starts, first), np.maximum.reduceat(ends, first)


def _digits(batches: Iterator[pa.RecordBatch], threshold: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [anchor_places(np.frombuffer(raw.as_buffer(), np.uint8), threshold)[1] for raw in batch.column(2) if raw.is_valid and raw.as_buffer().size >= threshold]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], ["digit"])


def _anchors(batches: Iterator[pa.RecordBatch], threshold: int, bits: Broadcast | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns: tuple[list, ...] = ([], [], [], [], [], [], [])
        for row, copy, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            raw = raw.as_buffer()
            if raw is None or raw.size < threshold:
                continue
            at, digits, first, last = anchor_places(np.frombuffer(raw, np.uint8), threshold)
            if bits is not None:
                may = in_bitmap(bits.value, digits)
                at, digits, first, last = at[may], digits[may], first[may], last[may]
            view, low, high = memoryview(raw), at - last, at - first
            around = np.fromiter((xxhash.xxh3_64_intdigest(view[f : l + threshold], seed=s) for f, l, s in zip(first.tolist(), last.tolist(), low.tolist())), np.uint64, len(at))
            values = (np.full(len(at), row, np.int64), np.full(len(at), copy, np.int64), at, low.astype(np.int16), high.astype(np.int16), digits.view(np.int64), around.view(np.int64))
            for column, value in zip(columns, values, strict=True):
                column.append(value)
        if columns[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], schema=_ANCHORS)


def _summary(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for doc_id, raw, spans in zip(batch.doc_id, batch.raw, batch.spans, strict=True):
            raw, spans = raw or b"", sorted((max(0, s["first"]), s["last"]) for s in spans) if spans is not None else []
            merged: list[list[int]] = []
            for first, last in spans:
                last = min(last, len(raw))
                if merged and first <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], last)
                else:
                    merged.append([first, last])
            digest, done = hashlib.sha256(), 0
            for first, last in merged:
                digest.update(memoryview(raw)[done:first])
                done = last
            digest.update(memoryview(raw)[done:])
            out.append((doc_id, len(raw), sum(b - a for a, b in merged), len(merged), digest.hexdigest(), merged))
        yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"]).astype({"doc_id": "Int64"})


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, row, copy, raw): row and copy tell texts apart, also where a doc_id is null or repeated."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.lit("row"), "text")).alias("row"),
        F.xxhash64("text").alias("copy"), F.col("text").cast("binary").alias("raw"),
    )


def repeated_spans(docs: DataFrame, threshold: int = 200) -> DataFrame:
    """The output of keyed() -> (row, copy, spans array<struct<first, last>>), spans in order, their ends not yet cut to the text; only rows with a repeat."""
    reach = threshold - (1 << depth_log(threshold))
    if reach < BLOCKS:
        raise ValueError("threshold must be 16 bytes at least")
    docs = docs.select("row", "copy", "raw")
    digits = docs.mapInArrow(partial(_digits, threshold=threshold), "digit long")
    again = checkpointed(digits.groupBy("digit").agg(F.count("*").alias("n")).filter("n > 1").select("digit"))
    bits = bitmap_of(again, "digit")
    bits = bits if bits is None else docs.sparkSession.sparkContext.broadcast(bits)
    anchors = docs.mapInArrow(partial(_anchors, threshold=threshold, bits=bits), "row long, copy long, pos long, low short, high short, digit long, around long")
    # what the bitmap lets through by chance is alone in its group and drops out below
    found = checkpointed(anchors if bits else anchors.join(again, "digit", "left_semi"))

    contexts = found.groupBy("digit", "around").agg(F.count("*").alias("n"), F.min(F.struct("row", "pos", "copy", "low", "high")).alias("at"))
    contexts = checkpointed(contexts.select("digit", "around", "n", "at.*"))
    several = contexts.groupBy("digit").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).filter("kinds > 1 AND least = 1").select("digit")
    # one member of each kind brings its bytes
    open_ = contexts.join(several, "digit", "left_semi").groupBy("row", "copy").agg(F.collect_list(F.struct("pos", "low", "high", "digit", "around")).alias("at"))
    open_ = checkpointed(open_)
    cut = f"substring(raw, int(greatest(0, pos - {reach}) + 1), int(least({reach}, pos)) + {threshold})"
    pieces = checkpointed(
        docs.join(_fitting(open_, "at"), ["row", "copy"]).select("raw", F.inline("at"))
        .select("digit", "around", "low", "high", F.least("pos", F.lit(reach)).cast("int").alias("before"), F.expr(cut).alias("bytes"))
    )
    halves = _blocks(pieces, "digit", 2, reach, threshold)
    alike = halves.groupBy("core").agg((F.min("around") < F.max("around")).alias("several")).filter("several").select("core")
    halves = checkpointed(halves.join(alike, "core", "left_semi").select("digit", "around", "first", "last", F.col("core").alias("half")))

    # a hull that two kinds share settles its block; else one kind for each hull goes through the block start by start
    near = pieces.join(halves, ["digit", "around"]).withColumns({"low": F.greatest("low", "first"), "high": F.least("high", "last")}).drop("first", "last")
    blocks = _blocks(near, "half", BLOCKS, reach, threshold)
    kinds = checkpointed(blocks.groupBy("core", "hull").agg(F.min("around").alias("around"), F.max("around").alias("other")))
    split = kinds.groupBy("core").agg((F.min("hull") < F.max("hull")).alias("several")).filter("several").select("core")
    by_hull = blocks.join(kinds.filter("around < other").select("core", "hull"), ["core", "hull"], "left_semi").select("digit", "around", F.greatest("low", "first").alias("low"), F.least("high", "last").alias("high"))
    single = kinds.join(split, "core", "left_semi").select("core", "hull", "around")
    starts = checkpointed(blocks.join(single, ["core", "hull", "around"], "left_semi").select("digit", "around", "first", "last", "core"))
    windows = pieces.join(starts, ["digit", "around"]).withColumn("start", F.explode(F.sequence(F.greatest("low", "first"), F.least("high", "last"))))
    window = F.xxhash64("core", "start", F.expr(f"substring(bytes, before - start + 1, {threshold})"))
    windows = checkpointed(windows.select("digit", "around", F.col("start").cast("short").alias("start"), window.alias("window")))
    equal = windows.groupBy("window").agg((F.min("around") < F.max("around")).alias("several")).filter("several").select("window")
    by_start = windows.join(equal, "window", "left_semi").select("digit", "around", F.col("start").alias("low"), F.col("start").alias("high"))
    whole = contexts.filter("n > 1").select("digit", "around", "low", "high")
    settled = checkpointed(whole.union(by_hull).union(by_start).groupBy("digit", "around").agg(F.min("low").alias("low"), F.max("high").alias("high")))

    span = F.struct((F.col("pos") - F.col("high")).alias("first"), (F.col("pos") - F.col("low") + threshold).alias("last"))
    # settled is a table, so that both sides of the join are dealt anew and a passage with very many anchors can be split
    spans = found.drop("low", "high").join(small_side(settled, 64), ["digit", "around"]).groupBy("row", "copy").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    # runs that overlap become one
    joined = """aggregate(spans, cast(array() as array<struct<first: bigint, last: bigint>>), (done, s) ->
        if(size(done) > 0 and s.first <= done[size(done) - 1].last,
           concat(slice(done, 1, size(done) - 1), array(named_struct('first', done[size(done) - 1].first, 'last', greatest(done[size(done) - 1].last, s.last)))),
           concat(done, array(s))))"""
    return spans.select("row", "copy", F.expr(joined).alias("spans"))


def _blocks(pieces: DataFrame, group: str, n: int, reach: int, threshold: int) -> DataFrame:
    """The n blocks of starts that a piece's windows lie in: first and last start, the group by what all windows of the block hold (core), within
    the group of the pass before, and all that they touch (hull)."""
    step = (reach + 1) // n
    number = F.explode(F.sequence(F.least(F.expr(f"int(low div {step})"), F.lit(n - 1)), F.least(F.expr(f"int(high div {step})"), F.lit(n - 1))))
    last = F.when(F.col("block") < n - 1, (F.col("block") + 1) * step - 1).otherwise(reach)
    blocks = pieces.withColumn("block", number).withColumns({"first": F.col("block") * step, "last": last})
    core = F.expr(f"substring(bytes, before - first + 1, {threshold} + first - last)")
    hull = F.expr(f"substring(bytes, greatest(before - last, 0) + 1, least(before, last) - first + {threshold})")
    return blocks.select("digit", "around", "low", "high", "first", "last", F.xxhash64(group, "block", core).alias("core"), F.xxhash64(F.greatest(F.col("last") - F.col("before"), F.lit(0)), hull).alias("hull"))


def _fitting(found: DataFrame, column: str, limit: int = 48 << 20) -> DataFrame:
    """Mark a materialised table with an array column for broadcast if its measured size fits the limit; else leave the join to shuffle."""
    size = found.agg(F.sum(F.size(column) * 32 + 64)).first()[0] or 0
    return F.broadcast(found) if size <= limit else found


def remove_repeats(docs: DataFrame, threshold: int = 200) -> DataFrame:
    """documents -> doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed (the maximal removed runs, as pairs of first byte and end)."""
    docs = keyed(docs)
    spans = checkpointed(repeated_spans(docs, threshold))
    merged = docs.join(_fitting(spans, "spans"), ["row", "copy"], "left").select("doc_id", "raw", "spans")
    return merged.mapInPandas(_summary, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<array<long>>")
