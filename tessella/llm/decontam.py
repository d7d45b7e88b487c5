"""Benchmark decontamination by greedy string tiling.

Tokens are letter and digit runs, lower-cased. Every run of `seed` tokens of a document that also occurs in a benchmark item is a
seed; seeds are joined by hash, after a bitmap of fixed size has dropped most of what cannot match. A pair of document and item
goes on if its seeds could cover enough of the item. The tiling then takes, again and again, the longest
matches between unmarked tokens (found by Karp-Rabin hashes of a falling length), marks them, and stops at the seed length: so
a passage in another order is covered as well. A document is contaminated by an item if the tiles cover `coverage` of its tokens.

Null and empty texts, and items with fewer tokens than a seed, match nothing. Rows with the same doc_id are tiled one by
one and the best result counts; repeated items likewise. Rows without doc_id or item_id, and other columns, are not read.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from functools import partial
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkit import bitmap_of, checkpointed, in_bitmap, measured_side, quoted, small_side, span_hashes

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_APART = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))


def tokens_of(text: str | None) -> list[bytes]:
    return [] if text is None else text.lower().encode("utf-8", "surrogatepass").translate(_APART).split()


def _runs(tokens: list[bytes], seed: int) -> np.ndarray:
    return span_hashes(tokens, seed) if len(tokens) >= seed else np.empty(0, np.uint64)


def _windows(codes: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of so many codes."""
    powers, inverses = (np.multiply.accumulate(np.r_[np.uint64(1), np.full(len(codes) - 1, base, np.uint64)]) for base in (_BASE, _INVERSE))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * powers, dtype=np.uint64)])
    return (total[length:] - total[:-length]) * inverses[: len(codes) - length + 1]


def _open(free: np.ndarray, length: int) -> np.ndarray:
    """Where windows of so many unmarked tokens start."""
    total = np.concatenate([[0], np.cumsum(free)])
    return np.flatnonzero(total[length:] - total[:-length] == length)


def tiling(item: list[bytes], doc: list[bytes], least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiles (place in item, place in doc, length) of at least `least` tokens, longest first."""
    index = {t: i + 1 for i, t in enumerate(dict.fromkeys(item))}
    a = np.fromiter((index[t] for t in item), np.uint64, len(item))
    b = np.fromiter((index.get(t, 0) for t in doc), np.uint64, len(doc))
    free_a, free_b = np.ones(len(a), bool), b > 0
    tiles: list[tuple[int, int, int]] = []
    length = max(least, len(a))
    while length >= least:
        found = []
        if length <= min(len(a), len(b)):
            open_a, open_b = _open(free_a, length), _open(free_b, length)
            hash_a, hash_b = _windows(a, length), _windows(b, length)
            places: dict[int, list[int]] = {}
            for i in open_a.tolist():
                places.setdefault(int(hash_a[i]), []).append(i)
            hit = open_b[np.isin(hash_b[open_b], hash_a[open_a])]
            for j in hit.tolist():
                for i in places.get(int(hash_b[j]), ()):
                    if i and j and free_a[i - 1] and free_b[j - 1] and a[i - 1] == b[j - 1]:
                        continue  # a part of a longer match
                    n = 0
                    while i + n < len(a) and j + n < len(b) and free_a[i + n] and free_b[j + n] and a[i + n] == b[j + n]:
                        n += 1
                    if n >= length:
                        found.append((n, i, j))
            # a match that a tile has cut is looked at again as what is left of it
            matches = [(-n, i, j) for n, i, j in found]
            heapify(matches)
            while matches:
                n, i, j = heappop(matches)
                n = -n
                free = free_a[i : i + n] & free_b[j : j + n]
                if free.all():
                    free_a[i : i + n] = free_b[j : j + n] = False
                    tiles.append((i, j, n))
                    continue
                edges = np.flatnonzero(np.diff(np.r_[False, free, False]))
                for first, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                    if end - first >= length:
                        heappush(matches, (first - end, i + first, j + first))
        if length == least:
            break
        length = max(least, length // 2 if not found else min(length - 1, length // 2))
    return tiles


def _item_seeds(batches: Iterator[pd.DataFrame], seed: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for item_id, text in zip(batch.item_id, batch.text, strict=True):
            tokens = tokens_of(text)
            runs = _runs(tokens, seed).view(np.int64)
            yield pd.DataFrame({"seed": runs, "item_id": item_id, "place": np.arange(len(runs), dtype=np.int32), "n_item_tokens": np.int32(len(tokens))})


def _doc_seeds(batches: Iterator[pa.RecordBatch], seed: int, bits: Broadcast | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, seeds = [], []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            runs = _runs(tokens_of(text.as_py()), seed)
            if bits is not None:
                runs = runs[in_bitmap(bits.value, runs)]
            runs = np.unique(runs)
            if len(runs):
                ids.append(np.full(len(runs), doc_id, np.int64))
                seeds.append(runs)
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(seeds).view(np.int64))], ["doc_id", "seed"])


def _tiled(batches: Iterator[pd.DataFrame], seed: int, coverage: float) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for doc_id, item_id, text, item_text in zip(batch.doc_id, batch.item_id, batch.text, batch.item_text, strict=True):
            item = tokens_of(item_text)
            tiles = tiling(item, tokens_of(text), seed)
            covered = sum(n for _, _, n in tiles)
            if item and covered >= coverage * len(item):
                out.append((doc_id, item_id, len(item), covered, len(tiles), covered / len(item)))
        yield pd.DataFrame(out, columns=["doc_id", "item_id", "n_item_tokens", "n_tiled_tokens", "n_tiles", "coverage"])


def contaminations(docs: DataFrame, benchmark: DataFrame, seed: int = 5, coverage: float = 0.5) -> DataFrame:
    """doc_id, item_id, n_item_tokens, n_tiled_tokens, n_tiles, coverage: one row for each contaminated document and item."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id IS NOT NULL AND text IS NOT NULL")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("item_id IS NOT NULL AND text IS NOT NULL")
    item_seeds = checkpointed(items.mapInPandas(partial(_item_seeds, seed=seed), "seed long, item_id long, place int, n_item_tokens int"))
    bits = bitmap_of(item_seeds, "seed")
    bits = bits if bits is None else docs.sparkSession.sparkContext.broadcast(bits)
    doc_seeds = docs.mapInArrow(partial(_doc_seeds, seed=seed, bits=bits), "doc_id long, seed long")
    hits = doc_seeds.join(small_side(item_seeds, 64), "seed")
    # the most that tiles can cover: tokens of the item that lie in a seed
    places = F.sort_array(F.collect_set("place"))
    pairs = hits.groupBy("doc_id", "item_id", "n_item_tokens").agg(places.alias("places")).withColumn(
        "most", F.expr(f"aggregate(places, named_struct('n', 0, 'end', 0), (a, p) -> named_struct('n', a.n + least({seed}, p + {seed} - a.end), 'end', p + {seed}), a -> a.n)")
    )
    pairs = checkpointed(pairs.filter(F.col("most") >= coverage * F.col("n_item_tokens")).select("doc_id", "item_id").distinct())
    named = pairs.join(measured_side(items, "octet_length(text) + 64").withColumnRenamed("text", "item_text"), "item_id")
    both = docs.join(measured_side(named, "octet_length(item_text) + 64"), "doc_id").select("doc_id", "item_id", "text", "item_text")
    tiled = both.mapInPandas(partial(_tiled, seed=seed, coverage=coverage), "doc_id long, item_id long, n_item_tokens long, n_tiled_tokens long, n_tiles long, coverage double")
    best = tiled.groupBy("doc_id", "item_id").agg(F.max(F.struct("coverage", "n_item_tokens", "n_tiled_tokens", "n_tiles")).alias("m"))
    return best.select("doc_id", "item_id", "m.n_item_tokens", "m.n_tiled_tokens", "m.n_tiles", "m.coverage")


def decontaminated(docs: DataFrame, benchmark: DataFrame, seed: int = 5, coverage: float = 0.5) -> DataFrame:
    """The documents whose texts no benchmark item contaminates; each row is judged by its own text, with or without a doc_id."""
    key = next(name for name in ("text_key", *(f"text_key{i}" for i in range(len(docs.columns)))) if name not in docs.columns)
    keyed = docs.withColumn(key, F.xxhash64("text"))
    texts = keyed.select(F.col(key).alias("doc_id"), "text")
    found = contaminations(texts, benchmark, seed, coverage).select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(found, key, "left_anti").drop(key).select(*quoted(docs.columns))
