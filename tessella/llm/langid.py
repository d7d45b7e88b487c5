"""Language identification by the nearest of several centroids per language.

A text is the vector of its byte n-grams, one to three bytes within words, hashed to a fixed number of places, with damped counts
times inverse document frequency, at length 1. Document frequencies cover all training texts. Centroids come from spherical
k-means per language over a bounded sample of training texts (`per_language`). The answer is the language of the centroid
with the largest cosine, the first by language and vector of those that are equally near. A text is rejected if it is further from that
centroid than `outliers` of the texts that the centroid was fitted on. One that is null or has no letter is und.

Neither the language nor the source nor the id of a text goes into its prediction. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lm import held_out
from .textkit import checkpointed, small_side

PLACES = 4096
_NOT_LETTERS = bytes.maketrans(bytes(b for b in range(128) if not chr(b).isalpha()), b" " * sum(not chr(b).isalpha() for b in range(128)))
_ROWS = 256


def grams(text: str) -> np.ndarray:
    """Counts of the hashed n-grams of a text."""
    raw = b" " + b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_NOT_LETTERS).split()) + b" "
    a = np.frombuffer(raw, np.uint8).astype(np.uint32)
    two = a[:-1] * np.uint32(0x9E3779B1) + a[1:]
    three = two[:-1] * np.uint32(0x85EBCA77) + a[2:]
    mixed = [(x * np.uint32(0xC2B2AE3D + 2 * i)) >> np.uint32(20) for i, x in enumerate((a, two, three))]
    return np.bincount(np.concatenate(mixed), minlength=PLACES)[:PLACES]


def vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    x = np.array([grams(t) for t in texts], np.float32).reshape(-1, PLACES)
    np.log1p(x, out=x)
    x *= idf
    length = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.maximum(length, 1e-12)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.zeros(PLACES, np.int64)
    n = 0
    for batch in batches:
        for text in batch.column(0):
            seen += grams(text.as_py()) > 0
            n += 1
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, PLACES)), pa.array(np.r_[n, seen])], ["place", "n"])


def _clusters(frame: pd.DataFrame, idf: np.ndarray, k: int, outliers: float, turns: int = 12) -> pd.DataFrame:
    """Spherical k-means of one language's sample, from spread-out starts; and the cosine that all but the outliers of a centroid's texts reach."""
    frame = frame.sort_values(["doc_id", "text"])
    x = vectors(frame.text.tolist(), idf)
    chosen = [int(np.argmax(x @ x.mean(0)))]
    while len(chosen) < min(k, len(x)):
        chosen.append(int(np.argmin((x @ x[chosen].T).max(1))))
    centres = x[chosen]
    for _ in range(turns):
        nearest = (x @ centres.T).argmax(1)
        sums = np.array([x[nearest == c].sum(0) if (nearest == c).any() else centres[c] for c in range(len(centres))])
        centres = sums / np.maximum(np.sqrt((sums * sums).sum(1, keepdims=True)), 1e-12)
    cosines = x @ centres.T
    nearest = cosines.argmax(1)
    floors = [float(np.quantile(own, outliers)) if len(own := cosines[nearest == c, c]) else 1.0 for c in range(len(centres))]
    return pd.DataFrame({"lang": frame.lang.iloc[0], "centre": [c.tolist() for c in centres], "floor": floors})


def train(labelled: DataFrame, k: int = 4, per_language: int = 1200, outliers: float = 0.005) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
    """(doc_id, text, lang) -> inverse document frequencies, and the language, vector and least cosine of each centroid.

    Each language's centroids are fitted on about per_language of its texts, those with the least hash of doc_id.
    """
    usable = labelled.filter("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    counts = usable.select("text").mapInArrow(_frequencies, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()
    seen = np.zeros(PLACES + 1)
    for r in counts:
        seen[r.place + 1] = r.n
    idf = (np.log((1 + seen[0]) / (1 + seen[1:])) + 1).astype(np.float32)
    languages = checkpointed(usable.groupBy("lang").agg(F.count("*").alias("n")))
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = usable.join(small_side(languages, 256), "lang").filter(share * F.col("n") < per_language).drop("n")
    sample = checkpointed(sample)
    rows = sample.groupBy("lang").applyInPandas(partial(_clusters, idf=idf, k=k, outliers=outliers), "lang string, centre array<float>, floor double").collect()
    rows.sort(key=lambda r: (r.lang, r.centre))
    return idf, [r.lang for r in rows], np.array([r.centre for r in rows], np.float32).reshape(-1, PLACES), np.array([r.floor for r in rows])


def _predicted(batches: Iterator[pa.RecordBatch], model: Broadcast) -> Iterator[pa.RecordBatch]:
    idf, names, centres, floors = model.value
    for batch in batches:
        for first in range(0, batch.num_rows, _ROWS):
            part = batch.slice(first, _ROWS)
            texts = [t.as_py() for t in part.column(part.schema.get_field_index("text"))]
            known = [i for i, t in enumerate(texts) if t is not None and any(map(str.isalpha, t))] if names else []
            langs, scores, far = ["und"] * len(texts), [0.0] * len(texts), [True] * len(texts)
            if known:
                cosines = vectors([texts[i] for i in known], idf) @ centres.T
                for i, best, score in zip(known, cosines.argmax(1).tolist(), cosines.max(1).tolist(), strict=True):
                    langs[i], scores[i], far[i] = names[best], min(max(score, 0.0), 1.0), bool(score < floors[best])
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(far)], [*part.schema.names, "lang_pred", "score", "rejected"])


def predict(docs: DataFrame, model: tuple) -> DataFrame:
    """Adds lang_pred, score and rejected (replacing columns so named)."""
    docs = docs.drop("lang_pred", "score", "rejected")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    return docs.mapInArrow(partial(_predicted, model=shared), f"{schema}, lang_pred string, score double, rejected boolean")


def identify(docs: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """documents -> doc_id, held_out, lang_pred, score, rejected, one row per row. Learns from rows whose crc32(doc_id) is not in the fold; rows without doc_id are held out.

    Without any labelled training text every prediction is und, and und is always rejected. Repeated rows count as often as they occur. A rejected text
    keeps the language of its nearest centroid, for the caller to drop.
    """
    named = docs.select("doc_id", "text", "lang", held_out(F.col("doc_id"), folds, fold).alias("held_out"))
    model = train(named.filter("NOT held_out"))
    return predict(named.select("doc_id", "held_out", "text"), model).drop("text")
