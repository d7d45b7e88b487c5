"""Vectorised text helpers shared by the operators: words, span hashes, byte-window hashes, stage tables.

Words are maximal runs of characters other than space and U+0009 to U+000D. In UTF-8 these
separators are single bytes that never occur inside another character, so all of this works on bytes.
Hashes are polynomial in the bytes modulo 2**64 with a random odd base, finished by a 64-bit mixer.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import shared_folder

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
WORD = r"[^\x20\x09-\x0D]+"

_rng = np.random.Generator(np.random.PCG64(20240517))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(1, 2**60)) * 8 + 5
_MASK = (1 << 64) - 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_tables: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers of base; the table at hand is doubled when it is too short."""
    have = _tables.get(base)
    if have is None or len(have) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        _tables[base] = have = np.multiply.accumulate(have)
    return have[:n]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit mixer (the finaliser of splitmix64), another one for each seed."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & _MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    """The words of a text with A-Z lower-cased; none for null."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()


def span_hashes(words: list[bytes], k: int) -> np.ndarray:
    """A hash for each run of k words, in text order; the whole sequence if there are fewer; none if empty."""
    if not words:
        return np.empty(0, np.uint64)
    data = np.frombuffer(b" ".join(words), np.uint8)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    k = min(k, len(words))
    starts, ends = starts[: len(words) - k + 1], ends[k - 1 :]
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[data] * _powers(_BASE, len(data)), out=total[1:])
    return mix((total[ends] - total[starts]) * _powers(_INVERSE, len(data))[starts])


def window_hashes(data: np.ndarray, log_length: int) -> np.ndarray:
    """The hash of every window of 2**log_length bytes, by doubling the window."""
    h, power = _BYTE[data], _BASE
    for i in range(log_length):
        step = 1 << i
        h = h[:-step] * np.uint64(power) + h[step:]
        power = power * power & _MASK
    return h


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every window of so many values, by doubling the window."""
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    rest = width - done
    return np.minimum(x[:-rest], x[rest:]) if rest else x


@contextmanager
def without_leftovers(spark: SparkSession) -> Iterator[None]:
    """Executions in this block delete their shuffle files at their end, as nothing reads them again; else they stay until the driver collects garbage."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage: write a table to the shared folder and read it again. Unlike a checkpoint it is compressed and has statistics."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    with without_leftovers(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._folder = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of checkpointed() that nothing reads any more."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t._folder)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def small_side(df: DataFrame, row_bytes: int, limit: int = 32 << 20) -> DataFrame:
    """Mark a materialised table for broadcast if its counted rows fit the limit; else leave the join to shuffle."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def measured_side(df: DataFrame, size: str, limit: int = 32 << 20) -> DataFrame:
    """Mark a materialised table for broadcast if the sum of an expression for its rows' bytes fits the limit; else leave the join to shuffle."""
    return F.broadcast(df) if (df.agg(F.sum(F.expr(size))).first()[0] or 0) <= limit else df


def bitmap_of(hashes: DataFrame, column: str, log_bits: int = 27) -> np.ndarray | None:
    """A bitmap of 2**log_bits bits with one set for each value of a long column; None if that would leave few bits unset.

    Its size is fixed, whatever the table: 16 MB at most come to the driver. What it lets through needs an exact test.
    """
    if hashes.count() > (1 << log_bits) // 8:
        return None
    bit = F.shiftrightunsigned(column, 64 - log_bits)
    parts = hashes.select(F.shiftright(bit, 15).alias("part"), bit.bitwiseAND(0x7FFF).alias("place"))
    bits = np.zeros((1 << log_bits) // 8, np.uint8)
    for row in parts.groupBy("part").agg(F.bitmap_construct_agg("place").alias("bits")).collect():
        bits[row.part << 12 : (row.part + 1) << 12] = np.frombuffer(row.bits, np.uint8)
    return bits


def in_bitmap(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of these 64-bit values may be in the column that bitmap_of() has seen."""
    bit = (values >> np.uint64(64 - (len(bits).bit_length() + 2))).astype(np.int64)
    return (bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def quoted(names: Iterable[str]) -> list[Column]:
    """Columns by name, whatever characters the names have."""
    return [F.col(f"`{name.replace('`', '``')}`") for name in names]


def map_batches(df: DataFrame, function: Callable, added: list[T.StructField] = []) -> DataFrame:  # noqa: B006
    """mapInArrow() to the columns of df and the added ones. mapInArrow() itself fails on names with dots, so those go under other names."""
    named = df.toDF(*(name if "." not in name and "`" not in name else f"column-{uuid.uuid4().hex}" for name in df.columns))
    return named.mapInArrow(function, T.StructType(df.schema.fields + added))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
