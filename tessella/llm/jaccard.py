"""Exact n-gram Jaccard join of documents in metric space.

A pair is linked if the Jaccard distance of its shingle sets is at most r; that is, if the size of the symmetric difference
d(x, y) = |x - y| + |y - x|, a metric too, is at most c * (|x| + |y|) with c = r / (2 - r). The join runs in the metric d:

* regions: the pivots are the sets {s} of one shingle. All pivots that a set holds lie at the same distance |x| - 1 from it, all
  others two further, so the rarest shingle decides among them and owns the set. What the triangle inequality lets
  a partner lack is the window: a set goes into the regions of its next pivots too, in the order of rarity, as far as a partner
  could have missed all before. How many it has passed there is its depth; two sets whose depths add up to more than their radius, or whose
  depths do not fit their sizes, are no pair of that region.
* shingles that occur once in the corpus have regions of one member, so most documents are settled by counting shingles: those with more
  single shingles than a partner may miss have no partner. Only the others are read again.
* within a region the member of least depth is the pivot: members are tested against it, and members already in one component need no further
  test. Regions that still hold several components and are small are tested member by member, where depths and sizes allow.
* a large one joins recursively, seen from its pivot p: members become x - p and p - x together, which leaves their distances d as they are.
  Members within the radius of p are in its component; any other pair shares a part of its difference from p, so the same
  regions and windows, made of these smaller sets, hold it. The recursion has no pivot p any more; at the depth DEPTH what is left is tested.

Equal sets are one document to the join: they get a class by a 128-bit digest. Nothing but bitmaps of fixed size comes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import least_reachable
from .textkit import checkpointed, discard, small_side, span_hashes, words_of

SMALL = 16  # members of a region that needs no further pivots
DEPTH = 6  # levels of regions within regions
LOG_BITS = 27  # of the bitmap of shingles that occur again


def shingles(text: str | None, k: int) -> np.ndarray:
    """The set of hashes of k-word shingles, sorted; with fewer words the whole sequence; empty without words."""
    return np.unique(span_hashes(words_of(text), k))


def _edge(percent: int) -> int:
    """Shingles with hashes below this are counted in the whole corpus; they hold well more than a partner may miss."""
    return min((1 << 64) - 1, int((1 << 64) * 2.5 * (100 - percent) / 100))


def _packed(codes: np.ndarray) -> bytes:
    return codes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _codes(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.view("<u8").reshape(-1)


def _bit(codes: np.ndarray, edge: int) -> np.ndarray:
    """The place of a 40-bit code in the bitmap, in the order of the codes."""
    return (codes >> np.uint64(8) << np.uint64(LOG_BITS)) // np.uint64((edge >> 32) + 1)


def _digest(items: np.ndarray) -> tuple[int, int]:
    a, b = divmod(xxhash.xxh3_128_intdigest(items.tobytes()), 1 << 64)
    return a - (1 << 63), b - (1 << 63)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches in parts of so many rows, which bounds what a task holds of sets."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def _sets(batches: Iterator[pa.RecordBatch], k: int, edge: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) -> doc_id, size of the set, its digest, and 40 bits of each shingle below the edge."""
    for batch in _slices(batches):
        sizes, a, b, zones = [], [], [], []
        for text in batch.column(1):
            items = shingles(text.as_py(), k)
            digest = _digest(items)
            sizes.append(len(items))
            a.append(digest[0])
            b.append(digest[1])
            zones.append(_packed(items[: np.searchsorted(items, np.uint64(edge))] >> np.uint64(24)))
        columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(zones, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "set_a", "set_b", "zone"])


def _binned(batches: Iterator[pa.RecordBatch], edge: int, log_bins: int) -> Iterator[pa.RecordBatch]:
    """zone -> (bin, codes that this batch has once, codes that it has again)."""
    for batch in batches:
        codes, n = np.unique(_codes(b"".join(batch.column(0).to_pylist())), return_counts=True)
        for again, kept in ((False, codes[n == 1]), (True, codes[n > 1])):
            where = np.searchsorted(_bit(kept, edge) >> np.uint64(LOG_BITS - log_bins), np.arange((1 << log_bins) + 1, dtype=np.uint64))
            bins = np.flatnonzero(where[1:] > where[:-1])
            data = pa.array([_packed(kept[where[i] : where[i + 1]]) for i in bins], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(bins, pa.int64()), pa.array(np.full(len(bins), again)), data], ["bin", "again", "codes"])


def _repeated(table: pa.Table, edge: int, log_bins: int) -> pa.Table:
    """The bits of one bin: those of codes that occur more than once."""
    size = 1 << (LOG_BITS - log_bins)
    again = table.column("again").to_numpy()
    data = table.column("codes").to_pylist()
    once, n = np.unique(_codes(b"".join(x for x, more in zip(data, again, strict=True) if not more)), return_counts=True)
    more = np.concatenate([once[n > 1], _codes(b"".join(x for x, more in zip(data, again, strict=True) if more))])
    bits = np.zeros(size, bool)
    bits[(_bit(more, edge) & np.uint64(size - 1)).astype(np.int64)] = True
    return pa.table({"bin": table.column("bin")[:1], "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})


def _repeated_bits(sets: DataFrame, edge: int) -> np.ndarray:
    """A bitmap of fixed size: which places are taken by shingles below the edge that occur more than once in the corpus."""
    codes = (sets.agg(F.sum(F.octet_length("zone"))).first()[0] or 0) // 5
    log_bins = min(14, max(5, (codes >> 20).bit_length()))
    binned = sets.filter("n_shingles > 0").select("zone").mapInArrow(partial(_binned, edge=edge, log_bins=log_bins), "bin long, again boolean, codes binary")
    repeated = partial(_repeated, edge=edge, log_bins=log_bins)
    bits = np.zeros(1 << (LOG_BITS - 3), np.uint8)
    width = len(bits) >> log_bins
    for row in binned.groupBy("bin").applyInArrow(lambda table: repeated(table), "bin long, bits binary").collect():
        bits[row.bin * width : (row.bin + 1) * width] = np.frombuffer(row.bits, np.uint8)
    return bits


def _with_partners(batches: Iterator[pa.RecordBatch], edge: int, percent: int, bits: Broadcast) -> Iterator[pa.RecordBatch]:
    """The rows whose single shingles are no more than what a partner may miss."""
    for batch in batches:
        zones = batch.column(4).to_pylist()
        place = _bit(_codes(b"".join(zones)), edge).astype(np.int64)
        single = np.r_[0, np.cumsum((bits.value[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 0)]
        ends = np.cumsum([len(z) // 5 for z in zones])
        n = batch.column(1).to_numpy()
        keep = single[ends] - single[np.r_[0, ends[:-1]]] <= (100 - percent) * n // 100
        yield pa.RecordBatch.from_arrays(batch.columns[:4], ["doc_id", "n_shingles", "set_a", "set_b"]).filter(pa.array(keep & (n > 0)))


def _items(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        found = [shingles(t.as_py(), k) for t in batch.column(1)]
        digests = [_digest(s) for s in found]
        columns = [batch.column(0), *(pa.array([d[i] for d in digests], pa.int64()) for i in (0, 1)), pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "set_a", "set_b", "items"])


def _regions(members: DataFrame, percent: int) -> DataFrame:
    """members (region, node, doc_id, n, m, reach, items) -> the regions within their regions: region, node, doc_id, n, m, depth.

    m is the number of items, reach the greatest depth at which a member may meet a partner. Items that only one member of the region
    has come first and make no region of their own; the others follow by how many have them.
    """
    each = members.select("region", "node", F.explode("items").alias("item"))
    shared = each.groupBy("region", "item").agg(F.count("*").alias("held")).filter("held > 1")
    own = each.join(shared, ["region", "item"]).groupBy("region", "node").agg(F.array_sort(F.collect_list(F.struct("held", "item"))).alias("shared"))
    dealt = members.drop("items").join(own, ["region", "node"]).withColumn("first", F.col("m") - F.size("shared")).filter("first <= reach")
    dealt = dealt.select("node", "doc_id", "n", "m", "region", "first", F.posexplode(F.slice("shared", F.lit(1), (F.col("reach") - F.col("first") + 1).cast("int"))).alias("at", "s"))
    found = checkpointed(dealt.select(F.xxhash64("region", "s.item").alias("region"), "node", "doc_id", "n", "m", (F.col("first") + F.col("at")).alias("depth")))
    out = checkpointed(_possible(found, percent))
    discard(found)
    return out


def _possible(found: DataFrame, percent: int) -> DataFrame:
    """The members of regions that some other member is near enough to, by depths."""
    spare = F.expr(f"{100 + percent} * depth - {100 - percent} * n")
    least = found.groupBy("region").agg(F.min(spare).alias("least"), F.count("*").alias("members")).filter("members > 1 AND least <= 0")
    return found.join(least, "region").filter(spare + F.col("least") <= 0).drop("least", "members")


def _fits(percent: int) -> str:
    """Whether two members x, y of a region may be a pair whose first shared item is the region's: what both passed, and what more the larger has, is in their difference."""
    radius = f"{100 - percent} * (x.n + y.n)"
    sides = [f"{100 + percent} * (2 * {a}.depth - {a}.m + {b}.m) <= {radius}" for a, b in ("xy", "yx")]
    return " AND ".join([*sides, f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)", "x.doc_id != y.doc_id"])


def _with_items(pairs: DataFrame, sets: DataFrame, a: str, b: str) -> DataFrame:
    """A table of pairs (a, b) of nodes, with id_a, items_a, id_b and items_b. Only the sets of these nodes are shuffled."""
    nodes = checkpointed(pairs.select(F.col(a).alias("node")).union(pairs.select(b)).distinct())
    held = sets.select("node", "doc_id", "items").join(small_side(nodes, 16), "node", "left_semi")
    side = lambda x: held.select(F.col("node").alias(x), F.col("doc_id").alias(f"id_{x}"), F.col("items").alias(f"items_{x}"))
    return pairs.join(side(a), a).join(side(b), b)


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """pairs (a, b) of nodes -> the links (a, b) of doc_ids among them, by whole sets; None without pairs."""
    pairs = checkpointed(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    if pairs.isEmpty():
        return None
    both = F.size(F.array_intersect("items_a", "items_b"))
    exact = _with_items(pairs, sets, "a", "b").filter(100 * both >= percent * (F.size("items_a") + F.size("items_b") - both))
    return checkpointed(exact.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")))


def _named(members: DataFrame, labels: DataFrame) -> DataFrame:
    return members.join(labels, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))


def _merged(labels: DataFrame, links: DataFrame | None) -> DataFrame:
    """The labels with more links; links is a table or None."""
    if links is None or links.isEmpty():
        return labels
    return checkpointed(least_reachable(labels.select(F.col("doc_id").alias("a"), F.col("component").alias("b")).union(links)))


def _open(members: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """The members of regions that a member of another component may be a pair with, with component and number of members (in_region).

    Each of the three conditions of _fits() is a sum of a part of x and a part of y; a member stays if its part and the least part
    that the other components have may meet it.
    """
    named = checkpointed(_named(members, labels))
    split = named.groupBy("region").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("region")
    own, other = f"{100 + percent}", f"{100 - percent} * n"
    parts = {"s": f"{own} * depth - {other}", "w": f"{own} * (2 * depth - m) - {other}", "z": f"{own} * m - {other}"}
    held = named.join(split, "region").withColumns({k: F.expr(v) for k, v in parts.items()})
    each = held.groupBy("region", "component").agg(*(F.min(k).alias(k) for k in parts))
    best = each.groupBy("region").agg(*(F.min_by("component", F.struct(k, "component")).alias(f"of_{k}") for k in parts))
    best = each.join(best, "region").groupBy("region", *(f"of_{k}" for k in parts)).agg(*(F.min(k).alias(f"least_{k}") for k in parts), *(F.min(F.expr(f"if(component = of_{k}, null, {k})")).alias(f"next_{k}") for k in parts))
    meets = lambda mine, theirs: f"{mine} + if(component = of_{theirs}, next_{theirs}, least_{theirs}) <= 0"
    kept = held.join(best, "region").filter(" AND ".join((meets("s", "s"), meets("w", "z"), meets("z", "w"))))
    kept = checkpointed(kept.select(*members.columns, "component"))
    out = checkpointed(kept.join(kept.groupBy("region").agg(F.count("*").alias("in_region")), "region"))
    discard(named, kept)
    return out


def _from_pivot(large: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The members of large regions as their differences from its pivot, and the links (a, b) to pivots.

    The radius of two members is c * (n_x + n_y). One that is outside the pivot's radius meets a partner at a depth of at most
    its own greatest radius; one inside needs a partner outside, which leaves it a depth under m * (1 + c) / 2.
    """
    pivots = large.groupBy("region").agg(F.min_by(F.struct("node", "n"), F.struct("depth", "node")).alias("p")).select("region", F.col("p.node").alias("pivot"), F.col("p.n").alias("n_p"))
    seen = checkpointed(large.select("region", "node", "doc_id", "n").join(pivots, "region").filter("node != pivot"))
    apart = _with_items(checkpointed(seen.select("node", "pivot").distinct()), sets, "node", "pivot")
    apart = checkpointed(apart.select("node", "pivot", "id_node", "id_pivot", F.concat(F.array_except("items_node", "items_pivot"), F.array_except("items_pivot", "items_node")).alias("items")))
    m = F.size("items").cast("long")
    inside = m * (100 + percent) <= (100 - percent) * (F.col("n") + F.col("n_p"))
    reach = F.when(inside, F.expr(f"(100 * size(items) - 1) div {100 + percent}")).otherwise(F.expr(f"{100 - percent} * n div {percent}"))
    members = seen.join(apart, ["node", "pivot"]).withColumn("inside", inside).withColumn("m", m).withColumn("reach", reach)
    links = checkpointed(members.filter("inside AND id_node != id_pivot").select(F.col("id_node").alias("a"), F.col("id_pivot").alias("b")).distinct())
    return members.select("region", "node", "doc_id", "n", "m", "reach", "items"), links


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """documents -> one row per row: doc_id, n_shingles, component_id, the least doc_id that links reach.

    Two texts link if 100 * |intersection| >= percent * |union| of their k-word shingle sets. Null and empty texts,
    and texts without words, have no shingles and link with nothing. Rows with the same doc_id are one document to the links, which has those
    of all its texts; a row without doc_id links with nothing and gets no component_id. Other columns are not read.
    """
    edge = _edge(percent)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sizes = checkpointed(docs.mapInArrow(partial(_sets, k=k, edge=edge), "doc_id long, n_shingles long, set_a long, set_b long, zone binary"))
    known = sizes.filter("doc_id IS NOT NULL")
    bits = docs.sparkSession.sparkContext.broadcast(_repeated_bits(known, edge))
    some = known.mapInArrow(partial(_with_partners, edge=edge, percent=percent, bits=bits), "doc_id long, n_shingles long, set_a long, set_b long")
    each = checkpointed(some)
    some = checkpointed(each.distinct())
    bits.unpersist()

    classes = checkpointed(some.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n")))
    copies = some.join(classes.select("set_a", "set_b", F.col("doc_id").alias("least")), ["set_a", "set_b"]).filter("doc_id > least").select(F.col("doc_id").alias("a"), F.col("least").alias("b"))
    labels = checkpointed(least_reachable(copies))

    wanted = small_side(checkpointed(classes.select("doc_id").distinct()), 16)
    texts = docs.join(wanted, "doc_id", "left_semi")
    if each.count() > some.count():  # else no row is repeated
        texts = texts.dropDuplicates(["doc_id", "text"])
    found = texts.mapInArrow(partial(_items, k=k), "doc_id long, set_a long, set_b long, items array<long>")
    found = found.join(small_side(classes, 64), ["doc_id", "set_a", "set_b"]).withColumns({"m": F.col("n"), "reach": F.expr(f"{100 - percent} * n div 100"), "region": F.lit(0).cast("long"), "node": F.monotonically_increasing_id()})
    members = sets = checkpointed(found.drop("set_a", "set_b"))

    for level in range(DEPTH):
        inner = _regions(members, percent)
        if inner.isEmpty():
            break
        labels = _star(inner, sets, labels, percent)
        left = _open(inner, labels, percent)
        if left.isEmpty():
            break
        few = F.lit(True) if level + 1 == DEPTH else F.col("in_region") <= SMALL
        x, y = left.filter(few).alias("x"), left.filter(few).alias("y")
        pairs = x.join(y, F.expr(f"x.region = y.region AND x.component < y.component AND {_fits(percent)}")).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        labels = _merged(labels, _linked(pairs, sets, percent))
        large = left.filter(~few)
        if large.isEmpty():
            break
        members, near = _from_pivot(large, sets, percent)
        labels = _merged(labels, near)
        discard(inner, left)
    return sizes.join(labels, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def _star(members: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """The labels after the members of each region have been tested against its pivot, the one of least depth.

    Each member is first tested against the pivot that it meets most often; what that settles needs no other test.
    """
    x, y = members.alias("x"), members.groupBy("region").agg(F.min_by(F.struct("node", "doc_id", "n", "m", "depth"), F.struct("depth", "node")).alias("p")).select("region", "p.*").alias("y")
    met = x.join(y, F.expr(f"x.region = y.region AND x.node != y.node AND {_fits(percent)}")).select(F.col("x.node").alias("a"), F.col("x.doc_id").alias("id_a"), F.col("y.node").alias("b"), F.col("y.doc_id").alias("id_b"))
    met = checkpointed(met.groupBy("a", "id_a", "b", "id_b").agg(F.count("*").alias("times")))
    first = met.groupBy("a").agg(F.max_by("b", F.struct("times", -F.col("b"))).alias("b"))
    labels = _merged(labels, _linked(first, sets, percent))
    left, right = (labels.select(F.col("doc_id").alias(f"id_{s}"), F.col("component").alias(f"component_{s}")) for s in "ab")
    rest = met.join(first, ["a", "b"], "left_anti").join(left, "id_a", "left").join(right, "id_b", "left")
    rest = rest.filter(F.coalesce("component_a", "id_a") != F.coalesce("component_b", "id_b"))
    return _merged(labels, _linked(rest.select("a", "b"), sets, percent))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents without those that another of their group stands for: the least doc_id of each group stays.

    Rows without doc_id or without words stay; of several rows with the doc_id that stays, all stay.
    """
    groups = near_duplicates(docs, k, percent).filter("component_id != doc_id").select("doc_id").distinct()
    return docs.join(groups, "doc_id", "left_anti")
