import hashlib
import random
from collections import Counter

import numpy as np

from tessella.llm import suffix_dedup
from tessella.llm.suffix_dedup import remove_repeats


def brute(rows, size):
    raws = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(r[p : p + size] for _, r in raws for p in range(len(r) - size + 1))
    out = []
    for i, r in raws:
        gone = bytearray(len(r))
        for p in range(len(r) - size + 1):
            if seen[r[p : p + size]] > 1:
                gone[p : p + size] = b"\1" * size
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        n_spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(r), sum(gone), n_spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, size=200):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(r)[:5] for r in remove_repeats(df, size).collect()]
    assert sorted(got, key=str) == brute(rows, size)


def text(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 8))) for _ in range(n))


def test_against_brute_force(spark):
    rng = random.Random(5)
    passage = text(rng, 90)
    docs = [text(rng, rng.randint(1, 200)) for _ in range(20)]
    for k in range(25):
        cut = passage[rng.randint(0, 150) : len(passage) - rng.randint(0, 150)]
        docs[k % 20] = docs[k % 20][:300] + cut + docs[k % 20][300:]
    docs += [docs[0], docs[0][1:], passage[:199], passage[:200], docs[3][:250] + "!" + docs[3][251:]]
    docs += ["a" * 700, "ab" * 300, "aab" * 70, "a" * 199, None, "", None, passage + passage[5:]]
    check(spark, list(enumerate(docs)))


def test_nulls_and_repeated_ids(spark):
    rng = random.Random(6)
    t, u = text(rng, 80), text(rng, 80)
    check(spark, [(1, t), (1, t), (1, u), (None, u), (None, None), (2, "x" + t[:230])])


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, row string, pos string, digit int")
    assert remove_repeats(empty).collect() == []


def test_anchors_do_not_depend_on_chunks(monkeypatch):
    data = np.random.default_rng(1).integers(0, 256, 5000).astype(np.uint8)
    want = suffix_dedup.anchor_places(data, 200)
    for chunk in (300, 333, 4999):
        monkeypatch.setattr(suffix_dedup, "_CHUNK", chunk)
        assert all(np.array_equal(a, b) for a, b in zip(suffix_dedup.anchor_places(data, 200), want, strict=True))


def test_a_text_longer_than_a_chunk_without_repeats_is_kept(spark):
    long = random.Random(7).randbytes((suffix_dedup._CHUNK + 2000) // 2).hex()
    (row,) = remove_repeats(spark.createDataFrame([(1, long)], "doc_id long, text string")).collect()
    assert (row.n_removed, row.n_spans, row.kept_sha256) == (0, 0, hashlib.sha256(long.encode()).hexdigest())
