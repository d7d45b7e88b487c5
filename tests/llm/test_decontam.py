import random

from tessella.llm.decontam import contaminations, decontaminated, tiling, tokens_of


def brute_tiles(a, b, least):
    free_a, free_b, tiles = [True] * len(a), [True] * len(b), []
    while True:
        best, found = least, []
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and free_a[i + n] and free_b[j + n]:
                    n += 1
                if n > best:
                    best, found = n, []
                if n == best:
                    found.append((i, j))
        if not found:
            return tiles
        for i, j in found:
            if all(free_a[i : i + best]) and all(free_b[j : j + best]):
                free_a[i : i + best] = [False] * best
                free_b[j : j + best] = [False] * best
                tiles.append((i, j, best))


def test_tiles_cover_as_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        a = [b"%d" % rng.randint(0, 3) for _ in range(rng.randint(0, 25))]
        b = [b"%d" % rng.randint(0, 4) for _ in range(rng.randint(0, 40))]
        least = rng.randint(2, 4)
        tiles = tiling(a, b, least)
        assert all(a[i : i + n] == b[j : j + n] and n >= least for i, j, n in tiles)
        assert len({x for i, _, n in tiles for x in range(i, i + n)}) == sum(n for *_, n in tiles)
        assert max((n for *_, n in tiles), default=0) == max((n for *_, n in brute_tiles(a, b, least)), default=0)


def test_tiles_are_those_of_greedy_tiling():
    item = [b"%d" % i for i in range(20)]
    assert sum(n for *_, n in tiling(item, [*item[:8], b"x", *item[6:15]], 5)) == 15
    rng = random.Random(6)
    for _ in range(150):
        a = [b"%d" % rng.randint(0, 5) for _ in range(rng.randint(0, 30))]
        b = [b"%d" % rng.randint(0, 5) for _ in range(rng.randint(0, 40))]
        assert tiling(a, b, 2) == brute_tiles(a, b, 2)


def test_leaks_are_caught_and_clean_documents_are_not(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    items = [(k, " ".join(word() for _ in range(30))) for k in range(6)] + [(6, None), (7, "short"), (None, "x y z w v u")]
    clean = lambda n: " ".join(word() for _ in range(n))
    docs = [(i, clean(80)) for i in range(20)]
    words = items[2][1].split()
    docs += [(100, clean(30) + " " + items[0][1].upper().replace(" ", ", ") + " " + clean(9)), (101, " ".join(words[15:] + [word()] + words[:15])), (102, clean(40) + " " + " ".join(words[:8])), (103, None), (104, ""), (100, clean(5)), (None, items[1][1])]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, item_id int").repartition(3)
    bench = spark.createDataFrame(items + [items[0]], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.coverage for r in contaminations(df, bench).collect()}
    assert got == {(100, 0): 1.0, (101, 2): 1.0}
    assert sorted(str(r.doc_id) for r in decontaminated(df, bench).collect()) == sorted([*(str(i) for i in range(20)), "100", "102", "103", "104"])
    clash = df.withColumn("text_key", df.text).withColumnRenamed("item_id", "seed")
    assert decontaminated(clash, bench).columns == clash.columns and decontaminated(clash, bench).count() == 24
    long = spark.createDataFrame([(1, clean(30_000) + " " + items[4][1]), (2, clean(30_000))], "doc_id long, text string")
    assert [(r.doc_id, r.item_id) for r in contaminations(long, bench).collect()] == [(1, 4)]
    assert contaminations(df.limit(0), bench).collect() == [] and contaminations(df, bench.limit(0)).collect() == []
    assert tokens_of("A-b, C") == [b"a", b"b", b"c"]
