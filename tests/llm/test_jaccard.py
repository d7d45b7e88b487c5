import random

from tessella.llm import jaccard
from tessella.llm.components import least_reachable
from tessella.llm.jaccard import keep_one, near_duplicates


def sets_of(text, k):
    words = [w.lower() for w in (text or "").split()]
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def brute(rows, k, percent):
    sets = {i: sets_of(t, k) for i, t in rows}
    label = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return sorted((i, len(sets[i]), label[i]) for i in sets)


def corpus(rng):
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(400)]
    line = " ".join(rng.choice(vocabulary) for _ in range(9))
    docs = []
    for _ in range(14):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 8, 13, 30, 90, 250]))]
        docs.append(" ".join(words))
        for _ in range(rng.randint(0, 8)):
            words = list(words)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            docs.append(" ".join(words))
    docs += [line + " " + " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 9))) for _ in range(70)]
    rng.shuffle(docs)
    return [*docs, None, "", " \n", "a", "a", "a b c", "A b c", "a b c d e"]


def test_against_brute_force(spark, monkeypatch):
    for seed, k, percent, small in ((1, 4, 85, 16), (3, 2, 60, 3)):
        monkeypatch.setattr(jaccard, "SMALL", small)
        rows = list(enumerate(corpus(random.Random(seed))))
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        assert sorted(map(tuple, near_duplicates(df, k, percent).collect())) == brute(rows, k, percent)


def test_copies_around_the_threshold_join_recursively(spark, monkeypatch):
    """Copies of one text with more and fewer edits: regions that all of them share, with many below the threshold."""
    monkeypatch.setattr(jaccard, "SMALL", 2)
    levels = []
    seen = jaccard._from_pivot
    monkeypatch.setattr(jaccard, "_from_pivot", lambda *a: levels.append(1) or seen(*a))
    rng = random.Random(11)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(90):
        words = list(base)
        at = rng.randrange(50)
        for j in range(rng.choice([1, 2, 3, 3, 4])):
            words[(at + j * rng.choice([1, 1, 9])) % 60] = f"x{i}.{j}" if rng.random() < 0.7 else f"y{rng.randrange(6)}"
        rows.append((i, " ".join(words)))
    rows.append((90, "long " * 20_000 + " ".join(f"t{i}" for i in range(20_000))))
    rows.append((91, "long " * 9 + " ".join(f"t{i}" for i in range(19_500))))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, near_duplicates(df, 3, 85).collect())) == brute(rows, 3, 85)
    assert levels


def test_nulls_repeats_and_empty_table(spark):
    rows = [(7, "a b c d e f", 1), (7, "a b c d e f", 2), (None, "a b c d e f", 3), (9, "A b c d e f", 4), (3, None, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    got = sorted(map(tuple, near_duplicates(df).collect()), key=str)
    assert got == sorted([(7, 2, 7), (7, 2, 7), (None, 2, None), (9, 2, 7), (3, 0, 3)], key=str)
    assert sorted(str(r.doc_id) for r in keep_one(df).collect()) == ["3", "7", "7", "None"]
    assert near_duplicates(df.limit(0)).collect() == []


def test_a_repeated_id_has_the_links_of_all_its_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(5, a), (5, b), (7, a + " c"), (9, b + " c"), (11, "d " * 30)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(5, 5), (5, 5), (7, 5), (9, 5), (11, 11)]


def test_components_of_a_path(spark):
    n = 40
    order = random.Random(4).sample(range(n), n)
    links = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(100, 101), (102, 101)], "a long, b long")
    got = {r.doc_id: r.component for r in least_reachable(links).collect()}
    assert got == {i: 0 for i in range(n)} | {100: 100, 101: 100, 102: 100}
