import hashlib
import random
import re

from tessella.llm import pii


def brute(text):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        doubled = [int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(reversed(digits))]
        if 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            out.append((2, *m.span()))
    return out + [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


def texts():
    rng = random.Random(7)
    parts = ["a.b+c@x-y.com", "x@y", "@@", "a@b.c@d.e.f", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (017) 555-7713", "+12", "+1.2.3.4.5.6.7.8.9", "tel", "é漢😀", "0001.002.3.04", "12345678901234567890", "4111111111111111", "\n", " ", ".", "@x.y", "+"]
    out = ["".join(rng.choice(parts) + rng.choice(["", " ", ", "]) for _ in range(rng.randint(1, 30))) for _ in range(150)]
    return [None, "", "no data", "1" * 20_000, "a" * 20_000 + "@", "a@" * 5000, *out]


def test_base_against_brute_force(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, base string").repartition(3)
    got = {r.doc_id: r for r in pii.report(df).collect()}
    for i, text in rows:
        want = brute(text or "")
        r = got[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in want) for kind in range(4)]
        named = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in want]
        assert r.base_sha256 == hashlib.sha256(",".join(named).encode()).hexdigest()
        assert set(filter(None, named)) <= set(r.spans.split(","))


def test_further_spans_and_mask(spark):
    rng = random.Random(1)
    ips = [".".join(str(rng.randint(0, 255)) for _ in range(4)) for _ in range(300)]
    rows = [(i, f"word {ip} then 12 more, at 2024 and {ip}") for i, ip in enumerate(ips)] + [(300, "see 10.20.30.400 and 10.20.30.40 and 10.20.30.40 again"), (301, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    masked = {r.doc_id: r.text for r in pii.mask(df).collect()}
    assert masked[0] == "word <ip> then 12 more, at 2024 and <ip>" and masked[301] is None
    assert masked[300].endswith("and <ip> and <ip> again")
    assert pii.report(df.limit(0)).collect() == []


def test_the_field_finds_variants_that_the_patterns_do_not(spark):
    """Repeats of a number's parts, and of an address with a defect, next to those that the patterns find; like tokens alone stay."""
    rng = random.Random(3)
    rows, planted = [], {}
    for i in range(400):
        a, b = rng.randint(100000, 999999), rng.randint(1000, 9999)
        if i % 10 == 1:
            rows.append((i, f"call +49 {a} {b}, I say +49 {a} {b}"))
        elif i % 10:
            rows.append((i, f"call +49 {a} {b} or again {a} for item {rng.randint(100000, 999999)} of {rng.randint(1990, 2030)}"))
        else:
            rows.append((i, f"the order {a} of {rng.randint(1990, 2030)} has {b} parts in {rng.randint(100000, 999999)}"))
        planted[i] = str(a) if i % 10 > 1 else None
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    further = {i: {r.text[s.start : s.end] for s in r.pii_further} for i, r in got.items()}
    hits = sum(planted[i] in further[i] for i in planted if planted[i])
    wrong = sum(len(further[i] - {planted[i]}) for i in planted)
    assert hits >= 0.9 * 320 and wrong <= 0.05 * 400


def test_masking_keeps_clashing_columns(spark):
    df = spark.createDataFrame([(1, "x", "mail a@b.cd", [1], "y"), (None, None, None, None, None), (1, "x", "", [], "z")], "doc_id long, base string, text string, further array<int>, pii_base string")
    assert sorted(map(tuple, pii.mask(df).collect()), key=str) == sorted([(1, "x", "mail <email>", [1], "y"), (None, None, None, None, None), (1, "x", "", [], "z")], key=str)


def test_message_passing_is_exact_on_a_tree():
    import itertools

    import numpy as np

    field = pii.Field([])
    rng = np.random.default_rng(0)
    field.weights = rng.normal(size=field.weights.shape)
    field.pairs = rng.normal(size=field.pairs.shape)
    bits, edges = [1, 2, 4], [(0, 0, 1), (1, 0, 2)]
    own = (np.array(bits)[:, None] >> np.arange(pii.N_FEATURES) & 1) @ field.weights
    want = np.zeros((3, 5))
    for labels in itertools.product(range(5), repeat=3):
        weight = np.exp(sum(own[i, y] for i, y in enumerate(labels)) + sum(field.pairs[k, labels[i], labels[j]] for k, i, j in edges))
        for i, y in enumerate(labels):
            want[i, y] += weight
    assert np.allclose(field.beliefs(bits, edges), want / want.sum(1, keepdims=True), atol=0.02)


def test_known_labels_reach_all_repeats():
    import numpy as np

    field = pii.Field([])
    field.pairs[1] = np.log(np.full((5, 5), 0.0005) + 0.9995 * np.eye(5))
    n = 30
    edges = [(1, i, i + 1) for i in range(n - 1)]
    label = np.array([4] + [0] * (n - 1))
    # exact on a chain: what the last node hears of the first
    step = np.exp(field.pairs[1])
    want = np.linalg.matrix_power(step / step.sum(1, keepdims=True), n - 1)[4]
    got = field.beliefs([0] * n, edges, label.tolist())
    assert got[0, 4] > 0.999 and np.allclose(got[-1], want, atol=0.01) and want[4] > 0.9
    # a part of a number that the pattern has found gives its label to its repeat
    text = "+49 123456 7890 and 123456"
    field.weights[0, 0] = 1.0
    assert [text[a:b] for k, a, b in pii.further_spans(text, pii.base_spans(text), field, 0.9)] == ["123456"]
