"""Personal data by patterns and a skip-chain conditional random field.

Patterns give the base spans. Tokens with a digit or an @ are the nodes of a random field over the labels none, email, ip, card and
phone; all other tokens are fixed to none. Edges join neighbouring nodes, repeated tokens, and tokens of the same shape, each to
the occurrence before it, so their number grows with the text and not with its square. The potentials, weights of token features and of two
labels for each kind of edge, are learnt together over all documents, from the labels that the patterns give: by the pseudo-likelihood, in
which each node is predicted from its features and the labels of all nodes that it has an edge to. Tokens that a pattern finds elsewhere in the same text have no known label. As the features nearly determine what a pattern
finds, every node counts again without those that the patterns test, and those with repeats once more with the edges to these alone, all three with the same weight, so that the edges have to tell. Damped loopy message passing, until it settles, gives each node's
beliefs; a node that a base span touches holds the span's label, which its repeats so hear of. Nodes that no base span touches become further spans of
their label if the belief is at least `belief`.

Offsets count code points, ends are exclusive. Null and empty texts have no spans. Rows with the same doc_id, and repeated rows, are labelled
one by one. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textkit import map_batches

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match of the address pattern always starts where a run of digits does
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK = re.compile("[0-9@]")
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_EDGE_KINDS = 3  # neighbours, repeats, same shape
_AGREE = (0.0, 3.0, 0.0)  # what equal labels over an edge of each kind are worth before anything is learnt
_TOLERANCE = 1e-3  # largest change of a message's logarithms at which message passing ends
_SPANS = ("pii_base", "pii_further")
_CERTAIN = 30.0  # logarithm of how much likelier a known label is than any other


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2]) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+, found from their @ in linear time."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        floor = match.end() if match else at + 1
        if match:
            yield start, match.end()
        at = text.find("@", floor)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns' matches, by kind and start."""
    out = [(0, a, b) for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((3, *m.span()))
    return out


def nodes_of(text: str) -> list[tuple[int, int]]:
    """The tokens that hold a digit or an @."""
    out, at = [], 0
    while match := _MARK.search(text, at):
        start = match.start()
        while start > at and not _SPACE.match(text, start - 1):
            start -= 1
        space = _SPACE.search(text, match.start())
        at = space.start() if space else len(text)
        out.append((start, at))
    return out


_EDGE = ".,;:!?()[]{}<>\"'%&$#*|="


def features(token: str) -> int:
    """The token's features as bits."""
    digits = sum("0" <= c <= "9" for c in token)
    letters = sum(c.isalpha() for c in token)
    dots = token.count(".")
    facts = (
        True, "@" in token, "@" in token and "." in token[token.rfind("@") :], digits == 0, digits <= 3, digits <= 6, digits <= 9, digits <= 12, 13 <= digits <= 19, digits >= 20,
        dots == 3, dots > 0, letters == 0, letters > digits, token[0] == "+", "(" in token, "-" in token, len(token) <= 4, len(token) <= 8, len(token) >= 24, bool(re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3}", token.strip(_EDGE))),
    )
    return sum(1 << i for i, fact in enumerate(facts) if fact)


N_FEATURES = 21
#: The features that no pattern tests: those all tokens have, few or many digits, letters, and the length.
_PLAIN = sum(1 << i for i in (0, 3, 4, 5, 13, 17, 18, 19))


def _word(text: str, start: int, end: int) -> str:
    return text[start:end].strip(_EDGE).lower()


def edges_of(text: str, nodes: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(kind, node, later node): neighbouring tokens, repeated tokens, tokens of the same shape, each to the nearest before."""
    out, words, shapes = [], {}, {}
    for j, (start, end) in enumerate(nodes):
        token = _word(text, start, end)
        shape = re.sub("[0-9]+", "9", re.sub(r"[^\W\d_]+", "a", token))
        if j and start - nodes[j - 1][1] == 1:
            out.append((0, j - 1, j))
        if token in words:
            out.append((1, words[token], j))
        elif shape in shapes and len(token) >= 6:
            out.append((2, shapes[shape], j))
        words[token] = shapes[shape] = j
    return out


def node_labels(nodes: list[tuple[int, int]], spans: list[tuple[int, int, int]]) -> list[int]:
    """The label of each node: that of the first kind with a span that touches it."""
    labels = [0] * len(nodes)
    for kind, start, end in reversed(spans):
        low = next((i for i in _from(nodes, start)), len(nodes))
        while low < len(nodes) and nodes[low][0] < end:
            labels[low] = kind + 1
            low += 1
    return labels


def _from(nodes: list[tuple[int, int]], place: int) -> Iterator[int]:
    """The first node that ends after a place."""
    low, high = 0, len(nodes)
    while low < high:
        middle = (low + high) // 2
        if nodes[middle][1] <= place:
            low = middle + 1
        else:
            high = middle
    if low < len(nodes):
        yield low


def around(n: int, edges: list[tuple[int, int, int]], labels: list[int]) -> list[int]:
    """What each node sees through its edges: for each kind and side one digit in base 6, the other node's label and 1, or 0 without an edge to a known label.

    A node has at most one edge of a kind to a node before it and one to a node after it. Unknown labels are -1.
    """
    seen = [0] * n
    for kind, i, j in edges:
        seen[j] += (labels[i] + 1) * 6 ** (2 * kind)
        seen[i] += (labels[j] + 1) * 6 ** (2 * kind + 1)
    return seen


def known_labels(tokens: list[str], labels: list[int]) -> list[int]:
    """The labels to learn from. That no pattern finds a token says nothing where the same token is found elsewhere in the text: -1."""
    found = {t for t, label in zip(tokens, labels, strict=True) if label}
    return [-1 if not label and t in found else label for t, label in zip(tokens, labels, strict=True)]


def _observed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (features, label, labels around) per task."""
    counts: Counter[tuple[int, int, int]] = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            nodes = nodes_of(text) if text else []
            if nodes:
                labels = known_labels([_word(text, *node) for node in nodes], node_labels(nodes, base_spans(text)))
                seen = around(len(nodes), edges_of(text, nodes), labels)
                counts.update((features(text[a:b]), label, beside) for (a, b), label, beside in zip(nodes, labels, seen, strict=True) if label >= 0)
    rows = np.array([(*k, n) for k, n in counts.items()], np.int64).reshape(-1, 4)
    yield pa.RecordBatch.from_arrays([pa.array(rows[:, i]) for i in range(4)], ["bits", "label", "beside", "n"])


class Field:
    """Potentials of the random field, in logarithms: fitted to counts (features, label, labels around, n) by the pseudo-likelihood."""

    def __init__(self, counts: list[tuple[int, int, int, int]], steps: int = 400):
        rows = np.array(counts, np.int64).reshape(-1, 4)
        plain, repeats = rows.copy(), rows.copy()
        plain[:, 0] &= _PLAIN
        repeats[:, 0] &= _PLAIN
        repeats[:, 2] = repeats[:, 2] // 36 % 36 * 36  # the digits of edges between repeats
        repeats = repeats[repeats[:, 2] > 0]
        n = np.concatenate([part[:, 3:] / max(1, part[:, 3].sum()) for part in (rows, plain, repeats)])
        rows = np.concatenate([rows, plain, repeats])
        x = (rows[:, :1] >> np.arange(N_FEATURES) & 1).astype(float)
        y = np.eye(len(LABELS))[rows[:, 1]]
        sides = rows[:, 2:3] // 6 ** np.arange(2 * _EDGE_KINDS) % 6 - 1
        self.weights = np.zeros((N_FEATURES, len(LABELS)))
        prior = np.array(_AGREE)[:, None, None] * np.eye(len(LABELS))
        self.pairs = prior.copy()
        momentum = [np.zeros_like(self.weights), np.zeros_like(self.pairs)]
        linked = [np.flatnonzero(sides[:, s] >= 0) for s in range(2 * _EDGE_KINDS)]
        for _ in range(steps if len(rows) else 0):
            z = x @ self.weights
            for s, at in enumerate(linked):
                table = self.pairs[s // 2] if s % 2 == 0 else self.pairs[s // 2].T
                z[at] += table[sides[at, s]]
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            rest = (y - p) * n / 3
            slope = np.zeros_like(self.pairs)
            for s, at in enumerate(linked):
                part = np.zeros((len(LABELS), len(LABELS)))
                np.add.at(part, sides[at, s], rest[at])
                slope[s // 2] += part if s % 2 == 0 else part.T
            momentum[0] = 0.9 * momentum[0] + x.T @ rest - 1e-5 * self.weights
            momentum[1] = 0.9 * momentum[1] + slope - 1e-5 * (self.pairs - prior)
            self.weights += momentum[0]
            self.pairs += momentum[1]

    def beliefs(self, bits: list[int], edges: list[tuple[int, int, int]], known: list[int] | None = None) -> np.ndarray:
        """Marginals of the labels of each node, by damped loopy message passing; nodes with a known label (not 0) hold it.

        Passing ends when no message changes by more than _TOLERANCE, or, where loops keep it from settling, after 100 rounds and as many as there are nodes.
        """
        own = (np.array(bits, np.int64)[:, None] >> np.arange(N_FEATURES) & 1) @ self.weights
        given = np.flatnonzero(known) if known is not None else []
        if len(given):
            own[given] = -_CERTAIN
            own[given, np.array(known)[given]] = 0
        if edges:
            kind, a, b = np.array(edges).T
            source, target = np.r_[a, b], np.r_[b, a]
            potential = np.concatenate([self.pairs[kind], self.pairs[kind].transpose(0, 2, 1)])
            back = np.r_[len(a) : 2 * len(a), 0 : len(a)]
            messages = np.zeros((len(source), len(LABELS)))
            for _ in range(100 + len(own)):
                total = own.copy()
                np.add.at(total, target, messages)
                new = np.logaddexp.reduce((total[source] - messages[back])[:, :, None] + potential, axis=1)
                new -= np.logaddexp.reduce(new, axis=1)[:, None]
                settled = np.abs(new - messages).max() < _TOLERANCE
                messages = 0.5 * messages + 0.5 * new
                if settled:
                    break
            np.add.at(own, target, messages)
        return np.exp(own - np.logaddexp.reduce(own, axis=1)[:, None])


def train(docs: DataFrame) -> Field:
    """The random field of a corpus. Only counts of what nodes and the labels around them look like come to the driver; there are few kinds of either."""
    rows = docs.select("text").mapInArrow(_observed, "bits long, label long, beside long, n long").groupBy("bits", "label", "beside").agg(F.sum("n").alias("n")).collect()
    return Field(sorted(tuple(r) for r in rows))


def further_spans(text: str, base: list[tuple[int, int, int]], field: Field, belief: float) -> list[tuple[int, int, int]]:
    nodes = nodes_of(text)
    if not nodes:
        return []
    touched = node_labels(nodes, base)
    if all(touched):
        return []
    beliefs = field.beliefs([features(text[a:b]) for a, b in nodes], edges_of(text, nodes), touched)
    best = beliefs.argmax(1)
    out: list[tuple[int, int, int]] = []
    for (start, end), label, sure, known in zip(nodes, best.tolist(), beliefs.max(1).tolist(), touched, strict=True):
        if known or not label or sure < belief:
            continue
        token = text[start:end]
        start += len(token) - len(token.lstrip(_EDGE))
        end -= len(token) - len(token.rstrip(_EDGE))
        if out and out[-1][0] == label - 1 and start - out[-1][2] == 1:
            start = out.pop()[1]
        if start < end:
            out.append((label - 1, start, end))
    return sorted(out)


def _found(batches: Iterator[pa.RecordBatch], field: Broadcast, belief: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: tuple[list, ...] = ([], [])
        for text in batch.column(batch.schema.get_field_index("text")):
            text = text.as_py() or ""
            base = base_spans(text)
            rows[0].append([{"kind": KINDS[k], "start": a, "end": b} for k, a, b in base])
            rows[1].append([{"kind": KINDS[k], "start": a, "end": b} for k, a, b in further_spans(text, base, field.value, belief)])
        spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(r, spans) for r in rows)], [*batch.schema.names, *_SPANS])


def find(docs: DataFrame, belief: float = 0.9) -> DataFrame:
    """Adds pii_base and pii_further, array<struct<kind, start, end>>; docs must not have columns so named."""
    if set(_SPANS) & set(docs.columns):
        raise ValueError(f"the columns {_SPANS} are added; rename those that docs has")
    field = docs.sparkSession.sparkContext.broadcast(train(docs))
    spans = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    return map_batches(docs, partial(_found, field=field, belief=belief), [T.StructField(name, spans) for name in _SPANS])


def _joined(*columns: str) -> F.Column:
    """kind:start:end of the spans in these columns, by kind as listed and start."""
    order = F.array(*map(F.lit, KINDS))
    spans = F.transform(F.concat(*columns), lambda s: F.struct(F.array_position(order, s["kind"]), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(docs: DataFrame, belief: float = 0.9) -> DataFrame:
    """documents -> doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    found = find(docs.select("doc_id", "text"), belief)
    counts = [F.expr(f"cast(size(filter(pii_base, s -> s.kind = '{kind}')) as long)").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(_joined("pii_base"), 256).alias("base_sha256"), _joined(*_SPANS).alias("spans"))


def _masked(batches: Iterator[pa.RecordBatch], field: Broadcast, belief: float, text_at: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text in batch.column(text_at):
            text = text.as_py()
            base = base_spans(text) if text else []
            spans = [*base, *further_spans(text, base, field.value, belief)] if text else []
            if spans:
                parts, at = [], 0
                for start, end, kind in sorted((a, b, KINDS[k]) for k, a, b in spans):
                    if end > at:
                        parts += [text[at : max(at, start)], f"<{kind}>"]
                        at = end
                text = "".join(parts) + text[at:]
            texts.append(text)
        yield batch.set_column(text_at, "text", pa.array(texts, pa.string()))


def mask(docs: DataFrame, belief: float = 0.9) -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets; of spans that overlap, each replaces what is left of it.

    All columns stay as they are but text. Null texts stay null.
    """
    field = docs.sparkSession.sparkContext.broadcast(train(docs))
    return map_batches(docs, partial(_masked, field=field, belief=belief, text_at=docs.columns.index("text")))
