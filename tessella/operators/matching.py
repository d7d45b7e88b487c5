"""Many words in one pass over each text: an automaton that finds all of them, overlaps included, and a walk that marks the leftmost longest.

The words of all works travel to the tasks if they are few enough; texts are then matched where they lie, without a shuffle, so a work that is most of the data
is many tasks. Each task builds a work's matcher when it first meets the work.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SMALL_GLOSSARIES = 16 << 20  # bytes of all works' words that travel to every task
SLICE = 256  # texts that are taken out of Arrow together
_MATCHERS = 256  # works whose matchers a task keeps


def few_words(words: DataFrame, *columns: str) -> bool:
    """Whether the words, with these columns, fit every task."""
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in columns), F.lit(64))
    return (words.agg(F.sum(size)).first()[0] or 0) <= SMALL_GLOSSARIES


def by_work(words: DataFrame, *columns: str) -> dict[str | None, list[tuple]]:
    """The distinct values of the columns for each work; only for words that few_words() has measured."""
    out: dict[str | None, list[tuple]] = {}
    for row in words.select("work", *columns).distinct().collect():
        out.setdefault(row.work, []).append(tuple(row)[1:])
    return out


def automaton(words: list[str]) -> ahocorasick.Automaton | None:
    """With failure links, so that a text is read once whatever the number of words; None for no words."""
    found = ahocorasick.Automaton()
    for word in words:
        found.add_word(word, word)
    found.make_automaton()
    return found if words else None


def _cached(make: Callable, words: Broadcast) -> Callable:
    return lru_cache(_MATCHERS)(lambda work: make(words.value.get(work, [])))


def sliced(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batches in slices of so many rows, so that few texts at a time are Python objects, however many rows Spark puts into a batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _contained(batches: Iterator[pa.RecordBatch], words: Broadcast, n_keys: int) -> Iterator[pa.RecordBatch]:
    """The keys of each text, its work first, with every distinct word that it holds."""
    matcher = _cached(lambda some: automaton([w for (w,) in some if w]), words)
    for batch in sliced(batches):
        rows, hits = [], []
        for i, (work, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(n_keys).to_pylist(), strict=True)):
            found = matcher(work)
            if found is not None and text:
                some = {word for _, word in found.iter(text)}
                rows += [i] * len(some)
                hits += some
        place = pa.array(rows, pa.int32())
        yield pa.RecordBatch.from_arrays([*(c.take(place) for c in batch.columns[:n_keys]), pa.array(hits, pa.string())], [*batch.schema.names[:n_keys], "word"])


def contained_words(texts: DataFrame, text: str, words: DataFrame) -> DataFrame:
    """(work, more keys, text) and few words (work, word) -> the keys with each distinct word of the work anywhere in the text. Empty words are not looked for."""
    keys = ["work", *(c for c in texts.columns if c not in ("work", text))]
    given = texts.sparkSession.sparkContext.broadcast(by_work(words, "word"))
    schema = T.StructType([texts.schema[c] for c in keys] + [T.StructField("word", T.StringType())])
    return texts.select(*keys, text).mapInArrow(partial(_contained, words=given, n_keys=len(keys)), schema)


class Walk:
    """Leftmost longest words: of all words that the automaton finds, those that begin before the last one ended are passed over."""

    def __init__(self, tips: list[tuple[str, str]]) -> None:
        self.tips = {word: tip for word, tip in tips if len(word) >= 2}
        self.automaton = automaton(list(self.tips))

    def spans(self, text: str) -> Iterator[tuple[int, int]]:
        if self.automaton is None:
            return
        at = 0
        for start, less in sorted((end + 1 - len(word), -len(word)) for end, word in self.automaton.iter(text)):
            if start >= at:
                at = start - less
                yield start, at


def _pieces(text: str, spans: Iterator[tuple[int, int]], mark: Callable[[str], str]) -> str:
    out, at = [], 0
    for start, end in spans:
        out += [text[at:start], mark(text[start:end])]
        at = end
    return "".join([*out, text[at:]])


def _text_nodes(html: str) -> Iterator[tuple[bool, str]]:
    """(is text, piece): what stands between tags, and the tags. A < without an end is text."""
    at = 0
    while at < len(html):
        start = html.find("<", at)
        end = html.find(">", start + 2) if start >= 0 else -1
        if end < 0:
            yield True, html[at:]
            return
        if start > at:
            yield True, html[at:start]
        yield False, html[start : end + 1]
        at = end + 1


def marked(html: str, walk: Walk, mark: Callable[[str, str], str]) -> str:
    """The html with every leftmost longest word in its text nodes replaced by its mark."""
    put = lambda word: mark(word, walk.tips[word])
    return "".join(_pieces(piece, walk.spans(piece), put) if is_text else piece for is_text, piece in _text_nodes(html))


def mapped_texts(frame: DataFrame, text: str, of_row: Callable[[str, Walk], object], out: T.StructField, tips: DataFrame | None) -> DataFrame:
    """frame with a column made from each text and the words of its work; with tips None, from the words in the row's own column `words`, [{word, tip}].

    Null texts give null.
    """
    names = frame.columns
    given = None if tips is None else frame.sparkSession.sparkContext.broadcast(by_work(tips, "word", "tip"))
    work_at, text_at, words_at = names.index("work"), names.index(text), names.index("words") if given is None else -1

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = None if given is None else _cached(Walk, given)
        for batch in sliced(batches):
            if walk:
                walks = map(walk, batch.column(work_at).to_pylist())
            else:
                walks = (Walk([(w["word"], w["tip"]) for w in some or []]) for some in batch.column(words_at).to_pylist())
            made = [None if t is None else of_row(t, w) for t, w in zip(batch.column(text_at).to_pylist(), walks, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, arrow)], [*batch.schema.names, out.name])

    from pyspark.sql.pandas.types import to_arrow_type

    arrow = to_arrow_type(out.dataType)
    return frame.mapInArrow(rows, T.StructType([*frame.schema.fields, out]))
