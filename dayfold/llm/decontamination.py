"""Benchmark decontamination with a generalised suffix automaton.

The words of all test items make one automaton, which accepts every run of words of any item.
Each document's words stream through it: after every word the state stands for the longest run
ending there that occurs in an item. Where that run is as long as a window, the window's words
are hit. An item shorter than a window, but not empty, is a window as a whole.

Null and empty texts have no words and no hits. Items without words are in no automaton. Repeated
rows are judged each on its own; other columns of the documents are kept by ``decontaminate``,
whatever their names. An item that is listed twice is one item per distinct id; a null id counts
as an item but is left out of ``items``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from .common import map_batches, written
from .words import LETTERS_BLANKED, fast_split

WINDOW = 13

# Words of one automaton. A benchmark with more words makes several, each of which all documents
# pass in turn, so neither the driver nor a task ever holds more than one block.
BLOCK_WORDS = 2_000_000

_NEVER = 1 << 62


class Automaton:
    """Generalised suffix automaton over words, with the windows that end in each state."""

    def __init__(self, items: Sequence[tuple[object, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        ids: list[set] = [set() for _ in self.link]
        whole: list[dict[int, set]] = [{} for _ in self.link]  # items shorter than a window, by length
        for item, words in items:
            state = 0
            for word in words:
                at = state = self.next[state][word]
                while len(words) >= window and at > 0 and item not in ids[at]:
                    ids[at].add(item)
                    at = self.link[at]
            if 0 < len(words) < window:
                whole[state].setdefault(len(words), set()).add(item)
        self._find_windows(ids, whole)

    def _extend(self, last: int, word: bytes) -> int:
        if word in self.next[last]:
            known = self.next[last][word]
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, word, known)
        new = self._state(self.length[last] + 1, {}, 0)
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at >= 0:
            known = self.next[at][word]
            if self.length[known] == self.length[at] + 1:
                self.link[new] = known
            else:
                self.link[new] = self._split(at, word, known)
        return new

    def _state(self, length: int, follow: dict[bytes, int], link: int) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, at: int, word: bytes, known: int) -> int:
        """A state for the shorter runs of ``known``, which ``at`` and its suffixes lead to."""
        new = self._state(self.length[at] + 1, dict(self.next[known]), self.link[known])
        self.link[known] = new
        while at >= 0 and self.next[at].get(word) == known:
            self.next[at][word] = new
            at = self.link[at]
        return new

    def _find_windows(self, ids: list[set], whole: list[dict[int, set]]) -> None:
        """For each state the windows among the suffixes of its runs: their lengths and items."""
        order = sorted(range(1, len(self.link)), key=self.length.__getitem__)
        self.windows: list[list[tuple[int, frozenset]]] = [[] for _ in self.link]
        for state in order:
            up, own = self.windows[self.link[state]], []
            for n, items in sorted(whole[state].items()):
                own.append((n, frozenset(items)))
            if self.length[state] >= self.window > self.length[self.link[state]]:
                own.append((self.window, frozenset(ids[state])))
            self.windows[state] = up + own if own else up
        self.least = [w[0][0] if w else _NEVER for w in self.windows]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Hit stretches ``[first, end)`` of the words in order, and the items whose windows occur."""
        follow, link, length, least = self.next, self.link, self.length, self.least
        root = follow[0]
        spans: list[tuple[int, int]] = []
        found: set = set()
        seen: set = set()
        state = n = 0
        for i, word in enumerate(words, 1):
            to = follow[state].get(word)
            if to is None:
                if not state:
                    continue
                while state and to is None:
                    state = link[state]
                    to = follow[state].get(word)
                if to is None:
                    n = 0
                    continue
                n = length[state]
            state = to
            n += 1
            if n >= least[state]:
                longest = 0
                for size, items in self.windows[state]:
                    if size <= n:
                        longest = size
                        if (state, size) not in seen:
                            seen.add((state, size))
                            found |= items
                if longest:
                    first = i - longest
                    while spans and spans[-1][1] >= first:
                        first = min(first, spans.pop()[0])
                    spans.append((first, i))
        return spans, found


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[list]:
    """Items in blocks of about ``block_words`` words, read one after the other."""
    block, size = [], 0
    for row in items.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).toLocalIterator():
        words = fast_split(row["t"])
        if not words:
            continue
        if block and size + len(words) > block_words:
            yield block
            block, size = [], 0
        block.append((row["i"], words))
        size += len(words)
    if block:
        yield block


def overlaps(
    docs: DataFrame,
    items: DataFrame,
    keep: Sequence[str],
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``keep`` columns of each document with its words in items' windows.

    Adds ``n_words``, ``n_hit``, ``spans`` (hit stretches of words, first and end) and ``items``
    (ids, as text, of the items with a window in the document, sorted).
    """
    spark = docs.sparkSession
    out = docs.select(*keep, F.col(text).alias("__text"), F.expr("array()").cast(
        "array<struct<first:bigint,end:bigint>>").alias("spans"), F.expr("array()").cast("array<string>").alias("items"))
    first = True
    for block in item_blocks(items, item_id, item_text, block_words):
        if not first:
            out = written(out, "overlaps")
        first = False
        out = _scanned(spark, out, block, window)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda t, s: t + s["end"] - s["first"])
    words = F.regexp_count("__text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    if first:  # no item has words
        out = out.withColumn("n_words", F.coalesce(words, F.lit(0)).cast("long"))
    return out.select(*keep, F.col("__text").alias("text"), "n_words", n_hit.alias("n_hit"), "spans",
                      F.array_sort(F.array_distinct("items")).alias("items"))


def _scanned(spark, docs: DataFrame, block: list, window: int) -> DataFrame:
    """Documents with the hits of one block of items added to those they have."""
    sent = spark.sparkContext.broadcast((block, window))
    kept = [f for f in docs.schema if f.name not in ("spans", "items", "n_words")]
    columns = [f.name for f in kept]
    schema = T.StructType([*kept, docs.schema["spans"], docs.schema["items"], T.StructField("n_words", T.LongType())])
    built: list[Automaton] = []

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not built:
            built.append(Automaton(*sent.value))
        automaton, spans, found, counts = built[0], [], [], []
        texts, had, names = (batch.column(batch.schema.get_field_index(c)) for c in ("__text", "spans", "items"))
        for i in range(len(batch)):
            text = texts[i]
            # .as_buffer() gives the bytes without making a Python string of them.
            words = text.as_buffer().to_pybytes().translate(LETTERS_BLANKED).split() if text.is_valid else []
            hit, ids = automaton.scan(words)
            old = had[i].as_py() if len(had[i]) else []
            spans.append(_merged([*((s["first"], s["end"]) for s in old), *hit]) if old else [
                {"first": a, "end": b} for a, b in hit])
            old = names[i].as_py() if len(names[i]) else []
            found.append(sorted({*old, *(str(x) for x in ids if x is not None)}))
            counts.append(len(words))
        kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        same = [batch.column(batch.schema.get_field_index(c)) for c in columns]
        return pa.RecordBatch.from_arrays(
            [*same, pa.array(spans, kind), pa.array(found, pa.list_(pa.string())), pa.array(counts, pa.int64())],
            names=[*columns, "spans", "items", "n_words"],
        )

    return map_batches(docs, scan, schema)


def _merged(spans: list[tuple[int, int]]) -> list[dict]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [{"first": a, "end": b} for a, b in out]


def contaminated(n_hit="n_hit", n_words="n_words", coverage_percent: int = 5):
    """Whether hit words make up at least so much of a document, and there are any."""
    return (F.col(n_hit) > 0) & (100 * F.col(n_hit) >= coverage_percent * F.col(n_words))


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    window: int = WINDOW,
    coverage_percent: int = 5,
    cut_spans: bool = True,
    **options,
) -> DataFrame:
    """Documents with their own columns: contaminated ones go, hit stretches of others are cut.

    A document whose hit words reach the coverage limit is removed. In the others every stretch
    of hit words, which is as long as a window or a whole item, is replaced by one blank if
    ``cut_spans``; texts without hits stay as they are, byte for byte.
    """
    columns = docs.columns
    rest = [c for c in columns if c != text]
    packed = docs.select(
        F.struct(F.lit(0).alias("__"), *[F.col(f"`{c}`") for c in rest]).alias("__rest"), F.col(f"`{text}`").alias("__t")
    )
    hits = overlaps(packed, items, ["__rest"], text="__t", window=window, **options)
    kept = hits.filter(~contaminated(coverage_percent=coverage_percent)).select("__rest", "text", "spans")
    if cut_spans:
        kept = map_batches(kept, _cut, kept.schema)
    kind = dict(docs.dtypes)[text]
    return kept.select(*[
        F.col("text").cast(kind).alias(c) if c == text else F.col(f"__rest.`{c}`").alias(c) for c in columns
    ])


def _cut(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Texts without their hit stretches of words, each of which leaves one blank."""
    texts, spans = batch.column(1), batch.column(2)
    hit = pc.greater(pc.list_value_length(spans), 0)
    if not pc.any(hit).as_py():
        return batch
    out = [_without(t.as_py(), s.as_py()) if h else t.as_py() for t, s, h in zip(texts, spans, hit.to_pylist())]
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, texts.type), spans], schema=batch.schema)


def _without(text: str, spans: list[dict]) -> str:
    data = text.encode()
    places = [m.span() for m in re.finditer(rb"[0-9A-Za-z\x80-\xff]+", data)]
    out, at = [], 0
    for span in spans:
        out.append(data[at : places[span["first"]][0]].rstrip(b" "))
        at = places[span["end"] - 1][1]
    return b" ".join([*out, data[at:].lstrip(b" ")]).decode()
