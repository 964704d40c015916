"""Benchmark passages in documents, found by a suffix automaton of the benchmark's items.

The items' words go into one generalised suffix automaton (several, one after another, if the items
are many). A document is streamed through it word by word; the automaton's state and the length of the
longest match that ends at a word say which windows of items end there. A word that no item has puts
the automaton back to its start, so only runs of known words are streamed, found by numpy.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelayers.llm.batches import steps
from carelayers.sources.layers import shared_folder

#: Words in a window.
WINDOW = 10
#: Words of items in one automaton, and about as many bytes of items in a block times eight.
BLOCK_WORDS = 100_000
#: Words of an item that a block takes in one piece; longer items are cut, with an overlap.
PIECE_WORDS = 20_000

# Fixed: a word is a run of digits, letters a-z after lower-casing A-Z, and anything beyond ASCII.
_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
_LOWERED = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or c in _KEPT else 32 for c in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text, A-Z in lower case; NULL has none."""
    return text.translate(_LOWERED).split() if text else []


class Automaton:
    """A generalised suffix automaton of items, and which windows end in each of its states.

    ``items`` are ``(name, words, whole)``; a window is ``window`` consecutive words of an item, or all
    its words if there are fewer (``whole`` is false for pieces of longer items). State 0 is the start.
    """

    def __init__(self, items: Iterable[tuple[str | None, Sequence[bytes], bool]], window: int = WINDOW):
        items = [(name, ws, whole) for name, ws, whole in items if ws]
        self.window = window
        self.ids = {w: i for i, w in enumerate(dict.fromkeys(w for _, ws, _ in items for w in ws))}
        coded = [[self.ids[w] for w in ws] for _, ws, _ in items]
        self._build(coded)
        self._mark([(name, ids, whole) for (name, _, whole), ids in zip(items, coded)])
        self.shortest = min((min(window, len(ids)) for ids in coded), default=window)

    def _build(self, texts: list[list[int]]) -> None:
        after: list[dict[int, int]] = [{}]
        link, length = [-1], [0]

        def state(size: int, to: dict[int, int], up: int) -> int:
            after.append(to)
            length.append(size)
            link.append(up)
            return len(after) - 1

        def split(at: int, word: int, target: int) -> int:
            """A state for the strings of ``target`` that are no longer than ``at`` allows."""
            if length[at] + 1 == length[target]:
                return target
            twin = state(length[at] + 1, dict(after[target]), link[target])
            link[target] = twin
            while at >= 0 and after[at].get(word) == target:
                after[at][word] = twin
                at = link[at]
            return twin

        for text in texts:
            last = 0
            for word in text:
                known = after[last].get(word)
                if known is not None:
                    last = split(last, word, known)
                    continue
                new, at = state(length[last] + 1, {}, 0), last
                while at >= 0 and word not in after[at]:
                    after[at][word] = new
                    at = link[at]
                if at >= 0:
                    link[new] = split(at, word, after[at][word])
                last = new
        self.link, self.length, self.size = link, length, len(self.ids)
        self.go = {s * self.size + w: t for s, to in enumerate(after) for w, t in to.items()}

    def _mark(self, items: list[tuple[str | None, list[int], bool]]) -> None:
        link, length, n = self.link, self.length, self.window
        order = sorted(range(1, len(link)), key=length.__getitem__)
        # The state of the last ``window`` words, where a state holds that many.
        self.gram = gram = [0] * len(link)
        for s in order:
            if length[s] >= n:
                gram[s] = s if length[link[s]] < n else gram[link[s]]
        self.names: dict[int, set[str | None]] = {}
        ends = set()
        for name, ids, whole in items:
            s = 0
            for i, w in enumerate(ids, 1):
                s = self.go[s * self.size + w]
                if i >= n:
                    self.names.setdefault(gram[s], set()).add(name)
            if whole and len(ids) < n:
                ends.add(s)
                self.names.setdefault(s, set()).add(name)
        # The nearest state, upwards from a state, that ends an item shorter than a window; 0: none.
        self.short = short = [0] * len(link)
        for s in order:
            short[s] = s if s in ends else short[link[s]]
        # A window ends at a match of so many words.
        never = len(link) + 1
        self.least = [never] * len(link)
        for s in order:
            if short[link[s]]:
                self.least[s] = 0
            else:
                self.least[s] = length[s] if s in ends else n if gram[s] else never

    def _windows(self, s: int, matched: int, seen: set[int]) -> int:
        """Adds the states of the windows that end here to ``seen``; returns the longest one's words."""
        longest = 0
        if matched >= self.window and self.gram[s]:
            longest = self.window
            seen.add(self.gram[s])
        end = self.short[s]
        if end == s and matched < self.length[s]:
            end = self.short[self.link[s]]
        while end:
            longest = max(longest, self.length[end])
            seen.add(end)
            end = self.short[self.link[end]]
        return longest

    def _stream(self, ids: list[int], at: int, spans: list[tuple[int, int]], seen: set[int]) -> None:
        go, link, length, least, size = self.go, self.link, self.length, self.least, self.size
        s = matched = 0
        for i, w in enumerate(ids, at + 1):
            to = go.get(s * size + w)
            while to is None:
                s = link[s]
                matched = length[s]
                to = go.get(s * size + w)
            s = to
            matched += 1
            if matched >= least[s]:
                width = self._windows(s, matched, seen)
                start = i - width
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, i))

    def scan(self, found: list[bytes]) -> tuple[list[tuple[int, int]], list[str]]:
        """Ranges of hit words, joined where they touch, and the names of the items hit, sorted."""
        if len(found) < self.shortest or not self.ids:
            return [], []
        get = self.ids.get
        ids = np.fromiter((get(w, -1) for w in found), np.int64, len(found))
        edges = np.flatnonzero(np.diff(ids >= 0, prepend=False, append=False))
        spans: list[tuple[int, int]] = []
        seen: set[int] = set()
        for start, end in edges.reshape(-1, 2).tolist():
            if end - start >= self.shortest:
                self._stream(ids[start:end].tolist(), start, spans, seen)
        return spans, sorted({name for s in seen for name in self.names[s] if name is not None})


def _pieces(window: int):
    """Items as numbered blocks of bounded size; a long item in pieces that share ``window - 1`` words."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = uuid.uuid4().hex
        block = held = 0
        for batch in steps(batches):
            rows = []
            for name, text in zip(batch["name"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist()):
                found = words(text)
                whole = len(found) <= PIECE_WORDS
                last = 1 if whole else len(found) - window + 1
                for start in range(0, last, PIECE_WORDS - window + 1):
                    piece = found[start : start + PIECE_WORDS]
                    size = max(len(piece), sum(map(len, piece)) // 8)
                    if held and held + size > BLOCK_WORDS:
                        block, held = block + 1, 0
                    held += size
                    rows.append((f"{part}-{block}", name, b" ".join(piece).decode(), whole))
            kinds = (pa.string(), pa.string(), pa.string(), pa.bool_())
            columns = list(zip(*rows)) or [()] * 4
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, ["block", "name", "text", "whole"])

    return cut


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> tuple[DataFrame, list[str]]:
    """The written pieces of all items, and the names of their blocks."""
    spark = benchmark.sparkSession
    size = benchmark.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    items = benchmark.select(F.col(id_col).cast("string").alias("name"), F.col(text_col).cast("string").alias("text"))
    parts = items.coalesce(max(1, -(-size // (8 * BLOCK_WORDS))))
    folder = shared_folder(spark, "benchmark")
    schema = "block string, name string, text string, whole boolean"
    parts.mapInArrow(_pieces(window), schema).where("text <> ''").write.parquet(folder)
    pieces = spark.read.parquet(folder)
    return pieces, [r.block for r in pieces.select("block").distinct().orderBy("block").collect()]


_BUILT: dict[str, Automaton] = {}


def _built(name: str, block, window: int) -> Automaton:
    """The automaton of a block; a worker process keeps the last one."""
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Automaton([(i, t.encode().split(), w) for i, t, w in block.value], window)
    return _BUILT[name]


def _scanner(block, name: str, window: int, kept: list[str]):
    """Kept columns, ``n_words``, ``spans`` and ``items`` of each row's ``__text``."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _built(name, block, window)
        for batch in steps(batches):
            n_words, spans, items = [], [], []
            for text in batch["__text"].cast(pa.binary()).to_pylist():
                found = words(text)
                where, what = automaton.scan(found)
                n_words.append(len(found))
                spans.append([{"start": a, "end": b} for a, b in where])
                items.append(what)
            arrays = [batch[c] for c in kept]
            arrays += [pa.array(n_words, pa.int64()), pa.array(spans, span), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(arrays, [*kept, "n_words", "spans", "items"])

    return scan


def _joined_spans(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans that touch become one."""
    for batch in steps(batches):
        out = []
        for spans in batch["spans"].to_pylist():
            joined: list[dict] = []
            for s in sorted(spans, key=lambda s: (s["start"], s["end"])):
                if joined and s["start"] <= joined[-1]["end"]:
                    joined[-1]["end"] = max(joined[-1]["end"], s["end"])
                else:
                    joined.append(s)
            out.append(joined)
        arrays = [batch["row"], pa.array(out, batch.schema.field("spans").type), batch["items"]]
        yield pa.RecordBatch.from_arrays(arrays, ["row", "spans", "items"])


_FOUND = "n_words bigint, spans array<struct<start:bigint,end:bigint>>, items array<string>"


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``row`` (the columns ``keep`` of ``docs``, or all), ``n_words``, ``spans`` and ``items``, one row per document.

    A window is ``window`` consecutive words of an item, or a whole shorter item. ``spans`` are the ranges
    of words (from 0, end exclusive) that lie in any occurrence of a window, in order and apart; ``items``
    the sorted ids, as text, of the items whose windows occur. NULL and empty texts have no words, items
    without words no window; an item without an id marks words but is not listed, and items that repeat an
    id count as one. Repeated documents are rows of their own. Names in ``docs`` do not matter.

    Items are taken in blocks of bounded size, one automaton and one pass over the documents for each;
    with more than one block the documents are written once with row numbers.
    """
    spark = docs.sparkSession
    pieces, names = _blocks(benchmark, item_col, item_text_col, window)
    whole = docs.select(F.struct(*(keep or docs.columns)).alias("row"), F.col(text_col).cast("string").alias("__text"))
    row_type = f"row {whole.schema['row'].dataType.simpleString()}"

    def scanned(rows: DataFrame, name: str | None, kept: str) -> DataFrame:
        held = [] if name is None else pieces.where(F.col("block") == name).select("name", "text", "whole").collect()
        block = spark.sparkContext.broadcast([tuple(r) for r in held])
        columns = [c for c in rows.columns if c != "__text"]
        return rows.mapInArrow(_scanner(block, name or "", window, columns), f"{kept}, {_FOUND}")

    if len(names) < 2:
        return scanned(whole, names[0] if names else None, row_type)
    folder = shared_folder(spark, "decontaminate")
    whole.withColumn("number", F.monotonically_increasing_id()).write.parquet(f"{folder}/docs")
    numbered = spark.read.parquet(f"{folder}/docs")
    for n, name in enumerate(names):
        hits = scanned(numbered.select("number", "__text"), name, "number bigint").where("size(spans) > 0")
        hits.select(F.col("number").alias("row"), "spans", "items").write.parquet(f"{folder}/block={n}")
    hits = spark.read.option("basePath", folder).parquet(*[f"{folder}/block={n}" for n in range(len(names))])
    merged = hits.groupBy("row").agg(
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    merged = merged.mapInArrow(_joined_spans, f"row bigint, {_FOUND.split(', ', 1)[1]}")
    counted = scanned(numbered, None, f"{row_type}, number bigint").select("row", "number", "n_words")
    none = [F.array().cast(k).alias(c) for c, k in (("spans", "array<struct<start:bigint,end:bigint>>"), ("items", "array<string>"))]
    picked = [F.coalesce(F.col(f"found.{c}"), e).alias(c) for c, e in zip(("spans", "items"), none)]
    both = counted.alias("docs").join(merged.alias("found"), F.col("docs.number") == F.col("found.row"), "left")
    return both.select("docs.row", "docs.n_words", *picked)


def n_hit(spans: Column) -> Column:
    """Words in all spans."""
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of the spans and what stands between them."""
    out, kept, waiting = [], 0, iter(spans)
    span = next(waiting, None)
    start = 0
    for n, word in enumerate(_WORD.finditer(text)):
        if span is None:
            break
        if n == span[0]:
            start = word.start()
        if n == span[1] - 1:
            out.append(text[kept:start])
            kept, span = word.end(), next(waiting, None)
    return "".join(out) + text[kept:]


def _cleaner(max_words: int, max_coverage: float):
    def clean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            texts, removed = [], []
            columns = (batch[c].to_pylist() for c in ("text", "n_words", "spans"))
            for text, n_words, spans in zip(*columns):
                ranges = [(s["start"], s["end"]) for s in spans]
                if sum(b - a for a, b in ranges) <= max_coverage * n_words:
                    ranges = [(a, b) for a, b in ranges if b - a > max_words]
                texts.append(_without(text, ranges) if ranges else text)
                removed.append(len(ranges))
            arrays = [batch["row"], pa.array(texts, pa.string()), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "text", "removed"])

    return clean


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    max_words: int = 0,
    max_coverage: float = 0.0,
    removed_col: str = "n_spans_removed",
    **options,
) -> DataFrame:
    """``docs`` without benchmark passages, and how many each row lost.

    Spans (see ``find_passages``) of more than ``max_words`` words go; where all spans together cover more
    than ``max_coverage`` of a document's words, all its spans go. Text before the first word of a span and
    after its last stays as it is. No document is dropped; NULL stays NULL.
    """
    found = find_passages(docs, benchmark, text_col, **options)
    rows = found.select("row", F.col(f"row.`{text_col}`").cast("string").alias("text"), "n_words", "spans")
    schema = f"row {rows.schema['row'].dataType.simpleString()}, text string, removed bigint"
    clean = rows.mapInArrow(_cleaner(max_words, max_coverage), schema)
    kept = [c for c in docs.columns if c.lower() != removed_col.lower()]
    picked = [F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in kept]
    return clean.select(*picked, F.col("removed").alias(removed_col))
