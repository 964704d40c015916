"""Collocations: frequent phrases of up to five words, scored by their weakest cut.

Texts become chunks of word numbers, each with a small dictionary of its own; the dictionaries are
added up, and frequent words get ids by frequency. Then the same step is done for pairs, triples and so
on: neighbouring ids are counted per chunk, the counts added up, and frequent pairs get ids by frequency
in their turn, which replace the ids they were made of. A pair of overlapping phrases of k words is a
phrase of k + 1 words.

Within a chunk, ids are cut into ranges, and pairs into the tiles that two ranges span. As ids follow
frequency, a few tiles hold most pairs: a tile with many is counted in a dense array by address, all
others together as sorted coordinates.

New ids reach the chunks as one table for all tasks while they are few, as counted; beyond that they are
joined with what each chunk has counted. The results are the same.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelayers.llm.batches import steps
from carelayers.operators.ranking import rank_within
from carelayers.sources.layers import shared_folder

#: Occurrences that make a phrase a candidate.
MIN_COUNT = 100
#: Words of the longest phrase.
MAX_WORDS = 5
#: Phrases reported for each language.
TOP = 2000
#: Words that a task gathers before it writes its chunks, one for each language it has met.
CHUNK_WORDS = 1_500_000
#: Bytes of a long text that are split at once (more if it has no break there).
SLICE_BYTES = 4 << 20
#: Counts in one batch.
ROWS = 100_000
#: Words or phrases whose ids are sent to all tasks (12 bytes and a word each); more are joined.
BROADCAST_ROWS = 500_000
#: Ids in a range: a tile has this number squared of addresses.
TILE = 1024
#: A tile with so many pairs of a chunk is counted by address.
DENSE = TILE * TILE // 16

# Fixed: phrases do not cross these characters; words are apart by blanks and tabs.
_BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
_PLAIN = bytes(10 if c in _BREAKS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


class _Numbers(dict):
    """Numbers words as they come; blanks between words are 0 and breaks 1."""

    def __init__(self):
        super().__init__({b"": 0, b"\n": 1})

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _slices(data: bytes) -> Iterator[bytes]:
    """``data`` cut at breaks into parts of about ``SLICE_BYTES``."""
    start = 0
    while len(data) - start > SLICE_BYTES:
        end = data.rfind(b"\n", start, start + SLICE_BYTES)
        if end < 0:
            end = data.find(b"\n", start + SLICE_BYTES)
            if end < 0:
                break
        yield data[start:end]
        start = end + 1
    yield data[start:]


def _tight(ids: np.ndarray) -> np.ndarray:
    """``ids`` without those that have no neighbour, and with one -1 between runs."""
    held = np.concatenate(([False], ids >= 0, [False]))
    paired = held[1:-1] & (held[:-2] | held[2:])
    before = np.concatenate(([False], paired[:-1]))
    return np.where(paired, ids, -1)[paired | before].astype(np.int32)


def _packed(ids: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(ids.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.int32)


_CHUNK = "chunk bigint, lang string, n_words bigint, ids binary, words array<string>, counts array<bigint>"


def _chunks(batches: Iterable[pa.RecordBatch], chunk_words: int) -> Iterator[pa.RecordBatch]:
    """Chunks of the texts of each language, with their words and how often each occurs."""
    serial = TaskContext.get().partitionId() << 32
    gathered: dict[str, tuple[_Numbers, list[np.ndarray]]] = {}
    size = 0

    def written() -> Iterator[pa.RecordBatch]:
        nonlocal serial
        for lang, (number, parts) in gathered.items():
            words = list(number)[2:]
            if not words:
                continue
            ids = np.concatenate(parts) - 2
            counts = np.bincount(ids[ids >= 0], minlength=len(words))
            values = (serial, lang, int(counts.sum()), _packed(_tight(ids)), [w.decode() for w in words], counts)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64()))
            names = ["chunk", "lang", "n_words", "ids", "words", "counts"]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)
            serial += 1

    for batch in steps(batches):
        together: dict[str, list[bytes]] = {}
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist()):
            if text:
                together.setdefault(lang, []).append(text)
        for lang, texts in together.items():
            for data in _slices(b"\n".join(texts).translate(_PLAIN)):
                tokens = data.replace(b"\n", b" \n ").split(b" ")
                number, parts = gathered.setdefault(lang, (_Numbers(), []))
                ids = np.fromiter(map(number.__getitem__, tokens), np.int32, len(tokens))
                ids = np.append(ids[ids > 0], np.int32(1))
                parts.append(ids)
                size += len(ids)
                if size >= chunk_words:
                    yield from written()
                    gathered.clear()
                    size = 0
    yield from written()


def pair_counts(ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(first, second, count)`` of all pairs of neighbouring ids; -1 is a break."""
    first, second = ids[:-1].astype(np.int64), ids[1:].astype(np.int64)
    both = (first >= 0) & (second >= 0)
    first, second = first[both], second[both]
    if not len(first):
        return
    side = int(max(first.max(), second.max())) // TILE + 1
    tile = first // TILE * side + second // TILE
    met, sizes = np.unique(tile, return_counts=True) if side > 4096 else (None, np.bincount(tile))
    full = np.flatnonzero(sizes >= DENSE)
    rest = np.ones(len(first), bool)
    for t in full if met is None else met[full]:
        at = tile == t
        rest &= ~at
        counts = np.bincount(first[at] % TILE * TILE + second[at] % TILE, minlength=TILE * TILE)
        address = np.flatnonzero(counts)
        yield t // side * TILE + address // TILE, t % side * TILE + address % TILE, counts[address]
    keys, counts = np.unique(first[rest] << 32 | second[rest], return_counts=True)
    yield keys >> 32, keys & 0xFFFFFFFF, counts


_COUNTS = "chunk bigint, lang string, a int, b int, n bigint"


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pair counts of every chunk."""
    for batch in batches:
        for chunk, lang, data in zip(*(batch[c].to_pylist() for c in ("chunk", "lang", "ids"))):
            for a, b, n in pair_counts(_unpacked(data)):
                for start in range(0, len(a), ROWS):
                    end = min(start + ROWS, len(a))
                    same = [pa.repeat(pa.scalar(v, k), end - start) for v, k in ((chunk, pa.int64()), (lang, pa.string()))]
                    some = [pa.array(x[start:end].astype(k)) for x, k in ((a, np.int32), (b, np.int32), (n, np.int64))]
                    yield pa.RecordBatch.from_arrays([*same, *some], ["chunk", "lang", "a", "b", "n"])


_STATE = "chunk bigint, lang string, ids binary"


def _of_pairs(ids: np.ndarray, keys: np.ndarray, new: np.ndarray) -> np.ndarray:
    """The new id of each pair of neighbours that is among the sorted ``keys``, else -1."""
    first, second = ids[:-1].astype(np.int64), ids[1:].astype(np.int64)
    asked = np.where((first >= 0) & (second >= 0), first << 32 | second, -1)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, new[at], -1)


def _of_words(ids: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The new id of each word, where -1 stands for no word; ``known`` has one for each number."""
    return np.append(known, -1)[ids]


def _states(batches: Iterable[pa.RecordBatch], renumbered) -> Iterator[pa.RecordBatch]:
    """Chunks with the ids that ``renumbered`` gives for a row's own; empty ones go."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            ids = _unpacked(row["ids"][0].as_py())
            tight = _tight(renumbered(row, ids)) if len(ids) else ids
            if len(tight):
                arrays = [row["chunk"], row["lang"], pa.array([_packed(tight)], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["chunk", "lang", "ids"])


def _from_all(table, pairs: bool):
    """New ids from a broadcast table ``{lang: ids of words}`` or ``{lang: (sorted pairs, ids)}``."""

    def renumbered(row: pa.RecordBatch, ids: np.ndarray) -> np.ndarray:
        held = table.value.get(row["lang"][0].as_py())
        if held is None:
            return np.full(len(ids), -1)
        if pairs:
            return _of_pairs(ids, *held)
        words = row["words"][0].as_py()
        return _of_words(ids, np.fromiter((held.get(w, -1) for w in words), np.int32, len(words)))

    return lambda batches: _states(batches, renumbered)


def _from_row(pairs: bool):
    """New ids from the row's own list ``held`` of ``(a, b, id)``."""

    def renumbered(row: pa.RecordBatch, ids: np.ndarray) -> np.ndarray:
        held = row["held"][0].values
        a, b, new = (held.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("a", "b", "id"))
        if pairs:
            keys = a << 32 | b
            order = np.argsort(keys)
            return _of_pairs(ids, keys[order], new[order])
        known = np.full(max(int(a.max()), int(ids.max())) + 1, -1)
        known[a] = new
        return _of_words(ids, known)

    return lambda batches: _states(batches, renumbered)


class _Mining:
    """The steps from texts to frequent phrases, each written to ``folder``."""

    def __init__(self, spark, folder: str, min_count: int, chunk_words: int, broadcast_rows: int):
        self.spark, self.folder, self.min_count = spark, folder, min_count
        self.chunk_words, self.broadcast_rows = chunk_words, broadcast_rows

    def written(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def ranked(self, counts: DataFrame, by: list[str], name: str) -> DataFrame:
        """What is frequent, with ids from 0 per language, the most frequent first."""
        found = counts.groupBy("lang", *by).agg(F.sum("n").alias("n")).where(F.col("n") >= self.min_count)
        found = self.written(found.withColumn("less", -F.col("n")), f"found-{name}")
        ids = rank_within(found, ["lang"], ["less", *by], "place")
        return self.written(ids.withColumn("id", (F.col("place") - 1).cast("int")).drop("less", "place"), name)

    def few(self, ids: DataFrame) -> bool:
        return ids.count() <= self.broadcast_rows

    def state(self, chunks: DataFrame, counts: DataFrame, ids: DataFrame, by: list[str], name: str) -> DataFrame:
        """Chunks with the new ids of their words or pairs."""
        pairs = by == ["a", "b"]
        if self.few(ids):
            held = ids.select("lang", *by, "id").toPandas()
            table = {}
            for lang, some in held.groupby("lang"):
                new = some["id"].to_numpy(np.int32)
                if pairs:
                    keys = some["a"].to_numpy(np.int64) << 32 | some["b"].to_numpy(np.int64)
                    order = np.argsort(keys)
                    table[lang] = keys[order], new[order]
                else:
                    table[lang] = dict(zip(some["phrase"].tolist(), new.tolist()))
            new = _from_all(self.spark.sparkContext.broadcast(table), pairs)
            wanted = ["chunk", "lang", "ids"] if pairs else ["chunk", "lang", "ids", "words"]
            return self.written(chunks.select(*wanted).mapInArrow(new, _STATE), name)
        met = counts.join(ids.drop("n"), ["lang", *by])
        a, b = ("a", "b") if pairs else ("at", F.lit(0).alias("b"))
        lists = met.groupBy("chunk").agg(F.collect_list(F.struct(F.col(a).alias("a"), b, "id")).alias("held"))
        joined = chunks.select("chunk", "lang", "ids").join(lists, "chunk")
        return self.written(joined.mapInArrow(_from_row(pairs), _STATE), name)

    def words(self, docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Words of each language, the frequent ones as phrases, and the chunks in their ids."""
        chunk_words = self.chunk_words
        chunks = self.written(docs.mapInArrow(lambda batches: _chunks(batches, chunk_words), _CHUNK), "chunks")
        totals = chunks.groupBy("lang").agg(F.sum("n_words").alias("total"))
        each = chunks.select("chunk", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "x"))
        counts = each.select("chunk", "lang", "at", F.col("x.words").alias("phrase"), F.col("x.counts").alias("n"))
        words = self.ranked(counts, ["phrase"], "phrases1")
        state = self.state(chunks, counts, words, ["phrase"], "state1")
        return totals, words.withColumn("last", F.col("phrase")), state

    def longer(self, phrases: DataFrame, state: DataFrame, size: int, last: bool) -> tuple[DataFrame, DataFrame | None]:
        """Frequent phrases of ``size`` words and the chunks in their ids."""
        counts = state.mapInArrow(_counted, _COUNTS)
        pairs = self.ranked(counts, ["a", "b"], f"pairs{size}")
        head = phrases.select("lang", F.col("id").alias("a"), F.col("phrase").alias("head"))
        tail = phrases.select("lang", F.col("id").alias("b"), "last")
        text = F.concat("head", F.lit(" "), F.col("last")).alias("phrase")
        texts = pairs.join(head, ["lang", "a"]).join(tail, ["lang", "b"]).select("lang", "id", text, "last", "n")
        texts = self.written(texts, f"phrases{size}")
        return texts, None if last else self.state(state, counts, pairs, ["a", "b"], f"state{size}")


def _scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates with the parts and the score of their weakest cut."""
    parts = F.split("phrase", " ")
    size = F.size(parts)
    cuts = phrases.where("size > 1").select(
        "lang", "phrase", F.col("n").alias("a"), parts.alias("parts"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k")
    )
    cuts = cuts.select(
        "lang",
        "phrase",
        "a",
        "k",
        F.array_join(F.slice("parts", F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice("parts", F.col("k") + 1, F.size("parts")), " ").alias("tail"),
    )
    heads = phrases.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    tails = phrases.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))
    known = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(totals, "lang")
    wide = "cast(1000 * total as decimal(19, 0)) * cast(a as decimal(18, 0))"
    score = F.expr(f"({wide}) div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0)))")
    least = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    best = known.groupBy("lang", "phrase", "a", "total").agg(least)
    return best.select("lang", "phrase", "a", "cut.l", "cut.r", F.col("total").alias("n"), "cut.score")


def _inside(phrases: DataFrame) -> DataFrame:
    """``(lang, phrase, a)`` that candidates one word longer contain as often.

    A phrase is in a longer one at most as often as it occurs, and any phrase between the two would be as
    frequent, so one more word is enough.
    """
    parts = F.split("phrase", " ")
    size = F.size(parts)
    shorter = F.array(F.slice(parts, F.lit(1), size - 1), F.slice(parts, F.lit(2), size - 1))
    held = phrases.where("size > 2").select("lang", F.explode(shorter).alias("parts"), F.col("n").alias("a"))
    return held.select("lang", F.array_join("parts", " ").alias("phrase"), "a")


def _best(scored: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each language, chosen in many groups first, so that none is large."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    groups = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = F.pmod(F.xxhash64("phrase"), F.lit(groups))
    some = Window.partitionBy("lang", "group").orderBy(*order)
    few = scored.withColumn("group", group).withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top)
    every = Window.partitionBy("lang").orderBy(*order)
    ranked = few.withColumn("rank", F.row_number().over(every).cast("bigint")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    top: int = TOP,
    chunk_words: int = CHUNK_WORDS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of each language.

    Texts are lower-cased (A-Z), cut at breaks, and words are apart by blanks and tabs. A phrase of 2 to
    ``max_words`` words with ``a >= min_count`` occurrences is a candidate. A cut gives ``l`` and ``r``, the
    occurrences of its parts, and ``floor(1000 * a * n / (l * r))`` with ``n`` the words of the language, in
    whole numbers of 38 digits; the lowest cut is the score, the first of equal ones. Candidates that a
    longer one holds as often are left out, then the ``top`` by score, occurrences and bytes are ranked.

    NULL languages count as ``und``; NULL and empty texts have no words; repeated rows count as often as
    they are there; other columns, ids included, do not matter. An empty table gives no rows. Ids of
    phrases are 32-bit numbers for each language.
    """
    spark = docs.sparkSession
    mining = _Mining(spark, shared_folder(spark, "phrases"), min_count, chunk_words, broadcast_rows)
    texts = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text")
    )
    totals, phrases, state = mining.words(texts)
    every = phrases.select("lang", "phrase", "n", F.lit(1).alias("size"))
    for size in range(2, max_words + 1):
        phrases, state = mining.longer(phrases, state, size, size == max_words)
        every = every.unionByName(phrases.select("lang", "phrase", "n", F.lit(size).alias("size")))
    scored = _scored(every, totals).join(_inside(every), ["lang", "phrase", "a"], "left_anti")
    return _best(scored, top)
