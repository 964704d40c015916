"""Language identification by prediction by partial matching.

Every language gets a tree of byte contexts of up to three bytes, learned once and then frozen. A
byte costs the bits that the tree needs to predict it: at the longest known context, or after an
escape at the next shorter one, where symbols already ruled out take no probability. The language
whose tree writes the text in the fewest bits is the answer.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelayers.llm.batches import hand_over_little, steps, texts
from carelayers.sources.layers import shared_folder

#: Longest context in bytes; a context and its byte fit 32 bits.
ORDER = 3
#: Documents of a language that its tree learns from; all their grams count.
MAX_DOCS = 1000
#: Languages whose trees are one broadcast; more are scored in blocks of so many, one after another.
LANGUAGES_AT_ONCE = 16
#: Up to so many ids of documents to learn from are broadcast.
BROADCAST_IDS = 500_000
UNDETERMINED = "und"
#: Parts of a language that are looked through side by side for the documents to learn from.
PARTS = 64

# Bytes of texts that are scored at once, and their grams looked up at once; a byte takes about 20 bytes of
# a worker's memory meanwhile, and every core has a worker.
_SCORED_BYTES = 1 << 20
_STEP = 1 << 18
# Bytes of a task's rows that meet a block of languages at once.
_GATHERED_BYTES = 64 << 20
_START = b"\n" * ORDER


def gram_codes(data: np.ndarray) -> np.ndarray:
    """For every byte after the first ``ORDER``: that byte and the ``ORDER`` before it, as one number."""
    wide = data.astype(np.uint32)
    return (wide[:-3] << 24) | (wide[1:-2] << 16) | (wide[2:-1] << 8) | wide[3:]


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
    return at, keys[at] == wanted


@dataclass
class _Order:
    """The nodes of one depth: counts of grams, and totals of contexts."""

    grams: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    totals: np.ndarray
    kinds: np.ndarray
    ruled_out: np.ndarray


class Tree:
    """The context tree of one language, from the counts of its longest grams."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        self.orders: list[_Order] = []
        codes, counts = codes.astype(np.int64), counts.astype(np.int64)
        for k in range(ORDER + 1):
            grams, back = np.unique(codes & ((1 << 8 * (k + 1)) - 1), return_inverse=True)
            held = np.bincount(back, weights=counts).astype(np.int64)
            contexts, of = np.unique(grams >> 8, return_inverse=True)
            shorter = np.zeros(len(grams))
            if k:
                below = self.orders[-1]
                shorter = below.counts[_find(below.grams, grams & ((1 << 8 * k) - 1))[0]]
            self.orders.append(
                _Order(
                    grams, held, contexts,
                    np.bincount(of, weights=held), np.bincount(of).astype(np.float64),
                    np.bincount(of, weights=shorter),
                )
            )

    def bits(self, codes: np.ndarray) -> np.ndarray:
        """Exact code length of each gram's last byte after the bytes before it."""
        codes = codes.astype(np.int64)
        out = np.zeros(len(codes))
        live, gone = np.arange(len(codes)), np.zeros(len(codes))
        for k in range(ORDER, -1, -1):
            order, gram = self.orders[k], codes[live] & ((1 << 8 * (k + 1)) - 1)
            node, known = _find(order.contexts, gram >> 8)
            at, seen = _find(order.grams, gram)
            seen &= known
            kinds = np.where(known, order.kinds[node], 1.0)
            space = np.where(known, order.totals[node] - gone[live] + kinds, 1.0)
            chance = np.where(seen, order.counts[at], kinds) / space
            out[live] -= np.where(known, np.log2(chance), 0.0)
            gone[live] = np.where(known, order.ruled_out[node], 0.0)
            live = live[~seen]
        out[live] += np.log2(max(1, 256 - len(self.orders[0].grams)))
        return out


@dataclass
class Model:
    """Frozen trees, and the code lengths of all grams that any of them has seen."""

    languages: list[str]
    trees: list[Tree]
    known: np.ndarray
    known_bits: np.ndarray
    _index: pd.Index | None = field(default=None, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_index": None}

    def _bits_of(self, codes: np.ndarray) -> np.ndarray:
        if self._index is None:
            self._index = pd.Index(self.known)
        at = self._index.get_indexer(codes)
        out = self.known_bits[at]
        new = np.flatnonzero(at < 0)
        out[new] = np.stack([t.bits(codes[new]) for t in self.trees], axis=1)
        return out

    def code_lengths(self, docs: list[bytes]) -> np.ndarray:
        """Bits of every text under every language, shape (texts, languages)."""
        sizes = np.array([len(d) for d in docs])
        data = np.frombuffer(b"".join(_START + d for d in docs), dtype=np.uint8)
        owner = np.repeat(np.arange(len(docs), dtype=np.int32), sizes + ORDER)[ORDER:]
        inside = np.ones(len(owner), dtype=bool)
        for back in range(ORDER):  # what stands before a text costs nothing
            inside[np.cumsum(sizes + ORDER)[:-1] - back - 1] = False
        total = np.zeros((len(docs), len(self.languages)))
        for start in range(0, len(owner), _STEP):
            some = slice(start, start + _STEP)
            use = inside[some]
            codes = gram_codes(data[start : start + _STEP + ORDER])[use]
            if not len(codes):
                continue
            own = owner[some][use]
            place, distinct = pd.factorize(codes)
            bits = self._bits_of(distinct)
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            for j in range(len(self.languages)):
                total[own[first], j] += np.add.reduceat(bits[:, j][place], first)
        return total

    def predict(self, docs: list[bytes]) -> tuple[list[str], np.ndarray]:
        """Language and its share of the probability; of equally good ones the first by name."""
        return shortest([self], [docs])[0]


@dataclass
class Blocks:
    """Models of more languages than fit one broadcast, in the order of their names."""

    languages: list[str]
    parts: list[Broadcast]


def shortest(models: Iterable[Model], pieces: list[list[bytes]]) -> list[tuple[list[str], np.ndarray]]:
    """For each piece, language and share of the probability of its texts over all models.

    Each model is used for all pieces and then let go; of equally good languages the first wins.
    """
    names = [np.full(len(p), UNDETERMINED, dtype=object) for p in pieces]
    least = [np.full(len(p), np.inf) for p in pieces]
    mass = [np.zeros(len(p)) for p in pieces]
    for model in models:
        for i, docs in enumerate(pieces):
            if not docs or not model.languages:
                continue
            bits = model.code_lengths(docs)
            low = bits.min(axis=1)
            better = low < least[i]
            names[i][better] = np.array(model.languages, dtype=object)[bits.argmin(axis=1)[better]]
            now = np.minimum(least[i], low)
            mass[i] = mass[i] * np.exp2(now - least[i]) + np.exp2(now[:, None] - bits).sum(axis=1)
            least[i] = now
        del model
    return [(n.tolist(), np.divide(1.0, m, out=np.zeros(len(m)), where=m > 0)) for n, m in zip(names, mass)]


def _unkept(part: Broadcast) -> Model:
    """The model of a block; ``value`` would keep every block in the worker's memory."""
    path = getattr(part, "_path", None)
    return part.load_from_path(path) if path else part.value


def _gathered(parts: Iterable[pa.RecordBatch], max_bytes: int) -> Iterator[list[pa.RecordBatch]]:
    group, held = [], 0
    for part in parts:
        group.append(part)
        held += part.nbytes
        if held >= max_bytes:
            yield group
            group, held = [], 0
    if group:
        yield group


def model_of(counts: pd.DataFrame) -> Model:
    """A model from the columns ``lang, code, n``."""
    languages, trees = [], []
    for name, own in counts.groupby("lang", sort=True):
        languages.append(str(name))
        trees.append(Tree(own["code"].to_numpy(), own["n"].to_numpy()))
    known = np.unique(counts["code"].to_numpy()).astype(np.uint32)
    bits = [t.bits(known) for t in trees]
    return Model(languages, trees, known, np.stack(bits, axis=1) if bits else np.zeros((0, 0)))


def _count_grams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in steps(batches):
        by_language: dict[str, list[bytes]] = {}
        for name, text in zip(part.column(0).to_pylist(), texts(part.column(1))):
            by_language.setdefault(name, []).append(_START + text.encode())
        for name, docs in by_language.items():
            codes = np.concatenate([gram_codes(np.frombuffer(d, dtype=np.uint8)) for d in docs])
            distinct, n = np.unique(codes, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(distinct)), pa.array(distinct.astype(np.int64)), pa.array(n.astype(np.int64))],
                names=["lang", "code", "n"],
            )


def train(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    max_docs: int = MAX_DOCS,
    max_grams: int | None = None,
    max_languages: int | None = None,
) -> Model | Blocks:
    """Learn one tree per language from at most ``max_docs`` whole texts each.

    Takes the rows with the smallest hash of their id, so the choice does not depend on order; rows
    without text, language or id teach nothing. All languages get a tree, unless ``max_languages``
    asks for those with the most rows only. All grams of the chosen texts count, unless ``max_grams`` asks
    for the most frequent ones of a language (then the smallest). ``LANGUAGES_AT_ONCE`` languages at a
    time reach the driver.
    """
    spark = labelled.sparkSession
    hand_over_little(spark)
    folder = shared_folder(spark, "language")
    rows = labelled.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    ).where("id is not null and lang is not null and length(text) > 0")
    # The first of each part of a language, then of the language, so no task sees all its rows.
    chosen = rows.select("id", "lang", F.xxhash64("id").alias("hash"))
    chosen = chosen.withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "id"), F.lit(PARTS)))
    for keys in (["lang", "part"], ["lang"]):
        first = Window.partitionBy(*keys).orderBy("hash", "id")
        chosen = chosen.withColumn("place", F.row_number().over(first)).where(F.col("place") <= max_docs)
    if max_languages is not None:
        common = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages)
        chosen = chosen.join(F.broadcast(common.select("lang")), "lang", "left_semi")
    chosen.select("id", "lang").write.parquet(f"{folder}/chosen")
    chosen = spark.read.parquet(f"{folder}/chosen")
    learned = {r["lang"]: r["count"] for r in chosen.groupBy("lang").count().collect()}
    few = sum(learned.values()) <= BROADCAST_IDS
    sample = rows.join(F.broadcast(chosen) if few else chosen, ["id", "lang"], "left_semi").select("lang", "text")
    counts = (
        sample.mapInArrow(_count_grams, "lang string, code bigint, n bigint")
        .groupBy("lang", "code")
        .agg(F.sum("n").alias("n"))
    )
    kept = counts
    if max_grams is not None:
        frequent = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
        kept = counts.withColumn("place", F.row_number().over(frequent)).where(F.col("place") <= max_grams)
        kept = kept.drop("place")
    languages = sorted(learned)
    if len(languages) <= LANGUAGES_AT_ONCE:
        return model_of(kept.toPandas())
    blocks = spark.createDataFrame([(x, i // LANGUAGES_AT_ONCE) for i, x in enumerate(languages)], "lang string, block int")
    kept.join(F.broadcast(blocks), "lang").write.partitionBy("block").parquet(f"{folder}/grams")
    grams, parts = spark.read.parquet(f"{folder}/grams"), []
    for i in range(-(-len(languages) // LANGUAGES_AT_ONCE)):
        own = grams.where(F.col("block") == i).drop("block").toPandas()
        parts.append(spark.sparkContext.broadcast(model_of(own)))
    return Blocks(languages, parts)


def identify(
    docs: DataFrame, model: Model | Blocks, text_col: str = "text", into: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """Every row of ``docs`` with language and score as columns ``into``, which replace such columns.

    Looks at the whole text. Texts that are NULL or have no letter are ``und`` with score 0; so is
    all text if the model knows no language. No shuffle; other columns are passed on.
    """
    hand_over_little(docs.sparkSession)
    columns = [F.col(c) for c in docs.columns if c.lower() not in {n.lower() for n in into}]
    whole = docs.select(*columns)
    text_at = whole.columns.index(text_col)
    answer = [T.StructField(into[0], T.StringType()), T.StructField(into[1], T.DoubleType())]
    schema = T.StructType([*whole.schema.fields, *answer])
    shared = model.parts if isinstance(model, Blocks) else [docs.sparkSession.sparkContext.broadcast(model)]
    many = len(shared) > 1
    lettered = whole.select("*", F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("__lettered"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _gathered(steps(batches, _SCORED_BYTES), _GATHERED_BYTES if many else 0):
            having = [np.array(part.column(part.num_columns - 1).to_pylist(), dtype=bool) for part in group]
            pieces = [
                [t.encode() for t in part.column(text_at).filter(pa.array(has)).to_pylist()]
                for part, has in zip(group, having)
            ]
            models = (_unkept(b) if many else b.value for b in shared)
            for part, has, (found, sure) in zip(group, having, shortest(models, pieces)):
                langs = np.full(part.num_rows, UNDETERMINED, dtype=object)
                scores = np.zeros(part.num_rows)
                langs[has], scores[has] = found, sure
                arrays = [part.column(i) for i in range(part.num_columns - 1)]
                names = [*part.schema.names[:-1], *into]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(langs, pa.string()), pa.array(scores)], names=names)

    return lettered.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is kept from learning: a quarter of all ids; rows without an id are not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
