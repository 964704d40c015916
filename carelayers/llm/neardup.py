"""Near-duplicate documents: SetSketch registers in bands, joint likelihood, exact check.

A document is the set of its five-word shingles. Each shingle throws exponentially spaced points at
registers; a register keeps its smallest point, truncated to a step of a geometric scale, so sketches
of two sets merge by maximum and agree in about as many registers as the sets share. Documents that
agree in a whole band of registers are candidates; the likelihood of what all registers show leaves
those that may reach the threshold, and full sets decide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelayers.llm.batches import hand_over_little, steps, texts
from carelayers.llm.graph import components
from carelayers.sources.layers import shared_folder

WORDS = 5
#: Links have ``100 * intersection >= PERCENT * union``.
PERCENT = 75
#: A pair at the threshold agrees in no band with a chance of 4 in a million.
BANDS, ROWS = 64, 6
REGISTERS = BANDS * ROWS
#: Registers are steps of a scale of base ``e ** STEP``, from ``e ** -LOWEST`` on.
STEP, LOWEST = 0.1, 25
#: Likeliest similarities below this are left out: four standard deviations under the threshold, which
#: leaves out 2 in 100,000 pairs that are just at it and none in a million from 0.77 on.
LIKELY = 0.66
#: Registers that sketches have in common if they may link, of the first ones and of all: seven and
#: eight deviations under what the threshold lets expect.
FIRST, LEAST_FIRST, LEAST_EQUAL = 64, 24, 222
#: Rows of a bucket that are compared with as many others at once.
BLOCK = 2048
#: Partners of a document that are checked against its full set in one piece.
PIECE = 512
#: Lists of ids of up to so many rows (8 bytes each) are sent to every executor, longer ones shuffled.
SENT_IDS = 500_000

_U = np.uint64
_RANDOM = np.random.default_rng(20)
#: Random numbers for every byte at 64 places of a word, and for the words of a shingle.
_BYTES = _RANDOM.integers(0, 2**64, (256, 64), dtype=np.uint64)
_PLACES = _RANDOM.integers(0, 2**64, WORDS, dtype=np.uint64) | _U(1)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit over all others."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(docs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All distinct shingles of the documents as 64-bit hashes: ``(hashes, bounds)``.

    Those of document ``i`` are ``hashes[bounds[i]:bounds[i + 1]]``, sorted.
    """
    raw = [d.encode().lower() for d in docs]  # of bytes, only A-Z
    data = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)
    starts_of_docs = np.cumsum([0, *[len(r) + 1 for r in raw]])
    inside = ~_BLANK[data]
    begins = inside & np.r_[True, ~inside[:-1]]
    at = np.flatnonzero(inside)
    first = np.flatnonzero(begins[at])
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(len(docs) + 1, np.int64)
    sizes = np.diff(np.r_[first, len(at)])
    place = np.arange(len(at)) - np.repeat(first, sizes)
    values = _BYTES[data[at], place & 63] * ((place >> 6) * 2 + 1).astype(np.uint64)
    words = _mixed(np.add.reduceat(values, first) + sizes.astype(np.uint64) * _PLACES[0])

    doc = np.searchsorted(starts_of_docs, at[first], side="right") - 1
    n_words = np.bincount(doc, minlength=len(docs))
    word_at = np.cumsum(np.r_[0, n_words])
    # Whole shingles, then the one shingle of documents that have fewer words.
    n = np.where(n_words >= WORDS, n_words - WORDS + 1, np.minimum(n_words, 1))
    owner = np.repeat(np.arange(len(docs)), n)
    begin = word_at[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    length = np.minimum(n_words[owner], WORDS)
    total = length.astype(np.uint64) * _U(0x9E3779B97F4A7C15)
    for k in range(WORDS):
        within = k < length
        total[within] += words[begin[within] + k] * _PLACES[k]
    hashes = _mixed(total)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.r_[True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])]
    return hashes[new], np.searchsorted(owner[new], np.arange(len(docs) + 1))


def sketches(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Registers of the sets given as by ``shingles``, shape (sets, ``REGISTERS``).

    The points of a shingle are a process of constant rate over all registers, so the first one at a
    register is exponential and independent of the others. Points are made in rising order up to a
    limit that nearly always fills all registers; sets with one left empty are done again with twice
    the limit, so the result does not depend on it.
    """
    n_sets = len(bounds) - 1
    least = np.full((n_sets, REGISTERS), np.inf)
    counts = np.diff(bounds)
    limit = np.where(counts > 0, 12.0 / np.maximum(counts, 1), 0.0)
    todo = np.flatnonzero(counts > 0)
    while len(todo):
        owner = np.repeat(todo, counts[todo])
        seed = np.concatenate([hashes[bounds[s] : bounds[s + 1]] for s in todo])
        point, n = np.zeros(len(seed)), 0
        while len(seed):
            n += 1
            bits = _mixed(seed + _U((n * 0x9E3779B97F4A7C15) % 2**64))
            point = point - np.log1p(-((bits >> _U(32)).astype(np.float64) + 0.5) / 2**32) / REGISTERS
            go = point <= limit[owner]
            seed, point, owner, bits = seed[go], point[go], owner[go], bits[go]
            register = ((bits & _U(0xFFFFFFFF)) * _U(REGISTERS)) >> _U(32)
            np.minimum.at(least.reshape(-1), owner * REGISTERS + register.astype(np.int64), point)
        todo = todo[np.isinf(least[todo]).any(axis=1)]
        limit[todo] *= 2
    with np.errstate(divide="ignore", invalid="ignore"):
        step = np.floor(-np.log(least) / STEP) + LOWEST
    return np.clip(np.nan_to_num(step, neginf=0), 0, 255).astype(np.uint8)


def likeliest(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The similarity that makes the registers' order most likely, given the sets' sizes.

    Counts of registers where ``a`` is larger, ``b`` is larger, and both are equal have, for sets with
    shares ``u`` and ``v`` of all elements and similarity ``j``, the chances ``p(u - v * j)``,
    ``p(v - u * j)`` and the rest; the likelihood has one peak.
    """
    more = (a > b).sum(axis=1)
    less = (a < b).sum(axis=1)
    same = REGISTERS - more - less
    u = n_a / (n_a + n_b)
    v = 1 - u
    base = np.exp(STEP)

    def chance(x: np.ndarray) -> np.ndarray:
        return np.clip(-np.log1p(-np.clip(x, 0, 1) * (base - 1) / base) / STEP, 1e-12, 1)

    def fit(j: np.ndarray) -> np.ndarray:
        up, down = chance(u - v * j), chance(v - u * j)
        return more * np.log(up) + less * np.log(down) + same * np.log(np.clip(1 - up - down, 1e-12, 1))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(25):
        left, right = low + (high - low) / 3, high - (high - low) / 3
        up = fit(left) < fit(right)
        low, high = np.where(up, left, low), np.where(up, high, right)
    return (low + high) / 2


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of bytes as an array of binary values of that length."""
    width = rows.shape[1]
    offsets = pa.py_buffer(np.arange(0, (len(rows) + 1) * width, width, dtype=np.int32))
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, offsets, pa.py_buffer(rows.tobytes())])


def _bytes_of(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), width)


_SKETCH = "id {id}, n bigint, c binary, registers binary"


def _classes(hashes: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """128 bits of every set."""
    keys = [hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest() for a, b in zip(bounds, bounds[1:])]
    return pa.array(keys, pa.binary())


def _sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in steps(batches, 1 << 20):
        hashes, bounds = shingles(texts(part.column(1)))
        arrays = [part.column(0), pa.array(np.diff(bounds)), _classes(hashes, bounds), _binary(sketches(hashes, bounds))]
        yield pa.RecordBatch.from_arrays(arrays, names=["id", "n", "c", "registers"])


def _sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in steps(batches):
        hashes, bounds = shingles(texts(part.column(0)))
        sets = [hashes[bounds[i] : bounds[i + 1]].tobytes() for i in range(part.num_rows)]
        yield pa.RecordBatch.from_arrays([_classes(hashes, bounds), pa.array(sets, pa.binary())], names=["c", "shingles"])


def _likely(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows ``a, b, n_a, n_b, registers_a, registers_b`` the pairs that may reach the threshold."""
    for part in steps(batches):
        n_a, n_b = (part.column(i).to_numpy().astype(float) for i in (2, 3))
        a, b = (_bytes_of(part.column(i), REGISTERS) for i in (4, 5))
        go = pa.array(likeliest(a, b, n_a, n_b) >= LIKELY)
        yield pa.RecordBatch.from_arrays([part.column(0).filter(go), part.column(1).filter(go)], names=["a", "b"])


def _linked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows ``b, piece, a, shingles`` the pairs that link; each piece begins with the set of ``b`` itself."""
    mine = np.zeros(0, np.uint64)
    for part in steps(batches):
        a, b = [], []
        for one, other, held in zip(part["a"].to_pylist(), part["b"].to_pylist(), part["shingles"].to_pylist()):
            held = np.frombuffer(held, dtype=np.uint64)
            if one is None:
                mine = held
                continue
            shared = len(np.intersect1d(held, mine, assume_unique=True))
            if 100 * shared >= PERCENT * (len(held) + len(mine) - shared):
                a.append(one)
                b.append(other)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b)], names=["a", "b"])


_GROUP = ["band", "i", "j"]


def _compare_blocks(best_only: bool):
    """``(a, b, similarity)`` of the likely pairs of different components in every group.

    Groups come one after the other, sorted, strangers first; those that end in a batch are compared
    together, each stranger with the row one, two, three ... places after it. A pair counts in the first
    band that it agrees in and in no other. With ``best_only`` each row gives only its likeliest partner.
    """

    def pairs(rows: pa.Table, group: np.ndarray) -> Iterator[pa.RecordBatch]:
        component, block, n, place = (rows.column(c).to_numpy() for c in ("component", "block", "n", "place"))
        most, partner = np.zeros(len(group)), np.zeros(len(group), dtype=np.int64)
        main = rows.column("main").to_numpy()
        # A group is of strangers with a part of the main component, or of two blocks of strangers.
        with_main = rows.column("i").to_numpy() >= 0
        one_block = rows.column("i").to_numpy() == rows.column("j").to_numpy()
        registers = _bytes_of(rows.column("registers"), REGISTERS)
        first = registers[:, :FIRST].copy()
        ids = rows.column("u").combine_chunks()
        last = np.searchsorted(group, group, side="right") - 1
        left = np.flatnonzero(~main)
        for step in range(1, int((last[left] - left).max(initial=0)) + 1):
            left = left[left + step <= last[left]]
            x, y = left, left + step
            # Sizes that are too far apart cannot link; components that are one need not.
            go = np.where(with_main[x], main[y], one_block[x] | (block[x] != block[y])) & (component[x] != component[y])
            go &= 100 * np.minimum(n[x], n[y]) >= PERCENT * np.maximum(n[x], n[y])
            x, y = x[go], y[go]
            go = (first[x] == first[y]).sum(axis=1) >= LEAST_FIRST
            x, y = x[go], y[go]
            equal = registers[x] == registers[y]
            bands = equal.reshape(-1, BANDS, ROWS).all(axis=2)
            go = (equal.sum(axis=1) >= LEAST_EQUAL) & bands.any(axis=1) & (bands.argmax(axis=1) == place[x])
            x, y = x[go], y[go]
            if not len(x):
                continue
            similarity = likeliest(registers[x], registers[y], n[x].astype(float), n[y].astype(float))
            go = similarity >= LIKELY
            x, y, similarity = x[go], y[go], similarity[go]
            if best_only:  # a row is at most once in x and once in y
                for one, other in ((x, y), (y, x)):
                    more = similarity > most[one]
                    most[one[more]], partner[one[more]] = similarity[more], other[more]
            elif len(x):
                yield found(ids, x, y, similarity)
        if best_only and most.any():
            x = np.flatnonzero(most)
            yield found(ids, x, partner[x], most[x])

    def found(ids: pa.Array, x: np.ndarray, y: np.ndarray, similarity: np.ndarray) -> pa.RecordBatch:
        columns = [ids.take(pa.array(x)), ids.take(pa.array(y)), pa.array(similarity)]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b", "similarity"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            held = now if held is None else pa.concat_tables([held, now])
            keys = np.stack([held.column(c).to_numpy() for c in _GROUP])
            group = np.cumsum(np.r_[0, (keys[:, 1:] != keys[:, :-1]).any(axis=0)]) if held.num_rows else np.zeros(0, int)
            ended = int(np.searchsorted(group, group[-1])) if len(group) else 0
            if ended:
                yield from pairs(held.slice(0, ended).combine_chunks(), group[:ended])
                held = held.slice(ended)
        if held is not None and held.num_rows:
            yield from pairs(held.combine_chunks(), np.zeros(held.num_rows, int))

    return run


def only(df: DataFrame, ids: DataFrame, by: str = "id") -> DataFrame:
    """The rows of ``df`` whose ``by`` is in ``ids``.

    A list of at most ``SENT_IDS`` ids is sent to every executor, a longer one shuffled.
    """
    ids = F.broadcast(ids) if ids.count() <= SENT_IDS else ids
    return df.join(ids, by, "left_semi")


def _blocked(parts: DataFrame) -> DataFrame:
    """Rows of buckets in several components, once for every group of blocks that they are compared in.

    ``parts`` has ``band, component`` and other columns. The largest component of a bucket is its main one:
    its rows meet the others, called strangers, and not each other. Blocks of the main component are
    numbered from 0, those of strangers from -1 down.
    """
    each = parts.groupBy("band", "component").agg(F.count(F.lit(1)).alias("rows"))
    split = each.groupBy("band").agg(
        F.count(F.lit(1)).alias("components"), F.sum("rows").alias("rows"), F.max(F.struct("rows", "component")).alias("most")
    )

    def blocks(rows):
        return F.ceil(rows / BLOCK).cast("int")

    split = split.where("components > 1").select(
        "band",
        F.col("most.component").alias("main_component"),
        blocks(F.col("most.rows")).alias("mains"),
        blocks(F.col("rows") - F.col("most.rows")).alias("strangers"),
    )
    rows = parts.join(split, "band").withColumn("main", F.col("component") == F.col("main_component"))
    number = F.pmod(F.xxhash64("u"), F.when(F.col("main"), F.col("mains")).otherwise(F.col("strangers"))).cast("int")
    rows = rows.withColumn("block", F.when(F.col("main"), number).otherwise(-1 - number))
    own, mains, strangers = F.col("block"), F.col("mains"), F.col("strangers")
    with_strangers = F.transform(F.sequence(F.lit(1), strangers), lambda k: F.struct(own.alias("i"), (-k).alias("j")))
    with_main = F.transform(F.sequence(F.lit(0), mains - 1), lambda k: F.struct(k.alias("i"), own.alias("j")))
    with_others = F.transform(
        F.sequence(F.lit(1), strangers), lambda k: F.struct(F.least(own, -k).alias("i"), F.greatest(own, -k).alias("j"))
    )
    met = F.when(F.col("main"), with_strangers).otherwise(F.concat(with_main, with_others))
    return rows.withColumn("met", F.explode(met)).select("*", "met.i", "met.j")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_shingles, component_id, kept)`` of every row.

    Whole texts; documents link if their sets of shingles are similar enough (``PERCENT``). NULL or
    empty texts and those of blanks alone have no shingles and link with nothing; so does a row
    without an id, whose component is NULL and which is kept. Rows that repeat an id are documents of
    their own, each compared with its own text, that share the id as a node. An empty table gives no rows.

    Equal sets are one class, whose smallest id stands for it. The hub of a bucket is the class that
    meets most others over all buckets. First each class is compared with the hub it shares most bands
    with, which is one pair per class however large the groups; what these links join is then one
    component. Then, in buckets whose classes are still in different components, each class outside the
    largest one is compared with the likeliest one of another component, and last with all of them. These
    comparisons of sketches are made in blocks, within a task, and nothing is left out.
    """
    spark = docs.sparkSession
    hand_over_little(spark)
    folder = shared_folder(spark, "neardup")
    id_kind = dict(docs.dtypes)[id_col]

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    all_rows = written(rows.mapInArrow(_sketch, _SKETCH.format(id=id_kind)), "sketches")
    linking = F.col("id").isNotNull() & (F.col("n") > 0)
    keyed = all_rows.where(linking)
    # Each class once, numbered; equal sets have equal registers.
    one = [F.any_value(x).alias(x) for x in ("n", "registers")]
    classes = keyed.groupBy("c").agg(F.min("id").alias("id"), *one)
    classes = written(classes.withColumn("u", F.monotonically_increasing_id()), "classes")

    pieces = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda i: F.xxhash64(i, F.substring("registers", i * ROWS + 1, F.lit(ROWS))),
    )
    in_bands = classes.select("u", F.posexplode(pieces).alias("place", "band"))
    shared = in_bands.groupBy("band").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    members = written(in_bands.join(shared, "band"), "members")
    weights = written(members.groupBy("u").agg(F.sum("rows").alias("weight")), "weights")
    known = written(only(classes, weights.select("u"), by="u"), "known")

    def linked(pairs: DataFrame, name: str) -> DataFrame | None:
        """Those of the candidate pairs of classes that link by their full sets, as ids."""
        pairs = written(pairs.select("a", "b").distinct(), f"{name}-pairs")
        if pairs.isEmpty():
            return None
        wanted = pairs.select(F.col("a").alias("u")).union(pairs.select(F.col("b").alias("u"))).distinct()
        wanted = written(known.select("u", "c", "id").join(wanted, "u", "left_semi"), f"{name}-wanted")
        sets = only(rows, wanted.select("id")).select("text").mapInArrow(_sets, "c binary, shingles binary")
        sets = sets.join(wanted.select("c", "u"), "c").groupBy("u").agg(F.any_value("shingles").alias("shingles"))
        sets = written(sets, f"{name}-sets")
        held = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n"))
        held = held.select("b", F.ceil(F.col("n") / PIECE).cast("int").alias("pieces"))
        mine = held.join(sets.withColumnRenamed("u", "b"), "b")
        mine = mine.select("b", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), F.lit(None).cast("bigint").alias("a"), "shingles")
        others = pairs.join(held, "b").join(sets.withColumnRenamed("u", "a"), "a")
        others = others.select("b", F.pmod(F.xxhash64("a"), "pieces").cast("int").alias("piece"), "a", "shingles")
        together = mine.unionByName(others).repartition("b", "piece").sortWithinPartitions("b", "piece", "a")
        found = together.mapInArrow(_linked, "a bigint, b bigint")
        for side in "ab":
            found = found.join(known.select(F.col("u").alias(side), F.col("id").alias(f"id_{side}")), side)
        return written(found.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")), f"{name}-links")

    # First each class and the hub that it shares most bands with.
    hubs = members.join(weights, "u").groupBy("band").agg(F.max(F.struct("weight", "u")).alias("hub"))
    stars = members.join(hubs.select("band", F.col("hub.u").alias("hub")), "band").where("u <> hub")
    stars = stars.groupBy("u", "hub").agg(F.count(F.lit(1)).alias("bands"))
    closest = stars.groupBy("u").agg(F.max(F.struct("bands", "hub")).alias("best"))
    pairs = closest.select(F.col("u").alias("a"), F.col("best.hub").alias("b"))
    for side in "ab":
        sketch = known.select(F.col("u").alias(side), F.col("n").alias(f"n_{side}"), F.col("registers").alias(f"registers_{side}"))
        pairs = pairs.join(sketch, side)
    pairs = pairs.select("a", "b", "n_a", "n_b", "registers_a", "registers_b")
    none = classes.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)
    links = linked(pairs.mapInArrow(_likely, "a bigint, b bigint"), "star")
    joined = components(none if links is None else links)

    def in_split_buckets(joined: DataFrame, best_only: bool) -> DataFrame:
        """``(a, b, similarity)`` of likely pairs in different components, each bucket whole."""
        at = known.select("u", "id").join(joined.withColumnRenamed("node", "id"), "id", "left")
        at = at.select("u", F.coalesce("component", "id").alias("component"))
        blocked = _blocked(members.select("band", "place", "u").join(at, "u"))
        blocked = blocked.join(known.select("u", "n", "registers"), "u").select(*_GROUP, "place", "u", "component", "block", "main", "n", "registers")
        by_group = blocked.repartition(*_GROUP).sortWithinPartitions(*_GROUP, "main")
        return by_group.mapInArrow(_compare_blocks(best_only), "a bigint, b bigint, similarity double")

    def grown(joined: DataFrame, found: DataFrame | None) -> DataFrame:
        """The components with more links, which stay as they are if nothing was found."""
        if found is None or found.isEmpty():
            return joined
        before = joined.select(F.col("component").alias("a"), F.col("node").alias("b")).where("a <> b")
        return components(before.unionByName(found))

    met = in_split_buckets(joined, best_only=True)
    best = met.groupBy("a").agg(F.max(F.struct("similarity", "b")).alias("best")).select("a", F.col("best.b").alias("b"))
    joined = grown(joined, linked(best, "closest"))
    joined = grown(joined, linked(in_split_buckets(joined, best_only=False), "rest"))

    label = classes.join(joined.withColumnRenamed("node", "id"), "id", "left")
    label = label.select("c", F.coalesce("component", "id").alias("component_id"))
    labelled = keyed.join(label, "c").select("id", "n", "component_id")
    alone = all_rows.where(~F.coalesce(linking, F.lit(False))).select("id", "n", F.col("id").alias("component_id"))
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))
    return labelled.unionByName(alone).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", kept.alias("kept")
    )


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept; all columns stay as they are."""
    found = near_duplicates(docs, id_col, text_col).where(~F.col("kept")).select(F.col(id_col).alias("id"))
    folder = shared_folder(docs.sparkSession, "neardup-removed")
    found.distinct().write.parquet(folder)
    removed = docs.sparkSession.read.parquet(folder)
    removed = F.broadcast(removed) if removed.count() <= SENT_IDS else removed
    return docs.alias("d").join(removed.alias("r"), F.col(f"d.`{id_col}`") == F.col("r.id"), "left_anti")
