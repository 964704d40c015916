"""Brute-force versions that share no code with the operators."""

import re
from collections import defaultdict

import numpy as np


def document_table(spark, rows, extra=False):
    """``(doc_id, text, lang, source)`` rows; ``extra`` adds columns with names the operators use."""
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    if extra:
        from pyspark.sql import functions as F

        for name in ("id", "__id", "n", "spans", "lang_pred", "score", "removed", "component_id", "length"):
            df = df.withColumn(name, F.lit("x"))
    return df


def shingle_sets(rows):
    sets = {}
    for key, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        if len(words) >= 5:
            sets[key] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        else:
            sets[key] = {tuple(words)} if words else set()
    return sets


def joined(keys, linked):
    """The smallest key that each key hangs together with."""
    root = {k: k for k in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {k: find(k) for k in keys}


def near_duplicates(rows):
    """``{id: (set size, component)}`` by comparing all pairs that share a shingle."""
    sets, holders, links = shingle_sets(rows), defaultdict(list), []
    for key, held in sets.items():
        for shingle in held:
            holders[shingle].append(key)
    for key, held in sets.items():
        shared = defaultdict(int)
        for shingle in held:
            for other in holders[shingle]:
                if other < key:
                    shared[other] += 1
        for other, n in shared.items():
            if 100 * n >= 75 * (len(held) + len(sets[other]) - n):
                links.append((other, key))
    return {k: (len(sets[k]), c) for k, c in joined(sets, links).items()}


def cosine_links(ids, vectors, threshold=0.9):
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = units @ units.T >= threshold
    np.fill_diagonal(near, False)
    pairs = [(int(ids[i]), int(ids[j])) for i, j in zip(*np.nonzero(np.triu(near)))]
    component = joined([int(i) for i in ids], pairs)
    return {int(i): (int(n), component[int(i)]) for i, n in zip(ids, near.sum(axis=1))}
