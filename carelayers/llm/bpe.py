"""BPE encoding by speculation: longest matches proposed, borders checked, few words merged.

A list of tokens is what byte-pair merging makes of a word exactly if every token is what merging
makes of its own bytes and no merge crosses the border of two neighbours. Both are facts about a
token or a pair of tokens, so they are checked for arrays of them at once; a word that fails is
merged step by step.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelayers.llm.batches import steps, texts
from carelayers.llm.tokens import Encoder, by_pieces

# Fixed value: how byte-level BPE files of this family cut a text into words.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Words of up to so many bytes are merged together, longer ones each on its own.
SHORT_WORD = 64

_NEVER = np.iinfo(np.int64).max
#: So few words are walked one after the other, byte by byte: the last ones are the longest.
_FEW = 16


def _byte_of_letter() -> dict[str, int]:
    """The letters that stand for bytes: printable ones for themselves, the rest from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Bpe:
    """Vocabulary and merges of a byte-level BPE file, as arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        letter = _byte_of_letter()
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.size = size
        self.bytes_of = [b""] * size
        for text, i in vocab.items():
            if text not in self.special:
                self.bytes_of[i] = bytes(letter[c] for c in text)
        for text, i in self.special.items():
            self.bytes_of[i] = text.encode()

        left, right = (np.array([vocab[m[k]] for m in merges], dtype=np.int64) for k in (0, 1))
        made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        # Parts and rank of the merge that makes a token; bytes have neither.
        self.rank = np.full(size, -1, dtype=np.int64)
        self.left, self.right = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        order = np.arange(len(merges))[::-1]
        self.rank[made[order]], self.left[made[order]], self.right[made[order]] = (
            order, left[order], right[order],
        )
        self.made = made
        keys = left * size + right
        by_key = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_ranks = keys[by_key], by_key
        self.merge_of = {(int(a), int(b)): (r, int(m)) for r, (a, b, m) in enumerate(zip(left, right, made))}
        self.byte_id = np.zeros(256, dtype=np.int64)
        for i, b in enumerate(self.bytes_of):
            if len(b) == 1 and self.rank[i] < 0 and i not in self.special.values():
                self.byte_id[b[0]] = i

        merged = np.flatnonzero(self.rank >= 0)
        self.sound = self.rank < 0
        self.sound[merged] = self._border_holds(self.left[merged], self.right[merged], inside=True)
        # A token is sound if its parts are; parts have lower ranks, so follow the ranks.
        for t in merged[np.argsort(self.rank[merged])].tolist():
            self.sound[t] &= self.sound[self.left[t]] and self.sound[self.right[t]]

        # Prefix tree: node * 256 + byte -> node, as sorted keys; the token that ends at a node.
        children: dict[int, int] = {}
        token_at = [-1]
        for i in [*self.byte_id.tolist(), *merged.tolist()]:
            node = 0
            for b in self.bytes_of[i]:
                key = node * 256 + b
                if key not in children:
                    children[key] = len(token_at)
                    token_at.append(-1)
                node = children[key]
            token_at[node] = i
        tree = np.array(sorted(children.items()), dtype=np.int64)
        self.edge_keys, self.edge_nodes = tree[:, 0].copy(), tree[:, 1].copy()
        self.token_at = np.array(token_at, dtype=np.int64)
        self.children, self.token_of_node = children, token_at

    def _merge_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], _NEVER)

    def _border_holds(self, a: np.ndarray, b: np.ndarray, inside: bool = False) -> np.ndarray:
        """Whether no merge ever crosses the border between neighbours ``a`` and ``b``.

        Undoes merges on both sides of the border from the last to the first. At each moment the
        two parts at the border would merge if their merge comes before either part's own next one;
        of two equal merges the left one comes first. ``inside``: the merge of ``a`` and ``b``
        themselves is wanted, only earlier ones are not.
        """
        holds = np.ones(len(a), dtype=bool)
        live = np.arange(len(a))
        next_a = np.full(len(a), _NEVER)
        next_b = np.full(len(a), _NEVER)
        top = inside
        while live.size:
            rank = self._merge_rank(a, b)
            crossed = (rank < next_a) & (rank <= next_b) & (rank < _NEVER) & (not top)
            top = False
            holds[live[crossed]] = False
            rank_a, rank_b = self.rank[a], self.rank[b]
            go = ~crossed & ((rank_a >= 0) | (rank_b >= 0))
            live, a, b, next_a, next_b = live[go], a[go], b[go], next_a[go], next_b[go]
            rank_a, rank_b = rank_a[go], rank_b[go]
            undo_b = rank_b >= rank_a
            next_b = np.where(undo_b, rank_b, next_b)
            next_a = np.where(undo_b, next_a, rank_a)
            a, b = np.where(undo_b, a, self.right[a]), np.where(undo_b, self.left[b], b)
        return holds

    def _longest_matches(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest tokens of all words at once: word numbers and tokens, in text order."""
        data = np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.int64)
        ends = np.cumsum([len(w) for w in words])
        starts = ends - [len(w) for w in words]
        word = np.flatnonzero(ends > starts)
        at, end = starts[word].copy(), ends[word]
        node, depth = np.zeros_like(at), np.zeros_like(at)
        best, best_len = np.full_like(at, -1), np.zeros_like(at)
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while word.size > _FEW:
            inside = at + depth < end
            keys = node * 256 + data[np.minimum(at + depth, len(data) - 1)]
            edge = np.minimum(np.searchsorted(self.edge_keys, keys), len(self.edge_keys) - 1)
            found = inside & (self.edge_keys[edge] == keys)
            node = np.where(found, self.edge_nodes[edge], 0)
            depth = np.where(found, depth + 1, 0)
            token = np.where(found, self.token_at[node], -1)
            best, best_len = np.where(token >= 0, token, best), np.where(token >= 0, depth, best_len)
            if not found.all():
                stop = ~found
                out.append((word[stop], at[stop], best[stop]))
                at = np.where(stop, at + best_len, at)
                best_len = np.where(stop, 0, best_len)
                go = at < end
                word, at, end, node, depth, best, best_len = (
                    x[go] for x in (word, at, end, node, depth, best, best_len)
                )
        for w, a, e in zip(word.tolist(), at.tolist(), end.tolist()):
            where, tokens = self._walk(words[w], a - (e - len(words[w])))
            out.append((np.full(len(where), w), np.array(where) + (e - len(words[w])), np.array(tokens)))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        word, at, token = (np.concatenate(x) for x in zip(*out))
        order = np.argsort(at, kind="stable")
        return word[order], token[order]

    def _walk(self, word: bytes, at: int) -> tuple[list[int], list[int]]:
        """Greedy longest tokens of one word from ``at`` on: where they begin, and which they are."""
        children, token_at = self.children, self.token_of_node
        where, tokens = [], []
        while at < len(word):
            node, best, after = 0, -1, at + 1
            for i in range(at, len(word)):
                node = children.get(node * 256 + word[i])
                if node is None:
                    break
                if token_at[node] >= 0:
                    best, after = token_at[node], i + 1
            where.append(at)
            tokens.append(best)
            at = after
        return where, tokens

    def merge(self, word: bytes) -> list[int]:
        """Exact merging of one word: always the lowest rank, the leftmost of equals."""
        ids = self.byte_id[np.frombuffer(word, dtype=np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        todo = []

        def note(i: int) -> None:
            j = after[i]
            if j < len(ids) and (found := self.merge_of.get((ids[i], ids[j]))):
                heapq.heappush(todo, (found[0], i, ids[i], ids[j], found[1]))

        for i in range(len(ids) - 1):
            note(i)
        while todo:
            _, i, a, b, made = heapq.heappop(todo)
            j = after[i]
            if ids[i] != a or j >= len(ids) or ids[j] != b:
                continue
            ids[i], ids[j] = made, -1
            after[i] = after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            note(i)
            if before[i] >= 0:
                note(before[i])
        return [t for t in ids if t >= 0]

    def _merge_together(self, words: list[bytes]) -> list[bytes]:
        """Exact merging of many short words: in each round every word makes its next merge."""
        lengths = np.array([len(w) for w in words])
        ids = self.byte_id[np.frombuffer(b"".join(words), dtype=np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        rank = np.full(len(ids), _NEVER)

        def look(at: np.ndarray) -> None:
            at = at[(at >= 0) & (at + 1 < len(ids))]
            at = at[word[at] == word[at + 1]]
            rank[at] = self._merge_rank(ids[at], ids[at + 1])

        look(np.arange(len(ids)))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(ids):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            sizes = np.diff(np.r_[starts, len(ids)])
            lowest = np.minimum.reduceat(rank, starts)
            ended = np.repeat(lowest == _NEVER, sizes)
            if ended.any():
                done.append((word[ended], ids[ended]))
                ids, word, rank = ids[~ended], word[~ended], rank[~ended]
                sizes, lowest = sizes[lowest < _NEVER], lowest[lowest < _NEVER]
            if not len(ids):
                break
            at = np.flatnonzero(rank == np.repeat(lowest, sizes))
            at = at[np.r_[True, word[at[1:]] != word[at[:-1]]]]
            ids[at] = self.made[rank[at]]
            rank[at] = _NEVER
            keep = np.ones(len(ids), dtype=bool)
            keep[at + 1] = False
            ids, word, rank = ids[keep], word[keep], rank[keep]
            at = at - np.arange(len(at))
            look(at)
            look(at - 1)
        word, ids = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        flat = ids[order].astype("<u4").tobytes()
        cuts = np.searchsorted(word[order], np.arange(len(words) + 1)) * 4
        return [flat[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of every word, as little-endian 32-bit bytes."""
        word, token = self._longest_matches(words)
        fails = np.zeros(len(words), dtype=bool)
        fails[word[~self.sound[token]]] = True
        same = np.flatnonzero(word[1:] == word[:-1])
        pairs, back = np.unique(token[same] * self.size + token[same + 1], return_inverse=True)
        holds = self._border_holds(pairs // self.size, pairs % self.size)
        fails[word[same[~holds[back]]]] = True
        flat = token.astype("<u4").tobytes()
        cuts = np.searchsorted(word, np.arange(len(words) + 1)) * 4
        found = [flat[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        failing = np.flatnonzero(fails).tolist()
        short = [w for w in failing if len(words[w]) <= SHORT_WORD]
        if short:
            for w, ids in zip(short, self._merge_together([words[w] for w in short])):
                found[w] = ids
        for w in failing:
            if len(words[w]) > SHORT_WORD:
                found[w] = np.array(self.merge(words[w]), dtype="<u4").tobytes()
        return found

    def encode_pieces(self, new: list[str]) -> list[bytes]:
        """Ids of pieces of text that hold whole words and no special token."""
        words = [[p] if p.removeprefix(" ").isalpha() else _WORD.findall(p) for p in new]
        distinct = list({w for ws in words for w in ws})
        ids = dict(zip(distinct, self.encode_words([w.encode() for w in distinct]), strict=True))
        return [b"".join([ids[w] for w in ws]) for ws in words]

    def decode(self, ids: bytes) -> str:
        """The text of ids given as little-endian 32-bit bytes; special tokens are their text."""
        get = self.bytes_of.__getitem__
        return b"".join(map(get, np.frombuffer(ids, dtype="<u4").tolist())).decode("utf-8", "replace")


_WORD = regex.compile(WORDS)
_LOADED: dict[str, tuple[Bpe, Encoder]] = {}


def load(path: str) -> tuple[Bpe, Encoder]:
    """Tables and encoder of a file; one per worker process."""
    if path not in _LOADED:
        bpe = Bpe(path)
        _LOADED[path] = bpe, Encoder(by_pieces(bpe.encode_pieces), bpe.special)
    return _LOADED[path]


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, ids array<int>)``: the ids of every whole text, special tokens' text included.

    One row per input row, repeated rows and NULL ids too; NULL and empty texts have no ids; other
    columns of the input are not looked at. No shuffle.
    """
    fields = f"__id {dict(docs.dtypes)[id_col]}, ids array<int>"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(tokenizer)[1]
        for part in steps(batches):
            found = encoder(texts(part.column(1)))
            cuts = np.cumsum([0, *[len(b) // 4 for b in found]]).astype(np.int32)
            flat = pa.array(np.frombuffer(b"".join(found), dtype="<u4").astype(np.int32))
            ids = pa.ListArray.from_arrays(pa.array(cuts), flat)
            yield pa.RecordBatch.from_arrays([part.column(0), ids], names=["__id", "ids"])

    picked = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    return picked.mapInArrow(run, fields).withColumnRenamed("__id", id_col)


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_tokens, ids_sha256, decoded_sha256)``: texts encoded, and their ids decoded.

    As ``encode``; the ids stay in the task, so long ones never leave it.
    """
    fields = f"__id {dict(docs.dtypes)[id_col]}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, encoder = load(tokenizer)
        for part in steps(batches):
            found = encoder(texts(part.column(1)))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([len(b) // 4 for b in found], pa.int64()),
                    pa.array([hashlib.sha256(b).hexdigest() for b in found], pa.string()),
                    pa.array([hashlib.sha256(bpe.decode(b).encode()).hexdigest() for b in found], pa.string()),
                ],
                names=["__id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    picked = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    return picked.mapInArrow(run, fields).withColumnRenamed("__id", id_col)
