"""Token ids of whole texts, encoding each repeated piece of text once.

A byte-level pre-tokenizer always cuts before a blank that a non-blank follows. So a text may be
cut there and the pieces encoded alone; most are one word, and few of them are new.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Sequence

_CUT = re.compile(r"(?=\x20\S)")
_BLANK_RUN = re.compile(r"\x20\s")
_MARK = "\x00"


def pieces(text: str) -> list[str]:
    """``text`` cut before every blank that a non-blank follows."""
    if _MARK in text or _BLANK_RUN.search(text):
        return _CUT.split(text)
    return text.replace(" ", _MARK + " ").split(_MARK)


class Encoder:
    """Texts to ids, as little-endian 32-bit bytes.

    ``encode_plain`` encodes texts without special tokens. A special token's own text in a text is
    that token, as in the tokenizers library.
    """

    def __init__(self, encode_plain: Callable[[list[str]], list[bytes]], special: dict[str, int]):
        self.encode_plain = encode_plain
        self.special = {text: i.to_bytes(4, "little") for text, i in special.items()}
        names = sorted(map(re.escape, special), key=len, reverse=True)
        self.at_special = re.compile(f"({'|'.join(names)})") if names else None

    def __call__(self, texts: Sequence[str]) -> list[bytes]:
        if self.at_special is None or not any(s in t for t in texts for s in self.special):
            return self.encode_plain(list(texts))
        parts = [self.at_special.split(t) for t in texts]
        plain = iter(self.encode_plain([p for ps in parts for p in ps[::2]]))
        return [
            b"".join(next(plain) if i % 2 == 0 else self.special[p] for i, p in enumerate(ps))
            for ps in parts
        ]


def by_pieces(encode_new: Callable[[list[str]], list[bytes]], max_pieces: int = 300_000):
    """An encoder of texts that encodes only pieces not seen before; it forgets beyond a bound."""
    known: dict[str, bytes] = {}

    def encode(texts: list[str]) -> list[bytes]:
        cut = [pieces(t) for t in texts]
        wanted = {p for c in cut for p in c}
        if len(known) > max_pieces:
            known.clear()
        new = list(wanted.difference(known))
        known.update(zip(new, encode_new(new), strict=True))
        get = known.__getitem__
        return [b"".join(map(get, c)) for c in cut]

    return encode


_ENCODERS: dict[str, Encoder] = {}


def library_encoder(tokenizer: str) -> Encoder:
    """The encoder of a byte-level BPE file of the tokenizers library; one per worker process.

    Runs tiktoken with the ranks of that file: the ids are those of the tokenizers library (tested)
    in a quarter of its time.
    """
    if tokenizer not in _ENCODERS:
        import tiktoken

        from carelayers.llm.bpe import WORDS, Bpe

        bpe = Bpe(tokenizer)
        special = set(bpe.special.values())
        ranks = {b: i for i, b in enumerate(bpe.bytes_of) if b and i not in special}
        library = tiktoken.Encoding("pieces", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

        def encode(texts: list[str]) -> list[bytes]:
            return [array("I", library.encode_ordinary(t)).tobytes() for t in texts]

        _ENCODERS[tokenizer] = Encoder(encode, bpe.special)
    return _ENCODERS[tokenizer]


def default_tokenizer() -> str:
    """Where the public byte-level vocabulary of 50,257 ids lies."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
