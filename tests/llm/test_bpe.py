import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from carelayers.llm import bpe, tokens
from helpers import document_table

PATH = tokens.default_tokenizer()
HARD = [
    "", " ", "   ", "a", "  a", "a  b \n c", "\n\n", "x <|endoftext|> y  <|endoftext|>", "<|endoftext|>",
    "it's 'll don't 1234 56", "naïve café 　  日本語 🎉🎉", "a\x1cb \x1c c  \x1dd\x00 e", "z" * 3000,
    "ab" * 700 + " " + "!" * 300, "<|endoftext|" + ">" * 3,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def whole_texts(spark, sf_dir):
    return [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]


def expected(library, texts):
    return [np.array(e.ids, dtype="<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]


def test_both_encoders_give_the_library_ids(library, whole_texts):
    texts = HARD + whole_texts
    want = expected(library, texts)
    assert bpe.load(PATH)[1](texts) == want
    assert tokens.library_encoder(PATH)(texts) == want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab etnis'  \n.,19é 日<|endoftext>"), max_size=60), max_size=4))
def test_random_texts(texts):
    library = Tokenizer.from_file(PATH)
    assert bpe.load(PATH)[1](texts) == expected(library, texts)


def test_speculation_and_exact_merging_agree(whole_texts):
    table = bpe.load(PATH)[0]
    words = list({w.encode() for t in whole_texts[:60] for w in bpe._WORD.findall(t)})
    merged = [np.array(table.merge(w), dtype="<u4").tobytes() for w in words]
    assert table.encode_words(words) == merged
    assert table._merge_together(words) == merged


def test_border_check_is_what_merging_does():
    """A pair holds exactly if merging both tokens' bytes together gives the two tokens."""
    table = bpe.load(PATH)[0]
    random = np.random.default_rng(1)
    a, b = random.integers(0, 50256, 3000), random.integers(0, 50256, 3000)
    holds = table._border_holds(a.copy(), b.copy())
    for x, y, h in zip(a.tolist(), b.tolist(), holds.tolist()):
        assert (table.merge(table.bytes_of[x] + table.bytes_of[y]) == [x, y]) == h
    assert table.sound.all()


def test_table(spark, library):
    rows = [(i, t, None, None) for i, t in enumerate(HARD)] + [(0, None, None, None), (None, "a b", None, None), (1, " ", "x", "y")]
    for extra in (False, True):
        docs = document_table(spark, rows, extra)
        out = bpe.round_trip(docs, PATH)
        assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        want = []
        for doc, text, *_ in rows:
            ids = library.encode(text or "", add_special_tokens=False).ids
            decoded = library.decode(ids, skip_special_tokens=False)
            assert decoded == (text or "")
            code = hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
            want.append((doc, len(ids), code, hashlib.sha256(decoded.encode()).hexdigest()))
        assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))
    found = {r.doc_id: r.ids for r in bpe.encode(docs, PATH).where("doc_id > 1").collect()}
    assert found == {i: library.encode(t, add_special_tokens=False).ids for i, t in enumerate(HARD) if i > 1}


def test_empty_table(spark):
    docs = document_table(spark, [])
    assert bpe.round_trip(docs, PATH).collect() == [] == bpe.encode(docs, PATH).collect()


def test_long_words(library):
    """Words of many tokens, alone and among many others; time grows with their length."""
    import random
    import time

    rng = random.Random(5)
    table = bpe.Bpe(PATH)
    long = ["".join(rng.choice(letters) for _ in range(n)) for letters, n in (("abcdefgh", 30_000), ("0123", 20_000), ("é日x", 9_000))]
    others = ["".join(rng.choice("etaoin") for _ in range(rng.randint(1, 30))) for _ in range(300)]
    for words in (long, long + others):
        want = [np.array(library.encode(w, add_special_tokens=False).ids, dtype="<u4").tobytes() for w in words]
        assert table.encode_words([w.encode() for w in words]) == want
    began = time.process_time()
    table._longest_matches(["".join(rng.choice("abcdefgh") for _ in range(1_000_000)).encode()])
    assert time.process_time() - began < 20
