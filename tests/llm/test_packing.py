import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from carelayers.llm import packing, tokens
from helpers import document_table

PATH = tokens.default_tokenizer()


@given(st.integers(1, 5000))
def test_cut_covers_a_document(n):
    lengths = packing.cut(n)
    assert sum(lengths) == n and all(1 <= x <= 1024 for x in lengths)
    assert sum(x < 1024 for x in lengths) <= 4


def check(rows, pieces, fill):
    library = Tokenizer.from_file(PATH)
    ids = defaultdict(list)
    for doc, text, *_ in rows:
        found = library.encode(text or "", add_special_tokens=False).ids
        ids[doc].append(np.array([*found, 0], dtype="<u4"))
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
    assert set(by_doc) == {r[0] for r in rows}
    for doc, own in by_doc.items():
        if len(ids[doc]) > 1:  # rows that share an id: as many pieces as the rows have
            assert sum(p.length for p in own) == sum(map(len, ids[doc]))
            continue
        whole, at = ids[doc][0], 0
        for p in sorted(own, key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(whole))
            assert p.ids_crc32 == zlib.crc32(whole[at : at + p.length].tobytes())
            at += p.length
        assert at == len(whole)
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024
    assert sum(p.length for p in pieces) >= fill * 1024 * len(sequences)


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    for frame in (docs, docs.repartition(70)):  # more workers than one round takes
        check(rows, packing.pack(frame, PATH).collect(), 0.97)


def test_odd_rows(spark):
    rows = [(1, None, None, None), (2, "", None, None), (3, "a b c", None, None), (3, "d", None, None), (None, "no id", None, None), (5, "word " * 9000, None, None)]
    for extra in (False, True):
        check(rows, packing.pack(document_table(spark, rows, extra), PATH).collect(), 0.5)
    assert packing.pack(document_table(spark, []), PATH).collect() == []


def test_sequence_ids_survive_a_second_look(spark, sf_dir):
    packed = packing.pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), PATH)
    assert sorted(map(tuple, packed.collect())) == sorted(map(tuple, packed.collect()))
