import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reelscope.llm import packing
from reelscope.llm.packing import UnitIds, best_fit, document_ids, pack_documents, sequence_rows, tokenized_pieces
from reelscope.llm.queries import tokenizer_path
from tests.llm.cases import EDGE_TEXTS, edge_docs, numbered, table


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def plain_ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, texts, tokenizer, limit=4096):
    """Every piece is its document's, every sequence gapless and within the limit."""
    want = defaultdict(int)
    for i, t in texts:
        ids = plain_ids(tokenizer, t)
        for p, s in enumerate(range(0, len(ids), limit)):
            part = np.array(ids[s : s + limit], dtype="<u4")
            want[i, p, s, len(part), zlib.crc32(part.tobytes())] += 1
    got = defaultdict(int)
    for r in rows:
        got[tuple(r)[:5]] += 1
    assert got == want
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit
    return held


def test_documents_pieces_and_places(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 100)
    rng = random.Random(2)
    texts = [(i, " ".join(rng.choices(["the", "Foxes'", "x1y22", "naïve", "漢字"], k=rng.randrange(1500)))) for i in range(250)]
    texts += [(900, numbered("word", 9000)), (901, None)]
    held = check(pack_documents(table(spark, texts), tokenizer_path()).collect(), texts, tokenizer)
    total = sum(length for parts in held.values() for _, length in parts)
    assert len(held) <= 1.02 * total / 4096 + 4


def test_edge_rows(spark, tokenizer):
    held = check(pack_documents(edge_docs(spark), tokenizer_path()).collect(), EDGE_TEXTS, tokenizer)
    assert held
    assert pack_documents(edge_docs(spark, empty=True), tokenizer_path()).collect() == []


def test_sequences_hold_the_ids(spark, tokenizer):
    texts = [(i, numbered("ab", 10 + i)) for i in range(20)] + [(99, numbered("long", 3000))]
    docs = table(spark, texts)
    packed = pack_documents(docs, tokenizer_path(), max_tokens=512)
    ids = tokenized_pieces(docs, tokenizer_path(), 512, with_ids=True)
    of = dict(texts)
    for r in sequence_rows(packed, ids).collect():
        assert len(r.ids) <= 512 and r.starts[0] == 0
        for doc, a, b in zip(r.doc_ids, r.starts, [*r.starts[1:], len(r.ids)]):
            whole = plain_ids(tokenizer, of[doc])
            assert any(whole[s : s + b - a] == r.ids[a:b] for s in range(0, len(whole), 512))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aB'sT \t\n\x85\xa0é́İſ漢12.<|>endoftxrΣς ", max_size=30), max_size=5))
def test_ids_of_units_are_ids_of_texts(texts):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    ids, bounds = document_ids(pa.array(texts, pa.string()), UnitIds(tokenizer_path()))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [plain_ids(plain, t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60), st.integers(1, 5), st.integers(4096, 6000), st.sampled_from(["norm", "dot"]))
def test_every_constraint_holds(lengths, documents, attention, rule):
    lengths = np.array(lengths, dtype=np.int64)
    sequence, offset = best_fit(lengths, 64, documents, attention, rule=rule)
    for s in set(sequence.tolist()):
        own = lengths[sequence == s]
        assert own.sum() <= 64 and len(own) <= documents and (own**2).sum() <= attention
        order = np.argsort(offset[sequence == s])
        assert offset[sequence == s][order].tolist() == np.r_[0, np.cumsum(own[order])[:-1]].tolist()


def test_too_large_a_piece_is_an_error():
    with pytest.raises(ValueError):
        best_fit(np.array([65]), 64, 4, 10_000)
    with pytest.raises(ValueError):
        best_fit(np.array([60]), 64, 4, 3000)


def test_best_fit_fills_sequences():
    lengths = np.array([60, 50, 40, 30, 24, 14, 4, 34])
    sequence, _ = best_fit(lengths, 64, 64, 64 * 64)
    assert len(set(sequence.tolist())) == 4  # 60+4, 50+14, 40+24, 30+34
