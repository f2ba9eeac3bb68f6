import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from reelscope.llm import textgrams
from tests.llm.cases import shingle_set, words

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbB \t\né \x1c漢", max_size=40)), max_size=6)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(1, 7))
def test_words_and_grams_tell_texts_apart(texts, n):
    w = textgrams.words(pa.array(texts, pa.string()))
    plain = [words(t) for t in texts]
    assert w.counts.tolist() == [len(p) for p in plain]
    flat = [x for p in plain for x in p]
    assert [w.data[a:b].tobytes().decode() for a, b in zip(w.starts, w.ends)] == flat
    of_hash = {}
    for x, h in zip(flat, w.hashes.tolist()):
        assert of_hash.setdefault(x, h) == h
    assert len(set(of_hash.values())) == len(of_hash)
    at, h = w.gram(n)
    row = w.row_of_word()
    grams = [tuple(flat[i : i + n]) for i in at]
    assert at.tolist() == [i for i in range(len(flat)) if i + n <= len(flat) and row[i] == row[i + n - 1]]
    assert len(set(h.tolist())) == len(set(grams))


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_shingle_sets(texts):
    sets = textgrams.shingles(textgrams.words(pa.array(texts, pa.string()), lower=True))
    plain = [shingle_set(t) for t in texts]
    assert [len(s) for s in sets] == [len(p) for p in plain]
    for i in range(len(texts)):
        for j in range(len(texts)):
            assert len(np.intersect1d(sets[i], sets[j])) == len(plain[i] & plain[j])


def test_segments_and_slices_do_not_change_hashes(monkeypatch):
    texts = pa.array(["x" * 50 + " ab cd " * 40, None, "ab " * 100 + "y" * 300])
    whole = textgrams.words(texts).hashes
    monkeypatch.setattr(textgrams, "SEGMENT_BYTES", 16)
    assert (textgrams.words(texts).hashes == whole).all()
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    parts = list(textgrams.slices(iter([batch]), "text", limit=10))
    assert [p.num_rows for p in parts] == [1, 1, 1]
    assert (np.concatenate([textgrams.words(p.column("text")).hashes for p in parts]) == whole).all()


def test_rolling_hashes_are_equal_only_for_equal_runs():
    rng = random.Random(3)
    texts = [" ".join(rng.choices("abcdefgh", k=rng.randrange(60))) for _ in range(300)]
    apart = {t: textgrams.words(pa.array([t])) for t in texts}
    w = textgrams.words(pa.array(texts))
    for n in (1, 2, 5, 10):
        seen = {}
        places, hashes = w.gram(n)
        row = w.row_of_word()
        for p, h in zip(places, hashes):
            own = texts[row[p]].split()[p - w.first[row[p]] :][:n]
            assert len(own) == n
            assert seen.setdefault(int(h), own) == own
        assert len(seen) == len({tuple(v) for v in seen.values()})
        assert list(hashes) == [h for t in texts for h in apart[t].gram(n)[1]]  # wherever a text lies in a slice
    assert list(textgrams.sequences(w)[0]) == [h for t in texts for h in textgrams.sequences(apart[t])[0]]


def test_a_span_hash_is_the_polynomial_of_its_bytes(monkeypatch):
    monkeypatch.setattr(textgrams, "SEGMENT_BYTES", 8)
    data = np.frombuffer(b"ab cdefghijklmnop q rst uvwxyz12", np.uint8)
    starts, ends = np.array([0, 3, 17, 18, 20, 28, 32]), np.array([2, 16, 17, 19, 28, 28, 32])  # two spans are empty
    power = [pow(textgrams._BASE, i, 1 << 64) for i in range(32)]
    want = [sum(int(textgrams._BYTE[b]) * power[i] for i, b in enumerate(data[s:e].tolist())) + int(e - s) for s, e in zip(starts, ends)]
    want = textgrams.mix(np.array([w % (1 << 64) for w in want], dtype=np.uint64))
    assert (textgrams.span_hashes(data, starts, ends) == want).all()
