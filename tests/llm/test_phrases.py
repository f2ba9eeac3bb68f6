import random
import re
from collections import Counter, defaultdict

import pytest

from reelscope.llm import phrases
from reelscope.llm.phrases import collocations, parse_dictionary
from tests.llm.cases import LONG, LOWER, table

SCHEMA = "lang string, text string"


def pieces(text):
    for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
        yield re.findall("[^\x20\x09]+", piece)


def brute(rows, top=2000, min_count=30, percent=80):
    count, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            for k in range(1, 5):
                count[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in count.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        inside = defaultdict(int)
        for p, a in found.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inside[p[i : i + size]] = max(inside[p[i : i + size]], a)
        rated = []
        for p, a in found.items():
            if 100 * inside[p] < percent * a:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                rated.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        rated.sort()
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(rated[:top])]
    return sorted(out)


def result(df):
    assert [f.simpleString() for f in df.schema] == [
        "lang:string", "rank:bigint", "phrase:string", "a:bigint", "l:bigint", "r:bigint", "n:bigint", "score:bigint"
    ]
    return sorted(tuple(r) for r in df.collect())


def corpus(seed, n=150):
    rng = random.Random(seed)
    pool = ["the", "of", "AND", "é", "漢字", "in", "a", "to"]
    fixed = ["new york city hall", "New York", "as well as", "a a a a a", "in the end of it"]
    rows = []
    for _ in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.3 else rng.choice(pool) for _ in range(rng.choice([0, 1, 5, 30, 200]))]
        text = "".join(p + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\x0b"]) for p in parts)
        rows.append((rng.choice(["en", "en", "en", None, "und", ""]), text))
        if rng.random() < 0.2:
            rows += [rows[-1]] * rng.randrange(4)
    return rows


@pytest.mark.parametrize("every, run", [(16, 512), (1, 512), (2, 1), (1 << 40, 5)])
def test_against_brute_force(spark, monkeypatch, every, run):
    """Whatever the triggers: often, never, and with runs of few words."""
    monkeypatch.setattr(phrases, "EVERY", every)
    monkeypatch.setattr(phrases, "RUN", run)
    rows = corpus(7)
    got = result(collocations(table(spark, rows, SCHEMA)))
    assert got == brute(rows) and len(got) > 20


def test_dictionary_rebuilds_every_piece(spark):
    """Chunks laid end to end, each without the words of the next one, are the pieces."""
    rows = corpus(11, 60) + [("en", LONG)]
    entries = parse_dictionary(table(spark, rows, SCHEMA)).collect()
    words = Counter()
    for r in entries:
        w = r.chunk.split(" ")
        assert r.own <= len(w) <= r.own + phrases.WINDOW and r.own <= phrases.RUN
        for x in w[: r.own]:
            words[r.lang, x] += r.f
    expected = Counter()
    for lang, text in rows:
        for w in pieces(text):
            expected.update(("und" if lang is None else lang, x) for x in w)
    assert words == expected
    assert sum(r.f for r in entries) > len(entries)  # copies are parsed into the same chunks


def test_edge_rows(spark):
    rows = [("en", None), (None, ""), ("en", " \t\n.,;"), ("de", "one"), ("en", LONG), ("fr", "x" * 100_000 + " y")]
    assert result(collocations(table(spark, rows, SCHEMA))) == []
    rows += [("en", "tie one. tie two! tie one two")] * 30 + [(None, "nul nul nul")] * 40 + [("und", "NUL nul")] * 3
    assert result(collocations(table(spark, rows, SCHEMA))) == brute(rows)
    assert result(collocations(table(spark, rows, SCHEMA), top=2)) == brute(rows, top=2)
    clash = table(spark, [(*r, "x", 1) for r in rows], SCHEMA + ", phrase string, n int")
    assert result(collocations(clash)) == brute(rows)
    assert collocations(table(spark, [], SCHEMA)).collect() == []


def test_one_long_text(spark):
    rng = random.Random(1)
    rows = [("en", " ".join(rng.choices(["p", "q", "r", "s"], k=60_000)))]
    assert result(collocations(table(spark, rows, SCHEMA))) == brute(rows)


def test_a_full_bitmap_changes_nothing(spark, monkeypatch):
    """The bitmap only spares work: with one that holds everything counts are the same."""
    rows = corpus(3, 80)
    usual = result(collocations(table(spark, rows, SCHEMA)))
    import numpy as np

    monkeypatch.setattr(phrases, "_bloom", lambda tokens: np.full(8192, 255, dtype=np.uint8))
    assert result(collocations(table(spark, rows, SCHEMA))) == usual == brute(rows)
