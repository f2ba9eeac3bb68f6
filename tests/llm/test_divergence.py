import random
import re
from collections import Counter, defaultdict

import pytest

from reelscope.llm import divergence
from reelscope.llm.divergence import source_divergence
from tests.llm.cases import LONG, LOWER, table

SCHEMA = "lang string, source string, text string"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute(rows, min_docs=10, top=10):
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(LOWER))
        groups[lang].add(source)
        count[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = {t for t, d in docs[lang].items() if d >= min_docs}
        v = len(kept)
        counts = {s: {t: count[lang, s][t] for t in kept} for s in sources}
        whole = {t: sum(c[t] for c in counts.values()) for t in kept}

        def prob(c):
            n = sum(c.values())
            return {t: 1 + 1_000_000_000 * (c[t] + 2) // (n + 2 * v) for t in kept}

        p, q = {s: prob(c) for s, c in counts.items()}, prob(whole)
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in sources:
            pair = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources - {s}]
            term = [(t, f(p[s][t], q[t])) for t in kept if counts[s][t] > 0 and p[s][t] > q[t]]
            for part, found, most in (("pair", pair, None), ("term", term, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(found[:most])]
    return sorted(out)


def result(df):
    assert [f.simpleString() for f in df.schema] == [
        "lang:string", "source:string", "part:string", "item:string", "value:bigint", "rank:int"
    ]
    return sorted(tuple(r) for r in df.collect())


def corpus(seed, n=240):
    rng = random.Random(seed)
    pool = [f"{a}{b}" for a in ("the", "Of", "and", "É", "漢", "zu") for b in ("", "x", "ß", "q", "ing", "ed")]
    rows = []
    for _ in range(n):
        own = rng.choices(pool, k=len(pool) // 2)
        text = " ".join(rng.choice([rng.choice(own), rng.choice(pool).upper()]) + rng.choice(["", ",", "'s", "1", "\n"]) for _ in range(rng.choice([0, 3, 40, 150])))
        rows.append((rng.choice(["en", "en", "en", "de", None, ""]), rng.choice(["a", "b", "b", "c", "é", None]), text))
    return rows


@pytest.mark.parametrize("own_block", [0, 1, 4, 10**6])
def test_against_brute_force(spark, monkeypatch, own_block):
    """With blocks of one term, of both kinds, and of 64 terms alone."""
    monkeypatch.setattr(divergence, "OWN_BLOCK", own_block)
    rows = corpus(own_block)
    assert result(source_divergence(table(spark, rows, SCHEMA))) == brute(rows)


def test_edge_rows(spark):
    rows = [("en", "s", None), ("en", None, ""), ("en", "t", "1 2 3 --- @[`{"), (None, None, "alone"), ("de", "x", LONG)]
    rows += [("fr", "one", "déjà vu DÉJÀ Vu")] * 10 + [("fr", "two", "vu")] * 3 + [("fr", "none", None)]
    assert result(source_divergence(table(spark, rows, SCHEMA))) == brute(rows)
    assert source_divergence(table(spark, [], SCHEMA)).collect() == []
    clash = table(spark, [(*r, "x", 1) for r in rows], SCHEMA + ", term string, n int")
    assert result(source_divergence(clash)) == brute(rows)


def test_languages_without_kept_terms_have_pairs_of_value_zero(spark):
    rows = [("en", "a", "few words"), ("en", "b", "here"), ("en", "c", None)]
    got = result(source_divergence(table(spark, rows, SCHEMA)))
    assert got == brute(rows) and {r[4] for r in got} == {0} and len(got) == 6


def test_many_terms_span_blocks_and_products_pass_64_bits(spark):
    words = [f"{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(400)]
    rows = [("en", s, " ".join(words[: 400 - 30 * k] * (k + 1))) for k, s in enumerate("abc") for _ in range(10)]
    assert result(source_divergence(table(spark, rows, SCHEMA))) == brute(rows)
    row = spark.sql("SELECT 20000000000L AS n, 50000000000L AS total, 100L AS v").select(
        divergence._probability("n", "total", "v").alias("p")
    ).first()
    assert row.p == 1 + 10**9 * (2 * 10**10 + 2) // (5 * 10**10 + 200)
