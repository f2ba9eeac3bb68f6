import random
import re
from collections import Counter

import pyarrow as pa

from reelscope.llm import repetition
from reelscope.llm.repetition import keep_good, repetition_rules
from tests.llm.cases import EDGE_TEXTS, LONG, edge_docs, table, words


def brute(text):
    text = text or ""
    w = words(text)
    cover = {}
    for n in repetition.GRAM_PERCENT:
        count = Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
        cover[n] = {i + k for i in range(len(w) - n + 1) if count[tuple(w[i : i + n])] > 1 for k in range(n)}
    seen, repeats, repeated, total = set(), 0, 0, 0
    for line in text.split("\n"):
        if words(line):
            total += len(line)
            if line in seen:
                repeats, repeated = repeats + 1, repeated + len(line)
            seen.add(line)
    chars = sum(map(len, w))
    dup = [sum(len(w[i]) for i in cover[n]) for n in cover]
    failed = len(w) < 10 or 100 * len(cover[5]) > 20 * len(w)
    kept = not failed and 100 * repeated <= 30 * total and all(100 * d <= 20 * chars for d in dup)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return (len(w), chars, symbols, repeats, len(cover[5]), failed, kept, total, repeated, *dup)


def random_text(rng):
    pool = [f"w{i}" for i in range(rng.choice([2, 8, 400]))]
    lines = [" ".join(rng.choices(pool, k=rng.randrange(12))) for _ in range(rng.randrange(1, 9))]
    return "\n".join(rng.choices(lines, k=rng.randrange(1, 14)))


def test_random_texts_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, random_text(rng)) for i in range(150)]
    got = {r.doc_id: tuple(r)[1:] for r in repetition_rules(table(spark, rows)).collect()}
    assert got == {i: brute(t) for i, t in rows}
    assert {g[6] for g in got.values()} == {True, False}


def test_edge_rows(spark):
    got = sorted((tuple(r) for r in repetition_rules(edge_docs(spark)).collect()), key=repr)
    assert got == sorted(((i, *brute(t)) for i, t in EDGE_TEXTS), key=repr)
    assert repetition_rules(edge_docs(spark, empty=True)).collect() == []


def test_keep_good_keeps_columns_and_clean_rows(spark):
    docs = edge_docs(spark)
    kept = keep_good(docs)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == [8, 9]
    assert keep_good(edge_docs(spark, empty=True)).collect() == []


def test_whole_text_counts(spark):
    tail = LONG + "\n" + " ".join(f"t{i % 50}" for i in range(9000))
    row = repetition_rules(table(spark, [(1, tail)])).first()
    assert row.n_repeat_words == 9000 and row.base_failed


def test_longer_grams_only_where_shorter_repeat():
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["a b c d e f g h a b c d e f x y"])], names=["doc_id", "text"])
    row = next(repetition._measure(iter([batch]))).to_pylist()[0]
    assert [row[f"dup_chars_{n}"] for n in range(5, 11)] == [12, 12, 0, 0, 0, 0]
