import random
from collections import defaultdict

import pytest

from reelscope.llm import line_dedup
from reelscope.llm.line_dedup import keep_bitmaps, without_repeated_lines
from tests.llm.cases import EDGE_TEXTS, LOWER, edge_docs, table


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def brute(rows, min_chars=20, min_docs=3):
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    last = {k: max(h, key=lambda i: (i is not None, i or 0)) for k, h in holders.items() if len(h) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if key(x) not in last or last[key(x)] == i]
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=repr)


def result(df):
    assert df.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def corpus(seed, n=120):
    rng = random.Random(seed)
    pool = [f"Line {i} that documents share é" for i in range(30)] + ["short one", "", "  ", "x" * 19, "y" * 20]
    rows = []
    for i in range(n):
        lines = [rng.choice(["", " ", "\t"]) + rng.choice(pool) + rng.choice(["", "\r", " \t"]) if rng.random() < 0.6
                 else f"a line of document {i} alone {rng.random()}" for _ in range(rng.choice([1, 3, 12, 200]))]
        if rng.random() < 0.3:
            lines = [x.upper() for x in lines]
        rows.append((rng.choice([i, i, i, i // 2, None]), "\n".join(lines)))
    return rows


@pytest.mark.parametrize("hot", [1, 10, 1000])
def test_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(line_dedup, "HOT_KEYS", hot)
    rows = corpus(hot)
    assert result(without_repeated_lines(table(spark, rows))) == brute(rows)


def test_edge_rows(spark):
    docs = edge_docs(spark)
    assert result(without_repeated_lines(docs)) == brute(EDGE_TEXTS)
    assert result(without_repeated_lines(edge_docs(spark, empty=True))) == []
    assert keep_bitmaps(edge_docs(spark, empty=True)).collect() == []


def test_two_documents_keep_their_line_and_the_largest_id_wins(spark):
    line = "the very same line in documents"
    rows = [(1, line), (2, f" {line.upper()} "), (2, line)]
    assert result(without_repeated_lines(table(spark, rows))) == brute(rows)
    rows += [(9, f"{line}\nown\n{line}"), (None, f"x\n{line}")]
    got = result(without_repeated_lines(table(spark, rows)))
    assert got == brute(rows)
    assert (9, f"{line}\nown\n{line}", 3, 0) in got and (None, "x", 2, 1) in got


def test_bitmaps_hold_only_words_with_a_dropped_line(spark):
    shared = "a line that all of them hold"
    texts = {i: "\n".join([*(f"own {i} {k}" for k in range(200)), shared, *(f"more {i} {k}" for k in range(300))]) for i in range(4)}
    rows = keep_bitmaps(table(spark, list(texts.items()))).collect()
    assert sorted(r.doc_id for r in rows) == [0, 1, 2]
    for r in rows:
        assert r.n_dropped == 1
        assert [(w.word, w.bits) for w in r.keep] == [(200 // 64, ~(1 << 200 % 64))]


def test_a_line_in_every_document_meets_in_no_task(spark):
    """Hot keys are counted by partial aggregates, so no task reads a row for each document."""
    shared = "a line that every document of the corpus holds"
    docs = spark.range(3000).selectExpr("id as doc_id", f"concat('own line number ', id, ' of this text\\n{shared}') as text")
    got = without_repeated_lines(docs)
    assert got.where("n_dropped = 1").count() == 2999
    lines = line_dedup._hashed(line_dedup._documents(docs), 20)
    hot = line_dedup._hot(lines)
    assert lines.where(lines.h1.isin(hot)).groupBy("h1").count().agg({"count": "max"}).first()[0] == 3000


def test_plan_has_no_python(spark):
    plan = without_repeated_lines(table(spark, corpus(3)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
