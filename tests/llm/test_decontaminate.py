import random

import numpy as np

from reelscope.llm import decontaminate
from reelscope.llm.decontaminate import contaminated_pairs, without_contaminated
from tests.llm.cases import EDGE_TEXTS, LONG, edge_docs, shingle_set, table

ITEMS = "item_id bigint, text string"


def brute(docs, items):
    out = []
    for d, text in docs:
        own = shingle_set(text)
        for i, item in items:
            s = shingle_set(item)
            if s and 100 * len(s & own) >= 80 * len(s):
                out.append((d, i, len(s), len(s & own)))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def planted(seed):
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(4000)]
    items = [(i, " ".join(rng.choices(pool, k=rng.choice([3, 5, 9, 20, 57, 130])))) for i in range(40)]
    docs = []
    for d in range(120):
        text = rng.choices(pool, k=rng.choice([0, 40, 400, 5000]))
        for _, item in rng.sample(items, rng.randrange(3)):
            w = item.split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                w[rng.randrange(len(w))] = "changed"
            at = rng.randrange(len(text) + 1)
            text[at:at] = [x.upper() for x in w] if rng.random() < 0.3 else w
        docs.append((d, " ".join(text)))
    return docs, items


def test_planted_items_against_brute_force(spark):
    docs, items = planted(2)
    want = brute(docs, items)
    assert len(want) > 30
    assert result(contaminated_pairs(table(spark, docs), table(spark, items, ITEMS))) == want


def test_blocks_give_the_same_pairs(spark, monkeypatch):
    docs, items = planted(3)
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 2000)
    assert result(contaminated_pairs(table(spark, docs), table(spark, items, ITEMS))) == brute(docs, items)


def test_item_anywhere_in_a_long_document(spark):
    item = " ".join(f"q{i}" for i in range(40))
    w = LONG.split()
    docs = [(at, " ".join(w[:at] + item.split() + w[at:])) for at in (0, 1, 31, 32, 33, 15_000, 29_999, 30_000)]
    got = result(contaminated_pairs(table(spark, docs), table(spark, [(1, item)], ITEMS)))
    assert got == [(at, 1, 36, 36) for at in sorted((d for d, _ in docs), key=lambda d: repr((d, 1, 36, 36)))]


def test_edge_rows_and_whole_rows_kept(spark):
    items = [(1, None), (2, ""), (3, "ONE"), (4, "a b c d e"), (4, "a b c d e"), (None, "a b c d"), (6, "not there at all here")]
    docs, bench = edge_docs(spark), table(spark, items, ITEMS)
    assert result(contaminated_pairs(docs, bench)) == brute(EDGE_TEXTS, items)
    clean = without_contaminated(docs, bench)
    assert clean.schema == docs.schema
    assert sorted((r.doc_id for r in clean.collect()), key=repr) == sorted([1, 2, 3, 8, 9, 10, 10, 11, None], key=repr)
    none = table(spark, [], ITEMS)
    assert contaminated_pairs(docs, none).collect() == []
    assert without_contaminated(docs, none).count() == docs.count()
    assert contaminated_pairs(edge_docs(spark, empty=True), bench).collect() == []


def test_minhash_estimates_the_overlap():
    a = np.arange(1000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    same = [(decontaminate._minhash(a[k : k + 100]) == decontaminate._minhash(a[k + 50 : k + 150])).mean() for k in range(0, 800, 100)]
    assert abs(np.mean(same) - 1 / 3) < 0.1


def test_a_repeated_item_is_indexed_once(spark):
    text = " ".join(f"q{i}" for i in range(30))
    items = table(spark, [(7, text)], ITEMS).selectExpr("item_id", "text", "explode(sequence(1, 5000)) as row").drop("row")
    (index,) = decontaminate.indexes(items)
    assert (len(index.sets), index.times) == (1, [5000])
    got = contaminated_pairs(table(spark, [(1, f"a {text} b"), (2, "c")]), items)
    assert got.groupBy("doc_id", "item_id", "n_item_shingles", "n_shared").count().collect() == [(1, 7, 26, 26, 5000)]
