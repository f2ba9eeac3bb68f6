import zlib

import numpy as np
import pyarrow as pa

from reelscope.llm import quality_model as q
from tests.llm.cases import EDGE_TEXTS, LONG, edge_docs, table

LABELS = "doc_id bigint, quality int, toxic int"


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    pos = label == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_held_out_accuracy_on_given_tables(spark, sf001_dir):
    docs = spark.read.parquet(f"{sf001_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf001_dir}/labels.parquet")
    scored = q.score_quality(docs, q.fit_quality(docs, labels)).collect()
    assert len(scored) == docs.count()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    for r in scored:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    out = [(r.score, truth[r.doc_id], r.predicted) for r in scored if r.held_out and r.doc_id in truth]
    score, label, predicted = (np.array(x) for x in zip(*out))
    assert auc(score, label) > 0.97
    assert (predicted == label).mean() > 0.95


def test_only_rows_that_are_not_held_out_are_learnt(spark):
    docs = table(spark, [(i, "bad ### text" if i % 2 else "good plain text") for i in range(400)])
    kept = [(i, 1 - i % 2, 0) for i in range(400) if zlib.crc32(str(i).encode()) % 5]
    lies = [(i, i % 2, 0) for i in range(400) if not zlib.crc32(str(i).encode()) % 5]
    a = q.fit_quality(docs, table(spark, kept, LABELS))
    b = q.fit_quality(docs, table(spark, kept + lies + [(None, 0, 0), (3, None, 0), (9999, 0, 0)], LABELS))
    assert (a.value == b.value).all() and (a.feature == b.feature).all()


def test_trees_against_row_by_row_traversal():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, len(q.FEATURES)))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    trees = q.fit(x, y, trees=20)
    fast = trees.scores(x)
    for row in range(0, 600, 37):
        margin = trees.base
        for f, t, v in zip(trees.feature, trees.threshold, trees.value):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if x[row, f[node]] > t[node] else 1)
            margin += v[node - len(f)]
        assert abs(fast[row] - 1 / (1 + np.exp(-margin))) < 1e-12
    assert ((fast > 0.5) == (y == 1)).mean() > 0.97


def test_no_labels_and_one_class():
    x = np.zeros((4, len(q.FEATURES)))
    assert q.fit(x[:0], np.zeros(0)).scores(x).tolist() == [0.5] * 4
    assert np.allclose(q.fit(x, np.ones(4)).scores(x), 5 / 6)


def test_edge_rows(spark):
    labels = table(spark, [(7, 1, 0), (9, 0, 0), (8, 1, 1)], LABELS)
    model = q.fit_quality(edge_docs(spark), labels)
    got = q.score_quality(edge_docs(spark), model).collect()
    assert sorted((r.doc_id for r in got), key=repr) == sorted((i for i, _ in EDGE_TEXTS), key=repr)
    assert all(0 <= r.score <= 1 for r in got) and not any(r.held_out for r in got if r.doc_id is None)
    assert len({r.score for r in got if r.doc_id in (2, 3)}) <= 2
    empty = q.fit_quality(edge_docs(spark, empty=True), table(spark, [], LABELS))
    assert {r.score for r in q.score_quality(edge_docs(spark), empty).collect()} == {0.5}
    assert q.score_quality(edge_docs(spark, empty=True), empty).collect() == []


def test_statistics_cover_the_whole_text():
    a, b = q.statistics(pa.array([LONG, LONG + " ###" * 20_000]))
    assert b[q.FEATURES.index("symbol_share")] > a[q.FEATURES.index("symbol_share")]


def test_statistics_by_hand():
    row = dict(zip(q.FEATURES, q.statistics(pa.array(["AB cd cd! #\ncd"]))[0]))
    assert row["log_words"] == np.log1p(5)
    assert np.isclose(row["mean_word"], 10 / 5)
    assert np.isclose(row["upper_share"], 2 / 14) and np.isclose(row["symbol_share"], 1 / 14)
    assert np.isclose(row["distinct_share"], 4 / 5) and np.isclose(row["top_word_share"], 2 / 5)
    assert np.isclose(row["shouted_share"], 1 / 5) and np.isclose(row["marked_share"], 1 / 5)
    assert row["words_per_line"] == 2.5


def test_every_split_is_the_best_of_all_cuts_and_every_leaf_its_step():
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.normal(size=120), rng.integers(0, 5, 120), rng.normal(size=120)]).astype(float)
    y = ((x[:, 0] * (x[:, 1] - 2) + 0.5 * x[:, 2] + rng.normal(0, 0.3, 120)) > 0).astype(float)
    cuts = [(f, float(np.quantile(c, k / q.BINS))) for f, c in enumerate(x.T) for k in range(1, q.BINS)]
    model = q.fit(x, y, trees=4)
    share = (y.sum() + 1) / (len(y) + 2)
    margin = [float(np.log(share / (1 - share)))] * len(y)
    splits = 0
    for feature, threshold, value in zip(model.feature, model.threshold, model.value):
        p = [1 / (1 + np.exp(-m)) for m in margin]

        def sums(rows):
            return sum(p[i] - y[i] for i in rows), sum(p[i] * (1 - p[i]) for i in rows)

        def gain(rows, f, cut):
            (g, h), (gl, hl) = sums(rows), sums([i for i in rows if x[i, f] <= cut])
            if min(hl, h - hl) < q.LEAST_HESSIAN:
                return 0.0
            return gl**2 / (hl + q.L2) + (g - gl) ** 2 / (h - hl + q.L2) - g**2 / (h + q.L2)

        nodes = {0: list(range(len(y)))}
        for node in range(2**q.DEPTH - 1):
            rows = nodes[node]
            best = max(gain(rows, f, cut) for f, cut in cuts)
            f, cut = int(feature[node]), float(threshold[node])
            if np.isfinite(cut):
                splits += 1
                assert (f, cut) in cuts and abs(gain(rows, f, cut) - best) < 1e-9
            else:
                assert best < 1e-8
            nodes[2 * node + 1] = [i for i in rows if x[i, f] <= cut]
            nodes[2 * node + 2] = [i for i in rows if x[i, f] > cut]
        for leaf in range(2**q.DEPTH):
            rows = nodes[2**q.DEPTH - 1 + leaf]
            g, h = sums(rows)
            assert abs(value[leaf] + q.RATE * g / (h + q.L2)) < 1e-9
            for i in rows:
                margin[i] += value[leaf]
    assert splits > 12
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(-np.array(margin))))
