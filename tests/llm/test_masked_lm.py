import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from reelscope.llm import masked_lm as lm
from reelscope.llm.staging import Staging
from tests.llm.cases import EDGE_TEXTS, edge_docs, table, words


def corpus(n=300, seed=1):
    """A language with strong neighbours: each word nearly fixes the next."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        at, out = rng.randrange(40), []
        for _ in range(60):
            out.append(f"w{at}")
            at = (at * 7 + 3) % 40 if rng.random() < 0.9 else rng.randrange(40)
        rows.append((i, " ".join(out)))
    return rows


def test_vocabulary_counts_the_whole_corpus(spark):
    rows = corpus(40) + [(90, None), (91, "rare1 rare2 rare2")]
    vocabulary, counts = lm.corpus_vocabulary(table(spark, rows), Staging(spark, "test"))
    flat = [w for _, t in rows for w in words(t)]
    assert counts.sum() == len(flat)
    ids = vocabulary.encode(pa.array([t for _, t in rows], pa.string())).ids
    assert (np.bincount(ids, minlength=lm.SIZE) == counts).all()
    assert len(set(ids.tolist())) == len(set(flat))


def test_words_beyond_the_frequent_share_ids(spark, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 64)
    monkeypatch.setattr(lm, "SIZE", 64 + lm.SHARED)
    rows = [(1, " ".join(f"x{i}" for i in range(500)))]
    vocabulary, counts = lm.corpus_vocabulary(table(spark, rows), Staging(spark, "test"))
    ids = vocabulary.encode(pa.array([rows[0][1]])).ids
    assert (np.bincount(ids, minlength=lm.SIZE) == counts).all() and (counts[:64] == 1).all()


def test_context_is_both_sides():
    vocabulary = lm.Vocabulary(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    text = vocabulary.encode(pa.array(["a b c", None, "d"]))
    first, context = text.first, text.context()
    a, b, c, d = text.ids
    left, right = lm.LEFT_EDGE, lm.RIGHT_EDGE
    assert first.tolist() == [0, 3, 3, 4]
    assert context.tolist() == [[left, left, b, c], [left, a, c, right], [a, b, right, right], [left, left, right, right]]


def test_probabilities_add_up_and_match_by_hand():
    rng = np.random.default_rng(0)
    net = lm.Network.start(rng.integers(0, 50, lm.SIZE).astype(float))
    net.block[:] = rng.normal(0, 0.3, net.block.shape)
    net.word[:] = rng.normal(0, 0.3, net.word.shape)
    context = np.array([[1, 2, 3, 4]])
    every = np.array([[1, 2, i, 3, 4] for i in range(lm.SIZE)], dtype=np.int32).ravel()
    everything = net.log_probabilities(lm.Encoded(every, np.arange(2, len(every), 5), np.array([0, lm.SIZE])))
    assert abs(np.exp(everything).sum() - 1) < 1e-4
    h = np.tanh(sum(net.embed[context[0, k]] * net.position[k] for k in range(4)))
    z = net.block @ h + net.block_bias
    block = 777 // lm.BLOCK
    y = net.word[block * lm.BLOCK : (block + 1) * lm.BLOCK] @ h + net.word_bias[block * lm.BLOCK : (block + 1) * lm.BLOCK]
    want = z[block] - np.log(np.exp(z).sum()) + y[777 % lm.BLOCK] - np.log(np.exp(y).sum())
    assert abs(everything[777] - want) < 1e-4


def test_gradient_step_lowers_the_loss():
    rng = np.random.default_rng(1)
    net = lm.Network.start(np.ones(lm.SIZE))
    padded = rng.integers(0, 30, 5 * 256).astype(np.int32)
    text = lm.Encoded(padded, np.arange(2, len(padded), 5), np.array([0, 256]))
    before = net.log_probabilities(text).mean()
    for _ in range(30):
        net.train(text.context(), text.ids)
    assert net.log_probabilities(text).mean() > before + 0.5


def test_gradients_equal_differences_of_the_loss():
    rng = np.random.default_rng(2)
    size = 3 * lm.BLOCK
    net = lm.Network(rng.normal(0, 0.3, lm.Network.length(size)), size)  # float64
    context, target = rng.integers(0, size + 2, (40, 4)), rng.integers(0, size, 40)
    target[:5] = target[0]  # a word and a block more than once
    padded = np.c_[context[:, :2], target, context[:, 2:]].ravel()
    text = lm.Encoded(padded, np.arange(2, len(padded), 5), np.array([0, 40]))

    def loss():
        return -net.log_probabilities(text).sum()

    found = {}
    for name, rows, weights, biases in net.gradients(context, target):
        for part, gradient in ((name, weights), (name + "_bias", biases)):
            if gradient is not None:
                found[part] = np.zeros(getattr(net, part).shape)
                found[part][rows] = gradient
    assert set(found) == {"embed", "position", "block", "block_bias", "word", "word_bias"}
    for part, gradient in found.items():
        values, gradient = getattr(net, part).reshape(-1), gradient.reshape(-1)
        largest = np.argsort(-np.abs(gradient))[:4]
        for i in [*largest, *rng.integers(0, len(values), 12)]:
            at, step = values[i], 1e-5
            values[i] = at + step
            above = loss()
            values[i] = at - step
            below = loss()
            values[i] = at
            assert abs((above - below) / (2 * step) - gradient[i]) < 1e-4, (part, i)


def test_own_ids_are_dealt_to_blocks_of_about_equal_mass():
    counts = [10_000 // (i + 1) for i in range(4 * lm.BLOCK)]
    ids = lm.dealt(counts, 4)
    assert sorted(ids.tolist()) == list(range(4 * lm.BLOCK))
    mass = np.bincount(ids // lm.BLOCK, weights=counts)
    assert mass.max() - mass.min() < 0.2 * mass.max()
    assert lm.dealt([], 4).tolist() == [] and lm.dealt([7, 7], 4).tolist() == [0, lm.BLOCK]


def test_encoded_rows_read_back(spark):
    rows = [(3, "a b rare a"), (1, None), (3, "a b rare a"), (2, ""), (None, "zz"), (4, " \n")]
    vocabulary, _ = lm.corpus_vocabulary(table(spark, rows), Staging(spark, "test"))
    got = lm.encoded_documents(table(spark, rows), vocabulary, Staging(spark, "test")).collect()
    assert len({r.row for r in got}) == len(rows)
    want = [(i, vocabulary.encode(pa.array([t], pa.string())).ids.tolist()) for i, t in rows]
    assert sorted(((r.doc_id, np.frombuffer(r.ids, np.int32).tolist()) for r in got), key=repr) == sorted(want, key=repr)


def test_training_beats_the_unigram_model_and_orders_texts(spark):
    rows = corpus()
    rng = random.Random(7)
    shuffled = [(1000 + i, " ".join(rng.sample(t.split(), 60))) for i, t in rows[:60]]
    docs = table(spark, rows)
    vocabulary, counts = lm.corpus_vocabulary(docs, Staging(spark, "test"))
    start = lm.Network.start(counts)
    net = lm.train_network(docs, vocabulary, counts, epochs=4, stride=1)
    unseen = vocabulary.encode(pa.array([t for _, t in corpus(50, seed=2)]))
    assert net.log_probabilities(unseen).mean() > start.log_probabilities(unseen).mean() + 0.2
    mixed = vocabulary.encode(pa.array([t for _, t in shuffled]))
    assert net.log_probabilities(mixed).mean() < net.log_probabilities(unseen).mean()


def test_every_word_is_a_target_once():
    vocabulary = lm.Vocabulary(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    text = vocabulary.encode(pa.array([" ".join(f"w{i}" for i in range(n)) for n in (0, 1, 2, 15, 16, 17, 40)]))
    seen = np.concatenate([lm.targets(text, epoch) for epoch in range(lm.EPOCHS)])
    assert sorted(seen.tolist()) == list(range(len(text.place)))


def test_registered_training_beats_the_unigram_model_on_held_out_text(spark):
    docs = table(spark, corpus(1500))
    vocabulary, counts = lm.corpus_vocabulary(docs, Staging(spark, "test"))
    net = lm.train_network(docs, vocabulary, counts)
    unseen = vocabulary.encode(pa.array([t for _, t in corpus(50, seed=2)]))
    gain = net.log_probabilities(unseen).mean() - lm.Network.start(counts).log_probabilities(unseen).mean()
    assert gain > 2.5, gain  # 1.5 when only one word in eight was a target


def test_scores_are_sums_over_the_words(spark):
    rows = corpus(50)
    docs = table(spark, rows)
    vocabulary, counts = lm.corpus_vocabulary(docs, Staging(spark, "test"))
    net = lm.train_network(docs, vocabulary, counts)
    for r in lm.score_documents(docs).collect():
        text = vocabulary.encode(pa.array([dict(rows)[r.doc_id]]))
        assert abs(net.log_probabilities(text).sum() - r.log_likelihood) < 1e-3
        assert abs(r.mean_log_likelihood - r.log_likelihood / 60) < 1e-9


def test_words_of_a_shared_id_have_their_own_probabilities(spark, monkeypatch):
    monkeypatch.setattr(lm, "own_ids", lambda distinct: 0)  # on the driver; the tasks take it from the vocabulary
    rng = random.Random(3)
    texts = [" ".join(f"x{int(3000 * rng.random() ** 3)}" for _ in range(40)) for _ in range(200)]
    rows = [(i, t) for i, t in enumerate([*texts, *texts[:5], "x1", "x2999 x2999"])]
    counts = Counter(w for _, t in rows for w in words(t))
    docs = table(spark, rows)
    vocabulary, of_id = lm.corpus_vocabulary(docs, Staging(spark, "test"))
    net = lm.train_network(docs, vocabulary, of_id)
    got = {r.doc_id: r for r in lm.score_documents(docs).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        text = vocabulary.encode(pa.array([t]))
        share = [np.log(counts[w] / of_id[k]) for w, k in zip(words(t), text.ids.tolist())]
        assert abs(net.log_probabilities(text).sum() + sum(share) - got[i].log_likelihood) < 1e-2


@pytest.mark.parametrize("known", [0, 40, 10_000])
def test_scores_do_not_depend_on_the_counts_that_travel(spark, monkeypatch, known):
    monkeypatch.setattr(lm, "own_ids", lambda distinct: lm.BLOCK)
    monkeypatch.setattr(lm, "KNOWN", lm.BLOCK + known)
    texts = ["a b c", None, "once", "", *(" ".join(f"x{(i * k) % 300}" for k in range(50)) for i in range(1, 60))]
    docs = table(spark, list(enumerate(texts)))
    counts = Counter(w for t in texts for w in words(t))
    vocabulary, of_id = lm.corpus_vocabulary(docs, Staging(spark, "test"))
    assert len(vocabulary.known) == min(known, len(counts) - lm.BLOCK) and (np.diff(vocabulary.known.astype(float)) > 0).all()
    net = lm.train_network(docs, vocabulary, of_id)
    got = {r.doc_id: r for r in lm.score_documents(docs).collect()}
    held = {r.doc_id: len(r.shared) // 8 for r in lm.encoded_documents(docs, vocabulary, Staging(spark, "test")).collect()}
    known_words = set(vocabulary.known.tolist())
    for i, t in enumerate(texts):
        w = lm.words(pa.array([t], pa.string()))
        text = vocabulary.encode(pa.array([t], pa.string()))
        assert held[i] == sum(k >= lm.BLOCK and h not in known_words for k, h in zip(text.ids.tolist(), w.hashes.tolist()))
        share = [np.log(counts[x] / of_id[k]) for x, k in zip(words(t), text.ids.tolist())]
        assert abs(net.log_probabilities(text).sum() + sum(share) - got[i].log_likelihood) < 1e-2


def test_embedding_gradients_sum_every_place_of_an_id():
    rng = np.random.default_rng(4)
    net = lm.Network(rng.normal(0, 0.3, lm.Network.length(2 * lm.BLOCK)).astype(np.float32), 2 * lm.BLOCK)
    context, back = rng.integers(0, 9, (4, 200)), rng.normal(size=(200, lm.WIDTH)).astype(np.float32)
    ids, sums = net._sums_by_id(context, back)
    want = np.zeros((9, lm.WIDTH))
    for k in range(4):
        np.add.at(want, context[k], back * net.position[k].astype(float))
    assert ids.tolist() == sorted(set(context.ravel().tolist())) and abs(sums - want[ids]).max() < 1e-4


def test_steps_of_other_sizes_share_no_memory():
    rng = np.random.default_rng(5)
    start = lm.Network.start(np.ones(lm.SIZE)).flat
    batches = [(rng.integers(0, 90, (n, 4)), rng.integers(0, 90, n)) for n in (300, 40, 500, 1)]
    net = lm.Network(start.copy(), lm.SIZE)
    for context, target in batches:
        net.train(context, target)
    fresh = lm.Network(start.copy(), lm.SIZE)
    for context, target in batches:
        fresh.held.clear()
        fresh.train(context, target)
    assert (net.flat == fresh.flat).all()


def test_own_ids_grow_with_the_distinct_words(spark):
    rows = [(i, " ".join(f"y{i * 100 + k}" for k in range(100))) for i in range(60)]
    vocabulary, counts = lm.corpus_vocabulary(table(spark, rows), Staging(spark, "test"))
    assert len(vocabulary.ids) == lm.own_ids(6000) > lm.FREQUENT and len(counts) == lm.own_ids(6000) + lm.SHARED
    assert counts.sum() == 6000 and lm.own_ids(10**8) > 5 * lm.FREQUENT


def test_edge_rows(spark):
    got = lm.score_documents(edge_docs(spark)).collect()
    assert sorted(((r.doc_id, r.n_words) for r in got), key=repr) == sorted(((i, len(words(t))) for i, t in EDGE_TEXTS), key=repr)
    for r in got:
        assert (r.log_likelihood == 0.0 and r.mean_log_likelihood is None) if not r.n_words else r.log_likelihood < 0
    repeated = [r.log_likelihood for r in got if r.doc_id == 10]
    assert abs(repeated[0] - repeated[1]) < 1e-6
    assert lm.score_documents(edge_docs(spark, empty=True)).collect() == []


def test_words_of_a_task_are_counted_once():
    batches = [pa.RecordBatch.from_pydict({"text": [f"a b c{i % 2}", None, "a"]}) for i in range(20)]
    got = [(w, n) for b in lm._counted(iter(batches)) for w, n in zip(b["word"].to_pylist(), b["n"].to_pylist())]
    hashes = lm.words(pa.array(["a b c0 c1"])).hashes.view(np.int64).tolist()
    assert sorted(got) == sorted(zip(hashes, [40, 20, 10, 10]))
    assert sum(b.num_rows for b in lm._counted(iter([pa.RecordBatch.from_pydict({"text": pa.array(["", None])})]))) == 0


def test_counts_travel_in_bounded_parts(monkeypatch):
    monkeypatch.setattr(lm, "COUNTED", 50)
    texts = [" ".join(f"v{i * 7 % 130} v{k}" for k in range(30)) for i in range(40)]
    parts = list(lm._counted(iter([pa.RecordBatch.from_pydict({"text": [t]}) for t in texts])))
    total = Counter()
    for b in parts:
        total.update(dict(zip(b["word"].to_pylist(), b["n"].to_pylist())))
    want = Counter(h for t in texts for h in lm.words(pa.array([t])).hashes.view(np.int64).tolist())
    assert len(parts) > 1 and total == want


def test_shared_words_travel_in_a_piece_for_each_bucket():
    hashes = lm.words(pa.array([" ".join(f"s{i}" for i in range(900))])).hashes
    first = np.array([0, 400, 400, 900])
    batch = pa.RecordBatch.from_arrays([pa.array([5, 6, 7]), lm._bytes(hashes, first)], names=["row", "shared"])
    (pieces,) = lm._sharing(4)(iter([batch]))
    assert pieces["bucket"].to_pylist() == [0, 1, 2, 3]
    pairs = zip(lm._ids(pieces["rows"], np.int64)[0].tolist(), lm._ids(pieces["words"], np.uint64)[0].tolist())
    assert sorted(pairs) == sorted(zip([5] * 400 + [7] * 500, hashes.tolist()))


@pytest.mark.parametrize("bucket", [3, 10_000])
def test_sums_of_shared_words_by_row(spark, monkeypatch, bucket):
    monkeypatch.setattr(lm, "BUCKET", bucket)
    monkeypatch.setattr(lm, "own_ids", lambda distinct: 0)
    monkeypatch.setattr(lm, "KNOWN", 0)
    texts = ["a b a", None, "once", "a b a", " ".join(f"x{i % 40}" for i in range(100)), "x3 x3 a other"]
    docs, stage = table(spark, list(enumerate(texts))), Staging(spark, "test")
    counts = Counter(w for t in texts for w in words(t))
    words_of = lm.word_counts(docs, stage)
    encoded = lm.encoded_documents(docs, lm.vocabulary_of(words_of)[0], stage)
    sums = {r.row: r.log_counts for r in lm.shared_words(encoded, words_of, stage).collect()}
    for r in encoded.select("row", "doc_id").collect():
        want = sum(np.log(counts[w]) for w in words(texts[r.doc_id]))
        assert abs(sums.get(r.row, 0.0) - want) < 1e-9


def test_lookup_finds_crowded_keys():
    rng = np.random.default_rng(6)
    near = np.arange(50, dtype=np.uint64) + np.uint64(1 << 63)
    keys = np.unique(np.r_[rng.integers(0, 2**64, 700, dtype=np.uint64), near, np.array([0, 2**64 - 1], np.uint64)])
    hashes = np.r_[keys[::-1], keys + np.uint64(1), rng.integers(0, 2**64, 500, dtype=np.uint64)]
    at, found = lm.Lookup(keys)(hashes)
    assert (found == np.isin(hashes, keys)).all() and (keys[at[found]] == hashes[found]).all()
    assert not lm.Lookup(keys[:0])(hashes)[1].any() and lm.Lookup(keys[:1])(keys[:2])[1].tolist() == [True, False]


@pytest.mark.parametrize("weights, biases", [(0.3, 1), (40, 1), (0.3, 60), (30, 60)])
def test_far_apart_logits_stay_exact(weights, biases):
    rng = np.random.default_rng(8)
    size = 3 * lm.BLOCK
    net = lm.Network(rng.normal(0, 0.3, lm.Network.length(size)).astype(np.float32), size)
    net.block *= weights
    net.word *= weights
    net.block_bias[:] = rng.normal(0, biases, len(net.block_bias))
    net.word_bias[:] = rng.normal(0, biases, size)
    exact = lm.Network(net.flat.astype(float), size)
    context, target = rng.integers(0, size, (60, 4)), rng.integers(0, size, 60)
    text = lm.Encoded(np.c_[context[:, :2], target, context[:, 2:]].ravel(), np.arange(2, 300, 5), np.array([0, 60]))
    h = np.tanh((exact.embed[context] * exact.position).sum(1))
    z, y = h @ exact.block.T + exact.block_bias, h @ exact.word.T + exact.word_bias
    y = np.where(np.arange(size) // lm.BLOCK == target[:, None] // lm.BLOCK, y, -np.inf)
    of_z, of_y = (np.exp(x - x.max(1, keepdims=True)) for x in (z, y))
    of_z, of_y = of_z / of_z.sum(1, keepdims=True), of_y / of_y.sum(1, keepdims=True)
    rows = np.arange(60)
    z, y = z - z.max(1, keepdims=True), y - y.max(1, keepdims=True)
    want = z[rows, target // lm.BLOCK] - np.log(np.exp(z).sum(1)) + y[rows, target] - np.log(np.exp(y).sum(1))
    assert np.allclose(net.log_probabilities(text), want, rtol=1e-4, atol=1e-3)
    of_z[rows, target // lm.BLOCK] -= 1
    of_y[rows, target] -= 1
    found = {name: (ids, w, b) for name, ids, w, b in net.gradients(context, target)}
    assert np.allclose(found["block"][1], of_z.T @ h, atol=1e-3) and np.allclose(found["block"][2], of_z.sum(0), atol=1e-3)
    ids = np.arange(size)[found["word"][0]]
    assert np.allclose(found["word"][1], (of_y.T @ h)[ids], atol=1e-3) and np.allclose(found["word"][2], of_y.sum(0)[ids], atol=1e-3)
