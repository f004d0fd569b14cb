import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from georisk.llm import catalog, lm_score as lm
from georisk.llm.common import read_table, space_words

P = lm.Params(top=5, classes=3, hidden=4, batch=8)


def net_of(p, seed=0):
    rng = np.random.default_rng(seed)
    start = lm.Network.start(p, rng.integers(1, 9, p.size).astype(float))
    return start.filled(rng.normal(0, 0.5, start.flat().size))


def brute_log_prob(net, tokens, t):
    p, r = net.params, net.params.reach
    total = net.b.astype(float).copy()
    for k, o in enumerate(x for x in range(-r, r + 1) if x):
        total += net.e[k][tokens[t + o] if 0 <= t + o < len(tokens) else 0]
    h, own = np.append(np.tanh(total), 1.0), tokens[t]
    first = own // p.width * p.width
    inside, group = h @ net.u.astype(float)[:, first:first + p.width], h @ net.v.astype(float)
    return (group[own // p.width] - math.log(sum(math.exp(x) for x in group))
            + inside[own - first] - math.log(sum(math.exp(x) for x in inside)))


def test_log_probs_match_brute_force():
    net, rng = net_of(P), random.Random(1)
    texts = [np.array([rng.randint(1, P.size - 1) for _ in range(n)], np.int32) for n in (0, 1, 2, 7, 0, 30)]
    ids, at, text = lm.padded(texts, P.reach)
    got = lm.Network.log_probs(net, ids, at, step=4)
    want = [brute_log_prob(net, t.tolist(), k) for t in texts for k in range(len(t))]
    assert got == pytest.approx(want, abs=1e-4)
    assert text.tolist() == [i for i, t in enumerate(texts) for _ in t]
    net.u *= 200  # large outputs don't overflow
    assert np.isfinite(net.log_probs(ids, at)).all()


def test_training_follows_the_gradient():
    """The first Adagrad step moves every parameter against the sign of its finite difference."""
    net, rng = net_of(P), np.random.default_rng(2)
    ids, at, _ = lm.padded([rng.integers(1, P.size, 8).astype(np.int32)], P.reach)

    def loss(flat):
        x = net.filled(flat)
        return -np.mean([brute_log_prob(x, ids[2:-2].tolist(), k - 2) for k in at.tolist()])
    before = net.flat().astype(float)
    moved = net.filled(before)
    moved.train(ids, at, [np.zeros_like(x) + 1e-30 for x in moved.parts()])
    step = moved.flat() - before
    for k in range(0, len(before), 3):
        up, down = before.copy(), before.copy()
        up[k] += 1e-3
        down[k] -= 1e-3
        slope = (loss(up) - loss(down)) / 2e-3
        if abs(slope) > 1e-3:
            assert np.sign(step[k]) == -np.sign(slope)


def test_vocabulary_counts_every_document(spark):
    rows = [(1, "b a a B"), (2, None), (3, "c b \n d"), (4, "é A")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    p = lm.Params(top=2, classes=3)
    vocab, counts = lm.vocabulary(docs, p)
    assert vocab.number == {b"a": 1, b"b": 2}
    want = Counter(x for _, t in rows for x in vocab.ids(space_words(t, lower=True)).tolist())
    assert counts.tolist() == [want.get(i, 0) for i in range(p.size)]


def test_learns_from_both_sides(spark):
    """A word that its two neighbours determine: better than token frequencies, worse when they are swapped."""
    rng = random.Random(7)
    sure = {(a, b): rng.choice("uvwxyz") for a in "abc" for b in "def"}

    def text():
        out = []
        for _ in range(120):
            a, b = rng.choice("abc"), rng.choice("def")
            out += [a, sure[a, b], b]
        return " ".join(out)
    docs = spark.createDataFrame([(i, text()) for i in range(120)], "doc_id long, text string").repartition(3).cache()
    p = lm.Params(top=20, classes=4, hidden=16, mask_every=1, batch=64)
    vocab, net = lm.train(docs, p)
    ids, at, _ = lm.padded([vocab.ids(space_words(text()))], p.reach)
    _, counts = lm.vocabulary(docs, p)
    frequency = np.log(counts / counts.sum(), where=counts > 0, out=np.full(p.size, -50.0))[ids[at]].mean()
    assert net.log_probs(ids, at).mean() > frequency + 0.8
    mixed = ids.copy()
    mixed[at] = np.random.default_rng(0).permutation(ids[at])
    assert net.log_probs(mixed, at).mean() < net.log_probs(ids, at).mean() - 0.8
    again = lm.train(docs, p)[1]
    assert np.array_equal(again.flat(), net.flat())  # averages don't depend on task order


def test_query_scores_every_document(spark):
    sf = "/root/testdata/sf0.001"
    got = catalog.QUERIES["op10_lm_scoring"](spark, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in read_table(spark, sf, "documents").collect()}
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    assert all(r["n_tokens"] == len(space_words(texts[r["doc_id"]])) for r in got)
    assert all(r["log_likelihood"] < 0 for r in got if r["n_tokens"])
    per_token = sum(r["log_likelihood"] for r in got) / sum(r["n_tokens"] for r in got)
    assert per_token > math.log(1 / 256)  # better than a uniform guess


def test_edge_rows(spark):
    rows = [(1, None, 1), (2, "", 1), (None, "a b", 1), (4, "x " * 250_000, 1), (4, "one", None), (4, "one", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    vocab, net = lm.train(docs, P)
    got = lm.score(docs, vocab, net).collect()
    assert sorted(r["n_tokens"] for r in got) == [0, 0, 1, 1, 2, 250_000]
    for r in got:
        assert (r["n_tokens"] == 0) == (r["perplexity"] is None) and (r["n_tokens"] or r["log_likelihood"] == 0)
    empty = docs.limit(0)
    assert lm.score(empty, *lm.train(empty, P)).count() == 0


def test_every_word_has_its_own_likelihood(spark):
    """The class part from the network, and each rare word's counted share of its class."""
    rng = random.Random(4)
    rows = [(i % 30, " ".join(f"w{int(rng.paretovariate(0.5))}" for _ in range(rng.randint(0, 40)))) for i in range(50)]
    rows += [(50, "frequent w1 W1 garbage"), (51, None)] + [(None, "w1 rare")] * 2 + [(52, "rare " * 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    vocab, net = lm.train(docs, P)
    counts = Counter(w for _, t in rows for w in space_words(t, lower=True))
    assert {bytes(r["word"]): r["n"] for r in vocab.counts.collect()} == counts

    def want(doc_id, text):
        words = space_words(text, lower=True)
        ids, at, _ = lm.padded([vocab.ids(words)], P.reach)
        classes = sum(brute_log_prob(net, ids[2:-2].tolist(), k) for k in range(len(words)))
        shares = sum(math.log(counts[w] / vocab.totals[i]) for w, i in zip(words, ids[2:-2].tolist()))
        return doc_id, len(words), classes, classes + shares
    key = lambda r: (r[0] is None, r[0] or 0, r[1], round(r[3], 1))
    got = sorted(((r["doc_id"], r["n_tokens"], r["log_likelihood"], r["word_log_likelihood"])
                  for r in lm.score(docs, vocab, net).collect()), key=key)
    assert len(got) == len(rows)
    for g, w in zip(got, sorted((want(*r) for r in rows), key=key)):
        assert g[:2] == w[:2] and g[2:] == pytest.approx(w[2:], abs=2e-2)
    other = spark.createDataFrame([(1, "never seen zz"), (2, "never w1 zz")], "doc_id long, text string")
    unseen = lm.score(other, vocab, net).collect()
    assert all(math.isfinite(r["mean_log_likelihood"]) for r in unseen)


def test_outputs_follow_the_vocabulary(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "concat('w', id, ' common') AS text")
    vocab, counts = lm.vocabulary(docs, P)
    assert (vocab.p.top, vocab.p.classes) == (23, 15) and len(vocab.number) == 23 and len(counts) == 39
    assert counts.sum() == 8000
    assert lm.Params().grown(10 ** 9).size > 2 * lm.Params().grown(10 ** 8).size > 2 * lm.Params().size


def test_production_parameters_learn_from_every_token(spark):
    """Far better than token frequencies, which the start network already gives, on few documents."""
    rng = random.Random(9)
    text = lambda: " ".join(f"{a} {a}{b} {b}" for a, b in ((rng.choice("abc"), rng.choice("def")) for _ in range(60)))
    docs = spark.createDataFrame([(i, text()) for i in range(60)], "doc_id long, text string").coalesce(1).cache()
    vocab, net = lm.train(docs)
    _, counts = lm.vocabulary(docs, lm.Params())
    texts = [vocab.ids(space_words(r["text"])) for r in docs.collect()]
    ids, at, _ = lm.padded(texts, vocab.p.reach)
    frequency = np.log(counts / counts.sum(), where=counts > 0, out=np.full(len(counts), -50.0))[ids[at]].mean()
    gain = net.log_probs(ids, at).mean() - frequency
    assert gain > 0.6  # with one token in four as a target: 0.15


def test_probabilities_of_all_outputs_add_up_to_one():
    for p in (P, lm.Params(top=20, classes=9, hidden=3), lm.Params(top=1, classes=1)):
        net = net_of(p)
        assert (p.groups - 1) * p.width < p.size <= p.groups * p.width
        around = np.random.default_rng(5).integers(1, p.size, 5).astype(np.int32)
        texts = [np.concatenate([around[:2], [k], around[3:]]).astype(np.int32) for k in range(p.size)]
        ids, at, _ = lm.padded(texts, p.reach)
        assert np.exp(net.log_probs(ids, at[2::5])).sum() == pytest.approx(1, abs=1e-5)


def test_counts_held_by_tasks_and_joined_ones_give_the_same_scores(spark):
    rng = random.Random(4)
    words = ["a", "b", "c", "dd", "eé", "f" * 65, "f" * 64] + [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 30)))) for i in range(60)] + [(5, "a w1 w1"), (5, "a w1 w1"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    vocab, net = lm.train(docs, P)
    n = {bytes(r["word"]): r["n"] for r in vocab.counts.collect()}
    assert set(vocab.held) == {w for w in n if len(w) <= 64}  # in a table this small each word is a token in 2^18
    key = lambda rows: sorted(map(tuple, rows), key=str)
    held = key(lm.score(docs, vocab, net).collect())
    vocab.held = {w: x for w, x in vocab.held.items() if n[w] > 25}
    assert key(lm.score(docs, vocab, net).collect()) == held
    vocab.held = {}
    assert key(lm.score(docs, vocab, net).collect()) == held
    few = lm.vocabulary(docs, lm.Params(top=5, classes=3, held=40))[0].held
    assert few and all(n[w] * 40 >= sum(n.values()) for w in few) and len(few) <= 40


def test_words_of_pieces_are_those_of_space_words(monkeypatch):
    rng = random.Random(6)
    marks = [" ", "  ", *"\t\n\x0b\x0c\r\x00\x1c\x1f\x7f\x85\xa0", "a", "Bc", "É", "𝔘x"]
    texts = ["".join(rng.choices(marks, k=rng.randint(0, 12))) for _ in range(300)] + [None, "", " ", "A " * 200]
    for size in (1, 50, 1 << 20):
        monkeypatch.setattr(lm, "PIECE", size)
        got, first = [], []
        for start, words, sizes in lm.pieces(pa.array([None, "cut", *texts])[2:]):
            ends = [0, *sizes.cumsum().tolist()]
            assert start == len(got) and ends[-1] == len(words)
            got += [words[a:z].to_pylist() for a, z in zip(ends, ends[1:])]
            first.append(start)
        assert got == [space_words(t, lower=True) for t in texts]
        assert (len(first) == 1) == (size == 1 << 20)
    assert not [*lm.pieces(pa.array([], pa.string()))]


def test_class_is_computed_for_unknown_words_alone():
    """Words that the tasks hold have their number beside them and cost no call per token."""
    vocab = lm.Vocabulary([b"a", b"b"], P, np.ones(P.size), None, {b"a": 7, b"held": 9})
    known, hashed = vocab.known(), []
    classes, known.classes = known.classes, lambda words: hashed.extend(words.to_pylist()) or classes(words)
    words = [b"held", b"rare", b"a", b"held", b"b", b"", b"rare"]
    ids, place, others = known.ids(pa.array(words, pa.binary()))
    assert hashed == [b"rare", b"", b"rare"] and others.tolist() == [1, 5, 6]
    assert ids.tolist() == vocab.ids(words).tolist() == [
        {b"a": 1, b"b": 2}.get(w) or 1 + P.top + zlib.crc32(w) % P.classes for w in words]
    assert known.logs[place].tolist() == [9, 0, 0, 9, 0, 0, 0]  # frequent words have their number to themselves
    none = lm.Vocabulary([], P, np.ones(P.size), None, {}).known()
    assert none.ids(pa.array([b"a"], pa.binary()))[0].tolist() == [1 + P.top + zlib.crc32(b"a") % P.classes]


def test_steps_sorted_ahead_are_the_steps_of_one_batch_after_the_other():
    """Many steps, the last one short and a run of steps cut: one call per batch moves the parameters alike."""
    p = lm.Params(top=14, classes=6, hidden=3, batch=8)
    net, rng = net_of(p), np.random.default_rng(8)
    ids, at, _ = lm.padded([rng.integers(1, p.size, n).astype(np.int32) for n in (700, 0, 503)], p.reach)
    at = rng.permutation(at)
    assert len(at) > 2 * lm.AHEAD * p.batch and len(at) % p.batch and p.size % p.width
    order, ends, own_group, own = net.steps(ids[at[:p.batch * 3 + 5]])
    assert [e[-1] for e in ends] == [8, 8, 8, 5] and sorted(order.tolist()) == list(range(29))
    assert (own_group // p.groups).tolist() == [*range(8)] * 3 + [*range(5)]
    nets, sums = [net.filled(net.flat()) for _ in range(2)], [[np.full_like(x, 1e-2) for x in net.parts()] for _ in range(2)]
    nets[0].train(ids, at, sums[0])
    for s in range(0, len(at), p.batch):
        nets[1].train(ids, at[s:s + p.batch], sums[1])
    assert np.array_equal(nets[0].flat(), nets[1].flat()) and not np.array_equal(nets[0].flat(), net.flat())
    assert all(np.array_equal(a, b) for a, b in zip(*sums))
