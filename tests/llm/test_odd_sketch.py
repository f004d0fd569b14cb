import random

import numpy as np
import pytest

from georisk.llm import odd_sketch
from georisk.llm.odd_sketch import Params, Sampler


def brute_set(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return frozenset()
    if len(words) < 3:
        return frozenset([" ".join(words)])
    return frozenset(" ".join(words[i:i + 3]) for i in range(len(words) - 2))


def brute(rows):
    """{position: (set size, component id, kept)} by comparing all pairs."""
    sets, root = [brute_set(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)] = min(d, ids.get(find(i), d))
    out = []
    for i, (d, _) in enumerate(rows):
        c = ids.get(find(i)) if sets[i] else d
        out.append((d, len(sets[i]), c, c is None or d == c))
    return sorted(out, key=str)


def run(spark, rows, p=Params()):
    docs = spark.createDataFrame([(d, t, 1, True) for d, t in rows], "doc_id long, text string, n long, kept boolean")
    found = odd_sketch.near_duplicates(docs, p=p)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def edited(rng, words, times):
    out = list(words)
    for _ in range(times):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(500)] + ["É", "Straße"]
    texts = [None, "", " \n\t", "One", "one", "one two", "ONE\tTWO", "a b c", "A B C", "a\x1cb c d"]
    for _ in range(25):
        w = [rng.choice(vocab) for _ in range(rng.randint(4, 260))]
        texts.append(" ".join(w))
        for _ in range(rng.randint(0, 5)):  # near the threshold on both sides: 3 shingles an edit
            texts.append(" ".join(edited(rng, w, rng.randint(0, max(1, len(w) // 25)))))
    drift = [rng.choice(vocab) for _ in range(120)]
    for _ in range(40):  # a chain: neighbours link, the ends do not
        drift = edited(rng, drift, 2)
        texts.append(" ".join(drift))
    rng.shuffle(texts)
    return list(enumerate(texts, start=5))


def test_components_match_brute_force(spark, rows):
    assert run(spark, rows) == brute(rows)


def test_split_buckets_and_one_partner_a_round(spark, rows):
    assert run(spark, rows, Params(hot=7, tile=4, partners=1)) == brute(rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, "a b c d"), (3, "a b c d"), (3, "a b c d"), (2, None), (None, ""), (1, ""), (None, "x y z"),
            (None, "x y z"), (7, "one text"), (7, "another text"), (8, "another text"), (9, "one text")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_keep_representatives(spark):
    docs = spark.createDataFrame([(4, "a b c d e", "x"), (2, "A b c d e", "y"), (None, "p q", "z")],
                                 "doc_id long, text string, __x string")
    got = odd_sketch.keep_representatives(docs)
    assert got.columns == docs.columns
    assert sorted(got.collect(), key=str) == sorted([(2, "A b c d e", "y"), (None, "p q", "z")], key=str)


def test_a_long_text(spark):
    rng = random.Random(1)
    words = [f"w{rng.randrange(10**5)}" for _ in range(300_000)]
    rows = [(1, " ".join(words)), (2, " ".join(edited(rng, words, 5000)))]
    n = len(brute_set(rows[0][1]))
    got = run(spark, rows)
    assert [r[2] for r in got] == [1, 1] and got[0][1] == n


@pytest.mark.parametrize("size", [8, 40, 400])
def test_sketch_estimates_similarity(size):
    p, rng = Params(), np.random.default_rng(0)
    sampler = Sampler(p.samples, 12)
    for shared in (0.85, 0.95):
        both = int(round(2 * size * shared / (1 + shared)))
        real = both / (2 * size - both)
        bits, agree = [], []
        for _ in range(100):
            grams = rng.integers(0, 2 ** 64, 2 * size - both, dtype=np.uint64)
            low = [sampler.minima(g) for g in (grams[:size], grams[size - both:])]
            agree.append((low[0] == low[1]).mean())
            bits.append(int(np.bitwise_count(odd_sketch.odd_sketch(low[0], p) ^ odd_sketch.odd_sketch(low[1], p)).sum()))
        assert abs(np.mean(agree) - real) < 0.006
        assert np.std(agree) <= 1.3 * (real * (1 - real) / p.samples) ** 0.5
        flips = 2 * p.samples * (1 - real)
        assert abs(np.mean(bits) - p.bits / 2 * (1 - (1 - 2 / p.bits) ** flips)) < 12
        assert real < 0.85 or max(bits) <= p.cut()


def test_slices_of_partners():
    p = Params()
    sketch = np.zeros((5, 64), np.uint64)
    sketch[3, 0] = 7
    key, comp = np.array([0, 0, 0, 0, 1]), np.array([1, 1, 2, 3, 4])
    n, node, band = np.array([100, 100, 100, 100, 100]), np.array([10, 11, 12, 13, 14]), np.ones(5, int)
    bands = np.array([[0, 5], [1, 5], [2, 5], [3, 5], [4, 9]])
    args = key, band, comp, n, node, sketch, bands, p
    a, b, more = odd_sketch.partners_outside(*args, 0, 1)   # the nearest of rows 0 and 1 is their own component
    assert list(zip(a, b)) == [(2, 0), (3, 0)] and more.tolist() == [0]
    a, b, more = odd_sketch.partners_outside(*args, 1, 8)
    assert list(zip(a, b)) == [(0, 2), (0, 3), (1, 2), (1, 3), (2, 1), (2, 3), (3, 1), (3, 2)] and not len(more)
    bands[:2, 0] = 7                                        # rows 0 and 1 meet in an earlier band: not named here
    comp[1] = 5
    a, b, _ = odd_sketch.partners_outside(*args, 0, 1)
    assert list(zip(a, b)) == [(2, 0), (3, 0)]
    n[3] = 50                                               # too small to reach the similarity
    a, b, _ = odd_sketch.partners_outside(*args, 0, 8)
    assert list(zip(a, b)) == [(0, 2), (1, 2), (2, 0), (2, 1)]
