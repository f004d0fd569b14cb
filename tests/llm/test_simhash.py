import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from georisk.llm import simhash
from georisk.llm.components import components


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words)] if len(words) < 3 else [" ".join(words[i:i + 3]) for i in range(len(words) - 2)]
    hs = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows, radius=3):
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in rows:
        for j, b in rows:
            if i < j and bin(a ^ b).count("1") <= radius:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in rows}


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(400)] + ["É", "Straße"]
    out = [None, "", "  \n\t", "One", "one two", "ONE TWO", "a\x1cb c d", "a b c d e", "a b c d e"]
    for _ in range(60):
        w = [rng.choice(vocab) for _ in range(rng.randint(3, 300))]
        out.append(" ".join(w))
        for _ in range(rng.randint(0, 4)):
            v = list(w)
            v[rng.randrange(len(v))] = "changed"
            out.append(" ".join(v))
    return out


def test_fingerprints_and_components_match_brute_force(spark, texts):
    rows = list(enumerate(texts, start=10))
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, fp int, component_id string")
    got = {r["doc_id"]: (r["fp"] % 2**64, r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    want = {i: brute_fingerprint(t) for i, t in rows}
    assert {i: f for i, (f, _) in got.items()} == want
    assert {i: c for i, (_, c) in got.items()} == brute_components(list(want.items()))


@pytest.mark.parametrize("hot,bucket", [(16384, 64), (40, 64), (40, 1)])
def test_links_on_dense_and_split_blocks(spark, hot, bucket):
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(4)]
    fps = set()
    for b in base:
        for _ in range(120):
            x = b
            for _ in range(rng.randint(0, 5)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    rows = [(i, f) for i, f in enumerate(sorted(fps))]
    df = spark.createDataFrame([(f - 2**64 if f >> 63 else f, i) for i, f in rows], "fp long, node long")
    pairs = simhash.links(df, 3, tile=16, bucket=bucket, hot=hot)
    roots = {r["node"]: r["root"] for r in components(pairs).collect()}
    assert {i: roots.get(i, i) for i, _ in rows} == brute_components(rows)


def test_tile_links_skip_and_spanning():
    rng = np.random.default_rng(0)
    fp = np.unique(rng.integers(0, 2**16, 600, dtype=np.uint64))  # dense: many links
    pc = np.bitwise_count(fp).astype(int)
    order = np.argsort(pc, kind="stable")
    fp, pc = fp[order], pc[order]
    a, b = simhash.tile_links(np.zeros(len(fp), int), pc, fp, 3, 32)
    got = brute = np.arange(len(fp))
    rows = list(enumerate(fp.tolist()))
    brute = brute_components(rows)
    root = list(range(len(fp)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = find(x), find(y)
        root[max(p, q)] = min(p, q)
    got = {i: find(i) for i in range(len(fp))}
    assert got == brute


def test_layout_grows_with_the_corpus():
    assert [simhash.layout(n, 3, 64) for n in (10, 4_000_000, 10**8, 10**10)] == [4, 4, 5, 6]


def test_edge_rows(spark):
    schema = "doc_id long, text string"
    assert simhash.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    docs = spark.createDataFrame([(None, "a b c d"), (3, "a b c d"), (3, "a b c d"), (2, None), (1, "")], schema)
    got = sorted((r["doc_id"] or 0, r["component_id"]) for r in simhash.near_duplicates(docs).collect())
    assert got == [(0, 3), (1, 1), (2, 1), (3, 3), (3, 3)]
    kept = simhash.keep_representatives(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [1, 3]


def test_ids_join_nothing_and_rows_without_id_join_others(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(4000)]
    base = [" ".join(rng.choices(words, k=400)) for _ in range(6)]

    def near(t, k):
        x = t.split()
        x[k] = "other"
        return " ".join(x)
    rows = [(1, base[0], "x"), (1, base[1], "y"), (2, base[0], "x"), (3, base[1], "x"), (None, base[2], "x"),
            (None, base[2], "z"), (None, near(base[2], 5), "x"), (9, near(base[2], 5), "x"), (8, near(base[2], 9), "x"),
            (None, base[3], "x"), (None, base[3], "x"), (5, base[4], "x"), (5, base[4], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hash string")
    fp = [simhash.fingerprint(t.lower().encode().split()) for _, t, _ in rows]
    root = brute_components(list(enumerate(fp)))  # rows as nodes
    members = {}
    for i, r in root.items():
        members.setdefault(r, []).append(i)
    least = {r: min((rows[i][0] for i in m if rows[i][0] is not None), default=None) for r, m in members.items()}
    assert root[4] == root[7]  # a row without id is between 8 and 9
    key = lambda r: tuple((x is None, x) if x is not None else (True, 0) for x in r)
    got = sorted(((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()), key=key)
    assert got == sorted(((rows[i][0], least[r]) for i, r in root.items()), key=key)
    kept = simhash.keep_representatives(docs)
    assert kept.columns == docs.columns
    kept = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert len(kept) == len(members)  # one per component, the two texts of doc 1 among them
    assert {(1, base[0]), (1, base[1]), (None, base[3]), (5, base[4])} <= set(kept)
    assert sorted(i for i, _ in kept if i) == sorted(x for x in least.values() if x)


def test_components_of_a_long_chain(spark):
    n = 60
    links = spark.range(n).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    links = links.unionByName(spark.createDataFrame([(200, 100), (100, 200), (None, 4), (7, 7)], "u long, v long"))
    got = {r["node"]: r["root"] for r in components(links).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {100: 100, 200: 100}
