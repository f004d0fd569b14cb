import hashlib
import random
import re

import pytest

from georisk.llm import catalog, decontaminate as dc
from georisk.llm.common import read_table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SF = "/root/testdata/sf0.001"


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            x = words(t)
            for s in range(max(len(x) - window, 0) + 1) if x else ():
                run = x[s:s + window]
                for k in range(len(w) - len(run) + 1):
                    if w[k:k + len(run)] == run:
                        hit |= set(range(k, k + len(run)))
                        found.add(item)
        found = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def rows(df):
    from pyspark.sql import functions as F
    ids = F.array_join(F.sort_array(F.transform("items", lambda x: x.cast("string"))), ",")
    got = df.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(ids, 256), "contaminated").collect()
    return sorted((tuple(r) for r in got), key=str)


@pytest.mark.parametrize("block", [200_000, 7])
def test_matches_brute_force(spark, block):
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(12)] + ["É", "ß", "日本"]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 3, 4, 5, 8, 12]))) for i in range(8)] + [(9, None), (10, ""), (11, "--"), (None, text(4))]
    items += [(2, items[2][1]), (12, items[2][1])]
    docs = [(1, None), (2, ""), (3, "W1-w2\x00W3")]
    for i in range(4, 60):
        t = text(rng.randint(0, 30))
        if rng.random() < 0.6:
            t += rng.choice([" ", ",", "\x7f"]) + (rng.choice(items)[1] or "").upper().replace(" ", "; ") + " " + text(5)
        docs.append((i, t))
    docs += [(None, docs[20][1]), (20, docs[20][1]), (20, docs[20][1])]
    d = spark.createDataFrame([(i, t, "s", 1) for i, t in docs], "doc_id long, text string, items string, th int")
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, words int")
    p = dc.Params(window=5, block=block)
    assert rows(dc.report(d, b, p)) == brute(docs, items, 5)
    clean = {i for i, _, n, *_ in brute(docs, items, 5) if not n}
    kept = dc.keep_clean(d, b, p)
    assert kept.columns == d.columns and {r["doc_id"] for r in kept.collect()} == clean


def test_whole_query_on_the_given_tables(spark):
    docs = [tuple(r) for r in read_table(spark, SF, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in read_table(spark, SF, "benchmark").select("item_id", "text").collect()]
    starts = {}
    for item, t in items:  # brute force with a dictionary of windows, as the tables are larger
        w = words(t)
        for s in range(max(len(w) - 10, 0) + 1) if w else ():
            starts.setdefault(tuple(w[s:s + 10]), set()).add(item)
    want = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in starts}:
            for s in range(len(w) - n + 1):
                if got := starts.get(tuple(w[s:s + n])):
                    hit |= set(range(s, s + n))
                    found |= got
        ids = ",".join(sorted(map(str, found)))
        want.append((i, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    got = [tuple(r) for r in catalog.QUERIES["op4_benchmark_decontamination"](spark, SF).collect()]
    assert sorted(got) == sorted(want) and any(r[5] for r in want)


def test_prefix_is_the_rarest_shingle():
    x = dc.Index([("a b c d", [1])], dc.Params())
    codes = x.code(x.coded[0], 3).tolist()
    x.set_prefixes({codes[0]: 5, codes[1]: 2})
    assert x.prefix == {codes[1]: [(1, 0)]}


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert rows(dc.report(d, b.limit(0))) == brute([(1, "a b"), (2, None)], [])
    assert dc.report(d.limit(0), b).count() == 0


def test_a_very_long_text(spark):
    t = "x y " * 100_000 + "needle in the hay stack of words that repeats"
    d = spark.createDataFrame([(1, t)], "doc_id long, text string")
    b = spark.createDataFrame([(5, "Needle in the hay; stack of words that repeats")], "item_id long, text string")
    assert rows(dc.report(d, b)) == [(1, 200_009, 9, 1, hashlib.sha256(b"5").hexdigest(), True)]
