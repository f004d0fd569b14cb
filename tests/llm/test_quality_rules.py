import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from georisk.llm import catalog, quality_rules as qr
from georisk.llm.common import read_table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text, p):
    text = text or ""
    w = WORD.findall(text)
    n = len(w)
    at = {}
    for s in range(n - p.window + 1):
        at.setdefault(tuple(w[s:s + p.window]), []).append(s)
    repeat = {k for s in at.values() if len(s) > 1 for x in s for k in range(x, x + p.window)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    longest, cover = 0, set()
    for i in range(n):
        for j in range(n):
            if i != j:
                k = 0
                while max(i, j) + k < n and w[i + k] == w[j + k]:
                    k += 1
                longest = max(longest, k)
                if k >= p.repeat_words:
                    cover |= set(range(i, i + k))
    chars = sum(map(len, w))
    return {"n_words": n, "word_chars": chars, "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": dup,
            "n_repeat_words": len(repeat), "longest_repeat": longest,
            "covered": pytest.approx(sum(len(w[k]) for k in cover) / chars if chars else 0.0)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(["a", "b", "é", "\n", "#*", "a b a b"]), max_size=40)
                          .map(" ".join)), max_size=6), st.sampled_from([1, 25, 10_000]))
def test_measures_match_brute_force(texts, chunk):
    p = qr.Params(window=3, repeat_words=2, chunk=chunk)
    got = qr.measure(texts, p)
    for i, t in enumerate(texts):
        assert {k: v[i] for k, v in got.items()} == brute(t, p)


def test_longest_matches_of_periodic_and_random_texts():
    rng = np.random.default_rng(1)
    for tokens in ([7] * 50, list(range(30)), [1, 2] * 40, rng.integers(0, 3, 200).tolist()):
        n, got = len(tokens), qr.longest_matches(np.array(tokens))
        for i in range(n):
            want = 0
            for j in range(n):
                k = 0
                while i != j and max(i, j) + k < n and tokens[i + k] == tokens[j + k]:
                    k += 1
                want = max(want, k)
            assert got[i] == want


def test_query_on_the_given_table(spark):
    sf, p = "/root/testdata/sf0.001", qr.Params()
    texts = {r["doc_id"]: r["text"] for r in read_table(spark, sf, "documents").collect()}
    got = catalog.QUERIES["op7_quality_rules"](spark, sf).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        if len(texts[r["doc_id"]]) < 1200:
            want = brute(texts[r["doc_id"]], p)
            for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "longest_repeat"):
                assert r[k] == want[k]
        base = r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]
        assert r["base_failed"] == base and (not base or not r["kept"])


def test_verdicts_and_edge_rows(spark):
    rng = random.Random(0)
    clean = " ".join(f"w{rng.randrange(10**6)}" for _ in range(300))
    copied = clean + " " + " ".join(clean.split()[:60])  # base rule passes: 120 of 360 words, the limits decide
    rows = [(1, clean), (2, copied), (3, None), (4, ""), (None, "few words"), (6, "spam " * 30_000), (1, clean)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, kept int")
    got = {r["doc_id"]: r for r in qr.judge(docs).collect()}
    assert got[1]["kept"] and not got[1]["base_failed"] and not got[1]["repeats_failed"]
    assert not got[2]["kept"] and got[2]["covered"] > 0.3
    assert got[3]["base_failed"] and got[4]["base_failed"] and not got[None]["kept"]
    assert got[6]["longest_repeat"] == 29_999 and not got[6]["kept"]
    assert qr.judge(docs).count() == 7 and qr.judge(docs.limit(0)).count() == 0


def test_a_long_repeat_alone_rejects_a_long_text(spark):
    words = [f"w{i}" for i in range(4000)]
    at_limit, above, passage = words[:], words[:], words[:]
    at_limit[2000:2040], above[2000:2041], passage[3000:3400] = words[:40], words[:41], words[:400]
    rows = [(i, " ".join(w)) for i, w in enumerate((words, at_limit, above, passage))]
    got = {r["doc_id"]: r for r in qr.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i]["longest_repeat"] for i in range(4)] == [0, 40, 41, 400]
    assert not any(r["base_failed"] or r["covered"] > 0.3 for r in got.values())
    assert [got[i]["kept"] for i in range(4)] == [True, True, False, False]
