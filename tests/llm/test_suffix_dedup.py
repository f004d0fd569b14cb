import random

import pytest

from georisk.llm import suffix_dedup as sd
from georisk.llm.common import space_words

SCHEMA = "doc_id long, text string, n_chars long, th string, row int"


def brute(rows, length):
    """{(doc_id, text): words repeated} over distinct texts, the first occurrence staying."""
    first_doc = {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        first_doc.setdefault(t or "", i)
    seen, hit = {}, {}
    for t, d in sorted(first_doc.items(), key=lambda x: x[1]):
        w = [x.decode() for x in space_words(t)]
        marks = set()
        for s in range(len(w) - length + 1):
            run = tuple(w[s:s + length])
            at = seen.setdefault(run, (d, s))
            if at[0] != d or s >= at[1] + length:
                marks |= set(range(s, s + length))
        hit[d] = marks
    for i, t in rows:
        n = len(space_words(t))
        if i is not None and first_doc[t or ""] != i:
            hit[i] = set(range(n)) if n >= length else set()
    return hit


def corpus(seed, min_words):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(3000)]
    words = lambda n: [rng.choice(vocab) for _ in range(n)]
    passages = [words(rng.randint(min_words - 2, 3 * min_words)) for _ in range(8)]
    halves = [p[:min_words * 2 // 3] for p in passages]
    texts = [None, "", " \n ", "a " * 300, "é " * 7]
    for _ in range(60):
        w = words(rng.randint(0, 40))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages + halves)
            a = rng.randint(0, 6)
            w += p[a:] + words(rng.randint(0, 30))
        texts.append(rng.choice([" ", "\n"]).join(w))
    texts += [texts[20], texts[20], texts[21]]
    rng.shuffle(texts)
    return list(enumerate(texts, start=1))


@pytest.mark.parametrize("seed,p", [(1, sd.Params(12, 6, 3)), (2, sd.Params(50, 32, 4)), (3, sd.Params(9, 9, 1)),
                                    (4, sd.Params(12, 6, 3, split=2)), (5, sd.Params(10, 7, 2, split=3))])
def test_matches_brute_force(spark, seed, p):
    rows = corpus(seed, p.min_words)
    docs = spark.createDataFrame([(i, t, 0, "x", 1) for i, t in rows], SCHEMA)
    got = {i: set() for i, _ in rows}
    for r in sd.find_repeats(docs, p).collect():
        span = set(range(r["start_word"], r["start_word"] + r["n_words"]))
        assert not span & got[r["doc_id"]] and r["kept_doc_id"] <= r["doc_id"]
        got[r["doc_id"]] |= span
    want = brute(rows, p.min_words)
    assert got == want

    kept = {r["doc_id"]: r for r in sd.remove_repeats(docs, p).collect()}
    for i, t in rows:
        w = space_words(t)
        left = [x for k, x in enumerate(w) if k not in want[i]]
        if not want[i]:
            assert kept[i]["text"] == t and kept[i]["n_chars"] == 0
        elif left:
            assert space_words(kept[i]["text"]) == left and kept[i]["n_chars"] == len(kept[i]["text"])
        else:
            assert i not in kept


def test_edge_rows(spark):
    p = sd.Params(6, 3, 2)
    long = " ".join(f"x{i}" for i in range(40))
    docs = spark.createDataFrame([(None, long, 1, None, None), (None, None, None, None, None), (4, long, 9, "t", 3),
                                  (4, long, 9, "t", 3), (9, long, 9, "t", 3), (9, "short text", 2, "t", 3)], SCHEMA)
    got = sorted((r["doc_id"] or 0, r["start_word"], r["n_words"], r["kept_doc_id"]) for r in sd.find_repeats(docs, p).collect())
    assert got == [(0, 0, 40, 4), (9, 0, 40, 4)]
    left = sd.remove_repeats(docs, p)
    assert left.columns == docs.columns and left.schema.simpleString() == docs.schema.simpleString()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in left.collect()) == [
        (0, ""), (4, long), (4, long), (9, "short text")]
    empty = docs.limit(0)
    assert sd.find_repeats(empty, p).count() == 0 and sd.remove_repeats(empty, p).count() == 0
    with pytest.raises(ValueError):
        sd.find_repeats(docs, sd.Params(5, 5, 2))


def test_every_copy_of_a_run_selects_the_same_suffix():
    rng = random.Random(4)
    p = sd.Params()
    w = [str(rng.randrange(50)).encode() for _ in range(400)]
    a, b = sd.Suffixes(w, p), sd.Suffixes(w[37:337], p)
    assert (a.selected[37:37 + len(b.selected)] - 37 == b.selected).all()
    assert set(b.keys.tolist()) <= set(a.keys.tolist())
    assert len(a.at) < 0.15 * len(w)  # sparse


def test_cut_words():
    assert sd.cut_words("a  b\nc d ", [1], [2]) == "a  d"
    assert sd.cut_words("a b c", [0, 2], [1, 1]) == "b"
    assert sd.cut_words(" a", [0], [1]) == ""
