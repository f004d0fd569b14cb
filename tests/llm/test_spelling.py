import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from georisk.llm import spelling
from georisk.llm.spelling import Params, Piece


def brute_words(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode()) & 0xFFFFFFFF
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    words = brute_words(rows)
    out, form = {}, {}
    for w, n in words.items():
        others = [v for v in words if near(w, v)]
        best = min(others, key=lambda v: (-words[v], [ord(c) for c in v]), default=None)
        if best is not None and words[best] >= 5 * n:
            form[w] = best
        out[w] = (n, len(others))
    result = []
    for w, (n, n_near) in out.items():
        root = w
        while root in form:
            root = form[root]
        result.append((w, form.get(w), root, n, n_near, words.get(form.get(w))))
    return sorted(result, key=str)


def run(spark, rows, p=Params()):
    docs = spark.createDataFrame([(i, t, 3, "x") for i, t in rows], "doc_id long, text string, n long, word string")
    found = spelling.variants(docs.repartition(4), p=p)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    letters = "abcdeé"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 9))) for _ in range(60)]
    base += ["Ärzte" + "xyz", "naïveté", "NAÏVETÉ", "straße" + "n", "pqr" * 30, "short", "a÷b×cdef"]
    pool = []
    for w in base:
        pool += [w] * rng.choice([1, 6, 40, 200])
        for _ in range(3):
            i, c = rng.randrange(len(w)), rng.choice(letters)
            v = rng.choice([w[:i] + w[i + 1:], w[:i] + c + w[i + 1:], w[:i] + c + w[i:]])
            pool += [v] * rng.choice([2, 5, 7, 30])
    pool += ["chainaa"] * 6 + ["chainab"] * 40 + ["chaizab"] * 300   # a form of a form
    rng.shuffle(pool)
    rows = [(i, " ".join(x.upper() if rng.random() < 0.1 else x for x in pool[at:at + 20]) + ", 12a_b\n")
            for i, at in enumerate(range(0, len(pool), 20))]
    return rows + [(None, "straßen straßen"), (None, None), (5000, ""), rows[3], rows[3]]


def test_variants_match_brute_force(spark, rows):
    want = brute(rows)
    assert sum(r[1] is not None for r in want) > 20 and any(r[2] != r[1] and r[1] for r in want)
    assert run(spark, rows) == want


def test_rounds_with_small_filters(spark, rows):
    """Each round broadcasts two blocks at most; lengths are divided by hash."""
    p = Params(filter_bytes=64, last_length=8)
    sizes = Counter(min(len(w), 8) for w in brute_words(rows))
    rounds = spelling.plan(sizes, p)
    assert len(rounds) > 3 and all(sum(x.blocks for x in r) <= 2 for r in rounds) and any(x.parts > 1 for x in rounds[0] + rounds[-1])
    assert run(spark, rows, p) == brute(rows)


def test_slips_delete_a_code_point():
    rows = [(i, "abcdefgh" * 2) for i in range(2000)]
    got = Counter()
    for r in rows:
        got.update(spelling.counted(*r))
    assert {w: n for w, n in got.items() if n >= 5} == brute_words(rows)
    assert len(got) > 1


def test_edit_hashes_are_those_of_the_edited_words():
    words = ["aabcde", "zÿàbcd"]
    (at, codes), = spelling._by_length(words)
    made = set()
    for row, h, length in spelling.edits(codes, True, True, step=5):
        made |= {(int(r), int(x)) for r, x in zip(row, h)}
    want = set()
    for k, w in enumerate(words):
        alphabet = [chr(int(c)) for c in spelling.ALPHABET]
        some = [w[:i] + w[i + 1:] for i in range(6)] + [w[:i] + c + w[i + 1:] for i in range(6) for c in alphabet if c > w[i]]
        want |= {(k, int(h)) for h in spelling.hashes(some)}
    assert made == want


def test_filter_has_no_false_negatives_and_few_false_positives():
    draw = np.random.default_rng(1)
    h = draw.integers(0, 2 ** 64, 20_000, dtype=np.uint64)
    piece = Piece(7, 0, 1, -(-len(h) * 16 // 256))
    piece.words = np.zeros((piece.blocks, 8), np.uint32)
    block, low = piece.places(h)
    for i in range(8):
        np.bitwise_or.at(piece.words[:, i], block, piece.bit(low, i))
    assert len(piece.holds(h)) == len(h)
    assert len(piece.holds(draw.integers(0, 2 ** 64, 100_000, dtype=np.uint64))) < 500


def test_empty_inputs(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, ""), (None, "abcdef")]) == []


def test_a_long_word(spark):
    word = "ab" * 5000
    other = word[:4000] + "z" + word[4001:]
    rows = [(i, f"{word} {word} {word} {word} {word} {word}") for i in range(5)] + [(9, " ".join([other] * 5 + [word[1:]] * 5))]
    assert run(spark, rows, Params(every=0)) == sorted(
        [(word, None, word, 30, 2, None), (other, word, word, 5, 1, 30), (word[1:], word, word, 5, 1, 30)], key=str)
