"""Quality rules from a suffix array over the words of each text.

Words get numbers, suffixes are sorted by prefix doubling in numpy, and the
longest common prefix of neighbours falls out of the ranks of the doublings.
The longest match that a suffix has anywhere else in its text is the larger
of the two neighbouring prefixes.  A maximal repeated substring is an interval
of the suffix array whose common prefix is bounded by shorter ones; its
occurrences, united over all intervals of at least m words, are exactly the
words p .. p + L(p) with L(p) >= m.  Two limits follow: the fraction of the
text's characters that such spans cover, and the longest repeat.

The texts of a batch are sorted together in chunks: the number of a word
includes its text, so suffixes of different texts never share a prefix.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import space_words

SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Params:
    """Limits of the rules.

    ``repeat_words``: words of a repeat that counts as covered.  A text is rejected
    when repeats cover more than ``max_covered`` of the characters of its words,
    or when one repeat is longer than ``max_repeat`` words, however long the text.
    ``chunk`` words are sorted at a time; a
    longer text is a chunk of its own.
    """

    min_words: int = 20
    window: int = 8
    max_repeat_percent: int = 30
    repeat_words: int = 5
    max_covered: float = 0.3
    max_repeat: int = 40
    chunk: int = 60_000


def longest_matches(tokens: np.ndarray) -> np.ndarray:
    """For each position the length of the longest other occurrence of what starts there."""
    n = len(tokens)
    best = np.zeros(n, np.int64)
    if n < 2:
        return best
    ranks = [np.unique(tokens, return_inverse=True)[1].astype(np.int64)]
    step = 1
    while True:
        rank = ranks[-1]
        second = np.zeros(n, np.int64)
        second[:n - step] = rank[step:] + 1  # 0: the text has ended
        pair = rank * (n + 1) + second
        order = np.argsort(pair, kind="stable")
        moved = pair[order]
        new = np.concatenate([[0], np.cumsum(moved[1:] != moved[:-1])])
        if new[-1] == n - 1 or 2 * step >= n:
            break
        back = np.empty(n, np.int64)
        back[order] = new
        ranks.append(back)
        step *= 2
    a, b = order[:-1].copy(), order[1:].copy()  # neighbours in the suffix array
    common = np.zeros(n - 1, np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        inside = np.maximum(a, b) < n
        same = inside.copy()
        same[inside] = ranks[level][a[inside]] == ranks[level][b[inside]]
        # a rank of this level stands for 2^level words, or for all that is left of the text
        jump = np.where(same, 1 << level, 0)
        common += jump
        a += jump
        b += jump
    best[order[:-1]] = common
    best[order[1:]] = np.maximum(best[order[1:]], common)
    return best


def covered(length: np.ndarray, least: int) -> np.ndarray:
    """Words inside the union of the repeats of at least ``least`` words; a match may not pass its text's end."""
    n = len(length)
    edge = np.zeros(n + 1, np.int64)
    at = np.nonzero(length >= least)[0]
    np.add.at(edge, at, 1)
    np.add.at(edge, at + length[at], -1)
    return np.cumsum(edge[:-1]) > 0


def _lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    seen, n = set(), 0
    for line in text.split(b"\n"):
        if line.strip():
            n += line in seen
            seen.add(line)
    return n


def measure(texts: list[str | None], p: Params) -> dict[str, list]:
    """The measures of each text; null is an empty text."""
    out = {k: [] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered", "longest_repeat")}
    chunk: list[list[bytes]] = []
    size = 0

    def flush():
        numbers: list[np.ndarray] = []
        top = 0
        for words in chunk:
            known: dict[bytes, int] = {}
            numbers.append(np.fromiter((known.setdefault(w, top + len(known)) for w in words), np.int64, len(words)))
            top += len(known)
        length = longest_matches(np.concatenate([np.empty(0, np.int64), *numbers]))
        windows, spans = covered_windows(length, p.window), covered(length, p.repeat_words)
        at = 0
        for words in chunk:
            end = at + len(words)
            chars = np.fromiter(map(len if b"".join(words).isascii() else _chars, words), np.int64, len(words))
            total = int(chars.sum())
            out["n_words"].append(len(words))
            out["word_chars"].append(total)
            out["n_repeat_words"].append(int(windows[at:end].sum()))
            out["covered"].append(float(chars[spans[at:end]].sum()) / total if total else 0.0)
            out["longest_repeat"].append(int(length[at:end].max(initial=0)))
            at = end
        chunk.clear()

    for t in texts:
        data = (t or "").encode()
        words = space_words(t)
        out["n_symbols"].append(len(data) - len(data.translate(None, SYMBOLS)))
        out["n_dup_lines"].append(_lines(data))
        if chunk and size + len(words) > p.chunk:
            flush()
            size = 0
        chunk.append(words)
        size += len(words)
    flush()
    return out


def covered_windows(length: np.ndarray, window: int) -> np.ndarray:
    """Words in some run of ``window`` words that occurs twice or more."""
    edge = np.zeros(len(length) + 1, np.int64)
    at = np.nonzero(length >= window)[0]
    edge[at] += 1
    edge[at + window] -= 1
    return np.cumsum(edge[:-1]) > 0


def _chars(word: bytes) -> int:
    return len(word) if word.isascii() else len(word.decode())


def judge(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """Measures and verdict per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    covered, longest_repeat, base_failed, repeats_failed, kept.

    Null and empty texts have no words and so fail the base rule.  Repeated
    rows and null ids are judged like any other; other columns are not read.
    """
    kinds = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long",
             "n_repeat_words": "long", "covered": "double", "longest_repeat": "long"}

    def run(batches):
        for b in batches:
            got = measure(b.column(1).to_pylist(), p)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(got[k], pa.float64() if t == "double" else pa.int64()) for k, t in kinds.items())],
                names=["doc_id", *kinds])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, " + ", ".join(f"{k} {t}" for k, t in kinds.items()))
    base = (F.col("n_words") < p.min_words) | (100 * F.col("n_repeat_words") > p.max_repeat_percent * F.col("n_words"))
    repeats = (F.col("covered") > p.max_covered) | (F.col("longest_repeat") > p.max_repeat)
    return (found.withColumn("base_failed", base).withColumn("repeats_failed", repeats)
            .withColumn("kept", ~F.col("base_failed") & ~F.col("repeats_failed")))
