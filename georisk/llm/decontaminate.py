"""Benchmark decontamination by a prefix-filtered set join.

An item's windows are its runs of ``window`` consecutive words (one shorter
run if it has fewer).  Taken as a set of shingles, a window is contained in a
document only if all its shingles are, so for containment 1 the necessary
prefix of the window is its single rarest shingle.

1. Count, over all documents, how many hold each shingle of the benchmark;
   order every window's shingles by that rarity and index the window under the
   rarest one, with its offset in the window.
2. A document's shingles that are some window's prefix are the candidates.
   Where one stands at word i and its offset is o, the window can only start
   at word i - o and must end inside the document: the positional and length
   bounds.  Windows longer than the document are never tried.
3. A candidate is verified word for word.

The benchmark goes to the tasks in blocks of about ``block`` windows, so what
is broadcast has a fixed bound however long the benchmark is.  Documents are
read once per block to count and once to match.  With a single block nothing
is shuffled; the hits of several blocks are joined by the hashes of the text.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, alnum_words, cut_lineage

MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


@dataclass(frozen=True)
class Params:
    """Words of a window, words of a shingle (3 at most), and windows sent to the tasks at once."""

    window: int = 10
    shingle: int = 3
    block: int = 200_000


def item_windows(benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """``(words, items)``: every distinct window, space-joined, with the sorted ids of its items.

    Items without words have no window.  A window whose items all have a null
    item_id has an empty list: it marks words as hit but counts for no item.
    """
    def run(batches):
        for b in batches:
            ids, wins = [], []
            for i, t in zip(*(c.to_pylist() for c in b.columns)):
                w = alnum_words(t)
                made = {b" ".join(w[s:s + p.window]) for s in range(max(len(w) - p.window, 0) + 1)} if w else set()
                ids += [i] * len(made)
                wins += [x.decode() for x in sorted(made)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(wins, pa.string())],
                                             names=["item_id", "words"])

    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(
        run, "item_id long, words string")
    return rows.groupBy("words").agg(F.sort_array(F.collect_set("item_id")).alias("items"))


class Index:
    """Windows of one block, by word number: 0 is a word that no window has."""

    def __init__(self, windows: list[tuple[str, list[int]]], p: Params):
        self.p = p
        self.windows = [w.encode().split(b" ") for w, _ in windows]
        self.items = [i for _, i in windows]
        self.number: dict[bytes, int] = {}
        for w in self.windows:
            for x in w:
                self.number.setdefault(x, len(self.number) + 1)
        self.coded = [np.array([self.number[x] for x in w], np.int64) for w in self.windows]
        self.sizes = sorted({min(p.shingle, len(w)) for w in self.windows})  # a short window is its own shingle

    def code(self, ids: np.ndarray, size: int) -> np.ndarray:
        """One number for the shingle at each position; 0 where a word is in no window."""
        n = len(ids) - size + 1
        if n <= 0:
            return np.empty(0, np.uint64)
        parts = [ids[k:k + n].astype(np.uint64) for k in range(size)]
        out = reduce(np.add, [x * MULTIPLIERS[k] for k, x in enumerate(parts)]) + np.uint64(size)
        for x in parts:
            out[x == 0] = 0
        return out

    def doc_ids(self, words: list[bytes]) -> np.ndarray:
        get = self.number.get
        return np.fromiter((get(w, 0) for w in words), np.int64, len(words))

    def shingles(self) -> np.ndarray:
        return np.unique(np.concatenate([np.empty(0, np.uint64)] + [self.code(c, min(self.p.shingle, len(c))) for c in self.coded]))

    def set_prefixes(self, held: dict[int, int]) -> None:
        """Index every window under its rarest shingle; ``held`` has the documents per shingle."""
        prefix = defaultdict(list)
        for n, c in enumerate(self.coded):
            size = min(self.p.shingle, len(c))
            codes = self.code(c, size).tolist()
            least = min(range(len(codes)), key=lambda k: (held.get(codes[k], 0), codes[k], k))
            prefix[codes[least]].append((least, n))
        self.prefix = dict(prefix)
        self.prefix_codes = np.array(sorted(self.prefix), np.uint64)

    def match(self, words: list[bytes]) -> tuple[np.ndarray, set[int]]:
        """Which words lie in an occurrence of a window, and the windows that occur."""
        ids = self.doc_ids(words)
        edge, found = np.zeros(len(ids) + 1, np.int64), set()
        for size in self.sizes:
            codes = self.code(ids, size)
            if not len(codes):
                continue
            at = np.searchsorted(self.prefix_codes, codes)
            at[at == len(self.prefix_codes)] = 0
            for i in np.nonzero(self.prefix_codes[at] == codes)[0].tolist():
                for offset, n in self.prefix[int(codes[i])]:
                    w = self.coded[n]
                    s = i - offset
                    if s >= 0 and s + len(w) <= len(ids) and np.array_equal(ids[s:s + len(w)], w):
                        edge[s] += 1
                        edge[s + len(w)] -= 1
                        found.add(n)
        return np.cumsum(edge[:-1]) > 0, found


def _holding(docs: DataFrame, index) -> dict[int, int]:
    """Documents that hold each shingle of the block, counted over all documents."""
    def run(batches):
        x = index.value
        wanted = x.shingles()
        counts = np.zeros(len(wanted), np.int64)
        for b in batches:
            for t in b.column(0):
                ids = x.doc_ids(alnum_words(t.as_py()))
                for size in x.sizes:
                    codes = x.code(ids, size)
                    codes = codes[codes != 0]
                    if len(codes):
                        at = np.searchsorted(wanted, codes)
                        at[at == len(wanted)] = 0
                        counts[np.unique(at[wanted[at] == codes])] += 1
        some = counts > 0
        yield pa.RecordBatch.from_arrays([pa.array(wanted[some].view(np.int64)), pa.array(counts[some])],
                                         names=["code", "n"])

    # at most one row per shingle of a block: bounded by block * window
    rows = docs.select("text").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).collect()
    return {r["code"] % 2**64: r["n"] for r in rows}


def _blocks(windows: DataFrame, p: Params):
    """Number of blocks, and the blocks one at a time."""
    stored = cut_lineage(windows, "windows")
    parts = max(-(-stored.count() // p.block), 1)

    def made():
        for k in range(parts):
            rows = stored.filter(F.pmod(F.xxhash64("words"), F.lit(parts)) == k).collect()
            yield Index(sorted((r["words"], r["items"]) for r in rows), p)
    return parts, made()


def _hits(docs: DataFrame, keep: list, index) -> DataFrame:
    """The ``keep`` columns as k0, k1, ... with ``n_words``, ``spans`` of hit words and ``items``."""
    names = [f"k{i}" for i in range(len(keep))]
    taken = docs.select(*[c.alias(k) for k, c in zip(names, keep)], F.col("text").alias("x"))
    kinds = {f.name: f.dataType.simpleString() for f in taken.schema.fields}

    def run(batches):
        x = index.value
        for b in batches:
            n_words, spans, items = [], [], []
            for t in b.column(len(names)):
                words = alnum_words(t.as_py())
                hit, found = x.match(words)
                step = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
                n_words.append(len(words))
                spans.append(np.stack([np.nonzero(step == 1)[0], np.nonzero(step == -1)[0]], axis=1).ravel().tolist())
                items.append(sorted({i for n in found for i in x.items[n]}))
            yield pa.RecordBatch.from_arrays(
                b.columns[:len(names)] + [pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pa.int64())),
                                          pa.array(items, pa.list_(pa.int64()))],
                names=[*names, "n_words", "spans", "items"])

    return taken.mapInArrow(run, ", ".join(f"{k} {kinds[k]}" for k in names)
                            + ", n_words long, spans array<long>, items array<long>")


def merged(lists: list[list[int]]) -> list[int]:
    """Union of spans given as [start, end, start, end, ...]."""
    out: list[int] = []
    for s, e in sorted((x[i], x[i + 1]) for x in lists for i in range(0, len(x), 2)):
        if out and s <= out[-1]:
            out[-1] = max(out[-1], e)
        else:
            out += [s, e]
    return out


def _merge_spans(rows: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            spans = pa.array([merged(x) for x in b.column(2).to_pylist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), spans, b.column(3)],
                                             names=["th", "th2", "found_spans", "found_items"])

    return rows.mapInArrow(run, "th long, th2 long, found_spans array<long>, found_items array<long>")


def scan(docs: DataFrame, benchmark: DataFrame, keep: list[str], p: Params = Params()) -> DataFrame:
    """Per row of ``docs``: ``keep`` as k0, k1, ... with ``n_words``, ``spans`` and ``items``.

    ``spans`` lists start and end of each stretch of hit words, ``items`` the
    sorted ids of the items found.  Null and empty texts have no words.
    """
    spark = docs.sparkSession
    columns = [F.col(c) for c in keep]
    parts, blocks = _blocks(item_windows(benchmark, p), p)

    def indexed(index: Index):
        index.set_prefixes(_holding(docs, Shared(spark, index)) if index.windows else {})
        return Shared(spark, index)
    if parts == 1:
        return _hits(docs, columns, indexed(next(blocks)))
    th, th2 = F.xxhash64("text"), F.xxhash64(F.lit(1), F.col("text"))
    found = [cut_lineage(_hits(docs, [th, th2], indexed(x)).filter("size(spans) > 0").dropDuplicates(["k0", "k1"]), "hits")
             for x in blocks]
    hits = _merge_spans(reduce(DataFrame.unionByName, found)
                        .groupBy(F.col("k0").alias("th"), F.col("k1").alias("th2"))
                        .agg(F.collect_list("spans").alias("spans"),  # one entry per block
                             F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")))
    none = Index([], p)
    none.set_prefixes({})
    rows = _hits(docs, [*columns, th, th2], Shared(spark, none)).withColumnsRenamed(
        {f"k{len(keep)}": "th", f"k{len(keep) + 1}": "th2"})
    return rows.join(hits, ["th", "th2"], "left").select(
        *[f"k{i}" for i in range(len(keep))], "n_words", F.coalesce("found_spans", "spans").alias("spans"),
        F.coalesce("found_items", "items").alias("items"))


def report(docs: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items, spans, contaminated`` per row of ``docs``."""
    found = scan(docs, benchmark, ["doc_id"], p)
    n_hit = F.aggregate(F.transform("spans", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)),
                        F.lit(0).cast("long"), lambda a, x: a + x)  # ends less starts
    return found.select(F.col("k0").alias("doc_id"), "n_words", n_hit.alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"), "items", "spans",
                        (F.size("spans") > 0).alias("contaminated"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows of ``docs`` without a hit word, all columns unchanged."""
    found = scan(docs, benchmark, docs.columns, p).filter("size(spans) = 0")
    return found.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(docs.columns)])
