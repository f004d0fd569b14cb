"""Spelling variants: words one edit apart, found by probing Bloom filters with generated edits.

The vocabulary is counted over all texts and split by length.  Each length has
a blocked Bloom filter (blocks of 256 bits, eight of them set by a word inside
its one block), broadcast to the tasks that hold the words.  A task generates
the deletions and replacements of its words as hashes, by arithmetic on the
word's own hash, and looks them up.  Insertions need not be generated: they are
the other word's deletions; and of two words that differ in one character only
the one with the smaller character asks.  What the filters let through, two
hashes a row, is shuffled to an exact join with the vocabulary, where the
strings themselves are compared.

A round broadcasts at most ``Params.filter_bytes``: lengths are taken round by
round, and a length whose filter alone is larger is divided by hash.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, cut_lineage

# Characters of words after lower-casing A-Z: a to z and U+00C0 to U+00FF.
ALPHABET = np.concatenate([np.arange(0x61, 0x7B), np.arange(0xC0, 0x100)]).astype(np.uint64)
RUNS = "[a-zÀ-ÿ]{%d,}"
BASE = 0x9E6C63D0876A9A99                      # odd, so that it has an inverse modulo 2^64
INVERSE = pow(BASE, -1, 2 ** 64)
SALTS = (np.random.default_rng(12).integers(0, 2 ** 31, 8, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
LOW32 = np.uint64(0xFFFFFFFF)


@dataclass(frozen=True)
class Params:
    least_length: int = 6
    least_count: int = 5
    ratio: int = 5               # a form occurs at least so many times as often as the word
    every: int = 199             # of the hashed slips; 0 makes none
    bits: int = 16               # of the filters, a word
    filter_bytes: int = 1 << 24  # broadcast in a round
    last_length: int = 64        # this and longer lengths share a filter
    flush: int = 200_000         # words counted by a task before it hands them on


def counted(doc_id: int | None, text: str | None, p: Params = Params()) -> Counter:
    """Words of a text of at least ``least_length`` code points.

    Where the unsigned crc32 of ``<doc_id>:<run>`` is a multiple of ``every``,
    the run loses one code point; a null id stands as the empty string.
    """
    out = Counter()
    if not text:
        return out
    head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    runs = Counter(re.findall(RUNS % p.least_length, text.encode().lower().decode()))  # bytes.lower() knows A-Z alone
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), head)
        if p.every and h % p.every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < p.least_length:
                continue
        out[run] += n
    return out


def _count_task(p: Params):
    def give(found):
        return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())],
                                          names=["word", "n"])

    def run(batches):
        found = Counter()
        for b in batches:
            for i, t in zip(b.column(0), b.column(1)):
                found.update(counted(i.as_py(), t.as_py(), p))
                if len(found) >= p.flush:
                    yield give(found)
                    found.clear()
        yield give(found)

    return run


def _mix(x: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    x = x + np.uint64(0x632BE59BD9B4E019) * np.asarray(length, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(length: int) -> np.ndarray:
    return np.concatenate([[np.uint64(1)], np.cumprod(np.full(length - 1, BASE, np.uint64))]) if length else np.empty(0, np.uint64)


def _by_length(words: list[str]):
    """(positions in ``words``, code points as a matrix) for every length."""
    lengths = np.array([len(w) for w in words], np.int64)
    for length in np.unique(lengths):
        at = np.nonzero(lengths == length)[0]
        raw = "".join(words[i] for i in at).encode("utf-32-le")
        yield at, np.frombuffer(raw, "<u4").reshape(len(at), length).astype(np.uint64)


def hashes(words: list[str]) -> np.ndarray:
    """64-bit hash of each word."""
    out = np.zeros(len(words), np.uint64)
    for at, codes in _by_length(words):
        out[at] = _mix((codes * _powers(codes.shape[1])).sum(axis=1, dtype=np.uint64), codes.shape[1])
    return out


def edits(codes: np.ndarray, deletions: bool, replacements: bool, step: int = 20_000):
    """Hashes of words of one length after one edit: (row, hash, length), a block of edits at a time.

    Replacements are made upwards only, by characters greater than the one they replace.
    """
    m, length = codes.shape
    parts = codes * _powers(length)
    upto = np.cumsum(parts, axis=1, dtype=np.uint64)
    row, place = np.divmod(np.arange(m * length), length)
    for i in range(0, len(row), step):
        r, c = row[i:i + step], place[i:i + step]
        if deletions:
            rest = upto[r, c] - parts[r, c] + (upto[r, -1] - upto[r, c]) * np.uint64(INVERSE)
            yield r, _mix(rest, length - 1), length - 1
        if replacements:
            old = codes[r, c]
            new = upto[r, -1][:, None] + (ALPHABET[None, :] - old[:, None]) * _powers(length)[c][:, None]
            up = ALPHABET[None, :] > old[:, None]
            yield r[np.nonzero(up)[0]], _mix(new[up], length), length


@dataclass
class Piece:
    """The Bloom filter of one length, or of a share of it by hash."""
    shard: int
    part: int
    parts: int
    blocks: int
    words: np.ndarray | None = None   # blocks x 8 of 32 bits

    def places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        block = ((h >> np.uint64(32)) * np.uint64(self.blocks)) >> np.uint64(32)
        return block.astype(np.int64), h & LOW32

    @staticmethod
    def bit(low: np.ndarray, i: int) -> np.ndarray:
        return (np.uint64(1) << (((low * SALTS[i]) & LOW32) >> np.uint64(27))).astype(np.uint32)

    def holds(self, h: np.ndarray) -> np.ndarray:
        """Indexes of the hashes that may be words of the piece."""
        at = np.arange(len(h)) if self.parts == 1 else np.nonzero(h % np.uint64(self.parts) == self.part)[0]
        block, low = self.places(h[at])
        for i in range(8):
            bit = self.bit(low, i)
            passed = (self.words[block, i] & bit) != 0
            at, block, low = at[passed], block[passed], low[passed]
        return at


def plan(sizes: dict[int, int], p: Params) -> list[list[Piece]]:
    """Rounds of pieces; each round's filters hold at most ``filter_bytes`` (or one block)."""
    most = max(p.filter_bytes // 32, 1)
    pieces = []
    for shard, n in sorted(sizes.items()):
        blocks = -(-n * p.bits // 256)
        parts = -(-blocks // most)
        pieces += [Piece(shard, i, parts, -(-blocks // parts)) for i in range(parts)]
    rounds, room = [], 0
    for piece in pieces:
        if not rounds or piece.blocks > room:
            rounds.append([])
            room = most
        rounds[-1].append(piece)
        room -= piece.blocks
    return rounds


def _fill_task(pieces: list[Piece]):
    schema = pa.schema([("piece", pa.int32()), ("block", pa.int64())] + [(f"w{i}", pa.int64()) for i in range(8)])

    def run(batches):
        for b in batches:
            shard = b.column("shard").to_numpy()
            h = b.column("h").to_numpy().view(np.uint64)
            for k, piece in enumerate(pieces):
                mine = (shard == piece.shard) & (h % np.uint64(piece.parts) == piece.part)
                if mine.any():
                    block, low = piece.places(h[mine])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(block), k), pa.int32()), pa.array(block)]
                        + [pa.array(piece.bit(low, i).astype(np.int64)) for i in range(8)], schema=schema)

    return run


def build(vocabulary: DataFrame, pieces: list[Piece]) -> Shared:
    """Fill the filters of a round: bits are joined in Spark, at most ``filter_bytes`` come back."""
    schema = "piece int, block long, " + ", ".join(f"w{i} long" for i in range(8))
    shards = sorted({x.shard for x in pieces})
    rows = (vocabulary.filter(F.col("shard").isin(shards)).select("shard", "h").mapInArrow(_fill_task(pieces), schema)
            .groupBy("piece", "block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(8)])
            .select("piece", "block", *[F.col(f"w{i}").cast("long") for i in range(8)]).toArrow())
    which, block = (rows.column(i).to_numpy() for i in range(2))
    bits = np.stack([rows.column(2 + i).to_numpy() for i in range(8)], axis=1).astype(np.uint32)
    for k, piece in enumerate(pieces):
        piece.words = np.zeros((piece.blocks, 8), np.uint32)
        piece.words[block[which == k]] = bits[which == k]
    return Shared(vocabulary.sparkSession, pieces)


def _probe_task(sent: Shared, p: Params):
    schema = pa.schema([("h", pa.int64()), ("edit", pa.int64())])

    def run(batches):
        by_shard = {}
        for piece in sent.value:
            by_shard.setdefault(piece.shard, []).append(piece)
        shard_of = lambda length: min(length, p.last_length)
        for b in batches:
            own = b.column("h").to_numpy()
            for at, codes in _by_length(b.column("word").to_pylist()):
                length = codes.shape[1]
                wanted = shard_of(length - 1) in by_shard, shard_of(length) in by_shard
                for row, h, long in edits(codes, *wanted):
                    for piece in by_shard[shard_of(long)]:
                        hit = piece.holds(h)
                        if len(hit):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(own[at[row[hit]]]), pa.array(h[hit].view(np.int64))], schema=schema)

    return run


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", p: Params = Params()) -> DataFrame:
    """The vocabulary: ``(word, n, shard, h)``, counted over all texts."""
    def sign(batches):
        for b in batches:
            found = b.column("word").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column("word"), b.column("n"), pa.array([min(len(w), p.last_length) for w in found], pa.int32()),
                 pa.array(hashes(found).view(np.int64))], names=["word", "n", "shard", "h"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(_count_task(p), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= p.least_count)
            .mapInArrow(sign, "word string, n long, shard int, h long"))


def near_pairs(vocabulary: DataFrame, p: Params = Params()) -> DataFrame:
    """``(a, na, b, nb)``: each pair of words one edit apart, once."""
    sizes = {r["shard"]: r["count"] for r in vocabulary.groupBy("shard").count().collect()}  # at most last_length rows
    hits = None
    for pieces in plan(sizes, p):
        shards = {x.shard for x in pieces}
        asking = sorted(shards | {s + 1 for s in shards if s < p.last_length})
        sent = build(vocabulary, pieces)
        found = cut_lineage(
            vocabulary.filter(F.col("shard").isin(asking)).select("word", "h")
            .mapInArrow(_probe_task(sent, p), "h long, edit long").distinct(), "spelling_hits")
        sent.release()
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        hits = vocabulary.select("h", F.col("h").alias("edit"))
    a = vocabulary.select("h", F.col("word").alias("a"), F.col("n").alias("na"))
    b = vocabulary.select(F.col("h").alias("edit"), F.col("word").alias("b"), F.col("n").alias("nb"))
    return (hits.join(b, "edit").join(a, "h").filter(F.levenshtein("a", "b", 1) == 1)
            .select("a", "na", "b", "nb").distinct())


def _roots(forms: DataFrame) -> DataFrame:
    """``forms(word, form)`` -> ``(word, root)``; each round doubles the steps followed."""
    state = cut_lineage(forms.select("word", F.col("form").alias("root")), "spelling_roots")
    while True:
        onward = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = cut_lineage(state.join(onward, "root", "left").select("word", "root", "next"), "spelling_roots")
        if moved.filter("next is not null").isEmpty():
            return moved.select("word", "root")
        state = moved.select("word", F.coalesce("next", "root").alias("root"))


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", p: Params = Params()) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` per word; other columns of ``docs`` are left out.

    Null and empty texts hold no words, repeated rows count again, a null id
    enters the hash of the slips as the empty string.  Near words of equal
    count: the smallest in code-point order is the form.  An empty table gives
    an empty result.
    """
    vocabulary = cut_lineage(words(docs, id_col, text_col, p), "spelling_words")
    pairs = cut_lineage(near_pairs(vocabulary, p), "spelling_pairs")
    both = pairs.select(F.col("a").alias("word"), "na", "b", "nb").unionByName(
        pairs.select(F.col("b").alias("word"), F.col("nb").alias("na"), F.col("a").alias("b"), F.col("na").alias("nb")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"),
                                    F.min(F.struct((-F.col("nb")).alias("n"), F.col("b").alias("b"))).alias("best"))
    form_n = -F.col("best.n")
    strong = form_n >= p.ratio * F.col("n")
    found = cut_lineage(
        vocabulary.select("word", "n").join(best, "word", "left")
        .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                F.when(strong, F.col("best.b")).alias("form"), F.when(strong, form_n).alias("form_n")), "spelling_forms")
    roots = _roots(found.filter("form is not null").select("word", "form"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
