"""SimHash near-duplicates: tiled exact comparison of fingerprints.

Comparing every fingerprint with every other one grows with the square of the
corpus.  The tiles are therefore laid inside blocks that share some of the 64
bits: with the bits cut into m pieces, two fingerprints that differ in at most
r bits agree in at least m - r whole pieces, so blocking by each choice of
m - r pieces meets every pair that may link and loses none.  Inside a block
the rows are sorted by population count and cut into tiles; a tile pair whose
population counts differ beyond the radius is skipped (fingerprints whose
counts differ by more than r differ in more than r bits), the others are
compared exactly with numpy exclusive-or and bit counts.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, space_words
from .components import components

BITS = 64


def fingerprint(words: list[bytes], shingle: int = 3, seed: int = 42) -> int:
    """Majority bits of the XXH64 of every shingle, repeats included; no words: 0."""
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(g, seed) for g in grams), np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(h), 1 << 16):  # a very long text takes bounded memory
        part = h[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3, seed: int = 42) -> DataFrame:
    """``(doc_id, text_hash, fp)`` of every row; ``fp`` holds the 64 bits as a signed long.

    Null, empty and blank texts have fingerprint zero.
    """
    def run(batches):
        for b in batches:
            fps = [fingerprint(space_words(t.as_py(), lower=True), shingle, seed) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(np.array(fps, np.uint64).view(np.int64))], names=["doc_id", "text_hash", "fp"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                        F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id long, text_hash long, fp long"))


def layout(n: int, radius: int, bucket: int, most_copies: int = 56) -> int:
    """Number of pieces m: the least whose blocks of n random fingerprints hold about ``bucket`` rows or fewer.

    More pieces mean longer block keys and more copies of a row; whatever m is, no pair is lost.
    """
    m = radius + 1
    while n > bucket << (BITS * (m - radius) // m) and comb(m + 1, radius) <= most_copies:
        m += 1
    return m


def _blocks(fps: DataFrame, radius: int, m: int) -> DataFrame:
    """One row per fingerprint and choice of m - radius pieces: ``(block, choice, pc, fp, node)``."""
    cuts = [BITS * i // m for i in range(m + 1)]
    masks = []
    for kept in combinations(range(m), m - radius):
        bits = sum(((1 << (cuts[i + 1] - cuts[i])) - 1) << cuts[i] for i in kept)
        masks.append(bits - (1 << 64) if bits >> 63 else bits)
    rows = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(x)).alias("block"))
                     for i, x in enumerate(masks)])
    return (fps.select("fp", "node", F.explode(rows).alias("b"))
            .select("b.choice", "b.block", F.bit_count("fp").cast("int").alias("pc"), "fp", "node"))


def tile_links(key: np.ndarray, pc: np.ndarray, fp: np.ndarray, radius: int, tile: int):
    """Index pairs that join all linked rows of equal ``key``; rows are sorted by (key, pc).

    Returns a spanning set: every linked pair is joined through returned pairs,
    but a dense tile pair gives a star per component, not all its pairs.
    """
    n, found = len(fp), []
    for i in range(0, n, tile):
        i_end = min(i + tile, n)
        for j in range(i, n, tile):
            j_end = min(j + tile, n)
            if j > i and (key[j] != key[i_end - 1] or pc[j] - pc[i_end - 1] > radius):
                break  # beyond the last block of tile i, or beyond the radius in population count
            near = np.bitwise_count(fp[i:i_end, None] ^ fp[None, j:j_end]) <= radius
            near &= key[i:i_end, None] == key[None, j:j_end]
            if i == j:
                near = np.triu(near, 1)
            a, b = np.nonzero(near)
            if len(a) <= 2 * tile:
                found.append((a + i, b + j))
                continue
            rows, cols = np.arange(i, i_end), np.arange(j, j_end)
            if i == j:
                near = near | near.T | np.eye(len(rows), dtype=bool)
            big = n
            while True:  # smallest row index reachable inside the tile pair
                new_cols = np.minimum(cols, np.where(near, rows[:, None], big).min(axis=0))
                new_rows = np.minimum(rows, np.where(near, new_cols[None, :], big).min(axis=1))
                if (new_cols == cols).all() and (new_rows == rows).all():
                    break
                rows, cols = new_rows, new_cols
            found.append((np.arange(i, i_end), rows))
            found.append((np.arange(j, j_end), cols))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def _link_task(radius: int, tile: int):
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches):
        left = None
        for b in batches:
            now = [b.column(c).to_numpy(zero_copy_only=False) for c in ("choice", "block", "pair", "pc", "fp", "node")]
            left = now if left is None else [np.concatenate(x) for x in zip(left, now)]
            head = left[0], left[1], left[2]
            edge = np.nonzero((head[0][1:] != head[0][:-1]) | (head[1][1:] != head[1][:-1]) | (head[2][1:] != head[2][:-1]))[0]
            if len(edge):
                at = edge[-1] + 1  # the last block may go on in the next batch
                yield from work([x[:at] for x in left])
                left = [x[at:] for x in left]
        if left is not None:
            yield from work(left)

    def work(cols):
        choice, block, pair, pc, fp, node = cols
        if len(fp) < 2:
            return
        new = (choice[1:] != choice[:-1]) | (block[1:] != block[:-1]) | (pair[1:] != pair[:-1])
        key = np.concatenate([[0], np.cumsum(new)])
        a, b = tile_links(key, pc, fp.view(np.uint64), radius, tile)
        keep = node[a] != node[b]
        if keep.any():
            u, v = node[a][keep], node[b][keep]
            pairs = np.unique(np.stack([np.maximum(u, v), np.minimum(u, v)], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=schema)

    return run


def links(nodes: DataFrame, radius: int = 3, tile: int = 128, bucket: int = 64, hot: int = 16384) -> DataFrame:
    """``nodes(fp, node)`` of distinct fingerprints -> ``(u, v)`` joining all within ``radius`` bits.

    A block of more than ``hot`` rows is dealt to several tasks: its rows fall
    into k shares of about ``hot`` rows, and each pair of shares is one group,
    so no task holds more than two shares and every pair still meets.
    """
    n = nodes.count()
    blocks = _blocks(nodes, radius, layout(n, radius, bucket))
    big = (blocks.groupBy("choice", "block").agg(F.count("*").alias("n")).filter(F.col("n") > hot)
           .select("choice", "block", F.ceil(F.col("n") / hot).cast("int").alias("k")))
    share = F.pmod(F.xxhash64("fp"), F.col("k")).cast("int")
    others = F.expr("sequence(0, coalesce(k, 1) - 1)")
    pairs = F.transform(others, lambda t: F.least(t, share) * F.col("k") + F.greatest(t, share))
    dealt = (blocks.join(big, ["choice", "block"], "left")
             .select("choice", "block", "pc", "fp", "node",
                     F.explode(F.when(F.col("k").isNull(), F.array(F.lit(0))).otherwise(pairs)).alias("pair")))
    return (dealt.repartition("choice", "block", "pair")
            .sortWithinPartitions("choice", "block", "pair", "pc", "fp")
            .mapInArrow(_link_task(radius, tile), "u long, v long"))


def _grouped(fps: DataFrame, radius: int) -> DataFrame:
    """``(fp, root)`` of every fingerprint, ``root`` the smallest fingerprint of its component.

    The fingerprints themselves are the nodes, whatever ids hold them: rows
    that share an id are not joined by it, and rows without one join others.
    """
    nodes = cut_lineage(fps.select("fp").distinct().select("fp", F.col("fp").alias("node")), "nodes")
    roots = components(links(nodes, radius))
    return nodes.join(roots, "node", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    radius: int = 3, seed: int = 42) -> DataFrame:
    """``(doc_id, fp, component_id)`` per row of ``docs``; other columns are left out.

    ``component_id`` is the smallest doc_id reachable over fingerprints that
    differ in at most ``radius`` bits, the row's own included.  Rows whose
    doc_id is null belong to their component like any other; a component of
    such rows alone has the id null.  An id that several texts share is in the
    component of each of them and joins none.  Repeated rows give repeated
    result rows; an empty table gives an empty result.
    """
    fps = cut_lineage(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    grouped = cut_lineage(_grouped(fps, radius), "grouped")
    least = (fps.groupBy("fp").agg(F.min("doc_id").alias("least")).join(grouped, "fp")
             .groupBy("root").agg(F.min("least").alias("component_id")))
    named = grouped.join(least, "root").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_representatives(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` with one row per component: the smallest by (doc_id, hash of the text), a null doc_id last.

    All columns are kept.  Rows that repeat doc_id and text are one document,
    of which any one row stays; two texts under one doc_id are two documents.
    """
    fps = cut_lineage(fingerprints(docs, shingle=shingle), "fingerprints")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    kept = (fps.groupBy("fp").agg(F.min(place).alias("least")).join(_grouped(fps, radius), "fp")
            .groupBy("root").agg(F.min("least").alias("least")))
    kept = kept.select(F.col("least.doc_id").alias("__id"), F.col("least.text_hash").alias("__hash"))
    marked = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"),
                         F.xxhash64("text").alias("hash"))
    one = (marked.join(kept, F.col("id").eqNullSafe(F.col("__id")) & (F.col("hash") == F.col("__hash")), "left_semi")
           .dropDuplicates(["id", "hash"]))
    return one.select(*[F.col("row")[c].alias(c) for c in docs.columns])
