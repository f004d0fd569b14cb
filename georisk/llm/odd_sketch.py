"""MinHash near-duplicates whose candidates are verified by odd sketches, then on the full sets.

A document is the set of its distinct shingles.  Minimum hashes of the set are
cut into bands; sets that agree in a whole band meet in a bucket.  Sets that
share a bucket get an odd sketch: ``samples`` minimum hashes are folded into a
bitmap of parities, where each sample flips one bit.  Two bitmaps differ where a
sample differs, so the population count of their exclusive-or estimates the
distance of two sets, and best where they are nearly equal.  A candidate within
the cut (`Params.cut`) is compared on the full sets of 64-bit shingle hashes.

Nothing emits all pairs of a bucket:

1. Equal sets are one node, whatever their number.
2. Every member of a bucket is paired with the bucket's smallest node, so a
   group of near copies costs one row per member and bucket.
3. Buckets whose members lie in more than one component are compared in full,
   tile by tile in numpy.  A node's partners are ordered by distance; a round
   names a slice of them, those outside its own component.  What is confirmed
   joins components, so that later slices have less to name; slices grow
   eightfold, and rounds end when every node has come to its last partner, so
   no link is lost.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, space_words
from .components import components


@dataclass(frozen=True)
class Params:
    shingle: int = 3
    percent: int = 85        # least similarity: 100 * intersection >= percent * union
    bands: int = 28
    rows: int = 5            # a pair of that similarity meets in no band with chance 7e-8
    samples: int = 2048      # minimum hashes of a sketch
    bits: int = 4096         # of the odd sketch
    sigmas: float = 5.5      # the sketch refutes only what lies this far beyond the threshold: chance 2e-8
    partners: int = 8        # ranks of the first slice
    hot: int = 4096          # a larger bucket is dealt as pairs of shares of this many rows
    tile: int = 64

    def cut(self) -> int:
        """Most differing bits of a pair at the threshold: the expected count and ``sigmas`` deviations.

        A sample differs with chance 1 - similarity and then flips two bits;
        f flips leave bits / 2 * (1 - (1 - 2 / bits) ** f) of them odd.
        """
        m, far = self.bits, 1 - self.percent / 100
        flips = 2 * self.samples * far
        one, two = (1 - 2 / m) ** flips, (1 - 4 / m) ** flips
        mean = m / 2 * (1 - one)
        folded = m * (m - 1) / 4 * (1 - 2 * one + two) + mean - mean * mean   # variance for a fixed number of flips
        spread = folded + 4 * one * one * self.samples * far * (1 - far)      # and that of the number itself
        return int(mean + self.sigmas * sqrt(spread)) + 1


def shingle_hashes(words: list[bytes], shingle: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; fewer words make one shingle, none an empty set."""
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= shingle:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64)
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    return np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, grams), np.uint64, len(words) - shingle + 1))


def _mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Sampler:
    """``size`` minimum hashes of a set; every sample is a bijection of the upper half of the shingle hashes."""

    def __init__(self, size: int, seed: int):
        draw = np.random.default_rng(seed)
        self.flip = draw.integers(0, 2 ** 32, size, dtype=np.uint32)[:, None]
        self.times = draw.integers(0, 2 ** 32, size, dtype=np.uint32)[:, None] | np.uint32(1)

    def minima(self, grams: np.ndarray) -> np.ndarray:
        half = (grams >> np.uint64(32)).astype(np.uint32)
        low = np.full(len(self.flip), np.iinfo(np.uint32).max, np.uint32)
        step = max(1, (1 << 18) // len(low))   # a long text takes bounded memory
        for at in range(0, len(half), step):
            part = half[None, at:at + step] ^ self.flip
            part *= self.times
            part ^= part >> np.uint32(15)
            np.minimum(low, part.min(axis=1), out=low)
        return low


def band_keys(low: np.ndarray, p: Params) -> np.ndarray:
    raw, r = low.tobytes(), 4 * p.rows
    return np.array([xxhash.xxh64_intdigest(raw[r * i:r * (i + 1)], i) for i in range(p.bands)], np.uint64).view(np.int64)


def odd_sketch(low: np.ndarray, p: Params) -> np.ndarray:
    """Parities of the samples' bits, packed into 64-bit words."""
    at = (_mix(low + (np.arange(len(low), dtype=np.uint64) << np.uint64(32))) % np.uint64(p.bits)).astype(np.int64)
    odd = np.bincount(at, minlength=p.bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def _sign_task(p: Params):
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("text_key", pa.int64()), ("n", pa.int64()),
                        ("set_key", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(batches):
        sampler = Sampler(p.bands * p.rows, 11)
        for b in batches:
            n, keys, bands, seen = [], [], [], {}
            for t in b.column(3):
                t = t.as_py()
                made = seen.get(t)
                if made is None:
                    grams = shingle_hashes(space_words(t, lower=True), p.shingle)
                    if len(grams):
                        made = (len(grams), xxhash.xxh3_128_digest(grams.tobytes()), band_keys(sampler.minima(grams), p))
                    else:
                        made = (0, None, None)
                    seen = {t: made}  # copies often stand side by side
                n.append(made[0])
                keys.append(made[1])
                bands.append(made[2])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(bands, schema.field("bands").type)], schema=schema)

    return run


def _sketch_task(p: Params):
    schema = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("sketch", pa.binary()),
                        ("bands", pa.list_(pa.int64())), ("text", pa.string())])

    def run(batches):
        sampler = Sampler(p.samples, 12)
        for b in batches:
            n, sketches = [], []
            for t in b.column(1):
                grams = shingle_hashes(space_words(t.as_py(), lower=True), p.shingle)
                n.append(len(grams))
                sketches.append(odd_sketch(sampler.minima(grams), p).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(sketches, pa.binary()),
                                              b.column(2).cast(schema.field("bands").type), b.column(1)], schema=schema)

    return run


def signatures(docs: DataFrame, p: Params, id_col: str, text_col: str) -> DataFrame:
    """One row per document: set size, key of its set and band keys (null for empty sets)."""
    return (docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                        F.xxhash64(text_col).alias("text_key"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(_sign_task(p), "row long, doc_id long, text_key long, n long, set_key binary, bands array<long>"))


def _sketches(column: pa.Array) -> np.ndarray:
    """Sketches of a batch, a row of 64-bit words each."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), -1)


def _may_link_task(p: Params):
    """Pairs whose sizes and sketches allow the similarity."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            nu, nv = b.column("nu").to_numpy(), b.column("nv").to_numpy()
            far = np.bitwise_count(_sketches(b.column("su")) ^ _sketches(b.column("sv"))).sum(axis=1, dtype=np.int64)
            near = (100 * np.minimum(nu, nv) >= p.percent * np.maximum(nu, nv)) & (far <= p.cut())
            yield pa.RecordBatch.from_arrays([b.column("u").filter(pa.array(near)), b.column("v").filter(pa.array(near))],
                                             schema=schema)

    return run


def _verify_task(p: Params):
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("linked", pa.bool_())])

    def run(batches):
        last, right = None, None
        for b in batches:
            out = []
            for u, v, tu, tv in zip(*(b.column(i) for i in range(4))):
                v = v.as_py()
                if v != last:  # rows are sorted by v: a pivot is split into shingles once
                    last, right = v, shingle_hashes(space_words(tv.as_py(), lower=True), p.shingle)
                left = shingle_hashes(space_words(tu.as_py(), lower=True), p.shingle)
                both = len(np.intersect1d(left, right, assume_unique=True))
                out.append((u.as_py(), v, 100 * both >= p.percent * (len(left) + len(right) - both)))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)] if out else
                                             [pa.array([], f.type) for f in schema], schema=schema)

    return run


def confirm(pairs: DataFrame, texts: DataFrame, p: Params) -> DataFrame:
    """``pairs(u, v)`` and ``texts(node, text)`` -> ``(u, v, linked)`` by the full shingle sets."""
    left = texts.select(F.col("node").alias("u"), F.col("text").alias("tu"))
    right = texts.select(F.col("node").alias("v"), F.col("text").alias("tv"))
    return (pairs.join(left, "u").join(right, "v").select("u", "v", "tu", "tv")
            .sortWithinPartitions("v").mapInArrow(_verify_task(p), "u long, v long, linked boolean"))


def partners_outside(key, band, comp, n, node, sketch, bands, p: Params, start: int, stop: int):
    """Rows sorted by (key, n): pairs of rows of equal key whose sketches are near and whose components differ.

    A row's near rows are ordered by distance, whatever their component, and
    those at ranks ``start`` to ``stop`` are named; a pair that meets in several
    bands is named in the first.  Returns row indexes (a, b), and the keys in
    which a row has partners beyond ``stop``.
    """
    cut, found, beyond = p.cut(), [], []
    first, end = np.searchsorted(key, key, "left"), np.searchsorted(key, key, "right")
    for i in range(0, len(key), p.tile):
        rows = slice(i, min(i + p.tile, len(key)))
        lo, hi = first[i], end[rows.stop - 1]
        outside = comp[rows, None] != comp[None, lo:hi]
        small, large = np.minimum(n[rows, None], n[None, lo:hi]), np.maximum(n[rows, None], n[None, lo:hi])
        near = (key[rows, None] == key[None, lo:hi]) & (100 * small >= p.percent * large)
        asks = np.nonzero((near & outside).any(axis=1))[0]
        if not len(asks):
            continue
        near, outside, at = near[asks], outside[asks], i + asks
        far = np.zeros(near.shape, np.int32)
        for w in range(sketch.shape[1]):
            far += np.bitwise_count(sketch[at, w][:, None] ^ sketch[None, lo:hi, w])
        near &= (far <= cut) & (at[:, None] != np.arange(lo, hi)[None, :])
        a, b = np.nonzero(near & outside)
        if not len(a):
            continue
        asks = np.unique(a)
        near[np.setdiff1d(np.arange(len(at)), asks)] = False
        a, b = np.nonzero(near)
        order = np.lexsort((node[lo + b], far[a, b], a))
        a, b = a[order], b[order]
        rank = np.arange(len(a)) - np.searchsorted(a, a, "left")
        wanted = outside[a, b]
        beyond.append(key[at[a[wanted & (rank >= stop)]]])
        wanted &= (rank >= start) & (rank < stop)
        a, b = at[a[wanted]], lo + b[wanted]
        own = (bands[a] == bands[b]).argmax(axis=1) == band[a]
        found.append((a[own], b[own]))
    none = np.empty(0, np.int64)
    a, b = (np.concatenate(x) for x in zip(*found)) if found else (none, none)
    return a, b, np.unique(np.concatenate(beyond)) if beyond else none


def _partner_task(p: Params, start: int, stop: int):
    """Pairs (u, v) named, and a row with null ends for each bucket that has more."""
    schema = pa.schema([("key", pa.int64()), ("u", pa.int64()), ("v", pa.int64())])
    names = ("key", "part", "band", "comp", "n", "node")

    def work(cols, sketch, bands):
        key, part, band, comp, n, node = cols
        if len(key) < 2:
            return
        new = (key[1:] != key[:-1]) | (part[1:] != part[:-1])
        group = np.concatenate([[0], np.cumsum(new)])
        a, b, more = partners_outside(group, band, comp, n, node, sketch, bands, p, start, stop)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(key[a]), pa.array(node[a]), pa.array(node[b])], schema=schema)
        if len(more):
            none = pa.nulls(len(more), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(key[np.searchsorted(group, more)]), none, none], schema=schema)

    def run(batches):
        left = None
        for b in batches:
            if not b.num_rows:
                continue
            now = [b.column(c).to_numpy(zero_copy_only=False) for c in names]
            now += [_sketches(b.column("sketch")), b.column("bands").flatten().to_numpy().reshape(b.num_rows, -1)]
            left = now if left is None else [np.concatenate(x) for x in zip(left, now)]
            edge = np.nonzero((left[0][1:] != left[0][:-1]) | (left[1][1:] != left[1][:-1]))[0]
            if len(edge):
                at = edge[-1] + 1  # the last bucket may go on in the next batch
                yield from work([x[:at] for x in left[:6]], left[6][:at], left[7][:at])
                left = [x[at:] for x in left]
        if left is not None:
            yield from work(left[:6], *left[6:])

    return run


def partners(members: DataFrame, signs: DataFrame, labels: DataFrame, p: Params, start: int, stop: int) -> DataFrame:
    """``(key, u, v)`` of buckets with several components: partners ranked from ``start`` to ``stop``.

    A bucket of more than ``hot`` rows is dealt to several tasks: its rows fall
    into shares, each pair of shares is one group, so every pair still meets.
    """
    named = (members.join(labels, "node", "left")
             .select("key", "band", "node", F.coalesce("root", "node").alias("comp")))
    open_ = (named.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("c"))
             .filter("lo < hi").select("key", F.ceil(F.col("c") / p.hot).cast("int").alias("k")))
    share = F.pmod(F.xxhash64("node"), F.col("k")).cast("int")
    parts = F.transform(F.expr("sequence(0, k - 1)"), lambda t: F.least(t, share) * F.col("k") + F.greatest(t, share))
    rows = named.join(open_, "key").select("key", "band", "node", "comp", F.explode(parts).alias("part"))
    return (rows.join(signs, "node").select("key", "part", "band", "comp", "n", "node", "sketch", "bands")
            .repartition("key", "part").sortWithinPartitions("key", "part", "n", "node")
            .mapInArrow(_partner_task(p, start, stop), "key long, u long, v long"))


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels(node, root)`` after the further ``links(u, v)``: only their roots are joined anew."""
    a = labels.select(F.col("node").alias("u"), F.col("root").alias("ru"))
    b = labels.select(F.col("node").alias("v"), F.col("root").alias("rv"))
    ends = links.join(a, "u", "left").join(b, "v", "left")
    up = components(ends.select(F.coalesce("ru", "u").alias("u"), F.coalesce("rv", "v").alias("v")))
    moved = labels.join(up.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left")
    moved = moved.select("node", F.coalesce("to", "root").alias("root"))
    fresh = up.join(labels, "node", "left_anti").select("node", "root")
    return cut_lineage(moved.unionByName(fresh), "odd_labels")


def _unordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    p: Params = Params()) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` per row of ``docs``; other columns are left out.

    ``component_id`` is the smallest doc_id reachable over links, the row's own
    included; ``kept`` says that the row carries it.  Null and blank texts have
    no shingle and no link.  Rows with null ids link like others and take the
    component's smallest id; where a component has no id at all, component_id
    is null and its rows are kept, since no id can name the one to stay.
    Repeated ids and rows give a result row each.  An empty table gives an
    empty result.  Shingles are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    rows = cut_lineage(signatures(docs, p, id_col, text_col), "odd_signatures")
    nodes = cut_lineage(
        rows.filter("n > 0").groupBy("set_key")
        .agg(F.min("row").alias("node"), F.min("doc_id").alias("first_id")), "odd_nodes")
    own = rows.join(nodes.select(F.col("node").alias("row")), "row", "left_semi")
    banded = own.select(F.col("row").alias("node"), F.posexplode("bands").alias("band", "key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("c"), F.min("node").alias("pivot")).filter("c > 1")
    members = cut_lineage(banded.join(shared.drop("c"), "key"), "odd_members")

    meets = members.select("node").distinct()
    needed = rows.join(meets, rows["row"] == meets["node"], "left_semi")
    wanted = needed.select(F.col("row").alias("node"), "text_key", "doc_id", "bands")
    found = docs.select(F.xxhash64(text_col).alias("text_key"), F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).cast("string").alias("text"))
    same = (found["text_key"] == wanted["text_key"]) & found["doc_id"].eqNullSafe(wanted["doc_id"])
    sketched = cut_lineage(
        found.join(wanted, same).select("node", "text", "bands").dropDuplicates(["node"])
        .mapInArrow(_sketch_task(p), "node long, n long, sketch binary, bands array<long>, text string"), "odd_texts")
    signs, texts = sketched.select("node", "n", "sketch", "bands"), sketched.select("node", "text")

    def candidates(pairs):
        a = signs.select(F.col("node").alias("u"), F.col("n").alias("nu"), F.col("sketch").alias("su"))
        b = signs.select(F.col("node").alias("v"), F.col("n").alias("nv"), F.col("sketch").alias("sv"))
        return (pairs.join(a, "u").join(b, "v").select("u", "v", "nu", "nv", "su", "sv")
                .mapInArrow(_may_link_task(p), "u long, v long"))

    pivots = _unordered(members.filter("node <> pivot").select(F.col("node").alias("u"), F.col("pivot").alias("v")))
    judged = cut_lineage(confirm(candidates(pivots), texts, p), "odd_judged")
    labels = cut_lineage(components(judged.filter("linked").select("u", "v")), "odd_labels")
    members, tried, start, stop = members.drop("pivot"), judged.select("u", "v"), 0, p.partners
    while True:
        named = cut_lineage(partners(members, signs, labels, p, start, stop), "odd_partners")
        fresh = _unordered(named.filter("u is not null")).join(tried, ["u", "v"], "left_anti")
        judged = cut_lineage(confirm(fresh, texts, p), "odd_judged")
        labels = _merged(labels, judged.filter("linked").select("u", "v"))
        more = named.filter("u is null").select("key").distinct()
        if more.isEmpty():
            break  # every node has named all its partners, and all of them are judged
        tried = tried.unionByName(judged.select("u", "v"))
        members = cut_lineage(members.join(more, "key", "left_semi"), "odd_members")
        start, stop = stop, 8 * stop

    of = nodes.join(labels, "node", "left").select("set_key", "first_id", F.coalesce("root", "node").alias("root"))
    least = of.groupBy("root").agg(F.min("first_id").alias("component"))
    named = of.join(least, "root").select("set_key", "component")
    whole = rows.select("doc_id", "n", "set_key").join(named, "set_key", "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    kept = component.isNull() | F.coalesce(F.col("doc_id") == component, F.lit(False))
    return whole.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), kept.alias("kept"))


def keep_representatives(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """``docs`` with the rows whose doc_id names their component, and rows without id whose component has none."""
    kept = near_duplicates(docs, p=p).filter("kept").select(F.col("doc_id").alias("__kept")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["__kept"]), "left_semi")
