"""Removal of repeated passages by a sparse suffix array.

A suffix array over all words of the corpus is mostly wasted: to find passages
of ``min_words`` words it is enough to retain the suffixes at content-selected
positions.  Every run of ``min_words`` words selects one of its first
``window`` positions, that with the smallest hash of ``order`` words (a
minimiser), so two copies of a passage select the same place.

1. Per document, retain the suffixes at the selected positions.  The hash of
   their first ``prefix`` = min_words - window + 1 words is the sort key; two
   suffixes that agree on that many words are neighbours in its order.
2. Compare neighbours: a suffix alone under its key repeats nothing and goes.
3. Extend the others left and right: each run of ``min_words`` words that
   selected the suffix reaches up to window - 1 words to its left and the rest
   to its right.  Runs equal in both directions are repeats; overlapping
   repeated runs join into one passage of any length.

Of the occurrences of a run the first one, by doc_id and position, stays; the
words of all later ones that don't overlap it are repeated.  So every passage
of at least ``min_words`` words that occurs earlier is found whole, and one
copy of its words is always kept.  Texts that are equal as a whole are handled as one text
in steps 2 and 3: the copy with the smallest doc_id stands for all.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, space_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NO_ID = (1 << 63) - 1  # stands for a null doc_id: it comes last
BASES = (0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1)


@dataclass(frozen=True)
class Params:
    """Passage length in words, selection window, and words hashed to select; order <= min_words - window + 1.

    A key with more than ``split`` suffixes is compared in shares of about that size.
    """

    min_words: int = 50
    window: int = 32
    order: int = 4
    split: int = 256

    @property
    def prefix(self) -> int:
        return self.min_words - self.window + 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Suffixes:
    """Hashes of the word runs of one text, and the suffix that each run of min_words words selects."""

    def __init__(self, words: list[bytes], p: Params):
        self.p, n = p, len(words)
        digest = xxhash.xxh64_intdigest
        h = np.fromiter(map(digest, words), np.uint64, n)
        self.sums, self.scale = [], []
        for base in BASES:
            steps = np.full((2, n), [[base], [pow(base, -1, 1 << 64)]], np.uint64)
            steps[:, 0] = 1
            power, back = np.cumprod(steps, axis=1)  # modulo 2^64
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * power, dtype=np.uint64)]))
            self.scale.append(back)
        rank = self.run_hash(np.arange(n - p.order + 1), p.order, 0)
        seen = np.lib.stride_tricks.sliding_window_view(rank[:n - p.min_words + p.window], p.window)
        self.selected = np.arange(len(seen)) + np.argmin(seen, axis=1)  # of the run that starts here
        self.at = np.unique(self.selected)
        self.keys = self.run_hash(self.at, p.prefix, 0).view(np.int64)

    def run_hash(self, at: np.ndarray, length: int, which: int) -> np.ndarray:
        s = self.sums[which]
        return _mix((s[at + length] - s[at]) * self.scale[which][at])


def _entries(docs: DataFrame, p: Params) -> DataFrame:
    """One row per text (``key`` null, ``n`` its words) and one per key of a retained suffix (``n`` its places)."""
    names = ["key", "th", "doc", "th2", "n"]

    def run(batches):
        for b in batches:
            key, th, doc, th2, count = [], [], [], [], []
            for d, h, h2, t in zip(*(c.to_pylist() for c in b.columns)):
                words = space_words(t)
                keys, places = [], []
                if len(words) >= p.min_words:  # a text that repeats a word or phrase has many equal suffixes
                    keys, places = np.unique(Suffixes(words, p).keys, return_counts=True)
                key.append(pa.array([None, *keys], pa.int64()))
                th.append(np.full(len(keys) + 1, h, np.int64))
                pad = [None] * len(keys)
                doc.append(pa.array([d, *pad], pa.int64()))
                th2.append(pa.array([h2, *pad], pa.int64()))
                count.append(pa.array([len(words), *places], pa.int64()))
            if key:
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays(key), pa.array(np.concatenate(th)), *map(pa.concat_arrays, (doc, th2, count))],
                    names=names)

    return _identified(docs).select("doc", "th", "th2", "text").mapInArrow(
        run, "key long, th long, doc long, th2 long, n long")


def _identified(docs: DataFrame) -> DataFrame:
    """``doc`` and two hashes of the text beside the columns of ``docs``, here as one struct."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), text.alias("text"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
                       F.xxhash64(text).alias("th"), F.xxhash64(F.lit(1), text).alias("th2"))


def _suffixes(texts: DataFrame, p: Params) -> DataFrame:
    """The suffixes that have neighbours, each with the hashes of the runs that selected it.

    Those runs start at consecutive words, the first at ``pos``.  Suffixes of a
    frequent key are dealt to ``share``s by text.
    """
    names = ["key", "share", "split", "doc", "th", "th2", "pos", "runs"]

    def run(batches):
        for b in batches:
            for d, h, h2, t, shared, often in zip(*(c.to_pylist() for c in b.columns)):
                s = Suffixes(space_words(t), p)
                used = np.isin(s.keys, np.array(shared, np.int64))
                starts = np.searchsorted(s.selected, s.at)  # selected is sorted: runs of a suffix are neighbours
                ends = np.append(starts[1:], len(s.selected))
                shares = {x["key"]: x["k"] for x in often}
                key = s.keys[used]
                k = np.array([shares.get(x, 1) for x in key.tolist()], np.int64)
                n = len(key)
                hashes = s.run_hash(np.arange(len(s.selected)), p.min_words, 1).view(np.int64)
                own = np.repeat(used, ends - starts)
                bounds = np.concatenate([[0], np.cumsum((ends - starts)[used])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array((h % k).astype(np.int32)), pa.array(k > 1), pa.array(np.full(n, d)),
                     pa.array(np.full(n, h)), pa.array(np.full(n, h2)), pa.array(starts[used].astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(bounds), pa.array(hashes[own]))], names=names)

    return texts.mapInArrow(run, "key long, share int, split boolean, doc long, th long, th2 long, pos int, runs array<long>")


def settle(group: np.ndarray, place: list[np.ndarray], pos: np.ndarray, sizes: np.ndarray, runs: np.ndarray,
           min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Compare runs inside groups of suffixes; rows are sorted by (group, place, pos).

    Returns, per run, its row, its position, its first occurrence (an index of
    runs), and whether it repeats that without overlapping it.
    """
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = pos[row] + np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    order = np.lexsort((np.arange(len(row)), runs, group[row]))
    a, b = order[1:], order[:-1]  # neighbours: equal runs follow each other, the earliest first
    new = np.concatenate([[True], (runs[a] != runs[b]) | (group[row[a]] != group[row[b]])])[:len(row)]
    first = np.empty(len(row), np.int64)
    first[order] = order[np.maximum.accumulate(np.where(new, np.arange(len(row)), 0))]
    same_text = np.ones(len(row), bool)
    for x in place:
        same_text &= x[row] == x[row[first]]
    return row, at, first, ~(same_text & (at < at[first] + min_words))


def _settled(suffixes: DataFrame, p: Params) -> DataFrame:
    """Sort, compare and extend: stretches of ``n`` runs whose words all repeat, and (n = 0) runs of split keys not yet decided."""
    names = ["key", "run", "th", "th2", "doc", "pos", "n", "kept"]

    def run(batches):
        left = None
        for b in batches:
            now = pa.Table.from_batches([b])
            left = now if left is None else pa.concat_tables([left, now])
            key, share = (left.column(c).to_numpy() for c in ("key", "share"))
            edge = np.nonzero((key[1:] != key[:-1]) | (share[1:] != share[:-1]))[0]
            if len(edge):  # the last group may go on in the next batch
                yield from work(left.slice(0, edge[-1] + 1))
                left = left.slice(edge[-1] + 1)
        if left is not None and left.num_rows:
            yield from work(left)

    def work(table):
        key, share, split, doc, th, th2, pos = (table.column(i).to_numpy() for i in range(7))
        lists = table.column("runs").combine_chunks()
        sizes, runs = lists.value_lengths().to_numpy(), lists.flatten().to_numpy()
        group = np.concatenate([[0], np.cumsum((key[1:] != key[:-1]) | (share[1:] != share[:-1]))])
        row, at, first, repeated = settle(group, [doc, th, th2], pos, sizes, runs, p.min_words)
        if not len(row):
            return
        # stretches: repeated runs of a text at consecutive words, then those of its suffixes that overlap or touch as one,
        # so that a row is the left end of a passage in this group and not one of the suffixes that it covers
        goes_on = np.concatenate([[False], repeated[1:] & repeated[:-1] & (row[1:] == row[:-1])])
        heads = np.nonzero(repeated & ~goes_on)[0]
        number = np.cumsum(repeated & ~goes_on)[repeated] - 1
        ends = at[heads] + np.bincount(number, minlength=len(heads)) - 1 + p.min_words
        if len(heads):
            own = row[heads]
            apart = at[heads[1:]] > ends[:-1]
            for x in (group, doc, th, th2):
                apart |= x[own[1:]] != x[own[:-1]]
            left = np.concatenate([[True], apart])
            heads, ends = heads[left], ends[np.concatenate([apart, [True]])]
        open_ = np.nonzero(~repeated & split[row])[0]
        pick = np.concatenate([heads, open_])
        r = row[pick]
        n = np.concatenate([ends - p.min_words + 1 - at[heads], np.zeros(len(open_), np.int64)])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
            key[r], runs[pick], th[r], th2[r], doc[r], at[pick].astype(np.int32), n.astype(np.int32), doc[row[first[pick]]])],
            names=names)

    # ranges of the sorted order: even parts, whatever the keys' frequencies, and no share in two of them
    return (suffixes.repartitionByRange("key", "share").sortWithinPartitions("key", "share", "doc", "th", "th2", "pos")
            .mapInArrow(run, "key long, run long, th long, th2 long, doc long, pos int, n int, kept long"))


def _passages(runs: DataFrame, p: Params) -> DataFrame:
    """Join overlapping stretches of repeated runs of a text: ``(th, th2, doc, starts, lengths, kept)``, arrays by position."""
    def run(batches):
        for b in batches:
            out = []
            for found in b.column(3).to_pylist():
                found.sort(key=lambda r: (r["pos"], r["kept"]))
                starts, ends, kept = [], [], []
                for r in found:
                    end = r["pos"] + r["n"] - 1 + p.min_words
                    if starts and r["pos"] <= ends[-1]:
                        ends[-1] = max(ends[-1], end)
                    else:
                        starts.append(r["pos"])
                        ends.append(end)
                        kept.append(r["kept"])
                out.append((starts, [e - s for s, e in zip(starts, ends)], kept))
            yield pa.RecordBatch.from_arrays(
                b.columns[:3] + [pa.array([o[i] for o in out], pa.list_(pa.int64())) for i in range(3)],
                names=["th", "th2", "doc", "starts", "lengths", "kept"])

    return (runs.groupBy("th", "th2", "doc").agg(F.collect_list(F.struct("pos", "n", "kept")).alias("found"))
            .mapInArrow(run, "th long, th2 long, doc long, starts array<long>, lengths array<long>, kept array<long>"))


def repeated_passages(docs: DataFrame, p: Params = Params()) -> tuple[DataFrame, DataFrame]:
    """Tables ``(th, th2, doc, n_words, first)`` of all texts and ``(th, th2, doc, starts, lengths, kept)`` of repeats.

    ``first`` is the smallest doc of equal texts; the second table has only such texts.
    """
    if p.order > p.prefix or p.window < 1:
        raise ValueError("order must be at most min_words - window + 1, window at least 1")
    entries = cut_lineage(_entries(docs, p), "suffixes")
    texts = entries.filter("key is null").select("doc", "th", "th2", F.col("n").alias("n_words"))
    first = texts.groupBy("th", "th2").agg(F.min("doc").alias("first"))
    suffixes = entries.filter("key is not null")
    # written, so that the join below reads a plain exchange on both sides and a frequent key can be split
    # a key has neighbours if two different texts have it, or one text twice; exact copies alone are none
    shared = cut_lineage(suffixes.groupBy("key").agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.min("th").alias("lo"),
                                                     F.max("th").alias("hi")).filter("most > 1 or lo <> hi")
                         .select("key", F.ceil(F.col("n") / p.split).cast("int").alias("k")), "shared")
    # copies of a text repeat its keys; what is collected is bounded by the words of one text
    often = F.collect_set(F.when(F.col("k") > 1, F.struct("key", "k"))).alias("often")
    by_text = suffixes.select("key", "th").join(shared, "key").groupBy("th").agg(F.collect_set("key").alias("shared"), often)
    wanted = first.join(by_text, "th").select("th", "th2", F.col("first").alias("doc"), "shared", "often")
    held = (_identified(docs).select("doc", "th", "th2", "text").join(wanted, ["th", "th2", "doc"])
            .select("doc", "th", "th2", "text", "shared", "often"))
    # written first, as finding even ranges reads the keys once more
    settled = cut_lineage(_settled(cut_lineage(_suffixes(held, p), "suffix-runs"), p), "settled")
    # shares of a frequent key have found their own first occurrences; the first of those decides the rest
    place = F.struct("doc", "th", "th2", "pos")
    open_ = settled.filter("n = 0").select("key", "run", "doc", "th", "th2", "pos")
    least = cut_lineage(open_.groupBy("key", "run").agg(F.min(place).alias("least"), F.max(place).alias("most"))
                        .filter("least <> most").select("key", "run", "least"), "least")
    own = (F.struct("doc", "th", "th2") == F.struct("least.doc", "least.th", "least.th2")) & (
        F.col("pos") < F.col("least.pos") + p.min_words)
    later = (open_.join(least, ["key", "run"]).filter(~own)
             .select("th", "th2", "doc", "pos", F.lit(1).alias("n"), F.col("least.doc").alias("kept")))
    passages = settled.filter("n > 0").select("th", "th2", "doc", "pos", "n", "kept").unionByName(later)
    return texts.join(first, ["th", "th2"]), cut_lineage(_passages(passages, p), "passages")


def _id(c: str):
    return F.when(F.col(c) != NO_ID, F.col(c))


def find_repeats(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """``(doc_id, start_word, n_words, kept_doc_id)``: one row per repeated passage of a document.

    Words are counted from 0.  ``kept_doc_id`` holds an earlier occurrence of
    the passage's beginning.  A copy of a whole text of at least ``min_words``
    words gives one row for all its words.  Documents that repeat nothing,
    first occurrences, null, empty and shorter texts give none.  Rows that
    share doc_id and text are one document and do not repeat each other; a
    null doc_id orders last and is given as null.
    """
    texts, passages = repeated_passages(docs, p)
    copies = (texts.filter((F.col("doc") != F.col("first")) & (F.col("n_words") >= p.min_words)).distinct()
              .select(_id("doc").alias("doc_id"), F.lit(0).cast("long").alias("start_word"), "n_words",
                      _id("first").alias("kept_doc_id")))
    parts = (passages.select("doc", F.explode(F.arrays_zip("starts", "lengths", "kept")).alias("x"))
             .select("doc", F.col("x.kept").alias("kept"), F.col("x.starts").alias("start_word"),
                     F.col("x.lengths").alias("n_words"))
             .select(_id("doc").alias("doc_id"), "start_word", "n_words", _id("kept").alias("kept_doc_id")))
    return parts.unionByName(copies)


def cut_words(text: str, starts: list[int], lengths: list[int]) -> str:
    """The text without the given words and the white space after them."""
    begins = [m.start() for m in WORD.finditer(text)] + [len(text)]
    out, at = [], 0
    for s, n in zip(starts, lengths):
        out.append(text[at:begins[s]])
        at = begins[s + n]
    return ("".join(out) + text[at:]).rstrip(" \t\n\r\x0b\x0c")


def remove_repeats(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text`` and ``n_chars`` (if there) counted anew.

    Documents of which no word is left, among them later copies of a whole
    text, go.  All others stay, those that repeat nothing byte for byte.
    """
    texts, passages = repeated_passages(docs, p)
    cuts = passages.select("th", "th2", "doc", "starts", "lengths")
    copies = (texts.filter((F.col("doc") != F.col("first")) & (F.col("n_words") >= p.min_words)).distinct()
              .select("th", "th2", "doc", F.lit(None).cast("array<long>").alias("starts"),
                      F.array(F.lit(-1).cast("long")).alias("lengths")))
    marked = _identified(docs).select("row", "doc", "th", "th2").join(
        cuts.unionByName(copies), ["th", "th2", "doc"], "left")

    def run(batches):
        for b in batches:
            rows, starts, lengths = (b.column(i) for i in range(3))
            names = [f.name for f in rows.type]
            fields = rows.flatten()
            texts = fields[names.index("text")].to_pylist()
            cut = {i: cut_words(texts[i], starts[i].as_py(), lengths[i].as_py())
                   for i in np.nonzero(starts.is_valid().to_numpy(zero_copy_only=False))[0].tolist()}
            keep = [not n or i in cut and bool(cut[i]) for i, n in enumerate(lengths.is_valid().to_pylist())]
            for i, t in cut.items():
                texts[i] = t
            fields[names.index("text")] = pa.array(texts, rows.type.field("text").type)
            if "n_chars" in names and cut:
                at = names.index("n_chars")
                counts = fields[at].to_pylist()
                for i, t in cut.items():
                    counts[i] = len(t)
                fields[at] = pa.array(counts, rows.type.field("n_chars").type)
            made = pa.StructArray.from_arrays(fields, fields=list(rows.type))
            yield pa.RecordBatch.from_arrays([made], names=["row"]).filter(pa.array(keep))

    done = marked.select("row", "starts", "lengths").mapInArrow(run, marked.select("row").schema)
    return done.select(*[F.col("row")[c].alias(c) for c in docs.columns])
