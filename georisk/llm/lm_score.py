"""Masked pseudo-likelihood of documents under a bidirectional window network.

    h_t = tanh(b + sum_{o in -r..r, o != 0} E_o[x_{t+o}])
    p(x_t | both sides) = softmax over groups (d + h_t V) * softmax inside the group (c + h_t U)

The network never sees x_t itself.  Its outputs are the corpus's most frequent
words, counted over all documents, and hashed classes of the rarer ones; both
numbers follow the number of distinct words.  About sqrt(outputs) / 2 groups of outputs
of like frequency make the sum over all outputs one over the groups and one inside
the token's own: the probabilities of all outputs still add up to one, at a cost per
token that grows with the root of their number.  A word of a class has its counted
share of it,

    p(word | both sides) = p(class | both sides) * n(word) / n(class)

so every distinct word has a likelihood of its own, and a document's score is
the sum over all its tokens of log p(word | both sides).  The tasks hold the counts
of words that are at least one token in ``held`` (so no more than that many words, of
at most 64 bytes).  The counts of all others stay a table: the documents' distinct
words are joined with it, and the logarithms are summed per document as fixed-point
integers.

Training is data-parallel: every task trains
a copy in numpy on its own documents, then the copies are averaged, weighted by
the tokens they were trained on; each document is used in one of the rounds,
with a token in ``mask_every`` masked and predicted: at 1 every token of every
document is a target once.  The score predicts every token.  The copies are summed as fixed-point integers by an
aggregation, so the average does not depend on the order of the tasks, and only
one set of parameters reaches the driver whatever the size of the corpus.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, cut_lineage

SCALE = 1 << 20
FLUSH = 2_000_000  # words counted at once
PIECE = 8 << 20  # bytes of text split at once
AHEAD = 64  # training steps whose tokens are sorted at once


@dataclass(frozen=True)
class Params:
    """``top`` frequent words, ``classes`` for the rest, ``reach`` words on each side, ``hidden`` units.

    ``top`` and ``classes`` are the least numbers: both grow with the cube root of the distinct words.
    One token in ``held`` is the least share of a word whose count the tasks hold.
    """

    top: int = 191
    classes: int = 64
    reach: int = 2
    hidden: int = 16
    rounds: int = 2
    mask_every: int = 1
    batch: int = 512
    rate: float = 0.1
    held: int = 1 << 18
    seed: int = 3

    @property
    def size(self) -> int:  # 0 stands for the ends of a text
        return 1 + self.top + self.classes

    @property
    def width(self) -> int:  # outputs of a group; output k is in group k // width
        return math.ceil(2 * math.sqrt(self.size))

    @property
    def groups(self) -> int:
        return -(-self.size // self.width)

    def grown(self, distinct: int) -> Params:
        """For a corpus of so many distinct words."""
        root = distinct ** (1 / 3)
        return replace(self, top=max(self.top, int(1.5 * root)), classes=max(self.classes, int(root)))


class Vocabulary:
    """Number of each frequent word, class of any other; ``totals`` of each number, ``counts`` ``(word, n)`` of all words.

    ``held`` has the fixed-point log n of words that tasks look up themselves.
    """

    def __init__(self, words: list[bytes], p: Params, totals: np.ndarray, counts: DataFrame, held: dict[bytes, int]):
        self.p, self.number, self.totals, self.counts = p, {w: i + 1 for i, w in enumerate(words)}, totals, counts
        self.held = held

    def __getstate__(self):  # the table stays with the driver
        return self.__dict__ | {"counts": None}

    def log_totals(self) -> np.ndarray:
        """log n(class) of each number; 0 for frequent words, which have their number to themselves."""
        out = np.log(np.maximum(self.totals, 1))
        out[:1 + self.p.top] = 0
        return out

    def known(self, held: bool = True) -> Known:
        """The frequent words and, if ``held``, those whose count the tasks hold."""
        words = pa.array(list(self.number | self.held) if held else list(self.number), pa.binary())
        logs = [0 if w.as_py() in self.number else self.held[w.as_py()] for w in words]
        numbers = np.append(self.classes(words), 0)
        numbers[:len(self.number)] = list(self.number.values())
        return Known(words, numbers, np.array([*logs, 0], np.int64), self.classes)

    def classes(self, words: pa.Array) -> np.ndarray:
        crcs = np.fromiter(map(zlib.crc32, words.to_numpy(zero_copy_only=False)), np.int64, len(words))
        return (1 + self.p.top + crcs % self.p.classes).astype(np.int32)

    def ids(self, words: list[bytes]) -> np.ndarray:
        return self.known(held=False).ids(pa.array(words, pa.binary()))[0]


@dataclass
class Known:
    """Words that tasks look up at once, number and fixed-point log n of each and, last, 0 for all others; classes of those."""

    words: pa.Array
    numbers: np.ndarray
    logs: np.ndarray
    classes: Callable[[pa.Array], np.ndarray]

    def ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of each word, its place among the known ones or -1, positions of the others."""
        place = pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy()
        others = np.flatnonzero(place < 0)
        ids = self.numbers[place]
        ids[others] = self.classes(words.take(pa.array(others)))
        return ids, place, others


@dataclass
class Network:
    params: Params
    e: np.ndarray  # (2 * reach, size, hidden)
    b: np.ndarray
    u: np.ndarray  # (hidden + 1, size): outputs inside their group, the last row the bias c
    v: np.ndarray  # (hidden + 1, groups): groups, the last row the bias d

    @classmethod
    def start(cls, p: Params, counts: np.ndarray) -> Network:
        """Small random inputs, and the corpus's token frequencies as the first guess of the output."""
        rng = np.random.default_rng(p.seed)
        share = (counts + 1) / (counts + 1).sum()
        of_group = np.add.reduceat(share, np.arange(0, p.size, p.width))
        return cls(p, rng.normal(0, 0.1, (2 * p.reach, p.size, p.hidden)).astype(np.float32), np.zeros(p.hidden, np.float32),
                   *[np.vstack([rng.normal(0, 0.1, (p.hidden, len(x))), np.log(x)]).astype(np.float32) for x in (share, of_group)])

    def parts(self) -> list[np.ndarray]:
        return [self.e, self.b, self.u, self.v]

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.parts()])

    def views(self, values: np.ndarray) -> list[np.ndarray]:
        """The parts of a flat vector."""
        out, at = [], 0
        for x in self.parts():
            out.append(values[at:at + x.size].reshape(x.shape))
            at += x.size
        return out

    def filled(self, values: np.ndarray) -> Network:
        return Network(self.params, *[x.astype(np.float32) for x in self.views(values)])

    def offsets(self) -> list[int]:
        r = self.params.reach
        return [o for o in range(-r, r + 1) if o]

    def around(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Neighbours of each position, a row per input table; ``ids`` has ``reach`` zeros around every text."""
        return ids.take(at + np.array(self.offsets())[:, None])

    def hidden(self, around: np.ndarray) -> np.ndarray:
        """Units of each position and a last one that is always 1, for the outputs' bias."""
        total = self.e[0].take(around[0], axis=0)
        for table, row in zip(self.e[1:], around[1:]):
            total += table.take(row, axis=0)
        total += self.b
        h = np.ones((len(total), self.params.hidden + 1), np.float32)
        np.tanh(total, out=h[:, :-1])
        return h

    def by_group(self, own: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice, slice]]]:
        """Order that brings tokens of a group together; first output, tokens and outputs of each group that has any."""
        width, group = self.params.width, (own // self.params.width).astype(np.int16)  # 16 bits are sorted by radix
        order = np.argsort(group, kind="stable")
        ends = [0, *np.bincount(group, minlength=self.params.groups).cumsum().tolist()]
        return order, [(g * width, slice(a, z), slice(g * width, (g + 1) * width))
                       for g, (a, z) in enumerate(zip(ends, ends[1:])) if a < z]

    def steps(self, own: np.ndarray) -> tuple[np.ndarray, list[list[int]], np.ndarray, np.ndarray]:
        """The same for the steps of a training run at once.

        Order that brings tokens of a group together inside each step; ends of the groups of each step; then, in that order, where
        a token's own group is in its step's flat table of tokens and groups, and its own output in its group's.
        """
        p, n = self.params, len(own)
        group, step = own // p.width, np.arange(n) // p.batch
        small = np.int16 if AHEAD * p.groups < 1 << 15 else np.int64  # 16 bits are sorted by radix
        order = np.argsort((step * p.groups + group).astype(small), kind="stable")
        own, group, inside = own[order], group[order], np.arange(n) - step * p.batch
        counts = np.bincount(step * p.groups + group, minlength=-(-n // p.batch) * p.groups).reshape(-1, p.groups)
        ends = np.hstack([np.zeros((len(counts), 1), np.int64), counts.cumsum(axis=1)])
        first = group * p.width
        width = np.minimum(p.width, p.size - first)
        return order, ends.tolist(), inside * p.groups + group, (inside - ends[step, group]) * width + own - first

    def steep(self, limit: float = 80) -> bool:
        """Whether exp of an output could overflow."""
        return max(float(np.abs(x).sum(axis=0).max()) for x in (self.u, self.v)) > limit

    @staticmethod
    def exps(h: np.ndarray, table: np.ndarray, own: np.ndarray, steep: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logit of each row's own output, exp of all of them and their sums."""
        z = h @ table
        if steep:
            z -= z.max(axis=1, keepdims=True)
        logit = z[np.arange(len(own)), own]
        np.exp(z, out=z)
        return logit, z, z.sum(axis=1)

    def log_probs(self, ids: np.ndarray, at: np.ndarray, step: int = 8192) -> np.ndarray:
        """log p of the token at each position, given both sides."""
        out = np.empty(len(at), np.float64)
        steep = self.steep()
        for s in range(0, len(at), step):
            order, groups = self.by_group(ids[at[s:s + step]])
            part = at[s:s + step][order]
            own, h = ids[part], self.hidden(self.around(ids, part))
            logit, _, total = self.exps(h, self.v, own // self.params.width, steep)
            found = logit - np.log(total)
            for first, mine, outputs in groups:
                logit, _, total = self.exps(h[mine], self.u[:, outputs], own[mine] - first, steep)
                found[mine] += logit - np.log(total)
            out[s + order] = found
        return out

    def train(self, ids: np.ndarray, at: np.ndarray, memory: list[np.ndarray]) -> None:
        """Adagrad steps over masked positions; ``memory`` has the summed squared gradients."""
        p = self.params
        # parameters, gradients and memory are one vector each; the parts are views of it
        x, m = self.flat(), np.concatenate([part.ravel() for part in memory])
        self.e, self.b, self.u, self.v = self.views(x)
        g = np.zeros_like(x)
        de, db, du, dv = self.views(g)
        de = de.reshape(len(de), -1)
        cells = np.arange(p.size * p.hidden).reshape(-1, p.hidden)  # of one input table
        outputs = [slice(first, first + p.width) for first in range(0, p.size, p.width)]

        def slopes(h, table, own, steep, n, out):  # at the inputs and, to out, the table
            z = h @ table
            if steep:
                z -= z.max(axis=1, keepdims=True)
            np.exp(z, out=z)
            total = np.add.reduce(z, axis=1)
            z.reshape(-1)[own] -= total
            z /= (n * total)[:, None]
            np.matmul(h.T, z, out=out)
            return z @ table[:-1].T

        for s in range(0, len(at), AHEAD * p.batch):
            some = at[s:s + AHEAD * p.batch]
            order, ends, own_group, own = self.steps(ids[some])
            some = some[order]
            around = self.around(ids, some)
            for k in range(len(ends)):
                if k % 8 == 0:  # a step moves a parameter by at most p.rate
                    steep = self.steep(80 - 8 * p.rate * len(self.u))
                a, z = k * p.batch, min((k + 1) * p.batch, len(some))
                near, n = around[:, a:z], z - a
                h = self.hidden(near)
                dh = slopes(h, self.v, own_group[a:z], steep, n, dv)
                du[:] = 0
                for mine, first, last in zip(outputs, ends[k], ends[k][1:]):
                    if first < last:
                        dh[first:last] += slopes(h[first:last], self.u[:, mine], own[a + first:a + last], steep, n, du[:, mine])
                dh *= 1 - h[:, :-1] ** 2
                np.add.reduce(dh, axis=0, out=db)
                each = dh.astype(np.float64).ravel()
                for table, row in zip(de, near):  # every table's own rows
                    table[:] = np.bincount(cells.take(row, axis=0).ravel(), each, cells.size)
                m += g * g
                g *= p.rate
                g /= np.sqrt(m)
                x -= g
        for old, new in zip(memory, self.views(m)):
            old[:] = new


def spread(tokens: np.ndarray, sizes: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one array with ``reach`` zeros around each; the positions of tokens; their text's number."""
    starts = np.concatenate([[0], np.cumsum(sizes + reach)])[:-1] + reach
    ids = np.zeros(int((sizes + reach).sum()) + reach, np.int32)
    at = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)])[:-1], sizes) + np.arange(int(sizes.sum()))
    ids[at] = tokens
    return ids, at, np.repeat(np.arange(len(sizes)), sizes)


def padded(texts: list[np.ndarray], reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return spread(np.concatenate([np.empty(0, np.int32), *texts]), np.array([len(t) for t in texts], np.int64), reach)


def runs(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """First and end of the texts that are together at most so large; a larger one is alone."""
    ends, start = np.concatenate([[0], np.cumsum(sizes)]), 0
    while start < len(sizes):
        end = max(start + 1, int(np.searchsorted(ends, ends[start] + most, side="right")) - 1)
        yield start, end
        start = end


def pieces(texts: pa.Array) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """A few texts at a time: number of the first, words of all of them and how many each text has.

    Words are those of ``space_words``, lower-cased: Arrow's ASCII kernels know the same six white space characters.
    """
    for start, end in runs(pc.binary_length(texts).fill_null(0).to_numpy().astype(np.int64), PIECE):
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts[start:end].fill_null("")))
        words, sizes = split.flatten(), pc.list_value_length(split).to_numpy().astype(np.int64)
        full = pc.binary_length(words).to_numpy() > 0  # white space at the ends of a text leaves empty words
        if not full.all():
            sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[full], minlength=len(sizes))
            words = words.filter(pa.array(full))
        yield start, words.cast(pa.binary()), sizes


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, n)`` over all documents; A-Z lower-cased, words as UTF-8 binary."""
    def run(batches):
        some: list[pa.Array] = []

        def out():
            found = pa.chunked_array(some, pa.binary()).value_counts()
            some.clear()
            return pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], names=["word", "n"])
        for b in batches:
            for _, words, _ in pieces(b.column(0)):
                some.append(words)
                if sum(map(len, some)) > FLUSH:
                    yield out()
        yield out()

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _log_n():
    """log of a word's count in 2^-32; a word that was not counted is taken for one seen once."""
    return F.round(F.log(F.coalesce("n", F.lit(1)).cast("double")) * (1 << 32)).cast("long")


def vocabulary(docs: DataFrame, p: Params) -> tuple[Vocabulary, np.ndarray]:
    """The most frequent words (ties by word) and the count of every token; ``p`` grown to the distinct words."""
    counts = cut_lineage(word_counts(docs), "words")
    p = p.grown(counts.count())
    top = counts.orderBy(F.desc("n"), "word").limit(p.top).collect()
    words = [bytes(r["word"]) for r in top]
    known = docs.sparkSession.createDataFrame([(w,) for w in words], "word binary")
    rest = (counts.join(F.broadcast(known), "word", "left_anti")  # at most p.top words
            .groupBy((F.crc32("word") % p.classes).alias("k")).agg(F.sum("n").alias("n")).collect())
    n = np.zeros(p.size)
    n[1:1 + len(top)] = [r["n"] for r in top]
    for r in rest:
        n[1 + p.top + r["k"]] = r["n"]
    often = (F.col("n") >= n.sum() / p.held) & (F.length("word") <= 64)
    held = {bytes(r["word"]): r["log_n"] for r in counts.filter(often).select("word", _log_n().alias("log_n")).collect()}
    return Vocabulary(words, p, n, counts, held), n


def _trained(docs: DataFrame, vocab: Vocabulary, net: Network, turn: int) -> Network:
    """One round: copies trained on the documents of this turn, averaged by the tokens they saw."""
    p, shared = net.params, Shared(docs.sparkSession, (vocab, net))

    def run(batches):
        vocab, start = shared.value
        mine = start.filled(start.flat())
        memory = [np.full_like(x, 1e-2) for x in mine.parts()]
        seen, known = 0, vocab.known()
        for b in batches:
            found = [(known.ids(words)[0], sizes) for _, words, sizes in pieces(b.column(0))]
            if not found:
                continue
            ids, at, _ = spread(*map(np.concatenate, zip(*found)), p.reach)
            at = at[(at + turn) % p.mask_every == 0]
            mine.train(ids, np.random.default_rng(p.seed).permutation(at), memory)
            seen += len(at)
        if seen:
            values = np.rint(mine.flat().astype(np.float64) * SCALE).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([values.tolist()], pa.list_(pa.int64()))],
                                             names=["seen", "copy"])

    copies = (docs.filter(F.pmod(F.xxhash64("text"), F.lit(p.rounds)) == turn).select("text")
              .mapInArrow(run, "seen long, copy array<long>"))
    # one row per parameter comes back, whatever the number of copies
    mean = (copies.select("seen", F.posexplode("copy").alias("i", "x"))
            .groupBy("i").agg(F.sum(F.col("x").cast("decimal(38,0)") * F.col("seen")).alias("x"), F.sum("seen").alias("n"))
            .select("i", (F.col("x") / F.col("n")).cast("double").alias("x")).toPandas())
    if not len(mean):
        return net
    return net.filled(mean.sort_values("i")["x"].to_numpy() / SCALE)


def train(docs: DataFrame, p: Params = Params()) -> tuple[Vocabulary, Network]:
    """Vocabulary and network of the whole table.  Without any word the network is its start."""
    vocab, counts = vocabulary(docs, p)
    net = Network.start(vocab.p, counts)
    for turn in range(p.rounds):
        net = _trained(docs, vocab, net, turn)
    return vocab, net


def score(docs: DataFrame, vocab: Vocabulary, net: Network) -> DataFrame:
    """``doc_id, n_tokens, log_likelihood, word_log_likelihood, mean_log_likelihood, perplexity`` per row of ``docs``.

    ``word_log_likelihood`` is the likelihood of the words, and mean and
    perplexity are taken from it; ``log_likelihood`` is its first part alone,
    that of the network's outputs (frequent words and classes).  A word that
    the vocabulary has not counted is taken for one that was seen once.  A
    null, empty or blank text has no tokens, log-likelihoods 0 and null mean
    and perplexity.  Repeated rows and null ids are scored like any other.
    """
    shared = Shared(docs.sparkSession, (vocab, net))

    def run(batches):
        vocab, net = shared.value
        known, log_totals = vocab.known(), vocab.log_totals()
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()]
        names = ["doc_id", "text_hash", "word", "times", "n_tokens", "log_likelihood", "log_totals", "held_log_n"]

        def rows(of, word, times, *values):  # of the texts numbered ``of``
            values = values or [pa.nulls(len(of), k) for k in kinds[4:]]
            return pa.RecordBatch.from_arrays([b.column(0).take(of), b.column(2).take(of), word, *[
                x if isinstance(x, pa.Array) else pa.array(x, k) for x, k in zip((times, *values), kinds[3:])]], names=names)
        for b in batches:
            found = []
            for start, words, sizes in pieces(b.column(1)):
                tokens, place, others = known.ids(words)
                log_n = np.concatenate([[0], known.logs[place].cumsum()])[np.concatenate([[0], sizes.cumsum()])]
                found.append((tokens, sizes, np.diff(log_n)))
                # a row per rare word of a text
                rare, text = words.take(pa.array(others)).dictionary_encode(), np.repeat(np.arange(len(sizes)), sizes)[others]
                pairs, times = np.unique(text * len(rare.dictionary) + rare.indices.to_numpy(), return_counts=True)
                of, word = np.divmod(pairs, max(len(rare.dictionary), 1))
                yield rows(pa.array(start + of), rare.dictionary.take(pa.array(word)), times)
            if not found:
                continue
            # and a row per text, whose word matches none
            tokens, sizes, held = map(np.concatenate, zip(*found))
            ids, at, text = spread(tokens, sizes, net.params.reach)
            total, minus = np.zeros((2, len(sizes)))
            ends = np.concatenate([[0], sizes.cumsum()])
            for first, end in runs(sizes, 200_000):
                some = slice(ends[first], ends[end])
                total[first:end] = np.bincount(text[some] - first, net.log_probs(ids, at[some]), end - first)
                minus[first:end] = np.bincount(text[some] - first, log_totals[tokens[some]], end - first)
            heads = pa.array([b" %d" % k for k in b.column(2).to_numpy()], pa.binary())
            yield rows(pa.array(np.arange(len(sizes))), heads, np.zeros(len(sizes), np.int64), sizes, total, minus, held)

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        run, "doc_id long, text_hash long, word binary, times long, n_tokens long, log_likelihood double, log_totals double, "
             "held_log_n long")
    # rows that repeat id and text are one group, given out as often as they came
    summed = (found.join(vocab.counts.hint("shuffle_hash"), "word", "left").groupBy("doc_id", "text_hash")
              .agg(F.count("n_tokens").alias("copies"), F.max("n_tokens").alias("n_tokens"),
                   F.max("log_likelihood").alias("log_likelihood"), F.max("log_totals").alias("log_totals"),
                   F.max("held_log_n").alias("held_log_n"), F.sum(_log_n() * F.col("times")).alias("log_n")))
    log_n = F.col("held_log_n") + F.col("log_n") / F.col("copies")
    of_words = F.col("log_likelihood") - F.col("log_totals") + log_n / (1 << 32)
    each = summed.withColumn("word_log_likelihood", of_words).withColumn("_", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    mean = F.when(F.col("n_tokens") > 0, F.col("word_log_likelihood") / F.col("n_tokens"))
    return each.select("doc_id", "n_tokens", F.round("log_likelihood", 3).alias("log_likelihood"),
                       F.round("word_log_likelihood", 3).alias("word_log_likelihood"),
                       F.round(mean, 6).alias("mean_log_likelihood"), F.round(F.exp(-mean), 4).alias("perplexity"))
