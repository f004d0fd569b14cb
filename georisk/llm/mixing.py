"""Mixing sources to target weights by Pfair scheduling.

Each source's documents, in a seeded hash order, are cut into blocks of
``block`` documents; one block takes one slot of the mixed stream.  With weight
w, block k of a source is released at slot floor(k / w) and due by slot
ceil((k + 1) / w).  Earliest-deadline-first over these windows never misses a
deadline, since the weights add up to one, so after any number t of slots each
source holds its t * w blocks up to less than one block.

The weights are exact fractions: integer parts of a period without rounding.
A phase that is longer than its period repeats it, and a document finds its slot
by arithmetic: slot = period number * period + slot inside the period.  With a
period of more than ``leg`` slots, as weights that are no round numbers have, the
driver goes over the slots once and keeps only how many blocks of each source are
done at the start of every leg; tasks lay out a leg each, one row a block, and
documents are joined by source and block.  A block has ``block`` documents
whatever the size of the table; ``max_slots``, if it is given, asks for coarser ones.
A source that runs out leaves, and the remaining ones go on in a new phase in
their own proportions, until every document has its place: none is dropped and
none is repeated.  The deviation bound holds in each phase from its start.

Any number of sources is mixed.  Those that have at least ``least_share`` of all
weight, so no more than its inverse, are scheduled one by one, the others as one
source of their joint weight; ``max_sources``, if it is given, further bounds the
first ones to those that have a weight given, then the largest.  Inside the joint
one documents follow each other by their own deadlines (r + 1) / w, found by a
distributed sort: there a source is never more than one document behind its
weight, and ahead by no more than its weight over the mean weight of these
sources, in documents.  Which sources these are depends on weights alone.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import dense_index
from .common import Shared, cut_lineage

REST = "rest"  # the sources that are scheduled as one; keys of single ones begin with "=" or are "null"


@dataclass(frozen=True)
class Params:
    """``block`` documents a slot; ``shard`` slots a shard; ``alpha`` gives the default weights, counts to that power.

    ``least_share`` of the weight makes a source be scheduled by itself; a task lays out ``leg`` slots.
    ``max_slots`` and ``max_sources`` bound them further if they are given.
    """

    block: int = 32
    alpha: float = 0.5
    shard: int = 64
    least_share: float = 0.001
    leg: int = 1 << 16
    max_sources: int | None = None
    max_slots: int | None = None
    seed: int = 11


def in_deadline_order(units: dict[str, int], done: dict[str, int] | None = None) -> Iterator[str]:
    """The source of each slot of a period, earliest deadline first; goes on where ``done`` blocks of each have left it."""
    period, taken = sum(units.values()), {s: 0 for s in units} | (done or {})
    waiting, due = [], []  # release of each source's next block; deadlines of the released ones
    for s in units:
        if taken[s] < units[s]:
            waiting.append((taken[s] * period // units[s], s))
    heapq.heapify(waiting)
    for t in range(sum(taken.values()), period):
        while waiting and waiting[0][0] <= t:
            _, name = heapq.heappop(waiting)
            heapq.heappush(due, (-(-(taken[name] + 1) * period // units[name]), name))
        deadline, name = heapq.heappop(due)
        if t >= deadline:
            raise AssertionError(f"{name} misses its deadline {deadline}")
        yield name
        taken[name] += 1
        if taken[name] < units[name]:
            heapq.heappush(waiting, (taken[name] * period // units[name], name))


def earliest_deadline_first(units: dict[str, int], blocks: dict[str, int] | None = None) -> dict[str, list[int]]:
    """Slots of each source's blocks inside one period of sum(units) slots, or until a source has no more ``blocks``."""
    slots: dict[str, list[int]] = {name: [] for name in units}
    for t, name in enumerate(in_deadline_order(units)):
        slots[name].append(t)
        if blocks and len(slots[name]) == blocks[name]:
            break
    return slots


def _legs(units: dict[str, int], blocks: dict[str, int], leg: int) -> tuple[list[np.ndarray], dict[str, int]]:
    """Blocks of each source done every ``leg`` slots until one has no more ``blocks`` or the period ends; those done then."""
    taken, starts = dict.fromkeys(units, 0), []
    for t, name in enumerate(in_deadline_order(units)):
        if t % leg == 0:
            starts.append(np.fromiter(taken.values(), np.int64, len(taken)))
        taken[name] += 1
        if taken[name] == blocks[name]:
            break
    return starts, taken


def weight_units(counts: dict[str, int], weights: dict[str, float] | None, p: Params) -> dict[str, int]:
    """The weights as whole numbers in exact proportion.  Sources without a weight get the smallest one given."""
    if weights is None:
        raw = {s: n ** p.alpha for s, n in counts.items()}
    else:
        given = [w for w in weights.values() if w > 0]
        raw = {s: max(weights.get(s, 0.0), 0.0) or min(given, default=1.0) for s in counts}
    exact = {s: Fraction(w) for s, w in raw.items()}
    common = math.lcm(*(w.denominator for w in exact.values()))
    return {s: int(w * common) for s, w in exact.items()}


def phases(blocks: dict[str, int], units: dict[str, int], leg: int | None = None) -> list[dict]:
    """Phases from the start to the last block: ``start``, ``period``, ``units``, ``slots``, ``first`` and ``taken`` blocks.

    ``slots`` holds one period, or the whole phase if that is not longer (``repeats`` is false).  Of a period of
    more than ``leg`` slots ``legs`` holds the blocks done every ``leg`` slots instead, and ``slots`` is empty;
    a phase of several such periods has them one after another.
    """
    left, done, out, start = dict(blocks), dict.fromkeys(blocks, 0), [], 0
    while left := {s: n for s, n in left.items() if n}:
        divisor = math.gcd(*(units[s] for s in left))
        own = {s: units[s] // divisor for s in sorted(left)}
        period, slots, legs = sum(own.values()), {}, []
        if leg is None or period <= leg:
            slots = earliest_deadline_first(own, left)
            taken = {s: len(x) for s, x in slots.items()}
        else:
            legs, taken = _legs(own, left, leg)
        length = sum(taken.values())
        repeats = bool(slots) and all(taken[s] < n for s, n in left.items())
        if repeats:
            length = min((n - 1) // own[s] * period + slots[s][(n - 1) % own[s]] + 1 for s, n in left.items())
            taken = {s: length // period * own[s] + sum(x < length % period for x in slots[s]) for s in left}
        out.append({"start": start, "period": period, "units": own, "slots": slots, "legs": legs,
                    "first": {s: done[s] for s in left}, "taken": taken, "repeats": repeats})
        start += length
        for s, n in taken.items():
            done[s] += n
            left[s] -= n
    return out


def _laid_out(spark, plan: list[dict], leg: int) -> DataFrame:
    """``s, block, slot`` of every block of the phases that do not repeat a period; a task has whole legs."""
    rows = []
    for i, ph in enumerate(plan):
        if ph["repeats"]:
            continue
        length = sum(ph["taken"].values())
        starts = ph["legs"] or [np.zeros(len(ph["units"]), np.int64)]
        rows += [(len(rows), i, k * leg if ph["legs"] else 0, min(length, (k + 1) * leg) if ph["legs"] else length,
                  bytearray(x.tobytes())) for k, x in enumerate(starts)]
    shared = Shared(spark, {i: (ph["start"], ph["units"], ph["first"]) for i, ph in enumerate(plan) if not ph["repeats"]})

    def run(batches):
        phase = shared.value
        for b in batches:
            for r in b.to_pylist():
                start, units, first = phase[r["phase"]]
                done = dict(zip(units, np.frombuffer(r["done"], np.int64).tolist()))
                names, blocks, at = [], [], {s: first[s] + n for s, n in done.items()}
                for _, s in zip(range(r["lo"], r["hi"]), in_deadline_order(units, done)):
                    names.append(s)
                    blocks.append(at[s])
                    at[s] += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), pa.array(blocks, pa.int64()),
                     pa.array(range(start + r["lo"], start + r["lo"] + len(names)), pa.int64())], names=["s", "block", "slot"])

    legs = spark.createDataFrame(rows, "leg long, phase long, lo long, hi long, done binary")
    return legs.repartition(max(1, min(len(rows), 1000)), "leg").mapInArrow(run, "s string, block long, slot long")


def _least(weights: dict[str, float]) -> float:
    """What a source without a weight of its own gets."""
    return float(min((w for w in weights.values() if w > 0), default=1.0))


def _places(docs: DataFrame, weights: dict[str, float] | None, p: Params, id_col: str, source_col: str):
    """``row, s, at`` with each row's place in its source; rows and weight of every source, the joint one included.

    Rows are sorted once over all tasks and stored; a source, an id or a row that
    a third of the table shares is spread over many of them.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("null"))
    plain = [f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]  # maps have no hash
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), key.alias("s"),
                       F.xxhash64(F.lit(p.seed), F.col(id_col)).alias("h"), F.col(id_col).alias("i"),
                       F.xxhash64(*[F.col(c) for c in plain]).alias("j"))
    ranked = dense_index(rows, ["s", "h", "i", "j"], "at").select("row", "s", "at")

    weight = F.pow(F.col("n").cast("double"), F.lit(p.alpha))
    sizes = ranked.groupBy("s").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    if weights is None:
        sizes = sizes.withColumn("given", F.lit(False)).withColumn("w", weight)
    else:
        table = spark.createDataFrame([(s, float(w)) for s, w in weights.items() if w > 0], "s string, w double")
        sizes = (sizes.join(table, "s", "left").withColumn("given", F.col("w").isNotNull())
                 .withColumn("w", F.coalesce("w", F.lit(_least(weights)))))
    sizes = cut_lineage(sizes, "mix_sources")
    # shares of the weight are compared as decimals, whose sum does not depend on the order of rows
    sizes = sizes.crossJoin(F.broadcast(sizes.agg(F.max("w").alias("most")))) \
        .withColumn("share", (F.col("w") / F.col("most")).cast("decimal(38,20)")).drop("most")
    total = sizes.agg(F.sum("share").alias("total"))
    least = F.lit(str(p.least_share)).cast("decimal(12,10)")
    large = sizes.crossJoin(F.broadcast(total)).filter(F.col("share") >= F.col("total") * least).drop("share", "total")
    if p.max_sources is not None:
        large = large.orderBy(F.desc("given"), F.desc("n"), "s").limit(p.max_sources)
    head = large.collect()
    single = sorted(head, key=lambda r: r["s"])
    counts = {r["s"]: r["n"] for r in single}
    if weights is None:
        raw = {r["s"]: r["w"] for r in single}
    else:  # as they were given: a double would round fractions
        raw = {s: max(weights.get(s, 0), 0) or _least(weights) for s in counts}
    firsts = F.broadcast(spark.createDataFrame([(r["s"], r["first"]) for r in single], "s string, first long"))
    places = ranked.join(firsts, "s").select("row", "s", (F.col("at") - F.col("first")).alias("at"))
    others = sizes.join(firsts.select("s"), "s", "left_anti")
    joint = others.agg(F.sum("n").alias("n"), F.sum("w").alias("w")).first()
    if joint["n"]:
        counts[REST], raw[REST] = joint["n"], joint["w"]
        due = (F.col("at") - F.col("first") + 1) / F.col("w")
        rest = dense_index(ranked.join(others.select("s", "first", "w"), "s").select("row", "s", "at", due.alias("due")),
                           ["due", "s", "at"], "place")
        places = places.unionByName(rest.select("row", F.lit(REST).alias("s"), F.col("place").alias("at")))
    return places, counts, raw


def mix(docs: DataFrame, weights: dict[str, float] | None = None, p: Params = Params(),
        id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """``docs`` with ``mix_block``, ``mix_slot``, ``mix_position`` and ``mix_shard`` added.

    ``mix_position`` orders the stream; a shard is a run of ``p.shard`` slots.
    Existing columns of these names are replaced.  ``weights`` is keyed by
    source; a null source is a source of its own with the key None.  Rows with
    equal ids, repeated rows and null ids each have a place of their own.  The
    sources that are scheduled as one share the numbers of ``mix_block``.
    """
    spark = docs.sparkSession
    keyed = docs.drop("mix_block", "mix_slot", "mix_position", "mix_shard")
    columns = keyed.columns
    if weights is not None:
        weights = {"null" if s is None else f"={s}": w for s, w in weights.items()}
    places, counts, raw = _places(keyed, weights, p, id_col, source_col)
    size = p.block
    while p.max_slots is not None and -(-sum(counts.values()) // size) > p.max_slots:
        size *= 2
    plan = phases({s: -(-n // size) for s, n in counts.items()}, weight_units(counts, raw, p), p.leg)
    placed = places.select("row", "s", F.floor(F.col("at") / size).alias("block"), (F.col("at") % size).alias("in_block"))

    # phases that repeat their period: one row per source and phase, with the slots of a period
    stages = spark.createDataFrame(
        [(s, ph["first"][s], ph["first"][s] + ph["taken"][s], ph["start"], ph["units"][s], ph["period"], ph["slots"][s])
         for ph in plan if ph["repeats"] for s in ph["units"] if ph["taken"][s]],
        "s2 string, lo long, hi long, start long, units long, period long, slots array<long>")
    k = F.col("block") - F.col("lo")
    slot = (F.col("start") + F.floor(k / F.col("units")) * F.col("period")
            + F.element_at("slots", (k % F.col("units") + 1).cast("int")))
    by_period = (F.col("s") == F.col("s2")) & (F.col("block") >= F.col("lo")) & (F.col("block") < F.col("hi"))
    kinds = []
    if any(ph["repeats"] for ph in plan):
        kinds.append(placed.join(F.broadcast(stages), by_period).select("row", "block", "in_block", slot.cast("long").alias("slot")))
    if not all(ph["repeats"] for ph in plan) or not plan:  # the others: one row per block
        kinds.append(placed.join(_laid_out(spark, plan, p.leg), ["s", "block"]).select("row", "block", "in_block", "slot"))
    found = kinds[0] if len(kinds) == 1 else kinds[0].unionByName(kinds[1])
    return (found.select(*[F.col("row")[c].alias(c) for c in columns], F.col("block").alias("mix_block"),
                    F.col("slot").alias("mix_slot"), (F.col("slot") * size + F.col("in_block")).alias("mix_position"),
                    F.floor(F.col("slot") / p.shard).alias("mix_shard")))


def in_stream_order(mixed: DataFrame) -> DataFrame:
    """Whole shards per partition, each in stream order: a reader takes shard after shard."""
    return mixed.repartition("mix_shard").sortWithinPartitions("mix_shard", "mix_position")
