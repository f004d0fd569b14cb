import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from georisk.llm import catalog, mixing
from georisk.llm.common import read_table


@pytest.mark.parametrize("units", [{"a": 1}, {"a": 3, "b": 2, "c": 5}, {f"s{i}": i * i + 1 for i in range(12)}])
def test_deviation_stays_under_one_block(units):
    period = sum(units.values())
    slots = mixing.earliest_deadline_first(units)
    assert sorted(x for s in slots.values() for x in s) == list(range(period))
    for s, u in units.items():
        assert len(slots[s]) == u
        for t in range(1, period + 1):
            assert abs(sum(x < t for x in slots[s]) - Fraction(t * u, period)) < 1
        for k, x in enumerate(slots[s]):  # inside its window
            assert k * period // u <= x < -(-(k + 1) * period // u)


def stream(rows):
    """Slot -> (source, block), checking that a slot holds one block of one source."""
    out = {}
    for r in rows:
        assert out.setdefault(r["mix_slot"], (r["source"], r["mix_block"])) == (r["source"], r["mix_block"])
    return out


@pytest.mark.parametrize("weights", [None, {"a": 0.6, "b": 0.3, None: 0.1}])
def test_every_row_is_placed_once_at_its_weight(spark, weights):
    rng = random.Random(3)
    rows = [(i, rng.choice(["a"] * 6 + ["b", "c", None]), "t", 5) for i in range(700)]
    rows += [(5, "a", "t", 5)] * 3 + [(None, "b", None, None)] * 4
    docs = spark.createDataFrame(rows, "doc_id long, source string, mix_slot string, s int")
    p = mixing.Params(block=4, shard=8)
    out = mixing.mix(docs, weights, p)
    got = out.collect()
    assert Counter((r["doc_id"], r["source"]) for r in got) == Counter((r[0], r[1]) for r in rows)
    assert len({r["mix_position"] for r in got}) == len(rows)
    slots = stream(got)
    assert sorted(slots) == list(range(len(slots)))
    full = Counter((r["source"], r["mix_block"]) for r in got)
    counts = Counter(r[1] for r in rows)
    for s, n in counts.items():  # whole blocks in order, the last one may be short
        assert [full[s, k] for k in range(-(-n // 4))] == [4] * (n // 4) + [n % 4] * bool(n % 4)
        at = [t for t, x in sorted(slots.items()) if x[0] == s]
        assert [slots[t][1] for t in at] == sorted(slots[t][1] for t in at)
    name = lambda s: "null" if s is None else f"={s}"
    keyed = {name(s): n for s, n in counts.items()}
    units = mixing.weight_units(keyed, weights and {name(s): w for s, w in weights.items()}, p)
    for ph in mixing.phases({s: -(-n // 4) for s, n in keyed.items()}, units):
        taken = defaultdict(int)
        for t in range(sum(ph["taken"].values())):
            taken[name(slots[ph["start"] + t][0])] += 1
            for s, u in ph["units"].items():
                assert abs(taken[s] - Fraction((t + 1) * u, ph["period"])) < 1
        assert +Counter(taken) == +Counter(ph["taken"])
    ordered = mixing.in_stream_order(out).collect()
    assert len(ordered) == len(rows)
    by_shard = defaultdict(list)
    for r in ordered:
        by_shard[r["mix_shard"]].append(r["mix_position"])
    assert all(x == sorted(x) for x in by_shard.values())


def test_same_result_on_any_partitioning(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "source")
    p = mixing.Params(block=4)
    pick = lambda d: sorted((r["doc_id"], r["mix_position"]) for r in mixing.mix(d, p=p).collect())
    assert pick(docs) == pick(docs.repartition(7))


def test_edge_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixing.mix(empty).count() == 0
    one = spark.createDataFrame([(1, None, None)], "doc_id long, source string, text string")
    r = mixing.mix(one).first()
    assert (r["mix_block"], r["mix_slot"], r["mix_position"], r["mix_shard"]) == (0, 0, 0, 0)


def test_more_sources_than_are_scheduled_one_by_one(spark):
    """The 20 largest on their own, the other 380 as one: every row once, all near their weights."""
    sizes = {f"big{i:02d}": 200 + i for i in range(20)} | {f"s{i:03d}": 2 + i % 7 for i in range(379)} | {None: 3}
    rows = [(k, s) for s, n in sizes.items() for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string").repartition(5)
    got = mixing.mix(docs, p=mixing.Params(block=4, max_sources=20)).orderBy("mix_position").collect()
    assert Counter((r["doc_id"], r["source"]) for r in got) == Counter(rows)
    assert sorted({r["mix_slot"] for r in got}) == list(range(len({r["mix_slot"] for r in got})))
    big = {s for s in sizes if s and s.startswith("big")}
    of_slot = defaultdict(set)
    for r in got:  # a slot belongs to one large source or to the joint one
        of_slot[r["mix_slot"]].add(r["source"] if r["source"] in big else "")
    assert all(len(x) == 1 for x in of_slot.values())
    joint = [r["source"] for r in got if r["source"] not in big]
    weight = {s: n ** 0.5 for s, n in sizes.items() if s not in big}
    total, seen = sum(weight.values()), Counter()
    mean = total / len(weight)
    for t, s in enumerate(joint[:600], 1):  # before the first of them runs out
        seen[s] += 1
        for x, w in weight.items():
            if seen[x] < sizes[x]:
                assert -1 - 1e-9 <= seen[x] - t * w / total <= w / mean + 1
    exact = mixing.weight_units({f"={s}": sizes[s] for s in big} | {"rest": len(joint)},
                                {f"={s}": sizes[s] ** 0.5 for s in big} | {"rest": total}, mixing.Params())
    whole, taken = sum(exact.values()), Counter()
    owner = {r["mix_slot"]: f"={r['source']}" if r["source"] in big else "rest" for r in got}
    for t in range(300):
        taken[owner[t]] += 1
        assert all(abs(taken[s] - Fraction((t + 1) * u, whole)) < 1 for s, u in exact.items())


def test_given_weights_come_first_among_the_sources_scheduled_one_by_one(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "CASE WHEN id < 20 THEN 'small' ELSE concat('s', id % 9) END AS source")
    got = mixing.mix(docs, {"small": 0.5, "absent": 0.0, "s1": 0.05}, mixing.Params(block=1, max_sources=2)).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(400))
    first = sorted(got, key=lambda r: r["mix_slot"])[:20]
    assert 9 <= sum(r["source"] == "small" for r in first) <= 13


def test_blocks_grow_so_that_the_driver_lays_out_a_bounded_number(spark):
    docs = spark.range(5000).selectExpr("id AS doc_id", "CASE WHEN id % 7 < 5 THEN 'a' ELSE 'b' END AS source")
    got = mixing.mix(docs, p=mixing.Params(block=2, max_slots=100)).collect()
    assert len({r["mix_position"] for r in got}) == 5000
    assert 40 <= len({r["mix_slot"] for r in got}) <= 102
    assert max(Counter(r["mix_slot"] for r in got).values()) == 64


def test_one_repeated_row_is_spread_over_tasks(spark):
    """A row without id that makes up most of the table: no task holds all of its copies."""
    was = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.files.maxPartitionBytes")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions and files stay apart
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    docs = spark.range(20000).selectExpr("CASE WHEN id % 10 = 0 THEN id END AS doc_id", "'a' AS source", "'t' AS text").repartition(8)
    places, counts, raw = mixing._places(docs, None, mixing.Params(), "doc_id", "source")
    assert counts == {"=a": 20000} and [r["at"] for r in places.orderBy("at").select("at").collect()] == list(range(20000))
    held = places.groupBy(F.spark_partition_id()).count().collect()
    for k, v in was.items():
        spark.conf.set(k, v)
    assert max(r["count"] for r in held) < 10000


def test_query_places_every_document(spark):
    sf = "/root/testdata/sf0.001"
    got = catalog.QUERIES["op6_source_mixing"](spark, sf).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r["doc_id"] for r in read_table(spark, sf, "documents").collect())
    assert sorted({r["mix_slot"] for r in got}) == list(range(len({r["mix_slot"] for r in got})))


@pytest.mark.parametrize("weights", [{"a": 1 / 3, "b": 2 / 3}, {"a": 0.0001, "b": 0.9999}, {f"s{i}": 1.4 ** -i for i in range(20)}])
def test_deviation_from_the_weights_given(weights):
    """Not from rounded ones: below one block after any number of slots."""
    total = sum(map(Fraction, weights.values()))
    counts = {s: 10 ** 6 for s in weights}
    plan = mixing.phases({s: 12000 for s in weights}, mixing.weight_units(counts, weights, mixing.Params()))
    order = sorted((x, s) for s, slots in plan[0]["slots"].items() for x in slots)
    if plan[0]["repeats"]:  # 1/3 and 2/3 are in the proportion of 1 and 2
        order = [(n * len(order) + x, s) for n in range(4001) for x, s in order]
    taken = Counter()
    for t, (x, s) in enumerate(order):
        taken[s] += 1
        assert x == t
        if t % 50 == 0 or t == len(order) - 1:
            assert all(abs(taken[s] - (t + 1) * Fraction(w) / total) < 1 for s, w in weights.items())
    assert len(order) > 6000 and min(taken.values()) > 0


def test_long_periods_and_repeated_ones_place_every_row(spark):
    docs = spark.range(900).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'a' WHEN id % 3 = 1 THEN 'b' ELSE 'c' END AS source")
    for weights in ({"a": 0.37, "b": 1 / 3, "c": 0.1234}, {"a": 2, "b": 1, "c": 1}, {"a": 0.37, "b": 1.0, "c": 1.0}):
        got = mixing.mix(docs, weights, mixing.Params(block=2)).collect()
        assert sorted(r["doc_id"] for r in got) == list(range(900))
        assert sorted({r["mix_slot"] for r in got}) == list(range(450)) and len({r["mix_position"] for r in got}) == 900


def slots_of(plan):
    """(source, block, slot) of phases that are laid out as a whole or repeat their period."""
    return {(s, ph["first"][s] + k + n * ph["units"][s], ph["start"] + t + n * ph["period"])
            for ph in plan for s, x in ph["slots"].items()
            for n in range(-(-sum(ph["taken"].values()) // ph["period"]) if ph["repeats"] else 1)
            for k, t in enumerate(x) if k + n * ph["units"][s] < ph["taken"][s]}


@pytest.mark.parametrize("blocks", [{"a": 900, "b": 900, "c": 300}, {"a": 400, "b": 700, "c": 5}])
def test_legs_give_the_slots_of_one_layout(spark, blocks):
    """Blocks done at the start of a leg are enough to go on; periods longer and shorter than a leg."""
    for weights in ({"a": 0.37, "b": 1 / 3, "c": 0.1234}, {"a": 200, "b": 131, "c": 70}):
        units = mixing.weight_units(blocks, weights, mixing.Params())
        whole = slots_of(mixing.phases(blocks, units))
        plan = mixing.phases(blocks, units, leg=64)
        assert max(len(ph["legs"]) for ph in plan) > 3 and not any(ph["slots"] for ph in plan if ph["period"] > 64)
        legs = {tuple(r) for r in mixing._laid_out(spark, plan, 64).select("s", "block", "slot").collect()}
        assert legs | slots_of([ph for ph in plan if ph["repeats"]]) == whole and len(whole) == sum(blocks.values())


def test_blocks_and_joint_sources_do_not_depend_on_the_size(spark):
    """The same shares in a table of one and of five times the rows: blocks of one size, the same sources by themselves."""
    assert mixing.Params().max_slots is None and mixing.Params().max_sources is None
    p = mixing.Params(block=2, alpha=1.0, least_share=0.1, leg=16)
    for times in (1, 5):  # shares 0.4, 0.3, 0.1 and four of 0.05
        docs = spark.range(100 * times).selectExpr("id AS doc_id", "element_at(array('a', 'a', 'a', 'a', 'a', 'a', 'a', 'a', 'b', 'b', "
                                                   "'b', 'b', 'b', 'b', 'c', 'c', 's1', 's2', 's3', 's4'), CAST(id % 20 + 1 AS INT)) AS source")
        _, counts, _ = mixing._places(docs, None, p, "doc_id", "source")
        assert counts == {"=a": 40 * times, "=b": 30 * times, "=c": 10 * times, "rest": 20 * times}
        got = mixing.mix(docs, p=p).collect()
        assert sorted(r["doc_id"] for r in got) == list(range(100 * times))
        assert max(Counter(r["mix_slot"] for r in got).values()) == 2
        assert sorted({r["mix_slot"] for r in got}) == list(range(len({r["mix_slot"] for r in got})))
