"""The corpus pipeline, stage by stage, against brute force on the given documents."""

import sys
from collections import Counter

import pytest

import corpus_pipeline as cp
from georisk.llm import quality_fm
from georisk.llm.common import cut_lineage, read_table, space_words

sys.path.insert(0, __file__.rpartition("/")[0])
from test_decontaminate import words  # noqa: E402
from test_simhash import brute_components, brute_fingerprint  # noqa: E402
from test_suffix_dedup import brute as brute_repeats  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    out = [read_table(spark, SF, "documents")]
    for name, stage in cp.STAGES:
        out.append(cut_lineage(stage(spark, out[-1], SF), name))
    return out


def rows(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_stages_are_the_dealt_ones_and_keep_the_columns(tables):
    assert [n for n, _ in cp.STAGES] == ["quality_classifier", "simhash_near_dedup", "suffix_array_dedup",
                                         "benchmark_decontamination", "mix_sources"]
    for t in tables[:-1]:
        assert t.dtypes == tables[0].dtypes
    assert tables[-1].columns[:5] == tables[0].columns


def test_quality_stage(spark, tables):
    machine = quality_fm.train(tables[0], read_table(spark, SF, "labels"))
    good = {r["doc_id"] for r in quality_fm.score(tables[0], machine).filter("predicted = 1").collect()}
    assert rows(tables[1]) == [x for x in rows(tables[0]) if x[0] in good]


def test_near_dedup_stage(tables):
    before = rows(tables[1])
    root = brute_components([(i, brute_fingerprint(t)) for i, t in before])
    assert rows(tables[2]) == [x for x in before if root[x[0]] == x[0]]


def test_suffix_stage(tables):
    before = rows(tables[2])
    hit = brute_repeats(before, 50)
    after = dict(rows(tables[3]))
    for i, t in before:
        left = [w for k, w in enumerate(space_words(t)) if k not in hit[i]]
        if hit[i] and not left:
            assert i not in after
        else:
            assert space_words(after[i]) == left and (hit[i] or after[i] == t)
    assert len(after) == tables[3].count()


def test_decontamination_stage(spark, tables):
    runs = set()
    for r in read_table(spark, SF, "benchmark").collect():
        w = words(r["text"])
        runs |= {tuple(w[s:s + 10]) for s in range(max(len(w) - 10, 0) + 1)} if w else set()
    sizes = {len(r) for r in runs}

    def clean(t):
        w = words(t)
        return not any(tuple(w[s:s + n]) in runs for n in sizes for s in range(len(w) - n + 1))
    assert rows(tables[4]) == [x for x in rows(tables[3]) if clean(x[1])]
    assert len(rows(tables[4])) < len(rows(tables[3]))


def test_mixing_stage(tables):
    assert rows(tables[5]) == rows(tables[4])
    place = [(r["mix_slot"], r["mix_position"], r["source"]) for r in tables[5].collect()]
    assert len({p for _, p, _ in place}) == len(place)
    assert sorted({s for s, *_ in place}) == list(range(len({s for s, *_ in place})))
    assert max(Counter({(s, x) for s, _, x in place}).values()) == 1 == max(Counter(s for s, _ in {(s, x) for s, _, x in place}).values())


def test_run_gives_the_last_stage(spark, tables):
    got = sorted((r["doc_id"], r["mix_position"]) for r in cp.run(spark, SF).collect())
    assert got == sorted((r["doc_id"], r["mix_position"]) for r in tables[5].collect())


def test_stages_take_nulls_ties_empty_tables_and_clashing_columns(spark):
    schema = ("doc_id long, text string, lang string, source string, n_chars long, score double, th long, items string, "
              "row string, component_id string, mix_slot string, label int")
    long = " ".join(f"word{i}" for i in range(120))
    extra = (None, 1, "x", "y", "z", "s", 3)
    data = [(1, None, None, None, None, *extra), (2, "", "en", "", 0, *extra), (None, long, None, "a", 5, *extra),
            (3, long, "en", "a", 5, *extra), (3, long, "en", "a", 5, *extra), (4, long + " tail", "en", None, None, *extra),
            (5, "w " * 50_000, "en", "b", 100_000, *extra)]
    for docs in (spark.createDataFrame(data, schema), spark.createDataFrame([], schema)):
        for name, stage in cp.STAGES:
            out = stage(spark, docs, SF)
            n = out.count()
            assert n <= docs.count()
            if name != "mix_sources":
                assert out.columns == docs.columns
            else:
                assert n == docs.count()
