"""Registered sampling / split / encoding queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import sql_hash_draw as H
from ..operators import model, sampling
from ..operators import spatial
from ..sources import bindings as B
from . import jobs
from .q_spatial import ROAD_GRID_CTES, SAFE_SQL
from .registry import r6, register

SEED = 42


def _safe_points(spark, sf_dir):
    g = jobs.road_grid(spark, B.roads(spark, sf_dir), meters=200.0, dedupe=True).select("latitude", "longitude")
    return g, spatial.exclude_near_points(g, B.acc(spark, sf_dir), 300.0)


NEG_SQL = f"""WITH safe AS ({SAFE_SQL}),
sidx AS (SELECT latitude, longitude, row_number() OVER (ORDER BY latitude, longitude) - 1 AS idx FROM safe),
eidx AS (SELECT datetime, atm, row_number() OVER (ORDER BY datetime, num_acc) - 1 AS idx FROM acc),
nn AS (SELECT least(c.n_ev * 22000, c.n_pts * 10) AS n, c.* FROM
       (SELECT (SELECT count(*) FROM acc) AS n_ev, (SELECT count(*) FROM safe) AS n_pts,
               (SELECT min(datetime) FROM acc) AS tmin, (SELECT max(datetime) FROM acc) AS tmax) c),
draws AS (SELECT unnest(range(n)) AS sample_id FROM nn),
d2 AS (SELECT d.sample_id,
         {H(SEED, 'point', 'd.sample_id')} % nn.n_pts AS pi,
         {H(SEED, 'time', 'd.sample_id')} % nn.n_ev AS ti,
         {H(SEED, 'atm', 'd.sample_id')} % nn.n_ev AS ai,
         {H(SEED, 'uniform', 'd.sample_id')} / 1152921504606846976e0 AS u,
         row_number() OVER (ORDER BY {H(SEED, 'shuffle', 'd.sample_id')}, d.sample_id) - 1 AS pos,
         nn.n, nn.tmin, nn.tmax FROM draws d, nn),
neg AS (SELECT d2.sample_id,
         CASE WHEN d2.pos < CAST(floor(d2.n * 0.85e0) AS BIGINT) THEN et.datetime
              ELSE d2.tmin + to_seconds(CAST(floor(d2.u * (date_diff('microsecond', d2.tmin, d2.tmax) / 1e6)) AS BIGINT))
         END AS datetime,
         s.latitude, s.longitude, ea.atm
       FROM d2 JOIN sidx s ON s.idx = d2.pi JOIN eidx et ON et.idx = d2.ti JOIN eidx ea ON ea.idx = d2.ai)
SELECT sample_id, datetime, latitude, longitude, atm, CAST(hour(datetime) AS INT) AS hour,
       CAST(isodow(datetime) - 1 AS INT) AS dayofweek, CAST(month(datetime) AS INT) AS month, 0 AS target FROM neg"""


@register("negative_samples", B.with_views("SELECT * FROM (" + NEG_SQL + ")", "grid", "roads", "acc",
                                           extra=ROAD_GRID_CTES))
def q_negatives(spark, sf_dir):
    """Synthetic negatives: safe road points drawn with replacement + time mixture + drawn atm."""
    road, safe = _safe_points(spark, sf_dir)
    return sampling.generate_negatives(spark, B.acc(spark, sf_dir), safe, road, seed=SEED)


@register("sample_with_replacement", B.with_views(
    f"""SELECT * FROM (WITH pidx AS (SELECT latitude, longitude, row_number() OVER (ORDER BY latitude, longitude) - 1 AS idx
                     FROM road_grid),
        nn AS (SELECT count(*) AS n FROM road_grid),
        draws AS (SELECT unnest(range(n * 10)) AS sample_id, n FROM nn)
     SELECT d.sample_id, p.latitude, p.longitude FROM draws d
     JOIN pidx p ON p.idx = {H(SEED, 'grid_draw', 'd.sample_id')} % d.n)""",
    "grid", "roads", extra=ROAD_GRID_CTES))
def q_sample_wr(spark, sf_dir):
    """Exactly 10 x |road grid| draws with replacement from the road grid."""
    g = jobs.road_grid(spark, B.roads(spark, sf_dir), meters=200.0, dedupe=True).select("latitude", "longitude")
    n = g.count() * 10
    return sampling.sample_with_replacement(spark, g, n, SEED, "grid_draw", ["latitude", "longitude"]) \
        .select("sample_id", "latitude", "longitude")


LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
           "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
LI_HASH = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def split_sql(table: str, cols, hash_cols, target: str | None, test: float = 0.2) -> str:
    tgt = target or "'_all'"
    order = ", ".join(f"{c} NULLS FIRST" for c in cols)
    return f"""WITH t AS (SELECT *, {tgt} AS _cls, {H(SEED, 'split', *hash_cols)} AS _h FROM {table}),
cls AS (SELECT _cls, count(*) AS n FROM t GROUP BY _cls),
q AS (SELECT _cls, n, floor({test!r}e0 * n) AS base, {test!r}e0 * n - floor({test!r}e0 * n) AS frac FROM cls),
ex AS (SELECT ceil({test!r}e0 * sum(n)) - sum(base) AS extra FROM q),
quota AS (SELECT _cls, base + CASE WHEN row_number() OVER (ORDER BY frac DESC, _cls) <= (SELECT extra FROM ex)
                                   THEN 1 ELSE 0 END AS k FROM q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY _cls ORDER BY _h, {order}) AS rn FROM t)
SELECT {", ".join(cols)}, CASE WHEN rn <= k THEN 'test' ELSE 'train' END AS split
FROM ranked JOIN quota USING (_cls)"""


@register("stratified_split", split_sql("lineitem", LI_COLS, LI_HASH, "l_returnflag"))
def q_stratified(spark, sf_dir):
    """Exact 80/20 split stratified by l_returnflag (largest-remainder quotas, hash order)."""
    li = B.strata(spark, sf_dir).select(*LI_COLS)
    return sampling.stratified_split(li, "l_returnflag", 0.2, SEED, hash_cols=LI_HASH)


@register("split_sizes", "SELECT l_returnflag, split, count(*) AS n FROM (" +
          split_sql("lineitem", LI_COLS, LI_HASH, "l_returnflag") + ") GROUP BY 1, 2")
def q_split_sizes(spark, sf_dir):
    """Class x split counts of the stratified split (train/test sizes per class)."""
    return q_stratified(spark, sf_dir).groupBy("l_returnflag", "split").agg(F.count(F.lit(1)).alias("n"))


ORD_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@register("random_split", split_sql("orders", ORD_COLS, ["o_orderkey"], None))
def q_random_split(spark, sf_dir):
    """Exact (not stratified) 80/20 split of orders."""
    o = B.table(spark, sf_dir, "orders").select(*ORD_COLS)
    return sampling.random_split(o, 0.2, SEED, hash_cols=["o_orderkey"])


@register("class_weights", B.with_views(
    """SELECT s.doc_id, s.label, round(c.total / (2e0 * c.n), 6) AS weight
       FROM scored s JOIN (SELECT label, count(*) AS n, sum(count(*)) OVER () AS total FROM scored GROUP BY label) c
       USING (label)""", "scored"))
def q_class_weights(spark, sf_dir):
    """Balanced class weight n / (k * n_c) attached to every row."""
    w = model.with_class_weights(B.scored(spark, sf_dir), "label", "balanced")
    return w.select("doc_id", "label", r6(F.col("weight")).alias("weight"))


@register("encode_label", B.with_views(
    """SELECT num_acc, atm, CAST(dense_rank() OVER (ORDER BY CAST(atm AS VARCHAR)) - 1 AS INT) AS atm_code
       FROM acc""", "acc"))
def q_encode(spark, sf_dir):
    """atm -> code in lexicographic order of its text."""
    a = B.acc(spark, sf_dir).select("num_acc", "atm")
    return model.encode_label(a, "atm", "atm_code")
