"""Random search with successive halving over continuous and discrete spaces.

All trials start with a small budget (rounds of boosting, trees, iterations);
the better part of them goes on with a larger one, until the survivors have had
the whole.  Every trial is scored on one validation part carved out of the
training rows, by recall of class 1, then by F1.
"""

from __future__ import annotations

import json
import math
import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import evaluate, model, sampling


@dataclass(frozen=True)
class Uniform:
    low: float
    high: float

    def draw(self, rnd: random.Random) -> float:
        return rnd.uniform(self.low, self.high)


@dataclass(frozen=True)
class LogUniform(Uniform):
    def draw(self, rnd: random.Random) -> float:
        return math.exp(rnd.uniform(math.log(self.low), math.log(self.high)))


@dataclass(frozen=True)
class IntRange:
    low: int
    high: int   # included

    def draw(self, rnd: random.Random) -> int:
        return rnd.randint(self.low, self.high)


def draw_trials(space: dict, n: int, seed: int = 42) -> list[dict]:
    """``n`` different points: distributions are drawn, lists are choices.  A space that has fewer raises."""
    rnd, out, seen = random.Random(seed), [], set()
    for _ in range(100 * n):
        if len(out) == n:
            break
        point = {k: v.draw(rnd) if hasattr(v, "draw") else rnd.choice(list(v)) for k, v in space.items()}
        key = json.dumps(point, sort_keys=True)
        if key not in seen:
            seen.add(key)
            out.append(point)
    if len(out) < n:
        raise ValueError(f"{n} trials asked of a space of about {len(out)} points")
    return out


def budgets(least: int, most: int, eta: int) -> list[int]:
    """least, least * eta, ... and ``most`` as the last."""
    out = [most]
    while out[0] > least:
        out.insert(0, max(least, out[0] // eta))
    return out


def with_validation(train: DataFrame, share: float = 0.2, seed: int = 42, target: str = "target", hash_cols=None,
                    out: str = "is_validation") -> DataFrame:
    """Training rows with a flag on an exact, stratified part of them."""
    split = sampling.stratified_split(train, target, share, seed, hash_cols)
    return split.withColumn(out, F.col("split") == "test").drop("split")


@dataclass
class Tuned:
    params: dict
    fitted: object
    trials: DataFrame   # (trial, rung, budget, params, recall, f1, dropped)


def halving(build, space: dict, train: DataFrame, n_trials: int, budget: tuple[str, int, int], eta: int = 3,
            share: float = 0.2, seed: int = 42, parallelism: int = 4, hash_cols=None) -> Tuned:
    """Try ``n_trials`` points of ``space`` and return the best one, fitted on all of ``train`` with the whole budget.

    ``build(params)`` gives an unfitted pipeline; ``budget`` is (parameter,
    least, most).  After each rung the best 1 / ``eta`` of the trials go on
    (ties: the earlier trial), the others are dropped and stay in the log.
    """
    spark = train.sparkSession
    flagged = cut_lineage(with_validation(train, share, seed, hash_cols=hash_cols), "tuning_rows")
    fit_rows, held = flagged.filter("NOT is_validation"), flagged.filter("is_validation")
    points = draw_trials(space, n_trials, seed)
    name, least, most = budget
    steps = budgets(least, most, eta)
    live, log, ranked = list(range(n_trials)), [], []

    def judge(trial, amount):
        fitted = build(points[trial] | {name: amount}).fit(fit_rows)
        s = model.score(held, fitted, out="score").select(F.col("target").alias("label"), "score")
        return evaluate.metrics_from_counts(evaluate.confusion_counts(s)).select("recall", "f1").first()

    for rung, amount in enumerate(steps):
        with ThreadPoolExecutor(parallelism) as pool:
            run = inheritable_thread_target(spark)(lambda t, a=amount: judge(t, a))
            found = dict(zip(live, pool.map(run, live)))
        ranked = sorted(live, key=lambda t: (-found[t]["recall"], -found[t]["f1"], t))
        keep = set(ranked[:max(1, math.ceil(len(ranked) / eta))] if rung + 1 < len(steps) else ranked[:1])
        log += [(t, rung, amount, json.dumps(points[t], sort_keys=True), found[t]["recall"], found[t]["f1"], t not in keep)
                for t in live]
        live = [t for t in live if t in keep]
    best = points[ranked[0]] | {name: most}
    rows = spark.createDataFrame(log, "trial int, rung int, budget int, params string, recall double, f1 double, dropped boolean")
    return Tuned(best, build(best).fit(train), rows)
