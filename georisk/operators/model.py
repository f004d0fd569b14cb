"""Encoders, class weights, spark.ml training / tuning and scoring."""

from __future__ import annotations

import itertools
import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..params import FEATURE_COLUMNS


# --------------------------------------------------------------- encoders
def label_dictionary(df: DataFrame, col: str, numeric: bool = False) -> DataFrame:
    """Distinct labels of ``col`` with a 0-based code in sorted order.

    numeric=False sorts the *text* of the value (lexicographic: '10' < '2'),
    numeric=True sorts values.  The window runs over the distinct labels only.
    """
    from .ordering import dense_index
    lab = df.select(F.col(col).alias("_v")).distinct()
    lab = lab.withColumn("_key", F.col("_v") if numeric else F.col("_v").cast("string"))
    # distinct labels can be many: a range-partitioned dense index instead of one global window
    idx = dense_index(lab, [F.col("_key").asc_nulls_last()], out="_code")
    return idx.select("_v", F.col("_code").cast("int").alias("_code"))


def _join_dictionary(df: DataFrame, col: str, dic: DataFrame) -> DataFrame:
    return df.join(dic, df[col].eqNullSafe(dic["_v"]), "left").drop("_v")


def encode_label(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Label encoding fitted on ``df`` itself; missing values are a category of their own."""
    out = out or col
    dic = label_dictionary(df, col)
    res = _join_dictionary(df, col, dic)
    return res.withColumnRenamed("_code", out) if out != col else res.drop(col).withColumnRenamed("_code", col)


def apply_encoder(df: DataFrame, col: str, dictionary: DataFrame, out: str | None = None) -> DataFrame:
    """Transform with a stored dictionary (_v, _code); a label it doesn't hold gets the next free code.

    Unknown labels, whether numbers or text, share that one code: the number of labels in the dictionary.
    """
    out = out or col
    unknown = dictionary.agg(F.coalesce(F.max("_code") + 1, F.lit(0)).alias("_unknown"))   # one row
    dic = dictionary.withColumn("_v", F.col("_v").cast("string"))
    key = df.withColumn("_label", F.col(col).cast("string"))
    res = key.join(dic, F.col("_label").eqNullSafe(F.col("_v")), "left").crossJoin(F.broadcast(unknown))
    return res.withColumn(out, F.coalesce("_code", "_unknown").cast("int")).drop("_v", "_code", "_label", "_unknown")


def index_with_unknown(df: DataFrame, col: str, fitted_on: DataFrame, out: str | None = None,
                       numeric: bool = True) -> DataFrame:
    """Sorted distinct values of ``fitted_on`` -> 0..k-1; unknown or NULL -> k."""
    out = out or f"{col}_idx"
    dic = label_dictionary(fitted_on.filter(F.col(col).isNotNull()), col, numeric=numeric)
    k = dic.count()
    res = _join_dictionary(df, col, dic)
    return res.withColumn(out, F.coalesce(F.col("_code"), F.lit(k)).cast("int")).drop("_code")


# ----------------------------------------------------------- class weights
def class_weight_table(df: DataFrame, target: str = "target", mode: str = "balanced") -> DataFrame:
    """One row per class: balanced n/(k*n_c), or scale_pos (n_neg/n_pos on class 1, 1 elsewhere)."""
    cls = df.groupBy(target).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy()   # over the class table only
    if mode == "balanced":
        wt = F.sum("_n").over(w) / (F.count(F.lit(1)).over(w) * F.col("_n"))
    elif mode == "scale_pos":
        n_pos = F.sum(F.when(F.col(target) == 1, F.col("_n"))).over(w)
        n_neg = F.sum(F.when(F.col(target) == 0, F.col("_n"))).over(w)
        wt = F.when(F.col(target) == 1, n_neg / n_pos).otherwise(F.lit(1.0))
    else:
        raise ValueError(mode)
    return cls.select(target, wt.cast("double").alias("weight"))


def with_class_weights(df: DataFrame, target: str = "target", mode: str = "balanced") -> DataFrame:
    # a row per class: rows that are nearly all of one class must not be shuffled by it
    return df.join(F.broadcast(class_weight_table(df, target, mode)), target)


# --------------------------------------------------------------- spark.ml
RAW_LABEL, LABEL_CODE = "atm_raw", "atm_label"


def encoder_stage():
    """The label dictionary as a pipeline stage: text order, an unknown or missing label gets the next free code.

    It reads ``atm_raw``, the code as it comes, so a saved pipeline that begins with it can't be fed by mistake.
    """
    from pyspark.ml.feature import StringIndexer
    return StringIndexer(inputCol=RAW_LABEL, outputCol=LABEL_CODE, stringOrderType="alphabetAsc", handleInvalid="keep")


def has_encoder(fitted) -> bool:
    """Whether a fitted pipeline encodes the raw label itself."""
    from pyspark.ml.feature import StringIndexerModel
    return any(isinstance(s, StringIndexerModel) and s.getOrDefault(s.inputCol) == RAW_LABEL
               for s in getattr(fitted, "stages", []))


def with_raw_label(df: DataFrame) -> DataFrame:
    """``atm_raw`` beside ``atm`` if it isn't there."""
    return df if RAW_LABEL in df.columns else df.withColumn(RAW_LABEL, F.col("atm"))


def _encoded_columns(cols) -> list[str]:
    return [LABEL_CODE if c == "atm" else c for c in cols]


def formula_pipeline(rows: DataFrame, weights: dict | None = None, intercept: float | None = None):
    """The logistic formula as a fitted, storable pipeline whose encoder knows the labels of ``rows``."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer

    from .features import FORMULA_WEIGHTS, logistic_score_sql
    used = FORMULA_WEIGHTS if weights is None else weights
    sql = logistic_score_sql({LABEL_CODE if c == "atm" else c: w for c, w in used.items()}, intercept)
    return PipelineModel(stages=[encoder_stage().fit(with_raw_label(rows)),
                                 SQLTransformer(statement=f"SELECT *, {sql} AS probability FROM __THIS__")])


def _assembler(cols=FEATURE_COLUMNS):
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="keep")


def _front(cols, encode: bool) -> list:
    """First stages: the encoder if asked for, and the assembler."""
    return [encoder_stage(), _assembler(_encoded_columns(cols))] if encode else [_assembler(cols)]


def logistic_pipeline(cols=FEATURE_COLUMNS, C: float = 0.5, max_iter: int = 2000, sum_weights: float = 1.0,
                      encode: bool = False, **params):
    """Standardised L2 logistic regression with class weights.

    sklearn's objective sum(w_i * loss_i) + ||b||^2 / (2C) equals Spark's
    mean-loss objective with regParam = 1 / (C * sum(w)).
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StandardScaler
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    params = {"maxIter": max_iter, "regParam": 1.0 / (C * sum_weights), "elasticNetParam": 0.0} | params
    lr = LogisticRegression(featuresCol="scaled", labelCol="target", weightCol="weight", standardization=False, **params)
    return Pipeline(stages=[*_front(cols, encode), scaler, lr])


def tree_pipeline(kind: str = "gbt", cols=FEATURE_COLUMNS, seed: int = 42, encode: bool = False, **params):
    """Boosted trees or a forest.  Boosting with ``validationIndicatorCol`` stops at the best round of that part."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier

    from .forest import BinnedForest
    if kind == "gbt":
        est = GBTClassifier(featuresCol="features", labelCol="target", weightCol="weight", seed=seed, **params)
    elif kind == "rf":
        est = BinnedForest(featuresCol="features", labelCol="target", weightCol="weight", seed=seed, **params)
    else:
        raise ValueError(kind)
    return Pipeline(stages=[*_front(cols, encode), est])


def positive_probability(pred: DataFrame, out: str = "probability_1") -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    return pred.withColumn(out, vector_to_array("probability")[1])


def score(df: DataFrame, fitted, out: str = "probability") -> DataFrame:
    """P(class 1) for every row with a fitted PipelineModel (JVM-side)."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql.types import DoubleType
    pred = fitted.transform(df)
    p = F.col("probability") if pred.schema["probability"].dataType == DoubleType() else vector_to_array("probability")[1]
    return pred.select(*df.columns, p.alias(out))


def score_pandas(df: DataFrame, predict_proba, feature_cols=FEATURE_COLUMNS, out: str = "probability",
                 schema_extra: str | None = None) -> DataFrame:
    """Score with any Python model (``predict_proba(pandas_df) -> ndarray``) via Arrow batches."""
    schema = df.schema.simpleString()[len("struct<"):-1] + f",{out}:double"

    def run(batches):
        for pdf in batches:
            p = predict_proba(pdf[list(feature_cols)])
            yield pdf.assign(**{out: p[:, 1] if getattr(p, "ndim", 1) == 2 else p})

    return df.mapInPandas(run, schema_extra or schema)


def logistic_coefficients(fitted) -> tuple[dict, float]:
    """(weights per raw feature, intercept) from a fitted logistic pipeline, with the
    scaler folded in, so scoring can run as a plain column expression."""
    assembler, scaler, lr = fitted.stages[-3:]
    cols = assembler.getInputCols()
    mean, std = scaler.mean.toArray(), scaler.std.toArray()
    coef = lr.coefficients.toArray()
    w = {c: (coef[i] / std[i] if std[i] > 0 else 0.0) for i, c in enumerate(cols)}
    b = float(lr.intercept) - sum(coef[i] * mean[i] / std[i] for i in range(len(cols)) if std[i] > 0)
    return w, b


def random_param_maps(grid: dict, n: int, seed: int = 42):
    """n random points of a parameter space (lists are choices); a space of fewer points is an error."""
    rnd = random.Random(seed)
    keys = list(grid)
    all_points = list(itertools.product(*[grid[k] for k in keys]))
    if n > len(all_points):
        raise ValueError(f"{n} trials asked of a space of {len(all_points)} points")
    rnd.shuffle(all_points)
    return [dict(zip(keys, p)) for p in all_points[:n]]


def tune(pipeline, estimator, space: dict, train: DataFrame, n_trials: int = 10, train_ratio: float = 0.8,
         parallelism: int = 4, seed: int = 42):
    """Random search maximising recall of class 1 on a validation split inside ``train``."""
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import TrainValidationSplit
    maps = []
    for point in random_param_maps(space, n_trials, seed):
        maps.append({getattr(estimator, k): v for k, v in point.items()})
    ev = MulticlassClassificationEvaluator(labelCol="target", metricName="recallByLabel", metricLabel=1.0)
    tvs = TrainValidationSplit(estimator=pipeline, estimatorParamMaps=maps, evaluator=ev, trainRatio=train_ratio,
                               parallelism=parallelism, seed=seed)
    return tvs.fit(train)


def rank_features(spark, fitted, cols=FEATURE_COLUMNS, k: int = 15) -> DataFrame:
    """Top-k feature importances of a fitted tree pipeline, with the share of the total in percent
    (one decimal).  The importance vector has one entry per feature (bounded), so it is read on the driver."""
    est = fitted.stages[-1]
    imp = est.featureImportances.toArray()
    rows = [(c, float(v)) for c, v in zip(cols, imp)]
    df = spark.createDataFrame(rows, "feature string, importance double")
    w = Window.partitionBy()          # over the feature table (one row per feature)
    return df.withColumn("share_pct", F.round(F.col("importance") * 100 / F.sum("importance").over(w), 1)) \
        .orderBy(F.desc("importance"), F.asc("feature")).limit(k)


def standardize(df: DataFrame, cols, suffix: str = "_z") -> DataFrame:
    """z-score with the population standard deviation (ddof 0), statistics from ``df`` (one aggregation)."""
    stats = df.agg(*[F.avg(c).alias(f"_m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols])
    out = df.crossJoin(F.broadcast(stats))   # one row
    out = out.withColumns({f"{c}{suffix}": F.when(F.col(f"_s_{c}") > 0, (F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}"))
                           .otherwise(F.lit(0.0)) for c in cols})
    return out.drop(*[f"_m_{c}" for c in cols], *[f"_s_{c}" for c in cols])


def oversample(df: DataFrame, target: str = "target", factor: int | None = None) -> DataFrame:
    """Repeat positive rows ``factor`` times (default: n_neg // n_pos) for estimators without weights."""
    if factor is None:
        c = {r[target]: r["count"] for r in df.groupBy(target).count().collect()}   # one row per class
        factor = max(1, int(c.get(0, 0) // max(c.get(1, 1), 1)))
    reps = F.when(F.col(target) == 1, F.lit(factor)).otherwise(F.lit(1))
    return df.withColumn("_rep", F.explode(F.sequence(F.lit(1), reps))).drop("_rep")


def mlp_preparation(cols=FEATURE_COLUMNS, categorical=("atm", "road_type"), encode: bool = False):
    """Categorical columns one-hot encoded (unknown kept), the rest standardised, assembled to ``features``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StandardScaler, VectorAssembler
    if encode:
        cols, categorical = _encoded_columns(cols), _encoded_columns(categorical)
    cats = [c for c in categorical if c in cols]
    cont = [c for c in cols if c not in cats]
    ohe = OneHotEncoder(inputCols=cats, outputCols=[f"{c}_ohe" for c in cats], handleInvalid="keep")
    cont_vec = VectorAssembler(inputCols=cont, outputCol="_cont", handleInvalid="keep")
    scaler = StandardScaler(inputCol="_cont", outputCol="_cont_z", withMean=True, withStd=True)
    feats = VectorAssembler(inputCols=["_cont_z"] + [f"{c}_ohe" for c in cats], outputCol="features")
    return Pipeline(stages=[*([encoder_stage()] if encode else []), ohe, cont_vec, scaler, feats])


def validation_loss(prepared: DataFrame, fitted) -> float:
    """Weighted mean of -log p(label) over rows with ``features``, ``target`` and ``weight`` (one aggregation)."""
    from pyspark.ml.functions import vector_to_array
    p = F.greatest(F.element_at(vector_to_array("probability"), F.col("target").cast("int") + 1), F.lit(1e-15))
    row = fitted.transform(prepared).agg(F.sum(-F.log(p) * F.col("weight")) / F.sum("weight")).first()
    return float("inf") if row[0] is None else float(row[0])


def fit_mlp(train: DataFrame, cols=FEATURE_COLUMNS, categorical=("atm", "road_type"), hidden=(64, 32),
            max_iter: int = 100, seed: int = 42, encode: bool = False, validation: DataFrame | None = None,
            step: int = 10, patience: int = 6, tolerance: float = 1e-4):
    """Fit preparation + multilayer perceptron; the perceptron takes no weight column, so train it on
    ``oversample(train)``.  The input layer size is read from the assembled features.

    With ``validation`` rows (which must not be in ``train``; they carry
    ``weight``) training goes on in steps of ``step`` iterations, each from the
    weights and corrections of the one before.  It ends after ``patience`` steps that did not
    lower the validation loss by ``tolerance``, or at ``max_iter``; the weights
    of the best step are kept.  The losses are left in ``losses`` of the result.
    """
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import MultilayerPerceptronClassifier

    from . import perceptron
    prep_model = mlp_preparation(cols, categorical, encode).fit(train)
    prepared = prep_model.transform(train)
    n_in = prepared.select("features").first()[0].size
    mlp = MultilayerPerceptronClassifier(featuresCol="features", labelCol="target", layers=[n_in, *hidden, 2],
                                         maxIter=max_iter, seed=seed)
    held = None if validation is None else perceptron.stored_blocks(prep_model.transform(validation), n_in, "weight")
    best, losses = perceptron.train(mlp, perceptron.stored_blocks(prepared, n_in), held, max_iter, step, patience, tolerance)
    out = PipelineModel(stages=[*prep_model.stages, best])
    out.losses = losses
    return out
