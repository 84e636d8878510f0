"""Model data preparation, classifiers and grid search on ``pyspark.ml``.

Preparation is explicit DataFrame code where it must be exact and reproducible
(stratified splits, imputation, scaling, class weights); models are the built-in
distributed estimators.  Class imbalance is handled with a weight column
(balanced weights n / (k * n_c)), which every estimator that supports
``weightCol`` consumes -- the scalable alternative to synthetic oversampling.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_table
from .drift import quantile_edges
from .ordered import ordered_scan

SEED = 42


# ---------------------------------------------------------------------------
# stratified splits
# ---------------------------------------------------------------------------


def _order_hash(key: str, seed: int, method: str) -> Column:
    if method == "md5":
        return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    return F.xxhash64(F.col(key), F.lit(seed))


def stratified_assign(df: DataFrame, label: str, key: str, shares: Sequence[tuple[str, float]], seed: int = SEED,
                      method: str = "xxhash64", out: str = "split") -> DataFrame:
    """Exact per-class shares: rank rows of each class by hash(key, seed); the first
    ceil(share_1 * n_c) go to the first split, the next up to ceil((share_1 + share_2) * n_c) to the second, ...

    The per-class rank is the skew-safe ordered scan (a class is a hot key by nature).
    """
    h = _order_hash(key, seed, method)
    ranked = ordered_scan(df.withColumn("_h", h), [label], [F.col("_h"), F.col(key)], rank_col="_r")
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))  # one row per class
    with_n = ranked.join(F.broadcast(sizes), on=label, how="inner")
    expr = None
    cum = 0.0
    for name, share in shares[:-1]:
        cum += share
        cond = F.col("_r") <= F.ceil(F.col("_n") * F.lit(cum))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    last = shares[-1][0]
    expr = F.lit(last) if expr is None else expr.otherwise(F.lit(last))
    return with_n.select(*df.columns, expr.alias(out))


def stratified_split(df: DataFrame, label: str = "TARGET", key: str = "SK_ID_CURR", seed: int = SEED, method: str = "xxhash64") -> DataFrame:
    """60 / 20 / 20 train / validation / test per class (20 % test first, then 25 % of the rest)."""
    return stratified_assign(df, label, key, [("test", 0.2), ("validation", 0.2), ("train", 0.6)], seed, method)


def stratified_subsample(df: DataFrame, fraction: float, label: str = "TARGET", key: str = "SK_ID_CURR",
                         seed: int = SEED, method: str = "xxhash64") -> DataFrame:
    """Exactly ceil(fraction * n_c) rows of every class."""
    tagged = stratified_assign(df, label, key, [("keep", fraction), ("drop", 1.0 - fraction)], seed, method, out="_s")
    return tagged.filter(F.col("_s") == "keep").drop("_s")


# ---------------------------------------------------------------------------
# imputation, scaling, encoding, weights
# ---------------------------------------------------------------------------


def fit_medians(train: DataFrame, cols: Sequence[str], relative_error: float = 0.001) -> dict[str, float]:
    """Median of each column on the fitting rows (rank ceil(n/2) when exact); one job, one number per column."""
    if relative_error > 0:
        return {c: float(v[0]) for c, v in zip(cols, train.approxQuantile(list(cols), [0.5], relative_error)) if v}
    q = quantile_edges(train, cols, buckets=2, relative_error=relative_error).filter(F.col("q_index") == 1)
    return {r["feature"]: r["value"] for r in q.collect()}


def impute_median(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    return df.select(*[
        F.coalesce(F.col(c).cast("double"), F.lit(medians[c])).alias(c) if c in medians else F.col(c)
        for c in df.columns
    ])


def fit_modes(train: DataFrame, cols: Sequence[str]) -> dict[str, str]:
    """Most frequent value per column (ties: smallest value); one aggregate over (column, value) counts."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols])
    counts = train.select(F.inline(pairs)).filter(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("feature").agg(F.min_by("value", F.struct((-F.col("n")).alias("neg_n"), F.col("value"))).alias("mode"))
    return {r["feature"]: r["mode"] for r in best.collect()}  # one value per column


def impute_mode(df: DataFrame, modes: dict[str, str]) -> DataFrame:
    return df.select(*[
        F.coalesce(F.col(c).cast("string"), F.lit(modes[c])).alias(c) if c in modes else F.col(c)
        for c in df.columns
    ])


def fit_scaler(train: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column (one aggregate)."""
    row = train.agg(*[a for c in cols for a in (F.avg(c).alias(f"{c}__m"), F.stddev_pop(c).alias(f"{c}__s"))]).first()
    return {c: (row[f"{c}__m"], row[f"{c}__s"]) for c in cols}


def standard_scale(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    """(x - mean) / sd; a zero (or undefined) sd leaves x - mean."""
    out = []
    for c in df.columns:
        if c in params:
            m, s = params[c]
            m = 0.0 if m is None else m
            scale = s if s else 1.0
            out.append(((F.col(c).cast("double") - F.lit(m)) / F.lit(scale)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def class_weights(df: DataFrame, label: str = "TARGET") -> DataFrame:
    """(label, n_rows, weight) with balanced weights n / (k * n_c)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))
    stats = counts.agg(F.sum("n_rows").alias("n"), F.count(F.lit(1)).alias("k")).first()  # two numbers
    return counts.select(label, "n_rows", (F.lit(float(stats["n"])) / (F.lit(float(stats["k"])) * F.col("n_rows"))).alias("weight"))


def encoder_stages(categorical: Sequence[str], numeric: Sequence[str], features: str = "features"):
    """StringIndexer(keep) + OneHotEncoder(dropLast): an unseen or null category encodes as all zeros."""
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep", stringOrderType="alphabetAsc") for c in categorical]
    ohe = OneHotEncoder(inputCols=[f"{c}__idx" for c in categorical], outputCols=[f"{c}__ohe" for c in categorical], dropLast=True,
                        handleInvalid="keep")
    asm = VectorAssembler(inputCols=list(numeric) + [f"{c}__ohe" for c in categorical], outputCol=features, handleInvalid="keep")
    return idx + ([ohe] if categorical else []) + [asm]


# ---------------------------------------------------------------------------
# model preparation end to end
# ---------------------------------------------------------------------------


def prepare_model_frame(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str = "TARGET",
                        key: str = "SK_ID_CURR", split_method: str = "xxhash64", exact_median: bool = False):
    """Split, then fit imputers and scaler on train only, apply to every split, add class weights.

    Returns (frame with split/label/weight/features-ready columns, fitted encoder pipeline).
    """
    base = df.select(key, F.col(label).cast("int").alias(label), *numeric, *[F.col(c).cast("string").alias(c) for c in categorical])
    split = stratified_split(base, label, key, method=split_method)
    # The fits below read the split eight times: they read a written copy, so that its order is made once for them.
    train = scratch_table(split, "model-split").filter(F.col("split") == "train")
    medians = fit_medians(train, numeric, 0.0 if exact_median else 0.001)
    modes = fit_modes(train, categorical) if categorical else {}
    scaler = fit_scaler(impute_mode(impute_median(train, medians), modes), numeric)
    weights = class_weights(train, label).select(label, "weight")

    def weighted(rows: DataFrame) -> DataFrame:
        return standard_scale(impute_mode(impute_median(rows, medians), modes), scaler).join(F.broadcast(weights), label, "left")

    enc = Pipeline(stages=encoder_stages(categorical, numeric)).fit(weighted(train))
    # iterative learners re-read their input many times: cut the lineage once
    # (reliable checkpoint in the shared checkpoint folder, survives executor loss)
    ensure_checkpoint_dir(df.sparkSession)
    return enc.transform(weighted(split)).checkpoint(eager=True), enc


# ---------------------------------------------------------------------------
# classifiers
# ---------------------------------------------------------------------------


def make_classifier(kind: str, n_features: int, label: str = "TARGET", weight: str = "weight", n_train: int = 1000):
    """The model zoo of the study, as pyspark.ml estimators (C = 1 -> regParam 1 / (C n))."""
    common = {"featuresCol": "features", "labelCol": label}
    reg = 1.0 / max(n_train, 1)
    if kind == "logreg_l2":
        return LogisticRegression(elasticNetParam=0.0, regParam=reg, standardization=False, maxIter=300, weightCol=weight, **common)
    if kind == "logreg_l1":
        return LogisticRegression(elasticNetParam=1.0, regParam=reg, standardization=False, maxIter=300, weightCol=weight, **common)
    if kind == "gaussian_nb":
        return NaiveBayes(modelType="gaussian", weightCol=weight, **common)
    if kind == "random_forest":
        return RandomForestClassifier(numTrees=100, maxDepth=5, weightCol=weight, seed=SEED, **common)
    if kind == "gbt":
        return GBTClassifier(maxIter=50, maxDepth=4, stepSize=0.1, weightCol=weight, seed=SEED, **common)
    if kind == "linear_svc":
        return LinearSVC(regParam=reg, maxIter=300, weightCol=weight, **common)
    if kind == "mlp":
        return MultilayerPerceptronClassifier(layers=[n_features, 64, 64, 64, 2], maxIter=100, seed=SEED, **common)
    raise ValueError(f"unknown model kind: {kind}")


def without_summary(model, spark: SparkSession):
    """The model as it is read back from the shared folder.

    A model that was just fitted keeps a training summary, which holds the session; once a query of that session has been
    observed, such a model can no longer be sent to tasks.
    """
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    model.write().session(spark).save(path)
    return type(model).read().session(spark).load(path)


def positive_score(pred: DataFrame) -> Column:
    """Score of class 1: probability when the model has one, else the raw margin."""
    if "probability" in pred.columns:
        return vector_to_array(F.col("probability"))[1]
    return vector_to_array(F.col("rawPrediction"))[1]


def replicate_minority(train: DataFrame, label: str) -> DataFrame:
    """Repeat rows of the rarer class a whole number of times, map-side, towards equal classes (for models without weights)."""
    sizes = {r[label]: r["count"] for r in train.groupBy(label).count().collect()}  # one row per class
    most = max(sizes.values(), default=0)
    times = F.coalesce(*[F.when(F.col(label) == c, F.lit(max(1, round(most / n)))) for c, n in sizes.items()], F.lit(1))
    return train.withColumn("_copy", F.explode(F.sequence(F.lit(1), times))).drop("_copy")


def fit_and_predict(frame: DataFrame, kind: str, label: str = "TARGET", key: str = "SK_ID_CURR") -> DataFrame:
    """Fit on train and validation (the neural net, which keeps validation aside, on train), predict test: (key, y, pred, score)."""
    train = frame.filter(F.col("split") == "train" if kind == "mlp" else F.col("split") != "test")
    if kind == "mlp":
        train = replicate_minority(train, label)
    n_features = len(train.select("features").first()["features"])
    n_train = train.count()
    model = without_summary(make_classifier(kind, n_features, label, n_train=n_train).fit(train), frame.sparkSession)
    pred = model.transform(frame.filter(F.col("split") == "test"))
    return pred.select(key, F.col(label).alias("y"), F.col("prediction").cast("int").alias("pred"), positive_score(pred).alias("score"))


def grid_search(frame: DataFrame, label: str = "TARGET", folds: int = 3):
    """3-fold cross-validated grid over logistic regression strength, scored by recall of class 1."""
    train = frame.filter(F.col("split") != "test")
    est = LogisticRegression(featuresCol="features", labelCol=label, weightCol="weight", maxIter=100, standardization=False)
    n = train.count()
    grid = ParamGridBuilder().addGrid(est.regParam, [1.0 / (0.1 * n), 1.0 / (1.0 * n)]).build()
    ev = MulticlassClassificationEvaluator(labelCol=label, metricName="recallByLabel", metricLabel=1.0)
    cv = CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=ev, numFolds=folds, seed=SEED, parallelism=2)
    model = cv.fit(train)
    return model, grid


def gaussian_nb_moments(frame: DataFrame, numeric: Sequence[str], label: str = "TARGET") -> DataFrame:
    """Per class and feature: weighted-free mean and population variance (what Gaussian NB estimates)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in numeric])
    long = frame.select(F.col(label).alias("label"), F.inline(pairs))
    return long.groupBy("label", "feature").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.var_pop("value").alias("variance")
    )
