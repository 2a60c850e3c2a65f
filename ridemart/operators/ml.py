"""Tip-amount linear regression with ``pyspark.ml``.

Feature table -> deterministic train/eval split -> Imputer, StringIndexer,
OneHotEncoder less a reference level, VectorAssembler, LinearRegression.
Fitting with the normal-equation solver is one distributed pass that builds
the (small) Gram matrix with a tree aggregate, then a driver-side solve over a
few hundred coefficients. Feature info and evaluation are single aggregates; their
medians are exact, by distributed selection (``quantiles``). Explanations are
plain column arithmetic over the fitted coefficients. A penalised fit is checked
by the optimality conditions of its objective (``optimality``).
"""

from __future__ import annotations

import random
from multiprocessing.pool import ThreadPool
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import (
    Imputer,
    ImputerModel,
    OneHotEncoder,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridemart.functions import safe_int
from ridemart.operators.quantiles import exact_quantiles
from ridemart.session import scratch_path

LABEL = "tip_amount"
NUMERIC = ["passenger_count", "trip_distance", "fare_amount", "tolls_amount"]
CATEGORICAL = ["PULocationID", "DOLocationID", "payment_type"]
FEATURES = ["passenger_count", "trip_distance", "PULocationID", "DOLocationID", "payment_type",
            "fare_amount", "tolls_amount"]
PREDICTION = f"predicted_{LABEL}"

FEATURE_SCHEMA = T.StructType([
    T.StructField("passenger_count", T.LongType()), T.StructField("trip_distance", T.DoubleType()),
    T.StructField("PULocationID", T.StringType()), T.StructField("DOLocationID", T.StringType()),
    T.StructField("payment_type", T.StringType()), T.StructField("fare_amount", T.DoubleType()),
    T.StructField("tolls_amount", T.DoubleType()),
])


def select_features(df: DataFrame) -> DataFrame:
    """The model's columns, trips with a non-zero fare only."""
    return df.where(F.col("fare_amount") != 0).select(*FEATURES, LABEL)


def ml_table(df: DataFrame) -> DataFrame:
    """Typed feature table (M1, T6): ids and payment type as text, counts as integers."""
    x = df.where(F.col("fare_amount") != 0)
    return x.select(
        safe_int(x["passenger_count"], x.schema["passenger_count"].dataType).alias("passenger_count"),
        F.col("trip_distance").cast(T.DoubleType()).alias("trip_distance"),
        F.col("PULocationID").cast(T.StringType()).alias("PULocationID"),
        F.col("DOLocationID").cast(T.StringType()).alias("DOLocationID"),
        F.col("payment_type").cast(T.StringType()).alias("payment_type"),
        F.col("fare_amount").cast(T.DoubleType()).alias("fare_amount"),
        F.col("tolls_amount").cast(T.DoubleType()).alias("tolls_amount"),
        F.col(LABEL).cast(T.DoubleType()).alias(LABEL),
    )


def split_bucket(cols: list[str] = FEATURES + [LABEL]) -> Column:
    """Repeatable bucket 0..9 from an MD5 of the row's values (no random state)."""
    txt = F.concat_ws("|", *[F.coalesce(F.col(c).cast(T.StringType()), F.lit("")) for c in cols])
    return F.pmod(F.conv(F.substring(F.md5(txt), 1, 8), 16, 10).cast(T.LongType()), F.lit(10))


def auto_split(df: DataFrame, eval_fraction: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """Deterministic train/eval split (M3): buckets below ``eval_fraction*10`` are eval rows."""
    cut = int(round(eval_fraction * 10))
    b = split_bucket()
    return df.where(b >= cut), df.where(b < cut)


def _numeric_inputs(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast(T.DoubleType()).alias(c) if c in NUMERIC else F.col(c)
                       for c in df.columns])


def fit_features(train: DataFrame, numeric: list[str] = NUMERIC, categorical: list[str] = CATEGORICAL) -> list:
    """Fitted feature stages (M2): indexed and one-hot categories, mean-imputed numbers, one ``features`` vector.

    The first category (in alphabetic order) of every categorical input is its
    reference level and has no column, so that with the intercept no column is
    a sum of others and the fit has one solution. A category unseen in
    training, NULL included, counts as the reference level.
    """
    stages, names, keep = [], [], list(range(len(numeric)))
    if numeric:
        imputer = Imputer(inputCols=numeric, outputCols=[f"{c}_imp" for c in numeric], strategy="mean").fit(train)
        stages.append(imputer)
        names += [f"{c}_imp" for c in numeric]
    if categorical:
        index = StringIndexer(inputCols=categorical, outputCols=[f"{c}_idx" for c in categorical], handleInvalid="keep",
                              stringOrderType="alphabetAsc").fit(train)
        # the level kept for unseen categories is the last one, which dropLast leaves out
        onehot = OneHotEncoder(inputCols=[f"{c}_idx" for c in categorical], outputCols=[f"{c}_vec" for c in categorical],
                               dropLast=True).fit(index.transform(train))
        stages += [index, onehot]
        names += [f"{c}_vec" for c in categorical]
        at = len(numeric)
        for labels in index.labelsArray:
            keep += range(at + 1, at + len(labels))
            at += len(labels)
    stages.append(VectorAssembler(inputCols=names, outputCol="all_features", handleInvalid="keep"))
    stages.append(VectorSlicer(inputCol="all_features", outputCol="features", indices=keep))
    return stages


def regression(reg_param: float = 0.0, elastic_net: float = 0.0, label: str = LABEL) -> LinearRegression:
    """Least squares by the normal equations: one pass over the rows, at most 4,096 feature columns (else an error)."""
    return LinearRegression(featuresCol="features", labelCol=label, predictionCol=PREDICTION,
                            regParam=reg_param, elasticNetParam=elastic_net, solver="normal")


def _to_scratch(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def train_tip_model(df: DataFrame, reg_param: float = 0.0, elastic_net: float = 0.0, eval_fraction: float = 0.2,
                    numeric: list[str] = NUMERIC, categorical: list[str] = CATEGORICAL) -> PipelineModel:
    """Fit on the train split of rows with a label (M2, M3).

    The training projection is written to shared scratch once, for the few
    passes of the fit (indexer, imputer, solver).
    """
    train, _ = auto_split(df.where(F.col(LABEL).isNotNull()), eval_fraction)
    train = _to_scratch(_numeric_inputs(train), "ml_train")
    stages = fit_features(train, numeric, categorical)
    return PipelineModel([*stages, regression(reg_param, elastic_net).fit(PipelineModel(stages).transform(train))])


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Input columns plus ``predicted_tip_amount`` (M6)."""
    own = [F.col(f.name).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    return model.transform(_numeric_inputs(df)).select(*own, PREDICTION)


def feature_info(df: DataFrame, numeric: list[str] = NUMERIC, categorical: list[str] = CATEGORICAL) -> DataFrame:
    """Per input: min, max, mean, median, stddev, category_count, null_count (M4).

    One aggregate pass over the table, then ``stack`` turns the single row
    into one row per input. Medians are exact (a few more passes over the numbers);
    the inputs are written to scratch once, for all these passes.
    """
    df = _to_scratch(df.select(*numeric, *categorical), "ml_inputs")
    medians = exact_quantiles(df, {c: F.col(c) for c in numeric})
    aggs = []
    for c in numeric:
        x = F.col(c).cast(T.DoubleType())
        aggs += [F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max"), F.avg(x).alias(f"{c}__mean"),
                 F.max(F.lit(medians[c]).cast(T.DoubleType())).alias(f"{c}__median"),
                 F.stddev_samp(x).alias(f"{c}__stddev"), F.count_if(x.isNull()).alias(f"{c}__nulls")]
    for c in categorical:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"))
    row = df.agg(*aggs)
    for c in categorical:       # a small aggregate each: several distinct counts in one would multiply the rows
        cats = df.groupBy(c).agg(F.lit(1).alias("one")).agg(F.count(c).alias(f"{c}__cats"))
        row = row.join(F.broadcast(cats))       # one row each
    parts = []
    for c in numeric:
        parts += [f"'{c}'", f"`{c}__min`", f"`{c}__max`", f"`{c}__mean`", f"`{c}__median`", f"`{c}__stddev`",
                  "CAST(NULL AS BIGINT)", f"`{c}__nulls`"]
    for c in categorical:
        parts += [f"'{c}'"] + ["CAST(NULL AS DOUBLE)"] * 5 + [f"`{c}__cats`", f"`{c}__nulls`"]
    n = len(numeric) + len(categorical)
    return row.selectExpr(
        f"stack({n}, {', '.join(parts)}) AS (input, min, max, mean, median, stddev, category_count, null_count)")


def evaluate(pred: DataFrame, label: str = LABEL, prediction: str = PREDICTION) -> DataFrame:
    """Regression metrics in one aggregate (M5); the median is exact.

    The pairs (label, prediction) are written to scratch once, for the passes of the median.
    """
    y, p = F.col("y"), F.col("p")
    x = _to_scratch(pred.select(F.col(label).cast(T.DoubleType()).alias("y"), F.col(prediction).cast(T.DoubleType()).alias("p"))
                    .where(y.isNotNull() & p.isNotNull()), "ml_pairs")
    err = p - y
    median = exact_quantiles(x, {"e": F.abs(err)})["e"]
    row = x.agg(
        F.avg(F.abs(err)).alias("mean_absolute_error"),
        F.avg(err * err).alias("mean_squared_error"),
        # defined above -1 only: one row outside makes the whole metric NULL
        F.when(F.min(F.least(p, y)) > -1, F.avg(F.pow(F.log1p(p) - F.log1p(y), 2))).alias("mean_squared_log_error"),
        F.max(F.lit(median).cast(T.DoubleType())).alias("median_absolute_error"),
        F.sum(err * err).alias("_ss_res"),
        F.var_pop(y).alias("_var_y"),
        F.var_pop(y - p).alias("_var_res"),
        F.count(F.lit(1)).alias("_n"),
    )
    return row.select(
        "mean_absolute_error", "mean_squared_error", "mean_squared_log_error", "median_absolute_error",
        # a constant label has no variance to explain: NULL
        (F.lit(1.0) - F.try_divide(F.col("_ss_res"), F.col("_var_y") * F.col("_n"))).alias("r2_score"),
        (F.lit(1.0) - F.try_divide(F.col("_var_res"), F.col("_var_y"))).alias("explained_variance"),
    )


# ---- explanations ----------------------------------------------------------------------

@dataclass
class LinearTerms:
    """A linear model in input terms: prediction = intercept + sum of per-input terms.

    ``numeric[c] = (weight, mean)``; ``categorical[c] = ({category: weight}, baseline, unseen_weight)``
    where baseline is the training-mean term of that input.
    """
    intercept: float
    numeric: dict[str, tuple[float, float]] = field(default_factory=dict)
    categorical: dict[str, tuple[dict[str, float], float, float]] = field(default_factory=dict)

    @property
    def baseline(self) -> float:
        return (self.intercept + sum(w * m for w, m in self.numeric.values())
                + sum(b for _, b, _ in self.categorical.values()))


def linear_terms(model: PipelineModel, train: DataFrame) -> LinearTerms:
    """Read the fitted pipeline as per-input linear terms.

    Coefficients stand in the order of :func:`fit_features`. Numeric means
    are the imputer's training means; a categorical input's baseline is the
    average of its term over ``train``, computed in one distributed
    aggregate. The category lookups hold one weight per category seen in
    training, fewer than the 4,096 columns the fit admits.
    """
    lr = model.stages[-1]
    coef = lr.coefficients.toArray()
    imputer = next((x for x in model.stages if isinstance(x, ImputerModel)), None)
    index = next((x for x in model.stages if isinstance(x, StringIndexerModel)), None)
    means = imputer.surrogateDF.first().asDict() if imputer else {}
    num = {c: (float(w), float(means[c])) for c, w in zip(imputer.getInputCols() if imputer else [], coef)}
    at = len(num)
    cat_w: dict[str, dict[str, float]] = {}
    for c, labels in zip(index.getInputCols() if index else [], index.labelsArray if index else []):
        cat_w[c] = {label: float(coef[at + i]) for i, label in enumerate(labels[1:])}     # the first is the reference, 0
        at += max(len(labels) - 1, 0)
    terms = LinearTerms(float(lr.intercept), num, {c: (w, 0.0, 0.0) for c, w in cat_w.items()})
    if cat_w:
        bases = train.agg(*[F.avg(_category_term(terms, c)).alias(c) for c in cat_w]).first().asDict()
        terms.categorical = {c: (w, float(bases[c] or 0.0), 0.0) for c, w in cat_w.items()}
    return terms


def _category_term(terms: LinearTerms, c: str) -> Column:
    weights, _, unseen = terms.categorical[c]
    if weights:
        lut = F.create_map(*[v for k, wt in sorted(weights.items()) for v in (F.lit(k), F.lit(wt))])
        return F.coalesce(F.element_at(lut, F.col(c).cast(T.StringType())), F.lit(unseen))
    return F.lit(unseen)


def explain_predict(terms: LinearTerms, df: DataFrame, top_k_features: int = 3) -> DataFrame:
    """Prediction with the ``top_k_features`` largest attributions (M7, L4).

    attribution(input) = term(input) - mean term(input); for a linear model
    the attributions sum exactly to prediction - baseline. Ranking sorts
    (-|attribution|, feature) structs with ``sort_array``, so ties break by
    feature name and no comparator lambda runs per row.
    """
    named: list[tuple[str, Column]] = []
    for c, (w, m) in terms.numeric.items():
        x = F.coalesce(F.col(c).cast(T.DoubleType()), F.lit(m))
        named.append((c, F.lit(w) * (x - F.lit(m))))
    for c, (_, base, _) in terms.categorical.items():
        named.append((c, _category_term(terms, c) - F.lit(base)))
    total = F.lit(0.0)
    for _, a in named:
        total = total + a
    keyed = F.sort_array(F.array(*[F.struct((-F.abs(a)).alias("k"), F.lit(n).alias("feature"),
                                            a.alias("attribution")) for n, a in named]))
    top = F.transform(F.slice(keyed, 1, top_k_features),
                      lambda s: F.struct(s["feature"].alias("feature"), s["attribution"].alias("attribution")))
    baseline = terms.baseline
    return df.select(
        *df.columns,
        (F.lit(baseline) + total).alias(PREDICTION),
        top.alias("top_feature_attributions"),
        F.lit(baseline).alias("baseline_prediction_value"),
        (F.lit(baseline) + total).alias("prediction_value"),
        F.lit(0.0).alias("approximation_error"),
    )


# ---- tuning, persistence, scoring ------------------------------------------------------

def sample_trials(num_trials: int = 5, l1_range: tuple[float, float] = (0.0, 20.0),
                  l2_candidates: tuple[float, ...] = (0.0, 0.1, 1.0, 10.0), seed: int = 42) -> list[tuple[float, float]]:
    """Random search over (l1, l2): l1 uniform in its range, l2 from the candidates (M8)."""
    rng = random.Random(seed)
    return [(rng.uniform(*l1_range), rng.choice(l2_candidates)) for _ in range(num_trials)]


def to_spark_reg(l1: float, l2: float) -> tuple[float, float]:
    """(l1, l2) penalties -> (regParam, elasticNetParam)."""
    total = l1 + l2
    return (total, l1 / total) if total > 0 else (0.0, 0.0)


def optimality(model: LinearRegressionModel, rows: DataFrame, label: str = LABEL) -> dict[str, float]:
    """How far a penalised fit is from the solution of its objective: 0 is optimal (M8).

    The objective is convex, so a point is its solution exactly where every
    coefficient's gradient equals the subgradient of its penalty. With
    residuals r, standard deviations s of the columns and t of the label,
    the fit minimises mean(r^2) / 2 + l1 * sum(s |w|) + l2 / (2 t) * sum(s^2 w^2).
    So mean(x r) = l1 s sign(w) + l2 / t s^2 w where w is not 0,
    |mean(x r)| <= l1 s where it is, and mean(r) = 0 for the intercept.
    All of it is two summaries of the rows ``features`` and ``label``; what
    reaches the driver is a few numbers a feature column (4,096 at most).

    Returns ``violation``, the largest deviation over columns relative to
    (s t), ``intercept`` (mean residual over t) and ``nonzero``, the number of
    coefficients that are not 0.
    """
    reg, mix = model.getOrDefault(model.regParam), model.getOrDefault(model.elasticNetParam)
    l1, l2 = reg * mix, reg * (1 - mix)
    r = F.col(label).cast(T.DoubleType()) - F.col(PREDICTION)
    x = model.transform(rows).select("features", r.alias("r"), F.col(label).cast(T.DoubleType()).alias("y"))
    total = Summarizer.metrics("sum")       # weights have to be positive: one sum for each sign, 1 added to both
    one = x.agg(Summarizer.metrics("std").summary(F.col("features")).alias("all"),
                total.summary(F.col("features"), 1 + F.greatest("r", F.lit(0.0))).alias("over"),
                total.summary(F.col("features"), 1 + F.greatest(-F.col("r"), F.lit(0.0))).alias("under"),
                F.avg("r").alias("mean"), F.stddev_pop("y").alias("t"), F.count("*").alias("n")).first()
    n, t = one.n, one.t or 0.0
    if not n or not t:
        return {"violation": 0.0, "intercept": abs(one["mean"] or 0.0), "nonzero": 0}
    worst, nonzero = 0.0, 0
    for w, s, over, under in zip(model.coefficients.toArray(), one["all"].std.toArray(), one.over.sum.toArray(), one.under.sum.toArray()):
        s = float(s) * ((n - 1) / n) ** 0.5
        if s == 0.0:
            continue                                         # a constant column takes no part
        g = float(over - under) / n
        if w:
            nonzero += 1
            off = abs(g - (l1 * s if w > 0 else -l1 * s) - l2 / t * s * s * w)
        else:
            off = max(0.0, abs(g) - l1 * s)
        worst = max(worst, off / (s * t))
    return {"violation": float(worst), "intercept": abs(one["mean"]) / t, "nonzero": nonzero}


R2_TIE = 1e-9       # trials closer than that are equally good: the first of them is chosen


def tune_tip_model(df: DataFrame, num_trials: int = 5, max_parallel_trials: int = 2, seed: int = 42,
                   eval_fraction: float = 0.2, l1_range: tuple[float, float] = (0.0, 20.0)):
    """Hyper-parameter search on the repeatable split of M3 (M8).

    The feature stages are fitted once on the train rows; only the regression
    is fitted for each trial and judged by R² on the eval rows. Returns
    ``(best PipelineModel, trials DataFrame)``; trials has one row per trial
    with its l1/l2, Spark parameters, split sizes, R², the best flag and the
    certificate of its fit (:func:`optimality`).
    """
    train, held = (_numeric_inputs(x) for x in auto_split(df.where(F.col(LABEL).isNotNull()), eval_fraction))
    train = _to_scratch(train, "ml_train")
    stages = fit_features(train)
    features = PipelineModel(stages)
    train = _to_scratch(features.transform(train).select("features", LABEL), "ml_train_features")
    held = _to_scratch(features.transform(held).select("features", LABEL), "ml_eval_features")
    judge = RegressionEvaluator(labelCol=LABEL, predictionCol=PREDICTION, metricName="r2")
    trials = sample_trials(num_trials, l1_range, seed=seed)

    def run(trial: tuple[float, float]):
        model = regression(*to_spark_reg(*trial)).fit(train)
        return model, float(judge.evaluate(model.transform(held))), optimality(model, train)

    with ThreadPool(max_parallel_trials) as pool:
        fitted = pool.map(run, trials)
    top = max(r2 for _, r2, _ in fitted)
    best = next(i for i, (_, r2, _) in enumerate(fitted) if r2 >= top - R2_TIE)
    sizes = train.count(), held.count()
    rows = [(i + 1, float(l1), float(l2), *map(float, to_spark_reg(l1, l2)), *sizes, fitted[i][1], i == best,
             fitted[i][2]["violation"], fitted[i][2]["intercept"], fitted[i][2]["nonzero"])
            for i, (l1, l2) in enumerate(trials)]
    schema = ("trial_id int, l1_reg double, l2_reg double, reg_param double, elastic_net_param double, "
              "train_rows long, eval_rows long, r2_score double, is_optimal boolean, "
              "violation double, intercept_violation double, nonzero int")
    return PipelineModel([*stages, fitted[best][0]]), df.sparkSession.createDataFrame(rows, schema)


def save_model(model: PipelineModel, path: str) -> None:
    """Persist to shared storage (M9)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score_instances(model: PipelineModel, requests: DataFrame, col: str = "request") -> DataFrame:
    """Score JSON requests ``{"instances": [...]}`` in batch."""
    from ridemart.sources.files import read_instances
    return predict(model, read_instances(requests, col, FEATURE_SCHEMA))


def stream_scores(model: PipelineModel, requests_path: str, out: str, checkpoint: str, spark,
                  files_per_trigger: int = 100, available_now: bool = True):
    """Score JSON request files as they arrive (M10): a text file stream through the model into Parquet.

    Every line of a file is a request ``{"instances": [...]}``. The stages of
    the model are row by row, so the stream has no state but its checkpoint:
    a restart goes on after the last file, and the file sink's log keeps a
    replayed batch from adding its rows again (read ``out`` with Spark).
    Returns the ``StreamingQuery``.
    """
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(requests_path)
    w = (score_instances(model, lines, "value").writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", out))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
