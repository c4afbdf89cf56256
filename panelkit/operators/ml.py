"""Class-balanced logistic regression with pyspark.ml.

Preprocessing statistics come from the training split only: exact medians (M1) via the
skew-safe ranking, means and population standard deviations (M2) via one aggregate.
They are baked into a ``SQLTransformer`` stage, so imputation, scaling, assembling and
the classifier form one ``PipelineModel`` that saves and loads as a unit.

The sklearn objective  C * sum_i w_i * loss_i + 1/2 |b|^2  equals, divided by C * sum(w),
Spark's  (1/sum w) sum_i w_i loss_i + regParam/2 |b|^2  with regParam = 1 / (C * sum w).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelkit.operators.ordered import exact_medians, ordered_scan
from panelkit.session import cut_lineage

SUPPORTED_MODELS = ("logistic_regression",)


@dataclass
class ModelConfig:
    """M8: hyper-parameters of the baseline model (dict in / out).

    ``impute_strategy`` is median or mean; ``with_mean`` and ``with_std`` switch centring and
    scaling; ``class_weight`` is balanced, None or a weight per class. The solver is always
    L-BFGS and the fit draws no random numbers and shows no progress, so other solvers are
    rejected and ``random_state``, ``verbose`` and ``warm_start`` change nothing. Unknown
    names are rejected.
    """
    C: float = 1.0
    penalty: str = "l2"
    solver: str = "lbfgs"
    max_iter: int = 1000
    class_weight: str | dict | None = "balanced"
    random_state: int = 42
    verbose: int = 0
    warm_start: bool = True
    impute_strategy: str = "median"
    with_mean: bool = True
    with_std: bool = True
    tol: float = 1e-6

    def __post_init__(self):
        allowed = {"penalty": ("l2",), "solver": ("lbfgs",), "impute_strategy": ("median", "mean"),
                   "class_weight": ("balanced", None)}
        if isinstance(self.class_weight, dict):
            del allowed["class_weight"]
            self.class_weight = {int(k): float(v) for k, v in self.class_weight.items()}
        for name, values in allowed.items():
            if getattr(self, name) not in values:
                raise ValueError(f"{name}={getattr(self, name)!r}: choose from {values}")

    def to_dict(self) -> dict:
        return asdict(self)

    @classmethod
    def from_dict(cls, params: dict | None) -> "ModelConfig":
        params = dict(params or {})
        if unknown := sorted(set(params) - set(cls.__dataclass_fields__)):
            raise ValueError(f"unknown model parameters: {unknown}")
        return cls(**params)


def build_model_config(name: str = "logistic_regression", params: dict | None = None) -> ModelConfig:
    """Factory; only the logistic regression is available, as in the reference."""
    if name not in SUPPORTED_MODELS:
        raise ValueError(f"model {name!r}: choose from {SUPPORTED_MODELS}")
    return ModelConfig.from_dict(params)


def train_medians(train: DataFrame, features: Sequence[str],
                  approx: int | None = None) -> DataFrame:
    """M1: exact median of every feature on the training rows (feature, median).
    Features without any value are absent (they are dropped, as in the reference).
    ``approx`` (an accuracy) uses mergeable sketches instead, as a scale option."""
    if not approx:
        return exact_medians(train, features)
    row = train.agg(*[F.percentile_approx(F.col(f).cast("double"), 0.5, approx).alias(f"m{i}")
                      for i, f in enumerate(features)])
    stack = ", ".join(f"'{f}', m{i}" for i, f in enumerate(features))
    return row.selectExpr(f"stack({len(features)}, {stack}) AS (feature, median)").filter("median IS NOT NULL")


def train_means(train: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """Mean of every feature with a value (one aggregate, one row back)."""
    row = train.agg(*[F.avg(F.col(f).cast("double")).alias(f"m{i}") for i, f in enumerate(features)]).first()
    return {f: row[f"m{i}"] for i, f in enumerate(features) if row[f"m{i}"] is not None}


def _dict(df: DataFrame, key: str, value: str) -> dict:
    return {r[key]: r[value] for r in df.collect()}  # bounded: one row per feature


def scaler_stats(train: DataFrame, medians: dict[str, float]) -> DataFrame:
    """M2: mean and population std of each imputed feature; a zero std counts as 1."""
    feats = list(medians)
    aggs = []
    for i, f in enumerate(feats):
        x = F.coalesce(F.col(f).cast("double"), F.lit(float(medians[f])))
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
    row = train.agg(*aggs)
    stack = ", ".join(f"'{f}', m{i}, s{i}" for i, f in enumerate(feats))
    out = row.selectExpr(f"stack({len(feats)}, {stack}) AS (feature, mean, std)")
    return out.withColumn("std", F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std")))


def class_weights(train: DataFrame, label: str, balanced: bool = True) -> DataFrame:
    """M3: n / (2 * n_class) per class (1.0 when not balanced).

    The total comes from a window over the per-class counts: one row per class."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    w = total / (F.lit(2.0) * F.col("n")) if balanced else F.lit(1.0)
    return counts.select(label, "n", w.cast("double").alias("weight"))


def _lit(v: float) -> str:
    return f"CAST('{float(v)!r}' AS DOUBLE)"


def preprocess_sql(medians: dict, stats: dict) -> str:
    """Imputation + standardisation as one SQL statement (no Python in the data path)."""
    cols = []
    for f in medians:
        mean, std = stats[f]
        cols.append(f"(COALESCE(CAST(`{f}` AS DOUBLE), {_lit(medians[f])}) - {_lit(mean)}) / "
                    f"{_lit(std)} AS `{f}__z`")
    return f"SELECT *, {', '.join(cols)} FROM __THIS__"


@dataclass
class FittedModel:
    config: ModelConfig
    features: list[str]
    pipeline: PipelineModel
    medians: dict
    stats: dict

    @classmethod
    def from_coefficients(cls, spark: SparkSession, coefficients: dict[str, float], intercept: float,
                          medians: dict[str, float], stats: dict[str, tuple[float, float]],
                          config: ModelConfig | None = None) -> "FittedModel":
        """A model with known coefficients (of the scaled features), e.g. fitted elsewhere."""
        features = list(coefficients)
        scala = spark._jvm.org.apache.spark.ml
        values = spark.sparkContext._gateway.new_array(spark._jvm.double, len(features))
        for i, f in enumerate(features):
            values[i] = float(coefficients[f])
        lr = LogisticRegressionModel(scala.classification.LogisticRegressionModel(
            f"lr_{uuid.uuid4().hex}", scala.linalg.Vectors.dense(values), float(intercept)))
        lr.setFeaturesCol("features")
        med, st = {f: medians[f] for f in features}, {f: tuple(stats[f]) for f in features}
        return cls(config or ModelConfig(), features, PipelineModel(
            [SQLTransformer(statement=preprocess_sql(med, st)),
             VectorAssembler(inputCols=[f"{f}__z" for f in features], outputCol="features"), lr]), med, st)

    @property
    def lr(self):
        return self.pipeline.stages[-1]

    def predict(self, df: DataFrame) -> DataFrame:
        """M5: class at 0.5 and the positive-class probability."""
        out = self.pipeline.transform(df)
        return out.withColumn("proba", vector_to_array("probability")[1]).drop(
            "features", "rawPrediction", "probability", *[f"{f}__z" for f in self.features])

    def weights(self) -> list[tuple[str, float]]:
        return list(zip(self.features, [float(c) for c in self.lr.coefficients]))

    def intercept(self) -> float:
        return float(self.lr.intercept)

    def save(self, path: str) -> None:
        """Pipeline plus its config and statistics (written by Spark, so any shared FS)."""
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        meta = json.dumps({"config": self.config.to_dict(), "features": self.features,
                           "medians": self.medians, "stats": self.stats})
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").json(
            f"{path}/meta")

    @classmethod
    def load(cls, spark, path: str) -> "FittedModel":
        meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
        return cls(ModelConfig.from_dict(meta["config"]), meta["features"],
                   PipelineModel.load(f"{path}/pipeline"), meta["medians"],
                   {k: tuple(v) for k, v in meta["stats"].items()})


def regularization(train: DataFrame, label: str, cfg: ModelConfig) -> tuple[dict, float]:
    """Weight per class, and Spark's regParam for the objective (one row per class back)."""
    counts = class_weights(train, label, cfg.class_weight == "balanced").collect()
    given = cfg.class_weight if isinstance(cfg.class_weight, dict) else {}
    weights = {r[label]: float(given.get(r[label], r["weight"])) for r in counts}
    return weights, 1.0 / (cfg.C * sum(weights[r[label]] * r["n"] for r in counts))


def gradient(model: "FittedModel", train: DataFrame, label: str) -> dict[str, float]:
    """Slope of the regularized weighted loss, per unit of weight, at the fitted coefficients:
    per feature and for the intercept. All are near 0 at the optimum (one aggregate)."""
    weights, reg = regularization(train, label, model.config)
    scored = model.pipeline.transform(train).withColumn("_p", vector_to_array("probability")[1])
    w = F.lit(1.0)
    for k, v in weights.items():
        w = F.when(F.col(label) == F.lit(k), F.lit(v)).otherwise(w)
    residual = w * (F.col("_p") - F.col(label).cast("double"))
    row = scored.agg(F.sum(w).alias("w"), F.sum(residual).alias("b"),
                     *[F.sum(residual * F.col(f"{f}__z")).alias(f"g{i}") for i, f in enumerate(model.features)]).first()
    out = {f: row[f"g{i}"] / row["w"] + reg * c for i, (f, c) in enumerate(model.weights())}
    return out | {"intercept": row["b"] / row["w"]}


def fit(train: DataFrame, features: Sequence[str], label: str,
        cfg: ModelConfig | None = None, checkpoint: bool = True) -> FittedModel:
    """M1-M4 on the training rows. Unless the rows already come from a written table
    (``checkpoint=False``), they are written once to the shared folder first: the
    statistics below and every optimizer pass then read them instead of recomputing the
    upstream plan."""
    cfg = cfg or ModelConfig()
    data = train.select(*features, label)
    if checkpoint:
        data = cut_lineage(data)
    med = (_dict(train_medians(data, features), "feature", "median") if cfg.impute_strategy == "median"
           else train_means(data, features))
    feats = [f for f in features if f in med]           # all-NULL in train -> dropped
    med = {f: med[f] for f in feats}
    st = {r["feature"]: (r["mean"] if cfg.with_mean else 0.0, r["std"] if cfg.with_std else 1.0)
          for r in scaler_stats(data, med).collect()}
    wts, reg_param = regularization(data, label, cfg)
    w_expr = F.lit(1.0)
    for k, w in wts.items():
        w_expr = F.when(F.col(label) == F.lit(k), F.lit(float(w))).otherwise(w_expr)
    data = data.select(*feats, F.col(label).cast("double").alias("_label"), w_expr.alias("_weight"))
    stages = [SQLTransformer(statement=preprocess_sql(med, st)),
              VectorAssembler(inputCols=[f"{f}__z" for f in feats], outputCol="features"),
              LogisticRegression(featuresCol="features", labelCol="_label", weightCol="_weight",
                                 regParam=reg_param, elasticNetParam=0.0,
                                 standardization=False, maxIter=cfg.max_iter, tol=cfg.tol,
                                 fitIntercept=True, family="binomial")]
    model = Pipeline(stages=stages).fit(data)
    # The training summary holds the session, which cannot be sent to tasks once it has
    # observed a count; scoring needs only the coefficients.
    model.stages[-1]._java_obj.setSummary(data.sparkSession.sparkContext._jvm.scala.Option.empty())
    return FittedModel(cfg, feats, model, med, st)


def evaluate(pred: DataFrame, label: str, prediction: str = "prediction",
             by: Sequence[str] = ()) -> DataFrame:
    """M6: accuracy, precision, recall, f1 (0 when undefined) in one aggregate."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    g = pred.groupBy(*by) if by else pred.groupBy()
    agg = g.agg(F.count(F.lit(1)).alias("n"),
                F.sum(F.when(y == p, 1).otherwise(0)).alias("_ok"),
                F.sum(F.when((y == 1) & (p == 1), 1).otherwise(0)).alias("_tp"),
                F.sum(F.when((y == 0) & (p == 1), 1).otherwise(0)).alias("_fp"),
                F.sum(F.when((y == 1) & (p == 0), 1).otherwise(0)).alias("_fn"))
    prec = F.coalesce(F.try_divide(F.col("_tp"), (F.col("_tp") + F.col("_fp")).cast("double")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("_tp"), (F.col("_tp") + F.col("_fn")).cast("double")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0))
    return agg.select(*by, "n", (F.col("_ok") / F.col("n")).alias("accuracy"),
                      prec.alias("precision"), rec.alias("recall"), f1.alias("f1"))


def roc_auc(scored: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """M7: tie-aware ROC AUC by average ranks; NULL when a class is missing.

    Scores are first reduced to distinct values with their class counts (partial
    aggregation), then ranked with the skew-safe ordered scan.
    """
    by = list(by)
    d = scored.filter(F.col(score).isNotNull()).groupBy(*by, score).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("double").alias("_pos"),
        F.count(F.lit(1)).cast("double").alias("_cnt"))
    s = ordered_scan(d, by, [score], cumsum={"_cum": "_cnt"})
    avg_rank = F.col("_cum") - F.col("_cnt") + (F.col("_cnt") + 1) / 2
    agg = (s.groupBy(*by) if by else s.groupBy()).agg(
        F.sum(F.col("_pos") * avg_rank).alias("_rs"), F.sum("_pos").alias("_p"),
        F.sum("_cnt").alias("_n"))
    p, n = F.col("_p"), F.col("_n") - F.col("_p")
    auc = F.when((p > 0) & (n > 0), (F.col("_rs") - p * (p + 1) / 2) / (p * n))
    return agg.select(*by, auc.alias("roc_auc"))


def top_k_weights(model: FittedModel, k: int = 15) -> list[tuple[str, float]]:
    """O3: the k largest |coefficient|, ties by name."""
    return sorted(model.weights(), key=lambda t: (-abs(t[1]), t[0]))[:k]

