"""Queries: preprocessing statistics, metrics and the fitted model."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.functions import cleaning as C
from panelkit.operators import ml as ML
from panelkit.operators import split as S
from panelkit.plans.q_split import split_sql, split_yearly
from panelkit.plans.registry import fx, register
from panelkit.session import checkpoint_dir


def _features(cols):
    return [f for f in C.yearly_feature_names() if f in cols]


@fx.memo
def train_rows(spark, d):
    data, _ = S.ensure_two_classes(split_yearly(spark, d), "y_next_year")
    return S.split_filter(data, S.TRAIN)


def _feature_names_static():
    from panelkit.plans.q_features import FEATS, SLOPE, STD
    return _features([f"{c}_last" for c in FEATS] + [f"{c}_mean" for c in FEATS]
                     + [f"{c}_std" for c in STD] + [f"{c}_slope" for c in SLOPE]
                     + ["obs_count_in_year"])


_F = _feature_names_static()
_TRAIN = "(SELECT * FROM sp WHERE split = 'train')"


def _median_sql(f):
    return (f"SELECT '{f}' AS feature, quantile_cont(CAST({f} AS DOUBLE), 0.5) AS median "
            f"FROM {_TRAIN} t HAVING COUNT({f}) > 0")


def _std_sql(f):
    x = f"COALESCE(CAST(t.{f} AS DOUBLE), q.m)"
    return (f"SELECT '{f}' AS feature, AVG({x}) AS mean, CASE WHEN STDDEV_POP({x}) = 0 THEN 1.0 "
            f"ELSE STDDEV_POP({x}) END AS std FROM {_TRAIN} t, (SELECT quantile_cont(CAST({f} AS "
            f"DOUBLE), 0.5) AS m FROM {_TRAIN} u) q")


@register("impute_median", split_sql(" UNION ALL ".join(_median_sql(f) for f in _F)))
def q_impute_median(spark, d):
    tr = train_rows(spark, d)
    return ML.train_medians(tr, _features(tr.columns))


@register("standardize", split_sql(" UNION ALL ".join(_std_sql(f) for f in _F)))
def q_standardize(spark, d):
    tr = train_rows(spark, d)
    med = {r["feature"]: r["median"] for r in ML.train_medians(tr, _features(tr.columns)).collect()}
    return ML.scaler_stats(tr, med)


@register("balanced_weights", split_sql(
    "SELECT y_next_year, COUNT(*) AS n, SUM(COUNT(*)) OVER () / (2.0 * COUNT(*)) AS weight "
    f"FROM {_TRAIN} t GROUP BY y_next_year"))
def q_balanced_weights(spark, d):
    return ML.class_weights(train_rows(spark, d), "y_next_year")


_RULE = "CAST(CASE WHEN roa_mean < -0.4 THEN 1 ELSE 0 END AS INTEGER)"


@register("evaluate", split_sql(
    f"""SELECT split, n, accuracy, prec AS precision, rec AS recall,
    COALESCE(2 * prec * rec / NULLIF(prec + rec, 0), 0.0) AS f1 FROM (
      SELECT split, n, ok / n AS accuracy,
        COALESCE(tp / NULLIF(CAST(tp + fp AS DOUBLE), 0), 0.0) AS prec,
        COALESCE(tp / NULLIF(CAST(tp + fn AS DOUBLE), 0), 0.0) AS rec FROM (
        SELECT split, COUNT(*) AS n, SUM(CASE WHEN y_next_year = p THEN 1 ELSE 0 END) AS ok,
          SUM(CASE WHEN y_next_year = 1 AND p = 1 THEN 1 ELSE 0 END) AS tp,
          SUM(CASE WHEN y_next_year = 0 AND p = 1 THEN 1 ELSE 0 END) AS fp,
          SUM(CASE WHEN y_next_year = 1 AND p = 0 THEN 1 ELSE 0 END) AS fn
        FROM (SELECT split, y_next_year, {_RULE} AS p FROM sp WHERE split <> 'train') t
        GROUP BY split) c) m"""))
def q_evaluate(spark, d):
    """M6 on a fixed rule (roa mean below -0.4 predicts a delisting) per held-out split."""
    sp = split_yearly(spark, d).filter(F.col("split") != "train")
    pred = sp.withColumn("prediction", F.when(F.col("roa_mean") < -0.4, 1).otherwise(0))
    return ML.evaluate(pred, "y_next_year", by=["split"])


@register("roc_auc", split_sql(
    """SELECT split, CASE WHEN p > 0 AND n - p > 0 THEN (rs - p * (p + 1) / 2) / (p * (n - p)) END
    AS roc_auc FROM (SELECT split, SUM(pos * (cum - cnt + (cnt + 1) / 2)) AS rs, SUM(pos) AS p,
    SUM(cnt) AS n FROM (SELECT *, SUM(cnt) OVER (PARTITION BY split ORDER BY s ROWS BETWEEN
    UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM (SELECT split, s,
    CAST(SUM(CASE WHEN y_next_year = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS pos,
    CAST(COUNT(*) AS DOUBLE) AS cnt FROM (SELECT split, -roa_mean AS s, y_next_year FROM sp
    WHERE roa_mean IS NOT NULL) a GROUP BY split, s) b) c GROUP BY split) e"""))
def q_roc_auc(spark, d):
    """M7 (tie-aware, rank based) of the score -roa_mean per split."""
    sp = split_yearly(spark, d).select("split", "y_next_year", (-F.col("roa_mean")).alias("s"))
    return ML.roc_auc(sp, "y_next_year", "s", by=["split"])


@fx.memo
def fitted(spark, d):
    tr = train_rows(spark, d)
    return ML.fit(tr, _features(tr.columns), "y_next_year", ML.build_model_config(),
                  checkpoint=False)      # train rows come from the written split table


# --- the optimum -------------------------------------------------------------------------

_NAMES = " UNION ALL ".join(f"SELECT '{f}' AS feature FROM {_TRAIN} t HAVING COUNT({f}) > 0" for f in _F)


@register("logistic_fit", split_sql(
    f"SELECT feature, TRUE AS at_optimum FROM ({_NAMES} UNION ALL SELECT 'intercept') q"))
def q_logistic_fit(spark, d):
    """M4: the features of the class-balanced L2 logistic regression, and whether the slope of
    its objective vanishes at the fitted coefficients."""
    slopes = ML.gradient(fitted(spark, d), train_rows(spark, d), "y_next_year")
    return spark.createDataFrame([(f, abs(g) < 1e-4) for f, g in slopes.items()], "feature string, at_optimum boolean")


# --- a model with known coefficients, scored on both sides --------------------------------

_COEF = {"roa_last": -1.25, "roa_mean": 0.75, "tobinq_mean": 0.5, "quick_ratio_std": -0.3, "tobinq_slope": 0.2}
_MEDIAN = {"roa_last": 0.1, "roa_mean": 0.2, "tobinq_mean": 1.0, "quick_ratio_std": 0.25, "tobinq_slope": 0.0}
_STATS = {"roa_last": (0.05, 0.5), "roa_mean": (0.0, 0.75), "tobinq_mean": (1.1, 2.0),
          "quick_ratio_std": (0.3, 0.4), "tobinq_slope": (0.0, 1.5)}
_INTERCEPT = -0.4
_Z = " + ".join(f"({c!r}) * ((COALESCE({f}, {_MEDIAN[f]!r}) - {_STATS[f][0]!r}) / {_STATS[f][1]!r})"
                for f, c in _COEF.items())
_PROBA = f"1.0 / (1.0 + EXP(-(CAST({_INTERCEPT!r} AS DOUBLE) + {_Z})))"
_SCORED = f"(SELECT *, {_PROBA} AS proba FROM sp WHERE split <> 'train')"


def known_model(spark):
    return ML.FittedModel.from_coefficients(spark, _COEF, _INTERCEPT, _MEDIAN, _STATS)


def _all_held(spark, d):
    return split_yearly(spark, d).filter(F.col("split").isin(S.VAL, S.TEST))


@register("predict", split_sql(
    f"""SELECT permno, public_year, split, y_next_year, CAST(CASE WHEN proba > 0.5 THEN 1 ELSE 0 END AS DOUBLE)
    AS prediction, proba FROM {_SCORED} t"""))
def q_predict(spark, d):
    """M5: class and probability for every val / test firm-year."""
    return known_model(spark).predict(_all_held(spark, d)).select(
        "permno", "public_year", "split", "y_next_year", "prediction", "proba")


_TOP = sorted(_COEF.items(), key=lambda t: (-abs(t[1]), t[0]))[:3]


@register("top_k_weights", split_sql(
    "SELECT * FROM (VALUES " + ", ".join(f"('{f}', CAST({c!r} AS DOUBLE))" for f, c in _TOP)
    + f", ('intercept', CAST({_INTERCEPT!r} AS DOUBLE))) v(feature, coef) CROSS JOIN (SELECT COUNT(*) AS n_scored "
      f"FROM {_SCORED} t) c"))
def q_top_k_weights(spark, d):
    """O3: the largest |coefficients| plus the intercept, beside the rows they score."""
    m = known_model(spark)
    n = m.predict(_all_held(spark, d)).agg(F.count(F.lit(1)).alias("n_scored"))
    rows = spark.createDataFrame(ML.top_k_weights(m, 3) + [("intercept", m.intercept())], "feature string, coef double")
    return n.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(c).alias("coef"))
                                        for f, c in rows.collect()])).alias("r"), "n_scored").select("r.*", "n_scored")


@register("model_save_load", split_sql(
    f"""SELECT permno, public_year, split, CAST(CASE WHEN proba > 0.5 THEN 1 ELSE 0 END AS DOUBLE) AS prediction
    FROM {_SCORED} t"""))
def q_model_save_load(spark, d):
    """Save the pipeline to the shared folder, load it, score."""
    import uuid
    path = f"{checkpoint_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    known_model(spark).save(path)
    back = ML.FittedModel.load(spark, path)
    return back.predict(_all_held(spark, d)).select("permno", "public_year", "split", "prediction")


_CONFIG = {"C": 0.5, "max_iter": 200, "tol": 1e-7, "with_mean": True, "impute_strategy": "mean"}


@register("model_config", split_sql(
    "SELECT 'C' AS name, 0.5 AS value UNION ALL SELECT 'max_iter', 200.0 UNION ALL SELECT 'with_mean', 1.0 "
    f"UNION ALL SELECT 'reg_param', 1.0 / (0.5 * COUNT(*)) FROM {_TRAIN} t"))
def q_model_config(spark, d):
    """M8: parameters through a dict and back, and what they become for these rows."""
    cfg = ML.build_model_config("logistic_regression", ML.build_model_config(params=_CONFIG).to_dict())
    _, reg = ML.regularization(train_rows(spark, d), "y_next_year", cfg)
    rows = [("C", cfg.C), ("max_iter", float(cfg.max_iter)), ("with_mean", float(cfg.with_mean)), ("reg_param", reg)]
    return spark.createDataFrame(rows, "name string, value double")


@register("model_run", split_sql(
    f"""SELECT m.*, a.roc_auc FROM (SELECT split, n, accuracy, prec AS precision, rec AS recall,
      COALESCE(2 * prec * rec / NULLIF(prec + rec, 0), 0.0) AS f1 FROM (
        SELECT split, n, ok / n AS accuracy, COALESCE(tp / NULLIF(CAST(pp AS DOUBLE), 0), 0.0) AS prec,
          COALESCE(tp / NULLIF(CAST(ap AS DOUBLE), 0), 0.0) AS rec FROM (
          SELECT split, COUNT(*) AS n, SUM(CASE WHEN y_next_year = p THEN 1 ELSE 0 END) AS ok,
            SUM(CASE WHEN y_next_year = 1 AND p = 1 THEN 1 ELSE 0 END) AS tp, SUM(p) AS pp,
            SUM(y_next_year) AS ap FROM (SELECT *, CASE WHEN proba > 0.5 THEN 1 ELSE 0 END AS p
            FROM {_SCORED} s) t GROUP BY split) c) e) m
    LEFT JOIN (SELECT split, CASE WHEN p > 0 AND n - p > 0 THEN (rs - p * (p + 1) / 2) / (p * (n - p)) END AS roc_auc
      FROM (SELECT split, SUM(pos * (cum - cnt + (cnt + 1) / 2)) AS rs, SUM(pos) AS p, SUM(cnt) AS n FROM (
        SELECT *, SUM(cnt) OVER (PARTITION BY split ORDER BY proba ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        AS cum FROM (SELECT split, proba, CAST(SUM(y_next_year) AS DOUBLE) AS pos, CAST(COUNT(*) AS DOUBLE) AS cnt
        FROM {_SCORED} s GROUP BY split, proba) b) c GROUP BY split) r) a ON a.split = m.split"""))
def q_model_run(spark, d):
    """M9: the whole training stage on the labelled panel, scoring the known model."""
    from panelkit.plans.q_labels import labelled
    from panelkit.plans.stages import train_and_evaluate
    return train_and_evaluate(labelled(spark, d), model=known_model(spark)).metrics


@register("model_fit_run")
def q_model_fit_run(spark, d):
    """M9 with the fit (no SQL for an iterative optimizer; ``logistic_fit`` checks its
    optimum): val / test metrics of the class-balanced model."""
    from panelkit.plans.q_labels import labelled
    from panelkit.plans.stages import train_and_evaluate
    return train_and_evaluate(labelled(spark, d)).metrics
