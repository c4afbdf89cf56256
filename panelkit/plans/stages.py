"""The reference's four stages as job functions over DataFrames.

1. universe: IPO / delist tables (``fetch_ipos``, ``fetch_delists``) and the panel fetch
   (``fetch_panel``) -- one lazy plan each, no per-firm loop;
2. ``match_delistings``: IPO x delist within N years;
3. ``label_exchange`` per exchange part, then ``merge_parts`` (union, fill, clean);
4. ``train_and_evaluate``: firm-year features, leakage-safe split, fit, metrics.

Each function returns DataFrames; writing them out is ``sources.io.write_table``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions import cleaning as C
from panelkit.operators import features as FE
from panelkit.operators import labels as L
from panelkit.operators import ml as ML
from panelkit.operators import panel as P
from panelkit.operators import split as S
from panelkit.operators import universe as U
from panelkit.plans.resume import Resumable
from panelkit.sources.bucketed import stored
from panelkit.sources.io import Source, first_nonempty_pair, first_nonempty_source, require_columns


def fetch_ipos(names: DataFrame, start: str, end: str, exchange: str | None = "NYSE",
               company: DataFrame | None = None, link: DataFrame | None = None,
               limit: int | None = None) -> DataFrame:
    """IPO table: company IPO dates through the link (default) or earliest names row."""
    if company is not None and link is not None:
        df = U.ipo_from_company(company, link, names, exchange, start, end)
    else:
        df = U.ipo_from_names(names, exchange, start, end)
    df = df.orderBy("ipo_date", "permno")
    return df.limit(limit) if limit else df


def fetch_delists(delist_events: DataFrame, names: DataFrame, start: str, end: str,
                  exchange: str | None = "NYSE", limit: int | None = None) -> DataFrame:
    df = U.delist_latest(delist_events, names, exchange, start, end).orderBy("permno")
    return df.limit(limit) if limit else df


def _named(sources: Sequence[Source]) -> list[tuple[str, Source]]:
    return [(s if isinstance(s, str) else f"source {i}", s) for i, s in enumerate(sources, 1)]


def fetch_ipos_ranked(spark: SparkSession, names: Sequence[Source], *args, **kw) -> tuple[DataFrame, str]:
    """:func:`fetch_ipos` from the first names table that exists and gives rows; sources
    are paths, catalog tables or frames. Also says which it was."""
    return first_nonempty_source(spark, _named(names), lambda n: fetch_ipos(n, *args, **kw))


def fetch_delists_ranked(spark: SparkSession, events: Sequence[Source], names: Sequence[Source],
                         *args, **kw) -> tuple[DataFrame, tuple[str, str]]:
    """S3: :func:`fetch_delists` from the first pair of an events and a names table that
    gives rows, the names varying fastest."""
    return first_nonempty_pair(spark, _named(events), _named(names), lambda e, n: fetch_delists(e, n, *args, **kw))


def fetch_panel(ipo: DataFrame, sources: P.FactSources, **kw) -> DataFrame:
    """S1b, then the panel fetch."""
    require_columns(ipo, ["permno", "ipo_date"], "IPO table")
    return P.build_panel(ipo, sources, **kw)


def match_delistings(ipo: DataFrame, delist: DataFrame, years: int = 5) -> DataFrame:
    return U.delist_within_years(ipo, delist, years)


def label_exchange(panel: DataFrame, matched: DataFrame) -> DataFrame:
    return L.event_label(panel, matched)


def merge_parts(parts: Sequence[DataFrame], direction: str = "both") -> DataFrame:
    return L.merge_clean(parts, direction)


@dataclass
class TrainResult:
    model: ML.FittedModel
    data: DataFrame            # firm-year rows with ``split``
    metrics: DataFrame         # split, n, accuracy, precision, recall, f1, roc_auc
    class_distribution: DataFrame
    moved_firm: object | None

    def report(self, k: int = 15) -> dict:
        """What a run tells: class counts per split, the firm moved into training (or None),
        the features, the intercept and the ``k`` largest weights."""
        counts = {(r["split"], r[self.label]): r["n"] for r in self.class_distribution.collect()}
        return {"classes": counts, "moved_firm": self.moved_firm, "features": self.model.features,
                "intercept": self.model.intercept(), "weights": ML.top_k_weights(self.model, k),
                "parameters": self.model.config.to_dict()}

    label: str = "y_next_year"


def train_and_evaluate(panel: DataFrame, cfg: ML.ModelConfig | None = None,
                       features: str | Sequence[str] | None = None,
                       cutoff_month: int | None = None,
                       ratios: Sequence[float] = (0.7, 0.15, 0.15),
                       drop_zero_variance: bool = False,
                       save_path: str | None = None,
                       predict_next_year: bool = True, label: str | None = "delist",
                       group: str = "permno", time: str | None = "public_year",
                       model: ML.FittedModel | None = None,
                       resume: Resumable | None = None) -> TrainResult:
    """M9: yearly features -> firm-level split -> class rescue -> fit -> val/test metrics.

    Without ``predict_next_year`` the rows are taken as they are, with the given label, time
    and group columns (None: inferred). A given ``model`` is scored instead of fitting one.
    With ``resume`` the split table and the fitted model are kept in its folder, and a run goes
    on from those that an earlier run finished on the same inputs with the same parameters.
    """
    cfg = cfg or ML.ModelConfig()
    if predict_next_year:
        yearly = FE.yearly_features(panel, cutoff_month=cutoff_month)
        label, group, time = "y_next_year", "permno", "public_year"
        default = C.yearly_feature_names()
    else:
        yearly = panel
        label = label or C.infer_column(panel.columns, C.LABEL_CANDIDATES, "label")
        time = time or C.infer_column(panel.columns, C.TIME_CANDIDATES, "year")
        require_columns(yearly, [label, group, time], "training table")
        default = C.BASE_FEATURES
    feats = C.select_features(yearly.columns, features, default)
    ipo_col = "ipodate" if "ipodate" in yearly.columns else None
    X = yearly.select(group, time, label, *([ipo_col] if ipo_col else []), *[C.to_numeric_clean(f) for f in feats])
    # The split firm-year table is small next to the panel (one row per firm and year):
    # written once to the shared folder, it feeds the column checks, the class rescue, the
    # fit and the scoring without recomputing the panel aggregation.
    def split() -> DataFrame:
        return S.firm_level_split(X, group, ipo_col, time, ratios)

    data = stored(split(), panel.sparkSession) if resume is None else resume.table(
        "split", split, columns=X.columns, cutoff_month=cutoff_month, ratios=list(ratios), next_year=predict_next_year)
    dropped = C.all_null_columns(data, feats)
    if drop_zero_variance:
        dropped += C.constant_columns(data, [f for f in feats if f not in dropped])
    feats = [f for f in feats if f not in dropped]
    data, moved = S.ensure_two_classes(data, label, group)
    if model is None:
        def fit() -> ML.FittedModel:
            return ML.fit(S.split_filter(data, S.TRAIN), feats, label, cfg, checkpoint=False)

        model = fit() if resume is None else resume.model("model", fit, config=cfg.to_dict(), features=feats, label=label)
    held = data.filter(F.col("split").isin(S.VAL, S.TEST))
    pred = model.predict(held)
    metrics = ML.evaluate(pred, label, by=["split"]).join(
        ML.roc_auc(pred, label, "proba", by=["split"]), on="split", how="left")
    if save_path:
        model.save(save_path)
    return TrainResult(model, data, metrics, S.class_distribution(data, label), moved, label)
