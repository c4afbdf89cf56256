"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text's features are the character 4- and 5-grams of its letters (lower case, words apart
by one blank), hashed, present or absent. Each present feature has the value r, the log of
the ratio of its smoothed share among toxic and among clean training texts; so n-grams that
say nothing are near 0. Logistic regression on these values gives the weights. The label
decides nothing but the fit; a score is a function of the text alone.

The fit takes a bounded sample of labelled rows (``per_class`` of each label, all if there
are fewer). Spark counts in how many of them each bucket stands, by label; the counts (at
most 2**bits rows) decide which buckets say something, and only those of each text are
brought to the driver, however long the texts are. Every row of the table is scored, in
tasks, with the weights broadcast (one vector of 2**bits floats).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.common import bounded_sample, held_out, in_batches, table, written
from panelkit.llm.features import letters_only, ngrams

THRESHOLD = 0.3
#: Weight of all toxic training texts together.
PRIOR = 0.25
PER_CLASS = 2_000
BITS = 19
SIZES = (4, 5)
MIN_TEXTS = 4


def text_features(text: str | None, bits: int = BITS) -> np.ndarray:
    """Distinct feature buckets of a text, in ascending order."""
    codes = letters_only(text or "")
    return np.unique(np.concatenate([ngrams(codes, n, bits) for n in SIZES]))


@dataclass
class Model:
    """score = 1 / (1 + exp(-(bias + sum of weights of the present features)))."""
    weights: np.ndarray
    bias: float
    bits: int = BITS

    def score(self, text: str | None) -> float:
        found = text_features_of_interest(text, self.weights, self.bits)
        z = self.bias + float(self.weights[found].sum())
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))))


def text_features_of_interest(text: str | None, weights: np.ndarray, bits: int) -> np.ndarray:
    """Distinct buckets with a weight; the same sum as over all, with less to sort."""
    codes = letters_only(text or "")
    found = np.concatenate([ngrams(codes, n, bits) for n in SIZES])
    return np.unique(found[weights[found] != 0])


def log_ratios(in_toxic: np.ndarray, in_clean: np.ndarray, positive: int, n: int, smoothing: float = 1.0,
               deviations: float = 4.0) -> np.ndarray:
    """Log-count ratio of each bucket from the number of toxic and clean texts that hold it.

    A ratio counts only where the labels of the texts with that feature differ from all texts'
    by ``deviations`` (the root of the likelihood ratio statistic); long texts would else
    gather chance ratios of many rare n-grams. It is 0 elsewhere.
    """
    # Smoothed towards the classes' shares: a feature that was never seen has ratio 0.
    share = positive / n
    a, b = in_toxic + smoothing * share, in_clean + smoothing * (1 - share)
    ratio = np.log(a / positive) - np.log(b / (n - positive))
    texts = in_toxic + in_clean
    with np.errstate(divide="ignore", invalid="ignore"):
        g = 2 * (np.where(in_toxic > 0, in_toxic * np.log(in_toxic / (texts * share)), 0)
                 + np.where(in_clean > 0, in_clean * np.log(in_clean / (texts * (1 - share))), 0))
    ratio[(texts < MIN_TEXTS) | (g < deviations ** 2)] = 0
    return ratio


def fit(features: list[np.ndarray], labels: np.ndarray, bits: int = BITS, ratio: np.ndarray | None = None,
        ridge: float = 1e-4, steps: int = 400) -> Model:
    """Logistic regression on the log-count ratios by accelerated gradient descent.

    ``ratio`` are the ratios of all buckets; without them they come from ``features``. With
    one label only, or no rows, the model says that label's share for every text (0 without
    rows).
    """
    size, n = 1 << bits, len(labels)
    positive = int(labels.sum())
    if not n or positive in (0, n):
        return Model(np.zeros(size, np.float32), 30.0 if positive else -30.0, bits)
    if ratio is None:
        counts = np.zeros((2, size))
        for found, label in zip(features, labels.tolist()):
            counts[label][found] += 1
        ratio = log_ratios(counts[1], counts[0], positive, n)
    features = [found[ratio[found] != 0] for found in features]
    row = np.repeat(np.arange(n), [len(f) for f in features])
    kept, column = np.unique(np.concatenate(features), return_inverse=True)
    value = ratio[kept][column]
    weight = ahead = np.zeros(len(kept))
    bias = bias_ahead = 0.0
    # Toxic texts weigh PRIOR together, whatever their share of the sample, so that a text
    # without any sign stays below the threshold; the step is safe for the largest curvature.
    balance = np.where(labels == 1, PRIOR / positive, (1 - PRIOR) / (n - positive))
    norm = np.bincount(row, value * value, minlength=n)
    step = 1.0 / (ridge + 0.25 * float((balance * (norm + 1)).sum()))
    for t in range(steps):
        z = bias_ahead + np.bincount(row, value * ahead[column], minlength=n)
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) * balance
        gradient = np.bincount(column, value * error[row], minlength=len(kept)) + ridge * ahead
        new, new_bias = ahead - step * gradient, bias_ahead - step * float(error.sum())
        pull = t / (t + 3)
        ahead, bias_ahead = new + pull * (new - weight), new_bias + pull * (new_bias - bias)
        weight, bias = new, new_bias
    weights = np.zeros(size, np.float32)
    weights[kept] = weight * ratio[kept]
    return Model(weights, float(bias), bits)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          per_class: int = PER_CLASS, bits: int = BITS) -> Model:
    """Fit on labelled rows that are not held out.

    Rows without a label or id don't count; an id with both labels counts as toxic, and each
    of several rows of one id is a text of its own. Null and empty texts have no features.
    """
    marked = (labels.filter("toxic IN (0, 1)").groupBy(F.col(id_col).alias("_id"))
              .agg(F.max("toxic").alias("_y")).filter(~held_out("_id")))
    chosen = bounded_sample(marked, "_y", "_id", per_class)
    rows = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
            .join(F.broadcast(chosen), "_id").select("_text", "_y"))   # two classes of per_class rows
    rows = in_batches(written(rows))
    size = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, texts = np.zeros((2, size), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for text, y in zip(batch.column(0), batch.column(1).to_pylist()):
                held[y][text_features(text.as_py(), bits)] += 1
                texts[y] += 1
        some = np.flatnonzero(held.any(0))
        # The texts themselves stand in one more place.
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, size)), pa.array(np.append(held[0][some], texts[0])),
             pa.array(np.append(held[1][some], texts[1]))], ["bucket", "clean", "toxic"])

    got = (rows.mapInArrow(count, "bucket bigint, clean bigint, toxic bigint").groupBy("bucket")
           .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow())
    counts = np.zeros((2, size + 1))
    for y, name in enumerate(("clean", "toxic")):
        counts[y][got["bucket"].to_numpy()] = got[name].to_numpy()
    clean, toxic = counts[:, size].astype(int).tolist()
    if not clean or not toxic:
        return fit([], np.array([int(toxic > 0)] * (clean + toxic), np.int64), bits)
    ratio = log_ratios(counts[1][:size], counts[0][:size], toxic, clean + toxic)
    kept = docs.sparkSession.sparkContext.broadcast(np.packbits(ratio != 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(kept.value)[:size].astype(bool)
        for batch in batches:
            found = [text_features(t.as_py(), bits) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[wanted[f]].astype("<u4").tobytes() for f in found], pa.binary()),
                 batch.column(1).cast(pa.int32())], ["features", "y"])

    some = sorted((bytes(r.features), r.y) for r in rows.mapInArrow(run, "features binary, y int").collect())
    return fit([np.frombuffer(f, "<u4") for f, _ in some], np.array([y for _, y in some], np.int64), bits, ratio)


def score_texts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
                threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id, score, predicted. Null and empty texts get the score of a
    text without features; texts are read whole, however long. Ids pass through, null or
    repeated; other columns are ignored; an empty table gives an empty result. A score equal
    to the threshold counts as toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [shared.value.score(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()),
                 pa.array([int(s >= threshold) for s in scores], pa.int32())],
                [id_col, "score", "predicted"])

    return in_batches(docs.select(id_col, F.col(text_col).cast("string"))).mapInArrow(
        run, f"`{id_col}` {kind}, score double, predicted int")


def without_toxic(docs: DataFrame, labelled: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) without the rows that the classifier calls toxic. Each row is
    judged by its own text, null as empty; repeated rows and null ids stay or go alike."""
    model = train(labelled, labels, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = [shared.value.score(t.as_py()) < THRESHOLD for t in batch.column(place)]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return in_batches(docs).mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_texts(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
