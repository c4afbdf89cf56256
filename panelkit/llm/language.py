"""Language identification by error-correcting output codes.

Every language has a codeword of bits. For each bit one binary classifier on character
n-grams (1 to 3, hashed) tells the languages with a 1 from those with a 0: its margin is the
mean over the text's n-grams of a log-ratio weight, scaled by a logistic fit. A text gets
the language whose codeword has the smallest loss, summed over the bits, each weighted by
how well its classifier separates the training texts. Where the runner-up is close the text
is flagged as ambiguous.

The fit takes a bounded sample of the labelled rows (``per_language`` of each language at
most, all if there are fewer), of any number of languages. Their n-gram counts are summed by
Spark and reach the driver a few languages at a time, the margins of the sample a few bits at a
time; the model, one weight per bit and bucket, is broadcast and every text is scored whole,
in tasks. The number of bits grows with the logarithm of the number of languages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.common import held_out, in_batches, table, written
from panelkit.llm.features import has_letter, letters_only, ngrams

UNKNOWN = "und"
PER_LANGUAGE = 2_000
#: Languages whose counts a task or the driver holds at once, and margins the driver holds at once.
AT_ONCE = 64
MARGINS = 1 << 23
BITS = 15
SIZES = (1, 2, 3)
#: Ambiguous: the runner-up's loss exceeds the best by less than this share of all weight.
CLOSE = 0.1


def codewords(n: int) -> np.ndarray:
    """One row of bits per language; every column has both values and no two are the same or
    opposite. All such columns for up to 5 languages, else 10 * log2(n) drawn ones."""
    if n < 2:
        return np.zeros((n, 0), np.int8)
    if n <= 5:
        columns = [[1] + [(c >> k) & 1 for k in range(n - 1)] for c in range(2 ** (n - 1) - 1)]
        return np.array(columns, np.int8).T
    rng = np.random.default_rng(n)
    wanted = 10 * int(np.ceil(np.log2(n)))
    best, best_distance = None, -1
    for _ in range(50):
        draw = rng.integers(0, 2, (n, wanted), np.int8)
        draw = draw[:, (draw.min(0) == 0) & (draw.max(0) == 1)]
        distance = _least_distance(draw)
        if distance > best_distance:
            best, best_distance = draw, distance
    return best


def _least_distance(code: np.ndarray, rows: int = 1_000) -> int:
    """The least number of bits in which two rows differ, by blocks of rows."""
    signed = (2 * code - 1).astype(np.float32)
    most = -np.inf
    for lo in range(0, len(code), rows):
        alike = signed[lo:lo + rows] @ signed.T
        alike[np.arange(len(alike)), lo + np.arange(len(alike))] = -np.inf
        most = max(most, alike.max())
    return int(code.shape[1] - most) // 2


def text_counts(text: str, bits: int = BITS) -> np.ndarray:
    codes = letters_only(text)
    return np.bincount(np.concatenate([ngrams(codes, n, bits) for n in SIZES]), minlength=1 << bits)


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray          # languages x bits, 0 or 1
    weights: np.ndarray       # buckets x bits
    slope: np.ndarray         # per bit: margin = slope * mean weight + offset
    offset: np.ndarray
    trust: np.ndarray         # per bit: weight of its loss

    def means(self, text: str) -> np.ndarray:
        counts = text_counts(text, int(np.log2(len(self.weights))))
        there = np.flatnonzero(counts)
        return counts[there] @ self.weights[there] / max(1, counts.sum())

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, ambiguous)."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, False
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        margin = self.slope * self.means(text) + self.offset
        signed = (2 * self.code - 1) * margin
        loss = (np.logaddexp(0, -signed) * self.trust).sum(1)
        order = np.argsort(loss, kind="stable")
        likely = np.exp(loss[order[0]] - loss)
        close = loss[order[1]] - loss[order[0]] < CLOSE * self.trust.sum()
        return self.languages[order[0]], float(likely[order[0]] / likely.sum()), bool(close)


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of a one-feature logistic regression, by damped Newton steps."""
    slope, offset = 1.0, 0.0
    scale = max(float(np.abs(x).max()), 1e-9)
    u = np.stack([x / scale, np.ones(len(x))])
    w = np.array([slope, offset])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(w @ u, -30, 30)))
        gradient = u @ (p - y) + 1e-2 * w
        hessian = (u * (p * (1 - p))) @ u.T + (1e-2 + 1e-6) * np.eye(2)
        w = w - np.clip(np.linalg.solve(hessian, gradient), -5, 5)
    return float(w[0] / scale), float(w[1])


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          per_language: int = PER_LANGUAGE, bits: int = BITS) -> Model:
    """Fit on rows with a language that are not held out.

    Null and empty texts add no n-grams, rows without a language or held out take no part, a
    null id is not held out, repeated rows count again, other columns are ignored. With no
    language nothing is learned; with one, it is the answer to every text with a letter.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"),
                       F.col(text_col).cast("string").alias("text")).filter("lang IS NOT NULL").filter(~held_out("id"))
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if len(languages) < 2:
        return Model(languages, codewords(len(languages)), np.zeros((1 << bits, 0)), *[np.zeros(0)] * 3)
    share = F.create_map([F.lit(x) for lang in languages for x in (lang, min(1.0, per_language / sizes[lang]))])
    unit = F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    sample = written(rows.filter(unit < share[F.col("lang")]).select("lang", "text"))

    def rows_of(total: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, counts in total.items():
            there = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(there), pa.string()), pa.array(there),
                                              pa.array(counts[there])], ["lang", "bucket", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if lang not in total:
                    if len(total) == AT_ONCE:
                        yield from rows_of(total)
                        total = {}
                    total[lang] = np.zeros(1 << bits, np.int64)
                total[lang] += text_counts(text.as_py() or "", bits)
        yield from rows_of(total)

    counted = (in_batches(sample).mapInArrow(count, "lang string, bucket bigint, n bigint")
               .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    if len(languages) > AT_ONCE:
        counted = written(counted)
    place = {lang: i for i, lang in enumerate(languages)}
    code = codewords(len(languages))
    width = code.shape[1]
    sums = np.zeros((2, width, 1 << bits))
    for lo in range(0, len(languages), AT_ONCE):
        some = languages[lo:lo + AT_ONCE]
        got = counted.filter(F.col("lang").isin(some)).toArrow()
        counts = np.zeros((len(some), 1 << bits))
        np.add.at(counts, ([place[x] - lo for x in got["lang"].to_pylist()], got["bucket"].to_numpy()),
                  got["n"].to_numpy())
        share = (counts + 0.5) / (counts + 0.5).sum(1, keepdims=True)
        for b, bit in enumerate(code[lo:lo + AT_ONCE].T):
            for value in (0, 1):
                sums[value, b] += share[bit == value].sum(0)
    ones = code.sum(0)
    weights = (np.log(sums[1].T / ones) - np.log(sums[0].T / (len(code) - ones)))
    model = Model(languages, code, weights, np.ones(width), np.zeros(width), np.ones(width))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            means = [shared.value.means(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(means, pa.list_(pa.float64()))],
                                             ["lang", "means"])

    told = in_batches(sample).mapInArrow(margins, "lang string, means array<double>")
    step = max(1, min(width, MARGINS // (per_language * len(languages))))
    if step < width:
        told = written(told)
    for lo in range(0, width, step):
        got = told.select("lang", F.slice("means", lo + 1, step).alias("means")).toArrow()
        means = np.stack(got["means"].to_numpy()) if got.num_rows else np.zeros((0, step))
        truth = code[[place[x] for x in got["lang"].to_pylist()]]
        for b in range(lo, min(lo + step, width)):
            x, y = means[:, b - lo], truth[:, b]
            model.slope[b], model.offset[b] = _logistic(x, y)
            wrong = ((model.slope[b] * x + model.offset[b] > 0) != (y == 1)).mean()
            model.trust[b] = np.log((1 - min(wrong, 0.49) + 1e-3) / (wrong + 1e-3))
    return model


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, lang_pred, score, ambiguous.

    Null texts and texts without a letter are ``und`` with score 0, as is everything if
    nothing could be learned; ids pass through, null or repeated; other columns are ignored.
    Texts are scored whole, however long. Of languages with one loss the first by name is
    told, and the text is ambiguous. An empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_())],
                [id_col, "lang_pred", "score", "ambiguous"])

    return in_batches(docs.select(id_col, F.col(text_col).cast("string"))).mapInArrow(
        run, f"`{id_col}` {kind}, lang_pred string, score double, ambiguous boolean")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs)).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score",
                                              "ambiguous")
