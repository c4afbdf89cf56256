"""Small tables and brute-force versions that the tests of this folder share."""

import random
import re

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def docs_of(spark, rows):
    """A documents table from (doc_id, text) pairs, in two partitions."""
    return spark.createDataFrame([(i, t) for i, t in rows], "doc_id bigint, text string").repartition(2)


def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing column names."""
    long = " ".join(f"word{i % 997} mixed{i % 31}" for i in range(60_000))
    rows = [(1, "alpha beta gamma"), (2, None), (None, "alpha beta gamma"), (3, ""), (4, long), (5, long),
            (6, " \t\n "), (7, "alpha beta gamma"), (7, "alpha beta gamma"), (None, None), (8, "éß 日本 🎉 \x00 x")]
    df = docs_of(spark, rows)
    for name in ("lang", "source", "digest", "content", "keep_id", "text_sha256", "fp", "id", "_id", "part", "score",
                 "predicted", "slot", "shard", "_slot", "_dropped", "key", "n", "component_id", "item_id", "word"):
        df = df.withColumn(name, F.when(F.col("doc_id") > 3, F.lit("x")))
    return df


def empty_docs(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def random_texts(seed, n, vocabulary=60, length=60):
    """Texts with shared passages, copies and near copies."""
    rng = random.Random(seed)
    voc = [f"w{i}" for i in range(vocabulary)]
    passages = [[rng.choice(voc) for _ in range(rng.randint(13, 40))] for _ in range(5)]
    out = []
    for i in range(n):
        if out and rng.random() < 0.2:
            text = rng.choice(out).split()
            if rng.random() < 0.5 and text:
                text[rng.randrange(len(text))] = rng.choice(voc)
        else:
            text = [rng.choice(voc) for _ in range(rng.randint(0, length))]
            if rng.random() < 0.5:
                at = rng.randint(0, len(text))
                text[at:at] = rng.choice(passages)
        out.append(rng.choice([" ", "\n", "  "]).join(text))
    return out


def sets_of(rows, *columns):
    return sorted(tuple(r[c] for c in columns) for r in rows)
