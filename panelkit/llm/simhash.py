"""SimHash near-dedup with pigeonring filtering.

A 64-bit fingerprint is four segments of 16 bits on a ring. If two fingerprints differ in
at most 3 bits, then at some segment of the ring a chain starts whose cumulative
differences stay within the proportional budgets floor(l * 3 / 4) = 0, 1, 2, 3 for chains
of l = 1 to 4 segments. So linked fingerprints agree in one whole segment and differ in at
most one bit of the next: distinct fingerprints meet by that 32-bit key, or by a key with
one bit of its second half changed. The chain's third budget prunes what meets, and the
full Hamming distance decides.

Copies are folded first (only distinct fingerprints meet). A key that many fingerprints
share is cut into blocks and its pairs of blocks are compared in separate rows; each row
gives a spanning forest of the links it finds, not the links themselves, so a large group
of near copies costs edges in proportion to its members and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit.llm.common import in_batches, table, written
from panelkit.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
SEGMENTS = 4
WIDTH = 16
#: Members of a block of a key that many fingerprints share.
BLOCK = 1024
_MASK = (1 << WIDTH) - 1


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of a text as an unsigned integer; 0 for a text without words.

    A-Z become lower case; words are runs of anything but ASCII white space; shingles are
    ``shingle`` words joined by a blank (all words if there are fewer), repeats included. A
    bit is 1 if it is set in more than half of the shingles' XXH64.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    span = min(shingle, len(words)) - 1
    hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED)
                       for a, b in zip(starts[:len(words) - span].tolist(), ends[span:].tolist())], np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):       # a bounded piece at a time
        piece = hashes[at:at + 65_536].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(piece, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int((2 * counts > len(hashes)) @ (np.uint64(1) << np.arange(64, dtype=np.uint64)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(id, fp): the fingerprint of each row as a signed 64-bit integer."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["id", "fp"])

    return in_batches(docs.select(id_col, F.col(text_col).cast("string"))).mapInArrow(run, f"id {kind}, fp bigint")


def _segment(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, WIDTH * (i % SEGMENTS)).bitwiseAND(F.lit(_MASK))


def _linked(members: np.ndarray, start: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, root) edges of a spanning forest of the links among ``members``."""
    n = len(members)
    third = np.uint64(_MASK) << np.uint64(WIDTH * ((start + 2) % SEGMENTS))
    second = np.uint64(_MASK) << np.uint64(WIDTH * ((start + 1) % SEGMENTS))
    near = np.zeros((n, n), bool)
    for at in range(0, n, 256):
        diff = members[at:at + 256, None] ^ members[None, :]
        # Chain of three: at most floor(3 * max_bits / 4) bits in its cumulative difference.
        chain = np.bitwise_count(diff & (second | third)) <= 3 * max_bits // SEGMENTS
        x, y = np.nonzero(chain)
        full = np.bitwise_count(diff[x, y]) <= max_bits
        near[at + x[full], y[full]] = True
    label = np.arange(n)
    while True:
        new = np.array([label[row].min() for row in near]) if n < 64 else \
            np.where(near, label[None, :], n).min(1)
        new = new[new]
        if (new == label).all():
            break
        label = new
    away = label != np.arange(n)
    return members[away], members[label[away]]


def links(distinct: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) that connect the distinct fingerprints ``fp`` exactly as links do."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"max_bits must lie between 0 and {MAX_BITS}")
    fp = F.col("fp")
    chains = F.array(*[F.struct(F.lit(i).alias("start"), (F.shiftleft(_segment(fp, i), WIDTH)
                                .bitwiseOR(_segment(fp, i + 1))).alias("key")) for i in range(SEGMENTS)])
    keyed = distinct.select("fp", F.explode(chains).alias("c")).select("c.start", "c.key", "fp")
    counted = keyed.withColumn("n", F.count(F.lit(1)).over(W.partitionBy("start", "key")))
    blocks = F.ceil(F.col("n") / F.lit(block))
    groups = written(counted.withColumn("block", F.pmod(F.hash("fp"), blocks.cast("int")))
                     .groupBy("start", "key", "block")
                     .agg(F.collect_list("fp").alias("members"), F.max("n").alias("n")))
    # The same key: all pairs of its blocks, a block with itself included.
    other = groups.select("start", "key", F.col("block").alias("_block"), F.col("members").alias("others"))
    same = (groups.filter("n > 1").join(other, ["start", "key"]).filter("block <= _block")
            .select("start", "members",
                    F.when(F.col("block") < F.col("_block"), F.col("others"))
                    .otherwise(F.array().cast("array<bigint>")).alias("others")))
    # A key with one bit less in its second half: each such pair of keys meets once.
    bits = F.filter(F.sequence(F.lit(0), F.lit(WIDTH - 1)),
                    lambda j: F.expr("key").bitwiseAND(F.call_function("shiftleft", F.lit(1), j)) != 0)
    probes = (groups.select("start", "key", "members", F.explode(bits).alias("_bit"))
              .select("start", F.col("key").bitwiseXOR(F.call_function("shiftleft", F.lit(1), F.col("_bit"))
                                                       .cast("long")).alias("key"), "members"))
    near = probes.join(other.drop("_block"), ["start", "key"]).select("start", "members", "others")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
            for start, left, right in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                members = np.concatenate([np.asarray(x.values, np.int64) for x in (left, right)])
                x, y = _linked(members.view(np.uint64), start, max_bits)
                a.append(x)
                b.append(y)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], ["a", "b"])

    return same.unionByName(near).mapInArrow(run, "a bigint, b bigint")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id.

    component_id is the smallest id that links reach, the row's own included; null ids are
    passed over (null if a component has no other). Null, empty and blank texts have
    fingerprint 0 and are linked like any other; repeated rows share all they get. Other
    columns are ignored, an empty table gives an empty result.
    """
    marked = written(fingerprints(docs, id_col, text_col, shingle))
    nodes = marked.groupBy("fp").agg(F.min("id").alias("least_id"))
    roots = components(links(nodes.select("fp"), max_bits))
    rooted = (nodes.join(roots, nodes.fp == roots.node, "left")
              .select("fp", F.coalesce("root", "fp").alias("root"), "least_id"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    found = rooted.join(least, "root").select(F.col("fp").alias("_fp"), "component_id")
    return marked.join(found, marked.fp == F.col("_fp")).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) with the row of smallest id of each group; rows that share an
    id share their fate, and rows without an id stay."""
    dropped = (near_groups(docs, id_col, text_col).filter(F.col(id_col) != F.col("component_id"))
               .select(F.col(id_col).alias("_dropped")).distinct())
    return docs.join(dropped, docs[id_col] == dropped["_dropped"], "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))
