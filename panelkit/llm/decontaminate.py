"""Benchmark decontamination: size-partitioned MinHash containment search.

Items and documents are sets of word shingles (5 words; all words if there are fewer). A
short item in a long document has a tiny Jaccard similarity, so items are partitioned by
size (classes that double), and for each class that occurs documents are searched by
overlapping windows in step with that class, of at most three times the shingles of an item
(n). ``BANDS`` bands of one minimum each, every one under a permutation of its own, find the
candidates. The shingle that is an item's minimum lies in the document with probability
0.8 at least, and is then the minimum of a window of up to 3 n shingles around it with
probability n / 4 n at least, however many pieces the item is in and wherever they stand.
So a band finds a contained item with probability 0.2, and all miss it with probability
0.8 ** 52 = 1e-5 at most.

Documents are hashed many at a time, in arrays. A band's minimum is a shingle of the item,
so stretches of a document without a shingle of any item (a Bloom filter of the items'
shingles, broadcast; a false positive only costs time) give no keys and need no windows;
nor do windows none of whose minima are an item's (a second filter). Both filters grow with
the items, up to a bound of 32 MB each; beyond it they let more through, and lose nothing.
Keys meet the items' by (class, band, minimum). The shingles of the whole document that may
be an item's meet those of its candidate items by (document, shingle), as bytes; their
number decides the containment.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.common import in_batches, table, written
from panelkit.llm.substring_dedup import edge_hashes

SHINGLE = 5
CONTAINMENT = 0.8
BANDS = 52
#: log2 of the bits of each filter over the items: 8 MB, and up to 32 MB for many items.
FILTER_BITS, MOST_FILTER_BITS = 26, 28
PROBES = 4
#: Bytes of text that are hashed at once, and words of a text that is longer than that.
HASH_BYTES, HASH_WORDS = 1 << 20, 1 << 17
#: Shingles of a document that are worked on at once.
PIECE = 1 << 14

_RNG = np.random.default_rng(20_240_601)
_ODD = _RNG.integers(0, 1 << 63, BANDS, np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, BANDS, np.uint64)[:, None]
_BAND = _RNG.integers(0, 1 << 63, BANDS, np.uint64)[:, None]


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words between ASCII white space."""
    return (text or "").lower().encode("utf-8", "surrogatepass").split()


def shingle_hashes(words: list[bytes], n: int = SHINGLE) -> np.ndarray:
    """A hash of every shingle in order (one of all words if there are fewer than ``n``)."""
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < n:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words))], np.uint64)
    return np.concatenate([edge_hashes([b" ".join(words[at:at + HASH_WORDS + n - 1])], n)[0].view(np.uint64)
                           for at in range(0, len(words) - n + 1, HASH_WORDS)])


def hashed_texts(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """(text index, hashes) of the lower-case texts that have words, many texts at a time."""
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size + len(texts[stop]) <= HASH_BYTES):
            size += len(texts[stop])
            stop += 1
        if size > HASH_BYTES:
            yield at, shingle_hashes(texts[at].split())
        else:
            hashes, owner, _ = edge_hashes(texts[at:stop], SHINGLE)
            edge = np.searchsorted(owner, np.arange(stop - at + 1))
            for k in range(stop - at):
                own = hashes[edge[k]:edge[k + 1]].view(np.uint64)
                own = own if len(own) else shingle_hashes(texts[at + k].split())
                if len(own):
                    yield at + k, own
        at = stop


def shingles(words: list[bytes], n: int = SHINGLE) -> list[bytes]:
    span = min(n, len(words))
    return [b" ".join(words[i:i + span]) for i in range(len(words) - span + 1)] if words else []


def size_class(count: int) -> int:
    """Class c holds items of more than 2**(c-1) and up to 2**c shingles."""
    return max(0, count - 1).bit_length()


def _permuted(hashes: np.ndarray) -> np.ndarray:
    h = (hashes[None, :] ^ _ADD) * _ODD
    return h ^ (h >> np.uint64(31))


def _keys(minima: np.ndarray, cls: int) -> np.ndarray:
    """One 64-bit key for (class, band, minimum)."""
    h = (minima ^ _BAND ^ np.uint64(cls * 0x9E3779B97F4A7C15 % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def item_keys(hashes: np.ndarray) -> np.ndarray:
    return _keys(_permuted(hashes).min(1, keepdims=True), size_class(len(np.unique(hashes))))[:, 0]


def _places(keys: np.ndarray, probe: int, log: int) -> np.ndarray:
    """Bit of a filter of 2 ** ``log`` bits that ``probe`` looks at."""
    step = (keys >> np.uint64(32)) | np.uint64(1)
    return (keys + np.uint64(probe) * step * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - log)


def _in_filter(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    hit = np.arange(keys.size)
    flat = keys.ravel()
    log = len(bits).bit_length() + 5
    for probe in range(PROBES):
        at = _places(flat[hit], probe, log)
        hit = hit[(bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1]
        if not len(hit):
            break
    found = np.zeros(keys.size, bool)
    found[hit] = True
    return found.reshape(keys.shape)


def windows(hashes: np.ndarray, classes: list[int], bits: np.ndarray,
            hits: np.ndarray | None = None) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first shingle, shingles, keys) of each window with a minimum that is in the filter;
    with ``hits`` (places of shingles, ascending) only from stretches that hold one."""
    strides = [max(1, (1 << c) // 2) for c in classes]
    if not len(hashes) or not classes:
        return
    last = max(strides)
    piece = max(1, PIECE // last) * last
    for begin in range(0, max(1, len(hashes) - 2 * last), piece):
        part = hashes[begin:begin + piece + 2 * last]
        if hits is not None and np.searchsorted(hits, begin) == np.searchsorted(hits, begin + len(part)):
            continue
        permuted = _permuted(part)
        for cls, stride in zip(classes, strides):
            # Classes double: coarser blocks are minima of the finer ones.
            block = np.minimum.reduceat(permuted, np.arange(0, len(part), stride), axis=1)
            n = max(1, block.shape[1] - 2)
            least = block[:, :n].copy()
            for k in (1, 2):
                if block.shape[1] > k:
                    np.minimum(least[:, :block.shape[1] - k], block[:, k:k + n], out=least[:, :block.shape[1] - k])
            keys = _keys(least, cls)
            found = _in_filter(keys, bits)
            for w in np.flatnonzero(found.any(0)):
                yield begin + int(w) * stride, 3 * stride, keys[found[:, w], w]


def distinct_items(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(content, item_id, n, cls, keys, hashes): each item with its words as one string, its
    number of distinct shingles, its class and keys, and the hashes of its shingles. Items
    without words are left out."""
    kind = dict(items.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if words := words_of(text.as_py()):
                    hashes = shingle_hashes(words)
                    n = len(set(shingles(words)))
                    rows.append({"item_id": i, "content": b" ".join(words), "n": n, "cls": size_class(n),
                                 "keys": item_keys(hashes).view(np.int64),
                                 "hashes": np.unique(hashes).view(np.int64)})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
                [("item_id", batch.schema.field(0).type), ("content", pa.binary()), ("n", pa.int64()),
                 ("cls", pa.int32()), ("keys", pa.list_(pa.int64())), ("hashes", pa.list_(pa.int64()))]))

    return items.select(id_col, F.col(text_col).cast("string")).mapInArrow(
        run, f"item_id {kind}, content binary, n bigint, cls int, keys array<bigint>, hashes array<bigint>")


def _filter_words(keys: DataFrame) -> np.ndarray:
    """The Bloom filter of a column of keys as 64-bit words, joined by Spark; its size follows
    from the number of keys, and at most 2**22 rows come back."""
    log = int(np.clip((10 * keys.count()).bit_length(), FILTER_BITS, MOST_FILTER_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            at = np.concatenate([_places(k, probe, log) for probe in range(PROBES)])
            yield pa.RecordBatch.from_arrays(
                [pa.array((at >> np.uint64(6)).astype(np.int64)),
                 pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], ["word", "bit"])

    got = keys.mapInArrow(run, "word bigint, bit bigint").groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(1 << (log - 6), np.uint64)
    bits[got["word"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    return bits


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text",
                 containment: float = CONTAINMENT) -> DataFrame:
    """(id, item_id, shared, item_shingles, containment) for each document and item whose
    containment reaches the threshold.

    Null and empty texts match nothing, on either side. Items of equal words are searched
    once and reported each; repeated rows of one document id count as one document. An item
    of fewer words than a shingle matches only documents of exactly its words. Documents
    are read whole; other columns are ignored; empty tables give an empty result.
    """
    spark = docs.sparkSession
    found = written(distinct_items(items, item_id_col, item_text_col))
    names = found.select(F.sha2("content", 256).alias("item"), F.col("item_id").alias("_item"))
    unique = found.groupBy("content").agg(F.first("n").alias("n"), F.first("cls").alias("cls"),
                                          F.first("keys").alias("keys"))
    item_rows = unique.select("content", F.explode("keys").alias("key"))
    # One row for each doubling of the size of an item.
    classes = sorted(r.cls for r in found.select("cls").distinct().collect())
    bits = spark.sparkContext.broadcast(_filter_words(item_rows.select("key")))
    parts = spark.sparkContext.broadcast(_filter_words(found.select(F.explode("hashes").alias("key"))))
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            ids = batch.column(0).to_pylist()
            texts = [(t or "").lower().encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()]
            for k, hashes in hashed_texts(texts):
                at = np.flatnonzero(_in_filter(hashes, parts.value))
                if not len(at):
                    continue
                keys = [k for _, _, k in windows(hashes, classes, bits.value, at)]
                if keys:
                    rows.append({"id": ids[k], "keys": np.unique(np.concatenate(keys)).view(np.int64), "shingles": []})
                # Of every row: rows of one id are one document, and may hold a piece each.
                words, at = texts[k].split(), at.tolist()
                span = min(SHINGLE, len(words))
                for p in range(0, len(at), PIECE):
                    rows.append({"id": ids[k], "keys": [],
                                 "shingles": list({b" ".join(words[j:j + span]) for j in at[p:p + PIECE]})})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
                [("id", batch.schema.field(0).type), ("keys", pa.list_(pa.int64())),
                 ("shingles", pa.list_(pa.binary()))]))

    searched = written(in_batches(docs.select(id_col, F.col(text_col).cast("string"))).mapInArrow(
        run, f"id {kind}, keys array<bigint>, shingles array<binary>"))
    pairs = (searched.select("id", F.explode("keys").alias("key")).join(item_rows, "key")
             .select("id", "content").distinct())

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind_of = batch.schema.field(0).type
            ids, keys, sizes, own = [], [], [], []

            def rows() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays(
                    [pa.array(ids, kind_of), pa.array(keys, pa.string()), pa.array(sizes, pa.int64()),
                     pa.array(own, pa.binary())], ["id", "item", "n", "shingle"])

            for i, content in zip(*(c.to_pylist() for c in batch.columns)):
                item = hashlib.sha256(content).hexdigest()
                some = dict.fromkeys(shingles(content.split()))
                ids += [i] * len(some)
                keys += [item] * len(some)
                sizes += [len(some)] * len(some)
                own += some
                if len(own) >= PIECE:
                    yield rows()
                    ids, keys, sizes, own = [], [], [], []
            yield rows()

    there = searched.select(F.col("id").alias("_id"), F.explode("shingles").alias("_shingle"))
    shared = (pairs.mapInArrow(wanted, f"id {kind}, item string, n bigint, shingle binary")
              .join(there, F.col("id").eqNullSafe(F.col("_id")) & (F.col("shingle") == F.col("_shingle")), "left_semi")
              .groupBy("id", "item", "n").agg(F.count(F.lit(1)).alias("shared")))
    return (shared.withColumn("containment", F.col("shared") / F.col("n"))
            .filter(F.col("containment") >= containment).join(names, "item")
            .select(F.col("id").alias(id_col), F.col("_item").alias("item_id"), "shared",
                    F.col("n").alias("item_shingles"), "containment"))


def without_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) without the documents that contain an item; rows that share an
    id share their fate."""
    dropped = contaminated(docs, items, id_col, text_col).select(F.col(id_col).alias("_dropped")).distinct()
    return docs.join(dropped, docs[id_col].eqNullSafe(dropped["_dropped"]), "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = """
WITH w AS (
  SELECT 0 AS item, doc_id AS id, list_filter(regexp_split_to_array(lower(text), '[ \\t-\\r]+'), lambda x: x <> '') AS w
  FROM documents
  UNION ALL
  SELECT 1, item_id, list_filter(regexp_split_to_array(lower(text), '[ \\t-\\r]+'), lambda x: x <> '')
  FROM benchmark),
s AS (
  SELECT DISTINCT item, id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS s
  FROM (SELECT item, id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT id, count(*) AS n FROM s WHERE item = 1 GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, count(*) AS shared, any_value(n.n) AS item_shingles,
       count(*)::DOUBLE / any_value(n.n) AS containment
FROM s d JOIN s b ON d.s = b.s AND d.item = 0 AND b.item = 1 JOIN n ON n.id = b.id
GROUP BY d.id, b.id HAVING count(*)::DOUBLE / any_value(n.n) >= 0.8
"""
