"""Substring dedup by compaction of a De Bruijn graph, verified at source coordinates.

Every ``k`` consecutive words of a document are an edge of a De Bruijn graph; its nodes are
the ``k`` - 1 words that consecutive edges share. The graph is that of the repeated edges, those
that also start in a document with a smaller id; the first place of an edge over all
documents is its source coordinate (document, word), and stands for the edge.

1. *Edges.* Each batch of documents hashes its edges (64 bits) and finds, in itself, the
   place with the smallest id of each edge. Repeats inside the batch get that source at
   once; only places in that first document leave the batch, however many documents of the
   batch share the edge. What is left meets by hash, where every place whose edge has a place
   of smaller id gets it as its source. Runs of places with consecutive sources travel as one
   row; a join of the runs with the runs at their sources leads them on to the first place.
2. *Nodes.* Each repeated edge gives its two nodes one row, at its source coordinate. An
   aggregate by node counts the edges that come in and go out. A node with more than one of
   either is a branch.
3. *Compaction.* Runs of consecutive source coordinates are cut at branches into segments. A
   node with one edge in and one out, in different documents, links two segments; the
   components of these links, by star contraction, are the nonbranching paths.
4. *Spans.* The runs of the documents are joined to the segments at their sources and cut as
   those are; neighbours on one nonbranching path join to one repeated span. Its words are
   removed.
5. *Verification.* Pieces and sources are joined to the texts on both coordinates; a piece counts
   only if the words at its source are its words.

Edges travel as packed columns (one row per batch and hash range), about 9 bytes an edge;
a set of documents is a few MB of text, and the number of sets grows with the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.common import in_batches, table, written
from panelkit.llm.components import components

WINDOW = 13
#: Bytes of text that a set of documents holds, and edges of a hash range, about.
SET_BYTES = 8 << 20
RANGE_EDGES = 1 << 20
#: Words of a block in which a path looks for the path at its source.
BLOCK_WORDS = 256
#: Bytes of text that are hashed at once.
BATCH_BYTES = 4 << 20

_RNG = np.random.default_rng(20_240_602)
_BYTE = _RNG.integers(0, 1 << 64, 256, np.uint64, endpoint=False)
_BASES = [int(b) * 2 + 1 for b in _RNG.integers(1 << 60, 1 << 63, 64)]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0, 1, ..., n - 1 modulo 2 ** 64."""
    out = np.ones(max(n, 1), np.uint64)
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """Hash of values[start:end] for each span; equal spans hash equally wherever they are."""
    n, base = len(values), _BASES[seed % len(_BASES)]
    total = np.zeros(n + 1, np.uint64)
    np.multiply(values, _powers(base, n), out=total[1:])
    np.cumsum(total[1:], out=total[1:])
    sums = total[ends] - total[starts]
    return _mixed(sums * _powers(pow(base, -1, 1 << 64), n)[starts])


def edge_hashes(texts: list[bytes], k: int = WINDOW, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text index, first word) of every edge, in order of text and word."""
    data = np.frombuffer(b" ".join(texts), np.uint8)
    gap = np.concatenate([[True], _SPACE[data], [True]])
    starts, ends = np.flatnonzero(gap[:-1] & ~gap[1:]), np.flatnonzero(~gap[:-1] & gap[1:])
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    owner = np.searchsorted(begins, starts, side="right") - 1
    words = _spans(_BYTE[data], starts, ends, seed)
    n = max(0, len(words) - k + 1)
    at = np.arange(n)
    at = at[owner[:n] == owner[k - 1:k - 1 + n]]
    first = np.searchsorted(owner, np.arange(len(texts)))
    return _spans(words, at, at + k, seed), owner[at], at - first[owner[at]]


# -- packed columns ---------------------------------------------------------------------

def _pack(values: np.ndarray, width: int = 8, delta: bool = False) -> bytes:
    """The low ``width`` bytes of 64-bit values, all first bytes, then all second, ...; as
    differences if ``delta``. High bytes that are mostly zero cost little when compressed."""
    v = values.astype(np.int64, copy=False).view(np.uint64)
    if delta:
        v = np.diff(v, prepend=np.uint64(0))
    return np.ascontiguousarray(v.view(np.uint8).reshape(-1, 8).T[:width]).tobytes()


def _unpack(data: bytes, width: int = 8, delta: bool = False) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    v = np.zeros((planes.shape[1], 8), np.uint8)
    v[:, :width] = planes.T
    v = v.view(np.uint64).ravel()
    return (np.cumsum(v, dtype=np.uint64) if delta else v).view(np.int64)


_PATH = ["doc", "start", "n", "src_doc", "src_start"]
_PATH_TYPE = ", ".join(f"{c} bigint" for c in _PATH)


def _pack_paths(paths: np.ndarray) -> bytes:
    """Paths (rows of _PATH), sorted by document and word."""
    return b"".join(_pack(paths[:, c], delta=True) for c in range(5))


def _unpack_paths(data: bytes) -> np.ndarray:
    size = len(data) // 5
    return np.stack([_unpack(data[c * size:(c + 1) * size], delta=True) for c in range(5)], axis=1)


def compact(paths: np.ndarray) -> np.ndarray:
    """Sort paths by place and join those that continue each other, copy and source alike."""
    paths = paths[np.lexsort((paths[:, 2], paths[:, 1], paths[:, 0]))]
    if len(paths) < 2:
        return paths
    # rows repeated with one id and text give the same places again
    again = (paths[1:, :3] == paths[:-1, :3]).all(1)
    paths = paths[np.concatenate([[True], ~again])]
    a, b = paths[:-1], paths[1:]
    goes_on = ((a[:, 0] == b[:, 0]) & (a[:, 3] == b[:, 3]) & (a[:, 1] + a[:, 2] == b[:, 1])
               & (a[:, 4] + a[:, 2] == b[:, 4]))
    head = np.flatnonzero(np.concatenate([[True], ~goes_on]))
    out = paths[head].copy()
    out[:, 2] = np.add.reduceat(paths[:, 2], head)
    return out


def _sources(h: np.ndarray, doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each edge place the index of the place of its edge with the smallest (doc, at)."""
    order = np.lexsort((at, doc, h))
    hs = h[order]
    new = np.concatenate([[True], hs[1:] != hs[:-1]]) if len(hs) else np.zeros(0, bool)
    heads = order[new]
    source = np.empty(len(h), np.int64)
    source[order] = heads[np.cumsum(new) - 1] if len(hs) else order
    return source


def _repeats(doc: np.ndarray, at: np.ndarray, source: np.ndarray) -> np.ndarray:
    """Paths of the places whose source lies in a document with a smaller id."""
    again = np.flatnonzero(doc[source] < doc)
    return compact(np.stack([doc[again], at[again], np.ones(len(again), np.int64),
                             doc[source[again]], at[source[again]]], axis=1))


def _batch_rows(ids: list[int], texts: list[bytes], k: int, bits: int, seed: int, hash_bits: int) -> list[dict]:
    """A batch's edges without its own repeats, by hash range, and the paths of those."""
    h, owner, at = edge_hashes(texts, k, seed)
    h &= np.uint64((1 << 64) - (1 << (64 - hash_bits)))
    if not len(h):
        return []
    doc = np.array(ids, np.int64)[owner]
    source = _sources(h, doc, at)
    rows = []
    paths = _repeats(doc, at, source)
    if len(paths):
        rows.append({"range": int(h[0] >> np.uint64(64 - bits)), "paths": _pack_paths(paths)})
    # All places in the first document go on: a smaller id elsewhere decides for each.
    alone = doc[source] == doc
    h, owner, at = h[alone], owner[alone], at[alone]
    at_range = (h >> np.uint64(64 - bits)).astype(np.int64)
    order = np.argsort(at_range, kind="stable")
    ids_packed = _pack(np.array(ids, np.int64), delta=True)
    cuts = np.flatnonzero(np.diff(at_range[order], prepend=-1))
    for lo, hi in zip(cuts, [*cuts[1:], len(order)]):
        part = order[lo:hi]
        rows.append({"range": int(at_range[part[0]]), "ids": ids_packed, "hash": _pack(h[part].view(np.int64), 7),
                     "text": _pack(owner[part], 4, True), "word": _pack(at[part], 4)})
    return rows


_EDGES = pa.schema([("range", pa.int32()), ("ids", pa.binary()), ("hash", pa.binary()), ("text", pa.binary()),
                    ("word", pa.binary()), ("paths", pa.binary())])


def edges(docs: DataFrame, k: int, bits: int, seed: int = 0, hash_bits: int = 64) -> DataFrame:
    """Rows of _EDGES: the edges of each batch, packed by hash range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        texts: list[bytes] = []
        size = 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(i)
                texts.append(text.as_py())
                size += len(texts[-1])
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(_batch_rows(ids, texts, k, bits, seed, hash_bits), schema=_EDGES)
                    ids, texts, size = [], [], 0
        if ids:
            yield pa.RecordBatch.from_pylist(_batch_rows(ids, texts, k, bits, seed, hash_bits), schema=_EDGES)

    return in_batches(docs).mapInArrow(run, "range int, ids binary, hash binary, text binary, word binary, paths binary")


def join_by_edge(packed: DataFrame, bits: int, sets: int) -> DataFrame:
    """(part, paths): the paths that the meeting of equal edges gives, by set of documents."""
    def run(group: pa.Table) -> pa.Table:
        found = [np.zeros((0, 5), np.int64)]
        h, doc, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for row in group.to_batches(max_chunksize=1):
            row = {name: row.column(k)[0].as_py() for k, name in enumerate(row.schema.names)}
            if row["paths"] is not None:
                found.append(_unpack_paths(row["paths"]))
                continue
            top = np.uint64(row["range"] >> (bits - 8)) << np.uint64(56)
            h.append(_unpack(row["hash"], 7).view(np.uint64) | top)
            doc.append(_unpack(row["ids"], delta=True)[_unpack(row["text"], 4, delta=True)])
            at.append(_unpack(row["word"], 4))
        h, doc, at = np.concatenate(h), np.concatenate(doc), np.concatenate(at)
        found.append(_repeats(doc, at, _sources(h, doc, at)))
        paths = compact(np.concatenate(found))
        part = (_mixed(paths[:, 0].view(np.uint64)) % np.uint64(sets)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        cuts = np.flatnonzero(np.diff(part[order], prepend=-1))
        ends = [*cuts[1:], len(order)]
        return pa.table({"part": pa.array(part[order[cuts]] if len(cuts) else [], pa.int64()),
                         "paths": pa.array([_pack_paths(paths[order[a:b]]) for a, b in zip(cuts, ends)], pa.binary())})

    return packed.groupBy("range").applyInArrow(run, "part bigint, paths binary")


def compact_paths(packed: DataFrame) -> DataFrame:
    """Paths as rows (doc, start, n, src_doc, src_start), compacted per set of documents."""
    def run(group: pa.Table) -> pa.Table:
        paths = compact(np.concatenate([_unpack_paths(p.as_py()) for p in group.column("paths")]))
        return pa.table({c: pa.array(paths[:, k]) for k, c in enumerate(_PATH)})

    return packed.groupBy("part").applyInArrow(run, _PATH_TYPE)


def _set_of(doc: Column, sets: int) -> Column:
    """The set of documents that a document belongs to."""
    return F.pmod(F.xxhash64(doc), F.lit(sets).cast("bigint"))


def _blocks(start: Column, n: Column) -> Column:
    """The blocks of words in which the edges start, start + 1, ..., start + n - 1 lie."""
    return F.explode(F.sequence(F.floor(start / F.lit(BLOCK_WORDS)), F.floor((start + n - 1) / F.lit(BLOCK_WORDS))))


def _at_sources(paths: DataFrame, marks: DataFrame, sets: int) -> DataFrame:
    """Each path with each mark (_doc, _start, _n and more) that overlaps its source.

    They meet by document and block of words, so AQE can split a source that many copy.
    """
    ahead = marks.withColumn("_block", _blocks(F.col("_start"), F.col("_n")))
    here = paths.withColumn("_at_block", _blocks(F.col("src_start"), F.col("n")))
    meet = ((F.col("src_doc") == F.col("_doc")) & (F.col("_at_block") == F.col("_block"))
            & (F.col("src_start") < F.col("_start") + F.col("_n"))
            & (F.col("_start") < F.col("src_start") + F.col("n")))
    return here.join(ahead, meet, "left").drop("_block", "_at_block").withColumn("part", _set_of(F.col("doc"), sets))


def _per_edge(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Of rows of :func:`_at_sources` the edges (doc, start, 1, src_doc, src_start), and for each
    the row whose mark covers its source, or -1."""
    rows = np.stack([group.column(c).to_numpy() for c in _PATH], axis=1).astype(np.int64)
    order = np.lexsort(rows.T[::-1])
    new = np.ones(len(rows), bool)
    new[1:] = (rows[order[1:]] != rows[order[:-1]]).any(1)
    path_of = np.empty(len(rows), np.int64)
    path_of[order] = np.cumsum(new) - 1
    paths = rows[order[new]]
    first = np.cumsum(paths[:, 2]) - paths[:, 2]
    edge = np.repeat(paths, paths[:, 2], axis=0)
    step = np.arange(len(edge)) - np.repeat(first, paths[:, 2])
    edge[:, 1] += step
    edge[:, 4] += step
    edge[:, 2] = 1
    mark = np.full(len(edge), -1)
    there = np.flatnonzero(group.column("_start").is_valid().to_numpy())
    if len(there):
        start = group.column("_start").fill_null(0).to_numpy()[there].astype(np.int64)
        end = start + group.column("_n").fill_null(0).to_numpy()[there].astype(np.int64)
        at, n = rows[there, 4], rows[there, 2]
        low, high = np.maximum(start, at), np.minimum(end, at + n)
        size = high - low
        begin = first[path_of[there]] + low - at
        mark[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())] = np.repeat(there, size)
    return edge, mark


def follow_sources(paths: DataFrame, sets: int) -> DataFrame:
    """Paths whose sources are the first places of their edges.

    A repeat that its own batch resolved leads to the batch's first document. Where that
    place is itself repeated its own source takes over; elsewhere it is the first of all.
    """
    ahead = paths.select(F.col("doc").alias("_doc"), F.col("start").alias("_start"), F.col("n").alias("_n"),
                         F.col("src_doc").alias("_src"), F.col("src_start").alias("_at"))

    def run(group: pa.Table) -> pa.Table:
        edge, mark = _per_edge(group)
        on = np.flatnonzero(mark >= 0)
        column = lambda c: group.column(c).fill_null(0).to_numpy()[mark[on]].astype(np.int64)
        edge[on, 4] += column("_at") - column("_start")
        edge[on, 3] = column("_src")
        found = compact(edge)
        return pa.table({c: pa.array(found[:, k]) for k, c in enumerate(_PATH)})

    return _at_sources(paths, ahead, sets).groupBy("part").applyInArrow(run, _PATH_TYPE)


# -- the graph --------------------------------------------------------------------------

def repeated_edges(paths: DataFrame, sets: int) -> DataFrame:
    """(doc, start, n): the longest runs of source coordinates. Each coordinate is one edge.

    The aggregate leaves a document one row per word at most, however many copy it.
    """
    cover = (paths.groupBy("src_doc", "src_start").agg(F.max("n").alias("n"))
             .withColumn("part", _set_of(F.col("src_doc"), sets)))

    def run(group: pa.Table) -> pa.Table:
        doc, start, n = (group.column(c).to_numpy() for c in ("src_doc", "src_start", "n"))
        order = np.lexsort((start, doc))
        doc, start, end = doc[order], start[order], (start + n)[order]
        out = []
        for lo, hi in _groups(doc):
            reach = np.maximum.accumulate(end[lo:hi])
            head = np.flatnonzero(np.concatenate([[True], start[lo + 1:hi] > reach[:-1]]))
            last = np.append(head[1:], hi - lo) - 1
            out.append(np.stack([doc[lo + head], start[lo + head], reach[last] - start[lo + head]], axis=1))
        found = np.concatenate(out)
        return pa.table({c: pa.array(found[:, k]) for k, c in enumerate(("doc", "start", "n"))})

    return cover.groupBy("part").applyInArrow(run, "doc bigint, start bigint, n bigint")


def _groups(sorted_values: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first, end) of each run of equal values."""
    heads = np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))
    return zip(heads.tolist(), np.append(heads[1:], len(sorted_values)).tolist())


def graph_nodes(docs: DataFrame, runs: DataFrame, k: int, sets: int, seed: int = 0) -> DataFrame:
    """(node, doc, at, comes, goes): the nodes of each run of edges. A node is the hash of the
    ``k`` - 1 words at (doc, at); whether the run has an edge that comes in and one that goes out."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        spans = np.stack([right.column(c).to_numpy() for c in ("doc", "start", "n")], axis=1).astype(np.int64)
        spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
        ids, texts, cut = [], [], []
        for doc, text in zip(left.column("doc").to_pylist(), left.column("text")):
            lo, hi = np.searchsorted(spans[:, 0], [doc, doc + 1])
            if lo < hi:
                ids.append(doc)
                texts.append(text.as_py())
                cut.append(spans[lo:hi])
        h, owner, _ = edge_hashes(texts, k - 1, seed) if texts else (np.zeros(0, np.uint64), np.zeros(0, int), None)
        begin = np.searchsorted(owner, np.arange(len(texts) + 1))
        out = [np.zeros((0, 5), np.int64)]
        for i, doc in enumerate(ids):
            own = h[begin[i]:begin[i + 1]].view(np.int64)
            for _, start, n in cut[i].tolist():
                if start + n >= len(own):   # of another row with this id
                    continue
                node = np.empty((n + 1, 5), np.int64)
                node[:, 0], node[:, 1], node[:, 2] = own[start:start + n + 1], doc, np.arange(start, start + n + 1)
                node[:, 3:] = 1
                node[0, 3] = node[n, 4] = 0
                out.append(node)
        found = np.concatenate(out)
        return pa.table({"node": pa.array(found[:, 0]), "doc": pa.array(found[:, 1]), "at": pa.array(found[:, 2]),
                         "comes": pa.array(found[:, 3].astype(np.int32)), "goes": pa.array(found[:, 4].astype(np.int32))})

    texts = docs.filter("doc IS NOT NULL").withColumn("part", _set_of(F.col("doc"), sets))
    asked = runs.withColumn("part", _set_of(F.col("doc"), sets))
    return texts.groupBy("part").cogroup(asked.groupBy("part")).applyInArrow(
        run, "node bigint, doc bigint, at bigint, comes int, goes int")


def degrees(nodes: DataFrame) -> DataFrame:
    """(node, n_in, n_out, in_doc, in_at, out_doc, out_at): the edges that come into and go out
    of each node, and where it stands in those, told only of a node with one of each."""
    one = lambda flag, c: F.max(F.when(F.col(flag) == 1, F.col(c)))
    return nodes.groupBy("node").agg(
        F.sum("comes").alias("n_in"), F.sum("goes").alias("n_out"), one("comes", "doc").alias("in_doc"),
        one("comes", "at").alias("in_at"), one("goes", "doc").alias("out_doc"), one("goes", "at").alias("out_at"))


def nonbranching(runs: DataFrame, nodes: DataFrame, sets: int) -> DataFrame:
    """(doc, start, n, path): the runs of edges cut at branches, and the nonbranching path
    that each segment lies on, named by one of its segments. A cycle is one path."""
    degree = written(degrees(nodes).filter("n_in > 1 OR n_out > 1 OR (n_in = 1 AND n_out = 1 AND "
                                           "(in_doc <> out_doc OR in_at <> out_at))"))
    branch = degree.filter("n_in > 1 OR n_out > 1")
    cuts = nodes.filter("comes = 1 AND goes = 1").join(branch, "node", "left_semi").select("doc", "at")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        whole = np.stack([left.column(c).to_numpy() for c in ("doc", "start", "n")], axis=1).astype(np.int64)
        at = np.stack([right.column(c).to_numpy() for c in ("doc", "at")], axis=1).astype(np.int64)
        # heads of runs and cuts in one order; a segment ends at the next cut or the run's end
        doc = np.concatenate([whole[:, 0], at[:, 0]])
        start = np.concatenate([whole[:, 1], at[:, 1]])
        end = np.concatenate([whole[:, 1] + whole[:, 2], np.full(len(at), -1)])
        order = np.lexsort((start, doc))
        doc, start, end = doc[order], start[order], end[order]
        if not len(doc):
            return pa.table({c: pa.array([], pa.int64()) for c in ("doc", "start", "n")})
        head = np.maximum.accumulate(np.where(end >= 0, np.arange(len(end)), 0))
        stop = end[head]
        more = np.flatnonzero(head[1:] == head[:-1])
        stop[more] = start[more + 1]
        keep = stop > start
        return pa.table({"doc": pa.array(doc[keep]), "start": pa.array(start[keep]),
                         "n": pa.array((stop - start)[keep])})

    split = (runs.withColumn("part", _set_of(F.col("doc"), sets)).groupBy("part")
             .cogroup(cuts.distinct().withColumn("part", _set_of(F.col("doc"), sets)).groupBy("part"))
             .applyInArrow(run, "doc bigint, start bigint, n bigint"))
    segments = written(split.withColumn("segment", F.monotonically_increasing_id()))
    ends = segments.select(F.col("doc").alias("in_doc"), (F.col("start") + F.col("n")).alias("in_at"),
                           F.col("segment").alias("a"))
    starts = segments.select(F.col("doc").alias("out_doc"), F.col("start").alias("out_at"),
                             F.col("segment").alias("b"))
    links = (degree.filter("n_in = 1 AND n_out = 1").join(ends, ["in_doc", "in_at"])
             .join(starts, ["out_doc", "out_at"]).select("a", "b"))
    return (segments.join(components(links), F.col("segment") == F.col("node"), "left")
            .select("doc", "start", "n", F.coalesce("root", "segment").alias("path")))


_PIECE_TYPE = f"{_PATH_TYPE}, path bigint, span_start bigint, span_n bigint"


def traverse(paths: DataFrame, segments: DataFrame, sets: int) -> DataFrame:
    """Paths cut as the segments at their sources: _PATH, the nonbranching path of each
    piece, and the span (span_start, span_n) of the document's pieces in a row on that path."""
    marks = segments.select(F.col("doc").alias("_doc"), F.col("start").alias("_start"), F.col("n").alias("_n"),
                            F.col("path").alias("_path"))

    def run(group: pa.Table) -> pa.Table:
        edge, mark = _per_edge(group)
        order = np.lexsort((edge[:, 1], edge[:, 0]))
        edge, mark = edge[order], mark[order]
        again = np.concatenate([[False], (edge[1:, :2] == edge[:-1, :2]).all(1)])
        edge, mark = edge[~again], mark[~again]
        # an edge without a segment (of another row with the source's id) is a path of its own
        label = np.where(mark >= 0, group.column("_path").fill_null(0).to_numpy()[mark].astype(np.int64),
                         -1 - np.arange(len(mark)))
        segment = np.where(mark >= 0, group.column("_start").fill_null(0).to_numpy()[mark].astype(np.int64), -1)
        new = np.ones(len(edge), bool)
        new[1:] = ((edge[1:, 0] != edge[:-1, 0]) | (edge[1:, 1] != edge[:-1, 1] + 1)
                   | (label[1:] != label[:-1]))
        piece = new.copy()
        piece[1:] |= ((edge[1:, 3] != edge[:-1, 3]) | (edge[1:, 4] != edge[:-1, 4] + 1)
                      | (segment[1:] != segment[:-1]))
        head = np.flatnonzero(piece)
        spans = np.flatnonzero(new)
        of = np.cumsum(new)[head] - 1
        out = {c: pa.array(edge[head, k]) for k, c in enumerate(_PATH)}
        out["n"] = pa.array(np.diff(np.append(head, len(edge))))
        out |= {"path": pa.array(label[head]), "span_start": pa.array(edge[spans, 1][of]),
                "span_n": pa.array(np.diff(np.append(spans, len(edge)))[of])}
        return pa.table(out)

    return _at_sources(paths, marks, sets).groupBy("part").applyInArrow(run, _PIECE_TYPE)


# -- the texts --------------------------------------------------------------------------

_READ = ("doc bigint, start bigint, n bigint, digest binary, n_words bigint, n_removed bigint, "
         "kept_sha256 string, kept binary")


def _read_text(doc: int | None, text: bytes, spans: np.ndarray, k: int, with_text: bool) -> list[dict]:
    """The document's row, and a digest of the words of each asked span (start, n, own)."""
    words = text.split()
    gone = np.zeros(len(words) + 1, np.int64)
    rows = []
    for start, n, own in spans.tolist():
        if start + n + k - 1 > len(words):
            continue
        piece = b" ".join(words[start:start + n + k - 1])
        rows.append({"doc": doc, "start": start, "n": n,
                     "digest": hashlib.blake2b(piece, digest_size=16).digest()})
        if own:
            gone[start] += 1
            gone[start + n + k - 1] -= 1
    covered = np.cumsum(gone)[:-1] > 0
    kept = b" ".join([words[i] for i in np.flatnonzero(~covered).tolist()] if covered.any() else words)
    rows.append({"doc": doc, "n_words": len(words), "n_removed": int(covered.sum()),
                 "kept_sha256": hashlib.sha256(kept).hexdigest(), "kept": kept if with_text else None})
    return rows


def read_texts(docs: DataFrame, paths: DataFrame, k: int, sets: int, with_text: bool = False) -> DataFrame:
    """Rows of _READ: a row per document without the words of its spans (start null), and
    a digest per piece and source. Texts and spans meet by set of documents."""
    gone = ("span_start", "span_n") if "span_n" in paths.columns else ("start", "n")
    asked = (paths.select("doc", "start", "n", F.lit(0).alias("own"))
             .union(paths.select("src_doc", "src_start", "n", F.lit(0)))
             .union(paths.select("doc", *gone, F.lit(1))))
    asked = (asked.groupBy("doc", "start", "n").agg(F.max("own").alias("own"))
             .withColumn("part", _set_of(F.col("doc"), sets)))
    texts = docs.withColumn("part", _set_of(F.coalesce("doc", F.xxhash64("text")), sets))
    schema = pa.schema([("doc", pa.int64()), ("start", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()),
                        ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
                        ("kept", pa.binary())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        spans = np.stack([right.column(c).to_numpy() for c in ("doc", "start", "n", "own")], axis=1).astype(np.int64)
        spans = spans[np.lexsort((spans[:, 2], spans[:, 1], spans[:, 0]))]
        out = []
        for doc, text in zip(left.column("doc").to_pylist(), left.column("text")):
            lo, hi = (0, 0) if doc is None else np.searchsorted(spans[:, 0], [doc, doc + 1])
            out += _read_text(doc, text.as_py(), spans[lo:hi, 1:], k, with_text)
        return pa.Table.from_pylist(out, schema=schema)

    return texts.groupBy("part").cogroup(asked.groupBy("part")).applyInArrow(run, _READ)


def _false_paths(paths: DataFrame, read: DataFrame) -> DataFrame:
    """Paths whose words differ from the words at their source."""
    spans = read.filter("start IS NOT NULL").select("doc", "start", "n", "digest").distinct()
    source = spans.select(F.col("doc").alias("src_doc"), F.col("start").alias("src_start"), "n",
                          F.col("digest").alias("_digest"))
    return (paths.join(spans, ["doc", "start", "n"], "left").join(source, ["src_doc", "src_start", "n"], "left")
            .filter(~F.col("digest").eqNullSafe(F.col("_digest"))).select(*_PATH))


def _windows(paths: DataFrame) -> DataFrame:
    return paths.select("doc", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("at"))


def _solve(docs: DataFrame, id_col: str, text_col: str, k: int, hash_bits: int,
           with_text: bool) -> tuple[DataFrame, DataFrame]:
    """The documents' rows of _READ, and the verified paths."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(8, int(size // 6 // RANGE_EDGES).bit_length())
    sets = int(size // SET_BYTES) * 2 + 9

    def paths_of(seed: int) -> DataFrame:
        packed = edges(rows.filter("doc IS NOT NULL"), k, bits, seed, hash_bits)
        return written(follow_sources(written(compact_paths(join_by_edge(packed, bits, sets))), sets))

    found = paths_of(0)
    runs = written(repeated_edges(found, sets))
    nodes = written(graph_nodes(rows, runs, k, sets))
    pieces = written(traverse(found, nonbranching(runs, nodes, sets), sets))
    read = written(read_texts(rows, pieces, k, sets, with_text))
    paths = pieces.select(*_PATH)
    false = written(_false_paths(paths, read))
    result = read.filter("start IS NULL")
    if false.isEmpty():
        return result, pieces
    # Different windows with one hash. Another hash function tells, of the windows of these
    # paths, which are not repeated and which truly are, until none is in doubt.
    hit = written(false.select("doc").distinct())
    true = written(paths.join(false, _PATH, "left_anti"))
    doubt, seed = written(_windows(false).distinct()), 0
    while not doubt.isEmpty():
        seed += 1
        found = paths_of(seed).join(doubt.select("doc").distinct(), "doc", "left_semi")
        false = written(_false_paths(found, read_texts(rows, found, k, sets)))
        true = written(true.union(found.join(false, _PATH, "left_anti")).distinct())
        doubt = written(doubt.join(_windows(false).distinct(), ["doc", "at"], "left_semi"))
    again = read_texts(rows.join(hit, "doc", "left_semi"), true.join(hit, "doc", "left_semi"), k, sets, with_text)
    spans = true.select("*", F.lit(None).cast("bigint").alias("path"), F.col("start").alias("span_start"),
                        F.col("n").alias("span_n"))
    return result.join(hit, "doc", "left_anti").unionByName(again.filter("start IS NULL")), spans


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    k: int = WINDOW, hash_bits: int = 64, with_text: bool = True) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_sha256 and, with ``with_text``,
    kept: the words that are left, joined by one blank.

    Removed are the words of every window of ``k`` words that also starts in a document with
    a smaller id. Null and empty texts have no words; texts under ``k`` words lose none. A
    row without an id loses nothing and is no source. Rows repeated with one id and text get
    equal results. An empty table gives an empty result. Ids must be integers, ``k`` 2 or more;
    other columns are ignored. ``hash_bits`` below 64 makes different windows meet, for tests.
    """
    kind = dict(docs.dtypes)[id_col]
    result, _ = _solve(docs, id_col, text_col, k, hash_bits, with_text)
    kept = [F.col("kept").cast("string").alias("kept")] if with_text else []
    return result.select(F.col("doc").cast(kind).alias(id_col), "n_words", "n_removed", "kept_sha256", *kept)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   k: int = WINDOW) -> DataFrame:
    """The verified pieces themselves: (id, first_word, n_words, source_id, source_word, path,
    span_first, span_words).

    A piece is a passage of ``k`` words or more that stands word for word in the source, a
    document with a smaller id. ``path`` names the nonbranching path of its windows, with equal
    windows in all documents on one path; the document's pieces in a row on one path are one
    span, whose words are told with each of them. Neighbours overlap by up to ``k`` - 1 words.

    Null and empty texts, texts under ``k`` words and rows without an id have no piece; rows
    repeated with one id and text give their pieces once; an empty table gives none; other
    columns are ignored. Where two windows had one hash, ``path`` is null and each piece its
    own span.
    """
    kind = dict(docs.dtypes)[id_col]
    _, pieces = _solve(docs, id_col, text_col, k, 64, False)
    return pieces.select(F.col("doc").cast(kind).alias(id_col), F.col("start").alias("first_word"),
                         (F.col("n") + k - 1).alias("n_words"), F.col("src_doc").cast(kind).alias("source_id"),
                         F.col("src_start").alias("source_word"), "path", F.col("span_start").alias("span_first"),
                         (F.col("span_n") + k - 1).alias("span_words"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), with_text=False)


ORACLE = """
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t-\\r]+'), lambda x: x <> '') AS w
  FROM documents),
g AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS m FROM g) WHERE m < doc_id),
c AS (SELECT DISTINCT doc_id, i + j AS p FROM r, range(0, 13) AS t(j)),
x AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
y AS (
  SELECT x.doc_id, count(c.p) AS n_removed,
         string_agg(x.word, ' ' ORDER BY x.p) FILTER (c.p IS NULL) AS kept
  FROM x LEFT JOIN c ON x.doc_id = c.doc_id AND x.p = c.p GROUP BY x.doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(y.n_removed, 0) AS n_removed,
       sha256(coalesce(y.kept, '')) AS kept_sha256
FROM d LEFT JOIN y ON d.doc_id = y.doc_id
"""
