"""Periodic runs of words: Lyndon arrays by Baier's grouping, roots extended into runs.

A run is a stretch of words with smallest period q that is at least 2 q long and that no
neighbouring word extends. Every run has a Lyndon root: under the order of the words or
under the reversed one, the longest Lyndon word at some place of it is as long as its
period. So the longest Lyndon words under both orders, each extended to the left and to the
right while words a period apart are equal, give all runs (Bannai et al. 2017).

The longest Lyndon words come from the first phase of Baier's suffix sorter (2016) alone.
It keeps suffixes in groups of a common context, at first by their first word, and takes
the groups from the greatest down. Each suffix of a finished group points to the nearest
place before it that is in no finished group; a place with k such pointers gets k times the
group's context added to its own and moves to a new group directly above its old one. When
all groups are finished, a suffix's context is its longest Lyndon prefix.

Extension needs the longest common extensions of two places. They are found for all roots
of a batch at once by bisection over prefix hashes, and each distinct run is then compared
word by word; where hashes collided, its ends are found by comparing words.

Most texts have few or no runs, so a batch is cut first to the zones that can hold any: a
run of 12 words or more is covered by sequences of 6 words (half of the least length) that
occur again in it, at most half a zone away. Zones follow from equal words only, so they lose no run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.common import in_batches, table

#: Least words of a reported run (and twice its period at least).
MIN_LENGTH = 12
#: Bytes of text that are worked on at once (one text is never cut).
PIECE = 4 << 20

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def lyndon_lengths(words: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each place (phase one of the sorter).

    ``words`` are numbers whose order is the order of the words; the end of the text is
    less than any word.
    """
    n = len(words)
    places: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        places.setdefault(w, []).append(i)
    ordered = sorted(places)
    members = [places[w] for w in ordered]        # of each group; some may have left since
    context = [1] * len(ordered)                  # words in the context of each group
    below = list(range(-1, len(ordered) - 1))     # neighbours in the order of the groups
    above = [*range(1, len(ordered)), -1]
    group = [0] * n
    for g, own in enumerate(members):
        for i in own:
            group[i] = g
    before = list(range(-1, n - 1))               # all places between are finished
    finished = [False] * n
    g = len(members) - 1
    while g >= 0:
        own = [i for i in members[g] if group[i] == g]
        for i in own:
            finished[i] = True
        pointers: dict[int, int] = {}
        for i in own:
            at = before[i]
            path = [i]
            while at >= 0 and finished[at]:
                path.append(at)
                at = before[at]
            for p in path:
                before[p] = at
            if at >= 0:
                pointers[at] = pointers.get(at, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for at, k in pointers.items():
            moved.setdefault((k, group[at]), []).append(at)
        # More pointers make a greater context: the fewest go in last, next to the old group.
        for k, old in sorted(moved, reverse=True):
            new, top = len(members), above[old]
            members.append(moved[k, old])
            context.append(context[old] + k * context[g])
            below.append(old)
            above.append(top)
            above[old] = below[top] = new
            for at in moved[k, old]:
                group[at] = new
        g = below[g]
    return [context[g] for g in group]


def zones(codes: np.ndarray, begins: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the stretches that can hold runs, in ascending order.

    ``codes`` are the words of several texts, ``begins`` where each text begins. A sequence
    of ``span`` words counts while the nearest place with the same sequence in its text is
    at most half its zone away; what the counting ones cover makes the zones.
    """
    n = len(codes) - span + 1
    none = np.zeros(0, np.int64)
    if n < 1:
        return none, none
    mixed = codes.astype(np.uint64) * _MULTIPLIER
    key = np.zeros(n, np.uint64)
    for k in range(span):
        key = (key ^ mixed[k:k + n]) * np.uint64(0xBF58476D1CE4E5B9)
        key ^= key >> np.uint64(29)
    text = np.searchsorted(begins, np.arange(len(codes)), "right")
    at = np.flatnonzero(text[:n] == text[span - 1:])
    key = key[at] ^ (text[at].astype(np.uint64) * _MULTIPLIER)
    order = np.argsort(key, kind="stable")
    key, place = key[order], at[order]
    gap = np.where(key[1:] == key[:-1], place[1:] - place[:-1], len(codes))
    if not (gap < len(codes)).any():
        return none, none
    nearest = np.empty(len(place), np.int64)
    nearest[order] = np.minimum(np.concatenate([gap, [len(codes)]]), np.concatenate([[len(codes)], gap]))
    keep = nearest < len(codes)
    at, nearest = at[keep], nearest[keep]
    while len(at):
        first = np.concatenate([[True], (at[1:] > at[:-1] + span) | (text[at[1:]] != text[at[:-1]])])
        zone = np.cumsum(first) - 1
        start = at[first]
        end = at[np.concatenate([first[1:], [True]])] + span
        keep = nearest <= ((end - start) // 2)[zone]
        if keep.all():
            return start, end
        at, nearest = at[keep], nearest[keep]
    return none, none


def _common(test, limit: np.ndarray) -> np.ndarray:
    """The greatest length up to ``limit`` for which ``test`` holds (it holds for all less)."""
    low, high = np.zeros_like(limit), limit.copy()
    while (low < high).any():
        half = (low + high + 1) // 2
        good = test(half)
        low, high = np.where(good, half, low), np.where(good, high, half - 1)
    return low


def _extend(codes: np.ndarray, at: int, q: int, begin: int, end: int) -> tuple[int, int]:
    """Begin and end of the stretch of period ``q`` around ``at``, by comparing words."""
    other = np.flatnonzero(codes[at:end - q] != codes[at + q:end])
    right = at + q + (int(other[0]) if len(other) else end - q - at)
    other = np.flatnonzero(codes[begin:at] != codes[begin + q:at + q])
    return (begin + int(other[-1]) + 1 if len(other) else begin), right


def runs_of(codes: np.ndarray, begins: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Rows (start, end, period) of all runs of ``min_length`` words or more in the texts,
    by start, then period. Places count through all texts; no run leaves its text."""
    codes = np.asarray(codes, np.int64)
    start, end = zones(codes, begins, max(1, min_length // 2))
    found: list[np.ndarray] = []
    for a, b in zip(start.tolist(), end.tolist()):
        if b - a < max(2, min_length):
            continue
        word = codes[a:b]
        for one in (word, -word):
            size = np.array(lyndon_lengths(one.tolist()), np.int64)
            i = np.arange(len(size))
            # Some word beside the root must continue it.
            more = (i + size < len(size)) & (word == word[np.minimum(i + size, len(size) - 1)])
            more |= (i > 0) & (word[i - 1] == word[i + size - 1])
            i = i[more & (2 * size <= len(size))]
            found.append(np.stack([a + i, size[i], np.full(len(i), a), np.full(len(i), b)], 1))
    if not found:
        return np.zeros((0, 3), np.int64)
    at, q, a, b = np.unique(np.concatenate(found), axis=0).T
    power = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(codes), _MULTIPLIER)]))
    value = codes.astype(np.uint64) * np.uint64(0x94D049BB133111EB)
    value ^= value >> np.uint64(31)
    prefix = np.concatenate([[np.uint64(0)], np.cumsum((value + np.uint64(1)) * power[:-1], dtype=np.uint64)])
    shift = power[q]
    right = _common(lambda n: (prefix[at + n] - prefix[at]) * shift == prefix[at + q + n] - prefix[at + q], b - at - q)
    left = _common(lambda n: (prefix[at] - prefix[at - n]) * shift == prefix[at + q] - prefix[at + q - n], at - a)
    rows = np.stack([at - left, at + q + right, q], 1)
    enough = rows[:, 1] - rows[:, 0] >= np.maximum(min_length, 2 * q)
    rows, seed, bounds = rows[enough], at[enough], np.stack([a, b], 1)[enough]
    runs, which = np.unique(rows, axis=0, return_inverse=True)
    which = which.ravel()
    good = np.array([np.array_equal(codes[s:e - p], codes[s + p:e]) for s, e, p in runs.tolist()], bool)
    if not good.all():
        again = [(*_extend(codes, int(seed[k]), int(rows[k, 2]), *bounds[k].tolist()), int(rows[k, 2]))
                 for k in np.flatnonzero(~good[which])]
        again = [r for r in again if r[1] - r[0] >= max(min_length, 2 * r[2])]
        runs = np.unique(np.concatenate([runs[good], np.array(again, np.int64).reshape(-1, 3)]), axis=0)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _collapsed(words: list[bytes], begins: np.ndarray, runs: np.ndarray) -> list[bytes]:
    """Each text's words, joined by one space, without those after a run's first period."""
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 1], -1)
    keep = np.cumsum(depth[:-1]) == 0
    out = []
    for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(words)]):
        own = words[a:b]
        out.append(b" ".join(own if keep[a:b].all() else [own[k] for k in np.flatnonzero(keep[a:b])]))
    return out


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about :data:`PIECE` bytes of text."""
    size = np.cumsum([len(t) if t is not None else 0 for t in batch.column(1).cast(pa.binary()).to_pylist()])
    at = 0
    while at < batch.num_rows:
        done = int(size[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(size, done + PIECE, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_length: int = MIN_LENGTH) -> DataFrame:
    """(id, n_words, runs, collapsed) for each row: its words (between ASCII white space), its
    runs as structs (start, length, period) by start, then period, and its words joined by
    one space, without those that a run holds after its first period.

    A run has ``min_length`` words at least (2 or more) and twice its period. Null and empty
    texts have no words and no runs. Texts of any length are read whole. Each row counts for
    itself: repeated rows give repeated rows, null ids are passed through, and columns of
    other names are ignored; an empty table gives an empty result.
    """
    if min_length < 2:
        raise ValueError("a run has two words at least")
    one = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in _pieces(batch):
                split = [(t or "").encode("utf-8", "surrogatepass").split() for t in piece.column(1).to_pylist()]
                words = [w for text in split for w in text]
                count = np.array([len(text) for text in split], np.int64)
                begins = np.cumsum(count) - count
                codes = pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy()
                runs = runs_of(codes, begins, min_length)
                # An empty text begins where the next one does; the last of them holds the run.
                text = np.searchsorted(begins, runs[:, 0], "right") - 1
                ends = np.searchsorted(text, np.arange(len(split) + 1))
                listed = pa.StructArray.from_arrays(
                    [pa.array(runs[:, 0] - begins[text]), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])],
                    fields=list(one))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(count), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), listed),
                     pa.array(_collapsed(words, begins, runs), pa.binary()).cast(pa.string())],
                    [id_col, "n_words", "runs", "collapsed"])

    return in_batches(docs.select(F.col(id_col), F.col(text_col).cast("string"))).mapInArrow(
        run, f"`{id_col}` {dict(docs.dtypes)[id_col]}, n_words bigint, "
             "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the texts of the query: of each document whose crc32(doc_id as text)
    is a multiple of ten, word i >= a becomes word a + (i - a) % p. Rows without an id and
    texts without words stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string"))
    split = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.floor(h / 10).alias("_g"),
                       F.when(h % 10 == 0, split).alias("_w"))
    n = F.size("_w").cast("bigint")
    rows = rows.withColumn("_a", F.when(n > 0, F.col("_g") % n))
    a = F.col("_a")
    rows = rows.withColumn("_p", 1 + F.floor((n - a) / (3 + F.col("_g") % 8)))

    def word(i: Column) -> Column:
        i = i.cast("bigint")
        return F.get("_w", F.when(i < a, i).otherwise(a + (i - a) % F.col("_p")).cast("int"))

    tail = F.array_join(F.transform(F.sequence(F.lit(0), n.cast("int") - 1), word), " ")
    return rows.select("doc_id", F.when(a.isNotNull(), tail).otherwise(F.col("text")).alias("text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periodic_runs(with_periodic_tails(table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    rows = rows.withColumn("_best", best)
    length, period = F.col("_best.length"), -F.col("_best.period")
    return rows.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("_best.start")).alias("start"),
        length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).cast("bigint").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256)
        .alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
