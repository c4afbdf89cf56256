"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

The pattern of the vocabulary cuts a text into pieces. Every byte of a piece becomes one
printable character (the byte alphabet), and the library's BPE model merges the pieces of a
batch that the worker does not know yet; what it found is kept by piece, in a cache of
bounded size. Decoding goes the other way through the byte table: the bytes of all tokens
stand one after the other, with an offset for each, and a text is gathered from there as
bytes, so that a character whose bytes lie in several tokens comes out whole.

Ranks give no merges, only tokens. Two neighbours merge if their bytes together are a
token, lowest rank first, the left one of equals; so every way to cut a token in two
tokens is a merge for the library, in rank order. A piece that is a token as a whole is
that token. The library knows no equal ranks: where two cuts of one token can overlap in a
text ("ere" in "erere"), its order could differ, so a piece that holds such a sequence
(:meth:`ByteBpe.order_matters`) is merged by :meth:`ByteBpe.merge` instead.

The rank file is read once on the driver and broadcast; its size is that of the file.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.bpe import byte_alphabet
from panelkit.llm.common import in_batches, table

#: Pieces whose encoding a worker remembers; then it forgets all and starts again.
CACHE_PIECES = 300_000
#: Longer pieces are encoded each time, so that the cache stays small.
CACHE_CHARS = 64
#: Texts of a batch that are worked on at once; their outputs are as long as they are.
TEXTS = 256


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Token bytes -> id, from lines of base64 and rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines()) if token}


class ByteBpe:
    """Tables of one rank file, with an exact encoder and decoder."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        from tokenizers import models
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("every byte must be a token")
        self.ranks = ranks
        self.pieces = regex.compile(pattern).findall
        alphabet = byte_alphabet()
        self._to_char = str.maketrans({chr(b): c for b, c in enumerate(alphabet)})
        by_rank = sorted(ranks, key=ranks.__getitem__)
        cuts = [(t[:k], t[k:]) for t in by_rank for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        self.library = models.BPE(      # without a cache: pieces that come again are kept here
            vocab={self._mapped(t): i for t, i in ranks.items()}, ignore_merges=True, cache_capacity=0,
            merges=[(self._mapped(a), self._mapped(b)) for a, b in cuts])
        self._tied = ahocorasick.Automaton()
        overlaps, often = self.order_matters(cuts)
        for part in overlaps | often:
            self._tied.add_word(self._mapped(part), "" if part in overlaps else self._mapped(part))
        self._tied.make_automaton()
        # Decoding: the bytes of all tokens one after the other, and where each begins.
        size = np.zeros(max(ranks.values()) + 2, np.int64)
        for token, i in ranks.items():
            size[i + 1] = len(token)
        self.offset = np.cumsum(size)
        self.blob = np.frombuffer(b"".join(by_rank), np.uint8)
        self._cache: dict[str, bytes] = {}

    def _mapped(self, token: bytes) -> str:
        """One printable character for each byte."""
        return token.decode("latin-1").translate(self._to_char)

    def order_matters(self, cuts: list[tuple[bytes, bytes]]) -> tuple[set[bytes], set[bytes]]:
        """Without one of the first sequences, or one of the second twice, a piece gets the
        same tokens in whatever order the library takes the cuts of one token: two different
        cuts of it that share their middle part; tokens with several cuts that lead on to a
        token of lower rank."""
        lefts: dict[bytes, set[bytes]] = {}
        for a, b in cuts:
            lefts.setdefault(a + b, set()).add(a)
        overlaps = {a + b + (a + b)[len(b):] for a, b in cuts if a != b and b in lefts[a + b]}
        often = {part for a, b in cuts for part in (a, b)
                 if len(lefts.get(part, ())) > 1 and self.ranks[part] > self.ranks[a + b]}
        return overlaps, often

    def _order_matters_in(self, mapped: str) -> bool:
        seen = set()
        for _, part in self._tied.iter(mapped):
            if not part or part in seen:
                return True
            seen.add(part)
        return False

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a piece: merge the neighbours of lowest rank, the leftmost first."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        ends = list(range(1, len(piece) + 1))            # of the token that starts here
        before = list(range(-1, len(piece) - 1))         # start of the token to the left
        alive = [True] * len(piece)

        def offer(at: int) -> None:
            if at >= 0 and ends[at] < len(piece):
                end = ends[ends[at]]
                rank = self.ranks.get(piece[at:end])
                if rank is not None:
                    heapq.heappush(heap, (rank, at, end))

        heap: list[tuple[int, int, int]] = []
        for at in range(len(piece) - 1):
            offer(at)
        while heap:
            _, at, end = heapq.heappop(heap)
            if not alive[at] or ends[at] >= end or ends[at] == len(piece) or ends[ends[at]] != end:
                continue                                  # one of the two has merged since
            alive[ends[at]] = False
            ends[at] = end
            if end < len(piece):
                before[end] = at
            offer(at)
            offer(before[at])
        return [self.ranks[piece[at:ends[at]]] for at in range(len(piece)) if alive[at]]

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of pieces, as little-endian unsigned 32-bit integers."""
        out = {}
        for piece in pieces:
            raw = piece.encode("utf-8", "surrogatepass")
            mapped = self._mapped(raw)
            if raw in self.ranks or not self._order_matters_in(mapped):
                ids = [token.id for token in self.library.tokenize(mapped)]
            else:
                ids = self.merge(raw)
            out[piece] = struct.pack(f"<{len(ids)}I", *ids)
        return out

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.pieces(t) for t in texts]
        unknown = set().union(*split).difference(self._cache)
        self._cache.update(self._learn(list(unknown)))
        out = [b"".join(map(self._cache.__getitem__, s)) for s in split]
        if len(self._cache) > CACHE_PIECES:
            self._cache.clear()
        else:
            for piece in unknown:
                if len(piece) > CACHE_CHARS:
                    del self._cache[piece]
        return out

    def decode(self, ids: bytes) -> bytes:
        """The bytes that the tokens stand for, one after the other."""
        token = np.frombuffer(ids, "<u4").astype(np.int64)
        start, size = self.offset[token], self.offset[token + 1] - self.offset[token]
        first = np.cumsum(size) - size
        return self.blob[np.arange(int(size.sum())) + np.repeat(start - first, size)].tobytes()

    def spans(self, ids: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each token in the text, in characters; a token that holds some
        bytes of a character covers it whole, as the library's offsets do."""
        token = np.frombuffer(ids, "<u4").astype(np.int64)
        end = np.cumsum(self.offset[token + 1] - self.offset[token])
        if not len(end):
            return end, end
        begins = (np.frombuffer(self.decode(ids), np.uint8) & 0xC0) != 0x80
        char = np.cumsum(begins) - 1
        return char[np.concatenate([[0], end[:-1]])], char[end - 1] + 1


_LOADED: dict[str, ByteBpe] = {}


def _loaded(lines: bytes, pattern: str) -> ByteBpe:
    key = hashlib.sha256(lines + pattern.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = ByteBpe(read_ranks(lines), pattern)
    return _LOADED[key]


def encode_decode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                  with_ids: bool = True) -> DataFrame:
    """One row per input row: id, n_tokens, ids_sha256 (of the decimal ids, joined by commas),
    decoded_sha256 (of the decoded bytes) and, with ``with_ids``, ids (array of int), starts
    and ends (arrays of int: the characters of the text that each token covers) and decoded
    (string).

    A null or empty text has no tokens: hashes of nothing, empty arrays. Texts of any length
    are encoded whole. Ids are passed through, null or repeated, so repeated rows stay
    repeated; ties between merges go to the left. Other columns are ignored, whatever their
    names; an empty table gives an empty result.
    """
    with open(vocabulary, "rb") as file:
        lines = docs.sparkSession.sparkContext.broadcast(file.read())
    schema = f"`{id_col}` {dict(docs.dtypes)[id_col]}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        schema += ", ids array<int>, starts array<int>, ends array<int>, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(lines.value, pattern)
        decimal = [str(i) for i in range(len(bpe.offset) - 1)]
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                piece = batch.slice(at, TEXTS)
                found = bpe.encode_batch([t or "" for t in piece.column(1).to_pylist()])
                back = [bpe.decode(ids) for ids in found]
                numbers = [np.frombuffer(ids, "<u4").astype(np.int32) for ids in found]
                columns = [
                    piece.column(0), pa.array(map(len, numbers), pa.int64()),
                    pa.array([hashlib.sha256(",".join([decimal[i] for i in n.tolist()]).encode()).hexdigest()
                              for n in numbers], pa.string()),
                    pa.array([hashlib.sha256(b).hexdigest() for b in back], pa.string())]
                names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    spans = [bpe.spans(ids) for ids in found]
                    columns += [pa.array(numbers, pa.list_(pa.int32())),
                                pa.array([s.astype(np.int32) for s, _ in spans], pa.list_(pa.int32())),
                                pa.array([e.astype(np.int32) for _, e in spans], pa.list_(pa.int32())),
                                pa.array([b.decode("utf-8", "surrogatepass") for b in back], pa.string())]
                    names += ["ids", "starts", "ends", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return in_batches(docs.select(F.col(id_col), F.col(text_col).cast("string"))).mapInArrow(run, schema)


def decode(rows: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded binary) from rows of ids: the bytes of all tokens, which are UTF-8 again
    only where the ids are those of a whole text. Null ids give null; an id that the
    vocabulary does not have is an error."""
    with open(vocabulary, "rb") as file:
        lines = rows.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(lines.value, "")
        for batch in batches:
            back = [None if ids is None else bpe.decode(np.array(ids, "<u4").tobytes())
                    for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(back, pa.binary())], [id_col, "decoded"])

    return in_batches(rows.select(F.col(id_col), F.col(ids_col))).mapInArrow(
        run, f"`{id_col}` {dict(rows.dtypes)[id_col]}, decoded binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                         public_tokenizers.PATTERN, with_ids=False)
