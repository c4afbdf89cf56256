"""BPE encoding by backtracking over longest matches, and decoding by an offset table.

An Aho-Corasick automaton over the vocabulary finds, for every position of a word, the
longest token that starts there. The encoder walks left to right with these tokens. A
token may follow another only if no merge would have crossed their border (the pair
table); where it may not, the encoder tries the next shorter token that is a prefix, and
when none is left it marks the position as a dead end and takes the previous token back.
A position is given up at most once, so the work is linear in the word, and the sequence
found is the one that applying the merges in rank order gives.

The vocabulary file (``tokenizers`` JSON: BPE with an end-of-word mark, NFC, lower case,
white space dropped, byte-level alphabet) is read once on the driver and broadcast; its
size is that of the file. Each worker builds the tables once.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import groupby

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.common import in_batches, table

#: Words whose encoding a worker remembers; then it forgets all and starts again.
CACHE_WORDS = 400_000

_END = "\ue000"    # stands for the end-of-word mark, one character of the word


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    chars = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [chars[b] for b in range(256)]


def _char_class(*kinds: str, below: int = 0x110000) -> str:
    """The characters of the given Unicode categories (by first letters) as ranges."""
    wanted = (c for c in range(below) if unicodedata.category(chr(c)).startswith(kinds))
    runs = [[c for _, c in run] for _, run in groupby(enumerate(wanted), lambda x: x[1] - x[0])]
    return "".join(f"{re.escape(chr(r[0]))}-{re.escape(chr(r[-1]))}" for r in runs)


class WordBpe:
    """Tables of one vocabulary file, with an exact encoder and decoder."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        model = data["model"]
        mark = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self._special_split = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")
        split = next(p for p in data["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        pattern = split["pattern"]["Regex"]
        self._word_any = self._words(pattern, 0x110000)
        self._word_low = self._words(pattern, 0x250)     # small classes match much faster
        self._high = re.compile("[^\x00-\u024f]")
        # Characters younger than Python's tables: the library's own tables split such texts.
        self._young = re.compile(f"[{_char_class('Cn')}]")
        self._library = None
        self._spec = spec

        def inner(token: str) -> str:
            return token[:-len(mark)] + _END if token.endswith(mark) else token
        self.ids = {inner(t): i for t, i in vocab.items()}
        self.pair: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for merge in model["merges"]:
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            if whole in self.parts or self.parts and whole < max(left, right):
                raise ValueError("each merge must make a token of its own, in rank order")
            self.pair[left, right] = whole
            self.parts[whole] = (left, right)
        self.automaton = ahocorasick.Automaton()
        for token, i in self.ids.items():
            self.automaton.add_word(token, (len(token), i))
        self.automaton.make_automaton()
        self.length = {i: len(t) for t, i in self.ids.items()}
        self.shorter = {i: next((self.ids[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.ids), -1)
                        for t, i in self.ids.items()}
        self._bytes = dict(enumerate(byte_alphabet()))
        self._compatible: dict[tuple[int, int], bool] = {}
        # Decoding: the printed tokens one after the other, and where each begins.
        printed = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in [*vocab.items(), *self.special.items()]:
            printed[i] = token.encode() + b" "
        self.blob = np.frombuffer(b"".join(printed), np.uint8)
        self.offset = np.concatenate([[0], np.cumsum([len(t) for t in printed])]).astype(np.int64)
        self._cache: dict[str, bytes] = {}

    @staticmethod
    def _words(pattern: str, below: int) -> re.Pattern:
        white = r"\t-\r \x85\xa0" + _char_class("Z", below=below)
        return re.compile(pattern.replace(r"\p{L}", _char_class("L", below=below))
                          .replace(r"\p{N}", _char_class("N", below=below)).replace(r"\s", white))

    def compatible(self, left: int, right: int) -> bool:
        """True if no merge applies across the border of the two tokens.

        Undo the merges of both sides from the latest on: the pair that meets at the border
        at some time must not form a token earlier than the side that was built next.
        """
        key = (left, right)
        known = self._compatible.get(key)
        if known is not None:
            return known
        bound = len(self.offset)
        while True:
            merged = self.pair.get((left, right))
            if merged is not None and merged < bound:
                answer = False
                break
            if left > right:              # the left token was completed last
                bound = left
                parts = self.parts.get(left)
                if parts is None:
                    answer = True
                    break
                left = parts[1]
            else:
                bound = right + 1         # on a tie the left of equal merges goes first
                parts = self.parts.get(right)
                if parts is None:
                    answer = True
                    break
                right = parts[0]
        if len(self._compatible) > 1_000_000:
            self._compatible.clear()
        self._compatible[key] = answer
        return answer

    def encode_symbols(self, word: str) -> list[int]:
        """Ids of a word of the byte alphabet that ends with the end-of-word character."""
        n = len(word)
        longest = [-1] * n
        size = [0] * n
        for end, (k, token) in self.automaton.iter(word):
            start = end - k + 1
            if k > size[start]:
                size[start], longest[start] = k, token
        dead = [False] * (n + 1)
        dead[n - 1] = True                # the mark never stands alone
        out: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            follows = at + self.length[token]
            if not dead[follows] and (not out or self.compatible(out[-1], token)):
                out.append(token)
                at = follows
                token = longest[at] if at < n else -1
                continue
            token = self.shorter[token]
            while token < 0:
                dead[at] = True
                token = out.pop()
                at -= self.length[token]
                token = self.shorter[token]
        return out

    def _encode_word(self, word: str) -> bytes:
        symbols = "".join(map(self._bytes.__getitem__, word.encode())) + _END
        found = np.array(self.encode_symbols(symbols), "<u4").tobytes()
        if len(self._cache) >= CACHE_WORDS:
            self._cache.clear()
        if len(word) <= 64:
            self._cache[word] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if not self.special or not self._special_split.search(text):
            return self._encode_plain(text)
        out, at = [], 0
        for m in self._special_split.finditer(text):
            out += [self._encode_plain(text[at:m.start()]), self.special[m[0]].to_bytes(4, "little")]
            at = m.end()
        return b"".join([*out, self._encode_plain(text[at:])])

    def _encode_plain(self, text: str) -> bytes:
        high = not text.isascii() and self._high.search(text)
        if high and self._young.search(text):
            return self._encode_young(text)
        # Lower case character by character, as the vocabulary's library does: a capital
        # sigma has one lower form wherever it stands.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        cache, slow = self._cache.get, self._encode_word
        # Lower case may lead out of the low characters or into them.
        words = (self._word_any if not text.isascii() and self._high.search(text) else self._word_low).findall(text)
        return b"".join([cache(w) or slow(w) for w in words])

    def _encode_young(self, text: str) -> bytes:
        """Normalise and split by the library, whose character tables are newer; encode here."""
        if self._library is None:
            from tokenizers import Tokenizer
            self._library = Tokenizer.from_str(self._spec)
        text = self._library.normalizer.normalize_str(text)
        words = self._library.pre_tokenizer.pre_tokenize_str(text)
        return np.array([i for w, _ in words for i in self.encode_symbols(w + _END)], "<u4").tobytes()

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 of the decoded text: the printed tokens, joined by spaces."""
        token = np.frombuffer(ids, "<u4").astype(np.int64)
        if not len(token):
            return b""
        start, size = self.offset[token], self.offset[token + 1] - self.offset[token]
        first = np.cumsum(size) - size
        where = np.arange(int(size.sum())) + np.repeat(start - first, size)
        return self.blob[where[:-1]].tobytes()


_LOADED: dict[str, WordBpe] = {}


def _loaded(spec: str) -> WordBpe:
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = WordBpe(spec)
    return _LOADED[key]


def encode_decode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                  with_ids: bool = True) -> DataFrame:
    """One row per input row: id, n_tokens, ids_sha256, decoded_sha256 and, with
    ``with_ids``, ids (array of int) and decoded (string).

    A null text counts as empty: no tokens, hashes of nothing. Ids are passed through,
    null or repeated; other columns are ignored. Texts are encoded whole, one at a time.
    """
    with open(vocabulary, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())
    kind = dict(docs.dtypes)[id_col]
    schema = f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        schema += ", ids array<int>, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(spec.value)
        for batch in batches:
            # A small piece at a time: the outputs are as long as the texts.
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                count, ids_sha, text_sha, ids, decoded = [], [], [], [], []
                for text in piece.column(1):
                    found = bpe.encode(text.as_py() or "")
                    back = bpe.decode(found)
                    count.append(len(found) // 4)
                    ids_sha.append(hashlib.sha256(found).hexdigest())
                    text_sha.append(hashlib.sha256(back).hexdigest())
                    if with_ids:
                        ids.append(np.frombuffer(found, "<u4").astype(np.int32))
                        decoded.append(back.decode())
                columns = [piece.column(0), pa.array(count, pa.int64()), pa.array(ids_sha, pa.string()),
                           pa.array(text_sha, pa.string())]
                names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns += [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return in_batches(docs.select(F.col(id_col), F.col(text_col).cast("string"))).mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                         with_ids=False)
