"""Secret scan: fixed patterns, and a guess-cost estimate for values in credential context.

The base patterns find assignments to credential names, access keys and long hex runs. The
method adds values that stand in a credential context (an assignment to a wider list of
names, or the password of a URL) and are hard to guess: dynamic programming finds the
cheapest way to write a value as a row of dictionary words, dates, repeats, keyboard walks
and brute-force characters; the cost is the log10 of the guesses that an attacker who knows
this way needs. Placeholders are cheap, keys and strong passwords are not.

The dictionary is a short list of well-known placeholders and the words of public tokenizer
vocabularies, whose order is that of their frequency; a word's rank is its cost. It does not
depend on the table, so a text has the same spans wherever it stands, and no secret of the
corpus becomes a word by being copied.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.byte_bpe import read_ranks
from panelkit.llm.common import in_batches, table

# Patterns and least lengths of the base secrets.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16

#: Names that make a credential context, beyond the base ones.
CONTEXT = (r"""(?<![A-Za-z0-9])(?:pass(?:word|wd|phrase)?|pwd|secret|token|credentials?|auth(?:orization)?"""
           r"""|(?:api|access|private|secret|auth)[_-]?key)["']?\x20*[:=]\x20*["']?([^\s"'<>,;(){}]+)""")
URL = r"[a-z][a-z0-9+.-]*://[^\s/:@]*:([^\s/@]+)@"
#: Guesses (log10) from which a value counts as a secret, and its least length.
HARD = 10.0
VALUE_LEAST = 8
#: Letters of a word at least, characters of a repeated unit at most, keys of a walk at least.
WORD_LEAST, UNIT_MOST, WALK_LEAST = 3, 8, 3
#: Values that stand for a secret in examples; known to everyone, so in any table.
PLACEHOLDERS = ("password", "changeme", "secret", "example", "placeholder", "default", "change", "your", "here",
                "token", "test", "sample", "dummy", "none", "null", "undefined", "redacted", "hidden", "admin",
                "user", "value", "insert", "replace", "credentials", "passphrase", "letmein", "welcome")

KINDS = ("assign", "access", "hex", "guess")

_ASSIGN = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(ACCESS)
_HEX = re.compile(f"[0-9a-f]{{{HEX_LEAST},}}")     # a run that is long enough, as HEX finds it
_CONTEXT = re.compile(CONTEXT, re.IGNORECASE | re.ASCII)
_URL = re.compile(URL, re.IGNORECASE | re.ASCII)
_ASSIGN_HINTS = ("passw", "secret", "token", "api")
_CONTEXT_HINTS = ("pass", "pwd", "secret", "token", "credential", "auth", "key")
#: Year, month and day; day, month and year; a year.
_DATES = (re.compile(r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])"),
          re.compile(r"(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\1(?:19|20)\d\d"),
          re.compile(r"(?:19|20)\d\d"))
_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
#: Letters that a digit or sign often stands for.
_LEET = str.maketrans("013457@$", "oieastas")


def _neighbours() -> dict[str, str]:
    """Keys next to each key: left, right, and the two it touches in the rows around it."""
    near = {}
    for r, row in enumerate(_ROWS):
        for c, key in enumerate(row):
            around = [(r, c - 1), (r, c + 1), (r - 1, c), (r - 1, c + 1), (r + 1, c - 1), (r + 1, c)]
            near[key] = "".join(_ROWS[y][x] for y, x in around if 0 <= y < len(_ROWS) and 0 <= x < len(_ROWS[y]))
    return near


_NEAR = _neighbours()


def _brute(char: str) -> float:
    """log10 of the alphabet of a character."""
    if char.isdigit():
        return 1.0
    if char.isascii() and char.isalpha():
        return math.log10(26)
    return math.log10(33) if char.isascii() else 2.0


class Guesses:
    """Guess costs under one dictionary (word -> rank)."""

    def __init__(self, ranks: dict[str, int]):
        self.ranks = ranks
        self.words = ahocorasick.Automaton()
        for word, rank in ranks.items():
            self.words.add_word(word, (len(word), math.log10(rank)))
        self.words.make_automaton()

    def cost(self, value: str) -> float:
        """log10 of the guesses for a value, by its cheapest segmentation; 0 for no value.

        Segments are brute-force characters in a row; words (also capitalised, or with digits
        for letters, for twice the guesses); dates (365 days of 200 years, or 200 years); a
        unit of up to 8 characters, repeated any number of times up to 3 characters or more
        (that number is a guess, too: up to as often as the value has room); walks of 3 or
        more neighbouring keys. Each segment after the first costs a further factor of 2 for
        where it begins. Segments of any length are tried, in time linear in the value: the
        cost of a repeat or walk that goes on follows from its cost one step before.
        """
        n = len(value)
        if not n:
            return 0.0
        lower = value.lower() if len(value.lower()) == n else value
        again, step = math.log10(2), math.log10(2.5)
        guess = [_brute(c) for c in value]
        offers: dict[int, list[tuple[int, float]]] = {}          # words and dates, by where they end
        if len(self.words):
            plain = lower.translate(_LEET)
            for last, (size, cost) in self.words.iter(plain):
                start = last + 1 - size
                twist = value[start:last + 1] != plain[start:last + 1]
                offers.setdefault(last + 1, []).append((start, cost + (again if twist else 0)))
        for i in range(n):
            if value[i].isdigit():
                for date in _DATES:
                    if m := date.match(value, i):
                        years = math.log10(200 * (365 if m.end() - i > 4 else 1))
                        offers.setdefault(m.end(), []).append((i, years))
        begin = [0.0] + [math.inf] * n       # cost up to here, with the factor of a next segment
        brute, walk, near = math.inf, math.inf, 1
        run = [0] * (UNIT_MOST + 1)          # characters up to here that equal those a unit before
        held = [[math.inf] * max(unit, 1) for unit in range(UNIT_MOST + 1)]     # of repeats, by place modulo unit
        for i in range(1, n + 1):
            char = value[i - 1]
            brute = min(brute, begin[i - 1]) + guess[i - 1]
            best = min([begin[start] + cost for start, cost in offers.get(i, ())], default=math.inf)
            for unit in range(1, min(UNIT_MOST, i - 1) + 1):
                if char != value[i - 1 - unit]:
                    run[unit] = 0
                    held[unit][i % unit] = math.inf
                    continue
                run[unit] += 1
                before = held[unit][i % unit]
                if run[unit] < unit:
                    held[unit][i % unit] = math.inf
                    continue
                first = i - 2 * unit
                cost = begin[first] + sum(guess[first:first + unit]) + math.log10(max(2, n // unit))
                held[unit][i % unit] = min(cost, before)
                best = min(best, held[unit][i % unit] if unit > 1 else before)
            near = near + 1 if i > 1 and lower[i - 1] in _NEAR.get(lower[i - 2], "") else 1
            if near >= WALK_LEAST:
                start = begin[i - WALK_LEAST] + math.log10(len(_NEAR)) + (WALK_LEAST - 1) * step
                walk = min(start, walk + step)
                best = min(best, walk)
            else:
                walk = math.inf
            begin[i] = min(brute, best) + again
        return begin[n] - again


def guess_cost(value: str, ranks: dict[str, int]) -> float:
    """:meth:`Guesses.cost` under a dictionary."""
    return Guesses(ranks).cost(value)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base secrets, in order of start, then kind."""
    found = []
    low = text.lower()
    if any(hint in low for hint in _ASSIGN_HINTS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def context_spans(text: str) -> set[tuple[int, int]]:
    """(start, end) of values in credential context."""
    low = text.lower()
    values = set()
    if any(hint in low for hint in _CONTEXT_HINTS):
        values |= {m.span(1) for m in _CONTEXT.finditer(text)}
    if "://" in text:
        values |= {m.span(1) for m in _URL.finditer(text)}
    return values


def guess_spans(text: str, guesses: Guesses) -> list[tuple[int, int, int]]:
    """(start, kind, end) of values in credential context that are hard to guess."""
    return sorted((a, 3, b) for a, b in context_spans(text)
                  if b - a >= VALUE_LEAST and guesses.cost(text[a:b]) >= HARD)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def dictionary(word_vocabulary: str, byte_vocabulary: str) -> dict[str, int]:
    """Ranks of the placeholders, then of the words of 3 letters or more that are tokens of
    a vocabulary of words (JSON, with an end-of-word mark) or, after a blank, of a rank file
    of bytes; a word's place is its better one of the two. Read on the driver; the size is
    bounded by that of the files."""
    with open(word_vocabulary, encoding="utf-8") as file:
        model = json.load(file)["model"]
    mark = model["end_of_word_suffix"]
    lists = [[t[:-len(mark)] for t in sorted(model["vocab"], key=model["vocab"].get) if t.endswith(mark) and t.isascii()]]
    with open(byte_vocabulary, "rb") as file:
        ranks = read_ranks(file.read())
    lists.append([t[1:].decode("utf-8", "replace") for t in sorted(ranks, key=ranks.get) if t.startswith(b" ")])
    place: dict[str, int] = {}
    for words in lists:
        words = [w for w in words if w.isalpha() and len(w) >= WORD_LEAST and len(w.lower()) == len(w)]
        for k, word in enumerate(dict.fromkeys(w.lower() for w in words)):
            place[word] = min(place.get(word, k), k)
    ordered = dict.fromkeys(PLACEHOLDERS) | dict.fromkeys(sorted(place, key=lambda w: (place[w], w)))
    return {word: k for k, word in enumerate(ordered, 1)}


_LOADED: dict[str, Guesses] = {}


def _loaded(ranks: dict[str, int]) -> Guesses:
    """The tables of a dictionary, built once per worker."""
    key = hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Guesses(ranks)
    return _LOADED[key]


def scan(docs: DataFrame, ranks: dict[str, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_assign, n_access, n_hex, base_sha256, spans, n_guess.

    Spans are ``kind:start:end`` (code points, end exclusive) in order of start, then kind.
    Null and empty texts have none; ids pass through, null or repeated; repeated rows give
    repeated rows; other columns are ignored; an empty table gives an empty result. Texts
    and values of any length are read whole. Of equally cheap segmentations the cost is one.
    """
    held = docs.sparkSession.sparkContext.broadcast(ranks)
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        guesses = _loaded(held.value)
        for batch in batches:
            counts: list[list[int]] = [[], [], [], []]
            digest, spans = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                base = base_spans(text)
                hard = guess_spans(text, guesses)
                for k in range(3):
                    counts[k].append(sum(s[1] == k for s in base))
                counts[3].append(len(hard))
                digest.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                spans.append(_joined(sorted(base + hard)))
            columns = [pa.array(c, pa.int64()) for c in counts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns[:3], pa.array(digest, pa.string()), pa.array(spans, pa.string()), columns[3]],
                [id_col, "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess"])

    return in_batches(docs.select(id_col, F.col(text_col).cast("string"))).mapInArrow(
        run, f"`{id_col}` {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, "
             "spans string, n_guess bigint")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    ranks = dictionary(public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return scan(table(spark, sf_dir, "documents"), ranks)
