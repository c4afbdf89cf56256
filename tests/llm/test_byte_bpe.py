"""Byte-level BPE against the tiktoken library, and round trips."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from helpers import SF, empty_docs, odd_docs

from panelkit.llm import byte_bpe
from panelkit.llm.common import table

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = byte_bpe.read_ranks(open(PATH, "rb").read())
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def own():
    return byte_bpe.ByteBpe(RANKS, public_tokenizers.PATTERN)


def ids(own, texts):
    return [list(memoryview(b).cast("I")) for b in own.encode_batch(texts)]


def test_random_texts_and_overlapping_tokens(own):
    rng = random.Random(7)
    kinds = ["ab", "aaaa", "abcde -=", "\n\t  \r", "éüñ日本🎉", "0123", "____", "hahaha", "erse", "anai", "'stlm ", "о го"]
    texts = ["".join(rng.choice(rng.choice(kinds)) for _ in range(rng.randint(0, 60))) for _ in range(8_000)]
    cuts = [(t[:k], t[k:]) for t in RANKS for k in range(1, len(t)) if t[:k] in RANKS and t[k:] in RANKS]
    overlaps, often = own.order_matters(cuts)
    assert b"erere" in overlaps and len(overlaps) > 100 and len(often) > 1_000
    tied = sorted(overlaps) + rng.sample(sorted(often), 400)
    words = [t.decode() for t in tied if t.isascii()]
    texts += [rng.choice(words)[:rng.randint(0, 3)] + w * rng.randint(1, 3) + rng.choice(words) for w in words * 20]
    texts += ["", "\x00", "İ \x85 x", "a" * 100_000, " " * 5_000 + "b", "日本" * 20_000]
    assert ids(own, texts) == [LIBRARY.encode_ordinary(t) for t in texts]
    for text, found in zip(texts, own.encode_batch(texts)):
        assert own.decode(found) == text.encode()


def test_plain_merges_are_the_same(own):
    rng = random.Random(9)
    for _ in range(3_000):
        piece = bytes(rng.choice(b"aehinrst -") for _ in range(rng.randint(1, 30)))
        assert own.merge(piece) == LIBRARY._core_bpe.encode_single_piece(piece), piece


def test_every_code_point(own):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or c % 41 == 0)]
    texts = [f"a{c}1{c} {c}  {c}.{c}\n" for c in points]
    for at in range(0, len(texts), 4_096):
        part = texts[at:at + 4_096]
        assert ids(own, part) == [LIBRARY.encode_ordinary(t) for t in part]


def test_offsets_cover_split_characters(own):
    text = "naïve 日本語 🎉 xé 𓀀𒀀"
    found = own.encode_batch([text])[0]
    starts, ends = own.spans(found)
    data = text.encode()
    at = 0
    for token, start, end in zip(memoryview(found).cast("I"), starts, ends):
        part = own.decode(int(token).to_bytes(4, "little"))
        whole = text[start:end].encode()
        assert part in whole and len(whole) <= len(part) + 6
        assert data[at:at + len(part)] == part
        at += len(part)
    assert starts[0] == 0 and ends[-1] == len(text)
    assert any(s1 == s2 for s1, s2 in zip(starts, starts[1:]))       # one character in two tokens


def test_cache_stays_bounded(own, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_PIECES", 50)
    texts = [" ".join(f"q{i}z{j}" for j in range(20)) for i in range(30)]
    for text in texts:
        assert ids(own, [text, "x" * 1_000]) == [LIBRARY.encode_ordinary(t) for t in (text, "x" * 1_000)]
        assert len(own._cache) <= 100 and "x" * 1_000 not in own._cache


def test_query_against_the_library(spark):
    rows = {r.doc_id: r.text or "" for r in table(spark, SF, "documents").collect()}
    got = {r.doc_id: r for r in byte_bpe.query(spark, SF).collect()}
    assert got.keys() == rows.keys()
    for i, text in rows.items():
        want = LIBRARY.encode_ordinary(text)
        assert got[i].n_tokens == len(want)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_odd_rows_and_round_trip(spark):
    docs = odd_docs(spark)
    out = byte_bpe.encode_decode(docs, PATH, public_tokenizers.PATTERN)
    texts = {(r.doc_id, r.text) for r in docs.collect()}
    got = out.collect()
    assert len(got) == 11 and {(r.doc_id, r.decoded or "") for r in got} == {(i, t or "") for i, t in texts}
    nothing = hashlib.sha256(b"").hexdigest()
    assert all(r.ids_sha256 == nothing and r.ids == [] for r in got if not r.n_tokens)
    assert all(len(r.ids) == len(r.starts) == len(r.ends) == r.n_tokens for r in got)
    back = byte_bpe.decode(out.drop("decoded"), PATH).collect()
    assert {(r.doc_id, bytes(r.decoded).decode()) for r in back} == {(i, t or "") for i, t in texts}
    assert byte_bpe.encode_decode(empty_docs(spark), PATH, public_tokenizers.PATTERN).count() == 0
