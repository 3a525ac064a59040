"""Encoders against the tokenizers library; decoding; packing without loss."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lychgate.llm import bpe, packing, token_output
from lychgate.llm.tokens import byte_bpe
from tests.llm.conftest import TEXTS

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "a\x1cb\x85c", "İstanbul ΣΑΣ ﬁ", "don't I'LL 123 ½ x²", "<|endoftext|> a<|startoftext|>b <|END", "aaaa" * 700, "\r\n\t x  y   z ", "\x00\x01 z", "a​b c　d", "...!!" * 50,
    "a\n b", "a \nb", "  lead", "trail  ", "x\xa0 y",
]


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(WORD)


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(BYTE)


@pytest.mark.parametrize("text", [*(t for t in TEXTS if t is not None), *ODD])
def test_word_encoder(word_library, text):
    ids = word_library.encode(text, add_special_tokens=False).ids
    own = bpe.word_bpe(WORD)
    assert own.encode(text) == ids
    decoded = word_library.decode(ids, skip_special_tokens=False)
    assert own.decode(ids) == decoded
    digest = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
    assert own.digest(text) == digest


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abeinorst'!1 é", max_size=60))
def test_encoders_on_any_text(text):
    w, b = Tokenizer.from_file(WORD) if not hasattr(test_encoders_on_any_text, "w") else test_encoders_on_any_text.w, None
    test_encoders_on_any_text.w = w
    assert bpe.word_bpe(WORD).encode(text) == w.encode(text, add_special_tokens=False).ids
    b = getattr(test_encoders_on_any_text, "b", None) or Tokenizer.from_file(BYTE)
    test_encoders_on_any_text.b = b
    assert np.frombuffer(byte_bpe(BYTE).encode(text), "<u4").tolist() == b.encode(text, add_special_tokens=False).ids


def test_small_merges_against_plain_merging():
    merges = [("a", "b"), ("b", "c"), ("ab", "c"), ("c", "a"), ("ca", "b"), ("a", "a"), ("aa", "b")]
    vocab = {t: i for i, t in enumerate(["a", "b", "c", *dict.fromkeys(x + y for x, y in merges)])}
    encoder = bpe.BacktrackingEncoder(vocab, merges, None)
    rank = {m: r for r, m in enumerate(merges)}

    def plain(word):
        parts = list(word)
        while True:
            pairs = [(rank[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in rank]
            if not pairs:
                return [vocab[p] for p in parts]
            r, _ = min(pairs)
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and rank.get((parts[i], parts[i + 1])) == r:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out

    rng = random.Random(3)
    for _ in range(2000):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 14)))
        assert encoder.encode(word) == plain(word)


@pytest.mark.parametrize("text", [*(t for t in TEXTS if t is not None), *ODD])
def test_byte_encoder(byte_library, text):
    assert np.frombuffer(byte_bpe(BYTE).encode(text), "<u4").tolist() == byte_library.encode(text, add_special_tokens=False).ids


def test_encode_table(spark, make):
    rows = bpe.encode_table(make(list(enumerate(TEXTS))), WORD).orderBy("doc_id").collect()
    assert [len(r["ids"]) for r in rows[:4]] == [0, 0, 0, 1] and len(rows) == len(TEXTS)
    assert bpe.digest_table(make([]), WORD).count() == 0


def test_shortest_pack_first():
    rng = random.Random(1)
    histogram = {rng.randint(1, 1024): rng.randint(1, 500) for _ in range(300)}
    patterns = packing.shortest_pack_first(histogram)
    used = {}
    for count, lengths in patterns:
        assert sum(lengths) <= 1024
        for n in lengths:
            used[n] = used.get(n, 0) + count
    assert used == histogram and packing.shortest_pack_first({}) == []
    # Equal short pieces share packs.
    assert sum(c for c, _ in packing.shortest_pack_first({300: 900})) == 300


def checked_packing(rows, texts, length=1024):
    tokens = {i: byte_bpe(BYTE).encode(t or "") + b"\0\0\0\0" for i, t in texts}
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append(r)
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    assert set(by_sequence) == set(range(len(by_sequence)))
    for i, parts in by_doc.items():
        at = 0
        for r in sorted(parts, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(tokens[i]) // 4
            assert r["ids_crc32"] == zlib.crc32(tokens[i][4 * at : 4 * (at + r["length"])])
            at += r["length"]
        assert at == len(tokens[i]) // 4
    assert set(by_doc) == set(tokens)


def test_pack(spark, make):
    texts = [*enumerate(TEXTS), *((10 + i, "same words again " * 100) for i in range(40)), (99, "long text here " * 3000)]
    checked_packing(packing.pack(make(texts), BYTE).collect(), texts)
    assert packing.pack(make([]), BYTE).count() == 0


def test_pack_gathers_the_ids(spark, make):
    texts = [(1, "alpha beta " * 900), (2, "gamma"), (3, None)]
    docs = make(texts)
    packed = packing.pack(docs, BYTE)
    rows = packing.gather_sequences(packed, docs, BYTE).collect()
    total = sum(len(byte_bpe(BYTE).encode(t or "")) // 4 + 1 for _, t in texts)
    assert sum(len(r["ids"]) for r in rows) == total and max(len(r["ids"]) for r in rows) <= 1024


def test_room_tree():
    rng = random.Random(2)
    tree, rooms = token_output.RoomTree(100), []
    for _ in range(3000):
        n = rng.randint(1, 100)
        best = min((r for r in rooms if r >= n), default=-1)
        assert tree.least(n) == best
        if best >= 0 and rng.random() < 0.6:
            tree.take(best)
            rooms.remove(best)
        else:
            r = rng.randint(1, 100)
            tree.put(r, None)
            rooms.append(r)


def test_token_rows(spark, make):
    texts = [*enumerate(TEXTS), (7, "many words follow " * 4000), (8, "x"), (8, "x")]
    rows = token_output.token_rows(make(texts), BYTE).collect()
    seen = {}
    for r in rows:
        ids, positions = np.frombuffer(r["ids"], "<u4"), np.frombuffer(r["positions"], "<u4")
        assert len(ids) == len(positions) == token_output.CAPACITY and r["cu_seqlens"][-1] == r["n_tokens"]
        for i, start, a, b in zip(r["doc_ids"], r["starts"], r["cu_seqlens"], r["cu_seqlens"][1:]):
            assert positions[a:b].tolist() == list(range(b - a))
            seen.setdefault(i, []).append((start, ids[a:b].tobytes()))
        assert not ids[r["n_tokens"] :].any()
    for i, t in texts:
        whole = byte_bpe(BYTE).encode(t or "") + b"\0\0\0\0"
        assert b"".join(p for _, p in sorted(seen[i])) == whole * (2 if i == 8 else 1)
    assert token_output.as_matrix(rows).shape == (len(rows), token_output.CAPACITY)
    assert token_output.token_rows(make([]), BYTE).count() == 0
    assert len({r["row_id"] for r in rows}) == len(rows)
