"""Exact byte-pair encoding by backtracking, and decoding through an offset table.

A tokenizer file gives tokens and ranked merges. A token sequence is what the ranked merges
produce exactly if every two neighbours are compatible: undoing merges on both sides of their
border from the latest on, no pair that meets at the border has a merge that would have come first.
The encoder finds every token inside a word with an Aho-Corasick automaton, takes the longest at
each place, and steps back to the next shorter one where the pair does not fit or no token follows;
places found to be dead ends are marked, so a word takes time linear in its length.

Defined results: a null text counts as empty and has no tokens; words of any length are encoded
whole; strings of the file's special tokens become those tokens, as the tokenizers library does.
Words are cached per worker in two generations of bounded bytes. Rows are taken one by one, so a repeated doc_id gives
a row each; an empty table gives an empty one; columns other than the id and the text are not read.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterable

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lychgate.llm.common import BEYOND_LATIN, TwoGenerations, docs_of, held, map_batches

#: Stands for the end of a word inside automaton keys; a private-use character.
_END = "\ue000"
_BASE = -1
#: Bytes of words and pieces that a worker keeps, about; new ones cost many steps each.
WORD_BYTES = 256 << 20


class BacktrackingEncoder:
    """Exact merges of one pre-split word.

    merges: pairs by rank; vocab: token string to id; suffix: end-of-word mark, or None.
    """

    def __init__(self, vocab: dict[str, int], merges: Iterable[tuple[str, str]], suffix: str | None):
        key = (lambda t: t[: -len(suffix)] + _END if t.endswith(suffix) and t != suffix else t) if suffix else (lambda t: t)
        self.end = _END if suffix else ""
        keys = {key(t): i for t, i in vocab.items()}
        size = max(vocab.values()) + 1
        #: Rank of the merge that makes a token, and its two parts; single symbols have none.
        self.rank, self.left, self.right = [_BASE] * size, [-1] * size, [-1] * size
        self.merge: dict[int, int] = {}
        for r, (a, b) in enumerate(merges):
            made = keys.get(key(a + b))
            if made is None:
                continue
            i, j = keys[key(a)], keys[key(b)]
            self.merge.setdefault(i << 20 | j, r)
            if self.rank[made] == _BASE:
                self.rank[made], self.left[made], self.right[made] = r, i, j
        self.fits: dict[int, bool] = {}
        symbol = lambda k: len(k) == 1 or len(k) == 2 and k[1:] == _END
        usable = {k: i for k, i in keys.items() if symbol(k) or self.rank[i] != _BASE and self._made(i)}
        self.ids = usable
        self.length = [0] * size
        self.automaton = ahocorasick.Automaton()
        for k, i in usable.items():
            self.length[i] = len(k)
            self.automaton.add_word(k, i)
        self.automaton.make_automaton()
        #: The next shorter token that begins a token.
        self.shorter = [-1] * size
        for k, i in usable.items():
            for n in range(len(k) - 1, 0, -1):
                if (s := usable.get(k[:n])) is not None:
                    self.shorter[i] = s
                    break

    def _made(self, token: int) -> bool:
        """Whether the merges turn the token's own characters into it."""
        return self._compatible(self.left[token], self.right[token], self.rank[token])

    def _compatible(self, a: int, b: int, limit: int = 1 << 40) -> bool:
        """Whether no merge across the border of a and b comes before what is merged on its sides.
        limit: merges of this rank or later do not count."""
        rank, left, right, merge = self.rank, self.left, self.right, self.merge
        while True:
            r = merge.get(a << 20 | b)
            if r is not None and r < limit:
                return False
            # Undo the later of the two merges; on the way back in time only earlier merges could interfere.
            ra, rb = rank[a], rank[b]
            if ra == _BASE and rb == _BASE:
                return True
            if ra > rb:
                limit, a = min(limit, ra), right[a]
            else:
                # The left of two equal merges is applied first, so one of the same rank to the left still comes before.
                limit, b = min(limit, rb + 1), left[b]

    def encode(self, word: str) -> list[int]:
        """Ids of a word given in the vocabulary's characters, without its end mark."""
        text = word + self.end
        whole = self.ids.get(text)
        if whole is not None:
            return [whole]
        n = len(text)
        length, shorter, fits = self.length, self.shorter, self.fits
        longest = [-1] * n
        for end, token in self.automaton.iter(text):
            start = end + 1 - length[token]
            if longest[start] == -1 or length[token] > length[longest[start]]:
                longest[start] = token
        open_at = bytearray(b"\1") * (n + 1)
        out: list[int] = []
        pos, token = 0, longest[0]
        while True:
            stepped = False
            while token != -1:
                to = pos + length[token]
                if open_at[to]:
                    if not out:
                        stepped = True
                    else:
                        pair = out[-1] << 20 | token
                        ok = fits.get(pair)
                        if ok is None:
                            if len(fits) > 100_000:
                                fits.clear()
                            ok = fits[pair] = self._compatible(out[-1], token)
                        stepped = ok
                    if stepped:
                        break
                token = shorter[token]
            if stepped:
                out.append(token)
                pos = to
                if pos == n:
                    return out
                token = longest[pos]
            else:
                open_at[pos] = 0
                if not out:
                    raise ValueError("characters outside the vocabulary")
                token = out.pop()
                pos -= length[token]
                token = shorter[token]


def byte_characters() -> list[str]:
    """The printable character of each byte in byte-level vocabularies: printable Latin-1 stands for
    itself, the rest are numbered from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    chars, extra = [""] * 256, 0
    for b in range(256):
        if b in plain:
            chars[b] = chr(b)
        else:
            chars[b] = chr(256 + extra)
            extra += 1
    return chars


class OffsetTable:
    """Decoding: token strings in one buffer with the offsets where each begins."""

    def __init__(self, tokens: dict[int, str], between: str):
        size = max(tokens) + 1
        parts = [(tokens.get(i, "") + between).encode() for i in range(size)]
        self.buffer = b"".join(parts)
        self.offsets = [0] * (size + 1)
        for i, p in enumerate(parts):
            self.offsets[i + 1] = self.offsets[i] + len(p)
        self.cut = len(between.encode())

    def decode(self, ids: Iterable[int]) -> bytes:
        buffer, at = self.buffer, self.offsets
        out = b"".join([buffer[at[i] : at[i + 1]] for i in ids])
        return out[: len(out) - self.cut] if self.cut else out


class WordBpe:
    """The tokenizer of a word-level file: normal form C, white space squeezed, lower case, words by
    pattern, byte characters, merges with an end-of-word mark; without a decoder, decoding joins
    token strings by one space."""

    def __init__(self, file: str, cache: int = WORD_BYTES):
        from tokenizers import Tokenizer

        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.encoder = BacktrackingEncoder(model["vocab"], map(_pair, model["merges"]), model["end_of_word_suffix"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.chars = byte_characters()
        self.library = Tokenizer.from_file(file)  # its normaliser and word split, for rare scripts only
        self.table = OffsetTable({i: t for t, i in (model["vocab"] | self.special).items()}, " ")
        self.word = TwoGenerations(self._word, cache // 3, lambda ids: 28 * len(ids))
        #: By space-delimited piece: decimal ids, their number, decoded text.
        self.piece = TwoGenerations(self._piece, cache - cache // 3, lambda p: 100 + len(p[0]) + len(p[2]))

    def _bytes_word(self, word: str) -> list[int]:
        chars = self.chars
        return self.encoder.encode(word if word.isascii() and word.isprintable() else "".join([chars[b] for b in word.encode()]))

    def _word(self, word: str) -> tuple[int, ...]:
        return tuple(self._bytes_word(word))

    def _piece_ids(self, piece: str) -> list[int]:
        return [i for w in self.words.findall(unicodedata.normalize("NFC", piece).lower()) for i in self.word[w]]

    def _piece(self, piece: str) -> tuple[bytes, int, bytes]:
        ids = self._piece_ids(piece)
        return " ".join(map(str, ids)).encode(), len(ids), self.table.decode(ids)

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text."""
        if "<|" in text:
            parts = self.split_special.split(text)
            return [i for k, p in enumerate(parts) for i in ([self.special[p]] if k % 2 else self._plain(p))]
        return self._plain(text)

    def _plain(self, text: str) -> list[int]:
        if BEYOND_LATIN.search(text) or _odd_space(text):
            text = self.library.normalizer.normalize_str(text)
            back = self.library.pre_tokenizer.pre_tokenize_str(text)
            return [i for w, _ in back for i in self.encoder.encode(w)]
        return [i for p in text.split() for i in self._piece_ids(p)]

    def decode(self, ids: Iterable[int]) -> str:
        return self.table.decode(ids).decode()

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the decimal ids, SHA-256 of the decoded text."""
        if "<|" in text or BEYOND_LATIN.search(text) or _odd_space(text):
            ids = self.encode(text)
            n, decimal, decoded = len(ids), " ".join(map(str, ids)).encode(), self.table.decode(ids)
        else:
            parts = [*map(self.piece.__getitem__, text.split())]
            if not all(p[1] for p in parts):
                parts = [p for p in parts if p[1]]
            n = sum([p[1] for p in parts])
            decimal, decoded = b" ".join([p[0] for p in parts]), b" ".join([p[2] for p in parts])
        return n, hashlib.sha256(decimal).hexdigest(), hashlib.sha256(decoded).hexdigest()


_ODD = regex.compile("[\x1c-\x1f\x85]")


def _odd_space(text: str) -> bool:
    """Characters that Python takes as white space and other libraries do not, or the other way."""
    return bool(_ODD.search(text))


def _pair(merge) -> tuple[str, str]:
    a, b = merge.split(" ") if isinstance(merge, str) else merge
    return a, b


def word_bpe(file: str) -> WordBpe:
    return held(("word_bpe", file), lambda: WordBpe(file))


def encode_table(docs: DataFrame, file: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids and decoded text of every document: (id_col, ids array<int>, decoded string)."""

    def batch(cols):
        bpe = word_bpe(file)
        ids = [bpe.encode(t or "") for t in cols[text]]
        yield {id_col: cols[id_col], "ids": ids, "decoded": [bpe.decode(x) for x in ids]}

    return map_batches(docs.select(F.col(id_col).cast("long"), text), batch, f"`{id_col}` long, ids array<int>, decoded string")


def digest_table(docs: DataFrame, file: str) -> DataFrame:
    """What encode_table gives, as digests; ids are made word by word from the worker's cache."""

    def batch(cols):
        bpe = word_bpe(file)
        rows = [bpe.digest(t or "") for t in cols["text"]]
        yield {"doc_id": cols["doc_id"], "n_tokens": [r[0] for r in rows], "ids_sha256": [r[1] for r in rows], "decoded_sha256": [r[2] for r in rows]}

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), batch, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op1_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digest_table(docs_of(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
