"""Token ids of a byte-level tokenizer file, for the packing operators.

Texts are cut at single spaces between other characters, where the tokenizer always cuts too; the
pieces' ids are kept per worker, in two generations of bounded bytes, so a text costs one lookup a
piece. New pieces are encoded from the file's own vocabulary by tiktoken, whose merges by rank are
those of the file if its ids follow its merges; that is checked, and else, and for characters whose
classes differ between Unicode versions, the tokenizers library does it. A text that holds the string of a
special token goes to that library whole.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array

import numpy as np

from lychgate.llm.bpe import byte_characters
from lychgate.llm.common import BEYOND_LATIN, CACHE_BYTES, CACHE_KEY, held

_OTHER_SPACE = re.compile(r"[^\S \n]")
_SAFE = re.compile(r"(?<=\S) (?=\S)")
_BLOCK = 50_000


def _has_runs(text: str) -> bool:
    return "  " in text or "\n " in text or " \n" in text or bool(_OTHER_SPACE.search(text))


def by_rank(file: str):
    """tiktoken's encoder of one piece from a tokenizer file, or None if its ids are not ranks."""
    import public_tokenizers
    import tiktoken

    with open(file, encoding="utf-8") as f:
        model = json.load(f)["model"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [model["vocab"].get(a + b) for a, b in pairs]
    if made != list(range(256, 256 + len(made))):
        return None
    byte = {c: b for b, c in enumerate(byte_characters())}
    ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if i < 256 + len(made)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class ByteBpe:
    def __init__(self, file: str, cache: int = CACHE_BYTES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(file)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.ordinary = by_rank(file)
        self.half, self.used, self.known, self.old = cache // 2, 0, {}, {}

    def _raw(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of new pieces, a piece standing for itself after a space; all but long ones are known afterwards."""
        if self.used > self.half:
            self.old, self.known, self.used = self.known, {}, 0
        rest, new = [], {}
        known, old, ordinary = self.known, self.old, self.ordinary
        for p in {p for p in pieces if p not in known}:
            if p in old:
                new[p] = old[p]
            elif ordinary is None or not p.isascii() and BEYOND_LATIN.search(p):
                rest.append(p)
            else:
                new[p] = array("I", ordinary(" " + p)).tobytes()
        for p, e in zip(rest, self.library.encode_batch_fast([f" {p}" for p in rest], add_special_tokens=False), strict=True):
            new[p] = np.array(e.ids, "<u4").tobytes()
        kept = {p: x for p, x in new.items() if len(p) <= CACHE_KEY}
        known.update(kept)
        self.used += sum(130 + sys.getsizeof(p) + len(x) for p, x in kept.items())
        return new

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if any(s in text for s in self.special):
            return self._raw(text)
        pieces = _SAFE.split(text) if _has_runs(text) else text.split(" ")
        out = [self._raw(pieces[0])]
        for at in range(1, len(pieces), _BLOCK):
            block = pieces[at : at + _BLOCK]
            try:
                out.append(b"".join(map(self.known.__getitem__, block)))
            except KeyError:
                new, known = self._learn(block), self.known
                out.append(b"".join([new[p] if p in new else known[p] for p in block]))
        return b"".join(out)


def byte_bpe(file: str) -> ByteBpe:
    return held(("byte_bpe", file), lambda: ByteBpe(file))
