"""Token ids of whole texts with a public byte-level BPE vocabulary.

The reference for the ids is ``tokenizers`` on the file named by the caller. Such a vocabulary splits
a text before every single space, so the ids of a text are those of its words in a row, and words
repeat: each Python worker keeps the ids of the words it met first (a bounded table). Words outside
the Latin blocks, and texts with special tokens, go to ``tokenizers`` itself.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import cached_property

KEPT_WORDS = 300_000
# The split pattern of this vocabulary (fixed value).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# A space between white space joins it in one token, so such texts are not cut at spaces.
JOINED_SPACE = re.compile(r"\s (?:\s|\Z)|\A (?:\s|\Z)")
LATIN_END = "ɐ"

_ENCODERS: dict[str, Encoder] = {}


def _byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in such vocabulary files: printable ones for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    def __init__(self, path: str):
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        alphabet = _byte_alphabet()
        ranks = {
            bytes(alphabet[c] for c in token): rank
            for token, rank in spec["model"]["vocab"].items()
            if token not in self.special and all(c in alphabet for c in token)
        }
        self.latin = tiktoken.Encoding("latin", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.kept: dict[str, bytes] = {}

    @cached_property
    def whole(self):
        """The reference itself; most texts never need it, so it is loaded on first use."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _ids(self, text: str) -> bytes:
        """Without the table; letters beyond the Latin blocks go to ``tokenizers``, whose letter tables count."""
        if text.isascii() or max(text, default="") < LATIN_END:
            return array("I", self.latin.encode_ordinary(text)).tobytes()
        return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str) -> bytes:
        if not word or word[0].isspace():
            self.joined = True
            return self._ids(" " + word)
        out = self._ids(" " + word)
        if len(self.kept) < KEPT_WORDS and len(word) <= 64:
            self.kept[word] = out
        return out

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if any(s in text for s in self.special):
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        first, *rest = text.split(" ")
        self.joined = False
        get, word = self.kept.get, self._word
        parts = [get(w) or word(w) for w in rest]
        if self.joined and JOINED_SPACE.search(text):
            return self._ids(text)
        return self._ids(first) + b"".join(parts)


def encoder(path: str) -> Encoder:
    """One encoder for each worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
