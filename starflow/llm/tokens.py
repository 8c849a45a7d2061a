"""Token ids of whole texts by the ``tokenizers`` library, with a cache of words.

Both vocabularies used here cut a text into pieces before any merge, and no
piece crosses a single space or newline between two words. A text is therefore
cut there, each distinct word is encoded once per Python worker, and the ids
are put together again. A text where that cut is not safe (white space beside
white space, in the byte-level vocabulary) is encoded in one call.
"""

from __future__ import annotations

import re
from array import array

#: Words kept per worker and kind (about 250 bytes each); the cache starts anew beyond that.
CACHE_WORDS = 600_000
#: Letters of words that need no more than the merges: plain Latin ones.
_LATIN = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyzÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
_PLAIN = re.compile(f"[{_LATIN}]+")
_END = ",.!?;:"


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for 256 and up."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _NotSafe(Exception):
    """The text cannot be cut at its white space."""


class _Words(dict):
    """Ids (little-endian 32-bit bytes) by word; ``lead`` is the space that stands before it, if that counts."""

    def __init__(self, owner: Encoder, lead: str):
        super().__init__()
        self.owner, self.lead = owner, lead

    def __missing__(self, word: str) -> bytes:
        own = self.owner
        if not word:
            if own.kind == "words":
                return b""
            raise _NotSafe
        if "\n" in word:
            head, _, tail = word.partition("\n")
            return self[head] + own.newline + own.bare[tail]
        if len(word) > 1 and word[-1] in _END and word[-2] in _LATIN:
            ids = self[word[:-1]] + own.bare[word[-1]]  # letters and signs never share a piece
        elif _PLAIN.fullmatch(word):
            text = word.lower() if own.kind == "words" else self.lead + word
            mapped = text.encode().decode("latin-1").translate(own.letters)
            ids = array("I", [t.id for t in own.model.tokenize(mapped)]).tobytes()
        elif own.kind == "bytes" and word.split() != [word]:
            raise _NotSafe
        else:
            ids = own.whole(self.lead + word)
        if len(word) <= 64:
            if len(self) >= own.cache_words:
                self.clear()
            self[word] = ids
        return ids


class Encoder:
    """Encodes whole texts with one vocabulary file."""

    def __init__(self, name: str, cache_words: int = CACHE_WORDS):
        import json

        import public_tokenizers
        from tokenizers import Tokenizer
        path = public_tokenizers.path(name) if "/" not in name else name
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        pre = rules.get("pre_tokenizer") or {}
        byte_level = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        lower = {"type": "Lowercase"} in (rules.get("normalizer") or {}).get("normalizers", [])
        word_level = rules["model"].get("end_of_word_suffix") == "</w>" and lower
        self.kind = "bytes" if byte_level and not rules.get("normalizer") else "words" if word_level else "whole"
        self.model = self.tokenizer.model
        self.cache_words = cache_words
        self.letters = _byte_letters()
        self.bare = _Words(self, "")
        self.spaced = _Words(self, " ") if self.kind == "bytes" else self.bare
        self.newline = self.whole("\n") if self.kind == "bytes" else b""

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit values; null has none."""
        if not text:
            return b""
        if self.kind == "whole":
            return self.whole(text)
        first, *others = text.split(" ")
        try:
            return self.bare[first] + b"".join(map(self.spaced.__getitem__, others))
        except _NotSafe:
            return self.whole(text)


_ENCODERS: dict[str, Encoder] = {}


def encoder(name: str, cache_words: int = CACHE_WORDS) -> Encoder:
    """The worker's encoder for a vocabulary file (a name in the public set, or a path all workers see)."""
    if name not in _ENCODERS:
        _ENCODERS[name] = Encoder(name, cache_words)
    return _ENCODERS[name]
