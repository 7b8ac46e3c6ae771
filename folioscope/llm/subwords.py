"""Public tokenizers inside Python workers, with bounded caches by word."""

from __future__ import annotations

import os
import re
from array import array

import numpy as np


def vocabulary_path(name: str) -> str:
    """The place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself, or the next free one from U+0100."""
    plain = [b for b in range(256) if chr(b).isprintable() and chr(b) not in " \xa0\xad"]
    spare = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(spare)) for b in range(256)}


class WordBpe(dict):
    """A lower-casing byte-level BPE tokenizer whose words never cross white space: the ids of each word, computed once and kept.

    Words of plain Latin letters go straight to the merge table, as their normalisation and splitting are known; all others
    go through the whole tokenizer. The caches hold at most ``LIMIT`` words and ``LIMIT_PARTS`` parts and are emptied when full, so memory is
    bounded and results don't depend on them.
    """

    LIMIT, LIMIT_PARTS = 400_000, 800_000
    _shared: dict[str, WordBpe] = {}
    #: Below U+0250 every character is composed already and lower-cases by itself.
    _PLAIN = re.compile(r"[\x21-\x7e\xc0-\xd6\xd8-\xf6\xf8-įĲ-ňŊ-ž]+\Z")
    # The tokenizer's own split of a word (fixed value), for those characters.
    _SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-ſ]+|[0-9]|[^\sa-z\xdf-\xf6\xf8-ſ0-9]+")

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.parts: dict[str, bytes] = {}
        self.to_bytes = str.maketrans({chr(b): c for b, c in byte_characters().items()})

    @classmethod
    def shared(cls, name: str) -> WordBpe:
        """One for each worker process; ``name`` is a file of the public vocabularies or a path."""
        if name not in cls._shared:
            cls._shared[name] = cls(name if os.sep in name else vocabulary_path(name))
        return cls._shared[name]

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.LIMIT:
            self.clear()
        core, tail = (word, "") if word[-1] not in ".,!?" else (word[:-1], word[-1])
        if core.isalpha() and max(core) < "\u0130":  # nearly all words: letters that compose and lower-case by themselves
            got = self._part(core.lower()) + (self._part(tail) if tail else b"")
        elif "<|" in word or not self._PLAIN.match(word):
            got = self.whole(word)
        else:
            got = b"".join(self._part(p) for p in self._SPLIT.findall(word.lower()))
        self[word] = got
        return got

    def _part(self, part: str) -> bytes:
        got = self.parts.get(part)
        if got is None:
            raw = part if part.isascii() else part.encode().decode("latin-1").translate(self.to_bytes)
            got = array("I", [t.id for t in self.merge(raw)]).tobytes()
            if len(self.parts) >= self.LIMIT_PARTS:
                self.parts.clear()
            self.parts[part] = got
        return got

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        get = self.__getitem__
        # Python splits at four control characters that the tokenizer takes as ordinary ones
        return [self.whole(t) if any(c in t for c in "\x1c\x1d\x1e\x1f") else b"".join(map(get, t.split())) for t in texts]
