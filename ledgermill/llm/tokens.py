"""Exact tokenization with a bounded memory of words already encoded.

Both vocabularies split a text into pieces before merging, and no piece reaches over the border
between a word and the white space after it. A text is therefore cut at those borders, each
distinct part is encoded once by the tokenizers library, and the ids are joined. Texts with white
space other than blanks and line feeds are encoded whole when the vocabulary treats it as a token.
"""

from __future__ import annotations

import array
import os
import re

MEMORY_WORDS = 1_200_000
# Marks that end a word. Such a mark never joins the letter or digit before it in one piece.
MARKS = ".,;:!?|*&%$#)"
# Byte-level vocabularies write a byte without a visible sign of its own as a letter from 256 on.
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LETTERS = {byte: 256 + k for k, byte in enumerate(b for b in range(256) if b not in _VISIBLE)}
_BLANK = chr(_BYTE_LETTERS[32])
_PARTS = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_OTHER_SPACE = re.compile(r"[^\S \n]|[\x1c-\x1f\x85]")


class Encoder:
    """Encodes texts to little-endian ids, four bytes each.

    ``memory_words`` bounds the number of parts remembered; a full memory is emptied.
    """

    def __init__(self, path: str, memory_words: int = MEMORY_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.model._resize_cache(0)  # no part is encoded twice while it is remembered
        # A normalizer that drops white space makes blanks separators; else they belong to words.
        self.drops_space = self.tokenizer.normalizer is not None
        self.limit = memory_words
        self.memory: dict[str, bytes | None] = {}

    def _word(self, part: str) -> bytes | None:
        """The ids of a part that is one piece of letters, straight from the merges; else None."""
        word = part[1:] if part[:1] == " " and not self.drops_space else part
        if not word.isalpha() or self.drops_space and not word.isascii():
            return None
        if self.drops_space:
            spelled = part.lower()
        elif part.isascii():
            spelled = word if word is part else _BLANK + word
        else:
            spelled = part.encode().decode("latin-1").translate(_BYTE_LETTERS)
        pieces = self.tokenizer.model.tokenize(spelled)
        return array.array("I", [piece.id for piece in pieces]).tobytes()

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array.array("I", e.ids).tobytes() for e in found]

    def _parts(self, text: str) -> list[str]:
        if self.drops_space:
            return text.replace("\n", " ").split(" ")
        return _PARTS.findall(text)

    def _learn(self, parts: set[str]) -> None:
        memory = self.memory
        cut, fresh = [], set()
        for part in parts:
            stem = part.rstrip(MARKS)
            if len(stem) < len(part) and stem and stem[-1].isalnum():
                marks = part[len(stem) :]
                cut.append((part, stem, marks))
                fresh.add(stem)
                fresh.add(marks)
            else:
                fresh.add(part)
        rest = []
        for part in fresh.difference(memory):
            ids = self._word(part)
            if ids is None:
                rest.append(part)
            else:
                memory[part] = ids
        fresh = rest
        for part, ids in zip(fresh, self._whole(fresh), strict=True):
            memory[part] = ids
        if not self.drops_space:
            for part in fresh:
                if _OTHER_SPACE.search(part):
                    memory[part] = None
        for part, stem, marks in cut:
            head, tail = memory[stem], memory[marks]
            memory[part] = None if head is None or tail is None else head + tail

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, without special tokens."""
        if len(self.memory) > self.limit:
            self.memory.clear()
        split = [self._parts(text) for text in texts]
        new = set().union(*split).difference(self.memory) if split else set()
        if new:
            self._learn(new)
        known = self.memory.__getitem__
        out = []
        for text, parts in zip(texts, split, strict=True):
            try:
                out.append(b"".join(map(known, parts)))
            except TypeError:
                out.append(self._whole([text])[0])
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per vocabulary and Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
