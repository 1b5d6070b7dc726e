"""Ids of whole texts by the tokenizers library.

Most words of a corpus have been seen before, so a worker keeps the ids of whole words and only hands new
ones to the library. Texts are cut where the vocabulary's own pattern always cuts, so the ids are
those of the whole text; texts in which that is not certain are encoded as a whole. Names of special tokens inside a text
give what the library gives, their ids, unless they are asked to be ordinary text.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa

from caremill.llm.words import text_bytes

#: Words that a worker keeps; when there are more it starts afresh between two blocks.
KEPT_WORDS = 1_500_000

_SPACE = np.array([b == 0x20 or 0x09 <= b <= 0x0D for b in range(256)])
# Bytes that begin white space beyond ASCII, and control characters that some patterns take for white space.
_MAYBE_SPACE = np.array([0x1C <= b <= 0x1F or b in (0xC2, 0xE1, 0xE2, 0xE3) for b in range(256)])
_RARE_SPACE = re.compile("[\x1c-\x1f\x85   -     　]")
# Marks that end a word: the pattern cuts between a letter or digit and these (the apostrophe is not one).
_MARKS = b".,;:!?*%$#&"


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if it is printable Latin-1,
    else the next one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


_BYTE_LETTERS = _byte_letters()


class _Kept(dict):
    """The ids of a word as bytes, encoded when first asked for."""

    def __init__(self, encoder: Encoder, before: bytes) -> None:
        self.encoder, self.before = encoder, before

    def __missing__(self, word: bytes) -> bytes:
        encoder, stem = self.encoder, word.rstrip(_MARKS)
        lines = word.split(b"\n") if encoder.spaced else [word]
        if len(lines) > 1 and all(lines):
            # A line end between two words is a piece of its own, and no space stands before the second.
            ids = self[lines[0]] + b"".join(encoder.plain[b"\n"] + encoder.plain[line] for line in lines[1:])
        elif 0 < len(stem) < len(word) and stem[-1:].isalnum():
            ids = self[stem] + encoder.plain[word[len(stem) :]]
        else:
            ids = encoder.word_ids(self.before, word)
        self[word] = ids
        return ids


class Encoder:
    """``spaced``: a byte-level vocabulary, in which a word holds the space before it. Else white space is
    dropped and A-Z are lower-cased by the vocabulary itself. ``names_are_text``: names of special tokens inside a text are
    ordinary text."""

    def __init__(self, path: str, spaced: bool, kept_words: int = KEPT_WORDS, names_are_text: bool = False) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = names_are_text
        added = [] if names_are_text else self.library.get_added_tokens_decoder().values()
        self.names = [token.content.encode() for token in added]
        self.model, self.normalizer = self.library.model, self.library.normalizer
        self.spaced, self.kept_words = spaced, kept_words
        self.clear()

    def clear(self) -> None:
        self.plain, self.after_space = _Kept(self, b""), _Kept(self, b" ")

    def library_ids(self, text: bytes) -> bytes:
        return array("I", self.library.encode(text.decode(), add_special_tokens=False).ids).tobytes()

    def word_ids(self, before: bytes, word: bytes) -> bytes:
        """A word of Latin letters is one piece for the pattern, so the merges can be asked for directly."""
        text = word.decode()
        if not text.isascii() and self.normalizer:
            text = self.normalizer.normalize_str(text)
        if text.isalpha() and max(text) < "\u0250":
            letters = (before + text.encode()).decode("latin-1").translate(_BYTE_LETTERS)
            return array("I", [token.id for token in self.model.tokenize(letters)]).tobytes()
        return self.library_ids(before + word)

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts as uint32, bounds of each); every text is followed by ``end_id``. Null is empty."""
        if len(self.plain) + len(self.after_space) > self.kept_words:
            self.clear()
        data, bounds = text_bytes(texts)
        end = array("I", [end_id]).tobytes()
        raw, plain, after_space = data.tobytes(), self.plain.__getitem__, self.after_space.__getitem__
        whole = self._uncertain(data, bounds) if self.spaced else set()
        whole |= self._naming(raw, bounds)
        encoded = []
        for i, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            text = raw[lo:hi]
            if i in whole:
                ids = self.library_ids(text)
            elif self.spaced:
                first, *rest = text.split(b" ")
                ids = (plain(first) if first else b"") + b"".join(map(after_space, rest))
            else:
                ids = b"".join(map(plain, text.lower().split()))
            encoded.append(ids + end)
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4
        return np.frombuffer(b"".join(encoded), np.uint32), np.concatenate([[0], np.cumsum(sizes)])

    def _naming(self, raw: bytes, bounds: np.ndarray) -> set[int]:
        """Texts in which a special token may be named. The library looks for names before it lower-cases."""
        found, searched = set(), raw if self.spaced else raw.lower()
        for name in self.names:
            at = searched.find(name)
            while at >= 0:
                found.add(int(np.searchsorted(bounds, at, "right")) - 1)
                at = searched.find(name, at + 1)
        return found

    def _uncertain(self, data: np.ndarray, bounds: np.ndarray) -> set[int]:
        """Texts in which a cut before each space might not be the pattern's: a space between other white
        space, or white space beyond ASCII."""
        space = np.concatenate([_SPACE[data], [True]])
        ends = bounds[1:][bounds[1:] > bounds[:-1]] - 1
        after = space[1:].copy()
        after[ends] = True
        before = np.concatenate([[False], space[:-2]]) if len(data) else np.zeros(0, bool)
        starts = bounds[:-1][bounds[1:] > bounds[:-1]]
        before[starts] = False
        at = np.flatnonzero((data == 0x20) & before & after)
        found = set((np.searchsorted(bounds, at, "right") - 1).tolist())
        maybe = set((np.searchsorted(bounds, np.flatnonzero(_MAYBE_SPACE[data]), "right") - 1).tolist())
        for i in maybe - found:
            if _RARE_SPACE.search(data[bounds[i] : bounds[i + 1]].tobytes().decode()):
                found.add(i)
        return found


_ENCODERS: dict[tuple[str, bool, int], Encoder] = {}


def encoder(path: str, spaced: bool, kept_words: int = KEPT_WORDS) -> Encoder:
    """The worker's encoder for a vocabulary file; it is read once in each worker."""
    key = path, spaced, kept_words
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]
