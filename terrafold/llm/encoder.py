"""Token ids of whole texts by a public tokenizer, with a cache of words.

Both tokenizers split a text into pieces before any merge is applied, and no
piece crosses certain blanks: the byte-level one never joins what stands on the
two sides of a single space between two other characters, the word-level one
drops white space altogether. So a text is cut there, every distinct unit is
encoded once by the tokenizers library, and a text's ids are its units' ids in
order. Texts for which a cut might not be safe are encoded as a whole.
"""

from __future__ import annotations

import re

import numpy as np

from .common import held_by

#: Letters for which one piece is one word, in composed form, with plain case.
_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
_PLAIN = re.compile(rf"([{_LETTERS}]+)([.,;:!?]*)\Z")
_TWO_BLANKS, _ODD_BLANKS = re.compile(r"\s\s"), re.compile("[\x1c-\x1f\x85]")
_ODD_BLANK = re.compile("[\x1c-\x1f]")
_ODD_SPECIAL = re.compile(r"<\|")
_MOST = 1_500_000  # cached units of one worker, unless told otherwise: bounds its memory


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + hidden.index(b)) for b in range(256)]


class Encoder(dict):
    """unit -> its ids as little-endian unsigned 16-bit integers in bytes."""

    def __init__(self, path: str, kind: str, most: int = _MOST):
        from tokenizers import Tokenizer

        super().__init__()
        self.kind, self.most, self.tokenizer = kind, most, Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.letters = "".join(byte_letters())
        self.pieces: dict[str, bytes] = {}
        self.spaced = _Spaced(self)
        self.size = self.tokenizer.get_vocab_size()
        if self.size > 1 << 16:
            raise ValueError("more than 65536 ids")

    def _piece(self, piece: str) -> bytes:
        got = self.pieces.get(piece)
        if got is None:
            mapped = piece.encode().decode("latin-1").translate(self.letters)
            got = np.array([t.id for t in self.model.tokenize(mapped)], "<u2").tobytes()
            if len(self.pieces) < self.most:
                self.pieces[piece] = got
        return got

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def unit(self, unit: str) -> bytes:
        space = unit[:1] == " "
        found = _PLAIN.match(unit, 1 if space else 0)
        if not found:
            ids = self._whole(unit)
        else:
            word, marks = found.groups()
            if self.kind == "words":
                ids = self._piece(word.lower())
            else:
                ids = self._piece(" " + word if space else word)
            if marks:
                ids += self._piece(marks)
        return ids

    def __missing__(self, unit: str) -> bytes:
        ids = self.unit(unit)
        if len(self) + len(self.spaced) < self.most:
            self[unit] = ids
        return ids

    def ids(self, text: str) -> bytes:
        """Ids of a whole text, two bytes each."""
        if not text:
            return b""
        if self.kind == "words":
            if _ODD_BLANK.search(text) or not _composed(text):
                return self._whole(text)
            return b"".join([self[w] for w in text.split()])
        if _unsafe(text):
            return self._guarded(text)
        first, *rest = text.split(" ")
        return self[first] + b"".join(map(self.spaced.__getitem__, rest))

    def _guarded(self, text: str) -> bytes:
        """Cut only at single spaces between two characters that are no blanks."""
        units = re.split(r"(?<=\S) (?=\S)", text)
        return self[units[0]] + b"".join([self.spaced[u] for u in units[1:]])


class _Spaced(dict):
    """What follows a single space -> the ids of both; bounded."""

    def __init__(self, enc: "Encoder"):
        super().__init__()
        self.enc = enc

    def __missing__(self, unit: str) -> bytes:
        ids = self.enc.unit(" " + unit)
        if len(self) + len(self.enc) < self.enc.most:
            self[unit] = ids
        return ids


def _unsafe(text: str) -> bool:
    """Two blanks in a row, at either end, or blanks that only Python splits at."""
    return text[0].isspace() or text[-1].isspace() or bool(_TWO_BLANKS.search(text) or _ODD_BLANKS.search(text))


def _composed(text: str) -> bool:
    import unicodedata

    return text.isascii() or unicodedata.is_normalized("NFC", text)


_LOADED: dict[tuple[str, str, int], Encoder] = held_by("encoder", {})


def encoder(path: str, kind: str, most: int = _MOST) -> Encoder:
    """One per worker: workers serve many tasks, and so does the cache."""
    if (path, kind, most) not in _LOADED:
        _LOADED[path, kind, most] = Encoder(path, kind, most)
    return _LOADED[path, kind, most]
