"""Token ids of whole texts by a public tokenizer, piece by piece.

The tokenizers library is exact but slow, and a corpus repeats its words.
A text is cut where the tokenizer itself always cuts, the library encodes
every distinct piece, and a worker remembers a bounded number of pieces.
Latin pieces go straight to the library's BPE model, all others through its
whole chain. The ids equal those of the whole text (tests compare them).
"""

from __future__ import annotations

import codecs
import os
import re
import sys
from array import array
from collections.abc import Callable

import numpy as np
import regex

# A worker forgets its pieces and starts again beyond this many.
CACHED_PIECES = 1_000_000

# The tokenizers' own word patterns (fixed values).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Latin letters and printable signs, without the one letter that becomes
# two in lower case.
_LATIN = "!-~¡-įı-ſ"
_PLAIN = re.compile(f"[{_LATIN}]+")
_PLAIN_SPACED = re.compile(f"[ \n{_LATIN}]+")
_CUT = re.compile(r"(?<=\S)(?= )")


def _byte_letters() -> str:
    """Byte-level BPE writes a byte as a letter: printable Latin-1 bytes as
    themselves, the rest as the letters from U+0100 on, in order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return "".join(chr(b) if b in printable else chr(next(rest)) for b in range(256))


_LETTERS = _byte_letters()


def _as_letters(word: str) -> str:
    return codecs.charmap_decode(word.encode(), "strict", _LETTERS)[0]


class _Blank(Exception):
    """A text has white space before a space: its cut takes more care."""


class _Ids(dict):
    """piece -> id bytes, filled by ``learn``; bounded."""

    def __init__(self, learn: Callable[[str], bytes]):
        self._learn = learn

    def __missing__(self, piece: str) -> bytes:
        ids = self._learn(piece)
        if len(self) >= CACHED_PIECES:
            self.clear()
        self[piece] = ids
        return ids


class PieceEncoder:
    """Ids (16 or 32 bits each, little-endian bytes) of whole texts. This
    class knows no cut and encodes whole texts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self.dtype = np.dtype("<u2" if self._tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self._code = "H" if self.dtype.itemsize == 2 else "I"

    def encode(self, text: str | None) -> bytes:
        """A null text has no ids."""
        return self._whole(text or "")

    def _whole(self, piece: str) -> bytes:
        return self._bytes(self._tokenizer.encode(piece, add_special_tokens=False).ids)

    def _model_ids(self, word: str) -> bytes:
        return self._bytes([t.id for t in self._model.tokenize(_as_letters(word))])

    def _bytes(self, ids: list[int]) -> bytes:
        out = array(self._code, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()


class BlankEncoder(PieceEncoder):
    """For a tokenizer that drops white space and lowers letters: pieces
    are the words between ASCII blanks (``bytes.split`` cuts at these)."""

    def __init__(self, path: str):
        super().__init__(path)
        self._words = regex.compile(WORD_PATTERN)
        self._ids = _Ids(self._learn)

    def _learn(self, piece: bytes) -> bytes:
        if piece.isalpha() and piece.islower():  # ASCII letters
            return self._bytes([t.id for t in self._model.tokenize(piece.decode())])
        text = piece.decode()
        # "<|" may open a special token's name.
        if "<|" in text or not _PLAIN.fullmatch(text):
            return self._whole(text)
        lower = text.lower()
        words = [lower] if lower.isalpha() else self._words.findall(lower)
        if words == [text]:
            return self._model_ids(text)
        return b"".join([self._ids[w.encode()] if w != text else self._model_ids(w)
                         for w in words])

    def encode(self, text: str | None) -> bytes:
        return b"".join(map(self._ids.__getitem__, (text or "").encode().split()))


class SpaceEncoder(PieceEncoder):
    """For a byte-level tokenizer whose words start with their space: cut
    before a space that follows a character other than white space. The
    pieces after a cut are remembered without their space."""

    def __init__(self, path: str):
        super().__init__(path)
        self._words = regex.compile(BYTE_PATTERN)
        self._spaced = _Ids(lambda piece: self._learn(" " + piece, piece))
        self._bare = _Ids(lambda piece: self._learn(piece, piece))

    def _learn(self, piece: str, word: str) -> bytes:
        if word.isalpha():
            if word.isascii() or _PLAIN.fullmatch(word):
                return self._model_ids(piece)
        elif not word or word[-1].isspace():
            raise _Blank
        return self._piece(piece)

    def _piece(self, piece: str) -> bytes:
        if "<|" in piece or not _PLAIN_SPACED.fullmatch(piece):
            return self._whole(piece)
        words = self._words.findall(piece)
        if len(words) == 1:
            return self._model_ids(piece)
        out = []
        for w in words:
            if w.isspace():
                out.append(self._model_ids(w))
            else:
                out.append(self._spaced[w[1:]] if w[0] == " " else self._bare[w])
        return b"".join(out)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        first, *rest = text.split(" ")
        try:
            return self._bare[first] + b"".join(map(self._spaced.__getitem__, rest))
        except _Blank:
            return b"".join([self._spaced[p[1:]] if p[0] == " " and not p[-1].isspace()
                             and not p[1].isspace() else self._piece(p)
                             for p in _CUT.split(text)])


# Tokenizer files whose cuts are known.
KINDS = {"word_bpe_49k.json": BlankEncoder, "byte_bpe_50k.json": SpaceEncoder}


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = KINDS.get(os.path.basename(path), PieceEncoder)(path)
    return _ENCODERS[path]


def forget() -> None:
    """Drop the worker's encoders and their pieces."""
    _ENCODERS.clear()


def public_tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)
