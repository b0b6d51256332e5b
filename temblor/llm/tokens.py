"""Ids of whole texts by the `tokenizers` library, its model asked once per distinct word.

The library's BPE works on each pre-token by itself, so a text's ids are those of its pre-tokens in
a row. Texts are cut at spaces, the pieces' ids are remembered, and the library's model encodes
what was not met yet. Memory is bounded: two generations of remembered words and pieces each.
"""

from __future__ import annotations

import json
import unicodedata
from array import array

GENERATION = 400_000


class _Remembered(dict):
    """Ids by piece, as little-endian unsigned 32-bit bytes; the older half is dropped when full."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.make(piece)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class TextEncoder:
    """Encodes texts like `Tokenizer.from_file(path).encode(text, add_special_tokens=False)`.

    Handles byte-level BPE without a normaliser, and lower-casing BPE that drops white space. The
    vocabulary's added tokens are cut out of the text first, each with its one id, as the library does.
    """

    def __init__(self, path: str, remembered: int = GENERATION):
        import regex
        from tokenizers import Tokenizer

        spec = json.loads(open(path, encoding="utf-8").read())
        self._model = Tokenizer.from_file(path).model
        self._lowers = spec["normalizer"] is not None
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("added tokens are taken as they stand in the text only")
        self._added = {t["content"]: array("I", [t["id"]]).tobytes() for t in spec["added_tokens"]}
        longest_first = sorted(self._added, key=len, reverse=True)
        self._at_added = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")").split
        split = spec["pre_tokenizer"]
        if self._lowers:
            pattern = split["pretokenizers"][0]["pattern"]["Regex"]
        else:
            pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self._cut = regex.compile(pattern).findall
        self._run = regex.compile(r"\s (?:\s|$)").search
        self._bytes = _byte_letters()
        self._words = _Remembered(self._encode_word, remembered)
        self._pieces = _Remembered(self._encode_piece, remembered)

    def _encode_word(self, word: str) -> bytes:
        if word.isascii() and word[1:].isalpha():
            seen = word if word[0] != " " else "\u0120" + word[1:]
        else:
            seen = word.encode("utf-8", "replace").decode("latin-1").translate(self._bytes)
        return array("I", [token.id for token in self._model.tokenize(seen)]).tobytes()

    def _encode_piece(self, piece: str) -> bytes:
        if self._lowers:
            if piece.isascii():
                piece = piece.lower()
            else:  # letter by letter, without a special form at word ends
                piece = "".join(map(str.lower, unicodedata.normalize("NFC", piece)))
            if piece.isalpha():
                return self._words[piece]
            if piece[:-1].isalpha() and piece[-1] in ".,;:!?":
                return self._words[piece[:-1]] + self._words[piece[-1]]
            return self._join(self._cut(piece))
        # A piece that is a word is remembered as such only, not as a word as well.
        if piece.isalpha():
            return self._encode_word(" " + piece)
        if piece[:-1].isalpha() and piece[-1] in ".,;:!?":
            return self._pieces[piece[:-1]] + self._words[piece[-1]]
        return self._join(self._cut(" " + piece))

    def _join(self, words: list[str]) -> bytes:
        return b"".join(map(self._words.__getitem__, words))

    def forget(self) -> None:
        """Free what is remembered, for whatever the worker does next."""
        for remembered in (self._words, self._pieces):
            remembered.clear()
            remembered.older = {}

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if text and any(token in text for token in self._added):
            between = self._at_added(text)
            return b"".join(self._added[cut] if k % 2 else self._plain(cut) for k, cut in enumerate(between))
        return self._plain(text)

    def _plain(self, text: str | None) -> bytes:
        """The ids of a text without added tokens."""
        if not text:
            return b""
        if self._lowers:
            return b"".join(map(self._pieces.__getitem__, text.split(" ")))
        if self._run(text):  # runs of white space with a space inside; their cut needs the whole run
            return self._join(self._cut(text))
        first, *rest = text.split(" ")
        return self._join(self._cut(first)) + b"".join(map(self._pieces.__getitem__, rest))


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}


_ENCODERS: dict[str, TextEncoder] = {}


def encoder(path: str, remembered: int = GENERATION) -> TextEncoder:
    """One encoder per vocabulary and Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path, remembered)
    return _ENCODERS[path]
