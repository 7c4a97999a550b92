"""Token ids of texts, by a public tokenizer and a bounded cache of pieces.

The tokenizer lower-cases a text and cuts it into runs of letters, digits and
runs of anything else; each piece has its ids whatever is beside it. Pieces
repeat, so each is encoded once and then looked up. Texts with other than the
usual letters go through the tokenizer itself.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np

VOCABULARY = "word_bpe_49k.json"
# Bytes of a worker's cache, and of an entry besides its key and value.
CACHED = 48 << 20
ENTRY = 110


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where this machine has the vocabulary; workers ask for themselves."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_alphabet() -> list[str]:
    """The printable stand-in of every byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    moved = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(moved)) for b in range(256)]


# Letters below U+0180 and ASCII: texts of these alone are cut up and lower-cased as the
# tokenizer does it, where letters are letters, digits are 0-9 and white space is ASCII's.
_ODD = re.compile("[^\x00-\x7fÀ-ÖØ-öø-įı-ſ]").search
_CUT = re.compile("'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ſ]+|[0-9]|[^\t-\r 0-9a-zß-öø-ſ]+").findall


class Pieces(dict):
    """Ids of a piece of text that the tokenizer treats alone, kept within some bytes; starts afresh when full."""

    def __init__(self, make, budget: int = CACHED, longest: int = 64):
        self.make, self.budget, self.longest, self.left = make, budget, longest, budget

    def __missing__(self, piece: str) -> bytes:
        ids = self.make(piece)
        if len(piece) <= self.longest:
            self.left -= len(piece) + len(ids) + ENTRY
            if self.left < 0:
                self.drop()
            self[piece] = ids
        return ids

    def drop(self) -> None:
        self.clear()
        self.left = self.budget


class Encoder:
    """``ids(text)`` as little-endian unsigned 32-bit bytes."""

    def __init__(self, vocabulary: str = VOCABULARY, cached: int = CACHED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(vocabulary if os.sep in vocabulary else vocabulary_path(vocabulary))
        self._model = self._tokenizer.model
        self._alphabet = dict(enumerate(_byte_alphabet()))
        self._pieces = Pieces(self._piece, cached)

    def _piece(self, piece: str) -> bytes:
        plain = piece.isascii() and piece.isprintable()
        ids = [t.id for t in self._model.tokenize(piece if plain else piece.encode().decode("latin-1").translate(self._alphabet))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _rest(self, text: str) -> bytes:
        ids = self._tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def ids(self, text: str) -> bytes:
        if "<|" in text:
            return self._rest(text)
        if _ODD(text):
            # ASCII white space is a border of pieces in any text.
            words = [w.decode("utf-8", "replace") for w in text.encode("utf-8", "replace").split()]
            return b"".join(self._rest(w) if _ODD(w) else b"".join(map(self._pieces.__getitem__, _CUT(w.lower()))) for w in words)
        return b"".join(map(self._pieces.__getitem__, _CUT(text.lower())))

    def drop(self) -> None:
        self._pieces.drop()


_encoders: dict[str, Encoder] = {}


@contextmanager
def encoder(vocabulary: str) -> Iterator[Encoder]:
    """The worker's encoder of a vocabulary, by name or path; what it has cached goes when the task is done."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    try:
        yield _encoders[vocabulary]
    finally:
        _encoders[vocabulary].drop()


class RankEncoder:
    """Ids of the byte-level vocabulary ``name``, which is given as a tokenizer file and as ranks.

    The ranks give the ids of the tokenizer file for all text between special
    tokens; ``special`` texts are cut out first, as the tokenizer does.
    """

    def __init__(self, name: str):
        import base64
        import json

        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        with open(public_tokenizers.path(f"{name}.json"), encoding="utf-8") as file:
            self.special = {added["content"]: added["id"] for added in json.load(file)["added_tokens"]}
        self._encoding = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=self.special)

    def ids(self, text: str) -> np.ndarray:
        return self._encoding.encode_to_numpy(text, allowed_special="all")
