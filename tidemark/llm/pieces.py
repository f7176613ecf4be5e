"""The piece table of a SentencePiece model file, and where its pieces can never reach across.

A text is written with one space put in front (the model's dummy prefix) and a literal U+2581 stands for a space, as in
the model's own notation. If no piece holds a space after another character, no piece and so no merge can cross a
boundary between a non-space and a space: every segmentation has a cut there, whatever stands around it. ``stretches``
cuts a text at those boundaries; what is found out about a stretch holds wherever the stretch stands.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache

SPACE = "▁"
STRETCH = re.compile(" *[^ ]+| +")
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # fixed values of the file format


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _number(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value, at
        shift += 7


def _fields(data: bytes) -> Iterator[tuple[int, int, int | bytes]]:
    """(field number, wire type, value) of a protocol-buffer message."""
    at = 0
    while at < len(data):
        key, at = _number(data, at)
        wire = key & 7
        if wire == 0:
            value, at = _number(data, at)
        else:
            if wire == 2:
                size, at = _number(data, at)
            else:
                size = {5: 4, 1: 8}[wire]
            value = data[at:at + size]
            at += size
        yield key >> 3, wire, value


class Pieces:
    """Pieces with scores and kinds, read from a model file; made once per worker by ``pieces``."""

    def __init__(self, path: str) -> None:
        self.text: list[str] = []
        self.score: list[float] = []
        self.kind: list[int] = []
        with open(path, "rb") as file:
            for number, _, value in _fields(file.read()):
                if number == 1:
                    piece = {n: v for n, _, v in _fields(value)}
                    self.text.append(piece[1].decode("utf-8"))
                    self.score.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                    self.kind.append(piece.get(3, NORMAL))
        # Pieces a text can be cut into, by their text with plain spaces.
        self.ids = {
            t.replace(SPACE, " "): i for i, t in enumerate(self.text) if self.kind[i] in (NORMAL, USER)
        }
        self.byte_ids = {int(t[3:5], 16): i for i, t in enumerate(self.text) if self.kind[i] == BYTE}
        self.longest = max(map(len, self.ids), default=1)
        # True if a cut is forced wherever a space follows a non-space.
        self.forced = not any(b == " " != a for t in self.ids for a, b in zip(t, t[1:]))


@lru_cache(maxsize=4)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def normal_form(text: str) -> str:
    """The text with plain spaces and the dummy prefix; empty stays empty."""
    return " " + text.replace(SPACE, " ") if text else ""


def stretches(form: str) -> list[str]:
    return STRETCH.findall(form)
