"""SentencePiece model files: the protobuf's pieces and settings, and safe cuts.

Only the wire format is read here (varints and length-prefixed fields); the
field numbers below are those of the public ``sentencepiece_model.proto``.
"""

from __future__ import annotations

import re
import struct
from dataclasses import dataclass, field
from functools import lru_cache

#: fixed values of the public format
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
SPACE = "▁"
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        at += 1
        value |= (b & 127) << shift
        if b < 128:
            return value, at
        shift += 7


def _fields(data: bytes):
    """(number, value, raw bytes) of each field of one message."""
    at = 0
    while at < len(data):
        start = at
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at:at + size], at + size
        else:
            size = 4 if kind == 5 else 8
            value, at = data[at:at + size], at + size
        yield tag >> 3, value, data[start:at]


def _message(number: int, body: bytes) -> bytes:
    size, head = len(body), bytearray()
    while size > 127:
        head.append(size & 127 | 128)
        size >>= 7
    return bytes([number << 3 | 2, *head, size]) + body


@dataclass(frozen=True)
class Model:
    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    charsmap: bytes = field(default=b"", repr=False)

    @property
    def unk_id(self) -> int:
        return self.kinds.index(UNKNOWN)

    def text_pieces(self):
        """(id, piece, score) of the pieces that text can match."""
        return [(i, p, s) for i, (p, s, k) in enumerate(zip(self.pieces, self.scores, self.kinds))
                if k in (NORMAL, USER_DEFINED, UNUSED)]

    def byte_ids(self) -> dict[int, int]:
        return {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds))
                if k == BYTE}


@lru_cache(maxsize=4)
def parse(data: bytes) -> Model:
    pieces, scores, kinds, settings = [], [], [], {}
    for number, value, _ in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v, _ in _fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            pieces.append(piece), scores.append(score), kinds.append(kind)
        elif number == 2:
            names = {3: "model_type", 35: "byte_fallback"}
            settings |= {names[n]: v for n, v, _ in _fields(value) if n in names}
        elif number == 3:
            names = {2: "charsmap", 3: "add_dummy_prefix", 4: "remove_extra_whitespaces"}
            settings |= {names[n]: v for n, v, _ in _fields(value) if n in names}
    flags = ("byte_fallback", "add_dummy_prefix", "remove_extra_whitespaces")
    settings |= {k: bool(settings[k]) for k in flags if k in settings}
    return Model(tuple(pieces), tuple(scores), tuple(kinds), **settings)


def without_normalizer(data: bytes, model_type: int | None = None) -> bytes:
    """The model file with an identity normaliser and no added prefix, so that the
    library takes segments of a normalised text as they are; optionally read as
    another model type."""
    out = b""
    for number, value, raw in _fields(data):
        if number == 2 and model_type is not None:
            raw = _message(2, value + bytes([3 << 3, model_type]))  # the last value counts
        if number != 3:
            out += raw
    spec = _message(1, b"identity") + bytes([3 << 3, 0, 4 << 3, 0, 5 << 3, 1])
    return out + _message(3, spec)


def normalized(model: Model, text: str) -> str:
    """The text as the model sees it: white space rules, marker and prefix."""
    if model.charsmap:
        text = _charsmap(model.charsmap).normalize_str(text)
    if model.remove_extra_whitespaces:
        text = re.sub(" {2,}", " ", text.strip(" "))
    if text and model.add_dummy_prefix:
        text = SPACE + text
    return text.replace(" ", SPACE)


@lru_cache(maxsize=4)
def _charsmap(charsmap: bytes):
    from tokenizers import normalizers
    return normalizers.Precompiled(charsmap)


def segmenter(model: Model):
    """A function that cuts a normalised text where no piece can cross.

    No piece has a marker after another character, so a marker run starts a new
    segment; a line feed that is part of no piece is a segment of its own. Best
    paths and merges of the whole text are then those of its segments. A model
    with such pieces gets the whole text as one segment.
    """
    pieces = [p for _, p, _ in model.text_pieces()]
    if any(SPACE in p.lstrip(SPACE) for p in pieces):
        return lambda text: [text] if text else []
    if any("\n" in p for p in pieces):
        return re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall
    return re.compile(f"{SPACE}+[^{SPACE}\n]*|\n|[^{SPACE}\n]+").findall


class Cache:
    """Results by segment in two halves: when the younger one is full it takes the place of
    the older one, from which segments that come again move over. So a task's memory stays
    under ``limit`` characters and one call's segments, and what is frequent stays."""

    def __init__(self, limit: int = 10_000_000):
        self.limit, self.held = limit, 0
        self.young: dict = {}
        self.old: dict = {}

    def missing(self, segments) -> tuple[list[str], bool]:
        """The distinct segments to compute, in order (the others are in ``young`` then); were
        some forgotten before?"""
        turned = self.held > self.limit // 2
        if turned:
            self.old, self.young, self.held = self.young, {}, 0
        young, old, new = self.young, self.old, []
        for s in dict.fromkeys(segments):
            if s in young:
                continue
            if s in old:
                young[s] = old[s]
            else:
                new.append(s)
            self.held += len(s) + 8
        return new, turned

    def __contains__(self, segment: str) -> bool:
        return segment in self.young or segment in self.old

    def __getitem__(self, segment: str):
        return self.young[segment]

    def __setitem__(self, segment: str, value) -> None:
        self.young[segment] = value
