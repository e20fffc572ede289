"""XXH64 digests of the words of many texts at once, in numpy.

Words are runs of bytes other than ASCII white space, with A-Z lowered. Words of one length are
digested together; from 32 bytes on the library digests them one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(x)
    for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)
_BLANK = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Words from here on are digested one by one.
LONG = 32
#: Bytes of texts that are digested in one go; a longer text is a piece of its own.
PIECE_BYTES = 1_000_000


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return x << np.uint64(bits) | x >> np.uint64(64 - bits)


def _lanes(data: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """The little-endian numbers of `width` bytes at `starts`."""
    rows = np.lib.stride_tricks.sliding_window_view(data, width)[starts]
    return rows.view(f"<u{width}").ravel().astype(np.uint64)


def _digests(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """XXH64 with seed 0 of words of one length under LONG."""
    out, rest = np.full(len(starts), _P5 + np.uint64(length)), length
    while rest >= 8:
        out ^= _turned(_lanes(data, starts, 8) * _P2, 31) * _P1
        out = _turned(out, 27) * _P1 + _P4
        starts, rest = starts + 8, rest - 8
    if rest >= 4:
        out ^= _lanes(data, starts, 4) * _P1
        out = _turned(out, 23) * _P2 + _P3
        starts, rest = starts + 4, rest - 4
    for at in range(rest):
        out ^= data[starts + at].astype(np.uint64) * _P5
        out = _turned(out, 11) * _P1
    out ^= out >> np.uint64(33)
    out *= _P2
    out ^= out >> np.uint64(29)
    out *= _P3
    return out ^ out >> np.uint64(32)


def pieces_of(texts: pa.Array | pa.ChunkedArray) -> Iterator[pa.Array]:
    """Texts in a row, as binary without nulls, in pieces of bounded size."""
    for chunk in texts.chunks if isinstance(texts, pa.ChunkedArray) else [texts]:
        if not len(chunk):
            continue
        chunk = chunk.cast(pa.binary() if pa.types.is_string(chunk.type) else pa.large_binary()).cast(pa.large_binary())
        chunk = chunk.fill_null(b"")
        offsets = _offsets(chunk)
        begin = 0
        while begin < len(chunk):
            end = int(np.searchsorted(offsets, offsets[begin] + PIECE_BYTES, side="right")) - 1
            end = min(max(end, begin + 1), len(chunk))
            yield chunk.slice(begin, end - begin)
            begin = end


def _offsets(texts: pa.Array) -> np.ndarray:
    return np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(digests of all words of large binary texts in a row, number of words of each text)."""
    import xxhash

    offsets = _offsets(texts)
    low, high = int(offsets[0]), int(offsets[-1])
    offsets = offsets - low
    if low == high:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    data = _LOWER[np.frombuffer(texts.buffers()[2], np.uint8)[low:high]]
    inside = np.zeros(len(data) + 2, np.bool_)
    inside[1:-1] = ~_BLANK[data]
    first, last = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    # A text's first and last byte border on other texts.
    own = offsets[:-1][offsets[1:] > offsets[:-1]]
    first[own] = inside[1:-1][own]
    last[own[1:] - 1] = inside[1:-1][own[1:] - 1]
    starts = np.flatnonzero(first)
    lengths = np.flatnonzero(last) + 1 - starts
    edges = np.searchsorted(starts, offsets)
    short = np.minimum(lengths, LONG).astype(np.uint8)
    order = np.argsort(short, kind="stable")
    ends = np.cumsum(np.bincount(short, minlength=LONG + 1))
    out = np.empty(len(starts), np.uint64)
    for length in range(1, LONG):
        places = order[ends[length - 1] : ends[length]]
        if len(places):
            out[places] = _digests(data, starts[places], length)
    for place in order[ends[LONG - 1] :]:
        start = starts[place]
        out[place] = xxhash.xxh64_intdigest(data[start : start + lengths[place]].tobytes())
    return out, np.diff(edges)
