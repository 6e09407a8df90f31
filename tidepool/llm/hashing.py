"""Vectorised 64-bit hashes of words, spans and sliding windows (arithmetic is modulo 2**64)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
_R = U(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_R_INVERSE = U(pow(int(_R), -1, 1 << 64))
_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first ``n`` powers of the base of span hashes, or of its inverse."""
    have = _POWERS.get(inverse)
    if have is None or len(have) < n:
        base = np.full(max(n, 1 << 16), _R_INVERSE if inverse else _R, dtype=U)
        base[0] = U(1)
        _POWERS[inverse] = have = np.multiply.accumulate(base)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


#: A hash of each byte.
BYTE_HASHES = mix(np.arange(1, 257, dtype=U))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all texts, offsets of the texts among them); NULL is empty."""
    texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def blank(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start and end of each word in the bytes, offsets of the texts among the words)."""
    solid = ~blank(data)
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.r_[False, solid[:-1]] if len(solid) else solid
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.r_[solid[1:], False] if len(solid) else solid
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word's bytes."""
    if not len(starts):
        return np.zeros(0, dtype=U)
    place = np.arange(len(data)) - np.repeat(np.r_[0, starts], np.diff(np.r_[0, starts, len(data)]))
    value = (data.astype(U) + U(1)) * powers(int(place.max()) + 1)[place]
    value[blank(data)] = 0
    return mix(np.add.reduceat(value, starts) + (ends - starts).astype(U))


def prefix_sums(symbols: np.ndarray) -> np.ndarray:
    """Sums of symbol * base**place before each place; a span's hash comes from two of them."""
    out = np.zeros(len(symbols) + 1, dtype=U)
    np.cumsum(symbols * powers(len(symbols)), dtype=U, out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the spans [start, end): equal spans have equal hashes wherever they are."""
    return mix((sums[ends] - sums[starts]) * powers(len(sums), inverse=True)[starts] + (ends - starts).astype(U))


def sliding_minima(values: np.ndarray, span: int) -> np.ndarray:
    """The least of the ``span`` values from each place on (fewer at the end are left out)."""
    out, have = values, 1
    while have < span:
        step = min(have, span - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out
