"""Hashes of words, word prefixes and word shingles of many texts at once, in numpy.

Words are runs of bytes other than space and \\x09-\\x0D; A-Z count as a-z. A word's hash is a polynomial in a fixed odd
number modulo 2**64 over one random number per byte value, then mixed, so equal words have equal hashes everywhere and
different words differ but for odds of about 2**-60.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
#: Texts are worked on in slices of about this many bytes, which bounds memory; one text is cut at white space.
SLICE = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
with np.errstate(over="ignore"):
    _BYTE = mix((np.arange(256, dtype=_U) + _U(1)) * _U(_BASE))
_BYTE[65:91] = _BYTE[97:123]
_BYTE[_SPACE] = 0
#: Letters by case, digits as one class, all other bytes as they are.
_SHAPE = np.arange(256, dtype=np.uint32)
_SHAPE[97:123] = _SHAPE[128:256] = ord("a")
_SHAPE[65:91] = ord("A")
_SHAPE[48:58] = ord("9")
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    if base not in _powers or len(_powers[base]) < n:
        out = np.full(max(n, SLICE + 1), base, _U)
        out[0] = 1
        _powers[base] = np.multiply.accumulate(out)
    return _powers[base][:n]


def _hash_slice(data: np.ndarray, breaks: np.ndarray, prefixes: tuple[int, ...], endings: bool):
    """Starts and hashes of the words of ``data``; a word also ends at each of ``breaks``."""
    word = ~_SPACE[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    at = breaks[breaks < len(data)]
    first[at] |= word[at]
    starts = np.flatnonzero(first)
    if not len(starts):
        return starts, np.zeros(0, _U), []
    parts = _BYTE[data] * _power(_BASE, len(data))
    back = _power(_INVERSE, len(data))[starts]
    hashes = mix(np.add.reduceat(parts, starts) * back + _U(1))
    if not prefixes and not endings:
        return starts, hashes, []
    # Bytes past a word's end must add nothing: the length of a word is its bytes up to the next space or break.
    ends = np.append(starts[1:], len(data))
    gaps = np.add.reduceat(word.astype(np.int64), starts)
    lengths = np.minimum(gaps, ends - starts)
    out, total = [], np.zeros(len(starts), _U)
    if endings:
        last, code = starts + lengths - 1, np.zeros(len(starts), np.uint32)
        for i in range(3):
            code |= np.where(lengths > i, _SHAPE[data[np.maximum(last - i, 0)]], 0).astype(np.uint32) << np.uint32(8 * i)
        out.append((lengths > 0, mix(code.astype(_U) + _U(_BASE))))
    for i in range(max(prefixes, default=0)):
        inside = lengths > i
        total[inside] += parts[starts[inside] + i]
        if i + 1 in prefixes:
            out.append((lengths > i + 1, mix(total * back + _U(i + 2) * _U(_BASE))))
    return starts, hashes, out


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.cast(pa.large_string()).fill_null("")
    if texts.offset:
        texts = pa.concat_arrays([texts, texts.slice(0, 0)])
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def _slices(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(first text, last text, first byte, last byte): whole texts up to SLICE bytes, or a piece of a longer one."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE, "right")) - 1)
        at, stop = int(offsets[i]), int(offsets[j])
        while j == i + 1 and stop - at > SLICE:
            spaces = np.flatnonzero(_SPACE[data[at + 1 : at + SLICE]])
            if len(spaces):
                cut = at + 1 + int(spaces[-1])
            else:  # one word longer than a slice
                rest = np.flatnonzero(_SPACE[data[at + SLICE : stop]])
                cut = at + SLICE + int(rest[0]) if len(rest) else stop
            yield i, i, at, cut
            at = cut
        yield i, j, at, stop
        i = j


def word_hashes(
    texts: pa.Array, prefixes: tuple[int, ...] = (), endings: bool = False
) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
    """(index, hashes of its words in order, hashes of more features) of each text, one after the other.

    The features are the words' proper prefixes of the given lengths in bytes and, with ``endings``, the shape of each
    word's last three bytes.
    """
    data, offsets = _buffers(texts)
    held: list[tuple[np.ndarray, list[np.ndarray]]] = []
    with np.errstate(over="ignore"):
        for i, j, start, stop in _slices(data, offsets):
            breaks = offsets[i + 1 : j] - start if j > i else np.zeros(0, np.int64)
            starts, hashes, extra = _hash_slice(data[start:stop], breaks, prefixes, endings)
            if j == i:  # a piece; the text goes on
                held.append((hashes, [h[ok] for ok, h in extra]))
                continue
            cuts = np.searchsorted(starts, np.append(np.append(0, breaks), stop - start))
            for k in range(j - i):
                own = slice(cuts[k], cuts[k + 1])
                one = hashes[own], [h[own][ok[own]] for ok, h in extra]
                if held:
                    parts = [*held, one]
                    one = np.concatenate([p[0] for p in parts]), [h for p in parts for h in p[1]]
                    held = []
                yield i + k, one[0], one[1]


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; of fewer words the whole run; of none, none."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    with np.errstate(over="ignore"):
        out = mix(hashes[: len(hashes) - size + 1] + _U(size))
        for i in range(1, size):
            out = mix(out * _U(_BASE) + hashes[i : len(hashes) - size + 1 + i])
    return np.unique(out)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The shingle set of each text."""
    for _, hashes, _ in word_hashes(texts):
        yield shingles(hashes, size)
