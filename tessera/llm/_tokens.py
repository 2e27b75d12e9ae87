"""Word and n-gram fingerprints of whole texts, with NumPy, inside tasks.

Words are the runs of ``[^\\x20\\x09-\\x0D]+`` in the UTF-8 bytes. All hashes
are 64-bit polynomials taken as differences of prefix sums, then mixed, so a
batch of texts costs a few vector operations. Bytes are handled in segments
of about 1 MB cut at white space: besides its own bytes a text of any length
needs 8 bytes per word.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEGMENT = 1 << 20
_U = np.uint64
_STEP = 0x9E3779B97F4A7C15  # odd: has an inverse modulo 2**64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BREAK = re.compile(rb"[ \t-\r]")


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64 (public domain)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Memo(dict):
    """A cache that stays behind when its module's functions are sent off."""

    def __reduce__(self):
        return dict, ()


_POWERS: dict = Memo()


def _powers(n: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of ``step`` and of its inverse modulo 2**64."""
    if (n, step) not in _POWERS:
        if len(_POWERS) > 8:
            _POWERS.clear()
        both = np.full((2, n), step, _U)
        both[1] = pow(step, -1, 1 << 64)
        both[:, 0] = 1
        _POWERS[n, step] = tuple(np.cumprod(both, axis=1, dtype=_U))
    return _POWERS[n, step]


def _round_up(n: int) -> int:
    return 1 << max(10, int(n).bit_length())


def _prefix(values: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    power, inverse = _powers(_round_up(len(values)), step)
    total = np.zeros(len(values) + 1, _U)
    np.cumsum(values * power[: len(values)], out=total[1:])
    return total, inverse


def _segment(buf: bytes, heads: tuple[int, ...]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Start byte and hash of each word of a buffer that ends in white space,
    and the hashes of the words' first bytes for each length in ``heads``."""
    data = np.frombuffer(buf, np.uint8)
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[0 : len(edge) // 2 * 2 : 2], edge[1::2]
    total, inverse = _prefix(data.astype(_U) + _U(1), _STEP)
    out = []
    for stop in (end, *(np.minimum(end, start + n) for n in heads)):
        h = (total[stop] - total[start]) * inverse[start]
        out.append(mix(h + (stop - start).astype(_U) * _U(0xD6E8FEB86659FD93)))
    return start, out


def _pieces(texts: list[bytes | None]):
    """(text number, piece), texts over a segment cut at white space."""
    for i, t in enumerate(texts):
        at = 0
        while t and at < len(t):
            cut = _BREAK.search(t, at + SEGMENT) if len(t) - at > SEGMENT else None
            end = cut.start() if cut else len(t)
            yield i, t[at:end]
            at = end


def word_and_head_hashes(texts: list[bytes | None], heads: tuple[int, ...]) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of all words of all texts in order, then of their heads, and the
    offsets of the texts (text i owns ``[offsets[i], offsets[i + 1])``)."""
    counts = np.zeros(len(texts), np.int64)
    out, owner, parts, size = [], [], [], 0

    def flush():
        starts, hashes = _segment(b" ".join(parts) + b" ", heads)
        begins = np.cumsum([0] + [len(p) + 1 for p in parts])
        np.add.at(counts, owner, np.diff(np.searchsorted(starts, begins)))
        out.append(hashes)

    for i, piece in _pieces(texts):
        parts.append(piece)
        owner.append(i)
        size += len(piece)
        if size >= SEGMENT:
            flush()
            parts, owner, size = [], [], 0
    if parts:
        flush()
    joined = [np.concatenate([h[v] for h in out]) if out else np.zeros(0, _U) for v in range(1 + len(heads))]
    return joined, np.concatenate([[0], np.cumsum(counts)])


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order, and offsets of the texts."""
    (hashes,), at = word_and_head_hashes(texts, ())
    return hashes, at


def grams(hashes: np.ndarray, k: int, step: int = _STEP) -> np.ndarray:
    """Hash of the ``k`` words from each position (those that fit)."""
    if len(hashes) < k:
        return np.zeros(0, _U)
    total, inverse = _prefix(hashes, step)
    n = len(hashes) - k + 1
    return mix((total[k:] - total[:-k]) * inverse[:n] + _U(k))


def spans(hashes: np.ndarray, start: np.ndarray, end: np.ndarray, step: int = _STEP) -> np.ndarray:
    """Hash of the words ``[start, end)`` for each pair."""
    total, inverse = _prefix(hashes, step)
    return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(_U))


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    return batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()


def slices(batches, column: str = "text", size: int = 2 << 20):
    """Cut batches so that the texts of a piece hold about ``size`` bytes; only
    a single longer text is more."""
    for batch in batches:
        length = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        group = (np.cumsum(length.to_numpy(zero_copy_only=False).astype(np.int64) + 64) // size).tolist()
        lo = 0
        for hi in range(1, len(group) + 1):
            if hi == len(group) or group[hi] != group[lo]:
                yield batch.slice(lo, hi - lo)
                lo = hi
