"""Hashes of words and of word runs, computed with numpy for many texts at once.

Words are runs of digits, a-z and bytes beyond ASCII after A-Z are lower-cased. A word's hash is a polynomial over its
bytes, taken from running sums; the hash of a run combines its words' hashes in order.
"""

from __future__ import annotations

import numpy as np

#: Bytes of text that are hashed in one go. A longer text is cut between words.
PIECE = 1 << 20
SHINGLE = 5

_U = np.uint64
_PRIME = 0x9E3779B97F4A7C15
_state: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    if len(_state.get("power", ())) < n:
        byte = np.arange(256, dtype=np.uint64)
        low = np.where((byte >= 65) & (byte <= 90), byte + _U(32), byte)
        _state["value"] = mix(low + _U(0x1234567))
        _state["word"] = ((byte >= 48) & (byte <= 57)) | ((low >= 97) & (low <= 122)) | (byte >= 128)
        one = np.ones(1, np.uint64)
        _state["power"] = np.append(one, np.cumprod(np.full(n, _PRIME, np.uint64)))
        _state["inverse"] = np.append(one, np.cumprod(np.full(n, pow(_PRIME, -1, 1 << 64), np.uint64)))
    return _state["value"], _state["word"], _state["power"], _state["inverse"]


def _hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word in ``data``."""
    a = np.frombuffer(data, np.uint8)
    value, is_word, power, inverse = _tables(max(len(a), PIECE) + 1)
    inside = np.concatenate(([False], is_word[a], [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value[a] * power[: len(a)])))
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)), starts


def _pieces(data: bytes) -> list[bytes]:
    out = []
    while len(data) > PIECE:
        at = PIECE
        while at and (data[at] >= 128 or chr(data[at]).isalnum()):
            at -= 1
        at = at or PIECE
        out.append(data[:at])
        data = data[at:]
    return [*out, data]


def words(texts: list[bytes]) -> list[np.ndarray]:
    """For each UTF-8 text the hashes of its words, in order."""
    out: list[np.ndarray] = []
    batch: list[bytes] = []
    size = 0

    def flush() -> None:
        nonlocal batch, size
        if batch:
            h, starts = _hashes(b"\n".join(batch))
            ends = np.cumsum([len(b) + 1 for b in batch])
            out.extend(np.split(h, np.searchsorted(starts, ends[:-1])))
        batch, size = [], 0

    for text in texts:
        if len(text) > PIECE:
            flush()
            out.append(np.concatenate([_hashes(p)[0] for p in _pieces(text)]))
            continue
        batch.append(text)
        size += len(text)
        if size > PIECE // 2:
            flush()
    flush()
    return out


def runs(w: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words; of the whole if there are fewer words, but some."""
    k = min(k, len(w))
    if not k:
        return w[:0]
    total = np.zeros(len(w) - k + 1, np.uint64)
    factor = 1
    for i in range(k):
        factor = factor * _PRIME % (1 << 64)
        total += mix(w[i : len(w) - k + 1 + i] + _U(i)) * _U(factor | 1)
    return mix(total)


def windows(w: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words from running sums, for long runs."""
    _, _, power, inverse = _tables(max(len(w), PIECE) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(w) * power[: len(w)])))
    return mix((total[k:] - total[:-k]) * inverse[: len(w) - k + 1])


def shingles(texts: list[bytes], k: int = SHINGLE) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its different word runs, sorted, and how often each occurs."""
    return [np.unique(runs(w, k), return_counts=True) for w in words(texts)]
