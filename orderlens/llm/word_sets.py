"""Sets of hashed five-word shingles, for whole blocks of texts at a time."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import xxhash

WORDS = 5
#: Bytes of text hashed at a time; longer texts are cut between words.
PIECE = 1 << 18
#: Longer words are hashed one by one: sums of powers modulo 2 ** 64 repeat in very long strings.
LONG_WORD = 256

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_CUT = re.compile(rb"[\x20\x09-\x0d]")
_BYTE = np.random.default_rng(5).integers(0, 1 << 64, 256, dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95
_powers: dict[str, np.ndarray] = {}


def _power_table(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64, at least so many."""
    if len(_powers.get("up", ())) < size:
        with np.errstate(over="ignore"):
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(max(size, PIECE + 2), base, np.uint64)
                steps[0] = 1
                _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31))) * _ODD
        return h ^ (h >> np.uint64(29))


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word of lower-case bytes."""
    raw = np.frombuffer(data, np.uint8)
    space = _SPACE[raw]
    edge = np.diff(space.astype(np.int8), prepend=1, append=1)
    start, stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _power_table(len(raw) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE[raw] * up[: len(raw)], out=total[1:])
        h = _mixed((total[stop] - total[start]) * down[start] + (stop - start).astype(np.uint64))
    for k in np.flatnonzero(stop - start > LONG_WORD):
        h[k] = xxhash.xxh3_64_intdigest(data[start[k] : stop[k]])
    return h, start


def _pieces(text: bytes) -> Iterator[bytes]:
    at = 0
    while len(text) - at > PIECE:
        cut = _CUT.search(text, at + PIECE)
        stop = cut.start() if cut else len(text)
        yield text[at:stop]
        at = stop
    yield text[at:]


def _shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of runs of ``width`` consecutive words."""
    count = len(words) - width + 1
    out = np.full(max(count, 0), width, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width if count > 0 else 0):
            out = (out ^ words[i : count + i]) * _ODD
            out ^= out >> np.uint64(29)
    return out


def shingle_sets(texts: list[bytes | None]) -> Iterator[np.ndarray]:
    """The distinct shingles of each text in turn, sorted; a text under five words is one shingle."""
    block, size = [], 0
    for text in texts:
        text = text or b""
        if block and size + len(text) > PIECE:
            yield from _block_sets(block)
            block, size = [], 0
        block.append(text)
        size += len(text) + 1
    if block:
        yield from _block_sets(block)


def _block_sets(block: list[bytes]) -> Iterator[np.ndarray]:
    if len(block) == 1:
        words = [_word_hashes(p.translate(_LOWER))[0] for p in _pieces(block[0])]
        words, bounds = np.concatenate(words), None
        bounds = np.array([0, len(words)])
    else:
        words, start = _word_hashes(b" ".join(block).translate(_LOWER))
        begins = np.cumsum([0] + [len(t) + 1 for t in block])
        bounds = np.searchsorted(start, begins)
    every = _shingles(words, WORDS)
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= WORDS:
            yield np.unique(every[a : b - WORDS + 1])
        else:
            yield _shingles(words[a:b], b - a) if b > a else np.zeros(0, np.uint64)


def set_name(hashes: np.ndarray) -> bytes:
    """A 128-bit name of a set of hashes."""
    return xxhash.xxh3_128_digest(hashes.tobytes())
