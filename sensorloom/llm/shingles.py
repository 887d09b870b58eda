"""Word shingles of whole texts as sorted sets of 64-bit hashes, computed for many texts at once."""

from __future__ import annotations

import hashlib

import numpy as np

from sensorloom.llm.decontaminate import _mix, _powers

WORDS = 5

# Words are runs of bytes other than blank and the controls 9 to 13.
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def _word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    parts = [(t or "").encode("utf-8", "replace").lower() for t in texts]
    data = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    word = ~_BLANK[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word)).astype(np.int8)))
    starts, lengths = edge[::2], edge[1::2] - edge[::2]
    firsts = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
    values = (data[word].astype(np.uint64) + np.uint64(1)) * _powers(int(lengths.max(initial=0)) + 1)[place]
    sums = np.add.reduceat(values, firsts) if len(starts) else np.zeros(0, np.uint64)
    bounds = np.cumsum([len(p) + 1 for p in parts])
    counts = np.diff(np.searchsorted(starts, bounds), prepend=0)
    return _mix(sums + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), counts


def shingle_sets(texts: list[str | None], size: int = WORDS) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``size`` words, at most five (A-Z lower-cased).

    A text of fewer words has one shingle, all its words; one without words has none."""
    hashes, counts = _word_hashes(texts)
    out, at = [], 0
    for n in counts.tolist():
        words = hashes[at:at + n]
        at += n
        if n >= size:
            sums = words[:n - size + 1] * _FACTORS[0]
            for k in range(1, size):
                sums = sums + words[k:n - size + 1 + k] * _FACTORS[k]
            out.append(np.unique(_mix(sums)))
        elif n:
            out.append(_mix((words * _FACTORS[:n]).sum(keepdims=True, dtype=np.uint64) + np.uint64(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_name(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    digest = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)
