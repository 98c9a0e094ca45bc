"""Words of texts as 64-bit hashes, in NumPy: a word's hash is a polynomial in
its bytes (each byte first replaced by a random 64-bit value), taken from
running sums, so the cost is a few operations a byte."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK = 1 << 21  #: bytes hashed at once; a longer text is cut between words

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: A-Z count as a-z.
_BYTE[65:91] = _BYTE[97:123]
_P = np.uint64(0xD6E8FEB86659FD93)
_INV = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    if name not in _powers or len(_powers[name]) < n:
        p = np.empty(n, np.uint64)
        p[0] = 1
        have = 1
        while have < n:  # doubling: p[k + i] = p[k] * p[i]
            more = min(have, n - have)
            with np.errstate(over="ignore"):  # arithmetic modulo 2^64
                p[have : have + more] = p[:more] * (p[have - 1] * base)
            have += more
        _powers[name] = p
    return _powers[name][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start byte) of every word of UTF-8 ``data``."""
    b = np.frombuffer(data, np.uint8)
    if not len(b):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    word = np.empty(len(b) + 2, bool)
    word[0] = word[-1] = False
    np.logical_not(_SPACE[b], out=word[1:-1])
    edge = np.flatnonzero(word[1:] != word[:-1])
    start, end = edge[::2], edge[1::2]
    total = np.empty(len(b) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[b] * _power("p", _P, len(b)), out=total[1:])
    h = (total[end] - total[start]) * _power("inv", _INV, len(b))[start]
    return mix(h ^ (end - start).astype(np.uint64)), start


def document_hashes(texts: list[bytes]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Word hashes of many texts in bounded chunks. Yields (first document,
    documents, hashes, words per document); a text longer than a chunk comes
    in several yields of one document each."""
    at = 0
    while at < len(texts):
        if len(texts[at]) > CHUNK:
            for part in _parts(texts[at]):
                h, _ = word_hashes(part)
                yield at, 1, h, np.array([len(h)])
            at += 1
            continue
        held, n = 0, 0
        while at + n < len(texts) and (held + len(texts[at + n]) <= CHUNK):
            held += len(texts[at + n]) + 1
            n += 1
        n = max(n, 1)
        group = texts[at : at + n]
        h, start = word_hashes(b" ".join(group))
        ends = np.cumsum([len(t) + 1 for t in group])
        upto = np.searchsorted(start, ends)
        yield at, n, h, np.diff(upto, prepend=0)
        at += n


def _parts(text: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(text):
        end = at + CHUNK
        while end < len(text) and text[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield text[at:end]
        at = end


def documents(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """(document, its whole hash array), long texts put together again."""
    pending: list[np.ndarray] = []
    last = None
    for first, n, h, counts in document_hashes(texts):
        if last is not None and first != last:
            yield last, np.concatenate(pending)
            pending, last = [], None
        if n == 1 and len(texts[first]) > CHUNK:
            pending.append(h)
            last = first
            continue
        for i, part in enumerate(np.split(h, np.cumsum(counts)[:-1])):
            yield first + i, part
    if last is not None:
        yield last, np.concatenate(pending)
