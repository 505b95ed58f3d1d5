"""Words, lines and hashes of many texts at once, on the UTF-8 bytes with numpy.

White space is the six ASCII characters ``\\x20 \\x09-\\x0D``; they are single bytes in UTF-8 and
never part of another character, so all of this works on bytes. Texts are handled in batches of
a few megabytes, so memory does not follow the size of a Spark partition; a single very long
text is a batch of its own.
"""

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORD = r"[^\x20\x09-\x0D]+"
BATCH_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _constants(name: str, n: int) -> np.ndarray:
    """n fixed odd 64-bit numbers drawn from a name."""
    digest = b"".join(hashlib.sha256(f"{name}:{i}".encode()).digest() for i in range(-(-n // 4)))
    return np.frombuffer(digest, np.uint64)[:n] | np.uint64(1)


BYTE_VALUES = _constants("byte", 256)
RADIX = int(_constants("radix", 1)[0])
STEP = _constants("step", 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def powers(n: int) -> np.ndarray:
    """RADIX ** 0 .. RADIX ** (n - 1) modulo 2 ** 64."""
    out = np.full(max(n, 1), RADIX, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def slices(sizes: list[int], limit: int = BATCH_BYTES) -> Iterator[slice]:
    """Consecutive slices whose sizes add up to at most ``limit``, or of one item."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield slice(start, i)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield slice(start, len(sizes))


def resting(run):
    """The task function ``run``; afterwards what it has freed goes back to the system, as reused workers,
    idle ones too, stand beside those of the next stage."""
    def whole(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)     # of glibc
        if trim is not None:
            trim(0)

    return whole


def as_bytes(text) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


class Words:
    """The words of a batch of texts: where they start and end, whose they are, their hashes."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        joined = np.frombuffer(b" ".join([*texts, b""]) or b" ", np.uint8)
        self.bytes = LOWER[joined] if lower else joined
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        self.text_starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        inside = ~SPACE[self.bytes]
        edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
        self.starts, self.ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.of = np.searchsorted(self.text_starts, self.starts, "right") - 1
        self.first = np.searchsorted(self.starts, self.text_starts)  # first word of each text
        self._inside = inside

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """One 64-bit hash per word."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        where = np.flatnonzero(self._inside)
        length = self.ends - self.starts
        begin = np.concatenate([[0], np.cumsum(length)[:-1]])
        place = np.arange(len(where)) - np.repeat(begin, length)
        value = BYTE_VALUES[self.bytes[where]] * powers(int(length.max()))[place]
        return mix(np.add.reduceat(value, begin) + length.astype(np.uint64))

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every run of n words inside one text."""
        h = self.hashes()
        if len(h) < n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        total = np.zeros(len(h) - n + 1, np.uint64)
        for j in range(n):
            total = mix(total + h[j:len(h) - n + 1 + j] * STEP[j])
        same = self.of[:len(total)] == self.of[n - 1:]
        return np.flatnonzero(same), total[same]


def shingle_sets(texts: list[bytes], n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, hashes): the sorted distinct n-word shingles of text i are
    ``hashes[offsets[i]:offsets[i + 1]]``, after lower-casing A-Z.

    A text with fewer than n words has its whole word sequence as its only shingle; one without
    words has none.
    """
    words = Words(texts, lower=True)
    at, h = words.windows(n)
    owner = words.of[at]
    counts = words.counts()
    short = np.flatnonzero((counts > 0) & (counts < n))
    parts, bounds = [], np.searchsorted(owner, np.arange(len(texts) + 1))
    base = words.hashes() if len(short) else None
    for i in range(len(texts)):
        if 0 < counts[i] < n:
            own = base[words.first[i]:words.first[i + 1]]
            total = np.array([counts[i]], np.uint64)
            for j in range(len(own)):
                total = mix(total + own[j:j + 1] * STEP[32 + j])
            parts.append(total)
        else:
            own = np.sort(h[bounds[i]:bounds[i + 1]])
            parts.append(own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) else own)
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return offsets, np.concatenate(parts) if parts else np.zeros(0, np.uint64)
