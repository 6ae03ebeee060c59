"""Words of an Arrow text column as 64-bit hashes, computed by numpy over whole buffers.

A word is a run of bytes outside the ASCII white space 0x09-0x0D and 0x20, with A-Z lowered. Two words
get the same hash only by chance (about n * n / 2**65 for n distinct words).
"""

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
SLICE_ROWS = 16_384

_BASE = 0xD1342543DE82EF95
_ROOT = np.uint64(_BASE)
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
PUNCTUATED = _SPACE.copy()
PUNCTUATED[:48] = PUNCTUATED[58:65] = PUNCTUATED[91:97] = PUNCTUATED[123:128] = True
_powers = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64 bits; a bijection."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = 1 << max(n - 1, 1023).bit_length()
        for name, root in (("up", _ROOT), ("down", _INVERSE)):
            steps = np.full(size, root, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"]


def slices(column, limit: int = SLICE_BYTES):
    """(first row, bytes, row offsets) of consecutive rows, about `limit` bytes and at least one row each.

    NULL counts as the empty text.
    """
    for chunk_start, chunk in _chunks(column):
        if chunk.null_count:
            chunk = chunk.fill_null("")
        if not pa.types.is_large_string(chunk.type):
            chunk = chunk.cast(pa.large_string())
        buffers = chunk.buffers()
        offsets = np.frombuffer(buffers[1], dtype=np.int64)[chunk.offset:chunk.offset + len(chunk) + 1]
        data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
        start = 0
        while start < len(chunk):
            end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            end = min(max(end, start + 1), start + SLICE_ROWS, len(chunk))
            own = offsets[start:end + 1]
            yield chunk_start + start, data[own[0]:own[-1]], own - own[0]
            start = end


def _chunks(column):
    start = 0
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        yield start, chunk
        start += len(chunk)


def word_bounds(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of each word. Rows end words."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~separators[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    rows = offsets[:-1][np.diff(offsets) > 0]
    first[rows] = inside[rows]
    last[rows[1:] - 1] = inside[rows[1:] - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


class Hasher:
    """Hashes of any spans of one slice."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((_LOWER[data] + np.uint64(1)) * up[:-1], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.down[starts])


def hashed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, word offsets by row) of one slice."""
    starts, ends = word_bounds(data, offsets)
    return Hasher(data)(starts, ends), np.searchsorted(starts, offsets).astype(np.int64)


def hash_text(text: str) -> int:
    """The hash of one word, as `hashed_words` gives it."""
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    return int(Hasher(data)(np.array([0]), np.array([len(data)]))[0])


def unmixed(x: np.ndarray) -> np.ndarray:
    """The inverse of `mixed`."""
    x = (x ^ (x >> np.uint64(31)) ^ (x >> np.uint64(62))) * np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
    x = (x ^ (x >> np.uint64(27)) ^ (x >> np.uint64(54))) * np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    return x ^ (x >> np.uint64(30)) ^ (x >> np.uint64(60))
