"""Words and hashes of many texts at once: numpy over the bytes of an Arrow column.

Spans of up to ``SHORT`` bytes, and runs of words, are hashed by polynomials modulo 2**64 with a final mix, longer spans
by a keyed BLAKE2b digest. The limit matters: for every odd base some pairs of two-letter words of 1,024 letters have
equal polynomials modulo 2**64, and shorter ones agree in part of their bits (19 of 64 at 32 letters or words). Two such
hashes together keep 90 bits or more that no repetition pattern of a word or window can make equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute

SLICE_BYTES = 1 << 20
"""Texts are worked on in slices of about this size, so that memory depends on the longest text, not on the batch."""

SHORT = 32
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
LETTERS_DIGITS = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])
"""Bytes of the words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of a lower-cased text."""
LETTERS_DIGITS[65:91] = False
NOT_SPACE = np.array([b != 0x20 and not 0x09 <= b <= 0x0D for b in range(256)])
"""Bytes of the words [^\\x20\\x09-\\x0D]+."""
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse, for i below n."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, int(n).bit_length())
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            pair.append(np.cumprod(steps, dtype=np.uint64))
        have = (pair[0], pair[1])
        if size <= SLICE_BYTES * 8:
            _powers[base] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hash of values[start:end] for each span of bytes or of hashes."""
    up, down = powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * down[starts]
    found = mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    if values.dtype == np.uint8:
        key = base.to_bytes(8, "little")
        for i in np.flatnonzero(ends - starts > SHORT):
            digest = hashlib.blake2b(values[starts[i] : ends[i]], digest_size=8, key=key).digest()
            found[i] = int.from_bytes(digest, "little")
    return found


class Texts:
    """Some texts as one byte array; ``words`` cuts them, without ever joining two texts."""

    def __init__(self, column: pa.Array):
        if not pa.types.is_large_string(column.type):
            column = column.cast(pa.large_string())
        column = column.fill_null("")
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = column.buffers()[2]
        all_bytes = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        self.data = all_bytes[offsets[0] : offsets[-1]]
        self.offsets = offsets - offsets[0]

    def lower(self) -> Texts:
        self.data = LOWER[self.data]
        return self

    def words(self, letters: np.ndarray = NOT_SPACE) -> Words:
        inside = letters[self.data]
        before, after = np.zeros(len(inside), bool), np.zeros(len(inside), bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        filled = self.offsets[:-1][self.offsets[:-1] < self.offsets[1:]]
        before[filled] = False
        after[filled[1:] - 1] = False
        starts = np.flatnonzero(inside & ~before)
        return Words(self, starts, np.flatnonzero(inside & ~after) + 1, np.searchsorted(starts, self.offsets))


class Words:
    """starts, ends: byte spans of all words; offsets: of each text's words in them."""

    def __init__(self, texts: Texts, starts: np.ndarray, ends: np.ndarray, offsets: np.ndarray):
        self.texts, self.starts, self.ends, self.offsets = texts, starts, ends, offsets
        self.counts = np.diff(offsets)
        self._limits: np.ndarray | None = None
        self._hashes: dict[int, np.ndarray] = {}

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, which: int = 0) -> np.ndarray:
        if which not in self._hashes:
            self._hashes[which] = span_hashes(self.texts.data, self.starts, self.ends, BASES[which])
        return self._hashes[which]

    def limits(self) -> np.ndarray:
        """For each word, the index at which its text's words end."""
        if self._limits is None:
            self._limits = np.repeat(self.offsets[1:], self.counts)
        return self._limits

    def doc(self, word: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, word, side="right") - 1

    def gram_starts(self, k: int) -> np.ndarray:
        """Words at which k words of one text begin."""
        return np.flatnonzero(np.arange(k, len(self) + k) <= self.limits())

    def gram_hashes(self, at: np.ndarray, k: int, which: int = 0) -> np.ndarray:
        return span_hashes(self.hashes(which), at, at + k, BASES[1 - which])

    def text(self, start: int, end: int) -> str:
        """Words start to end, joined by one space."""
        data = self.texts.data
        return b" ".join(data[s:e].tobytes() for s, e in zip(self.starts[start:end], self.ends[start:end])).decode()

    def joined(self, keep: np.ndarray | None = None) -> list[bytes]:
        """The words of each text (those marked in ``keep``), joined by one space."""
        data = self.texts.data.copy()
        kept = np.arange(len(self)) if keep is None else np.flatnonzero(keep)
        edge = np.zeros(len(data) + 1, np.int8)
        edge[self.starts[kept]] += 1
        edge[self.ends[kept]] -= 1
        take = np.cumsum(edge[:-1], dtype=np.int8) > 0
        docs = self.doc(kept)
        not_last = np.zeros(len(kept), bool)
        not_last[:-1] = docs[1:] == docs[:-1]
        gaps = self.ends[kept[not_last]]  # a kept word that is not the last one is followed by a separator
        take[gaps] = True
        data[gaps] = 32
        places = np.concatenate([[0], np.cumsum(take)])[self.texts.offsets]
        out = data[take].tobytes()
        return [out[a:b] for a, b in zip(places[:-1].tolist(), places[1:].tolist())]

    def digests(self, keep: np.ndarray | None = None) -> list[str]:
        """SHA-256 of the joined words."""
        return [hashlib.sha256(text).hexdigest() for text in self.joined(keep)]


def first_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values, the index of its first smallest one."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, size = np.arange(len(values)), 1

    def better(a, b):
        return np.where(values[b] < values[a], b, a)

    while size * 2 <= width:
        best = better(best[:-size], best[size:])
        size *= 2
    if size < width:
        return better(best[:n], best[width - size : width - size + n])
    return best[:n]


def winnow(words: Words, span: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of every run of ``span`` words.

    Returns the runs' first words, for each the word at which its anchor begins (the run's k words with the
    smallest hash, the first of equals), and that hash. Equal runs have equal anchors at equal places, wherever
    they stand.
    """
    starts = words.gram_starts(span)
    if not len(starts):
        return starts, starts, np.zeros(0, np.uint64)
    every = np.arange(len(words) - k + 1)
    hashes = words.gram_hashes(every, k)
    anchors = first_minimum(hashes, span - k + 1)[starts]
    return starts, anchors, hashes[anchors]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of about ``limit`` bytes of text; one row at least."""
    if not batch.num_rows:
        return
    sizes = np.asarray(pa.compute.binary_length(batch[column]).fill_null(0), dtype=np.int64)
    part = np.concatenate([[0], np.cumsum(sizes)[:-1]]) // limit
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
    for a, b in zip(edges[:-1], edges[1:]):
        yield batch.slice(a, b - a)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start and its length, one after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)
