"""Word shingles of texts as 64-bit hashes, computed on whole blocks of bytes at once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import regex

from adrlens.llm.common import text_slices

CHUNK = 1 << 20  # bytes hashed at once
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that its powers have inverses


def _is_word() -> np.ndarray:
    """Bytes that belong to words: ASCII letters and digits, and all of other characters but ``BREAKS``."""
    table = np.zeros(256, bool)
    table[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = True
    return table


WORD_BYTE = _is_word()
#: Blanks, signs and controls beyond ASCII, which separate words like those in ASCII.
BREAKS = regex.compile(r"[[\p{Z}\p{P}\p{S}\p{C}]--[\x00-\x7F]]+", regex.V1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps)


class WordHasher:
    """Hash of every word of lower-cased texts, from prefix sums of a polynomial modulo 2^64."""

    def __init__(self):
        self.up = _powers(int(BASE), 2 * CHUNK)
        self.down = _powers(pow(int(BASE), -1, 1 << 64), 2 * CHUNK)

    def _reach(self, size: int) -> None:
        if size > len(self.up):
            self.up = _powers(int(BASE), 2 * size)
            self.down = _powers(pow(int(BASE), -1, 1 << 64), 2 * size)

    def of(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of all words, number of words of each text)."""
        raw = [(t if t.isascii() else BREAKS.sub(" ", t)).lower().encode() for t in texts]
        data = np.frombuffer(b"\0".join([*raw, b""]), np.uint8)
        ends = np.cumsum([len(r) + 1 for r in raw]) if raw else np.zeros(0, np.int64)
        hashes, starts, begin = [], [], 0
        while begin < len(data):
            stop = begin + CHUNK
            while stop < len(data) and WORD_BYTE[data[stop - 1]]:  # ends between words
                gaps = np.flatnonzero(~WORD_BYTE[data[stop:stop + CHUNK]])
                stop = stop + (int(gaps[0]) + 1 if len(gaps) else CHUNK)
            stop = min(stop, len(data))
            own, at = self._chunk(data[begin:stop])
            hashes.append(own)
            starts.append(begin + at)
            begin = stop
        if not hashes:
            return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
        upto = np.searchsorted(np.concatenate(starts), ends)
        return np.concatenate(hashes), np.diff(upto, prepend=0)

    def _chunk(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        self._reach(len(data))
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = WORD_BYTE[data]
        change = np.diff(inside)
        start, end = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:len(data)], out=sums[1:])
        own = (sums[end] - sums[start]) * self.down[start]
        return mix(own + (end - start).astype(np.uint64)), start


class Shingler:
    def __init__(self, words: int):
        self.words, self.hasher = words, WordHasher()
        self.factor = _powers(0xD6E8FEB86659FD93, words + 1)[1:]

    def of(self, texts: Sequence[str]) -> Iterator[tuple[np.ndarray, int]]:
        """Per text: the shingle hashes in order of the text, and a hash of all its words.

        A text with fewer words than a shingle has one shingle of all of them; a text without
        words has none.
        """
        for begin, end in text_slices(texts):
            words, counts = self.hasher.of(texts[begin:end])
            if len(words) >= self.words:
                whole = sum(words[i:len(words) - self.words + 1 + i] * self.factor[i]
                            for i in range(self.words))
                whole = mix(whole)
            else:
                whole = np.empty(0, np.uint64)
            places = mix(words + _steps(counts))
            at = 0
            for count in counts.tolist():
                if count >= self.words:
                    own = whole[at:at + count - self.words + 1]
                elif count:
                    short = (words[at:at + count] * self.factor[:count]).sum(dtype=np.uint64)
                    own = mix(np.array([short + np.uint64(count)], np.uint64))
                else:
                    own = np.empty(0, np.uint64)
                yield own, int(places[at:at + count].sum(dtype=np.uint64).view(np.int64))
                at += count


def _steps(counts: np.ndarray) -> np.ndarray:
    """A different number for each place inside a text, so that order counts."""
    at = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return at.astype(np.uint64) * BASE


def pack_sorted(values: np.ndarray) -> bytes:
    """64-bit numbers byte plane by byte plane: equal leading bytes of sorted numbers compress."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1).astype(np.uint64)
