"""Token ids of texts by way of their distinct chunks.

A pre-tokeniser that separates words at white space gives the same ids for a text as for its
chunks one after the other, when every chunk begins at the white space after a visible
character: no pre-token reaches from a visible character into white space, and added tokens
hold no white space.  Texts are cut before single blanks and line ends; a text with any other
white space, or two such characters in a row, is not cut.  Chunks repeat, so each is encoded
once per worker; the memory is bounded by ``CAPACITY`` chunks of ``CHUNK_CHARS`` characters on
average.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from adrlens.llm.common import kept_by_worker, ranges

SLICE_BYTES = 1 << 22  # text handled at once inside a task
CAPACITY = 600_000
CHUNK_CHARS = 16
TAIL = ",.!?;:"
JOINED = 100  # chunks given to the library as one text
LOT = 1 << 14  # new chunks encoded at once; the library takes far more memory than their ids
FIRST = chr(2)  # before the first chunk of a text, which has no blank in front

#: White space and invisible separators other than the blank and the line end.
RARE_SPACE = "".join(map(chr, (
    0x09, 0x0B, 0x0C, 0x0D, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C),
    0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF)))
ODD = rf"[{RARE_SPACE}{FIRST}]|[ \n][ \n]|\A[ \n]|[ \n]\z"

Encoder = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]  # flat ids and their counts


def split_chunks(texts: pa.Array, spaced: bool) -> tuple[pa.ListArray, np.ndarray]:
    """(chunks of each text, whether the text is cut); a text that is not has one empty chunk.

    With ``spaced`` chunks keep their white space in front: a line end is kept, a blank is left
    out and stands for itself, the first chunk has ``FIRST``.  Without it white space is dropped
    and texts below U+0100 are put in lower case, which works there character by character.
    """
    plain = pc.invert(pc.match_substring_regex(texts, ODD))
    texts = pc.if_else(plain, texts, "")
    if spaced:
        texts = pc.binary_join_element_wise(FIRST, pc.replace_substring(texts, "\n", " \n"), "")
    else:
        keep = pc.match_substring_regex(texts, r"[^\x{00}-\x{ff}]|<\|")
        texts = pc.replace_substring(pc.if_else(keep, texts, pc.utf8_lower(texts)), "\n", " ")
    return pc.split_pattern(texts, " "), plain.to_numpy(zero_copy_only=False)


def array_slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Consecutive texts of about ``size`` bytes together; null becomes empty."""
    texts = pc.fill_null(texts, "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    begin = 0
    while begin < len(texts):
        done = ends[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(ends, done + size, "right")))
        yield texts.slice(begin, stop - begin)
        begin = stop


def batch_slices(batch: pa.RecordBatch, at: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch whose texts, column ``at``, take about ``size`` bytes together."""
    begin = 0
    for texts in array_slices(batch.column(at), size):
        yield batch.slice(begin, len(texts))
        begin += len(texts)


def strings(values: pa.Array) -> list[str]:
    """Strings without blanks, through one joined string (much quicker than one by one)."""
    if not len(values):
        return []
    one = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    return pc.binary_join(one, " ")[0].as_py().split(" ")


class ChunkCache:
    """Ids per distinct chunk; when full, those that several slices had stay, up to half of it.

    Sentence signs behind an ASCII letter or digit are a pre-token of their own, so a chunk with
    such a tail is put together from the ids of its core and of its tail.
    """

    def __init__(self, encode: Encoder, encode_tails: Encoder, capacity: int = CAPACITY):
        self.encode, self.encode_tails, self.capacity = encode, encode_tails, capacity
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.start, self.count = np.empty(0, np.int64), np.empty(0, np.int64)
        self.hits = np.empty(0, np.int32)  # slices that had the chunk
        self.pool = np.empty(0, np.int32)
        self.used = self.chars = 0

    def _make_room(self) -> None:
        """Forget all chunks but the commonest."""
        have = len(self.number)
        hits, start, count, pool = self.hits[:have], self.start, self.count, self.pool
        kept = np.flatnonzero(hits > 1)
        most = min(len(kept), self.capacity // 2)
        kept = np.sort(kept[np.argsort(-hits[kept], kind="stable")[:most]])
        every = list(self.number)  # in the order of their numbers
        chunks = [every[i] for i in kept.tolist()]
        del every
        self.clear()
        if sum(map(len, chunks)) <= CHUNK_CHARS * self.capacity // 2:
            self._append(chunks, pool[ranges(start[kept], count[kept])], count[kept])

    def _append(self, chunks: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        have, more = len(self.number), len(chunks)
        if have + more > len(self.start):
            room = max(2 * len(self.start), have + more, 1024)
            self.start = np.resize(self.start, room)
            self.count = np.resize(self.count, room)
            self.hits = np.resize(self.hits, room)
        if self.used + len(ids) > len(self.pool):
            self.pool = np.resize(self.pool, max(2 * len(self.pool), self.used + len(ids), 4096))
        self.start[have:have + more] = self.used + np.cumsum(counts) - counts
        self.count[have:have + more] = counts
        self.hits[have:have + more] = 0
        self.pool[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        self.chars += sum(map(len, chunks))
        self.number.update(zip(chunks, range(have, have + more)))

    def _take(self, chunks: list[str]) -> None:
        """Encode distinct chunks that are not there yet, a lot at a time."""
        for i in range(0, len(chunks), LOT):
            own = chunks[i:i + LOT]
            self._append(own, *self.encode(own))

    def _learn(self, chunks: pa.Array) -> np.ndarray:
        """Numbers of distinct chunks that are not there yet."""
        cores = pc.utf8_rtrim(chunks, TAIL)
        cores = pc.if_else(pc.match_substring_regex(cores, r"[0-9A-Za-z]\z"), cores, chunks)
        size = pc.binary_length(cores).to_numpy()
        tailed = size < pc.binary_length(chunks).to_numpy()
        numbers = np.empty(len(chunks), np.int64)
        numbers[~tailed] = len(self.number) + np.arange(len(chunks) - int(tailed.sum()))
        self._take(strings(chunks.filter(pa.array(~tailed))))
        if not tailed.any():
            return numbers
        whole, kept = strings(chunks.filter(pa.array(tailed))), strings(cores.filter(pa.array(tailed)))
        self._take([c for c in dict.fromkeys(kept) if c not in self.number])
        ends = [c[len(core):] for c, core in zip(whole, kept)]
        tails = list(dict.fromkeys(ends))
        ids, counts = self.encode_tails(tails)
        place = dict(zip(tails, range(len(tails))))
        tail = np.fromiter(map(place.__getitem__, ends), np.int64, len(ends))
        core = np.fromiter(map(self.number.__getitem__, kept), np.int64, len(kept))
        first, second = self.count[core], counts[tail]
        both = np.empty(int((first + second).sum()), np.int32)
        begin = np.cumsum(first + second) - first - second
        both[ranges(begin, first)] = self.pool[ranges(self.start[core], first)]
        both[ranges(begin + first, second)] = ids[ranges((np.cumsum(counts) - counts)[tail], second)]
        numbers[tailed] = len(self.number) + np.arange(len(whole))
        self._append(whole, both, first + second)
        return numbers

    def numbers(self, chunks: pa.Array) -> np.ndarray:
        """Numbers of the chunks in the cache, after encoding the new ones."""
        if len(self.number) > self.capacity or self.chars > CHUNK_CHARS * self.capacity:
            self._make_room()
        coded = chunks.dictionary_encode()
        distinct = strings(coded.dictionary)
        numbers = np.fromiter(map(self.number.get, distinct, repeat(-1)), np.int64, len(distinct))
        del distinct
        new = numbers < 0
        if new.any():
            numbers[new] = self._learn(coded.dictionary.filter(pa.array(new)))
        self.hits[numbers] += 1
        return numbers[coded.indices.to_numpy()]

    def look_up(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the chunks and the count of each chunk."""
        numbers = self.numbers(chunks)
        counts = self.count[numbers]
        return self.pool[ranges(self.start[numbers], counts)], counts


def segment_sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sum of each run of ``lengths`` values; runs may be empty."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(lengths, dtype=np.int64)
    return total[ends] - total[ends - lengths]


def _merged(first: np.ndarray, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]
            ) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids and counts of items of which those marked ``first`` come from a, the others from b."""
    counts = np.empty(len(first), np.int64)
    counts[first], counts[~first] = a[1], b[1]
    begin = np.cumsum(counts) - counts
    ids = np.empty(int(counts.sum()), np.int32)
    ids[ranges(begin[first], a[1])] = a[0]
    ids[ranges(begin[~first], b[1])] = b[0]
    return ids, counts


class TextEncoder:
    """Ids of whole texts, equal to those of ``encode`` on each text."""

    def __init__(self, encode: Encoder, spaced: bool, encode_chunks: Encoder | None = None,
                 capacity: int = CAPACITY):
        """``spaced``: the tokeniser keeps white space in its tokens.

        ``encode_chunks``: the same as ``encode``, quicker for many chunks.
        """
        self.encode, self.spaced, self.quick = encode, spaced, encode_chunks or encode
        self.cache = ChunkCache(self._spaced if spaced else self.quick, encode, capacity)

    def _spaced(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks that keep their white space."""
        first = np.array([c[:1] == FIRST for c in chunks])
        begun = self.encode([c[1:] for c in chunks if c[:1] == FIRST])
        return _merged(first, begun, self.quick([c if c[:1] == "\n" else " " + c for c in chunks if c[:1] != FIRST]))

    def texts(self, texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per slice of consecutive texts: flat ids and their number for each text."""
        for own in array_slices(texts, size):
            lists, plain = split_chunks(own, self.spaced)
            ids, sizes = self.cache.look_up(lists.flatten())
            counts = segment_sums(sizes, lists.value_lengths().to_numpy())
            if plain.all():
                yield ids, counts
            else:
                whole = self.encode(own.filter(pa.array(~plain)).to_pylist())
                yield _merged(plain, (ids, counts[plain]), whole)

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of each text."""
        out = [np.empty(0, np.int64)]
        for own in array_slices(texts):
            lists, plain = split_chunks(own, self.spaced)
            numbers = self.cache.numbers(lists.flatten())
            counts = segment_sums(self.cache.count[numbers], lists.value_lengths().to_numpy())
            if not plain.all():
                counts[~plain] = self.encode(own.filter(pa.array(~plain)).to_pylist())[1]
            out.append(counts)
        return np.concatenate(out)


def library(path: str):
    """Tokenizer of the file, one thread per task; kept by the worker."""
    return kept_by_worker("chunks", "library", path, lambda: _library(path))


def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def library_encoder(path: str) -> Encoder:
    tokenizer = library(path)

    def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int32, int(counts.sum())), counts

    return encode


def joined_encoder(path: str, spaced: bool) -> Encoder:
    """Encoder of chunks that gives the library ``JOINED`` of them as one text.

    Chunks that keep their white space are joined as they are; each begins where a token begins
    with white space.  Of the others, those of letters only are single pre-tokens; they are
    joined by blanks and each ends where a token ends a word.  Groups of letters below U+0100 in
    lower case need no normalising.  Chunks with other signs, and groups whose ids do not fall
    into as many parts as there are chunks, go one by one.
    """
    tokenizer, encode = library(path), library_encoder(path)
    vocabulary = tokenizer.get_vocab()
    marks = np.zeros(1 + max(vocabulary.values()), bool)
    if spaced:
        space = (chr(0x100 + ord(" ")), chr(0x100 + ord("\n")))  # as byte-level vocabularies write them
        marks[[i for token, i in vocabulary.items() if token[:1] in space]] = True
    else:
        marks[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
    bare = None if spaced else _bare(path)

    def parts(group: list[str], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(marks[ids])
        if len(at) != len(group):
            return encode(group)
        return ids, np.diff(at, append=len(ids)) if spaced else np.diff(at, prepend=-1)

    def encode_groups(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        groups = [chunks[i:i + JOINED] for i in range(0, len(chunks), JOINED)]
        texts = [("" if spaced else " ").join(g) for g in groups]
        plain = [not spaced and _folded(t) for t in texts]
        found = [iter(tool.encode_batch_fast(own, add_special_tokens=False) if own else ())
                 for tool, kind in ((tokenizer, False), (bare, True)) for own in [[t for t, p in zip(texts, plain) if p == kind]]]
        lists = [next(found[p]).ids for p in plain]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        ids = np.fromiter(chain.from_iterable(lists), np.int32, int(sizes.sum()))
        if np.array_equal(segment_sums(marks[ids], sizes), list(map(len, groups))):
            at = np.flatnonzero(marks[ids])
            # A group whose first id is not a mark would lend its first ids to the group before.
            if not len(ids) or (marks[ids[np.cumsum(sizes) - sizes]] if spaced else marks[ids[np.cumsum(sizes) - 1]]).all():
                return ids, np.diff(at, append=len(ids)) if spaced else np.diff(at, prepend=-1)
        cut = [parts(group, own) for group, own in zip(groups, np.split(ids, np.cumsum(sizes)[:-1]))]
        return (np.concatenate([np.empty(0, np.int32), *(c[0] for c in cut)]),
                np.concatenate([np.empty(0, np.int64), *(c[1] for c in cut)]))

    def encode_joined(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if spaced:
            return encode_groups(chunks)
        letters = np.fromiter(map(str.isalpha, chunks), bool, len(chunks))
        others = encode([chunks[i] for i in np.flatnonzero(~letters)])
        if letters.any():
            return _merged(letters, encode_groups([chunks[i] for i in np.flatnonzero(letters)]), others)
        return others

    return encode_joined


def _folded(text: str) -> bool:
    """Whether lower case and composition leave a text as it is, character by character."""
    return (text.isascii() or max(text) < chr(0x100)) and text == text.lower()


def _bare(path: str):
    """The tokenizer without its normaliser."""
    from tokenizers import Tokenizer, normalizers

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.normalizer = normalizers.Sequence([])
    return tokenizer


def text_encoder(path: str, spaced: bool) -> TextEncoder:
    """Encoder of this worker, kept with its chunks for the tasks that follow."""
    return kept_by_worker("chunks", "encoder", (path, spaced), lambda: TextEncoder(
        library_encoder(path), spaced, joined_encoder(path, spaced)))


def keeps_space(path: str) -> bool:
    """Whether the file describes a byte-level tokeniser without a normaliser.

    The other kind that is cut into chunks drops white space; see ``split_chunks``.
    """
    with open(path, encoding="utf-8") as source:
        return json.load(source)["normalizer"] is None
