"""Byte-level BPE by depth-first traversal of the trie of distinct words.

For every prefix of a word exactly one token ends its encoding, and the tokens before it are the
encoding of the shorter prefix.  A token may follow another if merging their bytes alone gives
back those two tokens.  The distinct words are visited in byte order, that is, depth first
through their trie; the path holds the last token of each prefix, so words that share a prefix
share its states, and only new trie nodes are computed.

Defined results: null text is empty (no ids, empty decoded text); texts of any length are
encoded whole; bytes that are no UTF-8 decode to replacement characters.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, types as T

from adrlens.llm.chunks import TextEncoder
from adrlens.llm.common import kept_by_worker

#: Fixed value: the pre-token pattern of byte-level BPE.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NEVER = 1 << 60
MOST_PAIRS = 2_000_000  # remembered pairs of tokens, per worker


def byte_letters() -> dict[str, int]:
    """Byte per letter of the vocabulary file: visible bytes stand for themselves, the others
    for the characters from 256 on."""
    visible = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1),
               *range(ord("®"), ord("ÿ") + 1)}
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class TrieBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        letters, model = byte_letters(), spec["model"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        spelled = {word: bytes(map(letters.__getitem__, word)) for word in model["vocab"]
                   if word not in self.added}
        self.ids = {spelled[word]: i for word, i in model["vocab"].items() if word in spelled}
        self.bytes: list[bytes] = [b""] * (1 + max([*self.ids.values(), *self.added.values()]))
        for word, i in self.ids.items():
            self.bytes[i] = word
        for word, i in self.added.items():
            self.bytes[i] = word.encode()
        self.longest = max(map(len, self.ids))
        self.merges: dict[tuple[int, int], int] = {}  # pair: rank
        self.rank: dict[int, int] = {}  # rank of the merge that makes a token
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            a, b = self.ids[spelled[left]], self.ids[spelled[right]]
            self.merges[a, b] = rank
            whole = self.ids[spelled[left] + spelled[right]]
            if whole not in self.rank:
                self.rank[whole], self.parts[whole] = rank, (a, b)
        self.follows: dict[int, bool] = {}  # token pair as one number
        self.words = regex.compile(WORDS)
        self.split = (regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")")
                      if self.added else None)

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the bytes of both tokens together are encoded as just these tokens.

        Goes back in time from the finished tokens: at each moment one part of ``left`` touches
        one part of ``right``; their merge must not come before either is used up otherwise.
        Of equal ranks the merge further left comes first.
        """
        until_left = until_right = NEVER
        while True:
            rank = self.merges.get((left, right))
            if rank is not None and rank < until_left and rank <= until_right:
                return False
            born_left, born_right = self.rank.get(left, -1), self.rank.get(right, -1)
            if born_left < 0 and born_right < 0:
                return True
            if born_left > born_right:
                until_left, left = born_left, self.parts[left][1]
            else:
                until_right, right = born_right, self.parts[right][0]

    def encode_words(self, words: Sequence[bytes]) -> list[list[int]]:
        """Ids of distinct words, in the order given."""
        order = sorted(range(len(words)), key=words.__getitem__)
        out: list[list[int]] = [[]] * len(words)
        ids, follows, longest = self.ids, self.follows, self.longest
        if len(follows) > MOST_PAIRS:
            follows.clear()
        token, begin = [0], [0]  # of each prefix on the path: its last token, where that begins
        before = b""
        for at in order:
            word = words[at]
            size, shared = len(word), 0
            most = min(size, len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del token[shared + 1:], begin[shared + 1:]
            for end in range(shared + 1, size + 1):
                for start in range(max(0, end - longest), end):
                    found = ids.get(word[start:end])
                    if found is None:
                        continue
                    if start:
                        pair = token[start] << 32 | found
                        fits = follows.get(pair)
                        if fits is None:
                            fits = follows[pair] = self.may_follow(token[start], found)
                    else:
                        fits = self.stands_alone(found)
                    if fits:
                        token.append(found)
                        begin.append(start)
                        break
            before, end, own = word, size, []
            while end:
                own.append(token[end])
                end = begin[end]
            own.reverse()
            out[at] = own
        return out

    def stands_alone(self, token: int) -> bool:
        """Whether merging the token's bytes makes the token (true for all that merges can make)."""
        return token in self.rank or len(self.bytes[token]) == 1

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the texts and the number of each."""
        numbers: dict[str, int] = {}
        plans: list[list[int]] = []  # word numbers; added tokens as -1 - id
        for text in texts:
            plan: list[int] = []
            for i, part in enumerate(self.split.split(text) if self.split else [text]):
                if i % 2:
                    plan.append(-1 - self.added[part])
                else:
                    plan += [numbers.setdefault(w, len(numbers)) for w in self.words.findall(part)]
            plans.append(plan)
        encoded = self.encode_words([w.encode() for w in numbers])
        found = [[i for n in plan for i in (encoded[n] if n >= 0 else (-1 - n,))] for plan in plans]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for own in found for i in own), np.int32, int(counts.sum())), counts

    def decode(self, ids: Sequence[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


def trie_encoder(path: str) -> tuple[TrieBpe, TextEncoder]:
    """Tokeniser of this worker, kept with its words for the tasks that follow."""
    def build():
        bpe = TrieBpe(path)
        return bpe, TextEncoder(bpe.encode, spaced=True)

    return kept_by_worker("trie", "encoder", path, build)


def encode_decode(docs: DataFrame, tokenizer: str, digests: bool = False, id_column: str = "doc_id",
                  text_column: str = "text") -> DataFrame:
    """(id, n_tokens, ids, decoded): ids as little-endian 32-bit numbers, and their text.

    With ``digests`` the two last are the SHA-256 of the ids and of the UTF-8 text, so that the
    texts do not go back through Arrow: (id, n_tokens, ids_sha256, decoded_sha256).
    """
    picked = docs.select(id_column, text_column)
    names = ("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded")
    kinds = (T.StringType(), T.StringType()) if digests else (T.BinaryType(), T.StringType())
    schema = T.StructType([picked.schema[id_column], T.StructField("n_tokens", T.LongType()),
                           *(T.StructField(n, k) for n, k in zip(names, kinds))])

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, encoder = trie_encoder(tokenizer)
        for batch in batches:
            at = 0
            for ids, counts in encoder.texts(batch.column(1)):
                raw, begin = ids.astype("<u4").tobytes(), 0
                encoded, decoded = [], []
                for count in counts.tolist():
                    own = raw[4 * begin:4 * (begin + count)]
                    text = bpe.decode(ids[begin:begin + count].tolist())
                    begin += count
                    encoded.append(hashlib.sha256(own).hexdigest() if digests else own)
                    decoded.append(hashlib.sha256(text.encode()).hexdigest() if digests else text)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(counts)), pa.array(counts, pa.int64()),
                     pa.array(encoded, pa.string() if digests else pa.binary()), pa.array(decoded, pa.string())],
                    schema.names)
                at += len(counts)

    return picked.mapInArrow(convert, schema)
