"""Secret scan over a trigram inverted index.

Every rule is a regular expression.  Its parse tree gives a Boolean query over trigrams that
each match must contain.  Per block of documents an inverted index (trigram to sorted document
numbers) answers the queries by intersecting and uniting postings; only candidates are searched
with the expression.  A rule without mandatory trigrams searches every document.  Blocks are
slices of an input partition, so nothing is shuffled.

Defined results: null and empty texts have no spans; a text of any length is one document;
repeated rows are scanned each on its own; only the id and text columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import product
from re import _constants as tree, _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from adrlens.llm.chunks import batch_slices
from adrlens.llm.common import kept_by_worker, text_slices

MOST_STRINGS = 64  # alternatives kept apart while a query is derived
LONGEST_CLASS = 4  # characters of a class that are spelled out
INDEX_BYTES = 1 << 18  # whose trigrams are looked up at once


@dataclass(frozen=True)
class Rule:
    """``least``: characters that ``group`` must have for a match to count."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    any_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


#: Fixed values of the base kinds.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         group=2, least=6, any_case=True),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]+", least=24),
)
#: Public credential formats beyond the base kinds.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH )?PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("slack", r"xox[baprs]-[A-Za-z0-9-]+", least=20),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=40),
)

# A query is True (no condition), a trigram, ("and", parts) or ("or", parts).


def _all_of(parts) -> object:
    parts = [p for p in dict.fromkeys(parts) if p is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _any_of(parts) -> object:
    parts = list(dict.fromkeys(parts))
    return True if True in parts or not parts else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _fold(char: int) -> bytes:
    """Bytes of a character as the index has them: ASCII letters in lower case."""
    return chr(char).encode().lower()


def _of_strings(strings) -> object:
    """Query that holds for a text containing one of the strings."""
    return _any_of([_all_of([s[i:i + 3] for i in range(len(s) - 2)]) for s in strings])


def _class(items) -> list[bytes] | None:
    """Spellings of a small character class; None for a large or negated one."""
    found = set()
    for op, value in items:
        if op is tree.LITERAL:
            found.add(_fold(value))
        elif op is tree.RANGE and value[1] - value[0] < LONGEST_CLASS:
            found |= {_fold(c) for c in range(value[0], value[1] + 1)}
        else:
            return None
    return sorted(found) if len(found) <= LONGEST_CLASS else None


def _read(nodes) -> tuple[list[bytes] | None, object]:
    """(all strings the nodes can match, or None if not listed; query every match fulfils)."""
    strings, query, whole = [b""], True, True

    def close():
        nonlocal strings, query, whole
        query, strings, whole = _all_of([query, _of_strings(strings)]), [b""], False

    for op, value in nodes:
        listed, inner = None, True
        if op is tree.LITERAL:
            listed = [_fold(value)]
        elif op is tree.IN:
            listed = _class(value)
        elif op is tree.SUBPATTERN:
            listed, inner = _read(value[3])
        elif op is tree.BRANCH:
            each = [_read(branch) for branch in value[1]]
            inner = _any_of([_of_strings(s) if s else q for s, q in each])
            if all(s for s, _ in each):
                listed = [s for own, _ in each for s in own]
        elif op in (tree.MAX_REPEAT, tree.MIN_REPEAT, tree.POSSESSIVE_REPEAT):
            low, high, body = value
            own, needed = _read(body)
            if own and high == 1:
                listed = [b"", *own] if low == 0 else own
            elif low:
                inner = _of_strings(own) if own else needed
        elif op is tree.AT:
            listed = [b""]
        if listed is not None and len(strings) * len(listed) <= MOST_STRINGS:
            strings = list(dict.fromkeys(a + b for a, b in product(strings, listed)))
        else:
            close()
            query = _all_of([query, inner])
            if listed is not None and len(listed) <= MOST_STRINGS:
                strings = list(listed)
    if whole:
        return strings, _of_strings(strings)
    return None, _all_of([query, _of_strings(strings)])


def trigram_query(rule: Rule) -> object:
    """Condition on the trigrams of a text without which the rule cannot match."""
    return _read(_parser.parse(rule.pattern))[1]


def trigrams_of(query) -> set[bytes]:
    if query is True:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*map(trigrams_of, query[1]))


def _code(trigram: bytes) -> int:
    return trigram[0] << 16 | trigram[1] << 8 | trigram[2]


class TrigramIndex:
    """Postings of the wanted trigrams over one block of texts, ASCII letters folded."""

    def __init__(self, texts: Sequence[str], wanted: np.ndarray):
        raw = [t.encode() for t in texts]
        data = np.frombuffer(b"\0\0".join(raw).lower(), np.uint8)
        ends = np.cumsum([len(r) + 2 for r in raw])
        self.all = np.arange(len(texts))
        self.postings: dict[int, np.ndarray] = {}
        if len(data) < 3 or not wanted.any():
            return
        key = np.unique(np.concatenate([self._keys(data, begin, ends, wanted) for begin in range(0, len(data) - 2, INDEX_BYTES)]))
        trigram, doc = key >> 32, key & 0xFFFFFFFF
        for part in np.split(np.arange(len(key)), np.flatnonzero(np.diff(trigram)) + 1):
            if len(part):
                self.postings[int(trigram[part[0]])] = doc[part]

    @staticmethod
    def _keys(data: np.ndarray, begin: int, ends: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """(trigram, document) as one number, of the wanted trigrams that start in ``INDEX_BYTES`` from ``begin`` on."""
        own = data[begin:begin + INDEX_BYTES + 2].astype(np.int32)
        codes = own[:-2] << 16 | own[1:-1] << 8 | own[2:]
        at = np.flatnonzero(wanted[codes])
        return np.unique(codes[at].astype(np.int64) << 32 | np.searchsorted(ends, begin + at, "right"))

    def candidates(self, query) -> np.ndarray:
        """Documents that fulfil a query, ascending."""
        if query is True:
            return self.all
        if isinstance(query, bytes):
            return self.postings.get(_code(query), self.all[:0])
        found = [self.candidates(part) for part in query[1]]
        result = found[0]
        for other in found[1:]:
            result = (np.intersect1d(result, other, assume_unique=True) if query[0] == "and"
                      else np.union1d(result, other))
        return result


class Scanner:
    def __init__(self, rules: Sequence[Rule]):
        self.rules = [(i, rule, rule.compiled(), trigram_query(rule)) for i, rule in enumerate(rules)]
        self.wanted = np.zeros(1 << 24, bool)
        for *_, query in self.rules:
            self.wanted[[_code(t) for t in trigrams_of(query)]] = True

    def scan(self, texts: Sequence[str]) -> list[list[tuple[int, int, int]]]:
        """Per text the spans (start, rule number, end) in order; code points."""
        found: list[list] = [[] for _ in texts]
        for begin, end in text_slices(texts):
            index = TrigramIndex(texts[begin:end], self.wanted)
            for number, rule, expression, query in self.rules:
                for doc in index.candidates(query):
                    for m in expression.finditer(texts[begin + doc]):
                        if m.end(rule.group) - m.start(rule.group) >= rule.least:
                            found[begin + doc].append((m.start(), number, m.end()))
        for spans in found:
            spans.sort()
        return found


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                     T.StructField("end", T.LongType())])


def find_secrets(docs: DataFrame, rules: Sequence[Rule], id_column: str = "doc_id",
                 text_column: str = "text") -> DataFrame:
    """(id, spans): the spans of each document, by start, then by order of the rules."""
    rules = tuple(rules)
    picked = docs.select(id_column, text_column)
    schema = T.StructType([picked.schema[id_column], T.StructField("spans", T.ArrayType(SPAN))])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = kept_by_worker("secrets", "scanner", rules, lambda: Scanner(rules))
        for whole in batches:
            for batch in batch_slices(whole, 1):
                texts = [t or "" for t in batch.column(1).to_pylist()]
                spans = [[{"kind": rules[k].kind, "start": s, "end": e} for s, k, e in own]
                         for own in scanner.scan(texts)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, arrow)],
                                                 [id_column, "spans"])

    return picked.mapInArrow(scan, schema)


def redact(docs: DataFrame, rules: Sequence[Rule], mark: str = "[REDACTED]") -> DataFrame:
    """``docs`` with every span of its ``text`` replaced and ``n_chars``, where there is one, counted anew.

    Overlapping spans become one mark; texts without spans stay as they are, null stays null.
    """
    rules = tuple(rules)
    names = docs.columns

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = kept_by_worker("secrets", "scanner", rules, lambda: Scanner(rules))
        for whole in batches:
            for batch in batch_slices(whole, names.index("text")):
                columns = dict(zip(names, batch.columns))
                texts = columns["text"].to_pylist()
                counts = columns["n_chars"].to_pylist() if "n_chars" in columns else [0] * len(texts)
                for i, spans in enumerate(scanner.scan([t or "" for t in texts])):
                    if spans:
                        texts[i] = _without(texts[i], spans, mark)
                        counts[i] = len(texts[i])
                columns["text"] = pa.array(texts, columns["text"].type)
                if "n_chars" in columns:
                    columns["n_chars"] = pa.array(counts, columns["n_chars"].type)
                yield pa.RecordBatch.from_arrays(list(columns.values()), names)

    return docs.mapInArrow(clean, docs.schema)


def _without(text: str, spans, mark: str) -> str:
    kept, end = [], 0
    for start, _, stop in spans:
        if start >= end:
            kept += [text[end:start], mark]
        end = max(end, stop)
    return "".join([*kept, text[end:]])
