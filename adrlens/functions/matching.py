"""Dictionary matching on text columns."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, functions as F


def minimal_terms(terms: Iterable[str]) -> list[str]:
    """Drop every term that contains another one: the shorter term already matches it."""
    unique = list(dict.fromkeys(t.upper() for t in terms))
    return [t for t in unique if not any(o != t and o in t for o in unique)]


def any_term(columns: Iterable[str], terms: Iterable[str], match: str = "substring") -> Column:
    """True when any upper-cased column holds any term; null text never matches.

    ``substring`` is a literal contains; ``word`` also asks for a non-alphanumeric
    neighbour on both sides, so that short names do not hit inside longer ones.
    """
    if match == "word":
        alternatives = "|".join(re.escape(t.upper()) for t in dict.fromkeys(terms))
        pattern = f"(?<![A-Z0-9])(?:{alternatives})(?![A-Z0-9])"
        tests = [F.upper(F.col(c)).rlike(pattern) for c in columns]
    elif match == "substring":
        kept = minimal_terms(terms)
        tests = [F.upper(F.col(c)).contains(t) for c in columns for t in kept]
    else:
        raise ValueError(f"match must be 'substring' or 'word', not {match!r}")
    return F.coalesce(reduce(lambda x, y: x | y, tests), F.lit(False))


def group_bits(columns: Iterable[str], groups: Mapping[str, Iterable[str]],
               match: str = "substring") -> Column:
    """Bit set of the groups a row belongs to: bit i is set for the i-th group.

    A row can belong to several groups.  ``bit_or`` over rows gives the groups of a
    case, so one narrow aggregate replaces one distinct id set per group.
    """
    columns = list(columns)
    bits = [F.when(any_term(columns, terms, match), F.lit(1 << i)).otherwise(F.lit(0))
            for i, terms in enumerate(groups.values())]
    return reduce(lambda x, y: x.bitwiseOR(y), bits)


def has_bit(bits: Column, position: int) -> Column:
    return bits.bitwiseAND(F.lit(1 << position)) != 0


def names_of_bits(bits: Column, names: Iterable[str]) -> Column:
    """Array of the names whose bit is set."""
    flags = [F.when(has_bit(bits, i), F.lit(n)) for i, n in enumerate(names)]
    return F.array_compact(F.array(*flags))


def first_bits(bits: Column, n: int) -> Column:
    return bits.bitwiseAND(F.lit((1 << n) - 1))


def count_bits(bits: Column, n: int) -> Column:
    """Number of bits set among the first ``n``."""
    return F.bit_count(first_bits(bits, n))
