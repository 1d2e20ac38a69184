"""The statistics by brute force over small Python rows: sets, loops and row counts."""

from __future__ import annotations

import math
import random
import re
import statistics
from collections.abc import Iterator

from adrlens.sources import report_files as rf

ORDER = ("HBV_MONO", "HIV_HBV_COINFECTION", "HBV_AUTOIMMUNE", "HBV_OTHER")


def hit(row, terms):
    text = [(row.get(c) or "").upper() for c in ("drugname", "prod_ai")]
    return any(t in x for t in terms for x in text)


def cohort_sets(data, study):
    exposed = {c: {r["primaryid"] for r in data["drug"] if hit(r, names)}
               for c, names in study.drug_classes.items()}
    antiviral = set().union(*exposed.values())
    hiv = {r["primaryid"] for r in data["drug"] if hit(r, study.hiv_drugs)}
    immuno = {r["primaryid"] for r in data["drug"] if hit(r, study.immunosuppressants)}
    everyone = {r["primaryid"] for r in data["demo"]}
    return exposed, dict(zip(ORDER, (antiviral - hiv, antiviral & hiv,
                                     (antiviral & immuno) - hiv, everyone - antiviral)))


def pair_rows(data, study, order=ORDER):
    exposed, cohorts = cohort_sets(data, study)
    grade = {}
    for r in data["outc"]:
        g = study.severity_grades.get(r["outc_cod"], 1)
        grade[r["primaryid"]] = max(g, grade.get(r["primaryid"], 0))
    return [(r["primaryid"], c, r["pt"], next(k for k in order if r["primaryid"] in cohorts[k]),
             grade.get(r["primaryid"], 1))
            for c, ids in exposed.items() for r in data["reac"] if r["primaryid"] in ids]


def cells(pairs):
    """(drug, adr) -> (a, b, c, d, mean severity) of observed pairs."""
    out = {}
    everyone = {p[0] for p in pairs}
    for drug in {p[1] for p in pairs}:
        with_drug = {p[0] for p in pairs if p[1] == drug}
        for adr in {p[2] for p in pairs if p[2] is not None}:
            mine = [p for p in pairs if p[1] == drug and p[2] == adr]
            both, with_adr = {p[0] for p in mine}, {p[0] for p in pairs if p[2] == adr}
            if both:
                a = len(both)
                b, c = len(with_drug) - a, len(with_adr) - a
                out[drug, adr] = (a, b, c, len(everyone) - a - b - c,
                                  statistics.fmean(p[4] for p in mine))
    return out


def signals(pairs, limits):
    out = {}
    for key, (a, b, c, d, severity) in cells(pairs).items():
        if a < limits.min_cases or min(b, c, d) <= 0:
            continue
        ror, prr = a * d / (b * c), (a / (a + b)) / (c / (c + d))
        low = math.exp(math.log(ror) - 1.96 * math.sqrt(1 / a + 1 / b + 1 / c + 1 / d))
        ic = math.log2(a * (a + b + c + d) / ((a + b) * (a + c)))
        ic_low = ic - 1.96 * math.sqrt(1 / a)
        out[key] = (a, ror, low, prr, ic, ic_low, severity,
                    low >= limits.ror_lower_ci and prr >= limits.prr and ic_low >= limits.ic_lower_ci)
    return out


def random_data(study, n_cases=60, hot=0, seed=1):
    """Rows for all branches: null text, repeated rows, several classes; ``hot`` extra rows
    of one case."""
    rng = random.Random(seed)
    names = [n for names in study.drug_classes.values() for n in names[:1]]
    names += [study.hiv_drugs[0], study.immunosuppressants[0], "aspirin", None]
    events = [f"event {i}" for i in range(8)] + [None]
    ids = [str(i) for i in range(n_cases)]
    data = {"demo": [dict(primaryid=i, caseid=i) for i in ids], "drug": [], "reac": [], "outc": []}
    for i in ids:
        for _ in range(rng.randint(0, 4)):
            data["drug"].append(dict(primaryid=i, drugname=rng.choice(names), prod_ai=rng.choice([None, *names])))
        for _ in range(rng.randint(0, 5)):
            data["reac"].append(dict(primaryid=i, pt=rng.choice(events[:rng.randint(2, 9)])))
        for _ in range(rng.randint(0, 2)):
            data["outc"].append(dict(primaryid=i, outc_cod=rng.choice([*study.severity_grades, "XX", None])))
    for k in range(hot):
        data["reac"].append(dict(primaryid="7", pt=events[k % 3]))
        data["drug"].append(dict(primaryid="7", drugname=names[k % 2]))
        data["outc"].append(dict(primaryid="7", outc_cod="HO"))
    return data


# --- records over several lines, one line after the other ---

def _shape(line: str) -> tuple[bool, bool, int]:
    """(a quoted field is open at the end, a quote stands inside plain text, fields)."""
    unquoted = re.sub(rf._QUOTED, r"\1", line)
    plain, opened = re.subn(rf._OPEN_QUOTE, r"\1", unquoted)
    return bool(opened), rf.QUOTE in plain, unquoted.count(rf.DELIMITER) + 1


def joined_lines(lines: list[str], n_columns: int, more: bool = False) -> Iterator[tuple[str, str | None]]:
    """(record, reason) of the lines of one file; no reason where the parser has to decide.

    An open quote takes in the lines that follow up to the one that closes it with a quote
    inside plain text, unless a line before that one has all fields by itself.  If the record
    has all fields, and its last line has not, it is kept, else it is rejected whole, so that no
    part of it passes as a row.  Otherwise the open quote is a stray one: its line is rejected
    and the next starts anew.  With ``more`` lines to come, a record that they may go on with is
    left for later.
    """
    at = 0
    while at < len(lines):
        first, end = lines[at], None
        if _shape(first)[0]:
            for i in range(at + 1, len(lines)):
                _, stray, own = _shape(lines[i])
                if not _shape(f"{rf.QUOTE}\n{lines[i]}")[0]:  # of an open field only its quote matters
                    end = i if stray else None
                    break
                if own >= n_columns:
                    break
            else:
                if more:
                    return
            if end is None:
                yield first, "unbalanced_quote"
            else:
                record = "\n".join(lines[at:end + 1])
                fields = _shape(record)[2]
                yield record, (rf.KEPT if fields == n_columns > own else
                               "too_many_fields" if fields > n_columns else rf._STRAY_QUOTE)
                at = end
        else:
            yield first, None
        at += 1
