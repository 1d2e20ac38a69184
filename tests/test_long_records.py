"""Quoted fields over many lines."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from adrlens.sources import report_files as rf
from reference_rules import joined_lines

HEADER = "primaryid$caseid$pt$drug_rec_act\n"


@pytest.mark.parametrize("inner", [1, 198, 199, 250, 30_000])
def test_a_record_may_take_any_number_of_lines(inner):
    field = "\n".join(f'line {i} ""x""' for i in range(inner))
    record = f'1$2$"first\n{field}\nlast"$y'
    found = list(joined_lines([*record.split("\n"), "3$3$c$d"], 4))
    assert found == [(record, rf.KEPT), ("3$3$c$d", None)]


def test_open_record_waits_for_more_lines():
    lines = ["0$0$a$b", '1$2$"first', "middle"]
    assert list(joined_lines(lines, 4, more=True)) == [("0$0$a$b", None)]
    assert [r for _, r in joined_lines(lines, 4)] == [None, "unbalanced_quote", None]


def test_long_records_in_files(spark, tmp_path):
    sizes = [5, 250, 30_000]
    text = "".join(f'{i}$c$"' + "\n".join(f"inner {j}" for j in range(n)) + f'"$x\n{i}b$d$plain$y\n'
                   for i, n in enumerate(sizes))
    (tmp_path / "REAC20Q1.txt").write_text(HEADER + text, encoding=rf.ENCODING)
    parsed = rf.parse_report_table(spark, "reac", rf.find_report_files(spark, str(tmp_path)))
    kept = {r["primaryid"]: r["pt"] for r in rf.kept_rows(parsed).collect()}
    assert sorted(kept) == ["0", "0b", "1", "1b", "2", "2b"] and rf.rejected_rows(parsed).count() == 0
    assert [kept[str(i)].count("\n") + 1 for i in range(3)] == sizes


LINES = ("1$2$3", "1$2", "x", '1$"a', 'b"$3', '1$2$"c', 'd"', 'e"$"f', '"g"', '1$"h"$3', 'i" j$2$3', 'k"$2$"l', '"', '""', 'm$"n""')


def test_records_equal_those_of_reading_line_after_line(spark):
    """Random files of every kind of line, cut into splits anywhere."""
    pick, files = random.Random(11), {}
    for i in range(400):
        kinds = pick.sample(LINES, pick.randint(2, len(LINES)))
        files[f"f{i}"] = [pick.choice(kinds) for _ in range(pick.randint(1, 25))]
    rows = []
    for path, lines in files.items():
        cuts = sorted(pick.sample(range(len(lines) + 1), min(len(lines), pick.randint(0, 4))))
        rows += [(path, path, sum(c <= n for c in cuts) * 1000, n + 1, line) for n, line in enumerate(lines)]
    pick.shuffle(rows)
    frame = spark.createDataFrame(rows, "path string, year_quarter string, split long, number long, line string")
    found = defaultdict(list)
    for r in rf.joined_records(frame, 3).collect():
        found[r["year_quarter"]].append((r["line"], r["given"]))
    wrong = [(p, lines, sorted(found[p], key=repr), sorted(joined_lines(lines, 3), key=repr)) for p, lines in files.items()
             if sorted(found[p], key=repr) != sorted(joined_lines(lines, 3), key=repr)]
    assert not wrong, (len(wrong), wrong[0])


def test_one_open_quote_leaves_a_file_split(spark, tmp_path, monkeypatch):
    """No Python, no unsplit read, and every split of the file is read on its own."""
    line = "1$2$" + "x" * 90 + "$y\n"
    (tmp_path / "REAC20Q1.txt").write_text(HEADER + line * 3000 + '7$7$"open\nclosed"$z\n' + line * 3000, encoding=rf.ENCODING)
    (tmp_path / "REAC20Q2.txt").write_text(HEADER + "8$8$plain$p\n", encoding=rf.ENCODING)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        parsed = rf.parse_report_table(spark, "reac", rf.find_report_files(spark, str(tmp_path)))
        plan = parsed._jdf.queryExecution().executedPlan().toString()
        assert "MapInPandas" not in plan and "multiLine" not in plan
        lines = rf._numbered_lines(spark, [str(tmp_path / "REAC20Q1.txt")])
        assert lines.select("split").distinct().count() > 5
        assert [r["number"] for r in lines.orderBy("number").collect()] == list(range(6003))
        kept = rf.kept_rows(parsed)
        assert kept.count() == 6002 and [r["pt"] for r in kept.where("primaryid = '7'").collect()] == ["open\nclosed"]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_filters_do_not_parse_a_line_again(spark, tmp_path):
    text = "".join(f'{i}$c$"a\nb"$x\n{i}b$d$plain$y\n' for i in range(3))
    (tmp_path / "REAC20Q1.txt").write_text(HEADER + text, encoding=rf.ENCODING)
    kept = rf.kept_rows(rf.parse_report_table(spark, "reac", rf.find_report_files(spark, str(tmp_path))))
    assert sorted(r["pt"] for r in kept.collect()) == ["a\nb"] * 3 + ["plain"] * 3
    plan = kept._jdf.queryExecution().optimizedPlan().toString().splitlines()
    filters = [line for line in plan if "Filter " in line]
    assert any("from_csv(" in line for line in plan) and not any("from_csv(" in line for line in filters)
