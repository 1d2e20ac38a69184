"""Quarterly report files: discovery, layouts, bad lines, missing text."""

import pytest

from adrlens.operators import cases
from adrlens.schemas import REPORT_COLUMNS
from adrlens.sources import report_files as rf
from adrlens.sources.star_schema import star_case_tables
from adrlens.sources.tables import read_table, write_table
from conftest import SMALL, rows


@pytest.fixture()
def folder(tmp_path):
    def put(name: str, text: str, encoding="iso-8859-1"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text.encode(encoding))
        return str(path)

    put.base = str(tmp_path)
    return put


def read(spark, folder, table, **options):
    files = rf.find_report_files(spark, folder.base)
    return rf.read_report_table(spark, table, files, **options)


def test_discovery(spark, folder):
    for name in ("a/DEMO20Q1.txt", "b/DEMO20Q1_copy.txt", "a/demo21q3.txt", "a/xDRUG25Q4new.txt",
                 "a/DEMO19Q1.txt", "a/Demo22Q1.txt", "a/DEMO23Q5.txt", "a/DEMO24Q1.csv"):
        folder(name, "primaryid$caseid\n")
    found = [(f.table, f.year, f.quarter, f.path.rsplit("/", 2)[1:]) for f in
             rf.find_report_files(spark, folder.base)]
    assert found == [("demo", 2020, 1, ["a", "DEMO20Q1.txt"]), ("demo", 2021, 3, ["a", "demo21q3.txt"]),
                     ("drug", 2025, 4, ["a", "xDRUG25Q4new.txt"])]


def test_paths_with_spaces(spark, folder):
    folder("my reports/OUTC20Q2.txt", "primaryid$caseid$outc_cod\n1$2$DE\n")
    assert rows(read(spark, folder, "outc")) == [("1", "2", "DE", "2020 Q2")]


def test_bad_lines(spark, folder):
    folder("OUTC20Q1.txt", 'primaryid$caseid$outc_cod\n1$2$3\n1$2\n1$2$3$4\n$$\n1$2$$5\n"a$b"$c$d\n'
                           '"9$8$7\n7$"x"$y$"z\n')
    got = rows(read(spark, folder, "outc"), "primaryid", "caseid", "outc_cod")
    assert got == [("1", "2", "3"), ("1", "2", None), ("a$b", "c", "d")]
    parsed = rf.parse_report_table(spark, "outc", rf.find_report_files(spark, folder.base))
    rejected = rf.rejected_rows(parsed)
    assert rejected.count() == 4
    assert rows(rejected, "reason", "line") == [
        ("too_many_fields", "1$2$$5"), ("too_many_fields", "1$2$3$4"),
        ("unbalanced_quote", '"9$8$7'), ("unbalanced_quote", '7$"x"$y$"z')]


def test_bad_lines_do_not_depend_on_the_columns_read(spark, folder):
    folder("OUTC20Q1.txt", "primaryid$caseid$outc_cod\n1$2$3\n4$5$6$7\n8$9\n")
    table = read(spark, folder, "outc")
    assert rows(table, "primaryid") == [("1",), ("8",)]
    assert table.count() == 2


def test_header_layouts_and_missing_columns(spark, folder):
    folder("DRUG20Q1.txt", " PRIMARYID $CASEID$DrugName\n1$2$Viread\n")
    folder("DRUG20Q2.txt", "drugname$prod_ai$primaryid$caseid$extra\nTruvada$EMTRICITABINE$3$4$x\n")
    table = read(spark, folder, "drug")
    assert table.columns == [*REPORT_COLUMNS["drug"], "year_quarter"]
    assert rows(table, "primaryid", "drugname", "prod_ai", "year_quarter") == [
        ("1", "Viread", None, "2020 Q1"), ("3", "Truvada", "EMTRICITABINE", "2020 Q2")]


def test_missing_text(spark, folder):
    folder("DEMO20Q1.txt", "primaryid$caseid$reporter_country$sex\n1$1$NA$None\n2$2$US$M\n")
    assert rows(read(spark, folder, "demo"), "reporter_country", "sex") == [("US", "M"), (None, None)]
    assert rows(read(spark, folder, "demo", missing=()), "reporter_country") == [("NA",), ("US",)]


def test_encoding(spark, folder):
    folder("REAC20Q1.txt", "primaryid$caseid$pt\n1$1$caf\xe9\n")
    assert rows(read(spark, folder, "reac"), "pt") == [("caf\xe9",)]


def test_no_files(spark, folder):
    folder("DEMO20Q1.txt", "primaryid\n1\n")
    empty = read(spark, folder, "rpsr")
    assert empty.columns == [*REPORT_COLUMNS["rpsr"], "year_quarter"] and empty.count() == 0
    assert rf.rejected_rows(rf.parse_report_table(spark, "rpsr", [])).count() == 0


def test_written_reports_come_back(spark, tmp_path):
    tables = star_case_tables(spark, SMALL)
    rf.write_report_files(tables, f"{tmp_path}/out")
    back = rf.read_reports(spark, f"{tmp_path}/out", years=range(1970, 2070))
    for (name, df), (_, again) in zip(tables.items(), back.items()):
        kept = [*REPORT_COLUMNS[name], "year_quarter"]
        again, df = again.select(*kept), df.select(*kept)
        assert again.exceptAll(df).count() == 0 and df.exceptAll(again).count() == 0, name


QUOTED = [
    # text of a file after its header, rows kept, reasons of rejected lines
    ('1$2$"a ""b"" c"$x\n', [("1", "2", 'a "b" c', "x")], []),
    ('2$2$"line one\nline two"$y\n3$3$c$d\n', [("2", "2", "line one\nline two", "y"), ("3", "3", "c", "d")], []),
    ('4$4$"back\\"$w\n', [("4", "4", "back\\", "w")], []),
    ('4$4$back\\$w\n', [("4", "4", "back\\", "w")], []),
    ('5$5$"a\n\nb ""c""\nd"$"x$y"\n', [("5", "5", 'a\nb "c"\nd', "x$y")], []),  # blank lines are skipped
    ('1$1$"open$x\n2$2$b$y\n3$3$"c"$z\n', [("2", "2", "b", "y"), ("3", "3", "c", "z")], ["unbalanced_quote"]),
    ('1$1$"open$x\n2$2$5 6" tube$y\n', [], ["stray_quote"]),  # one record or two: not to be told
    ('1$1$"line\ntwo"\n2$2$b$y\n', [("2", "2", "b", "y")], ["stray_quote"]),
    ('1$1$"line\ntwo"$a$b$c\n2$2$b$y\n', [("2", "2", "b", "y")], ["too_many_fields"]),
    ('line two"$y\n2$2$b$y\n', [("2", "2", "b", "y")], ["stray_quote"]),
    ('1$1$"never closed\n2\n', [("2", None, None, None)], ["unbalanced_quote"]),
    ('1$1$5" tube$x\n', [("1", "1", '5" tube', "x")], []),
]


@pytest.mark.parametrize("text, kept, reasons", QUOTED)
def test_quoted_text(spark, folder, text, kept, reasons):
    header = "primaryid$caseid$pt$drug_rec_act\n"
    folder("REAC20Q1.txt", header + text)
    folder("REAC20Q2.txt", header + "9$9$plain$p\n")
    parsed = rf.parse_report_table(spark, "reac", rf.find_report_files(spark, folder.base))
    got = [r[:4] for r in rows(rf.kept_rows(parsed))]
    assert sorted(got, key=repr) == sorted([*kept, ("9", "9", "plain", "p")], key=repr)
    assert sorted(r["reason"] for r in rf.rejected_rows(parsed).collect()) == sorted(reasons)


def test_records_over_lines_of_long_files(spark, folder, monkeypatch):
    text = "".join(f'{i}$c{i}$"one\ntwo {i}"$x\n{i}b$d$plain$y\n' for i in range(3000))
    folder("REAC20Q1.txt", "primaryid$caseid$pt$drug_rec_act\n" + text)
    folder("REAC20Q3.txt", "primaryid$caseid$pt$drug_rec_act\n" + text)
    table = read(spark, folder, "reac")
    assert table.count() == 12000
    assert table.where("pt = concat('one\ntwo ', primaryid)").count() == 6000


def test_paths_with_pattern_characters(spark, folder):
    folder("g [1]/x{a,b}/OUTC20Q2.txt", "primaryid$caseid$outc_cod\n1$2$DE\n")
    assert rows(read(spark, folder, "outc")) == [("1", "2", "DE", "2020 Q2")]
    files = rf.find_report_files(spark, f"{folder.base}/g [1]")
    assert rows(rf.read_report_table(spark, "outc", files)) == [("1", "2", "DE", "2020 Q2")]


def test_skipped_files_are_named(spark, folder):
    for name in ("a/DEMO20Q1.txt", "b/DEMO20Q1.txt", "a/DEMO19Q1.txt"):
        folder(name, "primaryid$caseid\n")
    skipped = rf.skipped_report_files(spark, folder.base)
    assert [(p.rsplit("/", 2)[1:], r) for p, r in rows(skipped)] == [
        (["a", "DEMO19Q1.txt"], "year_outside"), (["b", "DEMO20Q1.txt"], "second_file_of_quarter")]


def test_case_version_in_any_layout(spark, folder):
    folder("DEMO20Q1.txt", "primaryid$caseid\n1$a\n1$a\n2$a\n3$b\n")
    tables = rf.read_reports(spark, folder.base)
    assert not tables.versioned and rows(cases.keep_latest(tables).demo, "primaryid") == [("1",), ("2",), ("3",)]
    assert rows(cases.dedupe_counts(tables.demo, False)) == [(3, 3, 0)]
    folder("DEMO20Q2.txt", "primaryid$caseid$CaseVersion\n4$c$\n5$c$\n")
    tables = rf.read_reports(spark, folder.base)
    assert tables.versioned and rows(cases.keep_latest(tables).demo, "primaryid") == [("1",), ("3",), ("4",)]
    assert rows(cases.dedupe_counts(tables.demo)) == [(5, 3, 2)]


def test_text_without_encoding_stops_the_run(spark, tmp_path, make_tables):
    with pytest.raises(Exception, match="no ISO-8859-1 text in pt"):
        rf.write_report_files(make_tables(reac=[{"primaryid": "1", "pt": "ő", "year_quarter": "2020 Q1"}]), f"{tmp_path}/o")


HARD_TEXT = [" m ", "\ttab\t", 'a "quoted" word', '"', "line\nbreak", "back\\slash", "", None, "a,b", "NA", "é"]


def test_reports_keep_hard_text(spark, tmp_path, make_tables):
    own = [{"primaryid": str(i), "caseid": "1", "pt": t, "year_quarter": "2020 Q1"} for i, t in enumerate(HARD_TEXT)]
    rf.write_report_files(make_tables(reac=own), f"{tmp_path}/o")
    back = rf.read_reports(spark, f"{tmp_path}/o", missing=()).reac
    assert rows(back, "primaryid", "pt") == sorted(((r["primaryid"], r["pt"] or None) for r in own), key=repr)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_table_sink_keeps_every_value(spark, tmp_path, fmt):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(HARD_TEXT)], "primaryid string, sex string")
    write_table(df, f"{tmp_path}/t", fmt)
    assert rows(read_table(spark, f"{tmp_path}/t", df.schema, fmt)) == rows(df)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_table_sink_and_reload(spark, tmp_path, fmt):
    df = spark.createDataFrame([("1", "HBV_MONO")], "primaryid string, cohort string")
    path = f"{tmp_path}/t"
    write_table(df, path, fmt)
    assert rows(read_table(spark, path, df.schema, fmt)) == [("1", "HBV_MONO")]


def test_missing_table(spark, tmp_path):
    assert read_table(spark, f"{tmp_path}/none", "x string", required=False) is None
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_table(spark, f"{tmp_path}/none", "x string")


def test_quarter_is_searched_in_the_end_of_the_path_only(spark, folder):
    folder("20Q2x/report=DEMO99q4new.txt/part-0.csv", "primaryid$caseid\n1$2\n")
    df = rf.read_report_table(spark, "demo", rf.find_report_files(spark, folder.base, years=[1999]))
    assert rows(df, "primaryid", "year_quarter") == [("1", "1999 Q4")]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract(substring_index(" in plan.lower()
    assert "regexp_extract(_metadata" not in plan.lower()
