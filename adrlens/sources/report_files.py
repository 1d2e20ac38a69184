"""Quarterly report files: ``$``-delimited text, one file (or folder of parts) per table
and quarter, named like ``DEMO20Q1.txt``.

Bad lines follow the rule "too long is dropped, too short is padded"; a line with an
unbalanced quote is set aside (see ``rejected_rows``) and never takes its file with it.
Quotes inside quoted text are doubled; a backslash is an ordinary character.

Files are split and read line by line.  A first pass finds the files in which a quoted field is
still open at the end of a line; in those a record goes on over the lines that follow until its
quote is closed (see ``joined_records``).  They are split like all others.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import partial, reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from adrlens.functions.cleaning import NULL_TOKENS, null_tokens
from adrlens.schemas import REPORT_COLUMNS, REPORT_TABLES, string_schema
from adrlens.session import concurrently, materialise
from adrlens.sources.case_tables import CaseTables

# Fixed values.
DELIMITER = "$"
ENCODING = "ISO-8859-1"
QUOTE = '"'
YEARS = range(2020, 2026)
PIVOT_YEAR = 70  # two-digit years from here on are 19xx
HEADER_THREADS = 16
KEPT = "ok"

_RAW = "_raw_line"
#: A quoted field: up to the first quote that is not doubled, else up to the last but one of all.
#: Without backtracking, as a field may be long.
_QUOTED = r'(^|\$)"(?:(?:[^"]++|"")*+"|(?s:.*)"(?="[^"]*$))'
_OPEN_QUOTE = r'(^|\$)"[^"]*$'
_STRAY_QUOTE = "stray_quote"


@dataclass(frozen=True)
class ReportFile:
    table: str
    year: int
    quarter: int
    path: str


def _report_of(path: str, tables: Iterable[str]) -> tuple[tuple[str, int, int], str] | None:
    """(table, year, quarter) and the path up to the component that names the report."""
    names = "|".join(n for t in tables for n in (t.lower(), t.upper()))
    match = re.search(rf"^(.*/[^/]*?({names})(\d\d)[qQ]([1-4])[^/]*\.txt)(/[^/]+)?$", path)
    if match is None:
        return None
    year = int(match[3])
    return (match[2].lower(), year + (2000 if year < PIVOT_YEAR else 1900), int(match[4])), match[1]


def literal_path(path: str) -> str:
    """A path as Spark readers take it: characters of file patterns stand for themselves."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def _listed(spark: SparkSession, base_dir: str, tables: tuple[str, ...]) -> list[tuple[tuple[str, int, int], str]]:
    """Report files below a folder, from the file listing that Spark makes for a read."""
    listing = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*")
               .text(literal_path(base_dir)).inputFiles())
    return list(dict.fromkeys(r for r in (_report_of(p, tables) for p in sorted(map(unquote, listing))) if r))


def find_report_files(spark: SparkSession, base_dir: str, tables: Iterable[str] = REPORT_TABLES,
                      years: Iterable[int] = YEARS) -> list[ReportFile]:
    """Report files anywhere below a folder; the first path wins for a table and quarter."""
    years, found = set(years), {}
    for key, path in _listed(spark, base_dir, tuple(tables)):
        if key[1] in years:
            found.setdefault(key, path)
    return [ReportFile(*key, path) for key, path in sorted(found.items())]


def skipped_report_files(spark: SparkSession, base_dir: str, tables: Iterable[str] = REPORT_TABLES,
                         years: Iterable[int] = YEARS) -> DataFrame:
    """(path, reason) of report files that ``find_report_files`` leaves out."""
    tables, years = tuple(tables), set(years)
    used = {f.path for f in find_report_files(spark, base_dir, tables, years)}
    rows = [(path, "second_file_of_quarter" if key[1] in years else "year_outside")
            for key, path in _listed(spark, base_dir, tables) if path not in used]
    return spark.createDataFrame(rows, "path string, reason string")


def _reader(spark: SparkSession):
    return (spark.read.option("sep", DELIMITER).option("encoding", ENCODING).option("escape", QUOTE)
            .option("header", True).option("recursiveFileLookup", True))


def _normalised_header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names of one file, stripped and lower-cased; reads its first line only."""
    return tuple(c.strip().lower() for c in _reader(spark).csv(literal_path(path)).columns)


def _quarter_label() -> Column:
    """From the path's last two components, of which one names the report; searched once a row."""
    tail = F.substring_index("_metadata.file_path", "/", -2)
    quarter = F.regexp_extract(tail, r"(\d\d[qQ][1-4])[^/]*\.txt(/[^/]+)?$", 1)
    year = F.substring(quarter, 1, 2)
    century = F.when(year < str(PIVOT_YEAR), "20").otherwise("19")
    return F.concat(century, year, F.lit(" Q"), F.substring(quarter, 4, 1))


def _parsed(spark: SparkSession, paths: list[str], header: tuple[str, ...]) -> DataFrame:
    """Files of one layout, with the raw text of irregular lines in ``_RAW``.

    Column pruning of the parser is off because it would hide wrong field counts.
    """
    schema = string_schema([*header, _RAW])
    rows = (_reader(spark).schema(schema).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", _RAW).option("columnPruning", False)
            .csv([literal_path(p) for p in paths]))
    return rows.withColumns({"year_quarter": _quarter_label(), "reason": _reason(len(header))})


def _reason(n_columns: int) -> Column:
    """Why a line is left out; ``ok`` for a line that is kept."""
    unquoted = F.regexp_replace(F.col(_RAW), _QUOTED, "$1")
    fields = _fields(unquoted)
    return (F.when(F.col(_RAW).isNull(), KEPT)
            .when(unquoted.rlike(_OPEN_QUOTE), "unbalanced_quote")
            .when(fields > n_columns, "too_many_fields")
            .when((fields < n_columns) & unquoted.contains(QUOTE), _STRAY_QUOTE)
            .otherwise(KEPT))


# --- lines of files with open quotes ---------------------------------------------------

def _open_reports(spark: SparkSession, files: list[ReportFile]) -> set[tuple[str, int, int]]:
    """(table, year, quarter) of files in which a quoted field is open at the end of a line."""
    if not files:
        return set()
    lines = (spark.read.option("recursiveFileLookup", True).text([literal_path(f.path) for f in files])
             .where(F.col("value").contains(QUOTE)))
    unquoted = F.regexp_replace(F.rtrim("value"), _QUOTED, "$1")
    found = (lines.where(unquoted.rlike(_OPEN_QUOTE)).select(F.col("_metadata.file_path").alias("path"))
             .distinct().collect())  # at most one row per file
    return {_report_of(unquote(r["path"]), REPORT_TABLES)[0] for r in found}


_LINE_KEYS = ["path", "segment"]


def _quote_shape(line: Column) -> Column:
    """A line's quotes: whether a field is open at its end (``opens``), whether the line closes a
    field left open before it (``closes``), whether a quote stands inside plain text (``stray``);
    and its ``fields``."""
    def unquoted(text: Column) -> Column:
        return F.regexp_replace(text, _QUOTED, "$1")

    quoted = F.contains(line, F.lit(QUOTE))
    own = F.when(quoted, unquoted(line)).otherwise(line)
    within = unquoted(F.concat(F.lit(QUOTE + "\n"), line))  # of an open field only its quote matters
    return F.struct(
        (quoted & own.rlike(_OPEN_QUOTE)).alias("opens"), (quoted & ~within.rlike(_OPEN_QUOTE)).alias("closes"),
        (quoted & F.contains(F.regexp_replace(own, _OPEN_QUOTE, "$1"), F.lit(QUOTE))).alias("stray"), _fields(own).alias("fields"),
        _computed_once().alias("once"))


def _computed_once() -> Column:
    """A value that may not be copied, and nothing with it: else Spark puts the expression of a column
    into the filters on it, once for every use there."""
    return F.spark_partition_id()


def _fields(unquoted: Column) -> Column:
    return F.length(unquoted) - F.length(F.replace(unquoted, F.lit(DELIMITER), F.lit(""))) + 1


def _before(frame: DataFrame, count: Column, name: str) -> DataFrame:
    """(path, split, ``name``): sum of ``count`` over the earlier splits of a file; one row per split."""
    return (frame.groupBy("path", "split").agg(count.alias("n"))
            .withColumn(name, F.sum("n").over(W.partitionBy("path").orderBy("split")) - F.col("n")).drop("n"))


def _numbered_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, year_quarter, split, number, line): lines that are not blank, numbered per file from
    0, the header; files are split, and a line's number is its place in the split plus the lines before."""
    lines = (spark.read.option("recursiveFileLookup", True).text([literal_path(p) for p in paths])
             .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"),
                     _quarter_label().alias("year_quarter"), F.decode(F.col("value").cast("binary"), ENCODING).alias("line"))
             .where("trim(line) != ''").withColumn("place", F.monotonically_increasing_id()))
    splits = _before(lines, F.count("*"), "before").join(
        lines.groupBy("path", "split").agg(F.min("place").alias("first")), ["path", "split"])
    return (lines.join(materialise(splits, "splits"), ["path", "split"])
            .withColumn("number", F.col("before") + F.col("place") - F.col("first")).drop("before", "place", "first"))


def joined_records(lines: DataFrame, n_columns: int) -> DataFrame:
    """(year_quarter, line, given): the records of numbered lines; no reason given where the parser has to decide.

    An open quote takes in the lines that follow up to the one that closes it with a quote inside
    plain text, unless a line before that one has all fields by itself.  If the record has all
    fields, and its last line has not, it is kept, else it is rejected whole, so that no part of it
    passes as a row.  Otherwise the open quote is a stray one: its line is rejected and the next
    starts anew.

    A line that closes a field or has all fields ends a segment; a line's segment is known from
    the number of lines before it that do not, counted per split.  Only segments that follow one
    another in doubt (the last line of one may open or close a record) are looked at in order.
    """
    shaped = lines.withColumn("shape", _quote_shape(F.col("line"))).select("*", "shape.*").drop("shape", "once")
    full = F.col("fields") >= n_columns
    regular = full & ~F.col("opens") & ~F.col("closes")
    plain = shaped.where(regular).select("year_quarter", "line", F.lit(None).cast("string").alias("given"))

    odd = materialise(shaped.where(~regular).withColumn("inner", ~full & ~F.col("closes")), "odd-lines")
    inner = F.col("inner").cast("long")
    earlier = W.partitionBy("path", "split").orderBy("number").rowsBetween(W.unboundedPreceding, -1)
    own = (odd.withColumn("inners", F.coalesce(F.sum(inner).over(earlier), F.lit(0)))
           .join(_before(odd, F.sum(inner), "more"), ["path", "split"])
           .withColumn("segment", F.col("number") - F.col("inners") - F.col("more"))
           .select("path", "year_quarter", "segment", "number", "line", "opens", "inner", "fields",
                   (F.col("closes") & F.col("stray") & ~F.col("inner")).alias("good"), F.lit(False).alias("copy")))
    own = materialise(own, "segments")
    copies = (own.where("opens and not inner")  # may begin the next segment's record
              .withColumns({"segment": F.col("segment") + 1, "copy": F.lit(True), "good": F.lit(False)}))
    members = own.unionByName(copies)
    segments = members.groupBy(*_LINE_KEYS).agg(
        F.min(F.when(F.col("inner") & F.col("opens"), F.col("number"))).alias("inside"),
        F.max(F.when(F.col("copy"), F.col("number"))).alias("carried"), F.max("good").alias("good"))
    kind = (F.when(~F.col("good"), "no").when(F.col("inside").isNotNull(), "yes")
            .when(F.col("carried").isNotNull(), "unless").otherwise("no"))  # unless the one before is a record
    segments = materialise(segments.withColumn("kind", kind), "segment-kinds")
    last = segments.select("path", (F.col("segment") + 1).alias("segment"), F.col("kind").alias("last_kind"))
    known = segments.join(last, _LINE_KEYS, "left").withColumn("last_kind", F.coalesce("last_kind", F.lit("no")))
    settled = (known.where("kind != 'unless' or last_kind != 'unless'")
               .withColumn("record", (F.col("kind") == "yes") | ((F.col("kind") == "unless") & (F.col("last_kind") == "no"))))
    chained = (known.where("kind = 'unless' and last_kind = 'unless'")  # each the opposite of the one before
               .withColumn("link", F.row_number().over(W.partitionBy("path").orderBy("segment")))
               .withColumn("chain", F.col("segment") - F.col("link"))
               .withColumn("link", F.row_number().over(W.partitionBy("path", "chain").orderBy("segment")))
               .withColumn("start", F.col("segment") - F.col("link")))
    starts = settled.select("path", F.col("segment").alias("start"), F.col("record").alias("start_record"))
    chained = (chained.join(starts, ["path", "start"])
               .withColumn("record", (F.col("link") % 2 == 1) != F.col("start_record")))
    found = ["path", "segment", "inside", "carried", "record"]
    settled = materialise(settled.select(found).unionByName(chained.select(found)), "records")
    before = settled.select("path", (F.col("segment") + 1).alias("segment"), F.col("record").alias("last_record"))
    begin = F.when(F.col("record"), F.when(F.col("carried").isNotNull() & ~F.coalesce("last_record", F.lit(False)),
                                           F.col("carried")).otherwise(F.col("inside")))
    begun = settled.join(before, _LINE_KEYS, "left").select(*_LINE_KEYS, begin.alias("begin"))
    after = begun.select("path", (F.col("segment") - 1).alias("segment"), F.col("begin").alias("next_begin"))

    placed = members.join(begun, _LINE_KEYS)
    records = (placed.where("number >= begin").groupBy(*_LINE_KEYS, "year_quarter")
               .agg(F.array_sort(F.collect_list(F.struct("number", "line", "fields"))).alias("lines"))
               .select("year_quarter", F.array_join("lines.line", "\n").alias("line"),
                       F.element_at("lines.fields", -1).alias("last_fields"))
               .withColumn("fields", _fields(F.regexp_replace("line", _QUOTED, "$1"))))
    given = (F.when(F.col("fields") > n_columns, "too_many_fields")
             .when((F.col("fields") == n_columns) & (F.col("last_fields") < n_columns), KEPT).otherwise(_STRAY_QUOTE))
    alone = (placed.join(after, _LINE_KEYS, "left")
             .where("not copy and (begin is null or number < begin) and (next_begin is null or number < next_begin)")
             .select("year_quarter", "line", F.when(F.col("opens"), "unbalanced_quote").alias("given")))
    return plain.unionByName(records.select("year_quarter", "line", given.alias("given"))).unionByName(alone)


def _parsed_in_order(spark: SparkSession, paths: list[str], header: tuple[str, ...]) -> DataFrame:
    """Like ``_parsed`` for files with records over several lines."""
    n_columns = len(header)
    lines = _numbered_lines(spark, paths).where("number > 0")
    parsed = F.from_csv(F.when(_computed_once() >= 0, F.col("line")), F.lit(", ".join(f"`{c}` string" for c in [*header, _RAW])),
                        {"sep": DELIMITER, "escape": QUOTE, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _RAW})
    return (joined_records(lines, n_columns)
            .select("year_quarter", "given", "line", parsed.alias("parsed"))
            .select(*(F.col("parsed").getField(c).alias(c) for c in header),
                    F.when(F.col("given").isNull(), F.col(f"parsed.{_RAW}"))
                    .when(F.col("given") != KEPT, F.col("line")).alias(_RAW), "year_quarter", "given")
            .withColumn("reason", F.coalesce("given", _reason(n_columns))).drop("given"))


def _layouts(spark: SparkSession, files: Iterable[ReportFile]) -> dict[tuple[str, ...], list[ReportFile]]:
    files = list(files)
    paths = [f.path for f in files]
    headers = concurrently(spark, partial(_normalised_header, spark), paths, HEADER_THREADS)  # one short job per file
    layouts: dict[tuple[str, ...], list[ReportFile]] = {}
    for file, columns in zip(files, headers):
        layouts.setdefault(columns, []).append(file)
    return layouts


def has_column(spark: SparkSession, table: str, column: str, files: Iterable[ReportFile]) -> bool:
    """Whether the header of any file of a table names a column."""
    return any(column in header for header in _layouts(spark, (f for f in files if f.table == table)))


def parse_report_table(spark: SparkSession, table: str, files: Iterable[ReportFile],
                       missing: Iterable[str] = NULL_TOKENS) -> DataFrame:
    """Every line of one report table over all its quarters, kept or not, from one scan.

    Columns: the fixed columns as strings (null where a layout lacks one), year_quarter,
    reason (``ok`` for kept lines) and the text of irregular lines.  Text in ``missing``
    becomes null; pass an empty sequence to keep such text (country code NA, for example).
    """
    wanted, missing = REPORT_COLUMNS[table], tuple(missing)

    def cell(name: str, header: tuple[str, ...]) -> Column:
        if name not in header:
            return F.lit(None).cast("string").alias(name)
        value = F.col(name)
        return (null_tokens(value, missing) if missing else value).alias(name)

    files = [f for f in files if f.table == table]
    in_order = _open_reports(spark, files)
    parts = []
    for header, own in _layouts(spark, files).items():
        for parse, open_ in ((_parsed, False), (_parsed_in_order, True)):
            paths = [f.path for f in own if ((f.table, f.year, f.quarter) in in_order) == open_]
            if paths:
                parts.append(parse(spark, paths, header).select(
                    *[cell(c, header) for c in wanted], "year_quarter", "reason", F.col(_RAW).alias("line")))
    if not parts:
        return spark.createDataFrame(
            [], string_schema([*wanted, "year_quarter", "reason", "line"]))
    return reduce(DataFrame.unionByName, parts)


def kept_rows(parsed: DataFrame) -> DataFrame:
    """Lines that are kept, without those that are null in every column."""
    wanted = [c for c in parsed.columns if c not in ("year_quarter", "reason", "line")]
    return parsed.where(F.col("reason") == KEPT).drop("reason", "line").na.drop("all", subset=wanted)


def rejected_rows(parsed: DataFrame) -> DataFrame:
    """Lines that are left out: quarter, reason and text."""
    # The parser wants a data column in every query; the length test is always true.
    data = F.length(F.coalesce(parsed.columns[0], F.lit(""))) >= 0
    return parsed.where((F.col("reason") != KEPT) & data).select("year_quarter", "reason", "line")


def read_report_table(spark: SparkSession, table: str, files: Iterable[ReportFile],
                      missing: Iterable[str] = NULL_TOKENS) -> DataFrame:
    return kept_rows(parse_report_table(spark, table, files, missing))


def read_reports(spark: SparkSession, base_dir: str, years: Iterable[int] = YEARS,
                 missing: Iterable[str] = NULL_TOKENS) -> CaseTables:
    """All six tables of a folder of quarterly files."""
    files = find_report_files(spark, base_dir, years=years)
    return CaseTables(versioned=partial(has_column, spark, "demo", "caseversion", files),
                      **{t: partial(read_report_table, spark, t, files, missing) for t in REPORT_TABLES})


def write_report_files(tables: CaseTables, base_dir: str) -> None:
    """Quarterly files in the layout read above: one folder of parts per table and quarter.

    Blanks and tabs around values are kept.  A character that the encoding lacks stops the run.
    """
    for name, df in tables.items():
        year, quarter = F.substring("year_quarter", 3, 2), F.substring("year_quarter", 7, 1)
        report = F.concat(F.lit(name.upper()), year, F.lit("Q"), quarter, F.lit(".txt"))

        def encodable(column: str) -> Column:
            value = F.col(column)
            fits = value.rlike(r"^[\x{00}-\x{ff}]*$") | value.isNull()
            message = F.concat(F.lit(f"no {ENCODING} text in {column}: "), value)
            return F.when(fits, value).otherwise(F.raise_error(message)).alias(column)

        (df.select(*map(encodable, REPORT_COLUMNS[name]), report.alias("report"))
         .hint("rebalance", "report")  # whole reports together, large ones split
         .write.partitionBy("report").option("sep", DELIMITER).option("encoding", ENCODING)
         .option("escape", QUOTE).option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).option("header", True).csv(f"{base_dir}/{name}"))
