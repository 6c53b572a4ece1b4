"""Reservation export files (Shift_JIS CSV with a header row).

All stores' files are read together, each bound by its *own* header: columns
may stand in any order, be missing or be unknown, per file. Two passes over
the lines, both split freely (no file is one task's work):

1. per file: its header line, whether every line has as many fields as the
   header (commas outside quotes are counted, nothing is parsed), and whether
   a quoted field goes on in the next line;
2. the lines of the good files, parsed by Spark's CSV parser as records of
   their file's width, each field picked by the place its header gives it.

Files with line breaks inside quotes are read by Spark's ``multiLine`` reader
instead, one task a file, and written once, as their records are counted and
read. A file with a ragged record is rejected as a whole and alone.

Quoting: a field in double quotes may hold commas, doubled quotes and line
breaks; a backslash is an ordinary character (it is the second byte of many
Shift_JIS characters and the yen sign). Blanks around unquoted fields go.
Blank lines are skipped; a record equal to the header counts as a header.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bookflow.schema import CSV_ENCODING
from bookflow.session import configure, materialize

FILE = "_file_path"
# A comma (one is put before the line) and a quoted field after it.
_QUOTED = r',[ \t]*+"[^"]*+(?:""[^"]*+)*+"'
# How a record is read, whether from a line or from a file.
_CSV = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true", "mode": "PERMISSIVE"}


def _columns(width: int) -> str:
    return ", ".join(f"c{i} string" for i in range(width))


def _record(cell, width: int) -> Column:
    """A parsed record's fields in order; an empty cell is ''."""
    return F.array(*(F.coalesce(cell(f"c{i}"), F.lit("")) for i in range(width)))


def _parsed(line: Column, widths: list[int]) -> Column:
    """The fields of one CSV line that has ``width`` of them (a column; one of ``widths``)."""
    out = F.lit(None).cast("array<string>")
    for w in widths:
        parsed = F.array(F.from_csv(line, _columns(w), _CSV))  # bound once, read by field
        out = F.when(F.col("width") == w, F.transform(parsed, lambda r: _record(r.getField, w))[0]).otherwise(out)
    return out


def _text_lines(spark: SparkSession, path: str, encoding: str) -> tuple[DataFrame, list[str]]:
    """Non-blank decoded lines with file and split start; and the folder columns."""
    raw = spark.read.text(path)
    folders = [c for c in raw.columns if c != "value"]
    lines = raw.select(
        F.regexp_replace(F.decode(F.col("value").cast("binary"), encoding), "^\ufeff", "").alias("_line"),
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias("_start"),
        *[F.col(f"`{c}`").cast("string").alias(c) for c in folders],
    )
    return lines.filter(F.trim("_line") != ""), folders


def _occurrences(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def file_headers(spark: SparkSession, path: str, encoding: str = CSV_ENCODING) -> DataFrame:
    """One row per file: folder columns, ``header_line``, its ``width``,
    ``open_lines`` (whose last quote stays open) and ``bad_lines`` (whose
    field count differs from the header's). Lines are counted per (file, field
    count) before the shuffle, so a store with most of the lines ships a few
    rows per task."""
    lines, folders = _text_lines(spark, path, encoding)
    place = F.struct("_start", F.monotonically_increasing_id().alias("n"))  # a file's line order
    line = F.concat(F.lit(","), F.col("_line"))
    quoted = F.col("_line").contains('"')
    outside = F.when(quoted, F.regexp_replace(line, _QUOTED, ",")).otherwise(line)
    shapes = (
        lines.withColumn("_outside", outside)
        .withColumns({"width": _occurrences(F.col("_outside"), ","), "open": quoted & F.col("_outside").rlike(r',[ \t]*+"')})
        .select(FILE, *folders, F.col("width"), F.col("open"), "_line", place.alias("place"))
        .groupBy(FILE, *folders, "width", "open")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("place", "_line")).alias("first"))
    )
    files = shapes.groupBy(FILE, *folders).agg(
        F.min(F.struct(F.col("first.place"), F.col("first._line").alias("line"), "width", "open")).alias("head"),
        F.collect_list(F.struct("width", "n")).alias("shapes"),  # a few field counts a file
        F.sum(F.when(F.col("open"), F.col("n")).otherwise(0)).alias("open_lines"),
    )
    ragged = F.aggregate(F.filter("shapes", lambda s: s["width"] != F.col("head.width")), F.lit(0).cast("bigint"), lambda a, s: a + s["n"])
    return files.select(FILE, *folders, F.col("head.line").alias("header_line"), F.col("head.width").alias("width"),
                        F.col("head.open").alias("open_header"), "open_lines", ragged.alias("bad_lines"))


def _multi_line(spark: SparkSession, path: str, encoding: str, files: DataFrame, folders: list[str]) -> DataFrame | None:
    """The records of the files with line breaks inside quotes: file, folders, fields (NULL: a ragged record), header."""
    found = files.filter("open_lines > 0").select(FILE, "width", "open_header").collect()  # paths, as Spark's listing has them
    out = None
    for w in sorted({r["width"] for r in found}):
        paths = [unquote(r[FILE]) for r in found if r["width"] == w]
        read = (spark.read.schema(f"{_columns(w)}, _ragged string").options(**_CSV).option("columnNameOfCorruptRecord", "_ragged")
                .option("multiLine", True).option("encoding", encoding).option("basePath", path).csv(paths))
        rows = read.select(F.col("_metadata.file_path").alias(FILE), *(F.col(f"`{c}`").cast("string").alias(c) for c in folders),
                           F.when(F.col("_ragged").isNull(), _record(F.col, w)).alias("_fields"), "_ragged")
        # a header with a line break isn't told from a ragged one
        broken = [r[FILE] for r in found if r["width"] == w and r["open_header"]]
        rows = rows.withColumn("_fields", F.when(F.col(FILE).isin(broken), F.lit(None)).otherwise(F.col("_fields"))) if broken else rows
        rows = rows.drop("_ragged")
        out = rows if out is None else out.unionByName(rows)
    return None if out is None else materialize(out, "export-records")


def scan_exports(
    spark: SparkSession, path: str, encoding: str = CSV_ENCODING, columns: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Read every export under ``path``; return (lines, rejected_files).

    ``lines`` has the named ``columns`` (default: every name some accepted
    file's header has) as strings: '' for an empty cell, NULL where the
    line's file has no such column (of a name that repeats in a header the
    first counts); the folder columns (e.g. ``store_id``); and
    ``_file_path``. ``rejected_files`` has one row per rejected file with an
    error text. The per-file facts are written once here, so neither frame
    repeats that pass.
    """
    configure(spark)
    files = materialize(file_headers(spark, path, encoding), "export-headers")
    lines, folders = _text_lines(spark, path, encoding)
    records = _multi_line(spark, path, encoding, files, folders)
    if records is not None:
        ragged = records.groupBy(FILE).agg(F.count_if(F.col("_fields").isNull()).alias("bad_records"))
        # one ragged record can swallow the rest of its file: such a file has one at least
        files = files.join(ragged, FILE, "left").withColumn("bad_lines", F.when(F.col("open_lines") > 0, F.coalesce("bad_records", F.lit(1))).otherwise(F.col("bad_lines"))).drop("bad_records")
        files = materialize(files, "export-headers")
    widths = sorted(r[0] for r in files.filter("bad_lines = 0").select("width").distinct().collect())
    good = files.filter("bad_lines = 0").withColumn("header", _parsed(F.col("header_line"), widths))
    if columns is None:
        columns = sorted(r[0] for r in good.select(F.explode("header")).distinct().collect())
    names = [c for c in columns if c and c not in folders]
    places = good.select(
        FILE, "header_line", "header", "open_lines", "width", *[F.array_position("header", c).alias(f"_p{i}") for i, c in enumerate(names)]
    )
    cells = [F.when(F.col(f"_p{i}") > 0, F.get("_fields", (F.col(f"_p{i}") - 1).cast("int"))).alias(c) for i, c in enumerate(names)]
    bound = lines.join(places.filter("open_lines = 0").drop("header"), FILE).filter(F.col("_line") != F.col("header_line"))
    out = bound.withColumn("_fields", _parsed(F.col("_line"), widths)).select(*cells, *folders, FILE)
    if records is not None:
        more = records.join(places.filter("open_lines > 0"), FILE).filter(F.col("_fields") != F.col("header"))
        out = out.unionByName(more.select(*cells, *folders, FILE))
    rejected = files.filter("bad_lines > 0").select(
        FILE,
        *folders,
        "bad_lines",
        F.concat(F.lit("ragged CSV line(s): "), F.col("bad_lines").cast("string")).alias("error"),
    )
    return out, rejected


def write_exports(df: DataFrame, path: str, encoding: str = CSV_ENCODING, partition_by: str = "store_id") -> None:
    """Append lines as export files (header, given encoding), one folder per
    store; frames with different columns may be written to one path."""
    (
        df.hint("rebalance", partition_by)
        .write.mode("append")
        .partitionBy(partition_by)
        .option("header", True)
        .option("encoding", encoding)
        .option("escape", '"')
        .csv(path)
    )
