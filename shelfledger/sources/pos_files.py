"""Point-of-sale CSV drops.

A drop is a folder tree of files named ``{feed}_{location}_{yyyymmdd}.csv`` in folders that end
in ``_{yyyymm}``. A file may also be a directory of that name holding part files, as Spark
writes them; all its parts are one file here.

Lines are read whole and then parsed, so a row that does not fit keeps its line as it stands in
the file. Headers and rows are parsed by the same CSV rules.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyarrow.fs import FileSystem
from pyarrow.lib import ArrowException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfledger.operators.aggregates import first_by_priority
from shelfledger.operators.columns import snake
from shelfledger.session import scratch_path

# Where file and month folder stand in a path.
FILE_STEM = r"([^/=]+_[^/_=]+_[0-9]{8})\.csv"
FILE_SOURCE = r"^(.*?[^/=]+_[^/_=]+_[0-9]{8}\.csv)"
MONTH_FOLDER = r"^(.*?_[0-9]{6})/"

HEAD_BYTES = 4096
RANGE_BYTES = 16 << 20  # of a file that one task reads at a time
CORRUPT = "_corrupt_record"
NUMBER = "decimal(18,4)"
QUOTED_FIELD = r'(^|,)"[^"]*+(?:""[^"]*+)*+"(?=,|$)'


def number(text: Column, dtype: str = NUMBER) -> Column:
    """A number with thousands separators; NULL where the text is none."""
    return F.regexp_replace(F.trim(text), ",", "").try_cast(dtype)


def _lines(spark: SparkSession, roots: str | Sequence[str], glob: str, on_error: str) -> DataFrame:
    """Every line after the header of each file, whole: the separator is one that no line has.

    A line that has it all the same comes from the reader's own corrupt column.
    """
    if on_error not in ("permissive", "fail"):
        raise ValueError(f"on_error must be permissive or fail, got {on_error!r}")
    skip = on_error == "permissive"
    rows = (
        spark.read.option("header", True).option("sep", "\u0001").option("quote", "").option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("ignoreCorruptFiles", skip).option("ignoreMissingFiles", skip)
        .option("recursiveFileLookup", True).option("pathGlobFilter", glob)
        .schema(f"line string, {CORRUPT} string").csv(roots)
    )
    return rows.select(
        F.coalesce(CORRUPT, "line").alias("_line"), F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_modification_time").alias("_modified"),
    )


def _field_count(line: Column) -> Column:
    """Number of fields; 0 where a quoted field does not end."""
    rest = F.regexp_replace(line, QUOTED_FIELD, "$1")
    return F.when(rest.rlike('(^|,)"'), 0).otherwise(F.regexp_count(rest, F.lit(",")) + 1)


def _fields(line: Column, width: int) -> Column:
    """The line's fields as an array of ``width``, NULL where empty or missing."""
    schema = ", ".join(f"c{i} string" for i in range(width))
    parsed = F.from_csv(line, schema, {"escape": '"', "mode": "PERMISSIVE"})
    return F.array(*[parsed[f"c{i}"] for i in range(width)])


def _first_lines(files: DataFrame) -> DataFrame:
    """The first line with content of each file, NULL where a task cannot open the file by itself.

    Each task reads no further than the line's end.
    """

    # nested, so that it is shipped to the executors by value and they need not have this package
    def first_line(path: str) -> str | None:
        try:
            system, inner = FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))
            with system.open_input_stream(inner) as stream:
                head, more = b"", True
                while more and b"\n" not in head.lstrip(b"\xef\xbb\xbf\r\n\t "):
                    more = stream.read(HEAD_BYTES)
                    head += more
        except (OSError, ArrowException):
            return None
        return head.decode("utf-8-sig", "replace").lstrip().partition("\n")[0].rstrip("\r")

    def first_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for found in batches:
            yield pd.DataFrame({"file_path": found["file_path"], "header": found["file_path"].map(first_line)})

    return files.select("file_path").mapInPandas(first_lines, "file_path string, header string")


def _lines_of(files: DataFrame, on_error: str) -> DataFrame:
    """Every line after the header of the files of a path table, opened by the tasks that get their rows.

    A file is read in ranges of ``RANGE_BYTES``; a line belongs to the range it begins in. Lines without
    content are left out, as Spark's reader does.
    """
    skip, blank = on_error == "permissive", b"\xef\xbb\xbf\r\n\t "

    def lines(path: str, start: int, size: int) -> list[str]:
        system, inner = FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))
        with system.open_input_file(inner) as stream:
            head, more = b"", True
            while more and not head.strip(blank):
                more = stream.read(HEAD_BYTES)
                head += more
            header = head[: len(head) - len(head.lstrip(blank))].rfind(b"\n") + 1
            stream.seek(max(start - 1, 0))
            data, more = stream.read(size + (start > 0)), True
            while data and more and not data.endswith(b"\n"):
                more = stream.read(HEAD_BYTES)
                end = more.find(b"\n")
                data += more if end < 0 else more[: end + 1]
        if start:
            data = data[data.find(b"\n") + 1 :] if b"\n" in data else b""
        text = data.decode("utf-8-sig" if not start else "utf-8", "replace")
        found = [x for x in re.split("\r\n|\n|\r", text) if x.strip()]
        return found[1:] if start <= header < start + size else found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, modified, start in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                try:
                    found = lines(path, start, RANGE_BYTES)
                except (OSError, ArrowException):
                    if not skip:
                        raise
                    found = []
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.string()), pa.array([path] * len(found), pa.string()),
                     pa.array([modified.as_py()] * len(found), batch.schema.field(1).type)],
                    ["_line", "_path", "_modified"],
                )

    last = F.greatest(F.col("length") - 1, F.lit(0))
    ranges = files.select("file_path", "modified", F.explode(F.sequence(F.lit(0).cast("bigint"), last, F.lit(RANGE_BYTES).cast("bigint"))).alias("start"))
    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return ranges.repartition(parts, "file_path", "start").mapInArrow(run, "_line string, _path string, _modified timestamp")


def _scanned_lines(spark: SparkSession, roots: str | Sequence[str], glob: str) -> DataFrame:
    """The first line with content of every file by Spark's reader, for storage only it can open."""
    return (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(roots)
        .select(F.regexp_replace("value", "^\ufeff", "").alias("value"), "_metadata.file_path", "_metadata.file_block_start")
        .withColumn("_at", F.monotonically_increasing_id())
        .filter("file_block_start = 0 and trim(value) <> ''")
        .groupBy("file_path").agg(F.min_by("value", "_at").alias("header"))
    )


def file_headers(
    spark: SparkSession, roots: str | Sequence[str], glob: str = "*.csv", files: DataFrame | None = None
) -> DataFrame:
    """``file_path`` and snake_case column names ``names`` of every file that is not blank.

    The list is stored in the scratch folder, so that its size is known to the joins it goes
    into. Tasks open the files they are given and read one line of each; only where they
    cannot open some, the files are read through Spark. Of equal names in a header, the second is numbered
    ``name_2``, and so on. ``files``: a path table of the files below the roots to look at, by default all.
    """
    schema, kept = "file_path string, header string", scratch_path(spark, "headers")
    _first_lines(drop_files(spark, roots, glob) if files is None else files).write.parquet(kept)
    found = spark.read.schema(schema).parquet(kept)
    closed = found.filter("header IS NULL").select("file_path")
    if not closed.isEmpty():
        late = scratch_path(spark, "headers")
        _scanned_lines(spark, roots, glob).join(closed, "file_path", "left_semi").write.parquet(late)
        found = found.union(spark.read.schema(schema).parquet(late))
    found = found.filter("trim(header) <> ''")
    width = found.agg(F.max(_field_count(F.col("header")))).first()[0] or 1
    tidy = lambda x: F.regexp_replace(F.lower(F.trim(F.coalesce(x, F.lit("")))), "[ -]", "_")
    names = F.transform(F.slice(_fields(F.col("header"), width), F.lit(1), _field_count(F.col("header"))), tidy)
    nth = lambda x, i: F.size(F.filter(F.slice("names", F.lit(1), i), lambda y: y == x)) + 1
    return found.select("file_path", names.alias("names")).select("file_path", F.transform(
        "names", lambda x, i: F.when(nth(x, i) > 1, F.concat(x, F.lit("_"), nth(x, i).cast("string"))).otherwise(x)
    ).alias("names"))


def read_csv_tree(
    spark: SparkSession, roots: str | Sequence[str], columns: Sequence[str] | None = None,
    numeric_cols: Sequence[str] = (), glob: str = "*.csv", header: Sequence[str] | None = None,
    on_error: str = "permissive", number_type: str = NUMBER, files: DataFrame | None = None,
) -> DataFrame:
    """Every CSV file below the roots, matched by header name, whatever the column order.

    ``columns`` are the wanted snake_case names, by default every name found; a column a file
    lacks is NULL. With ``header`` given, all files are taken to have it and none is looked at
    beforehand. Otherwise the headers are written to the scratch folder first; if all agree,
    positions are fixed, else each row is mapped by its file's header, and both read rows alike.

    Rows with too few or too many fields or with an unreadable number are kept, with their line
    in ``_corrupt_record``; with ``on_error="fail"`` the first one is an error, as is a file that
    cannot be read. ``_path`` and ``_modified`` carry the file's metadata.

    ``files`` is a path table, rows of ``drop_files``: only these are read, by the tasks that get its rows, so
    neither are paths brought to the driver nor other files opened. Where tasks cannot open files by
    themselves, Spark's reader reads all below the roots, and lines of other files are left out.
    """
    layouts = None
    if header is None:
        layouts = file_headers(spark, roots, glob, files)
        common = layouts.select("names").distinct().limit(2).collect()
        if len(common) == 1:
            header = common[0].names
    else:
        header = [snake(c) for c in header]
    if header is not None:
        width, found = len(header), list(header)
    else:
        width = layouts.agg(F.max(F.size("names"))).first()[0] or 1
        found = [] if columns else sorted(
            r[0] for r in layouts.select(F.explode("names")).distinct().collect()
        )
    wanted = list(columns) if columns else found

    if files is None:
        rows = _lines(spark, roots, glob, on_error)
    elif _first_lines(files.limit(1)).filter("header IS NULL").isEmpty():
        rows = _lines_of(files, on_error)
    else:
        rows = _lines(spark, roots, glob, on_error).join(files.select(F.col("file_path").alias("_path")), "_path", "left_semi")
    if header is not None:
        places = F.array(*[F.lit(header.index(c) if c in header else None).cast("int") for c in wanted])
        rows = rows.withColumns({"_width": F.lit(width), "_at": places})
    else:
        names = F.transform(F.array(*[F.lit(c) for c in wanted]), lambda c: F.array_position("names", c).cast("int") - 1)
        rows = rows.join(
            layouts.select(F.col("file_path").alias("_of"), F.size("names").alias("_width"), names.alias("_at")),
            F.col("_path") == F.col("_of"), "left",
        )
    values = rows.select("_line", "_path", "_modified", "_width", "_at", _fields(F.col("_line"), width).alias("_values"))
    place = lambda i: F.get("_at", F.lit(i))
    out = values.select(
        "_line", "_path", "_modified", F.coalesce(_field_count(F.col("_line")) != F.col("_width"), F.lit(True)).alias("_bad"),
        *[F.when(place(i) >= 0, F.get("_values", place(i))).alias(c) for i, c in enumerate(wanted)],
    )
    typed = {c: number(F.col(c), number_type) for c in numeric_cols if c in wanted}
    bad = F.col("_bad")
    for c, v in typed.items():
        bad = bad | (F.col(c).isNotNull() & v.isNull())
    out = out.withColumn("_bad", bad)
    if on_error == "fail":
        message = F.concat(F.lit("row does not fit its header: "), "_line", F.lit(" in "), "_path")
        out = out.filter(F.when(F.col("_bad"), F.raise_error(message).cast("boolean")).otherwise(True))
    return out.select(
        *[typed[c].alias(c) if c in typed else F.col(c) for c in wanted], "_path", "_modified",
        F.when(F.col("_bad"), F.col("_line")).alias(CORRUPT),
    )


def read_pos_csv(
    spark: SparkSession, paths: str | Sequence[str], numeric_cols: Sequence[str],
    on_error: str = "permissive", number_type: str = NUMBER,
) -> DataFrame:
    """CSV files that share one header, with snake_case columns; another header is an error.

    Rows are read as ``read_csv_tree`` reads them, which takes mixed headers.
    """
    layouts = file_headers(spark, paths, "*").select("names").distinct().limit(2).collect()
    if len(layouts) > 1:
        raise ValueError(f"more than one header: {layouts[0].names} and {layouts[1].names}")
    header = layouts[0].names if layouts else []
    rows = read_csv_tree(spark, paths, None, numeric_cols, "*", header, on_error, number_type)
    return rows.drop("_path", "_modified")


def with_filename_columns(
    df: DataFrame, path: str = "_path", sep: str = "_", parts: dict[str, int] | None = None
) -> DataFrame:
    """Adds columns cut from the file's name; ``date`` is parsed as yyyymmdd."""
    stem = F.split(F.regexp_extract(F.col(path), FILE_STEM, 1), sep)
    for name, at in (parts or {"location": 1, "date": 2}).items():
        value = F.get(stem, F.lit(at))
        df = df.withColumn(name, F.to_date(value, "yyyyMMdd") if name == "date" else value)
    return df


def drop_files(spark: SparkSession, roots: str | Sequence[str], glob: str = "*.csv") -> DataFrame:
    """The path table of a drop, stored in the scratch folder: ``file_path``, ``length``, ``modified``, and the
    ``source``, ``name`` and ``folder`` that a file belongs to. No content is read.

    A file not named as a drop's files are stands under its own path.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob).load(roots)
        .select("path", "length", F.col("modificationTime").alias("modified"), "_metadata.file_path")
    )
    named = lambda column, pattern, other: F.coalesce(F.nullif(F.regexp_extract(column, pattern, 1), F.lit("")), F.col(other))
    table = files.select(
        "file_path", "length", "modified", named("file_path", FILE_SOURCE, "file_path").alias("source"),
        named("path", FILE_STEM, "path").alias("name"), F.regexp_extract("path", MONTH_FOLDER, 1).alias("folder"),
    )
    kept = scratch_path(spark, "paths")
    table.write.parquet(kept)
    return spark.read.schema(table.schema).parquet(kept)


def list_files(files: DataFrame) -> DataFrame:
    """``source``, ``name``, ``folder`` and ``modified`` of the files of a path table, a file in parts as one."""
    return files.groupBy("source", "name", "folder").agg(F.max("modified").alias("modified"))


def latest_version(df: DataFrame, name: str = "name", modified: str = "modified") -> DataFrame:
    """The newest row per name."""
    return first_by_priority(df, [name], [F.col(modified).desc()])


def latest_files(files: DataFrame) -> DataFrame:
    """The rows of a path table that belong to the newest file of each name."""
    return files.join(latest_version(list_files(files)).select("source"), "source", "left_semi")


def reject_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows read and rows that did not fit, per key."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows_read"), F.count(CORRUPT).alias("rows_rejected")
    )
