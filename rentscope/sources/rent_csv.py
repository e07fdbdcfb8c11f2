"""Rent CSV files in several encodings, and the ingest CSV."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rentscope import schemas
from rentscope.functions.numbers import blank_missing
from rentscope.session import materialise

LEGACY_ENCODINGS = ("big5", "x-windows-950")


#: Stands for a line break inside quotes while lines are cut; from Unicode's private area.
BREAK = "\ue00a"
BYTE_ORDER_MARK = "\ufeff"


@contextmanager
def _all_charsets(spark: SparkSession):
    """Expressions made inside know legacy charsets, and put a mark where bytes have no meaning."""
    needed = {"spark.sql.legacy.javaCharsets": "true", "spark.sql.legacy.codingErrorAction": "true"}
    before = {key: spark.conf.get(key) for key in needed}
    for key, value in needed.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def raw_lines(spark: SparkSession, paths: Sequence[str], multi_line: bool = False) -> DataFrame:
    """file, place (rising within a file), bytes and valid (as UTF-8) of every line that is not blank.

    ``multi_line`` allows line breaks in quoted fields; a file is then read by one task.
    """
    text = spark.read.text(list(paths), wholetext=multi_line)
    lines = text.select(
        F.col("_metadata.file_path").alias("file"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").cast("binary").alias("bytes"),
        F.is_valid_utf8("value").alias("valid"),
        # Only a file's first piece has its header.
        (F.col("_metadata.file_block_start") == 0).alias("first_piece"),
    )
    return lines.where(F.length(F.trim(F.col("bytes").cast("string"))) > 0)


def file_formats(lines: DataFrame) -> DataFrame:
    """file, encoding, head (the place of its header line) and header (its line as bytes); stored.

    The encoding is the first of UTF-8, big5 and cp950 that all lines of the file can be read in, null if
    there is none. Lines are judged where they are and counted before they meet, so one file may be of any
    size and there may be any number of them.
    """
    with _all_charsets(lines.sparkSession):
        readable = {
            name: ~F.contains(F.decode("bytes", name), F.lit("\ufffd")) for name in LEGACY_ENCODINGS
        }
        # Plain ASCII can be read in all of them; most files are UTF-8 and are not tried in others.
        judged = lines.select(
            "file", "place", "bytes", "first_piece", "valid",
            *[F.when(F.col("valid") & (F.length("bytes") == F.length(F.col("bytes").cast("string"))), True)
              .otherwise(test).alias(f"in_{k}") for k, test in enumerate(readable.values())],
        )
        head = F.min_by(F.struct("place", "bytes"), F.when(F.col("first_piece"), F.col("place")))
        files = judged.groupBy("file").agg(
            F.bool_and("valid").alias("valid"),
            *[F.bool_and(f"in_{k}").alias(f"in_{k}") for k in range(len(readable))],
            head.alias("head"),
        )
    encoding = F.when(F.col("valid"), "utf-8")
    for k, name in enumerate(readable):
        encoding = encoding.when(F.col(f"in_{k}"), name)
    files = files.select(
        "file", encoding.alias("encoding"), F.col("head.place").alias("head"), F.col("head.bytes").alias("header")
    )
    return materialise(files, "csv-files")


def _decoded(bytes_: str, encoding: str = "encoding") -> Column:
    legacy = [F.when(F.col(encoding) == name, F.decode(bytes_, name)) for name in LEGACY_ENCODINGS]
    return F.coalesce(*legacy, F.decode(bytes_, "utf-8"))


def _fields(line: Column, width: int) -> Column:
    """The fields of a line. They may be quoted, with quotes in them doubled; a backslash is an ordinary
    character."""
    names = [f"_{k}" for k in range(width)]
    parsed = F.from_csv(line, ", ".join(f"{n} string" for n in names), {"escape": '"'})
    return F.transform(F.array(parsed), lambda row: F.array(*[row[n] for n in names]))[0]


def _cut(text: Column) -> Column:
    """The lines of a text; line breaks inside quotes are kept under a mark."""
    whole = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    parts = F.transform(
        F.split(whole, '"'),
        lambda part, k: F.when(k % 2 == 1, F.replace(part, F.lit("\n"), F.lit(BREAK))).otherwise(part),
    )
    return F.split(F.array_join(parts, '"'), "\n")


def _table(spark: SparkSession, paths: Sequence[str], multi_line: bool = False) -> DataFrame:
    """All columns of all files as text, each file read by its own encoding and header.

    What the driver sees is the number of files, the names of columns, and a few files that nobody can read.
    """
    lines = raw_lines(spark, paths, multi_line)
    files = file_formats(lines)
    unread = files.where("encoding is null")
    name = F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B"))).alias("file")
    if some := unread.select(name).take(5):
        raise ValueError(
            f"cannot decode {unread.count()} files, {[r.file for r in some]} among them: "
            f"tried utf-8, {', '.join(LEGACY_ENCODINGS)}"
        )
    with _all_charsets(spark):
        head = _decoded("header")
        if multi_line:
            nonblank = F.filter(_cut(head), lambda line: F.length(F.trim(line)) > 0)
            head = F.get(nonblank, F.lit(0))
        head = F.replace(head, F.lit(BYTE_ORDER_MARK), F.lit(""))
        widest = files.agg(F.max(F.length(F.regexp_replace(head, "[^,]", "")) + 1)).first()[0]
        if widest is None:
            raise FileNotFoundError(f"no CSV file with a header in {paths}")
        cells = _fields(head, widest)
        titles = F.transform(cells, lambda c: F.trim(F.coalesce(c, F.lit(""))))
        files = files.select("file", "encoding", "head", titles.alias("titles"))
        named = files.select(F.posexplode("titles").alias("at", "title")).where("title <> ''")
        # One name a column: as many as the files have different titles.
        order = named.groupBy("title").agg(F.min("at").alias("at")).agg(
            F.array_sort(F.collect_list(F.struct("at", "title"))).alias("all")
        )
        columns = [row.title for row in order.first()["all"]]
        joined = lines.join(files, "file")
        if multi_line:
            # The first line that is not blank is the header; the lines of a file are in one row here.
            full = F.filter(_cut(_decoded("bytes")), lambda line: F.length(F.trim(line)) > 0)
            held = joined.select("titles", full.alias("lines")).where(F.size("lines") > 1)
            rows = held.select("titles", F.explode(F.slice("lines", F.lit(2), F.size("lines") - 1)).alias("line"))
        else:
            rows = joined.where("place <> head").select("titles", _decoded("bytes").alias("line"))
        cells = rows.select("titles", _fields(F.col("line"), widest).alias("cells"))
        return cells.select(
            *[
                F.replace(F.get("cells", F.array_position("titles", title) - 1), F.lit(BREAK), F.lit("\n")).alias(title)
                for title in columns
            ]
        )


def read_rent_csv(spark: SparkSession, *paths: str, multi_line: bool = False) -> DataFrame:
    """All columns as text, clean names, missing-value words as null.

    Files may differ in encoding (UTF-8, big5, cp950), in their columns and in the order of these. A
    column that a file doesn't have is null there; of columns with one name the first counts.
    """
    raw = _table(spark, paths, multi_line)
    return raw.select([blank_missing(F.col(f"`{c}`")).alias(c) for c in raw.columns])


def read_ingest_csv(spark: SparkSession, *paths: str, multi_line: bool = False) -> DataFrame:
    """Ingest-ready transactions as text columns; names decide, not positions."""
    return read_rent_csv(spark, *paths, multi_line=multi_line)


def with_columns(df: DataFrame, names: Sequence[str] = schemas.RAW_RENT_COLUMNS) -> DataFrame:
    """Add the named columns that are missing, as null text."""
    missing = {n: F.lit(None).cast("string") for n in names if n not in df.columns}
    return df.withColumns(missing) if missing else df
