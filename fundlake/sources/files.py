"""CSV and folder scans, price payloads, and the sinks."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.functions.coerce import formatted_date, iso_date, iso_text, lenient_double, month_text, nulls_for_tokens, strip_headers
from fundlake.schemas import LIVE_SCHEMES

#: Rows of a compressed part at most. No reader splits such a file, so this bounds its task; up to 1,000 parts of a task follow each other by name.
ROWS_A_PART = 1_000_000

PAYLOAD_SCHEMA = "meta STRUCT<scheme_code: BIGINT, scheme_name: STRING>, data ARRAY<STRUCT<date: STRING, nav: STRING>>"


def read_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns as text with NULL for missing tokens, plus ``ingest_seq``.

    Names come from the header; ``columns`` selects by name, so the order in the
    file does not matter. ``ingest_seq`` orders rows as they lie in the files. Types are given later, by explicit rules, so no
    inference pass over the data is needed.
    """
    raw = spark.read.option("header", True).option("mode", "FAILFAST").option("escape", '"').csv(path)
    names = raw.columns
    placed = _with_arrival(raw).select(*[F.col(f"`{name}`") for name in names], "ingest_seq")
    named = strip_headers(placed)
    return nulls_for_tokens(named.select(*columns, "ingest_seq") if columns else named)


def _with_arrival(raw: DataFrame) -> DataFrame:
    """Add ``ingest_seq``, one 64-bit number: file by name, then block of the file, then row of the task.

    A task reads blocks of a file from their start, so its row counter orders the rows of a block, and starts of blocks lie at
    least ``unit`` bytes apart. Sorts and comparisons see a number where a path stood.
    """
    spark = raw.sparkSession
    # The listing writes local paths with an empty host, the rows without.
    paths = sorted(re.sub("^file:/+", "file:/", path) for path in raw.inputFiles())
    size = lambda name: int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)))
    most = size("spark.sql.files.maxPartitionBytes")
    unit = max(min(most, size("spark.sql.files.openCostInBytes")), 1)
    file_bits = max(len(paths) - 1, 0).bit_length()
    # A row takes a byte at least; a file that cannot be split may be larger than a block.
    row_bits = 33 if any(path.endswith((".gz", ".deflate", ".snappy", ".zst", ".xz")) for path in paths) else min(most.bit_length() + 1, 33)
    block_bits = 63 - file_bits - row_bits
    numbered = raw.select("*", F.col("_metadata.file_path").alias("__path"), F.col("_metadata.file_block_start").alias("__block"))
    if len(paths) > 1:
        # As many rows as the driver has listed files; made without Python workers.
        files = spark.range(1).select(F.posexplode(F.array(*map(F.lit, paths))).alias("__file", "__path")).select("__path", F.col("__file").cast("long"))
        numbered = numbered.join(F.broadcast(files), "__path", "left")
    else:
        numbered = numbered.withColumn("__file", F.lit(0).cast("long"))
    block = F.floor(F.col("__block") / unit).cast("long")
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    fits = F.col("__file").isNotNull() & (block < (1 << block_bits)) & (row < (1 << row_bits))
    packed = F.shiftleft(F.shiftleft(F.col("__file"), block_bits).bitwiseOR(block), row_bits).bitwiseOR(row)
    return numbered.withColumn("ingest_seq", F.when(fits, packed).otherwise(F.raise_error(F.lit("arrival position does not fit 64 bits")).cast("long")))


def read_csv_with_dates(
    spark: SparkSession, path: str, dates: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    df = read_csv(spark, path, columns)
    return df.withColumns({name: iso_date(name) for name in dates})


def list_csv_files(spark: SparkSession, folder: str) -> list[str]:
    """Sorted ``*.csv`` entries of a folder; an absent or empty folder is an error.

    An entry may be one file or a folder of parts written by Spark.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(place):
        raise FileNotFoundError(f"Folder not found: {folder}")
    paths = sorted(
        entry.getPath().toString() for entry in store.listStatus(place) if entry.getPath().getName().endswith(".csv"))
    if not paths:
        raise FileNotFoundError(f"No CSV files found in: {folder}")
    return paths


def scan_folder(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """One table per CSV file, and the reason for each file that cannot be read."""
    tables, failures = {}, {}
    for path in list_csv_files(spark, folder):
        name = path.rsplit("/", 1)[-1]
        try:
            table = read_csv(spark, path)
            if table.columns == ["ingest_seq"]:
                raise ValueError("no columns to read")
            tables[name] = table
        except (PySparkException, ValueError) as problem:
            failures[name] = str(problem).splitlines()[0]
    return tables, failures


def _entries(parsed: DataFrame, pattern: str) -> DataFrame:
    rows = parsed.select(F.col("meta.scheme_code").alias("scheme_code"), F.inline("data"))
    return rows.select("scheme_code", formatted_date("date", pattern).alias("date"), lenient_double("nav").alias("nav"))


def payload_rows(documents: DataFrame, body: str = "body", pattern: str = "dd-MM-yyyy") -> DataFrame:
    """Rows of price payloads ``{meta, data: [{date, nav}]}`` held as text."""
    return _entries(documents.select(F.from_json(F.col(body), PAYLOAD_SCHEMA).alias("p")).select("p.*"), pattern)


def payload_status(documents: DataFrame, body: str = "body") -> DataFrame:
    """Rows per payload; a payload without data is reported, not an error."""
    parsed = documents.select(F.from_json(F.col(body), PAYLOAD_SCHEMA).alias("p"))
    return parsed.select(
        F.col("p.meta.scheme_code").alias("scheme_code"),
        F.coalesce(F.size("p.data"), F.lit(0)).cast("long").alias("records"),
        F.when(F.col("p.data").isNull(), "No NAV data").otherwise("ok").alias("status"),
    )


def read_payloads(spark: SparkSession, landing: str, pattern: str = "dd-MM-yyyy") -> DataFrame:
    """Landed payload files, one JSON document each."""
    return _entries(spark.read.schema(PAYLOAD_SCHEMA).option("multiLine", True).json(landing), pattern)


def tag_schemes(rows: DataFrame, schemes: Mapping[str, int] = LIVE_SCHEMES) -> DataFrame:
    """Add the name under which each scheme code is pulled; other codes are left out."""
    names = F.create_map(*[F.lit(v) for name, code in schemes.items() for v in (int(code), name)])
    tagged = rows.withColumn("scheme_name", F.try_element_at(names, F.col("scheme_code").cast("int")))
    return tagged.where(F.col("scheme_name").isNotNull())


def formatted(df: DataFrame, dates: Iterable[str] = (), months: Iterable[str] = ()) -> DataFrame:
    """Date columns as ISO text and month columns as ``yyyy-MM`` text."""
    shown = {name: iso_text(name) for name in dates if name in df.columns}
    shown |= {name: month_text(name) for name in months if name in df.columns}
    return df.withColumns(shown) if shown else df


def write_csv(
    df: DataFrame, path: str, dates: Iterable[str] = (), months: Iterable[str] = (), order: Sequence[str] = (),
    compression: str | None = None,
) -> None:
    """CSV parts with header; ``order`` range-sorts so that parts follow each other.

    ``compression`` is a codec of Spark's CSV writer; such parts hold ``ROWS_A_PART`` rows at most.
    """
    writer = _csv_writer(formatted(df.orderBy(*order) if order else df, dates, months))
    if compression:
        writer = writer.options(**{"compression": compression, "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": ROWS_A_PART})
    writer.csv(path)


def _csv_writer(df: DataFrame):
    """Text is written as it is: blanks at its ends are data."""
    options = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"'}
    return df.write.mode("overwrite").options(**options)


def in_order(df: DataFrame, columns: Sequence[str], order: str) -> DataFrame:
    """``columns`` as text, sorted by ``order``.

    What is exchanged is one line a row: short texts in columns of their own take up to twice the room. The line is a JSON
    list, which unlike one of CSV tells empty texts from missing ones.
    """
    line = F.to_json(F.array(*[F.col(name).cast("string") for name in columns]))
    lines = df.select(order, line.alias("__line")).orderBy(order)
    row = lines.select(F.from_json("__line", "ARRAY<STRING>", {"mode": "FAILFAST"}).alias("__row"))
    return row.select(*[F.col("__row")[i].alias(name) for i, name in enumerate(columns)])


def write_per_scheme(df: DataFrame, path: str, scheme: str = "scheme_name") -> None:
    """One folder per scheme, replaced as a whole.

    Rebalancing brings a scheme's rows together so that few files are written, and
    splits a scheme that is too large for one task.
    """
    _csv_writer(df.hint("rebalance", scheme)).partitionBy(scheme).csv(path)


def write_table(df: DataFrame, path: str) -> None:
    """Full refresh of one warehouse table."""
    df.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_text(df: DataFrame, path: str) -> None:
    """Rendered report lines, one string column."""
    df.write.mode("overwrite").text(path)
