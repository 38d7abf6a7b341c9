"""File scans and writes: CSV, JSON, Parquet, Avro, stage folders, bulk copy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martlet.functions.text import null_token
from martlet.session import written

CORRUPT = "_corrupt_record"
# Reader options of the text file format: comma, double quote, UTF-8; compressed
# files are recognised by their suffix.
CSV_OPTIONS = {
    "sep": ",", "quote": '"', "escape": '"', "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def _text_schema(columns: list[str]) -> str:
    return ", ".join(f"`{c}` string" for c in columns)


def read_csv(spark: SparkSession, path: str, columns: list[str], header: bool = True) -> DataFrame:
    """All-text scan; the null tokens become NULL in every column."""
    raw = (
        spark.read.options(**CSV_OPTIONS)
        .option("header", header)
        .option("enforceSchema", True)
        .schema(_text_schema(columns))
        .csv(path)
    )
    return raw.select(*[null_token(c).alias(c) for c in columns])


def write_csv(df: DataFrame, path: str) -> str:
    """One folder of CSV files with headers, written by all tasks."""
    df.write.options(**CSV_OPTIONS).option("header", True).option("emptyValue", "").csv(path)
    return path


def copy_rows(
    spark: SparkSession, path: str, width: int, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Positional scan ``c1 .. cN``: (readable rows, rows refused with their text).

    A row with too few or too many fields is refused; the load goes on.
    """
    columns = [f"c{i}" for i in range(1, width + 1)]
    raw = (
        spark.read.options(**CSV_OPTIONS)
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", False)  # fields are counted even if few are used
        .schema(_text_schema([*columns, CORRUPT]))
        .csv(path)
    )
    good = raw.filter(F.col(CORRUPT).isNull()).select(
        *[null_token(c).alias(c) for c in columns]
    )
    # Spark does not answer queries on the refused text alone, so the filter also
    # reads a parsed column, in a way that holds for every row.
    parsed = F.length(F.coalesce("c1", F.lit(""))) >= 0
    return good, raw.filter(F.col(CORRUPT).isNotNull() & parsed).select(CORRUPT)


def refused_rows(spark: SparkSession, path: str, width: int, header: bool = True) -> DataFrame:
    """The rows ``copy_rows`` refuses, as an account: ``file_name, row_number,
    n_fields, reason, record``.

    Rows are numbered from 1 in each file, its header not counted; empty lines are no
    rows. Commas between quotes separate nothing.
    """
    columns = [f"c{i}" for i in range(1, width + 1)]
    raw = (
        spark.read.options(**CSV_OPTIONS)
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", False)
        .schema(_text_schema([*columns, CORRUPT]))
        .csv(path)
    )
    bare = F.regexp_replace("record", '"[^"]*"', "")
    found = F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1
    text = F.concat(
        F.when(F.col("n_fields") < width, "too few").otherwise("too many"),
        F.lit(f" fields: {width} expected, "), F.col("n_fields").cast("string"), F.lit(" found"),
    )
    # Every row is placed, so that a refused one knows its number; good rows keep no text.
    rows = _numbered(raw.select(F.col(CORRUPT).alias("record"), F.coalesce("c1", F.lit("")).alias("c1")))
    return (
        rows.filter("record IS NOT NULL")
        .withColumn("n_fields", found)
        .select("file_name", "row_number", "n_fields", text.alias("reason"), "record")
    )


def file_accounts(
    spark: SparkSession, path: str, file_format: str, schema: str, pattern: str = "*",
    **options: str,
) -> DataFrame:
    """One row for each file ``read_stage`` is given: ``path, bytes, n_rows, n_refused,
    checksum, status``.

    The listing names every matching file, the scan those that gave rows; a file that
    is listed and gave none, because it is broken or holds none, is 'NO ROWS'. Spark
    lists no file of zero bytes. Rows that do not fit the schema (text formats) are counted as refused. Every column is read, so
    that a broken one shows; a file that breaks off midway counts the rows before that.
    ``checksum`` is the exclusive or of the row hashes, to hold against another load.
    """
    is_text = file_format in ("csv", "json")
    wanted = f"{schema}, {CORRUPT} string" if is_text else schema
    if is_text:
        options = {
            "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "columnPruning": "false",
            **options,
        }
    rows = read_stage(spark, path, file_format, wanted, pattern, **options)
    refused = F.col(CORRUPT).isNotNull() if is_text else F.lit(False)
    read = rows.select(
        F.col("_metadata.file_path").alias("path"),
        F.xxhash64(*rows.columns).alias("hash"),
        refused.alias("refused"),
    ).groupBy("path").agg(
        F.count_if(~F.col("refused")).alias("n_rows"),
        F.count_if("refused").alias("n_refused"),
        F.bit_xor("hash").alias("checksum"),
    )
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.col("_metadata.file_path").alias("path"), F.col("length").alias("bytes"))
    )
    status = (
        F.when(F.col("checksum").isNull(), "NO ROWS")
        .when(F.col("n_refused") > 0, "REFUSED ROWS")
        .otherwise("LOADED")
    )
    # Written once: if a caller drops the checksum, the scan must still read all columns.
    return written(
        listed.join(read, "path", "left").select(
            "path",
            "bytes",
            F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
            F.coalesce("n_refused", F.lit(0)).alias("n_refused"),
            "checksum",
            status.alias("status"),
        ),
        "file-accounts",
    )


def project(rows: DataFrame, **columns: Column) -> DataFrame:
    return rows.select(*[c.alias(name) for name, c in columns.items()])


def read_json(spark: SparkSession, path: str, schema: str, array_files: bool = False) -> DataFrame:
    """JSON scan. Files holding one outer array need ``array_files``: such a file
    cannot be split, so large inputs should come as many files or as lines."""
    return spark.read.schema(schema).option("multiLine", array_files).json(path)


def has_duplicate_keys(x) -> Column:
    """True for a JSON object text that names a key twice."""
    keys = F.json_object_keys(F.col(x) if isinstance(x, str) else x)
    return F.size(F.array_distinct(keys)) < F.size(keys)


def read_parquet(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def has_avro(spark: SparkSession) -> bool:
    """Whether the session was started with the Avro data source package."""
    try:
        spark.read.format("avro").schema("x int").load([])
    except Exception as missing:  # the class name of the error differs by version
        return "avro" not in str(missing).lower()
    return True


def read_avro(spark: SparkSession, path: str) -> DataFrame:
    if not has_avro(spark):
        raise RuntimeError("reading Avro needs the spark-avro package on the session")
    return spark.read.format("avro").load(path)


def read_stage(
    spark: SparkSession, path: str, file_format: str, schema: str, pattern: str = "*",
    max_partition_bytes: int | None = None, **options: str,
) -> DataFrame:
    """All files below a folder whose names match; unreadable files are skipped, and
    ``file_accounts`` names them."""
    if max_partition_bytes is not None:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(max_partition_bytes))
    return (
        spark.read.format(file_format)
        .schema(schema)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .option("ignoreCorruptFiles", "true")
        .options(**options)
        .load(path)
    )


def _numbered(raw: DataFrame) -> DataFrame:
    """``raw``, a file scan, with the file name and the row's number in its file.

    A file may be read as many splits. Rows of one split are consecutive in one
    task, so a row's number is its place in the split plus the sizes of the file's
    earlier splits; only one row per split is ever sorted.
    """
    placed = written(
        raw.select(
            "*",
            F.col("_metadata.file_name").alias("file_name"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_place"),
        ),
        "staged",
    )
    splits = placed.groupBy("file_name", "_block").agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    earlier = F.coalesce(
        F.expr(
            "sum(_n) OVER (PARTITION BY file_name ORDER BY _block "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        ),
        F.lit(0),
    )
    offsets = splits.select("file_name", "_block", "_first", earlier.alias("_before"))
    return (
        placed.join(offsets, ["file_name", "_block"])
        .withColumn("row_number", F.col("_before") + F.col("_place") - F.col("_first") + 1)
        .drop("_block", "_place", "_first", "_before")
    )


def with_lineage(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """CSV rows with load time, file name and the row's number in its file."""
    raw = (
        spark.read.options(**CSV_OPTIONS).option("header", True).schema(_text_schema(columns)).csv(path)
    )
    return (
        _numbered(raw.select(*[null_token(c).alias(c) for c in columns]))
        .withColumn("load_timestamp", F.current_timestamp())
        .select(*columns, "load_timestamp", "file_name", "row_number")
    )
