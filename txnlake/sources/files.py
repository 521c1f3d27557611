"""Raw CSV files as text columns, with the contract on their columns."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession, Window, functions as F, types as T

from txnlake import schemas
from txnlake.functions.lookup import hot_keys, lookup
from txnlake.sources.quoted import OpenQuote, opens_quote, quoted_records, text_lines

_CSV = {"header": "true", "escape": '"', "mode": "PERMISSIVE", "columnPruning": "false"}


class UnreadableFile(Exception):
    """The file is missing, empty or not a table."""


def missing_columns(df: DataFrame, table: str) -> list[str]:
    """Required columns that df lacks, sorted; none for a table without a contract."""
    required = schemas.RAW[table].names if table in schemas.RAW else []
    return sorted(set(required) - set(df.columns))


def validate_schema(df: DataFrame, table: str) -> tuple[bool, list[str]]:
    """(contract holds, missing columns). Extra columns are fine."""
    missing = missing_columns(df, table)
    return not missing, missing


def _has_quoted_line_ends(spark: SparkSession, path: str) -> bool:
    """True when some line ends inside quotes, so that lines are not rows."""
    return not text_lines(spark, path).filter(opens_quote(F.col("value"))).isEmpty()


def _ddl(names: list[str]) -> str:
    return ", ".join(f"`{name.replace('`', '``')}` string" for name in names)


def _parsed_records(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Columns, `_corrupt`, `_row_seq` and `_file` of files with quoted line ends, read by many tasks."""
    records = quoted_records(spark, path)
    header = F.from_csv("value", _ddl([f"c{i}" for i in range(len(names) + 1)]), {"escape": '"'})
    same = [F.lower(F.coalesce(header[f"c{i}"], F.lit(""))) == name.lower() for i, name in enumerate(names)]
    agrees = F.forall(F.array(*same, header[f"c{len(names)}"].isNull()), lambda one: one)
    rows = records.filter(F.when(F.col("_is_header") & ~agrees, F.raise_error(F.concat(
        F.lit("the header differs from that of another file: "), "value")).cast("boolean")).otherwise(~F.col("_is_header")))
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    fields = F.from_csv("value", _ddl([*names, "_corrupt"]), options)
    return rows.select(fields.alias("_fields"), "_row_seq", "_file").select("_fields.*", "_row_seq", "_file")


def _parsed_lines(reader: DataFrameReader, path: str, names: list[str]) -> DataFrame:
    """The same columns by Spark's own reader of files."""
    # The header is checked against this schema in every file of the path.
    fields = [T.StructField(n, T.StringType()) for n in [*names, "_corrupt"]]
    df = reader.option("enforceSchema", "false").option(
        "columnNameOfCorruptRecord", "_corrupt").schema(T.StructType(fields)).csv(path)
    return df.withColumns({
        "_row_seq": F.col("_metadata.file_block_start")
        + F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1),
        "_file": F.col("_metadata.file_path"),
    })


def read_csv(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """Every column as text, empty fields as '', plus `_row_seq` in file order.

    Files are split over tasks, also where quoted fields hold line ends (LF or CRLF). By default the
    text is looked through once for such fields. `multi_line=False` states that there are none;
    True leaves the file to Spark's reader as a whole, which also knows lines that end in CR alone.
    A row with more fields than the header stops the read when it is reached; a quoted field that
    is never closed makes the file unreadable.
    """
    try:
        quoted = multi_line is None and _has_quoted_line_ends(spark, path)
        reader = spark.read.options(**_CSV).option("multiLine", bool(quoted or multi_line))
        names = reader.csv(path).columns
        if not names:
            raise UnreadableFile(f"No columns to parse from file: {path}")
        if quoted:  # Spark leaves the CR of a CRLF to the last name when a name holds an LF
            names = [*names[:-1], names[-1].removesuffix("\r")]
        df = _parsed_records(spark, path, names) if quoted else _parsed_lines(reader, path, names)
    except (PySparkException, OpenQuote) as error:
        raise UnreadableFile(str(error)) from error

    wider = ", ".join(f"`c{i}` string" for i in range(len(names) + 1))
    overflow = F.from_csv("_corrupt", wider, {"escape": '"'})[f"c{len(names)}"].isNotNull()
    guard = F.when(F.col("_corrupt").isNotNull() & overflow,
                   F.raise_error(F.concat(F.lit("more fields than columns: "), "_corrupt")))
    df = _ordered_by_file(df, path)
    text = [F.coalesce(F.col(f"`{n}`"), F.lit("")).alias(n) for n in names]
    return df.select(F.coalesce(guard.cast("string"), text[0]).alias(names[0]), *text[1:],
                     "_row_seq")


def _ordered_by_file(df: DataFrame, path: str) -> DataFrame:
    """Put the files of a path one after the other, in the order of their names.

    Each file gets a range of places of its own. A row's place in its file is below the file's
    length plus the rows its task has read, and no task reads more bytes than a partition may
    hold or the largest file does. The list of files is a table; only names and lengths are read.
    """
    spark = df.sparkSession
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("_file"), "length")
    if files.count() < 2:
        return df
    partition = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    task = F.greatest(F.lit(partition).cast("long"), files.agg(F.max("length")).scalar())
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("_file", F.coalesce(F.sum(F.col("length") + task).over(before), F.lit(0)).alias("_start"))
    placed = lookup(df, starts, "_file", salt_by="_row_seq", hot=lambda: hot_keys(df, "_file"))
    return placed.withColumn("_row_seq", F.col("_start") + F.col("_row_seq"))
