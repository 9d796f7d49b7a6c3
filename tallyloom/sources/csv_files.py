"""CSV files of the five tables: header row, UTF-8, comma, RFC 4180 quoting.

Columns are addressed by header name, typed explicitly and never inferred. A value that cannot be
typed without a change, a missing required value, or a row with too few or too many fields either
fails the load (strict) or sends the row to quarantine with its raw text and a reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.dates import parse_date, slash_date
from tallyloom.schemas import TABLES, Table
from tallyloom.sources.records import BLOCK, FILE, ROW, cut, has_breaks, read_lines

POSITION = [FILE, BLOCK, ROW]
# The whole text of a row whose fields do not fit the header, NULL for others.
UNFIT = "_unfit"


def _parsed(records: DataFrame, header: list[str], fields: T.StructType) -> DataFrame:
    """Cut records as the fields of the header. A file with another header fails."""
    names = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in fields.fields)
    options = {"escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": UNFIT}
    rows = records.withColumn("_row_of", F.from_csv("record", names, options))
    same = F.lower(F.to_json(F.array(*[F.col("_row_of")[c] for c in header]))) == F.lower(F.to_json(F.array(*map(F.lit, header))))
    differs = F.raise_error(F.concat(F.lit("another header than the table's in "), F.col(FILE))).cast("boolean")
    return rows.where(F.when(F.col("first"), F.when(same, False).otherwise(differs)).otherwise(True)).select(
        "_row_of.*", FILE, BLOCK, ROW
    )


def read_raw(spark: SparkSession, table: Table, path: str, multi_line: bool | None = None) -> DataFrame:
    """The table's columns as text, with the file position of each row.

    Files are split. A pass over the lines first looks for line breaks inside quotes; files with any are cut into
    records by ``records.cut``, still by many tasks. ``multi_line`` True reads every file in one task instead, with the
    same rows.
    """
    options = {"header": True, "escape": '"', "encoding": "UTF-8"}
    header = spark.read.csv(path, **options).columns
    fields = T.StructType([T.StructField(c, T.StringType()) for c in [*header, UNFIT]])
    columns = [F.col(f"`{table.header(f.name)}`").alias(f.name) for f in table.schema.fields]
    if not multi_line:
        lines = read_lines(spark, path)
        if has_breaks(lines):
            return _parsed(cut(lines), header, fields).select(*columns, UNFIT, FILE, BLOCK, ROW)
    raw = spark.read.csv(
        path, schema=fields, multiLine=bool(multi_line), enforceSchema=False, columnNameOfCorruptRecord=UNFIT, **options
    )
    return raw.select(
        *columns,
        UNFIT,
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(ROW),
    )


def _typed(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.DateType):
        return parse_date(text)
    value = text.try_cast(kind)
    if isinstance(kind, T.DecimalType):
        # more places than the type has would be rounded away
        return F.when(value == text.try_cast(T.DecimalType(38, kind.scale + 14)), value)
    return value


def _must_hold(field: T.StructField) -> bool:
    """Required columns, and every column that is not text: an empty number or date is an error."""
    return not field.nullable or not isinstance(field.dataType, T.StringType)


def _fault(field: T.StructField) -> Column:
    """Why the raw text of a column is refused."""
    value = F.concat(F.lit("bad value "), F.col(field.name))
    return F.concat(F.lit(f"{field.name}: "), F.coalesce(value, F.lit("missing")))


def _unfit(raw: DataFrame) -> Column:
    """Why a whole row is refused, NULL if its fields fit the header."""
    if UNFIT not in raw.columns:
        return F.lit(None).cast("string")
    return F.when(F.col(UNFIT).isNotNull(), F.concat(F.lit("wrong number of fields: "), F.col(UNFIT)))


def _faults(raw: DataFrame, table: Table) -> Column:
    """The faults of a raw row, NULL for a good row."""
    found = [
        F.when(_typed(F.col(f.name), f.dataType).isNull(), _fault(f)) for f in table.schema.fields if _must_hold(f)
    ]
    return F.coalesce(_unfit(raw), F.nullif(F.concat_ws("; ", *found), F.lit("")))


def _is_bad(raw: DataFrame, table: Table) -> Column:
    """Whether a raw row has any fault, without the texts that say which."""
    bad = F.col(UNFIT).isNotNull() if UNFIT in raw.columns else F.lit(False)
    for f in table.schema.fields:
        if _must_hold(f):
            bad = bad | _typed(F.col(f.name), f.dataType).isNull()
    return bad


def typed_strict(raw: DataFrame, table: Table, keep: list[str] | None = None) -> DataFrame:
    """Typed rows; a query that reads a bad value fails, whatever the ANSI setting."""

    unfit = _unfit(raw)

    def column(field: T.StructField) -> Column:
        value = _typed(F.col(field.name), field.dataType)
        if UNFIT in raw.columns:
            message = F.concat(F.lit(f"{table.name}: "), unfit)
            value = F.when(unfit.isNotNull(), F.raise_error(message).cast(field.dataType)).otherwise(value)
        if _must_hold(field):
            message = F.concat(F.lit(f"{table.name}: "), _fault(field))
            value = F.coalesce(value, F.raise_error(message).cast(field.dataType))
        return value.alias(field.name)

    return raw.select(*[column(f) for f in table.schema.fields], *(keep or []))


def split_quarantine(
    raw: DataFrame, table: Table, keep: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(typed good rows, raw bad rows with ``reason``)."""
    typed = [_typed(F.col(f.name), f.dataType).alias(f.name) for f in table.schema.fields]
    bad = _is_bad(raw, table)
    return (
        raw.where(~bad).select(*typed, *(keep or [])),
        raw.where(bad).select(*table.schema.names, *(keep or []), _faults(raw, table).alias("reason")),
    )


def read_table(spark: SparkSession, name: str, path: str, multi_line: bool | None = None) -> DataFrame:
    """Strict typed read of one table."""
    return typed_strict(read_raw(spark, TABLES[name], path, multi_line), TABLES[name])


def read_customers(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    return read_table(spark, "customers", path, multi_line)


def read_products(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    return read_table(spark, "products", path, multi_line)


def read_orders(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    return read_table(spark, "orders", path, multi_line)


def read_order_items(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    return read_table(spark, "order_items", path, multi_line)


def read_payments(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    return read_table(spark, "payments", path, multi_line)


def as_text(frame: DataFrame, table: Table) -> DataFrame:
    """The table as its CSV files carry it: header names, dates as month/day/year."""
    return frame.select(
        *[
            (slash_date(F.col(f.name)) if isinstance(f.dataType, T.DateType) else F.col(f.name)).alias(
                table.header(f.name)
            )
            for f in table.schema.fields
        ]
    )


def write_table(frame: DataFrame, name: str, path: str) -> None:
    """Write one table as a folder of CSV files, each with a header row."""
    as_text(frame, TABLES[name]).write.mode("overwrite").csv(path, header=True, escape='"', encoding="UTF-8")
