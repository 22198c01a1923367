"""Reading and writing of CSV with a header and of JSON lines.

A path may use any scheme that the session's Hadoop file systems know.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagmatch.sources import schemas

FORMATS = ("csv", "json")
MALFORMED = ("fail", "keep")

# Fixed value: what stands for NULL in written CSV. Written text has no backslash of its
# own, so no text looks like it.
NULL_MARK = "\\N"
# Characters of text that are written as a percent sign and two digits. The
# percent sign is one of them and comes first, so that each one in a file starts a code.
CODES = {"%": "%25", "\\": "%5C", "\0": "%00", "\n": "%0A", "\r": "%0D"}
CORRUPT = "_corrupt_record"

_CSV = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def _escaped(text: Column) -> Column:
    """Text without line breaks, backslashes and NUL, which are written as codes."""
    for plain, code in CODES.items():
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def _unescaped(text: Column) -> Column:
    """The text before ``_escaped``. No code overlaps another, and the percent sign comes
    back last, so nothing that a step puts in is taken for a code by a later one."""
    for plain, code in reversed(CODES.items()):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _each_text(df: DataFrame, change) -> DataFrame:
    return df.select([change(F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def read_table(
    spark: SparkSession,
    path: str,
    schema: str,
    format: str = "csv",
    escaped: bool = False,
    malformed: str = "fail",
) -> DataFrame:
    """Read files with a fixed schema; nothing is inferred.

    ``escaped`` reads CSV that ``write_table`` wrote. A row that does not fit the schema
    makes the read fail, or with ``malformed`` "keep" comes with its text in a column
    ``_corrupt_record``, which is NULL for all other rows.
    """
    if format not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {format!r}")
    if malformed not in MALFORMED:
        raise ValueError(f"malformed must be one of {MALFORMED}, not {malformed!r}")
    keep = malformed == "keep"
    reader = spark.read.schema(f"{schema}, {CORRUPT} STRING" if keep else schema)
    reader = reader.option("mode", "PERMISSIVE" if keep else "FAILFAST")
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if format == "json":
        return reader.json(path)
    reader = reader.options(**_CSV)
    if not escaped:
        return reader.csv(path)
    return _each_text(reader.option("nullValue", NULL_MARK).option("emptyValue", "").csv(path), _unescaped)


def read_interactions(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_table(spark, path, schemas.INTERACTIONS, **options)


def read_items(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_table(spark, path, schemas.ITEMS, **options)


def read_item_tags(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_table(spark, path, schemas.ITEM_TAGS, "json", **options)


def read_users(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_table(spark, path, schemas.USERS, **options)


def write_table(df: DataFrame, path: str, format: str = "csv", mode: str = "overwrite") -> None:
    """Write a folder of part files, one per partition. CSV cannot hold arrays.

    In CSV, line breaks, backslashes, percent signs and NUL in text are written as codes and
    NULL has a mark, so that a read with ``escaped`` gives every value back and files can
    still be split.
    """
    if format not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {format!r}")
    if format == "json":
        df.write.mode(mode).json(path)
        return
    writer = _each_text(df, _escaped).write.mode(mode).options(**_CSV)
    writer.option("nullValue", NULL_MARK).option("emptyValue", '""').csv(path)
