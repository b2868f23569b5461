"""CSV scans that find the types of unknown columns and set malformed rows apart.

Columns of a known table have the types of ``SCHEMAS``. For all others one distributed pass counts
the values that each candidate type can hold, and the first type in ``CANDIDATES`` that holds all of them is taken; a
column without a value is text. Only one row of counts comes back to the driver, whatever the files hold.

A row is malformed if it has another number of fields than the header, or a value that the type of a
known column can't hold. Malformed rows are not part of the table; they keep their file, their text and the reasons.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.sources.schemas import SCHEMAS

# From narrow to wide. Whole numbers come before fractions, days before moments.
CANDIDATES = ("bigint", "double", "boolean", "date", "timestamp")
RAW, FILE = "_malformed_text", "_malformed_file"
# Words that a cast takes for a number or a truth value beside digits, true and false. Fixed values.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
PLAIN = {
    "bigint": r"^[+-]?\d+$",
    "double": NUMBER,
    "boolean": r"(?i)^(true|false)$",
    "date": r"^\d{4}-\d{1,2}-\d{1,2}$",
    "timestamp": r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{2}",
}


@dataclass(frozen=True)
class TypedScan:
    """The table, the rows that are not in it (file, text, reason), and the types by column."""

    rows: DataFrame
    malformed: DataFrame
    types: dict[str, str]


def scan(spark: SparkSession, path: str, table: str | None = None) -> TypedScan:
    """Read a CSV file or a folder of files with one header; ``table`` names a known schema.

    Columns go by their trimmed names; two of one name are refused. Empty fields are null. An empty
    file with a header gives an empty table.
    """
    header = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    names = [c.strip() for c in header]
    twice = sorted({c for c in names if names.count(c) > 1})
    if twice or not names:
        raise ValueError(f"columns of one name: {', '.join(twice)}" if twice else f"no header in {path}")
    known = {} if table is None else {f.name: f.dataType.simpleString() for f in SCHEMAS[table].fields}
    text = _text_rows(spark, path, header)
    counted = text.where(F.col(RAW).isNull())
    types = {**_found_types(counted, [c for c in names if c not in known]), **{c: known[c] for c in names if c in known}}
    types = {c: types[c] for c in names}
    reason = _reason(types, known)
    judged = text.withColumn("_reason", reason)
    rows = judged.where(F.col("_reason") == "").select(*[_value(c, kind).alias(c) for c, kind in types.items()])
    raw = F.coalesce(RAW, F.to_csv(F.struct(*[_name(c) for c in names])))
    malformed = judged.where(F.col("_reason") != "").select(
        F.col(FILE).alias("file"), raw.alias("text"), F.col("_reason").alias("reason")
    )
    return TypedScan(rows, malformed, types)


def _name(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def _text_rows(spark: SparkSession, path: str, header: list[str]) -> DataFrame:
    """Every field as text, with the file, and the whole text of rows with another number of fields.

    All fields are parsed in every read: with some left out, the parser would not see that there are too many.
    """
    fields = ", ".join("`" + c.replace("`", "``") + "` string" for c in header)
    reader = spark.read.schema(f"{fields}, `{RAW}` string").option("header", True).option("enforceSchema", False)
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW).option("columnPruning", False)
    rows = reader.csv(path).withColumn(FILE, F.col("_metadata.file_name"))
    return rows.toDF(*[c.strip() for c in header], RAW, FILE)


def _value(column: str, kind: str) -> Column:
    return _name(column) if kind == "string" else F.trim(_name(column)).try_cast(kind)


def _holds(column: str, kind: str) -> Column:
    """Whether a type can hold the value of an unknown column and writes it like one of its own."""
    return F.trim(_name(column)).rlike(PLAIN[kind]) & _value(column, kind).isNotNull()


def _found_types(text: DataFrame, columns: list[str]) -> dict[str, str]:
    if not columns:
        return {}
    counts = [F.count(_name(c)).alias(f"n{i}") for i, c in enumerate(columns)]
    for i, c in enumerate(columns):
        counts += [F.count_if(_holds(c, kind)).alias(f"n{i}_{kind}") for kind in CANDIDATES]
    got = text.agg(*counts).first()
    found = {}
    for i, c in enumerate(columns):
        fit = [kind for kind in CANDIDATES if got[f"n{i}"] > 0 and got[f"n{i}_{kind}"] == got[f"n{i}"]]
        found[c] = fit[0] if fit else "string"
    return found


def _reason(types: dict[str, str], known: dict[str, str]) -> Column:
    """Why a row is malformed; an empty text if it is not."""
    # A column beside the text of malformed rows must be read, or the parser refuses.
    read = F.coalesce(F.length(_name(next(iter(types)))), F.lit(0)) >= 0
    fields = F.when(F.col(RAW).isNotNull() & read, F.lit(f"not {len(types)} fields"))
    wrong = [
        F.when(_name(c).isNotNull() & _value(c, kind).isNull(), F.lit(f"{c}: not {kind}"))
        for c, kind in types.items()
        if c in known and kind != "string"
    ]
    return F.coalesce(fields, F.concat_ws(", ", *wrong) if wrong else F.lit(""))
