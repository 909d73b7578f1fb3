"""Scoring requests: typed JSON records with per-field defaults.

Requests carry the 19 input fields of a subscriber plus a ``customerID`` key. Missing
fields take the documented defaults; a missing TotalCharges defaults to
``MonthlyCharges * max(tenure, 1)`` (then to the field default).

They come as JSON lines (``read_requests``), or as arrays posted to the batch endpoint (``read_request_bodies``,
``request_elements``), where every element is judged by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnkit.operators.features import parse_number
from churnkit.schema import KEY, REQUEST, REQUEST_DEFAULTS

CORRUPT = "_corrupt_record"


def read_requests(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """JSON lines (or one JSON array per file with ``multiline``) with the REQUEST schema.

    Malformed records are kept with their text in ``_corrupt_record`` (PERMISSIVE)."""
    schema = T.StructType(REQUEST.fields + [T.StructField(CORRUPT, T.StringType())])
    return (spark.read.schema(schema).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("multiLine", multiline).json(path))


def requests_from_subscribers(raw: DataFrame) -> DataFrame:
    """Subscriber records as requests: the request fields, TotalCharges parsed (blank -> NULL)."""
    cols = [KEY] + [f.name for f in REQUEST.fields if f.name != KEY]
    return raw.select(*[parse_number(F.col(c)).alias(c) if c == "TotalCharges" else F.col(c)
                        for c in cols])


def with_request_defaults(df: DataFrame) -> DataFrame:
    out = []
    for f in REQUEST.fields:
        if f.name not in df.columns:
            continue
        c = F.col(f.name)
        if f.name == "TotalCharges":
            monthly = F.coalesce(F.col("MonthlyCharges"), F.lit(REQUEST_DEFAULTS["MonthlyCharges"]))
            tenure = F.coalesce(F.col("tenure"), F.lit(REQUEST_DEFAULTS["tenure"]))
            c = F.coalesce(c, monthly * F.greatest(tenure, F.lit(1)).cast("double"))
        elif f.name in REQUEST_DEFAULTS:
            c = F.coalesce(c, F.lit(REQUEST_DEFAULTS[f.name]).cast(f.dataType))
        out.append(c.alias(f.name))
    extra = [c for c in df.columns if c not in {f.name for f in REQUEST.fields}]
    return df.select(*out, *extra)


# ------------------------------------------------------------------ arrays of requests (the batch endpoint's bodies)
# A JSON text, not crossing the start of the next record ({"), so that a quote left open spoils no record but its own.
_STRING = r'"(?:[^"\\{]++|\\.|\{(?!"))*+"'


def _record(depth: int) -> str:
    """A pattern of a record that holds records up to ``depth`` deep; possessive, so it never backtracks into a part."""
    return r"\{(?:[^{}\"]++|" + _STRING + ("|" + _record(depth - 1) if depth else "") + r")*+\}"


# An element: a record; else the start of one up to the next; else a text or a bare word.
_ELEMENT = _record(6) + r'|\{(?:[^{]++|\{(?!"))*+|' + _STRING + r'|[^\s,\[\]{}"]+'
_KINDS = {T.StringType(): ["STRING"], T.IntegerType(): ["BIGINT", "DECIMAL", "DOUBLE"], T.DoubleType(): ["BIGINT", "DECIMAL", "DOUBLE", "FLOAT"]}


def read_request_bodies(spark: SparkSession, path: str, body_per: str = "line") -> DataFrame:
    """(source, body): JSON arrays of requests, one a ``file``, or one a ``line`` of a request log.

    The source is the file's name, or the post's id, which stands before the line's first tab; without a tab the line is the body."""
    lines = spark.read.text(path, wholetext=body_per == "file")
    if body_per == "file":
        return lines.select(F.col("_metadata.file_name").alias("source"), F.col("value").alias("body"))
    parts = F.split("value", "\t", 2)
    return lines.select(F.when(F.size(parts) == 2, parts[0]).alias("source"), F.element_at(parts, -1).alias("body"))


def request_elements(bodies: DataFrame, body: str = "body") -> DataFrame:
    """The other columns of ``bodies``, then position (0-based), n_elements, element (its text), the REQUEST fields, typed, and ``wrong``, the names
    of the faults found while typing.

    Elements are told apart before anything is parsed, so one that is broken -- cut off, a quote left open, no record,
    a field of the wrong type -- is one row with its faults and the others are untouched. Whole numbers count as
    numbers, a fraction is no whole number, text is no number; a null field is a missing one. A body that is no array is one row at
    position NULL. Empty arrays give no row. Records in nested arrays count as elements. Elements that nest records more than six deep
    are faulty, and so is a record with a text that ends in an opening brace."""
    keep = [c for c in bodies.columns if c != body]
    whole = F.coalesce(F.col(body).rlike(r"^\s*\["), F.lit(False))
    found = F.when(whole, F.regexp_extract_all(F.col(body), F.lit(_ELEMENT), F.lit(0))).otherwise(F.array(F.col(body)))
    rows = (bodies.select(*keep, found.alias("_e"), whole.alias("_w"))
            .select(*keep, "_w", F.when(F.col("_w"), F.size("_e")).alias("n_elements"), F.posexplode("_e").alias("_p", "element")))
    rows = rows.withColumn("_v", F.when(F.col("_w"), F.try_parse_json("element")))
    rows = rows.withColumn("_record", F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False)))
    typed, faults = [], [F.when(~F.col("_w"), "not_an_array"), F.when(F.col("_w") & ~F.col("_record"), "malformed_record")]
    for f in REQUEST.fields:
        wide = "string" if isinstance(f.dataType, T.StringType) else "double"
        value = F.when(F.col("_record"), F.try_variant_get("_v", f"$.{f.name}", wide))
        raw = F.when(F.col("_record"), F.try_variant_get("_v", f"$.{f.name}", "variant"))
        typed.append(value.cast(f.dataType).alias(f.name) if not isinstance(f.dataType, T.IntegerType) else
                     F.when(F.abs(value) < 2.0 ** 31, value).cast(f.dataType).alias(f.name))
        faults.append(F.when(_present(raw) & ~_fits(raw, value, f.dataType), f"{f.name}_wrong_type"))
    wrong = F.filter(F.array(*faults), lambda x: x.isNotNull())
    return rows.select(*keep, F.when(F.col("_w"), F.col("_p")).alias("position"), "n_elements", "element", *typed, wrong.alias("wrong"))


def _present(raw: Column) -> Column:
    return raw.isNotNull() & ~F.coalesce(F.is_variant_null(raw), F.lit(True))


def _fits(raw: Column, value: Column, kind: T.DataType) -> Column:
    """Whether a field's JSON kind is that of the request, and a whole number is whole and an int."""
    named = F.regexp_extract(F.schema_of_variant(raw), "^[A-Z]+", 0).isin(*_KINDS[kind])
    if isinstance(kind, T.IntegerType):
        named = named & (value == F.floor(value)) & (F.abs(value) < 2.0 ** 31)
    return F.coalesce(named, F.lit(False))
