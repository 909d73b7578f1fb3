"""Domain validation of subscriber / request records with per-record error isolation.

Each rule is a boolean expression; a record gets the list of rules it violates, so one
bad record yields an error row and all others pass -- a projection, no shuffle. The
valid / quarantine split is two filters on the same projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnkit.operators.features import parse_number
from churnkit.schema import DOMAINS, KEY, RANGES


def rules(df: DataFrame, need_key: bool = True) -> list[tuple[str, Column]]:
    """(rule name, violated?) for every enumerated field and numeric range present, and for the key if it is needed."""
    out = []
    for c, allowed in DOMAINS.items():
        if c in df.columns:
            out.append((f"{c}_not_allowed", F.col(c).isNotNull() & ~F.col(c).isin(*allowed)))
    for c, (lo, hi) in RANGES.items():
        if c not in df.columns:
            continue
        x = F.col(c)
        if isinstance(df.schema[c].dataType, T.StringType):
            num = parse_number(x)
            out.append((f"{c}_not_numeric", x.isNotNull() & num.isNull()))
            x = num
        out.append((f"{c}_out_of_range", x.isNotNull() & ((x < lo) | (x > hi))))
    if "_corrupt_record" in df.columns:
        out.append(("malformed_record", F.col("_corrupt_record").isNotNull()))
    if need_key and KEY in df.columns:
        whole = F.col("_corrupt_record").isNull() if "_corrupt_record" in df.columns else F.lit(True)
        out.append((f"{KEY}_missing", F.col(KEY).isNull() & whole))
    return out


def validate_records(df: DataFrame, key: str = KEY) -> DataFrame:
    """key, n_violations, error ('; '-joined rule names or NULL), is_valid."""
    rs = rules(df)
    names = F.filter(F.array(*[F.when(cond, F.lit(name)) for name, cond in rs]), lambda x: x.isNotNull())
    return df.select(F.col(key), names.alias("_v")).select(
        key,
        F.size("_v").alias("n_violations"),
        F.when(F.size("_v") > 0, F.array_join("_v", "; ")).alias("error"),
        (F.size("_v") == 0).cast("int").alias("is_valid"))


def with_errors(df: DataFrame, wrong: str) -> DataFrame:
    """Adds ``error``: the '; '-joined names in the ``wrong`` column and of the rules that the record breaks; NULL if none.

    The record's place is its key, so it needs no other. One that could not be read at all is judged by no rule."""
    names = F.filter(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules(df, need_key=False)]), lambda x: x.isNotNull())
    unread = F.arrays_overlap(F.col(wrong), F.array(F.lit("malformed_record"), F.lit("not_an_array")))
    names = F.concat(F.col(wrong), F.when(unread, F.array().cast("array<string>")).otherwise(names))
    return df.withColumn("error", F.nullif(F.array_join(names, "; "), F.lit("")))


def split_valid(df: DataFrame, key: str = KEY) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with their error) from one projection."""
    rs = rules(df)
    names = F.filter(F.array(*[F.when(cond, F.lit(name)) for name, cond in rs]), lambda x: x.isNotNull())
    tagged = df.withColumn("_v", names)
    valid = tagged.where(F.size("_v") == 0).drop("_v")
    bad = tagged.where(F.size("_v") > 0).withColumn("error", F.array_join("_v", "; ")).drop("_v")
    return valid, bad
