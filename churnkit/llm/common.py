"""Helpers of the training-data operators: reading tables, one pass over whole texts, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from churnkit.session import materialize, ship_package

# A word is a run of anything but ASCII white space; in bytes that is what bytes.split() gives.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Words of a whole text (NULL: 0), in the JVM."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def per_text(df: DataFrame, keep: Sequence[str], text: str, make: Callable[[], Callable],
             fields: Sequence[T.StructField]) -> DataFrame:
    """One pass over whole texts in Arrow batches, without a shuffle.

    Returns the ``keep`` columns unchanged, then ``fields``. ``make()`` is called once a task
    and returns a function from one text (str or None) to the tuple of field values. Other
    columns of ``df`` are not read. One text is decoded at a time, invalid UTF-8 as U+FFFD."""
    ship_package(df.sparkSession)
    source = df.select(*[F.col(f"`{c}`") for c in keep], F.make_valid_utf8(F.col(f"`{text}`").cast("string")).alias("__text"))
    schema = T.StructType([source.schema[c] for c in keep] + list(fields))
    arrow = to_arrow_schema(schema)
    names, kinds, n_keep = arrow.names, arrow.types, len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            rows = [fn(v.as_py()) for v in batch.column(n_keep)]
            made = [pa.array([r[i] for r in rows], kinds[n_keep + i]) for i in range(len(kinds) - n_keep)]
            kept = [batch.column(i).cast(kinds[i]) for i in range(n_keep)]
            yield pa.RecordBatch.from_arrays(kept + made, names=names)

    return source.mapInArrow(run, schema)


def free(name: str, taken: Sequence[str]) -> str:
    """``name``, lengthened until no column of ``taken`` has it, whatever its case."""
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def row_hash(df: DataFrame) -> Column:
    """XXH64 of all columns of a row but maps, which have no hash."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()])


def field(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind, True)


def components(links: DataFrame, a: str, b: str, max_rounds: int = 50) -> DataFrame:
    """Connected components of an undirected graph: (node, root), root the smallest node.

    Alternating large-star / small-star: each round points every node at smaller neighbours
    until the links form stars. Every aggregate is combined map-side, and each minimum is
    written before it is joined back, so both join sides come from files and the planner
    may broadcast a small one or split a hot node. Lineage is cut by a table in the shared
    checkpoint folder each half round. Nodes without a link do not appear. Self links and
    repeated links are ignored."""
    links = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    links = materialize(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    seen = None
    for _ in range(max_rounds):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m")), "cc-min")
        large = materialize(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                            .where("u <> v").distinct(), "cc-large")
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "cc-min")
        moved = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        links = materialize(moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "cc-small")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = links.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def filter_texts(df: DataFrame, text: str, make: Callable[[], Callable]) -> DataFrame:
    """The rows of ``df`` for which the function that ``make()`` returns holds of the text; columns unchanged.

    The function sees invalid UTF-8 as U+FFFD."""
    ship_package(df.sparkSession)
    schema, at = df.schema, df.columns.index(text)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = make()
        for batch in batches:
            texts = (v.as_py() for v in batch.column(at).cast(pa.binary()))
            part = batch.filter(pa.array([bool(keep(v if v is None else v.decode(errors="replace"))) for v in texts], pa.bool_()))
            yield pa.RecordBatch.from_arrays(part.columns, names=names)

    return df.mapInArrow(run, schema)
