"""Mixing sources to target weights by entropy balancing.

Targets: sources in code-point order (null last) weigh ``weights``, repeating, and share ``share`` times
all words. A target stops at ``cap`` times its source's words; the excess is shared again by weight until
none is above.

Rates: among all document rates in [0, cap] that give each source its target words, those closest to
one copy each (least relative entropy) are ``min(cap, exp(t * size / mean size))`` with one multiplier t a
source. The multipliers maximise a concave dual; safeguarded Newton steps find them, all sources at once,
each step one aggregate over the (source, size) histogram. The histogram holds all documents, and a source with a
third of them is spread over the cluster by size.

Rounding: within a source, sizes are taken from long to short; each size class gets the whole number of copies
that keeps the running sum nearest to the expected one, so a source ends within about half its shortest document of its
target. A class deals its copies evenly; which documents get the odd ones is decided by a hash of id and text (of the whole
row in ``mix_documents``), so it does not depend on the layout of the files. Rows of one hash are alike; they are counted, and
only the one set of them that the last odd copy falls into is numbered, in parts of bounded size.

Null text: size 0, taken 0. Null source: a source of its own, last. Null ids and repeated rows: each row
is a document. Empty table: empty result. Invalid UTF-8: its bytes are characters of a word. Very long
texts count whole. Other columns are not read. Reruns agree: nothing is random.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from churnkit.llm.common import free, n_words, row_hash
from churnkit.session import materialize, ship_package


def _ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``pos``, the 0-based place in code-point order, nulls last.

    Sorted by range into files, numbered in each, then offset by the (few) per-file counts."""
    spread = sources.repartitionByRange(F.col("source").isNull(), F.col("source")).sortWithinPartitions(
        F.col("source").isNull(), F.col("source")).withColumn("part", F.spark_partition_id())
    spread = materialize(spread, "mix-sorted")
    in_part = F.row_number().over(W.partitionBy("part").orderBy(F.col("source").isNull(), "source"))
    counts = spread.groupBy("part").agg(F.count("*").alias("n"))      # one row a partition
    before = counts.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))
    return spread.withColumn("at", in_part).join(before, "part").withColumn(
        "pos", F.col("at") + F.col("before") - 1).drop("part", "at", "before")


def targets(sources: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """(source, source_size, target). ``sources`` has one row a source: source, source_size."""
    n = len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("pos") % n + 1).cast("int"))
    ranked = materialize(_ranked(sources).withColumn("weight", weight).withColumn("most", F.col("source_size") * cap), "mix-sources")
    total = float(ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]) * share
    level, full = 0.0, -1
    while True:                        # each round caps at least one more source, or is the last
        over = F.col("most") <= F.col("weight") * level if full >= 0 else F.lit(False)
        capped, free, now = ranked.agg(
            F.coalesce(F.sum(F.when(over, F.col("most"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)),
            F.count(F.when(over, 1))).first()
        if now == full:
            break
        full, level = now, (total - capped) / free if free else math.inf
    level = F.lit(level)
    return ranked.select("source", "source_size",
                         F.when(F.col("most") <= F.col("weight") * level, F.col("most"))
                         .otherwise(F.col("weight") * level).alias("target"))


def _rate(t: Column, x: Column, cap: float) -> Column:
    return F.least(F.lit(float(cap)), F.exp(F.least(t * x, F.lit(50.0))))


def multipliers(hist: DataFrame, goals: DataFrame, cap: float, rounds: int = 60, near: float = 1e-9) -> DataFrame:
    """(source, mean, t): the dual variables. ``hist``: source, size > 0, c documents of that size.

    Newton on log(words) - log(target), which is monotone in t; a step that leaves the bracket is
    replaced by its midpoint."""
    per = hist.groupBy("source").agg(F.sum("c").alias("n"), F.min("size").alias("least"))
    x_min = F.col("least") / F.col("mean")
    state = goals.join(per, goals["source"].eqNullSafe(per["source"])).drop(per["source"]).where("source_size > 0")
    state = (state.withColumn("mean", F.col("source_size") / F.col("n"))
             .withColumn("full", F.col("target") >= F.col("source_size") * cap)
             .withColumn("lo", F.least(F.lit(0.0), F.log(F.col("target") / F.col("source_size"))) / x_min)
             .withColumn("hi", F.lit(math.log(cap)) / x_min)
             .withColumn("t", F.when(F.col("full"), F.col("hi")).otherwise(
                 F.greatest(F.col("lo"), F.least(F.col("hi"), F.log(F.col("target") / F.col("source_size"))))))
             .withColumn("gap", F.when(F.col("full"), 0.0).otherwise(1.0))
             .select("source", "source_size", "target", "mean", "full", "lo", "hi", "t", "gap"))
    state = materialize(state, "mix-state")
    for _ in range(rounds):
        todo = state.where((F.col("gap") > near) & (F.col("hi") - F.col("lo") > 1e-13 * F.abs("hi")))
        if todo.isEmpty():
            break
        x = F.col("size") / F.col("mean")
        rate, words = _rate(F.col("t"), x, cap), F.col("c") * F.col("size")
        slim = todo.select(F.col("source").alias("s"), "mean", "t")
        sums = (hist.join(slim, hist["source"].eqNullSafe(slim["s"]))
                .select("s", (words * rate).alias("f"), F.when(rate < cap, words * rate * x).otherwise(0.0).alias("d"))
                .groupBy("s").agg(F.sum("f").alias("f"), F.sum("d").alias("d")))
        state = state.join(sums, state["source"].eqNullSafe(sums["s"]), "left").drop("s")
        off = F.log(F.col("f")) - F.log("target")
        state = (state.withColumn("lo", F.when(off < 0, F.col("t")).otherwise(F.col("lo")))
                 .withColumn("hi", F.when(off > 0, F.col("t")).otherwise(F.col("hi")))
                 .withColumn("step", F.when(F.col("d") > 0, F.col("t") - off * F.col("f") / F.col("d"))))
        inside = (F.col("step") > F.col("lo")) & (F.col("step") < F.col("hi"))
        state = (state.withColumn("gap", F.coalesce(F.abs(off), F.col("gap")))
                 .withColumn("t", F.when(off.isNull() | (F.abs(off) <= near), F.col("t"))
                             .when(F.coalesce(inside, F.lit(False)), F.col("step"))
                             .otherwise((F.col("lo") + F.col("hi")) / 2))
                 .select("source", "source_size", "target", "mean", "full", "lo", "hi", "t", "gap"))
        state = materialize(state, "mix-state")
    return state.select("source", "mean", "t", "full")


def _round_copies(cap: float):
    """Whole copies for each size class of one source, long to short, the error carried on.

    A source has at most one row for each size, a number set by its longest document and not by its rows."""
    import pandas as pd

    most = int(math.floor(cap))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size", ascending=False, ignore_index=True)
        carry, copies = 0.0, []
        for size, c, rate in zip(pdf["size"], pdf["c"], pdf["rate"]):
            want = c * rate * size + carry
            got = min(max(math.floor(want / size + 0.5), 0), most * c)
            carry = want - got * size
            copies.append(got)
        pdf["copies"] = copies
        return pdf

    def groups(_, pdf: pd.DataFrame) -> pd.DataFrame:
        return one(pdf)[["source", "size", "c", "rate", "copies"]]

    return groups


def _dealt(odd: DataFrame, per_bucket: int) -> DataFrame:
    """``odd`` with ``extra``: 1 for the first ``odd`` rows of each (source, size) in (bucket, h) order, else 0."""
    group = ["source", "size", "bucket", "h"]
    alike = materialize(odd.groupBy(*group, "odd").agg(F.count("*").alias("n")), "mix-alike")
    counts = alike.groupBy("source", "size", "bucket").agg(F.sum("n").alias("m"))
    before = (counts.withColumn("before", F.sum("m").over(W.partitionBy("source", "size").orderBy("bucket")) - F.col("m"))
              .select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("bucket").alias("b"), "before"))
    here = F.sum("n").over(W.partitionBy("source", "size", "bucket").orderBy("h")) - F.col("n")      # about per_bucket hashes
    left = alike.withColumn("here", here).join(
        before, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("bucket") == F.col("b")))
    left = left.select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("h").alias("k"), "n",
                       (F.col("odd") - F.col("before") - F.col("here")).alias("left"))
    left = materialize(left.where("left > 0"), "mix-left")
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("h") == F.col("k"))
    whole = (odd.join(left, same, "left").where("left IS NULL OR left >= n")
             .select(*odd.columns, F.col("left").isNotNull().cast("int").alias("extra")))
    part = odd.join(left.where("left < n"), same).withColumn("salt", F.pmod("row", F.ceil(F.col("n") / per_bucket)))
    part = materialize(part.select(*odd.columns, "left", "salt"), "mix-part")
    salts = part.groupBy("source", "size", "h", "salt").agg(F.count("*").alias("m"))
    salts = (salts.withColumn("before", F.sum("m").over(W.partitionBy("source", "size", "h").orderBy("salt")) - F.col("m"))
             .select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("h").alias("k"), F.col("salt").alias("b"), "before"))
    at = F.row_number().over(W.partitionBy("source", "size", "h", "salt").orderBy("row"))
    part = part.withColumn("at", at).join(salts, same & (F.col("salt") == F.col("b")))
    return whole.unionByName(part.select(*odd.columns, (F.col("at") + F.col("before") <= F.col("left")).cast("int").alias("extra")))


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
        weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, per_bucket: int = 512,
        by: Column | None = None) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies, taken), one row per row of ``docs``.

    ``by`` is a long that decides which documents of a size get the odd copies; a hash of id and text if not given."""
    ship_package(docs.sparkSession)
    if by is None:
        by = F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`"))
    sized = materialize(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"),
                                    n_words(F.col(f"`{text}`")).alias("size"), by.alias("h")), "mix-sizes")
    hist = materialize(sized.groupBy("source", "size").agg(F.count("*").alias("c")), "mix-hist")
    sources = hist.groupBy("source").agg(F.sum(F.col("size") * F.col("c")).alias("source_size"))
    goals = materialize(targets(sources, weights, share, cap), "mix-targets")
    some = hist.where("size > 0")
    duals = multipliers(some, goals, cap).withColumnRenamed("source", "s")
    rate = F.when(F.col("full"), F.lit(float(cap))).otherwise(_rate(F.col("t"), F.col("size") / F.col("mean"), cap))
    rated = some.join(duals, some["source"].eqNullSafe(duals["s"])).select("source", "size", "c", rate.alias("rate"))
    classes = materialize(rated.groupBy("source").applyInPandas(
        _round_copies(cap), "source string, size long, c long, rate double, copies long"), "mix-classes")
    classes = (classes.withColumn("base", F.floor(F.col("copies") / F.col("c")))
               .withColumn("odd", F.col("copies") - F.col("base") * F.col("c"))
               .withColumn("buckets", F.ceil(F.col("c") / per_bucket))
               .select(F.col("source").alias("s"), F.col("size").alias("z"), "rate", "base", "odd", "buckets"))
    dealt = sized.join(classes, sized["source"].eqNullSafe(classes["s"]) & (sized["size"] == classes["z"]), "left")
    dealt = dealt.select("doc_id", "source", "size", "h", "rate", F.coalesce("base", F.lit(0)).alias("base"), F.coalesce("odd", F.lit(0)).alias("odd"),
                         F.pmod(F.shiftrightunsigned("h", 16), F.col("buckets")).alias("bucket"), F.monotonically_increasing_id().alias("row"))
    dealt = materialize(dealt, "mix-dealt")
    cols = ["doc_id", "source", "size", "rate"]
    out = (_dealt(dealt.where("odd > 0"), per_bucket).select(*cols, (F.col("base") + F.col("extra")).alias("copies"))
           .unionByName(dealt.where("odd = 0").select(*cols, F.col("base").alias("copies"))))
    goals = goals.select(F.col("source").alias("s"), "source_size", "target")
    return out.join(goals, out["source"].eqNullSafe(goals["s"])).select(
        F.col("doc_id").alias(doc_id), F.col("source").alias(source), "size", "source_size", "target",
        F.coalesce("rate", F.lit(0.0)).alias("rate"), F.col("copies").cast("long").alias("copies"),
        (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def mix_documents(docs: DataFrame, source: str = "source", text: str = "text", **how) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as its copies say, rows with none left out."""
    key, many, one = (free(c, docs.columns) for c in ("__row", "__copies", "__copy"))
    rows = materialize(docs.withColumn(key, F.monotonically_increasing_id()), "mix-docs")
    copies = mix(rows, key, source, text, by=row_hash(docs), **how).select(F.col(key), F.col("copies").cast("int").alias(many))
    taken = rows.join(copies, key).where(F.col(many) > 0).withColumn(one, F.explode(F.sequence(F.lit(1), F.col(many))))
    return taken.select(*[F.col(f"`{c}`") for c in docs.columns])
