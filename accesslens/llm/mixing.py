"""Mixing sources to target weights by Pareto order sampling.

Sizes are words. Sources, in code point order with null last, weigh 1, 2, 3,
repeating, and share all words by weight; no target exceeds ``MOST`` times its
source, the excess goes to the others by weight. A target of r times the source
gives every document floor(r) certain copies. One more copy goes to documents
in Pareto order: random odds divided by inclusion odds, ``(u / (1 - u)) /
(f / (1 - f))`` with f the rest of r; the sample ends where its words come
nearest to the rest of the target. u comes from a digest of the seed, ``doc_id``
and the text, so reruns agree, and texts are told apart where ids are null or repeated.
Inclusion odds are the same for all documents of a source, so that a mix does not lean to
long or short ones; the order among sources' documents is that of the odds.

No source is sorted: the cut is found digit by digit in histograms of
2^12 counters per source and level, combined in each task before they move.
One row per source is ranked in one task, so sources are meant to number
millions at most.

Defined cases: a null text has no words; null is a source of its own; ranks are
36 bits, rows of equal rank (rows alike in id and text above all) are taken or left
together; sources without words have target 0 and take none; an empty table
gives an empty result; other columns are ignored, ``mixed`` carries them along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accesslens.llm.common import stored, text_of, word_count

MOST = 3
SEED = "mix-1"
DIGIT, LEVELS = 12, 3
BITS = DIGIT * LEVELS


def uniform(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """52 bits of a digest, strictly between 0 and 1."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), F.md5(text.cast("binary")))
    digits = F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("double")
    return (digits + 0.5) / F.lit(float(2**52))


def pareto_rank(u: Column, part: Column) -> Column:
    """The Pareto order as a whole number below 2^36; null where nothing is drawn."""
    odds = (u / (1 - u)) / (part / (1 - part))
    return F.when((part > 0) & (part < 1), F.floor(odds / (1 + odds) * F.lit(float(2**BITS))).cast("long"))


def targets(sizes: DataFrame) -> DataFrame:
    """Per source: words, target, certain copies, words of the extra copy and its share.

    Sorted by cap over weight, a source is capped if its share of what the
    sources before it leave reaches the cap; that is the fixed point of
    capping and sharing again.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    big = "decimal(38,0)"
    weight = ((F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % 3 + 1).cast(big)
    per = per.withColumn("weight", weight).withColumn("cap", F.col("source_size").cast(big) * MOST)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy(F.col("cap").cast("double") / F.col("weight").cast("double"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(
        "*",
        F.sum("source_size").over(every).cast(big).alias("total"),
        F.coalesce(F.sum("cap").over(before), F.lit(0)).cast(big).alias("caps"),
        F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)).cast(big).alias("weights"),
    )
    capped = (F.col("total") - F.col("caps")).cast("decimal(25,0)") * F.col("weight").cast("decimal(10,0)") >= F.col(
        "cap"
    ).cast("decimal(25,0)") * F.col("weights").cast("decimal(12,0)")
    per = per.withColumn("capped", capped)
    rest = F.first(F.col("total")).over(every) - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(every), F.lit(0))
    free = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(every)
    per = per.withColumns({"rest": rest.cast("decimal(25,0)"), "free": free})
    shared = (F.col("rest") * F.col("weight").cast("decimal(10,0)")).cast("double") / F.col("free").cast("double")
    per = per.withColumn("target", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(shared))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    per = per.withColumn("certain", F.floor(ratio).cast("long"))
    extra = F.col("target") - (F.col("certain") * F.col("source_size")).cast("double")
    per = per.withColumn("extra", extra)
    part = F.when(F.col("source_size") > 0, F.col("extra") / F.col("source_size")).otherwise(0.0)
    return per.withColumn("part", part).select("source", "source_size", "target", "certain", "extra", "part")


def same_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Joins on the source, null equal to null; the right side's source goes."""
    right = right.withColumnRenamed("source", "of_source")
    return left.join(right, left["source"].eqNullSafe(right["of_source"]), how).drop("of_source")


def cuts(sizes: DataFrame, per: DataFrame) -> DataFrame:
    """``per`` with ``cut``: ranks up to it get the extra copy."""
    rank = pareto_rank(F.col("u"), F.col("part"))
    ranked = same_source(sizes, per.select("source", "part").filter((F.col("part") > 0) & (F.col("part") < 1)))
    ranked = ranked.select("source", "size", rank.alias("rank"))
    state = per.filter((F.col("part") > 0) & (F.col("part") < 1)).select(
        "source", "extra", F.lit(0).cast("long").alias("head"), F.lit(0).cast("long").alias("below")
    )
    for level in range(LEVELS):
        low = BITS - DIGIT * (level + 1)
        at = F.shiftright("rank", low)
        rows = same_source(ranked, state).filter(F.shiftright(at, DIGIT) == F.col("head"))
        counters = rows.groupBy("source", at.alias("digits")).agg(
            F.sum("size").alias("words"), F.first("extra").alias("extra"), F.first("below").alias("base")
        )
        order = Window.partitionBy("source").orderBy("digits")
        upto = F.col("base") + F.sum("words").over(order)
        counters = counters.withColumn("upto", upto).withColumn("last", F.lead("digits").over(order).isNull())
        # The first counter to reach the rest of the target; rounding may leave only the last.
        reach = counters.filter((F.col("upto") >= F.col("extra")) | F.col("last"))
        state = stored(
            reach.groupBy("source")
            .agg(F.min(F.struct("digits", "extra", "words", "upto")).alias("c"))
            .select(
                "source",
                "c.extra",
                F.col("c.digits").alias("head"),
                (F.col("c.upto") - F.col("c.words")).alias("below"),
                F.col("c.upto").alias("upto"),
            ),
            "cut",
        )
    nearer = F.abs(F.col("upto") - F.col("extra")) < F.abs(F.col("below") - F.col("extra"))
    ends = state.select("source", F.when(nearer, F.col("head")).otherwise(F.col("head") - 1).alias("cut"))
    return stored(same_source(per, ends, "left"), "mix")


def plan(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(sizes, per source)``, both stored."""
    text = text_of(docs)
    sizes = docs.select("doc_id", "source", word_count(text).alias("size"), uniform(F.col("doc_id"), text).alias("u"))
    sizes = stored(sizes, "sizes")
    per = stored(targets(sizes), "targets")
    return sizes, cuts(sizes, per)


def copies() -> Column:
    rank = pareto_rank(F.col("u"), F.col("part"))
    return F.col("certain") + F.coalesce(rank <= F.col("cut"), F.lit(False)).cast("long")


def mix(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies``, ``taken``."""
    sizes, per = plan(docs)
    rows = same_source(sizes, per).withColumn("copies", copies())
    return rows.select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of ``docs``.
    A document without words is taken as often as its source's documents are for certain."""
    _, per = plan(docs)
    u = uniform(F.col("doc_id"), text_of(docs)).alias("u")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), "source", u)
    rows = same_source(rows, per)
    return rows.select(F.explode(F.array_repeat("row", copies().cast("int"))).alias("row")).select("row.*")
