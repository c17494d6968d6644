"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierflow.llm.common import attach, positions, stored

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix"
#: Times that one document per source is exchanged to come nearer to the target.
ROUNDS = 3
WORD = r"[^\x20\x09-\x0D]+"


def water_level(sources: DataFrame) -> float | None:
    """The level L at which the sources' shares min(cap, weight * L) add up to all sizes.

    Sources are clamped at their caps and the excess goes to the others by weight until
    none is above. Each round is one aggregate; None if every source is at its cap.
    """
    total, weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    level, clamped = (total or 0) / (weights or 1), 0
    while True:
        above = F.col("cap") <= F.col("weight") * F.lit(level)
        caps, rest, count = sources.agg(
            F.coalesce(F.sum(F.when(above, F.col("cap"))), F.lit(0)),
            F.sum(F.when(~above, F.col("weight"))), F.count_if(above)).first()
        if rest is None:
            return None
        if count == clamped:
            return level
        level, clamped = (total - caps) / rest, count


def _fraction(name: str, seed: str) -> F.Column:
    """A number in [0, 1) that depends on the seed and the text in ``name`` only."""
    hexed = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.col(name))), 1, 8)
    return F.conv(hexed, 16, 10).cast("double") / 2.0 ** 32


def mix_sources(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED,
                rounds: int = ROUNDS, row: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken, repeats.

    The sources in order of their code points, null last, weigh ``weights``, repeating.
    Their targets share the words of all documents and stop at ``max_epochs`` times a
    source's own words. Each document is taken floor(target / source_size) times, and once
    more by seeded systematic sampling over the source's documents in order of size; then up
    to ``rounds`` documents per source change their mind to bring the source nearer to its
    target. Null and empty texts have size 0 and are taken with 0 words. Rows may repeat and
    keys may be null; each row counts for itself. No rows give no rows. The result depends on
    the rows and the seed only. ``row`` names a column of unique numbers, if there is one; it
    comes along and tells apart rows that are equal otherwise.
    """
    own = [] if row is None else [row]
    narrow = docs.select(
        *own,
        F.col(key).cast("long").alias("doc_id"),
        F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        # A text that keeps the order and puts null behind all others.
        F.coalesce(F.concat(F.lit("0"), F.col(source).cast("string")), F.lit("1")).alias("src"),
    ).withColumn("lot", F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    # The global order splits a large source over many tasks.
    rows = stored(positions(narrow, [F.asc("src"), F.desc("size"), F.asc("lot"), F.asc("doc_id"), *own], "at"), "sizes")
    totals = rows.groupBy("src").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"),
                                     F.min("at").alias("first"))
    cycle = F.array(*map(F.lit, weights))
    sources = stored(
        positions(totals, [F.asc("src")], "nth", "sources")
        .withColumn("weight", F.element_at(cycle, (F.col("nth") % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * max_epochs), "weighed")
    count = rows.count()
    level = water_level(sources)
    target = F.col("cap").cast("double") if level is None else F.least(
        F.col("cap").cast("double"), F.col("weight") * F.lit(float(level)))
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = (
        sources.withColumn("target", target).withColumn("whole", F.floor(epochs))
        .withColumn("part", epochs - F.col("whole")).withColumn("phase", _fraction("src", seed))
        .select("src", "source_size", "n_docs", "first", "target", "whole", "part", "phase",
                F.array().cast("array<bigint>").alias("swapped"))
    )
    nth = F.col("at") - F.col("first")
    sampled = F.floor((nth + 1) * F.col("part") + F.col("phase")) > F.floor(nth * F.col("part") + F.col("phase"))
    once_more = sampled != F.array_contains("swapped", F.col("at"))
    for _ in range(rounds):
        plan = stored(plan, "plan")
        chosen = attach(rows, plan, "src", "n_docs", count).withColumn("more", once_more)
        off = chosen.groupBy("src").agg(
            (F.first("target") - F.sum(F.col("size") * (F.col("whole") + F.col("more").cast("int")))).alias("off"))
        plan = stored(plan.join(off, "src"), "off")
        chosen = attach(rows, plan, "src", "n_docs", count).withColumn("more", once_more)
        change = F.when(F.col("more"), -F.col("size")).otherwise(F.col("size"))
        better = F.abs(F.col("off") - change)
        swap = chosen.filter((better < F.abs("off")) & (F.col("whole") < max_epochs)).groupBy("src").agg(
            F.min(F.struct(better.alias("left"), F.col("at"))).alias("best")).select("src", "best.at")
        plan = plan.join(swap, "src", "left").withColumn(
            "swapped", F.when(F.col("at").isNull(), F.col("swapped")).otherwise(F.array_append("swapped", F.col("at")))
        ).drop("off", "at")
    repeats = (F.col("whole") + once_more.cast("int")).cast("int")
    return attach(rows, stored(plan, "plan"), "src", "n_docs", count).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * repeats).alias("taken"), repeats.alias("repeats"), *own)
