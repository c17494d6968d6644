"""Exact duplicates by a two-pass Bloom filter.

The first pass over the narrow rows (key, digest, length) fills a filter of the hashes
that have been seen again. The second pass asks it: a row whose hash cannot repeat passes
straight through, and only the others are shuffled and grouped by their SHA-256 digest,
which decides. A false positive costs a shuffled row and changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierflow.llm import bloom
from tierflow.llm.common import attach, stored

BLANKS = r"[\x20\x09-\x0D]+"


def digest_of(text: str) -> F.Column:
    """SHA-256 of the text without white space, as bytes; null counts as empty."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), BLANKS, ""), 256))


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", bits_per_key: int = 16,
                max_bits: int = 1 << 28) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, n_chars.

    Texts are equal when identical without white space; null and empty texts are equal.
    Of equal texts the one with the most code points stays, then the smallest key (null
    last). Rows that also share the key are told apart by their place, so one is kept.
    No rows give no rows. Other columns of ``docs`` are not read.
    """
    narrow = stored(docs.select(
        F.col(key).alias("doc_id"),
        digest_of(text).alias("digest"),
        F.length(F.coalesce(F.col(text), F.lit(""))).alias("n_chars"),
        F.monotonically_increasing_id().alias("place"),
    ).withColumn("hash", F.xxhash64("digest")), "digests")
    bits = bloom.filter_bits(narrow.count(), bits_per_key, max_bits)
    _, again = bloom.build(narrow.select("hash"), bits)
    marked = bloom.probed(narrow, "hash", again, bits, "repeated")

    alone = marked.filter(~F.col("repeated")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "digest", "n_chars",
    )
    shuffled = stored(marked.filter("repeated").select("doc_id", "digest", "n_chars", "place"), "repeated")
    # The complement reverses the order of integers without overflow.
    groups = stored(shuffled.groupBy("digest").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.max(F.struct("n_chars", F.bitwise_not("doc_id").alias("id"), F.bitwise_not("place").alias("at"))).alias("best"),
    ).select("digest", "group_size", F.bitwise_not("best.id").alias("keep_id"),
             F.bitwise_not("best.at").alias("keep_place")), "groups")
    decided = attach(shuffled, groups, "digest", "group_size", shuffled.count()).select(
        "doc_id", "keep_id", "group_size", (F.col("place") == F.col("keep_place")).alias("kept"), "digest", "n_chars",
    )
    return alone.unionByName(decided).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"), "n_chars",
    )
