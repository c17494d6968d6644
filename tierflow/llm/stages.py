"""The corpus operators as steps that take documents and give documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F

from tierflow.llm import bloom
from tierflow.llm.common import attach, stored
from tierflow.llm.exact_dedup import digest_of, exact_dedup
from tierflow.llm.langid import UNKNOWN, held_out, identify, learn_languages
from tierflow.llm.mixing import mix_sources
from tierflow.llm.near_dup import near_duplicates


def _inner_names(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under names that clash with none of ours, and the new name of each old one."""
    names = {name: f"_c{i}" for i, name in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _key(name: str) -> F.Column:
    """A key as a text that equals another one only if the keys do, null included."""
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("null"))


def keep_language(docs: DataFrame) -> DataFrame:
    """Drop documents in no known language: without a letter, null and empty ones too, or unlike every learned one.

    Repeated rows are judged alike. Without any labelled document no language is known and
    nothing can be rejected: all rows stay, those without a letter too. An empty table stays
    empty. Other columns pass through under their names.
    """
    languages = learn_languages(docs.filter(~held_out()))
    inner, names = _inner_names(docs)
    told = identify(inner, languages, text=names["text"])
    if not languages.names:
        return docs
    kept = told.filter((F.col("lang_pred") != UNKNOWN) & F.col("explained"))
    return kept.select(*names.values()).toDF(*docs.columns)


def _chosen(docs: DataFrame, marks: DataFrame, mark: Callable[[dict[str, str]], F.Column]) -> DataFrame:
    """The rows of ``docs`` whose mark is kept, one per mark.

    ``marks``: mark, size (rows of that mark), kept. The marks that are dropped or that
    several rows share fill a Bloom filter of bounded size; rows that are not in it pass
    straight through, whole texts unshuffled. The others are joined with their marks; of
    the rows of one mark the one with the smallest text stays.
    """
    inner, names = _inner_names(docs)
    doubtful = marks.filter(~F.col("kept") | (F.col("size") > 1))
    count = doubtful.agg(F.count(F.lit(1)), F.sum("size")).first()
    bits = bloom.filter_bits(count[0])
    seen, _ = bloom.build(doubtful.select(F.xxhash64("mark").alias("hash")), bits)
    marked = inner.withColumn("mark", mark(names)).withColumn("hash", F.xxhash64("mark"))
    marked = bloom.probed(marked, "hash", seen, bits, "doubt")
    sure = marked.filter(~F.col("doubt")).select(*names.values())
    rows = attach(marked.filter("doubt"), marks.filter("kept").drop("kept"), "mark", "size", max(1, count[1] or 0))
    first = F.row_number().over(Window.partitionBy("mark").orderBy(names["text"]))
    several = rows.filter("size > 1").withColumn("first", first).filter("first = 1").drop("first")
    checked = rows.filter("size = 1").unionByName(several).select(*names.values())
    return sure.unionByName(checked).toDF(*docs.columns)


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts stays: the longest, then the one with the smallest key.

    Null and empty texts, and those of white space only, are one group. Keys may be null, the
    largest then, or stand on several rows; of equal rows one stays. An empty table stays
    empty. Other columns pass through under their names.
    """
    decided = stored(exact_dedup(docs), "decided")
    # A key may stand on several rows; the kept row is the one with the kept length.
    length = F.concat(_key("doc_id"), F.lit(" "), "text_sha256", F.lit(" "), F.col("n_chars").cast("string")).alias("mark")
    marks = stored(decided.groupBy(length).agg(F.count(F.lit(1)).alias("size"), F.max("kept").alias("kept")), "marks")
    return _chosen(docs, marks, lambda names: F.concat(
        _key(names["doc_id"]), F.lit(" "), F.lower(F.hex(digest_of(names["text"]))), F.lit(" "),
        F.length(F.coalesce(F.col(names["text"]), F.lit(""))).cast("string")))


def _numbered_rows(docs: DataFrame, label: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` stored under inner names with a unique number per row, which keys need not have."""
    inner, names = _inner_names(docs)
    return stored(inner.withColumn("row", F.monotonically_increasing_id()), label), names


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each near-duplicate component stays: the one with the smallest key.

    Rows are told apart by their number, so keys may repeat or be null: documents that are
    not linked all stay. Null is the largest key; of equal keys the smallest digest of the
    text stays.
    """
    held, names = _numbered_rows(docs, "near-rows")
    near = stored(near_duplicates(held, key="row", text=names["text"]).select(F.col("doc_id").alias("row"), "component_id"), "components")
    several = near.groupBy("component_id").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    linked = attach(near, stored(several, "several"), "component_id", "size", max(1, near.count())).select("row", "component_id")
    key = F.col(names["doc_id"])
    order = held.select("row", F.struct(key.isNull().alias("none"), key.alias("key"), F.sha2(F.coalesce(names["text"], F.lit("")), 256).alias("sha"),
                                        F.col("row").alias("at")).alias("order"))
    linked = stored(linked.join(order, "row"), "linked")
    stays = linked.groupBy("component_id").agg(F.min("order").alias("order")).select(F.col("order.at").alias("row"))
    gone = stored(linked.select("row").join(stays, "row", "left_anti"), "gone")
    # Rows that are surely not in the filter pass straight through, whole texts unshuffled.
    bits = bloom.filter_bits(gone.count())
    seen, _ = bloom.build(gone.select(F.xxhash64("row").alias("hash")), bits)
    marked = bloom.probed(held.withColumn("hash", F.xxhash64("row")), "hash", seen, bits, "doubt")
    checked = marked.filter("doubt").join(gone, "row", "left_anti")
    return marked.filter(~F.col("doubt")).select(*names.values()).unionByName(checked.select(*names.values())).toDF(*docs.columns)


def mix(docs: DataFrame) -> DataFrame:
    """Each document as often as the mix takes it, i.e. not at all, once, or up to three times.

    Each row is taken as often as the mix says for that row, also if its key repeats or is null.
    """
    held, names = _numbered_rows(docs, "mix-rows")
    taken = mix_sources(held, names["doc_id"], names["text"], names["source"], row="row")
    repeats = stored(taken.filter("repeats > 0").select("row", "repeats"), "repeats")
    copies = F.explode(F.sequence(F.lit(1), F.col("repeats")))
    return held.join(repeats, "row").select(*names.values(), copies.alias("copy")).drop("copy").toDF(*docs.columns)
