"""Very long and odd texts take time in proportion to their length."""

import time

import numpy as np
import public_tokenizers as P
import pytest

from tierflow.llm.html_tree import read_blocks, shown
from tierflow.llm.token_files import library_encoder, token_positions, write_token_files


def seconds(work):
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


@pytest.mark.parametrize("html", [
    "<a " * 330_000, "<i>" * 125_000 + "</b>" * 125_000, "<div>" * 100_000 + "</x>" * 100_000,
    "<b><div>" + "<i>" * 100_000 + "</b>" * 100_000, "<i>" * 100_000 + "<h1>" * 100_000, "<!--" * 250_000, "<a x='" * 150_000,
])
def test_pages_of_a_megabyte(html):
    assert seconds(lambda: read_blocks(html)) < 20


def test_end_tags_of_inline_elements_stay_in_their_block():
    tags = [b.tag for b in read_blocks("<div><b>x<p>y</b>z</p></div><p>q<li>r<li>s</p>")]
    assert tags == ["html", "div", "p", "p", "li", "li"]


def test_a_tag_cut_short_ends_at_the_next_one():
    blocks = read_blocks("<div <p class='k'>text</p>")
    assert [(b.tag, b.marks) for b in blocks] == [("html", ""), ("div", ""), ("p", "k")]


def test_references_are_decoded_text_by_text():
    assert shown(["&am", "p; &amp; &lt", ";"]) == "&amp; & <;"


def test_one_chunk_without_a_blank():
    text = "1!" * 500_000
    encode = library_encoder(P.path("byte_bpe_50k.json"), P.PATTERN)
    found = []
    assert seconds(lambda: found.extend(encode([text]))) < 20
    assert found[0].tolist() == np.tile(encode(["1!1!"])[0], 250_000).tolist()


def test_rows_of_one_key_are_dealt_over_shards(spark, documents, tmp_path):
    rows = [(None, f"text number {i}") for i in range(300)] + [(i, f"other {i}") for i in range(100)] + [(7, "same")] * 50
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], 6)
    spark.conf.set(names[1], "false")
    try:
        path = str(tmp_path / "t")
        write_token_files(documents(*rows).repartition(4), path, lambda: library_encoder(P.path("byte_bpe_50k.json"), P.PATTERN))
        sizes = [r["rows"] for r in spark.read.parquet(path).groupBy("shard").agg({"n_ids": "sum"}).withColumnRenamed("sum(n_ids)", "rows").collect()]
        assert len(sizes) >= 5 and max(sizes) * 2 < sum(sizes)
        got = token_positions(spark, path).collect()
        assert len(got) == 450 and sorted(r.start for r in got)[0] == 0
        keyed = sorted((r.start, r.doc_id) for r in got if r.doc_id is not None)
        assert [k for _, k in keyed] == sorted(k for _, k in keyed)
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)
