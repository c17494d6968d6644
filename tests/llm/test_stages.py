"""The pipeline's stages against plain Python, on odd tables and in a row."""

import random
import re
from collections import Counter

import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline
from tierflow.llm import bpe, stages
from tierflow.llm.mixing import mix_sources

EN = "the cat and the dog were in the house of the old man with that hat"
DE = "der hund und die katze sind in dem haus und der mann ist nicht da"


def strip(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


@pytest.fixture
def docs(documents, clashing):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.sample((EN if i % 2 else DE).split() * 4, 30)), "en" if i % 2 else "de", f"s{i % 3}") for i in range(40)]
    rows += [(50, rows[3][1], "en", "s0"), (51, rows[3][1] + " ", "en", None), (52, None, "en", "s1"), (53, "!!!", None, "s1"), (54, "漢字" * 99, None, "s2"),
             (4, rows[4][1], "de", "s1"), (None, rows[5][1] + " more", "en", "s0"), (60, EN + " " + rows[7][1], "en", "s0"), (61, EN + " " + rows[7][1] + " x", "en", "s0")]
    return clashing(documents(*rows))


def as_rows(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_language_stage(docs):
    got = stages.keep_language(docs)
    assert got.columns == docs.columns
    assert as_rows(got) == Counter({k: c for k, c in as_rows(docs).items() if k[0] not in (52, 53, 54)})


def test_exact_stage(docs):
    got = stages.drop_exact_copies(docs)
    assert got.columns == docs.columns
    best = {}
    for doc_id, text in as_rows(docs):
        order = (-len(text or ""), doc_id is None, doc_id or 0)
        if strip(text) not in best or order < best[strip(text)][0]:
            best[strip(text)] = order, (doc_id, text)
    assert as_rows(got) == Counter(row for _, row in best.values())


def test_near_stage(docs):
    got = as_rows(stages.drop_near_copies(docs))
    assert max(got.values()) == 1 and {k for k, _ in got} == {r.doc_id for r in docs.collect()} - {50, 51, 61, None}


def test_mixing_stage(docs):
    exact = stages.drop_exact_copies(docs)
    taken = Counter()
    for row in mix_sources(exact).collect():
        taken[row.doc_id] += row.repeats
    got = stages.mix(exact)
    assert got.columns == docs.columns
    assert Counter(r.doc_id for r in got.collect()) == +taken


def test_stages_on_an_empty_table(spark, docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), "").count() == 0


def test_pipeline(spark):
    sf = "/root/testdata/sf0.001"
    got = corpus_pipeline.run(spark, sf).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path(corpus_pipeline.RANKS)), special_tokens={})
    assert 0 < len(got) and len({strip(texts[r.doc_id]) for r in got}) == len({r.doc_id for r in got})
    assert max(Counter(r.doc_id for r in got).values()) <= 3
    for row in got:
        assert row.ids == library.encode_ordinary(texts[row.doc_id]) and row.n_tokens == len(row.ids)


def test_language_stage_without_labels(documents):
    docs = documents((1, "some words"), (2, None), (3, "!!!"), (3, "!!!"), (None, ""))
    got = stages.keep_language(docs)
    assert got.columns == docs.columns and as_rows(got) == as_rows(docs)
