"""Stages and the pipeline on rows whose keys repeat or are null."""

import hashlib
import random
from collections import Counter

import pyarrow as pa
import pytest

import corpus_pipeline
from tierflow.llm import stages
from tierflow.llm.mixing import mix_sources


def texts_of(count, seed=4):
    rng = random.Random(seed)
    return [" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(30 + i)) for i in range(count)]


def test_near_stage_keeps_rows_that_share_a_key(documents, clashing):
    t = texts_of(9)
    rows = [(None, t[0]), (None, t[1]), (None, t[2]), (7, t[3]), (7, t[4]), (8, t[5]), (None, t[5] + " x"), (7, t[5] + " y"),
            (None, t[6]), (None, t[6] + " z"), (9, None), (None, None), (9, "")]
    got = Counter((r.doc_id, r.text) for r in stages.drop_near_copies(clashing(documents(*rows))).collect())
    one_of = min((t[6], t[6] + " z"), key=lambda x: hashlib.sha256(x.encode()).hexdigest())
    # Of the three linked rows the one with key 7 stays; of the two without keys, one.
    assert got == Counter([(None, t[0]), (None, t[1]), (None, t[2]), (7, t[3]), (7, t[4]), (7, t[5] + " y"),
                           (None, one_of), (9, None), (None, None), (9, "")])


def test_mixing_stage_takes_rows_that_share_a_key_by_themselves(documents, clashing):
    rows = [(None if i % 3 else i % 9, text, None, f"s{i % 4 == 0}") for i, text in enumerate(texts_of(40))]
    docs = clashing(documents(*rows))
    expected = Counter()
    for r in mix_sources(docs).collect():
        expected[r.doc_id, r.size] += r.repeats
    got = Counter((r.doc_id, len(r.text.split())) for r in stages.mix(docs).collect())
    assert got == +expected and len({c for (k, _), c in expected.items() if k is None}) > 1


@pytest.mark.parametrize("stage", ["language", "near_dedup"])
def test_stages_hand_python_bounded_batches(spark, documents, stage):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "64m")
    try:
        docs = documents(*((i, f"{i} " + "word " * 20_000) for i in range(200))).coalesce(1)
        dict(corpus_pipeline.STAGES)[stage](spark, docs, "")
        taken = docs.select("text").mapInArrow(
            lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["size"]) for b in batches), "size long").collect()
    finally:
        spark.conf.set(name, before)
    assert sum(r["size"] for r in taken) > 20_000_000 and max(r["size"] for r in taken) < 5 << 20
