"""The registered corpus queries and their SQL counterparts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tierflow.llm.bpe import encode_documents
from tierflow.llm.common import table
from tierflow.llm.exact_dedup import exact_dedup
from tierflow.llm.hard_negatives import mine_negatives
from tierflow.llm.html_content import extract_content, learn_content
from tierflow.llm.langid import identify_documents
from tierflow.llm.lm import score_documents
from tierflow.llm.mixing import MAX_EPOCHS, ROUNDS, SEED, mix_sources
from tierflow.llm.near_dup import near_duplicates
from tierflow.llm.phrases import mine_phrases
from tierflow.llm.repeats import remove_repeats
from tierflow.llm.secrets import scan_secrets
from tierflow.llm.sql_mining import NEGATIVES, PASSAGES, PHRASES
from tierflow.llm.token_files import library_encoder, token_positions, write_token_files
from tierflow.llm.topk import top_k
from tierflow.session import scratch_path


def op1_secrets(spark, sf_dir):
    return scan_secrets(table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_documents(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, with_ids=False)


def op3_language(spark, sf_dir):
    return identify_documents(table(spark, sf_dir, "documents"))


def op4_lm_scores(spark, sf_dir):
    return score_documents(table(spark, sf_dir, "documents"))


def op5_main_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return extract_content(pages, learn_content(pages))


def op6_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents")).drop("n_chars")


def op8_ngram_jaccard(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_token_files(spark, sf_dir):
    vocabulary, files = public_tokenizers.path("byte_bpe_50k.json"), scratch_path(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), files, lambda: library_encoder(vocabulary, public_tokenizers.PATTERN))
    return token_positions(spark, files).select("doc_id", "start", "n_tokens", "ids_crc32")


def op10_mixing(spark, sf_dir):
    return mix_sources(table(spark, sf_dir, "documents")).drop("repeats")


def op7_top_k(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"))


def op11_phrases(spark, sf_dir):
    return mine_phrases(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(vectors.withColumn("label", moved))


def op13_repeats(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents"))


QUERIES = {q.__name__: q for q in (op1_secrets, op2_byte_bpe, op3_language, op4_lm_scores, op5_main_text, op6_exact_dedup, op7_top_k, op8_ngram_jaccard, op9_token_files, op10_mixing, op11_phrases, op12_hard_negatives, op13_repeats)}

def _mixing_sql() -> str:
    """The mix in SQL; a round of exchanges per step."""
    sql = rf"""
        WITH RECURSIVE sized AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                   md5('{SEED}:' || doc_id) AS lot
            FROM documents),
        numbered AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
            FROM sized GROUP BY source),
        whole AS (SELECT sum(source_size)::BIGINT AS words, sum(weight)::BIGINT AS weights FROM numbered),
        filled AS (
            SELECT 0 AS step, words / weights AS level FROM whole
            UNION ALL
            SELECT step + 1, (SELECT (w.words - coalesce(sum({MAX_EPOCHS} * source_size) FILTER ({MAX_EPOCHS} * source_size <= weight * level), 0))
                                     / sum(weight) FILTER ({MAX_EPOCHS} * source_size > weight * level)
                              FROM numbered, whole w GROUP BY w.words)
            FROM filled WHERE step < 40 AND level IS NOT NULL),
        reached AS (SELECT arg_max(level, step) AS level FROM filled WHERE step = 40 OR level IS NULL),
        planned AS (
            SELECT n.source, source_size, target, floor(epochs) AS whole, epochs - floor(epochs) AS part,
                   ('0x' || substr(md5('{SEED}:' || coalesce('0' || n.source, '1')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS phase
            FROM (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS epochs
                  FROM (SELECT source, source_size,
                               CASE WHEN level IS NULL THEN ({MAX_EPOCHS} * source_size)::DOUBLE
                                    ELSE least(({MAX_EPOCHS} * source_size)::DOUBLE, weight * level) END AS target
                        FROM numbered, reached)) n),
        chosen0 AS (
            SELECT doc_id, s.source, size, source_size, target, whole, pos,
                   floor((pos + 1) * part + phase) > floor(pos * part + phase) AS more
            FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY size DESC, lot, doc_id) - 1 AS pos FROM sized) s
            JOIN planned p ON s.source IS NOT DISTINCT FROM p.source)"""
    for i in range(ROUNDS):
        sql += f""",
        off{i} AS (SELECT *, target - sum(size * (whole + more::INT)) OVER (PARTITION BY source) AS off FROM chosen{i}),
        near{i} AS (SELECT *, abs(off - CASE WHEN more THEN -size ELSE size END) AS remaining FROM off{i}),
        best{i} AS (SELECT *, row_number() OVER (
                        PARTITION BY source ORDER BY remaining < abs(off) AND whole < {MAX_EPOCHS} DESC, remaining, pos) = 1
                        AND remaining < abs(off) AND whole < {MAX_EPOCHS} AS swap FROM near{i}),
        chosen{i + 1} AS (SELECT doc_id, source, size, source_size, target, whole, pos, more <> swap AS more FROM best{i})"""
    return sql + f"""
        SELECT doc_id, size::BIGINT AS size, source_size, target, (size * (whole + more::INT))::BIGINT AS taken
        FROM chosen{ROUNDS}"""


SQL = {
    "op13_repeats": PASSAGES,
    "op11_phrases": PHRASES,
    "op12_hard_negatives": NEGATIVES,
    "op8_ngram_jaccard": r"""
        WITH RECURSIVE worded AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        shingled AS (
            SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM worded WHERE len(w) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id),
        links AS (
            SELECT p.a, p.b FROM (
                SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
                FROM shingled x JOIN shingled y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL) p
            JOIN sizes m ON m.doc_id = p.a JOIN sizes n ON n.doc_id = p.b
            WHERE 100 * shared >= 80 * (m.n + n.n - shared)),
        reach AS (
            SELECT doc_id AS a, doc_id AS b FROM documents
            UNION
            SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
        SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, c.component_id
        FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
        JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = d.doc_id""",
    "op10_mixing": _mixing_sql(),
    "op7_top_k": """
        WITH vectors AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
            FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
        SELECT * FROM (
            SELECT query_id, vec_id, score,
                   (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank
            FROM scored) WHERE rank <= 20""",
    "op6_exact_dedup": r"""
        WITH texts AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id, text_sha256,
               first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               doc_id = first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS kept
        FROM texts""",
}
