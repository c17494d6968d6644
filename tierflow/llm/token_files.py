"""Token ids of documents in packed files, in ascending order of the documents.

A file part is one binary payload of a Parquet row (shard, part): Spark writes, lists and
rereads it wherever the shared folder is. The payload is little-endian:

    magic "S8B1", n_docs u32, n_blocks u32, n_words u32, bits of null keys u8 * ceil(n_docs / 8)
    keys i64 * n_docs, ids per document u32 * n_docs, word offsets u32 * n_blocks, words u64 * n_words

A document's ids are cut into blocks of 512 that are packed by themselves, so any document
can be unpacked alone.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tierflow.llm.chunks import ChunkEncoder
from tierflow.llm.common import arrow_batch, slices, texts_of
from tierflow.llm.simple8b import block_ends, pack, unpack

MAGIC = b"S8B1"
FILE_SCHEMA = "shard int, part int, n_ids long, payload binary"
PART_IDS = 1 << 20
#: Half the number of chunks whose codes a worker remembers.
MOST_CHUNKS = 400_000


def write_payload(keys: list[int | None], ids: list[np.ndarray]) -> bytes:
    sizes = np.array([len(i) for i in ids], np.int64)
    words, offsets = pack(np.concatenate(ids) if ids else np.zeros(0, np.uint64), block_ends(sizes))
    nulls = np.packbits([k is None for k in keys], bitorder="little")
    header = np.array([len(keys), len(offsets), len(words)], "<u4")
    return b"".join([
        MAGIC, header.tobytes(), nulls.tobytes(), np.array([k or 0 for k in keys], "<i8").tobytes(),
        sizes.astype("<u4").tobytes(), offsets.astype("<u4").tobytes(), words.astype("<u8").tobytes(),
    ])


def read_flat(payload: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Keys, numbers of ids, and all ids in a row."""
    if payload[:4] != MAGIC:
        raise ValueError("not a token file")
    n_docs, n_blocks, n_words = np.frombuffer(payload, "<u4", 3, 4)
    at = 16

    def take(kind, count):
        nonlocal at
        values = np.frombuffer(payload, kind, int(count), at)
        at += values.nbytes
        return values

    nulls = np.unpackbits(take("u1", -(-int(n_docs) // 8)), bitorder="little")
    keys, sizes = take("<i8", n_docs).tolist(), take("<u4", n_docs).astype(np.int64)
    offsets, words = take("<u4", n_blocks), take("<u8", n_words)
    values = unpack(words, offsets, block_ends(sizes))
    return [None if null else key for key, null in zip(keys, nulls)], sizes, values


def read_payload(payload: bytes) -> tuple[list[int | None], list[np.ndarray]]:
    keys, sizes, values = read_flat(payload)
    return keys, np.split(values, np.cumsum(sizes)[:-1])


def _byte_letters() -> dict[int, str]:
    """The letter by which byte-level files write each byte: itself if printable, else from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class LibraryEncoder:
    """Ids by a byte-level tokenizer file of the tokenizers library, without added special tokens.

    Texts that hold the text of one of the file's special tokens are handed over whole, as
    the library recognises it there. All others go by chunks and matches of the file's
    pattern: the library's model encodes each match that is not remembered.
    """

    def __init__(self, path: str, pattern: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.letters = str.maketrans({chr(b): c for b, c in _byte_letters().items()})
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.by_chunks = ChunkEncoder(self._match, pattern, most=MOST_CHUNKS)

    def _match(self, match: str) -> bytes:
        if match.isascii() and match.isprintable():  # all but the blank are their own letters
            spelled = match.replace(" ", self.letters[32])
        else:
            spelled = match.encode().decode("latin-1").translate(self.letters)
        return array("I", [token.id for token in self.library.model.tokenize(spelled)]).tobytes()

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        whole = [any(s in text for s in self.special) for text in texts]
        codes = self.by_chunks(["" if w else text for text, w in zip(texts, whole)])
        for i in np.flatnonzero(whole):
            codes[i] = array("I", self.library.encode(texts[i], add_special_tokens=False).ids).tobytes()
        return [np.frombuffer(c, np.uint32) for c in codes]


@cache
def library_encoder(path: str, pattern: str) -> LibraryEncoder:
    return LibraryEncoder(path, pattern)


def write_token_files(docs: DataFrame, out: str, encoder: Callable[[], Callable], end_id: int | None = 0,
                      key: str = "doc_id", text: str = "text", part_ids: int = PART_IDS) -> None:
    """Write the ids of all rows of ``docs`` below ``out``, ascending by key (null first).

    ``encoder()`` gives, on the executor, a function from texts to arrays of ids; ``end_id``
    follows each document, null and empty ones too. The rows are dealt into shards by ranges
    of the key before they are encoded, so each is encoded once; a shard is written in parts
    of about ``part_ids`` ids. Rows with the same key follow each other in the order of a hash
    of their texts, by which many rows of one key, or without one, are dealt over several shards.
    """
    def run(batches):
        encode, shard, part = encoder(), TaskContext.get().partitionId(), 0
        end = np.array([] if end_id is None else [end_id], np.uint32)
        keys, ids, held = [], [], 0
        for batch in slices(batches):
            for k, found in zip(batch.column(0).to_pylist(), encode(texts_of(batch.column(1)))):
                keys.append(k)
                ids.append(np.concatenate([found, end]))
                held += len(ids[-1])
                if held >= part_ids:
                    yield arrow_batch(schema, [shard], [part], [held], [write_payload(keys, ids)])
                    keys, ids, held, part = [], [], 0, part + 1
        if keys:
            yield arrow_batch(schema, [shard], [part], [held], [write_payload(keys, ids)])

    schema = pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("n_ids", pa.int64()), ("payload", pa.binary())])
    (
        docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"), F.xxhash64(docs[text]).alias("lot"))
        .repartitionByRange("doc_id", "lot").sortWithinPartitions("doc_id", "lot").drop("lot")
        .mapInArrow(run, FILE_SCHEMA).write.mode("overwrite").parquet(out)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """shard, part, nth (place in the part), doc_id, ids of every document in the files."""
    schema = pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("nth", pa.int32()), ("doc_id", pa.int64()),
                        ("ids", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            for shard, part, payload in zip(*(c.to_pylist() for c in batch.columns)):
                keys, ids = read_payload(payload)
                n = len(keys)
                lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, ids)]).astype(np.int32),
                                                 np.concatenate(ids).astype(np.int64))
                yield arrow_batch(schema, [shard] * n, [part] * n, range(n), keys, lists)

    return spark.read.schema(FILE_SCHEMA).parquet(path).drop("n_ids").mapInArrow(
        run, "shard int, part int, nth int, doc_id long, ids array<long>")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """shard, part, nth, doc_id, n_tokens, ids_crc32 of every document, from its unpacked ids."""
    schema = pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("nth", pa.int32()), ("doc_id", pa.int64()),
                        ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        for batch in batches:
            for shard, part, payload in zip(*(c.to_pylist() for c in batch.columns)):
                keys, sizes, values = read_flat(payload)
                n, whole, ends = len(keys), memoryview(values.astype("<u4").tobytes()), (4 * np.cumsum(sizes)).tolist()
                crcs = [zlib.crc32(whole[start:end]) for start, end in zip([0, *ends], ends)]
                yield arrow_batch(schema, [shard] * n, [part] * n, range(n), keys, pa.array(sizes), crcs)

    return spark.read.schema(FILE_SCHEMA).parquet(path).drop("n_ids").mapInArrow(
        run, "shard int, part int, nth int, doc_id long, n_tokens long, ids_crc32 long")


def token_positions(spark: SparkSession, path: str) -> DataFrame:
    """``read_index`` with ``start``: the number of ids of all documents before.

    Within a shard a running sum; the shards before it, one row each, are summed first,
    from the numbers beside the payloads.
    """
    shards = spark.read.schema(FILE_SCHEMA).parquet(path).groupBy("shard").agg(F.sum("n_ids").alias("of_shard"))
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("of_shard").over(ahead), F.lit(0)).alias("of_earlier"))
    inside = Window.partitionBy("shard").orderBy("part", "nth").rowsBetween(Window.unboundedPreceding, -1)
    running = read_index(spark, path).withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return running.join(shards, "shard").withColumn("start", F.col("of_earlier") + F.col("inside"))
