"""Language identification as inference of a mixture of languages.

Each language is a distribution over hashed byte trigrams. A document is taken to be drawn
from a mixture of languages; expectation-maximisation estimates the proportions. Every
language costs a penalty that grows with the logarithm of the document's length, and the
set with the best penalised likelihood is selected.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tierflow.llm.common import arrow_batch, remainder, slices, texts_of

BUCKETS = 1 << 14
UNKNOWN = "und"
#: Rows and bytes whose trigrams are held together: they take some thirty times the bytes.
AT_ONCE = 64, 1 << 19
# Everything that is no letter becomes a blank; bytes from 128 on are parts of letters.
_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTERS[128:] = np.arange(128, 256)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every trigram of all texts, ends of the texts' shares).

    Trigrams with two blanks side by side say nothing and are left out.
    """
    parts = [b" " + text.lower().encode() + b" " for text in texts]
    data = _LETTERS[np.frombuffer(b"".join(parts), np.uint8)]
    if len(data) < 3:
        return np.zeros(0, np.uint16), np.zeros(len(parts), np.int64)
    a, b, c = data[:-2].astype(np.uint32), data[1:-1].astype(np.uint32), data[2:].astype(np.uint32)
    told = ~(((a == 32) & (b == 32)) | ((b == 32) & (c == 32)))
    with np.errstate(over="ignore"):
        bucket = ((a << np.uint32(16) | b << np.uint32(8) | c) * np.uint32(2654435761) >> np.uint32(18)).astype(np.uint16)
    # A text's last trigram starts two bytes before its end; those across a border have two blanks.
    ends = np.minimum(np.cumsum([len(p) for p in parts]), len(told))
    share = np.concatenate([[0], np.cumsum(told)])
    return bucket[told], share[ends]


@dataclass
class Languages:
    """The learned languages in order of their names, and their trigram probabilities."""

    names: list[str]
    chance: np.ndarray  # one row per language

    def infer(self, counts: np.ndarray, penalty: float, rounds: int = 30) -> tuple[dict[str, float], bool]:
        """(proportion of each selected language, largest first; do they explain the document?)

        ``counts``: occurrences per bucket. A document that all languages together explain
        worse than even chance over all buckets is not explained.
        """
        seen = np.flatnonzero(counts)
        if not len(seen) or not self.names:
            return {}, False
        n, c = self.chance[:, seen], counts[seen].astype(np.float64)
        size = c.sum()
        single = np.log(n) @ c
        best = int(single.argmax())
        chosen, weight = [best], np.ones(1)
        everything, likelihood = self._mix(n, c, size, rounds)
        price = penalty * math.log(1 + size)
        # More languages can gain at most what all of them gain.
        if likelihood - single[best] > price:
            reached = single[best] - price
            order = np.argsort(-everything, kind="stable")
            for k in range(2, len(order) + 1):
                mixed, likelihood = self._mix(n[order[:k]], c, size, rounds)
                if likelihood - k * price > reached:
                    reached, chosen, weight = likelihood - k * price, list(order[:k]), mixed
        ranked = sorted(zip(weight.tolist(), chosen), key=lambda w: (-w[0], w[1]))
        explained = max(likelihood, single[best]) > -size * math.log(BUCKETS)
        return {self.names[i]: w for w, i in ranked}, bool(explained)

    @staticmethod
    def _mix(chance, counts, size, rounds):
        """Proportions by expectation-maximisation, and the log-likelihood they reach."""
        weight = np.full(len(chance), 1 / len(chance))
        for _ in range(rounds):
            after = weight * (chance @ (counts / (weight @ chance))) / size
            moved = np.abs(after - weight).max()
            weight = after
            if moved < 1e-3:
                break
        return weight, float(counts @ np.log(weight @ chance))


def _count(batches):
    """Trigram counts per language of a partition."""
    totals: dict[str, np.ndarray] = {}
    for part in slices(batches, *AT_ONCE):
        buckets, ends = trigrams(texts_of(part.column(1)))
        for name, counted in zip(part.column(0).to_pylist(), np.split(buckets, ends[:-1])):
            if name not in totals:
                totals[name] = np.zeros(BUCKETS, np.int64)
            totals[name] += np.bincount(counted, minlength=BUCKETS)
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])
    for name, counts in totals.items():
        seen = np.flatnonzero(counts)
        yield arrow_batch(schema, [name] * len(seen), pa.array(seen.astype(np.int32)), pa.array(counts[seen]))


def learn_languages(labelled: DataFrame, lang: str = "lang", text: str = "text", smooth: float = 0.5) -> Languages:
    """Trigram distributions from all labelled rows whose label is not null.

    Each partition sums its own counts before they are shuffled; the driver gets one number
    per language and bucket at most.
    """
    counted = labelled.select(labelled[lang].cast("string").alias("lang"), labelled[text].alias("text")).filter("lang IS NOT NULL")
    sums = counted.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = sums.toArrow()
    names = sorted(set(found.column("lang").to_pylist()))
    table = np.zeros((len(names), BUCKETS))
    rows = np.array([names.index(name) for name in found.column("lang").to_pylist()], np.int64)
    table[rows, found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return Languages(names, (table + smooth) / (table.sum(axis=1, keepdims=True) + smooth * BUCKETS))


_OUT = pa.schema([("lang_pred", pa.string()), ("score", pa.float64()), ("explained", pa.bool_()), ("mixture", pa.string())])
PREDICTED = "lang_pred string, score double, explained boolean, mixture string"


def identify(docs: DataFrame, languages: Languages, text: str = "text", keep: list[str] | None = None,
             penalty: float = 4.0) -> DataFrame:
    """The columns ``keep`` of ``docs`` with lang_pred, score, explained and mixture, in one pass.

    score is the proportion of the predicted language; mixture lists all selected ones as
    name:proportion. Null texts and texts without a letter are ``und`` with score 0 and not
    explained. Ties go to the name that sorts first. ``keep`` may not name the added columns.
    """
    keep = docs.columns if keep is None else keep
    at = len(keep)
    model = docs.sparkSession.sparkContext.broadcast(languages)

    def run(batches):
        known = model.value
        for part in slices(batches, *AT_ONCE):
            texts = texts_of(part.column(at))
            buckets, ends = trigrams(texts)
            rows = []
            for own, counted in zip(texts, np.split(buckets, ends[:-1])):
                mixture, explained = {}, False
                if any(map(str.isalpha, own)):
                    mixture, explained = known.infer(np.bincount(counted, minlength=BUCKETS), penalty)
                name, score = next(iter(mixture.items()), (UNKNOWN, 0.0))
                rows.append((name, min(1.0, score), explained, ",".join(f"{k}:{v:.3f}" for k, v in mixture.items())))
            added = arrow_batch(_OUT, *zip(*rows))
            yield pa.RecordBatch.from_arrays(part.columns[:at] + added.columns, [*keep, *_OUT.names])

    source = docs.select(*(docs[c] for c in keep), docs[text].alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:at])
    return source.mapInArrow(run, ", ".join(filter(None, (kinds, PREDICTED))))


def held_out(key: str = "doc_id") -> F.Column:
    """The rows that the query's model never learns from."""
    return remainder(key, 4) == 2


def identify_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and more of every row, learned from the other rows' labels.

    Null texts and texts without a letter are ``und`` with score 0, and so is everything if no
    row is labelled. A null key counts as the empty text when rows are held out. Repeated rows
    count each, in learning too. An empty table gives no rows.
    """
    languages = learn_languages(docs.filter(~held_out()))
    rows = docs.select(docs.doc_id.cast("long").alias("doc_id"), held_out().alias("held_out"), docs.text)
    return identify(rows, languages, keep=["doc_id", "held_out"])
