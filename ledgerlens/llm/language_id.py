"""Language ID by mixture inference.

Training counts letter trigrams (hashed to a fixed number of buckets) of every
labelled training text, one count vector per language, summed by Spark. A text
is modelled as a mixture of the learned languages: expectation-maximisation
estimates the proportions from the trigram likelihoods, starting with all
languages; then the language with the smallest proportion is dropped as long
as the likelihood, less ``PENALTY * log(1 + trigrams)`` for each language, does
not fall. The prediction is the language with the largest proportion left.

The model has BUCKETS numbers per language whatever the size of the corpus, so
it is broadcast; all else stays in the tasks.
"""
from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import parts, record_batch, slices

BUCKETS = 1 << 16
SMOOTHING = 0.1
PENALTY = 2.0
MAX_STEPS = 30
TOLERANCE = 1e-3
UNDETERMINED = "und"
#: Texts whose characters are handled together, by count and by characters.
GROUP_DOCS, GROUP_CHARS = 300, 2_000_000

COUNTS_DDL = "lang string, bucket int, n bigint"
COUNTS = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])
PREDICTED_DDL = "doc_id bigint, lang_pred string, score double, langs array<string>, shares array<double>"
PREDICTED = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()),
                       ("langs", pa.list_(pa.string())), ("shares", pa.list_(pa.float64()))])


@cache
def _letters() -> np.ndarray:
    """Code point -> lower-case code point of a letter, 0 for anything else."""
    out = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every trigram of the texts in turn, and where each text's trigrams end.

    Runs of non-letters are one blank; a text is taken between blanks.
    """
    joined = "\n".join(["", *texts, ""])
    c = _letters()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    blank = c == 0
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    keep[0] = True
    # A text's last separator stays even after a blank, so that every text ends in one.
    place = np.cumsum(keep)
    kept = c[keep].astype(np.uint64)
    if len(kept) < 3:
        return np.zeros(0, np.uint16), np.zeros(len(texts), np.int64)
    mixed = kept[:-2] * np.uint64(0x9E3779B97F4A7C15) + kept[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + kept[2:] * np.uint64(0x165667B19E3779F9)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    buckets = (mixed >> np.uint64(48)).astype(np.uint16)
    # Trigrams around a blank belong to two words; one with the blank in the middle may join two texts and is left out.
    inside = kept[1:-1] != 0
    upto = np.concatenate([[0], np.cumsum(inside)])
    stop = np.clip(place[ends] - 2, 0, len(buckets))
    return buckets[inside], upto[stop]


def _count(batches):
    total: dict[str, np.ndarray] = {}
    for batch in parts(batches):
        langs = batch.column(0).to_pylist()
        texts = [t or "" for t in batch.column(1).to_pylist()]
        for lang in set(langs):
            own = [t for t, x in zip(texts, langs, strict=True) if x == lang]
            counts = total.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for a, b in slices(own, GROUP_DOCS, GROUP_CHARS):
                counts += np.bincount(trigrams(own[a:b])[0], minlength=BUCKETS)
    for lang, counts in total.items():
        some = np.flatnonzero(counts)
        yield record_batch(COUNTS, [[lang] * len(some), some.astype(np.int32), counts[some]])


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order of name and their smoothed bucket probabilities, from rows of (lang, text)."""
    counted = docs.select(F.col("lang").cast("string"), F.col("text").cast("string")).where("lang is not null").mapInArrow(
        _count, COUNTS_DDL)
    # At most BUCKETS rows per language.
    rows = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(rows.column("lang").to_pylist()))
    counts = np.full((len(langs), BUCKETS), SMOOTHING)
    if langs:
        at = {x: i for i, x in enumerate(langs)}
        where = np.array([at[x] for x in rows.column("lang").to_pylist()])
        counts[where, rows.column("bucket").to_numpy()] += rows.column("n").to_numpy()
    return langs, counts / counts.sum(axis=1, keepdims=True) if langs else counts


def mixture(p: np.ndarray, n: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions of the columns of p (term likelihoods) for terms seen n times, and the log-likelihood."""
    total, share = n.sum(), start
    for _ in range(MAX_STEPS):
        new = share * ((n / (p @ share)) @ p) / total
        moved = np.abs(new - share).max()
        share = new
        if moved < TOLERANCE:
            break
    return share, float(n @ np.log(p @ share))


def choose(p: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(columns chosen, their proportions): backward elimination under the penalised likelihood."""
    cost = PENALTY * np.log1p(n.sum())
    chosen = np.arange(p.shape[1])
    share, ll = mixture(p, n, np.full(len(chosen), 1 / len(chosen)))
    while len(chosen) > 1:
        least = share.argmin()
        left = np.delete(chosen, least)
        start = np.delete(share, least)
        if start.sum() <= 0:
            start = np.full(len(left), 1.0)
        if len(left) == 1:
            new, new_ll = np.ones(1), float(n @ np.log(p[:, left[0]]))
        else:
            new, new_ll = mixture(p[:, left], n, start / start.sum())
        if new_ll - cost * len(left) < ll - cost * len(chosen):
            break
        chosen, share, ll = left, new, new_ll
    return chosen, share


def predict_texts(texts: list[str], model: tuple[list[str], np.ndarray]) -> list[tuple[str, float, list[str], list[float]]]:
    """(prediction, its proportion, languages chosen, their proportions) of each text."""
    langs, p = model
    columns = p.T
    out: list[tuple] = []
    for a, b in slices(texts, GROUP_DOCS, GROUP_CHARS):
        buckets, ends = trigrams(texts[a:b])
        begin = 0
        for end in ends.tolist():
            terms, n = np.unique(buckets[begin:end], return_counts=True)
            begin = end
            if not len(terms) or not langs:
                out.append((UNDETERMINED, 0.0, [], []))
                continue
            chosen, share = choose(columns[terms], n.astype(float))
            order = np.argsort(-share, kind="stable")
            names = [langs[k] for k in chosen[order].tolist()]
            out.append((names[0], float(min(1.0, share[order[0]])), names, share[order].tolist()))
    return out


def _sent(spark: SparkSession, model: tuple[list[str], np.ndarray]):
    """The model broadcast, with the probabilities of a bucket side by side."""
    return spark.sparkContext.broadcast((model[0], np.asfortranarray(model[1])))


def predict(spark: SparkSession, docs: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """doc_id, lang_pred, score (its proportion), langs and shares of the chosen set; the text is all that counts."""
    sent = _sent(spark, model)

    def run(batches):
        for batch in parts(batches):
            found = predict_texts([t or "" for t in batch.column(1).to_pylist()], sent.value)
            yield record_batch(PREDICTED, [batch.column(0), *(zip(*found, strict=True) if found else [[]] * 4)])
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, PREDICTED_DDL)


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, in which a language is found; learned as in ``identify``."""
    sent = _sent(docs.sparkSession, train(docs.where(F.col("doc_id").isNotNull() & ~held_out())))
    text = docs.columns.index("text")

    def run(batches):
        for batch in parts(batches):
            found = predict_texts([t or "" for t in batch.column(text).to_pylist()], sent.value)
            yield batch.filter(pa.array([x[0] != UNDETERMINED for x in found], pa.bool_()))
    return docs.mapInArrow(run, docs.schema)


def held_out():
    """Whether a document is kept from training: crc32 of its doc_id as text is 1 modulo 3 (never for a null doc_id)."""
    crc = F.crc32(F.col("doc_id").cast("bigint").cast("string").cast("binary"))
    return F.coalesce(crc % 3 == 1, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the rows of ``docs`` that are not held out and have a lang; predict every row.

    Gives doc_id, held_out, lang_pred, score, langs, shares, one row per input
    row. A null text, or one without a letter, is ``und`` with score 0, as is
    every text if there is nothing to learn from. Rows with a null doc_id are
    predicted but not learned from. Repeated rows count as often as they occur.
    """
    model = train(docs.where(F.col("doc_id").isNotNull() & ~held_out()))
    return predict(docs.sparkSession, docs, model).withColumn("held_out", held_out()).select(
        "doc_id", "held_out", "lang_pred", "score", "langs", "shares")
