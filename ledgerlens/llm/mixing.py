"""Mixing documents to target weights of soft domains.

A classifier learned from a labelled table gives each document its posterior
over the domains: a Bernoulli model over hashed words, word endings and the
document's shape, restricted to features of clearly higher odds in one domain than
in the others together. Posteriors are kept in thousandths. Then nonnegative document rates
are fitted so that the expected tokens of each domain, sum(rate * tokens *
posterior), match the targets: accelerated projected gradient on the squared
deviation of each domain over the domain's own tokens, with a small pull to rate
1. So a rare domain is met as well as a common one.

In the metric of token counts the gradient of a document depends on its
posterior alone, so documents of one posterior share their rate. Every step is
one Spark aggregation over the table of distinct posteriors and their tokens;
only the sums per domain come to the driver. A document's rate follows from its
posterior and the steps taken, as a Spark expression.
"""
from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import explode_copies, materialize, parts, record_batch, slices

#: Labelled rows the classifier is fitted on at most, the first by hash of doc_id.
LABELLED_ROWS = 20_000
FEATURE_BUCKETS = 1 << 18
FEATURES = 4096
MIN_SCORE, MIN_RATIO, MIN_DOCS = 5.0, 3.0, 8
THOUSAND = 1000
#: Against a curvature of 1 for the documents of one domain, whatever its share.
PULL = 1e-4
MAX_STEPS = 60
#: Deviation of each domain from its target, as a part of the target or, for target 0, of the domain's tokens.
TOLERANCE = 1e-4
GROUP_DOCS, GROUP_CHARS = 1000, 4_000_000
#: Signs of a word's end that tell endings apart.
MAX_SIGNS = 8
#: The bucket of a word without signs at its end.
NO_ENDING = 0

COUNTS_DDL = "domain string, bucket int, n bigint"
COUNTS = pa.schema([("domain", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])
SCORED_DDL = "doc_id bigint, n_tokens bigint, posterior array<int>"
SCORED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("posterior", pa.list_(pa.int32()))])
#: Bucket in which the number of documents of a domain is counted.
ALL = FEATURE_BUCKETS
SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _bucket(name: str) -> int:
    return xxhash.xxh3_64_intdigest(name) & (FEATURE_BUCKETS - 1)


@lru_cache(100_000)
def _ending(signs: str) -> int:
    return _bucket("e" + signs[:MAX_SIGNS])


def features(texts: list[str], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket) of each feature present, once each, and the number of words of each text.

    Features: lower-case words without the signs around them, the signs at a
    word's end, whether all is upper case, and how often words repeat. With
    ``wanted`` (a flag for each bucket) only those are given.
    """
    trimmed = pc.ascii_trim_whitespace(pa.array(texts, pa.large_string()))
    split = pc.ascii_split_whitespace(trimmed)  # an empty text has one empty word here
    flat, lengths = split.flatten(), np.diff(split.offsets.to_numpy())
    n_words = lengths * pc.greater(pc.binary_length(trimmed), 0).to_numpy(zero_copy_only=False)
    coded = flat.dictionary_encode()
    words, ends = [], []
    for word in coded.dictionary.to_pylist():
        core = word.rstrip(SIGNS)
        words.append(_bucket(core.lstrip(SIGNS).lower()))
        ends.append(_ending(word[len(core):]) if len(core) < len(word) else NO_ENDING)
    words, ends = np.array(words, np.int64), np.array(ends, np.int64)
    size = max(1, len(words))
    pairs = np.sort(np.repeat(np.arange(len(texts)), lengths) * size + coded.indices.to_numpy())
    doc, at = np.divmod(pairs[np.append(True, pairs[1:] != pairs[:-1])[:len(pairs)]], size)
    distinct = np.bincount(doc, minlength=len(texts))
    shape = np.array([_bucket(f"s{t.isupper()},{int(4 * math.log2(max(1, n) / max(1, d)))}") for t, n, d in zip(
        texts, n_words.tolist(), distinct.tolist(), strict=True)], np.int64)
    owner, bucket = np.concatenate([doc, doc, np.arange(len(texts))]), np.concatenate([words[at], ends[at], shape])
    if wanted is not None:
        owner, bucket = owner[wanted[bucket]], bucket[wanted[bucket]]
    both = np.sort(owner * FEATURE_BUCKETS + bucket)
    return *np.divmod(both[np.append(True, both[1:] != both[:-1])[:len(both)]], FEATURE_BUCKETS), n_words


def _count(batches):
    total: dict[str, np.ndarray] = {}
    for batch in parts(batches):
        domains = batch.column(0).to_pylist()
        texts = [t or "" for t in batch.column(1).to_pylist()]
        for domain in set(domains):
            own = [t for t, x in zip(texts, domains, strict=True) if x == domain]
            counts = total.setdefault(domain, np.zeros(FEATURE_BUCKETS + 1, np.int64))
            counts[ALL] += len(own)
            for a, b in slices(own, GROUP_DOCS, GROUP_CHARS):
                counts[:ALL] += np.bincount(features(own[a:b])[1], minlength=FEATURE_BUCKETS)
    for domain, counts in total.items():
        some = np.flatnonzero(counts)
        yield record_batch(COUNTS, [[domain] * len(some), some.astype(np.int32), counts[some]])


@dataclass
class Classifier:
    """Log odds of the domains: start + the weights of the features present."""
    domains: list[str]
    start: np.ndarray
    buckets: np.ndarray
    weights: np.ndarray

    def posterior(self, doc: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
        """Thousandths of each domain for n documents."""
        logit = np.tile(self.start, (n, 1))
        if len(self.buckets):
            at = np.minimum(np.searchsorted(self.buckets, bucket), len(self.buckets) - 1)
            used = self.buckets[at] == bucket
            np.add.at(logit, doc[used], self.weights[at[used]])
        p = np.exp(logit - logit.max(axis=1, keepdims=True))
        exact = p / p.sum(axis=1, keepdims=True) * THOUSAND
        low = np.floor(exact)
        left = (THOUSAND - low.sum(axis=1)).astype(int)
        rank = np.argsort(np.argsort(low - exact, axis=1, kind="stable"), axis=1, kind="stable")
        return (low + (rank < left[:, None])).astype(np.int32)


def fit(docs: DataFrame, labelled: DataFrame, domains: list[str], labelled_rows: int = LABELLED_ROWS) -> Classifier:
    """Learn from documents whose doc_id is labelled (doc_id, domain); at most ``labelled_rows`` labels are used."""
    labels = labelled.where(F.col("doc_id").isNotNull() & F.col("domain").isin(domains)).groupBy("doc_id").agg(
        F.max("domain").alias("domain"))
    bounded = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled_rows)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(bounded), "doc_id")
    counted = texts.select("domain", "text").mapInArrow(_count, COUNTS_DDL).groupBy("domain", "bucket").agg(F.sum("n").alias("n"))
    rows = counted.toArrow()  # at most FEATURE_BUCKETS + 1 rows for each domain
    counts = np.zeros((len(domains), FEATURE_BUCKETS + 1))
    if rows.num_rows:
        at = {d: i for i, d in enumerate(domains)}
        counts[[at[d] for d in rows.column("domain").to_pylist()], rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    size, present = counts[:, ALL:], counts[:, :ALL]
    total, all_docs = present.sum(axis=0), size.sum()
    rate, mean = (present + 0.5) / (size + 1), (total + 0.5) / (all_docs + 1)
    # Each domain against the other domains together, so that its share of the labels does not bound the odds.
    rest = all_docs - size
    other = (total - present + 0.5) / (rest + 1)
    odds = np.log(rate / (1 - rate)) - np.log(other / (1 - other))
    score = (rate - other) / np.sqrt(mean * (1 - mean) * (1 / np.maximum(size, 1) + 1 / np.maximum(rest, 1)))
    usable = (size > 0) & (rest > 0) & (odds >= math.log(MIN_RATIO))
    strength = np.where(total >= MIN_DOCS, np.where(usable, score, 0).max(axis=0), 0)
    chosen = np.sort(np.argsort(-strength, kind="stable")[:FEATURES])
    chosen = chosen[strength[chosen] >= MIN_SCORE]
    prior = np.log((size[:, 0] + 1) / (all_docs + len(domains)))
    p = rate[:, chosen]
    return Classifier(domains, prior + np.log1p(-p).sum(axis=1), chosen, (np.log(p) - np.log1p(-p)).T)


def score(docs: DataFrame, model: Classifier) -> DataFrame:
    """doc_id, n_tokens (words), posterior (thousandths, in the order of the domains) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        wanted = np.zeros(FEATURE_BUCKETS, bool)
        wanted[sent.value.buckets] = True
        for batch in parts(batches):
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in slices(texts, GROUP_DOCS, GROUP_CHARS):
                doc, bucket, n = features(texts[a:b], wanted)
                yield record_batch(SCORED, [ids.slice(a, b - a), n, sent.value.posterior(doc, bucket, b - a).tolist()])
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, SCORED_DDL)


@dataclass
class Rates:
    """The steps of a fit: a document's rate is a function of its posterior. ``achieved`` are the shares reached.

    Residuals are the deviations times ``weights``, budget_share**2 over each domain's share of the tokens; these make
    1 the largest curvature.
    """
    budget_share: float
    step: float
    weights: list[float]
    residuals: list[list[float]]
    momenta: list[float]
    achieved: list[float]

    def _fold(self, posterior: Column, pick: str) -> Column:
        zero = F.struct(F.lit(1.0).alias("r"), F.lit(1.0).alias("y"))
        if not self.residuals:
            return zero[pick]
        steps = F.array(*[F.struct(F.array(*map(F.lit, s)).alias("s"), F.lit(m).alias("m"))
                          for s, m in zip(self.residuals, self.momenta, strict=True)])

        def one(acc, s):
            slope = F.aggregate(F.zip_with(posterior, s["s"], lambda p, x: p * x / THOUSAND), F.lit(0.0), lambda a, x: a + x)
            r = F.greatest(F.lit(0.0), acc["y"] - self.step * (slope / self.budget_share + PULL * (acc["y"] - 1)))
            return F.struct(r.alias("r"), (r + s["m"] * (r - acc["r"])).alias("y"))
        return F.aggregate(steps, zero, one, lambda acc: acc[pick])

    def rate(self, posterior: Column) -> Column:
        return self._fold(posterior, "r")


def fit_rates(scored: DataFrame, targets: list[float], budget_tokens: float | None = None) -> Rates:
    """Fit rates to rows of (n_tokens, posterior) for target shares of ``budget_tokens`` (default: the tokens there are)."""
    cells = materialize(scored.groupBy("posterior").agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0"), "cells")
    d = len(targets)
    found = cells.agg(F.sum("tokens"), *[F.sum(F.col("tokens") * F.get("posterior", F.lit(i))) for i in range(d)]).first()
    tokens = found[0]
    share = float(budget_tokens / tokens) if tokens and budget_tokens else 1.0
    fit = Rates(share, 1 / (1 + PULL), [], [], [], [])
    if not tokens:
        return fit
    own = np.array(found[1:], float) / THOUSAND / tokens
    fit.weights = np.divide(share**2, own, out=np.zeros(d), where=own > 0).tolist()
    wanted, t = np.array(targets), 1.0
    scale = np.where(wanted > 0, wanted, np.where(own > 0, own / share, 1.0))

    def totals(pick: str) -> np.ndarray:
        value = fit._fold(F.col("posterior"), pick)
        cols = [F.sum(F.col("v") * F.col("tokens") * F.get("posterior", F.lit(i))) for i in range(d)]
        return np.array(cells.withColumn("v", value).agg(*cols).first(), float) / THOUSAND / (tokens * share)

    last = None
    for _ in range(MAX_STEPS):
        at = totals("y") - wanted
        if last is not None and (np.abs(at - last) / scale).max() < TOLERANCE / 10:
            break
        last = at
        faster = (1 + math.sqrt(1 + 4 * t * t)) / 2
        fit.residuals.append((at * fit.weights).tolist())
        fit.momenta.append((t - 1) / faster)
        t = faster
    fit.achieved = totals("r").tolist()
    return fit


def uniform(*columns: Column) -> Column:
    """A number in [0, 1) that depends on the columns alone."""
    return F.pmod(F.xxhash64(*columns, F.lit("mix")), F.lit(1 << 30)) / float(1 << 30)


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], budget_tokens: float | None = None,
        labelled_rows: int = LABELLED_ROWS) -> DataFrame:
    """doc_id, n_tokens, posterior (map of domain to probability), rate, copies, achieved for every row of ``docs``.

    ``labelled`` has doc_id and domain (a doc_id labelled twice has the larger
    domain; null and unknown domains are not used). ``targets`` are the shares of
    the budget wanted of each domain. copies is the rate rounded up or down by a
    number drawn from doc_id, so that it is the rate on average. achieved maps each
    domain to the share that the rates reach, the same on all rows (0 without tokens). Null text has
    no tokens. Without labels all domains are equally likely; without tokens all
    rates are 1. Repeated rows get one rate; an empty table gives no rows.
    """
    domains = sorted(targets)
    scored = materialize(score(docs, fit(docs, labelled, domains, labelled_rows)), "scored")
    rates = fit_rates(scored, [targets[d] for d in domains], budget_tokens)
    named = F.map_from_arrays(F.array(*map(F.lit, domains)), F.transform("posterior", lambda p: p / THOUSAND))
    out = scored.withColumn("rate", rates.rate(F.col("posterior"))).withColumn("posterior", named)
    out = out.select("doc_id", "n_tokens", "posterior", "rate")
    whole = F.floor("rate")
    reached = [F.lit(x) for d, a in zip(domains, rates.achieved or [0.0] * len(domains), strict=True) for x in (d, round(a, 6))]
    return out.withColumn("copies", (whole + (uniform(F.col("doc_id")) < F.col("rate") - whole).cast("int")).cast("int")
                          ).withColumn("achieved", F.create_map(*reached))


def quality_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) from (doc_id, quality, toxic): toxic, else high or low by quality; null labels give no domain."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low")
    return labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), domain.alias("domain"))


def mixed_documents(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], **options) -> DataFrame:
    """The rows of ``docs``, each as often as its number of copies; rows of one doc_id share that number."""
    copies = mix(docs, labelled, targets, **options).groupBy(F.col("doc_id").alias("__id")).agg(F.max("copies").alias("__copies"))
    rows = docs.join(copies.where("__copies > 0"), F.col("doc_id").eqNullSafe(F.col("__id"))).drop("__id")
    return explode_copies(rows, "__copies", "__nth").drop("__nth")
