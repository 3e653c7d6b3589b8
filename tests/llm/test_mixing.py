import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import mixing as M


def plain(n, p, targets, share=1.0, steps=20_000):
    """Projected gradient over single documents, not accelerated, to convergence."""
    p, m, t = p / M.THOUSAND, n / n.sum(), np.array(targets)
    r, step = np.ones(len(n)), 1 / (1 / share**2 + M.PULL)
    for _ in range(steps):
        r = np.maximum(0, r - step * (p @ ((m * r) @ p / share - t) / share + M.PULL * (r - 1)))
    return r


def scored(spark, n, p):
    return spark.createDataFrame([(i, int(a), [int(x) for x in b]) for i, (a, b) in enumerate(zip(n, p))], M.SCORED_DDL)


def random_documents(rng, size=300):
    n = rng.integers(1, 2000, size).astype(float)
    p = rng.dirichlet([0.3, 0.2, 0.1], size)
    p = np.round(p * 1000).astype(int)
    p[:, 0] += 1000 - p.sum(axis=1)
    return n, p


@pytest.mark.parametrize("targets,budget", [([0.5, 0.3, 0.2], None), ([0.9, 0.1, 0.0], None), ([0.2, 0.2, 0.6], 50_000)])
def test_rates_match_plain_projected_gradient(spark, targets, budget):
    n, p = random_documents(np.random.default_rng(4))
    table = scored(spark, n, p)
    fit = M.fit_rates(table, targets, budget)
    got = {r.doc_id: r.rate for r in table.select("doc_id", fit.rate(F.col("posterior")).alias("rate")).collect()}
    share = budget / n.sum() if budget else 1.0
    want = plain(n, p, targets, share)
    rates = np.array([got[i] for i in range(len(n))])
    reached, best = ((n * r) @ p / 1000 / (n.sum() * share) for r in (rates, want))
    assert (rates >= 0).all() and np.abs(reached - best).max() < 5e-3 and np.allclose(reached, fit.achieved)


def test_reachable_targets_are_reached(spark):
    n = np.array([100.0, 100, 100, 100])
    p = np.array([[1000, 0], [1000, 0], [0, 1000], [500, 500]])
    fit = M.fit_rates(scored(spark, n, p), [0.25, 0.75])
    assert np.allclose(fit.achieved, [0.25, 0.75], atol=2e-3)


@pytest.mark.parametrize("rare", [1000, 100, 10])
def test_rare_domain_meets_its_target(spark, rare):
    n = np.array([900_000.0 - rare, 100_000, rare])
    p = np.array([[1000, 0, 0], [0, 1000, 0], [0, 0, 1000]])
    table = scored(spark, n, p)
    for target in (0.0, 0.0002):
        fit = M.fit_rates(table, [0.95 - target, 0.05, target])
        rates = {r.doc_id: r.rate for r in table.select("doc_id", fit.rate(F.col("posterior")).alias("rate")).collect()}
        assert abs(rates[2] - target * 1e6 / rare) < 1e-3 * max(1, target * 1e6 / rare)
        assert np.allclose(fit.achieved, [0.95 - target, 0.05, target], rtol=1e-3, atol=2e-3 * rare / 1e6)


def test_achieved_shares_are_given(spark, docs_of):
    docs = docs_of([(1, "some words"), (2, "other words here")])
    got = M.mix(docs, spark.createDataFrame([], "doc_id bigint, domain string"), {"a": 0.5, "b": 0.5}).collect()
    assert all(r.achieved == {"a": 0.5, "b": 0.5} for r in got) and len(got) == 2


def test_classifier_on_labels_not_learned_from(spark):
    from ledgerlens.llm.queries import read
    docs = read(spark, "/root/testdata/sf0.1", "documents").where("length(text) > 200")
    labels = M.quality_domains(read(spark, "/root/testdata/sf0.1", "labels"))
    rest = labels.where("doc_id % 4 = 0")
    model = M.fit(docs, labels.where("doc_id % 4 <> 0"), ["high", "low", "toxic"])
    got = M.score(docs, model).join(rest, "doc_id").select("posterior", "domain").collect()
    by = {d: np.array([r.posterior for r in got if r.domain == d]) for d in ("high", "low", "toxic")}
    assert (by["high"][:, 2] < 500).mean() > 0.99 and (by["low"][:, 0] < 500).mean() > 0.6 and (by["toxic"][:, 2] > 500).mean() > 0.7
    assert all((x.sum(axis=1) == M.THOUSAND).all() for x in by.values())


@pytest.mark.parametrize("domains", [["a", "b"], ["a", "b", "c"]])
def test_equally_frequent_domains_have_features(spark, docs_of, domains):
    rows = [(i, f"word{i % 7} same {'xyz'[i % len(domains)]}sign other{i % 5}") for i in range(60 * len(domains))]
    labels = spark.createDataFrame([(i, domains[i % len(domains)]) for i, _ in rows if i % 4], "doc_id bigint, domain string")
    got = M.score(docs_of(rows), M.fit(docs_of(rows), labels, domains)).where("doc_id % 4 = 0").collect()
    assert got and all(r.posterior[r.doc_id % len(domains)] > 900 for r in got)


def test_features_do_not_depend_on_other_texts():
    texts = ["", "a B c.", "  x  y ", "É É É", None or "", "UPPER!! CASE!!", "a\x0bb\n"]
    doc, bucket, n = M.features(texts)
    assert n.tolist() == [0, 3, 2, 3, 0, 2, 2]
    for k, t in enumerate(texts):
        assert bucket[doc == k].tolist() == M.features([t])[1].tolist()


def test_edge_rows(spark, docs_of):
    rows = [(1, None), (2, ""), (3, "good words here"), (3, "good words here"), (None, "no id"), (4, "bad bad"), (5, "w " * 100_000)]
    docs = docs_of(rows)
    labels = spark.createDataFrame([(3, "a"), (4, "b"), (4, "a"), (9, "b"), (None, "a"), (1, None), (2, "unknown")], "doc_id bigint, domain string")
    got = M.mix(docs, labels, {"a": 0.5, "b": 0.5}).collect()
    assert len(got) == len(rows) and all(r.rate >= 0 and r.copies in (int(r.rate), int(r.rate) + 1) for r in got)
    assert {r.doc_id: r.n_tokens for r in got} == {1: 0, 2: 0, 3: 3, None: 2, 4: 2, 5: 100_000}
    none = M.mix(docs, labels.limit(0), {"a": 0.5, "b": 0.5}).collect()
    assert all(r.posterior == {"a": 0.5, "b": 0.5} and abs(r.rate - 1) < 1e-3 for r in none)
    assert M.mix(docs_of([]), labels, {"a": 1.0}).collect() == []
    mixed = M.mixed_documents(docs, labels, {"a": 0.5, "b": 0.5})
    assert mixed.columns == docs.columns
    copies = {r.doc_id: r.copies for r in got}
    for i, t in set(rows):
        assert mixed.where(F.col("doc_id").eqNullSafe(F.lit(i))).count() == copies[i] * rows.count((i, t))
