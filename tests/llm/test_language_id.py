import zlib

import numpy as np

from ledgerlens.llm import language_id as L


def test_trigrams_of_a_text_do_not_depend_on_its_neighbours():
    texts = ["", "ab cd. ef", "1 2", "  x", "É è", "漢字 かな", "y  ", "a" * 5000, "\n\n"]
    buckets, ends = L.trigrams(texts)
    begin = 0
    for t, end in zip(texts, ends):
        assert (L.trigrams([t])[0] == buckets[begin:end]).all()
        begin = end
    assert begin == len(buckets)


def test_mixture_reaches_the_best_proportions():
    rng = np.random.default_rng(1)
    p = rng.dirichlet(np.full(200, 0.3), 3).T + 1e-6
    n = rng.multinomial(6000, p[:, [0, 2]] @ [0.7, 0.3] / (p[:, [0, 2]] @ [0.7, 0.3]).sum()).astype(float)
    some = n > 0
    chosen, share = L.choose(p[some], n[some])
    assert chosen.tolist() == [0, 2] and abs(share[0] - 0.7) < 0.05
    grid = np.linspace(0.001, 0.999, 999)
    best = max(grid, key=lambda g: n[some] @ np.log(p[some][:, [0, 2]] @ [g, 1 - g]))
    assert abs(share[0] - best) < 0.01


def test_held_out_accuracy_and_rule(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = {r.doc_id: r for r in L.identify(docs).collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert rows.keys() == truth.keys()
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1
    held = [i for i, r in rows.items() if r.held_out and truth[i] is not None]
    assert len(held) > 200 and np.mean([rows[i].lang_pred == truth[i] for i in held]) >= 0.98


def test_mixed_text_gets_both_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = L.train(docs)
    by = {r.lang: r.text for r in docs.where("length(text) between 1500 and 3000").collect()}
    mixed = spark.createDataFrame([(1, by["de"] + " " + by["fr"])], "doc_id bigint, text string")
    got = L.predict(spark, mixed, model).first()
    assert set(got.langs) == {"de", "fr"} and abs(sum(got.shares) - 1) < 1e-6 and min(got.shares) > 0.3


def test_edge_rows(spark, docs_of):
    rows = [(1, None), (2, ""), (3, "123 !"), (4, "a"), (4, "a"), (None, "the end"), (5, "wor " * 100_000)]
    got = L.identify(docs_of(rows)).collect()
    assert len(got) == len(rows) and all(r.lang_pred == "und" and r.score == 0 for r in got)
    labelled = docs_of(rows).unionByName(spark.createDataFrame(
        [(i, t, lang, "s", 1, "x", 1, 2, "y") for i, (t, lang) in enumerate([("the end of it", "en"), ("le fin du", "fr")] * 9, 100)],
        docs_of([]).schema))
    got = {r.doc_id: r for r in L.identify(labelled).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and got[None].lang_pred == "en" and got[4].lang_pred != "und"
    assert L.identify(docs_of([])).collect() == []
