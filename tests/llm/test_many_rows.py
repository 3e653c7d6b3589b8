"""Operators that take a batch in slices, on batches of several slices."""
import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from ledgerlens.llm import exact_dedup, html_extract, jaccard_join, language_id, mixing, pieces, substring_dedup
from ledgerlens.llm.common import parts
from ledgerlens.llm.wordhash import GROUP_ROWS, text_groups
from tests.llm.test_exact_dedup import brute as brute_equal

N = 3 * GROUP_ROWS + 7
TEXTS = [None if i % 97 == 5 else f"Text \u00c9 number {i % (N - 50)} of the \u00fcber many, word{i} {'x' * (i % 13)}" for i in range(N)]


@pytest.fixture(scope="module")
def many(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string").coalesce(1)


def test_slices_hold_every_row_as_it_is():
    batch = pa.RecordBatch.from_arrays([pa.array(range(N)), pa.array(TEXTS)], names=["doc_id", "text"])
    assert [x for p in parts([batch]) for x in p.column(1).to_pylist()] == TEXTS
    assert [t for p in parts([batch]) for t in exact_dedup.normalised(p.column(1))] == [
        "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").encode() for t in TEXTS]
    seen = [(a + k, t) for a, texts in text_groups(batch.column(1)) for k, t in enumerate(texts)]
    assert seen == [(i, (t or "").encode()) for i, t in enumerate(TEXTS)]


def test_exact_dedup(many):
    rows = [(i, f"same {i % 1500}") for i in range(N)]
    table = many.sparkSession.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    assert sorted(map(tuple, exact_dedup.exact_duplicates(table).collect()), key=str) == brute_equal(rows)
    assert exact_dedup.drop_exact_duplicates(table).count() == 1500


def test_jaccard_join(many):
    got = {r.doc_id: r for r in jaccard_join.near_duplicates(many).collect()}
    assert len(got) == N and all(got[i].n_shingles == (0 if t is None else len(jaccard_join.shingle_sets([t.encode()], 5)[0]))
                                 for i, t in enumerate(TEXTS))


def test_substring_dedup(many):
    got = {r.doc_id: r for r in substring_dedup.remove_repeats(many).collect()}
    for i, t in enumerate(TEXTS):
        words = (t or "").encode().split()
        assert (got[i].n_words, got[i].n_removed) == (len(words), 0)
        assert got[i].kept_sha256 == hashlib.sha256(b" ".join(words)).hexdigest()


def test_pieces(many):
    got = {r.doc_id: r.text_sha256 for r in pieces.round_trip(many, public_tokenizers.path("piece_bpe_32k.model")).collect()}
    assert got == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in enumerate(TEXTS)}


def test_language_id_and_mixing(many):
    model = (["a", "b"], np.random.default_rng(0).dirichlet(np.ones(language_id.BUCKETS), 2))
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(many.sparkSession, many, model).collect()}
    assert got == {i: language_id.predict_texts([t or ""], model)[0][:2] for i, t in enumerate(TEXTS)}
    plain = mixing.Classifier(["a", "b"], np.zeros(2), np.zeros(0, int), np.zeros((0, 2)))
    assert {r.doc_id: r.n_tokens for r in mixing.score(many, plain).collect()} == {i: len((t or "").split()) for i, t in enumerate(TEXTS)}


def test_html(many):
    pages = many.selectExpr("doc_id AS page_id", "concat('http://h', doc_id % 40, '.example/') AS url", "concat('<article>', text, '</article>') AS html")
    got = {r.page_id: r.text for r in html_extract.extract_text(pages).collect()}
    assert got == {i: " ".join((t or "").split()) for i, t in enumerate(TEXTS)}
