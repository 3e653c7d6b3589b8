"""The corpus pipeline against plain Python versions of its filtering stages."""
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline as C
from ledgerlens.llm import language_id as L
from ledgerlens.llm import pieces as S
from tests.llm.test_exact_dedup import brute as brute_equal
from tests.llm.test_jaccard_join import brute as brute_similar

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs)
    for name, stage in C.STAGES:
        docs = C.materialize(stage(spark, docs, SF), "test")
        out.append(docs)
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_call_the_dealt_operators_in_order():
    assert [name for name, _ in C.STAGES] == ["language ID", "exact dedup", "n-gram Jaccard join", "mixing to target weights",
                                              "SentencePiece encoding"]


def test_all_but_the_last_keep_the_columns(stages):
    for df in stages[:-1]:
        assert df.dtypes == stages[0].dtypes


def test_language_stage_drops_what_has_no_letter(stages):
    before, after = rows(stages[0]), rows(stages[1])
    assert sorted(after) == sorted(r for r in before if any(c.isalpha() for c in r[1] or ""))


def test_exact_stage(stages):
    before, after = rows(stages[1]), rows(stages[2])
    assert sorted(i for i, _ in after) == sorted(r[0] for r in brute_equal(before) if r[3])


def test_near_stage(stages):
    before, after = rows(stages[2]), rows(stages[3])
    assert sorted(i for i, _ in after) == sorted({r[2] if r[1] else r[0] for r in brute_similar(before)})


def test_mixing_stage_keeps_clean_documents(spark, stages):
    before, after = rows(stages[3]), Counter(i for i, _ in rows(stages[4]))
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert set(after) <= {i for i, _ in before}
    clean = [i for i, _ in before if i in labels and labels[i].quality == 1 and not labels[i].toxic]
    assert np.mean([after[i] > 0 for i in clean]) > 0.97


def test_encoding_stage(stages):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    before = Counter(rows(stages[4]))
    got = stages[5].collect()
    lex = S.lexicon(public_tokenizers.path("piece_bpe_32k.model"))
    assert Counter((r.doc_id, S.decode(lex, np.array(r.ids, np.int32)).decode()) for r in got) == before
    assert all(model.decode(r.ids) == t for r, t in ((r, dict(before.keys())[r.doc_id]) for r in got[:50]))


def test_run_gives_the_last_stage(spark, stages):
    key = lambda df: sorted((r.doc_id, zlib.crc32(np.array(r.ids, "<u4").tobytes()), r.nbest_scores) for r in df.collect())
    assert key(C.run(spark, SF)) == key(stages[5])


def test_odd_rows_pass(spark, tmp_path):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    for name in ("root", "class", "bucket"):
        schema = schema.add(name, "integer")
    schema = schema.add("name", "string")
    odd = [(1, None), (2, ""), (3, "12 34"), (4, "Same text here"), (5, "same text here"), (None, "no id at all"), (6, "again"), (6, "again"),
           (6, "other words"), (7, "w " * 30_000), (8, "near one two three four five six seven eight nine ten eleven twelve"),
           (9, "near one two three four five six seven eight nine ten eleven twelve")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, 1, 2, 3, "n") for i, t in odd], schema)
    after = C.languages(spark, docs, SF)
    assert after.count() == 9
    after = C.exact_duplicates(spark, after, SF)
    assert sorted((str(r.doc_id), r.text[:5]) for r in after.collect()) == sorted(
        [("5", "same "), ("None", "no id"), ("6", "again"), ("6", "other"), ("7", "w w w"), ("9", "near ")])
    after = C.near_duplicates(spark, after, SF)
    assert after.count() == 6 and after.columns == docs.columns
    after = C.mixture(spark, after, SF)
    assert after.columns == docs.columns
    assert C.encoding(spark, after, SF).count() == after.count()
    for _, stage in C.STAGES:
        assert stage(spark, docs.limit(0), SF).collect() == []


def test_keep_identified_is_the_prediction(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id for r in L.keep_identified(docs).collect()}
    assert kept == {r.doc_id for r in L.identify(docs).where("lang_pred <> 'und'").collect()}
    assert re.fullmatch("[a-z]{2,3}", L.UNDETERMINED)
