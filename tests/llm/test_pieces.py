import hashlib
import heapq
import tracemalloc
import zlib
from itertools import islice

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import pieces as S

PATH = public_tokenizers.path("piece_bpe_32k.model")
LEX = S.lexicon(PATH)
HARD = ["", " ", "  ", "a", " a", "a ", "a  b", "hello world", "  two  blanks   three ", "é ü ß ñ", "漢字 と かな", "▁ own symbol ▁x",
        "line\nbreak\n\n end\n", "emoji 🙂🙂", "x" * 300, "1234567890", "a\x00b", "the the the the", " \n ", "\t tab"]


def all_paths(text):
    """Every segmentation as (score, piece lengths)."""
    if not text:
        return [(0.0, ())]
    out = []
    for size in range(1, min(len(text), LEX.longest) + 1):
        found = LEX.pieces.get(text[:size])
        if found or size == 1:
            s = found[1] if found else LEX.unknown
            out += [(s + rest, (size, *lengths)) for rest, lengths in all_paths(text[size:])]
    return out


def brute_scores(text, n):
    return sorted((s for s, _ in all_paths(" " + text if text else "")), reverse=True)[:n]


@pytest.mark.parametrize("text", [t for t in HARD if len(t) < 14])
def test_n_best_against_all_segmentations(text):
    (ids, scores, changes), = S.Segmenter(PATH).encode([text], 5)
    assert scores == brute_scores(text, 5) and changes[0] == "" and len(set(changes)) == len(changes)
    assert S.decode(LEX, ids).decode() == text


@settings(max_examples=60, deadline=None)
@given(st.text("the inasé \n", max_size=11), st.integers(1, 6))
def test_any_text(text, n):
    (ids, scores, _), = S.Segmenter(PATH).encode([text], n)
    assert scores == brute_scores(text, n) and S.decode(LEX, ids).decode() == text


def test_units_together_equal_units_alone(monkeypatch):
    units = [" the", " there", " international", "ing", " é\nx", "  ", " 漢", " aaaaaaaaaaaaaaaaaaaa"]
    together = S.segment_units(LEX, units)
    monkeypatch.setattr(S, "LONG_UNIT", 0)
    alone = S.segment_units(LEX, units)
    assert together == alone
    for u, (_, score, loss) in zip(units, together):
        both = S.n_best(LEX.edges(u), 2)
        assert both[0][0] == score and (len(both) < 2 or both[0][0] - both[1][0] == loss)


def n_best_by_tuples(edges, n):
    best, end = S.forward(edges), len(edges) - 1
    agenda, found = [(-best[end], (), end, 0.0)], []
    while agenda and len(found) < n:
        cost, path, at, score = heapq.heappop(agenda)
        if not at:
            found.append((-cost, tuple(-x for x in reversed(path))))
            continue
        for i, s in edges[at]:
            heapq.heappush(agenda, (-(score + s + best[i]), (*path, i - at), i, score + s))
    return found


@pytest.mark.parametrize("unit", [" " + "x" * 60, " international" + "ly" * 30, "漢字" * 30, "ab\ncd\t" * 12])
def test_back_pointers_order_paths_as_tuples(unit):
    assert S.n_best(LEX.edges(unit), 20) == n_best_by_tuples(LEX.edges(unit), 20)
    assert S._segment_long(LEX, unit) == S._segment_equal(LEX, [unit], len(unit))[0]


@pytest.mark.parametrize("text", ["line\nof\nwords\n" * 5000, "aGVsbG8gd29ybGQ" * 13_400])
def test_long_text_without_blanks(text):
    for part in (text[:30_000], text):
        if traced := len(part) < len(text):
            tracemalloc.start()
        (ids, scores, changes), = S.Segmenter(PATH).encode([part])
        if traced:
            assert tracemalloc.get_traced_memory()[1] < 200 << 20
            tracemalloc.stop()
        assert S.decode(LEX, ids).decode() == part and len(scores) == len(set(changes)) and scores == sorted(scores, reverse=True)


def test_agrees_with_the_library_on_the_same_scores(tmp_path):
    pb2 = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    proto = pb2.ModelProto()
    with open(PATH, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    own = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    texts = ["the international house", "ouen thth erentatsh of", "déjà vu über", "thonanion stionedreha"]
    for text, (ids, scores, _) in zip(texts, S.Segmenter(PATH).encode(texts, 3)):
        assert own.decode(ids.tolist()) == text
        assert sorted((sum(own.get_score(i) for i in x) for x in own.nbest_encode_as_ids(text, 3)), reverse=True) == scores


def test_tables(spark, docs_of):
    rows = [*enumerate(HARD), (50, None), (None, "null id"), (3, "again"), (3, "again"), (60, "word " * 40_000)]
    docs = docs_of(rows)
    got = S.round_trip(docs, PATH).collect()
    key = lambda r: (str(r[0]), r[1])
    assert sorted(((r.doc_id, r.text_sha256) for r in got), key=key) == sorted(
        ((i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows), key=key)
    encoded = S.encode_documents(docs, PATH)
    assert sorted((zlib.crc32(np.array(r.ids, "<u4").tobytes()), len(r.ids), r.nbest_scores) for r in encoded.collect()) == sorted(
        (r.ids_crc32, r.n_pieces, r.nbest_scores) for r in got)
    assert sorted(map(key, ((r.doc_id, r.text) for r in S.decode_documents(encoded, PATH).collect()))) == sorted(
        map(key, ((i, t or "") for i, t in rows)))
    assert S.round_trip(docs_of([]), PATH).collect() == []


def test_every_document_comes_back(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r for r in S.round_trip(docs, PATH).collect()}
    rows = list(islice(docs.collect(), 10_000))
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.doc_id].text_sha256 == hashlib.sha256(r.text.encode()).hexdigest() and got[r.doc_id].n_chars == len(r.text)
        assert got[r.doc_id].nbest_scores == sorted(got[r.doc_id].nbest_scores, reverse=True)
