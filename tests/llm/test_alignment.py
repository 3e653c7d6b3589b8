"""Alignment against a byte-by-byte version, and its edge cases."""
import hashlib
from collections import Counter
from functools import cache

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlens.llm import alignment as A

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [None, "", " ", "a", "antidisestablishmentarianism", "x" * 3000, "naïve café 漢字 😀", "a  b   c \n\n d", "▁under▁", "\u0000 nul",
         "<|endoftext|> <s> </s> <unk> <0x41>", "the cat sat on the mat", "the cat sat on the mat", "tab\there\r\nline", "12345 67.89",
         "a\u00a0b\u3000c", "ﬁ ligature", "e\u0301"]


@cache
def tokenizers():
    bpe = Tokenizer.from_file(BPE)
    bpe.encode_special_tokens = True
    return bpe, sentencepiece.SentencePieceProcessor(model_file=PIECES)


def tokens(text):
    """(id, bytes) of both sides, or nothing."""
    if not text:
        return [], []
    bpe, sp = tokenizers()
    alphabet = A.byte_alphabet()
    a = [(i, bytes(alphabet[c] for c in bpe.id_to_token(i))) for i in bpe.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("\u2581", " ").encode())
         for i in sp.encode(text)]
    whole = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])


def groups(a, b):
    out, i, j, at_a, at_b = [], 0, 0, 0, 0
    one, two = [], []
    while i < len(a) or j < len(b):
        if at_a <= at_b:
            one.append(a[i][0])
            at_a += len(a[i][1])
            i += 1
        else:
            two.append(b[j][0])
            at_b += len(b[j][1])
            j += 1
        if at_a == at_b:
            out.append((one, two))
            one, two = [], []
    return out


def expected(rows):
    found = [groups(*tokens(t)) for _, t in rows]
    links = [Counter((x, y) for one, two in g for x in one for y in two) for g in found]
    counts = Counter(p for doc in links for p in doc)
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for (i, _), g, doc in zip(rows, found, links, strict=True):
        text = ";".join(",".join(map(str, one)) + "|" + ",".join(map(str, two)) for one, two in g)
        out.append((i, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(doc.values()),
                    sum(n for p, n in doc.items() if counts[p] == best[p[0]]), sum(n * counts[p] for p, n in doc.items()),
                    hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return out


def key(row):
    return row[0] is not None, row[0] or 0, row[1:]


def test_terminals_of_chains():
    a, b = np.array([2, 4, 6, 9, 10]), np.array([1, 3, 5, 6, 10])
    assert [x.tolist() for x in A.terminals(a, b)] == [[2, 2, 2, 4, 4], [2, 2, 2, 2, 4]]
    one, two = A.terminals(np.arange(2, 20002, 2), np.append(np.arange(1, 20001, 2), 20000))
    assert set(one) == set(two) == {9999}  # one chain of 20,000 tokens


@pytest.mark.parametrize("block_tokens", [1_000_000, 5])
def test_documents_with_every_kind_of_text(docs_of, block_tokens):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "a"), (3, "the cat"), (None, "the mat")]
    got = A.align_documents(docs_of(rows), BPE, PIECES, block_tokens)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(expected(rows), key=key)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from(" ab\ncdetAé漢😀\u2581.'1"), max_size=40), min_size=1, max_size=6))
def test_random_texts(texts):
    first, second = A.side(A.ByteLevel, BPE), A.side(A.Pieces, PIECES)
    got = A.align(texts, first, second, A.Spelled(60_000, ",|;"))
    want = expected([(i, t) for i, t in enumerate(texts)])
    assert [(a, b, g, n, s) for a, b, g, n, s in zip(got.n_a, got.n_b, got.n_groups, got.n_links, got.sha256, strict=True)] == [
        (w[1], w[2], w[3], w[4], w[7]) for w in want]


def test_words_that_were_forgotten_are_encoded_again(monkeypatch):
    monkeypatch.setattr(A, "CACHED_WORDS", 3)
    test_random_texts()


def test_group_of_very_many_pairs_is_counted_by_different_ids(monkeypatch):
    monkeypatch.setattr(A, "MOST_PAIRS", 1)
    test_random_texts()


def test_very_long_text_without_blanks(docs_of):
    rows = [(1, "ab\n" * 70_000), (2, "x" * 200_000)]
    assert sorted(map(tuple, A.align_documents(docs_of(rows), BPE, PIECES).collect())) == sorted(expected(rows))


def test_empty_table(docs_of):
    assert A.align_documents(docs_of([]), BPE, PIECES).collect() == []


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, A.align_documents(docs, BPE, PIECES).collect())) == sorted(expected(rows))
