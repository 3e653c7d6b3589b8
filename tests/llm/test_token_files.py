import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerlens.llm import token_files as T

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", " ", "  ", "a", " a", "a ", "a  b", "a   b", "a \n b", "a\n b", "a\n\n  b \n", "it's they'll  've 's", "é 漢字  x\t y",
         "   b 　c", "x" * 3000, " lead", "tail  ", "1 22  333", "<|endoftext|> a <|endoftext|>", "!? ... --", "\x1c a \x1cb"]


def test_pieces_encode_like_whole_texts():
    whole = Tokenizer.from_file(PATH)
    texts = TEXTS + [a + b for a in TEXTS for b in TEXTS]
    want = [np.array(whole.encode(t, add_special_tokens=False).ids, np.uint16).tobytes() for t in texts]
    assert T.Encoder(PATH).encode(texts) == want


def expected(rows):
    whole, at, out = Tokenizer.from_file(PATH), 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] is not None, r[1] or ""))):
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 0]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("seq_len,batch", [(2048, 64), (7, 3)])
def test_files_give_back_every_document(docs_of, seq_len, batch):
    rows = [(i * 7 % 23, t) for i, t in enumerate(TEXTS)] + [(50, None), (None, "null id"), (3, "again"), (3, "again")]
    got = T.token_files(docs_of(rows), PATH, seq_len=seq_len, batch_sequences=batch).collect()
    assert sorted((tuple(r)[:4] for r in got), key=lambda x: x[1]) == expected(rows)


def test_random_access_and_mask(docs_of):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    got = T.token_files(docs_of(rows).coalesce(1), PATH, seq_len=16, batch_sequences=2).collect()
    folder, total = got[0].folder, 0
    for number in sorted({r.shard for r in got}):
        shard = T.Shard(folder, number)
        ids, n = [], sum(r.n_tokens for r in got if r.shard == number)
        for row in range(-(-n // 16)):
            seq, mask = shard.sequence(row)
            assert len(seq) == len(mask) == 16 and seq.base is not None
            ids += [x for x, m in zip(seq.tolist(), mask.to_pylist()) if m]
        assert len(ids) == n
        total += n
    assert total == sum(r.n_tokens for r in got)


def test_empty_table(docs_of):
    assert T.token_files(docs_of([]), PATH).collect() == []


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = [tuple(r)[:4] for r in T.token_files(docs, PATH).orderBy("start").collect()]
    assert got == expected([(r.doc_id, r.text) for r in docs.collect()])
