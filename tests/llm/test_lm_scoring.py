"""LM scores against a plain version of deleted interpolation, and its edge cases."""
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from ledgerlens.llm import lm_scoring as L

WORD = re.compile("[^\x20\x09-\x0d]+")


def tokens(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) + [None]


def fold(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5


class Model:
    def __init__(self, texts):
        self.one, self.two, self.three = Counter(), Counter(), Counter()
        for words in texts:
            seq = ["<", "<", *words]
            self.one.update(seq[1:])
            self.two.update(zip(seq[1:], seq[2:]))
            self.two["<", "<"] += 1
            self.three.update(zip(seq, seq[1:], seq[2:]))
        self.n = sum(c for w, c in self.one.items() if w != "<")
        self.v = len(self.one) - ("<" in self.one)

    def estimates(self, words):
        seq = ["<", "<", *words]
        for a, b, c in zip(seq, seq[1:], seq[2:]):
            uv, v = self.two[a, b], self.one[b]
            level = 3 if uv else 2 if v else 1 if self.n else 0
            bucket = int(math.log2(uv if uv else v)) if level > 1 else 0
            yield level, bucket, [self.three[a, b, c] / uv if uv else 0, self.two[b, c] / v if v else 0,
                                  self.one[c] / self.n if self.n else 0, 1 / (self.v + 1)]


def expected(rows):
    docs = [(i, tokens(t)) for i, t in rows]
    kept = Model([w for i, w in docs if fold(i) not in (1, 4)])
    final = Model([w for i, w in docs if fold(i) != 1])
    found = defaultdict(list)
    for i, w in docs:
        if fold(i) == 4:
            for level, bucket, f in kept.estimates(w):
                found[level, bucket].append(f)
    weights = {}
    for (level, bucket), f in found.items():
        if level:
            lam = np.full(level + 1, 1 / (level + 1))
            f = np.array(f)[:, 3 - level:]
            for _ in range(L.STEPS):
                share = f * lam
                share /= share.sum(axis=1, keepdims=True)
                lam = share.sum(axis=0) + 1 / (level + 1)
                lam /= lam.sum()
            weights[level, bucket] = [0.0] * (3 - level) + lam.tolist()
    table = L.weight_table(weights)
    out = {}
    for i, w in docs:
        base = sum(math.log10((final.one[x] + 0.5) / (final.n + 0.5 * (final.v + 1))) for x in w)
        score = sum(math.log10(np.dot(table[level, bucket], f)) for level, bucket, f in final.estimates(w))
        out.setdefault((i, len(w), sum(final.one[x] > 0 for x in w)), []).append((fold(i) == 1, final.n, base, score))
    return out


def check(got, rows, tolerance=2e-3):
    want = expected(rows)
    assert len(got) == len(rows)
    for r in got:
        options = want[r.doc_id, r.n_tokens, r.n_known]
        assert any(r.held_out == h and r.train_tokens == n and math.isclose(r.base_score, b, rel_tol=1e-9, abs_tol=1e-9)
                   and math.isclose(r.score, s, rel_tol=tolerance, abs_tol=1e-6) for h, n, b, s in options), (r, options)


def prose(n, seed=3):
    rng = np.random.default_rng(seed)
    words = ["the", "The", "cat", "sat", "on", "mat", "漢字", "a,", "b."]
    return [(i, " ".join(rng.choice(words, rng.integers(0, 30), p=[.3, .1, .2, .1, .1, .1, .05, .03, .02]))) for i in range(n)]


@pytest.mark.parametrize("block,shard", [(1_000_000, 2_000_000), (50, 100)])
def test_small_table(docs_of, block, shard):
    rows = prose(150) + [(200, None), (201, ""), (202, " \t\n"), (7, "again again"), (7, "again again"), (None, "no id"),
                         (203, "new words only here"), (204, "the " * 5000), (205, "x" * 3000)]
    check(L.score_documents(docs_of(rows), block, shard).collect(), rows)


def test_long_text_without_line_end(docs_of):
    rows = [(i, "the cat sat") for i in range(10)] + [(11, "the cat " * 60_000)]
    check(L.score_documents(docs_of(rows)).collect(), rows)


def test_one_estimate_only_where_nothing_is_trained(docs_of):
    ids = [i for i in range(60) if fold(i) == 1][:4]
    got = L.score_documents(docs_of([(i, "a b") for i in ids])).collect()
    assert {(r.held_out, r.n_known, r.train_tokens, r.base_score, r.score) for r in got} == {(True, 0, 0, 0.0, 0.0)}


def test_empty_table(docs_of):
    assert L.score_documents(docs_of([])).collect() == []


def test_probabilities_of_a_context_add_up_to_one():
    rows = prose(100)
    model = Model([tokens(t) for _, t in rows])
    table = L.weight_table({(3, 2): [.4, .3, .2, .1], (2, 1): [0, .5, .3, .2]})
    words = [w for w in model.one if w != "<"] + ["never seen"]
    for context in (["the", "cat"], ["new", "the"], ["new", "new"], ["<", "the"]):
        total = 0
        for w in words:
            level, bucket, f = list(model.estimates([*context, w]))[-1]
            total += np.dot(table[level, bucket], f)
        assert math.isclose(total, 1)


def test_solved_weights_are_most_likely():
    rng = np.random.default_rng(1)
    f, n = rng.random((200, 3)), rng.integers(1, 50, 200)
    best = L.solve(n, f)
    ours = (n * np.log(f @ best)).sum()
    for _ in range(300):
        other = rng.dirichlet([1, 1, 1])
        assert (n * np.log(f @ other)).sum() <= ours + 0.05


@given(st.lists(st.integers(0, (1 << 64) - 1), min_size=1, unique=True))
def test_packed_keys(keys):
    keys = np.sort(np.array(keys, np.uint64))
    assert L.unpacked(*L.packed(keys)).tolist() == keys.tolist()


def test_whole_table_beats_the_base_on_held_out_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = L.score_documents(docs).collect()
    check(got, [(r.doc_id, r.text) for r in docs.collect()])
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
