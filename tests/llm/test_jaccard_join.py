import random
import re
from fractions import Fraction

import numpy as np
import pytest

from ledgerlens.llm import jaccard_join as J
from ledgerlens.llm.components import components
from ledgerlens.llm.wordhash import groups, run_hashes, word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
AZ = {c: c + 32 for c in range(65, 91)}


def brute_set(text, k=5):
    w = WORD.findall((text or "").translate(AZ))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k=5, threshold=Fraction(4, 5)):
    sets = [brute_set(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) >= threshold * len(a | sets[j]):
                root[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(d)
    least = {r: min((d for d in x if d is not None), default=None) for r, x in ids.items()}
    return sorted(((d, len(s), least[find(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def run(df, **kw):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.near_duplicates(df, **kw).collect()), key=str)


def family(rng, size, words, edits, vocabulary):
    base = [rng.choice(vocabulary) for _ in range(words)]
    out = []
    for _ in range(size):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        out.append(" ".join(copy[:len(copy) - rng.randint(0, 3)]))
    return out


@pytest.mark.parametrize("seed,tile,least", [(1, 1024, 64), (2, 4, 64), (3, 7, 5)])
def test_against_brute_force(docs_of, monkeypatch, seed, tile, least):
    monkeypatch.setattr(J, "FREQUENT_LEAST", least)  # 5: nearly all shared shingles count as frequent
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(12):
        texts += family(rng, rng.randint(1, 8), rng.randint(6, 120), 4, vocabulary)
    texts += family(rng, 60, 90, 3, vocabulary)  # a large group of near copies
    passage = " ".join(rng.choice(vocabulary) for _ in range(40))
    texts += [passage + " " + " ".join(rng.choice(vocabulary) for _ in range(rng.randint(5, 60))) for _ in range(30)]
    texts += ["", "one", "ONE", "a b c d", "A b C d", "a b c d e", "a b c d e f"]
    texts += [texts[3]] * 20 + [texts[5].upper()]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    assert run(docs_of(rows).repartition(3), tile=tile) == brute(rows)


def test_edge_rows(docs_of):
    long = " ".join(f"x{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "É é"), (5, "é É"), (6, "é É"), (7, "a\x0bb\x0cc\rd"), (8, "a b c d"), (9, "a\xa0b"),
            (10, "same row"), (10, "same row"), (None, "same row"), (None, "alone without id"), (11, long), (12, long + " more"), (11, "other text")]
    assert run(docs_of(rows)) == brute(rows)
    assert run(docs_of([])) == []


def test_other_rules(docs_of):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(40)]
    rows = list(enumerate(t for _ in range(10) for t in family(rng, 5, rng.randint(3, 30), 5, vocabulary)))
    for words, threshold in ((2, Fraction(1, 2)), (3, Fraction(9, 10)), (1, Fraction(1))):
        assert run(docs_of(rows), rule=J.Rule(words, threshold)) == brute(rows, words, threshold)


def test_bitmaps_bound_the_overlap_from_above():
    rng = np.random.default_rng(0)
    pa = pytest.importorskip("pyarrow")
    for _ in range(50):
        a = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 400), dtype=np.uint64))
        b = np.unique(np.concatenate([rng.choice(a, len(a) // 2 + 1, replace=False), rng.integers(0, 1 << 63, rng.integers(1, 2000), dtype=np.uint64)]))
        s = J.Signatures(pa.array([J.bitmap(a), J.bitmap(b)], pa.binary()))
        lacks, lacked = s.lacking(np.array([0]), np.array([1]))
        common = len(np.intersect1d(a, b))
        assert common <= len(a) - lacks[0] and common <= len(b) - lacked[0]


def test_linked_sizes_are_in_one_band_or_adjacent():
    rule = J.Rule()
    n = np.arange(1, 5000)
    for k in n.tolist():
        most = k * 5 // 4
        assert int(rule.band(np.array([most]))[0]) - int(rule.band(np.array([k]))[0]) <= 1


def test_word_hashes_do_not_depend_on_other_texts():
    texts = [b"", b"a bb  ccc", b" lead", b"tail \n", b"\t\x0b\x0c\r", b"x" * 5000, "é ü".encode()]
    h, starts, bounds = word_hashes(texts)
    assert len(starts) == len(h) == bounds[-1]
    for k, t in enumerate(texts):
        own = word_hashes([t])[0]
        assert (h[bounds[k]:bounds[k + 1]] == own).all() and len(own) == len(t.split())
    assert len(run_hashes(h, 3)) == len(h) - 2 and [b - a for a, b in groups(texts)] == [len(texts)]


@pytest.mark.parametrize("at_once", [200_000, 7, 1])
def test_components_of_long_chains_and_hubs(spark, at_once):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(200, 200), (300, 301), (301, 300), (302, 301)]
    table = spark.createDataFrame(edges, "a bigint, b bigint").repartition(16)
    got = components(table, at_once).collect()
    assert len(got) == len({r.node for r in got})
    assert {r.node: r.root for r in got} == {
        **{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}, **{i: 300 for i in (300, 301, 302)}}
    assert components(spark.createDataFrame([], "a bigint, b bigint"), at_once).collect() == []
