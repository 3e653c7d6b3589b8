import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerlens.llm import substring_dedup as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    docs = [WORD.findall(t or "") for _, t in rows]
    count = Counter(tuple(w[i:i + window]) for w in docs for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, docs):
        gone = {j for i in range(len(w) - window + 1) if count[tuple(w[i:i + window])] > 1 for j in range(i, i + window)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


def run(df, **kw):
    return sorted(map(tuple, S.remove_repeats(df, with_text=True, **kw).collect()), key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(4, 60))] for _ in range(8)]
    docs = []
    for _ in range(40):
        words = []
        for _ in range(rng.randint(1, 5)):
            words += [rng.choice(vocabulary) for _ in range(rng.randint(0, 25))]
            if rng.random() < 0.6:
                p = rng.choice(passages)
                a = rng.randint(0, len(p) // 2)
                words += p[a:rng.randint(a, len(p))] if rng.random() < 0.5 else p
        docs.append(" ".join(words))
    docs += ["as " * 90, "as " * 40 + "x", "a b " * 60, "A B " * 60, docs[3], docs[3] + " tail", docs[4][:200]]
    return [(i, t) for i, t in enumerate(docs)]


@pytest.mark.parametrize("seed,kw", [(1, {}), (2, {"window": 12, "gram": 4}), (3, {"window": 12, "gram": 4, "hot_regions": 1}),
                                     (4, {"window": 7, "gram": 2, "hot_regions": 6, "automaton_words": 50}), (5, {"window": 5, "gram": 5})])
def test_against_brute_force(docs_of, seed, kw):
    rows = corpus(seed)
    assert run(docs_of(rows).repartition(3), **kw) == brute(rows, kw.get("window", 35))


def test_edge_rows(docs_of):
    words = [f"x{i}" for i in range(30_000)]
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "short"), (5, " ".join(words)), (6, "é  " + "\n".join(words[100:134])),
            (7, "z\t" + "\x0b".join(words[200:235]) + "\x0cq"), (8, "same " * 34), (9, "same " * 35), (10, "row " + " ".join(words[:40])),
            (10, "row " + " ".join(words[:40])), (None, " ".join(words[500:560])), (11, "ONE \xa0 " + " ".join(words[700:735]).upper())]
    assert run(docs_of(rows)) == brute(rows, 35)
    assert run(docs_of([])) == []


def test_frequent_anchors_are_dealt_out_by_document(docs_of, monkeypatch):
    rows = [(i, f"s{i} " + " ".join(f"p{j}" for j in range(20)) + f" e{i % 7}") for i in range(60)]
    found = S.frequent_anchors(docs_of(rows).select("doc_id", "text").coalesce(1), S.Settings(12, 4, 8, 5), len(rows))
    assert len(found)
    assert run(docs_of(rows).coalesce(1), window=12, gram=4, hot_regions=5) == brute(rows, 12)


def test_every_window_is_in_one_region():
    rng = random.Random(0)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 120))).encode() for _ in range(30)]
    s = S.Settings(9, 3)
    owner, _, first, n = S.anchors(texts, s)
    seen = Counter((o, w) for o, f, k in zip(owner.tolist(), first.tolist(), n.tolist()) for w in range(f, f + k))
    assert seen == Counter((o, w) for o, t in enumerate(texts) for w in range(max(0, len(t.split()) - 8)))
    assert n.max() <= 7


def test_a_passage_of_one_occurrence_covers_nothing():
    ids = np.array([0, 1, 2, 3, 4, 5, 0, 1, 2, 9, 8, 7])
    bounds = np.array([0, 6, 12])
    assert S.covered(ids, bounds, np.array([1, 1]), 3) == [[(0, 3)], [(0, 3)]]
    assert S.covered(ids, bounds, np.array([2, 1]), 3) == [[(0, 6)], [(0, 3)]]
    assert S.covered(ids[:6], bounds[:2], np.array([1]), 3) == [[]]
