"""Source divergence against a plain version, and the pointer sort against sorted()."""
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import source_divergence as D
from ledgerlens.llm.queries import QUERIES

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def expected(rows, min_docs=10, top=10):
    docs = [(lang or "", source or "", terms(text)) for lang, source, text in rows]
    held, count, lang_count = defaultdict(int), Counter(), Counter()
    for lang, source, words in docs:
        for t in set(words):
            held[lang, t] += 1
    for lang, source, words in docs:
        for t in words:
            if held[lang, t] >= min_docs:
                count[lang, source, t] += 1
                lang_count[lang, t] += 1
    kept = defaultdict(list)
    for (lang, t), n in held.items():
        if n >= min_docs:
            kept[lang].append(t)
    groups = {(lang, source) for lang, source, _ in docs}
    out = []

    def share(n, total, v):
        return 1 + 1_000_000_000 * (n + 2) // (total + 2 * v)

    p = {}
    for lang, source in groups:
        v, n = len(kept[lang]), sum(c for (x, s, _), c in count.items() if (x, s) == (lang, source))
        p[lang, source] = {t: share(count[lang, source, t], n, v) for t in kept[lang]}
    for lang, source in groups:
        own, v, total = p[lang, source], len(kept[lang]), sum(c for (x, _), c in lang_count.items() if x == lang)

        def f(x, y):
            return (x - y) ** 2 // (x + y)

        pairs = [(sum(f(own[t], p[lang, other][t]) for t in own), other) for x, other in groups if x == lang and other != source]
        marks = [(f(own[t], q), t) for t in own if count[lang, source, t] and own[t] > (q := share(lang_count[lang, t], total, v))]
        for part, found in (("pair", pairs), ("term", marks)):
            found.sort(key=lambda r: (-r[0], r[1].encode()))
            out += [(lang, source, part, item, value, k) for k, (value, item) in enumerate(found, 1) if part == "pair" or k <= top]
    return sorted(out)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("abABzé漢 .\x00\x7f"), max_size=60), max_size=12), st.sampled_from([1, 2, 5, 1 << 14]))
def test_pointers_sort_like_words(texts, small):
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, data)])
    raw = D._LOWER[np.frombuffer(b"".join(data), np.uint8)]
    starts, ends = D.pointers(raw, offsets)
    words = [w.encode() for t in texts for w in terms(t)]
    assert [raw[a:b].tobytes() for a, b in zip(starts, ends, strict=True)] == words
    order, runs = D.sorted_runs(raw, starts, ends, small)
    # Same terms in one run, places within a run ascending, every run another term.
    bounds = [*runs.tolist(), len(order)] if len(order) else []
    seen = []
    for a, b in zip(bounds, bounds[1:], strict=False):
        assert len({words[i] for i in order[a:b]}) == 1 and order[a:b].tolist() == sorted(order[a:b])
        seen.append(words[order[a]])
    assert seen == sorted(set(words))


def frame(spark, rows):
    return spark.createDataFrame([(i, *r, 7, "x") for i, r in enumerate(rows)],
                                 "doc_id bigint, lang string, source string, text string, count bigint, term string")


WORDS = ["the", "The", "of", "naïve", "漢字", "x" * 30, "x" * 31, "zz9q", "rare"]


@pytest.mark.parametrize("shard_bytes,held", [(16 << 20, 1 << 20), (40, 5)])
def test_small_table(spark, monkeypatch, shard_bytes, held):
    monkeypatch.setattr(D.sent_counts, "__defaults__", (shard_bytes,))
    monkeypatch.setattr(D, "HELD_ENTRIES", held)
    monkeypatch.setattr(D, "BLOCK_ROWS", held)
    monkeypatch.setattr(D, "BLOCK_CELLS", held)
    rng = np.random.default_rng(5)
    rows = [(lang, f"s{k}", " ".join(rng.choice(WORDS[:-1], rng.integers(0, 9))))
            for lang in ("en", "de", None) for k in range(4) for _ in range(8)]
    rows += [("en", "s1", None), ("en", None, ""), ("fr", "only", "rare"), ("it", "a", "rare"), ("it", "b", "12 34"),
             ("en", "hot", " ".join(["the of"] * 3000)), ("en", "s0", "the"), ("en", "s0", "the"), ("en", "s0", "漢" * 50_000)]
    got = D.audit(frame(spark, rows)).collect()
    assert sorted(map(tuple, got)) == expected(rows)


def test_all_terms_are_kept_with_one_document(spark):
    rows = [("en", "a", "x y y"), ("en", "b", "y z"), ("en", "c", "q")]
    assert sorted(map(tuple, D.audit(frame(spark, rows), min_docs=1, top_terms=2).collect())) == expected(rows, 1, 2)


def test_large_counts_stay_exact(spark):
    from pyspark.sql import functions as F
    n, v = 10**14, 10**7
    row = spark.range(1).select(D.share(F.lit(n), F.lit(3 * n), F.lit(v)).alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 2) // (3 * n + 2 * v)


def test_empty_table(spark):
    assert D.audit(frame(spark, [])).collect() == []


def test_shard_of_texts_without_terms():
    batch = D.shard_counts(["a", "a"], ["b", "b"], pa.array(["", "12"], pa.string()))
    assert batch.num_rows == 0


def test_whole_table(spark, sf):
    rows = [(r.lang, r.source, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op12_source_divergence"](spark, sf).collect())) == expected(rows)
