import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerlens.llm.exact_dedup import drop_exact_duplicates, exact_duplicates

AZ = {c: c + 32 for c in range(65, 91)}


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(AZ), []).append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        kept = False
        for i in sorted(ids, key=lambda x: (x is None, x)):
            first = i == keep and not kept
            kept |= first
            out.append((i, keep, len(ids), first, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def run(df, **kw):
    return sorted(map(tuple, exact_duplicates(df, **kw).collect()), key=str)


CASES = [(1, "Abc"), (2, "aBC"), (3, "É"), (4, "é"), (5, None), (6, ""), (7, "x" * 9000), (8, "x" * 9000), (9, "x" * 8999 + "y"),
         (9, "twice"), (9, "twice"), (None, "abc"), (None, "only null"), (10, "x" * 4096), (11, "ab" * 2048), (12, "ab" * 2048 + "a")]


@pytest.mark.parametrize("block_bytes,hash_bits", [(2048, 64), (4, 64), (3, 4), (1, 2)])
def test_matches_brute_force(docs_of, block_bytes, hash_bits):
    rows = CASES if block_bytes > 100 else [(i, t and t[:60]) for i, t in CASES]
    assert run(docs_of(rows), block_bytes=block_bytes, hash_bits=hash_bits) == brute(rows)


def test_empty_table(docs_of):
    assert run(docs_of([])) == []


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 6), st.text("abAB", max_size=9)), max_size=30))
def test_any_rows(docs_of, rows):
    assert run(docs_of(rows), block_bytes=2, hash_bits=3) == brute(rows)


def test_drop_keeps_one_row_of_each_group(docs_of):
    kept = drop_exact_duplicates(docs_of(CASES))
    assert kept.columns == docs_of([]).columns
    got = sorted(((r.text or "").translate(AZ), r.doc_id) for r in kept.collect())
    assert got == sorted((t, keep) for t, keep in {((t or "").translate(AZ), max((j for j, u in CASES if j is not None
                         and (u or "").translate(AZ) == (t or "").translate(AZ)), default=None)) for _, t in CASES})
