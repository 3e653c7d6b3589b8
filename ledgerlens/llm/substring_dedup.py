"""Substring dedup with repeated-phrase automata.

A window is ``WINDOW`` consecutive words. Every window's anchor is the run of
``GRAM`` words in it whose hash is least (the leftmost of equals), so equal
windows have equal anchors at equal places. Consecutive windows of one anchor
form a region. Three exchanges, all packed by numpy:

1. anchors are dealt out by hash; regions whose anchor occurs again go on;
2. these positions meet their documents, and the regions' words are dealt out
   by anchor, equal regions of a batch once with their places;
3. in each shard the windows that recur are found, runs of windows with the
   same occurrences become passages, an Aho-Corasick automaton of the passages
   (over word numbers) runs over all regions of the shard, and what a passage
   of two or more occurrences covers is a span.

The spans then meet the documents and their words are dropped. All windows that
start anywhere are in some region, so every occurrence is located; matches are
of whole words, exact.

Very frequent anchors are found beforehand from all documents and dealt out by
document too; an anchor with very many regions is dealt out by window in the
second exchange, so no group gathers a hot phrase's surroundings in one task.
"""
from __future__ import annotations

import hashlib
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import record_batch, shuffle_parts
from .wordhash import mix, run_hashes, text_groups, word_hashes

WINDOW = 35
GRAM = 8
FREQUENT_PART = 1 / 2000
FREQUENT_IN_BATCH = 3
#: An anchor with more regions than this is dealt out by window.
HOT_REGIONS = 20_000
BUCKETS_PER_PART = 4
#: Texts of documents handled together.
TEXT_BYTES = 1 << 22
#: Words of the passages of one automaton.
AUTOMATON_WORDS = 1_000_000

_HOT = 128
_PLACE = np.uint64((1 << 28) - 1)
ANCHOR = np.dtype([("gram", "<u4"), ("k0", "<u8"), ("k1", "<u8"), ("first", "<u4"), ("n", "u1")])
REGION = np.dtype([("k0", "<u8"), ("k1", "<u8"), ("gid", "<u8"), ("first", "<u4"), ("n", "u1")])
PLACE = np.dtype([("k0", "<u8"), ("k1", "<u8"), ("region", "<u4"), ("first", "<u4")])
SPAN = np.dtype([("k0", "<u8"), ("k1", "<u8"), ("first", "<u4"), ("n", "<u4")])

PACKED_DDL = "bucket int, packed binary"
PACKED = pa.schema([("bucket", pa.int32()), ("packed", pa.binary())])
MIXED_DDL = "bucket int, kind int, packed binary, doc_id bigint, text binary"
MIXED = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("packed", pa.binary()), ("doc_id", pa.int64()), ("text", pa.binary())])
SHARD_DDL = "bucket int, texts binary, gids binary, places binary"
SHARD = pa.schema([("bucket", pa.int32()), ("texts", pa.binary()), ("gids", pa.binary()), ("places", pa.binary())])
RESULT_DDL = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string"
RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
                    ("kept", pa.string())])


@dataclass(frozen=True)
class Settings:
    window: int = WINDOW
    gram: int = GRAM
    buckets: int = 1
    hot_regions: int = HOT_REGIONS
    automaton_words: int = AUTOMATON_WORDS


def document_key(doc_id: int | None, text: bytes) -> tuple[int, int]:
    """128 bits that tell rows apart; only rows with the same doc_id and text share them."""
    digest = xxhash.xxh3_128_digest(b"%s\n" % str(doc_id).encode() + text)
    return int.from_bytes(digest[:8], "little"), int.from_bytes(digest[8:], "little")


def anchors(texts: list[bytes], s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash of the anchor, first window, number of windows) of every region."""
    words, _, bounds = word_hashes(texts)
    none = np.zeros(0, np.int64)
    if len(words) < s.window:
        return none, none.astype(np.uint64), none, none
    grams = run_hashes(words, s.gram)
    least = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    width, span = 1, s.window - s.gram + 1
    while width < span:
        step = min(width, span - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))[:len(least)]
    start = np.flatnonzero(np.arange(len(least)) + s.window <= bounds[1:][owner])
    if not len(start):
        return none, none.astype(np.uint64), none, none
    place = (least[start] & _PLACE).astype(np.int64)
    cut = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    first, n = start[cut], np.diff(np.append(cut, len(place)))
    return owner[first], grams[place[cut]], first - bounds[owner[first]], n


def packed_rows(bucket: np.ndarray, entries: np.ndarray):
    """One row per bucket."""
    order = np.argsort(bucket, kind="stable")
    bucket, entries = bucket[order], entries[order]
    used, starts = np.unique(bucket, return_index=True)
    stops = np.append(starts, len(bucket))[1:]
    return used.astype(np.int32), [entries[a:b].tobytes() for a, b in zip(starts, stops, strict=True)]


def _frequent(batches, s):
    schema = pa.schema([("gram", pa.int64()), ("n", pa.int64())])
    for batch in batches:
        found = [anchors(texts, s)[1] for _, texts in text_groups(batch.column(1))]
        if found:
            grams, n = np.unique(np.concatenate(found), return_counts=True)
            many = n >= FREQUENT_IN_BATCH
            yield record_batch(schema, [grams[many].view(np.int64), n[many]])


def frequent_anchors(docs: DataFrame, s: Settings, n_docs: int) -> np.ndarray:
    """Sorted hashes of anchors with very many regions in all documents.

    They come to the driver: at most the mean number of anchors of a document / FREQUENT_PART, however many documents there are.
    """
    least = max(s.hot_regions, int(n_docs * FREQUENT_PART))
    counted = docs.mapInArrow(lambda it: _frequent(it, s), "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    return np.sort(counted.where(F.col("n") > least).select("gram").toArrow().column(0).to_numpy().view(np.uint64))


def _anchor_rows(batches, s, frequent):
    for batch in batches:
        ids = batch.column(0).to_pylist()
        parts, where = [], []
        for at, texts in text_groups(batch.column(1)):
            owner, gram, first, n = anchors(texts, s)
            keys = np.array([document_key(i, t) for i, t in zip(ids[at:], texts, strict=False)], np.uint64).reshape(-1, 2)
            out = np.zeros(len(owner), ANCHOR)
            near = np.minimum(np.searchsorted(frequent, gram), max(0, len(frequent) - 1))
            hot = frequent[near] == gram if len(frequent) else np.zeros(len(gram), bool)
            out["k0"], out["k1"], out["first"] = keys[owner, 0], keys[owner, 1], first
            out["gram"] = np.where(hot, 0, gram & np.uint64(0xFFFFFFFF))
            out["n"] = n + np.where(hot, _HOT, 0)
            spread = np.where(hot, mix(gram ^ out["k0"]), gram >> np.uint64(32))
            where.append((spread % np.uint64(s.buckets)).astype(np.int64))
            parts.append(out)
        if parts:
            yield record_batch(PACKED, packed_rows(np.concatenate(where), np.concatenate(parts)))


def recurring(entries: np.ndarray, bucket: int, s: Settings) -> np.ndarray:
    """Regions whose anchor occurs again in the bucket, and all of frequent anchors; the hot ones marked."""
    hot = entries["n"] >= _HOT
    _, place, count = np.unique(entries["gram"][~hot], return_inverse=True, return_counts=True)
    own = np.zeros(len(entries), np.int64)
    own[~hot] = count[place]
    good = hot | (own > 1)
    out = np.zeros(int(good.sum()), REGION)
    for field in ("k0", "k1", "first"):
        out[field] = entries[field][good]
    out["gid"] = (np.uint64(bucket) << np.uint64(32)) | entries["gram"][good].astype(np.uint64)
    out["n"] = entries["n"][good] | np.where(own[good] > s.hot_regions, _HOT, 0).astype(np.uint8)
    return out


def _by_bucket(batches, kinds):
    """(bucket, joined bytes) of rows sorted by bucket."""
    now, parts = None, []
    for batch in batches:
        for bucket, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if bucket != now:
                if parts:
                    yield now, np.frombuffer(b"".join(parts), kinds)
                now, parts = bucket, []
            parts.append(packed)
    if parts:
        yield now, np.frombuffer(b"".join(parts), kinds)


def _mixed(buckets, packed):
    none = len(buckets)
    return record_batch(MIXED, [buckets, np.zeros(none, np.int32), packed, pa.nulls(none, pa.int64()), pa.nulls(none, pa.binary())])


def _key_bucket(entries: np.ndarray, s: Settings) -> np.ndarray:
    return (entries["k0"] % np.uint64(s.buckets)).astype(np.int64)


def _recurring_rows(batches, s):
    for bucket, entries in _by_bucket(batches, ANCHOR):
        found = recurring(entries, bucket, s)
        yield _mixed(*packed_rows(_key_bucket(found, s), found))


def _document_rows(batches, s):
    zipper = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        for at, texts in text_groups(batch.column(1)):
            size = len(texts)
            ids = batch.column(0).slice(at, size)
            buckets = [document_key(i, t)[0] % s.buckets for i, t in zip(ids.to_pylist(), texts, strict=True)]
            yield record_batch(MIXED, [np.array(buckets, np.int32), np.ones(size, np.int32), pa.nulls(size, pa.binary()), ids,
                                       [zipper.compress(t) for t in texts]])


def _with_entries(batches, kinds):
    """Lists of (doc_id, key, text, own entries), of about TEXT_BYTES, from rows sorted by (bucket, kind): entries first, then documents."""
    unzip = zstandard.ZstdDecompressor()
    now, parts, table, size = None, [], None, 0
    for batch in batches:
        out = []
        buckets, kind, packed, ids, texts = (batch.column(i) for i in range(5))
        for k, (bucket, is_doc) in enumerate(zip(buckets.to_pylist(), kind.to_pylist(), strict=True)):
            if bucket != now:
                now, parts, table = bucket, [], None
            if not is_doc:
                parts.append(packed[k].as_py())
                continue
            if table is None:
                rows = np.frombuffer(b"".join(parts), kinds)
                rows = rows[np.lexsort((rows["first"], rows["k1"], rows["k0"]))]
                new = np.flatnonzero(np.append(True, (rows["k0"][1:] != rows["k0"][:-1]) | (rows["k1"][1:] != rows["k1"][:-1])))[:len(rows)]
                ends = np.append(new, len(rows))[1:]
                table = {(a, b): rows[x:y] for a, b, x, y in zip(rows["k0"][new].tolist(), rows["k1"][new].tolist(), new, ends, strict=True)}
            text, doc_id = unzip.decompress(texts[k].as_py()), ids[k].as_py()
            key = document_key(doc_id, text)
            out.append((doc_id, key, text, table.get(key)))
            size += len(text)
            if size > TEXT_BYTES:
                yield out
                out, size = [], 0
        if out:
            yield out


def _region_rows(batches, s):
    zipper = zstandard.ZstdCompressor(level=3)
    for docs in _with_entries(batches, REGION):
        seen: dict[tuple[int, bytes], int] = {}
        places = []
        for _, key, text, entries in docs:
            if entries is None:
                continue
            words = text.split()
            # Equal rows share a key and bring each region as often as there are rows; every row's own are enough.
            _, once = np.unique(entries["first"], return_index=True)
            for gid, first, n in zip(entries["gid"][once].tolist(), entries["first"][once].tolist(), entries["n"][once].tolist(), strict=True):
                if n >= _HOT:
                    for f in range(first, first + n - _HOT):
                        own = b" ".join(words[f:f + s.window])
                        places.append((*key, seen.setdefault((xxhash.xxh3_64_intdigest(own), own), len(seen)), f))
                else:
                    own = b" ".join(words[first:first + n + s.window - 1])
                    places.append((*key, seen.setdefault((gid, own), len(seen)), first))
        if not places:
            continue
        places = np.array(places, PLACE)
        regions = list(seen)
        gids = np.array([g for g, _ in regions], np.uint64)
        shard = (mix(gids) % np.uint64(s.buckets)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        number = np.zeros(len(regions), np.int64)
        used, starts = np.unique(shard[order], return_index=True)
        stops = np.append(starts, len(order))[1:]
        number[order] = np.arange(len(order)) - np.repeat(starts, stops - starts)
        of = shard[places["region"]]
        by = np.argsort(of, kind="stable")
        places["region"] = number[places["region"]]
        cuts = np.searchsorted(of[by], np.append(used, s.buckets))
        yield record_batch(SHARD, [
            used.astype(np.int32), [zipper.compress(b"\n".join(regions[k][1] for k in order[a:b])) for a, b in zip(starts, stops, strict=True)],
            [gids[order[a:b]].tobytes() for a, b in zip(starts, stops, strict=True)],
            [places[by[a:b]].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]])


def passages(ids: np.ndarray, bounds: np.ndarray, weight: np.ndarray, window: int) -> list[tuple[int, int]]:
    """(first word, words) of each different passage: runs of windows of one region that recur, with the same occurrences."""
    hashes = run_hashes(mix(ids.astype(np.uint64) + np.uint64(1)), window)
    owner = np.repeat(np.arange(len(weight)), np.diff(bounds))[:len(hashes)]
    start = np.flatnonzero(np.arange(len(hashes)) + window <= bounds[1:][owner])
    if not len(start):
        return []
    owner = owner[start]
    _, where = np.unique(hashes[start], return_inverse=True)
    by = np.argsort(where, kind="stable")
    cut = np.flatnonzero(np.append(True, where[by][1:] != where[by][:-1]))
    total = np.add.reduceat(weight[owner[by]], cut)[where]
    same = np.add.reduceat(mix(owner[by].astype(np.uint64) + np.uint64(7)), cut)[where]
    new = np.append(True, (start[1:] != start[:-1] + 1) | (owner[1:] != owner[:-1]) | (same[1:] != same[:-1]))
    runs = np.flatnonzero(new)
    length = np.diff(np.append(runs, len(start)))
    good = total[runs] > 1
    runs, length = runs[good], length[good]
    _, once = np.unique(np.stack([where[runs], length], axis=1), axis=0, return_index=True)
    return list(zip(start[runs[once]].tolist(), (length[once] + window - 1).tolist(), strict=True))


def covered(ids: np.ndarray, bounds: np.ndarray, weight: np.ndarray, window: int) -> list[list[tuple[int, int]]]:
    """For each region the (first, end) of what passages of two or more occurrences cover, located by the automaton."""
    words = ids.tolist()
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    found = passages(ids, bounds, weight, window)
    for k, (first, n) in enumerate(found):
        automaton.add_word(tuple(words[first:first + n]), (k, n))
    out: list[list[tuple[int, int]]] = [[] for _ in weight]
    if not found:
        return out
    automaton.make_automaton()
    hits, count = [], [0] * len(found)
    for r, (a, b, w) in enumerate(zip(bounds.tolist(), bounds[1:].tolist(), weight.tolist(), strict=False)):
        for end, (k, n) in automaton.iter(tuple(words[a:b])):
            hits.append((r, k, end + 1 - n, end + 1))
            count[k] += w
    for r, k, first, end in hits:
        if count[k] > 1:
            if out[r] and first <= out[r][-1][1]:
                out[r][-1] = (min(first, out[r][-1][0]), max(end, out[r][-1][1]))
            else:
                out[r].append((first, end))
    return out


def _chunks(sizes: np.ndarray, gids: np.ndarray, most: int):
    """Slices of rows in order of gid, each of about ``most`` words; a gid stays whole."""
    start, size = 0, 0
    for i in range(len(sizes)):
        if size > most and gids[i] != gids[i - 1]:
            yield start, i
            start, size = i, 0
        size += int(sizes[i])
    if start < len(sizes):
        yield start, len(sizes)


def shard_spans(texts: list[bytes], gids: np.ndarray, places: np.ndarray, s: Settings) -> np.ndarray:
    """Spans of one shard: texts are regions (repeated ones allowed), places their occurrences."""
    number: dict[tuple[int, bytes], int] = {}
    of = np.array([number.setdefault(x, len(number)) for x in zip(gids.tolist(), texts, strict=True)], np.int64)
    regions = sorted(number, key=lambda x: x[0])
    rank = np.zeros(len(number), np.int64)
    rank[[number[x] for x in regions]] = np.arange(len(regions))
    of = rank[of][places["region"]]
    order = np.argsort(of, kind="stable")
    of, places = of[order], places[order]
    weight = np.bincount(of, minlength=len(regions))
    split = pc.split_pattern(pa.array([x[1].decode() for x in regions], pa.large_string()), " ")
    ids = split.flatten().dictionary_encode().indices.to_numpy()
    bounds = split.offsets.to_numpy()
    gid = np.array([x[0] for x in regions], np.uint64)
    out = []
    at = np.searchsorted(of, np.arange(len(regions) + 1))
    for a, b in _chunks(np.diff(bounds), gid, s.automaton_words):
        spans = covered(ids[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a], weight[a:b], s.window)
        for r, own in zip(range(a, b), spans, strict=True):
            for first, end in own:
                part = places[at[r]:at[r + 1]]
                found = np.zeros(len(part), SPAN)
                found["k0"], found["k1"], found["first"], found["n"] = part["k0"], part["k1"], part["first"] + first, end - first
                out.append(found)
    return np.concatenate(out) if out else np.zeros(0, SPAN)


def _span_rows(batches, s):
    unzip = zstandard.ZstdDecompressor()
    now, texts, gids, places, base = None, [], [], [], 0

    def flush():
        spans = shard_spans(texts, np.concatenate(gids), np.concatenate(places), s)
        return _mixed(*packed_rows(_key_bucket(spans, s), spans))

    for batch in batches:
        for bucket, zipped, gid, place in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if bucket != now:
                if texts:
                    yield flush()
                now, texts, gids, places, base = bucket, [], [], [], 0
            texts += unzip.decompress(zipped).split(b"\n")
            gids.append(np.frombuffer(gid, np.uint64))
            place = np.frombuffer(place, PLACE).copy()
            place["region"] += base
            places.append(place)
            base = len(texts)
    if texts:
        yield flush()


def _removed_rows(batches, with_text):
    for docs in _with_entries(batches, SPAN):
        out = []
        for doc_id, _, text, spans in docs:
            words = text.split()
            removed = 0
            total = len(words)
            if spans is not None:
                keep = np.zeros(total + 1, np.int64)
                np.add.at(keep, spans["first"], 1)
                np.add.at(keep, spans["first"].astype(np.int64) + spans["n"], -1)
                gone = np.cumsum(keep[:-1]) > 0
                removed = int(gone.sum())
                words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            kept = b" ".join(words)
            out.append((doc_id, total, removed, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace") if with_text else None))
        yield record_batch(RESULT, zip(*out, strict=True))


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot_regions: int = HOT_REGIONS,
                   automaton_words: int = AUTOMATON_WORDS, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, with_text, the kept words joined by one space, for every row.

    A word is removed if a window that covers it has a word sequence that also
    starts elsewhere, in the same document or another. Words are as they stand.
    A null text has no words; texts shorter than the window keep all. Repeated
    rows are documents of their own, so their windows recur. A null doc_id stays
    null; an empty table gives no rows; columns other than doc_id and text are
    not read. All windows are judged on the input.
    """
    spark = docs.sparkSession
    n = shuffle_parts(spark)
    s = Settings(window, gram, n * BUCKETS_PER_PART, hot_regions, automaton_words)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    frequent = frequent_anchors(rows, s, rows.count())

    def dealt(df, *order):
        return df.repartition(n, "bucket").sortWithinPartitions("bucket", *order)

    whole = rows.mapInArrow(lambda it: _document_rows(it, s), MIXED_DDL)
    found = dealt(rows.mapInArrow(lambda it: _anchor_rows(it, s, frequent), PACKED_DDL)).mapInArrow(
        lambda it: _recurring_rows(it, s), MIXED_DDL)
    regions = dealt(found.unionByName(whole), "kind").mapInArrow(lambda it: _region_rows(it, s), SHARD_DDL)
    spans = dealt(regions).mapInArrow(lambda it: _span_rows(it, s), MIXED_DDL)
    result = dealt(spans.unionByName(whole), "kind").mapInArrow(lambda it: _removed_rows(it, with_text), RESULT_DDL)
    return result if with_text else result.drop("kept")
