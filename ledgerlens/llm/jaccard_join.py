"""N-gram Jaccard join with size-banded tiles and hashed bitmap signatures.

Every text becomes its sorted array of distinct shingle hashes. Equal sets are
one class. Two sets of similarity t share a shingle among the first
size - ceil(t * size) + 1 of each in any common order; the order used is by
hash, with the shingles that very many documents hold last. Only those prefix
shingles are dealt out, packed, by hash; a shingle that one class alone holds
goes no further.

Candidates: each class is paired with the leader of its size band that it meets
in most shingle groups, which joins large groups of near copies without
comparing all their pairs. Then, where a shingle group still holds several
components, its members are cut into tiles and compared: sizes must allow the
similarity, and the bits that one signature lacks of the other bound the
overlap from above. A tile gives the edges of a forest of what may be linked;
the connected parts are blocks that no link leaves.

Links: the classes of a block, most often a few, come together with their
sorted arrays, made anew from the texts, in tiles of a bounded number. Bitmaps of
more bits bound the overlap, and the sorted arrays confirm it, best bound first;
pairs that links already connect are skipped. Tiles of one block are compared
only where their classes are in different components. So every link between
different components is found, and components are exact.

A set's bitmap has a power of two of bits, at least its size, and is folded to
the length of a smaller set's. Shingles are told apart by 64-bit hashes, sets by
128-bit digests of their arrays.
"""
from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from .common import materialize, record_batch, shuffle_parts
from .components import Forest, components
from .wordhash import GROUP_ROWS, groups, mix, run_hashes, text_groups, word_hashes

SHINGLE_WORDS = 5
THRESHOLD = Fraction(4, 5)
#: A shingle is frequent if more documents than this part of all, and more than the least number, hold it.
FREQUENT_PART, FREQUENT_LEAST = Fraction(1, 1000), 64
#: It must be in so many documents of one batch to be counted there at all.
FREQUENT_IN_BATCH = 3
TILE = 512
#: Bits for each shingle in the bitmaps of a tile with its sorted arrays.
FINE_BITS = 8
BUCKETS_PER_PART = 4
#: Pairs whose bitmaps are compared in one step.
PAIRS_AT_ONCE = 1 << 17
#: 64-bit words of bitmaps held for that at a time.
WORDS_AT_ONCE = 1 << 19

SETS_DDL = "doc_id bigint, n bigint, digest binary, node bigint, bits binary"
SETS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("node", pa.int64()), ("bits", pa.binary())])
PACKED_DDL = "bucket int, packed binary"
PACKED = pa.schema([("bucket", pa.int32()), ("packed", pa.binary())])
MEMBERS_DDL = "shingle bigint, node bigint, leader bigint"
MEMBERS = pa.schema([("shingle", pa.int64()), ("node", pa.int64()), ("leader", pa.int64())])
POSTING = np.dtype([("shingle", "<u4"), ("band", "u1"), ("node", "<i8")])
ARRAYS_DDL = "block bigint, class bigint, shingles binary"
ARRAYS = pa.schema([("block", pa.int64()), ("class", pa.int64()), ("shingles", pa.binary())])
PAIR_DDL = "a bigint, b bigint"
PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


@dataclass(frozen=True)
class Rule:
    """What a link is: shingles of so many words, at this similarity or more."""
    words: int = SHINGLE_WORDS
    threshold: Fraction = THRESHOLD

    def prefix(self, n: np.ndarray) -> np.ndarray:
        p, q = self.threshold.numerator, self.threshold.denominator
        return n - -(-n * p // q) + 1

    def overlap(self, a, b):
        """The least intersection of linked sets of sizes a and b."""
        p, q = self.threshold.numerator, self.threshold.denominator
        return -(-(a + b) * p // (p + q))

    def linked(self, common: int, a: int, b: int) -> bool:
        return common * self.threshold.denominator >= (a + b - common) * self.threshold.numerator

    def band(self, n: np.ndarray) -> np.ndarray:
        """Linked sets are in one band or adjacent ones."""
        return np.floor(np.log(np.maximum(n, 1)) / -np.log(float(self.threshold)) + 1e-9).astype(np.uint8)


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text, A-Z lower-cased; shorter texts have their whole sequence."""
    hashes, _, bounds = word_hashes([t.lower() for t in texts])
    runs = run_hashes(hashes, words)
    out = []
    for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
        if b - a >= words:
            out.append(np.unique(runs[a:b - words + 1]))
        else:
            out.append(run_hashes(hashes[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out


def bitmap(shingles: np.ndarray) -> bytes:
    """One bit for the lowest bits of each hash."""
    size = max(64, 1 << int(max(1, len(shingles)) - 1).bit_length())
    bits = np.zeros(size, bool)
    bits[(shingles & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def fold(bits: np.ndarray, length: int) -> np.ndarray:
    """Rows of 64-bit words of a bitmap, folded to ``length`` words."""
    while bits.shape[1] > length:
        half = bits.shape[1] // 2
        bits = bits[:, :half] | bits[:, half:]
    return bits


def _describe(batches, rule):
    for batch in batches:
        for at, texts in text_groups(batch.column(1)):
            sets = shingle_sets(texts, rule.words)
            digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            yield record_batch(SETS, [batch.column(0).slice(at, len(texts)), [len(s) for s in sets], digests,
                                      [int.from_bytes(d[:8], "little", signed=True) for d in digests], list(map(bitmap, sets))])


def _frequent(batches, rule):
    schema = pa.schema([("shingle", pa.int64()), ("n", pa.int64())])
    for batch in batches:
        sets = [s for _, texts in text_groups(batch.column(1)) for s in shingle_sets(texts, rule.words)]
        if sets:
            shingles, n = np.unique(np.concatenate(sets), return_counts=True)
            many = n >= FREQUENT_IN_BATCH
            yield record_batch(schema, [shingles[many].view(np.int64), n[many]])


def frequent_shingles(docs: DataFrame, rule: Rule, n_docs: int) -> np.ndarray:
    """Sorted hashes of shingles seen in more than FREQUENT_PART of all documents.

    It comes to the driver: at most mean set size / FREQUENT_PART hashes, whatever the number of documents.
    """
    least = max(FREQUENT_LEAST, int(n_docs * FREQUENT_PART))
    counted = docs.mapInArrow(lambda it: _frequent(it, rule), "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))
    found = counted.where(F.col("n") > least).select("shingle").toArrow().column(0).to_numpy().view(np.uint64)
    return np.sort(found)


def prefix_postings(sets: list[np.ndarray], nodes: np.ndarray, rule: Rule, frequent: np.ndarray, buckets: int):
    """(bucket, POSTING) of the prefix shingles of each set.

    A frequent shingle is its number in ``frequent``, marked by the top bit of
    the band, and goes to a bucket by node as well; another is the low half of
    its hash in the bucket of the high half.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    first = np.cumsum(sizes) - sizes
    at = np.minimum(np.searchsorted(frequent, flat), max(0, len(frequent) - 1))
    hot = frequent[at] == flat if len(frequent) else np.zeros(len(flat), bool)
    hot_upto = np.cumsum(hot)
    before = np.where(first > 0, hot_upto[np.maximum(first - 1, 0)], 0) if len(flat) else first
    n_hot = np.bincount(owner[hot], minlength=len(sets))
    hot_rank = hot_upto - 1 - before[owner] if len(flat) else hot_upto
    cold_rank = np.arange(len(flat)) - first[owner] - (hot_upto - before[owner]) if len(flat) else hot_upto
    k = rule.prefix(sizes)
    chosen = np.where(hot, hot_rank < (k - (sizes - n_hot))[owner], cold_rank < k[owner]) if len(flat) else hot
    own, h, hot, at = owner[chosen], flat[chosen], hot[chosen], at[chosen]
    out = np.zeros(len(h), POSTING)
    out["shingle"] = np.where(hot, at, h & np.uint64(0xFFFFFFFF))
    out["band"] = rule.band(sizes)[own] | np.where(hot, 128, 0).astype(np.uint8)
    out["node"] = nodes[own]
    spread = np.where(hot, mix(h ^ out["node"].view(np.uint64) if len(h) else h), h >> np.uint64(32))
    return (spread % np.uint64(buckets)).astype(np.int64), out


def _pack(batches, rule, frequent, buckets):
    for batch in batches:
        parts = []
        seen: set[bytes] = set()
        for _, texts in text_groups(batch.column(1)):
            sets, nodes = [], []
            for s in shingle_sets(texts, rule.words):
                digest = xxhash.xxh3_128_digest(s.tobytes())
                if len(s) and digest not in seen:  # copies in one batch count once
                    seen.add(digest)
                    sets.append(s)
                    nodes.append(int.from_bytes(digest[:8], "little", signed=True))
            parts.append(prefix_postings(sets, np.array(nodes, np.int64), rule, frequent, buckets))
        if not parts:
            continue
        bucket = np.concatenate([x for x, _ in parts])
        posting = np.concatenate([x for _, x in parts])
        order = np.argsort(bucket, kind="stable")
        bucket, posting = bucket[order], posting[order]
        used, starts = np.unique(bucket, return_index=True)
        stops = np.append(starts, len(bucket))[1:]
        yield record_batch(PACKED, [used.astype(np.int32), [posting[a:b].tobytes() for a, b in zip(starts, stops, strict=True)]])


def shared(posting: np.ndarray, bucket: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingle group, node, leader) of the shingles that several nodes of this bucket hold, and of all frequent ones.

    The leader of a size band is its node of least mixed number; a leader leads itself.
    """
    posting = np.unique(posting)
    order = np.lexsort((mix(posting["node"].view(np.uint64)), posting["band"], posting["shingle"], posting["band"] >> 7))
    posting = posting[order]
    frequent = posting["band"] >> 7
    group = np.flatnonzero(np.append(True, (posting["shingle"][1:] != posting["shingle"][:-1]) | (frequent[1:] != frequent[:-1])))
    group = group[:len(posting)]
    sizes = np.diff(np.append(group, len(posting)))
    several = np.repeat((sizes > 1) | (frequent[group] > 0), sizes)
    lead = np.append(True, (posting["shingle"][1:] != posting["shingle"][:-1]) | (posting["band"][1:] != posting["band"][:-1]))[:len(posting)]
    leader = posting["node"][np.maximum.accumulate(np.where(lead, np.arange(len(posting)), 0))] if len(posting) else posting["node"]
    number = np.where(frequent > 0, -1 - posting["shingle"].astype(np.int64), posting["shingle"].astype(np.int64) * buckets + bucket)
    return number[several], posting["node"][several], leader[several]


def _share(batches, buckets):
    now, parts = None, []

    def flush():
        number, node, leader = shared(np.concatenate(parts), now, buckets)
        return record_batch(MEMBERS, [number, node, leader])

    for batch in batches:
        for bucket, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if bucket != now:
                if parts:
                    yield flush()
                now, parts = bucket, []
            parts.append(np.frombuffer(packed, POSTING))
    if parts:
        yield flush()


def _filter_pairs(batches, rule):
    """Of rows (a, b, n_a, bits_a, n_b, bits_b) the pairs whose sizes and bitmaps allow a link."""
    for batch in batches:
        a, b, n_a, n_b = (batch.column(c).to_numpy() for c in (0, 1, 2, 4))
        size = len(a)
        signatures = Signatures(pa.concat_arrays([batch.column(3).cast(pa.large_binary()), batch.column(5).cast(pa.large_binary())]))
        need = rule.overlap(n_a, n_b)
        lacks, lacked = signatures.lacking(np.arange(size), np.arange(size, 2 * size))
        good = (need <= np.minimum(n_a, n_b)) & (n_a - lacks >= need) & (n_b - lacked >= need)
        yield record_batch(PAIRS, [a[good], b[good]])


class Signatures:
    """Bitmaps of rows, as 64-bit words folded to any shorter length."""

    def __init__(self, bits: pa.Array):
        bits = bits.cast(pa.large_binary())
        self.raw = np.frombuffer(bits.buffers()[2] or b"", np.uint8)
        ends = np.frombuffer(bits.buffers()[1], np.int64)[bits.offset:bits.offset + len(bits) + 1]
        self.start, self.length = ends[:-1], np.diff(ends) // 8

    def words(self, rows: np.ndarray, length: int) -> np.ndarray:
        out = np.zeros((len(rows), length), np.uint64)
        for own in np.unique(self.length[rows]).tolist():
            at = self.length[rows] == own
            raw = self.raw[self.start[rows[at]][:, None] + np.arange(own * 8)]
            out[at] = fold(raw.view("<u8"), length)
        return out

    def lacking(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bits of rows a that rows b lack, and of b that a lack, pair by pair."""
        short = np.minimum(self.length[a], self.length[b])
        out = np.zeros((2, len(a)), np.int64)
        for length in np.unique(short).tolist():
            same = np.flatnonzero(short == length)
            step = max(1, WORDS_AT_ONCE // length)
            for at in (same[i:i + step] for i in range(0, len(same), step)):
                rows, place = np.unique(np.concatenate([a[at], b[at]]), return_inverse=True)
                words = self.words(rows, length)
                x, y = words[place[:len(at)]], words[place[len(at):]]
                out[0, at] = np.bitwise_count(x & ~y).sum(axis=1)
                out[1, at] = np.bitwise_count(y & ~x).sum(axis=1)
        return out[0], out[1]


def compare_tiles(rows: pa.Table, rule: Rule) -> list[tuple[int, int]]:
    """Components to connect, as edges of a forest: two are if sizes and bitmaps allow a link between them.

    Compared are all left with all right rows of each (shingle, i, j). The rows are sorted by (shingle, i, j, side).
    """
    key = [rows.column(c).to_numpy() for c in ("shingle", "i", "j")]
    side, n, component = (rows.column(c).to_numpy() for c in ("side", "n", "component"))
    names, component = np.unique(component, return_inverse=True)
    size = len(side)
    new = np.append(True, np.any([k[1:] != k[:-1] for k in key], axis=0))[:size]
    group = np.cumsum(new) - 1
    ends = np.append(np.flatnonzero(new)[1:], size)
    left = np.flatnonzero(side == 0)
    n_right = np.bincount(group[side == 1], minlength=len(ends))
    count = n_right[group[left]]
    start = ends[group[left]] - count
    left, start, count = left[count > 0], start[count > 0], count[count > 0]
    signatures = Signatures(rows.column("bits").combine_chunks()) if len(left) else None
    upto = np.cumsum(count)
    forest, now = Forest(), np.arange(len(names))
    at = 0
    while at < len(left):
        stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS_AT_ONCE, "right")))
        c = count[at:stop]
        a = np.repeat(left[at:stop], c)
        b = np.repeat(start[at:stop] - np.cumsum(c) + c, c) + np.arange(c.sum())
        at = stop
        good = now[component[a]] != now[component[b]]
        a, b = a[good], b[good]
        need = rule.overlap(n[a], n[b])
        good = need <= np.minimum(n[a], n[b])
        a, b, need = a[good], b[good], need[good]
        if len(a):
            lacks, lacked = signatures.lacking(a, b)
            good = (n[a] - lacks >= need) & (n[b] - lacked >= need)
            pairs = np.unique(now[component[a[good]]] * len(names) + now[component[b[good]]])
            for x, y in zip(*(v.tolist() for v in np.divmod(pairs, len(names))), strict=True):
                forest.add(x, y)
            if len(pairs):
                now = np.array([forest.find(x) for x in now.tolist()])
    return [(int(names[x]), int(names[y])) for x, y in forest.edges]


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return record_batch(PAIRS, zip(*pairs, strict=True) if pairs else [[], []])


def _compare(batches, rule):
    """Edges of compare_tiles over whole groups."""
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([rest, rows]) if rest else rows
        keys = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in ("shingle", "i", "j")])
        last = int(np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)))[-1]) if rows.num_rows else 0
        if last:
            yield _edges(compare_tiles(rows.slice(0, last).combine_chunks(), rule))
        rest = rows.slice(last).combine_chunks()
    if rest is not None:
        yield _edges(compare_tiles(rest, rule))


def fine_bits(sets: list[np.ndarray]) -> np.ndarray:
    """A bitmap of one length for all the sets, of FINE_BITS for each shingle of a middling one."""
    size = max(64, 1 << int(FINE_BITS * np.median([len(s) for s in sets])).bit_length())
    out = np.zeros((len(sets), size // 8), np.uint8)
    for row, s in zip(out, sets, strict=True):
        bits = np.zeros(size, bool)
        bits[(s & np.uint64(size - 1)).astype(np.int64)] = True
        row[:] = np.packbits(bits, bitorder="little")
    return out.view("<u8")


def link_tile(classes: list[int], sets: list[np.ndarray], component: list[int], n_left: int | None, rule: Rule) -> list[tuple[int, int]]:
    """Confirmed links that connect what is linked in a tile: of all its rows, or between the first n_left and the rest.

    A pair is left out if links found before, or a common component, connect it already.
    """
    n = np.array([len(s) for s in sets])
    bits = fine_bits(sets)
    _, group = np.unique(component, return_inverse=True)
    found = []
    for i in range(1 if n_left is None else n_left, len(sets)):
        upto = i if n_left is None else n_left
        rows = np.flatnonzero(group[:upto] != group[i])
        need = rule.overlap(n[rows], n[i])
        good = need <= np.minimum(n[rows], n[i])
        rows, need = rows[good], need[good]
        most = np.minimum(n[i] - np.bitwise_count(bits[i] & ~bits[rows]).sum(axis=1, dtype=np.int64),
                          n[rows] - np.bitwise_count(bits[rows] & ~bits[i]).sum(axis=1, dtype=np.int64))
        good = most >= need
        rows, most = rows[good], most[good]
        for j in rows[np.argsort(-most, kind="stable")].tolist():
            if group[i] != group[j] and rule.linked(len(np.intersect1d(sets[i], sets[j], assume_unique=True)), int(n[i]), int(n[j])):
                found.append((classes[j], classes[i]))
                group[group == group[i]] = group[j]
    return found


def _link_rows(batches, rule):
    """Links of rows (block, i, j, side, class, component, shingles) sorted by (block, i, j, side, class)."""
    key, rows = None, []

    def flush():
        lefts = sum(1 for r in rows if r[0] == 0)
        n_left = None if lefts == len(rows) else lefts
        return link_tile([r[1] for r in rows], [np.frombuffer(r[3], np.uint64) for r in rows], [r[2] for r in rows], n_left, rule)

    for batch in batches:
        found = []
        for *tile, side, cls, component, shingles in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if tile != key:
                if len(rows) > 1:
                    found += flush()
                key, rows = tile, []
            rows.append((side, cls, component, shingles))
        if found:
            yield _edges(found)
    if len(rows) > 1:
        yield _edges(flush())


def _zip(batches):
    schema = pa.schema([("id", pa.int64()), ("text", pa.binary())])
    zipper = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        for at, texts in text_groups(batch.column(1)):
            yield record_batch(schema, [batch.column(0).slice(at, len(texts)), [zipper.compress(t) for t in texts]])


def _arrays(batches, rule):
    """Rows (block, class, shingles) from (block, class, digest, text): the text whose set has the digest."""
    unzip = zstandard.ZstdDecompressor()
    for batch in batches:
        for start in range(0, batch.num_rows, GROUP_ROWS):
            block, cls, digest, zipped = (c.slice(start, GROUP_ROWS).to_pylist() for c in batch.columns)
            texts = [unzip.decompress(t) for t in zipped]
            sets = [s.tobytes() for a, b in groups(texts) for s in shingle_sets(texts[a:b], rule.words)]
            # Rows that share a doc_id bring their texts too, and repeated rows the same one.
            own = {cls[k]: k for k, s in enumerate(sets) if xxhash.xxh3_128_digest(s) == digest[k]}.values()
            yield record_batch(ARRAYS, [[block[k] for k in own], [cls[k] for k in own], [sets[k] for k in own]])


def _tile_columns(rows: DataFrame, key: str, tile: int, rule: Rule) -> DataFrame:
    """Rows (key, class, component, n) of the groups with several components, as tiles.

    The rows outside a group's largest component are compared with all of it:
    they are dealt to right tiles (side 1), and everyone to left ones (side 0).
    A group of two whose sizes allow no link is left out.
    """
    p, q = rule.threshold.numerator, rule.threshold.denominator
    parts = rows.groupBy(key, "component").agg(
        F.count(F.lit(1)).alias("rows"), F.min("n").alias("least"), F.max("n").alias("most")).groupBy(key).agg(
        F.count(F.lit(1)).alias("parts"), F.sum("rows").alias("size"), F.max(F.struct("rows", "component")).alias("top"),
        F.min("least").alias("least"), F.max("most").alias("most"))
    mixed = parts.where("parts > 1").where((F.col("size") > 2) | (F.col("least") * q >= F.col("most") * p)).select(
        key, F.col("top.component").alias("largest"), F.ceil(F.col("size") / tile).cast("int").alias("lefts"),
        F.ceil((F.col("size") - F.col("top.rows")) / tile).cast("int").alias("rights"))
    rows = rows.join(mixed, key)
    of = lambda n: F.pmod(F.xxhash64("class"), F.col(n)).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.withColumn("i", of("lefts")).withColumn("j", upto("rights")).withColumn("side", F.lit(0))
    right = rows.where("component <> largest").withColumn("j", of("rights")).withColumn("i", upto("lefts")).withColumn("side", F.lit(1))
    columns = [key, "i", "j", "side", "n", "class", "component"]
    return left.select(columns).unionByName(right.select(columns))


def blocks(classes: DataFrame, members: DataFrame, rule: Rule, tile: int) -> DataFrame:
    """(class, block) of the classes that may be linked with another: links never leave a block."""
    n = shuffle_parts(classes.sparkSession)
    # Each node with the leader it meets in most groups.
    met = members.where("node <> leader").groupBy("node", "leader").agg(F.count(F.lit(1)).alias("n")).groupBy("node").agg(
        F.max(F.struct("n", "leader")).alias("best")).select("node", F.col("best.leader").alias("leader"))
    side = lambda s: classes.select(F.col("node").alias(f"node_{s}"), F.col("class").alias(s), F.col("n").alias(f"n_{s}"),
                                    F.col("bits").alias(f"bits_{s}"))
    led = met.join(side("a"), F.col("node") == F.col("node_a")).join(side("b"), F.col("leader") == F.col("node_b"))
    # Classes that share a node cannot be told apart among the members, so they are candidates too.
    twins = side("a").join(side("b"), (F.col("node_a") == F.col("node_b")) & (F.col("a") < F.col("b")))
    columns = ["a", "b", "n_a", "bits_a", "n_b", "bits_b"]
    first = led.select(columns).unionByName(twins.select(columns)).mapInArrow(lambda it: _filter_pairs(it, rule), PAIR_DDL)
    first = materialize(first, "candidates")
    rooted = components(first).select(F.col("node").alias("member"), "root")

    rows = members.select("shingle", "node").distinct().join(classes.select("node", "class", "n"), "node").join(
        rooted, F.col("class") == F.col("member"), "left").select("shingle", "class", "n", F.coalesce("root", "class").alias("component"))
    tiles = _tile_columns(materialize(rows, "members"), "shingle", tile, rule).join(classes.select("class", "bits"), "class")
    tiles = tiles.select("shingle", "i", "j", "side", "n", "component", "bits").repartition(n, "shingle", "i", "j").sortWithinPartitions(
        "shingle", "i", "j", "side", "n", "component")
    second = materialize(tiles.mapInArrow(lambda it: _compare(it, rule), PAIR_DDL), "candidates")
    return components(first.unionByName(second)).withColumnRenamed("node", "class").withColumnRenamed("root", "block")


def links_in_blocks(docs: DataFrame, classes: DataFrame, block: DataFrame, rule: Rule, tile: int) -> DataFrame:
    """Confirmed links (a, b) of classes that connect all that is linked within the blocks."""
    n = shuffle_parts(docs.sparkSession)
    wanted = materialize(block.join(classes.select("class", "n", "digest", "first_doc"), "class"), "inblocks")
    texts = docs.select("doc_id", "text").mapInArrow(_zip, "id bigint, text binary")
    # A merge join at every size: how many classes are in blocks is not bounded.
    arrays = texts.hint("merge").join(wanted, F.col("id").eqNullSafe(F.col("first_doc"))).select("block", "class", "digest", "text")
    arrays = materialize(arrays.mapInArrow(lambda it: _arrays(it, rule), ARRAYS_DDL), "arrays")

    def linked(rows):
        dealt = rows.select("block", "i", "j", "side", "class", "component", "shingles").repartition(n, "block", "i", "j")
        return materialize(dealt.sortWithinPartitions("block", "i", "j", "side", "class").mapInArrow(
            lambda it: _link_rows(it, rule), PAIR_DDL), "links")

    # First inside the tiles of a block, each class in one of them.
    sizes = wanted.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    within = arrays.join(sizes, "block").select(
        "block", F.pmod(F.xxhash64("class"), "tiles").cast("int").alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side"), "class",
        F.col("class").alias("component"), "shingles")
    links = linked(within)
    # Then between what is not yet connected in the blocks of several tiles.
    rooted = components(links).select(F.col("node").alias("member"), "root")
    large = wanted.join(sizes.where("tiles > 1"), "block").join(rooted, F.col("class") == F.col("member"), "left").select(
        "block", "class", "n", F.coalesce("root", "class").alias("component"))
    between = _tile_columns(large, "block", tile, rule).join(arrays.select("class", "shingles"), "class")
    return links.unionByName(linked(between))


def link(docs: DataFrame, rule: Rule = Rule(), tile: int = TILE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sets, classes, links): the set of each row, the classes of equal sets, and confirmed links (a, b) of classes.

    The links join all that is linked: they hold a chain between any two classes that links connect.
    """
    spark = docs.sparkSession
    n = shuffle_parts(spark)
    buckets = n * BUCKETS_PER_PART
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets = materialize(texts.mapInArrow(lambda it: _describe(it, rule), SETS_DDL), "sets")
    classes = sets.where("n > 0").groupBy("digest", "node", "n").agg(F.min("doc_id").alias("first_doc"), F.max("bits").alias("bits"))
    classes = materialize(classes.withColumn("class", F.monotonically_increasing_id()), "classes")

    frequent = frequent_shingles(texts, rule, sets.count())
    packed = texts.mapInArrow(lambda it: _pack(it, rule, frequent, buckets), PACKED_DDL)
    members = materialize(packed.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(
        lambda it: _share(it, buckets), MEMBERS_DDL), "members")
    return sets, classes, links_in_blocks(texts, classes, blocks(classes, members, rule, tile), rule, tile)


def near_duplicates(docs: DataFrame, rule: Rule = Rule(), tile: int = TILE) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text; other columns are not read).

    Documents link when their shingle sets have the similarity or more;
    component_id is the smallest doc_id that links reach. A null or wordless
    text has no shingles and links with nothing, not even another such.
    Repeated rows are one set and so linked; a null doc_id is not a smallest one,
    unless its component has no other. An empty table gives no rows.
    """
    sets, classes, links = link(docs, rule, tile)
    member = _members(classes, links)
    smallest = member.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    of_set = member.join(smallest, "root").select("digest", "component_id")
    held = sets.where("n > 0").join(of_set, "digest").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    none = sets.where("n = 0").select("doc_id", F.lit(0).cast("bigint").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return held.unionByName(none)


def _members(classes: DataFrame, links: DataFrame) -> DataFrame:
    """(digest, first_doc, root) of every class."""
    rooted = components(links).withColumnRenamed("node", "member")
    return classes.join(rooted, F.col("class") == F.col("member"), "left").select(
        "digest", "first_doc", F.coalesce("root", "class").alias("root"))


def drop_near_duplicates(docs: DataFrame, rule: Rule = Rule(), tile: int = TILE) -> DataFrame:
    """The rows of ``docs`` with all their columns, one for each component: that of its smallest doc_id.

    Rows without words all stay.
    """
    _, classes, links = link(docs, rule, tile)
    first = F.struct(F.col("first_doc").isNull(), "first_doc", "digest")
    kept = _members(classes, links).groupBy("root").agg(F.min(first).alias("kept")).select(
        F.col("kept.first_doc").alias("__kept_doc"), F.col("kept.digest").alias("__kept_digest"))
    wordless = F.coalesce("text", F.lit("")).rlike(r"\A[\x20\x09-\x0D]*\z")
    text = docs.columns.index("text")
    schema = StructType([*docs.schema.fields, StructField("__digest", BinaryType())])

    def digested(batches):
        for batch in batches:
            digests = [xxhash.xxh3_128_digest(s.tobytes()) for _, texts in text_groups(batch.column(text))
                       for s in shingle_sets(texts, rule.words)]
            yield batch.append_column("__digest", pa.array(digests, pa.binary()))
    rows = docs.where(~wordless).mapInArrow(digested, schema)
    same = (F.col("__digest") == F.col("__kept_digest")) & F.col("doc_id").eqNullSafe(F.col("__kept_doc"))
    one = rows.join(kept, same, "leftsemi").dropDuplicates(["doc_id", "__digest"]).drop("__digest")
    return one.unionByName(docs.where(wordless))
