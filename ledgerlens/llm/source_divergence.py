"""Source divergence audit by sorting word-start pointers.

A shard is some rows of text laid end to end in one Arrow buffer, in order of
their group (language and source). A pointer is the byte at which a term starts.
The pointers of a shard are put in the order of their terms by multikey quicksort
on "characters" of eight bytes: a slice of pointers that agree so far is split by
a pivot into smaller, equal and greater next characters, the equal ones go on with
the character after it; slices that have become small are finished by one stable
sort of all of them. Splits keep the order of pointers, so a run of equal terms
lists its places in the order of groups and rows.

First the shards are documents, and runs give occurrences and documents by group.
Their terms, joined by blanks and by group, go to shards of terms (by a hash), one
row for each: there the runs add up document frequency and source counts. A shard of terms
adds up what it holds whenever that has grown, so it is bounded by its different
terms; a frequent term comes once from each shard of documents and group.

Languages keep the terms that enough of their documents hold. Divergence between
sources is taken over all kept terms though only terms that occur are rows: with
p0 the value of a term that does not occur in a group, the sum over all terms is
V * f(p0, p0'), corrected by terms that occur in one of the two groups (by their
different values) and by terms that occur in both (in blocks of terms).

All arithmetic is exact: decimals where a product may pass 63 bits, else longs.

Edge cases: null text, lang and source are ''. Very long texts are a shard of
their own size; a very long term is compared to its end. Rows with one doc_id, or
none, are documents of their own. Ties rank by the item's UTF-8 bytes. A language
without kept terms has pairs of value 0. An empty table gives no rows. Other
columns are not read.
"""
from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, record_batch, shuffle_parts

#: Bytes and documents of text sorted together.
SHARD_BYTES, SHARD_DOCS = 8 << 20, 50_000
#: Entries that a shard of terms takes before it adds them up.
HELD_ENTRIES = 500_000
#: Slices up to this length are finished by a stable sort.
SMALL = 1 << 14
#: Bytes of a character of the quicksort.
WIDE = 8
MIN_DOCS, TOP_TERMS, SCALE, ADDED = 10, 10, 1_000_000_000, 2

#: Rows (term and source) of a block in which pairs of sources are compared, and terms times sources of a part of it.
BLOCK_ROWS, BLOCK_CELLS = 50_000, 1 << 20

SENT_DDL = "shard int, lang array<string>, source array<string>, terms binary, count array<bigint>, docs array<bigint>"
SENT = pa.schema([("shard", pa.int32()), ("lang", pa.list_(pa.string())), ("source", pa.list_(pa.string())), ("terms", pa.binary()),
                  ("count", pa.list_(pa.int64())), ("docs", pa.list_(pa.int64()))])
KEPT_DDL = "lang string, source string, term string, count bigint, lang_count bigint"
KEPT = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("count", pa.int64()), ("lang_count", pa.int64())])
BOTH_DDL = "lang string, source_a string, source_b string, value bigint"
BOTH = pa.schema([("lang", pa.string()), ("source_a", pa.string()), ("source_b", pa.string()), ("value", pa.int64())])

_TERM = np.zeros(256, bool)
_TERM[0x41:0x5B] = _TERM[0x61:0x7B] = _TERM[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def pointers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every term of the texts between ``offsets``."""
    inside = _TERM[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    starts[cuts] = inside[cuts]
    ends = np.zeros(len(data) + 1, bool)
    ends[1:] = inside
    ends[1:-1] &= ~inside[1:]
    ends[cuts] = inside[cuts - 1]
    return np.flatnonzero(starts), np.flatnonzero(ends)


class Characters:
    """The eight bytes at a depth of a term, zeros after its end (no term holds a zero byte)."""

    def __init__(self, data: np.ndarray):
        self.padded = np.concatenate([data, np.zeros(WIDE, np.uint8)])
        self.view = np.ndarray((len(data) + 1,), ">u8", self.padded.data, 0, (1,))

    def at(self, starts: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
        place = np.minimum(starts + WIDE * depth, ends)
        left = np.minimum(ends - place, WIDE)
        cut = (WIDE * 8 - 8 * left).astype(np.uint64)
        raw = self.view[place].astype(np.uint64)
        return np.where(left > 0, raw >> cut % np.uint64(64) << cut % np.uint64(64), np.uint64(0))


def split(chars: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """``rows`` in slices of smaller, equal and greater characters than a pivot, each in their order."""
    sample = np.sort(chars[rows[::max(1, len(rows) // 31)]])
    pivot = sample[len(sample) // 2]
    own = chars[rows]
    return [rows[own < pivot], rows[own == pivot], rows[own > pivot]]


def sorted_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, small: int = SMALL) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pointers in the order of their terms, and where the runs of equal terms start."""
    characters = Characters(data)
    order, chars = np.arange(len(starts)), np.zeros(len(starts), np.uint64)
    slices, depth = [(0, len(starts))] if len(starts) else [], 0
    run_starts = np.zeros(len(starts) + 1, bool)
    run_starts[0] = True
    while slices:
        at = np.concatenate([np.arange(a, b) for a, b in slices])
        chars[order[at]] = characters.at(starts[order[at]], ends[order[at]], depth)
        finish, deeper = [], []
        stack = slices[::-1]
        while stack:
            a, b = stack.pop()
            if b - a <= small:
                finish.append((a, b))
                continue
            pieces = split(chars, order[a:b])
            order[a:b] = np.concatenate(pieces)
            less, same = a + len(pieces[0]), a + len(pieces[0]) + len(pieces[1])
            run_starts[[a, less, same]] = True
            stack += [(x, y) for x, y in ((same, b), (a, less)) if y > x]
            if chars[order[less]] & np.uint64(0xFF):
                deeper.append((less, same))
        if finish:
            at = np.concatenate([np.arange(a, b) for a, b in finish])
            of = np.repeat(np.arange(len(finish)), [b - a for a, b in finish])
            rows = order[at]
            by = np.lexsort((chars[rows], of))  # within each slice, so ``of`` stays as it is
            order[at] = rows[by]
            own = chars[rows[by]]
            first = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (of[1:] != of[:-1])]))
            run_starts[at[first]] = True
            sizes = np.diff(np.append(first, len(own)))
            more = (sizes > 1) & ((own[first] & np.uint64(0xFF)) != 0)
            deeper += zip(at[first][more].tolist(), (at[first] + sizes)[more].tolist(), strict=True)
        slices, depth = deeper, depth + 1
    return order, np.flatnonzero(run_starts[:len(starts)])


@dataclass
class Runs:
    """The sorted pointers of a shard, in sub-runs of one term and group."""
    groups: list[tuple[str, str]]
    by: np.ndarray
    order: np.ndarray
    row: np.ndarray
    first: np.ndarray
    term: np.ndarray
    group: np.ndarray
    terms: list[bytes]

    def added(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value of each sorted pointer by sub-run."""
        return np.add.reduceat(values, self.first) if len(self.first) else values[:0]


def runs_of(lang: list[str], source: list[str], texts: pa.Array) -> Runs:
    """Terms of rows of text: ``by`` is the order of groups in which the rows are laid, ``order`` the
    sorted pointers, ``row`` each one's row as laid, ``first``, ``term`` and ``group`` describe sub-runs."""
    keys = list(zip(lang, source, strict=True))
    groups = sorted(set(keys))
    number = {g: i for i, g in enumerate(groups)}
    group = np.array([number[k] for k in keys], np.int64)
    by = np.argsort(group, kind="stable")
    laid = texts.cast(pa.large_binary()).take(pa.array(by))
    offsets = np.frombuffer(laid.buffers()[1], np.int64)[:len(laid) + 1]
    data = _LOWER[np.frombuffer(laid.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]]
    offsets = offsets - offsets[0]
    starts, ends = pointers(data, offsets)
    order, runs = sorted_runs(data, starts, ends)
    row = np.searchsorted(offsets, starts, "right")[order] - 1
    of, run = group[by][row], np.zeros(len(order), bool)
    run[runs] = True
    cut = run.copy()
    cut[1:] |= of[1:] != of[:-1]
    first = np.flatnonzero(cut)
    raw = data.tobytes()
    terms = [raw[a:b] for a, b in zip(starts[order[runs]].tolist(), ends[order[runs]].tolist(), strict=True)]
    return Runs(groups, by, order, row, first, (np.cumsum(run) - 1)[first], of[first], terms)


def listed(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values, pa.int64()))


def rows_by_shard(found: Runs, count: np.ndarray, docs: np.ndarray, shards: int) -> pa.RecordBatch:
    """One row for each shard of terms: groups on lines, their terms joined by blanks."""
    if not len(found.term):
        return record_batch(SENT, [[] for _ in SENT])
    shard_of = np.array([zlib.crc32(t) % shards for t in found.terms], np.int64)
    n = len(found.groups)
    key = shard_of[found.term] * n + found.group
    order = np.argsort(key, kind="stable")
    key = key[order]
    cuts = np.flatnonzero(np.diff(key, prepend=-1, append=-2))
    heads = key[cuts[:-1]]
    terms, bounds = list(map(found.terms.__getitem__, found.term[order].tolist())), cuts.tolist()
    lines = [b" ".join(terms[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
    names = [found.groups[g] for g in (heads % n).tolist()]
    rows = np.flatnonzero(np.diff(heads // n, prepend=-1, append=-2))
    spans = list(zip(rows.tolist(), rows[1:].tolist(), strict=False))
    return record_batch(SENT, [(heads // n)[rows[:-1]], *([[x[k] for x in names[a:b]] for a, b in spans] for k in (0, 1)),
                               [b"\n".join(lines[a:b]) for a, b in spans], listed(count[order], cuts[rows]), listed(docs[order], cuts[rows])])


def shard_counts(lang: list[str], source: list[str], texts: pa.Array, shards: int = 1) -> pa.RecordBatch:
    """Occurrences and documents of every term of some documents, by group and shard of terms."""
    found = runs_of(lang, source, texts)
    new = np.ones(len(found.row), bool)
    new[1:] = found.row[1:] != found.row[:-1]
    new[found.first] = True
    return rows_by_shard(found, np.diff(np.append(found.first, len(found.order))), found.added(new.astype(np.int64)), shards)


def sent_counts(docs: DataFrame, shards: int, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Counts of all shards of documents (null lang, source and text are '')."""
    def count(batches):
        held, size, n = [], 0, 0

        def run():
            whole = pa.Table.from_batches(held)
            lang, source = (whole.column(c).to_pylist() for c in (0, 1))
            return shard_counts(lang, source, pa.concat_arrays(whole.column(2).chunks), shards)

        for batch in batches:
            start = 0
            for i, width in enumerate(pc.binary_length(batch.column(2)).to_pylist()):
                size, n = size + width, n + 1
                if size >= shard_bytes or n >= SHARD_DOCS:
                    held.append(batch.slice(start, i + 1 - start))
                    yield run()
                    held, size, n, start = [], 0, 0, i + 1
            if start < batch.num_rows:
                held.append(batch.slice(start))
        if held:
            yield run()

    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return rows.mapInArrow(count, SENT_DDL)


def summed(rows: list[pa.RecordBatch]) -> tuple[Runs, np.ndarray, np.ndarray]:
    """Runs over the terms of rows of counts, and both sums of every sub-run."""
    whole = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
    lines = [line for row in whole.column("terms").to_pylist() for line in row.split(b"\n")]
    found = runs_of(*(whole.column(c).flatten().to_pylist() for c in ("lang", "source")), pa.array(lines, pa.binary()))
    cuts = np.cumsum([0, *(line.count(b" ") + 1 for line in lines)])
    laid = (listed(whole.column(c).flatten().to_numpy(), cuts).take(pa.array(found.by)).flatten().to_numpy()[found.order]
            for c in ("count", "docs"))
    count, docs = (found.added(x) for x in laid)
    return found, count, docs


def kept_of_shard(rows: list[pa.RecordBatch], min_docs: int) -> pa.RecordBatch:
    """Terms that enough documents of a language hold, with their counts by source."""
    found, count, docs = summed(rows)
    langs = sorted({g[0] for g in found.groups})
    lang = np.array([langs.index(g[0]) for g in found.groups], np.int64)[found.group]
    cut = np.ones(len(lang), bool)
    cut[1:] = (lang[1:] != lang[:-1]) | (found.term[1:] != found.term[:-1])
    first = np.flatnonzero(cut)
    sizes = np.diff(np.append(first, len(lang)))
    held, total = (np.repeat(np.add.reduceat(x, first), sizes) for x in (docs, count))
    keep = np.flatnonzero(held >= min_docs)
    names = [found.groups[g] for g in found.group[keep].tolist()]
    return record_batch(KEPT, [[n[0] for n in names], [n[1] for n in names], [found.terms[t].decode() for t in found.term[keep].tolist()],
                               count[keep], total[keep]])


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, source, term, count (in the group) and lang_count of terms that ``min_docs`` documents of the language hold; written."""
    shards = shuffle_parts(docs.sparkSession)

    def add_up(batches):
        rows, of, held, least = [], None, 0, HELD_ENTRIES
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            cuts = np.flatnonzero(np.diff(shard)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(shard)], strict=True):
                if a == b:
                    continue
                if shard[a] != of:
                    if rows:
                        yield kept_of_shard(rows, min_docs)
                    rows, of, held, least = [], shard[a], 0, HELD_ENTRIES
                part = batch.slice(a, b - a)
                rows.append(part)
                held += len(part.column("count").flatten())
                if held >= least:  # sums take the place of rows; twice as many come before the next time
                    rows = [rows_by_shard(*summed(rows), 1)]
                    held = len(rows[0].column("count").flatten())
                    least = max(HELD_ENTRIES, 2 * held)
        if rows:
            yield kept_of_shard(rows, min_docs)

    sent = sent_counts(docs, shards).repartition(shards, "shard").sortWithinPartitions("shard")
    return materialize(sent.mapInArrow(add_up, KEPT_DDL), "divergence-terms")


def share(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (n + 2 v)); null where the language has no kept term."""
    top = (count + ADDED).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = (n + ADDED * v).cast("decimal(20,0)")
    return 1 + F.call_function("div", top, F.when(below > 0, below))


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def group_totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, n, v, lang_n and p0 (the share of a term that does not occur) of every group."""
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    n = kept.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    of_lang = kept.select("lang", "term", "lang_count").distinct().groupBy("lang").agg(
        F.count(F.lit(1)).alias("v"), F.sum("lang_count").alias("lang_n"))
    rows = groups.join(n, ["lang", "source"], "left").join(of_lang, "lang", "left").fillna(0, ["n", "v", "lang_n"])
    return materialize(rows.withColumn("p0", share(F.lit(0).cast("bigint"), F.col("n"), F.col("v"))), "divergence-groups")


def renamed(df: DataFrame, mark: str, *but: str) -> DataFrame:
    return df.select(*[F.col(c) if c in but else F.col(c).alias(f"{c}_{mark}") for c in df.columns])


def f_of(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def block_pairs(lang: str, terms: np.ndarray, source: list[str], p: np.ndarray, p0: np.ndarray):
    """What terms that two sources both have add to the value of the pair, for a block of terms of a language."""
    names, place = np.unique(np.array(source, object), return_inverse=True)
    n_terms = int(terms[-1]) - int(terms[0]) + 1
    if n_terms > 1 and n_terms * len(names) > BLOCK_CELLS:
        cut = int(np.searchsorted(terms, terms[0] + n_terms // 2))
        yield from block_pairs(lang, terms[:cut], source[:cut], p[:cut], p0[:cut])
        yield from block_pairs(lang, terms[cut:], source[cut:], p[cut:], p0[cut:])
        return
    terms = terms - terms[0]
    shares = np.zeros((n_terms, len(names)), np.int64)
    shares[terms, place] = p
    none = np.zeros(len(names), np.int64)
    none[place] = p0
    here = shares > 0
    for i in range(len(names) - 1):
        rows = np.flatnonzero(here[:, i])
        own, other = shares[rows, i][:, None], shares[rows, i + 1:]
        zero, zeros = none[i], none[i + 1:]
        value = np.where(other > 0, f_of(own, np.maximum(other, 1)) - f_of(own, zeros) - f_of(zero, np.maximum(other, 1)) + f_of(zero, zeros), 0)
        n = len(names) - 1 - i
        yield record_batch(BOTH, [[lang] * n, [names[i]] * n, names[i + 1:], value.sum(axis=0)])


def shared_terms(shares: DataFrame) -> DataFrame:
    """lang, source_a < source_b and what the terms of both add, in parts."""
    def compare(batches):
        held, cells = [], 0

        def blocks():
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            lang = whole.column("lang").to_pylist()
            term = whole.column("term").dictionary_encode().indices.to_numpy()
            cuts = [0, *(i for i in range(1, len(lang)) if lang[i] != lang[i - 1]), len(lang)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                part = whole.slice(a, b - a)
                numbers = np.cumsum(np.diff(term[a:b], prepend=term[a]) != 0)
                yield from block_pairs(lang[a], numbers, part.column("source").to_pylist(), part.column("p").to_numpy(),
                                       part.column("p0").to_numpy())

        for batch in batches:
            # Blocks end between terms.
            lang, term = (batch.column(c).to_pylist() for c in ("lang", "term"))
            start = 0
            for i, key in enumerate(zip(lang, term, strict=True)):
                if cells >= BLOCK_ROWS and key != last:
                    if i > start:
                        held.append(batch.slice(start, i - start))
                    yield from blocks()
                    held, cells, start = [], 0, i
                cells, last = cells + 1, key
            if start < batch.num_rows:
                held.append(batch.slice(start))
        if held:
            yield from blocks()

    rows = shares.select("lang", "term", "source", "p", "p0")
    ordered = rows.repartition(shuffle_parts(shares.sparkSession), "lang", "term").sortWithinPartitions("lang", "term", "source")
    return ordered.mapInArrow(compare, BOTH_DDL)


def pair_values(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item and value of every two sources of a language, in both orders."""
    a, b = renamed(groups.select("lang", "source", "p0", "v"), "a", "lang", "v"), renamed(groups.select("lang", "source", "p0"), "b", "lang")
    pairs = a.join(b, "lang").where(F.col("source_a") < F.col("source_b"))
    p, q, p0, q0 = (F.col(c) for c in ("p_a", "p_b", "p0_a", "p0_b"))
    none = pairs.select("lang", "source_a", "source_b", F.coalesce(F.col("v") * divergence(p0, q0), F.lit(0)).alias("value"))
    # Terms that occur in one group, by their different shares.
    values = shares.groupBy("lang", "source", "p0", "p").agg(F.count(F.lit(1)).alias("times"))
    one = renamed(values, "a", "lang").join(b, "lang").where(F.col("source_a") != F.col("source_b")).select(
        "lang", F.least("source_a", "source_b").alias("source_a"), F.greatest("source_a", "source_b").alias("source_b"),
        (F.col("times_a") * (divergence(p, q0) - divergence(p0, q0))).alias("value"))
    both = shared_terms(shares)
    each = [x.groupBy("lang", "source_a", "source_b").agg(F.sum("value").alias("value")) for x in (one, both)]
    total = none.unionByName(each[0]).unionByName(each[1]).groupBy("lang", "source_a", "source_b").agg(F.sum("value").alias("value"))
    ways = F.explode(F.array(*[F.struct(F.col(x).alias("source"), F.col(y).alias("item")) for x, y in (
        ("source_a", "source_b"), ("source_b", "source_a"))]))
    return total.select("lang", ways.alias("way"), "value").select("lang", "way.source", "way.item", "value")


def ranked(df: DataFrame, part: str) -> DataFrame:
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return df.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("bigint").alias("value"),
                     F.row_number().over(by).alias("rank"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: part ``pair`` compares a source with the others of its language,
    part ``term`` lists the terms that set it most apart from the language."""
    kept = kept_terms(docs, min_docs)
    groups = group_totals(docs, kept)
    shares = kept.join(groups.select("lang", "source", "n", "v", "lang_n", "p0"), ["lang", "source"]).select(
        "lang", "source", "term", "p0", share(F.col("count"), F.col("n"), F.col("v")).alias("p"),
        share(F.col("lang_count"), F.col("lang_n"), F.col("v")).alias("q"))
    pairs = ranked(pair_values(shares, groups), "pair")
    terms = shares.where(F.col("p") > F.col("q")).select(
        "lang", "source", F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
    return pairs.unionByName(ranked(terms, "term").where(F.col("rank") <= top_terms))
