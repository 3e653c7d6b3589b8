"""Language-model scores by deleted interpolation.

A trigram model learned from the training documents: the probability of a word
is a mixture of the maximum-likelihood estimates of order 3, 2 and 1 and of a
uniform one over the words and one unseen word. The mixture weights depend on a
bucket, the longest context seen and the binary logarithm of its frequency. They
are learned on deleted documents (a part of the training documents): counts are
taken from the other training documents, and expectation-maximisation finds the
weights of each bucket under which the deleted documents are most likely. The
final model counts all training documents.

On Spark: documents are cut into blocks of tokens, each of documents of one part
(kept, deleted or not trained on), and written once as word numbers. A block sends
its different words, and its different pairs of words each with the words before it,
with their counts, packed and sorted by hash, to shards of ranges of hashes; a shard
adds them up and answers every block, in the same order. The number of shards
follows the number of tokens, so a shard is bounded; a frequent n-gram comes once
from each block. The deleted blocks then
give the events of expectation-maximisation, added up by Spark in cells of nearly
equal estimates, a bounded number per bucket; each bucket is solved in a task of
its own. With the weights (a few rows) every block scores its documents.

Words and pairs are told apart by 64-bit hashes, the words before a pair by 32 bits.

Edge cases: a null or empty text has the end token alone. Very long texts are one
row and stay whole, in a block of their own size. A null doc_id counts as the empty
text in the choice of documents to train on. Rows with one doc_id stay rows of
their own. Without training documents every word is unseen. An empty table gives
no rows. Other columns are not read.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget_shuffles, materialize, partition_id, parts, record_batch, shuffle_parts
from .wordhash import mix, text_groups, word_hashes

ORDERS = (1, 2, 3)
#: Tokens and documents in a block, and different n-grams of blocks in a shard.
BLOCK_TOKENS, SHARD_ENTRIES = 1_000_000, 1_000_000
#: Blocks of one partition are numbered below this bit.
BLOCK_BITS = 24
KEPT, DELETED, UNTRAINED = 0, 1, 2
#: Documents are dealt by crc32(doc_id) mod FOLDS: one fold is held out, another one deleted.
FOLDS, HELD_OUT_FOLD, DELETED_FOLD = 5, 1, 4
#: Cells of expectation-maximisation: steps per factor of two of an estimate.
CELL_STEPS = 4
STEPS, TOLERANCE = 200, 1e-7

_rng = np.random.default_rng(20251)
_PAIR, START, END = (np.uint64(int(x) | 1) for x in _rng.integers(1 << 60, 1 << 63, 3, dtype=np.uint64))

BLOCKS_DDL = "block bigint, part int, doc_ids array<bigint>, sizes array<bigint>, words binary, stream binary, tokens bigint"
BLOCKS = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
                    ("words", pa.binary()), ("stream", pa.binary()), ("tokens", pa.int64())])
CHUNKS_DDL = "shard bigint, ngram int, block bigint, part int, first bigint, steps binary, sizes binary, earlier binary, times binary"
CHUNKS = pa.schema([("shard", pa.int64()), ("ngram", pa.int32()), ("block", pa.int64()), ("part", pa.int32()), ("first", pa.int64()),
                    *((c, pa.binary()) for c in ("steps", "sizes", "earlier", "times"))])
ANSWERS_DDL = "block bigint, ngram int, shard bigint, trained binary, kept binary, n bigint, v bigint, n_kept bigint, v_kept bigint"
ANSWERS = pa.schema([("block", pa.int64()), ("ngram", pa.int32()), ("shard", pa.int64()), ("trained", pa.binary()), ("kept", pa.binary()),
                     *((c, pa.int64()) for c in ("n", "v", "n_kept", "v_kept"))])
CELLS_DDL = "level int, bucket int, cell bigint, n bigint, f3 double, f2 double, f1 double"
CELLS = pa.schema([("level", pa.int32()), ("bucket", pa.int32()), ("cell", pa.int64()), ("n", pa.int64()),
                   *((c, pa.float64()) for c in ("f3", "f2", "f1"))])
SCORES_DDL = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, "
              "score double")
SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), *((c, pa.int64()) for c in ("n_tokens", "n_known", "train_tokens")),
                    ("base_score", pa.float64()), ("score", pa.float64())])


# --- packing --------------------------------------------------------------

def planes(numbers: np.ndarray) -> bytes:
    """Numbers from 0 as planes of their bytes, lowest first, as many as the largest needs: high ones compress to little."""
    if not len(numbers):
        return b""
    width = max(1, -(-int(numbers.max()).bit_length() // 8))
    return bytes([width]) + numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def from_planes(data) -> np.ndarray:
    if not len(data):
        return np.zeros(0, np.int64)
    raw = np.frombuffer(data, np.uint8)
    rows = raw[1:].reshape(int(raw[0]), -1)
    out = np.zeros((rows.shape[1], 8), np.uint8)
    out[:, :len(rows)] = rows.T
    return out.view("<i8").ravel()


# --- blocks ---------------------------------------------------------------

class Block:
    def __init__(self, part: int):
        self.part, self.docs, self.sizes, self.words, self.held = part, [], [], [], 0

    def add(self, doc_id, hashes: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.sizes.append(len(hashes) + 1)
        self.words += [_OPENING, hashes, _CLOSING]
        self.held += len(hashes) + 1

    def row(self, number: int) -> pa.RecordBatch:
        words, place, times = np.unique(np.concatenate(self.words), return_inverse=True, return_counts=True)
        order = np.argsort(-times, kind="stable")  # frequent words first: small numbers pack well
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        return record_batch(BLOCKS, [[number], [self.part], [self.docs], [self.sizes], [words[order].tobytes()], [planes(rank[place])],
                                     [self.held]])


_OPENING, _CLOSING = np.array([START, START]), np.array([END])


def token_blocks(docs: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Documents in blocks of one part each, words lower-cased (A-Z) and numbered within the block."""
    def cut(batches):
        number = partition_id() << BLOCK_BITS
        blocks = {p: Block(p) for p in (KEPT, DELETED, UNTRAINED)}
        for batch in batches:
            ids, part = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for row, texts in text_groups(batch.column(2)):
                hashes, _, bounds = word_hashes([t.lower() for t in texts])
                for i, (a, b) in enumerate(zip(bounds.tolist(), bounds[1:].tolist(), strict=False), row):
                    block = blocks[part[i]]
                    block.add(ids[i], hashes[a:b].copy())
                    if block.held >= block_tokens:
                        yield block.row(number)
                        number += 1
                        blocks[part[i]] = Block(part[i])
        for block in blocks.values():
            if block.docs:
                yield block.row(number)
                number += 1

    doc_id = F.col("doc_id").cast("bigint")
    fold = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS
    part = F.when(fold == HELD_OUT_FOLD, UNTRAINED).when(fold == DELETED_FOLD, DELETED).otherwise(KEPT)
    rows = docs.select(doc_id.alias("doc_id"), part.cast("int").alias("part"), F.col("text").cast("string").alias("text"))
    return materialize(rows.mapInArrow(cut, BLOCKS_DDL), "lm-blocks", "zstd")


@dataclass
class Grams:
    """The different words, pairs and triples of a block, sorted, and which of them ends at each place.

    Places are, for each document, one start sign and its tokens; the start signs
    count as contexts. Triples are sorted by pair: ``pair`` is the rank of a
    triple's last two words, ``earlier`` the word before them.
    """
    words: np.ndarray
    pairs: np.ndarray
    pair: np.ndarray
    earlier: np.ndarray
    at: dict[int, np.ndarray]
    token: np.ndarray
    times: dict[int, np.ndarray]


def ngrams(words: bytes, stream: bytes, sizes: np.ndarray) -> Grams:
    seq = np.frombuffer(words, np.uint64)[from_planes(stream)]
    firsts = np.cumsum(sizes + 2) - (sizes + 2)
    inside = np.ones(len(seq), bool)
    inside[firsts] = False
    token = inside.copy()
    token[firsts + 1] = False
    earlier = np.concatenate([[START], seq[:-2]])  # before a document's first place: a start sign, too
    earlier[firsts] = START
    one, at_one, times = np.unique(seq[inside], return_inverse=True, return_counts=True)
    two, at_two = np.unique(mix(seq[:-1] * _PAIR + seq[1:])[inside[1:]], return_inverse=True)
    three, at_three, triples = np.unique(at_two.astype(np.uint64) << np.uint64(32) | earlier[inside[1:]] >> np.uint64(32),
                                         return_inverse=True, return_counts=True)
    return Grams(one, two, (three >> np.uint64(32)).astype(np.int64), three.astype(np.uint32), {1: at_one, 2: at_two, 3: at_three},
                 token[inside], {1: times, 3: triples})


def blocks_of(batch: pa.RecordBatch):
    """block, part, doc_ids, sizes and n-grams of each block row."""
    for i in range(batch.num_rows):
        block, part, ids, sizes = (batch.column(c)[i] for c in ("block", "part", "doc_ids", "sizes"))
        sizes = sizes.values.to_numpy()
        grams = ngrams(batch.column("words")[i].as_buffer(), batch.column("stream")[i].as_buffer(), sizes)
        yield block.as_py(), part.as_py(), ids.values, sizes, grams


# --- counting -------------------------------------------------------------

def packed(keys: np.ndarray) -> tuple[int, bytes]:
    """First key (signed) and the steps between the sorted keys."""
    return int(keys[:1].view(np.int64)[0]), planes(np.diff(keys))


def unpacked(first: int, steps) -> np.ndarray:
    return np.cumsum(np.concatenate([np.array([first], np.int64), from_planes(steps)]).view(np.uint64), dtype=np.uint64)


def pieces_of(grams: Grams, shards: int):
    """Order, shard, first key, steps, sizes, earlier words and times of every part for a shard of words and pairs."""
    for order, keys in ((1, grams.words), (2, grams.pairs)):
        shard = ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(shard, prepend=-1, append=shards))
        times = grams.times[1] if order == 1 else grams.times[3]
        ends = cuts if order == 1 else np.searchsorted(grams.pair, cuts)
        sizes = None if order == 1 else np.bincount(grams.pair, minlength=len(keys))
        for a, b, x, y in zip(cuts.tolist(), cuts[1:].tolist(), ends.tolist(), ends[1:].tolist(), strict=False):
            yield (order, int(shard[a]), *packed(keys[a:b]), None if sizes is None else planes(sizes[a:b]),
                   None if sizes is None else grams.earlier[x:y].astype("<u4").tobytes(), planes(times[x:y]))


def chunks(blocks: DataFrame, shards: int) -> DataFrame:
    """The different n-grams of every block, one row for each block, range of hashes, and words or pairs."""
    def send(batches):
        for batch in batches:
            for block, part, _, _, grams in blocks_of(batch):
                order, shard, *rest = zip(*pieces_of(grams, shards), strict=True)
                yield record_batch(CHUNKS, [shard, order, [block] * len(shard), [part] * len(shard), *rest])

    return blocks.mapInArrow(send, CHUNKS_DDL)


def answer(rows: list[dict], order: int, sizes: list[int], place: np.ndarray, trained: np.ndarray, kept: np.ndarray) -> pa.RecordBatch:
    """Counts of the n-grams of each row; those of kept documents alone for the deleted blocks."""
    at = np.concatenate([[0], np.cumsum(sizes)]).tolist()
    spans, n = list(zip(at, at[1:], strict=False)), len(rows)
    return record_batch(ANSWERS, [
        [r["block"] for r in rows], [order] * n, [r["shard"] for r in rows], [planes(trained[place[a:b]]) for a, b in spans],
        [planes(kept[place[a:b]]) if r["part"] == DELETED else None for r, (a, b) in zip(rows, spans, strict=True)],
        *(pa.nulls(n, pa.int64()) for _ in range(4))])


def answered(rows: list[dict]):
    """Counts of the words, or of the pairs and triples, of one shard for every block that sent some."""
    keys = [unpacked(r["first"], r["steps"]) for r in rows]
    every, place = np.unique(np.concatenate(keys), return_inverse=True)
    times = [from_planes(r["times"]) for r in rows]
    part = np.repeat(np.array([r["part"] for r in rows], np.int8), [len(t) for t in times])
    times_of = np.concatenate(times)

    def by_part(at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        # A block holds at most its own number of tokens of an n-gram, so a double adds them exactly.
        kept, deleted = (np.bincount(at[part == p], times_of[part == p], n).astype(np.int64) for p in (KEPT, DELETED))
        return kept + deleted, kept

    if rows[0]["ngram"] == 1:
        trained, kept = by_part(place, len(every))
        yield answer(rows, 1, [len(k) for k in keys], place, trained, kept)
        word = every != START
        totals = [int(x) for c in (trained[word], kept[word]) for x in (c.sum(), np.count_nonzero(c))]
        yield record_batch(ANSWERS, [[None], [1], [rows[0]["shard"]], [None], [None], *([x] for x in totals)])
        return
    pair = np.repeat(place, np.concatenate([from_planes(r["sizes"]) for r in rows]))
    earlier = np.concatenate([np.frombuffer(r["earlier"], "<u4") for r in rows])
    triples, at = np.unique(pair.astype(np.uint64) << np.uint64(32) | earlier, return_inverse=True)
    yield answer(rows, 3, [len(t) for t in times], at, *by_part(at, len(triples)))
    yield answer(rows, 2, [len(k) for k in keys], place, *by_part(pair, len(every)))


def counted(sent: DataFrame, shards: int) -> DataFrame:
    """Answers for every block, and rows without a block that count words and tokens of each shard."""
    def count(batches):
        rows, of = [], None
        for batch in batches:
            for row in (r for part in parts(iter([batch]), 100) for r in part.to_pylist()):
                if (row["shard"], row["ngram"]) != of:
                    if rows:
                        yield from answered(rows)
                    rows, of = [], (row["shard"], row["ngram"])
                rows.append(row)
        if rows:
            yield from answered(rows)

    n = min(shards, shuffle_parts(sent.sparkSession))
    by_shard = sent.repartition(n, "shard").sortWithinPartitions("shard", "ngram")
    return materialize(by_shard.mapInArrow(count, ANSWERS_DDL), "lm-counts", "zstd")


# --- the mixture ----------------------------------------------------------

def estimates(counts: dict[int, np.ndarray], token: np.ndarray, n: int, v: int):
    """level (longest context seen), bucket and estimates of order 3, 2 and 1 of every token; the count of its word.

    ``counts`` holds those of the n-grams that end at each place.
    """
    places = np.flatnonzero(token)
    one, two = counts[1], counts[2]
    before, pair_before = one[places - 1], two[places - 1]
    level = np.where(pair_before > 0, 3, np.where(before > 0, 2, 1 if n else 0))
    bucket = np.zeros(len(places), np.int64)
    bucket[level == 3] = np.log2(pair_before[level == 3]).astype(np.int64)
    bucket[level == 2] = np.log2(before[level == 2]).astype(np.int64)
    f3 = counts[3][places] / np.maximum(pair_before, 1)
    f2 = two[places] / np.maximum(before, 1)
    known = one[places]
    return level, bucket, f3, f2, known / max(n, 1), known


def cell_codes(*estimates_of: np.ndarray) -> np.ndarray:
    """One number for the estimates' places on a logarithmic scale."""
    out = np.zeros(len(estimates_of[0]), np.int64)
    for f in estimates_of:
        step = np.zeros(len(f), np.int64)
        some = f > 0
        step[some] = 1 + np.floor(-CELL_STEPS * np.log2(f[some])).astype(np.int64)
        out = out * (1 << 12) + step
    return out


def solve(n: np.ndarray, estimates_of: np.ndarray) -> np.ndarray:
    """Weights (sum 1) under which the events, ``n`` of each row of estimates, are most likely.

    One event more is spread evenly over the estimates, so no weight is 0.
    """
    k = estimates_of.shape[1]
    weights = np.full(k, 1 / k)
    for _ in range(STEPS):
        share = estimates_of * weights
        total = share.sum(axis=1, keepdims=True)
        mass = (n[:, None] * np.divide(share, total, out=np.zeros_like(share), where=total > 0)).sum(axis=0) + 1 / k
        new = mass / mass.sum()
        done = np.abs(new - weights).max() < TOLERANCE
        weights = new
        if done:
            break
    return weights


def mixture(cells: DataFrame, v_kept: int) -> dict[tuple[int, int], list[float]]:
    """Weights of the estimates of order 3, 2, 1 and 0 by level and bucket (a bounded number of each)."""
    uniform = 1 / (v_kept + 1)

    def bucket_weights(key: tuple, cell: pd.DataFrame) -> pd.DataFrame:
        level, bucket = key
        n = cell["n"].to_numpy(float)
        f = np.column_stack([*(cell[c] / n for c in ("f3", "f2", "f1")[3 - level:]), np.full(len(cell), uniform)])
        weights = [0.0] * (3 - level) + solve(n, f).tolist()
        return pd.DataFrame({"level": [level], "bucket": [bucket], "weights": [weights]})

    summed = cells.groupBy("level", "bucket", "cell").agg(*[F.sum(c).alias(c) for c in ("n", "f3", "f2", "f1")])
    solved = summed.groupBy("level", "bucket").applyInPandas(bucket_weights, "level int, bucket int, weights array<double>")
    return {(r.level, r.bucket): list(r.weights) for r in solved.collect()}


def weight_table(weights: dict[tuple[int, int], list[float]]) -> np.ndarray:
    """Weights at [level, bucket]; a bucket without events has those of the nearest one below it, else above it."""
    table = np.zeros((4, 64, 4))
    table[0, :, 3] = 1.0
    for level in (1, 2, 3):
        table[level, :, 3 - level:] = 1 / (level + 1)
        seen = sorted(b for at, b in weights if at == level)
        for b in range(64 if seen else 0):
            table[level, b] = weights[level, max((x for x in seen if x <= b), default=seen[0])]
    return table


# --- passes over the blocks -------------------------------------------------

def blocks_with_counts(batches, column: str):
    """Every block with its counts by order; its answers come before it."""
    answers: dict[int, list[np.ndarray]] = {o: [] for o in ORDERS}
    for batch in batches:
        is_block = batch.column("stream").is_valid().to_numpy(zero_copy_only=False)
        for i in range(batch.num_rows):
            if not is_block[i]:
                answers[batch.column("ngram")[i].as_py()].append(from_planes(batch.column(column)[i].as_buffer()))
                continue
            (_, part, ids, sizes, grams), = blocks_of(batch.slice(i, 1))
            counts = {o: np.concatenate(answers[o])[grams.at[o]] for o in ORDERS}
            answers = {o: [] for o in ORDERS}
            yield part, ids, sizes, counts, grams.token


def with_answers(blocks: DataFrame, answers: DataFrame, column: str) -> DataFrame:
    """Blocks and their answers in a stream sorted by block."""
    given = answers.where(F.col(column).isNotNull()).select("block", "ngram", "shard", column)
    stream = given.unionByName(blocks.drop("tokens"), allowMissingColumns=True)
    return stream.repartition(shuffle_parts(blocks.sparkSession), "block").sortWithinPartitions(
        "block", F.col("ngram").asc_nulls_last(), "shard")


def events(blocks: DataFrame, answers: DataFrame, n_kept: int, v_kept: int) -> DataFrame:
    """Tokens of the deleted documents in cells of nearly equal estimates from the kept ones."""
    def cells(batches):
        for _, _, _, counts, token in blocks_with_counts(batches, "kept"):
            level, bucket, f3, f2, f1, _ = estimates(counts, token, n_kept, v_kept)
            code = cell_codes(f3, f2, f1)
            key = (level * 64 + bucket) << 36 | code
            keys, place, n = np.unique(key, return_inverse=True, return_counts=True)
            yield record_batch(CELLS, [(keys >> 42).astype(np.int32), (keys >> 36 & 63).astype(np.int32), keys & (1 << 36) - 1, n,
                                       *(np.bincount(place, f, len(keys)) for f in (f3, f2, f1))])

    deleted = blocks.where(F.col("part") == DELETED)
    return with_answers(deleted, answers, "kept").mapInArrow(cells, CELLS_DDL).where(F.col("level") > 0)


def scores(blocks: DataFrame, answers: DataFrame, n: int, v: int, table: np.ndarray) -> DataFrame:
    def score(batches):
        for part, ids, sizes, counts, token in blocks_with_counts(batches, "trained"):
            level, bucket, *orders, known = estimates(counts, token, n, v)
            weights = table[level, bucket]
            p = weights[:, 3] / (v + 1)
            for k, f in enumerate(orders):
                p += weights[:, k] * f
            at = np.cumsum(sizes) - sizes
            base = np.log10((known + 0.5) / (n + 0.5 * (v + 1)))
            m = len(sizes)
            yield record_batch(SCORES, [ids, np.full(m, part == UNTRAINED), sizes, np.add.reduceat((known > 0).astype(np.int64), at),
                                        np.full(m, n), np.add.reduceat(base, at), np.add.reduceat(np.log10(p), at)])

    return with_answers(blocks, answers, "trained").mapInArrow(score, SCORES_DDL)


def score_documents(docs: DataFrame, block_tokens: int = BLOCK_TOKENS, shard_entries: int = SHARD_ENTRIES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10 probability) of every document.

    Documents whose crc32(doc_id) mod 5 is 1 are held out; of the others those
    with remainder 4 are the deleted part that the weights are learned on.
    """
    blocks = token_blocks(docs, block_tokens)
    tokens = blocks.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    shards = max(1, min(math.ceil(len(ORDERS) * tokens / shard_entries), (1 << 32) - 1))
    answers = counted(chunks(blocks, shards), shards)
    forget_shuffles(docs.sparkSession)
    n, v, n_kept, v_kept = (x or 0 for x in answers.agg(*[F.sum(c) for c in ("n", "v", "n_kept", "v_kept")]).first())
    weights = mixture(events(blocks, answers, n_kept, v_kept), v_kept)
    forget_shuffles(docs.sparkSession)
    return scores(blocks, answers, n, v, weight_table(weights))
