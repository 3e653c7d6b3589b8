"""Cross-tokenizer alignment by pointer jumping.

Two tokenizers cut the same bytes into tokens. Places where a token of each ends
cut a text into groups; within a group tokens of both sides overlap in a chain.
For many texts at once every token points to its farthest-right overlapping
token, and successor doubling (``next = next[next]``) takes every token to the
last one of its chain in a logarithmic number of rounds; that terminal token
labels the group.

Corpus counts: each task cuts its documents into blocks of BLOCK_TOKENS tokens
and writes, once, one row for every different id pair of a block (with the number
of its documents that hold it linked) and one row for each document (which pairs
of its block it holds, and how often). Pair rows are summed by pair; the highest
count of each A id is a table of at most one row per vocabulary entry, so it is
broadcast. Counts go back to the blocks that asked, where documents are summed
in a stream sorted by block: no task holds more than one block's pairs and one
document. What is shuffled grows with the pairs per block, not with tokens.

Edge cases: a text that is null or empty, or whose tokens of one side do not give
back its bytes, has no tokens. Very long texts are one row and are encoded whole;
a group in which one side has very many tokens is counted by different ids, not
by pairs of tokens. Rows that share a doc_id, or have none, stay rows of their
own and each counts as a document. Ties for an A id's highest count all count as
highest. An empty table gives no rows. Other columns are not read.
"""
from __future__ import annotations

import hashlib
import re
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, parts, partition_id, record_batch, shuffle_parts, slices
from .token_files import Encoder

#: Documents and tokens of the first side in a block.
BLOCK_TOKENS = 500_000
#: Texts aligned together, by count and by characters.
GROUP_DOCS, GROUP_CHARS = 300, 500_000
#: Words an encoder keeps, about 200 bytes each.
CACHED_WORDS = 100_000
#: A group with more token pairs than this is counted by its different ids.
MOST_PAIRS = 1 << 16
#: Blocks of one partition are numbered below this bit.
BLOCK_BITS = 24

STATS = ["n_a", "n_b", "n_groups", "n_links"]
ENCODED_DDL = ("block bigint, pos int, pair bigint, docs int, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, "
               "n_links bigint, groups_sha256 string, held binary, times binary")
ENCODED = pa.schema([("block", pa.int64()), ("pos", pa.int32()), ("pair", pa.int64()), ("docs", pa.int32()),
                     ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                     ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("held", pa.binary()), ("times", pa.binary())])
RESULT_DDL = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
              "groups_sha256 string")
RESULT = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in (*STATS, "n_best", "count_sum")),
                    ("groups_sha256", pa.string())])


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level BPE: printable Latin-1 stands for itself, other bytes for U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}


class WordEncoder(Encoder):
    """Keeps a bounded number of words; two encoders share a worker here."""

    def _lookup(self, words: list[str]) -> list[bytes]:
        found = super()._lookup(words)
        if len(self.spaced) > CACHED_WORDS:
            self.spaced = {}
        return found


class ByteLevel:
    """A file of the tokenizers library; special tokens in texts are plain text."""

    def __init__(self, path: str):
        self.encoder = WordEncoder(path)
        self.encoder.tokenizer.encode_special_tokens = True
        self.kind = np.dtype(np.uint16 if self.encoder.code == "H" else np.uint32)
        alphabet = byte_alphabet()
        vocab = self.encoder.tokenizer.get_vocab(with_added_tokens=True)
        entries = [b""] * (1 + max(vocab.values()))
        for piece, i in vocab.items():
            if all(c in alphabet for c in piece):
                entries[i] = bytes(map(alphabet.get, piece))
        self.entries = pa.array(entries, pa.large_binary())

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(x, self.kind) for x in self.encoder.encode([" " + t for t in texts])]


class WordPieces(WordEncoder):
    """Encodes words of a SentencePiece model, each once, and texts from their words.

    Only for a vocabulary in which no piece has a blank after another character: then no merge
    crosses the place before a word, and words encode independently.
    """

    def __init__(self, model):
        self.model = model
        self.code = "H" if model.vocab_size() <= 1 << 16 else "I"
        self.spaced = {}

    def _bytes(self, texts: list[str]) -> list[bytes]:
        # The model adds the blank that these texts start with.
        return [array(self.code, x).tobytes() for x in self.model.encode([t.removeprefix(" ") for t in texts], num_threads=1)]

    def _word_bytes(self, words: list[str]) -> list[bytes]:
        return [array(self.code, x).tobytes() for x in self.model.encode(words, num_threads=1)]


#: A blank before another white-space character or the end of a text.
_LOOSE_BLANK = re.compile(r" (?!\S)")


class Pieces:
    """A SentencePiece model, which adds the leading space itself."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.kind = np.dtype(np.uint16 if self.model.vocab_size() <= 1 << 16 else np.uint32)
        self.entries = pa.array([self._bytes(i) for i in range(self.model.vocab_size())], pa.large_binary())
        pieces = [self.model.id_to_piece(i).lstrip("▁") for i in range(self.model.vocab_size())]
        self.words = None if any("▁" in p for p in pieces) else WordPieces(self.model)

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        if self.model.is_byte(i):
            return bytes([int(re.fullmatch(r"<0x([0-9A-F]{2})>", piece)[1], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        whole = [self.words is None or not t or _LOOSE_BLANK.search(t) is not None or t[0] == " " for t in texts]
        ids = self.model.encode([t for t, w in zip(texts, whole, strict=True) if w], num_threads=1)
        rest = self.words.encode([" " + t for t, w in zip(texts, whole, strict=True) if not w]) if self.words else []
        by_text, by_word = iter(ids), iter(rest)
        return [np.array(next(by_text), self.kind) if w else np.frombuffer(next(by_word), self.kind) for w in whole]


_sides: dict[tuple[type, str], ByteLevel | Pieces] = {}


def side(kind: type, path: str) -> ByteLevel | Pieces:
    """One for each Python worker."""
    if (kind, path) not in _sides:
        _sides[kind, path] = kind(path)
    return _sides[kind, path]


@dataclass(frozen=True)
class Tokens:
    """Ids, end bytes and texts of the tokens of one side of several texts laid end to end; entry bytes checked."""
    ids: np.ndarray
    ends: np.ndarray
    text: np.ndarray


def gives_back(entries: pa.Array, ids: list[np.ndarray], wanted: list[bytes]) -> list[bool]:
    """Whether the joined bytes of each text's tokens are the text."""
    sizes = [len(x) for x in ids]
    if not sum(sizes):
        return [not w for w in wanted]
    taken = entries.take(pa.array(np.concatenate(ids)))
    at = np.frombuffer(taken.buffers()[1], np.int64)[:len(taken) + 1]
    data = memoryview(taken.buffers()[2] or b"").cast("B")
    cuts = at[np.concatenate([[0], np.cumsum(sizes)])].tolist()
    return [data[a:b] == w for a, b, w in zip(cuts, cuts[1:], wanted, strict=False)]


def laid_out(entries: pa.Array, ids: list[np.ndarray]) -> Tokens:
    flat = np.concatenate(ids) if ids else np.zeros(0, np.uint16)
    size = np.diff(np.frombuffer(entries.buffers()[1], np.int64)[:len(entries) + 1])
    return Tokens(flat.astype(np.int64), np.cumsum(size[flat]), np.repeat(np.arange(len(ids)), [len(x) for x in ids]))


def terminals(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token of both sides the A token that ends its group.

    Both sides cover the same bytes. The farthest-right token that overlaps an A
    token is the B token over its last byte, and the other way round; where both
    end together the A token is the last of the group and points to itself.
    """
    n = len(a_ends)
    over_a = np.searchsorted(b_ends, a_ends)
    over_b = np.searchsorted(a_ends, b_ends)
    step = np.concatenate([np.where(b_ends[over_a] == a_ends, np.arange(n), n + over_a), over_b]) if n else over_b
    while True:
        further = step[step]
        if np.array_equal(further, step):
            return step[:n], step[n:]
        step = further


def linked_pairs(a: Tokens, b: Tokens, a_last: np.ndarray, b_last: np.ndarray, width: int):
    """text, pair (A id * width + B id) and number of links of every different linked pair of each text."""
    if not len(a.ids):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    heads = np.flatnonzero(np.concatenate([[True], a_last[1:] != a_last[:-1]]))
    b_heads = np.flatnonzero(np.concatenate([[True], b_last[1:] != b_last[:-1]]))
    n_a, n_b = np.diff(np.append(heads, len(a.ids))), np.diff(np.append(b_heads, len(b.ids)))
    text = a.text[heads]
    few = n_a * n_b <= MOST_PAIRS
    links = (n_a * n_b)[few]
    group = np.repeat(np.flatnonzero(few), links)
    place = np.arange(len(group)) - np.repeat(np.cumsum(links) - links, links)
    pair = a.ids[heads[group] + place // n_b[group]] * width + b.ids[b_heads[group] + place % n_b[group]]
    texts, pairs, times = [text[group]], [pair], [np.ones(len(pair), np.int64)]
    for g in np.flatnonzero(~few):
        ids, n = np.unique(a.ids[heads[g]:heads[g] + n_a[g]], return_counts=True)
        others, m = np.unique(b.ids[b_heads[g]:b_heads[g] + n_b[g]], return_counts=True)
        pairs.append((ids[:, None] * width + others).ravel())
        times.append((n[:, None] * m).ravel())
        texts.append(np.full(len(pairs[-1]), text[g]))
    text, pair, times = map(np.concatenate, (texts, pairs, times))
    order = np.argsort(text * (1 << 40) + pair, kind="stable")  # a pair is below 2^40
    text, pair, times = text[order], pair[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (pair[1:] != pair[:-1])]))
    return text[first], pair[first], np.add.reduceat(times, first)


class Spelled:
    """Decimal ids with the sign that follows them, as Arrow strings."""

    def __init__(self, size: int, signs: str):
        self.signs = signs
        self.words = pa.array([f"{i}{s}" for i in range(size) for s in signs], pa.large_binary())

    def codes(self, ids: np.ndarray, sign: np.ndarray) -> np.ndarray:
        return ids * len(self.signs) + sign


def digests(a: Tokens, b: Tokens, a_last: np.ndarray, b_last: np.ndarray, n_texts: int, spelled: Spelled) -> list[str]:
    """Digest of ``a1,a2|b1;a3|b2,b3`` of every text, '' without tokens."""
    n, m = len(a.ids), len(b.ids)
    last_a = np.concatenate([a_last[1:] != a_last[:-1], [True]]) if n else np.zeros(0, bool)
    last_b = np.concatenate([b_last[1:] != b_last[:-1], [True]]) if m else np.zeros(0, bool)
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    # A token's place: the tokens of its own side before it, and those of the other side in earlier groups (B) or up to its group (A).
    before_b = np.concatenate([[0], np.flatnonzero(last_b) + 1])
    upto_a = np.flatnonzero(last_a) + 1
    written = np.empty(n + m, np.int64)
    written[np.arange(n) + before_b[group_a]] = spelled.codes(a.ids, np.where(last_a, 1, 0))
    if m:
        written[np.arange(m) + upto_a[group_b]] = spelled.codes(b.ids, np.where(last_b, 2, 0))
    taken = spelled.words.take(pa.array(written))
    at = np.frombuffer(taken.buffers()[1], np.int64)[:n + m + 1] if n + m else np.zeros(1, np.int64)
    data = memoryview(taken.buffers()[2] or b"")
    sizes = np.bincount(a.text, minlength=n_texts) + np.bincount(b.text, minlength=n_texts)
    cuts = at[np.concatenate([[0], np.cumsum(sizes)])].tolist()
    return [hashlib.sha256(data[i:j - 1]).hexdigest() if j > i else "" for i, j in zip(cuts, cuts[1:], strict=False)]


@dataclass(frozen=True)
class Aligned:
    """What ``align`` finds in each of several texts, and their pairs sorted by text and pair."""
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    sha256: list[str]
    text: np.ndarray
    pair: np.ndarray
    times: np.ndarray


def align(texts: list[str | None], first: ByteLevel, second: Pieces, spelled: Spelled) -> Aligned:
    """Tokens of both sides aligned, for several texts together."""
    given = [t or "" for t in texts]
    a_ids, b_ids = first.encode(given), second.encode(given)
    wanted = [b" " + t.encode() for t in given]
    good = [bool(t) and x and y for t, x, y in zip(given, gives_back(first.entries, a_ids, wanted),
                                                   gives_back(second.entries, b_ids, wanted), strict=True)]
    a = laid_out(first.entries, [x if ok else x[:0] for x, ok in zip(a_ids, good, strict=True)])
    b = laid_out(second.entries, [x if ok else x[:0] for x, ok in zip(b_ids, good, strict=True)])
    a_last, b_last = terminals(a.ends, b.ends)
    text, pair, times = linked_pairs(a, b, a_last, b_last, len(second.entries))
    n = len(texts)
    ends = a_last == np.arange(len(a.ids))
    n_links = np.zeros(n, np.int64)
    np.add.at(n_links, text, times)
    return Aligned(np.bincount(a.text, minlength=n), np.bincount(b.text, minlength=n),
                   np.bincount(a.text[ends], minlength=n), n_links,
                   digests(a, b, a_last, b_last, n, spelled), text, pair, times)


class Block:
    """Documents of a block; ``rows`` are its pair rows and document rows."""

    def __init__(self, number: int):
        self.number, self.tokens = number, 0
        self.docs, self.stats, self.pairs, self.times = [], [[] for _ in range(5)], [], []

    def add(self, doc_ids: list, found: Aligned) -> None:
        self.docs += doc_ids
        for column, values in zip(self.stats, (found.n_a, found.n_b, found.n_groups, found.n_links, found.sha256), strict=True):
            column += values if isinstance(values, list) else values.tolist()
        bounds = np.searchsorted(found.text, np.arange(len(doc_ids) + 1)).tolist()
        for i, j in zip(bounds, bounds[1:], strict=False):
            self.pairs.append(found.pair[i:j])
            self.times.append(found.times[i:j])
        self.tokens += len(doc_ids) + int(found.n_a.sum())

    def rows(self):
        pairs, held, docs = np.unique(np.concatenate(self.pairs), return_inverse=True, return_counts=True)
        n = len(pairs)
        if n:
            yield record_batch(ENCODED, [np.full(n, self.number), np.arange(n, dtype=np.int32), pairs, docs.astype(np.int32),
                                         *(pa.nulls(n, f.type) for f in list(ENCODED)[4:])])
        held, n, at, packed = held.astype(np.uint32), len(self.docs), 0, []
        for pairs_of, times in zip(self.pairs, self.times, strict=True):
            own = held[at:at + len(pairs_of)]
            packed.append((np.diff(own, prepend=np.uint32(0)).astype("<u4").tobytes(), times.astype("<u4").tobytes()))
            at += len(pairs_of)
        yield record_batch(ENCODED, [np.full(n, self.number), *(pa.nulls(n, f.type) for f in list(ENCODED)[1:4]),
                                     self.docs, *self.stats, *zip(*packed, strict=True)])


def encoded_blocks(docs: DataFrame, first_path: str, second_path: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Pair rows (pair not null) and document rows of all blocks."""
    def encode(batches):
        first, second = side(ByteLevel, first_path), side(Pieces, second_path)
        spelled = Spelled(max(len(first.entries), len(second.entries)), ",|;")
        number = partition_id() << BLOCK_BITS
        block = Block(number)
        for batch in parts(batches):
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, j in slices([t or "" for t in texts], GROUP_DOCS, GROUP_CHARS):
                block.add(ids[i:j], align(texts[i:j], first, second, spelled))
                if block.tokens >= block_tokens:
                    yield from block.rows()
                    number += 1
                    block = Block(number)
        if block.docs:
            yield from block.rows()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialize(rows.mapInArrow(encode, ENCODED_DDL), "alignment")


def summed(batches):
    """Documents of each block, whose pairs with their counts come before them."""
    block, counts, best = None, [], []
    for batch in batches:
        blocks = batch.column("block").to_numpy()
        is_pair = batch.column("pos").is_valid().to_numpy(zero_copy_only=False)
        # Runs of rows of one block and kind.
        cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(is_pair.view(np.int8)) != 0)) + 1
        for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(blocks)], strict=True):
            if i == j:
                continue
            if blocks[i] != block:
                block, counts, best = blocks[i], [], []
            part = batch.slice(i, j - i)
            if is_pair[i]:
                counts.append(part.column("count").to_numpy())
                best.append(part.column("best").to_numpy(zero_copy_only=False))
                continue
            if len(counts) != 1:
                counts = [np.concatenate(counts) if counts else np.zeros(0, np.int64)]
                best = [np.concatenate(best) if best else np.zeros(0, bool)]
            n_best, total = [], []
            for held, times in zip(part.column("held"), part.column("times"), strict=True):
                own = np.cumsum(np.frombuffer(held.as_buffer(), "<u4"), dtype=np.int64)
                n = np.frombuffer(times.as_buffer(), "<u4").astype(np.int64)
                n_best.append(int(n[best[0][own]].sum()))
                total.append(int((n * counts[0][own]).sum()))
            yield record_batch(RESULT, [part.column("doc_id"), *(part.column(c) for c in STATS), n_best, total,
                                        part.column("groups_sha256")])


def align_documents(docs: DataFrame, byte_bpe_path: str, pieces_path: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document.

    A link is an A and a B token of one group; a pair's count is the number of
    documents that hold it linked. n_best counts links whose pair has its A id's
    highest count, count_sum adds the counts over links.
    """
    width = len(side(Pieces, pieces_path).entries)
    written = encoded_blocks(docs, byte_bpe_path, pieces_path, block_tokens)
    asked = written.where(F.col("pair").isNotNull()).select("block", "pos", "pair", "docs")
    counts = materialize(asked.groupBy("pair").agg(F.sum("docs").alias("count")), "alignment-counts")
    a_id = F.expr(f"pair div {width}")
    highest = counts.groupBy(a_id.alias("a")).agg(F.max("count").alias("highest"))  # at most one row per A entry
    ranked = counts.withColumn("a", a_id).join(F.broadcast(highest), "a").select(
        "pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    answers = asked.join(ranked, "pair").select("block", "pos", "count", "best")
    of_doc = [F.lit(None).cast(t).alias(c) for c, t in (
        ("doc_id", "bigint"), *((c, "bigint") for c in STATS), ("groups_sha256", "string"), ("held", "binary"), ("times", "binary"))]
    documents = written.where(F.col("held").isNotNull()).select(
        "block", F.lit(None).cast("int").alias("pos"), F.lit(None).cast("bigint").alias("count"),
        F.lit(None).cast("boolean").alias("best"), "doc_id", *STATS, "groups_sha256", "held", "times")
    stream = answers.select("*", *of_doc).unionAll(documents)
    ordered = stream.repartition(shuffle_parts(docs.sparkSession), "block").sortWithinPartitions(
        "block", F.col("pos").asc_nulls_last())
    return ordered.mapInArrow(summed, RESULT_DDL)
