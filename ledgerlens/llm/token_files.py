"""Token-id output as Arrow files of fixed-size-list batches.

Documents are put in ascending doc_id order by a range shuffle. Each partition
writes one shard: ``tokens-<n>.arrow``, whose rows are sequences of
``seq_len`` token ids (a fixed-size list) and a mask of the same length that is
false on the padding after the last document, and ``docs-<n>.arrow`` with
doc_id, start and n_tokens of its documents. The token file is the Arrow file
form of the stream: equal-length uncompressed batches plus a footer, so a
reader maps it and reaches any sequence and its mask without copying.

A task writes under a name of its attempt and then renames, so a repeated or
speculative task leaves the same complete file. The folder lies under
spark.checkpoint.dir and is opened by its URI with pyarrow.fs.

Encoding splits a text before each blank that a non-blank follows. The
vocabulary's pattern never joins characters across such a place, so the pieces
encode independently; a bounded table keeps pieces already encoded.
"""
from __future__ import annotations

import os
import re
import uuid
import zlib
from array import array
from dataclasses import dataclass
from itertools import compress
from operator import not_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, partition_id, record_batch, shared_work_dir, shuffle_parts

SEQ_LEN = 2048
BATCH_SEQUENCES = 64
END_ID = 0
#: Pieces kept by an encoder, about 200 bytes each.
CACHED_PIECES = 1_000_000
#: Pieces encoded in one call.
JOINED_WORDS = 500
#: Documents encoded together.
GROUP_DOCS = 2000

DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
WRITTEN_DDL = "shard int, folder string, n_docs bigint, n_tokens bigint"
WRITTEN = pa.schema([("shard", pa.int32()), ("folder", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])
READ_DDL = "shard int, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
READ = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                  ("ids_crc32", pa.int64())])

_BLANK_THEN_BLANK = re.compile(r" (?!\S)")
_BEFORE_WORD = re.compile(r"(?= \S)")


class Encoder:
    """Encodes texts with a byte-level BPE file of the tokenizers library."""

    _of_process: dict[str, Encoder] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.model._resize_cache(0)  # pieces are kept here, each is encoded once
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.spaced: dict[str, bytes] = {}
        self.line_break, = self.tokenizer.encode("\n", add_special_tokens=False).ids

    @classmethod
    def get(cls, path: str) -> Encoder:
        """One for each Python worker, so later tasks find its table filled."""
        if path not in cls._of_process:
            cls._of_process[path] = cls(path)
        return cls._of_process[path]

    def _bytes(self, texts: list[str]) -> list[bytes]:
        code = self.code
        return [array(code, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word_bytes(self, words: list[str]) -> list[bytes]:
        """The ids of a blank and each word (no line break in them), many in one text with line breaks between."""
        joined = ["\n".join([" " + w for w in words[i:i + JOINED_WORDS]]) for i in range(0, len(words), JOINED_WORDS)]
        out = []
        for ids in self._bytes(joined):
            at, size = 0, array(self.code).itemsize
            for cut in np.flatnonzero(np.frombuffer(ids, self.code) == self.line_break).tolist():
                out.append(ids[at:cut * size])
                at = (cut + 1) * size
            out.append(ids[at:])
        return out

    def _lookup(self, words: list[str]) -> list[bytes]:
        """The ids of a blank and each of these different words."""
        known = self.spaced
        found = list(map(known.get, words))
        new = list(compress(words, map(not_, found)))
        broken = [x for x in new if "\n" in x or not x]
        plain = [x for x in new if "\n" not in x and x]
        fresh = dict(zip(broken, self._bytes([" " + x for x in broken]), strict=True))
        fresh.update(zip(plain, self._word_bytes(plain), strict=True))
        if len(known) + len(fresh) <= CACHED_PIECES:
            known.update(fresh)
        return [ids or fresh[x] for x, ids in zip(words, found, strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The little-endian ids of each text."""
        split = []
        for text in texts:
            if _BLANK_THEN_BLANK.search(text):
                parts = _BEFORE_WORD.split(text)
                parts = parts if not parts[0].startswith(" ") or len(parts[0]) == 1 else ["", *parts]
                split.append([parts[0], *(x[1:] for x in parts[1:])])
            else:
                split.append(None)
        plain = pc.split_pattern(pa.array([t if x is None else "" for t, x in zip(texts, split, strict=True)], pa.large_string()), " ")
        words = plain.flatten().dictionary_encode()
        ids = pa.array(self._lookup(words.dictionary.to_pylist()), pa.large_binary()).take(words.indices)
        data, at = memoryview(ids.buffers()[2] or b""), np.frombuffer(ids.buffers()[1], np.int64)
        bounds = plain.offsets.to_pylist()
        firsts = plain.flatten().take(pa.array(bounds[:-1], pa.int64())).to_pylist() if texts else []
        heads = self._bytes([x[0] if x else first for x, first in zip(split, firsts, strict=True)])
        out = []
        for head, x, a, b in zip(heads, split, bounds, bounds[1:], strict=False):
            rest = data[at[a + 1]:at[b]] if x is None else b"".join(self._lookup([w])[0] for w in x[1:])
            out.append(head + rest)
        return out


@dataclass(frozen=True)
class Layout:
    folder: str
    seq_len: int = SEQ_LEN
    batch_sequences: int = BATCH_SEQUENCES

    def schema(self, code: str) -> pa.Schema:
        kind = pa.uint16() if code == "H" else pa.uint32()
        return pa.schema([("ids", pa.list_(kind, self.seq_len)), ("mask", pa.list_(pa.bool_(), self.seq_len))])


class ShardWriter:
    """Writes the two files of one shard; ``close`` makes them visible."""

    def __init__(self, layout: Layout, shard: int, code: str):
        self.layout, self.shard, self.code = layout, shard, code
        self.fs, self.at = pyarrow.fs.FileSystem.from_uri(layout.folder)
        self.fs.create_dir(self.at, recursive=True)
        self.attempt = uuid.uuid4().hex
        self.tokens = self._open("tokens", layout.schema(code))
        self.docs = self._open("docs", DOCS)
        self.rest, self.n_tokens, self.n_docs = [], 0, 0
        self.held = 0
        self.item = np.dtype(np.uint16 if code == "H" else np.uint32)
        self.unit = layout.seq_len * layout.batch_sequences * self.item.itemsize

    def _open(self, kind: str, schema: pa.Schema):
        out = self.fs.open_output_stream(f"{self.at}/.{kind}-{self.shard:05d}.{self.attempt}")
        return out, pa.ipc.new_file(out, schema)

    def add(self, doc_ids: list, ids: list[bytes]) -> None:
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // self.item.itemsize
        starts = self.n_tokens + np.cumsum(lengths) - lengths
        self.docs[1].write_batch(record_batch(DOCS, [doc_ids, starts, lengths]))
        self.n_tokens += int(lengths.sum())
        self.n_docs += len(ids)
        self.rest += ids
        self.held += sum(map(len, ids))
        if self.held >= self.unit:
            data = b"".join(self.rest)
            whole = len(data) // self.unit * self.unit
            for i in range(0, whole, self.unit):
                self._write(np.frombuffer(data, self.item, self.unit // self.item.itemsize, i))
            self.rest, self.held = [data[whole:]], len(data) - whole

    def _write(self, ids: np.ndarray) -> None:
        length = self.layout.seq_len
        padded = -(-len(ids) // length) * length
        mask = np.arange(padded) < len(ids)
        if padded > len(ids):
            ids = np.concatenate([ids, np.zeros(padded - len(ids), self.item)])
        self.tokens[1].write_batch(record_batch(self.layout.schema(self.code), [
            pa.FixedSizeListArray.from_arrays(pa.array(x), length) for x in (ids, mask)]))

    def close(self) -> None:
        if self.held:
            self._write(np.frombuffer(b"".join(self.rest), self.item))
        for kind, (out, writer) in (("tokens", self.tokens), ("docs", self.docs)):
            writer.close()
            out.close()
            self.fs.move(f"{self.at}/.{kind}-{self.shard:05d}.{self.attempt}", f"{self.at}/{kind}-{self.shard:05d}.arrow")


class Shard:
    """Random access to a written shard."""

    def __init__(self, folder: str, shard: int):
        fs, at = pyarrow.fs.FileSystem.from_uri(folder)
        local = isinstance(fs, pyarrow.fs.LocalFileSystem)
        self.files = [pa.memory_map(p) if local else fs.open_input_file(p)
                      for p in (f"{at}/{kind}-{shard:05d}.arrow" for kind in ("tokens", "docs"))]
        self.tokens, self.docs = map(pa.ipc.open_file, self.files)
        self.seq_len = self.tokens.schema.field("ids").type.list_size
        self.batch_at, self.batch = -1, None
        self.batch_rows = self.tokens.get_batch(0).num_rows if self.tokens.num_record_batches else 1

    def _batch(self, i: int) -> pa.RecordBatch:
        if i != self.batch_at:
            self.batch_at, self.batch = i, self.tokens.get_batch(i)
        return self.batch

    def sequence(self, row: int) -> tuple[np.ndarray, pa.Array]:
        """Ids (a view of the mapped file) and mask of one sequence."""
        b, i = divmod(row, self.batch_rows)
        batch = self._batch(b)
        ids = batch.column(0).flatten().to_numpy(zero_copy_only=True)
        return ids[i * self.seq_len:(i + 1) * self.seq_len], batch.column(1).flatten().slice(i * self.seq_len, self.seq_len)

    def runs(self, start: int, n: int):
        """The ids [start, start + n) as views, one for each batch they lie in."""
        unit = self.batch_rows * self.seq_len
        while n > 0:
            b, i = divmod(start, unit)
            ids = self._batch(b).column(0).flatten().to_numpy(zero_copy_only=True)[i:i + n]
            yield ids
            start, n = start + len(ids), n - len(ids)

    def close(self) -> None:
        for f in self.files:
            f.close()


def write_tokens(docs: DataFrame, tokenizer_path: str, layout: Layout, end_id: int = END_ID) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write the shards; one row per shard, in doc_id order of the shard number."""
    def write(batches):
        encoder, writer = Encoder.get(tokenizer_path), None
        end = array(encoder.code, [end_id]).tobytes()
        shard = partition_id()
        for batch in batches:
            for i in range(0, batch.num_rows, GROUP_DOCS):
                part = batch.slice(i, GROUP_DOCS)
                writer = writer or ShardWriter(layout, shard, encoder.code)
                ids = encoder.encode([x or "" for x in part.column(1).to_pylist()])
                writer.add(part.column(0).to_pylist(), [x + end for x in ids])
        if writer:
            writer.close()
            yield record_batch(WRITTEN, [[shard], [layout.folder], [writer.n_docs], [writer.n_tokens]])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    ordered = rows.repartitionByRange(shuffle_parts(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")
    return materialize(ordered.mapInArrow(write, WRITTEN_DDL), "tokenshards")


def read_documents(shards: DataFrame) -> DataFrame:
    """shard, doc_id, start (in the shard), n_tokens and ids_crc32 of each document, from the written files."""
    def read(batches):
        for batch in batches:
            for number, folder in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = Shard(folder, number)
                for k in range(shard.docs.num_record_batches):
                    rows = shard.docs.get_batch(k)
                    starts, lengths = (rows.column(c).to_numpy() for c in (1, 2))
                    crcs = []
                    for start, n in zip(starts.tolist(), lengths.tolist(), strict=True):
                        crc = 0
                        for ids in shard.runs(start, n):
                            crc = zlib.crc32(ids.astype("<u4"), crc)
                        crcs.append(crc)
                    yield record_batch(READ, [np.full(len(crcs), number, np.int32), rows.column(0), rows.column(1),
                                              rows.column(2), crcs])
                shard.close()

    spread = shards.select("shard", "folder").repartition(shuffle_parts(shards.sparkSession), "shard")
    return spread.mapInArrow(read, READ_DDL)


def token_files(docs: DataFrame, tokenizer_path: str, folder: str | None = None, seq_len: int = SEQ_LEN,
                batch_sequences: int = BATCH_SEQUENCES) -> DataFrame:
    """Write the token files of ``docs`` and read them back: doc_id, start, n_tokens, ids_crc32, shard, folder.

    start counts the ids of all documents before this one. Null text encodes as
    empty (the end id alone); a null doc_id comes first; rows with one doc_id
    are in text order. An empty table writes no file and gives no rows. Other
    columns are not read.
    """
    spark = docs.sparkSession
    folder = folder or shared_work_dir(spark, "tokens")
    if "://" not in folder:
        folder = folder.replace("file:", "", 1)
        folder = "file://" + folder
    shards = write_tokens(docs, tokenizer_path, Layout(folder, seq_len, batch_sequences))
    # The window holds one row per shard: as many as there were shuffle partitions.
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = shards.select("shard", "folder", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)).alias("before"))
    read = read_documents(shards)
    return read.join(F.broadcast(before), "shard").select(
        "doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids_crc32", "shard", "folder")
