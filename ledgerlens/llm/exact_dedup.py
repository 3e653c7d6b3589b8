"""Exact dedup by deterministic block naming.

Each normalised text (null: empty; A-Z lower-cased) is cut into blocks of a
fixed number of bytes. The distinct blocks are sorted and numbered: equal
blocks get one integer name, different blocks different names. Adjacent names
of a document are then paired, the distinct pairs sorted and numbered, and so
on until each document is a single name. Two texts are equal exactly when they
end on the same level with the same name, so identities never collide.

Text moves through one shuffle (the distinct blocks of each batch). Block rows
look their name up by a 64-bit hash; hashes that stand for more than one block
keep the block itself beside the name and are matched on it.

Hot groups: blocks and pairs are made distinct before they are shuffled for
naming, and the look-up joins have one row per key on one side, so Spark can
split a hot key of the other side.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import explode_copies, materialize, partition_id, parts, record_batch, shuffle_parts

BLOCK_BYTES = 2048

ROWS = pa.schema([("doc_id", pa.int64()), ("sha", pa.binary()), ("pos", pa.int32()), ("h", pa.int64()),
                  ("block", pa.binary())])
ROWS_DDL = "doc_id bigint, sha binary, pos int, h bigint, block binary"
NAMES = pa.schema([("h", pa.int64()), ("block", pa.binary()), ("name", pa.int64())])
NAMES_DDL = "h bigint, block binary, name bigint"
#: Names of a task start at its partition id times this.
NAMES_PER_TASK = 1 << 36


def normalised(texts: pa.Array) -> list[bytes]:
    """UTF-8 of each text with A-Z lower-cased; null is empty."""
    # bytes.lower() changes A-Z alone; Arrow's ascii_lower is wrong on a slice of an array.
    return [(t or "").encode().lower() for t in texts.to_pylist()]


def _cut(batches, block_bytes: int, hash_bits: int, want: str):
    """Rows of blocks. want: "blocks" (distinct in each part: h, block), "rows" or "rows+block"."""
    shift = 64 - hash_bits
    for batch in parts(batches):
        ids = batch.column(0).to_pylist()
        doc, shas, pos, blocks = [], [], [], []
        for i, text in zip(ids, normalised(batch.column(1)), strict=True):
            sha = hashlib.sha256(text).digest()
            for k in range(max(1, -(-len(text) // block_bytes))):
                doc.append(i)
                shas.append(sha)
                pos.append(k)
                blocks.append(text[k * block_bytes:(k + 1) * block_bytes])
        if want == "blocks":
            blocks = list(set(blocks))
        h = (np.fromiter(map(xxhash.xxh3_64_intdigest, blocks), np.uint64, len(blocks)) >> np.uint64(shift)).view(np.int64)
        if want == "blocks":
            none = pa.nulls(len(blocks))
            yield record_batch(ROWS, [none.cast(pa.int64()), none.cast(pa.binary()), none.cast(pa.int32()), h, blocks])
        else:
            kept = blocks if want == "rows+block" else pa.nulls(len(blocks), pa.binary())
            yield record_batch(ROWS, [doc, shas, pos, h, kept])


def _number_blocks(batches):
    """Names for the sorted (h, block) rows of one partition; the block stays where its hash is shared."""
    name = partition_id() * NAMES_PER_TASK
    run_h, run = None, []

    def flush(out):
        nonlocal name
        for block in run:
            name += 1
            out.append((run_h, block if len(run) > 1 else None, name))

    for batch in batches:
        out: list[tuple] = []
        for h, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if h != run_h:
                flush(out)
                run_h, run = h, [block]
            elif block != run[-1]:
                run.append(block)
        if out:
            yield record_batch(NAMES, zip(*out, strict=True))
    out = []
    flush(out)
    if out:
        yield record_batch(NAMES, zip(*out, strict=True))


def _first_names(docs: DataFrame, block_bytes: int, hash_bits: int) -> DataFrame:
    """(doc_id, sha, copies, names): each document as the names of its blocks."""
    spark = docs.sparkSession
    n = shuffle_parts(spark)
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))

    def cut(want):
        return texts.mapInArrow(lambda it: _cut(it, block_bytes, hash_bits, want), ROWS_DDL)

    distinct = cut("blocks").select("h", "block").repartition(n, "h").sortWithinPartitions("h", "block")
    names = materialize(distinct.mapInArrow(_number_blocks, NAMES_DDL), "blocknames")
    named = cut("rows").drop("block").join(names.where("block is null").select("h", "name"), "h").drop("h")
    shared = names.where("block is not null")
    if not shared.isEmpty():
        rows = cut("rows+block").join(shared.select("h").distinct(), "h", "leftsemi")
        named = named.unionByName(rows.join(shared, ["h", "block"]).drop("h", "block"))
    return named.groupBy("doc_id", "sha").agg(
        F.sum((F.col("pos") == 0).cast("int")).alias("copies"),
        F.array_sort(F.collect_set(F.struct("pos", "name"))).alias("names"),
    ).withColumn("names", F.col("names.name"))


def _next_names(docs: DataFrame) -> DataFrame:
    """Documents of two names or more with each adjacent pair replaced by its name."""
    pair = F.transform(F.sequence(F.lit(0), F.floor((F.size("names") - 1) / 2).cast("int")), lambda i: F.struct(
        F.get("names", i * 2).alias("a"), F.coalesce(F.get("names", i * 2 + 1), F.lit(0)).alias("b")))
    pairs = docs.select("doc_id", "sha", "copies", F.posexplode(pair).alias("pos", "pair")).select(
        "doc_id", "sha", "copies", "pos", "pair.a", "pair.b")
    names = pairs.select("a", "b").distinct().sortWithinPartitions("a", "b").withColumn(
        "name", F.monotonically_increasing_id() + 1)
    return pairs.join(materialize(names, "pairnames"), ["a", "b"]).groupBy("doc_id", "sha").agg(
        F.first("copies").alias("copies"), F.array_sort(F.collect_list(F.struct("pos", "name"))).alias("names"),
    ).withColumn("names", F.col("names.name"))


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES, hash_bits: int = 64) -> DataFrame:
    """(doc_id, sha, copies, level, name): (level, name) is the collision-free identity of the text.

    A row repeated with the same doc_id and text is one row with copies > 1.
    hash_bits only sets the width of the look-up hash; any width gives the same identities.
    """
    done: DataFrame | None = None
    level = 0
    now = materialize(_first_names(docs, block_bytes, hash_bits), "names")
    while True:
        one = now.where(F.size("names") == 1).select(
            "doc_id", "sha", "copies", F.lit(level).alias("level"), F.col("names")[0].alias("name"))
        done = one if done is None else done.unionByName(one)
        longer = now.where(F.size("names") > 1)
        if longer.isEmpty():
            return done
        now = materialize(_next_names(longer), "names")
        level += 1


def exact_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES, hash_bits: int = 64) -> DataFrame:
    """Per row of ``docs`` (columns doc_id, text; others ignored): doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest doc_id is kept. Null text counts as
    empty. A null doc_id is smaller than any other. Of rows with the same
    doc_id and equal texts exactly one is kept. An empty table gives no rows.
    """
    ids = identities(docs, block_bytes, hash_bits)
    groups = ids.groupBy("level", "name").agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    rows = explode_copies(ids.join(groups, ["level", "name"]), "copies", "nth")
    return rows.select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The kept rows of ``docs`` with all their columns, exactly one for each group of equal texts."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    kept = exact_duplicates(docs).where("kept").select(
        F.col("doc_id").alias("__kept_id"), F.col("text_sha256").alias("__kept_sha"))
    rows = docs.withColumn("__sha", F.sha2(F.translate(F.coalesce("text", F.lit("")), upper, lower), 256))
    same = F.col("doc_id").eqNullSafe(F.col("__kept_id")) & (F.col("__sha") == F.col("__kept_sha"))
    return rows.join(kept, same, "leftsemi").dropDuplicates(["doc_id", "__sha"]).drop("__sha")
