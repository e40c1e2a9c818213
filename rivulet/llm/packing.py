"""Packing by concatenate-and-cut.

Pass 1 tokenises every text once and writes its ids as a table, with the
partition's number and the ids before it in that partition. The partitions'
token totals, summed from the first, give each partition its global offset.
Pass 2 cuts the one long run of ids into windows of ``seq_len``: a document
that crosses a window's end becomes several pieces (boundary records). Only
the last window can be short.
"""

from __future__ import annotations

import base64

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.blocks import release, small_batches
from rivulet.session import scratch_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 0
SEQ_LEN = 1024

_encoders: dict = {}


def _encoder(path: str):
    """The JSON's byte-level BPE, run by tiktoken (three times the speed of
    ``tokenizers`` for the same ids; tests compare the two)."""
    if path not in _encoders:
        import json

        import tiktoken
        from tokenizers.pre_tokenizers import ByteLevel

        spec = json.load(open(path, encoding="utf-8"))
        printable = {}  # byte-level alphabet: character to byte
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(shown)]
        for b in shown:
            printable[chr(b)] = b
        for i, b in enumerate(rest):
            printable[chr(256 + i)] = b
        assert set(printable) == set(ByteLevel.alphabet())
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(printable[c] for c in tok): i for tok, i in spec["model"]["vocab"].items() if tok not in special}
        _encoders[path] = tiktoken.Encoding(
            path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return _encoders[path]


def token_table(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int) -> DataFrame:
    """One row per document: id, part, before (ids of the partition before
    it), n, ids (binary, little-endian; two bytes an id if the vocabulary
    allows), written to the shared folder so that every later read sees the
    same partitions."""
    id_type = docs.schema[id_col].dataType.simpleString()
    wide = _encoder(tokenizer).n_vocab > 1 << 16

    def encode(batches):
        enc, before, part = _encoder(tokenizer), 0, TaskContext.get().partitionId()
        for batch in batches:
            release()
            ids, counts, starts = [], [], []
            for t in batch.column(1).to_pylist():
                got = enc.encode_to_numpy(t or "", allowed_special="all")
                row = np.append(got, np.uint32(end_id)).astype("<u4" if wide else "<u2")
                ids.append(row.tobytes())
                counts.append(len(row))
                starts.append(before)
                before += len(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([part] * len(ids), pa.int32()), pa.array(starts, pa.int64()),
                 pa.array(counts, pa.int64()), pa.array(ids, pa.binary())], ["id", "part", "before", "n", "ids"])

    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "token_table")
    (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
     .mapInArrow(encode, f"id {id_type}, part int, before long, n long, ids binary")
     .write.option("compression", "zstd").parquet(path))
    return spark.read.parquet(path)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER,
         end_id: int = END_ID, seq_len: int = SEQ_LEN) -> DataFrame:
    """Pieces of all documents: id, start (the document's ids before the
    piece), length, ids (binary, little-endian unsigned 32-bit), doc_tokens
    (with the end id), sequence_id, offset (place in the sequence).

    Each id of each document lies in exactly one piece. Null and empty texts
    give the end id alone; a text of any length is cut at every window. Rows
    that repeat an id are separate documents. An empty table gives no piece.
    """
    small_batches(docs.sparkSession)
    table = token_table(docs, id_col, text_col, tokenizer, end_id)
    id_type = docs.schema[id_col].dataType.simpleString()
    width = 4 if _encoder(tokenizer).n_vocab > 1 << 16 else 2
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (  # one row per partition of pass 1
        table.groupBy("part").agg(F.sum("n").alias("total"))
        .select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    )

    def cut(batches):
        for batch in batches:
            release()
            out: dict[str, list] = {k: [] for k in ("row", "start", "length", "ids", "n", "seq", "off")}
            where, ids = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for i, (at, raw) in enumerate(zip(where, ids, strict=True)):
                row = np.frombuffer(raw, f"<u{width}").astype("<u4")
                start = 0
                while start < len(row):
                    length = min(seq_len - (at + start) % seq_len, len(row) - start)
                    out["row"].append(i)
                    out["start"].append(start)
                    out["length"].append(length)
                    out["ids"].append(row[start:start + length].tobytes())
                    out["n"].append(len(row))
                    out["seq"].append((at + start) // seq_len)
                    out["off"].append((at + start) % seq_len)
                    start += length
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(out["row"], pa.int64())), pa.array(out["start"], pa.int64()),
                 pa.array(out["length"], pa.int64()), pa.array(out["ids"], pa.binary()), pa.array(out["n"], pa.int64()),
                 pa.array(out["seq"], pa.int64()), pa.array(out["off"], pa.int64())],
                ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return (
        table.join(F.broadcast(bases), "part")
        .select("id", (F.col("base") + F.col("before")).alias("at"), "ids")
        .mapInArrow(cut, f"id {id_type}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
        .withColumnRenamed("id", id_col)
    )


def ids_array(ids: Column) -> Column:
    """A piece's ids as array<int>."""

    @F.arrow_udf("array<int>")
    def unpacked(rows: pa.Array) -> pa.Array:
        return pa.array([np.frombuffer(r, "<u4").astype(np.int32) for r in rows.to_pylist()], pa.list_(pa.int32()))

    return unpacked(ids)


def packed_digests(docs: DataFrame) -> DataFrame:
    """The pieces of ``documents`` with the CRC of their ids."""
    return pack(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def rank_file(path: str) -> dict[bytes, int]:
    """Ranks of a tiktoken file: token bytes to rank."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
