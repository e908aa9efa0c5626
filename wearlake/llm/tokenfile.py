"""Token-id output: documents as ids in range-coded, checksummed blocks.

A token file is a folder of Parquet parts written by Spark, so it is committed
whole or not at all and any store Spark reaches will do.  A row is a chunk of
consecutive documents:

    part, chunk   partition (ascending doc_id over partitions) and number in it
    first_id      ids in the part before this chunk
    n_ids         ids in the chunk
    payload       binary, little-endian:
        "WLRC" 2, n_docs u32, n_blocks u32, crc32 u32 of the index
        index: null flag u8, doc_id i64, n_tokens i64 columns, deflated, its size u32 first
        blocks: n_ids u32, n_bytes u32, crc32 of the ids u32, then the coded bytes
            (the block's alphabet and its ids, see ``rangecoder``)

Every block is decoded by itself from fresh models.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearlake.llm import rangecoder
from wearlake.llm import textvec as tv
from wearlake.llm.runtime import shared_path

BLOCK_IDS, CHUNK_BLOCKS = rangecoder.BLOCK_IDS, 2048
#: Bytes of text for each part: about one chunk of ids.
PART_BYTES = 16 << 20
#: Most parts of a file; a larger table has larger parts (each is many chunks), so that what is kept of each part stays small.
MOST_PARTS = 65_536
_HEAD, _BLOCK = struct.Struct("<4sBIII"), struct.Struct("<III")


def pack_chunk(doc_ids: list, lengths: np.ndarray, ids: np.ndarray, block_ids: int = BLOCK_IDS) -> bytes:
    """The payload of documents whose token ids lie in a row; ValueError for token ids beyond 0 to 2**32 - 1."""
    null = np.array([x is None for x in doc_ids], np.uint8)
    index = zlib.compress(
        null.tobytes() + np.array([x or 0 for x in doc_ids], "<i8").tobytes() + np.asarray(lengths, "<i8").tobytes()
    )
    blocks = [ids[k : k + block_ids] for k in range(0, len(ids), block_ids)]
    out = [_HEAD.pack(b"WLRC", 2, len(doc_ids), len(blocks), zlib.crc32(index)), struct.pack("<I", len(index)), index]
    for own, coded in zip(blocks, rangecoder.encode(blocks)):
        out += [_BLOCK.pack(len(own), len(coded), zlib.crc32(own.astype("<u4").tobytes())), coded]
    return b"".join(out)


def unpack_chunk(payload: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """(doc ids, lengths, ids) of a payload; ValueError if a checksum or the format is wrong."""
    if len(payload) < _HEAD.size + 4:
        raise ValueError("a token chunk ends too early")
    magic, version, n_docs, n_blocks, crc = _HEAD.unpack_from(payload)
    if magic != b"WLRC" or version != 2:
        raise ValueError("not a token chunk")
    (size,) = struct.unpack_from("<I", payload, _HEAD.size)
    at = _HEAD.size + 4
    packed = payload[at : at + size]
    if zlib.crc32(packed) != crc:
        raise ValueError("damaged index of a token chunk")
    index = zlib.decompress(packed)
    null = np.frombuffer(index, np.uint8, n_docs)
    doc_ids = [None if z else x for z, x in zip(null, np.frombuffer(index, "<i8", n_docs, n_docs).tolist())]
    lengths = np.frombuffer(index, "<i8", n_docs, 9 * n_docs).astype(np.int64)
    at += size
    heads, coded = [], []
    for _ in range(n_blocks):
        if at + _BLOCK.size > len(payload):
            raise ValueError("a token chunk ends too early")
        heads.append(_BLOCK.unpack_from(payload, at))
        at += _BLOCK.size
        coded.append(payload[at : at + heads[-1][1]])
        at += heads[-1][1]
    blocks = rangecoder.decode(coded, [h[0] for h in heads])
    for own, h in zip(blocks, heads):
        if zlib.crc32(own.astype("<u4").tobytes()) != h[2]:
            raise ValueError("damaged block of a token chunk")
    return doc_ids, lengths, np.concatenate(blocks) if blocks else np.zeros(0, np.int64)


def write_token_file(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
    chunk_ids: int = BLOCK_IDS * CHUNK_BLOCKS,
) -> None:
    """Encode every whole text, append ``end_id``, and write ids in ascending order of (doc_id, hash of the text, text), nulls first.

    A null text counts as empty (the end id alone); repeated rows are written
    row by row; a long document stays in one chunk; an empty table writes no
    chunk.  Ids must be long integers.

    Parts are ranges of (id, hash of the text), so rows of one id need not be
    one part; each holds about PART_BYTES of text, or more where there would be over MOST_PARTS.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from wearlake.llm.bytebpe import library_ids

        encoder, part = library_ids(tokenizer), TaskContext.get().partitionId()
        names, lengths, parts, held, chunk, before = [], [], [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal names, lengths, parts, held, chunk, before
            payload = pack_chunk(names, np.concatenate(lengths), np.concatenate(parts))
            row = pa.RecordBatch.from_pydict(
                {"part": [part], "chunk": [chunk], "first_id": [before], "n_ids": [held], "payload": [payload]}
            )
            before, chunk = before + held, chunk + 1
            names, lengths, parts, held = [], [], [], 0
            return row

        for batch in batches:
            for row, end, data, offsets in tv.blocks(batch.column(1)):
                ids, begin = encoder.encode(data, offsets)
                names += batch.column(0).slice(row, end - row).to_pylist()
                lengths.append(np.diff(begin) + 1)
                parts.append(np.insert(ids, begin[1:], end_id))
                held += len(parts[-1])
                if held >= chunk_ids:
                    yield flush()
        if names:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    place = ("id", F.xxhash64("text"), "text")
    sorted_rows = rows.repartitionByRange(max(1, min(MOST_PARTS, -(-size // PART_BYTES))), *place[:2]).sortWithinPartitions(*place)
    chunks = sorted_rows.mapInArrow(run, "part long, chunk long, first_id long, n_ids long, payload binary")
    chunks.write.option("compression", "none").parquet(path)  # payloads are coded already


def read_token_file(spark: SparkSession, path: str, id_col: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """Per document from the files: id, start (ids of all documents before it), n_tokens, ids_crc32, ids.

    Every block is decoded and its checksum verified; without ``with_ids`` the
    ids themselves stay behind.  Only one number per part, of at most MOST_PARTS, reaches the driver.
    """
    chunks = spark.read.schema("part long, chunk long, first_id long, n_ids long, payload binary").parquet(path)
    sizes = {r["part"]: r["n"] for r in chunks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    base, total = {}, 0
    for part in sorted(sizes):
        base[part] = total
        total += sizes[part]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, first, _, payload in zip(*(c.to_pylist() for c in batch.columns)):
                doc_ids, lengths, ids = unpack_chunk(payload)
                at = np.concatenate(([0], np.cumsum(lengths)))
                raw = memoryview(ids.astype("<u4").view(np.uint8))
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                columns = [pa.array(doc_ids, pa.int64()), pa.array(base[part] + first + at[:-1]), pa.array(lengths)]
                columns.append(pa.array(crc, pa.int64()))
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = [id_col, "start", "n_tokens", "ids_crc32", "ids"][: 5 if with_ids else 4]
    kinds = f"`{id_col}` long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    return chunks.mapInArrow(run, kinds)


def scratch_path(spark: SparkSession) -> str:
    """A new place in the shared folder."""
    return shared_path(spark, "tokens")
