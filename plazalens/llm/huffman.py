"""Token ids as files of canonical length-limited Huffman codes.

Method: global id counts give code lengths of at most ``limit`` bits
(package-merge); codes are canonical, so the file holds the lengths alone.
Documents are range-partitioned by id and sorted; each partition writes
independent blocks of whole documents with the bit offset of every 256th id.
A reader decodes a block by table look-up, all of its checkpoints side by side.

File format: a folder with three Parquet tables. ``lengths`` (token, length);
``blocks`` (part, local, doc_ids, sizes, n_ids, checkpoints, bits): ``local``
counts the ids before the block in its part, ``bits`` holds the codes from the
highest bit on, ``checkpoints`` 64-bit little-endian bit offsets; ``parts``
(part, base): the ids in all earlier parts.

Defined results: a null text is empty and holds the end id alone; null ids
come first; repeated ids follow each other in the order of their ids' bytes;
an empty table gives files without blocks; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plazalens.llm.common import written
from plazalens.llm.tokens import encode_documents, id_dtype_of, part_bases

BLOCK_IDS = 1 << 19
STEP = 256


def code_lengths(counts: np.ndarray, limit: int = 16) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits for the symbols with a count (package-merge).

    The limit grows to what as many symbols need at least.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    limit = max(limit, int(np.ceil(np.log2(len(used)))))
    leaves = np.sort(counts[used].astype(np.float64))
    by_count = used[np.argsort(counts[used], kind="stable")]
    level, is_leaf = leaves, [np.ones(len(leaves), bool)]
    for _ in range(limit - 1):
        pairs = level[:len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate((leaves, pairs))
        order = np.argsort(both, kind="stable")
        level = both[order]
        is_leaf.append(order < len(leaves))
    take = 2 * len(used) - 2
    for flags in reversed(is_leaf):  # the cheapest coins; each package stands for two of the level below
        n = int(flags[:take].sum())
        lengths[by_count[:n]] += 1
        take = 2 * (take - n)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, symbol)."""
    codes = np.zeros(len(lengths), np.uint64)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    code, last = 0, 0
    for s in order.tolist():
        n = int(lengths[s])
        code <<= n - last
        codes[s] = code
        code, last = code + 1, n
    return codes


def pack_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The codes of ``ids`` as bytes, and the bit offset of each id."""
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    at = ends - size
    word, room = at >> 6, 64 - (at & 63) - size
    code = codes[ids]
    out = np.zeros(int(ends[-1] >> 6) + 2 if len(ids) else 1, np.uint64)
    if len(ids):
        over = room < 0
        high = np.where(over, code >> np.where(over, -room, 0).astype(np.uint64),
                        code << np.where(over, 0, room).astype(np.uint64))
        first = np.flatnonzero(np.diff(word, prepend=-1))
        out[word[first]] = np.bitwise_or.reduceat(high, first)
        out[word[over] + 1] |= code[over] << (64 + room[over]).astype(np.uint64)
    return out.astype(">u8").tobytes()[:int(ends[-1] + 7) // 8 if len(ids) else 0], at


class Decoder:
    """Table-driven decoder: one look-up of the next ``width`` bits gives id and code length."""

    def __init__(self, lengths: np.ndarray):
        self.width = int(lengths.max(initial=1))
        codes = canonical_codes(lengths)
        used = np.flatnonzero(lengths)
        size = lengths[used].astype(np.int64)
        order = np.argsort(codes[used].astype(np.int64) << (self.width - size))
        self.symbol = np.repeat(used[order].astype(np.uint32), 1 << (self.width - size[order]))
        self.length = np.repeat(size[order], 1 << (self.width - size[order]))
        pad = (1 << self.width) - len(self.symbol)
        self.symbol = np.append(self.symbol, np.zeros(pad, np.uint32))
        self.length = np.append(self.length, np.ones(pad, np.int64))

    def decode(self, bits: bytes, checkpoints: np.ndarray, n: int, step: int = STEP) -> np.ndarray:
        raw = np.frombuffer(bits + b"\0\0\0\0", np.uint8).astype(np.uint32)
        window = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]  # 32 bits from each byte on
        at = checkpoints.copy()
        out = np.zeros((len(at), step), np.uint32)
        top, mask, last = 32 - self.width, (1 << self.width) - 1, len(window) - 1
        for k in range(min(step, n)):
            lanes = len(at) if k < n - (len(at) - 1) * step else len(at) - 1
            p = at[:lanes]
            code = (window[np.minimum(p >> 3, last)] >> (top - (p & 7)).astype(np.uint32)) & mask
            out[:lanes, k] = self.symbol[code]
            p += self.length[code]
        return out.reshape(-1)[:n]


def id_counts(tokens: DataFrame) -> np.ndarray:
    """Global counts by id, from the runs' tallies. One partial row per id and task; the driver gets one row per id of the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for b in batches:
            for tally in b.column(0):
                ids, counts = np.frombuffer(tally.as_buffer(), "<u4").reshape(2, -1).astype(np.int64)
                if int(ids[-1]) >= len(total):
                    total = np.append(total, np.zeros(int(ids[-1]) + 1 - len(total), np.int64))
                total[ids] += counts
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int64)), pa.array(total[used])], ["token", "n"])

    rows = tokens.select("tally").filter("tally is not null").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    counts = np.zeros(1, np.int64)
    for r in rows.collect():
        if r.token >= len(counts):
            counts = np.append(counts, np.zeros(r.token + 1 - len(counts), np.int64))
        counts[r.token] = r.n
    return counts


def write_files(tokens: DataFrame, path: str, dtype: np.dtype, block_ids: int = BLOCK_IDS, limit: int = 16) -> None:
    """Writes ``tokens`` (of ``encode_documents``) in the format above, in ascending id order; ``dtype`` is that of the ids."""
    spark = tokens.sparkSession
    lengths = code_lengths(id_counts(tokens), limit)
    if lengths.max(initial=0) > 25:
        raise ValueError("the decoder's window holds codes of at most 25 bits")
    codes = canonical_codes(lengths)
    id_field = tokens.schema["id"].dataType.simpleString()
    table = spark.sparkContext.broadcast((codes, lengths))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, lengths = table.value
        part, local = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        size = 0

        def flush():
            ids = np.concatenate([x for _, x in held])
            bits, at = pack_bits(ids, codes, lengths)
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([local], pa.int64()),
                pa.array([[i for i, _ in held]], pa.list_(id_type)), pa.array([[len(x) for _, x in held]], pa.list_(pa.int64())),
                pa.array([len(ids)], pa.int64()), pa.array([at[::STEP].astype("<i8").tobytes()], pa.binary()),
                pa.array([bits], pa.binary())], ["part", "local", "doc_ids", "sizes", "n_ids", "checkpoints", "bits"])

        for b in batches:
            id_type = b.column(0).type
            for i, ids in zip(b.column(0).to_pylist(), b.column(1)):
                held.append((i, np.frombuffer(ids.as_buffer(), dtype)))
                size += len(held[-1][1])
                if size >= block_ids:
                    yield flush()
                    held, size, local = [], 0, local + size
        if held:
            yield flush()

    blocks = (tokens.select("id", "ids").repartitionByRange("id").sortWithinPartitions("id", "ids")
              .mapInArrow(run, f"part int, local long, doc_ids array<{id_field}>, sizes array<long>, n_ids long,"
                               " checkpoints binary, bits binary"))
    blocks.write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    done = spark.read.schema(blocks.schema).parquet(f"{path}/blocks")
    part_bases(done.select("part", F.col("n_ids").alias("n"))).coalesce(1).write.parquet(f"{path}/parts")
    used = np.flatnonzero(lengths)
    spark.createDataFrame([(int(t), int(lengths[t])) for t in used], "token long, length int").coalesce(1).write.parquet(
        f"{path}/lengths")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, n_tokens, ids) of every document in the files; ``start`` counts the ids before it."""
    rows = spark.read.parquet(f"{path}/lengths").collect()  # one row per id of the vocabulary
    lengths = np.zeros(max((r.token for r in rows), default=0) + 1, np.uint8)
    for r in rows:
        lengths[r.token] = r.length
    table = spark.sparkContext.broadcast(lengths)
    blocks = spark.read.parquet(f"{path}/blocks")
    id_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    parts = spark.read.parquet(f"{path}/parts")
    placed = blocks.join(F.broadcast(parts), "part").select(  # one row per writing task
        "doc_ids", "sizes", "n_ids", "checkpoints", "bits", (F.col("base") + F.col("local")).alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(table.value)
        for b in batches:
            for k in range(b.num_rows):
                ids = decoder.decode(b.column(4)[k].as_py(), np.frombuffer(b.column(3)[k].as_py(), "<i8"),
                                     b.column(2)[k].as_py())
                sizes = b.column(1)[k].values.to_numpy()
                ends = np.cumsum(sizes)
                begin = ends - sizes
                yield pa.RecordBatch.from_arrays([
                    b.column(0)[k].values, pa.array(begin + b.column(5)[k].as_py()), pa.array(sizes),
                    pa.Array.from_buffers(pa.binary(), len(sizes), [
                        None, pa.py_buffer((np.append(begin, ends[-1:]) * 4).astype(np.int32).tobytes()),
                        pa.py_buffer(ids.astype("<u4").tobytes())])], ["id", "start", "n_tokens", "ids"])

    return placed.mapInArrow(run, f"id {id_type}, start long, n_tokens long, ids binary")


def with_crc32(documents: DataFrame) -> DataFrame:
    """``ids`` replaced by ``ids_crc32``, the unsigned CRC-32 of its bytes, next to the reading."""
    return documents.select("id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def encode_to_files(docs: DataFrame, path: str, tokenizer_path: str, mode: str = "words", end_id: int = 1,
                    id_col: str = "doc_id", text_col: str = "text") -> None:
    """Tokenizes every whole text and writes the ids in ascending id order."""
    write_files(written(encode_documents(docs, tokenizer_path, mode, end_id, id_col, text_col), "token_ids"), path,
                id_dtype_of(tokenizer_path))


__all__ = ["code_lengths", "canonical_codes", "pack_bits", "Decoder", "write_files", "read_files", "with_crc32",
           "encode_to_files"]
