"""Packing by concatenation and cutting.

Method: pass one tokenizes and writes each document's ids with the ids before
it in its task; a prefix sum over the tasks' totals gives every document its
place in one endless row of ids. Pass two cuts it into windows of ``window``
ids: a document yields one boundary record for each window that it touches.
Every sequence but the last is full, so there is next to no padding.

Defined results: a null text is empty and holds the end id alone; a text of any
length is encoded whole; repeated
rows are packed each; order is that of the input's splits; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazalens.llm.common import release_worker_cache, written
from plazalens.llm.tokens import encode_documents, id_dtype_of, part_bases


def cut_windows(tokens: DataFrame, dtype: np.dtype, window: int = 1024) -> DataFrame:
    """One row per piece of ``tokens`` (of ``encode_documents``) in fixed windows; ``dtype`` is that of the ids."""
    id_type = tokens.schema["id"].dataType.simpleString()
    # one row per task of the first pass, so the broadcast is as small as the task list
    placed = tokens.join(F.broadcast(part_bases(tokens)), "part").select(
        "id", (F.col("base") + F.col("local")).alias("at"), "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker_cache()  # the first pass is over, its encoder is not asked again
        for b in batches:
            rows, cols = [], [[] for _ in range(6)]
            for k, (at, ids) in enumerate(zip(b.column(1).to_pylist(), b.column(2))):
                ids = memoryview(np.frombuffer(ids.as_buffer(), dtype).astype("<u4").tobytes())
                n, start = len(ids) // 4, 0
                while start < n:
                    offset = (at + start) % window
                    length = min(window - offset, n - start)
                    rows.append(k)
                    for c, v in zip(cols, (start, length, zlib.crc32(ids[4 * start:4 * (start + length)]), n,
                                           (at + start) // window, offset)):
                        c.append(v)
                    start += length
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows, pa.int64()))] + [pa.array(c, pa.int64()) for c in cols],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return placed.mapInArrow(run, f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long,"
                                  " sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer_path: str, mode: str = "spaces", end_id: int = 0, window: int = 1024,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Boundary records (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of all documents."""
    return cut_windows(written(encode_documents(docs, tokenizer_path, mode, end_id, id_col, text_col), "packing"),
                       id_dtype_of(tokenizer_path), window)
