"""Best-fit packing by hierarchical residual packing.

Method: a document of more than ``window`` ids is cut into pieces of that
many, the first one may be shorter. Each task packs the pieces of its own
split into bins by best fit, longest first, some ``chunk`` pieces at a time.
Bins that miss at most ``slack`` ids are done. The others are items for the
next round: ``fan_in`` neighbouring tasks' underfull bins meet in one task,
which packs them by best fit again, and so on to the root of the tree. A task
hands on its ``hand_on`` emptiest bins and closes the rest as they are, so no
task of any round holds more than ``fan_in`` times as many bins.

A bin is a run of rows that share its number; a row knows its place in it, so
merging two bins shifts places and nothing is joined. Rows are written after
each round, which cuts the lineage.

Defined results: a null text is empty and holds the end id alone; a text of
any length is encoded whole; repeated rows and repeated or null ids are packed
row by row; equal lengths go in input order; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazalens.llm.common import written
from plazalens.llm.tokens import encoder

BIN = "bin long, fill int, offset int, done boolean, part int"


def best_fit(sizes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, place) of every size, longest first, each into the fullest bin that takes it."""
    order = np.argsort(-sizes, kind="stable")
    bins, places = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    room: list[list[int]] = [[] for _ in range(window + 1)]  # open bins by the ids they still take
    open_rooms, n = 0, 0  # bit r is set where room[r] has a bin
    for i, size in zip(order.tolist(), sizes[order].tolist()):
        fitting = open_rooms >> size
        if fitting:
            r = size + (fitting & -fitting).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                open_rooms ^= 1 << r
        else:
            r, b, n = window, n, n + 1
        bins[i], places[i] = b, window - r
        if r > size:
            room[r - size].append(b)
            open_rooms |= 1 << (r - size)
    return bins, places


def _pieces(ids: np.ndarray, offsets: np.ndarray, window: int, with_ids: bool) -> tuple[list, ...]:
    """(row, piece, start, length, crc32, ids) of every piece of a run of texts."""
    out: tuple[list, ...] = ([], [], [], [], [], [])
    raw = memoryview(ids.astype("<u4").tobytes())
    for row, (lo, hi) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        start, piece = 0, 0
        while start < hi - lo:
            end = start + ((hi - lo - start) % window or window)
            own = raw[4 * (lo + start):4 * (lo + end)]
            for c, v in zip(out, (row, piece, start, end - start, zlib.crc32(own), bytes(own) if with_ids else None)):
                c.append(v)
            start, piece = end, piece + 1
    return out


class _Packer:
    """Best-fit rounds of one task; bin numbers are its own, by level and task."""

    def __init__(self, window: int, slack: int, hand_on: int, level: int):
        self.window, self.slack, self.hand_on = window, slack, hand_on
        self.next = (level << 56) + (TaskContext.get().partitionId() << 32)

    def pack(self, rows: pa.Table, part: int, last: bool) -> tuple[pa.Table, pa.Table]:
        """(rows of bins that are done, rows of the emptiest ones that are not); rows of one bin stand together."""
        bin_, fill, offset = (rows.column(c).to_numpy().astype(np.int64) for c in ("bin", "fill", "offset"))
        first = np.flatnonzero(np.append(True, bin_[1:] != bin_[:-1]))
        item = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(bin_))))
        bins, places = best_fit(fill[first], self.window)
        n = int(bins.max()) + 1
        filled = np.bincount(bins, weights=fill[first], minlength=n).astype(np.int64)
        stays = np.zeros(n, bool)
        if not last:
            stays[np.argsort(filled, kind="stable")[:self.hand_on]] = True
            stays &= filled < self.window - self.slack
        of, at = bins[item], places[item] + offset
        for name, values in (("bin", self.next + of), ("fill", filled[of]), ("offset", at), ("done", ~stays[of]),
                             ("part", np.full(len(of), part))):
            field = rows.schema.field(name)
            rows = rows.set_column(rows.schema.get_field_index(name), field, pa.array(values, field.type))
        self.next += n
        order = np.lexsort((at, of))
        closed = ~stays[of[order]]
        return rows.take(pa.array(order[closed])), rows.take(pa.array(order[~closed]))


def best_fit_pack(docs: DataFrame, tokenizer_path: str, mode: str = "spaces", end_id: int = 2, window: int = 1024,
                  id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, slack: int = 4,
                  fan_in: int = 8, hand_on: int = 4096, chunk: int = 1 << 16) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece; with its 32-bit ids if asked."""
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, ids binary, {BIN}"
    with open(tokenizer_path, encoding="utf-8") as f:  # read once on the driver: its size is the vocabulary's
        source = docs.sparkSession.sparkContext.broadcast(f.read())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        enc, n = encoder(source.value, mode, end_id), 0
        for b in batches:
            for lo, ids, offsets in enc.encode(b.column(1)):
                row, piece, start, length, crc, own = _pieces(ids, offsets, window, with_ids)
                size = pa.array(length, pa.int32())
                yield pa.table({
                    "doc_id": b.column(0).take(pa.array(np.array(row, np.int64) + lo)),
                    "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
                    "ids": pa.array(own, pa.binary()), "bin": pa.array(np.arange(n, n + len(row))), "fill": size,
                    "offset": pa.array(np.zeros(len(row), np.int32)), "done": pa.array(np.zeros(len(row), bool)),
                    "part": pa.array(np.zeros(len(row), np.int32))})
                n += len(row)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, held, part = _Packer(window, slack, hand_on, 0), None, TaskContext.get().partitionId()
        for rows in encode(batches):
            held = rows if held is None else pa.concat_tables([held, rows])
            if held.num_rows >= chunk:  # the emptiest bins go on as items of the next chunk
                done, held = packer.pack(held, part, False)
                yield from done.to_batches(10_000)
        if held is not None and held.num_rows:
            for rows in packer.pack(held, part, False):
                yield from rows.to_batches(10_000)

    def merge(level: int, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            packer, held = _Packer(window, slack, hand_on, level), []  # one group: at most fan_in * hand_on bins

            def flush() -> Iterator[pa.RecordBatch]:
                rows = pa.Table.from_batches(held)
                for rows in packer.pack(rows, rows.column("part")[0].as_py(), last):
                    yield from rows.to_batches(10_000)

            for b in batches:
                group = b.column(b.schema.get_field_index("part")).to_numpy()
                cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)] if len(group) else []
                for s, e in zip(cuts[:-1], cuts[1:]):
                    if held and held[0].column(b.schema.get_field_index("part"))[0].as_py() != group[s]:
                        yield from flush()
                        held = []
                    held.append(b.slice(s, e - s))
            if held:
                yield from flush()
        return run

    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    rows = written(d.mapInArrow(local, schema), "bins")
    finished, open_rows, level = rows.filter("done"), rows.filter("not done"), 0
    parts = (open_rows.agg(F.max("part")).first()[0] or 0) + 1
    while parts:
        level, groups = level + 1, -(-parts // fan_in)
        grouped = open_rows.withColumn("part", F.expr(f"cast(part div {fan_in} as int)"))
        met = grouped.repartition(groups, "part").sortWithinPartitions("part", "bin", "offset")
        rows = written(met.mapInArrow(merge(level, groups == 1), schema), "bins")
        finished, open_rows = finished.unionByName(rows.filter("done")), rows.filter("not done")
        parts = groups if groups > 1 else 0
    return finished.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"),
                           F.col("offset").cast("long").alias("offset"), *(["ids"] if with_ids else []))
