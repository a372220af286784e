"""SimHash near-dedup by bit-sliced comparison.

A document's fingerprint is the majority bit of the XXH64 (seed 42) of its
word shingles. Equal fingerprints are collapsed first. Distinct ones that
differ in at most ``radius`` bits agree on two of ``radius + 2`` blocks of
the 64 bits; each pair of blocks is a candidate key. The members of a key
are compared bit-sliced: the planes of 64 consecutive members lie in one
word, every bit plane is XORed with itself shifted by s members, and
carry-save counters hold all distances at once; words whose lanes have all
passed the radius are abandoned. A key with more members than ``cap`` is cut
into chunks, and each pair of chunks is a unit of its own, so no task holds
an unbounded group and no pair is missed. A unit returns a spanning forest of its links, not all of
them; components come from star contraction.

Defined results: a null or empty text (no words) has fingerprint zero and
links like any other; fewer words than the shingle length form one shingle;
A-Z are lower-cased before; a text of any length is hashed whole; repeated rows
get equal answers, and of equal ids any names the component; a null id never
names a component (null only if no linked row has an id); an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazalens.llm.common import release_worker_cache, written
from plazalens.llm.components import star_components

SEED = 42


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of a UTF-8 text."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:len(words) - shingle + 1].tolist()
    stops = ends[shingle - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[s:e], SEED) for s, e in zip(starts, stops)], np.uint64)
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[k:k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp) of every row; ``fp`` is the fingerprint as a signed long."""
    id_type = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker_cache()
        for b in batches:
            texts = b.column(1).cast(pa.binary())
            fp = np.array([fingerprint(t.as_py() or b"", shingle) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["id", "fp"])

    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    return d.mapInArrow(run, f"id {id_type.simpleString()}, fp long")


def _live_over(counter: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose count exceeds ``radius`` (bitwise comparison with a constant)."""
    more, equal = np.zeros_like(over), ~np.zeros_like(over)
    for k in range(len(counter) - 1, -1, -1):
        if radius >> k & 1:
            equal = equal & counter[k]
        else:
            more = more | (equal & counter[k])
            equal = equal & ~counter[k]
    return more | over


def bit_sliced_links(fp: np.ndarray, group: np.ndarray, radius: int, check_every: int = 8):
    """Row pairs of a spanning forest of the links inside each group.

    ``group`` is sorted. Yields (i, j) index arrays; rows that earlier pairs
    already connect are left out.
    """
    n = len(fp)
    if n < 2:
        return
    bits = np.unpackbits(fp.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").T
    width = n // 64 + 3
    planes = np.zeros((64, width * 8), np.uint8)
    packed = np.packbits(bits, axis=1, bitorder="little")
    planes[:, :packed.shape[1]] = packed
    planes = planes.view(np.uint64)
    ends = np.searchsorted(group, group, side="right")
    remaining = ends - np.arange(n) - 1
    lanes = np.nonzero(remaining)[0]
    label = np.arange(n)
    for s in range(1, n):
        lanes = lanes[remaining[lanes] >= s]
        if not len(lanes):
            return
        mask8 = np.zeros(width * 64, bool)
        mask8[lanes] = True
        mask = np.packbits(mask8, bitorder="little").view(np.uint64)
        live = np.nonzero(mask)[0]
        mask = mask[live]
        q, r = divmod(s, 64)
        low, high = np.minimum(live + q, width - 1), np.minimum(live + q + 1, width - 1)
        counter = [np.zeros(len(live), np.uint64) for _ in range(max(1, radius.bit_length()))]
        over = np.zeros(len(live), np.uint64)
        for plane in range(64):
            p = planes[plane]
            other = p[low] if r == 0 else (p[low] >> np.uint64(r)) | (p[high] << np.uint64(64 - r))
            carry = p[live] ^ other
            for k in range(len(counter)):
                counter[k], carry = counter[k] ^ carry, counter[k] & carry
            over = over | carry
            if plane % check_every == check_every - 1:
                near = mask & ~_live_over(counter, over, radius)
                keep = near != 0
                if not keep.all():
                    live, mask, low, high, over = live[keep], mask[keep], low[keep], high[keep], over[keep]
                    counter = [c[keep] for c in counter]
                    if not len(live):
                        break
        if not len(live):
            continue
        near = mask & ~_live_over(counter, over, radius)
        w, bit = np.nonzero(np.unpackbits(near.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        i = live[w] * 64 + bit
        j = i + s
        new = label[i] != label[j]
        i, j = i[new], j[new]
        if not len(i):
            continue
        yield i, j
        while True:  # hook the larger label on the smaller one, then shorten the paths
            a, b = label[i], label[j]
            if (a == b).all():
                break
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while (label != label[label]).any():
                label = label[label]


def _key_masks(radius: int) -> list[int]:
    """Masks of all pairs of ``radius + 2`` blocks of the 64 bits, as signed longs."""
    m = radius + 2
    cuts = [64 * k // m for k in range(m + 1)]
    blocks = [((1 << cuts[k + 1]) - 1) ^ ((1 << cuts[k]) - 1) for k in range(m)]
    masks = [a | b for a, b in combinations(blocks, 2)]
    return [x - (1 << 64) if x >> 63 else x for x in masks]


def links(nodes: DataFrame, radius: int = 2, cap: int = 4096, buffer: int = 1 << 16) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints within ``radius`` bits of each other."""
    keys = F.array(*[F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                     for k, m in enumerate(_key_masks(radius))])
    cand = nodes.select("fp", F.explode(keys).alias("k")).select("fp", "k.t", "k.key")
    sizes = cand.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1")
    chunks = F.ceil(F.col("n") / cap).cast("int")
    cand = (cand.join(sizes, ["t", "key"]).withColumn("chunks", chunks)
            .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")))
    other = F.when(F.col("chunks") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda x: x != F.col("own")))
    units = (cand.withColumn("other", F.explode(other))
             .select("t", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp"))
    unit = ["t", "key", "i", "j"]
    units = units.repartition(*unit).sortWithinPartitions(*unit, "fp")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(final: bool):
            nonlocal held
            t = pa.Table.from_batches(held).combine_chunks()
            cols = [t.column(c).to_numpy() for c in range(5)]
            change = np.zeros(t.num_rows, bool)
            for c in cols[:4]:
                change[1:] |= c[1:] != c[:-1]
            cut = t.num_rows if final else int(np.nonzero(change)[0][-1]) if change.any() else 0
            held = [] if final else t.slice(cut).to_batches()
            fp, group = cols[4][:cut].astype(np.int64).view(np.uint64), np.cumsum(change[:cut])
            for i, j in bit_sliced_links(fp, group, radius):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fp[i].view(np.int64)), pa.array(fp[j].view(np.int64))], ["a", "b"])

        for b in batches:
            if b.num_rows:
                held.append(b)
                if sum(x.num_rows for x in held) >= buffer:
                    yield from flush(False)
        if held:
            yield from flush(True)

    return units.mapInArrow(compare, "a long, b long")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
               radius: int = 2, cap: int = 4096) -> DataFrame:
    """(id, fp, component_id) of every row; ``component_id`` is the smallest id reachable by links."""
    prints = written(fingerprints(docs, id_col, text_col, shingle), "simhash")
    nodes = prints.groupBy("fp").agg(F.min("id").alias("rep"))
    stars = star_components(links(nodes, radius, cap))
    label = nodes.join(stars.select(F.col("a").alias("fp"), "b"), "fp", "left").withColumn(
        "label", F.coalesce("b", "fp"))
    ids = label.groupBy("label").agg(F.min("rep").alias("component_id"))
    of = label.select("fp", "label").join(ids, "label").select("fp", "component_id")
    return prints.join(of, "fp").select("id", "fp", "component_id")
