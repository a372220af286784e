"""Prefix trie of conversations from sorted sequences and their common prefixes.

Method: a conversation is the sequence of its turns' digests. All sequences
are range-partitioned and sorted; neighbours have a longest common prefix
(LCP). A trie node is a run of neighbours: its candidate is a row and a depth,
and a sparse table of range minima over the LCPs lets every candidate
binary-search its left and its right end by itself - no stack, no order among
candidates. Members, children, leaves and texts below a node are differences
of prefix sums at the two ends.

Each partition also sees its neighbours' rows at the border, so it knows which
of its nodes go on beyond it. Those are partial; their sums are added up, in
one stream per node with a row for each partition that it reaches. All other
nodes are whole where they are found.

Defined results: rows without a conversation id take no part; a null role or
text is empty; turns are ordered by turn (null first), then role and text, so
repeated rows stand side by side and count each; texts of any length are
digested whole (128 bits); an empty table gives an empty result; other columns
are not read. A conversation's digests are one row, 24 bytes a turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plazalens.llm.common import release_worker_cache, written

TURNS = 100_000  # turns of a partition
DIGEST = 16
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
NODE = ("conv_id long, depth long, node binary, parent binary, parent_conv_id long, n_convs long, n_children long,"
        " n_leaves long, saved_tokens long, ends_sha256 string, ends string, open boolean, parent_open boolean, part long")


def sequences(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as (digest in hex, code points)."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    t = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"),
                     text.alias("text")).filter(F.col("conv_id").isNotNull())
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    t = t.withColumn("at", F.row_number().over(order))
    digest = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"))
    rows = t.select("conv_id", F.struct("at", digest.alias("digest"), F.char_length("text").cast("long").alias("chars")).alias("s"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("s")).alias("s")).select(
        "conv_id", F.transform("s", lambda x: F.struct(x["digest"].alias("digest"), x["chars"].alias("chars"))).alias("turns"))


def rebuilt(convs: DataFrame) -> DataFrame:
    """(conv_id, turns) where each conversation c begins with the first crc32(c) % 6 turns of c - c % 100."""
    h = F.crc32(F.col("conv_id").cast("string")) % 6
    own = convs.select("conv_id", "turns", (F.col("conv_id") - F.col("conv_id") % 100).alias("base"), h.cast("int").alias("h"))
    base = convs.filter(F.col("conv_id") % 100 == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, 5).alias("first"))
    none = F.slice("turns", 1, 0)
    return own.join(base, "base", "left").select("conv_id", F.concat(
        F.slice(F.coalesce("first", none), F.lit(1), F.col("h")),
        F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))).alias("turns"))


class SparseTable:
    """Minima of all runs whose length is a power of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            half = 1 << (len(self.levels) - 1)
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minimum of each run ``lo`` to ``hi``, both included."""
        level = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
        out = np.empty(len(lo), self.levels[0].dtype)
        for k in np.unique(level):
            of = level == k
            out[of] = np.minimum(self.levels[k][lo[of]], self.levels[k][hi[of] - (1 << int(k)) + 1])
        return out

    def right(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The last place that each ``at`` reaches to the right over values of ``least`` or more."""
        at = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            table, step = self.levels[k], 1 << k
            can = at + 1 < len(table)
            can[can] = table[at[can] + 1] >= least[can]
            at[can] += step
        return at

    def left(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The first place from which each ``at`` is reached over values of ``least`` or more (its own included)."""
        at = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            table, step = self.levels[k], 1 << k
            can = at - step >= 0
            can[can] = table[at[can] - step + 1] >= least[can]
            at[can] -= step
        return at


def common_prefixes(digests: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """LCP of each sequence with the one before it (-1 for the first); ``digests`` has two words a turn."""
    begin = np.cumsum(sizes) - sizes
    short = np.minimum(sizes[1:], sizes[:-1])
    pair = np.repeat(np.arange(len(short)), short)
    turn = np.arange(len(pair)) - np.repeat(np.cumsum(short) - short, short)
    differ = np.flatnonzero((digests[begin[pair] + turn] != digests[begin[pair + 1] + turn]).any(axis=1))
    out = short.copy()
    np.minimum.at(out, pair[differ], turn[differ])
    return np.append(-1, out)


def partition_nodes(keys: list[bytes], convs: np.ndarray, chars: list[np.ndarray], before: bytes | None,
                    after: bytes | None, part: int) -> pa.Table:
    """The nodes of one sorted partition; ``before`` and ``after`` are the neighbours' sequences at its borders."""
    all_keys = [*([before] if before is not None else []), *keys, *([after] if after is not None else [])]
    sizes = np.fromiter(map(len, all_keys), np.int64, len(all_keys)) // DIGEST
    lcp = common_prefixes(np.frombuffer(b"".join(all_keys), np.int64).reshape(-1, 2), sizes)
    if before is not None:
        lcp, sizes = lcp[1:], sizes[1:]
    n = len(keys)
    to_next, lcp, sizes = (int(lcp[n]) if after is not None else -1), lcp[:n], sizes[:n]
    # cumulative code points of each row: one more entry than turns
    cum = np.concatenate([np.append(0, np.cumsum(c)) for c in chars])
    at = np.cumsum(sizes + 1) - sizes - 1
    total = cum[at + sizes]

    def sums(x: np.ndarray) -> np.ndarray:
        return np.append(0, np.cumsum(x))

    rows_sum = sums(total)
    new_sum = sums(total - cum[at + np.maximum(lcp, 0)])
    leaves = sums(np.append(lcp[1:], to_next) < sizes)
    table = SparseTable(lcp)
    # candidates: every depth that a row does not share with the one before it, and all depths of the first row
    low = lcp + 1
    low[0] = 0
    count = sizes - low + 1
    first = np.cumsum(count) - count
    row = np.repeat(np.arange(n), count)
    depth = np.arange(len(row)) - np.repeat(first - low, count)
    left, right = table.left(row, depth), table.right(row, depth)
    goes_on = (row == 0) & (depth <= lcp[0])  # the node began in an earlier partition
    is_open = goes_on | ((right == n - 1) & (depth <= to_next))
    # each row that adds nodes hangs its first one on the node of depth lcp that holds the row before
    hang = np.flatnonzero((sizes > lcp) & (lcp >= 0))
    holder = table.left(hang, lcp[hang])
    parent_at = np.where(depth > low[row], np.arange(len(row)) - 1, -1)
    hung = first[holder] + lcp[hang] - low[holder]
    own_first = np.where(hang > 0, first[hang], first[hang] + lcp[hang] + 1)
    parent_at[own_first] = hung
    children = np.bincount(parent_at[(parent_at >= 0) & ~goes_on], minlength=len(row))
    shared = cum[at[left] + np.maximum(depth - 1, 0)]  # code points above the node's own text
    members = right - left + 1
    saved = rows_sum[right + 1] - rows_sum[left] - members * shared
    own = np.where(goes_on, new_sum[right + 1], total[left] - shared + new_sum[right + 1] - new_sum[left + 1])
    least = SparseTable(convs).least(left, right)

    names: list[bytes] = []
    for k, key in enumerate(keys):
        h = hashlib.md5()
        if low[k] == 0:
            names.append(h.digest())
        done = 0
        for d in range(max(1, int(low[k])), int(sizes[k]) + 1):
            h.update(key[done:DIGEST * d])
            done = DIGEST * d
            names.append(h.digest())
    # members that end at a node stand side by side at its left end
    starts = np.flatnonzero(np.append(True, (lcp[1:] != sizes[1:]) | (sizes[1:] != sizes[:-1])))
    ends = {int(s): ",".join(map(str, convs[s:e].tolist())) for s, e in zip(starts, np.append(starts[1:], n))}
    texts = [ends.get(int(l), "") if d == sizes[l] else "" for l, d in zip(left.tolist(), depth.tolist())]
    parent_conv = [None if p < 0 or is_open[p] else int(least[p]) for p in parent_at.tolist()]
    parent_name = [None if p < 0 else names[p] for p in parent_at.tolist()]
    open_parent = [p >= 0 and bool(is_open[p]) for p in parent_at.tolist()]
    return pa.table({
        "conv_id": least, "depth": depth, "node": pa.array(names, pa.binary()), "parent": pa.array(parent_name, pa.binary()),
        "parent_conv_id": pa.array(parent_conv, pa.int64()), "n_convs": members, "n_children": children,
        "n_leaves": leaves[right + 1] - leaves[left], "saved_tokens": saved - own,
        "ends_sha256": pa.array([None if o else hashlib.sha256(t.encode()).hexdigest() for o, t in zip(is_open.tolist(), texts)], pa.string()),
        "ends": pa.array([t if o else None for o, t in zip(is_open.tolist(), texts)], pa.string()),
        "open": is_open, "parent_open": open_parent, "part": np.full(len(row), part)})


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of each partition's rows (part, kind, key, conv_id, chars); kinds 0 and 2 are the neighbours' rows."""
    release_worker_cache()
    part, held = None, []

    def flush() -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        kind = rows.column("kind").to_numpy()
        keys = rows.column("key").to_pylist()
        own = rows.filter(pa.array(kind == 1))
        at = np.flatnonzero(kind == 1)
        chars = own.column("chars").combine_chunks()
        flat, cuts = chars.flatten().to_numpy(), np.append(0, np.cumsum(np.asarray(chars.value_lengths())))
        yield from partition_nodes(
            keys[at[0]:at[-1] + 1], own.column("conv_id").to_numpy(), [flat[s:e] for s, e in zip(cuts[:-1], cuts[1:])],
            keys[0] if kind[0] == 0 else None, keys[-1] if kind[-1] == 2 else None, part).to_batches(10_000)

    for b in batches:
        number = b.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(number)] if len(number) else []
        for s, e in zip(cuts[:-1], cuts[1:]):
            if held and int(number[s]) != part:
                yield from flush()
                held = []
            part = int(number[s])
            held.append(b.slice(s, e - s))
    if held:
        yield from flush()


def _added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of each open node from its partial rows, which come by node and partition; nothing is gathered."""
    total: dict | None = None
    out: list[dict] = []

    def close() -> None:
        total["ends_sha256"] = total.pop("hash").hexdigest()
        out.append(total | {"ends": None})

    for b in batches:
        for r in b.to_pylist():
            if total is None or r["node"] != total["node"]:
                if total is not None:
                    close()
                total = r | {"hash": hashlib.sha256(), "n_convs": 0, "n_children": 0, "n_leaves": 0, "saved_tokens": 0}
                some = False
            for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                total[c] += r[c]
            total["conv_id"] = min(total["conv_id"], r["conv_id"])
            if r["ends"]:
                total["hash"].update((("," if some else "") + r["ends"]).encode())
                some = True
        if len(out) >= 1000:
            yield pa.RecordBatch.from_pylist(out, b.schema)
            out.clear()
    if total is not None:
        close()
        yield pa.RecordBatch.from_pylist(out, b.schema)


def prefix_trie(convs: DataFrame, turns_at_once: int = TURNS) -> DataFrame:
    """(``COLUMNS``, node, parent) of every node of the trie of ``convs`` (conv_id, turns)."""
    convs = written(convs.select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda x: x["digest"]), "")).alias("key"),
        F.transform("turns", lambda x: x["chars"]).alias("chars")), "conversations")
    turns = convs.agg(F.sum(F.size("chars") + 1)).first()[0] or 0
    parts = max(1, -(-turns // turns_at_once))
    ranged = written(convs.repartitionByRange(parts, "key", "conv_id").withColumn(
        "part", F.spark_partition_id().cast("long")), "ranged")
    # one row per partition: its neighbours' nearest sequences
    by_part = Window.orderBy("part")
    edges = ranged.groupBy("part").agg(F.min("key").alias("least"), F.max("key").alias("most")).select(
        "part", F.lag("most").over(by_part).alias("before"), F.lead("least").over(by_part).alias("after"))
    rows = ranged.select("part", F.lit(1).alias("kind"), "key", "conv_id", "chars")
    for kind, side in ((0, "before"), (2, "after")):
        rows = rows.unionByName(edges.filter(F.col(side).isNotNull()).select("part", F.lit(kind).alias("kind"), F.col(
            side).alias("key")), allowMissingColumns=True)
    found = written(rows.repartition(parts, "part").sortWithinPartitions("part", "kind", "key", "conv_id").mapInArrow(
        _nodes, NODE), "nodes")
    whole = found.filter("not open")
    merged = written(found.filter("open").repartition("node").sortWithinPartitions("node", "part").mapInArrow(
        _added_up, NODE), "open_nodes")
    names = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("found"))
    hung = whole.filter("parent_open").unionByName(merged).join(names, "parent", "left").withColumn("parent_conv_id", F.col("found"))
    columns = [*COLUMNS, "node", "parent"]
    return whole.filter("not parent_open").select(columns).unionByName(hung.select(columns))
