"""The trie of conversation prefixes, by truncation peeling."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.llm.common import named, stored

UNIT = 24  # bytes of a turn inside a path: 16 of its digest, 8 for the length of its text
_IDS_BLOCK = 1 << 16  # ids of a block are numbers of one such range, so at most that many
_NONE = np.iinfo(np.int64).max
_BROADCAST_ROWS = 200_000  # resolved nodes of 24 bytes that are broadcast


class Parts(NamedTuple):
    """What is known of nodes on sorted paths: one entry per (row, depth)."""

    row: np.ndarray
    depth: np.ndarray
    conv: np.ndarray  # smallest member
    n: np.ndarray  # members
    children: np.ndarray
    leaves: np.ndarray
    saved: np.ndarray
    ends: np.ndarray  # digest of the ids that end here, or None
    key: np.ndarray  # name of the node where an earlier round left it open, or None


class Peeled(NamedTuple):
    """Closed nodes in ``nodes`` (columns by name); ``open`` has the entries (side, depth, …) of nodes that reach over the edge."""

    nodes: dict[str, list]
    open: list[tuple]


def shared_turns(a: bytes, b: bytes) -> int:
    """Turns that two paths have in common from the start."""
    low, high = 0, min(len(a), len(b)) // UNIT
    while low < high:
        mid = (low + high + 1) // 2
        if a[: mid * UNIT] == b[: mid * UNIT]:
            low = mid
        else:
            high = mid - 1
    return low


def prefix_keys(path: bytes) -> list[bytes]:
    """A name of 16 bytes for every prefix of a path, from the empty one on."""
    state = xxhash.xxh3_128(seed=13)
    out = [state.digest()]
    for at in range(0, len(path), UNIT):
        state.update(path[at : at + UNIT])
        out.append(state.digest())
    return out


def peel(paths: list[bytes], parts: Parts, final: bool) -> Peeled:
    """All nodes over sorted ``paths``, from the deepest level up.

    At each level the conversations that end there join the nodes that survived the level
    below, less their last turn; equal prefixes are neighbours, so two of them merge where
    the paths agree that far. Merged nodes are told and go on to the next level. Nodes on
    the first or last path may go on in the neighbouring partition: unless ``final``, they
    are left open and hand nothing up, so that a later round can add up what lies here.
    """
    m = len(paths)
    depth = np.array([len(p) // UNIT for p in paths], np.int64)
    common = np.array([-1, *(shared_turns(a, b) for a, b in zip(paths, paths[1:]))], np.int64)
    begin = np.cumsum(depth) - depth
    sizes = np.frombuffer(b"".join(paths), np.uint8).reshape(-1, UNIT)[:, 16:].copy().view(">u8").ravel().astype(np.int64)
    edge_keys = ([], []) if final else (prefix_keys(paths[0]), prefix_keys(paths[-1]))
    by_depth, of_depth = np.argsort(depth, kind="stable"), np.argsort(parts.depth, kind="stable")
    row_cuts = np.searchsorted(depth[by_depth], np.arange(depth.max() + 2))
    part_cuts = np.searchsorted(parts.depth[of_depth], np.arange(depth.max() + 2))
    names = ("conv_id", "depth", "parent_conv_id", "parent_key", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends", "key")
    told: dict[str, list] = {name: [] for name in names}
    open_: list[tuple] = []
    none = np.zeros(0, np.int64)
    alive, conv, n, leaves, saved, closed = none, none, none, none, none, np.zeros(0, bool)
    for level in range(int(depth.max()), -1, -1):
        own = by_depth[row_cuts[level] : row_cuts[level + 1]]
        heads = np.sort(np.concatenate([alive, own]))
        first = np.flatnonzero(common[heads] < level)
        starts = heads[first]
        groups = len(starts)
        up = np.searchsorted(starts, alive, "right") - 1  # the group of each survivor
        some = of_depth[part_cuts[level] : part_cuts[level + 1]]
        ended = np.searchsorted(starts, parts.row[some], "right") - 1
        new_conv = np.full(groups, _NONE)
        np.minimum.at(new_conv, up[closed], conv[closed])
        np.minimum.at(new_conv, ended, parts.conv[some])

        def add(of_survivors: np.ndarray, of_parts: np.ndarray) -> np.ndarray:
            out = np.zeros(groups, np.int64)
            np.add.at(out, up[closed], of_survivors[closed])
            np.add.at(out, ended, of_parts[some])
            return out

        new_n, children, new_leaves, new_saved = add(n, parts.n), add(np.ones_like(n), parts.children), add(leaves, parts.leaves), add(saved, parts.saved)
        ends, key = np.full(groups, None, object), np.full(groups, None, object)
        for out, values in ((ends, parts.ends), (key, parts.key)):
            has = np.array([v is not None for v in values[some]], bool)
            out[ended[has]] = values[some][has]
        shut = np.ones(groups, bool)
        if not final:
            for side, row in ((1, m - 1), (0, 0)):  # a node on both sides is told by the first
                if depth[row] >= level:
                    g = int(np.searchsorted(starts, row, "right")) - 1
                    if shut[g] or side == 0:
                        if not shut[g]:
                            open_.pop()
                        shut[g] = False
                        open_.append((side, level, new_conv[g], new_n[g], children[g], new_leaves[g], new_saved[g], ends[g], edge_keys[side][level]))
        # nodes told one level below learn their parent
        at = len(told["parent_conv_id"])
        told["parent_conv_id"] += [int(c) if s else None for c, s in zip(new_conv[up[closed]].tolist(), shut[up[closed]].tolist())]
        if not final:
            told["parent_key"] += [
                None if shut[g] else edge_keys[0 if depth[0] >= level and starts[g] == 0 else 1][level] for g in up[closed].tolist()
            ]
        else:
            told["parent_key"] += [None] * (len(told["parent_conv_id"]) - at)
        new_leaves[shut & (children == 0)] = 1
        if level:
            new_saved[shut] += (new_n[shut] - 1) * sizes[begin[starts[shut]] + level - 1]
        k = np.flatnonzero(shut)
        told["conv_id"] += new_conv[k].tolist()
        told["depth"] += [level] * len(k)
        for name, values in (("n_convs", new_n), ("n_children", children), ("n_leaves", new_leaves), ("saved_tokens", new_saved), ("ends", ends), ("key", key)):
            told[name] += values[k].tolist()
        alive, conv, n, leaves, saved, closed = starts, new_conv, new_n, new_leaves, new_saved, shut
    if alive.size and closed.any():  # the root has no parent
        told["parent_conv_id"].append(None)
        told["parent_key"].append(None)
    return Peeled(told, open_)


_PART = "depth bigint, conv bigint, n bigint, children bigint, leaves bigint, saved bigint, ends string, key binary"
_PART_FIELDS = [("depth", pa.int64()), ("conv", pa.int64()), ("n", pa.int64()), ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.string()), ("key", pa.binary())]
_PART_TYPE = "array<struct<" + ",".join(f.replace(" ", ":", 1) for f in _PART.split(", ")) + ">>"
_NODE_FIELDS = [
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("parent_key", pa.binary()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends", pa.string()), ("key", pa.binary()),
]
_OUT = pa.schema([*_NODE_FIELDS, ("path", pa.binary()), ("parts", pa.list_(pa.struct(_PART_FIELDS)))])
_OUT_TYPE = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, parent_key binary, n_convs bigint, n_children bigint, n_leaves bigint, "
    f"saved_tokens bigint, ends string, key binary, path binary, parts {_PART_TYPE}"
)


def _told(paths: list[bytes], parts: list[list[tuple]], final: bool) -> Iterator[pa.RecordBatch]:
    """Arrow rows of a partition: its closed nodes, then the paths with entries that stay open (``conv_id`` null)."""
    if not paths:
        return
    flat = [(row, *p) for row, some in enumerate(parts) for p in some]
    columns = [np.array([f[c] for f in flat], np.int64) for c in range(7)]
    texts = [np.array([f[c] for f in flat] + [None], object)[:-1] for c in (7, 8)]
    found = peel(paths, Parts(*columns, *texts), final)
    count, width = len(found.nodes["conv_id"]), 1 << 16
    for at in range(0, count, width):
        some = [pa.array(found.nodes[name][at : at + width], kind) for name, kind in _NODE_FIELDS]
        size = len(some[0])
        yield pa.RecordBatch.from_arrays([*some, pa.nulls(size, pa.binary()), pa.nulls(size, _OUT.field("parts").type)], schema=_OUT)
    for side in (0, 1):
        mine = [entry[1:] for entry in found.open if entry[0] == side]
        if mine:
            path = paths[0 if side == 0 else -1][: max(e[0] for e in mine) * UNIT]
            entries = [{name: (int(v) if isinstance(v, np.integer) else v) for (name, _), v in zip(_PART_FIELDS, e)} for e in mine]
            yield pa.RecordBatch.from_arrays(
                [*(pa.nulls(1, kind) for _, kind in _NODE_FIELDS), pa.array([path], pa.binary()), pa.array([entries], _OUT.field("parts").type)], schema=_OUT
            )


def _first_round(final: bool):
    """Rows (path, block, ids), sorted, to nodes: ids of equal paths run through their digest as they come and aren't kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths, least, counts, digests = [], [], [], []
        for batch in batches:
            for path, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if not paths or paths[-1] != path:
                    paths.append(path)
                    least.append(ids[0])
                    counts.append(0)
                    digests.append(hashlib.sha256())
                digests[-1].update((("," if counts[-1] else "") + ",".join(map(str, ids))).encode())
                counts[-1] += len(ids)
        entries = [[(len(p) // UNIT, c, n, 0, 0, 0, d.hexdigest(), None)] for p, c, n, d in zip(paths, least, counts, digests)]
        yield from _told(paths, entries, final)

    return run


def _later_round(final: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths, entries = [], []
        for batch in batches:
            for path, some in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                paths.append(path)
                entries.append([tuple(p[name] for name, _ in _PART_FIELDS) for p in some])
        yield from _told(paths, entries, final)

    return run


def turn_unit(role: Column, text: Column) -> Column:
    """A turn as ``UNIT`` bytes in hex: half a SHA-256 of role and text, and the bytes of its text. Null counts as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    size = F.octet_length(text).cast("bigint")
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(" "), role, text), 256)
    return F.concat(F.substring(digest, 1, 32), F.lpad(F.hex(size), 16, "0"))


def conversation_turns(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, units)``: the turns of each conversation in order, each as its unit in hex.

    Turns are in order of ``turn``, null first, equal ones by role, then text; rows without
    a conversation id are left out.
    """
    plain = rows.select(*(c.alias(n) for c, n in zip(named([conv_id, turn, role, text]), ("conv_id", "turn", "role", "text")))).where("conv_id is not null")
    plain = plain.withColumn("conv_id", F.col("conv_id").cast("bigint"))
    unit = turn_unit(F.col("role"), F.col("text")).alias("unit")
    turns = plain.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", unit))).alias("turns"))
    numbers = F.col("turns")["turn"]
    tied = F.size(F.array_distinct(numbers)) < F.size(numbers)
    # texts travel only where they are needed to order turns of one number
    again = plain.join(turns.where(tied).select("conv_id"), "conv_id", "left_semi")
    again = again.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), unit))).alias("turns")
    )
    units = lambda some: some.select("conv_id", F.col("turns")["unit"].alias("units"))
    return units(turns.where(~tied)).unionByName(units(again))


def prefix_trie(conversations: DataFrame, part_rows: int | None = None, conv_id: str = "conv_id", units: str = "units") -> DataFrame:
    """One row per node of the trie of ``conversations``, which hold a bigint id and the turns as units in hex.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (the parent's, null at the
    root), ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes of the subtree, itself
    included), ``saved_tokens`` (over the subtree, members but one times the bytes of the
    node's last text), ``ends_sha256`` (of the decimal ids that end at the node, ascending,
    joined by commas; of nothing, if none do).

    Paths are dealt to tasks by range, so a task has neighbours in the trie, and a hot first
    turn or prefix is spread over as many tasks as its conversations fill. Each task peels
    its paths from the deepest level up (:func:`peel`). Only nodes on the first and last
    path of a task can reach into another one; they stay open, two paths per task, and are
    peeled again in a round of fewer tasks, until one task is left, which has two paths per
    task of the round before. Copies of one conversation collapse first, to lists of ids of
    at most 65,536, which stream through the digest; its order is the one thing that ties
    all ids of a node to one task.

    Turns are equal if role and text are; a digest of 128 bits stands for them. Conversations
    without turns end at the root; null ids are left out; ids are expected once (repeated
    rows of one id count as so many members); an empty table has no nodes, not even a root.
    """
    spark = conversations.sparkSession
    path = F.unhex(F.array_join(named([units])[0], "")).alias("path")
    rows = conversations.select(named([conv_id])[0].cast("bigint").alias("conv_id"), path).where("conv_id is not null")
    block = F.floor(F.col("conv_id") / _IDS_BLOCK).alias("block")
    base = stored(rows.groupBy("path", block).agg(F.array_sort(F.collect_list("conv_id")).alias("ids")))
    count = base.count()
    part_rows = part_rows or min(1 << 16, max(4096, count // 10_000))
    rounds, width = [], max(1, -(-count // part_rows))
    # one task is told by coalesce, which no setting turns into several
    deal = lambda some: some.coalesce(1) if width == 1 else some.repartitionByRange(width, "path")
    now, run = deal(base).sortWithinPartitions("path", "block"), _first_round(width == 1)
    while True:
        out = stored(now.mapInArrow(run, _OUT_TYPE))
        rounds.append(out.where("conv_id is not null"))
        if width == 1:
            break
        left = out.where("conv_id is null").select("path", "parts")
        width = min(-(-2 * width // part_rows), width // 2)
        now, run = deal(left).sortWithinPartitions("path"), _later_round(width == 1)
    nodes = rounds[0]
    for more in rounds[1:]:
        nodes = nodes.unionByName(more)
    nodes = nodes.drop("path", "parts")
    names = nodes.where("key is not null").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("named_conv_id"))
    if names.count() <= _BROADCAST_ROWS:
        names = F.broadcast(names)
    waiting = nodes.where("parent_key is not null").join(names, "parent_key", "left").withColumn("parent_conv_id", F.col("named_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256")]
    return nodes.where("parent_key is null").select(*columns).unionByName(waiting.select(*columns))
