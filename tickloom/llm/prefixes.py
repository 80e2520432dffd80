"""Prefix trie of conversations, with count-min screening.

Every conversation is rebuilt as the first turns of its family's first conversation
followed by its own later turns (a fixed rule of conv_id); the trie's nodes are the
distinct sequences of first turns.

1. A turn becomes 16 bytes of its SHA-256 and a word count; texts never move. Turns
   are range-partitioned by conv_id and turn, so a conversation of any length is
   dealt over tasks. What a task must know of those before it (position in a
   conversation, first turns of the family) follows from one summary per task.
2. A prefix is named by its depth and 128 bits: the XOR of the mixed digests of its
   turns and their depths.
3. Names are counted in a count-min sketch whose counters stop at two. An estimate
   of one proves that no other conversation has the prefix, and then none has a
   longer one: such tails become nodes where they are. Only prefixes estimated at
   two or more are shuffled and grouped exactly.
4. A node's sums over its subtree are sums over its members: each node in it is
   booked with its smallest member, and a member's bookings from a depth on are
   summed along its own prefixes.

A sketch that is too full (its size is bounded) only sends more prefixes to step 3's
exact grouping.
"""

from __future__ import annotations

import hashlib
import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tickloom.llm.common import WORD, mixed, stored, tasks

FAMILY = 20
MAX_SHARED = 4
#: Counters a row of the sketch may have (one bit each where it is used), and counters per prefix below that.
SKETCH_BITS = 28
LOAD = 8
#: Counters merged together; their numbers fit 16 bits.
SLICE = 1 << 16
#: Turns of a packed block, and turns dealt to a task (about).
BLOCK_ROWS = 1 << 17
TASK_ROWS = 250_000
#: Depths of a conversation summed in one window, and bits of conv_ids gathered in one string.
DEPTHS = 4096
ID_BITS = 13

BLOCKS = "chunk int, block int, conv_id binary, a binary, b binary, words binary"
SCREENED = "conv_id long, depth long, a long, b long, words long, last boolean, kind int"
CELLS = "slice int, once binary, more binary"
#: Kinds of screened rows: shared by estimate; proven alone below such a prefix; proven alone below another; no turn at all.
SHARED, FIRST_ALONE, ALONE, TURNLESS = range(4)
NODE = ["a", "b", "depth"]
RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


# Turns in order, in packed blocks.

def turn_blocks(conversations: DataFrame) -> DataFrame:
    """Turns sorted by family, conv_id and turn (null first, ties by digest), packed into blocks and written once."""
    text, role = (F.coalesce(F.col(c), F.lit("")) for c in ("text", "role"))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), digest.substr(1, 16).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"), F.monotonically_increasing_id().alias("row"))
    offset = F.col("conv_id") % FAMILY  # a family's first conversation comes first, also among negative numbers
    order = [F.col("conv_id") - offset, F.abs(offset), F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("row")]
    parts = max(tasks(conversations.sparkSession), -(-conversations.count() // TASK_ROWS))
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("conv_id", "digest", "words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, block, held, size = TaskContext.get().partitionId(), 0, [], 0

        def packed() -> pa.RecordBatch:
            conv, lanes, words = (np.concatenate(c) for c in zip(*held))
            values = [chunk, block, *(np.ascontiguousarray(c).tobytes() for c in (conv, lanes[:, 0], lanes[:, 1], words))]
            kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], _names(BLOCKS))

        for batch in batches:
            if not batch.num_rows:
                continue
            lanes = np.frombuffer(b"".join(batch.column("digest").to_pylist()), "<i8").reshape(-1, 2)
            held.append((batch.column("conv_id").to_numpy(), lanes, batch.column("words").to_numpy()))
            size += batch.num_rows
            if size >= BLOCK_ROWS:
                yield packed()
                block, held, size = block + 1, [], 0
        if held:
            yield packed()

    return stored(dealt.mapInArrow(run, BLOCKS), "turn-blocks")


# What a block must know of those before it.

@dataclass
class Head:
    """A conversation as far as it has been seen: its turns so far, and the first of them as (a, b, words)."""

    conv_id: int | None = None
    seen: int = 0
    first: list[tuple[int, int, int]] = field(default_factory=list)

    def and_then(self, later: Head) -> Head:
        """This conversation continued by what a later block holds of it, or the later one if it is another."""
        if later.conv_id != self.conv_id:
            return later
        return Head(self.conv_id, self.seen + later.seen, (self.first + later.first)[: MAX_SHARED - 1])


@dataclass
class State:
    """At the start of a block: the last conversation, its family's first one, the digest of its last prefix.

    ``total`` counts all turns of the conversation the block ends in.
    """

    now: Head = field(default_factory=Head)
    base: Head = field(default_factory=Head)
    a: int = 0
    b: int = 0
    total: int = 0


def _base(conv_id: int) -> int:
    """The family's first conv_id, with the sign rule of SQL's remainder."""
    return conv_id - (conv_id % FAMILY if conv_id >= 0 else -(-conv_id % FAMILY))


def _shared_turns(conv_id: int) -> int:
    """How many turns a conversation takes from its family's first one; that itself takes all its turns as its own."""
    return 0 if conv_id == _base(conv_id) else zlib.crc32(str(conv_id).encode()) % MAX_SHARED


class Block:
    """The columns of a packed block, cut into conversations."""

    def __init__(self, row: dict):
        self.conv, self.words = (np.frombuffer(row[c], "<i8") for c in ("conv_id", "words"))
        self.a, self.b = (np.frombuffer(row[c], "<u8") for c in ("a", "b"))
        self.starts = np.concatenate(([0], np.flatnonzero(np.diff(self.conv)) + 1))
        self.lengths = np.diff(np.append(self.starts, len(self.conv)))
        self.ids = self.conv[self.starts].tolist()

    def head(self, i: int) -> Head:
        """The i-th conversation, as this block holds it."""
        first, n = int(self.starts[i]), int(self.lengths[i])
        rows = slice(first, first + min(n, MAX_SHARED - 1))
        return Head(self.ids[i], n, list(zip(self.a[rows].tolist(), self.b[rows].tolist(), self.words[rows].tolist())))

    def summary(self) -> tuple[Head, Head, Head]:
        """The first and last conversation, and the first one of the last one's family (of no turn, if it is not here)."""
        base = _base(self.ids[-1])
        at = np.flatnonzero(self.conv[self.starts] == base)
        return self.head(0), self.head(len(self.ids) - 1), self.head(int(at[0])) if len(at) else Head(base)


def _states(blocks: DataFrame) -> DataFrame:
    """The state at the start of every block: columns chunk, block, state and whether the block's last conversation goes on.

    The driver folds one summary per block (of ``BLOCK_ROWS`` turns).
    """
    spark = blocks.sparkSession

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pylist(
                    [{"chunk": row["chunk"], "block": row["block"], "state": pickle.dumps(Block(row).summary())}],
                    pa.schema([("chunk", pa.int32()), ("block", pa.int32()), ("state", pa.binary())]))

    found = sorted(blocks.mapInArrow(summaries, "chunk int, block int, state binary").collect(), key=lambda r: (r.chunk, r.block))
    parts = [pickle.loads(r.state) for r in found]
    states, now, base = [], Head(), Head()
    for first, last, family in parts:
        states.append(State(now, base))
        if family.conv_id == now.conv_id and family.seen:
            base = now.and_then(family)
        elif family.seen or family.conv_id != base.conv_id:
            base = family
        # The last conversation continues the one before only if it is also the first.
        now = now.and_then(last)
    for k in reversed(range(len(states))):  # turns of the conversation a block ends in, those of later blocks included
        last = parts[k][1]
        follows = k + 1 < len(parts) and parts[k + 1][0].conv_id == last.conv_id
        if not follows:
            states[k].total = now.seen if k + 1 == len(parts) else states[k + 1].now.seen
        elif parts[k + 1][1].conv_id == last.conv_id:
            states[k].total = states[k + 1].total
        else:
            states[k].total = states[k + 1].now.seen + parts[k + 1][0].seen
    goes_on = [p[1].conv_id == n[0].conv_id for p, n in zip(parts, parts[1:])] + [False] * bool(parts)

    def frame() -> DataFrame:
        rows = [(r.chunk, r.block, bytearray(pickle.dumps(s)), g) for r, s, g in zip(found, states, goes_on)]
        return spark.createDataFrame(rows, "chunk int, block int, state binary, goes_on boolean")

    if any(goes_on):  # the digest so far of conversations that cross blocks
        def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    a, b = rebuilt(Block(row), pickle.loads(row["state"]))[-1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["chunk"]], pa.int32()), pa.array([row["block"]], pa.int32()),
                         pa.array([a], pa.uint64()).view(pa.int64()), pa.array([b], pa.uint64()).view(pa.int64())], ["chunk", "block", "a", "b"])

        crossing = blocks.join(frame().filter("goes_on"), ["chunk", "block"])
        ends = {(r.chunk, r.block): (r.a % 2**64, r.b % 2**64) for r in crossing.mapInArrow(digests, "chunk int, block int, a long, b long").collect()}
        a = b = 0
        for r, state, (first, last, _), on in zip(found, states, parts, goes_on):
            state.a, state.b = a, b
            x, y = ends.get((r.chunk, r.block), (0, 0))
            inside = first.conv_id == last.conv_id and first.conv_id == state.now.conv_id
            a, b = (x ^ a * inside, y ^ b * inside) if on else (0, 0)
    return frame()


_STEP = np.uint64(0x9E3779B97F4A7C15)


def _placed(lane: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """A turn's part in a prefix: its digest mixed with its depth."""
    with np.errstate(over="ignore"):
        return mixed(lane ^ mixed(depth.astype(np.uint64) * _STEP))


def rebuilt(block: Block, state: State) -> tuple:
    """The prefixes of the rebuilt conversations that end in this block.

    Arrays conv_id, depth, a, b (the prefix), parent's a and b, words of the last
    turn, whether the conversation ends there; then the digest of the last prefix,
    relative to the block's start if the block lies inside one conversation. A
    conversation rebuilt without turns has one row of depth 0.
    """
    goes_on = block.ids[0] == state.now.conv_id
    seen = state.now.seen if goes_on else 0
    totals = block.lengths.copy()
    totals[0] += seen
    totals[-1] = state.total
    base = state.base
    if goes_on and base.conv_id is None:
        base = Head()
    shared, taken = np.zeros(len(block.ids), np.int64), np.zeros(len(block.ids), np.int64)
    owners, turns = [], []  # shared turns taken from the family's first conversation
    for i, conv_id in enumerate(block.ids):
        family = _base(conv_id)
        if conv_id == family:
            base = state.now.and_then(block.head(i)) if i == 0 else block.head(i)
        else:
            shared[i] = _shared_turns(conv_id)
            if base.conv_id == family:
                first = base.first[: shared[i]]
                taken[i] = len(first)
                owners += [i] * len(first)
                turns += first
    # Turns taken from the family come first.
    owner = np.array(owners, np.int64)
    lanes = np.array([t[:2] for t in turns], np.uint64).reshape(-1, 2)
    head_words = np.array([t[2] for t in turns], np.int64)
    head_depth = np.arange(len(owner)) - (np.cumsum(taken) - taken)[owner] + 1
    i = np.repeat(np.arange(len(block.ids)), block.lengths)
    position = np.arange(len(block.conv)) - block.starts[i] + 1
    position[: block.lengths[0]] += seen
    depth = position - shared[i] + taken[i]
    own = position > shared[i]
    columns = []
    for k, lane in enumerate((block.a, block.b)):
        parts = _placed(lanes[:, k], head_depth)
        heads, ends = _running(parts, taken)
        start = ends.copy()
        if goes_on:
            start[0] = (state.a, state.b)[k]
        placed = np.where(own, _placed(lane, depth), np.uint64(0))
        inner, _ = _running(placed, block.lengths)
        prefix = inner ^ start[i]
        columns.append((heads, heads ^ parts, prefix, prefix ^ placed))
    if goes_on:  # its first turns were given out where it starts
        new = owner > 0
        owner, head_depth, head_words = owner[new], head_depth[new], head_words[new]
        columns = [(h[new], hp[new], p, pp) for h, hp, p, pp in columns]
    none = (taken == 0) & (totals <= shared)
    none[0] &= not goes_on
    none = np.flatnonzero(none)
    zero, ids = np.zeros(len(none), np.uint64), np.array(block.ids, np.int64)
    out = (
        np.concatenate((ids[owner], block.conv[own], ids[none])),
        np.concatenate((head_depth, depth[own], np.zeros(len(none), np.int64))),
        *(np.concatenate((h, p[own], zero)) for h, _, p, _ in columns),
        *(np.concatenate((hp, pp[own], zero)) for _, hp, _, pp in columns),
        np.concatenate((head_words, block.words[own], np.zeros(len(none), np.int64))),
        np.concatenate(((head_depth == taken[owner]) & (totals <= shared)[owner], (position == totals[i])[own], np.ones(len(none), bool))),
    )
    return *out, tuple(int(p[-1]) for _, _, p, _ in columns)


def _running(values: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running XOR inside runs of the given lengths, and the XOR of each run."""
    whole = np.concatenate((np.zeros(1, np.uint64), np.bitwise_xor.accumulate(values))) if len(values) else np.zeros(1, np.uint64)
    stops = np.cumsum(lengths)
    before = whole[stops - lengths]
    return whole[1:] ^ np.repeat(before, lengths), whole[stops] ^ before


# The sketch.

def _sketch(blocks: DataFrame, prefixes: int) -> tuple[int, bytes]:
    """Bits of a counter's number, and one bit per counter of both rows: two or more."""
    bits = min(SKETCH_BITS, max(16, (LOAD * prefixes - 1).bit_length()))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, depth, a, b, *_ = rebuilt(Block(row), pickle.loads(row["state"]))
                for k, lane in enumerate((a[depth > 0], b[depth > 0])):
                    cell, n = np.unique((lane >> np.uint64(64 - bits)).astype(np.int64), return_counts=True)
                    slices, firsts = np.unique(cell // SLICE, return_index=True)
                    low, found = (cell % SLICE).astype("<u2"), []
                    for s, first, stop in zip(slices.tolist(), firsts.tolist(), [*firsts.tolist()[1:], len(cell)]):
                        part, once = low[first:stop], n[first:stop] == 1
                        found.append({"slice": (k << (bits - 16)) + s, "once": part[once].tobytes(), "more": part[~once].tobytes()})
                    yield pa.RecordBatch.from_pylist(found, pa.schema([("slice", pa.int32()), ("once", pa.binary()), ("more", pa.binary())]))

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts = None, np.zeros(SLICE, np.uint8)

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([np.packbits(counts > 1).tobytes()])], ["slice", "bits"])

        for batch in batches:
            for row in batch.to_pylist():
                if row["slice"] != now:
                    if now is not None:
                        yield done()
                    now = row["slice"]
                    counts[:] = 0
                once = np.frombuffer(row["once"], "<u2")  # each cell once
                counts[once] = np.minimum(counts[once] + 1, 2)
                counts[np.frombuffer(row["more"], "<u2")] = 2
        if now is not None:
            yield done()

    dealt = blocks.mapInArrow(cells, CELLS).repartition("slice").sortWithinPartitions("slice")
    sketch = np.zeros((2 << (bits - 16), SLICE // 8), np.uint8)
    for row in dealt.mapInArrow(merged, "slice int, bits binary").toLocalIterator():
        sketch[row.slice] = np.frombuffer(row.bits, np.uint8)
    return bits, sketch.tobytes()


def _alone(sketch: tuple[int, np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the estimate, the lesser of both counters, is one."""
    bits, cells = sketch
    many = np.ones(len(a), bool)
    for k, lane in enumerate((a, b)):
        cell = (lane >> np.uint64(64 - bits)).astype(np.int64) + (k << bits)
        many &= (cells[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 > 0
    return ~many


def _screened(blocks: DataFrame, sketch: tuple[int, bytes]) -> DataFrame:
    """All prefixes by kind; those proven alone need no name any more."""
    sent = blocks.sparkSession.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value[0], np.frombuffer(sent.value[1], np.uint8)
        for batch in batches:
            for row in batch.to_pylist():
                conv, depth, a, b, pa_, pb, words, last, _ = rebuilt(Block(row), pickle.loads(row["state"]))
                alone = _alone(known, a, b)
                parent = (depth <= 1) | _alone(known, pa_, pb)
                kind = np.where(depth == 0, TURNLESS, np.where(~alone, SHARED, np.where(parent, ALONE, FIRST_ALONE))).astype(np.int32)
                unnamed = (kind == FIRST_ALONE) | (kind == ALONE)
                for first in range(0, len(conv), 20_000):
                    part = slice(first, first + 20_000)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(conv[part]), pa.array(depth[part]), pa.array(a[part].view(np.int64), mask=unnamed[part]),
                        pa.array(b[part].view(np.int64), mask=unnamed[part]), pa.array(words[part]), pa.array(last[part]), pa.array(kind[part])],
                        _names(SCREENED))

    return stored(blocks.mapInArrow(run, SCREENED), "prefixes")


# Exact grouping.

def _ends(rows: DataFrame) -> DataFrame:
    """SHA-256 of the ascending conv_ids of each node's rows, joined by commas.

    Ids are gathered in strings of at most 2**ID_BITS; a digest runs over a node's strings one after another.
    """
    strings = rows.groupBy(*NODE, F.shiftright("conv_id", ID_BITS).alias("part")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    strings = strings.select(*NODE, "part", F.array_join(F.transform("ids", lambda c: c.cast("string")), ",").alias("ids"))
    dealt = strings.repartition(*NODE).sortWithinPartitions(*NODE, "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            found = []
            keys = zip(*(batch.column(c).to_pylist() for c in NODE))
            for key, ids in zip(keys, batch.column("ids").to_pylist()):
                if key != now:
                    if now is not None:
                        found.append((*now, digest.hexdigest()))
                    now, digest = key, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield _rows(found)
        if now is not None:
            yield _rows([(*now, digest.hexdigest())])

    def _rows(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [*[pa.int64()] * 3, pa.string()])], [*NODE, "ends_sha256"])

    return dealt.mapInArrow(run, "a long, b long, depth long, ends_sha256 string")


def _along(frames: DataFrame) -> DataFrame:
    """For each row of a conversation, by depth: bookings from here on, the parent's smallest member, whether the next node is booked here.

    Windows hold at most ``DEPTHS`` rows; longer conversations add what lies in their other windows.
    """
    frames = frames.withColumn("part", F.floor((F.col("depth") - 1) / DEPTHS))
    order = Window.partitionBy("conv_id", "part").orderBy("depth")
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = frames.select(
        "*", F.sum("saved").over(onward).alias("saved_on"), F.max("leaf").over(onward).alias("leaf_on"),
        F.lag("depth").over(order).alias("before"), F.lag("rep").over(order).alias("rep_before"),
        F.lead("depth").over(order).alias("after"), F.lead("booked").over(order).alias("booked_after"))
    longer = frames.filter(F.col("depth") > DEPTHS).select("conv_id").distinct()
    if not longer.isEmpty():
        parts = frames.join(longer, "conv_id", "left_semi").groupBy("conv_id", "part").agg(
            F.sum("saved").alias("s"), F.max("leaf").alias("l"), F.min("depth").alias("d_first"), F.max("depth").alias("d_last"),
            F.min_by("booked", "depth").alias("f"), F.max_by("rep", "depth").alias("r"))
        order = Window.partitionBy("conv_id").orderBy("part")
        later = order.rowsBetween(1, Window.unboundedFollowing)
        parts = parts.select("conv_id", "part", F.sum("s").over(later).alias("s"), F.max("l").over(later).alias("l"),
                             F.lag("d_last").over(order).alias("d_last"), F.lag("r").over(order).alias("r"),
                             F.lead("d_first").over(order).alias("d_first"), F.lead("f").over(order).alias("f"))
        names = rows.columns
        rows = rows.join(parts, ["conv_id", "part"], "left").withColumns({
            "saved_on": F.col("saved_on") + F.coalesce("s", F.lit(0)), "leaf_on": F.greatest("leaf_on", F.coalesce("l", F.lit(0))),
            "before": F.coalesce("before", "d_last"), "rep_before": F.coalesce("rep_before", "r"),
            "after": F.coalesce("after", "d_first"), "booked_after": F.coalesce("booked_after", "f")}).select(*names)
    return rows


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the prefix trie of rebuilt ``conversations`` (conv_id, turn, role, text).

    One row per distinct sequence of first turns, and one for the root: conv_id
    (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. Null roles and texts are empty; a null turn comes
    first, turns with equal numbers follow by digest, repeated rows are turns of
    their own; rows without conv_id belong to no conversation; a table without
    rows has no node. Other columns are not used.
    """
    spark = conversations.sparkSession
    packed = turn_blocks(conversations)
    states = _states(packed)
    blocks = packed.join(states.drop("goes_on"), ["chunk", "block"])
    turns = packed.agg(F.sum(F.octet_length("conv_id"))).first()[0] or 0
    rows = _screened(blocks, _sketch(blocks, max(1, turns // 8)))
    n_convs, smallest, children, leaves = rows.agg(
        F.count_if("last"), F.min("conv_id"), F.count_if((F.col("depth") == 1) & (F.col("kind") == ALONE)),
        F.count_if(F.col("last") & F.col("kind").isin(ALONE, FIRST_ALONE))).first()

    shared = rows.filter(F.col("kind") == SHARED)
    nodes = shared.groupBy(*NODE).agg(F.count("*").alias("n"), F.min("conv_id").alias("rep"), F.count_if("last").alias("n_ends"),
                                      F.max("words").alias("node_words"))
    nodes = stored(nodes, "prefix-nodes")
    more_children, more_leaves, saved = nodes.agg(
        F.count_if(F.col("depth") == 1), F.count_if(F.col("n") == F.col("n_ends")), F.sum((F.col("n") - 1) * F.col("node_words"))).first()
    booked = F.col("rep") == F.col("conv_id")
    members = shared.join(nodes, NODE).select(
        "conv_id", *NODE, "kind", "last", "n", "rep", booked.cast("int").alias("booked"),
        F.when(booked, (F.col("n") - 1) * F.col("node_words")).otherwise(F.lit(0)).alias("saved"),
        (booked & (F.col("n") == F.col("n_ends"))).cast("int").alias("leaf"))
    tails = rows.filter(F.col("kind") == FIRST_ALONE).select(
        "conv_id", *NODE, "kind", "last", F.lit(1).cast("long").alias("n"), F.col("conv_id").alias("rep"), F.lit(1).alias("booked"),
        F.lit(0).cast("long").alias("saved"), F.lit(1).alias("leaf"))
    frames = stored(members.unionByName(tails), "prefix-members")
    parent = F.when(F.col("depth") == 1, F.lit(smallest)).when(F.col("before") == F.col("depth") - 1, F.col("rep_before")).otherwise(F.col("conv_id"))
    along = _along(frames).select(
        "*", parent.alias("parent_conv_id"),
        F.when(F.col("after") == F.col("depth") + 1, F.col("booked_after")).otherwise(F.lit(0)).alias("child"))
    along = stored(along, "prefix-sums")

    ended = rows.filter(F.col("last") & F.col("kind").isin(SHARED, TURNLESS)).select(*NODE, "conv_id")
    ends = _ends(ended)
    grouped = along.filter(F.col("kind") == SHARED).groupBy(*NODE).agg(
        F.min("rep").alias("conv_id"), F.min("parent_conv_id").alias("parent_conv_id"), F.min("n").alias("n_convs"),
        F.sum("child").alias("n_children"), F.sum("leaf_on").cast("long").alias("n_leaves"), F.sum("saved_on").alias("saved_tokens"))
    root = spark.range(1 if n_convs else 0).select(
        F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), F.lit(0).cast("long").alias("depth"), F.lit(smallest).cast("long").alias("conv_id"),
        F.lit(None).cast("long").alias("parent_conv_id"), F.lit(n_convs).cast("long").alias("n_convs"),
        F.lit(children + more_children).cast("long").alias("n_children"), F.lit(max(1, leaves + more_leaves)).cast("long").alias("n_leaves"),
        F.lit(saved or 0).cast("long").alias("saved_tokens"))
    named = grouped.unionByName(root).join(ends, NODE, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA)))

    def alone(frame: DataFrame, above: Column) -> DataFrame:
        return frame.select(
            "conv_id", "depth", above.cast("long").alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"),
            F.when(F.col("last"), 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
            F.lit(0).cast("long").alias("saved_tokens"),
            F.when(F.col("last"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(F.lit(EMPTY_SHA)).alias("ends_sha256"))

    proven = alone(rows.filter(F.col("kind") == ALONE), F.when(F.col("depth") == 1, F.lit(smallest)).otherwise(F.col("conv_id")))
    first = alone(along.filter(F.col("kind") == FIRST_ALONE), F.col("parent_conv_id"))
    return named.select(*RESULT).unionByName(first).unionByName(proven)
