"""SimHash near-duplicates: fingerprints, links at a small Hamming distance, and their groups.

Method: pivot distance tables. Fingerprints that may link are brought together by
exact keys: with ``blocks`` blocks and at most ``distance`` differing bits, at
least ``blocks - distance`` blocks are equal (blocks - distance are in no link
missed), so every choice of that many blocks is a key. Inside a run of one key the
distances of each fingerprint to the reference fingerprints are computed once; a
pair whose distances differ by more than ``distance`` at any reference cannot link
(triangle inequality) and is discarded; survivors are verified bit by bit. A long
run is explored from fingerprint to fingerprint, those already reached being left
out, so that a dense group gives a tree of links and not all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import components, each, stored, tasks, text_bytes

SHINGLE, DISTANCE, SEED = 4, 4, 42
#: Reference fingerprints: the hashes of 0, 1, 2, ...
PIVOTS = np.array([xxhash.xxh64_intdigest(bytes([i]), SEED) for i in range(16)], np.uint64)
#: Fingerprints of one key that a task takes at once; a larger run is dealt over pairs of parts.
RUN_ROWS = 20_000


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of a text; zero if it has no word."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1:].tolist())
    hashes = np.fromiter([digest(joined[a:b], SEED) for a, b in pairs], np.uint64)
    total, n = np.zeros(64, np.int64), len(hashes)
    for first in range(0, n, 65_280):  # bits are spread out for so many hashes at once
        bits = np.unpackbits(hashes[first: first + 65_280].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        # 255 ones still fit a byte.
        total += np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint's bits as a long) of every row; a null text counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t, shingle) for t in each(batch.column("text"))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), text_bytes().alias("text")).mapInArrow(run, "doc_id long, fp long")


def _keys(blocks: int, distance: int):
    """An array column with one key for each choice of blocks that a link must leave equal in some choice."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - distance)):
        key, used = F.lit(number).cast("long"), 0
        for block in chosen:
            width = edges[block + 1] - edges[block]
            part = F.shiftrightunsigned("fp", edges[block]).bitwiseAND(F.lit((1 << width) - 1))
            key, used = F.shiftleft(key, width).bitwiseOR(part), used + width
        keys.append(key)
    return F.array(*keys)


def _near(x: int, others: np.ndarray, prints: np.ndarray, table: np.ndarray, distance: int) -> np.ndarray:
    """Those of ``others`` that link to x: by the pivot table first, survivors by their bits."""
    for columns in (slice(0, 1), slice(1, 4), slice(4, None)):
        others = others[(np.abs(table[others, columns] - table[x, columns]) <= distance).all(axis=1)]
    return others[np.bitwise_count(prints[others] ^ prints[x]) <= distance]


def link_run(prints: np.ndarray, table: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """A tree of links, as index pairs, for each group among ``prints``."""
    links, rest = [], np.arange(len(prints))
    while len(rest):
        ahead, rest = [int(rest[0])], rest[1:]
        while ahead and len(rest):
            x = ahead.pop()
            found = _near(x, rest, prints, table, distance)
            if len(found):
                rest = rest[~np.isin(rest, found, assume_unique=True)]
                ahead += found.tolist()
                links += [(x, y) for y in found.tolist()]
    return links


def _link_sorted(runs: np.ndarray, prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside runs of equal (sorted) ``runs``."""
    table = np.bitwise_count(prints[:, None] ^ PIVOTS[None, :]).astype(np.int8)
    starts = np.flatnonzero(np.concatenate(([True], runs[1:] != runs[:-1])))
    sizes = np.diff(np.append(starts, len(runs)))
    left, right = [], []
    short = np.repeat(sizes <= 16, sizes)
    for step in range(1, 16):
        at = np.flatnonzero((runs[:-step] == runs[step:]) & short[:-step])
        if not len(at):
            break
        at = at[(np.abs(table[at] - table[at + step]) <= distance).all(axis=1)]
        at = at[np.bitwise_count(prints[at] ^ prints[at + step]) <= distance]
        left.append(prints[at])
        right.append(prints[at + step])
    for start, size in zip(starts[sizes > 16].tolist(), sizes[sizes > 16].tolist()):
        inside = prints[start: start + size]
        pairs = np.array(link_run(inside, table[start: start + size], distance), np.int64).reshape(-1, 2)
        left.append(inside[pairs[:, 0]])
        right.append(inside[pairs[:, 1]])
    none = [np.empty(0, np.uint64)]
    return np.concatenate(left or none), np.concatenate(right or none)


def links(prints: DataFrame, distance: int = DISTANCE, blocks: int | None = None, run_rows: int = RUN_ROWS) -> DataFrame:
    """Links a, b between distinct fingerprints (column ``fp``) that join all groups at ``distance`` or fewer bits.

    Not every pair is returned: inside a dense run a tree of verified links is.
    The number of blocks only moves work between keys and runs; by default it
    follows the number of fingerprints. Runs above ``run_rows`` are dealt over
    pairs of parts, so no task gathers more than that and no pair is missed.
    """
    if blocks is None:
        n = prints.count()
        blocks = distance + (2 if n < 1 << 25 else 3 if n < 1 << 31 else 4)
    keyed = prints.select("fp", F.explode(_keys(blocks, distance)).alias("key"))
    hot = keyed.groupBy("key").count().filter(F.col("count") > run_rows)
    hot = hot.select("key", F.ceil(2 * F.col("count") / run_rows).cast("int").alias("parts"))
    parted = keyed.join(hot, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    parted = parted.withColumn("h", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    dealt = parted.select("fp", "key", "h", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("t"))
    dealt = dealt.select("fp", "key", F.least("h", "t").alias("p"), F.greatest("h", "t").alias("q"))
    dealt = dealt.repartition(tasks(prints.sparkSession), "key", "p", "q").sortWithinPartitions("key", "p", "q", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            new = (keys[1:] != keys[:-1]).any(axis=1)
            a, b = _link_sorted(np.concatenate(([0], np.cumsum(new))), fps, distance)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        keys, fps = np.empty((0, 3), np.int64), np.empty(0, np.uint64)
        for batch in batches:
            more = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("key", "p", "q")], axis=1)
            keys = np.concatenate((keys, more))
            fps = np.concatenate((fps, batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)))
            # The last run may go on in the next batch.
            open_run = int(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1))[-1]) + 1 if (keys[1:] != keys[:-1]).any() else 0
            if open_run:
                yield pairs(keys[:open_run], fps[:open_run])
                keys, fps = keys[open_run:], fps[open_run:]
        if len(fps):
            yield pairs(keys, fps)

    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id reachable over links of at most
    ``distance`` differing bits. Null, empty and blank texts have fingerprint zero
    and link like others. A null doc_id is never a component_id unless its group
    has no other; repeated rows stay. No row: no row.
    """
    rows = stored(fingerprints(docs, shingle), "fingerprints")
    least = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints-distinct")
    roots = components(links(least.select("fp"), distance))
    labelled = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    found = labelled.select("fp", "root").join(ids, "root").select("fp", "component_id")
    return rows.join(found, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def first_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One document of each group of near-duplicates: the one whose doc_id names the group.

    doc_id says which document a row is: of rows that repeat it one stays. Rows
    without a doc_id cannot be told apart and all stay.
    """
    found = near_duplicates(docs.filter("doc_id IS NOT NULL"), shingle, distance)
    kept = found.filter("doc_id = component_id").select("doc_id")
    named = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.unionByName(docs.filter("doc_id IS NULL"))
