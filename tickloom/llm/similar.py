"""Near copies by the Jaccard similarity of their word shingles: every pair at a least similarity links.

Method: documents whose SimHash fingerprints link (see ``simhash``) are candidates, and
as these miss pairs near the least similarity, so are those that agree in one of
``BANDS`` keys, each made of ``ROWS`` minima of the shingles' hashes; a pair at
similarity s is missed by the minima with probability (1 - s**ROWS)**BANDS, 5e-7 at
0.8. Groups of candidates are brought
together and compared shingle by shingle, so that a link is exact. In a group one
text is compared with all that are not yet linked, so a dense group gives a tree of
links and not all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import simhash
from tickloom.llm.common import components, each, mixed, stored, tasks, text_bytes, window_hashes, word_hashes

SHINGLE, LEAST = 5, 0.8
BANDS, ROWS = 48, 6
#: Odd multipliers, one for each minimum. Fixed values.
FACTORS = mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)
#: Shingles of one candidate group that a task takes at once; a larger group is dealt over pairs of parts.
RUN_SHINGLES = 2_000_000


def shingles(text: bytes | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``width`` words in lower case; of all words if there are fewer."""
    words = (text or b"").lower().split()
    return np.unique(window_hashes(word_hashes(words), min(width, len(words)))) if words else np.empty(0, np.uint64)


def band_keys(found: np.ndarray) -> np.ndarray:
    """One key per band of a set of hashes; none of an empty set."""
    if not len(found):
        return np.empty(0, np.uint64)
    spread, least = mixed(found), np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    with np.errstate(over="ignore"):
        for first in range(0, len(spread), 512):
            least = np.minimum(least, (FACTORS[:, None] * spread[None, first: first + 512]).min(axis=1))
        keys = np.arange(1, BANDS + 1, dtype=np.uint64)
        for row in least.reshape(BANDS, ROWS).T:
            keys = mixed(keys + row)
    return keys


def _node(found: np.ndarray) -> np.uint64:
    """A hash of the whole set; zero for the empty one."""
    return np.bitwise_xor.reduce(mixed(mixed(found) + np.uint64(len(found)))) if len(found) else np.uint64(0)


def link_run(sets: list[np.ndarray], least: float = LEAST) -> list[tuple[int, int]]:
    """A tree of links, as index pairs, for each group among ``sets`` (none empty)."""
    sizes = np.array([len(s) for s in sets])
    known, ids = np.unique(np.concatenate(sets), return_inverse=True)
    own, mark = np.split(ids, np.cumsum(sizes)[:-1]), np.zeros(len(known), bool)
    links, rest = [], np.arange(len(sets))
    while len(rest):
        ahead, rest = [int(rest[0])], rest[1:]
        while ahead and len(rest):
            x = ahead.pop()
            near = rest[np.minimum(sizes[rest], sizes[x]) + 1e-6 >= least * np.maximum(sizes[rest], sizes[x])]
            if not len(near):
                continue
            mark[own[x]] = True
            starts = np.concatenate(([0], np.cumsum(sizes[near])[:-1]))
            common = np.add.reduceat(mark[np.concatenate([own[i] for i in near])], starts, dtype=np.int64)
            mark[own[x]] = False
            found = near[common + 1e-6 >= least * (sizes[near] + sizes[x] - common)]
            if len(found):
                rest = rest[~np.isin(rest, found, assume_unique=True)]
                ahead += found.tolist()
                links += [(x, y) for y in found.tolist()]
    return links


def simhash_keys(nodes: DataFrame) -> DataFrame:
    """One key per node: its group of fingerprints ``fp`` that hang together by SimHash links."""
    groups = components(simhash.links(nodes.select("fp").distinct())).withColumnRenamed("node", "fp")
    return nodes.join(groups, "fp", "left").select("node", F.xxhash64(F.lit("simhash"), F.coalesce("root", "fp")).alias("key"))


def _candidates(nodes: DataFrame) -> DataFrame:
    """``node`` and ``root`` of the groups that hang together by common keys, of SimHash and of minima."""
    keyed = simhash_keys(nodes).unionByName(nodes.select("node", F.explode("keys").alias("key")))
    shared = keyed.groupBy("key").agg(F.min("node").alias("b"), F.max("node").alias("last")).filter("b <> last").select("key", "b")
    return components(keyed.join(shared, "key").filter("node <> b").select(F.col("node").alias("a"), "b").distinct())


def _links(texts: DataFrame, width: int, least: float, run_shingles: int) -> DataFrame:
    """Verified links a, b inside the groups ``root`` of ``texts`` (node, size, root, text)."""
    sizes = texts.groupBy("root").agg(F.sum("size").alias("n")).filter(F.col("n") > run_shingles)
    hot = sizes.select("root", F.ceil(2 * F.col("n") / run_shingles).cast("int").alias("parts"))
    parted = texts.join(hot, "root", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    parted = parted.withColumn("h", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    dealt = parted.select("node", "text", "root", "h", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("t"))
    dealt = dealt.select("root", F.least("h", "t").alias("p"), F.greatest("h", "t").alias("q"), "node", "text")
    dealt = dealt.repartition(tasks(texts.sparkSession), "root", "p", "q").sortWithinPartitions("root", "p", "q", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(names: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
            found = np.array(link_run(sets, least) if len(sets) > 1 else [], np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(np.array(names, np.int64)[found[:, k]]) for k in (0, 1)], ["a", "b"])

        now, names, sets = None, [], []
        for batch in batches:
            places = zip(*(batch.column(c).to_pylist() for c in ("root", "p", "q", "node")))
            for (*group, node), text in zip(places, each(batch.column("text"))):
                if group != now and names:
                    yield pairs(names, sets)
                if group != now:
                    now, names, sets = group, [], []
                if not names or names[-1] != node:
                    names.append(node)
                    sets.append(shingles(text, width))
        if names:
            yield pairs(names, sets)

    return dealt.mapInArrow(run, "a long, b long")


def first_of_each(docs: DataFrame, width: int = SHINGLE, least: float = LEAST, run_shingles: int = RUN_SHINGLES) -> DataFrame:
    """One document of each group that hangs together by pairs of similarity ``least`` or more: that with the smallest doc_id.

    Texts without words, null ones too, are copies of each other. Of rows that are
    equal in all columns one stays. Rows without a doc_id cannot be told apart and all
    stay. An empty table gives an empty table. The columns of ``docs`` stay, whatever
    their names: the input row travels as one struct.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    named = docs.filter("doc_id IS NOT NULL").select(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), whole.alias("whole"))
    named = named.select("__row", "whole", F.col("whole.doc_id").alias("doc_id"), F.col("whole.text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, sizes, keys, prints = [], [], [], []
            for text in each(batch.column("text")):
                found = shingles(text, width)
                prints.append(simhash.fingerprint(text))
                names.append(_node(found))
                sizes.append(len(found))
                keys.append(band_keys(found).view(np.int64))
            ends = np.cumsum([0, *map(len, keys)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("__row"), pa.array(np.array(names, np.uint64).view(np.int64)), pa.array(sizes, pa.int64()),
                 pa.array(np.array(prints, np.uint64).view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *keys])))],
                ["doc_id", "row", "node", "size", "fp", "keys"])

    rows = named.select(F.col("doc_id").cast("long"), "__row", text_bytes().alias("text")).mapInArrow(
        run, "doc_id long, row long, node long, size long, fp long, keys array<long>")
    nodes = stored(rows.groupBy("node").agg(
        F.min(F.struct("doc_id", "row")).alias("least"), F.first("size").alias("size"), F.min("fp").alias("fp"),
        F.first("keys").alias("keys")), "shingle-sets")
    near = _candidates(nodes).join(nodes.select("node", "size", F.col("least.row").alias("__row")), "node")
    roots = components(_links(named.select("__row", text_bytes().alias("text")).join(near, "__row"), width, least, run_shingles))
    labelled = nodes.select("node", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    kept = labelled.groupBy("root").agg(F.min("least").alias("k")).select(F.col("k.row").alias("__kept"), F.col("k.doc_id").alias("__id"))
    chosen = named.join(kept, (F.col("__row") == F.col("__kept")) & (F.col("doc_id") == F.col("__id")), "left_semi")
    return chosen.dropDuplicates(["doc_id", "__row"]).select("whole.*").unionByName(docs.filter("doc_id IS NULL"))
