"""Removal of passages that an earlier document holds too.

Method: Rabin-Karp hashes of every window of ``width`` words, counted in Spark;
repeated windows merge into maximal removal intervals.

Rows are dealt into chunks by a hash of the row. A chunk computes its windows and
keeps each different one once, with its smallest doc_id, so a passage that a third
of all documents share counts once per chunk. Windows go to buckets by their hash
as packed arrays, and one bit per window comes back: whether a smaller doc_id of
another chunk has it. The chunk then takes the same windows again and cuts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import BASES, mixed, tasks, text_bytes, window_hashes, word_hashes

WIDTH = 13
WINDOW = WIDTH
#: Chunks per partition of the exchange: small enough to be held at once, many enough to be dealt evenly.
CHUNKS = 4
#: Stands for a null doc_id, which is smaller than none.
NO_ID = np.int64(2**63 - 1)


class Windows:
    """The windows of a chunk of documents."""

    def __init__(self, ids: np.ndarray, texts: list, width: int):
        self.words = [(t or b"").split() for t in texts]
        self.lengths = np.fromiter(map(len, self.words), np.int64, len(texts))
        self.width = width
        values = np.concatenate([np.empty(0, np.uint64), *map(word_hashes, self.words)])
        main, check = window_hashes(values, width), window_hashes(mixed(values), width, BASES[1])
        doc = np.repeat(np.arange(len(texts)), self.lengths)
        #: Place of each window's first word in the chunk; windows stay inside a document.
        self.at = np.flatnonzero(doc[: len(main)] == doc[width - 1:]) if len(main) else np.empty(0, np.int64)
        main, check = main[self.at], (check[self.at] >> np.uint64(48)).astype(np.uint16)
        self.owner = ids[doc[self.at]]
        order = np.argsort(main, kind="stable")
        same = main[order][1:] == main[order][:-1]
        if (check[order][1:] != check[order][:-1])[same].any():  # the rolling hashes of two different windows agree
            order = np.lexsort((check, main))
            same = (main[order][1:] == main[order][:-1]) & (check[order][1:] == check[order][:-1])
        first = np.flatnonzero(np.concatenate(([True], ~same))) if len(order) else np.empty(0, np.int64)
        #: The different windows in order: hash, a second hash, smallest doc_id; and the entry of each window.
        self.main, self.check = main[order][first], check[order][first]
        self.least = np.minimum.reduceat(self.owner[order], first) if len(first) else np.empty(0, np.int64)
        self.entry = np.empty(len(order), np.int64)
        self.entry[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))

    def buckets(self, n: int) -> np.ndarray:
        """Where each bucket's entries begin: buckets are ranges of the hash, which is sorted."""
        edges = np.array([(i << 64) // n for i in range(1, n)], np.uint64)
        return np.concatenate(([0], np.searchsorted(self.main, edges), [len(self.main)]))

    def cut(self, elsewhere: np.ndarray) -> Iterator[tuple[int, int, bytes, list[tuple[int, int]]]]:
        """Per document: words, removed words, what is left, and the intervals that go."""
        gone = elsewhere[self.entry] | (self.least[self.entry] < self.owner)
        change = np.zeros(int(self.lengths.sum()) + self.width + 1, np.int32)
        np.add.at(change, self.at[gone], 1)
        np.add.at(change, self.at[gone] + self.width, -1)
        covered = np.cumsum(change) > 0
        start = 0
        for words, n in zip(self.words, self.lengths.tolist()):
            mask = covered[start: start + n]
            start += n
            removed = int(mask.sum())
            if not removed:
                yield n, 0, b" ".join(words), []
                continue
            edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
            kept = [words[i] for i in np.flatnonzero(~mask).tolist()]
            yield n, removed, b" ".join(kept), list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def _packed(sorted_hashes: np.ndarray) -> bytes:
    """Differences of sorted hashes, byte plane by byte plane: the upper planes are nearly empty."""
    steps = np.diff(sorted_hashes, prepend=np.uint64(0))
    return zlib.compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes()[::-1], 1)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data)[::-1], np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _earlier_elsewhere(main: np.ndarray, check: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Of windows from many chunks, those that a smaller doc_id has."""
    out = np.zeros(len(main), bool)
    order = np.argsort(main)
    same = main[order][1:] == main[order][:-1]
    repeated = order[np.concatenate((same, [False])) | np.concatenate(([False], same))] if len(main) else order
    if not len(repeated):
        return out
    repeated = repeated[np.lexsort((check[repeated], main[repeated]))]
    m, c = main[repeated], check[repeated]
    first = np.flatnonzero(np.concatenate(([True], (m[1:] != m[:-1]) | (c[1:] != c[:-1]))))
    smallest = np.repeat(np.minimum.reduceat(least[repeated], first), np.diff(np.append(first, len(m))))
    out[repeated] = smallest < least[repeated]
    return out


def without_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Cut every word covered by a window of ``width`` words that also starts in a document of smaller doc_id.

    Returns per row: doc_id, n_words, n_removed, kept (the words left, joined by
    one space) and intervals (removed [start, end) word ranges, maximal). Windows are
    judged on the input. Null, empty and short texts have no window and lose
    nothing; a null doc_id is smaller than none and larger than all others; rows
    that repeat a doc_id do not cut each other. No row: no row. Two windows count as
    equal when 64 bits of one rolling hash and 16 of another agree.
    """
    spark = docs.sparkSession
    n = tasks(spark)
    chunked = docs.select(
        F.col("doc_id").cast("long"), text_bytes().alias("text"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(n * CHUNKS)).cast("int").alias("chunk"),
    ).repartition(n, "chunk")

    def read(chunk: pa.Table) -> tuple[pa.Array, Windows]:
        ids = chunk.column("doc_id").combine_chunks()
        numbers = ids.fill_null(int(NO_ID)).to_numpy(zero_copy_only=False).astype(np.int64)
        return ids, Windows(numbers, chunk.column("text").to_pylist(), width)

    def deal(chunk: pa.Table) -> pa.Table:
        _, windows = read(chunk)
        edges = windows.buckets(n).tolist()
        ids, owner = np.unique(windows.least, return_inverse=True)
        owner = owner.astype(np.uint32 if len(ids) > 65_535 else np.uint16)
        rows: list[list] = [[], [], [], [], []]
        number = chunk.column("chunk")[0].as_py()
        for bucket, (a, b) in enumerate(zip(edges, edges[1:])):
            if a == b:
                continue
            used, own = np.unique(owner[a:b], return_inverse=True)
            own = own.astype(owner.dtype)
            owners = zlib.compress(ids[used].tobytes(), 1) + zlib.compress(own.view(np.uint8).reshape(len(own), -1).T.tobytes(), 1)
            for column, value in zip(rows, (number, bucket, _packed(windows.main[a:b]), windows.check[a:b].tobytes(), owners)):
                column.append(value)
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, k) for c, k in zip(rows, kinds)], ["chunk", "bucket", "main", "check", "owners"])

    def judge(bucket: pa.Table) -> pa.Table:
        main = [_unpacked(x) for x in bucket.column("main").to_pylist()]
        sizes = np.fromiter(map(len, main), np.int64, len(main))
        check = [np.frombuffer(x, np.uint16) for x in bucket.column("check").to_pylist()]
        least = []
        for data, size in zip(bucket.column("owners").to_pylist(), sizes.tolist()):
            first = zlib.decompressobj()
            ids = np.frombuffer(first.decompress(data), np.int64)
            planes = np.frombuffer(zlib.decompress(first.unused_data), np.uint8).reshape(-1, size)
            own = np.ascontiguousarray(planes.T).view(np.uint32 if len(planes) == 4 else np.uint16).ravel()
            least.append(ids[own])
        earlier = _earlier_elsewhere(np.concatenate(main), np.concatenate(check), np.concatenate(least))
        ends = np.cumsum(sizes)
        bits = [np.packbits(earlier[e - s: e]).tobytes() for s, e in zip(sizes.tolist(), ends.tolist())]
        return pa.table([bucket.column("chunk"), bucket.column("bucket"), pa.array(bits, pa.binary())], ["chunk", "bucket", "bits"])

    def cut(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        ids, windows = read(chunk)
        edges = windows.buckets(n).tolist()
        elsewhere = np.zeros(len(windows.main), bool)
        for bucket, bits in zip(answers.column("bucket").to_pylist(), answers.column("bits").to_pylist()):
            a, b = edges[bucket], edges[bucket + 1]
            elsewhere[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a)
        found = list(windows.cut(elsewhere))
        spans = [[{"start": a, "end": b} for a, b in f[3]] for f in found]
        kept = pa.array([f[2] for f in found], pa.binary()).cast(pa.string())
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table([ids, pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()), kept,
                         pa.array(spans, span)], ["doc_id", "n_words", "n_removed", "kept", "intervals"])

    windows = chunked.groupBy("chunk").applyInArrow(deal, "chunk int, bucket int, main binary, check binary, owners binary")
    answers = windows.groupBy("bucket").applyInArrow(judge, "chunk int, bucket int, bits binary")
    return chunked.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        cut, "doc_id long, n_words long, n_removed long, kept string, intervals array<struct<start:bigint,end:bigint>>")
