"""Benchmark decontamination by greedy string tiling.

Method: documents and benchmark items that share a seed (a run of ``min_match``
equal words) are tiled: the longest match whose words are still free on both sides
is marked, again and again, until none of ``min_match`` words is left. The share of
an item's words that tiles cover decides, so a passage that is cut up and reordered
counts like one in place. Seeds come from running Karp-Rabin hashes; only those at
the ends of a run are listed, so repeated words do not multiply.

The benchmark goes to the workers in blocks of bounded size; a larger benchmark
takes more passes over the documents, not more memory.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from tickloom.llm.common import Cache, each, text_bytes, window_hashes

MIN_MATCH, THRESHOLD = 5, 0.5
#: Words of the benchmark that one pass holds: bounds the broadcast to about 100 MB.
BLOCK_WORDS = 2_000_000
#: Bits of the table that rules out most windows before the search.
FILTER_BITS = 22

_NOT_WORD = re.compile(r"[\W_]+")


def _token(word: bytes) -> int:
    """Hash of a word's letters and digits in lower case; 0 if it has none."""
    plain = _NOT_WORD.sub("", word.decode("utf-8", "replace").lower())
    return (xxhash.xxh64_intdigest(plain) or 1) if plain else 0


_tokens = Cache(_token)


def tokens(text: bytes | None) -> np.ndarray:
    """The compared words of a text as hashes: lower case, letters and digits only, others left out."""
    words = (text or b"").split()
    found = np.fromiter(map(_tokens.__getitem__, words), np.uint64, len(words))
    return found[found != 0]


class Seeds:
    """Where runs of equal words begin, or end: places of the items' windows by hash and the word beside them.

    A pair of equal windows lies inside a run unless the words beside them differ, so
    pairs are taken by hash with the windows beside the same word left out. A run
    costs two entries, however many seeds it holds.
    """

    def __init__(self, hashes: np.ndarray, beside: np.ndarray, number: np.ndarray, place: np.ndarray):
        self.hashes, hash_id = np.unique(hashes, return_inverse=True)
        self.words, word_id = np.unique(beside, return_inverse=True)
        keys = hash_id.astype(np.int64) * (len(self.words) + 1) + word_id
        order = np.argsort(keys, kind="stable")
        self.keys, self.number, self.place = keys[order], number[order], place[order]

    def pairs(self, at: np.ndarray, hashes: np.ndarray, beside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document place, item and item place of each pair of equal hashes with different words beside it."""
        if not len(self.hashes):
            return at[:0], at[:0], at[:0]
        hash_id = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        known = self.hashes[hash_id] == hashes
        at, beside, first = at[known], beside[known], hash_id[known].astype(np.int64) * (len(self.words) + 1)
        word_id = np.minimum(np.searchsorted(self.words, beside), len(self.words) - 1)
        # A word that no item has beside a window stands behind all others.
        word_id = np.where((self.words[word_id] == beside) & (beside != 0), word_id, len(self.words))
        edges = [np.searchsorted(self.keys, k) for k in (first, first + word_id, first + word_id + 1, first + len(self.words) + 1)]
        low, counts = np.concatenate((edges[0], edges[2])), np.concatenate((edges[1] - edges[0], edges[3] - edges[2]))
        seed = np.repeat(low - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
        return np.repeat(np.concatenate((at, at)), counts), self.number[seed], self.place[seed]


class Index:
    """Seeds of a block of benchmark items. An item shorter than a seed is found only as a whole text."""

    def __init__(self, items: list[tuple[int | None, bytes | None]], min_match: int):
        self.min_match = min_match
        self.items = [(item_id, words) for item_id, text in items if len(words := tokens(text))]
        self.short: dict[bytes, list[int]] = {}
        parts: list[tuple[np.ndarray, ...]] = [(np.empty(0, np.uint64),) * 3 + (np.empty(0, np.int64),) * 2]
        for number, (_, words) in enumerate(self.items):
            if len(words) < min_match:
                self.short.setdefault(words.tobytes(), []).append(number)
                continue
            n = len(words) - min_match + 1
            before, after = _beside(words, min_match)
            parts.append((window_hashes(words, min_match), before, after, np.full(n, number), np.arange(n)))
        hashes, before, after, number, place = (np.concatenate(x) for x in zip(*parts))
        self.begin, self.end = Seeds(hashes, before, number, place), Seeds(hashes, after, number, place)
        self.table = np.zeros(1 << FILTER_BITS, bool)
        self.table[hashes >> np.uint64(64 - FILTER_BITS)] = True

    def _runs(self, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of equal words of at least a seed, by item: item, document place, item place, length."""
        width = self.min_match
        windows = window_hashes(doc, width)
        at = np.flatnonzero(self.table[windows >> np.uint64(64 - FILTER_BITS)])
        if not len(at):
            return (np.empty(0, np.int64),) * 4
        found = []
        for seeds, beside in zip((self.begin, self.end), _beside(doc, width)):
            where, item, inside = seeds.pairs(at, windows[at], beside[at])
            equal = np.ones(len(where), bool)
            for a, b in _cuts(item):  # equal hashes are compared word by word, so that beginnings and ends pair up
                words = self.items[int(item[a])][1]
                for k in range(width):
                    equal[a:b] &= doc[where[a:b] + k] == words[inside[a:b] + k]
            where, item, inside = where[equal], item[equal], inside[equal]
            order = np.lexsort((where, where - inside, item))
            found.append((item[order], where[order], inside[order]))
        (item, where, inside), (_, last, _) = found
        return item, where, inside, last - where + width

    def matches(self, doc: np.ndarray, threshold: float) -> Iterator[tuple[int | None, int, list[tuple[int, int, int]]]]:
        """Items whose tiles cover at least ``threshold`` of them: id, words, tiles (document, item, length)."""
        if len(doc) < self.min_match:
            for number in self.short.get(doc.tobytes(), ()) if len(doc) else ():
                yield self.items[number][0], len(doc), [(0, 0, len(doc))]
            return
        item, where, inside, length = self._runs(doc)
        for a, b in _cuts(item):
            item_id, words = self.items[int(item[a])]
            # No tile can cover a word that no run covers.
            reach = np.zeros(len(words) + 1, np.int64)
            np.add.at(reach, inside[a:b], 1)
            np.add.at(reach, inside[a:b] + length[a:b], -1)
            if (np.cumsum(reach) > 0).sum() < threshold * len(words):
                continue
            tiles = tile(where[a:b], inside[a:b], length[a:b], self.min_match, len(doc), len(words))
            if sum(t[2] for t in tiles) >= threshold * len(words):
                yield item_id, len(words), tiles


def _beside(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The word before and behind each window; 0 at the ends."""
    none = np.zeros(1, np.uint64)
    return np.concatenate((none, words[: len(words) - width])), np.concatenate((words[width:], none))


def _cuts(item: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of equal neighbours."""
    edges = np.flatnonzero(np.concatenate(([True], item[1:] != item[:-1], [True]))) if len(item) else np.empty(0, np.int64)
    return zip(edges[:-1].tolist(), edges[1:].tolist())


def tile(where: np.ndarray, inside: np.ndarray, lengths: np.ndarray, width: int, doc_words: int, item_words: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling from maximal runs: (document place, item place, length) of each tile."""
    heap = [(-n, d, i) for n, d, i in zip(lengths.tolist(), where.tolist(), inside.tolist())]
    heapq.heapify(heap)
    doc_taken, item_taken, tiles, free = np.zeros(doc_words, bool), np.zeros(item_words, bool), [], item_words
    while heap and free >= width:
        n, d, i = heapq.heappop(heap)
        n = -n
        taken = doc_taken[d: d + n] | item_taken[i: i + n]
        if not taken.any():
            doc_taken[d: d + n] = item_taken[i: i + n] = True
            tiles.append((d, i, n))
            free -= n
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([1], taken.view(np.int8), [1]))))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):  # what is still free goes back
            if b - a >= width:
                heapq.heappush(heap, (a - b, d + a, i + a))
    return tiles


def _indexes(benchmark: DataFrame, min_match: int, block_words: int) -> Iterator:
    """The benchmark's blocks, one broadcast after another."""
    items = benchmark.select(F.col("item_id").cast("long"), text_bytes().alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0))).first()[0]
    n = 1 + int(size) // (2 * block_words)  # a word and its space take two bytes at least
    for block in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block).collect()
        yield benchmark.sparkSession.sparkContext.broadcast(Index([(r[0], bytes(r[1]) if r[1] is not None else None) for r in rows], min_match))


def contamination(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, threshold: float = THRESHOLD,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """Pairs of a document and a benchmark item it holds.

    Columns doc_id, item_id, item_words, matched_words, coverage (matched share),
    tiles (array of document place, item place, length, in compared words). Null or
    empty documents and items match nothing; equal rows give equal pairs; null ids
    stay null. An item of fewer than ``min_match`` words matches texts of exactly its
    words only. No document or no item: no row. Extra columns are left out.
    """
    schema = ("doc_id long, item_id long, item_words long, matched_words long, coverage double, "
              "tiles array<struct<doc_at:bigint,item_at:bigint,length:bigint>>")
    kind = pa.list_(pa.struct([("doc_at", pa.int64()), ("item_at", pa.int64()), ("length", pa.int64())]))

    def search(index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows: list[list] = [[], [], [], [], [], []]
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), each(batch.column("text"))):
                    for item_id, n, tiles in index.value.matches(tokens(text), threshold):
                        matched = sum(t[2] for t in tiles)
                        spans = [{"doc_at": d, "item_at": i, "length": k} for d, i, k in sorted(tiles)]
                        for column, value in zip(rows, (doc_id, item_id, n, matched, matched / n, spans)):
                            column.append(value)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), kind)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(rows, kinds)],
                    ["doc_id", "item_id", "item_words", "matched_words", "coverage", "tiles"])
        return run

    texts = docs.select(F.col("doc_id").cast("long"), text_bytes().alias("text"))
    found = [texts.mapInArrow(search(index), schema) for index in _indexes(benchmark, min_match, block_words)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def without_benchmark(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, threshold: float = THRESHOLD,
                      block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item; all columns stay as they are, whatever their names.

    Null and empty texts hold nothing and stay; repeated rows share their verdict; an
    empty benchmark keeps all rows. Items of fewer than ``min_match`` words as above.
    """
    def clean(index):
        def run(texts: pa.Array) -> pa.Array:
            return pa.array([next(index.value.matches(tokens(t), threshold), None) is None for t in each(texts)], pa.bool_())
        return F.arrow_udf(run, BooleanType())

    for index in _indexes(benchmark, min_match, block_words):
        docs = docs.filter(clean(index)(text_bytes()))
    return docs
