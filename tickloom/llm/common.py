"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import work_folder

#: A word: a run of characters other than space, tab, line feed, vertical tab, form feed, carriage return.
#: ``bytes.split()`` cuts UTF-8 at exactly these.
WORD = r"[^\x20\x09-\x0D]+"

#: Entries a per-worker word cache may hold before it is emptied; bounds the worker's memory, not the result.
CACHE_WORDS = 250_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to a new table in the shared folder and read it back: later steps start from there."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tasks(spark: SparkSession) -> int:
    """Partitions of an explicit exchange: the session's own setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(column: str = "text"):
    """A text column as UTF-8 bytes, null as it is."""
    return F.col(column).cast("binary")


def each(column: pa.Array) -> Iterator:
    """The values of an Arrow column, of which only some are Python objects at a time."""
    for first in range(0, len(column), 200):
        yield from column.slice(first, 200).to_pylist()


class Cache(dict):
    """A dict that computes missing values and empties itself when full."""

    def __init__(self, make, limit: int = CACHE_WORDS):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value


_hashes = Cache(xxhash.xxh64_intdigest)


def word_hashes(words: list) -> np.ndarray:
    """A 64-bit hash per word."""
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


#: Multipliers of the two rolling hashes (odd, fixed).
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def window_hashes(values: np.ndarray, width: int, base: np.uint64 = BASES[0]) -> np.ndarray:
    """Rabin-Karp hash of every run of ``width`` values, modulo 2**64, built by doubling."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, done, power, power_base = None, 0, values, base  # power: hashes of runs of `size`; power_base: base**size
    size = 1
    with np.errstate(over="ignore"):
        while True:
            if width & size:
                # Runs of `size` come first, those gathered so far follow them.
                out = power if out is None else power[: len(values) - done - size + 1] * _power(base, done) + out[size: size + len(values) - done - size + 1]
                done += size
            if size * 2 > width:
                return out[:n]
            power = power[:-size] * power_base + power[size:]
            power_base = power_base * power_base
            size *= 2


def _power(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 1 << 64))


def mixed(values: np.ndarray) -> np.ndarray:
    """Another hash of the same words, so that the second rolling hash is independent of the first."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return values ^ (values >> np.uint64(32))


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared checkpoint folder; Spark removes the files when the frame is gone."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_folder(df.sparkSession, "checkpoint"))
    return df.checkpoint()


def components(links: DataFrame) -> DataFrame:
    """Smallest reachable node of every linked node: columns ``node`` and ``root``.

    ``links`` has columns a and b. Large-star and small-star steps alternate until
    nothing changes; a step is a combining minimum and a join, so a node with a
    great many links is split by the join and never gathered.
    """
    def edges(a, b) -> DataFrame:
        return a.select(F.greatest(*b).alias("a"), F.least(*b).alias("b")).filter("a <> b").distinct()

    now = checkpointed(edges(links, ("a", "b")))
    before = None
    while (mark := now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()) != before:
        before = mark
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select("b", "m")
        large = edges(large, ("b", "m"))
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.explode(F.array("a", "b")).alias("x"), "m")
        now = checkpointed(edges(small, ("x", "m")))
    nodes = now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return nodes.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def ngrams(words: list[str], sizes: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of the character n-grams of words, their ends marked: buckets and the word each belongs to.

    All words are taken at once, as one string of code points. A word must hold no
    space; single letters are n-grams without the marks.
    """
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    code = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    spaces = np.concatenate(([0], np.cumsum(code == 32)))
    code, found, owners = mixed(code + np.uint64(1)), [], []
    for n in sizes:
        if n > len(code):
            continue
        # Spaces before and behind a window's inner part; none may lie inside.
        first, last = (0, n) if n == 1 else (1, n - 1)
        inside = spaces[last: len(code) - n + last + 1] - spaces[first: len(code) - n + first + 1]
        at = np.flatnonzero(inside == 0)
        hashes = mixed(window_hashes(code, n)[at] + np.uint64(n))
        found.append((hashes >> np.uint64(64 - bits)).astype(np.int64))
        owners.append(spaces[at + 1] - 1)
    return np.concatenate([np.empty(0, np.int64), *found]), np.concatenate([np.empty(0, np.int64), *owners])
