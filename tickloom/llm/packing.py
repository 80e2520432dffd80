"""Best-fit packing of tokenized documents into sequences of fixed capacity.

Method: best-two-fit. A sequence is filled greedily with the longest piece that
fits; then its smallest piece is taken out again if two unpacked pieces fill the
enlarged gap more tightly. Only lengths matter for that, so the whole decision is
made on a histogram (never more than ``capacity`` counts, whatever the corpus):
the planner returns patterns of lengths with the number of times each is used.
Pieces are then numbered within their length, in Spark, and look their place up
in the plan.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import stored, text_bytes
from tickloom.llm.tokens import encoder, slices

CAPACITY = 4096
END_ID = 1
#: Pieces numbered together in one task.
RANK_ROWS = 4000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY,
                 end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Token ids of every document and the end id, cut into pieces of at most ``capacity``.

    One row per piece: doc_id, piece, start, length, CRC-32 of the ids as
    little-endian unsigned 32-bit numbers and, with ``with_ids``, the ids. A null
    or empty text gives one piece that holds the end id only. Repeated rows each
    give their pieces; a null doc_id stays null.
    """
    path = tokenizer_path or public_tokenizers.path("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            ids, counts = encoder(path).encode(batch.column("text"), end_id)
            ids = ids.astype("<u4", copy=False)
            pieces = -(-counts // capacity)
            owner = np.repeat(np.arange(len(counts)), pieces)
            piece = np.arange(len(owner)) - (np.cumsum(pieces) - pieces)[owner]
            start = piece * capacity
            length = np.minimum(counts[owner] - start, capacity)
            at = ((np.cumsum(counts) - counts)[owner] + start).tolist()
            bodies = [ids[first: first + n] for first, n in zip(at, length.tolist())]
            arrays = [batch.column("doc_id").take(pa.array(owner)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length),
                      pa.array([zlib.crc32(body) for body in bodies], pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array([body.astype(np.int32) for body in bodies], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = PIECES + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), text_bytes().alias("text")).mapInArrow(run, schema)


def best_two_fit(counts: np.ndarray, capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Plan sequences for ``counts[l]`` pieces of each length ``l``.

    Returns (pattern, times) pairs, a pattern being (length, pieces) pairs. While
    the counts last, the same choice is made again, so one pattern serves many
    sequences and the plan's size depends on the capacity, not on the corpus.
    """
    left = np.array(counts, np.int64)
    sizes = np.arange(capacity + 1)

    def largest() -> np.ndarray:
        """For every gap the longest piece left that fits, 0 for none."""
        return np.maximum.accumulate(np.where(left > 0, sizes, 0))

    plan, fit = [], largest()
    while fit[capacity]:
        used: dict[int, int] = {}
        gap = capacity
        while gap and (length := int(fit[gap])):
            n = min(int(left[length]), gap // length)
            used[length] = used.get(length, 0) + n
            left[length] -= n
            gap -= n * length
            if not left[length]:
                fit = largest()
        smallest = min(used)
        room = gap + smallest
        if gap and room > 2:
            firsts = sizes[1: room]
            firsts = firsts[left[firsts] > 0]
            seconds = fit[room - firsts]
            # Two of the same length need two of them; otherwise the next shorter one.
            same = (seconds == firsts) & (left[firsts] < 2)
            seconds = np.where(same, fit[np.maximum(firsts - 1, 0)], seconds)
            seconds = np.where(seconds > 0, seconds, -room)
            if len(firsts) and (best := int(np.argmax(firsts + seconds))) >= 0 and int(firsts[best] + seconds[best]) > smallest:
                used[smallest] -= 1
                left[smallest] += 1
                for length in (int(firsts[best]), int(seconds[best])):
                    used[length] = used.get(length, 0) + 1
                    left[length] -= 1
                used = {length: n for length, n in used.items() if n}
                fit = largest()
        again = min(int(left[length]) // n for length, n in used.items())
        for length, n in used.items():
            left[length] -= n * again
        plan.append((sorted(used.items(), reverse=True), 1 + again))
        if again:
            fit = largest()
    return plan


def _places(plan: list[tuple[list[tuple[int, int]], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The plan as (length, first rank) keys in order, with first sequence and offset of each."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in plan:
        offset = 0
        for length, n in pattern:
            for _ in range(n):
                first = taken.get(length, 0)
                rows.append(((length << 44) + first, sequence, offset))
                taken[length] = first + times
                offset += length
        sequence += times
    rows.sort()
    keys, sequences, offsets = (np.array(x, np.int64) for x in zip(*rows)) if rows else (np.empty(0, np.int64),) * 3
    return keys, sequences, offsets


def pack(pieces: DataFrame, capacity: int = CAPACITY, order: tuple[str, ...] = ("doc_id", "piece", "start", "ids_crc32")) -> DataFrame:
    """Put every row of ``pieces`` (with a ``length`` column) into a sequence.

    Adds sequence_id and offset; the pieces of a sequence lie one after another
    from 0. A length below 1 or above the capacity is an error. No row: no row.
    Equal rows are packed each; columns are kept as they are.
    """
    spark = pieces.sparkSession
    given = stored(pieces, "pieces")
    total = given.count()
    chunks = max(1, -(-total // RANK_ROWS))
    keyed = given.withColumn("_chunk", F.pmod(F.xxhash64(*order), F.lit(chunks)).cast("int"))
    counts = stored(keyed.groupBy("length", "_chunk").agg(F.count("*").alias("_n")), "piece-counts")
    histogram = np.zeros(capacity + 1, np.int64)
    for length, n in counts.groupBy("length").agg(F.sum("_n")).collect():  # at most one row per length
        if not 1 <= length <= capacity:
            raise ValueError(f"a piece of {length} tokens does not fit {capacity}")
        histogram[length] = n
    keys, sequences, offsets = _places(best_two_fit(histogram, capacity))
    plan = spark.sparkContext.broadcast((keys, sequences, offsets))

    before = Window.partitionBy("length").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_chunk").orderBy(*order)
    ranked = keyed.withColumn("_rank", F.row_number().over(within)).join(starts, ["length", "_chunk"])
    ranked = ranked.select(*given.columns, (F.col("_before") + F.col("_rank") - 1).alias("_rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sequences, offsets = plan.value
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, (length << 44) + rank, side="right") - 1
            first = keys[at] - (length << 44)
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequences[at] + rank - first), pa.array(offsets[at])],
                [*batch.schema.names[:-1], "sequence_id", "offset"])

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields)
    return ranked.mapInArrow(place, names + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Tokenize, cut and pack whole documents: one row per piece with its sequence and place."""
    return pack(token_pieces(docs, tokenizer_path, capacity, with_ids=with_ids), capacity)
