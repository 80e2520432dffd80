"""Token ids as Arrow files of equal-length sequences with masks.

The ids of all documents, in ascending doc_id order (null first; equal ids by their
text), form one stream. Text is range-partitioned by doc_id, so that each task
tokenizes one stretch of the stream and writes it as one Arrow IPC file: record
batches of ``BATCH_ROWS`` sequences with

* ``ids``: fixed-size list of ``length`` unsigned ids, 16 bits wide where the vocabulary allows it, else 32;
* ``mask``: fixed-size list of ``length`` bits, true for ids, false for the filling behind a file's last id;
* ``doc_ids``, ``offsets``: the documents that start in the sequence, and where.

Buffers are neither compressed nor copied: a reader maps the file, and row r of
batch b is a view of it. Every batch but a file's last has the same number of rows,
so a sequence is found by a division. Only text crosses the exchange, once. A table
``manifest`` lists the files that were completed, with their counts; file names
depend on the partition alone and files appear by renaming, so a task that runs
again replaces its own file.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import text_bytes
from tickloom.llm.tokens import encoder, slices
from tickloom.session import work_folder

END_ID = 2
LENGTH = 2048
#: Sequences in a record batch, and text in a file (about); neither changes the ids.
BATCH_ROWS = 256
FILE_BYTES = 64 << 20

MANIFEST = "part int, file string, sequences long, documents long, tokens long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _schema(length: int, kind: pa.DataType) -> pa.Schema:
    return pa.schema([
        pa.field("ids", pa.list_(kind, length)), pa.field("mask", pa.list_(pa.bool_(), length)),
        pa.field("doc_ids", pa.list_(pa.int64())), pa.field("offsets", pa.list_(pa.int32())),
    ])


class SequenceWriter:
    """Cuts a stream of documents into sequences and writes them batch by batch."""

    def __init__(self, sink, length: int, kind: pa.DataType):
        self.schema, self.length, self.kind = _schema(length, kind), length, kind
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.ids: list[np.ndarray] = []
        self.docs: list[tuple[np.ndarray, pa.Array]] = []  # first places in the stream, doc_ids
        self.done = self.tokens = self.documents = self.sequences = 0

    def add(self, doc_ids: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        """Take documents given by their ids one after another."""
        self.docs.append((self.tokens + np.cumsum(counts) - counts, doc_ids))
        self.ids.append(ids)
        self.tokens += len(ids)
        self.documents += len(counts)
        block = BATCH_ROWS * self.length
        if self.tokens - self.done >= block:
            whole = np.concatenate(self.ids)
            last = len(whole) // block * block
            for at in range(0, last, block):
                self._write(whole[at: at + block])
            self.ids = [whole[last:].copy()]

    def _write(self, ids: np.ndarray) -> None:
        rows = -(-len(ids) // self.length)
        filled = np.zeros(rows * self.length, self.kind.to_pandas_dtype())
        filled[: len(ids)] = ids
        places = np.concatenate([p for p, _ in self.docs])
        names = pa.concat_arrays([d for _, d in self.docs])
        n = int(np.searchsorted(places, self.done + len(ids)))
        row, offset = np.divmod(places[:n] - self.done, self.length)
        lists = pa.array(np.searchsorted(row, np.arange(rows + 1)), pa.int32())
        self.writer.write_batch(pa.RecordBatch.from_arrays([
            pa.FixedSizeListArray.from_arrays(pa.array(filled), self.length),
            pa.FixedSizeListArray.from_arrays(pa.array(np.arange(len(filled)) < len(ids)), self.length),
            pa.ListArray.from_arrays(lists, names[:n]),
            pa.ListArray.from_arrays(lists, pa.array(offset, pa.int32())),
        ], schema=self.schema))
        self.docs = [(places[n:], names[n:])]
        self.done += len(ids)
        self.sequences += rows

    def close(self) -> None:
        if self.tokens > self.done:
            self._write(np.concatenate(self.ids))
        self.writer.close()


class SequenceFile:
    """Random access to a file of sequences; ids and masks are views of the mapped file."""

    def __init__(self, source: pa.NativeFile | str):
        self.source = pa.memory_map(source) if isinstance(source, str) else source
        self.reader = pa.ipc.open_file(self.source)
        self.batch_rows = self.reader.get_batch(0).num_rows if self.reader.num_record_batches else 0
        last = self.reader.num_record_batches - 1
        self.rows = last * self.batch_rows + self.reader.get_batch(last).num_rows if last >= 0 else 0

    def __len__(self) -> int:
        return self.rows

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids (NumPy view) and mask (Arrow view) of sequence ``i``."""
        if not 0 <= i < self.rows:
            raise IndexError(i)
        batch, row = divmod(i, self.batch_rows)
        columns = self.reader.get_batch(batch)
        length = columns.schema.field("ids").type.list_size
        first = (columns.column("ids").offset + row) * length
        values = columns.column("ids").values.slice(first, length), columns.column("mask").values.slice(first, length)
        return values[0].to_numpy(zero_copy_only=True), values[1]

    def documents(self) -> Iterator[tuple[list, list[int], list[int]]]:
        """Per batch, of the documents that end in it: doc_id, number of ids, and CRC-32 of the ids as 32-bit numbers."""
        name, tokens, crc, open_ = None, 0, 0, False
        for b in range(self.reader.num_record_batches):
            batch = self.reader.get_batch(b)
            length = batch.schema.field("ids").type.list_size
            used = batch.column("mask").flatten().true_count
            ids = batch.column("ids").flatten().to_numpy()[:used].astype("<u4")
            starts = batch.column("offsets").flatten().to_numpy() + np.repeat(
                np.arange(batch.num_rows) * length, np.diff(batch.column("offsets").offsets.to_numpy()))
            found: tuple[list, list[int], list[int]] = ([], [], [])
            cuts = [0, *starts.tolist(), used]
            for k, next_name in enumerate([None, *batch.column("doc_ids").flatten().to_pylist()]):
                if k:
                    if open_:
                        for column, value in zip(found, (name, tokens, crc)):
                            column.append(value)
                    name, tokens, crc, open_ = next_name, 0, 0, True
                body = ids[cuts[k]: cuts[k + 1]]
                tokens, crc = tokens + len(body), zlib.crc32(body, crc)
            if b == self.reader.num_record_batches - 1 and open_:
                for column, value in zip(found, (name, tokens, crc)):
                    column.append(value)
            yield found


def write_sequences(docs: DataFrame, folder: str, tokenizer_path: str | None = None, length: int = LENGTH,
                    end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> None:
    """Write the ids of whole ``docs`` (doc_id, text), ``end_id`` behind each, below ``folder``.

    ``folder`` is a URI or path that executors and driver share, read and written
    through ``pyarrow.fs``. A null text counts as empty and is one id; a null doc_id
    comes first; repeated rows are each written; other columns are not used. A table
    without rows gives a manifest without rows. ``length`` must be a multiple of 8,
    so that masks start at whole bytes.
    """
    if length % 8 or length <= 0:
        raise ValueError(f"length {length} is no multiple of 8")
    path = tokenizer_path or public_tokenizers.path("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        files, at = fs.FileSystem.from_uri(_uri(folder))
        name, mine = f"part-{part:06d}.arrow", f"{at}/.part-{part:06d}-{uuid.uuid4().hex}"
        kind = pa.uint16() if max(encoder(path).size, end_id + 1) <= 1 << 16 else pa.uint32()
        writer = sink = None
        for batch in (piece for whole in batches for piece in slices(whole)):
            if writer is None:
                files.create_dir(at, recursive=True)
                sink = files.open_output_stream(mine)
                writer = SequenceWriter(sink, length, kind)
            writer.add(batch.column("doc_id"), *encoder(path).encode(batch.column("text"), end_id))
        if writer is not None:
            writer.close()
            sink.close()
            files.move(mine, f"{at}/{name}")
            values = (part, name, writer.sequences, writer.documents, writer.tokens)
            kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], [f.split()[0] for f in MANIFEST.split(", ")])

    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = ["doc_id", "_hash", "_row"]  # equal documents may share a doc_id in any number and are still dealt out
    rows = docs.select(F.col("doc_id").cast("long"), text_bytes().alias("text"), F.xxhash64("text").alias("_hash"),
                       F.monotonically_increasing_id().alias("_row"))
    dealt = rows.repartitionByRange(max(1, -(-size // file_bytes)), *order).sortWithinPartitions(*order).select("doc_id", "text")
    dealt.mapInArrow(run, MANIFEST).write.mode("overwrite").parquet(f"{folder}/manifest")


def _uri(folder: str) -> str:
    return folder if "://" in folder else f"file://{folder}" if not folder.startswith("file:") else folder.replace("file:", "file://", 1)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of a folder of sequences: doc_id, first place in the whole stream, number of ids, CRC-32 of the ids.

    Everything but the order of the files comes from the files. The manifest, of
    one row a file, is read by the driver to number the stream.
    """
    listed = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").orderBy("part").collect()
    files, base = [], 0
    for row in listed:
        files.append((row.file, base))
        base += row.tokens
    if not files:
        return spark.createDataFrame([], DOCUMENTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, at = fs.FileSystem.from_uri(_uri(folder))
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                place = f"{at}/{name}"
                local = isinstance(store, fs.LocalFileSystem)
                for doc_ids, tokens, crcs in SequenceFile(place if local else store.open_input_file(place)).documents():
                    counts = np.array(tokens, np.int64)
                    starts = start + np.cumsum(counts) - counts
                    start += int(counts.sum())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc_ids, pa.int64()), pa.array(starts), pa.array(counts), pa.array(crcs, pa.int64())],
                        [f.split()[0] for f in DOCUMENTS.split(", ")])

    return spark.createDataFrame(files, "file string, base long").repartition(len(files), "file").mapInArrow(run, DOCUMENTS)


def open_sequences(spark: SparkSession, folder: str) -> Sequences:
    """The sequences of a folder as one numbered series, for a training process."""
    listed = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").orderBy("part").collect()
    return Sequences(folder, [row.file for row in listed], [row.sequences for row in listed])


class Sequences:
    """Sequence i of a folder by a search among the files' counts; files are opened as they are met."""

    def __init__(self, folder: str, files: list[str], counts: list[int]):
        self.store, self.at = fs.FileSystem.from_uri(_uri(folder))
        self.files, self.stops = files, np.cumsum(counts, dtype=np.int64)
        self.opened: dict[int, SequenceFile] = {}

    def __len__(self) -> int:
        return int(self.stops[-1]) if len(self.stops) else 0

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        if not 0 <= i < len(self):
            raise IndexError(i)
        k = int(np.searchsorted(self.stops, i, side="right"))
        if k not in self.opened:
            place = f"{self.at}/{self.files[k]}"
            self.opened[k] = SequenceFile(place if isinstance(self.store, fs.LocalFileSystem) else self.store.open_input_file(place))
        return self.opened[k][i - (int(self.stops[k - 1]) if k else 0)]


def round_trip(docs: DataFrame, tokenizer_path: str | None = None, length: int = LENGTH) -> DataFrame:
    """Write ``docs`` to a new folder of sequences and read its documents back."""
    folder = work_folder(docs.sparkSession, "sequences")
    write_sequences(docs, folder, tokenizer_path, length)
    return read_documents(docs.sparkSession, folder)
