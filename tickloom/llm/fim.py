"""Fill-in-the-middle: a text is cut in three at line ends and the parts change places.

A text becomes bytes with a sentinel before each part. In PSM order middle and
suffix are exchanged, in SPM order the suffix goes before both others. Both are a
rotation of neighbouring blocks, done in place by three reversals: of each block,
then of both together. Restoring finds the sentinels, rotates back and takes them
out, with nothing but the output and its form.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import text_bytes

SEED = 7
FIM_PERCENT = 100
SPM_PERCENT = 50
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
LINE = re.compile(rb"[^\n]*\n|[^\n]+")

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary, restored binary"


def rotate(data: bytearray, first: int, cut: int, last: int) -> None:
    """Exchange data[first:cut] and data[cut:last] in place by three reversals."""
    view = np.frombuffer(data, np.uint8)
    for a, b in ((first, cut), (cut, last), (first, last)):
        part = view[a:b]
        half = len(part) // 2
        head = part[:half].copy()
        part[:half] = part[len(part) - half:][::-1]
        part[len(part) - half:] = head[::-1]


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four numbers of a document: the first groups of eight digits of a SHA-256. A null doc_id counts as no digits."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i: i + 8], 16) for i in range(0, 32, 8)]


def transform(text: bytes, doc_id: int | None, seed: int = SEED, fim_percent: int = FIM_PERCENT,
              spm_percent: int = SPM_PERCENT) -> tuple[int, str, int | None, int | None, bytes]:
    """Number of lines, form, code points of prefix and middle, and the output."""
    n = text.count(b"\n") + (not text.endswith(b"\n") and bool(text))
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= fim_percent:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    # The scan for cuts: where the lines low and high end.
    first = second = 0
    for k, line in enumerate(LINE.finditer(text), 1):
        if k <= low:
            first = line.end()
        if k > high:
            break
        second = line.end()
    if high == 0:
        second = 0
    prefix_chars, middle_chars = _chars(text[:first]), _chars(text[first:second])
    data = bytearray(text)
    for at, sentinel in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        data[at:at] = sentinel
    suffix = second + len(PREFIX) + len(MIDDLE)  # place of the suffix's sentinel
    if h4 % 100 < spm_percent:
        rotate(data, 0, suffix, len(data))
        form = "spm"
    else:
        rotate(data, first + len(PREFIX), suffix, len(data))
        form = "psm"
    return n, form, prefix_chars, middle_chars, bytes(data)


def restore(output: bytes, form: str) -> bytes:
    """The exact text, from an output and its form alone."""
    if form == "plain":
        return output
    data = bytearray(output)
    if form == "spm":
        rotate(data, 0, data.index(PREFIX), len(data))
    elif form == "psm":
        rotate(data, data.index(SUFFIX), data.index(MIDDLE), len(data))
    else:
        raise ValueError(f"no form {form!r}")
    for sentinel in (SUFFIX, MIDDLE, PREFIX):
        at = data.index(sentinel)
        del data[at: at + len(sentinel)]
    return bytes(data)


def _chars(text: bytes) -> int:
    """Code points of UTF-8: bytes that continue none."""
    return int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


def fill_in_middle(docs: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """Every document's output, and the text restored from it: one row per row of ``docs`` (doc_id, text).

    Null texts count as empty and stay plain, as do texts that hold a sentinel; a
    null doc_id draws as one without digits. Repeated rows give equal rows; other
    columns are not used; no row gives no row. Outputs are bytes (UTF-8).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        for whole in batches:
            for first in range(0, whole.num_rows, 200):  # outputs of so many are held at once
                batch = whole.slice(first, 200)
                rows = []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                    made = transform(text or b"", doc_id, seed, fim_percent, spm_percent)
                    rows.append((doc_id, *made, restore(made[4], made[1])))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return docs.select(F.col("doc_id").cast("long"), text_bytes().alias("text")).mapInArrow(run, SCHEMA)
