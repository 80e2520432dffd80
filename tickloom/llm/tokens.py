"""Token ids of whole texts, put together from those of their distinct words.

For tokenizers that never join tokens across ASCII white space, as the public word
BPE does. A batch of texts is split, its distinct words found and its ids gathered
by Arrow and NumPy; Python and the tokenizer only see words that are new to the
worker. A word of plain Latin letters with punctuation behind it is cut in two, so
that its letters are looked up once whatever follows them and only the BPE runs on
them; any other word goes through the whole tokenizer.
"""

from __future__ import annotations

import codecs
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

#: Parts of words whose ids a worker keeps; bounds its memory, not the result.
KNOWN_PARTS = 400_000
#: Text taken at once, and words gathered at once; they bound memory, not the result.
BATCH_BYTES = 4 << 20
GATHER_WORDS = 1 << 18

LETTERS = string.ascii_letters + "".join(chr(c) for c in range(0xC0, 0x100) if chr(c) not in "×÷")
#: All ASCII punctuation but the apostrophe, which belongs to suffixes such as 's.
MARKS = string.punctuation.replace("'", "")


class WordEncoder:
    """Encodes batches of texts; keeps the ids of the parts of words it has met."""

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.bpe = Tokenizer(self.whole.model)
        self.bpe.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.whole.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self.ends = np.zeros(self.size, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        # Byte-level tokenizers write a byte as a printable character: Latin-1 where that is one, else from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in plain)}
        self.written = "".join(byte[b] for b in range(256)).replace(byte[32], " ")
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {"": 0}
        self.starts, self.lengths, self.pool = np.zeros(1, np.int64), np.zeros(1, np.int64), np.empty(0, np.uint32)

    def _add(self, parts: list[str], lengths: np.ndarray, ids: np.ndarray) -> None:
        first = len(self.starts)
        self.known.update(zip(parts, range(first, first + len(parts)), strict=True))
        self.starts = np.concatenate((self.starts, len(self.pool) + np.cumsum(lengths) - lengths))
        self.lengths = np.concatenate((self.lengths, lengths))
        self.pool = np.concatenate((self.pool, ids))

    def _runs(self, stems: list[str], others: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The number of the id run of each part."""
        if len(self.known) + len(stems) + len(others) > KNOWN_PARTS:
            self._forget()
        # Stems are in lower case and without marks; other parts that look like them have the same ids.
        new = [s for s in stems if s not in self.known]
        if new:
            text, _ = codecs.charmap_decode(" ".join(new).encode(), "strict", self.written)
            ids = np.array(self.bpe.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            stops = np.flatnonzero(self.ends[ids]) + 1
            self._add(new, np.diff(stops, prepend=0), ids)
        new = [s for s in others if s not in self.known]
        if new:
            found = [e.ids for e in self.whole.encode_batch_fast(new, add_special_tokens=False)]
            self._add(new, np.array([len(f) for f in found], np.int64), np.array([i for f in found for i in f], np.uint32))
        return tuple(np.fromiter(map(self.known.__getitem__, parts), np.int64, len(parts)) for parts in (stems, others))

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, each with ``end_id`` behind it, and the number of ids of each.

        ``texts`` holds strings or UTF-8 bytes; null counts as empty, bytes that are no UTF-8 as U+FFFD.
        """
        split = pc.list_flatten(lists := pc.ascii_split_whitespace(_strings(texts)))
        words = np.diff(lists.offsets.to_numpy())
        distinct = split.dictionary_encode()
        codes, distinct = distinct.indices.to_numpy(), distinct.dictionary
        rest = pc.utf8_ltrim(distinct, LETTERS)
        odd = pc.not_equal(pc.utf8_rtrim(rest, MARKS), "")
        stems = pc.if_else(odd, "", pc.utf8_lower(pc.utf8_rtrim(distinct, MARKS))).dictionary_encode()
        marks = pc.if_else(odd, distinct, rest).dictionary_encode()
        of_stem, of_mark = self._runs(stems.dictionary.to_pylist(), marks.dictionary.to_pylist())
        runs = np.column_stack((of_stem[stems.indices.to_numpy()], of_mark[marks.indices.to_numpy()]))

        counts = np.concatenate(([0], np.cumsum(self.lengths[runs].sum(1)[codes])))
        stops = np.cumsum(words)
        per_text = counts[stops] - counts[stops - words]
        ids, at = np.empty(int(counts[-1]), np.uint32), 0
        for first in range(0, len(codes), GATHER_WORDS):
            run = runs[codes[first: first + GATHER_WORDS]].ravel()
            lengths = self.lengths[run]
            last = np.cumsum(lengths)
            taken = np.repeat(self.starts[run] - (last - lengths), lengths)
            ids[at: at + len(taken)] = self.pool[taken + np.arange(len(taken))]
            at += len(taken)
        return np.insert(ids, np.cumsum(per_text), np.uint32(end_id)), per_text + 1


def _strings(texts: pa.Array) -> pa.Array:
    texts = pc.fill_null(texts, b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else "")
    try:
        return texts.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([t.decode("utf-8", "replace") for t in texts.to_pylist()], pa.string())


_loaded: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder of a tokenizer file, loaded once."""
    if path not in _loaded:
        _loaded[path] = WordEncoder(path)
    return _loaded[path]


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``BATCH_BYTES`` of text; a longer text is a part of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64)
    part = np.cumsum(sizes) // BATCH_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for first, last in zip(cuts, cuts[1:]):
        if last > first:
            yield batch.slice(first, last - first)
