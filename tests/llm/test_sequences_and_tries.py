"""Sequence files, fill-in-the-middle and prefix tries: exact round trips, brute force and edge cases."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tickloom.llm import fim, prefixes, sequences

PATH = public_tokenizers.path("word_bpe_49k.json")


def expected_documents(docs, end_id=2):
    whole, start, rows = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in docs:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [end_id]
        rows.append((doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return rows


def test_sequences_of_the_table(spark, sf, tmp_path, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    for length, batch, size in ((2048, 256, 64 << 20), (64, 3, 30_000)):
        monkeypatch.setattr(sequences, "BATCH_ROWS", batch)
        folder = str(tmp_path / f"s{length}")
        sequences.write_sequences(docs, folder, length=length, file_bytes=size)
        found = [tuple(r) for r in sequences.read_documents(spark, folder).orderBy("start").collect()]
        assert found == expected_documents(rows)
        # Every sequence by number; together the ids under the masks are the stream.
        series = sequences.open_sequences(spark, folder)
        assert len(series.files) == (1 if size > 10**6 else len(series.files)) and len(series) > 0
        parts = []
        for i in range(len(series)):
            ids, mask = series[i]
            assert len(ids) == len(mask) == length and ids.dtype == np.uint16 and not ids.flags.owndata
            parts.append(ids[mask.to_numpy(zero_copy_only=False)])
        stream = np.concatenate(parts)
        assert len(stream) == sum(r[2] for r in found)
        for doc_id, start, n, crc in random.Random(1).sample(found, 20):
            assert zlib.crc32(stream[start: start + n].astype("<u4")) == crc
    with pytest.raises(IndexError):
        series[len(series)]
    assert len(series.files) > 3


def test_views_are_not_copied(tmp_path):
    path = str(tmp_path / "x.arrow")
    with pa.OSFile(path, "wb") as sink:
        writer = sequences.SequenceWriter(sink, 16, pa.uint16())
        writer.add(pa.array([5, None]), np.arange(40, dtype=np.uint32), np.array([33, 7]))
        writer.close()
    before = pa.total_allocated_bytes()
    opened = sequences.SequenceFile(path)
    held = [opened[i] for i in range(len(opened))]
    assert pa.total_allocated_bytes() - before < 64 * 100
    assert [h[0].tolist()[0] for h in held] == [0, 16, 32] and held[2][1].true_count == 8
    assert [d for found in opened.documents() for d in zip(*found)] == [
        (5, 33, zlib.crc32(np.arange(33, dtype="<u4"))), (None, 7, zlib.crc32(np.arange(33, 40, dtype="<u4")))]


def test_sequences_edges(spark, tmp_path):
    docs = [(None, "no id"), (-3, "x"), (1, None), (2, ""), (3, "y " * 30_000), (4, "same"), (4, "same"), (4, "other"), (9, "<|endoftext|> # #")]
    frame = spark.createDataFrame([(*d, 7, "a") for d in docs], "doc_id long, text string, ids int, file string")
    folder = str(tmp_path / "e")
    sequences.write_sequences(frame, folder, length=8, file_bytes=1000)
    found = [tuple(r) for r in sequences.read_documents(spark, folder).orderBy("start").collect()]
    assert [f[0] for f in found] == [None, -3, 1, 2, 3, 4, 4, 4, 9]
    assert sorted(f[2:] for f in found) == sorted(f[2:] for f in expected_documents(docs))
    assert [f[1] for f in found] == [sum(f[2] for f in found[:i]) for i in range(len(found))]
    # The same folder is written again; a table without rows leaves nothing to read.
    sequences.write_sequences(frame.limit(0), folder, length=8)
    assert sequences.read_documents(spark, folder).count() == 0 and len(sequences.open_sequences(spark, folder)) == 0
    with pytest.raises(ValueError):
        sequences.write_sequences(frame, folder, length=12)


LETTERS = st.text(st.sampled_from("ab\né漢\U0001f600\n<PSM>"), max_size=40)


@given(LETTERS, st.integers(-5, 10**9), st.sampled_from([0, 50, 100]), st.sampled_from([0, 50, 100]))
@settings(max_examples=400, deadline=None)
def test_middle_against_slices(text, doc_id, fim_percent, spm_percent):
    n, form, prefix_chars, middle_chars, output = fim.transform(text.encode(), doc_id, fim_percent=fim_percent, spm_percent=spm_percent)
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{doc_id}".encode()).hexdigest()
    h = [int(digest[i: i + 8], 16) for i in (0, 8, 16, 24)]
    low, high = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    a, b, c = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    plain = not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim_percent
    assert n == len(units)
    if plain:
        assert (form, prefix_chars, middle_chars, output) == ("plain", None, None, text.encode())
    else:
        assert form == ("spm" if h[3] % 100 < spm_percent else "psm") and (prefix_chars, middle_chars) == (len(a), len(b))
        assert output.decode() == (f"<S>{c}<P>{a}<M>{b}" if form == "spm" else f"<P>{a}<S>{c}<M>{b}")
    assert fim.restore(output, form) == text.encode()


@given(st.binary(max_size=30), st.lists(st.integers(0, 30), min_size=3, max_size=3))
def test_rotation_exchanges_neighbours(data, cuts):
    i, j, k = sorted(min(c, len(data)) for c in cuts)
    turned = bytearray(data)
    fim.rotate(turned, i, j, k)
    assert turned == data[:i] + data[j:k] + data[i:j] + data[k:]


def test_middle_edges(spark):
    docs = [(None, "a\nb"), (1, None), (2, ""), (3, "\n" * 5), (4, "x" * 3_000_000), (5, "a <M> b"), (6, "r\r\n s"), (6, "r\r\n s")]
    frame = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, n int, form int")
    rows = fim.fill_in_middle(frame).collect()
    assert sorted(bytes(r.restored).decode() for r in rows) == sorted(t or "" for _, t in docs)
    assert {r.doc_id: r.form == "plain" for r in rows} == {None: False, 1: True, 2: True, 3: False, 4: False, 5: True, 6: False}
    assert {r.doc_id: r.n for r in rows} == {None: 2, 1: 0, 2: 0, 3: 5, 4: 1, 5: 1, 6: 2}
    assert fim.fill_in_middle(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        fim.restore(b"x", "other")


def brute_trie(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            own[conv_id].append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [t for _, t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:]
    members, children = defaultdict(list), defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    leaves, saved, found = {}, {}, []
    for k in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        leaves[k] = sum(leaves[x] for x in children[k]) or 1
        saved[k] = (len(members[k]) - 1) * words + sum(saved[x] for x in children[k])
        ends = ",".join(str(c) for c in sorted(c for c in members[k] if len(built[c]) == len(k)))
        found.append((min(members[k]), len(k), min(members[k[:-1]]) if k else None, len(members[k]), len(children[k]), leaves[k], saved[k],
                      hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(found, key=str)


def trie(spark, rows):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, a string")
    return sorted((tuple(r) for r in prefixes.prefix_trie(frame).collect()), key=str)


def some_conversations(seed):
    rng, rows = random.Random(seed), [(None, 1, "user", "x")]
    for c in rng.sample(range(200), 60):  # families with and without their first conversation, some shorter than what is taken
        for i in range(rng.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, rng.choice([i, i, None, 1]), rng.choice(["u", "a", None]), rng.choice(["x", "y z", "", None])))
    rows += [(300 + j, i, "u", "x") for j in (0, 1) for i in range(60)]  # long ones, alike
    rows += [(320 + j, i, "u", f"same{i}") for j in range(30) for i in range(6)]  # many copies
    return rows + rows[:3]


@pytest.mark.parametrize("block_rows, depths, estimate", [(1 << 17, 4096, None), (7, 5, None), (3, 2, False), (40, 4, True)])
def test_trie_against_brute_force(spark, monkeypatch, block_rows, depths, estimate):
    """In one block and in many, with windows that cut conversations, with an empty and with a full sketch."""
    monkeypatch.setattr(prefixes, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(prefixes, "DEPTHS", depths)
    if estimate is False:  # as if all counters were two: everything is grouped exactly
        monkeypatch.setattr(prefixes, "_alone", lambda sketch, a, b: np.zeros(len(a), bool))
    elif estimate:  # any prefix may be over-estimated
        exact = prefixes._alone
        monkeypatch.setattr(prefixes, "_alone", lambda sketch, a, b: exact(sketch, a, b) & (a % np.uint64(3) > 0))
    rows = some_conversations(block_rows)
    assert trie(spark, rows) == brute_trie(rows)


def test_trie_edges(spark):
    assert trie(spark, []) == [] and trie(spark, [(None, 0, "u", "x")]) == []
    for rows in ([(20, None, None, None)], [(c, 0, "u", "x") for c in (-21, -20, -5, -33, 7, 21) for _ in range(3)] + [(0, i, 'u', 'base') for i in range(2)], [(5, 0, "u", "w " * 100_000)]):
        assert [r for r in trie(spark, rows) if r[1] > 0] == [r for r in brute_trie(rows) if r[1] > 0]
    # Turnless once rebuilt: members of the root only, which is then a leaf.
    alone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)
    assert trie(spark, [(alone, 0, "u", "x")]) == [(alone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())]
