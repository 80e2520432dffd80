"""Quality rules, SimHash, substring dedup and decontamination against brute force and on edge cases."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tickloom.llm import common, decontaminate, quality, similar, simhash, substrings

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, word string, length int, kept string"
EDGES = [
    (1, None, "x", 1, "k"), (2, "", "x", 1, "k"), (3, " \t\n ", "x", 1, "k"), (None, "the one of no name", "x", 1, "k"),
    (4, "the end", "x", 1, "k"), (4, "the end", "x", 1, "k"), (5, "the word " * 30_000, "x", 1, "k"), (6, "é ü 漢字 x 😀", "x", 1, "k"),
]


@pytest.fixture(scope="module")
def texts(spark, sf):
    return {r[0]: r[1] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}


def brute_measures(text):
    text = text or ""
    words = WORDS.findall(text)
    lines = [line for line in text.split("\n") if WORDS.search(line)]
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    repeated = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i: i + 3])] > 1:
            repeated |= {i, i + 1, i + 2}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_quality_against_brute_force(spark, sf, texts):
    rows = quality.judge(spark.read.parquet(f"{sf}/documents.parquet")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r[m] for m in MEASURES) == brute_measures(texts[r["doc_id"]])


def test_quality_edges(spark):
    docs = spark.createDataFrame(EDGES, SCHEMA)
    rows = quality.judge(docs, prefix="q_").collect()
    assert len(rows) == len(EDGES) and rows[0]["kept"] == "k"
    for r in rows:
        assert tuple(r["q_" + m] for m in MEASURES) == brute_measures(r["text"])
    assert all(r["q_base_failed"] and not r["q_kept"] for r in rows)
    assert quality.kept_rows(docs).count() == 0
    assert quality.judge(docs.limit(0)).count() == 0
    good = " ".join(f"word{i} of the" for i in range(40))
    kept = quality.kept_rows(spark.createDataFrame([(1, good, "a", 1, "b"), (1, good, "a", 1, "b"), (2, good + " ###" * 20, "a", 1, "b")], SCHEMA))
    assert [r["doc_id"] for r in kept.collect()] == [1, 1] and kept.columns == docs.columns


def test_quality_keeps_labelled_documents(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    judged = quality.judge(docs).join(labels.select("doc_id", "quality"), "doc_id").filter("NOT base_failed")
    assert all(r["kept"] == (r["quality"] == 1) for r in judged.collect())


def test_quality_is_one_projection(spark, sf):
    plan = quality.judge(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Arrow|Join|Aggregate", plan)


def brute_fingerprint(text, width=4):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i: i + width]) for i in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    nodes = sorted(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if linked(a, b):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def test_simhash_against_brute_force(spark, sf, texts):
    prints = {i: brute_fingerprint(t) for i, t in texts.items()}
    groups = brute_components(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    rows = simhash.near_duplicates(spark.read.parquet(f"{sf}/documents.parquet")).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {i: (f"{p:016x}", groups[i]) for i, p in prints.items()}
    kept = simhash.first_of_each(spark.read.parquet(f"{sf}/documents.parquet"))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(groups.values()))


def test_simhash_edges(spark):
    docs = spark.createDataFrame(EDGES, SCHEMA)
    rows = sorted((r["doc_id"] or 0, r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect())
    assert len(rows) == len(EDGES)
    assert [r for r in rows if r[0] in (1, 2, 3)] == [(i, "0" * 16, 1) for i in (1, 2, 3)]
    assert all(r[2] == 4 for r in rows if r[0] == 4)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    kept = simhash.first_of_each(docs)
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 4, 5, 6] and kept.columns == docs.columns


@pytest.mark.parametrize("run_rows, blocks", [(20_000, None), (20, 5), (40, 7)])
def test_links_join_what_brute_force_joins(spark, run_rows, blocks):
    rng = random.Random(run_rows)
    prints = {rng.getrandbits(64) for _ in range(150)}
    for centre in list(prints)[:4]:  # dense groups and chains
        for _ in range(60):
            centre ^= 1 << rng.randrange(64)
            prints.add(centre)
    expected = brute_components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    signed = {p: int(np.array(p, np.uint64).view(np.int64)) for p in prints}
    frame = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    links = simhash.links(frame, 4, blocks, run_rows)
    back = {s: p for p, s in signed.items()}
    assert all((back[r["a"]] ^ back[r["b"]]).bit_count() <= 4 for r in links.collect())
    roots = {r["node"]: r["root"] for r in common.components(links).collect()}
    sets = collections.defaultdict(set)
    for p, s in signed.items():
        sets[roots.get(s, s)].add(p)
    wanted = collections.defaultdict(set)
    for p, root in expected.items():
        wanted[root].add(p)
    assert sorted(map(sorted, sets.values())) == sorted(map(sorted, wanted.values()))


def test_components_of_a_chain_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    roots = {r["node"]: r["root"] for r in common.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert roots == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100)}


def brute_shingles(text, width=5):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i: i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set())


def brute_similar(texts, least=0.8):
    sets = {i: brute_shingles(t) for i, t in texts.items()}
    return brute_components(sets, lambda a, b: len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]))


def test_similar_against_brute_force(spark, sf, texts):
    """The pipeline's stage on the table and on planted copies: every pair at 0.8 or more links, none below."""
    import corpus_pipeline

    stage = dict(corpus_pipeline.STAGES)["simhash_near_dedup"]
    assert sorted(r["doc_id"] for r in stage(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf).collect()) == sorted(set(brute_similar(texts).values()))
    rng, planted = random.Random(8), {}
    for i in range(0, 600, 2):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(50, 150))]
        planted[i] = " ".join(words)
        for at in rng.sample(range(len(words)), max(1, len(words) // rng.randrange(25, 60))):
            words[at] = words[at].upper() if rng.random() < 0.3 else "other"
        planted[i + 1] = " ".join(words)
    groups = brute_similar(planted)
    exact = [len(a & b) / len(a | b) for a, b in ((brute_shingles(planted[i]), brute_shingles(planted[i + 1])) for i in range(0, 600, 2))]
    assert min(sum(0.8 <= x < 0.85 for x in exact), sum(0.85 <= x < 0.95 for x in exact), sum(x < 0.8 for x in exact)) > 20
    docs = spark.createDataFrame(list(planted.items()), "doc_id long, text string")
    for run_shingles in (similar.RUN_SHINGLES, 400):
        assert sorted(r["doc_id"] for r in similar.first_of_each(docs, run_shingles=run_shingles).collect()) == sorted(set(groups.values()))


def test_similar_takes_simhash_candidates(spark, monkeypatch):
    """Without any key of minima the links of SimHash alone bring near copies together, and the exact comparison still decides."""
    monkeypatch.setattr(similar, "band_keys", lambda found: np.empty(0, np.uint64))
    words = [f"w{i}" for i in range(400)]
    texts = {1: words, 2: [*words[:-1], "end"], 3: words[:200] * 2, 4: [f"v{i}" for i in range(400)]}
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    near = np.bitwise_count(np.uint64(simhash.fingerprint(" ".join(words).encode()) ^ simhash.fingerprint(" ".join(texts[2]).encode())))
    assert near <= simhash.DISTANCE
    assert sorted(r.doc_id for r in similar.first_of_each(docs).collect()) == [1, 3, 4]


def test_similar_edges(spark):
    docs = spark.createDataFrame(EDGES + [(9, "THE  end", "x", 1, "k"), (7, "a b c", "x", 1, "k"), (7, "not of it at all", "x", 1, "k")], SCHEMA)
    kept = similar.first_of_each(docs)
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 4, 5, 6, 7, 7] and kept.columns == docs.columns
    assert similar.first_of_each(docs.limit(0)).count() == 0
    chain = [set(range(k, k + 40)) for k in range(0, 40, 4)] + [set(range(900, 940))]  # neighbours only are at 0.8
    links = similar.link_run([np.array(sorted(s), np.uint64) for s in chain], 0.8)
    assert sorted(links) == [(k, k + 1) for k in range(9)]


def brute_repeats(docs, width):
    """doc_id, words, removed, digest for each row."""
    first = {}
    words = [(i, WORDS.findall(t or "")) for i, t in docs]
    for i, w in words:
        for k in range(len(w) - width + 1):
            if i is not None:
                key = tuple(w[k: k + width])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - width + 1):
            least = first.get(tuple(w[k: k + width]))
            if least is not None and (i is None or least < i):
                gone.update(range(k, k + width))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def repeats(docs, width=13):
    rows = substrings.without_repeats(docs, width).collect()
    for r in rows:
        assert sum(s["end"] - s["start"] for s in r["intervals"]) == r["n_removed"]
        assert all(a["end"] < b["start"] for a, b in zip(r["intervals"], r["intervals"][1:]))
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept"].encode()).hexdigest()) for r in rows), key=str)


def test_substrings_against_brute_force(spark, sf, texts):
    assert repeats(spark.read.parquet(f"{sf}/documents.parquet")) == brute_repeats(texts.items(), 13)


def test_substrings_edges(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(0, 60)))) for i in range(60)]
    rows += [(None, rows[3][1]), (None, "a b c d e f g"), (7, rows[7][1]), (8, rows[9][1]), (99, None), (98, ""), (97, "a b"), (96, "x " * 70_000)]
    docs = spark.createDataFrame([(*r, "extra") for r in rows], "doc_id long, text string, chunk string")
    assert repeats(docs, 5) == brute_repeats(rows, 5)
    assert repeats(docs.limit(0)) == []


def test_rolling_hashes_that_collide_are_told_apart():
    ids = np.array([2, 1], np.int64)
    windows = substrings.Windows(ids, [b"a b c d", b"a b c e"], 4)
    assert len(windows.main) == 2
    found = substrings._earlier_elsewhere(np.array([5, 5, 5], np.uint64), np.array([1, 2, 1], np.uint16), np.array([9, 1, 3]))
    assert found.tolist() == [True, False, False]


@given(st.lists(st.integers(0, 2**64 - 1), max_size=60), st.integers(1, 20))
@settings(max_examples=60, deadline=None)
def test_window_hashes(values, width):
    base, expected = int(common.BASES[0]), []
    for i in range(len(values) - width + 1):
        h = 0
        for v in values[i: i + width]:
            h = (h * base + v) % 2**64
        expected.append(h)
    assert common.window_hashes(np.array(values, np.uint64), width).tolist() == expected


def brute_tiles(doc, item, width):
    """Greedy string tiling by its definition: the longest unmarked match, first in order, again and again."""
    doc_taken, item_taken, tiles = [False] * len(doc), [False] * len(item), []
    while True:
        best = (0, 0, 0)
        for d in range(len(doc)):
            for i in range(len(item)):
                n = 0
                while (d + n < len(doc) and i + n < len(item) and doc[d + n] == item[i + n]
                       and not doc_taken[d + n] and not item_taken[i + n]):
                    n += 1
                if n > best[0]:
                    best = (n, d, i)
        n, d, i = best
        if n < width:
            return tiles
        tiles.append((d, i, n))
        for k in range(n):
            doc_taken[d + k] = item_taken[i + k] = True


@given(st.lists(st.sampled_from("abcd"), max_size=40), st.lists(st.sampled_from("abcd"), min_size=1, max_size=16))
@settings(max_examples=150, deadline=None)
def test_tiling_against_its_definition(doc, item):
    index = decontaminate.Index([(1, " ".join(item).encode())], 3)
    found = list(index.matches(decontaminate.tokens(" ".join(doc).encode()), 0.01))
    expected = brute_tiles(doc, item, 3) if len(item) >= 3 else [(0, 0, len(item))] if doc == item else []
    assert sorted(found[0][2]) == sorted(expected) if expected else not found


def test_contamination(spark):
    item = " ".join(f"w{i}" for i in range(20))
    parts = item.split()
    swapped = " ".join(["x y", *parts[10:], "and then", *parts[:10], "z"])
    rows = [(1, f"before {item} after"), (2, swapped), (3, "W0, w1! (w2) W3... w4; w5? w6 w7 w8 w9 w10"), (4, " ".join(parts[:9])),
            (5, None), (6, ""), (7, "nothing of it at all"), (None, item), (1, f"before {item} after"), (8, "Short!"), (9, "x " * 50_000 + item),
            (10, "a short one"), (11, "the word " * 3)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, item_id int")
    benchmark = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "short"), (5, "the"), (None, "a b c d e f")], "item_id long, text string")
    for block_words in (2_000_000, 8):
        found = decontaminate.contamination(docs, benchmark, block_words=block_words).collect()
        assert sorted((r["doc_id"] or 0, r["item_id"], r["matched_words"]) for r in found) == [
            (0, 1, 20), (1, 1, 20), (1, 1, 20), (2, 1, 20), (3, 1, 11), (8, 4, 1), (9, 1, 20)]
        clean = decontaminate.without_benchmark(docs, benchmark, block_words=block_words)
        assert sorted(r["doc_id"] for r in clean.collect()) == [4, 5, 6, 7, 10, 11] and clean.columns == docs.columns
    assert decontaminate.contamination(docs.limit(0), benchmark).count() == 0
    assert decontaminate.without_benchmark(docs, benchmark.limit(0)).count() == len(rows)


def test_repeated_words_do_not_multiply():
    """80,000 equal words against 200 of them: 16 million pairs of equal windows, 80,000 runs."""
    index = decontaminate.Index([(1, b"spam " * 200), (2, b"spam " * 100 + b"ham " * 100)], 5)
    doc = decontaminate.tokens(b"spam " * 80_000)
    item, where, inside, length = index._runs(doc)
    assert len(item) < 200_000 and (length <= 200).all()
    assert [(i, n, sum(t[2] for t in tiles)) for i, n, tiles in index.matches(doc, 0.5)] == [(1, 200, 200), (2, 200, 100)]


def test_rows_keep_columns_of_any_name(spark):
    good = " ".join(f"word{i} of the" for i in range(40))
    names = ["doc_id", "text", "__row", "__kept", "__id", "kept", "row", "body", "n_words", "whole", "place"]
    rows = [(n, good if n < 3 else f"{good} {' '.join(f'{n}x{i}' for i in range(90))}", *[10 * n + k for k in range(len(names) - 2)]) for n in (1, 2, 3, 4)]
    docs = spark.createDataFrame([*rows, (5, None, *range(len(names) - 2))], f"doc_id long, text string, {', '.join(f'`{n}` long' for n in names[2:])}")
    for found, left in ((quality.kept_rows(docs), rows), (similar.first_of_each(docs.filter("text IS NOT NULL")), [rows[0], rows[2], rows[3]]),
                        (simhash.first_of_each(docs.filter("doc_id IN (1, 2)")), [rows[0]])):
        assert found.columns == names and sorted(map(tuple, found.collect())) == left


def test_contamination_on_the_table(spark, sf, texts):
    items = {r[0]: r[1] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}

    def plain(t):
        return [p for p in (re.sub(r"[\W_]+", "", w).lower() for w in (t or "").split()) if p]

    wanted = set()
    for item_id, item in items.items():
        b = plain(item)
        seeds = {tuple(b[i: i + 5]) for i in range(len(b) - 4)}
        for doc_id, text in texts.items():
            d = plain(text)
            if any(tuple(d[i: i + 5]) in seeds for i in range(len(d) - 4)) and sum(n for _, _, n in brute_tiles(d, b, 5)) >= 0.5 * len(b):
                wanted.add((doc_id, item_id))
    found = decontaminate.contamination(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet"))
    assert {(r["doc_id"], r["item_id"]) for r in found.select("doc_id", "item_id").collect()} == wanted and wanted


def test_ngrams_of_all_words_at_once():
    buckets, owner = common.ngrams(["ab", "x", "ab"], (1, 2, 3), 16)
    assert np.bincount(owner).tolist() == [2 + 3 + 2, 1 + 2 + 1, 7]
    assert sorted(buckets[owner == 0]) == sorted(buckets[owner == 2])
    assert len(common.ngrams([], (2,), 8)[0]) == 0
