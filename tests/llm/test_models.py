"""Toxicity and language: accuracy on held-out rows, brute-force paths, edge cases; and the pipeline's stages."""

import itertools
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tickloom.llm import decontaminate, language, pii, queries, toxicity

SCHEMA = "doc_id long, text string, score string, lang string"


def crowd(spark, n=400):
    """Texts of two invented languages; every fifth holds an insult."""
    rng, rows, labels = random.Random(3), [], []
    for i in range(n):
        parts = ("ba", "do", "ki", "lu") if i % 2 else ("ne", "ra", "sto", "vy")
        words = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(20, 80))]
        if i % 5 == 0:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(("grumpf!", "Grumpfo", "zozzig")))
        rows.append((i, " ".join(words), "x", "aa" if i % 2 else "bb"))
        labels.append((i, int(i % 5 == 0)))
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_of_rows_that_were_not_learned(spark):
    docs, labels = crowd(spark)
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    model = toxicity.train(docs, labels.filter(fold != 0))
    rows = toxicity.scored(docs, model).join(labels, "doc_id").filter(fold == 0).collect()
    assert len(rows) > 50 and sum(r["predicted"] == r["toxic"] for r in rows) >= 0.97 * len(rows)
    again = toxicity.train(docs, labels.filter(fold != 0))
    assert (again.weights == model.weights).all() and again.intercept == model.intercept


def test_toxicity_edges(spark):
    docs, labels = crowd(spark, 60)
    rows = [(1, None, "s", "l"), (2, "", "s", "l"), (None, "grumpf!", "s", "l"), (3, "é 漢字 \U0001f600 ###", "s", "l"), (3, "ba " * 60_000, "s", "l"), (3, "ba " * 60_000, "s", "l")]
    model = toxicity.train(docs, labels.unionByName(spark.createDataFrame([(None, 1), (7, None), (8, 5), (10**6, 1)], labels.schema)))
    edge = spark.createDataFrame(rows, SCHEMA)
    out = toxicity.scored(edge, model).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)
    assert out[0]["score"] == out[1]["score"] and out[4]["score"] == out[5]["score"] and out[2]["score"] > out[4]["score"]
    assert toxicity.scored(edge.limit(0), model).count() == 0
    for few in (labels.limit(0), labels.filter("toxic = 0")):
        constant = toxicity.scored(edge, toxicity.train(docs, few)).collect()
        assert len({r["score"] for r in constant}) == 1 and constant[0]["score"] <= 0.5


def test_logistic_fit_reaches_the_minimum():
    rng = np.random.default_rng(0)
    rows = [(np.flatnonzero(rng.random(6) < 0.5), None) for _ in range(80)]
    rows = [(f.astype(np.int32), np.ones(len(f), np.float32)) for f, _ in rows]
    y = np.array([float(0 in f or rng.random() < 0.2) for f, _ in rows])
    w, b = toxicity.fit_logistic(rows, y, np.ones(6), penalty=1.0, steps=300)
    z = np.array([w[f].sum() + b for f, _ in rows])
    miss = 1 / (1 + np.exp(-z)) - y
    gradient = np.array([sum(m for (f, _), m in zip(rows, miss) if k in f) for k in range(6)]) + w
    assert np.abs(gradient).max() < 0.05 and abs(miss.sum()) < 0.05


def test_language_of_rows_that_were_not_learned(spark, sf):
    rows = queries.op10(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert {r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows} == {True}
    assert len(held) > 30 and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)


def test_spans_of_mixed_text_and_edges(spark):
    docs, _ = crowd(spark, 80)
    model = language.train(docs)
    mixed = "ba doki ludo kiba " * 10 + "nera stovy vyra neneva " * 12
    rows = [(1, mixed, "s", "l"), (2, None, "s", "l"), (3, "", "s", "l"), (4, "123 ### 4.5", "s", "l"), (None, "bado", "s", "l"), (5, "Ба до ки", "s", "l"), (6, "doki " * 60_000, "s", "l"), (6, "doki " * 60_000, "s", "l")]
    frame = spark.createDataFrame(rows, SCHEMA)
    out = language.identified(frame, model).collect()
    assert [r["lang_pred"] for r in out[:5]] == ["bb", "und", "und", "und", "aa"] and out[1]["score"] == 0.0
    spans = [(s["start"], s["end"], s["lang"]) for s in out[0]["lang_spans"]]
    assert spans == [(0, 40, "aa"), (40, 88, "bb")] and 0.5 < out[0]["score"] < 0.7
    assert out[6]["lang_pred"] == out[7]["lang_pred"] == "aa" and out[6]["score"] == 1.0
    assert language.identified(frame.limit(0), model).count() == 0
    none = language.identified(frame, language.train(docs.limit(0))).collect()
    assert {r["lang_pred"] for r in none} == {"und"}


@given(st.lists(st.lists(st.lists(st.integers(-9, 9), min_size=3, max_size=3), min_size=1, max_size=6), min_size=1, max_size=4))
@settings(max_examples=60, deadline=None)
def test_viterbi_against_all_paths(texts):
    def value(scores, path):
        return sum(s[k] for s, k in zip(scores, path)) - 5.0 * sum(a != b for a, b in zip(path, path[1:]))

    found = language.viterbi([np.array(t, float) for t in texts], 5.0)
    for scores, path in zip(texts, found):
        best = max(value(scores, p) for p in itertools.product(range(3), repeat=len(scores)))
        assert value(scores, path.tolist()) == best
        single = language.one_language(np.array(scores, float), 5.0)
        assert single is None or value(scores, [single] * len(scores)) == best


def test_script_ranges():
    names = [language.SCRIPT_NAMES[language.script_of(c)] for c in "aéяλ漢あ한אعअไ"]
    assert names == ["latin", "latin", "cyrillic", "greek", "han", "kana", "hangul", "hebrew", "arabic", "devanagari", "thai"]


def test_stages_against_brute_force(spark, sf):
    """Each stage on what its predecessor kept, against plain Python."""
    from tests.llm.test_text_rules import brute_measures, brute_similar
    from tickloom.llm import quality

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, rows = docs.columns, {r["doc_id"]: r for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_near_dedup", "benchmark_decontamination", "pii_pseudonyms", "best_fit_packing"]

    def passes(text):
        n, chars, symbols, _, repeated = brute_measures(text)
        if n < 50 or 100 * repeated > 50 * n:
            return False
        lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\f\r")]
        words = text.split()
        return (2 <= chars / n <= 15 and symbols / n <= 0.1 and sum(text.count(c) for c in "!?") / n <= 0.5
                and sum(w in quality.STOP_WORDS for w in words) / n >= 0.005 and (len(lines) - len(set(lines))) / max(1, len(lines)) <= 0.5)

    def step(name, frame):
        out = corpus_pipeline.stored(stages[name](spark, frame, sf), "test")
        assert out.columns == columns
        return out, {r["doc_id"]: r for r in out.collect()}

    frame, kept = step("quality_rules", docs)
    assert set(kept) == {i for i, r in rows.items() if passes(r["text"])}
    frame, found = step("simhash_near_dedup", frame)
    assert set(found) == set(brute_similar({i: r["text"] for i, r in kept.items()}).values())
    index = decontaminate.Index([(r[0], r[1].encode()) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()], 5)
    clean = {i for i, r in found.items() if not list(index.matches(decontaminate.tokens(r["text"].encode()), 0.5))}
    frame, kept = step("benchmark_decontamination", frame)
    assert set(kept) == clean and len(clean) < len(found)
    permute = pii.Permutation(pii.TEST_KEY)
    frame, found = step("pii_pseudonyms", frame)
    assert {i: r["text"] for i, r in found.items()} == {i: pii.pseudonymise(r["text"], permute)[0] for i, r in kept.items()}
    assert all(tuple(r[c] for c in columns if c != "text") == tuple(rows[i][c] for c in columns if c != "text") for i, r in found.items())
    packed = stages["best_fit_packing"](spark, frame, sf)
    assert {r["doc_id"] for r in packed.collect()} == set(found)


def test_stages_take_empty_tables_and_nulls(spark, sf):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    good = " ".join(f"word{i} of the" for i in range(40))
    frame = spark.createDataFrame([(None, good, None, None, None), (1, None, "en", "s", 0), (2, good, None, "s", 9), (2, good, None, "s", 9)], schema)
    for start in (frame, frame.limit(0)):
        docs = start
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stored(stage(spark, docs, sf), "test")
        assert {r["doc_id"] for r in docs.collect()} == ({None, 2} if start is frame else set())


def test_word_table_grows_in_place():
    """A batch of new words writes its own rows: the table is not copied for every batch, and earlier scores stay."""
    model = language.Model(["a", "b"], np.random.default_rng(1).random((1 << language.BUCKET_BITS, 2)), np.ones((len(language.SCRIPT_NAMES), 2), bool))
    model.prepare()
    batches = [[f"{''.join(chr(97 + int(d)) for d in str(n))}x{chr(97 + k % 26)}".encode() for n in range(50 * k, 50 * k + 50)] for k in range(200)]
    model.learn(set(batches[0]))
    before, tables = model.read(batches[0])[0].copy(), set()
    kept = []
    for batch in batches:
        model.learn(set(batch))
        if id(model.table) not in tables:
            tables.add(id(model.table))
            kept.append(model.table)
    assert len(kept) <= 3 and (model.read(batches[0])[0] == before).all() and len(model.read(batches[-1])[1]) == 50
