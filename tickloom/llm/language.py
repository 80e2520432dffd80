"""Languages of mixed texts.

Method: the script of a word narrows the languages it may belong to; every word
gets a score per language from its character n-grams; a Viterbi path over the
words, which pays for each switch, labels spans. The language with the most
letters is the text's.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import CACHE_WORDS, ngrams, stored, text_bytes

SIZES, BUCKET_BITS = (1, 2, 3), 16
#: Texts fitted per language, at most (in expectation, by a hash of the row).
SAMPLE = 2_000
#: Cost of a switch, in nats; weight of a bucket nobody has seen; words a language must have of a script, as a share.
SWITCH, SMOOTHING, SCRIPT_SHARE = 12.0, 0.1, 0.01
#: What a word costs in a language that does not use its script.
WRONG_SCRIPT = 30.0
UNKNOWN = "und"

#: First code points of scripts, up to the next entry. Fixed values of Unicode blocks.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0700, "other"), (0x0750, "arabic"), (0x0780, "other"), (0x08A0, "arabic"), (0x0900, "devanagari"), (0x0980, "bengali"),
    (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"),
    (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"), (0x1780, "khmer"), (0x1800, "mongolian"),
    (0x18B0, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"),
    (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"), (0x31F0, "kana"), (0x3200, "other"), (0x3400, "han"), (0xA000, "other"),
    (0xA720, "latin"), (0xA800, "other"), (0xAC00, "hangul"), (0xD800, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB13, "other"),
    (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFE70, "arabic"), (0xFF00, "other"), (0xFF21, "latin"), (0xFF66, "kana"),
    (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"), (0x32000, "other"),
)
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
_FIRST = np.array([first for first, _ in SCRIPTS])
_NUMBER = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS])
_RUNS = re.compile(r"[^\W\d_]+")
#: Buckets of n-grams, then one per script.
WIDTH = (1 << BUCKET_BITS) + len(SCRIPT_NAMES)


def script_of(letter: str) -> int:
    """Number of the script that a letter belongs to."""
    return int(_NUMBER[np.searchsorted(_FIRST, ord(letter), side="right") - 1])


def scripts_of(letters: list[str]) -> np.ndarray:
    """Script numbers of many letters."""
    return _NUMBER[np.searchsorted(_FIRST, np.fromiter(map(ord, letters), np.int64, len(letters)), side="right") - 1]


def letter_runs(word: bytes) -> list[str]:
    """The runs of letters of a word or text, in lower case."""
    return _RUNS.findall(word.decode("utf-8", "replace").lower())


@dataclass
class Model:
    """Log weights of buckets per language, and the scripts each language uses."""

    languages: list[str]
    weights: np.ndarray  # bucket x language
    uses: np.ndarray  # script x language

    def prepare(self) -> None:
        self.rows: dict[bytes, int] = {}
        # Room for words to come: a batch writes its own rows and copies no others.
        self.table = np.zeros((1 << 12, len(self.languages)))
        self.letters = np.zeros(1 << 12, np.int64)

    def learn(self, words: set[bytes]) -> None:
        """Score all words that are not known yet, in one go."""
        new = list(words.difference(self.rows))
        if len(self.rows) + len(new) > CACHE_WORDS:
            self.prepare()
            new = list(words)
        runs = [letter_runs(word) for word in new]
        owner = np.repeat(np.arange(len(new)), [len(r) for r in runs])
        flat = [run for r in runs for run in r]
        scores, letters = np.zeros((len(new), len(self.languages))), np.zeros(len(new), np.int64)
        buckets, run = ngrams(flat, SIZES, BUCKET_BITS)
        if len(flat):
            np.add.at(letters, owner, [len(r) for r in flat])
            for k in range(len(self.languages)):
                scores[:, k] = np.bincount(owner[run], self.weights[buckets, k], len(new))
            uses = self.uses[scripts_of([r[0] for r in flat])]
            np.add.at(scores, owner, -WRONG_SCRIPT * (uses.any(axis=1, keepdims=True) & ~uses))
        first, last = len(self.rows), len(self.rows) + len(new)
        if last > len(self.letters):
            more = max(last, 2 * len(self.letters)) - first
            self.table = np.concatenate((self.table[:first], np.zeros((more, len(self.languages)))))
            self.letters = np.concatenate((self.letters[:first], np.zeros(more, np.int64)))
        self.table[first:last], self.letters[first:last] = scores, letters
        self.rows.update(zip(new, range(first, last)))

    def read(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Scores and letters of the words that have letters."""
        at = np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))
        letters = self.letters[at]
        return self.table[at[letters > 0]], letters[letters > 0]


def one_language(scores: np.ndarray, switch: float = SWITCH) -> int | None:
    """The language of the whole path if no detour can pay, else None.

    A detour into k spans costs k - 1 switches or more. If no other language gains
    half a switch over the best one on any span, no detour pays.
    """
    best = int(scores.sum(axis=0).argmax())
    gains = np.cumsum(np.vstack((np.zeros(scores.shape[1]), scores - scores[:, [best]])), axis=0)
    most = (gains - np.minimum.accumulate(gains, axis=0)).max()
    return best if most < switch / 2 else None


def viterbi(texts: list[np.ndarray], switch: float = SWITCH) -> list[np.ndarray]:
    """Best label paths of several texts at once: word by word over all of them, longest first."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    lengths = np.array([len(texts[i]) for i in order])
    paths: list[np.ndarray] = [np.empty(0, np.int64)] * len(texts)
    start = 0
    while start < len(order):
        longest = max(1, int(lengths[start]))
        stop = min(len(order), start + max(1, 2_000_000 // (longest * texts[0].shape[1])))
        group, n = order[start:stop], lengths[start:stop]
        grid = np.zeros((longest, len(group), texts[0].shape[1]))
        for column, i in enumerate(group):
            grid[: len(texts[i]), column] = texts[i]
        came = np.zeros(grid.shape, np.int16)
        state, here = grid[0].copy(), np.arange(grid.shape[2])
        finals = np.zeros(len(group), np.int64)
        for t in range(1, longest + 1):
            ended = np.flatnonzero(n == t)
            finals[ended] = state[ended].argmax(axis=1)
            if t == longest:
                break
            live = int(np.searchsorted(-n, -t))  # texts longer than t come first
            part = state[:live]
            top = part.argmax(axis=1)
            jump = part[np.arange(live), top][:, None] - switch
            stay = part >= jump
            came[t, :live] = np.where(stay, here, top[:, None])
            state[:live] = np.where(stay, part, jump) + grid[t, :live]
        for column, i in enumerate(group):
            path = np.zeros(len(texts[i]), np.int64)
            label = int(finals[column])
            for t in range(len(path) - 1, -1, -1):
                path[t] = label
                label = int(came[t, column, label])
            paths[i] = path
        start = stop
    return paths


def train(docs: DataFrame, per_language: int = SAMPLE) -> Model:
    """Fit on ``docs`` (doc_id, text, lang): at most about ``per_language`` texts of each language.

    Rows without text or lang are left out. Which rows are taken depends on a hash
    of the doc_id only. Without rows the model knows no language.
    """
    named = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", text_bytes().alias("text"), F.col("lang").cast("string"))
    sizes = {r["lang"]: r["n"] for r in named.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row per language
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((1 << BUCKET_BITS, 0)), np.zeros((len(SCRIPT_NAMES), 0), bool))
    rate = F.create_map(*[x for lang in languages for x in (F.lit(lang), F.lit(min(1.0, per_language / sizes[lang])))])
    dice = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / (1 << 20)
    taken = stored(named.filter(dice < rate[F.col("lang")]).select("lang", "text"), "language-texts")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                runs = letter_runs(text)
                counts = found.setdefault(lang, np.zeros(WIDTH, np.int64))
                counts[: 1 << BUCKET_BITS] += np.bincount(ngrams(runs, SIZES, BUCKET_BITS)[0], minlength=1 << BUCKET_BITS)
                firsts, times = np.unique([r[0] for r in runs], return_counts=True)
                for letter, n in zip(firsts, times):
                    counts[(1 << BUCKET_BITS) + script_of(str(letter))] += n
        for lang, counts in found.items():
            present = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(present)), pa.array(present.astype(np.int32)), pa.array(counts[present])], ["lang", "bucket", "n"])

    # At most WIDTH rows per language.
    counts = taken.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros((WIDTH, len(languages)))
    table[counts["bucket"].to_numpy(np.int64), [languages.index(x) for x in counts["lang"]]] = counts["n"]
    seen, scripts = table[: 1 << BUCKET_BITS], table[1 << BUCKET_BITS:]
    used = np.count_nonzero(seen.sum(axis=1)) + 1
    weights = np.log((seen + SMOOTHING) / (seen.sum(axis=0) + SMOOTHING * used))
    return Model(languages, weights, scripts > SCRIPT_SHARE * np.maximum(1, scripts.sum(axis=0)))


def spans(path: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs of one label: first word, word after the last, label."""
    edges = np.flatnonzero(np.concatenate(([True], path[1:] != path[:-1], [True]))) if len(path) else np.empty(0, np.int64)
    return [(int(a), int(b), int(path[a])) for a, b in zip(edges[:-1], edges[1:])]


RESULT = "struct<lang:string,score:double,spans:array<struct<start:bigint,end:bigint,lang:string>>>"


def languages(text: Column, model: Model, spark) -> Column:
    """A struct of the text's language, its share of the letters, and the labelled spans (of words with letters).

    A text that is null or has no letter is ``und`` with score 0; so is any if the
    model knows no language. Of languages with equal shares the first by name counts.
    """
    shared = spark.sparkContext.broadcast((model.languages, model.weights, model.uses))
    ready: list[Model] = []

    def run(texts: pa.Array) -> pa.Array:
        if not ready:
            ready.append(Model(*shared.value))
            ready[0].prepare()
        m = ready[0]
        out: list[dict] = []
        open_rows: list[int] = []
        open_scores: list[np.ndarray] = []
        kept: list[np.ndarray] = []

        def put(row: int, path: np.ndarray, letters: np.ndarray) -> None:
            weight = np.bincount(path, letters, len(m.languages))
            best = int(weight.argmax())
            out[row] = {"lang": m.languages[best], "score": float(weight[best] / weight.sum()),
                        "spans": [{"start": a, "end": b, "lang": m.languages[k]} for a, b, k in spans(path)]}

        def settle() -> None:
            for row, path, letters in zip(open_rows, viterbi(open_scores), kept):
                put(row, path, letters)
            for x in (open_rows, open_scores, kept):
                x.clear()

        for first in range(0, len(texts), 500):  # words of so many texts are held at once
            batch = [(t or b"").split() for t in texts.slice(first, 500).to_pylist()]
            m.learn(set().union(*batch))
            for row, words in enumerate(batch, first):
                scores, letters = m.read(words)
                out.append({"lang": UNKNOWN, "score": 0.0, "spans": []})
                if not len(letters) or not m.languages:
                    continue
                label = one_language(scores)
                if label is not None:
                    put(row, np.full(len(letters), label), letters)
                    continue
                open_rows.append(row)
                open_scores.append(scores)
                kept.append(letters)
            if open_rows:
                settle()
        kind = pa.struct([("lang", pa.string()), ("score", pa.float64()),
                          ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])))])
        return pa.array(out, kind)

    return F.arrow_udf(run, RESULT)(text.cast("binary"))


def identified(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and lang_spans; other columns stay, repeated rows get equal results."""
    out = docs.withColumn("__language", languages(F.col(text), model, docs.sparkSession))
    return out.withColumns({"lang_pred": F.col("__language.lang"), "score": F.col("__language.score"), "lang_spans": F.col("__language.spans")}).drop("__language")
