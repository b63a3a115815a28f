"""Language of mixed texts: scripts narrow the candidates, Viterbi labels spans of words.

A model is learned from labelled texts: for each language the counts of hashed letter
n-grams of its words, and how often its words are of each script. A word scores, per language
that uses its script, the log likelihood of its n-grams; a language that does not use the
script cannot have the word. The path of labels over all words of a text maximises the scores
less a penalty per change of language, so stray words do not change the language and longer
passages do. The words of many texts advance together, a step per word position.

Training reads a sample of about TRAINING_DOCS texts per language, chosen by hash with the
fraction that the counts of the labels give; the model has a fixed number of counts per
language, so it is bounded by the number of languages.

Defined results: a null text, or one without letters, is ``und`` with score 0 and no spans;
so is every text if there is nothing to learn from; letters of words whose script no learned
language uses are unknown and count against the score; null labels are not learned; a null id is
neither learned from nor held out; texts are read whole; ties go to the smaller language name.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.llm.common import carried, small_batches, table

TRAINING_DOCS = 2000
GRAMS = 1 << 16
SWITCH = 12.0
#: Least share of a language's words in a script for the language to be a candidate there.
SCRIPT_SHARE = 0.01
#: Least share of the letters in recognised languages, for the pipeline to keep a document.
KEEP_SHARE = 0.5
#: A span is recognised if its n-grams are likelier than this: all n-grams alike.
EVEN = -float(np.log(GRAMS))
#: A word counts as so many independent n-grams; the score of a language that does not use its script.
WORD_SCALE = 4.0
FOREIGN = -50.0
#: Texts and words labelled together.
ROWS = 256
BLOCK = 150_000
SPANS = pa.list_(pa.struct([("first_word", pa.int64()), ("n_words", pa.int64()), ("lang", pa.string())]))


def signs(*categories: str) -> str:
    """The characters of general categories, by their first letters, as ranges for a character class."""
    ranges: list[list[int]] = []
    for code in range(sys.maxunicode + 1):
        if unicodedata.category(chr(code))[0] in categories:
            if ranges and ranges[-1][1] == code - 1:
                ranges[-1][1] = code
            else:
                ranges.append([code, code])
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in ranges)


#: A word: a letter, and what follows of letters and marks.
LETTERS = re.compile(f"[{signs('L')}][{signs('L', 'M')}]*")
#: The same for texts without characters from U+0300 on, where marks begin: quicker, with the numbers before it named.
LOW_LETTERS, HIGH = re.compile(r"[^\W\d_²³¹¼½¾]+"), re.compile("[\u0300-\U0010ffff]")

# First code points of the ranges that tell scripts apart, and their names.
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "indic"),
    (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3130, "hangul"),
    (0x3190, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"),
    (0xF900, "han"), (0xFB00, "latin"), (0xFB07, "other"), (0x20000, "han"), (0x30000, "other"),
]
_FIRST = [first for first, _ in SCRIPTS]
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
_NUMBER = [SCRIPT_NAMES.index(name) for _, name in SCRIPTS]

carried(__name__)


def script(word: str) -> int:
    """The script of a word, by its first letter, as a place in SCRIPT_NAMES."""
    return _NUMBER[bisect_right(_FIRST, ord(word[0])) - 1]


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed runs of two to four letters of words and their edges: (place of the word, slot)."""
    codes = np.frombuffer("".join([f"^{w}$" for w in words]).encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    places, slots, run = [], [], codes
    for n in (2, 3, 4):
        run = (run[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ codes[n - 1:]
        inside = owner[:len(run)] == owner[n - 1:]
        slot = run[inside] * np.uint64(0xD6E8FEB86659FD93)
        places.append(owner[:len(run)][inside])
        slots.append(((slot >> np.uint64(40)) % np.uint64(GRAMS)).astype(np.int64))
    return np.concatenate(places), np.concatenate(slots)


def words_in(text: str) -> list[str]:
    return (LETTERS if not text.isascii() and HIGH.search(text) else LOW_LETTERS).findall(text)


@dataclass
class Model:
    """Log likelihoods of n-grams, a row per n-gram, and which languages use a script."""

    languages: list[str]
    likelihood: np.ndarray
    uses: np.ndarray


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            counts = totals.setdefault(lang, np.zeros(GRAMS + len(SCRIPT_NAMES), np.int64))
            found = Counter(words_in(text.lower()))
            if found:
                times = np.array(list(found.values()))
                place, slot = grams(list(found))
                np.add.at(counts, slot, times[place])
                np.add.at(counts, [GRAMS + script(w) for w in found], times)
    for lang, counts in totals.items():
        slots = np.flatnonzero(counts)
        yield pd.DataFrame({"lang": lang, "slot": slots, "n": counts[slots]})


def learn(labelled: DataFrame, sample: int = TRAINING_DOCS) -> Model:
    """A model from (text, lang, lot): lot is a number in [0, 1) by which texts are chosen."""
    small_batches(labelled.sparkSession)
    labelled = labelled.where("lang is not null and text is not null")
    per_language = labelled.groupBy("lang").count()
    chosen = labelled.join(F.broadcast(per_language), "lang").where(F.col("lot") * F.col("count") < sample)
    # at most GRAMS + len(SCRIPT_NAMES) rows per language
    rows = chosen.select("lang", "text").mapInPandas(_count, "lang string, slot long, n long").groupBy(
        "lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(rows["lang"].unique())
    counts = np.zeros((GRAMS + len(SCRIPT_NAMES), len(languages)))
    counts[rows["slot"].to_numpy(np.int64), rows["lang"].map(languages.index).to_numpy(np.int64)] = rows["n"]
    seen = counts[:GRAMS] + 0.5
    scripts = counts[GRAMS:]
    uses = scripts >= np.maximum(1.0, SCRIPT_SHARE * scripts.sum(axis=0, keepdims=True))
    return Model(languages, np.log(seen / seen.sum(axis=0, keepdims=True)).astype(np.float32), uses)


def likelihoods_of(words: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """A row per word of the log likelihoods of its n-grams, one per language, and how many n-grams it has."""
    place, slot = grams(words)
    n = np.bincount(place, minlength=len(words))
    return np.stack([np.bincount(place, weights=model.likelihood[slot, k], minlength=len(words))
                     for k in range(len(model.languages))], axis=1), n


def scores_of(likelihoods: np.ndarray, n: np.ndarray, uses: np.ndarray) -> np.ndarray:
    """A row of scores per word, one per language, the best at 0."""
    mean = np.where(uses, likelihoods / n[:, None] * WORD_SCALE, -np.inf)
    best = mean.max(axis=1, keepdims=True)
    known = np.isfinite(best)
    return np.where(known, np.where(uses, mean - np.where(known, best, 0), FOREIGN), 0).astype(np.float32)


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """The best label of every word; the words of texts, of ``lengths`` > 0, lie one after another."""
    order = np.argsort(-lengths, kind="stable")
    begins = (np.cumsum(lengths) - lengths)[order]
    ordered = lengths[order]
    total, n_langs = scores.shape
    came = np.empty((total, n_langs), np.int16)
    best = scores[begins].astype(np.float64)
    states = np.arange(n_langs, dtype=np.int16)[None, :]
    longest = int(ordered[0])
    active = np.searchsorted(-ordered, -np.arange(1, longest + 1), side="right")  # texts with a word at each step
    for step in range(1, longest):
        k = active[step]
        now = best[:k]
        at = begins[:k] + step
        top = now.argmax(axis=1)
        changed = now[np.arange(k), top][:, None] - penalty
        stay = now >= changed
        came[at] = np.where(stay, states, top[:, None])
        best[:k] = np.where(stay, now, changed) + scores[at]
    labels = np.empty(total, np.int16)
    label = best.argmax(axis=1).astype(np.int16)
    for step in range(longest - 1, -1, -1):
        k = active[step]
        at = begins[:k] + step
        labels[at] = label[:k]
        if step:
            label[:k] = came[at, label[:k]]
    return labels


Labels = tuple[list[str], list[float], list[list[dict]], list[float]]


def label_texts(texts: list[str | None], model: Model) -> Iterator[Labels]:
    """Languages, scores, spans and covered shares of texts, for as many at a time as fill a block of words."""
    found, n = [], 0
    for text in texts:
        found.append(words_in(text) if text else [])
        n += len(found[-1])
        if n >= BLOCK:
            yield _labelled(found, model)
            found, n = [], 0
    if found:
        yield _labelled(found, model)


def _labelled(found: list[list[str]], model: Model) -> Labels:
    languages = model.languages
    n_words = np.array([len(w) for w in found])
    has = np.flatnonzero(n_words > 0)
    spans: list[list[dict]] = [[] for _ in found]
    predicted, score, covered = ["und"] * len(found), [0.0] * len(found), [0.0] * len(found)
    if len(has) and languages:
        flat = list(chain.from_iterable(found))
        vocabulary = dict.fromkeys(flat)
        vocabulary.update(zip(vocabulary, range(len(vocabulary))))
        words = [w.lower() for w in vocabulary]
        uses = model.uses[[script(w) for w in words]]
        likelihoods, n_grams = likelihoods_of(words, model)
        rows = scores_of(likelihoods, n_grams, uses)
        numbers = np.array(list(map(vocabulary.__getitem__, flat)), np.int64)
        letters = np.array(list(map(len, vocabulary)), np.int64)[numbers]
        labels = viterbi(rows[numbers], n_words[has])
        # words without a candidate language are in none of them
        candidate = uses.any(axis=1)[numbers]
        known = np.where(candidate, letters, 0)
        above = np.where(candidate, likelihoods[numbers, labels] - EVEN * n_grams[numbers], 0.0)
        ends = np.cumsum(n_words[has])
        for i, lo, hi in zip(has, ends - n_words[has], ends):
            share = np.bincount(labels[lo:hi], weights=known[lo:hi], minlength=len(languages))
            top, total = int(share.argmax()), letters[lo:hi].sum()
            predicted[i], score[i] = languages[top], float(share[top] / total)
            cuts = [0, *(np.flatnonzero(np.diff(labels[lo:hi])) + 1).tolist(), hi - lo]
            spans[i] = [{"first_word": a, "n_words": b - a, "lang": languages[labels[lo + a]]}
                        for a, b in zip(cuts, cuts[1:])]
            recognised = np.add.reduceat(above[lo:hi], cuts[:-1]) > 0
            covered[i] = float(np.add.reduceat(known[lo:hi], cuts[:-1])[recognised].sum() / total)
    return predicted, score, spans, covered


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of batches, ROWS at a time: texts become Python strings a few at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _joined(texts: list[str | None], model: Model) -> Labels:
    parts = list(label_texts(texts, model))
    return tuple(list(chain.from_iterable(p[k] for p in parts)) for k in range(4))


def label(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (text and others, without the text) with lang_pred, score and the spans of words.

    ``score`` is the share of the letters that lies in spans of the language found. A span
    counts words as runs of letters, from 0.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            predicted, score, spans, _ = _joined(batch.column("text").to_pylist(), model)
            others = batch.drop_columns(["text"])
            yield pa.RecordBatch.from_arrays(
                [*others.columns, pa.array(predicted, pa.string()), pa.array(score, pa.float64()),
                 pa.array(spans, SPANS)],
                names=[*others.schema.names, "lang_pred", "score", "spans"])

    others = T.StructType([f for f in docs.schema.fields if f.name != "text"])
    return docs.mapInArrow(run, others.add("lang_pred", "string").add("score", "double").add(
        "spans", T.ArrayType(T.StructType().add("first_word", "long").add("n_words", "long").add("lang", "string"))))


def fold(doc_id: Column) -> Column:
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4


def train(documents: DataFrame) -> Model:
    lot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    return learn(documents.where(fold(F.col("doc_id")) != 2).select("text", "lang", lot.alias("lot")))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out")
    return label(docs.select("doc_id", held_out, "text"), train(docs)).drop("spans")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters of which at least KEEP_SHARE are in recognised languages, one or several.

    With nothing to learn from, every document with letters is kept.
    """
    model = train(docs)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = batch.column("text").to_pylist()
            if model.languages:
                kept = [share >= KEEP_SHARE for share in _joined(texts, model)[3]]
            else:
                kept = [bool(text and LETTERS.search(text)) for text in texts]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
