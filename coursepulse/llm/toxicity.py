"""Toxicity scores: gradient-boosted trees over dense features with isotonic calibration.

Features of a text (counted over whole Arrow columns): densities of a fixed insult lexicon and of a
lexicon learned from the labels, insults written with look-alike characters or separators
(obfuscation), second-person pronouns and their proximity to insults, capitals, punctuation and
repeated marks. The learned lexicon is a greedy cover: word beginnings of 4 to 7 letters that occur
often in toxic rows and hardly ever in others, each chosen for the toxic rows it adds, so copies of
one text cannot fill it with that text's words.

Labels are learned only from rows outside the held-out fold ``crc32(id) mod 4 = 2``; of the other
three folds two fit the lexicon and the trees and one fits the calibration. The fit uses at most
``FIT_ROWS`` labelled rows, taken by a hash of the id; every document is scored from its whole text.

Defined results: a null or empty text has all features 0 and is scored like any other; conflicting
labels of an id count as toxic if one says so; without labelled rows of both classes every score is
the share of toxic rows (0 without any); repeated rows get a row each; an empty table gives an empty
result; other columns are passed on by ``with_scores`` and never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coursepulse.llm.quality import n_letters, n_words, word_chars
from coursepulse.llm.scratch import written
from coursepulse.llm.words import per_row, regex_count, rows_of, sliced, split_words, text_array

HELD_OUT, CALIBRATION = 2, 3
FIT_ROWS = 20_000
THRESHOLD = 0.3
TREES, DEPTH = 20, 3

# Common insults and slurs on persons, stated plainly.
INSULTS = """
asshole bastard bitch bullshit clown cretin cunt dick dipshit disgusting dumb dumbass fag faggot filth
filthy freak fuck fucker fucking idiot idiotic imbecile jerk loser lunatic maggot moron moronic motherfucker
nazi pathetic pig prick pussy retard retarded scum scumbag shit shithead shitty slut stupid trash twat vermin
whore worthless
arschloch dummkopf fotze hurensohn missgeburt schlampe vollidiot wichser
abruti batard connard connasse crétin débile enculé imbécile merde ordure pute salope
cabrón estúpido gilipollas hijoputa idiota imbécil maricón mierda pendejo puta
""".split()
# Words that threaten or dehumanise.
THREATS = "die hang hate kill murder rape slaughter strangle suicide".split()
# Second-person pronouns of the four languages.
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr euch tu toi te ton vous tú tu ti usted vosotros".split()
# Look-alikes of a letter in obfuscated writing.
LOOK_ALIKES = {"a": "a@4", "e": "e3", "i": "i1!|", "o": "o0", "s": "s$5", "t": "t7+", "l": "l1|", "b": "b8", "g": "g9"}


def _escape(chars: str) -> str:
    return "".join("\\" + c if c in r"\^]-[.*+?{}|()$" else c for c in chars)


def _obfuscated(word: str) -> str:
    """The word with look-alikes, and with one mark at most between its letters."""
    letters = ["[" + _escape(LOOK_ALIKES.get(c, c)) + "]" for c in word]
    return r"[._*\-]?".join(letters)


_EDGE = r"(?:^|[^\pL\pN])"
_LEX = "(?:" + "|".join(sorted(set(INSULTS))) + ")"
_THREAT = "(?:" + "|".join(THREATS) + ")"
_YOU = "(?:" + "|".join(sorted(set(SECOND_PERSON))) + ")"
_GAP = r"(?:[^\pL\pN]+[\pL\pN]+){0,4}[^\pL\pN]+"
PATTERNS = {
    "insults": rf"(?i){_EDGE}{_LEX}s?\b",
    "threats": rf"(?i){_EDGE}{_THREAT}\b",
    "second_person": rf"(?i){_EDGE}{_YOU}\b",
    "proximity": rf"(?i){_EDGE}(?:{_YOU}{_GAP}{_LEX}|{_LEX}{_GAP}{_YOU})\b",
    "obfuscated": "(?i)" + _EDGE + "(?:" + "|".join(_obfuscated(w) for w in sorted(set(INSULTS)) if len(w) > 3 and w.isascii()) + r")\b",
    "capitals": r"\p{Lu}",
    "capital_words": rf"{_EDGE}\p{{Lu}}{{2,}}\b",
    "exclamations": r"[!?]",
    "runs": r"[!?.#*$%&]{2,}",
    "punctuation": r"[\pP\pS]",
}
FEATURES = ("stems", "stem_density", "insults", "insult_density", "threat_density", "you_density", "proximity_density", "obfuscated_density",
            "capitals", "capital_words", "exclamations", "runs", "punctuation", "log_words", "mean_word")


STEM_LENGTHS = (4, 5, 6, 7)
MIN_TOXIC_ROWS, MIN_PRECISION, MAX_CANDIDATES = 4, 0.6, 2_000
DENSE = 200  # a row counts for a stem that begins one in so many of its words, or more


def _beginnings(words: pa.Array) -> dict[int, pa.Array]:
    """Lower-case beginnings of the letters of each word, by length; null for shorter words."""
    plain = pc.utf8_lower(pc.replace_substring_regex(words, r"[^\pL]+", ""))
    size = pc.utf8_length(plain)
    return {k: pc.if_else(pc.greater_equal(size, k), pc.utf8_slice_codeunits(plain, 0, k), None) for k in STEM_LENGTHS}


def stem_counts(a: pa.Array, stems: list[str]) -> np.ndarray:
    """Words that begin with one of the stems."""
    ids, words, offs = split_words(a)
    hit = np.zeros(len(words), bool)
    for k, begin in _beginnings(words).items():
        own = [x for x in stems if len(x) == k]
        if own:
            hit |= np.asarray(pc.is_in(begin, pa.array(own, pa.string())))
    return per_row(hit[ids], offs)


def learn_stems(rows: DataFrame) -> list[str]:
    """Word beginnings that cover the toxic rows of ``rows`` (``text, label``; bounded by the caller)."""

    def count(batches):
        for b in sliced(batches, 0):
            ids, words, offs = split_words(text_array(b.column(0)))
            bad = np.asarray(b.column(1)).astype(bool)
            row = rows_of(offs)
            for begin in _beginnings(words).values():
                d = begin.dictionary_encode()
                code = np.asarray(pc.fill_null(d.indices, -1)).astype(np.int64)[ids]
                pair, times = np.unique((code * len(bad) + row)[code >= 0], return_counts=True)
                pair = pair[times * DENSE >= np.diff(offs)[pair % len(bad)]]
                code, toxic = pair // len(bad), bad[pair % len(bad)]
                n = len(d.dictionary)
                yield pa.RecordBatch.from_arrays(
                    [d.dictionary, pa.array(np.bincount(code[toxic], minlength=n)), pa.array(np.bincount(code[~toxic], minlength=n))],
                    names=["stem", "toxic", "clean"])

    counted = (rows.select("text", "label").mapInArrow(count, "stem string, toxic long, clean long").groupBy("stem")
               .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
               .where((F.col("toxic") >= MIN_TOXIC_ROWS) & (F.col("toxic") >= MIN_PRECISION * (F.col("toxic") + F.col("clean")))))
    stems = [r["stem"] for r in counted.orderBy(F.desc("toxic"), F.length("stem"), "stem").limit(MAX_CANDIDATES).collect()]
    if not stems:
        return []

    def cover(batches):
        for b in sliced(batches, 0):
            a = text_array(b.column(0))
            ids, words, offs = split_words(a)
            row, bits = rows_of(offs), np.zeros((len(a), len(stems)), bool)
            for begin in _beginnings(words).values():
                code = np.asarray(pc.fill_null(pc.index_in(begin, pa.array(stems, pa.string())), -1))[ids]
                pair, times = np.unique(row[code >= 0] * len(stems) + code[code >= 0], return_counts=True)
                pair = pair[times * DENSE >= np.diff(offs)[pair // len(stems)]]
                bits[pair // len(stems), pair % len(stems)] = True
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in np.packbits(bits, axis=1)], pa.binary()),
                                              b.column(1)], names=["bits", "label"])

    packed = rows.select("text", "label").mapInArrow(cover, "bits binary, label double").collect()
    bits = np.unpackbits(np.array([np.frombuffer(r["bits"], np.uint8) for r in packed]), axis=1)[:, :len(stems)].astype(bool)
    worth = np.array([1 if r["label"] else -1 for r in packed])
    chosen, left = [], np.ones(len(bits), bool)
    while True:
        gain = worth[left] @ bits[left]
        best = int(gain.argmax())
        if gain[best] < MIN_TOXIC_ROWS:
            break
        chosen.append(stems[best])
        left &= ~bits[:, best]
    return chosen


def features(a: pa.Array, stems: list[str]) -> np.ndarray:
    """``len(a) x len(FEATURES)`` doubles."""
    words = n_words(a).astype(float)
    letters, chars = n_letters(a).astype(float), word_chars(a).astype(float)
    n = {k: regex_count(a, p).astype(float) for k, p in PATTERNS.items()}
    n["obfuscated"] = np.maximum(0, n["obfuscated"] - n["insults"])  # plain spellings match too
    learned = stem_counts(a, stems).astype(float)
    per_word, per_letter = 100 / np.maximum(words, 1), 1 / np.maximum(letters, 1)
    per_char = 1 / np.maximum(chars, 1)
    return np.column_stack([
        learned, learned * per_word, n["insults"], n["insults"] * per_word, n["threats"] * per_word,
        n["second_person"] * per_word, n["proximity"] * per_word, n["obfuscated"] * per_word,
        n["capitals"] * per_letter, n["capital_words"] * per_word, n["exclamations"] * per_char,
        n["runs"] * per_word, n["punctuation"] * per_char, np.log1p(words), chars / np.maximum(words, 1)])


def with_features(docs: DataFrame, stems: list[str], text_col: str = "text",
                  out: str = "__toxicity_features") -> DataFrame:
    """``docs`` with a column of features; one pass, all other columns pass through."""
    at = docs.columns.index(text_col)

    def run(batches):
        for b in sliced(batches, at):
            x = features(text_array(b.column(at)), stems)
            offs = pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1])
            col = pa.ListArray.from_arrays(offs, pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*b.columns, col], names=[*b.schema.names, out])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.ArrayType(T.DoubleType()))]))


def fold(id_column):
    return F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(4))


class Scorer:
    """Learned lexicon, trees and calibration; ``score`` adds a column to a frame with features."""

    def __init__(self, stems=(), trees=None, calibration=None, constant: float = 0.0):
        self.stems, self.trees, self.calibration, self.constant = list(stems), trees, calibration, constant

    def score(self, df: DataFrame, features_col: str = "__toxicity_features", out: str = "__toxicity_score") -> DataFrame:
        kept = [F.col(f"`{c}`") for c in df.columns if c != features_col]
        if self.trees is None:
            return df.select(*kept, F.lit(float(self.constant)).alias(out))
        # the model's column names cannot clash with the frame's, which travels as one struct
        packed = df.select(F.struct(*kept).alias("row"), array_to_vector(F.col(features_col)).alias("features"))
        scored = self.trees.transform(packed).select("row", vector_to_array("probability")[1].alias("raw"))
        return self.calibration.transform(scored).select(
            "row.*", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("calibrated"))).alias(out))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        fit_rows: int = FIT_ROWS, seed: int = 17) -> Scorer:
    """Learn from the labelled documents outside the held-out fold."""
    known = (labels.where("toxic is not null and doc_id is not null").groupBy("doc_id")
             .agg(F.max("toxic").alias("toxic")).where(fold(F.col("doc_id")) != HELD_OUT))
    total = known.count()
    if total > fit_rows:  # a share of the rows by a hash of the id: bounded, and the same in every run
        known = known.where(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) < int((1 << 30) * fit_rows / total))
    src = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    rows = src.join(F.broadcast(known.limit(fit_rows)), "doc_id")  # at most fit_rows ids and labels
    table, _ = written(rows.select(F.coalesce("text", F.lit("")).alias("text"), F.col("toxic").cast("double").alias("label"),
                                   fold(F.col("doc_id")).alias("fold")), "toxicity-fit")
    n, bad, classes, spare = table.agg(
        F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0)),
        F.countDistinct(F.when(F.col("fold") != CALIBRATION, F.col("label"))),
        F.sum((F.col("fold") == CALIBRATION).cast("int"))).first()
    if classes < 2 or not spare:
        return Scorer(constant=bad / n if n else 0.0)
    stems = learn_stems(table.where(F.col("fold") != CALIBRATION))
    table, _ = written(with_features(table, stems).drop("text").coalesce(8), "toxicity-features")
    ready = table.select("label", "fold", array_to_vector("__toxicity_features").alias("features")).coalesce(4)
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=seed).fit(ready.where(F.col("fold") != CALIBRATION))
    held = trees.transform(ready.where(F.col("fold") == CALIBRATION)).select(
        vector_to_array("probability")[1].alias("raw"), "label")
    calibration = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="calibrated").fit(held)
    return Scorer(stems, trees, calibration)


def with_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                out: str = "__toxicity_score") -> DataFrame:
    """``docs`` with a column of calibrated scores from 0 to 1."""
    scorer = fit(docs, labels, id_col, text_col)
    return scorer.score(with_features(docs, scorer.stems, text_col), out=out)


def scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    scored = with_scores(docs.select("doc_id", "text"), labels)
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"),
                         F.col("__toxicity_score").alias("score"),
                         (F.col("__toxicity_score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents below the threshold, with all their columns; no join, one pass after the fit."""
    scored = with_scores(docs, labels)
    return scored.where(F.col("__toxicity_score") < threshold).drop("__toxicity_score")
