"""Quality rules as a short-circuit cascade.

A document is kept when no rule rejects it. Every rule states the features it needs; the cascade
runs the rules one after another and computes the features of a rule only for the rows that all
earlier rules passed. The order comes from a sample: each rule's seconds per row and its
rejection rate are measured on the first ``SAMPLE_SLICES`` slices of the table, and rules run by
rejections per second. The order changes the time only: the verdict is the conjunction of all rules.

Defined results: a null or empty text has no words and is rejected by ``min_words``; repeated rows
get one result each; an empty table gives an empty result; other columns are passed on unread by
``keep_documents`` and left out by ``judge``.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from coursepulse.llm.words import (
    offsets_and_bytes,
    per_row,
    regex_count,
    rows_of,
    sliced,
    split_words,
    text_array,
    window_codes,
)

SYMBOLS = "#*$%&|<>"
SAMPLE_SLICES = 8
REPEAT_WIDTH = 5

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True


# --- features: each takes a string array and gives one integer per row -----------------------

def n_words(a: pa.Array) -> np.ndarray:
    offs, raw = offsets_and_bytes(a)
    word = ~_SPACE[raw]
    start = word.copy()
    start[1:] &= ~word[:-1]
    first = offs[:-1][np.diff(offs) > 0]
    start[first] = word[first]  # a text starts anew, whatever the text before ended with
    return per_row(start, offs)


def word_chars(a: pa.Array) -> np.ndarray:
    offs, raw = offsets_and_bytes(a)
    return per_row(~_SPACE[raw] & ((raw & 0xC0) != 0x80), offs)


def n_symbols(a: pa.Array) -> np.ndarray:
    offs, raw = offsets_and_bytes(a)
    return per_row(_SYMBOL[raw], offs)


def n_lines(a: pa.Array) -> np.ndarray:
    """Lines with a word."""
    lines = pc.split_pattern(a, "\n")
    offs = np.asarray(lines.offsets).astype(np.int64)
    return per_row(n_words(text_array(lines.flatten())) > 0, offs - offs[0])


def n_dup_lines(a: pa.Array) -> np.ndarray:
    """Lines with a word that are equal to an earlier line of the text."""
    lines = pc.split_pattern(a, "\n")
    offs = np.asarray(lines.offsets).astype(np.int64)
    offs = offs - offs[0]
    d = lines.flatten().dictionary_encode()
    ids = np.asarray(d.indices).astype(np.int64)
    if not len(ids):
        return np.zeros(len(a), np.int64)
    again = pd.Series(rows_of(offs) * len(d.dictionary) + ids).duplicated().to_numpy()
    return per_row(again & (n_words(text_array(d.dictionary)) > 0)[ids], offs)


def n_repeat_words(a: pa.Array) -> np.ndarray:
    """Words inside a 5-word window that occurs twice or more in the text, first one included."""
    ids, _, offs = split_words(a)
    codes = window_codes(ids, REPEAT_WIDTH)
    out = np.zeros(len(ids) + 1, np.int64)
    if len(codes):
        rows = rows_of(offs)
        at = np.flatnonzero(rows[: len(codes)] == rows[REPEAT_WIDTH - 1:])
        twice = at[pd.Series(codes[at] * len(a) + rows[at]).duplicated(keep=False).to_numpy()]
        np.add.at(out, twice, 1)
        np.add.at(out, twice + REPEAT_WIDTH, -1)
    return per_row(np.cumsum(out)[:-1] > 0, offs)


def n_letters(a: pa.Array) -> np.ndarray:
    return regex_count(a, r"\p{L}")


def n_capitals(a: pa.Array) -> np.ndarray:
    return regex_count(a, r"\p{Lu}")


FEATURES: dict[str, Callable[[pa.Array], np.ndarray]] = {
    f.__name__: f for f in (n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_letters, n_capitals)
}
BASE_FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


# --- rules ----------------------------------------------------------------------------------

@dataclass(frozen=True)
class Rule:
    """``rejects`` takes the arrays of ``features`` in that order and gives a mask."""

    name: str
    features: tuple[str, ...]
    rejects: Callable[..., np.ndarray]


#: Thresholds are integers in percent, so that SQL and numpy agree to the last row.
BASE_RULES = (
    Rule("min_words", ("n_words",), lambda w: w < 10),
    Rule("repeated_words", ("n_repeat_words", "n_words"), lambda r, w: 100 * r > 20 * w),
)
METHOD_RULES = (
    Rule("symbols", ("n_symbols", "n_words"), lambda s, w: 100 * s > 20 * w),
    Rule("capitals", ("n_capitals", "n_letters"), lambda c, n: 100 * c > 50 * n),
    Rule("word_length", ("word_chars", "n_words"), lambda c, w: (c < 2 * w) | (c > 15 * w)),
    Rule("repeated_lines", ("n_dup_lines", "n_lines"), lambda d, n: 100 * d > 50 * n),
)
RULES = BASE_RULES + METHOD_RULES


class _Lazy:
    """Features of a slice, computed for the rows that need them only."""

    def __init__(self, a: pa.Array):
        self.a, self.got = a, {}

    def of(self, name: str, rows: np.ndarray) -> np.ndarray:
        have = self.got.get(name)
        if have is None:
            have = self.got[name] = (np.zeros(len(self.a), np.int64), np.zeros(len(self.a), bool))
        values, done = have
        todo = rows[~done[rows]]
        if len(todo):
            part = self.a if len(todo) == len(self.a) else text_array(self.a.take(pa.array(todo)))
            values[todo] = FEATURES[name](part)
            done[todo] = True
        return values[rows]


def run_cascade(a: pa.Array, rules: Sequence[Rule], lazy: _Lazy | None = None) -> np.ndarray:
    """Mask of the rows that no rule rejects; a rule sees only what the earlier rules passed."""
    lazy = lazy or _Lazy(a)
    alive = np.arange(len(a))
    for rule in rules:
        if not len(alive):
            break
        alive = alive[~rule.rejects(*(lazy.of(f, alive) for f in rule.features))]
    mask = np.zeros(len(a), bool)
    mask[alive] = True
    return mask


def order_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text",
                sample_slices: int = SAMPLE_SLICES) -> list[Rule]:
    """The rules by rejections per second, measured on the first ``sample_slices`` slices.

    The measurement runs in the tasks; the driver gets one row per rule and slice.
    """
    rules = list(rules)

    def measure(batches):
        for b in sliced(batches, 0):
            a = text_array(b.column(0))
            out = []
            for i, rule in enumerate(rules):
                t0 = time.perf_counter()
                bad = rule.rejects(*(FEATURES[f](a) for f in rule.features))
                out.append((i, len(a), int(bad.sum()), time.perf_counter() - t0))
            i, n, bad, sec = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(n, pa.int64()),
                                              pa.array(bad, pa.int64()), pa.array(sec, pa.float64())],
                                             names=["rule", "n", "bad", "sec"])

    rows = (docs.select(docs[text_col]).mapInArrow(measure, "rule int, n long, bad long, sec double")
            .limit(sample_slices * len(rules)).collect())
    bad, sec = [0] * len(rules), [1e-9] * len(rules)
    for r in rows:
        bad[r["rule"]] += r["bad"]
        sec[r["rule"]] += r["sec"]
    return [rules[i] for i in sorted(range(len(rules)), key=lambda i: (-bad[i] / sec[i], sec[i], i))]


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          base: Sequence[Rule] = BASE_RULES, method: Sequence[Rule] = METHOD_RULES) -> DataFrame:
    """One row per document: the base counts, ``base_failed`` and the verdict ``kept``.

    The counts are asked for all rows; the method's rules run as a cascade on the rows that pass
    the base rules.
    """
    rules = order_rules(docs, method, text_col)
    src = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))

    def run(batches):
        for b in sliced(batches, 1):
            a = text_array(b.column(1))
            lazy, every = _Lazy(a), np.arange(len(a))
            counts = {f: lazy.of(f, every) for f in BASE_FEATURES}
            failed = np.zeros(len(a), bool)
            for rule in base:
                failed |= rule.rejects(*(lazy.of(f, every) for f in rule.features))
            kept = np.zeros(len(a), bool)
            good = np.flatnonzero(~failed)
            if len(good):
                sub = _Lazy(text_array(a.take(pa.array(good))))
                sub.got = {f: (v[good], np.ones(len(good), bool)) for f, v in counts.items()}
                kept[good] = run_cascade(sub.a, rules, sub)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(counts[f]) for f in BASE_FEATURES), pa.array(failed), pa.array(kept)],
                names=["doc_id", *BASE_FEATURES, "base_failed", "kept"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{f} long" for f in BASE_FEATURES)
                          + ", base_failed boolean, kept boolean")


def keep_documents(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The documents that no rule rejects, with all their columns: one pass, no shuffle."""
    ordered = order_rules(docs, rules, text_col)
    at = docs.columns.index(text_col)

    def run(batches):
        for b in sliced(batches, at):
            mask = run_cascade(text_array(b.column(at)), ordered)
            if mask.any():
                yield b.filter(pa.array(mask))

    return docs.mapInArrow(run, docs.schema)
