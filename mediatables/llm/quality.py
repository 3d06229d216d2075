"""Quality rules by repetition coverage.

Per text, words become integer ids, a rolling polynomial hash over the ids is
updated for each n-gram length in turn, and the characters of words inside
any n-gram that occurs twice or more are measured. Characters of repeated
lines are measured alike. All of it is numpy inside the scan's own tasks:
one pass, no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, small_batches, text_list, text_of

MIN_WORDS = 20
BASE_WINDOW = 8
BASE_REPEAT_PERCENT = 30
# Largest share, in percent, of a text's word characters that may lie inside
# repeated n-grams of each length, and inside repeated lines.
NGRAM_PERCENT = {5: 40, 6: 38, 7: 36, 8: 34, 9: 32, 10: 30}
LINE_PERCENT = 30

_WORDS = re.compile(WORD)
_SYMBOLS = re.compile(r"[#*$%&|<>]")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    *(T.StructField(c, T.LongType()) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "dup_ngram_percent", "dup_line_percent")),
    T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()),
])


def _scramble(ids: np.ndarray) -> np.ndarray:
    """Spread small ids over 64 bits before hashing."""
    x = (ids + np.uint64(1)) * _MULTIPLIER
    x ^= x >> np.uint64(29)
    x *= _MIX
    return x ^ (x >> np.uint64(32))


def repeated_windows(codes: np.ndarray) -> np.ndarray:
    """Which positions hold a value that occurs at least twice."""
    order = np.argsort(codes, kind="stable")
    s = codes[order]
    same = s[1:] == s[:-1]
    flags = np.zeros(len(codes), bool)
    flags[order[1:]] |= same
    flags[order[:-1]] |= same
    return flags


def covered(starts: np.ndarray, n: int, n_words: int) -> np.ndarray:
    """Words inside any flagged window of n words."""
    edge = np.zeros(n_words + 1, np.int64)
    at = np.flatnonzero(starts)
    edge[at] += 1
    edge[at + n] -= 1
    return np.cumsum(edge[:-1]) > 0


def measure(text: str) -> tuple[int, int, int, int, int, int, int, bool, bool]:
    """The measures and both verdicts of one text.

    An empty text, or one of white space only, has no words and fails. A
    text shorter than an n-gram has no repeated n-gram of that length.
    """
    words = _WORDS.findall(text)
    n_words = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n_words)
    word_chars = int(lengths.sum())
    n_symbols = len(_SYMBOLS.findall(text))

    seen: dict[str, bool] = {}
    n_dup_lines = dup_line_chars = 0
    for line in text.split("\n"):
        if line in seen:
            if seen[line]:
                n_dup_lines += 1
                dup_line_chars += sum(map(len, _WORDS.findall(line)))
        else:
            seen[line] = _WORDS.search(line) is not None

    index: dict[str, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.uint64, n_words)
    codes = _scramble(ids)
    rolling = codes.copy()
    n_repeat = worst = 0
    rejected = False
    for n in range(2, max(*NGRAM_PERCENT, BASE_WINDOW) + 1):
        if n > n_words:
            break
        rolling = rolling[:-1] * _MULTIPLIER + codes[n - 1:]
        if n not in NGRAM_PERCENT and n != BASE_WINDOW:
            continue
        flags = repeated_windows(rolling)
        if not flags.any():  # a longer repeat would hold a repeat of this length
            break
        inside = covered(flags, n, n_words)
        if n == BASE_WINDOW:
            n_repeat = int(inside.sum())
        if n in NGRAM_PERCENT:
            chars = int(lengths[inside].sum())
            worst = max(worst, 100 * chars // word_chars)
            rejected |= 100 * chars > NGRAM_PERCENT[n] * word_chars
    rejected |= 100 * dup_line_chars > LINE_PERCENT * word_chars
    failed = n_words < MIN_WORDS or 100 * n_repeat > BASE_REPEAT_PERCENT * n_words
    line_percent = 100 * dup_line_chars // word_chars if word_chars else 0
    return (n_words, word_chars, n_symbols, n_dup_lines, n_repeat, worst, line_percent,
            failed, not failed and not rejected)


def _measure_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64()] * 7 + [pa.bool_()] * 2
    names = SCHEMA.names
    for batch in batches:
        rows = [measure(t) for t in text_list(batch.column(1))]
        columns = list(zip(*rows)) if rows else [()] * len(types)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0)] + [pa.array(c, t) for c, t in zip(columns, types)], names=names)


def quality_rules(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document with its measures and verdicts.

    Null text reads as empty; null and repeated ids are passed through;
    extra columns are ignored; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return narrow.mapInArrow(_measure_batches, SCHEMA)


def _keeping(text_at: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [measure(t)[-1] for t in text_list(batch.column(text_at))]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return run


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that the rules reject; all columns kept."""
    small_batches(docs.sparkSession)
    return docs.mapInArrow(_keeping(docs.columns.index(text_col)), docs.schema)
