"""Quality rules on the repetition inside a document, from a suffix array of its words.

The words of many documents are numbered so that documents share no number, and one suffix array is
sorted over all of them by prefix doubling.  The common prefix of two neighbours in it comes from the
ranks kept per round.  A suffix lies in a longest-common-prefix interval of value ``l`` if one of its
neighbours shares ``l`` words with it; the largest such value is the longest repeated substring that
starts there.  The union of those spans is the repeated part of the document.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_WORDS = 300_000  # words sorted together; a longer document is sorted alone
_LAYOUT = b" \t\n\v\f\r"
# Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
_SYMBOL = re.compile(f"[{re.escape(SYMBOLS)}]")


@dataclass(frozen=True)
class Limits:
    """When a document is rejected.

    ``span_words``: repeats shorter than this are not counted as covered.  ``covered``: largest share
    of words in repeats.  ``longest``: largest share of words in one repeat, if that repeat has
    ``longest_words`` words or more.
    """

    span_words: int = 8
    covered: float = 0.4
    longest: float = 0.2
    longest_words: int = 50


def suffix_order(ids: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of ``ids`` and the ranks by the first 1, 2, 4, ... words.

    The numbers are dense from 0.  In every round only suffixes that still tie are sorted.
    """
    n = len(ids)
    counts = np.bincount(ids)
    rank = (np.cumsum(counts) - counts)[ids]
    order = np.empty(n, np.int64)
    sorted_ids = np.argsort(ids, kind="stable")
    order[:] = sorted_ids
    tied = sorted_ids[counts[ids[sorted_ids]] > 1]
    levels, step = [rank], 1
    while len(tied):
        after = tied + step
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        key = rank[tied] * (n + 1) + second
        by_key = np.argsort(key, kind="stable")
        tied, key = tied[by_key], key[by_key]
        at = np.arange(len(tied))
        first = rank[tied]
        run = np.maximum.accumulate(np.where(np.diff(first, prepend=-1) != 0, at, 0))
        place = first + at - run
        leader = np.maximum.accumulate(np.where(np.diff(key, prepend=-1) != 0, at, 0))
        rank = rank.copy()
        rank[tied] = place[leader]
        order[place] = tied
        size = np.bincount(leader, minlength=len(tied))[leader]
        tied = tied[size > 1]
        levels.append(rank)
        step *= 2
    return order, levels


def longest_repeats(ids: np.ndarray) -> np.ndarray:
    """Per position, the length of the longest substring from there that occurs twice or more."""
    n = len(ids)
    best = np.zeros(n, np.int64)
    if n < 2:
        return best
    order, levels = suffix_order(ids)
    a, b = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(n - 1, np.int64)
    live = np.arange(n - 1)
    for level in range(len(levels) - 1, -1, -1):
        rank, step = levels[level], 1 << level
        x, y = a[live] + shared[live], b[live] + shared[live]
        inside = (x < n) & (y < n)
        same = np.zeros(len(live), bool)
        same[inside] = rank[x[inside]] == rank[y[inside]]
        shared[live[same]] += step
    best[order[:-1]] = shared
    best[order[1:]] = np.maximum(best[order[1:]], shared)
    return best


def covered_positions(best: np.ndarray, least: int, span: int | None = None) -> np.ndarray:
    """True where a repeat of ``least`` words or more (its first ``span`` words) covers the position."""
    starts = np.nonzero(best >= least)[0]
    edges = np.zeros(len(best) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + (best[starts] if span is None else span), -1)
    return np.cumsum(edges[:-1]) > 0


def _words(data: bytes) -> list[bytes]:
    return data.split()


def measure(texts: Sequence[str | None], limits: Limits) -> list[tuple]:
    """Per text: words, word characters, symbols, repeated lines, words in repeated windows of three,
    words in repeats, longest repeat."""
    words = [_words((t or "").encode()) for t in texts]
    ids, starts = [], []
    top = 0
    for each in words:
        numbers: dict[bytes, int] = {}
        starts.append(len(ids))
        ids.extend([top + numbers.setdefault(w, len(numbers)) for w in each])
        ids.append(top + len(numbers))  # an end that nothing else equals
        top += len(numbers) + 1
    starts.append(len(ids))
    best = longest_repeats(np.array(ids, np.int64))
    in_three = covered_positions(best, 3, 3)
    in_spans = covered_positions(best, limits.span_words)
    ends = np.array(starts[1:])
    begins = np.array(starts[:-1])
    total = lambda flags: (s := np.concatenate(([0], np.cumsum(flags))))[ends] - s[begins]
    threes, spans = total(in_three), total(in_spans)
    out = []
    for k, (text, each) in enumerate(zip(texts, words)):
        text = text or ""
        lines = [line for line in text.split("\n") if line.strip(" \t\v\f\r")]
        layout = sum(text.count(c) for c in _LAYOUT.decode())
        out.append(
            (
                len(each),
                len(text) - layout,
                len(_SYMBOL.findall(text)),
                len(lines) - len(set(lines)),
                int(threes[k]),
                int(spans[k]),
                int(best[begins[k] : ends[k]].max(initial=0)),
            )
        )
    return out


MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat",
)


def quality(df: DataFrame, text: str, limits: Limits = Limits()) -> DataFrame:
    """All columns of ``df`` with the measures, ``base_failed``, ``covered_fraction`` and ``kept``.

    A NULL or empty text has no words and fails the base rule (50 words at least, at most half of the
    words in repeated windows of three).  ``kept`` also needs the limits on covered share and longest
    repeat.  Columns of ``df`` that are called like a result are replaced.  Documents are judged one
    by one, so copies get equal verdicts and an empty table gives an empty result.
    """
    results = (*MEASURES, "base_failed", "covered_fraction", "kept")
    base = df.drop(*[c for c in results if c != text])
    names = base.columns
    at = names.index(text)
    schema = base.select("*", *[F.lit(0).cast("long").alias(c) for c in MEASURES]).schema

    def run(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            begin, size = 0, 0
            for i, t in enumerate(texts):
                size += len(t or "") // 6 + 2
                if size >= BATCH_WORDS or i == len(texts) - 1:
                    part = batch.slice(begin, i + 1 - begin)
                    rows = measure(texts[begin : i + 1], limits)
                    added = [pa.array(c, pa.int64()) for c in zip(*rows)]
                    yield pa.RecordBatch.from_arrays([*part.columns, *added], [*names, *MEASURES])
                    begin, size = i + 1, 0

    n = F.col("n_words")
    failed = (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)
    share = F.when(n > 0, F.col("covered_words") / n).otherwise(F.lit(0.0))
    too_long = (F.col("longest_repeat") >= limits.longest_words) & (
        F.col("longest_repeat") > limits.longest * n
    )
    return (
        base.mapInArrow(run, schema)
        .withColumn("base_failed", failed)
        .withColumn("covered_fraction", share)
        .withColumn("kept", ~failed & (share <= limits.covered) & ~too_long)
    )


def keep_sound(df: DataFrame, text: str, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``df`` whose text is kept, with all columns as they were, whatever they are called."""
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row_of_df")
    judged = quality(df.select(whole, F.col(f"`{text}`").alias("text_of_df")), "text_of_df", limits)
    return judged.where("kept").select(*[F.col(f"row_of_df.`{c}`").alias(c) for c in df.columns])
