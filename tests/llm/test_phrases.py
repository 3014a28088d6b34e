"""Collocations against brute force, and their edge cases."""

import re
from collections import Counter

import numpy as np
import pytest

from marketloom.llm import phrases_era, queries

SF_DIR = "/root/testdata/sf0.01"
ASCII_LOWER = {i: i + 32 for i in range(65, 91)}


def plain_phrases(docs, least, top=2000, scale=2000000):
    """{(lang, rank): (phrase, a, l, r, n, score)}"""
    n, f = Counter(), {}
    for text, lang in docs:
        lang = "und" if lang is None else lang
        counts = f.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(ASCII_LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                counts.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = {}
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        most = Counter()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    most[p[i : i + k]] = max(most[p[i : i + k]], a)
        rows = []
        for p, a in candidates.items():
            if 100 * most[p] >= 80 * a and p in most:
                continue
            cuts = [(scale * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out[lang, rank] = (p.decode(), -a, left, right, n[lang], -s)
    return out


def found_phrases(found):
    rows = found.collect()
    out = {(r.lang, r["rank"]): (r.phrase, r.a, r.l, r.r, r.n, r.score) for r in rows}
    assert len(out) == len(rows)
    return out


def phrase_frame(spark, docs):
    schema = "text string, lang string, words string, phrase string, f string, n string, k string, word string"
    return spark.createDataFrame([(t, lang, *["mine"] * 6) for t, lang in docs], schema)


def made_documents():
    random = np.random.default_rng(17)
    words = np.array(["the", "The", "of", "ünder", "Ünder", "日本", "x", "y1", "q" * 100, "r" * 100, "rare", "a\x00b", "e.g"])
    weights = np.array([30, 10, 15, 5, 3, 4, 6, 6, 8, 6, 1, 3, 2], float)
    docs = []
    for i in range(120):
        drawn = random.choice(words, size=random.integers(0, 60), p=weights / weights.sum())
        gaps = random.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", "\r\n", "! "], size=len(drawn))
        docs.append(("".join(w + g for w, g in zip(drawn, gaps)), ["en", "de", None, "und", "x\x00"][i % 5]))
    docs += [("the end of the line", "en")] * 40 + [("hot " * 500 + ". hot pair hot pair", "hot")] * 3
    docs += [("one two three four " * 12 + "five", "de"), (None, "en"), ("", None), (" \t\n.,", "en"), (None, None)]
    docs += [(f"w{i % 3} v{i % 2}", "once") for i in range(30)]
    return docs


@pytest.mark.parametrize("budget, dictionary, flush", [(1 << 20, 1 << 20, 2_000_000), (60, 1 << 20, 500), (60, 4, 300), (25, 0, 50)])
def test_phrases_against_brute_force(spark, monkeypatch, budget, dictionary, flush):
    """Overlaps, breaks, NULLs, other scripts; prefixes split at every depth; words beyond the dictionary."""
    monkeypatch.setattr(phrases_era, "DICTIONARY_WORDS", dictionary)
    monkeypatch.setattr(phrases_era, "FLUSH_WORDS", flush)
    docs = made_documents()
    frame = phrase_frame(spark, docs).repartition(3)
    found = found_phrases(phrases_era.collocations(frame, "text", "lang", least=5, budget=budget))
    assert found == plain_phrases(docs, 5)


def test_prefixes_over_the_budget_are_split_at_every_depth(spark):
    """A phrase with most of all occurrences does not keep its suffixes in one group."""
    docs = phrase_frame(spark, [("hot " * 400, "en"), ("hot hot hot a. hot hot hot b", "en")]).select("lang", "text")
    docs = docs.withColumn("text", docs.text.cast("binary"))
    words = phrases_era.word_counts(docs)
    given = phrases_era._dictionary(words, 1, 30)
    assert given.splits[0].parts.tolist() == [14]
    rows = {r.phrase: r.f for r in phrases_era.phrase_counts(docs, words, 1, budget=30).collect()}
    assert rows == {
        "hot": 406, "a": 1, "b": 1, "hot hot": 403, "hot hot hot": 400, "hot hot hot hot": 397, "hot a": 1,
        "hot b": 1, "hot hot a": 1, "hot hot b": 1, "hot hot hot a": 1, "hot hot hot b": 1,
    }


def test_phrases_of_empty_tables(spark):
    frame = phrase_frame(spark, [("a b", "en"), (None, None)])
    assert phrases_era.collocations(frame.limit(0), "text", "lang").collect() == []
    assert phrases_era.collocations(frame, "text", "lang").collect() == []


def test_best_of_each_language_and_exact_scores(spark):
    """Only the first rows per language; the score keeps its digits where products pass 64 bits."""
    docs = made_documents()
    frame = phrase_frame(spark, docs)
    found = found_phrases(phrases_era.collocations(frame, "text", "lang", least=3, top=4, scale=10**18))
    assert found == plain_phrases(docs, 3, 4, 10**18)


def test_registered_phrases(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text", "lang").collect()
    found = queries.QUERIES["op11_phrases"](spark, SF_DIR)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert found_phrases(found) == plain_phrases([tuple(r) for r in rows], 30)
