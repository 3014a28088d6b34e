"""Exact searches against brute force, and their edge cases."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from marketloom.llm import lexical_bags, queries, topk_nra

SF_DIR = "/root/testdata/sf0.01"


# --- no-random-access aggregation ------------------------------------------

def plain_top(rows, asked, k, scale=256):
    """{query: [(id, score)]} with Python integers."""

    def whole(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(float(x) * scale) for x in v]

    coded = [(i, w) for i, v in rows if i is not None and (w := whole(v)) is not None]
    out = {}
    for q in {i for i, _ in asked if i is not None}:
        vectors = {tuple(w) for i, v in asked if i == q and (w := whole(v)) is not None}
        sums = [(sum(a * b for a, b in zip(v, w)), i) for v in vectors for i, w in coded if i != q]
        scored = [(-max(min(s, 2**63 - 1), -(2**63)), i) for s, i in sums]
        if scored:
            out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def as_lists(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r["rank"], r.found_id, r.score))
    assert all([n for n, _, _ in v] == list(range(1, len(v) + 1)) for v in out.values())
    return {q: [(i, s) for _, i, s in v] for q, v in out.items()}


def vectors_frame(spark, rows, kind="double"):
    schema = f"vec_id long, embedding array<{kind}>, query_id string, rank string, score string, strip string"
    return spark.createDataFrame([(i, v, *["mine"] * 4) for i, v in rows], schema)


@pytest.mark.parametrize("block", [2048, 7])
def test_top_k_against_brute_force(spark, monkeypatch, block):
    """Clusters, copies of one vector, ties, odd vectors, other lengths, repeated rows, several strips and groups."""
    monkeypatch.setattr(topk_nra, "BLOCK_ROWS", block)
    monkeypatch.setattr(topk_nra, "QUERY_ROWS", 5)
    monkeypatch.setattr(topk_nra, "GROUP_ROWS", 10)
    monkeypatch.setattr(topk_nra, "LEAST_STRIP_ROWS", 60)
    random = np.random.default_rng(5)
    centres = random.normal(size=(20, 12))
    vectors = [(c + random.normal(size=12) * 0.2).round(2).tolist() for c in centres for _ in range(10)]
    vectors += [vectors[0]] * 80 + [[0.0] * 12] * 3 + [[0.25] * 12, [-0.25] * 12]
    vectors += [None, [], [float("nan")] * 12, [1.0, float("inf")], [None, 1.0], [1.0, -2.0], [1e-9] * 12]
    rows = [(7 * i - 50, v) for i, v in enumerate(vectors)] + [(None, vectors[3]), (700, vectors[5]), (700, vectors[5])]
    asked = [(i, v) for i, v in rows if i is not None and i % 3 == 0]
    got = as_lists(topk_nra.top_k(vectors_frame(spark, rows), vectors_frame(spark, asked), "vec_id", "embedding", 5))
    assert got == plain_top(rows, asked, 5)


def test_top_k_of_large_components(spark):
    """Sums beyond exact doubles are still exact, and stay at the limits beyond 64 bits."""
    rows = [(i, [float(2**22 + 2 * (i % 7)), float(3 * i - 2**21)]) for i in range(40)] + [(50, [1e300, 1.0]), (51, [-1e300, 2.0])]
    frame = vectors_frame(spark, rows)
    got = as_lists(topk_nra.top_k(frame, frame, "vec_id", "embedding", 4))
    assert got == plain_top(rows, rows, 4)


def test_top_k_of_few_rows(spark):
    one = vectors_frame(spark, [(0, [1.0, 2.0])], "float")
    assert as_lists(topk_nra.top_k(one, one, "vec_id", "embedding", 5)) == {}
    two = vectors_frame(spark, [(0, [1.0, 2.0]), (1, [0.5])], "float")
    assert as_lists(topk_nra.top_k(two, one, "vec_id", "embedding", 5)) == {0: [(1, 128 * 256)]}
    assert topk_nra.top_k(two.limit(0), two.limit(0), "vec_id", "embedding", 5).collect() == []
    assert topk_nra.top_k(two.limit(0), two, "vec_id", "embedding", 5).collect() == []


def test_lists_leave_few_candidates():
    """Reading stops early: most full scores are never computed."""
    random = np.random.default_rng(2)
    rows = np.floor(256 * random.normal(size=(2048, 16)) * np.linspace(2, 0.05, 16))
    asked = rows[:64]
    may = np.ones((2048, 64), bool)
    topk_nra.SortedLists(rows).narrow(may, asked, np.full(64, -np.inf), 5)
    scores = rows @ asked.T
    least = np.sort(scores, axis=0)[-5]
    assert (may | (scores < least)).all()
    assert may.mean() < 0.25


def test_registered_top_k(spark):
    given = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()
    rows = [(r.vec_id, r.embedding) for r in given]
    want = plain_top(rows, [r for r in rows if r[0] % 50 == 0], 5)
    found = queries.QUERIES["op13_topk_nra"](spark, SF_DIR)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert as_lists(found.withColumnRenamed("vec_id", "found_id")) == want


# --- ranked lexical search ---------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ASCII_LOWER = {i: i + 32 for i in range(65, 91)}


def plain_search(docs, items, k):
    """{item: [(doc, score)]}"""
    bags = [(d, Counter(TERM.findall((t or "").translate(ASCII_LOWER)))) for d, t in docs]
    held = [sum(b.values()) for _, b in bags]
    n_docs, length = sum(n > 0 for n in held), sum(held)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for i, t in items:
        asked.setdefault(i, []).extend(TERM.findall((t or "").translate(ASCII_LOWER)))
    out = {}
    for item, terms in asked.items():
        scored = []
        for (doc, bag), n in zip(bags, held):
            if not n:
                continue
            m = 100 - 25 + (25 * n * n_docs) // length
            score = 0
            for t in terms:
                if tf := bag[t]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += weight * ((1000000000 * tf) // (1000 * tf + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        if scored:
            out[item] = [(doc, -s) for s, _, _, doc in sorted(scored, key=lambda x: x[:3])[:k]]
    return out


def found_lists(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (str(r.item_id), r["rank"])):
        out.setdefault(r.item_id, []).append((r["rank"], r.doc_id, r.score))
    assert all([n for n, _, _ in v] == list(range(1, len(v) + 1)) for v in out.values())
    return {i: [(d, s) for _, d, s in v] for i, v in out.items()}


def text_frame(spark, rows, id_name):
    schema = f"{id_name} long, text string, bag string, doc string, m string, part string, score string"
    return spark.createDataFrame([(i, t, *["mine"] * 5) for i, t in rows], schema)


WORDS = ["Apple", "pear", "PLUM", "fig", "ünder", "Ünder", "日本", "x1", "42", "kiwi", "the"]


def made_documents():
    random = np.random.default_rng(11)
    texts = [" ".join(random.choice(WORDS[:8], size=n)) for n in random.integers(1, 30, size=120)]
    texts += [texts[0]] * 70 + ["pear,apple"] * 30 + ["apple pear unknown"] * 30 + ["Apple! pear? other"] * 5
    texts += [None, "", " \n", "...", "kiwi" * 3000, "the fig " * 4000, "a\x00pear\x7fapple"]
    docs = list(enumerate(texts, 100))
    return docs + [(None, "apple pear unknown"), (100, texts[0]), (-5, "apple pear unknown")]


ITEMS = [
    (1, "apple PEAR pear"), (2, "the the fig 42"), (3, None), (4, ""), (5, "nothing of this"), (6, "ünder日本 x1"),
    (7, "plum"), (7, "apple"), (None, "kiwi pear"), (9, "Ünder"),
]


@pytest.mark.parametrize("small", [False, True])
def test_search_against_brute_force(spark, monkeypatch, small):
    """Copies, ties, equal bags of different lengths, NULLs, long texts; several groups and tiny chunks."""
    if small:
        monkeypatch.setattr(lexical_bags, "VOCABULARY_BYTES", 400)
        monkeypatch.setattr(lexical_bags, "PAIRS", 40)
    docs = made_documents()
    frames = text_frame(spark, docs, "doc_id").repartition(5), text_frame(spark, ITEMS, "item_id")
    found = lexical_bags.search(frames[0], "doc_id", "text", frames[1], "item_id", "text", k=20)
    assert found_lists(found) == plain_search(docs, ITEMS, 20)


def test_search_of_empty_tables(spark):
    docs, items = text_frame(spark, [(1, "apple"), (2, None)], "doc_id"), text_frame(spark, ITEMS, "item_id")
    for a, b in ((docs.limit(0), items), (docs, items.limit(0)), (docs.where("text is null"), items)):
        assert lexical_bags.search(a, "doc_id", "text", b, "item_id", "text").collect() == []


def test_registered_search(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    found = queries.QUERIES["op12_lexical_search"](spark, SF_DIR)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert found_lists(found) == plain_search(docs, items, 20)
