"""Vectors and conversations against brute force, and their edge cases."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.llm import chat_format, embedding_dedup, queries

SF_DIR = "/root/testdata/sf0.01"


def plain_components(ids, vectors, least):
    good = [i for i, v in enumerate(vectors) if v is not None and len(v) and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))]
    root = list(range(len(ids)))
    links = [0] * len(ids)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, i in enumerate(good):
        a = np.array(vectors[i], float)
        for j in good[k + 1 :]:
            b = np.array(vectors[j], float)
            if len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= least:
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    smallest = {}
    for i, n in enumerate(ids):
        smallest[find(i)] = min(smallest.get(find(i), n), n)
    return {n: (links[i], smallest[find(i)]) for i, n in enumerate(ids)}


@pytest.mark.parametrize("block", [2048, 16])
def test_links_against_brute_force(spark, monkeypatch, block):
    """Clusters, exact copies, scaled copies, odd vectors and other lengths; full cells cut into blocks."""
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", block)
    monkeypatch.setattr(embedding_dedup, "CELL_ROWS", 16)
    random = np.random.default_rng(3)
    vectors = []
    for centre in random.normal(size=(40, 16)):
        for _ in range(random.integers(1, 12)):
            vectors.append((centre + random.normal(size=16) * random.choice([0.05, 0.2, 0.3])).tolist())
    vectors += [vectors[0]] * 60 + [(3 * np.array(vectors[1])).tolist()] * 3
    vectors += [None, [], [0.0] * 16, [float("nan")] * 16, [1.0, float("inf")] * 8, [1.0, 2.0], [2.0, 4.0], [1e300] * 16, [1e-300] * 16]
    ids = list(range(100, 100 + len(vectors)))
    schema = "vec_id long, embedding array<double>, kept string"
    frame = spark.createDataFrame([(i, v, "mine") for i, v in zip(ids, vectors)], schema)
    out = embedding_dedup.embedding_components(frame, "vec_id", "embedding", 0.95).collect()
    want = plain_components(ids, [np.array(v) / max(np.abs(v)) if v and np.isfinite(v).all() and np.any(v) else v for v in vectors], 0.95)
    assert len(out) == len(ids)
    missed = sum(want[r.vec_id][0] - r.n_links for r in out)
    assert 0 <= missed <= 0.01 * sum(w[0] for w in want.values())
    if not missed:
        assert {r.vec_id: r.component_id for r in out} == {i: w[1] for i, w in want.items()}
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)


def test_query_10_recall(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    found = {r.vec_id: r.n_links for r in queries.op10_embedding_dedup(spark, SF_DIR).collect()}
    v = np.array([r.embedding for r in rows], float)
    length = np.linalg.norm(v, axis=1)
    want = ((v @ v.T) / np.outer(length, length) >= 0.95).sum(1) - 1
    assert [found[r.vec_id] for r in rows] == want.tolist()


def test_empty_and_null_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert embedding_dedup.embedding_components(spark.createDataFrame([], schema), "vec_id", "embedding").collect() == []
    frame = spark.createDataFrame([(1, None), (None, [1.0, 2.0]), (5, [1.0, 2.0]), (5, [1.0, 2.0])], schema)
    out = sorted(map(tuple, embedding_dedup.embedding_components(frame, "vec_id", "embedding").collect()), key=str)
    assert out == [(1, 0, 1, True), (5, 2, 5, True), (5, 2, 5, True), (None, 2, 5, False)]


# --- conversations -------------------------------------------------------

def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def test_query_9(spark):
    rows = spark.read.parquet(f"{SF_DIR}/conversations.parquet").collect()
    chats = {-7: [("user", r"\### Assistant: </turn> ok"), ("assistant", r"\### Assistant: </turn> ok")]}
    for r in sorted(rows, key=lambda r: (r.conv_id, r.turn)):
        chats.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    out = {r.conv_id: r for r in queries.op9_chat_format(spark, SF_DIR).collect()}
    assert set(out) == set(chats)
    for i, turns in chats.items():
        learned = [t for role, t in turns if role == "assistant"]
        assert out[i].n_turns == len(turns) and out[i].turns_sha256 == digest(f"{r}\n{t}\n" for r, t in turns)
        assert out[i].loss_chars == sum(map(len, learned)) and out[i].loss_sha256 == digest(learned)
        assert out[i].formatted_chars >= sum(len(t) for _, t in turns)


@pytest.mark.parametrize("text", ["", "</turn>\n", "<turn user>", "\\", "\\\\<", "a\\", "<\\/turn>", "🙂\n</turn>\n<turn assistant>x"])
def test_round_trip(text):
    template = chat_format.Template()
    written = "".join(s for r in ("user", text, "assistant") for s, _ in template.segments(r, text))
    assert template.parse(written) == [(r, text) for r in ("user", text, "assistant")]
    assert all(c not in template.quoted(text) for c in (template.head, template.end))


def test_order_of_roles_and_odd_rows(spark):
    rows = [
        (1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"),
        (2, 0, "assistant", "a"), (2, 1, "user", "u"),
        (3, 0, "user", None), (3, 0, "user", None), (3, 1, None, "x"),
        (None, None, "user", "q"), (None, 1, "assistant", "r"), (4, 0, "user", "only"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("position", F.lit("mine"))
    formatted = chat_format.format_turns(frame, "conv_id", "turn", "role", "text")
    assert formatted.count() == len(rows)
    out = {r.conv_id: r for r in chat_format.read_back(formatted, "conv_id").collect()}
    assert {i: r.valid for i, r in out.items()} == {1: True, 2: False, 3: False, None: True, 4: False}
    assert out[3].n_turns == 3 and out[3].turns_sha256 == digest(["user\n\n", "user\n\n", "\nx\n"])
    empty = chat_format.format_turns(frame.where("false"), "conv_id", "turn", "role", "text")
    assert chat_format.read_back(empty, "conv_id").collect() == []


def test_template_refuses_unusable_controls():
    with pytest.raises(ValueError):
        chat_format.Template(end="<<")
