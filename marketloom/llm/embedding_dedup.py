"""Near-duplicate vectors by an inverted multi-index.

Each vector, scaled to length one, is cut into two halves.  Each half has its own codebook, and the
two codebooks form a grid of cells; every vector is entered in the cell of its two nearest codewords.
A query visits cells in the order of a lower bound of its distance to anything inside: by how much the
query lies on its own side of the plane between two codewords, squared and added over the halves (the
multi-sequence order).  The traversal ends where the bound passes a reach that is calibrated for the
target recall: sample vectors are turned by exactly the wanted angle in random directions, and the
reach covers the cells of that share of them.  Real links are mostly closer than that and found more
often.  What a visit finds is verified by the cosine in double precision, so no false link is made.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import connected_components
from marketloom.sources.scratch import stored

SAMPLE_ROWS = 20_000  # vectors, chosen by hash, from which the codebooks are fitted
MAX_CODEWORDS = 1024  # per half; cells: the square of it
CELL_ROWS = 512  # vectors per cell that the codebook size aims at
TARGET_RECALL = 0.999  # of pairs that have just the wanted cosine
CALIBRATION_ROWS = 4096  # sample vectors that are turned to find the reach
BLOCK_ROWS = 2048  # vectors of one side that are compared in one task at a time


@dataclass(frozen=True)
class Codebooks:
    """Codewords of the first and the second half, for vectors of one length."""

    first: np.ndarray
    second: np.ndarray


def _fit(points: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's algorithm from a fixed seed; empty codewords stay where they are."""
    distinct = np.unique(points, axis=0)
    picks = np.random.default_rng(7).choice(len(distinct), min(k, len(distinct)), replace=False)
    words = distinct[picks].copy()
    for _ in range(rounds):
        near = np.argmin((words**2).sum(1)[None, :] - 2 * points @ words.T, axis=1)
        count = np.bincount(near, minlength=len(words))
        for axis in range(points.shape[1]):
            sums = np.bincount(near, points[:, axis], len(words))
            words[:, axis] = np.where(count > 0, sums / np.maximum(count, 1), words[:, axis])
    return words


def fit_codebooks(sample: list[np.ndarray], k: int) -> dict[int, Codebooks]:
    """Codebooks per vector length that occurs in the sample."""
    books = {}
    for size in sorted({len(v) for v in sample}):
        points = unit(np.array([v for v in sample if len(v) == size]))
        cut = size // 2
        books[size] = Codebooks(_fit(points[:, :cut], k), _fit(points[:, cut:], k))
    return books


def unit(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _bounds(points: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest codeword, and per codeword the square of the least distance to a point of its cell."""
    d2 = (points**2).sum(1)[:, None] + (words**2).sum(1)[None, :] - 2 * points @ words.T
    near = np.argmin(d2, axis=1)
    own = words[near]
    gap = np.sqrt(np.maximum((own**2).sum(1)[:, None] + (words**2).sum(1)[None, :] - 2 * own @ words.T, 0))
    over = d2 - d2[np.arange(len(points)), near][:, None]
    bound = np.divide(over, 2 * gap, out=np.zeros_like(over), where=gap > 1e-9)
    return near, np.maximum(bound, 0) ** 2


def calibrated_reach(books: Codebooks, sample: np.ndarray, cosine: float, recall: float) -> float:
    """The bound within which the cell of a neighbour lies for a share ``recall`` of turned vectors.

    It is never beyond the squared distance itself, at which nothing can be missed.
    """
    random = np.random.default_rng(11)
    points = unit(sample[:CALIBRATION_ROWS])
    aside = random.normal(size=points.shape)
    aside -= (aside * points).sum(1)[:, None] * points
    size = np.linalg.norm(aside, axis=1, keepdims=True)
    turned = cosine * points + np.sqrt(1 - cosine**2) * np.divide(aside, size, out=0 * aside, where=size > 0)
    cut, at, needed = books.first.shape[1], np.arange(len(points)), 0.0
    for half, words in ((slice(0, cut), books.first), (slice(cut, None), books.second)):
        needed = needed + _bounds(points[:, half], words)[1][at, _bounds(turned[:, half], words)[0]]
    return min(float(np.quantile(needed, recall, method="higher")), 2 - 2 * cosine) + 1e-9


def visits(points: np.ndarray, books: Codebooks, reach2: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, own cell): cells in multi-sequence order, until the bound passes ``reach2``."""
    cut = books.first.shape[1]
    near1, e1 = _bounds(points[:, :cut], books.first)
    near2, e2 = _bounds(points[:, cut:], books.second)
    width = len(books.second)
    rows, cells = [], []
    for r in range(len(points)):
        i, j = np.nonzero(e1[r] <= reach2)[0], np.nonzero(e2[r] <= reach2)[0]
        total = e1[r][i][:, None] + e2[r][j][None, :]
        a, b = np.nonzero(total <= reach2)
        order = np.argsort(total[a, b], kind="stable")
        cells.append((i[a] * width + j[b])[order])
        rows.append(np.full(len(a), r))
    return np.concatenate(rows), np.concatenate(cells), near1 * width + near2


def _entries(distinct: DataFrame, books: dict[int, tuple[Codebooks, float]]) -> DataFrame:
    """(size, cell, asks, home, key, copies, v): each vector in its cell, and as a query where it visits.

    ``home`` marks a query in its own cell.  A pair in different cells is looked for from the cell
    with the smaller number only.  Vectors of a length without codebooks share one cell.
    """

    def run(batches):
        for batch in batches:
            keys, copies = (batch.column(i).to_numpy() for i in range(2))
            offsets = batch.column(2).offsets.to_numpy()
            flat = batch.column(2).values.to_numpy()
            lengths = np.diff(offsets)
            for size in np.unique(lengths):
                at = np.nonzero(lengths == size)[0]
                for part in np.array_split(at, -(-len(at) // 1024)):
                    held = flat[offsets[part][:, None] + np.arange(size)[None, :]]
                    if int(size) in books:
                        rows, cells, own = visits(unit(held), *books[int(size)])
                    else:
                        rows, cells, own = np.arange(len(part)), np.zeros(len(part), int), np.zeros(len(part), int)
                    onward = cells >= own[rows]
                    rows, cells = rows[onward], cells[onward]
                    who = np.concatenate((np.arange(len(part)), rows))
                    asks = np.arange(len(who)) >= len(part)
                    where = np.concatenate((own, cells))
                    starts = np.arange(len(who) + 1, dtype=np.int32) * np.int32(size)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "size": pa.array(np.full(len(who), size, np.int32)),
                            "cell": pa.array(where.astype(np.int64)),
                            "asks": pa.array(asks),
                            "home": pa.array(asks & (where == own[who])),
                            "key": pa.array(keys[part][who]),
                            "copies": pa.array(copies[part][who]),
                            "v": pa.ListArray.from_arrays(pa.array(starts), pa.array(held[who].ravel())),
                        }
                    )

    schema = "size int, cell long, asks boolean, home boolean, key long, copies long, v array<double>"
    return distinct.select("key", "copies", "v").mapInArrow(run, schema)


def _blocks(entries: DataFrame) -> DataFrame:
    """Entries with the block pairs in which they are compared; a full cell is cut on both sides."""
    sides = entries.groupBy("size", "cell").agg(
        F.count_if(~F.col("asks")).alias("held"), F.count_if("asks").alias("asked")
    )
    sides = sides.where("held > 0 AND asked > 0").select(
        "size", "cell",
        F.ceil(F.col("held") / BLOCK_ROWS).cast("int").alias("held_blocks"),
        F.ceil(F.col("asked") / BLOCK_ROWS).cast("int").alias("asked_blocks"),
    )
    own = F.pmod(F.xxhash64("key"), F.when(F.col("asks"), F.col("asked_blocks")).otherwise(F.col("held_blocks")))
    other = F.when(F.col("asks"), F.col("held_blocks")).otherwise(F.col("asked_blocks"))
    return (
        entries.join(sides, ["size", "cell"])
        .withColumn("own", own.cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), other - 1)))
        .select(
            "size", "cell", "asks", "home", "key", "copies", "v",
            F.when(F.col("asks"), F.col("other")).otherwise(F.col("own")).alias("held_block"),
            F.when(F.col("asks"), F.col("own")).otherwise(F.col("other")).alias("asked_block"),
        )
    )


def _local_roots(keys: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, smallest key that each reaches over the pairs a, b), for the keys in pairs."""
    every, where = np.unique(np.concatenate((keys[a], keys[b])), return_inverse=True)
    x, y = where[: len(a)], where[len(a) :]
    label = np.arange(len(every))
    while True:
        least = np.minimum(label[x], label[y])
        if (label[x] == least).all() and (label[y] == least).all():
            return every, every[label]
        np.minimum.at(label, x, least)
        np.minimum.at(label, y, least)
        label = label[label]


def _compare(least_cosine: float):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        asks = block["asks"].to_numpy()
        keys, copies = block["key"].to_numpy(), block["copies"].to_numpy()
        q, h = np.nonzero(asks)[0], np.nonzero(~asks)[0]
        if not len(q) or not len(h):
            return pd.DataFrame({"key": [], "links": [], "root": []}).astype("int64")
        rows = np.array(block["v"].tolist(), np.float64)
        rows = rows / np.abs(rows).max(axis=1, keepdims=True)
        length = np.linalg.norm(rows, axis=1)
        cosine = (rows[q] @ rows[h].T) / (length[q][:, None] * length[h][None, :])
        linked = cosine >= least_cosine
        # in its own cell a query would see itself, and every pair would be seen twice
        home = block["home"].to_numpy()[q]
        linked &= ~home[:, None] | (keys[q][:, None] < keys[h][None, :])
        x, y = np.nonzero(linked)
        a, b = q[x], h[y]
        every, root = _local_roots(keys, a, b)
        links = np.zeros(len(every), np.int64)
        np.add.at(links, np.searchsorted(every, keys[a]), copies[b])
        np.add.at(links, np.searchsorted(every, keys[b]), copies[a])
        return pd.DataFrame({"key": every, "links": links, "root": root})

    return run


def embedding_components(
    df: DataFrame,
    id_col: str,
    vector: str,
    cosine: float = 0.95,
    recall: float = TARGET_RECALL,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``df``.

    Vectors link if their cosine is ``cosine`` or more.  ``n_links`` counts the other rows linked
    directly, ``component_id`` is the smallest id reachable, the row's own included, and ``kept`` says
    that it is the row's own.  Equal vectors are merged before any comparison and count by number.  A
    vector that is NULL, empty, zero or holds NULL or non-finite components links with nothing, and
    vectors of different lengths never link.  NULL ids are never the smallest unless a component has
    no other; then it has no id and nothing of it is kept.

    The codebooks are fitted on at most ``sample_rows`` distinct vectors; all are indexed and asked.
    Pairs of just the wanted cosine are found with the probability ``recall``.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    sound = F.coalesce(
        (F.size("v") > 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0),
        F.lit(False),
    )
    rows = stored(rows.withColumn("v", F.when(sound, F.col("v"))), "vectors")
    distinct = rows.where("v IS NOT NULL").groupBy("v").agg(
        F.min("id").alias("least_id"), F.count(F.lit(1)).alias("copies")
    )
    distinct = stored(distinct.withColumn("key", F.monotonically_increasing_id()), "distinct-vectors")

    chosen = distinct.select("v").orderBy(F.xxhash64("v")).limit(sample_rows).collect()
    sample = [np.array(r[0], np.float64) for r in chosen]
    k = int(np.clip(np.sqrt(distinct.count() / CELL_ROWS), 1, MAX_CODEWORDS))
    books = {
        size: (book, calibrated_reach(book, np.array([v for v in sample if len(v) == size]), cosine, recall))
        for size, book in fit_codebooks(sample, k).items()
    }
    entries = stored(_entries(distinct, books), "cells")
    found = stored(
        _blocks(entries)
        .groupBy("size", "cell", "held_block", "asked_block")
        .applyInPandas(_compare(cosine), "key long, links long, root long"),
        "links",
    )
    roots = connected_components(found, "key", "root")
    linked = found.groupBy("key").agg(F.sum("links").alias("links"))
    nodes = (
        distinct.join(linked, "key", "left")
        .join(roots, F.col("key") == F.col("node"), "left")
        .select(
            "v", "least_id", F.coalesce("root", "key").alias("root"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    nodes = stored(nodes, "vector-nodes")
    least = nodes.groupBy("root").agg(F.min("least_id").alias("component_id"))
    labels = nodes.join(least, "root").select("v", "n_links", "component_id")
    own = F.when(F.col("v").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return (
        rows.join(labels, "v", "left")
        .withColumn("component_id", own)
        .select(
            F.col("id").alias(id_col),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            "component_id",
            F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"),
        )
    )
