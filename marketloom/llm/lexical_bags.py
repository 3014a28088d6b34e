"""Ranked lexical search over classes of equal bags of words.

Documents are restricted to the words that the items ask for.  What is left of a document is its bag,
the words with their counts; its score for any item follows from the bag and one number ``m`` made
from its length.  Documents with equal bag and ``m`` are one class: found by the hash of the bag,
verified by the bag itself, scored once.  A class is as good as its smallest ``doc_id``, so the best
k classes per item hold the best k documents; their members are then taken in order of ``doc_id``.

Items are dealt into groups whose vocabulary is small enough to be sent to every task, however many
items there are, and a group is held against all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketloom.llm.tokens import byte_table, slices, words_of
from marketloom.sources.scratch import discard, scratch_path, stored

# Characters between terms, and the numbers of the score.
SEPARATORS = byte_table("".join(map(chr, [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])))
BASE, SHARE = 100 - 25, 25
TF_SCALE, TF_UNIT, LENGTH_UNIT = 1_000_000_000, 1000, 12

VOCABULARY_BYTES = 8 << 20  # terms of a group of items, sent to every task
TERM_BYTES = 64  # what a term takes there besides its characters
GROUP_ITEMS = 8192  # items of a group, on average
PAIRS = 2_000_000  # products of a term of a class and an item that are added up together


def _length_share(documents: int, length: int) -> Column:
    """100 - 25 + ((25 * n * N) div L)."""
    return F.lit(BASE) + F.expr(f"({SHARE}L * n * {documents}L) div {max(length, 1)}L")


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, term, times): the terms of each item; rows that share an id are one item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = words_of(part.column("text"), SEPARATORS)
                owner = part.column("item").take(pa.array(found.text))
                yield pa.RecordBatch.from_arrays([owner, found.words.cast(pa.binary())], ["item", "term"])

    given = items.select(F.col(id_col).alias("item"), F.col(text_col).cast("binary").alias("text"))
    schema = given.select("item", F.col("text").alias("term")).schema
    terms = given.mapInArrow(run, schema)
    return terms.groupBy("item", "term").agg(F.count(F.lit(1)).alias("times"))


@dataclass(frozen=True)
class Asked:
    """The items of a group as they are sent to every task.

    ``terms``: sorted; ``begin``: where the entries of a term start in ``item`` and ``weight``
    (the term's weight times its occurrences in that item).
    """

    ids: list
    terms: pa.Array
    begin: np.ndarray
    item: np.ndarray
    weight: np.ndarray


def _bags(docs: DataFrame, terms) -> DataFrame:
    """(doc, n, bag): the number of terms and the asked ones as pairs (number of the term, count)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = terms.value
        for batch in batches:
            for part in slices(batch, "text"):
                found = words_of(part.column("text"), SEPARATORS)
                n = np.bincount(found.text, minlength=part.num_rows)
                number = pc.fill_null(pc.index_in(found.words, value_set=known), -1).to_numpy()
                asked = number >= 0
                keys, counts = np.unique(found.text[asked] * len(known) + number[asked], return_counts=True)
                entries = np.empty((len(keys), 2), "<i8")
                entries[:, 0], entries[:, 1] = keys % max(len(known), 1), counts
                ends = np.searchsorted(keys, np.arange(1, part.num_rows + 1) * len(known))
                offsets = np.concatenate([[0], ends]) * entries.itemsize * 2
                bag = pa.Array.from_buffers(
                    pa.large_binary(), part.num_rows, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(entries)]
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), pa.array(n, pa.int64()), bag.cast(pa.binary())], ["doc", "n", "bag"]
                )

    return docs.mapInArrow(run, "doc long, n long, bag binary")


def _entries(bags: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and count of every entry of the bags."""
    bags = bags.cast(pa.large_binary())
    _, offsets, data = bags.buffers()
    bounds = np.frombuffer(offsets, np.int64)[bags.offset : bags.offset + len(bags) + 1] // 16
    flat = np.frombuffer(data, "<i8")[2 * bounds[0] : 2 * bounds[-1]].reshape(-1, 2) if data else np.empty((0, 2), np.int64)
    return np.repeat(np.arange(len(bags)), np.diff(bounds)), flat[:, 0], flat[:, 1]


def _document_counts(classes: DataFrame) -> DataFrame:
    """(term, df): the documents that hold each asked term, from the sizes of the classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, term, _ = _entries(batch.column("bag"))
            df = np.bincount(term, weights=batch.column("members").to_numpy()[row]).astype(np.int64)
            held = np.flatnonzero(df)
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(df[held])], ["term", "df"])

    counted = classes.select("bag", "members").mapInArrow(run, "term long, df long")
    return counted.groupBy("term").agg(F.sum("df").alias("df"))


class _Best:
    """The k best classes per item of what a task has read, by score and then by smallest doc_id."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.zeros(items, np.int64)
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.bags: list[bytes] = []
        self.size = 0

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, m: np.ndarray, row: np.ndarray, bags: pa.Array) -> None:
        used, place = np.unique(row, return_inverse=True)
        place = place + len(self.bags)
        self.bags += bags.take(pa.array(used)).to_pylist()
        self.parts.append((item, score, doc, m, place))
        self.size += len(item)
        if self.size > max(200_000, 4 * self.k * len(self.least)):
            self.compact()

    def compact(self) -> None:
        if not self.parts:
            return
        item, score, doc, m, place = (np.concatenate(c) for c in zip(*self.parts))
        order = np.lexsort((doc, -score, item))
        item = item[order]
        start = np.r_[0, np.flatnonzero(np.diff(item)) + 1]
        rank = np.arange(len(item)) - np.repeat(start, np.diff(np.r_[start, len(item)]))
        kept = order[rank < self.k]
        last = order[rank == self.k - 1]
        item, score, doc, m, place = (np.concatenate(c)[kept] for c in zip(*self.parts))
        full_item, full_score = (np.concatenate(c)[last] for c in list(zip(*self.parts))[:2])
        self.least[full_item] = full_score
        used, place = np.unique(place, return_inverse=True)
        self.bags = [self.bags[i] for i in used]
        self.parts, self.size = [(item, score, doc, m, place)], len(item)

    def rows(self) -> tuple[np.ndarray, ...]:
        self.compact()
        return self.parts[0] if self.parts else (np.empty(0, np.int64),) * 5


def _best_classes(classes: DataFrame, asked, k: int) -> DataFrame:
    """(item_at, score, doc, m, bag): per task and item the k best classes; ``doc`` is the smallest member."""
    names = ["item_at", "score", "doc", "m", "bag"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: Asked = asked.value
        items, spread = len(given.ids), np.diff(given.begin)
        best = _Best(items, k)
        for batch in batches:
            row, term, tf = _entries(batch.column("bag"))
            doc, m = batch.column("doc").to_numpy(), batch.column("m").to_numpy()
            share = TF_SCALE * tf // (TF_UNIT * tf + LENGTH_UNIT * m[row])
            # classes are taken together as long as their products, and their scores, are few
            first = np.searchsorted(row, np.arange(batch.num_rows + 1))
            work = np.r_[0, np.cumsum(spread[term])][first] + np.arange(batch.num_rows + 1) * items
            begin = 0
            while begin < batch.num_rows:
                end = max(begin + 1, int(np.searchsorted(work, work[begin] + PAIRS, side="right")) - 1)
                here = slice(first[begin], first[end])
                times = spread[term[here]]
                at = np.repeat(given.begin[term[here]] - np.r_[0, np.cumsum(times)[:-1]], times) + np.arange(times.sum())
                scores = np.zeros((end - begin) * items, np.int64)
                cell = np.repeat((row[here] - begin) * items, times) + given.item[at]
                np.add.at(scores, cell, given.weight[at] * np.repeat(share[here], times))
                scores = scores.reshape(end - begin, items)
                # an equal score may still win by its smaller doc_id
                r, i = np.nonzero((scores > 0) & (scores >= best.least))
                if len(r):
                    best.add(i, scores[r, i], doc[begin + r], m[begin + r], begin + r, batch.column("bag"))
                begin = end
        item, score, doc, m, place = best.rows()
        for begin in range(0, len(item), 10_000):
            part = slice(begin, begin + 10_000)
            bags = [best.bags[p] for p in place[part]]
            arrays = [pa.array(c[part], pa.int64()) for c in (item, score, doc, m)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(bags, pa.binary())], names)

    given = classes.select("doc", "m", "bag")
    return given.mapInArrow(run, "item_at long, score long, doc long, m long, bag binary")


def _search_group(
    spark: SparkSession, docs: DataFrame, terms: DataFrame, group: int, k: int
) -> tuple[DataFrame, str]:
    """The k best documents for the items of one group, and the scratch table of bags it reads."""
    sent = spark.sparkContext.broadcast
    group_terms = terms.where(F.col("part") == group)
    vocabulary = group_terms.select("term").distinct().orderBy("term").toArrow().column("term")
    known = pa.array(vocabulary.to_pylist(), pa.large_binary())
    bags_path = scratch_path(spark, "bags")
    bags = stored(_bags(docs, sent(known)), path=bags_path)
    total = bags.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()

    # a document without an asked term has no score; smallest ids last where they are NULL
    with_m = bags.where(F.octet_length("bag") > 0).select(
        F.coalesce("doc", F.lit(np.iinfo(np.int64).max)).alias("doc"),
        _length_share(total.documents, total.length).alias("m"),
        F.xxhash64("bag").alias("h"), "bag",
    )
    found = with_m.groupBy("h", "m", "bag").agg(F.count(F.lit(1)).alias("members"), F.min("doc").alias("doc"))
    classes = stored(found.select("doc", "m", "bag", "members"), "classes")

    df = {r.term: r.df for r in _document_counts(classes).collect()}
    counts = np.array([df.get(t, 0) for t in range(len(known))], np.float64)
    weight = np.floor(1000 * np.log((2 * total.documents + 2) / (2 * counts + 1))).astype(np.int64)
    entries = group_terms.select("item", "term", "times").toArrow()
    ids = entries.column("item").combine_chunks().unique()
    number = pc.index_in(entries.column("term").cast(pa.large_binary()).combine_chunks(), value_set=known).to_numpy()
    item = pc.index_in(entries.column("item").combine_chunks(), value_set=ids).to_numpy().astype(np.int64)
    order = np.argsort(number, kind="stable")
    begin = np.searchsorted(number[order], np.arange(len(known) + 1))
    products = (weight[number] * entries.column("times").to_numpy())[order]
    asked = sent(Asked(ids.to_pylist(), known, begin, item[order], products))

    per_item = Window.partitionBy("item_at").orderBy(F.col("score").desc(), "doc")
    best = _best_classes(classes, asked, k)
    winners = stored(
        best.withColumn("place", F.row_number().over(per_item)).where(F.col("place") <= k)
        .select("item_at", "score", "m", F.xxhash64("bag").alias("h"), "bag"),
        "winners",
    )
    # members: k winners per item at most, so their hashes are few; the bags decide
    hashes = winners.select("h", "m").distinct()
    members = with_m.join(F.broadcast(hashes), ["h", "m"], "left_semi")
    first = Window.partitionBy("h", "m", "bag").orderBy("doc")
    members = members.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k)
    ranked = (
        winners.join(members.select("h", "m", "bag", "doc"), ["h", "m", "bag"])
        .withColumn("rank", F.row_number().over(per_item))
        .where(F.col("rank") <= k)
        .select("item_at", "rank", "doc", "score")
    )
    names = spark.createDataFrame(pa.table({"item_at": pa.array(range(len(ids)), pa.int64()), "item": ids}))
    return ranked.join(names, "item_at").select("item", "rank", "doc", "score"), bags_path


def search(
    docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, k: int = 20
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents with the highest score above 0 for each item.

    Terms are runs of letters, digits and non-ASCII characters in whole texts, only A-Z lower-cased.
    Ids of documents are whole numbers; equal scores rank by ascending id, a NULL id last (it is
    returned as NULL).  NULL or empty texts hold no term: such a document counts nowhere, such an item
    has no answer, nor has one whose terms no document holds.  Repeated rows are documents each; rows
    that share an ``item_id`` are read as one item.  Fewer than k documents with a score: all of them;
    an empty table on either side: no rows.  Texts may be of any length.  Other columns, of any name,
    are neither read nor returned.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).cast("binary").alias("text"))
    terms = stored(item_terms(items, item_id, item_text), "item_terms")
    size = terms.agg(
        F.coalesce(F.sum(F.octet_length("term") + TERM_BYTES), F.lit(0)).alias("bytes"),
        F.count_distinct(F.struct("item")).alias("items"),
    ).first()
    groups = max(1, -(-size.bytes // VOCABULARY_BYTES), -(-size.items // GROUP_ITEMS))
    dealt = terms.withColumn("part", F.pmod(F.xxhash64("item"), F.lit(groups)))
    answers = []
    for group in range(groups):
        found, bags_path = _search_group(spark, narrow, dealt, group, k)
        answers.append(stored(found, "answers"))
        discard(spark, bags_path)
    out = reduce(DataFrame.unionAll, answers)
    doc = F.when(F.col("doc") < np.iinfo(np.int64).max, F.col("doc"))
    return out.select(F.col("item").alias("item_id"), "rank", doc.alias("doc_id"), "score")
