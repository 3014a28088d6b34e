"""Removing repeated passages: difference-cover suffix sorting over synchronised contexts.

A byte goes if a string of ``width`` bytes that covers it also starts earlier.  Sorting every suffix of
a corpus as rows would move it many times over, so what has to be sorted is found first, without loss:

1.  Every ``width``-byte string has an anchor, the place in it whose ``GRAM`` bytes have the least hash.
    Equal strings have equal anchors.  The strings of one anchor are a run of starts; its context is
    the bytes that they cover.
2.  A string can only repeat if its anchor's hash does.  Anchors whose hash is alone are left out.
3.  Of equal contexts the earliest stays and the strings of the others are repeats.
4.  Where an anchor's hash has different contexts left, these are sorted: anchors are dealt by their
    hash, each task puts its contexts into one text and builds the suffix array by the difference cover
    of three (sort the sampled triples, name them, recurse while names repeat, place the remaining
    suffixes by their first byte and the sample after it, and merge).  Neighbours in it whose first
    ``width`` bytes agree are copies; all but the earliest are repeats.

A hash with very many anchors is not put into one task: its contexts, and the strings of those that
differ, are counted one by one, which Spark combines before the shuffle.  So are the strings of a hash
whose differing contexts hold more bytes than are sorted together.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.common import free_name, other_columns
from marketloom.sources.scratch import scratch_path, stored

WIDTH = 100
GRAM = 32
BATCH_BYTES = 1 << 20  # bytes hashed together
SORT_BYTES = 1 << 20  # bytes of contexts of one hash that are sorted; a text holds less than twice as many
CROWDED = 100_000  # anchors of one hash from which on its contexts and strings are counted one by one
FILTER_BITS = 26  # size of the broadcast filter, whatever the corpus: 2**26 bits
NARROW, WIDE = 21, 31  # bits of a name: three narrow ones fit a long, of wide ones two
_U = np.uint64


# --- suffix array --------------------------------------------------------


def _dense(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Order of the keys, their names from 1 in that order, and the number of names."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    names = np.empty(len(keys), np.int64)
    names[order] = np.cumsum(np.concatenate(([1], (ordered[1:] != ordered[:-1]).astype(np.int64))))
    return order, names, int(names[order[-1]]) if len(keys) else 0


def _pairs(s: np.ndarray, bits: int) -> np.ndarray:
    """Keys of neighbours, in their order, that leave ``bits`` bits of a long free."""
    if bits == NARROW:
        return (s[:-1] << bits) | s[1:]
    return _dense((s[:-1] << bits) | s[1:])[1]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array by the difference cover of three; values from 1, they and the length below 2**31 - 3."""
    n = len(text)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: text[i:].tolist()), np.int64)
    s = np.concatenate((text.astype(np.int64), np.zeros(3, np.int64)))
    # a sample at n stands for the empty suffix, so that the first part of the named text ends by itself
    ones = np.arange(1, n + (n % 3 == 1), 3)
    sample = np.concatenate((ones, np.arange(2, n, 3)))
    bits = NARROW if max(int(s.max()), n + 3) < 1 << NARROW else WIDE
    pair = _pairs(s, bits)
    _, names, count = _dense((pair[sample] << bits) | s[np.minimum(sample + 2, n + 2)])
    if count < len(sample):
        order = suffix_array(names)
    else:
        order = np.argsort(names, kind="stable")
    rank = np.zeros(n + 3, np.int64)
    sorted_sample = sample[order]
    rank[sorted_sample] = np.arange(1, len(sample) + 1)
    sorted_sample = sorted_sample[sorted_sample < n]
    rest = np.arange(0, n, 3)
    rest_key = (s[rest] << bits) | rank[rest + 1]
    by_key = np.argsort(rest_key, kind="stable")
    rest, rest_key = rest[by_key], rest_key[by_key]
    first = sorted_sample[sorted_sample % 3 == 1]
    second = sorted_sample[sorted_sample % 3 == 2]
    below_first = np.searchsorted((s[first] << bits) | rank[first + 1], rest_key)
    second_key = (pair[second] << bits) | rank[second + 2]
    below_second = np.searchsorted(second_key, (pair[rest] << bits) | rank[rest + 2])
    place = np.arange(len(rest)) + below_first + below_second
    out = np.empty(n, np.int64)
    taken = np.zeros(n, bool)
    out[place] = rest
    taken[place] = True
    out[~taken] = sorted_sample
    return out


def equal_neighbours(text: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """For suffixes in order: True where the first ``width`` bytes equal those of the one before."""
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    same = np.zeros(len(starts), bool)
    live = np.arange(1, len(starts))
    for at in [*range(0, width - 7, 8), width - 8]:
        a, b = starts[live] + at, starts[live - 1] + at
        live = live[(words[a] == words[b]).all(axis=1)]
    same[live] = True
    return same


# --- anchors -------------------------------------------------------------

_byte_value = np.random.default_rng(2024).integers(1, 1 << 63, (2, 256), np.uint64) | _U(1)
_BASE = (_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F))
_powers: list[tuple[np.ndarray, np.ndarray]] = []


def _power(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    if not _powers or len(_powers[0][0]) < n:
        _powers.clear()
        for base in _BASE:
            inverse = _U(pow(int(base), -1, 1 << 64))
            up, down = np.full(n, base), np.full(n, inverse)
            up[0] = down[0] = 1
            _powers.append((np.multiply.accumulate(up), np.multiply.accumulate(down)))
    return _powers


class Hashed:
    """Rolling hashes of a text: any stretch of it, in either of two independent ways."""

    def __init__(self, data: np.ndarray, ways: int):
        self.tables = []
        for way in range(ways):
            up, down = _power(max(len(data) + 1, BATCH_BYTES))[way]
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(_byte_value[way][data] * up[: len(data)], out=sums[1:])
            self.tables.append((sums, down))

    def of(self, way: int, begin: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
        sums, down = self.tables[way]
        x = (sums[end] - sums[begin]) * down[begin]
        return (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)


def anchors(data: np.ndarray, sizes: np.ndarray, hashed: Hashed, width: int) -> tuple[np.ndarray, ...]:
    """(hash, document, low, high): the anchors of concatenated documents, with their runs of starts."""
    n, span = len(data), width - GRAM + 1
    ends = np.cumsum(sizes)
    strings = np.maximum(sizes - width + 1, 0)
    if not strings.sum():
        return tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64))
    gram = hashed.of(0, slice(0, n - GRAM + 1), slice(GRAM, n + 1))
    place = np.arange(len(gram), dtype=np.uint64)
    low_bits = _U((1 << 32) - 1)  # the same for all batches: equal strings must choose alike
    least = (gram & ~low_bits) | place
    have = 1
    while have * 2 <= span:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if span > have:
        least = np.minimum(least[: -(span - have)], least[span - have :])
    # starts of strings that lie within their document
    begin = ends - sizes
    document = np.repeat(np.arange(len(sizes)), strings)
    start = np.arange(strings.sum()) - np.repeat(np.cumsum(strings) - strings, strings) + np.repeat(begin, strings)
    at = (least[start] & low_bits).astype(np.int64)
    edge = np.concatenate(([True], (at[1:] != at[:-1]) | (document[1:] != document[:-1])))
    first = np.nonzero(edge)[0]
    last = np.append(first[1:], len(at)) - 1
    return gram[at[first]], document[first], start[first], start[last]


def _batches(texts: list[bytes]):
    """(first, data, sizes) of runs of documents of about BATCH_BYTES; longer documents stand alone."""
    begin = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > BATCH_BYTES:
            yield begin, texts[begin:i]
            begin, size = i, 0
        size += len(t)
    if texts[begin:]:
        yield begin, texts[begin:]


def _in_filter(words: np.ndarray, x: np.ndarray) -> np.ndarray:
    bits = 6 + len(words).bit_length() - 1
    bit = (x >> _U(64 - bits)).astype(np.int64)
    return (words[bit >> 6] >> (bit & 63).astype(np.uint64)) & _U(1) > 0


def _filter_words(hashes: DataFrame, column: str) -> np.ndarray:
    """A bit per hash prefix: at most 2**FILTER_BITS bits come to the driver, however many hashes there are."""
    bit = F.shiftrightunsigned(column, 64 - FILTER_BITS)
    rows = (
        hashes.select(F.shiftright(bit, 6).cast("int").alias("word"), F.expr(f"shiftleft(1L, int(shiftrightunsigned({column}, {64 - FILTER_BITS}) & 63))").alias("bits"))
        .groupBy("word")
        .agg(F.bit_or("bits").alias("bits"))
        .toArrow()
    )
    words = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    words[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return words


def _identity(row: np.ndarray, low: np.ndarray) -> np.ndarray:
    """A hash of an anchor's own place, by shifts only, so that SQL can say the same."""
    x = row.astype(np.uint64) ^ (low.astype(np.uint64) << _U(37))
    for _ in range(2):
        x ^= x << _U(13)
        x ^= x >> _U(7)
        x ^= x << _U(17)
    return x


def _identity_column() -> Column:
    x = F.col("row").bitwiseXOR(F.shiftleft("low", 37))
    for _ in range(2):
        for shift, n in ((F.shiftleft, 13), (F.shiftrightunsigned, 7), (F.shiftleft, 17)):
            x = x.bitwiseXOR(shift(x, n))
    return x


def _scan(docs: DataFrame, schema: str, emit) -> DataFrame:
    """Run ``emit(rows, ids, data, sizes, begin)`` over batches of whole documents (row, id, data)."""

    def run(batches):
        for batch in batches:
            rows, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            texts = batch.column(2).to_pylist()
            for first, part in _batches(texts):
                data = np.frombuffer(b"".join(part), np.uint8)
                sizes = np.fromiter(map(len, part), np.int64, len(part))
                here = slice(first, first + len(part))
                made = emit(rows[here], ids[here], data, sizes)
                if made is not None and made.num_rows:
                    yield made

    return docs.mapInArrow(run, schema)


def _all_hashes(docs: DataFrame, width: int) -> DataFrame:
    def emit(rows, ids, data, sizes):
        h, *_ = anchors(data, sizes, Hashed(data, 1), width)
        return pa.RecordBatch.from_pydict({"h": pa.array(h.view(np.int64))})

    return _scan(docs, "h long", emit)


def _contexts(docs: DataFrame, width: int, words) -> DataFrame:
    """Anchors that pass the filter, with a hash of their context."""

    def emit(rows, ids, data, sizes):
        hashed = Hashed(data, 2)
        h, doc, low, high = anchors(data, sizes, hashed, width)
        keep = _in_filter(words.value, h)
        h, doc, low, high = (x[keep] for x in (h, doc, low, high))
        begin = np.cumsum(sizes) - sizes
        # together with the anchor's own hash, 128 bits; only contexts of one anchor hash are compared
        c = hashed.of(1, low, high + width)
        return pa.RecordBatch.from_pydict(
            {
                "h": pa.array(h.view(np.int64)), "c": pa.array(c.view(np.int64)), "size": pa.array((high - low).astype(np.int32)),
                "id": pa.array(ids[doc]), "row": pa.array(rows[doc]), "low": pa.array(low - begin[doc]),
            }
        )

    return _scan(docs, "h long, c long, size int, id long, row long, low long", emit)


def _context_bytes(docs: DataFrame, width: int, words) -> DataFrame:
    """(h, id, row, low, bytes) of the anchors that pass the filter on their own place."""

    def emit(rows, ids, data, sizes):
        h, doc, low, high = anchors(data, sizes, Hashed(data, 1), width)
        begin = np.cumsum(sizes) - sizes
        keep = _in_filter(words.value, _identity(rows[doc], low - begin[doc]))
        h, doc, low, high = (x[keep] for x in (h, doc, low, high))
        whole = data.tobytes()
        texts = [whole[a:b] for a, b in zip(low.tolist(), (high + width).tolist())]
        return pa.RecordBatch.from_pydict(
            {
                "h": pa.array(h.view(np.int64)), "id": pa.array(ids[doc]), "row": pa.array(rows[doc]),
                "low": pa.array(low - begin[doc]), "bytes": pa.array(texts, pa.binary()),
            }
        )

    return _scan(docs, "h long, id long, row long, low long, bytes binary", emit)


def repeats_in(texts: list[bytes], ids: np.ndarray, rows: np.ndarray, lows: np.ndarray, width: int):
    """(row, low, high): runs of starts in the contexts whose strings start earlier in another or the same."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    joined = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    begin = np.cumsum(sizes) - sizes
    # bytes as names from 2 on; what stands between contexts is 1 and equals no byte of a string
    names = joined.astype(np.int64) + 2
    names[begin + sizes - 1] = 1
    order = suffix_array(names)
    context = np.repeat(np.arange(len(texts)), sizes)
    inside = order - begin[context[order]] <= sizes[context[order]] - 1 - width
    starts = order[inside]
    same = equal_neighbours(joined, starts, width)
    group = np.cumsum(~same)
    who = context[starts]
    position = lows[who] + starts - begin[who]
    by_age = np.lexsort((position, rows[who], ids[who], group))
    group_sorted = group[by_age]
    later = np.concatenate(([False], group_sorted[1:] == group_sorted[:-1])) if len(by_age) else np.zeros(0, bool)
    chosen = by_age[later]
    # the same string may stand in two contexts of one document: once is enough
    pairs = np.unique(np.stack((rows[who][chosen], position[chosen])), axis=1) if len(chosen) else np.zeros((2, 0), np.int64)
    row, at = pairs
    edge = np.nonzero(np.concatenate(([True], (np.diff(row) != 0) | (np.diff(at) != 1))))[0] if len(row) else np.zeros(0, np.int64)
    last = np.append(edge[1:], len(row)) - 1 if len(edge) else edge
    return row[edge], at[edge], at[last]


def _sorted_repeats(contexts: DataFrame, width: int) -> DataFrame:
    """(row, low, high) from contexts that are dealt and sorted by their hash and place.

    A context counts if a row of its place without bytes stands before it.
    """

    def run(batches):
        held: list[tuple] = []
        size, last, wanted = 0, None, None

        def flush():
            ids, rows, lows = (np.array([c[i] for c in held], np.int64) for i in range(3))
            row, low, high = repeats_in([c[3] for c in held], ids, rows, lows, width)
            return pa.RecordBatch.from_pydict({"row": pa.array(row), "low": pa.array(low), "high": pa.array(high)})

        for batch in batches:
            hs, ids, rows, lows, texts = (c.to_pylist() for c in batch.columns)
            for h, *one in zip(hs, ids, rows, lows, texts):
                if one[3] is None:
                    wanted = (one[1], one[2])
                    continue
                if wanted != (one[1], one[2]):
                    continue
                if h != last and size > SORT_BYTES:
                    yield flush()
                    held, size = [], 0
                held.append(tuple(one))
                size += len(one[3]) + 1
                last = h
        if held:
            yield flush()

    return contexts.select("h", "id", "row", "low", "bytes").mapInArrow(run, "row long, low long, high long")


def _counted_repeats(contexts: DataFrame, width: int) -> DataFrame:
    """The same for crowded hashes, string by string."""
    string = F.expr(f"substring(bytes, i + 1, {width})")
    strings = (
        contexts.select("id", "row", "low", "bytes", F.explode(F.sequence(F.lit(0), F.length("bytes") - width)).alias("i"))
        .select(F.sha2(string, 256).alias("s"), F.struct("id", "row", (F.col("low") + F.col("i")).alias("at")).alias("p"))
    )
    first = strings.groupBy("s").agg(F.min("p").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return strings.join(first, "s").where("p > first").select("p.row", F.col("p.at").alias("low"), F.col("p.at").alias("high"))


def _settled(found: DataFrame, width: int) -> DataFrame:
    """(row, low, high, first, h, large): of equal contexts all but the first; the firsts where contexts differ.

    One shuffle by the anchor's hash; contexts of a hash are in order, so equal ones are neighbours.
    ``large`` says that the firsts of the hash ``h`` hold too many bytes to be sorted together.
    """
    of_hash = Window.partitionBy("h")
    bytes_of_firsts = F.sum(F.when(F.col("first"), F.col("size").cast("long") + width + 1)).over(of_hash)
    ordered = Window.partitionBy("h").orderBy("c", "size", "id", "row", "low")
    same = F.col("c").eqNullSafe(F.lag("c").over(ordered)) & F.col("size").eqNullSafe(F.lag("size").over(ordered))
    return (
        found.withColumn("first", ~same)
        .withColumn("mixed", F.count_if("first").over(of_hash) > 1)
        .withColumn("large", bytes_of_firsts > SORT_BYTES)
        .where(~F.col("first") | F.col("mixed"))
        .select(
            "row", "low", (F.col("low") + F.col("size")).alias("high"), "first",
            F.when(F.col("first"), F.col("h")).alias("h"), (F.col("first") & F.col("large")).alias("large"),
        )
    )


def _settled_apart(found: DataFrame) -> DataFrame:
    """The same for crowded hashes: counts combined before the shuffle, and joins that Spark can split."""
    key = ["h", "c", "size"]
    firsts = stored(found.groupBy(*key).agg(F.min(F.struct("id", "row", "low")).alias("at")), "crowded-contexts")
    mixed = firsts.groupBy("h").agg((F.count(F.lit(1)) > 1).alias("mixed"))
    # whether a hash is mixed is told to its contexts, of which there are few; anchors never meet on a hash
    told = stored(firsts.join(mixed, "h"), "told-contexts")
    return (
        found.join(told, key)
        .withColumn("first", (F.col("row") == F.col("at.row")) & (F.col("low") == F.col("at.low")))
        .where(~F.col("first") | F.col("mixed"))
        .select("row", "low", (F.col("low") + F.col("size")).alias("high"), "first")
    )


def repeated_spans(docs: DataFrame, width: int) -> DataFrame:
    """(row, low, high): runs of starts of repeated strings in ``docs`` (row, id, data), a stored table."""
    spark = docs.sparkSession
    context = spark.sparkContext
    again = stored(_all_hashes(docs, width).groupBy("h").count().where("count > 1"), "repeated-hashes")
    words = context.broadcast(_filter_words(again, "h"))
    found = _contexts(docs, width, words)
    hot = again.where(F.col("count") > CROWDED).select("h")
    crowded = not hot.isEmpty()
    usual = stored(_settled(found.join(hot, "h", "left_anti") if crowded else found, width), "settled")
    spans = [usual]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)

    def to_compare(firsts: DataFrame) -> DataFrame:
        places = firsts.select(_identity_column().alias("me"))
        return _context_bytes(docs, width, context.broadcast(_filter_words(places, "me")))

    firsts, large = usual.where("first AND NOT large"), usual.where("large")
    counted, apart_hashes = [], []
    if not large.isEmpty():
        counted.append(large.select("row", "low"))
        apart_hashes.append(large.select("h").distinct())
    if crowded:
        apart = stored(_settled_apart(found.join(hot, "h", "left_semi")), "settled-apart")
        spans.append(apart)
        counted.append(apart.where("first").select("row", "low"))
        apart_hashes.append(hot)
    # the filter only saves work: hashes that are counted are taken out, and of the others only the places
    # themselves are sorted, each announced by a row without bytes
    contexts = to_compare(firsts)
    if counted:
        elsewhere = stored(reduce(DataFrame.unionByName, apart_hashes), "counted-hashes")
        contexts = contexts.join(elsewhere, "h", "left_anti")
        in_counted = to_compare(reduce(DataFrame.unionByName, counted)).join(elsewhere, "h", "left_semi")
    announced = firsts.select(
        "h", F.lit(None).cast("long").alias("id"), "row", "low", F.lit(None).cast("binary").alias("bytes")
    )
    in_order = ["h", "row", "low", F.col("bytes").isNotNull()]
    dealt = contexts.unionByName(announced).repartition(parts, "h").sortWithinPartitions(*in_order)
    compared = [_sorted_repeats(dealt, width)]
    if counted:
        compared.append(_counted_repeats(in_counted, width))
    copies = [x.where("NOT first").select("row", "low", "high") for x in spans]
    return stored(reduce(DataFrame.unionByName, [*copies, *compared]), "repeats")


def remove_repeats(
    df: DataFrame, id_col: str, text: str, width: int = WIDTH, kept: str | None = None
) -> DataFrame:
    """The columns of ``df`` but the text, with ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``.

    Texts are UTF-8 bytes, NULL is empty.  Documents are in the order of ``id_col``, NULL last, and in
    the order they are read where ids repeat.  With ``kept`` the remaining bytes are returned under
    that name.  A text shorter than ``width`` loses nothing; texts may be of any length.  Ids are whole
    numbers, and one that is not counts as NULL.  An empty table gives an empty result.  Columns called
    like a result, in upper or lower case, are replaced; all others keep name, order and value.
    """
    results = ["n_bytes", "n_removed", "n_spans", "kept_sha256"] + ([kept] if kept else [])
    carried = other_columns(df, text, *results)
    held = free_name(df, "_row_of_df")
    path = scratch_path(df.sparkSession, "documents")
    docs = stored(
        df.select(
            F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in carried]).alias(held),
            F.monotonically_increasing_id().alias("row"),
            F.coalesce(F.col(id_col).try_cast("long"), F.lit((1 << 63) - 1)).alias("id"),
            F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("data"),
        ),
        path=path,
    )
    runs = repeated_spans(docs.select("row", "id", "data"), width)
    removed = runs.groupBy("row").agg(F.collect_list(F.struct("low", "high")).alias("runs"))
    # documents that lose nothing and those that do are both taken through the same cut
    joined = docs.select(held, "row", "data").join(removed, "row", "left").select(held, "data", "runs")

    def run(batches):
        for batch in batches:
            out = []
            for data, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                gone = np.zeros(len(data) + 1, np.int64)
                for s in spans or ():
                    gone[s["low"]] += 1
                    gone[s["high"] + width] -= 1
                flags = np.cumsum(gone)[:-1] > 0
                rest = np.frombuffer(data, np.uint8)[~flags].tobytes() if spans else data
                n_spans = int(np.count_nonzero(np.diff(flags.astype(np.int8), prepend=0) == 1))
                out.append((len(data), len(data) - len(rest), n_spans, hashlib.sha256(rest).hexdigest(), rest))
            columns = list(zip(*out))
            arrays = [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())]
            if kept:
                arrays.append(pa.array(columns[4], pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, [held, *results])

    schema = joined.select(
        held, *[F.lit(0).cast("long").alias(c) for c in results[:3]], F.lit("").alias("kept_sha256"),
        *([F.lit(None).cast("binary").alias(kept)] if kept else []),
    ).schema
    cut = joined.mapInArrow(run, schema)
    return cut.select(*[F.col(f"{held}.`{c}`").alias(c) for c in carried], *results)
