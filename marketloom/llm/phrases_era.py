"""Collocations from depth-truncated suffix subtrees, partitioned by word prefix.

Counting every phrase of up to four words is reading a suffix tree of the corpus that is cut off at
depth four.  The tree is too large for one machine, so it is partitioned vertically: word prefixes
are grouped until a group holds about as many suffixes as the memory budget allows; a prefix that is
over the budget alone is extended by its next word, again and again, and its extensions are grouped
instead.  Each group's subtree is then built by one task, without the others: its suffixes are sorted,
equal ones are leaves with a total, and a node's count is the sum of the leaves below it.

Equal suffixes are added up before the shuffle, and a suffix ends where a word is too rare to be in
any counted phrase.  Words travel as numbers of a dictionary of bounded size; words beyond it are
spelled out beside the suffixes that hold them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketloom.llm.tokens import Words, byte_table, slices, words_of
from marketloom.sources.scratch import stored

# What ends a piece, and what parts words inside one.
BREAKS = byte_table(".,;:!?\n\v\f\r")
SEPARATORS = byte_table(" \t")
NO_LANG = "und"
DEPTH = 4

BUDGET = 1 << 19  # suffixes of a group, at most twice as many
DICTIONARY_WORDS = 1 << 20  # the most frequent words, sent to every task as numbers
DICTIONARY_BYTES = 64  # longer words are spelled out
FLUSH_WORDS = 500_000  # words whose suffixes are sorted together before the shuffle
_BITS = 21  # of a word's number in a key


@dataclass
class Split:
    """Prefixes over the budget: their keys in order, and for each the first of its groups and how many."""

    keys: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    first: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    parts: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are split, and their places."""
        if not len(self.keys):
            return np.zeros(len(key), bool), np.zeros(len(key), np.int64)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return self.keys[at] == key, at


@dataclass
class Partition:
    """The dictionary and the groups, as they are sent to every task.

    Numbers of words start at 1 and run by language; 0 ends a suffix.  ``group[w]`` is the group of
    the suffixes that start with ``w``, unless ``w`` is split.  ``splits[d]`` holds the split prefixes
    of d + 1 words; groups from ``levels[d]`` on hold suffixes whose first d + 1 words are split, so
    that only longer nodes are whole in them.
    """

    words: pa.Array
    first_of: dict[str, int]
    langs: list[str]
    group: np.ndarray
    rest_groups: tuple[int, int]
    complete: bool
    splits: list[Split] = field(default_factory=list)
    levels: list[int] = field(default_factory=list)
    groups: int = 0

    def __post_init__(self):
        bounds = [*self.first_of.values(), len(self.words) + 1]
        self.values = {lang: self.words[a - 1 : b - 1] for (lang, a), b in zip(self.first_of.items(), bounds[1:])}

    def split(self, keys: np.ndarray, totals: np.ndarray, budget: int) -> None:
        """Extend these prefixes: their suffixes are dealt by the next word over enough groups."""
        order = np.argsort(keys)
        parts = -(-totals[order] // budget)
        starts = self.groups + np.cumsum(parts) - parts
        self.levels.append(self.groups)
        self.splits.append(Split(keys[order], starts, parts))
        self.groups += int(parts.sum())

    def depth_of(self, group: int) -> int:
        """From how many words on nodes are whole in a group."""
        return 1 + max(1, sum(group >= level for level in self.levels))


@dataclass
class _Read:
    """Numbers of words in order, and the words beyond the dictionary that got numbers above it."""

    ids: np.ndarray
    follows: np.ndarray
    extra: list[tuple[str, bytes]]


def _numbers(part: pa.RecordBatch, found: Words, given: Partition, extra: list[tuple[str, bytes]]) -> np.ndarray:
    ids = np.zeros(len(found.words), np.int64)
    langs = part.column("lang").to_pylist()
    codes = {lang: i for i, lang in enumerate(dict.fromkeys(langs))}
    of_word = np.array([codes[lang] for lang in langs], np.int64)[found.text]
    for lang, code in codes.items():
        here = np.flatnonzero(of_word == code)
        words = found.words.take(pa.array(here)) if len(codes) > 1 else found.words
        if lang in given.values:
            at = pc.fill_null(pc.index_in(words, value_set=given.values[lang]), -1).to_numpy().astype(np.int64)
            ids[here] = np.where(at >= 0, at + given.first_of[lang], 0)
        if not given.complete:
            missing = np.flatnonzero(ids[here] == 0)
            spelled = words.take(pa.array(missing)).dictionary_encode()
            ids[here[missing]] = len(given.words) + 1 + len(extra) + spelled.indices.to_numpy()
            extra += [(lang, word) for word in spelled.dictionary.to_pylist()]
    return ids


def _reads(batches: Iterator[pa.RecordBatch], given: Partition) -> Iterator[_Read]:
    """The words of whole texts as numbers, about FLUSH_WORDS at a time."""
    ids: list[np.ndarray] = []
    follows: list[np.ndarray] = []
    extra: list[tuple[str, bytes]] = []
    for batch in batches:
        for part in slices(batch, "text"):
            found = words_of(part.column("text"), SEPARATORS, BREAKS)
            ids.append(_numbers(part, found, given, extra))
            follows.append(found.follows)
            if sum(map(len, ids)) >= FLUSH_WORDS:
                yield _Read(np.concatenate(ids), np.concatenate(follows), extra)
                ids, follows, extra = [], [], []
    if ids:
        yield _Read(np.concatenate(ids), np.concatenate(follows), extra)


def _suffixes(read: _Read) -> np.ndarray:
    """The first DEPTH words from every word on, as rows of numbers; those of one word only are left out."""
    n = len(read.ids)
    out = np.zeros((DEPTH, n), np.int64)
    out[0], open_ = read.ids, read.ids > 0
    for d in range(1, min(DEPTH, n)):
        after = read.ids[d:]
        open_[: n - d] &= read.follows[d:] & (after > 0)
        open_[n - d :] = False
        out[d, : n - d] = np.where(open_[: n - d], after, 0)
    return out[:, out[1] > 0]


def _key(words: np.ndarray, count: int) -> np.ndarray:
    """The first words as one number; only for words of the dictionary."""
    key = words[0]
    for d in range(1, count):
        key = key << _BITS | words[d]
    return key


def _in_dictionary(words: np.ndarray, count: int, given: Partition) -> np.ndarray:
    return ((words[:count] > 0) & (words[:count] <= len(given.words))).all(axis=0)


def _hashes(read: _Read, given: Partition) -> np.ndarray:
    """A number per word that is the same in every task."""
    own = (np.arange(len(given.words) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(34)
    spelled = np.array([xxhash.xxh64_intdigest(word) >> 34 for _, word in read.extra], np.uint64)
    return np.concatenate([own, spelled]).astype(np.int64)


def _route(suffixes: np.ndarray, read: _Read, given: Partition) -> np.ndarray:
    """The group of every suffix."""
    n, hashed = len(given.words), _hashes(read, given)
    first, spelled = suffixes[0], suffixes[0] > n
    start, count = given.rest_groups
    group = np.where(spelled, start + hashed[first] % max(count, 1), given.group[np.minimum(first, n)])
    for depth, split in enumerate(given.splits, 1):
        whole = np.flatnonzero(_in_dictionary(suffixes, depth, given))
        hot, at = split.find(_key(suffixes[:, whole], depth))
        whole, at = whole[hot], at[hot]
        group[whole] = split.first[at] + hashed[suffixes[depth, whole]] % split.parts[at]
    return group


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before in any key."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def _sorted_leaves(suffixes: np.ndarray, counts: np.ndarray, group: np.ndarray | None = None):
    """Equal suffixes (of a group) as one leaf each, in order, with their totals."""
    low, high = suffixes[2] << 32 | suffixes[3], suffixes[0] << 32 | suffixes[1]
    keys = (low, high) if group is None else (low, high, group)
    order = np.lexsort(keys)
    starts = _runs(*(k[order] for k in keys))
    leaves = order[starts]
    totals = np.add.reduceat(counts[order], starts) if len(starts) else counts[:0]
    return suffixes[:, leaves], totals, None if group is None else group[leaves]


def _pack(leaves: np.ndarray, totals: np.ndarray, extra: list[tuple[str, bytes]], n: int) -> dict:
    """Leaves of one group as bytes, with the words beyond the dictionary that they hold."""
    used = np.unique(leaves[leaves > n])
    if len(used):
        leaves = np.where(leaves > n, n + 1 + np.searchsorted(used, leaves), leaves)
    planes = np.vstack([leaves, totals[None, :]]).astype("<i4")
    spelled = [extra[i - n - 1] for i in used]
    return {
        "leaves": zstandard.ZstdCompressor(level=1).compress(planes.tobytes()),
        "extra_lang": [lang for lang, _ in spelled],
        "extra_word": [word for _, word in spelled],
    }


_LEAVES = pa.schema(
    [("group", pa.int64()), ("leaves", pa.binary()), ("extra_lang", pa.list_(pa.string())), ("extra_word", pa.list_(pa.binary()))]
)


def _grouped_leaves(docs: DataFrame, partition) -> DataFrame:
    """(group, leaves, ...): the leaves of each task and group, in few large rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: Partition = partition.value
        for read in _reads(batches, given):
            suffixes = _suffixes(read)
            leaves, totals, group = _sorted_leaves(
                suffixes, np.ones(suffixes.shape[1], np.int64), _route(suffixes, read, given)
            )
            starts = _runs(group) if len(group) else []
            for begin, end in zip(starts, [*starts[1:], len(group)]):
                packed = _pack(leaves[:, begin:end], totals[begin:end], read.extra, len(given.words))
                yield pa.RecordBatch.from_pylist([{"group": int(group[begin]), **packed}], _LEAVES)

    schema = "group long, leaves binary, extra_lang array<string>, extra_word array<binary>"
    return docs.mapInArrow(run, schema)


def _unpack(table: pa.Table, n: int) -> tuple[np.ndarray, np.ndarray, list[tuple[str, bytes]]]:
    """All leaves of a group with one numbering of the words beyond the dictionary."""
    planes, extra = [], {}
    for row in table.select(["leaves", "extra_lang", "extra_word"]).to_pylist():
        part = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["leaves"]), "<i4").reshape(DEPTH + 1, -1)
        if row["extra_word"]:
            spelled = zip(row["extra_lang"], row["extra_word"])
            numbers = np.array([extra.setdefault(word, n + 1 + len(extra)) for word in spelled])
            words = part[:DEPTH]
            part = np.vstack([np.where(words > n, numbers[np.maximum(words - n - 1, 0)], words), part[DEPTH:]])
        planes.append(part)
    joined = np.concatenate(planes, axis=1).astype(np.int64)
    return joined[:DEPTH], joined[DEPTH], list(extra)


def _spell(ids: np.ndarray, given: Partition, extra: list[tuple[str, bytes]]) -> pa.Array:
    n, used = len(given.words), np.unique(ids)
    own = given.words.take(pa.array(used[used <= n] - 1))
    spelled = pa.array([extra[i - n - 1][1] for i in used[used > n]], pa.large_binary())
    return pa.concat_arrays([own, spelled]).take(pa.array(np.searchsorted(used, ids)))


def _langs_of(ids: np.ndarray, given: Partition, extra: list[tuple[str, bytes]]) -> list[str]:
    starts, n = np.array(list(given.first_of.values()) or [1]), len(given.words)
    at = np.searchsorted(starts, ids, side="right") - 1
    return [given.langs[a] if i <= n else extra[i - n - 1][0] for i, a in zip(ids.tolist(), at.tolist())]


def _subtree(partition, least: int):
    """Nodes of a group's subtree that are counted often enough."""
    names = ["lang", "phrase", "k", "f"]

    def run(key: tuple, table: pa.Table) -> pa.Table:
        given: Partition = partition.value
        words, counts, extra = _unpack(table, len(given.words))
        leaves, totals, _ = _sorted_leaves(words, counts)
        tables = []
        for k in range(given.depth_of(key[0].as_py()), DEPTH + 1):
            deep = leaves[k - 1] > 0
            inner, below = leaves[:k, deep], totals[deep]
            if not len(below):
                continue
            starts = _runs(*inner)
            f = np.add.reduceat(below, starts)
            often = f >= least
            node = inner[:, starts[often]]
            phrase = pc.binary_join_element_wise(*[_spell(w, given, extra) for w in node], pa.scalar(b" ", pa.large_binary()))
            columns = [
                pa.array(_langs_of(node[0], given, extra), pa.string()), phrase.cast(pa.binary()),
                pa.array(np.full(len(phrase), k), pa.int32()), pa.array(f[often], pa.int64()),
            ]
            tables.append(pa.Table.from_arrays(columns, names))
        empty = pa.table({"lang": pa.array([], pa.string()), "phrase": pa.array([], pa.binary()), "k": pa.array([], pa.int32()), "f": pa.array([], pa.int64())})
        return pa.concat_tables([empty, *tables])

    return run


def _prefix_counts(docs: DataFrame, partition, depth: int) -> DataFrame:
    """(key, f): prefixes of ``depth`` words that may be over the budget.

    No phrase occurs more often than its parts, so all but the first and all but the last word must be
    over the budget; few pairs are, however many words follow a frequent one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: Partition = partition.value
        for read in _reads(batches, given):
            suffixes = _suffixes(read)
            suffixes = suffixes[:, _in_dictionary(suffixes, depth, given)]
            split = given.splits[depth - 2]
            hot = split.find(_key(suffixes, depth - 1))[0] & split.find(_key(suffixes[1:], depth - 1))[0]
            keys, counts = np.unique(_key(suffixes[:, hot], depth), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(counts, pa.int64())], ["key", "f"])

    return docs.mapInArrow(run, "key long, f long").groupBy("key").agg(F.sum("f").alias("f"))


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, f) for all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = words_of(part.column("text"), SEPARATORS, BREAKS)
                lang = part.column("lang").dictionary_encode()
                of_word = lang.indices.to_numpy()[found.text]
                for code, name in enumerate(lang.dictionary.to_pylist()):
                    here = found.words.take(pa.array(np.flatnonzero(of_word == code)))
                    counts = here.value_counts()
                    columns = [pa.array([name] * len(counts), pa.string()), counts.field("values").cast(pa.binary()), counts.field("counts")]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "f"])

    return docs.mapInArrow(run, "lang string, word binary, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))


def _dictionary(words: DataFrame, least: int, budget: int) -> Partition:
    """The most frequent words with their groups; words over the budget are the first to be split."""
    often = words.where(F.col("f") >= least)
    short = often.where(F.octet_length("word") <= DICTIONARY_BYTES)
    top = short.orderBy(F.col("f").desc(), "lang", "word").limit(DICTIONARY_WORDS).toArrow()
    all_often = often.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("f"), F.lit(0)).alias("f")).first()
    top = top.sort_by([("lang", "ascending"), ("f", "descending"), ("word", "ascending")])
    f, langs = top.column("f").to_numpy(), top.column("lang").to_pylist()
    first_of = {}
    for i, lang in enumerate(langs, 1):
        first_of.setdefault(lang, i)
    hot = f > budget
    own = np.where(hot, 0, f)
    group = np.concatenate([[0], (np.cumsum(own) - own) // budget]).astype(np.int64)
    groups = int(group[-1]) + 1
    complete = all_often.n == len(f)
    rest = 0 if complete else max(1, -(-int(all_often.f - f.sum()) // budget))
    given = Partition(
        words=pa.array(top.column("word").to_pylist(), pa.large_binary()),
        first_of=first_of, langs=list(first_of), group=group,
        rest_groups=(groups, rest), complete=complete, groups=groups + rest,
    )
    given.split(np.flatnonzero(hot) + 1, f[hot], budget)
    return given


def _node_rows(spark: SparkSession, keys: np.ndarray, f: np.ndarray, depth: int, given: Partition) -> DataFrame:
    """Split prefixes as nodes: their subtrees lie in several groups, but their counts are known."""
    words = [keys >> (_BITS * (depth - 1 - d)) & ((1 << _BITS) - 1) for d in range(depth)]
    phrase = pc.binary_join_element_wise(*[_spell(w, given, []) for w in words], pa.scalar(b" ", pa.large_binary()))
    columns = {
        "lang": pa.array(_langs_of(words[0], given, []), pa.string()), "phrase": phrase.cast(pa.binary()),
        "k": pa.array(np.full(len(keys), depth), pa.int32()), "f": pa.array(f, pa.int64()),
    }
    return spark.createDataFrame(pa.table(columns))


def phrase_counts(docs: DataFrame, words: DataFrame, least: int, budget: int = BUDGET) -> DataFrame:
    """(lang, phrase, k, f): every phrase of 1 to 4 words that occurs ``least`` times or more.

    ``docs`` has ``lang`` and ``text`` (binary); ``words`` are its ``word_counts``.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast
    given = _dictionary(words, least, budget)
    single = words.where(F.col("f") >= least).select("lang", F.col("word").alias("phrase"), F.lit(1).alias("k"), "f")
    nodes = [single]
    for depth in range(2, DEPTH):
        if not len(given.splits[-1].keys):
            break
        # prefixes over the budget: at most the number of words divided by it
        hot = _prefix_counts(docs, sent(given), depth).where(F.col("f") > budget).toArrow()
        keys, f = hot.column("key").to_numpy(), hot.column("f").to_numpy()
        given.split(keys, f, budget)
        if len(keys):
            nodes.append(_node_rows(spark, keys, f, depth, given).where(F.col("f") >= least))
    partition = sent(given)
    leaves = _grouped_leaves(docs, partition)
    nodes.append(leaves.groupBy("group").applyInArrow(_subtree(partition, least), "lang string, phrase binary, k int, f long"))
    out = nodes[0]
    for more in nodes[1:]:
        out = out.unionAll(more)
    return out.withColumn("phrase", F.col("phrase").cast("string"))


def _part(begin: Column, count: Column) -> Column:
    """So many words of the phrase, from a place on."""
    return F.array_join(F.slice("words", begin, count), " ")


def collocations(
    docs: DataFrame, text: str, lang: str, least: int = 30, top: int = 2000, scale: int = 2_000_000,
    contained: tuple[int, int] = (80, 100), budget: int = BUDGET,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of 2 to 4 words of each language.

    ``a`` occurrences of the phrase, at least ``least``; ``l`` and ``r`` those of its two parts at the
    cut with the lowest floor(scale * a / (l + r)), the first such cut; ``n`` words of the language.
    A phrase inside a longer one that has ``contained`` (80 of 100) of its occurrences or more is
    dropped.  All arithmetic is exact.

    Texts are read whole, A-Z lower-cased; NULL is empty.  A NULL language is ``und``, together with
    that name.  Ties are ranked by occurrences and then by the bytes of the phrase.  Repeated rows
    count each.  A table without phrases that occur often enough gives no rows.  Other columns, of any
    name, are neither read nor returned.
    """
    given = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(text).cast("binary").alias("text")
    )
    words = stored(word_counts(given), "words")
    nodes = stored(phrase_counts(given, words, least, budget), "phrases")
    longer = nodes.where(F.col("k") >= 2).withColumn("words", F.split("phrase", " ", -1))

    cuts = longer.select("lang", "phrase", "k", "f", "words", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select(
        "lang", "phrase", "f", "cut",
        _part(F.lit(1), F.col("cut")).alias("first"), _part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"),
    )
    count = lambda part, name: nodes.select("lang", F.col("phrase").alias(part), F.col("f").alias(name))
    whole = lambda name: f"cast({name} AS decimal(19,0))"
    score = F.expr(f"cast({scale} AS decimal(19,0)) * {whole('f')} div ({whole('l')} + {whole('r')})")
    scored = (
        cuts.join(count("first", "l"), ["lang", "first"])
        .join(count("rest", "r"), ["lang", "rest"])
        .groupBy("lang", "phrase", F.col("f").alias("a"))
        .agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("worst"))
    )

    inside = longer.where(F.col("k") >= 3).select(
        "lang", "f", "words", F.explode(F.expr("flatten(transform(sequence(2, k - 1), s -> transform(sequence(1, k - s + 1), b -> struct(b, s))))")).alias("at")
    )
    holders = (
        inside.select("lang", _part(F.col("at.b"), F.col("at.s")).alias("phrase"), "f")
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("most"))
    )
    share, of = contained
    held = F.expr(f"cast({of} AS decimal(10,0)) * {whole('most')} >= cast({share} AS decimal(10,0)) * {whole('a')}")
    kept = scored.join(holders, ["lang", "phrase"], "left").where(~F.coalesce(held, F.lit(False)))

    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return (
        kept.select("lang", "phrase", "a", "worst.l", "worst.r", "worst.score")
        .withColumn("rank", F.row_number().over(best).cast("long"))
        .where(F.col("rank") <= top)
        .join(sizes, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
