"""Near-duplicate documents by SimHash and multi-index hashing.

A 64-bit fingerprint is cut into two halves.  If two fingerprints differ in at most ``2r + 1`` bits,
one half differs in at most ``r``.  So every distinct fingerprint is entered, per half, under each
value within one bit of that half (a ball of 33 values); two fingerprints whose halves differ in at
most two bits meet under a common value, and the distance of the whole is verified in the join.
With balls of one bit on both sides this finds all pairs up to five differing bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import connected_components, free_name
from marketloom.sources.scratch import discard, scratch_path, stored

MAX_DISTANCE = 5  # what one-bit balls on both sides can find
HOT_BUCKET = 256  # from this many fingerprints under one value on, no pairs are compared there
DENSE_ROWS = 512  # crowded fingerprints that one task enters under the values around them


def fingerprint(text: str | None, words: int) -> int:
    """Majority bits of the XXH64 hashes of all word shingles; 0 without a word."""
    tokens = (text or "").encode().lower().split()  # of bytes: A-Z only, ASCII white space only
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    ends = ends[min(words, len(tokens)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, ends)], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def with_fingerprint(
    df: DataFrame, text: str, words: int, into: str, keep_text: bool = False
) -> DataFrame:
    """All columns (the text only if asked for) and, as a signed long, the fingerprint of the whole text."""
    kept = [c for c in df.columns if keep_text or c != text]
    hidden = free_name(df, "_text")
    given = df.select(*kept, F.col(text).cast("string").alias(hidden))

    def run(batches):
        for batch in batches:
            marks = [fingerprint(t.as_py(), words) for t in batch.column(len(kept))]
            arrays = [batch.column(i) for i in range(len(kept))] + [pa.array(marks, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, [*kept, into])

    schema = given.drop(hidden).withColumn(into, F.lit(0).cast("long")).schema
    return given.mapInArrow(run, schema)


def _balls(prints: DataFrame) -> DataFrame:
    """(half, key, fp): every fingerprint under the 33 values around each of its halves."""
    halves = F.array(
        F.struct(F.lit(0).alias("half"), F.shiftrightunsigned("fp", 32).alias("own")),
        F.struct(F.lit(1).alias("half"), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)).alias("own")),
    )
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i).cast("long") for i in range(32)])
    return (
        prints.select("fp", F.explode(halves).alias("h"))
        .select("fp", "h.half", "h.own", F.explode(flips).alias("flip"))
        .select("half", F.col("own").bitwiseXOR(F.col("flip")).alias("key"), "fp")
    )


def _links(met: DataFrame, distance: int) -> DataFrame:
    """Pairs under a common value, each once, verified on all 64 bits.

    Halves that differ in d bits share 33 values (d = 0) or two (d = 1, 2).  A pair counts under
    the smallest of the two, or under the common half itself, and for the second half only if the
    first one differs in more than two bits.
    """
    a = met.select("half", "key", F.col("fp").alias("a"))
    b = met.select("half", "key", F.col("fp").alias("b"))

    def half_of(x):
        return f"if(a.half = 0, shiftrightunsigned({x}, 32), {x} & 4294967295)"

    apart = f"({half_of('a.a')} ^ {half_of('b.b')})"
    low = f"({apart} & -{apart})"
    meeting = f"""CASE bit_count({apart}) WHEN 0 THEN {half_of('a.a')}
        WHEN 1 THEN least({half_of('a.a')}, {half_of('b.b')})
        ELSE least({half_of('a.a')} ^ {low}, {half_of('b.b')} ^ {low}) END"""
    verified = f"""a.half = b.half AND a.key = b.key AND a.a < b.b AND bit_count(a.a ^ b.b) <= {distance}
        AND (a.half = 0 OR bit_count(shiftrightunsigned(a.a ^ b.b, 32)) > 2) AND a.key = {meeting}"""
    # on disk, where values are sorted and fingerprints recur, rows are far smaller than in memory
    return a.alias("a").join(b.alias("b").hint("merge"), F.expr(verified)).select("a.a", "b.b")


def _stars(dense: DataFrame, distance: int) -> DataFrame:
    """Links among fingerprints of crowded values, without comparing pairs.

    Each is entered under all 64-bit values within half the distance, rounded up.  The smallest of
    those within half the distance, rounded down, is the centre of a value; whoever meets it there
    is within the distance of it, and every link has a value where both ends meet the centre.  Rows
    grow with the fingerprints, not with their pairs: 2,081 of each for a distance of 3 or 4.  Spark
    takes them for one or two, so it is told to deal out the fingerprints and to merge, not to broadcast.
    """
    dense = dense.repartition(-(-dense.count() // DENSE_ROWS))
    flips = F.array(*[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)])
    near = dense.select("fp", F.col("fp").alias("spot"), F.lit(-1).alias("last"), F.lit(0).alias("far"))
    found = near
    for radius in range(1, distance - distance // 2 + 1):
        near = (
            near.select("fp", "spot", "last", F.posexplode(flips).alias("i", "flip"))
            .where("i > last")
            .select(
                "fp", F.col("spot").bitwiseXOR(F.col("flip")).alias("spot"), F.col("i").alias("last"),
                F.lit(radius).alias("far"),
            )
        )
        found = found.unionByName(near)
    inner = F.when(F.col("far") <= distance // 2, F.col("fp"))
    centres = found.groupBy("spot").agg(F.min(inner).alias("b"), F.count(F.lit(1)).alias("n"))
    centres = centres.where("n > 1").hint("merge")
    return found.join(centres, "spot").select(F.col("fp").alias("a"), "b").where("a <> b")


def simhash_links(prints: DataFrame, distance: int) -> DataFrame:
    """(a, b) between distinct fingerprints (column ``fp``) whose components are those of all links."""
    if not 0 <= distance <= MAX_DISTANCE:
        raise ValueError(f"distance must be 0 to {MAX_DISTANCE}")
    spark = prints.sparkSession
    balls = _balls(prints)
    # counted before the shuffle; a join can split a value that very many fingerprints share, a window cannot.
    # It is a merge join: from the size of the fingerprints Spark cannot tell that there are 66 rows of each
    shared = balls.groupBy("half", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = stored(balls.join(shared.hint("merge"), ["half", "key"]), "met")
    crowded = met.where(F.col("n") > HOT_BUCKET)
    links = _links(met.where(F.col("n") <= HOT_BUCKET), distance)
    if not crowded.isEmpty():
        links = links.unionByName(_stars(stored(crowded.select("fp").distinct(), "dense"), distance))
    return links


def _components(prints: DataFrame, distance: int) -> DataFrame:
    """(fp, root) of all distinct fingerprints."""
    roots = connected_components(simhash_links(prints.select("fp"), distance), "a", "b")
    return prints.join(roots, F.col("fp") == F.col("node"), "left").select(
        *prints.columns, F.coalesce("root", "fp").alias("root")
    )


def simhash_components(
    df: DataFrame, id_col: str, text: str, words: int = 5, distance: int = 4
) -> DataFrame:
    """All columns of ``df`` but the text, with ``fingerprint`` and ``component_id``.

    ``component_id`` is the smallest id that can be reached over links, the row's own included.
    Equal fingerprints are merged before any comparison, so a group of copies of any size counts
    once.  Rows without text or words have fingerprint zero and are linked like any other.  A NULL id
    is never the smallest unless the whole component has none; repeated rows are all returned, and an
    empty table gives an empty result.  Texts may be of any length.  A column of ``df`` that is called
    like a result, in upper or lower case, is replaced; all others keep name, order and value.
    """
    results = ("fingerprint", "component_id")
    base = df.drop(*[c for c in df.columns if c.lower() in results and c not in (id_col, text)])
    marked = stored(with_fingerprint(base, text, words, "fingerprint"), "fingerprints")
    prints = marked.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(id_col).alias("least_id"))
    prints = stored(prints, "prints")
    rooted = _components(prints, distance)
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    own = free_name(marked, "_fp")
    labels = stored(rooted.join(least, "root").select(F.col("fp").alias(own), "component_id"), "labels")
    return marked.join(labels, F.col("fingerprint") == F.col(own), "left").drop(own)


def keep_one_per_component(
    df: DataFrame, id_col: str, text: str, words: int = 5, distance: int = 4
) -> DataFrame:
    """The rows of ``df`` that come first in their component: smallest id (NULL last), then first read.

    Exactly one row stays of each component, also where ids or whole rows repeat.
    """
    mark, row = free_name(df, "_fingerprint"), free_name(df, "_row")
    marked = with_fingerprint(df, text, words, mark, keep_text=True)
    marked = stored(marked.withColumn(row, F.monotonically_increasing_id()), "marked")
    first = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(row).alias("row"))
    prints = stored(marked.groupBy(F.col(mark).alias("fp")).agg(F.min(first).alias("first")), "prints")
    kept = _components(prints, distance).groupBy("root").agg(F.min("first").alias("first"))
    kept = stored(kept.select(F.col("first.row").alias(row)), "kept")
    # texts are never joined by broadcast: on disk, row numbers are far smaller than in memory
    return marked.join(kept.hint("merge"), row, "left_semi").select(*df.columns)
