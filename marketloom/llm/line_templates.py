"""Dropping lines that follow a template which recurs across documents.

Lines go down a tree of fixed depth: the number of tokens first, then the leading tokens, with tokens
that hold a digit or an at sign taken as variable fields.  In a leaf where lines differ, the token of
each place stays in the template if most lines of the leaf have it, and becomes a variable field
otherwise.  A line belongs to the template of its leaf if it has all its fixed tokens; else it is a
template of its own.  A template that enough different documents hold, in different surroundings, is
boilerplate, and its lines are dropped.  Copies of a document do not make its lines boilerplate: equal
texts count once, and a line that mostly comes after the same line, or mostly before the same line, is
part of a longer passage.  Such a passage is boilerplate itself if what stands before and after the
whole run of frequent lines varies, over documents that consist of other lines by half or more.
Blank lines are skipped when neighbours are looked at.  A long line is such a passage from two
documents on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.common import free_name
from marketloom.sources.scratch import discard, scratch_path, stored

LEADING = 3  # tokens below the token count in the tree
MIN_TOKENS = 3  # shorter lines have a template if they hold a token that is no variable field
MIN_DOCUMENTS = 10
LONG_TOKENS = 20  # tokens from which on a line is long
LONG_DOCUMENTS = 2  # documents from which on a long line recurs
MIN_SURROUNDINGS = 0.5  # different lines before, and after, per document that holds the line
FIXED_SHARE = 0.6  # of the places of a template that must be fixed
FILTER_BUCKETS = 1 << 18  # rows of the broadcast filter at most, whatever the corpus
VARIABLE = "<*>"


def _spaced(line: Column) -> Column:
    """A line with single spaces."""
    odd = F.rlike(line, F.lit(r"[\t\r\x0B\f]|  "))
    return F.trim(F.when(odd, F.regexp_replace(line, r"[ \t\r\x0B\f]+", " ")).otherwise(line))


def _variables_masked(spaced: Column) -> Column:
    """Single-spaced tokens with the variable ones replaced; their number stays."""
    return F.when(
        F.rlike(spaced, F.lit("[0-9@]")), F.regexp_replace(spaced, r"(?<![^ ])[^ 0-9@]*+[0-9@][^ ]*+", VARIABLE)
    ).otherwise(spaced)


def _tokens(masked: Column) -> Column:
    return F.length(masked) - F.length(F.replace(masked, F.lit(" "), F.lit(""))) + 1


def _has_template(masked: Column, tokens: Column) -> Column:
    return (tokens >= MIN_TOKENS) | ~masked.isin("", VARIABLE, f"{VARIABLE} {VARIABLE}")


def _leaf(masked: Column, tokens: Column) -> Column:
    return F.xxhash64(tokens, F.substring_index(masked, " ", LEADING))


def _lines(rows: DataFrame) -> DataFrame:
    """(row, line, k, n, document, long, mask, leaf, before, after, masked, tokens) of lines that have a template.

    ``k`` is the place among the ``n`` lines that are not blank.  The neighbours of a line are the next
    of these, masked too; the end of a document counts as one that no other has.  Each step over the
    lines is a transformation of its own, so that what it makes is made once.
    """
    masked = F.transform(F.transform(F.split("t", "\n"), _spaced), _variables_masked)
    placed = F.transform(masked, lambda m, i: F.struct(m.alias("masked"), _tokens(m).alias("tokens"), i.alias("line")))
    return (
        rows.where("t IS NOT NULL")
        .select("row", F.xxhash64("t").alias("document"), placed.alias("m"))
        .withColumn("m", F.filter("m", lambda m: m["masked"] != ""))
        .withColumn("h", F.transform("m", lambda m: F.xxhash64(m["masked"])))
        .select("row", "document", "h", F.size("m").alias("n"), F.posexplode("m").alias("k", "m"))
        .select("row", "document", "h", "n", "k", "m.line", "m.masked", "m.tokens")
        .where(_has_template(F.col("masked"), F.col("tokens")))
        .select(
            "row", "line", "k", "n", "document", (F.col("tokens") >= LONG_TOKENS).alias("long"),
            F.get("h", F.col("k")).alias("mask"), _leaf(F.col("masked"), F.col("tokens")).alias("leaf"),
            F.coalesce(F.get("h", F.col("k") - 1), "document").alias("before"),
            F.coalesce(F.get("h", F.col("k") + 1), "document").alias("after"),
            "masked", "tokens",
        )
    )


def _leaf_members(lines: DataFrame, min_documents: int) -> DataFrame:
    """(mask, template): the lines that follow the generalised template of their leaf."""
    mixed = stored(
        lines.groupBy("leaf")
        .agg(F.count(F.lit(1)).alias("n"), F.min("mask").alias("low"), F.max("mask").alias("high"))
        .where((F.col("n") >= min_documents) & (F.col("low") != F.col("high")))
        .select("leaf", "n"),
        "mixed-leaves",
    )
    bucket = F.pmod(F.col("leaf"), F.lit(FILTER_BUCKETS))
    near = mixed.select(bucket.alias("bucket")).distinct()
    texts = (
        lines.where(F.col("tokens") >= MIN_TOKENS)
        .select("leaf", "masked", bucket.alias("bucket"))
        .join(F.broadcast(near), "bucket", "left_semi")
        .groupBy("leaf", "masked")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(mixed.select("leaf"), "leaf")
    )
    texts = stored(texts, "leaf-texts")
    places = texts.select("leaf", "n", F.posexplode(F.split("masked", " ")).alias("place", "token"))
    counted = places.groupBy("leaf", "place", "token").agg(F.sum("n").alias("n"))
    fixed = counted.groupBy("leaf", "place").agg(
        F.max(F.struct("n", "token")).alias("top"), F.sum("n").alias("all")
    )
    is_fixed = (2 * F.col("top.n") > F.col("all")) & (F.col("top.token") != VARIABLE)
    templates = (
        fixed.withColumn("token", F.when(is_fixed, F.col("top.token")))
        .groupBy("leaf")
        .agg(
            F.array_sort(F.collect_list(F.struct("place", "token"))).alias("template"),
            F.count("token").alias("fixed"), F.count(F.lit(1)).alias("places"),
        )
        .where(F.col("fixed") >= FIXED_SHARE * F.col("places"))
        .select("leaf", F.transform("template", lambda p: p["token"]).alias("template"))
    )
    follows = F.forall(
        F.zip_with("template", F.split("masked", " "), lambda want, have: want.isNull() | (want == have)), lambda ok: ok
    )
    return (
        texts.join(templates, "leaf")
        .where(follows)
        .select(F.xxhash64("masked").alias("mask"), F.xxhash64(F.lit("template"), "leaf").alias("template"))
    )


def _in_runs(frequent: DataFrame) -> DataFrame:
    """``frequent`` with what stands before and after the run of its lines; NULL where too little else does."""
    of_row = Window.partitionBy("row")
    runs = frequent.withColumn("run", F.col("k") - F.row_number().over(of_row.orderBy("k")))
    of_run = Window.partitionBy("row", "run")
    other = 2 * F.count(F.lit(1)).over(of_row) <= F.col("n")
    return runs.select(
        "template", "long", "document", "before", "after",
        F.when(other, F.min_by("before", "k").over(of_run)).alias("run_before"),
        F.when(other, F.max_by("after", "k").over(of_run)).alias("run_after"),
    )


def drop_template_lines(
    df: DataFrame, text: str, min_documents: int = MIN_DOCUMENTS, lines_col: str = "n_lines", dropped_col: str = "n_dropped"
) -> DataFrame:
    """``df`` without the lines of recurring templates, with the number of lines before and of lines dropped.

    The other lines keep their order and wording.  A document that loses all its lines has an empty
    text; a NULL text stays NULL, with no lines.  Repeated rows are treated alike, and an empty table
    gives an empty result.  Columns of ``df`` that are called like a result, in upper or lower case,
    are replaced.  Lines, and templates of leaves, are told apart by 64-bit hashes.
    """
    replaced = (lines_col.lower(), dropped_col.lower())
    names = [c for c in df.columns if c.lower() not in replaced or c == text]
    held = free_name(df, "_row_of_df")
    rows = stored(
        df.select(
            F.struct(*[F.col(f"`{c}`") for c in names if c != text]).alias(held) if len(names) > 1 else F.lit(0).alias(held),
            F.col(f"`{text}`").cast("string").alias("t"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "documents",
    )
    # lines are masked once; their masked texts are kept only until the leaves are known
    path = scratch_path(df.sparkSession, "masked-lines")
    masked = stored(_lines(rows), path=path)
    members = stored(_leaf_members(masked, min_documents), "members")
    lines = stored(masked.drop("masked", "tokens"), "lines")
    discard(df.sparkSession, path)
    marked = lines.drop("leaf").join(members, "mask", "left")
    marked = marked.withColumn("template", F.coalesce("template", "mask")).drop("mask")
    least = F.when(F.col("long"), F.least(F.lit(min_documents), F.lit(LONG_DOCUMENTS))).otherwise(F.lit(min_documents))
    # the lines of a template have one number of tokens
    often = marked.groupBy("template", "long").count().where(F.col("count") >= least).select("template")
    # most templates have one line, so the finer counts are made on what is left
    frequent = stored(marked.join(often, "template", "left_semi"), "frequent-lines")
    varied = lambda documents, surroundings, least: (F.col(documents) >= least) & (
        F.col(surroundings) >= F.greatest(least, MIN_SURROUNDINGS * F.col(documents))
    )
    recurring = (
        _in_runs(frequent)
        .groupBy("template", "long", "document")
        .agg(*[F.min(c).alias(c) for c in ("before", "after", "run_before", "run_after")])
        .groupBy("template", "long")
        .agg(
            F.count(F.lit(1)).alias("documents"),
            F.least(F.count_distinct("before"), F.count_distinct("after")).alias("surroundings"),
            F.count("run_before").alias("run_documents"),
            F.least(F.count_distinct("run_before"), F.count_distinct("run_after")).alias("run_surroundings"),
        )
        .where(varied("documents", "surroundings", F.lit(min_documents)) | varied("run_documents", "run_surroundings", least))
        .select("template")
    )
    dropped = frequent.join(recurring, "template", "left_semi").groupBy("row").agg(F.collect_set("line").alias("dropped"))
    before = F.split("t", "\n")
    kept = F.filter(before, lambda line, i: ~F.array_contains(F.col("dropped"), i))
    other = [F.col(f"{held}.`{c}`").alias(c) if c != text else F.col("t").alias(c) for c in names]
    return (
        rows.join(dropped.hint("merge"), "row", "left")
        .select(
            held,
            F.when(F.col("dropped").isNull(), F.col("t")).otherwise(F.array_join(kept, "\n")).alias("t"),
            F.when(F.col("t").isNull(), 0).otherwise(F.size(before)).cast("long").alias("before"),
            F.when(F.col("dropped").isNull(), 0).otherwise(F.size("dropped")).cast("long").alias("gone"),
        )
        .select(*other, F.col("before").alias(lines_col), F.col("gone").alias(dropped_col))
    )
