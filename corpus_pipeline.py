"""A training corpus from raw documents, stage by stage.

Each stage takes the documents that the one before has kept and returns documents with the same
columns; the last packs them into training sequences.  ``n_chars`` follows the text where it changes.
Further columns, of any name, are carried through all but the last.  An empty table stays empty.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import line_templates, packing, pii, repetition, simhash
from marketloom.sources.scratch import discard, recorded, scratch_path, stored

# Scratch tables of the stages that ran before.
_earlier: list[str] = []


def _stage(function: Callable) -> Callable:
    """A stage that discards the scratch tables of the stage before.

    That stage has been written by then; if ``docs`` still reads them, they stay.
    """

    @functools.wraps(function)
    def staged(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = docs.inputFiles() if _earlier else []
        if not any(path.rsplit("/", 1)[1] in file for path in _earlier for file in read):
            for path in _earlier:
                discard(spark, path)
            _earlier.clear()
        with recorded() as paths:
            result = function(spark, docs, sf_dir)
        _earlier.extend(paths)
        return result

    return staged


def _with_length(docs: DataFrame, columns: list[str]) -> DataFrame:
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return docs.select(*columns)


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are too short or repeat themselves go.

    NULL and empty texts have no words and go; repeated rows are judged alike, texts whole.
    """
    return repetition.keep_sound(docs, "text")


@_stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of templates that recur across documents go; the documents stay.

    NULL stays NULL; a document that loses every line stays with an empty text, repeated rows stay.
    """
    cleaned = line_templates.drop_template_lines(docs, "text", lines_col="_lines", dropped_col="_dropped")
    return _with_length(cleaned, docs.columns)


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the smallest ``doc_id``, NULL last, then the first read.

    Four-word shingles and four differing bits, as the operator's own query has them.  NULL and empty
    texts are one group, as are repeated rows.
    """
    return simhash.keep_one_per_component(docs, "doc_id", "text", words=4, distance=4)


@_stage
def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets are replaced by their kind; NULL, empty and clean texts stay as they are."""
    return _with_length(pii.redact(docs, "text"), docs.columns)


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of all documents in sequences of at most 2048.

    A NULL or empty text is its end token; repeated rows are documents each.
    """
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.token_pieces(docs.select("doc_id", "text"), "text", tokenizer, packing.CAPACITY, with_ids=True)
    return packing.pack(pieces, packing.CAPACITY)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("pii_redaction", redact_pii),
    ("best_fit_packing", pack),
]

# No stage can be said in SQL: the tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        docs = stored(stage(spark, docs, sf_dir), path=path)
        if before:
            discard(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
