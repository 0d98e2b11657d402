"""Corpus pipeline: language, near duplicates, repeated strings, benchmark text, tokens.

Each stage reads what the one before wrote.  All but the last return the columns of
``documents``.  Rows with null ids, null texts or repeated ids pass through each stage
as its operator defines; the near-duplicate stage judges each row by itself.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm import bpe, decontam, language, near_dup, repeats
from ledgerlark.llm.common import fold, small_enough, stash, table
from ledgerlark.llm.queries import VOCABULARY

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: SQL cannot express language profiles, byte strings across documents, or BPE.
ORACLE_SQL = None


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with marks behind it until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def others_packed(docs: DataFrame) -> Column:
    """The columns but ``text`` as ``_row``, out of the way of those an operator adds."""
    return F.struct(*(c for c in docs.columns if c != "text")).alias("_row")


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without any letter, which have no language; a null ``lang`` becomes
    the predicted one (``und`` where no document tells a language)."""
    known = language.with_prediction(docs.select(others_packed(docs), "text"),
                                     language.learn(docs, fold("doc_id", 3) != 1))
    return known.where("letters").select(*(
        F.col(c) if c == "text" else F.coalesce("_row.lang", "lang_pred").alias(c) if c == "lang"
        else F.col(f"_row.`{c}`") for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of rows that share 80 % of their 5-word shingles,
    directly or through others: that of the smallest id, null last.  Rows are told apart
    by a number of their own, so that copies under one id or a null id are a group too."""
    number = free_name(docs, "row")
    rows = stash(docs.withColumn(number, F.monotonically_increasing_id()), "rows")
    ids = rows.select(F.col(number).alias("number"), "doc_id")
    found = stash(near_dup.near_duplicates(rows.select(F.col(number).alias("doc_id"), "text")).select(
        F.col("doc_id").alias("number"), "component_id"), "grouped")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "number"))
    groups = stash(found.join(ids, "number").groupBy("component_id").agg(
        first["number"].alias("first"), F.count("*").alias("n")).where("n > 1"), "groups")
    dropped = stash(found.join(groups, "component_id").where("number != first").select(
        F.col("number").alias(number)), "dropped")
    return rows.join(small_enough(dropped), number, "left_anti").select(*docs.columns)


def remove_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes every 400-byte string that also starts elsewhere; characters cut in two go
    too, and documents of which nothing is left."""
    packed = docs.select("doc_id", "text", others_packed(docs))
    cut = repeats.without_repeats(packed, as_text=True).where("n_bytes = 0 OR kept <> ''")
    n_chars = F.when(F.size("spans") > 0, F.length("kept")).otherwise(F.col("_row.n_chars"))
    return cut.select(*(
        F.col("kept").alias(c) if c == "text" else n_chars.alias(c) if c == "n_chars"
        else F.col(f"_row.`{c}`") for c in docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of what is left."""
    ranks = bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    return bpe.token_digests(docs, ranks, public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", keep_known_languages),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_strings", remove_repeated_strings),
    ("decontamination", drop_contaminated),
    ("byte_bpe", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
