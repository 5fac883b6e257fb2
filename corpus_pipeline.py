"""A corpus from raw documents to packed sequences: five stages, each written before the next reads it.

Every stage takes the session, the documents its predecessor kept, and the folder of the input tables;
all but the last return the columns of documents. A stage works on all rows it is given.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from epiframe.llm import jaccard, lines, packing, quality, repeats
from epiframe.llm.common import Scratch, free_name, words

#: A whole pass, packing included, has no SQL form: tokens come from a tokenizer.
ORACLE_SQL = None


def _aside(docs: DataFrame) -> DataFrame:
    """doc_id, text, and all other columns as one struct, so that no name among them meets an operator's own."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", (F.struct(*others) if others else F.lit(None).cast("string")).alias("others"))


def _back(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, with a new text and the matching number of characters, from doc_id, text and others."""
    new = {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[(new[c] if c in new else F.col("others").getField(c)).alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or whose source is refused, go.

    A null text is empty and goes; with a null source the base rules decide alone. Repeated rows are judged
    each; an empty table stays empty; columns may have any names.
    """
    return quality.judge(docs, "source", carry=tuple(docs.columns)).filter("kept").select("carried.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of two or more lines, or of one line of 50 words or more, go; so does a document of which no word is left.

    Null texts stay null. Rows equal in id and text are one document written several times, and get the same
    result; an empty table stays empty; columns may have any names.
    """
    out = lines.drop_repeated_lines(_aside(docs), 2, long_words=50)
    return _back(out.filter((F.col("n_removed") == 0) | (F.size(words(F.col("text"))) > 0)), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates stays: the one with the least id, null ids last.

    Classes join five-word shingle sets at a similarity of 0.8. Empty documents are in no class and stay. Ids may
    repeat or be null: rows are told apart by a digest (128 bits) of id and text, and of equal rows one stays.
    An empty table stays empty; columns may have any names.
    """
    row = free_name("row", docs.columns)
    digest = F.md5(F.concat_ws("\n", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce("text", F.lit(""))))
    classes = jaccard.near_classes(docs, 5, 80, tag=digest).filter(F.col("n_shingles") > 0)
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "tag")
    firsts = classes.groupBy("class_id").agg(F.min(place).alias("first")).select(F.col("first.tag").alias(row))
    held = docs.withColumn(row, digest)
    full = F.size(words(F.col("text"))) > 0
    kept = held.filter(full).join(firsts, row, "left_semi").dropDuplicates([row])
    return kept.unionByName(held.filter(~full)).select(*docs.columns)


def string_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that stand more than once go, each copy but the first.

    The first copy, by doc_id and place, stays, so that no passage is lost altogether. A null text becomes an
    empty one; of rows equal in id and text none but the first by place counts as such; an empty table stays
    empty; columns may have any names.
    """
    out = repeats.remove_repeats(_aside(docs), 200, keep_first=True, whole_characters=True)
    return _back(out.withColumn("text", F.col("kept").cast("string")), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, packed into sequences of 4096 tokens; a null text is empty, an empty table gives no rows."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 4096, 1)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("string_dedup", string_dedup),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written to the shared folder and reread."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
