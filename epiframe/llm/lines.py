"""Removal of repeated runs of lines, found by prefix doubling over line ids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from epiframe.llm.common import SPACES, Scratch, let, words

KEY = ["doc_id", "text_hash"]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text_hash", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))


def _rank(*parts: Column) -> list[Column]:
    """Two independent 64-bit hashes: together the class, or rank, of a run."""
    return [F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(1), *parts).alias("b")]


def _later(ranked: DataFrame) -> DataFrame:
    """Positions whose rank stands more than once, with ``later``: not the first of that rank."""
    place = F.struct(*KEY, "at")
    classes = ranked.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).filter("n > 1").drop("n")
    return ranked.join(classes, ["a", "b"]).select(*KEY, "at", "a", "b", (~place.eqNullSafe(F.col("first"))).alias("later"))


def later_copies(docs: DataFrame, min_lines: int, scratch: Scratch, long_words: int | None = None) -> DataFrame:
    """doc_id, text_hash, line: lines inside a run of ``min_lines`` that stands earlier in the corpus.

    A line of at least ``long_words`` words is a run by itself.

    The suffixes are those of the sequences of non-blank lines. A round joins each position's rank
    with the rank ``step`` lines on, which ranks runs of twice the length; positions whose run is
    unique leave, since no longer run of theirs repeats. Rounds go on until every rank is unique. Positions that share
    a rank are one interval of suffixes with that common prefix; all but the first are later copies. A position
    takes the longest run that is one; a maximal run of any length between two rounds is covered by the
    runs of the shorter round at its two ends and between them.
    """
    def long(x: Column) -> Column:
        return F.lit(False) if long_words is None else F.size(words(x)) >= long_words

    lines = _keyed(docs).select(
        *KEY,
        F.posexplode(F.filter(
            F.transform(F.split(F.coalesce(F.col("text"), F.lit("")), "\n"), lambda x, i: F.struct(
                i.alias("line"), *_rank(x), long(x).alias("long"), (F.length(F.translate(x, SPACES, "")) > 0).alias("full"))),
            lambda x: x["full"])).alias("at", "item"),
    ).select(*KEY, "at", "item.line", "item.a", "item.b", "item.long")
    ranked = scratch.cut(lines, "lines")
    numbers = ranked.select(*KEY, "at", "line")
    found = [] if long_words is None else [_later(ranked.filter("long")).filter("later").select(*KEY, "at", F.lit(1).alias("run"))]
    length = 1
    while True:
        if length < min_lines:
            step = min(length, min_lines - length)
            shared = ranked.join(ranked.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("a", "b"), ["a", "b"], "left_semi")
        else:
            step = length
            shared = scratch.cut(_later(ranked), f"shared{length}")
            if length > 1:
                scratch.drop(ranked)
            if shared.isEmpty():
                break
            found.append(shared.filter("later").select(*KEY, "at", F.lit(length).alias("run")))
        ahead = W.partitionBy(*KEY).orderBy("at").rangeBetween(step, step)
        ranked = shared.select(
            *KEY, "at", "a", "b", F.first("a").over(ahead).alias("a2"), F.first("b").over(ahead).alias("b2")
        ).filter(F.col("a2").isNotNull()).select(*KEY, "at", *_rank(F.col("a"), F.col("b"), F.col("a2"), F.col("b2")))
        ranked = scratch.cut(ranked, f"runs{length + step}")
        length += step
    if not found:  # no run of the least length stands twice
        found.append(numbers.limit(0).select(*KEY, "at", F.lit(1).alias("run")))
    longest = reduce(DataFrame.unionByName, found).groupBy(*KEY, "at").agg(F.max("run").alias("run"))
    covered = longest.select(*KEY, F.explode(F.sequence(F.col("at"), F.col("at") + F.col("run") - 1)).alias("at")).distinct()
    left, right = covered.alias("c"), numbers.alias("n")
    return left.join(
        right, (F.col("c.doc_id").eqNullSafe(F.col("n.doc_id"))) & (F.col("c.text_hash") == F.col("n.text_hash")) & (F.col("c.at") == F.col("n.at"))
    ).select("n.doc_id", "n.text_hash", "n.at", "n.line").distinct()


def drop_repeated_lines(docs: DataFrame, min_lines: int = 2, long_words: int | None = None) -> DataFrame:
    """Documents without the later copies of repeated runs of at least ``min_lines`` lines.

    With ``long_words`` a single line of at least so many words is a run as well.

    Lines are parted by \\n; blank ones (white space only) are no part of a run and always stay. Of
    equal runs the first by doc_id (nulls first), text hash and place stays, wherever it is; runs are
    judged on the input. Rows equal in doc_id and text are one document written several times:
    none of them is a later copy of another, and all get the same result. Null text: as empty.
    Result: the columns of ``docs`` with ``text`` replaced, and n_lines, n_removed, n_runs (maximal
    removed runs of non-blank lines) as columns of those names; clashing input columns give way. Other
    columns may have any names.
    """
    scratch = Scratch(docs.sparkSession)
    copies = later_copies(docs.select("doc_id", "text"), min_lines, scratch, long_words)
    gone = copies.groupBy(*KEY).agg(  # as many as the document has lines
        F.sort_array(F.collect_list("at")).alias("gone_at"), F.collect_list("line").alias("gone_line"))
    gone = scratch.cut(gone, "gone").select(
        F.col("doc_id").alias("gone_doc"), F.col("text_hash").alias("gone_hash"), "gone_line",
        F.size("gone_line").cast("long").alias("n_gone"),
        F.size(F.array_distinct(F.transform("gone_at", lambda x, i: x - i))).cast("long").alias("runs"),
    )
    kept_columns = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed", "n_runs")]
    rows = _keyed(docs.select(F.struct(*kept_columns).alias("held"), "doc_id", "text")).select("held", *KEY)
    joined = rows.join(gone, rows.doc_id.eqNullSafe(F.col("gone_doc")) & (rows.text_hash == F.col("gone_hash")), "left")
    given = F.col("held.text")
    split = F.split(given, "\n")
    kept = let(split, lambda lines: let(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone_line")),
        lambda stay: F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")))
    text = F.when(F.col("gone_line").isNull(), given).otherwise(kept)
    return joined.select(
        *[(text if c == "text" else F.col("held").getField(c)).alias(c) for c in kept_columns],
        F.when(given.isNull(), 0).otherwise(F.size(split)).cast("long").alias("n_lines"),
        F.coalesce("n_gone", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("runs", F.lit(0)).cast("long").alias("n_runs"))
