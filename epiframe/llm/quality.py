"""Quality rules for documents, and verdicts on their hosts from shrunk failure rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from epiframe.llm.common import SPACES, Scratch, let, words

SYMBOLS = "#*$%&|<>"
#: Refused hosts are sent to all tasks if their names and entries take no more bytes than this.
BROADCAST_BYTES = 16 << 20


def _repeat_words(parts: Column) -> Column:
    """Words that lie in a three-word window found twice or more."""

    def covered(starts: Column) -> Column:  # ascending starts of such windows
        return F.aggregate(
            F.sequence(F.lit(0), F.size(starts) - 1), F.lit(0),
            lambda n, i: n + F.when(i == F.size(starts) - 1, 3).otherwise(F.least(F.lit(3), F.get(starts, i + 1) - F.get(starts, i))),
        )

    def starts(windows: Column) -> Column:  # sorted by hash, equal windows side by side
        hashed = F.transform(windows, lambda x: x["h"])
        return let(hashed, lambda h: F.sort_array(F.transform(
            F.filter(
                F.transform(windows, lambda x, i: F.struct(x["p"].alias("p"), (
                    F.coalesce(F.get(h, i - 1) == x["h"], F.lit(False)) | F.coalesce(F.get(h, i + 1) == x["h"], F.lit(False))).alias("twice"))),
                lambda x: x["twice"]),
            lambda x: x["p"])))

    def counted(w: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("p")),
        )
        return let(windows, lambda x: F.when(
            F.size(F.array_distinct(F.transform(x, lambda y: y["h"]))) == F.size(x), 0,
        ).otherwise(let(starts(F.sort_array(x)), covered)))

    return F.when(F.size(parts) < 4, 0).otherwise(counted(parts))


def measures(text: Column) -> dict[str, Column]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text; null is empty."""
    text = F.coalesce(text, F.lit(""))
    parts = words(text)
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    return {
        "n_words": F.size(parts).cast("long"),
        "word_chars": F.length(F.translate(text, SPACES, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": let(parts, _repeat_words).cast("long"),
    }


def host_rates(base: DataFrame) -> DataFrame:
    """host, shrunk_rate: each host's share of failed documents, drawn towards an empirical beta prior.

    The prior's mean and strength come from the hosts' own rates by moments: strength
    mean (1 - mean) / variance - 1, at least 1; with no variance every host has the mean.
    """
    hosts = base.filter(F.col("host").isNotNull()).groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed"))
    rate = F.col("failed") / F.col("n")
    prior = hosts.agg(F.avg(rate).alias("mean"), F.coalesce(F.var_pop(rate), F.lit(0.0)).alias("variance"))  # one row
    strength = F.greatest(F.col("mean") * (1 - F.col("mean")) / F.col("variance") - 1, F.lit(1.0))
    shrunk = F.when(F.col("variance") <= 1e-12, F.col("mean")).otherwise(
        (F.col("failed") + strength * F.col("mean")) / (F.col("n") + strength))
    return hosts.join(F.broadcast(prior)).select("host", shrunk.alias("shrunk_rate"))


def judge(docs: DataFrame, host: str = "source", max_rate: float = 0.5, carry: tuple[str, ...] = ()) -> DataFrame:
    """Base rules for every document, then its host's verdict.

    A document fails the base rules with fewer than 50 words, or when more than half of its words lie
    in repeated three-word windows. A host is refused when its shrunk failure rate exceeds
    ``max_rate``; a document is kept if it passed and its host is not refused. Documents without a
    host are judged by the base rules alone; a null text is empty; repeated rows count each; an empty
    table gives no rows. ``carry`` names columns of the input to hand through, under any names, as
    fields of the struct ``carried``.
    Result: doc_id, the five measures, base_failed, kept, and carried if columns are.
    """
    scratch = Scratch(docs.sparkSession)
    carried = [F.struct(*[F.col(c) for c in carry]).alias("carried")] if carry else []
    base = docs.select("doc_id", F.col(host).alias("host"), *carried,
                       *[column.alias(name) for name, column in measures(F.col("text")).items()])
    base = base.withColumn(
        "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    base = scratch.cut(base, "measures")
    refused = scratch.cut(host_rates(base).filter(F.col("shrunk_rate") > max_rate).select("host", F.lit(True).alias("refused")), "refused")
    taken = refused.agg(F.sum(F.octet_length(F.col("host").cast("string")) + 64)).first()[0] or 0
    if taken <= BROADCAST_BYTES:  # few hosts; the documents then stay where they are
        refused = F.broadcast(refused)
    return base.join(refused, "host", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.col("refused").isNull()).alias("kept"),
        *(["carried"] if carry else []))
