"""The registered queries of the corpus operators and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from epiframe.llm import ann, bpe, concat, jaccard, lines, lm, merkle, packing, quality, repeats, runs, sharding, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(query):
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@register("op1_cross_polytope")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest of every hundredth vector, among all others."""
    return ann.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), every=100, k=10)


def remainder(modulus: int):
    """crc32 of the id as text, modulo ``modulus``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


@register("op2_elias_fano_trie")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probabilities of all texts under a model of words, pairs and triples of the training part."""
    held_out = remainder(7) == 2
    return lm.train_and_score(documents(spark, sf_dir).select("doc_id", "text"), held_out, order=3).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@register("op3_bigru_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all whole texts, learnt from the labels of the training part."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    held_out = F.coalesce(remainder(5) == 0, F.lit(False))
    scorer = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~held_out)
    return toxicity.score(docs, scorer).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_windows")


LINES_SQL = """
WITH l AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents),
f AS (SELECT doc_id, line, line_no, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS pos,
             lead(line) OVER (PARTITION BY doc_id ORDER BY line_no) AS following
      FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
c AS (SELECT doc_id, pos FROM (SELECT *, row_number() OVER (PARTITION BY line, following ORDER BY doc_id, pos) AS copy FROM f WHERE following IS NOT NULL)
      WHERE copy > 1),
gone AS (SELECT DISTINCT doc_id, pos + step AS pos FROM c, (VALUES (0), (1)) s(step)),
runs AS (SELECT f.doc_id, f.line_no, f.pos, gone.pos IS NOT NULL AS removed FROM f LEFT JOIN gone USING (doc_id, pos)),
counted AS (SELECT doc_id, count(*) FILTER (removed) AS n_removed,
                   count(*) FILTER (removed AND NOT previous) AS n_runs
            FROM (SELECT *, coalesce(lag(removed) OVER (PARTITION BY doc_id ORDER BY pos), false) AS previous FROM runs) GROUP BY doc_id),
kept AS (SELECT l.doc_id, count(*) AS n_lines,
                coalesce(string_agg(l.line, chr(10) ORDER BY l.line_no) FILTER (NOT coalesce(r.removed, false)), '') AS kept_text
         FROM l LEFT JOIN runs r ON l.doc_id = r.doc_id AND l.line_no = r.line_no GROUP BY l.doc_id)
SELECT doc_id, n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_runs, 0) AS n_runs, sha256(kept_text) AS kept_sha256
FROM kept LEFT JOIN counted USING (doc_id)
"""


@register("op4_line_dedup", LINES_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of two or more lines are deleted."""
    return lines.drop_repeated_lines(documents(spark, sf_dir).select("doc_id", "text"), 2).select(
        "doc_id", "n_lines", "n_removed", "n_runs", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@register("op5_balanced_shards")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight contiguous shards of near equal bytes."""
    return sharding.balanced_shards(documents(spark, sf_dir), 8).withColumn("grown_shard", F.lit(None).cast("int"))


@register("op6_best_fit_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), 4096, 1)


QUALITY_SQL = """
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS p, w FROM d WHERE len(w) > 2),
twice AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, w[p], w[p + 1], w[p + 2]) AS n FROM windows) WHERE n > 1),
repeated AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, p + s AS p FROM twice, (VALUES (0), (1), (2)) v(s)) GROUP BY doc_id),
ln AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
       WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
base AS (SELECT d.doc_id, source, len(w) AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
                length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                coalesce(ln.n, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words
         FROM d LEFT JOIN ln USING (doc_id) LEFT JOIN repeated USING (doc_id)),
failing AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base),
hosts AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS failed FROM failing WHERE source IS NOT NULL GROUP BY source),
prior AS (SELECT avg(failed / n) AS mean, var_pop(failed / n) AS variance FROM hosts),
refused AS (SELECT source FROM hosts, prior WHERE CASE WHEN variance <= 1e-12 THEN mean
    ELSE (failed + greatest(mean * (1 - mean) / variance - 1, 1) * mean) / (n + greatest(mean * (1 - mean) / variance - 1, 1)) END > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND refused.source IS NULL AS kept
FROM failing LEFT JOIN refused USING (source)
"""


@register("op7_host_rules", QUALITY_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule measures of every document and the verdict after its source's shrunk failure rate."""
    return quality.judge(documents(spark, sf_dir))


JACCARD_SQL = """
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i : i + 2]) WHEN len(w) > 0 THEN [w] ELSE [] END) AS g FROM d),
h AS (SELECT doc_id, md5(array_to_string(g, ' ')) AS g FROM s),
n AS (SELECT doc_id, count(*) AS n FROM h GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM h a JOIN h b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 90 * (x.n + y.n - o)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, l.b FROM reach JOIN both_ways l ON l.a = reach.b)
SELECT documents.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
"""


@register("op8_ngram_jaccard", JACCARD_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents linked at a Jaccard similarity of 0.9 of their three-word shingles."""
    return jaccard.near_classes(documents(spark, sf_dir), 3, 90).select("doc_id", "n_shingles", "component_id")


@register("op9_word_shuffle_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts encoded and decoded, as digests."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    both = bpe.decode(bpe.encode(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN), ranks)
    return both.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


REPEATS_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT doc_id, unnest(range(0, length(h) // 2 - 199)) AS p, h FROM d WHERE length(h) >= 400),
hashed AS (SELECT doc_id, p, md5(h[2 * p + 1 : 2 * p + 400]) AS s FROM starts),
twice AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY s) AS n FROM hashed) WHERE n > 1),
heads AS (SELECT *, coalesce(p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) > 200, true) AS head FROM twice),
runs AS (SELECT doc_id, min(p) AS a, max(p) + 200 AS b FROM (SELECT *, sum(head::INT) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM heads) GROUP BY doc_id, run),
gaps AS (SELECT doc_id, b AS a, coalesce(lead(a) OVER (PARTITION BY doc_id ORDER BY a), 2000000000) AS b FROM runs
         UNION ALL SELECT doc_id, 0, min(a) FROM runs GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(h[2 * a + 1 : 2 * least(b, length(h))], '' ORDER BY a) AS k FROM gaps JOIN d USING (doc_id) GROUP BY doc_id),
counted AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS n FROM runs GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(n, 0) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN counted USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@register("op10_repeated_strings", REPEATS_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes in strings of 200 bytes that stand more than once are removed."""
    docs = repeats.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"), 200)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return docs.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


MERKLE_SQL = """
WITH RECURSIVE d AS (SELECT doc_id, source, lang, n_chars, text, list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: unicode(c)::BIGINT)),
         lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS raw FROM documents),
f AS (SELECT *, coalesce(xor(raw, 4294967295) % 5 = 0, false) AS tampered, concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
        coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head FROM d),
l AS (SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
             sha256(head || coalesce(strlen(text) || ':' || CASE WHEN tampered THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END, '-')) AS claimed FROM f),
numbered AS (SELECT *, dense_rank() OVER (ORDER BY coalesce('1' || hex(encode(source)), '0')) - 1 AS tree,
                    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM l),
nodes AS (SELECT tree, 0 AS level, i, n, leaf AS digest FROM numbered
          UNION ALL SELECT tree, level + 1, i // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY tree, level, i // 16, n),
subroots AS (SELECT tree, digest, count(*) OVER () AS n FROM nodes WHERE n = 1),
top AS (SELECT 0 AS level, tree AS i, n, digest FROM subroots
        UNION ALL SELECT level + 1, i // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY level, i // 16, n),
ways AS (SELECT x.tree, x.i, n.level, n.i < x.i // 16 ** n.level AS before, string_agg(n.digest, '' ORDER BY n.i) AS digests
         FROM numbered x JOIN nodes n ON n.tree = x.tree AND n.i // 16 = x.i // (16 ** (n.level + 1))::BIGINT AND n.n > 1 AND n.i <> x.i // (16 ** n.level)::BIGINT GROUP BY ALL),
uppers AS (SELECT x.tree, t.level, t.i < x.tree // 16 ** t.level AS before, string_agg(t.digest, '' ORDER BY t.i) AS digests
           FROM subroots x JOIN top t ON t.i // 16 = x.tree // (16 ** (t.level + 1))::BIGINT AND t.n > 1 AND t.i <> x.tree // (16 ** t.level)::BIGINT GROUP BY ALL),
heights AS (SELECT tree, max(level) AS height FROM nodes GROUP BY tree),
steps AS (SELECT x.tree, x.i, s.level FROM numbered x, (SELECT unnest(range(0, 40)) AS level) s),
path AS (SELECT x.tree, x.i, list({'level': s.level, 'a': coalesce(a.digests, u.digests, ''), 'b': coalesce(b.digests, v.digests, '')} ORDER BY s.level) AS way
         FROM numbered x JOIN heights h ON h.tree = x.tree JOIN steps s ON s.tree = x.tree AND s.i = x.i AND s.level < h.height + (SELECT max(level) FROM top)
         LEFT JOIN ways a ON a.tree = x.tree AND a.i = x.i AND a.level = s.level AND a.before LEFT JOIN ways b ON b.tree = x.tree AND b.i = x.i AND b.level = s.level AND NOT b.before
         LEFT JOIN uppers u ON u.tree = x.tree AND u.level = s.level - h.height AND u.before LEFT JOIN uppers v ON v.tree = x.tree AND v.level = s.level - h.height AND NOT v.before
         GROUP BY x.tree, x.i),
folds AS (SELECT tree, i, 0 AS k, claimed AS digest, way FROM numbered LEFT JOIN path USING (tree, i)
          UNION ALL SELECT tree, i, k + 1, sha256(way[k + 1].a || digest || way[k + 1].b), way FROM folds WHERE k < coalesce(len(way), 0)),
folded AS (SELECT tree, i, digest, way FROM folds WHERE k = coalesce(len(way), 0))
SELECT x.doc_id, x.leaf, s.digest AS subroot, r.digest AS root, sha256(coalesce(array_to_string(list_transform(w.way, lambda y: y.a || y.b), ''), '')) AS proof_sha256,
       w.digest AS folded_root, w.digest = r.digest AS verified
FROM numbered x JOIN subroots s ON s.tree = x.tree JOIN folded w ON w.tree = x.tree AND w.i = x.i, (SELECT digest FROM top WHERE n = 1) r
"""


@register("op11_merkle_manifest", MERKLE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle roots and proofs of all documents by source, and what rows with changed texts fold to."""
    changed = F.when(F.coalesce(remainder(5) == 0, F.lit(False)), F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))
    head = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    nodes = merkle.manifest(
        documents(spark, sf_dir), "source", "doc_id", merkle.leaf_digest(*head, F.col("text")),
        {"doc_id": F.col("doc_id"), "claimed": merkle.leaf_digest(*head, changed)})
    return nodes.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof(F.col("path")), 256).alias("proof_sha256"),
        merkle.folded(F.col("claimed"), F.col("path")).alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


@register("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of all texts, every tenth with a planted repetition, as digests."""
    found = runs.periodic_runs(documents(spark, sf_dir), change=runs.planted)
    strongest = F.aggregate(
        F.slice("runs", F.lit(2), F.greatest(F.size("runs") - 1, F.lit(0))), F.get("runs", F.lit(0)),
        lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.withColumn("best", strongest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(listed, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")


@register("op13_concat_and_cut")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as one stream of tokens, cut into sequences of 1024."""
    return concat.concat_and_cut(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), 1024, 0).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
