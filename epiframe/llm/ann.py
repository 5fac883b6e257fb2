"""Approximate nearest neighbours by cross-polytope hashing with several probes, reranked exactly."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from epiframe.llm.common import Scratch

#: Vectors for each chunk of an average bucket, about.
CHUNK = 500


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the row length is a power of two."""
    width, half = x.shape[1], 1
    while half < width:
        pairs = x.reshape(len(x), -1, 2, half)
        x = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], axis=2).reshape(len(x), width)
        half *= 2
    return x / np.sqrt(width)


def rotations(x: np.ndarray, table: int, seed: int) -> np.ndarray:
    """Rows of x on the unit sphere, zero-padded to a power of two, pseudo-rotated for one table."""
    width = 1 << max(0, int(x.shape[1] - 1).bit_length())
    y = np.zeros((len(x), width))
    y[:, : x.shape[1]] = x / np.linalg.norm(x, axis=1, keepdims=True)
    signs = np.random.default_rng((seed, table, width)).choice([-1.0, 1.0], (3, width))
    for flips in signs:
        y = hadamard(y * flips)
    return y


def probes(y: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` nearest signed axes of each row, nearest first: 2 * axis + (1 if positive)."""
    count = min(count, y.shape[1])
    axes = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :count]
    return 2 * axes + (np.take_along_axis(y, axes, 1) > 0)


def probes_for(width: int) -> int:
    """Axes to look at: 12 for up to 64 components' share of them; a growing share beyond, where neighbours stand out less."""
    return max(2, round(12 * (width / 64) ** (1.0 if width <= 64 else 1.25)))


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id and vector (doubles) of the rows whose vector has finite components and isn't zero."""
    vector = F.col(vector_column).cast("array<double>")
    return vectors.select(F.col(id_column).cast("long").alias("id"), vector.alias("vector")).filter(
        F.col("id").isNotNull() & (F.size("vector") > 0)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0))


def nearest(
    vectors: DataFrame, every: int = 100, k: int = 10, tables: int = 8, probe: int | None = None,
    id_column: str = "vec_id", vector_column: str = "embedding", seed: int = 7,
) -> DataFrame:
    """The ``k`` nearest found of every row whose id is divisible by ``every``, among all other rows.

    Each distinct vector is indexed once, with its k + 1 least ids, so that copies of one vector
    never meet one by one. A table sends it to the signed axis that is nearest after a
    pseudo-rotation; a query looks at its ``probe`` nearest axes in each of ``tables`` tables, by default
    ``probes_for`` its length. Queries for which the probes find fewer than ``k`` go through all vectors of
    their length, block by block. Buckets are parted into chunks by a hash, as many as the number of vectors
    asks for, and a query visits all chunks of a bucket: no task holds more than a bounded share. Distances are
    exact, in double precision.

    So each query gets ``k`` rows, or all its candidates if they are fewer.

    Rows without id, or whose vector is null, empty, zero or holds a null or non-finite component, take
    no part; vectors of another length are never compared; rows equal in id and vector are one row;
    a query never finds rows of its own id; an empty table gives no rows; ties go to the smaller id.
    Result: query_id, rank (from 1), vec_id, score (Euclidean distance).
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    rows = scratch.cut(usable(vectors, id_column, vector_column), "usable")
    least = W.partitionBy("vector").orderBy("id")
    firsts = rows.withColumn("place", F.dense_rank().over(least)).filter(F.col("place") <= k + 1)
    distinct = firsts.groupBy("vector").agg(F.sort_array(F.collect_set("id")).alias("ids"))  # k + 1 at most

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [np.asarray(v, "<f8").tobytes() for v in batch.column("vector").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([blake2b(v, digest_size=16).digest() for v in raw], pa.binary()), pa.array(raw, pa.binary()), batch.column("ids")],
                names=["key", "raw", "ids"])

    # -0.0 and 0.0 group together; adding zero makes them one in bytes too.
    plain = distinct.withColumn("vector", F.transform("vector", lambda x: x + 0.0))
    index = scratch.cut(plain.select("vector", "ids").mapInArrow(name, "key binary, raw binary, ids array<long>"), "distinct")
    size = index.count()
    chunks = max(1, size // (CHUNK * 128))

    asked = rows.filter(F.col("id") % every == 0).withColumn("vector", F.transform("vector", lambda x: x + 0.0)).distinct()
    asked = asked.withColumn("ids", F.array("id")).select("vector", "ids").mapInArrow(name, "key binary, raw binary, ids array<long>")
    asked = scratch.cut(asked.select("key", "raw", F.col("ids")[0].alias("query_id")), "asked")

    def buckets(count: int | None, copies: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                raw = batch.column("raw").to_pylist()
                sizes = np.array([len(v) for v in raw])
                for length in np.unique(sizes):
                    at = np.flatnonzero(sizes == length)
                    x = np.frombuffer(b"".join(raw[i] for i in at), "<f8").reshape(len(at), -1)
                    own = np.array([int.from_bytes(batch.column("key")[int(i)].as_py()[:4], "little") % chunks for i in at])
                    for table in range(tables):
                        y = rotations(x, table, seed)
                        code = probes(y, count or probes_for(y.shape[1]))
                        row = np.repeat(np.arange(len(at)), code.shape[1])
                        code = code.ravel()
                        if copies > 1:
                            chunk = np.tile(np.arange(copies), len(row))
                            row, code = np.repeat(row, copies), np.repeat(code, copies)
                        else:
                            chunk = own[row] if count == 1 else np.zeros(len(row), np.int64)
                        spot = ((int(length) * tables + table) * (1 << 20) + code) * (1 << 16) + chunk
                        rows = pa.array(at[row])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(spot), *(batch.column(c).take(rows) for c in batch.schema.names)], names=["spot", *batch.schema.names])
        return run

    placed = index.mapInArrow(buckets(1, 1), "spot long, key binary, raw binary, ids array<long>")
    visits = asked.select("key", "raw").distinct().mapInArrow(buckets(probe, chunks), "spot long, key binary, raw binary")

    def compare(spot, there: pd.DataFrame, here: pd.DataFrame) -> pd.DataFrame:
        columns = ["query", "key", "least", "ids", "score"]
        if not len(there) or not len(here):
            return pd.DataFrame(columns=columns, dtype=object)
        x = np.frombuffer(b"".join(there["raw"]), "<f8").reshape(len(there), -1)
        norm = (x * x).sum(1)
        out = []
        for start in range(0, len(here), 64):
            part = here.iloc[start : start + 64]
            q = np.frombuffer(b"".join(part["raw"]), "<f8").reshape(len(part), -1)
            rough = norm - 2 * (q @ x.T) + (q * q).sum(1)[:, None]
            for i, query in enumerate(part["key"]):
                near = np.arange(len(x))
                if len(x) > k + 1:  # rounding cannot move a vector by as much as the margin
                    edge = np.partition(rough[i], k)[k]
                    near = np.flatnonzero(rough[i] <= edge + 1e-9 * (1 + abs(edge) + norm.max()))
                score = np.sqrt(((x[near] - q[i]) ** 2).sum(1))
                out.extend(zip([query] * len(near), there["key"].iloc[near], [v[0] for v in there["ids"].iloc[near]], there["ids"].iloc[near], score.tolist(), strict=True))
        return pd.DataFrame(out, columns=columns)

    def lists_of(placed: DataFrame, visits: DataFrame) -> DataFrame:
        """query, near: the k + 1 nearest of each query among the vectors of the spots that it visits."""
        found = placed.groupBy("spot").cogroup(visits.groupBy("spot")).applyInPandas(
            compare, "query binary, key binary, least long, ids array<long>, score double")
        best = W.partitionBy("query").orderBy("score", "least", "key")
        found = found.withColumn("place", F.dense_rank().over(best)).filter(F.col("place") <= k + 1).dropDuplicates(["query", "key"])
        found = found.select("query", "score", F.explode("ids").alias("vec_id"))
        order = W.partitionBy("query").orderBy("score", "vec_id")
        found = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)
        return scratch.cut(found.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("near")), "near")

    lists = lists_of(placed, visits)
    # k + 1 found are k others at least, whichever of them is the query's own row
    few = asked.select("key", "raw").distinct().join(lists.filter(F.size("near") > k).select(F.col("query").alias("key")), "key", "left_anti")
    few = scratch.cut(few, "few")
    if few.limit(1).count():
        length = F.octet_length("raw").cast("long") * (1 << 32)
        spots = max(1, size // (CHUNK * 8))
        everywhere = index.withColumn("spot", length + F.pmod(F.xxhash64("key"), F.lit(spots)))
        through = few.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(spots - 1)))).withColumn("spot", length + F.col("block"))
        whole = lists_of(everywhere.select("spot", "key", "raw", "ids"), through.select("spot", "key", "raw"))
        lists = lists.join(whole.select("query"), "query", "left_anti").unionByName(whole)
    own = F.filter("near", lambda x: x["vec_id"] != F.col("query_id"))
    answered = asked.select("query_id", F.col("key").alias("query")).join(lists, "query").select("query_id", F.posexplode(F.slice(own, 1, k)).alias("at", "hit"))
    return answered.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "hit.vec_id", "hit.score")
