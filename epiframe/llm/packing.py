"""Best-fit packing of tokenised documents into fixed-length sequences, large pieces first."""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from epiframe.llm.common import Scratch, blocks

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pack_lengths(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Bins for ``counts[length]`` pieces of each length: (lengths in a bin, number of such bins).

    Pieces above a third of the capacity stand at most two to a bin: the largest is matched with the
    largest that still fits, over and over. Then the smaller ones, longest first, each go into the
    smallest gap that holds them, or a new bin. Equal bins move together, so the work depends on the
    number of lengths, not of pieces.
    """
    left = {l: n for l, n in counts.items() if n > 0}
    gaps: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    sizes: list[int] = []

    def put(gap: int, bins: tuple[tuple[int, ...], int]) -> None:
        if gap not in gaps:
            gaps[gap] = []
            insort(sizes, gap)
        gaps[gap].append(bins)

    large = sorted(l for l in left if 3 * l > capacity)
    while large:
        longest = large[-1]
        at = bisect_right(large, capacity - longest) - 1
        if at < 0:
            put(capacity - longest, ((longest,), left[longest]))
            large.pop()
            continue
        mate = large[at]
        n = left[longest] // 2 if mate == longest else min(left[longest], left[mate])
        if n == 0:  # one of this length is left, and its like is the largest that fits
            shorter = at - 1
            if shorter < 0:
                put(capacity - longest, ((longest,), 1))
                large.pop()
                continue
            mate, n = large[shorter], 1
        put(capacity - longest - mate, ((longest, mate), n))
        for l in (longest, mate):
            left[l] -= n
        for l in {longest, mate}:
            if not left[l]:
                large.remove(l)

    for length in sorted((l for l in left if 3 * l <= capacity), reverse=True):
        n = left[length]
        while n:
            at = bisect_left(sizes, length)
            if at == len(sizes):
                each = capacity // length
                if n >= each:
                    put(capacity - each * length, ((length,) * each, n // each))
                if n % each:
                    put(capacity - n % each * length, ((length,) * (n % each), 1))
                break
            gap = sizes[at]
            pattern, bins = gaps[gap].pop()
            if bins > n:
                gaps[gap].append((pattern, bins - n))
                bins = n
            if not gaps[gap]:
                del gaps[gap]
                sizes.pop(at)
            n -= bins
            put(gap - length, ((*pattern, length), bins))
    return [bins for same in gaps.values() for bins in same]


def ascii_parts(tokenizer):
    """The pattern that parts lower-cased ASCII text as ``tokenizer`` does, None for another kind.

    Its kind lower-cases, takes all matches of one pattern, writes bytes as characters (printable ASCII
    as itself) and hands each match to the model alone. The pattern is read from the tokenizer.
    """
    held = json.loads(tokenizer.to_str())
    steps = [(held["normalizer"] or {}).get("normalizers", []), (held["pre_tokenizer"] or {}).get("pretokenizers", [])]
    kinds = [[step["type"] for step in part] for part in steps]
    if kinds != [["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]] or not all(t["special"] for t in held["added_tokens"]):
        return None
    space, (split, spelled) = steps[0][1], steps[1]
    if (space["pattern"], space["content"]) != ({"Regex": r"\s+"}, " ") or (split["behavior"], split["invert"]) != ("Removed", True):
        return None
    if spelled["add_prefix_space"] or spelled["use_regex"] or "Regex" not in split["pattern"]:
        return None
    return re.compile(split["pattern"]["Regex"].replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9"))


class Parts(dict):
    """Ids of single matches, straight from the tokenizer's model."""

    def __init__(self, model):
        self.model = model

    def __missing__(self, part: str) -> list[int]:
        self[part] = ids = [t.id for t in self.model.tokenize(part)]
        return ids


class Chunks(dict):
    """Ids of text chunks between blanks, each distinct chunk tokenised once."""

    def __init__(self, tokenizer):
        self.tokenizer, self.new = tokenizer, []
        self.pattern, self.parts = ascii_parts(tokenizer), Parts(tokenizer.model)
        self.flat, self.start = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def __missing__(self, chunk: bytes) -> int:
        self[chunk] = at = len(self)
        self.new.append(chunk)
        return at

    def settle(self) -> None:
        if not self.new:
            return
        ids: list[list[int]] = [[]] * len(self.new)
        rest = []
        for i, chunk in enumerate(self.new):
            text = chunk.decode("utf-8", "replace")
            if self.pattern is not None and text.isascii() and text.isprintable():
                parts = self.pattern.findall(text.lower())
                ids[i] = self.parts[parts[0]] if len(parts) == 1 else [x for part in parts for x in self.parts[part]]
            else:
                rest.append((i, text))
        for (i, _), e in zip(rest, self.tokenizer.encode_batch_fast([text for _, text in rest], add_special_tokens=False), strict=True):
            ids[i] = e.ids
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), np.uint32)])
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum([len(i) for i in ids])])
        self.new = []


#: Distinct chunks at which a worker's table starts anew.
TABLE = 1_000_000


@lru_cache(maxsize=1)
def worker_chunks(vocabulary: str) -> list[Chunks]:
    """The one table of chunks of this worker, which its tasks share."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    tokenizer.encode_special_tokens = True
    return [Chunks(tokenizer)]


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int) -> DataFrame:
    """Token counts and checksums of every document's pieces.

    The tokenizer parts text at white space before anything else and joins nothing across it, so
    each distinct chunk between ASCII blanks is tokenised once a worker, until its table is full and
    starts anew; chunks of printable ASCII are parted here and go to its model part by part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = worker_chunks(vocabulary)
        chunks = held[0]
        for batch in batches:
            names = batch.column("doc_id")
            for first, end, raw, starts in blocks(batch):
                rows, out = raw.tobytes(), []
                if len(chunks) > TABLE:
                    held[0] = chunks = Chunks(chunks.tokenizer)
                found = [np.fromiter(map(chunks.__getitem__, rows[a:b].split()), np.int64) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
                chunks.settle()
                for row, at in enumerate(found, first):
                    lengths = chunks.start[at + 1] - chunks.start[at]
                    total = int(lengths.sum())
                    shift = np.repeat(chunks.start[at] - (np.cumsum(lengths) - lengths), lengths)
                    ids = np.append(chunks.flat[shift + np.arange(total)], np.uint32(end_id)).astype("<u4")
                    for piece, start in enumerate(range(0, total + 1, capacity)):
                        part = ids[start : start + capacity]
                        out.append((row, piece, start, len(part), zlib.crc32(part.tobytes())))
                table = np.array(out, np.int64).reshape(-1, 5)
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(table[:, 0])), pa.array(table[:, 1].astype(np.int32)), *(pa.array(table[:, i]) for i in (2, 3, 4))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def pack(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Places for all pieces of all documents in sequences of at most ``capacity`` tokens.

    Each document's ids end with ``end_id``; longer ones are cut, only the last piece being shorter.
    The number of pieces of each length (``capacity`` rows at most) is planned on the driver; pieces
    of a length are then numbered by prefix sums over input partitions and look their places up
    in the plan, whose size is bounded by the capacity. Null and empty texts: the end id alone;
    repeated rows are packed each; an empty table gives no rows.
    Result: doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    pieces = token_pieces(docs, vocabulary, capacity, end_id).withColumn("part", F.spark_partition_id())
    pieces = scratch.cut(pieces, "pieces")
    counts = scratch.cut(pieces.groupBy("length", "part").count(), "counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}

    slots: dict[int, list[tuple[int, int, int]]] = {}
    used = dict.fromkeys(histogram, 0)
    sequences = 0
    for pattern, bins in pack_lengths(histogram, capacity):
        offset = 0
        for length in pattern:
            slots.setdefault(length, []).append((used[length], sequences, offset))
            used[length] += bins
            offset += length
        sequences += bins
    plan = spark.sparkContext.broadcast({l: np.array(rows, np.int64) for l, rows in slots.items()})

    earlier = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    before = counts.select("length", "part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    inside = W.partitionBy("length", "part").orderBy("doc_id", "start", "ids_crc32")
    ranked = pieces.withColumn("rank", F.row_number().over(inside)).join(before, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("rank") - 1).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for l in np.unique(length):
                rows, table = np.flatnonzero(length == l), plan.value[int(l)]
                at = np.searchsorted(table[:, 0], rank[rows], "right") - 1
                sequence[rows] = table[at, 1] + rank[rows] - table[at, 0]
                offset[rows] = table[at, 2]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, f"{PIECES}, sequence_id long, offset long")
