"""Byte-level BPE by one global pass over distinct words, and decoding by the token table."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from epiframe.llm.common import partitions

#: Characters of text that one block of documents holds, about; a longer text is a block of its own.
BLOCK = 1 << 23


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _pack(array: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(array).tobytes(), 3)


def _unpack(data: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), dtype)


def _pack_words(found: list[bytes]) -> tuple[bytes, bytes]:
    return _pack(np.array([len(w) for w in found], "<u4")), zstandard.compress(b"".join(found), 3)


def _unpack_words(lengths: bytes, data: bytes) -> list[bytes]:
    ends = np.cumsum(_unpack(lengths, "<u4")).tolist()
    whole = zstandard.decompress(data)
    return [whole[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def split_blocks(docs: DataFrame, pattern: str, buckets: int, positions: bool) -> DataFrame:
    """Blocks of documents, as positions or as distinct words.

    With ``positions``, a row (bucket -1) carries a block's documents: ids, words in each, and the
    word number at every position; else a row for each hash bucket holds the block's distinct words
    in it, with their numbers. Both are made from the same scan, which names the blocks alike; ``check`` is a
    hash of all the block's words in order.
    """
    import regex

    schema = StructType([
        StructField("block", LongType()), StructField("bucket", IntegerType()),
        StructField("numbers", BinaryType()), StructField("lengths", BinaryType()), StructField("data", BinaryType()),
        StructField("names", BinaryType()), StructField("check", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zlib import crc32

        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        words_of = regex.compile(pattern).findall

        def block(names: list, texts: list[str]) -> pa.RecordBatch:
            nonlocal number
            numbers: dict[str, int] = {}
            at, counts = [], []
            for text in texts:
                found = words_of(text)
                counts.append(len(found))
                at.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in found), np.uint32, len(found)))
            name = part * (1 << 32) + number
            number += 1
            check = xxhash.xxh3_64_intdigest("\n".join(numbers).encode()) >> 1
            rows = []
            if positions:
                absent = np.array([n is None for n in names], np.uint8)
                ids = np.array([len(numbers), *(0 if n is None else n for n in names)], "<i8")
                rows = [(name, -1, _pack(np.concatenate(at)), _pack(np.array(counts, "<u4")), _pack(absent), _pack(ids), check)]
            held: list[list[bytes]] = [[] for _ in range(buckets)]
            which: list[list[int]] = [[] for _ in range(buckets)]
            for i, w in enumerate([] if positions else numbers):
                raw = w.encode()
                b = crc32(raw) % buckets
                held[b].append(raw)
                which[b].append(i)
            for b in range(buckets):
                if held[b]:
                    rows.append((name, b, _pack(np.array(which[b], "<u4")), *_pack_words(held[b]), None, check))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), *[pa.binary()] * 4, pa.int64()), strict=True)],
                names=schema.names)

        names, texts, size = [], [], 0
        for batch in batches:
            for n, t in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                t = t.as_py() or ""
                if texts and size + len(t) > BLOCK:
                    yield block(names, texts)
                    names, texts, size = [], [], 0
                names.append(n)
                texts.append(t)
                size += len(t)
        if texts:
            yield block(names, texts)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Token ids of every whole text.

    Pre-tokens leave their documents as blocks of distinct words with positions. The words of all
    blocks meet by hash bucket, where each distinct one is encoded once; the ids go back to the
    blocks, which put them together by position. The texts are split twice, once for each, which keeps
    positions off the disk but for one shuffle; a block that didn't get all its words back, in their order, stops the
    job. ``docs`` is a stored table, whose scan is split alike both times. No special tokens. Null text: as empty; repeated
    rows each give a row; an empty table gives none; other columns are not read.
    Result: doc_id, ids (little-endian unsigned 32-bit integers).
    """
    buckets = partitions(docs.sparkSession)

    def encode_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        coder = tiktoken.Encoding("ranks", pat_str=r"[\s\S]+", mergeable_ranks=load_ranks(ranks_path), special_tokens={})
        known: dict[bytes, list[int]] = {}
        for batch in batches:
            out = []
            for row in batch.itertuples():
                ids = []
                for w in _unpack_words(row.lengths, row.data):
                    if w not in known:
                        known[w] = coder.encode_ordinary(w.decode())
                    ids.append(known[w])
                lengths = np.array([len(i) for i in ids], "<u4")
                flat = np.array([i for one in ids for i in one], "<u4")
                out.append((row.block, row.numbers, _pack(lengths), _pack(flat), row.check))
            yield pd.DataFrame(out, columns=["block", "numbers", "lengths", "ids", "check"])

    words = split_blocks(docs, pattern, buckets, False).select("block", "bucket", "numbers", "lengths", "data", "check")
    encoded = words.repartition(buckets, "bucket").mapInPandas(encode_words, "block long, numbers binary, lengths binary, ids binary, check long")

    def assemble(key, held: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        numbers = [_unpack(x, "<u4") for x in answers["numbers"]]
        size = sum(map(len, numbers))
        start, length, shift = np.zeros(size, np.int64), np.zeros(size, np.int64), 0
        flat = [np.zeros(0, "<u4")]
        for n, row in zip(numbers, answers.itertuples(), strict=True):
            lengths = _unpack(row.lengths, "<u4").astype(np.int64)
            start[n] = shift + np.cumsum(lengths) - lengths
            length[n] = lengths
            flat.append(_unpack(row.ids, "<u4"))
            shift += int(lengths.sum())
        flat = np.concatenate(flat)
        out = []
        for row in held.itertuples():  # one for each block
            at, counts = _unpack(row.numbers, "<u4").astype(np.int64), _unpack(row.lengths, "<u4")
            (distinct, *names), absent, place = _unpack(row.names, "<i8").tolist(), _unpack(row.data, np.uint8), 0
            if distinct != size or (answers["check"] != row.check).any():
                raise RuntimeError(f"block {row.block} has {distinct} words, {size} came back, or in another order: its scan was split anew")
            for name, none, n in zip(names, absent.tolist(), counts.tolist(), strict=True):
                mine = at[place : place + n]
                place += n
                lengths = length[mine]
                shift = np.repeat(start[mine] - (np.cumsum(lengths) - lengths), lengths)
                out.append((None if none else name, flat[shift + np.arange(len(shift))].astype("<u4").tobytes()))
        return pd.DataFrame(out, columns=["doc_id", "ids"]).astype({"doc_id": "Int64"})

    held = split_blocks(docs, pattern, buckets, True).select("block", "numbers", "lengths", "data", "names", "check")
    return held.groupBy("block").cogroup(encoded.groupBy("block")).applyInPandas(assemble, "doc_id long, ids binary")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` with the bytes that its ids stand for as ``decoded``.

    The table of token bytes is as large as the vocabulary; every task joins its ids to it.
    """
    schema = StructType([*encoded.schema.fields, StructField("decoded", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = {rank: token for token, rank in load_ranks(ranks_path).items()}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [b"".join(map(table.__getitem__, np.frombuffer(x.as_py() or b"", "<u4").tolist())) for x in part.column("ids")]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], names=[*part.schema.names, "decoded"])

    return encoded.mapInArrow(run, schema)
