"""Packing by concatenation: one stream of tokens over all documents, cut into fixed windows."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from epiframe.llm.common import Scratch

#: A run of so much white space goes through the tokenizer itself: the quick coder's pattern looks back over it.
WIDE = re.compile(r"\s{2000}")
#: The pattern by which byte-level tokenizers of this kind part a text, a fixed value of theirs.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def quick_coder(held: dict):
    """A ``tiktoken`` coder with the ids of a byte-level BPE tokenizer file, None for another kind.

    It needs the plain byte alphabet, ids in the order of merges, and the standard splitting.
    """
    import tiktoken

    steps, model = held["pre_tokenizer"] or {}, held["model"]
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if held["normalizer"] or {k: steps.get(k) for k in plain} != plain or model["type"] != "BPE":
        return None
    if any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        return None
    # Visible Latin-1 characters stand for their own byte, the other bytes for characters from 256 on.
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    alphabet = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(own)))}
    merges = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
    special = {t["content"] for t in held["added_tokens"]}
    vocab = {t: i for t, i in model["vocab"].items() if t not in special}
    in_order = [vocab.get(m.replace(" ", "", 1)) for m in merges]
    if in_order != list(range(256, 256 + len(merges))) or len(vocab) != 256 + len(merges) or not all(set(t) <= alphabet.keys() for t in vocab):
        return None
    ranks = {bytes(alphabet[c] for c in token): i for token, i in vocab.items()}
    return tiktoken.Encoding("quick", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def coder(vocabulary: str) -> Callable[[str], list[int]]:
    """The ids of a text by the tokenizer file ``vocabulary``, without special tokens."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    tokenizer.encode_special_tokens = True
    with open(vocabulary, encoding="utf-8") as file:
        quick = quick_coder(json.load(file))

    def ids(text: str) -> list[int]:
        if quick is None or WIDE.search(text):
            return tokenizer.encode(text, add_special_tokens=False).ids
        return quick.encode_ordinary(text)

    return ids


def token_stream(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Every document's ids, ``end_id`` last, and their place among the tokens of its input partition.

    Result: part, at, doc_id, tokens, ids (little-endian unsigned 32-bit).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at, encode = TaskContext.get().partitionId(), 0, coder(vocabulary)
        for batch in batches:
            rows = iter(zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True))
            while some := list(islice(rows, 256)):
                ids = [np.array([*encode(text.as_py() or ""), end_id], "<u4") for _, text in some]
                n = np.array([len(i) for i in ids], np.int64)
                starts = at + np.cumsum(n) - n
                at += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(some), pa.int32()), pa.array(starts), pa.array([name for name, _ in some], pa.int64()), pa.array(n),
                     pa.array([i.tobytes() for i in ids], pa.binary())],
                    names=["part", "at", "doc_id", "tokens", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "part int, at long, doc_id long, tokens long, ids binary")


def windows(total: int, length: int) -> np.ndarray:
    """Starts and end of the last windows, those that are not full: one for each binary digit of the rest.

    So each is a power of two long, and nothing is padded.
    """
    rest = total % length
    sizes = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return total - rest + np.cumsum([0, *sizes])


def concat_and_cut(docs: DataFrame, vocabulary: str, length: int = 1024, end_id: int = 0) -> DataFrame:
    """Pieces of all documents in sequences of ``length`` tokens, without padding.

    Documents follow one another in the order of the scan, each ended by ``end_id``. A first pass writes
    the ids with their place in their input partition; prefix sums over the partitions' totals, a row
    for each, make places global, and a second pass cuts every document where windows end. A document
    over a boundary has a record on both sides, and no record moves between tasks. What is left after the last
    full window is cut into powers of two, largest first. Null text: as empty, the end id alone;
    null and repeated ids and repeated rows are documents of their own; an empty table gives no rows;
    other columns are not read.
    Result: doc_id, start (the document's tokens before the piece), length, ids (little-endian unsigned
    32-bit), doc_tokens, sequence_id, offset.
    """
    scratch = Scratch(docs.sparkSession)
    stream = scratch.cut(token_stream(docs, vocabulary, end_id), "tokens")
    totals = stream.groupBy("part").agg(F.max(F.col("at") + F.col("tokens")).alias("n"))
    before = F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    totals = totals.select("part", F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(W.partitionBy()).alias("total"))
    # One row for each partition of the input: some 30 bytes for each of its splits.
    placed = stream.join(F.broadcast(totals), "part").select("doc_id", (F.col("before") + F.col("at")).alias("place"), "tokens", "ids", "total")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            names = batch.column("doc_id")
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                rows, starts, parts, tokens, sequences, offsets = [], [], [], [], [], []
                for row, (place, n, ids, total) in enumerate(zip(*(part.column(c) for c in ("place", "tokens", "ids", "total")), strict=True), first):
                    place, n, total, ids = place.as_py(), n.as_py(), total.as_py(), ids.as_py()
                    if last is None:
                        last = windows(total, length)
                    at, full = 0, int(last[0])
                    while at < n:
                        here = place + at
                        if here < full:
                            sequence, offset = divmod(here, length)
                            end = (sequence + 1) * length
                        else:
                            tail = int(np.searchsorted(last, here, "right")) - 1
                            sequence, offset, end = full // length + tail, here - int(last[tail]), int(last[tail + 1])
                        stop = min(n, at + end - here)
                        rows.append(row)
                        starts.append(at)
                        parts.append(ids[4 * at : 4 * stop])
                        tokens.append(n)
                        sequences.append(sequence)
                        offsets.append(offset)
                        at = stop
                lengths = [len(p) // 4 for p in parts]
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(rows, pa.int64())), *(pa.array(c, pa.int64()) for c in (starts, lengths)), pa.array(parts, pa.binary()),
                     *(pa.array(c, pa.int64()) for c in (tokens, sequences, offsets))],
                    names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return placed.mapInArrow(cut, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, tokens, ids: the sequences themselves; a sequence has no more pieces than tokens."""
    parts = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    held = pieces.groupBy("sequence_id").agg(F.sum("length").alias("tokens"), parts.alias("parts"))
    return held.select("sequence_id", "tokens", F.unhex(F.array_join(F.transform("parts", lambda p: p["ids"]), "")).alias("ids"))
