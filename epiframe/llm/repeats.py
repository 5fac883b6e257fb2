"""Removal of long byte strings that stand more than once in the corpus.

Ranking every byte position by prefix doubling would send the whole text through each shuffle many
times over. Here the positions that are ranked are chosen by content: of every ``threshold`` bytes
the gram with the least hash is the anchor, so equal strings have their anchor at the same offset.
A rank is an equality class of bytes at a given offset from the anchor. Round by round the ranked
string grows from the gram towards the threshold; a position whose rank is unique leaves, as no longer
string of its kind repeats, and one whose whole surroundings share a rank is past the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from epiframe.llm.common import Hashes, Scratch, blocks, salted

KEY = ["doc_id", "text_hash"]
#: Widths of the ranges of window starts that are told apart in the rounds after the first.
WIDTHS = (16, 4, 1)
PLACE = (1 << 28) - 1
#: Bytes of a block in which anchors are sought at once; places in it must fit into PLACE.
PIECE = 1 << 26


def find_anchors(raw: np.ndarray, starts: np.ndarray, threshold: int, gram: int):
    """Anchor, first and last start of its windows, gram hash, hash of the whole stretch, row."""
    if len(raw) < threshold:
        return None
    hashes = Hashes(raw)
    grams = hashes.grams(gram)
    least = (grams & np.uint64(~PLACE & ((1 << 64) - 1))) | np.arange(len(grams), dtype=np.uint64)
    span, width = threshold - gram + 1, 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if span > width:
        least = np.minimum(least[: width - span], least[span - width :])
    inside = np.ones(len(least), bool)
    for end in starts[1:-1].tolist():
        inside[max(0, end - threshold + 1) : end] = False
    window = np.flatnonzero(inside)
    if not len(window):
        return None
    anchor = (least[window] & np.uint64(PLACE)).astype(np.int64)
    new = np.flatnonzero((np.diff(anchor, prepend=-1) != 0) | (np.diff(window, prepend=-2) != 1))
    anchor, low, high = anchor[new], window[new], window[np.append(new[1:], len(window)) - 1]
    whole = salted(hashes.of(low, high + threshold), anchor - low, high - low)
    return anchor, low, high, grams[anchor], whole, np.searchsorted(starts, low, "right") - 1


def find_in_pieces(raw: np.ndarray, starts: np.ndarray, threshold: int, gram: int, piece: int = PIECE):
    """What ``find_anchors`` gives, for blocks of any length: pieces overlap by all but one byte of a window.

    An anchor whose windows start in two pieces comes as two rows.
    """
    if len(raw) <= piece + threshold:
        return find_anchors(raw, starts, threshold, gram)
    found = []
    for at in range(0, len(raw) - threshold + 1, piece):
        end = min(len(raw), at + piece + threshold - 1)
        first, last = np.searchsorted(starts, at, "right") - 1, np.searchsorted(starts, end, "left")
        part = find_anchors(raw[at:end], np.clip(starts[first : last + 1], at, end) - at, threshold, gram)
        if part is not None:
            anchor, low, high, grams, whole, row = part
            found.append((anchor + at, low + at, high + at, grams, whole, row + first))
    return tuple(map(np.concatenate, zip(*found, strict=True))) if found else None


def _anchors(docs: DataFrame, threshold: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, raw, starts in blocks(batch, limit=1 << 20):
                found = find_in_pieces(raw, starts, threshold, gram)
                if found is None:
                    continue
                anchor, low, high, grams, whole, row = found
                shift, rows = starts[row], pa.array(row + first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(rows), batch.column("text_hash").take(rows),
                     *(pa.array(x - shift) for x in (anchor, low, high)), pa.array(grams.astype(np.int64)), pa.array(whole.astype(np.int64))],
                    names=[*KEY, "anchor", "low", "high", "rank", "whole"])

    return docs.mapInArrow(run, "doc_id long, text_hash long, anchor long, low long, high long, rank long, whole long")


def _surroundings(docs: DataFrame, chosen: DataFrame, threshold: int) -> DataFrame:
    """The bytes that the windows of each chosen anchor span."""
    wanted = chosen.groupBy(*KEY).agg(F.collect_set(F.struct("anchor", "low", "high")).alias("at"))  # bounded by the text
    wanted = wanted.select(F.col("doc_id").alias("w_doc"), F.col("text_hash").alias("w_hash"), "at")
    held = docs.join(wanted, docs.doc_id.eqNullSafe(F.col("w_doc")) & (docs.text_hash == F.col("w_hash")))
    cut = F.explode("at").alias("at")
    return held.select(*KEY, F.col("text").cast("binary").alias("text"), cut).select(
        *KEY, "at.anchor", "at.low", "at.high",
        F.substring("text", (F.col("at.low") + 1).cast("int"), (F.col("at.high") - F.col("at.low") + threshold).cast("int")).alias("bytes"))


def _finer(held: DataFrame, width: int, threshold: int, gram: int) -> DataFrame:
    """Ranges of ``width`` window starts of each row, ranked by the bytes all windows of a range share.

    ``held`` has the anchor, its bytes from ``base`` on, and the range of windows to part.
    """
    farthest = threshold - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, raw, starts in blocks(batch, "bytes", 1 << 20):
                part = batch.slice(first, end - first)
                anchor, low, high, base = (part.column(c).to_numpy().astype(np.int64) for c in ("anchor", "low", "high", "base"))
                near, far = (anchor - high) // width, (anchor - low) // width
                times = far - near + 1
                row = np.repeat(np.arange(len(anchor)), times)
                step = np.repeat(near, times) + np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                left, right = step * width, np.minimum(step * width + width - 1, farthest)
                a, place = anchor[row], starts[row] - base[row]
                lows, highs = np.maximum(a - right, low[row]), np.minimum(a - left, high[row])
                hashes = Hashes(raw)
                rank = salted(hashes.of(a - left + place, a - right + threshold + place), step)
                whole = salted(hashes.of(lows + place, highs + threshold + place), a - lows, highs - lows)
                rows = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(rows), part.column("text_hash").take(rows), pa.array(a), pa.array(lows), pa.array(highs),
                     pa.array(rank.astype(np.int64)), pa.array(whole.astype(np.int64))],
                    names=[*KEY, "anchor", "low", "high", "rank", "whole"])

    return held.mapInArrow(run, "doc_id long, text_hash long, anchor long, low long, high long, rank long, whole long")


def repeated_windows(docs: DataFrame, threshold: int, gram: int, keep_first: bool, scratch: Scratch) -> DataFrame:
    """doc_id, text_hash, low, high: ranges of starts of ``threshold`` bytes that stand elsewhere too.

    ``docs`` has doc_id, text_hash and text; a pair of the first two names a text.
    """
    ranked = scratch.cut(_anchors(docs, threshold, gram), "anchors")
    shared = ranked.groupBy("rank").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("rank")
    alive = scratch.cut(ranked.join(shared, "rank", "left_semi"), "alive")
    scratch.drop(ranked)
    found, around = [], None
    for width in (*WIDTHS, None):
        # Rows that agree in all their windows are repeats as a whole. One of each such class goes
        # on, if its rank holds another class whose windows may agree in part.
        classes = alive.groupBy("rank", "whole").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct(*KEY, "anchor", "low", "high")).alias("one"))
        classes = scratch.cut(classes, "classes")
        several = classes.filter("n > 1").select("rank", "whole", "one")
        copies = alive.join(several, ["rank", "whole"])
        if keep_first:  # the first of a class is the first of all its strings, and goes on as such
            copies = copies.filter(~F.struct(*KEY, "anchor", "low", "high").eqNullSafe(F.col("one")))
        found.append(scratch.cut(copies.select(*KEY, "low", "high"), "found"))
        if width is None:
            break
        mixed = classes.groupBy("rank").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("rank")
        open_rows = scratch.cut(classes.join(mixed, "rank", "left_semi").select("one.*"), "open")
        scratch.drop(alive, classes)
        if around is None:
            around = scratch.cut(_surroundings(docs, open_rows, threshold), "around")
            held = around.withColumn("base", F.col("low"))
        else:
            whole = around.select(*KEY, "anchor", F.col("low").alias("base"), "bytes").alias("w")
            o = open_rows.alias("o")
            held = o.join(whole, F.col("o.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("o.text_hash") == F.col("w.text_hash")) & (F.col("o.anchor") == F.col("w.anchor"))
                          ).select("o.*", "w.base", "w.bytes")
        finer = scratch.cut(_finer(held, width, threshold, gram), f"width{width}")
        shared = finer.groupBy("rank").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("rank")
        alive = scratch.cut(finer.join(shared, "rank", "left_semi"), "alive")
        scratch.drop(finer, open_rows)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def remove_repeats(
    docs: DataFrame, threshold: int = 200, gram: int = 72, keep_first: bool = False, whole_characters: bool = False,
) -> DataFrame:
    """Documents with ``spans``, the byte ranges to remove, and ``kept``, the bytes that stay.

    A byte is removed if a string of ``threshold`` UTF-8 bytes that covers it also starts anywhere
    else, in the same document or another, overlapping or not. Strings are judged on the input. With
    ``keep_first`` the first copy of each string, by doc_id, text hash and place, doesn't count as
    such and stays; with ``whole_characters`` a range leaves a character that it cuts. Null text:
    as empty; ``gram`` is cut to the threshold; rows that repeat doc_id and text stand for texts of their own, so each is a repeat of
    the other; an empty table gives no rows; input columns named spans or kept give way, others may
    have any names.
    Result: the columns of ``docs``, spans (array of start and end, maximal), kept (binary).
    """
    if threshold < 1 or gram < 1:
        raise ValueError(f"threshold and gram must be 1 byte at least, not {threshold} and {gram}")
    gram = min(gram, threshold)  # a longer gram than the strings would miss some
    scratch = Scratch(docs.sparkSession)
    columns = [c for c in docs.columns if c.lower() not in ("spans", "kept")]
    key = [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_hash")]
    light, rows = docs.select(*key, "text"), docs.select(*key, F.struct(*columns).alias("held"))
    windows = repeated_windows(light, threshold, gram, keep_first, scratch)
    marks = windows.groupBy(*KEY).agg(F.collect_list(F.struct("low", "high")).alias("marks"))  # bounded by the text
    marks = scratch.cut(marks, "marks").select(F.col("doc_id").alias("m_doc"), F.col("text_hash").alias("m_hash"), "marks")
    joined = rows.join(marks, rows.doc_id.eqNullSafe(F.col("m_doc")) & (rows.text_hash == F.col("m_hash")), "left").select(
        "held", F.transform("marks", lambda x: x["low"]).alias("low"), F.transform("marks", lambda x: x["high"]).alias("high"))
    fields = joined.schema["held"].dataType.fields
    span = StructType([StructField("start", LongType()), StructField("end", LongType())])
    schema = StructType([*fields, StructField("spans", ArrayType(span)), StructField("kept", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = pa.RecordBatch.from_arrays(batch.column("held").flatten(), names=columns)
            for first, end, raw, starts in blocks(held):
                part, spans, kept = batch.slice(first, end - first), [], []
                for at, (low, high) in enumerate(zip(part.column("low"), part.column("high"), strict=True)):
                    text = raw[starts[at] : starts[at + 1]]
                    gone = merge(low.values.to_numpy(), high.values.to_numpy() + threshold) if low.is_valid else np.zeros((0, 2), np.int64)
                    if whole_characters and len(gone):
                        gone = inside_characters(text, gone)
                    spans.append([{"start": a, "end": b} for a, b in gone.tolist()])
                    edges = [0, *gone.ravel().tolist(), len(text)]
                    kept.append(b"".join(text[a:b].tobytes() for a, b in zip(edges[::2], edges[1::2], strict=True)))
                yield pa.RecordBatch.from_arrays(
                    [*held.slice(first, end - first).columns, pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                    names=[*columns, "spans", "kept"])

    return joined.mapInArrow(run, schema)


def merge(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Maximal ranges covered by the given ones, as rows of start and end."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.append(True, start[1:] > reach[:-1]))
    return np.column_stack([start[new], reach[np.append(new[1:], len(start)) - 1]])


def inside_characters(text: np.ndarray, ranges: np.ndarray) -> np.ndarray:
    """The ranges without the parts of characters at their edges."""
    heads = np.append(np.flatnonzero((text & 0xC0) != 0x80), len(text))
    start = heads[np.searchsorted(heads, ranges[:, 0])]
    end = heads[np.searchsorted(heads, ranges[:, 1], "right") - 1]
    return np.column_stack([start, end])[start < end]
