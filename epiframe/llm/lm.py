"""N-gram language model in an Elias-Fano trie, read through memory maps.

The vocabulary is ranked by word hash. Level 1 holds the words; level n holds, for every node of the
level above, the ids of the words that follow it, as one monotone sequence (each node's ids are
shifted by the last value of the node before) in Elias-Fano form, with monotone pointers to each
node's range. A query walks from level to level by successor search inside the range of its
context. Probabilities are quantised to one byte. Files lie in the shared folder, parted by ranges of
the first word; workers map them, so pages are shared and only what is touched is read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from epiframe.llm.common import LOWER, SPACES, Scratch, blocks, partitions

#: Scale of quantised log10 probabilities: byte q stands for -q / STEP.
STEP = 24.0
DISCOUNT = 0.75
#: Words beyond this many make a task's table of words start anew.
TABLE = 1 << 19
#: Tokens of which a task sums up the triples at once.
HELD = 2_000_000
END = b"\n"  # no word holds a blank, so the end has a name of its own
BLANK = np.zeros(256, bool)
BLANK[list(SPACES.encode())] = True


class EliasFano:
    """A monotone sequence: low bits packed, high bits in unary, with counts of ones per 64-bit word."""

    def __init__(self, low, high, counts, zeros, n: int, bits: int):
        self.low, self.high, self.counts, self.zeros, self.n, self.bits = low, high, counts, zeros, n, bits

    @staticmethod
    def build(values: np.ndarray) -> dict:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        place = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        raised = np.zeros(((int(place[-1]) if n else 0) // 64 + 2) * 64, np.uint8)
        raised[place] = 1
        high = np.packbits(raised, bitorder="little").view(np.uint64)
        counts = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)])
        low = values & np.uint64((1 << bits) - 1)
        packed = np.zeros(n * bits // 64 + 2, np.uint64)
        start = np.arange(n, dtype=np.int64) * bits
        word, shift = start >> 6, (start & 63).astype(np.uint64)
        np.bitwise_or.at(packed, word, low << shift)
        over = (shift + np.uint64(bits)) > np.uint64(64)
        np.bitwise_or.at(packed, word[over] + 1, low[over] >> (np.uint64(64) - shift[over]))
        return {"low": packed, "high": high, "counts": counts,
                "zeros": 64 * np.arange(len(counts), dtype=np.int64) - counts, "shape": np.array([n, bits], np.int64)}

    def _select(self, rank: np.ndarray, ones: bool) -> np.ndarray:
        """Places of the rank-th (from 0) one or zero of the high bits."""
        if ones:
            word = np.searchsorted(self.counts, rank, "right") - 1
            left = rank - self.counts[word]
            bits = self.high[word]
        else:
            word = np.searchsorted(self.zeros, rank, "right") - 1
            left = rank - self.zeros[word]
            bits = ~self.high[word]
        place = np.zeros(len(rank), np.int64)
        left = left.astype(np.int64)
        for width in (32, 16, 8, 4, 2, 1):  # halve the span that holds the wanted bit
            part = np.bitwise_count(bits & np.uint64((1 << width) - 1)).astype(np.int64)
            right = left >= part
            left -= np.where(right, part, 0)
            bits = np.where(right, bits >> np.uint64(width), bits)
            place += np.where(right, width, 0)
        return word * 64 + place

    def _ones(self, place: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """How many ones of the high bits stand from ``place`` on, before the zero of rank ``bucket``."""
        word, shift = place >> 6, (place & 63).astype(np.uint64)
        zeros = ~(self.high[word] >> shift)
        run = np.bitwise_count((zeros & (~zeros + np.uint64(1))) - np.uint64(1)).astype(np.int64)
        over = np.flatnonzero(run >= 64 - (place & 63))  # the run goes on in the next word
        run[over] = self._select(bucket[over], False) - place[over]
        return run

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(at), np.int64)
        start = at * self.bits
        word, shift = start >> 6, (start & 63).astype(np.uint64)
        value = self.low[word] >> shift
        over = (shift + np.uint64(self.bits)) > np.uint64(64)
        spill = np.where(over, self.low[np.minimum(word + 1, len(self.low) - 1)] << (np.uint64(64) - np.where(over, shift, np.uint64(1))), np.uint64(0))
        return ((value | spill) & np.uint64((1 << self.bits) - 1)).astype(np.int64)

    def at(self, index: np.ndarray) -> np.ndarray:
        """The values at these places."""
        return ((self._select(index, True) - index) << self.bits) | self._low(index)

    def pair(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values at these places and at the next ones."""
        place = self._select(index, True)
        rest = (self.high[place >> 6] >> (place & 63).astype(np.uint64)) >> np.uint64(1)
        following = place + 1 + np.bitwise_count((rest & (~rest + np.uint64(1))) - np.uint64(1)).astype(np.int64)
        over = np.flatnonzero(rest == 0)  # the next one lies in a later word
        following[over] = self._select(index[over] + 1, True)
        return ((place - index) << self.bits) | self._low(index), ((following - index - 1) << self.bits) | self._low(index + 1)

    def successor(self, value: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The first place in [first, last) whose value isn't less than ``value``; last if none is."""
        return self.seek(value, first, last)[0]

    def seek(self, value: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The successors' places, and whether the value there is ``value`` itself."""
        bucket = value >> self.bits
        limit = len(self.high) * 64 - int(self.counts[-1])  # zeros in all
        beyond = bucket >= limit  # greater than all values
        bucket = np.minimum(bucket, limit - 1)
        place = np.where(bucket > 0, self._select(np.maximum(bucket - 1, 0), False) + 1, 0)
        start = place - bucket  # values of smaller high part lie before
        low = np.where(beyond, last, np.clip(start, first, last))
        high = np.where(beyond, last, np.clip(np.minimum(start + self._ones(place, bucket), self.n), first, last))
        end, wanted = high.copy(), value & ((1 << self.bits) - 1)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):  # up to end the high parts are equal
                same = low < end
                same[same] = self._low(low[same]) == wanted[same]
                return low, same
            middle = (low[open_] + high[open_]) >> 1
            less = self._low(middle) < wanted[open_]
            low[open_] = np.where(less, middle + 1, low[open_])
            high[open_] = np.where(less, high[open_], middle)


def _local(path: str) -> str:
    """The shared folder as a mounted path: memory maps need one."""
    parsed = urlparse(path)
    if parsed.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped levels need a mounted shared folder, not {path}")
    return parsed.path


def _save(folder: str, name: str, arrays: dict) -> None:
    """Write once and rename, so that a repeated task leaves whole files."""
    os.makedirs(folder, exist_ok=True)
    for key, array in arrays.items():
        target = os.path.join(folder, f"{name}.{key}.npy")
        partial = f"{target}.{os.getpid()}.tmp.npy"
        np.save(partial, array)
        os.replace(partial, target)


def _open(folder: str, name: str, key: str) -> np.ndarray:
    return np.load(os.path.join(folder, f"{name}.{key}.npy"), mmap_mode="r").view(np.ndarray)


def _open_ef(folder: str, name: str) -> EliasFano:
    n, bits = _open(folder, name, "shape").tolist()
    return EliasFano(*(_open(folder, name, k) for k in ("low", "high", "counts", "zeros")), n, bits)


def word_hash(word: bytes) -> int:
    """63 bits of a keyed digest; ids are ranks among these."""
    return xxhash.xxh3_64_intdigest(word) >> 1


class WordTable(dict):
    """Numbers of the distinct words of a task."""

    def __init__(self):
        self.hashes: list[int] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self)
        self.hashes.append(word_hash(word))
        return at


def _words(raw: np.ndarray, starts: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The lower-cased words of a block of texts, its distinct ones numbered, and how many each text has."""
    raw = LOWER[raw]
    full = ~BLANK[raw]
    begins, ends = full.copy(), full.copy()
    begins[1:] &= ~full[:-1]
    ends[:-1] &= ~full[1:]
    edges = starts[1:-1]
    edges = edges[(edges > 0) & (edges < len(raw))]  # a word ends where its text does
    begins[edges], ends[edges - 1] = full[edges], full[edges - 1]
    first = np.flatnonzero(begins)
    offsets = np.concatenate([[0], np.cumsum(np.flatnonzero(ends) + 1 - first)])
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(first), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw[full]))])
    return words.dictionary_encode(), np.diff(np.searchsorted(first, starts))


def _tokens(batches: Iterator[pa.RecordBatch]):
    """Batch rows with the numbers of their tokens, each text's end included, and the table."""
    table = WordTable()
    for batch in batches:
        for first, end, raw, starts in blocks(batch):
            if len(table) > TABLE:
                table = WordTable()
            words, counts = _words(raw, starts)
            distinct = words.dictionary.to_pylist()
            numbers = np.fromiter(map(table.__getitem__, distinct), np.int64, len(distinct))
            ends = np.cumsum(counts + 1)
            flat = np.full(ends[-1], table[END], np.int64)
            inside = np.ones(len(flat), bool)
            inside[ends - 1] = False
            flat[inside] = numbers[words.indices.to_numpy()]
            yield batch.slice(first, end - first), np.split(flat, ends[:-1]), table


def _hashes(table: WordTable) -> np.ndarray:
    return np.array(table.hashes, np.int64)


class Model:
    """A trained model: where its levels lie, and the counts its formulas need."""

    def __init__(self, folder: str, words: int, tokens: int, shards: int, order: int = 2):
        self.folder, self.words, self.tokens, self.shards, self.order = folder, words, tokens, shards, order
        self.maps: dict = {}

    def __getstate__(self):
        return {**self.__dict__, "maps": {}}

    def vocabulary(self) -> tuple[np.ndarray, np.ndarray]:
        if "vocabulary" not in self.maps:
            parts = range(self.shards)
            self.maps["vocabulary"] = [(_open(self.folder, f"words-{i}", "hashes"), _open(self.folder, f"words-{i}", "counts")) for i in parts]
            self.maps["starts"] = np.concatenate([[0], np.cumsum([len(h) for h, _ in self.maps["vocabulary"]])])
        return self.maps["vocabulary"], self.maps["starts"]

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1: unknown) and training counts of word hashes."""
        parts, starts = self.vocabulary()
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        shard = shard_of(hashes, self.shards)
        for i in np.unique(shard):
            known, seen = parts[i]
            rows = np.flatnonzero(shard == i)
            if not len(known):
                continue
            rows = rows[np.argsort(hashes[rows])]
            at = np.minimum(np.searchsorted(known, hashes[rows]), len(known) - 1)
            same = known[at] == hashes[rows]
            ids[rows[same]] = starts[i] + at[same]
            counts[rows[same]] = seen[at[same]]
        return ids, counts

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1.0) / (self.tokens + self.words + 1.0))

    def followers(self, depth: int, shard: int) -> dict:
        if (depth, shard) not in self.maps:
            name = f"level{depth}-{shard}"
            self.maps[depth, shard] = {
                "pointers": _open_ef(self.folder, f"{name}-pointers"), "ids": _open_ef(self.folder, f"{name}-ids"),
                "probability": _open(self.folder, name, "probability"), "backoff": _open(self.folder, name, "backoff")}
        return self.maps[depth, shard]

    def descend(self, depth: int, shard: np.ndarray, node: np.ndarray, word: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 P(word | context), and the word's node of this depth (-1: none).

        ``node`` is the context's node of the level above, counted in its shard; -1: none, and ``lower``
        stays. ``word`` is -1 if unknown.
        """
        out, place = lower.copy(), np.full(len(node), -1, np.int64)
        known = np.flatnonzero(node >= 0)
        known = known[np.argsort((shard[known] << 40) | node[known])]
        parts, begin = np.unique(shard[known], return_index=True)
        for i, rows in zip(parts.tolist(), np.split(known, begin[1:]), strict=False):
            level = self.followers(depth, i)
            new = np.diff(node[rows], prepend=-1) != 0  # each context is read once
            nodes, which = node[rows[new]], np.cumsum(new) - 1
            first, last = level["pointers"].pair(nodes)
            backed = level["backoff"][nodes].astype(np.float64) / -STEP
            out[rows] = lower[rows] + backed[which]  # a context without followers has a backoff of 1
            base = np.zeros(len(nodes), np.int64)
            full = np.flatnonzero((last > first) & (first > 0))
            base[full] = level["ids"].at(first[full] - 1) + 1
            held = np.flatnonzero((last > first)[which] & (word[rows] >= 0))
            rows, which = rows[held], which[held]
            at, same = level["ids"].seek(base[which] + word[rows], first[which], last[which])
            found = np.flatnonzero(same)
            own = level["probability"][at[found]].astype(np.float64) / -STEP
            # discounted share of the n-gram, plus the share that falls to the lower order
            out[rows[found]] = np.log10(10.0**own + 10.0 ** out[rows[found]])
            place[rows[found]] = at[found]
        return out, place

    def shard_of_id(self, ids: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.vocabulary()[1], ids, "right") - 1

    def bigram(self, before: np.ndarray, word: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 P(word | before) and the pairs' nodes; -1: unknown words, or no such pair."""
        shard = self.shard_of_id(before)
        node = np.where(before >= 0, before - self.vocabulary()[1][np.maximum(shard, 0)], -1)
        return self.descend(2, shard, node, word, lower)

    def trigram(self, before: np.ndarray, pair: np.ndarray, word: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """log10 P(word | pair) for contexts by their first word and their node; -1: no such pair."""
        return self.descend(3, self.shard_of_id(before), pair, word, lower)[0]


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Equal ranges of the hash space, so that ranks run on from shard to shard."""
    return ((hashes >> 31) * shards >> 32).astype(np.int64)


def _quantise(log10: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(log10 * -STEP), 0, 255).astype(np.uint8)


def _distinct(u: np.ndarray, v: np.ndarray, w: np.ndarray, numbers: int) -> tuple[np.ndarray, ...]:
    """The distinct triples in ascending order, and how often each stands."""
    if numbers <= 1 << 21:
        key, hits = np.unique((u << 42) | (v << 21) | w, return_counts=True)
        return key >> 42, (key >> 21) & 0x1FFFFF, key & 0x1FFFFF, hits
    pairs, inverse = np.unique((u << 32) | v, return_inverse=True)
    key, hits = np.unique((inverse << 32) | w, return_counts=True)
    pairs = pairs[key >> 32]
    return pairs >> 32, pairs & 0xFFFFFFFF, key & 0xFFFFFFFF, hits


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of numbers under 2 ** 32 as one compressed string, by planes of bytes; the first as steps."""
    steps = np.diff(columns[0], prepend=0)
    planes = [np.ascontiguousarray(c.astype(np.uint32).view(np.uint8).reshape(-1, 4).T) for c in (steps, *columns[1:])]
    raw = np.concatenate([p.ravel() for p in planes])
    return len(columns[0]).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def _unpacked(blob: bytes, columns: int) -> list[np.ndarray]:
    n = int.from_bytes(blob[:8], "little")
    raw = np.frombuffer(pa.Codec("zstd").decompress(blob[8:], 4 * n * columns, asbytes=True), np.uint8).reshape(columns, 4, n)
    out = [np.ascontiguousarray(p.T).view(np.uint32).ravel().astype(np.int64) for p in raw]
    return [np.cumsum(out[0]), *out[1:]]


def _sorted_sums(u: np.ndarray, v: np.ndarray, w: np.ndarray, hits: np.ndarray, words: int) -> tuple[np.ndarray, ...]:
    """Triples in ascending order, those of equal words summed up."""
    bits = max(words, 1).bit_length()
    if int(u.max()).bit_length() + 2 * bits <= 63:
        order = np.argsort((u << (2 * bits)) | (v << bits) | w)
    else:
        order = np.lexsort((w, v, u))
    u, v, w = u[order], v[order], w[order]
    new = np.ones(len(u), bool)
    new[1:] = (u[1:] != u[:-1]) | (v[1:] != v[:-1]) | (w[1:] != w[:-1])
    first = np.flatnonzero(new)
    return u[first], v[first], w[first], np.add.reduceat(hits[order], first)


def train(texts: DataFrame, scratch: Scratch, shards: int | None = None, order: int = 2) -> Model:
    """Learn from the column ``text``: counts of words, pairs and, at ``order`` 3, triples, all of them.

    P(w) = (c + 1) / (N + V + 1); P(w | v) = max(c(vw) - D, 0) / c(v) + D f(v) / c(v) P(w), with f(v)
    the number of different followers of v, absolute discount D. Pairs lie inside a text, whose first
    word follows the end token. A task sums up what it reads before any row is shuffled. At order 3
    P(w | u v) = max(c(uvw) - D, 0) / c(uv.) + D f(uv) / c(uv.) P(w | v), where c(uv.) counts the pair with
    any follower; a text's first word has no pair before it and stays at P(w | v).
    """
    if order not in (2, 3):
        raise ValueError(f"order 2 or 3, not {order}")
    spark = texts.sparkSession
    shards = shards or partitions(spark)
    path = scratch.path("trie")
    folder = _local(path)

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = None, None
        for _, rows, now in _tokens(batches):
            if now is not table:
                if table is not None:
                    yield rows_of(table, total)
                table, total = now, np.zeros(0, np.int64)
            hits = np.bincount(np.concatenate(rows), minlength=len(now))
            hits[: len(total)] += total
            total = hits
        if table is not None:
            yield rows_of(table, total)

    def rows_of(table: WordTable, total: np.ndarray) -> pa.RecordBatch:
        hashes = _hashes(table)
        return pa.RecordBatch.from_arrays([pa.array(shard_of(hashes, shards)), pa.array(hashes), pa.array(total)], names=["shard", "word", "hits"])

    def write_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if parts:
            shard, word, hits = (np.concatenate([b.column(c).to_numpy() for b in parts]) for c in ("shard", "word", "hits"))
            for s in np.unique(shard):
                own = np.flatnonzero(shard == s)
                known, inverse = np.unique(word[own], return_inverse=True)
                counts = np.bincount(inverse, weights=hits[own]).astype(np.int64)
                _save(folder, f"words-{s}", {"hashes": known, "counts": counts})
                yield pa.RecordBatch.from_arrays([pa.array([int(s)]), pa.array([len(known)]), pa.array([int(counts.sum())])], names=["shard", "words", "tokens"])

    light = texts.select("text")
    words = light.mapInArrow(count_words, "shard long, word long, hits long").repartition(shards, "shard")
    totals = scratch.cut(words.mapInArrow(write_words, "shard long, words long, tokens long"), "words")
    by_shard = {r["shard"]: r for r in totals.collect()}  # a row for each shard
    for s in range(shards):
        if s not in by_shard:
            _save(folder, f"words-{s}", {"hashes": np.zeros(0, np.int64), "counts": np.zeros(0, np.int64)})
    model = Model(folder, sum(r["words"] for r in by_shard.values()), sum(r["tokens"] for r in by_shard.values()), shards, order)

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, held, size = None, [], 0

        def flush() -> pa.RecordBatch:
            pairs, hits = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            hits = np.bincount(hits, weights=np.concatenate([h[1] for h in held])).astype(np.int64)
            ids, _ = model.look_up(_hashes(table))
            before, after = ids[pairs >> 32], ids[pairs & 0xFFFFFFFF]
            _, starts = model.vocabulary()
            return pa.RecordBatch.from_arrays(
                [pa.array(np.searchsorted(starts, before, "right") - 1), pa.array(before), pa.array(after), pa.array(hits)], names=["shard", "before", "after", "hits"])

        for _, rows, now in _tokens(batches):
            if now is not table or size > 4_000_000:
                if held:
                    yield flush()
                table, held, size = now, [], 0
            flat = np.concatenate(rows)
            previous = np.empty_like(flat)
            previous[1:] = flat[:-1]
            previous[0] = now[END]  # each text's first word follows the end of the one before
            pairs, hits = np.unique((previous << 32) | flat, return_counts=True)
            held.append((pairs, hits))
            size += len(pairs)
        if held:
            yield flush()

    def write_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        shard, before, after, hits = (np.concatenate([b.column(c).to_numpy() for b in parts]) for c in ("shard", "before", "after", "hits"))
        for s in np.unique(shard):
            own = np.flatnonzero(shard == s)
            write_level(model, int(s), before[own], after[own], hits[own])
            yield pa.RecordBatch.from_arrays([pa.array([int(s)]), pa.array([len(own)])], names=["shard", "rows"])

    def count_triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Triples of each shard, packed; (u, end, end) stands for a pair at the end of a text."""
        table, held, size = None, [], 0

        def flush() -> pa.RecordBatch:
            ids, _ = model.look_up(_hashes(table))
            by_id = np.argsort(ids)
            rank = np.empty_like(by_id)
            rank[by_id] = np.arange(len(by_id))
            flat = rank[np.concatenate(held)]
            end = rank[table[END]]
            previous, following = np.empty_like(flat), np.empty_like(flat)
            previous[0], previous[1:] = end, flat[:-1]
            following[-1], following[:-1] = end, flat[1:]
            following[flat == end] = end
            u, v, w, hits = _distinct(previous, flat, following, len(ids))
            u, v, w = ids[by_id[u]], ids[by_id[v]], ids[by_id[w]]
            starts = model.vocabulary()[1]
            cuts = np.searchsorted(u, starts)
            found = np.flatnonzero(np.diff(cuts))
            packed = [_packed(u[a:b] - starts[s], v[a:b], w[a:b], hits[a:b]) for s, a, b in zip(found, cuts[found], cuts[found + 1], strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(found), pa.array(packed, pa.binary())], names=["shard", "triples"])

        for _, rows, now in _tokens(batches):
            if now is not table or size > HELD:
                if held:
                    yield flush()
                table, held, size = now, [], 0
            held.extend(rows)
            size += sum(map(len, rows))
        if held:
            yield flush()

    def write_triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed: dict[int, list] = {}
        for batch in batches:
            for s, blob in zip(batch.column("shard").to_pylist(), batch.column("triples").to_pylist(), strict=True):
                packed.setdefault(s, []).append(blob)
        ids, _ = model.look_up(np.array([word_hash(END)], np.int64))
        for s in sorted(packed):
            columns = [np.concatenate(c) for c in zip(*(_unpacked(blob, 4) for blob in packed.pop(s)), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([s]), pa.array([write_levels(model, s, int(ids[0]), *columns)])], names=["shard", "rows"])

    if order == 2:
        counted = light.mapInArrow(count_pairs, "shard long, before long, after long, hits long").repartition(shards, "shard")
        written = counted.mapInArrow(write_pairs, "shard long, rows long")
    else:
        counted = light.mapInArrow(count_triples, "shard long, triples binary").repartition(shards, "shard")
        written = counted.mapInArrow(write_triples, "shard long, rows long")
    done = {r["shard"] for r in scratch.cut(written, "grams").collect()}
    none = np.zeros(0, np.int64)
    for s in set(range(shards)) - done:
        write_level(model, s, none, none, none)
        if order == 3:
            write_nodes(model, f"level3-{s}", none, none, none, 0)
    return model


def write_level(model: Model, shard: int, before: np.ndarray, after: np.ndarray, hits: np.ndarray) -> None:
    """Level 2 of one shard: pointers, followers, their discounted shares, and backoffs."""
    parts, starts = model.vocabulary()
    counts = np.asarray(parts[shard][1], np.int64)
    order = np.lexsort((after, before))
    before, after, hits = before[order], after[order], hits[order]
    new = np.ones(len(before), bool)
    new[1:] = (before[1:] != before[:-1]) | (after[1:] != after[:-1])
    first = np.flatnonzero(new)
    hits = np.add.reduceat(hits, first) if len(first) else hits
    before, after = before[first] - starts[shard], after[first]
    write_nodes(model, f"level2-{shard}", before, after, hits, len(counts))


def write_levels(model: Model, shard: int, end: int, before: np.ndarray, middle: np.ndarray, after: np.ndarray, hits: np.ndarray) -> int:
    """Levels 2 and 3 of one shard from its triples, ``before`` counted in the shard: how many triples."""
    _, starts = model.vocabulary()
    before, middle, after, hits = _sorted_sums(before, middle, after, hits, model.words)
    new = np.ones(len(before), bool)
    new[1:] = (before[1:] != before[:-1]) | (middle[1:] != middle[:-1])
    first = np.flatnonzero(new)
    node = np.cumsum(new) - 1  # places of the pairs in level 2, which holds them in this order
    write_level(model, shard, before[first] + starts[shard], middle[first], np.add.reduceat(hits, first))
    whole = middle != end  # a pair at the end of a text has no follower
    write_nodes(model, f"level3-{shard}", node[whole], after[whole], hits[whole], len(first))
    return int(whole.sum())


def write_nodes(model: Model, name: str, node: np.ndarray, after: np.ndarray, hits: np.ndarray, nodes: int) -> None:
    """One level of a shard from its n-grams in ascending order of node and follower."""
    followers = np.bincount(node, minlength=nodes)
    pointers = np.concatenate([[0], np.cumsum(followers)])
    last = pointers[1:][followers > 0] - 1
    base = np.zeros(nodes, np.int64)
    base[followers > 0] = np.concatenate([[0], np.cumsum(after[last] + 1)[:-1]]) if len(last) else 0
    seen = np.bincount(node, weights=hits, minlength=nodes)
    with np.errstate(divide="ignore", invalid="ignore"):
        backoff = np.where(followers > 0, np.log10(DISCOUNT * followers / seen), 0.0)
        share = np.log10((hits - DISCOUNT) / seen[node])
    _save(model.folder, f"{name}-pointers", EliasFano.build(pointers))
    _save(model.folder, f"{name}-ids", EliasFano.build(base[node] + after))
    _save(model.folder, name, {"probability": _quantise(share), "backoff": _quantise(backoff)})


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, ids, counts = None, np.zeros(0, np.int64), np.zeros(0, np.int64)
        for part, rows, table in _tokens(batches):
            sizes = np.array([len(r) for r in rows])
            flat = np.concatenate(rows)
            if table is not known:
                known, ids, counts = table, ids[:0], counts[:0]
            new = np.array(table.hashes[len(ids):], np.int64)  # words that no block before had
            more = model.look_up(new) if model.words else (np.full(len(new), -1), np.zeros(len(new), np.int64))
            ids, counts = np.concatenate([ids, more[0]]), np.concatenate([counts, more[1]])
            base = model.unigram(counts)
            starts = np.cumsum(sizes) - sizes
            previous = np.empty_like(flat)
            previous[1:] = flat[:-1]
            previous[starts] = table[END] if END in table else 0
            pairs, inverse = np.unique((previous << 32) | flat, return_inverse=True)
            before, word = ids[pairs >> 32], ids[pairs & 0xFFFFFFFF]
            probability, node = model.bigram(before, word, base[pairs & 0xFFFFFFFF]) if model.words else (base[pairs & 0xFFFFFFFF], np.full(len(pairs), -1))
            each = probability[inverse]
            if model.order == 3 and model.words:
                later = np.ones(len(flat), bool)
                later[starts] = False  # a text's first word has no pair before it
                later = np.flatnonzero(later)
                triples, back = np.unique((inverse[later - 1] << 32) | inverse[later], return_inverse=True)
                context, now = triples >> 32, triples & 0xFFFFFFFF
                each[later] = model.trigram(before[context], node[context], word[now], probability[now])[back]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes.astype(np.int64)), pa.array(np.add.reduceat((counts[flat] > 0).astype(np.int64), starts)),
                 pa.array(np.add.reduceat(base[flat], starts)), pa.array(np.add.reduceat(each, starts))],
                names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return out.withColumn("train_tokens", F.lit(model.tokens).cast("long"))


def train_and_score(docs: DataFrame, held_out, order: int = 2) -> DataFrame:
    """Every document's log10 probability under a model, of this order, of those where ``held_out`` is false.

    A-Z are lower-cased; tokens are words between white space, then one end. A null text is empty:
    its end alone is scored. Repeated rows count and are scored each. With no training text every word is
    unknown and the end too. A null id is a training row. Other columns are not read.
    Result: doc_id, n_tokens, n_known, base_score, score, train_tokens.
    """
    scratch = Scratch(docs.sparkSession)
    model = train(docs.filter(~F.coalesce(held_out, F.lit(False))).select("text"), scratch, order=order)
    return score(docs, model)
