"""Periodic runs of words, found by a suffix automaton whose link tree is accessed word by word.

A run is a stretch that repeats itself with a period. The suffixes of a text that end at one word are a
way up the automaton's link tree. Appending a word gives that way a new colour, its place; the stretches of
the way that had one colour say where their strings ended last. A string of n words that ended q words
ago stands twice, q apart: a run with period q so far n + q long.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from epiframe.llm.common import blocks, mix

#: Words of the strings by whose repetition a stretch shows that it needs a search, at most.
GRAM = 4
#: Rounds in which stretches without repetition are left out; they only spare work.
TRIMS = 8
SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


class Automaton:
    """The suffix automaton of a sequence of numbers: length and link of each state, state of each prefix."""

    def __init__(self, words: list[int]):
        self.length, self.link, self.prefix = [0], [-1], []
        length, link, steps = self.length, self.link, [{}]
        last = 0
        for word in words:
            new = len(length)
            length.append(length[last] + 1)
            link.append(0)
            steps.append({})
            p = last
            while p >= 0 and word not in steps[p]:
                steps[p][word] = new
                p = link[p]
            if p >= 0:
                q = steps[p][word]
                if length[p] + 1 == length[q]:
                    link[new] = q
                else:
                    copy = len(length)
                    length.append(length[p] + 1)
                    link.append(link[q])
                    steps.append(steps[q].copy())
                    while p >= 0 and steps[p].get(word) == q:
                        steps[p][word] = copy
                        p = link[p]
                    link[q] = link[new] = copy
            self.prefix.append(new)
            last = new


class Access:
    """A link-cut tree over a fixed tree: preferred ways, each a splay tree by depth with one colour.

    Nodes are numbers from 1 on; ``up`` gives each node's parent, 0 for none.
    """

    def __init__(self, up: list[int]):
        n = len(up)
        self.up, self.left, self.right, self.colour = up, [0] * n, [0] * n, [-1] * n

    def _splay(self, x: int) -> None:
        """Make x the root of its way's splay tree; the colour stands at the root."""
        up, left, right = self.up, self.left, self.right
        p = up[x]
        if not p or (left[p] != x and right[p] != x):
            return
        while True:
            p = up[x]
            if not p or (left[p] != x and right[p] != x):
                return
            g = up[p]
            inner = g and (left[g] == p or right[g] == p)
            if inner:
                first = p if (left[g] == p) == (left[p] == x) else x
                turns = (first, x)
            else:
                turns = (x,)
            for y in turns:
                z = up[y]
                above = up[z]
                if left[z] == y:
                    child = left[z] = right[y]
                    right[y] = z
                else:
                    child = right[z] = left[y]
                    left[y] = z
                if child:
                    up[child] = z
                up[z] = y
                up[y] = above
                if above:
                    if left[above] == z:
                        left[above] = y
                    elif right[above] == z:
                        right[above] = y

    def _root(self, x: int) -> int:
        up, left, right = self.up, self.left, self.right
        while (p := up[x]) and (left[p] == x or right[p] == x):
            x = p
        return x

    def access(self, node: int, colour: int) -> list[tuple[int, int]]:
        """Give the way from ``node`` to its root a colour; the old colours on it, each with its lowest node."""
        up, right, colours = self.up, self.right, self.colour
        found, below, x = [], 0, node
        while x:
            old = colours[self._root(x)]
            self._splay(x)
            if right[x]:  # what hangs below keeps its colour and becomes a way of its own
                colours[right[x]] = old
            right[x] = below
            colours[x] = old
            if old >= 0:
                found.append((old, x))
            below, x = x, up[x]
        colours[below] = colour
        return found


def runs_of(words: list[int], least: int, exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``words``, by start, then period.

    A run has a length of at least ``least`` and ``exponent`` (two or more) times its smallest period,
    and no neighbouring word extends it.
    """
    automaton = Automaton(words)
    length = automaton.length
    # Shorter strings than a run's repeated part can settle nothing: their states are no nodes.
    short = least - least // exponent
    up = [p if p > 0 and length[p] >= short else 0 for p in automaton.link]
    tree, ends = Access(up), {}
    for i, state in enumerate(automaton.prefix):
        for old, node in tree.access(state, i) if length[state] >= short else ():
            period = i - old
            whole = length[node] + period
            if whole >= exponent * period and whole >= least:
                ends[i - whole + 1, period] = i
    return sorted((start, end - start + 1, period) for (start, period), end in ends.items())


def _stretches(words: np.ndarray, texts: np.ndarray, least: int, exponent: int) -> list[tuple[int, int]]:
    """Parts of a block of texts that hold all their runs, as first word and end; most texts have none.

    In a run of period q each string of at most (length - 2 q + 1) words stands once more, q words off. So each
    word of a run is in a string that recurs inside the stretch, no further off than its ``exponent``-th part.
    """
    n, gram = len(words), min(GRAM, *(max(least, exponent * q) - 2 * q + 1 for q in range(1, least + 1)))
    if n < least:
        return []
    hashed = mix(words.astype(np.uint64) + np.uint64(1))
    grams = hashed[: n - gram + 1]
    for step in range(1, gram):
        grams = mix(grams * np.uint64(0xD6E8FEB86659FD93) + hashed[step : n - gram + 1 + step])
    starts = np.flatnonzero(texts[: n - gram + 1] == texts[gram - 1 :])
    owner = texts.astype(np.int64)
    size = np.bincount(owner)
    for _ in range(TRIMS):
        if not len(starts):
            return []
        order = starts[np.lexsort((starts, grams[starts], owner[starts]))]
        same = (grams[order[1:]] == grams[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
        gap = np.where(same, order[1:] - order[:-1], n + 1)
        near = np.minimum(np.append(gap, n + 1), np.insert(gap, 0, n + 1))
        live = np.sort(order[near * exponent <= size[owner[order]]])
        covered = np.zeros(n + 1, np.int32)
        np.add.at(covered, live, 1)
        np.add.at(covered, live + gram, -1)
        inside = np.cumsum(covered[:n]) > 0
        head = inside & np.insert((~inside[:-1]) | (texts[1:] != texts[:-1]), 0, True)
        number = np.where(inside, np.cumsum(head), 0)
        size = np.bincount(number, minlength=1)
        size[0] = 0
        number[size[number] < least] = 0
        left = live[number[live] > 0]
        done = len(left) == len(starts)
        owner, starts = number, left
        if done:
            break
    first = np.flatnonzero((owner > 0) & (np.insert(owner[:-1], 0, 0) != owner))
    last = np.flatnonzero((owner > 0) & (np.append(owner[1:], 0) != owner))
    return list(zip(first.tolist(), (last + 1).tolist(), strict=True))


class Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def periodic_runs(docs: DataFrame, change: Callable[[int | None, list[bytes]], list[bytes]] | None = None, least: int = 6, exponent: int = 4) -> DataFrame:
    """Every text's periodic runs of words, and its words without what repeats in them.

    Words are parted by blanks and the control characters from tab to carriage return. A run is a
    stretch of at least ``least`` words and ``exponent`` smallest periods that no neighbouring word
    extends with that period. A word goes if a run contains it after its first period. ``change`` may replace the
    words of a document before the search. Each text is searched whole and alone, in a few hundred bytes a
    word of those stretches that repeat at all; nothing is shuffled. Null and empty texts
    have no words and no runs; null ids stay; repeated rows each give a row; an empty table gives none;
    other columns are not read.
    Result: doc_id, n_words, runs (start, length, period; by start, then period), collapsed (kept
    words joined by one blank).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        for batch in batches:
            for first, end, raw, starts in blocks(batch, limit=1 << 21):
                names = batch.column("doc_id").slice(first, end - first)
                text = raw.tobytes()
                held = [text[a:b].split() for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
                if change is not None:
                    held = [change(name, words) for name, words in zip(names.to_pylist(), held, strict=True)]
                number = Numbers().__getitem__
                counts = np.array([len(words) for words in held], np.int64)
                flat = np.fromiter((number(w) for words in held for w in words), np.int64, int(counts.sum()))
                begin = np.cumsum(counts) - counts
                texts = np.repeat(np.arange(len(held)), counts)
                found: list[list[tuple[int, int, int]]] = [[] for _ in held]
                for a, b in _stretches(flat, texts, least, exponent):
                    row = int(texts[a])
                    shift = a - int(begin[row])
                    found[row] += [(start + shift, length, period) for start, length, period in runs_of(flat[a:b].tolist(), least, exponent)]
                collapsed = []
                for words, runs in zip(held, found, strict=True):
                    runs.sort(key=lambda r: (r[0], r[2]))
                    if runs:
                        stay = np.ones(len(words), bool)
                        for start, length, period in runs:
                            stay[start + period : start + length] = False
                        words = [words[i] for i in np.flatnonzero(stay).tolist()]
                    collapsed.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays(
                    [names, pa.array(counts),
                     pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for runs in found],
                              pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")]))),
                     pa.array(collapsed, pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def planted(name: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a document, in every tenth one repeated from some word on.

    With h the checksum of the decimal id and g its tenth part, documents with h % 10 = 0 repeat their
    words from number g % n on with period 1 + (n - g % n) // (3 + g % 8). A null id changes nothing.
    """
    if name is None or not words or (h := zlib.crc32(str(name).encode())) % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    part = words[a : a + period]
    return words[:a] + (part * (-(-(n - a) // len(part))))[: n - a]
