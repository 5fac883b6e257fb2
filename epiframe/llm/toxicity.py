"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

Every word enters as an embedding of itself and the mean embedding of its character four-grams. The
network reads overlapping windows of words in both directions, pools the states by attention, and gives
a logit a window; a document's score follows its highest window.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from epiframe.llm.common import Hashes, blocks

WINDOW, STRIDE = 32, 24
BUCKETS, WIDTH, STATE = 1 << 13, 8, 8
#: Words beyond this many make a task's table of words start anew.
TABLE = 1 << 18

#: A-Z to lower case, ASCII punctuation to blanks.
PLAIN = bytes(
    ord(chr(i).lower()) if chr(i) in string.ascii_uppercase else 32 if chr(i) in string.punctuation else i for i in range(256))


class Words(dict):
    """Numbers of distinct words, and their embedding buckets once settled."""

    def __init__(self):
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self)
        self.new.append(word)
        return at

    def settle(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the words new since the last call: word buckets, four-gram buckets, first four-gram of each."""
        flat = b"".join(b"\x01" + w + b"\x02\x02" for w in self.new)
        sizes = np.array([len(w) + 3 for w in self.new], np.int64)
        self.new = []
        ends = np.cumsum(sizes)
        hashes = Hashes(np.frombuffer(flat, np.uint8))
        whole = (hashes.of(ends - sizes, ends) >> np.uint64(20)) % np.uint64(BUCKETS)
        grams = (hashes.grams(4) >> np.uint64(20)) % np.uint64(BUCKETS)
        inside = np.ones(len(flat), bool)
        for back in (1, 2, 3):  # a four-gram doesn't run into the next word
            inside[ends - back] = False
        first = np.cumsum(sizes - 3) - (sizes - 3)
        return whole.astype(np.int64), grams.astype(np.int64)[inside[: len(grams)]], first


def windows(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and first token (within the text) of every window over texts of these sizes."""
    counts = np.where(sizes > 0, 1 + np.maximum(0, -(-(sizes - WINDOW) // STRIDE)), 0)
    text = np.repeat(np.arange(len(sizes)), counts)
    return text, (np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)) * STRIDE


def _sigmoid(x):
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Network:
    """The parameters, and passes over a batch of windows (steps x windows x width)."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)

        def random(*shape, scale=0.3):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        # Words never seen in training then say nothing by themselves.
        self.p = {"word": np.zeros((BUCKETS, WIDTH), np.float32), "char": random(BUCKETS, WIDTH, scale=0.1)}
        for d in "fb":
            self.p |= {f"W{d}": random(2 * WIDTH, 3 * STATE), f"U{d}": random(STATE, 3 * STATE), f"b{d}": np.zeros(3 * STATE, np.float32)}
        self.p |= {"A": random(2 * STATE, STATE), "a": np.zeros(STATE, np.float32), "v": random(STATE), "o": random(2 * STATE), "c": np.zeros(1, np.float32)}

    def inputs(self, whole: np.ndarray, grams: np.ndarray, first: np.ndarray) -> np.ndarray:
        if not len(whole):
            return np.zeros((0, 2 * WIDTH), np.float32)
        sizes = np.diff(np.append(first, len(grams)))
        mean = np.concatenate([
            np.add.reduceat(self.p["char"][grams[a:b]], first[i : i + 4096] - a, axis=0)
            for i in range(0, len(first), 4096)
            for a, b in [(first[i], first[i + 4096] if i + 4096 < len(first) else len(grams))]]) / sizes[:, None]
        return np.concatenate([self.p["word"][whole], mean], axis=1).astype(np.float32)

    def gates(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x @ self.p["Wf"] + self.p["bf"], x @ self.p["Wb"] + self.p["bb"]

    def _run(self, gates: np.ndarray, mask: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        steps, n, _ = gates.shape
        h = np.zeros((n, STATE), np.float32)
        states = np.empty((steps, n, STATE), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            u = h @ self.p[f"U{d}"]
            zr = _sigmoid(gates[t, :, : 2 * STATE] + u[:, : 2 * STATE])
            z, r = zr[:, :STATE], zr[:, STATE:]
            new = np.tanh(gates[t, :, 2 * STATE :] + r * u[:, 2 * STATE :])
            m = mask[t][:, None]
            if keep is not None:
                keep.append((t, h, z, r, new, u[:, 2 * STATE :], m))
            h = h + m * (1 - z) * (new - h)
            states[t] = h
        return states

    def logits(self, forward: np.ndarray, backward: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        kept = ([], []) if keep is not None else (None, None)
        s = np.concatenate([self._run(forward, mask, "f", kept[0]), self._run(backward, mask, "b", kept[1])], axis=2)
        hidden = np.tanh(s @ self.p["A"] + self.p["a"])
        e = np.where(mask > 0, hidden @ self.p["v"], -1e9)
        e = np.exp(e - e.max(0))
        weight = e / e.sum(0)
        pooled = (weight[:, :, None] * s).sum(0)
        if keep is not None:
            keep.update(s=s, hidden=hidden, weight=weight, pooled=pooled, runs=kept)
        return pooled @ self.p["o"] + self.p["c"][0]

    def gradients(self, x: np.ndarray, mask: np.ndarray, label: np.ndarray) -> tuple[dict, np.ndarray]:
        """Of the mean cross entropy, for all but the embeddings; and with respect to ``x``."""
        keep: dict = {}
        forward, backward = self.gates(x)
        logit = self.logits(forward, backward, mask, keep)
        p, g = self.p, {}
        error = (_sigmoid(logit) - label) / len(label)
        g["o"], g["c"] = keep["pooled"].T @ error, np.array([error.sum()])
        pooled = error[:, None] * p["o"]
        s, weight, hidden = keep["s"], keep["weight"], keep["hidden"]
        ds = weight[:, :, None] * pooled
        dw = (s * pooled).sum(2)
        de = weight * (dw - (weight * dw).sum(0))
        g["v"] = np.einsum("tn,tnk->k", de, hidden)
        dh = de[:, :, None] * p["v"] * (1 - hidden**2)
        g["A"], g["a"] = np.einsum("tni,tnk->ik", s, dh), dh.sum((0, 1))
        ds = ds + dh @ p["A"].T
        dx = np.zeros_like(x)
        for d, run, part in zip("fb", keep["runs"], (ds[:, :, :STATE], ds[:, :, STATE:]), strict=True):
            U, carried = p[f"U{d}"], 0.0
            dgates, gu = np.zeros(x.shape[:2] + (3 * STATE,), np.float32), np.zeros_like(U)
            for t, h, z, r, new, un, m in reversed(run):
                total = part[t] + carried
                dnew = total * m * (1 - z) * (1 - new**2)
                dz = total * m * (h - new) * z * (1 - z)
                dr = dnew * un * r * (1 - r)
                du = np.concatenate([dz, dr, dnew * r], axis=1)
                dgates[t] = np.concatenate([dz, dr, dnew], axis=1)
                gu += h.T @ du
                carried = total * (1 - m * (1 - z)) + du @ U.T
            g[f"U{d}"], g[f"b{d}"] = gu, dgates.sum((0, 1))
            g[f"W{d}"] = np.einsum("tni,tnk->ik", x, dgates)
            dx += dgates @ p[f"W{d}"].T
        return g, dx


def _tokens(text: bytes) -> list[bytes]:
    return text.translate(PLAIN).split()


def _evidence(texts: list[list[int]], labels: np.ndarray, features: tuple, n_words: int) -> np.ndarray:
    """For each word, how far it or one of its four-grams leans to label 1 in whole texts."""
    whole, grams, first = features
    last = np.append(first[1:], len(grams))
    seen = {1: Counter(), 0: Counter()}
    for text, label in zip(texts, labels.tolist(), strict=True):
        words = np.unique(np.array(text, np.int64))
        own = [grams[first[w] : last[w]] for w in words.tolist()]
        seen[label].update(np.unique(np.concatenate([whole[words] + BUCKETS, *own])).tolist())
    ones, zeros = max(1, int(labels.sum())), max(1, int((1 - labels).sum()))
    lean = np.zeros(2 * BUCKETS)
    for feature, n in seen[1].items():
        if n >= 3:
            lean[feature] = np.log((n + 0.5) / (ones + 1)) - np.log((seen[0][feature] + 0.5) / (zeros + 1))
    return np.maximum(lean[whole + BUCKETS], np.maximum.reduceat(lean[grams], first)) if n_words else np.zeros(0)


class Scorer:
    """A trained network with the line from its highest logit to a score."""

    def __init__(self, network: Network | None, middle: float, slope: float, constant: float = 0.0):
        self.network, self.middle, self.slope, self.constant = network, middle, slope, constant

    def score(self, highest: np.ndarray) -> np.ndarray:
        if self.network is None:
            return np.full(len(highest), self.constant)
        return np.where(np.isfinite(highest), 1 / (1 + np.exp(-np.clip(self.slope * (highest - self.middle), -30, 30))), 0.0)


def _highest(network: Network, forward: np.ndarray, backward: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The highest window logit of each text; -inf for a text without words."""
    starts = np.cumsum(sizes) - sizes
    text, offset = windows(sizes)
    out = np.full(len(sizes), -np.inf)
    for a in range(0, len(text), 2048):
        t, o = text[a : a + 2048], offset[a : a + 2048]
        place = o + np.arange(WINDOW)[:, None]
        mask = (place < sizes[t]).astype(np.float32)
        at = flat[np.minimum(starts[t] + place, len(flat) - 1)]
        np.maximum.at(out, t, network.logits(forward[at], backward[at], mask))
    return out


def fit(texts: list[bytes], labels: np.ndarray, steps: int = 400, seed: int = 11) -> Scorer:
    """Train on whole labelled texts; the windows with the most evidence stand for texts of label 1."""
    if not len(labels) or labels.min() == labels.max():
        return Scorer(None, 0.0, 1.0, float(labels[0]) if len(labels) else 0.0)
    table = Words()
    rows = [[table[w] for w in _tokens(t)] for t in texts]
    labels = labels[[i for i, r in enumerate(rows) if r]]
    rows = [r for r in rows if r]
    features = table.settle()
    whole, grams, first = features
    last = np.append(first[1:], len(grams))
    lean = _evidence(rows, labels, features, len(table))
    sizes = np.array([len(r) for r in rows])
    flat = np.concatenate([np.array(r, np.int64) for r in rows])
    starts = np.cumsum(sizes) - sizes
    text, offset = windows(sizes)
    place = offset + np.arange(WINDOW)[:, None]
    mask = (place < sizes[text]).astype(np.float32)
    at = flat[np.minimum(starts[text] + place, len(flat) - 1)]
    proof = np.where(mask > 0, lean[at], -9).max(0)
    best = np.full(len(rows), -np.inf)
    np.maximum.at(best, text, proof)
    rng = np.random.default_rng(seed)
    positive = np.flatnonzero((labels[text] == 1) & (proof >= best[text] - 0.5))
    negative = np.flatnonzero(labels[text] == 0)
    hard = negative[np.argsort(-proof[negative], kind="stable")[: len(positive)]]
    network = Network(seed)
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in network.p.items()}
    step = 0
    while step < steps:
        chosen = np.concatenate([positive, hard, rng.choice(negative, min(len(negative), 2 * len(positive)), replace=False)])
        rng.shuffle(chosen)
        for a in range(0, len(chosen), 128)[: steps - step]:
            own = chosen[a : a + 128]
            tokens, m = at[:, own], mask[:, own]
            used, inverse = np.unique(tokens, return_inverse=True)
            spans = [grams[first[w] : last[w]] for w in used.tolist()]
            counts = np.array([len(s) for s in spans])
            own_grams = np.concatenate(spans)
            x = network.inputs(whole[used], own_grams, np.cumsum(counts) - counts)[inverse.reshape(tokens.shape)]
            told = np.ones(x.shape, np.float32)  # half of the words must be known by their characters
            told[:, :, :WIDTH] = rng.random(tokens.shape)[:, :, None] < 0.5
            x = x * told
            g, dx = network.gradients(x, m, labels[text[own]].astype(np.float32))
            by_word = np.zeros((len(used), 2 * WIDTH), np.float32)
            np.add.at(by_word, inverse.ravel(), (dx * told).reshape(-1, 2 * WIDTH))
            g["word"], g["char"] = np.zeros_like(network.p["word"]), np.zeros_like(network.p["char"])
            np.add.at(g["word"], whole[used], by_word[:, :WIDTH])
            np.add.at(g["char"], own_grams, np.repeat(by_word[:, WIDTH:] / counts[:, None], counts, axis=0))
            step += 1
            for k, v in network.p.items():  # Adam
                mean, square = moments[k]
                mean += 0.1 * (g[k] - mean)
                square += 0.001 * (g[k] ** 2 - square)
                v -= (0.01 * mean / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    forward, backward = network.gates(network.inputs(*features))
    highest = _highest(network, forward, backward, flat, sizes)
    order = np.sort(highest)
    middles = (order[1:] + order[:-1]) / 2
    rank = np.searchsorted(np.sort(highest[labels == 1]), middles), np.searchsorted(np.sort(highest[labels == 0]), middles)
    wrong = rank[0] / (labels == 1).sum() + 1 - rank[1] / (labels == 0).sum()
    ties = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    middle = float(middles[ties[len(ties) // 2]])
    return Scorer(network, middle, 1.0)


def train(docs: DataFrame, labels: DataFrame, usable: Column, each: int = 1000) -> Scorer:
    """A scorer learnt from whole texts of labelled documents, at most ``each`` of either label.

    The sample is bounded by that parameter and drawn by a hash of the id; only rows for which
    ``usable`` holds lend their labels. Null labels and ids don't count; a repeated id is toxic if any
    of its rows is, and of its texts the least counts.
    """
    marked = labels.filter(usable & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = None
    for value in (0, 1):
        part = marked.filter(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(each)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")).collect()  # 2 * each at most
    rows = sorted(rows, key=lambda r: r["doc_id"])
    return fit([bytes(r["text"]) for r in rows], np.array([r["toxic"] for r in rows], np.int64))


def score(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """doc_id, n_windows and score of every whole text: all its overlapping windows are read.

    Null and empty texts, and those without a word, have no window and score 0; repeated rows are
    scored each; an empty table gives no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = held.value
        table, forward, backward = Words(), None, None
        for batch in batches:
            for first, end, raw, starts in blocks(batch, limit=1 << 21):
                text, sizes, found = raw.tobytes().translate(PLAIN), [], []
                if len(table) > TABLE:
                    table, forward, backward = Words(), None, None
                for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                    words = text[a:b].split()
                    sizes.append(len(words))
                    found.append(np.fromiter(map(table.__getitem__, words), np.int64, len(words)))
                sizes, flat = np.array(sizes, np.int64), np.concatenate(found)
                highest = np.full(len(sizes), -np.inf)
                if scorer.network is not None and len(flat):
                    if table.new:
                        more = scorer.network.gates(scorer.network.inputs(*table.settle()))
                        forward, backward = more if forward is None else (np.concatenate(x) for x in zip((forward, backward), more, strict=True))
                    highest = _highest(scorer.network, forward, backward, flat, sizes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, end - first), pa.array(np.bincount(windows(sizes)[0], minlength=len(sizes))), pa.array(scorer.score(highest))],
                    names=["doc_id", "n_windows", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_windows long, score double")
