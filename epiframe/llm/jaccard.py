"""Exact near-duplicate classes by Jaccard similarity of word shingles.

Sets meet in index lists by the tokens of their prefixes. Prefixes are longer than one common token
needs, so that a linked set must share many tokens of its own: sets that share fewer leave the lists,
again and again as lists thin out. A list is read by blocks of like size and skipped by position,
and a set's answers come from a highly similar set's: a set that links to a list's leader belongs
to the leader's class, and pairs inside a class are skipped from then on. Only pairs of different
classes are left for the exact comparison at the end.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from epiframe.llm.common import LOWER, SPACES, Hashes, Scratch, blocks, components, let, mix

BLANK = np.zeros(256, bool)
BLANK[list(SPACES.encode())] = True
#: A token in this share of all documents, at least, comes after all rarer ones in the order.
FREQUENT = 1 / 1000
#: Passes that take sets with too few shared tokens out of the lists; they only spare work.
PASSES = 3
#: Rounds of links to leaders before the exact comparison of what is left; they only spare it work.
ROUNDS, CENTRAL_ROUNDS = 6, 2
#: Lists of a set, from its first token on, in which it looks for leaders.
LEADER_LISTS = 16
#: Parts by hash in which sets are numbered and lists are built: only one part's shuffles are on disk at a time.
SLICES = 4
#: Numbers of 64 bits in the parity map of a set's tokens.
MAP = 16
MAPS = [f"m{w}" for w in range(MAP)]


def shingle_sets(raw: np.ndarray, starts: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text in a block."""
    raw = LOWER[raw]
    blank = BLANK[raw]
    begins = ~blank
    begins[1:] &= blank[:-1]
    inner = starts[1:-1][starts[1:-1] < len(raw)]
    begins[inner] = ~blank[inner]
    first = np.flatnonzero(begins)
    ends = ~blank
    ends[:-1] &= blank[1:]
    cut = starts[1:-1] - 1
    cut = cut[cut >= 0]
    ends[cut] = ~blank[cut]
    last = np.flatnonzero(ends) + 1
    words = Hashes(raw).of(first, last)
    bounds = np.searchsorted(first, starts)
    grams = words
    for step in range(1, size):  # a window of step + 1 words from that of step words
        grams = mix(grams[: len(words) - step] * np.uint64(0xD6E8FEB86659FD93) + words[step:]) if len(words) > step else words[:0]
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(grams[a : b - size + 1]))
        elif b > a:
            whole = np.uint64(b - a)
            for w in words[a:b]:
                whole = mix(np.array([whole * np.uint64(0xD6E8FEB86659FD93) + w], np.uint64))[0]
            out.append(np.array([whole], np.uint64))
        else:
            out.append(words[:0])
    return out


def extra(n, percent: int):
    """Prefix tokens beyond those one common token needs, for a number or a column of set sizes.

    Sets linked to one of ``n`` tokens share at least ``extra(n)`` tokens of both prefixes: the overlap
    reaches ``percent`` of the larger set, and what either set holds beyond its prefix is
    smaller than that by its extra tokens (one less where rounding is against it).
    """
    if percent * 3 < 100:
        return n * 0
    return F.floor(n * (100 - percent) / 200) if isinstance(n, Column) else n * (100 - percent) // 200


def prefix_length(n: int, percent: int) -> int:
    return min(n, n - (percent * n + 99) // 100 + 1 + extra(n, percent))


def _sets(docs: DataFrame, size: int, body, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        for batch in batches:
            for first, end, raw, starts in blocks(batch, limit=1 << 20):
                yield from body(batch.slice(first, end - first), shingle_sets(raw, starts, size))

    return docs.mapInArrow(run, schema)


def _digest(tokens: np.ndarray) -> bytes:
    return blake2b(tokens.tobytes(), digest_size=16).digest()


def frequent_tokens(docs: DataFrame, size: int, scratch: Scratch) -> np.ndarray:
    """Tokens in at least ``FREQUENT`` of the documents, as far as blocks of documents show it.

    They only settle the order in which prefixes take tokens: any order gives the same classes. At
    most (mean set size / FREQUENT) tokens can pass, whatever the number of documents.
    """

    def count(part: pa.RecordBatch, sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        tokens, hits = np.unique(np.concatenate(sets), return_counts=True)
        often = hits >= max(2, 2 * FREQUENT * len(sets))
        yield pa.RecordBatch.from_arrays(
            [pa.array(tokens[often].view(np.int64)), pa.array(hits[often])], names=["token", "hits"])

    found = scratch.cut(_sets(docs, size, count, "token long, hits long").groupBy("token").agg(F.sum("hits").alias("hits")), "frequent")
    least = max(4.0, docs.count() * FREQUENT)
    tokens = found.filter(F.col("hits") >= least).select("token").collect()
    return np.sort(np.array([r["token"] for r in tokens], np.int64).view(np.uint64))


def _prefixes(docs: DataFrame, size: int, percent: int, late) -> DataFrame:
    """doc_id, tag, node (digest of the set), n, and the set's first tokens in the global order."""

    def take(part: pa.RecordBatch, sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        nodes, sizes, prefixes = [], [], []
        for tokens in sets:
            sizes.append(len(tokens))
            nodes.append(_digest(tokens) if len(tokens) else None)
            last = np.zeros(0, bool)
            if len(late.value) and len(tokens):
                at = np.minimum(np.searchsorted(late.value, tokens), len(late.value) - 1)
                last = late.value[at] == tokens
            ordered = np.concatenate([tokens[~last], tokens[last]]) if len(last) else tokens
            prefixes.append(ordered[: prefix_length(len(tokens), percent)].view(np.int64) if len(tokens) else ordered.view(np.int64))
        offsets = np.zeros(len(sets) + 1, np.int32)
        np.cumsum([len(p) for p in prefixes], out=offsets[1:])
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("tag"), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(prefixes)))],
            names=["doc_id", "tag", "node", "n", "prefix"])

    return _sets(docs, size, take, "doc_id long, tag string, node binary, n long, prefix array<long>")


def _near_sizes(a: Column, b: Column, percent: int) -> Column:
    return (100 * a >= percent * b) & (100 * b >= percent * a)


def _may_link(a: Column, b: Column, shared: Column, percent: int) -> Column:
    """Whether sets of these sizes that share so many prefix tokens can be similar enough."""

    def rest(n: Column) -> Column:
        return F.greatest(F.ceil(n * percent / 100.0) - 1 - extra(n, percent), F.lit(0))

    return (100 + percent) * (shared + F.greatest(rest(a), rest(b))) >= percent * (a + b)


def _position_skip(a: Column, b: Column, i: Column, j: Column, percent: int) -> Column:
    """Whether sets of these sizes can be similar enough with a common token at these positions.

    Of two linked sets, what comes before the token and what comes after differ in number by no more
    than the tokens that only one of the sets holds.
    """
    return (100 + percent) * (F.abs(i - j) + F.abs((a - i) - (b - j))) <= (100 - percent) * (a + b)


def parity_map(tokens: np.ndarray) -> np.ndarray:
    """``MAP`` numbers whose bits tell whether an odd number of a set's tokens fall on them."""
    odd = np.bincount((tokens >> np.uint64(16)).astype(np.int64) & (64 * MAP - 1), minlength=64 * MAP) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _differ_little(a: Column, b: Column, maps_a: list[Column], maps_b: list[Column], percent: int) -> Column:
    """Whether sets of these sizes and parity maps can be similar enough.

    Each token that only one of the sets holds flips one bit, so at least as many tokens are not
    common as the maps have different bits. Tokens of both flip the same bit twice.
    """
    bits = sum((F.bit_count(x.bitwiseXOR(y)) for x, y in zip(maps_a, maps_b, strict=True)), F.lit(0))
    return (100 + percent) * bits <= (100 - percent) * (a + b)


class Join:
    """One run of the join: index lists, sets of the texts in them, links found so far.

    ``reps`` numbers the distinct sets; ``core`` has those that may have a link, with their shared
    prefix tokens; ``sets`` has the whole sets of these and their parity maps.
    """

    def __init__(self, docs: DataFrame, size: int, percent: int):
        self.docs, self.size, self.percent = docs, size, percent
        self.spark = docs.sparkSession
        self.scratch = Scratch(self.spark)
        late = self.spark.sparkContext.broadcast(frequent_tokens(docs, size, self.scratch))
        whole = self.scratch.cut(_prefixes(docs, size, percent, late), "members")
        parts = [self.numbered(whole, part) for part in range(SLICES)]
        self.members = self.scratch.cut(whole.select("doc_id", "tag", "node", "n"), "members")
        self.scratch.drop(whole)
        wide = reduce(DataFrame.unionByName, parts)
        core = self.shared(wide.select("id", "n", F.posexplode("prefix").alias("pos", "token")), SLICES)
        # Prefixes are not read again, so the sets stay without them.
        self.reps = self.scratch.cut(wide.drop("prefix"), "reps")
        self.scratch.drop(*parts)
        for _ in range(1, PASSES):
            wider, core = core, self.shared(core.select("id", "n", F.inline("prefix")).drop("df"))
            self.scratch.drop(wider)
        self.core = core
        self.sketches = core.select("id", "n", F.transform("prefix", lambda x: (x["token"].bitwiseAND(65535) - 32768).cast("short")).alias("sketch"))
        self.sets = self.fetch()
        self.links: DataFrame | None = None
        self.tested: DataFrame | None = None

    def numbered(self, whole: DataFrame, part: int) -> DataFrame:
        """The distinct sets of one of ``SLICES`` parts of all sets, with numbers that no other part has."""
        rows = whole.filter((F.col("n") > 0) & (F.pmod(F.xxhash64("node"), F.lit(SLICES)) == part))
        reps = rows.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))
        # The numbers are written with the rows, so every later read sees the same ones.
        return self.scratch.cut(reps.withColumn("id", F.monotonically_increasing_id() + F.lit(part << 60)), "reps")

    def shared(self, entries: DataFrame, slices: int = 1) -> DataFrame:
        """id, n, prefix (pos, token, df) of sets with enough tokens that stand in other prefixes too."""
        parts = []
        for part in range(slices):
            own = entries if slices == 1 else entries.filter(F.pmod(F.col("token"), F.lit(slices)) == part)
            # Written first: the shuffle that counts is gone before the entries are shuffled.
            often = self.scratch.cut(own.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "often")
            parts.append(self.scratch.cut(own.join(often, "token").select("id", "n", "pos", "token", "df"), "held"))
            self.scratch.drop(often)
        held = reduce(DataFrame.unionByName, parts).groupBy("id", "n").agg(F.collect_list(F.struct("pos", "token", "df")).alias("prefix"))
        held = held.filter(F.size("prefix") >= F.greatest(extra(F.col("n"), self.percent), F.lit(1)))
        core = self.scratch.cut(held.withColumn("prefix", F.array_sort("prefix")), "core")
        self.scratch.drop(*parts)
        return core

    def fetch(self) -> DataFrame:
        """id, tokens, m0, m1 ...: the whole sets of ``core`` and their parity maps, from the texts."""
        wanted = self.scratch.cut(self.reps.join(self.core.select("id"), "id", "left_semi").select("id", "node", "doc_id"), "wanted")

        def take(part: pa.RecordBatch, sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            offsets = np.zeros(len(sets) + 1, np.int32)
            np.cumsum([len(s) for s in sets], out=offsets[1:])
            maps = np.array([parity_map(s) for s in sets])
            yield pa.RecordBatch.from_arrays(
                [pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets).view(np.int64))),
                 *[pa.array(maps[:, w]) for w in range(MAP)]], names=["node", "tokens", *MAPS])

        ids = wanted.select(F.col("doc_id").alias("wanted_id")).distinct()
        texts = self.docs.join(ids, self.docs.doc_id.eqNullSafe(F.col("wanted_id")), "left_semi")
        sets = _sets(texts, self.size, take, "node binary, tokens array<long>, " + ", ".join(f"{m} long" for m in MAPS))
        return self.scratch.cut(sets.join(wanted.select("node", "id"), "node").select("id", "tokens", *MAPS).dropDuplicates(["id"]), "sets")

    def labelled(self, labels: DataFrame | None) -> DataFrame:
        """``core`` with the class of each set, its own number where it has no link."""
        if labels is None:
            return self.core.withColumn("label", F.col("id"))
        named = labels.withColumnRenamed("node", "id")
        return self.core.join(named, "id", "left").withColumn("label", F.coalesce("label", "id"))

    def candidates(self, round_: int, labels: DataFrame | None) -> DataFrame:
        """Pairs of each set with the leaders of its blocks of lists, the most frequent two each.

        Leaders are the most central sets in the first rounds, and drawn by hash in later ones.
        """
        nodes = self.labelled(labels).select(
            "id", "n", "label", F.aggregate("prefix", F.lit(0.0), lambda w, x: w + F.log(x["df"].cast("double"))).alias("shares"),
            F.slice("prefix", 1, LEADER_LISTS).alias("prefix"))
        # The original of a group of near copies shares more of its prefix than copies with edits do.
        entries = nodes.select("id", "n", "label", (F.col("shares") / F.col("n")).alias("weight"), F.inline("prefix"))
        # Blocks of like size: sets a tenth apart at most lie in one block in at least every other round.
        width = math.log(100 / self.percent) * 2
        block = F.floor(F.log(F.col("n").cast("double")) / width + round_ / 2)
        entries = entries.select("token", "id", "n", "label", "weight", block.alias("block"))
        central = -F.col("weight") if round_ < CENTRAL_ROUNDS else F.lit(0.0)
        lead = F.min(F.struct(central.alias("w"), F.xxhash64("id", F.lit(round_)).alias("h"), "id", "n", "label"))
        leaders = entries.groupBy("token", "block").agg(lead.alias("lead"), F.min("label").alias("least"), F.max("label").alias("most"))
        leaders = leaders.filter("least <> most").select("token", "block", "lead")
        pairs = entries.join(leaders, ["token", "block"]).filter(
            (F.col("label") != F.col("lead.label")) & _near_sizes(F.col("n"), F.col("lead.n"), self.percent))
        counted = pairs.groupBy("id", F.col("lead.id").alias("leader")).agg(F.count(F.lit(1)).alias("votes"))
        best = counted.groupBy("id").agg(
            F.max(F.struct("votes", "leader")).alias("first"), F.min(F.struct(-F.col("votes"), F.xxhash64("leader"), "leader")).alias("second"))
        named = best.select(F.col("id").alias("a"), F.explode(F.array("first.leader", "second.leader")).alias("b"))
        return self.bounded(named.filter("a <> b"))

    def bounded(self, pairs: DataFrame) -> DataFrame:
        """Pairs that the overlap of their prefixes leaves possible."""
        left = self.sketches.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
        right = self.sketches.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))
        # Sketch values are token ends, so that equal tokens can only be overcounted.
        common = F.size(F.array_intersect("s_a", "s_b")) + F.size("s_a") - F.size(F.array_distinct("s_a"))
        ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        return ordered.join(left, "a").join(right, "b").filter(
            _may_link(F.col("n_a"), F.col("n_b"), common, self.percent)).select("a", "b")

    def verify(self, pairs: DataFrame) -> bool:
        """Add those of ``pairs`` that are similar enough to the links; whether there are new ones."""
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
        pairs = self.scratch.cut(pairs, "pairs")
        self.tested = pairs if self.tested is None else self.tested.unionByName(pairs)
        if not pairs.limit(1).count():
            return False
        percent = self.percent

        def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = []
                for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                    x, y = x.values.to_numpy(), y.values.to_numpy()
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * both >= percent * (len(x) + len(y) - both))
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

        left, right = (self.sets.select(F.col("id").alias(k), F.col("tokens").alias(t)) for k, t in (("a", "x"), ("b", "y")))
        found = self.scratch.cut(pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(test, "a long, b long"), "links")
        if not found.limit(1).count():
            return False
        self.links = found if self.links is None else self.links.unionByName(found)
        return True

    def remaining(self, labels: DataFrame | None) -> DataFrame:
        """Every pair of different classes that shares a list and may still link."""
        # Linked sets share extra(n) tokens, so the rarest of them stands before the last extra(n) - 1 of either.
        rare = F.array_sort(F.transform("prefix", lambda x: F.struct(x["df"], x["token"], x["pos"])))
        spare = F.greatest(extra(F.col("n"), self.percent) - 1, F.lit(0))
        rare = F.slice(rare, F.lit(1), (F.size("prefix") - spare).cast("int"))
        # A pair that also meets in a list just before leaves a row there.
        rare = let(rare, lambda r: F.transform(r, lambda x, i: F.struct(
            x["token"].alias("token"), x["pos"].alias("pos"), F.get(r, i - 1)["token"].alias("before"), F.get(r, i - 2)["token"].alias("before2"))))
        nodes = self.labelled(labels).join(self.sets.select("id", *MAPS), "id")
        entries = nodes.select("id", "n", "label", *MAPS, F.inline(rare))
        mixed = entries.groupBy("token").agg(F.min("label").alias("least"), F.max("label").alias("most")).filter("least <> most").select("token")
        entries = self.scratch.cut(entries.join(mixed, "token", "left_semi"), "mixed")
        a, b = (entries.select("token", *[F.col(c).alias(f"{c}_{s}") for c in ("id", "n", "label", "pos", "before", "before2", *MAPS)]) for s in "ab")
        n, m = F.col("n_a"), F.col("n_b")
        met = [F.coalesce(F.col(f"{x}_a") == F.col(f"{y}_b"), F.lit(False)) for x in ("before", "before2") for y in ("before", "before2")]
        pairs = a.join(b, "token").filter(
            (F.col("label_a") < F.col("label_b")) & ~reduce(Column.__or__, met) & _near_sizes(n, m, self.percent)
            & _position_skip(n, m, F.col("pos_a"), F.col("pos_b"), self.percent)
            & _differ_little(n, m, [F.col(f"{c}_a") for c in MAPS], [F.col(f"{c}_b") for c in MAPS], self.percent))
        return self.bounded(pairs.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")))

    def classes(self) -> DataFrame:
        """node (a set's number), label for every set that has a link; None when there are no links."""
        labels = None
        for round_ in range(ROUNDS):
            if self.verify(self.candidates(round_, labels)):
                labels = components(self.links, self.scratch)
            elif round_ >= CENTRAL_ROUNDS:
                break
        if self.verify(self.remaining(labels)):
            labels = components(self.links, self.scratch)
        return labels


def near_classes(docs: DataFrame, size: int = 5, percent: int = 80, tag: Column | None = None) -> DataFrame:
    """Classes of documents whose sets of ``size``-word shingles are linked at ``percent`` Jaccard.

    A-Z are lower-cased; words are parted by white space; a text of fewer words is one shingle, and
    one without words (or null) is empty and linked with nothing. Documents link when
    100 * intersection >= percent * union; a class is a connected component, exactly. Repeated rows and
    ids: rows with equal sets are one class; null ids never name a class unless all are null. An
    empty table gives no rows. Columns other than doc_id and text are not read, but for those of ``tag``,
    a text that goes along with each row.
    Result: doc_id, tag, n_shingles, component_id (least doc_id of the class), set_id, class_id (a number of
    the class, of its own even where ids repeat or are null; null for empty sets).
    """
    tag = F.lit(None).cast("string") if tag is None else tag
    light = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), tag.alias("tag"))
    join = Join(light, size, percent)
    labels = join.classes()
    sets = join.reps.select("node", F.col("id"), F.col("doc_id"))
    if labels is not None:
        named = sets.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("label", F.coalesce("label", "id"))
        least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
        sets = named.join(least, "label")
    else:
        sets = sets.withColumnRenamed("doc_id", "component_id").withColumn("label", F.col("id"))
    held = join.scratch.cut(join.members.join(sets.select("node", "component_id", "label"), "node", "left"), "result")
    join.scratch.clear(held)
    return held.select(
        "doc_id", "tag", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.col("node").alias("set_id"),
        F.col("label").alias("class_id"))
