"""Manifest, periodic runs and concatenation against brute force: nulls, ties, repeats, empty and long texts."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from epiframe.llm import concat, merkle, queries, runs

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Extra columns named as the operators name their own.
SCHEMA = ("doc_id long, text string, source string, lang string, n_chars long, part int, at long, place long, tree long, i long, n long, "
          "digest string, path string, row string, ids string, tokens long, runs string, key string, `group` string, leaf string, kids string")


def crc(i):
    return zlib.crc32(str(i).encode())


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def table(spark, rows):
    extra = (1, 2, 3, 4, 5, 6, "d", "p", "r", "i", 7, "r", "k", "g", "l", "k")
    return spark.createDataFrame([(i, t, s, l, c, *extra) for i, t, s, l, c in rows], SCHEMA)


def stored(spark, rows, sf):
    table(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").repartition(3).write.parquet(f"{sf}/documents.parquet")
    return str(sf)


def corpus(seed=0):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["Straße", "ŁÓDŹ", "\U0001f600", "a b", "É"]
    rows = [(0, None, None, None, None), (1, "", "one", "de", 0), (2, " \n\t ", "b", None, 4), (None, "No Id", "b", "en", 5), (None, None, "lone", "en", None),
            (3, "A b " * 40, "é", "en", 160), (3, "A b " * 40, "é", "en", 160), (3, "other text", "é", "en", 9)]
    for i in range(10, 330):
        words = rng.choices(vocabulary, k=rng.choice((1, 5, 30, 80)))
        if i % 7 == 0:
            at = rng.randrange(len(words))
            words[at:at] = words[:3] * rng.randrange(2, 9)
        rows.append((i, rng.choice((" ", "  ", "\n")).join(words), rng.choice(["b", "b", "b", "x", "é", None, "Z"]), "en", 1))
    rows += [(1000 + i, "y", "big", "en", 1) for i in range(257)] + [(2000 + i, "y", "sixteen", "en", 1) for i in range(16)]
    return rows


def brute_manifest(rows):
    """doc id and digests of every row, straight from the definition."""
    def leaf(i, t, s, l, c):
        return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, s, l, c, t)])

    def lower(i, t):
        return t if i is None or crc(i) % 5 or t is None else re.sub("[A-Z]", lambda m: m[0].lower(), t)

    def tree(nodes):
        """(digest, way of each node as (before, after) by level)"""
        ways, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
        while len(level) > 1:
            for w, k in zip(ways, at, strict=True):
                a = k // 16 * 16
                w.append((level[a:k], level[k + 1 : a + 16]))
            level = [H(*level[a : a + 16]) for a in range(0, len(level), 16)]
            at = [k // 16 for k in at]
        return level[0], ways

    sources = sorted({r[2] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    subs = []
    for s in sources:
        mine = sorted((r for r in rows if r[2] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        subs.append((mine, *tree([leaf(*r) for r in mine])))
    root, tops = tree([sub for _, sub, _ in subs])
    for (mine, sub, ways), top in zip(subs, tops, strict=True):
        for r, way in zip(mine, ways, strict=True):
            way = way + top
            fold = leaf(r[0], lower(r[0], r[1]), *r[2:])
            for before, after in way:
                fold = H(*before, fold, *after)
            yield r[0], leaf(*r), sub, root, H(*[x for b, a in way for x in b + a]), fold, fold == root


def test_manifest(spark, tmp_path):
    rows = corpus()
    sf = stored(spark, rows, tmp_path)
    got = queries.QUERIES["op11_merkle_manifest"](spark, sf)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = [tuple(r) for r in got.collect()]
    assert Counter(got) == Counter(brute_manifest(rows))
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("rows", [[], [(5, "A", "s", "en", 1)], [(5, "x", "s", None, 1), (6, "Y", "s", None, 1)], [(1, None, None, None, None)] * 40])
def test_small_manifests(spark, tmp_path, rows):
    got = queries.QUERIES["op11_merkle_manifest"](spark, stored(spark, rows, tmp_path)).collect()
    assert Counter(map(tuple, got)) == Counter(brute_manifest(rows) if rows else [])


def test_manifest_reads_only_named_columns(spark):
    docs = table(spark, corpus())
    leaf = merkle.leaf_digest(F.col("doc_id"), F.col("text"))
    got = merkle.manifest(docs, "source", "doc_id", leaf, {"tree": F.col("doc_id"), "digest": F.col("leaf")}, fanout=3)
    assert got.columns == ["tree", "digest", "leaf", "subroot", "root", "path"]
    assert got.filter(merkle.folded(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0
    assert got.count() == len(corpus()) and got.select("root").distinct().count() == 1


def brute_runs(words, least=6, exponent=4):
    """Runs by comparing every word with the one ``period`` words on."""
    n, found = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, exponent * q):
                found.setdefault((i, j - i + q), q)  # the smallest period of a stretch comes first
            i = j + 1
    return sorted((start, length, q) for (start, length), q in found.items())


def brute_changed(i, words):
    if i is None or not words or crc(i) % 10:
        return words
    n, g = len(words), crc(i) // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]


def brute_row(i, text):
    words = brute_changed(i, WORD.findall((text or "").encode()))
    found = brute_runs(words)
    gone = {k for s, l, q in found for k in range(s + q, s + l)}
    best = (None,) * 4
    if found:
        top = max(found, key=lambda r: (r[1] * 10**9 // r[2], -r[0], -r[2]))
        assert not any(l * top[2] > top[1] * q for _, l, q in found)
        best = (*top, 1000 * top[1] // top[2])
    return (i, len(found), *best, H("".join(f"{s},{l},{q}\n" for s, l, q in found)),
            hashlib.sha256(b" ".join(w for k, w in enumerate(words) if k not in gone)).hexdigest())


def test_runs_of_random_words():
    rng = random.Random(5)
    for trial in range(600):
        words = []
        while len(words) < rng.randrange(1, 120):
            part = rng.choices(range(rng.choice((1, 2, 3, 9))), k=rng.randrange(1, 9))
            words += part * rng.choice((1, 1, 2, 4, 5, 7))
        for least, exponent in ((6, 4), (1, 2), (6, 3), (2, 2), (20, 5)):
            want = brute_runs(words, least, exponent)
            assert runs.runs_of(words, least, exponent) == want, (words, least, exponent)
            numbers, texts = np.array([*words, 77, *words]), np.repeat([0, 1], [len(words), len(words) + 1])
            parts = runs._stretches(numbers, texts, least, exponent)
            held = [(a + s, l, q) for a, b in parts for s, l, q in runs.runs_of(numbers[a:b].tolist(), least, exponent)]
            both = [(s, l, q) for s, l, q in want] + [(s + len(words), l, q) for s, l, q in brute_runs([77, *words], least, exponent)]
            assert sorted(held) == sorted(both), (words, least, exponent)


def test_runs_of_long_periods():
    rng = random.Random(6)
    part = rng.choices(range(500), k=900)
    words = part * 4 + part[:451] + [1] * 3000 + rng.choices(range(500), k=900)
    found = runs.runs_of(words, 6, 4)
    assert [(l, q) for _, l, q in found if q == 900] == [(4051 + (part[451] == 1), 900)]
    assert any(q == 1 and l >= 3000 for _, l, q in found)


def test_periodic_runs(spark, tmp_path):
    rows = [(i, t) for i, t, *_ in corpus()]
    rows += [(5000, "x " * 9000), (5001, " ".join(map(str, range(3000))) + " a b c" * 2000), (5003, "z")]
    sf = stored(spark, [(i, t, "s", "en", 1) for i, t in rows], tmp_path)
    got = queries.QUERIES["op12_periodic_runs"](spark, sf)
    assert got.columns[:8] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = [tuple(r)[:8] for r in got.collect()]
    want = [brute_row(i, t) for i, t in rows if i != 5000] + [r for r in got if r[0] == 5000]
    assert Counter(got) == Counter(want)
    assert sum(r[1] > 0 for r in got) > 30
    plain = {r.doc_id: r for r in runs.periodic_runs(table(spark, [(i, t, "s", "en", 1) for i, t in rows])).collect()}
    assert [tuple(r) for r in plain[5000].runs] == [(0, 9000, 1)] and plain[5000].collapsed == "x"
    assert runs.periodic_runs(table(spark, [])).count() == 0


def test_quick_ids_equal_the_tokenizers():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(BYTES)
    whole.encode_special_tokens = True
    encode = concat.coder(BYTES)
    rng = random.Random(8)
    some = [chr(c) for c in range(1, 0x3000) if chr(c).isprintable() or chr(c).isspace()] + ["\U0001f600", "'s", "'LL", "<|endoftext|>", " ", " " * 5, "\x00"]
    texts = ["", " ", "a", "<|endoftext|>x", " " * 5000 + "end", "q" * 3000, "\r\n\r\n x"] + ["".join(rng.choices(some, k=rng.randrange(200))) for _ in range(400)]
    for t in texts:
        assert encode(t) == whole.encode(t, add_special_tokens=False).ids, t
    assert concat.quick_coder({"normalizer": None, "pre_tokenizer": None, "model": {"type": "BPE"}, "added_tokens": []}) is None
    word = concat.coder(public_tokenizers.path("word_bpe_49k.json"))
    assert word("Hello World") == Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode("Hello World", add_special_tokens=False).ids


def test_concat_and_cut(spark, tmp_path):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(BYTES)
    rows = corpus(3) + [(6000, "many words of a long text " * 3000, "s", "en", 1)]
    sf = stored(spark, rows, tmp_path)
    got = queries.QUERIES["op13_concat_and_cut"](spark, sf)
    assert got.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    ids = {}
    for i, t, *_ in rows:
        ids.setdefault(i, []).append(np.array([*whole.encode(t or "", add_special_tokens=False).ids, 0], "<u4"))
    pieces, sizes, held = got.collect(), Counter(), {}
    for p in pieces:
        assert any(len(x) == p.doc_tokens and zlib.crc32(x[p.start : p.start + p.length].tobytes()) == p.ids_crc32 for x in ids[p.doc_id])
        sizes[p.sequence_id] += p.length
        held.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert sum(sizes.values()) == sum(len(x) for many in ids.values() for x in many)
    assert Counter((p.doc_id, p.start, p.length) for p in pieces if p.doc_id not in (3, None)).most_common(1)[0][1] == 1
    for spans in held.values():
        spans.sort()
        assert all(a == sum(l for _, l in spans[:k]) for k, (a, _) in enumerate(spans))
    odd = sorted(n for n in sizes.values() if n != 1024)
    assert all(n & (n - 1) == 0 for n in odd) and len(set(odd)) == len(odd) < 11


def test_concatenated_sequences_round_trip(spark):
    docs = table(spark, corpus(4)).repartition(5)
    pieces = concat.concat_and_cut(docs, BYTES, 100, 50256)
    lines = concat.sequences(pieces).orderBy("sequence_id").collect()
    stream = np.frombuffer(b"".join(bytes(r.ids) for r in lines), "<u4")
    assert all(r.tokens == 100 or r.tokens & (r.tokens - 1) == 0 for r in lines) and sum(r.tokens for r in lines) == len(stream)
    from tokenizers import Tokenizer

    parts = np.split(stream, np.flatnonzero(stream == 50256) + 1)
    got = Counter(Tokenizer.from_file(BYTES).decode(p[:-1].tolist()) for p in parts[:-1])
    assert got == Counter(t or "" for _, t, *_ in corpus(4))
    assert concat.concat_and_cut(table(spark, []), BYTES).count() == 0
