"""Corpus operators against brute force on small tables: nulls, ties, repeats, empty and long texts."""

import base64
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from epiframe.llm import ann, bpe, jaccard, lines, lm, packing, quality, repeats, sharding, toxicity
from epiframe.llm.common import Scratch

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, source string, spans string, kept int, n int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{i}" for i in rng.integers(0, 5000, n))


@pytest.fixture(scope="module")
def texts():
    shared = "Zażółć gęślą jaźń " + prose(1, 60)
    body = prose(2, 120)
    return [
        (0, None), (1, ""), (2, " \n\t "), (3, "one two"), (4, "one two"), (5, body), (6, body), (7, body.replace("w", "W", 1) + " end"),
        (8, f"{prose(3, 40)}\n{shared}\n{prose(4, 40)}"), (9, f"{prose(5, 30)} {shared} tail"), (10, "a" * 450), (11, f"{shared}\nsecond line\n\n{prose(6, 9)}"),
        (12, f"{shared}\nsecond line"), (13, prose(7, 9000)), (14, "it's <|endoftext|> I'll go ééé 12345 !!! \U0001f600\U0001f600"), (15, "x y z " * 60), (15, "x y z " * 60),
        (None, "no id here"), (16, "\n".join(["same line of words"] * 5)),
    ]


@pytest.fixture(scope="module")
def docs(spark, texts, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "t")
    spark.createDataFrame([(i, t, "h", "x", 1, 2) for i, t in texts], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "t")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


def same(got, want):
    assert Counter(got) == Counter(want)


def test_repeated_strings(docs, texts, empty):
    raw = [(i, (t or "").encode()) for i, t in texts]
    starts = Counter(t[p : p + 200] for _, t in raw for p in range(len(t) - 199))
    want = []
    for i, t in raw:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - 199):
            if starts[t[p : p + 200]] > 1:
                gone[p : p + 200] = True
        want.append((i, bytes(np.frombuffer(t, np.uint8)[~gone]), int((np.diff(gone.astype(int), prepend=0) == 1).sum())))
    got = repeats.remove_repeats(docs, 200)
    assert got.columns == ["doc_id", "text", "source", "n", "spans", "kept"]
    same([(r.doc_id, bytes(r.kept), len(r.spans)) for r in got.collect()], want)
    assert repeats.remove_repeats(empty, 200).count() == 0


def test_repeated_strings_keep_the_first_copy(docs):
    got = {(r.doc_id): r for r in repeats.remove_repeats(docs, 200, keep_first=True, whole_characters=True).collect()}
    assert bytes(got[5].kept).decode() == got[5].text and not bytes(got[6].kept)
    assert all(bytes(r.kept).decode() is not None for r in got.values())
    assert "gęślą" in bytes(got[8].kept).decode() and "gęślą" not in bytes(got[9].kept).decode()


def test_repeats_shorter_than_a_gram(spark):
    shared = prose(61, 20)[:60]
    rows = [(1, "abc" + shared + "def"), (2, "xy" + shared + "zz"), (3, prose(62, 30))]
    got = {r.doc_id: bytes(r.kept).decode() for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 50).collect()}
    assert got == {1: "abcdef", 2: "xyzz", 3: rows[2][1]}


def test_lines(docs, texts, empty):
    got = {r.doc_id: r for r in lines.drop_repeated_lines(docs, 2).collect()}
    assert len(got) == len({i for i, _ in texts})
    assert got[0].text is None and got[1].text == "" and got[2].text == " \n\t "
    assert got[11].n_removed == 0 and (got[12].text, got[12].n_removed, got[12].n_runs) == ("", 2, 1)
    assert got[16].text == "same line of words" and got[16].n_removed == 4
    assert got[8].n_removed == 0 and got[15].n_removed == 0
    assert lines.drop_repeated_lines(empty, 2).count() == 0


def test_long_lines(spark):
    import corpus_pipeline

    long, other, short = prose(51, 60), prose(52, 50), prose(53, 49)
    rows = [(1, f"a\n{long}\nb"), (2, f"c\n{long}\nd"), (3, other), (4, other), (5, f"e\n{short}\nf"), (6, f"g\n{short}\nh"), (7, f"{long}\n\ni\n{long}")]
    got = {r.doc_id: r for r in lines.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), 2, long_words=50).collect()}
    assert [got[i].text for i in range(1, 8)] == [rows[0][1], "c\nd", other, "", rows[4][1], rows[5][1], "\ni"]
    assert [(got[i].n_removed, got[i].n_runs) for i in range(1, 8)] == [(0, 0), (1, 1), (0, 0), (1, 1), (0, 0), (0, 0), (2, 2)]
    out = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()}
    assert out[2] == "c\nd" and 4 not in out and out[5] == rows[4][1]


def test_shards(docs, texts, empty):
    rows = sharding.balanced_shards(docs, 4).collect()
    same([(r.doc_id, r.size, r.text_crc32) for r in rows], [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts])
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r.size
    total, largest = sum(sizes.values()), max(r.size for r in rows)
    assert all(abs(sizes[s] - total / 4) <= largest for s in range(4))
    assert sharding.balanced_shards(empty, 4).count() == 0


def test_packing_plan():
    rng = np.random.default_rng(0)
    for scale in (4096, 1500, 300):
        counts = Counter(rng.integers(1, scale + 1, 4000).tolist())
        bins = packing.pack_lengths(counts, 4096)
        held = Counter()
        for pattern, n in bins:
            assert sum(pattern) <= 4096 and sum(3 * l > 4096 for l in pattern) <= 2
            for l in pattern:
                held[l] += n
        assert held == counts
        least = max(-(-sum(l * n for l, n in counts.items()) // 4096), sum(n for l, n in counts.items() if 2 * l > 4096))
        assert sum(n for _, n in bins) <= 1.02 * least + 1
    assert packing.pack_lengths({}, 4096) == []


def test_packing_chunks():
    import random

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    rng = random.Random(0)
    made = {"".join(rng.choices("abcXYZ019'\"<|>.,-_@#sStTlLrReEdDmMvV\x1c\x7f\x00\u00e9\u0301", k=rng.randint(1, 12))) for _ in range(5000)}
    found = sorted(made | {"<|endoftext|>", "it'S", "I'LL", "</w>a</w>", "H\u0331x", "\u3000x\u3000"})
    want = [e.ids for e in tokenizer.encode_batch(found, add_special_tokens=False)]
    for known in (True, False):  # a tokenizer of another kind has no pattern
        chunks = packing.Chunks(tokenizer)
        assert chunks.pattern is not None
        chunks.pattern = chunks.pattern if known else None
        at = [chunks[c.encode()] for c in found]
        chunks.settle()
        assert [chunks.flat[chunks.start[i] : chunks.start[i + 1]].tolist() for i in at] == want


def test_packing(docs, texts, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    want = []
    for i, t in texts:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[start : start + 4096], "<u4")
            want.append((i, piece, start, len(part), zlib.crc32(part.tobytes())))
    rows = packing.pack(docs, VOCABULARY, 4096, 1).collect()
    same([tuple(r)[:5] for r in rows], want)
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in places.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 4096
    assert packing.pack(empty, VOCABULARY, 4096, 1).count() == 0


def test_bpe_round_trip(docs, texts, empty):
    import tiktoken

    with open(RANKS, "rb") as rows:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rows)}
    whole = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = [(i, np.array(whole.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in texts]
    got = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS).collect()
    same([(r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in got], want)
    assert bpe.encode(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def brute_measures(text):
    w = WORD.findall(text or "")
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    twice = {g for g, n in Counter(grams).items() if n > 1}
    repeated = {i + s for i, g in enumerate(grams) if g in twice for s in range(3)}
    full = [l for l in (text or "").split("\n") if WORD.search(l)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(full) - len(set(full)), len(repeated)


def test_quality(spark, docs, texts, empty):
    rows = quality.judge(docs).collect()
    same([tuple(r)[:6] for r in rows], [(i, *brute_measures(t)) for i, t in texts])
    assert quality.judge(empty).count() == 0
    bad, good = [(i, "few words", "bad", "", 0, 0) for i in range(200)], [(1000 + i, prose(i, 80), f"s{i % 9}", "", 0, 0) for i in range(400)]
    odd = [(5000, prose(9, 80), "bad", "", 0, 0), (5001, prose(8, 80), None, "", 0, 0)]
    kept = {r.doc_id for r in quality.judge(spark.createDataFrame(bad + good + odd, SCHEMA)).filter("kept").collect()}
    assert kept == {r[0] for r in good} | {5001}


def shingles(text, size):
    w = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def brute_classes(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    return [(i, len(s), min((rows[j][0] for j in range(len(rows)) if label[j] == label[k] and rows[j][0] is not None), default=None)) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True))]


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80)])
def test_jaccard(spark, texts, empty, size, percent):
    rng = np.random.default_rng(percent)
    rows = [r for r in texts if r[0] != 13]
    for group in range(6):
        base = prose(100 + group, 150).split()
        for i in range(12):
            w = list(base)
            for at in rng.integers(0, len(w), rng.integers(0, 6)):
                w[at] = f"e{rng.integers(0, 10**6)}"
            rows.append((1000 + 100 * group + i, " ".join(w[: len(w) - int(rng.integers(0, 12))])))
    got = jaccard.near_classes(spark.createDataFrame(rows, "doc_id long, text string"), size, percent)
    same([(r.doc_id, r.n_shingles, r.component_id) for r in got.collect()], brute_classes(rows, size, percent))
    assert jaccard.near_classes(empty, size, percent).count() == 0


def test_elias_fano():
    rng = np.random.default_rng(3)
    for n, top in ((1, 1), (5, 3), (1000, 10**9), (3000, 50)):
        values = np.sort(rng.integers(0, top, n))
        built = lm.EliasFano.build(values)
        ef = lm.EliasFano(built["low"], built["high"], built["counts"], built["zeros"], *built["shape"].tolist())
        assert (ef.at(np.arange(n)) == values).all()
        asked = np.concatenate([values, rng.integers(0, top + 5, 200)])
        first = rng.integers(0, n, len(asked))
        last = np.minimum(n, first + rng.integers(0, n + 1, len(asked)))
        want = [f + np.searchsorted(values[f:l], q) for q, f, l in zip(asked, first, last, strict=True)]
        assert (ef.successor(asked, first, last) == want).all()


def test_language_model(docs, texts, empty):
    held = F.col("doc_id").isin(9, 13)
    rows = lm.train_and_score(docs, held).collect()
    token_rows = [([*WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")), "\n"], i in (9, 13)) for i, t in texts]
    c, pairs = Counter(), Counter()
    for tokens, out in token_rows:
        if not out:
            c.update(tokens)
            pairs.update(zip(["\n", *tokens[:-1]], tokens, strict=True))
    followers, seen = Counter(), Counter()
    for (a, _), n in pairs.items():
        followers[a] += 1
        seen[a] += n
    N, V = sum(c.values()), len(c)

    def p(a, b):
        low = (c[b] + 1) / (N + V + 1)
        return (max(pairs[a, b] - 0.75, 0) + 0.75 * followers[a] * low) / seen[a] if seen[a] else low

    assert abs(sum(p("w1", b) for b in c) + p("w1", "never seen") - 1) < 1e-9
    assert {r.train_tokens for r in rows} == {N}
    want = Counter()
    got = Counter()
    for (tokens, _), (i, _) in zip(token_rows, texts, strict=True):
        base = sum(np.log10((c[b] + 1) / (N + V + 1)) for b in tokens)
        full = sum(np.log10(p(a, b)) for a, b in zip(["\n", *tokens[:-1]], tokens, strict=True))
        want[i, len(tokens), sum(c[b] > 0 for b in tokens), round(base, 4)] += 1
        mine = [r for r in rows if r.doc_id == i and r.n_tokens == len(tokens)][0]
        assert abs(mine.score - full) <= len(tokens) * 1.5 / lm.STEP  # one byte a probability
    for r in rows:
        got[r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 4)] += 1
    assert got == want
    assert lm.train_and_score(empty, held).count() == 0


def test_language_model_of_triples(docs, texts, empty):
    held = F.col("doc_id").isin(9, 13)
    rows = {}
    for r in lm.train_and_score(docs, held, order=3).collect():
        rows.setdefault((r.doc_id, r.n_tokens), r.score)
    token_rows = [([*WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")), "\n"], i) for i, t in texts]
    c, grams = Counter(), Counter()
    for tokens, i in token_rows:
        if i not in (9, 13):
            c.update((b,) for b in tokens)
            line = ["\n", *tokens]
            grams.update(zip(line, tokens, strict=False))
            grams.update(zip(line, tokens, tokens[1:], strict=False))
    followers, seen = Counter(g[:-1] for g in grams), Counter()
    for g, n in grams.items():
        seen[g[:-1]] += n
    total = sum(c.values())

    def p(*g):
        if len(g) == 1:
            return (c[g] + 1) / (total + len(c) + 1)
        low, context = p(*g[1:]), g[:-1]
        return (max(grams[g] - 0.75, 0) + 0.75 * followers[context] * low) / seen[context] if seen[context] else low

    assert abs(sum(p("x", "y", *b) for b in c) + p("x", "y", "never seen") - 1) < 1e-9
    apart = 0
    for tokens, i in token_rows:
        line = ["\n", *tokens]
        pairs = sum(np.log10(p(*g)) for g in zip(line, tokens, strict=False))
        full = np.log10(p("\n", tokens[0])) + sum(np.log10(p(*g)) for g in zip(line, tokens, tokens[1:], strict=False))
        assert abs(rows[i, len(tokens)] - full) <= len(tokens) * 1.5 / lm.STEP
        apart += abs(pairs - full) > len(tokens) * 3 / lm.STEP  # longer context tells in some texts
    assert apart
    assert lm.train_and_score(empty, held, order=3).count() == 0
    with pytest.raises(ValueError):
        lm.train_and_score(docs, held, order=4)


def test_triples_in_parts():
    rng = np.random.default_rng(3)
    u, v, w = rng.integers(0, 9, (3, 500))
    small, large = lm._distinct(u, v, w, 9), lm._distinct(u, v, w, 1 << 22)
    assert all((a == b).all() for a, b in zip(small, large, strict=True))
    assert all((a == b).all() for a, b in zip(lm._unpacked(lm._packed(*small), 4), small, strict=True))
    for words in (9, 1 << 31):
        merged = lm._sorted_sums(u, v, w, np.ones(500, np.int64), words)
        assert all((a == b).all() for a, b in zip(merged, small, strict=True))


def test_nearest(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((600, 16)).astype(np.float32)
    x[50:250] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, []), (1100, [1.0, 2.0]), (None, x[3].tolist()), (7, x[7].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in ann.nearest(df, every=20, k=10, probe=16).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(range(0, 600, 20))
    hits = 0
    for q, found in got.items():
        distance = np.sqrt(((x.astype(float) - x[q]) ** 2).sum(1))
        distance[q] = np.inf
        want = np.lexsort((np.arange(600), distance))[:10]
        found.sort()
        assert [f[0] for f in found] == list(range(1, len(found) + 1))
        assert all(abs(f[2] - distance[f[1]]) < 1e-12 for f in found)
        hits += len({f[1] for f in found} & set(want.tolist()))
    assert hits >= 0.9 * 10 * len(got)
    assert [f[1] for f in got[60]] == [0, *range(50, 59)]
    assert ann.nearest(df.limit(0)).count() == 0


def test_toxicity(spark, empty):
    rng = np.random.default_rng(2)
    rows, marks = [], []
    for i in range(400):
        w = prose(i + 50, 60 + i % 50).split()
        if i % 4 == 0:
            w[int(rng.integers(0, len(w)))] = ["vile", "brutish", "nastily"][i % 3]
        rows.append((i, " ".join(w)))
        marks.append((i, int(i % 4 == 0)))
    rows += [(900, None), (901, ""), (902, "... !"), (903, prose(1, 5000) + " vile")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([*marks, (None, 1), (5, None)], "doc_id long, toxic int")
    scorer = toxicity.train(df, labels, F.col("doc_id") % 5 != 0)
    got = {r.doc_id: r.score for r in toxicity.score(df, scorer).collect()}
    held = [i for i in range(0, 400, 5)]
    assert sum((got[i] >= 0.5) == (i % 4 == 0) for i in held) >= 0.95 * len(held)
    assert got[900] == got[901] == got[902] == 0 and got[903] >= 0.5
    assert toxicity.score(empty, scorer).count() == 0


def test_network_gradients():
    network = toxicity.Network(1)
    rng = np.random.default_rng(1)
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    x, mask, label = rng.standard_normal((5, 3, 16)), np.ones((5, 3)), np.array([1.0, 0, 1])
    mask[3:, 1] = 0

    def loss():
        p = toxicity._sigmoid(network.logits(*network.gates(x), mask))
        return -(label * np.log(p) + (1 - label) * np.log(1 - p)).mean()

    g, _ = network.gradients(x, mask, label)
    for name in ("Wf", "Ub", "A", "v", "o", "bf"):
        at = tuple(0 for _ in network.p[name].shape)
        network.p[name][at] += 1e-3
        up = loss()
        network.p[name][at] -= 2e-3
        down = loss()
        network.p[name][at] += 1e-3
        assert abs((up - down) / 2e-3 - g[name][at]) < 1e-4


def test_near_duplicates_without_own_ids(spark):
    import corpus_pipeline

    a, b, c, d, e = (prose(700 + i, 90) for i in range(5))
    rows = [(None, a), (None, a + " end"), (None, b), (2, b + " end"), (7, c), (3, c + " end"), (7, d), (9, e), (9, e + " end"), (9, e), (None, None), (None, "")]
    stay = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    held = Counter((r.doc_id, (r.text or "").removesuffix(" end")) for r in stay)
    assert held == Counter([(None, a), (2, b), (3, c), (7, d), (9, e), (None, ""), (None, "")])


def test_pipeline(spark, texts, tmp_path):
    import corpus_pipeline

    clean = [(100 + i, prose(200 + i, 90), "en", f"s{i % 3}", 1) for i in range(30)]
    copy, passage = clean[0][1], prose(999, 70)
    extra = [(500, copy, "en", "s1", 1), (501, clean[1][1] + " end", "en", "s1", 1), (502, prose(31, 80) + " " + passage, "en", "s1", 1), (503, prose(32, 80) + " " + passage, "en", "s2", 1), (504, "too short", "en", "s2", 1), (505, None, None, None, None)]
    spark.createDataFrame(clean + extra, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    scratch, docs, held = Scratch(spark), spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.cut(stage(spark, docs, str(tmp_path)), name)
        held[name] = {r.doc_id: r for r in docs.collect()}
        assert docs.columns == names or name == "pack"
    assert set(held["quality_rules"]) == {r[0] for r in clean} | {500, 501, 502, 503}
    assert set(held["near_duplicates"]) == {r[0] for r in clean} | {502, 503}
    last = held["string_dedup"]
    assert all(last[r[0]].text == r[1] for r in clean)
    assert passage in last[502].text and passage[50:] not in last[503].text
    whole = hashlib.sha256(repr(sorted(tuple(r) for r in held["pack"].values())).encode()).hexdigest()
    again = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(again) == set(held["pack"]) and whole
