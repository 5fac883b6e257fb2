"""Names that clash with the operators' own, very long blocks, complete and measured searches, the registered queries."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import check
import corpus_pipeline
from epiframe.llm import ann, lines, queries, quality, repeats, toxicity
from epiframe.llm.repeats import find_in_pieces, merge

SF = "/root/testdata/sf0.001"
#: Columns of the operators' own that an input may have as well.
NAMES = ("low high marks m_doc m_hash held text_hash gone_doc gone_hash gone_line new_text at row kept spans n_runs refused host carried "
         "others tag base_failed n_words n_chars").split()


def prose(seed, n):
    return " ".join(f"w{i}" for i in np.random.default_rng(seed).integers(0, 5000, n))


@pytest.fixture(scope="module")
def clashing(spark):
    shared = prose(1, 60)
    texts = [None, "", f"{prose(2, 60)}\n{shared}", f"{prose(3, 60)}\n{shared}", f"{shared}\nx\n{prose(4, 70)}", prose(5, 90)]
    rows = [(i, t, f"s{i % 2}", *[f"{n}-{i}" for n in NAMES]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, ", ".join(["doc_id long", "text string", "source string", *[f"{n} string" for n in NAMES if n != "n_chars"], "n_chars string"]))


def test_operators_leave_foreign_columns(clashing):
    gone = {"kept", "spans"}
    got = repeats.remove_repeats(clashing, 200)
    assert [c for c in got.columns if c not in gone] == [c for c in clashing.columns if c not in gone]
    assert all(r[n] == f"{n}-{r.doc_id}" for r in got.collect() for n in NAMES if n not in gone)
    got = lines.drop_repeated_lines(clashing, 1)
    assert all(r[n] == f"{n}-{r.doc_id}" for r in got.collect() for n in NAMES if n != "n_runs")
    got = quality.judge(clashing, carry=tuple(clashing.columns)).collect()
    assert len(got) == 6 and all(r.carried[n] == f"{n}-{r.doc_id}" for r in got for n in NAMES)


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_leave_foreign_columns(spark, clashing, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    got = stage(spark, clashing, "")
    assert got.columns == clashing.columns
    rows = got.collect()
    assert {r.doc_id for r in rows} >= {2, 5}
    assert all(r[n] == f"{n}-{r.doc_id}" for r in rows for n in NAMES if n != "n_chars")
    assert stage(spark, clashing.limit(0), "").count() == 0
    small = stage(spark, clashing.select("doc_id", "text", F.lit(None).cast("string").alias("source")), "")
    assert {r.doc_id for r in small.collect()} >= {2, 5}


@pytest.mark.parametrize("piece", [64, 301])
def test_anchors_in_pieces(piece):
    rng = np.random.default_rng(2)
    texts = [bytes(rng.integers(97, 100, n, dtype=np.uint8)) for n in (0, 700, 40, 0, 1200, 90, 333, 0)]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.cumsum([0, *map(len, texts)])
    anchor, low, high, grams, _, row = find_in_pieces(raw, starts, 40, 8, piece)
    whole = find_in_pieces(raw, starts, 40, 8)
    windows = {(int(a), int(p), int(g), int(r)) for a, b, e, g, r in zip(anchor, low, high, grams, row) for p in range(b, e + 1)}
    assert windows == {(int(a), int(p), int(g), int(r)) for a, b, e, g, r in zip(whole[0], whole[1], whole[2], whole[3], whole[5]) for p in range(b, e + 1)}
    assert len(merge(low, high + 40)) and len(windows) == sum(max(0, len(t) - 39) for t in texts)


def neighbours(x, ids, k):
    for q in ids:
        distance = ((x - x[q]) ** 2).sum(1)
        distance[q] = np.inf
        yield q, np.lexsort((np.arange(len(x)), distance))[:k].tolist()


@pytest.mark.parametrize("rows, width", [(2000, 64), (2000, 256)])
def test_recall_of_the_registered_search(spark, rows, width):
    x = np.random.default_rng(width).standard_normal((rows, width))
    got = {}
    for r in ann.nearest(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"), every=20).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert all(len(v) == 10 for v in got.values()) and len(got) == rows // 20
    assert sum(len(got[q] & set(want)) for q, want in neighbours(x, got, 10)) >= 0.9 * 10 * len(got)


def test_few_candidates_are_all_found(spark):
    x = np.random.default_rng(4).standard_normal((12, 64))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(100, [1.0, 0.0]), (200, [0.0, -1.0]), (300, [1.0] * 5)]
    got = {}
    for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=1).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert {q: v for q, v in got.items() if q < 12} == dict(neighbours(x, range(12), 10))
    assert got[100] == [200] and got[200] == [100] and 300 not in got


def test_least_text_of_a_repeated_id(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, labels: seen.append((texts, labels.tolist())))
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (2, "y"), (2, "x"), (3, "z")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 0), (2, 1), (3, None)], "doc_id long, toxic int")
    toxicity.train(docs, labels, F.lit(True))
    assert seen == [([b"", b"x"], [0, 1])]


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n in queries.ORACLES])
def test_registered_query_agrees_with_sql(spark, con, name):
    ok, note = check.compare(spark, con, SF, name)
    assert ok, note


@pytest.mark.parametrize("name, modulus, held", [("op2_elias_fano_trie", 7, 2), ("op3_bigru_toxicity", 5, 0)])
def test_held_out_rows(spark, con, name, modulus, held):
    rows = queries.QUERIES[name](spark, SF).collect()
    ids = [i for i, in con.execute("SELECT doc_id FROM documents").fetchall()]
    assert Counter(r.doc_id for r in rows) == Counter(ids)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == held) for r in rows)
    if name == "op3_bigru_toxicity":
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
        return
    texts = dict(con.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())
    tokens = {i: t.encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))).split() + [None] for i, t in texts.items()}
    counts = Counter(w for i, t in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in t)
    total = sum(counts.values())
    for r in rows:
        own = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(w in counts for w in own), total)
        base = sum(np.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in own)
        assert r.base_score == pytest.approx(base, abs=1e-6) and r.score < 0


def test_words_of_a_block():
    from epiframe.llm.common import LOWER_BYTES
    from epiframe.llm.lm import _words

    texts = [b"", b"One two", b"two\x0b", b"", b" \t", b"three", b"Three\nONE \x1c x", "é É".encode(), b""]
    for some in (texts, texts[::-1], [b""], [b"a"], [b" "]):
        words, counts = _words(np.frombuffer(b"".join(some), np.uint8), np.cumsum([0, *map(len, some)]))
        want = [t.translate(LOWER_BYTES).split() for t in some]
        assert words.to_pylist() == [w for t in want for w in t] and counts.tolist() == [len(t) for t in want]


def test_pairs_of_pointers():
    from epiframe.llm.lm import EliasFano

    for seed, top in ((1, 40), (2, 3000), (3, 10**7)):
        values = np.sort(np.random.default_rng(seed).integers(0, top, 2000))
        coded = EliasFano.build(values)
        n, bits = coded.pop("shape").tolist()
        held = EliasFano(**coded, n=n, bits=bits)
        first, second = held.pair(np.arange(1999))
        assert (first == values[:-1]).all() and (second == values[1:]).all()
        at, same = held.seek(values[::7], np.zeros(len(values[::7]), np.int64), np.full(len(values[::7]), 2000))
        assert (at == np.searchsorted(values, values[::7])).all() and same.all()
        odd = np.setdiff1d(np.arange(0, top + 9, max(1, top // 500)), values)
        at, same = held.seek(odd, np.zeros(len(odd), np.int64), np.full(len(odd), 2000))
        assert (at == np.searchsorted(values, odd)).all() and not same.any()


def test_line_ranks_double_until_they_are_unique(spark, monkeypatch):
    from epiframe.llm.common import Scratch

    made, cut = [], Scratch.cut
    monkeypatch.setattr(Scratch, "cut", lambda self, df, name="table": made.append(name) or cut(self, df, name))
    run = [f"line {i}" for i in range(11)]
    rows = [(1, "\n".join(["x", *run, "y"])), (2, "\n".join(run)), (3, "\n".join(["z", *run[3:8], "w"])), (4, "v\nline 10"), (None, "u\nu\nu\nu"), (5, None)]
    got = {r.doc_id: r for r in lines.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()}
    assert [n for n in made if n.startswith("shared")] == ["shared2", "shared4", "shared8", "shared16"]  # was one round, to length 2
    assert [(got[i].text, got[i].n_removed, got[i].n_runs) for i in (1, 2, 3, 4, None, 5)] == [
        (rows[0][1], 0, 0), ("", 11, 1), ("z\nw", 5, 1), ("v\nline 10", 0, 0), ("u", 3, 1), (None, 0, 0)]
