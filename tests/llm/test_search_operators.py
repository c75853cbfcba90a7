"""Importance resampling, nearest neighbours and ranked search against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import importance, lexical, neighbours

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def texts(seed, n):
    random.seed(seed)
    bits = ["the", "Of", "x", "É", "straße", "\U0001f600", "a1", "zyx", "word" * 30, "mat"]
    return ["".join(random.choice(bits) + random.choice([" ", "  ", "-", "\n", "."]) for _ in range(random.choice([0, 3, 25, 60]))) for _ in range(n)]


# --- importance resampling


def resampled(docs, target, run, percent, least, buckets=10_000):
    """doc number -> (features, weight, score), and the numbers drawn, best first."""
    crcs = lambda t: [zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for w in [words(t)] for k in range(1, run + 1) for i in range(len(w) - k + 1)]
    own = [crcs(t) for _, t in docs]
    s, t = Counter(b for x in own for b in x), Counter(b for _, x in target for b in crcs(x))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * float(sum(s.values()) + buckets) / ((s[b] + 1) * float(sum(t.values()) + buckets))))
    out = []
    for (key, _), x in zip(docs, own, strict=True):
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, x))
        out.append((len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = [i for i, (_, x) in enumerate(docs) if len(words(x)) >= least]
    order = sorted(fit, key=lambda i: (-out[i][2], docs[i][0] is None, docs[i][0]))
    return out, order[: len(fit) * percent // 100]


@pytest.mark.parametrize("run,most", [(1, 100_000), (1, 3), (3, 100_000), (3, 0)])
def test_resampling_against_brute_force(spark, monkeypatch, run, most):
    rows = [*enumerate(texts(1, 60)), (900, None), (901, ""), (7, texts(1, 60)[7]), (None, "the of x " * 20)]
    target = list(enumerate(texts(2, 9)))
    monkeypatch.setattr(importance.dictionary, "__defaults__", (most,))
    got = importance.resample(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(target, "id long, text string"), percent=30, run=run).collect()
    want, drawn = resampled(rows, target, run, 30, 20)
    assert sorted((str(r["doc_id"]), r["n_features"], r["weight"], r["score"]) for r in got) == sorted((str(k), *w) for (k, _), w in zip(rows, want, strict=True))
    assert [r["doc_id"] for r in sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])] == [rows[i][0] for i in drawn]


def test_resampling_corner_cases(spark, docs, empty):
    found = importance.resample(docs, empty, percent=50)
    assert found.count() == docs.count() and found.where("rank is not null").count() == 1  # of documents with twenty words there are two
    assert importance.resample(empty, docs).count() == 0
    assert {(r["n_features"], r["weight"], r["rank"]) for r in found.where("doc_id in (2, 3, 6)").collect()} == {(0, 0, None)}


def test_runs_from_payloads():
    text = "A long-ish text; é\U0001f600 with " + "w" * 1000 + " words"
    known = importance.Payloads([w.encode() for w in words(text)[:3]])
    own = words(text)
    for k, crc in enumerate(importance.run_crcs(*known.scan(text), 5), 1):
        assert crc.tolist() == [zlib.crc32(" ".join(own[i : i + k]).encode()) for i in range(len(own) - k + 1)]


# --- nearest neighbours


def closest(ids, x, k, every=50):
    """query id -> ids of the k nearest others, ties by id."""
    x = np.asarray(x, dtype=np.float64)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    out = {}
    for q in np.flatnonzero(ids % every == 0):
        near = unit @ unit[q]
        near[ids == ids[q]] = -9
        out[int(ids[q])] = [int(ids[i]) for i in np.lexsort((ids, -near.round(12)))[:k] if near[i] > -9]
    return out


def recall(found, want):
    got = {}
    for r in found:
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    return sum(len(set(got[q]) & set(x)) for q, x in want.items()) / sum(map(len, want.values()))


@pytest.mark.parametrize("kind", ["even", "clusters"])
def test_recall_of_collision_counting(spark, monkeypatch, kind):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(9000, 64))
    if kind == "clusters":  # a third of all vectors lies close together
        x[::3] = x[0] + 0.05 * rng.normal(size=x[::3].shape)
    ids = np.arange(len(x))
    monkeypatch.setattr(neighbours, "SAMPLE_ROWS", 500)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 100)  # queries in two blocks
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    found = neighbours.nearest(df).collect()
    assert recall(found, closest(ids, x, 5)) >= 0.95
    for r in found[:200]:
        a, b = x[r["query_id"]], x[r["vec_id"]]
        assert math.isclose(r["score"], a @ b / math.sqrt(a @ a) / math.sqrt(b @ b), rel_tol=1e-12)
    ranks = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        ranks.setdefault(r["query_id"], []).append((r["rank"], -r["score"], r["vec_id"]))
    assert all([x[0] for x in rows] == [1, 2, 3, 4, 5] and [x[1:] for x in rows] == sorted(x[1:] for x in rows) for rows in ranks.values())


def test_work_stops_short_of_all_vectors():
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(4000, 64))
    rows[:20] = rows[0] + 0.02 * rng.normal(size=(20, 64))
    block = neighbours.Block(np.arange(4000), rows, neighbours.directions(64))
    low, high = block.windows((rows[:1] / np.linalg.norm(rows[0])) @ block.axes.T, np.array([0.1]))
    count = np.bincount(np.concatenate([o[a:b] for o, a, b in zip(block.order, low[0], high[0], strict=True)]), minlength=4000)
    assert set(np.flatnonzero(count >= neighbours.THRESHOLD)) == set(range(20))


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0]), (9, [-1.0, 1.0]), (50, []), (100, [1e300, 1e300]), (None, [1.0, 0.0]), (150, None)]
    df = spark.createDataFrame([(*r, 0.5, 1) for r in rows], "vec_id long, embedding array<double>, score double, rank int")
    found = {(r["query_id"], r["rank"]): (r["vec_id"], round(r["score"], 9)) for r in neighbours.nearest(df, k=4).collect()}
    assert [found[0, i] for i in (1, 2, 3, 4)] == [(1, 1.0), (2, 1.0), (None, 1.0), (100, round(math.sqrt(0.5), 9))]
    assert found[100, 4][0] is None and {q for q, _ in found} == {0, 100}
    assert neighbours.nearest(df.limit(0)).count() == 0 and neighbours.nearest(df.where("vec_id in (3, 4)")).count() == 0
    few = neighbours.nearest(df.where("vec_id in (0, 9)")).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in few] == [(0, 1, 9)]


# --- ranked search


def ranking(docs, items, most):
    """item -> [(score, doc)], the best first."""
    own = [(k, Counter(words(t))) for k, t in docs if words(t)]
    n, total = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = {}
    for item in {i for i, _ in items}:
        terms, rows = {w for i, t in items if i == item for w in words(t)}, []
        for k, c in own:
            m = 50 + 50 * sum(c.values()) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            rows.append((-score, k is None, k))
        out[item] = [(-s, k) for s, _, k in sorted(rows)[:most] if s < 0]
    return {i: x for i, x in out.items() if x}


@pytest.mark.parametrize("held", [400_000, 40])
def test_search_against_brute_force(spark, monkeypatch, held):
    monkeypatch.setattr(lexical, "MOST_HELD", held)
    copies = [(1000 + i, "the zyx of it") for i in range(300)]  # one class with most of the rows
    docs = [*enumerate(texts(4, 200)), *copies, (3000, None), (3001, "..."), (3002, ""), (None, "the zyx of it"), (5, texts(4, 200)[5])]
    random.shuffle(docs)
    items = [*enumerate(texts(6, 12)), (50, "zyx"), (51, None), (52, "unheard"), (53, "Zyx of"), (53, "it straße")]
    want = ranking(docs, items, 50)
    for blocks in (2_000, 5):
        monkeypatch.setattr(lexical, "MOST_ITEMS", blocks)
        got = {}
        frames = spark.createDataFrame([(k, t, 9) for k, t in docs], "doc_id long, text string, rank int").repartition(5), spark.createDataFrame(items, "item_id long, text string")
        for r in sorted(lexical.search(*frames).collect(), key=lambda r: (r["item_id"], r["rank"])):
            got.setdefault(r["item_id"], []).append((r["score"], r["doc_id"]))
            assert r["rank"] == len(got[r["item_id"]])
        assert got == want


def test_search_of_nothing(spark, docs, empty):
    items = docs.selectExpr("doc_id as item_id", "text")
    assert lexical.search(empty, items).count() == 0 and lexical.search(docs, items.limit(0)).count() == 0
    assert lexical.search(docs, items.where("text is null")).count() == 0


def test_equal_hashes_of_different_bags_stay_apart(spark, monkeypatch):
    from pyspark.sql import functions as F

    plain = lexical.classes
    monkeypatch.setattr(lexical, "classes", lambda *a: plain(*a).withColumn("class", F.lit(1).cast("long")))
    docs, items = list(enumerate(texts(8, 40))), list(enumerate(texts(9, 5)))
    got = {}
    for r in sorted(lexical.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect(), key=lambda r: (r["item_id"], r["rank"])):
        got.setdefault(r["item_id"], []).append((r["score"], r["doc_id"]))
    assert got == ranking(docs, items, 50)
