"""Operators against brute force on small fixtures, and their corner cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import chat, decontaminate, html_text, licenses, packing, quality_model, quality_rules, simhash, token_files, toxicity
from tidemark.llm.common import text_slices
from tidemark.llm.tokens import Encoder, vocabulary_path

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def by_key(df, key="doc_id"):
    return sorted(df.collect(), key=lambda r: r[key])


# --- license scans


def test_license_phrases_and_rules(spark, docs, empty):
    found = by_key(licenses.scan_licenses(docs))
    assert [r["doc_id"] for r in found] == [1, 2, 3, 4, 5, 5, 6, 7]
    five = found[4]
    assert (five["n_base"], five["first_word"], five["last_word"]) == (2, 8, 11) and five["base_labels"] == ["cc-by", "reserved"]
    assert five["labels"] == ["apache", "cc-by", "reserved"] and five == found[5]
    assert [d["label"] for d in five["detections"]] == ["apache", "reserved", "cc-by"]  # names inside the grant are suppressed
    assert found[1]["n_words"] == 0 and found[1]["first_word"] is None and found[1]["labels"] == [] and found[1]["score"] == 0
    assert licenses.scan_licenses(empty).count() == 0
    random.seed(1)
    bits = ["cc", "by", "all", "rights", "reserved", "general", "public", "license", "x", "É"]
    texts = ["".join(random.choice(bits) + random.choice([" ", "-", "\n", ".. "]) for _ in range(60)) for _ in range(40)]
    rows = by_key(licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    for text, r in zip(texts, rows, strict=True):
        own = words(text)
        places = [i for p, _ in licenses.PHRASES for i in range(len(own)) if own[i : i + len(p.split())] == p.split()]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(own), len(places), min(places, default=None), max(places, default=None))


def test_containment_suppression(spark):
    text = "released under the terms of the gnu general public license, version 3 and see the mit license"
    rows = licenses.detections(spark.createDataFrame([(1, text)], "row long, low string")).orderBy("start").collect()
    assert [(r["label"], r["priority"]) for r in rows] == [("gpl", 4), ("mit", 2)]
    assert text[rows[0]["start"] : rows[0]["end"]].startswith("released under") and len(licenses.rule_list()) > 200
    python = {r[0]: re.compile(r[5]) for r in licenses.rule_list()}
    every = [(m.start(), m.end(), r[3], r[0]) for r in licenses.rule_list() for m in python[r[0]].finditer(text)]
    kept = [d for d in every if not any(e != d and e[0] <= d[0] and e[1] >= d[1] and e[2] >= d[2] and (e[:2] != d[:2] or e[2] > d[2] or e[3] < d[3]) for e in every)]
    assert sorted((a, b) for a, b, *_ in kept) == [(r["start"], r["end"]) for r in rows]


# --- toxicity


def test_marginals_against_the_plain_recursion():
    rng = np.random.default_rng(3)
    sizes = [1, 5, 40, 2, 300]
    e, first = rng.normal(-1, 3, sum(sizes)), np.zeros(sum(sizes), dtype=bool)
    first[np.cumsum([0, *sizes[:-1]])] = True
    trans, start = rng.normal(size=(2, 2)), rng.normal(size=2)
    want, at = [], 0
    for n in sizes:
        own, f, b = e[at : at + n], np.zeros((n, 2)), np.zeros((n, 2))
        f[0] = start + [0, own[0]]
        for t in range(1, n):
            f[t] = [np.logaddexp(*(f[t - 1] + trans[:, j])) + (own[t] if j else 0) for j in (0, 1)]
        for t in range(n - 2, -1, -1):
            b[t] = [np.logaddexp(trans[i, 0] + b[t + 1, 0], trans[i, 1] + own[t + 1] + b[t + 1, 1]) for i in (0, 1)]
        want += np.exp(f[:, 1] + b[:, 1] - np.logaddexp(*f[-1])).tolist()
        at += n
    assert np.allclose(toxicity.marginals(e, first, trans, start), want, atol=1e-9)


def test_words_and_their_features():
    """Words against a regular expression, also of texts longer than a piece; features tell words apart by text alone."""
    rng = random.Random(8)
    bits = ["word", "Été", "x1y", " ", "_", "\u00a0", "İstanbul", "\U0001f600", "straße", ", ", "ΣΑΣ", "9", "\n", "中文"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 50))) for _ in range(200)] + [None, "", "ab " * 400_000, "z" * 700_000 + " end"]
    seen, spans = {}, [[] for _ in texts]
    for owner, found, at in toxicity.words(texts):
        assert found.shape == (len(at), toxicity.N_FEATURES) and found.min(initial=0) >= 0 and found.max(initial=0) < toxicity.SPACE
        for i, f, (a, b) in zip(owner.tolist(), found, at.tolist(), strict=True):
            spans[i].append((a, b))
            if b - a < 20:
                word = "".join(c.lower() if c.isupper() and len(c.lower()) == 1 else c for c in texts[i][a:b])
                assert seen.setdefault(word, tuple(f)) == tuple(f)
    for text, own in zip(texts[:-1], spans[:-1], strict=True):
        assert own == [m.span() for m in re.finditer(r"[^\W\d_]+", text or "")]
    assert spans[-1][-1] == (700_001, 700_004) and len(set(seen.values())) == len(seen)
    assert len(set(seen["word"]) & set(seen["wordword"])) == 1  # the end


def test_suspects_against_plain_counts():
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["alpha", "alphabet", "beta", "vilest", "vile", "gamma"]) for _ in range(rng.randint(0, 9))) for _ in range(60)]
    labels = [int("vile" in t) for t in texts]
    counts = toxicity.counts_of(texts, labels)
    feature = {w: f[0] for w in ("alpha", "vile") for _, f, _ in toxicity.words([w])}
    for place in {int(x) for f in feature.values() for x in f[: 1 + len(toxicity.STEMS)]}:
        for y in (0, 1):
            often = [sum(place in f[0, : 1 + len(toxicity.STEMS)] for w in t.split() for _, f, _ in toxicity.words([w])) for t, k in zip(texts, labels, strict=True) if k == y]
            assert counts[y, :, place].tolist() == [sum(n >= 1 for n in often), sum(n >= 2 for n in often)]


def test_chain_training_against_all_labellings():
    """The gradient of every pass against sums over all labellings of each segment."""
    from itertools import product

    rng = np.random.default_rng(5)
    kinds = rng.integers(0, 40, (6, toxicity.N_FEATURES)).astype(np.int32)
    found = [kinds[rng.integers(0, 6, n)] for n in (3, 1, 4, 2)]
    marks, weights = [rng.integers(0, 2, len(x)) for x in found], [1, 3, 2, 1]
    model = toxicity.train_chain(found, marks, weights, rounds=12)
    w, bias, trans, start = np.zeros(40), -4.0, np.zeros((2, 2)), np.zeros(2)
    sums = [np.full(40, 1e-8), 1e-8, np.full((2, 2), 1e-8), np.full(2, 1e-8)]
    used = np.isin(np.arange(40), np.concatenate(found))
    for _ in range(12):
        slope = [1e-6 * w * used, 0.0, np.zeros((2, 2)), np.zeros(2)]
        for own, m, k in zip(found, marks, weights, strict=True):
            ways = list(product((0, 1), repeat=len(own)))
            e = bias + w[own].sum(axis=1)
            chance = np.exp([start[y[0]] + sum(e[t] * y[t] for t in range(len(y))) + sum(trans[y[t - 1], y[t]] for t in range(1, len(y))) for y in ways])
            for y, p in [*zip(ways, chance / chance.sum(), strict=True), (tuple(m.tolist()), -1.0)]:
                p = p * k / sum(weights)
                for t, on in enumerate(y):
                    if on:
                        slope[1] += p
                        np.add.at(slope[0], own[t], p)
                    if t:
                        slope[2][y[t - 1], on] += p
                slope[3][y[0]] += p
        sums = [a + g**2 for a, g in zip(sums, slope, strict=True)]
        w, bias = w - 0.4 * slope[0] / np.sqrt(sums[0]), bias - 0.4 * slope[1] / np.sqrt(sums[1])
        trans, start = trans - 0.08 * slope[2] / np.sqrt(sums[2]), start - 0.08 * slope[3] / np.sqrt(sums[3])
    got = np.zeros(40)
    got[model.places] = model.weights
    assert np.allclose(got, w, atol=2e-3) and np.isclose(model.bias, bias) and np.allclose(model.trans, trans) and np.allclose(model.start, start)


def test_scores_against_plain_sums():
    rng = np.random.default_rng(6)
    model = toxicity.Model(np.arange(0, toxicity.SPACE, 7), rng.normal(0, 2, len(range(0, toxicity.SPACE, 7))), -3.0, rng.normal(size=(2, 2)), rng.normal(size=2), (0.4, 0.9, -0.7, 0.2))
    texts = ["one two three four", None, "", "five " * 30, "Six\u00a0seven 8 nine"]
    score, found = model.score(texts)
    for s, (p, at), t in zip(score, found, texts, strict=True):
        assert [(t or "")[a:b] for a, b in at] == re.findall(r"[^\W\d_]+", t or "")
        rest = min(sum(np.log1p(-x) for x in p if x >= toxicity.LIKELY), min(np.log1p(-p), default=0.0))
        q = min(max(-np.expm1(rest), 6e-6), 1 - 6e-6)
        x = 0.4 * np.log(q / (1 - q)) + 0.9 * np.log(sum(x for x in p if x >= toxicity.LIKELY) + 0.05) - 0.7 * np.log(len(p) + 20) + 0.2
        assert np.isclose(s, 1 / (1 + np.exp(-x)))


def test_logistic_fit_is_the_best():
    rng = np.random.default_rng(1)
    x = np.column_stack([rng.normal(size=(300, 3)), np.ones(300)])
    y = (rng.random(300) < 1 / (1 + np.exp(-(x @ [1.0, -2.0, 0.5, 0.3])))).astype(float)
    loss = lambda b: np.sum(np.log1p(np.exp(-(2 * y - 1) * (x @ b)))) + 0.005 * np.sum(np.square(b))
    b = np.array(toxicity.fit_score(x, y))
    assert all(loss(b) <= loss(b + rng.normal(0, 0.02, 4)) for _ in range(200)) and toxicity.fit_score(x, y * 0) is None


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(5)
    clean = ["alpha", "beta", "gamma", "delta", "vile", "nasty", "epsilon", "omega"]
    rows = []
    for i in range(600):
        toxic = i % 5 == 0
        own = [rng.choice(clean) + rng.choice(["", "s", "ing"]) for _ in range(rng.randint(8, 60))]
        if toxic:
            own.insert(rng.randrange(len(own)), rng.choice(["grobold", "grobolding", "snarfle", "snarfler"]))
        junk = i % 7 == 0
        rows.append((i, (" ### ".join(own) if junk else " ".join(own) + "."), int(toxic), int(not junk)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int, quality int")


def test_toxicity_labels_that_are_odd(spark, labelled):
    """Labels of ids without a document, null ones, several of an id; near copies count once."""
    docs = labelled.select("doc_id", "text")
    own = labelled.select("doc_id", "toxic")
    extra = spark.createDataFrame([(10**9, 1), (None, 1), (3, None), (0, 0), (0, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, own.unionByName(extra))
    scored = toxicity.score_toxicity(labelled, model).join(labelled.where(~toxicity.training_fold()), "doc_id").collect()
    assert all((r["score"] >= 0.3) == bool(r["toxic"]) for r in scored)
    long = " ".join(f"w{i}" for i in range(200))
    rows = [(long, 1), (long + " more", 1), (long + " more", 0), ("else", 1), ("", 1), (None, 0)]
    assert toxicity.without_near_copies(spark.createDataFrame(rows, "text string, y int")).count() == 5


def test_toxic_spans_point_at_the_text(spark, labelled):
    model = toxicity.train(labelled.select("doc_id", "text"), labelled.select("doc_id", "toxic"))
    text = "İİİ alpha beta GROBOLD gamma\u00a0snarfle delta"
    row = toxicity.score_toxicity(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert [text[x["start"] : x["end"]] for x in row["spans"]] == ["GROBOLD", "snarfle"] and row["score"] >= 0.3


def test_toxicity_learns_and_points(spark, docs, empty, labelled):
    model = toxicity.train(labelled.select("doc_id", "text"), labelled.select("doc_id", "toxic"))
    scored = toxicity.score_toxicity(labelled, model).join(labelled.where(~toxicity.training_fold()), "doc_id").collect()
    assert len(scored) > 100 and all((r["score"] >= 0.3) == bool(r["toxic"]) for r in scored)
    hits = {r["text"][s["start"] : s["end"]] for r in scored for s in r["spans"]}
    assert hits and all(h.startswith(("grobold", "snarfle")) for h in hits)
    assert [r["score"] < 0.3 for r in by_key(toxicity.score_toxicity(docs, model))] == [True] * 8
    assert toxicity.score_toxicity(empty, model).count() == 0
    assert toxicity.keep_civil(docs, model).columns == docs.columns
    nothing = toxicity.train(labelled.select("doc_id", "text"), labelled.select("doc_id", F.lit(0).alias("toxic")))
    assert toxicity.score_toxicity(labelled, nothing).where("score >= 0.3").count() == 0


# --- pages


PAGE = """<html><head><title>T</title></head><body><header><h1>Site</h1></header><nav><a>Menu</a></nav>
<div class="cookie-notice">We use cookies</div>{main}<aside>More</aside><div id="comments"><p>First!</p></div>
<form><input><button>Go</button></form><script>if (a < b) {{ x("</p>") }}</script><footer>&copy; me</footer></body></html>"""


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (PAGE.format(main="<article><h1>One &amp; two</h1><p>a<b>b</b>\n c<p>d<!-- no --><br>e</article>"), "One & two ab c d e"),
        (PAGE.format(main="<main><header><h2>H</h2></header><div class='ad'>buy</div><p>x&#x41;</p><article class='comment'><p>no</p></article></main>"), "H xA"),
        ("<article><p hidden>no</p><p class='advert'>no<p>yes</article>", "yes"),
        (None, ""),
        ("", ""),
        ("<p>loose <i>te</i>xt", "loose text"),
        ("<div>top</div><div class='post-content'><div>a</div><div class='share'>s</div><p>b</div><div>end</div>", "a b"),
        ("<div id='content'><p>by me</p><article>text</article></div>", "text"),
        ("<div role=main>x<section>y</section></div>z", "x y"),
        ("<article>5 < 6 &am x</article>", "5 < 6 &am x"),
        ("<div class='layout-with-sidebar'><article>text</article></div>", "text"),
        ("<div class='related'><article>no</article></div><article>text</article>", "text"),
        ("<article>a <svg/> b <p>c <iframe src=x>d", "a b c d"),
        ("<p title=it's>Hello</p><p>World's end", "Hello World's end"),
        ("<article><div class='side-effects'>a</div><div class='share-buttons'>b</div><div id=post-footer>c</div>d</article>", "a d"),
    ],
)
def test_page_text(spark, page, want):
    rows = spark.createDataFrame([(1, "http://h/x", page)], "page_id long, url string, html string")
    assert html_text.extract_text(rows).select("text").first()[0] == want


def test_host_boilerplate_goes(spark):
    shared = "welcome to the one site that has all of the best things you want"
    pages = [(i, f"http://{'big' if i < 40 else f'h{i}'}.example/{i}", f"<div>{shared}</div><div>number{i} unique body speaks of topic{i * 7} at length{i}</div>") for i in range(44)]
    df = spark.createDataFrame([*pages, (99, None, None)], "page_id long, url string, html string").repartition(5)
    for r in html_text.extract_text(df).collect():
        i = r["page_id"]
        own = f"number{i} unique body speaks of topic{i * 7} at length{i}"
        assert r["text"] == ("" if i == 99 else own if i < 40 else f"{shared} {own}"), r


def test_suffix_array_against_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(60):
        sizes = rng.integers(0, 40, rng.integers(1, 7))
        words = rng.integers(0, 3, sizes.sum()).astype(np.uint32)
        text, order, lcp = html_text.suffix_array(words, sizes)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
        for a, b, n in zip(order[:-1], order[1:], lcp[1:], strict=True):
            x, y = text[a:], text[b:]
            assert (x[:n] == y[:n]).all() and (len(x) == n or len(y) == n or x[n] != y[n])
        streams = np.split(words, np.cumsum(sizes)[:-1])
        for least in (1, 2, 3):
            seen = {}
            for k, own in enumerate(streams):
                for i in range(len(own) - 3):
                    seen.setdefault(int(html_text.window_keys(own[i : i + 4], 4)[0]), set()).add(k)
            keys, pages = html_text.repeats(streams, 4, least)
            assert dict(zip(keys.tolist(), pages.tolist(), strict=True)) == {k: len(v) for k, v in seen.items() if len(v) >= least}


def plain_texts(pages, limits):
    """Texts of (host, blocks) by sets of pages that hold each run of words."""
    out = []
    for host, blocks in pages:
        others = {tuple(b) for h, b in pages if h == host}
        holders = {}
        for other in others:
            own = [w for _, t in other for w in t.split()]
            for i in range(len(own) - 7):
                holders.setdefault(tuple(own[i : i + 8]), set()).add(other)
        words = [w for _, t in blocks for w in t.split()]
        repeated, wide = set(), set()
        for i in range(len(words) - 7):
            n = len(holders[tuple(words[i : i + 8])])
            if n >= max(limits.least, limits.repeated * len(others)):
                repeated |= set(range(i, i + 8))
                if n >= max(limits.least_wide, limits.wide * len(others)):
                    wide |= set(range(i, i + 8))
        at, spans = 0, []
        for kind, t in blocks:
            spans.append((kind, range(at, at := at + len(t.split()))))
        main = [r for k, r in spans if k == "main"]
        if main:
            stay = [r for r in main if 2 * len(wide.intersection(r)) < len(r)]
            keep = [i for r in (stay if 2 * sum(map(len, stay)) >= sum(map(len, main)) else main) for i in r]
        else:
            keep = [i for k, r in spans if k == "open" for i in r if i not in wide]
            unique = [i for i in keep if i not in repeated]
            keep = unique if 5 * len(unique) >= len(keep) else keep
        out.append(" ".join(words[i] for i in keep))
    return out


@pytest.mark.parametrize("split", [False, True])
def test_texts_against_brute_force(spark, monkeypatch, split):
    """Menus, notices that all articles of a host hold, copied articles, pages without a region."""
    if split:  # hosts in parts that are counted exactly, nothing sent to every task
        monkeypatch.setattr(html_text, "PART_BYTES", 4000)
        monkeypatch.setattr(html_text, "PART_PAGES", 4)
        monkeypatch.setattr(html_text, "MOST_BYTES", 0)
        monkeypatch.setattr(html_text, "MOST_HOSTS", 0)
    rng = random.Random(7)
    prose = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    tag = {"main": "p", "open": "div", "out": "nav"}
    pages, rows = [], []
    for host in ("a.example", "b.example"):
        menus, notice, passages, copy = [prose(12) for _ in range(2)], prose(14), [prose(30) for _ in range(3)], prose(60)
        for i in range(60 if host[0] == "a" else 12):
            blocks = [("out", rng.choice(menus))]
            kind = "main" if rng.random() < 0.7 else "open"
            if kind == "open":
                blocks.append(("open", rng.choice(menus)))
            own = [(kind, prose(rng.randint(5, 60))) for _ in range(rng.randint(1, 3))]
            if rng.random() < 0.3:
                own.append((kind, rng.choice(passages) + " " + prose(9)))
            if rng.random() < 0.2:
                own = [(kind, copy)]
            if rng.random() < 0.8:
                own.insert(rng.randrange(len(own) + 1), (kind, notice))
            blocks += [*own, ("out", prose(6))]
            pages.append((host, blocks))
            body = "".join(f"<{tag[k]}>{t}</{tag[k]}>" for k, t in blocks)
            if kind == "main":
                body = body.replace("<p>", "<article><p>", 1)[::-1].replace("</p>"[::-1], "</p></article>"[::-1], 1)[::-1]
            rows.append((len(rows), f"https://{host}/{i}", body))
    pages, rows = pages + pages[:5], rows + rows[:5]  # repeated rows keep their text
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("host", F.lit(1)).repartition(7)
    found = {}
    for r in html_text.extract_text(df).collect():
        found.setdefault(r["page_id"], []).append(r)
    want = plain_texts(pages, html_text.Limits())
    cut = 0
    for (i, *_), text in zip(rows, want, strict=True):
        assert {r["text"] for r in found[i]} == {text} and len(found[i]) == (2 if i < 5 else 1)
        cut += found[i][0]["n_cut"] > 0
    assert cut > 40 and sum(r[0]["n_covered"] > 0 for r in found.values()) > 60


def test_page_corner_cases(spark):
    schema = "page_id long, url string, html string"
    assert html_text.extract_text(spark.createDataFrame([], schema)).count() == 0
    long = " ".join(f"word{i}" for i in range(200_000))
    rows = [(1, None, "<p>same words stand here twice in two equal rows</p>")] * 2 + [(2, "http://h/", f"<article>{long}</article>"), (3, "http://h/", "<svg>" * 3000 + "x"), (4, "http://h/", ""), (None, None, None)]
    out = html_text.extract_text(spark.createDataFrame(rows, schema)).collect()
    assert [r["text"] for r in out if r["page_id"] == 1] == ["same words stand here twice in two equal rows"] * 2
    assert {r["page_id"]: r["text"] for r in out if r["page_id"] != 1} == {2: long, 3: "x", 4: "", None: ""}


# --- quality rules


def test_quality_counts(spark, docs, empty):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("ab#") * rng.randint(1, 2) for _ in range(n)) + rng.choice(["", "\n", "\nx\nx\n\n"]) for n in (0, 3, 8, 30, 200) for _ in range(4)]
    rows = by_key(quality_rules.quality_report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    for text, r in zip(texts, rows, strict=True):
        own = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        wins = [tuple(own[i : i + 8]) for i in range(len(own) - 7)]
        in_two = {k for i, w in enumerate(wins) if wins.count(w) > 1 for k in range(i, i + 8)}
        lines = [x for x in text.split("\n") if x.strip(" \t\r\x0b\x0c")]
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"], r["n_dup_lines"]) == (len(own), sum(map(len, own)), len(in_two), len(lines) - len(set(lines)))
        assert r["n_symbols"] == text.count("#") and r["base_failed"] == (len(own) < 20 or 100 * len(in_two) > 30 * len(own))
    assert [r["kept"] for r in by_key(quality_rules.quality_report(docs))] == [True, False, False, False, False, False, False, False]
    assert quality_rules.quality_report(empty).count() == 0
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [1]


def test_bands_reject_noise_and_repeats():
    import zstandard

    pack, bands = zstandard.ZstdCompressor(level=3), quality_rules.Bands()
    noise = np.random.default_rng(0).integers(33, 127, 20_000).astype(np.uint8).tobytes()
    assert not quality_rules.ratio_verdict(noise, bands, pack)[2]
    assert not quality_rules.ratio_verdict(b"word " * 4000, bands, pack)[2]


def plain_verdict(raw):
    """The bands, read off their table one chunk at a time."""
    import zstandard

    bands, ratio = quality_rules.Bands(), lambda x: len(x) / len(zstandard.compress(x, 3))
    if not raw:
        return False
    low, high = [(a, b) for most, a, b in bands.whole if len(raw) < most][0]
    if not low <= ratio(raw) <= high:
        return False
    rules = [r for r in bands.chunks if len(raw) >= r[0]]
    if not rules:
        return True
    _, size, low, high = rules[-1]
    parts, rest = [], raw
    while len(rest) >= size:
        parts.append(rest[:size])
        rest = rest[size:]
    if rest:
        parts.append(raw[-size:])
    return sum(not low <= ratio(p) <= high for p in parts) <= bands.chunk_share * len(parts)


def test_verdicts_against_a_plain_version(spark):
    rng, plain = np.random.default_rng(3), random.Random(3)
    noise = lambda n: rng.integers(33, 127, n).astype(np.uint8).tobytes().decode()
    prose = lambda n: " ".join("".join(plain.choice(["an", "the", "or", "in", "st", "re", "o", "ly"]) for _ in range(plain.randint(1, 4))) for _ in range(n))
    texts = [prose(n) for n in (5, 30, 150, 700, 3000, 9000)]
    texts += [noise(n) for n in (90, 600, 1500, 5000, 40_000)] + ["so it goes " * n for n in (9, 60, 400, 5000)]
    texts += [prose(n) + noise(m) for n in (150, 400, 700, 1500, 4000) for m in (400, 1500, 4000)]  # the end counts as well
    rows = by_key(quality_rules.quality_report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    want = [plain_verdict(t.encode()) for t in texts]
    assert [r["kept"] for r in rows] == [w and not r["base_failed"] for w, r in zip(want, rows, strict=True)]
    assert 5 < sum(want) < len(want) - 10


@pytest.mark.parametrize("n", [1100, 2500, 4000, 8000, 12_200, 30_000])
def test_noise_at_the_end_is_seen(n):
    import zstandard

    plain = random.Random(n)
    raw = " ".join("".join(plain.choice(["an", "the", "or", "in", "st", "re", "o", "ly"]) for _ in range(plain.randint(1, 4))) for _ in range(n)).encode()[: n - n // 3]
    end = np.random.default_rng(n).integers(33, 127, n // 3).astype(np.uint8).tobytes()
    pack, bands = zstandard.ZstdCompressor(level=3), quality_rules.Bands()
    assert quality_rules.ratio_verdict(raw, bands, pack)[2] and not quality_rules.ratio_verdict(raw + end, bands, pack)[2]


# --- decontamination


def test_overlap_against_brute_force(spark, docs, empty):
    rng = random.Random(9)
    vocabulary = ["alpha", "Beta", "gamma", "Éte"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(n))) for i, n in enumerate([3, 10, 12, 4, 0, 25])] + [(90, None), (91, "beta,,gamma")]
    texts = [", ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 80))) for _ in range(30)] + [None, ""]
    df, bench = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = decontaminate.find_overlap(df, bench)
    for r in by_key(whole):
        own, hit, who = words(texts[r["doc_id"]]), set(), set()
        for item, t in items:
            w = words(t)
            for win in {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else ():
                for i in range(len(own) - len(win) + 1):
                    if tuple(own[i : i + len(win)]) == win:
                        hit |= set(range(i, i + len(win)))
                        who.add(item)
        assert r["n_words"] == len(own) and {k for s in r["spans"] for k in range(s["first"], s["past"])} == hit and r["items"] == sorted(who)
        assert [texts[r["doc_id"]][c["start"] : c["end"]].count(",") + 1 for c in r["chars"]] == [s["past"] - s["first"] for s in r["spans"]]
    assert decontaminate.find_overlap(df, bench.limit(0)).where("size(spans) > 0").count() == 0
    assert decontaminate.find_overlap(empty, bench).count() == 0 and decontaminate.find_overlap(docs, bench).count() == 8
    assert decontaminate.keep_clean(df, bench).count() == whole.where("size(spans) = 0").count()


@pytest.mark.parametrize("kind", ["long", "string"])
def test_blocks_of_items_give_the_same(spark, monkeypatch, kind):
    """Items of very unequal sizes, one of them most of the benchmark, by ids of any type."""
    texts = [(i % 5, f"a b c d e f g h i j k l {i} m n o p") for i in range(6)] + [(9, None), (None, "e f g h")]
    items = [(str(i), f"{'c d' if i % 2 else 'e f g'} {'h' if i % 3 == 0 else ''}".strip()) for i in range(9)]
    items += [("20", " ".join(f"x{i}" for i in range(3000)) + " a b c d e f g h i j"), (None, "m n"), ("21", None), ("22", "")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string").select(F.col("item_id").cast(kind).alias("item_id"), "text")
    total = lambda: sorted(((r["doc_id"] is None, r["doc_id"]), r["n"], tuple(r["items"])) for r in decontaminate.find_overlap(df, bench).withColumn("n", decontaminate.word_total("spans")).collect())
    clean = lambda: sorted(((r["doc_id"] is None, r["doc_id"]), r["text"] or "") for r in decontaminate.keep_clean(df, bench).collect())
    one, kept = total(), clean()
    assert any("20" in map(str, r[2]) for r in one) and ((False, 9), "") in kept
    monkeypatch.setattr(decontaminate, "BLOCK_SIGNS", 50_000)
    blocks = decontaminate.blocks_of(bench, 10, "item_id", "text")
    sizes = [sum(len(w) + 2 for w, _ in b.owners()) for b in blocks]
    assert len(blocks) > 3 and max(sizes) < 2 * sum(sizes) / len(sizes)
    assert total() == one and clean() == kept


# --- quality classifier


def test_quality_model(spark, docs, empty, labelled):
    fold = toxicity.training_fold(folds=3, held=1)
    model = quality_model.train(labelled.select("doc_id", "text"), labelled.select("doc_id", "quality"), fold)
    scored = quality_model.score_quality(labelled, model).join(labelled.where(~fold), "doc_id").collect()
    assert len(scored) > 100 and np.mean([(r["score"] >= 0.5) == bool(r["quality"]) for r in scored]) > 0.97
    assert quality_model.score_quality(docs, model).where("score between 0 and 1").count() == 8 and quality_model.score_quality(empty, model).count() == 0
    one_kind = quality_model.train(labelled.select("doc_id", "text"), labelled.select("doc_id", F.lit(1).alias("quality")), fold)
    assert quality_model.score_quality(docs, one_kind).where("score = 1").count() == 8


def plain_statistics(text):
    raw = (text or "").encode()
    own = [w.encode() for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    if not own:
        return [0.0] * 17
    n, chars = len(own), b"".join(own)
    lines = [x for x in raw.split(b"\n") if x]
    share = lambda kept: sum(b in kept for b in chars) / len(chars)
    sizes, kinds = [len(w) for w in own], len(set(own))
    mean = sum(sizes) / n
    packed = sum(len(zlib.compress(raw[i : i + 65536], 1)) for i in range(0, len(raw), 65536))
    return [
        np.log(1 + n), len(chars) / n, (sum((x - mean) ** 2 for x in sizes) / n) ** 0.5, kinds / n, np.log(kinds) / np.log(n + 1),
        *(share(k) ** 0.5 for k in (range(65, 91), range(48, 58), b".,;:!?", b"#*$%&|<>=~^_", b"!|")), sum(w.isupper() for w in own) / n,
        np.log(1 + len(lines)), len(set(lines)) / len(lines), len(raw) / packed, np.log(1 + len(raw) / len(lines)), sizes.count(1) / n, sum(b > 127 for b in chars) / len(chars),
    ]


def test_quality_model_against_a_plain_fit(spark, docs, labelled):
    """Statistics, features, summed normal equations, ridge weights and calibration."""
    fold = toxicity.training_fold(folds=3, held=1)
    given = labelled.select("doc_id", "text").unionByName(spark.createDataFrame([(5000 + i, t) for i, t in enumerate(["Éa b\n\nEIN 1 ! |", "x", "", None])], "doc_id long, text string"))
    labels = labelled.select("doc_id", "quality").unionByName(spark.createDataFrame([(5000, 0), (5001, 1), (5002, 0), (5003, 0), (77777, 1), (3, 0), (4, 1), (None, 1)], "doc_id long, quality int"))
    model = quality_model.train(given, labels, fold)
    sample = toxicity.labelled_sample(given, labels, "quality", fold).collect()
    assert {r["y"] for r in sample} == {0, 1} and len(sample) == len({(r["text"], r["y"]) for r in sample})
    x, y = np.array([plain_statistics(r["text"]) for r in sample]), np.array([r["y"] for r in sample])
    assert np.allclose(x, [quality_model.statistics(r["text"]) for r in sample])
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    rng = np.random.default_rng(6)
    freq, phase = rng.normal(0, np.sqrt(0.12), (17, 256)), rng.uniform(0, 2 * np.pi, 256)
    z = np.clip((x - mean) / scale, -6, 6)
    wide = np.column_stack([np.sqrt(2 / 256) * np.cos(z @ freq + phase), z, np.ones(len(z))])
    part = np.array([zlib.crc32((r["text"] or "").encode()) % 5 for r in sample])
    fit, share = part > 0, y.mean()
    w = np.where(y > 0, 0.5 / share, 0.5 / (1 - share))
    a, b = np.zeros((274, 274)), np.zeros(274)
    for row, t, k in zip(wide[fit], y[fit], w[fit], strict=True):
        a, b = a + k * np.outer(row, row), b + k * (2 * t - 1) * row
    weights = np.linalg.solve(a + 1e-3 * np.trace(a) / 274 * np.eye(274), b)
    assert np.allclose(model.weights, weights, atol=1e-6)
    # Isotonic levels by their min-max formula.
    raw, own = wide[~fit] @ weights, y[~fit]
    order = np.argsort(raw, kind="stable")
    raw, own = raw[order], own[order]
    level = [max(min(own[i : j + 1].mean() for j in range(k, len(own))) for i in range(k + 1)) for k in range(len(own))]
    pools = [np.flatnonzero(np.isclose(level, v)) for v in sorted(set(np.round(level, 12)))]
    assert np.allclose(model.knots[1:-1], [raw[p].mean() for p in pools], atol=1e-6)
    assert np.allclose(model.levels[1:-1], [(own[p].sum() + 0.5) / (len(p) + 1) for p in pools])


def test_isotonic_rises():
    x, y = quality_model.isotonic(np.array([3.0, 1, 2, 4, 5, 6]), np.array([0.0, 0, 1, 1, 0, 1]))
    assert (np.diff(x) > 0).all() and (np.diff(y) >= 0).all()


# --- chat


def test_best_branches_of_a_tree(spark):
    #  1 -> 2 -> 4 (3 points), 1 -> 3 -> 5 -> 6 ; 7 and 8 answer each other; 9 answers none there is
    rows = [("c", 1, None, "user", "q", 1.0), ("c", 2, 1, "assistant", "bad", 0.0), ("c", 3, 1, "assistant", "good", 5.0), ("c", 4, 2, "user", "x", 3.0), ("c", 5, 3, "user", "y", 3.0), ("c", 6, 5, "assistant", "z", 3.0)]
    rows += [("d", 7, 8, "user", "circle", 1.0), ("d", 8, 7, "user", "circle", 1.0), ("e", 9, 1, None, None, None), (None, 1, None, "user", "no id", 0.0)]
    df = spark.createDataFrame(rows, "conv_id string, id long, parent long, role string, text string, score double").withColumn("path", F.lit("clash"))
    out = {(r["conv_id"], r["rank"]): r for r in chat.format_conversations(df, n_best=2).withColumn("turns", chat.read_turns()).collect()}
    assert set(out) == {("c", 1), ("c", 2), ("e", 1), (None, 1)}
    assert [t["text"] for t in out["c", 1]["turns"]] == ["q", "good", "y", "z"] and [t["text"] for t in out["c", 2]["turns"]] == ["q", "bad", "x"]
    assert out["c", 1]["formatted"].startswith("### user: q</turn>\n### assistant: good</turn>\n")
    assert [tuple(t) for t in out["e", 1]["turns"]] == [("", "")]


def test_template_is_reversible(spark):
    texts = ["", "\\", "\\e</turn>\n### user: x", "a: b", "### ", "\\\\h### \\b: c", None, "ü\U0001f600", "</turn>\n"]
    rows = [(7, i, "assistant" if i % 2 else "us: er", t) for i, t in enumerate(texts)] + [(8, 0, "assistant", "x" * 100_000), (8, 0, "assistant", "tie")]
    df = chat.threads(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    out = {r["conv_id"]: r for r in chat.format_conversations(df).withColumn("turns", chat.read_turns()).withColumn("masked", chat.masked_text()).collect()}
    assert [t["text"] for t in out[7]["turns"]] == [t or "" for t in texts] and {t["role"] for t in out[7]["turns"]} == {"assistant", "us: er"}
    assert out[7]["masked"] == "".join(t or "" for i, t in enumerate(texts) if i % 2) and out[8]["masked"] == "tie" + "x" * 100_000
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_long_threads(spark):
    df = chat.threads(spark.range(700).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text")))
    assert [t["text"] for t in chat.format_conversations(df).select(chat.read_turns().alias("t")).first()["t"]] == [str(i) for i in range(700)]


# --- packing


def check_pieces(rows, lengths, length):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for k, spans in by_doc.items():
        ends = [0, *np.cumsum([n for _, n in sorted(spans)]).tolist()]
        assert [a for a, _ in sorted(spans)] == ends[:-1] and ends[-1] == lengths[k]
    fills = []
    for spans in by_sequence.values():
        ends = [0, *np.cumsum([n for _, n in sorted(spans)]).tolist()]
        assert [a for a, _ in sorted(spans)] == ends[:-1]
        fills.append(ends[-1])
    assert sorted(by_sequence) == list(range(len(by_sequence))) and all(n == length or n & (n - 1) == 0 for n in fills) and max(fills) <= length
    return fills


@pytest.mark.parametrize("weights", [None, {"a": 0.1, "b": 0.9}, {"a": 0.0, "b": 5.0, "none": 1.0}])
def test_packing_is_whole(spark, weights):
    rng = random.Random(8)
    docs = [(i, " ".join(rng.choice(["one", "two", "drei"]) for _ in range(rng.choice([0, 1, 30, 700]))), rng.choice(["a", "a", "a", "b", None])) for i in range(120)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(6)
    tokenizer = Encoder().tokenizer
    ids = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t, _ in docs}
    rows = packing.pack(df, length=128, weights=weights).collect()
    check_pieces(rows, {k: len(v) for k, v in ids.items()}, 128)
    for r in rows:
        raw = np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], dtype="<u4").tobytes()
        assert r["ids"] == raw and r["ids_crc32"] == zlib.crc32(raw) and r["doc_tokens"] == len(ids[r["doc_id"]])
    whole = packing.sequences(spark.createDataFrame(rows), 128)
    assert whole.agg(F.sum("n_tokens"), F.max(F.length("ids"))).first()[:] == (sum(map(len, ids.values())), 512)


def window_shares(rows, length):
    """Ids of each queue in each full window."""
    found = {}
    for r in rows:
        own = found.setdefault(r["sequence_id"], {})
        own[r["queue"]] = own.get(r["queue"], 0) + r["length"]
    return {k: v for k, v in found.items() if sum(v.values()) == length}


@pytest.mark.parametrize("weights", [None, {"s1": 0.4}])
def test_every_window_has_the_mixture(spark, weights):
    """Twenty sources: every window is within two ids of each share, as long as all sources last."""
    rng = random.Random(1)
    docs = [(i, " ".join(rng.choice(["one", "two", "drei"]) for _ in range(rng.randint(1, 400))), f"s{min(rng.randrange(26), 19)}") for i in range(1200)]
    rows = packing.pack(spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(5), length=1024, weights=weights, with_ids=False).collect()
    total = {}
    for r in rows:
        total[r["queue"]] = total.get(r["queue"], 0) + r["length"]
    n = sum(total.values())
    rest = n - sum(total[q] for q in weights or ())
    target = {q: (weights or {}).get(q, t / rest * (1 - sum((weights or {}).values()))) for q, t in total.items()}
    shares, last = window_shares(rows, 1024), min(t / target[q] for q, t in total.items())
    lasting = [v for k, v in shares.items() if (k + 2) * 1024 < last]
    apart = [sum(abs(v.get(q, 0) / 1024 - x) for q, x in target.items()) / 2 for v in lasting]
    assert len(lasting) > 40 and max(abs(v.get(q, 0) - 1024 * x) for v in lasting for q, x in target.items()) < 2 and np.mean(apart) < 0.01
    # Over many windows what falls short in one comes back in the next.
    for q, x in target.items():
        sent = np.cumsum([shares[k].get(q, 0) for k in range(len(lasting))])
        assert np.abs(sent - 1024 * x * np.arange(1, len(lasting) + 1)).max() < 1.01


def test_many_sources_keep_their_weights(spark):
    docs = [(i, "some words of a short text " * 40, f"s{i % 1100}") for i in range(2200)] + [(5000 + i, "a longer one with more of them " * 400, "s1") for i in range(80)]
    rows = packing.pack(spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(4), length=256, weights={"s1": 0.5}, with_ids=False).collect()
    shares, total = window_shares(rows, 256), sum(r["length"] for r in rows if r["queue"] == "s1")
    lasting = [v for k, v in shares.items() if (k + 2) * 128 < total]
    assert len(lasting) > 300 and all(abs(v["s1"] - 128) < 2 for v in lasting)
    sizes = {}
    for r in rows:
        sizes[r["doc_id"]] = r["doc_tokens"]
    check_pieces(rows, sizes, 256)


def test_packing_corner_cases(docs, empty):
    assert packing.pack(empty).count() == 0
    rows = packing.pack(docs.dropDuplicates(["doc_id"]), with_ids=False).collect()
    assert {r["doc_id"]: r["doc_tokens"] for r in rows}[2] == 1 and {r["queue"] for r in rows} == {"", "a", "b", "c"}


@pytest.mark.parametrize(("totals", "shares", "length"), [([1000, 317, 330, 55], [0.2, 0.5, 0.2, 0.1], 64), ([0, 900, 1, 70], [0.0, 0.9, 0.05, 0.05], 32), ([5], [1.0], 8), ([10**6, 3 * 10**6], [0.25, 0.75], 1024), ([3], [1.0], 8), ([40, 0, 500], [0.9, 0.1, 0.0], 16)])
def test_deficits_follow_round_robin(totals, shares, length):
    """The closed form against the window-by-window loop: carried credits, whole ids."""
    m = packing.Mixture.of(totals, shares, length)
    windows, sent = int(m.starts[-1]), [0] * len(totals)
    assert windows == sum(totals) // length
    for w in range(windows if windows < 2000 else 50):
        run = int(np.searchsorted(m.starts, w, side="right")) - 1
        n, ends = w - int(m.starts[run]), [int(x) for x in m.ends[run]]
        quota = [((n + 1) * length * b // ends[-1] - n * length * b // ends[-1]) - ((n + 1) * length * a // ends[-1] - n * length * a // ends[-1]) for a, b in zip(ends, ends[1:], strict=False)]
        assert min(quota) >= 0 and sum(quota) == length and all(s + k <= t for s, k, t in zip(sent, quota, totals, strict=True))
        for q in range(len(totals)):
            before, ahead = m.before(q, np.array([w]))
            assert before[0] == sent[q] and ahead[0] == sum(quota[:q])
            if quota[q]:
                assert m.window(q, np.array([sent[q], sent[q] + quota[q] - 1])).tolist() == [w, w]
        sent = [s + k for s, k in zip(sent, quota, strict=True)]
    if windows < 2000:
        for q, (s, t) in enumerate(zip(sent, totals, strict=True)):
            assert m.before(q, np.array([windows]))[0][0] == s and m.window(q, np.arange(s, t)).tolist() == [windows] * (t - s)


def test_windows_of_very_many_ids():
    """No product overflows at a hundred trillion ids."""
    m = packing.Mixture.of([6 * 10**13, 4 * 10**13 - 7, 10**11], [0.6, 0.4, 0.001], 1024)
    ids = np.array([0, 10**9, 5 * 10**13, 6 * 10**13 - 3000], dtype=np.int64)
    w = m.window(0, ids)
    assert ((m.before(0, w)[0] <= ids) & (m.before(0, w + 1)[0] > ids)).all() and abs(int(w[2]) - 5 * 10**13 / 1024 / (0.6 / 1.001)) < 10**4


# --- SimHash


def test_fingerprint_against_brute_force():
    rng = random.Random(6)
    for text in ["", None, "one", "a b c", *(" ".join(rng.choice("abcDÉ") for _ in range(n)) for n in (4, 5, 9, 60))]:
        own = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if w]
        shingles = [" ".join(own[i : i + 4]) for i in range(max(1, len(own) - 3))] if own else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        assert simhash.fingerprint(text) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_bit_sliced_pairs():
    rng = np.random.default_rng(1)
    for n in (1, 2, 63, 64, 65, 130, 600):
        fp = rng.integers(0, 2**64, 8, dtype=np.uint64)[rng.integers(0, 8, n)]
        for _ in range(5):
            fp = fp ^ np.where(rng.random(n) < 0.6, np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64), np.uint64(0))
        found = {(int(a), int(b)) for i, j in simhash.near_pairs(fp, np.full(n, n), 4) for a, b in zip(i, j, strict=True)}
        assert found == {(i, j) for i in range(n) for j in range(i + 1, n) if bin(int(fp[i]) ^ int(fp[j])).count("1") <= 4}


@pytest.mark.parametrize("cell_rows", [8192, 40])
def test_components_against_brute_force(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(simhash, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(simhash, "HOT_ROWS", cell_rows // 10)
    rng = random.Random(3)
    base = [" ".join(f"w{rng.randrange(5000)}" for _ in range(60)) for _ in range(12)]
    texts = []
    for _ in range(260):
        own = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 2])):
            own[rng.randrange(len(own))] = "changed"
        texts.append(" ".join(own))
    texts += [None, "", " "]
    rows = by_key(simhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    fp = [simhash.fingerprint(t) for t in texts]
    label = list(range(len(texts)))
    for _ in range(len(texts)):
        now = [min(label[j] for j in range(len(fp)) if bin(fp[i] ^ fp[j]).count("1") <= 4) for i in range(len(fp))]
        if now == label:
            break
        label = now
    assert [r["component_id"] for r in rows] == label and [r["fp"] & (2**64 - 1) for r in rows] == fp


def test_more_tables_find_the_same(spark):
    rng = np.random.default_rng(4)
    fp = np.unique(np.concatenate([rng.integers(0, 2**63, 50), rng.integers(0, 2**63, 1) ^ (1 << rng.integers(0, 62, 40))]))
    df = spark.createDataFrame([(int(x),) for x in fp], "fp long")
    want = {frozenset((int(a), int(b))) for a in fp for b in fp if a < b and bin(int(a) ^ int(b)).count("1") <= 4}
    for n in (100, 10**7, 10**10):
        links = {frozenset((r["u"], r["v"])) for r in simhash.near_links(df, 4, n).collect()}
        assert links <= want and (not want or links)


def test_near_duplicate_corner_cases(docs, empty):
    rows = simhash.near_duplicates(docs).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in rows) == [(1, 1), (2, 2), (3, 2), (4, 4), (5, 5), (5, 5), (6, 2), (7, 7)]
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 4, 5, 5, 7]


# --- token files


def test_token_files_round_trip(spark, docs, empty, tmp_path):
    texts = [(i, "word " * (i % 50) + "end") for i in range(300, 0, -1)]
    df = spark.createDataFrame([*texts, (0, None)], "doc_id long, text string").repartition(5)
    index = token_files.write_tokens(df, f"file://{tmp_path}/t", length=16)
    encoder, start = Encoder(), 0
    read = {r["doc_id"]: r for r in token_files.read_checks(index).collect()}
    for i, t in sorted([*texts, (0, "")]):
        ids = [*encoder.tokenizer.encode(t, add_special_tokens=False).ids, 2]
        assert (read[i]["start"], read[i]["n_tokens"], read[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)
    one = token_files.TokenFile(index.orderBy("doc_id").first()["file"])
    ids, mask = one.sequence(1)
    assert len(ids) == 16 and mask.all() and not ids.flags.owndata
    for i in (0, 1, 5):
        (own, bits), (again, _) = one.arrays(i), one.arrays(i)
        assert own.to_pylist() == one.sequence(i)[0].tolist() and bits.to_pylist() == one.sequence(i)[1].tolist()
        assert [b.address for b in (own.buffers()[1], bits.buffers()[1])] == [b.address for b in (again.buffers()[1], one.arrays(i)[1].buffers()[1])]  # the mapped file's bytes
    assert token_files.read_checks(token_files.write_tokens(empty, f"file://{tmp_path}/e")).count() == 0
    assert token_files.read_checks(token_files.write_tokens(docs, f"file://{tmp_path}/d")).count() == 8


def test_encoder_gives_the_librarys_ids():
    rng = random.Random(2)
    encoder = Encoder(vocabulary_path(), most=40)
    bits = ["a", "word", "Éx", ".", ",", " ", "  ", "\n", "\t", "'s", "\u00a0", "<|endoftext|>", "12", "x,", "y."]
    texts = ["".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randint(0, 30))) for _ in range(300)]
    got = encoder.encode(texts)
    for t, raw in zip(texts, got, strict=True):
        assert np.frombuffer(raw, dtype=encoder.dtype).tolist() == encoder.tokenizer.encode(t, add_special_tokens=False).ids, t


def test_words_are_encoded_once(monkeypatch):
    """Words met before, whatever newline or marks stand beside them, aren't handed to the library again."""
    encoder, rng, given = Encoder(), random.Random(4), []
    words = ["alpha", "beta", "Gamma", "délta", "x1"]
    marks = ["", ".", ",", ".***", "!", "%%%", "|"]
    encoder.encode(["start " + " ".join(w + m for w in words for m in marks) + "".join("\n" + w + m for w in words for m in marks)])
    texts = ["start" + "".join(rng.choice(" \n") + rng.choice(words) + rng.choice(marks) for _ in range(200)) for _ in range(50)]
    want = encoder._whole(texts)
    own = encoder.tokenizer

    class Counted:
        def encode_batch_fast(self, batch, **how):
            given.extend(batch)
            return own.encode_batch_fast(batch, **how)

    monkeypatch.setattr(encoder, "tokenizer", Counted())
    assert encoder.encode(texts) == want and given == ["start"] * 50


def test_encoder_splits_like_the_library_at_every_letter():
    """What Python takes for a letter or white space is so for the library's splitting, too."""
    encoder = Encoder()
    chars = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x14700), *range(0x16800, 0x18D10), *range(0x1B000, 0x20000, 3)]]
    texts = [f"x a{c}.\n{c}b, a{c}\nq{c}!? {c}\n{c} y\n\n{c}\n'{c}''." for c in chars]
    assert encoder.encode(texts) == encoder._whole(texts)
    assert encoder.encode([]) == [] and encoder.encode([None, "", " ", "\n", "a\nb"]) == encoder._whole(["", "", " ", "\n", "a\nb"])


def test_slices_by_bytes_of_text():
    texts = ["x" * n for n in (0, 3, 9, 40, 1)] + [None, "é" * 6, "", "y" * 10]
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], names=["k", "t"])
    parts = [x.column(0).to_pylist() for x in text_slices(batch, 1, 16)]
    assert sum(parts, []) == list(range(len(texts))) and len(parts) == 3
    assert [x.num_rows for x in text_slices(batch, 1)] == [9] and list(text_slices(batch.slice(0, 0), 1)) == []


def test_digest_of_no_items():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


@pytest.mark.parametrize(
    "page,text",
    [
        ("<div class='content sidebar-right'><h1>Head</h1><p>Body</p></div><div class='menu'>Home</div>", "Head Body"),
        ("<body><div class='page-banner post'><p>Body</p></div></body>", "Body"),
        ("<div id='post-related-content'><p>Body</p></div><footer>f</footer>", "Body"),
        ("<div class='comment content'><p>said</p></div>", ""),
        ("<div class='menu'>Home</div>", ""),
        ("<div class='sidebar-right'>x</div><div class='content'><p>Body</p></div>", "Body"),
    ],
)
def test_names_of_layouts(spark, page, text):
    assert " ".join(t for k, t in html_text.blocks_of(page) if k != "out") == text


def test_windows_of_many_items_fill_blocks(spark, monkeypatch):
    """A window that stands in every item counts by the ids beside it; results are as with one block."""
    line = " ".join(f"same{i}" for i in range(10))
    items = spark.createDataFrame([(i, f"{line} own{i}") for i in range(300)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"x {line} own7"), (2, "none")], "doc_id long, text string")
    shown = lambda: sorted((r["doc_id"], len(r["items"]), r["n"]) for r in decontaminate.find_overlap(docs, items).withColumn("n", decontaminate.word_total("spans")).collect())
    want = shown()
    assert want == [(1, 300, 11), (2, 0, 0)]
    monkeypatch.setattr(decontaminate, "BLOCK_SIGNS", 12_000)
    assert len(decontaminate.blocks_of(items, 10, "item_id", "text")) > 1 and shown() == want


def test_rows_of_one_key_are_dealt_to_many_files(spark):
    rows = [(None, f"text number {i} {'x' * (i % 7)}") for i in range(400)] + [(3, "a"), (3, "b"), (3, "b"), (4, None)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would go to one file
    try:
        _, index = token_files.token_files(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))
        held = sorted(index.collect(), key=lambda r: r["start"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({r["part"] for r in held if r["doc_id"] is None}) > 1
    assert [r["doc_id"] for r in held] == [None] * 400 + [3, 3, 3, 4]
    assert [r["start"] for r in held] == [sum(r["n_tokens"] for r in held[:i]) for i in range(len(held))]


def test_a_folder_of_token_files_stands_alone(spark, tmp_path):
    """The index is read from the folder's files; what a lost task left there counts for nothing."""
    rows = [(f"k{i:03d}", "some words " * (i % 9), i) for i in range(60)] + [(None, "no key", 1), ("k001", None, 2)]
    folder = f"file://{tmp_path}/t"
    index = token_files.write_tokens(spark.createDataFrame(rows, "name string, text string, part int").repartition(4), folder, length=8, key="name")
    want = sorted(tuple(r) for r in index.select(F.coalesce("name", F.lit("")), "start", "n_tokens").collect())
    for lost in ("part-000000-99999.arrow", "part-000000-99999.index.arrow"):
        (tmp_path / "t" / lost).write_bytes(b"half a file")
    again = token_files.read_index(spark, folder)
    assert again.schema == index.schema and again.schema["name"].dataType == T.StringType()
    assert sorted(tuple(r) for r in again.select(F.coalesce("name", F.lit("")), "start", "n_tokens").collect()) == want
    read = token_files.read_checks(again, key="name").collect()
    assert len(read) == len(rows) and sum(r["n_tokens"] for r in read) == max(r["start"] + r["n_tokens"] for r in read)
