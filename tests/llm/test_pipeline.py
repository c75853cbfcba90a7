"""The pipeline's stages against plain Python over the same documents."""

import re
from collections import Counter

import zstandard

import __spark_entry__
import corpus_pipeline
from tidemark.llm import decontaminate, quality_rules, toxicity
from tidemark.llm.common import staged
from tidemark.llm.tokens import Encoder

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, out = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = staged(stage(spark, docs, SF), name)
        out.append((before, docs))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    rows = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}
    (a, b), (_, c), (_, d), (_, e), (_, pieces) = out
    given, good, civil, single, clean = rows(a), rows(b), rows(c), rows(d), rows(e)

    pack, bands = zstandard.ZstdCompressor(level=3), quality_rules.Bands()
    assert set(good) == {i for i, t in given.items() if quality_rules.measure(t, bands, pack)["kept"]}
    for i, t in given.items():  # the base rule, in plain words
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t or "") if x]
        wins = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
        times = Counter(wins)
        n = len({k for at, x in enumerate(wins) if times[x] > 1 for k in range(at, at + 8)})
        assert not (i in good and (len(w) < 20 or 100 * n > 30 * len(w)))

    model = toxicity.train(b, spark.read.parquet(f"{SF}/labels.parquet"))
    assert set(civil) == {i for i, t in good.items() if model.score([t])[0][0] < 0.3}

    plain = lambda t: t.translate({c: c + 32 for c in range(65, 91)}).split()
    shingles = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, t in civil.items() if (w := plain(t))}
    label = {i: i for i in civil}
    pairs = [(i, j) for i in shingles for j in shingles if j < i and len(shingles[i] & shingles[j]) >= 0.8 * len(shingles[i] | shingles[j])]
    for _ in civil:
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
    assert set(single) == set(label.values())

    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        windows.update(decontaminate.windows(decontaminate.normal_words(r["text"]), 10))
    hit = lambda t: any(f" {w} " in f" {' '.join(decontaminate.normal_words(t))} " for w in windows)
    assert set(clean) == {i for i, t in single.items() if not hit(t)}

    encoder, sizes = Encoder().tokenizer, {}
    for r in pieces.collect():
        sizes[r["doc_id"]] = sizes.get(r["doc_id"], 0) + r["length"]
    assert sizes == {i: len(encoder.encode(t, add_special_tokens=False).ids) + 1 for i, t in clean.items()}


def test_corner_cases_go_through(spark, docs, tmp_path):
    spark.createDataFrame([(1, "what is the answer")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(1, 0, 1), (4, 1, 0)], "doc_id long, toxic int, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {1}


def test_columns_may_have_any_name(spark, monkeypatch, tmp_path):
    """Columns of the names that stages use themselves come out as they went in, also with a
    benchmark in several blocks."""
    monkeypatch.setattr(decontaminate, "BLOCK_SIGNS", 60)
    names = ["_row", "ROW", "row", "row_", "first", "label", "digest", "hit", "window", "items", "key", "score"]
    say = lambda i: " ".join(f"w{i}x{k}" for k in range(30))
    docs = spark.createDataFrame([(i, say(i % 4), *[f"R{i}"] * (len(names) - 1)) for i in range(6)], "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names if n != "ROW"))
    spark.createDataFrame([(i, f"{say(9)} {i} {say(3)}" if i == 5 else f"{say(20 + i)}") for i in range(8)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    single = corpus_pipeline.near_duplicates(spark, docs, "")
    clean = corpus_pipeline.decontamination(spark, single, str(tmp_path))
    assert single.columns == docs.columns == clean.columns
    assert {(r["doc_id"], *r[2:]) for r in clean.collect()} == {(i, *[f"R{i}"] * (len(names) - 1)) for i in range(3)}


def test_registered():
    known = __spark_entry__.queries()
    assert "pipeline" in known and sum(n.startswith("op") and n[2].isdigit() for n in known) == 13
    assert set(__spark_entry__.oracle_sql()) <= set(known)


def test_nulls_in_every_column(spark, tmp_path):
    """Rows of nulls alone, beside a few others, go through every query."""
    one = "twenty words or so about nothing in particular that a quality rule would keep since they are all plain and unlike each other"
    tables = {
        "documents": ([(None,) * 5, (1, one, "en", "a", 9), (2, one + " again", None, None, None)], "doc_id long, text string, lang string, source string, n_chars long"),
        "labels": ([(None,) * 3, (1, 1, 0), (2, None, None)], "doc_id long, quality int, toxic int"),
        "benchmark": ([(None, None), (None, "plain and unlike"), (3, None), (4, "nothing in particular")], "item_id long, text string"),
        "pages": ([(None,) * 3, (1, "http://h/", "<article>x</article>")], "page_id long, url string, html string"),
        "conversations": ([(None,) * 4, (1, None, "user", None), (1, 0, None, "x")], "conv_id long, turn long, role string, text string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    spark.createDataFrame([(None, None), (1, [1.0, 0.0]), (50, [0.0, 2.0])], "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    of = {"op3_host_suffix_array": 2, "op7_reply_trees": 3, "op8_deficit_packing": None, "op12_collision_counting": 1, "op13_bag_classes": None}
    for name, query in __spark_entry__.queries().items():
        if name.startswith("op") and name[2].isdigit():
            n = len(query(spark, str(tmp_path)).collect())
            assert n == of.get(name, 3) or of.get(name, 3) is None, name
