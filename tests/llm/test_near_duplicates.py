"""The pipeline's near-duplicate stage against all pairs of texts."""

import corpus_pipeline
import numpy as np
import pytest

from tidemark.llm import simhash


def plain(text):
    words = (text or "").split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.mark.parametrize("cell_rows,cell_bytes", [(8192, 64 << 20), (8, 64 << 20), (8192, 4000)])
def test_stage_against_all_pairs(spark, monkeypatch, cell_rows, cell_bytes):
    monkeypatch.setattr(simhash, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(simhash, "CELL_BYTES", cell_bytes)
    rng, rows = np.random.default_rng(4), []
    for i in range(40):
        words = [f"w{x}" for x in rng.integers(0, 4000, 200)]
        for _ in range(5):
            changed = list(words)
            for at in rng.choice(200, int(rng.integers(0, 8)), replace=False):
                changed[at] = f"x{rng.integers(0, 4000)}"
            rows.append((len(rows), " ".join(changed)))
    sets = [plain(t) for _, t in rows]
    label, fp = list(range(len(rows))), [simhash.fingerprint(t) for _, t in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert sum((fp[a] ^ fp[b]).bit_count() > 4 for a, b in pairs) > 20  # four bits don't reach them
    for _ in rows:
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "")
    assert {r["doc_id"] for r in kept.collect()} == set(label)


def test_forest_of_unequal_sizes_is_empty():
    """Pairs near by their fingerprints of which none can have the similarity."""
    one = np.arange(1, 9, dtype=np.uint64)
    u, v = simhash.similar_forest(np.zeros(2, np.uint64), np.zeros(2, np.int64), [one, one[:3]], 0.8)
    assert not len(u) and not len(v)


def test_null_ids_and_repeated_rows(spark):
    """A null id loses no document of its own, and repeated rows stay once."""
    own = " ".join(f"o{i}" for i in range(30))
    copy = " ".join(f"c{i}" for i in range(30))
    rows = [(None, own), (None, copy), (7, copy), (7, copy), (9, "other words"), (9, "other words")]
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(((r["doc_id"] or 0), r["text"]) for r in kept.collect()) == [(0, own), (7, copy), (9, "other words")]
