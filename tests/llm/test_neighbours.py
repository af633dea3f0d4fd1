"""Nearest neighbours and the pipeline against brute force."""

from __future__ import annotations

import math
import sys
from pathlib import Path

import numpy as np

from termtide.llm import neighbours
from termtide.llm.neighbours import Search, codes_of, nearest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))


def brute(rows, k=20):
    usable = [
        (i, v)
        for i, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)
    ]
    out = []
    for q, a in usable:
        if q is None or q % 20:
            continue
        scored = []
        for c, b in usable:
            if c != q and len(a) == len(b):
                s = 0.0
                for x, y in zip(a, b):
                    s += x * y
                scored.append((-s, c is None, c or 0, c))
        for rank, (s, _, _, c) in enumerate(sorted(scored)[:k], 1):
            out.append((q, rank, c, -s))
    return sorted(out, key=lambda t: t[:2])


def found(df):
    return sorted((tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()), key=lambda t: t[:2])


def test_nearest_of_odd_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(16).astype(np.float32).tolist()) for i in range(300)]
    rows += [(300 + i, rows[i][1]) for i in range(40)]  # ties
    rows += [(400, None), (420, [0.0] * 16), (440, [float("nan")] * 16), (460, [None] * 16), (480, [1.0, 2.0])]
    rows += [(501, [3.0, 1.0]), (502, [float("inf")] * 16), (None, rng.standard_normal(16).tolist())]
    rows += [(520, (1e3 * rng.standard_normal(16)).astype(np.float32).tolist()), (540, [])]
    df = spark.createDataFrame(
        [(*r, "x") for r in rows], "vec_id long, embedding array<double>, pair string"
    )
    assert found(nearest(df.repartition(3))) == brute(rows)


def test_no_vectors(spark):
    assert nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_blocks_change_nothing(spark, monkeypatch):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    whole = found(nearest(table))
    monkeypatch.setattr(neighbours, "CANDIDATE_BLOCK", 64)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 8)
    assert found(nearest(table)) == whole


def seen(vectors, every=20, k=20):
    ids = np.arange(len(vectors))
    asks = ids % every == 0
    search = Search(ids[asks], vectors[asks], k)
    code, alignment, length = codes_of(vectors)
    for low in range(0, len(ids), 2048):
        step = slice(low, low + 2048)
        search.see(ids[step], vectors[step], code[step], alignment[step], length[step])
    products = vectors[asks] @ vectors.T
    products[np.arange(asks.sum()), ids[asks]] = -np.inf
    true = np.argsort(-products, axis=1)[:, :k]
    found = [len(set(a) & set(b)) for a, b in zip(search.found, true)]
    return search, sum(found) / true.size


def test_few_products_are_computed_on_clustered_vectors():
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((60, 128))
    vectors = centres[rng.integers(0, 60, 6000)] + 0.4 * rng.standard_normal((6000, 128))
    search, recall = seen(vectors)
    assert search.ranked < 0.1 * search.pairs
    assert recall > 0.999


def test_vectors_without_clusters_and_in_few_dimensions():
    rng = np.random.default_rng(9)
    for dim in (1, 3, 70, 256):
        search, recall = seen(rng.standard_normal((5000, dim)) * rng.uniform(0.5, 2, (5000, 1)))
        assert search.ranked < search.pairs
        assert recall > 0.999


def test_estimates_keep_to_their_bounds():
    rng = np.random.default_rng(10)
    vectors = rng.standard_normal((3000, 96))
    search, _ = seen(vectors)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    code, alignment, _ = codes_of(vectors)
    true = unit[::20] @ unit.T
    estimate, most = search.cosines(slice(0, 256), code, alignment)
    assert np.mean(true > most) < 0.002
    assert abs(np.mean(estimate - true)) < 0.002


def test_a_block_of_copies_is_streamed(spark):
    rows = [(20 * i, [1.0, 2.0, float(i % 3)]) for i in range(60)] + [(None, [5.0, 1.0, 1.0])] * 9000
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(nearest(df)) == brute(rows[:60] + rows[60:100])


def test_pipeline_stages(spark, odd):
    import corpus_pipeline

    docs = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == odd.columns
        assert docs.count() > 0
    name, last = corpus_pipeline.STAGES[-1]
    assert last(spark, docs, "").count() >= docs.count()


def test_pipeline_runs_on_tables(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    load = out.groupBy("sequence_id").sum("length").collect()
    assert out.count() > 0 and max(r[1] for r in load) <= 4096
