"""Nearest neighbours against all inner products."""

import numpy as np
import pytest

from ledgermill.llm import nearest_neighbours as nn

ROWS = "vec_id long, embedding array<double>"


def plain_search(rows, every=20, nearest=20):
    """Exact result; rows are (id, vector)."""
    good = [
        (k, np.array(v, dtype=float))
        for k, v in rows
        if k is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    out = []
    for at, (query, vector) in enumerate(good):
        if query % every == 0:
            others = [(-float(vector @ v), k) for j, (k, v) in enumerate(good) if j != at and len(v) == len(vector)]
            out += [(query, rank, k, -s) for rank, (s, k) in enumerate(sorted(others)[:nearest], 1)]
    return out


def found_rows(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def same(got, want):
    assert [r[:3] for r in got] == [r[:3] for r in sorted(want)]
    assert np.allclose([r[3] for r in got], [r[3] for r in sorted(want)], rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("name", ["sf0.001", "sf0.1"])
def test_recall_on_the_given_tables(spark, name):
    table = spark.read.parquet(f"/root/testdata/{name}/embeddings.parquet")
    rows = table.toPandas()
    vectors = np.stack(rows["embedding"]).astype(float)
    got = nn.search(table, 20, 20).collect()
    by_query = {}
    for r in got:
        by_query.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    place = {k: j for j, k in enumerate(rows["vec_id"])}
    queries = [k for k in rows["vec_id"] if k % 20 == 0]
    assert sorted(by_query) == sorted(queries)
    hits = 0
    for q in queries:
        scores = vectors @ vectors[place[q]]
        scores[place[q]] = -np.inf
        best = sorted((-s, k) for s, k in zip(scores.tolist(), rows["vec_id"].tolist(), strict=True))[:20]
        ranks, ids, mine = zip(*sorted(by_query[q]), strict=True)
        assert ranks == tuple(range(1, 21)) and q not in ids
        assert list(zip([-s for s in mine], ids, strict=True)) == sorted(zip([-s for s in mine], ids, strict=True))
        assert np.allclose(mine, [scores[place[k]] for k in ids], rtol=1e-12)
        hits += len({k for _, k in best} & set(ids))
    assert hits >= 0.9 * 20 * len(queries)


def test_recall_of_vectors_of_all_lengths():
    rng = np.random.default_rng(1)
    vectors = (rng.standard_normal((3000, 24)) * np.exp(rng.standard_normal((3000, 1)))).astype(np.float32)
    queries = rng.standard_normal((200, 24)).astype(np.float32)
    layers = nn.build_graph(vectors)
    exact = queries.astype(float) @ vectors.astype(float).T
    hits = 0
    for lo, near, scores in nn.search_graph(vectors, layers, queries, nn.SEARCH_BEAM):
        for k in range(len(near)):
            top = near[k][np.argsort(-scores[k])[:20]]
            hits += len(set(top.tolist()) & set(np.argsort(-exact[lo + k])[:20].tolist()))
    assert hits >= 0.9 * 20 * len(queries)


def test_links_stay_inside_their_layer_and_bounds():
    vectors = np.random.default_rng(2).standard_normal((2000, 8)).astype(np.float32)
    layers = nn.build_graph(vectors)
    assert len(layers) > 1 and len(layers[-1]) == 2000
    for links in layers:
        assert links.max() < len(links) and links.min() >= -1
        assert links.shape[1] == (2 * nn.LINKS if links is layers[-1] else nn.LINKS)
        for node, row in enumerate(links):
            own = row[row >= 0].tolist()
            assert node not in own and len(set(own)) == len(own)


def test_a_third_of_all_rows_share_a_vector(spark):
    rng = np.random.default_rng(3)
    rows = [(k, rng.standard_normal(6).round(3).tolist()) for k in range(200)]
    rows += [(k, [1.0, 2.0, -1.0, 0.5, 0.0, 1.0]) for k in range(200, 320)]
    rng.shuffle(rows)
    rows = [(int(k), [float(x) for x in v]) for k, v in rows]
    df = spark.createDataFrame(rows, ROWS)
    same(found_rows(nn.search(df, 20, 7)), plain_search(rows, 20, 7))
    same(found_rows(nn.search(df, 20, 7, shard_root=2)), plain_search(rows, 20, 7))


def test_edge_rows(spark):
    rows = [(20, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [-1.0, 3.0]), (40, None), (60, []), (80, [0.0, 0.0])]
    rows += [(100, [1.0, None]), (120, [float("nan"), 1.0]), (3, [float("inf"), 1.0]), (None, [1.0, 1.0])]
    rows += [(140, [1.0, 2.0, 3.0]), (4, [0.5, 0.0, 0.0]), (1, [2.0, 0.0]), (-20, [0.0, 1.0]), (160, [1.0])]
    rows += [(20, [1.0, 0.0]), (20, [3.0, 1.0])]
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], ROWS + ", rank int, node string")
    same(found_rows(nn.search(df)), plain_search(rows))
    empty = nn.search(df.limit(0))
    assert empty.count() == 0
    assert dict(empty.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}
    assert nn.search(df.where("vec_id = 1")).count() == 0


def test_shards_grow_with_the_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(k, rng.standard_normal(4).tolist()) for k in range(600)]
    df = spark.createDataFrame(rows, ROWS)
    many = found_rows(nn.search(df, 20, 5, shard_root=2))  # 13 shards, a block of queries each
    same(many, plain_search(rows, 20, 5))
