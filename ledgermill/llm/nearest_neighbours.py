"""Nearest neighbours by inner product: a hierarchical navigable small-world graph for each shard.

1. Rows with equal vectors are one node, which keeps the smallest ids of its rows: as many as a result
   can name. Nodes are dealt to shards by a hash; shards grow with the root of their number, up to
   ``SHARD_BYTES``.
2. A task builds the graph of a shard: each node draws a level, is searched from the top layer down, and
   is linked in each of its layers to near nodes that lie in different directions. Lists that overflow
   are thinned out the same way. Nodes are inserted in batches that search side by side in numpy; they
   stand by descending level, so a layer is a prefix of the nodes and its links are one flat array.
3. Distinct query vectors are dealt to blocks; each block meets the graph of each shard in one cell. A
   cell scores what its search has found in double precision on the vectors as given.
4. The results of the shards are merged for each query.

The graph lives in a metric: vectors are divided by the largest length in the shard and get one more
component that makes their length 1, so the nearest in distance is the largest inner product.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from ledgermill.llm.common import ship_package
from ledgermill.session import written

LINKS = 16  # of a node in an upper layer; twice as many in the lowest
SLACK = 16  # links beyond that before a list is thinned out
BUILD_BEAM, SEARCH_BEAM, ENTRY_BEAM = 64, 128, 4
FIRST, BATCH = 32, 512
SEEN_CELLS = 1 << 26
SHARD_ROOT = 32  # a shard holds about so many times the root of all nodes
SHARD_BYTES = 1 << 28
SEED = 17
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def unit_points(vectors: np.ndarray) -> np.ndarray:
    """Vectors divided by the largest length, with one more component that makes their length 1."""
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max()  # so that squares stay finite
    wide /= np.sqrt((wide * wide).sum(axis=1).max())
    rest = np.sqrt(np.maximum(0.0, 1.0 - (wide * wide).sum(axis=1)))
    return np.concatenate([wide, rest[:, None]], axis=1).astype(np.float32)


def unit_targets(vectors: np.ndarray) -> np.ndarray:
    """Queries: each of length 1, the added component 0."""
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)
    wide /= np.sqrt((wide * wide).sum(axis=1, keepdims=True))
    return np.concatenate([wide, np.zeros((len(wide), 1))], axis=1).astype(np.float32)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    apart = a - b
    return np.einsum("ij,ij->i", apart, apart)


def _packed(distances: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Distance, node and an open mark in one number that sorts by distance."""
    bits = np.ascontiguousarray(distances, dtype=np.float32).view(np.uint32).astype(np.uint64)
    return bits << np.uint64(32) | nodes.astype(np.uint64) << np.uint64(1)


def beam_search(
    points: np.ndarray, links: np.ndarray, targets: np.ndarray, entries: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """For each target the ``width`` nearest nodes met, nearest first, -1 where there are fewer, and distances.

    All targets take a step together: the nearest open node of each beam is expanded; a beam without an
    open node is done. ``entries``: (targets, any), -1 for none, no node twice in a row.
    """
    n = len(links)
    beam = np.full((len(targets), max(width, entries.shape[1])), EMPTY)
    seen = np.zeros(len(targets) * n, dtype=bool)
    row, col = np.nonzero(entries >= 0)
    nodes = entries[row, col]
    seen[row * n + nodes] = True
    beam[row, col] = _packed(_squares(points[nodes], targets[row]), nodes)
    beam.sort(axis=1)
    beam = np.ascontiguousarray(beam[:, :width])
    active = np.arange(len(targets))
    while len(active):
        rows = beam[active]
        open_ = (rows & np.uint64(1)) == 0
        first = open_.argmax(axis=1)
        place = np.arange(len(active))
        more = open_[place, first]
        if not more.all():
            active, rows, first = active[more], rows[more], first[more]
            if not len(active):
                break
            place = np.arange(len(active))
        node = (rows[place, first] & np.uint64(0xFFFFFFFF)) >> np.uint64(1)
        rows[place, first] |= np.uint64(1)
        near = links[node.astype(np.int64)]
        at = near + (active * n)[:, None]
        row, col = np.nonzero((near >= 0) & ~seen[np.maximum(at, 0)])
        nodes = near[row, col]
        seen[at[row, col]] = True
        fresh = np.full(near.shape, EMPTY)
        fresh[row, col] = _packed(_squares(points[nodes], targets[active[row]]), nodes)
        both = np.concatenate([rows, fresh], axis=1)
        both.sort(axis=1)
        beam[active] = both[:, :width]
    found = ((beam & np.uint64(0xFFFFFFFF)) >> np.uint64(1)).astype(np.int64)
    found[beam == EMPTY] = -1
    distances = (beam >> np.uint64(32)).astype(np.uint32).view(np.float32).copy()
    distances[found < 0] = np.inf
    return found, distances


def spread_out(points: np.ndarray, base: np.ndarray, near: np.ndarray, distances: np.ndarray, most: int) -> np.ndarray:
    """Of the candidates of each base, nearest first, ``most`` that lie in different directions.

    A candidate nearer to one chosen before than to the base comes behind all others.
    """
    valid = near >= 0
    apart = points[np.maximum(near, 0)] - base[:, None, :]
    squares = np.einsum("bkd,bkd->bk", apart, apart)
    between = squares[:, :, None] + squares[:, None, :] - 2 * np.matmul(apart, apart.transpose(0, 2, 1))
    closest = np.full(near.shape, np.inf, dtype=np.float32)
    chosen = np.zeros(near.shape, dtype=bool)
    left = np.full(len(near), most)
    for k in range(near.shape[1]):
        good = valid[:, k] & (left > 0) & (closest[:, k] > distances[:, k])
        if good.any():
            chosen[good, k] = True
            left[good] -= 1
            closest[good] = np.minimum(closest[good], between[good, k])
    rank = np.where(chosen, 0, np.where(valid, 1, 2))
    turn = np.argsort(rank, axis=1, kind="stable")[:, :most]
    out = np.full((len(near), most), -1, dtype=np.int64)
    picked = np.take_along_axis(near, turn, axis=1)
    out[:, : picked.shape[1]] = picked
    return out


def _thin_out(points: np.ndarray, bases: np.ndarray, lists: np.ndarray, most: int) -> np.ndarray:
    """The lists of the bases, cut to ``most`` nodes each."""
    out = np.full((len(bases), most), -1, dtype=np.int64)
    for lo in range(0, len(bases), BATCH):
        base, near = points[bases[lo : lo + BATCH]], lists[lo : lo + BATCH]
        apart = points[np.maximum(near, 0)] - base[:, None, :]
        distances = np.where(near >= 0, np.einsum("bkd,bkd->bk", apart, apart), np.float32(np.inf))
        turn = np.argsort(distances, axis=1, kind="stable")
        near, distances = np.take_along_axis(near, turn, axis=1), np.take_along_axis(distances, turn, axis=1)
        out[lo : lo + BATCH] = spread_out(points, base, near, distances, most)
    return out


def _link_back(points: np.ndarray, links: np.ndarray, held: np.ndarray, nodes: np.ndarray, chosen: np.ndarray, most: int) -> None:
    """Adds each node to the lists of the nodes it chose; a list that overflows is thinned out."""
    width = links.shape[1]
    row, col = np.nonzero(chosen >= 0)
    ends, news = chosen[row, col], nodes[row]
    turn = np.lexsort((_squares(points[ends], points[news]), ends))
    ends, news = ends[turn], news[turn]
    first = np.flatnonzero(np.concatenate([[True], ends[1:] != ends[:-1]]))
    counts = np.diff(np.append(first, len(ends)))
    place = np.arange(len(ends)) - np.repeat(first, counts)
    inside = place < width  # of very many in one batch the nearest
    ends, news, place = ends[inside], news[inside], place[inside]
    who, counts = ends[place == 0], np.minimum(counts, width)
    full = held[who] + counts > width
    fits = ~np.repeat(full, counts)
    links[ends[fits], held[ends[fits]] + place[fits]] = news[fits]
    held[who[~full]] += counts[~full]
    if full.any():
        tight = who[full]
        lists = np.full((len(tight), 2 * width), -1, dtype=np.int64)
        lists[:, :width] = links[tight]
        at = np.repeat(np.arange(len(tight)), counts[full])
        lists[at, width + place[~fits]] = news[~fits]
        kept = _thin_out(points, tight, lists, most)
        links[tight] = -1
        links[tight, :most] = kept
        held[tight] = (kept >= 0).sum(axis=1)


def _descend(points: np.ndarray, layers: list[np.ndarray], targets: np.ndarray) -> np.ndarray:
    """Near nodes of the lowest of ``layers`` (top first), found from the top down; without layers node 0."""
    near = np.zeros((len(targets), 1), dtype=np.int64)
    for links in layers:
        near, _ = beam_search(points, links, targets, near, ENTRY_BEAM)
    return near


def _layer(points: np.ndarray, above: list[np.ndarray], size: int, most: int) -> np.ndarray:
    """Links of the first ``size`` nodes; the layers above are complete."""
    links = np.full((size, most + SLACK), -1, dtype=np.int64)
    held = np.zeros(size, dtype=np.int64)
    first = min(size, FIRST)
    near = np.tile(np.arange(first), (first, 1))
    near = near[~np.eye(first, dtype=bool)].reshape(first, first - 1)
    if first > 1:
        kept = _thin_out(points, np.arange(first), near, most)
        links[:first, :most] = kept
        held[:first] = (kept >= 0).sum(axis=1)
    at = first
    while at < size:
        most_cells = max(1, SEEN_CELLS // size)
        nodes = np.arange(at, min(size, at + min(BATCH, at, most_cells)))
        entries = _descend(points, above, points[nodes])
        entries = np.where(entries < at, entries, -1)
        entries[(entries < 0).all(axis=1), 0] = 0
        near, distances = beam_search(points, links, points[nodes], entries, BUILD_BEAM)
        chosen = spread_out(points, points[nodes], near, distances, most)
        links[nodes, :most] = chosen
        held[nodes] = (chosen >= 0).sum(axis=1)
        _link_back(points, links, held, nodes, chosen, most)
        at += len(nodes)
    over = np.flatnonzero(held > most)
    links[over, :most] = _thin_out(points, over, links[over], most)
    return links[:, :most].astype(np.int32)


def levels_of(n: int, seed: int = SEED) -> np.ndarray:
    """A level for each node, descending; one node in LINKS reaches the next one."""
    drawn = np.random.default_rng(seed).random(n)
    return np.sort((-np.log1p(-drawn) / np.log(LINKS)).astype(np.int64))[::-1]


def build_graph(vectors: np.ndarray) -> list[np.ndarray]:
    """Layers from the top down; layer rows are the links of the first nodes, -1 for none."""
    points, levels = unit_points(vectors), levels_of(len(vectors))
    layers: list[np.ndarray] = []
    for level in range(int(levels[0]), -1, -1):
        size = int((levels >= level).sum())
        layers.append(_layer(points, layers, size, LINKS if level else 2 * LINKS))
    return layers


def search_graph(vectors: np.ndarray, layers: list[np.ndarray], queries: np.ndarray, width: int):
    """Blocks of (first query, nodes, scores): what the search has met, with exact inner products."""
    points, targets, wide = unit_points(vectors), unit_targets(queries), queries.astype(np.float64)
    step = max(1, min(BATCH, SEEN_CELLS // len(vectors)))
    for lo in range(0, len(queries), step):
        mine = targets[lo : lo + step]
        near, _ = beam_search(points, layers[-1], mine, _descend(points, layers[:-1], mine), width)
        scores = np.empty(near.shape)
        for k in range(len(mine)):
            scores[k] = np.einsum("ij,j->i", vectors[np.maximum(near[k], 0)].astype(np.float64), wide[lo + k])
        yield lo, near, np.where(near >= 0, scores, -np.inf)


def _rows_of(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = pa.concat_arrays([chunk.flatten() for chunk in column.chunks])
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dim)


GRAPH = "dim int, shard int, layers array<int>, vectors binary, links binary, counts binary, ids binary, nodes binary"


def _graph(table: pa.Table) -> pa.Table:
    """The graph of one shard in flat arrays; nodes of the same level lie in a random order."""
    dim, shard = table.column("dim")[0].as_py(), table.column("shard")[0].as_py()
    ids = table.column("ids").combine_chunks()
    counts = ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = ids.flatten().to_numpy(zero_copy_only=False)
    firsts = np.cumsum(counts) - counts
    # By smallest id, so that the graph does not hang on the order in which rows arrive.
    turn = np.lexsort((table.column("node").to_numpy(), flat[firsts]))
    turn = turn[np.random.default_rng(SEED + shard).permutation(len(turn))]
    vectors = _rows_of(table.column("vector"), dim)[turn]
    layers = build_graph(vectors)
    counts = counts[turn]
    places = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(firsts[turn], counts)
    return pa.table(
        {
            "dim": pa.array([dim], pa.int32()),
            "shard": pa.array([shard], pa.int32()),
            "layers": pa.array([[len(links) for links in layers]], pa.list_(pa.int32())),
            "vectors": pa.array([vectors.tobytes()], pa.binary()),
            "links": pa.array([b"".join(links.tobytes() for links in layers)], pa.binary()),
            "counts": pa.array([counts.astype(np.int32).tobytes()], pa.binary()),
            "ids": pa.array([flat[places].astype(np.int64).tobytes()], pa.binary()),
            "nodes": pa.array([table.column("node").to_numpy()[turn].astype(np.int64).tobytes()], pa.binary()),
        }
    )


FOUND = "asked long, vec_id long, score double, node long"


def _searcher(kind: str, nearest: int, width: int):
    """Searches a block of queries in the graph of one shard; ``nearest`` + 1 ids for each query."""

    def run(graphs: pa.Table, queries: pa.Table) -> pa.Table:
        names = ["asked", "vec_id", "score", "node"]
        if not graphs.num_rows or not queries.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.int64())], names=names)
        graph = graphs.slice(0, 1).to_pylist()[0]
        vectors = np.frombuffer(graph["vectors"], dtype=kind).reshape(-1, graph["dim"])
        links, at, layers = np.frombuffer(graph["links"], dtype=np.int32), 0, []
        for size in graph["layers"]:
            each = LINKS if len(layers) < len(graph["layers"]) - 1 else 2 * LINKS
            layers.append(links[at : at + size * each].reshape(size, each))
            at += size * each
        counts = np.frombuffer(graph["counts"], dtype=np.int32).astype(np.int64)
        ids, nodes = np.frombuffer(graph["ids"], dtype=np.int64), np.frombuffer(graph["nodes"], dtype=np.int64)
        starts = np.cumsum(counts) - counts
        asked = queries.column("node").to_numpy()
        parts = []
        most = nearest + 1
        for lo, near, scores in search_graph(vectors, layers, _rows_of(queries.column("vector"), graph["dim"]), width):
            # A node has one id at least, so what lies behind the last of so many nodes cannot be named.
            least = -np.sort(-scores, axis=1)[:, min(most, near.shape[1]) - 1]
            row, col = np.nonzero((near >= 0) & (scores >= least[:, None]))
            node = near[row, col]
            times = counts[node]
            places = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(starts[node], times)
            row, score, node = np.repeat(row, times), np.repeat(scores[row, col], times), np.repeat(node, times)
            turn = np.lexsort((ids[places], -score, row))
            row, score, node, places = row[turn], score[turn], node[turn], places[turn]
            first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            rank = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
            top = rank < most
            parts.append((asked[lo + row[top]], ids[places[top]], score[top], nodes[node[top]]))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], names=names)

    return run


def _usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vector`` of the rows that take part."""
    element = rows.schema[vector_col].dataType.elementType
    kind = FloatType() if isinstance(element, FloatType) else DoubleType()
    rows = rows.select(
        rows[id_col].cast("long").alias("vec_id"), rows[vector_col].cast(ArrayType(kind)).alias("vector")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))


def _nodes(rows: DataFrame, every: int, nearest: int) -> DataFrame:
    """``node, vector, ids, dim, asked``: distinct vectors with the smallest ids; whether a query has them."""
    order = Window.partitionBy("vector").orderBy("vec_id")
    # Of a vector that very many rows share only the first ids leave the task that reads them.
    firsts = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= nearest + 1)
    nodes = firsts.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    asked = rows.where(F.col("vec_id") % every == 0).select("vector").distinct().withColumn("asked", F.lit(True))
    both = nodes.join(asked, "vector", "left").select(
        "vector", "ids", F.size("vector").alias("dim"), F.coalesce("asked", F.lit(False)).alias("asked")
    )
    return written(both.withColumn("node", F.monotonically_increasing_id()), "vector-nodes")


def search(
    rows: DataFrame,
    every: int = 20,
    nearest: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    beam: int = SEARCH_BEAM,
    shard_root: int = SHARD_ROOT,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``nearest`` rows found for each row whose id ``every`` divides.

    Every row but the query's own is a candidate; nearness is the inner product in double precision,
    ties go to the smaller id. Fewer candidates give fewer rows. Rows without an id and vectors that are
    null, empty or zero or hold null or non-finite components take no part; only vectors of equal length meet.
    Rows that repeat an id are rows of their own: a copy of the query's row is a candidate, and a
    query id that repeats gets a result for each of its rows. An empty table gives an empty result.
    """
    ship_package(rows.sparkSession)
    kind = "f4" if isinstance(rows.schema[vector_col].dataType.elementType, FloatType) else "f8"
    usable = _usable(rows, id_col, vector_col)
    nodes = _nodes(usable, every, nearest)
    bytes_each = F.col("dim") * (4 if kind == "f4" else 8)
    sizes = nodes.groupBy("dim").agg(F.count("*").alias("n"), F.count_if("asked").alias("queries"))
    shards = F.greatest(
        F.ceil(F.sqrt("n") / shard_root), F.ceil(F.col("n") * bytes_each / SHARD_BYTES), F.lit(1)
    ).cast("int")
    sizes = sizes.withColumn("shards", shards)
    blocks = F.ceil(F.col("queries") / F.ceil(F.col("n") / F.col("shards"))).cast("int")
    sizes = written(sizes.select("dim", "shards", F.greatest(blocks, F.lit(1)).alias("blocks")), "vector-sizes")
    total, cells = sizes.agg(F.sum("shards"), F.sum(F.col("shards") * F.col("blocks"))).first()
    placed = nodes.join(sizes, "dim")
    dealt = placed.select(
        "dim", F.pmod(F.xxhash64("node"), "shards").cast("int").alias("shard"), "node", "vector", "ids"
    )
    # Few rows of many bytes of work: adaptive execution must not join these partitions.
    dealt = dealt.repartition(3 * (total or 1), "dim", "shard")
    graphs = written(dealt.groupBy("dim", "shard").applyInArrow(_graph, GRAPH), "vector-graphs")
    cell = ["dim", "shard", "block"]
    spread = graphs.join(sizes.select("dim", "blocks"), "dim")
    spread = spread.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    queries = placed.where("asked").select(
        "dim",
        F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"),
        F.pmod(F.xxhash64("node", F.lit(1)), "blocks").cast("int").alias("block"),
        "node",
        "vector",
    )
    count = 3 * (cells or 1)
    left, right = (frame.repartition(count, *cell).groupBy(*cell) for frame in (spread, queries))
    found = left.cogroup(right).applyInArrow(_searcher(kind, nearest, beam), FOUND)
    found = written(found, "shard-results")
    order = Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id", "node")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest + 1)
    best = best.groupBy("asked").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score", "node"))).alias("best"))
    best = written(best, "merged-results")
    # Rows with the query's vector share one search; each leaves out its own row.
    known = nodes.where("asked").select("vector", "node").join(best, F.col("node") == F.col("asked"), "left")
    known = known.select("vector", "node", "best")
    mine = usable.where(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "query_id").join(known, "vector")
    own = F.expr("transform(best, b -> b.vec_id = query_id and b.node = node)")
    place = F.array_position(own, True).cast("int")
    others = F.filter("best", lambda b, k: k + 1 != place)
    rest = mine.select("query_id", F.posexplode(F.slice(others, 1, nearest)).alias("k", "b"))
    return rest.select(
        "query_id", (F.col("k") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), F.col("b.score").alias("score")
    )
