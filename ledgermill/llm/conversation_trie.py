"""The prefix trie of conversations that are put together from two others, by composable fingerprints.

A conversation is rebuilt from the head of its base and its own later turns. A run of turns is a map
x -> x * base^n + sum modulo a prime; runs that follow each other compose. So the fingerprint of every
rebuilt prefix comes from products over the turns as they are stored: with P(i) the product over the first
i own turns, those behind the head are P(i) - P(h) * base^(i-h), and the base's head takes the place of P(h).
No rebuilt text is ever made. Three primes together give 93 bits.

Prefixes of equal depth and fingerprint are one node. Nodes whose prefixes end in different stored turns are
verified on the turns themselves; as the prefixes before are nodes too, whole prefixes are verified. If
one differs, all is done again with other bases.

Sums over subtrees need no walk through the trie. Each node belongs to its smallest member; the nodes of a
conversation are one chain that ends where it ends. The subtree of a node holds the whole chains of all its
members but one, of its smallest member the chain from the node on.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.scans import running
from ledgermill.session import written

PRIMES = (2147483647, 2147483629, 2147483587)  # the largest below 2^31: products fit into a long
GROUP, HEADS = 100, 6
ATTEMPTS = 8
CHUNK = 1 << 20
NOTHING = hashlib.sha256(b"").hexdigest()


def bases_of(attempt: int) -> list[tuple[int, int]]:
    """Base and prime of each fingerprint."""
    rng = random.Random(attempt)
    return [(rng.randrange(1 << 20, p - 1), p) for p in PRIMES]


def _cols(prefix: str, maps: list) -> list[str]:
    return [f"{prefix}{k}" for k in range(len(maps))]


def _stored_turns(turns: DataFrame, maps: list, attempt: int) -> DataFrame:
    """Turns in order with the products over the conversation so far."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *text)
    rows = rows.where(F.col("conv_id").isNotNull())
    hashed = [
        F.pmod(F.xxhash64(F.lit(attempt * 97 + k), "role", "text"), F.lit(p)).alias(f"t{k}") for k, (_, p) in enumerate(maps)
    ]
    rows = rows.select("*", F.char_length("text").cast("long").alias("chars"), *hashed)
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    return written(running(rows, "conv_id", order, _cols("t", maps), maps, "sorted-turns"), "stored-turns")


def _conversations(stored: DataFrame, maps: list) -> DataFrame:
    """One row for each conversation: its base's head, and what takes the place of its own."""
    head = F.struct("place", *_cols("product", maps), *_cols("t", maps), "chars")
    own_head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    convs = stored.groupBy("conv_id").agg(
        F.max("place").alias("turns"),
        F.sort_array(F.collect_list(F.when(F.col("place") < HEADS, head))).alias("heads"),
    )
    convs = written(convs.withColumn("h", own_head), "conversations")
    bases = convs.select(F.col("conv_id").alias("base_id"), F.col("heads").alias("base_heads"))
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    both = convs.join(bases, base == F.col("base_id"), "left")
    both = both.withColumn("k", F.least("h", F.coalesce(F.size("base_heads"), F.lit(0))))

    def product(heads: str, length: str, field: str) -> Column:
        return F.coalesce(F.get(heads, F.col(length).cast("int") - 1)[field], F.lit(0))

    swaps = [
        F.pmod(product("base_heads", "k", f"product{n}") - product("heads", "h", f"product{n}"), F.lit(p)).alias(f"swap{n}")
        for n, (_, p) in enumerate(maps)
    ]
    total = F.col("k") + F.greatest(F.lit(0), F.col("turns") - F.col("h"))
    return written(
        both.select(
            "conv_id", "base_id", "h", "k", total.cast("long").alias("total"),
            F.slice("base_heads", 1, F.col("k").cast("int")).alias("head"), *swaps,
        ),
        "rebuilt-conversations",
    )


def _prefixes(stored: DataFrame, convs: DataFrame, maps: list) -> DataFrame:
    """Every prefix of every rebuilt conversation, the empty one included: fingerprints of it and of the
    prefix before, its last turn as a reference to a stored one, whether the conversation ends there."""
    each = range(len(maps))
    inverse = [pow(b, -1, p) for b, p in maps]
    nothing = [F.lit(0).cast("long").alias(c) for c in ["chars", *_cols("f", maps), *_cols("t", maps)]]
    no_ref = [F.lit(None).cast("long").alias(c) for c in ("ref_conv", "ref_place")]
    roots = convs.select("conv_id", "total", F.lit(0).cast("long").alias("depth"), *no_ref, *nothing)
    heads = convs.where("k > 0").select("conv_id", "total", "base_id", F.explode("head").alias("turn"))
    heads = heads.select(
        "conv_id", "total", F.col("turn.place").alias("depth"), F.col("base_id").alias("ref_conv"),
        F.col("turn.place").alias("ref_place"), "turn.chars",
        *(F.col(f"turn.product{n}").alias(f"f{n}") for n in each), *(f"turn.t{n}" for n in each),
    )
    own = stored.where(F.col("place") > F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS)
    own = own.drop("turn", "role", "text").join(convs.select("conv_id", "total", "h", "k", *_cols("swap", maps)), "conv_id")
    prints = []
    for n, (_, p) in enumerate(maps):
        back = F.array(*(F.lit(pow(inverse[n], h, p)) for h in range(HEADS)))
        behind = F.col(f"power{n}") * F.get(back, F.col("h").cast("int")) % p
        prints.append(((F.col(f"swap{n}") * behind + F.col(f"product{n}")) % p).alias(f"f{n}"))
    own = own.select(
        "conv_id", "total", (F.col("k") + F.col("place") - F.col("h")).alias("depth"), F.col("conv_id").alias("ref_conv"),
        F.col("place").alias("ref_place"), "chars", *prints, *_cols("t", maps),
    )
    every = roots.unionByName(heads).unionByName(own)
    before = [
        (F.pmod(F.col(f"f{n}") - F.col(f"t{n}"), F.lit(p)) * inverse[n] % p).alias(f"p{n}") for n, (_, p) in enumerate(maps)
    ]
    ends = (F.col("depth") == F.col("total")).alias("ends")
    return written(
        every.select("conv_id", "depth", "chars", "ref_conv", "ref_place", ends, *_cols("f", maps), *before), "prefixes"
    )


def _verified(prefixes: DataFrame, nodes: DataFrame, stored: DataFrame, node: list[str]) -> bool:
    """Whether all prefixes of each node end in equal turns."""
    mixed = nodes.where("least_ref != most_ref").select(node)
    # Written as joined: a node that very many conversations share may be split there, which a following
    # aggregate by the same columns would not allow.
    asked = prefixes.select(*node, "ref_conv", "ref_place").join(mixed, node, "left_semi")
    asked = written(asked, "shared-prefixes").distinct()
    turns = stored.select(F.col("conv_id").alias("ref_conv"), F.col("place").alias("ref_place"), "role", "text")
    met = asked.join(turns, ["ref_conv", "ref_place"])
    turn = F.struct("role", "text")
    return met.groupBy(node).agg((F.min(turn) != F.max(turn)).alias("wrong")).where("wrong").isEmpty()


def _end_hashes(prefixes: DataFrame, node: list[str]) -> DataFrame:
    """The node's columns and ``ends_sha256`` of the conversations that end there.

    Ids are joined in sorted pieces, a node's in as many tasks as they need, then run through one hash.
    """
    names = [*node, "part", "piece", "ids"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, ids, size = TaskContext.get().partitionId(), 0, None, [], 0
        for batch in batches:
            out = []
            *keys, convs = (c.to_pylist() for c in batch.columns)
            for key, conv in zip(zip(*keys, strict=True), convs, strict=True):
                if ids and (key != held or size >= CHUNK):
                    out.append((*held, part, number, ",".join(ids)))
                    number, ids, size = number + 1, [], 0
                held = key
                ids.append(str(conv))
                size += len(ids[-1]) + 1
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=kind)
        if ids:
            yield pa.RecordBatch.from_pylist([dict(zip(names, (*held, part, number, ",".join(ids)), strict=True))], schema=kind)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state = None, None

        def closed() -> dict:
            return {**dict(zip(node, held, strict=True)), "ends_sha256": state.hexdigest()}

        for batch in batches:
            out = []
            *keys, texts = (batch.column(k).to_pylist() for k in [*range(len(node)), len(names) - 1])
            for key, text in zip(zip(*keys, strict=True), texts, strict=True):
                if key != held:
                    if state:
                        out.append(closed())
                    held, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.encode())
            yield pa.RecordBatch.from_pylist(out, schema=done)
        if state:
            yield pa.RecordBatch.from_pylist([closed()], schema=done)

    kind = pa.schema([(c, pa.int64()) for c in names[:-1]] + [("ids", pa.string())])
    done = pa.schema([(c, pa.int64()) for c in node] + [("ends_sha256", pa.string())])
    ends = prefixes.where("ends").select(*node, "conv_id")
    ends = ends.repartitionByRange(*node, "conv_id").sortWithinPartitions(*node, "conv_id")
    cut = written(ends.mapInArrow(pieces, ", ".join(f"{c} long" for c in names[:-1]) + ", ids string"), "end-pieces")
    cut = cut.repartition(*node).sortWithinPartitions(*node, "part", "piece")
    return cut.mapInArrow(hashes, ", ".join(f"{c} long" for c in node) + ", ends_sha256 string")


def _nodes(turns: DataFrame, attempt: int) -> DataFrame | None:
    """The result, or none if two different prefixes have one fingerprint."""
    maps = bases_of(attempt)
    node, parent = ["depth", *_cols("f", maps)], _cols("p", maps)
    stored = _stored_turns(turns, maps, attempt)
    convs = _conversations(stored, maps)
    prefixes = _prefixes(stored, convs, maps)
    ref = F.struct("ref_conv", "ref_place")
    nodes = prefixes.groupBy(node).agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.max("chars").alias("chars"),
        *(F.max(c).alias(c) for c in parent),
        F.min(ref).alias("least_ref"),
        F.max(ref).alias("most_ref"),
    )
    weight = F.when(F.col("depth") > 0, (F.col("n_convs") - 1) * F.col("chars")).otherwise(0)
    nodes = written(nodes.withColumn("weight", weight), "trie-nodes")
    if not _verified(prefixes, nodes, stored, node):
        return None

    of_parent = [F.col(p).alias(f) for p, f in zip(parent, node[1:], strict=True)]
    inner = nodes.where("depth > 0")
    children = inner.select((F.col("depth") - 1).alias("depth"), *of_parent).groupBy(node)
    children = written(children.agg(F.count("*").alias("n_children")), "child-counts")
    # A childless node is where its smallest member ends, so a conversation speaks for one leaf at most.
    leaves = nodes.join(children, node, "left_anti").select("conv_id", F.lit(1).alias("leaf"), F.lit(0).alias("chain"))
    shared = nodes.where("n_convs > 1")
    chains = shared.select("conv_id", F.lit(0).alias("leaf"), F.col("weight").alias("chain"))
    marks = leaves.unionByName(chains).groupBy(F.col("conv_id").alias("marked"))
    marks = written(marks.agg(F.sum("leaf").alias("leaf"), F.sum("chain").alias("chain")), "conversation-marks")
    sums = prefixes.join(marks, F.col("conv_id") == F.col("marked")).groupBy(node)
    sums = sums.agg(F.sum("leaf").alias("n_leaves"), F.sum("chain").alias("chains"))
    along = shared.select("conv_id", *node, "weight")
    along = running(along, "conv_id", [F.col("depth")], ["weight"], [(1, None)], "shared-chains")
    earlier = along.select(*node, (F.col("product0") - F.col("weight")).alias("earlier"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), *(F.col(f).alias(p) for f, p in zip(node[1:], parent, strict=True)),
                           F.col("conv_id").alias("parent_conv_id"))
    facts = [c for c in ("n_children", "n_leaves", "chains", "earlier", "ends_sha256")]
    parts = {"n_children": children, "n_leaves": sums, "earlier": earlier, "ends_sha256": _end_hashes(prefixes, node)}
    kinds = {c: "string" if c == "ends_sha256" else "long" for c in facts}
    together = None
    for part in parts.values():
        full = part.select(*node, *(F.col(c) if c in part.columns else F.lit(None).cast(kinds[c]).alias(c) for c in facts))
        together = full if together is None else together.unionByName(full)
    together = together.groupBy(node).agg(*(F.max(c).alias(c) for c in facts))
    both = nodes.join(together, node, "left").join(parents, ["depth", *parent], "left")
    saved = F.when(F.col("n_convs") > 1, F.col("chains") - F.col("earlier")).otherwise(0)
    return both.select(
        "conv_id",
        "depth",
        F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        "n_leaves",
        saved.cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
    )


def prefix_nodes(turns: DataFrame) -> DataFrame:
    """A row for each distinct prefix of the rebuilt conversations.

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``. Turns are taken by ``turn``, null first,
    equal ones by role and text; a null role or text is empty. Rows without a ``conv_id`` take no part;
    repeated rows are turns of their own. The base of a negative id is the next multiple of 100 towards
    zero. An empty table has no node, not even the root. Other columns are not read.
    """
    for attempt in range(ATTEMPTS):
        found = _nodes(turns, attempt)
        if found is not None:
            return found
    raise RuntimeError("fingerprints of different prefixes were equal with all bases")
