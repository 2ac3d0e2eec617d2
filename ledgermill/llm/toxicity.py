"""Toxicity by a bidirectional gated recurrent network with attention pooling.

Each word enters as a word vector and the mean of the vectors of its character trigrams; words the
network has not learned have the trigrams alone. The states of both directions over a window are
pooled by attention, and the pooled state gives the logit of the window. A document is scored
over all its windows, which overlap, and has the logit of its most toxic window. Training first
takes every window of a document for its label; later the gradient goes to the window with the
largest logit alone.

The network is fitted on ``SAMPLE`` labelled documents of each class at most, in hash order of
their ids, with ``SAMPLE_WINDOWS`` windows of each; it is small enough to be sent to every task.
Scores cover every document and every word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm import gru
from ledgermill.llm.common import id_and_text, ship_package, slices

WINDOW, STRIDE = 64, 48
SAMPLE = 1500
SAMPLE_WINDOWS = 8
LEAST_DOCS = 8  # documents of the sample in which a word must be to get a vector
VOCABULARY = 20_000
TRIGRAMS = 4096
WORD_SIZE, CHAR_SIZE, HIDDEN, ATTENTION = 8, 8, 8, 8
EPOCHS, LEAST_STEPS, RATE, BAGS, DROP_WORD = 6, 400, 0.01, 32, 0.2
LANES = 512
MEMORY_WORDS = 150_000
SEED = 5
WORD = re.compile(r"\w+")


def window_starts(n_words: int) -> list[int]:
    """Where the overlapping windows that cover all words begin; no words: one empty window."""
    last = max(0, n_words - WINDOW)
    return [*range(0, last, STRIDE), last]


def windows_of(words: list) -> list[list]:
    return [words[s : s + WINDOW] for s in window_starts(len(words))]


def trigram_means(words: list[str], table: np.ndarray) -> np.ndarray:
    """The mean vector of each word's character trigrams, its borders included."""
    data = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode(), dtype=np.uint8).astype(np.int64)
    starts = np.flatnonzero(data == 2)
    places = np.flatnonzero(np.arange(len(data) - 2) >= 0) if len(data) >= 3 else np.zeros(0, dtype=np.int64)
    owner = np.searchsorted(starts, places, side="right") - 1
    ends = np.append(starts[1:], len(data))
    inside = places + 3 <= ends[owner]
    places, owner = places[inside], owner[inside]
    code = (data[places] * 65599 + data[places + 1] * 257 + data[places + 2] * 31) * 40503 >> 8
    vectors = table[code % TRIGRAMS]
    first = np.searchsorted(owner, np.arange(len(words)))
    count = np.bincount(owner, minlength=len(words))
    return np.add.reduceat(vectors, first, axis=0) / count[:, None].astype(np.float32), (owner, code % TRIGRAMS, count)


class Network:
    """Parameters and the two ways through the network."""

    def __init__(self, vocabulary: list[str]):
        rng = np.random.default_rng(SEED)
        self.words = {word: k + 1 for k, word in enumerate(vocabulary)}  # row 0: a word not learned

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        size, both = WORD_SIZE + CHAR_SIZE, 2 * HIDDEN
        self.params = {
            "word": normal(len(vocabulary) + 1, WORD_SIZE, scale=0.1),
            "char": normal(TRIGRAMS, CHAR_SIZE, scale=0.2),
            "project": normal(size, 2 * 3 * HIDDEN, scale=size**-0.5),
            "project_bias": np.zeros(2 * 3 * HIDDEN, dtype=np.float32),
            "recur": normal(2, HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
            "attend": normal(both, ATTENTION, scale=both**-0.5),
            "attend_bias": np.zeros(ATTENTION, dtype=np.float32),
            "attend_out": normal(ATTENTION, scale=0.5),
            "out": normal(both, scale=0.3),
            "bias": np.zeros(1, dtype=np.float32),
        }
        self.params["word"][0] = 0
        self.shift = 0.0

    def table(self, words: list[str]) -> np.ndarray:
        """The projected input of each word, for both directions and three gates."""
        p = self.params
        rows = np.array([self.words.get(w, 0) for w in words], dtype=np.int64)
        vectors = np.concatenate([p["word"][rows], trigram_means(words, p["char"])[0]], axis=1)
        return vectors @ p["project"] + p["project_bias"]

    def inputs(self, table: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Inputs of both directions, (steps, 2, lanes, gates), from rows of a table."""
        out = np.empty((len(ids), 2, ids.shape[1], 3 * HIDDEN), dtype=np.float32)
        np.take(table[:, : 3 * HIDDEN], ids, axis=0, out=out[:, 0], mode="clip")
        np.take(table[:, 3 * HIDDEN :], ids[::-1], axis=0, out=out[:, 1], mode="clip")
        return out

    def pool(self, inputs: np.ndarray, lengths: np.ndarray, tape: bool = False):
        """Logits of windows from their inputs; windows are padded at their ends."""
        p, (steps, _, lanes, _) = self.params, inputs.shape
        valid = np.arange(steps)[:, None] < lengths
        # The way back starts in the padding; its state stays zero until the last word.
        keep = None
        if not valid.all():
            before = np.concatenate([np.zeros((1, lanes), dtype=bool), valid[::-1][:-1]])
            keep = np.stack([np.ones_like(valid), before], axis=1).astype(np.float32)
        state = np.zeros((2, lanes, HIDDEN), dtype=np.float32)
        states, kept = gru.forward(inputs, p["recur"], state, keep, tape)
        joined = np.concatenate([states[:, 0], states[::-1, 1]], axis=-1)
        inner = np.tanh(joined @ p["attend"] + p["attend_bias"])
        weight = np.where(valid, inner @ p["attend_out"], -1e9)
        weight = np.exp(weight - weight.max(axis=0))
        weight = np.where(valid, weight / weight.sum(axis=0), 0).astype(np.float32)
        pooled = np.einsum("tb,tbh->bh", weight, joined)
        logits = pooled @ p["out"] + p["bias"][0]
        return (logits, (keep, kept, joined, inner, weight, pooled)) if tape else logits

    def gradients(self, d_logits: np.ndarray, saved: tuple) -> tuple[dict, np.ndarray]:
        """Gradients of the parameters above the inputs, and of the projected inputs."""
        p = self.params
        keep, kept, joined, inner, weight, pooled = saved
        d_pooled = d_logits[:, None] * p["out"]
        along = np.einsum("tbh,bh->tb", joined, d_pooled)
        d_score = weight * (along - (weight * along).sum(axis=0))
        d_inner = d_score[..., None] * p["attend_out"] * (1 - inner * inner)
        d_joined = weight[..., None] * d_pooled + d_inner @ p["attend"].T
        d_states = np.stack([d_joined[..., :HIDDEN], d_joined[::-1, :, HIDDEN:]], axis=1)
        d_inputs, d_recur = gru.backward(d_states, p["recur"], kept, keep)
        grads = {
            "out": pooled.T @ d_logits,
            "bias": d_logits.sum(keepdims=True),
            "attend_out": np.einsum("tb,tba->a", d_score, inner),
            "attend": np.einsum("tbh,tba->ha", joined, d_inner),
            "attend_bias": d_inner.sum(axis=(0, 1)),
            "recur": d_recur,
        }
        return grads, d_inputs


def _padded(windows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(w) for w in windows])
    ids = np.zeros((max(1, lengths.max()), len(windows)), dtype=np.int64)
    for k, window in enumerate(windows):
        ids[: len(window), k] = window
    return ids, lengths


def train(bags: list[list[list[str]]], labels: np.ndarray, odds: float) -> Network:
    """A network from the windows of labelled documents.

    ``odds``: those of label 1 among all training labels; the sample is balanced, so the logit is
    shifted to them in the end.
    """
    rng = np.random.default_rng(SEED)
    counts: dict[str, int] = {}
    for bag in bags:
        for word in {w for window in bag for w in window}:
            counts[word] = counts.get(word, 0) + 1
    known = sorted((w for w, n in counts.items() if n >= LEAST_DOCS), key=lambda w: (-counts[w], w))[:VOCABULARY]
    network = Network(known)
    place = {word: k for k, word in enumerate(counts)}
    every = list(counts)
    p = network.params
    rows = np.array([network.words.get(w, 0) for w in every], dtype=np.int64)
    if every:
        _, (owner, grams, gram_counts) = trigram_means(every, p["char"])
        bounds = np.searchsorted(owner, np.arange(len(every) + 1))
    numbered = [[[place[w] for w in window] for window in bag] for bag in bags]
    learner = gru.Adam(p, RATE)
    # A small sample is read more often, so that the network takes enough steps.
    epochs = max(EPOCHS, -(-LEAST_STEPS // max(1, -(-len(bags) // BAGS)))) if every else 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for first in range(0, len(order), BAGS):
            chosen = order[first : first + BAGS]
            windows = [w for k in chosen for w in numbered[k]]
            owner_bag = np.repeat(np.arange(len(chosen)), [len(numbered[k]) for k in chosen])
            ids, lengths = _padded(windows)
            used, back = np.unique(ids, return_inverse=True)
            back = back.reshape(ids.shape)
            spans = np.concatenate([np.arange(bounds[u], bounds[u + 1]) for u in used])
            inner = np.repeat(np.arange(len(used)), bounds[used + 1] - bounds[used])
            starts = np.cumsum(gram_counts[used]) - gram_counts[used]
            means = np.add.reduceat(p["char"][grams[spans]], starts, axis=0) / gram_counts[used][:, None]
            means = means.astype(np.float32)
            # Some known words come as unknown ones, so that the trigrams learn them too.
            word_rows = np.where(rng.random(len(used)) < DROP_WORD, 0, rows[used])
            vectors = np.concatenate([p["word"][word_rows], means], axis=1)
            projected = (vectors @ p["project"] + p["project_bias"]).astype(np.float32)
            logits, saved = network.pool(network.inputs(projected, back), lengths, tape=True)
            d_logits = (gru.sigmoid(logits) - labels[chosen][owner_bag]) / len(logits)
            if 2 * epoch >= epochs:
                # From here on the most toxic window of a bag speaks for it.
                top = np.full(len(chosen), -1)
                top[owner_bag[np.argsort(logits, kind="stable")]] = np.argsort(logits, kind="stable")
                rest = np.ones(len(logits), dtype=bool)
                rest[top] = False
                d_logits *= len(logits) / len(chosen)
                d_logits[rest] = 0
            d_logits = d_logits.astype(np.float32)
            grads, d_inputs = network.gradients(d_logits, saved)
            live = np.arange(len(ids))[:, None] < lengths
            flat = np.zeros((len(used), 6 * HIDDEN), dtype=np.float32)
            for side, (places, alive) in enumerate(((back, live), (back[::-1], live[::-1]))):
                words, sums = gru.row_sums(places[alive], d_inputs[:, side][alive])
                flat[words, 3 * HIDDEN * side : 3 * HIDDEN * (side + 1)] = sums
            d_vectors = flat @ p["project"].T
            grads["project"], grads["project_bias"] = vectors.T @ flat, flat.sum(axis=0)
            grads["word"] = (word_rows[word_rows > 0], d_vectors[word_rows > 0, :WORD_SIZE])
            grads["char"] = (grams[spans], (d_vectors[:, WORD_SIZE:] / gram_counts[used][:, None])[inner])
            learner.step(grads)
    share = labels.mean() if len(labels) else 0.5
    if 0 < share < 1 and odds > 0:
        network.shift = float(np.log(odds) - np.log(share / (1 - share)))
    return network


class Scorer:
    """Scores texts with a network; remembers the inputs of a bounded number of words."""

    def __init__(self, network: Network):
        self.network = network
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {}
        self.table = np.zeros((0, 6 * HIDDEN), dtype=np.float32)

    def scores(self, texts: list[str]) -> np.ndarray:
        words = [WORD.findall(text.lower()) for text in texts]
        if len(self.place) > MEMORY_WORDS:
            self._clear()
        fresh = list(set().union(*words).difference(self.place)) if words else []
        if fresh:
            self.place.update(zip(fresh, range(len(self.place), len(self.place) + len(fresh)), strict=True))
            self.table = np.concatenate([self.table, self.network.table(fresh).astype(np.float32)])
        number = self.place.__getitem__
        flat = np.fromiter(map(number, chain.from_iterable(words)), dtype=np.int64, count=sum(map(len, words)))
        starts = [window_starts(len(ws)) for ws in words]
        owner = np.repeat(np.arange(len(texts)), [len(s) for s in starts])
        counts = np.array([len(ws) for ws in words], dtype=np.int64)
        starts = np.concatenate([np.array(s, dtype=np.int64) for s in starts]) if texts else np.zeros(0, dtype=np.int64)
        lengths = np.minimum(WINDOW, counts[owner] - starts)
        starts = starts + (np.cumsum(counts) - counts)[owner]
        top = np.full(len(texts), -np.inf)
        order = np.argsort(lengths, kind="stable")
        for first in range(0, len(order), LANES):
            chosen = order[first : first + LANES]
            steps = np.arange(max(1, lengths[chosen[-1]]))[:, None]
            if len(flat):
                ids = flat[np.minimum(starts[chosen] + steps, len(flat) - 1)]
                inputs = self.network.inputs(self.table, ids)
            else:
                inputs = np.zeros((len(steps), 2, len(chosen), 3 * HIDDEN), dtype=np.float32)
            np.maximum.at(top, owner[chosen], self.network.pool(inputs, lengths[chosen]))
        return gru.sigmoid(top + self.network.shift)


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of an id as text, by ``modulus``; that of a null id is null."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus))


def sample_windows(docs: DataFrame, labels: DataFrame) -> tuple[pd.DataFrame, float]:
    """The windows of the training sample, and the odds of label 1 among all training labels."""
    usable = labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("toxic").cast("int").alias("toxic"))
    usable = usable.where(F.col("toxic").isin(0, 1) & (remainder(F.col("label_id"), 5) != 0))
    usable = usable.groupBy("label_id").agg(F.max("toxic").alias("toxic"))
    counts = {row["toxic"]: row["count"] for row in usable.groupBy("toxic").count().collect()}
    # Two lists of SAMPLE ids at most.
    picked = [
        usable.where(F.col("toxic") == k).orderBy(F.xxhash64("label_id"), "label_id").limit(SAMPLE) for k in (0, 1)
    ]
    sample = picked[0].unionByName(picked[1])
    rows = id_and_text(docs).join(F.broadcast(sample), F.col("doc_id") == F.col("label_id"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = windows_of(WORD.findall(text.lower()))
                if len(found) > SAMPLE_WINDOWS:
                    rng = np.random.default_rng(abs(doc_id))
                    found = [found[k] for k in sorted(rng.choice(len(found), SAMPLE_WINDOWS, replace=False))]
                bags.append([" ".join(window) for window in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(bags, pa.list_(pa.string()))],
                names=["doc_id", "toxic", "bag"],
            )

    bags = rows.select("doc_id", "text", "toxic").mapInArrow(cut, "doc_id long, toxic int, bag array<string>")
    # A repeated id would otherwise exceed the bound of the sample.
    bags = bags.dropDuplicates(["doc_id"])
    return bags.toPandas(), counts.get(1, 0) / max(1, counts.get(0, 0))


def fit(docs: DataFrame, labels: DataFrame) -> Network:
    """A network learned from labelled documents outside the held-out fifth."""
    ship_package(docs.sparkSession)
    found, odds = sample_windows(docs, labels)
    found = found.sort_values("doc_id")
    bags = [[window.split() for window in bag] for bag in found["bag"]]
    return train(bags, found["toxic"].to_numpy(dtype=np.float32), odds)


def score(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; a null or empty text has one empty window.

    Repeated rows are scored each; a null id stays null and is not held out.
    """
    rows = id_and_text(docs, id_col, text_col)
    held = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    rows = rows.select("doc_id", held.alias("held_out"), "text")
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in batches:
            for part in slices(batch, "text"):
                found = scorer.scores(part.column(2).to_pylist()).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, network: Network, text_col: str = "text") -> DataFrame:
    """All rows and columns of the documents that are not predicted toxic."""
    ship_package(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(network)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in batches:
            for part in slices(batch, batch.schema.names[place]):
                found = scorer.scores([text or "" for text in part.column(place).to_pylist()])
                yield part.filter(pa.array(found < 0.5))

    return docs.mapInArrow(run, docs.schema)
