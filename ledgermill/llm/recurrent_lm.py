"""Log-likelihood of whole documents under a gated recurrent language model.

Counts: every training document adds its tokens to the unigram counts; their total, the number of
distinct tokens and the ``VOCABULARY`` most frequent tokens follow from them.

Model: a gated recurrent layer reads the tokens; the output is factored into classes, P(class | state)
times P(word | class, state). Tokens outside the vocabulary are one word of a class of their own,
times their share (c + 1) / (n + v + 1) among those tokens, where unseen tokens are one kind. Biases
start at the unigram distribution, so training can only improve on it.

Training: truncated backpropagation over windows of ``STEPS`` tokens, the state carried from window to
window. A first model is learned from
about ``FIRST_DOCS`` training documents; then every task goes on from it over all windows of all its
training documents and the parameters of all tasks are averaged, weighted by their tokens. The work grows with the corpus.

Scoring: documents lie in lanes one after the other; the state is carried from window to window
and starts at zero with each document, so a document is scored whole, however long.
"""

from __future__ import annotations

import copy
import heapq
import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm import gru
from ledgermill.llm.common import id_and_text, slices
from ledgermill.session import written

END = "\n"  # the end token; no word holds white space
VOCABULARY = 4095
CLASSES = 64
LOCAL_WORDS = 150_000  # counts that every task holds; all others are joined
LOCAL_BYTES = 48
SUFFIXES = 128
SIZE, HIDDEN = 16, 16
STEPS, FIRST_LANES, LANES = 32, 64, 512  # few lanes: many steps for few tokens; many lanes: little work a token
SCORE_STEPS = 64
FIRST_DOCS, FIRST_PASSES = 1500, 2
RATE, LATER_RATE = 0.01, 0.008
SLICE_CHARS = 24_000_000
PIECE_BYTES = 2_000_000
CHUNK = 4096
BLOCK = 2048
SCORE_TOKENS = 32_768  # scored at once, of as many windows as it takes
SEED = 11


def tokens(text: bytes) -> list[bytes]:
    """Words of UTF-8 text, A-Z as a-z, cut at ASCII white space; the end token is not among them."""
    return text.lower().split()


def split_tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The ``tokens`` of all binary texts one after the other, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.binary()).view(pa.string())))
    found = lists.flatten().view(pa.binary())
    filled = pc.greater(pc.binary_length(found), 0)  # white space at either end of a text cuts off an empty piece
    before = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])
    return found.filter(filled), np.diff(before[lists.offsets.to_numpy()])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return id_and_text(docs, id_col, text_col).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("binary").alias("text")
    )


def _training(batch: pa.RecordBatch) -> pa.Array:
    """The texts of a batch that are not held out."""
    return batch.column(2).filter(pc.invert(batch.column(1)))


def count_tokens(rows: DataFrame) -> DataFrame:
    """``word, n`` over all training documents; each task sums up before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches, SLICE_CHARS):
            texts = _training(batch)
            words, times = split_tokens(texts)[0].value_counts().flatten()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([words, pa.array([END.encode()], pa.binary())]),
                    pa.concat_arrays([times, pa.array([len(texts)], pa.int64())]),
                ],
                names=["word", "n"],
            )

    summed = rows.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return written(summed.where("n > 0"), "token-counts")


@dataclass
class Words:
    """What tasks need of the counts: totals, and the counts of frequent tokens."""

    total: int
    distinct: int
    frequent: dict[bytes, int]
    known: list[bytes]  # the vocabulary; the end token comes first

    def __post_init__(self):
        inside = sum(self.frequent[w] for w in self.known)
        seen = sum(self.frequent[w] > 0 for w in self.known)
        self.rare_total, self.rare_distinct = self.total - inside, self.distinct - seen

    def spread(self) -> float:
        """What a base count is divided by."""
        return float(self.total + self.distinct + 1)

    def rare_spread(self) -> float:
        return float(self.rare_total + self.rare_distinct + 1)


def frequent_words(counts: DataFrame) -> Words:
    """Totals, and the most frequent tokens: LOCAL_WORDS of LOCAL_BYTES each at most.

    The least count of the list comes from a table of a few thousand steps of counts.
    """
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    end = F.col("word") == F.lit(END.encode())
    short = counts.where((F.octet_length("word") <= LOCAL_BYTES) & ~end)
    step = F.floor(F.log("n") * 32).cast("int")
    steps = short.groupBy(step.alias("step")).agg(F.count("*").alias("words")).orderBy(F.desc("step")).collect()
    held, least = 0, None
    for row in steps:
        held += row["words"]
        if held > LOCAL_WORDS:
            break
        least = row["step"]
    top = short.where(step >= least).collect() if least is not None else []
    top = sorted(((-row["n"], bytes(row["word"])) for row in top))
    ends = counts.where(end).first()
    frequent = {END.encode(): ends["n"] if ends else 0}
    frequent.update((word, -n) for n, word in top)
    return Words(total, distinct, frequent, [END.encode(), *(word for _, word in top[: VOCABULARY - 1])])


class Lexicon:
    """Looks tokens up: vocabulary number (-1: rare), what the network reads after one, local count.

    A rare token is read by the last bytes of its spelling. Count -1: not in the list of frequent
    tokens. Tokens are remembered up to the next call of ``make_room``.
    """

    def __init__(self, words: Words):
        self.words = words
        self.frequent = pa.array(list(words.frequent), pa.binary())
        # the last entry stands for all other tokens
        self.count = np.array([*words.frequent.values(), -1], dtype=np.int64)
        self.number = np.full(len(self.count), -1, dtype=np.int64)
        self.number[pc.index_in(pa.array(words.known, pa.binary()), value_set=self.frequent)] = np.arange(len(words.known))
        self.make_room()

    def make_room(self) -> None:
        self.parts, self.held = [pa.array([], pa.binary())], 0

    def rows(self, found: pa.Array | list[bytes]) -> np.ndarray:
        """Rows of the table; they hold until the next call of ``make_room``."""
        found = found if isinstance(found, pa.Array) else pa.array(found, pa.binary())
        coded = found.dictionary_encode()
        rows = coded.indices.to_numpy() + np.int32(self.held)
        self.parts.append(coded.dictionary)
        self.held += len(coded.dictionary)
        return rows

    def spelled(self) -> pa.Array:
        """The token of each row of the table."""
        return pa.concat_arrays(self.parts)

    def settle(self) -> np.ndarray:
        """The table with all tokens looked up since ``make_room``."""
        spelled, size = self.spelled(), len(self.words.known)
        place = pc.fill_null(pc.index_in(spelled, value_set=self.frequent), -1).to_numpy()
        table = np.empty((3, len(spelled)), dtype=np.int64)
        table[0], table[2] = self.number[place], self.count[place]
        bounds = np.frombuffer(spelled.buffers()[1], dtype=np.int32)[: len(spelled) + 1]
        letters = np.frombuffer(spelled.buffers()[2], dtype=np.uint8)
        last = letters[bounds[1:] - 1].astype(np.int64)
        before = letters[np.maximum(bounds[1:] - 2, bounds[:-1])].astype(np.int64)
        table[1] = np.where(table[0] >= 0, table[0], size + (last * 31 + before * 7) % SUFFIXES)
        return table

    def sequence(self, texts: pa.Array | list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the tokens of all texts, each closed by the end token, and how many each text has.

        The network reads each of them after the one before; the first comes after an end token.
        """
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.binary())
        self.make_room()
        end = self.rows([END.encode()])[0]
        rows, lengths = [np.zeros(0, dtype=np.int32)], [np.zeros(0, dtype=np.int64)]
        # pieces of about PIECE_BYTES keep what is held of their tokens small
        piece = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64)) // PIECE_BYTES
        bounds = np.flatnonzero(np.diff(piece, prepend=-1, append=-2)).tolist()
        for lo, hi in itertools.pairwise(bounds):
            found, sizes = split_tokens(texts[lo:hi])
            rows.append(np.insert(self.rows(found), np.cumsum(sizes), end))
            lengths.append(sizes + 1)
        return np.concatenate(rows), np.concatenate(lengths)


def _normalise(logits: np.ndarray, rows: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log P of one place in each row, and the sums by which to divide the odds that then stand in ``logits``."""
    logits -= np.maximum.reduce(logits, axis=1, keepdims=True)
    found = logits[rows, places]
    np.exp(logits, out=logits)
    sums = np.add.reduce(logits, axis=1)
    return found - np.log(sums), sums


class Model:
    """Parameters of the network; words are ordered by class, rare tokens last."""

    def __init__(self, words: Words):
        rng = np.random.default_rng(SEED)
        counts = np.array([words.frequent[w] for w in words.known] + [words.rare_total], dtype=np.float64) + 1
        share = counts / counts.sum()
        # Classes hold about equal shares and a bounded number of words; the rare one stands alone.
        most = -(-len(words.known) * 2 // CLASSES)
        owner, used, size = np.zeros(len(share), dtype=np.int64), 0.0, 0
        for k in range(len(words.known)):
            if size and (used + share[k] > 1.0 / CLASSES or size >= most):
                owner[k:] += 1
                used, size = 0.0, 0
            used, size = used + share[k], size + 1
        owner[-1] = owner[-2] + 1
        self.owner = owner
        self.first = np.searchsorted(owner, np.arange(owner[-1] + 2))
        classes = len(self.first) - 1
        mass = np.add.reduceat(share, self.first[:-1])

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.params = {
            "embed": normal(len(words.known) + SUFFIXES, SIZE, scale=0.3),
            "project": normal(SIZE, 3 * HIDDEN, scale=SIZE**-0.5),
            "project_bias": np.zeros(3 * HIDDEN, dtype=np.float32),
            "recur": normal(1, HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
            "class": np.zeros((HIDDEN, classes), dtype=np.float32),
            "class_bias": np.log(mass).astype(np.float32),
            "word": np.zeros((len(share), HIDDEN), dtype=np.float32),
            "word_bias": np.log(share / mass[owner]).astype(np.float32),
        }

    def states(self, inputs: np.ndarray, state: np.ndarray, fresh: np.ndarray, tape: bool = False):
        p = self.params
        vectors = p["embed"][inputs]
        projected = (vectors @ p["project"] + p["project_bias"])[:, None]
        keep = None if not fresh.any() else (~fresh[:, None]).astype(np.float32)
        out, kept = gru.forward(projected, p["recur"], state, keep, tape)
        return out, (vectors, keep, kept)

    def likelihood(self, states: np.ndarray, targets: np.ndarray, learn: bool = False):
        """log P of each target after its state; with ``learn`` also the gradients."""
        p = self.params
        classes = self.owner[targets]
        rows = np.arange(len(targets))
        kind = np.result_type(states, p["class"])
        odds = np.empty((len(targets) if learn else BLOCK, len(self.first) - 1), dtype=kind)
        out = np.empty(len(targets), dtype=kind)
        for lo in range(0, len(targets), BLOCK):  # blocks stay in the cache
            part = slice(lo, min(lo + BLOCK, len(targets)))
            logits = np.matmul(states[part], p["class"], out=odds[part] if learn else odds[: part.stop - lo])
            logits += p["class_bias"]
            place = rows[: len(logits)], classes[part]
            out[part], sums = _normalise(logits, *place)
            if learn:
                logits /= sums[:, None]
                logits[place] -= 1
                logits /= len(targets)
        grads = {}
        if learn:
            d_states = odds @ p["class"].T
            grads = {"class": states.T @ odds, "class_bias": odds.sum(axis=0)}
            d_word, d_bias = np.zeros_like(p["word"]), np.zeros_like(p["word_bias"])
        # narrow numbers are sorted by counting
        order = np.argsort(classes.astype(np.min_scalar_type(len(self.first))), kind="stable")
        bounds = np.searchsorted(classes[order], np.arange(len(self.first))).tolist()
        first, words, biases = self.first.tolist(), p["word"], p["word_bias"]
        states, places, sorted_out = states[order], (targets - self.first[classes])[order], out[order]
        d_sorted = d_states[order] if learn else None
        for k in range(len(first) - 1):
            lo, hi = first[k], first[k + 1]
            mine = slice(bounds[k], bounds[k + 1])
            if hi - lo < 2 or mine.start == mine.stop:
                continue
            given, word = states[mine], words[lo:hi]
            inner = given @ word.T
            inner += biases[lo:hi]
            place = rows[: len(inner)], places[mine]
            found, sums = _normalise(inner, *place)
            sorted_out[mine] += found
            if learn:
                inner /= sums[:, None]
                inner[place] -= 1
                inner /= len(targets)
                d_sorted[mine] += inner @ word
                d_word[lo:hi] = inner.T @ given
                d_bias[lo:hi] = np.add.reduce(inner, axis=0)
        out[order] = sorted_out
        if learn:
            d_states[order] = d_sorted
            grads |= {"word": d_word, "word_bias": d_bias}
            return out, grads, d_states
        return out

    def learn(
        self,
        inputs: np.ndarray,
        targets: np.ndarray,
        valid: np.ndarray,
        fresh: np.ndarray,
        state: np.ndarray,
        learner: gru.Adam,
        share: float = 1.0,
    ) -> np.ndarray:
        """One step over a window (steps, lanes) that goes on from ``state``; returns the state after it.

        Gradients end at the first token of the window, or where a document begins. ``share``: how full the
        window is; an emptier one moves the parameters less.
        """
        grads, out = self.gradients(inputs, targets, valid, fresh, state)
        learner.step(grads, share)
        return out[-1]

    def gradients(self, inputs: np.ndarray, targets: np.ndarray, valid: np.ndarray, fresh: np.ndarray, state: np.ndarray):
        """Gradients of the mean negative log likelihood of a window, and its states."""
        p = self.params
        out, (vectors, keep, kept) = self.states(inputs, state, fresh, tape=True)
        _, grads, d_states = self.likelihood(out[:, 0][valid], targets[valid], learn=True)
        d_out = np.zeros_like(out)
        d_out[:, 0][valid] = d_states
        d_inputs, grads["recur"] = gru.backward(d_out, p["recur"], kept, keep)
        d_inputs = d_inputs[:, 0].reshape(-1, 3 * HIDDEN)
        flat = vectors.reshape(-1, SIZE)
        grads["project"], grads["project_bias"] = flat.T @ d_inputs, d_inputs.sum(axis=0)
        rows = inputs.reshape(-1).astype(np.min_scalar_type(len(p["embed"])))  # narrow numbers are sorted by counting
        grads["embed"] = (rows, d_inputs @ p["project"].T)
        return grads, out


def train_on(
    model: Model, words: Words, texts: pa.Array | list[bytes], rate: float, passes: int, most_lanes: int
) -> int:
    """Truncated backpropagation over all tokens of the texts; returns the tokens seen.

    Documents lie in lanes one after the other, in an order drawn for each pass. A state starts at zero with
    each document and is carried from window to window, as in scoring.
    """
    rng = np.random.default_rng(SEED)
    size, lexicon = len(words.known), Lexicon(words)
    rows, lengths = lexicon.sequence(texts)
    number, read_of, _ = lexicon.settle()
    aims = np.where(number < 0, size, number).astype(np.int32)[rows]
    reads = read_of.astype(np.int32)[np.concatenate([rows[-1:], rows[:-1]])]
    begins = np.zeros(len(rows), dtype=bool)
    begins[np.cumsum(lengths) - lengths] = True
    learner = gru.Adam(model.params, rate)
    for _ in range(passes):
        lanes = deal_lanes(lengths, rng.permutation(len(lengths)), most_lanes, 4 * STEPS)
        state = np.zeros((1, len(lanes), HIDDEN), dtype=np.float32)
        for at, valid in windows(lanes, lengths, STEPS):
            share = valid.sum() / (STEPS * len(lanes))
            read, aim = np.where(valid, reads[at], 0), np.where(valid, aims[at], 0)
            state = model.learn(read, aim, valid, begins[at] & valid, state[:, : valid.shape[1]], learner, share)
    return int(lengths.sum())


def first_model(rows: DataFrame, words: Words) -> Model:
    """A model learned from about FIRST_DOCS training documents, chosen by a hash of their ids."""
    model = Model(words)
    training = rows.where(~F.col("held_out"))
    ids = training.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIRST_DOCS)
    ids = ids.distinct().withColumnRenamed("doc_id", "first_id")
    # Of a long text the windows that training reads are spread over it; others are not sent.
    texts = training.join(F.broadcast(ids), F.col("doc_id").eqNullSafe(F.col("first_id"))).select("doc_id", "text")
    texts = texts.dropDuplicates(["doc_id"]).mapInArrow(_excerpts, "doc_id long, text binary")
    found = sorted(((r["doc_id"], bytes(r["text"])) for r in texts.collect()), key=lambda r: (r[0] is None, r[0] or 0))
    train_on(model, words, [text for _, text in found], RATE, FIRST_PASSES, FIRST_LANES)
    return model


EXCERPT_WORDS = 512


def _excerpts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first model reads EXCERPT_WORDS words of a document in a row, at a place its id gives."""
    for batch in batches:
        out = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = text.split()
            room = max(0, len(words) - EXCERPT_WORDS)
            start = abs(doc_id or 0) * 7919 % (room + 1)
            out.append(b" ".join(words[start : start + EXCERPT_WORDS]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["doc_id", "text"])


def average(rows: DataFrame, words: Words, start: Model) -> Model:
    """Every task trains on its documents from ``start``; the parameters are averaged by tokens."""
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast((words, start))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, model = sent.value
        model = copy.deepcopy(model)
        seen = 0
        for batch in batches:
            for part in slices(batch, "text", SLICE_CHARS):
                texts = _training(part)
                if len(texts):
                    seen += train_on(model, known, texts, LATER_RATE, 1, LANES)
        if seen:
            flat = np.concatenate([v.ravel() for v in model.params.values()]).astype(np.float64) * seen
            parts = [flat[k : k + CHUNK].tobytes() for k in range(0, len(flat), CHUNK)]
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(len(parts)), pa.int32()),
                    pa.array([task % 64] * len(parts), pa.int32()),
                    pa.array([seen] * len(parts), pa.int64()),
                    pa.array(parts, pa.binary()),
                ],
                names=["chunk", "share", "seen", "sums"],
            )

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        sums = np.sum([np.frombuffer(b) for b in pdf["sums"]], axis=0)
        return pdf.head(1).assign(seen=pdf["seen"].sum(), sums=[sums.tobytes()])

    kind = "chunk int, share int, seen long, sums binary"
    trained = written(rows.select("doc_id", "held_out", "text").mapInArrow(run, kind), "task-models")
    partial = trained.groupBy("chunk", "share").applyInPandas(add, kind)
    found = partial.groupBy("chunk").applyInPandas(add, kind).orderBy("chunk").collect()  # one model
    if not found:
        return start
    flat = np.concatenate([np.frombuffer(row["sums"]) / row["seen"] for row in found]).astype(np.float32)
    at = 0
    for name, value in start.params.items():
        start.params[name] = flat[at : at + value.size].reshape(value.shape)
        at += value.size
    return start


def deal_lanes(lengths: np.ndarray, order: np.ndarray, most: int, least_steps: int) -> list[list[int]]:
    """Documents in lanes of about equal length, longest lane first; each goes to the shortest lane so far."""
    n_lanes = max(1, min(len(lengths), most, int(lengths.sum()) // least_steps))
    loads, lanes = [(0, lane) for lane in range(n_lanes)], [[] for _ in range(n_lanes)]
    for k in order.tolist():
        load, lane = loads[0]
        lanes[lane].append(k)
        heapq.heapreplace(loads, (load + int(lengths[k]), lane))
    return [lanes[lane] for _, lane in sorted(loads, key=lambda x: (-x[0], x[1]))]


def windows(lanes: list[list[int]], lengths: np.ndarray, steps: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each window the places of its tokens among those of all documents, (steps, lanes), and which there are.

    Lanes that have ended drop out. Only one window is spread out at a time: lanes may differ much in length.
    """
    starts = np.cumsum(lengths) - lengths
    spans = (np.arange(starts[k], starts[k] + lengths[k], dtype=np.int32) for lane in lanes for k in lane)
    places = np.concatenate([np.zeros(0, dtype=np.int32), *spans])
    left = np.array([lengths[lane].sum() for lane in lanes])
    first = np.cumsum(left) - left
    for lo in range(0, int(left[0]), steps):
        live = int((left > lo).sum())
        step = np.arange(lo, min(lo + steps, left[0]))[:, None]
        valid = step < left[:live]
        yield places[np.where(valid, first[:live] + step, 0)], valid


def lanes_of(lengths: np.ndarray) -> list[list[int]]:
    """The lanes of scoring: long documents first, so that lanes end together."""
    return deal_lanes(lengths, np.argsort(-lengths, kind="stable"), 512, 1024)


def score_batch(model: Model, lexicon: Lexicon, texts: pa.Array | list[bytes]):
    """For each text: natural log likelihood; tokens, known tokens, base score and rare shares as
    far as their counts are at hand; and its tokens whose counts are elsewhere."""
    words = lexicon.words
    rows, lengths = lexicon.sequence(texts)
    number, read_of, count_of = lexicon.settle()
    starts = np.cumsum(lengths) - lengths
    local = count_of >= 0
    own = np.log10(np.where(local, count_of + 1, words.spread()) / words.spread())
    share = np.log10(np.where(local & (number < 0), count_of + 1, words.rare_spread()) / words.rare_spread())
    known = (count_of > 0).astype(np.int32)
    sums = [np.add.reduceat(of[rows], starts, dtype=of.dtype).tolist() for of in (known, own, share)]
    # tokens with counts elsewhere, by text
    away = np.flatnonzero(~local[rows])
    texts_of = np.searchsorted(starts, away, side="right") - 1
    pairs, times = np.unique(texts_of * len(number) + rows[away], return_counts=True)
    spelled = lexicon.spelled().take(pa.array(pairs % len(number))).to_pylist()
    bounds = np.searchsorted(pairs // len(number), np.arange(len(lengths) + 1)).tolist()
    times = times.tolist()
    cut = [(spelled[lo:hi], times[lo:hi]) for lo, hi in itertools.pairwise(bounds)]
    stats = [(n, *of, *rest) for n, of, rest in zip(lengths.tolist(), zip(*sums, strict=True), cut, strict=True)]
    aims = np.where(number < 0, len(words.known), number).astype(np.int32)[rows]
    reads = read_of.astype(np.int32)[np.concatenate([rows[-1:], rows[:-1]])]
    likelihood = np.zeros(len(lengths))
    lanes = lanes_of(lengths)
    begins = np.zeros(len(rows), dtype=bool)
    begins[starts] = True
    owner = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    state = np.zeros((1, len(lanes), HIDDEN), dtype=np.float32)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    waiting, scored = 0, 0
    for at, valid in windows(lanes, lengths, SCORE_STEPS):
        read = np.where(valid, reads[at], 0)
        out, _ = model.states(read, state[:, : valid.shape[1]], begins[at] & valid)
        state = out[-1]
        held.append((out[:, 0][valid], at[valid]))
        waiting += len(held[-1][1])
        if waiting >= SCORE_TOKENS or scored + waiting == len(rows):
            states, places = (np.concatenate(x) for x in zip(*held, strict=True))
            likelihood += np.bincount(owner[places], weights=model.likelihood(states, aims[places]), minlength=len(lengths))
            held, waiting, scored = [], 0, scored + waiting
    return likelihood, stats


SCORED = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, "
    "away array<struct<word:binary,n:long>>"
)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    A null or empty text is the end token alone. Repeated rows count each; a null id is not held
    out. An empty table gives an empty result.
    """
    rows = _rows(docs, id_col, text_col)
    counts = count_tokens(rows)
    words = frequent_words(counts)
    model = average(rows, words, first_model(rows, words))
    sent = docs.sparkSession.sparkContext.broadcast((words, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, net = sent.value
        lexicon = Lexicon(known)
        row = TaskContext.get().partitionId() << 40
        for batch in _gathered(batches, SLICE_CHARS):
            found, stats = score_batch(net, lexicon, batch.column(2))
            words = pa.array(itertools.chain.from_iterable(s[4] for s in stats), pa.binary())
            times = pa.array(itertools.chain.from_iterable(s[5] for s in stats), pa.int64())
            bounds = pa.array(np.cumsum([0, *(len(s[5]) for s in stats)]), pa.int32())
            away = pa.StructArray.from_arrays([words, times], fields=[pa.field("word", pa.binary()), pa.field("n", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + len(stats))),
                    batch.column(0),
                    batch.column(1),
                    pa.array([s[0] for s in stats], pa.int64()),
                    pa.array([s[1] for s in stats], pa.int64()),
                    pa.array([s[2] for s in stats], pa.float64()),
                    pa.array([v / math.log(10) + s[3] for v, s in zip(found.tolist(), stats, strict=True)], pa.float64()),
                    pa.ListArray.from_arrays(bounds, away),
                ],
                names=[field.split()[0] for field in SCORED.split(", ")],
            )
            row += len(stats)

    scored = written(rows.mapInArrow(run, SCORED), "scored-documents")
    away = scored.select("row", F.explode("away").alias("token")).select("row", "token.word", "token.n")
    held = counts.select(F.col("word").alias("held_word"), F.col("n").alias("count"))
    met = away.join(held, F.col("word") == F.col("held_word"), "left").withColumn("count", F.coalesce("count", F.lit(0)))
    own = F.log10((F.col("count") + 1) / F.lit(words.spread()))
    share = F.log10((F.col("count") + 1) / F.lit(words.rare_spread()))
    rest = met.groupBy("row").agg(
        F.sum(F.when(F.col("count") > 0, F.col("n")).otherwise(0)).alias("more_known"),
        F.sum(F.col("n") * own).alias("more_base"),
        F.sum(F.col("n") * share).alias("more_score"),
    )
    both = scored.drop("away").join(rest.withColumnRenamed("row", "rest_row"), F.col("row") == F.col("rest_row"), "left")
    plus = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).alias(a)
    return both.select(
        "doc_id",
        "held_out",
        "n_tokens",
        plus("n_known", "more_known"),
        F.lit(int(words.total)).cast("long").alias("train_tokens"),
        plus("base_score", "more_base"),
        plus("score", "more_score"),
    )


def _gathered(batches: Iterator[pa.RecordBatch], chars: int) -> Iterator[pa.RecordBatch]:
    """Batches joined up to about ``chars`` bytes of text, so that lanes are many and even."""
    held, size = [], 0
    for batch in batches:
        for part in slices(batch, "text", chars):
            held.append(part)
            size += part.nbytes
            if size >= chars:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
    if held and sum(part.num_rows for part in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
