"""The language model against plain loops: its likelihood, its gradients, its gain over the counts."""

import copy
import math
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgermill.llm import recurrent_lm as lm
from ledgermill.llm.queries import op5_lm_score


def small_model(vocabulary=30, texts=40, seed=3):
    rng = np.random.default_rng(seed)
    names = [f"w{k}".encode() for k in range(vocabulary + 20)]
    weights = 1.0 / np.arange(1, len(names) + 1)
    docs = [b" ".join(rng.choice(names, size=rng.integers(1, 60), p=weights / weights.sum())) for _ in range(texts)]
    counts = Counter(w for d in docs for w in lm.tokens(d))
    counts[lm.END.encode()] = len(docs)
    known = [lm.END.encode(), *(w for w, _ in counts.most_common(vocabulary) if w != lm.END.encode())]
    words = lm.Words(sum(counts.values()), len(counts), dict(counts), known)
    model = lm.Model(words)
    for name, value in model.params.items():
        model.params[name] = value + rng.standard_normal(value.shape).astype(np.float32) * 0.3
    return words, model, docs


def plain_log10(words, model, text):
    """One document, one token after the other, every probability written out."""
    p = {k: v.astype(np.float64) for k, v in model.params.items()}
    h, lexicon = lm.HIDDEN, lm.Lexicon(words)
    lexicon.make_room()
    found = [lm.END.encode(), *lm.tokens(text), lm.END.encode()]
    rows = lexicon.rows(found)
    number, read, _ = lexicon.settle()
    state, total = np.zeros(h), 0.0
    for at in range(len(found) - 1):
        x = p["embed"][read[rows[at]]] @ p["project"] + p["project_bias"]
        ours = state @ p["recur"][0]
        gates = 1 / (1 + np.exp(-(x[: 2 * h] + ours[: 2 * h])))
        update, reset = gates[:h], gates[h:]
        candidate = np.tanh(x[2 * h :] + reset * ours[2 * h :])
        state = update * state + (1 - update) * candidate
        aim = number[rows[at + 1]]
        target = len(words.known) if aim < 0 else aim
        logits = state @ p["class"] + p["class_bias"]
        cls = model.owner[target]
        total += logits[cls] - math.log(np.exp(logits).sum())
        lo, hi = model.first[cls], model.first[cls + 1]
        inner = p["word"][lo:hi] @ state + p["word_bias"][lo:hi]
        if hi - lo > 1:
            total += inner[target - lo] - math.log(np.exp(inner).sum())
        if aim < 0:
            total += math.log((words.frequent.get(found[at + 1], 0) + 1) / words.rare_spread())
    return total / math.log(10)


def test_scores_equal_a_plain_loop():
    words, model, docs = small_model()
    docs = [*docs, b"", b" ".join(docs * 3)]  # one goes over many windows
    likelihood, stats = lm.score_batch(model, lm.Lexicon(words), docs)
    got = [v / math.log(10) + s[3] for v, s in zip(likelihood.tolist(), stats, strict=True)]
    assert np.allclose(got, [plain_log10(words, model, d) for d in docs], rtol=1e-4, atol=1e-3)


def test_probabilities_of_the_next_token_add_up_to_one():
    words, model, _ = small_model()
    states = np.random.default_rng(1).standard_normal((5, lm.HIDDEN)).astype(np.float32)
    every = len(words.known) + 1
    total = sum(np.exp(model.likelihood(states, np.full(5, k))) for k in range(every))
    assert np.allclose(total, 1, atol=1e-4)


@pytest.mark.parametrize("name", ["embed", "project", "project_bias", "recur", "class", "class_bias", "word", "word_bias"])
def test_gradients_of_a_window_with_carried_states(name):
    words, model, _ = small_model()
    rng = np.random.default_rng(7)
    steps, lanes = 6, 5
    inputs = rng.integers(0, len(words.known) + lm.SUFFIXES, (steps, lanes))
    targets = rng.integers(0, len(words.known) + 1, (steps, lanes))
    valid, fresh = rng.random((steps, lanes)) < 0.8, rng.random((steps, lanes)) < 0.2
    state = rng.standard_normal((1, lanes, lm.HIDDEN)).astype(np.float32)
    grads, _ = model.gradients(inputs, targets, valid, fresh, state)
    grad = grads[name]
    if isinstance(grad, tuple):
        full = np.zeros_like(model.params[name])
        np.add.at(full, grad[0], grad[1])
        grad = full

    def loss(params):
        other = copy.copy(model)
        other.params = params
        out, _ = other.states(inputs, state, fresh)
        return -float(other.likelihood(out[:, 0][valid], targets[valid]).astype(np.float64).mean())

    wide = {k: v.astype(np.float64) for k, v in model.params.items()}
    biggest = np.argsort(-np.abs(grad).ravel())[:6]
    for at in [np.unravel_index(k, grad.shape) for k in biggest]:
        shifted = []
        for step in (1e-2, -1e-2):
            params = {k: v.copy() for k, v in wide.items()}
            params[name][at] += step
            shifted.append(loss(params))
        assert math.isclose((shifted[0] - shifted[1]) / 2e-2, grad[at], rel_tol=0.03, abs_tol=2e-4)


def test_lanes_hold_every_document_once():
    lengths = np.array([5, 1, 90, 7, 7, 30, 2])
    lanes = lm.deal_lanes(lengths, np.arange(len(lengths)), 3, 10)
    assert sorted(k for lane in lanes for k in lane) == list(range(len(lengths)))
    loads = [lengths[lane].sum() for lane in lanes]
    assert len(lanes) == 3 and loads == sorted(loads, reverse=True)


def test_tokens_of_many_texts_at_once():
    texts = [b" A b\tc\x0b\x0c d \n", b"", b"  ", "\u00c9 x\u2003Y".encode(), b"x\x1cy\x00z", b"\xff\xfeA B", b"end"]
    found, sizes = lm.split_tokens(pa.array(texts, pa.binary()))
    assert found.to_pylist() == [w for text in texts for w in lm.tokens(text)]
    assert sizes.tolist() == [len(lm.tokens(text)) for text in texts]


def test_look_ups_in_pieces(monkeypatch):
    words, model, docs = small_model()
    docs = [*docs, b"", b"never seen here", b"never"]
    whole, stats = lm.score_batch(model, lm.Lexicon(words), docs)
    monkeypatch.setattr(lm, "PIECE_BYTES", 50)
    again, others = lm.score_batch(model, lm.Lexicon(words), docs)
    assert np.array_equal(whole, again)
    assert [(*s[:4], sorted(zip(s[4], s[5], strict=True))) for s in stats] == [
        (*s[:4], sorted(zip(s[4], s[5], strict=True))) for s in others
    ]
    assert sorted(zip(stats[-2][4], stats[-2][5], strict=True)) == [(b"here", 1), (b"never", 1), (b"seen", 1)]


def test_nothing_to_learn_from():
    words, model, _ = small_model()
    assert lm.train_on(model, words, [], 0.01, 2, 8) == 0


def test_one_long_text_does_not_stretch_the_lanes_of_all():
    words, model, docs = small_model()
    texts = [b" ".join([b"w1 w2 w3 w4"] * 25_000), *docs * 10]
    lexicon = lm.Lexicon(words)
    tracemalloc.start()
    lm.score_batch(model, lexicon, texts)
    lm.train_on(copy.deepcopy(model), words, texts, 0.01, 1, 512)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50_000_000


def test_held_out_gain_over_the_counts(spark):
    rows = [r for r in op5_lm_score(spark, "/root/testdata/sf0.01").collect() if r.held_out]
    tokens = sum(r.n_tokens for r in rows)
    assert sum(r.score for r in rows) / tokens > sum(r.base_score for r in rows) / tokens + 0.05
