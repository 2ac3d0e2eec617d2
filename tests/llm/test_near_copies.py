"""Removal of near copies against a comparison of all pairs."""

import random

import numpy as np
import pytest

from ledgermill.llm import near_copies, simhash

DOCS = "doc_id long, text string, fp string, block int"


def test_one_of_each_group_of_near_copies_stays(spark):
    rng = random.Random(9)
    base = [" ".join(f"v{rng.randrange(2000)}" for _ in range(200)) for _ in range(12)]
    rows = [(10 * k, t, "x", 1) for k, t in enumerate(base)]
    for k in range(6):
        words = base[k].split()
        words[50] = "edited"
        rows += [(10 * k + 1, " ".join(words), None, None), (10 * k + 2, base[k], None, 2)]
    rows += [(900, "", None, None), (901, None, None, None), (None, base[0], None, None), rows[3]]
    df = spark.createDataFrame(rows, DOCS)
    out = near_copies.without_near_copies(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == [*(10 * k for k in range(12)), 900]
    assert near_copies.without_near_copies(df.limit(0)).count() == 0


def kept_of(texts, similarity=0.8):
    """Plain search: the first text of each group linked by Jaccard similarity of five-word shingles."""
    words = [t.lower().split() for t in texts]
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for w in words]
    group = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if group[a] != group[b] and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]) - 1e-6:
                low, high = sorted((group[a], group[b]))
                group = [low if g == high else g for g in group]
    return sorted(set(group))


def stay(spark, texts):
    df = spark.createDataFrame([(k, t, None, None) for k, t in enumerate(texts)], DOCS)
    return sorted(r.doc_id for r in near_copies.without_near_copies(df).collect())


def test_equal_fingerprints_are_not_enough(spark):
    rng = random.Random(12)
    line = "one line of nine words that is often repeated "
    texts = [" ".join(f"u{rng.randrange(10**6)}" for _ in range(60)) + " " + line * 60 for _ in range(20)]
    assert len({simhash.text_fingerprint(t.encode(), 5) for t in texts}) == 1
    assert kept_of(texts) == stay(spark, texts) == list(range(20))


def test_fingerprints_link_copies_first(spark, monkeypatch):
    """SimHash classes are candidates of the stage; those that are not similar are not taken."""
    rng = random.Random(31)
    line = "one line of nine words that is often repeated "
    texts = [" ".join(f"u{rng.randrange(10**6)}" for _ in range(60)) + " " + line * 60 for _ in range(3)]
    for _ in range(4):
        base = [f"v{rng.randrange(3000)}" for _ in range(400)]
        texts += [" ".join(base), " ".join([*base[:-1], "edited"])]
    linked = []

    def spied(prints, distance=simhash.DISTANCE, found=simhash.near_duplicates):
        classes = found(prints, distance)
        linked.extend(classes.where("doc_id != component_id").collect())
        return classes

    monkeypatch.setattr(simhash, "near_duplicates", spied)
    assert stay(spark, texts) == kept_of(texts) == [0, 1, 2, 3, 5, 7, 9]
    assert len(linked) >= 4  # the three of one fingerprint, and pairs that differ in one word


@pytest.mark.parametrize(("n_words", "share", "times"), [(60, 0.02, 8), (250, 0.02, 8), (250, 0.02, 2), (60, 0.015, 1)])
def test_every_pair_of_near_copies_is_found(spark, monkeypatch, n_words, share, times):
    rng = random.Random(n_words)
    texts = []
    for _ in range(6):
        base = [f"v{rng.randrange(3000)}" for _ in range(n_words)]
        texts.append(" ".join(base))
        texts += [" ".join(w if rng.random() > share else f"x{rng.randrange(10**6)}" for w in base) for _ in range(25)]
    monkeypatch.setattr(near_copies, "HOT_TIMES", times)
    assert stay(spark, texts) == kept_of(texts)


def test_a_link_between_members_that_the_ends_of_a_bucket_do_not_hold(spark):
    rng = random.Random(3)
    base = [f"v{k}" for k in range(200)]
    left = base[:]
    for k in range(10, 190, 30):
        left[k] = f"l{k}"
    texts = [" ".join(base[:160] + [f"a{k}" for k in range(40)])]
    for k in range(30):
        words = left[:]
        words[rng.randrange(200)] = f"r{k}"
        texts.append(" ".join(words))
    assert stay(spark, texts) == kept_of(texts)


def test_many_texts_under_one_shingle(spark, monkeypatch):
    """A bucket of several blocks, with similar texts in different blocks and a line that all share."""
    monkeypatch.setattr(near_copies, "BLOCK", 16)
    monkeypatch.setattr(near_copies, "HOT_TIMES", 10**9)
    rng = random.Random(21)
    line = [f"c{k}" for k in range(12)]
    texts = []
    for k in range(150):
        base = line + [f"t{rng.randrange(10**6)}" for _ in range(rng.randint(8, 60))]
        texts.append(" ".join(base))
        if k % 3 == 0:
            texts.append(" ".join(base[:-1]))
    rng.shuffle(texts)
    assert stay(spark, texts) == kept_of(texts)


def test_sketches_never_claim_too_much():
    rng = np.random.default_rng(4)
    for size in (1, 3, 100, 700, 40_000):
        a = np.unique(rng.integers(-(2**63), 2**63 - 1, size))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.7], rng.integers(-(2**63), 2**63 - 1, size // 3 + 1)]))
        apart = len(np.setxor1d(a, b))
        assert near_copies.least_apart(near_copies.sketch(a), near_copies.sketch(b)) <= apart
        assert near_copies.least_apart(near_copies.sketch(a), near_copies.sketch(a)) == 0


def test_a_row_that_repeats_very_often_and_a_very_long_text(spark):
    rng = random.Random(2)
    long = " ".join(f"w{rng.randrange(5000)}" for _ in range(300_000))
    rows = [(5, "a b c d e f g", None, None)] * 500 + [(7, long, None, None), (8, long + " end", None, None)]
    df = spark.createDataFrame(rows, DOCS)
    assert sorted(r.doc_id for r in near_copies.without_near_copies(df).collect()) == [5, 7]
