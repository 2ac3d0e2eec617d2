"""Periodic runs against a search of every period."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from ledgermill.llm import periodic_runs
from ledgermill.llm.queries import op13_periodic_runs


def plain_runs(words, least=6, exponent=4):
    n, out = len(words), set()
    for q in range(1, n // exponent + 1):
        start = 0
        while start < n - q:
            if words[start] != words[start + q]:
                start += 1
                continue
            end = start
            while end < n - q and words[end] == words[end + q]:
                end += 1
            if start == 0 or words[start - 1] != words[start - 1 + q]:
                length = end - start + q
                stretch = words[start : end + q]
                smallest = all(any(stretch[k] != stretch[k + p] for k in range(length - p)) for p in range(1, q))
                if length >= max(least, exponent * q) and smallest:
                    out.add((start, length, q))
            start = end
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_repeat(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]


def plain_row(doc_id, text):
    words = plain_repeat(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    runs = plain_runs(words)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    dropped = {k for s, n, q in runs for k in range(s + q, s + n)}
    kept = " ".join(w for k, w in enumerate(words) if k not in dropped)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
    return (
        doc_id,
        len(runs),
        *best,
        1000 * best[1] // best[2] if runs else None,
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(kept.encode()).hexdigest(),
    )


def periodic_words(rng, alphabet):
    words = []
    while len(words) < rng.randint(0, 80):
        root = [rng.choice(alphabet) for _ in range(rng.randint(1, 6))]
        words += (root * 6)[: rng.randint(1, 6 * len(root))]
    return words


@pytest.mark.parametrize(("least", "exponent"), [(6, 4), (2, 2), (6, 5), (9, 4)])
def test_runs_equal_a_search_of_every_period(least, exponent):
    rng = random.Random(least * exponent)
    texts = [periodic_words(rng, "abc"[: rng.randint(1, 3)]) for _ in range(250)]
    texts += [[], ["a"], ["a"] * 6, ["a"] * 5, list("ab") * 4, list("ab") * 3]
    found = periodic_runs.runs_of_texts([[w.encode() for w in t] for t in texts], least, exponent)
    assert [[tuple(r) for r in runs.tolist()] for runs in found] == [plain_runs(t, least, exponent) for t in texts]


def test_common_prefixes_equal_a_plain_comparison():
    rng = np.random.default_rng(4)
    symbols = [*rng.integers(1, 3, 200).tolist(), 0]
    shared = periodic_runs.CommonPrefix(periodic_runs.SuffixTree(symbols, 3), np.arange(3))
    order = sorted(range(len(symbols)), key=lambda k: symbols[k:])
    assert np.argsort(shared.rank).tolist() == order
    a, b = np.triu_indices(len(symbols), 1)

    def plain(i, j):
        n = 0
        while symbols[i + n] == symbols[j + n]:
            n += 1
        return n

    assert shared(b, a).tolist() == [plain(i, j) for i, j in zip(a.tolist(), b.tolist(), strict=True)]


def test_a_long_text_of_few_words():
    words = ["w%d" % (k % 7) for k in range(60_000)] + ["x", "x", "y"] * 4 + ["z"]
    (found,) = periodic_runs.runs_of_texts([[w.encode() for w in words]])
    assert found.tolist() == [[0, 60_000, 7], [60_000, 12, 3]]


def test_edge_rows(spark):
    text = "x a b a b a b a b y"
    rows = [(1, text, "k"), (1, text, "k"), (None, text, "k"), (2, None, None), (3, "", None), (4, " \t\n", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = sorted(map(str, (tuple(r) for r in periodic_runs.find_runs(docs).collect())))
    run = "[Row(start=1, length=8, period=2)]"
    want = [f"({k}, {run}, 'x a b y')" for k in (1, 1, None)] + [f"({k}, [], '')" for k in (2, 3, 4)]
    assert got == sorted(want)
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.find_runs(docs, exponent=1)


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(5)
    rows = [(k, " ".join(periodic_words(rng, ["a", "É", "cc", "d"]))) for k in range(300)]
    rows += [(k, "".join(rng.choice("ab \t\n\x0b\x0c\r\x1c ") for _ in range(80))) for k in range(300, 340)]
    rows += [(1000 + k, None) for k in range(20)] + [(2000 + k, "") for k in range(20)] + [(None, "a " * 9), (-50, "b " * 30)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = op13_periodic_runs(spark, str(tmp_path))
    assert got.columns == "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    assert sorted(map(tuple, got.collect()), key=str) == sorted((plain_row(*r) for r in rows), key=str)


def test_given_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    short = {r.doc_id: r.text for r in docs if len(r.text or "") < 4000}
    got = {r.doc_id: tuple(r) for r in op13_periodic_runs(spark, folder).collect()}
    assert len(got) == len(docs)
    assert {k: got[k] for k in short} == {k: plain_row(k, text) for k, text in short.items()}
