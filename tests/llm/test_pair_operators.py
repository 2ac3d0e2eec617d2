"""Operators that relate documents to each other, against brute force."""

import base64
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from ledgermill.llm import components, minhash, repeated_spans, simhash, warc

DOCS = "doc_id long, text string, fp string, block int"


def random_texts(seed, n, words=40, vocabulary=300):
    rng = random.Random(seed)
    return [" ".join(f"w{rng.randrange(vocabulary)}" for _ in range(rng.randint(1, words))) for _ in range(n)]


# --- components -------------------------------------------------------------------------


def test_components_equal_a_plain_search(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)] + [(k, k + 1) for k in range(200, 240)]
    edges += [(500, 500), (None, 7), (7, None)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components.connected_components(df).collect()}
    assert got == {x: root(x) for x in parent}
    assert components.connected_components(df.limit(0)).count() == 0


# --- SimHash ----------------------------------------------------------------------------


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate({k: k + 32 for k in range(65, 91)}))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    bits = [0] * 64
    for shingle in shingles:
        h = xxhash.xxh64_intdigest(shingle.encode(), 42)
        for k in range(64):
            bits[k] += h >> k & 1
    return sum(1 << k for k in range(64) if 2 * bits[k] > len(shingles))


def plain_components(prints, distance):
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(k) for k in range(len(prints))]


def test_fingerprints(spark):
    texts = random_texts(1, 30) + ["", None, "A\tb\x0bc", "É É", "one", "x " * 5000]
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(texts)], DOCS)
    got = {r.doc_id: r.h for r in simhash.fingerprints(df).select("doc_id", simhash.hex_fingerprint().alias("h")).collect()}
    assert got == {k: f"{plain_print(t or ''):016x}" for k, t in enumerate(texts)}


@pytest.mark.parametrize(("distance", "block"), [(3, 2048), (3, 4), (9, 2048)])
def test_near_fingerprints_meet(spark, monkeypatch, distance, block):
    """Clusters whose members differ in a few bits, within one bucket and beyond a small block."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(6)
    prints = [rng.getrandbits(64) for _ in range(40)]
    for center in prints[:6]:
        for _ in range(12):
            flipped = center
            for bit in rng.sample(range(64), rng.randint(0, distance + 1)):
                flipped ^= 1 << bit
            prints.append(flipped)
    prints += [0, 0]
    rows = [(k, int(np.uint64(p).astype(np.int64))) for k, p in enumerate(prints)]
    df = spark.createDataFrame(rows, "doc_id long, fp long")
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(df, distance).collect()}
    assert got == dict(enumerate(plain_components(prints, distance)))


def test_ids_that_are_missing_or_repeated(spark):
    df = spark.createDataFrame([(None, 5), (9, 5), (9, 0xFFFFFF0000), (3, 0xFFFFFF0001), (None, -1), (4, 7)], "doc_id long, fp long")
    out = Counter((r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect())
    assert out == Counter({(None, 4): 1, (9, 4): 1, (9, 3): 1, (3, 3): 1, (None, None): 1, (4, 4): 1})
    assert simhash.near_duplicates(df.limit(0)).count() == 0


# --- MinHash ----------------------------------------------------------------------------


def shingles(text):
    words = text.lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def test_edited_texts_and_their_likeness(spark):
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(500)}" for _ in range(rng.randint(60, 400))) for _ in range(40)]
    texts += ["", None, "é" * 9, "three short words", texts[0], "\U0001f600 emoji text " * 20]
    ids = rng.sample(range(-50, 10_000, 7), len(texts))
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in zip(ids, texts, strict=True)], DOCS)
    out = {r.doc_id: r for r in minhash.edited_fingerprints(df.repartition(5)).collect()}
    ordered = sorted(zip(ids, texts, strict=True))
    errors = []
    for k, (doc_id, text) in enumerate(ordered):
        text, after = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = out[doc_id]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for estimate, other in ((row.near_edited, edited), (row.near_next, after)):
            a, b = shingles(text), shingles(other)
            errors.append(estimate - (len(a & b) / len(a | b) if a | b else 1.0))
    assert abs(np.mean(errors)) < 0.02 and np.abs(errors).max() < 0.25
    copies = [out[i].fingerprint for i, t in zip(ids, texts, strict=True) if t == texts[0]]
    assert len(copies) == 2 and copies[0] == copies[1]


def test_blocks_and_small_tables(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 3)
    texts = random_texts(2, 50, words=12)
    rows = [(1000 * (k % 20), t, None, None) for k, t in enumerate(texts)] + [(None, "no id here", None, None)]
    df = spark.createDataFrame(rows, DOCS)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    expected = Counter()
    for k, (doc_id, text, *_) in enumerate(ordered):
        after, half = ordered[(k + 1) % len(ordered)][1], len(text) // 2
        expected[doc_id, hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.edited_sha256) for r in minhash.edited_fingerprints(df).collect()) == expected
    assert minhash.edited_fingerprints(df.limit(0)).count() == 0
    one = minhash.edited_fingerprints(df.where("doc_id is null")).first()
    assert one.near_next == 1.0


# --- repeated spans ---------------------------------------------------------------------


def plain_removal(texts, length):
    seen = Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("fragments", [8192, 2])
def test_repeats_are_removed(spark, monkeypatch, fragments):
    """With two fragments to a bucket the way for hot anchors is taken."""
    monkeypatch.setattr(repeated_spans, "NODE_FRAGMENTS", fragments)
    rng = random.Random(12)
    shared = ["".join(rng.choices("abcdé ", k=n)) for n in (70, 150, 400)]
    texts = []
    for _ in range(40):
        parts = ["".join(rng.choices("abcdefgh ", k=rng.randint(0, 120))) for _ in range(3)]
        passage = rng.choice(shared)
        cut = rng.randrange(len(passage))
        texts.append(parts[0] + passage[: rng.randint(60, len(passage))] + parts[1] + (passage[cut:] if cut % 2 else "") + parts[2])
    texts += ["", None, texts[0], "ab" * 300, "z" * 200, "é" * 90]
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(texts)] + [(None, texts[1], None, None)], DOCS)
    length = 64
    expected = plain_removal([(t or "").encode() for t in [*texts, texts[1]]], length)
    out = repeated_spans.remove_repeats(df, length).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out}
    assert got == dict(zip([*range(len(texts)), None], expected, strict=True))
    assert all(len(r.kept) == r.n_bytes - r.n_removed for r in out)
    assert repeated_spans.remove_repeats(df.limit(0), length).count() == 0


def test_common_prefixes_against_counting():
    rng = random.Random(3)
    for trial in range(25):
        length = rng.choice([33, 40, 64])
        base = ["".join(rng.choices("ab" if trial % 2 else "abcdefg", k=300)).encode() for _ in range(3)]
        contents = set()
        for _ in range(rng.randint(1, 20)):
            text = rng.choice(base)
            at = rng.randint(0, 150)
            contents.add(text[at : at + rng.randint(length, 150)])
        contents = sorted(contents)
        numbers = np.array([rng.choice([1, 1, 2]) for _ in contents])
        seen = Counter()
        for text, n in zip(contents, numbers.tolist(), strict=True):
            for k in range(len(text) - length + 1):
                seen[text[k : k + length]] += n
        for text, flags in zip(contents, repeated_spans.repeated_windows(contents, numbers, length), strict=True):
            assert flags.tolist() == [seen[text[k : k + length]] > 1 for k in range(len(text) - length + 1)]


# --- WARC -------------------------------------------------------------------------------


def test_archives_resolve_revisits(spark):
    rows = [(k, f"http://h/{k}", f"<p>{k % 7}</p>" * 20) for k in range(60)]
    rows += [(70, None, None), (71, "http://x/\r\ny", ""), (72, "u", "ü" * 4000), (73, "u", "\r\n\r\nWARC/1.1\r\n")]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, digest string")
    for least in (0, 200):
        groups = {}
        for page, _, html in rows:
            groups.setdefault(html or "", []).append(page)
        expected = {}
        for html, pages in groups.items():
            data = html.encode()
            digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
            for page in pages:
                revisit = len(data) >= least and page != max(pages)
                expected[page] = (len(data), digest, "revisit" if revisit else "response", max(pages) if revisit else None)
        out = warc.write_and_read_back(spark, df, least).collect()
        got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out}
        assert got == expected and len(out) == len(rows)
    assert warc.write_and_read_back(spark, df.limit(0)).count() == 0


def test_missing_and_repeated_page_ids(spark):
    rows = [(None, "u", "same"), (None, "u", "same"), (4, "u", "same"), (4, "v", "same"), (2, "u", "same"), (None, "u", "own")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = Counter((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.write_and_read_back(spark, df).collect())
    assert out == Counter(
        {(None, "revisit", 4, 4): 2, (4, "response", None, 4): 2, (2, "revisit", 4, 4): 1, (None, "response", None, 3): 1}
    )
