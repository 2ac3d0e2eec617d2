"""Document fingerprints by one-permutation MinHash, in built-in functions only.

Each distinct shingle of five words is hashed once. The high bits of the hash name one of ``BINS``
bins and each bin keeps its smallest hash. Sorting the hashes puts the bins side by side, so the
smallest of each bin is the one whose bin differs from that of its left neighbour. An empty bin
takes the value of the first filled bin in a random order of its own (optimal densification); the
order depends on the bin alone, so two documents draw alike. The fingerprint packs the low
``LOW_BITS`` of each bin; two of them agree by chance in one of 2^b values, which the estimate
takes out.

Neighbours by id: ids are cut into blocks at quantiles, a window inside the block reaches the next
row, and the last row of a block gets the first row of the next block that has any. Texts are
shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgermill.session import written

SHINGLE = 5
BINS = 128
BIN_BITS = 7
LOW_BITS = 8
PROBES = 12
FAN = 64  # blocks are FAN * FAN at most
BLOCK_ROWS = 512
SPACE = r"[\x20\x09-\x0D]+"


def _order_of(bin_: int) -> list[int]:
    """The order in which an empty bin tries the others: a permutation that depends on it alone."""

    def mixed(other: int) -> int:
        x = ((bin_ * BINS + other + 1) * 0x9E3779B97F4A7C15) & (2**64 - 1)
        x ^= x >> 31
        x = (x * 0xBF58476D1CE4E5B9) & (2**64 - 1)
        return x ^ (x >> 29)

    return sorted((other for other in range(BINS) if other != bin_), key=mixed)


def _numbers(values: list[int], kind: str = "int") -> str:
    """SQL text of a constant array."""
    return f"cast(array({', '.join(map(str, values))}) as array<{kind}>)"


def word_hashes(text: Column) -> Column:
    """A hash per lower-cased word; words are cut at ASCII white space."""
    words = F.filter(F.split(F.lower(text), SPACE), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _with_shingles(df: DataFrame, words: str, out: str) -> DataFrame:
    """Sorted shingle hashes; fewer than SHINGLE words are one shingle, no words none."""
    n = F.size(words)
    shingles = F.transform(
        F.slice(words, 1, F.greatest(n - (SHINGLE - 1), F.lit(0))),
        lambda w, k: F.xxhash64(w, *(F.get(F.col(words), k + j) for j in range(1, SHINGLE))),
    )
    short = F.when(n > 0, F.array(F.xxhash64(F.col(words)))).otherwise(F.array().cast("array<bigint>"))
    return df.withColumn(out, F.sort_array(F.when(n >= SHINGLE, shingles).otherwise(short)))


def _bin(value: Column) -> Column:
    return F.shiftrightunsigned(value, 64 - BIN_BITS).cast("int")


def _with_signature(df: DataFrame, shingles: str, out: str) -> DataFrame:
    """The low bits of all bins as an array of BINS numbers; null for a text without words."""
    mins, bins, lows, found = (f"{out}_{name}" for name in ("mins", "bins", "lows", "found"))
    hashes = F.col(shingles)
    first = F.filter(hashes, lambda h, k: (k == 0) | (_bin(h) != _bin(F.get(hashes, F.greatest(k - 1, F.lit(0))))))
    df = df.withColumn(mins, first)
    df = df.withColumn(bins, F.transform(mins, _bin)).withColumn(
        lows, F.transform(mins, lambda h: h.bitwiseAND(2**LOW_BITS - 1).cast("int"))
    )
    # Named twice, so that the optimizer keeps both arrays as columns of their own.
    filled = (F.size(bins) > 0) & (F.size(lows) > 0)
    every = F.sequence(F.lit(0), F.lit(BINS - 1))
    place = lambda b: F.get(F.col(lows), (F.array_position(F.col(bins), b) - 1).cast("int"))
    df = df.withColumn(found, F.when(filled, F.transform(every, place)))
    orders = [_order_of(b) for b in range(BINS)]
    near = F.expr(f"array({', '.join(_numbers(order[:PROBES]) for order in orders)})")
    far = F.expr(f"array({', '.join(_numbers(order[PROBES:]) for order in orders)})")

    def draw(order: Column) -> Column:
        tried = F.filter(order, lambda b: F.get(F.col(found), b).isNotNull())
        return F.get(F.col(found), F.get(tried, F.lit(0)))

    dense = F.transform(F.col(found), lambda v, b: F.coalesce(v, draw(F.get(near, b)), draw(F.get(far, b))))
    return df.withColumn(out, F.when(F.col(found).isNotNull(), dense)).drop(mins, bins, lows, found)


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the signature array of a text column; equal texts have equal signatures."""
    words, shingles = f"{out}_words", f"{out}_shingles"
    df = df.withColumn(words, word_hashes(F.col(text)))
    df = _with_shingles(df, words, shingles).drop(words)
    return _with_signature(df, shingles, out).drop(shingles)


def packed(signature: str) -> Column:
    """The signature as hex text; the text without words has the empty fingerprint."""
    digits = F.transform(F.col(signature), lambda v: F.lpad(F.lower(F.hex(v)), LOW_BITS // 4, "0"))
    return F.coalesce(F.array_join(digits, ""), F.lit(""))


def likeness(a: str, b: str) -> Column:
    """Estimated Jaccard similarity of two signatures, 0 to 1; of two without words 1, of one 0."""
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)) / F.lit(float(BINS))
    chance = 1.0 / 2**LOW_BITS
    estimate = F.greatest(F.lit(0.0), (equal - chance) / (1 - chance))
    both_empty = F.col(a).isNull() & F.col(b).isNull()
    one_empty = F.col(a).isNull() | F.col(b).isNull()
    return F.when(both_empty, F.lit(1.0)).when(one_empty, F.lit(0.0)).otherwise(estimate)


def _block(doc_id: Column, bounds: list[int]) -> Column:
    """The number of bounds at or below an id, found in two steps; a null id sorts first."""
    if not bounds:
        return F.lit(0)
    rows = [bounds[k : k + FAN] for k in range(0, len(bounds), FAN)]
    # The last bound of each row but the last one leads to the next row.
    coarse = F.expr(_numbers([row[-1] for row in rows[:-1]], "bigint"))
    fine = F.expr(f"array({', '.join(_numbers(row, 'bigint') for row in rows)})")
    group = F.size(F.filter(coarse, lambda b: b <= doc_id))
    within = F.size(F.filter(F.get(fine, group), lambda b: b <= doc_id))
    return F.when(doc_id.isNull(), F.lit(0)).otherwise(group * FAN + within)


def _blocked(rows: DataFrame) -> DataFrame:
    """Adds ``block``: ids in blocks of some BLOCK_ROWS rows, FAN * FAN blocks at most."""
    n_blocks = max(1, min(FAN * FAN, -(-rows.count() // BLOCK_ROWS)))
    shares = [k / n_blocks for k in range(1, n_blocks)]
    bounds = rows.agg(F.percentile_approx("doc_id", shares, 100 * n_blocks)).first()[0] if shares else None
    return rows.withColumn("block", _block(F.col("doc_id"), sorted(set(bounds or []))))


def _tails(blocked: DataFrame) -> DataFrame:
    """For each block the first text after it: that of the next block, after the last of the first."""
    least = blocked.groupBy("block").agg(F.min(F.struct(F.col("doc_id").alias("id"))).alias("least"))
    least = written(least.select(F.col("block").alias("head_block"), F.col("least.id").alias("head_id")), "block-heads")
    heads = blocked.join(least, F.expr("block = head_block and doc_id <=> head_id"))
    heads = heads.groupBy("block").agg(F.min("text").alias("text"))
    order = Window.orderBy("block")  # one row per block
    around = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = heads.select(
        F.col("block").alias("tail_block"),
        F.coalesce(F.lead("text").over(order), F.first("text").over(around)).alias("tail_text"),
    )
    return written(with_fingerprint(after, "tail_text", "tail_signature"), "block-tails")


def with_next(rows: DataFrame) -> DataFrame:
    """Adds ``signature, next_text, next_signature`` to ``doc_id, text``.

    The next row is the one with the next id, after the last the first. Ties are ordered by text;
    a null id sorts first. A single row is its own next row.
    """
    blocked = _blocked(rows)
    tails = _tails(blocked)
    inside = Window.partitionBy("block").orderBy("doc_id", "text")
    ahead = blocked.withColumn("next_text", F.lead("text").over(inside))
    ahead = with_fingerprint(ahead, "text", "signature")
    ahead = ahead.withColumn("next_signature", F.lead("signature").over(inside))
    last = F.col("next_text").isNull()
    joined = ahead.join(tails, last & (F.col("block") == F.col("tail_block")), "left")
    return joined.select(
        "doc_id",
        "text",
        "signature",
        F.when(last, F.col("tail_text")).otherwise(F.col("next_text")).alias("next_text"),
        F.when(last, F.col("tail_signature")).otherwise(F.col("next_signature")).alias("next_signature"),
    )


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, with their likeness and that to the next one.

    The edited text has its last floor(n/2) code points replaced by the first as many of the next
    row's text. A null or empty text is empty; without words the fingerprint is the empty string.
    Repeated rows are reported each. An empty table gives an empty result.
    """
    rows = docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )
    both = with_next(rows).withColumn("n_chars", F.char_length("text"))
    kept = F.substring("text", F.lit(1), F.expr("n_chars - n_chars div 2").cast("int"))
    new = F.substring("next_text", F.lit(1), F.expr("n_chars div 2").cast("int"))
    both = both.withColumn("edited", F.concat(kept, new)).withColumn("edited_sha256", F.sha2("edited", 256))
    both = with_fingerprint(both, "edited", "edited_signature")
    return both.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited_sha256",
        packed("signature").alias("fingerprint"),
        packed("edited_signature").alias("edited_fingerprint"),
        likeness("signature", "edited_signature").alias("near_edited"),
        likeness("signature", "next_signature").alias("near_next"),
    )
