"""Key-set Bloom filter, tested natively in the scan's own stage.

A semi join against a key set that is too big to broadcast shuffles every fact
row, although few may match. The filter is far smaller than the keys (two bytes
a key): facts that certainly have no match go before the exchange, and the
exact join follows.

The filter is an array of 64-bit words. A key's hash chooses one word and four
bits of it, so a test is one array access and one comparison. The words are
gathered by one aggregate over (word, bits), whose size is checked first, and
reach the plan as a scalar subquery.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS_PER_WORD = 4
BITS = 4
#: 32 MB of words, the keys of 16 million rows at full density.
MAX_WORDS = 1 << 22
#: With more keys than that in a word nearly all facts pass, and the filter is not worth its test.
MOST_KEYS_PER_WORD = 32


def words_for(n_keys: int, max_words: int = MAX_WORDS) -> int | None:
    """How many words serve ``n_keys``; None if the filter would let nearly everything pass."""
    if n_keys > max_words * MOST_KEYS_PER_WORD:
        return None
    return max(1, min(max_words, -(-n_keys // KEYS_PER_WORD)))


def _place(keys: Sequence[Column], n_words: int) -> tuple[Column, Column]:
    """The word of a key (from 0) and its bits in it."""
    word = F.pmod(F.xxhash64(*keys), F.lit(n_words))
    spread = F.xxhash64(F.lit(BITS), *keys)
    bits = F.lit(0).cast("long")
    for i in range(BITS):
        # pmod of a stretch of the second hash: the bit's number.
        number = F.pmod(F.shiftrightunsigned(spread, 6 * i), F.lit(64)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), number))
    return word, bits


def filter_words(keys: DataFrame, columns: Sequence[str], n_words: int) -> DataFrame:
    """One row, ``words``: the filter of the rows of ``keys``."""
    word, bits = _place([F.col(f"`{c}`") for c in columns], n_words)
    # A row of each word without bits, so that the array has no gaps.
    blank = keys.sparkSession.range(n_words).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    told = keys.select(word.alias("word"), bits.alias("bits")).unionByName(blank)
    held = told.groupBy("word").agg(F.bit_or("bits").alias("bits"))
    ordered = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return held.agg(F.transform(ordered, lambda x: x["bits"]).alias("words"))


def may_contain(words: Column, columns: Sequence[str], n_words: int) -> Column:
    """False only for rows whose key is certainly not in the filter (a NULL key matches nothing in a join, and may pass here)."""
    word, bits = _place([F.col(f"`{c}`") for c in columns], n_words)
    return F.get(words, word.cast("int")).bitwiseAND(bits) == bits


def bloom_filtered(facts: DataFrame, keys: DataFrame, columns: Sequence[str], n_keys: int, max_words: int = MAX_WORDS) -> DataFrame:
    """``facts`` without rows that certainly have no match in ``keys`` (a written table of ``n_keys`` rows).

    All facts pass where the filter is not worth it (``words_for``).
    """
    kinds = [(facts.schema[c].dataType, keys.schema[c].dataType) for c in columns]
    if any(a != b for a, b in kinds):
        raise ValueError(f"key columns differ in type ({kinds}); equal values would not have equal hashes")
    n_words = words_for(n_keys, max_words)
    if n_words is None:
        return facts
    return facts.filter(may_contain(filter_words(keys, columns, n_words).scalar(), columns, n_words))
