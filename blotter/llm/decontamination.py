"""Benchmark decontamination (operator 11), with DataFrame functions only.

Words are runs of a-z, 0-9 and code points above U+007F after A-Z are lower-cased. An item of the benchmark is the set of
its windows of ``n`` consecutive words; an item with fewer words, but not none, is one window. Two hash tables are
broadcast: the distinct windows, and the shorter word sequences (blocks) in them. A document hashes one block in every
``stride`` words, so that each window of its text holds exactly one of them; only around blocks found in the table it
hashes its windows and looks them up. A hit counts only if the words are the same (``verify``), so equal hashes never
contaminate.

The documents are read once and their words never cross a shuffle: a document sends one row with its word count and one
small row per hit. Equal rows are merged by each map task, so a document that is repeated very often, or a passage that a
third of all documents hold, makes no hot task. Windows whose bytes exceed ``max_broadcast_bytes`` are dealt to groups by
hash, each of which is broadcast by itself over another scan; none is dropped. One document's words, hits and item ids are
held in one row, some ten times its text.

Null and empty texts and texts without words have no words and no hits. A null doc_id is a document like others; rows that
repeat a doc_id are judged each by its own text, and rows that repeat doc_id and text give as many rows. Benchmark rows
that repeat an item_id are one item with the windows of all of them; those with a null item_id hit words but count as no
item. With an empty benchmark nothing is hit. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import fresh, materialize
from blotter.operators.joins import DEFAULT_MAX_BROADCAST_BYTES, measured

#: Blocks and windows together take at most so many times the windows' measured bytes: a window has up to (n + 2) / 2
#: blocks of two numbers, and is itself measured with its words as JSON.
BLOCKS_SHARE = 3
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What stands between words (of a text with upper-case letters too), and the place where a word ends.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD_END = r"(?<=[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F])(?=[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F])"


def with_words(rows: DataFrame, *columns: str) -> DataFrame:
    """``columns`` and the words of ``text``."""
    raw = F.split(F.translate(F.coalesce("text", F.lit("")), UPPER, UPPER.lower()), SEPARATORS)
    before, after = (F.element_at("words", F.lit(at)) == "" for at in (1, -1))
    first, n = F.when(before, 2).otherwise(1), F.size("words") - before.cast("int") - after.cast("int")
    return rows.select(*columns, raw.alias("words")).withColumn("words", F.slice("words", first, F.greatest(n, F.lit(0))))


def block_size(length: int) -> int:
    return (length + 1) // 2


def item_windows(items: DataFrame, n: int) -> DataFrame:
    """hash, length, window, item_ids (sorted) of every distinct window."""
    words = with_words(items.select(F.col("item_id").cast("string").alias("item_id"), "text"), "item_id")
    sized = words.withColumn("length", F.least(F.size("words"), F.lit(n))).filter("length > 0")
    starts = F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)
    cut = sized.withColumn("start", F.explode(starts)).select("item_id", "length", F.slice("words", F.col("start"), F.col("length")).alias("window"))
    return (
        cut.groupBy("length", "window")
        .agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
        .withColumn("hash", F.xxhash64("window"))
    )


def blocks_of(windows: DataFrame, lengths: list[int]) -> DataFrame:
    """block_length, block_hash of every block of words in a window."""
    size = F.lit(0)
    for x in lengths:
        size = F.when(F.col("length") == x, block_size(x)).otherwise(size)
    sized = windows.select("window", "length", size.alias("size"))
    placed = sized.withColumn("start", F.explode(F.sequence(F.lit(1), F.col("length") - F.col("size") + 1)))
    return placed.select(F.col("length").alias("block_length"), F.xxhash64(F.slice("window", F.col("start"), F.col("size"))).alias("block_hash")).distinct()


def document_key(doc_id: Column, text: Column) -> Column:
    """Tells rows apart by id and text; never null."""
    told = F.when(doc_id.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), doc_id.cast("string")))
    return F.concat(F.md5(told.cast("binary")), F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def looked_up(docs: DataFrame, windows: DataFrame, blocks: DataFrame, lengths: list[int], verify: bool, count: bool) -> DataFrame:
    """key, doc_id, n_words and, of a hit, start, length and set_id; with ``count`` also one row without a hit per document."""
    words = with_words(docs, "doc_id", "text")
    own = [F.struct(F.lit(x).alias("length"), F.lit(block_size(x)).alias("size"), F.lit(x - block_size(x) + 1).alias("stride")) for x in lengths]
    shaped = words.withColumn("shape", F.explode(F.array(*own))).select("doc_id", "text", "words", "shape.*")
    starts = F.sequence(F.lit(1), F.size("words") - F.col("size") + 1, F.col("stride"))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice("words", i, F.col("size"))))
    told = F.array(F.lit(None).cast("long"))  # position 0 stands for the document itself
    hashes = F.when(F.size("words") >= F.col("length"), F.concat(told, hashes)).otherwise(told)
    placed = shaped.select("doc_id", "text", "words", "length", "size", "stride", F.posexplode(hashes).alias("block", "own_hash"))
    alone = F.lit(count) & (F.col("block") == 0) & (F.col("length") == lengths[0])
    near = placed.join(F.broadcast(blocks), (F.col("own_hash") == F.col("block_hash")) & (F.col("length") == F.col("block_length")), "left")
    at = (F.col("block") - 1) * F.col("stride") + 1
    around = F.sequence(
        F.greatest(F.lit(1), at - F.col("length") + F.col("size")), F.least(at, F.size("words") - F.col("length") + 1)
    )
    around = F.when(F.col("block") > 0, around).otherwise(F.array(F.lit(0)))
    windowed = (
        near.filter(F.col("block_hash").isNotNull() | alone)
        .select("doc_id", "text", "words", "length", F.explode(around).alias("start"))
        .withColumn("cut", F.when(F.col("start") > 0, F.slice("words", F.greatest("start", F.lit(1)), F.col("length"))))
        .withColumn("cut_hash", F.when(F.col("start") > 0, F.xxhash64("cut")))
    )
    window = windows.select("hash", F.col("length").alias("window_length"), "window", "set_id")
    same = (F.col("cut_hash") == F.col("hash")) & (F.col("length") == F.col("window_length"))
    if verify:
        same &= F.col("cut") == F.col("window")
    joined = windowed.join(F.broadcast(window), same, "left").filter(F.col("hash").isNotNull() | (F.col("start") == 0))
    return joined.select(
        document_key(F.col("doc_id"), F.col("text")).alias("key"),
        "doc_id",
        F.size("words").alias("n_words"),
        F.col("hash").isNotNull().alias("hit"),
        "start",
        "length",
        "set_id",
    )


def contamination(
    docs: DataFrame, items: DataFrame, n: int = 10, verify: bool = True, max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES
) -> DataFrame:
    """key, doc_id, n_words, n_hit, hits (array of start, from 1, and length, in words), item_ids (sorted) of every row."""
    found = materialize(item_windows(items, n))
    set_id = F.md5(F.to_json(F.col("item_ids")).cast("binary"))
    windows, size = measured(found.select("hash", "length", "window", set_id.alias("set_id")))
    sets = found.select(set_id.alias("set_id"), "item_ids").dropDuplicates(["set_id"])
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect()) or [n]  # n at most
    groups = -(-(BLOCKS_SHARE * size) // max_broadcast_bytes) or 1
    parts = []
    for g in range(groups):
        own = windows if groups == 1 else windows.filter(F.pmod("hash", F.lit(groups)) == g)
        parts.append(looked_up(docs, own, materialize(blocks_of(own, lengths)), lengths, verify, g == 0))
    end = lambda s: s["start"] + s["length"]
    told = materialize(
        reduce(DataFrame.unionByName, parts)
        .groupBy("key", "doc_id", "n_words")
        .agg(
            F.count(F.when(~F.col("hit"), 1)).alias("copies"),
            F.array_sort(F.collect_set(F.when(F.col("hit"), F.struct("start", "length")))).alias("hits"),
            F.collect_set("set_id").alias("set_ids"),
        )
    )
    covered = F.aggregate(
        "hits",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("total")),
        lambda a, s: F.struct(
            F.greatest(a["end"], end(s)).alias("end"), (a["total"] + F.greatest(F.lit(0), end(s) - F.greatest(a["end"], s["start"]))).alias("total")
        ),
        lambda a: a["total"],
    )
    of_items = (
        told.select("key", F.explode("set_ids").alias("set_id"))
        .join(sets, "set_id")
        .select("key", F.explode("item_ids").alias("item_id"))
        .groupBy("key")
        .agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    )
    none = F.array().cast("array<string>")
    return (
        told.join(of_items, "key", "left")
        .withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
        .select("key", "doc_id", "n_words", covered.alias("n_hit"), "hits", F.coalesce("item_ids", none).alias("item_ids"))
    )


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.col("n_hit").cast("long").alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, drop: str = "spans", n: int = 10,
                  max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``docs`` with all its columns, without the hit words (``spans``) or without the documents that have any (``documents``).

    A removed word goes with the separators before it; what follows the last word stays. A text that is not hit, and a null
    one, stays as it is. The hits are broadcast only if their measured bytes are within the bound.
    """
    if drop not in ("spans", "documents"):
        raise ValueError(f"unknown drop {drop!r}: spans or documents")
    key, own, hits, split = (fresh(docs.columns, x) for x in ("key", "found_key", "hits", "pieces"))
    found = contamination(docs, items, n, max_broadcast_bytes=max_broadcast_bytes).filter("n_hit > 0")
    kept = found.select(F.col("key").alias(own), *([F.col("hits").alias(hits)] if drop == "spans" else [])).dropDuplicates([own])
    side, size = measured(kept)
    side = F.broadcast(side) if size <= max_broadcast_bytes else side
    keyed = docs.withColumn(key, document_key(F.col("doc_id"), F.col("text")))
    if drop == "documents":
        return keyed.join(side, F.col(key) == F.col(own), "left_anti").select(*[f"`{c}`" for c in docs.columns])
    text = F.col("text")
    pieces = F.split(text, WORD_END)  # a word with the separators before it; what follows the last word, if any, comes last
    cut = F.col(split)
    gone = F.flatten(F.transform(hits, lambda h: F.sequence(h["start"], h["start"] + h["length"] - 1)))
    rest = F.array_except(F.sequence(F.lit(1), F.size(cut)), gone)
    cleaned = F.array_join(F.transform(rest, lambda i: F.element_at(cut, i)), "")
    joined = keyed.join(side, F.col(key) == F.col(own), "left").withColumn(split, F.when(F.col(hits).isNotNull(), pieces))
    return joined.select(*[F.when(F.col(hits).isNull(), text).otherwise(cleaned).alias("text") if c == "text" else f"`{c}`" for c in docs.columns])
