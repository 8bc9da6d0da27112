"""URL filters (operator 2) by a Bloom filter cascade, in DataFrame functions only.

A rule is (verdict, host, path). A URL's keys are its host suffixes (at label boundaries) with its path's prefixes (at the
lengths that rules have); it matches a rule whose key it has. The keys of all URLs and rules are the key universe. For
each verdict, level 0 is a Bloom filter of the listed keys, level 1 of the universe's keys that level 0 passes wrongly,
level 2 of the listed keys that level 1 passes wrongly, and so on until a level passes nothing wrongly: the first level
that lacks a key tells exactly whether it is listed. So no join is needed to judge a URL, only the filters' bits.

Level 0 is sized for about as many wrong keys as listed ones, so all levels stay in proportion to the rules, not to the
corpus; ``max_bits`` is the proven bound of what the plan sends to the executors, and passing it is an error.

A rule's key wins over shorter ones; at the same key, block wins over allow. Null URLs and those without ``://`` have an
empty host and path, match nothing and get ``default``. Every input row gives one output row; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import materialize

HASHES = 5
A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), A_TO_Z, A_TO_Z.lower())
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def candidate_keys(host: Column, path: Column, lengths: Sequence[int]) -> Column:
    """The keys of a URL, longest first."""
    labels = F.split(host, r"\.")
    hosts = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    paths = F.filter(
        F.array(*[F.when(F.char_length(path) >= n, F.substring(path, 1, n)) for n in sorted(set(lengths), reverse=True)]),
        lambda p: p.isNotNull(),
    )
    keys = F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p))))
    longer = lambda a, b: F.char_length(b) - F.char_length(a)
    return F.when(host != "", F.array_sort(F.array_distinct(keys), longer)).otherwise(F.array().cast("array<string>"))


def places(key: Column, bits: int, level: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(bits)) for i in range(HASHES)]


def filter_bits(keys: DataFrame, bits: int, level: int) -> bytes:
    """The filter's 64-bit words, big-endian; bits are or-ed per word in the cluster, the words meet in one row."""
    at = keys.select(F.explode(F.array(*places(F.col("key"), bits, level))).alias("bit"))
    masks = at.select(F.floor(F.col("bit") / 64).alias("word"), F.expr("shiftleft(1L, cast(bit % 64 AS int))").alias("mask"))
    blank = keys.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("mask"))  # no gaps
    words = masks.unionByName(blank).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    found = words.agg(F.array_sort(F.collect_list(F.struct("word", "mask"))).alias("found"))
    hexed = F.transform("found", lambda x: F.lpad(F.hex(x["mask"]), 16, "0"))
    return bytes(found.select(F.unhex(F.array_join(hexed, ""))).first()[0])


def passes(key: Column, held: bytes, bits: int, level: int) -> Column:
    """All places of the key are set. The bits are one literal of the plan, sent once per executor, never copied per row."""
    words, out = F.lit(bytearray(held)), F.lit(True)
    for at in places(key, bits, level):
        byte = F.substring(words, (F.floor(at / 64) * 8 + 8 - F.floor(at % 64 / 8)).cast("int"), 1)
        out = out & (F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (at % 8).cast("int")) == 1)
    return out


class Cascade:
    """Exact membership of the universe's keys in the listed keys."""

    def __init__(self, listed: DataFrame, universe: DataFrame, max_bits: int = 1 << 28):
        self.levels: list[tuple[bytes, int]] = []
        inside, outside = listed, universe.join(listed, "key", "left_anti")
        n_in, n_out, bits_so_far = inside.count(), outside.count(), 0
        while n_in:
            level = len(self.levels)
            rate = min(0.5, max(n_in / max(n_out, 1), 1e-9) if level == 0 else 0.5)
            per_key = -HASHES / math.log(1 - rate ** (1 / HASHES))
            bits = max(64, 64 * math.ceil(n_in * per_key / 64))
            bits_so_far += bits
            if bits_so_far > max_bits:
                raise ValueError(f"the filters of {n_in} keys need more than {max_bits} bits")
            held = filter_bits(inside, bits, level)
            self.levels.append((held, bits))
            wrong = materialize(outside.filter(passes(F.col("key"), held, bits, level)))
            inside, outside, n_in, n_out = wrong, inside, wrong.count(), n_in

    def contains(self, key: Column) -> Column:
        """Listed: the first level that lacks the key has an odd number, or no level lacks it and their count is odd."""
        listed = F.lit(len(self.levels) % 2 == 1)
        for i, (held, bits) in reversed(list(enumerate(self.levels))):
            listed = F.when(~passes(key, held, bits, i), F.lit(i % 2 == 1)).otherwise(listed)
        return listed


def url_filter(pages: DataFrame, rules: Sequence[tuple[str, str, str]], default: str = "allow") -> DataFrame:
    """page_id, host, path, rule (the longest that fits, else null) and verdict of every row."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    keyed = pages.select("page_id", host.alias("host"), path.alias("path"))
    keyed = keyed.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), [len(p) for _, _, p in rules] or [0]))
    listed = {v: sorted({h + p for w, h, p in rules if w == v}) for v in ("block", "allow")}
    given = {v: spark.createDataFrame([(k,) for k in keys], "key string") for v, keys in listed.items()}
    universe = materialize(
        keyed.select(F.explode("keys").alias("key")).distinct().unionByName(given["block"]).unionByName(given["allow"]).distinct()
    )
    cascades = {v: Cascade(given[v], universe) for v in listed}
    fits = lambda v: F.get(F.filter("keys", lambda k: cascades[v].contains(k)), F.lit(0))
    judged = keyed.withColumns({"blocked": fits("block"), "allowed": fits("allow")})
    longer = F.coalesce(F.char_length("blocked"), F.lit(-1)) >= F.coalesce(F.char_length("allowed"), F.lit(-1))
    return judged.select(
        "page_id", "host", "path",
        F.when(longer, F.col("blocked")).otherwise(F.col("allowed")).alias("rule"),
        F.when(F.col("blocked").isNull() & F.col("allowed").isNull(), default).when(longer, "block").otherwise("allow").alias("verdict"),
    )
