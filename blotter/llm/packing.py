"""Best-fit packing (operator 6): bulk-synchronous best fit over range-sorted documents and gaps.

A document's ids (and an end id) are cut into pieces of at most ``capacity``; only longer ones are cut, and the first piece
may be shorter. Pieces sorted by falling length and gaps sorted by size are the two sides of the match. Both are held run
by run: pieces of one length, or gaps of one size, are alike, so each side has at most ``capacity`` runs whatever the
number of documents. In each superstep the longest pieces left look up their successor, the smallest gap that holds them;
as many as there are such gaps are placed, in the order of their ranks, which settles who gets which gap; the gaps shrink,
and the rest looks again, opening new sequences where no gap is left. That is best-fit decreasing.

Spark counts pieces per length, ranks them within their length (in two steps, over salts whose number grows with the
pieces, so that no length meets in one task), and places each by its rank. Counts per length reach the driver (at most
``capacity``), where the match itself is a loop over them; back goes the plan: runs of ranks with their first sequence and
offset.

Null and empty texts are a single piece with the end id; every input row is packed, repeated rows and rows with a null
doc_id included; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import array
import base64
import bisect
import functools
import json
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.llm.cells import release
from blotter.llm.common import materialize, ship

#: Beyond these letters the two libraries' tables of character classes may be of different Unicode versions.
BEYOND_LATIN = re.compile("[^\\x00-\u024f]")
_loaded: dict[tuple, "Encoder"] = {}


class Encoder:
    """Ids as little-endian bytes, as ``tokenizers`` gives them for the vocabulary file.

    Texts of Latin letters go through the same vocabulary's ranks and split in ``tiktoken``, which gives the same ids
    several times faster; the special strings inside texts are the vocabulary file's own. All other texts go through
    ``tokenizers``.
    """

    def __init__(self, path: str, ranks_path: str, pattern: str):
        import tiktoken

        self.path = path
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        with open(path, encoding="utf-8") as vocabulary:
            special = {t["content"]: t["id"] for t in json.load(vocabulary)["added_tokens"]}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

    @functools.cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def ids(self, text: str) -> bytes:
        if BEYOND_LATIN.search(text):
            return array.array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        return array.array("I", self.fast.encode(text, allowed_special="all")).tobytes()


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces; all but the first are full."""
    first = (length - 1) % capacity + 1
    return [(0, first)] + [(s, capacity) for s in range(first, length, capacity)]


def pieces(docs: DataFrame, vocabulary: tuple[str, str, str], end_id: int, capacity: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32; one map over the texts."""
    end = array.array("I", [end_id]).tobytes()

    def run(batches):
        if vocabulary not in _loaded:
            _loaded[vocabulary] = Encoder(*vocabulary)
        encoder = _loaded[vocabulary]
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                own = encoder.ids(text or "") + end
                for k, (start, length) in enumerate(cut(len(own) // 4, capacity)):
                    told = zlib.crc32(own[4 * start : 4 * (start + length)])
                    for column, x in zip(out, (doc_id, k, start, length, told)):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, schema.types)], schema=schema)
            release()

    names = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(names)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Gaps:
    """Gaps sorted by size; a size's sequences are runs (first sequence, count)."""

    def __init__(self):
        self.sizes: list[int] = []
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def add(self, size: int, first: int, count: int) -> None:
        if size <= 0:
            return
        if size not in self.runs:
            bisect.insort(self.sizes, size)
            self.runs[size] = []
        own = self.runs[size]
        if own and own[-1][0] + own[-1][1] == first:
            own[-1] = (own[-1][0], own[-1][1] + count)
        else:
            own.append((first, count))

    def successor(self, length: int) -> int | None:
        i = bisect.bisect_left(self.sizes, length)
        return self.sizes[i] if i < len(self.sizes) else None

    def take(self, size: int, count: int) -> list[tuple[int, int]]:
        """Runs of ``count`` sequences of that size, or of all there are."""
        taken, own = [], self.runs[size]
        while own and count:
            first, n = own.pop()
            used = min(n, count)
            if used < n:
                own.append((first + used, n - used))
            taken.append((first, used))
            count -= used
        if not own:
            del self.runs[size]
            self.sizes.remove(size)
        return taken


def plan(counts: dict[int, int], capacity: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length: first ranks of the runs, their first sequences and their offsets."""
    gaps, sequences, out = Gaps(), 0, {}
    for length in sorted(counts, reverse=True):
        rank, left, runs = 0, counts[length], []
        while left:
            size = gaps.successor(length)
            if size is None:
                new = -(-left // (capacity // length))
                gaps.add(capacity, sequences, new)
                sequences += new
                continue
            for first, n in gaps.take(size, left):
                runs.append((rank, first, capacity - size))
                gaps.add(size - length, first, n)
                rank, left = rank + n, left - n
        out[length] = tuple(np.array(c, dtype=np.int64) for c in zip(*runs))
    return out


def ranked(cut_pieces: DataFrame, per_salt: int = 200_000, least_salts: int = 64) -> tuple[DataFrame, dict[int, int]]:
    """The pieces with their rank (from 0) within their length, and the number of pieces per length."""
    n_salts = max(least_salts, cut_pieces.count() // per_salt + 1)
    salted = cut_pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(n_salts)))
    per_salt_counts = materialize(salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")))
    counts = {r["length"]: r["n"] for r in per_salt_counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity at most
    earlier = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_salt_counts.select("length", "salt", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    within = salted.withColumn("within", F.row_number().over(order) - 1)
    joined = within.join(bases, ["length", "salt"])  # the pieces already lie by length and salt
    return joined.withColumn("rank", F.col("base") + F.col("within")).drop("salt", "base", "within"), counts


def pack(docs: DataFrame, vocabulary: tuple[str, str, str], end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """``vocabulary``: the tokenizer's file, the file of the same vocabulary's ranks, and the split's pattern.

    doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    ship(docs.sparkSession)
    rows, counts = ranked(materialize(pieces(docs, vocabulary, end_id, capacity)))
    placed = plan(counts, capacity)

    @F.pandas_udf(T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))
    def place(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        own_lengths, own_ranks = lengths.to_numpy(), ranks.to_numpy()
        for length in np.unique(own_lengths):
            at = np.flatnonzero(own_lengths == length)
            first_rank, first_sequence, offsets = placed[int(length)]
            run = np.searchsorted(first_rank, own_ranks[at], side="right") - 1
            sequence[at] = first_sequence[run] + own_ranks[at] - first_rank[run]
            offset[at] = offsets[run]
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    return rows.withColumn("at", place("length", "rank")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset"
    )
