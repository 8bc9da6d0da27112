"""Vector code compression (operator 13): product codes by Orchard's search, exact in whole numbers.

A vector's components become floor(256 * x) and are cut into equal parts; each part position has a codebook, and a part's
code is the index of its nearest entry (squared Euclidean distance, ties to the lower index). The codebooks start as the
parts of the vectors with the smallest ids; each round assigns all parts and replaces every entry by the componentwise
floor(sum / count) of its parts; an entry without parts stays.

Orchard's search keeps for every entry the list of all entries by their distance from it. A part walks the list of the
best entry it knows; when an entry of the list is nearer, it goes on in that entry's list from its start; entries seen
before are marked and not measured again. It ends where the list's next entry is more than twice the current distance
away: by the triangle inequality nothing farther can be nearer or as near. All parts of a batch walk at once.

The codebooks and lists hold entries x components and entries**2 numbers per part, whatever the input. They go to the
tasks with the code; a round brings back one sum per entry and component. Rows are not shuffled in a round, and a label
that a third of all rows share only adds to a partial sum.

Vectors that are null or empty or hold null or non-finite components are dropped, as are those of another length than the
kept vector with the smallest id, or of a length that isn't a multiple of ``parts``. A null vec_id is kept and comes
last in the order of ids; rows that repeat a vec_id each count, in the order of their components. With fewer vectors than
entries the codebooks are smaller; an empty table gives no rows. Components beyond ``vectors.LARGEST`` are an error. Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm import vectors
from blotter.llm.common import materialize, ship
from blotter.operators.joins import DEFAULT_MAX_BROADCAST_BYTES, measured


class Codebook:
    """The entries of one part position, and for each the others by distance (equal ones by index)."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        apart = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        self.lists = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.lists, axis=1)

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the nearest entry, squared distance) of each part."""
        n, k = len(parts), len(self.entries)
        best = np.zeros(n, np.int64)
        distance = ((parts - self.entries[0]) ** 2).sum(axis=1)
        marked = np.zeros((n, k), bool)
        marked[:, 0] = True
        walking, at = np.arange(n), np.zeros(n, np.int64)  # place in the list of the best entry
        while len(walking):
            own = best[walking]
            walking = walking[self.apart[own, at[walking]] <= 4 * distance[walking]]  # twice as far, squared; as near counts
            entry = self.lists[best[walking], at[walking]]
            at[walking] += 1
            new = ~marked[walking, entry]
            seen, entry = walking[new], entry[new]
            marked[seen, entry] = True
            d = ((parts[seen] - self.entries[entry]) ** 2).sum(axis=1)
            better = (d < distance[seen]) | ((d == distance[seen]) & (entry < best[seen]))
            seen, entry, d = seen[better], entry[better], d[better]
            best[seen], distance[seen], at[seen] = entry, d, 0
            walking = walking[at[walking] < k]
        return best, distance


def assigned(books: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, squared distances), rows x parts; ``books`` is parts x entries x components."""
    width = books.shape[2]
    found = [Codebook(entries).nearest(numbers[:, p * width : (p + 1) * width]) for p, entries in enumerate(books)]
    return np.stack([x for x, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def entry_sums(kept: DataFrame, books: np.ndarray) -> np.ndarray:
    """Per part and entry: the count of its parts and the sums of their components (parts x entries x 1 + components)."""
    n_parts, n_entries, width = books.shape

    def run(batches):
        total = np.zeros((n_parts, n_entries, 1 + width), np.int64)
        for batch in batches:
            numbers = vectors.stacked(batch["numbers"].to_numpy(zero_copy_only=False), n_parts * width)
            codes, _ = assigned(books, numbers)
            for p in range(n_parts):
                np.add.at(total[p], codes[:, p], np.concatenate([np.ones((len(numbers), 1), np.int64), numbers[:, p * width : (p + 1) * width]], axis=1))
        at = np.flatnonzero(total.reshape(-1))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.reshape(-1)[at])], names=["at", "x"])

    out = np.zeros(books.shape[0] * books.shape[1] * (1 + width), np.int64)
    for r in kept.select("numbers").mapInArrow(run, "at long, x long").groupBy("at").agg(F.sum("x").alias("x")).collect():
        out[r["at"]] = r["x"]
    return out.reshape(n_parts, n_entries, 1 + width)


def improved(books: np.ndarray, sums: np.ndarray) -> np.ndarray:
    count = sums[:, :, :1]
    return np.where(count > 0, sums[:, :, 1:] // np.maximum(count, 1), books)


def first_books(kept: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "numbers").limit(entries).select("numbers").collect()
    if not first:
        return None
    size = len(first[0]["numbers"])
    return vectors.stacked([r["numbers"] for r in first], size).reshape(len(first), parts, size // parts).transpose(1, 0, 2).copy()


def whole_rows(table: DataFrame, parts: int) -> DataFrame:
    """vec_id, label, numbers of the rows that take part."""
    good = table.select("vec_id", "label", "embedding").filter(vectors.whole(F.col("embedding")))
    good = good.filter(F.size("embedding") % parts == 0)
    first = good.select("vec_id", F.size("embedding").alias("n")).orderBy(F.col("vec_id").asc_nulls_last(), "n").first()
    return good.filter(F.size("embedding") == (first["n"] if first else 0)).select("vec_id", "label", vectors.scaled(F.col("embedding")).alias("numbers"))


def compress(
    table: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES
) -> DataFrame:
    """vec_id, code (two hex digits per part), error, label_error, codebooks_sha256 of every kept row."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    ship(table.sparkSession)
    kept = materialize(whole_rows(table, parts))
    books = first_books(kept, parts, entries)
    if books is None:
        return kept.select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in
                                       (("code", "string"), ("error", "long"), ("label_error", "long"), ("codebooks_sha256", "string"))])
    for _ in range(rounds):
        books = improved(books, entry_sums(kept, books))
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    width = books.shape[0] * books.shape[2]

    def run(batches):
        for batch in batches:
            codes, distances = assigned(books, vectors.stacked(batch["numbers"].to_numpy(zero_copy_only=False), width))
            text = [bytes(row).hex() for row in codes.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], batch["label"], pa.array(text, pa.string()), pa.array(distances.sum(axis=1), pa.int64())],
                names=["vec_id", "label", "code", "error"],
            )

    kinds = {c: kept.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    coded = materialize(kept.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"))
    totals, size = measured(coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error")))
    totals = F.broadcast(totals) if size <= max_broadcast_bytes else totals
    out = coded.join(totals, F.col("label").eqNullSafe(F.col("of_label")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
