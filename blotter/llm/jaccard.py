"""N-gram Jaccard join (operator 7) by token-combination prefixes.

A document is its set of distinct five-word shingles (words without case in A-Z; with fewer words the whole sequence is
one shingle). Documents link when 100 * |intersection| >= 75 * |union|.

1. Document frequencies. Each batch of documents sends its distinct shingles, packed into one cell per hash bucket; a
   shingle that occurs in several documents of a batch goes once, with its count, so a frequent one costs a row part per
   batch. The buckets reply to each batch with the shingles that occur in two documents or more.
2. Only documents at least 75 % of whose shingles are such can have a partner. They are kept with these shingles in the
   global order (frequency, hash); equal sets are merged into one class, named by its smallest doc_id.
3. A first round of verification links classes that have the same smallest hash under one of two seeds, as near copies
   mostly do: tiles of bounded size are compared, and a tile returns a spanning edge per class. All that follows is about
   classes that are still in different components.
4. Token-combination prefixes. Two sets that link share a shingle among the first ``n - ceil(0.75 n) + 1`` of each, and
   ``g + 1`` of them among ``g`` more. Rare shingles of the prefix are index keys of their own. Frequent ones are indexed
   as pairs within the prefix extended by ``g``: shingles are dealt to g hash groups, so of g + 1 shared ones two are in
   one group, and only pairs within a group are indexed. With g in proportion to the set's size that is a few keys per
   shingle, whatever the size; linked sets differ in size by 4/3 at most, so a set is indexed for its own and the next
   step of that scale, and each link has a step in common. Pairs are made only of shingles that classes of different
   components share.
5. Verification of what is left. A key counts only while its classes are in several components; that is decided from one
   row per key and component. Components chained by such keys form a cloud. Its classes that have such keys are compared
   in pairs of tiles where they share many keys, and else pair by pair (``open_links``); either way every pair across
   components that shares a key is compared.

Shingles are told apart by 64-bit hashes, whose words are hashed by a random table of (position, byte), and by 40 bits and
their bucket from the second step on; texts are not compared after that. With b buckets of some million shingles, a
document's shingle is taken for another one's with probability below 1e-6. ``docs`` must give the same rows in the same
order when read again, as a written table does; a batch whose replies don't find it is an error.

Null and empty texts and texts without words have no shingles and link with nothing; a null doc_id links with nothing and
has a null component; rows that repeat a doc_id each give an output row; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.llm import cells
from blotter.llm.common import materialize, partitions_for, ship
from blotter.llm.graph import components, smallest_reachable

WORDS = 5
MANY = 0xFFFF  # in a cell, instead of a document's number: several documents of the batch
CHUNK = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
NEXT_SPACE = re.compile(rb"[\x09-\x0d\x20]")
POSITIONS = 64
#: A random number for each byte at each of a word's first places; upper-case letters have those of lower-case ones.
PLACED = np.random.default_rng(2024).integers(0, 2**64, (POSITIONS, 256), dtype=np.uint64)
PLACED[:, 65:91] = PLACED[:, 97:123]
PLACED = PLACED.reshape(-1)
FACTORS = np.random.default_rng(5).integers(1, 2**63, 2 * WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def word_hashes(text: bytes) -> np.ndarray:
    """A hash per word, in order; long texts in chunks that end at white space.

    The sum over the word's bytes of a random number of (place, byte), with the length. Unlike a polynomial it has no
    structure that some pair of words cancels.
    """
    out, at = [], 0
    while at < len(text):
        m = NEXT_SPACE.search(text, at + CHUNK)
        end = m.start() if m else len(text)
        data = np.frombuffer(text, np.uint8, end - at, at)
        space = SPACE[data]
        edges = np.flatnonzero(np.diff(space, prepend=True, append=True))
        start, size = edges[::2], edges[1::2] - edges[::2]
        if len(start):
            first = np.cumsum(size) - size
            place = np.arange(first[-1] + size[-1]) - np.repeat(first, size)
            kept = data[~space].astype(np.int64)
            if size.max() <= POSITIONS:
                numbers = PLACED[place * 256 + kept]
            else:
                low = np.where((kept >= 65) & (kept < 91), kept + 32, kept)
                far = cells.mix((place * 256 + low).astype(np.uint64) * FACTORS[0] + FACTORS[1])
                numbers = np.where(place < POSITIONS, PLACED[np.minimum(place, POSITIONS - 1) * 256 + kept], far)
            out.append(cells.mix(np.add.reduceat(numbers, first) + size.astype(np.uint64) * FACTORS[2]))
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes."""
    words = word_hashes((text or "").encode())
    n = len(words)
    if n == 0:
        return words
    size = min(n, WORDS)
    factors = FACTORS[:WORDS] if n >= WORDS else FACTORS[WORDS:] + np.uint64(2 * n)
    total = np.zeros(n - size + 1, np.uint64)
    for j in range(size):
        total += words[j : n - size + 1 + j] * factors[j]
    return np.unique(cells.mix(total))


def id_width(buckets: int) -> int:
    """Bytes of a shingle's id: its bucket above its 40-bit key."""
    return 5 + max(1, (buckets.bit_length() + 7) // 8)


class Batch:
    """The distinct shingles of some documents: (id, document) pairs sorted by id, and how many documents have each."""

    def __init__(self, texts: list[str | None], buckets: int):
        sets = [shingles(t) for t in texts]
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        self.digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
        hashes = np.concatenate([*sets, np.empty(0, np.uint64)])
        documents = np.repeat(np.arange(len(sets)), self.sizes)
        ids = (cells.bucket_of(hashes, buckets).astype(np.uint64) << np.uint64(cells.KEY_BITS)) | (hashes & cells.KEY_MASK)
        order = np.argsort(ids, kind="stable")
        self.ids, self.documents = ids[order], documents[order]
        self.first = np.flatnonzero(np.diff(self.ids, prepend=np.uint64(2**64 - 1)) != 0) if len(ids) else np.empty(0, np.int64)
        self.counts = np.diff(np.append(self.first, len(ids)))

    def cells(self):
        """(bucket, cell of keys, document or MANY, count)."""
        ids, many = self.ids[self.first], self.counts > 1
        documents = np.where(many, MANY, self.documents[self.first])
        keys, buckets = ids & cells.KEY_MASK, (ids >> np.uint64(cells.KEY_BITS)).astype(np.int64)
        present, starts = np.unique(buckets, return_index=True)
        for b, lo, hi in zip(present, starts, np.append(starts[1:], len(ids))):
            yield int(b), cells.pack(keys[lo:hi], [(documents[lo:hi], 2), (self.counts[lo:hi], 2)])

    def own(self, doc_ids: list[int], width: int) -> bytes:
        """What the batch must know when the replies come: its documents, and who has the shingles that went as MANY."""
        many = np.repeat(self.counts > 1, self.counts)
        ids, documents = self.ids[many], self.documents[many]
        parts = [
            len(doc_ids).to_bytes(4, "little"), len(ids).to_bytes(4, "little"), np.array(doc_ids, "<i8").tobytes(), self.sizes.astype("<i8").tobytes(),
            b"".join(self.digests), cells.planes(np.diff(ids, prepend=np.uint64(0)), width), cells.planes(documents, 2),
        ]
        return b"".join(parts)


def read_own(data: bytes, width: int):
    n, m = int.from_bytes(data[:4], "little"), int.from_bytes(data[4:8], "little")
    at = 8
    doc_ids = np.frombuffer(data, "<i8", n, at)
    sizes = np.frombuffer(data, "<i8", n, at + 8 * n)
    at += 16 * n
    digests = [data[at + 16 * i : at + 16 * i + 16] for i in range(n)]
    held = memoryview(data)[at + 16 * n :]
    ids = np.cumsum(cells.from_planes(held, m, width), dtype=np.uint64)
    return doc_ids, sizes, digests, ids, cells.from_planes(held[m * width :], m, 2)


@F.pandas_udf(T.LongType())
def n_shingles(texts: pd.Series) -> pd.Series:
    return pd.Series([len(shingles(t)) for t in texts], dtype="int64")


BATCH_ROWS, BATCH_BYTES = 4096, 4 << 20
CELL = "batch long, bucket int, data binary"
CELL_SCHEMA = pa.schema([("batch", pa.int64()), ("bucket", pa.int32()), ("data", pa.binary())])


def send(docs: DataFrame, buckets: int, own: bool) -> DataFrame:
    """The batches' cells, or what they keep for themselves (bucket -1)."""
    width = id_width(buckets)

    def run(batches):
        partition, number = TaskContext.get().partitionId(), 0
        for arrow in batches:
            for part in cells.slices(arrow, BATCH_ROWS, BATCH_BYTES):
                doc_ids = part["doc_id"].to_pylist()
                batch = Batch(part["text"].to_pylist(), buckets)
                name = cells.batch_name(partition, number, doc_ids)
                number += 1
                rows = [(-1, batch.own(doc_ids, width))] if own else list(batch.cells())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(rows), pa.int64()), pa.array([b for b, _ in rows], pa.int32()), pa.array([d for _, d in rows], pa.binary())],
                    schema=CELL_SCHEMA,
                )
                cells.release()

    return docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), "text").mapInArrow(run, CELL)


def reply(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    """To each batch, the bucket's shingles that it has and that occur in two documents or more."""
    parts = [cells.unpack(d, [2, 2]) for d in frame["data"]]
    keys, documents, counts = (np.concatenate(c) for c in zip(*parts))
    source = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.flatnonzero(np.diff(ordered, prepend=ordered[0] + np.uint64(1)) != 0)
    total = np.add.reduceat(counts[order].astype(np.int64), first)
    frequency = np.empty(len(keys), np.int64)
    frequency[order] = np.repeat(total, np.diff(np.append(first, len(keys))))
    out = []
    bounds = np.searchsorted(source, np.arange(len(parts) + 1))
    for i, batch in enumerate(frame["batch"]):
        own = slice(bounds[i], bounds[i + 1])
        hit = frequency[own] > 1
        if hit.any():
            common = np.minimum(frequency[own][hit], MANY)
            out.append((batch, key[0], cells.pack(keys[own][hit], [(documents[own][hit], 2), (common, 2)])))
    cells.release()
    return pd.DataFrame(out, columns=["batch", "bucket", "data"])


def ordered_sets(width: int):
    """Per batch: its documents, and of those that may have a partner the shared shingles in the global order."""

    def run(mine: pd.DataFrame, frame: pd.DataFrame) -> pd.DataFrame:
        if len(mine) != 1:
            raise RuntimeError("the documents read differently the second time; write them to a table first")
        doc_ids, sizes, digests, many_ids, many_documents = read_own(mine["data"].iloc[0], width)
        ids, documents, frequency = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
        for bucket, data in zip(frame["bucket"], frame["data"]):
            k, d, f = cells.unpack(data, [2, 2])
            ids.append((np.uint64(bucket) << np.uint64(cells.KEY_BITS)) | k)
            documents.append(d)
            frequency.append(f)
        ids, documents, frequency = (np.concatenate(x) for x in (ids, documents, frequency))
        many = documents == MANY
        order = np.argsort(ids[many])
        at = order[np.searchsorted(ids[many], many_ids, sorter=order)] if len(many_ids) else np.empty(0, np.int64)
        ids = np.concatenate([ids[~many], many_ids])
        documents = np.concatenate([documents[~many], many_documents]).astype(np.int64)
        frequency = np.concatenate([frequency[~many], frequency[many][at]])
        shared = np.bincount(documents, minlength=len(doc_ids))
        may = (100 * shared >= 75 * sizes) & (sizes > 0)
        held = may[documents]
        ids, documents, frequency = ids[held], documents[held], frequency[held]
        order = np.lexsort((ids, frequency, documents))
        ids, frequency = ids[order], np.minimum(frequency[order], 255)
        ends = np.cumsum(np.where(may, shared, 0))
        rows = []
        for i, doc_id in enumerate(doc_ids):
            own = slice(ends[i] - shared[i], ends[i])
            rows.append((doc_id, sizes[i], digests[i], *((cells.planes(ids[own], width), frequency[own].astype(np.uint8).tobytes()) if may[i] else (None, None))))
        cells.release()
        return pd.DataFrame(rows, columns=["doc_id", "n", "digest", "ids", "frequency"])

    return run


def step_of(n: int) -> int:
    """The set size's place on a scale of powers of 4/3."""
    return int(math.log(n) / math.log(4 / 3))


def groups_at(step: int, spread: int) -> int:
    """Into how many hash groups frequent shingles are dealt."""
    return max(1, int((4 / 3) ** step / spread))


def prefix_keys(classes: DataFrame, width: int, rare: int, spread: int) -> DataFrame:
    """key, id, n, often: rare shingles of the classes' prefixes, and frequent ones of the extended prefixes."""

    def run(batches):
        for batch in batches:
            for cls, n, ids, frequency in zip(*(batch[c].to_pylist() for c in ("id", "n", "ids", "frequency"))):
                own = cells.from_planes(memoryview(ids), len(frequency), width).view(np.int64)
                often = np.frombuffer(frequency, np.uint8) > rare
                prefix = n - -(-3 * n // 4) + 1 - (n - len(own))  # shingles of one document come first and lead nowhere
                if prefix <= 0:
                    continue
                place = np.arange(len(own))
                taken = (place < prefix) | (often & (place < prefix + groups_at(step_of(n) + 1, spread)))
                k = int(taken.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[taken]), pa.array(np.full(k, cls)), pa.array(np.full(k, n)), pa.array(often[taken])], names=["key", "id", "n", "often"]
                )

    return classes.mapInArrow(run, "key long, id long, n long, often boolean")


def pair_keys(shingles: DataFrame, spread: int) -> DataFrame:
    """key, id, n, component from each class's frequent shingles (``keys``): pairs within a hash group, below zero."""

    def of_step(own: np.ndarray, step: int) -> np.ndarray:
        groups = np.uint64(groups_at(step, spread))
        group = cells.mix(own * FACTORS[3] + np.uint64(step)) % groups
        order = np.lexsort((own, group))
        own, group = own[order], group[order]
        out = []
        for apart in range(1, len(own)):
            low = np.flatnonzero(group[apart:] == group[:-apart])
            if not len(low):
                break
            out.append(cells.mix(own[low] * FACTORS[0] + cells.mix(own[low + apart] * FACTORS[1] + np.uint64(step))) | np.uint64(1 << 63))
        return np.concatenate([*out, np.empty(0, np.uint64)])

    def run(batches):
        for batch in batches:
            for cls, n, component, keys in zip(*(batch[c].to_pylist() for c in ("id", "n", "component", "keys"))):
                own = np.array(keys, np.int64).view(np.uint64)
                found = np.unique(np.concatenate([of_step(own, step_of(n)), of_step(own, step_of(n) + 1)])).view(np.int64)
                k = len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found), pa.array(np.full(k, cls)), pa.array(np.full(k, n)), pa.array(np.full(k, component))], names=["key", "id", "n", "component"]
                )

    return shingles.mapInArrow(run, "key long, id long, n long, component long")


def smallest_hashes(classes: DataFrame, width: int, rounds: int) -> DataFrame:
    """key, id: per class and seed, the smallest hash of its shingles."""

    def run(batches):
        for batch in batches:
            out: list[tuple[int, int]] = []
            for cls, ids in zip(*(batch[c].to_pylist() for c in ("id", "ids"))):
                own = cells.from_planes(memoryview(ids), len(ids) // width, width)
                out += [(int(cells.mix(own ^ FACTORS[r]).min()) >> 1, cls) for r in range(rounds)]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["key", "id"])

    return classes.mapInArrow(run, "key long, id long")


def similar_pairs(sets: list[np.ndarray], n: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int):
    """Pairs (i of left, j of right, i <> j) that link; intersections come from products over 4096 shingles at a time.

    The products are exact in float32; their sums and the comparison are in integers.
    """
    _, token = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    often = np.bincount(token) > 1
    number = np.cumsum(often) - 1
    row, token = row[often[token]], number[token[often[token]]]
    order = np.argsort(token, kind="stable")
    row, token = row[order], token[order]
    common = np.zeros((len(left), len(right)), np.int64)
    for start in range(0, int(often.sum()), 4096):
        lo, hi = np.searchsorted(token, [start, start + 4096])
        part = np.zeros((len(sets), 4096), np.float32)
        part[row[lo:hi], token[lo:hi] - start] = 1
        common += (part[left] @ part[right].T).astype(np.int64)
    common *= 100 + percent
    least = percent * n.astype(np.int64)
    i, j = np.nonzero((common >= least[left][:, None] + least[right][None, :]) & (left[:, None] != right[None, :]))
    return left[i], right[j]


def tile_links(dealt: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """Edges (a, b) that connect all classes that link within a pair of tiles (part, first, second) of ``dealt``."""

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id", ignore_index=True)
        tiles = frame["tile"].to_numpy()
        left, right = np.flatnonzero(tiles == key[1]), np.flatnonzero(tiles == key[2])
        ids = frame["id"].to_numpy()
        if not len(left) or not len(right):
            return pd.DataFrame({"a": ids[:0], "b": ids[:0]})
        sets = [cells.from_planes(memoryview(x), len(x) // width, width) for x in frame["ids"]]
        root = ids[smallest_reachable(len(frame), [similar_pairs(sets, frame["n"].to_numpy(), left, right, percent)])]
        return pd.DataFrame({"a": root, "b": ids})[root != ids]

    sent = dealt.join(classes.select("id", "n", "ids"), "id")
    return sent.groupBy("part", "first", "second").applyInPandas(run, "a long, b long")


def pair_links(pairs: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link."""
    sets = classes.select("id", "n", "ids")
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("ids").alias("ids_a")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("ids").alias("ids_b")), "b"
    )

    def run(batches):
        for batch in batches:
            out = []
            for a, b, n_a, x, n_b, y in zip(*(batch[c].to_pylist() for c in ("a", "b", "n_a", "ids_a", "n_b", "ids_b"))):
                p, q = (cells.from_planes(memoryview(z), len(z) // width, width) for z in (x, y))
                common = len(np.intersect1d(p, q, assume_unique=True))
                if 100 * common >= percent * (n_a + n_b - common):
                    out.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def still_open(rows: DataFrame) -> DataFrame:
    """key, component, many (classes): of keys whose classes are in several components, a row per component."""
    per_component = rows.groupBy("key", "component").agg(F.count(F.lit(1)).alias("many"))
    several = per_component.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    return per_component.join(several, "key").select("key", "component", "many", "low")


def open_links(prefixes: DataFrame, links: DataFrame, classes: DataFrame, width: int, percent: int, spread: int, tile_rows: int, tile_cost: float) -> DataFrame:
    """Links between classes that share a key and that ``links`` leave in different components.

    Components chained by open keys form a cloud. A cloud whose keys have more pairs than its tiles have rows is compared
    tile by tile; in the others each pair that shares a key is verified by itself.
    """
    placed = prefixes.join(components(links), "id", "left").select("key", "id", "n", "often", F.coalesce("component_id", "id").alias("component"))
    open_shingles = still_open(placed).select("key").distinct()
    rows = materialize(placed.join(open_shingles, "key"))
    often = rows.filter("often").groupBy("id", "n", "component").agg(F.collect_list("key").alias("keys"))  # part of one set
    index = materialize(rows.filter("NOT often").select("key", "id", "n", "component").unionByName(pair_keys(often, spread)))
    held = materialize(still_open(index))
    clouds = components(held.select(F.col("low").alias("a"), F.col("component").alias("b"))).select(F.col("id").alias("component"), F.col("component_id").alias("part"))
    many = F.col("many")
    n_pairs = (
        held.groupBy("key", "low").agg(F.sum("many").alias("many"))
        .join(clouds, F.col("low") == F.col("component")).groupBy("part").agg(F.sum(many * (many - 1) / 2).alias("pairs"))
    )
    placed_in = rows.select("id", "component").distinct().join(clouds, "component").select("id", "part")
    sized = (
        placed_in.groupBy("part")
        .agg(F.ceil(F.count(F.lit(1)) / tile_rows).cast("int").alias("tiles"), F.count(F.lit(1)).alias("rows"))
        .join(n_pairs, "part")
        .withColumn("tiled", tile_cost * F.col("rows") * F.col("tiles") <= F.col("pairs"))
        .select("part", "tiles", "tiled")
    )
    members = materialize(placed_in.join(sized, "part"))
    dealt = (
        members.filter("tiled")
        .withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select("part", "id", "tile", F.least("tile", "other").alias("first"), F.greatest("tile", "other").alias("second"))
    )
    single = index.join(members.filter("NOT tiled").select("id"), "id").join(held.select("key").distinct(), "key")
    left, right = (
        single.select(F.col("key").alias(f"key_{s}"), F.col("id").alias(s), F.col("n").alias(f"n_{s}"), F.col("component").alias(f"c_{s}")) for s in "ab"
    )
    in_size = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    across = left.join(right, (F.col("key_a") == F.col("key_b")) & (F.col("c_a") < F.col("c_b")) & in_size).select("a", "b").distinct()
    return tile_links(dealt, classes, width, percent).unionByName(pair_links(across, classes, width, percent))


def similar_documents(
    docs: DataFrame, rare: int = 200, percent: int = 75, rounds: int = 2, spread: int = 8,
    tile_rows: int = 512, tile_cost: float = 1.0,
) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    if percent < 75:
        raise ValueError("prefixes and size bounds are those of 75 % or more")
    if spread < 4:
        raise ValueError("with more groups than a quarter of the set, linked sets need not share enough shingles")
    spark = docs.sparkSession
    ship(spark)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = partitions_for(size / 6, 1e6, spark)
    width = id_width(buckets)
    replies = send(docs, buckets, own=False).groupBy("bucket").applyInPandas(reply, CELL)
    sets = materialize(
        send(docs, buckets, own=True)
        .groupBy("batch")
        .cogroup(replies.groupBy("batch"))
        .applyInPandas(ordered_sets(width), "doc_id long, n long, digest binary, ids binary, frequency binary")
    )
    classes = materialize(
        sets.filter("ids IS NOT NULL")
        .groupBy("n", "digest")
        .agg(F.min("doc_id").alias("id"), F.first("ids").alias("ids"), F.first("frequency").alias("frequency"))
    )
    smallest = smallest_hashes(classes, width, rounds)
    shared = smallest.groupBy("key").agg(F.count(F.lit(1)).alias("many")).filter("many > 1")
    tile = F.pmod(F.xxhash64("id", "key"), F.ceil(F.col("many") / tile_rows)).cast("int")
    blocks = smallest.join(shared, "key").select(F.col("key").alias("part"), "id", tile.alias("tile"))
    links = materialize(tile_links(blocks.withColumns({"first": F.col("tile"), "second": F.col("tile")}), classes, width, percent))
    prefixes = prefix_keys(classes, width, rare, spread)
    links = links.unionByName(open_links(prefixes, links, classes, width, percent, spread, tile_rows, tile_cost))
    found = components(links)
    class_of = classes.select("n", "digest", "id").join(found, "id", "left").select(
        F.col("n"), "digest", F.coalesce("component_id", "id").alias("component_id")
    )
    joined = sets.select("doc_id", "n", "digest").join(class_of, ["n", "digest"], "left")
    out = joined.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    nameless = docs.filter("doc_id IS NULL").select(F.col("doc_id").cast("long"), n_shingles("text").alias("n_shingles"))
    return out.unionByName(nameless.withColumn("component_id", F.lit(None).cast("long")))
