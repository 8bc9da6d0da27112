"""Suffix-array dedup (operator 4): a sparse suffix array, sorted by hash-compared merging.

Every byte is removed that a string of ``length`` bytes covers which also starts earlier in the corpus (smaller doc_id, or
the same document further left). Only suffixes that can begin such a string are sorted:

1. Anchors. Of every run of ``length - grams + 1`` neighbouring ``grams``-byte strings the one with the smallest hash is
   an anchor (the rightmost at a tie), so equal windows of ``length`` bytes have their anchor at the same place; each
   window belongs to one anchor. Prefix polynomial hashes give the hash of any stretch in constant time.
2. Batches of documents send each anchor's hash, the hash of the stretch that its windows cover (its context) and its
   first document, packed into one cell per hash bucket. The bucket replies with the anchors that occur again: all
   windows of a context but those of its first occurrence are repeats, and where an anchor has several contexts, their
   first occurrences are compared. What a batch holds many times it sends once.
3. Suffix sort. Windows at neighbouring offsets to their anchor share their inner bytes, their core. Contexts of an anchor
   that have no core in common with another have no window in common either, and most that meet by a short anchor have
   none: a large corpus repeats any anchor by chance. The others' suffixes at the anchor are sorted by a bottom-up
   mergesort. A comparison finds the
   common extension by binary search over the prefix hashes, so it takes a logarithmic number of steps. Neighbours'
   common extensions give those of any two to the right, another binary search those to the left; together they are
   the stretch that two contexts share. Where an anchor has more than ``SMALL`` such contexts, their windows around common
   cores are sorted instead, and neighbours with a common extension of ``length`` bytes are one string. Then the bytes of
   the contexts compared here are compared themselves: among them a collision of hashes is an error, never a removal.
   The contexts of anchors with very many meet by anchor and core instead, each in ``HALVES`` parts; cores with very many
   are split by salts, of which the distinct strings meet by hash (of 128 bits) afterwards.

   Not verified by bytes are these strings of salted cores, and later occurrences of a context (step 2; exact copies, most
   of what is removed): they are taken as equal to the first by a 64-bit hash of the context, over mixed numbers of eight
   bytes each, under the anchor's bucket and 40-bit key. A collision there would remove bytes that aren't repeated.
4. The removed bytes of a document are the union of its repeated windows.

A retry must find the documents as before, as with a written table; a batch whose replies don't find it is an error.

Null and empty texts have no bytes; rows with a null doc_id are left as they are and count for no one else; rows that
repeat a doc_id start at the same place, so neither is earlier than the other; ties are as the definition says; extra
columns are ignored (``remove_repeats`` passes them through).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.llm import cells
from blotter.llm.common import materialize, partitions_for, ship

PLACE_BITS = np.uint64(21)
PLACES = np.uint64((1 << 21) - 1)
SMALL = 32  # contexts of an anchor that are compared by the suffix array of their anchors
CORES, HALVES = 9, 2  # cores by which contexts of an anchor are told apart, and by which those of very frequent anchors meet
TOGETHER = 1 << 15  # bytes of short texts of which the anchors are found together
AT_ONCE = 1 << 20  # bytes of contexts that are sorted together (more only where one anchor has more), or compared byte by byte


class Anchors:
    """A text's anchors: positions, hashes, contexts, and the first and last window start that belongs to each.

    Long texts go in chunks of windows, as a window's anchor depends on its own bytes only; an anchor on whose windows
    two chunks meet counts twice, once for the windows in each.
    """

    def __init__(self, data: np.ndarray, length: int, grams: int, chunk: int = 1 << 20):
        parts = [
            self.of(data[a : a + chunk + length - 1], length, grams, a) for a in range(0, len(data) - length + 1, chunk)
        ]
        if not parts:
            self.at = self.first = self.last = np.empty(0, np.int64)
            self.hashes = self.contexts = np.empty(0, np.uint64)
        else:
            self.at, self.first, self.last, self.hashes, self.contexts = (
                parts[0] if len(parts) == 1 else [np.concatenate(x) for x in zip(*parts)]
            )

    @staticmethod
    def of(data: np.ndarray, length: int, grams: int, base: int, windows: np.ndarray | None = None):
        """Of all windows, or of those that start at ``windows``, of which no two from different texts overlap."""
        keys = gram_keys(data, grams)
        # hash above, place below and reversed: one minimum finds the smallest hash, of equals the rightmost
        low = keys >> PLACE_BITS
        low <<= PLACE_BITS
        low |= PLACES - np.arange(len(keys), dtype=np.uint64)
        width, reach = length - grams + 1, 1
        while reach < width:  # minima of runs of growing width
            step = min(reach, width - reach)
            low = np.minimum(low[:-step], low[step:])
            reach += step
        if windows is not None:
            low = low[windows]
        new = np.ones(len(low), bool)
        np.not_equal(low[1:], low[:-1], out=new[1:])
        first = np.flatnonzero(new)
        at, last = (PLACES - (low[first] & PLACES)).astype(np.int64), np.append(first[1:], len(low)) - 1
        if windows is not None:
            first, last = windows[first], windows[last]
        shape = (at - first).astype(np.uint64) * np.uint64(1 << 20) + (last - first).astype(np.uint64)
        contexts = cells.mix(cells.of_long(data, length).of(first, last + length) + cells.mix(shape)) | np.uint64(1)
        return at + base, first + base, last + base, keys[at], contexts


def gram_keys(data: np.ndarray, grams: int) -> np.ndarray:
    """A mixed hash of every string of ``grams`` bytes, as of a polynomial over its numbers of eight bytes."""
    n = len(data) - grams + 1
    if grams < 8:
        start = np.arange(n)
        return cells.mix(cells.Rolling(data).of(start, start + grams))
    eight = np.ndarray((len(data) - 7,), "<u8", buffer=np.ascontiguousarray(data), strides=(1,)).copy()
    at = sorted({*range(0, grams - 7, 8), grams - 8})
    powers = cells.geometric(cells.Rolling.BASE, len(at))
    keys = eight[:n].copy()
    for a, power in zip(at[1:], powers[1:]):
        keys += eight[a : a + n] * power
    return cells.mix(keys)


def anchors_of(texts: list[np.ndarray], length: int, grams: int) -> list[np.ndarray]:
    """The texts' numbers and their anchors' columns. Short texts go together, as a step's calls cost more than their bytes."""
    sizes = np.array([len(d) for d in texts], np.int64)
    found = [(*np.empty((4, 0), np.int64), *np.empty((2, 0), np.uint64))]
    for a, b in stretches(sizes, TOGETHER):
        if b - a == 1:
            one = Anchors(texts[a], length, grams)
            found.append((np.full(len(one.at), a), one.at, one.first, one.last, one.hashes, one.contexts))
            continue
        base, each = np.cumsum(sizes[a:b]) - sizes[a:b], np.maximum(sizes[a:b] - length + 1, 0)
        windows = np.arange(each.sum()) + np.repeat(base - (np.cumsum(each) - each), each)
        if len(windows):
            at, first, last, hashes, contexts = Anchors.of(np.concatenate(texts[a:b]), length, grams, 0, windows)
            own = np.searchsorted(base, at, side="right") - 1
            found.append((own + a, at - base[own], first - base[own], last - base[own], hashes, contexts))
    return [np.concatenate(c) for c in zip(*found)]


def document_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode(), np.uint8)


class Batch:
    """All anchors of some documents, by (bucket, key), documents and places in order within a key."""

    def __init__(self, doc_ids: list[int], texts: list[str | None], length: int, grams: int, buckets: int):
        order = sorted(range(len(doc_ids)), key=lambda i: doc_ids[i])
        self.doc_ids = np.array([doc_ids[i] for i in order], np.int64)
        self.rows = order
        self.data = [document_bytes(texts[i]) for i in order]
        self.document, self.at, self.first, self.last, hashes, self.contexts = anchors_of(self.data, length, grams)
        ids = (cells.bucket_of(hashes, buckets).astype(np.uint64) << np.uint64(cells.KEY_BITS)) | (hashes & cells.KEY_MASK)
        by_id = np.lexsort((self.contexts, ids))  # documents and places stay in order within an (anchor, context)
        self.ids = ids[by_id]
        for name in ("document", "at", "first", "last", "contexts"):
            setattr(self, name, getattr(self, name)[by_id])
        new = np.ones(len(ids), bool)
        new[1:] = (np.diff(self.ids) != 0) | (np.diff(self.contexts) != 0)
        self.start = np.flatnonzero(new)
        self.count = np.diff(np.append(self.start, len(ids)))

    def buckets(self) -> tuple[np.ndarray, np.ndarray]:
        """Buckets present and the bounds of their entries (anchor, context)."""
        present, starts = np.unique((self.ids[self.start] >> np.uint64(cells.KEY_BITS)).astype(np.int64), return_index=True)
        return present, np.append(starts, len(self.start))

    def cells(self):
        keys, contexts = self.ids[self.start] & cells.KEY_MASK, self.contexts[self.start]
        documents = self.doc_ids[self.document[self.start]].view(np.uint64)
        present, bounds = self.buckets()
        for b, lo, hi in zip(present, bounds, bounds[1:]):
            yield int(b), cells.pack(
                keys[lo:hi], [(contexts[lo:hi], 8), (documents[lo:hi], 8), (np.minimum(self.count[lo:hi], 255), 1)]
            )


CELL = "batch long, bucket int, data binary"
CELL_SCHEMA = pa.schema([("batch", pa.int64()), ("bucket", pa.int32()), ("data", pa.binary())])
BATCH_ROWS, BATCH_BYTES = 4096, 4 << 20


def send_anchors(docs: DataFrame, length: int, grams: int, buckets: int) -> DataFrame:
    def run(batches):
        partition, number = TaskContext.get().partitionId(), 0
        for arrow in batches:
            for part in cells.slices(arrow, BATCH_ROWS, BATCH_BYTES):
                doc_ids = part["doc_id"].to_pylist()
                name = cells.batch_name(partition, number, doc_ids)
                number += 1
                rows = list(Batch(doc_ids, part["text"].to_pylist(), length, grams, buckets).cells())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(rows), pa.int64()), pa.array([b for b, _ in rows], pa.int32()), pa.array([d for _, d in rows], pa.binary())],
                    schema=CELL_SCHEMA,
                )
                cells.release()

    return docs.mapInArrow(run, CELL)


def send_documents(docs: DataFrame) -> DataFrame:
    """batch, place and the documents' columns, under the same batch names (so all columns go both times)."""

    def run(batches):
        partition, number = TaskContext.get().partitionId(), 0
        for arrow in batches:
            for part in cells.slices(arrow, BATCH_ROWS, BATCH_BYTES):
                name = cells.batch_name(partition, number, part["doc_id"].to_pylist())
                number += 1
                marks = [pa.array(np.full(len(part), name)), pa.array(np.arange(len(part), dtype=np.int32))]
                yield pa.RecordBatch.from_arrays([*marks, *part.columns], names=["__batch", "__place", *part.schema.names])
            cells.release()

    schema = T.StructType([T.StructField("__batch", T.LongType()), T.StructField("__place", T.IntegerType()), *docs.schema.fields])
    return docs.mapInArrow(run, schema)


def reply(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    """To each batch, its entries whose anchor occurs again: the anchor's contexts, the context's first document."""
    parts = [cells.unpack(d, [8, 8, 1]) for d in frame["data"]]
    keys, contexts, documents, counts = (np.concatenate(c) for c in zip(*parts))
    documents = documents.view(np.int64)
    order = np.lexsort((contexts, keys))
    k, c = keys[order], contexts[order]
    new_key, new = np.ones(len(k), bool), np.ones(len(k), bool)
    new_key[1:] = np.diff(k) != 0
    new[1:] = new_key[1:] | (np.diff(c) != 0)
    of_key, of_context = np.cumsum(new_key) - 1, np.cumsum(new) - 1
    occurrences = np.bincount(of_key, weights=counts[order])
    n_contexts = np.bincount(of_key[new])
    first = np.minimum.reduceat(documents[order], np.flatnonzero(new))
    again, told, earliest = (np.empty(len(k), t) for t in (bool, np.int64, np.int64))
    again[order], told[order], earliest[order] = (occurrences > 1)[of_key], n_contexts[of_key], first[of_context]
    out, at = [], 0
    for batch, part in zip(frame["batch"], parts):
        entry = np.flatnonzero(again[at : at + len(part[0])])
        if len(entry):
            own = at + entry
            out.append((batch, key[0], cells.pack(entry.astype(np.uint64), [(told[own], 4), (earliest[own].view(np.uint64), 8)])))
        at += len(part[0])
    cells.release()
    return pd.DataFrame(out, columns=["batch", "bucket", "data"])


SPANS = "kind int, batch long, place int, doc_id long, start long, stop long, part long, text binary, before int"


def settle(length: int, grams: int, buckets: int, parts: int, per_salt: int):
    """Per batch: repeated windows that are certain (kind 0), and contexts to be compared (kind 1, dealt by part)."""

    def run(key: tuple, frame: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        if not len(frame):
            raise RuntimeError("the documents read differently the second time; write them to a table first")
        frame = frame.sort_values("place", ignore_index=True)
        batch = Batch(frame["doc_id"].tolist(), frame["text"].tolist(), length, grams, buckets)
        present, bounds = batch.buckets()
        base = dict(zip(present.tolist(), bounds.tolist()))
        n_contexts, first = np.zeros(len(batch.start), np.int64), np.zeros(len(batch.start), np.int64)
        for bucket, data in zip(told["bucket"], told["data"]):
            entry, n, f = cells.unpack(data, [4, 8])
            entry = entry.astype(np.int64) + base[bucket]
            n_contexts[entry], first[entry] = n, f.view(np.int64)
        entry = np.repeat(np.arange(len(batch.start)), batch.count)
        own = np.flatnonzero(n_contexts[entry] > 0)  # anchors that occur again
        entry = entry[own]
        documents, head = batch.document[own], batch.start[entry]
        # the context's first occurrence; rows that repeat its document start where it starts
        kept = (batch.doc_ids[documents] == first[entry]) & (documents == batch.document[head]) & (batch.at[own] == batch.at[head])
        kept |= (batch.doc_ids[documents] == first[entry]) & (batch.doc_ids[batch.document[head]] == first[entry]) & (batch.at[own] == batch.at[head])
        place = np.array(batch.rows, np.int64)[documents]
        a, b = place[~kept], batch.first[own[~kept]]
        spans = touching(a, b, batch.last[own[~kept]] + length)
        sure = pd.DataFrame({
            "kind": 0, "batch": key[0], "place": spans[0], "doc_id": frame["doc_id"].to_numpy()[spans[0]], "start": spans[1], "stop": spans[2],
            "part": 0, "text": None, "before": 0,
        })
        some = kept & (n_contexts[entry] > 1)
        rows, entry, documents = own[some], entry[some], documents[some]
        part = (cells.mix(batch.ids[rows]) % np.uint64(parts)).astype(np.int64)
        unsure = pd.DataFrame({
            "kind": 1, "batch": key[0], "place": place[some], "doc_id": batch.doc_ids[documents],
            "start": batch.first[rows], "stop": batch.last[rows] + length, "part": part,
            "text": [batch.data[d][a:b].tobytes() for d, a, b in zip(documents, batch.first[rows], batch.last[rows] + length)],
            "before": batch.at[rows] - batch.first[rows],
        })
        many = n_contexts[entry] > per_salt
        cut = by_core(unsure[many], batch.ids[rows[many]], length, grams)
        cells.release()
        return pd.concat([sure, unsure[~many], *cut], ignore_index=True)

    return run


def offsets(length: int, grams: int, cores: int) -> list[tuple[int, int]]:
    """Ranges (least, most) of a window's offset to its anchor. The windows of a range share ``length`` bytes less its width."""
    step = -(-(length - grams + 1) // cores)
    return [(a, min(a + step - 1, length - grams)) for a in range(0, length - grams + 1, step)]


class Cores:
    """Hashes of the bytes that a context's windows of neighbouring offsets share; equal windows have equal ones."""

    def __init__(self, texts: np.ndarray, before: np.ndarray, sizes: np.ndarray, length: int):
        self.at, self.length = np.cumsum(sizes) - sizes + before, length
        self.least, self.most = before - (sizes - length), before
        self.rolling = cells.Rolling(np.frombuffer(b"".join(texts), np.uint8))

    def of(self, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
        """(contexts that have windows in the range of offsets, their hashes)."""
        own = np.flatnonzero((self.least <= most) & (self.most >= least))
        at = self.at[own]
        return own, self.rolling.of(at - least, at - most + self.length)


def by_core(frame: pd.DataFrame, ids: np.ndarray, length: int, grams: int):
    """Contexts cut to the windows of each range of offsets (kind 2), dealt by anchor and core."""
    sizes, before = (frame["stop"] - frame["start"]).to_numpy(), frame["before"].to_numpy()
    cores = Cores(frame["text"].to_numpy(), before, sizes, length)
    for least, most in offsets(length, grams, HALVES):
        own, hashes = cores.of(least, most)
        left = np.maximum(cores.most[own] - most, 0)
        right = np.maximum(least - cores.least[own], 0)
        cut = frame.iloc[own]
        yield cut.assign(
            kind=2, start=cut["start"] + left, stop=cut["stop"] - right, before=cut["before"] - left,
            part=cells.mix(hashes + cells.mix(ids[own] + np.uint64(least))).view(np.int64),
            text=[t[a:b] for t, a, b in zip(cut["text"], left, sizes[own] - right)],
        )


def touching(owner: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans (owner, start, stop) with those of an owner that touch or overlap made one."""
    order = np.lexsort((start, owner))
    owner, start, stop = owner[order], start[order], stop[order]
    if not len(owner):
        return owner, start, stop
    # an owner's spans lie above those of the owner before
    lift = owner * np.int64(1 << 40)
    reach = np.maximum.accumulate(stop + lift)
    edge = np.flatnonzero(np.append(True, (start + lift)[1:] > reach[:-1]))
    return owner[edge], start[edge], (reach - lift)[np.append(edge[1:], len(owner)) - 1]


class Suffixes:
    """Suffixes of a byte string, compared on their first ``limit`` bytes."""

    def __init__(self, data: np.ndarray, limit: int):
        self.data, self.limit = data, limit
        self.rolling = cells.Rolling(data)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common extensions of suffixes, by binary search over the prefix hashes."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.limit, np.int64)
        while (open_ := low < high).any():
            mid = (low + high + 1) // 2
            same = self.rolling.of(a, a + mid) == self.rolling.of(b, b + mid)
            low, high = np.where(open_ & same, mid, low), np.where(open_ & ~same, mid - 1, high)
        return low

    def common_before(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Common bytes just before two places, ``most`` at most."""
        low, high = np.zeros(len(a), np.int64), most.copy()
        while (open_ := low < high).any():
            mid = (low + high + 1) // 2
            same = self.rolling.of(a - mid, a) == self.rolling.of(b - mid, b)
            low, high = np.where(open_ & same, mid, low), np.where(open_ & ~same, mid - 1, high)
        return low

    def precedes(self, a: np.ndarray, b: np.ndarray, at_tie: np.ndarray) -> np.ndarray:
        n = self.common(a, b)
        last = len(self.data) - 1
        x, y = self.data[np.minimum(a + n, last)], self.data[np.minimum(b + n, last)]
        return np.where(n >= self.limit, at_tie, x < y)

    def sort(self, start: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Order of the suffixes by (segment, suffix, place in ``start``); ``segment`` must be sorted.

        A bottom-up mergesort of all segments at once: each suffix finds its rank in the sibling run by binary search.
        """
        n = len(start)
        order = np.arange(n)
        first = np.searchsorted(segment, segment, side="left")
        size = np.searchsorted(segment, segment, side="right") - first
        run = 1
        while run < (size.max() if n else 0):
            live = np.flatnonzero(size > run)  # positions in segments that aren't sorted yet
            offset = live - first[live]
            number = offset // run
            sibling = first[live] + (number ^ 1) * run
            end = first[live] + size[live]
            low = np.minimum(sibling, end)
            high = np.minimum(sibling + run, end)
            base, left = low.copy(), number % 2 == 0
            mine = start[order[live]]
            while (open_ := low < high).any():
                mid = (low + high) // 2
                k = np.flatnonzero(open_)
                other = start[order[mid[k]]]
                # in the left run an equal suffix comes before those of the right run
                before = self.precedes(other, mine[k], ~left[k])
                low[k] = np.where(before, mid[k] + 1, low[k])
                high[k] = np.where(before, high[k], mid[k])
            target = first[live] + (number // 2) * 2 * run + offset % run + (low - base)
            merged = order.copy()
            merged[target] = order[live]
            order = merged
            run *= 2
        return order


def windows(frame: pd.DataFrame, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all contexts, window starts in them, the window's row, its offset to the anchor)."""
    sizes = np.array([len(t) for t in frame["text"]], np.int64)
    data = np.frombuffer(b"".join(frame["text"]), np.uint8)
    base = np.cumsum(sizes) - sizes
    each = sizes - length + 1
    row = np.repeat(np.arange(len(frame)), each)
    within = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
    return data, base[row] + within, row, frame["before"].to_numpy()[row] - within


def stretches(sizes: np.ndarray, most: int, may_cut: np.ndarray | None = None):
    """Bounds of consecutive stretches of about ``most`` bytes, cut only before items that may be cut off."""
    reach, at = np.cumsum(sizes), 0
    cuts = np.arange(len(sizes)) if may_cut is None else np.flatnonzero(may_cut)
    while at < len(sizes):
        full = np.searchsorted(reach, reach[at] - sizes[at] + most, side="right")  # the first item beyond
        k = np.searchsorted(cuts, full, side="right") - 1
        if k < 0 or cuts[k] <= at:
            k = np.searchsorted(cuts, at, side="right")
        end = len(sizes) if full >= len(sizes) or k >= len(cuts) else int(cuts[k])
        yield at, end
        at = end


def anchor_hashes(texts: pd.Series, before: np.ndarray, sizes: np.ndarray, grams: int) -> np.ndarray:
    out = [np.empty(0, np.uint64)]
    for a, b in stretches(sizes, AT_ONCE):
        at = np.cumsum(sizes[a:b]) - sizes[a:b] + before[a:b]
        out.append(cells.Rolling(np.frombuffer(b"".join(texts[a:b]), np.uint8)).of(at, at + grams))
    return np.concatenate(out)


def common_cores(texts: np.ndarray, before: np.ndarray, sizes: np.ndarray, group: np.ndarray, length: int, grams: int) -> np.ndarray:
    """Per range of offsets and context, whether another context of its anchor has the same core; others have no equal windows."""
    ranges = offsets(length, grams, CORES)
    out = np.zeros((len(ranges), len(sizes)), bool)
    rows = np.argsort(group, kind="stable")
    for a, b in stretches(sizes[rows], AT_ONCE, np.diff(group[rows], prepend=-1) != 0):
        rest = rows[a:b]
        cores, anchor = Cores(texts[rest], before[rest], sizes[rest], length), cells.mix(group[rest].astype(np.uint64))
        for k, (least, most) in enumerate(ranges):
            own, hashes = cores.of(least, most)
            hashes += anchor[own]
            order = np.argsort(hashes)
            twin = np.flatnonzero(np.diff(hashes[order]) == 0)
            out[k, rest[own[order[twin]]]] = out[k, rest[own[order[twin + 1]]]] = True
    return out


def compare(length: int, grams: int):
    """The contexts of one part: repeated windows (kind 0); of salted cores also the distinct strings (kind 3).

    Anchors don't meet, so a part goes in stretches of whole anchors: the hashes and sorted windows of one are held at a time.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "start", "batch", "place"], ignore_index=True)
        sizes, before = np.array([len(t) for t in frame["text"]], np.int64), frame["before"].to_numpy()
        _, group = np.unique(anchor_hashes(frame["text"], before, sizes, grams), return_inverse=True)
        common = common_cores(frame["text"].to_numpy(), before, sizes, group, length, grams)
        salted, some = frame["kind"].to_numpy() == 2, common.any(axis=0)
        small = (np.bincount(group, weights=some)[group] <= SMALL) & ~salted
        out = [span_rows(frame, *np.empty((3, 0), np.int64))]
        for few in (True, False):
            rows = np.flatnonzero((some | salted) & (small == few))
            rows = rows[np.argsort(group[rows], kind="stable")]  # within an anchor, documents and places stay in order
            for a, b in stretches(sizes[rows], AT_ONCE, np.diff(group[rows], prepend=-1) != 0):
                own = frame.iloc[rows[a:b]].reset_index(drop=True)
                out += [extended(own, group[rows[a:b]], length)] if few else sorted_windows(own, common[:, rows[a:b]], length, grams)
        cells.release()
        return pd.concat(out, ignore_index=True)

    return run


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> None:
    """Verifies that the stretches found equal by hash are equal."""
    for c, d in stretches(sizes, AT_ONCE):
        n = sizes[c:d]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        if (data[np.repeat(a[c:d], n) + within] != data[np.repeat(b[c:d], n) + within]).any():
            raise RuntimeError("two different strings have the same hash")


def extended(frame: pd.DataFrame, group: np.ndarray, length: int) -> pd.DataFrame:
    """Repeated stretches among few contexts of an anchor.

    The suffixes at the anchors are sorted; two of them agree to the right as far as the least common extension of
    neighbours between them, and to the left as far as a binary search over the prefix hashes tells.
    """
    sizes = np.array([len(t) for t in frame["text"]], np.int64)
    data = np.concatenate([np.frombuffer(b"".join(frame["text"]), np.uint8), np.zeros(length, np.uint8)])
    left = frame["before"].to_numpy()
    base = np.cumsum(sizes) - sizes
    order = np.lexsort((np.arange(len(frame)), group))
    suffixes = Suffixes(data, length)
    order = order[suffixes.sort((base + left)[order], group[order])]
    group, at, left, right = group[order], (base + left)[order], left[order], (sizes - left)[order]
    doc_id, begin = frame["doc_id"].to_numpy()[order], frame["start"].to_numpy()[order] + left
    reach = np.full(len(order), length, np.int64)  # common extension of i and i + step to the right
    neighbour = np.append(suffixes.common(at[:-1], at[1:]), 0)
    row, start, stop = [], [], []
    for step in range(1, SMALL):
        i = np.flatnonzero(group[: len(group) - step] == group[step:])
        if not len(i):
            break
        reach[i] = np.minimum(reach[i], neighbour[i + step - 1])
        j = i + step
        ahead = np.minimum(reach[i], np.minimum(right[i], right[j]))
        most = np.minimum(left[i], left[j])
        may = (ahead + most >= length) & ((doc_id[i] != doc_id[j]) | (begin[i] != begin[j]))
        i, j, ahead, most = i[may], j[may], ahead[may], most[may]
        back = suffixes.common_before(at[i], at[j], most)
        hit = back + ahead >= length
        i, j, ahead, back = i[hit], j[hit], ahead[hit], back[hit]
        same_bytes(data, at[i] - back, at[j] - back, back + ahead)
        later = np.where((doc_id[i] > doc_id[j]) | ((doc_id[i] == doc_id[j]) & (begin[i] > begin[j])), i, j)
        row.append(order[later])
        start.append(begin[later] - back)
        stop.append(begin[later] + ahead)
    row, start, stop = (np.concatenate([np.empty(0, np.int64), *x]) for x in (row, start, stop))
    return span_rows(frame, *touching(row, start, stop))


def sorted_windows(frame: pd.DataFrame, common: np.ndarray, length: int, grams: int) -> list[pd.DataFrame]:
    """Repeated windows among many contexts of an anchor: all their windows around common cores are sorted as suffixes."""
    data, start, row, offset = windows(frame, length)
    suffixes = Suffixes(data, length)
    base, salted = np.cumsum([0, *map(len, frame["text"])])[:-1], frame["kind"].to_numpy() == 2
    range_of = np.repeat(np.arange(len(common)), [b - a + 1 for a, b in offsets(length, grams, CORES)])
    may = common[range_of[offset], row]
    alone = np.flatnonzero(~may & salted[row])  # distinct as they are
    alone_start, alone_row = start[alone], row[alone]
    start, row, offset = start[may], row[may], offset[may]
    anchor = suffixes.rolling.of(start + offset, start + offset + grams)
    order = np.lexsort((np.arange(len(row)), offset, anchor))
    start, row, offset, anchor = start[order], row[order], offset[order], anchor[order]
    segment = np.cumsum(np.append(False, (np.diff(anchor) != 0) | (np.diff(offset) != 0)))
    order = suffixes.sort(start, segment)
    start, row, segment = start[order], row[order], segment[order]
    same = np.zeros(len(start), bool)
    same[1:] = segment[1:] == segment[:-1]
    twin = np.flatnonzero(same)
    same[twin] = suffixes.common(start[twin], start[twin - 1]) >= length
    twin = np.flatnonzero(same)
    same_bytes(data, start[twin], start[twin - 1], np.full(len(twin), length))
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(same))))
    doc_id, begin = frame["doc_id"].to_numpy()[row], frame["start"].to_numpy()[row] + start - base[row]
    # within a string's suffixes the sort keeps the order of documents and places
    repeat = same & ((doc_id != doc_id[head]) | (begin != begin[head]))
    out = [span_rows(frame, *touching(row[repeat], begin[repeat], begin[repeat] + length))]
    distinct = ~repeat & salted[row]
    start, row = np.append(start[distinct], alone_start), np.append(row[distinct], alone_row)
    if len(row):
        begin = frame["start"].to_numpy()[row] + start - base[row]
        own = span_rows(frame, row, begin, begin + length)
        first, second = (h.of(start, start + length) for h in (suffixes.rolling, cells.of_long(data, length)))
        out.append(own.assign(kind=3, text=[x.tobytes() for x in np.stack([first, second], axis=1)]))
    return out


def span_rows(frame: pd.DataFrame, row: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pd.DataFrame:
    batch, place, doc_id = (frame[name].to_numpy()[row] for name in ("batch", "place", "doc_id"))
    return pd.DataFrame({
        "kind": 0, "batch": batch, "place": place, "doc_id": doc_id, "start": start, "stop": stop, "part": 0, "text": None, "before": 0,
    })


def spans_of(docs: DataFrame, length: int, grams: int, per_salt: int) -> DataFrame:
    """batch, place, start, stop of all repeated windows (they may overlap)."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets, parts = partitions_for(size / 35, 1e6, spark), partitions_for(size, 8e6, spark)
    replies = send_anchors(docs, length, grams, buckets).groupBy("bucket").applyInPandas(reply, CELL)
    settled = materialize(
        send_documents(docs)
        .select(F.col("__batch").alias("batch"), F.col("__place").alias("place"), "doc_id", "text")
        .groupBy("batch")
        .cogroup(replies.groupBy("batch"))
        .applyInPandas(settle(length, grams, buckets, parts, per_salt), SPANS)
    )
    compared = materialize(contexts_by_part(settled, parts, per_salt).groupBy("part").applyInPandas(compare(length, grams), SPANS))
    first = F.min(F.struct("doc_id", "start")).alias("first")
    distinct = compared.filter("kind = 3")
    later = (
        distinct.join(distinct.groupBy("text").agg(first), "text")
        .filter("doc_id <> first.doc_id OR start <> first.start")
        .select(*SPAN_COLUMNS)
    )
    return settled.filter("kind = 0").select(*SPAN_COLUMNS).unionByName(compared.filter("kind = 0").select(*SPAN_COLUMNS)).unionByName(later)


def contexts_by_part(settled: DataFrame, parts: int, per_salt: int) -> DataFrame:
    """All contexts that may share windows; those dealt by core (kind 2) go where no other has theirs, and are salted where very many do."""
    many = settled.filter("kind = 2")
    salts = F.ceil(F.count(F.lit(1)) / F.lit(per_salt)).alias("salts")
    met = many.groupBy(F.col("part").alias("core")).agg(F.count(F.lit(1)).alias("n"), salts).filter("n > 1")
    salt = F.pmod(F.xxhash64("doc_id"), F.col("salts"))
    dealt = many.join(met, F.col("part") == F.col("core")).select(
        *(F.col(c) for c in settled.columns if c not in ("kind", "part")),
        F.when(F.col("salts") > 1, 2).otherwise(1).alias("kind"),
        F.pmod(F.xxhash64("core", salt), F.lit(parts)).cast("long").alias("part"),
    )
    return settled.filter("kind = 1").unionByName(dealt)


SPAN_COLUMNS = ("batch", "place", "start", "stop")


def merged_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs covered by the spans (start, stop)."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def per_document(docs: DataFrame, length: int, grams: int, per_salt: int, result, schema: T.StructType) -> DataFrame:
    """``result(table, removed spans per row)`` of every batch of documents, a table of ``schema``."""
    spans = spans_of(docs, length, grams, per_salt)
    packed = spans.groupBy("batch", "place").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))  # of one document

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            raise RuntimeError("the documents read differently the second time; write them to a table first")
        told = dict(zip(right["place"].to_pylist(), right["spans"].to_pylist()))
        own = [told.get(p, ()) for p in left["__place"].to_pylist()]
        cells.release()
        return result(left, [merged_spans([(s["start"], s["stop"]) for s in x]) for x in own])

    return send_documents(docs).groupBy("__batch").cogroup(packed.groupBy("batch")).applyInArrow(run, schema)


def kept_bytes(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    ends = [0, *[b for _, b in runs]]
    starts = [*[a for a, _ in runs], len(data)]
    return b"".join(data[a:b] for a, b in zip(ends, starts))


def removal_digests(docs: DataFrame, length: int = 100, grams: int = 24, per_salt: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    ship(docs.sparkSession)

    def result(documents: pa.Table, removed: list) -> pa.Table:
        rows = []
        for doc_id, text, runs in zip(documents["doc_id"].to_pylist(), documents["text"].to_pylist(), removed):
            data = (text or "").encode()
            told = hashlib.sha256(kept_bytes(data, runs)).hexdigest()
            rows.append((doc_id, len(data), sum(b - a for a, b in runs), len(runs), told))
        return pa.table(dict(zip(names, zip(*rows))))

    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    schema = T.StructType([T.StructField(n, T.LongType()) for n in names[:4]] + [T.StructField(names[4], T.StringType())])
    named = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), "text")
    text = F.coalesce(F.col("text"), F.lit(""))
    nameless = docs.filter("doc_id IS NULL").select(
        F.col("doc_id").cast("long"), F.octet_length(text).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2(text, 256).alias("kept_sha256"),
    )
    return per_document(named, length, grams, per_salt, result, schema).unionByName(nameless)


def remove_repeats(docs: DataFrame, length: int = 100, grams: int = 24, per_salt: int = 4096) -> DataFrame:
    """The rows with all their columns, ``text`` without the repeated bytes.

    A character of which bytes were removed goes as a whole; a text of which nothing was removed stays as it is.
    """
    ship(docs.sparkSession)

    def result(documents: pa.Table, removed: list) -> pa.Table:
        texts = [
            kept_bytes(t.encode(), runs).decode("utf-8", "ignore") if runs else t for t, runs in zip(documents["text"].to_pylist(), removed)
        ]
        own = documents.set_column(documents.schema.get_field_index("text"), "text", pa.array(texts, documents.schema.field("text").type))
        return own.drop_columns(["__batch", "__place"])

    named = docs.filter("doc_id IS NOT NULL")
    return per_document(named, length, grams, per_salt, result, named.schema).unionByName(docs.filter("doc_id IS NULL"))
