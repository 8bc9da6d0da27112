"""Hard-negative mining (operator 12): L2AP-style threshold joins of anchors with all rows, exact in whole numbers.

Components become floor(256 * x); the score of a row is its inner product with the anchor, higher first, ties by smaller
vec_id. The anchor's positives are its best other rows of the same label. A positive with score p opens a window: rows of
other labels with ``low * p <= 100 * score <= high * p``; the best of them are the hard negatives.

Both searches are threshold joins of a block of anchors with a group of rows, in strips (``Strip``). Dimensions stand by
falling energy. At a threshold, a row is indexed only in the dimensions up to where the norm of its rest, times the
largest such norm of the anchors, falls below the threshold; the omitted ones can't make a score of that size alone, and a
row covered wholly is not looked at. Partial scores accumulate along the indexed dimensions; a pair whose partial score
plus the product of the remaining norms stays below the threshold is pruned, the others are scored in full, once. An
anchor's threshold starts at what a strip could reach and falls until all its windows are full: no row still unseen can
enter them. What earlier strips found lifts the thresholds of later ones.

A task holds one block of anchors and one group of rows and returns at most ``want`` rows per window, whatever the hits;
the best of all tasks follow by rank, limited in each task before the shuffle. For positives, anchors meet only rows of
their label. For negatives a group of rows goes to a block of anchors only if its norms can reach the block's lowest
window. A hot label or a vector that very many rows share fills more groups, not larger ones.

Rows with a null label, null or empty vector, or null or non-finite components take no part, nor do those with a null
vec_id. Rows that repeat a vec_id are one row (the smallest by label, then components). A vector of another length than
the anchor's is neither its positive nor its negative. Anchors without other rows of their label, and windows without
rows, give no result; a positive with a negative score has an empty window. Components beyond ``vectors.LARGEST`` are an
error. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm import vectors
from blotter.llm.common import materialize, ship

STRIP = 2048
FALLS = (0.125, 0.25, 0.5, 1.0)  # the threshold's way from what a strip can reach to where its windows are full for sure
HITS = "anchor_id long, positive_id long, positive_score long, negative_id long, score long"


class Best:
    """The best ``want`` (score, id) of each window, filled strip by strip; scores outside [low, high] don't count."""

    def __init__(self, low: np.ndarray, high: np.ndarray, want: int):
        self.low, self.high, self.want = low, high, want
        self.window, self.score, self.id = (np.empty(0, np.int64) for _ in range(3))

    def add(self, window: np.ndarray, score: np.ndarray, row_id: np.ndarray) -> None:
        fits = (score >= self.low[window]) & (score <= self.high[window])
        window, score, row_id = (np.concatenate([a, b[fits]]) for a, b in ((self.window, window), (self.score, score), (self.id, row_id)))
        order = np.lexsort((row_id, -score, window))
        window = window[order]
        place = np.arange(len(window)) - np.searchsorted(window, window)
        self.window, self.score, self.id = (x[place < self.want] for x in (window, score[order], row_id[order]))

    def floors(self) -> np.ndarray:
        """Per window, the least score that can still enter it."""
        out = self.low.copy()
        full = np.bincount(self.window, minlength=len(out)) == self.want
        last = np.searchsorted(self.window, np.flatnonzero(full), side="right") - 1
        out[full] = np.maximum(out[full], self.score[last])
        return out


def rest_norms(x: np.ndarray, bounds: list[int]) -> np.ndarray:
    """Norms of what follows each bound, per row."""
    squares = np.cumsum((x.astype(np.float64) ** 2)[:, ::-1], axis=1)[:, ::-1]
    squares = np.concatenate([squares, np.zeros((len(x), 1))], axis=1)
    return np.sqrt(squares[:, bounds])


class Strip:
    """Some rows, indexed as far as a threshold needs, and their partial scores with the anchors."""

    def __init__(self, anchors: np.ndarray, rows: np.ndarray, skip: np.ndarray, block: int = 8):
        order = np.argsort(-(rows.astype(np.float64) ** 2).sum(axis=0), kind="stable")
        self.x, self.y = anchors[:, order], rows[:, order]
        self.bounds = [*range(0, rows.shape[1], block), rows.shape[1]]
        self.rest_x, self.rest_y = rest_norms(self.x, self.bounds), rest_norms(self.y, self.bounds)
        most = np.abs(self.x).max(initial=1).astype(float) * np.abs(self.y).max(initial=1) * rows.shape[1]
        self.kind = np.float64 if most < 2**52 else np.int64  # exact either way; the first is the faster one
        self.partial = np.zeros((len(anchors), len(rows)), self.kind)
        self.done = np.zeros(len(rows), np.int64)  # blocks of dimensions that are in a row's partial scores
        self.decided = skip.copy()

    def reach(self) -> np.ndarray:
        """Per anchor, what no score here exceeds."""
        return self.rest_x[:, 0] * self.rest_y[:, 0].max(initial=0.0) + 1.0

    def _bound(self, rows: np.ndarray) -> np.ndarray:
        rest = self.rest_x[:, self.done[rows]] * self.rest_y[rows, self.done[rows]]
        return self.partial[:, rows] + rest * (1 + 1e-9) + 1e-3  # norms are rounded, scores are not

    def join(self, open_anchors: np.ndarray, threshold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, score) of all pairs of open anchors that may reach their threshold and were not decided before."""
        least, largest = threshold[open_anchors].min(), self.rest_x[open_anchors].max(axis=0)
        covered = self.rest_y * largest * (1 + 1e-9) + 1e-3 < least
        indexed = np.where(covered.any(axis=1), covered.argmax(axis=1), len(self.bounds) - 1)  # blocks before the omitted ones
        goal = np.where(open_anchors, threshold, np.inf)[:, None]
        alive = np.flatnonzero(indexed > 0)
        for b in range(len(self.bounds) - 1):
            due = alive[(self.done[alive] == b) & (indexed[alive] > b)]
            if len(due):
                own = slice(self.bounds[b], self.bounds[b + 1])
                self.partial[:, due] += self.x[:, own].astype(self.kind) @ self.y[due, own].astype(self.kind).T
                self.done[due] = b + 1
                hopeless = due[~((self._bound(due) >= goal) & ~self.decided[:, due]).any(axis=0)]
                alive = np.setdiff1d(alive, hopeless, assume_unique=True)
        near = (self._bound(alive) >= goal) & ~self.decided[:, alive]
        i, j = np.nonzero(near)
        j = alive[j]
        self.decided[i, j] = True
        score = [np.einsum("ij,ij->i", self.x[i[c : c + 8192]], self.y[j[c : c + 8192]]) for c in range(0, len(i), 8192)]
        return i, j, np.concatenate([*score, np.empty(0, np.int64)])


def search(anchors: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, skip, best: Best, anchor_of: np.ndarray) -> None:
    """Fill the windows (``anchor_of`` names each one's anchor) from the rows; ``skip`` gives the pairs left out of a strip."""
    order = np.argsort(anchor_of, kind="stable")
    first, after = (np.searchsorted(anchor_of[order], np.arange(len(anchors)), side=s) for s in ("left", "right"))
    for start in range(0, len(rows), STRIP):
        own = slice(start, start + STRIP)
        strip = Strip(anchors, rows[own], skip(own))
        reach, many = strip.reach(), after - first
        for fall in FALLS:
            floor = np.full(len(anchors), np.inf)
            np.minimum.at(floor, anchor_of, best.floors().astype(float))
            if fall == FALLS[0]:
                begun, threshold = floor, np.full(len(anchors), np.inf)
            is_open = (threshold > floor) & (floor <= reach)
            if not is_open.any():
                break
            threshold = np.where(is_open, np.maximum(floor, reach - fall * (reach - np.minimum(begun, reach))), threshold)
            i, j, score = strip.join(is_open, threshold)
            # One entry for each window of the pair's anchor.
            pair = np.repeat(np.arange(len(i)), many[i])
            place = np.arange(len(pair)) - np.repeat(np.cumsum(many[i]) - many[i], many[i])
            best.add(order[first[i[pair]] + place], score[pair], row_ids[own][j[pair]])


def numbered(df: DataFrame, keys: list[str], name: str, rows: int) -> DataFrame:
    """``name``: a group number, evenly by vec_id's hash, of about ``rows`` rows per key."""
    sizes = df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("groups"))
    return df.join(sizes, keys).withColumn(name, F.pmod(F.xxhash64("vec_id"), F.col("groups")).cast("int"))


def usable(table: DataFrame, label: Column) -> DataFrame:
    """vec_id, label, numbers, size, norm: one row per vec_id."""
    good = table.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), "embedding").filter(
        vectors.whole(F.col("embedding")) & F.col("vec_id").isNotNull() & F.col("label").isNotNull()
    )
    one = good.groupBy("vec_id").agg(F.min(F.struct("label", vectors.scaled(F.col("embedding")).alias("numbers"))).alias("x"))
    square = F.aggregate("numbers", F.lit(0).cast("double"), lambda a, v: a + v.cast("double") * v)
    return one.select("vec_id", "x.label", "x.numbers").withColumns({"size": F.size("numbers"), "norm": F.sqrt(square)})


def met(anchors: DataFrame, rows: DataFrame, keys: list[str], run) -> DataFrame:
    """``run`` over the anchors and the rows of each key. Both descend from one table: the anchors get columns of their own."""
    own = anchors.select(*[F.col(c).alias(f"a_{c}") for c in anchors.columns])
    named = lambda key, a, r: run(key, a.rename(columns=lambda c: c[2:]), r)
    return own.groupBy(*[f"a_{k}" for k in keys]).cogroup(rows.groupBy(*keys)).applyInPandas(named, HITS)


def top(hits: DataFrame, keys: list[str], want: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "negative_id")
    return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= want)


def best_positives(rows: DataFrame, anchors: DataFrame, want: int, block_rows: int, group_rows: int) -> DataFrame:
    """vec_id (anchor), numbers, label, size, norm, positive_id, positive_score."""
    keys = ["label", "size"]
    blocks = materialize(numbered(anchors, keys, "block", block_rows))
    groups = numbered(rows.join(blocks.select(*keys).distinct(), keys, "left_semi"), keys, "part", group_rows)
    n_blocks = blocks.select(*keys, F.col("groups").alias("blocks")).distinct()
    n_groups = groups.select(*keys, "groups").distinct()
    left = blocks.drop("groups").join(n_groups, keys).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    right = groups.drop("groups").join(n_blocks, keys).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))

    def run(key: tuple, a: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(r):
            return pd.DataFrame(columns=["anchor_id", "positive_id", "positive_score", "negative_id", "score"])
        x, y = vectors.stacked(a["numbers"], int(key[1])), vectors.stacked(r["numbers"], int(key[1]))
        ids, own = r["vec_id"].to_numpy(), a["vec_id"].to_numpy()
        lowest = np.full(len(a), np.iinfo(np.int64).min // 2)
        lowest = np.maximum(lowest, -(np.linalg.norm(x.astype(float), axis=1) * np.linalg.norm(y.astype(float), axis=1).max() + 2).astype(np.int64))
        best = Best(lowest, np.full(len(a), np.iinfo(np.int64).max), want)
        search(x, y, ids, lambda s: own[:, None] == ids[s][None, :], best, np.arange(len(a)))
        return pd.DataFrame({"anchor_id": own[best.window], "positive_id": -1, "positive_score": 0, "negative_id": best.id, "score": best.score})

    cut = ["vec_id", "label", "size", "numbers", "block", "part"]
    hits = met(left.select(*cut), right.select(*cut), ["label", "size", "block", "part"], run)
    chosen = top(hits, ["anchor_id"], want).select(
        F.col("anchor_id").alias("vec_id"), F.col("negative_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return anchors.join(chosen, "vec_id")


def mine(
    table: DataFrame, label: Column | None = None, is_anchor: Column | None = None, positives: int = 5, negatives: int = 10,
    low: int = 30, high: int = 90, block_rows: int = 512, group_rows: int = 8192,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``label`` (default: the column) and ``is_anchor`` (default: every row) are expressions over the table's columns; ``low``
    and ``high`` are per cent of the positive's score.
    """
    ship(table.sparkSession)
    held = F.col("label") if label is None else label
    marked = table if is_anchor is None else table.select("vec_id", "label", "embedding", is_anchor.alias("anchor"))
    rows = materialize(usable(marked, held))
    named = rows if is_anchor is None else rows.join(marked.filter("anchor").select(F.col("vec_id").cast("long").alias("vec_id")).distinct(), "vec_id", "left_semi")
    found = best_positives(rows, named, positives, block_rows, group_rows)
    score = F.col("positive_score")
    windows = found.filter(score >= 0).groupBy("vec_id").agg(
        F.first("label").alias("label"), F.first("size").alias("size"), F.first("norm").alias("norm"), F.first("numbers").alias("numbers"),
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"), F.min("positive_score").alias("least"))  # at most ``positives``
    blocks = materialize(numbered(windows, ["size"], "block", block_rows))
    groups = materialize(numbered(rows, ["size"], "part", group_rows))
    ranges = groups.groupBy("size", "part").agg(F.max("norm").alias("longest"))
    needs = blocks.groupBy("size", "block").agg(F.min(F.col("least") * low / 100 / F.greatest("norm", F.lit(1.0))).alias("reach"))
    meets = materialize(needs.join(ranges, "size").filter(F.col("longest") * (1 + 1e-9) + 1e-3 >= F.col("reach")).select("size", "block", "part"))
    keys = ["size", "block", "part"]
    left = blocks.join(meets, ["size", "block"]).select(*keys, "vec_id", "label", "numbers", "positives")
    right = groups.join(meets, ["size", "part"]).select(*keys, "vec_id", "label", "numbers")

    def run(key: tuple, a: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(r):
            return pd.DataFrame(columns=["anchor_id", "positive_id", "positive_score", "negative_id", "score"])
        x, y = vectors.stacked(a["numbers"], int(key[0])), vectors.stacked(r["numbers"], int(key[0]))
        anchor_of = np.repeat(np.arange(len(a)), [len(p) for p in a["positives"]])
        of = [p for own in a["positives"] for p in own]
        positive, scored = (np.array([p[c] for p in of], np.int64) for c in ("positive_id", "positive_score"))
        best = Best(-(-(low * scored) // 100), high * scored // 100, negatives)
        labels, own, ids = r["label"].to_numpy(), a["label"].to_numpy(), r["vec_id"].to_numpy()
        search(x, y, ids, lambda s: own[:, None] == labels[s][None, :], best, anchor_of)
        w = best.window
        return pd.DataFrame({"anchor_id": a["vec_id"].to_numpy()[anchor_of[w]], "positive_id": positive[w], "positive_score": scored[w],
                             "negative_id": best.id, "score": best.score})

    hits = met(left, right, keys, run)
    ranked = top(hits, ["anchor_id", "positive_id", "positive_score"], negatives)
    return ranked.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", F.col("score").alias("negative_score"))
