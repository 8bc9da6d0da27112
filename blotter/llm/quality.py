"""Quality rules whose cutoffs are chosen under a bound on false rejections (operator 3).

A rule rejects a document when one of its ratios passes a cutoff from a fixed grid. What is bounded is the joint rejection
of all rules in use: with ``k`` of ``n`` labelled documents rejected that are good and pass the base rules, the exact
(Clopper-Pearson) upper bound of the rejection probability must stay below ``alpha``. Settings of all rules together are
tested along paths in a fixed order, each rule from loose to strict, up to the first that isn't proven, so a path needs its
share of ``delta`` only once. A path starts with one of the rules that catch labelled bad documents; ``delta`` is split
evenly over the strata that have paths, then over a stratum's paths. Paths are laid out by the bad documents alone, so for
the good ones that test them they are fixed in advance. With probability ``1 - delta`` all accepted settings hold together,
and a stratum loses at most ``alpha`` of its good documents. Of the accepted settings the one that rejects most documents
labelled bad is used, that with fewest good ones rejected at a tie; a stratum without one, or without labels, has all rules
off. With five rules and four strata 297 good labels in a stratum prove a setting that rejects none of them
(``labels_needed``).

Nulls, ties and odd rows: a null text has no words and fails the base rule; a null stratum is a stratum of its own; several
labels of one document count as good only if all of them are; label rows without a document are ignored; every input row
gives one output row, repeated rows included; other columns of the inputs are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.llm.cells import release
from blotter.llm.common import materialize, ship

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAD = 0.9  # of the bad documents that a path's first rule can catch, those it catches before other rules move
MEASURES = T.StructType(
    [
        T.StructField(n, T.LongType())
        for n in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
    ]
)
_MULTIPLIERS = np.random.default_rng(8).integers(1, 2**63, WINDOW, dtype=np.uint64) | np.uint64(1)


@dataclass(frozen=True)
class Rule:
    """Rejects when ``numerator / denominator`` is above (or, if not ``above``, below) the cutoff; strictest cutoff first."""

    name: str
    numerator: str
    denominator: str
    cutoffs: tuple[float, ...]
    above: bool = True

    def rejects(self, cutoff: float) -> Column:
        value = F.col(self.numerator) / F.when(F.col(self.denominator) > 0, F.col(self.denominator))
        return F.coalesce(value > cutoff if self.above else value < cutoff, F.lit(False))


RULES = (
    Rule("symbols", "n_symbols", "n_words", (0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.5, 0.8, 1.0, 1.5, 2.0, 3.0)),
    Rule("dup_lines", "n_dup_lines", "n_lines", (0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8)),
    Rule("repeats", "n_repeat_words", "n_words", (0.02, 0.05, 0.08, 0.1, 0.12, 0.15, 0.18, 0.2, 0.25)),
    Rule("long_words", "word_chars", "n_words", (7.0, 7.5, 8.0, 8.5, 9.0, 10.0, 12.0, 15.0, 20.0)),
    Rule("short_words", "word_chars", "n_words", (5.0, 4.5, 4.0, 3.5, 3.0, 2.5, 2.0, 1.5), above=False),
)


def repeated_words(words: list[str], window: int = WINDOW) -> int:
    """Words covered by windows of ``window`` words that occur twice or more, the first occurrence included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[str, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.uint64)
    if len(number) == len(words):
        return 0
    keys = np.zeros(n, np.uint64)
    for j in range(window):
        keys += (ids[j : j + n] + np.uint64(1)) * _MULTIPLIERS[j]
    _, first, inverse, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    again = np.flatnonzero(counts[inverse] > 1)
    if not len(again):
        return 0
    twin = first[inverse[again]]
    if any((ids[again + j] != ids[twin + j]).any() for j in range(window)):  # two windows share a key: compare the words
        seen: dict[tuple, list[int]] = {}
        for i in range(n):
            seen.setdefault(tuple(ids[i : i + window]), []).append(i)
        again = np.array([i for at in seen.values() if len(at) > 1 for i in at], dtype=np.int64)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + window, -1)
    return int((np.cumsum(edge) > 0).sum())


def measure(text: str | None) -> tuple[int, int, int, int, int, int]:
    """The base measures of one text, in the order of ``MEASURES``."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(text.count(c) for c in SYMBOLS),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


@F.pandas_udf(MEASURES)
def measures(texts: pd.Series) -> pd.DataFrame:
    release()
    return pd.DataFrame([measure(t) for t in texts], columns=MEASURES.names, dtype="int64")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def tail(k: int, n: int, p: float) -> float:
    """The probability of ``k`` or fewer of ``n``."""
    choose = (math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in range(k + 1))
    return math.fsum(math.exp(c + i * math.log(p) + (n - i) * math.log1p(-p)) for i, c in enumerate(choose))


def upper_bound(k: int, n: int, error: float) -> float:
    """Clopper-Pearson: the largest p under which ``k`` or fewer of ``n`` still have probability ``error``."""
    if n == 0 or k >= n:
        return 1.0
    low, high = k / n, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if tail(k, n, mid) > error else (low, mid)
    return high


def most_rejected(n: int, alpha: float, error: float) -> int:
    """The largest ``k`` whose ``upper_bound`` is at most ``alpha``; -1 if there is none."""
    if not 0 < alpha < 1:
        return n if alpha >= 1 else -1
    low, high = -1, int(alpha * n) + 1
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if mid < n and tail(mid, n, alpha) <= error else (low, mid)
    return low


def labels_needed(alpha: float, error: float) -> int:
    """Good labels from which a setting that rejects none of them is proven."""
    return math.ceil(math.log(error) / math.log1p(-alpha))


def path(levels: np.ndarray, bad: np.ndarray, sizes: list[int], lead: int) -> list[tuple[int, ...]]:
    """Ever stricter settings (per rule the place of its cutoff, its number of cutoffs for off), from the bad documents only.

    ``levels`` has per group of documents and rule the number of cutoffs that reject it, ``bad`` the bad documents of each
    group. The rule ``lead`` moves first, until it catches ``LEAD`` of what it can; then, of the rules' next cutoffs that
    catch more, the one that catches most.
    """
    at, left, out = list(sizes), bad.copy(), []
    reachable = bad[levels[:, lead] > 0].sum()
    while True:
        uncaught = levels * (left > 0)[:, None]
        top = uncaught.max(axis=0, initial=0)
        gains = [int(left[uncaught[:, r] == t].sum()) if t else 0 for r, t in enumerate(top)]
        if not any(gains):
            return out
        led = gains[lead] and bad[levels[:, lead] > at[lead]].sum() < LEAD * reachable
        r = lead if led else int(np.argmax(gains))
        at[r] = int(top[r]) - 1
        left[levels[:, r] > at[r]] = 0
        out.append(tuple(at))


def rejected(levels: np.ndarray, counts: np.ndarray, setting: tuple[int, ...]) -> int:
    return int(counts[(levels > np.array(setting)).any(axis=1)].sum())


def select_cutoffs(
    measured: DataFrame, labels: DataFrame, stratum: str, rules=RULES, alpha: float = 0.02, delta: float = 0.05
) -> dict[str | None, dict[str, float]]:
    """Per stratum the cutoffs of the proven setting that rejects most labelled bad documents.

    Collected is a row per labelled stratum and combination of the rules' levels that occurs in it: never more than the
    product of the grids' sizes (140,400) a stratum, however many labels there are.
    """
    labelled = labels.groupBy("doc_id").agg(
        (F.min("quality") == 0).alias("bad"), ((F.min("quality") == 1) & (F.max("toxic") == 0)).alias("good")
    )
    levels = [sum((r.rejects(c).cast("int") for c in r.cutoffs), F.lit(0)).alias(f"level_{r.name}") for r in rules]
    counts = (
        measured.filter(~base_failed())
        .select("doc_id", F.col(stratum).alias("stratum"), *levels)
        .join(labelled.filter("good OR bad"), "doc_id")
        .groupBy("stratum", *[f"level_{r.name}" for r in rules])
        .agg(F.count_if("good").alias("good"), F.count_if("bad").alias("bad"))
        .orderBy("stratum", *[f"level_{r.name}" for r in rules])
        .collect()
    )
    sizes = [len(r.cutoffs) for r in rules]
    tables: dict[str | None, list] = {}
    for row in counts:
        tables.setdefault(row["stratum"], []).append([row[f"level_{r.name}"] for r in rules] + [row["good"], row["bad"]])
    paths: dict[str | None, tuple[np.ndarray, np.ndarray, np.ndarray, list]] = {}
    for at, rows in tables.items():
        table = np.array(rows, np.int64)
        of, good, bad = table[:, :-2], table[:, -2], table[:, -1]
        leads = [i for i in range(len(rules)) if bad[of[:, i] > 0].any()] if good.any() else []
        paths[at] = of, good, bad, [path(of, bad, sizes, i) for i in leads]
    strata = sum(bool(told) for *_, told in paths.values())
    chosen: dict[str | None, dict[str, float]] = {}
    for at, (of, good, bad, told) in paths.items():
        most = most_rejected(int(good.sum()), alpha, delta / max(1, strata * len(told)))
        best = 0, 0, None
        for settings in told:
            for setting in settings:
                k = rejected(of, good, setting)
                if k > most:
                    break
                best = max(best, (rejected(of, bad, setting), -k, setting), key=lambda x: x[:2])
        if best[2]:
            chosen[at] = {r.name: r.cutoffs[i] for r, i in zip(rules, best[2]) if i < len(r.cutoffs)}
    return chosen


def verdict(chosen: dict[str | None, dict[str, float]], stratum: str, rules=RULES) -> Column:
    """Kept: not failed by the base rules, nor by a rule of its stratum."""
    rejected = F.lit(False)
    for r in rules:
        for at, cutoffs in chosen.items():
            if r.name in cutoffs:
                rejected = rejected | (F.col(stratum).eqNullSafe(F.lit(at)) & r.rejects(cutoffs[r.name]))
    return ~(base_failed() | rejected)


def quality_rules(
    docs: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = 0.02, delta: float = 0.05
) -> DataFrame:
    """doc_id, stratum, the measures, base_failed and kept of every row. Texts are read once; only measures are shuffled."""
    ship(docs.sparkSession)
    measured = materialize(
        docs.select("doc_id", stratum, measures("text").alias("m")).select("doc_id", stratum, "m.*")
    )
    chosen = select_cutoffs(measured, labels, stratum, alpha=alpha, delta=delta)
    return measured.withColumn("base_failed", base_failed()).withColumn("kept", verdict(chosen, stratum))


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang", **risk: float) -> DataFrame:
    """The kept rows with all their columns: cutoffs from one pass, then a map-only filter, so no text is shuffled."""
    ship(docs.sparkSession)
    measured = docs.select("doc_id", stratum, measures("text").alias("m")).select("doc_id", stratum, "m.*")
    chosen = select_cutoffs(measured, labels, stratum, **risk)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")  # so that no column's name can clash
    held = docs.select(row, F.col(stratum), measures("text").alias("m")).select("row", stratum, "m.*")
    return held.filter(verdict(chosen, stratum)).select("row.*")
