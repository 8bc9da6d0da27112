"""Token counts (operator 8): overlap resynchronisation for huge documents, a word memo for the rest.

The tokenizer must never join text across a space or line feed, as a word-end BPE with a white-space-dropping split does;
a position just after one is then a *stable* boundary, on whose sides tokens don't depend on each other. Texts of up to
``chunk`` characters are cut at these places and each distinct piece is encoded by the library once per memo. A longer
text is dealt out as overlapping chunks, each encoded whole with offsets: neighbours are spliced at a stable boundary at
which both have a token start. Where an overlap holds no such boundary, the document's chunks and overlaps are widened
eightfold and encoded again, until one chunk holds the whole text.

Null and empty texts have 0 bytes and 0 tokens; every input row gives one output row, repeated rows and rows with a null
doc_id included; extra columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm.common import materialize, ship

MEMO = 1_000_000  # pieces remembered per Python worker
_loaded: dict[str, tuple] = {}


def tokenizer(path: str):
    """The tokenizer and this worker's memo of token counts."""
    if path not in _loaded:
        from tokenizers import Tokenizer

        _loaded[path] = Tokenizer.from_file(path), {}
    return _loaded[path]


def count_words(encoder, words: list[str], at_once: int = 256) -> list[int]:
    """Tokens of each of many one-word pieces, which the library gets joined by spaces and tells apart again."""
    parts = [words[i : i + at_once] for i in range(0, len(words), at_once)]
    out: list[int] = []
    for part, told in zip(parts, encoder.encode_batch([" ".join(p) for p in parts], add_special_tokens=False)):
        own = np.bincount(told.word_ids).tolist() if part else []
        out += own if len(own) == len(part) else [len(x) for x in encoder.encode_batch_fast(part, add_special_tokens=False)]
    return out


def one_word(piece: str) -> bool:
    """Latin-1 letters stay one word under the normaliser and the split."""
    return piece.isalpha() and (piece.isascii() or max(piece) <= "\u00ff")


def core(piece: str) -> str:
    """The piece without a comma or full stop that the split cuts off after Latin-1 letters; in lower case if ASCII letters only.

    Anything else stays as spelt: the library looks for special tokens before it lowers case, and its normaliser makes
    marks of other letters (a capital I with a dot above), after which the split cuts elsewhere.
    """
    word = piece[:-1] if piece[-1:] in (",", ".") and one_word(piece[:-1]) else piece
    return word.lower() if word.isascii() and word.isalpha() else word


def learn(encoder, memo: dict[str, int], missing: set[str]) -> None:
    cores = {w: core(w) for w in missing}
    new = set(cores.values()).difference(memo)
    words = [w for w in new if one_word(w)]
    others = list(new.difference(words) | {",", "."})
    memo.update(zip(words, count_words(encoder, words)))
    memo.update(zip(others, map(len, encoder.encode_batch_fast(others, add_special_tokens=False))))
    memo.update({w: memo[c] + (memo[w[-1]] if len(c) < len(w) else 0) for w, c in cores.items() if c != w})


def count_pieces(texts: list[str], path: str) -> list[int]:
    """Tokens of each text: the sum over its pieces between spaces and line feeds."""
    encoder, memo = tokenizer(path)
    split = [t.replace("\n", " ").split(" ") for t in texts]
    words = set(itertools.chain.from_iterable(split))
    if len(memo) > MEMO:
        memo.clear()
    learn(encoder, memo, words.difference(memo))
    return [sum(map(memo.__getitem__, pieces)) for pieces in split]


def short_counts(path: str, at_once: int = 256):
    @F.pandas_udf("long")
    def counts(texts: pd.Series) -> pd.Series:
        own = texts.fillna("").tolist()
        return pd.Series([n for i in range(0, len(own), at_once) for n in count_pieces(own[i : i + at_once], path)], dtype="int64")

    return counts


def stable_starts(text: str, offsets, base: int, low: int, high: int) -> list[dict]:
    """{at, before}: token starts in [low, high) that follow a space or line feed, and the tokens before them."""
    return [
        {"at": s + base, "before": i}
        for i, (s, _) in enumerate(offsets)
        if low <= s < high and s > 0 and text[s - 1] in " \n" and (i == 0 or offsets[i - 1][1] <= s)
    ]


def encode_chunks(chunks: DataFrame, path: str, overlap: int) -> DataFrame:
    """Per chunk its token count and the stable boundaries in the overlaps with its neighbours."""

    def run(batches):
        encoder, _ = tokenizer(path)
        for batch in batches:
            rows = batch.to_pylist()
            out = []
            for r in rows:
                offsets = encoder.encode(r["part"], add_special_tokens=False).offsets
                n = len(r["part"])
                out.append({
                    "row_id": r["row_id"], "chunk_no": r["chunk_no"], "n": len(offsets),
                    "head": stable_starts(r["part"], offsets, r["start"], 0, overlap) if r["chunk_no"] else [],
                    "tail": [] if r["last"] else stable_starts(r["part"], offsets, r["start"], n - overlap, n),
                })
            yield pa.RecordBatch.from_pylist(out, schema)

    edge = pa.list_(pa.struct([("at", pa.int64()), ("before", pa.int64())]))
    schema = pa.schema([("row_id", pa.string()), ("chunk_no", pa.int64()), ("n", pa.int64()), ("head", edge), ("tail", edge)])
    kind = "array<struct<at: long, before: long>>"
    return chunks.mapInArrow(run, f"row_id string, chunk_no long, n long, head {kind}, tail {kind}")


def splice(encoded: DataFrame) -> DataFrame:
    """row_id, n_tokens (null where some overlap has no common stable boundary)."""
    order = Window.partitionBy("row_id").orderBy("chunk_no")
    common = F.array_max(F.array_intersect(F.col("head.at"), F.col("before_tail.at")))
    joint = encoded.withColumn("before_tail", F.lag("tail").over(order)).withColumn("at", common)
    at_index = lambda edge: F.get(F.filter(edge, lambda x: x["at"] == F.col("at")), F.lit(0))["before"]
    # tokens that the chunk before counts up to the boundary, less those that this chunk has before it
    step = F.when(F.col("chunk_no") > 0, at_index("before_tail") - at_index("head") - F.col("n_before")).otherwise(0)
    joint = joint.withColumn("n_before", F.lag("n").over(order))
    return (
        joint.select("row_id", "n", step.alias("step"))
        .groupBy("row_id")
        .agg(F.when(F.count("step") == F.count(F.lit(1)), F.sum("n") + F.sum("step")).alias("n_tokens"))
    )


def long_counts(long: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """row_id, n_tokens of texts longer than ``chunk``; each round widens what could not be spliced."""
    pending, done = long, None
    while True:
        size = F.char_length("text")
        starts = F.sequence(F.lit(0), F.greatest(size - overlap - 1, F.lit(0)), F.lit(chunk - overlap))
        parts = (
            pending.select("row_id", "text", F.posexplode(starts).alias("chunk_no", "start"), F.size(starts).alias("n_chunks"))
            .select(
                "row_id", F.col("chunk_no").cast("long"), F.col("start").cast("long"),
                (F.col("chunk_no") == F.col("n_chunks") - 1).alias("last"),
                F.expr(f"substring(text, start + 1, {chunk})").alias("part"),
            )
            .repartition("row_id", "chunk_no")
        )
        counted = materialize(splice(encode_chunks(parts, path, overlap)))
        done = counted if done is None else done.unionByName(counted)
        failed = counted.filter("n_tokens IS NULL").select("row_id")
        if failed.isEmpty():
            return done.filter("n_tokens IS NOT NULL")
        pending = pending.join(failed, "row_id", "left_semi")
        chunk, overlap = chunk * 8, overlap * 8


def token_counts(docs: DataFrame, path: str, chunk: int = 32_768, overlap: int = 512, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row."""
    ship(docs.sparkSession)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    size = F.coalesce(F.char_length("text"), F.lit(0))
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    short = rows.filter(size <= chunk).select("doc_id", n_bytes.alias("n_bytes"), short_counts(path)("text").alias("n_tokens"))
    # equal texts have equal counts, so a digest of the text names a long row whatever its doc_id
    long = rows.filter(size > chunk).withColumn("row_id", F.sha2("text", 256))
    counted = long_counts(long.select("row_id", "text").dropDuplicates(["row_id"]), path, chunk, overlap)
    joined = long.select("doc_id", n_bytes.alias("n_bytes"), "row_id").join(counted, "row_id").drop("row_id")
    return short.unionByName(joined.select(*short.columns)).withColumn("over_limit", F.col("n_tokens") > limit)
