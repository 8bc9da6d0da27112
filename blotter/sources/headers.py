"""Which files share a header line.

Spark's CSV reader takes the names from one file's header and binds all other files to them by position. Files whose
columns stand in another order, or that spell a name differently, must therefore be read apart. ``files_by_header`` lists
the files behind the given paths and reads the first line of each: one task per file block, of which only a file's first
opens it, and a task ends after that line. What reaches the driver is one line per file.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from urllib.parse import unquote

from pyspark.sql import SparkSession

#: Files per probing job: bounds the size of its plan, not the number of files.
FILES_PER_JOB = 500


def listed_files(spark: SparkSession, paths: list[str]) -> list[str]:
    """The data files behind ``paths`` (files, folders, globs), as paths that a reader takes literally."""
    return sorted(unquote(f) for f in spark.read.text(paths).inputFiles())


def literal(path: str) -> str:
    """``path`` with the characters escaped that a reader would expand."""
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in path)


def _first_line(comment: bytes | None, number: int, index: int, lines: Iterator[bytes]) -> Iterator[tuple[int, bytes]]:
    """(number, line) of a file's first line that is neither blank nor a comment; nothing from its later blocks."""
    if index:
        return iter(())
    told = (x.rstrip(b"\r") for x in lines)
    found = next((x for x in told if x.strip() and not (comment and x.startswith(comment))), None)
    return iter(()) if found is None else iter(((number, found),))


def header_lines(spark: SparkSession, files: list[str], comment: str | None = None) -> dict[str, bytes]:
    """The header line of each file that has one."""
    sc, out = spark.sparkContext, {}
    mark = comment.encode() if comment else None
    for start in range(0, len(files), FILES_PER_JOB):
        own = files[start : start + FILES_PER_JOB]
        probes = [
            # Bytes: a file of another encoding is only compared with files of its own.
            sc.textFile(literal(f), 1, use_unicode=False).mapPartitionsWithIndex(partial(_first_line, mark, i))
            for i, f in enumerate(own)
        ]
        out |= {own[i]: line for i, line in sc.union(probes).collect()}
    return out


def files_by_header(spark: SparkSession, paths: list[str], comment: str | None = None) -> list[list[str]]:
    """The files in groups of equal header lines, in the order of their first file; files without any line are left out.

    A single file is not opened. A file with a comma in its name, which the line reader takes for two, is a group of its own.
    """
    files = listed_files(spark, paths)
    if len(files) < 2:
        return [files] if files else []
    groups: dict[object, list[str]] = {}
    told = header_lines(spark, [f for f in files if "," not in f], comment)
    for f in files:
        if "," in f:
            groups[f] = [f]
        elif f in told:
            groups.setdefault(told[f], []).append(f)
    return list(groups.values())
