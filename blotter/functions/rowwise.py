"""Python twins, per row and per Arrow batch, used only by the RDD-route parity queries.

Kept tiny on purpose: the DataFrame route uses ``scalars.part_of_day``.
The helpers are closures over plain values, so cloudpickle ships them by value
and Python workers need no installed copy of this package.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa

from .scalars import NIGHT_FROM, NIGHT_LABEL, NIGHT_UNTIL, PART_OF_DAY_RANGES


def _make_part_of_day() -> Callable[[int | None], str | None]:
    ranges = tuple(PART_OF_DAY_RANGES)
    night_label, night_from, night_until = NIGHT_LABEL, NIGHT_FROM, NIGHT_UNTIL

    def part_of_day_py(clock: int | None) -> str | None:
        """Python twin of ``scalars.part_of_day`` (NULL in -> NULL out)."""
        if clock is None:
            return None
        for label, lo, hi in ranges:
            if lo <= clock <= hi:
                return label
        if clock >= night_from or clock <= night_until:
            return night_label
        return None

    return part_of_day_py


part_of_day_py = _make_part_of_day()


def _make_part_of_day_counts() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    ranges = (*PART_OF_DAY_RANGES,)
    night_label, night_from, night_until = NIGHT_LABEL, NIGHT_FROM, NIGHT_UNTIL

    def part_of_day_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(part_of_day, n) of all batches of a task; NULL for clocks in no part."""
        import pyarrow as pa
        import pyarrow.compute as pc

        counts: dict[str | None, int] = {}
        for batch in batches:
            clock, left = batch.column(0), batch.num_rows
            masks = [(label, pc.and_(pc.greater_equal(clock, lo), pc.less_equal(clock, hi))) for label, lo, hi in ranges]
            masks.append((night_label, pc.or_(pc.greater_equal(clock, night_from), pc.less_equal(clock, night_until))))
            for label, mask in masks:
                n = pc.sum(mask).as_py() or 0
                counts[label] = counts.get(label, 0) + n
                left -= n
            counts[None] = counts.get(None, 0) + left
        told = {label: n for label, n in counts.items() if n}
        yield pa.RecordBatch.from_arrays([pa.array(list(told), pa.string()), pa.array(list(told.values()), pa.int64())], names=["part_of_day", "n"])

    return part_of_day_counts


part_of_day_counts = _make_part_of_day_counts()
