"""Chat formatting (operator 5): a declarative template and a finite-state machine over roles.

The template names, per role, the strings that open and close a turn and whether the turn's text is trained on. Turns
become text segments with a loss flag; the state machine says for each turn whether its role may follow the role before.
A text's backslashes and the first characters of all control strings are preceded by a backslash, so a text cannot hold
a control string, and ``read_back`` recovers the turns from the segments alone.

Rows are dealt by conversation, sorted, and streamed, so memory holds one Arrow batch, never a conversation. Nulls, ties
and odd rows: a null or empty text gives an empty text segment; a null role counts as ``''``; unknown roles get the
``other`` marks, no loss, and are invalid; a null turn comes first; rows that tie on turn follow role, then text, and
repeated rows are turns of their own; rows with a null conversation are one conversation; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import ship


@dataclass(frozen=True)
class Turn:
    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    roles: dict[str, Turn]
    other: tuple[str, str, str]  # before the role's name, between name and text, after the text
    follows: dict[str, tuple[str, ...]]  # role -> roles allowed before it; "" is the start
    escape: str = "\\"
    controls: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        marks = [m for t in self.roles.values() for m in (t.open, t.close)] + list(self.other)
        object.__setattr__(self, "controls", tuple(sorted(set(marks), key=len, reverse=True)))
        if any(not m for m in marks) or len({t.open for t in self.roles.values()}) < len(self.roles):
            raise ValueError("each mark must be non-empty and each role's opening mark its own")

    def first_characters(self) -> set[str]:
        return {m[0] for m in self.controls} | {self.escape}

    def escaped(self, text: str) -> str:
        return re.sub(f"[{re.escape(''.join(self.first_characters()))}]", lambda m: self.escape + m[0], text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        turn = self.roles.get(role)
        if turn is None:
            start, middle, end = self.other
            return [(start, False), (self.escaped(role), False), (middle, False), (self.escaped(text), False), (end, False)]
        return [(turn.open, False), (self.escaped(text), turn.loss), (turn.close, False)]

    def tokens(self, formatted: str) -> Iterator[tuple[bool, str]]:
        """(is control, string): control strings and the unescaped text between them."""
        mark = re.escape(self.escape)
        plain = re.escape("".join(self.first_characters()))  # a run of others holds neither a control string nor an escape
        pattern = re.compile(f"({'|'.join(map(re.escape, self.controls))})|{mark}(.)|([^{plain}]+|[^{mark}])", re.S)
        text: list[str] = []
        for m in pattern.finditer(formatted):
            if m[1] is not None:
                yield False, "".join(text)
                text = []
                yield True, m[1]
            else:
                text.append(m[2] if m[2] is not None else m[3])
        yield False, "".join(text)

    def read_back(self, formatted: str) -> list[tuple[str, str]]:
        """(role, text) of every turn of a formatted string."""
        opened = {t.open: r for r, t in self.roles.items()}
        parts, turns, i = [x for x in self.tokens(formatted)], [], 0
        marks = [(i, s) for i, (control, s) in enumerate(parts) if control]
        while i < len(marks):
            at, mark = marks[i]
            if mark in opened:
                turns.append((opened[mark], parts[at + 1][1]))
                i += 2
            else:
                turns.append((parts[at + 1][1], parts[marks[i + 1][0] + 1][1]))
                i += 3
        return turns


INSTRUCT = Template(
    roles={
        "system": Turn("<<SYS>>\n", "<</SYS>>\n"),
        "user": Turn("<s>[INST] ", "[/INST]"),
        "assistant": Turn("<s>[ANSWER] ", "</s>", loss=True),
    },
    other=("<s>[ROLE] ", "[TEXT] ", "[/ROLE]"),
    follows={"system": ("",), "user": ("", "system", "assistant"), "assistant": ("user",)},
)


def format_turns(rows: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """conv_id, position, valid, segments (text, loss) per turn; each conversation is contiguous and in order."""
    ship(rows.sparkSession)

    def run(batches):
        conv, role, position = object(), "", 0
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["conv_id"] != conv:
                    conv, role, position = row["conv_id"], "", 0
                own = row["role"] or ""
                segments = [{"text": t, "loss": x} for t, x in template.segments(own, row["text"] or "")]
                out.append({"conv_id": conv, "position": position, "valid": role in template.follows.get(own, ()), "segments": segments})
                role, position = own, position + 1
            yield pa.RecordBatch.from_pylist(out, schema)

    segment = pa.struct([("text", pa.string()), ("loss", pa.bool_())])
    schema = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("valid", pa.bool_()), ("segments", pa.list_(segment))])
    return (
        rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role"), F.col("text"))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .mapInArrow(run, "conv_id long, position long, valid boolean, segments array<struct<text: string, loss: boolean>>")
    )


def digests(turns: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Per conversation, what can be read back from ``format_turns``' output (in its order)."""

    def run(batches):
        conv, state = object(), None

        def result():
            n, valid, told, chars, trained, size = state
            return {"conv_id": conv, "n_turns": n, "turns_sha256": told.hexdigest(), "loss_chars": chars,
                    "loss_sha256": trained.hexdigest(), "formatted_chars": size, "valid": valid}

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if state is None or row["conv_id"] != conv:
                    if state is not None:
                        out.append(result())
                    conv, state = row["conv_id"], [0, True, hashlib.sha256(), 0, hashlib.sha256(), 0]
                whole = "".join(s["text"] for s in row["segments"])
                back = template.read_back(whole)
                for role, text in back:
                    state[2].update(f"{role}\n{text}\n".encode())
                loss = "".join(text for s in row["segments"] if s["loss"] for control, text in template.tokens(s["text"]) if not control)
                state[0] += len(back)
                state[1] &= row["valid"]
                state[3] += len(loss)
                state[4].update(loss.encode())
                state[5] += len(whole)
            yield pa.RecordBatch.from_pylist(out, schema)
        if state is not None:
            yield pa.RecordBatch.from_pylist([result()], schema)

    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_())])
    return turns.mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean",
    )
