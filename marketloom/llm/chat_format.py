"""Chat formatting: a state machine over roles and a declarative template.

Rows are dealt by conversation and sorted, and each task walks through its conversations turn by turn
with one state per conversation, so a conversation of any length needs the memory of one turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START = ""


@dataclass(frozen=True)
class Template:
    """How turns are written, which are learned from, and which order of roles is valid.

    ``head`` and ``tail`` stand around the role, ``end`` closes a turn.  They are the control strings:
    each starts with a character that does not come again in it and is not the escape character.
    """

    head: str = "<turn "
    tail: str = ">"
    end: str = "</turn>\n"
    escape: str = "\\"
    learned: frozenset[str] = frozenset({"assistant"})
    follows: Mapping[str, frozenset[str]] = field(
        default_factory=lambda: {
            START: frozenset({"system", "user"}),
            "system": frozenset({"user"}),
            "user": frozenset({"assistant"}),
            "assistant": frozenset({"user"}),
        }
    )
    final: frozenset[str] = frozenset({"assistant"})

    def __post_init__(self):
        for control in (self.head, self.tail, self.end):
            if not control or control[0] in control[1:] or control[0] == self.escape:
                raise ValueError(f"not usable as a control string: {control!r}")

    def _codes(self) -> dict[str, str]:
        """What stands for the escape character and for the first character of each control string."""
        firsts = sorted({c[0] for c in (self.head, self.tail, self.end)})
        return {self.escape: self.escape * 2} | {c: self.escape + chr(ord("a") + i) for i, c in enumerate(firsts)}

    def quoted(self, text: str) -> str:
        """``text`` in a form in which no control string can occur."""
        codes = self._codes()
        return re.sub(f"[{re.escape(''.join(codes))}]", lambda m: codes[m[0]], text)

    def unquoted(self, text: str) -> str:
        back = {code[1]: plain for plain, code in self._codes().items()}
        return re.sub(f"{re.escape(self.escape)}(.)", lambda m: back[m[1]], text, flags=re.S)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """The parts of one turn: (text, learned)."""
        return [
            (self.head + self.quoted(role) + self.tail, False),
            (self.quoted(text), role in self.learned),
            (self.end, False),
        ]

    def parse(self, written: str) -> list[tuple[str, str]]:
        """(role, text) of the turns in a formatted text."""
        plain = f"(?:[^{re.escape(self.escape)}]|{re.escape(self.escape)}.)*?"
        turn = re.compile(
            re.escape(self.head) + f"({plain})" + re.escape(self.tail) + f"({plain})" + re.escape(self.end), re.S
        )
        out, at = [], 0
        while at < len(written):
            found = turn.match(written, at)
            if not found:
                raise ValueError("not a formatted conversation")
            out.append((self.unquoted(found[1]), self.unquoted(found[2])))
            at = found.end()
        return out

    def step(self, state: str | None, role: str) -> str | None:
        """The state after a turn; None once the order has been broken."""
        return role if state is not None and role in self.follows.get(state, ()) else None


SEGMENTS = "array<struct<text:string,learned:boolean>>"


def _sorted_turns(df: DataFrame, conv: str, *order: str) -> DataFrame:
    return df.repartition(conv).sortWithinPartitions(conv, *order)


def format_turns(
    df: DataFrame, conv: str, turn: str, role: str, text: str, template: Template = Template()
) -> DataFrame:
    """(conv, position, segments, in_order): every turn as text segments with a loss flag each.

    Turns are ordered by ``turn`` (NULL first), then role and text, and numbered from 0.  NULL roles
    and texts are empty.  ``in_order`` is true as long as the roles follow the template; a turn out of
    order is formatted all the same.  Rows with a NULL conversation form one.  Repeated rows are turns
    of their own.  Other columns are not carried.
    """
    given = _sorted_turns(
        df.select(
            F.col(conv).alias("conv"), F.col(turn).alias("turn"),
            F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        ),
        "conv", "turn", "role", "text",
    )
    schema = given.select(
        "conv", F.lit(0).cast("long").alias("position"), F.lit(None).cast(SEGMENTS).alias("segments"),
        F.lit(True).alias("in_order"),
    ).schema
    kind = pa.list_(pa.struct([("text", pa.string()), ("learned", pa.bool_())]))

    def run(batches):
        current, position, state = object(), 0, None
        for batch in batches:
            convs, roles, texts = (batch.column(i).to_pylist() for i in (0, 2, 3))
            positions, parts, valid = [], [], []
            for c, r, t in zip(convs, roles, texts):
                if c != current:
                    current, position, state = c, 0, START
                state = template.step(state, r)
                positions.append(position)
                parts.append([{"text": s, "learned": k} for s, k in template.segments(r, t)])
                valid.append(state is not None)
                position += 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(positions, pa.int64()), pa.array(parts, kind), pa.array(valid, pa.bool_())],
                ["conv", "position", "segments", "in_order"],
            )

    return given.mapInArrow(run, schema).withColumnRenamed("conv", conv)


def read_back(formatted: DataFrame, conv: str, template: Template = Template()) -> DataFrame:
    """Per conversation, from its segments alone: turns, digests, learned characters and validity.

    ``turns_sha256`` is over role, line break, text, line break of each turn; ``loss_sha256`` over the
    unescaped learned text.  ``valid`` says that all turns are in order and the last may be the last.
    """
    given = _sorted_turns(formatted.select(F.col(conv).alias("conv"), "position", "segments", "in_order"), "conv", "position")
    schema = given.selectExpr(
        "conv", "0L AS n_turns", "'' AS turns_sha256", "0L AS loss_chars", "'' AS loss_sha256",
        "0L AS formatted_chars", "true AS valid",
    ).schema
    names = schema.names

    def run(batches):
        rows, state, target = [], None, None

        def close():
            if state:
                rows.append(
                    (state["conv"], state["n"], state["turns"].hexdigest(), state["chars"], state["loss"].hexdigest(),
                     state["length"], state["valid"] and state["role"] in template.final)
                )

        def flush():
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, target)], schema=target
            )

        for batch in batches:
            if target is None:
                kinds = [batch.schema.field(0).type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
                target = pa.schema([pa.field(n, k) for n, k in zip(names, kinds)])
            for c, segments, in_order in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if state is None or c != state["conv"]:
                    close()
                    state = {
                        "conv": c, "n": 0, "turns": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(),
                        "length": 0, "valid": True, "role": None,
                    }
                written = "".join(s["text"] for s in segments)
                for r, t in template.parse(written):
                    state["n"] += 1
                    state["turns"].update(f"{r}\n{t}\n".encode())
                    state["role"] = r
                for s in segments:
                    if s["learned"]:
                        learned = template.unquoted(s["text"])
                        state["chars"] += len(learned)
                        state["loss"].update(learned.encode())
                state["length"] += len(written)
                state["valid"] &= in_order
            if len(rows) >= 1000:
                yield flush()
                rows.clear()
        close()
        if rows:
            yield flush()

    return given.mapInArrow(run, schema).withColumnRenamed("conv", conv)
