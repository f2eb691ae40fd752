"""Chat formatting: a finite-state machine over roles, a declarative template, segments with loss flags, and the way back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rows


@dataclass(frozen=True)
class Role:
    """How a turn of a role is written: what stands before and after its text, and whether its text is learned."""

    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Roles, controls that texts must not contain, and the turn orders that are valid.

    other: how a turn of any other role is written; the role's own name stands between its two parts of before.
    """

    roles: dict[str, Role]
    other: tuple[str, str, str]
    controls: tuple[str, ...]
    moves: dict[str, tuple[str, ...]]
    ends: tuple[str, ...]
    loss_other: bool = False
    escape_pattern: re.Pattern = field(init=False, compare=False)

    def __post_init__(self):
        longest = sorted(self.controls, key=len, reverse=True)
        object.__setattr__(self, "escape_pattern", re.compile(r"\\|" + "|".join(map(re.escape, longest))))

    def escape(self, text: str) -> str:
        r"""No control is left: a backslash is doubled, and \. stands behind a control's first character."""
        return self.escape_pattern.sub(lambda m: r"\\" if m[0] == "\\" else m[0][0] + r"\." + m[0][1:], text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", lambda m: "\\" if m[1] == "\\" else "", text, flags=re.S)

    def turn(self, role: str, text: str) -> list[tuple[str, bool]]:
        """The segments of one turn, with their loss flags."""
        if (r := self.roles.get(role)) is not None:
            return [(r.before, False), (self.escape(text), r.loss), (r.after, False)]
        a, b, c = self.other
        return [(a + self.escape(role) + b, False), (self.escape(text), self.loss_other), (c, False)]

    def pattern(self) -> re.Pattern:
        """One whole turn; texts hold no control, so the first end is the end."""
        known = [f"{re.escape(r.before)}(?P<t{i}>.*?){re.escape(r.after)}" for i, r in enumerate(self.roles.values())]
        a, b, c = map(re.escape, self.other)
        return re.compile("|".join([*known, f"{a}(?P<role>.*?){b}(?P<text>.*?){c}"]), re.S)


#: The production template. Markers are of a kind that instruction-tuned models use.
INSTRUCT = Template(
    roles={
        "system": Role("<s><<SYS>> ", " <</SYS>></s>\n"),
        "user": Role("<s>[INST] ", " [/INST]\n"),
        "assistant": Role("<s>[OUT] ", " [/OUT]</s>\n", loss=True),
    },
    other=("<s>[ROLE] ", " [/ROLE] ", " </s>\n"),
    controls=("<s>", "</s>", "[INST]", "[/INST]", "[OUT]", "[/OUT]", "[ROLE]", "[/ROLE]", "<<SYS>>", "<</SYS>>"),
    moves={"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    ends=("assistant",),
)


class Machine:
    """The state after the turns so far, and the first thing wrong with their order."""

    def __init__(self, template: Template):
        self.template, self.state, self.n, self.error = template, "start", 0, ""

    def step(self, role: str) -> None:
        self.n += 1
        if not self.error and role not in self.template.moves.get(self.state, ()):
            self.error = f"turn {self.n}: {role or 'no role'} after {self.state}"
        self.state = role

    def end(self) -> str:
        return self.error or ("" if self.state in self.template.ends else f"ends with {self.state or 'no role'}")


def chat_segments(turns: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """(conv_id, turn_no, segment_no, segment, loss, error) in order within each conversation.

    turns: conv_id, turn, role, text; rows go by turn, ties by role and text (nulls first), and repeated rows are turns of
    their own. A null role or text is empty. error is "" but in the last segment of a conversation whose order is not valid;
    it is formatted all the same. Conversations of any length pass through a task turn by turn and are never gathered.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, current, out, started, no = Machine(template), None, [], False, 0

        def close() -> None:
            if started and (error := machine.end()):
                out[-1] = (*out[-1][:5], error)

        for batch in batches:
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if not started or conv != current:
                    close()
                    machine, current, started, no = Machine(template), conv, True, 0
                role = role or ""
                machine.step(role)
                for segment, loss in template.turn(role, text or ""):
                    out.append((conv, machine.n, no, segment, loss, ""))
                    no += 1
                if len(out) > 3000:
                    done, out[:] = out[:-3], out[-3:]
                    yield record(done)
        close()
        if out:
            yield record(out)

    def record(found: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string())
        return pa.record_batch([pa.array(x, k) for x, k in zip(zip(*found, strict=True), kinds, strict=True)], ["conv_id", "turn_no", "segment_no", "segment", "loss", "error"])

    ordered = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, "conv_id long, turn_no long, segment_no long, segment string, loss boolean, error string")


class Reader:
    """Reads a formatted conversation back, piece by piece; it holds no more than one turn."""

    def __init__(self, template: Template):
        self.template, self.pattern = template, template.pattern()
        self.names = list(template.roles)
        self.rest = ""
        self.turns = self.chars = self.loss_chars = 0
        self.of_turns, self.of_loss = hashlib.sha256(), hashlib.sha256()

    def feed(self, segment: str, loss: bool) -> None:
        self.chars += len(segment)
        if loss:
            text = self.template.unescape(segment)
            self.loss_chars += len(text)
            self.of_loss.update(text.encode("utf-8", "surrogatepass"))
        self.rest += segment
        while (m := self.pattern.match(self.rest)) is not None:
            self.rest = self.rest[m.end() :]
            if m["role"] is not None:
                role, text = self.template.unescape(m["role"]), m["text"]
            else:
                i = next(i for i in range(len(self.names)) if m[f"t{i}"] is not None)
                role, text = self.names[i], m[f"t{i}"]
            self.turns += 1
            self.of_turns.update(f"{role}\n{self.template.unescape(text)}\n".encode("utf-8", "surrogatepass"))


def read_back(segments: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Digests of each conversation, read back from its segments, which come in order as chat_segments() leaves them.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid). No segments: an empty table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, current, error, out, started = Reader(template), None, "", [], False

        def close() -> None:
            if started:
                if reader.rest:
                    raise ValueError(f"conversation {current}: what follows turn {reader.turns} is no turn")
                out.append((current, reader.turns, reader.of_turns.hexdigest(), reader.loss_chars, reader.of_loss.hexdigest(), reader.chars, not error))

        for batch in rows(batches, 1000):
            for conv, segment, loss, wrong in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if not started or conv != current:
                    close()
                    reader, current, error, started = Reader(template), conv, "", True
                reader.feed(segment, loss)
                error = error or wrong
            if len(out) > 1000:
                yield record(out)
                out = []
        close()
        if out:
            yield record(out)

    def record(found: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
        return pa.record_batch([pa.array(x, k) for x, k in zip(zip(*found, strict=True), kinds, strict=True)], names)

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]
    return segments.select("conv_id", "segment", "loss", "error").mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean")


def oracle(template: Template = INSTRUCT, turns: str = "conversations") -> str:
    """DuckDB SQL for read_back(chat_segments()) of turns(conv_id, turn, role, text)."""

    def text(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    escaped = "|".join([r"\\", *(re.escape(c) for c in sorted(template.controls, key=len, reverse=True))])

    def length(column: str) -> str:  # a doubled backslash is one sign more, an escaped control two
        found = f"regexp_extract_all({column}, {text(escaped)})"
        return f"(length({column}) + len(list_filter({found}, lambda x: x = chr(92))) + 2 * len(list_filter({found}, lambda x: x <> chr(92))))"

    marks = " ".join(f"when role = {text(name)} then {len(r.before) + len(r.after)}" for name, r in template.roles.items())
    learned = ", ".join(text(name) for name, r in template.roles.items() if r.loss)
    moves = " or ".join(f"before = {text(a)} and role = {text(b)}" for a, many in template.moves.items() if a != "start" for b in many)
    starts, ends = (", ".join(map(text, x)) for x in (template.moves["start"], template.ends))
    return f"""
    with t as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) as no from {turns}),
    u as (select *, lag(role) over (partition by conv_id order by no) as before, count(*) over (partition by conv_id) as n,
                 case {marks} else {sum(map(len, template.other))} + {length("role")} end + {length("text")} as chars from t)
    select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by no)) as turns_sha256,
           coalesce(sum(length(text)) filter (where role in ({learned})), 0)::bigint as loss_chars, sha256(coalesce(string_agg(text, '' order by no) filter (where role in ({learned})), '')) as loss_sha256,
           sum(chars)::bigint as formatted_chars, bool_and(case when no = 1 then role in ({starts}) else {moves} end) and coalesce(bool_and(role in ({ends})) filter (where no = n), false) as valid
    from u group by conv_id"""
