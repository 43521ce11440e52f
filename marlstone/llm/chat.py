"""Chat formatting from event logs.

A log holds events of conversations: (conv_id, seq, kind, message_id, role, text). Kinds: "open" starts a message (and may carry
text), "delta" adds streamed text, "edit" replaces the text, "regenerate" empties it for new deltas, "delete" removes the
message. The log is partitioned by conversation and message and sorted by sequence, and each message is folded while it streams
by; the final messages, sorted within their conversation, are rendered to parts of bounded size. All three steps stream over
sorted partitions: no conversation is ever held whole, and Spark's sort spills.

The template puts each message between the two marks of its role. Control strings inside texts are broken by an escape that
can be undone, so the marks in the output are only the template's. Loss falls on the texts of assistants.

Defined results: null text is empty; a null role is an empty role; events without conversation id form one conversation of id
null; null sequence numbers come first; ties are ordered by kind, role and text, and repeated message events are kept as
messages of their own when they have ids of their own; events for a message that was never opened open it with an empty role.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import col


@dataclass(frozen=True)
class Template:
    """Marks before and after a message, by role; any other role is written after `other` and up to `other_end`."""

    marks: dict[str, tuple[str, str]] = field(default_factory=lambda: {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")})
    other: str = "[ROLE]"
    role_end: str = "[:ROLE]"
    other_end: str = "[/ROLE]"

    @property
    def controls(self) -> list[str]:
        return sorted({m for pair in self.marks.values() for m in pair} | {self.other, self.role_end, self.other_end}, key=len, reverse=True)

    def escape(self, text: str) -> str:
        """A backslash is doubled; a control string gets backslash and minus after its first character."""
        return re.sub("|".join(map(re.escape, self.controls)), lambda m: m[0][0] + "\\-" + m[0][1:], text.replace("\\", "\\\\"))

    def unescape(self, text: str) -> str:
        return re.sub(r"\\([\\-])", lambda m: "\\" if m[1] == "\\" else "", text)

    def render(self, role: str, text: str) -> tuple[str, int, int]:
        """The formatted message, and where its escaped text starts and ends in it."""
        begin, end = self.marks.get(role) or (self.other + self.escape(role) + self.role_end, self.other_end)
        body = self.escape(text)
        return begin + body + end, len(begin), len(begin) + len(body)

    def parse(self, formatted: str) -> Iterator[tuple[str, str]]:
        """(role, text) of each message, the inverse of render."""
        roles = {begin: (role, end) for role, (begin, end) in self.marks.items()}
        pos = 0
        begins = re.compile("|".join(map(re.escape, [*roles, self.other])))
        while pos < len(formatted):
            m = begins.match(formatted, pos)
            if not m:
                raise ValueError(f"no mark at {pos}")
            if m[0] == self.other:
                mid = formatted.index(self.role_end, m.end())
                role, at, end = self.unescape(formatted[m.end() : mid]), mid + len(self.role_end), self.other_end
            else:
                (role, end), at = roles[m[0]], m.end()
            stop = formatted.index(end, at)
            yield role, self.unescape(formatted[at:stop])
            pos = stop + len(end)


TEMPLATE = Template()
#: Characters after which a part of a conversation is closed.
PART_CHARS = 4_000_000
EVENT_COLUMNS = ("conv_id", "seq", "kind", "message_id", "role", "text")


def _stream(df: DataFrame, schema: T.StructType, rows):
    """df through rows(iterator of tuples) -> iterator of tuples, in batches of bounded size."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each():
            for b in batches:
                yield from zip(*[c.to_pylist() for c in b.columns])

        ready, size = [], 0
        for row in rows(each()):
            ready.append(row)
            size += 64 + sum(len(x) for x in row if isinstance(x, str))
            if size > 8_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*ready), arrow.types)], schema=arrow)
                ready, size = [], 0
        if ready:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*ready), arrow.types)], schema=arrow)

    return df.mapInArrow(run, schema)


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, pos, message_id, role, text) of an event log; pos is the sequence number that opened the message."""
    f = {s.name: s for s in events.schema.fields}
    schema = T.StructType([f["conv_id"], T.StructField("pos", f["seq"].dataType), f["message_id"], T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
    order = F.when(F.col("kind") == "open", 0).when(F.col("kind") == "regenerate", 1).when(F.col("kind") == "edit", 2).when(F.col("kind") == "delta", 3).otherwise(4)
    dealt = events.select(*EVENT_COLUMNS).repartition("conv_id", "message_id").sortWithinPartitions("conv_id", "message_id", "seq", order, "role", "text")

    def rows(events):
        now, open_ = None, None
        for conv, seq, kind, message, role, text in events:
            if (conv, message) != now:
                if open_:
                    yield (*open_[:4], "".join(open_[4]))
                now, open_ = (conv, message), None
            if kind == "delete":
                open_ = None
                continue
            if open_ is None:
                open_ = [conv, seq, message, "", []]
            if role is not None and kind == "open":
                open_[3] = role
            if kind in ("edit", "regenerate"):
                open_[4] = []
            if kind != "regenerate" and text:
                open_[4].append(text)
        if open_:
            yield (*open_[:4], "".join(open_[4]))

    return _stream(dealt, schema, rows)


def render(messages: DataFrame, template: Template = TEMPLATE, part_chars: int = PART_CHARS, loss_role: str = "assistant") -> DataFrame:
    """(conv_id, part, formatted, loss_starts, loss_ends): conversations as text, in parts of whole messages; offsets are code points in the part."""
    fed = messages.select("conv_id", "pos", "message_id", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "pos", "role", "text", "message_id")
    ints = T.ArrayType(T.LongType())
    schema = T.StructType([fed.schema.fields[0], T.StructField("part", T.IntegerType()), T.StructField("formatted", T.StringType()), T.StructField("loss_starts", ints), T.StructField("loss_ends", ints)])

    def rows(messages):
        now, part, out, size, a, b, any_ = None, 0, [], 0, [], [], False
        for conv, _, _, role, text in messages:
            if any_ and (conv != now or size >= part_chars):
                yield now, part, "".join(out), a, b
                out, size, a, b = [], 0, [], []
                part = part + 1 if conv == now else 0
            now, any_ = conv, True
            done, begin, end = template.render(role or "", text or "")
            if role == loss_role:
                a.append(size + begin)
                b.append(size + end)
            out.append(done)
            size += len(done)
        if any_:
            yield now, part, "".join(out), a, b

    return _stream(fed, schema, rows)


def read_back(formatted: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """What the rendered parts say: per conversation the turns, their digest, the text under the loss mask and the size.

    Parts must come as render left them, the parts of a conversation in order in one partition.
    """
    schema = T.StructType([formatted.schema["conv_id"], *(T.StructField(n, T.StringType() if "sha" in n else T.LongType()) for n in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"))])

    def rows(parts):
        now, state = None, None
        for conv, part, text, starts, ends in parts:
            if part == 0 or state is None:
                if state:
                    yield now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]
                now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, said in template.parse(text):
                state[0] += 1
                state[1].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
            for a, b in zip(starts, ends):
                said = template.unescape(text[a:b])
                state[2] += len(said)
                state[3].update(said.encode("utf-8", "surrogatepass"))
            state[4] += len(text)
        if state:
            yield now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

    return _stream(formatted, schema, rows)


def events_of(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Stored turns as an event log: each turn opens a message and streams its text in one delta.

    A message's id is made of its turn and a number of its own, so that repeated turns stay apart.
    """
    base = turns.select(col(conv_col).alias("conv_id"), col(turn_col).alias("seq"), F.concat_ws(":", col(turn_col).cast("string"), F.monotonically_increasing_id().cast("string")).alias("message_id"), col(role_col).alias("role"), col(text_col).alias("text"))
    steps = F.array(F.struct(F.lit("open").alias("kind"), F.col("role"), F.lit(None).cast("string").alias("text")), F.struct(F.lit("delta").alias("kind"), F.lit(None).cast("string").alias("role"), F.col("text")))
    return base.select("conv_id", "seq", "message_id", F.explode(steps).alias("e")).select("conv_id", "seq", "e.kind", "message_id", "e.role", "e.text")
