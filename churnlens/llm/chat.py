r"""Chat formatting with a grammar that is read back.

A conversation is a sequence of turns. A turn is

    <s>[INST]text</s>                 user
    <s>[/INST]text</s>                assistant
    <s>[ROLE]role[/ROLE]text</s>      any other role

Control strings inside texts and roles get a backslash after their first
character; those that already look escaped get one more, so that taking one
away restores the text. A turn is rendered as it is, parsed, and compared; only
where the parse differs is the conflicting content escaped, until the turns
are identical.

A conversation's turns lie in one partition in their order and pass one at a
time, so a conversation may be of any length.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A control string, with any number of backslashes after its first character.
CONTROL = re.compile(r"([<\[])(\\*)(/?(?:INST|ROLE)\]|/?s>)")
ESCAPED = re.compile(r"([<\[])\\(\\*)(/?(?:INST|ROLE)\]|/?s>)")
END = "</s>"
TAGS = {"user": "<s>[INST]", "assistant": "<s>[/INST]"}


def escape(text: str) -> str:
    return CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2\3", text)


def _render(role: str, written_role: str, text: str) -> tuple[str, int]:
    """A turn and the offset of its text."""
    head = TAGS.get(role) or f"<s>[ROLE]{written_role}[/ROLE]"
    return f"{head}{text}{END}", len(head)


def parse(formatted: str) -> list[tuple[str, str]] | None:
    """Turns (role, text) of formatted text; None where it is not in the grammar."""
    turns, at = [], 0
    while at < len(formatted):
        role = next((r for r, tag in TAGS.items() if formatted.startswith(tag, at)), None)
        if role:
            at += len(TAGS[role])
        elif formatted.startswith("<s>[ROLE]", at) and (to := formatted.find("[/ROLE]", at)) >= 0:
            role, at = formatted[at + 9:to], to + 7
        else:
            return None
        to = formatted.find(END, at)
        if to < 0:
            return None
        turns.append((unescape(role), unescape(formatted[at:to])))
        at = to + len(END)
    return turns


def render_turn(role: str, text: str) -> tuple[str, int]:
    """Formatted turn and the offset of its text, parsing back to the source."""
    made = _render(role, role, text)
    if parse(made[0]) != [(role, text)]:
        made = _render(role, escape(role), escape(text))
        if parse(made[0]) != [(role, text)]:
            raise ValueError("an escaped turn does not parse back")
    return made


def format_turns(conversations: DataFrame) -> DataFrame:
    """A row per turn, in order within its partition: conv_id, position, segment
    (formatted text), start (its code point offset in the conversation's text),
    loss_start and loss_end (offsets of an assistant's text, else null).

    Turns are ordered by turn, role and text; repeated rows are turns of their
    own. A null text or role counts as empty; rows without conv_id form one
    conversation. Segments of a conversation joined in order are its text. An
    empty table gives an empty result; other columns are ignored.
    """
    kind = conversations.schema["conv_id"].dataType.simpleString()
    ordered = (conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                                    F.coalesce("text", F.lit("")).alias("text"))
               .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))

    def run(batches):
        now, position, start = _NEVER, 0, 0
        for batch in batches:
            out = [[] for _ in range(5)]
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if conv != now:
                    now, position, start = conv, 0, 0
                segment, at = render_turn(role, text)
                loss = (start + at, start + len(segment) - len(END)) if role == "assistant" else (None, None)
                for c, v in zip(out, (position, segment, start, *loss)):
                    c.append(v)
                position, start = position + 1, start + len(segment)
            yield pa.record_batch(
                [batch.column("conv_id")] + [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.string()) + (pa.int64(),) * 3)],
                names=["conv_id", "position", "segment", "start", "loss_start", "loss_end"])

    return ordered.mapInArrow(run, f"conv_id {kind}, position long, segment string, start long, loss_start long, loss_end long")


_NEVER = object()


def read_back(segments: DataFrame) -> DataFrame:
    """Digests of conversations, from the formatted text alone: conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars. Takes the
    rows of ``format_turns`` in their partitions and order."""
    kind = segments.schema["conv_id"].dataType.simpleString()

    def run(batches):
        now, state = _NEVER, None

        def row():
            n, turns, chars, loss, size = state
            return now, n, turns.hexdigest(), chars, loss.hexdigest(), size

        for batch in batches:
            out = []
            for conv, segment, start, a, b in zip(*(batch.column(c).to_pylist() for c in
                                                    ("conv_id", "segment", "start", "loss_start", "loss_end"))):
                if conv != now:
                    if state:
                        out.append(row())
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse(segment):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                if a is not None:
                    said = unescape(segment[a - start:b - start])
                    state[2] += len(said)
                    state[3].update(said.encode())
                state[4] += len(segment)
            yield _digests(out, batch.schema.field("conv_id").type)
        if state:
            yield _digests([row()], batch.schema.field("conv_id").type)

    return segments.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
                                    "loss_sha256 string, formatted_chars long")


def _digests(rows: list[tuple], kind) -> pa.RecordBatch:
    types = (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)


SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(regexp_replace(text, '([<\[])(\\*)(/?(?:INST|ROLE)\]|/?s>)', '\1\\\2\3', 'g'))
    + CASE role WHEN 'user' THEN 9 WHEN 'assistant' THEN 10
      ELSE 16 + length(regexp_replace(role, '([<\[])(\\*)(/?(?:INST|ROLE)\]|/?s>)', '\1\\\2\3', 'g')) END + 4 AS size FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(size) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""
