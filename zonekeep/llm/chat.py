"""Chat formatting by schema fingerprints.

A record is JSON text.  The hash of its sorted nested field paths selects a
declared mapping, which lists where the turns are and how their roles are
named; so prompt, instruction and message layouts all become the same turns.
Turns are written as

    <|turn|>ROLE<|text|>TEXT<|end|>

and every ``<``, backslashes, ``|`` inside a role or text gets one backslash
more, which reading takes away again: no text can hold a control string.  The
loss mask is the text of assistant turns.

Defined results: null texts, roles and contents are empty; a record that is
null, no JSON or of an unknown layout gives no turns but one row that says so;
turns of a conversation are ordered by turn (null last), then role and text.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, BODY, CLOSE = "<|turn|>", "<|text|>", "<|end|>"
_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(OPEN) + r"(.*?)" + re.escape(BODY) + r"(.*?)" + re.escape(CLOSE), re.DOTALL)


@dataclass(frozen=True)
class Mapping:
    """Where a layout holds its turns: a list of objects, or fields of the record, each with its role."""

    name: str
    paths: tuple[str, ...]
    items: str | None = None
    role: str | None = None
    content: str | None = None
    fields: tuple[tuple[str, str], ...] = ()
    roles: dict[str, str] = field(default_factory=dict)
    joined: str = "\n\n"


#: Roles by the names that layouts use for them.
ROLE_NAMES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
MAPPINGS = (
    Mapping("turn", ("role", "text", "turn"), role="role", content="text"),
    Mapping("messages", ("messages", "messages[]", "messages[].content", "messages[].role"), "messages", "role", "content", roles=ROLE_NAMES),
    Mapping("messages", ("messages", "messages[]", "messages[].content", "messages[].name", "messages[].role"), "messages", "role", "content", roles=ROLE_NAMES),
    Mapping("conversations", ("conversations", "conversations[]", "conversations[].from", "conversations[].value"), "conversations", "from", "value", roles=ROLE_NAMES),
    Mapping("prompt", ("completion", "prompt"), fields=(("user", "prompt"), ("assistant", "completion"))),
    Mapping("prompt", ("prompt", "response"), fields=(("user", "prompt"), ("assistant", "response"))),
    Mapping("question", ("answer", "question"), fields=(("user", "question"), ("assistant", "answer"))),
    Mapping("instruction", ("instruction", "output"), fields=(("user", "instruction"), ("assistant", "output"))),
    Mapping("instruction", ("input", "instruction", "output"), fields=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Mapping("instruction", ("input", "instruction", "output", "system"), fields=(("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output"))),
)


def field_paths(value, at: str = "") -> set[str]:
    """Nested field paths of a JSON value; the items of a list share one path."""
    if isinstance(value, dict):
        out = set()
        for k, v in value.items():
            path = f"{at}.{k}" if at else k
            out |= {path} | field_paths(v, path)
        return out
    if isinstance(value, list):
        return {f"{at}[]"}.union(*(field_paths(v, f"{at}[]") for v in value)) if value else set()
    return set()


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def read_turns(record, mappings: dict[str, Mapping]) -> tuple[str, list[tuple[str, str]] | None]:
    """Fingerprint of a parsed record, and its turns (None: unknown layout)."""
    mark = fingerprint(field_paths(record)) if isinstance(record, dict) else ""
    m = mappings.get(mark)
    if m is None:
        return mark, None
    text = lambda v: "" if v is None else v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)
    if m.items is not None:
        return mark, [(m.roles.get(text(i.get(m.role)), text(i.get(m.role))), text(i.get(m.content))) for i in record[m.items]]
    if m.role is not None:
        return mark, [(text(record[m.role]), text(record[m.content]))]
    turns: list[tuple[str, str]] = []
    for role, name in m.fields:
        content = text(record[name])
        if turns and turns[-1][0] == role:  # an instruction and its input are one turn
            turns[-1] = role, m.joined.join(x for x in (turns[-1][1], content) if x)
        elif content or role != "system":
            turns.append((role, content))
    return mark, turns


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def format_turn(role: str, text: str) -> str:
    return f"{OPEN}{escape(role)}{BODY}{escape(text)}{CLOSE}"


def read_back(formatted: str) -> list[tuple[str, str, int, int]]:
    """Role, text, and the place of the written text, of each turn of formatted text."""
    return [(unescape(m[1]), unescape(m[2]), m.start(2), m.end(2)) for m in _TURN.finditer(formatted)]


def format_records(records: DataFrame, record: str = "record", keep: tuple[str, ...] = (), mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """Adds schema_mark, n_turns, formatted and loss (array of code point ranges) to the ``keep`` columns of a table of JSON records."""
    schema = "".join(f"`{c}` {records.schema[c].dataType.simpleString()}, " for c in keep)
    schema += "schema_mark string, n_turns long, formatted string, loss array<array<int>>"
    names = [*keep, "schema_mark", "n_turns", "formatted", "loss"]
    by_mark = {fingerprint(m.paths): m for m in mappings}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks, counts, texts, masks = [], [], [], []
            for raw in batch.column(len(keep)):
                try:
                    parsed = json.loads(raw.as_py() or "null")
                except ValueError:
                    parsed = None
                mark, turns = read_turns(parsed, by_mark)
                out, at, mask = [], 0, []
                for role, text in turns or []:
                    piece = format_turn(role, text)
                    if role == "assistant":
                        mask.append([at + len(piece) - len(CLOSE) - len(escape(text)), at + len(piece) - len(CLOSE)])
                    out.append(piece)
                    at += len(piece)
                marks.append(mark)
                counts.append(None if turns is None else len(turns))
                texts.append(None if turns is None else "".join(out))
                masks.append(mask)
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(marks, pa.string()), pa.array(counts, pa.int64()), pa.array(texts, pa.string()), pa.array(masks, pa.list_(pa.list_(pa.int32())))], names=names)

    return records.select(*keep, record).mapInArrow(run, schema)


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, turn, formatted, loss: each row of ``turns`` (conv_id, turn, role, text) as its stretch of the conversation's output.

    The output of a conversation is its stretches in order; it is never held as one value, so a conversation of any length is written.
    """
    record = F.to_json(F.struct("turn", "role", "text"), {"ignoreNullFields": "false"})
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return format_records(rows.withColumn("record", record), keep=("conv_id", "turn", "role", "text")).drop("schema_mark", "n_turns")


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Per conversation what reading its formatted stretches back in order gives: counts and digests."""
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_last(), "role", "text").select("conv_id", "formatted", "loss")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, rows = object(), None, []

        def flush() -> Iterator[pa.RecordBatch]:
            if rows:
                columns = list(zip(*rows, strict=True))
                types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[x.split()[0] for x in schema.split(", ")])
                rows.clear()

        def close() -> None:
            if state is not None:
                rows.append((now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        for batch in batches:
            for conv, text, mask in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if state is None or conv != now:
                    close()
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said, _, _ in read_back(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                for begin, end in mask:
                    said = unescape(text[begin:end])
                    state[2] += len(said)
                    state[3].update(said.encode())
                state[4] += len(text)
            if len(rows) >= 4096:
                yield from flush()
        close()
        yield from flush()

    return ordered.mapInArrow(run, schema)
