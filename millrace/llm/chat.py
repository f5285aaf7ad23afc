"""Chat formatting: heterogeneous records to canonical turns, and turns to a template with a loss mask.

**Layouts.** The nested field paths of a record that belong to the vocabulary of some layout are hashed; the
fingerprint selects a declarative mapping (`LAYOUTS`). Other fields play no part. A record whose fingerprint
selects nothing gives one row without a turn and with a null layout, so it is not lost silently.

**Template.** ``### <role>\\n<text>\\n</turn>\\n`` for each turn. In roles and texts a backslash, ``#``, ``<`` and, in roles,
a line end are escaped by a backslash and a letter, so no control string can occur inside, and it reads back exactly.

The loss mask is the text of the assistant's turns. Turns come by turn number, then role, then text; nulls come
first. Null roles and texts are empty. Repeated rows are turns each. A null conversation id is one conversation.
Conversations stream through a sorted partition, a turn in memory at a time, so a conversation may be of any length.
"""

from __future__ import annotations

import hashlib
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import record_batch

# Each layout: the field paths that make it, and where the turns are. A turn is (role, path); "each" walks a list.
LAYOUTS = [
    {"name": "turn rows", "paths": ["role", "text"], "turns": [("@role", "text")]},
    {"name": "prompt and completion", "paths": ["prompt", "completion"], "turns": [("user", "prompt"), ("assistant", "completion")]},
    {"name": "prompt and response", "paths": ["prompt", "response"], "turns": [("user", "prompt"), ("assistant", "response")]},
    {"name": "system, prompt and response", "paths": ["system", "prompt", "response"],
     "turns": [("system", "system"), ("user", "prompt"), ("assistant", "response")]},
    {"name": "question and answer", "paths": ["question", "answer"], "turns": [("user", "question"), ("assistant", "answer")]},
    {"name": "instruction", "paths": ["instruction", "output"], "turns": [("user", "instruction"), ("assistant", "output")]},
    {"name": "instruction with input", "paths": ["instruction", "input", "output"],
     "turns": [("user", "instruction+input"), ("assistant", "output")]},
    {"name": "messages", "paths": ["messages[].role", "messages[].content"], "each": "messages", "role": "role", "text": "content"},
    {"name": "conversations", "paths": ["conversations[].from", "conversations[].value"], "each": "conversations", "role": "from",
     "text": "value"},
]
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
VOCABULARY = {path for layout in LAYOUTS for path in layout["paths"]}


def fingerprint(paths) -> str:
    """Hash of the known field paths, whatever their order."""
    return hashlib.sha256("\n".join(sorted(set(paths) & VOCABULARY)).encode()).hexdigest()


BY_FINGERPRINT = {fingerprint(layout["paths"]): layout for layout in LAYOUTS}


def record_paths(value, at: str = "") -> set[str]:
    if isinstance(value, dict):
        return {p for k, v in value.items() for p in record_paths(v, f"{at}.{k}" if at else k)}
    if isinstance(value, list):
        return {p for v in value for p in record_paths(v, at + "[]")}
    return {at}


def schema_paths(kind: T.DataType, at: str = "") -> set[str]:
    if isinstance(kind, T.StructType):
        return {p for f in kind for p in schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name)}
    if isinstance(kind, T.ArrayType):
        return schema_paths(kind.elementType, at + "[]")
    return {at}


def as_text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def turns_of(record) -> tuple[str | None, list[tuple[str, str]]]:
    """Layout and canonical turns of a record."""
    layout = BY_FINGERPRINT.get(fingerprint(record_paths(record))) if isinstance(record, dict) else None
    if layout is None:
        return None, []
    role = lambda r: ROLES.get(as_text(r), as_text(r))
    if "each" in layout:
        return layout["name"], [(role(x.get(layout["role"])), as_text(x.get(layout["text"]))) for x in record[layout["each"]] if isinstance(x, dict)]
    out = []
    for who, path in layout["turns"]:
        who = role(record.get(who[1:])) if who[0] == "@" else who
        out.append((who, "\n".join(t for t in (as_text(record.get(p)) for p in path.split("+")) if t or "+" not in path)))
    return layout["name"], out


def canonical_turns(records: DataFrame, id_col: str, record_col: str | None = None) -> DataFrame:
    """Rows (conv_id, turn, role, text, layout).

    With ``record_col`` that column has a JSON record in each row, of any layout. Without, the frame's own schema is
    fingerprinted: its rows are turns (``role``, ``text`` and ``turn``), or whole records of columns.
    """
    if record_col is None:
        layout = BY_FINGERPRINT.get(fingerprint(schema_paths(records.schema)))
        if layout is None:
            raise ValueError(f"No layout has these columns: {', '.join(records.columns)}")
        if layout["name"] == "turn rows":
            return records.select(
                F.col(id_col).alias("conv_id"),
                F.col("turn").cast("long").alias("turn"),
                F.coalesce(F.col("role"), F.lit("")).alias("role"),
                F.coalesce(F.col("text"), F.lit("")).alias("text"),
                F.lit(layout["name"]).alias("layout"),
            )
        rows = records.select(id_col, F.to_json(F.struct(*[c for c in records.columns if c != id_col])).alias("record"))
        return canonical_turns(rows, id_col, "record")
    df = records.select(F.col(id_col).alias("conv_id"), F.col(record_col).alias("record"))

    def run(batches):
        for batch in batches:
            row, turn, roles, texts, layouts = [], [], [], [], []
            for i, record in enumerate(batch.column(1).to_pylist()):
                try:
                    layout, turns = turns_of(json.loads(record or "null"))
                except ValueError:
                    layout, turns = None, []
                for k, (role, text) in enumerate(turns) if turns else [(None, (None, None))]:
                    row.append(i)
                    turn.append(k)
                    roles.append(role)
                    texts.append(text)
                    layouts.append(layout)
            yield record_batch(
                conv_id=batch.column(0).take(pa.array(row, pa.int64())), turn=pa.array(turn, pa.int64()),
                role=pa.array(roles, pa.string()), text=pa.array(texts, pa.string()), layout=pa.array(layouts, pa.string()),
            )

    kind = df.schema["conv_id"].dataType.simpleString()
    return df.mapInArrow(run, f"conv_id {kind}, turn long, role string, text string, layout string")


# Fixed values of the template.
OPEN, CLOSE = "### ", "\n</turn>\n"
_ESCAPES = {"\\": "\\\\", "#": "\\h", "<": "\\l"}
_BACK = {"\\": "\\", "h": "#", "l": "<", "n": "\n"}
_TEXT = str.maketrans(_ESCAPES)
_ROLE = str.maketrans(_ESCAPES | {"\n": "\\n"})
_TURN = re.compile(r"### ([^\n]*)\n(.*?)\n</turn>\n", re.S)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _BACK[m[1]], text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn's piece of the output, and where its text is in it."""
    head = OPEN + role.translate(_ROLE) + "\n"
    body = text.translate(_TEXT)
    return head + body + CLOSE, len(head), len(head) + len(body)


FORMATTED = "conv_id {id}, place long, first long, piece string, loss_start long, loss_end long"


def format_chats(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """A row per turn: its place, its piece of the output, where that begins, and the span under the loss mask.

    The pieces of a conversation, joined by place, are its output. Rows of a conversation lie together and in order.
    """
    df = (
        turns.where("turn IS NOT NULL OR role IS NOT NULL OR text IS NOT NULL")
        .select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )

    def run(batches):
        conv, place, at = object(), 0, 0
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("place", "first", "piece", "loss_start", "loss_end")}
            for own, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if own != conv:
                    conv, place, at = own, 0, 0
                piece, start, end = format_turn(role, text)
                masked = role in loss_roles
                for key, value in zip(out, (place, at, piece, at + start if masked else None, at + end if masked else None)):
                    out[key].append(value)
                place, at = place + 1, at + len(piece)
            yield record_batch(
                conv_id=batch.column(0), **{k: pa.array(v, pa.string() if k == "piece" else pa.int64()) for k, v in out.items()}
            )

    return df.mapInArrow(run, FORMATTED.format(id=df.schema["conv_id"].dataType.simpleString()))


READ = "conv_id {id}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse the output again, piece by piece: a row of digests per conversation.

    ``formatted`` is the frame of `format_chats` itself, whose rows lie together by conversation.
    """

    def run(batches):
        conv, state, started = None, None, False

        def row():
            return conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

        def table(rows):
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
            return record_batch(
                conv_id=pa.array([r[0] for r in rows], kind),
                **{n: pa.array([r[i + 1] for r in rows], k) for i, (n, k) in enumerate(zip(names, kinds))},
            )

        for batch in batches:
            kind, rows = batch.column(0).type, []
            for own, first, piece, start, end in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5))):
                if not started or own != conv:
                    if started:
                        rows.append(row())
                    conv, state, started = own, [0, hashlib.sha256(), 0, hashlib.sha256(), 0], True
                for m in _TURN.finditer(piece):
                    state[0] += 1
                    state[1].update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode("utf-8", "surrogatepass"))
                if start is not None:
                    loss = unescape(piece[start - first : end - first])
                    state[2] += len(loss)
                    state[3].update(loss.encode("utf-8", "surrogatepass"))
                state[4] += len(piece)
            if rows:
                yield table(rows)
        if started:
            yield table([row()])

    return formatted.mapInArrow(run, READ.format(id=formatted.schema["conv_id"].dataType.simpleString()))
