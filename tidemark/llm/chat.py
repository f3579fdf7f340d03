"""Chat formatting: the nested field paths of a record are hashed, the hash selects a declarative mapping to canonical
turns, and a template writes the turns with a loss mask over the assistant's words.

Control strings inside texts are broken up by a backslash after their first character (backslashes are doubled), so
marks in the output are always marks of the template and every text comes back as it was.

Input cases: a null text or role is an empty one; turns of a conversation go by their number (missing numbers first),
then by role and text, so equal and repeated rows have one order; conversations without an id are one conversation;
records of an unknown layout give one row with no layout and no role, so that nothing vanishes; an empty table gives an
empty result. A conversation passes through its task turn by turn and is never held whole.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tables

# Strings that chat templates and tokenizers take as marks.
CONTROL = ["<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
START, END = "<|im_start|>", "<|im_end|>"
# Names that layouts give to the canonical roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))


@dataclass(frozen=True)
class Layout:
    """How records with these field paths become turns.

    ``turns`` lists (role, paths whose non-empty texts are joined); ``items`` names a list with the fields of role and
    text; ``row`` names the fields of number, role and text of a record that is one turn.
    """

    name: str
    paths: tuple[str, ...]
    optional: tuple[str, ...] = ()
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    items: tuple[str, str, str] | None = None
    row: tuple[str, str, str] | None = None
    rename: dict[str, str] = field(default_factory=dict, hash=False)


LAYOUTS = [
    Layout("turn row", ("turn", "role", "text"), row=("turn", "role", "text")),
    Layout("messages", ("messages", "messages[].role", "messages[].content"), items=("messages", "role", "content")),
    Layout(
        "from and value",
        ("conversations", "conversations[].from", "conversations[].value"),
        ("system",),
        turns=(("system", ("system",)),),
        items=("conversations", "from", "value"),
        rename=ROLES,
    ),
    Layout(
        "instruction",
        ("instruction", "output"),
        ("input", "system"),
        turns=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))),
    ),
    Layout("prompt and completion", ("prompt", "completion"), turns=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("prompt and response", ("prompt", "response"), turns=(("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("question and answer", ("question", "answer"), turns=(("user", ("question",)), ("assistant", ("answer",)))),
]


def field_paths(value: object, at: str = "") -> set[str]:
    """Nested paths of the fields of a record; elements of lists share a path."""
    if isinstance(value, dict):
        found = set()
        for key, inner in value.items():
            path = f"{at}.{key}" if at else key
            found |= {path} | field_paths(inner, path)
        return found
    if isinstance(value, list):
        return {p for inner in value for p in field_paths(inner, f"{at}[]")}
    return set()


def fingerprint(paths: set[str] | tuple[str, ...]) -> str:
    return hashlib.blake2b("\n".join(sorted(paths)).encode(), digest_size=8).hexdigest()


def fingerprints(layouts: list[Layout]) -> dict[str, Layout]:
    """Layout by fingerprint, with each choice of its optional fields."""
    found = {}
    for layout in layouts:
        for n in range(len(layout.optional) + 1):
            for extra in combinations(layout.optional, n):
                found[fingerprint(layout.paths + extra)] = layout
    return found


def _text(value: object) -> str:
    return value if isinstance(value, str) else "" if value is None else json.dumps(value, ensure_ascii=False)


def turns_of(record: dict, layout: Layout) -> list[tuple[int | None, str, str]]:
    """(number, role, text) of the turns of one record; a value that cannot be one is a ``ValueError``."""
    found: list[tuple[int | None, str, str]] = []
    if layout.row:
        number, role, text = (record.get(k) for k in layout.row)
        if number is not None and (type(number) is not int or not -(1 << 63) <= number < 1 << 63):
            raise ValueError("turn is no 64-bit number")
        return [(number, _text(role), _text(text))]
    for role, paths in layout.turns:
        present = [_text(record[p]) for p in paths if p in record]
        if present:
            found.append((len(found), role, "\n".join([x for x in present if x])))
    if layout.items:
        name, role, text = layout.items
        for i, item in enumerate(record[name]):
            if not isinstance(item, dict):
                raise ValueError(f"item {i} of {name} has no fields")
            said = _text(item.get(role))
            found.append((len(found), layout.rename.get(said, said), _text(item.get(text))))
    return found


TURNS = "conv_id long, turn long, role string, text string, layout string, fingerprint string, reason string"


def rows_of(text: str | None, known: dict[str, Layout]) -> list[tuple]:
    """Rows (turn, role, text, layout, fingerprint, reason) of one record; a bad one is one row that says why."""
    mark = None
    try:
        record = json.loads(text) if text else None
        mark = fingerprint(field_paths(record))
        layout = known.get(mark) if isinstance(record, dict) else None
        if layout is None:
            raise ValueError("unknown layout" if isinstance(record, dict) else "no record")
        turns = turns_of(record, layout)
        for turn in turns:
            "".join(turn[1:]).encode()  # lone surrogates are no text
        return [(*turn, layout.name, mark, None) for turn in turns]
    except json.JSONDecodeError:
        reason = "no JSON"
    except UnicodeEncodeError:
        reason = "lone surrogate"
    except RecursionError:
        reason = "nested too deeply"
    except ValueError as error:
        reason = str(error)
    return [(None, None, text, None, mark, reason)]


def canonical_turns(records: DataFrame, layouts: list[Layout] = LAYOUTS) -> DataFrame:
    """Turns from ``conv_id`` and ``record`` (JSON text of one record).

    A record that cannot be read is one row without a turn, with its text and the ``reason``: no JSON, no record (null,
    empty, a list), an unknown layout, list items that are no objects, a turn that is no 64-bit number, text that is
    not Unicode, or nesting beyond what the reader of JSON takes.
    """
    known = fingerprints(layouts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in TURNS.split(", ")]
        kinds = [pa.int64(), pa.int64(), *[pa.string()] * 5]
        for batch in batches:
            pairs = zip(batch.column("conv_id").to_pylist(), batch.column("record").to_pylist())
            rows = [(conv, *row) for conv, text in pairs for row in rows_of(text, known)]
            columns = list(zip(*rows)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return records.select("conv_id", "record").mapInArrow(run, TURNS)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def _role(role: str) -> str:
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def _unrole(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


def write_turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn as the template writes it, and the range of code points that loss is taken on."""
    head, body = f"{START}{_role(role)}\n", escape(text)
    loss = (len(head), len(head) + len(body)) if role == "assistant" else (0, 0)
    return f"{head}{body}{END}\n", *loss


_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.S)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts back from formatted turns; anything between them is an error."""
    found, at = [], 0
    for match in _TURN.finditer(formatted):
        if match.start() != at:
            raise ValueError(f"no turn starts at {at}")
        at = match.end()
        found.append((_unrole(match[1]), unescape(match[2])))
    if at != len(formatted):
        raise ValueError(f"no turn starts at {at}")
    return found


FORMATTED = "conv_id long, turn long, formatted string, loss_start int, loss_end int"


def format_turns(turns: DataFrame) -> DataFrame:
    """One row per turn, conversations together and in order: their ``formatted`` parts joined are the conversation.

    Loss is taken on the code points from ``loss_start`` to ``loss_end`` of a part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles, texts = batch.column("role").to_pylist(), batch.column("text").to_pylist()
            made = [write_turn(r or "", t or "") for r, t in zip(roles, texts)]
            text, start, end = zip(*made) if made else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), pa.array(text, pa.string())]
                + [pa.array(x, pa.int32()) for x in (start, end)],
                names=["conv_id", "turn", "formatted", "loss_start", "loss_end"],
            )

    ordered = turns.select("conv_id", "turn", "role", "text").repartition("conv_id")
    return ordered.sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, FORMATTED)


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


class _Digest:
    """Running digests of one conversation, read from its formatted parts."""

    def __init__(self, conv: int | None):
        self.conv, self.n, self.loss_chars, self.chars = conv, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, start: int, end: int) -> None:
        for role, text in read_turns(formatted):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n += 1
        under = unescape(formatted[start:end])
        self.loss.update(under.encode())
        self.loss_chars += len(under)
        self.chars += len(formatted)

    def row(self) -> tuple:
        return self.conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation; expects the order of ``format_turns`` and keeps one conversation's state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Digest | None = None
        names = [x.split()[0] for x in DIGESTS.split(", ")]
        kinds = [pa.string() if x.endswith(" string") else pa.int64() for x in DIGESTS.split(", ")]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            done = []
            for conv, text, start, end in zip(
                *(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end"))
            ):
                if now is None or now.conv != conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Digest(conv)
                now.add(text, start, end)
            if done:
                yield batch_of(done)
        if now is not None:
            yield batch_of([now.row()])

    return formatted.mapInArrow(run, DIGESTS)


def op7_chat_formatting(spark, sf_dir: str) -> DataFrame:
    rows = tables.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    record = F.to_json(F.struct("turn", "role", "text"), {"ignoreNullFields": "false"})
    records = rows.unionByName(extra).select("conv_id", record.alias("record"))
    return read_back(format_turns(canonical_turns(records)))
