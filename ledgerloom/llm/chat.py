"""Chat formatting: records of any known layout become canonical turns, then text in which turns are marked.

A record's layout is told by its schema fingerprint: a hash of the nested field paths that it holds. The fingerprint selects
a declarative mapping, which lists where the turns lie; no mapping has code. Turns are then written one segment each, with
control strings inside texts escaped so that they can be read back, and the places that a loss applies to.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.shared import widened

TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Turn:
    """One turn of a fixed role; its text is that of the paths, empty ones left out, with two line breaks between."""

    role: str
    paths: tuple[str, ...]


@dataclass(frozen=True)
class Turns:
    """One turn for each element of a list (or for the record itself, where ``each`` is empty). ``roles`` renames roles."""

    each: str
    role: str
    text: str
    roles: tuple[tuple[str, str], ...] = ()

    @property
    def paths(self) -> tuple[str, ...]:
        head = f"{self.each}[]." if self.each else ""
        return head + self.role, head + self.text


@dataclass(frozen=True)
class Layout:
    """A mapping: parts in the order of the conversation, and the paths that a record of the layout may lack."""

    name: str
    parts: tuple[Turn | Turns, ...]
    optional: tuple[str, ...] = ()

    @property
    def paths(self) -> set[str]:
        return {p for part in self.parts for p in part.paths}


_NAMED = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))
LAYOUTS = (
    Layout("turn", (Turns("", "role", "text"),)),
    Layout("messages", (Turns("messages", "role", "content"),)),
    Layout("message_parts", (Turns("messages", "role", "content[].text"),)),
    Layout("from_value", (Turn("system", ("system",)), Turns("conversations", "from", "value", _NAMED)), ("system",)),
    Layout("prompt_response", (Turn("system", ("system",)), Turn("user", ("prompt",)), Turn("assistant", ("response",))), ("system",)),
    Layout("prompt_completion", (Turn("user", ("prompt",)), Turn("assistant", ("completion",)))),
    Layout("question_answer", (Turn("user", ("question",)), Turn("assistant", ("answer",)))),
    Layout("instruction_output", (Turn("system", ("system",)), Turn("user", ("instruction", "input")), Turn("assistant", ("output",))), ("system", "input")),
)


def _key(name: str) -> str:
    return re.sub(r"([\\.\[])", r"\\\1", name)


def field_paths(value) -> set[str]:
    """Nested paths of all values, ``a.b`` for fields and ``a[]`` for elements; an empty list or object is a value."""
    found, waiting = set(), [("", value)]
    while waiting:
        at, value = waiting.pop()
        if isinstance(value, dict) and value:
            waiting.extend((f"{at}.{_key(k)}" if at else _key(k), v) for k, v in value.items())
        elif isinstance(value, list) and value:
            waiting.extend((f"{at}[]", v) for v in value)
        else:
            found.add(at)
    return found


def fingerprint(paths: Iterable[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode("utf-8", "surrogatepass")).hexdigest()[:16]


def registry(layouts: Sequence[Layout]) -> dict[str, Layout]:
    """The layout of each fingerprint; two layouts that share one are an error."""
    out: dict[str, Layout] = {}
    for layout in layouts:
        for n in range(len(layout.optional) + 1):
            for absent in combinations(layout.optional, n):
                if out.setdefault(mark := fingerprint(layout.paths - set(absent)), layout) is not layout:
                    raise ValueError(f"layouts {out[mark].name} and {layout.name} have the same paths")
    return out


def _values(value, path: str) -> list:
    """All values at a path, ``[]`` going through every element."""
    found = [value]
    for step in path.split("."):
        name, many = step.removesuffix("[]"), step.endswith("[]")
        found = [v[name] for v in found if isinstance(v, dict) and name in v]
        found = [x for v in found if isinstance(v, list) for x in v] if many else found
    return found


def _text(value, path: str) -> str:
    parts = (v if isinstance(v, str) else "" if v is None else json.dumps(v, ensure_ascii=False) for v in _values(value, path))
    return "".join(parts).encode("utf-8", "replace").decode()  # a lone surrogate has no UTF-8


def turns_of(record, layout: Layout) -> list[tuple[str, str]]:
    """The canonical turns (role, text); an absent or empty optional turn is none."""
    out = []
    for part in layout.parts:
        if isinstance(part, Turns):
            names = dict(part.roles)
            for one in _values(record, f"{part.each}[]") if part.each else [record]:
                role = _text(one, part.role)
                out.append((names.get(role, role), _text(one, part.text)))
        else:
            text = "\n\n".join(filter(None, (_text(record, p) for p in part.paths)))
            if text or not set(part.paths) <= set(layout.optional):
                out.append((part.role, text))
    return out


def canonical(records: DataFrame, record_col: str = "record", layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """``records`` (JSON texts) with fingerprint, layout and turns in place of the record.

    Only paths that some layout names count, so further fields of a record don't matter. A record of no known layout, an
    unreadable or null one keeps its row with null layout and turns. Null roles and texts are empty, other values that are
    no text become their JSON. Repeated rows stay; columns of the three names are replaced, others pass. A record is worked
    on alone, whatever its length.
    """
    known, by_mark = set().union(*(x.paths for x in layouts)), registry(layouts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        for whole in batches:
            for low in range(0, whole.num_rows, 1024):
                batch = whole.slice(low, 1024)
                marks, names, turns = [], [], []
                for raw in batch.column(batch.schema.get_field_index(record_col)).to_pylist():
                    try:
                        record = json.loads(raw) if raw is not None else None
                    except (ValueError, RecursionError):
                        record = None
                    mark = fingerprint(field_paths(record) & known) if record is not None else None
                    layout = by_mark.get(mark)
                    marks.append(mark)
                    names.append(layout.name if layout else None)
                    turns.append([{"role": r, "text": t} for r, t in turns_of(record, layout)] if layout else None)
                keep = [(n, batch.column(k)) for k, n in enumerate(batch.schema.names) if n != record_col]
                made = [pa.array(marks, pa.string()), pa.array(names, pa.string()), pa.array(turns, kind)]
                yield pa.RecordBatch.from_arrays([c for _, c in keep] + made, names=[n for n, _ in keep] + ["fingerprint", "layout", "turns"])

    kept = records.drop(*[c for c in ("fingerprint", "layout", "turns") if c != record_col])
    return kept.mapInArrow(run, widened(kept.drop(record_col), fingerprint="string", layout="string", turns=TURNS))


@dataclass(frozen=True)
class Template:
    """Marks of a turn, further strings that a text must not hold plain, and the roles that are learned.

    Escaping doubles the escape character and puts one behind the first character of every control string.
    """

    start: str = "<|im_start|>"
    middle: str = "<|im_sep|>"
    end: str = "<|im_end|>"
    others: tuple[str, ...] = ("<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    escape: str = "\\"
    learned: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        if len(self.escape) != 1 or any(self.escape in c or len(c) < 2 for c in self.controls):
            raise ValueError("the escape must be one character, control strings longer and without it")
        if any(mark[:k] == mark[-k:] for mark in (self.middle, self.end) for k in range(1, len(mark))):
            raise ValueError("a mark that ends as it begins could be found too early")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.start, self.middle, self.end, *self.others)

    def escaped(self, text: Column) -> Column:
        inside = "|".join(re.escape(c) for c in self.controls)
        doubled = F.replace(text, F.lit(self.escape), F.lit(self.escape * 2))
        return F.regexp_replace(doubled, f"(?s)(?=(?:{inside}))(.)", "$1" + re.sub(r"([\\$])", r"\\\1", self.escape))

    def plain(self, text: str) -> str:
        return re.sub(re.escape(self.escape) + "(.)", r"\1", text, flags=re.DOTALL)

    @cached_property
    def turn(self) -> re.Pattern:
        return re.compile(f"{re.escape(self.start)}(.*?){re.escape(self.middle)}(.*?){re.escape(self.end)}", re.DOTALL)

    def read(self, formatted: str) -> list[tuple[str, str]]:
        """The turns of a formatted text; anything beside them is an error."""
        out, at = [], 0
        for found in self.turn.finditer(formatted):
            if found.start() != at:
                break
            out.append((self.plain(found[1]), self.plain(found[2])))
            at = found.end()
        if at != len(formatted):
            raise ValueError(f"no turn at {at}")
        return out


def _named(key: Sequence[str], names: Sequence[str], results: Sequence[str]) -> list[Column]:
    return [F.col(n).alias(f"key_{c}" if c in results else c) for c, n in zip(key, names)]


def formatted(turns: DataFrame, key: Sequence[str], order: Sequence[str], template: Template = Template()) -> DataFrame:
    """Segments whose concatenation, by ``turn``, is each conversation's formatted text: key, turn (from 0), start (code
    points of the conversation before it), segment, loss_start and loss_length (the learned text's place in the
    conversation; null for other roles).

    ``turns`` has a row per record with its ``turns`` array; records of one key form a conversation, by ``order``, then role
    and text, nulls first. A null key is a key. Rows whose turns are null or empty add nothing. A conversation is never held
    whole: it is sorted and summed as a stream, so it may be longer than memory. Repeated rows are turns of their own; other
    columns are left out, and a key that bears a result's name gets ``key_`` before it. The rows of a conversation come
    together and in order.
    """
    keys, orders = [f"_key{k}" for k in range(len(key))], [f"_order{k}" for k in range(len(order))]
    named = [F.col(c).alias(n) for c, n in zip([*key, *order], [*keys, *orders])]
    each = turns.select(*named, F.posexplode("turns").alias("place", "turn")).select(*keys, *orders, "place", "turn.role", "turn.text")
    role, text = (template.escaped(F.coalesce(c, F.lit(""))) for c in ("role", "text"))
    head = F.concat(F.lit(template.start), role, F.lit(template.middle))
    marked = each.withColumns({"head": head, "body": text}).withColumn("segment", F.concat("head", "body", F.lit(template.end)))
    marked = marked.withColumn("skip", F.length("head")).drop("head")
    # records of equal order are told apart by what they say; a record's turns keep their places
    run = Window.partitionBy(*keys).orderBy(*[F.asc_nulls_first(c) for c in orders], "place", "role", "text")
    before = F.coalesce(F.sum(F.length("segment").cast("long")).over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = marked.repartition(*keys).select("*", (F.row_number().over(run) - 1).cast("long").alias("n"), before.alias("start"))
    learned = F.coalesce(F.col("role").isin(*template.learned), F.lit(False))
    return placed.sortWithinPartitions(*keys, "n").select(
        *_named(key, keys, ("turn", "start", "segment", "loss_start", "loss_length")), F.col("n").alias("turn"), "start", "segment",
        F.when(learned, F.col("start") + F.col("skip")).alias("loss_start"),
        F.when(learned, F.length("body").cast("long")).alias("loss_length"))


def read_back(segments: DataFrame, key: Sequence[str], template: Template = Template(), together: bool = False) -> DataFrame:
    """One row per conversation, read from its segments: key, n_turns, turns_sha256 (role, line break, text, line break of
    each turn), loss_chars and loss_sha256 (of the unescaped text under the loss), formatted_chars.

    ``together`` says that rows come as ``formatted`` returns them; else they are dealt by key and sorted. Only a
    conversation's running digests are held. No segments give no rows; a segment that is no whole turn is an error. A key
    that bears a result's name gets ``key_`` before it.
    """
    names = [f"_key{k}" for k in range(len(key))]
    rows = segments.select(*[F.col(c).alias(n) for c, n in zip(key, names)], "turn", "start", "segment", "loss_start", "loss_length")
    if not together:
        rows = rows.repartition(*names).sortWithinPartitions(*names, "turn")
    result = {"n_turns": "long", "turns_sha256": "string", "loss_chars": "long", "loss_sha256": "string", "formatted_chars": "long"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []

        def closed() -> pa.RecordBatch:
            done = [(*k, n, t.hexdigest(), c, l.hexdigest(), chars) for k, n, t, c, l, chars in out]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*done), fields)], schema=fields)

        fields = None
        for batch in batches:
            if fields is None:
                kinds = {"long": pa.int64(), "string": pa.string()}
                fields = pa.schema([*[batch.schema.field(n) for n in names], *[(n, kinds[t]) for n, t in result.items()]])
            for *ident, _, start, segment, at, size in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or ident != now[0]:
                    if now is not None:
                        out.append(now)
                    now = [ident, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in template.read(segment):
                    now[1] += 1
                    now[2].update(f"{role}\n{text}\n".encode())
                if at is not None:
                    under = template.plain(segment[at - start : at - start + size])
                    now[3] += len(under)
                    now[4].update(under.encode())
                now[5] += len(segment)
            if out:
                yield closed()
        if now is not None:
            out.append(now)
            yield closed()

    ddl = widened(rows.select(*names), **result)
    return rows.mapInArrow(run, ddl).select(*_named(key, names, list(result)), *result)
