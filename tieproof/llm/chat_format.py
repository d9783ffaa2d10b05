"""Conversations of any layout as formatted text with a loss mask.

A record is a JSON document. The set of its nested field paths, hashed, is its
schema fingerprint; the fingerprint selects a declarative mapping that says
where the turns are. Turns are written with a template whose control strings
are escaped inside texts, so the output can be read back exactly.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieproof.llm.tables import partitions, query, saved, table

# --- schema fingerprints ------------------------------------------------------


def field_paths(value, at: str = "") -> set[str]:
    """Paths of all leaves and empty containers; ``[]`` stands for any element of a list."""
    if isinstance(value, dict) and value:
        return set().union(*(field_paths(v, f"{at}.{k}" if at else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union({f"{at}[]"}, *(field_paths(v, f"{at}[]") for v in value))
    return {at}


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Mapping:
    """Where the turns of a layout are.

    Flat: ``turns`` lists (role, field), in order; several fields of one role are
    joined by a blank line. Listed: ``each`` is a list of objects with ``role``
    and ``text``; ``roles`` renames roles. ``optional`` fields may be missing.
    """

    name: str
    turns: tuple[tuple[str, str], ...] = ()
    each: str = ""
    role: str = ""
    text: str = ""
    roles: dict = field(default_factory=dict, hash=False)
    optional: tuple[str, ...] = ()

    def shapes(self) -> Iterator[str]:
        """Fingerprints of all sets of paths that the layout allows."""
        always = {f for _, f in self.turns if f not in self.optional}
        if self.each:
            always |= {f"{self.each}[]"}
        for k in range(1 << len(self.optional)):
            some = {f for i, f in enumerate(self.optional) if k >> i & 1}
            if self.each:
                yield fingerprint(always | some)  # no turns
                some = some | {f"{self.each}[].{self.role}", f"{self.each}[].{self.text}"}
            yield fingerprint(always | some)

    def read(self, record: dict) -> list[tuple[str, str]]:
        out: list[tuple[str, str]] = []
        for role, name in self.turns:
            if name in record:
                text = as_text(record[name])
                if out and out[-1][0] == role:
                    text = "\n\n".join(x for x in (out.pop()[1], text) if x)
                out.append((role, text))
        for turn in record[self.each] if self.each else ():
            role = as_text(turn[self.role])
            out.append((self.roles.get(role, role), as_text(turn[self.text])))
        return out


def as_text(value) -> str:
    """A null is empty; anything else that is no string, its JSON."""
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


# fixed values: public layouts
LAYOUTS = (
    Mapping("messages", each="messages", role="role", text="content"),
    Mapping("conversations", each="conversations", role="from", text="value",
            roles={"human": "user", "gpt": "assistant"}, optional=("system",), turns=(("system", "system"),)),
    Mapping("prompt", turns=(("system", "system"), ("user", "prompt"), ("assistant", "completion")), optional=("system",)),
    Mapping("response", turns=(("system", "system"), ("user", "prompt"), ("assistant", "response")), optional=("system",)),
    Mapping("instruction", turns=(("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output")),
            optional=("system", "input")),
)


class Layouts:
    def __init__(self, layouts: Sequence[Mapping] = LAYOUTS):
        self.by_print = {p: m for m in reversed(layouts) for p in m.shapes()}

    def turns(self, record: str | None) -> tuple[str | None, list[tuple[str, str]] | None]:
        """(layout, turns); (None, None) for a record that is no JSON object or of no known layout."""
        try:
            value = json.loads(record or "")
        except ValueError:
            return None, None
        mapping = self.by_print.get(fingerprint(field_paths(value))) if isinstance(value, dict) else None
        return (mapping.name, mapping.read(value)) if mapping else (None, None)


# --- template -----------------------------------------------------------------

OPEN, SHUT, END, ESCAPE = "[INST] ", " [/INST]", "</s>", "␛"
# fixed values: control strings that must never stand inside a text
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
_BEGINS = re.compile(f"(?=({'|'.join(map(re.escape, CONTROL))})).", re.DOTALL)
_ESCAPED = re.compile(f"{ESCAPE}({ESCAPE}?)")


def escape(text: str) -> str:
    """The text with its escape marks doubled and one set after the first character of each control string."""
    return _BEGINS.sub(lambda m: m[0] + ESCAPE, text.replace(ESCAPE, ESCAPE * 2))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def write(turns: Sequence[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """(formatted text, loss mask): a span of the mask is the text of one assistant turn."""
    out, spans, at = [], [], 0
    for role, text in turns:
        body = escape(text)
        if role == "assistant":
            spans.append((at, at + len(body)))
            part = body + END
        else:
            # the first line is the role; one that would not fit a line is written as JSON
            name = json.dumps(role) if "\n" in role or role.startswith('"') else role
            part = f"{OPEN}{escape(name)}\n{body}{SHUT}"
        out.append(part)
        at += len(part)
    return "".join(out), spans


def read(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    turns, at = [], 0
    while at < len(formatted):
        if formatted.startswith(OPEN, at):
            end = formatted.index(SHUT, at)
            role, _, body = formatted[at + len(OPEN):end].partition("\n")
            role = unescape(role)
            turns.append((json.loads(role) if role.startswith('"') else role, unescape(body)))
            at = end + len(SHUT)
        else:
            end = formatted.index(END, at)
            turns.append(("assistant", unescape(formatted[at:end])))
            at = end + len(END)
    return turns


def format_records(records: DataFrame, layouts: Sequence[Mapping] = LAYOUTS, order: str | None = None) -> DataFrame:
    """``conv_id, layout, formatted, loss_spans`` of every row of ``records`` (``conv_id``, ``record`` as JSON).

    Spans are (start, end) in code points of ``formatted``. A record that is null,
    no JSON object or of no known layout has null in all three. A null text or
    role is empty; a record without turns is an empty text. Rows keep their
    number and ids. A record is what one task holds. ``order`` names a column that
    is carried along.
    """
    layouts = tuple(layouts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Layouts(layouts)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                rows = [(name, *write(turns)) if name else (None, None, None)
                        for name, turns in map(known.turns, part.column(0).to_pylist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()),
                    pa.array([None if r[2] is None else [{"start": s, "end": e} for s, e in r[2]] for r in rows], kind),
                    *part.columns[1:],
                ], ["layout", "formatted", "loss_spans", *part.schema.names[1:]])

    rows = records.select("record", "conv_id", *([order] if order else []))
    kept = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    done = rows.mapInArrow(run, "layout string, formatted string, loss_spans array<struct<start: int, end: int>>" + kept)
    return done.select("conv_id", *([order] if order else []), "layout", "formatted", "loss_spans")


def as_record(turns: Sequence[tuple[str, str]]) -> str:
    """Turns as JSON in the layout that their roles fit.

    A user with an answer becomes prompt and completion, a system text before
    those two an instruction, a longer talk of the three usual roles a list of
    human and gpt messages, and anything else a list of role and content.
    """
    roles, texts = [r for r, _ in turns], [t for _, t in turns]
    if roles == ["user", "assistant"]:
        record = dict(zip(("prompt", "completion"), texts))
    elif roles == ["system", "user", "assistant"]:
        record = dict(zip(("system", "instruction", "output"), texts))
    elif len(turns) > 3 and {"system", "user", "assistant"}.issuperset(roles):
        names = {"user": "human", "assistant": "gpt"}
        record = {"conversations": [{"from": names.get(r, r), "value": t} for r, t in turns]}
    else:
        record = {"messages": [{"role": r, "content": t} for r, t in turns]}
    return json.dumps(record, ensure_ascii=False)


def hot_ids(turns: DataFrame) -> DataFrame:
    """``conv_id`` of conversations with more rows than a quarter of a task's share: fewer than four a task."""
    counts = saved(turns.groupBy("conv_id").agg(F.count("*").alias("n")), light=True)
    rows = counts.agg(F.sum("n")).first()[0] or 0
    return counts.where(F.col("n") * F.lit(4 * partitions(turns.sparkSession)) > F.lit(rows)).select("conv_id")


def records_of(turns: DataFrame, spread: bool = False, most_turns: int = 64, most_chars: int = 1 << 20) -> DataFrame:
    """``conv_id, part, record``: conversations, rows by turn, as JSON records.

    Rows are ordered by turn (null first), ties by role and text; repeated rows
    stay. A record ends with its conversation, or after ``most_turns`` turns or
    ``most_chars`` characters; a formatted conversation is that of its records in
    the order of ``part``, and they follow each other in one partition. With
    ``spread``, for conversations with many rows, rows are dealt out by ranges of
    their order, so that a conversation is cut among tasks. Bounds of ranges are
    sampled, so they know the first 64 characters of a role and a text; rows that
    agree in these share a task.
    """
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    if spread:
        long_role = F.length("role") > 64
        dealt = rows.repartitionByRange(
            partitions(turns.sparkSession), "conv_id", "turn", F.left("role", F.lit(64)), long_role,
            F.when(long_role, "").otherwise(F.left("text", F.lit(64))))
    else:
        dealt = rows.repartition("conv_id")
    dealt = dealt.sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    kind = rows.schema["conv_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, records, held, chars = [], [], [], 0
        last = None
        for b in batches:
            id_type = b.column(0).type
            for lo in range(0, b.num_rows, 512):
                for conv, role, text in zip(*(c.to_pylist() for c in b.slice(lo, 512).columns)):
                    if held and (conv != last or len(held) >= most_turns or chars >= most_chars):
                        ids.append(last)
                        records.append(as_record(held))
                        held, chars = [], 0
                    last = conv
                    held.append((role, text))
                    chars += len(text)
                if records:
                    yield pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array(records, pa.string())], ["conv_id", "record"])
                    ids, records = [], []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([last], id_type), pa.array([as_record(held)], pa.string())], ["conv_id", "record"])

    records = dealt.mapInArrow(run, f"conv_id {kind.simpleString()}, record string")
    return records.select("conv_id", F.monotonically_increasing_id().alias("part"), "record")


class Digest:
    """Counts and hashes of a formatted text and its loss text, taken part by part."""

    def __init__(self):
        self.turns = self.loss_chars = self.chars = 0
        self.whole, self.loss = hashlib.sha256(), hashlib.sha256()
        self.known = True

    def add(self, text: str | None, spans) -> Digest:
        if text is None:
            self.known = False
            return self
        for role, body in read(text):
            self.turns += 1
            self.whole.update(f"{role}\n{body}\n".encode())
        for s in spans:
            body = unescape(text[s["start"]:s["end"]])
            self.loss_chars += len(body)
            self.loss.update(body.encode())
        self.chars += len(text)
        return self

    def values(self) -> tuple:
        if not self.known:
            return (None,) * 5
        return self.turns, self.whole.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def digests(formatted: DataFrame, joined: bool = False) -> DataFrame:
    """Turns and loss text read back from ``formatted`` and ``loss_spans``, as counts and hashes.

    One row for each row; with ``joined``, rows of one ``conv_id`` that follow each
    other in a partition are parts of one text, of which a task holds one at a
    time. Where a text is null, all is.
    """
    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())

    def batch(ids, rows, id_type) -> pa.RecordBatch:
        cells = list(zip(*rows)) or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(ids, id_type), *(pa.array(c, k) for c, k in zip(cells, kinds))], ["conv_id", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, digest = None, None
        for b in batches:
            id_type = b.column(0).type
            for lo in range(0, b.num_rows, 512):
                ids, rows = [], []
                for conv, text, spans in zip(*(c.to_pylist() for c in b.slice(lo, 512).columns)):
                    if digest is not None and not (joined and conv == last):
                        ids.append(last)
                        rows.append(digest.values())
                        digest = None
                    last, digest = conv, (digest or Digest()).add(text, spans)
                yield batch(ids, rows, id_type)
        if digest is not None:
            yield batch([last], [digest.values()], id_type)

    rows = formatted.select("conv_id", "formatted", "loss_spans")
    key = rows.schema["conv_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"conv_id {key}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                                "formatted_chars long")


def conversation_digests(turns: DataFrame, most_turns: int = 64, most_chars: int = 1 << 20) -> DataFrame:
    """``digests`` of whole conversations, formatted record by record.

    Conversations with many rows are formatted by many tasks; only their parts
    are shuffled once more, as a hash over all of a conversation is one task's walk.
    """
    same = F.col("turns.conv_id").eqNullSafe(F.col("hot.conv_id"))
    hot = F.broadcast(hot_ids(turns)).alias("hot")  # fewer than four rows a task
    usual = records_of(turns.alias("turns").join(hot, same, "left_anti"), False, most_turns, most_chars)
    large = records_of(turns.alias("turns").join(hot, same, "left_semi"), True, most_turns, most_chars)
    parts = format_records(large, order="part").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return digests(format_records(usual), joined=True).unionByName(digests(parts, joined=True))


OP6_SQL = """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marks AS (
  SELECT *, text || '' AS body, len(regexp_extract_all(text, '(<s>|</s>|\\[INST\\]|\\[/INST\\]|<<SYS>>|<</SYS>>|<\\|im_start\\|>|<\\|im_end\\|>|<\\|endoftext\\|>|␛)'))
    AS added FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(text) + added + CASE WHEN role = 'assistant' THEN 4 ELSE length(role) + 16 END) AS BIGINT) AS formatted_chars
FROM marks GROUP BY conv_id
"""


@query("op6_chat_format", OP6_SQL)
def op6_chat_format(spark, folder):
    extra = spark.createDataFrame(
        [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")],
        "conv_id long, turn long, role string, text string")
    turns = table(spark, folder, "conversations", "conv_id", "turn", "role", "text").unionByName(extra)
    return conversation_digests(turns)
