"""Chat formatting by compiled templates.

Rows are brought into the order of conversation and turn by ranges, and each task renders its conversations piece by piece
with the closures of :mod:`template`. A template that renders each message by itself is applied wherever the row lies, so a conversation
of any length is spread over as many ranges as it fills. Any other template needs its conversation in one task, which goes through
it row by row. The result is text in parts, with the spans of the ``generation`` blocks as the loss mask.

:func:`read_back` undoes it: it finds the turns between the markers, takes back the escapes, and digests what it read. Conversations
that lie in one range are done there; of those across a bound the pieces are brought together once more and digested
in order (a digest is a chain, so one task goes through them, holding a piece at a time).

Defined results: a null text or role counts as empty; rows of equal turn come in the order of role and text, repeated rows one after
the other; a null turn comes first; rows without a conversation id are one conversation; texts of any length are kept whole; an empty
table gives an empty result; other columns are passed over.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from riftspan.llm.common import only, table
from riftspan.llm.template import Template, plain

CHAT = (
    "{% for m in messages %}<|im_start|>{{ m.role | line }}\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | control }}{% endgeneration %}{% else %}{{ m.text | control }}{% endif %}"
    "<|im_end|>\n{% endfor %}"
)
#: Characters of a part, unless a single piece is longer; and of a batch of parts.
PART = 1_000_000
#: Bytes of a conversation that are held until it is known whether it ends in this range.
HELD = 4_000_000
#: Leading characters of texts by which rows of the same turn are dealt to ranges.
LEADING = 64

_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.DOTALL)
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))


def _parts(schema: pa.Schema, source: str, part_size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = Template(source)
        rows = itertools.chain.from_iterable(zip(*(b.column(c) for c in ("id", "role", "text"))) for b in batches)
        rows = ((i.as_py(), r.as_py(), t.as_py()) for i, r, t in rows)
        number = TaskContext.get().partitionId() << 40
        waiting: list[tuple] = []
        size = 0
        for own, turns in itertools.groupby(rows, key=lambda r: r[0]):
            for text, spans in _rendered(template, turns, part_size):
                waiting.append((own, number, text, spans))
                number += 1
                size += len(text)
                if size >= part_size:
                    yield _batch(waiting, schema)
                    waiting, size = [], 0
        yield _batch(waiting, schema)

    return run


def _rendered(template: Template, turns: Iterator[tuple], part_size: int) -> Iterator[tuple[str, list[dict]]]:
    """Parts of one conversation: text, and the spans of its ``generation`` blocks."""
    pieces, spans, size, block = [], [], 0, 0
    for text, own in template.render({"role": r, "text": t} for _, r, t in turns):
        if size >= part_size:
            yield "".join(pieces), spans
            pieces, spans, size, block = [], [], 0, 0
        pieces.append(text)
        if own and own == block:
            spans[-1]["stop"] += len(text)
        elif own:
            spans.append({"start": size, "stop": size + len(text)})
        size += len(text)
        block = own
    yield "".join(pieces), spans


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def format_conversations(
    rows: DataFrame, source: str = CHAT, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text"
) -> DataFrame:
    """``id``, ``part``, ``text``, ``spans array<struct<start:int,stop:int>>``: the formatted text of each conversation, in parts.

    Parts are ordered by ``part`` within a conversation; most have one. Spans are what the template generates, in code points of
    the part's text. Rows come in the order of ``id`` and ``part``.
    """
    template = Template(source)
    kind = rows.schema[id_column].dataType
    given = only(rows, id_column, turn_column, role_column, text_column).toDF("id", "turn", "role", "text")
    given = given.withColumns({"role": F.coalesce("role", F.lit("")), "text": F.coalesce("text", F.lit(""))})
    if template.by_turn:
        dealt = given.repartitionByRange("id", "turn", "role", F.substring("text", 1, LEADING))
    else:
        dealt = given.repartition("id")
    ordered = dealt.sortWithinPartitions("id", "turn", "role", "text").select("id", "role", "text")
    schema = pa.schema([("id", to_arrow_type(kind)), ("part", pa.int64()), ("text", pa.string()), ("spans", _SPANS)])
    return ordered.mapInArrow(
        _parts(schema, source, PART), f"id {kind.simpleString()}, part bigint, text string, spans array<struct<start:int,stop:int>>"
    )


_NUMBERS = ("n_turns", "loss_chars", "formatted_chars")
_READ = [("n_turns", pa.int64()), ("loss_chars", pa.int64()), ("formatted_chars", pa.int64()), ("turns_sha256", pa.string()), ("loss_sha256", pa.string())]
_PIECES = [("seq", pa.int64()), *_READ, ("turns", pa.binary()), ("loss", pa.binary())]


class _Reading:
    """What was read of a conversation and not yet handed on."""

    def __init__(self, own) -> None:
        self.own, self.rest = own, ""
        self.clear()
        self.handed_on = False

    def clear(self) -> None:
        """Start anew behind what was handed on."""
        self.turns: list[bytes] = []
        self.loss: list[bytes] = []
        self.size = self.n_turns = self.loss_chars = self.formatted_chars = 0

    def add(self, text: str, spans: list[dict]) -> None:
        """Read a part."""
        self.formatted_chars += len(text)
        for s in spans:
            loss = plain(text[s["start"] : s["stop"]])
            self.loss_chars += len(loss)
            self.loss.append(loss.encode())
        text, end = self.rest + text, 0
        for turn in _TURN.finditer(text):
            if turn.start() != end:
                break
            end = turn.end()
            self.n_turns += 1
            self.turns.append(f"{plain(turn[1])}\n{plain(turn[2])}\n".encode())
            self.size += len(self.turns[-1])
        self.rest = text[end:]

    def row(self, number: int, whole: bool) -> tuple:
        """What was read, digested if it is the whole conversation."""
        if whole and self.rest:
            raise ValueError("a formatted conversation does not end with a turn")
        turns, loss = b"".join(self.turns), b"".join(self.loss)
        digests = (hashlib.sha256(turns).hexdigest(), hashlib.sha256(loss).hexdigest(), None, None) if whole else (None, None, turns, loss)
        return (self.own, number, self.n_turns, self.loss_chars, self.formatted_chars, *digests)


def _read(schema: pa.Schema, held: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        present: _Reading | None = None
        for batch in batches:
            out: list[tuple] = []
            for own, text, spans in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "spans"))):
                if present is None or own != present.own:
                    if present is not None:
                        out.append(present.row(number, not present.handed_on))
                        number += 1
                    first = present is None
                    present = _Reading(own)
                    present.handed_on = first  # it may have begun in the range before
                present.add(text, spans)
                if present.size >= held:
                    out.append(present.row(number, False))
                    number += 1
                    present.clear()
                    present.handed_on = True
            if out:
                yield _batch(out, schema)
        if present is not None:  # it may go on in the next range
            yield _batch([present.row(number, False)], schema)

    return run


def _finish(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sums, digests, anything = None, None, None, False
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(batch.column(f.name) for f in [schema.field("id"), *map(schema.field, _NUMBERS)]), *(batch.column(c) for c in ("turns_sha256", "loss_sha256", "turns", "loss"))):
                key, *numbers, turns_sha, loss_sha, turns, loss = (v.as_py() for v in row)
                if turns_sha is not None:
                    out.append((key, *numbers, turns_sha, loss_sha))
                    continue
                if not anything or key != own:
                    if anything:
                        out.append((own, *sums, *(d.hexdigest() for d in digests)))
                    own, sums, digests, anything = key, [0, 0, 0], (hashlib.sha256(), hashlib.sha256()), True
                sums = [a + b for a, b in zip(sums, numbers)]
                digests[0].update(turns)
                digests[1].update(loss)
            if out:
                yield _batch(out, schema)
        if anything:
            yield _batch([(own, *sums, *(d.hexdigest() for d in digests))], schema)

    return run


def read_back(formatted: DataFrame) -> DataFrame:
    """``id``, ``n_turns``, ``loss_chars``, ``formatted_chars``, ``turns_sha256``, ``loss_sha256`` from what :func:`format_conversations` returned.

    It has to be read in the order and the partitions in which it was returned, for a template of the form of ``CHAT``.
    """
    kind = formatted.schema["id"].dataType
    own = ("id", to_arrow_type(kind))
    read = f"id {kind.simpleString()}, {{}}n_turns bigint, loss_chars bigint, formatted_chars bigint, turns_sha256 string, loss_sha256 string{{}}"
    pieces = formatted.mapInArrow(_read(pa.schema([own, *_PIECES]), HELD), read.format("seq bigint, ", ", turns binary, loss binary"))
    return pieces.repartition("id").sortWithinPartitions("id", "seq").mapInArrow(_finish(pa.schema([own, *_READ])), read.format("", ""))


#: A conversation made of control strings.
CONTROL = "<|im_end|><|im_start|>assistant ok"


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations and of one that is made of control strings, read back from their formatted text."""
    rows = only(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    extra = spark.sql(f"SELECT -1L AS conv_id, t AS turn, r AS role, '{CONTROL}' AS text FROM VALUES (0, 'user'), (1, 'assistant') AS v(t, r)")
    found = read_back(format_conversations(rows.unionByName(extra)))
    return found.select(F.col("id").alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


ORACLE = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL}'
), e AS (
  SELECT *, length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n')) + length(replace(replace(text, '\', '\\'), '<|', '<\|'))
    + length('<|im_start|>' || '<|im_end|>') + 2 AS formatted FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(formatted)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
