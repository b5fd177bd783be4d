"""Token counts by section, from whole documents encoded once.

Encoding each section by itself would count other tokens than training sees, since merges then stop at
the section's edge. Here the whole text is encoded and its tokens are attributed:

1. Sections are spans of characters, as a column ``array<struct<name,start,stop>>`` in order of start and without overlap;
   by default, the lines of a text by what they hold. Spark's own functions make them.
2. The byte-level encoder is lossless, so the byte lengths of the tokens add up to their byte offsets, which are
   mapped to character offsets (a token that ends inside a character reaches to its end).
3. Token spans are joined with section spans by binary search over the starts.
4. A token that crosses a boundary is allocated by a named rule: ``start`` (the section of its first
   character), ``end`` (of its last), ``majority`` (of most of its bytes, the earlier one on a tie) or ``share`` (in
   parts, by bytes).

Tokens in no section are allocated to the section ``null``. Documents are independent: no shuffle.
Defined results: null and empty texts and documents without sections have no rows unless they have
tokens; a null list of sections is an empty one; an empty section has a row of 0 tokens; spans reaching beyond the text are cut
to it; repeated rows give repeated results; an empty table gives an empty result; further columns are passed over.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riftspan.llm.common import table, texts_of

RULES = ("start", "end", "majority", "share")


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a byte-level vocabulary file."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


def lines_by_kind(text: Column) -> Column:
    """The lines of a text with their line ends as consecutive sections ``struct<name,size>``: ``table``, ``notice``, ``blank`` or ``prose``."""
    pieces = F.split(F.coalesce(text, F.lit("")), "\n")
    kind = lambda line: (
        F.when(F.contains(line, F.lit(" | ")), "table")
        .when(line.rlike("(?i)licen[sc]e|copyright|rights reserved"), "notice")
        .when(F.trim(line) == "", "blank")
        .otherwise("prose")
    )
    return F.transform(pieces, lambda line: F.struct(kind(line).alias("name"), (F.length(line) + 1).cast("bigint").alias("size")))


def allocated(starts: np.ndarray, stops: np.ndarray, begins: np.ndarray, ends: np.ndarray, rule: str) -> np.ndarray:
    """Tokens by section, the last entry being those in none.

    Token ``i`` covers bytes ``starts[i]:stops[i]``; section ``j`` bytes ``begins[j]:ends[j]``, in order and without overlap.
    """
    n = len(begins)
    out = np.zeros(n + 1)
    if not len(starts):
        return out

    def section_at(byte: np.ndarray) -> np.ndarray:
        # the last section that begins at or before the byte and is not empty
        j = np.searchsorted(begins, byte, "right") - 1
        inside = (j >= 0) & (byte < ends[np.maximum(j, 0)]) if n else np.zeros(len(byte), bool)
        return np.where(inside, j, n)

    first, last = section_at(starts), section_at(stops - 1)
    if rule == "start":
        return out + np.bincount(first, minlength=n + 1)
    if rule == "end":
        return out + np.bincount(last, minlength=n + 1)
    plain = (first == last) & ((first < n) | (np.searchsorted(begins, starts, "right") == np.searchsorted(begins, stops - 1, "right")))
    out += np.bincount(first[plain], minlength=n + 1)
    for a, b in zip(starts[~plain].tolist(), stops[~plain].tolist()):
        inner = np.unique(np.concatenate([[a, b], begins[(begins > a) & (begins < b)], ends[(ends > a) & (ends < b)]]))
        parts: dict[int, int] = {}
        for x, y, j in zip(inner[:-1], inner[1:], section_at(inner[:-1]).tolist()):
            parts[j] = parts.get(j, 0) + int(y - x)
        if rule == "share":
            for j, size in parts.items():
                out[j] += size / (b - a)
        else:
            out[max(parts, key=lambda j: parts[j])] += 1  # of equals the first met, that is, the earlier one
    return out


def crossing(starts: np.ndarray, stops: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """How many tokens cross into each section from before its start."""
    if not len(begins):
        return np.zeros(0, np.int64)
    token = np.searchsorted(starts, begins, "left") - 1  # the last token that starts before the section
    return ((token >= 0) & (stops[np.maximum(token, 0)] > begins)).astype(np.int64) if len(starts) else np.zeros(len(begins), np.int64)


def byte_offsets(text: str, characters: np.ndarray) -> np.ndarray:
    """Byte offsets of character offsets."""
    if text.isascii():
        return np.clip(characters, 0, len(text))
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    sizes = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
    return np.concatenate([[0], np.cumsum(sizes)])[np.clip(characters, 0, len(text))]


def attribute_tokens(
    docs: DataFrame, sections: Column, ranks: dict[bytes, int], pattern: str, rule: str = "majority", id_column: str = "doc_id", text_column: str = "text", sized: bool = False
) -> DataFrame:
    """``id_column``, ``section`` (position), ``name``, ``tokens`` (double), ``crossing`` and ``start``, ``stop`` (characters).

    ``sections`` is an array of ``struct<name,start,stop>``, or with ``sized`` of consecutive ``struct<name,size>``.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {', '.join(RULES)}")
    box = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        encoder = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=box.value, special_tokens={})
        length_of = np.zeros(max(box.value.values(), default=0) + 1, np.int64)
        for token, rank in box.value.items():
            length_of[rank] = len(token)
        for batch in batches:
            spans = batch.column("sections")
            flat, offsets = spans.flatten(), np.concatenate([[0], np.cumsum(spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            all_names = flat.field("name")
            columns: dict[str, list] = {c: [] for c in ("row", "section", "tokens", "crossing", "start", "stop")}
            names = []
            for row, text in enumerate(texts_of(batch, "text")):
                own = slice(int(offsets[row]), int(offsets[row + 1]))
                if sized:
                    sizes = flat.field("size").to_numpy(zero_copy_only=False)[own]
                    stop = np.minimum(np.cumsum(sizes), len(text))
                    start = np.minimum(np.cumsum(sizes) - sizes, len(text))
                else:
                    start, stop = (np.clip(flat.field(c).to_numpy(zero_copy_only=False)[own], 0, len(text)) for c in ("start", "stop"))
                stops = np.cumsum(length_of[np.array(encoder.encode_ordinary(text), np.int64)])
                starts = np.concatenate([[0], stops[:-1]]) if len(stops) else stops
                begins, ends = byte_offsets(text, start), byte_offsets(text, stop)
                n = allocated(starts, stops, begins, ends, rule)
                some = np.flatnonzero(np.append(np.ones(len(begins), bool), n[-1] > 0))
                columns["row"].append(np.full(len(some), row))
                columns["section"].append(some)
                columns["tokens"].append(n[some])
                columns["crossing"].append(np.append(crossing(starts, stops, begins), 0)[some])
                columns["start"].append(np.append(start, 0)[some])
                columns["stop"].append(np.append(stop, 0)[some])
                names.append(pa.concat_arrays([all_names.slice(own.start, own.stop - own.start), pa.nulls(int(n[-1] > 0), pa.string())]))
            if not names:
                continue
            joined = {c: np.concatenate(v) for c, v in columns.items()}
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(joined["row"])),
                    pa.array(joined["section"].astype(np.int32)),
                    pa.concat_arrays(names),
                    pa.array(joined["tokens"].astype(float)),
                    *(pa.array(joined[c].astype(np.int64)) for c in ("crossing", "start", "stop")),
                ],
                names=["id", "section", "name", "tokens", "crossing", "start", "stop"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"), sections.alias("sections"))
    found = rows.mapInArrow(run, f"id {kind}, section int, name string, tokens double, crossing bigint, start bigint, stop bigint")
    return found.withColumnRenamed("id", id_column)


def op5_token_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document."""
    import public_tokenizers

    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return attribute_tokens(table(spark, sf_dir, "documents"), lines_by_kind(F.col("text")), ranks, public_tokenizers.PATTERN, sized=True)
