"""SentencePiece encoding and decoding through a table of distinct chunks.

No piece of the vocabulary holds a whitespace marker behind another character, so merges never
cross the start of a marker run. A text is therefore a row of independent chunks, each a run of
markers and the characters up to the next run. Words repeat far more often than texts, so each
distinct chunk of a block of documents is segmented once, and ids are joined back by position with
array lookups. Documents are independent: no shuffle, and a lost task is simply run again.

The table is built per block of about ``BLOCK`` characters, not over the whole corpus: over
0.5 GB of documents a corpus-wide table has 8 million chunks, and carrying every block's chunks
there and back by two shuffles costs more than segmenting them in place. What a task holds is the
text of a block once, its table, and the results of ``OUTPUT`` characters.

Defined results: a null text counts as empty and has the begin and end ids only; repeated rows give
repeated results; an empty table gives an empty result; other columns are passed over.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from riftspan.llm.common import batch_of, characters, only, ranges, table

MARKER = "▁"
#: Characters of a block; a longer text is a block of its own.
BLOCK = 4_000_000
#: Characters whose ids and decoded texts are held at once and leave as one batch.
OUTPUT = 500_000
#: Chunks segmented in one call, which bounds the lists that the encoder returns.
CALL = 50_000
#: A run of markers (as spaces) and what follows up to the next run.
CHUNK = re.compile(" +[^ ]*")


def model_bytes(path: str) -> bytes:
    """The vocabulary file, read on the driver and sent to the tasks with the job."""
    with open(path, "rb") as file:
        return file.read()


def check_independent(model: bytes) -> None:
    """Raise unless chunks are independent under this vocabulary."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    crossing = [p for p in map(processor.id_to_piece, range(processor.get_piece_size())) if MARKER in p.lstrip(MARKER)]
    if crossing:
        raise ValueError(f"{len(crossing)} pieces cross a whitespace marker, such as {crossing[0]!r}")
    probe = "a  b \t c "
    if processor.decode(processor.encode(probe)) != probe:
        raise ValueError("the vocabulary changes white space, so chunks cannot be told apart")


class ChunkTable:
    """Distinct chunks of one block of texts with their ids and decoded texts."""

    def __init__(self, processor) -> None:
        self.processor = processor
        self.marker = processor.piece_to_id(MARKER)
        self.codes: defaultdict[str, int] = defaultdict()
        self.codes.default_factory = self.codes.__len__

    def positions(self, text: str) -> np.ndarray:
        """Codes of the chunks of a text, in order."""
        if not text:
            return np.empty(0, np.int32)
        return np.fromiter(map(self.codes.__getitem__, CHUNK.findall(" " + text.replace(MARKER, " "))), np.int32)

    def segment(self) -> None:
        """Segment each distinct chunk once."""
        rests = [c[1:] for c in self.codes]  # the encoder itself puts the first marker
        lone = self.codes.get(" ")
        self.codes.clear()
        self.decoded: list[str] = []
        flat, lengths = [np.empty(0, np.uint32)], [np.empty(0, np.int32)]
        for first in range(0, len(rests), CALL):
            ids = self.processor.encode(rests[first : first + CALL], num_threads=1)
            if lone is not None and first <= lone < first + CALL:
                ids[lone - first] = [self.marker]  # at the end of a text; alone it would be no text to the encoder
            self.decoded += self.processor.decode(ids, num_threads=1)
            lengths.append(np.fromiter(map(len, ids), np.int32, len(ids)))
            flat.append(np.fromiter((i for own in ids for i in own), np.uint32, int(lengths[-1].sum())))
        if lone is not None:
            self.decoded[lone] = ""
        self.lengths = np.concatenate(lengths).astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.concatenate(flat)

    def ids(self, positions: np.ndarray) -> np.ndarray:
        """Ids of a text from its chunk codes."""
        lengths = self.lengths[positions]
        shift = self.starts[positions] - (np.cumsum(lengths) - lengths)
        return self.flat[np.repeat(shift, lengths) + np.arange(int(lengths.sum()))]

    def text(self, positions: np.ndarray) -> str:
        """Decoded text from chunk codes; the first marker is the one that the encoder put."""
        return " ".join(map(self.decoded.__getitem__, positions.tolist()))


def _columns(chunks: ChunkTable, rows: list[np.ndarray], begin: np.ndarray, end: np.ndarray, digests: bool) -> dict[str, pa.Array]:
    """Result columns of a few texts."""
    encoded = [np.concatenate([begin, chunks.ids(r), end]).astype("<u4") for r in rows]
    decoded = map(chunks.text, rows)
    counts = pa.array([len(i) for i in encoded], pa.int64())
    if digests:
        return {
            "n_tokens": counts,
            "ids_sha256": pa.array([hashlib.sha256(i.tobytes()).hexdigest() for i in encoded], pa.string()),
            "decoded_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded], pa.string()),
        }
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in encoded])]).astype(np.int32)
    flat = pa.array(np.concatenate(encoded).view("<i4"), pa.int32())
    return {"n_tokens": counts, "ids": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat), "decoded": pa.array(decoded, pa.string())}


def _encoder(model: bytes, id_column: str, text_column: str, digests: bool):
    schema = pa.schema(_fields(digests, id_column, None))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        begin, end = (np.array([i], np.uint32) for i in (processor.bos_id(), processor.eos_id()))
        for whole in batches:
            for first, stop in ranges(characters(whole, text_column), BLOCK):
                block = whole.slice(first, stop - first)
                chunks = ChunkTable(processor)
                rows = [chunks.positions(t.as_py() or "") for t in block.column(text_column)]
                chunks.segment()
                for begin_row, end_row in ranges(characters(block, text_column), OUTPUT):
                    own = rows[begin_row:end_row]
                    rows[begin_row:end_row] = [None] * len(own)
                    keys = block.column(id_column).slice(begin_row, len(own))
                    yield batch_of(schema.set(0, pa.field(id_column, keys.type)), **{id_column: keys}, **_columns(chunks, own, begin, end, digests))

    return run


def _fields(digests: bool, id_column: str, id_type) -> list[tuple]:
    rest = [("ids_sha256", pa.string()), ("decoded_sha256", pa.string())] if digests else [("ids", pa.list_(pa.int32())), ("decoded", pa.string())]
    return [(id_column, id_type or pa.int64()), ("n_tokens", pa.int64()), *rest]


def encode_pieces(
    docs: DataFrame, model: bytes, id_column: str = "doc_id", text_column: str = "text", digests: bool = False
) -> DataFrame:
    """Ids (with begin and end) and decoded text of every document, or their SHA-256 digests.

    ``id_column``, ``n_tokens`` and either ``ids array<int>``, ``decoded`` or ``ids_sha256``, ``decoded_sha256``.
    """
    check_independent(model)
    kind = docs.schema[id_column].dataType.simpleString()
    rest = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    return only(docs, id_column, text_column).mapInArrow(
        _encoder(model, id_column, text_column, digests), f"`{id_column}` {kind}, n_tokens bigint, {rest}"
    )


def default_model() -> bytes:
    """The public 32k vocabulary."""
    import public_tokenizers

    return model_bytes(public_tokenizers.path("piece_bpe_32k.model"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    return encode_pieces(table(spark, sf_dir, "documents"), default_model(), digests=True)
