"""Byte-level BPE with tiktoken and a local rank file: texts to ids, ids to bytes.

tiktoken cuts a text by a pattern and merges the bytes of each match by rank. Long texts are
cut beforehand, at places where the pattern must begin a new match whatever stands around:

- before a blank that follows a character that is no blank, since no match goes on into a
  blank;
- in a long run of blanks before its last one, if text follows: the pattern takes all blanks
  but the last one as one match, and the last goes with what follows.

So pieces stay small, ids are those of the whole text, and a run of blanks, on which the
pattern's search may fail when it is very long, is merged as the one match that it is.

Ids are kept as little-endian unsigned 32-bit numbers, packed. Decoding joins the raw bytes of
the ids' ranks: what comes back need not be valid UTF-8 for ids cut elsewhere, and no byte is
replaced.

Null text counts as empty; empty text has no ids and decodes to no bytes, null ids decode to
null. Rows that repeat an id are encoded each on its own. An empty table gives an empty
result. Special tokens' names are text like any other. Columns other than ``doc_id`` and the
text or ids are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.llm._shared import importable_by_workers, text_of

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Characters from which on a text is cut, and after which it is cut at the next safe place.
LONG_TEXT = 100_000
#: A run of so many blanks is merged without the pattern.
LONG_BLANKS = 10_000
#: Bytes of a batch that leaves a worker, but for the last row in it.
BATCH_BYTES = 8 << 20

# Fixed value: the blanks of the pattern's \s, Unicode's White_Space.
BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
SAFE = re.compile(f"(?<=[^{BLANK}])(?=[{BLANK}])")


def pieces(text: str, most: int = LONG_TEXT, blanks: int = LONG_BLANKS) -> Iterator[tuple[str, bool]]:
    """The text in order, cut at safe places, and whether a piece is one match for certain."""

    def cut(start: int, end: int) -> Iterator[tuple[str, bool]]:
        while end - start > most:
            safe = SAFE.search(text, start + most, end)
            if not safe:
                break
            yield text[start : safe.start()], False
            start = safe.start()
        if end > start:
            yield text[start:end], False

    at = 0
    for run in re.finditer(f"[{BLANK}]{{{blanks},}}", text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        yield from cut(at, run.start())
        yield text[run.start() : end], True
        at = end
    yield from cut(at, len(text))


class Codec:
    """The encodings of a rank file, loaded once per worker process."""

    _kept: dict[str, Codec] = {}

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.matched, self.whole = (
            tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            for pattern in (public_tokenizers.PATTERN, r"[\s\S]+")
        )

    @classmethod
    def load(cls, path: str | None) -> Codec:
        import public_tokenizers

        path = path or public_tokenizers.path(VOCABULARY)
        if path not in cls._kept:
            cls._kept[path] = cls(path)
        return cls._kept[path]

    def encode(self, text: str, most: int = LONG_TEXT, blanks: int = LONG_BLANKS) -> np.ndarray:
        if len(text) < min(most, blanks):
            return np.array(self.matched.encode_ordinary(text), "<u4")
        parts = [
            np.array((self.whole if one else self.matched).encode_ordinary(piece), "<u4")
            for piece, one in pieces(text, most, blanks)
        ]
        return np.concatenate(parts) if parts else np.array([], "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return self.matched.decode_bytes(ids.tolist())


def _in_batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded size; the last column holds the bytes that count."""
    kept, size = [], 0
    for row in rows:
        kept.append(row)
        size += len(row[-1] or b"") + 64
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in kept], schema)
            kept, size = [], 0
    if kept:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in kept], schema)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and ids (packed) of each row. ``path`` names a rank file that every
    worker can open; the default is the public one for many languages."""
    importable_by_workers(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.load(path)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    ids = codec.encode(text.as_py())
                    yield doc_id, len(ids), ids.tobytes()

        yield from _in_batches(rows(), schema)

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return texts.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids and the bytes that the ids stand for, of rows of ``encode``."""
    importable_by_workers(encoded.sparkSession)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.load(path)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for doc_id, n, ids in zip(*batch.columns[:3]):
                    ids = ids.as_py()
                    decoded = None if ids is None else codec.decode(np.frombuffer(ids, "<u4"))
                    yield doc_id.as_py(), n.as_py(), ids, decoded

        yield from _in_batches(rows(), schema)

    rows = encoded.select("doc_id", "n_tokens", "ids")
    return rows.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids binary, decoded binary")
