"""Bounded-space online packing of token sequences.

Each input partition streams its documents, in pieces of at most one window, through a
fixed number of open windows. A piece goes where it leaves the least room (best fit).
When it fits nowhere, the fullest window is emitted and a fresh one takes its place.
Windows still open at the end of a partition are the leftovers: those of a fixed number
of partitions meet in one task, largest first, and are merged whole by best fit.
So no task holds more than its open windows, or the leftovers of a few partitions.

The pieces of the partitions are written to a staged table before leftovers are merged,
so the tokenizer runs once. A sequence's id holds its partition (or merge group) and its
number there; a task that runs again gives the same ids to the same pieces, as long as
the table's files are read in the same splits, which is so within a session.

Documents longer than a window give full windows and a remainder. Null text counts as
empty and is one piece holding the end id alone. Repeated rows and ids are packed like
others, each row on its own. An empty table gives an empty result. Extra columns are
ignored.
"""

from __future__ import annotations

import base64
import bisect
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.llm._shared import importable_by_workers, staged, text_of

LENGTH = 2048
OPEN_WINDOWS = 64
#: Partitions whose leftovers meet in one task.
MERGED = 32
END_ID = 1
VOCABULARY = "byte_bpe_50k"
#: Blanks in a row from which on a text takes the slower way to the same ids.
LONG_BLANKS = 10_000
BLANKS = re.compile(rf"\s{{{LONG_BLANKS}}}")

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, full boolean, part long"
)


class _Encoder:
    """Ids of the public byte-level vocabulary, loaded once per worker process.

    They are those of ``tokenizers`` with the vocabulary's json file. ``tiktoken`` gives the
    same ones faster, but fails on very long runs of blanks; texts with such go through
    ``tokenizers`` itself. With ``added`` the json's added tokens are found in plain text,
    as ``tokenizers`` does by default; otherwise they are text like any other.
    """

    _kept: dict[tuple[str, bool], _Encoder] = {}

    def __init__(self, name: str, added: bool):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        self.whole.encode_special_tokens = not added
        tokens = {t.content: i for i, t in self.whole.get_added_tokens_decoder().items()}
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding(
            name,
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks=ranks,
            special_tokens=tokens if added else {},
        )

    def __call__(self, text: str) -> list[int]:
        if len(text) >= LONG_BLANKS and BLANKS.search(text):
            return self.whole.encode(text, add_special_tokens=False).ids
        return self.fast.encode(text, allowed_special="all")

    @classmethod
    def load(cls, name: str, added: bool) -> _Encoder:
        if (name, added) not in cls._kept:
            cls._kept[name, added] = cls(name, added)
        return cls._kept[name, added]


class OpenWindows:
    """A fixed number of windows, sorted by the room left in them."""

    def __init__(self, count: int, length: int):
        self.length, self.most = length, count
        self.rooms: list[tuple[int, int]] = []  # (room, window), ascending
        self.held: dict[int, list] = {}
        self.number = 0

    def place(self, size: int, item) -> tuple[int, list] | None:
        """Put an item into the best window; the window emitted for it, if any."""
        emitted = None
        at = bisect.bisect_left(self.rooms, (size, -1))
        if at < len(self.rooms):
            room, window = self.rooms.pop(at)
        else:
            if len(self.rooms) >= self.most:
                _, fullest = self.rooms.pop(0)
                emitted = (fullest, self.held.pop(fullest))
            room, window = self.length, self.number
            self.number += 1
            self.held[window] = []
        self.held[window].append((self.length - room, item))
        if room == size and emitted is None:
            return window, self.held.pop(window)
        # A window that fills up as another is emitted stays: it is the fullest and next to go.
        bisect.insort(self.rooms, (room - size, window))
        return emitted

    def rest(self) -> list[tuple[int, list]]:
        return sorted(self.held.items())


def _packed(batches: Iterator[pd.DataFrame], length: int, windows: int, vocabulary: str, added: bool):
    encode = _Encoder.load(vocabulary, added)
    part = TaskContext.get().partitionId()
    space = OpenWindows(windows, length)
    out: list[tuple] = []

    def emit(window: int, pieces: list, full: bool) -> None:
        sequence = (part << 32) | window
        out.extend((*piece, sequence, offset, full, part) for offset, piece in pieces)

    for batch in batches:
        for key, text in zip(batch["doc_id"], batch["text"]):
            doc_id = None if key is None else int(key)
            ids = np.array([*encode(text), END_ID], dtype="<u4")
            for start in range(0, len(ids), length):
                cut = ids[start : start + length]
                piece = (doc_id, start, len(cut), zlib.crc32(cut.tobytes()), len(ids))
                done = space.place(len(cut), piece)
                if done:
                    emit(*done, True)
            if len(out) >= 20_000:
                yield _frame(out)
                out.clear()
    for window, pieces in space.rest():
        emit(window, pieces, False)
    if out:
        yield _frame(out)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in PIECES.split(", ")])


def _merged(pieces: pd.DataFrame, length: int) -> pd.DataFrame:
    """Leftover windows of some partitions, merged whole by best fit, largest first."""
    pieces = pieces.sort_values(["sequence_id", "offset"], kind="stable")
    sizes = pieces.groupby("sequence_id")["length"].sum()
    order = sorted(sizes.items(), key=lambda x: (-x[1], x[0]))
    space = OpenWindows(len(order) + 1, length)
    goes: dict[int, tuple[int, int]] = {}
    done = [space.place(int(size), int(window)) for window, size in order]
    for window, held in [*filter(None, done), *space.rest()]:
        for offset, old in held:
            goes[old] = (window, offset)
    group = int(pieces["part"].iloc[0]) // MERGED
    new = pieces["sequence_id"].map(lambda s: -1 - ((group << 32) | goes[s][0]))
    shift = pieces["sequence_id"].map(lambda s: goes[s][1])
    return pieces.assign(sequence_id=new, offset=pieces["offset"] + shift, full=True)


def pack(
    docs: DataFrame,
    length: int = LENGTH,
    windows: int = OPEN_WINDOWS,
    vocabulary: str = VOCABULARY,
    added_tokens: bool = False,
) -> DataFrame:
    """One row per piece: where its ids come from and where they go.

    With ``added_tokens``, the vocabulary's added tokens count as such where a text spells
    them out.

    ``sequence_id`` is negative for merged leftovers. A sequence ends after its last
    piece; what is missing to ``length`` is padding.
    """
    importable_by_workers(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_of().alias("text"))
    pieces = staged(
        rows.mapInPandas(lambda batches: _packed(batches, length, windows, vocabulary, added_tokens), PIECES),
        "pieces",
    )
    leftovers = pieces.where(~F.col("full"))
    group = F.floor(F.col("part") / MERGED).alias("_group")
    merged = leftovers.groupBy(group).applyInPandas(lambda p: _merged(p, length), PIECES)
    return pieces.where("full").unionByName(merged).drop("full", "part")
