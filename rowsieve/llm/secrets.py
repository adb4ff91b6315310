"""Secret scans with recursive decoding.

Every text is scanned for three kinds of secrets: assignments to a telling name, access
keys and long hex strings. Then a worklist unwraps what the text hides: percent
escapes and Unicode escapes are decoded over the whole layer, base64 runs, also those
wrapped over lines, and the compressed data in them give layers of their own. A run is
decoded from each of its first four characters, since a path or name may stand before it. Each new layer is scanned and unwrapped
in turn, until nothing new appears; layers seen before are not entered again, so
encodings that lead back to themselves end. Every layer knows which characters of the
text each of its characters came from, so spans are reported in the text as it stands.

``scan`` returns each row with the spans of the plain text and those found in layers. A
span is (kind, start, end) in code points, the end exclusive. A secret found inside an
encoded run covers the whole run if that is base64 or compressed, else the escapes that
its characters were written as. A compressed run of more than 64 MB is read in pieces that
overlap by 1 MB, so that memory is bounded and nothing is left out; where an encoded run inside it is longer than
the overlap and cut there, each part is decoded by itself and ``truncated`` says so.

Null text counts as empty and has no spans; redacted it stays null. Empty tables give an
empty result. Rows are carried as a struct, so columns of any name stay as they are.
Repeated rows are scanned each.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import itertools
import lzma
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.functions import column
from rowsieve.llm._shared import importable_by_workers, text_of

# The kinds in order, and their patterns.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_VALUE = 12

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#(?:x([0-9A-Fa-f]{1,6})|([0-9]{1,7}));")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: Runs that go on in the next line, as base64 does that is wrapped, and one of their lines.
LINES = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:[\x20\t]*+\r?\n[\x20\t]*+[A-Za-z0-9+/_-]{2,}+)++={0,2}"
)
LINE = re.compile(r"[A-Za-z0-9+/_-]+")
ODD = re.compile(r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]")
#: Text between other bytes, and where compressed data may begin.
STRETCH = re.compile(rb"(?:[\t\n\r\x20-\x7E]|[\xC2-\xDF][\x80-\xBF]|[\xE0-\xEF][\x80-\xBF]{2}){12,}")
MAGIC = re.compile(rb"\x1F\x8B\x08|\x78[\x01\x5E\x9C\xDA]|BZh[1-9]|\xFD7zXZ\x00")

#: Unpacked data of more than so many bytes is read in pieces, a bound on memory, since a few bytes
#: can stand for terabytes; and how many bytes a piece has in common with the one before.
PIECE_BYTES, OVERLAP_BYTES = 64 << 20, 1 << 20
#: How often data that is packed more than once is unpacked while it is read in pieces.
MOST_NESTED = 64
#: An overlap of such characters alone may be the middle of one encoded run.
ENCODED = re.compile(rb"[A-Za-z0-9+/_=\s%\\&#;{}-]*")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the secrets in one layer, leftmost, apart within a kind.

    Hex and access runs are maximal, so asking for the length in the pattern finds the
    same runs as dropping short ones. Assignments are different: a short value still
    uses up its name, so those are dropped after matching.
    """
    found = [
        (m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= LEAST_VALUE
    ]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


class Layer:
    """A text with the place in the original that each of its characters came from."""

    def __init__(self, text: str, starts: np.ndarray | None, ends: np.ndarray | None, run=None):
        self.text, self.starts, self.ends, self.run = text, starts, ends, run

    def place(self, start: int, end: int) -> tuple[int, int]:
        if self.run:
            return self.run
        if self.starts is None:
            return start, end
        return int(self.starts[start]), int(self.ends[end - 1])

    def replaced(self, parts: list[tuple[int, int, str]]) -> Layer:
        """The layer with some stretches decoded; new characters share their stretch's place."""
        if self.run:
            text, at = [], 0
            for start, end, new in parts:
                text += [self.text[at:start], new]
                at = end
            return Layer("".join([*text, self.text[at:]]), None, None, self.run)
        n = len(self.text)
        old_s = self.starts if self.starts is not None else np.arange(n)
        old_e = self.ends if self.ends is not None else np.arange(1, n + 1)
        text, s, e, at = [], [], [], 0
        for start, end, new in parts:
            text += [self.text[at:start], new]
            s += [old_s[at:start], np.full(len(new), old_s[start])]
            e += [old_e[at:start], np.full(len(new), old_e[end - 1])]
            at = end
        text.append(self.text[at:])
        return Layer("".join(text), np.concatenate([*s, old_s[at:]]), np.concatenate([*e, old_e[at:]]))


def _readable(data: bytes) -> str | None:
    """Text of bytes that are UTF-8 and mostly printable."""
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    if text.isascii():
        odd = len(ODD.findall(text))
    else:
        odd = sum(1 for c in text if not (c.isprintable() or c in "\t\n\r"))
    return text if text and odd * 20 <= len(text) else None


def _member(data, most: int) -> tuple[bytes, bool, bytes] | None:
    """The first member of compressed data, whether the bound cut it, and what follows it."""
    opened = _opener(data)
    if not opened:
        return None
    try:
        out = opened.decompress(data, most)
    except (zlib.error, OSError, lzma.LZMAError, EOFError):
        return None
    cut = opened.unconsumed_tail if hasattr(opened, "unconsumed_tail") else not (opened.eof or opened.needs_input)
    return out, bool(cut), opened.unused_data


def _unpacked(data, most: int) -> tuple[bytes, bool] | None:
    """Decompressed bytes of all members, and whether the bound cut them; None for other data."""
    opened = _member(data, most)
    if not opened:
        return None
    out, cut, rest = opened
    outs, left = [out], most - len(out)
    # Some tools pad members with zeros.
    while not cut and (rest := rest.lstrip(b"\0")) and (opened := _member(rest, max(left, 1))):
        out, cut, rest = opened
        outs.append(out[: max(left, 0)])
        cut = cut or len(out) > left
        left -= len(out)
    return b"".join(outs), cut


def _opener(data):
    """What unpacks data that begins like this, if anything does."""
    head = bytes(data[:6])
    if head[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if head[:1] == b"\x78" and len(head) > 2 and int.from_bytes(head[:2], "big") % 31 == 0:
        return zlib.decompressobj()
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if head == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    return None


def _inflated(blocks: Iterator[bytes], step: int) -> Iterator[bytes]:
    """Unpacked bytes of all members, in blocks of ``step`` at most."""
    data = next(blocks, b"")
    while data and (opened := _opener(data)):
        feed = data
        while not opened.eof:
            try:
                out = opened.decompress(feed, step)
            except (zlib.error, OSError, lzma.LZMAError, EOFError):
                return
            if out:
                yield out
            feed = getattr(opened, "unconsumed_tail", b"")
            more = bool(feed) or len(out) == step or not getattr(opened, "needs_input", True)
            if not opened.eof and not more:
                feed = next(blocks, None)
                if feed is None:
                    return
        # Some tools pad members with zeros.
        data = bytes(opened.unused_data).lstrip(b"\0") or next(blocks, b"").lstrip(b"\0")


def _in_pieces(data, size: int, overlap: int) -> Iterator[tuple[bytes, bool]]:
    """Unpacked data as pieces that overlap, and whether an encoded run may be longer than that."""
    step = max(size // 8, 1)
    blocks, nested = _inflated(iter([bytes(data)]), step), 0
    first = next(blocks, b"")
    while first and nested < MOST_NESTED and _opener(first):
        blocks, nested = _inflated(itertools.chain([first], blocks), step), nested + 1
        first = next(blocks, b"")
    held = first
    for block in blocks:
        held += block
        if len(held) >= size:
            # A piece ends and begins with whole characters.
            end = len(held)
            while end > len(held) - 4 and held[end - 1] & 0xC0 == 0x80:
                end -= 1
            end -= end > 0 and held[end - 1] >= 0xC0
            carried = held[max(end - overlap, 1) :]
            start = next((k for k in range(4) if carried[k : k + 1] and carried[k] & 0xC0 != 0x80), 0)
            yield held[:end], bool(ENCODED.fullmatch(carried))
            held = carried[start:]
    if held:
        yield held, False


def _from_base64(run: str) -> Iterator[bytes]:
    """What a run decodes to from each of its first four characters: what stands before base64
    may look like it."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    for phase in range(4):
        part = body[phase:]
        part = part[:-1] if len(part) % 4 == 1 else part
        if part:
            yield binascii.a2b_base64(part + "=" * (-len(part) % 4))


def _blocks(chain: str) -> set[tuple[int, int]]:
    """Where wrapped base64 may begin and end among lines: lines of one length, with the
    shorter one after them or without, and the same with the line before; or all lines."""
    at = [m.span() for m in LINE.finditer(chain)]
    sizes = [end - start for start, end in at]
    found, i = {(0, len(at))}, 0
    while i < len(at):
        j = i + 1
        while j < len(at) and sizes[j] == sizes[i]:
            j += 1
        if sizes[i] >= 16:
            ends = [j, j + 1] if j < len(at) and sizes[j] < sizes[i] else [j]
            found |= {(a, b) for a in (max(i - 1, 0), i) for b in ends if b - a > 1}
        i = j
    return {(at[a][0], at[b - 1][1] if b < len(at) else len(chain)) for a, b in found}


def _children(layer: Layer, most: int | None, notes: dict) -> Iterator[Layer]:
    """Layers that one step of decoding gives, one after the other; ``notes`` says what was cut."""
    text = layer.text

    def unpacked(data) -> Iterator[bytes] | None:
        opened = _unpacked(data, most or PIECE_BYTES)
        return opened and contents(data, opened)

    def contents(data, opened) -> Iterator[bytes]:
        # Data packed more than once holds no text in between.
        met = set()
        while opened and opened[0] not in met:
            inner, cut = opened
            if cut and most is None:
                for piece, open_run in _in_pieces(data, PIECE_BYTES, OVERLAP_BYTES):
                    notes["cut"] = notes.get("cut", False) or open_run
                    yield piece
                return
            met.add(inner)
            notes["cut"] = notes.get("cut", False) or cut
            data, opened = inner, _unpacked(inner, most or PIECE_BYTES)
        yield data

    def pieces(data: bytes, place: tuple[int, int]) -> Iterator[Layer]:
        """Data as a layer if it is text, else each stretch of text in it."""
        found = _readable(data)
        texts = [found] if found else (m[0].decode("utf-8", "replace") for m in STRETCH.finditer(data))
        for t in texts:
            yield Layer(t, None, None, place)

    def enter(data: bytes, place: tuple[int, int]) -> Iterator[Layer]:
        opened = unpacked(data)
        if opened is not None:
            for piece in opened:
                if piece:
                    yield Layer(piece.decode("utf-8", "replace"), None, None, place)
            return
        yield from pieces(data, place)
        for m in MAGIC.finditer(data, 1):
            for piece in unpacked(memoryview(data)[m.start() :]) or ():
                yield from pieces(piece, place)

    if "%" in text:
        parts = []
        for m in PERCENT.finditer(text):
            data = bytes.fromhex(m[0].replace("%", ""))
            if _opener(data):
                yield from enter(data, layer.place(m.start(), m.end()))
            if data.isascii():  # one character for each escape: keep their places apart
                parts += [(m.start() + 3 * k, m.start() + 3 * k + 3, chr(b)) for k, b in enumerate(data)]
            else:
                parts.append((m.start(), m.end(), data.decode("utf-8", "replace")))
        if parts:
            yield layer.replaced(parts)
    if "\\" in text or "&#" in text:
        parts = []
        for m in ESCAPE.finditer(text):
            code = int(m[5]) if m[5] else int(m[1] or m[2] or m[3] or m[4], 16)
            if code < 0x110000 and not 0xD800 <= code < 0xE000:
                parts.append((m.start(), m.end(), chr(code)))
        if parts:
            yield layer.replaced(parts)
    runs = [(m[0], m.start(), m.end()) for m in BASE64.finditer(text)]
    if "\n" in text:
        for m in LINES.finditer(text):
            for start, end in _blocks(m[0]):
                run = "".join(m[0][start:end].split())
                runs.append((run, m.start() + start, m.start() + end))
    for run, start, end in runs:
        for data in _from_base64(run):
            yield from enter(data, layer.place(start, end))


def unwrap(text: str, most: int | None = None) -> tuple[list, list, int, bool]:
    """Base spans, all spans, layers entered, and whether something may have been missed.

    Spans are (start, kind, end), in that order. Layers are told apart by their text
    and place, so a layer that decodes to one seen before at that place ends there. ``most`` bounds what
    a compressed run unpacks to and drops the rest; without it large runs are read in pieces.
    """
    base = base_spans(text)
    spans, seen, notes, layers = set(base), set(), {}, 0
    # Depth first, each layer's children one at a time: of a large run one piece is held.
    work = [_children(Layer(text, None, None), most, notes)]
    while work:
        child = next(work[-1], None)
        if child is None:
            work.pop()
            continue
        mark = (child.run, hashlib.blake2b(child.text.encode("utf-8", "surrogatepass"), digest_size=16).digest())
        if mark in seen:
            continue
        seen.add(mark)
        layers += 1
        for start, kind, end in base_spans(child.text):
            a, b = child.place(start, end)
            spans.add((a, kind, b))
        work.append(_children(child, most, notes))
    return base, sorted(spans), layers, notes.get("cut", False)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


FOUND = (
    "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
    "n_layers long, truncated boolean, redacted string"
)


def _scanned(batches: Iterator[pa.RecordBatch], redact: bool, most: int | None) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in FOUND.split(", ")]
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            base, spans, layers, cut = unwrap(text, most)
            counts = [sum(1 for s in base if s[1] == kind) for kind in range(3)]
            digest = hashlib.sha256(joined(base).encode()).hexdigest()
            new = without(text, spans) if redact and spans else None
            rows.append((*counts, digest, joined(spans), layers, cut, new))
        kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64(), pa.bool_(), pa.string()]
        columns = list(zip(*rows)) or [()] * len(names)
        found = [pa.array(values, kind) for values, kind in zip(columns, kinds)]
        yield pa.RecordBatch.from_arrays([batch.column("row"), *found], ["row", *names])


def without(text: str, spans: list[tuple[int, int, int]], mark: str = "[secret]") -> str:
    """The text with each stretch that spans cover replaced by one mark."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at or not out:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, redact: bool = False, most: int | None = None) -> DataFrame:
    """Every row, as the struct ``row``, with what was found in its text.

    ``most`` bounds the bytes that a compressed run is unpacked to; by default all are read.

    ``redacted`` is null where there is nothing to take out, or if it isn't asked for.
    """
    importable_by_workers(docs.sparkSession)
    rows = docs.select(F.struct(*[column(c) for c in docs.columns]).alias("row"), text_of().alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(lambda batches: _scanned(batches, redact, most), f"row {kind}, {FOUND}")


def redact(docs: DataFrame) -> DataFrame:
    """The documents with secrets replaced by a mark; their columns as they were.

    ``n_chars``, where there is one, counts the new text where it changed.
    """
    found = scan(docs, redact=True)
    new = {"text": F.coalesce("redacted", F.col("row.text"))}
    if "n_chars" in docs.columns:
        count = F.length("redacted").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.coalesce(count, F.col("row.n_chars"))
    return found.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
