"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

Words and word pairs of the training documents are counted exactly, in segments of their
hashes. A count c is stored as its quantised logarithm q = 1 + floor(log2 c): the n-gram
goes into a Bloom filter once with each of the numbers 1 to q. Workers ask the filter for
1, 2, 3 and so on until it says no; what they counted to gives the count back, up to a
factor of two. A word's probability mixes the
share of its pair among all pairs of the word before (the end mark, for the first one)
with its own share, smoothed by adding one.

Every n-gram is held, whatever the corpus, so the filter grows with it and is kept in two parts.
Each segment's most frequent n-grams, down to a level of its own, make a filter that is
broadcast; their number is a fixed share of ``MOST_ENTRIES``, which bounds the broadcast. Each
segment's whole filter, sized by what it holds, is a row of a staged table. The
texts are cut into chunks, and a chunk's distinct n-grams are probed in the broadcast filter first;
those that it does not hold go to their segments, and what the filters there tell of them comes
back to the chunk.

The base score needs exact counts. Words at or above a count are broadcast, with the
count set such that there are a million of them at most; occurrences of rarer words meet
their counts in a join, rows that miss there have a count of zero and add nothing.

Words are compared by 64-bit hashes; pairs by the bits of their segment and 32 more, so that few
pairs are taken for others, and those are told the larger count. Null or empty text has only
its end. Rows that repeat an id are documents of their own. Without training documents all counts
are zero. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.llm._segments import packed, packed_sorted, summed, unpacked, unpacked_sorted
from rowsieve.llm._shared import (
    discarded,
    importable_by_workers,
    remainder_of_id,
    shuffle_parts,
    staged,
    text_of,
)

PROBES = 4
#: Bits of the filter for each n-gram and number held; bounds the rate of false answers.
BITS_EACH = 8
PAIR_SHARE = 0.3
MOST_FREQUENT = 1_000_000
#: Entries (an n-gram has one for each number it is held with) of the broadcast filter; 8 MB.
MOST_ENTRIES = 1 << 23
#: Tokens counted at a time, and tokens of a chunk, but for the last text in either.
FLUSH_WORDS = 1_000_000
CHUNK_WORDS = 300_000
MOST_LEVELS = 62
LEAST_SEGMENTS = 256
#: Training tokens that one more segment is opened for.
TOKENS_PER_SEGMENT = 4_000_000
#: Bytes of chunks and runs that a worker is given at a time, a few rows.
GIVEN_BYTES = 4 << 20
#: Keys of several chunks that a segment's filter is asked for at once.
ASKED_AT_ONCE = 1 << 19

_U = np.uint64
_END = 0x51ED270B9F6A8E32


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


class Reader:
    """Hashes of the tokens of texts, each text's end included; hashes are kept a while."""

    def __init__(self, most_kept: int = 500_000):
        self.most, self.kept = most_kept, {}

    def __call__(self, text: str) -> array:
        kept, out = self.kept, array("Q")
        if len(kept) > self.most:
            kept.clear()
        for word in text.encode("utf-8", "surrogatepass").lower().split():
            code = kept.get(word)
            if code is None:
                code = kept[word] = xxhash.xxh3_64_intdigest(word)
            out.append(code)
        out.append(_END)
        return out


def _keys(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of words (even) and of pairs (odd); ``tokens`` are whole texts end to end."""
    before = np.concatenate([np.array([_END], _U), tokens[:-1]])
    return tokens & ~_U(1), _mix(before * _U(3) + tokens) | _U(1)


def levels_of(counts: np.ndarray) -> np.ndarray:
    """Quantised logarithms of counts, from 1 on."""
    return np.frexp(counts.astype(np.float64))[1]


def count_of(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts that share a quantised logarithm; 0 for none."""
    return np.where(levels > 0, (3 * 2.0 ** (levels - 1.0) - 1) / 2, 0.0)


def _short(keys: np.ndarray, bits: int) -> np.ndarray:
    """The 32 bits that follow the segment's: few enough keys meet by chance, and those are
    told the larger count."""
    return ((keys << _U(bits)) >> _U(32)).astype(np.uint32)


def _bits_of(keys: np.ndarray, level: int, words) -> tuple[np.ndarray, np.ndarray]:
    """Word of the filter, of ``words`` many, and the bits in it, for keys at a level."""
    code = _mix(keys + _U((level * 0x9E3779B97F4A7C15) & (1 << 64) - 1))
    mask = np.zeros(len(keys), _U)
    for k in range(PROBES):
        mask |= _U(1) << ((code >> _U(6 * k)) & _U(63))
    return (((code >> _U(32)) * np.asarray(words, _U)) >> _U(32)).astype(np.int64), mask


MODEL = (
    "segment int, words binary, counts binary, filter binary, top binary, top_level int, "
    "total bigint, distinct_words bigint, from_count array<bigint>"
)


def _filter(short: np.ndarray, levels: np.ndarray, bits_each: int) -> np.ndarray:
    """A filter that holds each key with the numbers up to its level."""
    part = np.zeros(-(-int(levels.sum()) * bits_each // 64), _U)
    for level in range(1, int(levels.max(initial=0)) + 1):
        at, mask = _bits_of(short[levels >= level], level, len(part))
        np.bitwise_or.at(part, at, mask)
    return part


def _part(
    segment: int, keys: np.ndarray, counts: np.ndarray, bits: int, bits_each: int = BITS_EACH, most: int = 0
) -> pa.RecordBatch:
    """A segment's words with their counts, its filter, and that of its most frequent n-grams,
    which holds ``most`` entries or fewer."""
    levels, short = levels_of(counts), _short(keys, bits).astype(_U)
    single = (keys & _U(1)) == 0
    own = counts[single]
    steps = [int((own >= 2.0 ** (j / 2)).sum()) for j in range(2 * MOST_LEVELS)]
    entries = np.cumsum(np.bincount(levels, levels, MOST_LEVELS + 2)[::-1])[::-1]
    top_level = max(int(np.flatnonzero(entries <= most)[0]), 1)
    top = levels >= top_level
    return pa.RecordBatch.from_arrays(
        [
            pa.array([segment], pa.int32()),
            pa.array([keys[single].tobytes()], pa.binary()),
            pa.array([own.astype(np.int64).tobytes()], pa.binary()),
            pa.array([_filter(short, levels, bits_each).tobytes()], pa.binary()),
            pa.array([_filter(short[top], levels[top], bits_each).tobytes()], pa.binary()),
            pa.array([top_level], pa.int32()),
            pa.array([int(own.sum())], pa.int64()),
            pa.array([len(own)], pa.int64()),
            pa.array([steps], pa.list_(pa.int64())),
        ],
        [c.split()[0] for c in MODEL.split(", ")],
    )


def _words(batches: Iterator[pa.RecordBatch], least: float, most: float) -> Iterator[pa.RecordBatch]:
    """Word keys and counts within bounds, as rows."""
    for batch in batches:
        for k, c in zip(batch.column("words").to_pylist(), batch.column("counts").to_pylist()):
            counts = np.frombuffer(c, np.int64)
            inside = (counts >= least) & (counts < most)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(k, _U)[inside].view(np.int64)), pa.array(counts[inside])], ["word", "c"]
            )


def told(part: np.ndarray, keys: np.ndarray, first=0, size=None) -> np.ndarray:
    """Levels of short keys as a filter tells them: probe for 1, 2, ... until it says no.

    ``first`` and ``size`` say where in ``part`` the filter of each key lies, if not all of it is."""
    keys = keys.astype(_U)
    first, size = (np.broadcast_to(x, len(keys)) for x in (first, len(part) if size is None else size))
    levels = np.zeros(len(keys), np.uint8)
    alive = np.flatnonzero(size)
    for level in range(1, MOST_LEVELS + 1):
        at, mask = _bits_of(keys[alive], level, size[alive])
        alive = alive[(part[first[alive] + at] & mask) == mask]
        if not len(alive):
            break
        levels[alive] = level
    return levels


class Frequent:
    """The broadcast filter: one part for each segment, and the least level that it holds."""

    def __init__(self, bits: int, tops: dict[int, tuple[bytes, int]]):
        self.bits = bits
        # A segment without a part has counted nothing, and that is known as well.
        parts = [np.frombuffer(tops.get(k, (b"", 1))[0], _U) for k in range(1 << bits)]
        self.size = np.array([len(p) for p in parts], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.least = np.array([tops.get(k, (b"", 1))[1] for k in range(1 << bits)], np.uint8)
        self.part = np.concatenate([*parts, np.array([], _U)])

    def told(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Levels of keys, and which of them are settled: held, or sure to be held if there."""
        at = (keys >> _U(64 - self.bits)).astype(np.int64)
        levels = told(self.part, _short(keys, self.bits), self.first[at], self.size[at])
        return levels, (levels >= self.least[at]) | (self.least[at] == 1)


class Model:
    """Sums over all words, the exact counts of frequent ones, and one segment's filter or none."""

    def __init__(self, filter_: bytes, bits: int, words: np.ndarray, counts: np.ndarray, total: int, distinct: int):
        self.filter, self.bits = np.frombuffer(filter_, _U), bits
        order = np.argsort(words)
        self.words, self.counts = words[order], counts[order]
        self.total, self.distinct = total, distinct

    def probed(self, keys: np.ndarray) -> np.ndarray:
        """Counts of the segment's keys as its filter tells them."""
        return count_of(told(self.filter, _short(keys, self.bits)))

    def exact(self, keys: np.ndarray) -> np.ndarray:
        """Exact counts of frequent words, 0 for others."""
        if not len(self.words):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.words, keys), len(self.words) - 1)
        return np.where(self.words[at] == keys, self.counts[at], 0)

    def score(self, tokens: np.ndarray, own: np.ndarray, together: np.ndarray) -> np.ndarray:
        """Per token: the model's log10 probability, from the counts of words and of pairs."""
        end = own[np.flatnonzero(tokens == _U(_END))[:1]]
        before = np.append(end, own[:-1])
        alone = (own + 1) / (self.total + self.distinct + 1)
        share = np.minimum(together / np.maximum(before, 1), 1.0)
        return np.log10(np.where(before > 0, PAIR_SHARE * share + (1 - PAIR_SHARE) * alone, alone))


# A chunk's number is that of its first row.
CHUNKS = (
    "chunk bigint, segment int, data binary, doc_ids array<bigint>, teaches array<boolean>, "
    "ends array<bigint>, vocabulary binary"
)
CHUNK_SCHEMA = pa.schema(
    [
        ("chunk", pa.int64()),
        ("segment", pa.int32()),
        ("data", pa.binary()),
        ("doc_ids", pa.list_(pa.int64())),
        ("teaches", pa.list_(pa.bool_())),
        ("ends", pa.list_(pa.int64())),
        ("vocabulary", pa.binary()),
    ]
)
#: What passes between chunks and segments: keys asked for, and then the levels told.
ASKED = "chunk bigint, segment int, data binary"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row at a time: a batch may hold many large ones."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def _chunked(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Texts as places of their tokens in their chunk's vocabulary."""
    read, row = Reader(), TaskContext.get().partitionId() << 33
    ids, teaches, ends, flat = [], [], [], array("Q")

    def done() -> pa.RecordBatch:
        vocabulary, at, n = np.unique(np.frombuffer(flat, _U), return_inverse=True, return_counts=True)
        # Frequent ones first, so that most high bytes of places are zero and pack well.
        order = np.argsort(-n, kind="stable")
        place = np.empty(len(order), "<u4")
        place[order] = np.arange(len(order))
        columns = (row, -1, packed(place[at]), ids, teaches, ends, vocabulary[order].tobytes())
        return pa.RecordBatch.from_arrays(
            [pa.array([v], field.type) for v, field in zip(columns, CHUNK_SCHEMA)], schema=CHUNK_SCHEMA
        )

    for batch in batches:
        for doc_id, text, teach in zip(*(batch.column(c) for c in ("doc_id", "text", "teaches"))):
            flat.extend(read(text.as_py()))
            ids.append(doc_id.as_py())
            teaches.append(teach.as_py())
            ends.append(len(flat))
            if len(flat) >= most:
                yield done()
                row += len(ids)
                ids, teaches, ends, flat = [], [], [], array("Q")
    if ids:
        yield done()


def _tokens(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """A chunk's vocabulary, and the place of each token in it."""
    return np.frombuffer(row["vocabulary"], _U), unpacked(row["data"])


COUNTED = "segment int, words binary, word_counts binary, pairs binary, pair_counts binary"


def _edges(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each segment begins among sorted keys, and their end."""
    return np.append(np.searchsorted(keys, np.arange(1 << bits, dtype=_U) << _U(64 - bits)), len(keys))


def _counted(batches: Iterator[pa.RecordBatch], bits: int, most: int = FLUSH_WORDS) -> Iterator[pa.RecordBatch]:
    """Words and pairs of what teaches, counted, one row per segment."""
    held: list[np.ndarray] = []

    def done() -> pa.RecordBatch:
        singles, pairs = _keys(np.concatenate(held))
        columns: list[list] = [[] for _ in range(5)]
        words, counts = summed(singles)
        pairs, often = summed(pairs)
        at, pair_at = _edges(words, bits), _edges(pairs, bits)
        for k in np.flatnonzero(np.diff(at) + np.diff(pair_at)):
            own, both = slice(at[k], at[k + 1]), slice(pair_at[k], pair_at[k + 1])
            row = (
                int(k),
                words[own].tobytes(),
                packed(counts[own]),
                packed_sorted(_short(pairs[both], bits)),
                packed(often[both]),
            )
            for column, value in zip(columns, row):
                column.append(value)
        kinds = [pa.int32(), *[pa.binary()] * 4]
        names = [c.split()[0] for c in COUNTED.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    size = 0
    for row in _rows(batches):
        vocabulary, places = _tokens(row)
        sizes = np.diff(np.append(0, row["ends"]))
        taught = vocabulary[places[np.repeat(np.array(row["teaches"], bool), sizes)]]
        if len(taught):
            held.append(taught)
            size += len(taught)
        if size >= most:
            yield done()
            held, size = [], 0
    if held:
        yield done()


def _parts(batches: Iterator[pa.RecordBatch], bits: int, bits_each: int, most: int) -> Iterator[pa.RecordBatch]:
    """Each segment's runs, which follow one another, as its row of the model."""

    def done(segment: int, runs: list[dict]) -> pa.RecordBatch:
        words, counts = summed(
            np.concatenate([np.frombuffer(r["words"], _U) for r in runs]),
            np.concatenate([unpacked(r["word_counts"]) for r in runs]).astype(np.int64),
        )
        pairs, often = summed(
            np.concatenate([unpacked_sorted(r["pairs"]) for r in runs]),
            np.concatenate([unpacked(r["pair_counts"]) for r in runs]).astype(np.int64),
        )
        whole = (_U(segment) << _U(64 - bits)) | (pairs.astype(_U) << _U(32 - bits)) | _U(1)
        return _part(segment, np.append(words, whole), np.append(counts, often), bits, bits_each, most >> bits)

    at, runs = None, []
    for row in _rows(batches):
        if row["segment"] != at and runs:
            yield done(at, runs)
            runs = []
        at = row["segment"]
        runs.append(row)
    if runs:
        yield done(at, runs)


def _asked(batches: Iterator[pa.RecordBatch], frequent) -> Iterator[pa.RecordBatch]:
    """The distinct keys of each chunk that the broadcast filter leaves open, one row per segment."""
    frequent = frequent.value
    bits = frequent.bits
    for row in _rows(batches):
        vocabulary, places = _tokens(row)
        keys = np.unique(np.concatenate(_keys(vocabulary[places])))
        keys = keys[~frequent.told(keys)[1]]
        short, at = _short(keys, bits), _edges(keys, bits)
        full = np.flatnonzero(np.diff(at))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([row["chunk"]] * len(full), pa.int64()),
                pa.array(full.astype(np.int32)),
                pa.array([packed_sorted(short[at[k] : at[k + 1]]) for k in full], pa.binary()),
            ],
            ["chunk", "segment", "data"],
        )


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Levels of the keys asked for; each segment's filter (chunk -1) comes before them."""
    at, part = None, np.array([], _U)
    chunks: list[int] = []
    keys: list[np.ndarray] = []
    size = 0

    def done() -> pa.RecordBatch:
        ends = np.cumsum([len(k) for k in keys])
        levels = told(part, np.concatenate(keys))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(chunks, pa.int64()),
                pa.array([at] * len(chunks), pa.int32()),
                pa.array([x.tobytes() for x in np.split(levels, ends[:-1])], pa.binary()),
            ],
            ["chunk", "segment", "data"],
        )

    for batch in batches:
        for chunk, segment, data in zip(*(batch.column(c) for c in ("chunk", "segment", "data"))):
            chunk, segment = chunk.as_py(), segment.as_py()
            if chunks and (segment != at or size >= ASKED_AT_ONCE):
                yield done()
                chunks, keys, size = [], [], 0
            if segment != at:
                at, part = segment, np.array([], _U)
            if chunk < 0:
                part = np.frombuffer(data.as_py(), _U)
            else:
                chunks.append(chunk)
                keys.append(unpacked_sorted(data.as_py()))
                size += len(keys[-1])
    if chunks:
        yield done()


ROWS = "row bigint, doc_id bigint, n_tokens bigint, n_frequent bigint, frequent_log double, score double, rare array<bigint>"


def _scored(batches: Iterator[pa.RecordBatch], model, frequent) -> Iterator[pa.RecordBatch]:
    """Scores of each chunk's texts; the levels told follow them in the order of segments."""
    model, frequent = model.value, frequent.value
    names = [c.split()[0] for c in ROWS.split(", ")]

    def done(row: dict, answers: list[bytes]) -> pa.RecordBatch:
        vocabulary, places = _tokens(row)
        tokens, ends = vocabulary[places], np.array(row["ends"])
        singles, pairs = _keys(tokens)
        keys, which = np.unique(np.concatenate([singles, pairs]), return_inverse=True)
        levels, settled = frequent.told(keys)
        levels[~settled] = np.frombuffer(b"".join(answers), np.uint8)
        counts = count_of(np.arange(MOST_LEVELS + 1))[levels][which]
        logs = model.score(tokens, counts[: len(tokens)], counts[len(tokens) :])
        exact = model.exact(vocabulary & ~_U(1))[places]
        starts = np.append(0, ends[:-1])
        known = exact > 0
        rare = np.flatnonzero(~known)
        cut = np.searchsorted(rare, np.append(starts, len(tokens))).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(row["chunk"], row["chunk"] + len(ends))),
                pa.array(row["doc_ids"], pa.int64()),
                pa.array(ends - starts),
                pa.array(np.add.reduceat(known.astype(np.int64), starts)),
                pa.array(np.add.reduceat(np.log10(exact + 1.0), starts)),
                pa.array(np.add.reduceat(logs, starts)),
                pa.ListArray.from_arrays(pa.array(cut), pa.array(singles[rare].view(np.int64))),
            ],
            names,
        )

    texts, answers = None, []
    for row in _rows(batches):
        if row["segment"] >= 0:
            answers.append(row["data"])
            continue
        if texts:
            yield done(texts, answers)
        texts, answers = row, []
    if texts:
        yield done(texts, answers)


def _told_of(chunks: DataFrame, parts: DataFrame, frequent) -> DataFrame:
    """The chunks, each followed by what the filters tell of its keys, in order of segments."""
    tasks = max(shuffle_parts(chunks.sparkSession), 12)
    asked = chunks.drop("teaches").mapInArrow(lambda b: _asked(b, frequent), ASKED)
    filters = parts.select(F.lit(-1).cast("bigint").alias("chunk"), "segment", F.col("filter").alias("data"))
    both = asked.unionByName(filters)
    dealt = both.repartition(tasks, "segment").sortWithinPartitions("segment", "chunk")
    answers = dealt.mapInArrow(_answered, ASKED)
    told_of = chunks.drop("teaches").unionByName(answers, allowMissingColumns=True)
    return told_of.repartition(tasks, "chunk").sortWithinPartitions("chunk", "segment")


def train(chunks: DataFrame, bits_each: int = BITS_EACH, most: int = MOST_ENTRIES) -> tuple[Model, Frequent, DataFrame, float]:
    """A model of the chunks' texts that teach, its broadcast filter, the table of its parts, and
    the count of frequent words."""
    spark = chunks.sparkSession
    tokens = chunks.agg(F.sum(F.element_at("ends", -1))).first()[0] or 0
    bits = max(LEAST_SEGMENTS, tokens // TOKENS_PER_SEGMENT).bit_length() - 1
    runs = chunks.mapInArrow(lambda b: _counted(b, bits), COUNTED)
    dealt = runs.repartition(max(shuffle_parts(spark), 12), "segment").sortWithinPartitions("segment")
    parts = dealt.mapInArrow(lambda b: _parts(b, bits, bits_each, most), MODEL)
    parts = staged(parts, "ngram-parts", GIVEN_BYTES, GIVEN_BYTES)
    tops = parts.select("segment", "top", "top_level").toLocalIterator()
    frequent_ngrams = Frequent(bits, {r["segment"]: (bytes(r["top"]), r["top_level"]) for r in tops})
    totals = parts.agg(F.sum("total").alias("n"), F.sum("distinct_words").alias("v")).first()
    steps = parts.select(F.posexplode("from_count").alias("step", "n")).groupBy("step").agg(F.sum("n").alias("n"))
    enough = steps.where(F.col("n") <= MOST_FREQUENT).agg(F.min("step")).first()[0]
    frequent = 2.0 ** ((enough or 0) / 2)
    head = parts.select("words", "counts").mapInArrow(lambda b: _words(b, frequent, np.inf), "word bigint, c bigint")
    head = head.toArrow()
    model = Model(
        b"",
        bits,
        head.column("word").to_numpy().view(_U),
        head.column("c").to_numpy(),
        totals["n"] or 0,
        totals["v"] or 0,
    )
    return model, frequent_ngrams, parts, frequent


def score_texts(
    docs: DataFrame,
    held_out: int = 2,
    modulus: int = 7,
    bits_each: int = BITS_EACH,
    chunk_words: int = CHUNK_WORDS,
    most_entries: int = MOST_ENTRIES,
) -> DataFrame:
    """Per document: token counts, the base score and the model's score.

    Documents whose crc32 of the id has remainder ``held_out`` teach the model nothing.
    """
    spark = docs.sparkSession
    importable_by_workers(spark)
    doc_id = F.col("doc_id").cast("bigint").alias("doc_id")
    # A null id is in no fold, so its text teaches.
    teaches = ~F.coalesce(remainder_of_id(modulus) == held_out, F.lit(False))
    texts = docs.select(doc_id, text_of().alias("text"), teaches.alias("teaches"))
    chunks = staged(texts.mapInArrow(lambda b: _chunked(b, chunk_words), CHUNKS), "chunks", GIVEN_BYTES, GIVEN_BYTES)
    model, frequent_ngrams, parts, frequent = train(chunks, bits_each, most_entries)
    shared, shared_ngrams = map(spark.sparkContext.broadcast, (model, frequent_ngrams))
    told_of = _told_of(chunks, parts, shared_ngrams)
    rows = told_of.mapInArrow(lambda b: _scored(b, shared, shared_ngrams), ROWS)
    rows = staged(rows, "scores", GIVEN_BYTES, GIVEN_BYTES)
    discarded(chunks)
    rare = rows.select("row", F.explode("rare").alias("word"))
    counts = parts.select("words", "counts").mapInArrow(lambda b: _words(b, 0, frequent), "word bigint, c bigint")
    sums = (
        rare.join(counts, "word")
        .groupBy("row")
        .agg(F.sum(F.log10(F.col("c") + 1.0)).alias("rare_log"), F.count(F.lit(1)).alias("n_rare"))
    )
    total = F.log10(F.lit(float(model.total + model.distinct + 1)))
    base = F.col("frequent_log") + F.coalesce("rare_log", F.lit(0.0)) - F.col("n_tokens") * total
    return rows.drop("rare").join(sums, "row", "left").select(
        "doc_id",
        F.coalesce(remainder_of_id(modulus) == held_out, F.lit(False)).alias("held_out"),
        "n_tokens",
        (F.col("n_frequent") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("bigint").alias("train_tokens"),
        base.alias("base_score"),
        "score",
    )
