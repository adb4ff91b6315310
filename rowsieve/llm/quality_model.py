"""A factorisation machine that scores document quality.

Inputs are the distinct words of a text, hashed into a fixed number of buckets, and
buckets of statistics: structure (length, symbols, repeats, lines) and metadata (the
stored character count against the text's own). Each input has a weight and a short
vector; pairs of inputs act through the products of their vectors. The sum over all
pairs is half of (square of the sum less sum of the squares), so scoring is linear in
the number of inputs.

The model is trained in numpy on a bounded sample of labelled documents, the least by a
hash of their ids, from features that the executors extract. It has a fixed size, which
bounds what is broadcast. Every document is scored from its whole text.

Null text counts as empty and is scored from its statistics alone. A null
character count is a bucket of its own. Documents without a label, or with a null one,
teach nothing; a label repeated under one id counts each time. Without any labelled
document all scores are the prior of one half. An empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.llm._shared import ROW_KEY, importable_by_workers, labelled_sample, staged, text_of

WORD_BUCKETS = 1 << 15
FACTORS = 8
#: At most so many labelled documents are learnt from.
MOST_LABELLED = 4000
EPOCHS, BATCH, RATE, DECAY = 12, 64, 0.1, 1e-4
THRESHOLD = 0.7

SYMBOLS = b"#*$%&|<>"
#: Statistics are cut into buckets at these bounds; one more bucket for a missing value.
BOUNDS = {
    "words": [1, 5, 10, 20, 35, 50, 75, 100, 150, 250, 500, 1000, 5000],
    "word_size": [2, 3, 4, 5, 6, 7, 8, 10, 14],
    "symbols": [0.001, 0.01, 0.03, 0.06, 0.1, 0.2, 0.4, 0.8, 1.5],
    "distinct": [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.97],
    "repeats": [0.001, 0.01, 0.05, 0.1, 0.2, 0.3, 0.5, 0.8],
    "dup_lines": [0.001, 0.05, 0.1, 0.2, 0.3, 0.5, 0.8],
    "line_words": [1, 3, 6, 10, 20, 40, 80, 200],
    "digits": [0.001, 0.01, 0.05, 0.1, 0.2, 0.5],
    "chars_off": [-0.5, 0.5],
}
FIRST = dict(zip(BOUNDS, np.cumsum([0, *[len(b) + 2 for b in BOUNDS.values()]])[:-1].tolist()))
STATISTICS = sum(len(b) + 2 for b in BOUNDS.values())
INPUTS = STATISTICS + WORD_BUCKETS


class Extractor:
    """Inputs of a text: indices of words and statistics. Word buckets are kept a while."""

    def __init__(self, most_kept: int = 500_000):
        self.kept: dict[bytes, int] = {}
        self.most = most_kept

    def __call__(self, text: str, n_chars) -> tuple[np.ndarray, np.ndarray]:
        data = text.encode("utf-8", "surrogatepass")
        words = data.lower().split()
        if len(self.kept) > self.most:
            self.kept.clear()
        ids = []
        for word in words:
            bucket = self.kept.get(word)
            if bucket is None:
                bucket = self.kept[word] = zlib.crc32(word) % WORD_BUCKETS
            ids.append(bucket)
        row = np.array(ids, dtype=np.int64)
        distinct = np.unique(row)
        n = len(words)
        lines = [line for line in data.split(b"\n") if line.strip()]
        values = {
            "words": n,
            "word_size": sum(map(len, words)) / n if n else None,
            "symbols": sum(data.count(c) for c in SYMBOLS) / n if n else None,
            "distinct": len(distinct) / n if n else None,
            "repeats": 0.0 if n < 6 else _repeats(row),
            "dup_lines": 1 - len(set(lines)) / len(lines) if lines else None,
            "line_words": n / len(lines) if lines else None,
            "digits": sum(data.count(c) for c in b"0123456789") / n if n else None,
            "chars_off": None if n_chars is None else float(n_chars - len(text)),
        }
        found = []
        for name, value in values.items():
            bounds = BOUNDS[name]
            at = len(bounds) + 1 if value is None else int(np.searchsorted(bounds, value, side="right"))
            found.append(FIRST[name] + at)
        return np.array(found, dtype=np.int64), distinct + STATISTICS


def _repeats(ids: np.ndarray) -> float:
    """Share of three-word windows that occur more than once."""
    windows = (ids[:-2] * WORD_BUCKETS + ids[1:-1]) * WORD_BUCKETS + ids[2:]
    _, counts = np.unique(windows, return_counts=True)
    return float(counts[counts > 1].sum() / len(windows))


class FactorisationMachine:
    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.bias = 0.0
        self.weight = np.zeros(INPUTS, np.float32)
        self.factor = rng.normal(0, 0.02, (INPUTS, FACTORS)).astype(np.float32)

    @staticmethod
    def inputs(statistics: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices and values; words share one unit of length, each statistic has its own."""
        value = np.ones(len(statistics) + len(words), np.float32)
        value[len(statistics) :] = 1 / np.sqrt(max(len(words), 1))
        return np.concatenate([statistics, words]), value

    def odds(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray):
        """Log odds of examples laid end to end, and the sums that training needs."""
        vx = self.factor[index] * value[:, None]
        total = np.add.reduceat(vx, starts, axis=0)
        squares = np.add.reduceat(vx * vx, starts, axis=0)
        linear = np.add.reduceat(self.weight[index] * value, starts)
        return self.bias + linear + 0.5 * (total * total - squares).sum(axis=1), vx, total

    def train(self, examples: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, seed: int = 5):
        if not len(examples):
            return self
        rng = np.random.default_rng(seed)
        g_w = np.full(INPUTS, 1e-2, np.float32)
        g_v = np.full((INPUTS, FACTORS), 1e-2, np.float32)
        share = float(np.clip(target.mean(), 0.02, 0.98))
        self.bias = float(np.log(share / (1 - share)))
        for _ in range(EPOCHS):
            order = rng.permutation(len(examples))
            for at in range(0, len(order), BATCH):
                chosen = order[at : at + BATCH]
                index = np.concatenate([examples[i][0] for i in chosen])
                value = np.concatenate([examples[i][1] for i in chosen])
                lengths = np.array([len(examples[i][0]) for i in chosen])
                starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
                odds, vx, total = self.odds(index, value, starts)
                error = (1 / (1 + np.exp(-odds)) - target[chosen]) / len(chosen)
                each = np.repeat(error, lengths).astype(np.float32) * value
                grad_v = each[:, None] * (np.repeat(total, lengths, axis=0) - vx)
                used, place = np.unique(index, return_inverse=True)
                sum_w = np.bincount(place, each, len(used)) + DECAY * self.weight[used]
                sum_v = np.zeros((len(used), FACTORS))
                np.add.at(sum_v, place, grad_v)
                sum_v += DECAY * self.factor[used]
                g_w[used] += sum_w**2
                g_v[used] += sum_v**2
                self.weight[used] -= RATE * sum_w / np.sqrt(g_w[used])
                self.factor[used] -= RATE * sum_v / np.sqrt(g_v[used])
                self.bias -= RATE * float(error.sum())
        return self

    def score(self, examples: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        starts = np.concatenate([[0], np.cumsum([len(i) for i, _ in examples])[:-1]]).astype(np.int64)
        odds, _, _ = self.odds(
            np.concatenate([i for i, _ in examples]), np.concatenate([v for _, v in examples]), starts
        )
        return 1 / (1 + np.exp(-odds.astype(np.float64)))


def _rows(docs: DataFrame) -> DataFrame:
    n_chars = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"), n_chars.alias("n_chars"))


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    extract = Extractor()
    for batch in batches:
        texts, chars = batch.column("text").to_pylist(), batch.column("n_chars").to_pylist()
        found = [extract(t, c) for t, c in zip(texts, chars)]
        arrays = [
            batch.column("target"),
            pa.array([s.tolist() for s, _ in found], pa.list_(pa.int64())),
            pa.array([w.tolist() for _, w in found], pa.list_(pa.int64())),
        ]
        yield pa.RecordBatch.from_arrays(arrays, ["target", "statistics", "words"])


def train(labelled: DataFrame, docs: DataFrame, most: int = MOST_LABELLED) -> FactorisationMachine:
    """A model from (doc_id, target) rows, at most ``most`` of them, and their documents."""
    importable_by_workers(docs.sparkSession)
    chosen = staged(labelled_sample(labelled, docs, most), "labelled")
    texts = _rows(docs).withColumn("tie", F.xxhash64("text"))
    rows = texts.join(F.broadcast(chosen), [*ROW_KEY]).dropDuplicates([*ROW_KEY, "target"])
    rows = rows.select("text", "n_chars", "target")
    found = rows.mapInArrow(_extracted, "target int, statistics array<bigint>, words array<bigint>").toArrow()
    found = found.sort_by([("target", "ascending")]).to_pylist()
    # The same examples in the same order, whatever task gave them.
    found.sort(key=lambda r: (r["target"], r["statistics"], r["words"]))
    examples = [
        FactorisationMachine.inputs(np.array(r["statistics"], np.int64), np.array(r["words"], np.int64))
        for r in found
    ]
    return FactorisationMachine().train(examples, np.array([r["target"] for r in found], np.float64))


def _scored(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    extract = Extractor()
    for batch in batches:
        texts, chars = batch.column("text").to_pylist(), batch.column("n_chars").to_pylist()
        scores: list[float] = []
        for at in range(0, len(texts), 256):
            pairs = zip(texts[at : at + 256], chars[at : at + 256])
            examples = [FactorisationMachine.inputs(*extract(t, c)) for t, c in pairs]
            scores += model.value.score(examples).tolist()
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"]
        )


def score(docs: DataFrame, model: FactorisationMachine) -> DataFrame:
    """doc_id and the probability of good quality, one row per document."""
    spark = docs.sparkSession
    importable_by_workers(spark)
    shared = spark.sparkContext.broadcast(model)
    return _rows(docs).select("doc_id", "text", "n_chars").mapInArrow(
        lambda batches: _scored(batches, shared), "doc_id bigint, score double"
    )
