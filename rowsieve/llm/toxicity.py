"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A text is read as words; each word is given to the network by a word input (a vector
of the bucket its hash falls into) and a character input (the mean vector of its hashed
character trigrams, its ends marked). One gated unit reads a window of words forwards,
another backwards; attention weighs the states of both, and their weighted sum gives the
window's log odds. Windows overlap by half and cover the whole text; where one is near the
threshold in a text that no window decides, all windows that begin within half a window of it are
scored too. A text scores as its most toxic window does.

The network is trained in numpy on a bounded sample of labelled documents (the least by a
hash of their ids, half of them toxic as far as there are enough, none longer than 64 KB). Labels are known per
document only, so each step teaches the window that scores highest in its document. The
first number of each bucket starts at the log odds with which the bucket's words occur
in toxic documents of the sample. All parameters have a fixed size, which bounds what is
broadcast.

Null or empty text has no window and scores as the network's answer to an empty one. A
word of any length is one input. Documents without a label, or with a null one, teach
nothing. Without labels of both kinds all documents score the share of toxic ones. An
empty table gives an empty result. Extra columns are ignored. Rows are scored one by
one, repeated or not.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.llm._shared import ROW_KEY, importable_by_workers, labelled_sample, staged, text_of

WINDOW, STRIDE = 32, 16
WORD_BUCKETS, TRIGRAM_BUCKETS = 1 << 15, 1 << 12
WORD_SIZE, CHAR_SIZE, HIDDEN, ATTENTION = 6, 4, 8, 8
#: At most so many labelled texts of each kind are learnt from, chosen among those of so many
#: bytes or fewer; longer ones are scored like all others.
MOST_LABELLED, MOST_BYTES = 1000, 64 << 10
EPOCHS, BATCH, RATE = 8, 50, 0.01
#: Log odds within which a window is near the threshold, and its neighbours are scored as well.
NEAR = 3.0


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Words:
    """Word bucket and trigram buckets of words, found for many at a time."""

    @staticmethod
    def bare(word: bytes) -> bytes:
        return word.strip(b".,;:!?\"'()[]{}") or word

    @classmethod
    def inputs(cls, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word buckets, all trigram buckets end to end, and where each word's begin."""
        bare = [cls.bare(w) for w in words]
        bucket = np.fromiter((zlib.crc32(w) % WORD_BUCKETS for w in bare), np.int64, len(bare))
        flat = np.frombuffer(b"".join(b"\x01" + w + b"\x02" for w in bare), np.uint8).astype(np.int64)
        sizes = np.fromiter((len(w) + 2 for w in bare), np.int64, len(bare))
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        code = flat[:-2] * 65536 + flat[1:-1] * 256 + flat[2:]
        inside = np.ones(len(flat), bool)
        inside[np.concatenate([starts + sizes - 1, starts + sizes - 2])] = False
        grams = (code[inside[:-2]] * 2654435761 >> 9) % TRIGRAM_BUCKETS
        counts = sizes - 2
        return bucket, grams, np.concatenate([[0], np.cumsum(counts)[:-1]])


class Network:
    """Parameters, window scores, and one training step."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)

        def some(*shape: int) -> np.ndarray:
            return rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)

        size = WORD_SIZE + CHAR_SIZE
        self.p = {
            "word": rng.normal(0, 0.05, (WORD_BUCKETS, WORD_SIZE)).astype(np.float32),
            "char": rng.normal(0, 0.05, (TRIGRAM_BUCKETS, CHAR_SIZE)).astype(np.float32),
            "att": some(2 * HIDDEN, ATTENTION),
            "att_v": some(ATTENTION),
            "out": some(2 * HIDDEN),
            "bias": np.zeros(1, np.float32),
        }
        for way in ("f", "b"):
            self.p[f"in_{way}"] = some(size, 3 * HIDDEN)
            self.p[f"in_b_{way}"] = np.zeros(3 * HIDDEN, np.float32)
            self.p[f"re_{way}"] = some(HIDDEN, 3 * HIDDEN)
        self.constant: float | None = None

    def embedded(self, words: list[bytes]) -> np.ndarray:
        bucket, grams, starts = Words.inputs(words)
        counts = np.diff(np.append(starts, len(grams)))[:, None]
        chars = np.add.reduceat(self.p["char"][grams], starts, axis=0) / counts
        return np.concatenate([self.p["word"][bucket], chars], axis=1)

    def projected(self, words: list[bytes]) -> np.ndarray:
        """What the units get from each word, both ways side by side."""
        x = self.embedded(words)
        sides = [x @ self.p[f"in_{way}"] + self.p[f"in_b_{way}"] for way in ("f", "b")]
        return np.concatenate(sides, axis=1).astype(np.float32)

    def _read(self, given: np.ndarray, mask: np.ndarray, way: str, keep: list | None) -> np.ndarray:
        """States after each word (windows, words, hidden), reading in one direction."""
        n, steps, _ = given.shape
        re = self.p[f"re_{way}"]
        h = np.zeros((n, HIDDEN), np.float32)
        out = np.empty((n, steps, HIDDEN), np.float32)
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            x, u = given[:, t], h @ re
            gates = 1 / (1 + np.exp(-(x[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])))
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            n_ = np.tanh(x[:, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
            new = n_ + z * (h - n_)
            m = mask[:, t, None]
            if keep is not None:
                keep.append((t, h, z, r, n_, u[:, 2 * HIDDEN :], m))
            h = h + m * (new - h)
            out[:, t] = h
        return out

    def odds(self, given: np.ndarray, mask: np.ndarray, kept: dict | None = None) -> np.ndarray:
        """Log odds of windows from their words' projections."""
        width = 3 * HIDDEN
        keep = {"f": None, "b": None} if kept is None else {"f": [], "b": []}
        states = np.concatenate(
            [
                self._read(given[:, :, :width], mask, "f", keep["f"]),
                self._read(given[:, :, width:], mask, "b", keep["b"]),
            ],
            axis=2,
        )
        seen = np.tanh(states @ self.p["att"])
        weight = seen @ self.p["att_v"] - 1e9 * (1 - mask)
        weight = np.exp(weight - weight.max(axis=1, keepdims=True))
        weight /= weight.sum(axis=1, keepdims=True)
        pooled = np.einsum("nt,nth->nh", weight, states)
        if kept is not None:
            kept.update(keep=keep, states=states, seen=seen, weight=weight, pooled=pooled)
        return pooled @ self.p["out"] + self.p["bias"][0]

    def gradients(self, words: list[bytes], ids: np.ndarray, mask: np.ndarray, target: np.ndarray) -> dict:
        """Gradients of the mean log loss over windows; ``ids`` index ``words``."""
        p, n = self.p, len(ids)
        bucket, grams, starts = Words.inputs(words)
        x = self.embedded(words)
        kept: dict = {}
        odds = self.odds(self.projected(words)[ids], mask, kept)
        d_odds = ((_sigmoid(odds) - target) / n).astype(np.float32)
        g = {"out": kept["pooled"].T @ d_odds, "bias": d_odds.sum(keepdims=True)}
        d_pool = d_odds[:, None] * p["out"]
        states, seen, weight = kept["states"], kept["seen"], kept["weight"]
        d_states = weight[:, :, None] * d_pool[:, None, :]
        d_w = np.einsum("nth,nh->nt", states, d_pool)
        d_w = weight * (d_w - (weight * d_w).sum(axis=1, keepdims=True))
        g["att_v"] = np.einsum("nt,nta->a", d_w, seen)
        d_seen = d_w[:, :, None] * p["att_v"] * (1 - seen**2)
        g["att"] = np.einsum("nth,nta->ha", states, d_seen)
        d_states += d_seen @ p["att"].T
        d_x = np.zeros_like(x)
        for way, side in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, 2 * HIDDEN))):
            re = p[f"re_{way}"]
            g_re, d_given = np.zeros_like(re), np.zeros((len(words), 3 * HIDDEN), np.float32)
            d_h = np.zeros((n, HIDDEN), np.float32)
            for t, h, z, r, n_, u_n, m in reversed(kept["keep"][way]):
                d_h = d_h + d_states[:, t, side]
                d_new, d_old = d_h * m, d_h * (1 - m)
                d_n = d_new * (1 - z) * (1 - n_**2)
                d_z = d_new * (h - n_) * z * (1 - z)
                d_r = d_n * u_n * r * (1 - r)
                d_u = np.concatenate([d_z, d_r, d_n * r], axis=1)
                np.add.at(d_given, ids[:, t], np.concatenate([d_z, d_r, d_n], axis=1))
                g_re += h.T @ d_u
                d_h = d_old + d_new * z + d_u @ re.T
            g[f"re_{way}"] = g_re
            g[f"in_{way}"], g[f"in_b_{way}"] = x.T @ d_given, d_given.sum(axis=0)
            d_x += d_given @ p[f"in_{way}"].T
        g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        np.add.at(g["word"], bucket, d_x[:, :WORD_SIZE])
        counts = np.diff(np.append(starts, len(grams)))
        each = np.repeat(d_x[:, WORD_SIZE:] / counts[:, None], counts, axis=0)
        np.add.at(g["char"], grams, each)
        return g

    def train(self, texts: list[str], target: np.ndarray, seed: int = 13) -> Network:
        if len(set(target.tolist())) < 2:
            self.constant = float(target.mean()) if len(target) else 0.5
            return self
        docs = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
        self._start(docs, target)
        share = float(target.mean())
        self.p["bias"][0] = np.log(share / (1 - share))
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(v) for k, v in self.p.items()}
        rng, step = np.random.default_rng(seed), 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(docs))
            for at in range(0, len(order), BATCH):
                chosen = [i for i in order[at : at + BATCH] if docs[i]]
                if not chosen:
                    continue
                words, ids, mask, owner = windows_of([docs[i] for i in chosen])
                odds = self.odds(self.projected(words)[ids], mask)
                best = [np.flatnonzero(owner == k)[odds[owner == k].argmax()] for k in range(len(chosen))]
                used, place = np.unique(ids[best], return_inverse=True)
                some = [words[i] for i in used]
                grads = self.gradients(some, place.reshape(len(best), -1), mask[best], target[chosen])
                step += 1
                for k, grad in grads.items():
                    m[k] += 0.1 * (grad - m[k])
                    v[k] += 0.01 * (grad**2 - v[k])
                    mean, spread = m[k] / (1 - 0.9**step), v[k] / (1 - 0.99**step)
                    self.p[k] -= (RATE * mean / (np.sqrt(spread) + 1e-6)).astype(np.float32)
        return self

    def _start(self, docs: list[list[bytes]], target: np.ndarray) -> None:
        """Log odds of each word bucket and trigram bucket as the first number of its vector."""
        words = np.ones((2, WORD_BUCKETS))
        chars = np.ones((2, TRIGRAM_BUCKETS))
        for doc, label in zip(docs, target):
            if doc:
                bucket, grams, _ = Words.inputs(list(set(doc)))
                words[int(label), np.unique(bucket)] += 1
                chars[int(label), np.unique(grams)] += 1
        of = np.array([(target == 0).sum(), (target == 1).sum()])[:, None] + 2
        for name, seen in (("word", words), ("char", chars)):
            share = seen / of
            self.p[name][:, 0] = np.clip(np.log(share[1] / share[0]), -4, 4)

    def scores(self, texts: list[str], kept: dict, most_kept: int = 200_000) -> np.ndarray:
        """Probability of toxicity of each text. ``kept`` holds projections of words met before."""
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        index, table = kept.setdefault("index", {}), kept.get("table")
        docs = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
        if len(index) > most_kept:
            index.clear()
            table = None
        new: list[bytes] = []
        rows = []
        for doc in docs:
            row = []
            for word in doc:
                at = index.get(word)
                if at is None:
                    at = index[word] = len(index)
                    new.append(word)
                row.append(at)
            rows.append(np.array(row, np.int64))
        if new:
            added = self.projected(new)
            table = added if table is None else np.concatenate([table, added])
        kept["table"] = table
        best = np.full(len(texts), -np.inf)
        best[[not len(r) for r in rows]] = self.p["bias"][0]
        starts, owner = [], []
        for k, row in enumerate(rows):
            at = window_starts(len(row))
            starts.append(at)
            owner.append(np.full(len(at), k))
        begin = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        flat = np.concatenate([*rows, np.zeros(WINDOW, np.int64)])
        owner_all = np.concatenate(owner).astype(np.int64)
        start_all = np.concatenate(starts).astype(np.int64)

        def scored(owner: np.ndarray, start: np.ndarray) -> np.ndarray:
            """Log odds of windows; the most of each text goes into ``best``."""
            out = np.empty(len(owner))
            for at in range(0, len(owner), 2048):
                own, first = owner[at : at + 2048], start[at : at + 2048]
                size = np.minimum(begin[own + 1] - begin[own] - first, WINDOW)
                places = (begin[own] + first)[:, None] + np.arange(WINDOW)
                mask = (np.arange(WINDOW) < size[:, None]).astype(np.float32)
                odds = self.odds(table[flat[np.minimum(places, len(flat) - 1)]], mask)
                out[at : at + 2048] = odds
                np.maximum.at(best, own, odds)
            return out

        odds = scored(owner_all, start_all)
        near = np.flatnonzero((np.abs(odds) <= NEAR) & (best[owner_all] <= NEAR))
        if len(near):
            around = np.arange(1 - STRIDE, STRIDE)
            own = np.repeat(owner_all[near], len(around))
            last = np.maximum(begin[own + 1] - begin[own] - WINDOW, 0)
            first = (start_all[near][:, None] + around).ravel()
            inside = (first >= 0) & (first <= last) & (first % STRIDE != 0)
            own, first = np.unique(np.stack([own[inside], first[inside]]), axis=1)
            scored(own, first)
        return _sigmoid(best.astype(np.float64))


def window_starts(words: int) -> np.ndarray:
    """Starts of windows that overlap by half; the last one ends with the text."""
    if not words:
        return np.array([], np.int64)
    last = max(words - WINDOW, 0)
    return np.append(np.arange(0, last, STRIDE), last)


def windows_of(docs: list[list[bytes]]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words, windows as indices of them, masks, and the document of each window."""
    index: dict[bytes, int] = {}
    ids, mask, owner = [], [], []
    for k, doc in enumerate(docs):
        row = [index.setdefault(w, len(index)) for w in doc]
        for start in window_starts(len(row)):
            part = row[start : start + WINDOW]
            ids.append(part + [0] * (WINDOW - len(part)))
            mask.append([1.0] * len(part) + [0.0] * (WINDOW - len(part)))
            owner.append(k)
    return list(index), np.array(ids), np.array(mask, np.float32), np.array(owner)


def train(
    labelled: DataFrame, docs: DataFrame, most: int = MOST_LABELLED, most_bytes: int = MOST_BYTES
) -> Network:
    """A network from (doc_id, target) rows and their documents: at most ``most`` texts of each kind, of
    at most ``most_bytes`` each."""
    kinds = [labelled_sample(labelled.where(F.col("target") == kind), docs, most, most_bytes) for kind in (0, 1)]
    chosen = staged(kinds[0].unionByName(kinds[1]), "labelled")
    texts = docs.select("doc_id", F.xxhash64(text_of()).alias("tie"), text_of().alias("text"))
    rows = texts.join(F.broadcast(chosen), [*ROW_KEY]).dropDuplicates([*ROW_KEY, "target"])
    rows = rows.select("doc_id", "text", "target").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"], r["target"]))
    return Network().train([r["text"] for r in rows], np.array([r["target"] for r in rows], np.float32))


def _scored(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    kept: dict = {}
    for batch in batches:
        texts, scores = batch.column("text").to_pylist(), []
        at = 0
        while at < len(texts):
            upto, size = at, 0
            while upto < len(texts) and (upto == at or size + len(texts[upto]) <= 1 << 20):
                size += len(texts[upto])
                upto += 1
            scores += model.value.scores(texts[at:upto], kept).tolist()
            at = upto
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"]
        )


def score(docs: DataFrame, model: Network) -> DataFrame:
    """doc_id and the probability of toxicity, one row per document."""
    spark = docs.sparkSession
    importable_by_workers(spark)
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(lambda batches: _scored(batches, shared), "doc_id bigint, score double")
