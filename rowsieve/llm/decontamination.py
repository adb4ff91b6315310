"""Benchmark decontamination by winnowing: which words of a document lie in a window
of consecutive words that a benchmark item has too.

A window is 13 item words; an item of fewer words is one window. From every run of
7 consecutive hashes of 7 words each, the least is kept as a fingerprint, so any 13
words that a document shares with an item leave one fingerprint in common, whatever
stands around them. A document's fingerprints are looked up among those of the items, as
hashes, each once: neither a gram that an item repeats nor one that many items have makes
more rows. What is hit is extended: all windows of 13 words around a hit that the document has are
compared with the items' windows, word by word. A shared span of 13 words or more holds a hit
in each of its windows, so it is found from end to end, and a text that goes in
circles costs no more than any other. Items too short to have a window of 13 words are looked up as
they are, by one hash per place and length; such lengths occur in no or few items.

No side is hinted: the planner broadcasts the staged item fingerprints and windows while
they are below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles beyond. Hits are
gathered per document, not per fingerprint, so a passage that many documents share stays
spread out. Only DataFrame functions are used.

Null or empty text has no words: such a document is never hit and such an item has no
window. Repeated items count each by its id; a repeated item id is one item with
several texts. Every row is judged by its own text, whether its id is repeated or null. Empty
tables give clean documents or an empty result. Extra columns are ignored by
``find_contamination`` and kept by ``keep_clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsieve.llm._shared import LOWER, ROW_KEY, UPPER, carried, join_by, staged, text_of, uncarried

WINDOW = 13
GRAM = 7

# Fixed value: what separates words here, every ASCII character but digits and a-z.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, UPPER, LOWER), NO_WORD), lambda w: w != "")


def _grams(words: str, size: int) -> Column:
    """Hash of ``size`` words from each place on; empty for shorter texts."""
    starts = F.slice(F.col(words), 1, F.greatest(F.size(words) - (size - 1), F.lit(0)))
    return F.transform(
        starts, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, size)])
    )


def _keys(words: str, size: int, places: int) -> Column:
    """Grams from each place on, whose low bits hold the place modulo ``places``."""
    codes = F.slice(F.col(words), 1, F.greatest(F.size(words) - (size - 1), F.lit(0)))
    return F.transform(
        codes,
        lambda code, i: F.xxhash64(code, *[F.get(words, i + k) for k in range(1, size)])
        .bitwiseAND(F.lit(-places))
        .bitwiseOR(i.bitwiseAND(F.lit(places - 1)).cast("bigint")),
    )


def _runs(keys: str, width: int) -> Column:
    """One element for each run of ``width`` keys."""
    return F.slice(F.col(keys), 1, F.greatest(F.size(keys) - (width - 1), F.lit(0)))


def _least(keys: str, width: int, i: Column) -> Column:
    run = [F.get(keys, i + k) for k in range(width)]
    return F.least(*run) if width > 1 else run[0]


def _marked(keys: str, at: Column, places: int) -> Column:
    """Places and hashes, each place once."""
    return F.transform(
        F.array_distinct(at),
        lambda p: F.struct(p.alias("at"), F.get(keys, p).bitwiseAND(F.lit(-places)).alias("hash")),
    )


def _winnowed(keys: str, width: int, places: int) -> Column:
    """A place with the least gram of every ``width`` grams. Which one of equal grams is
    taken depends on where the run begins."""
    at = F.transform(
        _runs(keys, width),
        lambda _, i: i
        + F.pmod(
            _least(keys, width, i).bitwiseAND(F.lit(places - 1)).cast("int") - i, F.lit(places)
        ),
    )
    return _marked(keys, at, places)


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """doc_id, n_words, n_hit, the hit item ids (sorted as text) and ``contaminated``.

    A document is contaminated when a twentieth of its words or more are hit.
    """
    return _judged(carried(docs).drop("row"), benchmark, window, gram).drop("tie")


def _judged(rows: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``find_contamination`` of rows made by ``carried``, with their keys."""
    width = window - gram + 1
    places = 1 << (width - 1).bit_length()
    items = staged(
        benchmark.select(F.col("item_id").cast("string").alias("item_id"), words_of(text_of()).alias("item"))
        .where(F.size("item") > 0)
        .withColumn("length", F.least(F.lit(window), F.size("item"))),
        "items",
    )
    lengths = sorted(r["length"] for r in items.select("length").distinct().collect() if r["length"] < window)
    starts = F.sequence(F.lit(0), F.size("item") - F.col("length"))
    windows = items.select("item_id", "length", F.explode(starts).alias("_s"), "item").select(
        "item_id", F.slice("item", F.col("_s") + 1, F.col("length")).alias("words")
    )
    windows = staged(windows.distinct(), "windows")

    def keyed(texts: DataFrame, words: str) -> DataFrame:
        codes = texts.withColumn("_codes", F.transform(words, lambda w: F.xxhash64(w)))
        return codes.withColumn("_keys", _keys("_codes", gram, places))

    def whole(words: str, length: int) -> Column:
        """Every run of ``length`` words, as the mark of a short item."""
        return F.transform(
            _grams(words, length),
            lambda code, i: F.struct(i.alias("at"), code.alias("hash"), F.lit(length).alias("length")),
        )

    def fingerprints(keys: str) -> Column:
        return F.transform(
            _winnowed(keys, width, places),
            lambda m: F.struct(m["at"].alias("at"), m["hash"].alias("hash"), F.lit(window).alias("length")),
        )

    marks = keyed(items.where(F.col("length") == window), "item").select(
        F.explode(fingerprints("_keys")).alias("m")
    )
    for length in lengths:
        short = items.where(F.col("length") == length)
        marks = marks.unionByName(short.select(F.explode(whole("item", length)).alias("m")))
    marks = staged(
        marks.select(F.col("m.hash").alias("mark"), F.col("m.length").alias("mark_length")).distinct(), "marks"
    )
    # Each row's number of words travels with its fingerprints, as one that meets nothing,
    # so that texts are split into words once.
    counted = F.struct(
        (-1 - F.size("words")).alias("at"),
        F.xxhash64("doc_id", "tie", F.lit("words")).alias("hash"),
        F.lit(0).alias("length"),
    )
    own = rows.select(*ROW_KEY, words_of(F.col("text")).alias("words"))
    prints = (
        keyed(own, "words")
        .select(
            *ROW_KEY,
            F.explode(
                F.concat(F.array(counted), fingerprints("_keys"), *[whole("words", n) for n in lengths])
            ).alias("_m"),
        )
        .select(*ROW_KEY, "_m.*")
    )
    meets = (F.col("hash") == F.col("mark")) & (F.col("length") == F.col("mark_length"))
    met = prints.join(marks, meets, "left").where(F.col("mark").isNotNull() | (F.col("at") < 0))
    met = staged(met.select(*ROW_KEY, "at", "length"), "met")
    counted = met.where("at < 0").select(*ROW_KEY, (-1 - F.col("at")).cast("bigint").alias("n_words"))

    # The windows around each hit, each once. Equal rows have the same ones.
    hits = met.where("at >= 0").distinct()
    per_row = hits.groupBy(*ROW_KEY).agg(F.collect_list(F.struct("at", "length")).alias("hits"))
    per_row = staged(per_row, "hits")
    # Only texts with a hit are shuffled while their keys are few enough for the planner to broadcast.
    hit_texts = join_by(rows, per_row.select(*ROW_KEY), "left_semi", *ROW_KEY).dropDuplicates([*ROW_KEY])
    hit_texts = hit_texts.select(*ROW_KEY, words_of(F.col("text")).alias("words"))
    hit_texts = join_by(hit_texts, per_row, "inner", *ROW_KEY)
    last = F.size("words") - window

    def around(hit: Column) -> Column:
        first = F.greatest(hit["at"] - (window - gram), F.lit(0))
        wide = F.when(first <= F.least(hit["at"], last), F.sequence(first, F.least(hit["at"], last)))
        at = F.when(hit["length"] == window, wide).otherwise(F.array(hit["at"]))
        return F.transform(at, lambda s: F.struct(s.alias("start"), hit["length"].alias("length")))

    near = F.array_distinct(F.flatten(F.transform("hits", around)))
    candidates = hit_texts.select(*ROW_KEY, "words", F.explode(near).alias("_w")).select(
        *ROW_KEY,
        F.col("_w.start").alias("start"),
        (F.col("_w.start") + F.col("_w.length")).alias("end"),
        F.slice("words", F.col("_w.start") + 1, F.col("_w.length")).alias("words"),
    )
    runs = staged(candidates.join(windows, "words").select(*ROW_KEY, "item_id", "start", "end"), "runs")
    # Hit words are counted by merging a document's runs in order of their starts.
    per_doc = runs.groupBy(*ROW_KEY).agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("_runs"),
        F.sort_array(F.collect_set("item_id")).alias("item_ids"),
    )
    merged = F.aggregate(
        "_runs",
        F.struct(F.lit(0).alias("upto"), F.lit(0).cast("bigint").alias("n")),
        lambda acc, r: F.struct(
            F.greatest(acc["upto"], r["end"]).alias("upto"),
            (acc["n"] + F.greatest(r["end"] - F.greatest(acc["upto"], r["start"]), F.lit(0))).alias("n"),
        ),
    )["n"]
    found = per_doc.select(*ROW_KEY, merged.alias("n_hit"), "item_ids")
    hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("bigint")
    return join_by(counted, found, "left", *ROW_KEY).select(
        *ROW_KEY,
        "n_words",
        hit.alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        ((hit > 0) & (20 * hit >= F.col("n_words"))).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their columns as they were."""
    rows = carried(docs)
    dirty = _judged(rows.drop("row"), benchmark).where("contaminated").select(*ROW_KEY).distinct()
    return uncarried(join_by(rows, dirty, "left_anti", *ROW_KEY), docs)
