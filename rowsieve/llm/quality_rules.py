"""Weak supervision of document quality: rules vote or abstain, their accuracies are
estimated by expectation-maximisation, and a posterior probability decides.

Every rule looks at a statistic of the text and votes good (+1), junk (-1) or abstains
(0). The label model has a prior and, per rule, the chance of a right vote given a
good document and given junk; an abstention says nothing. Documents are counted by
vote pattern first, of which there are at most 3 to the number of rules whatever the
corpus holds, and each iteration is one aggregate over the patterns that returns one
row. Only DataFrame functions are used.

What the base rule rejects is decided already, so the model learns from the rest: its
two classes are then not spent on telling short or looping texts from all others. The
length rule votes junk only on such texts, so what is learnt about it comes from its good votes.

Null text counts as empty and empty text has no words: all statistics are zero, every
rule but the length rule abstains, and the base rule rejects it. An empty table gives
an empty result. Extra columns are ignored by ``score_quality`` and kept by
``keep_good``. Rows are judged one by one, whether their ids are repeated or null.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsieve.llm._shared import BLANK_RUN, carried, staged, text_of, uncarried

ITERATIONS = 15
THRESHOLD = 0.5
#: Where estimation starts: good documents pass nearly every rule, and each kind of junk
#: fails few rules. ``LEAST_RIGHT`` keeps a rule's votes on good documents from being read as
#: their opposite, and the odds finite for junk.
START_PRIOR, START_RIGHT, LEAST_RIGHT = 0.7, (0.99, 0.3), (0.5, 0.02)
#: Votes that every rule is taken to have cast besides its own, half of them right.
PSEUDO_VOTES = 2.0

# The symbols and word characters that the statistics count.
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\f\r"
NO_LETTERS = "0123456789" + "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def text_statistics(docs: DataFrame, *others: str) -> DataFrame:
    """doc_id and the counts that the rules look at, one row per document; other columns if named.

    A word is a run without ASCII blanks. Three-word windows are compared by 64-bit
    hashes; only texts in which a window repeats sort them to find the places.
    """
    text = F.col("_text")
    words = docs.select(
        "doc_id",
        *others,
        text_of().alias("_text"),
        F.filter(F.split(text_of(), BLANK_RUN), lambda w: w != "").alias("_words"),
    )
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    hashed = words.select(
        "doc_id",
        *others,
        "_text",
        F.size("_words").cast("bigint").alias("n_words"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_h"),
        lines.alias("_lines"),
    )
    windows = hashed.withColumn(
        "_w",
        F.when(
            F.col("n_words") >= 3,
            F.transform(
                F.slice("_h", 1, F.greatest(F.col("n_words").cast("int") - 2, F.lit(0))),
                lambda h, i: F.xxhash64(h, F.get("_h", i + 1), F.get("_h", i + 2)),
            ),
        ),
    )
    placed = windows.withColumn(
        "_sorted",
        F.when(
            F.size(F.array_distinct("_w")) < F.size("_w"),
            F.sort_array(F.transform("_w", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    found_twice = F.filter(
        "_sorted",
        lambda x, i: x["h"].eqNullSafe(F.get("_sorted", i - 1)["h"])
        | x["h"].eqNullSafe(F.get("_sorted", i + 1)["h"]),
    )
    covered = F.array_distinct(
        F.flatten(F.transform(found_twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    )
    bare = F.translate(text, BLANKS, "")
    return placed.select(
        "doc_id",
        *others,
        "n_words",
        F.length(bare).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(F.size(covered), F.lit(0)).cast("bigint").alias("n_repeat_words"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        F.size(F.array_distinct("_h")).cast("bigint").alias("n_distinct_words"),
        (F.length(text) - F.length(F.translate(text, ".!?", ""))).cast("bigint").alias("n_stops"),
        F.length(F.translate(bare, NO_LETTERS, "")).cast("bigint").alias("n_letters"),
    )


@dataclass(frozen=True)
class Rule:
    """Votes junk where ``junk`` holds, good where ``good`` holds, else abstains."""

    name: str
    junk: Column
    good: Column

    def vote(self) -> Column:
        cast = F.when(self.junk, F.lit(-1)).when(self.good, F.lit(1)).otherwise(F.lit(0))
        return cast.cast("tinyint").alias(f"vote_{self.name}")


def default_rules() -> list[Rule]:
    """Rules over ``text_statistics``; a comparison with nothing to compare abstains."""
    n = F.col("n_words").cast("double")
    per_word = {c: F.try_divide(F.col(c), n) for c in (
        "n_symbols", "n_repeat_words", "word_chars", "n_distinct_words", "n_stops")}
    dup_lines = F.try_divide(F.col("n_dup_lines"), F.col("n_lines").cast("double"))
    letters = F.try_divide(F.col("n_letters"), F.col("word_chars").cast("double"))
    return [
        Rule("length", n < 50, n >= 100),
        Rule("symbols", per_word["n_symbols"] > 0.2, per_word["n_symbols"] < 0.05),
        Rule("repeats", per_word["n_repeat_words"] > 0.3, per_word["n_repeat_words"] < 0.1),
        Rule("lines", dup_lines > 0.3, (dup_lines < 0.1) & (F.col("n_lines") >= 3)),
        Rule(
            "word_size",
            ~per_word["word_chars"].between(3.0, 10.0),
            per_word["word_chars"].between(4.0, 8.0),
        ),
        Rule(
            "variety",
            (per_word["n_distinct_words"] < 0.25) & (n < 2000),
            (per_word["n_distinct_words"] > 0.4) & (n >= 50),
        ),
        Rule("letters", letters < 0.8, letters > 0.9),
        Rule("sentences", (per_word["n_stops"] < 0.01) & (n >= 50), per_word["n_stops"] > 0.04),
    ]


def _odds(votes: list[str], right: dict[str, tuple[float, float]], prior: float) -> Column:
    """Log odds of good under the label model, from the vote columns."""
    total = F.log(F.lit(prior / (1 - prior)))
    for vote in votes:
        good, junk = right[vote]
        total = total + F.when(F.col(vote) == 1, F.log(F.lit(good / (1 - junk)))).when(
            F.col(vote) == -1, F.log(F.lit((1 - good) / junk))
        ).otherwise(F.lit(0.0))
    return total


def _probability(odds: Column) -> Column:
    return 1 / (1 + F.exp(-odds))


def estimate(patterns: DataFrame, votes: list[str], iterations: int = ITERATIONS):
    """Prior and per-rule accuracies from vote patterns with their counts ``n``.

    Returns (prior, {vote: (right given good, right given junk)}). Without documents
    the starting values come back.
    """
    prior = START_PRIOR
    right = {vote: START_RIGHT for vote in votes}
    for _ in range(iterations):
        p = _probability(_odds(votes, right, prior))
        weighed = patterns.select("*", (p * F.col("n")).alias("_g"), ((1 - p) * F.col("n")).alias("_j"))
        sums = [F.sum("_g").alias("good"), F.sum("n").alias("all")]
        for vote in votes:
            said = F.col(vote)
            sums += [
                F.sum(F.when(said == 1, F.col("_g")).otherwise(0.0)).alias(f"{vote}_gr"),
                F.sum(F.when(said != 0, F.col("_g")).otherwise(0.0)).alias(f"{vote}_ga"),
                F.sum(F.when(said == -1, F.col("_j")).otherwise(0.0)).alias(f"{vote}_jr"),
                F.sum(F.when(said != 0, F.col("_j")).otherwise(0.0)).alias(f"{vote}_ja"),
            ]
        row = weighed.agg(*sums).first()
        if not row["all"]:
            break
        prior = (row["good"] + PSEUDO_VOTES / 2) / (row["all"] + PSEUDO_VOTES)

        def rate(hits: float, of: float) -> float:
            return (hits + PSEUDO_VOTES * 0.5) / (of + PSEUDO_VOTES)

        right = {
            vote: (
                max(LEAST_RIGHT[0], rate(row[f"{vote}_gr"], row[f"{vote}_ga"])),
                max(LEAST_RIGHT[1], rate(row[f"{vote}_jr"], row[f"{vote}_ja"])),
            )
            for vote in votes
        }
    return prior, right


def score_quality(
    docs: DataFrame, rules: list[Rule] | None = None, threshold: float = THRESHOLD,
    iterations: int = ITERATIONS, others: tuple[str, ...] = (),
) -> DataFrame:
    """Statistics, votes, posterior ``p_good``, ``base_failed`` and ``kept`` per document.

    The base rule rejects texts of under 50 words and those of which over half the
    words lie in repeated windows; ``kept`` wants a posterior of ``threshold`` besides.
    Columns named in ``others`` stay.
    """
    rules = rules or default_rules()
    votes = [f"vote_{rule.name}" for rule in rules]
    voted = staged(text_statistics(docs, *others).select("*", *[r.vote() for r in rules]), "votes")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    undecided = voted.where(~failed).groupBy(*votes).agg(F.count(F.lit(1)).alias("n"))
    prior, right = estimate(staged(undecided.coalesce(1), "patterns"), votes, iterations)
    return voted.select(
        "*",
        failed.alias("base_failed"),
        _probability(_odds(votes, right, prior)).alias("p_good"),
    ).withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that ``score_quality`` keeps, with their columns as they were."""
    return uncarried(score_quality(carried(docs), others=("row",)).where("kept"), docs)
