"""Weak supervision over quality rules: rules vote or abstain, EM weighs them, a posterior decides.

Everything is a column expression; no Python runs on the executors. A text is
measured within its own row, so nothing is shuffled but one count per voting
pattern (at most three to the number of rules). EM runs over these counts,
which stand for all rows.

Results: a null text has no words. Rows without a vote get the prior. Repeated
rows get equal results, an empty table gives an empty one and a model with its
starting values. Extra columns pass through; an input column named like a
result is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apexlake.llm.common import unused

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 5
MINIMUM_WORDS = 10
MOST_REPEATED = 20  # per cent of the words

RULES = (
    "plain_words", "variety", "symbols", "repeated_windows", "repeated_lines", "adjacent_words", "word_length", "capitals",
    "shouts",
)
LEAST_RIGHT, MOST_RIGHT = 0.55, 0.98
PLAIN_WORD = r"^[\p{L}\p{N}'’\-]+[.,;:!?]?$"
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_adjacent", "n_distinct",
    "n_upper", "n_shouts", "n_plain",
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(hashes: Column) -> Column:
    """Words inside windows whose words occur again in the text, from one hash per word."""
    last = F.size(hashes) - WINDOW
    windows = F.when(last >= 0, F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]),
    )).otherwise(F.array().cast("array<bigint>"))

    def covered(found: Column) -> Column:
        placed = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(placed, lambda rows: F.filter(
            F.transform(rows, lambda x, j: F.when(
                (F.coalesce(F.get(rows, j - 1)["h"] == x["h"], F.lit(False)))
                | (F.coalesce(F.get(rows, j + 1)["h"] == x["h"], F.lit(False))), x["i"])),
            lambda i: i.isNotNull()))
        return let(F.sort_array(twice), lambda starts: F.aggregate(
            F.transform(starts, lambda s, j: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, j + 1) - s, F.lit(WINDOW)))),
            F.lit(0), lambda total, n: total + n))

    return let(windows, lambda found: F.when(
        F.size(F.array_distinct(found)) == F.size(found), F.lit(0)).otherwise(covered(found)))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measures of each text, as bigints."""
    source = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(source, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    words = F.regexp_extract_all(source, F.lit(WORD), F.lit(0))

    def of_words(own: Column) -> Column:
        return let(F.transform(own, lambda w: F.xxhash64(w)), lambda h: F.struct(
            F.size(h).alias("n_words"),
            F.length(F.array_join(own, "")).alias("word_chars"),
            _repeat_words(h).alias("n_repeat_words"),
            F.size(F.array_distinct(h)).alias("n_distinct"),
            F.size(F.filter(own, lambda w: w.rlike(PLAIN_WORD))).alias("n_plain"),
            F.size(F.filter(h, lambda x, i: x == F.get(h, i - 1))).alias("n_adjacent"),
        ))

    inner = unused(docs, "measured")
    of_text, by_line = f"{inner}_words", f"{inner}_lines"
    measured = docs.withColumn(of_text, let(words, of_words)).withColumn(by_line, let(lines, lambda own: F.struct(
        F.size(own).alias("n_lines"), (F.size(own) - F.size(F.array_distinct(own))).alias("n_dup_lines"))))
    found = {
        **{name: F.col(f"{of_text}.{name}") for name in ("n_words", "word_chars", "n_repeat_words", "n_distinct", "n_adjacent", "n_plain")},
        **{name: F.col(f"{by_line}.{name}") for name in ("n_lines", "n_dup_lines")},
        "n_symbols": F.regexp_count(source, F.lit(SYMBOL)),
        "n_upper": F.regexp_count(source, F.lit(r"\p{Lu}")),
        "n_shouts": F.regexp_count(source, F.lit("!!")),
    }
    return measured.withColumns({name: found[name].cast("bigint") for name in MEASURES}).drop(of_text, by_line)


def _rules() -> dict[str, Column]:
    """Each rule's vote from the measures: 1 for good, 0 for bad, null to abstain.

    Most rules only know a fault; the absence of one fault says little, so they abstain then.
    """
    n = F.greatest(F.col("n_words"), F.lit(1))
    several, many = F.col("n_words") >= 10, F.col("n_words") >= 40
    length, plain, variety = F.col("word_chars") / n, F.col("n_plain") / n, F.col("n_distinct") / F.sqrt(n)
    lines = F.greatest(F.col("n_lines"), F.lit(1))

    def fault(found: Column) -> Column:
        return F.when(found, F.lit(0))

    return {
        "plain_words": fault(plain < 0.6).when(plain >= 0.8, F.lit(1)),
        "variety": fault(many & (variety < 2)),
        "symbols": fault(F.col("n_symbols") / n > 0.1),
        "repeated_windows": fault(several & (F.col("n_repeat_words") / n > 0.2)),
        "repeated_lines": fault((F.col("n_lines") >= 3) & (F.col("n_dup_lines") / lines > 0.3)),
        "adjacent_words": fault(several & (F.col("n_adjacent") / n > 0.3)),
        "word_length": fault(several & ~length.between(2, 13)),
        "capitals": fault(F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1)) > 0.3),
        "shouts": fault(F.col("n_shouts") / n > 0.1),
    }


@dataclass(frozen=True)
class Model:
    """Share of good rows, and for each rule how often its vote is right."""

    prior: float
    accuracy: dict[str, float]


def vote(measured: DataFrame) -> DataFrame:
    """Add one column ``vote_<rule>`` per rule."""
    return measured.withColumns({f"vote_{name}": rule for name, rule in _rules().items()})


def fit(voted: DataFrame, rounds: int = 100, tolerance: float = 1e-9) -> Model:
    """Accuracies by expectation-maximisation over the counts of all voting patterns.

    Starts from rules that are right four times in five and from the share of
    rows without a majority against them. An accuracy stays between
    ``LEAST_RIGHT`` and ``MOST_RIGHT``: a rule never counts against its own
    vote, and none decides alone whatever the others say. The counts come to the
    driver: at most three to the number of rules, whatever the input.
    """
    columns = [f"vote_{name}" for name in RULES]
    patterns = [(tuple(row[c] for c in columns), row["n"]) for row in voted.groupBy(*columns).agg(F.count("*").alias("n")).collect()]
    total = sum(n for _, n in patterns)
    leaning = sum(n for votes, n in patterns if votes.count(1) >= votes.count(0))
    model = Model((leaning + 1) / (total + 2), dict.fromkeys(RULES, 0.8))
    for _ in range(rounds if total else 0):
        weights = [(votes, n, _posterior(model, votes)) for votes, n in patterns]
        accuracy = {}
        for k, name in enumerate(RULES):
            cast = [(n, p if votes[k] else 1 - p) for votes, n, p in weights if votes[k] is not None]
            right = (4 + sum(n * p for n, p in cast)) / (5 + sum(n for n, _ in cast))
            accuracy[name] = min(MOST_RIGHT, max(LEAST_RIGHT, right))
        after = Model((1 + sum(n * p for _, n, p in weights)) / (2 + total), accuracy)
        moved = abs(after.prior - model.prior) + sum(abs(accuracy[r] - model.accuracy[r]) for r in RULES)
        model = after
        if moved < tolerance:
            break
    return model


def _log_odds(chance: float) -> float:
    return math.log(chance / (1 - chance))


def _posterior(model: Model, votes: tuple) -> float:
    odds = _log_odds(model.prior)
    for chance, v in zip(model.accuracy.values(), votes):
        odds += 0.0 if v is None else _log_odds(chance) * (1 if v else -1)
    return 1 / (1 + math.exp(-odds))


def judge(voted: DataFrame, model: Model) -> DataFrame:
    """Add ``quality`` (posterior probability of a good row), ``base_failed`` and ``kept``."""
    odds = F.lit(_log_odds(model.prior))
    for name, chance in model.accuracy.items():
        vote_ = F.col(f"vote_{name}")
        odds = odds + F.when(vote_ == 1, _log_odds(chance)).when(vote_ == 0, -_log_odds(chance)).otherwise(0.0)
    failed = (F.col("n_words") < MINIMUM_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return (
        voted.withColumn("quality", 1 / (1 + F.exp(-odds))).withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))
    )
