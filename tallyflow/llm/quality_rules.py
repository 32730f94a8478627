"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation estimates how accurate they are on good texts and on each kind of bad ones. Native expressions only."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.common import cut, words_of


def text_figures(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and, for the rules, n_lines, n_upper, n_marks and n_same of each whole text. Null texts count as empty.

    Repeated windows are found within the row: 64-bit hashes of the five-word windows, sorted with their positions only where
    some hash occurs twice. No words leave the row, so a long text costs its own row alone.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("words", words_of(F.col("text")))
    window = lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(5)])
    hashes = F.when(F.size("words") >= 5, F.transform(F.sequence(F.lit(0), F.size("words") - 5), window)).otherwise(F.array().cast("array<long>"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    removed = lambda pattern: F.length(F.regexp_replace("text", pattern, ""))
    rows = base.withColumn("hashes", hashes).withColumn("lines", lines)
    order = F.array_sort(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("order", F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), order))
    twice = lambda x, i: (F.get("order", i + 1)["h"] == x["h"]) | (F.get("order", i - 1)["h"] == x["h"])
    rows = rows.withColumn("places", F.when(F.col("order").isNotNull(), F.array_sort(F.transform(F.filter("order", lambda x, i: F.coalesce(twice(x, i), F.lit(False))), lambda x: x["i"]))))
    covered = F.aggregate(F.transform("places", lambda p, k: F.least(F.lit(5), F.coalesce(F.get("places", k + 1) - p, F.lit(5)))), F.lit(0).cast("long"), lambda a, x: a + x)
    same = F.size(F.filter("words", lambda w, i: F.coalesce(F.get("words", i - 1) == w, F.lit(False))))
    return rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        (F.length("text") - removed(r"[^\x20\x09-\x0D]+")).cast("long").alias("word_chars"),
        removed(r"[^#*$%&|<>]+").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        removed(r"[^A-Z]+").cast("long").alias("n_upper"),
        removed(r"[^!?]+").cast("long").alias("n_marks"),
        same.cast("long").alias("n_same"),
    )


def _rule(value, good: float, bad: float):
    """A vote: 0 (bad) from ``bad`` upwards, 1 (good) up to ``good``, null (abstains) between."""
    return F.when(value >= bad, 0).when(value <= good, 1)


def _per(a: str, b: str):
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


#: The rules, by name: votes over the columns of text_figures.
RULES = {
    "symbols": lambda: _rule(_per("n_symbols", "n_words"), 0.02, 0.1),
    "repeated_windows": lambda: _rule(_per("n_repeat_words", "n_words"), 0.02, 0.2),
    "repeated_lines": lambda: F.when(F.col("n_lines") >= 4, _rule(_per("n_dup_lines", "n_lines"), 0.0, 0.3)),
    "capitals": lambda: _rule(_per("n_upper", "word_chars"), 0.1, 0.4),
    "marks": lambda: _rule(_per("n_marks", "n_words"), 0.05, 0.3),
    "same_word": lambda: _rule(_per("n_same", "n_words"), 0.05, 0.15),
    "word_length": lambda: _rule(F.abs(_per("word_chars", "n_words") - 6), 3.0, 6.0),
}


#: Kinds of badness, with the rules that speak of them; each kind is a class of its own beside the good texts.
FAMILIES = (("symbols",), ("repeated_windows", "repeated_lines", "same_word"), ("capitals", "marks"), ("word_length",))


def estimate(patterns: list[tuple[tuple[int | None, ...], int]], rounds: int = 50, smooth: float = 0.5) -> tuple[list[float], list[list[float]]]:
    """(prior of each class, for each class and rule the probability of a good vote), from counts of vote patterns.

    Expectation-maximisation over the good texts, class 0, and the kinds of badness: bad texts have unlike causes, which a
    single bad class would not describe. Given its class, a text's votes are independent; abstentions say nothing. It starts
    from the verdict of each family of rules.
    """
    names, total = list(RULES), sum(n for _, n in patterns)
    members = [[names.index(r) for r in family] for family in FAMILIES]
    classes = range(len(FAMILIES) + 1)
    belongs = []
    for votes, _ in patterns:
        bad = [float(any(votes[r] == 0 for r in m)) for m in members]
        start = [0.1 if any(bad) else 0.9, *[0.05 + x for x in bad]]
        belongs.append([x / sum(start) for x in start])
    priors, rates = [1 / len(classes)] * len(classes), [[0.5] * len(names) for _ in classes]
    for _ in range(rounds):
        for c in classes:
            weights = [b[c] * n for b, (_, n) in zip(belongs, patterns, strict=True)]
            priors[c] = (sum(weights) + smooth) / (total + smooth * len(classes))
            for r in range(len(names)):
                voted = [(w, votes[r]) for w, (votes, _) in zip(weights, patterns, strict=True) if votes[r] is not None]
                lean = 0.1 if c and r in members[c - 1] else 0.9
                rates[c][r] = (sum(w * v for w, v in voted) + 2 * smooth * lean) / (sum(w for w, _ in voted) + 2 * smooth)
        belongs = [posteriors(priors, rates, votes) for votes, _ in patterns]
    return priors, rates


def posteriors(priors, rates, votes) -> list[float]:
    """Probability of each class given the votes."""
    logs = [math.log(p) + sum(math.log(x if v else 1 - x) for x, v in zip(rs, votes, strict=True) if v is not None) for p, rs in zip(priors, rates, strict=True)]
    top = max(logs)
    parts = [math.exp(x - top) for x in logs]
    return [x / sum(parts) for x in parts]


def quality_rules(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are ignored): the figures, base_failed, kept and posterior.

    base_failed: fewer than 10 words, or over 20 % of the words in repeated five-word windows. Such texts are not kept; others
    are if the posterior probability of good quality is ``threshold`` or more. The rules' rates are estimated from all texts:
    Spark counts the vote patterns, at most 3 to the number of rules, and only these counts reach the driver. An empty table
    gives no rows; a null doc_id is carried along; repeated rows are judged each.
    """
    figures = cut(text_figures(docs).select("*", *[rule().cast("int").alias(f"vote_{name}") for name, rule in RULES.items()]))
    votes = [f"vote_{name}" for name in RULES]
    counted = [(tuple(r[:-1]), r[-1]) for r in figures.groupBy(*votes).agg(F.count("*").alias("n")).collect()]
    priors, rates = estimate(counted)
    logs = []
    for prior, rs in zip(priors, rates, strict=True):
        each = [F.when(F.col(name) == 1, math.log(x)).when(F.col(name) == 0, math.log(1 - x)).otherwise(0.0) for name, x in zip(votes, rs, strict=True)]
        logs.append(sum(each, F.lit(math.log(prior))))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    posterior = 1 / sum((F.exp(F.least(x - logs[0], F.lit(700.0))) for x in logs[1:]), F.lit(1.0))
    return figures.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & (posterior >= threshold)).alias("kept"), posterior.alias("posterior"))
