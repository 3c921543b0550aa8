"""Quality of documents from rules that vote, their accuracies estimated without labels.

1. One pass over the texts gives the counts of each document, and every rule of ``RULES``
   votes good or bad or abstains, by its measure of these counts.  They are written without texts.
2. Documents are counted by their votes: at most 3 ** (number of rules) rows, whatever the input.
3. Expectation-maximisation over these counts estimates the share of good documents and, for
   each rule, how often its vote is right on good and on bad ones.  A step is one
   aggregation of the counts to a single row; ``STEPS`` are made, from the votes imagined
   below.  A rule is right on at least ``ON_GOOD`` of the good documents, as it votes bad on
   extremes only, and votes bad on bad ones more often than on good ones; this tells which
   of the two kinds is which.  It may well overlook most bad ones: there are many ways to be bad.
4. The posterior probability of being good, from all its votes together, decides on a
   document: a bad vote counts by how sure that rule proved, and may be outweighed.

Everything is DataFrame expressions; the driver gets one row of sums a step.

Words are runs of other characters than ASCII white space.  A 5-word window is repeated
if the same words occur at another position of its text; windows are compared by 64-bit
hashes within one text (for a text of a million words, odds of 3 in 100 million that any
two different ones agree).  Texts of fewer words have no window.

Null and empty texts have no words: all counts are 0, rules that divide by words or
letters abstain.  Whole texts are counted, however long, in one row each.  Rows that
repeat are judged each.  An empty table gives none.  Columns named like those added here are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.storage import written

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 5
STEPS = 20
#: Imagined right and wrong votes of each rule on good and on bad documents, and imagined good and bad documents.
RIGHT_ON_GOOD, RIGHT_ON_BAD, IMAGINED = (99.0, 1.0), (3.0, 7.0), (17.0, 3.0)
ON_GOOD = 0.99
#: How much more often, at least, a rule votes bad on bad documents than on good ones.
MORE = 0.05
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_capitals", "n_letters", "n_marks", "n_different",
)


@dataclass(frozen=True)
class Rule:
    """Votes good up to ``good`` and bad from ``bad`` on, or the other way round if ``good`` is the greater."""

    name: str
    measure: str
    good: float
    bad: float

    def vote(self) -> Column:
        """1 good, -1 bad, 0 abstains."""
        m = F.expr(self.measure)
        high = self.good > self.bad
        good, bad = (m >= self.good, m <= self.bad) if high else (m <= self.good, m >= self.bad)
        return F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0))


#: Measures are SQL expressions over ``COUNTS``; dividing by 0 gives null, and the rule abstains.
#: Measures of one fault are one rule, as votes are taken to be independent within either kind of documents.
RULES = (
    Rule("long_enough", "n_words", 30, 9),
    Rule("word_length", "abs(word_chars / nullif(n_words, 0) - 6.0e0)", 3.5, 9),
    Rule("symbols", "n_symbols / nullif(n_words, 0)", 0.02, 0.2),
    Rule(
        "repetition",
        "greatest(2.5e0 * n_dup_lines / nullif(n_lines, 0), 5.0e0 * n_repeat_words / nullif(n_words, 0),"
        " sqrt(n_words) / nullif(n_different, 0))",
        0.5, 1,
    ),
    Rule("shouting", "greatest(n_capitals / nullif(n_letters, 0), 2.0e0 * n_marks / nullif(n_words, 0))", 0.2, 0.6),
)


def repeated_words(words: Column) -> Column:
    """Words of the array that lie in a window whose words occur at another position too."""
    starts = F.when(F.size(words) >= WINDOW, F.sequence(F.lit(0), F.size(words) - WINDOW)).otherwise(
        F.array().cast("array<int>")
    )
    hashed = F.transform(starts, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))))

    def covered(ordered: Column) -> Column:
        again = F.filter(
            ordered,
            lambda x, j: F.coalesce(F.get(ordered, j - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(ordered, j + 1)["h"] == x["h"], F.lit(False)),
        )
        return F.aggregate(
            F.sort_array(F.transform(again, lambda x: x["i"])),
            F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
            lambda s, i: F.struct((s["n"] + i + WINDOW - F.greatest(i, s["to"])).alias("n"), (i + WINDOW).alias("to")),
            lambda s: s["n"],
        )

    def counted(hashes: Column) -> Column:
        return _bound(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), covered)

    # most texts repeat nothing, and need no sorting
    return _bound(hashed, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(counted(h)))


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without its text, with ``COUNTS`` as long columns."""
    kept = [c for c in df.columns if c not in (text, *COUNTS)]
    whole = F.coalesce(F.col(text), F.lit(""))

    def left(pattern: str) -> Column:
        return F.char_length(F.regexp_replace(whole, F.lit(pattern), F.lit("")))

    lines = F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(WORD))
    words = F.regexp_extract_all(whole, F.lit(WORD), F.lit(0))
    of_words = _bound(words, lambda w: F.struct(
        F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("different"), repeated_words(w).alias("repeated"),
    ))
    of_lines = _bound(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("different")))
    read = df.select(
        *kept,
        of_words.alias("words_"),
        of_lines.alias("lines_"),
        left(SPACE).alias("word_chars"),
        left(r"[^#*$%&|<>]+").alias("n_symbols"),
        left(r"[^A-Z]+").alias("n_capitals"),
        left(r"[^A-Za-z]+").alias("n_letters"),
        left(r"[^!?]+").alias("n_marks"),
    )
    found = {
        "n_words": F.col("words_.n"),
        "word_chars": F.col("word_chars"),
        "n_symbols": F.col("n_symbols"),
        "n_dup_lines": F.col("lines_.n") - F.col("lines_.different"),
        "n_repeat_words": F.col("words_.repeated"),
        "n_lines": F.col("lines_.n"),
        "n_capitals": F.col("n_capitals"),
        "n_letters": F.col("n_letters"),
        "n_marks": F.col("n_marks"),
        "n_different": F.col("words_.different"),
    }
    return read.select(*kept, *(found[c].cast("long").alias(c) for c in COUNTS))


# ---------------------------------------------------------------- votes


@dataclass(frozen=True)
class Accuracies:
    """Share of good documents; per rule, the share of its votes that are right on good and on bad ones."""

    good: float
    on_good: tuple[float, ...]
    on_bad: tuple[float, ...]

    def posterior(self, votes: Column) -> Column:
        """The probability of being good, given an array of votes."""

        def product(right: tuple[float, ...], vote: int, share: float) -> Column:
            # by rule and vote; one literal, so that all steps share their compiled code
            shares = [x for p in right for x in ((1 - p, 1.0, p) if vote == 1 else (p, 1.0, 1 - p))]
            table = F.array(*map(F.lit, [share, *shares]))
            total = F.get(table, F.lit(0))
            for k in range(len(right)):
                total = total * F.get(table, F.get(votes, F.lit(k)).cast("int") + (3 * k + 2))
            return total

        good, bad = product(self.on_good, 1, self.good), product(self.on_bad, -1, 1 - self.good)
        return good / (good + bad)


def start(rules: int) -> Accuracies:
    good, bad, share = (a / (a + b) for a, b in (RIGHT_ON_GOOD, RIGHT_ON_BAD, IMAGINED))
    return Accuracies(share, (good,) * rules, (bad,) * rules)


def step(patterns: DataFrame, now: Accuracies) -> Accuracies:
    """One step of expectation and maximisation over (votes, n)."""
    rules = len(now.on_good)
    weighed = patterns.withColumn("p", now.posterior(F.col("votes")))
    good, bad = F.col("n") * F.col("p"), F.col("n") * (1 - F.col("p"))
    vote = [F.get("votes", F.lit(k)) for k in range(rules)]

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0.0))

    sums = weighed.agg(
        total(good), total(bad),
        *(total(F.when(v == 1, good)) for v in vote), *(total(F.when(v != 0, good)) for v in vote),
        *(total(F.when(v == -1, bad)) for v in vote), *(total(F.when(v != 0, bad)) for v in vote),
    ).first()
    parts = [sums[2 + k * rules : 2 + (k + 1) * rules] for k in range(4)]

    on_good = tuple(
        max(ON_GOOD, (r + RIGHT_ON_GOOD[0]) / (e + sum(RIGHT_ON_GOOD))) for r, e in zip(parts[0], parts[1], strict=True)
    )
    on_bad = tuple(
        max(1 - g + MORE, (r + RIGHT_ON_BAD[0]) / (e + sum(RIGHT_ON_BAD)))
        for r, e, g in zip(parts[2], parts[3], on_good, strict=True)
    )
    return Accuracies((sums[0] + IMAGINED[0]) / (sums[0] + sums[1] + sum(IMAGINED)), on_good, on_bad)


def estimated(patterns: DataFrame, rules: int, steps: int = STEPS) -> Accuracies:
    now = start(rules)
    for _ in range(steps):
        now = step(patterns, now)
    return now


def judged(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df`` without its text, with ``COUNTS``, the array ``votes`` and ``quality``, the posterior probability of being good."""
    counted = counts(df.drop("votes", "quality"), text)
    voted = written(counted.withColumn("votes", F.array(*(r.vote().cast("tinyint") for r in rules))), "votes")
    # at most 3 ** len(rules) rows
    patterns = written(voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")), "patterns", files=1)
    found = estimated(patterns, len(rules))
    return voted.withColumn("quality", found.posterior(F.col("votes")))
