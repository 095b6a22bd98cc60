"""Quality rules as weak supervision: rules vote or abstain, and a document is kept if its posterior
probability of being good is at least one half.

Every rule looks at one measure of the whole text and votes keep, votes reject or abstains between
its two bounds. Expectation-maximisation estimates, without labels, the share of good documents
and for each rule how often it votes right on good and on bad documents. Documents only matter
through their votes, so the estimation runs on the counts of the vote patterns (at most
3 ** rules rows, written once); a round is one aggregate over them, of which one row of sums
reaches the driver. The posterior is then a column expression with the estimates as literals.

Only DataFrame functions; texts are read once and nothing but pattern counts is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmart.llm.common import SPACE, SPACE_CHARS, materialize

SYMBOLS = "#*$%&|<>"
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """Votes reject at ``bad`` or beyond, keep at ``good`` or before it, else abstains.

    The measure is an SQL expression over the measured columns. ``bad < good`` means that small
    values are bad.
    """

    name: str
    measure: str
    good: float
    bad: float

    def vote(self) -> Column:
        x = F.expr(self.measure)
        low = self.bad < self.good
        reject, keep = (x <= self.bad, x >= self.good) if low else (x >= self.bad, x <= self.good)
        return F.when(reject, -1).when(keep, 1).otherwise(0).cast("int").alias(self.name)


RULES = (
    Rule("long_enough", "n_words", 30, 9),
    Rule("words_not_short", "word_chars / n_words", 3.5, 2.0),
    Rule("words_not_long", "word_chars / n_words", 9.0, 14.0),
    Rule("few_symbols", "n_symbols / n_words", 0.02, 0.1),
    Rule("little_punctuation", "n_punctuation / greatest(n_words, 40)", 0.35, 0.5),
    Rule("few_repeated_lines", "n_dup_lines / n_lines", 0.25, 0.4),
    Rule("few_repeated_words", "n_repeat_words / n_words", 0.15, 0.2),
    Rule("few_doubled_words", "n_doubled / greatest(n_words, 20)", 0.05, 0.3),
    Rule("few_capitals", "n_upper / greatest(n_words, 20)", 0.4, 1.5),
    Rule("few_exclamations", "n_exclaim / n_words", 0.05, 0.2),
)


def _without(text: str, chars: str) -> Column:
    return F.translate(F.col(text), chars, "")


def _repeat_words(ordered: str) -> Column:
    """Words covered by windows that occur again, from the windows in hash order (hash, place)."""
    def again(x: Column, k: Column) -> Column:
        same = [F.coalesce(F.get(F.col(ordered), k + d)["h"] == x["h"], F.lit(False)) for d in (-1, 1)]
        return same[0] | same[1]

    places = F.sort_array(F.transform(F.filter(ordered, again), lambda x: x["i"]))
    first = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
    covered = F.aggregate(places, first, lambda a, i: F.struct(
        (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"])
    return F.when(F.col(ordered).isNull(), 0).otherwise(covered).cast("long")


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the measures of the whole text, one row per document; NULL counts as empty.

    A text's windows are only put in order if some window occurs twice.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    words = F.filter(F.split("text", SPACE), lambda w: w != "")
    window = F.transform(F.sequence(F.lit(1), F.col("n_words") - WINDOW + 1),
                         lambda i: F.xxhash64(F.slice("words", i, WINDOW)))
    doubled = F.size(F.filter("words", lambda w, i: w == F.get("words", i - 1)))
    ordered = F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    chars = F.length(_without("text", SPACE_CHARS))
    return (
        docs.select("doc_id", text.alias("text"))
        .select("doc_id", words.alias("words"), lines.alias("lines"),
                chars.alias("word_chars"),
                (F.length("text") - F.length(_without("text", SYMBOLS))).alias("n_symbols"),
                (F.length("text") - F.length(_without("text", PUNCTUATION))).alias("n_punctuation"),
                (F.length("text") - F.length(_without("text", UPPER))).alias("n_upper"),
                (F.length("text") - F.length(_without("text", "!"))).alias("n_exclaim"))
        .select("doc_id", "words", F.size("words").alias("n_words"), doubled.alias("n_doubled"), "word_chars", "n_symbols", "n_punctuation", "n_upper", "n_exclaim",
                F.size("lines").alias("n_lines"),
                (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"))
        .withColumn("hashes", F.when(F.col("n_words") >= WINDOW, window)).drop("words")
        .withColumn("ordered", F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), ordered))
        .select("doc_id", *[F.col(c).cast("long").alias(c) for c in (
            "n_words", "word_chars", "n_symbols", "n_punctuation", "n_upper", "n_exclaim", "n_lines",
            "n_dup_lines", "n_doubled")],
            _repeat_words("ordered").alias("n_repeat_words")))


@dataclass(frozen=True)
class Estimate:
    """Share of good documents, and each rule's rate of right votes on good and on bad ones."""

    prior: float
    right: tuple[tuple[float, float], ...]

    def posterior(self, rules: Sequence[Rule]) -> Column:
        """Probability that a document with the rules' vote columns is good."""
        odds = F.lit(log(self.prior / (1 - self.prior)))
        for rule, (good, bad) in zip(rules, self.right):
            vote = F.col(rule.name)
            odds = odds + (F.when(vote == 1, log(good / (1 - bad)))
                           .when(vote == -1, log((1 - good) / bad)).otherwise(0.0))
        return 1 / (1 + F.exp(-odds))


def estimate(votes: DataFrame, rules: Sequence[Rule] = RULES, rounds: int = 40,
             tolerance: float = 1e-4) -> Estimate:
    """Expectation-maximisation over the vote patterns.

    Rates are smoothed by one imagined right and one imagined wrong vote and rounded, so that
    reruns agree. Starts from what rules are made for: four good documents in five, a rule rejects
    one good document in fifty, and, as each looks for one kind of fault, three bad ones in ten.
    """
    patterns = materialize(votes.groupBy(*[r.name for r in rules]).agg(F.count(F.lit(1)).alias("n")).coalesce(1),
                           "quality_patterns")
    now = Estimate(0.8, tuple((0.98, 0.3) for _ in rules))
    for _ in range(rounds):
        good, n = F.col("good"), F.col("n")
        sums = [F.sum(n * good).alias("g"), F.sum(n).alias("n")]
        for r in rules:
            vote = F.col(r.name)
            sums += [F.sum(n * good * (vote == v).cast("int")).alias(f"{r.name} g{v}") for v in (1, -1)]
            sums += [F.sum(n * (1 - good) * (vote == v).cast("int")).alias(f"{r.name} b{v}") for v in (1, -1)]
        got = patterns.withColumn("good", now.posterior(rules)).agg(*sums).first()
        if not got["n"]:
            break

        def rate(a: float, b: float) -> float:
            return round((a + 1) / (a + b + 2), 9)

        new = Estimate(rate(got["g"], got["n"] - got["g"]), tuple(
            (rate(got[f"{r.name} g1"], got[f"{r.name} g-1"]), rate(got[f"{r.name} b-1"], got[f"{r.name} b1"]))
            for r in rules))
        moved = max(abs(a - b) for a, b in zip([new.prior, *sum(new.right, ())], [now.prior, *sum(now.right, ())]))
        now = new
        if moved < tolerance:
            break
    return now


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """doc_id, the measures, base_failed, quality (the posterior) and kept: one row per document.

    NULL and blank texts have no words and fail the base rules. Repeated rows each get a row;
    rules on a share abstain where there is nothing to share by. An empty table gives an empty result.
    """
    measured = measure(docs.select("doc_id", "text"))
    safe = {c: F.when(F.col(c) > 0, F.col(c)) for c in ("n_words", "n_lines")}
    voting = measured.select("*", F.struct(*measured.columns).alias("m")).withColumns(safe)
    votes = materialize(voting.select("m.*", *[r.vote() for r in rules]), "quality_votes")
    found = estimate(votes, rules)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (votes.withColumn("base_failed", failed).withColumn("quality", found.posterior(rules))
            .select(*measured.columns, "base_failed", "quality",
                    (~F.col("base_failed") & (F.col("quality") >= 0.5)).alias("kept")))
