"""Quality rules combined by weak supervision. Built-in functions only.

Every rule votes good (1), bad (-1) or abstains (0). Expectation-maximisation over the counts of vote
patterns estimates how often each rule votes which way on good and on bad documents, hence how
accurate it is, and a document is judged by the posterior probability of being good instead of having
to pass every rule. The pattern counts are the sufficient statistics of all documents, at most
3 ** rules of them. Abstaining counts too: a rule that mostly votes alone has no other witness.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import stored

SPACE = r"\x20\x09-\x0D"
SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the measures of the rules; words are runs of anything but ASCII white space.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words`` (words in 5-word
    windows found twice or more), ``n_lines`` (with a word), ``n_ended`` (of these, with closing
    punctuation), ``n_upper`` (ASCII capitals), ``n_distinct`` (words). Null text counts as empty.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    trimmed = F.btrim(text, F.lit(_BLANKS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{SPACE}]+"))
    has_word = lambda x: x.rlike(f"[^{SPACE}]")
    out = docs.withColumns({"_words": words, "_lines": F.filter(F.split(text, "\n"), has_word)})
    out = out.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": _without(text, _BLANKS).cast("long"),
        "n_symbols": (F.length(text) - _without(text, SYMBOLS)).cast("long"),
        "n_upper": (F.length(text) - _without(text, _UPPER)).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_ended": F.size(F.filter("_lines", lambda x: x.rlike(rf"[.!?:;…。！？][\"'»”)\]]*[{SPACE}]*\z"))).cast("long"),
        "_keys": F.transform("_words", lambda w: F.xxhash64(w)),
    }).drop("_words", "_lines")
    key = lambda i: F.get("_keys", i)
    window = lambda i: F.xxhash64(*[key(i + d) for d in range(5)])
    windows = F.when(F.col("n_words") >= 5, F.transform(F.sequence(F.lit(0), (F.col("n_words") - 5).cast("int")), window))
    out = out.withColumn("_windows", windows)
    out = out.withColumns({
        "n_distinct": F.size(F.array_distinct("_keys")).cast("long"),
        # sorted only where some window comes twice
        "_sorted": F.when(
            F.size(F.array_distinct("_windows")) < F.size("_windows"),
            F.array_sort(F.transform("_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))),
        ),
    }).drop("_keys", "_windows")
    near = lambda k: F.get("_sorted", k)["w"]
    twice = F.filter("_sorted", lambda s, k: F.coalesce(near(k - 1) == s["w"], F.lit(False)) | F.coalesce(near(k + 1) == s["w"], F.lit(False)))
    out = out.withColumn("_twice", F.when(F.col("_sorted").isNotNull(), F.array_sort(F.transform(twice, lambda s: s["i"])))).drop("_sorted")
    # each window adds the words that no window before it has covered
    covered = F.aggregate(
        "_twice",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-5).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(5), i - a["last"])).alias("n"), i.alias("last")),
        lambda a: a["n"],
    )
    return out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_twice")


@dataclass(frozen=True)
class QualityRule:
    """A vote as SQL over the measures; abstains where neither condition holds or one is null."""

    name: str
    bad: str = "false"
    good: str = "false"

    def vote(self) -> Column:
        return F.expr(f"CASE WHEN {self.bad} THEN -1 WHEN {self.good} THEN 1 ELSE 0 END")


RULES = (
    QualityRule("symbols", "n_symbols > 0.05 * word_chars"),
    QualityRule("repeats", "n_repeat_words > 0.1 * n_words"),
    QualityRule("same_lines", "n_lines >= 3 AND n_dup_lines > 0.4 * n_lines"),
    QualityRule("capitals", "n_upper > 0.4 * word_chars"),
    QualityRule("few_words", "n_words >= 50 AND n_distinct < 0.3 * n_words"),
    QualityRule("word_length", "word_chars > 9 * n_words OR word_chars < 2 * n_words"),
    QualityRule("open_lines", "n_lines >= 4 AND n_ended < 0.2 * n_lines"),
    QualityRule("prose", good="n_words > 0 AND n_symbols <= 0.02 * word_chars AND n_upper <= 0.25 * word_chars AND n_ended >= 0.6 * n_lines"),
    QualityRule("varied", good="n_words > 0 AND n_distinct >= 0.5 * n_words AND n_symbols <= 0.02 * word_chars"),
    QualityRule("fresh", good="n_words > 0 AND n_repeat_words <= 0.02 * n_words AND n_symbols <= 0.03 * word_chars AND n_upper <= 0.25 * word_chars"),
)


@dataclass(frozen=True)
class LabelModel:
    """Share of good documents; per rule, the rates of its votes (-1, 0, 1) on good and on bad ones."""

    good: float
    rates: tuple[tuple[tuple[float, ...], tuple[float, ...]], ...]

    def weights(self, rule: int) -> list[float]:
        on_good, on_bad = self.rates[rule]
        return [math.log(g / b) for g, b in zip(on_good, on_bad, strict=True)]

    def accuracy(self, rule: int) -> float:
        """How often a vote of the rule is right; abstentions aside."""
        on_good, on_bad = self.rates[rule]
        right = self.good * on_good[2] + (1 - self.good) * on_bad[0]
        return right / (right + self.good * on_good[0] + (1 - self.good) * on_bad[2])

    def log_odds(self, votes: Sequence[Column]) -> Column:
        score = F.lit(math.log(self.good / (1 - self.good)))
        for j, vote in enumerate(votes):
            bad, none, good = map(F.lit, self.weights(j))
            score = score + F.when(vote < 0, bad).when(vote > 0, good).otherwise(none)
        return score


def fit_votes(counts: dict[tuple[int, ...], int], rounds: int = 50) -> LabelModel:
    """Expectation-maximisation over counts of vote patterns, from the majority of the votes.

    Every rate starts from one vote of each kind, so a rule that hardly votes, a corpus of one kind
    and an empty one are handled. The sums run in the order of the patterns: reruns agree.
    """
    patterns = sorted(counts)
    rules = len(patterns[0]) if patterns else 0
    total = sum(counts.values())
    post = [0.99 if sum(p) > 0 else 0.01 if sum(p) < 0 else 0.5 for p in patterns]
    model = LabelModel(0.5, ())
    for _ in range(rounds):
        on_good = [counts[p] * q for p, q in zip(patterns, post, strict=True)]
        on_bad = [counts[p] * (1 - q) for p, q in zip(patterns, post, strict=True)]
        rates = []
        for j in range(rules):
            pair = []
            for weight in (on_good, on_bad):
                seen = [1.0, 1.0, 1.0]
                for p, w in zip(patterns, weight, strict=True):
                    seen[p[j] + 1] += w
                pair.append(tuple(x / sum(seen) for x in seen))
            rates.append(tuple(pair))
        model = LabelModel((1 + sum(on_good)) / (2 + total), tuple(rates))
        bias = math.log(model.good / (1 - model.good))
        weights = [model.weights(j) for j in range(rules)]
        score = [bias + sum(w[v + 1] for v, w in zip(p, weights, strict=True)) for p in patterns]
        post = [1 / (1 + math.exp(-min(max(x, -700), 700))) for x in score]
    return model


def judge_quality(
    docs: DataFrame,
    *,
    text_col: str = "text",
    rules: Sequence[QualityRule] = RULES,
    least: float = 0.5,
    min_words: int = 10,
    max_repeat_percent: int = 20,
    carry: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """The columns ``carry`` of every row with its measures, ``p_good``, ``base_failed`` and ``kept``.

    ``base_failed``: fewer than ``min_words`` words, or more than ``max_repeat_percent`` of them in
    repeated windows. ``kept``: not that, and a posterior ``p_good`` of ``least`` or more. Null and
    empty texts have no words and fail. Every row has a result row, repeated ones too; other columns
    are not read, and carried names may be those of measures' inputs but not of results.
    """
    carried = F.struct(*[F.col(c) for c in carry]).alias("_carried")
    measured = features(docs.select(carried, F.col(text_col).alias("_text")), "_text").drop("_text")
    votes = [f"_vote_{k}" for k in range(len(rules))]
    code = sum((F.col(v) + 1) * 3**k for k, v in enumerate(votes)).cast("long")
    table = stored(
        measured.withColumns({v: r.vote() for v, r in zip(votes, rules, strict=True)}).withColumn("_code", code),
        "quality-votes",
    )
    counts = {  # at most 3 ** rules rows, whatever the number of documents
        tuple(row._code // 3**k % 3 - 1 for k in range(len(rules))): row.n
        for row in table.groupBy("_code").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    model = fit_votes(counts)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    p_good = 1 / (1 + F.exp(-model.log_odds([F.col(v) for v in votes] if counts else [])))
    return (
        table.withColumn("p_good", p_good).withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= least))
        .select(*[F.col(f"_carried.{c}").alias(c) for c in carry], "n_words", "word_chars", "n_symbols",
                "n_dup_lines", "n_repeat_words", "n_lines", "n_ended", "n_upper", "n_distinct", "p_good",
                "base_failed", "kept")
    )
