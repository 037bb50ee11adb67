"""Quality rules learned as decision lists by sequential covering, DataFrame functions only.

Statistics of every text are one expression. A rule is a conjunction of thresholds on them: it grows by the condition of
greatest information gain on two thirds of the labelled rows, is pruned on the last third, and the rows it covers leave
before the next rule is learnt. The list is a Spark conditional expression in that order.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.session import cut_lineage

#: Labelled rows that rules are learnt from, at most about.
LEARN_ROWS = 12_000
#: Cut points tried for each statistic, conditions of a rule, rules of a list, and what a rule must reach on held-out rows.
CUTS, CONDITIONS, RULES, PRECISION, LEAST_COVER = 24, 3, 8, 0.95, 5
#: Words in a window, and the base limits.
WINDOW, LEAST_WORDS, MOST_REPEAT = 8, 20, 30

_SPACE = r"[\x20\x09-\x0D]+"
STATISTICS = (
    "n_words", "mean_word", "symbol_share", "upper_share", "mark_share", "digit_share", "dup_line_share", "repeat_share", "distinct_share",
)


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _left(text: Column, others: str) -> Column:
    """Characters left after taking out runs that match `others`."""
    return F.char_length(F.regexp_replace(text, others, ""))


def _repeat_words(words: Column) -> Column:
    """Words inside windows of 8 words that the text holds twice or more."""

    def covered(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = lambda s: F.filter(
            F.transform(s, lambda x, k: F.when((F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]), x["i"])),
            lambda i: i.isNotNull(),
        )
        places = _let(pairs, lambda s: F.array_sort(twice(s)))
        return _let(
            places,
            lambda p: F.aggregate(
                F.transform(p, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - i, F.lit(WINDOW)))),
                F.lit(0), lambda a, b: a + b,
            ),
        )

    windows = F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    return F.when(F.size(words) < WINDOW + 1, F.lit(0)).otherwise(
        _let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))
    )


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and shares of every row.

    Words are `[^\\x20\\x09-\\x0D]+`; a null text has none. word_chars are code points in words, n_symbols characters of
    `[#*$%&|<>]`, n_dup_lines lines with a word that equal an earlier line, n_repeat_words words inside 8-word windows
    that occur twice or more in the text.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    text = F.col("text")
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    by_word = _let(
        words,
        lambda w: F.struct(
            F.size(w).alias("n_words"), F.char_length(F.array_join(w, "")).alias("word_chars"),
            F.size(F.array_distinct(w)).alias("n_distinct"), _repeat_words(w).alias("n_repeat_words"),
        ),
    )
    by_line = _let(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    counted = rows.select(
        "doc_id", by_word.alias("w"), by_line.alias("l"), F.char_length(text).alias("n_chars"),
        _left(text, r"[^#*$%&|<>]+").alias("n_symbols"), _left(text, r"[^A-Z]+").alias("n_upper"),
        _left(text, r"[^!?.,;:]+").alias("n_marks"), _left(text, r"[^0-9]+").alias("n_digits"),
    )
    share = lambda a, b: (a.cast("double") / F.greatest(b, F.lit(1))).cast("double")
    n_words, chars = F.col("w.n_words"), F.col("w.word_chars")
    return counted.select(
        "doc_id", n_words.cast("long").alias("n_words"), chars.cast("long").alias("word_chars"), F.col("n_symbols").cast("long").alias("n_symbols"),
        F.col("l.n_dup_lines").cast("long").alias("n_dup_lines"), F.col("w.n_repeat_words").cast("long").alias("n_repeat_words"),
        share(chars, n_words).alias("mean_word"), share(F.col("n_symbols"), chars).alias("symbol_share"),
        share(F.col("n_upper"), chars).alias("upper_share"), share(F.col("n_marks"), chars).alias("mark_share"),
        share(F.col("n_digits"), chars).alias("digit_share"), share(F.col("l.n_dup_lines"), F.col("l.n_lines")).alias("dup_line_share"),
        share(F.col("w.n_repeat_words"), n_words).alias("repeat_share"), share(F.col("w.n_distinct"), n_words).alias("distinct_share"),
    )


@dataclass(frozen=True)
class Condition:
    """statistic >= cut, or statistic < cut."""

    statistic: str
    at_least: bool
    cut: float

    def expression(self) -> Column:
        value = F.col(self.statistic).cast("double")
        return value >= F.lit(self.cut) if self.at_least else value < F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.statistic} {'>=' if self.at_least else '<'} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def _all(rule: Rule) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.expression()
    return out


def _cuts(rows: DataFrame) -> dict[str, list[float]]:
    """Cut points of every statistic: quantiles of either class, so that a rare class has its own."""
    share = [(k + 1) / (CUTS + 1) for k in range(CUTS)]
    found: dict[str, set[float]] = {s: set() for s in STATISTICS}
    for r in rows.groupBy("bad").agg(*(F.percentile_approx(F.col(s).cast("double"), share, 1000).alias(s) for s in STATISTICS)).collect():
        for s in STATISTICS:
            found[s].update(r[s] or ())
    return {s: sorted(v) for s, v in found.items()}


def _reached(statistic: str, cuts: list[float]) -> Column:
    """How many of the cut points the statistic reaches."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: F.col(statistic) >= c))


def _grow(rows: DataFrame, cuts: dict[str, list[float]]) -> Rule:
    """Conditions added one at a time by FOIL's gain, until the rule covers no good row or nothing is gained."""
    rule: Rule = ()
    while len(rule) < CONDITIONS:
        # how many cut points a value reaches; counts by that give every candidate condition
        reached = F.array(
            *(
                F.struct(F.lit(s).alias("statistic"), _reached(s, cuts[s]).alias("bin"))
                for s in STATISTICS if cuts[s]
            )
        )
        bins = (
            rows.filter(_all(rule)).select("bad", F.explode(reached).alias("r")).groupBy("r.statistic", "r.bin")
            .agg(F.sum("bad").alias("bad"), F.count("*").alias("n")).collect()
        )
        total = {s: (sum(b["bad"] for b in bins if b["statistic"] == s), sum(b["n"] for b in bins if b["statistic"] == s)) for s in STATISTICS}
        bad, n = max(total.values())
        if bad == 0 or bad == n:
            break
        best, gain = None, 0.0
        for s, points in cuts.items():
            own = sorted((b["bin"], b["bad"], b["n"]) for b in bins if b["statistic"] == s)
            for k, cut in enumerate(points):
                over = (sum(b for i, b, _ in own if i > k), sum(m for i, _, m in own if i > k))
                for at_least, (p, m) in ((True, over), (False, (bad - over[0], n - over[1]))):
                    if p and (g := p * (math.log2(p / m) - math.log2(bad / n))) > gain + 1e-9:
                        best, gain = Condition(s, at_least, cut), g
        if best is None:
            break
        rule = (*rule, best)
    return rule


def _prune(rows: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The part of the rule's conditions with the best corrected precision on held-out rows, fewest conditions first."""
    parts = [p for k in range(1, len(rule) + 1) for p in itertools.combinations(rule, k)]
    counts = rows.agg(*(
        F.struct(F.coalesce(F.sum(F.when(_all(p), F.col("bad"))), F.lit(0)).alias("bad"), F.count(F.when(_all(p), F.lit(1))).alias("n")).alias(f"p{k}")
        for k, p in enumerate(parts)
    )).first()
    at = max(range(len(parts)), key=lambda k: ((counts[f"p{k}"]["bad"] + 1) / (counts[f"p{k}"]["n"] + 2), counts[f"p{k}"]["n"], -len(parts[k])))
    return parts[at], counts[f"p{at}"]["bad"], counts[f"p{at}"]["n"]


def learn_rules(labelled: DataFrame) -> list[Rule]:
    """Decision list from rows of statistics, `doc_id` and `bad` (0 or 1); no rows, or no bad rows, give the empty list."""
    rows = labelled.withColumn("held", F.pmod(F.xxhash64(F.lit("held"), "doc_id"), F.lit(3)) == 0)
    cuts = _cuts(rows)
    rules: list[Rule] = []
    while any(cuts.values()) and len(rules) < RULES:
        rule = _grow(rows.filter(~F.col("held")), cuts)
        if not rule:
            break
        rule, bad, n = _prune(rows.filter("held"), rule)
        if n < LEAST_COVER or n - bad > max(1, (1 - PRECISION) * n):
            break
        rules.append(rule)
        rows = rows.filter(~_all(rule))
    return rules


def labelled_statistics(docs: DataFrame, labels: DataFrame, limit: int = LEARN_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics and `bad` of about `limit` labelled documents, taken by the hash of their id; labels disagreeing on an id count as bad."""
    one = labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).filter(F.col("quality").isNotNull())
    share = min(1.0, limit / max(1, one.count()))
    picked = one.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))).select(
        F.col("doc_id").alias(id_col), (F.col("quality") == 0).cast("int").alias("bad")
    )
    rows = docs.select(id_col, text_col).join(F.broadcast(picked), id_col)  # at most about `limit` rows
    stats = text_statistics(rows.select(F.struct(F.col(id_col).alias("id"), "bad").alias("key"), F.col(text_col).alias("text")), "key", "text")
    return stats.select(F.col("doc_id.id").alias("doc_id"), F.col("doc_id.bad").alias("bad"), *STATISTICS)


def rule_number(rules: list[Rule]) -> Column:
    """Number from 1 of the first rule that holds, 0 for none: the decision list as one conditional expression."""
    out = F.when(F.lit(False), F.lit(0))
    for k, rule in enumerate(rules, 1):
        out = out.when(_all(rule), F.lit(k))
    return out.otherwise(F.lit(0))


def apply_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the base counts, base_failed, rule and kept of every row of `docs`.

    base_failed: fewer than 20 words, or over 30 % of the words in repeated 8-word windows. rule is the number of the
    first learnt rule that holds (0: none); kept: neither failed nor ruled out. A null text has no words and fails.
    Labels without a quality, and ids without a document, teach nothing; without usable labels no rule is learnt.
    Repeated rows are returned as they come; other columns are ignored.
    """
    learnt = cut_lineage(labelled_statistics(docs, labels, id_col=id_col, text_col=text_col))
    rules = learn_rules(learnt)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEAT * F.col("n_words"))
    return (
        text_statistics(docs, id_col, text_col).withColumn("base_failed", failed).withColumn("rule", rule_number(rules))
        .select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "rule",
            (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept"),
        )
    )
