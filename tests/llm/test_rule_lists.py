"""Base counts against plain Python, rules on planted labels and on held-out ones."""

import itertools
import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tickloom.llm import queries as Q
from tickloom.llm import rule_lists as R

from . import cases


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    inside = [False] * len(words)
    for k in range(len(words) - 7):
        if windows[tuple(words[k : k + 8])] > 1:
            inside[k : k + 8] = [True] * 8
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, sum(inside)


def got(df):
    return cases.counted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in df.collect())


def test_statistics(spark):
    lines = "one line\nother\none line\n \n \none line"
    rows = [*cases.edge_rows(), (900, lines), (901, "a b c d e f g h " * 3), (902, "a " * 9 + "b"), (903, "\x0b a\x0cb\x1fc 𝒳 | < "), (904, "q w e r t y u i q w e r t y u i")]
    assert got(R.text_statistics(cases.documents(spark, rows))) == cases.counted((i, *base(t)) for i, t in rows)
    assert R.text_statistics(cases.empty(spark)).count() == 0


def test_planted_rules(spark):
    """Texts with many signs, or many capitals, are poor: the list finds both and nothing else."""
    rng = random.Random(2)
    rows, labels = [], []
    for k in range(600):
        text = cases.prose(k, 60)
        kind = rng.choice(["plain", "plain", "signs", "capitals"])
        text = text.replace(" ", " ## ") if kind == "signs" else text.upper() if kind == "capitals" else text
        rows.append((k, text))
        labels.append((k, int(kind == "plain"), 0))
    docs = cases.documents(spark, rows)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rules = R.learn_rules(R.cut_lineage(R.labelled_statistics(docs, table)))
    assert rules and {c.statistic for rule in rules for c in rule} <= {"symbol_share", "upper_share", "mean_word", "n_words", "distinct_share"}
    kept = {r.doc_id: r.kept for r in R.apply_rules(docs, table).collect()}
    assert sum(kept[i] == bool(q) for i, q, _ in labels) >= 0.98 * len(labels)


def test_without_labels(spark):
    rows = cases.edge_rows()
    schema = "doc_id long, quality int, toxic int"
    for labels in ([], [(1, None, 0), (None, 0, 1), (10**9, 0, 0)]):
        out = R.apply_rules(cases.documents(spark, rows), spark.createDataFrame(labels, schema)).collect()
        for r in out:
            failed = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
            assert (r.base_failed, r.rule, r.kept) == (failed, 0, not failed)
        assert len(out) == len(rows)


def holds(rule, row):
    return all((row[c.statistic] >= c.cut) == c.at_least for c in rule)


def plain_rule(rows, cuts):
    """One rule grown condition by condition: every candidate is tried on every row."""
    rule = ()
    for _ in range(R.CONDITIONS):
        covered = [r for r in rows if holds(rule, r)]
        p, n = sum(r["bad"] for r in covered), len(covered)
        if p in (0, n):
            return rule
        tried = []
        for s in R.STATISTICS:
            for cut in cuts[s]:
                for at_least in (True, False):
                    more = [r for r in covered if (r[s] >= cut) == at_least]
                    bad = sum(r["bad"] for r in more)
                    if bad:
                        tried.append((bad * (math.log2(bad / len(more)) - math.log2(p / n)), R.Condition(s, at_least, cut)))
        best, chosen = 0.0, None
        for gain, condition in tried:
            if gain > best + 1e-9:
                best, chosen = gain, condition
        if chosen is None:
            return rule
        rule += (chosen,)
    return rule


def plain_list(rows, cuts):
    """Sequential covering over lists of rows: grow on two thirds, prune on the rest, take away what is covered."""
    rules = []
    while any(cuts.values()) and len(rules) < R.RULES:
        rule = plain_rule([r for r in rows if not r["held"]], cuts)
        if not rule:
            break
        scored = []
        for part in (p for k in range(1, len(rule) + 1) for p in itertools.combinations(rule, k)):
            covered = [r for r in rows if r["held"] and holds(part, r)]
            bad = sum(r["bad"] for r in covered)
            scored.append(((bad + 1) / (len(covered) + 2), len(covered), -len(part), bad, part))
        _, n, _, bad, rule = max(scored, key=lambda x: x[:3])
        if n < R.LEAST_COVER or n - bad > max(1, (1 - R.PRECISION) * n):
            break
        rules.append(rule)
        rows = [r for r in rows if not holds(rule, r)]
    return rules


def labelled(seed, n=900):
    """Texts of which some kinds are poor, with a few wrong labels."""
    rng = random.Random(seed)
    for k in range(n):
        text = cases.prose(1000 * seed + k, rng.randint(25, 90))
        kind = rng.choice(["plain", "plain", "plain", "signs", "capitals", "few"])
        if kind == "signs":
            text = "".join(c + "#" * (c == " " and rng.random() < 0.6) for c in text)
        elif kind == "capitals":
            text = " ".join(w.upper() if rng.random() < 0.7 else w for w in text.split(" "))
        elif kind == "few":
            text = " ".join(rng.choice(text.split(" ")[:6]) for _ in range(60))
        yield k, text, int((kind == "plain") != (rng.random() < 0.01)), 0


def test_covering_and_verdicts_against_plain(spark):
    """Cut points by rank, every rule and every verdict as plain Python finds them."""
    for seed in (1, 2):
        rows = list(labelled(seed))
        docs = cases.documents(spark, [r[:2] for r in rows])
        labels = spark.createDataFrame([(i, q, x) for i, _, q, x in rows], "doc_id long, quality int, toxic int")
        table = R.cut_lineage(R.labelled_statistics(docs, labels))
        cuts = R._cuts(table)
        held = F.pmod(F.xxhash64(F.lit("held"), "doc_id"), F.lit(3)) == 0
        plain = [r.asDict() for r in table.withColumn("held", held).collect()]
        assert len(plain) == len(rows)
        for s in R.STATISTICS:
            ranks = set()
            for bad in (0, 1):
                own = sorted(r[s] for r in plain if r["bad"] == bad)
                ranks |= {float(own[math.ceil((k + 1) / (R.CUTS + 1) * len(own)) - 1]) for k in range(R.CUTS)}
            assert set(cuts[s]) == ranks
        rules = R.learn_rules(table)
        assert len(rules) >= 2 and rules == plain_list(plain, cuts)
        stats = {r.doc_id: r for r in R.text_statistics(docs).collect()}
        for r in R.apply_rules(docs, labels).collect():
            one = stats[r.doc_id]
            failed = one.n_words < 20 or 100 * one.n_repeat_words > 30 * one.n_words
            number = next((k for k, rule in enumerate(rules, 1) if holds(rule, one)), 0)
            assert (r.base_failed, r.rule, r.kept) == (failed, number, not failed and number == 0)


def test_held_out_accuracy(spark):
    """Rules learnt from even ids judge odd ones."""
    sf = "/root/testdata/sf0.1"
    docs, labels = Q.table(spark, sf, "documents"), Q.table(spark, sf, "labels")
    out = R.apply_rules(docs, labels.filter("doc_id % 2 = 0")).join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("not base_failed")
    good, poor = out.filter("quality = 1"), out.filter("quality = 0")
    assert good.filter("not kept").count() <= 0.01 * good.count()
    assert poor.filter("not kept").count() >= 0.8 * poor.count()


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    out = Q.op10_decision_list(spark, sf)
    assert got(out) == cases.counted((r.doc_id, *base(r.text)) for r in Q.table(spark, sf, "documents").collect())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
