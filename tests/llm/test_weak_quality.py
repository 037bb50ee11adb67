"""Every step against plain Python, label model on simulated votes, and the classifier against held-out labels."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickloom.llm import queries as Q
from tickloom.llm import weak_quality as K
from tickloom.llm.arrays import mix, text_bytes

from . import cases

SF = "/root/testdata/sf0.1"


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(5)
    true = np.array([0.95, 0.9, 0.8, 0.7])
    poor = rng.random(20000) < 0.5
    right = rng.random((20000, 4)) < true
    votes = np.where(right == poor[:, None], 1, -1) * (rng.random((20000, 4)) < 0.8)
    numbers, counts = np.unique(K.pattern(votes), return_counts=True)
    accuracy, posterior = K.estimate(numbers, counts, 4)
    assert np.abs(accuracy - true).max() < 0.05
    judged = dict(zip(numbers.tolist(), posterior, strict=True))
    hit = np.array([judged[p] > 0.5 for p in K.pattern(votes).tolist()]) == poor
    assert hit.mean() > 0.9


def test_accuracy_on_labels(spark):
    """No label is used in fitting, so all of them are held out."""
    rows = Q.op3_weak_labels(spark, SF).join(Q.table(spark, SF, "labels"), "doc_id")
    good = rows.filter("quality = 1")
    assert good.filter("rejected").count() <= 0.002 * good.count()
    poor = rows.filter("quality = 0")
    assert poor.filter("rejected").count() >= 0.95 * poor.count()


def _votes(text):
    return dict(zip([name for name, _ in K.LABELLERS], K.votes(*text_bytes(pa.array([text])))[0].tolist(), strict=True))


def _long_prose(spark, n):
    docs = Q.table(spark, SF, "documents").join(Q.table(spark, SF, "labels").filter("quality = 1"), "doc_id")
    rows = docs.filter("lang = 'en'").orderBy("doc_id").select(F.col("text")).collect()
    return " ".join(" ".join(r.text for r in rows).split(" ")[:n])


@pytest.mark.parametrize("n", [5000, 20000, 100000, 200000])
def test_long_clean_text_is_varied(spark, n):
    got = _votes(_long_prose(spark, n))
    assert got["repeated_words"] == 0
    assert got["varied_words"] == -1


def test_long_clean_text_is_kept(spark):
    docs = Q.table(spark, SF, "documents").select("doc_id", "text")
    long = spark.createDataFrame([(-1, _long_prose(spark, 200000))], docs.schema)
    (r,) = K.classify(docs.unionByName(long)).filter("doc_id = -1").collect()
    assert r.posterior < 0.5
    assert not r.rejected


def test_long_repeats_are_poor(spark):
    """A long passage again and again, words from few, and both in a long text."""
    passage = _long_prose(spark, 5000)
    few = np.random.default_rng(3).choice(passage.split(" ")[:100], 30000)
    assert [_votes(t)["repeated_words"] for t in (passage * 4, " ".join(few), passage + " " + " ".join(few))] == [1, 1, 1]


def test_short_signs_are_poor(spark):
    """Signs among a few words are a fault; one sign, or a call, is none."""
    docs = Q.table(spark, SF, "documents").select("doc_id", "text")
    texts = ["Iechein | chenverst | enenlich.\nVon | ungein. |", "That*** atly.###", "AT&T grows", "Really?!", "In 2024"]
    short = spark.createDataFrame([(-1 - k, t) for k, t in enumerate(texts)], docs.schema)
    got = K.classify(docs.unionByName(short)).filter("doc_id < 0").orderBy(F.desc("doc_id")).collect()
    assert [r.rejected for r in got] == [True, True, False, False, False]


def test_edges(spark):
    rows = cases.edge_rows()
    got = K.classify(cases.documents(spark, rows)).collect()
    assert cases.counted(r.doc_id for r in got) == cases.counted(i for i, _ in rows)
    assert not any(r.rejected for r in got if r.n_votes == 0)
    assert all(0 <= r.score <= 1 and 0 <= r.posterior <= 1 for r in got)
    assert K.classify(cases.empty(spark)).count() == 0
    assert not K.classify(cases.documents(spark, [(1, None), (2, ""), (2, "")])).filter("rejected").count()


def plain_statistics(text):
    data, words = (text or "").encode(), cases.low_words(text)
    n, kinds = len(words), Counter(data)
    upper = sum(kinds[b] for b in range(65, 91))
    letters = upper + sum(kinds[b] for b in [*range(97, 123), *range(128, 256)])
    blocks = max(1, -(-n // K.BLOCK))
    distinct = len({(i * blocks // n, w) for i, w in enumerate(words)}) / max(n, 1)
    if blocks > 1:
        windows = [tuple(words[k : k + K.WINDOW]) for k in range(n - K.WINDOW + 1)]
        distinct *= len(set(windows)) / len(windows)
    lines = [x for x in data.split(b"\n") if x]
    return {
        "letters": letters, "words": n, "upper": upper / max(letters, 1), "symbol": sum(kinds[b] for b in b"#*$%&|<>") / max(n, 1),
        "shout": (kinds[33] + kinds[63]) / max(n, 1), "digit": sum(kinds[b] for b in range(48, 58)) / max(len(data), 1),
        "distinct": distinct, "expected": min(1.0, 1.15 - 0.065 * math.log(max(n / blocks, 1))), "lines": len(lines),
        "repeats": (len(lines) - len(set(lines))) / max(len(lines), 1), "echo": sum(a == b for a, b in zip(words, words[1:], strict=False)) / max(n, 1),
    }


def _texts(spark):
    rows = [t for _, t in cases.edge_rows()] + [r.text for r in Q.table(spark, "/root/testdata/sf0.001", "documents").collect()]
    return [*rows, "a\n\na\nb\n", "\n", "A! b? 12 é é", "one two " * 900]


def test_statistics_are_plain(spark):
    texts = _texts(spark)
    got = K.statistics(*text_bytes(pa.array(texts, pa.string())))
    for k, text in enumerate(texts):
        want = plain_statistics(text)
        assert {n: float(x[k]) for n, x in got.items()} == pytest.approx(want, abs=1e-12), k


def test_features_are_plain(spark):
    texts = _texts(spark)
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    votes = K.votes(data, offsets)
    got = [Counter() for _ in texts]
    for r, b, x in zip(*K.features(data, offsets, votes), strict=True):
        got[r][int(b)] += x
    for text, vote, found in zip(texts, votes.tolist(), got, strict=True):
        b = (text or "").encode()
        grams = Counter(int(mix(np.array([(b[i] << 16 | b[i + 1] << 8 | b[i + 2]) + 1], np.uint64))[0]) % K.BUCKETS for i in range(len(b) - 2))
        want = {g: math.sqrt(c / (len(b) - 2)) for g, c in grams.items()}
        want.update({K.BUCKETS + 2 * j + (v > 0): 0.5 for j, v in enumerate(vote) if v})
        assert dict(found) == pytest.approx(want)


def test_estimate_is_plain():
    """Expectation and maximisation, vote by vote; a pattern that was not counted has a posterior too."""
    rng = np.random.default_rng(1)
    votes = rng.integers(-1, 2, (300, 3))
    accuracy = [K.START] * 3

    def poor(vote):
        odds = math.prod((a / (1 - a)) ** v for a, v in zip(accuracy, vote, strict=True))
        return odds / (1 + odds)

    for _ in range(K.ROUNDS):
        right, total = [0.0] * 3, [0.0] * 3
        for vote in votes.tolist():
            p = poor(vote)
            for j, v in enumerate(vote):
                right[j] += p if v > 0 else 1 - p if v < 0 else 0
                total[j] += v != 0
        accuracy = [min(0.995, max(0.55, (r + K.START * K.SMOOTH) / (t + K.SMOOTH))) for r, t in zip(right, total, strict=True)]
    numbers, counts = np.unique(K.pattern(votes), return_counts=True)
    got, posterior = K.estimate(numbers, counts, 3)
    assert got.tolist() == pytest.approx(accuracy)
    assert posterior.tolist() == pytest.approx([poor(v) for v in K.unpattern(numbers, 3).tolist()])
    assert K.posterior_of(np.zeros((1, 3)), got).tolist() == [0.5]


def test_fit_is_plain():
    """Scaled gradient steps, weight by weight."""
    rng = np.random.default_rng(2)
    rows = [{int(b): float(x) for b, x in zip(rng.integers(0, 5, 3), rng.random(3), strict=True)} for _ in range(20)]
    target = rng.random(20)
    weight, scale, last = [0.0] * 6, [1e-8] * 6, 5
    poor, good = max(1, target.sum()), max(1, (1 - target).sum())
    for _ in range(K.STEPS):
        gradient = [1e-6 * w for w in weight[:5]] + [0.0]
        for x, t in zip(rows, target, strict=True):
            score = 1 / (1 + math.exp(-sum(weight[b] * v for b, v in x.items()) - weight[last]))
            error = (score - t) * (t / poor + (1 - t) / good) * abs(2 * t - 1) / 2
            for b, v in x.items():
                gradient[b] += v * error
            gradient[last] += error
        for b, g in enumerate(gradient):
            scale[b] += g * g
            weight[b] -= K.RATE * g / math.sqrt(scale[b])
    row = np.repeat(np.arange(20), [len(x) for x in rows])
    got = K.fit(row, np.array([b for x in rows for b in x]), np.array([v for x in rows for v in x.values()]), target)
    assert [*got[:5], got[-1]] == pytest.approx(weight, rel=1e-6)


def test_sample_is_bounded(spark, monkeypatch):
    """Copies, and texts without ids that open alike, give no more rows than others."""
    monkeypatch.setattr(K, "FIT_ROWS", 50)
    head = "All rights reserved. " * 5
    rows = [(None, head + str(k)) for k in range(2000)] + [(None, "copy")] * 2000 + [(k, f"text {k}") for k in range(2000)] + [(1, None)] * 9
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    got = [r.text for r in K._sample(texts, len(rows)).collect()]
    assert 10 <= len(got) <= 50 and len(set(got)) == len(got)
    assert [r.text for r in K._sample(texts.repartition(7), len(rows)).collect()] == got
    assert K._sample(texts, 1).count() == 50
