import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.cases import DOCS, counted, documents, edge_rows, empty, prose
from tickloom.llm import collocations
from tickloom.llm.arrays import text_bytes

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def plain(rows, least, top=2000):
    """Ranked phrases of (lang, text) rows by counting every phrase of one to five words."""
    f = Counter()
    for lang, text in rows:
        for words in pieces(text):
            for k in range(len(words)):
                for m in range(1, min(5, len(words) - k) + 1):
                    f[lang or "und", tuple(words[k : k + m])] += 1
    n = Counter()
    for (lang, words), c in f.items():
        n[lang] += c * (len(words) == 1)
    candidates = {(lang, w): a for (lang, w), a in f.items() if len(w) > 1 and a >= least}
    dropped = set()
    for (lang, w), a in candidates.items():
        for k in range(len(w)):
            for m in range(2, len(w) - k + 1):
                if m < len(w) and f[lang, w[k : k + m]] <= a:
                    dropped.add((lang, w[k : k + m]))
    out = []
    for (lang, w), a in candidates.items():
        if (lang, w) not in dropped:
            score, _, l, r = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
            out.append((lang, -score, -a, " ".join(w).encode(), l, r))
    ranked, place = [], Counter()
    for lang, score, a, phrase, l, r in sorted(out):
        place[lang] += 1
        if place[lang] <= top:
            ranked.append((lang, place[lang], phrase.decode(), -a, l, r, n[lang], -score))
    return counted(ranked)


def rows_of(df):
    return counted(tuple(r) for r in df.select(COLUMNS).collect())


def chatter(seed, n, kinds=12):
    rng = random.Random(seed)
    words = ["The", "the", "of", "é", "日本", "x\xa0y", "b", "c", "D", "e\x85", "f", "g"][:kinds]
    return "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", "\x0b", " ! "]) for _ in range(n))


def test_transforms_are_inverse_of_text():
    """Interval widths of the index equal plain counts for every phrase of the text."""
    ids, words = collocations.word_ids(*text_bytes(pa.array([chatter(4, 800, 5), "", chatter(5, 300, 5)])))
    names = [None, *words.to_pylist()]
    plain_counts = Counter()
    for text in (chatter(4, 800, 5), chatter(5, 300, 5)):
        for p in pieces(text):
            for k in range(len(p)):
                for m in range(1, min(5, len(p) - k) + 1):
                    plain_counts[tuple(p[k : k + m])] += 1
    behind, ahead = collocations.transforms(ids)
    count = np.bincount(ids, minlength=len(names))
    start = np.cumsum(count) - count
    phrases = [(names[k],) for k in range(1, len(names))]
    f, r, w = start[1:].copy(), start[1:].copy(), count[1:]
    found = dict(zip(phrases, w.tolist(), strict=True))
    for length in range(2, 6):
        right = length % 2 == 0
        own, other = (r, f) if right else (f, r)
        phrase, here, there, w = collocations.extend(ahead if right else behind, len(words), own, other, w)
        f, r = (there, here) if right else (here, there)
        word = [names[k] for k in np.searchsorted(start, here, side="right") - 1]  # an interval lies in that of its first word
        phrases = [(*phrases[p], c) if right else (c, *phrases[p]) for p, c in zip(phrase, word, strict=True)]
        found |= dict(zip(phrases, w.tolist(), strict=True))
    assert found == plain_counts


@pytest.mark.parametrize("size", [12 << 20, 700])
def test_equals_brute_force(spark, monkeypatch, size):
    """Many shards or few, several languages and none, hot phrases, nulls and repeated rows."""
    monkeypatch.setattr(collocations, "SHARD_BYTES", size)
    monkeypatch.setattr(collocations, "RANGE_WORDS", 2000)
    rows = [(None if k % 5 == 0 else ["en", "de", "fr"][k % 3], chatter(k, 150, 4 + k % 9)) for k in range(60)]
    rows += [("en", "the very same line of words, again the very same line")] * 30 + [("en", None), (None, None), ("xx", ""), ("yy", "  .\n"), (None, "word " * 400)]
    rows += [(None if (i or 0) % 3 else "en", t) for i, t in edge_rows()]
    docs = spark.createDataFrame([(k, t, g, "s", None, "no size", "no path", "x", "y") for k, (g, t) in enumerate(rows)], DOCS).repartition(5)
    assert rows_of(collocations.collocations(docs, least=8)) == plain(rows, 8)
    assert rows_of(collocations.collocations(docs, least=20, top=3)) == plain(rows, 20, 3)


def test_long_text_is_cut_where_pieces_end(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SHARD_BYTES", 500)
    text = chatter(7, 3000, 6) + " " + "a b c d " * 400 + ". " + chatter(8, 900, 6)
    docs = documents(spark, [(1, text), (2, prose(1, 30))])
    assert rows_of(collocations.collocations(docs, least=10)) == plain([(None, text), (None, prose(1, 30))], 10)


def test_products_beyond_64_bits(spark):
    """Counts are whole numbers of any size: 1000 * a * n of these is some 10**25."""
    rows = [("en", ["p", "q"], 9_000_000_000, 9_500_000_001, 9_100_000_003, 2_000_000_000_003)]
    df = spark.createDataFrame(rows, "lang string, words array<string>, a long, l long, r long, n long")
    df = df.select("lang", "words", "a", "n", *(__import__("pyspark.sql.functions", fromlist=["F"]).array(c, "a").alias(x) for c, x in (("l", "heads"), ("r", "tails"))))
    got = collocations._scored(df, 2).first()
    assert (got["l"], got["r"]) == rows[0][3:5] and got["score"] == 1000 * rows[0][2] * rows[0][5] // (rows[0][3] * rows[0][4])


def test_empty(spark):
    assert collocations.collocations(empty(spark)).collect() == []
