"""Small tables with nulls, empty and long texts, ties, repeated rows and columns with clashing names."""

import random
import re

from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
    StructField("source", StringType()), StructField("n_chars", LongType()), StructField("size", StringType()),
    StructField("path", StringType()), StructField("n_tokens", StringType()), StructField("anchor", StringType()),
])

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(["ka", "lo", "mi", "né", "tu", "ss", "Ri"]) for _ in range(rng.randint(1, 5))) for _ in range(n))


def edge_rows():
    """(doc_id, text) rows: one passage in many texts, near copies, copies, repeats inside a text, and the odd ones."""
    passage = prose(1, 120)
    base = prose(2, 300).split(" ")
    near = []
    for k in range(5):
        words = list(base)
        words[40 * k + 3] = f"changed{k}"
        near.append(" ".join(words))
    texts = [
        None, None, "", " ", "\n\n", "a", "one two", passage, passage + " " + prose(3, 50), prose(4, 50) + "\n" + passage, passage * 2,
        *near, near[0], prose(5, 6000) + " " + passage, "x" * 3000, "ab" * 900, "日本語 テキスト" * 60, "word " * 300, "<|endoftext|> a<|endoftext|>",
        "x▁y  ▁ z", " lead", "trail ", "a\xa0b  c\t\td", "!!! ### $$$",
    ]
    rows = [(k, t) for k, t in enumerate(texts)]
    rows += [(7, passage), (7, passage), (3, "other text under a used id"), (None, passage), (None, None)]
    return rows


def documents(spark, rows):
    full = [(i, t, None if (i or 0) % 3 else "en", "src0", None, "no size", "no path", "x", "y") for i, t in rows]
    return spark.createDataFrame(full, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def counted(rows):
    """Rows as a sorted list, for tables in which rows repeat."""
    return sorted(map(repr, rows))
