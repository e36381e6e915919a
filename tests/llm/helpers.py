"""Brute-force versions of the operators, and awkward inputs for all of them."""

from __future__ import annotations

import hashlib
import re

ASCII_LOWER = {i: i + 32 for i in range(65, 91)}
LONG = " ".join(f"word{i % 977} of line {i}" for i in range(20_000))

#: doc_id, text: null ids and texts, empty, blank, long, repeated and tied rows, odd characters.
AWKWARD = [
    (1, None),
    (2, ""),
    (3, "   \n\t "),
    (4, "one"),
    (5, "two words"),
    (6, LONG),
    (7, LONG),
    (7, LONG),
    (8, "Ünïcödé ▁ text \U0001f600  with   runs\n \n of   space ￿ end "),
    (9, "a b c d e f g h i j k l m n"),
    (9, "a b c d e f g h i j k l m n o"),
    (None, "no id at all, but words"),
    (None, None),
    (10, "x" * 50_000),
    (11, "1.2.3.4 " * 3000),
    (12, "<|endoftext|> </s> & [INST] &lt; \\ \""),
]


def documents(spark, rows=AWKWARD):
    """With columns that clash with those the operators make."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "doc_id long, text string")
    extra = ("lang", "source", "score", "labels", "ids", "node", "n", "fingerprint", "pii_spans")
    return df.withColumns({name: F.lit("own") for name in extra}).withColumn(
        "n_chars", F.char_length("text").cast("long")
    )


def ascii_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))


def shingle_set(text, size):
    words = ascii_words(text)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*[words[k:] for k in range(size)]))


def components(texts, size, percent):
    """Smallest id each id reaches, all pairs compared."""
    sets = {i: shingle_set(text, size) for i, text in texts.items()}
    parent = {i: i for i in texts}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(texts)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            union = len(sets[a] | sets[b])
            if union and 100 * len(sets[a] & sets[b]) >= percent * union:
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {i: (len(sets[i]), find(i)) for i in ids}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
