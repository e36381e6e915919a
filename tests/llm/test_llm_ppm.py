"""Prediction by partial matching against a plain version, and what its probabilities add up to."""

from __future__ import annotations

import math

import pytest
from helpers import AWKWARD, ascii_words, documents
from pyspark.sql import functions as F

from tillmart.llm import ppm

PAST = bytes([ppm.START] * ppm.ORDER)


def learning():
    return F.coalesce(F.col("doc_id") % 3 != 0, F.lit(True))


def counted(texts, order):
    """What follows each context of up to `order` bytes, and how often."""
    seen: dict[bytes, dict[int, int]] = {}
    for text in texts:
        raw = bytes([ppm.START] * order) + (text or "").encode() + bytes([ppm.END])
        for at in range(order, len(raw)):
            for k in range(order + 1):
                own = seen.setdefault(raw[at - k : at], {})
                own[raw[at]] = own.get(raw[at], 0) + 1
    return seen


def probability(seen, past, symbol, order):
    value, excluded = 1.0, set()
    for k in range(order, -1, -1):
        followers = seen.get(past[len(past) - k :])
        if followers is None:
            continue
        left = {s: n for s, n in followers.items() if s not in excluded}
        if not left:
            continue
        whole = sum(left.values()) + len(left)
        if symbol in left:
            return value * left[symbol] / whole
        value *= len(left) / whole
        excluded |= left.keys()
    return value / (ppm.SYMBOLS - len(excluded))


def plain_score(seen, text, order):
    raw = bytes([ppm.START] * order) + (text or "").encode() + bytes([ppm.END])
    return sum(
        math.log10(probability(seen, raw[at - order : at], raw[at], order))
        for at in range(order, len(raw))
    )


def learned(rows):
    return [text for i, text in rows if i is None or i % 3]


@pytest.mark.parametrize("order", [0, 2, 4, 6])
def test_scores_are_those_of_the_plain_model(spark, order):
    rows = [(i, text) for i, text in AWKWARD if len(text or "") < 5000]
    rows += [(30, "one too"), (33, "seven words that nobody has ever seen"), (36, "twö wörds")]
    seen = counted(learned(rows), order)
    found = ppm.score(documents(spark, rows), learning(), order).collect()
    expected = [(i, plain_score(seen, text, order)) for i, text in rows]
    assert len(found) == len(rows)
    for (_, value), row in zip(sorted(expected, key=str), sorted(found, key=lambda r: str((r.doc_id, r.score)))):
        assert row.score == pytest.approx(value, rel=1e-9)


def test_tokens_and_the_score_they_are_compared_with(spark):
    found = ppm.score(documents(spark), learning()).collect()
    words = [ascii_words(text) + [None] for text in learned(AWKWARD)]
    flat = [word for text in words for word in text]
    numbers = {word: flat.count(word) for word in set(flat)}

    def base(text):
        c = [numbers.get(word, 0) for word in ascii_words(text) + [None]]
        return sum(math.log10((n + 1) / (len(flat) + len(numbers) + 1)) for n in c), sum(n > 0 for n in c)

    expected = [
        (i, len(ascii_words(text)) + 1, base(text)[1], len((text or "").encode())) for i, text in AWKWARD
    ]
    assert sorted(map(str, expected)) == sorted(
        str((r.doc_id, r.n_tokens, r.n_known, r.n_bytes)) for r in found
    )
    assert {r.train_tokens for r in found} == {len(flat)}
    assert sorted(r.base_score for r in found) == pytest.approx(sorted(base(t)[0] for _, t in AWKWARD))
    assert all(r.learns == (r.doc_id is None or r.doc_id % 3 != 0) for r in found)


@pytest.mark.parametrize("past", [PAST, b"the ", b"zzzz", b"\xc3\xa4xe"])
def test_probabilities_of_all_symbols_add_up(past):
    seen = counted(["the then there", "that", "äxe", ""], ppm.ORDER)
    symbols = [*range(0x80), *range(0x80, 0xC0), *range(0xC2, 0xF5), ppm.END]
    assert len(symbols) == ppm.SYMBOLS
    assert sum(probability(seen, past, s, ppm.ORDER) for s in symbols) == pytest.approx(1)


def test_blocks_do_not_change_scores(spark):
    """Neither their number nor which texts share one."""

    def scores(docs, **settings):
        found = ppm.score(docs, learning(), **settings).select("doc_id", F.round("score", 6))
        return sorted(map(str, found.collect()))

    docs = documents(spark)
    assert scores(docs.coalesce(1)) == scores(docs.repartition(5), block=100)


def test_without_learning_texts_all_is_uniform(spark):
    (row,) = ppm.score(documents(spark, [(1, "abc")]), F.lit(False)).collect()
    assert row.score == pytest.approx(-4 * math.log10(ppm.SYMBOLS))
    assert (row.n_known, row.train_tokens, row.base_score) == (0, 0, 0.0)


def test_empty_table(spark):
    assert ppm.score(documents(spark, []), learning()).count() == 0
    assert ppm.with_adaptive_score(documents(spark, [])).count() == 0


def test_order_has_to_fit(spark):
    with pytest.raises(ValueError):
        ppm.score(documents(spark, []), learning(), 7)


def test_adaptive_scores(spark):
    """Each byte is coded by what the text itself has shown before, so a shuffled one costs more."""
    rows = [(i, text) for i, text in AWKWARD if len(text or "") < 5000]
    docs = documents(spark, rows).withColumn("adaptive_score", F.lit("own"))
    found = ppm.with_adaptive_score(docs)
    assert set(docs.columns) == set(found.columns)
    for row in found.collect():
        raw = PAST + (row.text or "").encode() + bytes([ppm.END])
        total, seen = 0.0, {}
        for at in range(ppm.ORDER, len(raw)):
            total += math.log10(probability(seen, raw[at - ppm.ORDER : at], raw[at], ppm.ORDER))
            for k in range(ppm.ORDER + 1):
                own = seen.setdefault(raw[at - k : at], {})
                own[raw[at]] = own.get(raw[at], 0) + 1
        assert row.adaptive_score == pytest.approx(total, rel=1e-9)
