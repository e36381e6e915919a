"""Hard negatives and spelling variants against versions that compare all pairs."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest
from helpers import ASCII_LOWER, AWKWARD, documents
from pyspark.sql import functions as F

from tillmart.llm import hard_negatives, spelling

ROWS = "vec_id long, embedding array<double>, label int"


def embeddings(spark, rows):
    extra = ("id", "vector", "score", "bucket", "windows", "query")
    return spark.createDataFrame(rows, ROWS).withColumns({name: F.lit("own") for name in extra})


def mined(spark, rows, **settings):
    found = hard_negatives.mine(
        hard_negatives.vectors(embeddings(spark, rows)), F.col("id") % 10 == 0, **settings
    )
    return sorted(
        (r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score)
        for r in found.collect()
    )


def mined_plainly(rows, positives=5, negatives=3, least=50, largest=95):
    width = max(len(v) for _, v, _ in rows)
    own = {i: (np.floor(256 * np.pad(v, (0, width - len(v)))).astype(int), c) for i, v, c in rows}
    found = []
    for i, (query, label) in own.items():
        if i % 10:
            continue
        ranked = sorted((-int(query @ v), j) for j, (v, _) in own.items() if j != i)
        for p, positive in [x for x in ranked if own[x[1]][1] == label][:positives]:
            fits = [
                (s, j)
                for s, j in ranked
                if own[j][1] != label and least * -p <= 100 * -s <= largest * -p
            ]
            for rank, (s, negative) in enumerate(fits[:negatives], 1):
                found.append((i, positive, rank, negative, -p, -s))
    return sorted(found)


def random_rows(number, width=6, spread=1.0, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, width))
    return [
        (i, (centres[i % 4] + spread * rng.normal(size=width)).tolist(), int(rng.integers(3)))
        for i in range(number)
    ]


@pytest.mark.parametrize("spread", [0.1, 1.0])
@pytest.mark.parametrize("bucket", [16, 4096])
def test_hard_negatives(spark, monkeypatch, spread, bucket):
    rows = random_rows(300, spread=spread)
    # Small blocks and buckets, so that many meet.
    monkeypatch.setattr(hard_negatives, "BLOCK", 7)
    monkeypatch.setattr(hard_negatives, "BLOCKS", 2)
    assert mined(spark, rows, bucket=bucket) == mined_plainly(rows)


def test_hard_negatives_with_ties_and_one_vector_for_a_third(spark):
    rows = random_rows(120)
    rows += [(i, [0.5, 0.25, 0.0, -0.5, 0.125, 1.0], i % 2) for i in range(120, 180)]
    rows += [(i, [0.0] * 6, i % 3) for i in range(180, 200)]
    assert mined(spark, rows, bucket=32) == mined_plainly(rows)


def test_hard_negatives_of_unlike_width(spark):
    rows = [(i, v[: 3 + i % 4], c) for i, v, c in random_rows(90)]
    assert mined(spark, rows, bucket=20) == mined_plainly(rows)


def test_hard_negatives_of_other_numbers(spark):
    rows = random_rows(100)
    settings = {"positives": 2, "negatives": 7, "least": 10, "largest": 100}
    assert mined(spark, rows, **settings) == mined_plainly(rows, **settings)


def test_rows_that_take_no_part(spark):
    rows = random_rows(60)
    odd = [
        (None, [1.0] * 6, 1),
        (200, None, 1),
        (210, [1.0] * 6, None),
        (220, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1),
        (230, [float("nan")] * 6, 1),
        (240, [float("inf")] * 6, 2),
    ]
    assert mined(spark, rows + odd) == mined_plainly(rows)
    assert mined(spark, odd) == []
    assert mined(spark, []) == []


def test_of_rows_with_one_id_one_counts(spark):
    rows = random_rows(60)
    assert mined(spark, rows + rows[:20] + rows[:20]) == mined_plainly(rows)


def test_no_table_that_grows_with_the_queries_is_broadcast(spark, monkeypatch):
    """Blocks of queries are copied many times; the driver would hold all copies. A row a bucket may go."""
    plans = []

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    write = hard_negatives.written
    monkeypatch.setattr(hard_negatives, "written", lambda df, name: write(seen(df), name))
    rows = random_rows(300)
    found = hard_negatives.mine(
        hard_negatives.vectors(embeddings(spark, rows)), F.col("id") % 10 == 0, bucket=16
    )
    seen(found)
    joins = re.findall(r"\w+Join.*", "\n".join(plans))
    assert {re.sub(r"#\d+L?", "", join) for join in joins if "Broadcast" in join} <= {
        f"BroadcastHashJoin [bucket], [bucket], Inner, Build{side}, false"
        for side in ("Left", "Right")
    }
    assert sum("SortMergeJoin [tile" in join for join in joins) == 4


@pytest.mark.parametrize("tiles", [1, 100])
def test_tiles_of_many_buckets_and_many_blocks(spark, monkeypatch, tiles):
    """Each bucket meets each block once, however they are dealt to tiles."""
    rows = random_rows(300)
    monkeypatch.setattr(hard_negatives, "BLOCK", 3)
    for name, value in (("TILES", tiles), ("TOGETHER", 5), ("BLOCKS", 4), ("LEAST", 2)):
        monkeypatch.setattr(hard_negatives, name, value)
    assert mined(spark, rows, bucket=16) == mined_plainly(rows)


def test_feasible_ranges_hold_all_that_qualify():
    """The bounds are those of a cap around the query: no vector of the cap lies outside."""
    rng = np.random.default_rng(3)
    unit = hard_negatives._unit(rng.normal(size=(4000, 3)))
    for query in unit[:20]:
        for least in (0.05, 0.5, 0.9, 0.999, 1.0):
            low, high = hard_negatives.feasible(query, least)
            inside = unit[unit @ query >= least]
            assert (inside >= low).all() and (inside <= high).all()
            if least == 0.9:  # and they cut something off
                assert ((unit < low) | (unit > high)).any()


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.mark.parametrize("letters", ["ab", "abcéÿ"])
def test_search_schemes(letters):
    rng = random.Random(1)
    for number in (1, 2, 30, 30, 30, 60):
        words = sorted({"".join(rng.choices(letters, k=rng.randint(2, 8))) for _ in range(number)})
        asked = words + ["".join(rng.choices(letters + "z", k=5)) for _ in range(20)]
        asked = sorted(set(asked))
        index = spelling.Index(spelling.points(words))
        found = []
        for right in (True, False):
            for edit in (spelling.DELETE, spelling.REPLACE, spelling.INSERT):
                of, other = spelling.near_in_shard(index, words, asked, right, edit)
                found += [(asked[a], words[b]) for a, b in zip(of.tolist(), other.tolist())]
        assert sorted(found) == sorted((a, b) for a in asked for b in words if near(a, b))


def test_intervals_of_both_directions_agree():
    """Each interval has as many suffixes as the text has places of the pattern."""
    words = ["abab", "aab", "babb", "b", "aabab"]
    index = spelling.Index(spelling.points(words))
    text = "\0" + "\0".join(words) + "\0"
    place = {chr(c): i for i, c in enumerate(index.alphabet.tolist())}
    for pattern in ("ab", "aab", "bab", "\0a", "b\0", "\0aab\0"):
        for turn in range(len(pattern)):
            state = index.whole(1)
            for c in reversed(pattern[:turn]):
                state = index.extend(state, np.array([place[c]]), right=False)
            for c in pattern[turn:]:
                state = index.extend(state, np.array([place[c]]), right=True)
            assert state[2, 0] == len(re.findall(f"(?={pattern})", text))


def formed_plainly(counts, times=2):
    rows = {}
    for word, n in counts.items():
        own = sorted((-m, other) for other, m in counts.items() if near(word, other))
        form = own[0] if own and -own[0][0] >= times * n else None
        rows[word] = (n, len(own), form and form[1], form and -form[0])
    found = []
    for word, row in rows.items():
        root = word
        while rows[root][2]:
            root = rows[root][2]
        found.append((word, *row, root))
    return sorted(found, key=str)


def formed(words):
    rows = spelling.forms(words).collect()
    return sorted(((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in rows), key=str)


@pytest.mark.parametrize("shard", [64, 2**16])
def test_forms(spark, monkeypatch, shard):
    """Also where words that begin and end alike have to share many small shards."""
    monkeypatch.setattr(spelling, "SHARD", shard)
    rng = random.Random(5)
    words = {"".join(rng.choices("abc", k=rng.randint(3, 7))) for _ in range(200)}
    words |= {"aaaa" + "".join(rng.choices("ab", k=4)) for _ in range(60)}
    counts = {word: rng.choice([1, 2, 3, 5, 9, 20, 50, 200]) for word in sorted(words)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert formed(df) == formed_plainly(counts)


def test_forms_of_nothing_and_of_one_word(spark):
    assert formed(spark.createDataFrame([], "word string, n long")) == []
    df = spark.createDataFrame([("alone", 3)], "word string, n long")
    assert formed(df) == [("alone", 3, 0, None, None, "alone")]


def test_forms_of_awkward_words(spark):
    """Null, empty and single letters, repeated rows, ties, letters beyond ASCII, clashing columns."""
    counts = {"": 4, "a": 9, "ab": 2, "abc": 4, "abd": 4, "äbc": 1, "xyz": 4}
    rows = [*counts.items(), (None, 7), (None, None), ("xyz", 3), ("xyz", 1)]
    df = spark.createDataFrame(rows, "word string, n long")
    for name in ("near", "root", "form", "bucket", "right", "length", "query"):
        df = df.withColumn(name, F.lit("own"))
    counts["xyz"] = 8
    expected = formed_plainly({w: n for w, n in counts.items() if len(w) >= 2})
    expected += [(w, counts[w], 0, None, None, w) for w in ("", "a")]
    assert formed(df) == sorted(expected, key=str)


def test_long_chains_reach_their_root(spark):
    words = ["a" * (40 - i) + "b" * i for i in range(40)]
    counts = {word: 2**i for i, word in enumerate(words)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert {r.root for r in spelling.forms(df).collect()} == {words[-1]}


def test_very_long_words(spark):
    counts = {"x" * 3000: 3, "x" * 2999: 9, "x" * 1500 + "y" + "x" * 1499: 2, "hello": 3}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert formed(df) == formed_plainly(counts)


@pytest.mark.parametrize("drop_every", [None, 3])
def test_spellings(spark, drop_every):
    counts = {}
    for i, text in AWKWARD:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(ASCII_LOWER)):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if drop_every and h % drop_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    found = spelling.spellings(documents(spark), drop_every).collect()
    assert {r.word: r.n for r in found} == counts
    assert spelling.spellings(documents(spark, []), drop_every).count() == 0
