"""Language identification by rank-order profiles.

A profile lists the most frequent character n-grams (one to three characters, words padded by
blanks) of a language by rank. A document's own list is compared with each profile by the
out-of-place distance: how far each of its n-grams stands from its rank in the profile, with a
fixed distance for those the profile lacks. The nearest profile is the language.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmart.llm.common import text_slices, trim

UNKNOWN = "und"
COUNTS = "lang string, gram long, n long"
#: Characters beyond it share codes; three codes fit into 63 bits with room to spare.
CODE_BITS = 17


class Model(NamedTuple):
    """`ranks[k][j]`: place of n-gram `grams[j]` in the profile of `langs[k]`."""

    langs: list[str]
    grams: np.ndarray
    ranks: np.ndarray
    size: int


def _codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Letters in lower case as numbers from 1, all else as single zeros, and each text's start."""
    lowered = [f" {(text or '').lower()} " for text in texts]
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered))
    points = np.frombuffer("".join(lowered).encode("utf-32-le"), np.uint32)
    letters = np.where(_is_letter()[points], points, 0)
    # Runs of others count as one blank.
    kept = np.ones(len(letters), bool)
    kept[1:] = (letters[1:] != 0) | (letters[:-1] != 0)
    kept[np.cumsum(sizes) - sizes] = True
    starts = np.concatenate([[0], np.cumsum(kept)])[np.concatenate([[0], np.cumsum(sizes)])]
    return letters[kept] & np.uint32(2**CODE_BITS - 1), starts


_LETTERS: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def _grams(codes: np.ndarray) -> np.ndarray:
    """All n-grams of one text as numbers; runs of blanks alone are left out."""
    codes = codes.astype(np.int64)
    two = (codes[:-1] << CODE_BITS) | codes[1:]
    three = (two[:-1] << CODE_BITS) | codes[2:]
    # The number of characters goes on top.
    ones = codes[codes != 0] | (1 << 60)
    return np.concatenate([ones, two[two != 0] | (2 << 60), three[codes[1:-1] != 0] | (3 << 60)])


def _count(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(_grams(codes), return_counts=True)


def _added(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]):
    grams, place = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    numbers = np.zeros(len(grams), np.int64)
    np.add.at(numbers, place, np.concatenate([a[1], b[1]]))
    return grams, numbers


def ngram_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """How often each language has each n-gram, over all rows; (lang, gram, n)."""

    def count(batches) -> Iterator:
        import pyarrow as pa

        totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for rows in text_slices(batch, 1, 2**20):
                langs = np.array(rows.column(0).to_pylist(), object)
                codes, starts = _codes(rows.column(1).to_pylist())
                for name in sorted(set(langs.tolist())):
                    own = [codes[starts[i] : starts[i + 1]] for i in np.flatnonzero(langs == name)]
                    found = _count(np.concatenate(own))
                    totals[name] = _added(totals[name], found) if name in totals else found
            trim()
        for name, (grams, numbers) in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(grams)), pa.array(grams), pa.array(numbers)],
                ["lang", "gram", "n"],
            )

    labelled = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    return labelled.mapInArrow(count, COUNTS).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = 400) -> Model:
    """Learn a profile of `size` n-grams for each language from all rows with both columns.

    Only profiles come to the driver: `size` rows a language. Equally frequent n-grams are ordered
    by their characters. Without such rows the model knows no language.
    """
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    counts = ngram_counts(docs, text, lang)
    ranked = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)
    rows = [(r["lang"], r["gram"], r["rank"]) for r in ranked.collect()]
    langs = sorted({r[0] for r in rows})
    grams = np.unique(np.array([r[1] for r in rows], np.int64))
    ranks = np.full((len(langs), len(grams)), size + 1, np.int64)
    for lang_, gram, rank in rows:
        ranks[langs.index(lang_), np.searchsorted(grams, gram)] = rank
    return Model(langs, grams, ranks, size)


def _classify(model: Model, codes: np.ndarray) -> tuple[str, float]:
    """The nearest language and how near it is: 0 where no n-gram is known, 1 where all are in
    place. Of equally near languages the first by name."""
    if not model.langs or not codes.any():
        return UNKNOWN, 0.0
    grams, numbers = _count(codes)
    top = np.lexsort((grams, -numbers))[: model.size]
    own = grams[top]
    if not len(own):
        return UNKNOWN, 0.0
    at = np.minimum(np.searchsorted(model.grams, own), len(model.grams) - 1)
    known = model.grams[at] == own
    profile = np.where(known, model.ranks[:, at], model.size + 1)
    out = np.where(
        profile > model.size, model.size, np.abs(profile - np.arange(1, len(own) + 1))
    ).sum(1)
    best = int(out.argmin())
    return model.langs[best], float(1 - out[best] / (len(own) * model.size))


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add `lang_pred` and `score` (0 to 1) from `text` alone.

    Null texts and texts without a letter get `und` and 0, as does every row where the model knows
    no language. Columns of these names are replaced; all others and all rows stay.
    """
    from pyspark.sql import types as T

    kept = docs.drop("lang_pred", "score")
    schema = T.StructType(
        [
            *kept.schema.fields,
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    at, names = kept.columns.index(text), schema.names

    def classify(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for rows in text_slices(batch, at, 2**20):
                codes, starts = _codes(rows.column(at).to_pylist())
                found = [_classify(model, codes[a:b]) for a, b in zip(starts, starts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        *rows.columns,
                        pa.array([x[0] for x in found], pa.string()),
                        pa.array([x[1] for x in found], pa.float64()),
                    ],
                    names,
                )
            trim()

    return kept.mapInArrow(classify, schema)


def held_out(doc_id: str | Column, folds: int = 3) -> Column:
    """Whether a document is kept from training: its id's crc32 leaves a remainder of 1."""
    return F.coalesce(
        F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 1, F.lit(False)
    )
