"""Benchmark decontamination by latent semantic retrieval.

Benchmark passages are TF-IDF vectors, with document frequencies from all documents. A distributed
randomised singular value decomposition gives them a latent space: tasks multiply their passages by a
random matrix and back, term by term sums meet in a shuffle, and the driver orthonormalises a matrix
whose size is that of the benchmark's vocabulary. Windows of every document are folded into the same
space and compared with all passages by cosine; near ones are candidates. A candidate counts as a
leak if the longest common subsequence of its words and the document's around the window holds enough
of the passage, or somewhat less together with the passage's answer, its last sentence, anywhere in the
document. The subsequence is taken in the run of words that is densest in the passage's, and in a wider
stretch where words put in count against it. So passages with words changed, left out or put in, up to
one for each of their own, are found.

The passages are the side that is indexed, in blocks of bounded size; documents are only read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.llm.common import hash_strings, text_slices, trim

#: Passages that are compared with the documents at a time.
BLOCK = 4096
RANK, OVERSAMPLE, POWER = 192, 16, 2
#: Rows of a matrix that are added up together.
PIECE = 1024
#: Words of a half window; a window is two of them, and windows overlap by half.
STEP = 32
#: Terms in more than this share of documents say nothing, but each passage keeps its rarest ones.
COMMON, RAREST = 0.02, 8
#: What a candidate window needs at least: kept terms, cosine, and how much of the passage's vector
#: it holds. A window has two thirds of any passage of `REACH` words, and less of longer ones.
TERMS, COSINE, HELD, REACH = 2, 0.3, 0.25, 64
#: Share of a passage's words in common: alone; with the answer in the document too.
ALONE, WITH_ANSWER, ANSWER = 0.7, 0.5, 0.9
#: What a word put in takes from the words in common: one in so many. Put-in words that outweigh
#: `1 - WITH_ANSWER` of the passage leave no leak, so no stretch is longer than `WIDE` passages.
PUT_IN = 4
WIDE = 1 + PUT_IN * (1 - WITH_ANSWER)
#: Passages with fewer words have to be there as they are.
SHORT = 8
LEAKS = "doc_id long, item_id long, share double, answer boolean"
PUNCTUATION = ".,;:!?()[]{}<>\"'`*_-"


class Passage(NamedTuple):
    item_id: int
    words: np.ndarray  # hashes
    answer: np.ndarray


class Block(NamedTuple):
    """Passages with their place in the latent space."""

    passages: list[Passage]
    terms: np.ndarray  # hashes of kept terms, sorted
    space: np.ndarray  # a row for each term, weighted
    vectors: np.ndarray  # a row of length 1 for each passage
    least: np.ndarray  # what a window's product with that row has to be


def words_of(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct word hashes of an Arrow string array, each word as an index of them, and where each
    text's words begin. A-Z in lower case, punctuation around words dropped."""
    import pyarrow as pa
    import pyarrow.compute as pc

    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    words = lists.flatten().dictionary_encode()
    bare = pc.utf8_trim(pc.ascii_lower(words.dictionary), PUNCTUATION)
    distinct, same = np.unique(hash_strings(bare), return_inverse=True)
    index = same[words.indices.to_numpy(zero_copy_only=False)]
    starts = lists.offsets.to_numpy().astype(np.int64)
    starts -= starts[0]
    gap = hash_strings(pa.array([""]))[0]
    at = np.searchsorted(distinct, gap)
    if at < len(distinct) and distinct[at] == gap:  # tokens of punctuation alone are no words
        kept = index != at
        return distinct, index[kept], np.concatenate([[0], np.cumsum(kept)])[starts]
    return distinct, index, starts


def _passages(rows: list) -> list[Passage]:
    import re

    import pyarrow as pa

    texts = [r["text"] or "" for r in rows]
    answers = [re.split(r"(?<=[.!?])\s+", text.strip())[-1] for text in texts]
    found = []
    both = [words_of(pa.array(x, pa.string())) for x in (texts, answers)]
    for i, r in enumerate(rows):
        own = [distinct[index[starts[i] : starts[i + 1]]] for distinct, index, starts in both]
        if len(own[0]):
            found.append(Passage(r["item_id"], *own))
    return found


def document_frequencies(docs: DataFrame, terms: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many documents each of the terms (sorted hashes) occurs, and the number of all."""

    def count(batches) -> Iterator:
        import pyarrow as pa

        total, rows_seen = np.zeros(len(terms), np.int64), 0
        for batch in batches:
            for rows in text_slices(batch, 0):
                distinct, index, starts = words_of(rows.column(0))
                place = _places(terms, distinct)[index]
                doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
                known = place >= 0
                seen = np.unique(doc[known] * len(terms) + place[known])
                total += np.bincount(seen % len(terms), minlength=len(terms))
                rows_seen += rows.num_rows
            trim()
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(some, -1)),
                pa.array(np.append(total[some], rows_seen)),
            ],
            ["term", "n"],
        )

    found = docs.select("text").mapInArrow(count, "term long, n long")
    sums = {r["term"]: r["n"] for r in found.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    return np.array([sums.get(i, 0) for i in range(len(terms))], np.int64), sums.get(-1, 0)


def _places(terms: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Where each hash stands among the sorted terms, or -1."""
    if not len(terms):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
    return np.where(terms[at] == hashes, at, -1)


def randomised_svd(
    matrix: DataFrame, width: int, rank: int, power: int = POWER, seed: int = 1
) -> np.ndarray:
    """The leading right singular vectors (width x rank) of a sparse matrix given as rows of
    (terms array<int>, weights array<double>).

    `power` times, every task multiplies its rows by the current width x k basis and by their own
    transpose; the products are summed by column in a shuffle and orthonormalised on the driver.
    Last, the k x k Gram matrix of the rows in that basis rotates it onto the singular vectors.
    """
    k = min(width, rank + OVERSAMPLE)
    basis = np.random.default_rng(seed).standard_normal((width, k))

    def rows_of(frame):
        sizes = frame["terms"].map(len).to_numpy()
        columns = np.concatenate([np.asarray(x, np.int64) for x in frame["terms"]])
        values = np.concatenate([np.asarray(x, float) for x in frame["weights"]])
        return sizes, columns, values

    def product(sizes, columns, values, base):
        starts = np.cumsum(sizes) - sizes
        return np.add.reduceat(values[:, None] * base[columns], starts, axis=0)

    def back(rows, base):
        """The rows' share of the matrix' transpose times its product with the basis."""
        sizes, columns, values = rows
        by_row = np.repeat(product(sizes, columns, values, base), sizes, axis=0)
        total = np.zeros_like(base)
        np.add.at(total, columns, values[:, None] * by_row)
        return total

    def gram(rows, base):
        own = product(*rows, base)
        return own.T @ own

    for _ in range(max(1, power)):
        basis = np.linalg.qr(_summed(matrix, rows_of, back, basis, (width, k)))[0]
    k = basis.shape[1]
    total = _summed(matrix, rows_of, gram, basis, (k, k))
    values, vectors = np.linalg.eigh(total)
    kept = np.argsort(-values)[:rank]
    kept = kept[values[kept] > max(values.max(), 0) * 1e-9]
    return basis @ vectors[:, kept]


def _summed(matrix: DataFrame, rows_of, share, basis: np.ndarray, shape) -> np.ndarray:
    """The sum of all tasks' shares, added up in a shuffle by pieces of some rows each."""
    pieces = "piece int, numbers binary"

    def partial(frames) -> Iterator:
        import pandas as pd

        total = np.zeros(shape)
        for frame in frames:
            if len(frame):
                total += share(rows_of(frame), basis)
        for piece in range(0, shape[0], PIECE):
            own = total[piece : piece + PIECE]
            if own.any():
                yield pd.DataFrame({"piece": [piece], "numbers": [own.tobytes()]})

    def add(frame):
        import pandas as pd

        total = sum(np.frombuffer(x) for x in frame["numbers"])
        return pd.DataFrame({"piece": frame["piece"][:1], "numbers": [total.tobytes()]})

    found = np.zeros(shape)
    summed = matrix.mapInPandas(partial, pieces).groupBy("piece").applyInPandas(add, pieces)
    for r in summed.collect():
        own = np.frombuffer(r["numbers"]).reshape(-1, shape[1])
        found[r["piece"] : r["piece"] + len(own)] = own
    return found


def _block(spark, passages: list[Passage], docs: DataFrame) -> Block | None:
    vocabulary = np.unique(np.concatenate([p.words for p in passages]))
    counts, total = document_frequencies(docs, vocabulary)
    idf = np.log((1 + total) / (1 + counts)) + 0.1
    kept = counts <= COMMON * total
    for p in passages:
        own = _places(vocabulary, np.unique(p.words))
        kept[own[np.lexsort((own, counts[own]))][:RAREST]] = True
    terms, idf = vocabulary[kept], idf[kept]
    rows = []
    for i, p in enumerate(passages):
        own, numbers = np.unique(_places(terms, p.words), return_counts=True)
        numbers, own = numbers[own >= 0], own[own >= 0]
        rows.append((i, own.tolist(), (numbers * idf[own]).tolist()))
    schema = "passage int, terms array<int>, weights array<double>"
    # A few hundred passages a task.
    matrix = spark.createDataFrame(rows, schema).repartition(1 + len(rows) // 256)
    basis = randomised_svd(matrix, len(terms), RANK)
    space = (idf[:, None] * basis).astype(np.float32)
    places = [_places(terms, p.words) for p in passages]
    vectors = np.array([space[own[own >= 0]].sum(0) for own in places])
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors = (vectors / np.maximum(lengths, 1e-9)).astype(np.float32)
    sizes = np.array([len(p.words) for p in passages])
    least = HELD * lengths[:, 0] * np.minimum(1, REACH / sizes)
    return Block(passages, terms, space, vectors, least.astype(np.float32))


def lcs(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, with a bit for each word of `a`."""
    where: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b.tolist():
        hit = row & where.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _contains(words: np.ndarray, run: np.ndarray) -> bool:
    if not len(run) or len(run) > len(words):
        return False
    starts = np.flatnonzero(words[: len(words) - len(run) + 1] == run[0])
    return any((words[s : s + len(run)] == run).all() for s in starts.tolist())


def judge(passage: Passage, words: np.ndarray) -> tuple[bool, float, bool]:
    """Whether the passage has leaked into these words; the share of it in common; the answer."""
    size = len(passage.words)
    if size < SHORT:
        whole = _contains(words, passage.words)
        return whole, float(whole), whole
    share = lcs(passage.words, words) / size
    if share < WITH_ANSWER:
        return False, share, False
    answer = len(passage.answer) and lcs(passage.answer, words) >= ANSWER * len(passage.answer)
    return share >= ALONE or bool(answer), share, bool(answer)


def aligned(a: np.ndarray, b: np.ndarray) -> tuple[float, int]:
    """Words of `a` found in order in `b`, less a `PUT_IN`th for each word put in between them; and the
    words found.

    A word of `b` that stands for one of `a` which is left out is changed, not put in. A row of the
    table is kept for each word of `b`: the best that ends by each word of `a`. Points and words are
    held in one number.
    """
    point = 1 << 20
    gain = PUT_IN * point + 1
    row = np.zeros(len(a) + 1, np.int64)
    best = 0
    hits = {x: gain * (a == x) for x in np.intersect1d(a, b).tolist()}
    for x in b.tolist():
        diagonal = row[:-1] + hits[x] if x in hits else row[:-1]
        row[1:] = np.maximum(diagonal, row[1:] - point)
        np.maximum(row, 0, out=row)
        np.maximum.accumulate(row, out=row)
        best = max(best, int(row[-1]))
    return (best >> 20) / PUT_IN, best & (point - 1)


def holds_answer(answer: np.ndarray, words: np.ndarray) -> bool:
    """Whether some run of the words, a quarter longer than the answer, has enough of it in order."""
    if not len(answer):
        return False
    least, size = ANSWER * len(answer), len(answer) + len(answer) // 4 + 1
    inside = np.isin(words, answer)
    sums = np.concatenate([[0], np.cumsum(inside)])
    ends = np.minimum(np.arange(len(words)) + size, len(words))
    # A run that holds it can begin with its first word in common.
    starts = np.flatnonzero(inside & (sums[ends] - sums[:-1] >= least))
    return any(lcs(answer, words[s : s + size]) >= least for s in starts.tolist())


def judge_around(
    passage: Passage, words: np.ndarray, first: int, last: int
) -> tuple[bool, float, bool]:
    """As `judge`, around the words from `first` to `last` of a document; its answer anywhere."""
    size = len(passage.words)
    near = _densest(passage, words[max(0, first - size) : last + size])
    leaked, share, answer = judge(passage, near)
    if size < SHORT or leaked and answer:
        return leaked, share, answer
    reach = int(WIDE * size)
    wide = words[max(0, first - reach) : last + reach]
    # No part of the stretch has more in common than all of it.
    most = lcs(passage.words, wide) / size
    if most < WITH_ANSWER:
        return False, share, False
    answer = holds_answer(passage.answer, words)
    enough = WITH_ANSWER if answer else ALONE
    if not leaked and share < enough <= most:
        points, found = aligned(passage.words, wide)
        if points >= enough * size:
            share = found / size
    return share >= enough, share, answer


def _candidates(block: Block, place: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int]]:
    """(text, first half window, passage) of windows that are near a passage."""
    known = np.flatnonzero(place >= 0)
    if not len(known):
        return []
    sizes = np.diff(starts)
    text = np.repeat(np.arange(len(sizes)), sizes)[known]
    half = (known - starts[text]) // STEP
    change = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (half[1:] != half[:-1])))
    text, half = text[change], half[change]
    own = place[known]
    # Distinct terms would need a sort; runs of one term are rare, so terms are counted.
    numbers = np.diff(np.append(change, len(known)))
    sums = np.add.reduceat(block.space[own], change, axis=0)
    nexts = np.flatnonzero((text[1:] == text[:-1]) & (half[1:] == half[:-1] + 1))
    joint, joint_numbers = sums.copy(), numbers.copy()
    joint[nexts] += sums[nexts + 1]
    joint_numbers[nexts] += numbers[nexts + 1]
    # A half window without a neighbour before it is a window of its own.
    found = set()
    lowest = float(block.least.min())
    terms = min(TERMS, min(len(p.words) for p in block.passages))
    for vectors, count in ((joint, joint_numbers), (sums, numbers)):
        length = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        enough = np.flatnonzero((count >= terms) & (length >= lowest))
        for begin in range(0, len(enough), 4096):
            some = enough[begin : begin + 4096]
            product = vectors[some] @ block.vectors.T
            near = np.flatnonzero((product >= block.least).ravel())
            i, j = np.divmod(near, len(block.passages))
            cosine = product[i, j] >= COSINE * length[some[i]]
            at, j = some[i[cosine]], j[cosine]
            found.update(zip(text[at].tolist(), half[at].tolist(), j.tolist()))
    return sorted(found)


def find_leaks(block: Block, texts) -> list[tuple[int, int, float, bool]]:
    """(text, item, share, answer) for all passages that leaked into an Arrow string array."""
    distinct, index, starts = words_of(texts)
    place = _places(block.terms, distinct)[index]
    best: dict[tuple[int, int], tuple[float, bool]] = {}
    held, words = -1, distinct[:0]
    for text, half, j in _candidates(block, place, starts):
        passage = block.passages[j]
        if text != held:
            held, words = text, distinct[index[starts[text] : starts[text + 1]]]
        leaked, share, answer = judge_around(passage, words, half * STEP, (half + 2) * STEP)
        key = (text, passage.item_id)
        if leaked and (share, answer) > best.get(key, (0.0, False)):
            best[key] = (share, answer)
    return [(text, item, *found) for (text, item), found in sorted(best.items())]


def _densest(passage: Passage, words: np.ndarray) -> np.ndarray:
    """The run of words, a quarter longer than the passage, with the most words of it.

    In a longer one, frequent words alone would make a long common subsequence.
    """
    size = len(passage.words) + len(passage.words) // 4 + 1
    if len(words) <= size:
        return words
    inside = np.concatenate([[0], np.cumsum(np.isin(words, passage.words))])
    start = int(np.argmax(inside[size:] - inside[:-size]))
    return words[start : start + size]


def blocks(docs: DataFrame, benchmark: DataFrame) -> Iterator[Block]:
    """The benchmark in blocks of `BLOCK` passages, by item and text; those without words are left out."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    held: list = []
    for row in items.orderBy("item_id", "text").toLocalIterator():
        held.append(row)
        if len(held) == BLOCK:
            passages, held = _passages(held), []
            if passages:
                yield _block(docs.sparkSession, passages, docs)
    passages = _passages(held) if held else []
    if passages:
        yield _block(docs.sparkSession, passages, docs)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, share, answer) for every passage of `benchmark` (item_id, text) that leaked
    into a row of `docs` (doc_id, text).

    `share` is the part of the passage's words found in order, `answer` whether its last sentence is
    anywhere in the document. Null and empty texts, in either table, have no leaks. Repeated documents are told each;
    of equal items with the same id one. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = docs.sparkSession.createDataFrame([], LEAKS)
    for block in blocks(rows, benchmark):

        def search(batches, block=block) -> Iterator:
            import pyarrow as pa

            for batch in batches:
                for some in text_slices(batch, 1):
                    hits = find_leaks(block, some.column(1))
                    yield pa.RecordBatch.from_arrays(
                        [
                            some.column(0).take(pa.array([h[0] for h in hits], pa.int64())),
                            pa.array([h[1] for h in hits], pa.int64()),
                            pa.array([h[2] for h in hits], pa.float64()),
                            pa.array([h[3] for h in hits], pa.bool_()),
                        ],
                        ["doc_id", "item_id", "share", "answer"],
                    )
                trim()

        found = found.union(rows.mapInArrow(search, LEAKS))
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` into which no passage leaked, unchanged."""
    at = docs.columns.index("text")
    for block in list(blocks(docs, benchmark)):

        def clean(batches, block=block) -> Iterator:
            import pyarrow as pa

            for batch in batches:
                for some in text_slices(batch, at):
                    kept = np.ones(some.num_rows, bool)
                    kept[[h[0] for h in find_leaks(block, some.column(at))]] = False
                    yield some.filter(pa.array(kept))
                trim()

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
