"""Spelling variants: words one edit apart, found by search schemes over bidirectional FM-indexes.

A word and another that differs from it by one inserted, deleted or replaced character agree in the
word's left half or in its right half. So there are two searches: match one half exactly, from
the middle outwards to the word's end on that side, then turn and extend across the other half,
where one error is allowed, to the other end. An index over `|word|word|...|` holds the text's suffix
array forwards and backwards; a pattern is an interval of suffix ranks in each, and a character
added on either side narrows both. All queries of a shard move on together, as arrays of
intervals.

How it is spread: words near to each other meet by what must be equal. The left search looks for words
of a length that begin like the query, the right one for words that end like it, so the vocabulary is
dealt twice, by (length, beginning) and by (length, end), into shards of bounded size. A shard has an
index of its own words. Words that share beginning and length with very many others are dealt to
several shards, and their queries go to each of those.

A pair is found once: the right search leaves out what the left one finds, words that begin with the
query's left half.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.llm.common import ranges, written

LETTERS = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Characters of words, with their delimiters, that a shard should hold.
SHARD = 2**16
#: Stands between words; smaller than any character.
MARK = 0
DELETE, REPLACE, INSERT = -1, 0, 1
PAIRS = "word string, n long, near string, near_n long"


def spellings(docs: DataFrame, drop_every: int | None = None) -> DataFrame:
    """(word, n): every word of the texts, A-Z in lower case, and how often it occurs.

    Words are runs of Latin-1 letters. With `drop_every`, a run loses the character `h % length` where
    that number divides `h`, the crc32 of `<doc_id>:<run>`. Null texts have no words; a null doc_id
    counts as empty.
    """
    runs = F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(LETTERS), F.lit(0)))
    words = docs.select("doc_id", runs.alias("word"))
    if drop_every:
        key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word"))
        words = words.select("word", F.crc32(key).alias("h"))
        at = (F.col("h") % F.char_length("word")).cast("int")
        cut = F.concat(
            F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.char_length("word"))
        )
        words = words.select(F.when(F.col("h") % drop_every == 0, cut).otherwise(F.col("word")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


class Index:
    """A bidirectional FM-index over delimited words of code points.

    `less[d][i, c]` is how many of the first `i` characters that precede the suffixes in order of
    direction `d` (0: forwards, 1: backwards) are smaller than `c`. An interval is a pair of first ranks, one a
    direction, and a size.
    """

    def __init__(self, words: list[np.ndarray]):
        lengths = np.array([len(w) for w in words])
        flat = np.full(int(lengths.sum()) + len(words) + 1, MARK, np.int64)
        begins = np.cumsum(lengths + 1) - lengths
        flat[ranges(begins, lengths)] = np.concatenate(words)
        self.alphabet, text = np.unique(flat, return_inverse=True)
        self.size, self.kinds = len(flat), len(self.alphabet)
        owner = np.repeat(np.arange(len(words) + 1), np.append(lengths + 1, 1))
        self.less, self.first, self.owner = [], [], None
        for way in (text, text[::-1]):
            suffixes = self._sorted(way)
            if self.owner is None:
                self.owner = owner[suffixes]  # the word whose mark or character a suffix begins with
            before = way[suffixes - 1]
            seen = np.zeros((self.size + 1, self.kinds + 1), np.int32)
            seen[np.arange(1, self.size + 1), before + 1] = 1
            np.cumsum(seen, axis=0, out=seen)
            np.cumsum(seen, axis=1, out=seen)
            self.less.append(seen)
            self.first.append(seen[-1])

    @staticmethod
    def _sorted(text: np.ndarray) -> np.ndarray:
        """The ranks of all rotations, by doubling the compared length."""
        _, rank = np.unique(text, return_inverse=True)
        step, size = 1, len(text)
        while True:
            pairs = rank * size + np.roll(rank, -step)
            order = np.argsort(pairs, kind="stable")
            ordered = pairs[order]
            steps = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
            rank = np.empty(size, np.int64)
            rank[order] = steps
            if steps[-1] == size - 1 or step >= size:
                return order
            step *= 2

    def whole(self, n: int) -> np.ndarray:
        """The intervals of `n` empty patterns: first ranks forwards and backwards, size."""
        state = np.zeros((3, n), np.int64)
        state[2] = self.size
        return state

    def extend(self, state: np.ndarray, symbols: np.ndarray, right: bool) -> np.ndarray:
        """The intervals with a character more on the right or left; size 0 where there are none."""
        way = 1 if right else 0  # the order in which new characters stand before the pattern
        less, first = self.less[way], self.first[way]
        low, high = state[way], state[way] + state[2]
        smaller = less[high, symbols] - less[low, symbols]
        size = less[high, symbols + 1] - less[low, symbols + 1] - smaller
        new = np.empty_like(state)
        # Characters that precede the first `low` suffixes, and equal this one.
        new[way] = first[symbols] + less[low, symbols + 1] - less[low, symbols]
        new[1 - way] = state[1 - way] + smaller
        new[2] = size
        return new

    def branches(self, state: np.ndarray, right: bool) -> np.ndarray:
        """How often each character of the alphabet stands beside each pattern."""
        less = self.less[1 if right else 0]
        low, high = state[1 if right else 0], state[1 if right else 0] + state[2]
        return np.diff(less[high] - less[low], axis=1)


def _next(index, state, who, symbols, right):
    """Extend and keep those that are left; symbols of -1 are not in the index."""
    there = symbols >= 0
    state, who = index.extend(state[:, there], symbols[there], right), who[there]
    left = state[2] > 0
    return state[:, left], who[left]


def one_error(index: Index, symbols: np.ndarray, lengths: np.ndarray, right: bool, edit: int):
    """(query, word) pairs: words of the index that differ from a query by this edit, in the half on the
    right (`right`) or left, while the other half agrees.

    `symbols` are the characters of all queries in a row, as places in the index's alphabet (-1: not
    in it), `lengths` how many each has.
    """
    begins = np.cumsum(lengths) - lengths
    half, mark = lengths // 2, np.searchsorted(index.alphabet, MARK)
    who = np.arange(len(lengths))
    state = index.whole(len(who))
    # From the middle to the end of the half that agrees; `done` characters are matched.
    kept = half if right else lengths - half
    done = 0
    finished, finished_who = [], []
    while len(who):
        ended = kept[who] == done
        if ended.any():
            finished.append(state[:, ended])
            finished_who.append(who[ended])
            state, who = state[:, ~ended], who[~ended]
        at = half[who] - 1 - done if right else half[who] + done
        state, who = _next(index, state, who, symbols[begins[who] + at], not right)
        done += 1
    if not finished_who:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    state, who = np.concatenate(finished, axis=1), np.concatenate(finished_who)
    state, who = _next(index, state, who, np.full(len(who), mark), not right)
    # Now the other way, with and without the error.
    rest = (lengths - half) if right else half
    error_state, error_who = index.whole(0), np.empty(0, np.int64)
    pairs = [], []
    done = 0
    while len(who) or len(error_who):
        # A query's character `done` is the next for those without an error; for those with one the
        # same, as deletions and replacements have passed theirs, and insertions none.
        over = rest[error_who] == done
        if over.any():
            found, owners = _next(
                index, error_state[:, over], error_who[over], np.full(int(over.sum()), mark), right
            )
            # The suffix that begins with the pattern's first mark names the word.
            pairs[0].append(owners)
            pairs[1].append(index.owner[found[0]])
            error_state, error_who = error_state[:, ~over], error_who[~over]
        open_ = rest[who] >= done
        if edit != INSERT:
            open_ &= rest[who] > done
        state, who = state[:, open_], who[open_]

        def next_symbols(own):
            last = rest[own] == done
            at = half[own] + done if right else half[own] - 1 - done
            return np.where(last, -1, symbols[begins[own] + np.where(last, 0, at)])

        wanted = next_symbols(who)
        stepped, stepped_who = _next(index, error_state, error_who, next_symbols(error_who), right)
        new_state, new_who = index.whole(0), who[:0]
        if edit == DELETE:
            new_state, new_who = state, who
        elif len(who):
            counts = index.branches(state, right)
            counts[:, mark] = 0
            rows = np.flatnonzero(wanted >= 0)
            counts[rows, wanted[rows]] = 0
            rows, others = np.nonzero(counts)
            new_state, new_who = _next(index, state[:, rows], who[rows], others, right)
        if edit == INSERT:
            # They have the same next character still before them.
            last = rest[new_who] == done
            ended, owners = _next(
                index, new_state[:, last], new_who[last], np.full(int(last.sum()), mark), right
            )
            pairs[0].append(owners)
            pairs[1].append(index.owner[ended[0]])
            new_state, new_who = new_state[:, ~last], new_who[~last]
            new_state, new_who = _next(index, new_state, new_who, next_symbols(new_who), right)
        error_state = np.concatenate([stepped, new_state], axis=1)
        error_who = np.concatenate([stepped_who, new_who])
        state, who = _next(index, state, who, wanted, right)
        done += 1
    if not pairs[0]:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    found = np.unique(
        np.stack([np.concatenate(pairs[0]), np.concatenate(pairs[1])]).astype(np.int64), axis=1
    )
    return found[0], found[1]


def points(words: list[str]) -> list[np.ndarray]:
    """The code points of each word."""
    return [np.frombuffer(word.encode("utf-32-le"), "<u4").astype(np.int64) for word in words]


def near_in_shard(index: Index, words: list[str], queries: list[str], right: bool, edit: int):
    """(query, word) places of the pairs of a query and a word of the index that this search finds."""
    own = points(queries)
    lengths = np.array([len(x) for x in own], np.int64)
    flat = np.concatenate(own) if own else np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(index.alphabet, flat), index.kinds - 1)
    symbols = np.where(index.alphabet[at] == flat, at, -1)
    of, near = one_error(index, symbols, lengths, right, edit)
    if not right and len(of):
        pairs = zip(of.tolist(), near.tolist())
        new = [not words[w].startswith(queries[q][: len(queries[q]) // 2]) for q, w in pairs]
        of, near = of[new], near[new]
    return of, near


def _begins(length: Column) -> Column:
    """How many characters a word of this length surely shares with each word near to it, on the side
    of the half that agrees: half of the shortest such word."""
    return F.greatest(F.lit(1), F.floor((length - 1) / 2)).cast("int")


def _placed(words: DataFrame, bucket_count: int) -> tuple[DataFrame, DataFrame]:
    """(right, bucket, word, n), where each word is looked for, and how many parts a bucket has."""
    length = F.char_length("word")
    rows = words.select(
        "word", "n", F.explode(F.array(F.lit(True), F.lit(False))).alias("right"), length.alias("length")
    )
    rows = rows.withColumn("bucket", _bucket(F.col("length"), F.col("right"), bucket_count))
    sizes = rows.groupBy("right", "bucket").agg(
        F.ceil(F.sum(F.col("length") + 1) / SHARD).cast("long").alias("parts")
    )
    return rows, sizes


def _bucket(length: Column, right: Column, bucket_count: int) -> Column:
    """Where words of this length go that begin, or end, like `word`."""
    shared = _begins(length)
    part = F.when(right, F.substring("word", F.lit(1), shared)).otherwise(
        F.substring("word", -shared, shared)
    )
    return F.pmod(F.xxhash64(length.cast("int"), part), F.lit(bucket_count))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every ordered pair of words of (word, n) that differ by exactly one
    inserted, deleted or replaced character, once each.

    Words are distinct; those that are null or have fewer than two characters take no part.
    """
    words = written(words.filter(F.char_length("word") >= 2).select("word", "n"), "spelling-words")
    characters = words.agg(F.sum(F.char_length("word") + 1)).first()[0] or 0
    # Half full on average, so that most buckets are one part.
    bucket_count = max(1, -(-2 * characters // SHARD))
    placed, sizes = _placed(words, bucket_count)
    sizes = written(sizes, "spelling-shards")
    held = placed.join(sizes, ["right", "bucket"]).select(
        "right",
        "bucket",
        F.pmod(F.xxhash64("word", F.lit(1)), F.col("parts")).alias("part"),
        "word",
        "n",
    )
    edits = F.explode(F.array(*[F.lit(x) for x in (DELETE, REPLACE, INSERT)])).alias("edit")
    asked = words.select(
        F.col("word").alias("query"),
        F.col("n").alias("query_n"),
        "word",
        F.explode(F.array(*[F.lit(x) for x in (DELETE, REPLACE, INSERT)])).alias("edit"),
    ).withColumn("length", F.char_length("word") + F.col("edit"))
    asked = asked.filter("length >= 2").withColumn(
        "right", F.explode(F.array(F.lit(True), F.lit(False)))
    )
    asked = (
        asked.withColumn("bucket", _bucket(F.col("length"), F.col("right"), bucket_count))
        .join(sizes, ["right", "bucket"])
        .select(
            "right",
            "bucket",
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
            "query",
            "query_n",
            "edit",
        )
    )

    def search(key, own, queries):
        import pyarrow as pa

        found: list[list] = [[], [], [], []]
        if own.num_rows and queries.num_rows:
            words_, numbers = own.column("word").to_pylist(), own.column("n").to_numpy()
            index = Index(points(words_))
            edit = queries.column("edit").to_numpy()
            asking, asking_n = queries.column("query"), queries.column("query_n").to_numpy()
            for kind in (DELETE, REPLACE, INSERT):
                mine = np.flatnonzero(edit == kind)
                if len(mine):
                    texts = asking.take(pa.array(mine)).to_pylist()
                    of, near = near_in_shard(index, words_, texts, key[0].as_py(), kind)
                    found[0] += [texts[i] for i in of.tolist()]
                    found[1].append(asking_n[mine[of]])
                    found[2] += [words_[i] for i in near.tolist()]
                    found[3].append(numbers[near])
        none = np.empty(0, np.int64)
        return pa.Table.from_arrays(
            [
                pa.array(found[0], pa.string()),
                pa.array(np.concatenate(found[1] or [none])),
                pa.array(found[2], pa.string()),
                pa.array(np.concatenate(found[3] or [none])),
            ],
            ["word", "n", "near", "near_n"],
        )

    shard = ["right", "bucket", "part"]
    return held.groupBy(*shard).cogroup(asked.groupBy(*shard)).applyInArrow(search, PAIRS)


def forms(words: DataFrame, times: int = 2) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for each word of (word, n).

    Rows of one word count together, rows without a word not at all; other columns are ignored. `n_near` counts the near words. A word's form is the near word of largest n (ties: the smallest in
    code-point order) if that n is at least `times` (2 or more) times its own, else null; its root is
    what following forms leads to, the word itself without one.
    """
    if times < 2:
        raise ValueError("forms must grow, so times is 2 or more")
    known = words.filter("word is not null").groupBy("word").agg(F.sum("n").alias("n"))
    words = written(known, "spelling-vocabulary")
    # Least of (-n, word): the largest n, then the smallest word.
    best = near_words(words).groupBy(F.col("word").alias("of")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    form_n = -F.col("best.less")
    follows = F.coalesce(form_n >= times * F.col("n"), F.lit(False))
    rows = written(
        words.join(best, F.col("word") == F.col("of"), "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(follows, F.col("best.near")).alias("form"),
            F.when(follows, form_n).alias("form_n"),
        ),
        "spelling-forms",
    )
    return rows.join(roots(rows), "word", "left").withColumn("root", F.coalesce("root", "word"))


def roots(rows: DataFrame) -> DataFrame:
    """(word, root) of the words of (word, form) that have a form.

    Each round every word skips to where the one it points to points, so a chain of `k` forms takes
    `log2(k)` rounds; as n at least doubles along it, that is six rounds at most.
    """
    formed = rows.filter("form is not null")
    links = written(formed.select("word", F.col("form").alias("root")), "spelling-links")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = written(
            links.join(ahead, "root", "left").select(
                "word",
                F.coalesce("next", "root").alias("root"),
                F.col("next").isNotNull().alias("moved"),
            ),
            "spelling-links",
        )
        moved = not links.filter("moved").isEmpty()
        links = links.drop("moved")
        if not moved:
            return links
