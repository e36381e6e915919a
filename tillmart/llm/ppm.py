"""Language-model scores by prediction by partial matching (PPM) over bytes.

The model is a trie of byte contexts: for every string of up to `ORDER + 1` bytes how often the
learning texts have it. A text's first bytes follow `ORDER` start marks, and an end mark follows its
last byte; start marks are context only. A byte is predicted in the longest context that the trie
has. If it never followed there, the model escapes to the context without its first byte, where
the bytes that did follow in the longer one are excluded, and so on down to the uniform
distribution over what is left. With `T` occurrences of `d` different bytes in a context, a byte seen `n`
times has probability `n / (T + d)` and the escape `d / (T + d)` (escape method C); under exclusion, `T` and
`d` count what is not excluded. What was seen in a context was also seen in each shorter one,
so for a shorter context the excluded counts belong to the longer one's node (`shadow`).

How it is spread: texts are dealt to blocks of bounded size. Each block asks for the distinct
strings of `ORDER + 1` bytes and the distinct words that it holds; the same rows hold how often its
learning texts have them. Counts, trie and the probability of every string asked for are joins and
aggregates over the whole corpus; a block gets back just the answers to what it asked. No task holds
the model, which grows with the corpus, and nothing of it is broadcast.

`adaptive` scores each document by itself instead: the trie starts empty and learns as it reads.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmart.llm.common import hash_strings, ranges, text_slices, word_hashes, written

ORDER = 4
#: Bytes that UTF-8 never uses mark the start and the end of a text.
START, END = 0xFF, 0xFE
#: The bytes that UTF-8 uses, and the end.
SYMBOLS = 243 + 1
#: Bytes of text after which a block is full, and those looked at together. The larger a block, the
#: fewer of its strings are new.
BLOCK, TOGETHER = 2**25, 2**20
#: Keys a block collects before it counts them again.
COLLECTED = 2**20
WORD, GRAM = 0, 1
ASKS = "block long, kind int, key long, n long"
SCORES = "row_id long, n_bytes long, n_tokens long, n_known long, base double, score double"


def _end_of_text() -> np.uint64:
    """The key of the token that ends each text; with its blank it is no word."""
    import pyarrow as pa

    return hash_strings(pa.array([" end"]))[0]


def gram_codes(texts, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of each text and each text's end, the string of `order + 1` bytes that ends there,
    as a number. Returns all in a row and where each text's begin, with the total at the end."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    # Joined anew, as a slice shares its buffers with the whole.
    texts = pa.concat_arrays([pc.fill_null(texts.cast(pa.large_string()), "")])
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    sizes = np.diff(offsets)
    before = np.arange(len(sizes)) * (order + 1) + np.cumsum(sizes) - sizes
    spread = np.full(len(raw) + len(sizes) * (order + 1), START, np.uint64)
    spread[ranges(before + order, sizes)] = raw
    spread[before + order + sizes] = END
    codes = np.zeros(len(spread), np.uint64)
    for back in range(order + 1):
        codes[back:] |= spread[: len(spread) - back] << np.uint64(8 * back)
    places = ranges(before + order, sizes + 1)
    return codes[places].view(np.int64), np.concatenate([[0], np.cumsum(sizes + 1)])


def token_keys(texts) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the words of each text and of its end, like `gram_codes`."""
    words, starts = word_hashes(texts)
    sizes = np.diff(starts)
    keys = np.full(len(words) + len(sizes), _end_of_text(), np.uint64)
    keys[ranges(starts[:-1] + np.arange(len(sizes)), sizes)] = words
    return keys.view(np.int64), starts + np.arange(len(starts))


class _Asked:
    """The distinct keys of one kind in a block, and how often its learning texts have them."""

    def __init__(self):
        self.keys, self.numbers, self.size = [], [], 0

    def add(self, keys: np.ndarray, starts: np.ndarray, learns: np.ndarray) -> None:
        learning = np.repeat(learns, np.diff(starts))
        for part, counts in ((keys[learning], True), (keys[~learning], False)):
            if len(part):
                found, numbers = np.unique(part, return_counts=True)
                self.keys.append(found)
                self.numbers.append(numbers if counts else np.zeros(len(found), np.int64))
                self.size += len(found)
        if self.size > COLLECTED and len(self.keys) > 2:
            keys, numbers = self.merged()
            self.keys, self.numbers, self.size = [keys], [numbers], 0

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        keys = np.concatenate(self.keys)
        order = np.argsort(keys, kind="stable")
        keys, numbers = keys[order], np.concatenate(self.numbers)[order]
        firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[firsts], np.add.reduceat(numbers, firsts)


def _dealt(rows: DataFrame, size: int) -> DataFrame:
    """Number the rows and give each its block: texts in a row, up to `size` bytes and the end of one."""

    def deal(batches) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        task, row, total = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            sizes = pc.binary_length(batch.column("text")).to_numpy().astype(np.int64)
            before = total + np.cumsum(sizes) - sizes
            own = [
                pa.array((task << 32) + before // size),
                pa.array((task << 40) + np.arange(row, row + len(sizes))),
            ]
            names = ["block", "row_id", *batch.schema.names]
            yield pa.RecordBatch.from_arrays([*own, *batch.columns], names)
            row, total = row + len(sizes), total + int(sizes.sum())

    types = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    return rows.mapInArrow(deal, f"block long, row_id long, {types}")


def _asks(texts: DataFrame, order: int) -> DataFrame:
    """(block, kind, key, n): what each block holds, and how often its learning texts do."""

    def ask(batches) -> Iterator:
        import pyarrow as pa

        block, words, grams = None, _Asked(), _Asked()

        def answer():
            for kind, asked in ((WORD, words), (GRAM, grams)):
                keys, numbers = asked.merged()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(keys), block, np.int64)),
                        pa.array(np.full(len(keys), kind, np.int32)),
                        pa.array(keys),
                        pa.array(numbers),
                    ],
                    ["block", "kind", "key", "n"],
                )

        for batch in batches:
            blocks = batch.column("block").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
            for a, b in zip(cuts, cuts[1:]):
                if b > a and blocks[a] != block:
                    if block is not None:
                        yield from answer()
                    block, words, grams = blocks[a], _Asked(), _Asked()
                at = batch.schema.get_field_index("text")
                for part in text_slices(batch.slice(a, b - a), at, TOGETHER):
                    learns = part.column("learns").to_numpy(zero_copy_only=False)
                    words.add(*token_keys(part.column(at)), learns)
                    grams.add(*gram_codes(part.column(at), order), learns)
        if block is not None:
            yield from answer()

    return texts.select("block", "learns", "text").mapInArrow(ask, ASKS)


def _node(length: Column | int, code: Column) -> Column:
    """A string's key in the trie: its length above its bytes."""
    return F.shiftleft(F.lit(length).cast("long"), 56).bitwiseOR(code)


def _ending(code: str, length: int) -> Column:
    """The last bytes of a string."""
    return F.col(code).bitwiseAND(F.lit((1 << 8 * length) - 1))


def trie(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """The trie of (key, n), strings of `order + 1` bytes: a row for each string and context.

    `node` is the string; `n` how often it occurs, null for start marks alone; `total` and `kinds` how
    many bytes, and how many different ones, follow it, null where none does; `shadow` how often those
    that follow it follow the context without its first byte.
    """
    endings = F.explode(
        F.array(
            *[
                F.struct(F.lit(k).alias("length"), _ending("key", k).alias("code"))
                for k in range(1, order + 2)
            ]
        )
    )
    strings = written(
        grams.select(endings.alias("x"), "n")
        .groupBy("x.length", "x.code")
        .agg(F.sum("n").alias("n")),
        "ppm-strings",
    )
    # Nothing is shorter than a single byte; for the contexts of all others their parents' counts.
    tail = reduce(
        lambda other, k: F.when(F.col("length") == k, _ending("code", k - 1)).otherwise(other),
        range(2, order + 2),
        F.lit(None).cast("long"),
    )
    parents = strings.select(_node(F.col("length"), F.col("code")).alias("tail"), F.col("n").alias("m"))
    followed = (
        strings.withColumn("tail", _node(F.col("length") - 1, tail))
        .join(parents, "tail", "left")
        .groupBy(_node(F.col("length") - 1, F.shiftright("code", 8)).alias("node"))
        .agg(
            F.sum("n").alias("total"), F.count("*").alias("kinds"), F.sum("m").alias("shadow")
        )
    )
    own = strings.select(_node(F.col("length"), F.col("code")).alias("node"), "n")
    return own.join(followed, "node", "full_outer")


def log10_probabilities(grams: DataFrame, nodes: DataFrame, order: int = ORDER) -> DataFrame:
    """(key, value): for each row (key, n) of `grams`, strings of `order + 1` bytes and how often learning
    texts have them, the log10 of the probability that the model gives its last byte after the
    others."""
    # Most are known in full, and need no more than those that share their context.
    context = Window.partitionBy(F.shiftright("key", 8))
    whole = F.sum("n").over(context) + F.count("*").over(context)
    seen = grams.filter("n > 0").select("key", (F.log10("n") - F.log10(whole)).alias("value"))
    roles = [
        F.struct(F.lit(f"n{k}").alias("role"), _node(k, _ending("key", k)).alias("node"))
        for k in range(1, order + 1)
    ] + [
        F.struct(
            F.lit(f"c{k}").alias("role"),
            _node(k, F.shiftright("key", 8).bitwiseAND(F.lit((1 << 8 * k) - 1))).alias("node"),
        )
        for k in range(order + 1)
    ]
    unseen = grams.filter("n = 0").select("key", F.explode(F.array(*roles)).alias("x"))
    asked = unseen.select("key", "x.*")
    known = asked.join(nodes, "node", "left")

    def of(role: str, name: str) -> Column:
        return F.max(F.when(F.col("role") == role, F.col(name))).alias(f"{name}_{role}")

    wide = known.groupBy("key").agg(
        *[of(f"n{k}", "n") for k in range(1, order + 1)],
        *[of(f"c{k}", name) for k in range(order + 1) for name in ("total", "kinds", "shadow")],
    )
    return seen.union(wide.select("key", _chain(order).alias("value")))


def _chain(order: int) -> Column:
    """The walk from the longest known context down, from the columns of `log10_probabilities`.

    Built from the shortest context up: `reached` is the value of coming to context `k` with the
    bytes of context `k + 1` excluded, `begun` that of starting in it.
    """
    excluded = [F.coalesce(F.col(f"kinds_c{k}"), F.lit(0)) for k in range(order + 1)]
    uniform = -F.log10(F.lit(float(SYMBOLS)) - excluded[0])
    begun = -F.log10(F.lit(float(SYMBOLS)))  # where not even the shortest context is known
    below = uniform
    for k in range(order + 1):
        # In the longest context it never followed.
        n = F.coalesce(F.col(f"n_n{k + 1}"), F.lit(0)) if k < order else F.lit(0)
        total, kinds = F.col(f"total_c{k}"), F.col(f"kinds_c{k}")
        begun = F.when(total.isNull(), begun).otherwise(
            F.when(n > 0, F.log10(n) - F.log10(total + kinds)).otherwise(
                F.log10(kinds) - F.log10(total + kinds) + below
            )
        )
        if k < order:
            left = kinds - F.col(f"kinds_c{k + 1}")
            whole = total - F.col(f"shadow_c{k + 1}") + left
            # Where nothing is left there is nothing to tell: the escape is certain.
            below = F.when(n > 0, F.log10(n) - F.log10(whole)).otherwise(
                F.when(left > 0, F.log10(left) - F.log10(whole)).otherwise(0.0) + below
            )
    return begun


def _scored(texts: DataFrame, answers: DataFrame, order: int) -> DataFrame:
    """Sums over each text of the answers to what its block asked."""

    def score(own, given):
        import pyarrow as pa

        kinds = given.column("kind").to_numpy()
        keys, values = given.column("key").to_numpy(), given.column("value").to_numpy()
        known = {}
        for kind in (WORD, GRAM):
            mine = kinds == kind
            order_ = np.argsort(keys[mine])
            known[kind] = keys[mine][order_], values[mine][order_]

        def looked_up(kind, codes):
            at, value = known[kind]
            return value[np.searchsorted(at, codes)]

        parts = []
        for batch in own.to_batches():
            for rows in text_slices(batch, batch.schema.get_field_index("text"), TOGETHER):
                codes, starts = gram_codes(rows.column("text"), order)
                sums = np.add.reduceat(looked_up(GRAM, codes), starts[:-1])
                tokens, begins = token_keys(rows.column("text"))
                counts = looked_up(WORD, tokens)
                parts.append(
                    [
                        rows.column("row_id").to_numpy(),
                        np.diff(starts) - 1,
                        np.diff(begins),
                        np.add.reduceat((counts > 0).astype(np.int64), begins[:-1]),
                        np.add.reduceat(np.log10(counts + 1), begins[:-1]),
                        sums,
                    ]
                )
        columns = [pa.array(np.concatenate(x)) for x in zip(*parts)]
        pa.default_memory_pool().release_unused()
        names = ["row_id", "n_bytes", "n_tokens", "n_known", "base", "score"]
        return pa.Table.from_arrays(columns, names)

    left = texts.select("block", "row_id", "text").groupBy("block")
    return left.cogroup(answers.groupBy("block")).applyInArrow(score, SCORES)


def score(docs: DataFrame, learns: Column, order: int = ORDER, block: int = BLOCK) -> DataFrame:
    """Scores every row of `docs` (doc_id, text) by a model of those rows for which `learns` is true.

    Returns a row for each, with its doc_id and learns (false for null), and: n_bytes; n_tokens, words
    by white space with A-Z in lower case, and one for the end; n_known, those that a learning text
    has; train_tokens, all tokens of learning texts; base_score, the sum of
    `log10((c + 1) / (N + V + 1))` over tokens, where `c` is a token's number, `N` that of all and `V`
    that of different ones in learning texts; and score, log10 of the probability that the PPM
    model gives the whole text and its end. A null text is empty. Rows may repeat: each counts and each
    is scored. Without learning texts all is uniform. Other columns are ignored. Words are compared by
    64-bit hashes, strings of bytes exactly; `order` is at most 6.
    """
    if not 0 <= order <= 6:
        raise ValueError("order must be from 0 to 6")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(learns, F.lit(False)).alias("learns"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    texts = written(_dealt(rows, block), "ppm-texts")
    asks = written(_asks(texts, order), "ppm-asks")
    counts = written(asks.groupBy("kind", "key").agg(F.sum("n").alias("n")), "ppm-counts")
    grams = counts.filter(F.col("kind") == GRAM).select("key", "n")
    nodes = written(trie(grams.filter("n > 0"), order), "ppm-nodes")
    words = counts.filter(F.col("kind") == WORD).select("key", "n")
    n, v = words.agg(F.sum("n"), F.count_if(F.col("n") > 0)).first()
    values = words.select(F.lit(WORD).alias("kind"), "key", F.col("n").cast("double").alias("value"))
    found = log10_probabilities(grams, nodes, order)
    values = values.union(found.select(F.lit(GRAM).alias("kind"), "key", "value"))
    answers = asks.drop("n").join(written(values, "ppm-values"), ["kind", "key"])
    scored = _scored(texts, answers.select("block", "kind", "key", "value"), order)
    # Joined by number, so that the texts need not come back from the blocks.
    return texts.select("row_id", "doc_id", "learns").join(scored, "row_id").select(
        "doc_id",
        "learns",
        "n_bytes",
        "n_tokens",
        "n_known",
        F.lit(n or 0).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * math.log10((n or 0) + v + 1)).alias("base_score"),
        "score",
    )


def adaptive_score(raw: bytes, order: int = ORDER) -> float:
    """log10 of the probability of a text under a model that starts empty and learns each byte
    after it was coded."""
    seen: dict[bytes, dict[int, int]] = {}
    past, total = bytes([START] * order), 0.0
    for symbol in (*raw, END):
        excluded: set[int] = set()
        for k in range(order, -1, -1):
            followers = seen.get(past[order - k :])
            if followers is None:
                continue
            left = {s: n for s, n in followers.items() if s not in excluded}
            if not left:
                continue
            whole = sum(left.values()) + len(left)
            if symbol in left:
                total += math.log10(left[symbol] / whole)
                break
            total += math.log10(len(left) / whole)
            excluded |= left.keys()
        else:
            total -= math.log10(SYMBOLS - len(excluded))
        for k in range(order + 1):
            followers = seen.setdefault(past[order - k :], {})
            followers[symbol] = followers.get(symbol, 0) + 1
        past = (past + bytes([symbol]))[1:] if order else b""
    return total


def with_adaptive_score(docs: DataFrame, order: int = ORDER, into: str = "adaptive_score") -> DataFrame:
    """Add `into`, each text's score by `adaptive_score`; a null text is empty. All rows and other
    columns stay; a column of that name is replaced. A task holds the trie of one text."""
    kept = docs.drop(into)
    at = kept.columns.index("text")

    def run(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for rows in text_slices(batch, at, TOGETHER):
                scores = [adaptive_score((x or "").encode(), order) for x in rows.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(scores, pa.float64())], [*rows.schema.names, into]
                )

    from pyspark.sql import types as T

    schema = T.StructType([*kept.schema.fields, T.StructField(into, T.DoubleType())])
    return kept.mapInArrow(run, schema)
