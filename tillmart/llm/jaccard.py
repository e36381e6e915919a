"""N-gram Jaccard join by vertical partitioning.

Every document's set of word n-grams is put in one global order and cut at the same places into
fragments; a pair's overlap is counted in each fragment separately and summed per pair. Which pairs
are counted:

* Equal sets are one node, however many documents have them.
* A pair that is similar enough shares an n-gram among the first few of both, the prefix, in an order
  that puts frequent n-grams last. How far down the shared n-gram stands also bounds the overlap.
* Before sets are fetched, pairs are held against parity sketches: a bit for each range of hashes
  that says whether an odd number of n-grams falls there. Two sets differ in at least as many
  n-grams as their sketches do in bits, so pairs with too many different bits are left out. Short
  sketches of one length stand beside the n-grams themselves, so that such pairs are not even made.
* The nodes that share a prefix n-gram are not all paired. First each is paired with one of them,
  the one with the fewest rare n-grams of its own. Only where a prefix n-gram then still joins nodes
  that are not connected yet are those paired too, across components. So a large group of near
  copies costs about one pair a copy, and no link between unconnected nodes is left out.

The order of n-grams affects the work only, not the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.llm.common import shingle_hashes, text_slices, trim, written

FRAGMENT_BITS = 4
#: Frequent n-grams that are ordered by frequency: those seen in at least `LEAST` documents of a
#: few thousand, `MOST` of them at most. All others come before them, in order of their hashes.
LEAST, MOST = 4, 2**19
#: N-grams that are counted at a time.
COUNTED = 2**20
SETS = "doc_id long, n int, digest binary, prefix array<long>, parity array<long>, short array<long>"
#: 64-bit words of the sketch that pairs are held against while they are made: of most sets, and of those
#: with more n-grams than the first has bits twice over, in which it says nothing.
SHORT, LONGER = 8, 32
SEGMENTS = "digest binary, fragment int, grams array<long>"


def _texts(batches, at: int = 0) -> Iterator:
    for batch in batches:
        yield from text_slices(batch, at, 2**21)
        trim()


def frequent_grams(docs: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of frequent n-grams, sorted, and the rank of each by frequency, from 1."""

    def count(batches) -> Iterator:
        import pyarrow as pa

        held, total = [], 0

        def counted():
            grams, numbers = np.unique(np.concatenate(held), return_counts=True)
            often = numbers >= LEAST
            return pa.RecordBatch.from_arrays(
                [pa.array(grams[often].view(np.int64)), pa.array(numbers[often])], ["gram", "n"]
            )

        for rows in _texts(batches):
            grams, _ = shingle_hashes(rows.column(0), size)
            held.append(grams)
            total += len(grams)
            if total >= COUNTED:
                yield counted()
                held, total = [], 0
        if total:
            yield counted()

    counts = docs.select("text").mapInArrow(count, "gram long, n long")
    top = counts.groupBy("gram").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "gram").limit(MOST)
    found = top.toPandas()
    grams = found["gram"].to_numpy(np.int64).view(np.uint64)
    ranks = np.arange(len(grams), 0, -1)
    order = np.argsort(grams)
    return grams[order], ranks[order]


def prefix_size(n, percent: int):
    """How many of its first n-grams a set of `n` shares one with any set that is similar enough."""
    return n - -(-percent * n // 100) + 1


def _sets(docs: DataFrame, size: int, percent: int, frequent) -> DataFrame:
    known, ranks = frequent

    def build(batches) -> Iterator:
        import pyarrow as pa
        import xxhash

        for rows in _texts(batches, 1):
            grams, starts = shingle_hashes(rows.column(1), size)
            rank = np.zeros(len(grams), np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
                rank = np.where(known[at] == grams, ranks[at], 0)
            digests, prefixes, parities, shorts = [], [], [], []
            sizes = np.diff(starts)
            for a, b in zip(starts.tolist(), starts[1:].tolist()):
                digests.append(xxhash.xxh3_128_digest(grams[a:b].tobytes()))
                own = rank[a:b]
                # Grams are sorted by hash already.
                order = np.argsort(own, kind="stable") if own.any() else slice(None)
                prefixes.append(grams[a:b][order][: prefix_size(b - a, percent) if b > a else 0])
                parities.append(parity(grams[a:b]))
                shorts.append(parity(grams[a:b], 64 * (SHORT if b - a <= 128 * SHORT else LONGER)))

            def lists(arrays):
                cuts = np.cumsum([0] + [len(x) for x in arrays]).astype(np.int32)
                flat = np.concatenate(arrays) if arrays else grams[:0]
                return pa.ListArray.from_arrays(pa.array(cuts), pa.array(flat.view(np.int64)))

            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    pa.array(sizes.astype(np.int32)),
                    pa.array(digests, pa.binary()),
                    lists(prefixes),
                    lists(parities),
                    lists(shorts),
                ],
                ["doc_id", "n", "digest", "prefix", "parity", "short"],
            )

    return docs.select("doc_id", "text").mapInArrow(build, SETS)


def parity(grams: np.ndarray, bits: int | None = None) -> np.ndarray:
    """A set's parity sketch, in 64-bit words: of so many bits, a power of two; by default the next of at
    least a bit a gram."""
    bits = bits or (max(64, 1 << (len(grams) - 1).bit_length()) if len(grams) else 64)
    odd = np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def _sketches_allow(percent: int) -> Column:
    """Whether the sketches `left` and `right` differ in few enough bits; a sketch of double length
    is folded. At other lengths, which only low thresholds allow, nothing is said."""
    words = F.least(F.size("left"), F.size("right"))

    def folded(name: str) -> Column:
        both = F.transform(
            F.sequence(F.lit(0), words - 1),
            lambda i: F.get(name, i).bitwiseXOR(F.get(name, i + words)),
        )
        return F.when(F.size(name) == words, F.col(name)).when(F.size(name) == 2 * words, both)

    different = F.aggregate(
        F.zip_with(folded("left"), folded("right"), lambda x, y: F.bit_count(x.bitwiseXOR(y))),
        F.lit(0),
        lambda total, n: total + n,
    )
    few = different * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent)
    return F.coalesce(few, F.lit(True))


def _segments(docs: DataFrame, size: int) -> DataFrame:
    """(digest, fragment, grams): each document's set, cut by ranges of the hash."""

    def build(batches) -> Iterator:
        import pyarrow as pa
        import xxhash

        bounds = np.arange(1, 2**FRAGMENT_BITS, dtype=np.uint64) << np.uint64(64 - FRAGMENT_BITS)
        for rows in _texts(batches):
            grams, starts = shingle_hashes(rows.column(0), size)
            digests, fragments, cuts = [], [], [0]
            for a, b in zip(starts.tolist(), starts[1:].tolist()):
                digest = xxhash.xxh3_128_digest(grams[a:b].tobytes())
                inner = (a + np.searchsorted(grams[a:b], bounds)).tolist()
                for fragment, (x, y) in enumerate(zip([a, *inner], [*inner, b])):
                    if y > x:
                        digests.append(digest)
                        fragments.append(fragment)
                        cuts.append(y)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(digests, pa.binary()),
                    pa.array(fragments, pa.int32()),
                    pa.ListArray.from_arrays(
                        pa.array(np.array(cuts, np.int32)), pa.array(grams.view(np.int64))
                    ),
                ],
                ["digest", "fragment", "grams"],
            )

    return docs.select("text").mapInArrow(build, SEGMENTS)


def _possible(percent: int, a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Whether sizes, and what can be left to share after the places of the n-gram, allow a link.

    An overlap of `o` is enough if `o * (100 + percent) >= percent * (n_a + n_b)`.
    """
    most = F.least(a["n"] - a["pos"], b["n"] - b["pos"])
    return (
        (a["n"] * percent <= b["n"] * 100)
        & (b["n"] * percent <= a["n"] * 100)
        & (most * (100 + percent) >= (a["n"] + b["n"]) * percent)
    )


def _short_sketches_allow(percent: int, a: str, b: str) -> Column:
    """Whether the short sketches of two sides of a join differ in few enough bits; of different lengths
    nothing is said."""

    def different(words: range) -> Column:
        return sum(
            F.bit_count(F.get(f"{a}.short", F.lit(i)).bitwiseXOR(F.get(f"{b}.short", F.lit(i))))
            for i in words
        )

    first = different(range(SHORT))
    rest = F.coalesce(different(range(SHORT, LONGER)), F.lit(0))  # null where there are no more
    both = F.col(f"{a}.n") + F.col(f"{b}.n")
    few = (first + rest) * (100 + percent) <= both * (100 - percent)
    return few | (F.size(f"{a}.short") != F.size(f"{b}.short"))


def _near(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sketches leave it open that they are similar enough."""
    right = nodes.select(F.col("node").alias("b"), F.col("parity").alias("right"))
    left = nodes.select(F.col("node").alias("a"), F.col("parity").alias("left"))
    return (
        pairs.join(right, "b").join(left, "a").filter(_sketches_allow(percent)).drop("left", "right")
    )


def _links(
    pairs: DataFrame, rows: DataFrame, nodes: DataFrame, size: int, percent: int, unique: bool
) -> DataFrame:
    """Those of (a, b, n_a, n_b) that are similar enough, by partial overlaps summed per pair.

    Sets are made again from the texts, of one row a node. `b` is the side that stands in fewer
    pairs: its fragments travel with the pair, while those of `a`, which may be the partner of
    very many, meet them in a join that splits hot keys.
    """
    either = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    needed = nodes.select("node", "digest", "first").join(either, "node", "semi")
    needed = written(needed, "needed")
    texts = rows.join(needed.select(F.col("first").alias("doc_id")).distinct(), "doc_id", "semi")
    unnamed = rows.filter("doc_id is null")  # rows whose whole group has no id
    segments = (
        _segments(texts.select("text").union(unnamed.select("text")), size)
        .join(needed.select("digest", "node"), "digest")
        .select("node", "fragment", "grams")
    )
    segments = segments if unique else segments.dropDuplicates(["node", "fragment"])
    segments = written(segments, "segments")
    right = segments.select(F.col("node").alias("b"), "fragment", F.col("grams").alias("right"))
    left = segments.select(F.col("node").alias("a"), "fragment", F.col("grams").alias("left"))
    partial = (
        pairs.join(right, "b")
        .join(left, ["a", "fragment"])
        .select("a", "b", "n_a", "n_b", F.size(F.array_intersect("left", "right")).alias("part"))
    )
    overlap = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("part").alias("overlap"))
    enough = F.col("overlap") * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent
    return overlap.filter(enough).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (a, b); the label is a node of its component, the
    same for all of it.

    Each round moves every node to its smallest neighbour (or itself) and keeps the edges that
    are left between different ones, until there are none.
    """
    edges = written(edges.filter("a != b").distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select("b", "a"))
        moved = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to"))
        moved = written(moved.select("node", F.least("node", "to").alias("to")), "moved")
        if labels is None:
            labels = moved.select("node", F.col("to").alias("label"))
        else:
            step = moved.select(F.col("node").alias("label"), "to")
            labels = written(
                labels.join(step, "label", "left").select(
                    "node", F.coalesce("to", "label").alias("label")
                ),
                "labels",
            )
        first = moved.select(F.col("node").alias("a"), F.col("to").alias("a2"))
        second = moved.select(F.col("node").alias("b"), F.col("to").alias("b2"))
        left = edges.join(first, "a").join(second, "b").filter("a2 != b2")
        edges = written(
            left.select(
                F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")
            ).distinct(),
            "edges",
        )
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels


def similar_groups(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Per row of `docs`: doc_id, n_shingles, and component_id, the smallest doc_id that links
    reach from it.

    Words are separated by white space, A-Z in lower case; a set is the distinct runs of `size`
    words, or the whole sequence where there are fewer. Two rows link when
    `100 * intersection >= percent * union`. Null and empty texts have no set and link with nothing:
    their component is their own id. Repeated rows are kept, and equal texts are one component also
    where ids repeat. Null ids are never the smallest, unless all of a component are null. Other
    columns are ignored. N-grams are compared by 64-bit hashes, equal sets by 128-bit ones.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent must be from 1 to 100")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    sets = written(_sets(rows, size, percent, frequent_grams(rows, size)), "sets")
    nodes = (
        sets.filter("n > 0")
        .groupBy("digest", "n")
        .agg(
            F.min("doc_id").alias("first"),
            F.any_value("prefix").alias("prefix"),
            F.any_value("parity").alias("parity"),
            F.any_value("short").alias("short"),
        )
    )
    # Numbers are given once, as the table is written.
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    grams = nodes.select("node", "n", F.posexplode("prefix").alias("pos", "gram"))
    hubs = grams.groupBy("gram").agg(
        F.count("*").alias("members"), F.min(F.struct("pos", "n", "node")).alias("hub")
    )
    hubs = hubs.filter("members > 1").select("gram", "hub")
    shared = written(grams.join(hubs, "gram"), "shared")

    own = {"n": F.col("n"), "pos": F.col("pos")}
    hub = {"n": F.col("hub.n"), "pos": F.col("hub.pos")}
    first_pairs = (
        shared.filter((F.col("node") != F.col("hub.node")) & _possible(percent, own, hub))
        .select(
            F.col("hub.node").alias("a"),
            F.col("node").alias("b"),
            F.col("hub.n").alias("n_a"),
            F.col("n").alias("n_b"),
        )
        .distinct()
    )
    unique = _ids_are_unique(sets)
    first_pairs = written(_near(first_pairs, nodes, percent), "first-pairs")
    labels = components(_links(first_pairs, rows, nodes, size, percent, unique))

    tagged = shared.select("gram", "node", "n", "pos").join(labels, "node", "left")
    tagged = tagged.withColumn("label", F.coalesce("label", "node"))
    mixed = tagged.groupBy("gram").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    mixed = mixed.filter("low < high").select("gram")
    left = written(tagged.join(mixed, "gram", "semi"), "unconnected")
    left = left.join(nodes.select("node", "short"), "node")
    x, y = left.alias("x"), left.alias("y")
    sides = [{"n": F.col(f"{s}.n"), "pos": F.col(f"{s}.pos")} for s in "xy"]
    across = x.join(
        y,
        (F.col("x.gram") == F.col("y.gram"))
        & (F.col("x.label") < F.col("y.label"))
        & _possible(percent, *sides)
        & _short_sketches_allow(percent, "x", "y"),
    ).select(
        F.col("x.node").alias("a"),
        F.col("y.node").alias("b"),
        F.col("x.n").alias("n_a"),
        F.col("y.n").alias("n_b"),
        F.col("x.label").alias("label_a"),
        F.col("y.label").alias("label_b"),
    )
    across = written(_near(across.distinct(), nodes, percent), "across")
    more = _links(across.select("a", "b", "n_a", "n_b"), rows, nodes, size, percent, unique)
    joined = across.join(more, ["a", "b"]).select(
        F.col("label_a").alias("a"), F.col("label_b").alias("b")
    )
    merged = components(joined).select(F.col("node").alias("label"), F.col("label").alias("group"))

    grouped = (
        nodes.select("node", "digest", "first")
        .join(labels, "node", "left")
        .withColumn("label", F.coalesce("label", "node"))
        .join(merged, "label", "left")
        .withColumn("group", F.coalesce("group", "label"))
    )
    smallest = grouped.groupBy("group").agg(F.min("first").alias("component_id"))
    of_set = grouped.join(smallest, "group").select("digest", "component_id")
    return sets.join(of_set, "digest", "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias(
            "component_id"
        ),
    )


def _ids_are_unique(sets: DataFrame) -> bool:
    ids = sets.groupBy("doc_id").count().filter("count > 1")
    return ids.isEmpty()


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` whose doc_id is the smallest of their group, in full; of rows with the
    same id and text one. Rows without an id stay."""
    groups = similar_groups(docs, size, percent)
    ids = groups.filter("doc_id = component_id").select("doc_id").distinct()
    named = docs.filter("doc_id is not null").join(ids, "doc_id", "semi").select(*docs.columns)
    if not _ids_are_unique(groups):
        named = named.dropDuplicates(["doc_id", "text"])
    return named.union(docs.filter("doc_id is null"))
