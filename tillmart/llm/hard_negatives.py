"""Hard-negative mining by inner-product search with length buckets and coordinate pruning (LEMP).

Rows are ordered by length and cut into buckets of bounded size. Each bucket holds its vectors and its
longest length; a task that opens it makes for every coordinate the list of its rows sorted by that
coordinate of the vector at unit length.

A query looks for the best rows whose score lies in a window. For a vector of length `l` and a query
of length `q` the score `s` asks for a cosine of `s / (l q)` at least; with the bucket's longest
length, that bounds the angle to the query, and so from both sides each coordinate of a row that
can qualify. The query's focus coordinates, its largest, cut their sorted lists to these
feasible ranges, and the rows in all of them are candidates. Their scores are computed exactly.
A bucket that is too short for the window is left out whole.

How it is spread: a bucket is a row, a block of queries is a row, and a task takes pairs of them, so
neither side is held whole anywhere, nor broadcast. The longest bucket comes first; the scores found
there raise the lower ends of the windows for all other buckets, since only better or equal rows can
still count. The pruning decides about work only; every row is considered for every query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmart.llm.common import written

#: Rows of a bucket, queries of a block, and coordinates that a query looks at.
BUCKET, BLOCK, FOCUS = 4096, 256, 4
#: What meets under one key is a tile, of at most so many buckets and blocks. Up to TILES tiles a core,
#: a tile has one bucket, and blocks are dealt to several tiles from LEAST blocks on.
TOGETHER, BLOCKS, LEAST, TILES = 32, 64, 8, 4
SCALE = 256
#: For what rounding does to unit vectors.
SLACK = 1e-9
LOWEST, HIGHEST = -(2**62), 2**62
BUCKETS = (
    "bucket long, longest double, width int, ids array<long>, labels array<int>,"
    " vectors array<double>"
)
FOUND = "query long, tag long, id long, score long"


def vectors(rows: DataFrame) -> DataFrame:
    """(id, label, vector) of `rows` (vec_id, label, embedding): components scaled and rounded down.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part.
    """
    numbers = F.col("embedding").cast("array<double>")
    usable = F.forall(
        numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    kept = rows.filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(usable, F.lit(False))
    )
    return kept.select(
        F.col("vec_id").cast("long").alias("id"),
        F.col("label").cast("int").alias("label"),
        # As doubles, which hold whole numbers of up to 53 bits exactly.
        F.transform(numbers, lambda x: F.floor(x * SCALE).cast("double")).alias("vector"),
    )


def _unit(matrix: np.ndarray) -> np.ndarray:
    lengths = np.sqrt((matrix * matrix).sum(axis=1))
    return matrix / np.where(lengths > 0, lengths, 1)[:, None]


def buckets(rows: DataFrame, size: int = BUCKET) -> DataFrame:
    """Length buckets of `size` rows of (id, label, vector); `place` counts them from 0, the longest first.

    Dealt out by range of length and id, so that many rows of one length are many buckets. Vectors of
    unlike size count as filled up with zeros.
    """
    length = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    ordered = rows.withColumn("length", length).repartitionByRange(F.desc("length"), "id")
    ordered = ordered.sortWithinPartitions(F.desc("length"), "id").select("id", "label", "vector")

    def pack(batches) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        bucket = TaskContext.get().partitionId() << 32

        def packed(part):
            lists = part.column("vector")
            sizes = np.diff(lists.offsets.to_numpy())
            width = int(sizes.max())
            matrix = np.zeros((len(sizes), width))
            matrix[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy()
            longest = float(np.sqrt((matrix * matrix).sum(axis=1)).max())
            one = {
                "bucket": pa.array([bucket]),
                "longest": pa.array([longest]),
                "width": pa.array([width], pa.int32()),
                "ids": pa.array([part.column("id").to_numpy()], pa.list_(pa.int64())),
                "labels": pa.array([part.column("label").to_numpy()], pa.list_(pa.int32())),
                "vectors": pa.array([matrix.ravel()], pa.list_(pa.float64())),
            }
            return pa.RecordBatch.from_arrays(list(one.values()), list(one))

        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            while count >= size:
                table = pa.Table.from_batches(held).combine_chunks()
                yield packed(table.slice(0, size).combine_chunks().to_batches()[0])
                bucket += 1
                held, count = table.slice(size).to_batches(), count - size
        if count:
            yield packed(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    cells = written(ordered.mapInArrow(pack, BUCKETS), "lemp-buckets")
    # A row for each bucket, without what it holds.
    number = F.row_number().over(Window.orderBy(F.desc("longest"), "bucket")) - 1
    places = written(cells.select("bucket", number.cast("long").alias("place")), "lemp-places")
    return cells.join(places, "bucket")


def feasible(focus: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest value at a coordinate of the unit vectors whose cosine with a unit query is
    `least` or more, given the query's value there."""
    across = np.sqrt(np.maximum(0, 1 - focus * focus) * max(0.0, 1 - least * least))
    low = np.where(-focus >= least, -1.0, focus * least - across)
    high = np.where(focus >= least, 1.0, focus * least + across)
    return low - SLACK, high + SLACK


class Bucket:
    """A bucket as a task works on it."""

    def __init__(self, longest: float, width: int, ids, labels, numbers):
        self.longest, self.width, self.ids, self.labels = longest, width, ids, labels
        self.matrix = numbers.reshape(len(ids), width)
        unit = np.ascontiguousarray(_unit(self.matrix).T)
        self.lists = np.argsort(unit, axis=1, kind="stable")
        self.sorted = np.take_along_axis(unit, self.lists, axis=1)

    def candidates(self, query: np.ndarray, length: float, least: int) -> np.ndarray | None:
        """Places of all rows whose score may be `least` or more; None stands for all.

        `query` is what the query of that length has at the bucket's coordinates.
        """
        if least <= 0:
            return None
        reach = length * self.longest
        if least > reach * (1 + SLACK):
            return np.empty(0, np.int64)
        unit = query / length
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        low, high = feasible(unit[focus], min(1.0, least / reach))
        hits = np.zeros(len(self.ids), np.int8)
        for f, a, b in zip(focus, low, high):
            begin = np.searchsorted(self.sorted[f], a)
            end = np.searchsorted(self.sorted[f], b, "right")
            hits[self.lists[f][begin:end]] += 1
        return np.flatnonzero(hits == len(focus))

    def search(self, query: np.ndarray, own: int, label: int, windows, most: int) -> Iterator:
        """(tag, ids, scores) of the best `most` rows of each window."""
        length = float(np.sqrt(query @ query))
        known = np.zeros(self.width)
        known[: len(query)] = query[: self.width]  # beyond the bucket's width are zeros
        places = self.candidates(known, length, min(low for _, low, _, _ in windows))
        matrix, ids, labels = self.matrix, self.ids, self.labels
        if places is not None:
            matrix, ids, labels = matrix[places], ids[places], labels[places]
        scores = (matrix @ known).astype(np.int64)
        same, other = labels == label, ids != own
        for tag, low, high, wanted in windows:
            fits = np.flatnonzero((scores >= low) & (scores <= high) & (same == wanted) & other)
            if len(fits) > most:
                # Ties with the last of the best stay in.
                last = np.partition(scores[fits], -most)[-most]
                fits = fits[scores[fits] >= last]
            best = fits[np.lexsort((ids[fits], -scores[fits]))[:most]]
            if len(best):
                yield tag, ids[best], scores[best]


def _search(pairs: DataFrame, most: int) -> DataFrame:
    """The best `most` rows of each bucket for each window of each query of the block beside it."""
    parts = ("ids", "labels", "vectors")

    def run(batches) -> Iterator:
        import pyarrow as pa

        open_place, bucket = None, None
        for batch in batches:
            for row in batch.to_struct_array() if batch.num_rows else ():
                # The join gives a bucket's blocks one after the other.
                if row["place"].as_py() != open_place:
                    flat = [row[name].values.to_numpy(zero_copy_only=False) for name in parts]
                    bucket = Bucket(row["longest"].as_py(), row["width"].as_py(), *flat)
                    open_place = row["place"].as_py()
                found: list[tuple] = []
                for query in row["queries"].values:
                    vector = query["vector"].values.to_numpy(zero_copy_only=False)
                    own, label = query["id"].as_py(), query["label"].as_py()
                    windows = [tuple(w.values()) for w in query["windows"].as_py()]
                    for tag, ids, scores in bucket.search(vector, own, label, windows, most):
                        found.append((np.full(len(ids), own), np.full(len(ids), tag), ids, scores))
                if found:
                    columns = [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*found)]
                    yield pa.RecordBatch.from_arrays(columns, ["query", "tag", "id", "score"])

    names = ["place", "longest", "width", *parts, "queries"]
    return pairs.select(*names).mapInArrow(run, FOUND)


def _against(cells: DataFrame, first: int, last: int, queries: DataFrame, most: int) -> DataFrame:
    """Each of the written `queries` against each bucket from `first` to `last`, in blocks.

    Blocks are copied to tiles of neighbouring buckets, which are far larger; a bucket is copied only
    where very many blocks would meet in its task. The copies of the blocks outgrow the file of queries
    by the number of tiles, which the optimizer does not see, so it is told not to broadcast them.
    """
    blocks, number = max(1, -(-queries.count() // BLOCK)), last - first + 1
    tiles = TILES * queries.sparkSession.sparkContext.defaultParallelism
    copies = max(-(-blocks // BLOCKS), min(-(-blocks // LEAST), tiles // number))
    together = max(1, min(TOGETHER, number * copies // tiles))
    packed = queries.groupBy(
        F.pmod(F.monotonically_increasing_id(), F.lit(blocks)).alias("block")
    ).agg(F.collect_list(F.struct("id", "label", "vector", "windows")).alias("queries"))
    packed = packed.select(
        F.explode(
            F.sequence(F.lit(first // together).cast("long"), F.lit(last // together).cast("long"))
        ).alias("tile"),
        F.pmod("block", F.lit(copies)).cast("long").alias("copy"),
        "queries",
    )
    copied = (
        cells.filter(F.col("place").between(first, last))
        .withColumn("tile", F.floor(F.col("place") / together))
        .withColumn(
            "copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long")))
        )
    )
    return _search(copied.join(packed.hint("merge"), ["tile", "copy"]), most)


def _best(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("query", "tag").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def best_in_windows(cells: DataFrame, queries: DataFrame, most: int) -> DataFrame:
    """(query, tag, id, score, rank): for each window of `queries` (id, label, vector, windows) its
    best `most` rows, higher scores first, ties by smaller id; all, if there are fewer.

    A window (tag, low, high, same) takes the rows whose score is from `low` to `high` and whose label
    is, or is not, the query's. A row is no answer to itself. Ids are those of one query and one row.
    """
    number = cells.select("place").count()
    if not number:
        return _best(queries.sparkSession.createDataFrame([], FOUND), most)
    queries = written(queries, "lemp-queries")
    early = written(_against(cells, 0, 0, queries, most), "lemp-first")
    if number == 1:
        return _best(early, most)
    # A window that is full already: only what scores as high as its last can still count.
    reached = (
        early.groupBy("query", "tag")
        .agg(F.min("score").alias("last"), F.count("*").alias("n"))
        .filter(F.col("n") >= most)
        .groupBy("query")
        .agg(F.map_from_entries(F.collect_list(F.struct("tag", "last"))).alias("reached"))
    )

    def raised(w: Column) -> Column:
        return w.withField(
            "low", F.greatest(w["low"], F.try_element_at("reached", w["tag"]))
        )

    # As the joins of `mine`, by shuffles whatever the sizes: what grows with the queries would go through
    # the driver in a broadcast, and files of ids are far smaller than their rows.
    later = queries.join(reached.hint("merge"), F.col("id") == F.col("query"), "left").select(
        "id", "label", "vector", F.transform("windows", raised).alias("windows")
    )
    rest = _against(cells, 1, number - 1, written(later, "lemp-raised"), most)
    return _best(early.union(rest), most)


def mine(
    rows: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 3,
    least: int = 50,
    largest: int = 95,
    bucket: int = BUCKET,
) -> DataFrame:
    """Hard negatives of the rows for which `anchors` is true, from (id, label, vector) with integer
    components: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    An anchor's positives are the best `positives` other rows of its label. For each, the best
    `negatives` rows of another label whose score is between `least` and `largest` percent of the
    positive's are its hard negatives, ranked from 1. Higher scores come first, ties by smaller id.
    Anchors without positives and positives without negatives have no rows, nor have positives of a
    negative score, between whose percentages there is nothing. Of rows with one id the smallest by
    label and vector counts. An empty table gives no rows. Vectors of unlike size count as filled up
    with zeros. Scores are exact below 2**53. Other columns are ignored.
    """
    if not 0 <= least <= largest:
        raise ValueError("least must be from 0 to largest")
    one = rows.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("x"))
    rows = written(one.select("id", "x.*"), "lemp-rows")
    cells = buckets(rows, bucket)
    asked = rows.filter(anchors)

    def windows(tag: str, low: str, high: str, same: bool) -> Column:
        names = ("tag", "low", "high")
        bounds = [F.expr(f"cast({x} as bigint)").alias(n) for n, x in zip(names, (tag, low, high))]
        return F.struct(*bounds, F.lit(same).alias("same"))

    whole = F.array(windows("0", str(LOWEST), str(HIGHEST), True)).alias("windows")
    found = best_in_windows(cells, asked.select("*", whole), positives)
    chosen = written(
        found.select(
            F.col("query").alias("anchor_id"),
            F.col("id").alias("positive_id"),
            F.col("score").alias("positive_score"),
        ),
        "lemp-positives",
    )
    # Positives of one score share a window, whose tag is that score.
    window = windows(
        "positive_score",
        f"(positive_score * {least} + 99) div 100",
        f"positive_score * {largest} div 100",
        False,
    )
    asking = (
        chosen.filter("positive_score >= 0")
        .select(F.col("anchor_id").alias("id"), "positive_score")
        .distinct()
        .groupBy("id")
        .agg(F.collect_list(window).alias("windows"))
    )
    hard = best_in_windows(cells, asked.join(asking.hint("merge"), "id"), negatives).select(
        F.col("query").alias("anchor_id"),
        F.col("tag").alias("positive_score"),
        "rank",
        F.col("id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    return chosen.hint("merge").join(hard, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
