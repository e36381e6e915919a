"""Helpers the operators of this package share."""

from __future__ import annotations

import atexit
import contextlib
import itertools
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_NUMBERS = itertools.count()
_APPLICATIONS: set[str] = set()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A folder that driver and executors share and that no other run uses.

    It lies in `spark.checkpoint.dir`, else in the warehouse folder, one of which a cluster has to share.
    All of an application's are deleted as its driver exits, as lazy results read them until then.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    own = f"{root.rstrip('/')}/tillmart/{spark.sparkContext.applicationId}"
    if own not in _APPLICATIONS:
        _APPLICATIONS.add(own)
        path = spark._jvm.org.apache.hadoop.fs.Path(own)
        files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        atexit.register(_delete, files, path)
    return f"{own}/{name}-{next(_NUMBERS)}"


def _delete(files, path) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone before
        files.delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as a Parquet table in the shared scratch folder and return a reader of it.

    This cuts the lineage: a lost executor costs the reader one task, not the plan behind it.
    """
    folder = scratch_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def hash_strings(values) -> np.ndarray:
    """64-bit hashes of an Arrow string array; the same in every process."""
    import pandas as pd

    strings = values.to_numpy(zero_copy_only=False)
    return pd.util.hash_array(strings, categorize=False) if len(strings) else np.empty(0, np.uint64)


def mix(hashes: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scramble."""
    hashes = (hashes ^ (hashes >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    hashes = (hashes ^ (hashes >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return hashes ^ (hashes >> np.uint64(31))


def word_hashes(texts) -> tuple[np.ndarray, np.ndarray]:
    """Hash the white-space separated words of an Arrow string array, A-Z in lower case.

    Returns the hashes of all words in a row and, per text, where its words begin, with the
    total at the end. White space is space and the characters 9 to 13. Null: no words.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    words = lists.flatten().dictionary_encode()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    # Lower case only where it costs least; besides, Arrow gets it wrong for slices of an array.
    distinct = hash_strings(pc.ascii_lower(words.dictionary))
    hashes = distinct[words.indices.to_numpy(zero_copy_only=False)]
    # Leading and trailing white space gives empty words.
    empty = np.flatnonzero(hashes == _EMPTY)
    if len(empty):
        kept = hashes != _EMPTY
        offsets = np.concatenate([[0], np.cumsum(kept)])[offsets - offsets[0]]
        return hashes[kept], offsets
    return hashes, offsets - offsets[0]


def _empty_hash() -> np.uint64:
    import pyarrow as pa

    return hash_strings(pa.array([""]))[0]


_EMPTY = _empty_hash()


def shingle_hashes(texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct word shingles of each text, as sorted 64-bit hashes.

    A text of fewer than `size` words is one shingle, one without words has none. Returned like
    `word_hashes`.
    """
    words, starts = word_hashes(texts)
    counts = np.diff(starts)
    shingles, offsets = [], np.zeros(len(counts) + 1, np.int64)
    rolled = np.full(max(0, len(words) - size + 1), size, np.uint64)
    for k in range(size):
        rolled = mix(rolled ^ words[k : k + len(rolled)])
    for i, count in enumerate(counts.tolist()):
        if count >= size:
            own = np.unique(rolled[starts[i] : starts[i] + count - size + 1])
        elif count:
            whole = np.full(1, count, np.uint64)
            for word in words[starts[i] : starts[i + 1]]:
                whole = mix(whole ^ word)
            own = whole
        else:
            own = words[:0]
        shingles.append(own)
        offsets[i + 1] = offsets[i] + len(own)
    return (np.concatenate(shingles) if shingles else words[:0]), offsets


def text_slices(batch, at: int, most: int = 2**21) -> Iterator:
    """Slices of an Arrow batch whose texts in column `at` have at most so many bytes together, one
    row at least: few rows of long texts, many of short ones."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < batch.num_rows:
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


class WordTable:
    """What words are encoded to, each of them encoded once; emptied when it holds `most` words.

    `encode` gives the ids of a list of words in a row and how many each has.
    """

    def __init__(self, encode, most: int = 2**18):
        self.encode, self.most = encode, most
        self.places: dict[str, int] = {}
        self.flat = self.lengths = np.empty(0, np.int64)

    def joined(self, words: list[str], index: np.ndarray, sizes_at=None) -> tuple:
        """The ids of `words[i]` for each `i` of `index`, in a row, and how many each has.

        `words` are distinct. At the places `sizes_at` of `index` nothing is taken.
        """
        new = [word for word in words if word not in self.places]
        if len(self.places) + len(new) > self.most:
            self.places, new = {}, words
            self.flat = self.lengths = np.empty(0, np.int64)
        if new:
            flat, lengths = self.encode(new)
            first = len(self.places)
            self.places.update(zip(new, range(first, first + len(new))))
            self.flat = np.concatenate([self.flat.astype(flat.dtype), flat])
            self.lengths = np.concatenate([self.lengths, lengths])
        places = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))[index]
        sizes = self.lengths[places]
        if sizes_at is not None:
            sizes[sizes_at] = 0
        begins = (np.cumsum(self.lengths) - self.lengths)[places]
        return self.flat[ranges(begins, sizes)], sizes


def give_back() -> None:
    """Let the system have what Arrow keeps for later; the worker lives on, the task ends."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()


def trim() -> None:
    """As `give_back`, and what the C library keeps of freed arrays, where it can be asked to."""
    import ctypes

    give_back()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def small_batches(spark: SparkSession) -> None:
    """From now on, have Spark hand texts to Python some 4 MB at a time instead of 10,000 rows, however
    long. A batch is held several times, by Spark and by Python, and long-lived executors keep the room."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All of `start, start + 1, ...` of each length, in a row."""
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)


def code_points(column: str | Column) -> Column:
    return F.char_length(column).cast("long")
