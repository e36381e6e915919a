"""Token-ID files: flat unsigned integers plus 64-bit document offsets, memory-mapped.

A corpus is a folder of shards. Shard `k` holds documents in ascending order, all of them before
those of shard `k + 1`:

* `k.ids`      the token ids of all its documents in a row, little-endian unsigned integers of
               16 bits where the vocabulary fits them, else of 32
* `k.offsets`  unsigned 64-bit numbers: where each document starts in `k.ids`, then its length
* `k.docs`     signed 64-bit document ids (a null id is the smallest such number)

The manifest holds each shard's base, the prefix sum of the lengths of the shards before it. A
document's place in the whole corpus is its shard's base plus its offset.

The folder has to be one that tasks reach as a path (local disk in tests, a shared mount on a
cluster) or by `pyarrow.fs`; only the former is memory-mapped.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillmart.llm.common import (
    give_back,
    ranges,
    scratch_folder,
    text_slices,
    written,
)

NULL_ID = -(2**63)
INDEX = "shard long, doc_id long, n_tokens long"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"
#: Bytes of text that are encoded together.
TOGETHER = 2**24
#: Chunks that are encoded as one text.
RUN = 2**10
#: Bytes of distinct pieces, with their places, that a worker remembers the ids of.
REMEMBERED = 2**24
#: How byte-level models write a space.
BYTE_SPACE = "Ġ"


class TokenFiles(NamedTuple):
    folder: str
    manifest: DataFrame  # shard, n_docs, n_tokens, base
    bits: int


def _joined(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes


# Kinds of bytes. UNSURE are those of other scripts and of white space outside ASCII.
UNSURE, LETTER, DIGIT, MARK, APOSTROPHE, BLANK, SPACE = range(7)
VISIBLE = (LETTER, DIGIT, MARK, APOSTROPHE)
# What a pair of kinds says of the place between: a piece begins, or does so if its neighbours allow it.
BEGINS, BLANK_BEGINS, IN_BLANKS, BEHIND_UNSURE = 1, 2, 3, 4


def _kinds() -> bytes:
    kinds = np.full(256, MARK, np.uint8)
    kinds[128:] = UNSURE
    kinds[28:32] = UNSURE  # white space to some
    kinds[9:14], kinds[ord(" ")], kinds[ord("'")] = BLANK, SPACE, APOSTROPHE
    kinds[ord("0") : ord("9") + 1] = DIGIT
    kinds[ord("A") : ord("Z") + 1] = kinds[ord("a") : ord("z") + 1] = LETTER
    return kinds.tobytes()


def _pairs(fine: bool) -> bytes:
    """By `8 * kind + next kind`."""
    pairs = np.zeros((32, 8), np.uint8)
    pairs[VISIBLE, SPACE] = BEGINS
    pairs[[BLANK, SPACE], SPACE] = IN_BLANKS
    pairs[UNSURE, SPACE] = BEHIND_UNSURE
    if fine:
        pairs[VISIBLE, BLANK] = BLANK_BEGINS
        for kind in (LETTER, DIGIT, MARK):
            others = [other for other in (LETTER, DIGIT, MARK) if other != kind]
            pairs[kind, others] = BEGINS
        # What follows an apostrophe may belong to it, as in "it's".
        pairs[[LETTER, DIGIT], APOSTROPHE] = BEGINS
    return pairs.tobytes()


KINDS = _kinds()


def piece_bounds(data: np.ndarray, offsets: np.ndarray, pairs: bytes) -> np.ndarray:
    """Where pieces begin in UTF-8 texts, which begin at `offsets`, and the end; of `pairs` see `_pairs`.

    Within a text, a piece begins only where a token does, and the tokens before are those that the text
    would have if it ended there.
    """
    kinds = np.frombuffer(bytearray(data).translate(KINDS), np.uint8)
    # U+00C0 to U+023F, but for the signs of multiplication and division.
    leads = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xC8))
    behind = data[leads + 1]
    leads = leads[(data[leads] != 0xC3) | ((behind != 0x97) & (behind != 0xB7))]
    kinds[leads] = kinds[leads + 1] = LETTER
    says = np.frombuffer(((kinds[:-1] << 3) | kinds[1:]).tobytes().translate(pairs), np.uint8)
    begins = np.zeros(len(data), bool)
    begins[1:] = (says == BEGINS) | (says == BLANK_BEGINS)
    begins[offsets[offsets < len(data)]] = True

    def before_visible(at: np.ndarray) -> np.ndarray:
        """Those of `at` behind which a visible character of the same text stands."""
        at = at[at + 1 < len(data)]
        found = kinds[at + 1]
        # So far, pieces begin behind blanks and spaces only where texts do.
        return at[(found >= LETTER) & (found <= APOSTROPHE) & ~begins[at + 1]]

    blanks = before_visible(np.flatnonzero(says == BLANK_BEGINS) + 1)
    spaces = before_visible(np.flatnonzero(says == IN_BLANKS) + 1)
    # One blank between visible characters is a token.
    begins[blanks + 1] = True
    # Of a run of white space, the last space goes with the visible character behind it.
    begins[spaces] = True
    # Else there is white space before the space: U+0085, 00A0, 1680, 180E, 2000 to 207F, 3000 to 303F.
    spaces = np.flatnonzero(says == BEHIND_UNSURE) + 1
    one, two, three = (data[np.maximum(spaces - k, 0)] for k in (1, 2, 3))
    maybe_blank = (one < 0x80) | ((two == 0xC2) & ((one == 0x85) | (one == 0xA0)))
    maybe_blank |= (three == 0xE1) & ((two == 0x9A) | (two == 0xA0))
    maybe_blank |= (three == 0xE2) & ((two == 0x80) | (two == 0x81))
    maybe_blank |= (three == 0xE3) & (two == 0x80)
    begins[spaces[~maybe_blank]] = True
    return np.append(np.flatnonzero(begins), len(data))


class ChunkEncoder:
    """Encodes whole texts, each distinct piece once as long as a table of bounded size remembers it.

    A byte-level pre-tokenizer never joins what stands before a space to that space, unless the
    space lies within a run of white space. So " word" can be encoded by itself. With the usual
    expression of the library's `ByteLevel`, letters, digits, other visible characters and white space are
    never joined either, but for a space before and what follows an apostrophe. Texts that contain the string
    of an added token are encoded whole. Strings of special tokens are ordinary text if `plain` is set,
    else they give the special token's id, as the library does by itself.
    """

    def __init__(self, path: str, plain: bool = True, most: int = REMEMBERED):
        import re

        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        split = self.tokenizer.pre_tokenizer
        self.pairs = _pairs(
            self.tokenizer.normalizer is None
            and isinstance(split, pre_tokenizers.ByteLevel)
            and split.use_regex
            and not split.add_prefix_space
        )
        self.behind_space = re.compile(r" [^\s][^ ]*", re.DOTALL)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [token.content for token in added if token.content]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.after_space = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        for token, i in vocabulary.items():
            self.after_space[i] = token[:1] == BYTE_SPACE
        self.most = most
        self.forget()

    def forget(self) -> None:
        """Empty the table: pieces, their ids in a row, where each one's begin there and how many they are."""
        import pyarrow as pa

        self.pieces = pa.array([], pa.large_string())
        self.flat = np.empty(0, np.uint32)
        self.begins = self.sizes = np.empty(0, np.int64)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each has."""
        ids = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return _joined(ids)

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of pieces in a row, where each one's begin there and how many they are.

        Pieces of a space and what stands behind it are encoded as runs of text; a token that begins with a
        space begins one. The others are encoded apart.
        """
        in_run = np.fromiter(map(bool, map(self.behind_space.fullmatch, pieces)), bool, len(pieces))
        behind = list(compress(pieces, in_run.tolist()))
        runs = ["".join(behind[a : a + RUN]) for a in range(0, len(behind), RUN)]
        flat, _ = self._encode(runs)
        run_begins = np.flatnonzero(self.after_space[flat])
        if len(run_begins) != len(behind):
            raise RuntimeError("this tokenizer joins words or drops the space before them")
        apart, apart_sizes = self._encode(list(compress(pieces, (~in_run).tolist())))
        begins, sizes = np.empty(len(pieces), np.int64), np.empty(len(pieces), np.int64)
        begins[in_run], sizes[in_run] = run_begins, np.diff(np.append(run_begins, len(flat)))
        begins[~in_run] = len(flat) + np.cumsum(apart_sizes) - apart_sizes
        sizes[~in_run] = apart_sizes
        return np.concatenate([flat, apart]), begins, sizes

    def _remember(self, pieces) -> np.ndarray:
        """The places in the table of distinct pieces, an Arrow array; new ones are encoded and added.

        A table that would grow beyond `most` bytes of pieces keeps those of `pieces` alone, and nothing
        once their ids are taken if these are too many by themselves.
        """
        import pyarrow as pa
        import pyarrow.compute as pc

        places = pc.index_in(pieces, value_set=self.pieces)
        new = pieces.filter(places.is_null())
        if self.pieces.nbytes + new.nbytes > self.most:
            kept = places.drop_null().to_numpy()
            self.pieces, sizes = self.pieces.take(pa.array(kept)), self.sizes[kept]
            self.flat = self.flat[ranges(self.begins[kept], sizes)]
            self.begins, self.sizes = np.cumsum(sizes) - sizes, sizes
            places = pc.index_in(pieces, value_set=self.pieces)
        if len(new):
            flat, begins, sizes = self._encode_pieces(new.to_numpy(zero_copy_only=False).tolist())
            before = len(self.pieces)
            self.pieces = pa.concat_arrays([self.pieces, new])
            self.begins = np.concatenate([self.begins, len(self.flat) + begins])
            self.flat = np.concatenate([self.flat, flat])
            self.sizes = np.concatenate([self.sizes, sizes])
            found = places.is_valid().to_numpy(zero_copy_only=False)
            places = places.fill_null(0).to_numpy().astype(np.int64)
            places[~found] = np.arange(before, before + len(new))
            return places
        return places.to_numpy()

    def encode(self, texts, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, a list or an Arrow array, in a row, `end_id` after each (null: empty), and
        where each text's ids begin."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = np.zeros(len(texts), bool)
        for token in self.added:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        split = pc.if_else(pa.array(~whole), texts, "") if whole.any() else texts
        _, offsets, data = split.buffers()
        offsets = np.frombuffer(offsets, np.int64)[split.offset : split.offset + len(split) + 1]
        data = np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        bounds = piece_bounds(data, offsets, self.pairs)
        pieces = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(data))
        encoded = pieces.dictionary_encode()
        index = self._remember(encoded.dictionary)[encoded.indices.to_numpy()]
        sizes = self.sizes[index]
        body = self.flat[ranges(self.begins[index], sizes)]
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(bounds, offsets)]
        if self.pieces.nbytes > self.most:
            self.forget()
        if whole.any():
            at = np.flatnonzero(whole)
            apart, apart_sizes = self._encode(texts.take(pa.array(at)).to_pylist())
            per_text = [body[a:b] for a, b in zip(ends, ends[1:])]
            for i, ids in zip(at.tolist(), np.split(apart, np.cumsum(apart_sizes)[:-1])):
                per_text[i] = ids
            body = np.concatenate(per_text)
            ends = np.cumsum([0] + [len(x) for x in per_text])
        # One more place after each text, for its end.
        starts = ends + np.arange(len(ends))
        ids = np.full(int(starts[-1]), end_id, np.uint32)
        ids[ranges(starts[:-1], np.diff(ends))] = body
        return ids, starts


@lru_cache(maxsize=1)
def _chunk_encoder(path: str, plain: bool) -> ChunkEncoder:
    """One for each Python worker; loading the vocabulary takes a while."""
    return ChunkEncoder(path, plain)


@lru_cache(maxsize=1)
def _own_encoder(path: str, plain: bool, folder: str) -> ChunkEncoder:
    """Its table serves all tasks that write to the folder, but no later run."""
    encoder = _chunk_encoder(path, plain)
    encoder.forget()
    return encoder


def _filesystem(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (
        fs.LocalFileSystem(),
        folder,
    )


def _writer(folder: str, tokenizer: str, end_id: int, bits: int, text: str, plain: bool):
    kind = np.dtype(f"<u{bits // 8}")

    def write(batches) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        system, path = _filesystem(folder)
        task = TaskContext.get()
        shard = task.partitionId()
        names = {x: f"{path}/{shard:06d}.{x}" for x in ("ids", "offsets", "docs")}
        drafts = {x: f"{name}.{task.taskAttemptId()}" for x, name in names.items()}
        files, encoder, total = {}, None, 0
        for batch in batches:
            for rows in text_slices(batch, batch.schema.get_field_index(text), TOGETHER):
                if encoder is None:
                    encoder = _own_encoder(tokenizer, plain, folder)
                    system.create_dir(path, recursive=True)
                    files = {x: system.open_output_stream(name) for x, name in drafts.items()}
                ids, starts = encoder.encode(rows.column(text), end_id)
                docs = rows.column("doc_id").fill_null(NULL_ID).cast(pa.int64())
                files["ids"].write(ids.astype(kind).tobytes())
                files["offsets"].write((total + starts[:-1]).astype("<u8").tobytes())
                files["docs"].write(docs.to_numpy().astype("<i8").tobytes())
                total += int(starts[-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(rows.num_rows, shard)),
                        rows.column("doc_id").cast(pa.int64()),
                        pa.array(np.diff(starts)),
                    ],
                    ["shard", "doc_id", "n_tokens"],
                )
                give_back()
        if files:
            files["offsets"].write(np.array([total], "<u8").tobytes())
        for x, file in files.items():
            file.close()
            system.move(drafts[x], names[x])  # all attempts write the same

    return write


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    folder: str | None = None,
    end_id: int = 0,
    text: str = "text",
    plain: bool = True,
) -> TokenFiles:
    """Encode `text` of every row and write it in ascending `doc_id` order.

    `tokenizer` is a file of the tokenizers library with byte-level pre-tokenization. Rows with the
    same `doc_id` are ordered by their text and all kept; null ids come first; a null text is
    empty and still gets its end id. An empty table gives no shards. Other columns are ignored.
    Strings of special tokens are ordinary text, unless `plain` is false.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    folder = folder or scratch_folder(spark, "token-files")
    bits = 16 if Tokenizer.from_file(tokenizer).get_vocab_size() <= 2**16 else 32
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions(
        "doc_id", F.xxhash64("text"), "text"
    )
    index = written(
        ordered.mapInArrow(_writer(folder, tokenizer, end_id, bits, "text", plain), INDEX), "token-index"
    )
    shards = index.groupBy("shard").agg(
        F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")
    )
    # One row for each shard, whatever the number of documents.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base")
    manifest = written(shards.select("*", base), "token-manifest")
    return TokenFiles(folder, manifest, bits)


def _reader(folder: str, bits: int):
    kind = np.dtype(f"<u{bits // 8}")

    def array(system, path: str, dtype) -> np.ndarray:
        from pyarrow import fs

        if isinstance(system, fs.LocalFileSystem):
            return np.memmap(path, dtype, "r")
        with system.open_input_file(path) as file:
            return np.frombuffer(file.read(), dtype)

    def read(batches) -> Iterator:
        import pandas as pd

        system, path = _filesystem(folder)
        for batch in batches:
            for shard, base in zip(batch["shard"], batch["base"]):
                name = f"{path}/{shard:06d}"
                ids = array(system, f"{name}.ids", kind)
                offsets = array(system, f"{name}.offsets", "<u8").astype(np.int64)
                docs = array(system, f"{name}.docs", "<i8")
                for a in range(0, len(docs), 10_000):
                    cut = offsets[a : a + 10_001]
                    sums = [
                        zlib.crc32(ids[x:y].astype("<u4").tobytes()) for x, y in zip(cut, cut[1:])
                    ]
                    own = pd.Series(docs[a : a + 10_000].tolist(), dtype="Int64")
                    yield pd.DataFrame(
                        {
                            "doc_id": own.mask(own == NULL_ID),
                            "start": base + cut[:-1],
                            "n_tokens": np.diff(cut),
                            "ids_crc32": sums,
                        }
                    )

    return read


def read_token_files(files: TokenFiles) -> DataFrame:
    """Per document: its id, place, length and the checksum of its ids as 32-bit integers."""
    shards = files.manifest.select("shard", "base")
    # With their number, as adaptive execution would join so few small rows in one task.
    shards = shards.repartitionByRange(max(1, shards.count()), "shard")
    return shards.mapInPandas(_reader(files.folder, files.bits), READ)
