"""SentencePiece encoding and decoding: an Aho-Corasick automaton and a single-pass Viterbi.

The automaton runs over a text once and names, at each position, every piece that ends there (its
state and, by the output links, all shorter ones); each relaxes the best score at that position.
A character that no piece covers is written as its bytes.

Scores: a unigram vocabulary's own. The pieces of a merge vocabulary carry merge ranks, which are
no log probabilities; there the score is that of Zipf's law, `-log(rank * (1 + 1/2 + ... + 1/n))`.

A space is written as U+2581, and one is put before a text that is not empty. A U+2581 of the text
itself is written as bytes, so decoding gives back every text exactly. As no piece goes on from
another character into a U+2581, best paths can be found piecewise between spaces, and each distinct
word is encoded once as long as a table of bounded size remembers it.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from tillmart.llm.common import WordTable, give_back, text_slices, trim

SPACE = "▁"
#: Stands for a U+2581 of the text where pieces are looked up; no text has half a surrogate pair.
NO_SPACE = "\ud800"
#: How much worse a byte is than the last piece.
BYTE_PENALTY = 10.0
#: Bytes of text that are encoded together.
TOGETHER = 2**20
CHUNK = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class PieceModel:
    """Pieces, scores and automaton of a vocabulary file; for tests also from a list."""

    def __init__(self, pieces: list[tuple[str, float]], byte_ids: dict[int, int]):
        import ahocorasick

        self.scores = {i: score for i, (piece, score) in enumerate(pieces) if piece}
        self.byte_ids = byte_ids
        self.byte_score = min(self.scores.values(), default=0.0) - BYTE_PENALTY
        self.words_apart = not any(SPACE in piece.lstrip(SPACE) for piece, _ in pieces)
        self.bytes = [piece.replace(SPACE, " ").encode() for piece, _ in pieces]
        for value, i in byte_ids.items():
            self.bytes[i] = bytes([value])
        self.automaton = ahocorasick.Automaton()
        for i, (piece, score) in enumerate(pieces):
            if piece and piece not in self.automaton:
                self.automaton.add_word(piece, (len(piece), i, score))
        self.automaton.make_automaton()
        self.single = {piece for piece, _ in pieces if len(piece) == 1}
        self.table = WordTable(self.encode_words)

    @classmethod
    def load(cls, path: str) -> PieceModel:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(processor.get_piece_size())
        byte_ids = {int(processor.id_to_piece(i)[3:5], 16): i for i in ids if processor.is_byte(i)}
        usable = [
            not (processor.is_byte(i) or processor.is_control(i) or processor.is_unknown(i))
            for i in ids
        ]
        scores = [processor.get_score(i) for i in ids]
        ranked = [i for i in ids if usable[i] and scores[i] > -1e8]
        merges = all(scores[i] == int(scores[i]) for i in ranked)
        if merges:
            total = math.log(sum(1 / r for r in range(1, len(ranked) + 1)))
            order = sorted(ranked, key=lambda i: -scores[i])
            zipf = {i: -math.log(r) - total for r, i in enumerate(order, 1)}
            # Runs of blanks have no rank; they count as the last.
            scores = [zipf.get(i, -math.log(len(ranked)) - total) for i in ids]
        pieces = [(processor.id_to_piece(i) if usable[i] else "", scores[i]) for i in ids]
        return cls(pieces, byte_ids)

    def viterbi(self, text: str) -> list[int]:
        """Ids of the best path; `text` has spaces as U+2581 and its own U+2581 as `NO_SPACE`.

        Of equally good paths, the one with the shorter last piece.
        """
        size = len(text)
        best = [0.0] + [-math.inf] * size
        came: list[tuple[int, int]] = [(0, -1)] * (size + 1)
        encoded = {}
        reached = 0
        for end, piece in self.automaton.iter(text):
            while reached < end:
                # All pieces that end before are known; a character without one becomes bytes.
                reached = self._settle(text, reached, best, came, encoded)
            length, i, score = piece
            start = end + 1 - length
            value = best[start] + score
            if value > best[end + 1] or value == best[end + 1] and start > came[end + 1][0]:
                best[end + 1], came[end + 1] = value, (start, i)
        while reached < size:
            reached = self._settle(text, reached, best, came, encoded)
        ids, at = [], size
        while at:
            start, i = came[at]
            ids += [i] if i >= 0 else reversed(encoded[start])
            at = start
        return ids[::-1]

    def _settle(self, text, at, best, came, encoded) -> int:
        """Fix the best path to the end of character `at`."""
        if text[at] not in self.single:
            raw = (SPACE if text[at] == NO_SPACE else text[at]).encode()
            encoded[at] = [self.byte_ids[b] for b in raw]
            value = best[at] + self.byte_score * len(raw)
            if value > best[at + 1]:
                best[at + 1], came[at + 1] = value, (at, -1)
        return at + 1

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and how many each has."""
        flat, lengths = array("i"), array("q")
        for word in words:
            ids = self.viterbi(word)
            flat.extend(ids)
            lengths.append(len(ids))
        return np.frombuffer(flat, np.int32), np.frombuffer(lengths, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row and where each begins, with the total at the end."""
        import pyarrow as pa
        import pyarrow.compute as pc

        marked = [
            (" " + text).replace(SPACE, NO_SPACE).replace(" ", SPACE) if text else ""
            for text in texts
        ]
        if not self.words_apart:
            ids, sizes = self.encode_words(marked)
            return ids, np.concatenate([[0], np.cumsum(sizes)])
        if any(SPACE * 2 in text or NO_SPACE in text for text in marked):
            words = [CHUNK.findall(text) for text in marked]
            places: dict[str, int] = {}
            order = [places.setdefault(w, len(places)) for ws in words for w in ws]
            begins = np.cumsum([0] + [len(ws) for ws in words])
            ids, sizes = self.table.joined(list(places), np.array(order, np.int64))
        else:
            # Each word with its one space; far faster than the general expression.
            split = pc.split_pattern(pa.array(marked, pa.large_string()), SPACE)
            del marked
            flat, begins = split.flatten().dictionary_encode(), split.offsets.to_numpy()
            index = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            distinct = [SPACE + word for word in flat.dictionary.to_pylist()]
            # What stands before a text's first space is nothing.
            ids, sizes = self.table.joined(distinct, index, begins[:-1])
        return ids, np.concatenate([[0], np.cumsum(sizes)])[begins]

    def decode(self, ids) -> str:
        """The text that was encoded; bytes that are no UTF-8 become U+FFFD."""
        table = self.bytes
        return b"".join([table[i] for i in ids])[1:].decode("utf-8", "replace")


@lru_cache(maxsize=2)
def model(path: str) -> PieceModel:
    return PieceModel.load(path)


def _mapped(df: DataFrame, column: str, into: str, kind, convert, texts: bool) -> DataFrame:
    from pyspark.sql import types as T

    kept = df.drop(into) if into != column else df
    names = kept.columns
    at = names.index(column)
    fields = list(kept.schema.fields)
    if into == column:
        fields[at] = T.StructField(into, kind)
    else:
        fields.append(T.StructField(into, kind))

    def run(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            slices = text_slices(batch, at, TOGETHER) if texts else [batch]
            for rows in slices:
                columns = list(rows.columns)
                new = convert(columns[at])
                if into == column:
                    columns[at] = new
                else:
                    columns.append(new)
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])
                give_back()
            trim()

    return kept.mapInArrow(run, T.StructType(fields))


def encode(docs: DataFrame, path: str, text: str = "text", into: str = "ids") -> DataFrame:
    """Add `into`: the piece ids of `text`. Null gives null, an empty text no ids; all rows and
    other columns stay."""
    from pyspark.sql import types as T

    def convert(column):
        import pyarrow as pa

        texts = column.to_pylist()
        ids, starts = model(path).encode([x or "" for x in texts])
        mask = pa.array([x is None for x in texts]) if column.null_count else None
        return pa.ListArray.from_arrays(
            pa.array(starts.astype(np.int32)), pa.array(ids, pa.int32()), mask=mask
        )

    return _mapped(docs, text, into, T.ArrayType(T.IntegerType()), convert, texts=True)


def decode(df: DataFrame, path: str, ids: str = "ids", into: str = "text") -> DataFrame:
    """Add `into`: the text whose piece ids are in `ids`; null gives null."""
    from pyspark.sql import types as T

    def convert(column):
        import pyarrow as pa

        own = model(path)
        flat = column.flatten().to_pylist()
        starts = np.cumsum([0] + [n for _, n in _lengths(column)]).tolist()
        return pa.array(
            [
                own.decode(flat[starts[i] : starts[i + 1]]) if valid else None
                for i, (valid, _) in enumerate(_lengths(column))
            ],
            pa.string(),
        )

    return _mapped(df, ids, into, T.StringType(), convert, texts=False)


def _lengths(column) -> list[tuple[bool, int]]:
    import pyarrow.compute as pc

    return [(n is not None, n or 0) for n in pc.list_value_length(column).to_pylist()]
