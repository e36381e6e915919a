"""Token files and SentencePiece: exact round trips and brute force."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest
from helpers import AWKWARD, documents

from tillmart.llm import pieces, queries, token_files

P = pytest.importorskip("public_tokenizers")
BPE, SP = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def whole_encoder():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BPE)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_chunks_give_the_ids_of_whole_texts():
    rng, encode = random.Random(3), whole_encoder()
    alphabet = [" ", "  ", "   ", "\n", "\t", "a", "Bc", "'s", "12", ",", "é", " ", "😀", "_"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 12))) for _ in range(3000)]
    texts += [text or "" for _, text in AWKWARD]
    ids, starts = token_files.ChunkEncoder(BPE).encode(texts, 0)
    for i, text in enumerate(texts):
        assert ids[starts[i] : starts[i + 1]].tolist() == [*encode(text), 0], repr(text)


def test_chunks_that_stand_together_in_a_run_stay_apart():
    """Pieces that end or begin with white space, or are empty, behind each other in any order."""
    encode, encoder = whole_encoder(), token_files.ChunkEncoder(BPE)
    for seed in range(200):
        rng = random.Random(seed)
        pieces_ = ["", "a", "\n", "b\n", "\nc", "\u00a0d", "e\t", "'s", "1", "\x1c", ".", "\u3000"]
        texts = [" ".join(rng.choices(pieces_, k=rng.randint(1, 5))) for _ in range(rng.randint(1, 30))]
        ids, starts = encoder.encode(texts, 0)
        for i, text in enumerate(texts):
            assert ids[starts[i] : starts[i + 1]].tolist() == [*encode(text), 0], repr(text)


def test_the_query_gives_the_ids_of_the_library_call(spark, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BPE)
    end = "<|endoftext|>"
    texts = [end, f"a {end} b", f"a{end}{end}  b ", f"some words {end[:-1]} {end[1:]}", "plain words", None]
    documents(spark, list(enumerate(texts))).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in queries.op1_token_files(spark, str(tmp_path)).collect()}
    start = 0
    for i, text in enumerate(texts):
        own = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        crc = zlib.crc32(np.array(own, "<u4").tobytes())
        assert (found[i].start, found[i].n_tokens, found[i].ids_crc32) == (start, len(own), crc)
        start += len(own)
    assert found[0].n_tokens == 2


SCRIPTS = [" ", " ", "  ", "\n", "\t", "\r\n", "a", "Bc", "'", "'s", "'re", "12", ",", ".!", "\u00e9", "\u00d7"]
SCRIPTS += ["\u00f7", "\u023f", "\u0436", "\u754c", "\u0661", "\u00b2", "\u2014", "\u2026", "\U0001f600"]
SCRIPTS += ["\u0301", "_", "\0", "\x1c", "\x7f", "\x85", "\u00a0", "\u1680", "\u180e", "\u2003", "\u200b"]
SCRIPTS += ["\u2028", "\u202f", "\u205f", "\u3000", "\ufeff"]


def some_texts(rng, n):
    return ["".join(rng.choices(SCRIPTS, k=rng.randint(0, 9))) for _ in range(n)]


def test_pieces_split_into_the_tokens_to_be_of_whole_texts():
    """Before any merge, and whatever texts stand beside one another."""
    encoder, rng = token_files.ChunkEncoder(BPE), random.Random(5)
    split = encoder.tokenizer.pre_tokenizer.pre_tokenize_str
    for _ in range(50):
        texts = some_texts(rng, 200)
        encoded = [text.encode() for text in texts]
        data = b"".join(encoded)
        offsets = np.cumsum([0, *map(len, encoded)])
        bounds = token_files.piece_bounds(np.frombuffer(data, np.uint8), offsets, encoder.pairs).tolist()
        pieces_ = {a: data[a:b].decode() for a, b in zip(bounds, bounds[1:])}
        for text, a, b in zip(texts, offsets.tolist(), offsets[1:].tolist()):
            own = [pieces_[x] for x in range(a, b) if x in pieces_]
            assert "".join(own) == text
            assert [t for p in own for t, _ in split(p)] == [t for t, _ in split(text)], own


def test_pieces_give_the_ids_of_whole_texts_in_all_scripts():
    """Also across texts of one call, and across calls with a table too small for all pieces."""
    encode, rng = whole_encoder(), random.Random(11)
    for most in (0, 300, 2**24):
        encoder = token_files.ChunkEncoder(BPE, most=most)
        for _ in range(30):
            texts = some_texts(rng, 200)
            ids, starts = encoder.encode(texts, 0)
            for i, text in enumerate(texts):
                assert ids[starts[i] : starts[i + 1]].tolist() == [*encode(text), 0], repr(text)


@pytest.mark.parametrize("how", ["whole", "prefix", "lower", "joined"])
def test_tokenizers_that_split_in_other_places_give_the_ids_of_whole_texts(tmp_path, how):
    from tokenizers import Regex, Tokenizer, normalizers, pre_tokenizers

    tokenizer = Tokenizer.from_file(BPE)
    if how == "lower":
        tokenizer.normalizer = normalizers.Lowercase()
    else:  # a mark goes with the word behind it, line ends with the mark before them
        expression = Regex(r"[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s+(?!\S)|\s+")
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=how == "prefix", use_regex=how == "prefix")
        split = pre_tokenizers.Split(expression, "isolated")
        tokenizer.pre_tokenizer = {
            "whole": pre_tokenizers.Sequence([pre_tokenizers.Split(" ", "merged_with_next"), byte_level]),
            "prefix": byte_level,
            "joined": pre_tokenizers.Sequence([split, byte_level]),
        }[how]
    tokenizer.save(f"{tmp_path}/tokenizer.json")
    encoder, rng = token_files.ChunkEncoder(f"{tmp_path}/tokenizer.json"), random.Random(7)
    alphabet = [" ", " ", "\n", "a", "The", "'s", "12", ",", "!\n", "é", "(", "#"]
    texts = ["The,the".join(rng.choices(alphabet, k=rng.randint(0, 9))) for _ in range(500)]
    ids, starts = encoder.encode(texts, 0)
    for i, text in enumerate(texts):
        own = tokenizer.encode(text, add_special_tokens=False).ids
        assert ids[starts[i] : starts[i + 1]].tolist() == [*own, 0], repr(text)


def test_words_are_encoded_once_whatever_stands_beside_them_and_over_all_calls(monkeypatch):
    encoder, seen = token_files.ChunkEncoder(BPE), []
    encode = encoder._encode
    monkeypatch.setattr(encoder, "_encode", lambda texts: (seen.extend(texts), encode(texts))[1])
    words = [f"w{a}{b}" for a in "abcdefghij" for b in "abcdefghij"]
    for mark in (",", ".", "!!", ";\n", ")"):
        encoder.encode(["".join(f" {word}{mark}" for word in words)] * 3, 0)
    once = sum(len(word) + 1 for word in words)
    assert once <= sum(map(len, seen)) < 1.1 * once


def test_the_table_of_pieces_is_bounded_and_starts_empty_for_each_run():
    encoder = token_files.ChunkEncoder(BPE, most=2**12)
    for i in range(50):
        encoder.encode([" ".join(f"{chr(97 + i % 26)}{a}{b}" for a in "xyz" for b in "klmnop")], 0)
        assert encoder.pieces.nbytes <= 2**12
        assert len(encoder.pieces) == len(encoder.begins) == len(encoder.sizes)
        assert len(encoder.flat) == encoder.sizes.sum()
    ids, starts = encoder.encode([" ".join(map(str, range(2000)))], 0)
    assert ids.tolist() == [*whole_encoder()(" ".join(map(str, range(2000)))), 0]
    assert not len(encoder.pieces) and not len(encoder.flat)
    own = token_files._own_encoder(BPE, True, "a")
    own.encode(["some words"], 0)
    assert len(own.pieces) and token_files._own_encoder(BPE, True, "a") is own
    assert not len(token_files._own_encoder(BPE, True, "b").pieces)


def test_arrow_slices_with_nulls_give_the_ids_of_their_own_texts():
    import pyarrow as pa

    texts = ["a b.", None, "", "é <|endoftext|>", "c  d\n", None, "e"]
    encode, encoder = whole_encoder(), token_files.ChunkEncoder(BPE)
    for kind in (pa.string(), pa.large_string()):
        for a in range(len(texts) + 1):
            for b in range(a, len(texts) + 1):
                ids, starts = encoder.encode(pa.array(texts, kind).slice(a, b - a), 0)
                assert ids.tolist() == [i for text in texts[a:b] for i in [*encode(text or ""), 0]]
                assert len(starts) == b - a + 1 and starts[-1] == len(ids)


def test_files_hold_every_row_in_order(spark, tmp_path):
    files = token_files.write_token_files(documents(spark), BPE, str(tmp_path / "ids"))
    found = token_files.read_token_files(files).collect()
    encode, start, expected = whole_encoder(), 0, []
    rows = sorted(AWKWARD, key=lambda r: -1 if r[0] is None else r[0])
    assert [r.doc_id for r in sorted(found, key=lambda r: r.start)] == [r[0] for r in rows]
    by_id = {}
    for doc_id, text in rows:
        ids = np.array([*encode(text or ""), 0], "<u4")
        by_id.setdefault(doc_id, []).append((len(ids), zlib.crc32(ids.tobytes())))
    for row in sorted(found, key=lambda r: r.start):
        assert row.start == start
        assert (row.n_tokens, row.ids_crc32) in by_id[row.doc_id]
        by_id[row.doc_id].remove((row.n_tokens, row.ids_crc32))
        start += row.n_tokens
        expected.append(row)
    assert files.bits == 16 and len(expected) == len(AWKWARD)
    # Bases are the sums of what stands in the shards before.
    base = 0
    for row in files.manifest.orderBy("shard").collect():
        assert row.base == base
        base += row.n_tokens


def test_no_documents_give_no_files(spark, tmp_path):
    files = token_files.write_token_files(documents(spark, []), BPE, str(tmp_path / "none"))
    assert token_files.read_token_files(files).count() == 0


def best_score(model, text):
    """Dynamic programming over all pieces at all places."""
    by_piece = {}
    for i, score in model.scores.items():
        by_piece.setdefault(model.bytes[i].decode().replace(" ", "▁"), score)
    best = [0.0] + [-math.inf] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - 16), end):
            if text[start:end] in by_piece:
                best[end] = max(best[end], best[start] + by_piece[text[start:end]])
        if text[end - 1] not in model.single:
            raw = len(text[end - 1].encode())
            best[end] = max(best[end], best[end - 1] + raw * model.byte_score)
    return best[-1]


def test_viterbi_finds_the_best_path():
    model, rng = pieces.PieceModel.load(SP), random.Random(5)
    for _ in range(300):
        text = "▁" + "".join(rng.choices("etaoinshr é😀ß▁th", k=rng.randint(1, 14))).replace(" ", "▁")
        ids = model.viterbi(text)
        byte_ids = set(model.byte_ids.values())
        score = sum(model.byte_score if i in byte_ids else model.scores[i] for i in ids)
        assert score == pytest.approx(best_score(model, text))


def test_a_small_unigram_vocabulary():
    vocabulary = [("▁a", -1.0), ("b", -1.0), ("ab", -0.5), ("▁", -3.0), ("a", -2.0), ("bb", -1.5)]
    model = pieces.PieceModel(vocabulary, {})
    assert [vocabulary[i][0] for i in model.viterbi("▁abb")] == ["▁a", "bb"]
    assert [vocabulary[i][0] for i in model.viterbi("▁bab")] == ["▁", "b", "ab"]


def test_decoding_gives_every_text_back(spark):
    coded = pieces.encode(documents(spark), SP)
    back = pieces.decode(coded, SP, into="again").collect()
    assert len(back) == len(AWKWARD)
    assert all(row.again == row.text for row in back)
    assert {row.labels for row in back} == {"own"}
    assert {(row.ids is None) == (row.text is None) for row in back} == {True}
    assert pieces.encode(documents(spark, []), SP).count() == 0


def test_words_encoded_apart_are_those_of_the_whole():
    model, rng = pieces.PieceModel.load(SP), random.Random(8)
    texts = ["".join(rng.choices(["the", " ", "  ", "in", "\n", "é", "▁"], k=9)) for _ in range(200)]
    ids, starts = model.encode(texts)
    byte_ids = set(model.byte_ids.values())
    for i, text in enumerate(texts):
        marked = (" " + text).replace("▁", pieces.NO_SPACE).replace(" ", "▁") if text else ""
        scores = [
            sum(model.byte_score if k in byte_ids else model.scores[k] for k in own)
            for own in (ids[starts[i] : starts[i + 1]].tolist(), model.viterbi(marked))
        ]
        assert scores[0] == pytest.approx(scores[1])
