"""Each stage of the pipeline on awkward rows."""

from __future__ import annotations

import pytest
from helpers import AWKWARD, documents

import corpus_pipeline
from tillmart.llm import pieces, queries

STAGES = dict(corpus_pipeline.STAGES)
LEAK = "a passage of the benchmark that nobody should have seen before, with words enough to count"


@pytest.fixture
def folder(spark, tmp_path):
    rows = [(1, LEAK), (2, None), (3, ""), (None, "another passage without an id but with many words in it")]
    spark.createDataFrame(rows, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def run(spark, folder, name, rows):
    docs = documents(spark, rows)
    out = STAGES[name](spark, docs, folder)
    if name != "encode":
        assert out.dtypes == docs.dtypes
    return docs, out.collect()


def kept(rows):
    return sorted(((r.doc_id, r.text) for r in rows), key=str)


def test_language_id(spark, folder):
    """All rows have one language here, so only those without a letter go."""
    _, out = run(spark, folder, "language_id", AWKWARD)
    with_letters = [(i, t) for i, t in AWKWARD if t and any(c.isalpha() for c in t)]
    assert kept(out) == sorted(with_letters, key=str)


def test_near_duplicates(spark, folder):
    _, out = run(spark, folder, "near_duplicates", AWKWARD)
    found = kept(out)
    ids = [i for i, _ in found]
    assert ids.count(6) == 1 and 7 not in ids  # copies of 6
    assert {1, 2, 3, 4, 5, 8, 10, 11, 12} <= set(ids)
    assert ids.count(None) == 2
    assert len(found) == len(set(found))


def test_benchmark_decontamination(spark, folder):
    rows = [*AWKWARD, (20, f"before {LEAK} after"), (None, f"no id, {LEAK}"), (21, LEAK), (21, LEAK)]
    _, out = run(spark, folder, "benchmark_decontamination", rows)
    assert kept(out) == sorted(AWKWARD, key=str)


def test_personal_data(spark, folder):
    key = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    rows = [*AWKWARD, (20, f'to joe@example.com, token = "{key}"'), (20, f'to joe@example.com, token = "{key}"')]
    _, out = run(spark, folder, "personal_data", rows)
    texts = {r.doc_id: r.text for r in out}
    assert len(out) == len(rows)
    assert texts[20] == 'to [EMAIL], token = "[SECRET]"'
    assert texts[11] == "[IP] " * 3000
    assert (texts[1], texts[2], texts[3]) == (None, "", "   \n\t ")
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in out)


def test_encode(spark, folder):
    _, out = run(spark, folder, "encode", AWKWARD)
    model = pieces.model(queries.tokenizer("piece_bpe_32k.model"))
    assert len(out) == len(AWKWARD)
    decoded = [(r.doc_id, None if r.ids is None else model.decode(r.ids)) for r in out]
    assert sorted(decoded, key=str) == sorted(AWKWARD, key=str)


@pytest.mark.parametrize("name", STAGES)
def test_no_rows(spark, folder, name):
    assert run(spark, folder, name, [])[1] == []


@pytest.mark.parametrize("name", STAGES)
def test_rows_without_ids_or_texts(spark, folder, name):
    rows = [(None, None)] * 3 + [(1, None)] * 2
    out = run(spark, folder, name, rows)[1]
    expected = {"language_id": 0, "near_duplicates": 4}
    assert len(out) == expected.get(name, 5)


@pytest.mark.parametrize("name", STAGES)
def test_texts_reach_python_in_small_batches(spark, folder, name):
    """Long-lived executors keep the room of the largest batch, several times over."""
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    run(spark, folder, name, [])

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["bytes"])

    docs = spark.range(0, 2000, 1, 1).selectExpr("repeat(cast(id as string), 5000) as text")
    found = [row[0] for row in docs.mapInArrow(sizes, "bytes long").collect()]
    assert max(found) < 6_000_000 and sum(found) > 20_000_000
