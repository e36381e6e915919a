"""Jaccard join, fingerprints, decontamination, chat and the pipeline."""

from __future__ import annotations

import random

import numpy as np
import pytest
from helpers import AWKWARD, LONG, components, documents, sha, shingle_set
from pyspark.sql import functions as F

from tillmart.llm import chat, decontamination, fingerprints, jaccard, queries


def near_copies(seed, groups=6, copies=12, words=70):
    """Groups of texts with a few words changed, a passage that many share, and single texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=40)
    texts = []
    for g in range(groups):
        base = rng.choices(vocabulary, k=words + 7 * g)
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                own += passage[: rng.randint(1, 6)]
            texts.append(" ".join(own))
    texts += [" ".join(passage + rng.choices(vocabulary, k=rng.randint(2, 30))) for _ in range(30)]
    texts += [texts[0]] * 5 + ["one two"] * 3 + ["one", "ONE", "", None]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed,size,percent", [(1, 3, 90), (2, 5, 80), (3, 3, 60)])
def test_components_against_all_pairs(spark, seed, size, percent):
    rows = near_copies(seed)
    found = jaccard.similar_groups(documents(spark, rows), size, percent).collect()
    expected = components(dict(rows), size, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected
    assert len(found) == len(rows)


def test_groups_do_not_depend_on_which_grams_are_frequent(spark, monkeypatch):
    rows = near_copies(4)
    monkeypatch.setattr(jaccard, "LEAST", 1)
    few = jaccard.similar_groups(documents(spark, rows), 3, 80).collect()
    monkeypatch.setattr(jaccard, "LEAST", 10**9)
    none = jaccard.similar_groups(documents(spark, rows), 3, 80).collect()
    assert sorted(few) == sorted(none)


def test_groups_of_awkward_rows(spark):
    found = jaccard.similar_groups(documents(spark), 3, 90).collect()
    assert len(found) == len(AWKWARD)
    by_id = {}
    for row in found:
        by_id.setdefault(row.doc_id, []).append((row.n_shingles, row.component_id))
    assert by_id[1] == [(0, 1)] and by_id[2] == [(0, 2)] and by_id[4] == [(1, 4)]
    assert {c for _, c in by_id[6] + by_id[7]} == {6}
    assert {c for _, c in by_id[9]} == {9}
    assert (0, None) in by_id[None]
    assert jaccard.similar_groups(documents(spark, []), 3, 90).count() == 0


def test_one_row_of_each_group_stays(spark):
    rows = near_copies(5)
    docs = documents(spark, rows)
    kept = {r.doc_id for r in jaccard.one_of_each(docs, 5, 80).collect()}
    assert kept == {i for i, (_, first) in components(dict(rows), 5, 80).items() if i == first}
    assert jaccard.one_of_each(docs, 5, 80).columns == docs.columns
    again = jaccard.one_of_each(documents(spark), 5, 80).collect()
    assert len([r for r in again if r.doc_id == 7]) == 0  # a copy of 6
    assert len([r for r in again if r.doc_id is None]) == 2


def test_components_of_edges(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(5, 5), (70, 71), (71, 70)]
    chain = [(100 + i, 101 + i) for i in range(40)]
    df = spark.createDataFrame(edges + chain, "a long, b long")
    found = {r.node: r.label for r in jaccard.components(df).collect()}
    parent = {}

    def find(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges + chain:
        if a != b:
            parent[find(a)] = find(b)
    nodes = {x for e in edges + chain if e[0] != e[1] for x in e}
    assert found.keys() == nodes
    for a in nodes:
        for b in nodes:
            assert (found[a] == found[b]) == (find(a) == find(b))
    assert jaccard.components(df.limit(0)).count() == 0


def template_group(rng, size):
    """Texts of one template, each with words of its own: all alike, none enough."""
    base = [f"t{i}" for i in range(200)]
    texts = []
    for k in range(size):
        own = list(base)
        for at in rng.sample(range(200), 12):
            own[at] = f"own{k}x{at}"
        texts.append(" ".join(own))
    return texts


def test_pairs_of_a_template_group_that_is_not_alike_enough_stay_few(spark, monkeypatch):
    """Five-word sets of which 0.4 to 0.6 are in common, and a link is asked for at 0.8."""
    pairs = {}

    def counted(df, name, original=jaccard.written):
        found = original(df, name)
        if name in ("across", "first-pairs"):
            pairs[name] = pairs.get(name, 0) + found.count()
        return found

    monkeypatch.setattr(jaccard, "written", counted)
    numbers = []
    for size in (40, 160):
        pairs.clear()
        rows = list(enumerate(template_group(random.Random(1), size)))
        found = jaccard.similar_groups(documents(spark, rows)).collect()
        assert all(r.component_id == r.doc_id for r in found)
        numbers.append(sum(pairs.values()))
    assert numbers[1] <= 4 * numbers[0] + 40


def test_short_sketches_never_rule_out_a_link(spark):
    rng = np.random.default_rng(4)
    for _ in range(200):
        universe = rng.integers(0, 2**63, 400).astype(np.uint64)
        size = int(rng.integers(5, 300))
        a = np.unique(rng.choice(universe, size, replace=False))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.95], rng.choice(universe, 3)]))
        different = np.bitwise_count(jaccard.parity(a, 512) ^ jaccard.parity(b, 512)).sum()
        assert different <= len(np.setxor1d(a, b))
        assert len(jaccard.parity(a, 64 * jaccard.SHORT)) == jaccard.SHORT


def test_fingerprints_estimate_jaccard(spark):
    rng = random.Random(7)
    pairs, truth = [], []
    for i in range(60):
        a = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(200, 600))]
        b = list(a)
        for _ in range(rng.randint(0, 60)):
            b[rng.randrange(len(b))] = f"v{rng.randrange(5000)}"
        pairs.append((i, " ".join(a), " ".join(b)))
        x, y = shingle_set(pairs[-1][1], 5), shingle_set(pairs[-1][2], 5)
        truth.append(len(x & y) / len(x | y))
    df = spark.createDataFrame(pairs, "i int, a string, b string").select(
        "i", fingerprints.fingerprint("a").alias("a"), fingerprints.fingerprint("b").alias("b")
    )
    found = df.select("i", fingerprints.likeness("a", "b").alias("near")).orderBy("i").collect()
    errors = [r.near - t for r, t in zip(found, truth)]
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_fingerprints_of_awkward_texts(spark):
    rows = documents(spark).select("text", fingerprints.fingerprint("text").alias("print")).collect()
    for row in rows:
        wordless = not (row.text or "").strip()
        assert len(row.print) == (0 if wordless else fingerprints.BINS)
    by_text = {}
    for row in rows:
        assert by_text.setdefault(row.text, row.print) == row.print


def test_each_document_meets_the_next(spark, tmp_path):
    rows = [(i * 3 % 50, f"text number {i} " + "some more words " * (i % 7)) for i in range(50)]
    rows += [(60, None), (61, ""), (62, "a"), (62, "a"), (63, LONG), (None, "first of all")]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op7_fingerprints(spark, str(tmp_path)).collect()
    assert len(found) == len(rows)
    order = sorted({(-1 if i is None else i): t or "" for i, t in rows}.items())
    expected = {}
    for k, (i, text) in enumerate(order):
        cut, other = len(text) // 2, order[(k + 1) % len(order)][1]
        expected[i] = (len(text), sha(text[: len(text) - cut] + other[:cut]))
    for row in found:
        assert (row.n_chars, row.edited_sha256) == expected[-1 if row.doc_id is None else row.doc_id]
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1


@pytest.mark.parametrize("per_range", [50, 700, 10**6])
def test_ranges_do_not_change_who_is_next(spark, per_range):
    """Also where ids repeat or are missing, and where a range has one document."""
    rows = [(i * 7 % 101, f"text number {i} " + "some more words " * (i % 9)) for i in range(101)]
    rows += [(50, "other"), (50, "other"), (50, "third")] + [(None, f"no id {k}") for k in range(5)]
    found = fingerprints.with_next(documents(spark, rows), per_range).collect()
    whole = fingerprints.with_next(documents(spark, rows), 10**9).collect()
    assert sorted(map(str, found)) == sorted(map(str, whole))
    assert len(found) == len(rows)
    prints = {r.text: r.fingerprint for r in found}
    for r in found:
        after = [t for t, p in prints.items() if p == r.next_fingerprint and t.startswith(r.head)]
        assert len(r.head) <= len(r.text) // 2 and after
        if r.doc_id is not None and r.doc_id not in (49, 50):
            successor = (r.doc_id + 1) if r.doc_id < 100 else None
            assert any((successor, t) in rows for t in after)


def test_ranges_are_searched_for_as_plainly(spark):
    keys = spark.range(300).selectExpr(
        "struct(if(id % 20 = 0, null, id * 37 % 101) as doc_id, id * 13 % 29 as tie) as key"
    )
    ordered = [r.key for r in keys.distinct().orderBy("key").collect()]
    for step in (1, 3, 50, 299):
        bounds = ordered[::step]
        found = keys.select("key", fingerprints._part(F.col("key"), bounds).alias("part")).collect()
        for r in found:
            before = ordered[: ordered.index(r.key) + 1]
            assert r.part == sum(b in before for b in bounds) - 1


def test_no_documents_have_no_fingerprints(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op7_fingerprints(spark, str(tmp_path)).count() == 0


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j], row[j + 1])
    return row[-1]


def test_lcs_against_the_table():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a, b = rng.integers(0, 6, rng.integers(0, 20)), rng.integers(0, 6, rng.integers(0, 30))
        assert decontamination.lcs(a, b) == plain_lcs(a.tolist(), b.tolist())


def test_svd_spans_what_numpy_finds(spark):
    rng = np.random.default_rng(2)
    dense = (rng.random((60, 40)) < 0.2) * rng.random((60, 40))
    dense[:, :5] += rng.random((60, 1)) * 3
    dense[np.arange(60), rng.integers(0, 40, 60)] += 0.1  # no empty row
    rows = [(np.flatnonzero(r).tolist(), r[r != 0].tolist()) for r in dense]
    df = spark.createDataFrame(rows, "terms array<int>, weights array<double>").repartition(4)
    basis = decontamination.randomised_svd(df, 40, 40)
    assert np.allclose(basis.T @ basis, np.eye(basis.shape[1]), atol=1e-8)
    assert np.allclose(np.linalg.norm(dense @ basis, axis=0), np.linalg.svd(dense)[1][: basis.shape[1]])
    lead = decontamination.randomised_svd(df, 40, 1, power=4)
    assert abs(lead[:, 0] @ np.linalg.svd(dense)[2][0]) > 0.999


def passages(seed=9):
    rng = random.Random(seed)
    words = ["the", "of", "and", "in"] * 30 + [f"term{i}" for i in range(900)]

    def text(n):
        return " ".join(rng.choices(words, k=n)) + "."

    items = [(i, text(rng.randint(12, 60))) for i in range(40)] + [(90, None), (91, ""), (92, "a few words")]
    docs, planted = [], set()
    for d in range(200):
        own = text(rng.randint(5, 300))
        if d % 5 == 0:
            item, passage = items[rng.randrange(40)]
            parts = passage.split()
            for _ in range(len(parts) // 10 * (d % 3)):  # up to a fifth of its words changed
                parts[rng.randrange(len(parts))] = rng.choice(words)
            at = rng.randint(0, 250)
            before = own.split()
            own = " ".join(before[:at] + parts + before[at:])
            planted.add((d, item))
        docs.append((d, own))
    return items, docs, planted


def test_leaks_are_found_and_only_they(spark):
    items, docs, planted = passages()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.leaks(documents(spark, docs), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == planted
    kept = decontamination.without_leaks(documents(spark, docs), benchmark).collect()
    assert {r.doc_id for r in kept} == {d for d, _ in docs} - {d for d, _ in planted}


def test_candidates_recall_against_brute_force(spark):
    """Cosine candidates hold at least 0.9 of what judging all windows finds."""
    import pyarrow as pa

    items, docs, _ = passages(10)
    rows = documents(spark, docs)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    (block,) = decontamination.blocks(rows, benchmark)
    texts = pa.array([t for _, t in docs])
    distinct, index, starts = decontamination.words_of(texts)
    truth = set()
    for i in range(len(docs)):
        words = distinct[index[starts[i] : starts[i + 1]]]
        for p in block.passages:
            near = decontamination._densest(p, words)
            if decontamination.judge(p, near)[0]:
                truth.add((i, p.item_id))
    found = {(t, item) for t, item, _, _ in decontamination.find_leaks(block, texts)}
    assert len(found & truth) >= 0.9 * len(truth) and truth


def plain_aligned(a, b):
    """The table in full: words in order, less a fourth for each word put in."""
    rows = [[0.0] * (len(a) + 1)]
    for y in b:
        before, row = rows[-1], [0.0]
        for i, x in enumerate(a):
            row.append(max(before[i] + (x == y), before[i + 1] - 1 / decontamination.PUT_IN, row[i], 0))
        rows.append(row)
    return max(row[-1] for row in rows)


def plain_leak(passage, words):
    """Over the whole document, without windows or dense runs."""
    own, answer, size = passage.words.tolist(), passage.answer.tolist(), len(passage.words)
    points = plain_aligned(own, words) / size
    if points >= decontamination.ALONE or points < decontamination.WITH_ANSWER:
        return points >= decontamination.ALONE
    run = len(answer) + len(answer) // 4 + 1
    least = decontamination.ANSWER * len(answer)
    return any(plain_lcs(answer, words[k : k + run]) >= least for k in range(len(words)))


def test_alignment_against_the_table():
    rng = np.random.default_rng(3)
    for _ in range(300):
        a, b = rng.integers(0, 6, rng.integers(1, 20)), rng.integers(0, 6, rng.integers(0, 60))
        points, found = decontamination.aligned(a, b)
        assert points == plain_aligned(a.tolist(), b.tolist())
        assert points <= found <= plain_lcs(a, b)


def scattered(seed):
    """Passages with an answer; documents by what was done to a passage, and others without any."""
    rng = random.Random(seed)
    words = ["the", "of", "and", "in"] * 600 + [f"term{i}" for i in range(20_000)]

    def text(n):
        return " ".join(rng.choices(words, k=n))

    items = [(i, f"{text(rng.randint(30, 50))}. {text(8)}.") for i in range(12)]
    docs, kinds = [], ("answer far behind", "answer before", "half, no answer", "put in", "many put in")
    for d in range(60):
        item, passage = items[d % 12]
        body, answer = passage[:-1].split(". ")
        own, kind = body.split(), kinds[d % 5]
        part = " ".join(own[: int(0.7 * len(own))])
        middle = {
            "answer far behind": f"{part} {text(100)} {answer}",
            "answer before": f"{answer} {text(100)} {part}",
            "half, no answer": part,
            "put in": " ".join(f"{w} {text(1)}" for w in passage.split()),
            "many put in": " ".join(f"{w} {text(4)}" for w in passage.split()),
        }[kind]
        docs.append((d, f"{text(rng.randint(0, 150))} {middle} {text(rng.randint(0, 150))}"))
    docs += [(d, text(100)) for d in range(60, 400)]
    leaked = {(d, d % 12) for d in range(60) if kinds[d % 5] not in ("half, no answer", "many put in")}
    return items, docs, leaked


def test_answers_elsewhere_and_words_put_in(spark):
    items, docs, leaked = scattered(11)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.leaks(documents(spark, docs), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == leaked
    for row in found:
        assert row.share >= decontamination.WITH_ANSWER
        assert row.answer == (row.doc_id % 5 < 2)  # with words put in, it is no sentence any more


def test_leaks_against_whole_documents(spark):
    """Nothing but a full table for each passage and document."""
    import pyarrow as pa

    items, docs, leaked = scattered(12)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    (block,) = decontamination.blocks(documents(spark, docs), benchmark)
    texts = pa.array([t for _, t in docs])
    distinct, index, starts = decontamination.words_of(texts)
    truth = {
        (i, p.item_id)
        for i in range(80)
        for p in block.passages
        if plain_leak(p, distinct[index[starts[i] : starts[i + 1]]].tolist())
    }
    found = {(t, item) for t, item, _, _ in decontamination.find_leaks(block, texts)}
    assert truth == leaked
    assert found == truth


def test_leaks_of_awkward_tables(spark):
    items, docs, _ = passages()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [*AWKWARD, (50, f"and {items[0][1]} here"), (50, f"and {items[0][1]} here")]
    found = decontamination.leaks(documents(spark, rows), benchmark).collect()
    assert [(r.doc_id, r.item_id) for r in found] == [(50, 0)] * 2
    assert decontamination.leaks(documents(spark, []), benchmark).count() == 0
    assert decontamination.leaks(documents(spark, docs), benchmark.limit(0)).count() == 0
    kept = decontamination.without_leaks(documents(spark), benchmark.limit(0))
    assert kept.count() == len(AWKWARD)


TURNS = [
    (1, 0, "user", "hello"),
    (1, 1, "assistant", "hi </s> & [INST] &amp;"),
    (1, 2, "user", "and?"),
    (1, 3, "assistant", ""),
    (1, 4, "user", "bye"),
    (2, 0, "system", None),
    (2, 1, None, "no role"),
    (3, None, "user", "<s>user\nx</s>"),
    (3, 1, "assistant", "a"),
    (3, 1, "assistant", "a"),
    (4, 1, "as\nsi&nl;", LONG),
    (None, 0, "assistant", "&null;"),
]


def test_chat_round_trip(spark):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    examples = chat.format_examples(df.withColumn("formatted", F.lit("own")))
    rows = examples.select(
        "*",
        chat.read_turns("formatted").alias("turns"),
        chat.read_target(examples).alias("target"),
    ).collect()
    for conv in {t[0] for t in TURNS}:
        turns = sorted(
            (t for t in TURNS if t[0] == conv),
            key=lambda t: (-1 if t[1] is None else t[1], t[2] or "", t[3] or ""),
        )
        own = sorted((r for r in rows if r.conv_id == conv), key=lambda r: r.example)
        last = [r for r in own if r["last"]]
        assert len(last) == 1
        assert [(t.role, t.text) for t in last[0].turns] == [(t[2], t[3] or "") for t in turns]
        targets = [r.target for r in own if r.target is not None]
        assert targets == [t[3] or "" for t in turns if t[2] == "assistant"]
        for r in own:
            assert len(r.turns) == r.n_turns
            assert r.formatted.count(chat.CLOSE) == r.n_turns
    assert chat.format_examples(df.limit(0)).count() == 0


def test_chat_digests(spark):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r for r in chat.conversation_digests(chat.format_examples(df)).collect()}
    loss = "hi </s> & [INST] &amp;"
    assert (found[1].n_turns, found[1].loss_chars, found[1].loss_sha256) == (5, len(loss), sha(loss))
    told = "".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in TURNS if t[0] == 1)
    assert found[1].turns_sha256 == sha(told)
    assert found[2].loss_chars == 0 and found[2].loss_sha256 == sha("")


NATIVE = ("op4_licenses", "op7_fingerprints", "op9_chat")


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_hold_no_python(spark, name):
    plan = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "MapIn", "ExistingRDD "))


@pytest.mark.parametrize("size", [100, 1000, 1025, 3000])
def test_short_sketches_tell_sets_apart(spark, size):
    """Of long texts too, whose n-grams outnumber the bits of the shortest sketch."""
    grams = np.random.default_rng(1).integers(0, 2**63, 2 * size, dtype=np.uint64)

    def built(own):
        text = " ".join(str(x) for x in own)
        return jaccard._sets(documents(spark, [(1, text)]), 1, 80, (grams[:0], grams[:0])).select("n", "short")

    def allowed(a, b):
        both = built(a).alias("x").crossJoin(built(b).alias("y"))
        return both.select(jaccard._short_sketches_allow(80, "x", "y")).first()[0]

    own, near, other = grams[:size], grams[size // 10 : size + size // 50], grams[size:]
    assert allowed(own, own) and allowed(own, near) and not allowed(own, other)
