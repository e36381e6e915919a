"""The field for personal data: exact marginals, what words and copies decide, precision and recall."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from helpers import documents

from tillmart.llm import pii


def added(text, **settings):
    return [(k, text[a:b]) for k, a, b, own in pii.find_spans(text, **settings) if not own]


def marginals(unary, known, edges):
    """By going through all labellings; known nodes keep their best label."""
    size, labels = unary.shape
    sums = np.zeros(unary.shape)
    choices = [[int(unary[i].argmax())] if known[i] else range(labels) for i in range(size)]
    for labelling in itertools.product(*choices):
        score = sum(unary[i, c] for i, c in enumerate(labelling))
        score += sum(w for i, j, w in edges if labelling[i] == labelling[j])
        for i, c in enumerate(labelling):
            sums[i, c] += np.exp(score)
    return sums / sums.sum(1, keepdims=True)


def believed(unary, known, edges):
    beliefs = pii._beliefs(unary, known, edges, 1000)
    shares = np.exp(beliefs - beliefs.max(1, keepdims=True))
    return shares / shares.sum(1, keepdims=True)


def random_field(rng, size, loops):
    unary = rng.normal(size=(size, 4)) * 1.5
    known = rng.random(size) < 0.2
    unary[known, rng.integers(0, 4, known.sum())] += 40
    edges = [(int(rng.integers(i)), i, float(rng.random() * 2)) for i in range(1, size)]
    for _ in range(loops):
        i, j = sorted(rng.choice(size, 2, replace=False).tolist())
        edges.append((i, j, float(rng.random())))
    return unary, known, edges


def test_beliefs_of_trees_are_exact():
    rng = np.random.default_rng(1)
    for _ in range(100):
        own = random_field(rng, int(rng.integers(2, 7)), 0)
        assert believed(*own) == pytest.approx(marginals(*own), abs=2e-3)


def test_beliefs_of_loops_come_close():
    rng, errors, same = np.random.default_rng(2), [], []
    for _ in range(100):
        unary, known, edges = random_field(rng, 6, 2)
        exact, found = marginals(unary, known, edges), believed(unary, known, edges)
        errors.append(np.abs(exact - found).max())
        same += (exact.argmax(1) == found.argmax(1)).tolist()
    assert np.mean(errors) < 0.06 and np.mean(same) > 0.97


def test_beliefs_of_fields_of_texts_are_exact_where_there_is_no_loop():
    text = "call +1 (504) 555-2652 or 5045552652 now, mail joe@a.com or joe@b"
    base = pii.base_spans(text)
    nodes = pii._nodes(text, base, False)
    unary, known, edges = pii.field(text, nodes, pii.Weights(), pii.DEFAULT)
    assert len(nodes) == 6 and known.sum() == 4
    assert believed(unary, known, edges) == pytest.approx(marginals(unary, known, edges), abs=2e-3)


def test_a_number_without_a_base_twin_is_found_by_its_words():
    assert added("call 504-555-2652 today") == [("phone", "504-555-2652")]
    assert added("there are 504-555-2652 of them") == []


def test_one_mention_speaks_for_its_copies():
    """What a look-up of base spans cannot find: there are none."""
    text = "call 504-555-2652 today. " + "so it goes " * 200 + "then 5045552652 it was"
    assert added(text) == [("phone", "504-555-2652"), ("phone", "5045552652")]
    assert added("so it goes then 5045552652 it was") == []


@pytest.mark.parametrize(
    "text",
    [
        "from 111.222.33.33 came 1112223333 things",  # an address gives numbers no evidence
        "dial +49 30 1234567 then order 9991234567 invoice",  # the same end, but another number
        "4539578763621486 is one, 1234578763621486 none",
        "joe.doe@mail.com wrote about 5 @ 3",
    ],
)
def test_what_only_looks_alike_stays(text):
    assert added(text) == []


@pytest.mark.parametrize("again", ["5045552652", "15045552652", "05045552652", "504-555-2652", "504.555.2652"])
def test_other_ways_to_write_a_number(again):
    assert added(f"dial +1 (504) 555-2652 or so, {again} as well") == [("phone", again)]


def test_secrets_are_found_only_where_asked_for():
    value = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    text = f'token = "{value}" and commit {value[::-1]}'
    assert added(text) == []
    assert added(text, secrets=True) == [("secret", value)]
    again = f"password={value} " + "words and " * 100 + value
    assert added(again, secrets=True) == [("secret", value)] * 2
    assert added("key " + "a" * 40 + " and api_token_for_the_test_server1", secrets=True) == []


def test_long_tokens_are_looked_at_whole():
    name = "a" * 80
    text = f"write to {name}@mail.example.com or {name}@localhost"
    assert added(text) == [("email", f"{name}@localhost")]


def test_fit_learns_what_stands_before(spark):
    rng = random.Random(3)
    filler = "the of and to in with for on by at".split()

    def sentence(word, value):
        return " ".join([*rng.choices(filler, k=6), word, value, *rng.choices(filler, k=6)])

    texts = []
    for i in range(400):
        number = f"{rng.randint(200, 999)} {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
        texts.append(sentence("ring", f"+1 {number}"))
        texts.append(sentence("invoice", str(rng.randint(10**8, 10**9))))
    model = pii.fit(documents(spark, list(enumerate(texts))))
    phone = 1 + pii.LABELS.index("phone")
    assert model.words["ring"][phone] > 2 > 0 > model.words["invoice"][phone]
    assert abs(model.words["the"][phone]) < 1
    assert added("please ring 5045552652 now", model=model) == [("phone", "5045552652")]
    assert added("please ring 5045552652 now") == []
    empty = pii.fit(documents(spark, []))
    assert empty.words.keys() == pii.DEFAULT.words.keys()


def planted(rng):
    """A text with base spans and other forms of some of them; the other forms, and decoys."""
    number = f"{rng.randint(200, 999)}{rng.randint(200, 999)}{rng.randint(1000, 9999)}"
    spoken = f"+1 ({number[:3]}) {number[3:6]}-{number[6:]}"
    name = "".join(rng.choices("abcdefgh", k=7))
    forms = {
        "phone": rng.choice([number, f"1{number}", f"{number[:3]}-{number[3:6]}-{number[6:]}"]),
        "email": rng.choice([f"{name}@localhost", f"{name}@mailhost"]),
    }
    decoys = [str(rng.randint(10**9, 10**10 - 1)), f"item{rng.randint(1, 99)}", f"{rng.randint(1, 9)}.{rng.randint(0, 9)}"]
    words = "so it goes and then there was more of that in the end".split()
    bits = [spoken, f"{name}@example.com", *forms.values(), *decoys]
    rng.shuffle(bits)
    text = " ".join(x for bit in bits for x in (*rng.choices(words, k=rng.randint(2, 9)), bit))
    return text, forms


def test_precision_and_recall_on_planted_forms():
    rng = random.Random(9)
    hits, found, wanted = {"phone": 0, "email": 0}, 0, {"phone": 0, "email": 0}
    for _ in range(300):
        text, forms = planted(rng)
        spans = added(text)
        found += len(spans)
        for kind, form in forms.items():
            wanted[kind] += 1
            hits[kind] += (kind, form) in spans
    assert all(hits[kind] >= 0.98 * wanted[kind] for kind in wanted)
    assert sum(hits.values()) >= 0.98 * found
