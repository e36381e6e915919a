"""Personal data by a skip-chain conditional random field.

The base finds e-mail addresses, IP addresses, card numbers and phone numbers by their patterns.
The field then looks at the tokens around and away from them. Its nodes are the white-space
separated tokens with a digit or an at sign that may be an entity by their shape; all other tokens are
observed to be none and send nothing. Its labels are the kinds and "none". Potentials:

* of a node: what its shape says about each label, and what the words before it do; a token inside a base
  span is observed. Words weigh by a short list, and by what `fit` learns: log ratios of how often a word
  stands before a base span of a kind and before other tokens
* of neighbouring tokens: labels go on where a phone number or a card is written in groups
* of skip edges: two tokens with the same key (digits without punctuation, or the address in lower
  case) or similar keys (of two numbers one ends in the other; the same mailbox name) want the same
  label, of those that both may have by their shape

Every unobserved token has skip edges to the nearest observed one with its key and to the nearest with
a similar key, so that evidence reaches it over one edge however often the key is repeated. Observed
tokens keep their label whatever they are sent. Among each other, unobserved tokens with the same key
are joined with the one before; so a token whose words tell what it is speaks for its copies.
Sum-product messages go round until they settle, or `rounds` are over. A token that is more probably of
a kind than anything else, and no base span holds it, is added as a span of that kind. So a number
that is written once as "+1 (504) 555-2652", or is once called a phone, is found again as "5045552652";
a number that stands alone and fits no pattern is left.

Secrets (long mixed values that a word like "token" or "password" stands before) are a kind that only the
field finds, and only where it is asked for.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame

from tillmart.llm.common import trim

KINDS = ("email", "ip", "card", "phone")
SECRET = "secret"
LABELS = (*KINDS, SECRET)

# The patterns of the four kinds.
EMAIL_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits does; saying so keeps long runs linear.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

TOKEN = re.compile(r"\S*[0-9@]\S*")
ADDRESS = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
# At most so long, as keys are; what is longer is data.
VALUE = re.compile(r"(?:.*[=:])?[\"']?([A-Za-z0-9_/+.-]{20,256}?)=*[\"']?\W*", re.DOTALL)
WORDS = re.compile(r"[^\W\d_]+")
#: Characters before a token in which the words before it are looked for, and how many count.
BEFORE, NEAREST = 48, 2
SMOOTHING = 20.0

# Words that tell what comes after them.
CALLED = {
    "email": ("email", "mail", "mailto"),
    "ip": ("ip", "host", "server"),
    "card": ("card", "visa", "mastercard", "amex", "creditcard"),
    "phone": ("call", "phone", "tel", "telephone", "mobile", "fax", "cell", "whatsapp"),
    SECRET: ("token", "secret", "password", "passwd", "pwd", "bearer", "apikey", "key", "auth"),
}
DIGIT_OR_AT = re.compile(r"[0-9@]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


class Weights(NamedTuple):
    """Log potentials of the field."""

    prior_none: float = 3.0
    shape: float = 2.0
    neighbour: float = 1.0
    same: float = 6.0
    similar: float = 4.0
    observed: float = 30.0
    called: float = 3.0


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Looks left and right of each at sign, so that long words without one cost nothing."""
    spans, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        found = EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if found:
            spans.append((start, found.end()))
        # No run of the name's characters goes beyond an at sign.
        done = found.end() if found else at + 1
        at = text.find("@", done)
    return spans


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """All base spans by kind as listed, then start; code points, end exclusive."""
    if not DIGIT_OR_AT.search(text):
        return []
    spans = [("email", *span) for span in emails(text)]
    for found in IP.finditer(text):
        if all(len(part) <= 3 or not part[:-3].strip("0") for part in found[0].split(".")) and all(
            int(part[-3:]) <= 255 for part in found[0].split(".")
        ):
            spans.append(("ip", *found.span()))
    for found in CARD.finditer(text):
        digits = _digits(found[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *found.span()))
    for found in PHONE.finditer(text):
        if 9 <= len(_digits(found[0])) <= 15:
            spans.append(("phone", *found.span()))
    return spans


class _Node(NamedTuple):
    start: int
    end: int
    text: str
    base: int  # label of the first base span it touches, or -1
    whole: str  # the text of that span, or its own
    may_be: frozenset[int]  # the labels its shape allows, besides none
    words: tuple[str, ...]  # before it, the nearest first


def _nodes(text: str, base: list[tuple[str, int, int]], secrets: bool) -> list[_Node]:
    marks = sorted((start, end, 1 + KINDS.index(kind)) for kind, start, end in base)
    nodes, first = [], 0
    for found in TOKEN.finditer(text):
        bare = found[0].strip(".,;:!?()[]{}<>\"'")
        if not DIGIT_OR_AT.search(bare):
            continue
        start = found.start() + found[0].index(bare)
        end = start + len(bare)
        while first < len(marks) and marks[first][1] <= start:
            first += 1
        label, whole, i = -1, bare, first
        while label < 0 and i < len(marks) and marks[i][0] < end:
            if marks[i][1] > start:
                label, whole = marks[i][2], text[marks[i][0] : marks[i][1]]
            i += 1
        may_be = frozenset([label]) if label >= 0 else _may_be(bare)
        value = VALUE.fullmatch(bare) if secrets and label < 0 and not may_be else None
        if value and _mixed(value[1]):
            may_be = frozenset([1 + LABELS.index(SECRET)])
            start, end = start + value.start(1), start + value.end(1)
            bare = value[1]
        if may_be:
            nodes.append(_Node(start, end, bare, label, whole, may_be, _words_before(text, start)))
    return nodes


def _may_be(token: str) -> frozenset[int]:
    """The labels of base kinds that a token outside base spans may have."""
    if "@" in token:
        return frozenset([1] if token.count("@") == 1 else [])
    if not all(c in "0123456789+().-" for c in token):
        return frozenset()
    if ADDRESS.fullmatch(token):
        return frozenset([2])
    size = len(_digits(token))
    card = 13 <= size <= 19 and luhn(_digits(token))
    found = ([3] if card else []) + ([4] if 7 <= size <= 15 else [])
    # Groups of a number that another token begins or goes on with.
    return frozenset(found or ([3, 4] if 4 <= size < 7 else []))


def _mixed(value: str) -> bool:
    """Letters and digits in turn, as in keys and unlike in names."""
    turns = sum(a.isdigit() != b.isdigit() for a, b in zip(value, value[1:]))
    return 6 * turns >= len(value)


def _words_before(text: str, start: int) -> tuple[str, ...]:
    found = WORDS.findall(text[max(0, start - BEFORE) : start])
    return tuple(word.lower() for word in found[: -NEAREST - 1 : -1])


class Model(NamedTuple):
    """What words before a token say: for each word a log potential a label."""

    words: dict[str, np.ndarray]


def _called() -> Model:
    words: dict[str, np.ndarray] = {}
    for kind, names in CALLED.items():
        for name in names:
            weights = words.setdefault(name, np.zeros(1 + len(LABELS)))
            weights[1 + LABELS.index(kind)] = Weights().called
    return Model(words)


DEFAULT = _called()


def fit(
    docs: DataFrame, text: str = "text", sample: int = 20_000, least: int = 5, most: float = 3.0
) -> Model:
    """Learn what words before tokens say about their kind, from base spans as labels.

    A weight is the logarithm of how much more often a word stands before base spans of a kind than
    before other tokens with a digit or an at sign, smoothed; at most `most`, and only for words seen
    `least` times. The listed words keep their weights. Learned from about `sample` texts, chosen
    by their hashes, so the same ones at each call; only counts of their words reach the driver.
    """
    from pyspark.sql import functions as F

    def count(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            labels, words = [], []
            for x in batch.column(0).to_pylist():
                for node in _labelled(x or ""):
                    for word in node.words:
                        labels.append(max(node.base, 0))
                        words.append(word)
            yield pa.RecordBatch.from_arrays(
                [pa.array(labels, pa.int32()), pa.array(words, pa.string())], ["label", "word"]
            )
            trim()

    share = int(min(1.0, sample / max(1, docs.count())) * 2**20)
    few = docs.select(F.col(text).alias("text")).filter(
        F.pmod(F.xxhash64("text"), F.lit(2**20)) < share
    )
    rows = few.mapInArrow(count, "label int, word string").groupBy("label", "word").count().collect()
    totals = np.ones(1 + len(LABELS))
    numbers: dict[str, np.ndarray] = {}
    for row in rows:
        totals[row["label"]] += row["count"]
        own = numbers.setdefault(row["word"], np.zeros(1 + len(LABELS)))
        own[row["label"]] += row["count"]
    words = {}
    for word, own in numbers.items():
        if own.sum() >= least:
            # As if so many more tokens of each label had it as often as all tokens together.
            usual = own.sum() / totals.sum()
            rates = np.log((own + SMOOTHING * usual) / (totals + SMOOTHING))
            weights = np.clip(rates - rates[0], -most, most)
            weights[1 + LABELS.index(SECRET)] = 0.0  # of which there are no labels
            words[word] = weights
    return Model(words | DEFAULT.words)


def _labelled(text: str) -> list[_Node]:
    """All tokens with a digit or an at sign, also those that the field leaves out."""
    found = _nodes(text, base_spans(text), secrets=False)
    inside = {node.start for node in found}
    others = [
        _Node(x.start(), x.end(), x[0], 0, x[0], frozenset(), _words_before(text, x.start()))
        for x in TOKEN.finditer(text)
        if x.start() not in inside
    ]
    return found + others


def _shape(node: _Node, weights: Weights, model: Model) -> np.ndarray:
    """Log potentials of no entity and the kinds."""
    scores = np.full(1 + len(LABELS), -weights.observed)
    scores[0] = weights.prior_none
    if node.base >= 0:
        scores[node.base] = weights.observed
        return scores
    size = len(_digits(node.text))
    for label in node.may_be:
        group = label in (3, 4) and size < 7
        scores[label] = -weights.shape if group else weights.shape
    told = [model.words[word] for word in node.words if word in model.words]
    if told:
        # The word that says most about a label counts; two of them are no more sure than one.
        strongest = np.max(told, axis=0)
        scores[1:] += np.where(strongest[1:] > 0, strongest[1:], np.min(told, axis=0)[1:])
    return scores


def _keys(node: _Node) -> tuple[str | None, list[str], list[str]]:
    """What makes a token the same as another; what it gives, and what it asks for, to be similar.

    A token of a base span stands for the whole span, so that groups match the number in one piece.
    """
    if SECRET_LABEL in node.may_be:
        return node.text, [], []
    if "@" in node.whole:
        address = node.whole.lower()
        mailbox = address[: address.index("@") + 1]
        similar = [mailbox] if len(mailbox) > 1 else []
        return address, similar, similar
    if 2 in node.may_be:
        return node.whole, [], []
    digits = _digits(node.whole)
    if len(digits) < 7:
        return None, [], []
    national = digits.lstrip("0")
    # Of two similar numbers one ends in the other, but for zeros in front.
    ends = [digits[i:] for i in range(1, len(digits) - 6)] if len(digits) <= 19 else []
    return digits, ["<" + x for x in [digits, *ends]] + [">" + digits], [
        "<" + (national if len(national) >= 7 else digits),
        *[">" + x for x in ends],
    ]


SECRET_LABEL = 1 + LABELS.index(SECRET)


def _edges(
    nodes: list[_Node], text: str, weights: Weights
) -> list[tuple[int, int, float]]:
    edges = []
    for i in range(1, len(nodes)):
        between = text[nodes[i - 1].end : nodes[i].start]
        if len(between) <= 2 and not between.strip(" ()"):
            edges.append((i - 1, i, weights.neighbour))
    keys = [_keys(node) for node in nodes]
    last: dict[str, int] = {}
    for i, (key, _, _) in enumerate(keys):
        if key is not None and nodes[i].base < 0:
            if key in last:
                edges.append((last[key], i, weights.same))
            last[key] = i
    gives = [[key] if key is not None else [] for key, _, _ in keys]
    edges += [(j, i, weights.same) for i, j in _evidence(nodes, gives, gives).items()]
    similar = _evidence(nodes, [x for _, x, _ in keys], [x for _, _, x in keys])
    return edges + [(j, i, weights.similar) for i, j in similar.items()]


def _evidence(
    nodes: list[_Node], gives: list[list[str]], asks: list[list[str]]
) -> dict[int, int]:
    """For each unobserved node the nearest observed one that gives what it asks for and is of a kind it
    may be."""
    nearest: dict[int, int] = {}
    for order in (range(len(nodes)), range(len(nodes) - 1, -1, -1)):
        seen: dict[tuple[str, int], int] = {}
        for i in order:
            node = nodes[i]
            if node.base >= 0:
                seen.update(((key, node.base), i) for key in gives[i])
                continue
            for key in asks[i]:
                for label in node.may_be:
                    j = seen.get((key, label))
                    if j is not None and (i not in nearest or abs(j - i) < abs(nearest[i] - i)):
                        nearest[i] = j
    return nearest


def _beliefs(
    unary: np.ndarray, known: np.ndarray, edges: list[tuple[int, int, float]], rounds: int
) -> np.ndarray:
    """Loopy sum-product; an edge's potential is `exp(weight)` for equal labels, else 1.

    What `known` nodes send does not depend on what they are sent.
    """
    if not edges:
        return unary
    source = np.array([e[0] for e in edges] + [e[1] for e in edges])
    target = np.array([e[1] for e in edges] + [e[0] for e in edges])
    gain = np.expm1(np.array([e[2] for e in edges] * 2))[:, None]
    back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    fixed = known[source][:, None]
    messages = np.zeros((len(source), unary.shape[1]))
    for _ in range(rounds):
        beliefs = unary.copy()
        np.add.at(beliefs, target, messages)
        out = np.where(fixed, unary[source], beliefs[source] - messages[back])
        out = np.exp(out - out.max(1, keepdims=True))
        new = np.log(out.sum(1, keepdims=True) + gain * out)
        new -= new.max(1, keepdims=True)
        settled = np.abs(new - messages).max() < 1e-4
        messages = 0.5 * messages + 0.5 * new if not settled else new
        if settled:
            break
    beliefs = unary.copy()
    np.add.at(beliefs, target, messages)
    return beliefs


def field(
    text: str, nodes: list[_Node], weights: Weights, model: Model
) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, float]]]:
    """Log potentials of the nodes, which of them are observed, and the edges."""
    unary = np.array([_shape(node, weights, model) for node in nodes])
    return unary, np.array([node.base >= 0 for node in nodes]), _edges(nodes, text, weights)


def find_spans(
    text: str | None,
    weights: Weights = Weights(),
    rounds: int = 1000,
    model: Model = DEFAULT,
    secrets: bool = False,
) -> list[tuple[str, int, int, bool]]:
    """All spans of a text by kind as listed, then start; the last field marks base spans."""
    if not text:
        return []
    base = base_spans(text)
    spans = [(*span, True) for span in base]
    nodes = _nodes(text, base, secrets)
    if any(node.base < 0 for node in nodes):
        unary, known, edges = field(text, nodes, weights, model)
        # Without edges and words nothing speaks for a token but its shape, which is not enough.
        if edges or (unary[~known].argmax(1) > 0).any():
            labels = _beliefs(unary, known, edges, rounds).argmax(1)
            spans += [
                (LABELS[label - 1], node.start, node.end, False)
                for node, label in zip(nodes, labels.tolist())
                if label and node.base < 0
            ]
    return sorted(spans, key=lambda span: (LABELS.index(span[0]), span[1], span[2]))


def with_spans(
    docs: DataFrame,
    text: str = "text",
    into: str = "pii_spans",
    weights: Weights = Weights(),
    model: Model = DEFAULT,
    secrets: bool = False,
) -> DataFrame:
    """Add the column `into`: the spans of personal data in `text`, of secrets too if asked for.

    All rows and columns stay (a column of that name is replaced). Null and empty texts have no
    spans. Rows do not influence each other, so equal rows get equal spans.
    """
    from pyspark.sql import types as T

    kept = docs.drop(into)
    names = kept.columns
    schema = T.StructType([*kept.schema.fields, T.StructField(into, _spans_type())])

    def found_in(x: str | None):
        return find_spans(x, weights, model=model, secrets=secrets)

    def find(batches) -> Iterator:
        import pyarrow as pa

        kind = pa.list_(
            pa.struct(
                [
                    ("kind", pa.string()),
                    ("start", pa.int64()),
                    ("end", pa.int64()),
                    ("base", pa.bool_()),
                ]
            )
        )
        for batch in batches:
            texts = batch.column(names.index(text)).to_pylist()
            found = [
                [dict(zip(("kind", "start", "end", "base"), span)) for span in found_in(x)]
                for x in texts
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, kind)], [*names, into]
            )

    return kept.mapInArrow(find, schema)


def _spans_type():
    from pyspark.sql import types as T

    return T.ArrayType(
        T.StructType(
            [
                T.StructField("kind", T.StringType()),
                T.StructField("start", T.LongType()),
                T.StructField("end", T.LongType()),
                T.StructField("base", T.BooleanType()),
            ]
        )
    )


def redact(
    docs: DataFrame, text: str = "text", model: Model = DEFAULT, secrets: bool = False
) -> DataFrame:
    """Replace every span in `text` by its kind in brackets, as `[EMAIL]`; spans that overlap
    become one, named after the first. All rows and columns stay in place; null and empty texts stay as
    they are, and equal rows stay equal."""
    schema = docs.schema
    at = docs.columns.index(text)

    def replace(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            column = batch.column(at)
            clean = [x if x is None else _redacted(x, model, secrets) for x in column.to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(clean, column.type))
            trim()

    return docs.mapInArrow(replace, schema)


def _redacted(text: str, model: Model, secrets: bool) -> str:
    found = find_spans(text, model=model, secrets=secrets)
    spans = sorted((start, end, kind) for kind, start, end, _ in found)
    if not spans:
        return text
    parts, done = [], 0
    for start, end, kind in spans:
        if start >= done:
            parts += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*parts, text[done:]])
