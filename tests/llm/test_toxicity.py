"""Toxicity against plain versions of its kernel and of its scores."""

import math
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from conftest import SMALL

from tablemill.llm import toxicity
from tablemill.llm.queries import QUERIES

TOKENS = ["moron", "mor-on", "mooron", "stupid", "stu", "äöü", "日本語", "aaaaaaa", "idi0t", "x" * 30, "pathetic"]


def subsequences(token):
    """Weight of every subsequence of three characters, by enumeration."""
    framed, found = f" {token} ", Counter()
    for places in combinations(range(len(framed)), 3):
        span = places[2] - places[0]
        if span < toxicity.REACH:
            found["".join(framed[i] for i in places)] += toxicity.DECAY ** (span - 2)
    return found


def norm(token):
    """All subsequences, equal ones counted apart."""
    spans = (c - a for a, _, c in combinations(range(len(token) + 2), 3) if c - a < toxicity.REACH)
    return math.sqrt(sum(toxicity.DECAY ** (2 * (s - 2)) for s in spans))


def kernel(one, two):
    x, y = subsequences(one), subsequences(two)
    return sum(w * y[s] for s, w in x.items()) / norm(one) / norm(two)


def test_kernel_by_enumeration():
    got = toxicity.kernel_rows(TOKENS, TOKENS)
    assert np.allclose(got, [[kernel(a, b) for b in TOKENS] for a in TOKENS])
    assert np.allclose(got, got.T) and np.linalg.eigvalsh(got).min() > -1e-9


def test_swapped_and_inserted_characters_stay_near():
    for insult, changed in [("moron", "mooron"), ("moron", "mor-on"), ("stupid", "stuupid"), ("idiot", "idioot")]:
        others = [kernel(insult, t) for t in ("table", "window", "green", "standard")]
        assert kernel(insult, changed) > 0.4 > 2 * max(others)


@pytest.fixture(scope="module")
def fitted(spark):
    documents = spark.read.parquet(f"{SMALL}/../sf0.01/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/../sf0.01/labels.parquet")
    texts, values = toxicity.labelled_sample(documents, labels, 2000, 4000, "doc_id", "text", "toxic")
    return texts, values, toxicity.train_toxicity(documents, labels), documents


def plain_weights(model):
    """Weight of every subsequence of a model."""
    n = len(model.alphabet) + 1
    return {
        chr(model.alphabet[ab // n - 1]) + chr(model.alphabet[ab % n - 1]) + chr(model.alphabet[c - 1]): model.weights[row, c]
        for ab, row in enumerate(model.pairs.tolist()) if row for c in range(1, n)
    }


def plain_value(model, weights, token):
    """The best stretch of a token or of its letters, each stretch enumerated by itself."""
    def of(text):
        framed, reach = f" {text} ", toxicity.SPAN + 2
        values = []
        for at in range(max(1, len(framed) - reach + 1)):
            part, total = framed[at : at + reach], 0.0
            for i in range(len(part)):
                for k in range(i + 2, min(i + toxicity.REACH, len(part))):
                    for j in range(i + 1, k):
                        total += toxicity.DECAY ** (k - i - 2) * weights.get(part[i] + part[j] + part[k], 0.0)
            values.append(total / norm("x" * min(len(text), toxicity.SPAN)))
        return max(values) + model.bias

    alike = dict(zip("013457@$!", "oieastasi"))
    letters = "".join(alike.get(c, c) for c in token if c in alike or c.isalpha())
    mixed = not token.isalpha() and any(c.isalpha() for c in token) and len(letters) > 2
    return max(of(token), of(letters)) if mixed else of(token)


def plain_score(model, weights, text):
    """A document's score with one dictionary of subsequences, token by token."""
    values = [plain_value(model, weights, t) for t in toxicity.tokens_of(text)]
    words = text.lower().split()
    unknown = [len(w) > 2 and w not in model.known and w.strip(toxicity.STRIP) not in model.known for w in words]
    pairs = {(i, a, b) for i, (a, b) in enumerate(zip(words, words[1:])) if (unknown[i] or unknown[i + 1])}
    for _, a, b in pairs:
        if a.isalpha() and b.isalpha():
            one, two, both = (plain_value(model, weights, x) for x in (a, b, a + b))
            if both > max(0, one, two):
                values.append(both)
    values.sort(reverse=True)
    positive = [v for v in values if v > 0]
    features = [
        values[0] if values else -1.5, values[1] if len(values) > 1 else -1.5, math.log1p(len(positive)),
        math.log1p(sum(positive)), len(positive) / math.sqrt(len(values)) if values else 0.0,
    ]
    z = sum((f - m) / s * w for f, m, s, w in zip(features, model.mean, model.scale, model.layer)) + model.base
    return 1 / (1 + math.exp(-z))


def test_scores_of_all_documents_by_a_plain_version(spark, fitted):
    _, _, model, _ = fitted
    small = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = spark.createDataFrame(
        [(-1, "you id iot and stu pid mor on"), (-2, "an idi0t, a m-oron " + "moronidiot" * 9), (-3, "日本語 ab c d e f1 " + "x" * 43)],
        "doc_id long, text string",
    )
    both = small.select("doc_id", "text").unionByName(odd)
    got = toxicity.score_toxicity(both, model).collect()
    texts = {r.doc_id: r.text or "" for r in both.collect()}
    weights = plain_weights(model)
    assert len(got) == len(texts) > 50
    for r in got:
        assert r.score == pytest.approx(plain_score(model, weights, texts[r.doc_id]), abs=1e-9)
        assert r.predicted == (r.score >= toxicity.THRESHOLD)


def test_split_swapped_and_hyphenated_insults_score_as_the_insult():
    bad = ["you are an idiot", "what a moron", "so stupid", "idiot and moron", "stupid idiot", "moron"] * 5
    good = ["a fine day", "the window is green", "on the table", "what a day", "so good", "an apple and a pear"] * 15
    model = toxicity.fit(bad + good, [1] * len(bad) + [0] * len(good), 10)
    scorer = toxicity.Scorer(model)
    for text in ("idiot", "id iot", "mor on", "stu pid", "idi0t", "m-oron", "st.upid", "idi" + "iot" * 30):
        assert scorer.values([text])[0].max() > 0, text
    for text in ("a fine on", "the day on table", "green pear 12", "", "x" * 100):
        values = scorer.values([text])[0]
        assert not len(values) or values.max() < 0, text


def test_many_scripts_are_told_apart():
    """Every character of the landmarks counts as itself, however many there are."""
    words = ["".join(chr(0x4E00 + 7 * i + j) for j in range(4)) for i in range(100)]
    texts = words * 3 + [w[::-1] for w in words] * 9
    model = toxicity.fit(texts, [1] * 300 + [0] * 900, 100)
    assert len(model.alphabet) > 300
    scores = toxicity.Scorer(model).score(words + [w[::-1] for w in words])
    assert scores[:100].min() > scores[100:].max()


def test_labels_that_are_held_out_are_never_drawn(spark, fitted):
    import zlib

    texts, values, _, documents = fitted
    labels = spark.read.parquet(f"{SMALL}/../sf0.01/labels.parquet").collect()
    allowed = {r.doc_id: r.toxic for r in labels if r.toxic in (0, 1) and zlib.crc32(str(r.doc_id).encode()) % 3 != 1}
    by_id = {r.doc_id: r.text for r in documents.collect()}
    assert Counter(zip(texts, values)) == Counter((by_id[i], y) for i, y in allowed.items() if by_id.get(i) is not None)


def test_query_on_repeated_and_clashing_rows(spark):
    rows = [(1, "you moron", 0.5), (1, "you moron", 0.5), (None, "you moron", None), (2, None, 1.0), (3, "", 1.0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score double")
    model = toxicity.fit(["you moron", "fine day", "moron there", "good words", "such a moron", "all well"], [1, 0, 1, 0, 1, 0], 10)
    got = toxicity.score_toxicity(frame, model).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == [(False, 1), (False, 1), (False, 2), (False, 3), (True, 0)]
    assert len({r.score for r in got if r.doc_id in (1, None)}) == 1
    assert len({r.score for r in got if r.doc_id in (2, 3)}) == 1
    assert toxicity.score_toxicity(frame.limit(0), model).count() == 0
    assert "op7_toxicity" in QUERIES
