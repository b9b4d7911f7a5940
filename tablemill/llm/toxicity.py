"""Toxicity by a support vector machine over a gap-weighted subsequence kernel.

The kernel of two tokens counts the subsequences of three characters they share, each
weighted by ``DECAY`` to the power of the stretch it spans in either token; stretches
span at most ``REACH`` characters. So a token with a character put into, left out of or
swapped in an insult still shares most of its subsequences. For training, a sentence is its
token nearest to a landmark.

A token with signs or digits among its letters also counts as its letters alone, digits that
look like letters read as such (``idi0t``, ``m-oron``). Where a token stands in no labelled
document, subsequences also run across the blank to its neighbours (``id iot``); such a
pair counts if it says more than its parts. The value of a token is that of
its best stretch of ``SPAN`` characters, wherever it begins; shorter ones are one stretch.

Nyström: ``LANDMARKS`` tokens of the labelled sentences that speak most for a toxic label
span the feature space, whitened by the inverse root of their kernel matrix. A linear
machine is trained on labelled sentences in that space: the sentences of clean documents,
and of each toxic document those its label must stem from, found by two rounds of training
(multiple instances). Its scores of a document's tokens (largest, their sum, how many,
against the length) are turned into a probability by logistic regression on whole
documents.

As the machine is linear in the features, landmarks, whitening and weights fold into one
weight per subsequence; scoring needs no landmark again. Only the fold (a bounded table) goes
to the tasks, and scoring is one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemill.llm.sentencepiece_codec import slices
from tablemill.operators.joins import own_exchange
from tablemill.spec import col

DECAY = 0.7
REACH = 6
LANDMARKS = 160
# Labelled documents of each kind the machine is fitted on at most.
TOXIC_SAMPLE, CLEAN_SAMPLE = 2_000, 4_000
# Clean sentences the machine is trained on at most: those nearest to a landmark.
HARD_SENTENCES = 20_000
THRESHOLD = 0.7
# Tokens remembered by a worker before it starts anew.
REMEMBERED = 200_000
# Labelled texts whose values are computed at once.
TEXTS_AT_ONCE = 500
# Characters of the longest stretch that counts as one.
SPAN = 40
# Characters of texts scored at once.
CHARS_AT_ONCE = 2_000_000

SENTENCE = re.compile(r"[.!?\n]+")
STRIP = "\"'`.,;:!?()[]{}<>|/\\*#$%&+=~^_-"
# Signs that stand for letters.
LOOKALIKES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
# Three positions within REACH of the first: their offsets and the stretch spanned.
SHAPES = [(j, k) for k in range(2, REACH) for j in range(1, k)]


def tokens_of(sentence: str) -> list[str]:
    """Lower-case tokens without outer punctuation; single letters in a row are one token,
    as is a word spelt with blanks."""
    out, spelt = [], []
    for raw in sentence.lower().split():
        token = raw.strip(STRIP)
        if len(token) == 1 and token.isalpha():
            spelt.append(token)
            continue
        if len(spelt) > 2:
            out.append("".join(spelt))
        spelt = []
        if len(token) > 2:
            out.append(token)
    if len(spelt) > 2:
        out.append("".join(spelt))
    return out


def letters_of(token: str) -> str:
    """The letters of a token that has other characters among them, else the token."""
    if token.isalpha() or not any(c.isalpha() for c in token):
        return token
    letters = "".join(c for c in token.translate(LOOKALIKES) if c.isalpha())
    return letters if len(letters) > 2 else token


def neighbours(text: str, known: frozenset[str]) -> list[tuple[str, str]]:
    """Adjacent words of letters with nothing but white space between, one of them unknown.
    Words of one or two letters count as known."""
    raw = text.lower().split()
    new = [i for i, w in enumerate(raw) if w not in known and len(w) > 2 and w.strip(STRIP) not in known]
    found = {}
    for i in new:
        for at in (i - 1, i):
            if 0 <= at < len(raw) - 1 and raw[at].isalpha() and raw[at + 1].isalpha():
                found[at] = raw[at], raw[at + 1]
    return list(found.values())


def subsequences(tokens: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(token number, code, weight) of the subsequences of all tokens, and the norm of
    every token. Codes hold three code points; a token is framed by one blank each side."""
    texts = [f" {t} " for t in tokens]
    sizes = np.array([len(t) for t in texts], np.int64)
    chars = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(chars))
    who, codes, weights = [], [], []
    for j, k in SHAPES:
        at = np.flatnonzero(left > k)
        who.append(owner[at])
        codes.append((chars[at] << 42) | (chars[at + j] << 21) | chars[at + k])
        weights.append(np.full(len(at), DECAY ** (k - 2)))
    who, codes, weights = np.concatenate(who), np.concatenate(codes), np.concatenate(weights)
    return who, codes, weights, norms_of(sizes - 2)


def norms_of(sizes: np.ndarray) -> np.ndarray:
    """Norm of tokens by length: all their subsequences, equal ones counted apart."""
    square = sum(np.maximum(0, sizes + 2 - k) * DECAY ** (2 * (k - 2)) for _, k in SHAPES)
    return np.sqrt(np.maximum(square, 1e-18))


@dataclass
class Model:
    """Weights of subsequences of three characters out of ``alphabet`` (sorted code points of the
    landmarks; number 0 is any other character, which has none), by the row in ``pairs`` of the
    first two and the number of the third; the tokens of the labelled documents; and the logistic layer over documents."""

    alphabet: np.ndarray
    pairs: np.ndarray
    weights: np.ndarray
    bias: float
    known: frozenset[str]
    mean: np.ndarray
    scale: np.ndarray
    layer: np.ndarray
    base: float

    def token_scores(self, tokens: list[str]) -> np.ndarray:
        """Decision value of every token, or of its letters if that is larger."""
        letters = [letters_of(t) for t in tokens]
        other = [i for i, t in enumerate(tokens) if letters[i] != t]
        values = self.stretch_scores(tokens)
        if other:
            values[other] = np.maximum(values[other], self.stretch_scores([letters[i] for i in other]))
        return values

    def stretch_scores(self, tokens: list[str]) -> np.ndarray:
        """Decision value of the best stretch of every token."""
        if not tokens or not len(self.alphabet):
            return np.full(len(tokens), self.bias)
        sizes = np.array([len(t) for t in tokens], np.int64)
        chars = np.frombuffer("".join(f" {t} " for t in tokens).encode("utf-32-le"), np.uint32)
        place = np.minimum(np.searchsorted(self.alphabet, chars), len(self.alphabet) - 1)
        number = np.where(self.alphabet[place] == chars, place + 1, 0)
        n = len(self.alphabet) + 1
        # A subsequence must not reach into the next token.
        left = np.repeat(np.cumsum(sizes + 2), sizes + 2) - np.arange(len(chars))
        by_reach = {k: np.zeros(len(chars)) for k in range(2, REACH)}
        for j, k in SHAPES:
            if len(chars) > k:
                m = len(chars) - k
                row = self.pairs[number[:m] * n + number[j : j + m]]
                by_reach[k][:m] += self.weights[row, number[k:]] * (DECAY ** (k - 2) * (left[:m] > k))
        begin = np.concatenate([[0], np.cumsum(sizes + 2)[:-1]])
        values = np.add.reduceat(sum(by_reach.values()), begin) / norms_of(np.minimum(sizes, SPAN))
        for i in np.flatnonzero(sizes > SPAN):
            count = int(sizes[i]) - SPAN + 1
            sums = np.zeros(count)
            for k, total in by_reach.items():
                upto = np.concatenate([[0.0], np.cumsum(total[begin[i] : begin[i] + sizes[i] + 2])])
                sums += upto[SPAN + 2 - k :][:count] - upto[:count]
            values[i] = sums.max() / norms_of(np.array([SPAN]))[0]
        return values + self.bias

    def score(self, features: np.ndarray) -> np.ndarray:
        z = ((features - self.mean) / self.scale) @ self.layer + self.base
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def document_features(values: np.ndarray) -> list[float]:
    """What the logistic layer sees of the decision values of a document's tokens."""
    n = len(values)
    if n == 0:
        return [-1.5, -1.5, 0.0, 0.0, 0.0]
    top = np.sort(values)[::-1]
    positive = top[top > 0]
    return [
        float(top[0]), float(top[1]) if n > 1 else -1.5,
        float(np.log1p(len(positive))), float(np.log1p(positive.sum())),
        float(len(positive) / np.sqrt(n)),
    ]


class Scorer:
    """Scores of whole texts; decision values of tokens are remembered."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def values(self, texts: list[str]) -> list[np.ndarray]:
        """Values of the tokens of each text, then those of neighbours that say more together."""
        split = [tokens_of(x) for x in texts]
        pairs = [neighbours(x, self.model.known) for x in texts]
        every = {t for x in split for t in x}
        for x in pairs:
            for a, b in x:
                every.update((a, b, a + b))
        fresh = list(every.difference(self.known))
        if len(self.known) + len(fresh) > REMEMBERED:
            self.known, fresh = {}, list(every)
        for start in range(0, len(fresh), 5000):
            part = fresh[start : start + 5000]
            self.known.update(zip(part, self.model.token_scores(part).tolist()))
        value = self.known
        together = [[v for a, b in x if (v := value[a + b]) > max(0.0, value[a], value[b])] for x in pairs]
        return [np.array([value[t] for t in x] + more) for x, more in zip(split, together)]

    def score(self, texts: list[str]) -> np.ndarray:
        return self.model.score(np.array([document_features(v) for v in self.values(texts)]).reshape(-1, 5))


def kernel_rows(tokens: list[str], landmarks: list[str]) -> np.ndarray:
    """Kernel between tokens and landmarks, each of norm one."""
    who, codes, weights, norms = subsequences(landmarks)
    order = np.unique(codes)
    table = np.zeros((len(order), len(landmarks)))
    np.add.at(table, (np.searchsorted(order, codes), who), weights / norms[who])
    out = np.zeros((len(tokens), len(landmarks)))
    for start in range(0, len(tokens), 500):
        part = tokens[start : start + 500]
        who, codes, weights, norms = subsequences(part)
        place = np.minimum(np.searchsorted(order, codes), len(order) - 1)
        hit = np.flatnonzero(order[place] == codes)
        hit = hit[np.argsort(who[hit], kind="stable")]
        if len(hit):
            rows = table[place[hit]] * weights[hit][:, None]
            first = np.flatnonzero(np.diff(who[hit], prepend=-1))
            out[start + who[hit][first]] = np.add.reduceat(rows, first) / norms[who[hit][first]][:, None]
    return out


def linear_machine(
    x: np.ndarray, y: np.ndarray, times: np.ndarray, rounds: int = 300, strength: float = 1e-3
):
    """Weights and bias of a linear machine by full-batch descent on the squared hinge;
    rows count ``times`` times, both classes weigh the same."""
    share = 0.5 * times / np.where(y > 0, times[y > 0].sum(), times[y < 0].sum())
    w, b = np.zeros(x.shape[1]), 0.0
    step = 1.0 / (2 * (np.linalg.norm(x, axis=1) ** 2).max() + 2 + strength)
    vw, vb = w.copy(), b
    for i in range(rounds):
        pull = share * y * np.maximum(0, 1 - y * (x @ vw + vb)) * 2
        nw, nb = vw + step * (x.T @ pull - strength * vw), vb + step * pull.sum()
        m = i / (i + 3)
        vw, vb, w, b = nw + m * (nw - w), nb + m * (nb - b), nw, nb
    return w, b


def logistic_layer(x: np.ndarray, y: np.ndarray, rounds: int = 50, strength: float = 1.0):
    """Newton steps on standardised features; y is 0 or 1."""
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    ridge = np.append(np.full(x.shape[1], strength), 1e-6)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge)
        w = w + np.linalg.solve(h, z.T @ (y - p) - ridge * w)
    return mean, scale, w[:-1], float(w[-1])


def choose_landmarks(documents: list[list[list[str]]], labels: np.ndarray, most: int) -> list[str]:
    """Tokens by the evidence of their presence for a toxic label: the log-likelihood
    ratio of documents with and without it, ties by token."""
    with_token, toxic_with = Counter(), Counter()
    for sentences, label in zip(documents, labels):
        for token in {t for s in sentences for t in s}:
            with_token[token] += 1
            toxic_with[token] += int(label)
    n, t = len(labels), int(labels.sum())

    def part(k: float, m: float, p: float) -> float:
        return (k * np.log(k / (m * p)) if k else 0.0) + ((m - k) * np.log((m - k) / (m * (1 - p))) if m > k else 0.0)

    ranked = []
    for token, m in with_token.items():
        k = toxic_with[token]
        if k >= 3 and k * n > 2 * m * t:
            ranked.append((-part(k, m, t / n), token))
    return [token for _, token in sorted(ranked)[:most]]


def fit(texts: list[str], labels: list[int], landmarks: int = LANDMARKS) -> Model:
    """A model from labelled whole texts. Without both labels or any telling token all
    texts get the share of toxic labels."""
    y = np.asarray(labels, np.int64)
    shared: dict[str, str] = {}
    documents = [
        [[shared.setdefault(t, t) for t in s] for s in map(tokens_of, SENTENCE.split(x)) if s] for x in texts
    ]
    marks = choose_landmarks(documents, y, landmarks) if 0 < y.sum() < len(y) else []
    if not marks:
        share = float(y.mean()) if len(y) else 0.0
        base = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
        nothing = np.empty(0, np.int64), np.zeros(1, np.int64), np.zeros((1, 1))
        return Model(*nothing, -1.0, frozenset(), np.zeros(5), np.ones(5), np.zeros(5), base)
    known = frozenset(shared)
    gram = kernel_rows(marks, marks)
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    # The token of a sentence nearest to any landmark stands for it.
    vocabulary = sorted(shared)
    number = {t: i for i, t in enumerate(vocabulary)}
    closest = np.concatenate([
        kernel_rows(vocabulary[i : i + 5000], marks).max(1) for i in range(0, len(vocabulary), 5000)
    ])
    stands, owners = [], []
    for d, document in enumerate(documents):
        for s in document:
            ids = [number[t] for t in s]
            stands.append(ids[int(np.argmax(closest[ids]))])
            owners.append(d)
    stands, owners = np.array(stands), np.array(owners)
    del documents, shared
    toxic = y[owners] == 1
    clean, clean_times = np.unique(stands[~toxic], return_counts=True)
    hard = np.argsort(-closest[clean], kind="stable")[:HARD_SENTENCES]
    clean, clean_times = clean[hard], clean_times[hard]
    used = np.unique(np.r_[stands[toxic], clean])
    space = kernel_rows([vocabulary[i] for i in used], marks) @ root
    theirs, of = np.searchsorted(used, stands[toxic]), owners[toxic]
    negative = np.searchsorted(used, clean)
    # At first a sentence speaks for its label by its token alone.
    value = np.where(np.isin(used, [number[m] for m in marks]), closest[used], closest[used] - 1)
    for _ in range(3):
        best = np.full(len(y), -np.inf)
        np.maximum.at(best, of, value[theirs])
        positive, times = np.unique(theirs[(value[theirs] > 0) | (value[theirs] == best[of])], return_counts=True)
        w, b = linear_machine(
            space[np.r_[positive, negative]],
            np.r_[np.ones(len(positive)), -np.ones(len(negative))],
            np.r_[times, clean_times].astype(float),
        )
        value = space @ w + b
    model = fold(marks, root @ w, float(b), known)
    scorer = Scorer(model)
    features = np.array([
        document_features(v) for i in range(0, len(texts), TEXTS_AT_ONCE) for v in scorer.values(texts[i : i + TEXTS_AT_ONCE])
    ]).reshape(-1, 5)
    model.mean, model.scale, model.layer, model.base = logistic_layer(features, y)
    return model


def fold(marks: list[str], alpha: np.ndarray, bias: float, known: frozenset[str]) -> Model:
    """Landmarks and their weights as one weight per subsequence."""
    alphabet = np.unique(np.array([ord(c) for m in marks for c in f" {m} "], np.int64))
    n = len(alphabet) + 1
    who, codes, weights, norms = subsequences(marks)
    one, two, three = (np.searchsorted(alphabet, (codes >> shift) & ((1 << 21) - 1)) + 1 for shift in (42, 21, 0))
    used, row = np.unique(one * n + two, return_inverse=True)
    pairs = np.zeros(n * n, np.int64)
    pairs[used] = np.arange(1, len(used) + 1)
    folded = np.zeros((len(used) + 1, n))
    np.add.at(folded, (row + 1, three), alpha[who] * weights / norms[who])
    return Model(alphabet, pairs, folded, bias, known, np.zeros(5), np.ones(5), np.zeros(5), 0.0)


def labelled_sample(
    documents: DataFrame, labels: DataFrame, toxic: int, clean: int, id_column: str, text_column: str, label: str
) -> tuple[list[str], list[int]]:
    """Up to so many labelled texts of each kind, drawn by a hash of the id; rows held out
    (crc32 of the id modulo 3 is 1) and null labels or texts are never drawn."""
    known = labels.where(col(label).isin(0, 1) & col(id_column).isNotNull()).where(~held_out(id_column))
    known = known.groupBy(col(id_column).alias("__doc")).agg(F.max(col(label).cast("int")).alias("__y"))
    texts, values = [], []
    for y, most in ((1, toxic), (0, clean)):
        drawn = known.where(F.col("__y") == y).orderBy(F.xxhash64("__doc"), "__doc").limit(most)
        rows = (
            documents.select(col(id_column).alias("doc"), col(text_column).alias("t")).where("t is not null")
            .join(own_exchange(drawn), F.col("doc") == F.col("__doc"))
            .groupBy("doc").agg(F.min("t").alias("t")).orderBy("doc").toPandas()
        )
        texts += rows["t"].tolist()
        values += [y] * len(rows)
    return texts, values


def held_out(id_column: str):
    return F.coalesce(F.crc32(col(id_column).cast("string")) % 3 == 1, F.lit(False))


def score_toxicity(
    documents: DataFrame,
    model: Model,
    id_column: str = "doc_id",
    text_column: str = "text",
    threshold: float = THRESHOLD,
    keep: list[str] | None = None,
) -> DataFrame:
    """Id (or the columns of ``keep``), ``score`` and ``predicted`` of every row by its
    whole text alone; a null text scores as an empty one. Repeated rows and null ids stay;
    other columns are not read."""
    names = list(keep or [id_column])
    if text_column not in names:
        names.append(text_column)
    taken = [n for n in names if n != text_column or text_column in (keep or [])]
    whole = documents.select([col(n).alias(f"c{i}") for i, n in enumerate(names)])
    schema = whole.select([f"c{names.index(n)}" for n in taken]).schema.add("score", "double").add("predicted", "integer")

    def run(batches):
        scorer = Scorer(model)
        for batch in batches:
            for part in slices(batch, names.index(text_column), CHARS_AT_ONCE):
                score = scorer.score([t or "" for t in part.column(names.index(text_column)).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(names.index(n)) for n in taken), pa.array(score),
                     pa.array((score >= threshold).astype(np.int32))],
                    names=schema.names,
                )

    scored = whole.mapInArrow(run, schema)
    renamed = [F.col(f"c{names.index(n)}").alias(n) for n in taken]
    return scored.select(*renamed, "score", "predicted")


def train_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    toxic: int = TOXIC_SAMPLE,
    clean: int = CLEAN_SAMPLE,
    landmarks: int = LANDMARKS,
    id_column: str = "doc_id",
    text_column: str = "text",
    label: str = "toxic",
) -> Model:
    return fit(*labelled_sample(documents, labels, toxic, clean, id_column, text_column, label), landmarks)
