"""Toxicity scores by a bidirectional gated recurrent network with attention pooling.

Characters of a word run through a two-way GRU and are pooled by attention; with
the word's own embedding, if training knew it, they make its vector. The words
of a window run through a second such layer, whose pooled state gives the
window's score. Windows overlap by half, and all of a text's windows are scored.
The highest window scores of a text and their number make its probability.

The network is trained in numpy on a bounded sample of labelled documents, one
layer after the other: the lower one on the words of the sample, to tell how
often a document with the word is toxic, the upper one on all windows. Three
quarters of the sample set the weights, the held-back quarter the final
probability and the end of the training.
"""

from __future__ import annotations

import hashlib
import logging
import pickle
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

WINDOW = 32
STRIDE = 16
LETTERS = 20
#: Labelled documents of each class that training may use.
SAMPLE = 800
#: Words that get an embedding of their own, and the least number of documents they are in.
VOCABULARY, WORD_DOCS = 20_000, 3
THRESHOLD = 0.7
#: Words that are scored at a time.
BATCH_WORDS = 400_000
#: Epochs at most, epochs without a better held-back loss that end training, weight of toxic windows.
EPOCHS, PATIENCE, TOXIC_PART = 8, 2, 0.375
#: Rate of the optimizer, halved by each epoch that brings nothing.
RATE = 0.03
#: Epochs over the words, documents that a word must be in, share of words seen by their letters alone.
WORD_EPOCHS, WORD_LEAST, BY_LETTERS = 8, 2, 0.5
#: Words whose projected vectors a worker keeps.
KEPT_WORDS = 150_000
_PIECE_CHARS = 1_000_000
_models: dict[str, Network] = {}
_WORD = re.compile(r"\w+")
_CHARS, _CHAR_DIM, _WORD_DIM, _HIDDEN = 512, 8, 8, 8


def words_of(text: str) -> list[str]:
    """Lower-case words; those of more than LETTERS letters come in pieces."""
    words = _WORD.findall(text.lower())
    if words and max(map(len, words)) > LETTERS:
        words = [w[i : i + LETTERS] for w in words for i in range(0, len(w), LETTERS)]
    return words


def word_pieces(text: str | None) -> Iterator[list[str]]:
    """The words of a text in lists of bounded size that overlap like windows do."""
    text, start, carried = text or "", 0, []
    while True:
        stop = start + _PIECE_CHARS
        if stop < len(text):
            gap = re.compile(r"\s").search(text, stop)
            stop = gap.start() if gap else len(text)
        words = carried + words_of(text[start:stop])
        yield words
        if stop >= len(text):
            return
        start, carried = stop, words[-(WINDOW - STRIDE) :]


def window_starts(n: int) -> np.ndarray:
    """Starts of the windows over n words; at least one, and the last words are covered."""
    if n <= WINDOW:
        return np.zeros(1, "i8")
    starts = np.arange(0, n - WINDOW + STRIDE, STRIDE)
    return np.minimum(starts, n - WINDOW)


def letters_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters as rows (letter, word) and a mask of the same shape."""
    lengths = np.fromiter(map(len, words), "i8", len(words))
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    flat = np.where(flat < 384, flat, 384 + flat % 128)
    width = int(lengths.max(initial=1))
    mask = np.arange(width)[:, None] < lengths[None, :]
    letters = np.zeros((width, len(words)), "i4")
    letters.T[mask.T] = flat
    return letters, mask


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def gru(x: np.ndarray, mask: np.ndarray, u: np.ndarray, trace: list | None = None) -> np.ndarray:
    """States (time, batch, h) of a GRU over projected inputs (time, batch, 3 h)."""
    steps, batch, width = x.shape
    h = width // 3
    state, states = np.zeros((batch, h), x.dtype), np.empty((steps, batch, h), x.dtype)
    for t in range(steps):
        inner = state @ u
        gates = sigmoid(x[t, :, : 2 * h] + inner[:, : 2 * h])
        z, r = gates[:, :h], gates[:, h:]
        new = np.tanh(x[t, :, 2 * h :] + r * inner[:, 2 * h :])
        after = new + z * (state - new)
        if trace is not None:
            trace.append((z, r, new, state, inner[:, 2 * h :]))
        state = np.where(mask[t][:, None], after, state)
        states[t] = state
    return states


def gru_back(grad: np.ndarray, mask: np.ndarray, u: np.ndarray, trace: list):
    """Gradients of the projected inputs and of ``u``."""
    steps, batch, h = grad.shape
    dx, du = np.zeros((steps, batch, 3 * h), grad.dtype), np.zeros_like(u)
    carry = np.zeros((batch, h), grad.dtype)
    for t in range(steps - 1, -1, -1):
        z, r, new, before, inner = trace[t]
        total = grad[t] + carry
        mine = np.where(mask[t][:, None], total, 0)
        dnew = mine * (1 - z) * (1 - new * new)
        dz = mine * (before - new) * z * (1 - z)
        dr = dnew * inner * r * (1 - r)
        back = np.concatenate([dz, dr, dnew * r], axis=1)
        du += before.T @ back
        carry = total - mine + mine * z + back @ u.T
        dx[t] = np.concatenate([dz, dr, dnew], axis=1)
    return dx, du


class Layer:
    """Two-way GRU with attention pooling; ``p`` holds its weights under a prefix."""

    def __init__(self, p: dict[str, np.ndarray], name: str):
        self.p, self.name = p, name

    def __getattr__(self, key: str) -> np.ndarray:
        return self.p[f"{self.name}_{key}"]

    @staticmethod
    def create(p: dict, name: str, inputs: int, rng: np.random.Generator) -> None:
        h = _HIDDEN
        for key, shape in {
            "w": (inputs, 6 * h), "u1": (h, 3 * h), "u2": (h, 3 * h), "a": (2 * h, h), "v": (h, 1)
        }.items():
            p[f"{name}_{key}"] = (rng.standard_normal(shape) / np.sqrt(shape[0])).astype("f4")
        p[f"{name}_b"] = np.zeros(6 * h, "f4")
        p[f"{name}_c"] = np.zeros(h, "f4")

    def project(self, x: np.ndarray) -> np.ndarray:
        return x @ self.w + self.b

    def pooled(self, x: np.ndarray, mask: np.ndarray, trace: dict | None = None) -> np.ndarray:
        """Pooled states (batch, 2 h) of projected inputs (time, batch, 6 h)."""
        h3 = x.shape[2] // 2
        one, two = ([], []) if trace is not None else (None, None)
        ahead = gru(x[:, :, :h3], mask, self.u1, one)
        back = gru(x[::-1, :, h3:], mask[::-1], self.u2, two)[::-1]
        states = np.concatenate([ahead, back], axis=2)
        inner = np.tanh(states @ self.a + self.c)
        marks = np.where(mask, (inner @ self.v)[:, :, 0], -1e9)
        shares = np.exp(marks - marks.max(axis=0))
        shares = np.where(mask, shares, 0)
        shares /= np.maximum(shares.sum(axis=0), 1e-9)
        if trace is not None:
            trace.update(one=one, two=two, states=states, inner=inner, shares=shares, mask=mask)
        return np.einsum("tb,tbd->bd", shares, states)

    def back(self, grad: np.ndarray, trace: dict, g: dict) -> np.ndarray:
        """Gradient of the projected inputs; those of the weights are added to ``g``."""
        states, inner, shares, mask = (trace[k] for k in ("states", "inner", "shares", "mask"))
        dshares = np.einsum("tbd,bd->tb", states, grad)
        dmarks = shares * (dshares - (shares * dshares).sum(axis=0))
        dinner = dmarks[:, :, None] * self.v[:, 0] * (1 - inner * inner)
        dstates = shares[:, :, None] * grad[None] + dinner @ self.a.T
        n, h = self.name, _HIDDEN
        g[f"{n}_v"] = np.einsum("tbh,tb->h", inner, dmarks)[:, None]
        g[f"{n}_a"] = np.einsum("tbd,tbh->dh", states, dinner)
        g[f"{n}_c"] = dinner.sum(axis=(0, 1))
        dx1, g[f"{n}_u1"] = gru_back(dstates[:, :, :h], mask, self.u1, trace["one"])
        dx2, g[f"{n}_u2"] = gru_back(dstates[::-1, :, h:], mask[::-1], self.u2, trace["two"])
        return np.concatenate([dx1, dx2[::-1]], axis=2)


class Network:
    """Weights, vocabulary and scoring."""

    def __init__(self, vocabulary: dict[str, int], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.vocabulary = vocabulary  # word -> row, 0 for any other
        p: dict[str, np.ndarray] = {}
        p["letters"] = (0.3 * rng.standard_normal((_CHARS, _CHAR_DIM))).astype("f4")
        p["words"] = (0.1 * rng.standard_normal((len(vocabulary) + 1, _WORD_DIM))).astype("f4")
        p["words"][0] = 0
        Layer.create(p, "low", _CHAR_DIM, rng)
        Layer.create(p, "high", 2 * _HIDDEN + _WORD_DIM, rng)
        p["out"], p["bias"] = np.zeros((2 * _HIDDEN, 1), "f4"), np.zeros(1, "f4")
        p["word_out"] = (0.3 * rng.standard_normal((2 * _HIDDEN + _WORD_DIM, 1))).astype("f4")
        p["word_bias"] = np.zeros(1, "f4")
        self.p = p
        self.final = np.array([1.0, 0.0, 0.0, 0.0])
        self.token = ""
        self.kept: dict[str, int] = {}
        self.kept_inputs = np.zeros((0, 6 * _HIDDEN), "f4")

    def rows(self, words: list[str]) -> np.ndarray:
        return np.array([self.vocabulary.get(w, 0) for w in words], "i8")

    def vectors(self, words: list[str]) -> np.ndarray:
        """Pooled letters of each word, then its own embedding."""
        low, result = Layer(self.p, "low"), np.zeros((len(words), 2 * _HIDDEN + _WORD_DIM), "f4")
        order = np.argsort([len(w) for w in words], kind="stable")
        projected = low.project(self.p["letters"])
        for start in range(0, len(words), 8192):
            rows = order[start : start + 8192]
            some = [words[i] for i in rows]
            letters, mask = letters_of(some)
            pooled = low.pooled(projected[letters], mask)
            result[rows] = np.concatenate([pooled, self.p["words"][self.rows(some)]], axis=1)
        return result

    def projected(self, words: list[str]) -> np.ndarray:
        """Inputs of the upper layer for each word; those of words met before are kept."""
        new = [w for w in words if w not in self.kept]
        if len(self.kept) + len(new) > KEPT_WORDS:
            self.forget()
            new = words
        if new:
            inputs = Layer(self.p, "high").project(self.vectors(new))
            self.kept.update(zip(new, range(len(self.kept), len(self.kept) + len(new)), strict=True))
            self.kept_inputs = np.concatenate([self.kept_inputs, inputs])
        return self.kept_inputs[np.fromiter(map(self.kept.__getitem__, words), "i8", len(words))]

    def forget(self) -> None:
        self.kept, self.kept_inputs = {}, np.zeros((0, 6 * _HIDDEN), "f4")

    def window_scores(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Scores of all windows of each list of words."""
        known: dict[str, int] = {}
        codes = [
            np.array([known.setdefault(w, len(known)) for w in words], "i8") for words in texts
        ]
        return self.coded_scores(list(known), codes)

    def coded_scores(self, words: list[str], codes: list[np.ndarray]) -> list[np.ndarray]:
        """Scores of all windows of each list of codes into the list of words."""
        codes = [c if len(c) else np.full(1, -1) for c in codes]
        inputs = np.concatenate([self.projected(words), np.zeros((1, 6 * _HIDDEN), "f4")])
        starts = [window_starts(len(c)) for c in codes]
        at = np.cumsum([0, *(len(c) for c in codes)])[:-1]
        lengths = np.concatenate(
            [np.minimum(WINDOW, len(c) * (c[0] >= 0)) + 0 * s for c, s in zip(codes, starts, strict=True)]
        )
        flat = np.concatenate([*codes, np.full(WINDOW, -1)])
        first = np.concatenate([s + a for s, a in zip(starts, at, strict=True)])
        high, scores = Layer(self.p, "high"), np.empty(len(first), "f4")
        step = np.arange(WINDOW)[:, None]
        for start in range(0, len(first), 4096):
            some = slice(start, start + 4096)
            mask = step < lengths[some][None, :]
            index = np.where(mask, flat[first[some][None, :] + step], -1)
            pooled = high.pooled(inputs[index], mask)
            scores[some] = (pooled @ self.p["out"] + self.p["bias"])[:, 0]
        return np.split(scores, np.cumsum([len(s) for s in starts])[:-1])

    @staticmethod
    def summary(scores: np.ndarray) -> np.ndarray:
        """What the final probability looks at: two highest windows and their number."""
        top = np.sort(np.partition(scores, -min(2, len(scores)))[-2:])[::-1]
        return np.array([top[0], top[-1], np.log(len(scores)), 1.0])

    def summaries(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros((len(texts), 4))
        lists, owners, size = [], [], 0
        best: dict[int, list[np.ndarray]] = {}

        def settle() -> None:
            nonlocal lists, owners, size
            if lists:
                for owner, scores in zip(owners, self.window_scores(lists), strict=True):
                    best.setdefault(owner, []).append(scores)
            lists, owners, size = [], [], 0

        for number, text in enumerate(texts):
            for words in word_pieces(text):
                lists.append(words)
                owners.append(number)
                size += len(words)
                if size >= BATCH_WORDS:
                    settle()
        settle()
        for number, parts in best.items():
            out[number] = self.summary(np.concatenate(parts))
        return out

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.summaries(texts) @ self.final, -50, 50)))


class Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float):
        self.p, self.rate, self.t = p, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.s = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, g: dict[str, np.ndarray]) -> None:
        self.t += 1
        norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
        scale = min(1.0, 1.0 / (norm + 1e-9))
        for k, grad in g.items():
            grad = grad * scale
            self.m[k] += 0.1 * (grad - self.m[k])
            self.s[k] += 0.01 * (grad * grad - self.s[k])
            m = self.m[k] / (1 - 0.9**self.t)
            s = self.s[k] / (1 - 0.99**self.t)
            self.p[k] -= (self.rate * m / (np.sqrt(s) + 1e-8)).astype("f4")


def _losses(chance: np.ndarray, target: np.ndarray, weight: np.ndarray) -> float:
    eps = 1e-7
    return float(-(weight * (target * np.log(chance + eps) + (1 - target) * np.log(1 - chance + eps))).mean())


def _word_step(
    net: Network, adam: Adam, words: list[str], target: np.ndarray, weight: np.ndarray, rng: np.random.Generator
) -> float:
    """One update of the lower layer: from a word's letters and embedding to its target."""
    p, low, trace = net.p, Layer(net.p, "low"), {}
    letters, mask = letters_of(words)
    embedded = p["letters"][letters]
    pooled = low.pooled(low.project(embedded), mask, trace)
    rows = net.rows(words) * (rng.random(len(words)) >= BY_LETTERS)
    vectors = np.concatenate([pooled, p["words"][rows]], axis=1)
    chance = sigmoid((vectors @ p["word_out"] + p["word_bias"])[:, 0])
    dlogit = (weight * (chance - target) / len(target)).astype("f4")[:, None]
    g = {"word_out": vectors.T @ dlogit, "word_bias": dlogit.sum(axis=0)}
    dvectors = dlogit @ p["word_out"].T
    g["words"] = np.zeros_like(p["words"])
    np.add.at(g["words"], rows, dvectors[:, 2 * _HIDDEN :])
    g["words"][0] = 0
    dletters = low.back(dvectors[:, : 2 * _HIDDEN], trace, g)
    flat = dletters.reshape(-1, dletters.shape[2])
    g["low_w"] = embedded.reshape(-1, _CHAR_DIM).T @ flat
    g["low_b"] = flat.sum(axis=0)
    g["letters"] = np.zeros_like(p["letters"])
    np.add.at(g["letters"], letters.ravel(), flat @ p["low_w"].T)
    adam.step(g)
    return _losses(chance, target, weight)


def _train_step(
    net: Network, adam: Adam, vectors: np.ndarray, codes: np.ndarray, mask: np.ndarray,
    target: np.ndarray, weight: np.ndarray, rng: np.random.Generator,
) -> float:
    """One update of the upper layer on windows: codes and mask (time, batch) into the words' vectors."""
    p, high, trace = net.p, Layer(net.p, "high"), {}
    used, inverse = np.unique(codes, return_inverse=True)
    inverse = inverse.reshape(codes.shape)
    some = vectors[used]
    some[rng.random(len(used)) >= 0.7, 2 * _HIDDEN :] = 0  # so letters count as well
    states = high.pooled(high.project(some)[inverse], mask, trace)
    chance = sigmoid((states @ p["out"] + p["bias"])[:, 0])
    dlogit = (weight * (chance - target) / len(target)).astype("f4")[:, None]
    g = {"out": states.T @ dlogit, "bias": dlogit.sum(axis=0)}
    dx = high.back(dlogit @ p["out"].T, trace, g)
    dprojected = np.zeros((len(used), dx.shape[2]), "f4")
    np.add.at(dprojected, inverse.ravel(), dx.reshape(-1, dx.shape[2]))
    g["high_w"], g["high_b"] = some.T @ dprojected, dprojected.sum(axis=0)
    adam.step(g)
    return _losses(chance, target, weight)


class Corpus:
    """Texts as codes of their words: all pieces of each text and all windows of each piece."""

    def __init__(self, texts: list[str | None]):
        known: dict[str, int] = {}
        self.codes: list[np.ndarray] = []
        owners = []
        for number, text in enumerate(texts):
            for words in word_pieces(text):
                coded = (known.setdefault(w, len(known)) for w in words)
                self.codes.append(np.fromiter(coded, "i4", len(words)))
                owners.append(number)
        self.owners, self.words = np.array(owners, "i8"), list(known)

    def pieces(self, chosen: np.ndarray) -> np.ndarray:
        """Numbers of the pieces of chosen texts."""
        return np.flatnonzero(chosen[self.owners])

    def windows(self, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece and first word of every window of pieces, in the order in which they are scored."""
        starts = [window_starts(len(self.codes[n])) for n in pieces]
        return np.repeat(pieces, [len(s) for s in starts]), np.concatenate([*starts, np.zeros(0, "i8")])

    def scores(self, net: Network, pieces: np.ndarray) -> np.ndarray:
        """Scores of all windows of pieces."""
        if not len(pieces):
            return np.zeros(0, "f4")
        net.forget()
        return np.concatenate(net.coded_scores(self.words, [self.codes[n] for n in pieces]))

    def summaries(self, net: Network, chosen: np.ndarray) -> np.ndarray:
        """What the final probability looks at, for each chosen text in order."""
        pieces = self.pieces(chosen)
        owner = self.owners[self.windows(pieces)[0]]
        cuts = np.flatnonzero(np.diff(owner)) + 1
        return np.array([net.summary(part) for part in np.split(self.scores(net, pieces), cuts)])


def held_back(toxic: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A quarter of each class, at least one text where it has two."""
    back = np.zeros(len(toxic), bool)
    for value in (0, 1):
        rows = rng.permutation(np.flatnonzero(toxic == value))
        back[rows[: max(len(rows) // 4, int(len(rows) > 1))]] = True
    return back


def likely_toxic(owner: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Of all windows of toxic texts those that look toxic, and the highest of each text."""
    best = pd.Series(scores).groupby(owner).transform("max").to_numpy()
    return (scores >= best) | (scores > 0)


def fit_final(features: np.ndarray, target: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, drawn to the highest window's score as it is."""
    start = np.array([1.0, 0.0, 0.0, 0.0])
    ridge = np.diag([0.5, 0.5, 0.5, 0.05])

    def loss(theta: np.ndarray) -> float:
        logits, apart = features @ theta, theta - start
        return float((weight * (np.logaddexp(0, logits) - target * logits)).sum() + apart @ ridge @ apart / 2)

    theta, now = start, loss(start)
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(features @ theta, -50, 50)))
        slope = features.T @ (weight * (chance - target)) + ridge @ (theta - start)
        curve = (features.T * (weight * chance * (1 - chance))) @ features + ridge
        step = np.linalg.solve(curve, slope)
        while (after := loss(theta - step)) > now and np.abs(step).max() > 1e-6:
            step = step / 2
        if after >= now:
            break
        theta, now = theta - step, after
    return theta


def documents_with(corpus: Corpus, pieces: np.ndarray) -> np.ndarray:
    """In how many of the texts of ``pieces`` each word of the corpus is."""
    last, seen = np.full(len(corpus.words), -1, "i8"), np.zeros(len(corpus.words), "i8")
    for n in pieces:
        codes = np.unique(corpus.codes[n])
        fresh = codes[last[codes] != corpus.owners[n]]
        last[fresh] = corpus.owners[n]
        seen[fresh] += 1
    return seen


def train_words(
    net: Network, words: list[str], in_toxic: np.ndarray, in_clean: np.ndarray, share: float,
    rng: np.random.Generator, epochs: int = WORD_EPOCHS,
) -> np.ndarray:
    """Train the lower layer; returned is how toxic it takes each word to be, as a logit.

    A word's target is the share of toxic texts among those that it is in, drawn
    a little to the ``share`` among all. Words in few texts say little and weigh
    little; the letters they have in common with others say more.
    """
    found = in_toxic + in_clean
    target = ((in_toxic + 2 * share) / (found + 2)).astype("f4")
    weight = np.minimum(found, 20).astype("f4")
    used = np.flatnonzero(found >= (WORD_LEAST if (found >= WORD_LEAST).sum() > 100 else 1))
    weight /= max(1e-6, float(weight[used].mean()) if len(used) else 1.0)
    # Where embeddings begin: by how much a word is in more toxic texts than chance has it.
    excess = np.clip((in_toxic - found * share) / np.sqrt(found * share + 1), -3, 8) / 2
    rows = net.rows(words)
    net.p["words"][rows[rows > 0], 0] = excess[rows > 0]
    net.p["word_out"][2 * _HIDDEN, 0] = 1.0
    adam = Adam({k: v for k, v in net.p.items() if not k.startswith("high") and k not in ("out", "bias")}, RATE)
    lengths = np.array([len(w) for w in words])
    for epoch in range(epochs):
        # Words of like length together, in batches of a size that leaves some hundred updates.
        order = used[np.argsort(lengths[used] + rng.random(len(used)) * 4, kind="stable")]
        size = int(np.clip(len(order) / 40, 64, 1024))
        parts = [order[i : i + size] for i in range(0, len(order), size)]
        losses = [
            _word_step(net, adam, [words[i] for i in parts[k]], target[parts[k]], weight[parts[k]], rng)
            for k in rng.permutation(len(parts))
        ]
        adam.rate *= 0.75
        log.info("words, epoch %d: loss %.4f", epoch, float(np.mean(losses)) if losses else 0.0)
    vectors = net.vectors(words)
    return (vectors @ net.p["word_out"] + net.p["word_bias"])[:, 0]


def train(
    texts: list[str | None], toxic: np.ndarray, prior: float, seed: int = 7, steps: int | None = None
) -> Network:
    """Train on labelled texts; ``prior`` is the share of toxic ones among all labelled rows.

    First the lower layer learns from the words. Then an epoch goes over all
    windows of the clean texts and over the windows of toxic texts that look
    toxic, chosen anew from all of them, at first by their worst word; each
    toxic text weighs the same. A held-back quarter sets the final probability
    and ends the training: the weights of its best epoch stay. ``steps`` ends it
    after so many updates of the upper layer at most.
    """
    rng = np.random.default_rng(seed)
    toxic = np.asarray(toxic, "f4")
    corpus, back = Corpus(texts), held_back(toxic, rng)
    checked = back if len(np.unique(toxic[back])) == 2 else np.ones(len(toxic), bool)
    bad_pieces, good_pieces = (corpus.pieces(~back & (toxic == v)) for v in (1, 0))
    in_toxic, in_clean = (documents_with(corpus, pieces) for pieces in (bad_pieces, good_pieces))
    seen = in_toxic + in_clean
    common = [(-seen[c], corpus.words[c]) for c in np.flatnonzero(seen >= WORD_DOCS)]
    net = Network({w: i + 1 for i, (_, w) in enumerate(sorted(common)[:VOCABULARY])}, seed)
    logits = train_words(net, corpus.words, in_toxic, in_clean, float(toxic[~back].mean()), rng)
    vectors = net.vectors(corpus.words) if corpus.words else np.zeros((1, 2 * _HIDDEN + _WORD_DIM), "f4")
    adam = Adam({k: v for k, v in net.p.items() if k.startswith("high") or k in ("out", "bias")}, RATE)
    flat = np.concatenate([*corpus.codes, np.zeros(WINDOW, "i4")])
    at = np.cumsum([0, *map(len, corpus.codes)])
    sizes = np.diff(at)
    bad, good = corpus.windows(bad_pieces), corpus.windows(good_pieces)
    target = toxic[checked]
    share = max(1e-6, float(target.mean()))
    odds = np.where(target > 0, prior / share, (1 - prior) / max(1e-6, 1 - share))
    step = np.arange(WINDOW)[:, None]
    best, kept, waited, done = np.inf, None, 0, 0
    limit = np.inf if steps is None else steps

    def worst_words() -> np.ndarray:
        """The highest logit of a word in each window of the toxic texts, from their mean up."""
        mask = step < np.minimum(WINDOW, sizes[bad[0]])
        each = logits[flat[np.minimum(at[bad[0]] + bad[1] + step, len(flat) - 1)]] if len(logits) else 0.0 * mask
        highest = np.where(mask, each, -np.inf).max(axis=0, initial=-np.inf)
        finite = highest[np.isfinite(highest)]
        return highest - (finite.mean() + 2 * finite.std() if len(finite) else 0.0)

    for epoch in range(EPOCHS):
        owner = corpus.owners[bad[0]]
        use = likely_toxic(owner, corpus.scores(net, bad_pieces) if epoch else worst_words())
        use &= sizes[bad[0]] > 0
        owner, some = owner[use], sizes[good[0]] > 0
        piece = np.concatenate([bad[0][use], good[0][some]])
        first = at[piece] + np.concatenate([bad[1][use], good[1][some]])
        label = np.repeat([1.0, 0.0], [len(owner), some.sum()]).astype("f4")
        weight = np.concatenate([1 / np.bincount(owner)[owner], np.ones(some.sum())])
        for value, part in ((1, TOXIC_PART), (0, 1 - TOXIC_PART)):
            weight[label == value] *= part * len(label) / max(1e-9, weight[label == value].sum())
        size = int(np.clip(len(label) / 100, 64, 1024))
        order = rng.permutation(len(label))
        for start in range(0, len(order), size):
            if done >= limit:
                break
            rows = order[start : start + size]
            mask = step < np.minimum(WINDOW, sizes[piece[rows]])
            index = np.where(mask, flat[np.minimum(first[rows] + step, len(flat) - 1)], 0)
            _train_step(net, adam, vectors, index, mask, label[rows], weight[rows], rng)
            done += 1
        features = corpus.summaries(net, checked)
        final = fit_final(features, target, odds)
        chance = np.clip(1 / (1 + np.exp(-np.clip(features @ final, -50, 50))), 1e-6, 1 - 1e-6)
        loss = -float((odds * np.where(target > 0, np.log(chance), np.log(1 - chance))).mean())
        if loss < best - 1e-4:
            best, waited, kept = loss, 0, ({k: v.copy() for k, v in net.p.items()}, final)
        else:
            waited += 1
            adam.rate /= 2
        log.info("epoch %d: %d updates, %d windows, held-back loss %.4f", epoch, done, len(label), loss)
        if waited == PATIENCE or done >= limit:
            break
    if kept:
        net.p, net.final = kept
    net.forget()
    net.token = hashlib.sha256(b"".join(net.p[k].tobytes() for k in sorted(net.p))).hexdigest()
    return net


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from; a null doc_id has none anyway."""
    part = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3))
    return F.coalesce(part == 1, F.lit(False))


def train_on_labels(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample: int = SAMPLE,
    steps: int | None = None,
) -> Network | float:
    """The network from at most ``sample`` documents of each class, or a constant score.

    The sample is bounded, so one task trains on it.

    Documents of a class are taken by the hash of their id. Where a class has no
    labelled document the score is the share of toxic ones, 0 without labels.
    """
    marks = labels.select(
        F.col(id_col).cast("long").alias("_label_id"), F.col(label_col).cast("int").alias("_toxic")
    ).where(F.col("_toxic").isin(0, 1) & F.col("_label_id").isNotNull() & ~held_out(F.col("_label_id")))
    marks = marks.groupBy("_label_id").agg(F.max("_toxic").alias("_toxic"))
    counts = {row[0]: row[1] for row in marks.groupBy("_toxic").count().collect()}
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    total = sum(counts.values())
    prior = counts.get(1, 0) / total if total else 0.0
    if not (counts.get(0) and counts.get(1)):
        return prior
    parts = []
    for value in (0, 1):
        chosen = (
            marks.where(F.col("_toxic") == value)
            .orderBy(F.xxhash64("_label_id"), "_label_id")
            .limit(sample)
        )
        joined = texts.join(F.broadcast(chosen), F.col("_id") == F.col("_label_id"))
        # One text of an id, so that repeated ids don't enlarge the sample.
        parts.append(joined.groupBy("_id", "_toxic").agg(F.min("_text").alias("_text")))

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_id", "_text"], kind="stable")
        if rows["_toxic"].nunique() < 2:
            return pd.DataFrame({"model": [pickle.dumps(prior)]})
        texts = [t if isinstance(t, str) else "" for t in rows["_text"]]
        model = train(texts, rows["_toxic"].to_numpy(), prior, steps=steps)
        return pd.DataFrame({"model": [pickle.dumps(model)]})

    together = parts[0].unionByName(parts[1]).withColumn("_all", F.lit(0))
    made = together.groupBy("_all").applyInPandas(fit, "model binary").first()
    return pickle.loads(made["model"]) if made else prior


def score_toxicity(
    docs: DataFrame,
    model: Network | float,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``docs`` with all its columns and ``_score`` (0 to 1) added, in place of one that is there.

    A null text counts as empty; texts without words get a score as well. An
    empty table gives no rows. Repeated rows get equal scores.
    """
    docs = docs.drop("_score")
    schema = docs.select("*", F.lit(0.0).alias("_score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Tasks of a worker share what it keeps of words met before.
        net = model if isinstance(model, float) else _models.setdefault(model.token, model)
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]
            scores = [net] * len(texts) if isinstance(net, float) else net.probabilities(texts)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, "_score"]
            )

    return docs.mapInArrow(run, schema)


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    threshold: float = THRESHOLD,
    sample: int = SAMPLE,
    steps: int | None = None,
) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from ``threshold`` on) per document.

    Learns from the labels of rows that are not held out; see
    ``train_on_labels`` for too few labels and ``score_toxicity`` for odd texts.
    Null and repeated doc_ids are rows like others; other columns are ignored.
    """
    model = train_on_labels(docs, labels, id_col, text_col, label_col, sample, steps)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    scored = score_toxicity(rows, model, "doc_id", "text").select("doc_id", "_score")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= threshold).cast("int").alias("predicted"),
    )
