"""Toxicity by a learned lexicon, misspellings included, and the context each hit stands in.

Training finds the terms that mark toxic texts: all whose odds are significantly above those of the
sample, however rare they are or often quoted. They form a trie, and the Levenshtein automata of all
terms run over it together: a state is a set of (trie node, edits spent), made deterministic as words
need it, so a word costs one table look-up per character, and words seen before cost one in all. Every
spelling has evidence of its own from training, which keeps ordinary words that happen to be close to a
term from counting. The words in a window around a hit, and quotation marks around it, tell abuse from
quotation. A logistic model weighs the evidence.

Training reads at most SAMPLE_TEXTS labelled texts, those with the smallest hash of their id, one of
each group with equal text or equal MinHash of word 5-grams, so that copies do not vote. Only `text`
and `toxic` are read.

Defined cases: a null or empty text has no hits and gets the score of a text without any. A null label
is no label; of several labels of a document the largest counts. Without labelled texts every score is
0. Terms of equal weight are ordered by themselves. Extra columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.frames import crc_of_id, small_batches, stored
from ledgerline.llm.text import SPACED, TextBlock, blocks, window_hashes

FOLDS = 5
SAMPLE_TEXTS = 30_000
# A term: in so many toxic texts, and more often toxic than chance has it once in 10,000 times, by the
# log-likelihood ratio of its texts under its own odds against those of the sample.
MIN_TEXTS, SIGNIFICANT = 4, 15.13
# Letters a term needs for one and for two edits.
ONE_EDIT, TWO_EDITS = 5, 9
# Texts a misspelling counts as seen in before training shows any, toxic and clean ones.
PRIOR = (1.0, 0.3)
WINDOW = 6
# Texts of the sample a word has to stand near a hit in, to tell abuse from quotation.
CUE_TEXTS = 5
QUOTES = "\"“”„«»‘’`"
STRIPPED = ".,;:!?()[]{}<>…'" + QUOTES
# Words a worker remembers; beyond that it starts over.
REMEMBERED = 500_000
# Trie nodes that the states of a worker's automaton hold; beyond that it starts over.
REMEMBERED_NODES = 1_000_000
# Evidence of a text's distinct hits together counts up to here.
MOST_EVIDENCE = 24.0
FEATURES = 7


def allowed_edits(term: str) -> int:
    return 2 if len(term) >= TWO_EDITS else 1 if len(term) >= ONE_EDIT else 0


class LexiconAutomaton:
    """The trie of the terms, crossed with their Levenshtein automata, determinised on demand."""

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        # Most edits any term below a node allows; and the term that ends at a node.
        self.budget, self.term = [0], [None]
        for term in terms:
            node = 0
            edits = allowed_edits(term)
            self.budget[0] = max(self.budget[0], edits)
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.budget.append(0)
                    self.term.append(None)
                node = self.children[node][c]
                self.budget[node] = max(self.budget[node], edits)
            self.term[node] = term
        self.alphabet = {c for term in terms for c in term}
        self.start = self._closed({0: 0})
        self.moves: dict = {}
        self.accepts: dict = {}
        self.held = 0

    def _closed(self, reached: dict[int, int]) -> frozenset:
        """With the nodes that leaving out letters of a term reaches."""
        todo = list(reached.items())
        while todo:
            node, edits = todo.pop()
            for child in self.children[node].values():
                if edits < self.budget[child] and reached.get(child, 9) > edits + 1:
                    reached[child] = edits + 1
                    todo.append((child, edits + 1))
        return frozenset(reached.items())

    def _step(self, state: frozenset, c: str) -> frozenset:
        reached: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits <= self.budget[node] and edits < reached.get(node, 9):
                reached[node] = edits

        for node, edits in state:
            reach(node, edits + 1)
            for letter, child in self.children[node].items():
                reach(child, edits + (letter != c))
        return self._closed(reached)

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term within its allowed edits, and the edits; ties by the term."""
        if self.held > REMEMBERED_NODES:
            self.moves.clear()
            self.accepts.clear()
            self.held = 0
        state = self.start
        for c in word:
            move = (state, c if c in self.alphabet else "")
            following = self.moves.get(move)
            if following is None:
                following = self.moves[move] = self._step(state, move[1])
                self.held += len(following)
            state = following
            if not state:
                return None
        if state not in self.accepts:
            ends = [
                (edits, self.term[node])
                for node, edits in state
                if self.term[node] is not None and edits <= allowed_edits(self.term[node])
            ]
            self.accepts[state] = min(ends) if ends else None
        best = self.accepts[state]
        return (best[1], best[0]) if best else None


@dataclass
class Model:
    """What training found. Everything in it is bounded by the sample."""

    terms: dict[str, float] = field(default_factory=dict)
    spellings: dict[str, float] = field(default_factory=dict)
    # Evidence of all misspellings of a term together, for those that training has not seen.
    misspelt: dict[str, float] = field(default_factory=dict)
    # Evidence of a misspelling of a term that training has only seen spelt right.
    unseen: float = 0.0
    cues: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray | None = None
    known: dict[str, float | None] = field(default_factory=dict)
    automaton: LexiconAutomaton | None = None

    def __getstate__(self):
        return self.__dict__ | {"known": {}, "automaton": None}

    def evidence(self, token: str) -> float | None:
        """Log odds of a token that spells a term, or None."""
        known = self.known
        if token in known:
            return known[token]
        if self.automaton is None:
            self.automaton = LexiconAutomaton(sorted(self.terms))
        word = token.strip(STRIPPED)
        found = self.automaton.match(word) if word else None
        if found is None:
            value = None
        elif word in self.spellings:
            value = self.spellings[word]
        else:
            value = self.misspelt.get(found[0], self.unseen) / max(found[1], 1)
        if len(known) >= REMEMBERED:
            known.clear()
        known[token] = value
        return value

    def hits(self, tokens: list[str]) -> list[tuple[int, float]]:
        evidence = self.evidence
        known = self.known
        fresh = [w for w in set(tokens) if w not in known]
        for w in fresh:
            evidence(w)
        found = {w for w in set(tokens) if evidence(w) is not None}
        if not found:
            return []
        return [(k, evidence(w)) for k, w in enumerate(tokens) if w in found]

    def features(self, text: str | None) -> np.ndarray:
        """Evidence outside and inside quotation marks, number of hits of each, best context; and the
        strongest evidence of either, which many weak hits together do not reach.
        """
        x = np.zeros(FEATURES)
        tokens = (text or "").lower().split()
        best: dict[tuple[bool, str], float] = {}
        hits = self.hits(tokens)
        marked = bool(hits) and any(q in text for q in QUOTES)
        for k, value in hits:
            quoted = marked and is_quoted(tokens, k)
            best[quoted, tokens[k]] = value
            if value > 0:
                x[3 if quoted else 2] += 1
        contexts = (sum(self.cues.get(w, 0.0) for w in window(tokens, k)) for k in strong(hits))
        context = max(contexts, default=None)
        for quoted in (False, True):
            own = [max(v, 0) for (q, _), v in best.items() if q == quoted]
            x[int(quoted)] = min(sum(own), MOST_EVIDENCE)
            x[5 + quoted] = max(own, default=0.0)
        x[2:4] = np.log1p(x[2:4])
        x[4] = np.clip(context or 0.0, -4, 4)
        return x

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(x))
        z = x @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def strong(hits: list[tuple[int, float]]) -> list[int]:
    """Places of hits with half the evidence of the strongest or more; weak ones are everywhere."""
    least = max((v for _, v in hits), default=0.0) / 2
    return [k for k, v in hits if v >= least > 0]


def window(tokens: list[str], k: int) -> list[str]:
    return [
        w.strip(STRIPPED) for w in (*tokens[max(k - WINDOW, 0) : k], *tokens[k + 1 : k + 1 + WINDOW])
    ]


def is_quoted(tokens: list[str], k: int) -> bool:
    """The nearest mark before a hit opens a quotation, and the nearest one after it closes one.

    A mark in front of a token opens, one behind it closes, so a hit between two quotations is in neither.
    """

    def opens(w: str) -> bool:
        return w[0] in QUOTES

    def closes(w: str) -> bool:
        return w.rstrip(".,;:!?")[-1:] in set(QUOTES)

    before = reversed(tokens[max(k - WINDOW, 0) : k])
    after = tokens[k + 1 : k + 1 + WINDOW]
    opened = opens(tokens[k]) or next((not closes(w) for w in before if opens(w) or closes(w)), False)
    return opened and (
        closes(tokens[k]) or next((not opens(w) for w in after if opens(w) or closes(w)), False)
    )


def _log_odds(toxic: float, clean: float, a: float = 0.5, b: float = 0.5) -> float:
    return math.log((toxic + a) / (clean + b))


def _ratio(toxic: float, clean: float, base: float) -> float:
    """Log-likelihood ratio of texts under odds of their own against the sample's log odds."""
    share = 1 / (1 + math.exp(-base))
    expected = ((toxic, share), (clean, 1 - share))
    return 2 * sum(n * math.log(n / ((toxic + clean) * p)) for n, p in expected if n)


def _misspelling(toxic: int, clean: int, base: float) -> float:
    """Evidence of spellings that are no terms: ordinary words are close to terms too, so it counts
    against the sample's odds only if most of their texts are toxic, or significantly many."""
    odds = _log_odds(toxic, clean, *PRIOR)
    significant = toxic >= MIN_TEXTS and odds > base and _ratio(toxic, clean, base) >= SIGNIFICANT
    return odds - base if odds > 0 or significant else min(odds, 0.0)


def _sample(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """label, text of distinct labelled training texts."""
    marks = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id")
    marks = marks.agg(F.max("toxic").cast("int").alias("label")).where(~held_out())
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                words = TextBlock(part.column("text"), lower=True).words(SPACED)
                h = words.hashes()
                low = [
                    int(window_hashes(h[a:b], min(5, b - a)).min()) if b > a else 0
                    for a, b in zip(words.first.tolist(), words.first[1:].tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("label"),
                        part.column("text"),
                        pa.array(np.array(low, dtype=np.uint64).view(np.int64)),
                    ],
                    ["label", "text", "low"],
                )

    # One text for each id, however many rows share it.
    texts = docs.select("doc_id", "text").join(marks, "doc_id").groupBy("doc_id", "label")
    texts = texts.agg(F.min("text").alias("text")).select("label", "text")
    texts = texts.mapInArrow(hashed, "label int, text string, low long")
    return stored(
        texts.groupBy("low", "label").agg(F.min("text").alias("text")).drop("low"), "labelled"
    )


def held_out(column: str = "doc_id") -> Column:
    return F.coalesce(crc_of_id(column) % FOLDS == 0, F.lit(False))


def _counted(sample: DataFrame, tokens_of) -> DataFrame:
    """Texts of each label that hold a token of those `tokens_of(text)` gives."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                label, token = [], []
                for y, t in zip(part.column("label").to_pylist(), part.column("text").to_pylist()):
                    own = tokens_of(t or "")
                    token += own
                    label += [y] * len(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(token, pa.string()), pa.array(label, pa.int32())], ["token", "label"]
                )

    rows = sample.mapInArrow(emit, "token string, label int")
    return rows.groupBy("token").agg(
        F.count_if(F.col("label") == 1).alias("toxic"), F.count_if(F.col("label") == 0).alias("clean")
    )


def _words(text: str) -> list[str]:
    return list({w.strip(STRIPPED) for w in text.lower().split()} - {""})


def fit(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE_TEXTS) -> Model:
    small_batches(docs)
    sample = _sample(docs, labels, limit)
    n = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic or not clean:
        return Model()
    base = _log_odds(toxic, clean)
    words = stored(_counted(sample, _words), "words")
    # Weights are odds against those of the sample, so a term counts though clean texts quote it more.
    # Words in MIN_TEXTS toxic texts of a bounded sample.
    model = Model(unseen=_misspelling(0, 0, base))
    for r in words.where(F.col("toxic") >= MIN_TEXTS).orderBy("token").toLocalIterator():
        odds = _log_odds(r["toxic"], r["clean"]) - base
        if odds > 0 and _ratio(r["toxic"], r["clean"], base) >= SIGNIFICANT:
            model.terms[r["token"]] = odds
    if not model.terms:
        model.weights = np.append(np.zeros(FEATURES), base)
        return model

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = LexiconAutomaton(sorted(model.terms))
        for batch in batches:
            close = [automaton.match(w) is not None for w in batch.column("token").to_pylist()]
            yield batch.filter(pa.array(close, pa.bool_()))

    # Spellings within the allowed edits of the lexicon, in a bounded sample.
    automaton, pooled = LexiconAutomaton(sorted(model.terms)), {}
    for r in words.mapInArrow(near, words.schema).collect():
        own = model.terms.get(r["token"])
        model.spellings[r["token"]] = _misspelling(r["toxic"], r["clean"], base) if own is None else own
        term, edits = automaton.match(r["token"])
        if edits:
            seen = pooled.setdefault(term, [0, 0])
            seen[0] += r["toxic"]
            seen[1] += r["clean"]
    model.misspelt = {t: _misspelling(a, b, base) for t, (a, b) in pooled.items()}

    def around(text: str) -> list[str]:
        tokens = text.lower().split()
        cues = {w for k in strong(model.hits(tokens)) for w in window(tokens, k)}
        return list(cues - {""})

    # Words of a bounded sample.
    common = _counted(sample, around).where(F.col("toxic") + F.col("clean") >= CUE_TEXTS)
    common = common.orderBy("token").collect()
    hits = {y: sum(r[y] for r in common) + 1 for y in ("toxic", "clean")}
    for r in common:
        rate = _log_odds(r["toxic"], r["clean"], 2 * hits["toxic"] / hits["clean"], 2)
        model.cues[r["token"]] = (rate - math.log(hits["toxic"] / hits["clean"])) / 4

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [model.features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array([v.tolist() for v in x], pa.list_(pa.float64()))],
                ["label", "x"],
            )

    rows = sample.mapInArrow(measured, "label int, x array<double>").groupBy("label", "x").count()
    rows = sorted(rows.collect(), key=lambda r: (r["label"], r["x"]))
    x = np.array([r["x"] for r in rows])
    y = np.array([r["label"] for r in rows], dtype=float)
    model.weights = _logistic(x, y, np.array([r["count"] for r in rows], dtype=float))
    return model


def _logistic(x: np.ndarray, y: np.ndarray, times: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Newton's method with a quadratic penalty on all weights but the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    ridge = np.diag(np.append(np.full(x.shape[1] - 1, penalty), 1e-6))
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ ((p - y) * times) + ridge @ w
        hessian = (x * (times * p * (1 - p))[:, None]).T @ x + ridge
        w = w - np.linalg.solve(hessian, gradient)
    return w


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted and the number of hits of every row."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                x = np.array([model.features(t) for t in part.column("text").to_pylist()])
                score = model.score(x)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("held_out"),
                        pa.array(score),
                        pa.array((score >= 0.5).astype(np.int32)),
                        pa.array(np.rint(np.expm1(x[:, 2])).astype(np.int64)),
                        pa.array(np.rint(np.expm1(x[:, 3])).astype(np.int64)),
                    ],
                    ["doc_id", "held_out", "score", "predicted", "n_direct", "n_quoted"],
                )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text"
    )
    return rows.mapInArrow(
        scored,
        "doc_id long, held_out boolean, score double, predicted int, n_direct long, n_quoted long",
    )
