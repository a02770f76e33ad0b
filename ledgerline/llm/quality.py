"""Quality rules by labelling lines with a linear-chain conditional random field.

Every line that holds a word gets features (symbol, capital, digit and separator shares, word length,
repeats, end mark); Viterbi decoding labels the lines of a text content or boilerplate together, and
the share of words in content lines decides whether the text is kept.

Defined cases: a null or empty text has no words and fails the base rules. A line without words is not
part of the sequence. Equal scores count as content. Without labelled rows all weights are 0, every
line is content, and only the base rules decide. Extra columns are never looked at; repeated rows are
judged one by one, each the same way.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerline.llm.frames import small_batches
from ledgerline.llm.text import SPACED, TextBlock, blocks, mix, window_hashes

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
# A text is kept if at least this share of its words lies in content lines.
MIN_CONTENT_SHARE = 0.5
# The field is fitted on this many labelled texts at most, those with the smallest hash of their id.
SAMPLE_TEXTS = 2000
# Fitting cuts longer runs of lines into pieces of this many.
FIT_LINES = 64

SYMBOLS = "#*$%&|<>"
FEATURES = (
    "one symbol capital digit bar mark wordlength words earlier repeated distinct ended".split()
)
BOILERPLATE, CONTENT = 0, 1


def _byte_set(chars: str) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[[ord(c) for c in chars]] = True
    return table


_SYMBOL, _BAR, _MARK = _byte_set(SYMBOLS), _byte_set("|"), _byte_set("!")
_CAPITAL = _byte_set("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT = _byte_set("0123456789")
_END = _byte_set(".!?\"')")
_STARTS_CHAR = (np.arange(256) & 0xC0) != 0x80


@dataclass
class Measured:
    """Base counts of the texts of a block, and its lines that hold words."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    line_doc: np.ndarray
    line_words: np.ndarray
    features: np.ndarray

    @property
    def base_failed(self) -> np.ndarray:
        crowded = 100 * self.n_repeat_words > MAX_REPEAT_PERCENT * self.n_words
        return (self.n_words < MIN_WORDS) | crowded


def _between(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Sum of `values` over each range [low, high)."""
    sums = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[high] - sums[low]


def _seen_earlier(group: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Entries whose hash stood in the same group before."""
    order = np.lexsort((hashes, group))
    again = np.zeros(len(hashes), dtype=bool)
    same = (group[order][1:] == group[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    again[order[1:][same]] = True
    return again


def measure(texts: pa.Array) -> Measured:
    block = TextBlock(texts)
    data, words = block.data, block.words(SPACED)
    hashes = words.hashes()
    n_words = words.counts

    chars = _between(_STARTS_CHAR[data], words.starts, words.ends)
    symbol = _SYMBOL[data]

    # Words in windows that occur at least twice in their text.
    covered = np.zeros(len(hashes), dtype=bool)
    windows = window_hashes(hashes, WINDOW)
    if len(windows):
        whole = np.flatnonzero(words.doc[: len(windows)] == words.doc[WINDOW - 1 :])
        keys = mix(windows[whole] + words.doc[whole].astype(np.uint64))
        order = np.argsort(keys, kind="stable")
        same = np.zeros(len(order) + 1, dtype=bool)
        same[1:-1] = keys[order][1:] == keys[order][:-1]
        repeated = whole[order[same[:-1] | same[1:]]]
        steps = np.zeros(len(hashes) + 1, dtype=np.int64)
        np.add.at(steps, repeated, 1)
        np.add.at(steps, repeated + WINDOW, -1)
        covered = np.cumsum(steps[:-1]) > 0

    # Lines: cut at every \n and at the ends of texts, only those with a word.
    breaks = np.flatnonzero(data == 10)
    starts = np.union1d(block.offsets[:-1], breaks + 1)
    starts = starts[starts < len(data)]
    line_of_word = np.searchsorted(starts, words.starts, side="right") - 1
    used, first_word = np.unique(line_of_word, return_index=True)
    last_word = np.append(first_word[1:], len(hashes))
    low = starts[used]
    high = np.append(starts, len(data))[used + 1]
    high = np.where((high > low) & (data[high - 1] == 10), high - 1, high) if len(used) else high
    line_doc = words.doc[first_word] if len(used) else np.empty(0, dtype=np.int64)
    line_words = last_word - first_word

    spans = type(words)(block, low, high) if len(used) else None
    line_hash = spans.hashes() if spans else np.empty(0, dtype=np.uint64)
    earlier = _seen_earlier(line_doc, line_hash)

    fresh_word = ~_seen_earlier(line_of_word, hashes)
    size = np.maximum(high - low, 1)
    share = lambda table: _between(table[data], low, high) / size
    features = np.empty((len(used), len(FEATURES)), dtype=np.float32)
    if len(used):
        columns = (
            np.ones(len(used)),
            share(_SYMBOL) * 5,
            share(_CAPITAL) * 3,
            share(_DIGIT) * 3,
            share(_BAR) * 10,
            share(_MARK) * 10,
            _between(chars, first_word, last_word) / line_words / 10,
            np.log1p(line_words) / 3,
            earlier,
            _between(covered, first_word, last_word) / line_words,
            _between(fresh_word, first_word, last_word) / line_words,
            _END[data[words.ends[last_word - 1] - 1]],
        )
        for k, column in enumerate(columns):
            features[:, k] = column

    bounds = block.offsets
    return Measured(
        n_words=n_words,
        word_chars=_between(chars, words.first[:-1], words.first[1:]),
        n_symbols=_between(symbol, bounds[:-1], bounds[1:]),
        n_dup_lines=np.bincount(line_doc[earlier], minlength=block.n),
        n_repeat_words=_between(covered, words.first[:-1], words.first[1:]),
        line_doc=line_doc,
        line_words=line_words,
        features=features,
    )


@dataclass(frozen=True)
class Field:
    """Weights of the chain: `emit` [feature, label] and `move` [label, next label]."""

    emit: np.ndarray
    move: np.ndarray

    @classmethod
    def zero(cls) -> "Field":
        return cls(np.zeros((len(FEATURES), 2)), np.zeros((2, 2)))

    def decode(self, features: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """The best labels of each text's lines; all texts advance a line at a time."""
        scores = features @ self.emit
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        length = np.diff(np.append(first, len(doc)))
        order = np.argsort(-length, kind="stable")
        first, length = first[order], length[order]
        longest = int(length[0]) if len(length) else 0
        still = np.searchsorted(-length, -np.arange(1, longest + 1), side="right")
        came = np.zeros((len(doc), 2), dtype=np.int8)
        best = scores[first].copy()
        for t in range(1, longest):
            n = still[t]
            ways = best[:n, :, None] + self.move[None]
            # Equal scores go to content, the larger label.
            came[first[:n] + t] = ways[:, CONTENT] >= ways[:, BOILERPLATE]
            best[:n] = ways.max(axis=1) + scores[first[:n] + t]
        labels = np.zeros(len(doc), dtype=np.int8)
        state = (best[:, CONTENT] >= best[:, BOILERPLATE]).astype(np.int8)
        for t in range(longest - 1, -1, -1):
            n = still[t]
            at = first[:n] + t
            labels[at] = state[:n]
            state[:n] = came[at, state[:n]]
        return labels


def fit_field(lines: list[np.ndarray], labels: list[int], rounds: int = 80) -> Field:
    """Maximum likelihood with a quadratic penalty; a text's label stands for all its lines."""
    pieces = [
        (x[k : k + FIT_LINES], y)
        for x, y in zip(lines, labels)
        for k in range(0, len(x), FIT_LINES)
    ]
    if not pieces:
        return Field.zero()
    pieces.sort(key=lambda piece: -len(piece[0]))
    length = np.array([len(x) for x, _ in pieces])
    y = np.array([label for _, label in pieces])
    # Both labels weigh the same in total, and a text counts once, however many lines it has.
    weight = np.where(y == 1, 0.5 / max((y == 1).sum(), 1), 0.5 / max((y == 0).sum(), 1)) / length
    x = np.zeros((length[0], len(pieces), len(FEATURES)))
    for k, (piece, _) in enumerate(pieces):
        x[: len(piece), k] = piece
    there = np.arange(length[0])[:, None] < length[None]

    theta = np.zeros(len(FEATURES) * 2 + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        emit, move = theta[:-4].reshape(-1, 2), theta[-4:].reshape(2, 2)
        scores = x @ emit
        forward = np.empty_like(scores)
        forward[0] = scores[0]
        for t in range(1, len(x)):
            ways = forward[t - 1][:, :, None] + move[None]
            forward[t] = np.where(
                there[t][:, None], np.logaddexp(ways[:, 0], ways[:, 1]) + scores[t], forward[t - 1]
            )
        total = np.logaddexp(forward[-1][:, 0], forward[-1][:, 1])
        backward = np.zeros_like(scores)
        pair = np.zeros((len(pieces), 2, 2))
        for t in range(len(x) - 1, 0, -1):
            ahead = scores[t] + backward[t]
            ways = move[None] + ahead[:, None, :]
            here = np.exp(forward[t - 1][:, :, None] + ways - total[:, None, None])
            pair += here * there[t][:, None, None]
            backward[t - 1] = np.where(
                there[t][:, None], np.logaddexp(ways[:, :, 0], ways[:, :, 1]), backward[t]
            )
        marginal = np.exp(forward + backward - total[None, :, None]) * there[:, :, None]
        goal = np.zeros_like(marginal)
        goal[:, np.arange(len(y)), y] = there
        grad_emit = np.einsum("tnf,tnl,n->fl", x, goal - marginal, weight)
        stay = np.zeros_like(pair)
        stay[np.arange(len(y)), y, y] = length - 1
        grad_move = ((stay - pair) * weight[:, None, None]).sum(axis=0)
        grad = np.concatenate([grad_emit.ravel(), grad_move.ravel()]) - 0.002 * theta
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad**2
        theta = theta + 0.1 * (first / (1 - 0.9**step)) / (
            np.sqrt(second / (1 - 0.99**step)) + 1e-9
        )
    return Field(theta[:-4].reshape(-1, 2), theta[-4:].reshape(2, 2))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_TEXTS) -> Field:
    """Fit on at most `sample` labelled texts; only their line features reach the driver."""
    small_batches(docs)
    marks = (
        labels.where("quality IN (0, 1) AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    # One text for each id, however many rows share it.
    texts = docs.select("doc_id", "text").join(marks, "doc_id").groupBy("doc_id", "quality")
    texts = texts.agg(F.min("text").alias("text")).select("quality", "text")

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                m = measure(part.column("text"))
                cuts = np.searchsorted(m.line_doc, np.arange(part.num_rows + 1))
                rows = [m.features[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("quality"), pa.array(rows, pa.binary())], ["quality", "lines"]
                )

    rows = texts.mapInArrow(measured, "quality int, lines binary").collect()
    # The order in which tasks finish must not show in the sums.
    rows.sort(key=lambda r: (r["quality"], bytes(r["lines"])))
    lines = [
        np.frombuffer(r["lines"], dtype=np.float32).reshape(-1, len(FEATURES)).astype(float)
        for r in rows
    ]
    return fit_field(lines, [r["quality"] for r in rows])


def content_share(m: Measured, field: Field) -> np.ndarray:
    """Share of each text's words that lie in content lines; 1 for a text without lines."""
    labels = field.decode(m.features, m.line_doc)
    n = len(m.n_words)
    inside = np.bincount(m.line_doc, weights=m.line_words * (labels == CONTENT), minlength=n)
    return np.where(m.n_words > 0, inside / np.maximum(m.n_words, 1), 1.0)


REPORT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long,"
    " n_repeat_words long, base_failed boolean, content_share double, kept boolean"
)


def report(docs: DataFrame, field: Field) -> DataFrame:
    """The base counts and the verdict of every row."""

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                m = measure(part.column("text"))
                share = content_share(m, field)
                failed = m.base_failed
                columns = [
                    part.column("doc_id").cast(pa.int64()),
                    *(
                        pa.array(np.asarray(c, dtype=np.int64))
                        for c in (
                            m.n_words,
                            m.word_chars,
                            m.n_symbols,
                            m.n_dup_lines,
                            m.n_repeat_words,
                        )
                    ),
                    pa.array(failed),
                    pa.array(share),
                    pa.array(~failed & (share >= MIN_CONTENT_SHARE)),
                ]
                yield pa.RecordBatch.from_arrays(
                    columns, [c.split()[0] for c in REPORT.split(", ")]
                )

    return docs.select("doc_id", "text").mapInArrow(judged, REPORT)


def keep(docs: DataFrame, field: Field) -> DataFrame:
    """The rows that pass, all columns as they came."""
    at = docs.columns.index("text")

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = batch.rename_columns([f"c{k}" for k in range(batch.num_columns)])
            for part in blocks(named, f"c{at}"):
                m = measure(part.column(at))
                good = ~m.base_failed & (content_share(m, field) >= MIN_CONTENT_SHARE)
                yield part.filter(pa.array(good)).rename_columns(batch.schema.names)

    return docs.mapInArrow(passing, docs.schema)
