"""Token counts under a unigram vocabulary by Viterbi, without building the tokens.

An Aho-Corasick automaton over the vocabulary names every piece that ends at each character; dynamic
programming keeps, per character, only the best score and the number of pieces of the path that has it.
The rules are those of the tokenizers library's Unigram model: scores add up as 64-bit floats from left
to right; of equal scores the longer last piece wins, as the library meets pieces by ascending start and
replaces only by a better one; a character without a piece of its own costs the lowest score less
UNKNOWN_PENALTY; neighbouring unknown characters count as one token.

Each space, and no other white space, becomes the mark U+2581; one more mark is put in front of every text,
also of one that begins with a space, as its word boundary; and no piece holds a mark after another character.
Runs of spaces are counted as the model sees them. So texts fall apart before each run of marks, and equal parts are counted once.

Defined cases: a null or empty text has no tokens; a text of any length is counted whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, functions as F

from ledgerline.llm.frames import small_batches
from ledgerline.llm.text import blocks

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
UNKNOWN_PENALTY = 10.0
MARK = "▁"
# Parts of texts whose counts a worker remembers; beyond that it starts over.
REMEMBERED = 500_000


def pieces(path: str = VOCABULARY) -> dict[str, float]:
    """Ordinary pieces with their scores; byte and control pieces have no text to match."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return {
        model.id_to_piece(k): model.get_score(k)
        for k in range(model.get_piece_size())
        if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k))
    }


class Counter:
    """Counts of parts, remembered."""

    def __init__(self, vocabulary: dict[str, float]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p in vocabulary if len(p) == 1}
        self.unknown = min(vocabulary.values(), default=0.0) - UNKNOWN_PENALTY
        self.splits = not any(MARK in p.lstrip(MARK) for p in vocabulary)
        self.parts = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        self.known: dict[str, int] = {}

    def count_part(self, part: str) -> int:
        """Tokens of the best path through one part."""
        n = len(part)
        score = [0.0] + [None] * n
        # Per place: tokens of the best path, and whether its last one is unknown.
        count, loose = [0] * (n + 1), [False] * (n + 1)
        ends: list[list] = [[] for _ in range(n)]
        for end, piece in self.automaton.iter(part):
            ends[end].append(piece)
        for end in range(n):
            best, at = None, 0
            for length, value in sorted(ends[end], reverse=True):
                total = score[end + 1 - length] + value
                if best is None or total > best:
                    best, at = total, length
            if part[end] not in self.single:
                total = score[end] + self.unknown
                if best is None or total > best:
                    best, at = total, 0
            score[end + 1] = best
            if at:
                count[end + 1] = count[end + 1 - at] + 1
            else:
                count[end + 1] = count[end] + (not loose[end])
                loose[end + 1] = True
        return count[n]

    def count(self, text: str) -> int:
        if not text:
            return 0
        text = MARK + text.replace(" ", MARK)
        known = self.known
        total = 0
        for part in self.parts.findall(text) if self.splits else [text]:
            n = known.get(part)
            if n is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                n = known[part] = self.count_part(part)
            total += n
        return total


_counters: dict[str, Counter] = {}


def counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_chars and n_tokens of every row."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _counters:
            _counters[vocabulary] = Counter(pieces(vocabulary))
        counter = _counters[vocabulary]
        for batch in batches:
            for part in blocks(batch, "text"):
                texts = part.column("text").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(np.array([len(t or "") for t in texts], dtype=np.int64)),
                        pa.array(np.array([counter.count(t) for t in texts], dtype=np.int64)),
                    ],
                    ["doc_id", "n_chars", "n_tokens"],
                )

    small_batches(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(counted, "doc_id long, n_chars long, n_tokens long")
