"""Text scores by context-tree weighting over bytes.

Every byte is predicted as eight binary choices, each by the DEPTH bytes before it. For each choice the
contexts of all depths form a tree. A node's two counts give a Krichevsky-Trofimov estimate; bottom up,
each node weighs its own estimate against the product of its children, half and half; top down, these
weights mix the estimates of all depths on a context's path into one probability. Training counts
(DEPTH + 1)-byte grams of all training texts; texts are scored with the counts as training left them.
A text is lower-cased (A-Z) and ends with a symbol of its own, so its probability is that of a whole text.

Contexts are worked off by their last two bytes, so a group holds whole subtrees; only the nodes of
depth 0 and 1, at most 256 * 255, meet on the driver. Scores are looked up in tables of PART_ROWS entries
at most, one pass over the texts for each, so what a pass ships is bounded however large the corpus is.

Defined cases: a null or empty text is its end symbol alone. A null doc_id is not held out. Equal rows
get equal scores, one each. Without training texts every byte costs eight bits. Extra columns are not
looked at. Words are known by 64-bit hashes; grams are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import zip_longest

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.frames import crc_of_id, row_key, small_batches, stored
from ledgerline.llm.text import SPACED, TextBlock, blocks

DEPTH = 5
FOLDS, HELD_OUT = 7, 2
# Bytes that no UTF-8 text holds: before a text, and after it.
START, END = 0xFE, 0xFF
# The end of a text as a word.
END_WORD = -1
PART_ROWS = 1_000_000
LN2 = math.log(2)


def held_out() -> Column:
    return F.coalesce(crc_of_id() % FOLDS == HELD_OUT, F.lit(False))


def grams(block: TextBlock, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all texts with their contexts, packed, and where each text's begin."""
    lengths = np.diff(block.offsets)
    extra = np.arange(block.n) * (depth + 1) + depth
    symbols = np.full(len(block.data) + block.n * (depth + 1), START, dtype=np.int64)
    symbols[np.arange(len(block.data)) + np.repeat(extra, lengths)] = block.data
    symbols[block.offsets[1:] + extra] = END
    packed = symbols.copy()
    for d in range(1, depth + 1):
        packed[d:] |= symbols[:-d] << (8 * d)
    return packed[symbols != START], block.offsets[:-1] + np.arange(block.n)


def _merged(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their values."""
    key, value = np.concatenate(keys), np.concatenate(values)
    order = np.argsort(key, kind="stable")
    key, value = key[order], value[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else []
    return key[first], np.add.reduceat(value, first) if len(key) else value


def _counted(keys: np.ndarray, learn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and how many of each are to be learnt; keys leave their highest bit free."""
    both = np.sort((keys << 1) | learn)
    key, learnt = both >> 1, np.append(0, np.cumsum(both & 1))
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[first], np.diff(learnt[np.append(first, len(key))])


def _gather(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Grams of all texts and words of training texts, each with its count in training."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def report(kind: int, held: tuple[list, list]) -> pa.RecordBatch:
            key, n = _merged(*held)
            kinds = pa.array(np.full(len(key), kind, dtype=np.int32))
            return pa.RecordBatch.from_arrays([kinds, pa.array(key), pa.array(n)], ["kind", "key", "n"])

        held = {0: ([], []), 1: ([], [])}
        for batch in batches:
            for part in blocks(batch, "text"):
                train = ~np.asarray(part.column("held_out"))
                block = TextBlock(part.column("text"), lower=True)
                packed, first = grams(block)
                learn = np.repeat(train, np.diff(np.append(first, len(packed))))
                words = block.words(SPACED)
                known = words.hashes().view(np.int64)[train[words.doc]]
                known = np.append(known, np.full(int(train.sum()), END_WORD))
                for kind, found in (
                    (0, _counted(packed, learn)),
                    (1, np.unique(known, return_counts=True)),
                ):
                    for store, x in zip(held[kind], found):
                        store.append(x)
                    if sum(map(len, held[kind][0])) > PART_ROWS:
                        key, n = _merged(*held[kind])
                        held[kind] = ([key], [n])
                    if len(held[kind][0][0]) > PART_ROWS:
                        yield report(kind, held[kind])
                        held[kind] = ([], [])
        for kind, found in held.items():
            if found[0]:
                yield report(kind, found)

    rows = docs.select(held_out().alias("held_out"), "text").mapInArrow(
        counted, "kind int, key long, n long"
    )
    counts = stored(rows.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    return (
        counts.where("kind = 0").select("key", "n"),
        counts.where("kind = 1").select("key", "n"),
    )


_FACTS = np.array([[math.lgamma(n + 0.5), math.lgamma(n + 1)] for n in range(4096)])


def _lgamma(n: np.ndarray, column: int) -> np.ndarray:
    """lgamma(n + 0.5) or lgamma(n + 1) of whole numbers."""
    z = np.maximum(n, 4096) + (0.5, 1.0)[column]
    far = (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z)
    return np.where(n < 4096, _FACTS[np.minimum(n, 4095).astype(int), column], far)


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log probability that the Krichevsky-Trofimov estimator gives a sequence with these counts."""
    return _lgamma(a, 0) + _lgamma(b, 0) - _lgamma(a + b, 1) - math.log(math.pi)


class Subtrees:
    """The binary context trees below contexts of two bytes, for a set of grams with counts."""

    def __init__(self, gram: np.ndarray, n: np.ndarray, depth: int, top: int = 2):
        symbol, context = gram & 0xFF, gram >> 8
        bit = np.arange(8)
        choice = (1 << bit) | (symbol[:, None] >> (8 - bit))
        self.bits = (symbol[:, None] >> (7 - bit)) & 1
        self.choice = choice
        ids, at = np.unique(((context[:, None] << 8) | choice).ravel(), return_inverse=True)
        times = np.repeat(n, 8)
        ones = np.bincount(at, weights=times * self.bits.ravel(), minlength=len(ids))
        zeros = np.bincount(at, weights=times, minlength=len(ids)) - ones
        self.leaf = at.reshape(-1, 8)
        weight = log_kt(zeros, ones)
        # From the deepest level up: counts, weight of the own estimate, and each node's parent.
        self.levels = [(zeros, ones, np.ones(len(ids)), None)]
        for d in range(depth - 1, top - 1, -1):
            parent = (ids & 0xFF) | (((ids >> 8) & ((1 << 8 * d) - 1)) << 8)
            ids, up = np.unique(parent, return_inverse=True)
            below = np.bincount(up, weights=weight, minlength=len(ids))
            zeros = np.bincount(up, weights=zeros, minlength=len(ids))
            ones = np.bincount(up, weights=ones, minlength=len(ids))
            own = log_kt(zeros, ones)
            weight = np.logaddexp(own, below) - LN2
            self.levels.append((zeros, ones, np.exp(own - LN2 - weight), up))
        self.ids, self.weight = ids, weight

    def probabilities(self) -> np.ndarray:
        """Of each gram's bits, mixed over the depths of the subtree."""
        zeros, ones, _, _ = self.levels[0]
        node = self.leaf
        path = [node]
        for _, _, _, up in self.levels[1:]:
            node = up[node]
            path.append(node)
        p = None
        for node, (zeros, ones, own, _) in zip(path, self.levels):
            kt = np.where(self.bits == 1, ones[node], zeros[node]) + 0.5
            kt = kt / (zeros[node] + ones[node] + 1)
            p = kt if p is None else own[node] * kt + (1 - own[node]) * p
        return p


def model(counts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """key, value: every gram with the log10 probability of its symbol."""
    grouped = counts.withColumn("pair", F.shiftright("key", 8).bitwiseAND(0xFFFF).cast("int"))

    def tops(table: pa.Table) -> pa.Table:
        trees = Subtrees(table.column("key").to_numpy(), table.column("n").to_numpy(), depth)
        zeros, ones, _, _ = trees.levels[-1]
        # (last byte, choice), without the byte before.
        return pa.table(
            {"node": trees.ids & 0xFFFF, "zeros": zeros, "ones": ones, "weight": trees.weight}
        )

    top = grouped.groupBy("pair").applyInArrow(
        tops, "node long, zeros double, ones double, weight double"
    )
    # At most 256 * 255 rows. Weights are added in a fixed order.
    top = top.groupBy("node").agg(
        F.sum("zeros").alias("zeros"),
        F.sum("ones").alias("ones"),
        F.aggregate(F.array_sort(F.collect_list("weight")), F.lit(0.0), lambda x, y: x + y).alias(
            "below"
        ),
    )
    top = top.orderBy("node").toArrow()
    node = top.column("node").to_numpy()
    levels = []
    zeros, ones = top.column("zeros").to_numpy(), top.column("ones").to_numpy()
    below = top.column("below").to_numpy()
    for mask in (0xFFFF, 0xFF):
        if mask == 0xFF:
            node, up = np.unique(node & 0xFF, return_inverse=True)
            zeros, ones = np.bincount(up, weights=zeros), np.bincount(up, weights=ones)
            below = np.bincount(up, weights=weight)
        own = log_kt(zeros, ones)
        weight = np.logaddexp(own, below) - LN2
        table = np.zeros((3, mask + 1))
        table[:, node] = zeros, ones, np.exp(own - LN2 - weight)
        levels.append((mask, table))

    def scored(table: pa.Table) -> pa.Table:
        key = table.column("key").to_numpy()
        trees = Subtrees(key, table.column("n").to_numpy(), depth)
        p = trees.probabilities()
        last = ((key >> 8) & 0xFF)[:, None] << 8
        for mask, (zeros, ones, own) in levels:
            at = (last | trees.choice) & mask
            kt = (np.where(trees.bits == 1, ones[at], zeros[at]) + 0.5) / (zeros[at] + ones[at] + 1)
            p = own[at] * kt + (1 - own[at]) * p
        return pa.table({"key": key, "value": np.log10(p).sum(axis=1)})

    return grouped.groupBy("pair").applyInArrow(scored, "key long, value double")


class Table:
    """A hash table from 64-bit keys to numbers that looks up whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.shift = 64 - max(int(2 * len(keys)).bit_length(), 4)
        size = 1 << (64 - self.shift)
        self.used = np.zeros(size, dtype=bool)
        self.keys, self.values = np.zeros(size, dtype=np.int64), np.zeros(size)
        slot = self._slot(keys)
        left = np.arange(len(keys))
        while len(left):
            free = left[~self.used[slot[left]]]
            _, one_each = np.unique(slot[free], return_index=True)
            put = free[one_each]
            self.used[slot[put]] = True
            self.keys[slot[put]], self.values[slot[put]] = keys[put], values[put]
            left = left[self.keys[slot[left]] != keys[left]]
            slot[left] = (slot[left] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(self.shift)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values, 0 for keys that are not there."""
        slot = self._slot(keys)
        found = self.keys[slot] == keys
        out = np.where(found, self.values[slot], 0.0)
        left = np.flatnonzero(~found & self.used[slot])
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & (len(self.keys) - 1)
            found = self.keys[slot] == keys[left]
            out[left[found]] = self.values[slot[found]]
            going = ~found & self.used[slot]
            left, slot = left[going], slot[going]
        return np.where(self.used[self._slot(keys)], out, 0.0)


def _parts(table: DataFrame, parts: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for k in range(parts):
        rows = table.where(F.pmod(F.xxhash64("key"), F.lit(parts)) == k).toArrow()
        yield rows.column("key").to_numpy(), rows.column("value").to_numpy()


def scores(docs: DataFrame) -> DataFrame:
    """Per row: held_out, tokens, known tokens, training tokens, unigram score and model score.

    And the text's length in bytes, with the end symbol, and the model's code length per byte in bits.
    """
    spark = docs.sparkSession
    small_batches(docs)
    gram_counts, word_counts = _gather(docs)
    probabilities = stored(model(gram_counts), "model")
    n, v = word_counts.agg(F.sum("n"), F.count("*")).first()
    n = n or 0
    words = word_counts.select("key", F.log10(F.col("n") + 1).alias("value"))
    gram_parts, word_parts = (max(-(-s // PART_ROWS), 1) for s in (probabilities.count(), v))
    passes = max(gram_parts, word_parts)

    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out().alias("held_out"),
        row_key("doc_id", "text").alias("k"),
        "text",
    ).select("doc_id", "held_out", "k.a", "k.b", "text")
    out_names = ["doc_id", "held_out", "a", "b", "n_tokens", "n_bytes", "n_known", "words", "score"]

    def scored(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # The larger table takes more passes; the other one is then left out.
            gram_table, word_table = (Table(*t) if t else None for t in shared.value)
            end = word_table.get(np.array([END_WORD]))[0] if word_table else 0.0
            for batch in batches:
                for part in blocks(batch, "text"):
                    block = TextBlock(part.column("text"), lower=True)
                    score = np.zeros(block.n)
                    if gram_table:
                        packed, first = grams(block)
                        score = np.add.reduceat(gram_table.get(packed), first)
                    found = block.words(SPACED)
                    value = np.zeros(len(found.doc))
                    if word_table:
                        value = word_table.get(found.hashes().view(np.int64))
                    add = lambda x: np.bincount(found.doc, weights=x, minlength=block.n)
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(part.column(c) for c in out_names[:4]),
                            pa.array(found.counts + 1),
                            pa.array(np.diff(block.offsets) + 1),
                            pa.array((add(value > 0) + (end > 0)).astype(np.int64)),
                            pa.array(add(value) + end),
                            pa.array(score),
                        ],
                        out_names,
                    )

        return run

    schema = (
        "doc_id long, held_out boolean, a long, b long, n_tokens long, n_bytes long,"
        " n_known long, words double, score double"
    )
    done = []
    for part in zip_longest(_parts(probabilities, gram_parts), _parts(words, word_parts)):
        shared = spark.sparkContext.broadcast(part)  # about PART_ROWS entries each
        done.append(stored(keyed.mapInArrow(scored(shared), schema), "scored"))
    rows = done[0]
    if passes > 1:
        for more in done[1:]:
            rows = rows.unionByName(more)
        # Equal rows share a key; each pass has all of them.
        copies = F.count("*") / F.lit(passes)
        rows = rows.groupBy("doc_id", "held_out", "a", "b", "n_tokens", "n_bytes").agg(
            (F.sum("n_known") / copies).cast("long").alias("n_known"),
            (F.sum("words") / copies).alias("words"),
            (F.sum("score") / copies).alias("score"),
            F.explode(F.sequence(F.lit(1), copies.cast("int"))).alias("nth"),
        )
    all_ = math.log10(n + v + 1)
    return rows.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("words") - F.col("n_tokens") * F.lit(all_)).alias("base_score"),
        "score",
        "n_bytes",
        (F.col("score") / F.col("n_bytes") * F.lit(-math.log2(10))).alias("bits_per_byte"),
    )
