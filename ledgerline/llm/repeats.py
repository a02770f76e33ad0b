"""Substring dedup by seed and extend: passages of LENGTH words and more that an earlier document holds.

Seeds are winnowed anchors: of any SPREAD neighbouring runs of SEED_WORDS words, the one with the least
hash is an anchor, so two equal passages of LENGTH words share the anchor that the passage itself picks.
Documents are joined on their anchors, and each shared anchor is extended both ways, in two steps that
emit no pairs, however many documents hold an anchor:

1. In full: an anchor's surroundings are all words that a passage of LENGTH words around it can reach,
   LENGTH - SEED_WORDS to either side. The first document with equal surroundings is their owner, and a
   later document's surroundings are a repeat as a whole.
2. In part, for the owners of surroundings only: a passage around an anchor reaches at least half of
   LENGTH - SEED_WORDS words to the left or to the right. Where a document shares that much of a side with
   another one, the anchor is extended word by word to every passage on that side. The first document
   to hold a passage owns it.

What overlaps is merged into maximal repeats. Rows are one per anchor (some 1 in 21 words) in the first
step, and one per passage around a partly matching anchor in the second.

Defined cases: order is by doc_id. A null id stands outside of the order: its document keeps all words
and takes none from others. Rows that share an id take nothing from each other. Null and empty texts,
and texts of fewer than LENGTH words, have no passage. A repeat inside one document is no repeat. Words
are compared by two hashes of 64 bits: of the anchor and its surroundings, or of a passage. Empty tables
give no rows.
Extra columns are not looked at by `report` and kept as they came by `clean`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerline.llm.frames import Scratch, small_batches, whole_rows
from ledgerline.llm.text import SPACED, TextBlock, Words, blocks, mix, span_hashes, window_hashes

LENGTH = 50
SEED_WORDS = 10
# Runs of SEED_WORDS words in a passage, and words a passage can reach beyond its anchor.
SPREAD = LENGTH - SEED_WORDS + 1
REACH = LENGTH - SEED_WORDS
HALF = REACH // 2

_OTHER = np.uint64(0x2545F4914F6CDD1D)

ANCHORS = (
    "doc_id long, tie long, place int, at int, stop int,"
    " anchor long, around long, to_left long, to_right long"
)
PASSAGES = "doc_id long, tie long, at int, later boolean, passage_a long, passage_b long"


def _twice(hashes: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> list[np.ndarray]:
    """Two independent hashes of each range."""
    return [
        span_hashes(h, starts, stops).view(np.int64) for h in (hashes, mix(hashes ^ _OTHER))
    ]


def anchors_of(words: Words, hashes: np.ndarray) -> np.ndarray:
    """Places of the anchors in a block: the last least seed of every SPREAD seeds of one text."""
    seeds = window_hashes(hashes, SEED_WORDS)
    if len(seeds) < SPREAD:
        return np.empty(0, dtype=np.int64)
    starts = np.arange(len(seeds) - SPREAD + 1)
    whole = words.doc[starts] == words.doc[starts + LENGTH - 1]
    seen = np.lib.stride_tricks.sliding_window_view(seeds, SPREAD)[whole][:, ::-1]
    return np.unique(starts[whole] + SPREAD - 1 - seen.argmin(axis=1))


def anchors(docs: DataFrame) -> DataFrame:
    """Every anchor with hashes of itself, of its surroundings [at, stop), and of half of either side.

    A half that the text is too short for is null. `tie` tells rows of one doc_id apart by their texts.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                words = TextBlock(part.column("text")).words(SPACED)
                hashes = words.hashes()
                places = anchors_of(words, hashes)
                doc = words.doc[places]
                first, end = words.first[doc], words.first[doc + 1]
                low, high = np.maximum(places - REACH, first), np.minimum(places + LENGTH, end)
                # Equal words around another place of the anchor are other surroundings.
                around = span_hashes(hashes, low, high) + (places - low).astype(np.uint64)
                after = places + SEED_WORDS
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c).take(pa.array(doc)) for c in ("doc_id", "tie")),
                        *(pa.array((x - first).astype(np.int32)) for x in (places, low, high)),
                        pa.array(window_hashes(hashes, SEED_WORDS)[places].view(np.int64)),
                        pa.array(mix(around).view(np.int64)),
                        _half(hashes, places - HALF, after, places - HALF >= first),
                        _half(hashes, places, after + HALF, after + HALF <= end),
                    ],
                    names,
                )

    names = _names(ANCHORS)
    rows = _tied_texts(small_batches(docs)).where("doc_id IS NOT NULL")
    return rows.mapInArrow(found, ANCHORS)


def _half(hashes: np.ndarray, starts: np.ndarray, stops: np.ndarray, fits: np.ndarray) -> pa.Array:
    values = np.zeros(len(fits), dtype=np.int64)
    values[fits] = span_hashes(hashes, starts[fits], stops[fits]).view(np.int64)
    return pa.array(values, mask=~fits)


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _tied_texts(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _tie().alias("tie"), text.alias("text"))


def _tie() -> Column:
    return F.xxhash64(F.col("text").isNull(), "text")


def firsts(rows: DataFrame, *key: str) -> DataFrame:
    """The first and the last document of each key.

    The second grouping lays the result out apart from the key, so that in a join with it a hot key can
    be split between tasks; see `operators.keyed`.
    """
    ends = [F.min("doc_id").alias("first"), F.max("doc_id").alias("last")]
    return rows.groupBy(*key, F.xxhash64(*key).alias("_spread")).agg(*ends).drop("_spread")


def spans(docs: DataFrame, keep: Scratch) -> DataFrame:
    """Words [at, stop) of documents, by (doc_id, tie), that an earlier document holds; may overlap."""
    seeds = keep.store(anchors(docs), "anchors")
    shared = firsts(seeds, "anchor").where("first < last").select("anchor")
    linked = keep.store(seeds.join(shared, "anchor"), "linked")
    keep.drop("anchors")

    owners = firsts(linked, "anchor", "around").select("anchor", "around", "first")
    known = linked.join(owners, ["anchor", "around"])
    known = keep.store(known.withColumn("whole", F.col("first") < F.col("doc_id")).drop("first"), "known")
    keep.drop("linked")
    in_full = known.where("whole").select("doc_id", "tie", "at", "stop")

    passages = keep.store(_passages(docs, _sides(known.where("NOT whole"), keep)), "passages")
    held = firsts(passages, "passage_a", "passage_b").where("first < last").drop("last")
    in_part = passages.where("later").join(held, ["passage_a", "passage_b"]).where("first < doc_id")
    in_part = in_part.select("doc_id", "tie", "at", (F.col("at") + F.lit(LENGTH)).alias("stop"))
    return in_full.unionByName(in_part)


def _sides(owned: DataFrame, keep: Scratch) -> DataFrame:
    """Words [at, stop) around anchors whose passages another document may hold, and if an earlier one."""
    left = F.struct(
        F.col("to_left").alias("half"),
        "at",
        # Passages that take all of the left half.
        F.least("stop", F.col("place") + F.lit(LENGTH - HALF)).alias("stop"),
        F.lit(True).alias("is_left"),
    )
    right = F.struct(
        F.col("to_right").alias("half"),
        F.greatest("at", F.col("place") - F.lit(HALF - 1)).alias("at"),
        "stop",
        F.lit(False).alias("is_left"),
    )
    each = owned.select("doc_id", "tie", "anchor", F.explode(F.array(left, right)).alias("side"))
    each = each.select("doc_id", "tie", "anchor", "side.*").where(
        F.col("half").isNotNull() & (F.col("stop") - F.col("at") >= F.lit(LENGTH))
    )
    each = keep.store(each, "sides")
    key = ["anchor", "half", "is_left"]
    others = firsts(each, *key).where("first < last")
    return each.join(others, key).select(
        "doc_id", "tie", "at", "stop", (F.col("first") < F.col("doc_id")).alias("later")
    )


def _passages(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Every passage of LENGTH words within the wanted words of each document, once."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                words = TextBlock(part.column("text")).words(SPACED)
                hashes = words.hashes()
                places = part.column("places")
                doc = np.repeat(np.arange(part.num_rows), np.diff(places.offsets.to_numpy()))
                at, stop, later = (np.asarray(c) for c in places.flatten().flatten())
                low = words.first[doc] + at
                starts = _covered(len(hashes), low, low + stop - at - LENGTH + 1)
                is_later = np.zeros(len(hashes) + 1, dtype=bool)
                is_later[_covered(len(hashes), low[later], (low + stop - at - LENGTH + 1)[later])] = True
                of = words.doc[starts]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c).take(pa.array(of)) for c in ("doc_id", "tie")),
                        pa.array((starts - words.first[of]).astype(np.int32)),
                        pa.array(is_later[starts]),
                        *map(pa.array, _twice(hashes, starts, starts + LENGTH)),
                    ],
                    names,
                )

    names = _names(PASSAGES)
    of_text = wanted.groupBy("doc_id", "tie").agg(
        F.collect_list(F.struct("at", "stop", "later")).alias("places")
    )
    return _tied_texts(docs).join(of_text, ["doc_id", "tie"]).mapInArrow(cut, PASSAGES)


def _covered(n: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Places below n within any of the ranges [low, high)."""
    steps = np.zeros(n + 1, dtype=np.int64)
    np.add.at(steps, low, 1)
    np.add.at(steps, high, -1)
    return np.flatnonzero(np.cumsum(steps[:-1]) > 0)


def _merged(part: pa.RecordBatch, words: Words) -> np.ndarray:
    """Which words of a block lie in a span."""
    places = part.column("spans")
    doc = np.repeat(np.arange(part.num_rows), np.diff(places.offsets.to_numpy()))
    at, stop = (np.asarray(c, dtype=np.int64) for c in places.flatten().flatten())
    gone = np.zeros(len(words.starts), dtype=bool)
    gone[_covered(len(gone), words.first[doc] + at, words.first[doc] + stop)] = True
    return gone


def _with_spans(
    docs: DataFrame, rows: DataFrame, columns: list[str], schema: str | StructType, made: Callable
) -> DataFrame:
    """Hand each text with its spans to `made`, which gives arrays beside the passed columns."""
    keep = Scratch(docs.sparkSession, "repeats")
    found = spans(docs, keep).groupBy("doc_id", "tie")
    found = keep.store(found.agg(F.collect_list(F.struct("at", "stop")).alias("spans")), "spans")
    keep.drop("known", "sides", "passages")
    none = F.array().cast("array<struct<at:int,stop:int>>")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                words = TextBlock(part.column("text")).words(SPACED)
                beside = made(words, _merged(part, words))
                passed = {c: part.column(c) for c in columns}
                yield pa.RecordBatch.from_pydict(passed | beside)

    joined = rows.join(found, ["doc_id", "tie"], "left").withColumn("spans", F.coalesce("spans", none))
    return joined.mapInArrow(each, schema)


def report(docs: DataFrame) -> DataFrame:
    """Per document its words, how many are removed, and a digest of those kept."""

    def made(words: Words, gone: np.ndarray) -> dict:
        data = words.block.data.tobytes()
        first = words.first.tolist()
        starts, ends, kept = words.starts.tolist(), words.ends.tolist(), ~gone
        sums = []
        for low, high in zip(first, first[1:]):
            mine = (np.flatnonzero(kept[low:high]) + low).tolist()
            sums.append(hashlib.sha256(b" ".join([data[starts[k] : ends[k]] for k in mine])).hexdigest())
        removed = np.add.reduceat(np.append(gone, False).astype(np.int64), words.first[:-1])
        removed[words.counts == 0] = 0
        return {
            "n_words": pa.array(words.counts.astype(np.int64)),
            "n_removed": pa.array(removed),
            "kept_sha256": pa.array(sums, pa.string()),
        }

    rows = _tied_texts(small_batches(docs))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return _with_spans(docs, rows, ["doc_id"], schema, made)


def clean(docs: DataFrame) -> DataFrame:
    """The documents without repeats, all columns as they came; n_chars, if there, is counted anew.

    Untouched texts stay as they are, byte by byte. In others the repeats go with the white space
    behind them; a text that is all repeat becomes empty.
    """

    def made(words: Words, gone: np.ndarray) -> dict:
        data, out = words.block.data, []
        offsets, first = words.block.offsets.tolist(), words.first.tolist()
        for k, (low, high) in enumerate(zip(first, first[1:])):
            begin, end = offsets[k], offsets[k + 1]
            cut = np.flatnonzero(gone[low:high]) + low
            if not len(cut):
                out.append(None)
                continue
            left = np.ones(end - begin, dtype=bool)
            after = np.append(words.starts[low + 1 : high], end)
            for w in cut.tolist():
                left[words.starts[w] - begin : after[w - low] - begin] = False
            out.append(data[begin:end][left].tobytes().decode())
        return {"changed": pa.array(out, pa.string())}

    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    rows = whole_rows(docs, doc_id.alias("doc_id"), _tie().alias("tie"), text.alias("text"))
    schema = StructType([rows.schema["row"], StructField("changed", StringType())])
    out = _with_spans(docs, rows, ["row"], schema, made)

    def column(name: str) -> Column:
        own = F.col("row").getField(name)
        if name == "text":
            return F.coalesce("changed", own).alias(name)
        if name == "n_chars":
            fresh = F.length("changed").cast(docs.schema[name].dataType)
            return F.coalesce(fresh, own).alias(name)
        return own.alias(name)

    return out.select(*[column(c) for c in docs.columns])

