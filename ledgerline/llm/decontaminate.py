"""Benchmark decontamination over a distributed positional inverted index.

The index is cut by documents: a shard holds some whole texts, and for each of its terms the ascending
word positions at which the term stands. It is written to the shared folder, so it outlives executors
and serves several phrase sets. Phrases are looked up shard by shard: the positions of a phrase's rarest
term, counted over the whole corpus, are shifted to the phrase's start and then intersected with the
lists of its other terms, the next rarest first (of equally rare ones, the earlier in the phrase). With
`slop` 0 a match is the exact phrase; with more, every other term may stand up to `slop` words off its
place, in the same document.

Defined cases: a null or empty text has no words and no match; an item without words has no phrase; an
item with fewer words than a phrase is one phrase. A null item_id reads as the empty string. Rows of
the benchmark that share an item_id are one item. Repeated documents are indexed one by one. Empty
tables give no matches. Terms are 64-bit hashes of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.frames import row_key, small_batches, stored, whole_rows
from ledgerline.llm.text import ALNUM, TextBlock, blocks

PHRASE_WORDS = 10
# Words that a term may be off its place in the proximity matches of the registered query.
NEAR = 2
# Phrases looked up in one pass over the index: what a pass ships to each task is bounded by this.
PASS_PHRASES = 100_000
# Bytes of text in a shard, so that one shard's lists fit a task; a longer text has its own shard.
SHARD_BYTES = 4_000_000
# Start positions tested at once within a shard.
TESTED_AT_ONCE = 2_000_000

INDEX = (
    "shard long, term long, n long, positions binary,"
    " doc_ids array<long>, keys_a array<long>, keys_b array<long>, words array<long>"
)


def index(docs: DataFrame) -> DataFrame:
    """Postings of every word of every text, and one row per shard that lists its documents.

    `positions` are differences of neighbouring word positions, the first from -1, as unsigned 32-bit
    numbers; a document's words follow those of the one before it.
    """

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in blocks(batch, "text", SHARD_BYTES):
                words = TextBlock(part.column("text"), lower=True).words(ALNUM)
                terms = words.hashes().view(np.int64)
                order = np.argsort(terms, kind="stable")
                term, first = np.unique(terms[order], return_index=True)
                bounds = np.append(first, len(order))
                steps = np.diff(order, prepend=-1)
                steps[first] = order[first] + 1
                data = pa.py_buffer(steps.astype("<u4"))
                lists = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(term), [None, pa.py_buffer(bounds * 4), data]
                )
                k, none = len(term), pa.nulls(len(term), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(k, number)),
                        pa.array(term),
                        pa.array(np.diff(bounds)),
                        lists.cast(pa.binary()),
                        *[none] * 4,
                    ],
                    names,
                )
                listed = [
                    pa.array([c.to_pylist()], pa.list_(pa.int64()))
                    for c in (*(part.column(c) for c in ("doc_id", "a", "b")), pa.array(words.counts))
                ]
                empty = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array([number]), *empty, *listed], names)
                number += 1

    names = [c.strip().split()[0] for c in INDEX.split(",")]
    small_batches(docs)
    key = row_key("doc_id", "text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("k"), "text")
    rows = rows.select("doc_id", "k.a", "k.b", "text").mapInArrow(postings, INDEX)
    return stored(rows, "postings")


def phrases(items: DataFrame, size: int = PHRASE_WORDS) -> DataFrame:
    """Each distinct run of `size` words of the items, with the items that hold it."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                words = TextBlock(part.column("text"), lower=True).words(ALNUM)
                terms = words.hashes().view(np.int64)
                ids, runs = [], []
                for k, item in enumerate(part.column("item_id").to_pylist()):
                    own = terms[words.first[k] : words.first[k + 1]].tolist()
                    for at in range(max(len(own) - size + 1, min(len(own), 1))):
                        ids.append(item)
                        runs.append(own[at : at + size])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.string()), pa.array(runs, pa.list_(pa.int64()))],
                    ["item_id", "terms"],
                )

    plain = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text"
    )
    runs = plain.mapInArrow(cut, "item_id string, terms array<long>")
    return runs.groupBy("terms").agg(F.array_sort(F.collect_set("item_id")).alias("items"))


# Without an item, the range is covered by matches of any items.
MATCH = "slop int, shard long, doc_no long, item_id string, start long, stop long"


def _lookup(ids, doc_of, phrase_terms, offsets, anchors, lists, slop):
    """Matches in one shard, as (phrase, document, start) arrays; a start may lie before the document.

    ids: term number at each position, or -1; phrase_terms, offsets: per phrase its terms and their
    places, rarest first; lists: positions by term number.
    """
    width = phrase_terms.shape[1]
    sizes = np.array([len(lists[t]) if t in lists else 0 for t in anchors])
    alive = np.flatnonzero(sizes)
    total, begin = np.cumsum(sizes[alive]), 0
    while begin < len(alive):
        done = total[begin - 1] if begin else 0
        end = max(int(np.searchsorted(total, done + TESTED_AT_ONCE, side="right")), begin + 1)
        group = alive[begin:end]
        phrase = np.repeat(group, sizes[group])
        start = np.concatenate([lists[t] for t in anchors[group]]) - offsets[phrase, 0]
        # The rarest term is in the document; the frame of unmoved terms may reach beyond it.
        doc = doc_of[start + offsets[phrase, 0]]
        for place in range(1, width):
            wanted, at = phrase_terms[phrase, place], start + offsets[phrase, place]
            near = wanted < 0
            for shift in range(-slop, slop + 1):
                moved = np.clip(at + shift, 0, len(ids) - 1)
                inside = moved == at + shift
                near = near | (inside & (ids[moved] == wanted) & (doc_of[moved] == doc))
            phrase, doc, start = phrase[near], doc[near], start[near]
        yield phrase, doc, start
        begin = end


def matches(postings: DataFrame, wanted: DataFrame, slop: int = 0) -> DataFrame:
    """Every run of words of a document covered by matches of one item, as word ranges [start, stop).

    `wanted` comes from `phrases`. It is worked off in passes of about PASS_PHRASES phrases, whose matches
    are written before the next pass is planned; only one pass's phrases and the corpus counts of their
    terms are on the driver at a time.
    """
    return _found(postings, wanted, (slop,)).where("item_id IS NOT NULL").drop("slop")


def _found(postings: DataFrame, wanted: DataFrame, slops: tuple[int, ...]) -> DataFrame:
    """Matches for several slops, which share one reading of the index."""
    wanted = stored(wanted, "phrases")
    passes = -(-wanted.count() // PASS_PHRASES)
    out = postings.sparkSession.createDataFrame([], MATCH)
    for part in _parts(wanted, passes):
        if part:
            out = out.unionByName(stored(_pass(postings, part, slops), "matches"))
    return out


def _parts(wanted: DataFrame, passes: int) -> Iterator[list]:
    for k in range(passes):
        part = wanted.where(F.pmod(F.xxhash64("terms"), F.lit(passes)) == k)
        yield sorted(part.collect(), key=lambda r: r["terms"])


def _pass(postings: DataFrame, rows: list, slops: tuple[int, ...]) -> DataFrame:
    spark = postings.sparkSession
    vocabulary = sorted({t for r in rows for t in r["terms"]})
    # At most PASS_PHRASES * PHRASE_WORDS numbers by construction.
    terms = F.broadcast(spark.createDataFrame([(t,) for t in vocabulary], "term long"))
    lists = postings.where("term IS NOT NULL").select("shard", "term", "n", "positions")
    lists = lists.join(terms, "term", "left_semi")
    df = {r["term"]: r["n"] for r in lists.groupBy("term").agg(F.sum("n").alias("n")).collect()}

    number = {t: k for k, t in enumerate(vocabulary)}
    width = max(len(r["terms"]) for r in rows)
    phrase_terms = np.full((len(rows), width), -1, dtype=np.int32)
    offsets = np.zeros((len(rows), width), dtype=np.int32)
    for k, r in enumerate(rows):
        rarest = sorted(range(len(r["terms"])), key=lambda j: (df.get(r["terms"][j], 0), j))
        phrase_terms[k, : len(rarest)] = [number[r["terms"][j]] for j in rarest]
        offsets[k, : len(rarest)] = rarest
    # A phrase with a term that the corpus lacks cannot occur.
    possible = np.array([all(t in df for t in r["terms"]) for r in rows])
    phrase_terms, offsets = phrase_terms[possible], offsets[possible]
    items = [r["items"] for r, p in zip(rows, possible) if p]
    vocabulary = np.array(vocabulary, dtype=np.int64)
    names = [c.strip().split()[0] for c in MATCH.split(",")]

    def in_shard(table: pa.Table) -> pa.Table:
        of = {c: table.column(c) for c in table.column_names}
        is_term = np.asarray(of["term"].is_valid())
        header = table.filter(pa.array(~is_term)).slice(0, 1)
        counts = np.array(header.column("words")[0].as_py(), dtype=np.int64)
        doc_of = np.repeat(np.arange(len(counts)), counts)
        first = np.cumsum(counts) - counts
        ids = np.full(int(counts.sum()), -1, dtype=np.int32)
        lists = {}
        mine = table.filter(pa.array(is_term))
        for term, steps in zip(mine.column("term").to_pylist(), mine.column("positions")):
            at = np.cumsum(np.frombuffer(steps.as_buffer(), dtype="<u4").astype(np.int64)) - 1
            k = int(np.searchsorted(vocabulary, term))
            lists[k], ids[at] = at, k
        shard = of["shard"][0].as_py()
        out = []
        for slop in slops:
            found = [(np.empty(0, np.int64),) * 3]
            if len(phrase_terms) and len(ids):
                anchors = phrase_terms[:, 0]
                found += list(_lookup(ids, doc_of, phrase_terms, offsets, anchors, lists, slop))
            phrase, doc, start = (np.concatenate(x) for x in zip(*found))
            length = (phrase_terms[phrase] >= 0).sum(axis=1)
            stop = np.minimum(start + length, (first + counts)[doc])
            start = np.maximum(start, first[doc])
            spans: dict[tuple, list] = {}
            order = np.argsort(start, kind="stable")
            each = (x[order].tolist() for x in (phrase, doc, start, stop))
            for p, d, s, e in zip(*each):
                for item in (None, *items[p]):
                    own = spans.setdefault((d, item), [])
                    if own and s <= own[-1][1]:
                        own[-1][1] = max(own[-1][1], e)
                    else:
                        own.append([s, e])
            out += [
                (slop, shard, doc, item, a - int(first[doc]), b - int(first[doc]))
                for (doc, item), own in spans.items()
                for a, b in own
            ]
        columns = list(zip(*out)) or [[]] * 6
        types = [pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    headers = postings.where("term IS NULL").select("shard", "words")
    both = lists.select("shard", "term", "positions").unionByName(headers, allowMissingColumns=True)
    return both.groupBy("shard").applyInArrow(in_shard, MATCH)


def _covered(spans: Column) -> Column:
    """Number of words in an array of ranges that may overlap."""
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))

    def add(done: Column, span: Column) -> Column:
        fresh = F.greatest(span["stop"] - F.greatest(span["start"], done["end"]), F.lit(0))
        return F.struct(
            F.greatest(done["end"], span["stop"]).alias("end"), (done["n"] + fresh).alias("n")
        )

    return F.aggregate(F.array_sort(spans), start, add, lambda done: done["n"])


def report(docs: DataFrame, items: DataFrame, near: int = 0) -> DataFrame:
    """Per document its words, the words within exact matches, and the items that match.

    With `near`, also the number of items with a match whose words are up to so many off their places.
    """
    postings = index(docs)
    exact, item = F.col("slop") == 0, F.col("item_id").isNotNull()
    found = _found(postings, phrases(items), (0, near) if near else (0,))
    found = found.groupBy("shard", "doc_no").agg(
        _covered(F.collect_list(F.when(exact & ~item, F.struct("start", "stop")))).alias("n_hit"),
        F.array_sort(F.collect_set(F.when(exact, F.col("item_id")))).alias("items"),
        F.size(F.collect_set(F.when(~exact, F.col("item_id")))).alias("n_near_items"),
    )
    rows = postings.where("term IS NULL").select(
        "shard", F.posexplode(F.arrays_zip("doc_ids", "keys_a", "keys_b", "words"))
    )
    rows = rows.select("shard", F.col("pos").cast("long").alias("doc_no"), "col.*")
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce(F.col("n_hit").cast("long"), F.lit(0).cast("long"))
    n_near = F.coalesce(F.col("n_near_items").cast("long"), F.lit(0).cast("long"))
    return rows.join(found, ["shard", "doc_no"], "left").select(
        F.col("doc_ids").alias("doc_id"),
        F.col("words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(items_of).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_of, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        *([n_near.alias("n_near_items")] if near else []),
        F.col("keys_a").alias("key_a"),
        F.col("keys_b").alias("key_b"),
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without a match, all columns as they came."""
    dirty = report(docs, items).where("contaminated").select("key_a", "key_b").distinct()
    keyed = whole_rows(docs, row_key("doc_id", "text").alias("k"))
    keyed = keyed.select("row", F.col("k.a").alias("key_a"), F.col("k.b").alias("key_b"))
    return keyed.join(dirty, ["key_a", "key_b"], "left_anti").select("row.*")
