"""Exact Jaccard join of documents as sets of word n-grams, by pivots in the Jaccard metric space.

Distance is 1 - |x & y| / |x | y|, and two documents link within EPSILON of each other. Equal sets are
one point. The regions come in two kinds:

* Regions of shared n-grams. All n-grams have one order: those that many documents hold last, the rest
  by hash. A set of size n may differ from a linked set in fewer than n - ceil(0.8 n) + 1 of its own
  n-grams, so two linked sets share one of that many first ones. Each n-gram is thus a one-element
  pivot; a set belongs to the regions of its window of first n-grams. Whole documents do not serve
  here: nearly all of them are at distance 1 from any document, and a window of twice EPSILON around a
  cell border would put every document in every cell.
* Cells of pivot documents. The most typical set of each region, in whose order the shared n-gram stands
  first, becomes the region's pivot, and a set joins the cell of each of its pivots. Linked sets share a
  region, so they share a cell. Within a cell the exact distances to the pivot are taken. Sets within
  EPSILON link to it, and need not be compared with each other to know their component. Every other set
  becomes the pivot of what is left, and by the triangle inequality only meets sets whose distance to
  the first pivot differs from its own by EPSILON at most. This goes on until nothing is left.

Before whole sets meet in a cell, their counts in parts of the universe do. These are distances to
pivots too, and sets whose counts differ by more than linked sets can are ruled out.

A cell with more than CELL_NGRAMS n-grams is cut into tiles. Each tile joins with the pivot, and only the sets
that do not link to the pivot, those beyond its ball, are copied to the other tiles. No cell, and no
n-gram, is ever in one task whole because it is popular.

Defined cases: a text with fewer words than an n-gram is one n-gram as a whole; a text without words, or
null, is empty and links with nothing. Repeated rows are copies. A null doc_id never is a component's
smallest, unless it is alone: then the component is null. Extra columns are not looked at.
N-grams are 64-bit hashes, and so are the names of sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerline.llm.frames import row_key, small_batches, stored, whole_rows
from ledgerline.llm.text import SPACED, TextBlock, blocks, mix, window_hashes
from ledgerline.operators import keyed

WORDS = 5
# Linked: 100 * intersection >= PERCENT * union.
PERCENT = 80
EPSILON = 1 - PERCENT / 100
# The order of n-grams knows the counts of this many, the most frequent ones. It only steers the work.
FREQUENT = 1 << 18
# N-grams held while counting; an n-gram met this often among them is reported.
COUNTED_AT_ONCE = 2_000_000
REPORTED = 6
# From this count on the pivot of an n-gram's region is found by a distributed minimum.
HOT = 2_000
BUCKET_ROWS = 400_000
# Sketches compared at once, and n-grams of whole sets joined at once.
CELL_SETS = 4_000
CELL_NGRAMS = 4_000_000
# Rows of a few numbers that may be broadcast; more of them meet in a shuffled join.
BROADCAST_ROWS = 1_000_000


def ngram_sets(texts: pa.Array, size: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct n-grams of each text."""
    words = TextBlock(texts, lower=True).words(SPACED)
    hashes = words.hashes()
    windows = window_hashes(hashes, size)
    sets = []
    for a, b in zip(words.first.tolist(), words.first[1:].tolist()):
        if b - a >= size:
            own = np.sort(windows[a : b - size + 1])
            keep = np.empty(len(own), dtype=bool)
            keep[0] = True
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            sets.append(own[keep])
        else:
            sets.append(window_hashes(hashes[a:b], b - a) if b > a else hashes[:0])
    return sets


def set_name(ngrams: np.ndarray) -> int:
    """A signed 64-bit name that equal sets share."""
    total = mix(ngrams ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64)
    total = mix(np.array([total + np.uint64(len(ngrams))], dtype=np.uint64))
    return int(total.view(np.int64)[0])


def sketch(ngrams: np.ndarray) -> bytes:
    """How many n-grams of a set lie in each part of the universe, up to 255; n / 8 parts or more.

    Each count is a distance to a pivot that is a part: what one set has more of than another, in all
    parts together, is at most the size of their difference.
    """
    parts = max(64, 1 << (len(ngrams) // 8).bit_length())
    place = (ngrams >> np.uint64(16)).astype(np.int64) & (parts - 1)
    return np.minimum(np.bincount(place, minlength=parts), 255).astype(np.uint8).tobytes()


class Sketches:
    """Sketches of some sets. Those of twice as many parts are folded to compare them."""

    def __init__(self, sketches: list[bytes]):
        counts = [np.frombuffer(c, dtype=np.uint8).astype(np.int16) for c in sketches]
        self.parts = np.array([len(c) for c in counts], dtype=np.int64)
        self.levels = {}
        for level in np.unique(self.parts).tolist():
            members = np.flatnonzero((self.parts == level) | (self.parts == 2 * level))
            folded = [
                counts[k] if len(counts[k]) == level else counts[k].reshape(2, -1).sum(axis=0)
                for k in members.tolist()
            ]
            row = np.full(len(counts), -1)
            row[members] = np.arange(len(members))
            # Counts that were cut off at 255 before folding stay comparable cut off after it.
            self.levels[level] = np.minimum(np.array(folded), 255), row

    def near(self, size: np.ndarray, at: int, to: np.ndarray) -> np.ndarray:
        """Which sets of `to` may link to one, by their counts; all of them may by their sizes.

        Linked sets differ in a ninth of their n-grams, counted with both sets, at most.
        """
        out = np.zeros(len(to), dtype=bool)
        common = np.minimum(self.parts[to], self.parts[at])
        for level in np.unique(common).tolist():
            matrix, row = self.levels[level]
            here = np.flatnonzero(common == level)
            # Sizes that allow a link are less than two apart in the number of parts.
            there = row[to[here]]
            apart = np.abs(matrix[there] - matrix[row[at]]).sum(axis=1, dtype=np.int64)
            bound = (100 - PERCENT) * (size[to[here]] + size[at])
            out[here] = apart * (100 + PERCENT) <= bound
        return out


def _named_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for part in blocks(batch, "text"):
            yield part, ngram_sets(part.column("text"))


def _members(docs: DataFrame) -> DataFrame:
    """Every row with the name and size of its set."""

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _named_sets(batches):
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(c) for c in ("doc_id", "a", "b")),
                    pa.array([set_name(s) for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([sketch(s) for s in sets], pa.binary()),
                ],
                ["doc_id", "a", "b", "sid", "n", "sketch"],
            )

    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), row_key("doc_id", "text").alias("k"), "text"
    ).select("doc_id", "k.a", "k.b", "text")
    rows = keyed.mapInArrow(named, "doc_id long, a long, b long, sid long, n long, sketch binary")
    return stored(rows, "members")


def _fresh(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """Name and n-grams of every set a task meets, without copies and empty sets."""
    seen = set()
    for _, sets in _named_sets(batches):
        for s in sets:
            name = set_name(s)
            if len(s) and name not in seen:
                seen.add(name)
                yield name, s


def _frequent(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent n-grams, ascending, and their counts.

    Every task counts all its n-grams; those it meets less than REPORTED times it keeps to itself.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def report(held):
            all_ = np.sort(np.concatenate(held))
            first = np.flatnonzero(np.append(True, all_[1:] != all_[:-1]))
            times = np.diff(np.append(first, len(all_)))
            often = times >= REPORTED
            keys = pa.array(all_[first[often]].view(np.int64))
            return pa.RecordBatch.from_arrays([keys, pa.array(times[often])], ["ngram", "n"])

        held, size = [], 0
        for _, s in _fresh(batches):
            held.append(s)
            size += len(s)
            if size > COUNTED_AT_ONCE:
                yield report(held)
                held, size = [], 0
        if held:
            yield report(held)

    counts = docs.select("text").mapInArrow(counted, "ngram long, n long")
    counts = counts.groupBy("ngram").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "ngram").limit(FREQUENT).toArrow()
    ngram = top.column("ngram").to_numpy().view(np.uint64)
    order = np.argsort(ngram)
    return ngram[order], top.column("n").to_numpy()[order]


def _window(ngrams: np.ndarray, frequent: np.ndarray, counts: np.ndarray) -> tuple:
    """The first n-grams of a set, so many that linked sets share one.

    With the place of each among the frequent ones, or -1.
    """
    n = len(ngrams)
    take = n - (PERCENT * n + 99) // 100 + 1
    if not len(frequent):
        return ngrams[:take], np.full(take, -1)
    at = np.minimum(np.searchsorted(frequent, ngrams), len(frequent) - 1)
    found = frequent[at] == ngrams
    # Sets are sorted by hash, and the sort is stable.
    order = np.argsort(np.where(found, counts[at], 0), kind="stable")[:take]
    return ngrams[order], np.where(found, at, -1)[order]


def _pivots(docs: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs of a set and a pivot set of one of its regions; regions of one set are left out.

    Rows go to a bucket of their n-gram, where each region finds its pivot. Rows of hot n-grams go by
    their set instead, and their pivots come from a minimum with a map side.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(_frequent(docs))  # at most FREQUENT entries
    total = members.agg(F.sum("n")).first()[0] or 0
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(buckets, total * (100 - PERCENT) // 100 // BUCKET_ROWS + 1)

    def regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, counts = shared.value
        hot_counts = np.append(counts, 0)
        held, size = [], 0

        def rows(held):
            ngram = np.concatenate([w for _, w, _ in held])
            rank = np.concatenate([r for _, _, r in held])
            sizes = [len(w) for _, w, _ in held]
            sid = np.repeat(np.array([name for name, _, _ in held]), sizes)
            place = np.concatenate([np.arange(k, dtype=np.int32) for k in sizes])
            hot = hot_counts[rank] >= HOT
            bucket = np.where(
                hot, -1 - (sid.view(np.uint64) % np.uint64(buckets)).astype(np.int64),
                (ngram % np.uint64(buckets)).astype(np.int64),
            )
            # Within a bucket 32 bits tell n-grams apart well enough; a mix-up only widens a region.
            short = np.where(hot, rank, (ngram >> np.uint64(32)).view(np.int64))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket.astype(np.int32)),
                    pa.array(short.astype(np.uint32).view(np.int32)),
                    pa.array(sid),
                    pa.array(place),
                ],
                ["bucket", "ngram", "sid", "place"],
            )

        for name, s in _fresh(batches):
            held.append((name, *_window(s, frequent, counts)))
            size += len(held[-1][1])
            if size > 50_000:
                yield rows(held)
                held, size = [], 0
        if held:
            yield rows(held)

    def with_pivots(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < 0:
            n = table.num_rows
            return pa.table(
                [*(table.column(c) for c in ("ngram", "place", "sid")), pa.nulls(n, pa.int64())],
                names=["ngram", "place", "sid", "pivot"],
            )
        ngram, sid = table.column("ngram").to_numpy(), table.column("sid").to_numpy()
        by = np.lexsort((sid, table.column("place").to_numpy(), ngram))
        ngram, sid = ngram[by], sid[by]
        first = np.flatnonzero(np.append(True, ngram[1:] != ngram[:-1]))
        size = np.diff(np.append(first, len(ngram)))
        pivot = np.repeat(sid[first], size)
        several = np.repeat(size > 1, size)
        pairs = np.unique(np.stack([sid[several], pivot[several]], axis=1), axis=0)
        none = pa.nulls(len(pairs), pa.int32())
        return pa.table(
            [none, none, pa.array(pairs[:, 0]), pa.array(pairs[:, 1])],
            names=["ngram", "place", "sid", "pivot"],
        )

    rows = docs.select("text").mapInArrow(regions, "bucket int, ngram int, sid long, place int")
    rows = rows.groupBy("bucket").applyInArrow(
        with_pivots, "ngram int, place int, sid long, pivot long"
    )
    rows = stored(rows, "regions")
    cold = rows.where("pivot IS NOT NULL").select("sid", "pivot")
    hot = rows.where("pivot IS NULL").select("ngram", "sid", "place")
    # At most FREQUENT rows.
    best = F.broadcast(
        hot.groupBy("ngram").agg(
            F.min(F.struct("place", "sid"))["sid"].alias("pivot"), F.count("*").alias("size")
        )
    )
    hot = hot.join(best, "ngram").where("size > 1").select("sid", "pivot")
    return stored(cold.unionByName(hot).distinct(), "pivots")


def _representatives(docs: DataFrame, members: DataFrame, only: DataFrame) -> DataFrame:
    """The text of one document for each of some sets."""
    best = members.where("n > 0").groupBy("sid").agg(F.min(F.struct("a", "b")).alias("k"))
    best = _bounded(stored(best.join(only, "sid", "left_semi").select("k.a", "k.b"), "wanted"))
    keyed = docs.select(row_key("doc_id", "text").alias("k"), "text").select("k.a", "k.b", "text")
    return keyed.join(best, ["a", "b"], "left_semi").select("text")


def packed(ngrams: np.ndarray) -> bytes:
    return ngrams.astype("<u8").tobytes()


def unpacked(data: pa.Buffer) -> np.ndarray:
    return np.frombuffer(data, dtype="<u8")


def join_cell(
    sets: list[np.ndarray], pivot: int, probes: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Components among the sets of a cell, and the sets that do not link to the pivot.

    `pivot` is the pivot's place. With `probes`, a mask, only pairs with a probe are of interest.
    """
    size = np.array([len(s) for s in sets])
    _, element = np.unique(np.concatenate(sets), return_inverse=True)
    start = np.cumsum(size) - size
    mark = np.zeros(element.max() + 1, dtype=np.int64)

    def linked(at: int, to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mark[element[start[at] : start[at] + size[at]]] = 1
        if len(to) == len(size):
            held = np.add.reduceat(mark[element], start)
        else:
            spans = np.concatenate([element[start[k] : start[k] + size[k]] for k in to.tolist()])
            held = np.add.reduceat(mark[spans], np.cumsum(size[to]) - size[to])
        mark[element[start[at] : start[at] + size[at]]] = 0
        union = size[to] + size[at] - held
        return 100 * held >= PERCENT * union, 1 - held / union

    every = np.arange(len(sets))
    counts = Sketches([sketch(s) for s in sets])
    near, distance = linked(pivot, every)
    component = every.copy()
    component[near] = pivot
    beyond = np.flatnonzero(~near)
    done = np.zeros(len(sets), dtype=bool)
    for at in (beyond if not probes.any() else np.flatnonzero(probes)).tolist():
        done[at] = True
        window = np.abs(distance - distance[at]) <= EPSILON + 1e-9
        fits = 100 * np.minimum(size, size[at]) >= PERCENT * np.maximum(size, size[at])
        left = np.flatnonzero(window & fits & ~done & (component != component[at]))
        left = left[counts.near(size, at, left)]
        if not len(left):
            continue
        hits, _ = linked(at, left)
        for other in np.unique(component[left[hits]]).tolist():
            component[component == other] = component[at]
    return component, beyond


def possible(size: np.ndarray, sketches: list[bytes]) -> np.ndarray:
    """Groups of the sets of a cell that may be linked, by sizes and sketches: a number for each set.

    A set that cannot link to any other has a number of its own.
    """
    order = np.argsort(size, kind="stable")
    size, counts = size[order], Sketches([sketches[k] for k in order.tolist()])
    group = np.arange(len(size))
    ends = np.searchsorted(PERCENT * size, 100 * size, side="right")
    for k, end in enumerate(ends.tolist()):
        to = np.arange(k + 1, end)
        to = to[group[to] != group[k]]
        for other in np.unique(group[to[counts.near(size, k, to)]]).tolist():
            group[group == other] = group[k]
    out = np.empty_like(group)
    out[order] = group
    return out


def _narrowed(table: pa.Table) -> pa.Table:
    """The sets of a cell that may link to others in it, each with the first set of its group."""
    order = table.sort_by("sid")
    sid = order.column("sid").to_numpy()
    group = possible(order.column("n").to_numpy(), order.column("sketch").to_pylist())
    _, first, label, size = np.unique(group, return_index=True, return_inverse=True, return_counts=True)
    left = size[label] > 1
    return pa.table(
        {
            "sid": sid[left],
            "other": sid[first[label]][left],
            "pivot": np.full(int(left.sum()), order.column("pivot")[0].as_py()),
        }
    )


_EDGE = "sid long, other long, tile int"


def _in_cell(table: pa.Table) -> pa.Table:
    pivot, tile = table.column("pivot")[0].as_py(), table.column("tile")[0].as_py()
    cell = table.column("cell")[0].as_py()
    by = table.sort_by([("sid", "ascending"), ("probe", "descending")])
    names = by.column("sid").to_numpy()
    # A probe that is at home here as well counts once.
    first = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
    names, probes = names[first], np.asarray(by.column("probe"))[first]
    sets = [unpacked(x.as_buffer()) for x in by.column("ngrams").take(pa.array(first))]
    out: list[tuple] = []
    if len(names) > 1:
        component, beyond = join_cell(sets, int(np.searchsorted(names, pivot)), probes)
        root = names[component]
        out = [(s, r, None) for s, r in zip(names.tolist(), root.tolist()) if s != r]
        if tile >= 0 and not probes.any():
            # What lies beyond the pivot's ball has to see the other tiles.
            out += [(int(names[k]), cell, tile) for k in beyond]
    columns = list(zip(*out)) or [[]] * 3
    types = (pa.int64(), pa.int64(), pa.int32())
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["sid", "other", "tile"])


def _bounded(rows: DataFrame) -> DataFrame:
    """Marked for broadcast if it has few rows; the rows are a few numbers each."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _placed(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Which sets meet in which cell and tile: cell, pivot, tiles, tile, sid.

    Cells are narrowed by sketches first, which rules out nearly all sets that share no more than a
    passage. What is left of them often overlaps, as a group of copies has several pivots; overlapping
    cells are joined into one, so that every whole set travels once. Its pivot is the set that was one
    for the most others.
    """
    sizes = keyed(pairs, "pivot", F.count(F.lit(1)).alias("size")).where("size > 1")
    rows = stored(pairs.join(sizes, "pivot"), "cells")
    few = F.col("size") <= CELL_SETS
    sketches = members.where("n > 0").groupBy("sid").agg(
        F.first("n").alias("n"), F.first("sketch").alias("sketch")
    )
    narrowed = _bounded(rows.where(few).select("sid", "pivot")).join(sketches, "sid")
    narrowed = narrowed.groupBy("pivot").applyInArrow(
        _narrowed, "sid long, other long, pivot long"
    )
    large = rows.where(~few).select("sid", F.col("pivot").alias("other"), "pivot")
    near = stored(narrowed.unionByName(large), "near")
    roots = components(near.select("sid", "other"))
    cell_of = near.select("sid").distinct().join(roots, "sid", "left")
    cell_of = stored(cell_of.select("sid", F.coalesce("root", "sid").alias("cell")), "merged")
    weight = near.groupBy(F.col("pivot").alias("sid")).agg(F.count("*").alias("weight"))
    sized = cell_of.join(sketches.select("sid", "n"), "sid")
    cells = keyed(
        sized.join(weight, "sid", "left"),
        "cell",
        F.count("*").alias("size"),
        F.sum("n").alias("ngrams"),
        F.max(F.struct(F.coalesce("weight", F.lit(0)), "sid"))["sid"].alias("pivot"),
    )
    tiles = F.ceil(F.col("ngrams") / F.lit(CELL_NGRAMS)).cast("int")
    cells = cells.where("size > 1").select("cell", "pivot", tiles.alias("tiles"))
    # A cell of one tile has no tile number; the pivot of a larger one is in every tile.
    tile = F.pmod(F.xxhash64("sid"), F.col("tiles")).cast("int")
    tile_of = (
        F.when(F.col("tiles") == 1, F.array(F.lit(-1)))
        .when(F.col("sid") == F.col("pivot"), _every_tile())
        .otherwise(F.array(tile))
    )
    placed = cell_of.join(cells, "cell").withColumn("tile", F.explode(tile_of))
    return stored(placed.select("cell", "pivot", "tiles", "tile", "sid"), "placed")


def _every_tile():
    return F.sequence(F.lit(0), F.col("tiles") - F.lit(1))


def _cells(placed: DataFrame, sets: DataFrame) -> DataFrame:
    """Links of all cells, as pairs of set names that make their components."""

    def joined(part: DataFrame) -> DataFrame:
        part = _bounded(part.select("cell", "pivot", "tile", "sid", "probe"))
        return part.join(sets, "sid").groupBy("cell", "tile").applyInArrow(_in_cell, _EDGE)

    home = placed.withColumn("probe", F.lit(False))
    links = stored(joined(home), "links")
    edges = links.where("tile IS NULL").select("sid", "other")
    lonely = links.where("tile IS NOT NULL").select("sid", F.col("other").alias("cell"), "tile")
    if not lonely.isEmpty():
        cells = placed.where("tiles > 1").select("cell", "pivot", "tiles").distinct()
        probes = lonely.withColumnRenamed("tile", "own").join(cells, "cell")
        probes = probes.withColumn("tile", F.explode(_every_tile())).where("tile != own")
        probes = probes.select("cell", "pivot", "tiles", "tile", "sid", F.lit(True).alias("probe"))
        again = stored(home.where("tiles > 1").unionByName(probes), "again")
        more = stored(joined(again), "tiles").where("tile IS NULL").select("sid", "other")
        edges = edges.unionByName(more)
    return edges


def components(edges: DataFrame) -> DataFrame:
    """The root, its smallest name, of every node with an edge, by alternating star contractions.

    A round keeps, for every node, links to the smallest node it knows. Popular nodes only meet
    aggregations with a map side and joins whose large partitions can be split, as both sides have an
    exchange of their own.
    """
    edges = edges.select(
        F.greatest("sid", "other").alias("u"), F.least("sid", "other").alias("v")
    ).where("u != v")
    edges = stored(edges.distinct(), "edges")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = keyed(both, "u", F.min("v").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        low = keyed(large, "u", F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.where("u != v").unionByName(low.select("u", F.col("m").alias("v")))
        edges = stored(small.distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.select(F.col("u").alias("sid"), F.col("v").alias("root"))
        mark = now


def members(docs: DataFrame) -> DataFrame:
    """Every row with its set's size, its component's root set, and the component's smallest doc_id."""
    small_batches(docs)
    rows = _members(docs)
    pairs = _pivots(docs, rows)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, ngrams in _fresh(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([packed(ngrams)], pa.binary())],
                ["sid", "ngrams"],
            )

    placed = _placed(pairs, rows)
    texts = _representatives(docs, rows, placed.select("sid").distinct())
    sets = texts.mapInArrow(encoded, "sid long, ngrams binary")
    roots = components(_cells(placed, sets))
    sets_of = rows.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("first"))
    sets_of = sets_of.join(roots, "sid", "left").select(
        "sid", "first", F.coalesce("root", "sid").alias("root")
    )
    smallest = keyed(sets_of, "root", F.min("first").alias("component_id"))
    named = sets_of.join(smallest, "root").select("sid", "root", "component_id")
    out = rows.join(named, "sid", "left")
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "root",
        "a",
        "b",
    )


def report(docs: DataFrame) -> DataFrame:
    return members(docs).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each component, the one with the smallest doc_id, all columns as they came.

    Documents without words are all kept.
    """
    rows = members(docs)
    best = rows.where("n_shingles > 0").groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "a", "b")).alias("k")
    )
    keep = best.select("k.a", "k.b", F.lit(True).alias("once")).unionByName(
        rows.where("n_shingles = 0").select("a", "b", F.lit(False).alias("once")).distinct()
    )
    keyed = whole_rows(docs, row_key("doc_id", "text").alias("k")).select("row", "k.a", "k.b")
    keyed = keyed.join(keep, ["a", "b"])
    # A kept document that is there several times stays once.
    once = keyed.where("once").dropDuplicates(["a", "b"])
    return once.unionByName(keyed.where("NOT once")).select("row.*")
