"""Token ids as ORC files: run-length encoded integers, row indexes, Bloom filters on document ids.

Documents are range-partitioned by id, so the files in name order, and the rows within each, ascend by
doc_id. Readers take stripes in parallel; a filter on doc_id skips stripes and row groups by their
statistics and Bloom filters without decoding ids.

Defined cases: a null or empty text is the end id alone; null ids come first; rows with equal ids are
ordered by a hash of the text; extra columns are not written. An empty table gives no rows. Files hold
about as many documents each, and there are as many files as the bytes of all texts ask for. Equal ids
are told apart by the hash, and equal rows by their place in the input, so ranges can be cut anywhere.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerline.llm.frames import scratch, small_batches
from ledgerline.llm.text import TextBlock, Words, blocks

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
# Bytes of text per file, on average, and the knobs of the format.
FILE_BYTES = 64_000_000
STRIPE_BYTES = 8_000_000
ROWS_PER_INDEX = 1_000
# Pieces of text whose ids a worker remembers, some 40 bytes each; beyond that it starts over.
REMEMBERED = 1_000_000
# Bytes of text encoded at once; the more, the fewer look-ups of the same pieces.
ENCODED_BYTES = 2_000_000
# Words put into one call of the tokenizer.
AT_ONCE = 50

_SPACE, _LETTER, _MARK, _OTHER = range(4)
_CLASS = np.full(256, _OTHER, dtype=np.uint8)
_CLASS[list(b" \t\n\v\f\r")] = _SPACE
_CLASS[list(b"abcdefghijklmnopqrstuvwxyz")] = _LETTER
_CLASS[list(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")] = _MARK
# Where a piece begins, by the class before and the class at a byte.
_BEGINS = np.zeros(16, dtype=bool)
_BEGINS[[_LETTER, _MARK, _OTHER, 4 * _LETTER + _MARK, 4 * _MARK + _LETTER]] = True


class Encoder:
    """Ids of texts by the tokenizers library, remembered per piece of text.

    The vocabulary's rules make that exact. White space is dropped and never joins characters; upper
    case is lowered; a letter a-z and an ASCII mark other than the apostrophe never share a token. So a
    text's ids are those of its pieces between spaces, and between such letters and marks, one after the
    other. Words of letters only can share a call, as each ends with a token that says so. A text that
    might spell a special token goes to the library as a whole. Pieces are known by 64-bit hashes.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[k for token, k in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        # Hashes of pieces in order, and for each where its ids lie in the pool.
        self.names = np.empty(0, dtype=np.uint64)
        self.origin = np.empty(0, dtype=np.int64)
        self.size = np.empty(0, dtype=np.int32)
        self.pool, self.used = np.empty(1 << 16, dtype="<u4"), 0

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4") for e in encoded]

    def _learn(self, fresh: list[str]) -> list[np.ndarray]:
        """Ids of pieces, in their order."""
        out: list = [None] * len(fresh)
        words, others = [], []
        for k, text in enumerate(fresh):
            alone = text.isalpha() and text.lower().isalpha()
            (words if alone else others).append(k)
        calls = [words[k : k + AT_ONCE] for k in range(0, len(words), AT_ONCE)]
        for call, ids in zip(calls, self._encode([" ".join([fresh[k] for k in c]) for c in calls])):
            begin = 0
            for k, stop in zip(call, (np.flatnonzero(self.ends[ids]) + 1).tolist()):
                out[k] = ids[begin:stop]
                begin = stop
        for k, ids in zip(others, self._encode([fresh[k] for k in others])):
            out[k] = ids
        return out

    def _remember(self, names: np.ndarray, places: np.ndarray, lists: list[np.ndarray]) -> None:
        """Take up pieces; `places` tells where they belong among those known."""
        size = np.fromiter(map(len, lists), dtype=np.int32, count=len(lists))
        total = int(size.sum())
        if self.used + total > len(self.pool):
            wider = np.empty(2 * (self.used + total), dtype="<u4")
            wider[: self.used] = self.pool[: self.used]
            self.pool = wider
        self.pool[self.used : self.used + total] = np.concatenate(lists)
        origin = self.used + np.cumsum(size, dtype=np.int64) - size
        self.used += total
        self.names = np.insert(self.names, places, names)
        self.origin = np.insert(self.origin, places, origin)
        self.size = np.insert(self.size, places, size)

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text, without an end id."""
        special = pc.fill_null(pc.match_substring(texts, "<|"), False)
        if pc.any(special).as_py():
            plain = pc.if_else(special, "", texts)
            out = self.ids(plain)
            for k in np.flatnonzero(special):
                out[k] = self._encode([texts[int(k)].as_py()])[0]
            return out
        if len(self.names) > REMEMBERED:
            self._forget()
        block = TextBlock(texts, lower=True)
        at = _CLASS[block.data]
        outer = block.offsets[1:-1][block.offsets[1:-1] < len(at)]
        before = np.append(np.uint8(_SPACE), at)[:-1]
        before[outer] = _SPACE
        after = np.append(at, np.uint8(_SPACE))[1:]
        after[outer[outer > 0] - 1] = _SPACE
        starts = np.flatnonzero(_BEGINS[4 * before + at])
        ends = np.flatnonzero((at != _SPACE) & ((after == _SPACE) | _BEGINS[4 * at + after])) + 1
        pieces = Words(block, starts, ends)
        names, first, unit = np.unique(pieces.hashes(), return_index=True, return_inverse=True)
        places = np.searchsorted(self.names, names)
        known = np.zeros(len(names), dtype=bool)
        inside = places < len(self.names)
        known[inside] = self.names[places[inside]] == names[inside]
        if not known.all():
            text, of = block.data.tobytes(), first[~known]
            pieces_ = [text[a:b].decode() for a, b in zip(starts[of].tolist(), ends[of].tolist())]
            self._remember(names[~known], places[~known], self._learn(pieces_))
            places = np.searchsorted(self.names, names)
        sizes, origin, flat = self.size[places].astype(np.int64), self.origin[places], self.pool
        size = sizes[unit]
        stop = np.cumsum(size)
        ids = flat[np.repeat(origin[unit] - (stop - size), size) + np.arange(int(size.sum()))]
        bounds = np.append(0, stop)[pieces.first]
        return [ids[a:b] for a, b in zip(bounds.tolist(), bounds[1:].tolist())]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def write(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> None:
    """Encode whole texts and write them as ORC files in ascending order of doc_id."""
    end = np.array([end_id], dtype="<u4")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            for part in blocks(batch, "text", ENCODED_BYTES):
                lists = [np.append(ids, end) for ids in enc.ids(part.column("text"))]
                offsets = np.cumsum([0, *map(len, lists)]).astype(np.int32)
                flat = np.concatenate(lists).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("tie"), ids], ["doc_id", "tie", "ids"]
                )

    small_batches(docs)
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    files = max(total // FILE_BYTES + 1, docs.sparkSession.sparkContext.defaultParallelism)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("tie"),
        # The same whenever a task reads its part of a stored table again.
        F.monotonically_increasing_id().alias("place"),
        "text",
    )
    order = ["doc_id", "tie", "place"]
    rows = rows.repartitionByRange(files, *order).sortWithinPartitions(*order)
    rows = rows.mapInArrow(encoded, "doc_id long, tie long, ids array<int>")
    (
        rows.write.option("orc.compress", "ZSTD")
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", ROWS_PER_INDEX)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .orc(path)
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("doc_id long, tie long, ids array<int>").orc(path)


def report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write the files, read them back, and tell where each document's ids begin.

    Starts need a running sum over all documents. Each file is summed on its own, and the totals, a row
    per file, are summed in the order of the files.
    """
    spark = docs.sparkSession
    path = path or scratch(spark, "tokens") + ".orc"
    write(docs, path)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            flat = lists.values.to_numpy(zero_copy_only=False)
            bounds = lists.offsets.to_numpy()
            sums = [zlib.crc32(flat[a:b].astype("<u4")) for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", "tie", "file")),
                    pa.array(np.diff(bounds).astype(np.int64)),
                    pa.array(sums, pa.int64()),
                ],
                ["doc_id", "tie", "file", "n_tokens", "ids_crc32"],
            )

    rows = read(spark, path).select("doc_id", "tie", "ids", F.col("_metadata.file_name").alias("file"))
    rows = rows.mapInArrow(
        digest, "doc_id long, tie long, file string, n_tokens long, ids_crc32 long"
    )
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    # Files are numbered; their names sort like the numbers only as long as all have five digits.
    number = F.regexp_extract("file", r"part-(\d+)", 1).cast("long")
    before = F.sum("n").over(Window.orderBy(number).rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("file", F.coalesce(before, F.lit(0)).alias("file_start"))
    order = Window.partitionBy("file").orderBy("doc_id", "tie", "n_tokens", "ids_crc32")
    earlier = F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return rows.join(offsets, "file").select(
        "doc_id",
        (F.col("file_start") + F.coalesce(earlier, F.lit(0))).alias("start"),
        "n_tokens",
        "ids_crc32",
    )
