"""Substring dedup, the Merkle manifest and whitening against brute force, on edges and hot groups."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from helpers import DOCS, EDGES, LONG, SPACED, counted, docs, edges, nothing
from pyspark.sql import functions as F

from ledgerline.llm import merkle, repeats, whitening
from ledgerline.llm.bidiagonal import singular
from ledgerline.llm.frames import stored

REPEATS = ("doc_id", "n_words", "n_removed", "kept_sha256")


def removed(rows):
    """(doc_id, words kept, words removed) by looking at every window."""
    words = [(r[0], SPACED.findall(r[1] or "")) for r in rows]
    first = {}
    for doc_id, w in sorted((x for x in words if x[0] is not None), key=lambda x: x[0]):
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k : k + 50]), doc_id)
    out = []
    for doc_id, w in words:
        gone = set()
        for k in range(len(w) - 49 if doc_id is not None else 0):
            if first[tuple(w[k : k + 50])] < doc_id:
                gone.update(range(k, k + 50))
        out.append((doc_id, [x for k, x in enumerate(w) if k not in gone], len(gone)))
    return out


def expected_repeats(rows):
    return sorted(
        (
            (doc_id, len(kept) + n, n, hashlib.sha256(" ".join(kept).encode()).hexdigest())
            for doc_id, kept, n in removed(rows)
        ),
        key=repr,
    )


def passages(seed):
    """Documents that share passages of lengths around the threshold, in all positions."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(10**6)}"
    shared = [[word() for _ in range(rng.choice((49, 50, 51, 60, 90, 140, 200)))] for _ in range(12)]
    rows = []
    for doc_id in rng.sample(range(1000), 120):
        text = []
        for _ in range(rng.randrange(4)):
            text += [word() for _ in range(rng.choice((0, 0, 1, 7, 60)))]
            own = list(rng.choice(shared))
            if rng.random() < 0.5:
                own[rng.randrange(len(own))] = word()
            cut = rng.choice((0, 0, 5, 20, 45))
            text += own[cut : len(own) - rng.choice((0, 0, 3, 30))]
        rows.append((doc_id, rng.choice((" ", "\n", " \t ")).join(text)))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_repeats_match_every_window(spark, seed):
    rows = passages(seed)
    assert sum(n for *_, n in removed(rows)) > 1000
    assert counted(repeats.report(docs(spark, rows)), *REPEATS) == expected_repeats(rows)


def test_repeats_of_edges_and_nothing(spark):
    rows = EDGES + [(20, LONG), (21, LONG.replace(" w5x5 ", " other ")), (22, LONG.upper())]
    # The same word over and over is an anchor everywhere, and has no other surroundings.
    rows += [(30, "same " * 300), (31, "same " * 120), (31, "same " * 49), (None, "same " * 70)]
    frame = docs(spark, rows, clashing=True)
    assert counted(repeats.report(frame), *REPEATS) == expected_repeats(rows)
    assert repeats.report(nothing(spark)).count() == 0
    assert repeats.clean(nothing(spark)).count() == 0
    cleaned = repeats.clean(frame)
    assert cleaned.columns == frame.columns
    found = sorted(((r["doc_id"], SPACED.findall(r["text"] or "")) for r in cleaned.collect()), key=repr)
    assert found == sorted(((d, kept) for d, kept, _ in removed(rows)), key=repr)
    texts = {(r["doc_id"], r["text"]) for r in cleaned.collect()}
    assert (8, EDGES[9][1]) in texts and (1, None) in texts
    assert all(r["n_chars"] == len(r["text"] or "") for r in cleaned.collect())


def test_repeats_in_a_third_of_all_documents_are_linear(spark, monkeypatch):
    """A frequent line in many surroundings: rows grow with the documents, not with their pairs."""
    line = " ".join(f"licence{k}" for k in range(45))
    rows = [(k, f"{line} {'x' if k % 2 else 'y'} end{k % 7} " + " ".join(f"v{k}n{j}" for j in range(60))) for k in range(600)]
    rows += [(1000 + k, " ".join(f"u{k}n{j}" for j in range(80))) for k in range(300)]
    counts = {}

    def store(self, df, name):
        frame = plain(self, df, name)
        counts[name] = frame.count()
        return frame

    plain = repeats.Scratch.store
    monkeypatch.setattr(repeats.Scratch, "store", store)
    assert counted(repeats.report(docs(spark, rows)), *REPEATS) == expected_repeats(rows)
    # Each document has some anchors around the line, and each of them 41 passages at most.
    assert 0 < counts["passages"] <= 600 * 60
    assert counts["anchors"] <= sum(len(r[1].split()) for r in rows) / 10


def test_a_hot_passage_is_split_between_tasks(spark):
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        passage = " ".join(f"p{k}" for k in range(60))
        frame = spark.range(6000).repartition(8).select(
            F.col("id").alias("doc_id"),
            F.when(F.col("id") % 10 > 0, F.lit(passage))
            .otherwise(F.concat(*[F.concat(F.lit(f" {j}q"), F.col("id")) for j in range(60)]))
            .alias("text"),
        )
        seeds = stored(repeats.anchors(frame), "anchors")
        met = seeds.join(repeats.firsts(seeds, "anchor", "around"), ["anchor", "around"])
        assert met.where("first < doc_id").count() == 5399 * seeds.where("doc_id = 1").count()
        rows = met.groupBy().agg(F.max("doc_id"), F.max("tie"))
        rows.collect()
        assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


# The manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    spelled = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in spelled])


def tree(nodes, fan):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][k : k + fan]) for k in range(0, len(out[-1]), fan)])
    return out


def climb(levels, k, folded, fan):
    siblings = []
    for level in levels[:-1]:
        run, slot = level[k // fan * fan :][:fan], k % fan
        siblings += run[:slot] + run[slot + 1 :]
        folded, k = digest(*run[:slot], folded, *run[slot + 1 :]), k // fan
    return siblings, folded


def expected_manifest(rows, fan):
    by_source = {}
    for r in rows:
        by_source.setdefault(r["source"], []).append(r)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        by_source[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
    trees = {s: tree([leaf(r, r["text"]) for r in by_source[s]], fan) for s in names}
    top = tree([trees[s][-1][0] for s in names], fan)
    out = []
    for j, s in enumerate(names):
        for k, r in enumerate(by_source[s]):
            own = trees[s][0][k]
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
            text = r["text"]
            if tampered and text is not None:
                text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            low, folded = climb(trees[s], k, leaf(r, text), fan)
            high, folded = climb(top, j, folded, fan)
            root = top[-1][0]
            out.append((r["doc_id"], own, trees[s][-1][0], root, digest(*low, *high), folded, folded == root))
    return sorted(out, key=repr)


MANIFEST = "doc_id leaf subroot root proof_sha256 folded_root verified".split()


@pytest.mark.parametrize("fan", (2, 3, 16))
def test_the_manifest_matches_a_plain_tree(spark, fan):
    rng = random.Random(fan)
    rows = []
    for doc_id in rng.sample(range(10**6), 500):
        # A hot source, sources of 1, 16, 17 and 256 rows, and more sources than a run holds.
        n = len(rows)
        source = "one" if n == 0 else "s16" if n < 17 else "s17" if n < 34 else "hot" if n < 290 else f"ä{n % 40}"
        rows.append((doc_id, f"Text {doc_id} É", "en", source, doc_id % 90))
    frame = spark.createDataFrame(rows, DOCS).repartition(7)
    assert counted(merkle.report(frame, fan), *MANIFEST) == expected_manifest(frame.collect(), fan)


def test_the_manifest_of_edges_and_nothing(spark):
    frame = edges(spark).withColumn("lang", F.when(F.col("doc_id") != 3, F.col("lang")))
    frame = frame.withColumn("n_chars", F.when(F.col("doc_id") != 4, F.col("n_chars")))
    assert counted(merkle.report(frame), *MANIFEST) == expected_manifest(frame.collect(), 16)
    assert merkle.report(nothing(spark)).count() == 0
    single = docs(spark, [(7, "Just One")])
    (row,) = merkle.report(single).collect()
    assert row["leaf"] == row["subroot"] == row["root"]
    assert row["proof_sha256"] == digest()


def test_equal_rows_are_numbered_across_ranges(spark):
    rows = [(5, "an equal row", "s")] * 700 + [(k, f"row {k}", "s") for k in range(40)]
    frame = docs(spark, rows).repartition(5)
    assert counted(merkle.report(frame), *MANIFEST) == expected_manifest(frame.collect(), 16)
    ranges = frame.select("source", "doc_id", F.expr("uuid()").alias("nth"))
    places = merkle.numbered(ranges, "source", "doc_id", "nth").orderBy("idx").collect()
    assert [r["idx"] for r in places] == list(range(740)) and {r["size"] for r in places} == {740}
    assert [r["doc_id"] for r in places] == sorted(r["doc_id"] for r in places)


# Whitening


def vectors(spark, rows, element="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{element}>, component string")


def held_against_dense(spark, rows, k):
    """Compare with an eigendecomposition of the covariance made from exact integers."""
    frame = vectors(spark, [(i, c, "x") for i, c in rows], "double").repartition(4)
    out = whitening.report(frame).orderBy("vec_id", "component").collect()
    usable = sorted((i, c) for i, c in rows if c and all(x is not None and np.isfinite(x) for x in c))
    x = np.array([[int(np.floor(64 * v)) + 1_000_000 for v in c] for _, c in usable], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    exact = n * x - sums
    centred = (exact / n).astype(float)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    assert len(out) == n * k
    assert [(r["vec_id"], r["component"]) for r in out] == [(i, c) for i, _ in usable for c in range(1, k + 1)]
    assert {r["n"] for r in out} == {n}
    assert [r["deviation"] for r in out[::k]] == [int(d) for d in (exact * exact).sum(axis=1)]
    found = np.array([r["whitened"] for r in out]).reshape(n, k)
    plain = centred @ axes[:, :k] / np.sqrt(values[:k])
    gaps = np.diff(values[: k + 1] if k < len(values) else np.append(values, 0)) / values[0]
    for c in range(k):
        if min(abs(gaps[c]), abs(gaps[c - 1]) if c else 1) > 1e-6:
            assert np.abs(np.abs(found[:, c]) - np.abs(plain[:, c])).max() < 1e-6
    assert np.allclose([r["explained"] for r in out[:k]], values[:k] / values.sum(), rtol=1e-9)
    (error,) = {r["identity_error"] for r in out}
    assert error < 1e-9
    covariance = (found - found.mean(axis=0)).T @ (found - found.mean(axis=0)) / n
    assert np.abs(covariance - np.eye(k)).max() < 1e-9


def test_whitening_matches_a_dense_solver(spark):
    rng = np.random.default_rng(5)
    mixed = rng.normal(size=(400, 40)) * np.linspace(1, 30, 40) @ rng.normal(size=(40, 40))
    rows = [(int(k), [float(v) for v in c]) for k, c in enumerate(mixed)]
    rows += [(1000, None), (1001, [1.0] * 39 + [None]), (1002, [float("nan")] * 40), (1003, [float("inf")] * 40)]
    held_against_dense(spark, rows, 32)


def test_whitening_of_few_dimensions_and_low_rank(spark):
    rng = np.random.default_rng(6)
    held_against_dense(spark, [(k, [float(v) for v in c]) for k, c in enumerate(rng.normal(size=(50, 3)) * 9)], 3)
    twice = np.repeat(rng.normal(size=(60, 5)) * 20, 2, axis=1)
    held_against_dense(spark, [(k, [float(v) for v in c]) for k, c in enumerate(twice)], 5)


def test_whitening_of_edges_and_nothing(spark):
    none = vectors(spark, [])
    assert whitening.report(none).count() == 0
    assert whitening.report(vectors(spark, [(1, None, "x"), (2, [], "x")])).count() == 0
    assert whitening.report(vectors(spark, [(1, [1.0, 2.0], "x")])).count() == 0
    assert whitening.report(vectors(spark, [(k, [1.5, 2.0], "x") for k in range(9)])).count() == 0
    # Other lengths go, repeated rows and null ids stay.
    rows = [(None, [1.0, 2.0]), (1, [3.0, 5.0]), (1, [3.0, 5.0]), (2, [9.0, 1.0]), (3, [1.0]), (4, [7.0] * 3)]
    out = whitening.report(vectors(spark, [(i, c, "x") for i, c in rows])).collect()
    assert sorted(((r["vec_id"], r["component"]) for r in out), key=repr) == sorted(
        [(i, c) for i in (None, 1, 1, 2) for c in (1, 2)], key=repr
    )
    # Numbers beyond 64 bits: the deviation is null, the rest is right.
    big = [(k, [float(k) * 2.0**50, float(k * k)]) for k in range(1, 7)]
    out = whitening.report(vectors(spark, [(i, c, "x") for i, c in big], "double")).collect()
    assert {r["deviation"] for r in out} == {None} and {r["n"] for r in out} == {6}


def test_singular_values_and_vectors():
    rng = np.random.default_rng(8)
    turn = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    cases = [rng.normal(size=(40, 40)), np.eye(40), np.diag([3.0] * 20 + [2.0] * 15 + [1.0] * 5) @ turn]
    cases += [np.diag(np.r_[1 + 1e-9 * np.arange(20), 1e-3 * np.ones(20)]) @ turn, np.zeros((5, 5))]
    cases += [np.linalg.qr(rng.normal(size=(90, 40)) * 2.0 ** -np.arange(40.0), mode="r")]
    cases += [rng.normal(size=(40, 4)) @ rng.normal(size=(4, 40))]
    for a in cases:
        squares, v = singular(a, 40)
        plain = np.linalg.svd(a, compute_uv=False)
        k = v.shape[1]
        assert np.allclose(np.sqrt(squares[:k]), plain[:k], rtol=1e-9, atol=0)
        assert np.abs(v.T @ v - np.eye(k)).max(initial=0) < 1e-7
        if k:
            turned = a @ v / np.sqrt(squares[:k])
            assert np.abs(turned.T @ turned - np.eye(k)).max() < 1e-7


def test_small_singular_values_keep_their_digits():
    """What a covariance matrix would lose: values that differ by 10 to the 30th."""
    a = np.diag(10.0 ** -np.arange(30)) + np.diag(10.0 ** -np.arange(29), 1)
    squares, _ = singular(a, 1)
    # The product of the singular values is that of the diagonal.
    assert np.isclose(np.log10(squares).sum() / 2, -sum(range(30)), rtol=1e-12)
