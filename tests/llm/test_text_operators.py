"""Quality rules, decontamination, token files, mixing: against brute force and on edge cases."""

import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from helpers import ALNUM, EDGES, LONG, SPACED, counted, docs, edges, labels, leaks, lower, nothing
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm import decontaminate, mixing, orc_tokens, quality


def measures(text):
    text = text or ""
    words = SPACED.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if SPACED.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    marked = {
        j for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for j in range(k, k + 5)
    }
    n, repeated = len(words), len(marked)
    return (
        n,
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        dup,
        repeated,
        n < 10 or 100 * repeated > 20 * n,
    )


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_quality_counts(spark):
    rng = random.Random(1)
    texts = [
        "".join(rng.choice(["a ", "b ", "c", "\n", " ", "é", "|", "a b c d e ", " "]) for _ in range(rng.randrange(60)))
        for _ in range(150)
    ]
    rows = EDGES + [(100 + k, t) for k, t in enumerate(texts)]
    got = counted(quality.report(docs(spark, rows, clashing=True), quality.Field.zero()), "doc_id", *BASE, "kept")
    assert got == sorted(((r[0], *(m := measures(r[1])), not m[-1]) for r in rows), key=repr)


def test_field_learns_lines_and_keeps_clean_documents(spark):
    rng = random.Random(2)
    good = lambda: "\n".join(
        " ".join(f"w{rng.randrange(10**6)}" for _ in range(12)) + "." for _ in range(6)
    )
    bad = lambda: "\n".join(" | ".join(f"W{rng.randrange(10**6)}" for _ in range(12)) for _ in range(6))
    rows = [(k, good() if k % 2 else bad()) for k in range(120)]
    mixed = (200, good() + "\n" + " | ".join(f"W{rng.randrange(10**6)}" for _ in range(8)))
    frame = docs(spark, rows + [mixed])
    marks = labels(spark, [(k, k % 2, 0) for k in range(80)] + [(None, 1, 0), (3, None, 0)])
    field = quality.fit(frame, marks)
    kept = {r["doc_id"] for r in quality.keep(frame, field).collect()}
    assert kept == {k for k in range(120) if k % 2} | {200}
    assert np.allclose(field.emit, quality.fit(frame, marks).emit)


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(3)
    field = quality.Field(rng.normal(size=(len(quality.FEATURES), 2)), rng.normal(size=(2, 2)))
    x = rng.normal(size=(17, len(quality.FEATURES)))
    doc = np.repeat([0, 2, 3], [8, 1, 8])
    labels_ = field.decode(x, doc)
    for d in (0, 2, 3):
        scores = x[doc == d] @ field.emit
        n = len(scores)
        paths = [[k >> t & 1 for t in range(n)] for k in range(1 << n)]
        value = lambda p: sum(scores[t, s] for t, s in enumerate(p)) + sum(field.move[a, b] for a, b in zip(p, p[1:]))
        assert value(list(labels_[doc == d])) == pytest.approx(max(map(value, paths)))


def test_quality_on_edges_and_nothing(spark):
    frame = edges(spark)
    kept = quality.keep(frame, quality.fit(frame, labels(spark)))
    assert kept.columns == frame.columns
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == ["4", "5", "5", "6", "8", "8", "None"]
    empty = nothing(spark)
    assert quality.report(empty, quality.fit(empty, labels(spark))).count() == 0


LEAKS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def test_decontamination_matches_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    words = [f"v{k}" for k in range(12)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    items = [(k, text(rng.randrange(1, 16))) for k in range(20)] + [(3, text(14)), (10, ""), (11, None), (None, text(12))]
    rows = EDGES + [(k, text(rng.randrange(0, 60))) for k in range(100, 160)]
    rows += [(200, items[0][1] + " " + items[5][1].upper()), (201, "x" + items[19][1] + "-" + items[1][1])]
    table = spark.createDataFrame(items, "item_id long, text string")
    expected = leaks(rows, items)
    frame = docs(spark, rows, clashing=True)
    assert counted(decontaminate.report(frame, table), *LEAKS) == expected
    # Many shards, and phrases in several passes, change nothing.
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 200)
    monkeypatch.setattr(decontaminate, "PASS_PHRASES", 30)
    monkeypatch.setattr(decontaminate, "TESTED_AT_ONCE", 7)
    assert counted(decontaminate.report(frame, table), *LEAKS) == expected
    clean = decontaminate.clean(frame, table)
    assert clean.columns == frame.columns
    assert counted(clean, "doc_id") == sorted([(r[0],) for r in expected if not r[-1]], key=repr)


def test_proximity_matches_allow_moved_words(spark):
    items = spark.createDataFrame([("i", "alpha beta gamma delta")], "item_id string, text string")
    rows = [(1, "alpha beta x gamma delta"), (2, "alpha beta gamma delta"), (3, "alpha x y z beta gamma delta"), (4, "alpha beta")]
    postings = decontaminate.index(docs(spark, rows))
    of = lambda slop: {r["doc_no"] for r in decontaminate.matches(postings, decontaminate.phrases(items), slop).collect()}
    assert len(of(0)) == 1 and len(of(1)) == 2


def test_proximity_at_the_edges_of_documents(spark):
    items = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    texts = ["x beta alpha y", "beta alpha", "beta alpha y", "x beta alpha", "x beta", "alpha", "beta y", "y alpha"]
    postings = decontaminate.index(docs(spark, list(enumerate(texts))))
    names = postings.where("term IS NULL").selectExpr("shard", "posexplode(doc_ids) AS (doc_no, doc_id)")
    found = decontaminate.matches(postings, decontaminate.phrases(items), 2).join(names, ["shard", "doc_no"])
    got = {r["doc_id"]: (r["start"], r["stop"]) for r in found.collect()}
    # Terms of neighbouring documents do not meet, and places stay in the document.
    assert set(got) == {0, 1, 2, 3}
    assert all(0 <= a < b <= len(texts[k].split()) for k, (a, b) in got.items())
    assert decontaminate.matches(postings, decontaminate.phrases(items)).count() == 0


def near_items(rows, items, slop):
    """Number of items with a proximity match per document, by trying every place of the rarest word."""
    texts = [ALNUM.findall(lower(text)) for _, text, *_ in rows]
    df = Counter(w for words in texts for w in words)
    found = [set() for _ in rows]
    for item, text in items:
        own = ALNUM.findall(lower(text))
        for k in range(max(len(own) - 9, min(len(own), 1))):
            p = own[k : k + 10]
            rarest = min(range(len(p)), key=lambda j: (df[p[j]], j))
            for words, names in zip(texts, found):
                for at in (i for i, w in enumerate(words) if w == p[rarest]):
                    places = [at - rarest + j for j in range(len(p))]
                    if all(p[j] in words[max(x - slop, 0) : max(x + slop + 1, 0)] for j, x in enumerate(places) if j != rarest):
                        names.add("" if item is None else str(item))
    return sorted(((r[0], len(names)) for r, names in zip(rows, found)), key=repr)


def test_report_counts_items_with_proximity_matches(spark, monkeypatch):
    rng = random.Random(11)
    words = [f"v{k}" for k in range(40)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    items = [(k, text(rng.randrange(1, 25))) for k in range(12)] + [(3, text(14)), (12, ""), (13, None), (None, text(12))]
    rows = EDGES + [(k, text(rng.randrange(0, 60))) for k in range(100, 130)]
    # Items with words swapped, left out and put in, at both edges of a document and inside.
    for k, (_, own) in enumerate(items[:12]):
        w = own.split()
        swapped = w[1::-1] + w[2:]
        rows += [(200 + k, " ".join(swapped)), (300 + k, " ".join([*w[:4], "new", *w[4:]])), (400 + k, "a b " + " ".join(w[:3] + w[4:]) + " c")]
    table = spark.createDataFrame(items, "item_id long, text string")
    expected, frame = near_items(rows, items, 2), docs(spark, rows, clashing=True)
    got = decontaminate.report(frame, table, near=2)
    assert counted(got, "doc_id", "n_near_items") == expected
    assert counted(got, *LEAKS) == leaks(rows, items)
    assert sum(n for _, n in expected) > sum(r[3] for r in leaks(rows, items))
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 200)
    monkeypatch.setattr(decontaminate, "PASS_PHRASES", 30)
    monkeypatch.setattr(decontaminate, "TESTED_AT_ONCE", 7)
    got = decontaminate.report(frame, table, near=2)
    assert counted(got, "doc_id", "n_near_items") == expected
    assert counted(got, *LEAKS) == leaks(rows, items)


def test_decontamination_of_nothing(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.report(nothing(spark), items).count() == 0
    report = decontaminate.report(edges(spark), items)
    assert report.where("contaminated").count() == 0 and report.count() == len(EDGES)


def test_token_files_hold_the_librarys_ids(spark, tmp_path):
    tricky = ["don't", "'s it's,", "İx ΑΣ, ﬁ", "<|endoftext|> <|ENDOFTEXT|> x<|", "a.b a1b …, a…, !!-- 'a\"", "é Å", "≠̸ x y"]
    rows = EDGES + [(50 + k, t) for k, t in enumerate(tricky)]
    path = str(tmp_path / "t.orc")
    got = orc_tokens.report(docs(spark, rows, clashing=True), path).collect()
    tokenizer = Tokenizer.from_file(orc_tokens.VOCABULARY)
    expected = Counter()
    for doc_id, text, *_ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        expected[doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == expected
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    order = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda k: (k is not None, k or 0))
    # A filter on the id reaches the files.
    found = orc_tokens.read(spark, path).where("doc_id = 4")
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,4)]" in found._jdf.queryExecution().toString()
    assert found.count() == 1
    assert orc_tokens.report(nothing(spark)).count() == 0


def test_encoder_forgets_without_harm(monkeypatch):
    monkeypatch.setattr(orc_tokens, "REMEMBERED", 3)
    encoder = orc_tokens.Encoder(orc_tokens.VOCABULARY)
    texts = ["Alpha beta, gamma", "beta gamma. delta", "alpha 12 x"] * 3
    for t in texts:
        (ids,) = encoder.ids(pa.array([t]))
        assert ids.tolist() == encoder.tokenizer.encode(t, add_special_tokens=False).ids


def test_targets_refill_what_full_sources_leave():
    goal = mixing.targets({"a": 10, "b": 100, "c": 100, None: 30})
    assert goal["a"] == 20 and sum(goal.values()) == pytest.approx(360)
    assert goal["b"] / goal["c"] == pytest.approx(2) and goal[None] == 60
    assert mixing.targets({}) == {} and mixing.targets({"a": 0}) == {"a": 0.0}


def level_of(sizes, weights, total, most):
    """Targets by the one level at which min(most * size, level * weight) adds up, in fractions.

    The sum is linear between the levels at which a source is full, so the level is found between two.
    """
    def filled(level):
        return [min(most * n, level * w) for n, w in zip(sizes, weights)]

    stops = sorted({Fraction(most * n, w) for n, w in zip(sizes, weights)} | {Fraction(0)})
    below = max(x for x in stops if sum(filled(x)) <= total)
    slope = sum(w for n, w in zip(sizes, weights) if Fraction(most * n, w) > below)
    return filled(below + (total - sum(filled(below))) / slope if slope else below)


def test_targets_are_the_level_of_the_mix():
    rng = random.Random(12)
    for _ in range(400):
        names = rng.sample(["", "a", "b", "Z", "é", "zz", "B", "10", "9", None], rng.randrange(1, 10))
        sizes = {s: rng.choice([0, 1, rng.randrange(50), rng.randrange(10_000)]) for s in names}
        order = sorted((s for s in names if s is not None), key=lambda s: [ord(c) for c in s])
        order += [None] * (None in sizes)
        total = Fraction(3, 2) * sum(sizes.values())
        expected = level_of([sizes[s] for s in order], [(5, 2, 1)[k % 3] for k in range(len(order))], total, 2)
        goal = mixing.targets(sizes)
        assert [goal[s] for s in order] == pytest.approx([float(x) for x in expected])


def test_pairing_keeps_the_sum_and_leaves_one():
    rng = np.random.default_rng(5)
    size = rng.integers(1, 500, 300).astype(float)
    part, left = mixing.round_pairs(size, np.full(300, 0.3), rng.random(300))
    assert (part * size).sum() == pytest.approx(0.3 * size.sum())
    assert set(np.delete(part, left)) <= {0.0, 1.0}
    # Without bias: each document is taken as often as its fraction says.
    taken = np.mean([mixing.round_pairs(size[:10], np.full(10, 0.3), np.random.default_rng(k).random(10))[0] for k in range(3000)], axis=0)
    assert np.allclose(taken, 0.3, atol=0.04)


def test_mix_meets_its_targets_again_and_again(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(k, "w " * rng.randrange(1, 80), f"s{min(k % 7, 3)}") for k in range(700)]
    rows += EDGES[:3] + [(900, "same same", "s1")] * 20 + [(901, "x y", None)]
    frame = docs(spark, rows, clashing=True)
    monkeypatch.setattr(mixing, "GROUP_ROWS", 40)
    columns = ("doc_id", "size", "source_size", "target", "taken")
    got = counted(mixing.report(frame), *columns)
    assert got == counted(mixing.report(frame.repartition(5)), *columns)
    assert len(got) == len(rows)
    by_target = {}
    for _, size, _, target, taken in got:
        assert 0 <= taken <= 2 * size and (size == 0 or taken % size == 0)
        by_target[target] = by_target.get(target, 0) + taken
    assert all(abs(total - target) <= 80 for target, total in by_target.items())
    mixed = mixing.mix(frame)
    assert mixed.columns == frame.columns
    words = mixed.groupBy("source").agg(F.sum(F.size(F.split(F.trim("text"), r"\s+"))).alias("n"))
    goal = mixing.targets({r["source"]: r["n"] for r in frame.groupBy("source").agg(F.sum(mixing.words_in()).alias("n")).collect()})
    assert all(abs(r["n"] - goal[r["source"]]) <= 80 for r in words.collect())
    assert mixing.report(nothing(spark)).count() == 0


def test_long_texts_are_whole(spark):
    n = len(SPACED.findall(LONG))
    frame = docs(spark, [(1, LONG)])
    assert quality.report(frame, quality.Field.zero()).first()["n_words"] == n
    assert mixing.copies(frame).agg(F.max("size")).first()[0] == n
