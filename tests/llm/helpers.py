"""Small tables and brute-force versions the operators are held against."""

import hashlib
import re

SPACED = re.compile("[^\x20\x09-\x0d]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use for columns of their own.
CLASHING = "key score sid a b row shard n_words copies start ids tie file held_out kept root cell n"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def docs(spark, rows, clashing=False):
    """Rows of (doc_id, text[, source]) as documents, with columns of clashing names if asked for."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    frame = spark.createDataFrame(full, DOCS)
    if clashing:
        frame = frame.selectExpr("*", *[f"'x' AS {c}" for c in CLASHING.split()])
    return frame


LONG = " ".join(f"w{k % 977}x{k}" for k in range(30_000))
# Nulls, empty and blank texts, a long one, repeated rows, equal texts and equal ids.
EDGES = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, LONG),
    (5, "one two three four five six seven eight nine ten eleven"),
    (5, "one two three four five six seven eight nine ten eleven"),
    (6, "One two  three\nfour five six seven eight nine ten ELEVEN"),
    (7, "short text", None),
    (None, "a text of a document without an id that is long enough to be kept by rules"),
    (8, "Ünïcode 日本 \U0001f600 é text, and more!! | of | it"),
    (8, "another text under the same id, which is a tie of ids but not of rows at all"),
]


def edges(spark):
    return docs(spark, EDGES, clashing=True)


def nothing(spark):
    return docs(spark, [])


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def counted(frame, *columns):
    """Rows of a frame, sorted, as tuples of some columns."""
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)


def leaks(documents, items):
    """The columns of LEAKS per document, by looking at every window."""
    windows = {}
    for item, text in items:
        w = ALNUM.findall(lower(text))
        for k in range(max(len(w) - 9, min(len(w), 1))):
            windows.setdefault(tuple(w[k : k + 10]), set()).add("" if item is None else str(item))
    out = []
    for doc_id, text, *_ in documents:
        w = ALNUM.findall(lower(text))
        hit, found = set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if own := windows.get(tuple(w[k : k + size])):
                    found |= own
                    hit.update(range(k, k + size))
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=repr)
