"""DuckDB statements for the corpus queries that SQL can express in full."""

from __future__ import annotations

from ledgerline.llm import chat, decontaminate, secrets

_LOWER = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)


def _words(pattern: str) -> str:
    return f"regexp_extract_all({_LOWER}, '{pattern}')"


JACCARD = rf"""
WITH RECURSIVE d AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, doc_id, {_words(r"[^\x20\x09-\x0D]+")} AS w FROM documents
), s AS MATERIALIZED (
    SELECT DISTINCT rid, array_to_string(w[k + 1:k + 5], ' ') AS g
    FROM (SELECT rid, w, unnest(range(greatest(len(w) - 4, least(len(w), 1)))) AS k FROM d)
), sizes AS (
    SELECT rid, count(*) AS n FROM s GROUP BY rid
), shared AS (
    SELECT a.rid AS x, b.rid AS y, count(*) AS c
    FROM s AS a JOIN s AS b ON a.g = b.g AND a.rid < b.rid GROUP BY ALL
), links AS MATERIALIZED (
    SELECT x, y FROM shared JOIN sizes AS p ON p.rid = x JOIN sizes AS q ON q.rid = y
    WHERE 100 * c >= 80 * (p.n + q.n - c)
), reach AS (
    SELECT rid, rid AS other FROM d
    UNION
    SELECT reach.rid, e.y FROM reach
    JOIN (SELECT x, y FROM links UNION ALL SELECT y, x FROM links) AS e ON e.x = reach.other
)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(o.doc_id) AS component_id
FROM reach JOIN d USING (rid) JOIN d AS o ON o.rid = reach.other LEFT JOIN sizes ON sizes.rid = d.rid
GROUP BY d.rid, d.doc_id"""

DECONTAMINATION = rf"""
WITH d AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, doc_id,
        {_words(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")} AS w FROM documents
), items AS (
    SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
        {_words(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")} AS w FROM benchmark
), phrases AS MATERIALIZED (
    SELECT DISTINCT item, w[k + 1:k + 10] AS p
    FROM (SELECT item, w, unnest(range(greatest(len(w) - 9, least(len(w), 1)))) AS k FROM items)
), sizes AS (
    SELECT DISTINCT len(p) AS size FROM phrases
), places AS (
    SELECT rid, size, unnest(range(len(w) - size + 1)) AS k FROM d, sizes WHERE len(w) >= size
), hits AS MATERIALIZED (
    SELECT rid, k, size, item
    FROM places JOIN d USING (rid) JOIN phrases ON p = w[k + 1:k + size]
), words AS (
    SELECT rid, count(DISTINCT place) AS n_hit
    FROM (SELECT rid, unnest(range(k, k + size)) AS place FROM hits) GROUP BY rid
), found AS (
    SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
    FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid
), placed AS MATERIALIZED (
    SELECT rid, unnest(w) AS word, unnest(range(len(w))) AS place FROM d
), df AS (
    SELECT word, count(*) AS n FROM placed GROUP BY word
), terms AS MATERIALIZED (
    SELECT DISTINCT p, unnest(p) AS term, unnest(range(len(p))) AS j FROM phrases
), anchors AS (
    SELECT p, arg_min({{'term': term, 'j': j}}, {{'n': n, 'j': j}}) AS rarest
    FROM terms JOIN df ON word = term GROUP BY p
), starts AS (
    SELECT rid, p, place - rarest.j AS start FROM anchors JOIN placed ON word = rarest.term
), near AS (
    SELECT starts.rid, starts.p
    FROM starts JOIN terms ON terms.p = starts.p
    JOIN placed ON placed.rid = starts.rid AND word = term AND place - j BETWEEN start - {decontaminate.NEAR}
        AND start + {decontaminate.NEAR}
    GROUP BY starts.rid, starts.p, start HAVING count(DISTINCT j) = len(starts.p)
), close AS (
    SELECT rid, count(DISTINCT item) AS n_near_items FROM near JOIN phrases USING (p) GROUP BY rid
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(list, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated,
    coalesce(n_near_items, 0) AS n_near_items
FROM d LEFT JOIN words USING (rid) LEFT JOIN found USING (rid) LEFT JOIN close USING (rid)"""

_FOUND = "\n    UNION ALL ".join(
    f"SELECT rid, '{kind}' AS kind, regexp_extract_all(t, '{quoted}') AS m,"
    f" string_split_regex(t, '{quoted}') AS gaps FROM d"
    for kind, quoted in ((k, p.replace("'", "''")) for k, p in secrets.PATTERNS.items())
)
_ASSIGN = secrets.PATTERNS[secrets.ASSIGN].replace("'", "''")

SECRETS = f"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, source, lang FROM documents
), found AS (
    {_FOUND}
), each AS (
    SELECT rid, kind, unnest(m) AS m, unnest(gaps[1:len(m)]) AS gap, unnest(range(len(m))) AS i
    FROM found
), placed AS (
    SELECT *, CASE kind WHEN 'assign' THEN regexp_extract(m, '{_ASSIGN}', 2) ELSE m END AS v,
        sum(length(gap) + length(m)) OVER (PARTITION BY rid, kind ORDER BY i) AS e
    FROM each
), kept AS (
    SELECT rid, kind, source, lang, v, e - length(m) AS s, e, e - length(v) AS vs
    FROM placed JOIN d USING (rid)
    WHERE length(v) >= CASE kind WHEN 'assign' THEN 12 WHEN 'access' THEN 18 WHEN 'hex' THEN 16
        ELSE 20 END
), owned AS (
    SELECT v, count(*) AS repositories, count(DISTINCT source) + count(DISTINCT source IS NULL OR NULL)
        AS owners
    FROM (SELECT DISTINCT v, source, lang FROM kept) GROUP BY v
), judged AS (
    SELECT *, repositories = 1 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')
        AND len(list_distinct(string_split(v, ''))) >= 8 AS live
    FROM kept JOIN owned USING (v)
), spans AS (
    SELECT DISTINCT rid, s, kind, e,
        CASE kind WHEN 'assign' THEN 0 WHEN 'access' THEN 1 ELSE 2 END AS k
    FROM judged WHERE kind <> 'mixed'
    UNION ALL SELECT DISTINCT rid, vs, 'live', e, 4 FROM judged WHERE live
), listed AS (
    SELECT rid,
        string_agg(concat_ws(':', kind, s::BIGINT, e::BIGINT), ',' ORDER BY s, k, e)
            FILTER (WHERE kind <> 'live') AS base,
        string_agg(concat_ws(':', kind, s::BIGINT, e::BIGINT), ',' ORDER BY s, k, e) AS spans,
        count(*) FILTER (WHERE kind = 'live') AS n_live
    FROM spans GROUP BY rid
), counted AS (
    SELECT rid, count(*) FILTER (WHERE kind = 'assign') AS n_assign,
        count(*) FILTER (WHERE kind = 'access') AS n_access,
        count(*) FILTER (WHERE kind = 'hex') AS n_hex,
        count(*) FILTER (WHERE repositories >= 3) AS n_example,
        max(owners) AS n_owners, max(repositories) AS n_repositories
    FROM judged GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
    coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
    coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example,
    coalesce(n_owners, 0) AS n_owners, coalesce(n_repositories, 0)::BIGINT AS n_repositories
FROM d LEFT JOIN counted USING (rid) LEFT JOIN listed USING (rid)"""

REPEATS = r"""
WITH d AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, doc_id,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), windows AS MATERIALIZED (
    SELECT rid, doc_id, k, array_to_string(w[k + 1:k + 50], ' ') AS passage
    FROM (SELECT *, unnest(range(len(w) - 49)) AS k FROM d WHERE len(w) >= 50)
), first AS (
    SELECT passage, min(doc_id) AS owner FROM windows GROUP BY passage
), gone AS (
    SELECT rid, list(DISTINCT place) AS places
    FROM (
        SELECT rid, unnest(range(k, k + 50)) AS place FROM windows JOIN first USING (passage)
        WHERE owner < doc_id
    )
    GROUP BY rid
), kept AS (
    SELECT rid, string_agg(word, ' ' ORDER BY place) AS text
    FROM (SELECT rid, unnest(w) AS word, unnest(range(len(w))) AS place FROM d)
    LEFT JOIN gone USING (rid)
    WHERE places IS NULL OR NOT list_contains(places, place)
    GROUP BY rid
)
SELECT doc_id, len(w) AS n_words, coalesce(len(places), 0) AS n_removed,
    sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (rid) LEFT JOIN kept USING (rid)"""


def _digest(text: str) -> str:
    spelled = " || ".join(
        f"coalesce(strlen({v}::VARCHAR) || ':' || {v}, '-')"
        for v in ("doc_id", "source", "lang", "n_chars", text)
    )
    return f"sha256({spelled})"


# Levels of a tree that the statement spells out: groups of up to 16 ** 6 nodes.
_LEVELS = 6


def _tree(name: str, leaves: str) -> str:
    """Levels of trees over (grp, idx, digest): <name>0 to <name>_LEVELS with the group's size.

    A group of one node is passed on as it is.
    """
    ctes = [f"{name}0 AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM ({leaves}))"]
    for k in range(_LEVELS):
        ctes.append(
            f"{name}{k + 1} AS MATERIALIZED (SELECT grp, idx // 16 AS idx,"
            f" CASE WHEN n = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY idx)) END"
            f" AS digest, (n + 15) // 16 AS n FROM {name}{k} GROUP BY grp, idx // 16, n)"
        )
    return ",\n".join(ctes)


def _proof(name: str, leaf: str, idx: str, source: str, group: str) -> str:
    """Rows of `source` with the siblings of each level (s<k>) and the digest folded so far (f<k>)."""
    step = f"SELECT *, {leaf} AS f0, {idx} AS i0 FROM {source}"
    for k in range(_LEVELS):
        run = (
            f"(SELECT string_agg(t.digest, '' ORDER BY t.idx) FROM {name}{k} AS t WHERE t.grp = q.{group}"
            f" AND t.idx // 16 = i{k} // 16 AND t.n > 1 AND t.idx <> i{k})"
        )
        whole = (
            f"(SELECT sha256(string_agg(CASE WHEN t.idx = i{k} THEN f{k} ELSE t.digest END, ''"
            f" ORDER BY t.idx)) FROM {name}{k} AS t WHERE t.grp = q.{group} AND t.idx // 16 = i{k} // 16"
            f" AND t.n > 1)"
        )
        step = (
            f"SELECT *, coalesce({run}, '') AS s{k}, coalesce({whole}, f{k}) AS f{k + 1},"
            f" i{k} // 16 AS i{k + 1} FROM ({step}) AS q"
        )
    siblings = " || ".join(f"s{k}" for k in range(_LEVELS))
    facts = "doc_id, grp, leaf, subroot" if name == "t" else "doc_id, grp, leaf, subroot, siblings AS lower"
    return f"SELECT {facts}, {siblings} AS siblings, f{_LEVELS} AS folded FROM ({step})"


# DuckDB has no crc32: the reflected polynomial, a bit at a time.
_CRC = (
    "xor(list_reduce([4294967295::BIGINT] || list_transform(range(strlen(doc_id::VARCHAR)),"
    " lambda i: ascii((doc_id::VARCHAR)[i + 1])::BIGINT), lambda c, b: list_reduce("
    "[xor(c, b)] || range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384)"
    " ELSE x >> 1 END)), 4294967295)"
)

MERKLE = f"""
WITH docs AS MATERIALIZED (
    SELECT doc_id, coalesce('=' || source, '') AS grp, {_digest("text")} AS leaf,
        CASE WHEN {_CRC} % 5 = 0 THEN {_digest(_LOWER.replace("coalesce(text, '')", "text"))} END AS tampered
    FROM documents
), placed AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM docs
), {_tree("t", "SELECT grp, idx, leaf AS digest FROM placed")},
subroots AS MATERIALIZED (
    SELECT grp, row_number() OVER (ORDER BY grp) - 1 AS idx, digest FROM t{_LEVELS}
), {_tree("r", "SELECT '' AS grp, idx, digest FROM subroots")},
leaves AS (
    SELECT placed.*, s.digest AS subroot FROM placed JOIN subroots AS s USING (grp)
), below AS MATERIALIZED (
    {_proof("t", "coalesce(tampered, leaf)", "idx", "leaves", "grp")}
), tops AS (
    SELECT below.doc_id, below.leaf, below.subroot, below.siblings, below.folded, s.idx, '' AS grp
    FROM below JOIN subroots AS s USING (grp)
), above AS (
    {_proof("r", "folded", "idx", "tops", "grp")}
)
SELECT doc_id, leaf, subroot, r{_LEVELS}.digest AS root, sha256(lower || above.siblings) AS proof_sha256,
    folded AS folded_root, folded = r{_LEVELS}.digest AS verified
FROM above, r{_LEVELS}"""

ORACLE_SQL = {
    "op1_jaccard_regions": JACCARD,
    "op3_perspective_rotation": chat.ORACLE_SQL,
    "op6_secret_ownership": SECRETS,
    "op7_positional_index": DECONTAMINATION,
    "op11_anchored_repeats": REPEATS,
    "op13_sibling_manifest": MERKLE,
}
