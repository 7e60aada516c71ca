"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

import re

from lexipost.llm.product_codes import ENTRIES, PARTS, ROUNDS, SCALE
from lexipost.llm.quality import ALPHA, DELTA, LEAST_WORDS, MOST_REPEATED_PERCENT, RULES
from lexipost.llm.secrets import BASE_RULES, MORE_RULES, Rule

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_URLS = f"""
WITH parts AS (
    SELECT page_id,
           CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), urls AS (
    SELECT page_id,
           translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM parts
), judged AS (
    SELECT *, CASE
        WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com'))
             AND starts_with(path, '/en/') THEN 'www.example.com/en/'
        WHEN (host = 'example.com' OR ends_with(host, '.example.com'))
             AND starts_with(path, '/en/') THEN 'example.com/en/'
        WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
        WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
        WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/'
        END AS rule
    FROM urls
)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END
           AS verdict
FROM judged
"""



def _found(order: int, rule: Rule) -> str:
    """(doc_id, kind, ord, start, stop) of one rule.

    A match starts where the pieces and matches before it end.
    """
    flags = "(?i)" if rule.flags & re.IGNORECASE else ""
    pattern = "'" + (flags + rule.pattern).replace("'", "''") + "'"
    return f"""
    SELECT doc_id, '{rule.kind}' AS kind, {order} AS ord, start, start + length(hit) AS stop
    FROM (SELECT doc_id, hits[i] AS hit, parts[i] AS part,
                 list_sum(list_transform(pieces[1:i], lambda x: length(x)))
                 + coalesce(list_sum(list_transform(hits[1:i-1], lambda x: length(x))), 0) AS start
          FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i
                FROM (SELECT doc_id, regexp_extract_all(text, {pattern}) AS hits,
                             regexp_extract_all(text, {pattern}, {rule.group}) AS parts,
                             string_split_regex(text, {pattern}) AS pieces
                      FROM documents)))
    WHERE length(part) >= {rule.least}"""


_BASE = ", ".join(f"'{rule.kind}'" for rule in BASE_RULES)
_WRITTEN = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord)"
_COUNTS = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE_RULES)
_SECRETS = f"""
WITH found AS ({" UNION ALL ".join(_found(n, r) for n, r in enumerate(BASE_RULES + MORE_RULES))})
SELECT doc_id, {_COUNTS},
       sha256(coalesce({_WRITTEN} FILTER (kind IN ({_BASE})), '')) AS base_sha256,
       coalesce({_WRITTEN} FILTER (kind IS NOT NULL), '') AS spans
FROM documents LEFT JOIN found USING (doc_id) GROUP BY doc_id
"""

def _components(key: str, nodes: str) -> str:
    """CTEs for (id, component) from links ``link(a, b)`` among the ids of ``nodes``."""
    return f"""
sides AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reached(id, from_id) AS (
    SELECT {key}, {key} FROM {nodes}
    UNION
    SELECT sides.b, reached.from_id FROM reached JOIN sides ON sides.a = reached.id
),
comp AS (SELECT id, min(from_id) AS component_id FROM reached GROUP BY id)"""


_SPACES = r"'[\x20\x09-\x0D]+'"
_NEAR = f"""
WITH RECURSIVE worded AS (
    SELECT doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), {_SPACES}), lambda w: w <> '') AS ws
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(ws) < 2 THEN ws ELSE list_distinct(list_transform(
        range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) END AS shingles
    FROM worded
), sizes AS (SELECT doc_id, len(shingles) AS n FROM sets),
each AS (SELECT doc_id, unnest(shingles) AS shingle FROM sets),
shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_have
    FROM each x JOIN each y USING (shingle) WHERE x.doc_id < y.doc_id GROUP BY ALL
), link AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * both_have >= 80 * (x.n + y.n - both_have)
),{_components("doc_id", "documents")}
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept
FROM sizes JOIN comp ON id = doc_id
"""

_VECTORS = f"""
WITH RECURSIVE sound AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: NOT isfinite(x) OR x IS NULL)) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), link AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM sound x JOIN sound y
    ON x.vec_id < y.vec_id AND len(x.v) = len(y.v) AND list_cosine_similarity(x.v, y.v) >= 0.9
),{_components("vec_id", "embeddings")},
counts AS (SELECT a AS id, count(*) AS n_links FROM sides GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN comp ON comp.id = vec_id LEFT JOIN counts ON counts.id = vec_id
"""

# A level of every group's tree is a list of digests; the next one hashes its runs of three.
_NEXT_LEVEL = (
    "list_transform(range(0, len(nodes), 3), lambda i: sha256(array_to_string(nodes[i+1:i+3], '')))"
)
# One bit of CRC-32 for each list element; the first of each byte's eight also takes the byte in.
_EVEN_CRC = """list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(
        string_split(CAST(doc_id AS VARCHAR), ''),
        lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda crc, byte: xor(xor(crc, byte) >> 1, 3988292384 * (xor(crc, byte) & 1))) & 1 = 1"""


def _leaf(text: str) -> str:
    fields = ["doc_id", "source", "lang", "n_chars", text]
    spelled = [
        f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')" for f in fields
    ]
    return f"sha256({' || '.join(spelled)})"


_MERKLE = f"""
WITH RECURSIVE leaves AS MATERIALIZED (
    SELECT doc_id, source, {_leaf("text")} AS leaf, CASE WHEN {_EVEN_CRC}
           THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS claimed
    FROM documents
), ranked AS MATERIALIZED (
    SELECT *, row_number() OVER (
        PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, claimed) - 1 AS pos
    FROM leaves
), trees(source, level, nodes) AS (
    SELECT source, 0, list(leaf ORDER BY pos) FROM ranked GROUP BY source
    UNION ALL
    SELECT source, level + 1, {_NEXT_LEVEL} FROM trees WHERE len(nodes) > 1
), subroots AS MATERIALIZED (
    SELECT source, level AS height, nodes[1] AS subroot,
           row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place
    FROM trees WHERE len(nodes) = 1
), crown(level, nodes) AS (
    SELECT 0, list(subroot ORDER BY place) FROM subroots HAVING count(*) > 0
    UNION ALL
    SELECT level + 1, {_NEXT_LEVEL} FROM crown WHERE len(nodes) > 1
), levels AS MATERIALIZED (
    -- The levels that a leaf of each source passes, one after the other.
    SELECT t.source, t.level AS step, t.nodes, t.level AS up, false AS above
    FROM trees t WHERE len(t.nodes) > 1
    UNION ALL
    SELECT s.source, s.height + c.level, c.nodes, c.level, true
    FROM subroots s CROSS JOIN crown c WHERE len(c.nodes) > 1
), steps AS MATERIALIZED (
    SELECT r.source, r.pos, l.step, i % 3 AS own, nodes[i - i % 3 + 1 : i - i % 3 + 3] AS run
    FROM ranked r JOIN subroots s ON s.source IS NOT DISTINCT FROM r.source
    JOIN levels l ON l.source IS NOT DISTINCT FROM r.source,
    LATERAL (SELECT CAST(floor((CASE WHEN above THEN place ELSE pos END) / power(3, up)) AS BIGINT)) AS place_of(i)
), folds(source, pos, step, digest) AS (
    SELECT source, pos, 0, claimed FROM ranked
    UNION ALL
    SELECT f.source, f.pos, f.step + 1,
           sha256(array_to_string(s.run[1 : s.own] || [f.digest] || s.run[s.own + 2 :], ''))
    FROM folds f JOIN steps s
    ON s.source IS NOT DISTINCT FROM f.source AND s.pos = f.pos AND s.step = f.step
), proofs AS (
    SELECT source, pos, max(step) + 1 AS n, string_agg(
        array_to_string(run[1 : own] || run[own + 2 :], ''), '' ORDER BY step) AS siblings
    FROM steps GROUP BY source, pos
)
SELECT r.doc_id, r.leaf, s.subroot, top.root,
       sha256(coalesce(p.siblings, '')) AS proof_sha256, f.digest AS folded_root,
       f.digest = top.root AS verified
FROM ranked r JOIN subroots s ON s.source IS NOT DISTINCT FROM r.source
LEFT JOIN proofs p ON p.source IS NOT DISTINCT FROM r.source AND p.pos = r.pos
JOIN folds f ON f.source IS NOT DISTINCT FROM r.source AND f.pos = r.pos
     AND f.step = coalesce(p.n, 0)
CROSS JOIN (SELECT nodes[1] AS root FROM crown WHERE len(nodes) = 1) AS top
"""

_STEPS = len(RULES[0].cutoffs)


def _exceeds(step: int) -> str:
    shares = [re.sub(r"try_divide\((\w+), (\w+)\)", r"\1 / nullif(\2, 0)", r.share) for r in RULES]
    tests = zip(shares, RULES, strict=True)
    return " OR ".join(f"coalesce({s} > {rule.cutoffs[step]}, false)" for s, rule in tests)


_FAILS = f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words"
_QUALITY = f"""
WITH worded AS MATERIALIZED (
    SELECT doc_id, lang, coalesce(text, '') AS text,
           list_filter(string_split_regex(coalesce(text, ''), {_SPACES}), lambda w: w <> '') AS ws,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
    FROM documents
), words AS (
    SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM worded WHERE len(ws) > 8
), windows AS (
    SELECT doc_id, i, {" || ' ' || ".join(f"lead(w, {k}) OVER in_text" for k in range(8))} AS run
    FROM words WINDOW in_text AS (PARTITION BY doc_id ORDER BY i)
), runs AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, run) AS n FROM windows
    WHERE run IS NOT NULL
), repeats AS (
    SELECT doc_id, count(DISTINCT word) AS n_repeat_words
    FROM (SELECT doc_id, unnest(range(i, i + 8)) AS word FROM runs WHERE n > 1) GROUP BY doc_id
), counts AS MATERIALIZED (
    SELECT doc_id, lang, len(ws) AS n_words,
           coalesce(CAST(list_sum(list_transform(ws, lambda w: length(w))) AS BIGINT), 0) AS word_chars,
           len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words,
           len(lines) AS n_lines, len(list_distinct(ws)) AS n_distinct
    FROM worded LEFT JOIN repeats USING (doc_id)
), held AS (
    SELECT *, quality > 0 AS good FROM counts JOIN labels USING (doc_id) WHERE NOT ({_FAILS})
), tallies AS (
    {" UNION ALL ".join(
        f"SELECT lang, {step} AS step, count(*) FILTER (good) AS good, "
        "count(*) FILTER (NOT good) AS bad, "
        f"count(*) FILTER (good AND ({_exceeds(step)})) AS wrong, "
        f"count(*) FILTER (NOT good AND ({_exceeds(step)})) AS caught FROM held GROUP BY lang"
        for step in range(_STEPS)
    )}
), tested AS (
    -- The exact binomial chance of so few false rejections, at the rate that is not allowed.
    SELECT *, list_sum(list_transform(range(0, wrong + 1), lambda k: exp(
        lgamma(good + 1) - lgamma(k + 1) - lgamma(good - k + 1)
        + k * ln({ALPHA}) + (good - k) * ln(1 - {ALPHA})))) AS chance,
        count(DISTINCT lang) OVER () AS strata
    FROM tallies
), certified AS (
    SELECT *, coalesce(caught / nullif(bad, 0), 0) - wrong / good AS gain
    FROM (SELECT *, bool_and(good > 0 AND wrong < good * {ALPHA} AND chance <= {DELTA} / strata)
                    OVER (PARTITION BY lang ORDER BY step) AS sound FROM tested)
    WHERE sound
), chosen AS (
    SELECT lang, arg_max(step, (gain, -step)) AS step FROM certified WHERE gain > 0 GROUP BY lang
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       {_FAILS} AS base_failed,
       NOT ({_FAILS}) AND NOT coalesce(CASE step {" ".join(
           f"WHEN {step} THEN {_exceeds(step)}" for step in range(_STEPS))} END, false) AS kept
FROM counts LEFT JOIN chosen ON chosen.lang IS NOT DISTINCT FROM counts.lang
"""


def _codes() -> str:
    """Rounds of assigning and averaging, a pair of table expressions each."""
    square = "list_sum(list_transform(list_zip(x, v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    mean = "CAST((sum(c) - ((sum(c) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT)"
    tables = [
        f"""kept AS MATERIALIZED (
    SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS id
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), cut AS MATERIALIZED (
    SELECT id, p, list_transform(
        embedding[p * len(embedding) // {PARTS} + 1 : (p + 1) * len(embedding) // {PARTS}],
        lambda c: CAST(floor({SCALE} * CAST(c AS DOUBLE)) AS BIGINT)) AS x
    FROM kept CROSS JOIN range({PARTS}) AS parts(p)
), book0 AS (SELECT p, id - 1 AS entry, x AS v FROM cut WHERE id <= {ENTRIES})"""
    ]
    for number in range(ROUNDS + 1):
        tables.append(f"""near{number} AS MATERIALIZED (
    SELECT id, p, arg_min(entry, (square, entry)) AS entry, min(square) AS square
    FROM (SELECT id, p, entry, {square} AS square FROM cut JOIN book{number} USING (p))
    GROUP BY id, p)""")
        if number < ROUNDS:
            tables.append(f"""book{number + 1} AS MATERIALIZED (
    SELECT old.p, old.entry, coalesce(new.v, old.v) AS v FROM book{number} old LEFT JOIN (
        SELECT p, entry, list(mean ORDER BY i) AS v FROM (
            SELECT p, entry, i, {mean} AS mean FROM (
                SELECT p, entry, unnest(x) AS c, generate_subscripts(x, 1) AS i
                FROM near{number} JOIN cut USING (id, p))
            GROUP BY p, entry, i)
        GROUP BY p, entry) new USING (p, entry))""")
    return f"""
WITH {", ".join(tables)}, coded AS (
    SELECT id, string_agg(printf('%02x', entry), '' ORDER BY p) AS code,
           CAST(sum(square) AS BIGINT) AS error
    FROM near{ROUNDS} GROUP BY id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, entry)) FROM book{ROUNDS})
           AS codebooks_sha256
FROM coded JOIN kept USING (id)
"""

ORACLE: dict[str, str] = {
    "op1_near_dedup": _NEAR,
    "op5_secrets": _SECRETS,
    "op6_url_filter": _URLS,
    "op10_vector_dedup": _VECTORS,
    "op11_merkle": _MERKLE,
    "op12_quality": _QUALITY,
    "op13_vector_codes": _codes(),
}
