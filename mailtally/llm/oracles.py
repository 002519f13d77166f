"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from mailtally.llm.licenses import NOTICES, PHRASES, notice_words
from mailtally.llm.url_filter import RULES

SUFFIX_DEDUP = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
blocks AS (  -- 256 bytes with what their windows reach: slices of long strings are slow
    SELECT doc_id, least(length(h) // 2 - p0, 256) AS n, p0, part FROM (
        SELECT doc_id, h, unnest(range(0, length(h) // 2, 256)) AS p0,
            unnest(list_transform(range(0, length(h) // 2, 256),
                lambda k: h[2 * k + 1 : 2 * k + 610])) AS part
        FROM docs)
),
bytes AS (
    SELECT doc_id, p0 + unnest(range(n)) AS i,
        unnest(list_transform(range(n), lambda j: part[2 * j + 1 : 2 * j + 2])) AS b,
        unnest(list_transform(range(n), lambda j: CASE WHEN 2 * j + 100 <= length(part)
            THEN md5(part[2 * j + 1 : 2 * j + 100]) END)) AS s
    FROM blocks
),
firsts AS (SELECT s, min(doc_id) AS first_id FROM bytes WHERE s IS NOT NULL GROUP BY s),
flagged AS (
    SELECT doc_id, i, b, coalesce(first_id < doc_id, false) AS hit
    FROM bytes LEFT JOIN firsts USING (s)
),
covered AS (
    SELECT doc_id, i, b, bool_or(hit) OVER (
        PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
    FROM flagged
),
edges AS (
    SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS starts
    FROM covered
),
cut AS (
    SELECT doc_id, count_if(gone) AS n_removed, count_if(starts) AS n_spans,
        coalesce(string_agg(b, '' ORDER BY i) FILTER (NOT gone), '') AS kept
    FROM edges GROUP BY doc_id
)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes,
    CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
    CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
    sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM docs LEFT JOIN cut USING (doc_id)
"""

SUBSTRING_DEDUP = """
WITH docs AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
),
words AS (
    SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word,
        unnest(list_transform(range(1, len(w) + 1), lambda j: CASE WHEN j + 19 <= len(w)
            THEN md5(array_to_string(w[j : j + 19], ' ')) END)) AS s
    FROM docs
),
ranked AS (
    SELECT *, s IS NOT NULL
        AND row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1 AS hit
    FROM words
),
covered AS (
    SELECT doc_id, i, word, bool_or(hit) OVER (
        PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
    FROM ranked
),
cut AS (
    SELECT doc_id, count_if(gone) AS n_removed,
        string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
    FROM covered GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN cut USING (doc_id)
"""

EMBEDDING_DEDUP = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
),
good AS (
    SELECT * FROM vectors
    WHERE label IS NOT NULL AND x IS NOT NULL AND len(list_filter(x, lambda v: v <> 0)) > 0
        AND len(list_filter(x, lambda v: v IS NULL OR NOT isfinite(v))) = 0
),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
        ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
    WHERE list_cosine_similarity(a.x, b.x) >= 0.93
),
reached AS (
    SELECT vec_id AS a, vec_id AS b FROM vectors
    UNION
    SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
),
roots AS (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a),
counts AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM roots LEFT JOIN counts USING (vec_id)
"""


def _templates() -> str:
    rows, number = [], 0
    for exact, group in (("true", PHRASES), ("false", NOTICES)):
        for text, label in group.items():
            words, core = notice_words(text)
            for i in range(len(words) - 1):
                pair = f"'{words[i]}', '{words[i + 1]}'"
                rows.append(f"({number}, '{label}', {exact}, {len(words) - 1}, {core}, {i}, {pair})")
            number += 1
    return ", ".join(rows)


LICENSES = f"""
WITH templates(template, label, exact, pairs, core, tpos, a, b) AS (VALUES {_templates()}),
docs AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM documents
),
words AS (
    SELECT doc_id, unnest(range(len(w) - 1)) AS pos, unnest(w[: -2]) AS a, unnest(w[2 :]) AS b
    FROM docs WHERE len(w) > 1
),
votes AS (
    SELECT doc_id, template, label, exact, pairs, core, pos - tpos AS diagonal,
        bit_or(CAST(1 AS BIGINT) << tpos) AS found
    FROM words JOIN templates USING (a, b) GROUP BY ALL
),
marked AS (
    SELECT *, CASE WHEN exact OR diagonal - lag(diagonal) OVER along <= 2 IS NOT TRUE OR exact
        THEN 1 ELSE 0 END AS begins
    FROM votes WINDOW along AS (PARTITION BY doc_id, template ORDER BY diagonal)
),
spanned AS (
    SELECT *, sum(begins) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM marked
),
spans AS (
    SELECT doc_id, label, exact, min(diagonal) AS start,
        bit_count(bit_or(found)) / CAST(any_value(pairs) AS DOUBLE) AS part,
        any_value(pairs) - bit_count(bit_or(found)) <= 2
            AND (bit_or(found) & any_value(core)) = any_value(core) AS verified
    FROM spanned GROUP BY doc_id, template, label, exact, span
),
found AS (
    SELECT doc_id, count_if(exact AND part = 1) AS n_base,
        min(start) FILTER (exact AND part = 1) AS first_word,
        max(start) FILTER (exact AND part = 1) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) FILTER (exact AND part = 1) AS base_labels,
        string_agg(DISTINCT label, ',' ORDER BY label)
            FILTER (part = 1 AND exact OR verified AND NOT exact) AS labels,
        max(part) AS score
    FROM spans GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
    CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
    coalesce(score, 0.0) AS score
FROM docs LEFT JOIN found USING (doc_id)
"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (t): the 256 steps of a crc32, from its polynomial.
CRC_TABLE = """crc AS (
    SELECT list(c ORDER BY n) AS t FROM (
        SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, k:
            CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) r(n))
)"""


def crc32(text: str) -> str:
    """SQL for the crc32 of a text's UTF-8 bytes, with ``CRC_TABLE`` beside it."""
    h = f"hex(encode({text}))"
    steps = f"list_transform(range(length({h}) // 2), lambda i: CAST('0x' || {h}[2 * i + 1 : 2 * i + 2] AS BIGINT))"
    return (
        f"xor(4294967295, list_reduce(list_prepend(4294967295, {steps}),"
        f" lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))"
    )


def _merkle(levels: int = 12) -> str:
    """Trees of runs of 16, upwards: ``levels`` of them are written out."""

    def field(x: str) -> str:
        x = f"CAST({x} AS VARCHAR)"
        return f"coalesce(octet_length(encode({x})) || ':' || {x}, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"

    def grown(name: str) -> str:
        """Levels above ``name``0 (tree, pos, digest); a tree that has one node stays as it is."""
        out = []
        for k in range(1, levels + 1):
            out.append(f"""{name}{k} AS (
    SELECT tree, run AS pos, CASE WHEN any_value(n) = 1 THEN any_value(digest)
        ELSE sha256(string_agg(digest, '' ORDER BY pos)) END AS digest
    FROM (SELECT *, pos // 16 AS run, count(*) OVER (PARTITION BY tree) AS n FROM {name}{k - 1})
    GROUP BY tree, run
)""")
        return ",\n".join(out)

    def beside(name: str) -> str:
        """(tree, pos, lefts, rights): a node's siblings on its way up, a text for each level."""
        out = [f"{name}p0 AS (SELECT tree, pos, pos AS now, [] :: VARCHAR[] AS l, [] :: VARCHAR[] AS r FROM {name}0)"]
        for k in range(1, levels + 1):
            out.append(f"""{name}p{k} AS (
    SELECT p.tree, p.pos, p.now // 16 AS now,
        CASE WHEN n = 1 THEN l ELSE list_append(l, left_) END AS l,
        CASE WHEN n = 1 THEN r ELSE list_append(r, right_) END AS r
    FROM {name}p{k - 1} p JOIN (
        SELECT tree, pos, count(*) OVER (PARTITION BY tree) AS n,
            coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS left_,
            coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS right_
        FROM {name}{k - 1} WINDOW run AS (PARTITION BY tree, pos // 16 ORDER BY pos)
    ) s ON s.tree = p.tree AND s.pos = p.now
)""")
        return ",\n".join(out)

    small = f"translate(text, '{UPPER}', '{LOWER}')"
    return f"""
WITH {CRC_TABLE},
leaves AS (
    SELECT doc_id, source, {leaf("text")} AS leaf,
        CASE WHEN {crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN {leaf(small)} ELSE {leaf("text")} END AS claim,
        dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
        row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos
    FROM documents, crc
),
low0 AS (SELECT tree, pos, leaf AS digest FROM leaves),
{grown("low")},
top0 AS (SELECT 0 AS tree, tree AS pos, digest FROM low{levels}),
{grown("top")},
{beside("low")},
{beside("top")},
paths AS (
    SELECT d.doc_id, d.leaf, d.claim, s.digest AS subroot, t.digest AS root,
        list_concat(a.l, b.l) AS l, list_concat(a.r, b.r) AS r
    FROM leaves d JOIN lowp{levels} a ON a.tree = d.tree AND a.pos = d.pos
    JOIN topp{levels} b ON b.pos = d.tree
    JOIN low{levels} s ON s.tree = d.tree CROSS JOIN top{levels} t
),
folded AS (
    SELECT *, list_reduce(list_prepend(claim, list_transform(range(1, len(l) + 1), lambda i: l[i] || '|' || r[i])),
        lambda node, x: sha256(split_part(x, '|', 1) || node || split_part(x, '|', 2))) AS folded_root
    FROM paths
)
SELECT doc_id, leaf, subroot, root,
    sha256(array_to_string(list_transform(range(1, len(l) + 1), lambda i: l[i] || r[i]), '')) AS proof_sha256,
    folded_root, folded_root = root AS verified
FROM folded
"""

RESAMPLING = f"""
WITH {CRC_TABLE},
texts AS (
    SELECT 1 AS side, doc_id, text FROM documents UNION ALL SELECT 2, item_id, text FROM benchmark
),
split AS (
    SELECT side, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM texts
),
runs AS (
    SELECT side, doc_id, unnest(list_concat(w, list_transform(range(1, len(w)),
        lambda i: w[i] || ' ' || w[i + 1]))) AS run
    FROM split
),
named AS (
    SELECT run, {crc32("run")} % 10000 AS bucket FROM (SELECT DISTINCT run FROM runs), crc
),
placed AS (SELECT side, doc_id, bucket FROM runs JOIN named USING (run)),
hist AS (
    SELECT bucket, count_if(side = 1) AS s, count_if(side = 2) AS t FROM placed GROUP BY bucket
),
totals AS (SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM hist),
gains AS (
    SELECT bucket, CAST(floor(1000 * ln((t + 1.0::DOUBLE) * (s_all + 10000)
        / ((s + 1.0::DOUBLE) * (t_all + 10000)))) AS BIGINT) AS gain
    FROM hist, totals
),
sums AS (
    SELECT doc_id, CAST(count(*) AS BIGINT) AS n, CAST(sum(gain) AS BIGINT) AS total
    FROM placed JOIN gains USING (bucket) WHERE side = 1 GROUP BY doc_id
),
scored AS (
    SELECT doc_id, len(w) AS words, coalesce(n, 0) AS n_features,
        coalesce(CAST(floor(total / n) AS BIGINT), 0) AS weight,
        CAST('0x' || sha256('7:' || doc_id)[1:8] AS BIGINT) AS h
    FROM split LEFT JOIN sums USING (doc_id) WHERE side = 1
),
noisy AS (
    SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score
    FROM scored
),
ordered AS (
    SELECT *, count_if(words >= 20) OVER () AS n_all,
        row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id) AS place
    FROM noisy
)
SELECT doc_id, n_features, weight, score,
    CASE WHEN words >= 20 AND place <= 25 * n_all // 100 THEN place END AS rank
FROM ordered
"""


def _url_filter(rules: list, order: int = 4, strength: float = 4.0, alphabet: int = 256) -> str:
    longest = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1])))
    fits = [
        (f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", verdict, h + p)
        for verdict, h, p in longest
    ]
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{name}'" for c, _, name in fits) + " END"
    decided = "CASE " + " ".join(f"WHEN {c} THEN '{verdict}'" for c, verdict, _ in fits) + " END"
    n, each = order + 1, range(1, order + 2)
    marked = f"repeat(chr(2), {order}) || text || chr(3)"
    places = f"list_transform(range(1, length(text) + 2), lambda i: substr({marked}, i, {n}))"
    models = [
        f"""m{k} AS (
    SELECT gram, (a + {strength} * {"pa" if k > 1 else 1 / alphabet}) / (ca + {strength}) AS pa,
        (b + {strength} * {"pb" if k > 1 else 1 / alphabet}) / (cb + {strength}) AS pb
    FROM known {f"JOIN (SELECT gram AS ending, pa, pb FROM m{k - 1}) ON ending = substr(gram, 2)" if k > 1 else ""}
    WHERE len = {k}
)"""
        for k in each
    ]
    joins = " ".join(f"LEFT JOIN ratios r{k} ON r{k}.gram = right(win, {k})" for k in each)
    best = ", ".join(f"r{k}.ratio" for k in reversed(each))
    return f"""
WITH parts AS (
    SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), '{UPPER}', '{LOWER}') AS host,
        regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
    FROM pages
),
listed AS (
    SELECT row_number() OVER () AS row, *, host || path AS text, {rule} AS rule, {decided} AS decided,
        md5(host || path)[1:1] IN ('0', '1', '2') AS aside
    FROM parts
),
seen AS (
    SELECT decided = 'allow' AS good, unnest({places}) AS win FROM listed WHERE decided IS NOT NULL AND NOT aside
),
grams AS (
    SELECT gram, length(gram) AS len, left(gram, length(gram) - 1) AS context,
        count_if(good) AS a, count_if(NOT good) AS b
    FROM (SELECT good, right(win, k) AS gram FROM seen, range(1, {n + 1}) t(k)) GROUP BY gram
),
contexts AS (SELECT len, context, sum(a) AS ca, sum(b) AS cb FROM grams GROUP BY len, context),
known AS (
    SELECT * FROM (SELECT * FROM grams ORDER BY a + b DESC, len, gram LIMIT 100000)
    JOIN contexts USING (len, context)
),
{(","+chr(10)).join(models)},
ratios AS ({" UNION ALL ".join(f"SELECT gram, ln(pa) - ln(pb) AS ratio FROM m{k}" for k in each)}),
scores AS (
    SELECT row, sum(coalesce({best}, 0.0)) / count(*) AS score
    FROM (SELECT row, unnest({places}) AS win FROM listed) {joins} GROUP BY row
),
steps AS (
    SELECT floor(score * 100) AS step, count_if(decided = 'allow') AS good, count_if(decided = 'block') AS bad
    FROM listed JOIN scores USING (row) WHERE decided IS NOT NULL AND aside GROUP BY step
),
cuts AS (
    SELECT step, sum(good) OVER () AS goods, sum(bad) OVER () AS bads,
        coalesce(sum(good) OVER before, 0) AS missed, coalesce(sum(bad) OVER before, 0) AS stopped
    FROM steps WINDOW before AS (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
cut AS (
    SELECT coalesce((SELECT step / 100 FROM cuts WHERE goods > 0 AND bads > 0
        ORDER BY (goods - missed) * bads + stopped * goods DESC, abs(step), step LIMIT 1), 0) AS cut
),
kinds AS (SELECT count(DISTINCT decided) AS n, min(decided) AS sole FROM listed)
SELECT page_id, host, path, rule, coalesce(decided, CASE WHEN n < 2 THEN coalesce(sole, 'allow')
    WHEN score >= cut THEN 'allow' ELSE 'block' END) AS verdict
FROM listed JOIN scores USING (row), cut, kinds
"""


ORACLES = {
    "op1_suffix_dedup": SUFFIX_DEDUP.strip(),
    "op3_embedding_dedup": EMBEDDING_DEDUP.strip(),
    "op7_licenses": LICENSES.strip(),
    "op10_substring_dedup": SUBSTRING_DEDUP.strip(),
    "op11_resampling": RESAMPLING.strip(),
    "op12_url_filter": _url_filter(RULES).strip(),
    "op13_merkle_manifest": _merkle().strip(),
}
