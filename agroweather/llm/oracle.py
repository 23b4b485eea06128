"""DuckDB statements of the text queries that SQL expresses."""

from agroweather.llm import url_filter
from agroweather.llm.license_scan import RULES, SENTENCES

LINE_DEDUP = r"""
WITH lines AS (
    SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
    SELECT *, translate(
        trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), shared AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
    SELECT k.*, s.keeper IS NOT NULL AND k.doc_id < s.keeper AS gone
    FROM keyed k LEFT JOIN shared s USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_KNOWN = ", ".join(f"('{name}', '{text}')" for name, text in SENTENCES.items())
_SHOWN = ", ".join(
    "CASE WHEN "
    + " OR ".join(f"contains(ids, ',{','.join(sequence)},')" for sequence in sequences)
    + f" THEN '{name}' END"
    for name, sequences in RULES
)
LICENSE_SCAN = rf"""
WITH known(name, sentence) AS (VALUES {_KNOWN}), parts AS (
    SELECT doc_id, string_split(regexp_replace(translate(
        regexp_replace(coalesce(text, ''), '[.!?][\x20\x09\x0D]+', chr(10), 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^a-z0-9
]+', ' ', 'g'), chr(10)) AS parts
    FROM documents
), sentences AS (
    SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS sentence FROM parts
), found AS (
    SELECT doc_id, count(*) AS n, ',' || string_agg(name, ',' ORDER BY pos) || ',' AS ids
    FROM sentences JOIN known ON trim(sentences.sentence) = known.sentence GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_sentences, coalesce(trim(ids, ','), '') AS sentence_ids,
       CASE WHEN ids IS NULL THEN '' ELSE concat_ws(',', {_SHOWN}) END AS licenses
FROM documents LEFT JOIN found USING (doc_id)
"""

_WHOLE_VECTORS = """
WITH valid AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
)"""
_PRODUCT = """CAST(coalesce(list_sum(list_transform(
        generate_series(1, len({a}.v)), lambda i: {a}.v[i] * {b}.v[i])), 0) AS BIGINT)"""
HARD_NEGATIVES = f"""{_WHOLE_VECTORS.format(scale=256)}, rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, v
    FROM valid WHERE label IS NOT NULL
), scored AS (
    SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id, {_PRODUCT.format(a="a", b="c")} AS score
    FROM rows a JOIN rows c ON len(a.v) = len(c.v) AND a.vec_id <> c.vec_id
    WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score
    FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), found AS (
    SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
           row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS place
    FROM positives p JOIN scored s USING (anchor_id)
    WHERE NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM found WHERE place <= 3
"""
TOP_PRODUCTS = f"""{_WHOLE_VECTORS.format(scale=1024)}, scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, {_PRODUCT.format(a="q", b="c")} AS score
    FROM valid q JOIN valid c ON len(q.v) = len(c.v) AND q.vec_id <> c.vec_id
    WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 10
"""

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

# Smallest member of each component of ``links (a, b)``, both ways round.
_COMPONENTS = """reached(a, b) AS (
    SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), lowest AS (SELECT a, min(b) AS low FROM reached GROUP BY a)"""

EMBEDDING_JOIN = f"""
WITH RECURSIVE valid AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT p.vec_id AS a, q.vec_id AS b FROM valid p JOIN valid q
    ON p.label = q.label AND p.vec_id <> q.vec_id AND len(p.v) = len(q.v)
    WHERE list_cosine_similarity(p.v, q.v) >= 0.93
), {_COMPONENTS}, counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
       least(vec_id, coalesce(low, vec_id)) = vec_id AS kept
FROM embeddings LEFT JOIN lowest ON lowest.a = vec_id LEFT JOIN counted ON counted.a = vec_id
"""

NGRAM_JOIN = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle
    FROM (SELECT *, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS n
    FROM shingles p JOIN shingles q ON p.shingle = q.shingle AND p.doc_id <> q.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * shared.n >= 75 * (x.n + y.n - shared.n)
), {_COMPONENTS}
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest ON lowest.a = doc_id
"""

DECONTAMINATION = rf"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
    SELECT item_id, w, least(len(w), 10) AS k FROM (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}),
                                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark)
    WHERE len(w) > 0
), windows AS (
    SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS words
    FROM (SELECT *, unnest(generate_series(1, len(w) - k + 1)) AS i FROM item)
), places AS (
    SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS words
    FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
          FROM doc, (SELECT DISTINCT k FROM item) WHERE len(w) >= k)
), found AS (SELECT doc_id, k, i, item_id FROM places JOIN windows USING (k, words)
), hit AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS place FROM found) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _rule(column: int | None) -> str:
    """The longest fitting rule's name, or one of its columns."""
    fits = [
        f"WHEN (host = '{rule[0]}' OR ends_with(host, '.{rule[0]}')) AND starts_with(path, '{rule[1]}') "
        f"THEN '{rule[0] + rule[1] if column is None else rule[column]}'"
        for rule in reversed(sorted(url_filter.RULES, key=lambda rule: len(rule[0] + rule[1])))
    ]
    return f"CASE {' '.join(fits)} END"


_Z, _PRIOR, _WEIGHT = url_filter.SIMILAR_Z, url_filter.PRIOR, url_filter.PRIOR_WEIGHT


def _evidence(groups: str, by: str) -> str:
    return f"""
    SELECT {by}, CASE WHEN squares - b * b / n <=
                     (free + {_Z} * sqrt(2.0 * free)) * (b / n) * (1 - b / n) + 1e-9
                THEN (b + {_PRIOR * _WEIGHT}) / (n + {_WEIGHT}) ELSE -1 END AS found
    FROM (SELECT {by}, sum(n)::DOUBLE AS n, sum(b)::DOUBLE AS b, sum(b * b / n) AS squares, count(*) - 1 AS free
          FROM {groups} WHERE n > 0 GROUP BY {by})"""


URL_FILTER = rf"""
WITH parts AS (
    SELECT page_id,
           CASE WHEN position('://' IN url) > 0
                THEN translate(regexp_extract(rest, '^[^/?#]*'), {_LOWER}) ELSE '' END AS host,
           CASE WHEN position('://' IN url) > 0
                THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
    FROM (SELECT page_id, url, substr(url, position('://' IN url) + 3) AS rest FROM pages)
), pages_ AS (
    SELECT page_id, host, path, {_rule(None)} AS rule, {_rule(2)} AS ruled,
           list_transform(list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''),
               lambda s: [s, regexp_replace(s, '\.[A-Za-z]{{1,5}}$', '')]),
               lambda p: CASE
                   WHEN regexp_matches(p[2], '^[0-9]+$') THEN '{{number}}' || substr(p[1], length(p[2]) + 1)
                   WHEN regexp_matches(p[2], '^[0-9a-fA-F-]{{8,}}$') THEN '{{hex}}' || substr(p[1], length(p[2]) + 1)
                   WHEN regexp_matches(p[2], '[0-9]') AND length(p[2]) >= 12
                   THEN '{{mixed}}' || substr(p[1], length(p[2]) + 1)
                   ELSE translate(p[1], {_LOWER}) END) AS template
    FROM parts
), leaves AS (
    SELECT host, template, count(ruled) AS labelled, count(*) FILTER (ruled = 'block') AS blocked
    FROM pages_ GROUP BY host, template
), levels AS (
    SELECT *, template[1:level - 1] AS parent, template[level] AS branch
    FROM (SELECT *, unnest(generate_series(1, len(template))) AS level FROM leaves)
), nodes AS (
    SELECT host, level, parent, branch, sum(labelled)::DOUBLE AS n, sum(blocked)::DOUBLE AS b
    FROM levels GROUP BY ALL
), named AS (
    SELECT *, CASE WHEN n = 0 THEN '?'
        WHEN abs(b / n - rate) <= {_Z} * sqrt(rate * (1 - rate) * greatest(1 / n - 1 / n_all, 0)) + 1e-9 THEN '*'
        ELSE branch END AS name
    FROM (SELECT *, sum(n) OVER siblings AS n_all, sum(b) OVER siblings / sum(n) OVER siblings AS rate
          FROM nodes WINDOW siblings AS (PARTITION BY host, level, parent))
), renamed AS (
    SELECT host, template, list(name ORDER BY level) AS merged
    FROM levels JOIN named USING (host, level, parent, branch) GROUP BY host, template
), trees AS (
    SELECT host, template, labelled, blocked, coalesce(merged, []::VARCHAR[]) AS merged,
           list_transform(template, lambda s: CASE WHEN starts_with(s, '{{') THEN s ELSE '*' END) AS shape
    FROM leaves LEFT JOIN renamed USING (host, template)
), own AS (SELECT host, merged, sum(labelled)::DOUBLE AS n, sum(blocked)::DOUBLE AS b FROM trees GROUP BY ALL
), shapes AS (
    SELECT host, shape, merged, sum(labelled)::DOUBLE AS n, sum(blocked)::DOUBLE AS b FROM trees GROUP BY ALL
), of_shape AS ({_evidence("shapes", "host, shape")}
), chain AS (
    SELECT host, up, array_to_string(labels[up + 1:], '.') AS domain
    FROM (SELECT host, labels, unnest(generate_series(0, greatest(len(labels) - {url_filter.LEAST_LABELS}, 0))) AS up
          FROM (SELECT DISTINCT host, string_split(host, '.') AS labels FROM own))
), reached AS (SELECT domain, n, b FROM own JOIN chain USING (host)
), of_host AS ({_evidence("reached", "domain")}
), nearest AS (
    SELECT host, up, found FROM chain JOIN of_host USING (domain)
    QUALIFY row_number() OVER (PARTITION BY host ORDER BY up) = 1
), placed AS (
    SELECT t.host, t.template, t.merged,
           CASE WHEN n > 0 THEN 0 WHEN s.found >= 0 THEN 1
                WHEN s.found IS NULL AND h.found >= 0 THEN h.up + 2 END AS steps,
           CASE WHEN n > 0 THEN (b + {_PRIOR * _WEIGHT}) / (n + {_WEIGHT}) ELSE coalesce(s.found, h.found) END AS found
    FROM trees t JOIN own o ON o.host = t.host AND o.merged = t.merged
    LEFT JOIN of_shape s ON s.host = t.host AND s.shape = t.shape LEFT JOIN nearest h ON h.host = t.host
), judged AS (
    SELECT *, CASE WHEN steps IS NULL THEN {_PRIOR}
              ELSE {_PRIOR} + pow({url_filter.STEP}, steps) * (found - {_PRIOR}) END AS purity FROM placed
)
SELECT page_id, p.host, path, rule,
       coalesce(ruled, CASE WHEN purity >= {url_filter.REJECT_FROM} THEN 'block' ELSE 'allow' END) AS verdict,
       '/' || array_to_string(merged, '/') AS template, round(purity, 9) AS purity, CAST(steps AS INTEGER) AS steps
FROM pages_ p JOIN judged j ON j.host = p.host AND j.template = p.template
"""

ORACLES = {
    "op1_line_dedup": LINE_DEDUP,
    "op4_embedding_join": EMBEDDING_JOIN,
    "op5_ngram_join": NGRAM_JOIN,
    "op6_license_scan": LICENSE_SCAN,
    "op8_url_filter": URL_FILTER,
    "op9_decontamination": DECONTAMINATION,
    "op11_hard_negatives": HARD_NEGATIVES,
    "op13_top_products": TOP_PRODUCTS,
}
