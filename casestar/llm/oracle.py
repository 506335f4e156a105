"""DuckDB twins of the corpus queries that SQL can express.

They restate the contracts in plain SQL (windows by unnesting, spans by running
sums, estimation as one step per CTE), not the operators' methods.
"""

from __future__ import annotations

from casestar.llm import lookup_sharding, quality_rules, secret_scan, source_divergence

WORD = r"[^\x20\x09-\x0D]+"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def quality_sql() -> str:
    """Statistics, votes, label model and verdict."""
    function_words = ", ".join(map(_quoted, quality_rules.FUNCTION_WORDS))

    def rule(bad: str, good: str) -> str:
        return f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END"

    votes = [
        rule("n < 10", "n >= 20"),
        rule("word_chars < 2 * n OR word_chars > 15 * n", "word_chars >= 3 * n AND word_chars <= 12 * n"),
        rule("10 * n_symbols > n", "50 * n_symbols <= n"),
        rule("10 * runs > n", "50 * runs <= n"),
        rule("10 * dup > 3 * lines", "20 * dup <= lines"),
        rule("100 * rep > 20 * n", "100 * rep <= 5 * n"),
        rule("8 * vocab < n AND n >= 20", "4 * vocab >= n"),
        rule("10 * caps > 3 * word_chars", "100 * caps <= 15 * word_chars"),
        rule("10 * excl > n", "50 * excl <= n"),
        rule("stops = 0 AND n >= 20", "40 * stops >= n"),
        rule("50 * func < n AND n >= 20", "16 * func >= n")]
    rules, weight = range(len(votes)), quality_rules.PRIOR_WEIGHT
    steps = ["m0 AS (SELECT %r AS good, %s)" % (quality_rules.START_GOOD, ", ".join(
        f"{quality_rules.START_ON_GOOD!r} AS g{j}, {quality_rules.START_ON_BAD!r} AS b{j}" for j in rules))]
    evidence = "ln(good / (1 - good)) + " + " + ".join(
        f"CASE v{j} WHEN 1 THEN ln(g{j} / (1 - b{j})) WHEN -1 THEN ln((1 - g{j}) / b{j}) ELSE 0 END" for j in rules)
    posterior = f"1 / (1 + exp(-({evidence})))"

    def share(part: str, whole: str, start: float, low: float, high: float) -> str:
        return f"least(greatest(({part} + {weight} * {start}) / ({whole} + {weight}), {low}), {high})"

    for k in range(quality_rules.ITERATIONS):
        cols = []
        for j in rules:
            gp, gn = (f"coalesce(sum(CASE WHEN v{j} = {v} THEN c * p ELSE 0 END), 0)" for v in (1, -1))
            bp, bn = (f"coalesce(sum(CASE WHEN v{j} = {v} THEN c * (1 - p) ELSE 0 END), 0)" for v in (1, -1))
            cols.append(share(gp, f"({gp} + {gn})", quality_rules.START_ON_GOOD, 0.7, 0.999) + f" AS g{j}")
            cols.append(share(bn, f"({bp} + {bn})", quality_rules.START_ON_BAD, 0.1, 0.99) + f" AS b{j}")
        good = share("coalesce(sum(c * p), 0)", "coalesce(sum(c), 0)", quality_rules.START_GOOD, 0.05, 0.95)
        steps.append(f"m{k + 1} AS MATERIALIZED (SELECT {good} AS good, {', '.join(cols)} FROM "
                     f"(SELECT pats.*, {posterior} AS p FROM pats, m{k}))")
    pattern = ", ".join(f"v{j}" for j in rules)
    return rf"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
windows AS (
  SELECT rid, i, array_to_string(ws[i:i + 4], ' ') AS k
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM docs)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM windows) WHERE c > 1),
covered AS (
  SELECT rid, count(DISTINCT i + o) AS rep FROM again, (SELECT unnest(range(0, 5)) AS o) GROUP BY rid),
stats AS MATERIALIZED (
  SELECT rid, doc_id, len(ws)::BIGINT AS n, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         len(regexp_extract_all(t, '[#*$%&|<>]+')) AS runs, len(list_distinct(ws)) AS vocab,
         len(list_filter(ws, lambda w: w IN ({function_words}))) AS func,
         len(ls) AS lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS dup, coalesce(rep, 0)::BIGINT AS rep,
         length(regexp_replace(t, '[^A-ZÀ-ÖØ-Þ]', '', 'g')) AS caps,
         length(regexp_replace(t, '[^!]', '', 'g')) AS excl, length(regexp_replace(t, '[^.!?]', '', 'g')) AS stops
  FROM (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM docs)
  LEFT JOIN covered USING (rid)),
voted AS MATERIALIZED (SELECT *, {", ".join(f"{v} AS v{j}" for j, v in enumerate(votes))} FROM stats),
pats AS MATERIALIZED (SELECT {pattern}, count(*) AS c FROM voted GROUP BY ALL ORDER BY ALL),
{", ".join(steps)},
scored AS (SELECT voted.*, {posterior} AS p, n < 10 OR 100 * rep > 20 * n AS failed
           FROM voted, m{quality_rules.ITERATIONS})
SELECT doc_id, n AS n_words, word_chars, n_symbols, dup AS n_dup_lines, rep AS n_repeat_words, failed AS base_failed,
       NOT failed AND p >= {quality_rules.THRESHOLD} AS kept, round(p, 6) AS posterior
FROM scored"""


def warc_sql() -> str:
    digits = " || ".join(f"substr('{BASE32}', ((v >> {s}) & 31)::INTEGER + 1, 1)" for s in (15, 10, 5, 0))
    return f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS bytes, sha1(coalesce(html, '')) AS d FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM p),
digest AS (
  SELECT d, string_agg({digits}, '' ORDER BY k) AS b32
  FROM (SELECT d, k, ('0x' || substr(d, k * 5 + 1, 5))::BIGINT AS v
        FROM (SELECT DISTINCT d FROM p), (SELECT unnest(range(0, 8)) AS k)) GROUP BY d)
SELECT page_id, bytes AS payload_bytes, b32 AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f JOIN digest USING (d)"""


def sharding_sql() -> str:
    """The look-up table is data here; tests check it against a naive filling."""
    slots = ",".join(map(str, lookup_sharding.fill_table(lookup_sharding.shard_names())))
    return f"""
WITH lookup AS MATERIALIZED (SELECT string_split('{slots}', ',') AS s),
t AS (SELECT row_number() OVER () - 1 AS slot, shard FROM (SELECT unnest(s)::INTEGER AS shard FROM lookup)),
placed AS (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 15))::BIGINT
                          % {lookup_sharding.TABLE_SIZE} AS slot FROM documents)
SELECT doc_id, shard FROM placed JOIN t USING (slot)"""


def contamination_sql() -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

    def words(table: str) -> str:
        return (f"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
                f"'abcdefghijklmnopqrstuvwxyz'), '{word}') AS ws FROM {table}")

    return rf"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, {words("documents")}),
items AS MATERIALIZED (SELECT item_id::VARCHAR AS item, {words("benchmark")}),
windows AS MATERIALIZED (
  SELECT DISTINCT item, least(len(ws), 13) AS l, array_to_string(ws[i:i + 12], ' ') AS k
  FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM items WHERE len(ws) > 0)),
starts AS (
  SELECT rid, ws, l, unnest(range(1, len(ws) - l + 2)) AS i FROM docs, (SELECT DISTINCT l FROM windows)),
hits AS MATERIALIZED (
  SELECT rid, i, s.l, item FROM starts s JOIN windows w ON w.l = s.l AND w.k = array_to_string(s.ws[i:i + s.l - 1], ' ')),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + l)) AS p FROM hits) GROUP BY rid),
found AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids
          FROM hits GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM docs LEFT JOIN hit USING (rid) LEFT JOIN found USING (rid)"""


def secrets_sql() -> str:
    parts = []
    for order, r in enumerate(secret_scan.RULES):
        if r.group:
            head, tail = r.pattern[:r.pattern.rindex("(")], r.pattern[r.pattern.rindex("("):]
            pattern, marked, cycle = f"({head}){tail}", r"chr(1) || '\1' || chr(1) || '\2' || chr(1)", 3
        else:
            pattern, marked, cycle = f"({r.pattern})", r"chr(1) || '\1' || chr(1)", 2
        before = "length(h)" if cycle == 3 else "0"
        parts.append(rf"""
  SELECT rid, (pos - {before})::BIGINT AS s, {order} AS o, (pos + length(p))::BIGINT AS e, '{r.kind}' AS kind
  FROM (SELECT rid, j, p, lag(p) OVER w AS h,
               coalesce(sum(length(p)) OVER (PARTITION BY rid ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
        FROM (SELECT rid, generate_subscripts(ps, 1) - 1 AS j, unnest(ps) AS p
              FROM (SELECT rid, string_split(regexp_replace(t, {_quoted(pattern)}, {marked}, 'g'), chr(1)) AS ps FROM docs))
        WINDOW w AS (PARTITION BY rid ORDER BY j))
  WHERE j % {cycle} = {cycle - 1} AND length(p) >= {r.least}""")
    text = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o)"
    return f"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, replace(coalesce(text, ''), chr(1), chr(2)) AS t FROM documents),
found AS MATERIALIZED ({" UNION ALL ".join(parts)}),
per_doc AS (
  SELECT rid, count(*) FILTER (o = 0) AS a, count(*) FILTER (o = 1) AS k, count(*) FILTER (o = 2) AS x,
         {text} FILTER (o < 3) AS base, {text} AS every FROM found GROUP BY rid)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(k, 0)::BIGINT AS n_access, coalesce(x, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
FROM docs LEFT JOIN per_doc USING (rid)"""


def divergence_sql() -> str:
    """Every kept term with every group, absent ones included, and every pair of groups."""
    unit = f"{source_divergence.UNIT}::HUGEINT"
    return rf"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
tokens AS MATERIALIZED (SELECT rid, lang, source, unnest(ts) AS term FROM docs),
kept AS MATERIALIZED (
  SELECT lang, term, count(*) AS n FROM tokens GROUP BY lang, term HAVING count(DISTINCT rid) >= {source_divergence.MIN_DOCS}),
langs AS (SELECT lang, sum(n) AS total, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, k.n AS lang_n, coalesce(c.n, 0) AS n
  FROM groups g JOIN kept k USING (lang) LEFT JOIN (
    SELECT lang, source, term, count(*) AS n FROM tokens GROUP BY ALL) c USING (lang, source, term)),
shares AS MATERIALIZED (
  SELECT c.lang, c.source, c.term, c.n,
         1 + ({unit} * (c.n + 1)) // (sum(c.n) OVER (PARTITION BY c.lang, c.source) + l.v) AS p,
         1 + ({unit} * (c.lang_n + 1)) // (l.total + l.v) AS q
  FROM counts c JOIN langs l USING (lang)),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM found)
SELECT lang, source, part, item, value::BIGINT AS value, r::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR r <= {source_divergence.TOP_TERMS}"""


def negatives_sql() -> str:
    """Every anchor against every row."""
    return """
WITH parsed AS (
  SELECT row_number() OVER () AS rid, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding
  FROM (SELECT DISTINCT vec_id, label, embedding FROM embeddings)),
rows AS MATERIALIZED (
  SELECT rid, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS c FROM parsed
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS MATERIALIZED (
  SELECT a.rid AS arid, a.vec_id AS anchor_id, r.rid, r.vec_id, r.label = a.label AS same,
         list_inner_product(a.c, r.c)::BIGINT AS s
  FROM rows a JOIN rows r ON a.rid <> r.rid WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT arid, anchor_id, vec_id AS positive_id, s AS positive_score,
         row_number() OVER (PARTITION BY arid ORDER BY s DESC, vec_id) AS k
  FROM scores WHERE same QUALIFY k <= 5)
SELECT p.anchor_id, p.positive_id,
       (row_number() OVER (PARTITION BY p.arid, p.k ORDER BY n.s DESC, n.vec_id))::INTEGER AS rank,
       n.vec_id AS negative_id, p.positive_score, n.s AS negative_score
FROM positives p JOIN scores n ON n.arid = p.arid AND NOT n.same
  AND 50 * p.positive_score <= 100 * n.s AND 100 * n.s <= 95 * p.positive_score
QUALIFY rank <= 3"""


SQL: dict[str, str] = {
    "op1_quality_rules": quality_sql(),
    "op3_warc_zstd": warc_sql(),
    "op5_lookup_sharding": sharding_sql(),
    "op6_decontaminate": contamination_sql(),
    "op10_secret_scan": secrets_sql(),
    "op11_source_divergence": divergence_sql(),
    "op12_hard_negatives": negatives_sql(),
}
