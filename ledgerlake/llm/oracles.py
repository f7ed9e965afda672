"""DuckDB SQL for the queries of this package that SQL can express.

Secret windows, tiles, paths of transducers, fingerprints and parsed pages are beyond it; tests
hold those queries against brute force.
"""

from __future__ import annotations

from ledgerlake.llm import (
    centroid_clustering,
    host_reputation,
    quality_rules,
    source_divergence,
    tool_calls,
)

SPACE = r"[ \t\n\x0B\f\r]"

OP5 = rf"""
WITH line AS (
  SELECT doc_id, p, l[p] AS line,
    translate(regexp_replace(l[p], '^{SPACE}+|{SPACE}+$', '', 'g'),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS p
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM line WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*) AS n_lines,
  count(*) FILTER (WHERE keeper IS NOT NULL AND doc_id <> keeper) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY p)
    FILTER (WHERE keeper IS NULL OR doc_id = keeper), '')) AS kept_sha256
FROM line LEFT JOIN shared USING (key) GROUP BY doc_id
"""


def _op7() -> str:
    rules = quality_rules
    lists = ", ".join(
        f"'{lang}': [{', '.join(repr(w) for w in words)}]"
        for lang, words in rules.COMMON_WORDS.items()
    )
    # The same classes, each taken out of what the ones before have left.
    left, sizes = "t", []
    for pattern in rules.CLASSES.values():
        java = pattern.replace("'", "''").replace(r"\x20\x09-\x0D", r" \t\n\x0B\f\r")
        rest = f"regexp_replace({left}, '{java}', '', 'g')"
        sizes.append(f"length({left}) - length({rest})")
        left = rest
    sizes.append(f"length({left})")
    unit, span = rules.UNIT, rules.WINDOW
    following = " || ".join(f"' ' || lead(word, {k}) OVER along" for k in range(1, span))

    def js(a: str, b: str) -> str:
        n = f"list_sum({a})", f"list_sum({b})"
        p = f"list_transform({a}, lambda x: x / {n[0]})", f"list_transform({b}, lambda x: x / {n[1]})"

        def part(x: str, y: str) -> str:
            return (
                f"list_sum(list_transform(list_zip({x}, {y}), lambda z: CASE WHEN z[1] > 0"
                " THEN z[1] * log2(2 * z[1] / (z[1] + z[2])) ELSE 0.0 END))"
            )

        both = f"sqrt(greatest(0.0, ({part(*p)} + {part(*p[::-1])}) / 2))"
        return f"CASE WHEN {n[0]} > 0 AND {n[1]} > 0 THEN {both} ELSE 0.0 END"

    def refs(column: str, size: int, enough: str) -> str:
        each = ", ".join(
            f"coalesce(sum(CASE WHEN {enough} THEN {column}[{i + 1}] ELSE 0 END), 0)::DOUBLE"
            for i in range(size)
        )
        return f"[{each}]"

    return rf"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
    CASE WHEN lang IN ({', '.join(repr(x) for x in rules.COMMON_WORDS)}) THEN lang
      ELSE 'other' END AS lang
  FROM documents
), word AS (
  SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p
  FROM (SELECT r, regexp_extract_all(t, '[^ \t\n\x0B\f\r]+') AS w FROM doc)
), win AS (
  SELECT r, p, word || {following} AS gram FROM word
  WINDOW along AS (PARTITION BY r ORDER BY p)
), twice AS (
  SELECT r, gram FROM win WHERE gram IS NOT NULL GROUP BY r, gram HAVING count(*) > 1
), rep AS (
  SELECT r, count(DISTINCT q) AS n_repeat FROM (
    SELECT r, unnest(range(p, p + {span})) AS q FROM win JOIN twice USING (r, gram))
  GROUP BY r
), base AS (
  SELECT doc.r, doc_id, lang, t, coalesce(n_repeat, 0) AS n_repeat,
    regexp_extract_all(t, '[^ \t\n\x0B\f\r]+') AS words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS lines,
    [{', '.join(sizes)}] AS classes,
    coalesce(MAP {{{lists}}}[lang], []::VARCHAR[]) AS known
  FROM doc LEFT JOIN rep USING (r)
), counted AS (
  SELECT *, len(words) AS n_words, list_sum(classes) AS n_chars,
    list_transform(known, lambda k: len(list_filter(words, lambda x: x = k))) AS common
  FROM base
), shared AS (
  SELECT *,
    list_transform(classes, lambda x: floor(x * {unit}.0::DOUBLE / greatest(n_chars, 1))) AS cs,
    list_transform(list_append(common, n_words - coalesce(list_sum(common), 0)),
      lambda x: floor(x * {unit}.0::DOUBLE / greatest(n_words, 1))) AS ws
  FROM counted
), ref AS (
  SELECT lang,
    {refs('cs', len(rules.CLASS_NAMES), f'n_chars >= {rules.MIN_CHARS}')} AS rc,
    {refs('ws', rules.N_COMMON + 1, f'n_words >= {rules.MIN_WORDS}')} AS rw
  FROM shared GROUP BY lang
), far AS (
  SELECT *,
    CASE WHEN n_chars >= {rules.MIN_CHARS} THEN {js('cs', 'rc')} ELSE 0.0 END AS dc,
    CASE WHEN n_words >= {rules.MIN_WORDS} AND lang <> 'other' THEN {js('ws', 'rw')}
      ELSE 0.0 END AS dw,
    n_words < {rules.MIN_WORDS_KEPT} OR 100 * n_repeat > {rules.MAX_REPEAT_PERCENT} * n_words
      AS base_failed
  FROM shared JOIN ref USING (lang)
)
SELECT doc_id, n_words, (n_chars - classes[2])::BIGINT AS word_chars,
  classes[5]::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT
    AS n_dup_lines, n_repeat::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND NOT (dc > {rules.MAX_CLASS_DISTANCE} OR dw > {rules.MAX_WORD_DISTANCE}
    OR dc > {rules.BOTH_CLASS_DISTANCE} AND dw > {rules.BOTH_WORD_DISTANCE}) AS kept
FROM far
"""


OP8 = """
WITH page AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
), hashed AS (
  SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS hex FROM page
), bits AS (
  SELECT page_id, payload_bytes, hex,
    list_aggregate(list_transform(range(1, 41), lambda i:
      substr(((('0x' || substr(hex, i::BIGINT, 1))::INTEGER)::UTINYINT)::BIT::VARCHAR, 5, 4)),
      'string_agg', '') AS b
  FROM hashed
), coded AS (
  SELECT page_id, payload_bytes,
    list_aggregate(list_transform(range(0, 32), lambda i:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        list_sum(list_transform(range(0, 5), lambda k:
          CASE WHEN substr(b, (i * 5 + k + 1)::BIGINT, 1) = '1' THEN 1 << (4 - k) ELSE 0 END
        ))::BIGINT + 1, 1)), 'string_agg', '') AS payload_digest
  FROM bits
), first AS (
  SELECT payload_digest, min(page_id) AS first_id FROM coded GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM coded JOIN first USING (payload_digest)
"""


def _op9() -> str:
    """Plain talk only: the sample's texts hold no JSON."""
    tools = tool_calls.SCHEMAS["reply"]
    assert list(tools) == ["role", "text"]
    return """
WITH said AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text,
    CASE WHEN role = 'user' THEN 'call' WHEN role = 'assistant' AND turn >= 1 THEN 'result'
      ELSE 'text' END AS kind
  FROM conversations
), named AS (
  SELECT *, CASE kind WHEN 'call' THEN turn WHEN 'result' THEN turn - 1 END AS id FROM said
), calls AS (
  SELECT conv_id, id, count(*) AS n FROM named WHERE kind = 'call' GROUP BY ALL
), results AS (
  SELECT conv_id, id, count(*) AS n FROM named WHERE kind = 'result' GROUP BY ALL
), chained AS (
  SELECT conv_id, id, n, id - 2 * row_number() OVER (PARTITION BY conv_id, id % 2 ORDER BY id)
    AS island FROM calls
), levelled AS (
  SELECT conv_id, id, n,
    row_number() OVER (PARTITION BY conv_id, id % 2, island ORDER BY id) - 1 AS level
  FROM chained
)
SELECT s.conv_id, s.turn, s.role, s.kind, s.id::VARCHAR AS call_id,
  coalesce(2 * c.level + CASE WHEN s.kind = 'result' THEN 1 ELSE 0 END, -1) AS step,
  CASE s.kind WHEN 'call' THEN r.n IS NOT NULL WHEN 'result' THEN c.n IS NOT NULL
    ELSE false END AS linked,
  CASE WHEN s.kind = 'call' AND c.n > 1 THEN 'repeated call id'
    WHEN s.kind = 'result' AND c.n IS NULL THEN 'no such call' ELSE '' END AS problems,
  CASE s.kind
    WHEN 'call' THEN '{"arguments":{"role":' || to_json(s.role) || ',"text":' || to_json(s.text)
      || '},"call_id":"' || s.id || '","name":"reply","role":' || to_json(s.role)
      || ',"type":"call"}'
    WHEN 'result' THEN '{"call_id":"' || s.id || '","content":' || to_json(s.text)
      || ',"role":' || to_json(s.role) || ',"type":"result"}'
    ELSE '{"content":' || to_json(s.text) || ',"role":' || to_json(s.role) || ',"type":"text"}'
  END AS json
FROM named s
LEFT JOIN levelled c ON c.conv_id = s.conv_id AND c.id = s.id
LEFT JOIN results r ON r.conv_id = s.conv_id AND r.id = s.id
"""


def _op10() -> str:
    rules = host_reputation
    low, high = rules.STRENGTHS
    unit = rules.UNIT
    verdict, text = "NULL", "NULL"
    for what, at, prefix in sorted(rules.RULES, key=lambda r: len(r[1] + r[2])):
        fits = f"(host = '{at}' OR ends_with(host, '.{at}')) AND starts_with(path, '{prefix}')"
        verdict = f"CASE WHEN {fits} THEN '{what}' ELSE {verdict} END"
        text = f"CASE WHEN {fits} THEN '{at}{prefix}' ELSE {text} END"
    suffix = "parts[-1]"
    domain = "array_to_string(parts[-2:], '.')"
    for known in rules.SUFFIXES:
        labels = known.count(".") + 1
        inside = f"(name = '{known}' OR ends_with(name, '.{known}'))"
        suffix = f"CASE WHEN {inside} THEN '{known}' ELSE {suffix} END"
        domain = (
            f"CASE WHEN {inside} THEN array_to_string(parts[{-labels - 1}:], '.')"
            f" ELSE {domain} END"
        )

    def strength(level: str, source: str) -> str:
        return f"""
{level}_sums AS (
  SELECT count(*) AS g, sum(n)::DOUBLE AS total, sum(k)::DOUBLE AS bad,
    sum(n * n)::DOUBLE AS squares, sum(floor(k * k * {unit}.0::DOUBLE / n)) AS kk
  FROM {source} WHERE n > 0
), {level}_inner AS (
  SELECT *, bad / total AS p, (kk / {unit}.0::DOUBLE - bad / total * bad
    - bad / total * (1 - bad / total) * (g - 1))
    / (bad / total * (1 - bad / total) * (total - squares / total - (g - 1))) AS rho
  FROM {level}_sums
), {level}_prior AS (
  SELECT coalesce(p, 0.0) AS share, CASE WHEN total > 0 AND p * (1 - p) > 0 AND rho > 0
    AND isfinite(rho) THEN greatest({low}::DOUBLE, least({high}::DOUBLE, (1 - rho) / rho))
    ELSE {high}::DOUBLE END AS s
  FROM {level}_inner
)"""

    return rf"""
WITH split AS (
  SELECT page_id,
    translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM (SELECT page_id, coalesce(url, '') AS url FROM pages)
), ruled AS (
  SELECT *, {text} AS rule, {verdict} AS by_rule FROM split
), bad AS (
  SELECT doc_id AS page_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad
  FROM labels WHERE doc_id IS NOT NULL AND (toxic IS NOT NULL OR quality IS NOT NULL)
  GROUP BY doc_id
), host_counts AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS k
  FROM split LEFT JOIN bad USING (page_id) GROUP BY host
), hosts AS (
  SELECT host, n, k, {suffix} AS suffix, {domain} AS domain
  FROM (SELECT *, regexp_replace(host, ':[0-9]*$', '') AS name,
    string_split(regexp_replace(host, ':[0-9]*$', ''), '.') AS parts FROM host_counts)
), domains AS (
  SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY ALL
), suffixes AS (
  SELECT suffix, sum(n) AS n, sum(k) AS k FROM domains GROUP BY ALL
), {strength('suffix', 'suffixes')}, {strength('domain', 'domains')}, {strength('host', 'hosts')},
suffix_means AS (
  SELECT suffix, (s * share + k) / (s + n) AS m FROM suffixes, suffix_prior
), domain_means AS (
  SELECT domain, suffix, (s * m + k) / (s + n) AS m
  FROM domains JOIN suffix_means USING (suffix), domain_prior
), posterior AS (
  SELECT host, s * m + k AS a, s * (1 - m) + n - k AS b
  FROM hosts JOIN domain_means USING (domain, suffix), host_prior
), bounds AS (
  SELECT host, a / (a + b) - {rules.DEVIATIONS}
    * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bound
  FROM posterior
)
SELECT page_id, host, path, rule,
  coalesce(by_rule, CASE WHEN bound > {rules.LIMIT} THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN bounds USING (host)
"""


def _op11() -> str:
    rules = centroid_clustering
    steps = []
    for i in range(rules.ROUNDS + 1):
        steps.append(f"""near{i} AS MATERIALIZED (
  SELECT r, vec_id, v, min(d) AS distance, arg_min(c, (d, c)) AS cluster FROM (
    SELECT r, vec_id, v, c, list_sum(list_transform(list_zip(v, w),
      lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM whole, centroids{i})
  GROUP BY r, vec_id, v
)""")
        if i < rules.ROUNDS:
            steps.append(f"""moved{i} AS (
  SELECT cluster AS c, list(((s - ((s % n + n) % n)) // n)::BIGINT ORDER BY place) AS w FROM (
    SELECT cluster, place, sum(v[place]) AS s, count(*) AS n
    FROM near{i}, range(1, {rules.DIMENSIONS} + 1) AS t(place) GROUP BY ALL)
  GROUP BY cluster
), centroids{i + 1} AS MATERIALIZED (
  SELECT c, coalesce(moved{i}.w, centroids{i}.w) AS w FROM centroids{i} LEFT JOIN moved{i} USING (c)
)""")
    rest = ", ".join(steps)
    n = rules.DIMENSIONS
    return f"""
WITH whole AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda x: floor({rules.SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = {n}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {n}
), centroids0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY key, vec_id NULLS FIRST, v) - 1 AS c, v AS w FROM (
    SELECT *, sha256('{rules.SALT}' || coalesce(vec_id::VARCHAR, '')) AS key FROM whole
    ORDER BY key, vec_id NULLS FIRST, v LIMIT {rules.CENTROIDS})
), {rest}
SELECT vec_id, cluster::INTEGER AS cluster, distance,
  (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
  (sum(distance) OVER ())::BIGINT AS inertia,
  sha256(list_aggregate(w::VARCHAR[], 'string_agg', ',')) AS centroid_sha256
FROM near{rules.ROUNDS} JOIN centroids{rules.ROUNDS} ON cluster = c
"""


def _op12() -> str:
    rules = source_divergence

    def share(n: str, total: str) -> str:
        return f"(1 + {rules.UNIT}::HUGEINT * ({n} + 1) // ({total} + v))"

    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), counted AS (
  SELECT r, lang, source, term, count(*) AS n FROM (
    SELECT r, lang, source,
      unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs)
  GROUP BY ALL
), terms AS MATERIALIZED (
  SELECT lang, term, sum(n) AS lang_n FROM counted
  GROUP BY ALL HAVING count(*) >= {rules.MIN_DOCS}
), used AS MATERIALIZED (
  SELECT lang, source, term, sum(n) AS n
  FROM counted JOIN terms USING (lang, term) GROUP BY ALL
), langs AS (
  SELECT lang, count(term) AS v, coalesce(sum(lang_n), 0) AS lang_total
  FROM (SELECT DISTINCT lang FROM docs) LEFT JOIN terms USING (lang) GROUP BY lang
), groups AS (
  SELECT lang, source, v, lang_total, coalesce(sum(n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) JOIN langs USING (lang)
  LEFT JOIN used USING (lang, source) GROUP BY ALL
), shares AS MATERIALIZED (
  SELECT lang, source, term, coalesce(n, 0) AS n,
    {share('coalesce(n, 0)', 'total')} AS p, {share('lang_n', 'lang_total')} AS q
  FROM groups JOIN terms USING (lang) LEFT JOIN used USING (lang, source, term)
), summed AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN summed ON a.lang = summed.lang AND a.source = summed.source AND b.source = item
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM found
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= {rules.TOP}
"""


def build() -> dict[str, str]:
    return {
        "op5_line_dedup": OP5,
        "op7_quality_rules": _op7(),
        "op8_warc": OP8,
        "op9_tool_calls": _op9(),
        "op10_host_reputation": _op10(),
        "op11_centroid_clustering": _op11(),
        "op12_source_divergence": _op12(),
    }
