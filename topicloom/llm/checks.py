"""SQL (DuckDB dialect) that repeats those queries of the catalogue that SQL can express.

Set-similarity groups, boosted trees, compression ratios, tree scoring, repeated substrings and
seeded draws have none; they are tested against brute force, round trips and held-out accuracy.
"""

from __future__ import annotations

from topicloom.llm import secrets, url_filter


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _matches(kind: str, rank: int, pattern: str, keep: str) -> str:
    """Rows (doc_id, kind, rank, match, start) of one pattern: gaps and matches take turns."""
    return f"""
        SELECT doc_id, '{kind}' AS kind, {rank} AS rank, match, start FROM (
            SELECT doc_id, match, sum(length(gap)) OVER w + coalesce(sum(length(match)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
            FROM (SELECT doc_id, unnest(m) AS match, unnest(g[1:len(m)]) AS gap, generate_subscripts(m, 1) AS i FROM (
                SELECT doc_id, regexp_extract_all(t, {_q(pattern)}) AS m, string_split_regex(t, {_q(pattern)}) AS g FROM docs WHERE regexp_matches(t, {_q(pattern)})))
            WINDOW w AS (PARTITION BY doc_id ORDER BY i))
        WHERE {keep}"""


def _scan() -> str:
    w = secrets.WINDOW
    window = f"string_split(substr(match, i, {w}), '')"
    weight = f"list_min(list_transform(generate_series(1, length(match) - {w - 1}), lambda i: list_sum(list_transform(list_distinct({window}), lambda c: ({secrets.COUNT_WEIGHTS})[len(list_filter({window}, lambda x: x = c)) + 1]))))"
    limit = {k: secrets.limit_of(v) for k, v in secrets.LIMITS.items()}
    allowed = " OR ".join(f"regexp_matches(match, {_q(p)})" for p in secrets.ALLOW)
    allowed += f" OR len(list_filter(string_split_regex(match, {_q(secrets.SIGNS)}), lambda p: NOT regexp_matches(p, {_q(secrets.ALLOWED_PART)}))) = 0"
    suspicious = f"""regexp_matches(match, '[0-9]') AND regexp_matches(match, '[A-Za-z]') AND NOT ({allowed}) AND {weight} <= CASE
        WHEN regexp_matches(match, '^([0-9a-f]+|[0-9A-F]+)$') THEN {limit["hex"]}
        WHEN NOT (regexp_matches(match, '[a-z]') AND regexp_matches(match, '[A-Z]')) THEN {limit["single"]} ELSE {limit["mixed"]} END"""
    listed = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank)"
    return f"""
        WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        base AS (SELECT *, start + length(match) AS stop FROM (
            {_matches("assign", 0, secrets.ASSIGN, f"length(regexp_extract(match, {_q(secrets.ASSIGN)}, 2)) >= {secrets.MIN_ASSIGN}")}
            UNION ALL {_matches("access", 1, secrets.ACCESS, f"length(match) >= {secrets.MIN_ACCESS}")}
            UNION ALL {_matches("hex", 2, secrets.HEX, f"length(match) >= {secrets.MIN_HEX}")})),
        tokens AS (SELECT *, start + length(match) AS stop FROM ({_matches("entropy", 3, secrets.CANDIDATE, "true")})),
        entropy AS (SELECT * FROM tokens t WHERE {suspicious}
            AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = t.doc_id AND b.start < t.stop AND t.start < b.stop)),
        of_base AS (SELECT doc_id, {listed} AS line, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
            count(*) FILTER (kind = 'hex') AS n_hex FROM base GROUP BY doc_id),
        of_all AS (SELECT doc_id, {listed} AS spans FROM (SELECT * FROM base UNION ALL SELECT * FROM entropy) GROUP BY doc_id)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
            sha256(coalesce(line, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM docs LEFT JOIN of_base USING (doc_id) LEFT JOIN of_all USING (doc_id)"""


def _urls() -> str:
    n, both = url_filter.N, ("allow", "block")
    rules = ", ".join(f"({_q(h)}, {_q(p)}, {_q(v)})" for h, p, v in url_filter.RULES)
    upper, lower = _q("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _q("abcdefghijklmnopqrstuvwxyz")
    shorter = ", ".join(f"sum(c3_{v}) OVER (PARTITION BY y, z) AS c2_{v}, sum(c3_{v}) OVER (PARTITION BY z) AS c1_{v}" for v in both)
    totals = ", ".join(
        f"sum(c3_{v}) OVER (PARTITION BY x, y) AS t3_{v}, sum(c3_{v}) OVER (PARTITION BY y) AS t2_{v}, sum(c3_{v}) OVER () AS t1_{v}, "
        f"sum(CAST(c3_{v} > 0 AS BIGINT)) OVER (PARTITION BY x, y) AS k3_{v}, sum(CAST(c2_{v} > 0 AS BIGINT)) OVER (PARTITION BY y) / {n}.0::DOUBLE AS k2_{v}, "
        f"sum(CAST(c1_{v} > 0 AS BIGINT)) OVER () / {n * n}.0::DOUBLE AS k1_{v}"
        for v in both
    )

    def probability(v: str) -> str:
        p = f"(1.0::DOUBLE / {n})"
        for o in (1, 2, 3):
            p = f"(CASE WHEN t{o}_{v} = 0 THEN {p} ELSE (c{o}_{v} + CAST(k{o}_{v} AS DOUBLE) * {p}) / CAST(t{o}_{v} + k{o}_{v} AS DOUBLE) END)"
        return p

    bins, steps, scale = url_filter.RANGE * url_filter.STEPS, url_filter.STEPS, url_filter.SCALE
    kept_out = f"substr(md5(url), 1, 1) IN ({', '.join(_q(c) for c in '0123456789abcdef'[: 16 // url_filter.KEPT_OUT])})"
    return f"""
        WITH split AS (SELECT page_id, coalesce(url, '') AS url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
        own AS (SELECT row_number() OVER () AS k, page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), {upper}, {lower}) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM split),
        rules(rule_host, rule_path, says) AS (VALUES {rules}),
        ruled AS (SELECT k, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(says, length(rule_host || rule_path)) AS says
            FROM own JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY k),
        known AS MATERIALIZED (SELECT own.*, rule, says, {kept_out} AS kept_out FROM own LEFT JOIN ruled USING (k)),
        codes AS (SELECT k, list_transform(string_split('^^' || regexp_replace(translate(host || path, {upper}, {lower}), '[^a-z0-9./_-]', '?', 'g'), ''),
            lambda c: strpos({_q(url_filter.SYMBOLS)}, c) - 1) AS s FROM known WHERE host || path <> ''),
        grams AS MATERIALIZED (SELECT k, (s[i] * {n} + s[i + 1]) * {n} + s[i + 2] AS gram FROM (SELECT k, s, unnest(generate_series(1, len(s) - 2)) AS i FROM codes)),
        counts AS (SELECT gram, {", ".join(f"count(*) FILTER (says = '{v}') AS c3_{v}" for v in both)} FROM grams JOIN known USING (k) WHERE rule IS NOT NULL AND NOT kept_out GROUP BY gram),
        full3 AS (SELECT range AS gram, range // {n * n} AS x, range // {n} % {n} AS y, range % {n} AS z, {", ".join(f"coalesce(c3_{v}, 0) AS c3_{v}" for v in both)}
            FROM range({n**3}) LEFT JOIN counts ON gram = range),
        full2 AS (SELECT *, {shorter} FROM full3),
        full1 AS (SELECT *, {totals} FROM full2),
        model AS MATERIALIZED (SELECT gram, CAST(round(ln({probability("allow")} / {probability("block")}) * {scale}) AS BIGINT) AS ratio FROM full1),
        scored AS MATERIALIZED (SELECT k, CAST(greatest(-{bins}, least({bins}, floor(sum(ratio) * {steps}.0::DOUBLE / (count(*) * {scale}.0::DOUBLE)))) AS BIGINT) AS bin FROM grams JOIN model USING (gram) GROUP BY k),
        judged AS (SELECT known.*, coalesce(bin, 0) AS bin FROM known LEFT JOIN scored USING (k)),
        held AS (SELECT bin, count(*) FILTER (says = 'allow') AS a, count(*) FILTER (says = 'block') AS b FROM judged WHERE rule IS NOT NULL AND kept_out GROUP BY bin),
        sums AS (SELECT range AS bin, coalesce(sum(a) OVER (ORDER BY range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lost, sum(coalesce(a, 0)) OVER () AS all_a,
            sum(coalesce(b, 0)) OVER () - coalesce(sum(b) OVER (ORDER BY range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS passed, sum(coalesce(b, 0)) OVER () AS all_b
            FROM range(-{bins}, {bins + 1}) LEFT JOIN held ON bin = range),
        least_bin AS (SELECT bin FROM sums ORDER BY CASE WHEN all_a > 0 AND all_b > 0 THEN round(CAST(lost AS DOUBLE) / all_a + CAST(passed AS DOUBLE) / all_b, 9) ELSE 0 END, abs(bin), bin LIMIT 1)
        SELECT page_id, host, path, rule, coalesce(says, CASE WHEN bin >= (SELECT bin FROM least_bin) THEN 'allow' ELSE 'block' END) AS verdict FROM judged"""


def divergence_sql() -> str:
    """Dense version of the source divergence audit: every kept term of every group, all pairs of groups."""
    from topicloom.llm import divergence as dv

    p = lambda c, n, v: f"1 + CAST((CAST({dv.SCALE} AS HUGEINT) * ({c} + {dv.SMOOTH})) // ({n} + {dv.SMOOTH} * {v}) AS BIGINT)"
    return f"""
        WITH d AS (SELECT row_number() OVER () AS rid, coalesce(text, '') AS t, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
        groups AS (SELECT DISTINCT lang, source FROM d),
        tok AS (SELECT rid, lang, source, translate(w, {_q(dv.UPPER)}, {_q(dv.LOWER)}) AS term
            FROM (SELECT rid, lang, source, unnest(regexp_extract_all(t, {_q(dv.TERM)})) AS w FROM d)),
        kept AS (SELECT lang, term, count(*) AS lang_count FROM tok GROUP BY lang, term HAVING count(DISTINCT rid) >= {dv.MIN_DOCS}),
        vocab AS (SELECT lang, count(*) AS V, sum(lang_count) AS lang_N FROM kept GROUP BY lang),
        counts AS (SELECT lang, source, term, count(*) AS c FROM tok SEMI JOIN kept USING (lang, term) GROUP BY ALL),
        sizes AS (SELECT g.lang, g.source, coalesce(sum(c), 0) AS N, coalesce(any_value(v.V), 0) AS V, coalesce(any_value(v.lang_N), 0) AS lang_N
            FROM groups g LEFT JOIN counts USING (lang, source) LEFT JOIN vocab v ON v.lang = g.lang GROUP BY g.lang, g.source),
        dense AS (SELECT s.lang, s.source, k.term, coalesce(c.c, 0) AS c, {p("coalesce(c.c, 0)", "s.N", "s.V")} AS p,
                {p("k.lang_count", "s.lang_N", "s.V")} AS q
            FROM sizes s JOIN kept k ON k.lang = s.lang LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
        pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(abs(da.p - db.p)), 0) AS value
            FROM sizes a JOIN sizes b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN dense da ON da.lang = a.lang AND da.source = a.source
            LEFT JOIN dense db ON db.lang = b.lang AND db.source = b.source AND db.term = da.term
            GROUP BY a.lang, a.source, b.source),
        term AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM dense WHERE c > 0 AND p > q),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (
            SELECT * FROM pair UNION ALL SELECT * FROM term))
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked
        WHERE part = 'pair' OR rank <= {dv.TOP_TERMS}"""


def chat_sql() -> str:
    """Digests of the turns by turn order; the formatted length follows the template's escaping."""
    from topicloom.llm import chat

    esc = lambda x: f"replace(replace({x}, '\\', '\\\\'), '<|', '\\l')"
    order = "ORDER BY turn NULLS LAST, role, text"
    fixed = len(chat.START) + len(chat.BODY) + len(chat.END)
    planted = _q(chat.PLANTED_TEXT)
    return f"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT {chat.PLANTED_CONVERSATION}, 0, 'user', {planted}
            UNION ALL SELECT {chat.PLANTED_CONVERSATION}, 1, 'assistant', {planted})
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' {order})) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (WHERE role = '{chat.LOSS_ROLE}'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' {order}) FILTER (WHERE role = '{chat.LOSS_ROLE}'), '')) AS loss_sha256,
            CAST(sum({fixed} + length({esc("role")}) + length({esc("text")})) AS BIGINT) AS formatted_chars
        FROM c GROUP BY conv_id"""


SQL = {
    "op6_decontamination": r"""
        WITH doc_words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        item_words AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        patterns AS (
            SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS words
            FROM (SELECT *, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM item_words WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT size FROM patterns),
        places AS (
            SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS words
            FROM (SELECT d.*, s.size, unnest(generate_series(1, len(w) - s.size + 1)) AS i FROM doc_words d JOIN sizes s ON len(d.w) >= s.size)),
        found AS (SELECT doc_id, item_id, i, size FROM places JOIN patterns USING (size, words)),
        hit AS (
            SELECT doc_id, count(DISTINCT place) AS n_hit
            FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS place FROM (SELECT DISTINCT doc_id, i, size FROM found)) GROUP BY doc_id),
        items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM found) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op10_warc": r"""
        WITH payloads AS (
            SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS digest, strlen(coalesce(html, '')) AS bytes FROM pages),
        firsts AS (SELECT digest, min(page_id) AS first FROM payloads WHERE bytes >= 100 GROUP BY digest)
        SELECT page_id, bytes AS payload_bytes, digest AS payload_digest,
            CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN page_id > first THEN first END AS refers_to
        FROM payloads LEFT JOIN firsts USING (digest)""",
    "op5_secret_scan": _scan(),
    "op9_url_filter": _urls(),
    "op11_chat_format": chat_sql(),
    "op12_source_divergence": divergence_sql(),
}
