"""SQL (DuckDB dialect) that repeats the queries of the catalogue over the same tables.

Queries without an entry train a model, whose numbers depend on thread timing.
"""

from __future__ import annotations

from topicloom.functions.text import NARROW, WIDE
from topicloom.operators.filters import OTHER_STOP_WORDS, PLACE_SUFFIXES, SYMBOLS
from topicloom.plans.inputs import ACCENTS, HAN_LETTERS, HAN_MIN_FREQ
from topicloom.plans.queries import PREFIXES, SUFFIXES, THRES, TOP_WORDS, TR_DIGITS, VOTES

SQL: dict[str, str] = {}


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _in(words) -> str:
    return "(" + ", ".join(_q(w) for w in words) + ")"


def _any(words, form: str) -> str:
    return "(" + " OR ".join(form.format(_q(w)) for w in words) + ")"


HASH = "CAST('0x' || substr(md5(word), 1, 7) AS BIGINT)"


def _words(text: str) -> str:
    return f"regexp_extract_all(lower(translate({text}, {_q(WIDE)}, {_q(NARROW)})), '[\\p{{L}}]+')"


# Common table expressions, each with those it needs.
CTE: dict[str, tuple[list[str], str]] = {
    "doc": ([], f"SELECT CAST(doc_id AS VARCHAR) AS id, text AS msg, lang, source, {_words('text')} AS words FROM documents"),
    "tok": (["doc"], "SELECT id, lang, source, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS pos FROM doc"),
    "lex": (
        ["tok"],
        "SELECT word, count(*) AS freq, CASE WHEN length(word) >= 6 THEN 'n' WHEN length(word) = 5 THEN 'ns' "
        "WHEN length(word) = 4 THEN 'nr' WHEN length(word) = 3 THEN 'nx' ELSE 'x' END AS nature FROM tok GROUP BY word",
    ),
    "tag": (["tok", "lex"], "SELECT tok.id, tok.pos, tok.word, lex.nature FROM tok JOIN lex USING (word)"),
    "tf": (["tok"], "SELECT id, word, count(*) AS tf FROM tok GROUP BY id, word"),
    "df": (["tf"], "SELECT word, count(*) AS df, CAST(sum(tf) AS BIGINT) AS tf FROM tf GROUP BY word"),
    "n": ([], "SELECT count(*) AS n FROM documents"),
    "stop": (["df", "n"], "SELECT word FROM df, n WHERE df > n // 10"),
    "part_word": ([], "SELECT p_partkey, p_size, unnest(regexp_extract_all(lower(p_name), '[\\p{L}]+')) AS word FROM part"),
    "w": (
        ["tf", "df", "n"],
        "SELECT tf.id, tf.word, ln(CAST(n + 1 AS DOUBLE)) / (df + 1) * tf.tf * 1000 AS weight "
        "FROM tf JOIN df USING (word), n WHERE df > 1",
    ),
    "tfidf": (
        ["w"],
        "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(weight, 6) DESC, word) AS rank, "
        "count(*) OVER (PARTITION BY id) AS n_all FROM w) WHERE rank < n_all",
    ),
    "off": ([], "SELECT unnest([-5, -4, -3, -2, -1, 1, 2, 3, 4]) AS k"),
    "edge": (
        ["tok", "off"],
        "SELECT DISTINCT a.id, a.word, b.word AS neighbour FROM (SELECT id, word, pos, pos + k AS near FROM tok CROSS JOIN off) a JOIN tok b ON b.id = a.id AND b.pos = a.near",
    ),
    "node": (["tf"], "SELECT row_number() OVER (ORDER BY id, word) AS k, id, word FROM tf"),
    "link": (
        ["edge", "node"],
        "SELECT a.k AS a, b.k AS b, 1.0::DOUBLE AS f FROM edge e JOIN node a ON a.id = e.id AND a.word = e.word "
        "JOIN node b ON b.id = e.id AND b.word = e.neighbour WHERE e.word <> e.neighbour "
        "UNION ALL SELECT k, k, 0.0::DOUBLE FROM node",
    ),
    "iter": (
        ["link", "node"],
        "SELECT k, 0 AS it, 0.0::DOUBLE AS s FROM node UNION ALL SELECT l.a, i.it + 1, 0.15::DOUBLE + 0.85::DOUBLE * sum(l.f * i.s) "
        "FROM iter i JOIN link l ON l.b = i.k WHERE i.it < 20 GROUP BY l.a, i.it",
    ),
    "tr": (
        ["iter", "node"],
        "SELECT id, word, s, row_number() OVER (PARTITION BY id ORDER BY round(ln(s), 9) DESC, word) AS rank, "
        "count(*) OVER (PARTITION BY id) AS n_words FROM iter JOIN node USING (k) WHERE it = 20",
    ),
    "trsum": (["tr"], "SELECT word, sum(s) AS trval FROM tr GROUP BY word"),
    "top_word": (["trsum"], f"SELECT word FROM trsum ORDER BY trval DESC, word LIMIT {TOP_WORDS}"),
    "pt": ([], "SELECT lpad(CAST(vec_id AS VARCHAR), 9, '0') AS id, vec_id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings"),
    "wv": (
        ["lex", "pt"],
        f"SELECT word, vec FROM (SELECT word, {HASH} % (SELECT count(*) FROM embeddings) AS vec_id FROM lex WHERE nature = 'n') JOIN pt USING (vec_id)",
    ),
    "pair": (["pt"], "SELECT a.vec_id, a.vec AS a, b.vec AS b FROM pt a JOIN pt b ON b.vec_id = (a.vec_id + 1) % (SELECT count(*) FROM embeddings)"),
    "lp": (
        ["tok"],
        "SELECT DISTINCT word, label FROM (SELECT word, lang AS label FROM tok UNION ALL SELECT word, source FROM tok)",
    ),
    "log": (
        [],
        f"SELECT CAST(conv_id AS VARCHAR) AS imei, turn, text AS key_word, {_words('text')} AS words FROM conversations",
    ),
    "lt": (["log"], "SELECT imei, turn, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS pos FROM log"),
    "score": (["lt", "lp"], "SELECT imei, turn, label, count(*) AS n FROM lt JOIN lp USING (word) GROUP BY ALL"),
    "best5": (
        ["score"],
        "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY imei, turn ORDER BY n DESC, label) AS rank FROM score) WHERE rank <= 5",
    ),
    "tagdict": (["lex"], "SELECT word, substr(word, 1, 1) || '-' || substr(word, 1, 2) || '-' || word AS taglayer FROM lex WHERE nature = 'n'"),
    "tagscore": (["lt", "tagdict"], "SELECT imei, turn, taglayer, count(*) AS n FROM lt JOIN tagdict USING (word) GROUP BY ALL"),
    "tag5": (
        ["tagscore"],
        "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY imei, turn ORDER BY n DESC, taglayer) AS rank FROM tagscore) WHERE rank <= 5",
    ),
    "cd": (["lex"], f"SELECT word, CAST(100 + {HASH} % (SELECT count(*) FROM nation) AS INTEGER) AS s_id FROM lex WHERE nature LIKE 'n%'"),
    "hier": ([], "SELECT n_nationkey + 100 AS id, r_name || '-' || n_name AS name FROM nation JOIN region ON n_regionkey = r_regionkey"),
    "class5": (
        ["lt", "cd", "hier"],
        "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY imei, turn ORDER BY n DESC, s_id) AS rank FROM "
        "(SELECT imei, turn, s_id, name, count(*) AS n FROM lt JOIN cd USING (word) JOIN hier ON hier.id = s_id GROUP BY ALL)) WHERE rank <= 5",
    ),
    "wn": (["tag"], "SELECT word, nature, count(*) AS cnt FROM tag GROUP BY word, nature"),
}
RECURSIVE = {"iter": "iter(k, it, s)"}


def _han(text: str) -> str:
    return f"translate({text}, 'abcdefghijklmnopqrstuvwxyz', {_q(HAN_LETTERS)})"


def _walked(name: str, rows: str, keys: str) -> None:
    """Longest match of the Han lexicon, place by place, in the distinct pieces of some words."""
    CTE[f"{name}_piece"] = (
        [*rows.split(), "han_lex"],
        f"SELECT {keys}, pos, unnest(p) AS piece, generate_subscripts(p, 1) AS part FROM "
        f"(SELECT {keys}, pos, regexp_extract_all({_han('word')}, '\\p{{Han}}+|[^\\p{{Han}}]+') AS p FROM {rows})",
    )
    CTE[f"{name}_spot"] = (
        [f"{name}_piece"],
        "SELECT piece, a AS place, max(n) AS n FROM (SELECT piece, a, unnest(generate_series(2, least(40, length(piece) - a + 1))) AS n FROM "
        f"(SELECT piece, unnest(generate_series(1, length(piece))) AS a FROM (SELECT DISTINCT piece FROM {name}_piece WHERE regexp_matches(piece, '^\\p{{Han}}')))) "
        "WHERE substr(piece, a, n) IN (SELECT word FROM han_lex) GROUP BY ALL",
    )
    CTE[f"{name}_walk"] = (
        [f"{name}_piece", f"{name}_spot"],
        f"SELECT DISTINCT piece, 1::BIGINT, CASE WHEN regexp_matches(piece, '^\\p{{Han}}') THEN coalesce(n, 1) ELSE length(piece) END FROM {name}_piece "
        f"LEFT JOIN (SELECT piece, n FROM {name}_spot WHERE place = 1) USING (piece) "
        f"UNION ALL SELECT w.piece, w.place + w.n, coalesce(s.n, 1) FROM {name}_walk w LEFT JOIN {name}_spot s ON s.piece = w.piece AND s.place = w.place + w.n "
        "WHERE w.place + w.n <= length(w.piece)",
    )
    RECURSIVE[f"{name}_walk"] = f"{name}_walk(piece, place, n)"
    CTE[f"{name}_tok"] = (
        [f"{name}_walk", f"{name}_piece"],
        f"SELECT {keys}, substr(piece, place, n) AS word, row_number() OVER (PARTITION BY {keys} ORDER BY pos, part, place) - 1 AS pos FROM {name}_piece JOIN {name}_walk USING (piece)",
    )


CTE["han_lex"] = (["lex"], f"SELECT {_han('word')} AS word, nature, freq FROM lex WHERE freq >= {HAN_MIN_FREQ} AND regexp_full_match(word, '[a-z]+')")
CTE["log2"] = (
    ["log"],
    "SELECT imei, turn, words FROM log UNION ALL SELECT imei || 'again', turn, words FROM log",
)
CTE["lt2"] = (["log2"], "SELECT imei, turn, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS pos FROM log2")
_walked("hd", "tok", "id")
_walked("hl", "lt2", "imei, turn")
CTE["han_lp"] = (["lp"], f"SELECT {_han('word')} AS word, label FROM lp")
CTE["han_few"] = (["han_lp", "han_lex"], "SELECT word FROM han_lp JOIN han_lex USING (word) WHERE nature LIKE 'n%' GROUP BY word HAVING count(*) < 20")
CTE["han5"] = (
    ["hl_tok", "han_lp", "han_few"],
    "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY imei, turn ORDER BY n DESC, label) AS rank FROM "
    "(SELECT imei, turn, label, count(*) AS n FROM hl_tok JOIN han_few USING (word) JOIN han_lp USING (word) GROUP BY ALL)) WHERE rank <= 5",
)

DOT = "list_dot_product"


def _plus(a: str, b: str) -> str:
    return f"list_transform({a}, lambda x, i: x + {b}[i])"


def _round_ctes(r: int, unit: bool = False) -> None:
    """Tables of merging round ``r``: u for the first-partner form on unit vectors."""
    p = "u" if unit else "m"
    if r == 0:
        vec = "list_transform(vec, lambda x: trunc(x * 1000000) / 1000000.0::DOUBLE)" if unit else "vec"
        CTE[f"{p}0"] = (["pt"], f"SELECT id, id AS ids, v AS vec, sqrt({DOT}(v, v)) AS norm, 1::BIGINT AS size FROM (SELECT id, {vec} AS v FROM pt)")
    here = f"{p}{r}"
    sim = f"{DOT}(a.vec, b.vec)" if unit else f"{DOT}(a.vec, b.vec) / (a.norm * b.norm)"
    order = "partner" if unit else "sim DESC, partner"
    CTE[f"{here}_pairs"] = (
        [here],
        f"SELECT * FROM (SELECT a.id, b.id AS partner, round({sim}, 12) AS sim FROM {here} a JOIN {here} b ON a.id < b.id) WHERE sim > {THRES}::DOUBLE",
    )
    CTE[f"{here}_best"] = (
        [f"{here}_pairs"],
        f"SELECT id, partner, sim, row_number() OVER (ORDER BY id) AS k FROM {here}_pairs "
        f"QUALIFY row_number() OVER (PARTITION BY id ORDER BY {order}) = 1",
    )
    CTE[f"{here}_ord"] = ([f"{here}_best"], f"SELECT id, partner, row_number() OVER (ORDER BY id) AS k FROM {here}_best")
    taken = "(list_contains(s.used, o.id) OR list_contains(s.used, o.partner))"
    CTE[f"{here}_scan"] = (
        [f"{here}_ord"],
        "SELECT 0::BIGINT AS k, []::VARCHAR[] AS used, NULL::VARCHAR AS id, NULL::VARCHAR AS partner, false AS ok UNION ALL "
        f"SELECT o.k, CASE WHEN {taken} THEN s.used ELSE list_concat(s.used, [o.id, o.partner]) END, o.id, o.partner, NOT {taken} "
        f"FROM {here}_scan s JOIN {here}_ord o ON o.k = s.k + 1",
    )
    RECURSIVE[f"{here}_scan"] = f"{here}_scan(k, used, id, partner, ok)"
    CTE[f"{here}_kept"] = ([f"{here}_scan"], f"SELECT id, partner FROM {here}_scan WHERE ok")
    total = _plus("a.vec", "b.vec")
    vec = "list_transform(v, lambda x: trunc(x / n * 1000000) / 1000000.0::DOUBLE)" if unit else "v"
    CTE[f"{p}{r + 1}"] = (
        [here, f"{here}_kept"],
        f"SELECT id, ids, vec, sqrt({DOT}(vec, vec)) AS norm, size FROM (SELECT id, ids, {vec} AS vec, size FROM "
        f"(SELECT *, sqrt({DOT}(v, v)) AS n FROM (SELECT CASE WHEN a.id LIKE '%|' THEN a.id ELSE a.id || '|' END AS id, a.ids || '|' || b.ids AS ids, "
        f"{total} AS v, a.size + b.size AS size FROM {here}_kept k JOIN {here} a ON a.id = k.id JOIN {here} b ON b.id = k.partner))) "
        f"UNION ALL SELECT id, ids, vec, norm, size FROM {here} WHERE id NOT IN (SELECT id FROM {here}_kept UNION ALL SELECT partner FROM {here}_kept)",
    )
    CTE[f"{p}{r + 1}_class"] = ([f"{p}{r + 1}"], f"SELECT *, row_number() OVER (ORDER BY id) - 1 AS class_id FROM {p}{r + 1}")
    CTE[f"{p}{r + 1}_mem"] = ([f"{p}{r + 1}_class"], f"SELECT class_id, size, unnest(string_split(ids, '|')) AS member FROM {p}{r + 1}_class")


_round_ctes(0)
_round_ctes(1)
_round_ctes(0, unit=True)


def _with(needs: list[str], body: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for dep in CTE[name][0]:
            if dep not in order:
                add(dep)
        if name not in order:
            order.append(name)

    for need in needs:
        add(need)
    if not order:
        return body
    heads = ", ".join(f"{RECURSIVE.get(n, n)} AS {'' if n in RECURSIVE else 'MATERIALIZED '}({CTE[n][1]})" for n in order)
    return f"WITH {'RECURSIVE ' if any(n in RECURSIVE for n in order) else ''}{heads} {body}"


def _check(name: str, body: str, *needs: str) -> None:
    SQL[name] = _with(list(needs), body)


# ---------------------------------------------------------------- sources and sinks
_check("s1_read_lines", "SELECT line, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY line")
_check("s2_load_delimited", "SELECT CAST(p_partkey AS VARCHAR) AS key, p_name AS name, p_brand AS brand FROM part WHERE p_size BETWEEN 5 AND 45")
_check(
    "s3_load_typed_csv",
    "SELECT p_name AS word, p_size AS f_id, CAST(p_partkey AS INTEGER) AS s_id, 7::INTEGER AS t_id, 1::INTEGER AS dict_id, "
    "p_brand AS f_name, p_type AS s_name, p_name AS t_name, 'parts' AS dict_name FROM part WHERE p_size >= 5",
)
_check(
    "s4_load_corpus",
    "SELECT msg, count(*) AS n, count(*) AS ids, true AS prefixed FROM (SELECT unnest(string_split(text, chr(10))) AS msg FROM documents) WHERE length(msg) > 100 GROUP BY msg",
)
_check("s5_load_words", "SELECT word, count(*) AS n FROM part_word GROUP BY word", "part_word")
_check("s6_read_partition", "SELECT o_orderkey, o_totalprice, 20240102::BIGINT AS stat_date FROM orders WHERE o_orderstatus = 'O'")
_check("s7_load_class_hierarchy", "SELECT id, name FROM hier", "hier")
_check(
    "s8_save_partition",
    "SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_acctbal < 0 THEN 'd2' ELSE 'd1' END AS stat_date FROM customer",
)
_check("s9_create_schema", "SELECT s_suppkey AS key, s_name AS name, s_acctbal AS balance, s_acctbal > 0 AS positive FROM supplier")
_check("s10_save_load_embeddings", "SELECT id AS word, CAST(i AS INTEGER) AS i, round(x, 6) AS x FROM (SELECT id, unnest(vec) AS x, generate_subscripts(vec, 1) - 1 AS i FROM pt)", "pt")

# ---------------------------------------------------------------- text functions
_widened = f"translate(msg, {_q(NARROW)}, {_q(WIDE)})"
_check("t1_to_half_width", f"SELECT id, translate({_widened} || '｟', {_q(WIDE)}, {_q(NARROW)}) AS half FROM doc", "doc")
_check(
    "t2_to_simplified",
    f"SELECT id, translate(translate(msg, {_q(WIDE)}, {_q(NARROW)}), {_q(''.join(ACCENTS))}, {_q(''.join(ACCENTS.values()))}) AS plain FROM doc",
    "doc",
)
_check("t3_segment", "SELECT id, array_to_string(words, ',') AS words FROM doc", "doc")
_check(
    "t3_segment_han",
    "SELECT doc.id, coalesce(w, '') AS words FROM doc LEFT JOIN (SELECT id, string_agg(word, ',' ORDER BY pos) AS w FROM hd_tok GROUP BY id) USING (id)",
    "doc",
    "hd_tok",
)
SQL["t3_segment_han_joined"] = SQL["t3_segment_han"]
_check(
    "t4_segment_with_nature",
    "SELECT id, CAST(pos AS INTEGER) AS pos, word, CASE WHEN freq > 1 THEN nature ELSE 'x' END AS nature FROM tok JOIN lex USING (word)",
    "tok",
    "lex",
)
_check(
    "t5_with_user_words",
    "SELECT word, nature, freq FROM lex WHERE word NOT IN (SELECT word FROM part_word) UNION ALL "
    "SELECT DISTINCT word, 'mbk' AS nature, 1024::BIGINT AS freq FROM part_word",
    "lex",
    "part_word",
)
_check(
    "t6_tokens_codec",
    "SELECT id, CAST(len(w) AS INTEGER) AS n, array_to_string(w, ',') AS words FROM (SELECT id, list_filter(string_split(msg, ','), lambda x: x <> '') AS w FROM doc)",
    "doc",
)
_check(
    "t7_weighted_codec",
    "SELECT p_partkey, p_name || ';' || (p_size * 10) || ',;0,' || p_brand || ';15,;0,' || p_type || ';70' AS line, 5 AS n FROM part",
)
_check(
    "t8_ids_codec",
    "SELECT o_orderkey, 3 AS n, CAST(o_orderkey AS VARCHAR) AS first, o_orderkey || '|' || o_custkey || '|' || o_orderstatus AS text FROM orders",
)
_check(
    "t9_tag_prefixes",
    "SELECT p_partkey, 0 AS level, p_brand AS tag FROM part UNION ALL SELECT p_partkey, 1, p_brand || '-' || p_type FROM part "
    "UNION ALL SELECT p_partkey, 2, p_brand || '-' || p_type || '-' || p_name FROM part WHERE p_size > 10",
)
_check("t10_vector_codec", f"SELECT id, CAST(len(vec) AS INTEGER) AS width, round({DOT}(vec, vec), 6) AS dot FROM pt", "pt")
_check(
    "t11_truncate6",
    "SELECT id, CAST(i AS INTEGER) AS i, round(trunc(x * 1000000) / 1000000.0::DOUBLE, 6) AS x FROM (SELECT id, unnest(vec) AS x, generate_subscripts(vec, 1) - 1 AS i FROM pt)",
    "pt",
)

# ---------------------------------------------------------------- filters
_counted = "SELECT word, nature, count(*) AS n FROM tag WHERE {} GROUP BY word, nature"
_check("f1_keep_nature", _counted.format("nature LIKE 'n%' AND length(word) > 1"), "tag")
_check("f2_keep_nature_exclude", _counted.format("nature IN ('n', 'nx')"), "tag")
_check("f3_keep_search_nature", _counted.format("(nature LIKE 'mbk%' OR nature LIKE 'n%' OR nature LIKE 'mz%' OR nature LIKE 'muc%') AND length(word) > 1"), "tag")
_affix = "NOT (" + _any(PREFIXES, "starts_with(word, {})") + " OR " + _any(SUFFIXES, "ends_with(word, {})") + ")"
_check("f4_drop_affixes", _counted.format(_affix), "tag")
_check(
    "f5_drop_symbolic",
    "SELECT word, nature, count(*) AS n FROM (SELECT word, CASE WHEN length(word) <= 3 THEN 'nx' ELSE 'n' END AS nature FROM "
    "(SELECT unnest(string_split(msg, ' ')) AS word FROM doc) WHERE word <> '') "
    f"WHERE NOT (nature = 'nx' AND length(translate(word, {_q(SYMBOLS)}, '')) < 2) GROUP BY ALL",
    "doc",
)
_check("f6_drop_words", "SELECT word, count(*) AS n FROM tok WHERE word NOT IN (SELECT word FROM stop) GROUP BY word", "tok", "stop")
_check("f7_drop_rare", "SELECT id, count(*) AS n FROM tok JOIN lex USING (word) WHERE freq >= 3 GROUP BY id", "tok", "lex")
_check("f8_drop_rule_words", "SELECT word, count(*) AS n FROM tok WHERE length(word) % 7 <> 0 GROUP BY word", "tok")
_check("f9_min_tokens", "SELECT id, CAST(len(words) AS INTEGER) AS n FROM doc WHERE len(words) > 50", "doc")
_check("f10_min_df", "SELECT word, df FROM df WHERE df > 1", "df")
_check(
    "f11_min_cluster_size",
    "SELECT class_id, member FROM (SELECT source || '/' || lang AS class_id, id AS member, count(*) OVER (PARTITION BY source, lang) AS n FROM doc) WHERE n > 10",
    "doc",
)
_check("f12_max_label_fanout", "SELECT word, string_agg(label, ',' ORDER BY label) AS labels FROM lp GROUP BY word HAVING count(*) < 5", "lp")
_check("f13_stopwords_by_df", "SELECT word FROM stop", "stop")
_check(
    "f14_stopwords_by_rank",
    f"SELECT word, count(*) AS votes FROM tr WHERE rank > floor(n_words * 0.8::DOUBLE) GROUP BY word HAVING count(*) > {VOTES}",
    "tr",
)
_check("f15_non_empty", "SELECT p_partkey, p_type AS taglayer FROM part WHERE p_size > 25")

# ---------------------------------------------------------------- joins
_check("j1_lookup_vectors", "SELECT id, count(*) AS n, round(sum(vec[1]), 6) AS x0 FROM tok JOIN wv USING (word) GROUP BY id", "tok", "wv")
_check("j2_lookup_labels", "SELECT imei, label, CAST(sum(n) AS BIGINT) AS n FROM score GROUP BY imei, label", "score")
_check("j3_vocab_topk_join", "SELECT word, round(vec[1], 6) AS x0 FROM wv JOIN top_word USING (word)", "wv", "top_word")
_check(
    "j4_doc_labels",
    "SELECT member AS id, class_id, length(msg) AS n_chars, array_to_string(words, ',') AS words FROM m1_mem JOIN doc ON lpad(doc.id, 9, '0') = member",
    "m1_mem",
    "doc",
)
_check(
    "j5_lookup_doc_words",
    "SELECT class_id, member, count(*) AS n, count(DISTINCT word) AS words FROM m1_mem JOIN tok ON lpad(tok.id, 9, '0') = member GROUP BY ALL",
    "m1_mem",
    "tok",
)
_check(
    "j5_missing_members",
    "SELECT class_id, member FROM m1_mem WHERE member NOT IN (SELECT lpad(CAST(doc_id AS VARCHAR), 9, '0') FROM labels)",
    "m1_mem",
)
_check(
    "j6_anti_words",
    "SELECT id, count(*) AS n FROM tok JOIN df USING (word) WHERE df <= 5 AND word NOT IN (SELECT word FROM part_word) GROUP BY id",
    "tok",
    "df",
    "part_word",
)
_check("j7_semi_words", "SELECT id, count(*) AS n FROM tok JOIN df USING (word) WHERE df BETWEEN 2 AND 50 GROUP BY id", "tok", "df")
_check("j8_cosine_self_join_pivots", "SELECT id, partner, round(sim, 6) AS sim FROM m0_pairs", "m0_pairs")
_check("j8_cosine_self_join", "SELECT id, partner, round(sim, 6) AS sim FROM m0_pairs", "m0_pairs")

# ---------------------------------------------------------------- aggregations
_check("a1_word_nature_count", "SELECT * FROM wn", "wn")
_check("a2_term_frequency", "SELECT * FROM tf", "tf")
_check("a3_document_frequency", "SELECT * FROM df", "df")
_check("a4_doc_count", "SELECT count(*) AS n_docs FROM documents")
_check("a5_doc_tfidf", "SELECT id, word, round(weight, 6) AS weight, CAST(rank AS INTEGER) AS rank FROM tfidf", "tfidf")
_check(
    "a5_doc_tfidf_lists",
    "SELECT d.id, coalesce(words, '') AS words, round(coalesce(total, 0.0::DOUBLE), 4) AS total FROM (SELECT DISTINCT id FROM w) d LEFT JOIN "
    "(SELECT id, string_agg(word, ',' ORDER BY rank) AS words, sum(weight) AS total FROM tfidf GROUP BY id) t USING (id)",
    "w",
    "tfidf",
)
_check("a6_corpus_tfidf", "SELECT word, tf, df, round(tf * ln(CAST(n + 1 AS DOUBLE) / (df + 1)), 6) AS tfidf FROM df, n", "df", "n")
_check("a7_textrank_total", f"SELECT word, round(ln(trval), {TR_DIGITS}) AS trval FROM trsum", "trsum")
_by_weight = "row_number() OVER (PARTITION BY class_id ORDER BY round(weight, 6) DESC, word)"
_check(
    "a8_cluster_words",
    f"SELECT *, {_by_weight} AS rank FROM (SELECT class_id, word, count(*) AS weight FROM m1_mem JOIN tok ON lpad(tok.id, 9, '0') = member GROUP BY class_id, word)",
    "m1_mem",
    "tok",
)
_check(
    "a8_cluster_words_rules",
    f"SELECT *, {_by_weight} AS rank FROM (SELECT class_id, word, count(*) AS weight FROM m2_mem JOIN tok ON lpad(tok.id, 9, '0') = member WHERE size > 2 AND length(word) % 7 <> 0 GROUP BY class_id, word)",
    "m2_mem",
    "tok",
)
_check(
    "a8_cluster_words_weighted",
    f"SELECT class_id, word, round(weight, 4) AS weight, {_by_weight} AS rank FROM (SELECT class_id, word, sum(weight) AS weight FROM m1_mem JOIN tfidf ON lpad(tfidf.id, 9, '0') = member GROUP BY class_id, word)",
    "m1_mem",
    "tfidf",
)
_check("a9_word2label", "SELECT *, row_number() OVER (PARTITION BY word ORDER BY cnt DESC, label) AS rank FROM (SELECT word, lang AS label, count(*) AS cnt FROM tok GROUP BY word, lang)", "tok")
_check("a10_label_scores", "SELECT imei, turn, label, n FROM score", "score")
_check("a11_top_label", "SELECT name AS label, count(*) AS imei_count FROM class5 GROUP BY name", "class5")
_check(
    "a12_tag_rollup",
    "SELECT tag, count(*) AS cnt FROM (SELECT unnest([split_part(taglayer, '-', 1), split_part(taglayer, '-', 1) || '-' || split_part(taglayer, '-', 2), taglayer]) AS tag FROM tag5) GROUP BY tag",
    "tag5",
)
_check(
    "a13_word_classes",
    "SELECT word, string_agg(CAST(p_size AS VARCHAR), ',' ORDER BY p_size) AS class_ids FROM (SELECT DISTINCT word, p_size FROM part_word) GROUP BY word",
    "part_word",
)
_check(
    "a14_vec_sum",
    "SELECT label, CAST(i AS INTEGER) AS i, round(sum(x), 4) AS s, round(sum(x * (vec_id % 7 + 0.5::DOUBLE)), 4) AS ws FROM "
    "(SELECT label, vec_id, unnest(CAST(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings) GROUP BY label, i",
)
_check("a15_distinct_words", "SELECT DISTINCT word FROM tok", "tok")
_check("a16_vocabulary", "SELECT word, freq AS cnt, row_number() OVER (ORDER BY freq DESC, word) - 1 AS index FROM lex WHERE freq >= 5", "lex")
_check("a17_dedupe_map", "SELECT word, min(p_partkey) AS p_partkey FROM part_word GROUP BY word", "part_word")

# ---------------------------------------------------------------- vectors
_check(
    "v1_vec_dot",
    f"SELECT vec_id, round({DOT}(a, b), 6) AS dense, round({DOT}(list_transform(a, lambda x: greatest(x, 0.0::DOUBLE)), b), 6) AS sparse FROM pair",
    "pair",
)
_check("v2_vec_norm", f"SELECT vec_id, round(3.0::DOUBLE * sqrt({DOT}(a, a)), 6) AS norm FROM pair", "pair")
_check(
    "v3_vec_scale",
    "SELECT vec_id, CAST(i AS INTEGER) AS i, round(x * (vec_id + 0.5::DOUBLE), 5) AS s, round(x / n, 6) AS u FROM "
    f"(SELECT vec_id, unnest(a) AS x, generate_subscripts(a, 1) - 1 AS i, sqrt({DOT}(a, a)) AS n FROM pair)",
    "pair",
)
_check(
    "v4_vec_add",
    "SELECT vec_id, CAST(i AS INTEGER) AS i, round(x + y, 6) AS s, round(2.0::DOUBLE * x + y, 6) AS y FROM "
    "(SELECT vec_id, unnest(a) AS x, unnest(b) AS y, generate_subscripts(a, 1) - 1 AS i FROM pair)",
    "pair",
)
_check("v5_cosine", f"SELECT vec_id, round({DOT}(a, b) / sqrt({DOT}(a, a) * {DOT}(b, b)), 6) AS cos, NULL::DOUBLE AS none FROM pair", "pair")
CTE["doc_dim"] = (["tok", "wv"], "SELECT id, word, pos, unnest(vec) AS x, generate_subscripts(vec, 1) AS i FROM tok JOIN wv USING (word)")
CTE["top_dim"] = (["doc_dim", "top_word"], "SELECT * FROM doc_dim WHERE word IN (SELECT word FROM top_word)")
CTE["w_dim"] = (["tfidf", "wv"], "SELECT id, word, weight, unnest(vec) AS x, generate_subscripts(vec, 1) AS i FROM tfidf JOIN wv USING (word)")


def _vectors(dim: str, weight: str = "x") -> str:
    return (
        f"(SELECT id, max(s) FILTER (i = 1) AS x0, max(s) FILTER (i = (SELECT max(len(vec)) FROM pt)) AS x_last, sqrt(sum(s * s)) AS norm FROM "
        f"(SELECT id, i, sum({weight}) AS s FROM {dim} GROUP BY id, i) GROUP BY id)"
    )


_listed = "(SELECT id, string_agg(word, ',' ORDER BY pos) AS words, count(*) AS n FROM {} WHERE i = 1 GROUP BY id)"
_check(
    "v6_doc_vectors_unit",
    f"SELECT id, words, round(x0 / norm, 4) AS x0, round(x_last / norm, 4) AS x_last FROM {_vectors('top_dim')} JOIN {_listed.format('top_dim')} USING (id) WHERE n > 3",
    "top_dim",
    "pt",
)
_check(
    "v7_doc_vectors_sum",
    f"SELECT id, words, round(x0, 4) AS x0, round(x_last, 4) AS x_last, round(norm, 4) AS norm FROM {_vectors('doc_dim')} JOIN {_listed.format('doc_dim')} USING (id) WHERE n > 3",
    "doc_dim",
    "pt",
)
_check(
    "v8_doc_vectors_tfidf",
    "SELECT id, words, round(x0 / nullif(norm, 0), 5) AS x0, round(x_last / nullif(norm, 0), 5) AS x_last, round(ln(nullif(norm, 0)), 6) AS norm "
    "FROM (SELECT id, string_agg(word, ',' ORDER BY rank) AS words FROM tfidf GROUP BY id HAVING count(*) > 3) "
    f"LEFT JOIN {_vectors('w_dim', 'x * weight')} USING (id)",
    "w_dim",
    "pt",
)

# ---------------------------------------------------------------- graphs and clusters
_check("g1_cooccurrence_edges", "SELECT id, word, string_agg(neighbour, ',' ORDER BY neighbour) AS neighbours FROM edge GROUP BY id, word", "edge")
_check("g2_textrank", f"SELECT id, word, round(ln(s), {TR_DIGITS}) AS score FROM tr", "tr")
CTE["degree"] = (["link"], "SELECT a AS k, count(*) FILTER (f > 0) AS d FROM link GROUP BY a")
CTE["dlink"] = (["link", "degree"], "SELECT a, b, f / greatest(d, 1) AS f FROM link JOIN degree ON k = b")
CTE["diter"] = (["dlink", "node"], CTE["iter"][1].replace("iter i", "diter i").replace("JOIN link", "JOIN dlink"))
RECURSIVE["diter"] = "diter(k, it, s)"
_check("g2_textrank_degree", "SELECT id, word, round(s, 6) AS score FROM diter JOIN node USING (k) WHERE it = 20", "diter")
_check(
    "g3_textrank_by_doc",
    "SELECT doc.id, length(msg) AS n_chars, coalesce(ranked, '') AS ranked FROM doc LEFT JOIN (SELECT id, string_agg(word, ',' ORDER BY rank) AS ranked FROM tr GROUP BY id) r USING (id)",
    "doc",
    "tr",
)
_check("g4_best_partner_max", "SELECT id, partner, round(sim, 6) AS sim FROM m0_best", "m0_best")
_check("g5_best_partner_first", "SELECT id, partner, round(sim, 5) AS sim FROM u0_best", "u0_best")
_check("g6_greedy_matching", "SELECT id, partner FROM m0_kept", "m0_kept")
_check("g7_merge_pairs", "SELECT id, size, round(norm, 5) AS norm, round(vec[1], 5) AS x0 FROM m1", "m1")
_check("g7_merge_pairs_unit", "SELECT id, size, round(norm, 5) AS norm, round(vec[1], 6) AS x0 FROM u1", "u1")
_check("g8_subject_clusters", "SELECT id, size, round(norm, 5) AS norm, round(vec[1], 5) AS x0 FROM m2", "m2")
_check("g8_cluster_members", "SELECT id AS cid, unnest(string_split(ids, '|')) AS member, generate_subscripts(string_split(ids, '|'), 1) AS rank FROM m2", "m2")
_check("g9_assign_class_id", "SELECT id, class_id, size FROM m1_class", "m1_class")

# ---------------------------------------------------------------- embeddings and term vectors
_check(
    "m3_word_vector",
    "SELECT id AS word, CAST(i AS INTEGER) AS i, round(x, 6) AS x FROM (SELECT id, unnest(vec) AS x, generate_subscripts(vec, 1) - 1 AS i FROM pt WHERE id = (SELECT min(id) FROM pt))",
    "pt",
)
_similar = f"SELECT a.id AS word, round({DOT}(a.vec, q.vec) / sqrt({DOT}(a.vec, a.vec)), 6) AS similarity FROM pt a, pt q WHERE q.id = {{}} {{}} ORDER BY {DOT}(a.vec, q.vec) / sqrt({DOT}(a.vec, a.vec)) DESC, a.id LIMIT {{}}"
_check("m4_find_synonyms", _similar.format("'000000007'", "AND a.id <> q.id", 20), "pt")
_check(
    "m5_term_vectors",
    "SELECT id, word, index, tf, num AS num_features FROM tf JOIN "
    "(SELECT word, row_number() OVER (ORDER BY freq DESC, word) - 1 AS index, count(*) OVER () AS num FROM lex) USING (word)",
    "tf",
    "lex",
)

# ---------------------------------------------------------------- ranks and limits
_check("l1_top_k", f"SELECT * FROM df ORDER BY tf DESC, word LIMIT {TOP_WORDS}", "df")
_check("l2_top_labels", "SELECT imei, turn, label || '|' || n AS label, CAST(rank AS INTEGER) AS rank FROM best5", "best5")
_check("l3_top_label_names", "SELECT imei, turn, string_agg(label, ',' ORDER BY rank) AS labels FROM best5 GROUP BY imei, turn", "best5")
_ranked = "(SELECT *, CAST(row_number() OVER (PARTITION BY id ORDER BY tf DESC, word) AS INTEGER) AS rank, count(*) OVER (PARTITION BY id) AS n_words FROM tf)"
_check("l4_rank_drop_last", f"SELECT id, word, tf, rank FROM {_ranked} WHERE rank < n_words", "tf")
_check("l5_rank_tail", f"SELECT id, word, tf, rank, n_words FROM {_ranked} WHERE rank > floor(n_words * 0.8::DOUBLE)", "tf")
_check("l6_sample_limit", "SELECT imei, key_word, turn FROM log ORDER BY imei, turn LIMIT 100", "log")
_check("l7_similar_top_k", _similar.format("'000000003'", "", 10), "pt")
_check("l8_rank_words", "SELECT id, word, tf, row_number() OVER (PARTITION BY id ORDER BY tf DESC, word) AS rank FROM tf", "tf")

# ---------------------------------------------------------------- composed operators


def _matched(words: str, top: str, label: str, needs: list[str], name: str = "labels", extra: str = "", log: str = "log", terms: str = "lt") -> str:
    picked = f"(SELECT imei, turn, string_agg(word, ',' ORDER BY pos) AS words FROM {terms} WHERE word IN ({words}) GROUP BY ALL)"
    best = f"(SELECT imei, turn, string_agg({label}, ',' ORDER BY rank) AS {name}{extra} FROM {top} GROUP BY ALL)"
    more = ", coalesce(class_names, '') AS class_names" if extra else ""
    body = f"SELECT imei, turn, coalesce(w.words, '') AS words, coalesce({name}, '') AS {name}{more} FROM {log} LEFT JOIN {picked} w USING (imei, turn) LEFT JOIN {best} USING (imei, turn)"
    return _with(needs, body)


CTE["few"] = (["lp", "lex"], "SELECT word FROM lp JOIN lex USING (word) WHERE nature LIKE 'n%' GROUP BY word HAVING count(*) < 20")
CTE["few5"] = (
    ["lt", "lp", "few"],
    "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY imei, turn ORDER BY n DESC, label) AS rank FROM "
    "(SELECT imei, turn, label, count(*) AS n FROM lt JOIN few USING (word) JOIN lp USING (word) GROUP BY ALL)) WHERE rank <= 5",
)
SQL["c1_match_labels"] = _matched("SELECT word FROM few", "few5", "label || '|' || n", ["log", "lt", "few", "few5"])
SQL["c1_match_labels_han"] = _matched("SELECT word FROM han_few", "han5", "label || '|' || n", ["log2", "hl_tok", "han_few", "han5"], log="log2", terms="hl_tok")
SQL["c1_match_labels_han_joined"] = SQL["c1_match_labels_han"]
SQL["c2_match_tags"] = _matched("SELECT word FROM lex WHERE nature LIKE 'n%'", "tag5", "taglayer", ["log", "lt", "lex", "tag5"])
SQL["c3_match_classes"] = _matched(
    "SELECT word FROM cd", "class5", "CAST(s_id AS VARCHAR)", ["log", "lt", "cd", "class5"], "class_ids", ", string_agg(name, ',' ORDER BY rank) AS class_names"
)
_other = f"word NOT IN {_in(PLACE_SUFFIXES + OTHER_STOP_WORDS)} AND word NOT IN (SELECT word FROM stop)"
_check(
    "c4_segment_corpus",
    "SELECT doc.id, coalesce(w, '') AS words FROM doc LEFT JOIN (SELECT id, string_agg(word, ',' ORDER BY pos) AS w FROM tag "
    f"WHERE nature LIKE 'n%' AND {_affix} AND {_other} GROUP BY id) k USING (id)",
    "doc",
    "tag",
    "stop",
)
_check("c4_segment_corpus_natures", f"SELECT word, nature, cnt FROM wn WHERE nature IN ('n', 'nx') AND {_other}", "wn", "stop")
_check(
    "c5_filter_segments",
    "SELECT doc.id, coalesce(w, '') AS words FROM doc LEFT JOIN (SELECT id, string_agg(word, ',' ORDER BY pos) AS w FROM tok JOIN lex USING (word) "
    "WHERE freq >= 3 AND length(word) % 7 <> 0 GROUP BY id) k USING (id)",
    "doc",
    "tok",
    "lex",
)
