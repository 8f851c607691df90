"""Operators on small tables with nulls, ties, repeated rows, clashing columns and no rows, against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from test_units import plain_counts, plain_hits

from topicloom.llm import decontaminate, quality_model, secrets, stages
from topicloom.llm.components import components
from topicloom.llm.html_text import extract_text
from topicloom.llm.mixing import mix_sources
from topicloom.llm.ngram_join import ngram_join
from topicloom.llm.quality_rules import quality_rules
from topicloom.llm.substring_dedup import dedup_substrings
from topicloom.llm.url_filter import filter_urls
from topicloom.llm.warc import archive_round_trip, read_warc, write_warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, n_words long, _text string, component string"
WORDS = ["alpha", "Beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa", "lambda", "mu", "ünïcode", "xi"]


def table(spark, texts, sources=None):
    rows = [(i, t, None, (sources or ["a"])[i % len(sources or ["a"])], None, 7, 8, "clash", None) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, *rows[:2]], DOCS)  # the first two rows stand twice


def prose(draw, n):
    return " ".join(draw.choices(WORDS, k=n))


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(2)
    base = [prose(draw, 60) for _ in range(6)]
    near = []
    for i in range(40):
        words = base[i % 3].split()
        for _ in range(draw.randint(0, 3)):
            words[draw.randrange(len(words))] = draw.choice(WORDS)
        near.append(" ".join(words))
    long = prose(draw, 3_000)
    passage = prose(draw, 55)
    shared = [f"{prose(draw, draw.randint(0, 30))} {passage} {prose(draw, draw.randint(0, 30))}" for _ in range(6)]
    return [None, "", "  \n ", "one two", "One TWO", *base, *near, long, long.upper(), long + " tail", "spam " * 400, "ab" * 300, *shared, "é" * 150]


def shingles(text):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {b" ".join(w)} if w else set()


def plain_components(texts):
    sets = [shingles(t) for t in texts]
    parent = list(range(len(sets)))

    def find(i):
        return i if parent[i] == i else find(parent[i])

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in enumerate(sets)}


def test_ngram_join(spark, texts):
    rows = ngram_join(table(spark, texts)).collect()
    expected = plain_components(texts)
    assert Counter(tuple(r) for r in rows) == Counter((i, *expected[i]) for i in [*range(len(texts)), 0, 1])
    assert len({c for _, c in expected.values()}) < len(texts) - 20


def test_ngram_join_of_repeated_and_missing_ids(spark):
    draw = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    a, b, c, d = (draw.sample(words, 60) for _ in range(4))
    near = [" ".join(d[i : i + 50]) for i in (0, 5, 10)]  # the first and last link by the middle one only
    text = lambda w, change="": " ".join([*w[:-1], change or w[-1]])
    rows = [
        (5, text(a)), (5, text(b)), (5, text(c)), (5, text(c)),
        (6, text(a, "x")), (7, text(b, "x")), (8, text(c, "x")),
        (20, near[0]), (None, near[1]), (None, near[1]), (21, near[2]), (None, "none of them"), (30, ""), (30, "other words"),
    ]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    found = Counter((r[0], r[2]) for r in ngram_join(docs).collect())
    assert found == Counter([*[(5, 5)] * 4, (6, 5), (7, 5), (8, 5), (20, 20), (None, 20), (None, 20), (21, 20), (None, None), (30, 30), (30, 30)])
    kept = Counter((r[0], r[1]) for r in stages.distinct_texts(spark, docs, "").collect())
    assert kept == Counter([*[rows[i] for i in (0, 1, 2, 7, 8, 9, 11, 12, 13)]])


def test_ngram_join_finds_links_across_kept_lists(spark, texts, monkeypatch):
    """Short runs and blocks: most lists are kept, and pairs between components are searched."""
    from topicloom.llm import ngram_join as module

    for name, value in (("RUN", 3), ("NEAREST", 1), ("BLOCK", 4), ("ORDERS", 1), ("PARTNERS", 2), ("FLUSH", 200)):
        monkeypatch.setattr(module, name, value)
    rows = ngram_join(table(spark, texts)).collect()
    expected = plain_components(texts)
    assert {(r[0], r[1], r[2]) for r in rows} == {(i, *x) for i, x in expected.items()}


def test_components(spark):
    links = [(3, 9), (9, 12), (12, 3), (5, 6), (6, 5), (7, 7), (1, 2), *((100 + i, 101 + i) for i in range(60)), *((500, 501 + i) for i in range(40))]
    found = {r[0]: r[1] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found[12] == found[9] == 3 and found[6] == 5 and found[2] == 1 and found[160] == 100 and found[540] == 500 and 7 not in found
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_dedup(texts, length=200):
    bodies = [(t or "").encode() for t in texts]
    seen = Counter(b[p : p + length] for b in bodies for p in range(len(b) - length + 1))
    out = []
    for b in bodies:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(c for c, x in zip(b, gone, strict=True) if not x)
        out.append((len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [20_000, 1])
def test_substring_dedup(spark, texts, hot):
    every = [*texts, *texts[:2]]
    rows = dedup_substrings(table(spark, texts), hot=hot).collect()
    expected = plain_dedup(every)
    assert Counter(tuple(r) for r in rows) == Counter((i, *expected[i]) for i in [*range(len(texts)), 0, 1])
    assert sum(e[1] > 0 for e in expected) > 20


def test_quality_rules(spark, texts):
    rows = quality_rules(table(spark, texts)).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        n_words, _, _, _, repeated = expected = plain_counts(texts[r["doc_id"]])
        assert tuple(r[1:6]) == expected
        assert r["base_failed"] == (n_words < 50 or 100 * repeated > 50 * n_words)
        assert not (r["base_failed"] and r["kept"])


@pytest.mark.parametrize("pattern_words", [1_000_000, 8])
def test_decontaminate(spark, texts, pattern_words):
    items = [texts[5][20:150], texts[7].upper(), "nothing here", None, "", "xi", "- -"]
    benchmark = spark.createDataFrame([(i, t) for i, t in enumerate(items)] + [(5, "xi"), (None, "alpha")], "item_id long, text string")
    rows = decontaminate.decontaminate(table(spark, texts), benchmark, pattern_words=pattern_words)
    rows = rows.select("doc_id", "n_words", decontaminate.hit_words("hits"), "items").collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        n_words, hit, found = plain_hits(texts[r[0]], items)
        assert (r[1], r[2], r[3]) == (n_words, hit, sorted(map(str, found)))


def test_secrets(spark):
    key = "AKIA" + "B2C3D4E5F6G7H8"
    texts = [
        None,
        "",
        "no secret here, only words_joined_by_signs_and_more",
        "é password = 'abcd1234', token:short api_key=\"A+/=_.-xyz\" PASSWD:ABCDEFGH",
        f"{key} AKIA {key.lower()} token=token: abcdefgh",
        "hex 0123456789abcdef0123456789abcdef and 0123456789abcdef",
        "entropy q8Zt4LmX0vB7nRk2YpW5 again q8Zt4LmX0vB7nRk2YpW5",
        "uuid 123e4567-e89b-12d3-a456-426614174000 date 2024-01-01-2024-01-01-22 path/of/some/words2/here3",
        "secret=" + "x" * 3_000 + "1",
    ]
    rows = secrets.scan(table(spark, texts)).collect()
    assert len(rows) == len(texts) + 2 and rows[0]["_text"] == "clash"
    patterns = ((secrets.ASSIGN, "assign", 2, 8), (secrets.ACCESS, "access", 0, 16), (secrets.HEX, "hex", 0, 32))
    for r in rows:
        text = texts[r["doc_id"]] or ""
        base = sorted((m.start(), i, kind, m.end()) for i, (p, kind, g, least) in enumerate(patterns) for m in re.finditer(p, text) if len(m[g]) >= least)
        assert [tuple(s) for s in r["secrets"] if s["rank"] < 3] == base
        others = [text[s["start"] : s["end"]] for s in r["secrets"] if s["rank"] == 3]
        assert others == (["q8Zt4LmX0vB7nRk2YpW5"] * 2 if r["doc_id"] == 6 else [])
    cleaned = {r["doc_id"]: r for r in stages.without_secrets(spark, table(spark, texts), "").collect()}
    assert cleaned[6]["text"] == "entropy [secret] again [secret]" and cleaned[6]["n_chars"] == 31
    assert cleaned[2]["text"] == texts[2] and cleaned[2]["n_chars"] is None and cleaned[0]["text"] is None


def test_secrets_beside_base_spans(spark):
    random40 = "q8Zt4LmX0vB7nRk2YpW5d3Hs9JcF6gTxKe1QaUoI"
    access = "AKIA" + "B2C3D4E5F6G7H8"
    wrong = "0123456789abcdef" * 2
    texts = [
        f"é https://h/{random40}/token=abcd1234 end",
        f"{access}/{random40}",
        f"{random40}/{access}/{random40}",
        f"{wrong}_{random40} and my_long_prefix_of_token=abcd1234",
        f"token={random40} {random40[:19]}/token=abcd1234",
    ]
    rows = {r["doc_id"]: r for r in secrets.scan(table(spark, texts)).collect()}
    found = [[(s["kind"], texts[i][s["start"] : s["end"]]) for s in rows[i]["secrets"]] for i in range(len(texts))]
    assert found == [
        [("entropy", f"//h/{random40}/"), ("assign", "token=abcd1234")],
        [("access", access), ("entropy", f"/{random40}")],
        [("entropy", f"{random40}/"), ("access", access), ("entropy", f"/{random40}")],
        [("hex", wrong), ("entropy", f"_{random40}"), ("assign", "token=abcd1234")],
        [("assign", f"token={random40}"), ("entropy", f"{random40[:19]}/"), ("assign", "token=abcd1234")],
    ]
    cleaned = {r["doc_id"]: r["text"] for r in stages.without_secrets(spark, table(spark, texts), "").collect()}
    assert not any(random40[:19] in t for t in cleaned.values()) and cleaned[0] == "é https:[secret][secret] end"


def test_window_weight(spark):
    draw = random.Random(4)
    tokens = ["".join(draw.choices("ab1", k=20)), *("".join(draw.choices("abcdefgh0123456789XYZ+/=_-", k=draw.randint(20, 60))) for _ in range(30))]
    rows = spark.createDataFrame([(t,) for t in tokens], "t string").select("t", secrets.window_weight(F.col("t"))).collect()
    for t, weight in rows:
        sums = [sum(secrets.COUNT_WEIGHTS[n] for n in Counter(t[i : i + 20]).values()) for i in range(len(t) - 19)]
        assert weight == min(sums)


def test_mixing(spark, texts):
    sources = ["b", "a", None, "Z", "é"]
    docs = table(spark, texts, sources)
    rows = mix_sources(docs).collect()
    assert len(rows) == len(texts) + 2
    size = Counter()
    for r in rows:
        n = len((texts[r["doc_id"]] or "").encode().split())
        assert r["size"] == n and 0 <= r["taken"] <= 3 * n
        size[sources[r["doc_id"] % 5]] += n
    taken, target = Counter(), {}
    for r in rows:
        s = sources[r["doc_id"] % 5]
        taken[s] += r["taken"]
        target[s] = r["target"]
        assert r["source_size"] == size[s]
    assert sum(target.values()) == pytest.approx(sum(size.values()))
    for s, t in target.items():
        assert abs(taken[s] - t) <= 0.1 * t + 3 * 64
    again = mix_sources(docs.repartition(7)).collect()
    key = lambda r: (r["doc_id"], r["taken"])
    assert sorted(map(key, rows)) == sorted(map(key, again))
    assert mix_sources(docs.where("false")).count() == 0


def plain_split(url):
    rest = (url or "").split("://", 1)[1] if "://" in (url or "") else ""
    m = re.match(r"([^/?#]*)([^?#]*)", rest)
    return re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]


def test_urls(spark):
    hosts = ["x.example.org", "EXAMPLE.org", "org", "example.com", "a.example.net", "xexample.org"]
    urls = [f"http://{h}/{p}/{i}?q#f" for i in range(12) for h in hosts for p in ("en", "de", "fr", "es")]
    urls += [None, "", "no scheme", "http://", "https://host.net", "ftp://org?x/", "http://example.org/en/1", "a://b://c/d\n#"]
    rows = filter_urls(spark.createDataFrame([(i, u, "x") for i, u in enumerate([*urls, *urls[:3]])], "page_id long, url string, verdict string")).collect()
    assert len(rows) == len(urls) + 3
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
    for r in rows:
        host, path = plain_split([*urls, *urls[:3]][r["page_id"]])
        assert (r["host"], r["path"]) == (host, path)
        fits = [x for x in rules if (host == x[0] or host.endswith("." + x[0])) and path.startswith(x[1])]
        best = max(fits, key=lambda x: len(x[0] + x[1]), default=None)
        assert r["rule"] == (best and best[0] + best[1])
        assert r["verdict"] == best[2] if best else r["verdict"] in ("allow", "block")
    assert {r["verdict"] for r in rows if r["rule"] is None and r["host"].endswith(".net") and "/de/" in r["path"]} == {"block"}
    empty = spark.createDataFrame([], "page_id long, url string")
    assert filter_urls(empty).count() == 0


def test_warc(spark, tmp_path):
    long = "<p>page</p>" * 20
    pages = [(3, "http://a", long), (1, None, long), (2, "u", None), (5, "u", ""), (7, "x", "short"), (8, "x", "short"), (9, "é", "é" * 60), (10, "é", "é" * 60), (None, "n", long), (1, None, long)]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, digest string")
    files = write_warc(df, f"file://{tmp_path}/w", archive_bytes=600)
    assert files.count() > 1
    rows = read_warc(spark, files).collect()
    first = {hashlib.sha256(h.encode()).hexdigest(): min(i for i, _, x in pages if x == h and i is not None) for h in (long, "é" * 60)}
    expected = Counter()
    for i, _, html in pages:
        body = (html or "").encode()
        digest = hashlib.sha256(body).hexdigest()
        to = first.get(digest) if len(body) >= 100 and i != first.get(digest) else None
        expected[i, len(body), digest, "revisit" if to else "response", to, None if to else body] += 1
    assert Counter((r[0], r[1], r[2], r[3], r[4], None if r[6] is None else bytes(r[6])) for r in rows) == expected
    assert archive_round_trip(df.where("false")).count() == 0


def test_html(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a  b</p>", 5), (2, None, None, 5), (1, "u", "<p>a  b</p>", 5)], "page_id long, url string, html string, n_chars int")
    rows = sorted(tuple(r) for r in extract_text(pages).fillna("", "url").collect())
    assert rows == [(1, "u", "a b", 3), (1, "u", "a b", 3), (2, "", "", 0)]
    assert extract_text(pages.where("false")).count() == 0


def test_quality_model(spark):
    draw = random.Random(9)
    texts = [prose(draw, 80) if i % 3 else " ".join(w + "###" for w in prose(draw, 80).split()) for i in range(240)] + [None, ""]
    docs = table(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(240)] + [(5, 0), (5, 1), (7, None), (None, 1)], "doc_id long, quality int")
    forest = quality_model.fit(docs, labels)
    rows = quality_model.score(docs, forest).collect()
    assert len(rows) == len(texts) + 2
    import zlib

    right = defaultdict(list)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        if r["doc_id"] < 240:
            right[r["held_out"]].append(r["predicted"] == int(r["doc_id"] % 3 > 0))
    assert sum(right[True]) / len(right[True]) > 0.95
    empty = quality_model.fit(docs.where("false"), labels.where("false"))
    assert quality_model.score(docs.where("false"), empty).count() == 0


def test_empty_tables(spark, texts):
    none = table(spark, texts).where("false")
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert ngram_join(none).count() == dedup_substrings(none).count() == quality_rules(none).count() == 0
    assert decontaminate.decontaminate(none, benchmark).count() == secrets.scan(none).count() == 0
    assert {r["items"] == [] for r in decontaminate.decontaminate(table(spark, texts), benchmark).collect()} == {True}


def test_components_rounds_stay_within_links_and_nodes(spark):
    draw = random.Random(11)
    hub = [(0, i) for i in range(1, 3000)]
    chain = [(5000 + i, 5001 + i) for i in range(2000)]
    loose = [(draw.randrange(10_000, 15_000), draw.randrange(10_000, 15_000)) for _ in range(6000)]
    links = hub + chain + loose + [(b, a) for a, b in hub[:500]]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
    nodes = {n for link in links for n in link}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        trace = []
        df = spark.createDataFrame(links, "a long, b long").repartition(200)
        found = {r.node: r.component for r in components(df, trace=trace).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found == {n: find(n) for n in nodes if any(find(m) == find(n) for m in nodes if m != n)} | {n: find(n) for n in nodes if find(n) != n}
    assert max(trace) <= len(links) + len(nodes)


def test_components_write_links_once_and_settle_few_without_a_shuffle(spark, monkeypatch):
    from topicloom.llm import components as module

    links = [(i, i + 1) for i in range(0, 4000) if i % 50] + [(i, 10_000) for i in range(7000, 7300)]
    seen = []
    real = module.cut_lineage
    monkeypatch.setattr(module, "cut_lineage", lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString()) or real(df))
    df = spark.createDataFrame(links, "a long, b long").repartition(20)
    found = {r.node: r.component for r in components(df).collect()}
    assert len(seen) == 2 and "Exchange" not in seen[1]
    assert found == {i: -(-i // 50) * 50 - 49 if i % 50 == 0 and i else i // 50 * 50 + 1 for i in range(1, 4001)} | dict.fromkeys([*range(7000, 7300), 10_000], 7000)
    monkeypatch.setattr(module, "LINKS", 100)  # several tasks and rounds, then one
    assert {r.node: r.component for r in components(df).collect()} == found


def test_ngram_join_bounds_what_a_task_gathers(spark, texts, monkeypatch):
    """Few postings and names are held at a time, and the sets are those of larger pieces."""
    from topicloom.llm import ngram_join as module

    assert module.FLUSH * module.POSTING.itemsize <= 8 << 20 and module.TEXT < 1 << 20
    expected = plain_components(texts)
    for name, value in (("FLUSH", 50), ("SEEN", 2), ("TEXT", 64), ("CELLS", 3)):
        monkeypatch.setattr(module, name, value)
    assert {tuple(r) for r in module.ngram_join(table(spark, texts)).collect()} == {(i, *x) for i, x in expected.items()}
