"""Chat formatting, source divergence and embedding whitening on small tables, against plain versions."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from topicloom.llm import chat, checks, divergence, whitening

CONV = "conv_id long, turn long, role string, text string, extra string"


def plain_chat(rows):
    convs = {}
    for conv, turn, role, text, *_ in rows:
        convs.setdefault(conv, []).append((turn, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns.sort(key=lambda t: (t[0] is None, t[0] or 0, t[1].encode(), t[2].encode()))
        joined = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(joined.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_chat_round_trip(spark, tmp_path):
    tricky = ["", None, "<|end|>\n<|turn|>assistant<|body|>x", "\\", "\\l", "\\\\<|", "a\\<|b", "### Assistant: </turn> ok", "ünï 🙂", "x" * 20_000]
    rows = []
    for conv in range(4):
        for turn in range(6):
            rows.append((conv, turn, ["user", "assistant", None][turn % 3], tricky[(conv * 6 + turn) % len(tricky)], "clash"))
    rows += [(None, 0, "assistant", "null conversation", None), (9, None, "user", "late", None), (9, 0, "user", "tie", None), (9, 0, "user", "tie", None)]
    df = spark.createDataFrame(rows, CONV)
    got = {r.conv_id: r for r in chat.format_chats(spark, chat.turn_events(df), str(tmp_path / "out")).collect()}
    expected = plain_chat(rows)
    assert set(got) == set(expected)
    for conv, (n, turns, loss_chars, loss) in expected.items():
        r = got[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (n, turns, loss_chars, loss)
        assert r.formatted_chars > 0


def test_chat_events_fold(spark, tmp_path):
    events = spark.createDataFrame(
        [
            (1, 1, 1, "message", "user", "hello"),
            (1, 2, 2, "delta", "assistant", "Hi"),
            (1, 3, 2, "delta", None, " there"),
            (1, 4, 3, "message", "user", "again"),
            (1, 5, 1, "edit", None, "hello, edited"),
            (1, 6, 2, "regenerate", "assistant", "Regenerated"),
            (1, 7, 2, "delta", None, "!"),
            (1, 8, 4, "message", "user", "after"),
            (2, 1, 1, "delta", "assistant", None),
        ],
        "conv_id long, seq long, msg_id long, kind string, role string, text string",
    )
    messages = {(r.conv_id, r.msg_id): (r.role, r.text) for r in chat.reconstruct(events).collect()}
    # message 3 existed before the regeneration of message 2 and goes; message 4 came later and stays
    assert messages == {(1, 1): ("user", "hello, edited"), (1, 2): ("assistant", "Regenerated!"), (1, 4): ("user", "after"), (2, 1): ("assistant", "")}
    rendered = chat.render(chat.reconstruct(events)).where("conv_id = 1").first()
    spans = [rendered.formatted[s.start : s.end] for s in rendered.loss_mask]
    assert spans == ["Regenerated!"]


def test_chat_empty(spark, tmp_path):
    empty = spark.createDataFrame([], CONV)
    assert chat.format_chats(spark, chat.turn_events(empty), str(tmp_path / "e")).count() == 0


def duck(spark_rows, schema_sql, sql):
    con = duckdb.connect()
    con.sql(f"CREATE TABLE documents ({schema_sql})")
    if spark_rows:
        con.executemany(f"INSERT INTO documents VALUES ({', '.join('?' * len(spark_rows[0]))})", spark_rows)
    return sorted(tuple(r) for r in con.sql(sql).fetchall())


DOCS = "doc_id long, text string, lang string, source string, extra long"
DOCS_SQL = "doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, extra BIGINT"


def test_divergence_against_sql(spark):
    draw = random.Random(4)
    words = ["alpha", "Beta", "GAMMA", "delta", "éclair", "Ωmega", "x1y", "zeta", "eta"]
    rows = []
    for i in range(400):
        text = " ".join(draw.choices(words[: draw.randint(2, 9)], k=draw.randint(0, 40))) if i % 17 else None
        lang = [None, "en", "fr", "solo"][i % 4]
        source = ["a", "b", None, "c"][draw.randrange(4)] if lang != "solo" else "only"
        rows.append((i, text, lang, source, 7))
    rows += rows[:50]  # repeated rows count again
    got = divergence.audit(spark.createDataFrame(rows, DOCS).withColumnRenamed("extra", "count"), min_docs=30, top=3).collect()
    expected = duck(rows, DOCS_SQL, checks.divergence_sql().replace(f"<= {divergence.TOP_TERMS}", "<= 3"))
    assert sorted(tuple(r) for r in got) == expected
    assert {r.part for r in got} == {"pair", "term"}
    assert not [r for r in got if r.lang == "solo" and r.part == "pair"]


def test_divergence_without_kept_terms_and_empty(spark):
    rows = [(1, "rare words", "en", "a", 0), (2, None, "en", "b", 0), (3, "", None, None, 0)]
    got = sorted(tuple(r) for r in divergence.audit(spark.createDataFrame(rows, DOCS)).collect())
    assert got == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    assert divergence.audit(spark.createDataFrame([], DOCS)).count() == 0


EMB = "vec_id long, embedding array<float>, component string, n double"


def plain_whitening(vectors):
    x = np.array([[math.floor(64 * float(np.float32(c))) + whitening.OFFSET for c in v] for v in vectors], dtype=np.float64)
    fit = np.unique(x, axis=0)
    mean = fit.mean(axis=0)
    cov = (fit - mean).T @ (fit - mean) / len(fit)
    values, vecs = np.linalg.eigh(cov)
    return x, fit, mean, values[::-1], vecs[:, ::-1]


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(0, 0.3, (120, 12)) * np.linspace(2, 0.2, 12)
    vectors = [list(map(float, v)) for v in base] + [list(map(float, base[0]))] * 5
    rows = [(i, v, "clash", 1.0) for i, v in enumerate(vectors)]
    rows += [(900, None, None, None), (901, [1.0, None] + [0.0] * 10, None, None), (902, [float("nan")] * 12, None, None), (903, [float("inf")] + [0.0] * 11, None, None)]
    got = whitening.whiten(spark.createDataFrame(rows, EMB)).collect()
    x, fit, mean, values, vecs = plain_whitening(vectors)
    assert {r.vec_id for r in got} == set(range(len(vectors)))
    assert len(got) == len(vectors) * 12
    n = len(fit)
    sums = fit.sum(axis=0)
    for r in got:
        k = r.component - 1
        row = x[r.vec_id]
        assert r.n == n
        assert r.deviation == int(sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)))
        assert abs(r.explained - values[k] / values.sum()) <= 1e-4 * values[k] / values.sum()
        plain = (row - mean) @ vecs[:, k] / math.sqrt(values[k])
        assert abs(abs(r.whitened) - abs(plain)) < 1e-6
        assert r.identity_error <= 1e-4
    # one sign per component for all rows
    for k in range(12):
        signs = {np.sign(r.whitened) * np.sign((x[r.vec_id] - mean) @ vecs[:, k]) for r in got if r.component == k + 1 and abs(r.whitened) > 1e-6}
        assert len(signs) == 1


def test_whitening_rank_deficient_and_empty(spark):
    rows = [(1, [0.5, 0.5, 0.5], None, None), (2, [0.25, 0.25, 0.25], None, None), (3, [0.25, 0.25, 0.25], None, None)]
    got = whitening.whiten(spark.createDataFrame(rows, EMB)).collect()
    assert len(got) == 9
    first = [r for r in got if r.component == 1]
    assert all(r.whitened is not None and abs(abs(r.whitened) - 1) < 1e-9 for r in first)
    assert all(r.whitened is None and r.explained == 0 for r in got if r.component > 1)
    assert whitening.whiten(spark.createDataFrame([], EMB)).count() == 0


def test_charpoly_exact():
    m = [[4, 1, -2], [1, 2, 0], [-2, 0, 3]]
    # det(tI - M) = t^3 - 9 t^2 + 21 t - 13, by hand
    assert whitening.charpoly(m) == [-13, 21, -9, 1]
    values, vectors = whitening.components(m, 3)
    for lam, v in zip(values, vectors):
        assert np.allclose(np.array(m, float) @ v, float(lam) * v, atol=1e-9)


@pytest.mark.parametrize("text", ["", "\\", "<|", "\\l", "a\\\\l<|<|\\", "🙂<|\\"])
def test_escape_round_trip(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(chat.unescape(chat.escape(F.col("t")))).first()[0] == text
    assert "<|" not in df.select(chat.escape(F.col("t"))).first()[0]
