"""The pipeline and the registered queries on the small tables, against plain versions and SQL."""

import re
import zlib
from collections import Counter
from pathlib import Path

import pytest
from compare import DATA, connect
from test_operators import plain_components, plain_dedup
from test_units import plain_counts, plain_hits

import __spark_entry__ as entry_points
import corpus_pipeline
from topicloom.llm import catalog, checks, mixing, quality_rules, secrets

SF = f"{DATA}/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").orderBy("doc_id").collect()]


def test_every_operator_is_registered():
    names = set(entry_points.queries())
    assert {n.split("_")[0] for n in names if re.match(r"op\d+_", n)} == {f"op{i}" for i in range(1, 14)} and "pipeline" in names
    assert set(checks.SQL) <= set(catalog.QUERIES) <= names
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality rules" and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", list(checks.SQL))
def test_equals_sql(spark, name):
    ref = connect(SF).execute(checks.SQL[name])
    columns = [d[0] for d in ref.description]
    rows = catalog.QUERIES[name](spark, SF)
    assert sorted(rows.columns) == sorted(columns)
    assert Counter(tuple(r) for r in rows.select(*columns).collect()) == Counter(ref.fetchall())


def test_whole_table_results(spark, documents):
    texts = [t for _, t, _ in documents]
    expected = plain_dedup(texts)
    assert {tuple(r) for r in catalog.op7_substring_dedup(spark, SF).collect()} == {(d[0], *e) for d, e in zip(documents, expected, strict=True)}


def test_held_out_accuracy(spark):
    sf = f"{DATA}/sf0.01"
    found = {r.doc_id: r for r in catalog.op2_quality_classifier(spark, sf).collect()}
    quality = {r[0]: r[1] for r in spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality").collect()}
    held = [(found[i].predicted, q) for i, q in quality.items() if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(found) == 1_000 and sum(p == q for p, q in held) >= 0.95 * len(held)


def test_pipeline(spark, documents):
    limits = (quality_rules.BANDS, quality_rules.CHUNK, quality_rules.CHUNK_BAND)
    kept = []
    for i, text, source in documents:
        n_words, _, _, _, repeated = plain_counts(text)
        if n_words >= 50 and 100 * repeated <= 50 * n_words and quality_rules.verdict(text.encode(), *limits)[2]:
            kept.append((i, text, source))
    groups = plain_components([t for _, t, _ in kept])
    kept = [d for k, d in enumerate(kept) if groups[k][1] == k]
    items = [r[0] for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("text").collect()]
    kept = [d for d in kept if not plain_hits(d[1], items)[2]]
    assert 0 < len(kept) < len(documents)

    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(rows) == {i for i, _, _ in kept}
    patterns = ((secrets.ASSIGN, 2, 8), (secrets.ACCESS, 0, 16), (secrets.HEX, 0, 32))
    size = Counter()
    for i, text, source in kept:
        n = len(text.encode().split())
        clean = not any(len(m[g]) >= least for p, g, least in patterns for m in re.finditer(p, text))
        assert rows[i]["size"] == n if clean else rows[i]["size"] <= n
        size[source] += rows[i]["size"]
    names = sorted(size, key=lambda s: s.encode())
    target = dict(zip(names, mixing.target_sizes([size[s] for s in names], [k % 3 + 1 for k in range(len(names))], 3.0), strict=True))
    taken = Counter()
    for i, _, source in kept:
        assert rows[i]["source_size"] == size[source] and rows[i]["target"] == pytest.approx(target[source])
        taken[source] += rows[i]["taken"]
    assert all(abs(taken[s] - target[s]) <= 0.1 * target[s] + 3 * mixing.BLOCK for s in names)
