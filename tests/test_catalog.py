"""Catalogue against SQL. TOPICLOOM_ALL=1 compares every query, else a quick selection."""

import os
from pathlib import Path

import pytest
from compare import DATA, connect, differences

import __spark_entry__ as entry_points
from topicloom.plans.checks import SQL
from topicloom.plans.queries import CATALOG

QUICK = [
    "s8_save_partition", "t3_segment", "t7_weighted_codec", "f6_drop_words", "f12_max_label_fanout", "j2_lookup_labels", "a5_doc_tfidf",
    "a14_vec_sum", "v8_doc_vectors_tfidf", "g2_textrank", "g6_greedy_matching", "m5_term_vectors", "l5_rank_tail", "c1_match_labels", "c4_segment_corpus",
]
SF = f"{DATA}/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(SQL) if os.environ.get("TOPICLOOM_ALL") else QUICK)
def test_equals_sql(spark, con, name):
    assert differences(spark, con, name, SF) is None


def test_entry_points(spark):
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert set(CATALOG) == set(entry_points.queries()) - set(entry_points.PIPELINE)
    assert entry_points.entry(spark).columns == ["id", "word", "weight", "rank"]
