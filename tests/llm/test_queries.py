"""Every query of the training-data part against its SQL; those that SQL cannot express name their brute-force tests."""

import importlib
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))

from compare import compare, connect  # noqa: E402

from gaugeline.llm.queries import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"

#: Query without SQL: the tests that hold it to whole results worked out in another way.
BRUTE_FORCE = {
    "op2_token_records": ["test_tokens.test_records_round_trip"],
    "op3_simhash": ["test_groups.test_fingerprints", "test_groups.test_trees_lose_no_link"],
    "op4_packing": ["test_tokens.test_packing_keeps_every_id_once"],
    "op5_toxicity": ["test_classifiers.test_held_out_accuracy", "test_classifiers.test_hidden_words_are_restored"],
    "op7_quality": ["test_classifiers.test_held_out_accuracy", "test_classifiers.test_gradients_are_those_of_the_loss"],
    "op9_token_counts": ["test_tokens.test_token_counts"],
    "op11_pattern_packing": ["test_pattern_packing.test_query_has_every_id_once", "test_pattern_packing.test_packing_keeps_every_id_once"],
    "op12_periodic_runs": ["test_periodic_runs.test_query_against_a_search", "test_periodic_runs.test_runs_are_those_of_a_search"],
    "pipeline": ["test_classifiers.test_pipeline_stages"],
}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    assert compare(spark, con, QUERIES[name], ORACLES[name], SF) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_queries_without_sql_have_other_tests(name):
    for test in BRUTE_FORCE[name]:
        module, function = test.split(".")
        assert callable(getattr(importlib.import_module(module), function))
