"""Queries against their SQL on the smallest tables; the rest runs at the next size from outside."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import frame_rows, sql_rows
from tests.conftest import DATA

CHOSEN = (
    "prj3_holdings_split prj4_enumeration_split prj9_publisher_names prj13_imprint_parse prj19_checksums flt9_agency_exclusions joi2_left_fan_out joi14_update_join "
    "srt1_skip_most_frequent set5_separate_imprints agg2_key_groups agg15_agency_map clu1_components clu3_duplicates clu5_checksums_all clu6_relations clu9_score_bands "
    "clu10_canonical_ids sco1_cluster_scores rul3_cascade rul4_cascade_with_review sco3_best_f1 qry1_conjunctive dml1_insert_new src1_json_records prj5_attributes mrc13_dublin_core "
    "src2_sequential_records src3_records_of_a_file mrc1_strict_reader mrc2_forgiving_reader mrc3_field_parse mrc5_marc8_text mrc7_xml_reader mrc8_binary_round_trip joi4_token_self_join "
    "joi5_bipartite_traversal joi9_pairs_of_a_set rul5_evaluation qry6_candidate_documents dml3_wipe dml4_delete_file "
    "clu2_related_sets clu2_leftovers prj7_dictionary_loads dml1_continuous_load dml6_file_ids_kept clu1_components_in_loads qry1_posting_lists"
).split()


@pytest.mark.parametrize("name", CHOSEN)
def test_query_agrees_with_its_sql(spark, name):
    assert frame_rows(entry.queries()[name](spark, DATA)) == sql_rows(DATA, entry.oracle_sql()[name])


def test_entry_gives_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["gd_id", "cluster_id"] and df.count() == 1500


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
