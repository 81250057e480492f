"""Schemas of the tables that the engine reads and writes, as Spark DDL."""

from __future__ import annotations

MOMENT = (
    "law STRING, law_id STRING, law_key STRING, finlex_version STRING, node_id STRING, part STRING, part_title STRING, chapter STRING, chapter_title STRING, "
    "section_id STRING, section_num INT, section_suffix STRING, section_title STRING, moment STRING, text STRING, effective_from STRING, in_force BOOLEAN, "
    "tags ARRAY<STRING>, anchors ARRAY<STRING>, source STRUCT<xml_path: STRING, finlex_url: STRING, xpath: STRING>"
)
VERSION = "finlex STRING, effective_from STRING, source_xml STRING, date_consolidated STRING, amendments ARRAY<STRING>"
VECTOR = "id STRING, law_key STRING, document STRING, embedding ARRAY<FLOAT>, section_id STRING, section_num INT, section_title STRING, moment STRING, tags ARRAY<STRING>, anchors ARRAY<STRING>, in_force BOOLEAN"
GRAPH_NODE = "node_id STRING, node_type STRING, law_key STRING, section_num INT, moment STRING, section_title STRING, text STRING"
GRAPH_EDGE = "edge_ord BIGINT, source STRING, target STRING, edge_type STRING, context STRING"
QUESTION = "id STRING, category STRING, must BOOLEAN, query STRING, expected_any ARRAY<STRUCT<section: STRING, moment: STRING>>, expected_none ARRAY<STRING>, test_type STRING, k INT, min_score DOUBLE, notes STRING"
CROSS_QUESTION = "id STRING, type STRING, category STRING, test_type STRING, query STRING, expected_any ARRAY<STRUCT<law_key: STRING, section_num: INT, moment: STRING>>, expected_none ARRAY<STRING>, notes STRING, autofill_status STRING"
CASE_RESULT = "case_id STRING, category STRING, query STRING, top1_law_key STRING, topk_law_keys ARRAY<STRING>, confusion_fail BOOLEAN, hallucinated_evidence BOOLEAN, version_drift BOOLEAN, system_abstains BOOLEAN, abstain_expected BOOLEAN, latency_ms DOUBLE"
