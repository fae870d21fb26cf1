import re
from pathlib import Path

import pytest

from dayferry.registry import (
    REPORT_TABLES,
    TableSpec,
    check_days,
    mapping,
    mapping_frame,
    registry_frame,
    select_tables,
    window_days,
)
from dayferry.workload.expected_columns import EXPECTED


def _fixture_mapping():
    """(target table, source, target, type) from the mapping lists in FIXTURES.md."""
    text = (Path(__file__).parent.parent / "FIXTURES.md").read_text(encoding="utf-8")
    section = text.split("\n## 3.")[1].split("\n## 4.")[0]
    for part in section.split("\n### ")[1:]:
        table = re.match(r"`\w+ → (\w+)`", part)[1]
        for kind, pairs in re.findall(r"\| `([\w(),]+)` \(\d+\) \| (.*) \|", part):
            for source, target in re.findall(r"`([^`]+)` → `([^`]+)`", pairs):
                yield table, source, target, kind


def test_shipped_mappings_match_the_fixture():
    shipped = {(s.target_table, c.source, c.target, c.type) for s in REPORT_TABLES for c in s.columns}
    assert shipped == set(_fixture_mapping())
    assert [len(s.columns) for s in REPORT_TABLES] == [23, 20, 137, 68]


def test_shipped_order_and_defaults():
    assert [s.target_table for s in REPORT_TABLES] == [
        "ods_query", "ods_campain", "ods_campaign_dsp", "ods_aws_asin_philips"
    ]
    assert [s.default_days for s in REPORT_TABLES] == [24, 60, 60, 60]
    query, _, dsp, asin = REPORT_TABLES
    assert query.target_columns[:5] == ["time", "query", "keyword_text", "profile_name", "current_bid"]
    assert query.target_columns[-3:] == ["dpv14d", "campaign_tag", "activity_type"]
    assert dsp.target_columns[-7:] == [
        "search_cvr", "search_cpa", "search_value_sum", "search", "search_value_average",
        "totale_cpdpv", "totale_cpatc",
    ]
    assert asin.target_columns[22:35] == [
        "cvr1d", "cvr7d", "cvr30d", "acos1d", "acos7d", "acos30d", "roas1d", "roas7d", "roas30d",
        "cpa1d", "cpa7d", "cpa14d", "cpa30d",
    ]


def test_every_shipped_column_in_its_place():
    """Against the values written out for the oracle: names, types and order of all four tables."""
    expected = [line.split("|") for line in EXPECTED.split("\n") if line]
    shipped = [[s.target_table, c.source, c.target, c.type] for s in REPORT_TABLES for c in s.columns]
    assert shipped == expected


def test_types_are_a_choice():
    plain = REPORT_TABLES[0].untyped()
    assert {c.type for c in plain.columns} == {None}
    assert plain.target_columns == REPORT_TABLES[0].target_columns


def test_table_spec_is_checked():
    with pytest.raises(ValueError, match="duplicate source"):
        TableSpec("a", "b", mapping(["Time", "TIME"], ["x", "y"]), "Time")
    with pytest.raises(ValueError, match="duplicate target"):
        TableSpec("a", "b", mapping(["Time", "B"], ["x", "X"]), "Time")
    with pytest.raises(ValueError, match="kept for the partition"):
        TableSpec("a", "b", mapping(["Time", "B"], ["x", "Day"]), "Time")
    with pytest.raises(ValueError, match="not mapped"):
        TableSpec("a", "b", mapping(["A"], ["x"]), "Time")
    with pytest.raises(ValueError):
        mapping(["A", "B"], ["x"])


@pytest.mark.parametrize("days", [0, 366, -1, 1.5, "7", True, None])
def test_days_out_of_range(days):
    with pytest.raises(ValueError):
        check_days(days)


def test_days_override():
    assert [window_days(s) for s in REPORT_TABLES] == [24, 60, 60, 60]
    assert [window_days(s, 365) for s in REPORT_TABLES] == [365] * 4
    assert window_days(REPORT_TABLES[0], 1) == 1


def test_select_tables():
    assert select_tables(REPORT_TABLES, None) == select_tables(REPORT_TABLES, []) == list(REPORT_TABLES)
    named = select_tables(REPORT_TABLES, ["ods_campaign_dsp", "ods_query"])
    assert [s.target_table for s in named] == ["ods_query", "ods_campaign_dsp"]
    with pytest.raises(ValueError, match="nope"):
        select_tables(REPORT_TABLES, ["nope"])


def test_missing_columns_ignores_case():
    spec = TableSpec("a", "b", mapping(["Time", "Impression.rank"], ["t", "r"]), "Time")
    assert spec.missing_columns(["TIME"]) == ["Impression.rank"]
    assert spec.lane == "a_b"


def test_frames_are_local_relations(spark):
    for df, n in ((registry_frame(spark, REPORT_TABLES), 4), (mapping_frame(spark, REPORT_TABLES), 248)):
        assert "LocalTableScan" in df._jdf.queryExecution().executedPlan().toString()
        assert df.count() == n
