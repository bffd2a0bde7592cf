from __future__ import annotations

import datetime as dt
import random

import pytest
from files import rows

from fleetlens import params
from fleetlens.operators import installed_base as base, quality, relational as rel

ASOF = dt.date(2026, 1, 1)
TOOLS = "ENTITY string, Location string, Three_CEID string, Process_Node string, install_sts string, Warranty_Start string"
GBOM = "Part_Number string, Three_CEID string, Process_Node string, Tool_Type string, Qty_Per_Tool int"
INVENTORY = "Part_Number string, Qty decimal(18,2), Total_Amount_USD decimal(18,2), Supplier_Code string, line int"


def random_lists(seed, hot=True):
    """Tools and parts over few configurations; a third of both are in one of them."""
    rng = random.Random(seed)

    def config():
        if hot and rng.random() < 0.33:
            return ("HOT", "7")
        return (rng.choice(["A", "B", "C", None]), rng.choice(["1", "2", "x", None]))

    tools = [
        (rng.choice(["E", None]) and f"E{rng.randrange(60)}", rng.choice(["L1", "L2", None]), *config(),
         rng.choice(["Bagged", "Installed", None]), rng.choice(["2025-06-01", "2023-06-01", "2021-06-01", "2010-01-01", "bad"]))
        for _ in range(300)
    ]
    gbom = [(rng.choice([f"P{rng.randrange(40)}"] * 9 + [None]), *config(), f"T{rng.randrange(3)}", rng.randrange(1, 5)) for _ in range(150)]
    return tools, gbom


def brute_force(tools, gbom):
    """(part -> {tool id -> set of ages}) by going through all pairs."""
    ages = {"2025-06-01": "0_1Y", "2023-06-01": "1_3Y", "2021-06-01": "3_5Y", "2010-01-01": "5P_Y", "bad": "UnknownAge"}

    def node(text):
        return int(text) if text in ("1", "2", "7") else None

    found = {}
    for part, ceid, process, *_ in gbom:
        for entity, location, tool_ceid, tool_process, status, start in tools:
            same = ceid == tool_ceid and node(process) == node(tool_process)
            if part is not None and same and status != "Bagged":
                found.setdefault(part, {}).setdefault(f"{entity}|{location}", set()).add(ages[start])
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_part_counts_against_all_pairs(spark, seed):
    tools, gbom = random_lists(seed)
    expected = brute_force(tools, gbom)
    tools_df, gbom_df = spark.createDataFrame(tools, TOOLS), spark.createDataFrame(gbom, GBOM)
    columns = ["Number_of_active_tools", *params.AGE_COLUMNS.values()]
    got = {row.Part_Number: tuple(row[c] for c in columns) for row in base.part_tool_counts(gbom_df, tools_df, ASOF).collect()}
    assert got == {
        part: (len(found), *[sum(age in ages for ages in found.values()) for age in params.AGE_COLUMNS])
        for part, found in expected.items()
    }
    offenders = [(part, tool, len(ages)) for part, found in expected.items() for tool, ages in found.items() if len(ages) > 1]
    assert rows(base.bucket_consistency(gbom_df, tools_df, ASOF), "Part_Number", "Tool_ID", "Distinct_Buckets") == sorted(offenders)
    first = list(dict.fromkeys(tool for _, tool, _ in sorted(offenders)))[:3]
    assert {row[0] for row in rows(base.offending_tools(gbom_df, tools_df, ASOF, 3), "Tool_ID")} == set(first)


def test_config_mart_counts_tools_not_rows(spark):
    data = [
        ("E1", "L1", "A", "1", None, "2025-06-01"), ("E1", "L1", "A", "1.0", "Installed", "2023-06-01"),
        ("E1", "L2", "A", "1", "Installed", "bad"), ("E2", "L1", "A", "1", "Bagged", "bad"),
        ("E3", "L1", None, "1", "Installed", "bad"), ("E3", "L1", "A", "n/a", "Installed", "bad"),
    ]
    mart = base.config_mart(spark.createDataFrame(data, TOOLS), ASOF)
    assert rows(mart, "Three_CEID", "Process_Node", "Active_Tool_Count_Config", *params.AGE_COLUMNS.values()) == [("A", 1, 2, 1, 1, 0, 0, 1)]


def test_drilldown_and_leadership(spark):
    tools = spark.createDataFrame([("E1", "L1", "A", "1", None, "2025-06-01"), ("E2", "L1", None, "1", None, "bad")], TOOLS)
    gbom = spark.createDataFrame(
        [("P1", "A", "1", "T2", 2), ("P1", None, "1", "T1", 3), ("P2", "B", "1", None, 1), (None, "A", "1", "T1", 4)], GBOM
    )
    stock = spark.createDataFrame(
        [("P1", 2, 10, None, 1), ("P1", 3, 10, "S2", 2), ("P1", 0, 5, "S1", 3), ("P2", 0, 7, None, 4), ("P9", 1, 1, "S9", 5), (None, 1, 1, "S", 6)],
        "Part_Number string, Qty int, Total_Amount_USD int, Supplier_Code string, line int",
    )
    rows_ = base.drilldown(gbom, base.config_mart(tools, ASOF), stock)
    columns = ["Part_Number", "Active_Tool_Count_Config", "Count_Of_Tools_Age_0_to_1_Yr", "Qty_Total", "Estimated_Parts_Needed_Config"]
    assert rows(rows_, *columns) == [(None, 1, 1, None, 4), ("P1", 0, None, 5, 0), ("P1", 1, 1, 5, 2), ("P2", 0, None, 0, 0)]
    board = base.leadership(gbom, tools, stock, ASOF, ["line"])
    columns = ["Part_Number", "Amount_of_stock", "Supplier_Code", "Cost_per_part", "Amount_needed_per_tool", "Applicable_CEIDs",
               "Applicable_Tool_Types", "Number_of_active_tools", "Count_Of_Tools_Age_Unknown", "Active_Installed_Flag",
               "Disposition_Category", "Confidence_Level"]
    assert rows(board, *columns) == [
        ("P1", 5, "S2", 5.0, 3, "A", "T1, T2", 2, 1, "Y", "Sell", "High"),
        ("P2", 0, None, None, 1, "B", "", 0, 0, "N", "Investigate", "Medium"),
        ("P9", 1, "S9", 1.0, None, None, None, 0, 0, "N", "Divest/Scrap", "Low"),
    ]
    assert "Supplier_Code" not in base.leadership(gbom, tools, stock, ASOF).columns


def test_part_count_lies_between_largest_and_sum_of_config_counts(spark):
    tools, gbom = random_lists(5)
    gbom = [row for row in gbom if row[0] and row[1] and row[2] in ("1", "2", "7")]
    mart = {tuple(r[:2]): r[2] for r in rows(base.config_mart(spark.createDataFrame(tools, TOOLS), ASOF), "Three_CEID", "Process_Node", "Active_Tool_Count_Config")}
    counts = base.part_tool_counts(spark.createDataFrame(gbom, GBOM), spark.createDataFrame(tools, TOOLS), ASOF)
    for part, n in rows(counts, "Part_Number", "Number_of_active_tools"):
        parts = [mart.get((c, int(p)), 0) for c, p in {(g[1], g[2]) for g in gbom if g[0] == part}]
        assert max(parts) <= n <= sum(parts)


def test_acceptance_checks(spark):
    data = [("E1", f"L{i}", "A", "1", None, "bad") for i in range(3)] + [("E_2", "L", "B", "1", None, "bad")]
    tools = spark.createDataFrame(data, TOOLS)
    gbom = spark.createDataFrame([("P1", "A", "1", "T", 1), ("P1", "B", "1", "T", 1)], GBOM)
    stock = spark.createDataFrame([("P1", 1, 1, "S", 1)], "Part_Number string, Qty int, Total_Amount_USD int, Supplier_Code string, line int")
    mart, board = base.config_mart(tools, ASOF), base.leadership(gbom, tools, stock, ASOF)
    columns = ["check_name", "value", "bound", "passed"]
    assert rows(quality.acceptance_checks(tools, mart, board, gbom), *columns) == [("A", 1, 0, False), ("B", 3, 4, True), ("C", 4, 4, True)]
    by_entity = quality.acceptance_checks(tools, mart, board, gbom, "entity")
    assert rows(by_entity, *columns) == [("A", 1, 0, False), ("B", 3, 2, False), ("C", 4, 2, False)]
    with pytest.raises(ValueError):
        quality.acceptance_checks(tools, mart, board, gbom, "row")


def test_key_overlap_warns(spark):
    left = spark.createDataFrame([("a", 1), ("b", None)], "k string, n int")
    right = spark.createDataFrame([("c", 1), ("b", 2)], "k string, n int")
    columns = ["column_name", "n_left", "n_right", "n_common", "no_overlap"]
    assert rows(quality.key_overlap(left, right, ["k", "n"]), *columns) == [("k", 2, 2, 1, False), ("n", 1, 2, 1, False)]
    assert rows(quality.key_overlap(left.limit(1), right, ["k"]), *columns) == [("k", 1, 2, 0, True)]


def test_small_reports(spark):
    df = spark.createDataFrame([("a",), ("a",), ("c",), ("b",), (None,)], "v string")
    assert [tuple(r) for r in rel.value_counts(df, "v", 2).collect()] == [("a", 2), ("b", 1)]
    assert [r[0] for r in rel.distinct_sample(df, "v", 2).collect()] == ["a", "b"]
    assert rel.distinct_count(df, "v", "n").first().n == 3
    assert tuple(quality.dedup_report(df, ["v"]).first()) == (5, 4, 1)
    assert tuple(quality.dedup_report(df.where("false"), ["v"]).first()) == (0, 0, 0)
    assert rows(quality.null_violations(df, ["v"]), "column_name", "n_nulls") == [("v", 1)]
    assert rows(quality.unique_violations(df, ["v"]), "v", "n_rows") == [("a", 2)]
    left = spark.createDataFrame([(1, 2)], "b int, a int")
    right = spark.createDataFrame([(3, 4)], "c int, b int")
    both = rel.union_dynamic([left, right])
    assert both.columns == ["b", "a", "c"] and rows(both, "b", "a", "c") == [(1, 2, None), (4, None, 3)]


def test_parts_with_sets_of_their_own_over_one_large_configuration(spark, monkeypatch):
    """All sets differ, a third of the tools are in one configuration: counts add up, few pairs of classes are made."""
    chooser = random.Random(4)
    gbom, tools = [], []
    for part in range(500):
        for node in {0, *chooser.sample(range(1, 60), 4), 60 + part}:
            gbom.append((f"P{part}", "A", str(node), "t", 1))
    for tool in range(600):
        nodes = [0] if tool % 3 == 0 else [chooser.randrange(60)]
        nodes += [chooser.randrange(60)] if tool % 50 == 0 else []
        start = str(ASOF - dt.timedelta(days=chooser.randrange(3000)))
        tools += [(f"T{tool}", "L", "A", str(node), "Installed", start) for node in nodes]
    gbom_df, tools_df = spark.createDataFrame(gbom, GBOM), spark.createDataFrame(tools, TOOLS)
    made, matches = [], base._matches
    monkeypatch.setattr(base, "_matches", lambda *given: made.append(matches(*given)) or made[-1])
    got = {row.Part_Number: row.Number_of_active_tools for row in base.part_tool_counts(gbom_df, tools_df, ASOF).collect()}
    nodes_of = {}
    for part, _, node, *_ in gbom:
        nodes_of.setdefault(part, set()).add(node)
    want = {part: len({tool for tool, _, _, node, *_ in tools if node in nodes}) for part, nodes in nodes_of.items()}
    assert got == want
    # Only the dozen tools under two configurations meet sets, not all 600.
    assert made[0].count() <= 12 * 500


def test_inconsistent_pairs_are_made_of_blocks(spark, monkeypatch):
    """Of 60 parts and 50 tools in one configuration, blocks are joined and shuffled, each small; all 3,000 pairs are found."""
    made, blocks = [], base._blocks
    monkeypatch.setattr(base, "_BLOCK", 10)
    monkeypatch.setattr(base, "_blocks", lambda *given: made.append(blocks(*given)) or made[-1])
    tools = [(f"E{i}", "L", "A", str(node), None, start) for i in range(50) for node, start in ((1, "2025-06-01"), (2, "bad"))]
    gbom = [(f"P{i}", "A", str(node), "T", 1) for i in range(60) for node in (1, 2)]
    found = base.bucket_consistency(spark.createDataFrame(gbom, GBOM), spark.createDataFrame(tools, TOOLS), ASOF)
    assert rows(found, "Part_Number", "Tool_ID", "Distinct_Buckets") == sorted((f"P{p}", f"E{t}|L", 2) for p in range(60) for t in range(50))
    sizes = [[row.n for row in of.selectExpr("size(members) AS n").collect()] for of in made]
    assert [sum(of) for of in sizes] == [60, 50] and all(len(of) > 1 and max(of) <= 30 for of in sizes)
