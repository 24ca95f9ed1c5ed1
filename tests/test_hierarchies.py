"""Account hierarchies of very many accounts; parent chains, depths and cycles."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from ledgerweave.operators.hierarchy import closure, level_edges, node_report
from ledgerweave.sources.generate import Volumes, generate


def test_hierarchies_of_very_many_accounts(spark, salted):
    sized = Volumes(rows={"gl_account_dim": 10**9, "gl_account_hierarchy": 10**9})
    ids = spark.createDataFrame([(1,), (999_999_998,)], "id bigint")
    rows = generate(spark, "gl_account_hierarchy", sized, salted, ids=ids)
    found = rows.select("gl_account_nbr", "node_gl_account_nbr").orderBy(F.length("gl_account_nbr"))
    small, large = (tuple(r) for r in found.collect())
    assert small[1] == int(small[0]) and large[1] == int(large[0][-7:])


EDGES = "hierarchy string, child string, parent string"


def report(spark, rows):
    found = node_report(spark.createDataFrame(rows, EDGES)).collect()
    assert len({(r.hierarchy, r.node) for r in found}) == len(found)
    return {(r.hierarchy, r.node): (r.depth, r.ancestor_cnt, r.state) for r in found}


def test_chains_cycles_and_what_leads_into_them(spark):
    rows = [
        ("h", "a", None), ("h", "b", "a"), ("h", "c", "b"), ("h", "c", "b"), ("h", "m", "absent"),
        ("h", "x", "y"), ("h", "y", "x"), ("h", "z", "y"), ("h", "s", "s"), ("h", None, "a"),
        ("other", "b", "q"),
    ]
    assert report(spark, rows) == {
        ("h", "a"): (0, 0, "root"),
        ("h", "b"): (1, 1, "chain"),
        ("h", "c"): (2, 2, "chain"),
        ("h", "absent"): (0, 0, "root"),
        ("h", "m"): (1, 1, "chain"),
        ("h", "x"): (None, 1, "cycle"),
        ("h", "y"): (None, 1, "cycle"),
        ("h", "z"): (None, 2, "into cycle"),
        ("h", "s"): (None, 0, "cycle"),
        ("other", "b"): (1, 1, "chain"),
        ("other", "q"): (0, 0, "root"),
    }


def test_several_parents_take_the_shortest_way(spark):
    rows = [("h", "d", "b"), ("h", "d", "a"), ("h", "b", "a"), ("h", "a", None)]
    assert report(spark, rows)[("h", "d")] == (1, 2, "chain")
    found = closure(spark.createDataFrame(rows, EDGES)).where("node = 'd'").collect()
    assert {r.ancestor: r.distance for r in found} == {"a": 1, "b": 1}


def test_no_edges(spark):
    assert report(spark, []) == {}


def test_a_planted_cycle_among_generated_nodes(spark, salted):
    sized = Volumes(rows={"consolidation_segment_hierarchy_dim": 500})
    rows = generate(spark, "consolidation_segment_hierarchy_dim", sized, salted)
    edges = level_edges(rows, "h", "consolidation_segment_", 10)
    whole = {r.node: (r.depth, r.state) for r in node_report(edges).collect()}
    assert {d for d, _ in whole.values()} == set(range(10))
    assert all(int(n[3:].split("_")[0]) - 1 == d for n, (d, _) in whole.items())
    first = rows.select("consolidation_segment_1_cd", "consolidation_segment_3_cd").first()
    top, leaf = first
    planted = edges.where(F.col("child") != top).unionAll(
        spark.createDataFrame([("h", top, leaf)], EDGES)
    )
    states = {r.node: r.state for r in node_report(planted).collect()}
    assert set(states) == set(whole)
    assert states[top] == states[leaf] == "cycle"
    assert Counter(states.values())["cycle"] == 3
