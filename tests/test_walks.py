"""Walks that end, break, branch and go round."""

from strataspark.operators import walks


def test_each_way_to_stop(spark):
    nodes = [(n, n == 9) for n in range(1, 21)]
    edges = [(1, 2, 0.1), (2, 3, 0.9), (3, 9, 0.1), (4, 5, 0.1), (5, 99, 0.1), (6, 7, 0.1), (7, 8, 0.1), (7, 1, 0.1), (10, 11, 0.1), (11, 12, 0.1), (12, 10, 9.0), (13, 13, 0.1), (14, 10, None), (9, 1, 0.1)]
    edges += [(15, 16, 0.1), (16, 17, 0.1), (17, 18, 0.1), (18, 19, 0.1), (19, 20, 5.0)]
    got = {r[0]: tuple(r[1:]) for r in walks.chain_walks(spark.createDataFrame(nodes, "node long, terminal boolean").repartition(3), spark.createDataFrame(edges, "a long, b long, error double"), 0.5).collect()}
    assert got[1] == ("complete", 3, 9, 2) and got[2] == ("complete", 2, 9, 1) and got[9] == ("complete", 0, 9, None)
    assert got[4] == ("broken", 1, 5, None) and got[5] == ("broken", 0, 5, None) and got[6] == ("branching", 1, 7, None)
    assert got[10] == ("cyclic", None, None, 3) and got[12] == ("cyclic", None, None, 1) and got[13] == ("cyclic", None, None, None) and got[14] == ("cyclic", None, None, 1)
    assert got[15] == ("broken", 5, 20, 5) and got[20] == ("broken", 0, 20, None) and len(got) == 20


def test_long_chain_and_no_rows(spark):
    nodes = spark.range(200).selectExpr("id as node", "id = 199 as terminal")
    edges = spark.range(199).selectExpr("id as a", "id + 1 as b", "if(id = 150, 2D, 0D) as error")
    got = {r.node: r for r in walks.chain_walks(nodes, edges, 1.0).collect()}
    assert (got[0].state, got[0].hops, got[0].first_failing_hop) == ("complete", 199, 151) and got[160].first_failing_hop is None
    assert walks.chain_walks(nodes.limit(0), edges, 1.0).count() == 0
