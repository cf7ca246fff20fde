"""The property graph: build, checks, patterns of one and two hops, lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.dialect import Dialect, operator, text
from ..plans.shape import SHAPES
from ..session import stash


@operator("k01_kgx_nodes", "kg_nodes")
def kgx_nodes(d: Dialect) -> str:
    return "SELECT id, category, name FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY category, name) AS rn FROM kg_nodes) x WHERE rn = 1"


@operator("k01_kgx_manifest", "kg_nodes", "kg_edges")
def kgx_manifest(d: Dialect) -> str:
    return """SELECT 'node' AS part, category AS name, count(DISTINCT id) AS n FROM kg_nodes GROUP BY category
UNION ALL SELECT 'edge', predicate, count(*) FROM kg_edges GROUP BY predicate"""


@operator("k02_kgx_validate", "kg_nodes", "kg_edges")
def kgx_validate(d: Dialect) -> str:
    """Edges whose ends are missing or whose predicate is not allowed."""
    return """SELECT e.subject, e.predicate, e.object, CASE WHEN s.id IS NULL THEN 'no_subject' WHEN o.id IS NULL THEN 'no_object' ELSE 'bad_predicate' END AS problem
FROM kg_edges e LEFT JOIN kg_nodes s ON s.id = e.subject LEFT JOIN kg_nodes o ON o.id = e.object
WHERE s.id IS NULL OR o.id IS NULL OR e.predicate NOT IN ('mentions', 'uses_line')"""


@operator("k03_one_hop", "kg_nodes", "kg_edges", pinned="CHEM:7")
def one_hop(d: Dialect, pinned: str) -> str:
    """Neighbours of a pinned node in both orientations; both ends must exist."""
    p = text(pinned)
    return f"""
SELECT m.pinned, m.predicate, m.orientation, n.id AS other, n.category, n.name FROM (
  SELECT subject AS pinned, predicate, 'out' AS orientation, object AS other FROM kg_edges WHERE subject = {p}
  UNION ALL SELECT object, predicate, 'in', subject FROM kg_edges WHERE object = {p}) m
JOIN kg_nodes n ON n.id = m.other JOIN (SELECT id FROM kg_nodes WHERE id = {p}) me ON me.id = m.pinned"""


@operator("k04_two_hop_hub", "kg_nodes", "kg_edges", leaf="CHEM:7")
def two_hop_hub(d: Dialect, leaf: str) -> str:
    """Other leaves that share a hub with a pinned leaf: the pin is applied before the self join."""
    return f"""
SELECT a.object AS leaf_a, b.object AS leaf_b, n.name AS leaf_b_name, count(DISTINCT a.subject) AS n_hubs, min(a.subject) AS example_hub
FROM (SELECT DISTINCT subject, object FROM kg_edges WHERE predicate = 'mentions' AND object = {text(leaf)}) a
JOIN (SELECT DISTINCT subject, object FROM kg_edges WHERE predicate = 'mentions') b ON a.subject = b.subject AND a.object <> b.object
JOIN kg_nodes n ON n.id = b.object GROUP BY a.object, b.object, n.name"""


@operator("k05_meta_graph", "kg_nodes", "kg_edges")
def meta_graph(d: Dialect) -> str:
    return """SELECT s.category AS subject_category, e.predicate, o.category AS object_category, count(*) AS n
FROM kg_edges e JOIN kg_nodes s ON s.id = e.subject JOIN kg_nodes o ON o.id = e.object GROUP BY s.category, e.predicate, o.category"""


@operator("k06_capped_results", "kg_nodes", "kg_edges", k=1000)
def capped_results(d: Dialect, k: int) -> str:
    """The first k results, and only the nodes that these bind."""
    return f"""
WITH kept AS (SELECT subject, object FROM kg_edges WHERE predicate = 'uses_line' ORDER BY subject, object LIMIT {k})
SELECT n.id, n.category, n.name FROM kg_nodes n WHERE EXISTS (SELECT 1 FROM (SELECT subject AS id FROM kept UNION SELECT object FROM kept) b WHERE b.id = n.id)"""


@operator("k08_edge_attributes", "kg_edges")
def edge_attributes(d: Dialect) -> str:
    return "SELECT predicate, role AS attribute, count(*) AS n, count(DISTINCT subject) AS n_subjects FROM kg_edges WHERE role <> '' GROUP BY predicate, role"


@operator("a39_kgx_summary", "kg_nodes", "kg_edges", k=20)
def kgx_summary(d: Dialect, k: int) -> str:
    return f"""SELECT e.object AS query, count(*) AS n, {d.joined_set('e.role')} AS kinds FROM kg_edges e LEFT JOIN kg_nodes o ON o.id = e.object
WHERE o.id IS NULL GROUP BY e.object ORDER BY n DESC, query LIMIT {k}"""


@operator("k11_corpus_grounding", "reagents", "kg_nodes")
def corpus_grounding(d: Dialect) -> str:
    """Each distinct name is looked up once and the answer fanned out."""
    return """
WITH names AS (SELECT DISTINCT canonical, kind FROM reagents), hit AS (SELECT lower(name) AS k, min(id) AS id FROM kg_nodes WHERE category = 'SmallMolecule' GROUP BY lower(name)),
resolved AS (SELECT n.canonical, n.kind, h.id FROM names n LEFT JOIN hit h ON h.k = lower(n.canonical))
SELECT r.kind, r.canonical, coalesce(x.id, 'none') AS curie, CASE WHEN x.id IS NULL THEN 'not_found' ELSE 'resolved' END AS status, count(*) AS n_records
FROM reagents r JOIN resolved x ON x.canonical = r.canonical AND x.kind = r.kind GROUP BY r.kind, r.canonical, coalesce(x.id, 'none'), CASE WHEN x.id IS NULL THEN 'not_found' ELSE 'resolved' END"""


@operator("b02_lineage_graph", "lineage")
def lineage_graph(d: Dialect) -> str:
    return """
WITH e AS (SELECT DISTINCT source, cited, substring(change, 1, 60) AS change FROM lineage),
deg AS (SELECT node, sum(i) AS in_degree, sum(o) AS out_degree FROM (SELECT source AS node, 0 AS o, 1 AS i FROM e UNION ALL SELECT cited, 1, 0 FROM e) x GROUP BY node)
SELECT node, CAST(in_degree AS BIGINT) AS in_degree, CAST(out_degree AS BIGINT) AS out_degree, CASE WHEN in_degree = 0 AND out_degree > 0 THEN 1 ELSE 0 END AS is_root FROM deg"""


def lineage_reach(lineage: DataFrame) -> DataFrame:
    """Nodes reachable from each root, and the most steps that the shortest way to one of them takes.

    Breadth first: a step joins the last step's nodes with the edges and leaves out what was reached
    before, so that cycles end, and a node is held once for a root however many ways lead to it.
    Each step's nodes are written to the shared folder; the number of steps is that of the longest
    shortest way."""
    e = stash(lineage.select(F.col("cited").alias("a"), F.col("source").alias("b")).where("a IS NOT NULL AND b IS NOT NULL").distinct(), "edges")
    roots = e.select("a").distinct().join(e.select(F.col("b").alias("a")).distinct(), "a", "left_anti")
    front = stash(roots.select(F.col("a").alias("root"), F.col("a").alias("node"), F.lit(0).alias("depth")), "reach")
    steps = [front]
    while not front.isEmpty():
        seen = steps[0].select("root", "node")
        for s in steps[1:]:
            seen = seen.unionByName(s.select("root", "node"))
        found = front.join(e, F.col("node") == F.col("a")).select("root", F.col("b").alias("node"), (F.col("depth") + 1).alias("depth")).distinct()
        front = stash(found.join(seen, ["root", "node"], "left_anti"), "reach")
        steps.append(front)
        if len(steps) == 16:  # few tables, whatever the number of steps
            whole = steps[0]
            for s in steps[1:]:
                whole = whole.unionByName(s)
            steps = [stash(whole, "reach")]
    reached = steps[0]
    for s in steps[1:]:
        reached = reached.unionByName(s)
    return reached.groupBy("root").agg((F.count("*") - 1).alias("n_reached"), F.max("depth").alias("max_depth"))


def _reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..catalog import relation

    return lineage_reach(relation(spark, sf_dir, "lineage"))


QUERIES = {"b02b_lineage_reach": _reach}
ORACLE = {
    "b02b_lineage_reach": f"""
WITH RECURSIVE lineage AS ({SHAPES['lineage'][1].strip()}), e AS (SELECT DISTINCT cited AS a, source AS b FROM lineage),
walk AS (SELECT DISTINCT a AS root, a AS node, 0 AS depth FROM e WHERE a NOT IN (SELECT b FROM e) UNION SELECT w.root, e.b, w.depth + 1 FROM walk w JOIN e ON e.a = w.node)
SELECT root, count(*) - 1 AS n_reached, max(depth) AS max_depth FROM (SELECT root, node, min(depth) AS depth FROM walk GROUP BY root, node) x GROUP BY root"""
}


@operator("s19_lineage_dot", "lineage", oracle=True)
def lineage_dot(d: Dialect) -> str:
    return """SELECT concat('"', cited, '" -> "', source, '" [label="', substring(change, 1, 40), '"];') AS line FROM (SELECT DISTINCT cited, source, change FROM lineage) x"""
