"""Routes that serve another operator's result, a filter of it, or the catalogue."""

from __future__ import annotations

from ..plans.dialect import OPERATORS, Dialect, operator, q, rate, text
from . import breakdowns, doses, evaluation, graph, quality_reports, reagent_sets, retrieval, temporal  # noqa: F401  the catalogue lists them
from .breakdowns import typed
from .graph import lineage_graph
from .quality_reports import assay_endpoints, consensus_reagents, coverage_report, failure_modes, mior, protocol_diff, quality_score, system_status

operator("a04_failure_modes_route", "manuscripts")(failure_modes)
operator("a05_lineage_route", "lineage")(lineage_graph)
operator("a06_compare_route", "reagents", a="5", b="7")(protocol_diff)
operator("a08_coverage_route", "protocols")(coverage_report)
operator("a11_status_route", "protocols", "reagents")(system_status)
operator("a13_assay_route", "manuscripts")(assay_endpoints)
operator("a40_mior_route", "protocols")(mior)


@operator("a01_catalogue")
def catalogue(d: Dialect) -> str:
    rows = ", ".join(f"({text(k)}, {text(k.split('_')[0])})" for k in sorted(OPERATORS) if k != "a01_catalogue" and OPERATORS[k].oracle)
    return f"SELECT key, family FROM (VALUES {rows}) v(key, family)"


@operator("a03_consensus_type", "reagents", wanted="NATION_1")
def consensus_type(d: Dialect, wanted: str) -> str:
    return f"WITH c AS (SELECT * FROM ({consensus_reagents(d).strip().replace('WITH t AS', 'WITH t AS', 1)}) z) SELECT * FROM c WHERE organoid_type = {text(wanted)} AND prevalence >= 0.05"


@operator("a07_substitutions", "lineage", wanted="urgent")
def substitutions(d: Dialect, wanted: str) -> str:
    """Changes that name a thing, once for each source and the first 60 characters."""
    return f"SELECT source, min(cited) AS cited, substring(change, 1, 60) AS change_key FROM lineage WHERE position({text(wanted)} IN lower(change)) > 0 GROUP BY source, substring(change, 1, 60)"


@operator("a09_coverage_type", "protocols", wanted="NATION_1")
def coverage_type(d: Dialect, wanted: str) -> str:
    return f"SELECT * FROM ({coverage_report(d)}) z WHERE organoid_type = {text(wanted)}"


@operator("a12_quality_rows", "protocols", wanted="NATION_1", tier="silver", cap=200)
def quality_rows(d: Dialect, wanted: str, tier: str, cap: int) -> str:
    return f"SELECT pmcid, organoid_type, score, tier FROM ({quality_score(d)}) z WHERE organoid_type = {text(wanted)} AND tier = {text(tier)} ORDER BY score DESC, pmcid LIMIT {cap}"


@operator("a19_candidate_pools", "documents", "labels")
def candidate_pools(d: Dialect) -> str:
    """Rows of each pool (source), and stored verdicts."""
    return f"""SELECT d.source AS pool, count(*) AS n, count(l.doc_id) AS n_judged, {rate('sum(l.quality)', 'count(l.doc_id)')} AS accept_rate
FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) l ON l.doc_id = d.doc_id GROUP BY d.source"""


@operator("b03_universal_reagents", "reagents", least=0.05)
def consensus_universal(d: Dialect, least: float) -> str:
    return f"""SELECT canonical, n_types, mean_prevalence FROM (SELECT canonical, count(*) AS n_types, {q('avg(prev)')} AS mean_prevalence FROM (
  SELECT r.organoid_type, r.canonical, CAST(count(DISTINCT r.pmcid) AS DOUBLE) / max(t.n) AS prev FROM reagents r
  JOIN (SELECT organoid_type, count(DISTINCT pmcid) AS n FROM reagents WHERE {typed()} GROUP BY organoid_type) t ON t.organoid_type = r.organoid_type GROUP BY r.organoid_type, r.canonical) x
WHERE prev >= {least} GROUP BY canonical) y"""
