"""Checks of extracted records against their texts, resolvers, and merges of stored documents."""

from __future__ import annotations

from ..functions.vocabulary import CITED_KEY, FAILURE_CLUSTERS, FIGURE_FILE, FIGURE_SKIP, PRODUCTS, RESOLVER_ALIASES, RESOLVER_GREEK
from ..plans.dialect import Dialect, operator, q, rate
from .quality_reports import public_license


@operator("t04_grounded_extraction", "conversations")
def grounded_extraction(d: Dialect) -> str:
    """A quote (the first sentence of a reply) is kept only where it stands in the text it is from."""
    quote = "substring_index(a.text, '.', 1)" if d.spark else "split_part(a.text, '.', 1)"
    return f"""
SELECT a.conv_id, a.turn, CASE WHEN b.text IS NOT NULL AND length({quote}) > 0 AND position({quote} IN b.text) > 0 THEN 1 ELSE 0 END AS grounded, CAST(length({quote}) AS BIGINT) AS n_quote
FROM conversations a LEFT JOIN (SELECT conv_id, turn, min(text) AS text FROM conversations GROUP BY conv_id, turn) b ON b.conv_id = a.conv_id AND b.turn = a.turn WHERE a.role = 'assistant'"""


_CITED = """
SELECT source, change, CASE WHEN CAST(cited AS BIGINT) % 4 = 0 THEN cited ELSE concat('10.1000/', cited) END AS cited,
  CASE WHEN CAST(source AS BIGINT) % 5 = 0 THEN 'as described before' ELSE concat('as in 10.1000/', cited, ' with less salt') END AS source_text FROM lineage"""


@operator("t06_modification_gate", "lineage")
def modification_gate(d: Dialect) -> str:
    """Modifications with a description; their citation is kept only where it has the full form of a
    DOI and stands verbatim in the source."""
    kept = f"{d.matches('cited', CITED_KEY)} AND position(cited IN source_text) > 0"
    return f"SELECT source, CASE WHEN {kept} THEN cited END AS cited, change FROM ({_CITED}) m WHERE trim(change) <> ''"


@operator("t08_confirm_only", "reagents")
def confirm_only(d: Dialect) -> str:
    """Names read from figures count only where the text has them too."""
    return """SELECT f.pmcid, f.canonical FROM (SELECT DISTINCT pmcid, canonical FROM reagents WHERE figure_confirmed = 1) f
WHERE EXISTS (SELECT 1 FROM reagents t WHERE t.figure_confirmed = 0 AND t.pmcid = f.pmcid AND t.canonical = f.canonical)"""


@operator("t10_delegation_resolve", "lineage", "protocols")
def delegation_resolve(d: Dialect) -> str:
    """A delegated citation resolves where type and journal agree and the cited paper is not later."""
    return """SELECT l.source, l.cited, CASE WHEN c.pmcid IS NULL THEN 'no_paper' WHEN c.year > s.year THEN 'later' WHEN c.journal IS DISTINCT FROM s.journal THEN 'other_journal' ELSE 'resolved' END AS verdict
FROM lineage l JOIN protocols s ON s.pmcid = l.source LEFT JOIN protocols c ON c.pmcid = l.cited"""


@operator("t12_backfill_merge", "protocols", "manuscripts", "lineage")
def backfill_merge(d: Dialect) -> str:
    """Failure notes and cited changes of each paper, derived anew, merged into the stored record;
    the other sections stay as stored."""
    return """
SELECT p.pmcid, p.passaging, f.n AS n_failures, c.n AS n_changes, CASE WHEN f.pmcid IS NULL AND c.pmcid IS NULL THEN 'kept' ELSE 'merged' END AS state FROM protocols p
LEFT JOIN (SELECT substring(pmcid, 4) AS pmcid, count(*) AS n FROM manuscripts WHERE trim(failure) <> '' GROUP BY substring(pmcid, 4)) f ON f.pmcid = p.pmcid
LEFT JOIN (SELECT source AS pmcid, count(DISTINCT cited) AS n FROM lineage GROUP BY source) c ON c.pmcid = p.pmcid"""


def resolver_key(d: Dialect, c: str) -> str:
    """Lower case, Greek letters by name, letters and digits only."""
    x = f"lower({c})"
    for letter, name in RESOLVER_GREEK.items():
        x = f"replace({x}, '{letter}', '{name}')"
    return d.sub(x, "[^a-z0-9]", "")


@operator("k09_grounding_resolve", "mentions", "resolver_hits", prefixes=("CHEBI", "UNII", "PR"))
def grounding_resolve(d: Dialect, prefixes: tuple[str, ...]) -> str:
    """Names by alias, then by the resolver's hits in their order: the first hit of a wanted prefix
    whose label or synonym is the name resolves; else the first of a wanted prefix needs review; no
    such hit: not found; no name: not attempted. Hits meet names by key, labels and synonyms each
    in a join of their own."""
    wanted = ", ".join(f"'{p}'" for p in prefixes)
    return f"""
WITH names AS (SELECT DISTINCT name FROM mentions),
asked AS (SELECT name, {d.lookup(d.sub("lower(name)", "[^a-z0-9]", ""), RESOLVER_ALIASES, "name")} AS lookup FROM names WHERE name <> ''),
q AS (SELECT name, lookup, {resolver_key(d, 'lookup')} AS k FROM asked),
hit AS (SELECT query, pos, curie, {resolver_key(d, 'label')} AS lk, {resolver_key(d, 'synonym')} AS sk FROM resolver_hits WHERE substring_index(curie, ':', 1) IN ({wanted})),
met AS (SELECT q.name, hit.pos, hit.curie, CASE WHEN q.k <> '' AND (hit.lk = q.k OR hit.sk = q.k) THEN 0 ELSE 1 END AS grade FROM q JOIN hit ON hit.query = q.k),
best AS (SELECT name, curie, grade FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY grade, pos, curie) AS rn FROM met) x WHERE rn = 1)
SELECT n.name, best.curie, CASE WHEN coalesce(n.name, '') = '' THEN 'not_attempted' WHEN best.grade = 0 THEN 'resolved' WHEN best.grade = 1 THEN 'needs_review' ELSE 'not_found' END AS status
FROM names n LEFT JOIN best ON best.name = n.name""".replace("substring_index(curie, ':', 1)", "substring_index(curie, ':', 1)" if d.spark else "split_part(curie, ':', 1)")


@operator("k12_supplement_resolve", "mentions", "resolver_hits")
def supplement_resolve(d: Dialect) -> str:
    """Supplements: a known product first, else the first verified hit of any prefix, else the first
    hit for review, else not found."""
    return f"""
WITH names AS (SELECT name, count(*) AS n FROM mentions WHERE kind = 'supplement' AND name <> '' GROUP BY name),
q AS (SELECT name, n, {d.lookup('name', PRODUCTS)} AS product, {resolver_key(d, 'name')} AS k FROM names),
met AS (SELECT q.name, h.pos, h.curie, CASE WHEN q.k <> '' AND ({resolver_key(d, 'h.label')} = q.k OR {resolver_key(d, 'h.synonym')} = q.k) THEN 0 ELSE 1 END AS grade FROM q JOIN resolver_hits h ON h.query = q.k),
best AS (SELECT name, curie, grade FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY grade, pos, curie) AS rn FROM met) x WHERE rn = 1)
SELECT q.name, q.n, coalesce(q.product, best.curie) AS identifier,
  CASE WHEN q.product IS NOT NULL THEN 'curated' WHEN best.grade = 0 THEN 'resolved' WHEN best.grade = 1 THEN 'needs_review' ELSE 'not_found' END AS status
FROM q LEFT JOIN best ON best.name = q.name"""


@operator("k10_cell_line_resolve", "supplier", "kg_nodes")
def cell_line_resolve(d: Dialect) -> str:
    return """SELECT s.s_name AS name, n.id AS accession FROM supplier s JOIN (SELECT name, min(id) AS id FROM kg_nodes WHERE category = 'CellLine' GROUP BY name) n ON lower(n.name) = lower(s.s_name)"""


@operator("b14_figure_manifest", "figures", "captions", "manuscripts")
def figure_manifest(d: Dialect) -> str:
    """Figures of papers with a public licence, each with its caption: by the file's base name, else
    by the figure's label."""
    return f"""
WITH open_papers AS (SELECT DISTINCT pmcid FROM manuscripts WHERE {public_license(d)})
SELECT f.pmcid, f.file, coalesce(a.caption, b.caption) AS caption, CASE WHEN a.caption IS NOT NULL THEN 'file' WHEN b.caption IS NOT NULL THEN 'label' ELSE 'none' END AS matched_by
FROM figures f JOIN open_papers o ON o.pmcid = f.pmcid
LEFT JOIN (SELECT pmcid, graphic, min(caption) AS caption FROM captions GROUP BY pmcid, graphic) a ON a.pmcid = f.pmcid AND a.graphic = {d.sub('f.file', '[.][a-z]+$', '')}
LEFT JOIN (SELECT pmcid, label, min(caption) AS caption FROM captions GROUP BY pmcid, label) b ON b.pmcid = f.pmcid AND b.label = f.label
WHERE {d.matches('f.file', FIGURE_FILE)} AND NOT {d.matches('f.file', FIGURE_SKIP)}"""


@operator("e09_baseline_score", "protocols")
def baseline_score(d: Dialect) -> str:
    """Exact matches and status accuracy of one field against another."""
    return f"""SELECT {rate("sum(CASE WHEN lower(coalesce(matrix, '')) = lower(coalesce(journal, '')) THEN 1 ELSE 0 END)", 'count(*)')} AS exact_match,
  {rate('sum(CASE WHEN (matrix IS NULL) = (journal IS NULL) THEN 1 ELSE 0 END)', 'count(*)')} AS status_accuracy, {q('avg(coalesce(grounding_rate, 0))')} AS mean_rate, count(*) AS n FROM protocols"""


@operator("i11_batch_split", "protocols")
def batch_split(d: Dialect) -> str:
    """A batch's accepted and rejected papers in the order of their keys, with the reason."""
    reason = "CASE WHEN n_signaling_factors = 0 THEN 'no_factors' WHEN coalesce(grounding_rate, 0) < 0.3 THEN 'low_grounding' END"
    return f"SELECT pmcid, CASE WHEN {reason} IS NULL THEN 'accepted' ELSE 'rejected' END AS side, coalesce({reason}, 'ok') AS reason FROM protocols"


@operator("x24_multi_label", "manuscripts")
def multi_label(d: Dialect) -> str:
    """All failure clusters of a description by their patterns, `other` where none holds."""
    parts = ", ".join(f"CASE WHEN {d.matches('lower(failure)', p)} THEN '{n};' ELSE '' END" for n, p in FAILURE_CLUSTERS.items())
    return f"SELECT failure, coalesce(nullif(concat({parts}), ''), 'other;') AS labels, count(*) AS n FROM manuscripts WHERE trim(failure) <> '' GROUP BY failure, coalesce(nullif(concat({parts}), ''), 'other;')"


@operator("w11_round_robin", "protocols", n=50)
def round_robin(d: Dialect, n: int) -> str:
    return f"""SELECT pmcid, organoid_type, turn FROM (SELECT pmcid, organoid_type, row_number() OVER (PARTITION BY organoid_type ORDER BY sha1(pmcid), pmcid) AS turn FROM protocols) x
ORDER BY turn, organoid_type LIMIT {n}"""


@operator("j06_full_outer_diff", "reagents", a=1997, b=1998)
def full_outer_diff(d: Dialect, a: int, b: int) -> str:
    return f"""SELECT coalesce(x.c, y.c) AS canonical, coalesce(x.n, 0) AS n_a, coalesce(y.n, 0) AS n_b, CASE WHEN y.c IS NULL THEN 'only_a' WHEN x.c IS NULL THEN 'only_b' ELSE 'both' END AS status
FROM (SELECT variety AS c, count(*) AS n FROM reagents WHERE year = {a} GROUP BY variety) x FULL OUTER JOIN (SELECT variety AS c, count(*) AS n FROM reagents WHERE year = {b} GROUP BY variety) y ON x.c = y.c"""
