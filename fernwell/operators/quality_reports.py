"""Grounding, completeness and quality reports, and the batch analytics."""

from __future__ import annotations

from ..plans.dialect import Dialect, operator, q, rate, text
from ..functions.vocabulary import ASSAY_CLUSTERS, COUNT_FIELDS, FAILURE_CLUSTERS, REPORTING_ITEMS
from .breakdowns import has_field, three_state, truthy, typed



@operator("a27_grounding_quality", "reagents")
def grounding_quality(d: Dialect) -> str:
    return f"""
SELECT CASE WHEN grouping(organoid_type) = 0 THEN 'type' WHEN grouping(kind) = 0 THEN 'kind' ELSE 'corpus' END AS level,
  coalesce(organoid_type, kind, '*') AS key, count(*) AS n_reagents, sum(grounded) AS n_grounded, {rate('sum(grounded)', 'count(*)')} AS grounding_rate,
  count(evidence_quote) AS n_with_quote, {rate('count(evidence_quote)', 'count(*)')} AS evidence_quote_rate, sum(suspect_unit) AS n_suspect_unit
FROM reagents GROUP BY GROUPING SETS ((organoid_type), (kind), ())"""


@operator("a27_top_ungrounded", "reagents", k=20)
def top_ungrounded(d: Dialect, k: int) -> str:
    return f"SELECT variety AS canonical, count(*) AS n FROM reagents WHERE grounded = 0 GROUP BY variety ORDER BY n DESC, canonical LIMIT {k}"


@operator("a48_grounding_by_kind", "reagents")
def grounding_by_kind(d: Dialect) -> str:
    return f"""
SELECT CASE WHEN grouping(organoid_type) = 1 THEN 'corpus' ELSE 'type' END AS level, coalesce(organoid_type, '*') AS organoid_type, kind,
  count(*) AS n_total, sum(grounded) AS n_grounded, count(*) - sum(grounded) AS n_ungrounded, {rate('sum(grounded)', 'count(*)')} AS grounding_rate
FROM reagents GROUP BY GROUPING SETS ((organoid_type, kind), (kind))"""


@operator("a51_grounding_inconsistency", "reagents", min_n=3)
def grounding_inconsistency(d: Dialect, min_n: int) -> str:
    return f"""
SELECT canonical, n_grounded_papers, n_ungrounded_papers, n_grounded_papers + n_ungrounded_papers AS n_total_papers,
  {rate('n_ungrounded_papers', '(n_grounded_papers + n_ungrounded_papers)')} AS ungrounded_rate, n_types FROM (
  SELECT variety AS canonical, count(DISTINCT CASE WHEN grounded = 1 THEN doi END) AS n_grounded_papers,
    count(DISTINCT CASE WHEN grounded = 0 THEN doi END) AS n_ungrounded_papers, count(DISTINCT organoid_type) AS n_types FROM reagents GROUP BY variety) x
WHERE n_grounded_papers > 0 AND n_ungrounded_papers > 0 AND n_grounded_papers + n_ungrounded_papers >= {min_n}"""


@operator("a59_quote_coverage", "reagents")
def quote_coverage(d: Dialect) -> str:
    by = lambda kind: rate(f"sum(CASE WHEN kind = '{kind}' THEN quoted ELSE 0 END)", f"sum(CASE WHEN kind = '{kind}' THEN 1 ELSE 0 END)")
    return f"""
SELECT CASE WHEN grouping(organoid_type) = 0 THEN 'type' ELSE 'corpus' END AS level, coalesce(organoid_type, '*') AS key, sum(quoted) AS n_with_quote, count(*) AS n_total,
  {rate('sum(quoted)', 'count(*)')} AS coverage_rate, {by('signaling')} AS signaling_rate, {by('supplement')} AS supplement_rate
FROM (SELECT organoid_type, kind, CASE WHEN evidence_quote IS NOT NULL AND trim(evidence_quote) <> '' THEN 1 ELSE 0 END AS quoted FROM reagents) x
GROUP BY GROUPING SETS ((organoid_type), ())"""


@operator("b04_coverage_report", "protocols")
def coverage_report(d: Dialect) -> str:
    bm, mx = (f"sum(CASE WHEN {truthy(c)} THEN 1 ELSE 0 END)" for c in ("base_media", "matrix"))
    sf = f"sum(CASE WHEN {truthy('n_signaling_factors')} THEN 1 ELSE 0 END)"
    return f"""
SELECT organoid_type, n_papers, avg_grounding_rate, pooled_grounding_rate, rate_signaling, rate_base_media, rate_matrix, completeness,
  row_number() OVER (ORDER BY completeness DESC, organoid_type) AS completeness_rank FROM (
  SELECT *, {q('(coalesce(avg_grounding_rate, 0) + rate_signaling + rate_base_media + rate_matrix + least(1e0, log10(n_papers) / 2)) / 5')} AS completeness FROM (
    SELECT organoid_type, count(*) AS n_papers, {q('avg(grounding_rate)')} AS avg_grounding_rate, {rate('sum(reagents_grounded)', 'sum(reagents_total)')} AS pooled_grounding_rate,
      {rate(sf, 'count(*)')} AS rate_signaling, {rate(bm, 'count(*)')} AS rate_base_media, {rate(mx, 'count(*)')} AS rate_matrix
    FROM protocols WHERE {typed()} GROUP BY organoid_type) x) y"""


def labels_of(d: Dialect, x: str, clusters: dict[str, str]) -> str:
    """An array of the clusters whose pattern a lower-case text has, `other` where none has one."""
    made = ", ".join(f"CASE WHEN {d.matches(x, p)} THEN '{n}' END" for n, p in clusters.items())
    if d.spark:
        return f"CASE WHEN size(array_compact(array({made}))) > 0 THEN array_compact(array({made})) ELSE array('other') END"
    return f"CASE WHEN len(list_filter([{made}], lambda z: z IS NOT NULL)) > 0 THEN list_filter([{made}], lambda z: z IS NOT NULL) ELSE ['other'] END"


def _exploded(d: Dialect, array: str, name: str) -> str:
    return f"explode({array}) AS {name}" if d.spark else f"unnest({array}) AS {name}"


TERM_BREAK = r"\s*[·•,;/]\s*"


@operator("b05_assay_endpoints", "manuscripts")
def assay_endpoints(d: Dialect) -> str:
    """Papers of each cluster of assay terms, in all and by type, and the share of the papers that
    report any; a term may be of several clusters."""
    return f"""
WITH terms AS (SELECT pmcid, organoid_type, trim(lower(item)) AS term FROM manuscripts {d.parts('assay_endpoints', TERM_BREAK)}),
found AS (SELECT pmcid, organoid_type, {_exploded(d, labels_of(d, 'term', ASSAY_CLUSTERS), 'cluster')} FROM terms WHERE term <> ''),
total AS (SELECT coalesce(organoid_type, '?') AS t, grouping(organoid_type) AS overall, count(DISTINCT pmcid) AS n FROM terms WHERE term <> '' GROUP BY GROUPING SETS ((organoid_type), ()))
SELECT x.level, x.t AS organoid_type, x.cluster, x.n_papers, {rate('x.n_papers', 'total.n')} AS fraction FROM (
  SELECT CASE WHEN grouping(organoid_type) = 1 THEN 'cross' ELSE 'type' END AS level, grouping(organoid_type) AS overall, coalesce(organoid_type, '?') AS t, cluster, count(DISTINCT pmcid) AS n_papers
  FROM found GROUP BY GROUPING SETS ((organoid_type, cluster), (cluster))) x JOIN total ON total.t = x.t AND total.overall = x.overall"""


@operator("b05_assay_terms", "manuscripts", k=30)
def assay_terms(d: Dialect, k: int) -> str:
    """The raw terms that most papers have."""
    return f"""
SELECT term, count(DISTINCT pmcid) AS n_papers FROM (SELECT pmcid, trim(lower(item)) AS term FROM manuscripts {d.parts('assay_endpoints', TERM_BREAK)}) t
WHERE term <> '' GROUP BY term ORDER BY n_papers DESC, term LIMIT {k}"""


def _quality() -> str:
    """Five components of at most 1: grounded share, reagents of five, a quarter for each part of the
    context, whether assays are reported, and figure-confirmed reagents of three."""
    context = " + ".join(f"CASE WHEN {has_field(c)} THEN 25e-2 ELSE 0e0 END" for c in ("timeline", "base_media", "matrix", "passaging"))
    return f"""
SELECT pmcid, organoid_type, {q('greatest(0e0, least(1e0, coalesce(grounding_rate, 0)))')} AS grounding_quality, {q('least(coalesce(reagents_total, 0) / 5e0, 1e0)')} AS reagent_coverage,
  {q(context)} AS context_richness, CASE WHEN {has_field('assay_endpoints')} THEN 1e0 ELSE 0e0 END AS assay_coverage,
  {q('least(coalesce(n_figure_confirmed, 0) / 3e0, 1e0)')} AS figure_support FROM protocols"""


@operator("b06_quality_score", "protocols")
def quality_score(d: Dialect) -> str:
    score = q("(grounding_quality + reagent_coverage + context_richness + assay_coverage + figure_support) / 5")
    return f"""
SELECT *, CASE WHEN score >= 0.80 THEN 'gold' WHEN score >= 0.55 THEN 'silver' ELSE 'bronze' END AS tier FROM (SELECT *, {score} AS score FROM ({_quality()}) x) y"""


@operator("a12_quality_tiers", "protocols")
def quality_tiers(d: Dialect) -> str:
    return f"SELECT organoid_type, tier, count(*) AS n, {q('avg(score)')} AS mean_score FROM ({quality_score(d)}) s GROUP BY organoid_type, tier"


def item_state(c: str) -> str:
    """M4; counts are present above 0, the grounding rate from 0 on."""
    if c in COUNT_FIELDS:
        return f"CASE WHEN {c} IS NULL THEN 'not_extracted' WHEN {c} > 0 THEN 'present' ELSE 'not_reported' END"
    if c == "grounding_rate":
        return f"CASE WHEN {c} IS NULL OR {c} < 0 THEN 'not_extracted' ELSE 'present' END"
    return three_state(c)


@operator("b07_mior_papers", "protocols")
def mior_papers(d: Dialect) -> str:
    """Completeness of each paper over the twelve items, and over the required ones."""
    n = lambda state, need: " + ".join(f"CASE WHEN {item_state(c)} = '{state}' THEN 1 ELSE 0 END" for _, _, c, r in REPORTING_ITEMS if r or not need)
    return f"""
SELECT pmcid, n_present, n_not_reported, {len(REPORTING_ITEMS)} - n_present - n_not_reported AS n_not_extracted,
  CASE WHEN n_present + n_not_reported > 0 THEN {q('CAST(n_present AS DOUBLE) / (n_present + n_not_reported)')} END AS mior_completeness,
  CASE WHEN rp + rn > 0 THEN {q('CAST(rp AS DOUBLE) / (rp + rn)')} END AS required_completeness
FROM (SELECT pmcid, {n('present', 0)} AS n_present, {n('not_reported', 0)} AS n_not_reported, {n('present', 1)} AS rp, {n('not_reported', 1)} AS rn FROM protocols) x"""


@operator("b07_mior", "protocols")
def mior(d: Dialect) -> str:
    items = [(m, c) for m, _, c, _ in REPORTING_ITEMS]
    if d.spark:
        src = f"SELECT organoid_type, stack({len(items)}, {', '.join(f'{m!r}, {c!r}, {item_state(c)}' for m, c in items)}) AS (module, field, state) FROM protocols"
    else:
        src = " UNION ALL ".join(f"SELECT organoid_type, '{m}' AS module, '{c}' AS field, {item_state(c)} AS state FROM protocols" for m, c in items)
    p, r = (f"sum(CASE WHEN state = '{s}' THEN 1 ELSE 0 END)" for s in ("present", "not_reported"))
    return f"""
SELECT organoid_type, module, field, {p} AS n_present, {r} AS n_not_reported, sum(CASE WHEN state = 'not_extracted' THEN 1 ELSE 0 END) AS n_not_extracted,
  {rate(p, f'({p} + {r})')} AS completeness, CASE WHEN {p} >= 0.8 * ({p} + {r}) THEN 'full' WHEN {p} >= 0.5 * ({p} + {r}) THEN 'partial' ELSE 'low' END AS grade
FROM ({src}) x GROUP BY organoid_type, module, field"""


@operator("b01_failure_modes", "manuscripts")
def failure_modes(d: Dialect) -> str:
    """Failure descriptions (one of each paper and first 80 characters) by type and cluster, with the
    first five papers as examples."""
    return f"""
WITH f AS (SELECT pmcid, max(coalesce(nullif(organoid_type, ''), 'unknown')) AS t, substring(lower(failure), 1, 80) AS k, min(lower(failure)) AS failure FROM manuscripts WHERE trim(failure) <> ''
  GROUP BY pmcid, substring(lower(failure), 1, 80)),
x AS (SELECT pmcid, t, {_exploded(d, labels_of(d, 'failure', FAILURE_CLUSTERS), 'cluster')} FROM f),
r AS (SELECT *, row_number() OVER (PARTITION BY t, cluster ORDER BY pmcid) AS rn FROM x)
SELECT t AS organoid_type, cluster, count(*) AS n, {d.joined_set('CASE WHEN rn <= 5 THEN pmcid END')} AS examples, row_number() OVER (PARTITION BY t ORDER BY count(*) DESC, cluster) AS cluster_rank
FROM r GROUP BY t, cluster"""


@operator("b03_consensus_scalars", "protocols", k=10)
def consensus_scalars(d: Dialect, k: int) -> str:
    cols = ("species", "matrix", "base_media", "source_cell_type")
    rows = " UNION ALL ".join(f"SELECT organoid_type, '{c}' AS field, {c} AS v FROM protocols" for c in cols)
    return f"""
SELECT organoid_type, field, value, n, fraction, value_rank FROM (
  SELECT organoid_type, field, v AS value, n, {rate('n', 'sum(n) OVER (PARTITION BY organoid_type, field)', 3)} AS fraction,
    row_number() OVER (PARTITION BY organoid_type, field ORDER BY n DESC, v) AS value_rank FROM (
    SELECT organoid_type, field, v, count(*) AS n FROM ({rows}) x
    WHERE v IS NOT NULL AND v NOT IN ('', 'not_reported', 'not_extracted', 'not_applicable') GROUP BY organoid_type, field, v) y) z WHERE value_rank <= {k}"""


@operator("b03_consensus_reagents", "reagents")
def consensus_reagents(d: Dialect) -> str:
    return f"""
WITH t AS (SELECT organoid_type, count(DISTINCT pmcid) AS n FROM reagents WHERE {typed()} GROUP BY organoid_type),
u AS (SELECT organoid_type, canonical, canonical_unit, row_number() OVER (PARTITION BY organoid_type, canonical ORDER BY count(*) DESC, canonical_unit) AS rn
  FROM reagents WHERE canonical_unit IS NOT NULL AND value IS NOT NULL GROUP BY organoid_type, canonical, canonical_unit)
SELECT r.organoid_type, r.canonical, count(DISTINCT r.pmcid) AS n_papers, {rate('count(DISTINCT r.pmcid)', 'max(t.n)')} AS prevalence, {q('median(r.value)', 3)} AS median,
  min(r.value) AS min, max(r.value) AS max, {q('coalesce(stddev_samp(r.value), 0e0)', 3)} AS std, {q('coalesce(stddev_samp(r.value), 0e0) / avg(r.value)', 3)} AS cv,
  max(u.canonical_unit) AS consensus_unit, CASE WHEN count(r.value) >= 2 AND stddev_samp(r.value) / avg(r.value) > 1 THEN 1 ELSE 0 END AS high_variability
FROM reagents r JOIN t ON t.organoid_type = r.organoid_type LEFT JOIN u ON u.organoid_type = r.organoid_type AND u.canonical = r.canonical AND u.rn = 1
GROUP BY r.organoid_type, r.canonical"""


@operator("b10_protocol_diff", "reagents", a="1", b="32")
def protocol_diff(d: Dialect, a: str, b: str) -> str:
    side = lambda x: f"SELECT variety AS c, max(value) AS value, max(canonical_unit) AS unit FROM reagents WHERE pmcid = {text(x)} GROUP BY variety"
    return f"""
SELECT coalesce(x.c, y.c) AS canonical, CASE WHEN y.c IS NULL THEN 'only_a' WHEN x.c IS NULL THEN 'only_b' WHEN x.value IS DISTINCT FROM y.value OR x.unit IS DISTINCT FROM y.unit THEN 'changed' ELSE 'same' END AS status,
  x.value AS value_a, y.value AS value_b FROM ({side(a)}) x FULL OUTER JOIN ({side(b)}) y ON x.c = y.c"""


@operator("b15_supplement_worklist", "reagents", k=30)
def supplement_worklist(d: Dialect, k: int) -> str:
    return f"""SELECT variety AS canonical, count(*) AS n, count(DISTINCT pmcid) AS n_papers FROM reagents
WHERE kind = 'supplement' AND grounded = 0 GROUP BY variety ORDER BY n DESC, canonical LIMIT {k}"""


def public_license(d: Dialect, c: str = "license") -> str:
    """CC0 or CC-BY (SA included) without NC or ND; a last -NG says nothing about use."""
    code = f"replace(replace(upper(trim({c})), ' ', '-'), '_', '-')"
    bare = f"CASE WHEN {code} LIKE '%-NG' THEN substring({code}, 1, length({code}) - 3) ELSE {code} END"
    return f"(coalesce({c}, '') <> '' AND {bare} NOT LIKE '%NC%' AND {bare} NOT LIKE '%ND%' AND ({bare} LIKE 'CC-BY%' OR {bare} LIKE 'CC0%'))"


@operator("b12_public_export", "manuscripts")
def public_export(d: Dialect) -> str:
    """What may be exported: papers with a PMC key, a public licence and a type."""
    return f"""
SELECT organoid_type, license, count(*) AS n FROM manuscripts WHERE pmcid LIKE 'PMC%' AND {typed()} AND {public_license(d)} GROUP BY organoid_type, license"""


@operator("b13_knowledge_base", "reagents")
def knowledge_base(d: Dialect) -> str:
    """One row per paper and name: the dose-bearing one is kept (the larger dose, then the unit)."""
    return """
SELECT pmcid, variety, kind, value, unit FROM (SELECT *, row_number() OVER (PARTITION BY pmcid, variety
    ORDER BY CASE WHEN value IS NULL THEN 1 ELSE 0 END, value DESC, kind, unit) AS rn FROM reagents) x WHERE rn = 1"""


@operator("b11_system_status", "protocols", "reagents")
def system_status(d: Dialect) -> str:
    return """
SELECT p.n AS n_protocols, r.n AS n_reagents, p.t AS n_types, r.o AS n_orphan_reagents, CASE WHEN p.n > 0 AND r.o = 0 THEN 'ok' ELSE 'degraded' END AS health
FROM (SELECT count(*) AS n, count(DISTINCT organoid_type) AS t FROM protocols) p CROSS JOIN (
  SELECT count(*) AS n, sum(CASE WHEN x.pmcid IS NULL THEN 1 ELSE 0 END) AS o FROM reagents r LEFT JOIN (SELECT DISTINCT pmcid FROM protocols) x ON x.pmcid = r.pmcid) r"""
