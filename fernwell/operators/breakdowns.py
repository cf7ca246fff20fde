"""Counts of values by organoid type, reporting and size: the breakdown family."""

from __future__ import annotations

from ..functions.vocabulary import BASE_MEDIA, MATRICES, SOURCE_CELLS, SPECIES
from ..plans.dialect import SPARK, Dialect, operator, q, rate

# The four missingness rules of the reports, kept apart on purpose.
M1_UNREPORTED = ("", "not_stated", "not_reported")
M2_FALSY = ("", "null", "none", "not_reported", "not_extracted", "not_applicable", "tbd", "0")
M4_NOT_REPORTED = ("not_reported", "not_extracted", "not_applicable", "tbd", "null", "none", "", "0")


def _in(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def reported(c: str) -> str:
    """M1: neither null nor blank nor marked as not stated."""
    return f"({c} IS NOT NULL AND lower(trim(CAST({c} AS STRING))) NOT IN ({_in(M1_UNREPORTED)}))"


def truthy(c: str) -> str:
    """M2: the coverage report's rule, in which 0 is missing too."""
    return f"({c} IS NOT NULL AND lower(trim(CAST({c} AS STRING))) NOT IN ({_in(M2_FALSY)}))"


def has_field(c: str) -> str:
    """M3: M2 without 0."""
    return f"({c} IS NOT NULL AND lower(trim(CAST({c} AS STRING))) NOT IN ({_in(M2_FALSY[:-1])}))"


def three_state(c: str) -> str:
    """M4: present, not_reported or not_extracted."""
    return (
        f"CASE WHEN {c} IS NULL THEN 'not_extracted' WHEN lower(trim(CAST({c} AS STRING))) IN ({_in(M4_NOT_REPORTED)})"
        f" THEN 'not_reported' ELSE 'present' END"
    )


def typed(c: str = "organoid_type") -> str:
    return f"{c} IS NOT NULL AND {c} <> '' AND {c} <> 'other'"


def _breakdown(column: str, folded: str):  # noqa: ANN202
    def plan(d: Dialect) -> str:
        return f"""
SELECT CASE WHEN grouping(t) = 1 THEN 'cross' ELSE 'type' END AS level, coalesce(t, '*') AS organoid_type, v AS value, count(*) AS n
FROM (SELECT organoid_type AS t, {folded} AS v FROM manuscripts WHERE {typed()} AND {reported(column)}) x
GROUP BY GROUPING SETS ((t, v), (v))"""

    return plan


for _key, _column, _folded in (
    ("a20_species_breakdown", "species", SPECIES),
    ("a21_matrix_breakdown", "matrix", MATRICES),
    ("a22_base_media_breakdown", "base_media", BASE_MEDIA),
    ("a23_source_cell_breakdown", "source_cell_type", SOURCE_CELLS),
):
    # the display value of a known spelling; of others the text itself, of a species in lower case
    _raw = "lower(trim(species))" if _column == "species" else f"trim({_column})"
    operator(_key, "manuscripts")(_breakdown(_column, SPARK.lookup(f"lower(trim({_column}))", _folded, _raw)))


@operator("a17_type_timeseries", "protocols")
def type_timeseries(d: Dialect) -> str:
    return f"""
SELECT year, organoid_type, count(*) AS n, sum(count(*)) OVER (PARTITION BY year) AS year_total,
  min(year) OVER (PARTITION BY organoid_type) AS first_year
FROM protocols WHERE {typed()} AND year IS NOT NULL GROUP BY year, organoid_type"""


@operator("a24_protocol_complexity", "protocols")
def protocol_complexity(d: Dialect) -> str:
    metrics = ("n_signaling_factors", "n_supplements", "n_figure_confirmed", "reagents_total")
    cols = ", ".join(f"{q(f'avg({m})', 3)} AS {m}_mean, min({m}) AS {m}_min, max({m}) AS {m}_max, count({m}) AS {m}_n" for m in metrics)
    return f"""
SELECT *, rank() OVER (ORDER BY n_signaling_factors_mean DESC, organoid_type) AS complexity_rank FROM (
  SELECT organoid_type, count(*) AS n_papers, {cols} FROM protocols WHERE {typed()} GROUP BY organoid_type) x"""


_GAP_FIELDS = ("species", "matrix", "base_media", "source_cell_type", "passaging", "timeline")


@operator("a25_reporting_gaps", "protocols")
def reporting_gaps(d: Dialect) -> str:
    rows = " UNION ALL ".join(f"SELECT organoid_type AS t, '{c}' AS field, CASE WHEN {reported(c)} THEN 1 ELSE 0 END AS ok FROM protocols WHERE {typed()}" for c in _GAP_FIELDS)
    if d.spark:  # one scan: the six fields are unpivoted
        stack = ", ".join(f"'{c}', CASE WHEN {reported(c)} THEN 1 ELSE 0 END" for c in _GAP_FIELDS)
        rows = f"SELECT organoid_type AS t, stack({len(_GAP_FIELDS)}, {stack}) AS (field, ok) FROM protocols WHERE {typed()}"
    return f"""
SELECT CASE WHEN grouping(t) = 1 THEN 'corpus' ELSE 'type' END AS level, coalesce(t, '*') AS organoid_type, field,
  sum(ok) AS reported, count(*) - sum(ok) AS not_stated, count(*) AS total, {rate('sum(ok)', 'count(*)')} AS reporting_rate
FROM ({rows}) x GROUP BY GROUPING SETS ((t, field), (field))"""


@operator("a26_year_trend", "protocols")
def year_trend(d: Dialect) -> str:
    fields = ("species", "matrix", "base_media", "passaging", "timeline")
    cols = ", ".join(f"{rate(f'sum(CASE WHEN {reported(c)} THEN 1 ELSE 0 END)', 'count(*)')} AS rate_{c}" for c in fields)
    return f"""
SELECT year, count(*) AS n_papers, {q('avg(n_signaling_factors)', 2)} AS avg_signaling_factors,
  {q('avg(grounding_rate)')} AS avg_grounding_rate, {cols}
FROM protocols WHERE year IS NOT NULL GROUP BY year"""


@operator("a32_journal_breakdown", "protocols", top=5)
def journal_breakdown(d: Dialect, top: int) -> str:
    return f"""
SELECT organoid_type, journal, n, rank_in_type FROM (
  SELECT organoid_type, journal, n, row_number() OVER (PARTITION BY organoid_type ORDER BY n DESC, journal) AS rank_in_type FROM (
    SELECT organoid_type, coalesce(nullif(trim(journal), ''), 'unknown') AS journal, count(*) AS n
    FROM protocols WHERE {typed()} GROUP BY organoid_type, coalesce(nullif(trim(journal), ''), 'unknown')) x) y
WHERE rank_in_type <= {top}"""


@operator("a35_protocol_outliers", "protocols", z=1.5)
def protocol_outliers(d: Dialect, z: float) -> str:
    return f"""
SELECT organoid_type, pmcid, doi, year, n_signaling_factors AS n_sf, {q('(n_signaling_factors - mean) / std', 2)} AS z_score,
  CASE WHEN n_signaling_factors > mean + {z} * std THEN 'complex' ELSE 'minimal' END AS class
FROM (SELECT *, avg(n_signaling_factors) OVER (PARTITION BY organoid_type) AS mean,
    stddev_samp(n_signaling_factors) OVER (PARTITION BY organoid_type) AS std
  FROM (SELECT coalesce(organoid_type, 'unknown') AS organoid_type, pmcid, doi, year, n_signaling_factors FROM protocols WHERE n_signaling_factors IS NOT NULL) p) x
WHERE std > 0 AND (n_signaling_factors > mean + {z} * std OR n_signaling_factors < greatest(1e0, mean - {z} * std))"""


@operator("a35_outlier_stats", "protocols", z=1.5)
def outlier_stats(d: Dialect, z: float) -> str:
    return f"""
SELECT organoid_type, n, {q('mean')} AS mean, {q('std')} AS std, {q(f'mean + {z} * std')} AS threshold_hi,
  {q(f'greatest(1e0, mean - {z} * std)')} AS threshold_lo FROM (
  SELECT coalesce(organoid_type, 'unknown') AS organoid_type, count(*) AS n, avg(n_signaling_factors) AS mean,
    coalesce(stddev_samp(n_signaling_factors), 0e0) AS std
  FROM protocols WHERE n_signaling_factors IS NOT NULL GROUP BY coalesce(organoid_type, 'unknown')) x"""


@operator("a36_grounding_histogram", "protocols")
def grounding_histogram(d: Dialect) -> str:
    spine = "(SELECT explode(sequence(0, 9)) AS bucket)" if d.spark else "(SELECT unnest(range(0, 10)) AS bucket)"
    return f"""
SELECT CAST(s.bucket AS BIGINT) AS bucket, coalesce(h.n, 0) AS n FROM {spine} s LEFT JOIN (
  SELECT least(9, CAST(floor(grounding_rate * 10) AS INT)) AS bucket, count(*) AS n FROM protocols
  WHERE grounding_rate BETWEEN 0 AND 1 GROUP BY least(9, CAST(floor(grounding_rate * 10) AS INT))) h ON h.bucket = s.bucket"""


@operator("a36_grounding_by_type", "protocols")
def grounding_by_type(d: Dialect) -> str:
    return f"""
SELECT organoid_type, n, mean, median, row_number() OVER (ORDER BY mean DESC, organoid_type) AS rank_desc FROM (
  SELECT organoid_type, count(*) AS n, {q('avg(grounding_rate)')} AS mean, {q('median(grounding_rate)')} AS median
  FROM protocols WHERE grounding_rate BETWEEN 0 AND 1 GROUP BY organoid_type) x"""


@operator("a36_grounding_extremes", "protocols", k=20)
def grounding_extremes(d: Dialect, k: int) -> str:
    side = lambda name, way: f"""SELECT '{name}' AS side, * FROM (SELECT pmcid, organoid_type, grounding_rate FROM protocols
      WHERE grounding_rate BETWEEN 0 AND 1 ORDER BY grounding_rate {way}, pmcid LIMIT {k}) {name}_rows"""  # noqa: E731
    return f"{side('top', 'DESC')} UNION ALL {side('bottom', 'ASC')}"


@operator("a46_protocol_size", "protocols")
def protocol_size(d: Dialect) -> str:
    rows = " UNION ALL ".join(f"SELECT '{m}' AS metric, {m} AS v FROM protocols" for m in ("n_signaling_factors", "n_supplements"))
    return f"""
SELECT metric, v AS value, count(*) AS n_papers, {q('avg(avg(v)) OVER (PARTITION BY metric)', 3)} AS level_mean
FROM ({rows}) x WHERE v IS NOT NULL GROUP BY metric, v"""


@operator("a46_size_stats", "protocols")
def size_stats(d: Dialect) -> str:
    rows = " UNION ALL ".join(f"SELECT '{m}' AS metric, {m} AS v FROM protocols" for m in ("n_signaling_factors", "n_supplements"))
    return f"""
SELECT metric, {q('avg(v)', 3)} AS mean, {q('median(v)', 3)} AS median, {q('coalesce(stddev_samp(v), 0e0)', 3)} AS std,
  min(v) AS min, max(v) AS max, count(*) AS n FROM ({rows}) x WHERE v IS NOT NULL GROUP BY metric"""


@operator("a46_size_by_type", "protocols")
def size_by_type(d: Dialect) -> str:
    return f"""
SELECT coalesce(organoid_type, 'unknown') AS organoid_type, {q('avg(n_signaling_factors)', 3)} AS mean_sf,
  {d.upper_median('n_signaling_factors')} AS median_sf_upper, {q('avg(n_supplements)', 3)} AS mean_supp, count(*) AS n
FROM protocols GROUP BY coalesce(organoid_type, 'unknown')"""


@operator("a37_type_maturity", "protocols")
def type_maturity(d: Dialect) -> str:
    return f"""
SELECT organoid_type, min(year) AS first_year, max(year) AS last_year, max(year) - min(year) + 1 AS n_years_active,
  sum(n) AS n_papers_total,
  CASE WHEN count(*) < 4 THEN 'insufficient_data' WHEN avg(CASE WHEN rn > half THEN n END) > 1.3 * avg(CASE WHEN rn <= half THEN n END) THEN 'accelerating'
    WHEN avg(CASE WHEN rn > half THEN n END) < 0.75 * avg(CASE WHEN rn <= half THEN n END) THEN 'slowing' ELSE 'stable' END AS trajectory,
  CASE WHEN sum(n) >= 50 OR min(year) <= 2017 THEN 'established' WHEN sum(n) >= 20 OR min(year) <= 2021 THEN 'developing' ELSE 'emerging' END AS maturity_tier
FROM (SELECT *, row_number() OVER (PARTITION BY organoid_type ORDER BY year) AS rn,
    floor(count(*) OVER (PARTITION BY organoid_type) / 2) AS half
  FROM (SELECT coalesce(nullif(trim(organoid_type), ''), 'unknown') AS organoid_type, year, count(*) AS n FROM protocols WHERE year IS NOT NULL
    GROUP BY coalesce(nullif(trim(organoid_type), ''), 'unknown'), year) x) y
GROUP BY organoid_type"""


@operator("a50_base_media_by_source", "protocols")
def base_media_by_source(d: Dialect) -> str:
    return f"""
SELECT source, base_media, n, probability, modal_rank FROM (
  SELECT source, base_media, n, {rate('n', 'sum(n) OVER (PARTITION BY source)')} AS probability,
    row_number() OVER (PARTITION BY source ORDER BY n DESC, base_media) AS modal_rank FROM (
    SELECT trim(source_cell_type) AS source, trim(base_media) AS base_media, count(*) AS n FROM protocols
    WHERE {reported('source_cell_type')} AND {reported('base_media')} GROUP BY trim(source_cell_type), trim(base_media)) x) y
WHERE modal_rank <= 10"""


@operator("a50_base_media_impute", "protocols")
def base_media_impute(d: Dialect) -> str:
    return f"""
WITH modal AS (SELECT source, base_media, n, total FROM (
  SELECT source, base_media, n, sum(n) OVER (PARTITION BY source) AS total, row_number() OVER (PARTITION BY source ORDER BY n DESC, base_media) AS rn FROM (
    SELECT trim(source_cell_type) AS source, trim(base_media) AS base_media, count(*) AS n FROM protocols
    WHERE {reported('source_cell_type')} AND {reported('base_media')} GROUP BY trim(source_cell_type), trim(base_media)) x) y WHERE rn = 1)
SELECT p.pmcid, p.organoid_type, trim(p.source_cell_type) AS source, m.base_media AS predicted_media, {rate('m.n', 'm.total')} AS confidence, m.total AS n_training
FROM protocols p JOIN modal m ON trim(p.source_cell_type) = m.source WHERE NOT {reported('p.base_media')}"""


@operator("a54_protocol_completeness", "protocols")
def protocol_completeness(d: Dialect) -> str:
    fields = _GAP_FIELDS
    score = " + ".join(f"CASE WHEN {reported(c)} THEN 1 ELSE 0 END" for c in fields)
    missing = "concat(" + ", ".join(f"CASE WHEN {reported(c)} THEN '' ELSE '{c};' END" for c in fields) + ")"
    return f"SELECT doi, organoid_type, {score} AS score, {missing} AS missing_fields FROM protocols WHERE {typed()}"


@operator("a54_completeness_by_type", "protocols")
def completeness_by_type(d: Dialect) -> str:
    score = " + ".join(f"CASE WHEN {reported(c)} THEN 1 ELSE 0 END" for c in _GAP_FIELDS)
    return f"""
SELECT organoid_type, count(*) AS n, {q('avg(score)')} AS mean, {d.upper_median('score')} AS median_upper
FROM (SELECT organoid_type, {score} AS score FROM protocols WHERE {typed()}) x GROUP BY organoid_type"""


@operator("a54_completeness_histogram", "protocols")
def completeness_histogram(d: Dialect) -> str:
    score = " + ".join(f"CASE WHEN {reported(c)} THEN 1 ELSE 0 END" for c in _GAP_FIELDS)
    return f"""
SELECT score, n, {rate('n', 'sum(n) OVER ()')} AS fraction FROM (
  SELECT score, count(*) AS n FROM (SELECT {score} AS score FROM protocols WHERE {typed()}) x GROUP BY score) y"""


@operator("a10_summary_snapshot", "protocols")
def summary_snapshot(d: Dialect) -> str:
    rows = " UNION ALL ".join(f"SELECT '{c}' AS field, {c} AS value FROM protocols" for c in ("species", "matrix", "base_media", "source_cell_type"))
    return f"""
SELECT field, value, n, value_rank FROM (SELECT field, value, n, row_number() OVER (PARTITION BY field ORDER BY n DESC, value) AS value_rank
  FROM (SELECT field, trim(value) AS value, count(*) AS n FROM ({rows}) x WHERE {reported('value')} GROUP BY field, trim(value)) y) z WHERE value_rank <= 3"""


@operator("a10_summary_corpus", "protocols")
def summary_corpus(d: Dialect) -> str:
    return f"""
SELECT count(*) AS n_papers, count(DISTINCT organoid_type) AS n_types, {q('avg(grounding_rate)')} AS avg_grounding_rate,
  {rate('sum(reagents_grounded)', 'sum(reagents_total)')} AS pooled_rate FROM protocols"""


@operator("a02_consensus_list", "protocols")
def consensus_list(d: Dialect) -> str:
    return f"SELECT organoid_type, count(*) AS n_protocols FROM protocols WHERE {typed()} GROUP BY organoid_type"
