"""Adoption, spread and variance over the years."""

from __future__ import annotations

from ..plans.dialect import Dialect, operator, q, rate


@operator("a29_temporal_adoption", "reagents", "protocols")
def temporal_adoption(d: Dialect) -> str:
    return f"SELECT canonical, year, n_all AS n_papers_total, n AS n_papers_with_reagent, f AS adoption_fraction FROM ({_series(d)}) s"


@operator("a29_adoption_trend", "reagents", "protocols", k=20)
def adoption_trend(d: Dialect, k: int) -> str:
    return f"""
WITH series AS ({_series(d)})
SELECT canonical, min(year) AS first_year, max(year) AS last_year, max(CASE WHEN peak = 1 THEN year END) AS peak_year, max(f) AS peak_adoption,
  {q('avg(CASE WHEN up <= 3 THEN f END)')} AS early_avg, {q('avg(CASE WHEN down <= 3 THEN f END)')} AS recent_avg,
  CASE WHEN avg(CASE WHEN down <= 3 THEN f END) - avg(CASE WHEN up <= 3 THEN f END) > 5e-2 THEN 'rising'
    WHEN avg(CASE WHEN down <= 3 THEN f END) - avg(CASE WHEN up <= 3 THEN f END) < -5e-2 THEN 'falling' ELSE 'stable' END AS direction, sum(n) AS n_pmcids_using
FROM (SELECT *, row_number() OVER (PARTITION BY canonical ORDER BY year) AS up, row_number() OVER (PARTITION BY canonical ORDER BY year DESC) AS down,
    row_number() OVER (PARTITION BY canonical ORDER BY f DESC, year) AS peak FROM series) x
GROUP BY canonical ORDER BY n_pmcids_using DESC, canonical LIMIT {k}"""


def _series(d: Dialect) -> str:
    """Papers of each name in each year of the corpus, zeros included. The years, a few dozen, are
    gathered into one array and exploded beside each name: no join of names and years."""
    papers = "SELECT year, count(DISTINCT pmcid) AS n FROM protocols WHERE year IS NOT NULL GROUP BY year"
    used = """SELECT r.canonical, p.year, count(DISTINCT r.pmcid) AS n FROM reagents r
  JOIN (SELECT DISTINCT pmcid, year FROM protocols WHERE year IS NOT NULL) p ON p.pmcid = r.pmcid GROUP BY r.canonical, p.year"""
    fraction = rate("n", "n_all", 3)
    if not d.spark:
        return f"""SELECT canonical, year, n_all, n, {fraction} AS f FROM (
  SELECT c.canonical, y.year, y.n AS n_all, coalesce(u.n, 0) AS n FROM (SELECT DISTINCT canonical FROM ({used}) a) c CROSS JOIN ({papers}) y
  LEFT JOIN ({used}) u ON u.canonical = c.canonical AND u.year = y.year) z"""
    return f"""SELECT canonical, year, n_all, n, {fraction} AS f FROM (
  SELECT canonical, y.year AS year, y.n AS n_all, coalesce(element_at(by_year, y.year), 0) AS n FROM (
    SELECT canonical, by_year, (SELECT collect_list(struct(year, n)) FROM ({papers}) p) AS years FROM (
      SELECT canonical, map_from_entries(collect_list(struct(year, n))) AS by_year FROM ({used}) u GROUP BY canonical) x) z
  LATERAL VIEW explode(years) e AS y) w"""


def _yearly(min_n: int, name: str) -> str:
    return f"""SELECT r.{name} AS canonical, p.year, count(*) AS n, avg(r.value) AS mean, stddev_pop(r.value) AS std, {q('stddev_pop(r.value) / avg(r.value)')} AS cv
FROM reagents r JOIN (SELECT pmcid, max(year) AS year FROM protocols WHERE year IS NOT NULL GROUP BY pmcid) p ON p.pmcid = r.pmcid
WHERE r.value > 0 GROUP BY r.{name}, p.year HAVING count(*) >= {min_n}"""


@operator("a49_temporal_variance", "reagents", "protocols", min_n=3)
def temporal_variance(d: Dialect, min_n: int) -> str:
    return f"SELECT canonical, year, n, {q('mean')} AS mean, {q('std')} AS std, cv FROM ({_yearly(min_n, 'canonical')}) x"


def _trend(min_n: int, min_years: int, name: str, words: tuple[str, str, str]) -> str:
    return f"""
SELECT canonical, count(*) AS n_years, min(year) AS first_year, max(year) AS last_year, max(CASE WHEN up = 1 THEN cv END) AS first_cv, max(CASE WHEN down = 1 THEN cv END) AS last_cv,
  {q('max(CASE WHEN down = 1 THEN cv END) - max(CASE WHEN up = 1 THEN cv END)')} AS cv_change,
  CASE WHEN max(CASE WHEN down = 1 THEN cv END) - max(CASE WHEN up = 1 THEN cv END) < -2e-1 THEN '{words[0]}'
    WHEN max(CASE WHEN down = 1 THEN cv END) - max(CASE WHEN up = 1 THEN cv END) > 2e-1 THEN '{words[1]}' ELSE '{words[2]}' END AS trend
FROM (SELECT *, row_number() OVER (PARTITION BY canonical ORDER BY year) AS up, row_number() OVER (PARTITION BY canonical ORDER BY year DESC) AS down
  FROM ({_yearly(min_n, name)}) y) x GROUP BY canonical HAVING count(*) >= {min_years}"""


@operator("a49_variance_trend", "reagents", "protocols", min_n=3)
def variance_trend(d: Dialect, min_n: int) -> str:
    return _trend(min_n, 2, "canonical", ("decreasing", "increasing", "stable"))


@operator("a62_convergence_leaders", "reagents", "protocols", min_n=2, min_years=3)
def convergence_leaders(d: Dialect, min_n: int, min_years: int) -> str:
    return _trend(min_n, min_years, "variety", ("converging", "diverging", "stable"))


@operator("a56_type_adoption", "reagents", "protocols")
def type_adoption(d: Dialect) -> str:
    return """
WITH dim AS (SELECT doi, max(organoid_type) AS t, max(year) AS year FROM protocols WHERE year IS NOT NULL AND organoid_type IS NOT NULL GROUP BY doi),
r AS (SELECT DISTINCT x.variety AS c, dim.t, dim.year FROM reagents x JOIN dim ON dim.doi = x.doi),
f AS (SELECT c, t, min(year) AS year FROM r GROUP BY c, t),
fresh AS (SELECT c, year, count(*) AS n FROM f GROUP BY c, year),
y AS (SELECT c, year, count(*) AS n FROM r GROUP BY c, year)
SELECT y.c AS canonical, y.year, y.n AS n_types_this_year, coalesce(fresh.n, 0) AS n_new_types,
  CAST(sum(coalesce(fresh.n, 0)) OVER (PARTITION BY y.c ORDER BY y.year ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_n_types
FROM y LEFT JOIN fresh ON fresh.c = y.c AND fresh.year = y.year"""


@operator("a56_adoption_heads", "reagents", "protocols", min_types=10, k=50)
def adoption_heads(d: Dialect, min_types: int, k: int) -> str:
    return f"""
WITH dim AS (SELECT doi, max(organoid_type) AS t, max(year) AS year FROM protocols WHERE year IS NOT NULL AND organoid_type IS NOT NULL GROUP BY doi),
r AS (SELECT DISTINCT x.variety AS c, dim.t, dim.year FROM reagents x JOIN dim ON dim.doi = x.doi),
y AS (SELECT c, year, count(*) AS n, row_number() OVER (PARTITION BY c ORDER BY count(*) DESC, year) AS rn FROM r GROUP BY c, year)
SELECT h.c AS canonical, h.n AS n_types_current, h.first_year, y.year AS year_peak, h.n_years AS n_years_active FROM (
  SELECT c, count(DISTINCT t) AS n, min(year) AS first_year, count(DISTINCT year) AS n_years FROM r GROUP BY c HAVING count(DISTINCT t) >= {min_types}) h
JOIN y ON y.c = h.c AND y.rn = 1 ORDER BY n_types_current DESC, canonical LIMIT {k}"""
