"""Doses and units: the concentration family."""

from __future__ import annotations

from ..functions.vocabulary import ACTIVITY_UNIT, BARE_VOLUME, BODY_DOSE, EXTRACTED_UNITS, MASS_UNIT, MOLAR, UCUM
from ..plans.dialect import Dialect, operator, q, rate

UNIT = "coalesce(nullif(trim(canonical_unit), ''), nullif(trim(unit), ''), 'unknown')"


def canonical_unit(d: Dialect, unit: str) -> str:
    """One spelling for units of concentration, else the text with micro signs and dashes folded."""
    s = f"translate(trim({unit}), 'μµ−', 'uu-')"
    low = f"lower({s})"
    bare = f"replace({low}, ' ', '')"
    part = lambda p, k: f"regexp_extract({low}, {d.pattern(p)}, {k})"
    mass = f"concat({part(MASS_UNIT, 1)}, '/', {d.lookup(part(MASS_UNIT, 2), {'ml': 'mL', 'ul': 'uL', 'l': 'L'})})"
    activity = d.lookup(part(ACTIVITY_UNIT, 1), {"u": "U/mL", "mu": "mU/mL", "iu": "IU/mL", "kiu": "kIU/mL"})
    return f"""CASE WHEN {unit} IS NULL OR {unit} = '' THEN NULL WHEN {d.matches(low, MASS_UNIT)} THEN {mass} WHEN {d.matches(low, ACTIVITY_UNIT)} THEN {activity}
  WHEN {d.lookup(bare, MOLAR)} IS NOT NULL THEN {d.lookup(bare, MOLAR)} WHEN position('%' IN {s}) > 0 OR {bare} IN ('v/v', 'w/v', 'vv', 'wv') THEN '%' ELSE {s} END"""


def concentration_class(d: Dialect, unit: str) -> str:
    """missing, in_vivo_dose, volume, percent, concentration or other, the first that holds."""
    known = ", ".join(f"'{u}'" for u in UCUM)
    return f"""CASE WHEN {unit} IS NULL OR trim({unit}) = '' THEN 'missing' WHEN {d.matches(f'trim({unit})', BODY_DOSE)} THEN 'in_vivo_dose'
  WHEN {d.matches(f"lower(translate(trim({unit}), 'μµ−', 'uu-'))", BARE_VOLUME)} THEN 'volume' WHEN position('%' IN {unit}) > 0 THEN 'percent'
  WHEN {canonical_unit(d, unit)} IN ({known}) THEN 'concentration' ELSE 'other' END"""


@operator("a61_within_type_dose_range", "reagents", min_n=3)
def within_type_dose_range(d: Dialect, min_n: int) -> str:
    return f"""
SELECT canonical, organoid_type, unit_c AS unit, count(*) AS n, min(value) AS min, max(value) AS max,
  {q('max(value) / min(value)', 2)} AS fold_range, {q('median(value)')} AS median, {q('stddev_pop(value) / avg(value)')} AS cv
FROM (SELECT canonical, organoid_type, {UNIT} AS unit_c, value FROM reagents WHERE value > 0) x
GROUP BY canonical, organoid_type, unit_c HAVING count(*) >= {min_n}"""


@operator("a28_concentration_stats", "reagents")
def concentration_stats(d: Dialect) -> str:
    return f"""
SELECT canonical, unit_c AS unit, count(value) AS n, {q('median(value)')} AS median, min(value) AS min, max(value) AS max,
  {q('coalesce(stddev_pop(value), 0e0)')} AS std
FROM (SELECT canonical, {UNIT} AS unit_c, value FROM reagents) x WHERE value IS NOT NULL GROUP BY canonical, unit_c"""


@operator("a28_concentration_heads", "reagents", k=50)
def concentration_heads(d: Dialect, k: int) -> str:
    return f"""
WITH u AS (SELECT canonical, {UNIT} AS unit_c, count(value) AS n FROM reagents GROUP BY canonical, {UNIT}),
dom AS (SELECT canonical, unit_c FROM (SELECT *, row_number() OVER (PARTITION BY canonical ORDER BY n DESC, unit_c) AS rn FROM u) x WHERE rn = 1)
SELECT r.canonical, count(*) AS n_total, count(r.value) AS n_with_value, max(dom.unit_c) AS dominant_unit, count(DISTINCT r.organoid_type) AS n_types
FROM reagents r JOIN dom ON dom.canonical = r.canonical GROUP BY r.canonical ORDER BY n_with_value DESC, r.canonical LIMIT {k}"""


@operator("a33_concentration_by_type", "reagents", wanted="almond")
def concentration_by_type(d: Dialect, wanted: str) -> str:
    from ..plans.dialect import text

    w = text(wanted.lower())
    return f"""
WITH pick AS (SELECT canonical FROM (SELECT canonical, count(*) AS n FROM reagents WHERE position({w} IN lower(canonical)) > 0 GROUP BY canonical) x
  ORDER BY CASE WHEN lower(canonical) = {w} THEN 0 ELSE 1 END, n DESC, canonical LIMIT 1)
SELECT r.canonical, r.organoid_type, {UNIT} AS unit, count(*) AS n, {q('median(r.value)')} AS median, min(r.value) AS min, max(r.value) AS max
FROM reagents r JOIN pick ON pick.canonical = r.canonical WHERE r.value IS NOT NULL GROUP BY r.canonical, r.organoid_type, {UNIT}"""


@operator("a38_concentration_deviation", "reagents", min_n=3, k=30)
def concentration_deviation(d: Dialect, min_n: int, k: int) -> str:
    return f"""
WITH v AS (SELECT canonical, {UNIT} AS unit_c, value FROM reagents WHERE value IS NOT NULL),
u AS (SELECT canonical, unit_c, count(*) AS n FROM v GROUP BY canonical, unit_c),
dom AS (SELECT canonical, unit_c FROM (SELECT *, row_number() OVER (PARTITION BY canonical ORDER BY n DESC, unit_c) AS rn FROM u) x WHERE rn = 1)
SELECT v.canonical, v.unit_c AS dominant_unit, count(*) AS n_with_value, CASE WHEN count(*) < 10 THEN 1 ELSE 0 END AS low_n_warning,
  {q('avg(value)')} AS mean, {q('median(value)')} AS median, {q('stddev_samp(value)')} AS std, {q('stddev_samp(value) / avg(value)')} AS cv, min(value) AS min, max(value) AS max
FROM v JOIN dom ON dom.canonical = v.canonical AND dom.unit_c = v.unit_c
GROUP BY v.canonical, v.unit_c HAVING count(*) >= greatest(2, {min_n}) AND avg(value) <> 0 ORDER BY cv DESC, v.canonical LIMIT {k}"""


@operator("a45_unit_distribution", "reagents")
def unit_distribution(d: Dialect) -> str:
    return f"""
SELECT canonical, coalesce(canonical_unit, 'none') AS unit, n, {q('n * 1e2 / total', 1)} AS pct, min, {q('med')} AS median, max FROM (
  SELECT canonical, canonical_unit, count(*) AS n, sum(count(*)) OVER (PARTITION BY canonical) AS total, min(value) AS min, median(value) AS med, max(value) AS max
  FROM reagents WHERE value IS NOT NULL GROUP BY canonical, canonical_unit) x"""


@operator("a45_multi_unit_heads", "reagents", k=30)
def multi_unit_heads(d: Dialect, k: int) -> str:
    return f"""
SELECT canonical, n_units, n_records_total, dominant_unit, {q('top * 1e2 / n_records_total', 1)} AS dominant_pct FROM (
  SELECT canonical, count(*) AS n_units, sum(n) AS n_records_total, max(n) AS top, max(CASE WHEN rn = 1 THEN canonical_unit END) AS dominant_unit FROM (
    SELECT canonical, canonical_unit, n, row_number() OVER (PARTITION BY canonical ORDER BY n DESC, canonical_unit) AS rn FROM (
      SELECT canonical, canonical_unit, count(*) AS n FROM reagents WHERE value IS NOT NULL AND canonical_unit IS NOT NULL GROUP BY canonical, canonical_unit) x) y
  GROUP BY canonical HAVING count(*) > 1) z ORDER BY n_units DESC, n_records_total DESC, canonical LIMIT {k}"""


def _medians(min_n: int) -> str:
    return f"""SELECT canonical, {UNIT} AS unit_c, organoid_type, count(*) AS n, median(value) AS med, min(value) AS lo, max(value) AS hi
  FROM reagents WHERE value > 0 GROUP BY canonical, {UNIT}, organoid_type HAVING count(*) >= {min_n}"""


@operator("a53_cross_type_variance", "reagents", min_n=3, min_types=3)
def cross_type_variance(d: Dialect, min_n: int, min_types: int) -> str:
    return f"""
SELECT canonical, unit_c AS unit, count(*) AS n_types, {q('max(med) / min(med)', 2)} AS max_to_min_ratio,
  max(CASE WHEN rh = 1 THEN organoid_type END) AS high_type, max(CASE WHEN rl = 1 THEN organoid_type END) AS low_type FROM (
  SELECT *, row_number() OVER (PARTITION BY canonical, unit_c ORDER BY med DESC, organoid_type) AS rh,
    row_number() OVER (PARTITION BY canonical, unit_c ORDER BY med, organoid_type) AS rl FROM ({_medians(min_n)}) x) y
GROUP BY canonical, unit_c HAVING count(*) >= {min_types}"""


@operator("a53_cross_type_detail", "reagents", min_n=3)
def cross_type_detail(d: Dialect, min_n: int) -> str:
    return f"SELECT canonical, unit_c AS unit, organoid_type, n, {q('med')} AS median, lo AS min, hi AS max FROM ({_medians(min_n)}) x"


@operator("a55_unit_normalization", "reagents")
def unit_normalization(d: Dialect) -> str:
    return """
SELECT coalesce(canonical_unit, 'none') AS canonical_unit, coalesce(unit, 'none') AS raw_unit, count(*) AS n,
  sum(count(*)) OVER (PARTITION BY coalesce(canonical_unit, 'none')) AS n_records, count(*) OVER (PARTITION BY coalesce(canonical_unit, 'none')) AS n_raw_strings
FROM reagents GROUP BY coalesce(canonical_unit, 'none'), coalesce(unit, 'none')"""


@operator("a58_value_rate", "reagents", min_n=5, k=30)
def value_rate(d: Dialect, min_n: int, k: int) -> str:
    return f"""
SELECT canonical, n_with_value, n_total, value_rate, side, side_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY side ORDER BY CASE WHEN side = 'highest' THEN -value_rate ELSE value_rate END, n_total DESC, canonical) AS side_rank FROM (
    SELECT r.*, s.side FROM (SELECT canonical, count(value) AS n_with_value, count(*) AS n_total, {rate('count(value)', 'count(*)')} AS value_rate
      FROM reagents GROUP BY canonical HAVING count(*) >= {min_n}) r CROSS JOIN (SELECT 'highest' AS side UNION ALL SELECT 'lowest') s) x) y
WHERE side_rank <= {k}"""


@operator("b08_dose_consistency", "reagents")
def dose_consistency(d: Dialect) -> str:
    return f"""
SELECT pmcid, canonical, unit_c AS canonical_unit, value, {q('med')} AS median, {q('value / med')} AS ratio,
  CASE WHEN value / med > 10 THEN 'high' ELSE 'low' END AS flag FROM (
  SELECT pmcid, canonical, unit_c, value, m.med FROM (SELECT pmcid, canonical, {UNIT} AS unit_c, value FROM reagents WHERE value > 0) v
  JOIN (SELECT canonical AS c, {UNIT} AS u, median(value) AS med, count(*) AS n FROM reagents WHERE value > 0 GROUP BY canonical, {UNIT}) m
    ON m.c = v.canonical AND m.u = v.unit_c WHERE m.n >= 2) x
WHERE value / med > 10 OR value / med < 1e-1"""


@operator("b09_unit_audit", "mentions")
def unit_audit(d: Dialect) -> str:
    """Validity class, canonical unit and UCUM code of the units of dosed mentions; all classes but
    `concentration` and `missing` are suspect."""
    klass, code = concentration_class(d, "unit"), d.lookup("canonical", UCUM)
    return f"""
SELECT class, canonical AS unit, ucum, count(*) AS n, sum(CASE WHEN class IN ('in_vivo_dose', 'volume', 'percent', 'other') THEN 1 ELSE 0 END) AS n_suspect,
  {rate('count(ucum)', 'count(*)')} AS ucum_rate
FROM (SELECT class, canonical, {code} AS ucum FROM (SELECT {klass} AS class, {canonical_unit(d, 'unit')} AS canonical FROM mentions WHERE value IS NOT NULL) x) y
GROUP BY class, canonical, ucum"""


@operator("x04_canonical_unit", "mentions")
def canonical_units(d: Dialect) -> str:
    """Units as written, their canonical form, and what the extraction step alone would fold."""
    folded = d.lookup("lower(trim(unit))", EXTRACTED_UNITS, "trim(unit)")
    return f"SELECT unit, {canonical_unit(d, 'unit')} AS canonical, {folded} AS extracted, count(*) AS n FROM mentions GROUP BY unit, {canonical_unit(d, 'unit')}, {folded}"
