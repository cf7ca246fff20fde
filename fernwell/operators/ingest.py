"""Gates, verdicts and chunks of incoming candidates."""

from __future__ import annotations

from ..functions.vocabulary import TORTURED, TYPE_ALIASES
from ..plans.dialect import Dialect, operator, q, rate
from .quality_reports import public_license


@operator("i01_candidate_select", "manuscripts", "known_papers")
def candidate_select(d: Dialect) -> str:
    """Manuscripts that the corpus (papers with extracted, grounded reagents) has by neither key, with
    methods and a public licence."""
    return f"""
WITH corpus AS (SELECT pmcid, doi FROM known_papers)
SELECT c.pmcid, c.organoid_type FROM manuscripts c WHERE c.has_methods = 'yes' AND {public_license(d, 'c.license')}
  AND NOT EXISTS (SELECT 1 FROM corpus x WHERE upper(trim(x.pmcid)) = upper(trim(c.pmcid))) AND NOT EXISTS (SELECT 1 FROM corpus x WHERE lower(trim(x.doi)) = lower(trim(c.doi)))"""


@operator("i02_qc_verdict", "protocols")
def qc_verdict(d: Dialect) -> str:
    v = """CASE WHEN n_signaling_factors = 0 THEN 'no_factors' WHEN species IS NULL THEN 'no_species' WHEN coalesce(grounding_rate, 0) < 0.3 THEN 'low_grounding'
  WHEN license IS NULL THEN 'no_license' ELSE 'accepted' END"""
    return f"SELECT {v} AS verdict, count(*) AS n, {rate('count(*)', 'sum(count(*)) OVER ()')} AS share FROM protocols GROUP BY {v}"


def strict_license(d: Dialect, c: str = "license") -> str:
    """The stricter gate: a CC-BY or CC0 beginning, and no part that is nc or nd."""
    code = f"replace(replace(lower(trim({c})), '_', '-'), ' ', '-')"
    return f"(coalesce({c}, '') <> '' AND ({code} LIKE 'cc-by%' OR {code} LIKE 'cc0%' OR {code} LIKE 'ccby%') AND concat('-', {code}, '-') NOT LIKE '%-nc-%' AND concat('-', {code}, '-') NOT LIKE '%-nd-%')"


def discovery_license(d: Dialect, c: str = "license") -> str:
    """Discovery's spelling: CC0, CC-BY-NC, CC-BY (ND and SA variants included) or unknown."""
    s = d.sub(f"replace(replace(lower(trim({c})), '_', ' '), '-', ' ')", r"\s+", " ")
    return f"""CASE WHEN coalesce({c}, '') = '' THEN 'unknown' WHEN position('cc0' IN {s}) > 0 OR position('public domain' IN {s}) > 0 THEN 'CC0'
  WHEN position('cc by' IN {s}) > 0 OR {s} = 'ccby' THEN CASE WHEN concat(' ', {s}, ' ') LIKE '% nc %' THEN 'CC-BY-NC' ELSE 'CC-BY' END ELSE 'unknown' END"""


def verified_license(d: Dialect, c: str = "license") -> str:
    """The verifier's spelling, which keeps NC and ND apart."""
    s = f"replace(replace(upper(trim({c})), ' ', '-'), '_', '-')"
    return f"""CASE WHEN coalesce(trim({c}), '') = '' THEN 'unknown' WHEN {s} LIKE 'CC0%' OR {s} = 'CC-ZERO' THEN 'CC0' WHEN position('CC-BY-NC-ND' IN {s}) > 0 THEN 'CC-BY-NC-ND'
  WHEN position('CC-BY-NC' IN {s}) > 0 THEN 'CC-BY-NC' WHEN position('CC-BY-ND' IN {s}) > 0 THEN 'CC-BY-ND' WHEN position('CC-BY-SA' IN {s}) > 0 OR {s} LIKE 'CC-BY%' THEN 'CC-BY'
  WHEN position('AUTHOR' IN {s}) > 0 OR position('MANUSCRIPT' IN {s}) > 0 OR position('NIHMS' IN {s}) > 0 THEN 'author-manuscript' ELSE 'unknown' END"""


@operator("f10_license_gates", "manuscripts")
def license_gates(d: Dialect) -> str:
    """The two gates (F10, F11) and both spellings (X20) of each licence text."""
    return f"""
SELECT license, CASE WHEN {public_license(d)} THEN 1 ELSE 0 END AS public, CASE WHEN {strict_license(d)} THEN 1 ELSE 0 END AS strict, {discovery_license(d)} AS discovery, {verified_license(d)} AS verified, count(*) AS n
FROM manuscripts GROUP BY license"""


@operator("i03_authorization", "manuscripts", "known_papers", types=("intestinal", "liver", "kidney", "brain", "lung", "retina"))
def authorization(d: Dialect, types: tuple[str, ...]) -> str:
    """Nine ordered rules: the first that holds decides."""
    known = ", ".join(f"'{t}'" for t in types)
    rules = (
        ("coalesce(trim(m.pmcid), '') = ''", "blocked", "no_key"), (f"NOT {strict_license(d, 'm.license')}", "blocked", "license"), ("a.k IS NOT NULL", "blocked", "in_corpus_by_pmcid"),
        ("b.k IS NOT NULL", "blocked", "in_corpus_by_doi"), ("m.tier = 'tier3' AND coalesce(m.human_confirmed, '') <> 'true'", "blocked", "tier3_not_confirmed"),
        ("m.sem_score < 3e-1", "review_required", "low_relevance"), ("m.grounding_rate < 4e-1", "review_required", "low_grounding"),
        (f"coalesce(m.organoid_type, '') NOT IN ({known})", "review_required", "unknown_type"), ("coalesce(m.has_methods, '') <> 'yes'", "review_required", "no_methods"),
    )
    cases = lambda k, last: "CASE " + " ".join(f"WHEN {r[0]} THEN '{r[k]}'" for r in rules) + f" ELSE '{last}' END"
    return f"""
SELECT decision, rule, count(*) AS n, min(pmcid) AS example FROM (SELECT m.pmcid, {cases(1, 'auto_ingest')} AS decision, {cases(2, 'all_checks_passed')} AS rule FROM manuscripts m
  LEFT JOIN (SELECT DISTINCT upper(trim(pmcid)) AS k FROM known_papers) a ON a.k = upper(trim(m.pmcid))
  LEFT JOIN (SELECT DISTINCT lower(trim(doi)) AS k FROM known_papers WHERE doi <> '') b ON b.k = lower(trim(m.doi))) x GROUP BY decision, rule"""


@operator("i04_type_assignment", "manuscripts", queries=(("intestin", "intestinal"), ("liver", "liver"), ("hepat", "liver"), ("kidney", "kidney"), ("organoid", "other")))
def type_assignment(d: Dialect, queries: tuple[tuple[str, str], ...]) -> str:
    """The type of the first query, in the order of priority, that a title has."""
    cases = lambda k: "CASE " + " ".join(f"WHEN position('{w}' IN lower(title)) > 0 THEN {(i + 1, repr(t))[k]}" for i, (w, t) in enumerate(queries)) + " END"
    return f"SELECT pmcid, {cases(1)} AS organoid_type, {cases(0)} AS priority FROM manuscripts WHERE {cases(0)} IS NOT NULL"


@operator("i05_citation_expansion", "lineage", "manuscripts", "known_papers")
def citation_expansion(d: Dialect) -> str:
    """Papers that the corpus cites, enriched, once each, that it does not have."""
    return """
SELECT l.cited AS pmcid, count(*) AS n_citing, min(l.source) AS first_citing, max(p.organoid_type) AS organoid_type FROM lineage l JOIN manuscripts p ON p.pmcid = concat('PMC', l.cited)
WHERE NOT EXISTS (SELECT 1 FROM known_papers c WHERE upper(c.pmcid) = concat('PMC', l.cited)) GROUP BY l.cited"""


@operator("i06_license_pool", "manuscripts")
def license_pool(d: Dialect) -> str:
    """Verified licences: public, unknown ones in quarantine, others rejected; and where discovery's
    spelling said otherwise."""
    v, w = verified_license(d), discovery_license(d)
    return f"""
SELECT pool, verified, count(*) AS n, sum(CASE WHEN verified <> discovery THEN 1 ELSE 0 END) AS n_mismatch FROM (
  SELECT CASE WHEN verified = 'unknown' THEN 'quarantine' WHEN verified IN ('CC0', 'CC-BY') THEN 'public_ok' ELSE 'rejected' END AS pool, verified, discovery
  FROM (SELECT {v} AS verified, {w} AS discovery FROM manuscripts) x) y GROUP BY pool, verified"""


@operator("i07_relabel_types", "manuscripts", types=("intestinal", "liver", "kidney", "brain", "lung", "other"))
def relabel_types(d: Dialect, types: tuple[str, ...]) -> str:
    """Aliases folded; a known specific type stays, `other` is rescued by discovery's label."""
    known = ", ".join(f"'{t}'" for t in types)
    folded = lambda c: d.lookup(f"lower(trim(coalesce({c}, '')))", TYPE_ALIASES, f"lower(trim(coalesce({c}, '')))")
    return f"""
SELECT old_type, new_type, count(*) AS n, sum(CASE WHEN coalesce(old_type, '') <> new_type THEN 1 ELSE 0 END) AS n_changed FROM (
  SELECT old_type, CASE WHEN t NOT IN ('', 'other') AND t IN ({known}) THEN t WHEN f IN ({known}) THEN f WHEN t <> '' THEN t ELSE 'other' END AS new_type
  FROM (SELECT organoid_type AS old_type, {folded('organoid_type')} AS t, {folded('discovery_type')} AS f FROM manuscripts) x) y GROUP BY old_type, new_type"""


@operator("i08_discovery_map", "lineage")
def discovery_map(d: Dialect) -> str:
    """The first non-empty value of each key over pools."""
    return """
SELECT pmcid, found FROM (SELECT pmcid, found, row_number() OVER (PARTITION BY pmcid ORDER BY pool, found) AS rn FROM (
  SELECT source AS pmcid, 1 AS pool, cited AS found FROM lineage UNION ALL SELECT cited, 2, source FROM lineage) x WHERE found IS NOT NULL AND found <> '') y WHERE rn = 1"""


@operator("i09_chunks", "protocols", size=400)
def chunks(d: Dialect, size: int) -> str:
    """Newest first in chunks of a size, and how far a year's papers spread over them. Ranks are
    made within the year and shifted by the counts of later years, so that no task ranks all."""
    return f"""
WITH y AS (SELECT year, count(*) AS n FROM protocols WHERE year IS NOT NULL GROUP BY year),
o AS (SELECT a.year, coalesce(sum(b.n), 0) AS before FROM y a LEFT JOIN y b ON b.year > a.year GROUP BY a.year),
r AS (SELECT p.pmcid, p.year, o.before + row_number() OVER (PARTITION BY p.year ORDER BY p.pmcid) AS rn FROM protocols p JOIN o ON o.year = p.year)
SELECT CAST(floor((rn - 1) / {size}) AS BIGINT) AS chunk, count(*) AS n, max(year) AS newest, min(year) AS oldest, min(pmcid) AS first_pmcid FROM r GROUP BY CAST(floor((rn - 1) / {size}) AS BIGINT)"""


#: A record of type retraction, an update of such a type, or a notice that retracts it.
RETRACTED = r'(?i)^\{"type":"(retraction|retracted-article)"|"update-to":\[[^\]]*"type":"[^"]*retract|"is-retracted-by":\[\s*[^\]\s]'


def title_words(d: Dialect, c: str) -> str:
    """The distinct words of a title without punctuation."""
    bare = f"trim({d.sub(f'lower({c})', '[^a-z0-9 ]', '')})"
    if d.spark:
        return f"filter(array_distinct(split(coalesce({bare}, ''), ' ')), w -> w <> '')"
    return f"list_filter(list_distinct(string_split(coalesce({bare}, ''), ' ')), lambda w: w <> '')"


@operator("i10_integrity_screen", "manuscripts", least=0.6)
def integrity_screen(d: Dialect, least: float) -> str:
    """Papers by screen: retracted by the registry, not resolved there, a title that agrees with the
    registry's in too few words, a tortured phrase; and the share that no screen flags."""
    retracted = f"({d.matches('registry', RETRACTED)})"
    n = (lambda a, b: f"size(array_intersect({a}, {b}))") if d.spark else (lambda a, b: f"len(list_intersect({a}, {b}))")
    size = "size" if d.spark else "len"
    a, b = title_words(d, "title"), title_words(d, "registry_title")
    share = f"CAST({n('a', 'b')} AS DOUBLE) / nullif({size}(a) + {size}(b) - {n('a', 'b')}, 0)"
    tortured = " OR ".join(f"position('{p}' IN lower(coalesce(body, ''))) > 0" for p in TORTURED)
    flags = "CASE WHEN retracted THEN 1 ELSE 0 END AS r, CASE WHEN unresolved THEN 1 ELSE 0 END AS u, CASE WHEN NOT unresolved AND coalesce(agree, 0) < {0} THEN 1 ELSE 0 END AS t, CASE WHEN tortured THEN 1 ELSE 0 END AS p".format(least)
    return f"""
SELECT count(*) AS n, sum(r) AS n_retracted, sum(u) AS n_unresolved, sum(t) AS n_title_mismatch, sum(p) AS n_tortured, {rate('sum(CASE WHEN r + u + t + p = 0 THEN 1 ELSE 0 END)', 'count(*)')} AS clean_rate
FROM (SELECT {flags} FROM (SELECT {retracted} AS retracted, registry IS NULL AS unresolved, {share} AS agree, ({tortured}) AS tortured FROM (
  SELECT registry, body, {a} AS a, {b} AS b FROM manuscripts) w) x) y"""


@operator("j16_precedence_union", "mentions", "manuscripts")
def precedence_union(d: Dialect) -> str:
    """Local rows win; public ones fill what is not there."""
    return """
WITH local AS (SELECT pmcid, min(unit) AS value FROM mentions WHERE kind = 'signaling' AND value IS NOT NULL GROUP BY pmcid), pub AS (SELECT pmcid, matrix AS value FROM manuscripts)
SELECT pmcid, coalesce(value, 'none') AS value, 'local' AS origin FROM local
UNION ALL SELECT p.pmcid, coalesce(p.value, 'none'), 'public' FROM pub p WHERE NOT EXISTS (SELECT 1 FROM local l WHERE l.pmcid = p.pmcid)"""


@operator("j17_fallback_join", "figures", "captions")
def fallback_join(d: Dialect) -> str:
    """Figures and captions by the file's base name, else by the label."""
    return f"""
SELECT CASE WHEN a.graphic IS NOT NULL THEN 'file' WHEN b.label IS NOT NULL THEN 'label' ELSE 'none' END AS matched_by, count(*) AS n, count(DISTINCT f.pmcid) AS n_papers
FROM figures f LEFT JOIN (SELECT DISTINCT pmcid, graphic FROM captions) a ON a.pmcid = f.pmcid AND a.graphic = {d.sub('f.file', '[.][a-z]+$', '')}
LEFT JOIN (SELECT DISTINCT pmcid, label FROM captions WHERE label <> '') b ON b.pmcid = f.pmcid AND b.label = f.label
GROUP BY CASE WHEN a.graphic IS NOT NULL THEN 'file' WHEN b.label IS NOT NULL THEN 'label' ELSE 'none' END"""


@operator("j04_anti_join", "customer", "orders")
def anti_join(d: Dialect) -> str:
    return "SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)"


@operator("s21_merge_on_key", "protocols", "mentions")
def merge_on_key(d: Dialect) -> str:
    """Prior rows that were not made again, and the fresh ones."""
    return """
WITH prior AS (SELECT concat('PMC', pmcid) AS pmcid, n_signaling_factors AS v FROM protocols), fresh AS (SELECT pmcid, count(*) AS v FROM mentions WHERE kind = 'signaling' AND quote <> '' GROUP BY pmcid)
SELECT p.pmcid, p.v, 'prior' AS origin FROM prior p WHERE NOT EXISTS (SELECT 1 FROM fresh f WHERE f.pmcid = p.pmcid) UNION ALL SELECT pmcid, v, 'fresh' FROM fresh"""


@operator("f13_plausible_years", "protocols")
def plausible_years(d: Dialect) -> str:
    y = "try_cast(substring(CAST(year AS STRING), 1, 4) AS INT)"
    return f"SELECT CASE WHEN {y} BETWEEN 1990 AND 2027 THEN {y} END AS clean_year, count(*) AS n, {q('avg(total)', 0)} AS mean_total FROM protocols GROUP BY CASE WHEN {y} BETWEEN 1990 AND 2027 THEN {y} END"
