"""Which reagents occur where: set, pair, lookup and naming operators.

Pairs come from an inverted join on the paper, with sizes from counts, never from all pairs of
names; names below the wanted support are dropped before the join, as no pair can have more."""

from __future__ import annotations

from ..functions.vocabulary import MERGE_BREAK, MERGE_PREFIX, MERGE_STOP_WORDS, ROLES
from ..plans.dialect import Dialect, operator, q, rate, text
from .breakdowns import typed

def _named(c: str = "canonical") -> str:
    return f"coalesce(nullif(trim({c}), ''), name)"


@operator("a14_reagent_lookup", "reagents", wanted="almond")
def reagent_lookup(d: Dialect, wanted: str) -> str:
    w = text(wanted.lower())
    return f"""
SELECT canonical, count(*) AS n_records, count(DISTINCT pmcid) AS n_papers, count(DISTINCT organoid_type) AS n_types, count(value) AS n_with_value,
  min(value) AS min, max(value) AS max, {q('median(value)')} AS median, CASE WHEN count(value) >= 2 THEN {q('stddev_samp(value) / avg(value)')} END AS cv,
  {rate('sum(grounded)', 'count(*)')} AS grounding_rate, sum(figure_confirmed) AS figure_confirmed_count
FROM reagents WHERE position({w} IN lower(canonical)) > 0 OR position({w} IN lower(name)) > 0 GROUP BY canonical
ORDER BY n_papers DESC, canonical LIMIT 10"""


@operator("a14_lookup_usage", "reagents", wanted="almond")
def lookup_usage(d: Dialect, wanted: str) -> str:
    w = text(wanted.lower())
    return f"""
SELECT canonical, organoid_type, kind, count(*) AS n FROM reagents
WHERE position({w} IN lower(canonical)) > 0 OR position({w} IN lower(name)) > 0 GROUP BY canonical, organoid_type, kind"""


@operator("a14_lookup_examples", "reagents", wanted="almond", k=5)
def lookup_examples(d: Dialect, wanted: str, k: int) -> str:
    w = text(wanted.lower())
    return f"""
SELECT canonical, pmcid, quote FROM (
  SELECT canonical, pmcid, quote, row_number() OVER (PARTITION BY canonical ORDER BY pmcid) AS rn FROM (
    SELECT canonical, pmcid, min(substring(evidence_quote, 1, 300)) AS quote FROM reagents
    WHERE evidence_quote IS NOT NULL AND (position({w} IN lower(canonical)) > 0 OR position({w} IN lower(name)) > 0) GROUP BY canonical, pmcid) x) y
WHERE rn <= {k}"""


@operator("a15_reagent_network", "reagents", wanted="almond antique", k=20)
def reagent_network(d: Dialect, wanted: str, k: int) -> str:
    w = text(wanted.lower())
    n = f"lower({_named('variety')})"
    return f"""
WITH hit AS (SELECT DISTINCT pmcid FROM reagents WHERE {n} <> '' AND (position({w} IN {n}) > 0 OR position({n} IN {w}) > 0))
SELECT name_key, papers, row_number() OVER (ORDER BY papers DESC, name_key) AS name_rank FROM (
  SELECT {_named('variety')} AS name_key, count(*) AS papers FROM reagents r
  WHERE EXISTS (SELECT 1 FROM hit h WHERE h.pmcid = r.pmcid) AND {n} <> {w} AND {n} <> '' GROUP BY {_named('variety')}) x
ORDER BY papers DESC, name_key LIMIT {k}"""


def _essentials(fraction: float) -> str:
    return f"""
SELECT u.organoid_type, u.c AS canonical, {rate('u.n', 't.n')} AS fraction, u.n AS n_papers, t.n AS n_total_papers FROM (
  SELECT organoid_type, lower(canonical) AS c, count(DISTINCT pmcid) AS n FROM reagents WHERE {typed()} GROUP BY organoid_type, lower(canonical)) u
JOIN (SELECT organoid_type, count(DISTINCT pmcid) AS n FROM reagents WHERE {typed()} GROUP BY organoid_type) t ON t.organoid_type = u.organoid_type
WHERE CAST(u.n AS DOUBLE) / t.n >= {fraction}"""


@operator("a16_essential_reagents", "reagents", min_fraction=0.05)
def essential_reagents(d: Dialect, min_fraction: float) -> str:
    return _essentials(min_fraction)


@operator("a16_universal_reagents", "reagents", min_fraction=0.05)
def universal_reagents(d: Dialect, min_fraction: float) -> str:
    return f"""
SELECT canonical, count(*) AS n_types FROM ({_essentials(min_fraction)}) e GROUP BY canonical
HAVING count(*) * 2 >= (SELECT count(DISTINCT organoid_type) FROM reagents WHERE {typed()})"""


def _type_pairs(d: Dialect, **_) -> str:  # noqa: ANN003
    """Names that two types share and, as pairs with themselves, names of a type: types are gathered
    by name, and are few."""
    if d.spark:
        return """
SELECT p.a AS ta, p.b AS tb, count(*) AS n FROM (
  SELECT explode(flatten(transform(ts, a -> transform(ts, b -> struct(a AS a, b AS b))))) AS p
  FROM (SELECT lower(variety) AS c, collect_set(organoid_type) AS ts FROM reagents WHERE organoid_type IS NOT NULL AND variety IS NOT NULL GROUP BY lower(variety)) x) y GROUP BY p.a, p.b"""
    return """
SELECT x.t AS ta, y.t AS tb, count(*) AS n FROM (SELECT DISTINCT organoid_type AS t, lower(variety) AS c FROM reagents WHERE organoid_type IS NOT NULL AND variety IS NOT NULL) x
JOIN (SELECT DISTINCT organoid_type AS t, lower(variety) AS c FROM reagents WHERE organoid_type IS NOT NULL AND variety IS NOT NULL) y ON x.c = y.c GROUP BY x.t, y.t"""


@operator("a18_type_similarity", "reagents", steps={"type_pairs": _type_pairs}, top=5)
def type_similarity(d: Dialect, top: int) -> str:
    return f"""
WITH sizes AS (SELECT ta AS t, n FROM type_pairs WHERE ta = tb), shared AS (SELECT ta, tb, n FROM type_pairs WHERE ta <> tb)
SELECT organoid_type, other_type, jaccard, n_shared, n_union, type_rank FROM (
  SELECT ta AS organoid_type, tb AS other_type, {q('CAST(h.n AS DOUBLE) / (x.n + y.n - h.n)')} AS jaccard, h.n AS n_shared, x.n + y.n - h.n AS n_union,
    row_number() OVER (PARTITION BY ta ORDER BY CAST(h.n AS DOUBLE) / (x.n + y.n - h.n) DESC, tb) AS type_rank
  FROM shared h JOIN sizes x ON x.t = ta JOIN sizes y ON y.t = tb) z WHERE type_rank <= {top}"""


def _pair_counts(where: str):  # noqa: ANN202
    """Papers of each pair of names and, as pairs with themselves, of each name, in one scan: names
    are gathered by paper, which has few."""

    def plan(d: Dialect, **_) -> str:  # noqa: ANN003
        if d.spark:
            return f"""
SELECT p.a AS ca, p.b AS cb, count(*) AS n FROM (
  SELECT explode(flatten(transform(cs, a -> transform(filter(cs, b -> b >= a), b -> struct(a AS a, b AS b))))) AS p
  FROM (SELECT pmcid, collect_set(variety) AS cs FROM reagents WHERE {where} GROUP BY pmcid) x) y GROUP BY p.a, p.b"""
        return f"""
SELECT x.variety AS ca, y.variety AS cb, count(*) AS n FROM (SELECT DISTINCT pmcid, variety FROM reagents WHERE {where}) x
JOIN (SELECT DISTINCT pmcid, variety FROM reagents WHERE {where}) y ON x.pmcid = y.pmcid AND x.variety <= y.variety GROUP BY x.variety, y.variety"""

    return plan


@operator("a30_reagent_cooccurrence", "reagents", steps={"pair_counts": _pair_counts("kind = 'signaling' AND variety IS NOT NULL")}, min_papers=2)
def reagent_cooccurrence(d: Dialect, min_papers: int) -> str:
    return f"""
SELECT p.ca AS c_a, p.cb AS c_b, p.n AS n_papers, x.n AS n_papers_a, y.n AS n_papers_b, {q('CAST(p.n AS DOUBLE) / (x.n + y.n - p.n)')} AS jaccard
FROM pair_counts p JOIN pair_counts x ON x.ca = p.ca AND x.cb = p.ca JOIN pair_counts y ON y.ca = p.cb AND y.cb = p.cb WHERE p.ca < p.cb AND p.n >= {min_papers}"""


@operator("a31_type_comparison", "reagents", a="NATION_1", b="NATION_2")
def type_comparison(d: Dialect, a: str, b: str) -> str:
    in_a, in_b = (f"count(CASE WHEN organoid_type = {text(x)} THEN 1 END)" for x in (a, b))
    return f"""
SELECT variety AS canonical, CASE WHEN {in_a} > 0 AND {in_b} > 0 THEN 'shared' WHEN {in_a} > 0 THEN 'only_a' ELSE 'only_b' END AS membership,
  {d.joined_set('kind')} AS kinds, count(*) AS n_records FROM reagents WHERE organoid_type IN ({text(a)}, {text(b)}) GROUP BY variety"""


@operator("a31_comparison_head", "reagents", a="NATION_1", b="NATION_2")
def comparison_head(d: Dialect, a: str, b: str) -> str:
    return f"""
SELECT sum(CASE WHEN m = 3 THEN 1 ELSE 0 END) AS n_shared, sum(CASE WHEN m = 1 THEN 1 ELSE 0 END) AS n_only_a, sum(CASE WHEN m = 2 THEN 1 ELSE 0 END) AS n_only_b,
  count(*) AS n_union, {rate('sum(CASE WHEN m = 3 THEN 1 ELSE 0 END)', 'count(*)')} AS jaccard FROM (
  SELECT variety, max(CASE WHEN organoid_type = {text(a)} THEN 1 ELSE 0 END) + 2 * max(CASE WHEN organoid_type = {text(b)} THEN 1 ELSE 0 END) AS m
  FROM reagents WHERE organoid_type IN ({text(a)}, {text(b)}) GROUP BY variety) x"""


@operator("a34_reagent_prevalence", "reagents", min_types=1)
def reagent_prevalence(d: Dialect, min_types: int) -> str:
    return f"""
SELECT variety AS canonical, count(DISTINCT organoid_type) AS n_types, count(*) AS n_records, {d.joined_set('organoid_type')} AS types
FROM reagents WHERE variety IS NOT NULL AND organoid_type IS NOT NULL GROUP BY variety HAVING count(DISTINCT organoid_type) >= {min_types}"""


@operator("a34_prevalence_breadth", "reagents")
def prevalence_breadth(d: Dialect) -> str:
    return """
SELECT n_types, count(*) AS n_canonicals, CASE WHEN n_types >= 20 THEN 'cross_field' WHEN n_types <= 2 THEN 'specialist' ELSE 'middle' END AS breadth FROM (
  SELECT variety, count(DISTINCT organoid_type) AS n_types FROM reagents WHERE variety IS NOT NULL GROUP BY variety) x GROUP BY n_types"""


@operator("a41_supplement_breakdown", "reagents", top=10)
def supplement_breakdown(d: Dialect, top: int) -> str:
    return f"""
SELECT organoid_type, canonical, n_papers, type_rank FROM (
  SELECT organoid_type, canonical, n_papers, row_number() OVER (PARTITION BY organoid_type ORDER BY n_papers DESC, canonical) AS type_rank FROM (
    SELECT organoid_type, variety AS canonical, count(DISTINCT pmcid) AS n_papers FROM reagents WHERE kind = 'supplement' GROUP BY organoid_type, variety) x) y
WHERE type_rank <= {top}"""


@operator("a41_cross_type_supplements", "reagents", min_types=5)
def cross_type_supplements(d: Dialect, min_types: int) -> str:
    return f"""
SELECT variety AS canonical, count(DISTINCT pmcid) AS n_papers, count(DISTINCT organoid_type) AS n_types FROM reagents
WHERE kind = 'supplement' GROUP BY variety HAVING count(DISTINCT organoid_type) >= {min_types}"""


def role_of(d: Dialect, c: str = "role") -> str:
    known = d.lookup(f"lower(trim({c}))", ROLES, "'other'")
    return f"CASE WHEN {c} IS NULL OR lower(trim({c})) IN ('', 'null', 'not stated') THEN 'not_stated' ELSE {known} END"


@operator("a42_role_breakdown", "mentions")
def role_breakdown(d: Dialect) -> str:
    return f"""
SELECT CASE WHEN grouping(t) = 1 THEN 'cross' ELSE 'type' END AS level, coalesce(t, '*') AS organoid_type, r AS role, count(*) AS n_records,
  {q('count(*) * 1e2 / sum(count(*)) OVER (PARTITION BY grouping(t), t)', 1)} AS pct
FROM (SELECT organoid_type AS t, {role_of(d)} AS r FROM mentions WHERE kind = 'signaling') x GROUP BY GROUPING SETS ((t, r), (r))"""


@operator("a42_role_tops", "mentions", k=50)
def role_tops(d: Dialect, k: int) -> str:
    return f"""
SELECT role, canonical, n_papers, n_records FROM (
  SELECT role, canonical, n_papers, n_records, row_number() OVER (PARTITION BY role ORDER BY n_papers DESC, canonical) AS rn FROM (
    SELECT {role_of(d)} AS role, coalesce(name, '') AS canonical, count(DISTINCT pmcid) AS n_papers, count(*) AS n_records FROM mentions WHERE kind = 'signaling'
    GROUP BY {role_of(d)}, coalesce(name, '')) x) y WHERE rn <= {k}"""


@operator("a43_type_reagent_heatmap", "reagents", top=20)
def type_reagent_heatmap(d: Dialect, top: int) -> str:
    return f"""
WITH n AS (SELECT organoid_type AS t, canonical AS c, count(DISTINCT pmcid) AS n FROM reagents WHERE kind = 'signaling' AND {typed()} GROUP BY organoid_type, canonical),
tops AS (SELECT canonical AS c, count(DISTINCT pmcid) AS total FROM reagents WHERE kind = 'signaling' AND {typed()} GROUP BY canonical ORDER BY total DESC, c LIMIT {top})
SELECT types.t AS organoid_type, tops.c AS canonical, coalesce(n.n, 0) AS n_papers, tops.total AS n_papers_total
FROM (SELECT DISTINCT t FROM n) types CROSS JOIN tops LEFT JOIN n ON n.t = types.t AND n.c = tops.c"""


@operator("a44_name_variants", "reagents", min_variants=2, k=30)
def name_variants(d: Dialect, min_variants: int, k: int) -> str:
    return f"""
SELECT canonical, count(DISTINCT name) AS n_variants, count(*) AS n_records, {d.joined_set('name')} AS names FROM reagents
GROUP BY canonical HAVING count(DISTINCT name) >= {min_variants} ORDER BY n_variants DESC, n_records DESC, canonical LIMIT {k}"""


@operator("a47_source_cell_profile", "reagents", "protocols", k=20)
def source_cell_profile(d: Dialect, k: int) -> str:
    return f"""
WITH dim AS (SELECT doi, max(source_cell_type) AS source FROM protocols WHERE source_cell_type <> '' GROUP BY doi),
n AS (SELECT dim.source, r.variety AS c, count(DISTINCT r.doi) AS n FROM reagents r JOIN dim ON dim.doi = r.doi GROUP BY dim.source, r.variety)
SELECT source, canonical, n_papers, exclusive, source_rank FROM (
  SELECT source, c AS canonical, n AS n_papers, CASE WHEN count(*) OVER (PARTITION BY c) = 1 THEN 1 ELSE 0 END AS exclusive,
    row_number() OVER (PARTITION BY source ORDER BY n DESC, c) AS source_rank FROM n) x WHERE source_rank <= {k}"""


def _source_names(d: Dialect, min_papers: int) -> str:
    return f"""
SELECT dim.source AS s, r.variety AS c FROM reagents r JOIN (SELECT doi, max(source_cell_type) AS source FROM protocols WHERE source_cell_type <> '' GROUP BY doi) dim
ON dim.doi = r.doi GROUP BY dim.source, r.variety HAVING count(DISTINCT r.doi) >= {min_papers}"""


@operator("a47_source_cell_jaccard", "reagents", "protocols", steps={"source_names": _source_names}, min_papers=2)
def source_cell_jaccard(d: Dialect, min_papers: int) -> str:
    return f"""
WITH sizes AS (SELECT s, count(*) AS n FROM source_names GROUP BY s)
SELECT a.s AS source_a, b.s AS source_b, count(*) AS shared_n, {q('CAST(count(*) AS DOUBLE) / (max(x.n) + max(y.n) - count(*))')} AS jaccard
FROM source_names a JOIN source_names b ON a.c = b.c AND a.s < b.s JOIN sizes x ON x.s = a.s JOIN sizes y ON y.s = b.s GROUP BY a.s, b.s"""


def _typed_papers(d: Dialect, **_) -> str:  # noqa: ANN003
    return f"SELECT doi, max(organoid_type) AS t FROM protocols WHERE {typed()} GROUP BY doi"


def _name_counts(d: Dialect, **_) -> str:  # noqa: ANN003
    """Papers of each name, in all (t null) and by type, in one pass over the reagents."""
    return """
SELECT c, t, count(DISTINCT doi) AS n, min(kind) AS kind, grouping(t) AS overall FROM (
  SELECT x.doi, x.variety AS c, dim.t, x.kind FROM reagents x JOIN typed_papers dim ON dim.doi = x.doi) y GROUP BY GROUPING SETS ((c, t), (c))"""


@operator("a52_type_enrichment", "reagents", "protocols", steps={"typed_papers": _typed_papers, "name_counts": _name_counts}, min_n=3)
def type_enrichment(d: Dialect, min_n: int) -> str:
    return f"""
WITH dim AS (SELECT * FROM typed_papers), ct AS (SELECT c, t, n, kind FROM name_counts WHERE overall = 0 AND n >= {min_n}),
cg AS (SELECT c, n FROM name_counts WHERE overall = 1), tt AS (SELECT t, count(*) AS n FROM dim GROUP BY t), g AS (SELECT count(*) AS n FROM dim)
SELECT canonical, organoid_type, n_type_papers, n_global_papers, n_type_protocols, {q('type_rate', 6)} AS type_rate, {q('global_rate', 6)} AS global_rate,
  {q('type_rate / global_rate')} AS enrichment_ratio, kind FROM (
  SELECT ct.c AS canonical, ct.t AS organoid_type, ct.n AS n_type_papers, cg.n AS n_global_papers, tt.n AS n_type_protocols,
    CAST(ct.n AS DOUBLE) / tt.n AS type_rate, CAST(cg.n AS DOUBLE) / g.n AS global_rate, ct.kind
  FROM ct JOIN cg ON cg.c = ct.c JOIN tt ON tt.t = ct.t CROSS JOIN g) x WHERE type_rate > global_rate"""


@operator("a57_kind_ambiguity", "reagents", min_n=3)
def kind_ambiguity(d: Dialect, min_n: int) -> str:
    s, u = "sum(CASE WHEN kind = 'signaling' THEN 1 ELSE 0 END)", "sum(CASE WHEN kind = 'supplement' THEN 1 ELSE 0 END)"
    return f"""
SELECT canonical, n_signaling, n_supplement, n_signaling + n_supplement AS n_total, CASE WHEN n_signaling >= n_supplement THEN 'signaling' ELSE 'supplement' END AS dominant_kind,
  {rate('least(n_signaling, n_supplement)', '(n_signaling + n_supplement)')} AS minority_fraction FROM (
  SELECT variety AS canonical, {s} AS n_signaling, {u} AS n_supplement FROM reagents GROUP BY variety) x
WHERE n_signaling > 0 AND n_supplement > 0 AND n_signaling + n_supplement >= {min_n}"""


def normal_form(d: Dialect, c: str) -> str:
    """The prefix dropped, then the words that tell names apart, by blanks."""
    bare = d.sub(f"lower(trim({c}))", MERGE_PREFIX, "") if d.spark else f"regexp_replace(lower(trim({c})), {text(MERGE_PREFIX)}, '')"
    stop = ", ".join(text(w) for w in ("", *MERGE_STOP_WORDS))
    if d.spark:
        return f"array_join(filter(split({bare}, {d.pattern(MERGE_BREAK)}), w -> w NOT IN ({stop})), ' ')"
    return f"array_to_string(list_filter(regexp_split_to_array({bare}, {text(MERGE_BREAK)}), lambda w: w NOT IN ({stop})), ' ')"


@operator("a60_merge_candidates", "mentions", min_records=2)
def merge_candidates(d: Dialect, min_records: int) -> str:
    return f"""
SELECT normalized_form, count(*) AS n_canonicals, sum(n) AS total_records, {d.joined_set('c')} AS members FROM (
  SELECT {normal_form(d, 'name')} AS normalized_form, name AS c, count(*) AS n FROM mentions WHERE name IS NOT NULL GROUP BY {normal_form(d, 'name')}, name) x
WHERE normalized_form <> ''
GROUP BY normalized_form HAVING count(*) >= 2 AND sum(n) >= {min_records}"""


@operator("r13_factor_heatmap", "reagents", min_types=5)
def factor_heatmap(d: Dialect, min_types: int) -> str:
    return f"""
WITH f AS (SELECT canonical FROM reagents GROUP BY canonical HAVING count(DISTINCT organoid_type) >= {min_types})
SELECT r.canonical, r.organoid_type, count(*) AS n, sum(r.figure_confirmed) AS n_confirmed, {d.joined_set('CAST(CAST(r.value AS INT) AS STRING)')} AS doses
FROM reagents r JOIN f ON f.canonical = r.canonical GROUP BY r.canonical, r.organoid_type"""


@operator("r12_facet_counts", "reagents")
def facet_counts(d: Dialect) -> str:
    cols = ("organoid_type", "kind", "role", "canonical_unit")
    if d.spark:
        src = f"SELECT stack({len(cols)}, {', '.join(f'{c!r}, {c}' for c in cols)}) AS (facet, value) FROM reagents"
    else:
        src = " UNION ALL ".join(f"SELECT '{c}' AS facet, {c} AS value FROM reagents" for c in cols)
    return f"SELECT facet, coalesce(value, 'none') AS value, count(*) AS n FROM ({src}) x GROUP BY facet, coalesce(value, 'none')"
