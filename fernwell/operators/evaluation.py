"""Scores against gold and verdicts, samples for review, and text checks."""

from __future__ import annotations

from ..plans.dialect import Dialect, operator, q, rate


def wilson(k: str, n: str, side: int, z: float = 1.96) -> str:
    """A bound of the Wilson interval; side -1 or 1."""
    p = f"(CAST({k} AS DOUBLE) / {n})"
    sign = "+" if side > 0 else "-"
    return q(f"({p} + {z * z} / (2 * {n}) {sign} {z} * sqrt({p} * (1 - {p}) / {n} + {z * z} / (4e0 * {n} * {n}))) / (1 + {z * z} / {n})")


@operator("e05_fidelity_audit", "reagents")
def fidelity_audit(d: Dialect) -> str:
    """Whether the dose stands in the quote as a whole number, with Wilson bounds."""
    ok = "CASE WHEN concat(' ', evidence_quote, ' ') LIKE concat('% ', CAST(CAST(value AS INT) AS STRING), ' %') THEN 1 ELSE 0 END"
    return f"""
SELECT kind, n, n_ok, {rate('n_ok', 'n')} AS fidelity, {wilson('n_ok', 'n', -1)} AS ci_low, {wilson('n_ok', 'n', 1)} AS ci_high FROM (
  SELECT kind, count(*) AS n, sum({ok}) AS n_ok FROM reagents WHERE evidence_quote IS NOT NULL AND value IS NOT NULL GROUP BY kind) x"""


@operator("e01_set_field_score", "reagents")
def set_field_score(d: Dialect) -> str:
    """Names with a dose (predicted) against grounded names (gold), per paper and name."""
    return """
SELECT coalesce(g.pmcid, p.pmcid) AS pmcid, sum(CASE WHEN g.c IS NOT NULL AND p.c IS NOT NULL THEN 1 ELSE 0 END) AS tp,
  sum(CASE WHEN g.c IS NULL THEN 1 ELSE 0 END) AS fp, sum(CASE WHEN p.c IS NULL THEN 1 ELSE 0 END) AS fn
FROM (SELECT DISTINCT pmcid, canonical AS c FROM reagents WHERE grounded = 1) g
FULL OUTER JOIN (SELECT DISTINCT pmcid, canonical AS c FROM reagents WHERE value > 5) p ON p.pmcid = g.pmcid AND p.c = g.c
GROUP BY coalesce(g.pmcid, p.pmcid)"""


@operator("e03_micro_macro", "reagents")
def micro_macro(d: Dialect) -> str:
    return f"""
SELECT {rate('sum(tp)', 'sum(tp + fp)')} AS micro_precision, {rate('sum(tp)', 'sum(tp + fn)')} AS micro_recall, {rate('2 * sum(tp)', 'sum(2 * tp + fp + fn)')} AS micro_f1,
  {q('avg(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0))')} AS macro_precision, {q('avg(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0))')} AS macro_recall, count(*) AS n_papers
FROM ({set_field_score(d)}) s"""


@operator("e02_scalar_score", "protocols")
def scalar_score(d: Dialect) -> str:
    return """
SELECT field, verdict, count(*) AS n FROM (SELECT 'matrix' AS field, CASE WHEN journal IS NULL THEN 'not_in_gold' WHEN matrix IS NULL THEN 'missing'
    WHEN lower(matrix) = lower(journal) THEN 'correct' ELSE 'incorrect' END AS verdict FROM protocols) x GROUP BY field, verdict"""


@operator("e04_silver_aggregate", "labels")
def silver_aggregate(d: Dialect) -> str:
    return f"""SELECT CASE WHEN toxic = 1 THEN 'toxic' ELSE 'plain' END AS stratum, count(*) AS n, sum(quality) AS n_good, {rate('sum(quality)', 'count(*)')} AS precision_rate
FROM labels GROUP BY CASE WHEN toxic = 1 THEN 'toxic' ELSE 'plain' END"""


@operator("e06_stratified_sample", "reagents", n=120)
def stratified_sample(d: Dialect, n: int) -> str:
    """Round-robin over types in the order of a hash of the paper and name: a sampling operator."""
    h = "sha1(concat(pmcid, ':', variety))" if d.spark else "sha1(concat(pmcid, ':', variety))"
    return f"""
SELECT organoid_type, pmcid, variety, turn FROM (SELECT *, row_number() OVER (PARTITION BY organoid_type ORDER BY h, pmcid, variety) AS turn FROM (
  SELECT DISTINCT organoid_type, pmcid, variety, {h} AS h FROM reagents WHERE evidence_quote IS NOT NULL AND value IS NOT NULL) x) y
ORDER BY turn, organoid_type LIMIT {n}"""


@operator("e07_verdict_aggregate", "labels")
def verdict_aggregate(d: Dialect) -> str:
    v = "CASE WHEN quality = 1 AND toxic = 0 THEN 'supported' WHEN quality = 1 THEN 'partial' WHEN quality = 0 THEN 'unsupported' ELSE 'invalid' END"
    return f"SELECT {v} AS verdict, count(*) AS n, {rate('count(*)', 'sum(count(*)) OVER ()')} AS share FROM labels GROUP BY {v}"


@operator("e10_model_bakeoff", "events")
def model_bakeoff(d: Dialect) -> str:
    """Runs by model (event type): success share and the upper median of a measure."""
    return f"SELECT event_type AS model, count(*) AS n, {rate('count(CASE WHEN value > 50 THEN 1 END)', 'count(*)')} AS success, {d.upper_median('value')} AS median_upper FROM events GROUP BY event_type"


@operator("e11_grounded_comparison", "reagents")
def grounded_comparison(d: Dialect) -> str:
    """Factors by type, each with the first 60 characters of a quote."""
    return """SELECT organoid_type, canonical, substring(min(evidence_quote), 1, 60) AS citation, count(*) AS n
FROM reagents WHERE kind = 'signaling' AND grounded = 1 GROUP BY organoid_type, canonical"""


@operator("j13_stage_overlap", "conversations")
def stage_overlap(d: Dialect) -> str:
    """Pairs of neighbouring stages (turns) whose day ranges overlap by half of their union."""
    lo, hi = "greatest(a.s, b.s)", "least(a.e, b.e)"
    return f"""
WITH st AS (SELECT conv_id, turn, turn * 3 AS s, turn * 3 + length(text) % 11 AS e FROM conversations WHERE text IS NOT NULL)
SELECT a.conv_id, a.turn AS turn_a, b.turn AS turn_b, {q(f'CAST(greatest(0, {hi} - {lo}) AS DOUBLE) / nullif(greatest(a.e, b.e) - least(a.s, b.s), 0)')} AS iou
FROM st a JOIN st b ON a.conv_id = b.conv_id AND a.turn < b.turn
WHERE CAST(greatest(0, {hi} - {lo}) AS DOUBLE) / nullif(greatest(a.e, b.e) - least(a.s, b.s), 0) >= 0.5"""


@operator("j14_verbatim_grounding", "documents", "benchmark")
def verbatim_grounding(d: Dialect) -> str:
    """Quotes of three words or more that stand verbatim in a source text. A quote's longest word
    between its first and its last one is a word of each text that holds it: texts and quotes meet
    by that word, and the whole quote is looked up in what meets."""
    found = "d.doc_id, b.item_id, CAST(position(b.text IN d.text) AS BIGINT) AS at"
    if not d.spark:
        return f"SELECT {found} FROM documents d JOIN benchmark b ON contains(d.text, b.text) WHERE len(string_split(b.text, ' ')) >= 3"
    return f"""
WITH quotes AS (SELECT item_id, text, array_max(transform(slice(split(text, ' '), 2, size(split(text, ' ')) - 2), w -> struct(length(w) AS n, w))).w AS word
  FROM benchmark WHERE size(split(text, ' ')) >= 3),
met AS (SELECT w.doc_id, q.item_id, q.text AS quote FROM (SELECT DISTINCT doc_id, word FROM documents LATERAL VIEW explode(array_distinct(split(text, ' '))) t AS word) w
  JOIN quotes q ON q.word = w.word)
SELECT {found} FROM documents d JOIN (SELECT doc_id, item_id, quote AS text FROM met) b ON b.doc_id = d.doc_id WHERE contains(d.text, b.text)"""


@operator("t02_bundle_summary", "documents")
def bundle_summary(d: Dialect) -> str:
    return f"SELECT lang, count(*) AS n, {q('median(n_chars)', 1)} AS median_chars, sum(CASE WHEN {d.matches('text', 'Licensed?|License')} THEN 1 ELSE 0 END) AS n_licensed FROM documents GROUP BY lang"


@operator("t03_evidence_text", "documents", "benchmark", cap=24000, least=400)
def evidence_text(d: Dialect, cap: int, least: int) -> str:
    """A document's text, its source put before it where it is short, cut at a cap."""
    t = f"CASE WHEN length(coalesce(text, '')) < {least} THEN concat(source, ' ', coalesce(text, '')) ELSE text END"
    return f"SELECT doc_id, CAST(length(substring({t}, 1, {cap})) AS BIGINT) AS n_evidence, md5(substring({t}, 1, {cap})) AS evidence_md5 FROM documents"


@operator("t11_prediction_validation", "protocols")
def prediction_validation(d: Dialect) -> str:
    checks = {"no_species": "species IS NULL", "no_matrix": "matrix IS NULL", "rate_range": "grounding_rate NOT BETWEEN 0 AND 1", "grounded_over_total": "reagents_grounded > reagents_total",
              "bad_year": "year NOT BETWEEN 1990 AND 2027", "no_license": "license IS NULL"}
    rows = " UNION ALL ".join(f"SELECT '{n}' AS message, pmcid FROM protocols WHERE {c}" for n, c in checks.items())
    if d.spark:
        made = ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in checks.items())
        rows = f"SELECT pmcid, explode(array_compact(array({made}))) AS message FROM protocols"
    return f"SELECT message, count(*) AS n, min(pmcid) AS example FROM ({rows}) x GROUP BY message"


@operator("x13_slugs", "part")
def slugs(d: Dialect) -> str:
    key = d.sub("lower(p_name)", "[^a-z0-9]", "")
    slug = f"trim(BOTH '_' FROM {d.sub('lower(p_type)', '[^a-z0-9]+', '_')})" if d.spark else f"trim({d.sub('lower(p_type)', '[^a-z0-9]+', '_')}, '_')"
    return f"SELECT {key} AS norm_key, {slug} AS slug, count(*) AS n FROM part GROUP BY {key}, {slug}"


@operator("o06_token_jaccard", "part", least=0.3)
def token_jaccard(d: Dialect, least: float) -> str:
    """Pairs of names whose words agree by a share. Two such names share one of the rarest words of
    each: of n words, the first n - ceil(least * n) + 1 in the order of frequency. Names meet by
    these words alone, so that common words are never squared."""
    w = "explode(split(p_name, ' ')) AS w" if d.spark else "unnest(string_split(p_name, ' ')) AS w"
    words = f"SELECT DISTINCT p_name, w FROM (SELECT p_name, {w} FROM (SELECT DISTINCT p_name FROM part) n) x"
    if not d.spark:
        return f"""
WITH t AS ({words}), s AS (SELECT p_name, count(*) AS n FROM t GROUP BY p_name),
c AS (SELECT a.p_name AS na, b.p_name AS nb, count(*) AS k FROM t a JOIN t b ON a.w = b.w AND a.p_name < b.p_name GROUP BY a.p_name, b.p_name)
SELECT na AS name_a, nb AS name_b, {q('CAST(k AS DOUBLE) / (x.n + y.n - k)')} AS jaccard FROM c JOIN s x ON x.p_name = na JOIN s y ON y.p_name = nb
WHERE CAST(k AS DOUBLE) / (x.n + y.n - k) >= {least}"""
    return f"""
WITH t AS ({words}), f AS (SELECT w, count(*) AS f FROM t GROUP BY w),
named AS (SELECT t.p_name, array_sort(collect_list(struct(f.f AS f, t.w AS w))) AS ws FROM t JOIN f ON f.w = t.w GROUP BY t.p_name),
rare AS (SELECT p_name, transform(ws, x -> x.w) AS ws, x.w AS w FROM named LATERAL VIEW explode(slice(ws, 1, size(ws) - CAST(ceil({least} * size(ws)) AS INT) + 1)) e AS x),
met AS (SELECT DISTINCT a.p_name AS na, b.p_name AS nb, a.ws AS wa, b.ws AS wb FROM rare a JOIN rare b ON a.w = b.w AND a.p_name < b.p_name)
SELECT na AS name_a, nb AS name_b, {q('CAST(k AS DOUBLE) / n')} AS jaccard FROM (
  SELECT na, nb, size(array_intersect(wa, wb)) AS k, size(array_union(wa, wb)) AS n FROM met) m WHERE CAST(k AS DOUBLE) / n >= {least}"""
