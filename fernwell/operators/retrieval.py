"""Full text, vectors, recommendation, and the SQL surface."""

from __future__ import annotations

from ..plans.dialect import Dialect, operator, q, rate, text
from .breakdowns import typed


def _question(d: Dialect, query: str) -> list[str]:
    import re

    stop = {"the", "and", "for", "with", "what", "how", "are", "which", "use", "used"}
    return [t for t in dict.fromkeys(re.findall(r"[a-z0-9][a-z0-9-]+", query.lower())) if len(t) > 2 and t not in stop]


@operator("r01_bm25", "documents", query="heed thathent reingwh license general", k=12)
def bm25(d: Dialect, query: str, k: int) -> str:
    """BM25 (k1 1.2, b 0.75). Only the asked words are exploded past the scan."""
    asked = ", ".join(text(t) for t in _question(d, query)) or "''"
    return f"""
WITH len AS (SELECT doc_id, {"size(split(text, ' '))" if d.spark else "len(string_split(text, ' '))"} AS dl FROM documents WHERE text IS NOT NULL),
st AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM len),
tf AS (SELECT doc_id, w, count(*) AS f FROM documents {d.words('text')} WHERE w IN ({asked}) GROUP BY doc_id, w),
idf AS (SELECT w, ln((max(st.n) - count(*) + 5e-1) / (count(*) + 5e-1) + 1) AS idf FROM tf CROSS JOIN st GROUP BY w)
SELECT doc_id, score, row_number() OVER (ORDER BY score DESC, doc_id) AS score_rank FROM (SELECT doc_id, {q('score')} AS score FROM (
  SELECT tf.doc_id, sum(idf.idf * tf.f * 2.2 / (tf.f + 1.2 * (0.25 + 0.75 * len.dl / st.avgdl))) AS score
  FROM tf JOIN idf ON idf.w = tf.w JOIN len ON len.doc_id = tf.doc_id CROSS JOIN st GROUP BY tf.doc_id) x
  ORDER BY score DESC, doc_id LIMIT {k}) best"""


def _dot(d: Dialect, a: str, b: str) -> str:
    if d.spark:
        return f"aggregate(zip_with({a}, {b}, (x, y) -> CAST(x AS DOUBLE) * CAST(y AS DOUBLE)), 0e0, (s, v) -> s + v)"
    return f"list_inner_product(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[]))"


def _cos(d: Dialect, a: str, b: str) -> str:
    return f"({_dot(d, a, b)} / nullif(sqrt({_dot(d, a, a)}) * sqrt({_dot(d, b, b)}), 0))"


@operator("r03_dense_top_k", "embeddings", query_id=0, k=20)
def dense_top_k(d: Dialect, query_id: int, k: int) -> str:
    """Cosine to one stored vector (one row, broadcast), best k."""
    return f"""
SELECT vec_id, label, cosine, row_number() OVER (ORDER BY cosine DESC, vec_id) AS cosine_rank FROM (SELECT vec_id, label, {q('c', 5)} AS cosine FROM (
  SELECT e.vec_id, e.label, {_cos(d, 'e.embedding', 'q.embedding')} AS c FROM embeddings e CROSS JOIN (SELECT embedding FROM embeddings WHERE vec_id = {query_id}) q
  WHERE e.vec_id <> {query_id} AND e.embedding IS NOT NULL) x WHERE c IS NOT NULL ORDER BY cosine DESC, vec_id LIMIT {k}) best"""


def _centroids(d: Dialect) -> str:
    parts = "LATERAL VIEW posexplode(embedding) p AS i, v" if d.spark else ", unnest(embedding, range(len(embedding))) p(v, i)"
    if not d.spark:
        return "SELECT label, CAST(i AS INT) AS i, avg(CAST(v AS DOUBLE)) AS v FROM (SELECT label, unnest(embedding) AS v, unnest(range(len(embedding))) AS i FROM embeddings) x GROUP BY label, i"
    return f"SELECT label, i, avg(CAST(v AS DOUBLE)) AS v FROM embeddings {parts} GROUP BY label, i"


@operator("r05_type_centroids", "embeddings")
def type_centroids(d: Dialect) -> str:
    return f"""
WITH c AS ({_centroids(d)}), n AS (SELECT label, sqrt(sum(v * v)) AS norm FROM c GROUP BY label)
SELECT c.label, CAST(c.i AS INT) AS position, {q('c.v / n.norm', 5)} AS component FROM c JOIN n ON n.label = c.label"""


@operator("r06_hybrid_rerank", "embeddings", k=10)
def hybrid_rerank(d: Dialect, k: int) -> str:
    """Within each label, vectors by cosine to the label's centroid, with their first place kept."""
    at = "posexplode(embedding) AS (i, v)" if d.spark else "unnest(embedding) AS v, unnest(range(len(embedding))) AS i"
    return f"""
WITH c AS ({_centroids(d)}), n AS (SELECT label, sqrt(sum(v * v)) AS norm FROM c GROUP BY label),
e AS (SELECT vec_id, label, {at} FROM embeddings),
s AS (SELECT e.vec_id, e.label, sum(CAST(e.v AS DOUBLE) * c.v) / (sqrt(sum(CAST(e.v AS DOUBLE) * CAST(e.v AS DOUBLE))) * max(n.norm)) AS cosine
  FROM e JOIN c ON c.label = e.label AND c.i = e.i JOIN n ON n.label = e.label GROUP BY e.vec_id, e.label)
SELECT label, vec_id, {q('cosine', 5)} AS score, lex_rank, hybrid_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS lex_rank, row_number() OVER (PARTITION BY label ORDER BY {q('cosine', 5)} DESC, vec_id) AS hybrid_rank FROM s) x WHERE hybrid_rank <= {k}"""


@operator("r07_relevance_ranking", "labels", least=0)
def relevance_ranking(d: Dialect, least: int) -> str:
    """Best first, rows without a score last. Ranks are made within a score and a range of ids, and
    shifted by the counts of what comes before: no task ranks all."""
    return f"""
WITH kept AS (SELECT doc_id, quality, coalesce(-quality, 1000000) AS o, CAST(floor(doc_id / 5e4) AS BIGINT) AS part FROM labels WHERE quality IS NULL OR quality >= {least}),
n AS (SELECT o, part, count(*) AS n FROM kept GROUP BY o, part),
shift AS (SELECT o, part, sum(n) OVER (ORDER BY o, part) - n AS before FROM n)
SELECT k.doc_id, k.quality, CAST(s.before + row_number() OVER (PARTITION BY k.o, k.part ORDER BY k.doc_id) AS BIGINT) AS relevance_rank
FROM kept k JOIN shift s ON s.o = k.o AND s.part = k.part"""


def _prevalence(d: Dialect, **_) -> str:  # noqa: ANN003
    """Share of a type's papers that name a reagent, for types of five papers at least: papers of a
    type and of its names come from one pass."""
    return f"""
SELECT t, c, CAST(n AS DOUBLE) / n_type AS prev FROM (
  SELECT t, c, n, max(CASE WHEN overall = 1 THEN n END) OVER (PARTITION BY t) AS n_type, overall FROM (
    SELECT organoid_type AS t, canonical AS c, count(DISTINCT pmcid) AS n, grouping(canonical) AS overall FROM reagents WHERE {typed()}
    GROUP BY GROUPING SETS ((organoid_type, canonical), (organoid_type))) x) y WHERE overall = 0 AND n_type >= 5"""


@operator("r08_recommender", "reagents", steps={"p": _prevalence}, here=0.02, there=0.03, k=12)
def recommender(d: Dialect, here: float, there: float, k: int) -> str:
    """Reagents common in similar types and rare in this one."""
    return f"""
WITH nrm AS (SELECT t, sqrt(sum(prev * prev)) AS n FROM p GROUP BY t),
sim AS (SELECT a.t AS t, b.t AS o, {q('sum(a.prev * b.prev) / (max(x.n) * max(y.n))', 6)} AS s FROM p a JOIN p b ON a.c = b.c AND a.t <> b.t JOIN nrm x ON x.t = a.t JOIN nrm y ON y.t = b.t GROUP BY a.t, b.t),
near AS (SELECT t, o, s FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY s DESC, o) AS rn FROM sim) z WHERE rn <= 5),
cand AS (SELECT near.t, p.c, {q('sum(near.s * p.prev)', 4)} AS score FROM near JOIN p ON p.t = near.o WHERE p.prev >= {there} GROUP BY near.t, p.c)
SELECT organoid_type, canonical, score, suggestion_rank FROM (
  SELECT cand.t AS organoid_type, cand.c AS canonical, cand.score, row_number() OVER (PARTITION BY cand.t ORDER BY cand.score DESC, cand.c) AS suggestion_rank
  FROM cand LEFT JOIN p ON p.t = cand.t AND p.c = cand.c WHERE coalesce(p.prev, 0) < {here}) x WHERE suggestion_rank <= {k}"""


@operator("r09_signaling_by_type", "reagents", wanted="NATION_1")
def signaling_by_type(d: Dialect, wanted: str) -> str:
    return f"SELECT canonical, count(DISTINCT pmcid) AS n_papers, count(value) AS n_dosed FROM reagents WHERE kind = 'signaling' AND organoid_type = {text(wanted)} GROUP BY canonical"


@operator("r09_compare_reagent", "reagents", wanted="almond")
def compare_reagent(d: Dialect, wanted: str) -> str:
    return f"SELECT organoid_type, canonical, value, unit, count(*) AS n FROM reagents WHERE canonical LIKE {text('%' + wanted + '%')} AND value IS NOT NULL GROUP BY organoid_type, canonical, value, unit"


@operator("r09_grounding_by_protocol", "protocols")
def grounding_by_protocol(d: Dialect) -> str:
    return "SELECT pmcid, organoid_type, reagents_grounded, reagents_total, grounding_rate FROM protocols WHERE reagents_total > 0"


@operator("r10_landing_counts", "protocols")
def landing_counts(d: Dialect) -> str:
    return f"SELECT organoid_type, count(*) AS n, {rate('count(*)', 'sum(count(*)) OVER ()')} AS share FROM protocols GROUP BY organoid_type"


@operator("r11_database_counts", "protocols", "reagents")
def database_counts(d: Dialect) -> str:
    return "SELECT 'protocols' AS relation, count(*) AS n, count(DISTINCT pmcid) AS n_papers FROM protocols UNION ALL SELECT 'reagents', count(*), count(DISTINCT pmcid) FROM reagents"


@operator("r02_retrieval_blend", "documents", "labels", query="license general heed", k=12)
def retrieval_blend(d: Dialect, query: str, k: int) -> str:
    """Labelled documents that match lead, then the other matches."""
    asked = ", ".join(text(t) for t in _question(d, query)) or "''"
    return f"""
WITH hit AS (SELECT doc_id, count(*) AS f FROM documents {d.words('text')} WHERE w IN ({asked}) GROUP BY doc_id)
SELECT doc_id, priority, f FROM (SELECT h.doc_id, CASE WHEN l.doc_id IS NULL THEN 1 ELSE 0 END AS priority, h.f FROM hit h
  LEFT JOIN (SELECT DISTINCT doc_id FROM labels WHERE quality = 1) l ON l.doc_id = h.doc_id) x ORDER BY priority, f DESC, doc_id LIMIT {k}"""


@operator("r15_proposals", "events")
def proposals(d: Dialect) -> str:
    """Latest state of each thing in an append-only log."""
    return """SELECT user_id, event_id, event_type AS status, n_events FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn, count(*) OVER (PARTITION BY user_id) AS n_events FROM events) x WHERE rn = 1"""


@operator("r16_protocol_record", "protocols", "reagents", wanted="1")
def protocol_record(d: Dialect, wanted: str) -> str:
    return f"""SELECT p.pmcid, p.organoid_type, p.species, count(r.name) AS n_reagents, {d.joined_list("concat(r.kind, ':', r.name)", "concat(r.kind, ':', r.name)")} AS reagent_list
FROM protocols p LEFT JOIN reagents r ON r.pmcid = p.pmcid WHERE p.pmcid = {text(wanted)} GROUP BY p.pmcid, p.organoid_type, p.species"""


@operator("r17_filtered_rows", "protocols", cap=10000)
def filtered_rows(d: Dialect, cap: int) -> str:
    """Column filters of the table API: exact, greater, in, like, not null; with its row cap."""
    return f"""SELECT pmcid, organoid_type, year, n_signaling_factors FROM protocols WHERE year > 1996 AND species IN ('ASIA', 'EUROPE') AND journal LIKE '%U%'
  AND base_media IS NOT NULL AND n_signaling_factors >= 2 ORDER BY pmcid LIMIT {cap}"""
