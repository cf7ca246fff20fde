"""Corpus-shaped relations over the driver's tables: papers from orders, reagents from line items,
a property graph, lineage, vectors. The text is the same for both engines."""

from __future__ import annotations

_TYPED = """
orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
"""


def _pick(expression: str, values: tuple) -> str:
    """One of the values by a number: text as papers write it, for the rules that fold it."""
    quoted = [("NULL" if v is None else "'" + str(v).replace("'", "''") + "'") for v in values]
    return f"CASE ({expression}) % {len(values)} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(quoted)) + " END"


_NAMES = (
    "bFGF", "FGF-basic", "rhEGF", "EGF", " egf", "Y27632", "ROCK inhibitor", "CHIR 99021", "Wnt", "FGF", "Noggin", "noggin ", "B27 supplement", "N2", "Matrigel",
    "ImageJ software", "Nikon camera", "WNT signaling", "Hs00950669_m1", "Activin-A", "TGF-β1", "heparin", "cisplatin", "", None, "recombinant human Noggin", "human EGF",
    "Gastrin I", "gastrin I", "Gastrin I", "SHH", "hedgehog pathway", "mouse Noggin protein", "Laminin 511", "ACTA", "Nog", "GlutaMAX", "FBS",
)
_UNITS = (
    "ng/ml", "ng ml -1", "µg/mL", "μM", "uM", "nmol/L", "IU/mL", "kIU/ml", "% v/v", "%", "mg/kg", "mg kg-1", "mpk", "ul", "v/v", "conditioned medium", "n m", "g/L", None, "",
    "U/ml", "pg/uL", "mM", "ng·ml−1", " M ", "cells/ml", "ng/mLEG",
)
_ROLES = ("growth factor", "Signaling", "morphogen", "inhibition", "supplementation", "pathway agonist", "stimulation", "null", None, "", "not stated", "buffer", "proliferation", " Inhibitor ")
_FAILURES = (
    "Matrigel did not solidify", "bacterial contamination after day 3", "organoids collapsed", "growth arrest", "low efficiency and few organoids", "dose is critical, too high kills",
    "lot to lot variation", "passaging too late", "no crypt budding", "cells remain undifferentiated", "failed to passage", "nothing of note", "", None, "timing and contamination",
)
_ASSAYS = ("qPCR; Immunofluorescence", "RNA-seq / scRNA", "flow cytometry, FACS", "TEM · histology", "Western blot", "ELISA;insulin secretion", "viability • Ki67", "calcium imaging", None, "", "mass spec", "TEER", "single-cell droplet")
_TYPES = ("intestinal", "hepatic", "liver", "other", None, "kidney", "Brain", "", "lung", "hepatobiliary", "retina")
_TITLES = ("Long-term culture of intestinal organoids", "Long term culture of intestinal organoids.", "Culture of liver organoids", "A kidney model", "Kidney organoids: a model", None, "")
_METHODS = (
    "Organoids were cultured as previously described (Sato et al., 2011) with changes.", "Sections were stained as previously described (Lee et al., 2015).",
    "Passaging was done as described above in step 3.", "Spheroids were expanded, adapted from ref 21, as previously described 21.", "Cells were fed daily.", None, "",
    "Differentiation was based on the protocol for liver organoids (Hu et al 2018).",
)
_STAGES = ("Definitive endoderm", "Expansion", "4h wash", "maturation", "Expansion ", "Day 3 (12 h)", "", None)
_LICENSES = ("CC BY", "cc_by_nc", "CC0_NG", "CC-BY-SA-4.0", "CC BY-NC-ND", "cc0", "CC-BY-ND", "author-manuscript", None, "unknown", "ccby", "public domain", "CC-BY 4.0")

#: relation -> (tables or relations it reads, SELECT)
SHAPES: dict[str, tuple[tuple[str, ...], str]] = {
    "reagents": (
        ("lineitem", "part", "orders", "customer", "nation", "region"),
        f"""
SELECT CAST(l.l_orderkey AS STRING) AS pmcid, CAST(l.l_orderkey AS STRING) AS doi, n.n_name AS organoid_type,
  CASE l.l_linestatus WHEN 'O' THEN 'signaling' ELSE 'supplement' END AS kind,
  concat(p.p_name, ' ', p.p_brand) AS name, p.p_name AS canonical, concat(p.p_name, ' ', p.p_brand) AS variety,
  p.p_type AS role, CASE WHEN l.l_tax = 0 THEN NULL ELSE l.l_quantity END AS value,
  l.l_returnflag AS unit, CASE l.l_returnflag WHEN 'A' THEN 'ng/mL' WHEN 'N' THEN 'uM' ELSE NULL END AS canonical_unit,
  CASE WHEN l.l_discount >= 0.05 THEN concat('added ', CAST(CAST(l.l_quantity AS INT) AS STRING), ' of ', p.p_name) END AS evidence_quote,
  CASE WHEN l.l_discount >= 0.05 THEN 1 ELSE 0 END AS grounded,
  CASE WHEN l.l_linestatus = 'O' AND l.l_quantity >= 48 THEN 1 ELSE 0 END AS suspect_unit,
  CASE WHEN l.l_tax >= 0.07 THEN 1 ELSE 0 END AS figure_confirmed,
  CAST(year(o.o_orderdate) AS INT) AS year
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN {_TYPED.replace('orders o JOIN', 'orders o ON l.l_orderkey = o.o_orderkey JOIN', 1)}
""",
    ),
    "protocols": (
        ("orders", "customer", "nation", "region", "lineitem"),
        f"""
SELECT CAST(o.o_orderkey AS STRING) AS pmcid, CAST(o.o_orderkey AS STRING) AS doi, n.n_name AS organoid_type,
  CASE WHEN o.o_orderkey % 7 = 0 THEN NULL WHEN o.o_orderkey % 19 = 0 THEN 'not_reported' ELSE r.r_name END AS species,
  CASE WHEN o.o_orderkey % 11 = 0 THEN NULL WHEN o.o_orderkey % 13 = 0 THEN 'Not_Stated' ELSE c.c_mktsegment END AS matrix,
  CASE WHEN o.o_orderkey % 5 = 0 THEN NULL ELSE o.o_orderpriority END AS base_media,
  CASE WHEN o.o_orderkey % 23 = 0 THEN '' ELSE o.o_orderstatus END AS source_cell_type,
  CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE c.c_mktsegment END AS journal,
  CAST(year(o.o_orderdate) AS INT) AS year, o.o_totalprice AS total,
  coalesce(l.n_sf, 0) AS n_signaling_factors, coalesce(l.n_sup, 0) AS n_supplements, coalesce(l.n_fig, 0) AS n_figure_confirmed,
  coalesce(l.n_ground, 0) AS reagents_grounded, coalesce(l.n_all, 0) AS reagents_total,
  floor(CAST(l.n_ground_sf AS DOUBLE) / nullif(l.n_sf, 0) * 1e3 + 5e-1) / 1e3 AS grounding_rate,
  CASE WHEN o.o_orderkey % 3 = 0 THEN NULL ELSE 'enzymatic split' END AS passaging,
  CASE WHEN o.o_orderkey % 4 = 0 THEN NULL ELSE concat('day 0 -> day ', CAST(o.o_orderkey % 30 AS STRING)) END AS timeline,
  CASE o.o_orderkey % 6 WHEN 0 THEN 'qPCR; Imaging' WHEN 1 THEN 'flow cytometry' WHEN 2 THEN 'imaging, TEER' WHEN 3 THEN '' WHEN 4 THEN NULL ELSE 'RNA-seq; qPCR; viability' END AS assay_endpoints,
  CASE WHEN o.o_orderkey % 29 = 0 THEN NULL WHEN o.o_orderkey % 5 = 0 THEN 'CC BY-NC-ND' WHEN o.o_orderkey % 2 = 0 THEN 'cc_by' ELSE 'CC0-1.0' END AS license
FROM {_TYPED}
LEFT JOIN (SELECT l_orderkey, sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS n_sf, sum(CASE WHEN l_linestatus = 'O' THEN 0 ELSE 1 END) AS n_sup,
    sum(CASE WHEN l_tax >= 0.07 THEN 1 ELSE 0 END) AS n_fig, sum(CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END) AS n_ground,
    sum(CASE WHEN l_discount >= 0.05 AND l_linestatus = 'O' THEN 1 ELSE 0 END) AS n_ground_sf, count(*) AS n_all
  FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey
""",
    ),
    "mentions": (
        ("lineitem",),
        f"""
SELECT concat('PMC', CAST(l_orderkey AS STRING)) AS pmcid, CAST(l_linenumber AS INT) AS pos, {_pick('l_partkey', _NAMES)} AS name, {_pick('l_orderkey + l_linenumber', _UNITS)} AS unit,
  CASE WHEN l_tax = 0 THEN NULL ELSE l_quantity END AS value, {_pick('l_partkey + l_suppkey', _ROLES)} AS role, CASE l_linestatus WHEN 'O' THEN 'signaling' ELSE 'supplement' END AS kind,
  {_pick('l_orderkey', _TYPES)} AS organoid_type,
  CASE WHEN l_discount >= 0.07 THEN concat('with ', CAST(CAST(l_quantity AS INT) AS STRING), '% of it') WHEN l_discount >= 0.04 THEN concat('at ', CAST(CAST(l_quantity AS INT) AS STRING), ' units')
    WHEN l_discount >= 0.02 THEN '' END AS quote,
  concat('They kept it at ', CAST(CAST(l_quantity AS INT) AS STRING), ' units in all wells.') AS source_text, CAST(l_discount * 100 AS INT) AS confidence
FROM lineitem
""",
    ),
    "manuscripts": (
        ("orders",),
        f"""
SELECT concat('PMC', CAST(o_orderkey AS STRING)) AS pmcid, CASE WHEN o_orderkey % 3 = 0 THEN concat('PMID:', CAST(o_orderkey AS STRING)) WHEN o_orderkey % 3 = 1 THEN '' END AS pmid,
  concat('10.1000/', CAST(o_orderkey AS STRING)) AS doi,
  {_pick('o_custkey', _TITLES)} AS title, {_pick('o_custkey + o_orderkey', _TITLES)} AS registry_title, {_pick('o_custkey', _TYPES)} AS organoid_type, {_pick('o_orderkey + 3', _TYPES)} AS discovery_type,
  {_pick('o_orderkey', ("human", "Homo sapiens", "Murine", "mus musculus", "rat", None, "not_stated", " Human "))} AS species,
  {_pick('o_orderkey + 1', ("Matrigel", "corning Matrigel", "Geltrex", "Cultrex BME", "laminin-511", "alginate", None, "not_reported", "Collagen I"))} AS matrix,
  {_pick('o_orderkey + 2', ("Advanced DMEM/F12", "ADF", "dmem:f12", "mTeSR 1", "E8 medium", "RPMI", "IMDM", None, "StemFlex medium", ""))} AS base_media,
  {_pick('o_custkey + 1', ("hiPSCs", "iPSC", "ES cell", "biopsy", "adult stem cell", "fibroblast", None, "Not_Stated"))} AS source_cell_type,
  {_pick('o_orderkey + o_custkey', _LICENSES)} AS license, {_pick('o_orderkey + 5', _FAILURES)} AS failure, {_pick('o_custkey + 2', _ASSAYS)} AS assay_endpoints,
  {_pick('o_orderkey', ("tier1", "tier3", "tier2"))} AS tier, {_pick('o_custkey', ("true", "false", None))} AS human_confirmed,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_custkey % 100 AS DOUBLE) / 100 END AS sem_score, CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE CAST(o_orderkey % 100 AS DOUBLE) / 100 END AS grounding_rate,
  {_pick('o_orderkey + 1', ("yes", "yes", "no", None))} AS has_methods, {_pick('o_orderkey', (None, "", "TBD", " pending ", "A. Reader", "n/a", "B"))} AS verified_by,
  {_pick('o_orderkey', ("research-article", "Review-article", None, "systematic-review"))} AS article_type, {_pick('o_custkey', ("review", "Primary_Methods", '"other"', "letter", None))} AS model_type,
  {_pick('o_orderkey', ("Table 2", "Fig. 3", "supplementary file", "methods", None, "Schematic B"))} AS source_loc,
  {_pick('o_custkey', ("matrix: hESC line", "value fabricated", "medium RPMI", "mouse for human", "dose 3 for 5", None))} AS disputed,
  {_pick('o_orderkey', ('{"authorList":{"author":[{"lastName":"Sato"}]}}', '{"authorList":{"author":[{"fullName":"Clevers H"}]}}', '{"authorString":"Smith J, Doe A","journalInfo":{"journal":{"title":" Cell "}}}', "{}", None))} AS record,
  {_pick('o_custkey', ('{"type":"retraction"}', '{"update-to":[{"type":"Retraction notice"}]}', '{"relation":{"is-retracted-by":[{"id":"x"}]}}', '{"type":"journal-article","update-to":[{"type":"erratum"}]}', "{}", None))} AS registry,
  {_pick('o_orderkey', _METHODS)} AS methods,
  {_pick('o_orderkey', ("we saw bosom peril here", "Counterfeit  consciousness", "counterfeit consciousness in wells", "plain text", None))} AS body,
  CAST(year(o_orderdate) AS INT) AS year
FROM orders
""",
    ),
    "articles": (
        ("manuscripts",),
        """
SELECT pmcid, concat('<article article-type="', coalesce(article_type, ''), '" xmlns:xlink="http://www.w3.org/1999/xlink"><body><sec><title>Results</title><p>We saw growth.</p></sec>',
  CASE WHEN year % 3 = 1 THEN concat('<sec sec-type="methods"><title>Methods</title><p>', coalesce(methods, ''), '</p></sec>') WHEN year % 3 = 0 THEN concat('<p>', coalesce(methods, ''), '</p>') ELSE '' END,
  '</body><back>', CASE WHEN year % 3 = 2 THEN concat('<sec><title>Online Methods</title><p>', coalesce(methods, ''), '</p></sec>') ELSE '' END,
  '<fig><label>1</label><caption><p>Growth</p></caption></fig>', CASE WHEN year % 2 = 1 THEN '<table-wrap><label>T</label></table-wrap>' ELSE '' END,
  '<ref-list><ref id="a">One</ref><ref id="b">Two</ref></ref-list><p><ext-link xlink:href="http://a.org"/><ext-link xlink:href="http://a.org"/></p></back></article>') AS xml FROM manuscripts
""",
    ),
    "stages": (
        ("lineitem",),
        f"""
SELECT concat('PMC', CAST(l_orderkey AS STRING)) AS pmcid, CASE WHEN l_linenumber % 2 = 0 THEN 'gold' ELSE 'pred' END AS side, CAST(l_linenumber AS INT) AS pos,
  {_pick('l_partkey', _STAGES)} AS name, CAST(l_partkey % 6 AS INT) AS day_start, CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE CAST(l_partkey % 6 + l_suppkey % 4 AS INT) END AS day_end,
  {_pick('l_partkey + 1', ("EGF;Noggin", "EGF", "CHIR99021;Noggin", "", None))} AS reagents
FROM lineitem
""",
    ),
    "known_papers": (
        ("orders", "lineitem"),
        """
SELECT concat('pmc', CAST(o.o_orderkey AS STRING)) AS pmcid, CASE WHEN o.o_custkey % 3 = 0 THEN concat('10.1000/', CAST(o.o_orderkey + 1 AS STRING)) ELSE '' END AS doi
FROM orders o JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_tax >= 0.07 GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey
""",
    ),
    "resolver_hits": (
        ("mentions",),
        """
SELECT DISTINCT k AS query, pos, concat(CASE (length(k) + pos) % 4 WHEN 0 THEN 'CHEBI' WHEN 1 THEN 'UNII' WHEN 2 THEN 'NCBIGene' ELSE 'PR' END, ':', CAST(length(k) * 10 + pos AS STRING)) AS curie,
  CASE WHEN pos = 2 THEN k ELSE concat(k, ' receptor') END AS label, CASE WHEN pos = 3 THEN upper(k) ELSE 'x' END AS synonym
FROM (SELECT regexp_replace(replace(replace(lower(name), 'β', 'beta'), ' ', ''), '-', '') AS k FROM mentions WHERE name <> '') a
CROSS JOIN (SELECT 1 AS pos UNION ALL SELECT 2 UNION ALL SELECT 3) b WHERE length(k) % 5 <> 0
""",
    ),
    "figures": (
        ("lineitem",),
        f"""
SELECT concat('PMC', CAST(l_orderkey AS STRING)) AS pmcid, concat('Figure ', CAST(l_linenumber AS STRING)) AS label,
  concat({_pick('l_partkey', ("41598_Fig", "nihms-f000", "gr", "graphic_", "logo", "MOESM", "embj-g00"))}, CAST(l_linenumber AS STRING), CASE WHEN l_suppkey % 2 = 0 THEN '.jpg' ELSE '.png' END) AS file
FROM lineitem
""",
    ),
    "captions": (
        ("lineitem",),
        """
SELECT concat('PMC', CAST(l_orderkey AS STRING)) AS pmcid, CASE WHEN l_suppkey % 3 = 0 THEN '' ELSE concat('Figure ', CAST(l_linenumber AS STRING)) END AS label,
  CASE WHEN l_partkey % 2 = 0 THEN concat('41598_Fig', CAST(l_linenumber AS STRING)) ELSE concat('gr', CAST(l_linenumber AS STRING)) END AS graphic, concat('Growth on day ', CAST(l_linenumber AS STRING)) AS caption
FROM lineitem
""",
    ),
    "lineage": (
        ("orders",),
        """
SELECT CAST(o_orderkey AS STRING) AS source, CAST(prev AS STRING) AS cited, concat('modified ', o_orderpriority) AS change FROM (
  SELECT o_orderkey, o_orderpriority, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev FROM orders) x
WHERE prev IS NOT NULL
""",
    ),
    "kg_nodes": (
        ("orders", "part", "supplier"),
        """
SELECT concat('PUB:', CAST(o_orderkey AS STRING)) AS id, 'Publication' AS category, concat('order ', CAST(o_orderkey AS STRING)) AS name FROM orders
UNION ALL SELECT concat('CHEM:', CAST(p_partkey AS STRING)), 'SmallMolecule', p_name FROM part WHERE p_partkey % 50 <> 0
UNION ALL SELECT concat('CELL:', CAST(s_suppkey AS STRING)), 'CellLine', s_name FROM supplier
""",
    ),
    "kg_edges": (
        ("lineitem",),
        """
SELECT DISTINCT concat('PUB:', CAST(l_orderkey AS STRING)) AS subject, 'mentions' AS predicate, concat('CHEM:', CAST(l_partkey AS STRING)) AS object, l_returnflag AS role FROM lineitem
UNION ALL SELECT DISTINCT concat('PUB:', CAST(l_orderkey AS STRING)), 'uses_line', concat('CELL:', CAST(l_suppkey AS STRING)), l_linestatus FROM lineitem WHERE l_linenumber = 1
""",
    ),
}
