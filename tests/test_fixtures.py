"""Operators on small rows whose results were worked out by hand."""

from __future__ import annotations

import pytest

from fernwell.catalog import run_on
from fernwell.operators.graph import lineage_reach

R = "pmcid string, doi string, organoid_type string, kind string, name string, canonical string, variety string, role string, value double, unit string, canonical_unit string, evidence_quote string, grounded int, suspect_unit int, figure_confirmed int, year int"


def reagents(spark, rows):
    base = dict.fromkeys([c.split()[0] for c in R.split(", ")])
    return spark.createDataFrame([tuple((base | {"doi": r.get("pmcid"), "name": r.get("canonical"), "variety": r.get("canonical"), "grounded": 0, "suspect_unit": 0, "figure_confirmed": 0} | r).values()) for r in rows], R)


def papers(spark, rows):
    names = ("pmcid", "doi", "organoid_type", "species", "matrix", "base_media", "source_cell_type", "journal", "year", "n_signaling_factors", "n_supplements", "passaging", "timeline")
    kinds = ["int" if n in ("year", "n_signaling_factors", "n_supplements") else "string" for n in names]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


def test_prevalence(spark):
    rows = [("EGF", "intestinal"), ("EGF", "gastric"), ("EGF", "liver"), ("EGF", "liver"), ("CHIR99021", "intestinal"), ("CHIR99021", "kidney"), ("Noggin", "intestinal")]
    r = reagents(spark, [{"pmcid": str(i), "canonical": c, "organoid_type": t, "kind": "signaling"} for i, (c, t) in enumerate(rows)])
    got = {x.canonical: (x.n_types, x.n_records, x.types) for x in run_on(spark, "a34_reagent_prevalence", {"reagents": r}).collect()}
    assert got == {"EGF": (3, 4, "gastric|intestinal|liver"), "CHIR99021": (2, 2, "intestinal|kidney"), "Noggin": (1, 1, "intestinal")}


def test_cooccurrence(spark):
    sets = {"1": "EGF Noggin CHIR99021", "2": "EGF Noggin CHIR99021", "3": "EGF Noggin", "4": "EGF CHIR99021"}
    rows = [{"pmcid": p, "canonical": c, "kind": "signaling", "organoid_type": "x"} for p, cs in sets.items() for c in cs.split()]
    rows.append({"pmcid": "5", "canonical": "B27", "kind": "supplement", "organoid_type": "x"})
    got = {(x.c_a, x.c_b): (x.n_papers, x.jaccard) for x in run_on(spark, "a30_reagent_cooccurrence", {"reagents": reagents(spark, rows)}).collect()}
    assert got == {("EGF", "Noggin"): (3, 0.75), ("CHIR99021", "EGF"): (3, 0.75), ("CHIR99021", "Noggin"): (2, 0.5)}


@pytest.mark.parametrize(("values", "complex_", "minimal"), [([1, 5, 5, 5, 5, 15], [15], []), ([1, 4, 5, 5, 5, 6], [], [1])])
def test_outliers(spark, values, complex_, minimal):
    p = papers(spark, [{"pmcid": str(i), "doi": str(i), "organoid_type": "t", "n_signaling_factors": v} for i, v in enumerate(values)] + [{"pmcid": "z", "organoid_type": "alone", "n_signaling_factors": 90}])
    got = run_on(spark, "a35_protocol_outliers", {"protocols": p}).collect()
    assert sorted(x.n_sf for x in got if x["class"] == "complex") == complex_
    assert sorted(x.n_sf for x in got if x["class"] == "minimal") == minimal


def test_adoption(spark):
    p = papers(spark, [{"pmcid": "a", "year": 2020}, {"pmcid": "b", "year": 2020}])
    r = reagents(spark, [{"pmcid": "a", "canonical": "EGF", "organoid_type": "t"}])
    got = run_on(spark, "a29_temporal_adoption", {"reagents": r, "protocols": p}).collect()
    assert [(x.year, x.adoption_fraction) for x in got] == [(2020, 0.5)]


def test_species_and_journals(spark):
    p = papers(spark, [{"pmcid": "1", "organoid_type": "t", "species": " Homo sapiens ", "journal": None}, {"pmcid": "2", "organoid_type": "t", "species": "human", "journal": "J"}, {"pmcid": "3", "organoid_type": "other", "species": "mouse", "journal": "J"}, {"pmcid": "4", "organoid_type": "t", "species": "not_reported"}])
    got = {(x.level, x.organoid_type, x.value): x.n for x in run_on(spark, "a20_species_breakdown", {"manuscripts": p}).collect()}
    assert got == {("type", "t", "human"): 2, ("cross", "*", "human"): 2}
    assert {(x.journal, x.n) for x in run_on(spark, "a32_journal_breakdown", {"protocols": p}).collect()} == {("unknown", 2), ("J", 1)}


def test_dose_range_and_empty(spark):
    rows = [{"pmcid": str(i), "canonical": "EGF", "organoid_type": "t", "value": v, "canonical_unit": "ng/mL"} for i, v in enumerate([10.0, 20.0, 40.0, 0.0, None])]
    x = run_on(spark, "a61_within_type_dose_range", {"reagents": reagents(spark, rows)}).collect()
    assert [(r.n, r["min"], r["max"], r.fold_range, r["median"], r.cv) for r in x] == [(3, 10.0, 40.0, 4.0, 20.0, 0.5345)]
    assert run_on(spark, "a61_within_type_dose_range", {"reagents": reagents(spark, rows).limit(0)}).count() == 0


def test_two_hops(spark):
    nodes = spark.createDataFrame([("P1", "Publication", "p1"), ("P2", "Publication", "p2"), ("C1", "SmallMolecule", "a"), ("C2", "SmallMolecule", "b")], "id string, category string, name string")
    edges = spark.createDataFrame([("P1", "mentions", "C1", ""), ("P1", "mentions", "C2", ""), ("P2", "mentions", "C1", "")], "subject string, predicate string, object string, role string")
    f = {"kg_nodes": nodes, "kg_edges": edges}
    assert [(x.leaf_b, x.n_hubs) for x in run_on(spark, "k04_two_hop_hub", f, leaf="C1").collect()] == [("C2", 1)]
    assert {x.other for x in run_on(spark, "k03_one_hop", f, pinned="C1").collect()} == {"P1", "P2"}


def test_lineage_cycle_free(spark):
    lin = spark.createDataFrame([("b", "a", "x"), ("c", "b", "y"), ("c", "b", "y")], "source string, cited string, change string")
    assert [(x.root, x.n_reached, x.max_depth) for x in lineage_reach(lin).collect()] == [("a", 2, 2)]
    assert {x.node: (x.in_degree, x.out_degree, x.is_root) for x in run_on(spark, "b02_lineage_graph", {"lineage": lin}).collect()} == {"a": (0, 1, 1), "b": (1, 1, 0), "c": (1, 0, 0)}


def test_lineage_with_cycles_and_diamonds(spark):
    rows = [("b", "a"), ("c", "b"), ("d", "c"), ("b", "d"), ("c", "c")]  # a cycle behind a root, and a loop
    for k in range(18):  # two ways from each stage to the next
        rows += [(f"l{k}", f"s{k}"), (f"r{k}", f"s{k}"), (f"s{k + 1}", f"l{k}"), (f"s{k + 1}", f"r{k}")]
    lin = spark.createDataFrame([(s, c, "") for s, c in rows], "source string, cited string, change string")
    assert {x.root: (x.n_reached, x.max_depth) for x in lineage_reach(lin).collect()} == {"a": (3, 3), "s0": (54, 36)}


def test_long_lineage(spark):
    lin = spark.createDataFrame([(f"n{k + 1}", f"n{k}", "") for k in range(120)], "source string, cited string, change string")
    assert [(x.root, x.n_reached, x.max_depth) for x in lineage_reach(lin).collect()] == [("n0", 120, 120)]


def test_quality_score(spark):
    cols = "pmcid string, organoid_type string, grounding_rate double, reagents_total int, timeline string, base_media string, matrix string, passaging string, assay_endpoints string, n_figure_confirmed int"
    rows = [("1", "t", 1.0, 5, "d0", "m", "g", "p", "qPCR", 3), ("2", "t", 0.5, 2, "d0", None, "not_reported", "TBD", "qPCR", 1), ("3", "t", None, None, None, None, None, None, None, None)]
    got = {x.pmcid: (x.score, x.tier) for x in run_on(spark, "b06_quality_score", {"protocols": spark.createDataFrame(rows, cols)}).collect()}
    assert got == {"1": (1.0, "gold"), "2": (0.4967, "bronze"), "3": (0.0, "bronze")}


def test_reporting_items(spark):
    cols = "pmcid string, species string, organoid_type string, source_cell_type string, base_media string, matrix string, n_signaling_factors int, n_supplements int, passaging string, timeline string, assay_endpoints string, n_figure_confirmed int, grounding_rate double"
    rows = [("1", "human", "t", "iPSC", "m", "g", 3, 0, "p", None, "not_reported", 0, 0.0)]
    got = run_on(spark, "b07_mior_papers", {"protocols": spark.createDataFrame(rows, cols)}).first()
    # present: six required ones, passaging, rate; not reported: supplements, endpoints, figures; timeline unknown
    assert (got.n_present, got.n_not_reported, got.n_not_extracted, got.mior_completeness, got.required_completeness) == (8, 3, 1, 0.7273, 0.8571)


def test_roles_and_merge(spark):
    m = [("1", "t", "signaling", "rhEGF", " Growth Factor "), ("1", "t", "signaling", "EGF", "morphogen"), ("2", "t", "signaling", "recombinant human EGF", "buffer"), ("3", "t", "signaling", "EGF protein", "null")]
    df = spark.createDataFrame([(*r, 1.0) for r in m], "pmcid string, organoid_type string, kind string, name string, role string, value double")
    got = {x.role: x.n_records for x in run_on(spark, "a42_role_breakdown", {"mentions": df}).where("level = 'cross'").collect()}
    assert got == {"growth_factor": 1, "differentiation": 1, "other": 1, "not_stated": 1}
    merged = run_on(spark, "a60_merge_candidates", {"mentions": df}).collect()
    assert [(x.normalized_form, x.members) for x in merged] == [("egf", "EGF|EGF protein|recombinant human EGF")]


def test_clusters(spark):
    cols = "pmcid string, organoid_type string, failure string, assay_endpoints string"
    rows = [("1", "a", "Contamination, too late", "qPCR; FACS"), ("2", "a", "nothing", "qPCR"), ("3", None, "", None)]
    df = spark.createDataFrame(rows, cols)
    got = {(x.organoid_type, x.cluster): x.n for x in run_on(spark, "b01_failure_modes", {"manuscripts": df}).collect()}
    assert got == {("a", "contamination"): 1, ("a", "timing_critical"): 1, ("a", "other"): 1}
    assays = {(x.level, x.cluster): (x.n_papers, x.fraction) for x in run_on(spark, "b05_assay_endpoints", {"manuscripts": df}).collect()}
    assert assays[("cross", "gene_expression_qPCR")] == (2, 1.0) and assays[("cross", "flow_cytometry_FACS")] == (1, 0.5)


def test_maturity(spark):
    p = papers(spark, [{"pmcid": str((y, k)), "organoid_type": t, "year": y} for t, years in ((None, {2020: 1, 2021: 1, 2022: 2, 2023: 2}), ("x", {2022: 1})) for y, n in years.items() for k in range(n)])
    got = {x.organoid_type: x.trajectory for x in run_on(spark, "a37_type_maturity", {"protocols": p}).collect()}
    assert got == {"unknown": "accelerating", "x": "insufficient_data"}
