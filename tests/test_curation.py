"""Names, units, licences, records, articles and stages against results worked out by hand."""

from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from fernwell.catalog import run_on
from fernwell.functions import markup
from fernwell.functions import text_columns as X
from fernwell.operators import curation as C
from fernwell.sources import registry as S

M = "pmcid string, pos int, name string, value double, unit string, quote string"


def mentions(spark, rows):
    return spark.createDataFrame([tuple(r.get(c) for c in ("pmcid", "pos", "name", "value", "unit", "quote")) for r in rows], M)


def test_units(spark):
    want = {
        "ng/ml": "ng/mL", "ng ml -1": "ng/mL", "ng·ml−1": "ng/mL", "µg/mL": "ug/mL", "pg/uL": "pg/uL", "g/L": "g/L", "IU/mL": "IU/mL", "U/ml": "U/mL", "kIU/ml": "kIU/mL",
        "μM": "uM", "nmol/L": "nM", "n m": "nM", "fM": "fM", "% v/v": "%", "v/v": "%", "mg/kg": "mg/kg", "conditioned medium": "conditioned medium",
    }
    df = spark.createDataFrame([(u,) for u in want], "u string")
    assert {r.u: r.c for r in df.select("u", X.canonical_unit(F.col("u")).alias("c")).collect()} == want
    m = spark.createDataFrame([(u, 1.0) for u in ["ng/ml", "IU/ml", "fM", "mg kg-1", "mpk", "µl", "5 %", "cells", None, ""]], "unit string, value double")
    got = {(r["class"], r.unit): r.ucum for r in run_on(spark, "b09_unit_audit", {"mentions": m}).collect()}
    assert got[("concentration", "ng/mL")] == "ng.mL-1" and got[("concentration", "IU/mL")] == "[IU].mL-1" and got[("concentration", "fM")] == "fmol.L-1"
    assert {k for k, _ in got} == {"concentration", "in_vivo_dose", "volume", "percent", "other", "missing"}


def test_percentages(spark):
    m = mentions(spark, [{"value": 10.0, "unit": "conditioned medium", "quote": "10% R-spondin"}, {"value": 10.0, "unit": "% v/v", "quote": "10 % of it"}, {"value": 0.0, "unit": "ng/ml", "quote": "10% of"}, {"value": 2.5, "unit": "x", "quote": "12.5%"}])
    assert [r.u for r in m.select(C.fixed_unit(F.col("value"), F.col("unit"), F.col("quote")).alias("u")).collect()] == ["%", "%", "ng/mL", "x"]
    assert {(r.unit, r.dropped) for r in C.dropped_percent(m).collect()} == {("conditioned medium", 1), ("% v/v", 0), ("ng/ml", 0), ("x", 0)}


def test_names(spark):
    rows = ["bFGF", "FGF-basic", "Gastrin I", "Gastrin I", "gastrin i", "Wnt", "Hs00950669_m1", "Nikon camera", "WNT signaling", "Wnt3a", "acta", ""]
    m = mentions(spark, [{"pmcid": "1", "pos": k, "name": n} for k, n in enumerate(rows)])
    canon = {r.name: r.canonical for r in C.canonical_names(m).collect()}
    assert canon["bFGF"] == canon["FGF-basic"] == "FGF2" and canon["gastrin i"] == "Gastrin I" and canon["Wnt"] == "Wnt"
    curated = {r.name: (r.curated, r.family) for r in C.curated_names(m).collect()}
    assert curated["acta"] == ("Activin A", 0) and curated["Wnt"] == (None, 1) and curated["Wnt3a"] == ("Wnt3a", 0)
    verdict = {r.name: r.verdict for r in C.name_filters(m).collect()}
    assert (verdict["Hs00950669_m1"], verdict["Nikon camera"], verdict["WNT signaling"], verdict["Wnt"], verdict["Wnt3a"]) == ("assay_id", "equipment", "pathway", "pathway", "kept")


def test_selected_reagents(spark):
    m = mentions(spark, [{"pmcid": "1", "pos": 1, "name": "bFGF"}, {"pmcid": "1", "pos": 2, "name": "FGF2", "value": 5.0}, {"pmcid": "1", "pos": 3, "name": "FGF2", "value": 9.0}, {"pmcid": "1", "pos": 4, "name": "x", "quote": "by Hs00950669_m1"}])
    assert [tuple(r) for r in C.selected_reagents(m).collect()] == [("1", "fgf2", "FGF2", 5.0, 1)]


def test_licences(spark):
    cases = {  # public, strict, discovery, verified
        "CC BY": (1, 1, "CC-BY", "CC-BY"), "CC0_NG": (1, 1, "CC0", "CC0"), "CC BY-NC-ND": (0, 0, "CC-BY-NC", "CC-BY-NC-ND"), "CC-BY-ND": (0, 0, "CC-BY", "CC-BY-ND"),
        "CC-BY-SA-4.0": (1, 1, "CC-BY", "CC-BY"), "author-manuscript": (0, 0, "unknown", "author-manuscript"), None: (0, 0, "unknown", "unknown"),
    }
    df = spark.createDataFrame([(k,) for k in cases], "license string")
    got = {r.license: (r.public, r.strict, r.discovery, r.verified) for r in run_on(spark, "f10_license_gates", {"manuscripts": df}).collect()}
    assert got == cases


def test_authorisation(spark):
    cols = "pmcid string, doi string, license string, tier string, human_confirmed string, sem_score double, grounding_rate double, organoid_type string, has_methods string"
    ok = dict(pmcid="PMC1", doi="d", license="CC BY", tier="tier1", human_confirmed=None, sem_score=0.9, grounding_rate=0.9, organoid_type="liver", has_methods="yes")
    changes = [{"pmcid": " "}, {"license": "CC BY-NC"}, {"pmcid": "pmc9"}, {"doi": "KNOWN"}, {"tier": "tier3"}, {"sem_score": 0.2}, {"grounding_rate": 0.3}, {"organoid_type": "x"}, {"has_methods": None}, {"sem_score": None}]
    df = spark.createDataFrame([tuple((ok | c).values()) for c in changes], cols)
    known = spark.createDataFrame([("PMC9", "known")], "pmcid string, doi string")
    got = {r.rule: r.decision for r in run_on(spark, "i03_authorization", {"manuscripts": df, "known_papers": known}).collect()}
    assert [got[r] for r in ("no_key", "license", "in_corpus_by_pmcid", "in_corpus_by_doi", "tier3_not_confirmed")] == ["blocked"] * 5
    assert [got[r] for r in ("low_relevance", "low_grounding", "unknown_type", "no_methods")] == ["review_required"] * 4 and got["all_checks_passed"] == "auto_ingest"


def test_resolver(spark):
    names = spark.createDataFrame([("PGE2", "supplement"), ("TGF-β1", "supplement"), ("B27", "supplement"), ("odd", "supplement"), ("", "supplement")], "name string, kind string")
    hits = spark.createDataFrame(
        [("prostaglandine2", 1, "CHEBI:1", "15-keto", "x"), ("prostaglandine2", 2, "CHEBI:2", "Prostaglandin E2", ""), ("tgfbeta1", 1, "NCBIGene:3", "TGF-beta1", ""), ("tgfbeta1", 2, "PR:4", "receptor", "y"), ("pge2", 1, "CHEBI:5", "z", "PGE-2")],
        "query string, pos int, curie string, label string, synonym string",
    )
    got = {r.name: (r.curie, r.status) for r in run_on(spark, "k09_grounding_resolve", {"mentions": names, "resolver_hits": hits}).collect()}
    assert got == {"PGE2": ("CHEBI:2", "resolved"), "TGF-β1": ("PR:4", "needs_review"), "B27": (None, "not_found"), "odd": (None, "not_found"), "": (None, "not_attempted")}
    sup = {r.name: (r.identifier, r.status) for r in run_on(spark, "k12_supplement_resolve", {"mentions": names, "resolver_hits": hits}).collect()}
    assert sup == {"PGE2": ("CHEBI:5", "resolved"), "TGF-β1": ("NCBIGene:3", "resolved"), "B27": ("B-27 Supplement", "curated"), "odd": (None, "not_found")}


def test_stage_scores(spark):
    cols = "pmcid string, side string, pos int, name string, day_start int, day_end int, reagents string"
    rows = [("1", "gold", 1, "DE", 0, 4, "EGF;Noggin"), ("1", "gold", 2, "Expand", 4, 10, "CHIR"), ("1", "pred", 1, "x", 0, 3, "EGF"), ("1", "pred", 2, "expand!", None, None, "Noggin;CHIR"), ("1", "pred", 3, "late", 30, 40, None), ("2", "pred", 1, "a", 0, 1, "")]
    got = {r.pmcid: r for r in C.stage_scores(spark.createDataFrame(rows, cols)).collect()}
    r = got["1"]
    assert (r.n_pred, r.n_gold, r.count_error, r.seg_tp, r.seg_fp, r.seg_fn, r.seg_f1) == (3, 2, 1, 2, 1, 0, 0.8)
    assert (r.reagent_tp, r.reagent_fp, r.reagent_fn, r.attribution) == (2, 1, 1, 0.6667)
    assert (got["2"].seg_tp, got["2"].seg_fp, got["2"].attribution) == (0, 1, None)


def test_articles():
    xml = """<a:article xmlns:a="urn:x" xmlns:xlink="http://www.w3.org/1999/xlink" article-type="research-article"><a:body><a:sec><a:title>Introduction</a:title><a:p>Hi</a:p></a:sec>
    <a:sec><a:title>Generation of organoids</a:title><a:p>We <a:b>grew</a:b> cells.</a:p></a:sec></a:body><a:back><a:sec><a:title>Online Methods</a:title><a:p>More.</a:p></a:sec>
    <a:supplementary-material><a:label>S1</a:label></a:supplementary-material><a:ref-list><a:ref id="1">R</a:ref></a:ref-list></a:back></a:article>"""
    a = markup.article(xml)
    assert a["methods"] == "Generation of organoids We grew cells.\n\nOnline Methods More." and a["detected"] and a["refs"] == ["R"] and a["supplements"] == ["S1"]
    assert a["warnings"] == ["methods_in_back:1"] and list(a["sections"]) == ["Introduction", "Generation of organoids"]
    assert markup.article("<article><body>plain</body></article>")["methods"] == "plain" and markup.article("<broken")["warnings"] == ["unreadable"] == markup.article(None)["warnings"]


@pytest.mark.parametrize(
    ("text", "kind"),
    [("Organoids were cultured as previously described (Sato et al., 2011).", "named"), ("Cells were passaged as previously described 21.", "numbered"), ("Stained as previously described (Lee et al., 2015).", None),
     ("Organoids grew as described above in step 3.", None), ("Organoids were adapted from a friend.", None), (None, None)],
)
def test_delegations(text, kind):
    d = markup.delegation(text)
    assert (d["kind"] if d else None) == kind


def test_rules_on_records(spark):
    p = spark.createDataFrame([(1, '{"type":"journal-article","update-to":[{"type":"Retraction"}]}'), (2, '{"relation":{"is-retracted-by":[]}}'), (3, None)], "k int, registry string")
    assert {r.registry is None or "Retraction" in r.registry: r.retracted for r in C.retractions(p).where("registry IS NULL OR registry LIKE '%Retraction%'").collect()} in ({True: 0}, {True: 1})
    assert {r.registry: r.retracted for r in C.retractions(p).collect()}[None] == 0
    checks = {r.message: r.n for r in C.nested_checks(spark.createDataFrame([("1", 1, " ", 2.0, None, "   ", 90), ("1", 2, "x", 1.0, "uM", "short", 1)], M + ", confidence int")).collect()}
    assert checks == {"empty_name": 1, "value_without_unit": 1, "empty_quote": 1, "short_quote": 1, "confidence_out_of_range": 1}
    t = spark.createDataFrame([("k", "We added EGF at 50 ng/mL. Then noggin, with much more than that, at 100 ng/mL.")], "k string, text string")
    assert [tuple(r) for r in C.extract_doses(t, "k").collect()] == [("k", "EGF", 50.0, "ng/mL"), ("k", "noggin", None, None)]


def test_filters_and_proposals(spark):
    df = spark.createDataFrame([(1, "ab", 5.0, ["x"]), (2, "b", None, ["y"])], "id int, name string, v double, tags array<string>")
    ids = lambda **p: [r.id for r in C.facet_filter(df, p).collect()]
    assert ids(name__contains="a") == [1] and ids(v__gte="5") == [1] and ids(tags__arraycontains="y") == [2] and ids(name__in="b, ab") == [1, 2] and ids(v__isnull="1") == [2] and ids(name="b") == [2]
    for bad in ({"nope": "1"}, {"name__near": "1"}, {"v__gt": "x"}):
        with pytest.raises(ValueError):
            C.facet_filter(df, bad)
    assert [r.id for r in C.find_terms(df, "name", "A", "b").collect()] == [1] and C.find_terms(df, "name", "a.").count() == 0
    log = spark.createDataFrame([(1, 1, "insert", "p"), (2, 1, "accept", None)], "id long, ts long, action string, payload string")
    log = C.record(C.record(log, 1, 2, "reject"), 1, 3, "accept")
    assert [tuple(r) for r in C.proposal_states(log).collect()] == [(1, "p", "accepted")]
    graph = {"message": {"query_graph": {"nodes": {"a": {}, "b": {}, "c": {}}, "edges": {"e": {"subject": "a", "object": "b"}, "f": {"subject": "b", "object": "c"}}}}}
    assert C.check_request(graph) == (200, "ok") and C.check_request({})[0] == 400
    graph["message"]["query_graph"]["edges"]["f"] = {"subject": "a", "object": "z"}
    assert C.check_request(graph)[0] == 400


def test_stored_files(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\nbad\n{"a": 2}\n')
    kept = S.read_json_lines(spark, str(tmp_path / "x.jsonl"), "a int", "keep").cache()
    assert S.count_bad_lines(kept) == 1
    for k in (1, 2):
        (tmp_path / f"pool{k}.csv").write_text("\ufeffpmcid,year\n" + "P,1\n" * k, encoding="utf-8")
    pools = S.read_pools(spark, str(tmp_path / "pool*.csv"))
    assert pools.columns == ["pmcid", "year", "pool"] and {tuple(r) for r in S.pool_counts(pools).collect()} == {("pool1.csv", 1), ("pool2.csv", 2)}
    np.save(tmp_path / "v.npy", np.arange(6, dtype=np.float32).reshape(3, 2))
    (tmp_path / "v.jsonl").write_text("".join(json.dumps({"pmcid": f"P{k}"}) + "\n" for k in range(3)))
    assert {r.pmcid: r.embedding for r in S.read_vectors(spark, str(tmp_path / "v.npy"), str(tmp_path / "v.jsonl"), "pmcid string").collect()} == {"P0": [0, 1], "P1": [2, 3], "P2": [4, 5]}
    asked = spark.createDataFrame([("a",), ("b",)], "q string")
    assert {tuple(r) for r in S.cached_lookup(asked, spark.createDataFrame([("a", "1")], "q string, answer string"), "q").collect()} == {("a", "1", "cached"), ("b", None, "not_attempted")}
    df = spark.createDataFrame([(f"P{k}", 2000 + k % 3) for k in range(7)], "pmcid string, year int")
    S.write_report(df, str(tmp_path / "report"), made="now")
    report = S.read_report(spark, str(tmp_path / "report")).first()
    assert len(report.rows) == 7 and report.made == "now"
    S.write_slices(df, str(tmp_path / "slices"), ["pmcid", "year"], "year", "pmcid", 3)
    slices = spark.read.option("header", True).csv(str(tmp_path / "slices"))
    assert {k: sorted(r.pmcid for r in slices.where(f"slice = {k}").collect()) for k in range(3)} == {0: ["P1", "P2", "P5"], 1: ["P0", "P3", "P4"], 2: ["P6"]}
    for _ in range(2):
        S.append_manifest(df, str(tmp_path / "m"), ["year", "pmcid"])
    assert S.read_manifest(spark, str(tmp_path / "m")).count() == 14
    S.load_database({"reagents_t": spark.createDataFrame([(1, "EGF human"), (2, "Noggin")], "id int, name string")}, str(tmp_path / "db"), {"reagents_t": ("name",)})
    assert [r.name for r in spark.sql("SELECT r.name FROM reagents_t r JOIN reagents_t_words w ON w.rowid = r.id WHERE w.word = 'egf'").collect()] == ["EGF human"]
    assert {tuple(r) for r in S.export_files({"p": df}, str(tmp_path / "e")).collect()} == {("p", 7)}


def test_stage_scores_by_expressions(spark):
    rows = [
        # two predicted stages want the first gold one: the earlier one has it, the other one takes the next that is alike
        ("P", "pred", 1, "Expansion", 0, 4, "EGF; noggin"), ("P", "pred", 2, "x", 0, 4, "EGF;;egf"), ("P", "gold", 1, None, 0, 4, "E G F;SHH"), ("P", "gold", 2, "X!", None, 9, "Noggin"), ("P", "gold", None, "x", 7, 9, None),
        # a day alone is alike with the same day, names without letters with nothing
        ("Q", "pred", 1, "!", 3, 3, None), ("Q", "pred", 2, "!", None, None, "EGF"), ("Q", "gold", 1, "?", 3, 3, ""), ("Q", "gold", 2, "!", None, None, "EGF"),
        ("R", "other", 1, "a", 0, 1, "EGF"), (None, "gold", 1, "a", 0, 1, "EGF"),
    ]
    got = C.stage_scores(spark.createDataFrame(rows, "pmcid string, side string, pos int, name string, day_start int, day_end int, reagents string"))
    assert {r.pmcid: tuple(r)[1:] for r in got.collect()} == {
        "P": (2, 3, 1, 2, 0, 1, 0.8, 1, 2, 2, 0.5),
        "Q": (2, 2, 0, 1, 1, 1, 0.5, 0, 0, 0, 0.0),
        "R": (0, 0, 0, 0, 0, 0, 0.0, 0, 0, 0, None),
        None: (0, 1, 1, 0, 0, 1, 0.0, 0, 0, 0, None),
    }
    # no call of Python for each of many papers
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("InPandas", "InArrow", "EvalPython") if x in plan]
