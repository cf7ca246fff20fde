"""Names, units, keys and records put in order: the curation rules as DataFrame expressions.

Each query has SQL of its own for the engine it is held against; tables of words are rows there."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import vocabulary as V
from ..functions.text_columns import canonical_unit, norm_key
from ..plans.dialect import DUCKDB
from ..plans.shape import SHAPES
from .doses import canonical_unit as canonical_unit_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from ..catalog import relation

    return relation(spark, sf_dir, name)


def _query(key: str, relation: str, sql: str | None = None):  # noqa: ANN202
    """Registers a function of one relation; sql reads the relation by its name."""

    def put(f: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        QUERIES[key] = lambda spark, sf_dir: f(_relation(spark, sf_dir, relation))
        if sql:
            shaped = f"{relation} AS ({SHAPES[relation][1].strip()})" if relation in SHAPES else None
            body = sql.strip()
            if body[:5].upper() == "WITH ":
                body = body[5:] if shaped else body
                ORACLE[key] = f"WITH {shaped}, {body}" if shaped else body
            else:
                ORACLE[key] = f"WITH {shaped} {body}" if shaped else body
        return f

    return put


def known(c: Column, table: dict[str, str]) -> Column:
    """The value that a table has for a column, else null."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.element_at(F.create_map(*pairs), c)


def _rows(table: dict[str, str], name: str) -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    return f"{name}(k, v) AS (VALUES {', '.join(f'({quoted(k)}, {quoted(v)})' for k, v in table.items())})"


def _literal(p: str) -> str:
    return "'" + p.replace("'", "''") + "'"


# ------------------------------------------------------------------------------------------ names


@_query(
    "x02_canonical_names",
    "mentions",
    f"""WITH {_rows(V.CANONICAL, "curated")},
s AS (SELECT regexp_replace(lower(name), '[^a-z0-9]', '', 'g') AS k, trim(name) AS form, name FROM mentions WHERE name <> ''),
f AS (SELECT k, form, count(*) AS n FROM s GROUP BY k, form),
best AS (SELECT k, form FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n DESC, form) AS rn FROM f) x WHERE rn = 1)
SELECT s.name, coalesce(c.v, best.form) AS canonical, count(*) AS n FROM s JOIN best ON best.k = s.k LEFT JOIN curated c ON c.k = s.k GROUP BY s.name, coalesce(c.v, best.form)""",
)
def canonical_names(mentions: DataFrame) -> DataFrame:
    """Each name as written and its canonical one: the curated name of its key, else the form that
    most mentions of the key have."""
    counts = mentions.where("name <> ''").groupBy("name").agg(F.count("*").alias("n")).withColumn("k", norm_key(F.col("name")))
    forms = counts.groupBy("k", F.trim("name").alias("form")).agg(F.sum("n").alias("m"))
    best = forms.groupBy("k").agg(F.min(F.struct((-F.col("m")).alias("m"), "form")).alias("b")).select("k", F.col("b.form").alias("form"))
    return counts.join(best, "k").select("name", F.coalesce(known(F.col("k"), V.CANONICAL), "form").alias("canonical"), "n")


@_query(
    "x03_curated_names",
    "mentions",
    f"""WITH {_rows(V.FIGURE_NAMES | V.CANONICAL, "curated")}
SELECT m.name, c.v AS curated, CASE WHEN regexp_replace(lower(m.name), '[^a-z0-9]', '', 'g') IN ({", ".join(map(_literal, V.FAMILIES))}) THEN 1 ELSE 0 END AS family, count(*) AS n
FROM mentions m LEFT JOIN curated c ON c.k = regexp_replace(lower(m.name), '[^a-z0-9]', '', 'g') WHERE m.name IS NOT NULL GROUP BY m.name, c.v""",
)
def curated_names(mentions: DataFrame) -> DataFrame:
    """Names that a figure may confirm (curated or a figure's abbreviation, else null), and whether
    a name is a bare family."""
    k = norm_key(F.col("name"))
    return mentions.where("name IS NOT NULL").groupBy("name").agg(F.count("*").alias("n")).select(
        "name", known(k, V.FIGURE_NAMES | V.CANONICAL).alias("curated"), k.isin(*V.FAMILIES).cast("int").alias("family"), "n"
    )


@_query(
    "f14_name_filters",
    "mentions",
    f"""SELECT name, CASE WHEN regexp_matches(name, {_literal(V.ASSAY_ID)}) THEN 'assay_id' WHEN regexp_matches(name, {_literal(V.EQUIPMENT)}) THEN 'equipment'
  WHEN regexp_matches(name, {_literal(V.PATHWAY)}) THEN 'pathway' ELSE 'kept' END AS verdict, count(*) AS n FROM mentions WHERE name <> '' GROUP BY 1, 2""",
)
def name_filters(mentions: DataFrame) -> DataFrame:
    """Names that are no reagents: identifiers of assays, instruments or software, and pathways."""
    c = F.col("name")
    verdict = F.when(c.rlike(V.ASSAY_ID), "assay_id").when(c.rlike(V.EQUIPMENT), "equipment").when(c.rlike(V.PATHWAY), "pathway").otherwise("kept")
    return mentions.where("name <> ''").groupBy("name", verdict.alias("verdict")).agg(F.count("*").alias("n"))


@_query(
    "w12_selected_reagents",
    "mentions",
    f"""WITH {_rows(V.CANONICAL, "curated")},
m AS (SELECT m.pmcid, m.pos, m.name, m.value, lower(trim(coalesce(c.v, m.name))) AS k FROM mentions m LEFT JOIN curated c ON c.k = regexp_replace(lower(m.name), '[^a-z0-9]', '', 'g')
  WHERE m.name IS NOT NULL AND NOT regexp_matches(m.name, {_literal(V.ASSAY_ID)}) AND NOT regexp_matches(coalesce(m.quote, ''), {_literal(V.ASSAY_ID)}))
SELECT pmcid, k, name, value, first_pos FROM (SELECT *, min(pos) OVER (PARTITION BY pmcid, k) AS first_pos, row_number() OVER (PARTITION BY pmcid, k ORDER BY CASE WHEN value IS NULL THEN 1 ELSE 0 END, pos, name, value) AS rn
  FROM m WHERE k <> '') x WHERE rn = 1""",
)
def selected_reagents(mentions: DataFrame) -> DataFrame:
    """One mention for each paper and canonical name, the first with a dose, else the first; assay
    identifiers are left out."""
    key = F.lower(F.trim(F.coalesce(known(norm_key(F.col("name")), V.CANONICAL), "name")))
    bad = F.col("name").rlike(V.ASSAY_ID) | F.coalesce("quote", F.lit("")).rlike(V.ASSAY_ID)
    kept = mentions.where(F.col("name").isNotNull() & ~bad).withColumn("k", key).where("k <> ''")
    pick = F.min(F.struct(F.col("value").isNull().alias("undosed"), "pos", "name", "value"))
    return kept.groupBy("pmcid", "k").agg(pick.alias("p"), F.min("pos").alias("first_pos")).select("pmcid", "k", "p.name", "p.value", "first_pos")


# ---------------------------------------------------------------------------------- units and doses


def percent_in_quote(value: Column, quote: Column) -> Column:
    """Whether the quote shows the value as a percentage."""
    whole = F.when(value == F.floor(value), value.cast("long").cast("string")).otherwise(value.cast("string"))
    return F.coalesce(F.regexp_like(quote, F.concat(F.lit(r"(?<!\d)"), F.replace(whole, F.lit("."), F.lit("\\.")), F.lit(r"\s*%"))), F.lit(False))


_PERCENT_SQL = r"regexp_matches(coalesce(quote, ''), concat('(^|[^0-9])', CAST(CAST(value AS BIGINT) AS VARCHAR), '\s*%'))"


@_query(
    "x17_dropped_percent",
    "mentions",
    f"""SELECT unit, CASE WHEN coalesce(trim(unit), '') <> '' AND position('%' IN unit) = 0 AND {_PERCENT_SQL} THEN 1 ELSE 0 END AS dropped, count(*) AS n
FROM mentions WHERE value IS NOT NULL AND quote <> '' GROUP BY 1, 2""",
)
def dropped_percent(mentions: DataFrame) -> DataFrame:
    """Doses whose quote shows a percentage that the unit lost."""
    bug = (F.coalesce(F.trim("unit"), F.lit("")) != "") & ~F.contains(F.col("unit"), F.lit("%")) & percent_in_quote(F.col("value"), F.col("quote"))
    return mentions.where("value IS NOT NULL AND quote <> ''").groupBy("unit", F.coalesce(bug, F.lit(False)).cast("int").alias("dropped")).agg(F.count("*").alias("n"))


def fixed_unit(value: Column, unit: Column, quote: Column) -> Column:
    """The canonical unit; `%` where the quote shows the value as a percentage and the unit has none."""
    u = canonical_unit(unit)
    return F.when(F.coalesce(F.contains(u, F.lit("%")), F.lit(False)), u).when(percent_in_quote(value, quote), F.lit("%")).otherwise(u)


@_query(
    "x05_fixed_units",
    "mentions",
    f"""SELECT unit, CASE WHEN value IS NOT NULL AND {_PERCENT_SQL} THEN 1 ELSE 0 END AS shows_percent, count(*) AS n,
  sum(CASE WHEN value IS NOT NULL AND {_PERCENT_SQL} OR position('%' IN coalesce(unit, '')) > 0 OR replace(lower(trim(coalesce(unit, ''))), ' ', '') IN ('v/v', 'w/v', 'vv', 'wv') THEN 1 ELSE 0 END) AS n_percent
FROM mentions GROUP BY 1, 2""",
)
def fixed_units(mentions: DataFrame) -> DataFrame:
    """By unit as written: how many doses are percentages after the repair."""
    fixed = fixed_unit(F.col("value"), F.col("unit"), F.col("quote"))
    shows = F.col("value").isNotNull() & percent_in_quote(F.col("value"), F.col("quote"))
    return mentions.groupBy("unit", F.coalesce(shows, F.lit(False)).cast("int").alias("shows_percent")).agg(
        F.count("*").alias("n"), F.count_if(fixed == "%").alias("n_percent")
    )


@_query("x37_clean_doses", "mentions", f"""WITH {_rows(V.UCUM, "ok")} SELECT pmcid, pos, CASE WHEN u IN (SELECT k FROM ok) THEN value END AS value, CASE WHEN u IN (SELECT k FROM ok) THEN u END AS unit FROM (SELECT pmcid, pos, value, {canonical_unit_sql(DUCKDB, 'unit')} AS u FROM mentions) x""")
def clean_doses(mentions: DataFrame) -> DataFrame:
    """Doses read from figures: the unit only if it is one of concentration, the value only with it."""
    u = canonical_unit(F.col("unit"))
    unit = F.when(u.isin(*V.UCUM), u)
    return mentions.select("pmcid", "pos", F.when(unit.isNotNull(), F.col("value")).alias("value"), unit.alias("unit"))


@_query(
    "x37_clean_stages",
    "stages",
    r"""WITH s AS (SELECT pmcid, pos, trim(name) AS name, CASE WHEN regexp_matches(name, '(?i)\b\d+\s*h(?:ours?|rs?)?\b') AND NOT regexp_matches(name, '(?i)\bday\b|\bweek\b|\bw\d|\bd\d|\bp\d') THEN NULL ELSE day_start END AS a,
  CASE WHEN regexp_matches(name, '(?i)\b\d+\s*h(?:ours?|rs?)?\b') AND NOT regexp_matches(name, '(?i)\bday\b|\bweek\b|\bw\d|\bd\d|\bp\d') THEN NULL ELSE day_end END AS b FROM stages WHERE trim(name) <> '')
SELECT pmcid, arg_min(name, pos) AS name, a AS day_start, b AS day_end, min(pos) AS pos FROM s GROUP BY pmcid, lower(name), a, b""",
)
def clean_stages(stages: DataFrame) -> DataFrame:
    """Stages once each in their order; labels of hours have no days."""
    hours = F.col("name").rlike(V.HOUR_LABEL) & ~F.col("name").rlike(V.DAY_LABEL)
    day = lambda c: F.when(~hours, F.col(c)).alias(c)
    s = stages.where(F.trim("name") != "").select("pmcid", "pos", F.trim("name").alias("name"), day("day_start"), day("day_end"))
    first = s.groupBy("pmcid", F.lower("name").alias("k"), "day_start", "day_end").agg(F.min(F.struct("pos", "name")).alias("f"))
    return first.select("pmcid", "f.name", "day_start", "day_end", "f.pos")


# ------------------------------------------------------------------------------- keys and records


@_query(
    "x19_publication_keys",
    "manuscripts",
    "SELECT pmcid, CASE WHEN trim(replace(coalesce(pmid, ''), 'PMID:', '')) <> '' THEN concat('PMID:', trim(replace(pmid, 'PMID:', ''))) ELSE concat('PMC:', trim(replace(pmcid, 'PMC', ''))) END AS curie FROM manuscripts",
)
def publication_keys(papers: DataFrame) -> DataFrame:
    """A publication's key: the PMID where there is one, else the PMC digits."""
    pmid = F.nullif(F.trim(F.replace("pmid", F.lit("PMID:"), F.lit(""))), F.lit(""))
    return papers.select("pmcid", F.coalesce(F.concat(F.lit("PMID:"), pmid), F.concat(F.lit("PMC:"), F.trim(F.replace("pmcid", F.lit("PMC"), F.lit(""))))).alias("curie"))


@_query(
    "x15_content_hashes",
    "manuscripts",
    """SELECT pmcid, sha256(concat('{"pmcid":"', pmcid, '"', CASE WHEN title IS NULL THEN '' ELSE concat(',"title":"', title, '"') END, CASE WHEN year IS NULL THEN '' ELSE concat(',"year":', CAST(year AS VARCHAR)) END, '}')) AS content_sha256 FROM manuscripts""",
)
def content_hashes(papers: DataFrame) -> DataFrame:
    """SHA-256 of a record as JSON with its fields in order, nulls left out."""
    return papers.select("pmcid", F.sha2(F.to_json(F.struct("pmcid", "title", "year")), 256).alias("content_sha256"))


_RECORD = "authorList struct<author: array<struct<lastName: string, fullName: string>>>, authorString string, journalInfo struct<journal: struct<title: string>>"


@_query(
    "x22_first_authors",
    "manuscripts",
    """WITH r AS (SELECT pmcid, coalesce(nullif(trim(json_extract_string(record, '$.authorList.author[0].lastName')), ''), nullif(split_part(trim(json_extract_string(record, '$.authorList.author[0].fullName')), ' ', 1), ''),
  nullif(split_part(trim(split_part(json_extract_string(record, '$.authorString'), ',', 1)), ' ', 1), ''), '') AS first_author, coalesce(trim(json_extract_string(record, '$.journalInfo.journal.title')), '') AS journal FROM manuscripts)
SELECT first_author, journal, count(*) AS n FROM r GROUP BY first_author, journal""",
)
def first_authors(papers: DataFrame) -> DataFrame:
    """First author's last name and the journal from nested records."""
    r = F.from_json("record", _RECORD)
    a = F.get(r["authorList"]["author"], 0)
    word = lambda c: F.nullif(F.substring_index(F.trim(c), " ", 1), F.lit(""))
    name = F.coalesce(F.nullif(F.trim(a["lastName"]), F.lit("")), word(a["fullName"]), word(F.substring_index(r["authorString"], ",", 1)), F.lit(""))
    return papers.groupBy(name.alias("first_author"), F.coalesce(F.trim(r["journalInfo"]["journal"]["title"]), F.lit("")).alias("journal")).agg(F.count("*").alias("n"))


_REGISTRY = "type string, `update-to` array<struct<type: string>>, relation struct<`is-retracted-by`: array<struct<id: string>>>"


@_query(
    "x28_retractions",
    "manuscripts",
    """WITH r AS (SELECT registry, lower(coalesce(json_extract_string(registry, '$.type'), '')) IN ('retraction', 'retracted-article')
    OR len(list_filter(coalesce(json_extract_string(registry, '$."update-to"[*].type'), []), lambda t: position('retract' IN lower(t)) > 0)) > 0
    OR coalesce(json_array_length(registry, '$.relation."is-retracted-by"'), 0) > 0 AS retracted FROM manuscripts)
SELECT registry, CASE WHEN retracted THEN 1 ELSE 0 END AS retracted, count(*) AS n FROM r GROUP BY registry, retracted""",
)
def retractions(papers: DataFrame) -> DataFrame:
    """Registry records that say a work is retracted: by type, by an update, or by a notice."""
    r = F.from_json("registry", _REGISTRY)
    by_update = F.exists(r["update-to"], lambda u: F.contains(F.lower(u["type"]), F.lit("retract")))
    hit = F.coalesce(F.lower(r["type"]).isin("retraction", "retracted-article"), F.lit(False)) | F.coalesce(by_update, F.lit(False)) | F.coalesce(F.size(r["relation"]["is-retracted-by"]) > 0, F.lit(False))
    return papers.groupBy("registry").agg(F.max(hit.cast("int")).alias("retracted"), F.count("*").alias("n"))


@_query(
    "x27_tortured_phrases",
    "manuscripts",
    f"SELECT body, CASE WHEN {' OR '.join(f'contains(lower(body), {_literal(p)})' for p in V.TORTURED)} THEN 1 ELSE 0 END AS tortured, count(*) AS n FROM manuscripts GROUP BY body",
)
def tortured_phrases(papers: DataFrame) -> DataFrame:
    """Texts with a phrase that stands for a common term."""
    return papers.groupBy("body").agg(F.count("*").alias("n")).select("body", F.coalesce(F.lower("body").rlike("|".join(V.TORTURED)), F.lit(False)).cast("int").alias("tortured"), "n")


@_query(
    "x25_silver_taxonomy",
    "manuscripts",
    f"""SELECT kind, place, count(*) AS n FROM (SELECT
  CASE {' '.join(f"WHEN {' OR '.join(f'contains(lower(disputed), {_literal(w)})' for w in ws)} THEN '{k}'" for k, ws in V.ERROR_KINDS.items())} ELSE 'other_value_unit_name' END AS kind,
  CASE {' '.join(f"WHEN {' OR '.join(f'contains(lower(source_loc), {_literal(w)})' for w in ws)} THEN '{k}'" for k, ws in V.MISS_PLACES.items())} ELSE 'methods/body_text' END AS place
  FROM manuscripts WHERE disputed IS NOT NULL) x GROUP BY kind, place""",
)
def silver_taxonomy(papers: DataFrame) -> DataFrame:
    """Disputed fields by kind of error (the first whose words they have) and place of the miss."""

    def first(c: str, table: dict[str, tuple[str, ...]], other: str) -> Column:
        out = F.lit(other)
        for kind, words in reversed(table.items()):
            out = F.when(F.coalesce(F.lower(c).rlike("|".join(words)), F.lit(False)), kind).otherwise(out)
        return out

    return papers.where("disputed IS NOT NULL").groupBy(first("disputed", V.ERROR_KINDS, "other_value_unit_name").alias("kind"), first("source_loc", V.MISS_PLACES, "methods/body_text").alias("place")).agg(F.count("*").alias("n"))


@_query(
    "f19_verified_gold",
    "manuscripts",
    f"SELECT verified_by, CASE WHEN verified_by IS NULL OR lower(trim(verified_by)) IN ({', '.join(map(_literal, V.UNVERIFIED))}) THEN 0 ELSE 1 END AS verified, count(*) AS n FROM manuscripts GROUP BY verified_by",
)
def verified_gold(papers: DataFrame) -> DataFrame:
    """Gold records that a person has verified."""
    return papers.groupBy("verified_by").agg(F.count("*").alias("n")).select(
        "verified_by", (~F.coalesce(F.lower(F.trim("verified_by")).isin(*V.UNVERIFIED), F.lit(True))).cast("int").alias("verified"), "n"
    )


@_query(
    "t05_publication_types",
    "manuscripts",
    """SELECT article_type, model_type, CASE WHEN contains(lower(coalesce(article_type, '')), 'review') THEN 'review' WHEN trim(trim(lower(coalesce(model_type, '')), '"')) IN ('review', 'primary_methods', 'other')
  THEN trim(trim(lower(model_type), '"')) ELSE 'primary_methods' END AS publication_type, count(*) AS n FROM manuscripts GROUP BY ALL""",
)
def publication_types(papers: DataFrame) -> DataFrame:
    """The markup's article type before the model's answer."""
    said = F.trim(F.trim(F.lower("model_type"), F.lit('"')))
    kind = F.when(F.contains(F.lower("article_type"), F.lit("review")), "review").when(said.isin("review", "primary_methods", "other"), said).otherwise("primary_methods")
    return papers.groupBy("article_type", "model_type").agg(F.count("*").alias("n")).withColumn("publication_type", kind)


@_query(
    "g11_size_buckets",
    "protocols",
    """SELECT bucket, count(*) AS n FROM (SELECT CASE WHEN n_signaling_factors < 1 THEN '0' WHEN n_signaling_factors < 3 THEN '1-2' WHEN n_signaling_factors < 6 THEN '3-5' ELSE '6+' END AS bucket FROM protocols) x GROUP BY bucket""",
)
def size_buckets(protocols: DataFrame) -> DataFrame:
    """Papers by labelled ranges [low, high) of their factors."""
    edges = (("0", 1), ("1-2", 3), ("3-5", 6))
    label = F.lit("6+")
    for name, high in reversed(edges):
        label = F.when(F.col("n_signaling_factors") < high, name).otherwise(label)
    return protocols.groupBy(label.alias("bucket")).agg(F.count("*").alias("n"))


@_query(
    "o07_first_names",
    "mentions",
    "SELECT pmcid, string_agg(name, '|' ORDER BY pos, name) AS names FROM (SELECT pmcid, name, min(pos) AS pos FROM mentions WHERE name <> '' GROUP BY pmcid, name) x GROUP BY pmcid",
)
def first_names(mentions: DataFrame) -> DataFrame:
    """A paper's names once each, in the order in which they first come."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "name"))), lambda s: s["name"])
    return mentions.where("name <> ''").groupBy("pmcid").agg(F.array_join(F.array_distinct(ordered), "|").alias("names"))


@_query(
    "j15_gold_predictions",
    "manuscripts",
    """WITH g AS (SELECT pmcid FROM manuscripts WHERE verified_by IN ('A. Reader', 'B')), p AS (SELECT pmcid, model_type FROM manuscripts WHERE has_methods = 'yes')
SELECT CASE WHEN p.pmcid IS NULL THEN 'skipped_no_pred' ELSE 'scored' END AS state, coalesce(p.model_type, 'none') AS model_type, count(*) AS n FROM g LEFT JOIN p ON p.pmcid = g.pmcid GROUP BY 1, 2""",
)
def gold_predictions(papers: DataFrame) -> DataFrame:
    """Verified gold papers with their predictions by key, and those without one; missing answers
    get a default (J05, J15)."""
    gold = papers.where(~F.coalesce(F.lower(F.trim("verified_by")).isin(*V.UNVERIFIED), F.lit(True))).select("pmcid")
    pred = papers.where("has_methods = 'yes'").select("pmcid", "model_type", F.lit(1).alias("there"))
    return gold.join(pred, "pmcid", "left").groupBy(
        F.when(F.col("there").isNull(), "skipped_no_pred").otherwise("scored").alias("state"), F.coalesce("model_type", F.lit("none")).alias("model_type")
    ).agg(F.count("*").alias("n"))


@_query(
    "f20_usable_hits",
    "manuscripts",
    "SELECT pmcid, journal FROM (SELECT pmcid, coalesce(trim(json_extract_string(record, '$.journalInfo.journal.title')), '') AS journal, license, has_methods FROM manuscripts) x WHERE pmcid <> '' AND has_methods = 'yes' AND license IS NOT NULL AND lower(license) <> 'unknown'",
)
def usable_hits(papers: DataFrame) -> DataFrame:
    """Search hits with a key, in the index, open to access."""
    r = F.from_json("record", _RECORD)
    return papers.where("pmcid <> '' AND has_methods = 'yes' AND license IS NOT NULL AND lower(license) <> 'unknown'").select("pmcid", F.coalesce(F.trim(r["journalInfo"]["journal"]["title"]), F.lit("")).alias("journal"))


@_query(
    "t14_nested_checks",
    "mentions",
    r"""WITH c AS (SELECT pmcid, CASE WHEN coalesce(trim(name), '') = '' THEN 1 ELSE 0 END AS e1, CASE WHEN value IS NOT NULL AND coalesce(unit, '') = '' THEN 1 ELSE 0 END AS w1,
  CASE WHEN quote IS NOT NULL AND trim(quote) = '' THEN 1 ELSE 0 END AS e2, CASE WHEN quote IS NOT NULL AND trim(quote) <> '' AND length(quote) < 12 THEN 1 ELSE 0 END AS w2,
  CASE WHEN CAST(confidence AS DOUBLE) / 8 > 1 THEN 1 ELSE 0 END AS e3 FROM mentions)
SELECT 'confidence_out_of_range' AS message, 'error' AS level, sum(e3) AS n, count(DISTINCT CASE WHEN e3 = 1 THEN pmcid END) AS n_papers FROM c UNION ALL
SELECT 'empty_name', 'error', sum(e1), count(DISTINCT CASE WHEN e1 = 1 THEN pmcid END) FROM c UNION ALL SELECT 'empty_quote', 'error', sum(e2), count(DISTINCT CASE WHEN e2 = 1 THEN pmcid END) FROM c UNION ALL
SELECT 'short_quote', 'warning', sum(w2), count(DISTINCT CASE WHEN w2 = 1 THEN pmcid END) FROM c UNION ALL SELECT 'value_without_unit', 'warning', sum(w1), count(DISTINCT CASE WHEN w1 = 1 THEN pmcid END) FROM c""",
)
def nested_checks(mentions: DataFrame) -> DataFrame:
    """Errors and warnings of nested records (a paper's reagents, each with its evidence), by
    message. A record's quote may be absent, but not blank; its confidence lies in 0 to 1."""
    record = F.struct(F.col("name"), F.col("value"), F.col("unit"), F.struct("quote", (F.col("confidence") / 8.0).alias("confidence")).alias("evidence"))
    return record_messages(mentions.groupBy("pmcid").agg(F.collect_list(record).alias("reagents")), shortest=12)


def record_messages(papers: DataFrame, shortest: int = 5) -> DataFrame:
    """message, level, n, n_papers for papers with an array of reagents."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    checks = {
        ("empty_name", "error"): lambda r: blank(r["name"]),
        ("value_without_unit", "warning"): lambda r: r["value"].isNotNull() & (F.coalesce(r["unit"], F.lit("")) == ""),
        ("empty_quote", "error"): lambda r: r["evidence"]["quote"].isNotNull() & blank(r["evidence"]["quote"]),
        ("short_quote", "warning"): lambda r: ~blank(r["evidence"]["quote"]) & (F.length(r["evidence"]["quote"]) < shortest),
        ("confidence_out_of_range", "error"): lambda r: ~r["evidence"]["confidence"].between(0, 1),
    }

    def hits(check: Callable[[Column], Column]) -> Column:
        return F.size(F.filter("reagents", lambda r: F.coalesce(check(r), F.lit(False))))

    counted = papers.select(*[hits(check).alias(m) for (m, _), check in checks.items()])
    stacked = ", ".join(f"'{m}', '{level}', {m}" for m, level in checks)
    return counted.selectExpr(f"stack({len(checks)}, {stacked}) AS (message, level, k)").groupBy("message", "level").agg(F.sum("k").alias("n"), F.count_if(F.col("k") > 0).alias("n_papers"))


# ------------------------------------------------------------------------------- texts and stages

_NAME_PATTERN = r"(?i)(?<![A-Za-z0-9])(EGF|Noggin|CHIR 99021|bFGF|heparin|SHH|N2)(?![A-Za-z0-9])"
_DOSE_PATTERN = r"(\d+(?:\.\d+)?)\s*(ng/mL|ug/mL|uM|nM|mM|%)"


@_query(
    "x36_rule_extraction",
    "mentions",
    r"""WITH t AS (SELECT pmcid, pos, concat('We added ', coalesce(name, 'salt'), ' at ', CAST(CAST(coalesce(value, 0) AS INT) AS VARCHAR), CASE WHEN pos % 2 = 0 THEN ' ng/mL' ELSE ' drops of water and more ng/mL' END, ' then.') AS s FROM mentions),
h AS (SELECT pmcid, pos, s, regexp_extract(s, '(?i)(?:^|[^A-Za-z0-9])(EGF|Noggin|CHIR 99021|bFGF|heparin|SHH|N2)(?:$|[^A-Za-z0-9])', 1) AS found FROM t),
w AS (SELECT pmcid, pos, found, substring(s, position(found IN s), length(found) + 25) AS near FROM h WHERE found <> '')
SELECT pmcid, pos, found, CASE WHEN regexp_extract(near, '(\d+(?:\.\d+)?)\s*(ng/mL|ug/mL|uM|nM|mM|%)', 1) <> '' THEN CAST(regexp_extract(near, '(\d+(?:\.\d+)?)\s*(ng/mL|ug/mL|uM|nM|mM|%)', 1) AS DOUBLE) END AS value,
  nullif(regexp_extract(near, '(\d+(?:\.\d+)?)\s*(ng/mL|ug/mL|uM|nM|mM|%)', 2), '') AS unit FROM w""",
)
def rule_extraction(mentions: DataFrame) -> DataFrame:
    """Names of a dictionary in the sentences of a text, and the dose that follows one within 25
    characters."""
    dose = F.when(F.col("pos") % 2 == 0, " ng/mL").otherwise(" drops of water and more ng/mL")
    text = F.concat(F.lit("Cells rest. We added "), F.coalesce("name", F.lit("salt")), F.lit(" at "), F.coalesce("value", F.lit(0)).cast("int").cast("string"), dose, F.lit(" then. Wash!"))
    return extract_doses(mentions.select("pmcid", "pos", text.alias("text")), "pmcid", "pos")


def extract_doses(texts: DataFrame, *keys: str) -> DataFrame:
    """keys, found, value, unit of the texts (keys, text)."""
    sentences = texts.select(*keys, F.explode(F.split("text", r"(?<=[.!?])\s+")).alias("s")).withColumn("found", F.regexp_extract("s", _NAME_PATTERN, 1)).where("found <> ''")
    near = F.substr("s", F.expr("locate(found, s)"), F.length("found") + 25)
    value, unit = F.regexp_extract(near, _DOSE_PATTERN, 1), F.regexp_extract(near, _DOSE_PATTERN, 2)
    return sentences.select(*keys, "found", F.when(value != "", value.cast("double")).alias("value"), F.nullif(unit, F.lit("")).alias("unit"))


@_query("e08_stage_scores", "stages")
def stage_scores(stages: DataFrame) -> DataFrame:
    """Predicted against gold stages of each paper: greedy one-to-one matches in the order of the
    predicted ones (day ranges that overlap by half of their union, or one name), counts of the
    segmentation, of reagents in matched stages, and the share of gold reagents found anywhere that
    are in the matched stage. A paper's stages are few and are scored together, in expressions."""
    key = lambda c: norm_key(F.coalesce(c, F.lit("")))
    day = lambda c: F.nullif(F.col(c).cast("double"), F.lit(float("nan")))
    names = F.array_distinct(F.filter(F.transform(F.split(F.coalesce("reagents", F.lit("")), ";"), key), lambda x: x != ""))
    # in the order of pos, null last; what shares one is in the order of its content
    rows = stages.select("pmcid", "side", F.struct(F.isnull("pos").alias("unplaced"), "pos", key(F.col("name")).alias("key"), day("day_start").alias("start"), day("day_end").alias("end"), names.alias("names")).alias("stage"))
    of_side = lambda s: F.array_sort(F.collect_list(F.when(F.col("side") == s, F.col("stage")))).alias(s)
    papers = rows.groupBy("pmcid").agg(of_side("pred"), of_side("gold"))

    def alike(p: Column, g: Column) -> Column:
        shared = F.greatest(F.lit(0.0), F.least(p["end"], g["end"]) - F.greatest(p["start"], g["start"]))
        union = p["end"] - p["start"] + g["end"] - g["start"] - shared
        known_days = p["start"].isNotNull() & p["end"].isNotNull() & g["start"].isNotNull() & g["end"].isNotNull()
        overlap = F.when(union > 0, 2 * shared >= union).otherwise(p["start"] == g["start"])
        return F.when(known_days & overlap, True).otherwise((p["key"] == g["key"]) & (p["key"] != ""))

    def matched(of: Column, p: Column) -> Column:
        """of: for each gold stage the reagents of the predicted one that has it, else null."""
        first = F.array_position(F.zip_with("gold", of, lambda g, o: o.isNull() & alike(p, g)), True)
        # an array of one, so that the place is found once
        return F.transform(F.array(first), lambda j: F.transform(of, lambda o, k: F.when(k + 1 == j, p["names"]).otherwise(o)))[0]

    nothing = F.transform("gold", lambda g: F.lit(None).cast("array<string>"))
    papers = papers.select("pmcid", "pred", "gold", F.aggregate("pred", nothing, matched).alias("of"))
    total = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda n, x: n + x)
    anywhere = F.array_distinct(F.flatten(F.transform("pred", lambda p: p["names"])))
    paired = lambda f: total(F.zip_with("of", "gold", lambda o, g: F.when(o.isNull(), 0).otherwise(f(o, g["names"]))))
    counts = papers.select(
        "pmcid", F.size("pred").cast("long").alias("n_pred"), F.size("gold").cast("long").alias("n_gold"), F.size(F.filter("of", lambda o: o.isNotNull())).cast("long").alias("tp"),
        paired(lambda p, g: F.size(F.array_intersect(p, g))).alias("both"), paired(lambda p, g: F.size(p)).alias("of_pred"), paired(lambda p, g: F.size(g)).alias("of_gold"),
        F.transform(F.array(anywhere), lambda a: total(F.transform("gold", lambda g: F.size(F.array_intersect(g["names"], a)))))[0].alias("asked"),
    )
    share = lambda k, n: F.bround(k / n, 4)
    n_pred, n_gold, tp = (F.col(c) for c in ("n_pred", "n_gold", "tp"))
    return counts.select(
        "pmcid", "n_pred", "n_gold", F.abs(n_pred - n_gold).alias("count_error"), tp.alias("seg_tp"), (n_pred - tp).alias("seg_fp"), (n_gold - tp).alias("seg_fn"),
        F.when(n_pred + n_gold > 0, share(2 * tp, n_pred + n_gold)).otherwise(0.0).alias("seg_f1"),
        F.col("both").alias("reagent_tp"), (F.col("of_pred") - F.col("both")).alias("reagent_fp"), (F.col("of_gold") - F.col("both")).alias("reagent_fn"),
        F.when(F.col("asked") > 0, share(F.col("both"), F.col("asked"))).alias("attribution"),
    )


# ------------------------------------------------------------------------------------- retrieval


def _unit(c: str) -> Column:
    v = F.col(c).cast("array<double>")
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    return F.when(norm > 0, F.transform(v, lambda x: x / norm))


@_query(
    "r04_semantic_precision",
    "embeddings",
    """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL),
q AS (SELECT label AS ql, min(vec_id) AS qid FROM e GROUP BY label), asked AS (SELECT q.ql, q.qid, e.v AS qv FROM q JOIN e ON e.vec_id = q.qid),
s AS (SELECT ql, label, row_number() OVER (PARTITION BY ql ORDER BY round(list_inner_product(v, qv) / sqrt(list_inner_product(v, v) * list_inner_product(qv, qv)), 9) DESC, vec_id) AS rn FROM asked JOIN e ON e.vec_id <> asked.qid)
SELECT ql AS label, sum(CASE WHEN label = ql THEN 1 ELSE 0 END) / 10 AS precision_at_10 FROM s WHERE rn <= 10 GROUP BY ql""",
)
def semantic_precision(embeddings: DataFrame, k: int = 10) -> DataFrame:
    """Precision among the best k by cosine, for one query of each label (its first vector). The
    queries, one a label, are a stated set against all rows; each task keeps its best rows first."""
    e = embeddings.where("embedding IS NOT NULL").select("vec_id", "label", _unit("embedding").alias("v"))
    first = e.groupBy(F.col("label").alias("ql")).agg(F.min_by("v", "vec_id").alias("qv"), F.min("vec_id").alias("qid"))
    asked = F.broadcast(first) if first.count() <= 10_000 else first
    dot = F.aggregate(F.zip_with("v", "qv", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    s = e.join(asked, F.col("vec_id") != F.col("qid")).select("ql", "label", "vec_id", F.round(dot, 9).alias("c"))
    rank = F.row_number().over(Window.partitionBy("ql").orderBy(F.desc("c"), "vec_id"))
    return s.withColumn("rn", rank).where(F.col("rn") <= k).groupBy(F.col("ql").alias("label")).agg((F.count_if(F.col("label") == F.col("ql")) / k).alias("precision_at_10"))


@_query(
    "r04_lexical_precision",
    "documents",
    """WITH tok AS (SELECT doc_id, lang, w, count(*) AS f FROM (SELECT doc_id, lang, unnest(string_split(lower(text), ' ')) AS w FROM documents WHERE text IS NOT NULL) x WHERE w <> '' GROUP BY doc_id, lang, w),
n AS (SELECT count(DISTINCT doc_id) AS n FROM tok), df AS (SELECT w, ln(CAST((SELECT n FROM n) + 1 AS DOUBLE) / (count(*) + 1)) + 1 AS idf FROM tok GROUP BY w),
v AS (SELECT tok.doc_id, tok.lang, tok.w, tok.f * df.idf AS x FROM tok JOIN df ON df.w = tok.w), nrm AS (SELECT doc_id, sqrt(sum(x * x)) AS n FROM v GROUP BY doc_id),
q AS (SELECT lang, min(doc_id) AS qid FROM tok GROUP BY lang),
s AS (SELECT q.lang AS ql, d.doc_id, max(d.lang) AS lang, round(sum(d.x * a.x) / max(nd.n * na.n), 9) AS c FROM q JOIN v a ON a.doc_id = q.qid JOIN v d ON d.w = a.w AND d.doc_id <> q.qid JOIN nrm nd ON nd.doc_id = d.doc_id JOIN nrm na ON na.doc_id = q.qid GROUP BY q.lang, d.doc_id)
SELECT ql AS lang, sum(CASE WHEN lang = ql THEN 1 ELSE 0 END) / 10 AS precision_at_10 FROM (SELECT *, row_number() OVER (PARTITION BY ql ORDER BY c DESC, doc_id) AS rn FROM s) y WHERE rn <= 10 GROUP BY ql""",
)
def lexical_precision(documents: DataFrame, k: int = 10) -> DataFrame:
    """Precision among the best k by TF-IDF cosine, for one query of each language (its first
    document). Only the queries' words are joined; lengths come from all words."""
    words = documents.where("text IS NOT NULL").select("doc_id", "lang", F.explode(F.split(F.lower("text"), " ")).alias("w")).where("w <> ''")
    tok = words.groupBy("doc_id", "lang", "w").agg(F.count("*").alias("f"))
    n = documents.where("text IS NOT NULL AND length(trim(text)) > 0").select("doc_id").distinct().count()
    idf = tok.groupBy("w").agg((F.log(F.lit(n + 1.0) / (F.count("*") + 1)) + 1).alias("idf"))
    v = tok.join(idf, "w").select("doc_id", "lang", "w", (F.col("f") * F.col("idf")).alias("x"))
    norm = v.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("n"))
    q = v.groupBy("lang").agg(F.min("doc_id").alias("qid")).withColumnRenamed("lang", "ql")
    a = v.join(q, F.col("doc_id") == F.col("qid")).select("ql", "qid", "w", F.col("x").alias("qx"))
    hit = v.join(a, "w").where("doc_id <> qid").groupBy("ql", "qid", "doc_id").agg(F.max("lang").alias("lang"), F.sum(F.col("x") * F.col("qx")).alias("dot"))
    s = hit.join(norm, "doc_id").join(norm.select(F.col("doc_id").alias("qid"), F.col("n").alias("qn")), "qid").withColumn("c", F.round(F.col("dot") / (F.col("n") * F.col("qn")), 9))
    rank = F.row_number().over(Window.partitionBy("ql").orderBy(F.desc("c"), "doc_id"))
    return s.withColumn("rn", rank).where(F.col("rn") <= k).groupBy(F.col("ql").alias("lang")).agg((F.count_if(F.col("lang") == F.col("ql")) / k).alias("precision_at_10"))


# ------------------------------------------------------------------------- filters and proposals

_TESTS: dict[str, Callable[[Column, str], Column]] = {
    "exact": lambda c, v: c.cast("string") == v,
    "not": lambda c, v: c.cast("string") != v,
    "contains": lambda c, v: F.contains(c.cast("string"), F.lit(v)),
    "notcontains": lambda c, v: ~F.contains(c.cast("string"), F.lit(v)),
    "like": lambda c, v: c.cast("string").like(v),
    "gt": lambda c, v: c.cast("double") > float(v),
    "gte": lambda c, v: c.cast("double") >= float(v),
    "lt": lambda c, v: c.cast("double") < float(v),
    "lte": lambda c, v: c.cast("double") <= float(v),
    "in": lambda c, v: c.cast("string").isin(*[x.strip() for x in v.split(",")]),
    "arraycontains": lambda c, v: F.array_contains(c, v),
    "isnull": lambda c, v: c.isNull() == (v not in ("0", "false")),
}


def facet_filter(df: DataFrame, params: dict[str, str]) -> DataFrame:
    """Rows that pass all of `column__test=value` (no test: exact). Unknown columns and tests, and
    numbers that are none, raise ValueError."""
    for name, value in params.items():
        column, _, test = name.partition("__")
        if column not in df.columns or (test or "exact") not in _TESTS:
            raise ValueError(f"no such filter: {name}")
        df = df.where(_TESTS[test or "exact"](F.col(f"`{column}`"), value))
    return df


@_query(
    "f06_faceted_rows",
    "mentions",
    "SELECT pmcid, pos, name FROM mentions WHERE contains(name, 'o') AND NOT contains(kind, 'supp') AND value >= 10 AND value < 40 AND pos IN (1, 2, 3) AND name LIKE 'N%'",
)
def faceted_rows(mentions: DataFrame) -> DataFrame:
    params = {"name__contains": "o", "kind__notcontains": "supp", "value__gte": "10", "value__lt": "40", "pos__in": "1,2,3", "name__like": "N%"}
    return facet_filter(mentions, params).select("pmcid", "pos", "name")


def find_terms(df: DataFrame, column: str, *terms: str) -> DataFrame:
    """Rows whose text has all terms, case ignored; a term is taken letter by letter."""
    import re

    for t in terms:
        df = df.where(F.col(column).rlike("(?i)" + re.escape(t)))
    return df


@_query("f04_two_terms", "manuscripts", "SELECT pmcid, failure FROM manuscripts WHERE contains(lower(failure), 'low') AND contains(lower(failure), 'few org')")
def two_terms(papers: DataFrame) -> DataFrame:
    return find_terms(papers, "failure", "LOW", "few org").select("pmcid", "failure")


def proposal_states(log: DataFrame) -> DataFrame:
    """The last state of each proposal of a log (id, ts, action, payload): insert makes it pending,
    accept and reject decide it, later events win; decisions on nothing are left out."""
    last = log.groupBy("id").agg(
        F.max(F.when(F.col("action") == "insert", F.struct("ts", "payload"))).alias("made"),
        F.max(F.when(F.col("action").isin("accept", "reject"), F.struct("ts", "action"))).alias("decided"),
    )
    state = F.when(F.col("decided.ts") >= F.col("made.ts"), F.concat("decided.action", F.lit("ed"))).otherwise("pending")
    return last.where("made IS NOT NULL").select("id", "made.payload", state.alias("state"))


def record(log: DataFrame, proposal_id: int, ts: int, action: str, payload: str | None = None) -> DataFrame:
    """The log with one more event."""
    if action not in ("insert", "accept", "reject"):
        raise ValueError(action)
    return log.unionByName(log.sparkSession.createDataFrame([(proposal_id, ts, action, payload)], log.schema))


@_query(
    "r15_proposal_states",
    "stages",
    """WITH l AS (SELECT pmcid AS id, pos AS ts, CASE side WHEN 'pred' THEN 'insert' ELSE CASE WHEN day_start % 2 = 0 THEN 'accept' ELSE 'reject' END END AS action, name AS payload FROM stages),
m AS (SELECT id, max(ts) AS ts FROM l WHERE action = 'insert' GROUP BY id), d AS (SELECT id, max(ts) AS ts FROM l WHERE action <> 'insert' GROUP BY id)
SELECT m.id, max(x.payload) AS payload, CASE WHEN max(d.ts) >= max(m.ts) THEN concat(max(y.action), 'ed') ELSE 'pending' END AS state FROM m JOIN l x ON x.id = m.id AND x.ts = m.ts AND x.action = 'insert'
LEFT JOIN d ON d.id = m.id LEFT JOIN l y ON y.id = d.id AND y.ts = d.ts AND y.action <> 'insert' GROUP BY m.id""",
)
def stage_proposals(stages: DataFrame) -> DataFrame:
    action = F.when(F.col("side") == "pred", "insert").when(F.col("day_start") % 2 == 0, "accept").otherwise("reject")
    return proposal_states(stages.select(F.col("pmcid").alias("id"), F.col("pos").alias("ts"), action.alias("action"), F.col("name").alias("payload")))


@_query(
    "x38_figure_files",
    "figures",
    f"SELECT file, count(*) AS n FROM figures WHERE regexp_matches(lower(file), '[.](jpg|jpeg|png|gif)$') AND regexp_matches(file, {_literal(V.FIGURE_FILE)}) AND NOT regexp_matches(file, {_literal(V.FIGURE_SKIP)}) GROUP BY file",
)
def figure_files(figures: DataFrame) -> DataFrame:
    """Files that are figures by their names; supplements, logos and the like are not (R14's gallery
    shows these, by facets)."""
    f = F.col("file")
    return figures.where(F.lower(f).rlike("[.](jpg|jpeg|png|gif)$") & f.rlike(V.FIGURE_FILE) & ~f.rlike(V.FIGURE_SKIP)).groupBy("file").agg(F.count("*").alias("n"))


@_query(
    "r14_gallery",
    "figures",
    "WITH c AS (SELECT pmcid, label, file FROM figures WHERE file LIKE '%Fig%') SELECT label, count(*) AS n, count(DISTINCT pmcid) AS n_papers FROM c WHERE label IN ('Figure 1', 'Figure 2') GROUP BY label",
)
def gallery(figures: DataFrame) -> DataFrame:
    """The gallery's facets: figures of some labels, by label."""
    return facet_filter(figures, {"file__contains": "Fig", "label__in": "Figure 1,Figure 2"}).groupBy("label").agg(F.count("*").alias("n"), F.count_distinct("pmcid").alias("n_papers"))


def check_request(query: dict) -> tuple[int, str]:
    """What a graph request is answered with before it is planned: (status, reason)."""
    graph = query.get("message", {}).get("query_graph") if isinstance(query.get("message"), dict) else None
    if not isinstance(graph, dict) or not graph.get("nodes") or not graph.get("edges"):
        return 400, "no query graph"
    nodes, edges = graph["nodes"], graph["edges"]
    if len(edges) > 2:
        return 400, "more than two edges"
    for name, e in edges.items():
        if not {e.get("subject"), e.get("object")} <= set(nodes):
            return 400, f"edge {name} has an end that is no node"
    if len(edges) == 2 and len(set.intersection(*({e["subject"], e["object"]} for e in edges.values()))) != 1:
        return 400, "two edges must share one node"
    return 200, "ok"
