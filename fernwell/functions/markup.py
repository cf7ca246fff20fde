"""Full-text articles in XML as columns, and citations that hand a method to another text. Both need
a parser or positions, and run in Arrow batches; the rest of their queries is built-in."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.shape import SHAPES

# Titles and types of sections that are, or are not, methods; of supplements.
METHOD_TYPES = re.compile(r"method|materials", re.I)
METHOD_TITLES = re.compile(
    r"(materials?\s*(and|&)\s*methods?|^\s*methods?\b|methodology|experimental\s+(procedures?|methods?|section|design)|star\s*methods|online\s*methods|methods?\s*summary)", re.I
)
OTHER_TITLES = re.compile(
    r"\b(introduction|background|results?|discussion|conclusion|abstract|acknowledg|author\s+contribution|competing|conflict\s+of\s+interest|funding|"
    r"data\s+availability|code\s+availability|references?|bibliography|supplementary|supporting\s+information)\b",
    re.I,
)
SUPPLEMENT_TITLES = re.compile(r"supplementary|supporting\s+information", re.I)
_LINK = "{http://www.w3.org/1999/xlink}href"
_ARTICLE = (
    "article_type string, methods string, detected boolean, n_body long, captions array<string>, tables array<string>, refs array<string>, supplements array<string>, "
    "links array<string>, sections map<string, long>, warnings array<string>"
)


def _named(e: ElementTree.Element, *names: str) -> list[ElementTree.Element]:
    """All elements below e with one of the names, whatever their namespace."""
    return [x for x in e.iter() if isinstance(x.tag, str) and x.tag.rpartition("}")[2] in names and x is not e]


def _children(e: ElementTree.Element | None, name: str) -> list[ElementTree.Element]:
    return [] if e is None else [x for x in e if isinstance(x.tag, str) and x.tag.rpartition("}")[2] == name]


def _words(e: ElementTree.Element | None) -> str:
    return "" if e is None else " ".join(" ".join(t.split()) for t in e.itertext() if t.strip())


def _title(e: ElementTree.Element) -> str:
    return next((_words(t) for t in _children(e, "title")), "")


def _is_methods(section: ElementTree.Element, back: bool) -> bool:
    """In the body all that is not clearly something else; after it, what says so."""
    kind = (section.get("sec-type") or "").lower()
    if back:
        return bool(METHOD_TYPES.search(kind) or METHOD_TITLES.search(_title(section)))
    return "supplementary" not in kind and bool(METHOD_TYPES.search(kind) or not OTHER_TITLES.search(_title(section)))


def article(xml: str | None) -> dict:
    """The parts of an article; markup that cannot be read gives empty parts and a warning."""
    empty = {"article_type": "", "methods": "", "detected": False, "n_body": 0, "captions": [], "tables": [], "refs": [], "supplements": [], "links": [], "sections": {}, "warnings": []}
    try:
        root = ElementTree.fromstring(xml or "")
    except ElementTree.ParseError:
        return empty | {"warnings": ["unreadable"]}
    bodies, backs = _named(root, "body"), _named(root, "back")
    body = bodies[0] if bodies else None
    top = _children(body, "sec")
    from_body = [s for s in top if _is_methods(s, False)]
    from_back = [s for b in backs[:1] for s in _children(b, "sec") if _is_methods(s, True)]
    methods = [_words(s) for s in from_body + from_back]
    attached = _named(root, "supplementary-material")
    supplements = [_words(s) for s in [*attached, *(s for s in _named(body, "sec") if SUPPLEMENT_TITLES.search(_title(s)))]] if body is not None else [_words(s) for s in attached]
    once = lambda xs: list(dict.fromkeys(x for x in xs if x))
    captions = [next((_words(c) for c in _children(f, "caption")), "") for f in _named(root, "fig")]
    tables = [_words(t) for t in _named(root, "table-wrap")]
    said = {
        "whole_body_as_methods": not methods, f"methods_in_back:{len(from_back)}": bool(from_back), "no_supplement": not attached, f"tables:{len(tables)}": bool(tables),
        f"figures:{len(captions)}": bool(captions), "no_body": body is None,
    }
    return {
        "article_type": root.get("article-type", ""), "methods": "\n\n".join(methods) if methods else _words(body), "detected": bool(methods), "n_body": len(_words(body)),
        "captions": captions, "tables": tables, "refs": [_words(r)[:500] for r in _named(root, "ref")], "supplements": once(supplements),
        "links": once(e.get(_LINK) for e in _named(root, "ext-link")), "sections": {_title(s) or "(untitled)": len(_words(s)) for s in top},
        "warnings": [w for w, holds in said.items() if holds],
    }


def articles(df: DataFrame, key: str = "pmcid") -> DataFrame:
    """key and the parts of the articles in column xml."""

    @F.pandas_udf(_ARTICLE)
    def parse(xml):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.DataFrame([article(x) for x in xml])

    return df.select(key, parse("xml").alias("a")).select(key, "a.*")


# Phrases that hand a method to another text, what must stand near and what must not.
_PHRASE = re.compile(
    r"(as (?:previously |prev\.? )?described|previously described|based on (?:a )?(?:previously described|the) (?:protocol|method)|"
    r"modif\w+ (?:of|the) [^.]{0,40}?(?:protocol|method)|adapted from)",
    re.I,
)
_CULTURE = re.compile(r"(different\w+|cultur\w+|organoid|expand\w+|passag\w+|maintain\w+|embryoid|definitive endoderm|spheroid|staged|reprogram\w+)", re.I)
_ASSAY = re.compile(
    r"(sequenc\w+|immuno\w+|stain\w+|antibod\w+|qPCR|RNA-?seq|FACS|flow cytom\w+|histolog\w+|imaging|microscop\w+|\bmice\b|\bmouse\b|western|ELISA|genotyp\w+|library prep|reprogram\w+ using)",
    re.I,
)
_OWN = re.compile(
    r"(step\s*\d|steps\s*\d|procedure step|section (?:above|below)|Extended (?:Experimental|Data)|as described (?:above|below)|in ref\.?\s*\d|previous section|earlier in)", re.I
)
_BY_NAME = re.compile(r"\(([A-Z][A-Za-z\-]+)\s+et\s+al\.?\s*,?\s*(\d{4})[a-z]?\s*\)")
_BY_NUMBER = re.compile(r"described[^.]{0,40}?\b\d{1,3}\b")


def delegation(text: str | None) -> dict | None:
    """The first phrase with culture near it, no assay and no self-reference close to it, and a
    citation by name or number after it."""
    text = (text or "").replace("\xa0", " ")
    for m in _PHRASE.finditer(text):
        s, e = m.span()
        close = text[max(0, s - 70) : e + 70]
        if not _CULTURE.search(text[max(0, s - 120) : e + 140]) or _ASSAY.search(close) or _OWN.search(close):
            continue
        name = _BY_NAME.search(text[s : e + 90])
        if name or _BY_NUMBER.search(text[max(0, s - 10) : e + 50]):
            author, year = name.groups() if name else (None, None)
            return {"position": s, "context": close.replace("\n", " ").strip(), "kind": "named" if name else "numbered", "author": author, "year": year}
    return None


def delegations(df: DataFrame, key: str = "pmcid", text: str = "methods") -> DataFrame:
    """key, position, context, kind, author, year of texts that hand their method on."""

    @F.pandas_udf("struct<position: long, context: string, kind: string, author: string, year: string>")
    def find(texts):  # noqa: ANN001, ANN202
        import pandas as pd

        none = dict.fromkeys(("position", "context", "kind", "author", "year"))
        out = pd.DataFrame([delegation(t if isinstance(t, str) else None) or none for t in texts], columns=list(none))
        return out.astype({"position": "Int64"})

    return df.select(key, find(text).alias("d")).where("d.position IS NOT NULL").select(key, "d.*")


def _relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from ..catalog import relation

    return relation(spark, sf_dir, name)


def _counts(df: DataFrame, arrays: Iterable[str]) -> DataFrame:
    return df.select(
        "pmcid", "article_type", "methods", F.col("detected").cast("int").alias("detected"), *[F.size(a).cast("long").alias(f"n_{a}") for a in arrays],
        F.array_join(F.array_sort(F.map_keys("sections")), "|").alias("sections"),
    )


def _articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(articles(_relation(spark, sf_dir, "articles")), ("captions", "tables", "refs", "supplements", "links"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "t01_article_sections": _articles,
    "t09_delegations": lambda spark, sf_dir: delegations(_relation(spark, sf_dir, "manuscripts")),
}
ORACLE: dict[str, str] = {
    "t01_article_sections": f"""
WITH manuscripts AS ({SHAPES['manuscripts'][1].strip()})
SELECT pmcid, coalesce(article_type, '') AS article_type, CASE WHEN year % 3 = 0 THEN trim(concat('Results We saw growth. ', coalesce(methods, ''))) WHEN year % 3 = 1 THEN trim(concat('Methods ', coalesce(methods, '')))
    ELSE trim(concat('Online Methods ', coalesce(methods, ''))) END AS methods, CASE WHEN year % 3 = 0 THEN 0 ELSE 1 END AS detected, CAST(1 AS BIGINT) AS n_captions, CAST(year % 2 AS BIGINT) AS n_tables, CAST(2 AS BIGINT) AS n_refs,
  CAST(0 AS BIGINT) AS n_supplements, CAST(1 AS BIGINT) AS n_links, CASE WHEN year % 3 = 1 THEN 'Methods|Results' ELSE 'Results' END AS sections FROM manuscripts"""
}
