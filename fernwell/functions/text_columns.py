"""Column functions for texts and units, and the operators that need a scan position by position.

Everything but the scan of raw pages is built-in expressions."""

from __future__ import annotations

from collections.abc import Callable
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .vocabulary import ACTIVITY_UNIT, MASS_UNIT, MOLAR

# Greek letters that names are folded to.
GREEK = {"α": "alpha", "β": "beta", "γ": "gamma", "δ": "delta", "κ": "kappa", "μ": "mu", "µ": "mu"}


def norm_key(c: Column) -> Column:
    """Lower case, letters and digits only."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def greek_key(c: Column) -> Column:
    c = F.lower(c)
    for letter, name in GREEK.items():
        c = F.replace(c, F.lit(letter), F.lit(name))
    return norm_key(c)


def slug(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), F.lit("_"))


def snippet(c: Column, n: int) -> Column:
    """White space folded, cut to n characters with an ellipsis."""
    flat = F.trim(F.regexp_replace(c, r"\s+", " "))
    return F.when(F.length(flat) > n, F.concat(F.substring(flat, 1, n - 1), F.lit("…"))).otherwise(flat)


def canonical_unit(c: Column) -> Column:
    """One spelling for units of concentration, else the text with micro signs and dashes folded."""
    s = F.translate(F.trim(c), "µμ−", "uu-")
    low = F.lower(s)
    bare = F.replace(low, F.lit(" "), F.lit(""))
    known = lambda x, table: F.coalesce(*[F.when(x == k, F.lit(v)) for k, v in table.items()])
    part = lambda p, k: F.regexp_extract(low, p, k)
    mass = F.concat(part(MASS_UNIT, 1), F.lit("/"), known(part(MASS_UNIT, 2), {"ml": "mL", "ul": "uL", "l": "L"}))
    return (
        F.when(c.isNull() | (c == ""), F.lit(None))
        .when(low.rlike(MASS_UNIT), mass)
        .when(low.rlike(ACTIVITY_UNIT), known(part(ACTIVITY_UNIT, 1), {"u": "U/mL", "mu": "mU/mL", "iu": "IU/mL", "kiu": "kIU/mL"}))
        .when(known(bare, MOLAR).isNotNull(), known(bare, MOLAR))
        .when(F.contains(s, F.lit("%")) | bare.isin("v/v", "w/v", "vv", "wv"), F.lit("%"))
        .otherwise(s)
    )


def value_in_quote(value: Column, quote: Column) -> Column:
    """Whether the number stands in the quote, not as part of a longer one."""
    whole = F.when(value == F.floor(value), value.cast("long").cast("string")).otherwise(value.cast("string"))
    return F.regexp_like(quote, F.concat(F.lit(r"(?<![\d.])"), F.regexp_replace(whole, r"\.", r"\\."), F.lit(r"(?![\d.]*\d)")))


class _Sections(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.title, self.headings, self.links, self.text, self._in = "", 0, 0, [], []

    def handle_starttag(self, tag, attrs):  # noqa: ANN001
        self._in.append(tag)
        self.headings += tag in ("h1", "h2", "h3")
        self.links += tag == "a" and any(k == "href" for k, _ in attrs)

    def handle_endtag(self, tag):  # noqa: ANN001
        while self._in and self._in.pop() != tag:
            pass

    def handle_data(self, data):  # noqa: ANN001
        if "script" in self._in or "style" in self._in:
            return
        if "title" in self._in:
            self.title += data
        elif data.strip():
            self.text.append(" ".join(data.split()))


def page_sections(pages: DataFrame) -> DataFrame:
    """page_id, title, n_headings, n_links, n_text of raw markup (T01's analogue)."""

    @F.pandas_udf("struct<title: string, n_headings: long, n_links: long, n_text: long>")
    def parse(html):  # noqa: ANN001, ANN202
        import pandas as pd

        rows = []
        for h in html.fillna(""):
            p = _Sections()
            p.feed(h)
            rows.append((p.title.strip(), p.headings, p.links, sum(map(len, p.text))))
        return pd.DataFrame(rows, columns=["title", "n_headings", "n_links", "n_text"])

    return pages.select("page_id", parse("html").alias("s")).select("page_id", "s.*")


def greedy_intervals(spans: DataFrame) -> DataFrame:
    """key, starts: non-overlapping spans taken in order, each after the end of the last taken; a
    fold over the sorted array of a key (W13)."""
    return spans.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("s")).select(
        "key",
        F.expr(
            "aggregate(s, struct(CAST(-1 AS BIGINT) AS e, CAST(array() AS array<bigint>) AS o),"
            " (a, x) -> IF(x.start >= a.e, struct(x.end AS e, array_append(a.o, x.start) AS o), a), a -> array_join(a.o, ','))"
        ).alias("starts"),
    )


def _spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return greedy_intervals(
        spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
            F.col("conv_id").alias("key"), (F.col("turn") * 40).cast("long").alias("start"), (F.col("turn") * 40 + F.length("text")).cast("long").alias("end")
        )
    )


def _quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fernwell.catalog import relation

    r = relation(spark, sf_dir, "reagents").where("evidence_quote IS NOT NULL AND value IS NOT NULL")
    return r.groupBy("kind").agg(F.count_if(value_in_quote(F.col("value"), F.col("evidence_quote"))).alias("n_in_quote"), F.count("*").alias("n"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "t01_page_sections": lambda s, d: page_sections(s.read.parquet(f"{d}/pages.parquet")),
    "w13_greedy_intervals": _spans,
    "x16_value_in_quote": _quotes,
}
ORACLE: dict[str, str] = {}
