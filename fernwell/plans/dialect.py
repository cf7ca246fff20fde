"""Operators are SQL plans over named relations. Most text is common to Spark and to the SQL engine
that the results are held against; a Dialect writes what is not."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field


def q(x: str, places: int = 4) -> str:
    """Rounds half up in double precision, alike on both engines."""
    k = f"1e{places}"
    return f"(floor(({x}) * {k} + 5e-1) / {k})"


def rate(k: str, n: str, places: int = 4) -> str:
    """k / n rounded; 0 where n is 0."""
    return f"coalesce({q(f'CAST({k} AS DOUBLE) / nullif({n}, 0)', places)}, 0e0)"


def text(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("'", "''") + "'"


@dataclass(frozen=True)
class Dialect:
    name: str

    @property
    def spark(self) -> bool:
        return self.name == "spark"

    def joined_set(self, x: str, sep: str = "|") -> str:
        """Aggregate: the distinct values in order, as one string."""
        if self.spark:
            return f"array_join(array_sort(collect_set({x})), '{sep}')"
        return f"coalesce(array_to_string(list_sort(list_distinct(list({x}))), '{sep}'), '')"

    def joined_list(self, x: str, order: str, sep: str = "|") -> str:
        """Aggregate: all values in the order of another expression."""
        if self.spark:
            return f"array_join(transform(array_sort(collect_list(struct({order} AS o, {x} AS x))), z -> z.x), '{sep}')"
        return f"coalesce(string_agg({x}, '{sep}' ORDER BY {order}, {x}), '')"

    def upper_median(self, x: str) -> str:
        """Aggregate: the element at index n // 2 of the sorted values."""
        if self.spark:
            return f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {x} DESC)"
        return f"list_extract(list_sort(list({x}) FILTER (WHERE {x} IS NOT NULL)), CAST(floor(count({x}) / 2) AS INT) + 1)"

    def matches(self, x: str, pattern: str) -> str:
        return f"{x} RLIKE {self.pattern(pattern)}" if self.spark else f"regexp_matches({x}, {text(pattern)})"

    def pattern(self, p: str) -> str:
        """A pattern literal; Spark's parser takes backslashes in literals for itself."""
        return text(p.replace("\\", "\\\\") if self.spark else p)

    def sub(self, x: str, pattern: str, to: str) -> str:
        extra = "" if self.spark else ", 'g'"
        return f"regexp_replace({x}, {self.pattern(pattern)}, {text(to)}{extra})"

    def words(self, x: str) -> str:
        """The lower-case words of a text, one per row: use as `FROM t <words>`, column w."""
        if self.spark:
            return f"LATERAL VIEW explode(regexp_extract_all(lower({x}), '[a-z0-9]+', 0)) tok AS w"
        return f", unnest(regexp_extract_all(lower({x}), '[a-z0-9]+')) tok(w)"

    def parts(self, x: str, sep: str, alias: str = "item") -> str:
        """The pieces between separators, one per row, column <alias>."""
        if self.spark:
            return f"LATERAL VIEW explode(split({x}, {self.pattern(sep)})) pieces AS {alias}"
        return f", unnest(regexp_split_to_array({x}, {text(sep)})) pieces({alias})"

    def lookup(self, x: str, table: dict[str, str], default: str = "NULL") -> str:
        """The value that a table has for x, else the default expression."""
        return f"CASE {x} " + " ".join(f"WHEN {text(k)} THEN {text(v)}" for k, v in table.items()) + f" ELSE {default} END"

    def try_double(self, x: str) -> str:
        return f"try_cast({x} AS DOUBLE)"

    def epoch(self, ts: str) -> str:
        """Whole seconds since 1970."""
        return f"unix_seconds(CAST({ts} AS TIMESTAMP))" if self.spark else f"CAST(floor(epoch({ts})) AS BIGINT)"


SPARK, DUCKDB = Dialect("spark"), Dialect("duckdb")
Plan = Callable[..., str]


@dataclass
class Operator:
    """A named plan: text of a SELECT over relations, for a dialect and parameters."""

    key: str
    plan: Plan
    relations: tuple[str, ...]
    oracle: bool = True
    params: dict = field(default_factory=dict)
    #: Results that the plan uses more than once, by name, in the order in which they build on each
    #: other. They are kept (in memory or on local disk, made again where an executor is lost).
    steps: dict[str, Plan] = field(default_factory=dict)

    def sql(self, dialect: Dialect, **params) -> str:  # noqa: ANN003
        return self.plan(dialect, **(self.params | params))


OPERATORS: dict[str, Operator] = {}


def operator(key: str, *relations: str, oracle: bool = True, steps: dict[str, Plan] | None = None, **params) -> Callable[[Plan], Plan]:  # noqa: ANN003
    """Registers a plan under a key; relations are the inputs it names, steps what it uses more than
    once."""

    def put(plan: Plan) -> Plan:
        if key in OPERATORS:
            raise ValueError(f"{key} is there already")
        OPERATORS[key] = Operator(key, plan, relations, oracle, params, steps or {})
        return plan

    return put
