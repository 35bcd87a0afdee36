"""Predicates that go on where a value cannot be computed.

An error met on one value would end the scan that all rules share. So every part of a predicate that can
fail on values (casts, arithmetic, date parsing, element access) is replaced by the ``try_`` function that gives
null instead, and a second predicate tells such nulls from those of null input. Rules without such
parts stay as they are. What has no ``try_`` form, and fails all the same, still ends the scan.
"""

from dataclasses import dataclass

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Operators and functions that fail on values, and what gives null instead.
TRIED = {
    "Add": "try_add",
    "Subtract": "try_subtract",
    "Multiply": "try_multiply",
    "Divide": "try_divide",
    "Remainder": "try_mod",
    "GetArrayItem": "get",
    "to_date": "try_to_date",
    "to_timestamp": "try_to_timestamp",
    "gettimestamp": "try_to_timestamp",
    "element_at": "try_element_at",
    "to_number": "try_to_number",
    "to_binary": "try_to_binary",
    "make_timestamp": "try_make_timestamp",
    "parse_url": "try_parse_url",
}
#: Numeric types from narrow to wide; a cast to a wider one cannot fail.
WIDTHS = {"tinyint": 0, "smallint": 1, "int": 2, "bigint": 3, "float": 4, "double": 5}


@dataclass(frozen=True)
class Tolerant:
    """SQL texts: ``value`` is null where the predicate fails, ``failed`` is true there; null if it cannot fail.

    ``reasons`` names the errors that its parts would end with.
    """

    value: str
    failed: str | None
    reasons: str = ""


def _safe_cast(source: str, target: str) -> bool:
    if source == target or target == "string" or source == "void":
        return True
    if source in WIDTHS and target in WIDTHS:
        return WIDTHS[source] <= WIDTHS[target]
    if source in ("tinyint", "smallint", "int", "bigint") and target.startswith("decimal"):
        return target.startswith("decimal(20,0)") or target.startswith("decimal(38,")
    if source.startswith("decimal") and target in ("float", "double"):
        return True
    dates = ("date", "timestamp", "timestamp_ntz")
    return source in dates and target in dates


def _reason(kind: str, name: str) -> str:
    """Spark's name for the error of a part."""
    if kind == "Cast":
        return "CAST_INVALID_INPUT"
    if kind in ("Divide", "Remainder", "IntegralDivide"):
        return "DIVIDE_BY_ZERO"
    if kind in ("Add", "Subtract", "Multiply"):
        return "ARITHMETIC_OVERFLOW"
    if kind == "GetArrayItem" or name == "element_at":
        return "INVALID_ARRAY_INDEX"
    return "CANNOT_PARSE"


def _children(node) -> list:
    found = node.children()
    return [found.apply(i) for i in range(found.size())]


Failure = tuple[str, str]  # when a part fails, and how


def _analysed(df: DataFrame, predicate: str):
    plan = df.select(F.expr(predicate).alias("v"))._jdf.queryExecution().analyzed()
    return plan.expressions().apply(0).children().apply(0)


def _rewritten(df: DataFrame, node) -> tuple[str, list[Failure]]:
    """The text of an analysed expression in its tolerant form, and the conditions under which a part failed."""
    kind = node.getClass().getSimpleName()
    if kind == "Between":
        value, low, high = (part.sql() for part in (node.input(), node.lower(), node.upper()))
        return _rewritten(df, _analysed(df, f"(({value}) >= ({low}) AND ({value}) <= ({high}))"))
    original, children = node.sql(), _children(node)
    parts = [(child.sql(), *_rewritten(df, child)) for child in children]
    failed = [f for _, _, fails in parts for f in fails]
    name = node.prettyName().lower()
    inner = [new for _, new, _ in parts]

    def tried(text: str) -> tuple[str, list[Failure]]:
        held = " AND ".join(f"({part}) IS NOT NULL" for part in inner)
        return text, [*failed, (f"({held} AND ({text}) IS NULL)", _reason(kind, name))]

    if kind == "Cast":
        source, target = children[0].dataType().sql().lower(), node.dataType().sql().lower()
        if not _safe_cast(source, target):
            return tried(f"try_cast({inner[0]} AS {target})")
    elif kind in TRIED or name in TRIED:
        fractions = kind in ("Add", "Subtract", "Multiply") and node.dataType().sql().lower() in ("float", "double")
        if not fractions:
            return tried(f"{TRIED.get(kind) or TRIED[name]}({', '.join(inner)})")
    elif kind == "IntegralDivide":
        return tried(f"if(({inner[1]}) = 0, NULL, {inner[0]} div {inner[1]})")
    if inner == [old for old, _, _ in parts]:
        return original, failed
    if len(parts) == 1 and parts[0][0] not in original:
        # A function that stands for another expression: that one is what runs.
        return inner[0], failed
    # The text of a node holds those of its children, in their order.
    text, at = [], 0
    for old, new, _ in parts:
        place = original.find(old, at)
        if place < 0:
            raise ValueError(f"{old} not found in {original}")
        text += [original[at:place], new]
        at = place + len(old)
    return "".join([*text, original[at:]]), failed


def tolerant(df: DataFrame, predicate: str) -> Tolerant:
    """The tolerant form of a predicate that can be analysed on ``df``; only its schema is used.

    Casts that Spark puts in by itself, as for a text compared with a number, are seen too. A
    predicate whose parts fail counts as failed only where its outcome is unknown for it, so guards
    such as ``b <> 0 AND a / b > 1`` and ``coalesce`` keep their meaning.
    """
    try:
        value, failed = _rewritten(df, _analysed(df, predicate))
        if not failed:
            return Tolerant(predicate, None)
        any_part = " OR ".join(dict.fromkeys(when for when, _ in failed))
        flagged = f"(({value}) IS NULL AND ({any_part}))"
        # A form that Spark cannot read back is no use: the predicate stays as it was.
        _ = df.select(F.expr(value).cast("boolean"), F.expr(flagged).cast("boolean")).schema
    except (PySparkException, Py4JError, ValueError):
        return Tolerant(predicate, None)
    return Tolerant(value, flagged, ", ".join(dict.fromkeys(how for _, how in failed)))
