"""Aggregate expressions and the distributed exact median."""

from dataclasses import dataclass

from pyspark.sql import DataFrame

from assay.plans.shape import name, text


def pearson(x: str, y: str) -> str:
    """SQL aggregate: pairwise-complete correlation, NULL (not an error) for a constant column."""
    a, b = f"CAST({name(x)} AS DOUBLE)", f"CAST({name(y)} AS DOUBLE)"
    spread = f"stddev_pop(IF({b} IS NULL, NULL, {a})) * stddev_pop(IF({a} IS NULL, NULL, {b}))"
    return f"try_divide(covar_pop({a}, {b}), {spread})"


#: Relative error of the rank in Spark's quantile sketch is 1 / SKETCH.
SKETCH = 10_000
#: Values of a column that a pass brings back, at most.
KEEP = 10_000


@dataclass
class _Search:
    """The two middle ranks of a column, whose values lie in [low, high]; at most ``inside`` lie strictly between."""

    column: str
    n: int
    ends: tuple[float, float]
    low: float
    high: float
    inside: float
    bins: int
    slack: int = 1
    found: tuple[float, float] | None = None

    @property
    def ranks(self) -> tuple[int, int]:
        return (self.n - 1) // 2, self.n // 2

    def measures(self, v: str) -> str:
        """SQL aggregate of a pass: rows below, at and between the ends, and the values or quantiles between them."""
        low, high = (f"CAST({text(repr(end))} AS DOUBLE)" for end in (self.low, self.high))
        between = f"CASE WHEN {v} > {low} AND {v} < {high} THEN {v} END"
        if self.inside <= KEEP:
            seen = f"array_sort(collect_list({between}))"
        else:
            grid = ", ".join(f"{i / self.bins}D" for i in range(self.bins + 1))
            seen = f"percentile_approx({between}, array({grid}), {SKETCH})"
        return (
            f"named_struct('below', count_if({v} < {low}), 'at_low', count_if({v} = {low}), 'between', count({between}), "
            f"'at_high', count_if({v} = {high}), 'seen', {seen})"
        )

    def narrow(self, counted) -> None:
        """Take the counts of a pass: find both values or a smaller range."""
        first = counted["below"] + counted["at_low"]
        after = first + counted["between"]

        def value(rank: int) -> float | None:
            if counted["below"] <= rank < first:
                return self.low
            if after <= rank < after + (counted["at_high"] if self.high > self.low else 0):
                return self.high
            if first <= rank < after and self.inside <= KEEP:
                return counted["seen"][rank - first]
            return None

        values = tuple(value(rank) for rank in self.ranks)
        if None not in values:
            self.found = values
        elif self.ranks[0] < counted["below"] or self.ranks[1] >= after + counted["at_high"]:
            # Not where the sketch put it: a range that surely holds it, and more room for the sketch's error.
            self.low, self.high, self.inside, self.slack = *self.ends, self.n, 2 * self.slack
        else:
            share = [(rank - first) / max(counted["between"], 1) * self.bins for rank in self.ranks]
            grid = counted["seen"]
            low, high = int(share[0]) - self.slack, int(share[1]) + 1 + self.slack
            if low >= 0:
                self.low = grid[low]
            if high <= self.bins:
                self.high = grid[high]
            self.inside = counted["between"] * ((high - low) / self.bins + 2 / SKETCH)


def exact_medians(df: DataFrame, columns: list[str], bins: int = 256) -> dict[str, float | None]:
    """Exact median of each column without gathering the column anywhere; NaN counts as missing.

    A quantile sketch gives a range that holds both middle ranks and few rows. The next pass counts
    what lies below and in it and brings the values between its ends back, if they are sure to be at
    most ``KEEP``; else it asks a sketch of those values for ``bins + 1`` quantiles and so a smaller
    range. Up to some 16 million rows take two passes for all columns, a trillion takes four or five.
    """
    if not columns:
        return {}
    doubles = [f"CAST({name(c)} AS DOUBLE)" for c in columns]
    values = df.selectExpr(*[f"CASE WHEN NOT isnan({v}) THEN {v} END AS v{i}" for i, v in enumerate(doubles)])
    about = f"array({0.5 - 2 / SKETCH}D, {0.5 + 2 / SKETCH}D)"

    def one_row(measures: list[str]):
        return values.selectExpr(*[f"{m} AS m{i}" for i, m in enumerate(measures)]).first()

    ranges = one_row(
        [
            f"named_struct('n', count(v{i}), 'low', min(v{i}), 'high', max(v{i}), "
            f"'about', percentile_approx(v{i}, {about}, {SKETCH}))"
            for i in range(len(columns))
        ]
    )
    searches = {
        f"v{i}": _Search(c, r["n"], (r["low"], r["high"]), *r["about"], r["n"] * 6 / SKETCH, bins)
        for i, (c, r) in enumerate(zip(columns, ranges, strict=True))
        if r["n"]
    }
    while still := {v: s for v, s in searches.items() if s.found is None}:
        for s, counted in zip(still.values(), one_row([s.measures(v) for v, s in still.items()]), strict=True):
            s.narrow(counted)
    searches = searches.values()
    medians = {s.column: (s.found[0] + s.found[1]) / 2 for s in searches}
    return {c: medians.get(c) for c in columns}
