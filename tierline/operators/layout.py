"""Where the rows of a clustered table go, decided from counts taken before it is written.

A range exchange has to sample its input, which computes the input twice.  Here the cut points are
known beforehand: earlier writes observe them in passing.

1. The raw write observes quantiles of every dimension (``quantiles``); they cut each dimension into
   ``2 ** BITS`` buckets of about equal rows.
2. A row's buckets, interleaved bit by bit, are its cell on a space-filling curve (Z order): rows that are
   near in all dimensions are near on the curve.  The clean write observes quantiles of the cells.
3. The fact write deals the curve out to files, half by half, each file about the same number of rows.  A cell
   that fills several files (a hot date, code and origin) is spread over them by a hash of the row.

So every file holds a small range of every dimension, and a date, an airline list or an origin list each skip
most files by their statistics.  All expressions are native and compiled.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of every dimension on the curve; three dimensions make 4,096 cells.
BITS = 4
#: Quantiles of the cells: shares of rows are known to one part in so many.
CELL_QUANTILES = 512
#: Accuracy of the observed quantiles: their sketches stay below 100 KB a task.
ACCURACY = 2000
PREFIX = "layout:"
LOOKED_AT = 16


def number_of(value: Column, kind: str) -> Column:
    """A number that sorts like the value: days of a date, the first six bytes of a text; null stays null."""
    if kind == "date":
        return F.unix_date(value).cast("bigint")
    digits = F.rpad(F.substring(F.hex(F.encode(value, "UTF-8")), 1, 12), 12, "0")
    return F.conv(digits, 16, 10).cast("bigint")


def looked_at(spread: Sequence[str]) -> Column:
    """True for one in ``LOOKED_AT`` rows, by a hash: quantiles need no more, and the others cost next to nothing.

    Only the places of file boundaries depend on it.
    """
    return F.pmod(F.xxhash64(*spread), F.lit(LOOKED_AT)) == 0


def quantiles(columns: Mapping[str, tuple[Column, str]], spread: Sequence[str], buckets: int = 1 << BITS) -> list[Column]:
    """Aggregates that cut every named dimension into buckets of about equal rows."""
    at, some = [i / buckets for i in range(1, buckets)], looked_at(spread)
    return [
        F.percentile_approx(F.when(some, number_of(c, kind)), at, ACCURACY).alias(f"{PREFIX}{name}") for name, (c, kind) in columns.items()
    ]


def _literals(values: Iterable[int], kind: str = "") -> str:
    """An array literal: one text that Spark folds, where as many Column objects would take seconds."""
    return f"array({', '.join(f'{v}{kind}' for v in values)})"


def _bucket(number: str, cuts: Sequence[int]) -> Column:
    """How many cuts a column's number has reached; a null is in the first bucket.

    A filter over a literal keeps the compiled code of a row small; fifteen comparisons a dimension do not.
    The number is bound first, or the optimizer would move its expression into the filter, once for every cut.
    """
    return F.expr(f"transform(array(`{number}`), n -> size(filter({_literals(cuts, 'L')}, c -> c <= n)))[0]") if cuts else F.lit(0)


def _spread_bits(step: int, shift: int) -> list[int]:
    """Every bucket with its bits ``step`` apart, from bit ``shift``."""
    return [sum(((bucket >> bit) & 1) << (bit * step + shift) for bit in range(BITS)) for bucket in range(1 << BITS)]


@dataclass(frozen=True)
class Curve:
    """Cut points of the dimensions, in the order their bits are interleaved: ``(name, kind, cuts)``."""

    dimensions: tuple[tuple[str, str, tuple[int, ...]], ...]

    @classmethod
    def of(cls, metrics: Mapping, kinds: Mapping[str, str]) -> Curve | None:
        """The curve from observed ``quantiles``; ``None`` when a dimension was not observed."""
        if any(f"{PREFIX}{name}" not in metrics for name in kinds):
            return None
        return cls(tuple((n, k, tuple(sorted(set(metrics[f"{PREFIX}{n}"] or ())))) for n, k in kinds.items()))

    def with_cell(self, df: DataFrame, columns: Mapping[str, Column], name: str, of: Column | None = None) -> DataFrame:
        """Adds every row's cell (of rows where ``of`` holds; else null), step by step, so that nothing is computed twice."""
        number = lambda d, kind: number_of(columns[d], kind) if of is None else F.when(of, number_of(columns[d], kind))
        numbers = {f"_number_{d}": number(d, kind) for d, kind, _ in self.dimensions}
        buckets = {f"_bucket_{d}": _bucket(f"_number_{d}", cuts) for d, _, cuts in self.dimensions}
        last = len(self.dimensions) - 1
        parts = [f"element_at({_literals(_spread_bits(last + 1, last - i))}, `{b}` + 1)" for i, b in enumerate(buckets)]
        cell = F.expr(" + ".join(parts))
        if of is not None:
            cell = F.when(of, cell)
        return df.withColumns(numbers).withColumns(buckets).withColumn(name, cell).drop(*numbers, *buckets)

    def observed_cells(self, df: DataFrame, columns: Mapping[str, Column], spread: Sequence[str], name: str) -> tuple[DataFrame, Column]:
        """``df`` with a helper column, and the aggregate of it that tells how rows lie on the curve."""
        at = ", ".join(f"{i / CELL_QUANTILES}D" for i in range(1, CELL_QUANTILES))
        celled = self.with_cell(df, columns, name, looked_at(spread))
        return celled, F.expr(f"percentile_approx(`{name}`, array({at}), {ACCURACY})").alias(f"{PREFIX}cells")

    @property
    def cells(self) -> int:
        return 1 << (BITS * len(self.dimensions))


@dataclass(frozen=True)
class Layout:
    """A curve with the observed quantiles of its cells."""

    curve: Curve
    cell_quantiles: tuple[int, ...]

    def spans(self, files: int) -> list[tuple[int, int]]:
        """First and last file of every cell.

        The curve is halved again and again, and every half gets files by its share of the rows, so a file is
        a box of the dimensions and not a stretch of the curve that runs through several.  A half
        with less than half a file joins its neighbour; a single cell with several files is spread over them.
        """
        q, out = self.cell_quantiles, [(0, 0)] * self.curve.cells

        def deal(lo: int, hi: int, first: int, n: int) -> None:
            if n == 1 or hi - lo == 1:
                out[lo:hi] = [(first, first + n - 1)] * (hi - lo)
                return
            mid = (lo + hi) // 2
            low, all_rows = bisect_left(q, mid) - bisect_left(q, lo), bisect_left(q, hi) - bisect_left(q, lo)
            left = round(n * low / all_rows) if all_rows else n // 2
            if left:
                deal(lo, mid, first, left)
            else:
                out[lo:mid] = [(first, first)] * (mid - lo)
            if left < n:
                deal(mid, hi, first + left, n - left)
            else:
                out[mid:hi] = [(first + n - 1, first + n - 1)] * (hi - mid)

        deal(0, self.curve.cells, 0, files)
        return out

    def file_of(self, cell: Column, files: int, spread: Sequence[str]) -> Column:
        """The file a row of a cell goes to, from 0; rows of a cell with several files are spread by a hash."""
        spans = self.spans(files)
        # Thousands of literals, folded from one text: as separate expressions they take the analyzer seconds.
        table = lambda values: F.from_json(F.lit(str(list(values))), "array<int>")
        first, wide = F.element_at(table(a for a, _ in spans), cell + 1), F.element_at(table(b - a + 1 for a, b in spans), cell + 1)
        return (first + F.pmod(F.xxhash64(*spread), wide.cast("bigint"))).cast("int")


def deal(df: DataFrame, layout: Layout, columns: Mapping[str, Column], files: int, spread: Sequence[str]) -> DataFrame:
    """Rows dealt out to ``files`` tasks along the curve: one exchange, no sampling pass."""
    names = df.columns
    celled = layout.curve.with_cell(df, columns, "_cell")
    return celled.withColumn("_file", layout.file_of(F.col("_cell"), files, spread)).repartitionById(files, F.col("_file")).select(*names)
