"""Table profiles, and the numbers behind a grid of pair plots."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def known(name: str) -> Column:
    """A column as double, NaN as NULL: it is no place on an axis."""
    return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))


def _ordered(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _ordered(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_ordered(field.dataType) for field in kind)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _named(name: str, measures: dict[str, Column]) -> Column:
    return F.struct(F.lit(name).alias("column"), *[m.alias(label) for label, m in measures.items()])


def exact_profile(rows: DataFrame) -> DataFrame:
    """Per column: rows, nulls, mean, deviation, minimum and maximum.

    Minimum and maximum are text; mean and deviation are NULL for columns that are
    not numbers, extremes NULL for maps and what holds them. The extremes of text keep an aggregate from being compiled, so such
    columns have one of their own; each column is still read once.
    """
    sized = [f for f in rows.schema if not isinstance(f.dataType, (T.StringType, T.BinaryType))]
    text = [f for f in rows.schema if f not in sized]
    parts = [_exact(rows, fields) for fields in (sized, text) if fields]
    return reduce(DataFrame.unionByName, parts)


def _exact(rows: DataFrame, fields: list[T.StructField]) -> DataFrame:
    nothing = F.lit(None).cast("double")
    measures: list[Column] = [F.count(F.lit(1)).alias("rows")]
    entries = []
    for i, field in enumerate(fields):
        column = F.col(f"`{field.name}`")
        numeric = isinstance(field.dataType, T.NumericType)
        extreme = column if _ordered(field.dataType) else F.lit(None).cast("string")
        measures += [
            F.count(column).alias(f"filled_{i}"),
            F.min(extreme).alias(f"low_{i}"),
            F.max(extreme).alias(f"high_{i}"),
        ]
        if numeric:
            measures += [F.avg(column).alias(f"mean_{i}"), F.stddev(column).alias(f"deviation_{i}")]
        found = {
            "rows": F.col("rows"),
            "nulls": F.col("rows") - F.col(f"filled_{i}"),
            "mean": F.col(f"mean_{i}").cast("double") if numeric else nothing,
            "stddev": F.col(f"deviation_{i}").cast("double") if numeric else nothing,
            "min": F.col(f"low_{i}").cast("string"),
            "max": F.col(f"high_{i}").cast("string"),
        }
        entries.append(_named(field.name, found))
    return rows.agg(*measures).select(F.inline(F.array(*entries)))


def sketch_profile(rows: DataFrame, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Per column: approximate quantiles (NULL unless a number) and distinct count."""
    ranks = F.array(*[F.lit(q) for q in quantiles])
    measures, entries = [], []
    for i, field in enumerate(rows.schema):
        column = F.col(f"`{field.name}`")
        counted = column if _ordered(field.dataType) else F.to_json(F.struct(column))
        counted = F.when(column.isNotNull(), counted)
        measures.append(F.approx_count_distinct(counted).alias(f"distinct_{i}"))
        cuts = F.lit(None).cast("array<double>")
        if isinstance(field.dataType, T.NumericType):
            measures.append(F.kll_sketch_agg_double(column.cast("double")).alias(f"sketch_{i}"))
            cuts = F.kll_sketch_get_quantile_double(f"sketch_{i}", ranks)
            cuts = F.when(F.kll_sketch_get_n_double(f"sketch_{i}") > 0, cuts)
        found = {"quantiles": cuts, "approx_distinct": F.col(f"distinct_{i}")}
        entries.append(_named(field.name, found))
    return rows.agg(*measures).select(F.inline(F.array(*entries)))


def table_profile(rows: DataFrame, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One row per column of ``rows``, exact measures and sketches.

    Exact measures are compiled as long as no sketch shares their aggregate, so the
    two are taken in a scan each and joined by column name.
    """
    return exact_profile(rows).join(sketch_profile(rows, quantiles), "column")


def frequent_values(rows: DataFrame, columns: list[str], k: int = 5) -> DataFrame:
    """The ``k`` most frequent values of each column, exactly.

    Values are counted per task before the shuffle, and the rank filter keeps ``k``
    rows per task before the last one, so no task sees all values of a column.
    """
    cells = [
        F.struct(F.lit(name).alias("column"), F.col(f"`{name}`").cast("string").alias("value"))
        for name in columns
    ]
    long = rows.select(F.inline(F.array(*cells))).where("value IS NOT NULL")
    counts = long.groupBy("column", "value").agg(F.count("*").alias("c"))
    order = Window.partitionBy("column").orderBy(F.desc("c"), "value")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def pair_regression(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Regression line and correlation of every column pair (y over x), in one aggregate.

    Pairs are rows, not columns, of that aggregate: its code stays short enough to be
    compiled, and every task sends one row per pair to the shuffle.
    """
    points = [
        F.struct(
            F.lit(x).alias("x"),
            F.lit(y).alias("y"),
            F.col(x).cast("double").alias("x_value"),
            F.col(y).cast("double").alias("y_value"),
        )
        for x, y in combinations(columns, 2)
    ]
    long = rows.select(F.inline(F.array(*points)))
    return long.groupBy("x", "y").agg(
        F.regr_slope("y_value", "x_value").alias("slope"),
        F.regr_intercept("y_value", "x_value").alias("intercept"),
        F.corr("x_value", "y_value").alias("corr"),
    )


class Grid:
    """Equal-width bins over the range of each column; one small aggregate finds the ranges."""

    def __init__(self, rows: DataFrame, columns: list[str], bins: int):
        measures = []
        for name in columns:
            measures += [f(known(name)) for f in (F.min, F.max, F.stddev, F.count)]
        found = rows.agg(*measures).first()
        self.bins = bins
        self.columns, self.low, self.width, self.bandwidth = [], {}, {}, {}
        for i, name in enumerate(columns):
            low, high, deviation, count = found[4 * i : 4 * i + 4]
            if low is None:
                continue
            self.columns.append(name)
            self.low[name] = float(low)
            self.width[name] = (float(high) - float(low)) / bins or 1.0
            # Scott's rule: n^(-1/5) for a curve, n^(-1/6) for a surface.
            sigma = deviation or self.width[name]
            self.bandwidth[name] = (sigma * count ** (-1 / 5), sigma * count ** (-1 / 6))

    def bin_of(self, name: str) -> Column:
        """0-based bin, NULL for NULL and NaN; the highest value belongs to the last one."""
        offset = F.floor((known(name) - self.low[name]) / self.width[name])
        last = F.lit(self.bins - 1)
        return F.when(offset.isNotNull(), F.least(offset, last)).cast("int")

    def centre(self, name: str, bin_column: Column) -> Column:
        return F.lit(self.low[name]) + (bin_column + 0.5) * self.width[name]


def histograms(rows: DataFrame, columns: list[str], bins: int = 20, grid: Grid | None = None) -> DataFrame:
    """Rows per bin of each column, NULLs left out: (column, bin, c)."""
    grid = grid or Grid(rows, columns, bins)
    cells = [
        F.struct(F.lit(name).alias("column"), grid.bin_of(name).alias("bin")) for name in grid.columns
    ]
    long = rows.select(F.inline(F.array(*cells))).where("bin IS NOT NULL")
    return long.groupBy("column", "bin").agg(F.count("*").alias("c"))


def pair_histograms(
    rows: DataFrame, columns: list[str], bins: int = 20, grid: Grid | None = None
) -> DataFrame:
    """Rows per cell of each column pair: (x, y, x_bin, y_bin, c)."""
    grid = grid or Grid(rows, columns, bins)
    cells = [
        F.struct(
            F.lit(x).alias("x"),
            F.lit(y).alias("y"),
            grid.bin_of(x).alias("x_bin"),
            grid.bin_of(y).alias("y_bin"),
        )
        for x, y in combinations(grid.columns, 2)
    ]
    long = rows.select(F.inline(F.array(*cells)))
    long = long.where("x_bin IS NOT NULL AND y_bin IS NOT NULL")
    return long.groupBy("x", "y", "x_bin", "y_bin").agg(F.count("*").alias("c"))


def _by_column(key: str, values: dict[str, float]) -> Column:
    pairs = [F.lit(part) for pair in values.items() for part in pair]
    return F.create_map(*pairs)[F.col(key)]


def _kernel(at: Column, centre: Column, bandwidth: Column) -> Column:
    z = (at - centre) / bandwidth
    return F.exp(-z * z / 2) / (bandwidth * F.sqrt(F.lit(2.0) * F.pi()))


def density(rows: DataFrame, columns: list[str], bins: int = 100, points: int = 50) -> DataFrame:
    """Gaussian density curve of each column at ``points`` places: (column, point, at, density).

    The data is read to fill the bins; the curve is summed over at most ``bins``
    counts per column, so its cost does not grow with the rows.
    """
    grid = Grid(rows, columns, bins)
    low, width = _by_column("column", grid.low), _by_column("column", grid.width)
    spread = _by_column("column", {name: pair[0] for name, pair in grid.bandwidth.items()})
    counts = histograms(rows, columns, bins, grid)
    curve = counts.withColumn("share", F.col("c") / F.sum("c").over(Window.partitionBy("column")))
    curve = curve.withColumn(
        "point", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    )
    step = width * bins / (points - 1)
    curve = curve.withColumns({"at": low + F.col("point") * step, "mid": low + (F.col("bin") + 0.5) * width})
    weight = F.col("share") * _kernel(F.col("at"), F.col("mid"), spread)
    return curve.groupBy("column", "point", "at").agg(F.sum(weight).alias("density"))


def pair_density(rows: DataFrame, columns: list[str], bins: int = 30, points: int = 20) -> DataFrame:
    """Gaussian density surface of each column pair, smoothed along x and then along y."""
    grid = Grid(rows, columns, bins)
    spread = {name: pair[1] for name, pair in grid.bandwidth.items()}
    share = F.col("c") / F.sum("c").over(Window.partitionBy("x", "y"))
    surface = pair_histograms(rows, columns, bins, grid).withColumn("weight", share)
    left = ["y", "y_bin"]
    for axis in ("x", "y"):
        low, width = _by_column(axis, grid.low), _by_column(axis, grid.width)
        place = low + F.col(f"{axis}_point") * width * bins / (points - 1)
        mid = low + (F.col(f"{axis}_bin") + 0.5) * width
        spots = surface.withColumn(
            f"{axis}_point", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
        )
        kernel = _kernel(place, mid, _by_column(axis, spread))
        spots = spots.withColumn("weight", F.col("weight") * kernel)
        keys = ["x", "x_point", *left]
        surface = spots.groupBy(*keys).agg(F.sum("weight").alias("weight"))
        left = ["y", "y_point"]
    return surface.select("x", "y", "x_point", "y_point", F.col("weight").alias("density"))
