"""Exact order statistics by radix selection, without sorting anything.

Every value has an order-preserving 64-bit image: whole numbers are their own, a floating-point number has its sign,
exponent and fraction as one whole number. One aggregation finds the extent of the images of each group. Then, in rounds, the
interval that holds a rank is cut into at most ``2 ** DIGIT_BITS`` parts by the leading bits of the image; one counter
for each part, combined on the map side, tells which part holds the rank, and the extent of that part's own images is the next
interval. A part with one distinct value is the answer.

The work does not depend on how values are distributed: a value that holds a third of all rows is one counter, a heavy tail
is cut by its exponents. No task ever sees more than the counters of one interval. At most four rounds settle any rank, and as
every round drops empty bits, two or three are usual; the way is the same for one row and for all sizes above.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, StructField, StructType

from ..functions.numeric import amount, units

#: Bits of the image that one round settles.
DIGIT_BITS = 16

# Rank name -> SQL expression over the group's row count ``n`` and the group columns.
Ranks = dict[str, str]


def _double_image(x: str) -> str:
    """SQL: a whole number in the order of DOUBLE values. Powers of two are exact, so no step here rounds."""
    guess = f"floor(log2(abs({x})))"
    power = f"(CASE WHEN pow(2D, {guess}) > abs({x}) THEN {guess} - 1 WHEN pow(2D, {guess} + 1) <= abs({x}) THEN {guess} + 1 ELSE {guess} END)"
    fraction = f"CAST(abs({x}) / pow(2D, {power}) * {2.0 ** 52!r}D AS BIGINT)"
    size = (f"CASE WHEN isnan({x}) THEN {(2047 << 52) + 1}L WHEN abs({x}) = double('inf') THEN {2047 << 52}L WHEN {x} = 0 THEN 0L "
            f"WHEN abs({x}) < {2.0 ** -1022!r}D THEN CAST(abs({x}) * {2.0 ** 1000!r}D * {2.0 ** 74!r}D AS BIGINT) "
            f"ELSE CAST({power} + 1022 AS BIGINT) * {1 << 52}L + {fraction} END")
    return f"(CASE WHEN {x} < 0 THEN -1L ELSE 1L END * ({size}))"


def image(column: str, kind: DataType) -> str:
    """SQL: the order-preserving BIGINT image of a column of numbers or dates."""
    if isinstance(kind, (ByteType, ShortType, IntegerType, LongType)):
        return f"CAST({column} AS BIGINT)"
    if isinstance(kind, (FloatType, DoubleType)):
        return _double_image(f"CAST({column} AS DOUBLE)")
    if isinstance(kind, DecimalType) and kind.precision <= 18:
        return f"CAST({column} * {10 ** kind.scale} AS BIGINT)"
    if isinstance(kind, DateType):
        return f"CAST(unix_date({column}) AS BIGINT)"
    raise TypeError(f"no order-preserving image of {kind.simpleString()}")


def _cut(low: int, high: int) -> int:
    """How many low bits a round leaves out, so that an interval has at most 2 ** DIGIT_BITS parts."""
    return next(s for s in range(64) if (high >> s) - (low >> s) < 1 << DIGIT_BITS)


def order_statistics(df: DataFrame, value: Column | str, ranks: Ranks, by: Sequence[str] = ()) -> DataFrame:
    """Values at 1-based ascending ranks: one row per group and rank name.

    Ranks outside 1..n give no row. ``below`` counts the rows with a strictly smaller value. NULL values are ignored, and so
    are rows of a NULL group. The groups must be few (segments, metrics, flags): one row for each rank of each reaches the
    driver, and the intervals of a round are broadcast.
    """
    keys, spark = list(by), df.sparkSession
    value = F.col(value) if isinstance(value, str) else value
    rows = df.select(*keys, value.alias("_v")).where("_v IS NOT NULL")
    schema = rows.schema
    rows = rows.selectExpr("*", f"{image('_v', schema['_v'].dataType)} AS _i")
    named = ", ".join(f"named_struct('stat', '{name}', 'rank', CAST({rank} AS BIGINT))" for name, rank in ranks.items())
    extent = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("_i").alias("_low"), F.max("_i").alias("_high"))
    found = extent.selectExpr(*keys, "n", "_low", "_high", f"filter(array({named}), t -> t.rank BETWEEN 1 AND n) AS _ranks").collect()

    open_ = [{"group": i, "stat": t["stat"], "rank": t["rank"], "below": 0, "low": g["_low"], "high": g["_high"]}
             for i, g in enumerate(found) if all(g[k] is not None for k in keys) for t in g["_ranks"]]
    done: list[dict] = []
    while open_:
        intervals = sorted({(t["group"], t["low"], t["high"]) for t in open_})
        number = {x: i for i, x in enumerate(intervals)}
        part = _parts(rows, keys, schema, found, intervals)
        so_far = F.sum("c").over(Window.partitionBy("_x").orderBy("_digit").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        wanted = sorted({(number[t["group"], t["low"], t["high"]], t["rank"] - t["below"]) for t in open_})
        targets = spark.createDataFrame(pa.table({"_x": pa.array([x for x, _ in wanted], pa.int32()), "_nth": pa.array([r for _, r in wanted], pa.int64())}))
        hit = part.withColumn("cum", so_far).join(F.broadcast(targets), "_x").where("cum >= _nth AND cum - c < _nth")
        hits = {(r["_x"], r["_nth"]): r for r in hit.selectExpr("_x", "_nth", "cum - c AS before", "low", "high", "value").collect()}
        for t in open_:
            r = hits[number[t["group"], t["low"], t["high"]], t["rank"] - t["below"]]
            t |= {"below": t["below"] + r["before"], "low": r["low"], "high": r["high"], "value": r["value"]}
        done += [t for t in open_ if t["low"] == t["high"]]
        open_ = [t for t in open_ if t["low"] < t["high"]]

    done.sort(key=lambda t: (t["group"], t["rank"], t["stat"]))
    out = StructType([*[schema[k] for k in keys], StructField("stat", StringType()), StructField("rank", LongType()), StructField("n", LongType()),
                      StructField("below", LongType()), StructField("value", schema["_v"].dataType)])
    columns = [[found[t["group"]][k] for t in done] for k in keys] + [
        [t["stat"] for t in done], [t["rank"] for t in done], [found[t["group"]]["n"] for t in done], [t["below"] for t in done], [t["value"] for t in done]]
    return spark.createDataFrame(pa.table([pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, out)], names=out.names), out)


def _parts(rows: DataFrame, keys: list[str], schema: StructType, found: list, intervals: list[tuple[int, int, int]]) -> DataFrame:
    """Counters of one round: interval, digit, rows, extent of their images and their smallest value."""
    literal = lambda i, low, high: f"named_struct('_x', {i}, '_from', {_long(low)}, '_to', {_long(high)}, '_s', {_cut(low, high)})"
    if keys:
        own: dict[int, list[tuple[int, int, int, int]]] = {}
        for i, (g, low, high) in enumerate(intervals):
            own.setdefault(g, []).append((i, low, high, _cut(low, high)))
        kind = pa.list_(pa.struct([("_x", pa.int32()), ("_from", pa.int64()), ("_to", pa.int64()), ("_s", pa.int32())]))
        table = pa.table([pa.array([found[g][k] for g in own], to_arrow_type(schema[k].dataType)) for k in keys]
                         + [pa.array([[dict(zip(("_x", "_from", "_to", "_s"), x)) for x in own[g]] for g in own], kind)], names=[*keys, "_all"])
        rows = rows.join(F.broadcast(rows.sparkSession.createDataFrame(table)), keys)
        candidates = "_all"
    else:
        candidates = f"array({', '.join(literal(i, low, high) for i, (_, low, high) in enumerate(intervals))})"
    met = rows.selectExpr("_v", "_i", f"inline(filter({candidates}, t -> _i BETWEEN t._from AND t._to))")
    digit = "CAST(shiftright(_i, _s) - shiftright(_from, _s) AS INT)"
    return met.groupBy("_x", F.expr(digit).alias("_digit")).agg(
        F.count(F.lit(1)).alias("c"), F.min("_i").alias("low"), F.max("_i").alias("high"), F.min("_v").alias("value"))


def _long(number: int) -> str:
    return f"{number}L" if number > -(1 << 63) else f"(-{(1 << 63) - 1}L - 1L)"


def group_quantiles(df: DataFrame, value: Column | str, probs: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Linearly interpolated quantiles, wide: one row per group, one column per name, plus ``n``."""
    ranks: Ranks = {}
    for name, p in probs.items():
        ranks[f"{name}|lo"] = f"floor((n - 1) * {float(p)!r}D) + 1"
        ranks[f"{name}|hi"] = f"ceil((n - 1) * {float(p)!r}D) + 1"
    found = order_statistics(df, value, ranks, by)

    def interpolated(name: str, p: float) -> Column:
        lo, hi = (f"max(IF(stat = '{name}|{end}', value, NULL))" for end in ("lo", "hi"))
        place = f"(max(n) - 1) * {float(p)!r}D"
        return F.expr(f"{lo} + ({hi} - {lo}) * ({place} - floor({place}))").alias(name)

    return found.groupBy(*by).agg(F.max("n").alias("n"), *[interpolated(name, p) for name, p in probs.items()])


def quantiles(df: DataFrame, value: Column | str, probs: dict[str, float]) -> dict[str, float]:
    """Linearly interpolated quantiles of one column as plain numbers (one row reaches the driver)."""
    row = group_quantiles(df, value, probs).first()
    return {name: None if row is None else row[name] for name in probs}


def top_sums(df: DataFrame, value: str, sizes: Ranks) -> DataFrame:
    """Sum of the k largest values for every named k, with the overall sum and count.

    The k-th largest value decides: everything above it counts in full, and equal values fill what is left of k, so
    no row order is needed among ties. The few deciding values become literals of one aggregation.
    """
    edges = order_statistics(df, value, {name: f"n - ({k}) + 1" for name, k in sizes.items()}).collect()
    held = F.col(value)
    sums = [F.sum(units(held)).alias("_all")]
    named = []
    for i, edge in enumerate(edges):
        limit = F.lit(edge["value"])
        sums += [F.coalesce(F.sum(F.when(held > limit, units(held))), F.lit(0)).alias(f"_over{i}"),
                 F.count_if(held > limit).alias(f"_count{i}")]
        k = edge["n"] - edge["rank"] + 1
        named.append(F.struct(
            F.lit(edge["stat"]).alias("stat"), F.lit(k).cast("bigint").alias("k"), F.lit(edge["n"]).cast("bigint").alias("n"),
            amount(F.col(f"_over{i}") + (F.lit(k) - F.col(f"_count{i}")) * units(limit)).alias("top_sum"),
            amount(F.col("_all")).alias("total_sum")))
    if not named:
        return df.sparkSession.createDataFrame([], "stat string, k bigint, n bigint, top_sum double, total_sum double")
    return df.agg(*sums).select(F.inline(F.array(*named)))


def key_cuts(df: DataFrame, metrics: dict[str, str], key: str, ranks: Ranks) -> list:
    """The (value, key) pair standing at each rank when rows are ordered by (value, key), for several metrics.

    ``metrics`` maps a name to a SQL expression. The value comes first; ties on it are then resolved by the same
    selection over the keys that share it. A handful of rows reaches the driver, and every row's bucket is afterwards a
    comparison with literals.
    """
    structs = ", ".join(f"named_struct('metric', '{m}', 'x', CAST({sql} AS DOUBLE))" for m, sql in metrics.items())
    long = df.selectExpr(f"{key} AS _key", f"inline(array({structs}))")
    first = order_statistics(long, "x", ranks, ["metric"]).collect()
    if not first:
        return []
    wanted = ", ".join(
        f"named_struct('m', '{r['metric']}', 'cut', '{r['stat']}', 'edge', {r['value']!r}D, "
        f"'nth', {r['rank'] - r['below']}L)" for r in first)
    ties = long.selectExpr("_key", f"inline(filter(array({wanted}), t -> t.m = metric AND t.edge = x))")
    return order_statistics(ties, "_key", {"key": "nth"}, ["m", "cut", "edge", "nth"]).selectExpr(
        "m AS metric", "cut", "edge AS value", "value AS key").collect()


def bucket_by_cuts(value: str, key: str, cuts: list) -> Column:
    """1-based bucket of a row: one more than the number of cut points that lie strictly before it."""
    value = f"CAST({value} AS DOUBLE)"
    after = [
        f"IF({value} > {c['value']!r}D OR ({value} = {c['value']!r}D AND {key} > {c['key']}L), 1, 0)" for c in cuts
    ]
    return F.expr(" + ".join(["1", *after]))


def ntile_ranks(buckets: int) -> Ranks:
    """Last row of every bucket but the final one under NTILE: larger buckets come first."""
    return {f"cut{k:02d}": f"{k} * (n div {buckets}) + least({k}, n % {buckets})" for k in range(1, buckets)}


def quantile_cut_ranks(buckets: int) -> Ranks:
    """Last row of every bucket when row numbers are cut at evenly spaced interpolated quantiles."""
    return {f"cut{k:02d}": f"({k} * (n - 1)) div {buckets} + 1" for k in range(1, buckets)}
