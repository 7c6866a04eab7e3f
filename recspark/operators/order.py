"""Exact positions in a global order without sorting everything in one task.

A few positions (split cuts, quantiles) are found by selection: rounds of sketched edges
and exact counts between them, hash aggregates only. Where every key needs its rank,
distinct keys and their multiplicities are range-partitioned (Spark's sampled bounds)
and checkpointed; sums per range give each range its offset, a running sum inside a
range gives each key the number of rows before it. Nothing but the rows at the wanted
positions reaches the driver, at every size and for any number of columns at once.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recspark.functions.scalar import wall_clock_micros
from recspark.session import cut_lineage

#: Cells of the sketched quantile grid and the sketch's accuracy (an error of rows / ACCURACY).
CELLS, ACCURACY = 1000, 10_000
#: Up to this many rows a group's stretches around wanted positions (some 3 / CELLS of it) are listed value by value.
LISTED = 1 << 24
#: Rows that agree with a wanted key so far and are ranked directly; groups whose edges are broadcast.
FEW, BROADCAST_GROUPS = 4096, 10_000


def _lit(value, dtype) -> Column:
    if value is None:
        return F.lit(None).cast(dtype)
    if isinstance(value, (_dt.datetime, _dt.date)):
        return F.lit(value.isoformat()).cast(dtype)
    return F.lit(value).cast(dtype)


def order_key(cols) -> Column:
    """A struct that compares like the columns in ascending order, nulls last."""
    return F.struct(*[x for c in cols for x in (F.col(c).isNull().alias(f"{c}_null"), F.col(c).alias(c))])


def key_literal(df: DataFrame, cols, row) -> Column:
    """The ``order_key`` of one row of values."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    return F.struct(*[x for i, c in enumerate(cols) for x in (F.lit(row[i] is None).alias(f"{c}_null"), _lit(row[i], fields[c]).alias(c))])


def running_counts(df: DataFrame, groups, cols) -> DataFrame:
    """One row per group and distinct key: ``groups, cols, n, before, total``.

    n is the key's multiplicity, before the number of the group's rows with a smaller key
    (nulls last), total the group's rows.
    """
    groups, cols = list(groups), list(cols)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(c).asc_nulls_last() for c in [*groups, *cols]]
    keys = df.groupBy(*groups, *cols).agg(F.count(F.lit(1)).alias("n"))
    keys = cut_lineage(keys.repartitionByRange(parts, *order).withColumn("_pid", F.spark_partition_id()))
    sums = keys.groupBy("_pid", *groups).agg(F.sum("n").alias("_n"))
    whole = Window.partitionBy(*groups)
    ahead = whole.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_pid", *groups, F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_off"), F.sum("_n").over(whole).alias("total"))
    inside = Window.partitionBy("_pid", *groups).orderBy(*[F.col(c).asc_nulls_last() for c in cols]).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_off") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    return keys.join(sums, ["_pid", *groups]).select(*groups, *cols, "n", before.alias("before"), "total")


def select_ranks(rows: DataFrame, groups, value: str, positions) -> DataFrame:
    """``groups, pos, value, before, n, total``: the value at each wanted 0-based position of its group.

    Values are numbers or times without nulls and NaN; rows of a null group give nothing.
    before counts the group's smaller values, n its equal ones. ``positions`` is an array
    column over ``total`` or a table (groups, ``_at`` array); a few per group.

    A round sketches each group's quantiles, takes the two grid values that should enclose
    each position as edges and counts exactly what lies between edges, in hash aggregates
    alone. The sketch only steers: a position that still lies in a stretch too long to be
    listed value by value goes to the next round with that stretch as its group, so a
    round leaves at most about 3 / CELLS of the rows and nothing is ever sorted as a whole.
    """
    g = list(groups)
    zone = f"_zone{len(g)}"
    grid = F.percentile_approx(value, [i / CELLS for i in range(CELLS + 1)], ACCURACY)
    sketch = rows.groupBy(*g).agg(F.count(value).alias("total"), grid.alias("_grid"))
    sketch = sketch.withColumn("_at", positions) if isinstance(positions, Column) else sketch.join(positions, g)

    def span(p):
        cell = F.floor(p * F.lit(float(CELLS)) / F.col("total")).cast("int")
        low, high = F.greatest(cell, F.lit(1)), F.least(cell + 3, F.lit(CELLS + 1))
        return F.struct(F.element_at("_grid", low).alias("lo"), F.element_at("_grid", high).alias("hi"))

    guide = sketch.select(*g, "total", "_at", F.transform("_at", span).alias("_spans"))
    ends = F.concat(F.transform("_spans", lambda s: s["lo"]), F.transform("_spans", lambda s: s["hi"]))
    guide = guide.withColumn("_edges", F.array_sort(F.array_distinct(ends)))
    # is the stretch below an edge listed value by value?
    short = lambda e: (F.col("total") <= LISTED) & F.exists("_spans", lambda s: (s["lo"] < e) & (e <= s["hi"]))
    guide = cut_lineage(guide.withColumn("_open", F.transform("_edges", short)))
    size, most = guide.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("_edges")), F.lit(0))).first()
    small = size <= BROADCAST_GROUPS
    x = F.col(value)
    # stretch i ends at edge i: 2i, or 2i + 1 where values are listed; all values of a stretch are, or just its edge
    place = F.lit(2 * most)
    for i in reversed(range(most)):
        shown = (x == F.col(f"_e{i}")) | F.col(f"_o{i}")
        place = F.when(x <= F.col(f"_e{i}"), F.lit(2 * i) + shown.cast("int")).otherwise(place)
    edges = [c for i in range(most) for c in (F.get("_edges", F.lit(i)).alias(f"_e{i}"), F.get("_open", F.lit(i)).alias(f"_o{i}"))]
    flat = guide.select(*g, *edges)
    near = rows.join(F.broadcast(flat) if small else flat, g).select(*g, x, place.alias(zone))
    listed = F.when(F.col(zone) % 2 == 1, x).alias(value)
    parts = near.select(*g, zone, listed).groupBy(*g, zone, value).agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy(*g).orderBy(zone, x.asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    spots = guide.select(*g, "total", F.explode("_at").alias("pos"))
    hits = parts.join(spots, g).where((F.col("before") <= F.col("pos")) & (F.col("pos") < F.col("before") + F.col("n")))
    hits = cut_lineage(hits.select(*g, "pos", value, "before", "n", "total", zone))
    found = hits.where(x.isNotNull()).drop(zone)
    still = hits.where(x.isNull()).select(*g, zone, "pos", F.col("before").alias("_before"), F.col("total").alias("_total"))
    if still.isEmpty():
        return found
    left = F.col("pos") - F.col("_before")
    wanted = still.groupBy(*g, zone).agg(F.collect_set(left).alias("_at"))
    stretch = near.join(F.broadcast(wanted.drop("_at")) if small else wanted.drop("_at"), [*g, zone])
    deeper = select_ranks(stretch, [*g, zone], value, wanted).withColumnRenamed("pos", "_pos").drop("total")
    deeper = deeper.join(still, [*g, zone]).where(F.col("_pos") == left)
    return found.unionByName(deeper.select(*g, "pos", value, (F.col("before") + F.col("_before")).alias("before"), "n", F.col("_total").alias("total")))


def _levels(c: str, dtype, facts):
    """Numbers that, compared one after the other, order the column ascending, nulls last.

    Each is exact as a double and never null; what a level leaves equal the next one decides.
    """
    x = F.col(c)
    if facts[f"{c}_nulls"]:
        yield x.isNull().cast("long")
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        raw = x.cast("binary")
        for at in range(0, facts[f"{c}_high"] or 0, 6):
            six = F.rpad(F.hex(F.substring(raw, at + 1, 6)), 12, "0")
            yield F.coalesce(F.conv(six, 16, 10).cast("long"), F.lit(0))
        yield F.coalesce(F.octet_length(x).cast("long"), F.lit(0))
    elif isinstance(dtype, (T.FloatType, T.DoubleType)):
        yield F.coalesce(F.isnan(x).cast("long"), F.lit(0))
        yield F.coalesce(F.nanvl(x.cast("double"), F.lit(0.0)), F.lit(0.0))
    elif isinstance(dtype, T.DecimalType):
        yield F.coalesce(x.cast("double"), F.lit(0.0))
        # equal as doubles: whole part in two halves, then the digits behind the point
        whole = F.floor(x).cast("decimal(38,0)")
        for part in (F.floor(whole / F.lit(10**15)), whole % F.lit(10**15), (x - F.floor(x))):
            yield F.coalesce(part.cast("double"), F.lit(0.0))
    else:
        whole = F.coalesce(_whole(c, dtype), F.lit(0))
        if -(2**53) < (facts[f"{c}_low"] or 0) and (facts[f"{c}_high"] or 0) < 2**53:
            yield whole
        else:
            yield F.shiftright(whole, 32)
            yield whole.bitwiseAND(F.lit(2**32 - 1))


def _whole(c: str, dtype) -> Column:
    x = F.col(c)
    if isinstance(dtype, T.DateType):
        return F.unix_date(x).cast("long")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(x)
    return wall_clock_micros(x) if isinstance(dtype, T.TimestampNTZType) else x.cast("long")


def _facts(df: DataFrame, cols, types) -> dict:
    out = []
    for c in cols:
        out.append((F.count(F.lit(1)) - F.count(c)).alias(f"{c}_nulls"))
        if isinstance(types[c], (T.StringType, T.BinaryType)):
            out.append(F.max(F.octet_length(c)).alias(f"{c}_high"))
        elif not isinstance(types[c], (T.FloatType, T.DoubleType, T.DecimalType)):
            out += [F.min(_whole(c, types[c])).alias(f"{c}_low"), F.max(_whole(c, types[c])).alias(f"{c}_high")]
    return df.agg(F.count(F.lit(1)).alias("_rows"), *out).first().asDict()


def kth_keys(df: DataFrame, cols, positions_fn):
    """Keys at 0-based positions of the ascending order on ``cols``, nulls last.

    ``positions_fn(n)`` receives the row count and returns the wanted positions (a few).
    Returns (n, {position: key tuple}).

    One column after the other is decided by ``select_ranks`` among the rows that agree
    with a wanted key so far; once at most FEW rows agree they are ranked directly.
    """
    cols = list(cols)
    df = df.select(*cols)
    types = {f.name: f.dataType for f in df.schema.fields}
    facts = _facts(df, cols, types)
    n = facts["_rows"]
    wanted = sorted({p for p in positions_fn(n) if 0 <= p < n})
    if not wanted:
        return n, {}
    # per wanted position: what its key is known to satisfy, its place among such rows, their number
    known = {p: (F.lit(True), p, n) for p in wanted}
    levels = (x for c in cols for x in _levels(c, types[c], facts))
    while any(rows > FEW for _, _, rows in known.values()):
        x = next(levels, None)
        if x is None:
            break
        tag = F.lit(None).cast("int")
        for i, p in reversed(list(enumerate(wanted))):
            tag = F.when(known[p][0], F.lit(i)).otherwise(tag)
        # positions that agree so far share the first one's tag
        tags = {p: next(i for i, q in enumerate(wanted) if p - known[p][1] == q - known[q][1]) for p in wanted}
        spots = df.sparkSession.createDataFrame([(t, [known[p][1] for p in wanted if tags[p] == t]) for t in sorted(set(tags.values()))], "_tag int, _at array<bigint>")
        rows = df.select(tag.alias("_tag"), x.alias("_x")).where("_tag is not null")
        got = {(r["_tag"], r["pos"]): r for r in select_ranks(rows, ["_tag"], "_x", spots).collect()}
        for p in wanted:
            cond, place, _ = known[p]
            r = got[tags[p], place]
            known[p] = (cond & (x == F.lit(r["_x"])), place - r["before"], r["n"])
    out = {}
    few = [p for p in wanted if known[p][2] <= FEW]
    if few:
        marks = F.array_compact(F.array(*[F.when(known[p][0], F.lit(p).cast("long")) for p in few]))
        rows = df.select(*cols, F.explode(marks).alias("_pos"))
        ranked = Window.partitionBy("_pos").orderBy(*[F.col(c).asc_nulls_last() for c in cols])
        place = F.create_map(*[F.lit(v).cast("long") for p in few for v in (p, known[p][1])])
        rows = rows.withColumn("_rn", F.row_number().over(ranked) - 1).where(F.col("_rn") == place[F.col("_pos")])
        out = {r["_pos"]: tuple(r[c] for c in cols) for r in rows.collect()}
    for p in wanted:
        if p not in out:
            out[p] = tuple(df.where(known[p][0]).first())
    return n, out


def grouped_quantiles(long: DataFrame, group: str, value: str, probs) -> DataFrame:
    """``group, n, q0, q1, …``: exact linear-interpolated quantiles of all groups in one pass.

    Null and NaN values are left out; a null group or one without others gives no row.
    """
    rows = long.select(group, F.col(value).cast("double").alias("_x")).where("_x is not null and not isnan(_x)")
    place = [(F.col("total") - 1) * F.lit(float(q)) for q in probs]
    spots = F.array_distinct(F.array(*[f(p).cast("long") for p in place for f in (F.floor, F.ceil)]))
    found = select_ranks(rows.where(F.col(group).isNotNull()), [group], "_x", spots)
    out = []
    for j, pos in enumerate(place):
        at = lambda p: F.max(F.when(F.col("pos") == p, F.col("_x")))
        out += [at(F.floor(pos)).alias(f"lo{j}"), at(F.ceil(pos)).alias(f"hi{j}"), F.max(pos - F.floor(pos)).alias(f"f{j}")]
    agg = found.groupBy(group).agg(F.max("total").alias("n"), *out)
    return agg.select(group, "n", *[(F.col(f"lo{j}") + (F.col(f"hi{j}") - F.col(f"lo{j}")) * F.col(f"f{j}")).alias(f"q{j}") for j in range(len(probs))])


def unpivoted(df: DataFrame, cols, name: str = "column", value: str = "value") -> DataFrame:
    """(column name, value as double) rows of several numeric columns."""
    pairs = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value)) for c in cols])
    return df.select(F.explode(pairs).alias("_p")).select("_p.*")


def exact_quantiles(df: DataFrame, col: str, probs) -> tuple[int, list[float | None]]:
    """Linear-interpolated quantiles (pandas / Spark ``percentile`` definition) of one column."""
    probs = list(probs)
    r = grouped_quantiles(unpivoted(df, [col]), "column", "value", probs).first()
    return (0, [None] * len(probs)) if r is None else (r["n"], [r[f"q{j}"] for j in range(len(probs))])


def global_index(df: DataFrame, cols, name: str = "idx") -> DataFrame:
    """Consecutive 0-based index following the order on ``cols`` (ties broken arbitrarily).

    Range-partition + sort inside each partition, tag rows with partition id and a
    monotonically increasing id, checkpoint so the tags are fixed, then add each
    partition's offset (a P-row table, broadcast).
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tagged = (
        df.repartitionByRange(parts, *[F.col(c).asc_nulls_first() for c in cols])
        .sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in cols])
        .select("*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid"))
    )
    tagged = cut_lineage(tagged)
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy("_pid")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
        .select("_pid", "_m0", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    )
    return tagged.join(F.broadcast(offsets), "_pid").select(
        *[F.col(c) for c in df.columns], (F.col("_off") + F.col("_mid") - F.col("_m0")).alias(name)
    )
