"""Statistics of signal and entry tracks over intervals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txspark.operators.intervals import BIN, clip_intervals, overlap_join
from txspark.session import free_shuffles, stored

KEY = ["chromosome", "start", "end"]
STATS = ("mean", "max", "min", "coverage", "std", "sum", "extract_names")


def _sizes_of(track: DataFrame, sizes: DataFrame | None) -> DataFrame:
    """Known chromosomes: the given table, or the largest end of each chromosome of the track."""
    return sizes if sizes is not None else track.groupBy("chromosome").agg(F.max("end").alias("length"))


def _asked(intervals: DataFrame, track: DataFrame, sizes: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Different intervals as q_start, q_end with the part of them that lies on the chromosome; all and the non-empty ones."""
    plain = intervals.select(*KEY).distinct().withColumns({"q_start": F.col("start"), "q_end": F.col("end")})
    return plain, clip_intervals(plain, sizes) if sizes is not None else plain.join(track.select("chromosome").distinct(), "chromosome", "left_semi")


#: Bases of a tile in which the ends of entries are put in order.
TILE = 1 << 16


def depth_segments(entries: DataFrame, on: tuple[str, ...] = ("chromosome",), tile: int = TILE) -> DataFrame:
    """(on, start, end, value): how many entries lie over each stretch that some cover, wherever it is asked for.

    A sweep over the ends of entries, tile by tile: what is open where a tile begins follows from sums over the tiles before it, so that no task sees a
    chromosome. Statistics over these segments add up within tasks; ends of entries by interval that covers them would be rows for each pair.
    """
    place = lambda c: F.floor(F.col(c) / tile)
    tiles = F.explode(F.array_distinct(F.array(place("start"), place("end"))))
    dealt = entries.where("start < end").select(*on, "start", "end", tiles.alias("_tile")).repartition(*on, "_tile")
    ends = F.explode(F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("step")), F.struct(F.col("end").alias("at"), F.lit(-1).alias("step"))))
    steps = dealt.select(*on, "_tile", ends.alias("x")).select(*on, "_tile", "x.*").where(place("at") == F.col("_tile"))
    steps = steps.groupBy(*on, "_tile", "at").agg(F.sum("step").alias("step")).where("step <> 0")
    along, within = Window.partitionBy(*on).orderBy("_tile"), Window.partitionBy(*on, "_tile").orderBy("at")
    opened = steps.groupBy(*on, "_tile").agg(F.sum("step").alias("_net"), F.min("at").alias("_first"))
    opened = opened.select(*on, "_tile", (F.sum("_net").over(along) - F.col("_net")).alias("_before"), F.lead("_first").over(along).alias("_next"))
    parts = steps.join(opened.hint("merge"), [*on, "_tile"])
    found = parts.select(*on, F.col("at").alias("start"), F.coalesce(F.lead("at").over(within), "_next").alias("end"), (F.col("_before") + F.sum("step").over(within)).cast("double").alias("value"))
    return found.where("value > 0")


def _back(intervals: DataFrame, stats: DataFrame, names: list[str]) -> DataFrame:
    on = stats.select("chromosome", F.col("q_start").alias("start"), F.col("q_end").alias("end"), *names)
    return intervals.join(on, KEY, "left")


def signal_stats(intervals: DataFrame, signal: DataFrame, stats: tuple[str, ...] = ("mean", "max", "min", "sum", "std", "coverage"), sizes: DataFrame | None = None, bin_size: int = BIN) -> DataFrame:
    """Statistics of a piecewise constant signal, weighted by overlapping bases, one column for each (TRK1).

    Mean and std are over covered bases (std with n - 1), coverage is the covered share of the interval. An interval without a value, on
    an unknown chromosome or wholly outside it has nulls.
    """
    _, inside = _asked(intervals, signal, sizes)
    pairs = overlap_join(inside, signal.select(*KEY, "value"), bin_size)
    w = F.least("end", "b_end") - F.greatest("start", "b_start")
    v = F.col("b_value")
    n, s, q = F.sum(w), F.sum(v * w), F.sum(v * v * w)
    how = {
        "mean": s / n, "max": F.max(v), "min": F.min(v), "sum": s, "coverage": n / F.first(F.col("end") - F.col("start")),
        "std": F.sqrt(F.greatest(F.when(n > 1, (q - s * s / n) / (n - 1)), F.lit(0.0))),
    }
    found = pairs.groupBy("chromosome", "q_start", "q_end").agg(*[how[x].cast("double").alias(x) for x in stats])
    return _back(intervals, found, list(stats))


def entry_stats(intervals: DataFrame, entries: DataFrame, sizes: DataFrame | None = None, bin_size: int = BIN) -> DataFrame:
    """Coverage and depth of overlapping entries: coverage, depth_sum, depth_mean, depth_min, depth_max (TRK2, TRK3).

    Statistics over ``depth_segments``, which are written once. Mean and minimum are over covered bases. Without
    entries all are 0; on an unknown chromosome or outside it they are null.
    """
    _, inside = _asked(intervals, entries, sizes)
    pairs = overlap_join(inside, stored(depth_segments(entries), "depth"), bin_size)
    w, v = F.least("end", "b_end") - F.greatest("start", "b_start"), F.col("b_value")
    found = pairs.groupBy("chromosome", "q_start", "q_end").agg(
        (F.sum(w) / F.first(F.col("end") - F.col("start"))).alias("coverage"), F.sum(v * w).alias("depth_sum"), (F.sum(v * w) / F.sum(w)).alias("depth_mean"), F.min(v).alias("depth_min"), F.max(v).alias("depth_max"),
    )
    names = ["coverage", "depth_sum", "depth_mean", "depth_min", "depth_max"]
    all_inside = inside.select("chromosome", "q_start", "q_end").join(found, ["chromosome", "q_start", "q_end"], "left").fillna(0.0, names)
    return _back(intervals, all_inside, names)


def entry_coverage(intervals: DataFrame, entries: DataFrame, sizes: DataFrame | None = None, bin_size: int = BIN) -> DataFrame:
    """Share of each interval in the union of the entries (TRK2)."""
    return entry_stats(intervals, entries, sizes, bin_size).select(*intervals.columns, "coverage")


def entry_names(intervals: DataFrame, entries: DataFrame, index: int = 3, sizes: DataFrame | None = None, bin_size: int = BIN) -> DataFrame:
    """Distinct sorted names of overlapping entries, comma-joined: field ``index`` of the entry's ``rest``; empty ones and '.' do not count (TRK4)."""
    _, inside = _asked(intervals, entries, sizes)
    field = F.get(F.split("rest", "\t"), F.lit(index))
    named = entries.select(*KEY, field.alias("name")).where("name <> '' AND name <> '.'").distinct()
    # a hash aggregation leaves each name once, before the few of an interval are collected
    held = overlap_join(inside, named, bin_size).select("chromosome", "q_start", "q_end", "b_name").distinct()
    found = held.groupBy("chromosome", "q_start", "q_end").agg(F.array_join(F.array_sort(F.collect_list("b_name")), ",").alias("names"))
    return _back(intervals, found, ["names"])


ASK = ["chromosome", "start", "end", "_ask"]
#: What a statistic of values and their overlaps is made of.
SUMS = {"mean": ("w", "vw"), "max": ("high",), "min": ("low",), "sum": ("vw",), "coverage": ("w", "len"), "std": ("w", "vw", "vvw")}


def _long_tracks(values: dict[int, tuple[str, DataFrame]], named: dict[int, tuple[int, DataFrame]]) -> DataFrame:
    """All that is asked of tracks as one table by number: the values of signals, the depth of entries, and (``field``, ``name``) of entries, of which several numbers may come from one track."""
    value, name = F.col("value").cast("double"), lambda k: F.get(F.split("rest", "\t"), F.lit(k))
    parts = [df.where("value IS NOT NULL").select(F.lit(i).alias("_track"), *KEY, value.alias("value")) for i, (kind, df) in values.items() if kind == "signal"]
    entries = {i: df.select(*KEY) for i, (kind, df) in values.items() if kind == "entry"}
    if len(entries) == 1:  # a number that is the same in all rows would spoil the partitioning
        parts += [depth_segments(df).select(F.lit(i).alias("_track"), *KEY, "value") for i, df in entries.items()]
    elif entries:
        parts.append(depth_segments(reduce(lambda x, y: x.unionByName(y), [df.withColumn("_track", F.lit(i)) for i, df in entries.items()]), ("_track", "chromosome")))
    parts += [df.select(F.lit(i).alias("_track"), *KEY, name(k).alias("name")).where("name <> '' AND name <> '.'") for i, (k, df) in named.items()]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def _asks(intervals: DataFrame, asks: list[tuple], uses: list[tuple[int, int]], sizes: DataFrame | None) -> DataFrame:
    """A row for each different interval and use of a track by an ask (track, expansion): both numbers, the interval, and the part to look at, within the chromosome."""
    listed = F.array(*[F.struct(F.lit(i).alias("_ask"), F.lit(t).alias("_track"), F.lit(asks[i][1]).alias("up"), F.lit(asks[i][2]).alias("down")) for i, t in uses])
    rows = intervals.select(*KEY).distinct()
    if sizes is not None:
        rows = rows.join(sizes.select("chromosome", F.col("length").alias("_length")), "chromosome", "left")
    rows = rows.select("*", F.explode(listed).alias("x")).select(*rows.columns, "x.*")
    low, high = F.greatest(F.col("start") - F.col("up"), F.lit(0)), F.col("end") + F.col("down")
    high = F.least(high, F.coalesce("_length", high)) if sizes is not None else high
    # an interval that its expansion would empty stays as it is, and so does one without an expansion
    fine = (low < high) & ((F.col("up") != 0) | (F.col("down") != 0))
    rows = rows.withColumns({"_s": F.when(fine, low).otherwise(F.col("start")), "_e": F.when(fine, high).otherwise(F.col("end"))})
    if sizes is not None:
        rows = rows.withColumns({"_s": F.greatest("_s", F.lit(0)), "_e": F.least("_e", "_length")}).where("_length IS NOT NULL AND _s < _e").drop("_length")
    return rows.select(*ASK, "_track", "_s", "_e")


def query_tracks(intervals: DataFrame, spec: list[dict], tracks: dict[str, tuple[str, DataFrame]], sizes: DataFrame | None = None, bin_size: int = BIN) -> DataFrame:
    """All rows of a track specification over all intervals, a column for each name, names in order (TRK5).

    ``spec`` rows have path, stat, name, upstream, downstream and name_field_index; ``tracks`` maps a path to (kind, table) with kind ``signal`` or
    ``entry``. What is asked of the tracks is one long table: values of signals, the depth of entries as values (``depth_segments``), names of entries. Each interval asks for each (track, expansion) that the specification names, so that one overlap join serves all; its
    pairs are added up within tasks by interval and ask, and one aggregation by interval makes the columns. A repeated name takes the later row; a track that
    is missing, names of a signal and the standard deviation of entries give null.
    """
    last = {row["name"]: row for row in spec}
    asked = lambda r: (r["path"], r.get("upstream", 0), r.get("downstream", 0))
    field = lambda r: r.get("name_field_index", 3)
    kind_of = lambda r: "string" if r["stat"] == "extract_names" else "double"
    rest = [c for c in intervals.columns if c not in KEY]
    # of each row that has an answer: the track and, of names, the field
    source = {}
    for name, r in last.items():
        kind = tracks[r["path"]][0] if r["path"] in tracks else None
        if kind == "entry" and r["stat"] == "extract_names":
            source[name] = (r["path"], field(r))
        elif kind and r["stat"] in SUMS and not (kind == "entry" and r["stat"] == "std"):
            source[name] = (r["path"], None)
    if not source:
        return intervals.select(*KEY, *rest, *[F.lit(None).cast(kind_of(r)).alias(n) for n, r in sorted(last.items())])
    number = {x: i for i, x in enumerate(sorted(set(source.values()), key=str))}
    asks = sorted({asked(last[n]) for n in source})
    ask = {n: asks.index(asked(last[n])) for n in source}
    values = {i: tracks[p] for (p, k), i in number.items() if k is None}
    names = {i: (k, tracks[p][1]) for (p, k), i in number.items() if k is not None}
    # read several times
    table = stored(_long_tracks(values, names), "tracks")
    sizes = stored(sizes.select("chromosome", "length"), "sizes") if sizes is not None else None
    free_shuffles(intervals.sparkSession)
    wanted = _asks(intervals, asks, sorted({(ask[n], number[x]) for n, x in source.items()}), sizes)
    looked = wanted.withColumnsRenamed({"start": "_start", "end": "_end"}).withColumnsRenamed({"_s": "start", "_e": "end"})
    pairs = overlap_join(looked, table, bin_size, ("_track", "chromosome"))

    w, v = F.least("end", "b_end") - F.greatest("start", "b_start"), F.col("b_value") if values else F.lit(None).cast("double")
    parts = {"w": F.when(v.isNotNull(), w), "vw": v * w, "vvw": v * v * w, "low": v, "high": v, "len": F.col("end") - F.col("start")}
    add = {"w": F.sum, "vw": F.sum, "vvw": F.sum, "low": F.min, "high": F.max, "len": F.max}
    used = [c for c in add if any(c in SUMS.get(last[n]["stat"], ()) for n in source)]
    text = ["_track", F.col("b_name").alias("name")] if names else []
    rows = pairs.select("chromosome", F.col("_start").alias("start"), F.col("_end").alias("end"), "_ask", *text, *[parts[c].alias(c) for c in used], F.lit(False).alias("_inside"))
    if names:  # a name becomes one row, all values one
        rows = rows.withColumn("_track", F.when(F.col("name").isNotNull(), F.col("_track"))).groupBy(*ASK, "_track", "name").agg(*[add[c](c).alias(c) for c in used], F.lit(False).alias("_inside"))
    entry = [i for i, (kind, _) in values.items() if kind == "entry"]
    if entry:  # an interval without entries has depth 0 where the chromosome is known
        here = wanted.where(F.col("_track").isin(entry))
        if sizes is None:
            known = reduce(lambda x, y: x.unionByName(y), [values[i][1].select(F.lit(i).alias("_track"), "chromosome").distinct() for i in entry])
            here = here.join(known, ["_track", "chromosome"], "left_semi")
        rows = rows.unionByName(here.select(*ASK).withColumns({c: F.lit(None).cast(t) for c, t in rows.dtypes if c not in ASK} | {"_inside": F.lit(True)}))
    columns = []
    for name, r in sorted(last.items()):
        if name not in source:
            columns.append(F.lit(None).cast(kind_of(r)).alias(name))
            continue
        own = F.col("_ask") == ask[name]
        if r["stat"] == "extract_names":
            held = F.collect_list(F.when(own & (F.col("_track") == number[source[name]]), F.col("name")))
            columns.append(F.nullif(F.array_join(F.array_sort(held), ","), F.lit("")).alias(name))
            continue
        x = {c: add[c](F.when(own, F.col(c))) for c in SUMS[r["stat"]]}
        n, s, q = x.get("w"), x.get("vw"), x.get("vvw")
        value = {
            "mean": lambda: s / n, "max": lambda: x["high"], "min": lambda: x["low"], "sum": lambda: s, "coverage": lambda: n / x["len"],
            "std": lambda: F.sqrt(F.greatest(F.when(n > 1, (q - s * s / n) / (n - 1)), F.lit(0.0))),
        }[r["stat"]]().cast("double")
        if tracks[r["path"]][0] == "entry":
            value = F.when(F.bool_or(own & F.col("_inside")), F.coalesce(value, F.lit(0.0)))
        columns.append(value.alias(name))
    wide = rows.groupBy(*KEY).agg(*columns)
    return intervals.join(wide, KEY, "left").select(*KEY, *rest, *sorted(last))
