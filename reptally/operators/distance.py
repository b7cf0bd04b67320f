"""Step 5: replicates that disagree with their group.

Pair tables are sparse where not said otherwise: a pair of units that share no item is at
distance exactly 1 and is not listed. Centre distances count such pairs from group sizes;
histograms are made without any table of pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reptally.functions.bins import centred_bin
from reptally.functions.joins import attach, total_of
from reptally.functions.numeric import normal_probability, normal_quantile
from reptally.functions.storage import cut
from reptally.operators.blanks import group_columns

# sizes of the pieces that the distance step is cut into
UNITS_PER_BLOCK = 1024
ROWS_PER_TASK = 100_000
# rows from which on an item of a tile is summed as a matrix of its own
DENSE_ITEM = 48
# units up to which their places are broadcast to pairs
BROADCAST_UNITS = 200_000
# a spatial median is settled when no distance to it changes by more, or after so many rounds
MEDIAN_CHANGE = 1e-5
MEDIAN_ROUNDS = 100


# fixed values: classes of pairs, in their order
CLASSES = ("PCR.replicates", "Biol.replicates", "Same Barcode Different Site", "Different Barcode")


# sums of the smaller values per pair of units
_SUMS = "grp string, a string, b string, shared double, total_a double, total_b double"
# places of units, of which two make a cell of a tile, are below 2^_BITS, as are blocks
_BITS = 20
_SIDE = 1 << 40


def table_size(long: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct samples and features."""
    kinds = F.approx_count_distinct if approximate else F.count_distinct
    return long.agg(kinds("sample").alias("samples"), kinds("feature").alias("features"))


def edna_index(
    long: DataFrame,
    sample_keys: Sequence[str] = ("sample",),
    feature_keys: Sequence[str] = ("feature",),
) -> DataFrame:
    """Share of the sample's reads, then divided by the feature's largest share."""
    sample_keys, feature_keys = list(sample_keys), list(feature_keys)
    size = F.count(F.lit(1)).alias("n_rows")
    totals = long.groupBy(*sample_keys).agg(F.sum("reads").alias("_total"), size)
    shares = attach(long, totals, sample_keys, by=feature_keys, counted="n_rows").withColumn(
        "share", F.col("reads") / F.col("_total")
    )
    tops = shares.groupBy(*feature_keys).agg(F.max("share").alias("_top"), size)
    scaled = attach(shares, tops, feature_keys, by=sample_keys, counted="n_rows")
    return scaled.withColumn("index", F.col("share") / F.col("_top")).select(*long.columns, "share", "index")


def _label(columns: Sequence[str]) -> Column:
    """One text per combination of values: parts joined by colons, with colons and backslashes
    in a part escaped and a missing part told from every text."""

    def part(name: str) -> Column:
        text = F.col(name).cast("string")
        escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(":"), F.lit("\\:"))
        return F.coalesce(escaped, F.lit("\\N"))

    return F.concat_ws(":", *map(part, columns)) if columns else F.lit("")


def unit_values(
    long: DataFrame, unit: Sequence[str], item: str, value: str, group: Sequence[str] = ()
) -> DataFrame:
    """(grp, unit, item, value): positive sums per unit and item, with labels as by :func:`_label`."""
    keys = list(dict.fromkeys([*group, *unit, item]))
    return (
        long.groupBy(*keys)
        .agg(F.sum(F.col(value).cast("double")).alias("_v"))
        .filter(F.col("_v") > 0)
        .select(
            _label(group).alias("grp"),
            _label(unit).alias("unit"),
            F.col(item).alias("item"),
            F.col("_v").alias("value"),
        )
    )


def unit_totals(values: DataFrame) -> DataFrame:
    """Units with the sum and the number of their values."""
    return values.groupBy("grp", "unit").agg(
        F.sum("value").alias("total"), F.count(F.lit(1)).alias("n_rows")
    )


def _codes(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    coded = column.combine_chunks().dictionary_encode(null_encoding="encode")
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def _shared(rows: pa.Table) -> pa.Table:
    """Sum of the smaller values over shared items, for the pairs of one piece.

    Sorted by item, rows at distance s are compared all at once for s = 1, 2, ...; a
    group of a piece has at most about 1,024 units, which bounds the number of steps.
    """
    grp, grp_names = _codes(rows["grp"])
    names, unit_names = _codes(rows["unit"])
    items, item_names = _codes(rows["item"])
    # units in label order, so that the smaller label of a pair comes first
    order = np.argsort(unit_names.to_numpy(zero_copy_only=False))
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    keys, at, unit = np.unique(grp * len(rank) + rank[names], return_index=True, return_inverse=True)
    unit_grp = keys // len(rank)
    sizes = np.bincount(unit_grp, minlength=len(grp_names))
    first = np.cumsum(sizes) - sizes
    local = np.arange(len(keys)) - first[unit_grp]
    offset = np.concatenate([[0], np.cumsum(sizes * sizes)])

    item = grp * len(item_names) + items
    by_item = np.lexsort((unit, item))
    item, unit = item[by_item], unit[by_item]
    value = rows["value"].to_numpy()[by_item]
    cells = offset[unit_grp] + local * sizes[unit_grp]
    sums = np.zeros(offset[-1])
    left = np.arange(len(item))
    for s in range(1, len(item)):
        # rows whose item ends within s rows are done for good
        left = left[: np.searchsorted(left, len(item) - s)]
        left = left[item[left] == item[left + s]]
        if not left.size:
            break
        a, b = unit[left], unit[left + s]
        np.add.at(sums, cells[a] + local[b], np.minimum(value[left], value[left + s]))

    hit = np.flatnonzero(sums)
    g = np.searchsorted(offset, hit, side="right") - 1
    rest = hit - offset[g]
    a, b = at[first[g] + rest // sizes[g]], at[first[g] + rest % sizes[g]]
    return pa.table(
        {
            "grp": rows["grp"].take(pa.array(a)),
            "a": rows["unit"].take(pa.array(a)),
            "b": rows["unit"].take(pa.array(b)),
            "shared": sums[hit],
            "total_a": rows["total"].take(pa.array(a)),
            "total_b": rows["total"].take(pa.array(b)),
        }
    )


def _blocks_of(totals: DataFrame) -> DataFrame:
    """(grp, n_units, n_values, largest, blocks) of every group."""
    sizes = totals.groupBy("grp").agg(
        F.count(F.lit(1)).alias("n_units"),
        F.sum("n_rows").alias("n_values"),
        F.max("n_rows").alias("largest"),
    )
    return sizes.withColumn("blocks", F.ceil(F.col("n_units") / UNITS_PER_BLOCK))


def unit_pairs(totals: DataFrame) -> DataFrame:
    """(grp, a < b, total_a, total_b) for all pairs of a group, a pair of blocks a task."""
    sizes = _blocks_of(totals).select("grp", "blocks", "n_units")
    units = attach(totals, sizes, ["grp"], "inner", by=["unit"], counted="n_units")
    dealt = (
        units.withColumn("block", F.pmod(F.xxhash64("unit"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
        .select("grp", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "unit", "total")
    )
    one = dealt.withColumnsRenamed({"unit": "a", "total": "total_a", "block": "block_a"})
    two = dealt.withColumnsRenamed({"unit": "b", "total": "total_b", "block": "block_b"})
    near = (F.col("a") < F.col("b")) & ((F.col("lo") == F.col("hi")) | (F.col("block_a") != F.col("block_b")))
    return one.join(two, ["grp", "lo", "hi"]).filter(near).select("grp", "a", "b", "total_a", "total_b")


def pair_distances(values: DataFrame, totals: DataFrame | None = None, every: bool = False) -> DataFrame:
    """Bray-Curtis distance (grp, a < b, dist) of units of one group that share an item, or of
    all its units with ``every``.

    Distances are 1 - 2 * sum(smaller value) / (sum of both). Groups of up to about 1,024 units
    are dealt to tasks together, with items in buckets, so that a large group's items are several
    pieces. Larger groups are cut into blocks of units, and every two blocks are a tile
    (:func:`_tile_stream`), so neither a common item nor a large unit or group lands in one task as
    a whole. What leaves a task are sums per pair of units, not pairs per item.
    """
    totals = unit_totals(values) if totals is None else totals
    per_piece = (F.col("n_values") / F.col("blocks") + F.col("largest")) * 2 / ROWS_PER_TASK
    sizes = _blocks_of(totals).withColumn("buckets", F.greatest(F.lit(1), F.ceil(per_piece)))
    least, most = sizes.agg(F.min("blocks"), F.max("blocks")).first()
    found = []
    if most is None or least == 1:
        sizes_of = sizes.filter("blocks = 1").select("grp", "buckets", "n_units")
        units = attach(totals, sizes_of, ["grp"], "inner", by=["unit"], counted="n_units")
        tiles = F.greatest(F.lit(1), F.ceil(total_of(totals, F.sum("n_rows")) / ROWS_PER_TASK))
        rows = attach(values, units, ["grp", "unit"], "inner", by=["item"], counted="n_rows")
        pieces = rows.withColumn("tile", F.pmod(F.xxhash64("grp"), tiles)).withColumn("bucket", F.pmod(F.xxhash64("item"), F.col("buckets")))
        pieces = pieces.select("tile", "bucket", "grp", "unit", "item", "value", "total")
        parts = pieces.groupBy("tile", "bucket").applyInArrow(_shared, _SUMS)
        found.append(parts.groupBy("grp", "a", "b").agg(F.sum("shared").alias("shared"), F.max("total_a").alias("total_a"), F.max("total_b").alias("total_b")))
    if most is not None and most > 1:
        finer = F.least(F.ceil(2 * F.col("n_values") / (4 * ROWS_PER_TASK)), F.ceil(F.col("n_units") / 64))
        large = sizes.filter("blocks > 1").withColumn("blocks", F.greatest("blocks", finer))
        # as many rows as there are groups of over 1,024 units
        number = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("grp"))
        large = large.select("grp", number.alias("gno"), "blocks", "n_units")
        units = attach(totals, large, ["grp"], "inner", by=["unit"], counted="n_units").withColumn("block", F.pmod(F.xxhash64("unit"), F.col("blocks")).cast("int"))
        at = F.row_number().over(Window.partitionBy("gno", "block").orderBy("unit")) - 1
        head = F.concat(F.length("grp").cast("string"), F.lit(";"), "grp", "unit")
        placed = cut(units.select("grp", "unit", "gno", "blocks", "block", at.alias("at"), "total", "n_rows", head.alias("head")), "tile-units")
        found.append(_tile_stream(values, placed, ["grp", "unit"]).mapInArrow(_tile_pairs, _SUMS))
    sums = reduce(DataFrame.unionByName, found)
    if every:
        apart = unit_pairs(totals).select("grp", "a", "b", F.lit(0.0).alias("shared"), "total_a", "total_b")
        sums = sums.unionByName(apart).groupBy("grp", "a", "b").agg(F.sum("shared").alias("shared"), F.max("total_a").alias("total_a"), F.max("total_b").alias("total_b"))
    dist = F.greatest(F.lit(0.0), 1 - 2 * F.col("shared") / (F.col("total_a") + F.col("total_b")))
    return sums.select("grp", "a", "b", dist.alias("dist"))


def bray_curtis(
    long: DataFrame, unit: Sequence[str] = ("run", "sample"), item: str = "feature", value: str = "index"
) -> DataFrame:
    """Distances (a, b, dist) between all samples over features; unlisted pairs are at 1."""
    return pair_distances(cut(unit_values(long, unit, item, value), "values")).drop("grp")


def location_columns(mode: str = "double") -> tuple[list[str], list[str]]:
    """Columns of a replicate group and of one replicate in it."""
    group = ["run", *group_columns(mode)]
    return group, [*group, "tech_rep" if mode == "double" else "bio_rep"]


def location_values(long: DataFrame, mode: str = "double", value: str = "index") -> DataFrame:
    """Values of every replicate, by taxon, within its group."""
    group, unit = location_columns(mode)
    return unit_values(long, unit, "taxon", value, group)


def bray_curtis_within(long: DataFrame, mode: str = "double", value: str = "index") -> DataFrame:
    """Distances (grp, a, b, dist) between all replicates of each group, over taxa."""
    return pair_distances(cut(location_values(long, mode, value), "values"), every=True)


def sample_units(long: DataFrame, columns: Sequence[str] = ("site", "bio_rep")) -> DataFrame:
    """Label and place of every (run, sample)."""
    return long.select(_label(["run", "sample"]).alias("unit"), "run", *columns).distinct()


def pair_class(pairs: DataFrame, units: DataFrame) -> DataFrame:
    """Class of each pair by how much of their place the two samples have in common."""

    def side(name: str) -> DataFrame:
        place = F.struct("run", "site", "bio_rep").alias(f"_{name}")
        return units.select(F.col("unit").alias(name), place)

    # pairs grow with the square of the units, so that these are few beside them; where they are
    # many, every unit is in at most as many pairs as there are units: no key stands out
    units = cut(units, "places")
    few = F.broadcast if units.count() <= BROADCAST_UNITS else lambda rows: rows
    both = pairs.join(few(side("a")), "a", "left").join(few(side("b")), "b", "left")

    def same(*columns: str):
        out = F.lit(True)
        for c in columns:
            out = out & F.col(f"_a.{c}").eqNullSafe(F.col(f"_b.{c}"))
        return out

    order = (
        F.when(same("run", "site", "bio_rep"), 0).when(same("run", "site"), 1).when(same("run"), 2).otherwise(3)
    )
    names = F.array(*[F.lit(c) for c in CLASSES])
    return both.select("a", "b", "dist", order.alias("class_order")).withColumn(
        "pair_class", F.element_at(names, F.col("class_order") + 1)
    )


def both_orders(pairs: DataFrame) -> DataFrame:
    """Every pair twice, as (a, b) and as (b, a)."""
    rest = [c for c in pairs.columns if c not in ("a", "b")]
    ends = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    return pairs.select(ends.alias("_p"), *rest).select("_p.a", "_p.b", *rest)


def class_totals(units: DataFrame) -> DataFrame:
    """Number of pairs of each class, listed or not, from the sizes of the groups."""

    def choose2(n: str):
        return F.col(n) * (F.col(n) - 1) / 2

    bottles = units.groupBy("run", "site", "bio_rep").agg(F.count(F.lit(1)).alias("n"))
    sites = bottles.groupBy("run", "site").agg(F.sum(choose2("n")).alias("in_bottle"), F.sum("n").alias("n"))
    runs = sites.groupBy("run").agg(
        F.sum("in_bottle").alias("in_bottle"), F.sum(choose2("n")).alias("in_site"), F.sum("n").alias("n")
    )
    all_of = runs.agg(
        F.sum("in_bottle").alias("in_bottle"),
        F.sum("in_site").alias("in_site"),
        F.sum(choose2("n")).alias("in_run"),
        F.sum("n").alias("n"),
    )
    numbers = [
        F.col("in_bottle"),
        F.col("in_site") - F.col("in_bottle"),
        F.col("in_run") - F.col("in_site"),
        choose2("n") - F.col("in_run"),
    ]
    rows = [
        F.struct(F.lit(i).alias("class_order"), F.lit(name).alias("pair_class"), n.cast("bigint").alias("n_pairs"))
        for i, (name, n) in enumerate(zip(CLASSES, numbers))
    ]
    return all_of.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _bins(dist: np.ndarray, width: float) -> np.ndarray:
    """As :func:`centred_bin` from 0 on, of distances at 9 digits."""
    return np.ceil(np.round(dist, 9) / width - 0.5).astype(np.int64)


def _tile_stream(values: DataFrame, placed: DataFrame, on: Sequence[str]) -> DataFrame:
    """What tiles are made of, sorted by tile: (tile, kind, p, value, name).

    ``placed`` (the columns ``on`` that name a unit, gno, blocks, block, at, total, n_rows, head) has the
    units of group ``gno`` dealt to ``blocks`` blocks; two blocks, or one, are a tile. First come a tile's
    units (kind 0: side and place, total, head), then sums of pairs (kind 1: cell, smaller value), then
    values by item (kind 2: side and place, value, item). An item's pairs are sent one by one where that is
    less than its values once per block, which is so for items of few units; those of many
    units are never paired before they meet in the tile.
    """
    keys = ["gno", "item"]
    item = F.coalesce(F.concat(F.lit("="), F.col("item").cast("string")), F.lit("")).alias("item")
    cells = attach(values.select(*on, "item", "value"), placed.select(*on, "gno", "blocks", "block", "at", "n_rows"), on, "inner", by=["item"], counted="n_rows")
    cells = cut(cells.select("gno", "blocks", item, "block", "at", "value"), "tile-values")
    common = cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.max("blocks").alias("_most")).filter(F.col("n_rows") - 1 > 2 * F.col("_most"))
    common = cut(common.select(*keys, "n_rows"), "tile-items")

    def tile(lo: Column, hi: Column) -> Column:
        bits = F.shiftleft(F.col("gno").cast("bigint"), 2 * _BITS) + F.shiftleft(lo.cast("bigint"), _BITS) + hi.cast("bigint")
        return bits.alias("tile")

    def dealt(rows: DataFrame, kind: int, value: str, name: str) -> DataFrame:
        """Rows of units once for each tile of their block."""
        each = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))
        lo, hi = F.least("block", "_other"), F.greatest("block", "_other")
        side = F.when(F.col("block") != lo, F.lit(_SIDE)).otherwise(F.lit(0).cast("bigint")) + F.col("at")
        return each.select(tile(lo, hi), F.lit(kind).alias("kind"), side.alias("p"), F.col(value).alias("value"), F.col(name).alias("name"))

    rare = attach(cells, common.select(*keys), keys, "left_anti", by=["block", "at"])
    lists = rare.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("block", "at", "value"))).alias("_l"))
    first = lists.filter(F.size("_l") > 1).select("gno", "_l", F.posexplode("_l").alias("_i", "_x")).filter(F.col("_i") + 1 < F.size("_l"))
    # never empty; outer, as the plan else makes each slice twice to see that
    pairs = first.select("gno", "_x", F.explode_outer(F.slice("_l", F.col("_i") + 2, F.size("_l"))).alias("_y"))
    cell = F.shiftleft(F.col("_x.at").cast("bigint"), _BITS) + F.col("_y.at")
    pairs = pairs.select(
        tile(F.col("_x.block"), F.col("_y.block")), F.lit(1).alias("kind"), cell.alias("p"), F.least("_x.value", "_y.value").alias("value"), F.lit(None).cast("string").alias("name")
    )
    many = attach(cells, common.withColumn("_n", F.col("n_rows")), keys, "inner", by=["block", "at"], counted="_n")
    parts = dealt(placed, 0, "total", "head").unionByName(pairs).unionByName(dealt(many, 2, "value", "item"))
    return parts.repartition("tile").sortWithinPartitions("tile", "kind", "name")


class _Tile:
    """Sums of the smaller values for all pairs of two blocks of units (or within one)."""

    def __init__(self, tile: int, place: np.ndarray, total: np.ndarray, heads: pa.ChunkedArray) -> None:
        blocks = tile & (1 << 2 * _BITS) - 1
        self.within = blocks >> _BITS == blocks & (1 << _BITS) - 1
        self.total, self.heads = total, heads
        side, at = place // _SIDE, place % _SIDE
        of = [np.flatnonzero(side == k)[np.argsort(at[side == k])] for k in (0, 1)]
        self.rows, self.columns = of[0], of[0] if self.within else of[1]
        self.shape = len(self.rows), len(self.columns)
        self.sums = np.zeros(self.shape)

    def add_cells(self, cell: np.ndarray, value: np.ndarray) -> None:
        np.add.at(self.sums.reshape(-1), (cell >> _BITS) * self.shape[1] + (cell & (1 << _BITS) - 1), value)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The two units of each pair that shares an item, by their places among the heads, and its sum."""
        hit = np.flatnonzero(self.sums)
        a, b = hit // max(1, self.shape[1]), hit % max(1, self.shape[1])
        if self.within:
            hit, a, b = (x[a < b] for x in (hit, a, b))
        return self.rows[a], self.columns[b], self.sums.reshape(-1)[hit]

    def add(self, runs: np.ndarray, side: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
        """Rows of whole items; ``runs`` numbers the items in order."""
        begins = np.flatnonzero(np.concatenate([[True], runs[1:] != runs[:-1]]))
        sizes = np.diff(np.concatenate([begins, [len(runs)]]))
        for k in np.flatnonzero(sizes >= DENSE_ITEM):
            own = slice(begins[k], begins[k] + sizes[k])
            first, second = (side[own] == 0, side[own] == (0 if self.within else 1))
            self.sums[np.ix_(at[own][first], at[own][second])] += np.minimum.outer(value[own][first], value[own][second])
        small = np.repeat(sizes < DENSE_ITEM, sizes)
        runs, side, at, value = runs[small], side[small], at[small], value[small]
        order = np.lexsort((at, side, runs))
        runs, side, at, value = runs[order], side[order], at[order], value[order]
        left = np.arange(len(runs))
        flat = self.sums.reshape(-1)
        for s in range(1, DENSE_ITEM):
            # rows whose item ends within s rows are done for good
            left = left[: np.searchsorted(left, len(runs) - s)]
            left = left[runs[left] == runs[left + s]]
            if not left.size:
                break
            pick = left if self.within else left[side[left] != side[left + s]]
            np.add.at(flat, at[pick] * self.shape[1] + at[pick + s], np.minimum(value[pick], value[pick + s]))

    def counts(self, width: float) -> dict[tuple[int, int], int]:
        """Number of pairs that share an item per class and bin."""
        a, b, shared = self.pairs()
        if not len(a):
            return {}
        both = self.total[a] + self.total[b]
        bins = _bins(np.maximum(0.0, 1 - np.divide(2 * shared, both, out=np.zeros(len(a)), where=both > 0)), width)
        # labels of run, site and bottle, each the begin of the next
        labels = [(*map(int, sizes.split(",")), label) for sizes, _, label in (h.partition(";") for h in self.heads.to_pylist())]
        kind = np.full(len(a), 3)
        for order, names in ((2, [x[:run] for run, _, x in labels]), (1, [x[:site] for _, site, x in labels]), (0, [x for *_, x in labels])):
            codes = np.unique(names, return_inverse=True)[1]
            kind[codes[a] == codes[b]] = order
        base = int(bins.max()) + 1
        codes, n = np.unique(kind * base + bins, return_counts=True)
        return {(int(c // base), int(c % base)): int(k) for c, k in zip(codes, n)}


def _read_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[_Tile]:
    """Tiles one after another, each from its units and then its pairs and values. One tile's sums
    and the rows of one batch are held."""

    def whole_runs() -> Iterator[tuple[pa.Table, np.ndarray]]:
        rest: pa.Table | None = None

        def runs(table: pa.Table) -> np.ndarray:
            """Begins of a tile's units, of single pairs and of a tile's items."""
            tile, kind = table["tile"].to_numpy(), table["kind"].to_numpy()
            new = np.ones(len(table), bool)
            new[1:] = (tile[1:] != tile[:-1]) | (kind[1:] != kind[:-1]) | (kind[1:] == 1)
            name = table["name"].combine_chunks()
            apart = pc.fill_null(pc.not_equal(name[1:], name[:-1]), False).to_numpy(zero_copy_only=False)
            new[1:] |= apart & (kind[1:] == 2)
            return new

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
            if not len(table):
                continue
            new = runs(table)
            last = np.flatnonzero(new)[-1]
            if last:
                yield table[:last], np.cumsum(new[:last])
            rest = table[last:]
        if rest is not None and len(rest):
            yield rest, np.cumsum(runs(rest))

    now: _Tile | None = None
    for table, runs in whole_runs():
        tile, kind, p, value = (table[c].to_numpy() for c in ("tile", "kind", "p", "value"))
        cuts = np.flatnonzero(np.concatenate([[True], (tile[1:] != tile[:-1]) | (kind[1:] != kind[:-1])]))
        for a, b in zip(cuts, [*cuts[1:], len(tile)]):
            if kind[a] == 0:  # the units of a tile are one run, and come before the rest
                if now is not None:
                    yield now
                now = _Tile(int(tile[a]), p[a:b], value[a:b], table["name"][a:b])
            elif kind[a] == 1:
                now.add_cells(p[a:b], value[a:b])
            else:
                now.add(runs[a:b], p[a:b] // _SIDE, p[a:b] % _SIDE, value[a:b])
    if now is not None:
        yield now


def _tile_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the pairs that share an item, smaller label first; heads are the group's and the unit's label."""
    for tile in _read_tiles(batches):
        one, two, shared = tile.pairs()
        if not len(one):
            continue
        size, _, label = tile.heads[0].as_py().partition(";")
        grp = label[: int(size)]
        units = pc.utf8_slice_codeunits(tile.heads.combine_chunks(), len(size) + 1 + len(grp))
        order = np.argsort(np.array(units.to_pylist(), object))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        a, b = np.where(rank[one] < rank[two], one, two), np.where(rank[one] < rank[two], two, one)
        for at in range(0, len(a), ROWS_PER_TASK):
            x, y = a[at : at + ROWS_PER_TASK], b[at : at + ROWS_PER_TASK]
            yield pa.RecordBatch.from_pydict(
                {
                    "grp": pa.repeat(pa.scalar(grp), len(x)),
                    "a": units.take(pa.array(x)),
                    "b": units.take(pa.array(y)),
                    "shared": shared[at : at + ROWS_PER_TASK],
                    "total_a": tile.total[x],
                    "total_b": tile.total[y],
                }
            )


def _tile_counts(width: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of the tiles that a task reads."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {}
        for tile in _read_tiles(batches):
            for k, n in tile.counts(width).items():
                total[k] = total.get(k, 0) + n
        yield pa.RecordBatch.from_pydict(
            {
                "class_order": pa.array([k for k, _ in total], pa.int32()),
                "bin": pa.array([b for _, b in total], pa.int64()),
                "n": pa.array(list(total.values()), pa.int64()),
            }
        )

    return count


def pair_hist(values: DataFrame, units: DataFrame, width: float = 0.05) -> DataFrame:
    """Histogram of all distances between ``units`` (unit, run, site, bio_rep) per class, bins of
    ``width`` centred on its multiples, with densities.

    No pair is listed. Units are dealt to blocks of about 1,024 and every two blocks make a
    tile with one matrix of sums (:func:`_tile_stream`); what leaves a task are counts per class and
    bin of the pairs that share an item. All others are at distance 1, and their number follows
    from the sizes of the classes.
    """
    totals = unit_totals(values)
    known = attach(units, totals.select("unit", "total", "n_rows"), ["unit"], by=["run"])
    n_units, n_rows = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_rows"), F.lit(0))).first()
    # enough tiles that none has all the work, and no more than one for every 64 units
    blocks = max(1, -(-n_units // UNITS_PER_BLOCK), min(-(-2 * n_rows // (4 * ROWS_PER_TASK)), -(-n_units // 64)))
    at = F.row_number().over(Window.partitionBy("block").orderBy("unit")) - 1
    run, site, bottle = (_label(c) for c in (["run"], ["run", "site"], ["run", "site", "bio_rep"]))
    head = F.concat(F.length(run).cast("string"), F.lit(","), F.length(site).cast("string"), F.lit(";"), bottle)
    placed = cut(
        known.withColumn("block", F.pmod(F.xxhash64("unit"), F.lit(blocks)).cast("int")).select(
            "unit", F.lit(0).alias("gno"), F.lit(blocks).alias("blocks"), "block", at.alias("at"),
            F.coalesce("total", F.lit(0.0)).alias("total"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"), head.alias("head"),
        ),
        "tile-units",
    )
    near = _tile_stream(values, placed, ["unit"]).mapInArrow(_tile_counts(width), "class_order int, bin bigint, n bigint")
    near = cut(near.groupBy("class_order", "bin").agg(F.sum("n").alias("n")), "tile-counts")
    whole = class_totals(units).select("class_order", F.col("n_pairs").alias("_pairs"))
    listed = near.groupBy("class_order").agg(F.sum("n").alias("_near"))
    apart = whole.join(F.broadcast(listed), "class_order", "left").select(
        "class_order", F.lit(int(_bins(np.ones(1), width)[0])).cast("bigint").alias("bin"), (F.col("_pairs") - F.coalesce("_near", F.lit(0))).alias("n")
    )
    counted = near.unionByName(apart.filter("n > 0")).groupBy("class_order", "bin").agg(F.sum("n").alias("n"))
    names = F.array(*[F.lit(c) for c in CLASSES])
    return counted.join(F.broadcast(whole), "class_order").select(
        F.element_at(names, F.col("class_order") + 1).alias("pair_class"), "class_order", "bin", "n", (F.col("n") / (F.col("_pairs") * F.lit(width))).alias("density")
    )


def sample_hist(long: DataFrame, item: str = "feature", value: str = "index", width: float = 0.05) -> DataFrame:
    """:func:`pair_hist` of all samples over features."""
    return pair_hist(cut(unit_values(long, ["run", "sample"], item, value), "values"), cut(sample_units(long), "units"), width)


def lone_replicates(long: DataFrame, mode: str = "double") -> DataFrame:
    """Groups with a single replicate."""
    group, unit = location_columns(mode)
    return (
        long.groupBy(*group)
        .agg(F.count_distinct(unit[-1]).alias("cases"))
        .filter(F.col("cases") == 1)
        .select(*group)
    )


def drop_lone(long: DataFrame, mode: str = "double") -> DataFrame:
    group, _ = location_columns(mode)
    return attach(long, lone_replicates(long, mode), group, "left_anti", by=["feature", "sample"]).select(
        *long.columns
    )


def pairs_per_group(totals: DataFrame) -> DataFrame:
    """Number of comparisons in each group, whether listed or not."""
    n = F.count(F.lit(1))
    return totals.groupBy("grp").agg((n * (n - 1) / 2).cast("bigint").alias("n_pairs"))


def _centre_mean(pairs: DataFrame, units: DataFrame) -> DataFrame:
    """Distance to the group's centroid from the pair distances alone (Gower 1966; Anderson 2006)."""
    square = F.col("dist") * F.col("dist")
    ends = F.explode(F.array("a", "b"))
    near = (
        pairs.select("grp", ends.alias("unit"), square.alias("_sq"))
        .groupBy("grp", "unit")
        .agg(F.sum("_sq").alias("_sq"), F.count(F.lit(1)).alias("_n"))
    )
    groups = units.groupBy("grp").agg(F.count(F.lit(1)).alias("n_rows"))
    # (grp, unit) is a key of both sides, so no task gets more than its share
    sums = attach(
        units.select("grp", "unit").join(near, ["grp", "unit"], "left"),
        groups.withColumn("n_units", F.col("n_rows")),
        ["grp"],
        "inner",
        by=["unit"],
        counted="n_rows",
    ).withColumn(
        "_sq",
        F.coalesce("_sq", F.lit(0.0)) + F.col("n_units") - 1 - F.coalesce("_n", F.lit(0)),
    )
    whole = sums.groupBy("grp").agg(F.sum("_sq").alias("_all"), F.count(F.lit(1)).alias("n_rows"))
    n = F.col("n_units").cast("double")
    squared = F.col("_sq") / n - F.col("_all") / (n * n * 2)
    return attach(sums, whole, ["grp"], "inner", by=["unit"], counted="n_rows").select(
        "grp", "unit", F.sqrt(F.abs(squared)).alias("distance")
    )


def _centre_median(pairs: DataFrame, units: DataFrame) -> DataFrame:
    """Distance to the group's spatial median from the pair distances alone.

    The median is a weighted mean of the units. Weiszfeld's rounds give each unit the inverse of
    its distance to the last median as its weight; with weights w, the squared distance to their
    mean is the weighted sum of a unit's squared distances, less half of that of all units. One
    round is two aggregates for all groups at once.
    """
    square = (F.col("dist") * F.col("dist")).alias("sq")
    both = cut(
        pairs.select("grp", F.col("a").alias("unit"), F.col("b").alias("other"), square).unionByName(
            pairs.select("grp", F.col("b").alias("unit"), F.col("a").alias("other"), square)
        ),
        "both-ends",
    )
    state = cut(units.select("grp", "unit", F.lit(1.0).alias("v"), F.lit(None).cast("double").alias("distance")), "median")
    for _ in range(MEDIAN_ROUNDS):
        weights = state.select("grp", F.col("unit").alias("other"), F.col("v").alias("w"))
        # a unit has as many rows as its group has units; (grp, other) stands out no more
        near = both.join(weights, ["grp", "other"]).groupBy("grp", "unit").agg(F.sum(F.col("w") * F.col("sq")).alias("p"), F.sum("w").alias("k"))
        # pairs that share nothing are at distance 1
        gap = F.coalesce("p", F.lit(0.0)) - F.col("v") - F.coalesce("k", F.lit(0.0))
        each = cut(state.join(near, ["grp", "unit"], "left").select("grp", "unit", "v", "distance", gap.alias("gap")), "median-sums")
        whole = each.groupBy("grp").agg(F.sum("v").alias("all_v"), F.sum(F.col("v") * F.col("gap")).alias("all_gap"), F.count(F.lit(1)).alias("n_rows"))
        squared = (F.col("gap") + F.col("all_v")) / F.col("all_v") - (F.col("all_gap") + F.col("all_v") * F.col("all_v")) / (2 * F.col("all_v") * F.col("all_v"))
        found = attach(each, whole, ["grp"], "inner", by=["unit"], counted="n_rows").withColumn("_new", F.sqrt(F.abs(squared)))
        state = cut(
            found.select("grp", "unit", (1 / F.greatest(F.col("_new"), F.lit(1e-9))).alias("v"), F.col("_new").alias("distance"), F.abs(F.col("_new") - F.col("distance")).alias("change")),
            "median",
        )
        left = state.agg(F.max(F.coalesce("change", F.lit(1.0)))).first()[0]
        state = state.drop("change")
        if left is None or left <= MEDIAN_CHANGE:
            break
    return state.select("grp", "unit", "distance")


def centroid_distance(pairs: DataFrame, units: DataFrame, kind: str = "mean") -> DataFrame:
    """Distance (grp, unit, distance) of every replicate to the centre of its group.

    ``units`` lists (grp, unit); groups of one are left out. The centre is the mean, whose
    distances are aggregates of the pairs, or the spatial median (``kind="median"``), which is
    found in rounds; a group may have any size with both. Two replicates are at half their
    distance with both.
    """
    if kind not in ("mean", "median"):
        raise ValueError(kind)
    sizes = units.groupBy("grp").agg(F.count(F.lit(1)).alias("n_rows"))
    lone = sizes.filter(F.col("n_rows") < 2).select("grp")
    units = attach(units.select("grp", "unit"), lone, ["grp"], "left_anti", by=["unit"], weights=sizes)
    return (_centre_mean if kind == "mean" else _centre_median)(pairs, units)


def normal_fit(distances: DataFrame) -> DataFrame:
    """Mean and population deviation of all distances, in one row."""
    return distances.agg(F.avg("distance").alias("mu"), F.stddev_pop("distance").alias("sd"))


def normal_prob(distances: DataFrame, fit: DataFrame) -> DataFrame:
    """Normal distribution function of every distance, for display."""
    z = F.try_divide(F.col("distance") - fit.select("mu").scalar(), fit.select("sd").scalar())
    return distances.withColumn("_z", z).withColumn("prob", normal_probability(F.col("_z"))).drop("_z")


def distance_outliers(distances: DataFrame, prob: float = 0.975, fit: DataFrame | None = None) -> DataFrame:
    """Replicates beyond the ``prob`` quantile of the fit; 1 leaves all in."""
    if prob >= 1:
        return distances.filter(F.lit(False))
    fit = normal_fit(distances) if fit is None else fit
    limit = fit.select((F.col("mu") + F.lit(normal_quantile(prob)) * F.col("sd")).alias("v")).scalar()
    return distances.filter(F.col("distance") > limit)


def drop_replicates(long: DataFrame, bad: DataFrame, mode: str = "double") -> DataFrame:
    """Remove replicates; ``bad`` names them in ``unit``."""
    _, unit = location_columns(mode)
    names = bad.select(F.col("unit").alias("_unit")).distinct()
    rows = long.withColumn("_unit", _label(unit))
    return attach(rows, names, ["_unit"], "left_anti", by=["feature", "sample"]).select(*long.columns)


def replication_level(long: DataFrame, mode: str = "double") -> DataFrame:
    """Replicates left per run, site and biological replicate."""
    _, unit = location_columns(mode)
    return long.groupBy("run", "site", "bio_rep").agg(F.count_distinct(unit[-1]).alias("cases"))
