"""Spatial joins: boxes first, then the exact test, both on whole batches.

A right side of few vertices is sent to every task, and the left side is not shuffled. Beyond that both sides are dealt
out by cells of a grid. Either way a task holds right rows of a bounded number and reads the left ones by batches; the pairs
are handed on in steps and never held together.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from geosync.functions import geom as g
from geosync.functions import grid, planar, shapes
from geosync.session import stage

#: Vertices and rows of a right side that is sent to every task, some 250 MB with its index; a larger one is dealt out.
SENT = 1 << 22
#: Vertices and rows of both sides that a bucket of cells holds on average.
BUCKET = 1 << 20
#: Rows of one side in a cell beyond which they are split over several buckets, each with so many.
HOT_ROWS = 250_000
#: Left rows whose right ids are gathered at once, and pairs beyond which they are taken in halves.
GATHERED, GATHERED_PAIRS = 1 << 11, 1 << 22

# How two rows may meet in a cell: on one level, or on that of the coarser one.
_SAME, _LEFT_COARSER, _RIGHT_COARSER = 0, 1, 2
_PLACE = ["_meet", "_level", "_cell"]
_BOX = ("xmin", "ymin", "xmax", "ymax")
#: What a join gives beside ids and kept columns, and how two geometries must lie.
_MEETS, _WITHIN, _COVER = "meets", "within", "cover"


def _boxed(df: DataFrame, key: str, geom: str, side: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Id, geometry and box of the rows that have one."""
    named = df.select(F.col(key).alias(f"_{side}id"), F.col(geom).alias(f"_{side}g"), *(F.col(c).alias(f"_keep_{c}") for c in keep))
    return named.withColumn(f"_{side}b", g.bbox(F.col(f"_{side}g"))).filter(F.col(f"_{side}b").isNotNull())


def _weight(side: str) -> Column:
    return g.n_points(F.col(f"_{side}g")) + 1


class _Rows:
    """One side's rows in Arrow, with what is prepared once for all candidates."""

    def __init__(self, rows: pa.Table | pa.RecordBatch, side: str):
        whole = rows if isinstance(rows, pa.Table) else pa.Table.from_batches([rows])
        self.table = whole.combine_chunks()
        geom, box = (self.array(f"_{side}{c}") for c in "gb")
        self.box = [box.field(c).to_numpy(zero_copy_only=False) for c in _BOX]
        self.shapes = shapes.Shapes(geom)
        self.fills = self.shapes.fills_box()
        self._prepared: shapes.Prepared | None = None
        self._borders: shapes.Borders | None = None

    def array(self, name: str) -> pa.Array:
        column = self.table.column(name)
        return column.chunk(0) if column.num_chunks else pa.array([], column.type)

    def numbers(self, name: str) -> np.ndarray:
        return self.array(name).to_numpy(zero_copy_only=False)

    @property
    def prepared(self) -> shapes.Prepared:
        if self._prepared is None:
            self._prepared = shapes.Prepared(self.shapes)
        return self._prepared

    @property
    def borders(self) -> shapes.Borders:
        if self._borders is None:
            self._borders = shapes.Borders(self.shapes)
        return self._borders


def _hits(left: _Rows, right: _Rows, i: np.ndarray, j: np.ndarray, want: str, start: np.ndarray) -> np.ndarray:
    """Whether geometries whose boxes meet do so themselves; where both fill their boxes that is known."""
    if want == _WITHIN:
        x, y = left.shapes.x[start[i]], left.shapes.y[start[i]]
        sure = right.fills[j]
        hit = sure & (right.box[0][j] < x) & (x < right.box[2][j]) & (right.box[1][j] < y) & (y < right.box[3][j])
        if not sure.all():
            hit[~sure] = right.prepared.covers(j[~sure], x[~sure], y[~sure], strict=True)
        return hit
    hit = left.fills[i] & right.fills[j]
    if not hit.all():
        rest = np.flatnonzero(~hit)
        hit[rest] = shapes.meets(left.prepared, right.prepared, i[rest], j[rest])
    return hit


def _found(left: _Rows, right: _Rows, boxes: shapes.Boxes, want: str, allowed) -> Iterator[list[pa.Array]]:
    """Ids, kept columns and measures of the pairs that are to be in the result."""
    kept = [c for c in left.table.column_names if c.startswith("_keep_")]
    first, owner = left.shapes.first_vertices()
    start = np.zeros(left.shapes.n, np.int64)
    start[owner[::-1]] = first[::-1]
    for i, j in boxes.candidates(*left.box):
        if allowed is not None:
            near = allowed(i, j)
            i, j = i[near], j[near]
        hit = _hits(left, right, i, j, want, start)
        if not hit.all():
            i, j = i[hit], j[hit]
        out = [left.array("_lid").take(pa.array(i)), right.array("_rid").take(pa.array(j)), *(left.array(c).take(pa.array(i)) for c in kept)]
        if want == _COVER:
            x, y = (np.nan_to_num(left.numbers(f"_keep_{c}")[i], nan=np.inf) for c in ("_mx", "_my"))
            out += [pa.array(shapes.overlap(left.borders, right.borders, i, j)), pa.array(right.prepared.covers(j, x, y, strict=True))]
        yield out


def _joined(left: DataFrame, right: DataFrame, left_id: str, right_id: str, left_geom: str, right_geom: str, cell: float,
            want: str, hot_rows: int, sent: int, keep: tuple[str, ...] = ()) -> DataFrame:
    lhs, rhs = _boxed(left, left_id, left_geom, "l", keep), _boxed(right, right_id, right_geom, "r")
    names = [left_id, right_id, *keep, *(("overlap_sqm", "centroid_within") if want == _COVER else ())]
    types = [*(lhs.schema[c].dataType.simpleString() for c in ("_lid",)), rhs.schema["_rid"].dataType.simpleString(), *(lhs.schema[f"_keep_{c}"].dataType.simpleString() for c in keep)]
    types += ["double", "boolean"] if want == _COVER else []
    inner = [f"c{k}" for k in range(len(names))]
    shape = ", ".join(f"{c} {t}" for c, t in zip(inner, types))
    weight = rhs.agg(F.sum(_weight("r"))).first()[0] or 0
    made = _sent(lhs, rhs, want, inner, shape) if weight <= sent else _dealt(lhs, rhs, want, inner, shape, cell, hot_rows)
    return made.toDF(*names)


def _sent(lhs: DataFrame, rhs: DataFrame, want: str, names: list[str], shape: str) -> DataFrame:
    """The right side, whose size was checked, goes to every task."""
    shared = lhs.sparkSession.sparkContext.broadcast(rhs.toArrow())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right = _Rows(shared.value, "r")
        boxes = shapes.Boxes(*right.box)
        for batch in batches:
            for out in _found(_Rows(batch, "l"), right, boxes, want, None):
                yield pa.RecordBatch.from_arrays(out, names=names)

    return lhs.mapInArrow(run, shape)


def _levels(located: DataFrame, side: str) -> list[int]:
    """Levels in use: one for each fourfold size of box, so a few dozen whatever the data."""
    return sorted(row[0] for row in located.select(f"_{side}l").distinct().collect() if row[0] is not None)


def _placed(located: DataFrame, side: str, others: list[int], coarser: int, finer: int, cell: float) -> DataFrame:
    """A row for each cell in which a geometry can meet one of the other side.

    It meets coarser ones in cells of their level, and all others in cells of its own.
    """
    own = F.col(f"_{side}l")
    meets = F.transform(
        F.array(*[F.lit(level) for level in others]).cast("array<int>"),
        lambda level: F.struct(
            F.when(level == own, _SAME).when(level > own, coarser).otherwise(finer).alias("_meet"),
            F.greatest(level, own).alias("_level"),
        ),
    )
    met = located.select("*", F.explode(F.array_distinct(meets)).alias("_m")).select(*located.columns, "_m._meet", "_m._level")
    return met.withColumn("_cell", F.explode(grid.cover(F.col(f"_{side}b"), cell, F.col("_level"))))


def _dealt(lhs: DataFrame, rhs: DataFrame, want: str, names: list[str], shape: str, cell: float, hot_rows: int) -> DataFrame:
    """Both sides are staged with their boxes and dealt into buckets of cells.

    A box lies on the level of the grid that fits its size and touches four cells there at most; two rows meet in cells
    of the coarser one's level, and a pair that meets in several is kept in one of them only, so no distinct is needed.
    Where one side has more than ``hot_rows`` rows in a cell, they are split and the other side's are copied; the list
    of such cells has an entry for each ``hot_rows`` rows at most.
    """
    lhs = stage(lhs.withColumn("_ll", grid.level_of(F.col("_lb"), cell)), "located-l")
    rhs = stage(rhs.withColumn("_rl", grid.level_of(F.col("_rb"), cell)), "located-r")
    left_levels, right_levels = _levels(lhs, "l"), _levels(rhs, "r")
    lhs = _placed(lhs, "l", right_levels, _RIGHT_COARSER, _LEFT_COARSER, cell)
    rhs = _placed(rhs, "r", left_levels, _LEFT_COARSER, _RIGHT_COARSER, cell)
    weight = sum((side.agg(F.sum(_weight(name))).first()[0] or 0) for side, name in ((lhs, "l"), (rhs, "r")))
    buckets = max(1, -(-weight // BUCKET), lhs.sparkSession.sparkContext.defaultParallelism)
    parts = F.ceil(F.col("count") / hot_rows).cast("int")
    crowded = [
        side.groupBy(*_PLACE).count().filter(F.col("count") > hot_rows).select(*_PLACE, parts.alias(own), F.lit(1).alias(other))
        for side, own, other in ((lhs, "_lparts", "_rparts"), (rhs, "_rparts", "_lparts"))
    ]
    hot = crowded[0].unionByName(crowded[1]).groupBy(*_PLACE).agg(F.max("_lparts").alias("_lparts"), F.max("_rparts").alias("_rparts"))

    def salted(side: DataFrame, key: str, own: str, other: str) -> DataFrame:
        marked = side.join(F.broadcast(hot), _PLACE, "left")
        split = F.pmod(F.xxhash64(key), F.coalesce(f"{own}parts", F.lit(1))).cast("int")
        copies = F.sequence(F.lit(0), F.coalesce(f"{other}parts", F.lit(1)) - 1)
        spread = marked.withColumn(f"{own}salt", split).withColumn(f"{other}salt", F.explode(copies)).drop("_lparts", "_rparts")
        bucket = F.pmod(F.xxhash64(*_PLACE, "_lsalt", "_rsalt"), F.lit(buckets)).cast("int")
        return spread.select("*", bucket.alias("_bucket"), "_cell.cx", "_cell.cy").drop("_cell")

    place = ("_meet", "_level", "cx", "cy", "_lsalt", "_rsalt")

    def found(left: _Rows, right: _Rows, boxes: shapes.Boxes) -> Iterator[pa.RecordBatch]:
        own, other = (np.stack([rows.numbers(c) for c in place], 1) for rows in (left, right))

        def allowed(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            width = cell * float(grid.STEP) ** own[i, 1]
            home = [np.floor(np.maximum(left.box[k][i], right.box[k][j]) / width) for k in (0, 1)]
            return (own[i] == other[j]).all(1) & (home[0] == own[i, 2]) & (home[1] == own[i, 3])

        for out in _found(left, right, boxes, want, allowed):
            yield pa.RecordBatch.from_arrays(out, names=names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by bucket, the right ones of each first."""
        held: list[pa.RecordBatch] = []
        right, boxes = None, None
        for bucket, is_left, rows in _stretches(batches):
            if not is_left:
                if right is not None or (held and held[0].column("_bucket")[0].as_py() != bucket):
                    held, right, boxes = [], None, None
                held.append(rows)
            elif held and held[0].column("_bucket")[0].as_py() == bucket:
                if right is None:
                    right = _Rows(pa.Table.from_batches(held), "r")
                    boxes = shapes.Boxes(*right.box)
                yield from found(_Rows(rows, "l"), right, boxes)

    both = salted(lhs, "_lid", "_l", "_r").withColumn("_left", F.lit(True)).unionByName(
        salted(rhs, "_rid", "_r", "_l").withColumn("_left", F.lit(False)), allowMissingColumns=True
    )
    return both.repartition(buckets, "_bucket").sortWithinPartitions("_bucket", "_left").mapInArrow(run, shape)


def _stretches(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
    """Slices of one bucket and side each."""
    for batch in batches:
        bucket, left = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_bucket", "_left"))
        cuts = np.flatnonzero((bucket[1:] != bucket[:-1]) | (left[1:] != left[:-1])) + 1
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(bucket)]):
            if low < high:
                yield int(bucket[low]), bool(left[low]), batch.slice(low, high - low)


def spatial_join(left: DataFrame, right: DataFrame, left_id: str, right_id: str, left_geom: str = "geom",
                 right_geom: str = "geom", cell: float = 0.05, within: bool = False,
                 hot_rows: int = HOT_ROWS, sent: int = SENT) -> DataFrame:
    """Pairs (``left_id``, ``right_id``) whose geometries intersect, each once.

    With ``within`` the left geometry is a point that must lie strictly inside. Ids must be unique on their side. A
    right side of at most ``sent`` vertices and rows, which are counted first, goes to every task; else both are dealt
    out by cells ``cell`` wide, and cells with more than ``hot_rows`` rows of a side are split.
    """
    return _joined(left, right, left_id, right_id, left_geom, right_geom, cell, _WITHIN if within else _MEETS, hot_rows, sent)


def area_keys(geometries: DataFrame, areas: DataFrame, key: str = "task_key", area_key: str = "area_key",
              cell: float = 0.05, sent: int = SENT) -> DataFrame:
    """For every item with a geometry the sorted keys of the areas it meets, NULL when it meets none.

    There is one geometry for each item. Where the areas go to every task, the keys are gathered there and not shuffled.
    """
    rhs = _boxed(areas, area_key, "geom", "r")
    if (rhs.agg(F.sum(_weight("r"))).first()[0] or 0) > sent:
        pairs = spatial_join(geometries, areas, key, area_key, cell=cell, sent=-1)
        gathered = pairs.groupBy(key).agg(F.array_sort(F.collect_set(area_key)).alias("area_keys"))
        return geometries.select(key).join(gathered, key, "left")
    shared = geometries.sparkSession.sparkContext.broadcast(rhs.toArrow())
    lhs = geometries.select(F.col(key).alias("_lid"), F.col("geom").alias("_lg"), g.bbox(F.col("geom")).alias("_lb"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right = _Rows(shared.value, "r")
        boxes, names = shapes.Boxes(*right.box), _Names(right.array("_rid"))
        for batch in batches:
            for low in range(0, batch.num_rows, GATHERED):
                for rows, lists in _gathered(batch.slice(low, GATHERED), right, boxes, names):
                    yield pa.RecordBatch.from_arrays([rows.column("_lid"), lists], names=["k", "keys"])

    types = lhs.schema["_lid"].dataType.simpleString(), rhs.schema["_rid"].dataType.simpleString()
    return lhs.mapInArrow(run, f"k {types[0]}, keys array<{types[1]}>").toDF(key, "area_keys")


def placed_keys(rows: DataFrame, place: str, areas: DataFrame, key: str, area_key: str = "area_key",
                cell: float = 0.05, sent: int = SENT) -> DataFrame:
    """``rows`` with ``area_keys``, as ``area_keys`` gives them for the geometry ``place``, in its stead.

    Rows with one ``key`` have one place; those without either have no keys. Where the areas go to every task, the keys
    are added there, so they are in no shuffle of this step.
    """
    others = [c for c in rows.columns if c != place]
    rhs = _boxed(areas, area_key, "geom", "r")
    if (rhs.agg(F.sum(_weight("r"))).first()[0] or 0) > sent:
        once = rows.filter(F.col(place).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("_placed"), F.col(place).alias("geom"))
        found = area_keys(once.dropDuplicates(["_placed"]), areas, "_placed", area_key, cell=cell, sent=sent)
        return rows.join(found, F.col(key) == F.col("_placed"), "left").select(*others, "area_keys")
    shared = rows.sparkSession.sparkContext.broadcast(rhs.toArrow())
    lhs = rows.select(*others, F.col(key).alias("_lid"), F.col(place).alias("_lg"), g.bbox(F.col(place)).alias("_lb"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right = _Rows(shared.value, "r")
        boxes, names = shapes.Boxes(*right.box), _Names(right.array("_rid"))
        for batch in batches:
            for low in range(0, batch.num_rows, GATHERED):
                for some, lists in _gathered(batch.slice(low, GATHERED), right, boxes, names):
                    yield pa.RecordBatch.from_arrays([*some.columns[: len(others)], lists], names=[*others, "area_keys"])

    return lhs.mapInArrow(run, rows.select(*others).schema.add("area_keys", ArrayType(rhs.schema["_rid"].dataType)))


class _Names:
    """Ids that are not NULL, each once and sorted, and the place there of each row's."""

    def __init__(self, ids: pa.Array):
        once = pc.drop_null(pc.unique(ids))
        self.sorted = once.take(pc.sort_indices(once))
        self.place = pc.fill_null(pc.index_in(ids, value_set=self.sorted), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _gathered(batch: pa.RecordBatch, right: _Rows, boxes: shapes.Boxes, names: _Names) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """The sorted ids that each row meets, NULL where there are none or the row has no id, for slices of the rows in their order."""
    left, count = _Rows(batch, "l"), len(names.sorted)
    named = left.array("_lid").is_valid().to_numpy(zero_copy_only=False)
    keys, pairs = [np.zeros(0, np.int64)], 0
    for i, j in boxes.candidates(*left.box):
        hit = _hits(left, right, i, j, _MEETS, i) & named[i] & (names.place[j] >= 0)
        keys.append(i[hit] * count + names.place[j[hit]])
        pairs += len(keys[-1])
        if pairs > GATHERED_PAIRS and batch.num_rows > 1:
            half = batch.num_rows // 2
            yield from _gathered(batch.slice(0, half), right, boxes, names)
            yield from _gathered(batch.slice(half), right, boxes, names)
            return
    met = np.unique(np.concatenate(keys))
    counts = np.bincount(met // max(count, 1), minlength=batch.num_rows)
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    values = names.sorted.take(pa.array(met % max(count, 1)))
    yield batch, pa.ListArray.from_arrays(pa.array(offsets), values, mask=pa.array(counts == 0))


def points_within(points: DataFrame, polygons: DataFrame, point_id: str, polygon_id: str,
                  cell: float = 0.05) -> DataFrame:
    """Points strictly inside one of the polygons."""
    inside = spatial_join(points, polygons, point_id, polygon_id, cell=cell, within=True)
    return points.join(inside.select(point_id).distinct(), point_id, "left_semi")


def coverage(areas: DataFrame, districts: DataFrame, area_id: str, district_id: str,
             cell: float = 0.05, hot_rows: int = HOT_ROWS, sent: int = SENT) -> DataFrame:
    """Intersecting pairs with their common area, the area's own size, and whether its centroid is inside."""
    middle = g.centroid(F.col("geom"))
    sized = areas.select(area_id, "geom", g.area_sqm(F.col("geom")).alias("area_sqm"), middle.alias("_mid"))
    sized = sized.select(area_id, "geom", "area_sqm", F.col("_mid.x").alias("_mx"), F.col("_mid.y").alias("_my"))
    pairs = _joined(sized, districts, area_id, district_id, "geom", "geom", cell, _COVER, hot_rows, sent, ("area_sqm", "_mx", "_my"))
    return pairs.select(area_id, district_id, "area_sqm", "overlap_sqm", "centroid_within")


def best_cover(areas: DataFrame, districts: DataFrame, area_id: str, district_id: str,
               min_ratio: float = 0.999, cell: float = 0.05) -> DataFrame:
    """The district that covers each area best, NULL where none holds its centroid and enough of it."""
    good = coverage(areas, districts, area_id, district_id, cell).filter(
        F.col("centroid_within") & (F.col("overlap_sqm") >= F.col("area_sqm") * min_ratio)
    )
    best = good.groupBy(area_id).agg(
        F.max_by(district_id, F.struct("overlap_sqm", district_id)).alias(district_id)
    )
    return areas.select(area_id).join(best, area_id, "left")


def radius_search(points: DataFrame, lat: float, lng: float, radius_m: float) -> DataFrame:
    """Points within ``radius_m`` metres of a position, by box first and distance after.

    The box may cross the 180th meridian: longitudes are compared by their difference the short way round. Where the
    circle holds a pole, it has points of every longitude.
    """
    from math import asin, cos, degrees, radians, sin

    # A degree is nowhere shorter than 110 km on a meridian; the box errs on the large side.
    dy = radius_m / 110_000
    here = g.start_point(F.col("geom"))
    named = points.withColumns({"_x": here["x"], "_y": here["y"]})
    near = F.col("_y").between(lat - dy, lat + dy)
    if abs(lat) + dy < 90:
        # where the circle's edge runs along a meridian, on a sphere a little smaller than the earth
        widest = degrees(asin(min(1.0, sin(radians(dy)) / cos(radians(lat))))) * 1.01
        near = near & (F.abs(F.pmod(F.col("_x") - lng + 180, F.lit(360.0)) - 180) <= widest)
    boxed = named.filter(near)
    away = planar.distance_m(F.col("_x"), F.col("_y"), F.lit(float(lng)), F.lit(float(lat)))
    return boxed.withColumn("_away", away).filter(F.col("_away") <= radius_m).select(*points.columns)


def item_geometries(items: DataFrame, layers: DataFrame | None, by_id: list[tuple[DataFrame, str, str, str]]) -> DataFrame:
    """Every geometry an item can be found by: ``task_key``, ``geom``, ``prio``, ``source``, ``row_id``.

    ``layers`` are linked layer rows, if there are any. Each of ``by_id`` is a point table with ``id`` and ``geom``, its
    business-id column, the item column holding that id, and the table's name for anchors.
    """
    ways = []
    if layers is not None:
        prio = F.when(F.col("layer") == "polygons", 2).when(F.col("layer") == "lines", 1).otherwise(0)
        ways.append(
            layers.filter(F.col("task_key").isNotNull() & ~g.is_empty(F.col("geom"))).select(
                "task_key", "geom", prio.alias("prio"), F.col("layer").alias("source"), F.col("id").alias("row_id")
            )
        )
    for table, business_id, item_id, name in by_id:
        rows = table.filter(~g.is_empty(F.col("geom"))).select(
            F.col("id").alias("row_id"), "geom", F.col(business_id).cast("string").alias("_bid")
        )
        named = rows.filter(F.trim("_bid") != "").join(
            items.filter(F.col(item_id).isNotNull()).select("key", F.col(item_id).alias("_bid")), "_bid"
        )
        anchored = rows.join(
            items.filter((F.col("source_table") == name) & F.col("source_row_id").isNotNull()).select(
                "key", F.col("source_row_id").alias("row_id")
            ),
            "row_id",
        )
        for part in (named, anchored):
            ways.append(
                part.select(
                    F.col("key").alias("task_key"), "geom", F.lit(0).alias("prio"), F.lit(name).alias("source"), "row_id"
                )
            )
    return reduce(DataFrame.unionByName, ways)


def best_geometry(found: DataFrame) -> DataFrame:
    """One geometry per item: polygon over line over point, then source and row id."""
    best = found.groupBy("task_key").agg(
        F.min_by(
            F.struct("geom", "prio", "source", "row_id"), F.struct(-F.col("prio"), F.col("source"), F.col("row_id"))
        ).alias("_best")
    )
    return best.select("task_key", "_best.*")
