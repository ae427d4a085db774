"""Points in outlines that come as a table: concave or convex, any number of them, with priorities.

The plane is covered by grids whose cells grow by LEVEL_STEP powers of two. An outline lies in
the cells of the one grid in which it is a few cells wide, and a point in one cell of every
grid that outlines use; so points find outlines by an equi-join on (level, cell), and an
even-odd test over the outline's edges settles the rest. Points are neither copied nor grouped
again: for each grid in use they meet at most one row, the list of the cell's outlines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A grid's cells are this power of two larger than those of the grid below it.
LEVEL_STEP = 2
#: An outline is at most this many cells wide, and more than this many over 2 ** LEVEL_STEP, beyond the least level.
WIDTH_CELLS = 16
#: The finest grid has cells of 2 ** LEAST_LEVEL units.
LEAST_LEVEL = -30


def _size(level: Column) -> Column:
    return F.pow(F.lit(2.0), level)


def outline_cells(outlines: DataFrame, label: str = "name") -> DataFrame:
    """(level, cx, cy, outline): the cells of each outline of ``(priority, <label>, vertices)``.

    Outlines of fewer than three vertices, or with a null or non-finite one, hold nothing and have no cells.
    """
    xs, ys = F.transform("vertices", lambda v: v["x"]), F.transform("vertices", lambda v: v["y"])
    whole = F.forall("vertices", lambda v: v["x"].isNotNull() & v["y"].isNotNull() & (F.abs(v["x"]) < float("inf")) & (F.abs(v["y"]) < float("inf")))
    boxes = outlines.filter((F.size("vertices") > 2) & whole).select(
        F.struct("priority", F.col(label).alias("name"), "vertices").alias("outline"),
        F.array_min(xs).alias("x0"),
        F.array_max(xs).alias("x1"),
        F.array_min(ys).alias("y0"),
        F.array_max(ys).alias("y1"),
    )
    width = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    steps = F.ceil(F.log2(F.greatest(width, F.lit(2.0**LEAST_LEVEL)) / WIDTH_CELLS) / LEVEL_STEP)
    boxes = boxes.withColumn("level", F.greatest(steps * LEVEL_STEP, F.lit(LEAST_LEVEL)).cast("int"))
    size = _size(F.col("level"))

    def cells(low: str, high: str) -> Column:
        return F.sequence(F.floor(F.col(low) / size), F.floor(F.col(high) / size))

    across = boxes.withColumn("cx", F.explode(cells("x0", "x1")))
    return across.select("level", "cx", F.explode(cells("y0", "y1")).alias("cy"), "outline")


def holds(x: Column, y: Column, vertices: Column) -> Column:
    """Whether the even-odd rule puts a point strictly inside; points on an edge are outside."""
    following = F.concat(F.slice(vertices, F.lit(2), F.size(vertices)), F.slice(vertices, 1, 1))
    edges = F.arrays_zip(vertices.alias("a"), following.alias("b"))

    def crosses(e: Column) -> Column:
        """1 for an edge to the right of the point that a line to the right crosses."""
        (ax, ay), (bx, by) = _ends(e)
        at = (bx - ax) * (y - ay) / F.when(by != ay, by - ay) + ax
        return F.when(((ay > y) != (by > y)) & (x < at), 1).otherwise(0)

    def touches(e: Column) -> Column:
        (ax, ay), (bx, by) = _ends(e)
        on_line = (x - ax) * (by - ay) == (y - ay) * (bx - ax)
        return on_line & x.between(F.least(ax, bx), F.greatest(ax, bx)) & y.between(F.least(ay, by), F.greatest(ay, by))

    odd = F.aggregate(edges, F.lit(0), lambda n, e: n + crosses(e)) % 2 == 1
    return odd & ~F.exists(edges, touches)


def _ends(edge: Column) -> tuple[tuple[Column, Column], tuple[Column, Column]]:
    a, b = edge["a"], edge["b"]
    return (a["x"], a["y"]), (b["x"], b["y"])


def grids(cells: DataFrame) -> list[int]:
    """The levels that outlines use: a few, by their sizes alone."""
    return sorted(r[0] for r in cells.select("level").distinct().collect())


def with_place(points: DataFrame, outlines: DataFrame, name: str, x: str = "lon", y: str = "lat") -> DataFrame:
    """Adds column ``name``, that of the outline that holds each point, else null: of several that of least priority, then name.

    ``outlines`` has ``(priority, <name>, vertices)``. A point with a null or non-finite coordinate lies nowhere.
    The outlines of one cell are one row and are tried one after the other.
    """
    covered, out, best = outline_cells(outlines, name), points, []
    for i, level in enumerate(grids(covered)):
        here = covered.filter(F.col("level") == level).groupBy(F.col("cx").alias(f"__cx{i}"), F.col("cy").alias(f"__cy{i}"))
        here = here.agg(F.array_sort(F.collect_list("outline")).alias(f"__outlines{i}"))
        for axis, c in (("x", x), ("y", y)):
            finite = F.abs(F.col(c)) < float("inf")
            out = out.withColumn(f"__c{axis}{i}", F.when(finite, F.floor(F.col(c) / 2.0**level)))
        out = out.join(here, [f"__cx{i}", f"__cy{i}"], "left")
        inside = F.filter(f"__outlines{i}", lambda o: holds(F.col(x), F.col(y), o["vertices"]))
        first = F.get(inside, F.lit(0))
        best.append(F.when(first.isNotNull(), F.struct(first["priority"].alias("priority"), first["name"].alias("name"))))
    found = F.array_min(F.array(*best))["name"] if best else F.lit(None).cast("string")
    return out.select(*[c for c in points.columns if c != name], found.alias(name))
