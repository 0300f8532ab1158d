"""Joins of boxes on a page. Page and tile are equality keys; the exact condition is the residual one.

Boxes have page, id and a rectangle ``box``; regions and panels likewise. Boxes that meet have a tile of a grid in
common, so a page's boxes are compared only with those nearby; of the tiles that a pair has in common the one with the
first corner of what both cover counts. Where a box looks along one direction, the grid has strips across it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import text as T
from . import joins


#: Side of a tile, and height or width of a strip, in points. Any size gives the same rows; boxes should cover few tiles.
TILE, STRIP = 50.0, 16.0
#: Side of a tile for rectangles of 250 points and more: most of them cover two or three.
WIDE_TILE = 250.0


def _tile(c: Column, size: float) -> Column:
    return F.floor(c / F.lit(size)).cast("long")


def _cut(low: Column, high: Column, size: float) -> Column:
    """The tiles from one coordinate to another; one for a range that is turned round."""
    return F.sequence(_tile(low, size), F.greatest(_tile(low, size), _tile(high, size)))


def _tiled(boxes: DataFrame, box: str, tag: str, size: float) -> DataFrame:
    """A row for each tile that a box covers, in ``tag``_tx and ``tag``_ty."""
    sides = [F.col(f"{box}.{n}") for n in ("x0", "x1", "y0", "y1")]
    wide = boxes.select("*", F.explode(_cut(*sides[:2], size)).alias(f"{tag}_tx"))
    return wide.select("*", F.explode(_cut(*sides[2:], size)).alias(f"{tag}_ty"))


def _meeting(boxes: DataFrame, other: DataFrame, tag: str, size: float = TILE) -> DataFrame:
    """Every pair of a box and one of ``other`` (columns named by ``tag``) of its page that intersect, once."""
    a, b = _tiled(boxes, "box", "a", size), _tiled(other, f"{tag}_box", tag, size)
    box, against = F.col("box"), F.col(f"{tag}_box")
    first = (F.col("a_tx") == _tile(F.greatest(box.getField("x0"), against.getField("x0")), size)) & (F.col("a_ty") == _tile(F.greatest(box.getField("y0"), against.getField("y0")), size))
    near = (F.col("page") == F.col(f"{tag}_page")) & (F.col("a_tx") == F.col(f"{tag}_tx")) & (F.col("a_ty") == F.col(f"{tag}_ty"))
    return a.join(b, near & first & G.intersects(box, against)).drop("a_tx", "a_ty", f"{tag}_tx", f"{tag}_ty")


def _other(boxes: DataFrame, tag: str = "o") -> DataFrame:
    return boxes.select(*[F.col(c).alias(f"{tag}_{c}") for c in boxes.columns])


def panels(boxes: DataFrame, slack: float = 30.0) -> DataFrame:
    """(page, box): the hull of each page's stat boxes, grown on all sides."""
    return boxes.filter(F.col("type").isin("stat", "stat_h")).groupBy("page").agg(G.hull(F.col("box")).alias("hull")).select("page", G.grown(F.col("hull"), slack).alias("box"))


def inside(boxes: DataFrame, hulls: DataFrame) -> DataFrame:
    """Boxes whose centre lies in a hull of their page."""
    h = _tiled(_other(hulls, "h"), "h_box", "h", TILE)
    x, y = G.centre(F.col("box"))
    here = (F.col("page") == F.col("h_page")) & (_tile(x, TILE) == F.col("h_tx")) & (_tile(y, TILE) == F.col("h_ty"))
    return boxes.join(h, here & G.contains_point(F.col("h_box"), x, y), "left_semi")


def panel_order(boxes: DataFrame) -> DataFrame:
    """Boxes with their place in reading order: rows of forty pixels, then left to right."""
    w = Window.partitionBy("page").orderBy(F.bround(F.col("box.y0") / 40), F.col("box.x0"), "id")
    return boxes.withColumn("place", F.row_number().over(w))


def outside_regions(boxes: DataFrame, regions: DataFrame, share: float = 0.5) -> DataFrame:
    """Boxes that no region covers by more than ``share``; ids are unique on a page."""
    met = _meeting(boxes.select("page", "id", "box"), _other(regions, "r"), "r")
    covered = met.filter(G.area(G.intersection(F.col("box"), F.col("r_box"))) > G.area(F.col("box")) * share).select(F.col("page").alias("_page"), F.col("id").alias("_id")).distinct()
    return boxes.join(covered, F.col("page").eqNullSafe(F.col("_page")) & F.col("id").eqNullSafe(F.col("_id")), "left_anti")


def touching(boxes: DataFrame, regions: DataFrame) -> DataFrame:
    """(box, region) pairs of a page that intersect."""
    return _meeting(boxes, _other(regions, "r"), "r")


def table_regions(rects: DataFrame, cells: DataFrame, least: int = 25, share: float = 0.3) -> DataFrame:
    """Large rectangles with enough words of which enough are numbers; of those that overlap, the first of a page stays.

    The choice among overlapping ones follows their order on the page, a fold over the few of each page.
    """
    sized = rects.filter(G.width(F.col("box")).between(250.0001, 569.9999) & G.height(F.col("box")).between(90.0001, 719.9999) & (F.col("box.y0") > 30))
    marked = cells.select("page", "box", F.coalesce(T.is_numeric_cell(F.col("text")), F.lit(False)).alias("number"))  # texts aren't moved
    held = _meeting(sized.select("page", "id", "box"), _other(marked, "w"), "w", WIDE_TILE)
    counted = held.groupBy("page", "id", "box").agg(F.count("*").alias("n"), F.count_if("w_number").alias("numbers")).filter((F.col("n") >= least) & (F.col("numbers") >= F.col("n") * share))
    pages = counted.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("id", "box"))).alias("all"))
    none = F.filter("all", lambda r: F.lit(False))
    kept = F.aggregate("all", none, lambda done, r: F.when(F.exists(done, lambda d: G.intersects(d.getField("box"), r.getField("box"))), done).otherwise(F.concat(done, F.array(r))))
    return pages.select("page", F.explode(kept).alias("r")).select("page", "r.id", "r.box")


def nearest_column(cells: DataFrame, centres: DataFrame, margin: float = 15.0) -> DataFrame:
    """Words with the number of the nearest column centre; -1 left of the first centre by more than ``margin``.

    ``centres`` has region, column and x; words have region and a unique id. Of equally near centres the first holds.
    Words and centres of a region stand in one order, in which the nearest centre is the last one before or the first
    one after a word.
    """
    x = G.centre(F.col("box"))[0]
    kind = centres.schema["column"].dataType
    word = cells.select("region", "id", x.alias("x"), F.lit(None).cast(kind).alias("column"), F.lit(1).alias("word"))
    centre = centres.filter("x IS NOT NULL").groupBy("region", F.col("x").cast("double").alias("x")).agg(F.min("column").alias("column")).select("region", F.lit(None).cast(cells.schema["id"].dataType).alias("id"), "x", "column", F.lit(0).alias("word"))
    held = joins.dealt(word.unionByName(centre), "region").withColumn("c", F.when(F.col("word") == 0, F.struct("x", "column")))
    region = Window.partitionBy("region")
    upto = region.orderBy("x", "word").rowsBetween(Window.unboundedPreceding, 0)
    after = region.orderBy(F.desc("x"), F.desc("word")).rowsBetween(Window.unboundedPreceding, -1)
    both = held.select("region", "id", "x", "word", F.last("c", True).over(upto).alias("left"), F.last("c", True).over(after).alias("right"), F.min("c.x").over(region).alias("least"))
    nearer = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.abs(F.col("x") - F.col(f"{c}.x")).alias("d"), F.col(f"{c}.column").alias("column")))
    best = both.filter("word = 1 AND least IS NOT NULL").select("region", "id", "x", F.least(nearer("left"), nearer("right")).alias("best"), "least")
    return best.select("region", "id", F.when(F.col("x") < F.col("least") - margin, F.lit(-1).cast(kind)).otherwise(F.col("best.column")).alias("column"))


def right_limit(boxes: DataFrame, page_right: float) -> DataFrame:
    """(page, id, limit): how far a box may grow to the right before a neighbour, the text column or the page's edge.

    The column ends at the furthest right side of boxes of several lines, or of all if there are none.
    """
    edge = boxes.groupBy(F.col("page").alias("e_page")).agg(F.coalesce(F.max(F.when(F.col("lines") > 1, F.col("box.x1"))), F.max("box.x1")).alias("edge"))
    one = boxes.select("page", "id", "box")
    strip = lambda df, box, tag: df.select("*", F.explode_outer(_cut(F.col(f"{box}.y0"), F.col(f"{box}.y1"), STRIP)).alias(tag))
    one, o = strip(one, "box", "strip"), strip(_other(one), "o_box", "o_strip")
    near = (F.col("page") == F.col("o_page")) & (F.col("strip") == F.col("o_strip")) & (F.col("id") != F.col("o_id")) & (F.col("o_box.x0") >= F.col("box.x1") - 1) & (F.col("o_box.y1") >= F.col("box.y0")) & (F.col("o_box.y0") <= F.col("box.y1"))
    free = one.join(o, near, "left").groupBy("page", "id", F.col("box.x1").alias("x1")).agg(F.min(F.col("o_box.x0") - 4).alias("next"))
    return free.join(edge, F.col("page") == F.col("e_page")).select("page", "id", F.greatest("x1", F.least("edge", F.lit(page_right - 8), "next")).alias("limit"))


def space_below(boxes: DataFrame, page_height: float, most: float = 4.0) -> DataFrame:
    """(page, id, space): free height below a box, at most ``most``."""
    one = boxes.select("page", "id", "box")
    strip = lambda df, box, tag: df.select("*", F.explode_outer(_cut(F.col(f"{box}.x0"), F.col(f"{box}.x1"), STRIP)).alias(tag))
    one, o = strip(one, "box", "strip"), strip(_other(one), "o_box", "o_strip")
    near = (F.col("page") == F.col("o_page")) & (F.col("strip") == F.col("o_strip")) & (F.col("id") != F.col("o_id")) & (F.col("o_box.y0") >= F.col("box.y1") - 1) & (F.col("o_box.x1") >= F.col("box.x0")) & (F.col("o_box.x0") <= F.col("box.x1"))
    free = one.join(o, near, "left").groupBy("page", "id", F.col("box.y1").alias("y1")).agg(F.min(F.col("o_box.y0") - 2).alias("next"))
    return free.select("page", "id", F.greatest(F.lit(0.0), F.least(F.least("next", F.lit(page_height - 4)) - F.col("y1"), F.lit(most))).alias("space"))


def separated(left: DataFrame, separators: DataFrame, slack: float = 0.2) -> DataFrame:
    """Gaps (page, id, x0, x1) in which a separator of the page stands."""
    s = _other(separators, "s")
    return left.join(s, (F.col("page") == F.col("s_page")) & F.col("s_x").between(F.col("x0") - slack, F.col("x1") + slack), "left_semi")


def heading_above(hulls: DataFrame, boxes: DataFrame) -> DataFrame:
    """(page, title): the last heading, in reading order, that stands just above a hull."""
    b = _other(boxes.filter(F.col("type").isin("h1", "h2", "h_mayor")), "b")
    near = (F.col("page") == F.col("b_page")) & F.col("b_box.y1").between(F.col("box.y0") - 200, F.col("box.y0") + 60) & F.col("b_box.x0").between(F.col("box.x0") - 60, F.col("box.x1"))
    return hulls.join(b, near).groupBy("page").agg(F.max_by(F.trim("b_text"), F.col("b_place")).alias("title"))


def panel_sides(boxes: DataFrame) -> DataFrame:
    """(page, side, columns): both halves populated is one full panel of two columns, else one panel per side."""
    x = G.centre(F.col("box"))[0]
    half = F.col("page_width") / 2
    seen = boxes.filter(F.col("type").isin("stat", "stat_h")).groupBy("page").agg(F.min(x - half).alias("a"), F.max(x - half).alias("b"))
    side = F.when((F.col("a") < 0) & (F.col("b") > 0), F.array(F.lit("F"))).otherwise(F.array_compact(F.array(F.when(F.col("a") < 0, "L"), F.when(F.col("b") >= 0, "R"))))
    return seen.select("page", F.explode(side).alias("side")).withColumn("columns", F.when(F.col("side") == "F", 2).otherwise(1))


def dominant_style(rects: DataFrame, spans: DataFrame) -> DataFrame:
    """(page, id, size, color, bold, serif): the style of the longest span under a rectangle, the first of equals; or a default."""
    s = _other(spans, "s")
    under = rects.join(s, (F.col("page") == F.col("s_page")) & G.intersects(F.col("box"), F.col("s_box")) & (F.trim("s_text") != ""), "left")
    best = under.groupBy("page", "id").agg(F.max(F.when(F.col("s_id").isNotNull(), F.struct(F.length("s_text").alias("n"), (-F.col("s_place")).alias("first"), F.col("s_size").alias("size"), F.col("s_color").alias("color"), F.col("s_bold").alias("bold"), F.col("s_serif").alias("serif")))).alias("b"))
    return best.select("page", "id", F.coalesce("b.size", F.lit(8.0)).alias("size"), F.coalesce("b.color", F.lit(0)).alias("color"), F.coalesce("b.bold", F.lit(False)).alias("bold"), F.coalesce("b.serif", F.lit(False)).alias("serif"))


def ordinals(cells: DataFrame, regions: DataFrame) -> DataFrame:
    """(page, id, text): English ordinals in table regions as Spanish ones."""
    from ..functions import fixed

    hit = cells.filter(F.col("text").rlike(T.rx(fixed.ORDINAL_CELL)))
    r = _other(regions, "r")
    found = hit.join(r, (F.col("page") == F.col("r_page")) & G.intersects(F.col("box"), F.col("r_box")), "left_semi")
    return found.select("page", "id", F.concat(F.regexp_extract("text", T.rx(fixed.ORDINAL_CELL), 1), F.lit(".º")).alias("text"))


def overlaps(boxes: DataFrame, least_width: float = 40.0, least_height: float = 12.0) -> DataFrame:
    """(page, a, b): boxes of a page that overlap by more than a minimum, not below 0, in both directions."""
    common = G.intersection(F.col("box"), F.col("o_box"))
    met = _meeting(boxes.select("page", "id", "box"), _other(boxes.select("page", "id", "box")), "o")
    return met.filter((F.col("id") < F.col("o_id")) & (G.width(common) > least_width) & (G.height(common) > least_height)).select("page", F.col("id").alias("a"), F.col("o_id").alias("b"))


def clip(boxes: DataFrame, fixed_boxes: DataFrame) -> DataFrame:
    """(page, id, box): boxes cut back from protected ones that they graze, one after the other in order of id.

    A protected box is grazed if the common height is at most 60 % of the lower of both; it then bounds the box from
    above or below. Boxes that contain it, or overlap it by more, stay.
    """
    p = fixed_boxes.groupBy(F.col("page").alias("p_page")).agg(F.array_sort(F.collect_list(F.struct("id", "box"))).alias("protected"))

    def step(e, item):
        r = item.getField("box")
        common = G.intersection(e, r)
        inside = (e.getField("x0") <= r.getField("x0")) & (e.getField("y0") <= r.getField("y0")) & (e.getField("x1") >= r.getField("x1")) & (e.getField("y1") >= r.getField("y1"))
        graze = G.intersects(e, r) & ~inside & (G.height(common) <= F.least(G.height(e), G.height(r)) * 0.6)
        middle = (e.getField("y0") + e.getField("y1")) / 2
        above, below = graze & (r.getField("y1") <= middle), graze & (r.getField("y0") >= middle)
        return F.struct(e.getField("x0").alias("x0"), F.when(above, F.greatest(e.getField("y0"), r.getField("y1") + 0.25)).otherwise(e.getField("y0")).alias("y0"), e.getField("x1").alias("x1"), F.when(below & ~above, F.least(e.getField("y1"), r.getField("y0") - 0.25)).otherwise(e.getField("y1")).alias("y1"))

    joined = boxes.join(p, F.col("page") == F.col("p_page"), "left")
    return joined.select("page", "id", F.when(F.col("protected").isNull(), F.col("box")).otherwise(F.aggregate("protected", F.col("box"), step)).alias("box"))


def page_texts(blocks: DataFrame, values: DataFrame, hulls: DataFrame) -> DataFrame:
    """(page, en, es): the texts of a page that a check compares.

    Source: blocks with a live translation, and absent ones that lie in a panel's hull or that a control extends over.
    Target: live values, in order of block. ``values`` has page, block, kind, t and ``extends`` (array of blocks).
    """
    v = values.select(F.col("page").alias("v_page"), F.col("block").alias("v_block"), "kind", "t")
    live = F.col("kind").isin("text", "control")
    own = blocks.join(v, (F.col("page") == F.col("v_page")) & (F.col("id") == F.col("v_block")), "left")
    extended = values.select(F.col("page").alias("x_page"), F.explode("extends").alias("x_block")).distinct()
    absent = own.filter(F.col("kind").isNull())
    taken = inside(absent, hulls).unionByName(absent.join(extended, (F.col("page") == F.col("x_page")) & (F.col("id") == F.col("x_block")), "left_semi")).dropDuplicates(["page", "id"])
    source = own.filter(live).unionByName(taken).groupBy("page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "text"))), lambda s: s.getField("text")), " ").alias("en"))
    target = values.filter(live & F.col("t").isNotNull()).groupBy(F.col("page").alias("t_page")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "t"))), lambda s: s.getField("t")), " ").alias("es"))
    return source.join(target, F.col("page") == F.col("t_page"), "full_outer").select(F.coalesce("page", "t_page").alias("page"), F.coalesce("en", F.lit("")).alias("en"), F.coalesce("es", F.lit("")).alias("es"))


def index_entries(words: DataFrame, middle: float = 300.0, top: float = 30.0, bottom: float = 810.0) -> DataFrame:
    """(page, column, line, title, number, x0, y0, x1, y1, limit): titles of an index page's lines.

    ``words``: page, text, x0, y0, x1, y1. Words of one column whose base lines fall into the same third-point bucket
    are a line; words that shadow layers repeat count once, and the title ends before the first leader dots or page
    number. A number glued to a title is taken off it. ``limit`` is the left edge of the first leader or number of the
    column to the right of the title's beginning and at its height; nulls: there is none.
    """
    from ..functions import fixed
    from .folds import drop_echoed_words, until_leader

    column = F.when(F.col("x0") < middle, 0).otherwise(1)
    inside = words.filter((F.col("y1") > top) & (F.col("y1") < bottom)).withColumn("column", column)
    line = F.bround(F.col("y1") / 3).cast("int")
    sides = ("x0", "y0", "x1", "y1")
    placed = inside.groupBy("page", "column", line.alias("line")).agg(F.array_sort(F.collect_list(F.struct(F.col("x0").alias("x"), "text", *sides))).alias("all"))
    kept = placed.withColumn("all", drop_echoed_words(F.col("all")))
    n = F.size(until_leader(F.transform("all", lambda w: w.getField("text"))))
    kept = kept.withColumn("own", F.when(n > 0, F.slice("all", F.lit(1), n))).filter("own is not null")
    text = F.regexp_replace(F.trim(F.array_join(F.transform("own", lambda w: w.getField("text")), " ")), T.rx(r"\s*\.+$"), "")
    edge = lambda s: (F.array_min if s.endswith("0") else F.array_max)(F.transform("own", lambda w: w.getField(s))).alias(s)
    titled = kept.select("page", "column", "line", text.alias("whole"), *[edge(s) for s in sides]).filter(F.col("whole").rlike("[A-Za-z]{2}"))
    glued = F.col("whole").rlike(T.rx(fixed.INDEX_GLUED))
    title = F.when(glued, F.regexp_replace(F.regexp_extract("whole", T.rx(fixed.INDEX_GLUED), 1), r"[ .]+$", "")).otherwise(F.col("whole"))
    titled = titled.select("page", "column", "line", title.alias("title"), F.when(glued, F.regexp_extract("whole", T.rx(fixed.INDEX_GLUED), 2)).alias("number"), *sides)
    stops = inside.filter(F.col("text").rlike(T.rx(fixed.INDEX_NUMBER))).select(F.col("page").alias("s_page"), F.col("column").alias("s_column"), *[F.col(s).alias(f"s_{s}") for s in sides])
    near = (F.col("page") == F.col("s_page")) & (F.col("column") == F.col("s_column")) & (F.col("s_x0") > F.col("x0") + 10) & (F.least("y1", "s_y1") - F.greatest("y0", "s_y0") > 3)
    own = ["page", "column", "line", "title", "number", *sides]
    return titled.join(stops, near, "left").groupBy(*own).agg(F.min("s_x0").alias("limit"))
