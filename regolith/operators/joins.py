"""Joins of pairs, images, statistics and lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regolith.functions import geometry, ids
from regolith.session import stage


def pairs_with(pairs: DataFrame, images: DataFrame, left: str = "l_image", right: str = "r_image", key: str = "image") -> DataFrame:
    """Pairs both of whose images are in ``images``."""
    good = images.select(F.col(key).alias("__k"))
    return pairs.join(good, F.col(left) == F.col("__k"), "left_semi").join(good, F.col(right) == F.col("__k"), "left_semi")


def drop_pairs_touching(pairs: DataFrame, listed: DataFrame, left: str, right: str, key: str) -> DataFrame:
    """Pairs neither of whose sides is listed."""
    bad = listed.select(F.col(key).alias("__k")).filter("__k IS NOT NULL")
    return pairs.join(bad, F.col(left) == F.col("__k"), "left_anti").join(bad, F.col(right) == F.col("__k"), "left_anti")


keep_pairs_within = pairs_with


def stereo_pair_join(convergence: DataFrame, component: DataFrame, matches: DataFrame, residuals: DataFrame) -> DataFrame:
    """(l_image, r_image, num, p75, l_median, r_median): convergence and matches of the same pair, both images in the
    component and with residuals; ends in canonical order; distinct."""
    inside = pairs_with(convergence, component)
    both = inside.join(matches.select("l_image", "r_image", "num"), ["l_image", "r_image"])
    left = residuals.select(F.col("image").alias("l_image"), F.col("median").alias("l_median"))
    right = residuals.select(F.col("image").alias("r_image"), F.col("median").alias("r_median"))
    whole = both.join(left, "l_image").join(right, "r_image")
    first, second = ids.canonical_pair(F.col("l_image"), F.col("r_image"))
    return whole.select(first.alias("l_image"), second.alias("r_image"), "num", "p75", "l_median", "r_median").distinct()


def _grams(rows: DataFrame, column: str, lengths: Column) -> DataFrame:
    """Rows with the distinct runs (``key``) of the column that have one of the lengths."""
    each = rows.withColumn("__n", F.explode(lengths)).filter(F.length(column) >= F.col("__n"))
    each = each.withColumn("__at", F.explode(F.sequence(F.lit(1), F.length(column) - F.col("__n") + 1)))
    return each.select(*rows.columns, F.substr(F.col(column), F.col("__at"), F.col("__n")).alias("key")).distinct()


def _may_contain(texts: DataFrame, parts: DataFrame, text: str, part: str, gram: int) -> DataFrame:
    """(text, part) of the distinct texts that hold the part's rarest run of ``gram`` characters (a shorter part: all of it)."""
    known = parts.select(F.col(part).cast("string").alias("part")).filter("part <> ''").distinct()
    size = F.least(F.length("part"), F.lit(gram))
    runs = stage(_grams(known, "part", F.array(size)), "part_runs")
    lengths = [r[0] for r in runs.select(F.length("key")).distinct().collect()]  # at most ``gram``
    whole = texts.select(F.col(text).cast("string").alias("text")).filter("text IS NOT NULL").distinct()
    met = _grams(whole, "text", F.array(*map(F.lit, lengths)) if lengths else F.array().cast("array<int>"))
    met = stage(met.join(runs.select("key").distinct(), "key", "left_semi"), "text_runs")
    counts = met.groupBy("key").agg(F.count(F.lit(1)).alias("texts"))
    # a part with a run that no text has is in none
    rarest = runs.join(counts, "key", "left").groupBy("part").agg(F.min(F.struct(F.coalesce("texts", F.lit(0)).alias("texts"), "key")).alias("r")).filter("r.texts > 0")
    return met.join(rarest.select("part", F.col("r.key").alias("key")), "key").select("text", "part")


def containing(texts: DataFrame, parts: DataFrame, text: str, part: str, gram: int = 8) -> DataFrame:
    """(text, part) of the distinct texts that hold a part somewhere in them, by an equi-join.

    A part's key is that of its runs of ``gram`` characters which the fewest texts have, or the whole of a shorter part, for which
    the key is the answer. Only texts with the key are tested in full, so a short part adds no more than its own hits,
    and a beginning that many parts share is nobody's key. Texts are cut into runs of those lengths that keys have, and runs
    that are no part's are left out before anything is counted. Null and empty parts are in no text; null texts hold none.
    """
    return _may_contain(texts, parts, text, part, gram).filter(F.contains("text", "part"))


def substring_join(images: DataFrame, cameras: DataFrame, image: str = "image", camera: str = "camera") -> DataFrame:
    """Images whose text holds some camera's."""
    found = containing(images, cameras, image, camera).select(F.col("text").alias(image)).distinct()
    return images.join(found, image, "left_semi")


def pair_geometry_join(pairs: DataFrame, footprints: DataFrame, left: str = "l_id", right: str = "r_id") -> DataFrame:
    """Pairs of different observations with the common box (px0 ..) and its area, where there is one."""
    boxes = lambda p, k: footprints.select(F.col("product_id").alias(k), *[F.col(c).alias(p + c) for c in ("x0", "y0", "x1", "y1")])
    rows = pairs.join(boxes("l_", left), left).join(boxes("r_", right), right)
    rows = rows.filter((F.col(left) != F.col(right)) & (ids.observation_id(F.col(left)) != ids.observation_id(F.col(right))))
    common = geometry.box_intersection([F.col("l_" + c) for c in ("x0", "y0", "x1", "y1")], [F.col("r_" + c) for c in ("x0", "y0", "x1", "y1")])
    rows = rows.withColumns(dict(zip(("px0", "py0", "px1", "py1"), common, strict=True)))
    return rows.withColumn("pair_area", geometry.box_area(*common)).filter("pair_area > 0")


def replace_footprints(db: DataFrame, footprints: DataFrame, key: str = "product_id", columns: tuple[str, ...] = ("x0", "y0", "x1", "y1")) -> DataFrame:
    """Rows with a new footprint, by the id in the footprint's file name."""
    new = footprints.select(ids.filename_to_pid(F.col("location")).alias(key), *columns)
    return db.drop(*columns).join(new, key)


def keep_component(db: DataFrame, components: DataFrame, index: int, key: str = "product_id") -> DataFrame:
    return db.join(components.filter(F.col("component_rank") == index).select(F.col("id").alias("__k")), F.col(key) == F.col("__k"), "left_semi")


def exclude_ids(db: DataFrame, listed: DataFrame, key: str = "product_id", value: str = "value") -> DataFrame:
    bad = listed.select(ids.filename_to_pid(F.col(value)).alias("__k"))
    return db.join(bad, F.col(key) == F.col("__k"), "left_anti")


def missed_ids(db: DataFrame, pairs: DataFrame, left: str, right: str, key: str = "product_id") -> DataFrame:
    used = pairs.select(F.col(left).alias(key)).union(pairs.select(F.col(right).alias(key)))
    return db.select(key).distinct().join(used, key, "left_anti")


def substitute_camera(images: DataFrame, registered: DataFrame, default: Column, better: Column, key: str = "product_id") -> DataFrame:
    """(pos, camera): the registered camera where the id is registered, else the default one."""
    known = registered.select(key).distinct().withColumn("__r", F.lit(True))
    return images.join(known, key, "left").select("pos", key, F.when(F.col("__r"), better).otherwise(default).alias("camera")).orderBy("pos")


def positional_zip(a: DataFrame, b: DataFrame, pos: str = "pos") -> DataFrame:
    """Line n with line n; lists of other lengths are an error."""
    n, m = a.count(), b.count()
    if n != m:
        raise ValueError(f"the lists have {n} and {m} lines")
    return a.withColumnRenamed("value", "left").join(b.withColumnRenamed("value", "right"), pos)


def azimuth_lookup(listed: DataFrame, table: DataFrame) -> DataFrame:
    """Listed images with the table's last azimuth of their id; others are dropped."""
    last = table.withColumn("__id", ids.extract_pid(F.col("image"), strict=False))
    last = last.withColumn("__n", F.row_number().over(Window.partitionBy("__id").orderBy(F.desc("pos")))).filter("__n = 1").select("__id", "azimuth")
    return listed.withColumn("__id", ids.extract_pid(F.col("value"), strict=False)).join(last, "__id").drop("__id")


def camera_for_image(images: DataFrame, cameras: DataFrame, image: str = "value", camera: str = "camera", required: bool = False) -> DataFrame:
    """Each image with the camera whose path holds its id (the first by name), or null; an error if one is required.

    The id is the product id in the image's text, or its file name up to the first dot where there is none.
    """
    named = images.withColumn("__id", F.coalesce(ids.extract_pid(F.col(image), strict=False), ids.filename_to_pid(F.col(image))))
    best = containing(cameras, named, camera, "__id").groupBy(F.col("part").alias("__id")).agg(F.min("text").alias(camera))
    out = named.join(best, "__id", "left").select(*images.columns, camera)
    if required and not out.filter(F.col(camera).isNull()).isEmpty():
        raise ValueError("an image has no camera")
    return out


def good_dems(files: DataFrame, diffs: DataFrame, errors: DataFrame, old: str, new: str) -> DataFrame:
    """Names of the files whose pair is in both tables, with ``old`` replaced by ``new``."""
    keyed = files.withColumn("__k", ids.pair_key(F.col("file")))
    for other in (diffs, errors):
        keyed = keyed.join(other.select(ids.pair_key(F.col("file")).alias("__k")).filter("__k IS NOT NULL"), "__k", "left_semi")
    return keyed.select(F.replace("file", F.lit(old), F.lit(new)).alias("file"))


def filter_gcp(points: DataFrame, images: DataFrame) -> DataFrame:
    """Control points with only the listed images' groups, in order; points without any are dropped."""
    each = points.select("*", F.posexplode("images").alias("__at", "__g")).withColumn("__name", ids.basename(F.col("__g.img")))
    kept = each.join(images.select(ids.basename(F.col("value")).alias("__name")).distinct(), "__name", "left_semi")
    groups = kept.groupBy("pos").agg(F.transform(F.array_sort(F.collect_list(F.struct("__at", "__g"))), lambda x: x["__g"]).alias("images"))
    return points.drop("images").join(groups, "pos")


def transform_gcp(points: DataFrame, disparity: DataFrame, max_disparity: float = 30, search: int = 3) -> DataFrame:
    """Points (id, px, py) moved by the disparity (x, y, dx, dy, valid) of the nearest valid cell within ``search`` cells.

    Ties go to the smaller offset in y, then x; points moved by more than ``max_disparity`` are dropped.
    """
    near = [(i, j) for i in range(-search, search + 1) for j in range(-search, search + 1)]
    around = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in near]))
    asked = points.withColumn("__o", around).withColumns({"x": (F.round("px") + F.col("__o.i")).cast("int"), "y": (F.round("py") + F.col("__o.j")).cast("int")})
    found = asked.join(disparity.filter("valid = 1").select("x", "y", "dx", "dy"), ["x", "y"])
    order = F.struct((F.col("__o.i") * F.col("__o.i") + F.col("__o.j") * F.col("__o.j")).alias("d"), F.col("__o.j"), F.col("__o.i"))
    best = found.groupBy("id", "px", "py").agg(F.min_by(F.struct("dx", "dy"), order).alias("m"))
    return best.filter(F.hypot("m.dx", "m.dy") <= max_disparity).select("id", (F.col("px") + F.col("m.dx")).alias("px"), (F.col("py") + F.col("m.dy")).alias("py"))
