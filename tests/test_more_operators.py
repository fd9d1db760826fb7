"""Containment, selection, scans, covers, paths, orders, stripes and pruned mosaics against brute force on small inputs."""

import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from regolith.operators import coverage, graph, joins, lists, ordering, raster, windows


def strings(spark, values, name):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


# Containment.


def test_containing_is_brute_force(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abc") for _ in range(n))
    texts = [word(rng.randrange(0, 30)) for _ in range(120)] + ["éüé ß", None, ""]
    parts = [word(rng.randrange(1, 14)) for _ in range(80)] + ["é", "ü", None, "", "absent"]
    got = sorted((r.text, r.part) for r in joins.containing(strings(spark, texts, "t"), strings(spark, parts, "p"), "t", "p", 4).collect())
    want = sorted({(t, p) for t in texts for p in parts if t and p and p in t})
    assert got == want
    none = strings(spark, [], "p")
    assert joins.containing(strings(spark, texts, "t"), none, "t", "p").count() == 0


def test_one_short_part_adds_its_own_hits_only(spark):
    """10,000 long parts that share their first 12 letters, and one of two letters: what meets is not much more than what holds."""
    texts = [f"folder/common-start{i:05}-{'xy' if i % 50 == 0 else 'ab'}.json" for i in range(10_000)]
    parts = [f"common-start{i:05}" for i in range(10_000)] + ["xy"]
    t, p = strings(spark, texts, "t"), strings(spark, parts, "p")
    hits = joins.containing(t, p, "t", "p").count()
    assert hits == 10_000 + 200
    assert joins._may_contain(t, p, "t", "p", 8).count() <= 1.5 * hits


# Selection and scans.


@pytest.mark.parametrize("kind", ["ties", "spread", "wide", "one"])
def test_order_statistics(spark, kind):
    rng = np.random.default_rng(2)
    draw = {"ties": lambda n: rng.integers(0, 3, n) / 7, "spread": lambda n: rng.normal(0, 1, n), "wide": lambda n: rng.choice([-1, 1], n) * 10.0 ** rng.integers(-300, 300, n), "one": lambda n: np.full(n, -0.5)}[kind]
    groups = {g: draw(n) for g, n in (("a", 1), ("b", 2), ("c", 900), ("d", 5000))}
    if kind == "wide":
        groups["c"][:3] = [np.inf, -np.inf, 0.0]
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs], "g string, v double")
    targets = [(g, r) for g, vs in groups.items() for r in {0, len(vs) - 1, len(vs) // 2, len(vs) // 3}]
    got = {(r.g, r["rank"]): r.v for r in windows.order_statistics(df, spark.createDataFrame(targets, "g string, rank bigint")).collect()}
    assert got == {(g, r): float(np.sort(groups[g])[r]) for g, r in targets}


def test_quantiles(spark):
    rng = np.random.default_rng(5)
    values = [*rng.normal(0, 1, 400), *[0.25] * 3000]
    rows = [("x", float(v)) for v in values] + [("y", 1.0), ("y", None), ("y", float("nan")), ("z", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    assert windows.exact_quantiles(df.filter("g = 'x'"), "v", [0, 0.1, 0.5, 0.77, 1]) == pytest.approx(np.quantile(values, [0, 0.1, 0.5, 0.77, 1]).tolist(), abs=1e-12)
    got = {r.g: r.q for r in windows.group_quantile(df, "g", "v", 0.9, "q").collect()}
    assert got == {"x": pytest.approx(np.quantile(values, 0.9), abs=1e-12), "y": 1.0}
    assert windows.exact_quantiles(df.filter("g = 'z'"), "v", [0.5]) == [None]


def test_streaks_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(windows, "BLOCK", 4)
    rng = random.Random(1)
    flags = [f for f in (rng.random() < 0.5 for _ in range(40)) for _ in range(rng.choice([1, 2, 30]))]
    df = spark.createDataFrame(list(enumerate(flags, 1)), "orderid bigint, intersects_prior boolean").repartition(5)
    want = {}
    for f, run in itertools.groupby(flags):
        key = (f, len(list(run)))
        want[key] = want.get(key, 0) + 1
    assert {(r.intersects_prior, r.length): r.streaks for r in windows.streak_lengths(df).collect()} == want


def test_random_sample_has_the_least_hashes(spark):
    df = spark.range(3000).select("id", (F.col("id") % 7).alias("g"))
    for n in (0, 1, 40, 2990, 3000):
        got = sorted(r.id for r in lists.random_sample(df, n, 5).collect())
        want = df.withColumn("h", F.xxhash64(F.lit(5), "id", "g")).orderBy("h").limit(n)
        assert got == sorted(r.id for r in want.collect())
    same = spark.range(50).select(F.lit(1).alias("x"))
    assert lists.random_sample(same, 7).count() == 7


# Covers.


def greedy(left, least):
    """(id, gain) of one group; ``left`` is a set of (id, i, j)."""
    out = []
    while True:
        gains = {}
        for c in left:
            gains[c[0]] = gains.get(c[0], 0) + 1
        if not gains or max(gains.values()) < least:
            return out
        best = min(gains, key=lambda k: (-gains[k], k))
        out.append((best, float(gains[best])))
        gone = {c[1:] for c in left if c[0] == best}
        left = {c for c in left if c[1:] not in gone}


def test_cover_takes_few_passes(spark, monkeypatch):
    """Far more images than passes: those that share nothing are taken together, and the order is that of plain greedy."""
    rng = random.Random(6)
    cells = {(f"i{k:03}", 10 * (k // 3) + rng.randrange(6), rng.randrange(4)) for k in range(240) for _ in range(12)}
    staged = []
    monkeypatch.setattr(coverage, "stage", lambda df, name, f=coverage.stage: staged.append(name) or f(df, name))
    got = [(r.id, r.gain) for r in coverage.set_coverage(spark.createDataFrame([(*c, 1.0) for c in cells], "id string, i int, j int, w double"), 2).orderBy("round").collect()]
    want = greedy(cells, 2)
    assert got == want and len(want) > 150 and staged.count("chosen") <= 6


def images(spark, rng, rasters=9, side=12):
    return [(k, x, y, round(rng.random(), 2) if rng.random() < 0.5 else 0.0, k % 3) for k in range(rasters) for x in range(side) for y in range(side)]


def lit(rows, limit, group=None):
    return {(r[0], r[1], r[2]) for r in rows if r[3] >= limit and (group is None or r[4] == group)}


def test_image_subsets(spark):
    rows = images(spark, random.Random(7))
    df = spark.createDataFrame(rows, "raster_id int, x int, y int, v double, g int")
    got = [(r.id, r.gain) for r in coverage.image_subset(df, 0.3, (2, 2, 9, 9), 2.0).orderBy("round").collect()]
    assert got == greedy({c for c in lit(rows, 0.3) if 2 <= c[1] <= 9 and 2 <= c[2] <= 9}, 2)
    twice = coverage.image_subset_2x(df, 0.3, 2.0, "g").collect()
    for g in range(3):
        first = greedy(lit(rows, 0.3, g), 2)
        taken = {k for k, _ in first}
        second = greedy({c for c in lit(rows, 0.3, g) if c[0] not in taken}, 2)
        for n, want in ((1, first), (2, second)):
            assert [(r.id, r.gain) for r in sorted(twice, key=lambda r: r["round"]) if r["pass"] == n and r.g == g] == want


def test_full_site(spark):
    rng = random.Random(8)
    azimuths = [20.0, 40.0, 100.0, 120.0, 200.0, 300.0, 310.0, 330.0, 350.0]
    rows = images(spark, rng, 9, 16)
    df = spark.createDataFrame(rows, "raster_id int, x int, y int, v double, g int")
    table = spark.createDataFrame(list(enumerate(azimuths)), "raster_id int, azimuth double")
    got = coverage.select_full_site(df.drop("g"), table, 0.3, 4, 1.0).collect()
    low, high = np.median([a for a in azimuths if a < 180]), np.median([a for a in azimuths if a >= 270])
    group = lambda a: "mid" if 180 <= a < 270 else ("low1" if a <= low else "low2") if a < 180 else ("high1" if a <= high else "high2")
    small = {}
    for k, x, y, v, _ in rows:
        small.setdefault((k, x // 4, y // 4), []).append(v)
    cells = {c for c, vs in small.items() if sum(vs) / len(vs) >= 0.3}
    for g in {group(a) for a in azimuths}:
        own = {c for c in cells if group(azimuths[c[0]]) == g}
        first = greedy(own, 1)
        taken = {k for k, _ in first}
        for n, want in ((1, first), (2, greedy({c for c in own if c[0] not in taken}, 1))):
            assert [(r.id, r.gain) for r in sorted(got, key=lambda r: r["round"]) if r["pass"] == n and r.azimuth_group == g] == want


# Paths.


def test_shortest_path_is_the_least(spark):
    rng = random.Random(5)
    links = {(rng.randrange(60), rng.randrange(60)) for _ in range(75)}
    near = {}
    for a, b in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    df = spark.createDataFrame(sorted(links), "src bigint, dst bigint")

    def least(a, b):
        level = {a: [a]}
        seen = {a}
        while level and b not in level:
            grown = {}
            for v, path in level.items():
                for w in near.get(v, ()):
                    if w not in seen:
                        grown[w] = min(grown.get(w, [math.inf]), path + [w])
            seen |= set(grown)
            level = grown
        return level.get(b, [])

    ends = sorted(near)
    pairs = [(ends[0], ends[-1]), (ends[1], ends[-2]), (ends[3], ends[20])]
    lengths = set()
    for a, b in pairs:
        want = least(a, b)
        lengths.add(len(want))
        assert [r.id for r in graph.shortest_path(df, a, b).orderBy("step").collect()] == want
        if len(want) > 2:
            assert graph.shortest_path(df, a, b, len(want) - 2).count() == 0
            assert graph.shortest_path(df, a, b, len(want) - 1).count() == len(want)
    assert max(lengths) > 3
    assert [r.id for r in graph.shortest_path(df, 1000, 1000).collect()] == [1000] and graph.shortest_path(df, 1000, ends[0]).count() == 0


# Orders: the rules in words, one image after another.


def boxes(rng, n):
    out = []
    for i in range(n):
        x, y = rng.uniform(0, 9), rng.uniform(0, 9)
        out.append((f"p{i:02}", i % 2, round(rng.uniform(0, 360), 2), x, y, x + 3, y + 3))
    return out


def meets(a, b):
    return a[3] <= b[5] and b[3] <= a[5] and a[4] <= b[6] and b[4] <= a[6]


def weight(a, b):
    """Of a pair by ids: the difference of azimuths, twice its square if negative, and 100 more if the boxes don't meet."""
    a, b = sorted((a, b))
    d = a[2] - b[2]
    return (2 * d * d if d < 0 else d) + (0 if meets(a, b) else 100)


def order_by_weight(rows):
    rest = sorted(rows)
    out = [min(rest, key=lambda r: (r[2], r[0]))]
    rest.remove(out[0])
    while rest:
        last = out[-1]
        above = [r for r in rest if r[2] >= last[2]]
        able = [r for r in above if meets(last, r)] or above or rest
        out.append(min(able, key=lambda r: (abs(r[2] - last[2]), r[0])))
        rest.remove(out[-1])
    return [r[0] for r in out]


def order_by_degree(rows):
    rest = sorted(rows)
    degree = {r[0]: sum(meets(r, s) for s in rows if s is not r) for r in rows}
    out = [min(rest, key=lambda r: (-degree[r[0]], r[0]))]
    rest.remove(out[0])
    while rest:
        near = [r for r in rest if meets(out[-1], r)]
        out.append(min(near, key=lambda r: (-degree[r[0]], r[0])) if near else rest[0])
        rest.remove(out[-1])
    return [r[0] for r in out]


def test_orders_follow_their_rules(spark):
    rows = boxes(random.Random(9), 40)
    df = spark.createDataFrame(rows, "product_id string, g int, roi_sub_solar_ground_azimuth double, x0 double, y0 double, x1 double, y1 double")
    for method, plain in (("weight", order_by_weight), ("degree", order_by_degree)):
        got = ordering.ordered_groups(df, "g", method).collect()
        for g in (0, 1):
            assert [r.product_id for r in sorted(got, key=lambda r: r.place) if r.g == g] == plain([r for r in rows if r[1] == g]), method


def test_tour_has_no_better_exchange(spark):
    """It begins at the least azimuth, no reversal of a stretch between two images shortens it, and it is not far from the best of all."""
    rows = boxes(random.Random(3), 8)
    df = spark.createDataFrame(rows, "product_id string, g int, roi_sub_solar_ground_azimuth double, x0 double, y0 double, x1 double, y1 double").withColumn("g", F.lit(0))
    by_id = {r[0]: r for r in rows}
    path = [by_id[r.product_id] for r in ordering.ordered_groups(df, "g", "tour").orderBy("place").collect()]
    length = lambda p: sum(weight(a, b) for a, b in zip(p, p[1:]))
    assert path[0] == min(rows, key=lambda r: r[2]) and sorted(path) == sorted(rows)
    for i in range(1, len(path) - 2):
        for j in range(i + 1, len(path) - 1):
            assert length(path[:i] + path[i : j + 1][::-1] + path[j + 1 :]) >= length(path) - 1e-6
    best = min(length([path[0], *p]) for p in itertools.permutations(path[1:]))
    assert best <= length(path) + 1e-9 <= 3 * best + 1


def test_orders_by_bins_and_chunks(spark):
    rows = [(*r[:1], 0, *r[2:]) for r in boxes(random.Random(4), 45)]
    df = spark.createDataFrame(rows, "product_id string, g int, roi_sub_solar_ground_azimuth double, x0 double, y0 double, x1 double, y1 double")
    edges = np.quantile([r[2] for r in rows], np.linspace(0, 1, 6))
    bin_of = {r[0]: max(int(np.searchsorted(edges, r[2], "left")) - 1, 0) for r in rows}
    got = ordering.reorder_by_illumination_bins(df, 5).collect()
    for b in set(bin_of.values()):
        own = sorted((r for r in got if r.bin == b), key=lambda r: r.place)
        assert [r.product_id for r in own] == order_by_weight([r for r in rows if bin_of[r[0]] == b])
    chunks = ordering.reorder_by_illumination_tour(df, 10).collect()
    place = {r[0]: i // 10 for i, r in enumerate(sorted(rows, key=lambda r: (r[2], r[0])))}
    assert {r.product_id: r.chunk for r in chunks} == place
    assert all(sorted(r.place for r in chunks if r.chunk == c) == list(range(1, 1 + sum(v == c for v in place.values()))) for c in set(place.values()))


# Rasters.


def pixels(spark, g, raster_id=1):
    return spark.createDataFrame(pd.DataFrame([(raster_id, x, y, float(v)) for (y, x), v in np.ndenumerate(g) if not np.isnan(v)], columns=["raster_id", "x", "y", "v"]), "raster_id int, x int, y int, v double")


def spectrum(a):
    p = np.pad(a, 4, mode="symmetric")
    mean = sum(p[i : i + a.shape[0], j : j + a.shape[1]] for i in range(9) for j in range(9)) / 81
    return np.abs(np.fft.fftshift(np.fft.fft2(a - mean))) ** 2


def ratio(power):
    size = np.sqrt(power)
    cy, cx = size.shape[0] // 2, size.shape[1] // 2
    off = size.copy()
    off[cy - 4 : cy + 5] = 0
    off[:, cx - 4 : cx + 5] = 0
    return off.max() / (size.mean() + 1e-9)


def test_stripe_score_of_windows(spark):
    rng = np.random.default_rng(3)
    g = rng.random((150, 170)) + 1
    df = pixels(spark, g)
    score = lambda **k: raster.stripe_score(df, **k).first().score
    assert score() == pytest.approx(ratio(spectrum(g)))
    assert score(region="centre") == pytest.approx(ratio(spectrum(g[37:112, 42:127])))
    assert score(region=(10, 20, 90, 500)) == pytest.approx(ratio(spectrum(g[20:, 10:90])))
    assert score(region=(10, 20, 60, 90)) is None
    p = np.pad(g, 4, mode="symmetric")
    mean = sum(p[i : i + 150, j : j + 170] for i in range(9) for j in range(9)) / 81
    tiles = [(g - mean)[y : y + 64, x : x + 64] for y in (0, 64, 86) for x in (0, 64, 106)]
    whole = np.mean([np.abs(np.fft.fftshift(np.fft.fft2(t))) ** 2 for t in tiles], axis=0)
    assert score(side=64) == pytest.approx(ratio(whole))


def test_stripes_anywhere_are_found(spark):
    """A raster of which only a far corner has stripes scores above one without."""
    rng = np.random.default_rng(4)
    flat = rng.random((200, 200)) + 1
    y, x = np.mgrid[0:200, 0:200]
    corner = flat + np.where((x > 130) & (y > 130), 2 * np.sin(2 * np.pi * (x + y) / 6), 0)
    score = {r.raster_id: r.score for r in raster.stripe_score(pixels(spark, flat, 1).union(pixels(spark, corner, 2)).union(pixels(spark, np.where(x < 70, 0.0, flat), 3)), side=64).collect()}
    assert score[2] > 3 * score[1] and score[3] is None


def test_prune_and_remosaic(spark):
    rng = random.Random(11)
    rows = [(k, x, y, None if rng.random() < 0.1 else round(rng.random(), 1)) for k in range(10) for x in range(8) for y in range(8) if rng.random() < 0.6]
    df = spark.createDataFrame(rows, "raster_id int, x int, y int, v double")
    positions = spark.createDataFrame([(k, k) for k in range(10)], "raster_id int, pos long")
    before = raster.chunked_max_lit(df, positions, 3, 5).cache()
    for gone in ([], [4], [0, 1, 2, 7], list(range(10))):
        removed = spark.createDataFrame([(k,) for k in gone], "raster_id int")
        now = raster.prune_and_remosaic(before, df, positions, removed, 3, 5)
        want = raster.chunked_max_lit(df.filter(~F.col("raster_id").isin(gone)) if gone else df, positions, 3, 5)
        order = lambda d: sorted(map(tuple, d.select("level", "part", "x", "y", "v").collect()))
        assert order(now) == order(want)


def test_best_azimuth_over_tiles(spark):
    rng = np.random.default_rng(6)
    y, x = np.mgrid[0:40, 0:40]
    df = pixels(spark, 3.0 * y + 2.0 * x + rng.random((40, 40)))
    one = [raster.hillshade(df, a).filter(~F.isnan("v")).agg(F.avg("v").alias("m")).first().m for a in range(0, 360, 45)]
    assert raster.best_azimuth(df, tile=16).first().azimuth == 45.0 * int(np.argmax(one)) == raster.best_azimuth(df).first().azimuth
    assert raster.best_azimuth(df.limit(0)).first().azimuth == 300


def test_blend_with_relief(spark):
    """As plain numpy does it: shadows of enough pixels keep the reference, and the model's weight grows with the distance from them."""
    rng = np.random.default_rng(7)
    side, reach, least = 30, 4, 6
    y, x = np.mgrid[0:side, 0:side]
    ref, dem = 100 * np.sin(x / 5.0) + y, 100 * np.cos(y / 6.0) - x
    bright = rng.random((side, side)) + 0.1
    bright[3:9, 4:10] = bright[20:22, 20:22] = 0.0
    bright[15, 25:30] = 0.0
    got = raster.blend_to_reference(pixels(spark, ref), pixels(spark, dem), pixels(spark, bright).select("x", "y", "v"), 0.005, reach, least).collect()
    shadow = np.zeros((side, side), bool)
    seen = set()
    for j, i in zip(*np.nonzero(bright <= 0.005), strict=True):
        part, todo = set(), [(j, i)]
        while todo:
            a, b = todo.pop()
            if (a, b) in part or not (0 <= a < side and 0 <= b < side) or bright[a, b] > 0.005:
                continue
            part.add((a, b))
            todo += [(a + 1, b), (a - 1, b), (a, b + 1), (a, b - 1)]
        if len(part) >= least and not part & seen:
            seen |= part
            for a, b in part:
                shadow[a, b] = True
    away = np.full((side, side), float(reach))  # city-block distance to shadow or to the border
    for j in range(side):
        for i in range(side):
            d = [abs(j - a) + abs(i - b) for a, b in zip(*np.nonzero(shadow), strict=True)]
            away[j, i] = min(reach, min(d, default=reach), i + 1, j + 1, side - i, side - j)
    w = away / reach
    want = np.where(shadow, ref, w * dem + (1 - w) * ref)
    assert shadow.sum() == 36
    for r in got:
        assert r.v == pytest.approx(want[r.y, r.x]), (r.x, r.y)
