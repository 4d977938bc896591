"""Image sizes, tiles, crops and token counts as Column expressions over integers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PATCH = 28
MAX_PIXELS = 14 * 14 * 4 * 160


def divisor_pairs(n: int) -> list[tuple[int, int]]:
    """Ordered pairs (i, n / i) of the divisors of n."""
    return [(i, n // i) for i in range(1, n + 1) if n % i == 0]


def candidate_sizes(max_splits: int = 8, image_size: int = 336) -> list[tuple[int, float, int, int]]:
    """(order, ratio, width, height) of every grid of 1 to max_splits tiles; order is that of first appearance."""
    pairs = [(w, h) for n in range(1, max_splits + 1) for w, h in divisor_pairs(n)]
    ratios = list(dict.fromkeys(w / h for w, h in pairs))
    by_ratio = sorted(pairs, key=lambda p: ratios.index(p[0] / p[1]))
    return [(i, w / h, w * image_size, h * image_size) for i, (w, h) in enumerate(by_ratio)]


def size_table(spark: SparkSession, max_splits: int = 8, image_size: int = 336) -> DataFrame:
    return spark.createDataFrame(candidate_sizes(max_splits, image_size), "ord int, ratio double, cw int, ch int")


def _bound(value: Column, use) -> Column:
    """use(value), the value evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _nearest(rows: list[tuple[int, float, int, int]], ratio: Column, size: Column, able) -> Column:
    """The row of the nearest allowed ratio, then of the nearest product of sides; the first wins ties, and none allowed gives nulls."""
    table = F.array(*[F.struct(F.lit(o).alias("ord"), F.lit(r).alias("ratio"), F.lit(w).alias("w"), F.lit(h).alias("h")) for o, r, w, h in rows])

    def sized(v: Column, first: Column) -> Column:
        same = F.filter(table, lambda c: c["ratio"] == first["ratio"])
        return F.array_min(F.transform(same, lambda c: F.struct(F.abs(c["w"] * c["h"] - v["size"]).alias("d"), c["ord"].alias("ord"), c["w"].alias("w"), c["h"].alias("h"))))

    def chosen(v: Column) -> Column:
        allowed = F.filter(table, lambda c: able(c["ratio"], v["ratio"]))
        first = F.array_min(F.transform(allowed, lambda c: F.struct(F.abs(c["ratio"] - v["ratio"]).alias("d"), c["ord"].alias("ord"), c["ratio"].alias("ratio"))))
        return _bound(first, lambda f: sized(v, f))

    return _bound(_bound(F.struct(ratio.alias("ratio"), size.alias("size")), chosen), lambda x: F.struct(x["w"].alias("w"), x["h"].alias("h")))


def best_size(w: Column, h: Column, max_splits: int = 8, image_size: int = 336) -> Column:
    """Width and height of the candidate with the nearest ratio, then the nearest area; the first wins ties."""
    return _nearest(candidate_sizes(max_splits, image_size), w / h, w * h, lambda r, a: F.lit(True))


def best_slices(w_slices: Column, h_slices: Column, aspect: Column, max_splits: int = 12) -> Column:
    """Slice counts near an aspect ratio, from below for ratios under 1 and from above for those over 1; null if none fits."""
    able = lambda r, a: F.when(a < 1, r <= a).when(a > 1, r >= a).otherwise(F.lit(True))
    return _nearest(candidate_sizes(max_splits, 1), aspect, w_slices * h_slices, able)


def stride(dim: Column, window: Column, slices: Column) -> Column:
    """Distance of neighbouring windows, rounded down (also below zero); 0 for a single slice."""
    return F.when(slices > 1, F.floor((dim - window) / F.when(slices > 1, slices - 1).otherwise(1))).otherwise(0).cast("int")


def origins(dim: Column, window: Column, step: Column) -> Column:
    """Where windows start: 0, step, ... while they fit; a zero step counts as the window's size."""
    by = F.when(step == 0, window).otherwise(step)
    return F.when(dim >= window, F.sequence(F.lit(0), dim - window, by)).otherwise(F.array().cast("array<int>"))


def fitted(w: Column, h: Column, w_slices: Column, h_slices: Column, window: int) -> Column:
    """The resized width and height that slices of a window size cover."""
    wide = (w_slices * window).cast("int")
    high = (h_slices * window).cast("int")
    narrow = w_slices < h_slices
    return F.struct(F.when(narrow, wide).otherwise((w / h * high).cast("int")).alias("w"), F.when(narrow, (h / w * wide).cast("int")).otherwise(high).alias("h"))


def limited(w: Column, h: Column, max_size: int) -> Column:
    """Both sides divided by the square root of how often the area exceeds a limit; unchanged within it."""
    ratio = F.pow(w * h / F.lit(max_size), F.lit(0.5))
    fits = w * h <= max_size
    return F.struct(F.when(fits, w).otherwise((w / ratio).cast("int")).alias("w"), F.when(fits, h).otherwise((h / ratio).cast("int")).alias("h"))


def smart_size(w: Column, h: Column, max_pixels: int = MAX_PIXELS) -> Column:
    """Sides as multiples of 28 near the original, shrunk to a pixel budget; our own rule."""
    near = lambda x: F.greatest(F.lit(PATCH), (F.bround(x / PATCH) * PATCH).cast("int"))
    beta = F.sqrt(w * h / F.lit(max_pixels))
    down = lambda x: F.greatest(F.lit(PATCH), (F.floor(x / beta / PATCH) * PATCH).cast("int"))
    fits = near(w) * near(h) <= max_pixels
    return F.struct(F.when(fits, near(w)).otherwise(down(w)).alias("w"), F.when(fits, near(h)).otherwise(down(h)).alias("h"))


def fits_aspect(w: Column, h: Column, most: int) -> Column:
    """The ratio of the sides is at most ``most`` to one, either way."""
    return (w / h <= most) & (w / h >= F.lit(1.0) / most)


def within_aspect(w: Column, h: Column, most: int) -> Column:
    """The size with the longer side cut down to ``most`` times the shorter where it exceeds that."""
    fits, wide = fits_aspect(w, h, most), w > h
    return F.struct(F.when(~fits & wide, h * most).otherwise(w).alias("w"), F.when(~fits & ~wide, w * most).otherwise(h).alias("h"))


def square_crop(w: Column, h: Column) -> Column:
    side = F.least(w, h)
    half = lambda x: F.floor(x / 2).cast("int")
    return F.struct(half(w - side).alias("left"), half(h - side).alias("top"), half(w + side).alias("right"), half(h + side).alias("bottom"))


def pixels(share: Column, dim: Column | int) -> Column:
    """A normalised coordinate in pixels, truncated toward zero."""
    return (share * dim).cast("int")


def image_tokens(w: Column, h: Column) -> Column:
    return (w / PATCH * h / PATCH).cast("int")


def video_tokens(grid: Column) -> Column:
    """A quarter of the product of a grid's sides, rounded down."""
    return F.floor(F.aggregate(grid, F.lit(1).cast("long"), lambda a, x: a * x.cast("long")) / 4).cast("long")


def grid_offset(i: Column, per_row: int, width: Column, height: Column) -> Column:
    return F.struct(((i % per_row) * width).alias("x"), (F.floor(i / per_row) * height).cast("long").alias("y"))


def warmup_and_decay(iterations: Column, share: float = 0.03) -> Column:
    warm = (iterations * F.lit(share)).cast("int")
    return F.struct(warm.alias("warmup"), (iterations - warm).alias("decay"))
