"""Boxes, grids and image sizes as Column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GRID = 1000
# Fixed values of the box format.
ROTATION_TOKENS = ((0, "<|rotate_up|>"), (90, "<|rotate_right|>"), (180, "<|rotate_down|>"), (270, "<|rotate_left|>"))


def grid(value: Column, size: Column) -> Column:
    return F.least(F.greatest(F.floor(value * GRID / size), F.lit(0)), F.lit(GRID)).cast("int")


def rotation_token(degrees: Column) -> Column:
    out = F.lit(ROTATION_TOKENS[0][1])
    for value, token in ROTATION_TOKENS[1:]:
        out = F.when(degrees == value, token).otherwise(out)
    return out


def box_text(box: Column, label: Column, rotation: Column, width: Column, height: Column) -> Column:
    at = [grid(box[k], width if k % 2 == 0 else height).cast("string") for k in range(4)]
    return F.concat(F.lit("<|box_start|>"), F.concat_ws(" ", *at), F.lit("<|box_end|><|ref_start|>"), F.coalesce(label, F.lit("unknown")), F.lit("<|ref_end|>"), rotation_token(rotation))


def layout_text(elements: Column, width: Column, height: Column, fit: Column | None = None) -> Column:
    """Elements (bbox, label, rotation) in order, as one string; fit: how the image is resized, null where it isn't."""
    if fit is None:
        return F.array_join(F.transform(elements, lambda e: box_text(e["bbox"], e["label"], e["rotation"], width, height)), "")
    size = [F.coalesce(fit[f"output_{name}"], side) for name, side in (("width", width), ("height", height))]
    box = lambda e: F.when(fit.isNull(), e["bbox"]).otherwise(moved_box(e["bbox"], fit))
    return F.array_join(F.transform(elements, lambda e: box_text(box(e), e["label"], e["rotation"], *size)), "")


def crop_box(box: Column, width: Column, height: Column) -> Column:
    """Whole pixels inside of the image, one pixel wide and high at least."""
    x1, y1 = (F.least(F.greatest(box[k].cast("int"), F.lit(0)), s - 1) for k, s in ((0, width), (1, height)))
    x2, y2 = (F.least(F.greatest(box[k].cast("int"), a + 1), s) for k, a, s in ((2, x1, width), (3, y1, height)))
    return F.array(x1, y1, x2, y2)


def scaled_if_normal(box: Column, width: Column, height: Column) -> Column:
    """Boxes within 0 to 1 as pixels; a box without four numbers as [0, 0, 1, 1]."""
    scaled = F.transform(box, lambda v, i: v * F.when(i % 2 == 0, width).otherwise(height))
    return F.when(F.coalesce(F.size(box) != 4, F.lit(True)), F.array(*(F.lit(x) for x in (0.0, 0.0, 1.0, 1.0)))).when(F.forall(box, lambda v: (v >= 0) & (v <= 1)), scaled).otherwise(box)


def aspect_ratio(width: Column, height: Column) -> Column:
    """The longer side by the shorter; null unless both are positive."""
    return F.when((width > 0) & (height > 0), F.greatest(width / height, height / width))


def fitted(width: Column, height: Column, size: int, square: bool) -> Column:
    """How an image becomes `size` by `size`: stretched, or padded to a square and scaled alike; null without a positive size."""
    longer = F.greatest(width, height)
    if square:
        x = y = F.lit(float(size)) / longer
        left, top = (longer - width) * x / 2, (longer - height) * y / 2
    else:
        x, y = F.lit(float(size)) / width, F.lit(float(size)) / height
        left = top = F.lit(0.0)
    made = F.struct(x.alias("scale_x"), y.alias("scale_y"), left.alias("pad_left"), top.alias("pad_top"), F.lit(size).alias("output_width"), F.lit(size).alias("output_height"))
    return F.when((width > 0) & (height > 0), made)


def moved_box(box: Column, fit: Column) -> Column:
    """A box of the original image as it lies in the fitted one."""
    return F.transform(box, lambda v, i: F.when(i % 2 == 0, v * fit["scale_x"] + fit["pad_left"]).otherwise(v * fit["scale_y"] + fit["pad_top"]))
