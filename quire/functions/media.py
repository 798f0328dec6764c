"""Classification of inputs, and the arithmetic of rendering."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from quire.constants import KIND_BY_MIME, KIND_BY_SUFFIX, LISTED_SUFFIXES, MIME_BY_SUFFIX
from quire.functions.text import suffix


def lookup(mapping: dict, key: Column) -> Column:
    """mapping[key], null where it has none."""
    return F.element_at(F.create_map(*(F.lit(x) for x in chain(*mapping.items()))), key)


def is_listed(path: Column) -> Column:
    return suffix(path).isin(*LISTED_SUFFIXES)


def mime_of(path: Column) -> Column:
    return lookup(MIME_BY_SUFFIX, suffix(path))


def kind_of(path: Column, mime: Column | None = None) -> Column:
    """pdf, image, docx, xlsx, html or unknown: by suffix first, then by MIME type."""
    mime = F.lit(None).cast("string") if mime is None else F.lower(mime)
    by_mime = F.coalesce(lookup(KIND_BY_MIME, mime), F.when(mime.startswith("image/"), "image"))
    return F.coalesce(lookup(KIND_BY_SUFFIX, suffix(path)), by_mime, F.lit("unknown"))


def sniffed(content: Column) -> Column:
    """Media type by the first bytes; PNG where they tell nothing."""
    head = F.hex(F.substring(content, 1, 12))
    return (
        F.when(head.startswith("FFD8FF"), "image/jpeg").when(head.startswith("89504E470D0A1A0A"), "image/png")
        .when(head.startswith("474946383761") | head.startswith("474946383961"), "image/gif")
        .when(head.startswith("52494646") & (F.substring(head, 17, 8) == "57454250"), "image/webp").otherwise("image/png")
    )


def too_large(size: Column, most_mb: float) -> Column:
    """Whether a size is beyond the cap; a cap of 0 or less is none, and an unknown size passes."""
    return F.coalesce(size > F.lit(int(most_mb * 1024 * 1024)), F.lit(False)) if most_mb > 0 else F.lit(False)


def clamped_scale(width: Column, height: Column, scale: Column, most: float) -> Column:
    """(scale, clamped): the scale at which width x height has at most most pixels; degenerate sizes keep theirs."""
    pixels = width * height * scale * scale
    over = (width * height > 0) & (pixels > most) & F.lit(most > 0)
    return F.struct(F.when(over, scale * F.sqrt(F.lit(float(most)) / pixels)).otherwise(scale).alias("scale"), F.coalesce(over, F.lit(False)).alias("clamped"))


def pixel_box(x0: Column, y0: Column, x1: Column, y1: Column, page_height: Column, scale: Column, width_px: Column, height_px: Column) -> Column:
    """A box with its origin at the bottom left, in points, as pixels from the top left within the image; valid: it has an area."""
    clamp = lambda v, top: F.greatest(F.lit(0.0), F.least(v.cast("double"), top.cast("double")))
    left, right = clamp(x0 * scale, width_px), clamp(x1 * scale, width_px)
    upper, lower = clamp((page_height - y1) * scale, height_px), clamp((page_height - y0) * scale, height_px)
    pixel = lambda v: v.cast("int")
    return F.struct(pixel(left).alias("left"), pixel(upper).alias("upper"), pixel(right).alias("right"), pixel(lower).alias("lower"), ((right > left) & (lower > upper)).alias("valid"))
