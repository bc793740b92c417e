"""Nested metadata: formats of a video, storyboard fragments, person boxes per frame."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FORMATS = "array<struct<format_id:string,format_note:string,height:int,resolution:string,vcodec:string,acodec:string,fragments:array<struct<url:string>>>>"
# Image tiers of storyboards.
STORYBOARD_IDS = ("sb0", "sb1", "sb2", "sb3")


def is_storyboard(f: Column) -> Column:
    return (F.coalesce(f["format_note"], F.lit("")) == "storyboard") | F.coalesce(f["format_id"], F.lit("")).isin(*STORYBOARD_IDS)


def has_video(f: Column) -> Column:
    return ~is_storyboard(f) & (F.coalesce(f["vcodec"], F.lit("none")) != "none")


def height(f: Column) -> Column:
    """The stated height, else the longer edge of WxH, else the number of a note such as 720p."""
    edges = F.transform(F.regexp_extract_all(F.coalesce(f["resolution"], F.lit("")), F.lit(r"(\d+)"), 1), lambda x: F.try_to_number(x, F.lit("999999")).cast("int"))
    wxh = F.when(F.coalesce(f["resolution"], F.lit("")).rlike(r"^\d+x\d+$"), F.array_max(edges))
    note = F.nullif(F.regexp_extract(F.coalesce(f["format_note"], F.lit("")), r"^(\d{3,4})p", 1), F.lit("")).cast("int")
    return F.coalesce(f["height"], wxh, note)


def max_height(formats: Column, least: int = 100) -> Column:
    """The largest height of the video formats, storyboards and heights under `least` left out; null where there is none."""
    good = F.filter(F.transform(F.filter(formats, has_video), height), lambda h: h >= least)
    return F.array_max(good)


def missing_height_status(formats: Column) -> Column:
    """Why there is no height: NO_HEIGHT for sound alone, else EMPTY_FORMATS; null where there is one."""
    real = F.filter(formats, lambda f: ~is_storyboard(f))
    sound_only = (F.size(real) > 0) & ~F.exists(real, has_video)
    return F.when(max_height(formats).isNotNull(), F.lit(None).cast("string")).when(F.coalesce(sound_only, F.lit(False)), "NO_HEIGHT").otherwise("EMPTY_FORMATS")


def fragment_urls(fragments: Column) -> Column:
    """The urls of fragments, missing ones left out."""
    return F.filter(F.transform(fragments, lambda x: F.nullif(F.trim(x["url"]), F.lit(""))), lambda u: u.isNotNull())


def tile_box(index: Column, columns: int, width: int, height_px: int) -> Column:
    """The crop of tile `index` of a storyboard sheet."""
    x, y = (index % columns) * width, F.floor(index / columns) * height_px
    return F.struct(x.cast("int").alias("x0"), y.cast("int").alias("y0"), (x + width).cast("int").alias("x1"), (y + height_px).cast("int").alias("y1"))


def person_frames(boxes: Column) -> Column:
    """Frames with at least one box; null frames (no picture) do not count."""
    return F.size(F.filter(boxes, lambda b: F.coalesce(F.size(b), F.lit(0)) > 0))


def box_share(boxes: Column, width: int, height_px: int) -> Column:
    """The largest share of a frame that one box takes, over all frames; null without a box."""
    area = F.flatten(F.transform(F.filter(boxes, lambda b: b.isNotNull()), lambda b: F.transform(b, lambda r: (r["x1"] - r["x0"]) * (r["y1"] - r["y0"]))))
    return F.array_max(area) / F.lit(float(width * height_px))


def frame_verdict(boxes: Column, share: Column, yes_frames: int, yes_share: float) -> Column:
    """T with enough person frames of enough size, F without any, ERROR without a readable frame, else U."""
    readable = F.size(F.filter(boxes, lambda b: b.isNotNull()))
    n = person_frames(boxes)
    return F.when(F.coalesce(readable, F.lit(0)) <= 0, "ERROR").when((n >= yes_frames) & (F.coalesce(share, F.lit(0.0)) >= yes_share), "T").when(n == 0, "F").otherwise("U")


def storyboard_urls(formats: Column, tiers: tuple[str, ...] = STORYBOARD_IDS) -> Column:
    """array<struct<tier, url>>: the first usable fragment of each storyboard tier, in the given order of tiers."""
    found = F.filter(formats, lambda f: is_storyboard(f) & F.coalesce(F.size(fragment_urls(f["fragments"])) > 0, F.lit(False)))
    flat = F.transform(found, lambda f: F.struct(F.array_position(F.array(*(F.lit(t) for t in tiers)), f["format_id"]).alias("rank"), f["format_id"].alias("tier"), F.element_at(fragment_urls(f["fragments"]), 1).alias("url")))
    ranked = F.array_sort(F.filter(flat, lambda x: x["rank"] > 0))
    return F.transform(ranked, lambda x: F.struct(x["tier"].alias("tier"), x["url"].alias("url")))
