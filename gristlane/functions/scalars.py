"""Column expressions: boxes, bins, weights, hashes and text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Classes, expected weight of an empty container by size (grams), largest weight without a box.
CLASSES = ["can", "pet", "paper", "plastic", "styrofoam", "vinyl", "glass", "battery", "fluorescent"]
EMPTY_WEIGHT = {
    "pet": {"S": 15.0, "M": 22.0, "L": 45.0},
    "can": {"S": 14.0, "M": 20.0, "L": 40.0},
    "plastic": {"S": 10.0, "M": 30.0, "L": 80.0},
    "paper": {"S": 5.0, "M": 40.0, "L": 200.0},
}
FALLBACK_WEIGHT = {"pet": 300.0, "can": 200.0, "plastic": 500.0, "paper": 2000.0, "styrofoam": 500.0, "vinyl": 400.0, "glass": 1000.0, "battery": 200.0, "fluorescent": 500.0}
MARGIN = 15.0


def let(value: Column, then) -> Column:
    """then(value) with the value computed once: an expression that a lambda repeats would be computed for every element."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def micros(ts) -> Column:
    """Microseconds since the epoch; a time without a zone counts as UTC under the session's setting."""
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def lookup(key: Column, table: dict) -> Column:
    """Value of a small constant table; null for other keys."""
    out = F.lit(None)
    for k, v in reversed(list(table.items())):
        out = F.when(key == k, F.lit(v)).otherwise(out)
    return out


def external_class(class_id: Column) -> Column:
    """Class ids as others see them: 1 counts as 3."""
    return F.when(class_id == 1, F.lit(3)).otherwise(class_id)


def category(text: Column, table: dict, default=None) -> Column:
    """Value of the first key of table that the text contains."""
    out = F.lit(default)
    for k, v in reversed(list(table.items())):
        out = F.when(text.contains(k), F.lit(v)).otherwise(out)
    return out


def area(box) -> Column:
    """Area of (x1, y1, x2, y2), 0 for a degenerate one."""
    x1, y1, x2, y2 = box
    return F.greatest(F.lit(0.0), x2 - x1) * F.greatest(F.lit(0.0), y2 - y1)


def intersection(a, b) -> Column:
    return area((F.greatest(a[0], b[0]), F.greatest(a[1], b[1]), F.least(a[2], b[2]), F.least(a[3], b[3])))


def iou(a, b, empty: float | None = 0.0) -> Column:
    """Intersection over union; ``empty`` where the union is empty (None leaves it null)."""
    both = intersection(a, b)
    union = area(a) + area(b) - both
    return F.when(union > 0, both / union).otherwise(F.lit(empty))


def assignment(overlap: Column, positive: float = 0.5, negative: float = 0.1) -> Column:
    """truth at or above positive, background at or below negative, else ambiguous."""
    return F.when(overlap >= positive, "truth").when(overlap <= negative, "background").otherwise("ambiguous")


def pad_and_clip(box, share: float, width: Column, height: Column):
    """A box grown by a share of its sides, in whole pixels within the image."""
    x1, y1, x2, y2 = box
    dx, dy = (x2 - x1) * share, (y2 - y1) * share
    return (F.greatest(F.lit(0.0), F.floor(x1 - dx)), F.greatest(F.lit(0.0), F.floor(y1 - dy)), F.least(width, F.ceil(x2 + dx)), F.least(height, F.ceil(y2 + dy)))


def expand_and_clip(box, margin: float, width: Column, height: Column):
    """A box grown by a share of its sides on each side, within the image."""
    x1, y1, x2, y2 = box
    dx, dy = (x2 - x1) * margin, (y2 - y1) * margin
    return (F.greatest(F.lit(0.0), x1 - dx), F.greatest(F.lit(0.0), y1 - dy), F.least(width, x2 + dx), F.least(height, y2 + dy))


def overlap(a, b) -> Column:
    """Whether two boxes of positive area share some."""
    solid = (a[2] > a[0]) & (a[3] > a[1]) & (b[2] > b[0]) & (b[3] > b[1])
    return solid & (F.least(a[2], b[2]) > F.greatest(a[0], b[0])) & (F.least(a[3], b[3]) > F.greatest(a[1], b[1]))


def background_state(material: Column, background, truth, crop, width: Column, height: Column, margin: float = 0.1) -> Column:
    """Whether a crop is strictly background: it must not meet the truth's box grown by a margin (names are fixed values)."""
    near = overlap(crop, expand_and_clip(truth, margin, width, height))
    return F.when(material.isNull(), "ambiguous_assignment").when(material != background, "not_background").when(crop[0].isNull(), "invalid_crop").when(truth[0].isNull(), "accepted_empty_source").when(near, "rejected_gt_intersection").otherwise("accepted_zero_intersection")


def parse_box(text: Column, width: Column, height: Column, least: float, most: float) -> tuple[Column, Column]:
    """(corner box as a struct, reason) of a JSON value: [x1, y1, x2, y2], or an object of corners or of a corner and sizes; the other is null.

    The reasons are fixed values.
    """
    at = lambda path: F.get_json_object(text, path)
    has = lambda *names: F.size(F.array_intersect(F.json_object_keys(text), F.array(*map(F.lit, names)))) == len(names)
    shape = F.when(F.size(F.from_json(text, "array<string>")) == 4, 0).when(has("x1", "y1", "x2", "y2"), 1).when(has("x", "y", "width", "height"), 2).when(F.json_object_keys(text).isNotNull(), 3).otherwise(4)
    number = lambda path: at(path).try_cast("double")

    def corners(kind: Column) -> Column:
        by = lambda i, name, sized: F.when(kind == 0, number(f"$[{i}]")).when(kind == 1, number(f"$.{name}")).when(kind == 2, sized)
        x1, y1 = by(0, "x1", number("$.x")), by(1, "y1", number("$.y"))
        x2, y2 = by(2, "x2", number("$.x") + number("$.width")), by(3, "y2", number("$.y") + number("$.height"))
        return F.struct(kind.alias("kind"), F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2")).alias("box"))

    def judged(v: Column) -> Column:
        x1, y1, x2, y2 = (v["box"][c] for c in ("x1", "y1", "x2", "y2"))
        odd = lambda c: F.isnan(c) | (F.abs(c) == float("inf"))
        share = (x2 - x1) * (y2 - y1) / (width * height)
        reason = (
            F.when(v["kind"] == 4, "bbox_missing").when(v["kind"] == 3, "bbox_invalid_shape").when(x1.isNull() | y1.isNull() | x2.isNull() | y2.isNull(), "bbox_non_numeric").when(odd(x1) | odd(y1) | odd(x2) | odd(y2), "bbox_non_finite")
            .when((x1 < 0) | (y1 < 0) | (x2 > width) | (y2 > height) | (x2 <= x1) | (y2 <= y1), "bbox_out_of_bounds").when(share < least, "bbox_area_too_small").when(share > most, "bbox_area_too_large")
        )
        return let(reason, lambda why: F.struct(F.when(why.isNull(), v["box"]).alias("box"), why.alias("reason")))

    out = let(let(shape, corners), judged)
    return out["box"], out["reason"]


def box_score(box, confidence: Column, width: Column, height: Column) -> Column:
    """Confidence less penalties for distance from the usual place and for an unusual size; null for a box that is out of the question.

    The place, the sizes and the penalties are fixed values.
    """
    x1, y1, x2, y2 = box
    share = (x2 - x1) * (y2 - y1) / (width * height)
    away = F.hypot((x1 + x2) / 2 / width - 0.5, (y1 + y2) / 2 / height - 0.55)
    odd = F.abs(F.log(F.greatest(share, F.lit(1e-6)) / 0.20)) * 0.05
    return F.when((x2 - x1 > 2) & (y2 - y1 > 2) & (share >= 0.003) & (share <= 0.92), confidence - away * 0.20 - odd)


def first_path(json: Column, *paths: str) -> Column:
    """The first value that one of several paths of a JSON text has."""
    return F.coalesce(*[F.get_json_object(json, p) for p in paths])


def centred(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column):
    """Centre and size of a corner box as shares of the image, within 0..1."""

    def unit(v: Column) -> Column:
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), v))

    return unit((x + w / 2) / width), unit((y + h / 2) / height), unit(w / width), unit(h / height)


def polygon_box(points: Column):
    """Bounding box of an array of structs (x, y), and twice the signed area."""
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    nxt = F.concat(F.slice(points, 2, F.greatest(F.size(points) - 1, F.lit(0))), F.slice(points, 1, 1))
    twice = F.aggregate(F.zip_with(points, nxt, lambda p, q: p["x"] * q["y"] - q["x"] * p["y"]), F.lit(0.0), lambda a, v: a + v)
    return (F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)), twice


def bins(value: Column, cuts: list[float], names: list[str]) -> Column:
    """names[i] below cuts[i]; the last name from the last cut on."""
    out = F.lit(names[-1])
    for cut, name in reversed(list(zip(cuts, names))):
        out = F.when(value < cut, F.lit(name)).otherwise(out)
    return out


def size_bucket(ratio: Column) -> Column:
    return bins(ratio, [0.10, 0.28], ["S", "M", "L"])


def area_bin(ratio: Column) -> Column:
    return bins(ratio, [0.15, 0.45], ["small", "medium", "large"])


def focus_bin(ratio: Column) -> Column:
    return bins(ratio, [0.20, 0.45], ["small", "medium", "large"])


def weight_anomaly(cls: Column, grams: Column, ratio: Column) -> Column:
    """Heavier than the empty container of its size plus a margin; without a box or table, than one bound; else false."""
    size = size_bucket(ratio)
    expected = F.lit(None).cast("double")
    for name, table in EMPTY_WEIGHT.items():
        expected = F.when(cls == name, lookup(size, table)).otherwise(expected)
    sized = ratio.isNotNull() & expected.isNotNull()
    return F.coalesce(F.when(sized, grams > expected + MARGIN).otherwise(grams > lookup(cls, FALLBACK_WEIGHT)), F.lit(False))


def softmax(logits: Column) -> Column:
    def shares(e: Column) -> Column:
        return let(F.aggregate(e, F.lit(0.0), lambda a, v: a + v), lambda total: F.transform(e, lambda x: x / total))

    return let(F.array_max(logits), lambda top: let(F.transform(logits, lambda x: F.exp(x - top)), shares))


def view_mean(views: Column) -> Column:
    """Mean of the arrays of an array, place by place (the first one's length); null without any."""
    first = F.get(views, F.lit(0))
    total = F.aggregate(F.slice(views, 2, F.greatest(F.size(views), F.lit(1))), first, lambda a, v: F.zip_with(a, v, lambda x, y: x + y))
    return F.transform(total, lambda x: x / F.size(views))


def argmax(values: Column) -> tuple[Column, Column]:
    """(index of the one greatest value, whether several share it); a tie has no index."""
    top = F.array_max(values)
    tied = let(top, lambda t: F.size(F.filter(values, lambda v: v == t)) > 1)
    return F.when(~tied, (F.array_position(values, top) - 1).cast("int")), tied


def ranked(values: Column) -> Column:
    """(value, index) pairs, greatest first, ties to the lower index."""
    return F.transform(F.sort_array(F.transform(values, lambda v, i: F.struct(v.alias("value"), (-i).alias("i"))), asc=False), lambda p: F.struct(p["value"].alias("value"), (-p["i"]).alias("index")))


def stable_id(prefix: str, length: int, *parts: Column) -> Column:
    """prefix and the first hex digits of the SHA-256 of the parts, joined by |."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256), 1, length))


def pseudonym(value: Column) -> Column:
    return F.substring(F.sha2(F.lower(F.trim(value)), 256), 1, 20)


def basename(path: Column) -> Column:
    return F.lower(F.regexp_extract(F.replace(path, F.lit("\\"), F.lit("/")), r"([^/]*)$", 1))


def fraction(text: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of a text's SHA-256."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("double") / float(1 << 52)


def shard(text: Column, n: int) -> Column:
    return (F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("long") % n).cast("int")


#: Fixed value: no hour from this one on, whatever the configured end.
LAST_HOUR = 17


def in_hours(ts: Column, zone: str, first: int, end: int, most: int = LAST_HOUR) -> Column:
    """first <= hour < the smaller of end and ``most`` in a time zone; ts is UTC."""
    h = F.hour(F.from_utc_timestamp(ts, zone))
    return (h >= first) & (h < min(end, most))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def unpad_base64url(text: Column) -> Column:
    """Text of base64url whose padding may be missing."""
    plain = F.translate(text, "-_", "+/")
    return F.unbase64(F.rpad(plain, (F.ceil(F.length(plain) / 4) * 4).cast("int"), F.lit("="))).cast("string")


def distinct_list(text: Column, sep: str = ",") -> Column:
    """Names of a list in lower case without blanks, the first of equal ones kept."""
    return F.array_distinct(F.filter(F.transform(F.split(text, sep), lambda x: F.lower(F.trim(x))), lambda x: x != ""))


def valid_name(text: Column) -> Column:
    return F.coalesce(text.rlike(r"^[A-Za-z0-9_-]{1,128}$"), F.lit(False))


def safe_name(text: Column) -> Column:
    return F.regexp_replace(text, r"[^A-Za-z0-9_-]", "_")


def box_quality(box, width: Column, height: Column) -> tuple[Column, Column, Column]:
    """(area ratio, edges touched, suspicious) of a box; null without a box or a size."""
    x1, y1, x2, y2 = box
    ratio = F.when((width > 0) & (height > 0), area(box) / (width * height))
    touches = (x1 <= width * 0.01).cast("int") + (y1 <= height * 0.01).cast("int") + (x2 >= width * 0.99).cast("int") + (y2 >= height * 0.99).cast("int")
    touches = F.when(ratio.isNotNull(), touches)
    return ratio, touches, (ratio >= 0.5) | (touches >= 2)


# The platform's centre and radii and how far detection reaches beyond them, as shares of the image.
PLATFORM = {"centre": (0.447, 0.590), "radius": (0.175, 0.160), "strip": 1.5, "stretch": (2.0, 2.5), "anchor": 0.85}


def on_platform(box, width: Column, height: Column, centre=PLATFORM["centre"], radius=PLATFORM["radius"], strip: float = PLATFORM["strip"], stretch=PLATFORM["stretch"], anchor: float = PLATFORM["anchor"]) -> Column:
    """Whether the lower centre of a box lies in the strip and the ellipse around a platform; false for a degenerate box."""
    x1, y1, x2, y2 = box
    ax, ay = (x1 + x2) / 2 / width, (y1 + (y2 - y1) * anchor) / height
    dx, dy = (ax - centre[0]) / (radius[0] * stretch[0]), (ay - centre[1]) / (radius[1] * stretch[1])
    inside = (F.abs(ax - centre[0]) <= radius[0] * strip) & (dx * dx + dy * dy <= 1.0)
    return F.coalesce((x2 > x1) & (y2 > y1) & (width > 0) & (height > 0) & inside, F.lit(False))


def first_reason(reasons: Column, priority: dict, vetoes: list) -> Column:
    """Canonical name of the first reason by priority; null with none, with a veto, or with an unknown one."""
    known = F.array(*[F.lit(k) for k in priority])
    pick = F.coalesce(*[F.when(F.array_contains(reasons, k), F.lit(v)) for k, v in priority.items()])
    ok = (F.size(reasons) > 0) & ~F.arrays_overlap(reasons, F.array(*map(F.lit, vetoes))) & (F.size(F.array_except(reasons, known)) == 0)
    return F.when(ok, pick)


def head_label(applies: Column, accepted: Column, value: Column) -> Column:
    """0 or 1 where a head applies to an accepted row, else -1."""
    return F.when(applies & accepted, F.coalesce(value.cast("int"), F.lit(-1))).otherwise(-1)


def valid_crop(count: Column, size: Column, x, y, w, h, width, height, least_bytes: int) -> Column:
    """One object, enough bytes, a box within its image (two pixels over are borne) of 2 % to 95 %; strings that are no numbers are invalid."""
    n, b = count.try_cast("int"), size.try_cast("int")
    x, y, w, h, width, height = (c.try_cast("double") for c in (x, y, w, h, width, height))
    share = w * h / (width * height)
    ok = (n == 1) & (b >= least_bytes) & (F.least(width, height, w, h) > 1) & (F.least(x, y) >= 0) & (x + w <= width + 2) & (y + h <= height + 2) & share.between(0.02, 0.95)
    return F.coalesce(ok, F.lit(False))


def eligible(split: Column, category: Column, targets: list[str], count: Column, size: Column, share: Column, least_bytes: int, least: float, most: float, clean: Column | None = None) -> Column:
    """Training rows of wanted categories with one object, enough bytes and a share of the image within bounds; what is no number is not eligible."""
    ok = (F.lower(split) == "training") & category.isin(targets) & (count.try_cast("int") == 1) & (size.try_cast("int") >= least_bytes) & share.between(least, most)
    return F.coalesce(ok if clean is None else ok & clean, F.lit(False))
