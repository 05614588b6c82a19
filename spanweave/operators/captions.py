"""What is asked of a captioner: frames, rosters, crops and prompts; and what of its answer is kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import references, without_references
from .intervals import KEYS, merge, within


def frame_count(duration, seconds_each=4.0, least=1, most=8) -> Column:
    """How many frames a span gets: one for so many seconds, within bounds; an empty span the fewest.

    Without a rate (``seconds_each`` not above 0) every span gets the most.
    """
    if seconds_each <= 0:
        return F.when(duration <= 0, F.lit(least)).otherwise(F.lit(most))
    return F.when(duration <= 0, F.lit(least)).otherwise(F.least(F.greatest(F.bround(duration / seconds_each), F.lit(least)), F.lit(most)).cast("int"))


def sample_times(start, end, count) -> Column:
    """Times at the middles of ``count`` equal parts of a span, to four places; of one part, its start; of
    none, none.
    """
    step = (end - start) / F.greatest(count, F.lit(1))
    middles = F.transform(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1), lambda i: F.bround(start + (i + 0.5) * step, 4))
    return F.when(count <= 0, F.array().cast("array<double>")).when(count == 1, F.array(start)).otherwise(middles)


def thinned(items: Column, most: int) -> Column:
    """At most ``most`` items, evenly spread, in order."""
    n = F.size(items)
    at = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda i: F.floor((i + 0.5) * n / most).cast("int")))
    return F.when(n <= most, items).otherwise(F.transform(at, lambda i: F.get(items, i)))


def rosters(present: DataFrame, shots: DataFrame, keys: Sequence[str] = KEYS, least=0.2) -> DataFrame:
    """The faces in view of each shot for ``least`` or longer, sorted; shots without any have none.

    ``present``: face, start, end.  Spans are merged, so those clipped to a shot do not overlap.
    """
    k = list(keys)
    clipped = within(merge(present, [*k, "face"]), shots, [*k, "face"], k)
    seen = clipped.groupBy(*k, "index", "face").agg(F.sum(F.col("end") - F.col("start")).alias("length")).where(F.col("length") >= least)
    named = seen.groupBy(*k, "index").agg(F.array_sort(F.collect_set("face")).alias("roster"))
    return shots.join(named, [*k, "index"], "left").withColumn("roster", F.coalesce("roster", F.array().cast("array<string>")))


def checked_caption(rows: DataFrame) -> DataFrame:
    """Captions (``text, roster, known``) without ids that their roster lacks, and why they are doubtful."""
    named = rows.withColumn("referenced", references(F.col("text"))).withColumn("dropped", F.array_except("referenced", "roster"))
    kept = without_references(F.col("text"), F.col("dropped"))
    flags = F.array_compact(
        F.array(
            F.when(F.size(F.array_except("dropped", "known")) > 0, "invented"),
            F.when(F.size(F.array_intersect("dropped", "known")) > 0, "misattributed"),
            F.when(kept == "", "empty"),
        )
    )
    return named.withColumn("caption", kept).withColumn("flags", flags)


def clamp_box(x, y, w, h, width, height) -> dict[str, Column]:
    """A box of whole numbers cut to the frame, not moved into it: x, y, width, height."""
    left, top = (F.greatest(F.lit(0), F.least(v, most)) for v, most in ((x, width), (y, height)))
    right, bottom = (F.greatest(at, F.least(v + size, most)) for at, v, size, most in ((left, x, w, width), (top, y, h, height)))
    return {"x": left, "y": top, "width": right - left, "height": bottom - top}


def crop_box(x, y, w, h, width, height, margin=0.0) -> dict[str, Column]:
    """A box grown by ``margin`` of its size on each side, its origin and size rounded (half to even),
    and cut to the frame: x, y, width, height.  A box without area stays without, where it is.
    """
    whole = lambda v: F.bround(v).cast("int")
    cut = clamp_box(whole(x - w * margin), whole(y - h * margin), whole(w + 2 * margin * w), whole(h + 2 * margin * h), width, height)
    flat = (w <= 0) | (h <= 0)
    least = {"x": x.cast("int"), "y": y.cast("int"), "width": F.lit(0), "height": F.lit(0)}
    return {k: F.when(flat, least[k]).otherwise(v) for k, v in cut.items()}


def box_area(width, height) -> Column:
    """Area of a box, 0 where a side is below 0."""
    return F.greatest(F.lit(0), width) * F.greatest(F.lit(0), height)


def box_points(x, y, w, h) -> dict[str, Column]:
    """A box's centre and its far corner."""
    return {"cx": x + w / 2, "cy": y + h / 2, "x2": x + w, "y2": y + h}


def mouth(landmarks: Column) -> Column:
    """The two corners of the mouth, the last of five landmarks; null where there are fewer."""
    return F.when(F.size(landmarks) >= 5, F.slice(landmarks, 4, 2))


def even_size(width, height, most=448) -> tuple[Column, Column]:
    """A frame scaled down to ``most`` on its longer edge, both edges even and at least 2."""
    scale = F.least(F.lit(1.0), F.lit(float(most)) / F.greatest(width, height))
    even = lambda v: F.greatest(F.lit(2), F.floor(F.bround(v * scale) / 2).cast("int") * 2)
    return even(width), even(height)


def people_line(roster: Column) -> Column:
    """Who may be named in a caption; that nobody is in view is said too."""
    names = F.array_join(roster, ", ")
    return F.when(F.size(roster) == 0, "No tracked people are in view.").otherwise(F.concat(F.lit("In view are: "), names, F.lit(". Call them by these identifiers and use no others.")))


def shot_prompt(index: Column, start: Column, end: Column, roster: Column, total: Column | None = None, rules: str = "") -> Column:
    """What a captioner is asked of a shot; ``rules`` are added as they are."""
    of = F.lit("") if total is None else F.concat(F.lit(" of "), total.cast("string"))
    head = F.concat(F.format_string("Frames of shot %d", index), of, F.format_string(", from %.1f to %.1f seconds.", start.cast("double"), end.cast("double")))
    return F.concat_ws("\n", head, people_line(roster), F.lit("Describe the place, the light and what people do."), F.nullif(F.lit(rules), F.lit("")))


def global_prompt(roster: Column, frames: Column, shots: Column, rules: str = "") -> Column:
    """What a captioner is asked of a whole video."""
    head = F.format_string("%d frames of a video of %d shots, one from each.", frames, shots)
    return F.concat_ws("\n", head, people_line(roster), F.lit("Describe in one sentence where it takes place and who is in it."), F.nullif(F.lit(rules), F.lit("")))
