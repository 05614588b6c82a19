"""Text functions of the annotation formats, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNRENDERABLE = r"[<>\n\r]"


def tag(c: Column) -> Column:
    """A tag trimmed and lower-cased; blank is null."""
    return F.nullif(F.lower(F.trim(c)), F.lit(""))


def slug(c: Column) -> Column:
    """Lower-case words joined by ``-``."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"(?U)[\W_]+", "-"), "^-+|-+$", "")


def is_tag(c: Column) -> Column:
    return c.rlike(r"(?U)^[\w-]+$")


def face_id(n: Column) -> Column:
    """``F001`` from 1; numbers below 1 have none."""
    return F.when(n >= 1, F.format_string("F%03d", n))


def face_number(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"^F(\d+)$", 1), F.lit("")).cast("int")


def squeezed(c: Column) -> Column:
    """White space collapsed to single spaces and trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def speaker_name(c: Column) -> Column:
    """``spk_03`` for a number, else ``spk_`` and the text."""
    number = c.try_cast("int")
    return F.when(number.isNotNull(), F.format_string("spk_%02d", number)).otherwise(F.concat(F.lit("spk_"), F.trim(c)))


def clipped(c: Column, most: int = 160) -> Column:
    """An error message on one line, cut to ``most`` characters with an ellipsis."""
    one = squeezed(c)
    return F.when(F.length(one) > most, F.concat(F.substring(one, 1, most - 1), F.lit("…"))).otherwise(one)


def duration_text(seconds: Column) -> Column:
    """``1h 04m 09s``, ``4m 09s`` or ``9s``."""
    s = F.bround(seconds).cast("long")
    h, m, r = F.floor(s / 3600).cast("long"), F.floor(s / 60).cast("long") % 60, s % 60
    return F.when(h > 0, F.format_string("%dh %02dm %02ds", h, m, r)).when(m > 0, F.format_string("%dm %02ds", m, r)).otherwise(F.format_string("%ds", r))


def unrenderable(text: Column, label: Column) -> Column:
    """Why an utterance can't be written as a line; null where it can."""
    return (
        F.when(text.isNull() | (F.trim(text) == ""), "empty text")
        .when(text.rlike(UNRENDERABLE), "text has a character that the script reserves")
        .when(label.isNotNull() & ~is_tag(label), "tag is not a word")
    )


def utterance_line(face: Column, label: Column, text: Column) -> Column:
    """``<F001> tag: <S>text<E>``."""
    return F.concat(F.lit("<"), face, F.lit("> "), F.coalesce(F.concat(label, F.lit(": ")), F.lit("")), F.lit("<S>"), F.trim(text), F.lit("<E>"))


def references(text: Column) -> Column:
    """Distinct face ids named in a text, in order of first mention."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"\b(F\d{3})\b"), F.lit(1)))


def without_references(text: Column, dropped: Column) -> Column:
    """The text without the dropped ids and with its spacing mended; only stripped if none is dropped."""
    gone = F.aggregate(dropped, text, lambda acc, name: F.regexp_replace(acc, F.concat(F.lit(r"\b"), name, F.lit(r"\b")), F.lit("")))
    mended = F.regexp_replace(F.regexp_replace(gone, "[ \t]{2,}", " "), r"\s+([,.;:!?])", "$1")
    mended = F.regexp_replace(F.trim(mended), "^[ ,;:]+|[ ,;:]+$", "")
    return F.when(F.size(dropped) == 0, F.trim(text)).otherwise(F.trim(mended))


def iou(ax, ay, aw, ah, bx, by, bw, bh) -> Column:
    """Intersection over union of two boxes, 0 where they touch or lack area."""
    w = F.greatest(F.lit(0.0), F.least(ax + aw, bx + bw) - F.greatest(ax, bx))
    h = F.greatest(F.lit(0.0), F.least(ay + ah, by + bh) - F.greatest(ay, by))
    union = aw * ah + bw * bh - w * h
    return F.when((w > 0) & (h > 0) & (union > 0), w * h / union).otherwise(0.0)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors, 0 where one has no length."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm).otherwise(0.0)
