"""Column expressions. All are built-in Spark functions, so they stay in codegen."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab

MARKER = r"\[[^\n]*?\]"
NOT_WORD = r"[^\p{L}\p{N}_\s]"
NUMBER = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also where Spark would compute it again in every branch of a condition."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


# --- text -----------------------------------------------------------------

def strip_markers(text, replacement: str = " ") -> Column:
    """Replace bracketed markers such as ``[Chorus]`` that close on their line."""
    return F.regexp_replace(col(text), MARKER, replacement)


def punctuation_to_space(text) -> Column:
    """Everything but Unicode letters, digits, underscore and blanks becomes a space."""
    return F.regexp_replace(col(text), NOT_WORD, " ")


def tokens(text) -> Column:
    """Lowercase words of a text, in order."""
    return F.array_remove(F.split(F.lower(col(text)), r"\s+"), "")


def lyric_tokens(text) -> Column:
    """Words of a lyric: lowercase, markers and punctuation removed."""
    return tokens(punctuation_to_space(strip_markers(F.lower(col(text)))))


def collapse_newlines(text) -> Column:
    return F.regexp_replace(col(text), r"[\r\n]+", " ")


def trim_chars(text, chars: str = "'\"*.-[] ") -> Column:
    return F.btrim(col(text), F.lit(chars))


def strip_blanks(text) -> Column:
    """Without the white space around it, line ends included."""
    return F.regexp_replace(col(text), r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def is_blank(text) -> Column:
    """True for NULL and for text of blanks only."""
    return ~F.coalesce(F.rlike(col(text), F.lit(r"[^\s\p{Z}]")), F.lit(False))


def contained_label(low: Column, otherwise: Column, labels: list[str] | None = None) -> Column:
    """First label contained in a lower-case text, else another value."""
    return F.coalesce(*[F.when(F.contains(low, F.lit(v.lower())), F.lit(v)) for v in labels or vocab.TOPICS], otherwise)


def without_marks(text) -> Column:
    return trim_chars(strip_blanks(text))


def canonical_label(text, labels: list[str] | None = None) -> Column:
    """First label contained in the text, ignoring case; else the text without blanks and marks around it."""
    return contained_label(F.lower(without_marks(text)), without_marks(text), labels)


def prefix(text, n: int) -> Column:
    """The first ``n`` characters, as a bounded prompt takes them."""
    return F.left(col(text), F.lit(n))


def slug(text) -> Column:
    """Lowercase identifier; NULL and empty become ``unknown``."""
    t = col(text)
    made = F.lower(F.regexp_replace(t, "[^a-zA-Z0-9]", "-"))
    return F.when(t.isNull() | (t == ""), F.lit("unknown")).otherwise(made)


def title_label(name, overrides: dict[str, str] | None = None) -> Column:
    """Underscores to spaces and a capital at each word start, the rest unchanged."""
    name = col(name)
    spaced = F.regexp_replace(name, "_", " ")
    parts = F.split(spaced, r"(?<=[^A-Za-z0-9_])")
    label = F.array_join(
        F.transform(parts, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substring(w, 2, 1 << 30))), "")
    for key, text in (vocab.LABEL_OVERRIDES if overrides is None else overrides).items():
        label = F.when(name == key, F.lit(text)).otherwise(label)
    return label


def short_label(label, short: dict[str, str] | None = None) -> Column:
    label = col(label)
    out = label
    for long, abbreviation in (short or vocab.SHORT_LABELS).items():
        out = F.when(label == long, F.lit(abbreviation)).otherwise(out)
    return out


def abbreviate(text, n: int) -> Column:
    """Cut text longer than ``n`` to ``n - 2`` characters and an ellipsis."""
    t = col(text)
    return F.when(F.length(t) > n, F.concat(F.left(t, F.lit(n - 2)), F.lit("..."))).otherwise(t)


# --- artist, title, identifiers --------------------------------------------

def _before_separator(text: Column) -> Column:
    return F.trim(F.substring_index(text, " - ", 1))


def _after_separator(text: Column) -> Column:
    """NULL without a separator."""
    at = F.instr(text, " - ")
    return F.when(at > 0, F.trim(F.substring(text, at + 3, F.length(text))))


def artist_part(artist_title) -> Column:
    return _before_separator(col(artist_title))


def title_part(artist_title) -> Column:
    """Text after the first separator; empty when there is none."""
    text = col(artist_title)
    return F.when(text.isNotNull(), F.coalesce(_after_separator(text), F.lit("")))


def backfill_title(title, artist_title) -> Column:
    """Blank titles come from the text after the separator, else the whole text."""
    text = col(artist_title)
    filled = F.coalesce(_after_separator(text), text)
    return F.when(is_blank(title), F.coalesce(filled, col(title))).otherwise(col(title))


def id_from_url(url) -> Column:
    """Track id in a URL, or a bare 22-character id, or NULL."""
    u = col(url)
    bare = F.when((F.length(u) == 22) & ~F.contains(u, F.lit("/")), u)
    return F.coalesce(F.nullif(F.regexp_extract(u, "track/([a-zA-Z0-9]+)", 1), F.lit("")), bare)


def embed_url(url, old: str = "/track/", new: str = "/embed/track/") -> Column:
    """Rewrite the first occurrence of a path part."""
    u = col(url)
    at = F.locate(old, u)
    rewritten = F.concat(F.left(u, at - 1), F.lit(new), F.substr(u, at + F.lit(len(old))))
    return F.when(at > 0, rewritten).otherwise(u)


# --- numbers ----------------------------------------------------------------

def prefix_float(text) -> Column:
    """Leading number of a text (``'12abc'`` is 12), or NULL."""
    found = F.regexp_extract(col(text).cast("string"), rf"^\s*({NUMBER})", 1)
    return F.nullif(found, F.lit("")).cast("double")


def prefix_int(text) -> Column:
    found = F.regexp_extract(col(text).cast("string"), r"^\s*([-+]?\d+)", 1)
    return F.nullif(found, F.lit("")).try_cast("bigint")


def whole_float(text) -> Column:
    """The number a text consists of (surrounding blanks allowed), or NULL."""
    found = F.regexp_extract(col(text).cast("string"), rf"^\s*({NUMBER})\s*$", 1)
    return F.nullif(found, F.lit("")).cast("double")


def coerce_number(text, default: float = 0.0) -> Column:
    return F.coalesce(whole_float(text), F.lit(default))


def grouped_int(text) -> Column:
    """Integer with comma grouping, or NULL when it is not one."""
    bare = F.trim(F.replace(col(text), F.lit(","), F.lit("")))
    return F.when(F.rlike(bare, F.lit(r"^[-+]?\d+$")), bare.try_cast("bigint"))


def as_int(value) -> Column:
    """Integer from a number or numeric text such as ``'2010.0'``; NULL when not numeric."""
    return whole_float(value).try_cast("int")


def min_max(value, low, high) -> Column:
    """Position of a value within its bounds; 0 when the bounds coincide."""
    v, lo, hi = col(value), _lit(low), _lit(high)
    return F.when(hi == lo, F.lit(0.0)).otherwise((v - lo) / F.nullif(hi - lo, F.lit(0.0)))


def _lit(value) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))


def minutes(ms) -> Column:
    ms = col(ms)
    return F.when(ms > 0, ms / F.lit(60000.0)).otherwise(F.lit(0.0))


def duration_text(fractional_minutes, carry: bool = False) -> Column:
    """``M.SS``. Seconds may round to 60 unless ``carry`` moves them into the minute."""
    m = col(fractional_minutes)
    whole = F.floor(m)
    seconds = F.floor((m - whole) * 60 + 0.5)
    if carry:
        total = F.floor(m * 60 + 0.5)
        whole, seconds = F.floor(total / 60), total % 60
    return F.format_string("%d.%02d", whole.cast("bigint"), seconds.cast("bigint"))


def fixed_text(value, places: int, minus: str = "−") -> Column:
    """Fixed-point text, halves rounded away from zero, with a typographic minus."""
    text = F.format_string(f"%.{places}f", col(value).cast("double"))
    return F.regexp_replace(text, "^-", minus)


def feature_text(feature, value) -> Column:
    """Tempo without decimals, duration as ``M.SS``, everything else with two."""
    f = col(feature)
    return (F.when(f == "duration_min", duration_text(value))
            .when(f == "tempo", fixed_text(value, 0))
            .otherwise(fixed_text(value, 2)))


def summary_text(value, upper) -> Column:
    """No decimals for features whose upper bound exceeds 100, else two."""
    return F.when(_lit(upper) > 100, fixed_text(value, 0)).otherwise(fixed_text(value, 2))


def sqrt_scale(value, low, high, range_low: float, range_high: float) -> Column:
    """Map a value to a mark size on a square-root scale."""
    v, lo, hi = F.sqrt(col(value)), F.sqrt(_lit(low)), F.sqrt(_lit(high))
    mid = F.lit((range_low + range_high) / 2)
    scaled = (v - lo) / F.nullif(hi - lo, F.lit(0.0)) * (range_high - range_low) + range_low
    return F.when(hi == lo, mid).otherwise(scaled)


def linear_scale(value, low, high, range_low: float = 0.0, range_high: float = 1.0) -> Column:
    v, lo, hi = col(value), _lit(low), _lit(high)
    mid = F.lit((range_low + range_high) / 2)
    scaled = (v - lo) / F.nullif(hi - lo, F.lit(0.0)) * (range_high - range_low) + range_low
    return F.when(hi == lo, mid).otherwise(scaled)


def epanechnikov(distance, h: float) -> Column:
    u = col(distance) / h
    return F.when(F.abs(u) <= 1, 0.75 * (1 - u * u) / h).otherwise(0.0)


def present(value) -> Column:
    """Neither NULL nor NaN."""
    v = col(value)
    return v.isNotNull() & ~F.isnan(v.cast("double"))


# --- keys, quadrants, polar positions ----------------------------------------

def key_name(key, mode=None) -> Column:
    """Note name of a key number; minor keys (mode 0) carry an ``m``."""
    name = F.get(F.array(*[F.lit(k) for k in vocab.KEY_NAMES]), col(key).cast("int"))
    if mode is None:
        return name
    return F.when(col(mode) == 0, F.concat(name, F.lit("m"))).otherwise(name)


def relative_minor(key) -> Column:
    return (col(key) + 9) % 12


def quadrant(x: str, y: str, names: tuple[str, str, str, str] | None = None, split: float = 0.5) -> Column:
    """Name of the quadrant a point lies in; points on the split go right and up."""
    tr, tl, bl, br = names or vocab.QUADRANTS[(x, y)]
    right, up = F.col(x) >= split, F.col(y) >= split
    return (F.when(~(present(x) & present(y)), F.lit(None))
            .when(right & up, F.lit(tr)).when(up, F.lit(tl))
            .when(right, F.lit(br)).otherwise(F.lit(bl)))


def polar_point(key, score, radius: float) -> tuple[Column, Column]:
    """Position on a dial: the key gives the angle, the score in [-1, 1] the radius."""
    angle = col(key) * F.pi() / 6 - F.pi() / 2
    r = linear_scale(score, -1, 1, 0, radius)
    return r * F.cos(angle), r * F.sin(angle)
