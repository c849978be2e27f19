"""Rows from stored HTML pages and JSON responses, as column expressions; chart rows from arrays of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..operators.keys import once
from .chart_pages import BLANKS, NAMES, rows_of


def _numbered(reference: Column) -> Column:
    """The character of a numeric reference, NULL if there is none."""
    number = F.when(F.rlike(reference, F.lit(r"^#[0-9]{1,7}\z")), F.substring(reference, 2, 7).try_cast("int")).when(
        F.rlike(reference, F.lit(r"^#[xX][0-9a-fA-F]{1,6}\z")), F.conv(F.substring(reference, 3, 6), 16, 10).try_cast("int"))
    return S.bound(number, lambda n: F.when(n.between(1, 0xD7FF) | n.between(0xE000, 0x10FFFF), F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")))


def _named(reference: Column) -> Column:
    """The character of a name, NULL if there is none; looked up among the names with the same first letter."""
    initials: dict[str, list[Column]] = {}
    for name, character in NAMES.items():
        initials.setdefault(name[0], []).extend((F.lit(name), F.lit(character)))
    names = F.create_map(*[x for initial, own in initials.items() for x in (F.lit(initial), F.create_map(*own))])
    return F.try_element_at(F.try_element_at(names, F.left(reference, F.lit(1))), reference)


def _character(reference: Column) -> Column:
    """The character of a reference without ``&`` and ``;``, NULL if there is none."""
    return F.when(F.startswith(reference, F.lit("#")), _numbered(reference)).otherwise(_named(reference))


def decode_references(text: Column) -> Column:
    """Named and numeric character references replaced, each once; unknown ones stay."""
    def part(p: Column, i: Column) -> Column:
        def decoded(reference: Column) -> Column:
            rest = F.concat(_character(reference), F.substring(p, F.length(reference) + 2, F.length(p)))
            return F.coalesce(rest, F.concat(F.lit("&"), p))
        ended = F.when(F.contains(p, F.lit(";")), F.substring_index(p, ";", 1))
        return F.when(i == 0, p).otherwise(S.bound(ended, decoded))
    parts = F.transform(F.split(text, "&", -1), part)
    return F.when(F.contains(text, F.lit("&")), F.array_join(parts, "")).otherwise(text)


def first_table(html) -> Column:
    """The inside of the first table, up to its own end tag: tables within it are part of it."""
    simple = F.regexp_extract(html, r"(?is)<table(?=[\s>])[^>]*>(.*?)</table\s*>", 1)
    start = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("done"), F.array().cast("array<string>").alias("inside"))

    def step(state: Column, piece: Column) -> Column:
        opens, closes = F.rlike(piece, F.lit(r"(?i)^<table[\s>]")), F.rlike(piece, F.lit(r"(?i)^</table[\s>]"))
        depth = state["depth"] + F.when(opens, 1).when(closes & (state["depth"] > 0), -1).otherwise(0)
        held = F.when((depth > 0) & ~state["done"], F.array_append(state["inside"], piece)).otherwise(state["inside"])
        return F.struct(depth.alias("depth"), (state["done"] | (closes & (state["depth"] == 1))).alias("done"), held.alias("inside"))
    def inside(pieces: Column) -> Column:
        nested = F.aggregate(pieces, start, step, lambda state: F.regexp_replace(
            F.array_join(state["inside"], ""), r"(?is)^<table(?=[\s>])[^>]*>", ""))
        several = F.size(F.filter(pieces, lambda piece: F.rlike(piece, F.lit(r"(?i)^<table[\s>]")))) > 1
        return F.when(several, nested).otherwise(simple)
    return S.bound(F.split(html, r"(?i)(?=</?table[\s>])", -1), inside)


def cell_text(html: Column) -> Column:
    """Text of a cell: its text nodes trimmed and joined, character references decoded."""
    bare = F.when(F.contains(html, F.lit("<")), F.regexp_replace(html, r"\s*<[^>]*>\s*", "")).otherwise(html)
    return F.btrim(decode_references(bare), F.lit(BLANKS))


def table_cells(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """``(keep..., row_no, cells)`` of the first table of every page, header row left out.

    ``cells`` holds the raw inner HTML; a row is parsed once.
    """
    rows = F.regexp_extract_all(first_table(F.col(html)), F.lit(r"(?is)<tr(?=[\s>])[^>]*>(.*?)</tr\s*>"), F.lit(1))
    cells = F.regexp_extract_all("tr", F.lit(r"(?is)<td(?=[\s>])[^>]*>(.*?)</td\s*>"), F.lit(1))
    found = pages.select(*keep, F.posexplode(rows).alias("row_no", "tr")).where(F.col("row_no") > 0)
    return once(found, cells=cells).drop("tr")


def chart_rows(pages: DataFrame, *, html: str = "html", year: str = "year") -> DataFrame:
    """Chart rows of all pages in one scan, each stamped with its page's year.

    Rows with fewer than three cells or unreadable numbers are dropped. The cells
    are those of ``table_cells`` and their texts those of ``cell_text``, read from
    arrays of whole pages.
    """
    read = pages.select(F.col(year).alias("stamp"), F.col(html).cast("binary").alias("html"))
    found = T.StructType([read.schema["stamp"], *[T.StructField(n, t()) for n, t in (
        ("text", T.StringType), ("streams", T.LongType), ("daily", T.LongType))]])
    return read.mapInArrow(rows_of, found).select(
        F.col("text").alias("Artist and Title"), S.artist_part("text").alias("Artist"),
        S.title_part("text").alias("Title"), F.col("streams").alias("Streams"), F.col("daily").alias("Daily"),
        F.col("stamp").cast("int").alias("Year"))


def list_items(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """``(keep..., item_no, item)`` of every list item of a page."""
    items = F.regexp_extract_all(html, F.lit(r"(?is)<li(?=[\s>])[^>]*>(.*?)</li\s*>"), F.lit(1))
    return pages.select(*keep, F.posexplode(items).alias("item_no", "li")).select(
        *keep, "item_no", cell_text(F.col("li")).alias("item"))


def require_rows(df: DataFrame) -> DataFrame:
    """The table itself, or an error when no page gave a row."""
    if df.isEmpty():
        raise ValueError("no rows were extracted")
    return df


def content_id(response) -> Column:
    """Id of the first content entry of a stored search response, else NULL."""
    return F.get_json_object(response, "$.content[0].id")


def feature_map(response) -> Column:
    """Numbers of a stored response by name; members that are no numbers are NULL, and so is what does not parse."""
    members = F.from_json(response, "map<string,string>")
    return F.transform_values(members, lambda _, v: v.try_cast("double"))


_MEMBERS = "map<string,variant>"


def _is_object(v: Column) -> Column:
    return F.schema_of_variant(v).startswith("OBJECT")


def _members(response: str, depth: int) -> Column:
    """``array<struct<key, value>>``: members by dotted name, objects down to ``depth`` replaced by their own members."""
    found = F.map_entries(F.try_variant_get(F.try_parse_json(F.col(response)), "$", _MEMBERS))

    def opened(e: Column) -> Column:
        inner = F.map_entries(F.try_variant_get(e["value"], "$", _MEMBERS))
        named = F.transform(inner, lambda x: F.struct(F.concat(e["key"], F.lit("."), x["key"]).alias("key"), x["value"].alias("value")))
        return F.when(_is_object(e["value"]), named).otherwise(F.array(e))
    for _ in range(depth):
        found = F.flatten(F.transform(found, opened))
    return found


def nesting(df: DataFrame, response: str) -> int:
    """How many levels of objects within objects the responses have; one pass of the table for each level."""
    depth = 0
    while not df.where(F.exists(_members(response, depth), lambda e: _is_object(e["value"]))).isEmpty():
        depth += 1
    return depth


def feature_rows(df: DataFrame, keep: list[str], response: str, *, depth: int | None = None) -> DataFrame:
    """``(keep..., feature, value)``: a row per member of every response, whatever the names and however deep.

    A member of a member is named ``outer.inner``. Numbers and numbers in quotes
    are values, everything else is NULL; an empty object has no members, and what
    does not parse gives no rows. Without ``depth`` the table is looked through first.
    """
    levels = nesting(df, response) if depth is None else depth
    found = df.select(*keep, F.inline(_members(response, levels)).alias("feature", "__value"))
    return found.select(*keep, "feature", F.try_variant_get("__value", "$", "string").try_cast("double").alias("value"))


def with_all_features(df: DataFrame, response: str, *, most: int = 10_000) -> DataFrame:
    """One column per member that any response has, in alphabetical order, NULL where a response lacks it.

    The names are read from the table first; more than ``most`` of them are an error, for then rows are the right shape.
    """
    depth = nesting(df, response)
    names = sorted(r.feature for r in feature_rows(df, [], response, depth=depth).select("feature").distinct().limit(most + 1).collect())
    if len(names) > most:
        raise ValueError(f"more than {most} names: use feature_rows")
    found = F.map_from_entries(F.transform(_members(response, depth), lambda e: F.struct(
        e["key"], F.try_variant_get(e["value"], "$", "string").try_cast("double").alias("value"))))
    return once(df, __m=found).withColumns({n: F.try_element_at("__m", F.lit(n)) for n in names}).drop("__m")


def with_features(df: DataFrame, response: str, names: list[str]) -> DataFrame:
    """One column per named feature, NULL where a response lacks it."""
    m = feature_map(F.col(response))
    return df.withColumn("__m", m).withColumns({n: F.col("__m")[n] for n in names}).drop("__m")
