"""URL filter: rules on host and path, carried over to the aliases of a page.

A meta refresh and a canonical link say that two addresses are one page. These
edges join addresses to components; a component with a blocked member is
blocked, unless one of its members is explicitly allowed. A page that a rule
fits keeps that rule's verdict. Only columns and joins are used: no Python
touches a row.

Rules are a table of any size. A host asks for the suffixes of itself that have
as many labels as some rule, a path for the prefixes as long as some rule of
that host, so every rule is met by an equality and none is compared with all urls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import lookup
from .graph import components
from .registry import query, table
from .store import stored

# The rules of the registered query as verdict, host, path.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Patterns that read the same in Spark and in the check SQL.
ORIGIN = r"(?s)^(.*?://[^/?#]*)"
HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
PARAMETERS = r"(?s)^.*?://[^?#]*\?([^#]*)"
#: Parameters that name where a visitor came from, not what the page holds.
TRACKING = r"(?i)^(?:utm_[a-z]+|gclid|fbclid)(?:=|$)"
SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"
MAY_LINK = r"(?i)canonical|http-equiv"
NO_MARKUP = r"(?is)<!--.*?-->|<(?:script|style)\b.*?</(?:script|style)\s*>"
TAG = r"(?is)<(?:link|meta)\b[^>]*>"
IS_CANONICAL = r"""(?is)^<link\b.*\srel\s*=\s*(?:"(?:[^"]*\s)?canonical["\s]|'(?:[^']*\s)?canonical['\s]|canonical[\s/>])"""
IS_REFRESH = r"""(?is)^<meta\b.*\shttp-equiv\s*=\s*["']?\s*refresh\b"""
HREF = r"""(?is)\shref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
CONTENT = r"""(?is)\scontent\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
AFTER_DELAY = r"""(?is)^["'\s]*[0-9.]*\s*[;,]\s*(?:url\s*=)?(.*)$"""
AROUND = r"""^["'\s]+|["'\s]+$"""
AMPERSAND = r"(?i)&(?:amp|#38|#x26);"


def host_of(url: Column) -> Column:
    """What stands between ``://`` and the path, A-Z lower-cased; empty for null and for text without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, HOST, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


def address(url: Column) -> Column:
    """One text for all spellings of an address: no scheme, ``www.``, usual port, fragment, tracking parameter or slash at
    the end, parameters in order. Null where there is no ``://``."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r":(?:80|443)$", ""), r"^www\.", "")
    kept = F.filter(F.split(F.regexp_extract(url, PARAMETERS, 1), "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    parameters = F.array_join(F.array_sort(kept), "&")
    return F.when(F.instr(url, "://") > 0, F.concat(
        host, F.regexp_replace(path_of(url), "/+$", ""), F.when(parameters != "", F.concat(F.lit("?"), parameters)).otherwise("")))


def _resolved(url: Column, target: Column) -> Column:
    """An absolute address for a link found on ``url``; null for other schemes and places on the same page. Dots stay as written."""
    origin, scheme = F.regexp_extract(url, ORIGIN, 1), F.regexp_extract(url, SCHEME, 1)
    folder = F.regexp_extract(path_of(url), r"(?s)^(.*/)", 1)
    return (F.when((target == "") | target.startswith("#"), None)
            .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
            .when(target.rlike(SCHEME), None)
            .when((origin == "") | url.isNull(), None)
            .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
            .when(target.startswith("/"), F.concat(origin, target))
            .when(target.startswith("?"), F.concat(origin, path_of(url), target))
            .otherwise(F.concat(origin, F.when(folder == "", "/").otherwise(folder), target)))


def alias_targets(url: Column, html: Column) -> Column:
    """Addresses that the page names as its own: canonical links and meta refreshes outside comments, scripts and styles."""
    def attribute(tag, pattern):
        return F.regexp_replace(F.regexp_replace(F.regexp_extract(tag, pattern, 1), AROUND, ""), AMPERSAND, "&")

    def refresh(tag):
        return F.regexp_replace(F.regexp_extract(attribute(tag, CONTENT), AFTER_DELAY, 1), AROUND, "")
    tags = F.regexp_extract_all(F.regexp_replace(html, NO_MARKUP, " "), F.lit(TAG), F.lit(0))
    found = F.concat(F.transform(F.filter(tags, lambda t: t.rlike(IS_CANONICAL)), lambda t: attribute(t, HREF)),
                     F.transform(F.filter(tags, lambda t: t.rlike(IS_REFRESH)), refresh))
    targets = F.filter(F.transform(found, lambda t: _resolved(url, t)), lambda t: t.isNotNull())
    return F.when(html.rlike(MAY_LINK), targets).otherwise(F.array().cast("array<string>"))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """A short list of rules as the table ``verdict, host, path`` that :func:`judged` takes."""
    made = [F.struct(*[F.lit(v).alias(n) for n, v in zip(("verdict", "host", "path"), r, strict=True)]) for r in rules]
    none = F.array().cast("array<struct<verdict:string,host:string,path:string>>")
    return spark.range(1).select(F.inline(F.array(*made) if made else none))


def matched(places: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, path, rule, verdict`` of the different ``host, path`` in ``places`` that a rule fits.

    The longest rule wins, of equally long ones that with the longer host; of equal rules the allowing one. Rules with a null
    in a column fit nothing.
    """
    rules = rules.groupBy("host", "path").agg(F.min("verdict").alias("verdict")).where("host is not null and path is not null and verdict is not null")
    places = places.select("host", "path").distinct()
    labels = rules.select(F.collect_set(F.size(F.split("host", r"\."))).alias("n")).scalar()
    asked = (places.select("host").distinct().withColumn("n", F.explode(labels))
             .where(F.col("n") <= F.size(F.split("host", r"\.")))
             .withColumn("rule_host", F.expr("substring_index(host, '.', -n)")))
    lengths = rules.groupBy(F.col("host").alias("rule_host")).agg(F.collect_set(F.length("path")).alias("lengths"))
    hosts = (lookup(asked, lengths, ["rule_host"], "inner")
             .groupBy("host").agg(F.collect_list(F.struct("rule_host", "lengths")).alias("asked")))
    prefixes = (lookup(places, hosts, ["host"], "inner").select("host", "path", F.inline("asked"))
                .select("host", "path", "rule_host", F.explode("lengths").alias("n")).where("n <= length(path)")
                .select("host", "path", "rule_host", F.expr("left(path, n)").alias("rule_path")))
    known = rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict")
    fits = lookup(prefixes, known, ["rule_host", "rule_path"], "inner")
    size = F.struct(F.length("rule_host") + F.length("rule_path"), F.length("rule_host"))
    best = F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), "verdict"), size).alias("best")
    return fits.groupBy("host", "path").agg(best).select("host", "path", "best.rule", "best.verdict")


def judged(pages: DataFrame, rules: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict, alias`` of every row of ``pages`` (``page_id, url, html``).

    ``rules`` has ``verdict`` (allow or block), ``host``, ``path``; ``links`` may bring further redirects as ``source, target``
    urls, a log of them for example. ``alias`` is the smallest address of the page's component (null without ``://``).
    A page without a rule of its own has its component's verdict: allow if a member is allowed, else block if one is
    blocked, else allow. Members are pages and the addresses that they or ``links`` name.

    Null urls and urls without ``://`` have an empty host and path and no alias; null or empty html has no links; very long
    html is read to its end; repeated rows and null page_ids come back as often as they are there; other columns are not read.
    """
    url, html = F.col("url").cast("string"), F.col("html").cast("string")
    rows = stored(pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"),
                               address(url).alias("key"), alias_targets(url, html).alias("targets")), "addresses")
    named = rows.where("key is not null and size(targets) > 0").select(F.col("key").alias("a"), F.explode("targets").alias("target"))
    if links is not None:
        source = F.col("source").cast("string")
        log = links.select(address(source).alias("a"), F.col("target").cast("string").alias("target"), source.alias("source"))
        named = named.unionByName(log.select("a", "target")).unionByName(log.select("a", F.col("source").alias("target")))
    target = F.col("target")
    edges = stored(named.select("a", address(target).alias("b"), host_of(target).alias("host"), path_of(target).alias("path"))
                   .where("a is not null and b is not null").distinct(), "links")
    verdicts = stored(matched(rows.select("host", "path").unionByName(edges.select("host", "path")), rules), "verdicts")
    members = stored(components(edges.select("a", "b")), "components")

    ends = (lookup(rows.select("key", "host", "path"), members.select(F.col("node").alias("key")), ["key"], "left_semi")
            .unionByName(edges.select(F.col("b").alias("key"), "host", "path")).distinct())
    explicit = lookup(ends, verdicts, ["host", "path"], "inner").groupBy("key").agg(F.min("verdict").alias("verdict"))
    decided = (lookup(explicit, members.select(F.col("node").alias("key"), "component"), ["key"], "inner")
               .groupBy("component").agg(F.min("verdict").alias("shared")))
    carried = lookup(members, decided, ["component"], "left").select(F.col("node").alias("key"), "component", "shared")
    out = lookup(lookup(rows.drop("targets"), verdicts, ["host", "path"], "left"), carried, ["key"], "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", "shared", F.lit("allow")).alias("verdict"),
                      F.coalesce("component", "key").alias("alias"))


def _sql() -> str:
    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    def get(column: str, pattern: str, group: int = 1) -> str:
        return f"regexp_extract({column}, {text(pattern)}, {group})"

    def swap(column: str, pattern: str, by: str) -> str:
        return f"regexp_replace({column}, {text(pattern)}, {text(by)}, 'g')"

    def host(u: str) -> str:
        return f"coalesce(translate({get(u, HOST)}, '{UPPER}', '{LOWER}'), '')"

    def path(u: str) -> str:
        return f"coalesce({get(u, PATH)}, '')"

    def key(u: str) -> str:
        kept = f"list_filter(string_split({get(u, PARAMETERS)}, '&'), lambda p: p <> '' AND NOT regexp_matches(p, {text(TRACKING)}))"
        joined = f"array_to_string(list_sort({kept}), '&')"
        bare = swap(swap(host(u), ":(?:80|443)$", ""), r"^www\.", "")
        return (f"CASE WHEN contains({u}, '://') THEN {bare} || {swap(path(u), '/+$', '')} || "
                f"CASE WHEN {joined} <> '' THEN '?' || {joined} ELSE '' END END")

    def attribute(tag: str, pattern: str) -> str:
        return swap(swap(get(tag, pattern), AROUND, ""), AMPERSAND, "&")
    rules = ", ".join(f"({text(v)}, {text(h)}, {text(p)})" for v, h, p in RULES)
    refresh = swap(get(attribute("t", CONTENT), AFTER_DELAY), AROUND, "")
    folder = get(path("url"), r"(?s)^(.*/)")
    return f"""WITH RECURSIVE r(verdict, host, path) AS (VALUES {rules}),
p AS (SELECT page_id, url, {host('url')} AS host, {path('url')} AS path, {key('url')} AS key, html FROM pages),
tag AS (SELECT url, key, unnest(regexp_extract_all({swap('html', NO_MARKUP, ' ')}, {text(TAG)})) AS t
  FROM p WHERE regexp_matches(html, {text(MAY_LINK)})),
named AS (
  SELECT url, key, {attribute('t', HREF)} AS t FROM tag WHERE regexp_matches(t, {text(IS_CANONICAL)})
  UNION ALL SELECT url, key, {refresh} AS t FROM tag WHERE regexp_matches(t, {text(IS_REFRESH)})),
target AS (SELECT key, CASE WHEN t = '' OR starts_with(t, '#') THEN NULL
  WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t
  WHEN regexp_matches(t, '{SCHEME}') THEN NULL
  WHEN url IS NULL OR {get('url', ORIGIN)} = '' THEN NULL
  WHEN starts_with(t, '//') THEN {get('url', SCHEME)} || ':' || t
  WHEN starts_with(t, '/') THEN {get('url', ORIGIN)} || t
  WHEN starts_with(t, '?') THEN {get('url', ORIGIN)} || {path('url')} || t
  ELSE {get('url', ORIGIN)} || CASE WHEN {folder} = '' THEN '/' ELSE {folder} END || t END AS t FROM named),
link AS (SELECT DISTINCT key AS a, {key('t')} AS b, {host('t')} AS host, {path('t')} AS path FROM target
  WHERE key IS NOT NULL AND t IS NOT NULL AND contains(t, '://')),
place AS (SELECT host, path FROM p UNION SELECT host, path FROM link),
fit AS (SELECT place.host, place.path, arg_max({{'rule': r.host || r.path, 'verdict': r.verdict}}, [length(r.host) + length(r.path), length(r.host)]) AS best
  FROM place JOIN r ON (place.host = r.host OR ends_with(place.host, '.' || r.host)) AND starts_with(place.path, r.path) GROUP BY ALL),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT a AS x, a AS y FROM edge UNION SELECT x, b FROM reach JOIN edge ON y = a),
member AS (SELECT x AS key, min(y) AS component FROM reach GROUP BY x),
explicit AS (SELECT key, best.verdict AS verdict FROM (SELECT key, host, path FROM p UNION SELECT b, host, path FROM link) JOIN fit USING (host, path)),
decided AS (SELECT component, min(verdict) AS shared FROM explicit JOIN member USING (key) GROUP BY component)
SELECT page_id, p.host, p.path, best.rule AS rule, coalesce(best.verdict, shared, 'allow') AS verdict, coalesce(component, p.key) AS alias
FROM p LEFT JOIN fit USING (host, path) LEFT JOIN member USING (key) LEFT JOIN decided USING (component)"""


@query(_sql())
def op12_judged_urls(spark, folder):
    return judged(table(spark, folder, "pages"), rule_table(spark, RULES))
