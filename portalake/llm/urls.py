"""URL filters: a temporal list join.

Lists change: an entry (a host, a domain, or a host with a path prefix) is blocked from one
date, released at another, blocked anew. The dated entries become validity intervals, and each
capture is judged by the entry that was active when it was fetched: an equi-join on the keys a
URL can match (its host, every parent domain, every path prefix) with an as-of condition on
the date. The most specific active entry decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_START = r"^[A-Za-z][A-Za-z0-9+.-]*://"


def host(url: Column) -> Column:
    """Host of an absolute URL in lower case, without user, port and a closing dot; else null."""
    raw = F.regexp_extract(url, _START + r"([^/?#\\]*)", 1)
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(raw, r"^.*@", ""), r":[0-9]*$", ""), r"\.+$", "")
    return F.when(bare != "", F.lower(bare))


def path_parts(url: Column) -> Column:
    """Segments of the path, without empty ones."""
    path = F.regexp_extract(url, _START + r"[^/?#\\]*([^?#]*)", 1)
    return F.filter(F.split(path, "/", -1), lambda x: x != "")


def depth(pattern: Column) -> Column:
    return F.size(F.split(pattern, "/", -1)) - 1


def normal_pattern(pattern: Column) -> Column:
    """A list entry as keys are written: lower-case host, no closing dot or slash."""
    at = F.instr(pattern, "/")
    name = F.lower(F.when(at > 0, F.left(pattern, at - 1)).otherwise(pattern))
    rest = F.when(at > 0, F.substr(pattern, at)).otherwise(F.lit(""))
    return F.concat(F.regexp_replace(name, r"\.+$", ""), F.regexp_replace(F.regexp_replace(rest, "/+", "/"), "/$", ""))


def intervals(entries: DataFrame) -> DataFrame:
    """``pattern``, ``action`` ('block' or 'allow'), ``since`` -> ``pattern, action, since, until``.

    An entry holds from its date to the date of the pattern's next entry, that day excluded; the
    last one has no end. Of several of one date the block holds. Repeated rows count once, rows
    with a null pattern, date or action are left out.
    """
    clean = (entries.select(normal_pattern(F.col("pattern").cast("string")).alias("pattern"), "action", F.col("since").cast("date").alias("since"))
             .where(F.col("pattern").isNotNull() & (F.col("pattern") != "") & F.col("since").isNotNull() & F.col("action").isin("block", "allow"))
             .groupBy("pattern", "since").agg(F.max("action").alias("action")))
    return clean.withColumn("until", F.lead("since").over(W.partitionBy("pattern").orderBy("since")))


def keys(url: Column, path_depth: int) -> Column:
    """All a URL can be listed under: host and parent domains, and the host with each path prefix
    of up to ``path_depth`` segments."""
    labels, name, parts = F.split(host(url), r"\.", -1), host(url), path_parts(url)
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    n = F.least(F.size(parts), F.lit(path_depth))
    paths = F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                                      lambda i: F.concat(name, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/"))))
    return F.when(name.isNotNull(), F.concat(domains, F.coalesce(paths, F.array().cast("array<string>"))))


def judge(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url",
          time_col: str = "fetched") -> DataFrame:
    """One row per row of ``captures``: ``id, url_host, fetched, blocked, pattern, action, since``.

    ``pattern`` is the most specific entry active on the day of the fetch (a longer path, then
    more labels), null if there is none; ``blocked`` says whether it blocks. A null or relative
    URL and a null date match nothing and stay, not blocked. Repeated captures give repeated
    rows. An empty list blocks nothing. Other columns aren't read.

    A host with a third of all captures: the list side has few rows for each key, so the join
    can be split (or sent to all tasks, which Spark decides by size), and captures are folded
    to distinct (host, path key, day) before it, so a hot page is judged once for each day.
    """
    spans = intervals(entries)
    deepest = spans.agg(F.max(depth(F.col("pattern")))).first()[0] or 0
    name, parts, day = host(F.col("url")), path_parts(F.col("url")), F.col("fetched").cast("date")
    rows = captures.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(time_col).alias("fetched"))
    place = F.array_join(F.concat(F.array(name), F.slice(parts, 1, deepest) if deepest else F.array().cast("array<string>")), "/")
    rows = rows.select("id", name.alias("url_host"), "fetched", day.alias("day"), F.when(name.isNotNull(), place).alias("place"))
    cases = rows.where(F.col("place").isNotNull() & F.col("day").isNotNull()).select("place", "day").distinct()
    tried = cases.select("place", "day", F.explode(keys(F.concat(F.lit("x://"), F.col("place")), deepest)).alias("pattern"))
    active = (F.col("day") >= F.col("since")) & (F.col("until").isNull() | (F.col("day") < F.col("until")))
    best = (tried.join(spans, "pattern").where(active).groupBy("place", "day")
            .agg(F.max(F.struct(depth(F.col("pattern")).alias("d"), F.length("pattern").alias("n"), "action", "pattern", "since")).alias("m")))
    return (rows.join(best, ["place", "day"], "left")
            .select("id", "url_host", "fetched", F.coalesce(F.col("m.action") == "block", F.lit(False)).alias("blocked"),
                    F.col("m.pattern").alias("pattern"), F.col("m.action").alias("action"), F.col("m.since").alias("since")))
