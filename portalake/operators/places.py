"""Place names -> dataset codes.

The code list is turned once into an index with one row per searchable key, holding every
candidate of that key. Each query then meets at most one index row: an equi join without
fan-out, in place of comparing every query with every name. Queries are made distinct before
they are normalised and resolved, so a name asked a billion times costs one lookup. No side
is broadcast by force: Spark does so where it measures the side small enough, and otherwise
shuffles, splitting hot keys adaptively.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portalake.functions.text import nfc, strip, words

# Short province names that are not part of the full name.
PROVINCE_ALIASES = {
    "충북": "충청북도",
    "충남": "충청남도",
    "경북": "경상북도",
    "경남": "경상남도",
}

# Land forecast zones and their codes.
LAND_ZONES = """
강원영동 11D20000
강원영서 11D10000
경상남도 11H20000
경상도 11H00000
경상북도 11H10000
서울.인천.경기 11B00000
전라남도 11F20000
전라도 11F00000
전북자치도 11F10000
제주도 11G00000
충청남도 11C20000
충청도 11C00000
충청북도 11C10000
평안남도 11J20000
평안북도 11J10000
함경남도 11K20000
함경북도 11K10000
황해도 11I00000
"""

_CITY_SEAM = "시"


def land_zones(spark: SparkSession) -> DataFrame:
    """The land forecast zones: name, code."""
    return spark.createDataFrame([tuple(line.split()) for line in LAND_ZONES.split("\n") if line],
                                 "name string, code string")


def districts_from_legal_codes(codes: DataFrame) -> DataFrame:
    """The district dimension (``sido``, ``sigungu``, ``code``) out of the government's list
    of legal-district codes: ``code`` (10 digits), ``name`` (full, words spaced), ``active``.

    A district is an active code with no parts below its first five digits that is not a
    whole province; its name is the words after the province, joined (``수원시장안구``).
    A province that is its own only district (code ``xx110`` named by one word) repeats it.
    """
    parts = words(F.col("name"))
    level = F.col("active") & F.col("code").endswith("00000") & (F.substring("code", 3, 3) != "000")
    named = F.array_join(F.slice(parts, F.lit(2), F.size(parts)), "")
    return codes.where(level).select(
        parts[0].alias("sido"),
        F.when(named == "", parts[0]).otherwise(named).alias("sigungu"),
        F.substring("code", 1, 5).alias("code"))


def _resolve(queries: DataFrame, query: str, look_up) -> DataFrame:
    """Resolve the distinct values of ``query`` and attach the result to every row. Rows without a
    query have a key of their own each, or they would all meet in one task."""
    distinct = queries.select(F.col(query).alias("_query")).where(
        F.col("_query").isNotNull()).distinct()
    resolved = look_up(distinct.withColumn("_text", nfc("_query"))).withColumn("_spread", F.lit(0).cast("bigint"))
    spread = F.when(F.col(query).isNull(), F.monotonically_increasing_id()).otherwise(0)
    same = (F.col(query) == F.col("_query")) & (F.col("_place") == F.col("_spread"))
    return (queries.withColumn("_place", spread).join(resolved, same, "left").drop("_query", "_place", "_spread")
            .withColumn("status", F.coalesce("status", F.lit("none"))))


def _outcome(found: Column, label) -> list[Column]:
    """``status``, ``code`` and, where there are several, the ``candidates``."""
    n = F.coalesce(F.size(found), F.lit(0))
    return [
        F.when(n == 0, "none").when(n == 1, "ok").otherwise("ambiguous").alias("status"),
        F.when(n == 1, found[0]["code"]).alias("code"),
        F.when(n > 1, F.array_sort(F.transform(found, label))).alias("candidates"),
    ]


def _strict(df: DataFrame, strict: bool) -> DataFrame:
    if not strict:
        return df
    failed = F.raise_error(F.concat(F.lit("place name is "), F.col("status")))
    return df.withColumn("code", F.when(F.col("status") == "ok", F.col("code")).otherwise(failed))


def resolve_region(queries: DataFrame, districts: DataFrame, query: str = "query",
                   strict: bool = False) -> DataFrame:
    """District code of a place name: adds ``status`` (ok, none, ambiguous), ``code`` and the
    ``candidates`` of an ambiguous name.

    The last word names the district, or the ward after a city's ``시`` seam; every word
    before it must be part of the province, its alias, or the start of the district name.
    """
    # Full name plus what follows each 시 in it: 수원시장안구 is also found as 장안구.
    name = F.col("sigungu")
    cuts = F.filter(F.sequence(F.lit(1), F.greatest(F.length(name), F.lit(1))),
                    lambda i: (F.substr(name, i, F.lit(1)) == _CITY_SEAM) & (i < F.length(name)))
    keys = F.array_distinct(F.concat(F.array(name), F.transform(
        cuts, lambda i: F.substr(name, i + F.lit(1)))))
    index = (districts.select(F.struct("sido", "sigungu", "code").alias("d"),
                              F.explode(keys).alias("_key"))
             .groupBy("_key").agg(F.collect_list("d").alias("_districts")))

    def fits(district: Column, hint: Column) -> Column:
        alias = F.lit(None).cast("string")
        for short, full in PROVINCE_ALIASES.items():
            alias = F.when(hint == short, full).otherwise(alias)
        return (F.contains(district["sido"], hint)
                | F.coalesce(district["sido"] == alias, F.lit(False))
                | F.startswith(district["sigungu"], hint))

    def look_up(distinct: DataFrame) -> DataFrame:
        split = distinct.withColumn("_words", words(F.col("_text")))
        split = split.select("_query", F.try_element_at("_words", F.lit(-1)).alias("_key"),
                             F.slice("_words", F.lit(1), F.greatest(
                                 F.size("_words") - 1, F.lit(0))).alias("_hints"))
        found = F.filter("_districts", lambda d: F.forall("_hints", lambda h: fits(d, h)))
        hits = split.join(index, "_key", "left").select("_query", found.alias("_found"))
        return hits.select("_query", *_outcome(
            F.col("_found"), lambda d: F.concat_ws(" ", d["sido"], d["sigungu"])))

    return _strict(_resolve(queries, query, look_up), strict)


# Names that an ambiguous query lists; of more only the status is told.
LISTED = 1000


# Up to this length a query is looked up whole.
WHOLE = 16
# Marks of the grams that are asked for: a number that bounds what is broadcast.
MARKS = 1 << 20


def _gram_size(text: Column) -> Column:
    """Letters of the grams a text is looked up by: all it has, or of a long text the greatest power of
    two."""
    n = F.length(text)
    return F.when(n <= WHOLE, n).otherwise(F.pow(F.lit(2.0), F.floor(F.log2(n.cast("double")))).cast("int"))


def _grams(df: DataFrame, text: str) -> DataFrame:
    """A row for each different ``_gram`` of ``_size`` letters of the text."""
    at = F.sequence(F.lit(1), F.length(text) - F.col("_size") + 1)
    placed = df.where(F.length(text) >= F.col("_size")).withColumn("_at", F.explode(at))
    return placed.withColumn("_gram", F.substr(F.col(text), F.col("_at"), F.col("_size")))


def _mark() -> Column:
    """A number told by a gram's length and its first and last two letters."""
    return F.pmod(F.xxhash64("_size", F.left("_gram", F.lit(2)), F.right("_gram", F.lit(2))), F.lit(MARKS)).alias("_mark")


def resolve_named(queries: DataFrame, names: DataFrame, query: str = "query",
                  strict: bool = False, listed: int = LISTED) -> DataFrame:
    """Code of a named zone or city (``names``: name, code): adds ``status``, ``code`` and
    ``candidates``. An exact name wins, otherwise the names that contain the query count. The
    candidates of a query that fits more than ``listed`` names are not listed.

    A query is looked up as a whole among the names' grams of its length, so it meets the names
    that contain it and no others. One of over ``WHOLE`` letters is looked up under the rarest of
    its grams of a length that is a power of two, half its own at least, and what stands there is
    tested for the whole query. Of the names' grams only those of the lengths asked for are made,
    and only those whose length and ends some query has are kept. A blank query fits all names, and
    is answered by their number. Names without text are left out.
    """
    names = (names.where(F.length("name") > 0).groupBy("name", "code").agg(F.count(F.lit(1)).alias("_times")))

    def index(sized: DataFrame) -> DataFrame:
        """The grams of the names that may be among those of the queries, each once for a name."""
        sizes = sized.agg(F.collect_set("_size").alias("_sizes"))
        marks = _grams(sized, "_key").select(_mark()).distinct()
        grams = _grams(names.crossJoin(sizes).withColumn("_size", F.explode("_sizes")), "name")
        return (grams.withColumn("_mark", _mark()).join(F.broadcast(marks), "_mark", "left_semi")
                .where(F.instr(F.col("name"), F.col("_gram")) == F.col("_at")).select("name", "code", "_times", "_gram"))

    def look_up(distinct: DataFrame) -> DataFrame:
        keyed = distinct.select("_query", strip(F.col("_text")).alias("_key"))
        sized = keyed.where("_key <> ''").withColumn("_size", _gram_size(F.col("_key")))
        short, long = sized.where(F.length("_key") <= WHOLE), sized.where(F.length("_key") > WHOLE)
        held = index(long).groupBy("_gram").agg(F.count(F.lit(1)).alias("_held"))
        rarest = (_grams(long, "_key").join(held, "_gram", "left").groupBy("_query", "_key", "_size")
                  .agg(F.min_by("_gram", "_held").alias("_gram"), F.every(F.col("_held").isNotNull()).alias("_met"))
                  .where("_met").drop("_met"))
        asked = short.withColumn("_gram", F.col("_key")).unionByName(rarest).drop("_size")

        def hits(of: DataFrame, *columns: str) -> DataFrame:
            met = of.join(index(sized), "_gram").where(F.contains("name", F.col("_key")))
            return met.select("_query", *columns, "name", "code", "_times", (F.col("name") == F.col("_key")).alias("_exact"))

        of_query = F.sum("_times").alias("_n"), F.sum(F.when(F.col("_exact"), F.col("_times"))).alias("_exactly"), \
            F.min("code").alias("_code"), F.min(F.when(F.col("_exact"), F.col("code"))).alias("_exact_code")
        # All names fit a blank query: it has the count of all as its own.
        every = names.agg(F.sum("_times").alias("_n"), F.min("code").alias("_code")).where("_n > 0").withColumn("_key", F.lit(""))
        blank = keyed.where("_key = ''").join(every, "_key").select("_query", "_n", F.lit(None).cast("bigint").alias("_exactly"), "_code", F.lit(None).cast("string").alias("_exact_code"))
        counted = (hits(asked).groupBy("_query").agg(*of_query).unionByName(blank)
                   .select("_query", F.coalesce("_exactly", "_n").alias("_n"), F.coalesce("_exact_code", "_code").alias("code"), F.col("_exactly").isNotNull().alias("_only_exact")))
        several = (F.col("_n") > 1) & (F.col("_n") <= listed)
        # The names of a query that lists them are looked up anew; of the others only numbers are shuffled.
        few = counted.where(several).select("_query", "_n", F.col("code").alias("_one"), "_only_exact")
        everything = blank.where(several).crossJoin(names.select("name", "_times")).select("_query", "_n", F.col("_code").alias("_one"), "name", "_times")
        listing = (hits(asked.join(few, "_query"), "_n", "_one", "_only_exact").where("_exact or not _only_exact")
                   .select("_query", "_n", "_one", "name", "_times").unionByName(everything).groupBy("_query", "_n", F.col("_one").alias("code"))
                   .agg(F.flatten(F.collect_list(F.array_repeat("name", F.col("_times").cast("int")))).alias("candidates")))
        unlisted = counted.where(~several).select("_query", "_n", "code", F.lit(None).cast("array<string>").alias("candidates"))
        n = F.col("_n")
        return (unlisted.unionByName(listing)
                .select("_query", F.when(n == 0, "none").when(n == 1, "ok").otherwise("ambiguous").alias("status"),
                        F.when(n == 1, F.col("code")).alias("code"), F.array_sort("candidates").alias("candidates")))

    return _strict(_resolve(queries, query, look_up), strict)


def resolve_land_zone(queries: DataFrame, query: str = "query", strict: bool = False) -> DataFrame:
    """Land forecast zone of a place name."""
    return resolve_named(queries, land_zones(queries.sparkSession), query, strict)


def resolve_temp_city(queries: DataFrame, cities: DataFrame, query: str = "query",
                      strict: bool = False) -> DataFrame:
    """Temperature city of a place name. ``cities`` (name, code) is the weather agency's
    published list of forecast points; a name may occur in it twice and is then ambiguous."""
    return resolve_named(queries, cities, query, strict)
