"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are short, documents long: the Jaccard similarity of a document with an item inside
it falls with the document's length, and so would the chance that a MinHash of fixed size sees
it. Documents are therefore partitioned by size, and the one-permutation MinHash of each
partition has bins in proportion: the hash space is cut into 2^b bins, b growing with the size,
and each bin keeps its least shingle hash. An item matches a document if they share the minimum
of a bin; items are indexed once for all partitions, each hash with the least b at which it is
the minimum of its bin. Candidates are verified by exact containment of word shingles.

Only DataFrame functions: no Python runs on the executors.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, ascii_lower, settle

SHINGLE = 5
#: The chance that a contained item shares no minimum.
MISSED = 1e-7
#: Rows up to which a side is sent to all tasks; 24 bytes a row. Beyond it the join is shuffled.
SENT_ROWS = 1_000_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), SPACES + "+"), "")


def _hashes(rows: DataFrame) -> DataFrame:
    """Column ``w`` (words) -> ``h``: the distinct shingle hashes, in order."""
    rows = rows.withColumn("w", F.transform("w", lambda x: F.xxhash64(x)))
    five = F.transform(F.sequence(F.lit(0), F.size("w") - SHINGLE),
                       lambda i: F.xxhash64(*(F.get("w", i + k) for k in range(SHINGLE))))
    few = F.when(F.size("w") > 0, F.array(F.xxhash64("w"))).otherwise(F.array().cast("array<bigint>"))
    return rows.withColumn("h", F.when(F.size("w") >= SHINGLE, five).otherwise(few)).drop("w").withColumn("h", F.sort_array(F.array_distinct("h")))


def shingles(w: Column) -> Column:
    """Distinct shingles as text; fewer words are one shingle."""
    five = F.transform(F.sequence(F.lit(1), F.size(w) - SHINGLE + 1), lambda i: F.array_join(F.slice(w, i, SHINGLE), " "))
    return F.array_distinct(F.when(F.size(w) >= SHINGLE, five).when(F.size(w) > 0, F.array(F.array_join(w, " ")))
                            .otherwise(F.array().cast("array<string>")))


def spare_bits(fewest: int, threshold: float, missed: float = MISSED) -> int:
    """How many more bits than its size a partition's bins need: with 2^-s shingles a bin, a
    shingle is the minimum of its bin with chance d = (1 - exp(-x)) / x, x = 2^-s, and all
    of the shared ones fail to be with (1 - d)^m."""
    m = max(1, math.ceil(threshold * fewest))
    for s in range(1, 24):
        x = 2.0 ** -s
        if (1 - (1 - math.exp(-x)) / x) ** m <= missed:
            return s
    return 24


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= SENT_ROWS else df


def search(docs: DataFrame, items: DataFrame, threshold: float = 0.75, id_col: str = "doc_id", text_col: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc_id, item_id, n_item_shingles, n_shared, containment`` of each document and item of
    which the document holds at least ``threshold`` of the distinct shingles.

    Words are lower-cased (A-Z) and parted by ASCII white space. An item of fewer than five words
    is one shingle, found in documents of just these words. Null and empty texts match nothing,
    rows with a null id neither; rows that repeat give one result; items alike are reported
    each. Either table may be empty; other columns aren't read.

    Documents stay where they are: the item index is sent to them if its counted rows allow, and
    so are the candidates for the second reading. Past that size both joins are shuffled by
    shingle hash and by document. A passage that a third of the documents hold makes as many rows
    as there are such documents, in as many tasks.
    """
    item = (items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
            .where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).distinct().withColumn("w", words(F.col("text"))).where(F.size("w") > 0))
    hashed = settle(_hashes(item.select("item_id", "w")), "items")
    ran = hashed.agg(F.min(F.size("h")), F.sum(F.size("h"))).first()
    if ran[0] is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, n_item_shingles int, n_shared int, containment double")
    spare = spare_bits(ran[0], threshold)
    # A hash is the minimum of its bin if the one before it lies in another: at more bits than
    # the two have in common from the left.
    index = hashed.select("item_id", F.posexplode("h").alias("i", "v"), "h").select(
        "item_id", "v", F.when(F.col("i") == 0, 0).otherwise(
            65 - F.length(F.bin(F.col("v").bitwiseXOR(F.get("h", F.col("i") - 1))))).cast("int").alias("least"))

    doc = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where(
        F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    sized = _hashes(doc.select("doc_id", words(F.col("text")).alias("w")))
    bits = F.least(F.lit(60), F.ceil(F.log2(F.size("h"))) + spare).cast("int")
    # The outer form: for the inner one Spark adds a filter on the array, and pushed below the
    # projection it would compute the shingles anew for each element.
    minima = sized.withColumn("b", bits).select("doc_id", "b", F.explode_outer(F.expr(
        "filter(h, (x, i) -> i = 0 or shiftright(x, 64 - b) <> shiftright(h[i - 1], 64 - b))")).alias("v"))
    found = settle(minima.join(_small(index, ran[1]), "v").where(F.col("b") >= F.col("least")).select("doc_id", "item_id").distinct(), "candidates")

    ids = found.select("doc_id").distinct()
    again = doc.join(_small(ids, ids.count()), "doc_id").withColumn("w", words(F.col("text"))).select("doc_id", shingles(F.col("w")).alias("s"))
    wanted = item.select("item_id", shingles(F.col("w")).alias("t"))
    return (found.join(again, "doc_id").join(_small(wanted, ran[1]), "item_id")
            .select("doc_id", "item_id", F.size("t").alias("n_item_shingles"), F.size(F.array_intersect("s", "t")).alias("n_shared"))
            .withColumn("containment", F.col("n_shared") / F.col("n_item_shingles")).where(F.col("containment") >= threshold).distinct())
