"""Bottom-k sketches of a document's word shingles, in DataFrame functions only.

A fingerprint is the k least hashes of the document's distinct shingles, in order. Two
fingerprints merge into that of both documents together. The share of the k least of the
merged ones that are in both estimates resemblance; the k-th value estimates how many
distinct shingles there are; both give containment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiwarden.sources.scratch import stored

K = 128
SHINGLE = 5


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    """Hash of every run of ``size`` words; a shorter text is one run; none without words."""
    split = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def runs(words: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(words) - size)
        return F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(size)]))

    # a list of one, so that the words are computed once
    return F.flatten(
        F.transform(
            F.array(split),
            lambda words: F.when(F.size(words) >= size, runs(words))
            .when(F.size(words) > 0, F.array(F.xxhash64(words)))
            .otherwise(F.array().cast("array<bigint>")),
        )
    )


def _least(hashes: Column, k: int) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def fingerprint(text: Column, k: int = K, size: int = SHINGLE) -> Column:
    """The k least shingle hashes, ascending; fewer if there are fewer; equal for equal texts."""
    return _least(shingle_hashes(text, size), k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Fingerprint of both documents' shingles together."""
    return _least(F.concat(a, b), k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of the shingle sets; two empty ones are alike."""
    both = merged(a, b, k)
    common = F.size(F.array_intersect(F.array_intersect(both, a), b))
    return F.when(F.size(both) == 0, 1.0).otherwise(common / F.size(both))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    share = (F.element_at(a, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too; nothing is contained in everything."""
    j = resemblance(a, b, k)
    common = j / (1 + j) * (distinct_shingles(a, k) + distinct_shingles(b, k))
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), common / distinct_shingles(a, k)))


def as_text(a: Column) -> Column:
    """The fingerprint as hexadecimal numbers joined by single spaces."""
    return F.array_join(F.transform(a, lambda x: F.hex(x)), " ")


def _successors(keys: DataFrame) -> DataFrame:
    """For each row its predecessor in descending order of id, the first after the last.

    Ids are dealt out by range and ordered within each part; ends of parts are put
    together over one row for each part.
    """
    dealt = keys.repartitionByRange(F.desc_nulls_last("doc_id"), "tag").withColumn("part", F.spark_partition_id())
    dealt = stored(dealt, "order")
    here = F.struct("doc_id", "tag", "n_chars")
    inside = Window.partitionBy("part").orderBy(F.desc_nulls_last("doc_id"), "tag")
    rows = dealt.withColumn("before", F.lag(here).over(inside)).withColumn("last", F.lead(F.lit(1)).over(inside).isNull())
    ends = rows.where("last").select("part", here.alias("end"))
    along = Window.orderBy("part")
    ends = ends.select(
        F.col("part").alias("of"),
        F.coalesce(F.lag("end").over(along), F.last("end").over(along.rowsBetween(0, Window.unboundedFollowing))).alias("end"),
    )
    joined = rows.join(ends, rows["part"] == ends["of"])
    before = F.coalesce("before", "end")
    return joined.select(
        F.col("doc_id").alias("id"),
        F.col("tag").alias("mark"),
        "copies",
        before["doc_id"].alias("asked_id"),
        before["tag"].alias("asked_tag"),
        F.floor(before["n_chars"] / 3).cast("int").alias("asked"),
    )


def _plain_key(name: str) -> tuple[Column, Column]:
    """An id that may be null as two columns that are not, for joins on plain equality."""
    return F.coalesce(name, F.lit(0)).alias(f"{name}_"), F.col(name).isNull().alias(f"{name}_none")


def fingerprint_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and how alike they are.

    The edited text has the last third of the characters replaced by the first as many
    of the next document in descending order of id, the first after the last. Null texts
    count as empty. Rows that repeat id and text are one document there and are returned
    each; of different texts with one id, the next is by their hash; null ids come last.
    A document that is alone is its own next.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tag"))
    keys = rows.groupBy("doc_id", "tag").agg(
        F.count(F.lit(1)).alias("copies"), F.max(F.char_length("text")).alias("n_chars")
    )
    order = _successors(keys)
    order = order.select(*_plain_key("id"), "mark", *_plain_key("asked_id"), "asked_tag", "asked", "copies")
    # One exchange of texts by plain keys serves the join, the removal of repeats and the second join.
    rows = rows.select(*_plain_key("doc_id"), "tag", "text")
    same = (rows["doc_id_"] == order["id_"]) & (rows["doc_id_none"] == order["id_none"]) & (rows["tag"] == order["mark"])
    known = rows.join(order, same).dropDuplicates(["doc_id_", "doc_id_none", "tag"])
    doc_id = F.when(~F.col("doc_id_none"), F.col("doc_id_")).alias("doc_id")
    own = known.select("doc_id_", "doc_id_none", "tag", doc_id, "text", "copies")
    lent = known.select(
        F.col("asked_id_").alias("to_"),
        F.col("asked_id_none").alias("to_none"),
        F.col("asked_tag").alias("to_tag"),
        F.substring("text", F.lit(1), F.col("asked")).alias("lent"),
        fingerprint(F.col("text"), k).alias("next_print"),
    )
    asks = (own["doc_id_"] == lent["to_"]) & (own["doc_id_none"] == lent["to_none"]) & (own["tag"] == lent["to_tag"])
    joined = own.join(lent, asks).withColumn("print", fingerprint(F.col("text"), k))
    n = F.char_length("text")
    edited = F.concat(F.substring("text", F.lit(1), (n - F.floor(n / 3)).cast("int")), "lent")
    out = joined.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "print", "next_print", "copies")
    out = out.withColumn("edited_print", fingerprint(F.col("edited"), k))
    out = out.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("print")).alias("fingerprint"),
        as_text(F.col("edited_print")).alias("edited_fingerprint"),
        resemblance(F.col("print"), F.col("edited_print"), k).alias("near_edited"),
        resemblance(F.col("print"), F.col("next_print"), k).alias("near_next"),
        "copies",
    )
    once = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    return out.select(*[c for c in out.columns if c != "copies"], once).drop("copy")
