"""Content-level dedup and overlap: URL dedup (D1), exact dedup (D2), overlap spans (D3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mediasift.functions.text import canonical_url, words
from mediasift.session import materialize


def url_dedup(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per canonical URL: (canonical, keep_id, n); keep the smallest id."""
    return (pages.select(canonical_url(url_col).alias("canonical"), F.col(id_col).alias("id"))
            .groupBy("canonical")
            .agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("n")))


def exact_dedup(items: DataFrame, id_col: str = "doc_id", content_col: str = "text") -> DataFrame:
    """Every item with the id it keeps: (id, keep_id) by SHA-256 of the whole content.

    Group-by on the digest pre-aggregates map-side, so a digest shared by a third
    of the rows is one partial minimum per task. Only digests that occur twice or
    more are joined back, from a written table: both sides of the join are then
    plain exchanges, and AQE can split the partition of a dominating digest.
    Null contents are copies of one another.
    """
    digests = items.select(F.col(id_col).alias("id"),
                           F.coalesce(F.sha2(F.col(content_col), 256), F.lit("")).alias("digest"))
    keep = materialize(digests.groupBy("digest").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
                       .where("n > 1").select("digest", "keep_id"), "copies")
    return digests.join(keep, "digest", "left").select(
        F.col("id").alias(id_col), F.coalesce("keep_id", "id").alias("keep_id"))


def shingle_hashes(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(id, pos, sh, h): every k-word window of the whole text (0-based position),
    its k words and a 64-bit hash of them. Each row carries only its own k words,
    so the output is linear in the text length."""
    w = docs.select(F.col(id_col).alias("id"), words(text_col).alias("w"))
    # posexplode and the projection to the k-word slice run in one codegen
    # stage; the whole word list is dropped there and never shuffled.
    return (w.select("id", "w", F.posexplode("w").alias("pos", "_t"))
            .where(F.col("pos") <= F.size("w") - k)
            .select("id", "pos", F.slice("w", F.col("pos") + 1, k).alias("sh"))
            .withColumn("h", F.xxhash64("sh")))


MAX_BROADCAST_HASHES = 1_000_000   # 8 bytes each


def overlap_spans(docs: DataFrame, refs: DataFrame, k: int = 8,
                  doc_id: str = "doc_id", ref_id: str = "item_id", text_col: str = "text") -> DataFrame:
    """Copied passages of reference items inside documents.

    Both sides are cut into k-word shingles, joined on the shingle's 64-bit hash
    (then on the text itself), and grouped into runs of consecutive positions per
    (doc, ref, diagonal), where the diagonal is ``pos_doc - pos_ref``: a verbatim
    copy keeps it constant, and a changed word ends its span.
    Returns (doc_id, item_id, start, length, containment) with ``start`` the
    first matched word in the document, ``length`` in words and
    ``containment`` = matched shingles / shingles of the reference.
    """
    # Join on the hash; the word lists confirm each hit, so a hash collision
    # can never create a match. Document shingles without a reference's hash end
    # before the shuffle if the references' hashes are few enough to broadcast.
    ds = shingle_hashes(docs, doc_id, text_col, k)
    rs = shingle_hashes(refs, ref_id, text_col, k)
    hashes = materialize(rs.select("h").distinct(), "hashes")
    if hashes.count() <= MAX_BROADCAST_HASHES:
        ds = ds.join(F.broadcast(hashes), "h", "left_semi")
    totals = rs.groupBy(F.col("id").alias("rid")).agg(F.count(F.lit(1)).alias("total"))
    ref = rs.select(F.col("id").alias("rid"), F.col("pos").alias("rpos"), "h", F.col("sh").alias("rsh"))
    m = (ds.select(F.col("id").alias("did"), F.col("pos").alias("dpos"), "h", F.col("sh").alias("dsh"))
         .join(ref, "h")
         .where(F.col("dsh") == F.col("rsh")))
    # consecutive positions of a diagonal are one span; a gap starts another
    m = m.select("did", "rid", "dpos", (F.col("dpos") - F.col("rpos")).alias("diag"))
    along = Window.partitionBy("did", "rid", "diag").orderBy("dpos")
    g = (m.withColumn("island", F.col("dpos") - F.row_number().over(along))
         .groupBy("did", "rid", "diag", "island")
         .agg(F.min("dpos").alias("start"), F.count(F.lit(1)).alias("n")))
    return (g.join(totals, "rid")
            .select(F.col("did").alias(doc_id), F.col("rid").alias(ref_id), "start",
                    (F.col("n") + (k - 1)).alias("length"),
                    F.round(F.col("n") / F.col("total"), 6).alias("containment")))
