"""Fingerprints of documents, of their edited texts and of the documents that follow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm import fingerprints
from barloom.llm.ordering import numbered
from barloom.llm.tables import stored


def beside_edited(docs: DataFrame) -> DataFrame:
    """Each document (``doc_id, text``) with its fingerprint, its edited text's and how like they are.

    The edited text has its last half (rounded down) of code points replaced by the first as many, or all, of
    the next document in ascending doc_id, null first, then by a hash of the text; the first follows the last.
    Null is empty. Rows equal in doc_id and text are one document, returned as often as it is there.

    Order and halves are settled on a narrow table; each text is shuffled once by its document, and once
    more the half that the document before needs.
    """
    text = F.coalesce("text", F.lit(""))
    texts = docs.select("doc_id", text.alias("text"), F.col("doc_id").isNotNull().alias("named"))
    texts = texts.select("named", F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("mark"), "text")
    # Without nulls in it, the key of the first shuffle is that of all joins, which then need no other.
    key = ["named", "id", "mark"]
    narrow = texts.groupBy(*key).agg(F.min(F.length("text")).alias("n"), F.count(F.lit(1)).alias("copies"))
    keys = stored(numbered(narrow, [F.col(c) for c in key], "place"), "document-order")
    total = max(keys.count(), 1)
    before = keys.select(
        *[F.col(c).alias(f"of_{c}") for c in (*key, "n")], F.pmod(F.col("place") + 1, F.lit(total)).alias("place")
    )
    follows = keys.select(*key, "place").join(before, "place").drop("place")

    signed = fingerprints.with_signature(texts, "text")
    base = signed.groupBy(*key).agg(F.first("text").alias("text"), F.first("signature").alias("signature"))
    following = base.join(follows, key).select(
        *[F.col(f"of_{c}").alias(c) for c in key],
        F.substring("text", F.lit(1), F.floor(F.col("of_n") / 2).cast("int")).alias("put"),
        F.col("signature").alias("next_signature"),
    )
    n = F.length("text")
    head = F.substring("text", F.lit(1), (n - F.floor(n / 2)).cast("int"))
    edited = base.join(following, key).select(
        *key, n.cast("long").alias("n_chars"), F.concat(head, "put").alias("edited"), "signature", "next_signature"
    )
    both = fingerprints.with_signature(edited, "edited", "edited_signature")
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    rows = both.join(keys.select(*key, "copies"), key).withColumn("doc_id", F.when(F.col("named"), F.col("id")))
    return rows.select(
        "doc_id", "n_chars", "edited", "signature", "edited_signature", "next_signature", each
    ).drop("copy")
