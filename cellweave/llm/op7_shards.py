"""Operator 7: sharding by vector bin packing.

Rows of equal text form a group, and a group stays whole in one shard unless its bytes or rows are
more than an even share of one shard; such a group is split by a hash of its ids into parts of
1/PARTS of a share. Groups (and parts) of at least 1/SINGLE of a share are packed one by one, which
are at most 3 * SINGLE * n_shards; the smaller ones hash, whole, into bundles. Spark sums each
bundle's vector (bytes, tokens, rows); then every bundle, most bytes first, goes to the shard where
the dot product of its vector with the shard's residual capacity is highest. Only bundles (at most
BUNDLES_MOST a shard, whatever the input, and the single groups) are seen by the driver.

The law held is ``bytes``: the shards' sizes are near equal. Tokens are words, unless a column of
token counts is named.

Defined results: a null text has size OVERHEAD, the checksum of the empty text and no tokens; each
input row gets a place, repeated and null ids included; an empty table gives no rows. Groups are
told apart by 64 bits of hash; two that share it stay together.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellweave.session import cut

OVERHEAD = 16
#: Bundles for each shard: as many as give bundles of ROWS_BUNDLE rows, between these bounds.
BUNDLES_LEAST, BUNDLES_MOST, ROWS_BUNDLE, SINGLE, PARTS = 64, 2048, 50_000, 64, 8


def place(vectors: np.ndarray, n_shards: int) -> np.ndarray:
    """Shard of each vector: most bytes first, to the highest dot product with the residual capacity among shards with room."""
    total = vectors.sum(0)
    v = vectors / np.where(total > 0, total, 1) * n_shards
    rest = np.ones((n_shards, v.shape[1]))
    out = np.empty(len(v), np.int64)
    for k in np.lexsort((np.arange(len(v)), -v.max(1), -v[:, 0])):
        fit = rest @ v[k]
        room = rest[:, 0] - v[k, 0]  # bytes are the law: among those that would not overflow, else the emptiest
        ok = room >= -1e-12
        s = int(np.argmax(np.where(ok, fit, -np.inf))) if ok.any() else int(np.argmax(room))
        out[k] = s
        rest[s] -= v[k]
    return out


def shard(docs: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text", tokens_col: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    spark = docs.sparkSession
    text = F.coalesce(docs[text_col], F.lit(""))
    tokens = F.coalesce(docs[tokens_col], F.lit(0)) if tokens_col else F.regexp_count(text, F.lit(r"[^ \t-\r]+"))
    meta = cut(docs.select(
        docs[id_col].alias("doc_id"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        tokens.cast("long").alias("tokens"), F.xxhash64(text, F.octet_length(text)).alias("key"),
    ))
    sums = meta.agg(F.sum("size"), F.count("*"), F.sum("tokens")).first()
    share = [max(1.0, (x or 0) / n_shards) for x in sums]
    n_bundles = n_shards * min(BUNDLES_MOST, max(BUNDLES_LEAST, sums[1] // (n_shards * ROWS_BUNDLE)))
    groups = meta.groupBy("key").agg(F.sum("size").alias("b"), F.count("*").alias("n"), F.sum("tokens").alias("t"))
    fill = F.greatest(F.col("b") / share[0], F.col("n") / share[1], F.col("t") / share[2])
    # At most 3 * SINGLE * n_shards groups, as the parts of a whole add up to n_shards in each of three measures.
    large = F.broadcast(groups.filter(fill >= 1 / SINGLE).select("key", F.when(fill > 1, F.ceil(fill * PARTS)).otherwise(1).alias("parts")))
    part = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.col("parts"))
    rowed = meta.join(large, "key", "left").withColumn("bundle", F.when(F.col("parts").isNull(), F.struct(F.lit(None).cast("long").alias("key"), F.pmod(F.xxhash64("key"), F.lit(n_bundles)).alias("part"))).otherwise(F.struct("key", part.alias("part")))).drop("parts")
    found = rowed.groupBy("bundle").agg(F.sum("size").cast("double").alias("b"), F.sum("tokens").cast("double").alias("t"), F.count("*").alias("n")).orderBy("bundle").select("bundle.key", "bundle.part", "b", "t", "n").collect()
    n = np.array([r["n"] for r in found], np.int64)
    shards = place(np.array([(r["b"], r["t"], r["n"]) for r in found], float).reshape(-1, 3), n_shards)
    start = np.zeros(len(found), np.int64)
    for s in range(n_shards):
        mine = np.flatnonzero(shards == s)
        start[mine] = np.cumsum(n[mine]) - n[mine]
    placed = spark.createDataFrame([((r["key"], r["part"]), int(s), int(x), -(-r["n"] // ROWS_BUNDLE)) for r, s, x in zip(found, shards, start)], "bundle struct<key: long, part: long>, shard int, start long, runs long")
    rowed = rowed.join(F.broadcast(placed), rowed["bundle"].eqNullSafe(placed["bundle"])).drop(placed["bundle"])
    # Rows of a bundle are numbered run by run, so that no task has to sort a large bundle.
    rowed = rowed.withColumn("run", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.col("runs")))
    runs = rowed.groupBy("shard", "start", "run").agg(F.count("*").alias("n"))
    runs = runs.select("shard", "start", "run", (F.sum("n").over(W.partitionBy("shard", "start").orderBy("run")) - F.col("n")).alias("before"))
    w = W.partitionBy("shard", "start", "run").orderBy(F.col("doc_id").asc_nulls_last(), "key")
    out = rowed.withColumn("nth", F.row_number().over(w)).join(runs, ["shard", "start", "run"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("start") + F.col("before") + F.col("nth") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
