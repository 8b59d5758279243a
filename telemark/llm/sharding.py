"""Sharding by extendible hashing.

A directory is indexed by the first bits of a hash of the document id. It starts as one
bucket; only a bucket over the byte limit is split, on its next bit, until every bucket
fits. A bucket is named by its bits ("b" alone is the whole table).

The bytes of all prefixes up to COARSE bits beyond the expected depth come from one
aggregation, so the usual directory needs one shuffle of (hash, bytes) rows; buckets that
are still too large then go on bit by bit, reading only their own rows. The directory has
a row per shard and is joined back by its size: broadcast within a checked bound, else
shuffled by prefix. Hashes spread a hot source or group of copies over all buckets.

The hash is 32 bits of the id and then 28 bits of the row's number in the stored id
table, so that rows that share an id can be split as well. A document larger than the
limit is alone in its shard at the end, with oversize true: documents are never cut.

Null text has 0 bytes; a null id is hashed like the empty string. Repeated rows are dealt
each. An empty table gives an empty result. Other columns do not matter.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemark.llm.tables import stored
from telemark.operators.joins import attach

LIMIT = 256 << 20
COARSE = 3
BITS = 60


def _prefix(h, depth):
    """The first `depth` of 60 bits."""
    return F.shiftright(h, BITS - depth) if isinstance(depth, int) else F.call_function("shiftright", h, F.lit(BITS) - depth)


def _names(frame: DataFrame) -> DataFrame:
    """The bucket's bits as text, leading zeros kept."""
    bits = F.when(F.col("depth") == 0, F.lit("")).otherwise(F.lpad(F.bin("prefix"), F.col("depth"), "0"))
    return frame.withColumn("shard", F.concat(F.lit("b"), bits))


def directory(rows: DataFrame, limit: int) -> tuple[DataFrame, int]:
    """(depth, prefix, shard_bytes, shard_rows) of every bucket for rows (h, n_bytes), and
    the number of bits that the first aggregation looked at."""
    total, count = rows.agg(F.sum("n_bytes"), F.count("*")).first()
    first = min(32, max(0, int((total or 0) // limit).bit_length()) + COARSE)
    fine = stored(rows.groupBy(_prefix(F.col("h"), first).alias("p")).agg(
        F.sum("n_bytes").alias("b"), F.count("*").alias("n")), "prefixes")
    levels = fine.select(F.explode(F.sequence(F.lit(0), F.lit(first))).alias("depth"), "p", "b", "n")
    levels = stored(levels.groupBy("depth", F.expr(f"shiftright(p, {first} - depth)").alias("prefix")).agg(
        F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_rows")), "levels")
    fits = (F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1)
    parents = levels.filter(~fits).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
    split = levels.withColumn("parent", F.shiftright("prefix", 1)).join(parents, ["depth", "parent"], "left_semi").drop("parent")
    found = [levels.filter("depth = 0").filter(fits), split.filter(fits)]
    depth, open_ = first, stored(split.unionByName(levels.filter("depth = 0")).filter(~fits & (F.col("depth") == first)).select("prefix"), "open")
    active = rows
    while depth < BITS and not open_.isEmpty():
        active = stored(active.withColumn("prefix", _prefix(F.col("h"), depth)).join(open_, "prefix", "left_semi").drop("prefix"), "active")
        depth += 1
        level = stored(active.groupBy(_prefix(F.col("h"), depth).alias("prefix")).agg(
            F.sum("n_bytes").alias("shard_bytes"), F.count("*").alias("shard_rows")).select(
            F.lit(depth).alias("depth"), "prefix", "shard_bytes", "shard_rows"), "level")
        last = depth == BITS
        found.append(level if last else level.filter(fits))
        open_ = level.filter(~fits).select("prefix")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return stored(out, "directory"), first


def assign(docs: DataFrame, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, shard, depth, shard_bytes, oversize) per row of `docs`."""
    text = F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long")
    slim = stored(docs.select(F.col(id_col).alias("id"), text.alias("n_bytes")), "ids")
    bits = F.conv(F.substring(F.md5(F.coalesce(F.col("id").cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long")
    # Row numbers of a stored table are the same when a task is run again.
    low = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 28))
    rows = slim.withColumn("h", F.shiftleft(bits, 28).bitwiseOR(low))
    shards, first = directory(rows, limit)
    # Shallow buckets are listed once per coarse prefix, deeper ones under theirs.
    begin = F.expr(f"CASE WHEN depth <= {first} THEN shiftleft(prefix, {first} - depth) ELSE shiftright(prefix, depth - {first}) END")
    listed = shards.withColumn("coarse", F.explode(F.sequence(begin, begin + F.expr(f"shiftleft(1L, greatest(0, {first} - depth))") - 1)))
    placed = attach(rows.withColumn("coarse", _prefix(F.col("h"), first)), listed, "coarse", "inner", salts=1).filter(
        F.expr(f"shiftright(h, {BITS} - depth) = prefix"))
    return _names(placed).select(
        F.col("id").alias(id_col), "n_bytes", "shard", F.col("depth").cast("int").alias("depth"), "shard_bytes",
        (F.col("shard_bytes") > limit).alias("oversize"))
