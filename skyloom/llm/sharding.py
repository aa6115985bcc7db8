"""Sharding by extendible hashing.

A row's hash bits index a directory.  The whole table is one bucket at first; a bucket over the
byte limit splits on the next bit, and only such buckets do, so a shard is a hash prefix whose
rows fit the limit while those of its parent prefix do not.  Sizes are summed for all prefixes
down to a base depth at once, and only rows of buckets that are still too large are looked at
again with further bits.  Rows whose hashes are equal cannot be parted by bits: such a bucket
gets overflow pages, each within the limit unless one row alone is larger.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, take, with_row

BITS = 60
#: The limit of the query: a small shard, so that small tables too are split.
SMALL_SHARD = 1 << 20
#: Ways by which rows of overflowing buckets are dealt out.
WAYS = 32


def row_hash(id_: Column, text: Column) -> Column:
    """60 bits of the MD5 of the id and the text (nulls as empty), as a long."""
    return F.conv(F.substring(F.md5(F.concat(F.coalesce(id_.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))), 1, 15), 16, 10).cast("long")


def prefix(h: Column, depth: Column | int) -> Column:
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.call_function("shiftright", h, (F.lit(BITS) - depth).cast("int"))


def directory(rows: DataFrame, limit: int, spare_bits: int = 4, more_bits: int = 8) -> DataFrame:
    """Leaves of the split tree of `rows` (h, bytes): depth, prefix, bytes, n, whether it
    `overflows` (over the limit though all its hashes are equal), and `h`, its least hash."""
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    depth = min(BITS, max(0, math.ceil(math.log2(max(1.0, total / limit)))) + spare_bits)
    base, found = 0, []
    left = rows.groupBy("h").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"))
    root = materialise(rows.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi")).where("n > 0").select(F.lit(0).alias("depth"), F.lit(0).cast("long").alias("prefix"), "bytes", "n", "lo", "hi"), "root")
    open_ = (F.col("bytes") > limit) & (F.col("lo") != F.col("hi"))
    found.append(root.where(~open_))
    parents = root.where(open_)
    while not parents.isEmpty():
        # sizes of all prefixes between base and depth; each fine bucket adds to its ancestors
        fine = left.groupBy(prefix(F.col("h"), depth).alias("p")).agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi"))
        levels = fine.withColumn("depth", F.explode(F.sequence(F.lit(base + 1), F.lit(depth))))
        nodes = levels.groupBy("depth", F.call_function("shiftright", F.col("p"), F.lit(depth) - F.col("depth")).alias("prefix")).agg(
            F.sum("bytes").alias("bytes"), F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
        )
        nodes = materialise(nodes, "nodes")
        split = nodes.where(open_).select("depth", "prefix").unionByName(parents.select("depth", "prefix"))
        above = split.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("up"))
        born = nodes.withColumn("up", F.call_function("shiftright", F.col("prefix"), F.lit(1))).join(above, ["depth", "up"], "left_semi").drop("up")
        found.append(born.where(~open_))
        parents = materialise(nodes.where(open_ & (F.col("depth") == depth)), "parents")
        wide = parents.select(F.col("prefix").alias("p"))
        left = left.withColumn("p", prefix(F.col("h"), depth)).join(wide, "p", "left_semi").drop("p")
        base, depth = depth, min(BITS, depth + more_bits)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.select("depth", "prefix", "bytes", "n", (F.col("bytes") > limit).alias("overflows"), F.col("lo").alias("h"))


def _measured(rows: DataFrame) -> DataFrame:
    """Adds `bytes` and the hash `h`; the text goes."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes")
    return rows.select(*(c for c in rows.columns if c != "text"), size, row_hash(F.col("id"), F.col("text")).alias("h"))


def _placed(sized: DataFrame, leaves: DataFrame, limit: int) -> DataFrame:
    """Adds depth, prefix and page to rows with `h` and `bytes`.  A row has one leaf; it is looked
    up under its prefixes, one for each depth that leaves have."""
    depths = [r[0] for r in leaves.select("depth").distinct().collect()]  # at most BITS + 1 numbers
    names = [c for c in sized.columns if c != "h"]

    def plain(rows: DataFrame) -> DataFrame:
        keyed = rows.withColumn("depth", F.explode(F.array(*(F.lit(d) for d in sorted(depths))).cast("array<int>")))
        found = keyed.withColumn("prefix", prefix(F.col("h"), F.col("depth"))).join(leaves.where(~F.col("overflows")).select("depth", "prefix"), ["depth", "prefix"])
        return found.select(*names, "depth", "prefix", F.lit(0).cast("long").alias("page"))

    over = leaves.where("overflows").select("h", F.col("depth").alias("_depth"), F.col("prefix").alias("_prefix"))
    if over.isEmpty():
        return plain(sized)
    # the rows of an overflowing bucket, however many, meet its leaf by several ways
    dealt = sized.withColumn("_part", F.spark_partition_id()).withColumn("_way", F.pmod(F.monotonically_increasing_id(), F.lit(WAYS)))
    marked = dealt.join(over.withColumn("_way", F.explode(F.sequence(F.lit(0), F.lit(WAYS - 1)).cast("array<long>"))), ["h", "_way"], "left")
    full = marked.where("_depth IS NOT NULL").withColumn("_g", F.xxhash64("id", "bytes", "h"))
    pages = _paged(full, limit).select(*names, F.col("_depth").alias("depth"), F.col("_prefix").alias("prefix"), "page")
    return plain(marked.where("_depth IS NULL").select(*sized.columns)).unionByName(pages)


def _paged(full: DataFrame, limit: int) -> DataFrame:
    """Adds `page` to rows of overflowing buckets.  Equal rows (`_g`) are numbered within the part
    of the input that they come from, and each part starts where the parts before it end, so no
    task and no row ever holds all copies of a row."""
    parts = full.groupBy("_g", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = parts.select("_g", "_part", F.coalesce(before, F.lit(0)).alias("_start"))
    nth = F.row_number().over(Window.partitionBy("_g", "_part").orderBy(F.xxhash64(*(c for c in full.columns if not c.startswith("_way")))))
    fit = F.greatest(F.floor(F.lit(limit) / F.greatest("bytes", F.lit(1))), F.lit(1))
    return full.withColumn("_nth", nth).join(starts, ["_g", "_part"]).withColumn("page", F.floor((F.col("_start") + F.col("_nth") - 1) / fit).cast("long"))


def assign_shards(docs: DataFrame, limit: int = 64 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, bytes, depth, prefix, page): each row's shard is (depth, prefix, page).

    `bytes` is the text's length in UTF-8; null texts have none.  Every shard's bytes are within
    `limit`, but for a row that is larger by itself, which is alone on its page.  Equal rows may
    be on several pages; they are interchangeable.  An empty table gives no rows."""
    sized = materialise(_measured(take(docs, id_col, text_col).toDF("id", "text")), "sizes")
    return _placed(sized, materialise(directory(sized, limit), "leaves"), limit).drop("h")


def shard_name(depth: Column, prefix_: Column, page: Column) -> Column:
    """The shard's hash bits (none for the whole table) and its page, like `b0110-p0`."""
    bits = F.when(depth == 0, F.lit("")).otherwise(F.lpad(F.conv(prefix_.cast("string"), 10, 2), depth, F.lit("0")))
    return F.concat(F.lit("b"), bits, F.lit("-p"), page.cast("string"))


def write_shards(docs: DataFrame, path: str, limit: int = 64 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the rows of `docs`, with all their columns, as Parquet with a folder for each
    shard (column `_shard`, or where the table has such a column `__shard` and so on), one file each.
    Returns the table as written."""
    shard = "_shard"
    while shard in {c.lower() for c in docs.columns}:
        shard = f"_{shard}"
    rows = _measured(with_row(docs, id_col, text_col).toDF("_row", "id", "text"))
    leaves = materialise(directory(rows.select("h", "bytes"), limit), "leaves")
    placed = _placed(rows, leaves, limit).withColumn("_shard", shard_name(F.col("depth"), F.col("prefix"), F.col("page")))
    flat = placed.select("_shard", *(F.col(f"_row.c{i}") for i in range(len(docs.columns)))).toDF(shard, *docs.columns)
    flat.repartition(shard).write.partitionBy(shard).parquet(path)
    return docs.sparkSession.read.parquet(path)
