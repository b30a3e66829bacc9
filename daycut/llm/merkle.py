"""Merkle fixity audit of WARC replicas, in DataFrame functions alone.

Records are hashed; ordered ranges of 16, 256, ... record numbers get the hash
of their children's numbers and hashes, up to one root.  Two replicas are
compared from the root downwards, and only the children of mismatching nodes
are joined on the next level.  Ranges are ranges of record numbers, so a lost
or added record changes its own branch alone; the byte range reported is that
of the primary's files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daycut.session import checkpointed

FANOUT = 16
#: Records of one file: a full subtree, so files are nodes too.
FILE_RECORDS = FANOUT ** 3


def warc_record(url: Column, record_id: Column, body: Column) -> Column:
    """A WARC response record as text; null parts are empty."""
    url, body = F.coalesce(url, F.lit("")), F.coalesce(body, F.lit(""))
    return F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), url,
                    F.lit("\r\nWARC-Record-ID: <urn:record:"), F.coalesce(record_id.cast("string"), F.lit("")),
                    F.lit(">\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body,
                    F.lit("\r\n\r\n"))


def leaves(records: DataFrame, id_col: str, body: Column) -> DataFrame:
    """Leaf nodes: ``slot``, ``digest``, ``bytes``, ``copies``.

    A null id is slot -1 (ids are taken as non-negative).  Repeated ids form
    one leaf whose digest covers how many there are and what they hold,
    whatever their order.
    """
    one = records.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-1).cast("long")).alias("slot"), body.alias("body"))
    one = one.select("slot", F.sha2("body", 256).alias("sha"), F.octet_length("body").cast("long").alias("bytes"))
    many = F.sha2(F.concat_ws(":", F.count(F.lit(1)).cast("string"), F.min("sha"), F.max("sha"),
                              F.bit_xor(F.xxhash64("sha")).cast("string"),
                              F.sum(F.xxhash64("sha").cast("decimal(38,0)")).cast("string")), 256)
    return one.groupBy("slot").agg(F.when(F.count(F.lit(1)) == 1, F.min("sha")).otherwise(many).alias("digest"),
                                   F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("copies"))


def _parent(slot: str = "slot") -> Column:
    return F.floor(F.col(slot) / FANOUT)


def _up(level: DataFrame, slot: Column) -> DataFrame:
    """Parents of a level; a node has at most ``FANOUT`` children."""
    kids = F.array_sort(F.collect_list(F.struct("slot", "digest")))
    text = F.array_join(F.transform(kids, lambda k: F.concat(k["slot"].cast("string"), F.lit("="), k["digest"])), ",")
    return level.groupBy(slot.alias("_s")).agg(F.sha2(text, 256).alias("digest")).withColumnRenamed("_s", "slot")


def tree(leaf: DataFrame, height: int) -> list[DataFrame]:
    """Levels from the leaves up to the root (one node, slot 0)."""
    levels = [leaf]
    for _ in range(height):
        levels.append(checkpointed(_up(levels[-1].select("slot", "digest"), _parent())))
    return [*levels, checkpointed(_up(levels[-1].select("slot", "digest"), F.lit(0).cast("long")))]


def audit(primary: DataFrame, replica: DataFrame, id_col: str, primary_body: Column, replica_body: Column) -> DataFrame:
    """Records in which the replica differs from the primary.

    Returns ``slot`` (record id, null for -1), ``status`` (``missing``,
    ``extra``, ``repeated`` or ``corrupt``), ``file`` and the byte range
    ``start``, ``stop`` (end exclusive) in the primary's file, in which the
    records lie in order of id, and ``sha256`` of the primary's record.  The
    last four are null for ``extra``.  Equal replicas, also two empty ones,
    give no rows.
    """
    a = checkpointed(leaves(primary, id_col, primary_body))
    b = checkpointed(leaves(replica, id_col, replica_body))
    most = max([0, *(x for x in (d.agg(F.max("slot")).first()[0] for d in (a, b)) if x is not None)])
    height = 0
    while FANOUT ** height <= most:
        height += 1
    up_a, up_b = tree(a, height), tree(b, height)
    open_nodes = None
    for level in range(height + 1, -1, -1):
        left, right = up_a[level], up_b[level]
        if open_nodes is not None:
            top = level == height          # all nodes of this level hang on the root
            of = F.lit(0).cast("long") if top else _parent()
            left, right = (d.join(open_nodes, of == F.col("node"), "left_semi") for d in (left, right))
        extra = ["bytes", "copies"] if level == 0 else []
        sides = [d.select("slot", *[F.col(c).alias(f"{c}_{x}") for c in ["digest", *extra]])
                 for d, x in ((left, "a"), (right, "b"))]
        differ = sides[0].join(sides[1], "slot", "full").where(~F.col("digest_a").eqNullSafe(F.col("digest_b")))
        open_nodes = checkpointed(differ.select(F.col("slot").alias("node"))) if level else None
    status = (F.when(F.col("digest_b").isNull(), "missing").when(F.col("digest_a").isNull(), "extra")
              .when(F.col("copies_a") != F.col("copies_b"), "repeated").otherwise("corrupt"))
    # byte ranges of the files that hold a finding
    file = F.floor(F.col("slot") / FILE_RECORDS)
    differ = checkpointed(differ.withColumns({"status": status, "file": file}))
    order = Window.partitionBy("file").orderBy("slot")
    ranges = (a.withColumn("file", file).join(differ.select("file").distinct(), "file", "left_semi")
              .withColumn("stop", F.sum("bytes").over(order)).select("slot", (F.col("stop") - F.col("bytes")).alias("start"),
                                                                     "stop"))
    found = F.col("digest_a").isNotNull()
    return differ.join(ranges, "slot", "left").select(
        F.when(F.col("slot") >= 0, F.col("slot")).alias("slot"), "status",
        F.when(found, F.col("file")).alias("file"), "start", "stop", F.col("digest_a").alias("sha256"))
