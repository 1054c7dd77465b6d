"""Bloom filters as Spark bitmaps of fixed size: build by aggregation, test by a broadcast join. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import kept

SLOTS = 1 << 25  # 4 MiB of bits: the size bound of what is broadcast
PROBES = 2
_PER_ROW = 1 << 15  # bits in one row of Spark's bitmap functions


def _slot(key: Column, probe: int, slots: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(probe)), F.lit(slots))


def _is_set(bitmap: Column, position: Column) -> Column:
    """The bit at ``position`` of a binary column; not set where the bitmap is missing."""
    byte = F.conv(F.hex(F.substring(bitmap, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (position % 8).cast("int")) == 1, F.lit(False))


def filter_of(keys: DataFrame, key: str, least: int = 1, slots: int = SLOTS) -> DataFrame:
    """(bucket, bitmap): the slots that at least ``least`` marks fell on, PROBES marks for each row. At most ``slots`` bits in all."""
    marks = keys.select(F.explode(F.array(*[_slot(F.col(key), p, slots) for p in range(PROBES)])).alias("slot"))
    often = marks.groupBy("slot").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return kept(often.groupBy(F.floor(F.col("slot") / _PER_ROW).alias("bucket")).agg(F.bitmap_construct_agg(F.col("slot") % _PER_ROW).alias("bitmap")))


def tested(df: DataFrame, key: str, bits: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``df`` with a boolean ``maybe``; false is certain, true may be by chance. No shuffle."""
    hit = F.lit(True)
    for p in range(PROBES):
        slot = _slot(F.col(key), p, slots)
        own = bits.select(F.col("bucket").alias(f"__b{p}"), F.col("bitmap").alias(f"__m{p}"))
        df = df.join(F.broadcast(own), F.floor(slot / _PER_ROW) == F.col(f"__b{p}"), "left")  # at most ``slots`` bits
        hit = hit & _is_set(F.col(f"__m{p}"), slot % _PER_ROW)
    return df.withColumn("maybe", hit).drop(*[f"__{c}{p}" for c in "bm" for p in range(PROBES)])


def looked_up(df: DataFrame, key: str, table: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``df`` left-joined with ``table`` (one row per key). Only rows whose key may be there are shuffled, the others pass straight through."""
    rows = tested(df, key, filter_of(table, key, slots=slots), slots)
    more = [f for f in table.schema if f.name != key]
    straight = rows.where(~F.col("maybe")).select(*df.columns, *[F.lit(None).cast(f.dataType).alias(f.name) for f in more])
    joined = rows.where("maybe").drop("maybe").join(table, key, "left").select(*df.columns, *[f.name for f in more])
    return straight.unionAll(joined)
