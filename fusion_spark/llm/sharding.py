"""Shards that all hold the mixture of the sources: proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fusion_spark.llm.store import stored

SEED = 11
LEAST_ROWS = 4096  # of a stretch; from 16 million rows on, stretches and their rows grow alike


def unit(code: Column) -> Column:
    """The first 32 bits of a hexadecimal code as a number from 0 to below 1."""
    return F.conv(F.substring(code, 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def seeded(column: str, seed: int) -> Column:
    """MD5 of a seed and a value; null has a code of its own."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(column).cast("string"), F.lit("-"))))


def earlier(by: list[str], order: str) -> object:
    return Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def interleave(
    docs: DataFrame, shards: int = 8, seed: int = SEED, key: str = "doc_id", text: str = "text",
    stratum: str = "source", least_rows: int = LEAST_ROWS,
) -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard), one row per row of ``docs``.

    Within each stratum the rows are ranked in a seeded shuffled order. A row of rank r of n
    stands at (r + offset of the stratum) / n, so the rows of every stratum spread evenly over
    0 to 1 and strata of one row do not meet at one point. A shard holds of a stratum its share
    of the rows but for one, and strata of a few rows by chance. All rows in this order are cut into
    runs whose counts are at most one apart (law ``rows``), so each shard holds of every
    stratum its share. ``grown_shard`` is null: the place of a row depends on the others.

    ``size`` is the number of UTF-8 bytes plus 1. Null texts have size 1, a null stratum is a
    stratum, null ids are ranked like any other. Equal texts are rows of their own, placed by
    their ids. Rows equal in all that is read are ranked as one row with a count, so a row
    repeated without end loads no task; they differ only in slot. Fewer rows than shards leave
    shards empty, an empty table gives an empty result, and other columns are not read.

    Only small integers are moved. Ranks are counted inside stretches of the order and
    shifted by the sizes of the earlier stretches; a stretch has about ``least_rows`` rows or
    the square root of all, so no task orders a whole stratum or the whole table.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    slim = stored(
        docs.select(
            F.col(key).alias("_key"), F.col(stratum).alias("_stratum"),
            (F.octet_length(body).cast("long") + 1).alias("size"),
            F.crc32(body).alias("text_crc32"),
        )
    )
    rows = slim.count()
    stretches = max(1, int(rows / max(least_rows, rows ** 0.5)))

    single = (
        slim.groupBy("_key", "_stratum", "size", "text_crc32").agg(F.count("*").alias("_copies"))
        .withColumn("_code", seeded("_key", seed))
        .withColumn("_stretch", F.floor(unit(F.col("_code")) * stretches))
    )
    counts = single.groupBy("_stratum", "_stretch").agg(F.sum("_copies").alias("_n"))
    shifts = counts.select(
        F.col("_stratum").alias("_of"), F.col("_stretch").alias("_at"),
        F.coalesce(F.sum("_n").over(earlier(["_stratum"], "_stretch")), F.lit(0)).alias("_shift"),
        F.sum("_n").over(Window.partitionBy("_stratum")).alias("_all"),
    )
    own = Window.partitionBy("_stratum", "_stretch").orderBy(
        "_code", "_key", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("_copies").over(own), F.lit(0))
    spread = (
        single.withColumn("_first", first)
        .join(shifts, F.col("_stratum").eqNullSafe(F.col("_of")) & (F.col("_stretch") == F.col("_at")))
        .withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)))
        .withColumn("_rank", F.col("_shift") + F.col("_first") + F.col("_copy"))
        .withColumn("_point", (F.col("_rank") + unit(seeded("_stratum", seed))) / F.col("_all"))
        .select("_key", "size", "text_crc32", "_stratum", "_rank", "_point",
                F.floor(F.col("_point") * stretches).alias("_part"))
    )
    spread = stored(spread)
    parts = spread.groupBy("_part").agg(F.count("*").alias("_n"))
    # one row per stretch: at most the square root of the number of rows
    starts = parts.select(
        "_part", F.coalesce(F.sum("_n").over(earlier([], "_part")), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_part").orderBy("_point", "_stratum", "_rank")
    place = F.col("_start") + F.row_number().over(inside) - 1
    return (
        spread.join(starts, "_part").withColumn("_place", place)
        .withColumn("shard", F.expr(f"((_place + 1) * {shards} - 1) div {max(rows, 1)}").cast("int"))
        .select(
            F.col("_key").alias(key), "size", "text_crc32", F.lit("rows").alias("law"), "shard",
            F.expr(f"_place - (cast(shard as bigint) * {rows}) div {shards}").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
