"""The tables of this package, derived from the generated test tables.

Each function reads one of the given parquet tables and shapes it like a production table. The
catalog uses them; production code passes its own tables to the same reports.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    return predictions_from(table(spark, folder, "events"))


def predictions_from(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("ts").alias("timestamp"),
        F.col("event_id").alias("image_id"),
        F.concat(F.lit("overlay/img_"), F.col("event_id").cast("string"), F.lit(".png")).alias("image_url"),
        F.least(F.col("value") * 0.5, F.lit(100.0)).alias("water_coverage_percent"),
        (F.get_json_object("props", "$.k").cast("double") / 100).alias("confidence_score"),
        (F.lit(50) + F.col("event_id") % 451).alias("processing_time_ms"),
        F.concat(F.lit("v-"), F.col("event_type")).alias("model_version"),
        F.concat(F.lit("River"), F.char(F.lit(65) + F.col("user_id") % 3)).alias("location"),
    )


def stock(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("l_extendedprice")
    # Ties on the order number have equal prices, so first and last are well defined.
    rank = F.col("l_orderkey") * 100000000 + F.round(price * 100).cast("bigint")
    dec = lambda c: (c / 250).cast("decimal(20,8)")
    return (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_shipdate").cast("date").alias("date"))
        .agg(
            dec(F.max_by(price, rank)).alias("close"),
            dec(F.max(price)).alias("high"),
            dec(F.min(price)).alias("low"),
            dec(F.min_by(price, rank)).alias("open"),
            F.sum("l_quantity").cast("bigint").alias("volume"),
        )
    )


def upload_log(spark: SparkSession, folder: str) -> DataFrame:
    failed = F.col("event_type") == "error"
    return table(spark, folder, "events").select(
        "event_id",
        F.concat(F.lit("img_"), (F.col("event_id") % 200).cast("string"), F.lit(".jpg")).alias("filename"),
        (~failed).alias("success"),
        F.col("ts").alias("timestamp"),
        F.floor(F.col("value") * 1048576).cast("bigint").alias("file_size"),
        F.when(failed, "HTTP 500").alias("error"),
    )


def objects(spark: SparkSession, folder: str) -> DataFrame:
    log = upload_log(spark, folder)
    stamp = F.unix_millis(F.col("timestamp").cast("timestamp")).cast("string")
    return log.select(
        F.concat(F.lit("uploads/"), stamp, F.lit("_"), F.col("filename")).alias("key"),
        F.col("file_size").alias("size"),
        F.col("timestamp").alias("last_modified"),
    )


def client_ips(spark: SparkSession, folder: str) -> DataFrame:
    user = F.col("user_id")
    text = lambda c: c.cast("string")
    return table(spark, folder, "events").select(
        "event_id",
        F.when(user % 11 == 0, "172.16.0.5")
        .when(user % 10 == 0, F.concat(F.lit("192.168.0."), text(user % 256)))
        .otherwise(F.concat(text(F.lit(20) + user % 200), F.lit("."), text(user % 256), F.lit(".0.7, 10.0.0.1")))
        .alias("x_forwarded_for"),
        F.lit("127.0.0.1").alias("client_host"),
    )


def geo_ranges(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    low = (F.lit(20) + F.col("n_nationkey")).cast("bigint") * 16777216
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        low.alias("ip_from"),
        (low + 16777215).alias("ip_to"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("region"),
        F.concat(F.col("n_name"), F.lit(" City")).alias("city"),
        F.col("n_nationkey").cast("double").alias("lat"),
        (F.col("n_nationkey") * -2).cast("double").alias("lon"),
    )


def mixed_ips(spark: SparkSession, folder: str) -> DataFrame:
    """Clients with addresses of both kinds, in eight spellings by turns."""
    user, turn = F.col("user_id"), F.col("event_id") % 8
    site, host, net = F.lit(0xD00) + user % 40, user % 256, F.lit(20) + user % 200
    spelt = [
        F.format_string("%d.%d.0.7, 10.0.0.1", net, host),
        F.format_string("2001:%x::%x", site, host),
        F.format_string("2001:%04X:8000:0000:0000:0000:0000:%04X", site, host),
        F.format_string("::ffff:%d.%d.0.7", net, host),
        F.format_string("0:0:0:0:0:FFFF:%02x%02x:0007", net, host),
        F.format_string("[2001:%x:7fff::%x]:443", site, host),
        F.format_string("::ffff:192.168.0.%d", host),
        F.when(user % 2 == 0, F.format_string("fe80::%x%%eth0", host)).otherwise("1:2:3"),
    ]
    address = F.when(turn == 0, spelt[0])
    for at, spelling in enumerate(spelt[1:], 1):  # only the one in turn is made
        address = address.when(turn == at, spelling)
    return table(spark, folder, "events").select("event_id", address.alias("x_forwarded_for"), F.lit("::1").alias("client_host"))


def geo_networks(spark: SparkSession, folder: str) -> DataFrame:
    """A wide network, one for each nation in it, and a part of each of these."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    key = F.col("n_nationkey")
    sites = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    fields = [F.col("n_name").alias("country"), F.col("r_name").alias("region")]
    place = [key.cast("double").alias("lat"), (key * -2).cast("double").alias("lon")]
    of_nation = sites.select(F.format_string("2001:%x::/32", F.lit(0xD00) + key).alias("cidr"), *fields, F.concat("n_name", F.lit(" City")).alias("city"), *place)
    north = sites.select(F.format_string("2001:%x:8000::/36", F.lit(0xD00) + key).alias("cidr"), *fields, F.concat("n_name", F.lit(" North")).alias("city"), *place)
    none = [F.lit(None).cast("string").alias("city"), F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon")]
    wide = region.where("r_regionkey = 0").select(F.lit("2001:c00::/22").alias("cidr"), F.lit(None).cast("string").alias("country"), F.col("r_name").alias("region"), *none)
    return of_nation.unionByName(north).unionByName(wide)


def logit_maps(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("key"), F.lit(8).alias("height"), F.lit(8).alias("width"), F.col("embedding").alias("logits")
    )


def truth_maps(spark: SparkSession, folder: str) -> DataFrame:
    """The truth of image `key` is the sign of the vector that follows it, as 0/255 grey."""
    return table(spark, folder, "embeddings").select(
        (F.col("vec_id") - 1).alias("key"),
        F.transform("embedding", lambda v: F.when(v > 0, 255).otherwise(0)).alias("truth"),
    )
