"""Uploads, objects and locations as table jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hydrolens.functions.text import (
    UPLOAD_TYPES,
    client_ip,
    epoch_ms,
    extension,
    fixed,
    inner_ipv4,
    ipv4_number,
    ipv6_halves,
    is_local_ip,
    is_local_number,
    iso_text,
    object_key,
    uploaded_name,
)
from hydrolens.operators.lookup import locate_numbers, locate_prefixes, lookup_join
from hydrolens.session import stage

MB = 1024 * 1024

# The record of a local client, and of a failed lookup.
LOCAL = {"country": "Development", "region": "Local", "city": "Localhost", "lat": 40.7128, "lon": -74.0060}
UNKNOWN = {"country": "Unknown", "region": "Unknown", "city": "Unknown", "lat": 0.0, "lon": 0.0}
UNKNOWN_IP = "0.0.0.0"


def validate_uploads(uploads: DataFrame, max_mb: int = 50) -> DataFrame:
    """Add `size_ok` (inclusive limit) and `type_ok`."""
    return uploads.withColumns(
        {
            "size_ok": F.col("file_size") <= max_mb * MB,
            "type_ok": F.coalesce(extension(F.col("filename")).isin(UPLOAD_TYPES), F.lit(False)),
        }
    )


def mark_already_uploaded(new: DataFrame, log: DataFrame) -> DataFrame:
    """Add `already_uploaded`: the file name has a successful upload in the log."""
    done = log.where("success").select("filename").distinct().withColumn("_done", F.lit(True))
    return lookup_join(new, done, "filename").withColumn("already_uploaded", F.coalesce("_done", F.lit(False))).drop("_done")


def build_messages(uploads: DataFrame) -> DataFrame:
    """Upload rows (filename, timestamp, file_size, lat, lon) -> message rows with their key."""
    stamp = F.col("timestamp")
    return uploads.select(
        epoch_ms(stamp).alias("key"),
        "filename",
        object_key(stamp, F.col("filename")).alias("image_link"),
        iso_text(stamp).alias("date"),
        "file_size",
        "lat",
        "lon",
    )


def enrich_location(uploads: DataFrame, ranges: DataFrame, networks: DataFrame | None = None) -> DataFrame:
    """Add ip, country, region, city, lat, lon from the client's address.

    IPv4 addresses, also those inside an IPv6 address, are found in `ranges` (`ip_from`, `ip_to`), other IPv6 addresses
    in `networks` (`cidr`), where the longest prefix wins. Distinct addresses are counted, staged and resolved once; the result
    is joined back as a lookup, so an address with a large share of the traffic costs no more than any other.
    """
    rows = uploads.withColumn("_address", client_ip(F.col("x_forwarded_for"), F.col("client_host")))
    counts = stage(rows.groupBy("_address").agg(F.count("*").alias("_n")), "addresses")
    found = resolve_addresses(counts.select("_address"), ranges, "_address", networks)
    # A client without any address finds nothing and is unknown.
    filled = [F.coalesce(c, F.lit(v)).alias(c) for c, v in {"ip": UNKNOWN_IP, **UNKNOWN}.items()]
    return lookup_join(rows, found, "_address", counts=counts).select(*uploads.columns, *filled)


def parsed_networks(networks: DataFrame) -> DataFrame:
    """`networks` with `high`, `low` and `bits` of each `cidr`; those that are no IPv6 network are left out."""
    bits = F.when(F.rlike("cidr", F.lit(r"/\d{1,3}$")), F.substring_index("cidr", "/", -1).cast("int"))
    halves = networks.withColumns({"_halves": ipv6_halves(F.substring_index("cidr", "/", 1)), "bits": bits})
    return halves.select(*networks.columns, "_halves.high", "_halves.low", "bits").where("high IS NOT NULL AND bits BETWEEN 0 AND 128")


def resolve_addresses(addresses: DataFrame, ranges: DataFrame, address: str, networks: DataFrame | None = None) -> DataFrame:
    """One location record per distinct address: local, found in the ranges or networks, or unknown."""
    numbered = addresses.select(address, ipv6_halves(F.col(address)).alias("_halves")).select(address, "_halves.high", "_halves.low")
    number = F.coalesce(ipv4_number(F.col(address)), inner_ipv4(F.col("high"), F.col("low")))
    numbered = numbered.withColumn("_number", number)
    local = is_local_ip(F.col(address)) | F.coalesce(is_local_number(F.col("_number")), F.lit(False))
    numbered = numbered.withColumn("_local", local).withColumn("_number", F.when(~F.col("_local"), F.col("_number")))
    # Parsed once: conditions on what an address holds would otherwise be moved below and parse the address of every row again.
    numbered = stage(numbered, "numbered")
    located = locate_numbers(numbered, ranges, "_number", list(UNKNOWN))
    if networks is not None:
        six = numbered.where("NOT _local AND _number IS NULL AND high IS NOT NULL").select(address, "high", "low")
        held = locate_prefixes(six, parsed_networks(networks), list(UNKNOWN)).select(address, "network")
        located = located.join(held, address, "left").withColumns(
            {"found": F.col("found") | F.col("network").isNotNull(), **{c: F.coalesce(F.col(c), F.col(f"network.{c}")) for c in UNKNOWN}}
        )

    def pick(name: str) -> Column:
        return F.when(F.col("_local"), F.lit(LOCAL[name])).otherwise(F.coalesce(name, F.lit(UNKNOWN[name]))).alias(name)

    ip = F.when(F.col("_local") | F.col("found"), F.col(address)).otherwise(UNKNOWN_IP).alias("ip")
    return located.select(address, ip, *[pick(c) for c in UNKNOWN])


def upload_statistics(log: DataFrame) -> DataFrame:
    good = F.count_if("success")
    return log.agg(
        F.count("*").alias("total_uploads"),
        good.alias("successful"),
        (F.count("*") - good).alias("failed"),
        (F.try_divide(good.cast("double"), F.count("*")) * 100).alias("success_pct"),
        (F.coalesce(F.sum("file_size"), F.lit(0)).cast("double") / MB).alias("total_mb"),
    )


def recent_uploads(log: DataFrame, sequence: str, n: int = 5) -> DataFrame:
    """The last uploads, newest first, as shown to the user."""
    return (
        log.orderBy(F.desc("timestamp"), F.desc(sequence))
        .limit(n)
        .select(
            "filename",
            "success",
            F.date_format("timestamp", "HH:mm:ss").alias("timestamp"),
            F.concat(fixed(F.col("file_size") / MB, 2), F.lit(" MB")).alias("size"),
            "file_size",
            "error",
        )
    )


def latest_success(log: DataFrame, sequence: str) -> DataFrame:
    return recent_uploads(log.where("success"), sequence, 1)


def objects_under(listing: DataFrame, prefix: str = "") -> DataFrame:
    """Objects whose key starts with the prefix: key, size, last_modified."""
    return listing.where(F.startswith("key", F.lit(prefix))).select("key", "size", "last_modified")


def object_count(listing: DataFrame, prefix: str = "") -> DataFrame:
    return objects_under(listing, prefix).agg(F.count("*").alias("count"))


def latest_objects(listing: DataFrame) -> DataFrame:
    """For every uploaded file name, its newest object."""
    return (
        listing.withColumn("filename", uploaded_name(F.col("key")))
        .where("filename IS NOT NULL")
        .groupBy("filename")
        .agg(
            F.max_by("key", F.struct("last_modified", "key")).alias("key"),
            F.max("last_modified").alias("last_modified"),
        )
    )


def latest_object(listing: DataFrame, filename: str) -> DataFrame:
    """The newest object of one file name; no row when there is none."""
    return latest_objects(listing.where(F.endswith("key", F.lit("_" + filename)))).where(F.col("filename") == filename)
