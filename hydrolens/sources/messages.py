"""Messages: JSON values on a topic or in files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from hydrolens.schemas import MESSAGE

BAD = "_bad"

# What a message without these fields counts as.
DEFAULTS = {"filename": "unknown", "processing_time_ms": 0, "model_version": "unet++", "location": "unknown"}

# Options that bound a micro-batch; a stream of messages needs one of them.
BOUNDS = {"kafka": ("maxOffsetsPerTrigger",), "text": ("maxFilesPerTrigger", "maxBytesPerTrigger")}

# Producer settings (50 MB messages, 16 KB batches).
PRODUCER = {
    "kafka.acks": "all",
    "kafka.batch.size": "16384",
    "kafka.linger.ms": "0",
    "kafka.compression.type": "snappy",
    "kafka.max.request.size": "52428800",
}


def kafka_options(
    servers: str, protocol: str = "PLAINTEXT", username: str | None = None, password: str | None = None
) -> dict[str, str]:
    """Connection options, with SASL/PLAIN when a user is given."""
    options = {"kafka.bootstrap.servers": servers, "kafka.security.protocol": protocol.upper()}
    if username is not None:
        login = "org.apache.kafka.common.security.plain.PlainLoginModule"
        options["kafka.security.protocol"] = "SASL_PLAINTEXT"
        options["kafka.sasl.mechanism"] = "PLAIN"
        options["kafka.sasl.jaas.config"] = f'{login} required username="{username}" password="{password}";'
    return options


def read_messages(spark: SparkSession, source: dict, schema: T.StructType = MESSAGE) -> DataFrame:
    """Stream of parsed messages plus `source_id`, a stable identity of each record.

    source = {"format": "kafka", "topic": ..., "options": kafka_options(...)} reads a topic from
    its start; {"format": "text", "path": ..., "options": {...}} reads files of JSON lines. The
    group's position is the checkpoint of the query that consumes the stream. One of the options in
    BOUNDS has to be given: a backlog would otherwise arrive as a single batch.
    """
    options = dict(source.get("options", {}))
    bounds = BOUNDS["kafka" if source["format"] == "kafka" else "text"]
    if not {b.lower() for b in bounds} & {o.lower() for o in options}:
        raise ValueError(f"a stream of messages needs a bound per batch: one of {', '.join(bounds)}")
    if source["format"] == "kafka":
        options.setdefault("startingOffsets", "earliest")
        raw = spark.readStream.format("kafka").option("subscribe", source["topic"]).options(**options).load()
        ident = F.concat_ws("/", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
        raw = raw.select(F.col("value").cast("string").alias("value"), ident.alias("source_id"))
    else:
        raw = spark.readStream.format("text").options(**options).load(source["path"])
        # A line is known by its file and its own text, both unchanged when it is read again.
        ident = F.concat_ws("/", F.col("_metadata.file_path"), F.sha2("value", 256))
        raw = raw.select("value", ident.alias("source_id"))
    return parse_messages(raw, schema)


def parse_messages(raw: DataFrame, schema: T.StructType = MESSAGE) -> DataFrame:
    """Parse the JSON text in `value`; text that is not JSON stays in `_bad` with NULL fields."""
    full = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    parsed = F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD})
    rest = [c for c in raw.columns if c != "value"]
    return raw.select(*rest, parsed.alias("m")).select(*rest, "m.*")


def normalise_messages(messages: DataFrame) -> DataFrame:
    """One shape for inline and linked messages.

    `content` holds the decoded inline bytes, `image_link` the object key; `error` says why a
    record cannot be used: bad JSON, bad base64, no image at all, or a key that leaves the store.
    Fields that a message does not have get the values in DEFAULTS.
    """
    content = F.try_to_binary("image", F.lit("base64"))
    bad = F.col(BAD) if BAD in messages.columns else F.lit(None).cast("string")
    error = (
        F.when(bad.isNotNull(), "not JSON")
        .when(F.col("image").isNotNull() & content.isNull(), "bad base64")
        .when(F.col("image").isNull() & F.col("image_link").isNull(), "no image")
        .when(_climbs("filename") | _climbs("image_link"), "path outside the store")
    )
    extra = [c for c in ("source_id",) if c in messages.columns]
    return messages.select(
        *extra,
        _given("filename").alias("filename"),
        "image_link",
        content.alias("content"),
        "date",
        event_time(F.col("date")).alias("event_time"),
        "message_id",
        "file_size",
        "lat",
        "lon",
        _given("location").alias("location"),
        _given("processing_time_ms").alias("processing_time_ms"),
        _given("model_version").alias("model_version"),
        error.alias("error"),
    )


def _given(name: str) -> Column:
    return F.coalesce(name, F.lit(DEFAULTS[name]))


def _climbs(name: str) -> Column:
    """The key has a '..' step, which in a file store would lead out of the root."""
    return F.coalesce(F.rlike(name, F.lit(r"(^|/)\.\.(/|$)")), F.lit(False))


def event_time(text: Column) -> Column:
    """Event time of a message; text that is not a time gives NULL."""
    return F.try_to_timestamp(text)


def to_messages(df: DataFrame, key: str) -> DataFrame:
    """(key, value) text rows: the key column, and all other columns as JSON."""
    rest = [c for c in df.columns if c != key]
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*rest)).alias("value"))


def write_messages(df: DataFrame, key: str, sink: dict) -> None:
    """Publish rows as a batch: {"format": "kafka", "topic", "options"} or {"format": "json", "path"}."""
    rows = to_messages(df, key)
    if sink["format"] == "kafka":
        rows.write.format("kafka").option("topic", sink["topic"]).options(**{**PRODUCER, **sink.get("options", {})}).save()
    else:
        rows.write.mode(sink.get("mode", "append")).format(sink["format"]).save(sink["path"])


def stream_messages(df: DataFrame, key: str, sink: dict, checkpoint: str, trigger: dict | None = None):
    """Publish a stream; returns the running query."""
    rows = to_messages(df, key)
    writer = rows.writeStream.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True}))
    if sink["format"] == "kafka":
        return writer.format("kafka").option("topic", sink["topic"]).options(**{**PRODUCER, **sink.get("options", {})}).start()
    return writer.format(sink["format"]).option("path", sink["path"]).start()
