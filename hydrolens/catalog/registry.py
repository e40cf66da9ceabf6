"""Query registry: name -> (Spark function, optional SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

Run = Callable[[SparkSession, str], DataFrame]
_RUNS: dict[str, Run] = {}
_SQL: dict[str, str] = {}

# A range that covers every row, for reports that take one.
ALL = ("1970-01-01", "2100-01-01")
ALL_TS = "timestamp BETWEEN TIMESTAMP '1970-01-01' AND TIMESTAMP '2100-01-01'"
ALL_DATE = "date BETWEEN DATE '1970-01-01' AND DATE '2100-01-01'"

# The fixture tables in the checking engine's SQL (see sources.fixtures).
VIEWS = {
    "preds": """preds AS (
  SELECT ts AS timestamp, event_id AS image_id,
         concat('overlay/img_', CAST(event_id AS VARCHAR), '.png') AS image_url,
         least(value * CAST(0.5 AS DOUBLE), CAST(100 AS DOUBLE)) AS water_coverage_percent,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) / CAST(100 AS DOUBLE) AS confidence_score,
         50 + event_id % 451 AS processing_time_ms,
         concat('v-', event_type) AS model_version,
         concat('River', chr(CAST(65 + user_id % 3 AS INT))) AS location
  FROM events)""",
    "stock": """stock AS (
  SELECT CAST(l_shipdate AS DATE) AS date,
         CAST(arg_max(l_extendedprice, ord) / 250 AS DECIMAL(20,8)) AS close,
         CAST(max(l_extendedprice) / 250 AS DECIMAL(20,8)) AS high,
         CAST(min(l_extendedprice) / 250 AS DECIMAL(20,8)) AS low,
         CAST(arg_min(l_extendedprice, ord) / 250 AS DECIMAL(20,8)) AS open,
         CAST(sum(l_quantity) AS BIGINT) AS volume
  FROM (SELECT *, l_orderkey * 100000000 + CAST(round(l_extendedprice * 100) AS BIGINT) AS ord FROM lineitem)
  GROUP BY 1)""",
    "upload_log": """upload_log AS (
  SELECT event_id, concat('img_', CAST(event_id % 200 AS VARCHAR), '.jpg') AS filename,
         event_type <> 'error' AS success, ts AS timestamp,
         CAST(floor(value * 1048576) AS BIGINT) AS file_size,
         CASE WHEN event_type = 'error' THEN 'HTTP 500' END AS error
  FROM events)""",
    "objects": """objects AS (
  SELECT concat('uploads/', CAST(epoch_us(ts) // 1000 AS VARCHAR), '_img_', CAST(event_id % 200 AS VARCHAR), '.jpg') AS key,
         CAST(floor(value * 1048576) AS BIGINT) AS size, ts AS last_modified
  FROM events)""",
    "client_ips": """client_ips AS (
  SELECT event_id,
         CASE WHEN user_id % 11 = 0 THEN '172.16.0.5'
              WHEN user_id % 10 = 0 THEN concat('192.168.0.', CAST(user_id % 256 AS VARCHAR))
              ELSE concat(CAST(20 + user_id % 200 AS VARCHAR), '.', CAST(user_id % 256 AS VARCHAR), '.0.7, 10.0.0.1')
         END AS x_forwarded_for, '127.0.0.1' AS client_host
  FROM events)""",
    "geo_ranges": """geo_ranges AS (
  SELECT CAST(20 + n_nationkey AS BIGINT) * 16777216 AS ip_from,
         CAST(20 + n_nationkey AS BIGINT) * 16777216 + 16777215 AS ip_to,
         n_name AS country, r_name AS region, concat(n_name, ' City') AS city,
         CAST(n_nationkey AS DOUBLE) AS lat, CAST(n_nationkey * -2 AS DOUBLE) AS lon
  FROM nation JOIN region ON n_regionkey = r_regionkey)""",
    "pixels": """pixels AS (
  SELECT vec_id AS key, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
scored AS (
  SELECT key, i, CAST(1 AS DOUBLE) / (CAST(1 AS DOUBLE) + exp(-CAST(x AS DOUBLE))) AS p, x FROM pixels)""",
}


def register(name: str, sql: str | None = None, views: tuple[str, ...] = ()) -> Callable[[Run], Run]:
    """Add a query. Doubles are shown with eight places, decimals as doubles, on both sides."""

    def add(run: Run) -> Run:
        if name in _RUNS:
            raise ValueError(f"query {name} is registered twice")
        _RUNS[name] = lambda spark, folder: presentable(run(spark, folder))
        if sql:
            body = sql.strip()
            if views:
                body = "WITH " + ",\n".join(VIEWS[v] for v in views) + "\n" + body
            _SQL[name] = body
        return run

    return add


def presentable(df: DataFrame) -> DataFrame:
    shown = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            col = F.round(col.cast("double"), 8).alias(field.name)
        shown.append(col)
    return df.select(*shown)


def queries() -> dict[str, Run]:
    return dict(_RUNS)


def oracle() -> dict[str, str]:
    return dict(_SQL)
