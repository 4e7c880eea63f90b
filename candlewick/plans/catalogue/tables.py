"""Layer tables, landed files, exports, versions and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.operators import profile as pf, shaping as sh, versions as vs
from candlewick.plans import inputs, jobs
from candlewick.plans.catalogue.registry import query, rounded, rounded_sql, scratch_lake
from candlewick.session import shared_dir, staged
from candlewick.sinks.files import export_csv, export_parquet, write_predictions
from candlewick.sources.landing import landed_bars as read_landed_bars
from candlewick.sources.tables import read_csv, read_ticker

# --- sinks -------------------------------------------------------------------------------------------


def _totals(spark, d, *statuses):
    """Order count and value per customer, of orders of some statuses, under the name of the first."""
    status = statuses[0]
    chosen = inputs.table(spark, d, "orders").filter(F.col("o_orderstatus").isin(*statuses))
    return chosen.groupBy(F.col("o_custkey").alias("custkey")).agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("value"), F.lit(status).alias("status")
    )


_TOTALS = """totals AS (SELECT if(o_orderstatus = 'F', 'F', 'O') AS status, o_custkey AS custkey, count(*) AS orders,
  round(sum(o_totalprice), 2) AS value FROM orders GROUP BY ALL)"""
_UPSERT_SQL = f"""WITH {_TOTALS}, source AS (SELECT * FROM totals WHERE status = 'O')
SELECT custkey, orders, value, status FROM source UNION ALL
SELECT custkey, orders, value, status FROM totals t
WHERE status = 'F' AND NOT EXISTS (SELECT 1 FROM source s WHERE s.custkey = t.custkey)"""


@query("keyed_upsert", _UPSERT_SQL)
def keyed_upsert(spark, d):
    lake = scratch_lake(spark)
    lake.upsert(_totals(spark, d, "F"), "silver.totals", ["custkey"])
    lake.upsert(_totals(spark, d, "O", "P"), "silver.totals", ["custkey"])
    return lake.read("silver.totals")


@query(
    "upsert_into_partitions",
    """WITH days AS (SELECT o_orderpriority AS priority, CAST(o_orderdate AS DATE) AS day, if(o_orderstatus = 'F', 'F', 'P') AS status,
  count(*) AS orders FROM orders GROUP BY ALL), source AS (SELECT * FROM days WHERE status = 'P')
SELECT priority, day, status, orders FROM source UNION ALL SELECT priority, day, status, orders FROM days t
WHERE status = 'F' AND NOT EXISTS (SELECT 1 FROM source s WHERE s.priority = t.priority AND s.day = t.day)""",
)
def upsert_into_partitions(spark, d):
    """Only the partitions that the source touches are written again."""
    lake, keys = scratch_lake(spark), ["priority", "day"]

    def daily(*statuses):
        chosen = inputs.table(spark, d, "orders").filter(F.col("o_orderstatus").isin(*statuses))
        return chosen.groupBy(
            F.col("o_orderpriority").alias("priority"), F.col("o_orderdate").cast("date").alias("day")
        ).agg(F.lit(statuses[0]).alias("status"), F.count(F.lit(1)).alias("orders"))

    lake.upsert(daily("F"), "gold.days", keys, partition_by=["priority"])
    lake.upsert(daily("P", "O"), "gold.days", keys)
    return lake.read("gold.days").select("priority", "day", "status", "orders")


@query(
    "partial_column_upsert",
    """SELECT c_custkey AS custkey, c_name AS name, CASE WHEN o.n IS NULL THEN 0 ELSE o.n END AS orders
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) o ON o.o_custkey = c_custkey""",
)
def partial_column_upsert(spark, d):
    """An upsert with fewer columns keeps the others."""
    lake = scratch_lake(spark)
    customers = inputs.table(spark, d, "customer").select(
        F.col("c_custkey").alias("custkey"), F.col("c_name").alias("name"), F.lit(0).cast("long").alias("orders")
    )
    lake.upsert(customers, "silver.customers", ["custkey"])
    known = inputs.table(spark, d, "orders").select(F.col("o_custkey").alias("custkey"))
    counted = known.join(customers.select("custkey"), "custkey", "left_semi").groupBy("custkey").agg(
        F.count(F.lit(1)).alias("orders")
    )
    lake.upsert(counted, "silver.customers", ["custkey"])
    return lake.read("silver.customers")


@query(
    "write_modes",
    "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')",
)
def write_modes(spark, d):
    """Overwrite twice, append, then merge."""
    lake = scratch_lake(spark)
    orders = inputs.table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    for status, mode in (("P", "overwrite"), ("F", "overwrite"), ("O", "append"), ("P", "merge")):
        lake.write(orders.filter(F.col("o_orderstatus") == status), "bronze.orders", mode, ["o_orderkey"])
    return lake.read("bronze.orders")


@query(
    "row_counts",
    """SELECT 'bronze.orders' AS "table", count(*) AS "rows" FROM orders UNION ALL
SELECT 'bronze.nation', count(*) FROM nation""",
)
def row_counts(spark, d):
    """Counts reported after each write."""
    lake = scratch_lake(spark)
    counts = [
        (f"bronze.{name}", lake.write(inputs.table(spark, d, name), f"bronze.{name}")) for name in ("orders", "nation")
    ]
    return spark.createDataFrame(counts, "table string, rows bigint")


@query("table_alias", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def table_alias(spark, d):
    lake = scratch_lake(spark)
    lake.overwrite(inputs.table(spark, d, "nation"), "gold.nation")
    alias = f"{lake.prefix}nations"
    lake.view(alias, "gold.nation")
    return spark.table(alias)


# --- files -------------------------------------------------------------------------------------------


@query("csv_scan", "SELECT o_orderkey, o_orderdate AS date, o_totalprice, o_orderstatus FROM orders")
def csv_scan(spark, d):
    path = shared_dir(spark, "csv")
    orders = inputs.table(spark, d, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("date"), "o_totalprice", "o_orderstatus"
    )
    export_csv(orders, path)
    return read_csv(spark, path)


@query("csv_to_layer", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def csv_to_layer(spark, d):
    path, lake = shared_dir(spark, "csv"), scratch_lake(spark)
    export_csv(inputs.table(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal"), path)
    for mode in ("overwrite", "merge"):
        jobs.csv_to_layer(lake, path, "supplier", keys=["s_suppkey"], mode=mode)
    stored = lake.read("bronze.supplier").select(F.col("s_suppkey").cast("long"), "s_name", "s_acctbal")
    return stored


@query("parquet_export", f"WITH {inputs.BARS} SELECT * FROM bars WHERE ticker = '2-HIGH'")
def parquet_export(spark, d):
    """Bars exported by ticker, then one ticker read back; only its folder is read."""
    path = shared_dir(spark, "export")
    export_parquet(inputs.bars(spark, d), path, ("ticker",))
    return read_ticker(spark, path, "2-HIGH", ["ticker", "date", "open", "high", "low", "close", "volume"])


@query(
    "landed_bars",
    f"""WITH {inputs.BARS} SELECT date, open, high, low, close, volume, ticker FROM bars
WHERE ticker IN ('1-URGENT', '5-LOW') AND date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'""",
)
def landed_bars(spark, d):
    """One folder of CSV files per ticker, capital headers; a ticker without files adds nothing."""
    path = shared_dir(spark, "landed")
    named = inputs.bars(spark, d).select(
        *[F.col(c).alias(c.capitalize()) for c in ("date", "open", "high", "low", "close", "volume")], "ticker"
    )
    named.write.partitionBy("ticker").option("header", True).csv(path)
    return read_landed_bars(spark, path, ["1-URGENT", "5-LOW", "NONE"], "1996-01-01", "1997-12-31")


@query(
    "prediction_files",
    f"""WITH {inputs.FEATURES} SELECT ticker AS stock, date, {rounded_sql("Return")},
  CASE WHEN Return > 0 THEN 'UP' ELSE 'DOWN' END AS prediction_direction FROM features WHERE Return IS NOT NULL""",
)
def prediction_files(spark, d):
    path = shared_dir(spark, "predictions")
    rows = inputs.features(spark, d).filter(F.col("Return").isNotNull())
    up = F.when(F.col("Return") > 0, "UP").otherwise("DOWN").alias("prediction_direction")
    write_predictions(rows.select(F.col("ticker").alias("stock"), "date", "Return", up), path, stamp="20240101_000000")
    back = spark.read.schema("date date, Return double, prediction_direction string, stock string, run string").json(path)
    return back.select("stock", "date", rounded("Return"), "prediction_direction")


@query(
    "land_and_stamp",
    f"WITH {inputs.BARS} SELECT date, open, high, low, close, volume, ticker, true AS stamped FROM bars",
)
def land_and_stamp(spark, d):
    """Bars landed twice: the second landing updates, adds nothing."""
    lake = scratch_lake(spark)
    jobs.land_bars(lake, inputs.bars(spark, d))
    jobs.land_bars(lake, inputs.bars(spark, d))
    jobs.bars_to_gold(lake)
    stored = lake.read("gold.bars")
    return stored.select(*[c for c in stored.columns if c != "ingestion_timestamp"], F.col("ingestion_timestamp").isNotNull().alias("stamped"))


# --- shaping -----------------------------------------------------------------------------------------

_STATUS = {"P": "deleted", "F": "done"}
_STATUS_SQL = "CASE o_orderstatus WHEN 'P' THEN 'deleted' WHEN 'F' THEN 'done' ELSE o_orderstatus END"


@query(
    "filtered_jobs",
    f"""SELECT o_orderkey, o_orderpriority, {_STATUS_SQL} AS status FROM orders
WHERE {_STATUS_SQL} <> 'deleted' AND {_STATUS_SQL} = 'done' AND o_orderpriority = '2-HIGH'""",
)
def filtered_jobs(spark, d):
    rows = sh.recode_column(inputs.table(spark, d, "orders"), "o_orderstatus", _STATUS, "status")
    kept = sh.not_deleted(rows, {"status": "done", "o_orderpriority": "2-HIGH", "o_custkey": None})
    return kept.select("o_orderkey", "o_orderpriority", "status")


@query(
    "soft_delete",
    f"""SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'deleted' ELSE {_STATUS_SQL} END AS status,
  CASE WHEN o_totalprice > 300000 THEN TIMESTAMP '2024-01-01 00:00:00' ELSE o_orderdate END AS updated_at FROM orders""",
)
def soft_delete(spark, d):
    rows = sh.recode_column(inputs.table(spark, d, "orders"), "o_orderstatus", _STATUS, "status")
    base = rows.withColumn("updated_at", F.col("o_orderdate").cast("timestamp"))
    out = vs.soft_deleted(base, F.col("o_totalprice") > 300000, F.lit("2024-01-01").cast("timestamp"))
    return out.select("o_orderkey", "status", "updated_at")


@query(
    "newest_jobs",
    "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 15",
)
def newest_jobs(spark, d):
    return inputs.table(spark, d, "orders").select("o_orderkey", "o_orderdate").orderBy(
        F.desc("o_orderdate"), F.desc("o_orderkey")
    ).limit(15)


@query(
    "union_by_name",
    """SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL
SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier""",
)
def union_by_name(spark, d):
    customers = inputs.table(spark, d, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = inputs.table(spark, d, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")
    )
    return customers.unionByName(suppliers, allowMissingColumns=True)


@query(
    "filled_and_pruned",
    """SELECT c_custkey, coalesce(o_orderstatus, '') AS o_orderstatus, coalesce(o_totalprice, 0.0) AS o_totalprice
FROM customer LEFT JOIN orders ON o_custkey = c_custkey""",
)
def filled_and_pruned(spark, d):
    """Left join, blanks for text, zero for a number, unwanted columns dropped whatever their case."""
    joined = inputs.table(spark, d, "customer").join(
        inputs.table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left"
    )
    filled = sh.fill(sh.blank_strings(joined), {"o_totalprice": 0.0})
    kept = sh.drop_if_present(filled, ["C_NAME", "c_nationkey", "C_AcctBal", "c_mktsegment", "not_there"])
    return sh.available(sh.lower_names(kept), ["c_custkey", "o_orderstatus", "o_totalprice"])


# --- versions ----------------------------------------------------------------------------------------

_V = inputs.VERSIONS


@query(
    "latest_versions",
    f"WITH {_V} SELECT * FROM versions QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY version_id DESC) = 1",
)
def latest_versions(spark, d):
    return vs.latest(inputs.versions(spark, d), ["job_id"])


@query(
    "active_versions",
    f"""WITH {_V} SELECT * FROM versions WHERE is_active
QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY version_id DESC) = 1""",
)
def active_versions(spark, d):
    return vs.active(inputs.versions(spark, d), ["job_id"])


@query("next_versions", f"WITH {_V} SELECT job_id, coalesce(max(version_id), 0) + 1 AS next_version FROM versions GROUP BY 1")
def next_versions(spark, d):
    return vs.next_version(inputs.versions(spark, d), ["job_id"])


@query("versions_newest_first", f"WITH {_V} SELECT job_id, version_id, config FROM versions ORDER BY job_id, version_id DESC")
def versions_newest_first(spark, d):
    return vs.versions_newest_first(inputs.versions(spark, d).select("job_id", "version_id", "config"), ["job_id"])


@query(
    "jobs_with_active_version",
    f"""WITH {_V}, latest AS (SELECT * FROM versions WHERE is_active
  QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY version_id DESC) = 1)
SELECT c_custkey AS job_id, c_name AS job_name, version_id, config FROM customer JOIN latest ON job_id = c_custkey""",
)
def jobs_with_active_version(spark, d):
    base = inputs.table(spark, d, "customer").select(F.col("c_custkey").alias("job_id"), F.col("c_name").alias("job_name"))
    return sh.with_active_version(base, vs.active(inputs.versions(spark, d), ["job_id"]), "job_id")


@query(
    "new_versions",
    f"""WITH {_V}, arriving AS (SELECT c_custkey AS job_id, c_name AS config FROM customer WHERE c_mktsegment = 'BUILDING')
SELECT job_id, version_id, is_active AND job_id NOT IN (SELECT job_id FROM arriving) AS is_active, config FROM versions
UNION ALL SELECT a.job_id, coalesce(max(v.version_id), 0) + 1, true, a.config
FROM arriving a LEFT JOIN versions v ON v.job_id = a.job_id GROUP BY a.job_id, a.config""",
)
def new_versions(spark, d):
    arriving = inputs.table(spark, d, "customer").filter("c_mktsegment = 'BUILDING'")
    arriving = arriving.select(F.col("c_custkey").alias("job_id"), F.col("c_name").alias("config"))
    return vs.with_new_versions(inputs.versions(spark, d), arriving, ["job_id"])


@query(
    "activated_versions",
    f"""WITH {_V}, chosen AS (SELECT job_id, min(version_id) AS version_id FROM versions GROUP BY 1 HAVING count(*) > 3)
SELECT v.job_id, v.version_id, v.config, CASE WHEN c.job_id IS NULL THEN v.is_active ELSE v.version_id = c.version_id END AS is_active
FROM versions v LEFT JOIN chosen c ON c.job_id = v.job_id""",
)
def activated_versions(spark, d):
    versions = inputs.versions(spark, d)
    chosen = versions.groupBy("job_id").agg(F.min("version_id").alias("version_id"), F.count(F.lit(1)).alias("n"))
    return vs.activated(versions, chosen.filter("n > 3").drop("n"), ["job_id"])


@query(
    "changed_configs",
    """WITH stored AS (SELECT conv_id AS job_id, arg_max(role, turn) AS role, max(turn) AS turn FROM conversations GROUP BY 1),
arriving AS (SELECT c_custkey AS job_id, 'user' AS role, CAST(c_nationkey % 4 AS BIGINT) AS turn FROM customer)
SELECT a.job_id, a.role, a.turn, CASE WHEN s.job_id IS NULL THEN 'Created'
  WHEN s.role IS NOT DISTINCT FROM a.role AND s.turn IS NOT DISTINCT FROM a.turn THEN 'Existed' ELSE 'Updated' END AS action
FROM arriving a LEFT JOIN stored s ON s.job_id = a.job_id""",
)
def changed_configs(spark, d):
    turns = inputs.table(spark, d, "conversations").groupBy(F.col("conv_id").alias("job_id"))
    stored = turns.agg(F.max_by("role", "turn").alias("role"), F.max("turn").alias("turn"))
    arriving = inputs.table(spark, d, "customer").select(
        F.col("c_custkey").alias("job_id"), F.lit("user").alias("role"), (F.col("c_nationkey") % 4).cast("long").alias("turn")
    )
    return vs.changed(stored, arriving, ["job_id"], ["role", "turn"])


def _config_sql(turn: str = "turn") -> str:
    """Keys in order, no spaces."""
    return f"""'{{"job_id":' || job_id || ',"role":"' || role || '","size":' || size || ',"turn":' || {turn} || '}}'"""


_FIRST = "SELECT conv_id AS job_id, turn, role, length(text) AS size FROM conversations"


@query(
    "config_as_json",
    f"""SELECT job_id, turn, config, sha256(config) AS config_hash FROM (SELECT job_id, turn, {_config_sql()} AS config FROM ({_FIRST}))""",
)
def config_as_json(spark, d):
    """Conversation turns as configs: one spelling, whatever the order of the columns."""
    turns = inputs.table(spark, d, "conversations").select(F.col("conv_id").alias("job_id"), "turn", "role", F.length("text").alias("size"))
    return vs.config_json(turns, ["turn", "role", "job_id", "size"]).select("job_id", "turn", "config", "config_hash")


_STAMPED = "2024-06-01 08:00:00"


@query(
    "updated_configs",
    f"""WITH first AS (SELECT job_id, role, size, turn FROM ({_FIRST}) QUALIFY turn = min(turn) OVER (PARTITION BY job_id)),
stored AS (SELECT job_id, {_config_sql()} AS config FROM first),
arriving AS (SELECT job_id, {_config_sql("99")} AS config FROM first WHERE job_id % 3 = 1
  UNION ALL SELECT job_id + 1000000, config FROM stored WHERE job_id % 5 = 0)
SELECT s.job_id, s.config, CASE WHEN job_id % 3 = 1 THEN 'deleted' ELSE 'active' END AS status,
  CASE WHEN job_id % 3 = 1 THEN TIMESTAMP '{_STAMPED}' END AS updated_at FROM stored s
UNION ALL SELECT job_id, config, 'active', TIMESTAMP '{_STAMPED}' FROM arriving""",
)
def updated_configs(spark, d):
    """Of the stored configs a third comes again in another spelling, a third has changed, and some are new."""
    turns = inputs.table(spark, d, "conversations").select(F.col("conv_id").alias("job_id"), "turn", "role", F.length("text").alias("size"))
    first = vs.keep_first(turns, ["job_id"], ["turn"])
    columns = ["job_id", "role", "size", "turn"]
    stored = vs.config_json(first, columns).select("job_id", "config", F.lit("active").alias("status"), F.lit(None).cast("timestamp").alias("updated_at"))
    spelled = F.to_json(F.struct("turn", "size", "role", "job_id"), {"pretty": "true"})
    again = first.filter("job_id % 3 = 0").select("job_id", spelled.alias("config"))
    other = vs.config_json(first.filter("job_id % 3 = 1").withColumn("turn", F.lit(99)), columns).select("job_id", "config")
    new = stored.filter("job_id % 5 = 0").select((F.col("job_id") + 1_000_000).alias("job_id"), "config")
    return vs.with_updates(stored, again.unionByName(other).unionByName(new), ["job_id"], now=F.lit(_STAMPED).cast("timestamp"))[0]


@query("existing_keys", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def existing_keys(spark, d):
    orders = inputs.table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return vs.existing(inputs.table(spark, d, "customer").select("c_custkey"), orders, ["c_custkey"])


@query(
    "run_summary",
    f"""WITH h AS (SELECT o_custkey AS job_id, CASE o_orderstatus WHEN 'F' THEN 'success' ELSE 'failed' END AS status,
  o_orderdate + to_seconds(o_orderkey) AS run_at FROM orders)
SELECT job_id, count(*) AS total_runs, {rounded_sql("avg(CASE WHEN status = 'success' THEN 1.0::DOUBLE ELSE 0.0 END)", 6, "success_rate")},
  max(run_at) AS last_run_at, arg_max(status, run_at) AS last_run_status FROM h GROUP BY 1""",
)
def run_summary(spark, d):
    at = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(secs=F.col("o_orderkey"))
    history = inputs.table(spark, d, "orders").select(
        F.col("o_custkey").alias("job_id"), F.when(F.col("o_orderstatus") == "F", "success").otherwise("failed").alias("status"), at.alias("run_at")
    )
    out = vs.run_summary(history)
    return out.select("job_id", "total_runs", rounded("success_rate"), "last_run_at", "last_run_status")


# --- profiles ----------------------------------------------------------------------------------------

_CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
_UNIQUE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c})::DOUBLE / nullif(count({c}), 0) AS distinct_ratio FROM customer"
    for c in _CUSTOMER
)


@query("uniqueness", f"SELECT column_name, {rounded_sql('distinct_ratio')} FROM ({_UNIQUE_SQL})")
def uniqueness(spark, d):
    return pf.uniqueness(inputs.table(spark, d, "customer")).select("column_name", rounded("distinct_ratio"))


@query("key_candidates", f"SELECT column_name FROM ({_UNIQUE_SQL}) WHERE distinct_ratio >= 0.99")
def key_candidates(spark, d):
    return pf.key_candidates(inputs.table(spark, d, "customer")).select("column_name")


_ORDERS = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz",
    "o_orderpriority": "string",
}


@query(
    "column_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) FILTER ({c} IS NULL) AS null_count, "
        f"count(DISTINCT {c}) AS distinct_count FROM orders"
        for c, t in _ORDERS.items()
    ),
)
def column_profile(spark, d):
    return pf.profile(inputs.table(spark, d, "orders"))


@query(
    "profile_from_sketches",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS rows, count(*) FILTER ({c} IS NULL) AS null_count, "
        f"count(DISTINCT {c}) >= 0.4 * count({c}) AS varied FROM orders"
        for c, t in _ORDERS.items()
        if c != "o_orderdate"
    ),
)
def profile_from_sketches(spark, d):
    """Sketches per order status, stored and united: counts are exact, the distinct share is told from few to many values."""
    orders = inputs.table(spark, d, "orders").drop("o_orderdate").withColumn("status", F.col("o_orderstatus"))
    stored = staged(pf.column_sketches(orders, ["status"]), "sketches")
    return pf.united(stored).select("column_name", "data_type", "rows", "null_count", (F.col("distinct_ratio") >= 0.4).alias("varied"))


@query(
    "keys_of_tables",
    f"""SELECT 'customer' AS table_name, column_name, 'detected' AS source FROM ({_UNIQUE_SQL}) WHERE distinct_ratio >= 0.99
UNION ALL SELECT 'orders', 'o_orderkey', 'declared'""",
)
def keys_of_tables(spark, d):
    """Key columns: declared for orders, detected for customers."""
    declared = spark.createDataFrame([("o_orderkey",)], "column_name string")
    orders = pf.keys_of(inputs.table(spark, d, "orders"), declared).select(F.lit("orders").alias("table_name"), "*")
    return pf.keys_of(inputs.table(spark, d, "customer")).select(F.lit("customer").alias("table_name"), "*").unionByName(orders)


@query(
    "columns_with_types",
    "SELECT * FROM (VALUES " + ", ".join(f"('{c}', '{t}')" for c, t in _ORDERS.items()) + ") v(column_name, data_type) WHERE (SELECT count(*) FROM orders) > 0",
)
def columns_with_types(spark, d):
    return pf.columns_of(inputs.table(spark, d, "orders"))


@query(
    "dataset_info",
    f"""WITH {inputs.FEATURES} SELECT ticker, count(*) AS total_samples, 4 AS n_features, min(date) AS first_date,
  max(date) AS last_date, '{",".join(inputs.FEATURE_COLUMNS)}' AS feature_cols FROM features GROUP BY ticker""",
)
def dataset_info(spark, d):
    return pf.dataset_info(inputs.features(spark, d), [*inputs.FEATURE_COLUMNS, "RSI"], by=["ticker"])


@query(
    "tables_per_schema",
    """SELECT r_name AS schema_name, list(n_name ORDER BY n_name) AS tables, count(*) AS table_count
FROM nation JOIN region ON r_regionkey = n_regionkey GROUP BY 1""",
)
def tables_per_schema(spark, d):
    nations = inputs.table(spark, d, "nation").join(inputs.table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return pf.tables_per_schema(nations.select(F.col("r_name").alias("schema_name"), F.col("n_name").alias("table_name")))


@query(
    "declared_keys",
    """SELECT r_name AS table_schema, n_name AS table_name, c_name AS column_name FROM customer
JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey WHERE c_mktsegment = 'BUILDING'""",
)
def declared_keys(spark, d):
    """Nations as constraints of a region, customers as their columns; one segment stands for primary keys."""
    places = inputs.table(spark, d, "nation").join(inputs.table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    customers = inputs.table(spark, d, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    kind = F.when(F.col("c_mktsegment") == "BUILDING", "PRIMARY KEY").otherwise("UNIQUE")
    constraint = F.concat("n_name", F.lit("/"), "c_mktsegment")
    constraints = customers.select(
        constraint.alias("constraint_name"), F.col("r_name").alias("table_schema"), F.col("n_name").alias("table_name"), kind.alias("constraint_type")
    ).distinct()
    usage = customers.select(
        constraint.alias("constraint_name"), F.col("r_name").alias("table_schema"), F.col("c_name").alias("column_name")
    )
    return pf.declared_keys(constraints, usage)


@query("preview", "SELECT n_nationkey, n_name, n_regionkey FROM nation ORDER BY n_nationkey LIMIT 15")
def preview(spark, d):
    return pf.preview(inputs.table(spark, d, "nation").orderBy("n_nationkey")).rows
