"""Sources, sinks, upserts, change detection and history."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelgrove.operators import governance, plugins
from reelgrove.operators.dedupe import dedupe_by_key
from reelgrove.operators.index_sync import VectorIndex
from reelgrove.operators.upsert import change_feed, scd2_from_cdc, upsert_by_key
from reelgrove.plans.registry import query
from reelgrove.session import shared_dir
from reelgrove.sources import curve, sample_views as v, tables
from reelgrove.sources.tables import read_table


@query("src_parquet", "SELECT * FROM orders")
def src_parquet(spark, folder):
    return read_table(spark, folder, "orders")


@query("sink_parquet", "SELECT * FROM interactions")
def sink_parquet(spark, folder):
    return tables.write_parquet(v.interactions(spark, folder), shared_dir(spark, "interactions"))


@query("ctas_projection", "SELECT content_id, title, synopsis, genre FROM silver_items")
def ctas_projection(spark, folder):
    return tables.create_table_as(
        v.all_item_features(spark, folder),
        "item_features_for_index",
        ["content_id", "title", "synopsis", "genre"],
        shared_dir(spark, "item_features_for_index"),
    )


@query("clustered_layout", "SELECT * FROM silver_interactions")
def clustered_layout(spark, folder):
    laid = tables.clustered_layout(
        v.silver_interactions(spark, folder), ["user_id", "content_id"]
    )
    return tables.write_parquet(laid, shared_dir(spark, "clustered"))


@query("curve_layout", """
    SELECT * EXCLUDE (key), key FROM (
        SELECT *, 'content_id' AS key FROM silver_interactions
        WHERE content_id = (SELECT min(content_id) FROM silver_interactions)
        UNION ALL SELECT *, 'user_id' FROM silver_interactions
        WHERE user_id = (SELECT min(user_id) FROM silver_interactions))""")
def curve_layout(spark, folder):
    """All interactions laid along a curve; the rows of the least item and of the least user."""
    laid = curve.curve_layout(v.silver_interactions(spark, folder), ["user_id", "content_id"])
    written = tables.write_parquet(laid, shared_dir(spark, "curve"))
    least = written.agg(F.min("content_id"), F.min("user_id")).first()
    found = [
        written.where(F.col(key) == F.lit(value)).withColumn("key", F.lit(key))
        for key, value in zip(("content_id", "user_id"), least)
    ]
    return found[0].unionByName(found[1])


@query("table_listing", """
    SELECT 'bronze_interactions' AS table_name, count(*) AS rows FROM interactions
    UNION ALL SELECT 'bronze_items', count(*) FROM items
    UNION ALL SELECT 'bronze_users', count(*) FROM users
    UNION ALL SELECT 'gold_interactions', count(*) FROM gold_interactions
    UNION ALL SELECT 'silver_interactions', count(*) FROM silver_interactions
    UNION ALL SELECT 'silver_items', count(*) FROM silver_items
    UNION ALL SELECT 'silver_users', count(*) FROM silver_users""")
def table_listing(spark, folder):
    views = {
        "bronze_users": v.users,
        "bronze_items": v.items,
        "bronze_interactions": v.interactions,
        "silver_users": v.silver_users,
        "silver_items": v.silver_items,
        "silver_interactions": v.silver_interactions,
        "gold_interactions": v.gold_interactions,
    }
    counts = None
    for name, build in views.items():
        build(spark, folder).createOrReplaceTempView(name)
        rows = spark.table(name).agg(F.lit(name).alias("table_name"), F.count("*").alias("rows"))
        counts = rows if counts is None else counts.unionByName(rows)
    return tables.table_listing(spark, ["bronze_", "silver_", "gold_"]).join(counts, "table_name")


# ---- upsert -----------------------------------------------------------------------

_USER_CHANGES = """
    SELECT user_id, CAST(age + 1 AS INTEGER) AS age, country, segment, email, phone
    FROM silver_users WHERE segment = 'BUILDING'
    UNION ALL
    SELECT -1 - s_suppkey, CAST(floor(s_acctbal / 100) AS INTEGER), n_name, 'SUPPLIER',
           concat(s_name, '@example.invalid'), CAST(NULL AS VARCHAR)
    FROM supplier JOIN nation ON s_nationkey = n_nationkey"""


def _user_changes(spark, folder):
    updates = (
        v.silver_users(spark, folder)
        .where("segment = 'BUILDING'")
        .withColumn("age", (F.col("age") + 1).cast("int"))
    )
    nation = read_table(spark, folder, "nation")
    added = (
        read_table(spark, folder, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            (F.lit(-1) - F.col("s_suppkey")).alias("user_id"),
            F.floor(F.col("s_acctbal") / 100).cast("int").alias("age"),
            F.col("n_name").alias("country"),
            F.lit("SUPPLIER").alias("segment"),
            F.concat("s_name", F.lit("@example.invalid")).alias("email"),
            F.lit(None).cast("string").alias("phone"),
        )
    )
    return updates.unionByName(added)


@query("upsert_by_key", f"""
    WITH changes AS ({_USER_CHANGES})
    SELECT * FROM silver_users WHERE user_id NOT IN (SELECT user_id FROM changes)
    UNION ALL SELECT * FROM changes""")
def upsert(spark, folder):
    return upsert_by_key(v.silver_users(spark, folder), _user_changes(spark, folder), "user_id")


@query("keyed_table", f"""
    WITH changes AS ({_USER_CHANGES})
    SELECT * FROM silver_users WHERE user_id NOT IN (SELECT user_id FROM changes)
    UNION ALL SELECT * FROM changes""")
def keyed_table(spark, folder):
    """The same upsert through a written table, of which only touched partitions are replaced."""
    table = tables.KeyedTable(spark, shared_dir(spark, "users"), "user_id")
    table.upsert(v.silver_users(spark, folder))
    return table.upsert(_user_changes(spark, folder))


@query("change_feed", f"""
    WITH changes AS ({_USER_CHANGES}),
    after AS (
        SELECT * FROM silver_users
        WHERE user_id NOT IN (SELECT user_id FROM changes) AND country <> 'NATION_3'
        UNION ALL SELECT * FROM changes)
    SELECT 'insert' AS change_type, a.* FROM after a
    WHERE user_id NOT IN (SELECT user_id FROM silver_users)
    UNION ALL
    SELECT 'delete', b.* FROM silver_users b WHERE user_id NOT IN (SELECT user_id FROM after)
    UNION ALL
    SELECT 'update', a.* FROM after a JOIN silver_users b ON a.user_id = b.user_id
    WHERE (a.age, a.country, a.segment, a.email, a.phone)
          IS DISTINCT FROM (b.age, b.country, b.segment, b.email, b.phone)""")
def feed(spark, folder):
    before = v.silver_users(spark, folder)
    changes = _user_changes(spark, folder)
    after = upsert_by_key(before.where("country <> 'NATION_3'"), changes, "user_id")
    return change_feed(before, after, "user_id")


@query("index_sync", """
    WITH later AS (
        SELECT content_id, CASE WHEN genre LIKE 'PROMO%' THEN concat(title, ' again') ELSE title END AS title,
               CASE WHEN genre LIKE 'PROMO%' THEN 'update' END AS change
        FROM silver_items WHERE language <> 'Brand#11'
        UNION ALL
        SELECT -1 - s_suppkey, s_name, 'insert' FROM supplier)
    SELECT content_id, CAST(length(title) AS FLOAT) AS letters,
           CAST(length(title) - length(replace(title, ' ', '')) AS FLOAT) AS spaces,
           CAST(CASE WHEN change IS NULL THEN 1 ELSE 2 END AS INTEGER) AS embedded_by
    FROM later""")
def index_sync(spark, folder):
    """Vectors after two syncs, and which sync made each: the second embeds changed items only.

    Between the two some titles change, the items of one language go and new ones come.
    """
    def embed(number):
        def counting():
            return lambda texts: [[len(t), t.count(" ")] for t in texts]

        def run(rows):
            made = plugins.embed_with(rows, "title", counting)
            return made.select("content_id", "embedding", F.lit(number).alias("embedded_by"))

        return run

    before = v.silver_items(spark, folder).select("content_id", "title", "genre", "language")
    changed = F.col("genre").startswith("PROMO")
    after = (
        before.where("language <> 'Brand#11'")
        .withColumn("title", F.when(changed, F.concat("title", F.lit(" again"))).otherwise(F.col("title")))
        .unionByName(
            read_table(spark, folder, "supplier").select(
                (F.lit(-1) - F.col("s_suppkey")).alias("content_id"), F.col("s_name").alias("title")
            ),
            allowMissingColumns=True,
        )
    )
    index = VectorIndex(spark, shared_dir(spark, "index"), "content_id", ["title"])
    index.sync(before, embed(1))
    index.sync(after, embed(2))
    return index.read().select(
        "content_id", F.col("embedding")[0].alias("letters"), F.col("embedding")[1].alias("spaces"), "embedded_by"
    )


@query("scd2_from_cdc", """
    WITH changes AS (
        SELECT user_id, ts, event_type, value FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) AS rn FROM events)
        WHERE rn = 1)
    SELECT user_id, event_type, value, ts AS valid_from,
           lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to,
           lead(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL AS is_current
    FROM changes""")
def scd2(spark, folder):
    changes = read_table(spark, folder, "events").select(
        "event_id", "user_id", "ts", "event_type", "value"
    )
    return scd2_from_cdc(changes, "user_id", "ts", "event_id").drop("event_id")


# ---- assets -----------------------------------------------------------------------

def _pages_as_assets(spark, folder):
    return read_table(spark, folder, "pages").select(
        F.pmod("page_id", F.lit(7)).cast("int").alias("chapter"),
        F.regexp_extract("url", r"^([a-z]+)://", 1).alias("asset_type"),
        F.col("url").alias("name"),
        F.col("page_id").cast("string").alias("id"),
        "url",
        F.lit("").alias("description"),
        F.timestamp_seconds("page_id").alias("created_at"),
        "page_id",
    )


_ASSETS = """
    WITH assets AS (
        SELECT CAST(page_id % 7 AS INTEGER) AS chapter, regexp_extract(url, '^([a-z]+)://', 1) AS asset_type,
               url AS name, CAST(page_id AS VARCHAR) AS id, url, '' AS description,
               TIMESTAMP '1970-01-01' + to_seconds(page_id) AS created_at,
               row_number() OVER (PARTITION BY url ORDER BY page_id) AS first_rn,
               row_number() OVER (PARTITION BY url ORDER BY page_id DESC) AS last_rn
        FROM pages)
    SELECT chapter, asset_type, name, id, url,
           CASE WHEN url LIKE '%?%' THEN 'refreshed' ELSE description END AS description, created_at
    FROM assets WHERE CASE WHEN url LIKE '%?%' THEN last_rn = 1 ELSE first_rn = 1 END"""


def _assets(spark, folder):
    pages = _pages_as_assets(spark, folder)
    log = dedupe_by_key(pages, ["asset_type", "name"], ["page_id"]).drop("page_id")
    fresh = (
        dedupe_by_key(pages, ["asset_type", "name"], [F.desc("page_id")])
        .where(F.col("url").contains("?"))
        .withColumn("description", F.lit("refreshed"))
        .drop("page_id")
    )
    return governance.asset_log(log, fresh)


@query("asset_log", _ASSETS)
def asset_log(spark, folder):
    return _assets(spark, folder).withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


@query("sorted_listing", _ASSETS + " ORDER BY chapter, asset_type, name")
def sorted_listing(spark, folder):
    listed = governance.sorted_listing(_assets(spark, folder))
    return listed.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))
