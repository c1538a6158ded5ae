"""The entity models over landed payloads, each with plain SQL over the source tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.operators import planning
from layerwright.plans import contracts, serving
from layerwright.plans import marts as m
from layerwright.plans import staging as stg
from layerwright.session import cut_lineage, fresh_path
from layerwright.sources import raw
from layerwright.sources import tables
from layerwright.streaming.landing import follow_landing
from workloads import landing
from workloads.registry import query, table

# ---- the landed entities as SQL ------------------------------------------------------------------

ENTITIES = """
entities AS (
  SELECT p_partkey + 1 AS poke_id, p_name AS poke_name, p_type, p_brand, p_size, p_retailprice,
         CASE WHEN p_size > 25 THEN TIMESTAMP '2024-06-01' ELSE TIMESTAMP '2024-01-01' END AS fetch_date,
         round((p_size + CASE WHEN p_size > 25 THEN 10 ELSE 0 END) / 10, 2) AS height,
         round(CAST(floor(p_retailprice) AS INTEGER) / 10, 2) AS weight,
         CASE WHEN p_size = 10 THEN NULL WHEN p_size > 10 THEN p_size % 9 + 1
              ELSE (p_size + 3) % 9 + 1 END AS poke_gen,
         CAST(p_partkey % 256 AS INTEGER) AS hp,
         CAST(p_partkey * 7 % 256 AS INTEGER) AS attack,
         CAST(p_partkey * 11 % 256 AS INTEGER) AS defense,
         CAST(p_partkey * 13 % 256 AS INTEGER) AS special_attack,
         CAST(p_partkey * 17 % 256 AS INTEGER) AS special_defense,
         CASE WHEN p_size = 1 THEN NULL ELSE CAST(p_partkey * 19 % 256 AS INTEGER) END AS speed
  FROM part),
stats AS (
  SELECT fetch_date, poke_id, hp, attack, defense, special_attack, special_defense, speed,
         hp + attack + defense + special_attack + special_defense + speed AS total_stat_points
  FROM entities),
types AS (
  SELECT md5(poke_id || '-1') AS type_id, fetch_date, poke_id, 1 AS slot, p_type AS type FROM entities
  UNION ALL
  SELECT md5(poke_id || '-2'), fetch_date, poke_id, 2, p_brand FROM entities WHERE p_size > 25),
past AS (
  SELECT poke_id, 1 AS slot, 'OLD ' || p_type AS type, (p_size + 3) % 9 + 2 AS period
  FROM entities WHERE p_size <= 10
  UNION ALL
  SELECT poke_id, 1, 'MID ' || p_type, (p_size + 3) % 9 + 4 FROM entities WHERE p_size <= 5
  UNION ALL
  SELECT poke_id, 2, 'OLD ' || p_brand, (p_size + 3) % 9 + 2 FROM entities WHERE p_size <= 5
  UNION ALL
  SELECT poke_id, 2, 'OLD ' || p_brand, p_size % 9 + 3 FROM entities WHERE p_size > 45),
past_stat AS (
  SELECT poke_id, s.stat, s.stat_value, p_size % 9 + 3 AS period
  FROM entities, (VALUES ('attack', 10), ('special', 20)) AS s(stat, stat_value)
  WHERE p_size BETWEEN 20 AND 23),
learned AS (
  SELECT DISTINCT fetch_date, poke_id,
         ((poke_id - 1) * 7 + j * 13) % (SELECT count(*) FROM supplier) + 1 AS move_id
  FROM entities, unnest(range(0, p_size % 5 + 1)) AS t(j)),
moves AS (
  SELECT TIMESTAMP '2024-01-01' AS fetch_date, s_suppkey + 1 AS move_id, lower(s_name) AS move_name,
         CASE WHEN s_nationkey >= 6 THEN CAST(floor(abs(s_acctbal)) AS INTEGER) % 150 END AS power,
         CASE WHEN s_nationkey >= 3 THEN s_nationkey + 50 END AS accuracy,
         s_nationkey + 5 AS pp, s_nationkey % 3 - 1 AS priority, 'type-' || s_nationkey AS type,
         CASE s_nationkey % 3 WHEN 0 THEN 'physical' WHEN 1 THEN 'special' ELSE 'status' END AS damage_class,
         s_nationkey % 9 + 1 AS poke_gen
  FROM supplier),
generations AS (
  SELECT n_nationkey + 1 AS poke_gen, lower(n_name) AS gen_api_name, 'Nation ' || n_name AS gen_name
  FROM nation),
strongest AS (
  SELECT r.* EXCLUDE (pct),
         CASE WHEN pct >= 0.95 THEN 'S' WHEN pct >= 0.80 THEN 'A' WHEN pct >= 0.55 THEN 'B'
              WHEN pct >= 0.30 THEN 'C' WHEN pct >= 0.10 THEN 'D' ELSE 'F' END AS tier
  FROM (SELECT e.poke_gen, e.poke_id, e.poke_name, s.hp, s.attack, s.defense, s.special_attack,
               s.special_defense, s.speed, s.total_stat_points,
               row_number() OVER (ORDER BY s.total_stat_points DESC NULLS LAST, e.poke_id) AS rank,
               percent_rank() OVER (ORDER BY s.total_stat_points ASC NULLS LAST) AS pct
        FROM entities e JOIN stats s USING (poke_id)) r),
starters AS (
  SELECT e.poke_gen, e.poke_id, e.poke_name, s.hp, s.attack, s.defense, s.special_attack,
         s.special_defense, s.speed, s.total_stat_points,
         row_number() OVER (ORDER BY s.total_stat_points DESC NULLS LAST, e.poke_id) AS rank
  FROM entities e JOIN stats s USING (poke_id) WHERE e.p_brand = 'Brand#1'),
species AS (
  SELECT TIMESTAMP '2024-06-01' AS fetch_date, poke_id,
         CASE WHEN p_size <> 7 THEN poke_name || ' is ' || p_type END AS description,
         g.genus, p_brand = 'Brand#9' AS is_legendary, p_type = 'SMALL' AS is_mythical,
         p_size < 3 AS is_baby, p_type AS color,
         CASE WHEN p_size <= 40 THEN p_brand END AS habitat,
         CASE WHEN p_size > 20 THEN 'parent of ' || poke_name END AS evolves_from_name,
         CASE WHEN p_size > 20 THEN poke_id - 1 END AS evolves_from_id
  FROM entities e
  LEFT JOIN (SELECT poke_id AS gid, p_brand AS genus FROM entities WHERE p_size <> 9
             UNION ALL SELECT poke_id, 'second' FROM entities WHERE p_size = 8) g ON g.gid = e.poke_id)
"""

# The rule itself, row by row: what precedes a row is the greatest earlier period of its slot, where a
# current row comes after every past one.
_WINDOWS = """
held AS (
  SELECT poke_id, {slot}, {value}, period FROM {past}
  UNION ALL SELECT poke_id, {slot}, {value}, NULL FROM {current}),
placed AS (
  SELECT h.*, e.fetch_date, e.poke_gen AS intro,
         (SELECT max(q.period) FROM {past} q
          WHERE q.poke_id = h.poke_id AND q.{slot} = h.{slot}
            AND (h.period IS NULL OR q.period < h.period
                 OR (q.period = h.period AND q.{value} < h.{value}))) AS earlier
  FROM held h LEFT JOIN entities e ON e.poke_id = h.poke_id),
bounded AS (
  SELECT fetch_date, poke_id, {slot}, {value}, coalesce({prior} + 1, intro) AS valid_from_gen,
         CAST({until} AS INTEGER) AS valid_to_gen
  FROM placed),
history AS (
  SELECT md5(concat_ws('-', poke_id, {slot}, coalesce(CAST(valid_from_gen AS VARCHAR),
                                                      '_dbt_utils_surrogate_key_null_'))) AS {key}, *
  FROM bounded)
"""


def sql(select: str, *extra: str) -> str:
    return "WITH " + ",".join([ENTITIES, *extra]) + select


TYPE_HISTORY = _WINDOWS.format(
    prior="earlier", until="period", past="past", current="types", slot="slot", value="type", key="type_id"
)
TYPE_HISTORY_AS_WRITTEN = _WINDOWS.format(
    prior="CASE WHEN earlier IS NOT NULL THEN intro END",
    until="CASE WHEN period IS NOT NULL THEN intro END",
    past="past",
    current="types",
    slot="slot",
    value="type",
    key="type_id",
)
STAT_ROWS = """
stat_rows AS (
  SELECT fetch_date, poke_id, s.stat, s.stat_value
  FROM stats, unnest([
    struct_pack(stat := 'hp', stat_value := hp),
    struct_pack(stat := 'attack', stat_value := attack),
    struct_pack(stat := 'defense', stat_value := defense),
    struct_pack(stat := 'special-attack', stat_value := special_attack),
    struct_pack(stat := 'special-defense', stat_value := special_defense),
    struct_pack(stat := 'speed', stat_value := speed)]) AS t(s)
  WHERE s.stat_value IS NOT NULL)
"""
STAT_HISTORY = STAT_ROWS + "," + _WINDOWS.format(
    prior="earlier",
    until="period",
    past="past_stat",
    current="stat_rows",
    slot="stat",
    value="stat_value",
    key="stat_id",
)
MART_STATS = (
    "poke_id, hp, attack, defense, special_attack, special_defense, speed, total_stat_points"
)


# ---- generations, versions, catalogue ------------------------------------------------------------


@query(
    "SELECT TIMESTAMP '2024-01-01' AS fetch_date, n_nationkey + 1 AS poke_gen, "
    "lower(n_name) AS gen_api_name, 'Nation ' || n_name AS gen_name FROM nation"
)
def model_generations(spark: SparkSession, folder: str) -> DataFrame:
    return landing.views(spark, folder)["stg_generations"]


@query(
    "SELECT DISTINCT n_nationkey + 1 AS version_group_id, lower(n_name) AS version_group_name, "
    "n_regionkey + 1 AS poke_gen FROM nation"
)
def model_version_groups(spark: SparkSession, folder: str) -> DataFrame:
    return landing.live_marts(spark, folder)["mart_version_groups"]


@query(
    "SELECT n_nationkey * 2 + v.n AS version_id, lower(n_name) || v.suffix AS version_name, "
    "n_nationkey + 1 AS version_group_id FROM nation, (VALUES (1, '-red'), (2, '-blue')) v(n, suffix)"
)
def model_versions(spark: SparkSession, folder: str) -> DataFrame:
    return landing.live_marts(spark, folder)["mart_version_group_versions"]


@query(
    """
    WITH listed AS (
      SELECT p_partkey + 1 AS poke_id, p_size, p_name FROM part),
    docs AS (
      SELECT TIMESTAMP '2024-01-01' AS fetch_date, (p_size + 3) % 9 + 1 AS poke_gen, poke_id,
             'old ' || p_name AS poke_name
      FROM listed WHERE p_size <> 10
      UNION ALL
      SELECT TIMESTAMP '2024-06-01', p_size % 9 + 1, poke_id, p_name FROM listed WHERE p_size > 10),
    entries AS (
      SELECT * FROM docs
      UNION ALL
      SELECT fetch_date, poke_gen, poke_id + 1000000000000, poke_name || ' form' FROM docs)
    SELECT * FROM entries
    QUALIFY row_number() OVER (PARTITION BY poke_id ORDER BY fetch_date DESC) = 1
    """
)
def model_catalogue(spark: SparkSession, folder: str) -> DataFrame:
    return landing.views(spark, folder)["stg_pokemon_catalogue"]


@query(
    """
    SELECT p_partkey + 1 + f.form AS poke_id, (p_size + 3) % 9 + 1 AS poke_gen
    FROM part, (VALUES (0), (1000000000000)) AS f(form) WHERE p_size <> 10
    UNION ALL
    SELECT p_partkey + 1 + f.form, p_size % 9 + 1
    FROM part, (VALUES (0), (1000000000000)) AS f(form) WHERE p_size > 10
    """
)
def id_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return raw.id_lookup(landing.catalogue(spark, folder))


@query(sql("SELECT fetch_date, poke_gen, poke_id, poke_name, height, weight FROM entities"))
def model_entities(spark: SparkSession, folder: str) -> DataFrame:
    return landing.views(spark, folder)["stg_pokemons"]


@query(sql("SELECT poke_gen, poke_id, poke_name, height, weight FROM entities"))
def mart_entities(spark: SparkSession, folder: str) -> DataFrame:
    return landing.live_marts(spark, folder)["mart_pokemons"]


@query(
    sql(
        """
        SELECT fetch_date, poke_id,
               CASE WHEN p_size = 1 THEN 5 ELSE 6 END AS n_stats,
               CASE WHEN p_size > 25 THEN 2 ELSE 1 END AS n_types,
               p_size % 5 + 2 AS n_moves,
               CASE WHEN p_size <= 5 THEN 2 WHEN p_size <= 10 OR p_size > 45 THEN 1 ELSE 0 END AS n_past_types,
               CASE WHEN p_size BETWEEN 20 AND 23 THEN 1 ELSE 0 END AS n_past_stats
        FROM entities
        """
    )
)
def model_json_columns(spark: SparkSession, folder: str) -> DataFrame:
    arrays = stg.entity_arrays(stg.newest_fetch(landing.entities(spark, folder)))
    sizes = [F.size(name).alias(f"n_{name}") for name in stg.ENTITY_ARRAYS]
    return arrays.select("fetch_date", "poke_id", *sizes)


# ---- moves, species ------------------------------------------------------------------------------


@query(sql("SELECT * EXCLUDE (fetch_date) FROM moves"))
def model_moves(spark: SparkSession, folder: str) -> DataFrame:
    return landing.live_marts(spark, folder)["mart_moves"]


@query(sql("SELECT md5(poke_id || '-' || move_id) AS pokemon_move_id, * FROM learned"))
def model_bridge(spark: SparkSession, folder: str) -> DataFrame:
    return landing.views(spark, folder)["int_pokemon_moves"]


@query(sql("SELECT * FROM species"))
def model_species(spark: SparkSession, folder: str) -> DataFrame:
    return landing.views(spark, folder)["stg_pokemon_species"]


# ---- stats, types, history -----------------------------------------------------------------------


@query(sql(f"SELECT {MART_STATS} FROM stats"))
def model_stats(spark: SparkSession, folder: str) -> DataFrame:
    return landing.live_marts(spark, folder)["mart_stats"]


@query(sql("SELECT * FROM types"))
def model_types(spark: SparkSession, folder: str) -> DataFrame:
    return landing.views(spark, folder)["int_types"]


@query(
    sql(
        """
        SELECT md5(p.poke_id || '-' || p.period || '-' || p.slot) AS past_type_id, e.fetch_date,
               p.poke_id, p.period AS poke_gen, p.slot, p.type
        FROM past p JOIN entities e USING (poke_id)
        """
    )
)
def model_past_types(spark: SparkSession, folder: str) -> DataFrame:
    return landing.views(spark, folder)["int_past_types"]


@query(
    sql(
        """
        SELECT md5(p.poke_id || '-' || p.period || '-' || p.stat) AS past_stat_id, e.fetch_date,
               p.poke_id, p.period AS poke_gen, p.stat_value, p.stat AS stat_name
        FROM past_stat p JOIN entities e USING (poke_id)
        """
    )
)
def model_past_stats(spark: SparkSession, folder: str) -> DataFrame:
    return landing.views(spark, folder)["int_past_stats"]


@query(sql("SELECT * FROM history", TYPE_HISTORY))
def model_type_history(spark: SparkSession, folder: str) -> DataFrame:
    return landing.views(spark, folder)["int_type_history"]


@query(sql("SELECT * FROM history", TYPE_HISTORY_AS_WRITTEN))
def model_type_history_as_written(spark: SparkSession, folder: str) -> DataFrame:
    return landing.views(spark, folder, history_rule="as_written")["int_type_history"]


@query(sql("SELECT * EXCLUDE (fetch_date) FROM history", TYPE_HISTORY))
def model_past_type_mart(spark: SparkSession, folder: str) -> DataFrame:
    return landing.live_marts(spark, folder)["mart_past_types"]


@query(sql("SELECT * FROM history", STAT_HISTORY))
def model_stats_history(spark: SparkSession, folder: str) -> DataFrame:
    return landing.views(spark, folder)["int_stats_history"]


@query(
    sql(
        """
        SELECT poke_id, slot, type, coalesce(prior + 1, intro) AS valid_from, period AS valid_to
        FROM (SELECT p.*, e.poke_gen AS intro,
                     lag(period) OVER (PARTITION BY poke_id, slot ORDER BY period) AS prior
              FROM past p LEFT JOIN entities e USING (poke_id))
        UNION ALL
        SELECT t.poke_id, t.slot, t.type, coalesce(l.last_period + 1, e.poke_gen), NULL
        FROM types t LEFT JOIN entities e USING (poke_id)
        LEFT JOIN (SELECT poke_id, slot, max(period) AS last_period FROM past GROUP BY ALL) l
          ON l.poke_id = t.poke_id AND l.slot = t.slot
        """
    )
)
def changelog_window(spark: SparkSession, folder: str) -> DataFrame:
    """The change log as the draft states it: the current side takes the last change of its slot."""
    v = landing.views(spark, folder)
    history = v["int_type_history"]
    return history.select(
        "poke_id",
        "slot",
        "type",
        F.col("valid_from_gen").alias("valid_from"),
        F.col("valid_to_gen").alias("valid_to"),
    )


# ---- ranks ---------------------------------------------------------------------------------------


@query(sql("SELECT * FROM strongest"))
def model_strongest(spark: SparkSession, folder: str) -> DataFrame:
    return landing.live_marts(spark, folder)["mart_strongest_pokemons"]


@query(sql("SELECT * FROM starters"))
def model_starters(spark: SparkSession, folder: str) -> DataFrame:
    return landing.live_marts(spark, folder, with_starters=True)["mart_strongest_starters"]


# ---- loads ---------------------------------------------------------------------------------------

_BATCH = "batch-2024-06-01"
_TYPED = """
    name string, height int, weight int,
    stats array<struct<base_stat:int, stat:struct<name:string>>>,
    types array<struct<slot:int, type:struct<name:string>>>
"""


def _database(spark: SparkSession) -> str:
    """A database of its own per run, its files in the shared folder."""
    path = fresh_path(spark, "run")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    tables.create_database(spark, name, path)
    return name


@query(
    sql(
        f"""
        SELECT e.poke_id, e.poke_name AS name, CAST(e.height AS DECIMAL(10, 2)) AS height,
               CAST(e.weight AS DECIMAL(10, 2)) AS weight, t.type, t.slot, t.slot = 1 AS is_primary_slot,
               e.hp, e.attack, e.special_attack, e.defense, e.special_defense, e.speed
        FROM entities e JOIN types t USING (poke_id) WHERE e.p_size > 25
        """
    )
)
def typed_batch_load(spark: SparkSession, folder: str) -> DataFrame:
    """One batch from raw into a typed nested table, then into its three flat tables."""
    landed = landing.entities(spark, folder)
    batch = landed.where(F.col("batch_id") == F.lit(_BATCH))
    typed = batch.select(
        "batch_id",
        "fetch_date",
        "id",
        F.from_json("payload", _TYPED).alias("p"),
    ).select(
        "batch_id",
        "fetch_date",
        "id",
        "p.name",
        F.round(F.col("p.height") / 10, 2).cast("decimal(10,2)").alias("height"),
        F.round(F.col("p.weight") / 10, 2).cast("decimal(10,2)").alias("weight"),
        "p.types",
        "p.stats",
    )
    staged = f"{_database(spark)}.staged"
    tables.create_like(typed, staged)
    tables.append(typed, staged)
    loaded = spark.sql(f"SELECT * FROM {staged} WHERE batch_id = :batch", args={"batch": _BATCH})
    return _flat_tables(loaded)


def _flat_tables(loaded: DataFrame) -> DataFrame:
    flat = loaded.select(F.col("id").alias("poke_id"), "name", "height", "weight")
    types = loaded.select(F.col("id").alias("poke_id"), F.inline("types")).select(
        "poke_id",
        F.col("type.name").alias("type"),
        "slot",
        (F.col("slot") == 1).alias("is_primary_slot"),
    )
    long = loaded.select(F.col("id").alias("poke_id"), F.inline("stats")).select(
        "poke_id", F.col("stat.name").alias("stat"), F.col("base_stat").alias("value")
    )
    wide = m.inter.pivot_fixed(long, ["poke_id"], "stat", "value", m.inter.STAT_COLUMNS)
    return flat.join(types, "poke_id").join(wide, "poke_id")


@query(
    sql(
        f"""
        SELECT 'mart_pokemons' AS mart, count(*) AS n_rows,
               CAST(sum(poke_id) AS BIGINT) AS key_sum, CAST(sum(height * 10) AS BIGINT) AS value_sum
        FROM entities
        UNION ALL
        SELECT 'mart_stats', count(*), CAST(sum(poke_id) AS BIGINT),
               CAST(sum(total_stat_points) AS BIGINT) FROM stats
        UNION ALL
        SELECT 'mart_types', count(*), CAST(sum(poke_id) AS BIGINT), CAST(sum(slot) AS BIGINT) FROM types
        UNION ALL
        SELECT 'mart_pokemon_moves', count(*), CAST(sum(poke_id) AS BIGINT),
               CAST(sum(move_id) AS BIGINT) FROM learned
        UNION ALL
        SELECT 'mart_version_groups', count(*), CAST(sum(n_nationkey + 1) AS BIGINT),
               CAST(sum(n_regionkey + 1) AS BIGINT) FROM nation
        """
    )
)
def incremental_marts(spark: SparkSession, folder: str) -> DataFrame:
    """A first load from the older landing, then an incremental one from the whole landing."""
    database = _database(spark)
    names = ["mart_pokemons", "mart_stats", "mart_types", "mart_pokemon_moves", "mart_version_groups"]
    older = m.Views(landing.RawTables(spark, folder, until=landing.FIRST))
    m.load_marts(older, database, names=names)
    m.load_marts(landing.views(spark, folder), database, names=names)

    def summary(name: str, key: str, value) -> DataFrame:
        return spark.table(f"{database}.{name}").agg(
            F.lit(name).alias("mart"),
            F.count(F.lit(1)).alias("n_rows"),
            F.sum(F.col(key).cast("bigint")).alias("key_sum"),
            F.sum(value).cast("bigint").alias("value_sum"),
        )

    return (
        summary("mart_pokemons", "poke_id", F.round(F.col("height") * 10).cast("bigint"))
        .unionByName(summary("mart_stats", "poke_id", F.col("total_stat_points")))
        .unionByName(summary("mart_types", "poke_id", F.col("slot")))
        .unionByName(summary("mart_pokemon_moves", "poke_id", F.col("move_id")))
        .unionByName(summary("mart_version_groups", "version_group_id", F.col("poke_gen")))
    )


def _fetched(spark: SparkSession, folder: str, when: str) -> DataFrame:
    """The entities fetched at one time, as they come before they are landed."""
    rows = landing.entities(spark, folder).where(f"fetch_date = TIMESTAMP_NTZ '{when}'")
    return rows.withColumn("fetch_date", F.lit(when.replace(" ", "T") + "+00:00"))


@query(
    sql(
        """
        SELECT 'stats' AS mart, poke_id, CAST(total_stat_points AS BIGINT) AS value FROM stats
        UNION ALL SELECT 'types', poke_id, CAST(slot AS BIGINT) FROM types
        UNION ALL SELECT 'moves', poke_id, CAST(move_id AS BIGINT) FROM learned
        """
    )
)
def marts_after_landings(spark: SparkSession, folder: str) -> DataFrame:
    """Two fetches landed and loaded one after the other; the catalog names the second mark and its batches."""
    database = _database(spark)
    raw.create_raw_tables(spark, database)
    for when in (landing.FIRST, landing.SECOND):
        raw.land(spark, database, "pokemons", _fetched(spark, folder, when), guard="fetch")
        views = m.Views(raw.Landed(spark, database))
        m.load_marts(views, database, names=["mart_stats", "mart_types", "mart_pokemon_moves"])

    def cells(mart: str, value: str) -> DataFrame:
        rows = spark.table(f"{database}.mart_{mart}")
        return rows.select(F.lit(mart.rsplit("_")[-1]).alias("mart"), "poke_id", F.col(value).cast("bigint").alias("value"))

    return (
        cells("stats", "total_stat_points")
        .unionByName(cells("types", "slot"))
        .unionByName(cells("pokemon_moves", "move_id"))
    )


@query(sql(f"SELECT {MART_STATS} FROM stats"))
def refresh_after_landing(spark: SparkSession, folder: str) -> DataFrame:
    """Landed files are taken up as they arrive, and each batch brings the mart up to date."""
    database = _database(spark)
    raw.create_raw_tables(spark, database)
    files, progress = fresh_path(spark, "landed"), fresh_path(spark, "progress")

    def refresh() -> None:
        views = m.Views(raw.Landed(spark, database))
        m.load_marts(views, database, names=["mart_stats"], mark_from="target")

    for when in (landing.FIRST, landing.SECOND):
        _fetched(spark, folder, when).write.mode("append").json(files)
        follow_landing(
            spark, database, "pokemons", files, progress, after_batch=refresh, guard="fetch"
        ).awaitTermination()
    return spark.table(f"{database}.mart_stats")


@query(sql(f"SELECT {MART_STATS} FROM stats"))
def incremental_mart_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Row by row: a mart after a first and an incremental load equals a full rebuild."""
    database = _database(spark)
    older = m.Views(landing.RawTables(spark, folder, until=landing.FIRST))
    options = {"names": ["mart_stats"], "mark_from": "target"}
    m.load_marts(older, database, **options)
    m.load_marts(landing.views(spark, folder), database, **options)
    return m.loaded_marts(spark, database)["mart_stats"]


@query(sql("SELECT poke_gen, poke_id, poke_name, height, weight FROM entities"))
def incremental_bucketed_mart(spark: SparkSession, folder: str) -> DataFrame:
    """The same for a mart laid out by key buckets, of which a load rewrites those it touches."""
    database = _database(spark)
    older = m.Views(landing.RawTables(spark, folder, until=landing.FIRST))
    # catalogue entries of the older landing differ, so the second load takes every entity anew
    m.load_marts(older, database, names=["mart_pokemons"], buckets=16)
    views = landing.views(spark, folder)
    tables.load_mart(
        views["stg_pokemons"].withColumn("fetch_date", F.lit(landing.SECOND)),
        f"{database}.mart_pokemons",
        "poke_id",
        m.MARTS["mart_pokemons"].columns,
        buckets=16,
    )
    return m.loaded_marts(spark, database)["mart_pokemons"]


def _event_versions(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Events as a keyed source: all of them at first, then those of three users once more."""
    events = table(spark, folder, "events").select("event_id", "user_id", "value", F.lit(landing.FIRST).alias("at"))
    again = events.where("user_id IN (1, 2, 3)").withColumn("value", F.col("value") + 1)
    return events, again.withColumn("at", F.lit(landing.SECOND))


_VERSIONED = (
    "SELECT event_id, user_id, CASE WHEN user_id IN (1, 2, 3) THEN value + 1 ELSE value END AS value FROM events"
)
_VERSIONS = {"key": "event_id", "columns": ["event_id", "user_id", "value"], "loaded_at": "at"}


@query(_VERSIONED)
def mart_rebucketed(spark: SparkSession, folder: str) -> DataFrame:
    """A load that asks for another number of buckets than the table has: no row is lost or doubled."""
    name = f"{_database(spark)}.events"
    first, again = _event_versions(spark, folder)
    tables.load_mart(first, name, buckets=8, **_VERSIONS)
    tables.load_mart(again, name, buckets=16, **_VERSIONS)
    return spark.table(name).drop(tables.BUCKET)


@query("SELECT event_id, value AS measured FROM events WHERE user_id IN (1, 2, 3)")
def mart_refresh_changes_layout(spark: SparkSession, folder: str) -> DataFrame:
    """Full refreshes of a bucketed table: in its layout, then without buckets and with other columns."""
    name = f"{_database(spark)}.events"
    first, again = _event_versions(spark, folder)
    tables.load_mart(first, name, buckets=8, **_VERSIONS)
    tables.load_mart(again, name, full_refresh=True, **_VERSIONS)
    some = first.where("user_id IN (1, 2, 3)").withColumnRenamed("value", "measured")
    options = {**_VERSIONS, "columns": ["event_id", "measured"]}
    tables.load_mart(some, name, full_refresh=True, buckets=0, **options)
    return spark.table(name)


@query(
    """
    SELECT event_id, user_id, CASE WHEN event_id = 7 THEN value + 1 ELSE value END AS value,
           event_id = 7 AS rewritten
    FROM events
    """
)
def mart_partial_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """A batch of one key: of 64 buckets only the one it is in gets new files."""
    name = f"{_database(spark)}.events"
    first, _ = _event_versions(spark, folder)
    tables.load_mart(first, name, buckets=64, **_VERSIONS)
    before = cut_lineage(_bucket_files(spark, name))
    again = first.where("event_id = 7").withColumn("value", F.col("value") + 1)
    tables.load_mart(again.withColumn("at", F.lit(landing.SECOND)), name, buckets=64, **_VERSIONS)
    fresh = _bucket_files(spark, name).join(before, [tables.BUCKET, "file"], "left_anti")
    touched = spark.table(name).join(fresh.select(tables.BUCKET).distinct(), tables.BUCKET, "left_semi")
    # rows beside key 7 in the rewritten bucket keep their values; a second bucket would show as rewritten
    others = touched.where("event_id <> 7").select(tables.BUCKET).distinct()
    own = spark.table(name).where("event_id = 7").select(tables.BUCKET)
    strays = others.join(own, tables.BUCKET, "left_anti").withColumn("stray", F.lit(True))
    return (
        spark.table(name)
        .join(strays, tables.BUCKET, "left")
        .select("event_id", "user_id", "value", ((F.col("event_id") == 7) | F.col("stray").isNotNull()).alias("rewritten"))
    )


def _bucket_files(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name).select(tables.BUCKET, F.input_file_name().alias("file")).distinct()


# ---- landing -------------------------------------------------------------------------------------


def _landed_parts(spark: SparkSession, folder: str, batch: str = "b1", shift: int = 0) -> DataFrame:
    """Parts as landed rows: some twice, some without an id, some with a payload that is no JSON."""
    part = table(spark, folder, "part")
    payload = "to_json(named_struct('name', p_name, 'height', p_size + {shift}))".replace("{shift}", str(shift))
    rows = part.selectExpr(
        "CASE WHEN p_partkey % 10 = 3 THEN NULL ELSE CAST(p_partkey AS BIGINT) END AS id",
        "'2024-01-01T00:00:00+00:00' AS fetch_date",
        f"'{batch}' AS batch_id",
        f"CASE WHEN p_partkey % 10 = 4 THEN '{{\"name\": ' ELSE {payload} END AS payload",
    )
    return rows.unionByName(rows.where("id % 10 = 5"))


def _landed_report(spark: SparkSession, database: str) -> DataFrame:
    kept = spark.table(f"{database}.pokemons").selectExpr("'raw' AS kind", "id", "batch_id")
    bad = spark.table(f"{database}.pokemons_quarantine").selectExpr("'quarantine' AS kind", "id", "batch_id")
    return kept.unionByName(bad).groupBy("kind", "batch_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("id").alias("n_ids"),
        F.coalesce(F.sum("id"), F.lit(0)).alias("id_sum"),
    )


_LAND = """
SELECT 'raw' AS kind, 'b1' AS batch_id, count(*) AS n_rows, count(*) AS n_ids, CAST(sum(p_partkey) AS BIGINT) AS id_sum
FROM part WHERE p_partkey % 10 NOT IN (3, 4)
UNION ALL
SELECT 'quarantine', 'b1', (SELECT count(DISTINCT (p_name, p_size)) FROM part WHERE p_partkey % 10 = 3) + count(*),
       count(*), CAST(coalesce(sum(p_partkey), 0) AS BIGINT)
FROM part WHERE p_partkey % 10 = 4
"""


@query(_LAND)
def land_stamped(spark: SparkSession, folder: str) -> DataFrame:
    """Fetched rows get their time and batch, then land."""
    database = _database(spark)
    raw.create_raw_tables(spark, database)
    fetched = _landed_parts(spark, folder).select("id", "payload")
    raw.land(spark, database, "pokemons", raw.stamp(fetched, "2024-01-01T00:00:00+00:00", "b1"))
    return _landed_report(spark, database)


@query(_LAND)
def land_twice(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows landed twice: neither the raw table nor the quarantine grows."""
    database = _database(spark)
    raw.create_raw_tables(spark, database)
    for _ in range(2):
        raw.land(spark, database, "pokemons", _landed_parts(spark, folder))
    return _landed_report(spark, database)


@query(
    """
    SELECT CAST(p_partkey AS BIGINT) AS poke_id, p_name AS poke_name, round((p_size + 5) / 10, 2) AS height
    FROM part WHERE p_partkey % 10 NOT IN (3, 4)
    """
)
def land_refetch(spark: SparkSession, folder: str) -> DataFrame:
    """A newer fetch of known ids lands as a fetch of its own, and the views read the newest."""
    database = _database(spark)
    raw.create_raw_tables(spark, database)
    raw.land(spark, database, "pokemons", _landed_parts(spark, folder), guard="fetch")
    later = _landed_parts(spark, folder, "b2", 5).withColumn("fetch_date", F.lit("2024-06-01T00:00:00+00:00"))
    for _ in range(2):
        raw.land(spark, database, "pokemons", later, guard="fetch")
    views = m.Views({name: spark.table(f"{database}.{name}") for name in raw.RAW_TABLES})
    return views["stg_pokemons"].select("poke_id", "poke_name", "height")


@query(
    """
    SELECT 'generations' AS "table", 4 AS n_columns, 0 AS n_rows
    UNION ALL SELECT 'pokemon_catalogue', 4, 0 UNION ALL SELECT 'version_groups', 4, 0
    UNION ALL SELECT 'pokemons', 4, (SELECT count(*) FROM part WHERE p_partkey % 10 NOT IN (3, 4))
    UNION ALL SELECT 'moves', 4, 0 UNION ALL SELECT 'pokemon_species', 4, 0
    UNION ALL SELECT 'pokemon_ids', 2, 0
    """
)
def raw_tables_created(spark: SparkSession, folder: str) -> DataFrame:
    """All raw tables; creating them again leaves landed rows alone."""
    database = _database(spark)
    raw.create_raw_tables(spark, database)
    raw.land(spark, database, "pokemons", _landed_parts(spark, folder))
    raw.create_raw_tables(spark, database)
    found = None
    for name in raw.RAW_TABLES:
        rows = spark.table(f"{database}.{name}")
        counted = rows.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table"), F.lit(len(rows.columns)).alias("n_columns"), "n_rows"
        )
        found = counted if found is None else found.unionByName(counted)
    return found


@query(
    """
    SELECT 'before' AS step, count(*) > 0 AS to_do, count(*) AS n_missing FROM part
    UNION ALL
    SELECT 'after', count(*) FILTER (WHERE p_partkey % 10 IN (3, 4)) > 0,
           count(*) FILTER (WHERE p_partkey % 10 IN (3, 4)) FROM part
    """
)
def landing_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Is there anything to fetch: before a landing, and after it, when only bad rows are missing."""
    database = _database(spark)
    raw.create_raw_tables(spark, database)
    wanted = table(spark, folder, "part").select(F.col("p_partkey").cast("bigint").alias("id"))

    def step(name: str) -> DataFrame:
        missing = planning.missing_ids(wanted, spark.table(f"{database}.pokemons"), "id")
        gate = planning.anything_to_do(missing)
        return cut_lineage(
            missing.agg(F.count(F.lit(1)).alias("n_missing")).select(
                F.lit(name).alias("step"), F.lit(gate).alias("to_do"), "n_missing"
            )
        )

    before = step("before")
    raw.land(spark, database, "pokemons", _landed_parts(spark, folder))
    return before.unionByName(step("after"))


# ---- checks --------------------------------------------------------------------------------------



@query(
    """
    SELECT source, newest, CAST(date_diff('second', newest, TIMESTAMP '2024-12-10') AS DOUBLE) AS age_seconds, status
    FROM (SELECT CASE WHEN max(p_size) > 25 THEN TIMESTAMP '2024-06-01' ELSE TIMESTAMP '2024-01-01' END AS entity,
                 CASE WHEN max(p_size) > 10 THEN TIMESTAMP '2024-06-01' ELSE TIMESTAMP '2024-01-01' END AS listed
          FROM part),
         LATERAL (VALUES ('pokemons', entity, 'error'), ('pokemon_catalogue', listed, 'warn'),
                         ('version_groups', TIMESTAMP '2024-01-01', 'pass'), ('moves', TIMESTAMP '2024-01-01', 'pass'),
                         ('pokemon_species', TIMESTAMP '2024-06-01', 'error'),
                         ('generations', TIMESTAMP '2024-01-01', 'pass')) v(source, newest, status)
    """
)
def freshness_sources(spark: SparkSession, folder: str) -> DataFrame:
    """The six raw tables against their own limits."""
    raw_frames = landing.RawTables(spark, folder)
    frames = {name: raw_frames[name] for name in contracts.FRESHNESS_DAYS}
    return contracts.freshness_report(frames, datetime(2024, 12, 10))


@query(
    """
    SELECT 'mart_version_group_versions' AS model, 'relationships' AS "check", 'version_group_id' AS columns,
           2 * count(*) AS failures
    FROM nation WHERE n_regionkey = 1
    """
)
def contract_foreign_key(spark: SparkSession, folder: str) -> DataFrame:
    """The declared foreign key, with the groups of one region taken out from under it."""
    live = landing.live_marts(spark, folder)
    groups = live["mart_version_groups"].where("poke_gen <> 2")
    models = {"mart_version_group_versions": live["mart_version_group_versions"], "mart_version_groups": groups}
    return contracts.report(models).where("check = 'relationships'")


_KINDS = ["ECONOMY", "SMALL", "STANDARD"]
_CHECKED = ("stg_pokemons", "int_stats", "int_types", "mart_stats", "mart_types", "mart_strongest_pokemons")


@query(
    sql(
        """
        SELECT model, "check", columns, failures FROM (
          SELECT 'stg_pokemons' AS model, 'not_null' AS "check", c AS columns,
                 CASE c WHEN 'poke_gen' THEN (SELECT count(*) FROM entities WHERE poke_gen IS NULL) ELSE 0 END AS failures
          FROM (VALUES ('fetch_date'), ('poke_gen'), ('poke_id'), ('poke_name')) v(c)
          UNION ALL SELECT 'stg_pokemons', 'unique', 'poke_id', 0
          UNION ALL SELECT 'stg_pokemons', 'accepted_range', 'height',
                           (SELECT count(*) FROM entities WHERE height < 0 OR height > 100)
          UNION ALL SELECT 'stg_pokemons', 'accepted_range', 'weight',
                           (SELECT count(*) FROM entities WHERE weight < 0 OR weight > 10000)
          UNION ALL SELECT 'stg_pokemons', 'no_negative_size', 'height,weight', 0
          UNION ALL
          SELECT 'int_stats', 'not_null', c,
                 CASE c WHEN 'speed' THEN (SELECT count(*) FROM entities WHERE speed IS NULL) ELSE 0 END
          FROM (VALUES ('fetch_date'), ('poke_id'), ('hp'), ('attack'), ('defense'), ('special_attack'),
                       ('special_defense'), ('speed')) v(c)
          UNION ALL SELECT 'int_stats', 'unique', 'poke_id', 0
          UNION ALL
          SELECT 'int_stats', 'accepted_range', c, 0
          FROM (VALUES ('hp'), ('attack'), ('defense'), ('special_attack'), ('special_defense'), ('speed')) v(c)
          UNION ALL SELECT 'int_stats', 'all_stats_present',
                           'hp,attack,defense,special_attack,special_defense,speed',
                           (SELECT count(*) FROM entities WHERE speed IS NULL)
          UNION ALL
          SELECT 'int_types', 'not_null', c, 0
          FROM (VALUES ('type_id'), ('fetch_date'), ('poke_id'), ('slot'), ('type')) v(c)
          UNION ALL SELECT 'int_types', 'unique', 'type_id', 0
          UNION ALL SELECT 'int_types', 'accepted_values', 'slot', 0
          UNION ALL SELECT 'int_types', 'accepted_values', 'type',
                           (SELECT count(*) FROM types WHERE type NOT IN ('ECONOMY', 'SMALL', 'STANDARD'))
          UNION ALL SELECT 'mart_stats', 'not_null', 'poke_id', 0
          UNION ALL SELECT 'mart_stats', 'unique', 'poke_id', 0
          UNION ALL
          SELECT 'mart_stats', 'accepted_range', c, 0
          FROM (VALUES ('hp'), ('attack'), ('defense'), ('special_attack'), ('special_defense'), ('speed')) v(c)
          UNION ALL SELECT 'mart_stats', 'min_value', 'total_stat_points', 0
          UNION ALL SELECT 'mart_stats', 'total_is_sum', 'total_stat_points', 0
          UNION ALL SELECT 'mart_types', 'not_null', 'type_id', 0
          UNION ALL SELECT 'mart_types', 'unique', 'type_id', 0
          UNION ALL SELECT 'mart_types', 'has_primary_slot', 'poke_id', 0
          UNION ALL
          SELECT 'mart_strongest_pokemons', 'not_null', c, 0
          FROM (VALUES ('poke_id'), ('poke_name'), ('rank')) v(c)
          UNION ALL SELECT 'mart_strongest_pokemons', 'unique', 'poke_id', 0
          UNION ALL SELECT 'mart_strongest_pokemons', 'min_value', 'total_stat_points', 0
          UNION ALL SELECT 'mart_strongest_pokemons', 'accepted_values', 'tier', 0
          UNION ALL SELECT 'mart_strongest_pokemons', 'first_is_top_tier', 'tier', 0
          UNION ALL SELECT 'mart_strongest_pokemons', 'ranks_contiguous', 'rank', 0)
        """
    )
)
def model_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The declared checks over six models, with three type names accepted."""
    v = landing.views(spark, folder)
    marts = m.LiveMarts(v)
    models = {
        name: marts[name] if name.startswith("mart_") else v[name] for name in _CHECKED
    }
    return contracts.report(models, types=_KINDS)


# ---- serving -------------------------------------------------------------------------------------

_LIST = """
  SELECT e.poke_id, e.poke_name, e.poke_gen, e.height, e.weight, s.hp, s.attack, s.defense,
         s.special_attack, s.special_defense, s.speed, s.total_stat_points, r.rank, r.tier
  FROM entities e JOIN stats s USING (poke_id) LEFT JOIN strongest r USING (poke_id)
"""


@query(sql("SELECT poke_gen, gen_name FROM generations"))
def list_generations(spark: SparkSession, folder: str) -> DataFrame:
    return serving.generation_list(landing.live_marts(spark, folder))


@query(sql(_LIST + "ORDER BY poke_id"))
def list_entities(spark: SparkSession, folder: str) -> DataFrame:
    return serving.entity_list(landing.live_marts(spark, folder))


@query(sql("SELECT poke_id, slot, type FROM types ORDER BY poke_id, slot"))
def list_types(spark: SparkSession, folder: str) -> DataFrame:
    return serving.type_list(landing.live_marts(spark, folder))


@query(sql("SELECT poke_id FROM starters"))
def list_starters(spark: SparkSession, folder: str) -> DataFrame:
    return serving.starter_ids(landing.live_marts(spark, folder, with_starters=True))


@query(sql("SELECT poke_id FROM species WHERE is_legendary"))
def list_legendaries(spark: SparkSession, folder: str) -> DataFrame:
    return serving.legendary_ids(landing.live_marts(spark, folder))


@query(sql("SELECT * EXCLUDE (fetch_date) FROM species"))
def list_species(spark: SparkSession, folder: str) -> DataFrame:
    return serving.species_list(landing.live_marts(spark, folder))


@query(
    sql(
        "SELECT l.poke_id, v.move_name, v.type, v.power, v.accuracy, v.pp, v.damage_class "
        "FROM learned l JOIN moves v USING (move_id)"
    )
)
def list_moves(spark: SparkSession, folder: str) -> DataFrame:
    return serving.move_list(landing.live_marts(spark, folder))


_EXPLORED = (
    _LIST
    + """
    WHERE e.poke_gen = 3 AND s.total_stat_points BETWEEN 500 AND 1000
      AND e.poke_id IN (SELECT poke_id FROM types WHERE type IN ('ECONOMY', 'Brand#4', 'Brand#7'))
    """
)


@query(sql(_EXPLORED))
def explore_entities(spark: SparkSession, folder: str) -> DataFrame:
    return serving.explore(
        landing.live_marts(spark, folder), 3, (500, 1000), ["ECONOMY", "Brand#4", "Brand#7"]
    )


_CARDS = """
    SELECT e.poke_id, e.poke_name, g.gen_name, e.p_type AS primary_type,
           CASE WHEN e.p_size > 25 THEN e.p_brand END AS secondary_type,
           coalesce(CAST(r.rank AS VARCHAR), '—') AS rank, coalesce(r.tier, '—') AS tier,
           e.p_brand = 'Brand#1' AS is_starter, e.p_brand = 'Brand#9' AS is_legendary
    FROM entities e LEFT JOIN strongest r USING (poke_id) LEFT JOIN generations g
      ON g.poke_gen = e.poke_gen
    """


@query(sql(_CARDS))
def entity_cards(spark: SparkSession, folder: str) -> DataFrame:
    return serving.cards(landing.live_marts(spark, folder, with_starters=True))


# ---- serving from loaded marts -------------------------------------------------------------------


def _loaded_twice(spark: SparkSession, folder: str, *names: str, with_starters: bool = False) -> serving.Marts:
    """Marts loaded from the entities of the older landing and brought up to date, with the stored ranks.

    The catalogue is whole from the start: a load takes up the entities of its batch, not other ones whose
    generation changes in the catalogue.
    """
    database = _database(spark)
    wanted = ["mart_pokemons", "mart_stats", *names]
    seed = landing.starters(spark, folder) if with_starters else None
    older = landing.RawTables(spark, folder, until=landing.FIRST, of=("pokemons",))
    m.load_marts(m.Views(older), database, names=wanted)
    m.load_marts(landing.views(spark, folder), database, seed, names=wanted)
    return m.loaded_marts(spark, database)


@query(sql("SELECT * FROM strongest"))
def ranks_after_loads(spark: SparkSession, folder: str) -> DataFrame:
    """The stored ranks, of which the second load ranked anew the ranges that its batch touched."""
    return _loaded_twice(spark, folder)[m.STRONGEST]


@query(sql(_LIST + "ORDER BY poke_id"))
def list_loaded_entities(spark: SparkSession, folder: str) -> DataFrame:
    return serving.entity_list(_loaded_twice(spark, folder))


@query(sql(_EXPLORED))
def explore_loaded_entities(spark: SparkSession, folder: str) -> DataFrame:
    marts = _loaded_twice(spark, folder, "mart_types")
    return serving.explore(marts, 3, (500, 1000), ["ECONOMY", "Brand#4", "Brand#7"])


@query(sql(_CARDS))
def loaded_entity_cards(spark: SparkSession, folder: str) -> DataFrame:
    names = ("mart_types", "mart_generations", "mart_pokemon_species")
    return serving.cards(_loaded_twice(spark, folder, *names, with_starters=True))


@query(
    sql(
        "SELECT v.move_name, v.type, v.power, v.accuracy, v.pp, v.damage_class "
        "FROM learned l JOIN moves v USING (move_id) WHERE l.poke_id = 45"
    )
)
def moves_of_entity(spark: SparkSession, folder: str) -> DataFrame:
    return serving.moves_of(landing.live_marts(spark, folder), 45)


@query(sql("SELECT poke_name, total_stat_points, tier FROM strongest ORDER BY rank LIMIT 5"))
def question_strongest(spark: SparkSession, folder: str) -> DataFrame:
    return serving.strongest_entities(landing.live_marts(spark, folder))


@query(
    sql(
        "SELECT e.poke_name, t.type, t.slot FROM entities e JOIN types t USING (poke_id) "
        "WHERE e.poke_name = 'red widget'"
    )
)
def question_types_of(spark: SparkSession, folder: str) -> DataFrame:
    return serving.types_of(landing.live_marts(spark, folder), "Red Widget")


@query(
    sql(
        "SELECT g.gen_name, count(*) AS pokemon_count FROM entities e "
        "JOIN generations g USING (poke_gen) GROUP BY g.gen_name, e.poke_gen"
    )
)
def question_count_by_generation(spark: SparkSession, folder: str) -> DataFrame:
    return serving.count_by_generation(landing.live_marts(spark, folder))


@query(
    sql(
        "SELECT v.move_name, v.type, v.power, v.damage_class FROM learned l "
        "JOIN entities e USING (poke_id) JOIN moves v USING (move_id) WHERE e.poke_name = 'blue bolt'"
    )
)
def question_learnable_moves(spark: SparkSession, folder: str) -> DataFrame:
    return serving.learnable_moves_by_power(landing.live_marts(spark, folder), "blue bolt")


@query(
    sql(
        """
        SELECT e.poke_name, s.total_stat_points, s.attack, s.special_attack, s.speed
        FROM entities e JOIN stats s USING (poke_id) JOIN types t USING (poke_id)
        WHERE t.type = 'ECONOMY' ORDER BY s.total_stat_points DESC NULLS LAST, e.poke_id LIMIT 10
        """
    )
)
def question_strongest_of_type(spark: SparkSession, folder: str) -> DataFrame:
    return serving.strongest_of_type(landing.live_marts(spark, folder), "ECONOMY")


@query(sql("SELECT poke_name, total_stat_points, poke_gen FROM starters ORDER BY rank LIMIT 1"))
def question_best_starter(spark: SparkSession, folder: str) -> DataFrame:
    return serving.best_starter(landing.live_marts(spark, folder, with_starters=True))


@query(
    sql(
        "SELECT e.poke_name, s.speed, s.total_stat_points FROM entities e JOIN stats s USING (poke_id) "
        "ORDER BY s.speed DESC NULLS LAST, e.poke_id LIMIT 10"
    )
)
def question_fastest(spark: SparkSession, folder: str) -> DataFrame:
    return serving.fastest(landing.live_marts(spark, folder))


@query(
    sql(
        "SELECT move_name, power, accuracy, pp, damage_class FROM moves "
        "WHERE type = 'type-7' AND power IS NOT NULL ORDER BY power DESC, move_id LIMIT 10"
    )
)
def question_strongest_moves(spark: SparkSession, folder: str) -> DataFrame:
    return serving.strongest_moves_of_type(landing.live_marts(spark, folder), "type-7")


@query(sql("SELECT type, count(*) AS move_count FROM moves GROUP BY type"))
def question_moves_per_type(spark: SparkSession, folder: str) -> DataFrame:
    return serving.moves_per_type(landing.live_marts(spark, folder))


@query(
    sql(
        "SELECT e.poke_name, h.type, h.slot, h.valid_from_gen, h.valid_to_gen FROM history h "
        "JOIN entities e USING (poke_id) WHERE h.valid_to_gen IS NOT NULL",
        TYPE_HISTORY,
    )
)
def question_changed_type(spark: SparkSession, folder: str) -> DataFrame:
    return serving.changed_type(landing.live_marts(spark, folder))


@query(
    sql(
        "SELECT poke_gen, avg(total_stat_points) AS average FROM entities JOIN stats USING (poke_id) "
        "GROUP BY poke_gen"
    )
)
def question_average_by_generation(spark: SparkSession, folder: str) -> DataFrame:
    return serving.average_by_generation(landing.live_marts(spark, folder))


@query(
    sql(
        "SELECT t.type, count(*) AS n, max(s.total_stat_points) AS best FROM types t "
        "JOIN stats s USING (poke_id) WHERE t.slot = 1 GROUP BY t.type"
    )
)
def ad_hoc_sql(spark: SparkSession, folder: str) -> DataFrame:
    """Free SQL over mart names."""
    return serving.run_sql(
        landing.live_marts(spark, folder).some("mart_types", "mart_stats"),
        "SELECT t.type, count(*) AS n, max(s.total_stat_points) AS best FROM mart_types t "
        "JOIN mart_stats s ON s.poke_id = t.poke_id WHERE t.slot = :slot GROUP BY t.type",
        slot=1,
    )


@query(sql("SELECT poke_id, poke_name, height FROM entities ORDER BY height DESC, poke_id LIMIT 10"))
def analysis_tallest(spark: SparkSession, folder: str) -> DataFrame:
    return serving.tallest(landing.views(spark, folder)["stg_pokemons"])


@query(
    sql(
        "SELECT poke_id, poke_name, height, weight, round(height / weight, 2) AS height_weight_ratio "
        "FROM entities WHERE height > 0 AND weight > 0"
    )
)
def analysis_ratio(spark: SparkSession, folder: str) -> DataFrame:
    return serving.size_ratio(landing.views(spark, folder)["stg_pokemons"])
