"""The operators on the driver tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.functions import (
    array_of,
    clean_text,
    json_text,
    last_match,
    parse,
    payload_subset,
    raw_elements,
    surrogate_key,
    tier,
    total,
    url_segment,
    url_tail,
)
from layerwright.operators import incremental as inc
from layerwright.operators import planning as plan
from layerwright.operators import quality as q
from layerwright.operators import serving
from layerwright.operators.history import validity_windows
from layerwright.operators.latest import distinct_values, latest_per_key
from layerwright.operators.ordered import rank_table
from layerwright.operators.profile import column_profile, sample_rows, table_columns
from layerwright.operators.reshape import pivot_fixed, unpivot
from layerwright.operators.unnest import (
    unnest,
    unnest_nested,
    unnest_whole,
    unnest_with_position,
    with_matching,
)
from layerwright.session import cut_lineage, fresh_path
from layerwright.sources import archive, tables
from layerwright.sources.seeds import read_seed
from workloads.models import _database
from workloads.registry import query, table

# ---- ranks ---------------------------------------------------------------------------------------

_TIERED = """
SELECT c_custkey, c_name, n_name, c_acctbal,
       row_number() OVER (ORDER BY c_acctbal DESC NULLS LAST, c_custkey) AS rank,
       percent_rank() OVER (ORDER BY c_acctbal ASC NULLS LAST) AS pct_rank
FROM customer JOIN nation ON n_nationkey = c_nationkey
"""
_LADDER = """CASE WHEN pct_rank >= 0.95 THEN 'S' WHEN pct_rank >= 0.80 THEN 'A'
  WHEN pct_rank >= 0.55 THEN 'B' WHEN pct_rank >= 0.30 THEN 'C' WHEN pct_rank >= 0.10 THEN 'D'
  ELSE 'F' END AS tier"""


def _tiered(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    customer = table(spark, folder, "customer")
    rows = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    ranked = rank_table(
        rows.select("c_custkey", "c_name", "n_name", "c_acctbal"), "c_acctbal", ["c_custkey"]
    )
    return ranked.withColumn("tier", tier("pct_rank"))


@query(f"SELECT *, {_LADDER} FROM ({_TIERED})")
def tier_customers(spark: SparkSession, folder: str) -> DataFrame:
    return _tiered(spark, folder)


@query(
    """
    SELECT o_orderkey, total_quantity,
           row_number() OVER (ORDER BY total_quantity DESC NULLS LAST, o_orderkey) AS rank,
           percent_rank() OVER (ORDER BY total_quantity ASC NULLS LAST) AS pct_rank
    FROM (SELECT o_orderkey, sum(l_quantity) AS total_quantity
          FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey)
    """
)
def rank_orders_with_ties(spark: SparkSession, folder: str) -> DataFrame:
    """Ranks of a measure with many equal values and, for orders without lines, NULLs."""
    quantity = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum("l_quantity").alias("total_quantity"))
    )
    rows = table(spark, folder, "orders").select("o_orderkey").join(quantity, "o_orderkey", "left")
    return rank_table(rows, "total_quantity", ["o_orderkey"])


@query(
    """
    SELECT s_suppkey, s_name, s_acctbal,
           row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) AS rank
    FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE n_regionkey = 2
    """
)
def rank_subset(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers of a seeded list of nations, the seed being a CSV file."""
    path = fresh_path(spark, "nations")
    nation = table(spark, folder, "nation")
    nation.where("n_regionkey = 2").select("n_nationkey").write.csv(path, header=True)
    seed = read_seed(spark, path, "s_nationkey int")
    chosen = table(spark, folder, "supplier").join(seed, "s_nationkey")
    return rank_table(
        chosen.select("s_suppkey", "s_name", "s_acctbal"),
        "s_acctbal",
        ["s_suppkey"],
        percent_rank=None,
    )


# ---- semi-structured -----------------------------------------------------------------------------


@query("SELECT event_id, event_type, CAST(props->>'$.k' AS INTEGER) AS k FROM events")
def json_props(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return events.select("event_id", "event_type", parse("props", "k int")["k"].alias("k"))


@query("SELECT event_id, props->>'$.k' AS k, props->>'$.absent' AS absent FROM events")
def json_path_text(spark: SparkSession, folder: str) -> DataFrame:
    """Paths read without a declared shape; one that is not there gives NULL."""
    return table(spark, folder, "events").select(
        "event_id", json_text("props", "$.k").alias("k"), json_text("props", "$.absent").alias("absent")
    )


@query("SELECT event_id, '{\"k\":' || (props->>'$.k') || '}' AS payload FROM events")
def payload_cut(spark: SparkSession, folder: str) -> DataFrame:
    """A payload cut to its needed fields before landing."""
    wide = table(spark, folder, "events").select(
        "event_id",
        F.to_json(
            F.struct(json_text("props", "$.k").cast("int").alias("k"), "value", "event_type")
        ).alias("payload"),
    )
    return wide.select("event_id", payload_subset("payload", "k int").alias("payload"))


_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    " UNION ALL ".join(
        f"SELECT l_orderkey, l_linenumber, '{c}' AS measure, {c} AS value FROM lineitem"
        for c in _MEASURES
    )
)
def json_explode_items(spark: SparkSession, folder: str) -> DataFrame:
    """A JSON payload per line, its array of measures unnested again."""
    items = [
        F.struct(F.lit(c).alias("measure"), F.col(c).alias("value")) for c in _MEASURES
    ]
    landed = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.to_json(F.array(*items)).alias("payload")
    )
    rows = landed.select(
        "l_orderkey", "l_linenumber", array_of("payload", "measure string, value double").alias("a")
    )
    return unnest(
        rows, "a", {"measure": "measure", "value": "value"}, "l_orderkey", "l_linenumber"
    )


@query(
    """
    SELECT o_orderkey, e.part, e.text FROM orders,
      (VALUES (1), (2)) v(n),
      LATERAL (SELECT CASE n WHEN 1 THEN 'status' ELSE 'priority' END AS part,
                      CASE n WHEN 1 THEN o_orderstatus ELSE o_orderpriority END AS text) e
    """
)
def json_raw_elements(spark: SparkSession, folder: str) -> DataFrame:
    """Array elements of differing shapes, kept as JSON text and read one by one."""
    landed = table(spark, folder, "orders").select(
        "o_orderkey",
        F.concat(
            F.lit('[{"status":"'),
            "o_orderstatus",
            F.lit('"},{"priority":"'),
            "o_orderpriority",
            F.lit('"}]'),
        ).alias("payload"),
    )
    rows = unnest_whole(landed, raw_elements("payload"), "element", "o_orderkey")
    status, priority = json_text("element", "$.status"), json_text("element", "$.priority")
    return rows.select(
        "o_orderkey",
        F.when(status.isNotNull(), "status").otherwise("priority").alias("part"),
        F.coalesce(status, priority).alias("text"),
    )


@query(
    """
    SELECT o_orderkey, CAST(year(o_orderdate) + p.n AS INTEGER) AS period, s.slot,
           CASE s.slot WHEN 1 THEN o_orderstatus ELSE o_orderpriority END AS type
    FROM orders, (VALUES (0), (1)) p(n), (VALUES (1), (2)) s(slot)
    """
)
def json_explode_nested(spark: SparkSession, folder: str) -> DataFrame:
    """Two levels of arrays in one payload, periods holding slots."""
    year = F.year("o_orderdate")

    def period(n: int):
        slots = F.array(
            F.struct(F.lit(1).alias("slot"), F.col("o_orderstatus").alias("type")),
            F.struct(F.lit(2).alias("slot"), F.col("o_orderpriority").alias("type")),
        )
        url = F.concat(F.lit("/period/"), (year + n).cast("string"), F.lit("/"))
        return F.struct(url.alias("url"), slots.alias("slots"))

    landed = table(spark, folder, "orders").select(
        "o_orderkey", F.to_json(F.array(period(0), period(1))).alias("payload")
    )
    shape = "url string, slots array<struct<slot:int, type:string>>"
    rows = landed.select("o_orderkey", array_of("payload", shape).alias("periods"))
    flat = unnest_nested(
        rows,
        "periods",
        "slots",
        {"url": "url"},
        {"slot": "slot", "type": "type"},
        "o_orderkey",
    )
    return flat.select(
        "o_orderkey", url_tail("url").cast("int").alias("period"), "slot", "type"
    )


@query(
    """
    SELECT conv_id, max(turn) AS turn, arg_max(text, turn) AS text
    FROM conversations WHERE role = 'user' GROUP BY conv_id
    """
)
def last_matching_element(spark: SparkSession, folder: str) -> DataFrame:
    """The last user turn of every conversation, by position."""
    said = table(spark, folder, "conversations").where(F.col("role") == "user")
    return latest_per_key(said, ["conv_id"], ["turn"]).select("conv_id", "turn", "text")


@query(
    """
    SELECT doc_id, lines[len(lines)] AS last_line, len(lines) AS n_lines
    FROM (SELECT doc_id, [x FOR x IN string_split(text, chr(10)) IF trim(x) <> ''] AS lines
          FROM documents)
    """
)
def last_array_element(spark: SparkSession, folder: str) -> DataFrame:
    """The last non-blank line of every text, picked inside its array without a shuffle."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda line: F.struct(
            line.alias("line"),
            F.when(F.trim(line) == "", "blank").otherwise("text").alias("kind"),
        ),
    )
    rows = table(spark, folder, "documents").select("doc_id", lines.alias("lines"))
    return rows.select(
        "doc_id",
        last_match("lines", "kind", "text")["line"].alias("last_line"),
        F.size(F.filter("lines", lambda x: x["kind"] == "text")).cast("bigint").alias("n_lines"),
    )


@query(
    """
    SELECT doc_id, t.position, string_split(text, chr(10))[t.position] AS line
    FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS t(position)
    """
)
def array_positions(spark: SparkSession, folder: str) -> DataFrame:
    """Every line of every text with its position counted from 1."""
    rows = table(spark, folder, "documents").select("doc_id", F.split("text", "\n").alias("lines"))
    out = unnest_with_position(rows, "lines", "line", "doc_id")
    return out.withColumn("position", F.col("position").cast("bigint"))


@query(
    """
    SELECT c.conv_id, a.answer
    FROM (SELECT DISTINCT conv_id FROM conversations) c
    LEFT JOIN (SELECT conv_id, arg_min(text, turn) AS answer FROM conversations
               WHERE role = 'assistant' GROUP BY conv_id) a USING (conv_id)
    """
)
def first_matching_left(spark: SparkSession, folder: str) -> DataFrame:
    """The first answer joined back; conversations without one keep their row."""
    turns = table(spark, folder, "conversations")
    spoken = turns.where("role = 'assistant'").withColumnRenamed("text", "answer")
    answers = latest_per_key(spoken, ["conv_id"], [F.col("turn").asc(), F.col("answer").asc()])
    return with_matching(turns.select("conv_id").distinct(), "conv_id", answers, "answer")


@query(
    r"""
    SELECT page_id,
           string_split(rtrim(regexp_replace(url, '[?#].*$', ''), '/'), '/')[-1] AS tail,
           nullif(split_part(regexp_replace(url, '[?#].*$', ''), '/', -2), '') AS before_tail
    FROM pages
    """
)
def url_tail_id(spark: SparkSession, folder: str) -> DataFrame:
    path = F.regexp_replace("url", "[?#].*$", "")
    return table(spark, folder, "pages").select(
        "page_id", url_tail(path).alias("tail"), url_segment(path).alias("before_tail")
    )


@query(
    "SELECT doc_id, replace(replace(text, chr(12), ' '), chr(10), ' ') AS text FROM documents"
)
def clean_text_documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", clean_text("text").alias("text"))


# ---- keys ----------------------------------------------------------------------------------------


@query(
    "SELECT * FROM orders QUALIFY row_number() OVER "
    "(PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"
)
def latest_per_customer(spark: SparkSession, folder: str) -> DataFrame:
    return latest_per_key(
        table(spark, folder, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]
    )


@query(
    "SELECT md5(l_orderkey || '-' || l_linenumber) AS line_id, l_orderkey, l_linenumber FROM lineitem"
)
def surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    key = surrogate_key("l_orderkey", "l_linenumber")
    return table(spark, folder, "lineitem").select(
        key.alias("line_id"), "l_orderkey", "l_linenumber"
    )


@query(
    """
    SELECT md5(o_custkey || '-' || l_partkey) AS pair_id, o_custkey, l_partkey
    FROM (SELECT DISTINCT o_custkey, l_partkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
    """
)
def distinct_bridge(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    pairs = (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .select("o_custkey", "l_partkey")
        .distinct()
    )
    return pairs.select(surrogate_key("o_custkey", "l_partkey").alias("pair_id"), "*")


# ---- pivot ---------------------------------------------------------------------------------------

_STATUS = {"O": "open_max", "F": "filled_max", "P": "pending_max"}
_PIVOT = """
SELECT o_custkey,
       max(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS open_max,
       max(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS filled_max,
       max(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END) AS pending_max
FROM orders GROUP BY o_custkey
"""


def _pivoted(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return pivot_fixed(orders, ["o_custkey"], "o_orderstatus", "o_totalprice", _STATUS)


@query(
    f"SELECT *, open_max + filled_max + pending_max AS total FROM ({_PIVOT})"
)
def pivot_status(spark: SparkSession, folder: str) -> DataFrame:
    """One column per status and their sum, which is NULL where a status is missing."""
    return _pivoted(spark, folder).withColumn("total", total(_STATUS.values()))


@query(
    f"""
    SELECT o_custkey, 'O' AS status, open_max AS price FROM ({_PIVOT}) WHERE open_max IS NOT NULL
    UNION ALL SELECT o_custkey, 'F', filled_max FROM ({_PIVOT}) WHERE filled_max IS NOT NULL
    UNION ALL SELECT o_custkey, 'P', pending_max FROM ({_PIVOT}) WHERE pending_max IS NOT NULL
    """
)
def unpivot_status(spark: SparkSession, folder: str) -> DataFrame:
    return unpivot(_pivoted(spark, folder), ["o_custkey"], _STATUS, "status", "price")


# ---- history -------------------------------------------------------------------------------------

_YEARS = """
yearly AS (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS period,
         arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS priority
  FROM orders GROUP BY ALL),
bounds AS (SELECT o_custkey, min(period) AS intro, max(period) AS newest FROM yearly GROUP BY ALL),
past AS (SELECT y.* FROM yearly y JOIN bounds b USING (o_custkey) WHERE y.period < b.newest),
present AS (SELECT y.o_custkey, y.priority FROM yearly y JOIN bounds b USING (o_custkey)
            WHERE y.period = b.newest)
"""


def _customer_history(spark: SparkSession, folder: str, rule: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    newest = F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey"))
    yearly = orders.groupBy("o_custkey", F.year("o_orderdate").alias("period")).agg(
        newest.alias("priority")
    )
    yearly = yearly.withColumn("slot", F.lit(1))
    bounds = yearly.groupBy("o_custkey").agg(
        F.min("period").alias("intro"), F.max("period").alias("newest")
    )
    dated = yearly.join(bounds, "o_custkey")
    return validity_windows(
        dated.where("period < newest").select("o_custkey", "slot", "priority", "period"),
        dated.where("period = newest").select("o_custkey", "slot", "priority"),
        bounds,
        "o_custkey",
        "slot",
        "priority",
        rule=rule,
    ).drop("slot")


@query(
    f"""
    WITH {_YEARS}
    SELECT o_custkey, priority,
           coalesce(lag(period) OVER (PARTITION BY o_custkey ORDER BY period) + 1, intro) AS valid_from,
           period AS valid_to
    FROM past JOIN bounds USING (o_custkey)
    UNION ALL
    SELECT o_custkey, priority, coalesce(last_period + 1, intro), NULL
    FROM present JOIN bounds USING (o_custkey)
    LEFT JOIN (SELECT o_custkey, max(period) AS last_period FROM past GROUP BY ALL) USING (o_custkey)
    """
)
def type_history(spark: SparkSession, folder: str) -> DataFrame:
    """A customer's order priority by year, the newest year being the current one."""
    return _customer_history(spark, folder, "documented")


@query(
    f"""
    WITH {_YEARS}
    SELECT o_custkey, priority,
           coalesce(lag(intro) OVER (PARTITION BY o_custkey ORDER BY period) + 1, intro) AS valid_from,
           intro AS valid_to
    FROM past JOIN bounds USING (o_custkey)
    UNION ALL
    SELECT o_custkey, priority, coalesce(last_end + 1, intro), NULL
    FROM present JOIN bounds USING (o_custkey)
    LEFT JOIN (SELECT o_custkey, max(intro) AS last_end FROM past JOIN bounds USING (o_custkey) GROUP BY ALL)
      USING (o_custkey)
    """
)
def type_history_as_written(spark: SparkSession, folder: str) -> DataFrame:
    return _customer_history(spark, folder, "as_written")


# ---- incremental loads ---------------------------------------------------------------------------

_CUT = "2024-01-20"
_OLD = f"(SELECT * FROM events WHERE ts < TIMESTAMP '{_CUT}')"
_NEW = f"(SELECT * FROM events WHERE ts >= TIMESTAMP '{_CUT}')"


@query(
    f"""
    SELECT * FROM {_OLD} WHERE user_id NOT IN (SELECT user_id FROM {_NEW})
    UNION ALL SELECT * FROM {_NEW}
    """
)
def incremental_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Events up to a cut as the target; users seen since then are replaced as a whole."""
    events = table(spark, folder, "events")
    target = events.where(f"ts < TIMESTAMP_NTZ '{_CUT}'")
    batch = inc.since(events, "ts", datetime.fromisoformat(_CUT))
    return inc.keyed_replace(target, batch, ["user_id"])


@query("SELECT * FROM events")
def incremental_full_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """A mart loaded from part of its source, then rebuilt from all of it."""
    events = table(spark, folder, "events")
    name = f"{_database(spark)}.events"
    options = {"key": "user_id", "columns": events.columns, "loaded_at": "ts"}
    tables.load_mart(events.where(f"ts < TIMESTAMP_NTZ '{_CUT}'"), name, **options)
    tables.load_mart(events, name, full_refresh=True, **options)
    return spark.table(name)


@query("SELECT max(ts) AS newest, min(ts) AS oldest, count(*) AS n FROM events")
def high_water_mark(spark: SparkSession, folder: str) -> DataFrame:
    """The mark as the incremental loads take it."""
    events = table(spark, folder, "events")
    newest = F.lit(inc.high_water_mark(events, "ts").isoformat()).cast("timestamp_ntz")
    return events.agg(F.min("ts").alias("oldest"), F.count(F.lit(1)).alias("n")).select(
        newest.alias("newest"), "oldest", "n"
    )


@query(
    """
    SELECT doc_id, quality FROM labels
    UNION ALL
    SELECT doc_id, NULL FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    """
)
def append_unseen(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without a label appended to the labels."""
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    batch = table(spark, folder, "documents").select(
        "doc_id", F.lit(None).cast("int").alias("quality")
    )
    return labels.unionByName(inc.append_unseen(labels, batch, ["doc_id"]))


@query(
    """
    SELECT event_id, user_id, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-05' THEN value + 1 ELSE value END AS value,
           CAST(CAST(ts AS DATE) AS VARCHAR) AS batch_id
    FROM events
    """
)
def batch_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """One day's batch landed again: only the folder of that batch is overwritten."""
    day = F.col("ts").cast("date").cast("string").alias("batch_id")
    events = table(spark, folder, "events")
    landed = events.select("event_id", "user_id", "value", day)
    path = fresh_path(spark, "batches")
    # few files per batch, and a large batch is still split over several tasks
    landed.hint("rebalance", F.col("batch_id")).write.partitionBy("batch_id").parquet(path)
    again = landed.where("batch_id = '2024-01-05'").withColumn("value", F.col("value") + 1)
    again.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "batch_id"
    ).parquet(path)
    schema = landed.schema
    return spark.read.schema(schema).parquet(path).select(*landed.columns)


@query(
    """
    SELECT event_id, user_id, value, event_type AS batch_id FROM events WHERE event_type <> 'click'
    UNION ALL SELECT event_id, user_id, value * 2, 'click' FROM events WHERE event_type = 'click'
    """
)
def batch_replace(spark: SparkSession, folder: str) -> DataFrame:
    """The same for a table that is not laid out by batch: earlier rows dropped by batch id."""
    landed = table(spark, folder, "events").select(
        "event_id", "user_id", "value", F.col("event_type").alias("batch_id")
    )
    again = landed.where("batch_id = 'click'").withColumn("value", F.col("value") * 2)
    return inc.replace_batch(landed, again)


# ---- planning ------------------------------------------------------------------------------------


@query(
    "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) "
    "ORDER BY doc_id LIMIT 50"
)
def missing_batch(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return plan.next_batch(plan.missing_ids(documents, labels, "doc_id"), "doc_id", 50)


@query(
    """
    SELECT r.id FROM (SELECT unnest(range(0, (SELECT max(doc_id) + 1 FROM documents))) AS id) r
    WHERE r.id NOT IN (SELECT doc_id FROM labels)
    """
)
def missing_range(spark: SparkSession, folder: str) -> DataFrame:
    last = table(spark, folder, "documents").agg(F.max("doc_id")).first()[0]
    return plan.missing_from_range(table(spark, folder, "labels"), "doc_id", 0, last)


@query(
    "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"
)
def missing_setdiff(spark: SparkSession, folder: str) -> DataFrame:
    return plan.missing_ids(
        table(spark, folder, "orders"), table(spark, folder, "lineitem"), "o_orderkey", "l_orderkey"
    )


@query(
    """
    SELECT event_id, CASE WHEN event_type = 'error' THEN '{"k": ' ELSE props END AS payload,
           event_type = 'error' AS quarantined FROM events
    """
)
def quarantine_json(spark: SparkSession, folder: str) -> DataFrame:
    """Payloads of one event type are torn; they are kept apart from the readable ones."""
    torn = F.when(F.col("event_type") == "error", F.substring("props", 1, 6)).otherwise(F.col("props"))
    landed = table(spark, folder, "events").select("event_id", torn.alias("payload"))
    good, bad = plan.split_malformed(landed)
    return good.withColumn("quarantined", F.lit(False)).unionByName(
        bad.withColumn("quarantined", F.lit(True))
    )


# ---- serving -------------------------------------------------------------------------------------


@query(
    """
    SELECT c_custkey, c_name, c_acctbal FROM customer
    WHERE c_mktsegment = 'MACHINERY' AND c_acctbal BETWEEN 1000 AND 6000
      AND c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_name IN ('NATION_1', 'NATION_7', 'NATION_19'))
    """
)
def explorer_filter(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").where(
        (F.col("c_mktsegment") == "MACHINERY") & F.col("c_acctbal").between(1000, 6000)
    )
    nation = table(spark, folder, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    names = ["NATION_1", "NATION_7", "NATION_19"]
    kept = serving.having_any(customer, nation, "c_nationkey", "n_name", names)
    return kept.select("c_custkey", "c_name", "c_acctbal").orderBy("c_custkey")


@query(
    f"""
    WITH ranked AS (SELECT c_custkey, rank, {_LADDER} FROM ({_TIERED}))
    SELECT c.c_custkey, c.c_name, n.n_name, c.c_acctbal, r.rank, r.tier
    FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey LEFT JOIN ranked r USING (c_custkey)
    """
)
def entity_list(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation")
    ranks = _tiered(spark, folder).select("c_custkey", "rank", "tier")
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(ranks, "c_custkey", "left")
        .select("c_custkey", "c_name", "n_name", "c_acctbal", "rank", "tier")
        .orderBy("c_custkey")
    )


_PLACED = """customer JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey"""


def _placed(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey)
    customer = table(spark, folder, "customer")
    return customer.join(places, customer.c_nationkey == places.n_nationkey)


@query(f"SELECT r_name, count(*) AS n FROM {_PLACED} GROUP BY r_name")
def count_per_group(spark: SparkSession, folder: str) -> DataFrame:
    return serving.count_per_group(_placed(spark, folder), "r_name").orderBy("r_name")


@query(
    f"SELECT r_name, round(avg(c_acctbal), 6) AS average FROM {_PLACED} GROUP BY r_name"
)
def avg_per_group(spark: SparkSession, folder: str) -> DataFrame:
    grouped = _placed(spark, folder).groupBy("r_name")
    return grouped.agg(F.round(F.avg("c_acctbal"), 6).alias("average")).orderBy("r_name")


@query(
    "SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10"
)
def topk(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_retailprice")
    return serving.top_k(parts, 10, "p_retailprice", "p_partkey")


@query(
    """
    SELECT o_orderkey, c_name, n_name, o_totalprice
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    WHERE o_orderstatus = 'P' ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
    """
)
def topk_filtered(spark: SparkSession, folder: str) -> DataFrame:
    """Top orders of one status among those whose customer and nation are known; the best ones are joined."""
    orders = table(spark, folder, "orders").where("o_orderstatus = 'P'")
    customer = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")

    def known(rows: DataFrame) -> DataFrame:
        rows = rows.join(customer, rows.o_custkey == customer.c_custkey)
        rows = rows.join(nation, rows.c_nationkey == nation.n_nationkey)
        return rows.select("o_orderkey", "c_name", "n_name", "o_totalprice")

    return serving.top_k_joined(orders, 10, "o_totalprice", "o_orderkey", known)


@query(
    """
    SELECT o_orderkey, shipped FROM orders
    LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS shipped FROM lineitem GROUP BY ALL)
      ON l_orderkey = o_orderkey
    ORDER BY shipped DESC NULLS LAST, o_orderkey LIMIT 25
    """
)
def topk_nulls_last(spark: SparkSession, folder: str) -> DataFrame:
    shipped = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.max("l_shipdate").alias("shipped"))
    )
    rows = table(spark, folder, "orders").select("o_orderkey").join(shipped, "o_orderkey", "left")
    return serving.top_k(rows, 25, "shipped", "o_orderkey")


_ORDERED = """orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey"""


def _ordered_parts(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    part = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(
        part, lines.l_partkey == part.p_partkey
    )


@query(f"SELECT o_custkey, p_name, p_brand, l_quantity FROM {_ORDERED}")
def three_way(spark: SparkSession, folder: str) -> DataFrame:
    return _ordered_parts(spark, folder).select("o_custkey", "p_name", "p_brand", "l_quantity")


@query(
    f"SELECT p_type, p_brand, p_name, l_quantity FROM {_ORDERED} WHERE o_custkey = 7"
)
def moves_of_one(spark: SparkSession, folder: str) -> DataFrame:
    rows = _ordered_parts(spark, folder).where("o_custkey = 7")
    return rows.select("p_type", "p_brand", "p_name", "l_quantity").orderBy(
        "p_type", "p_brand", "p_name"
    )


@query(
    """
    SELECT o_orderkey, o_orderkey IN (SELECT l_orderkey FROM lineitem) AS has_lines,
           CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem) THEN o_orderpriority ELSE '—' END AS shown
    FROM orders
    """
)
def exists_flags(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    lines = table(spark, folder, "lineitem")
    flagged = serving.with_flag(orders, lines, "o_orderkey", "has_lines", "l_orderkey")
    shown = F.coalesce(F.when(F.col("has_lines"), F.col("o_orderpriority")), F.lit("—"))
    return flagged.select("o_orderkey", "has_lines", shown.alias("shown"))


@query("SELECT min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders")
def value_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return serving.value_bounds(table(spark, folder, "orders"), "o_totalprice")


@query("SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority IS NOT NULL")
def distinct_priorities(spark: SparkSession, folder: str) -> DataFrame:
    return distinct_values(table(spark, folder, "orders"), "o_orderpriority")


# ---- quality -------------------------------------------------------------------------------------


@query(
    """
    SELECT 'not_null' AS "check", 'o_custkey' AS columns,
           (SELECT count(*) FROM orders WHERE o_custkey IS NULL) AS failures
    UNION ALL SELECT 'accepted_values', 'o_orderstatus',
           (SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('O', 'F'))
    UNION ALL SELECT 'accepted_range', 'o_totalprice',
           (SELECT count(*) FROM orders WHERE o_totalprice < 1000 OR o_totalprice > 400000)
    UNION ALL SELECT 'min_value', 'o_totalprice',
           (SELECT count(*) FROM orders WHERE o_totalprice < 1000)
    UNION ALL SELECT 'unique', 'o_custkey',
           (SELECT count(*) FROM (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 1))
    UNION ALL SELECT 'unique_combination', 'o_custkey,o_orderdate',
           (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1))
    UNION ALL SELECT 'relationships', 'o_orderkey',
           (SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))
    """
)
def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    orders, lines = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    return q.run_checks(
        orders,
        [
            q.not_null("o_custkey"),
            q.accepted_values("o_orderstatus", ["O", "F"]),
            q.accepted_range("o_totalprice", 1000, 400000),
            q.min_value("o_totalprice", 1000),
            q.unique("o_custkey"),
            q.unique_combination("o_custkey", "o_orderdate"),
            q.relationships("o_orderkey", lines, "l_orderkey"),
        ],
    )


@query(
    """
    SELECT 'missing_part' AS rule, o_custkey AS key FROM (SELECT * FROM ({pivot}))
    WHERE open_max IS NULL OR filled_max IS NULL OR pending_max IS NULL
    UNION ALL
    SELECT 'no_primary', l_orderkey FROM lineitem GROUP BY l_orderkey
    HAVING sum(CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END) = 0
    UNION ALL
    SELECT 'negative', c_custkey FROM customer WHERE c_acctbal < 0
    UNION ALL
    SELECT 'wrong_total', o_custkey FROM ({pivot})
    WHERE o_custkey % 97 = 0 AND open_max + filled_max + pending_max IS NOT NULL
    UNION ALL
    SELECT 'rank_gap', count(*) FROM customer JOIN nation ON n_nationkey = c_nationkey
    UNION ALL
    (SELECT 'top_tier', c_custkey FROM customer JOIN nation ON n_nationkey = c_nationkey
     ORDER BY c_acctbal DESC NULLS LAST, c_custkey LIMIT 1)
    """.replace("{pivot}", _PIVOT)
)
def quality_singular(spark: SparkSession, folder: str) -> DataFrame:
    """Hand-written rules; the rows are the failures.

    The ranks and totals are checked on stored tables into which faults were put: some totals are one
    too high, the second rank is missing, and the first row has the wrong tier.
    """

    def failures(rule: str, df: DataFrame, key: str) -> DataFrame:
        return df.select(F.lit(rule).alias("rule"), F.col(key).cast("bigint").alias("key"))

    off = F.when(F.col("o_custkey") % 97 == 0, 1).otherwise(0)
    wide = cut_lineage(_pivoted(spark, folder).withColumn("total", total(_STATUS.values()) + off))
    missing = q.row_rule(
        "missing_part",
        _STATUS.values(),
        F.col("open_max").isNull() | F.col("filled_max").isNull() | F.col("pending_max").isNull(),
    )
    wrong = q.row_rule("wrong_total", ["total"], F.col("total") != total(_STATUS.values()))
    lines = table(spark, folder, "lineitem")
    customer = table(spark, folder, "customer")
    first_as_a = F.when(F.col("rank") == 1, "A").otherwise(F.col("tier"))
    ranked = cut_lineage(_tiered(spark, folder).where("rank <> 2").withColumn("tier", first_as_a))
    top = q.row_rule("top_tier", ["tier"], (F.col("rank") == 1) & (F.col("tier") != "S"))
    return (
        failures("missing_part", q.failing_rows(wide, missing), "o_custkey")
        .unionByName(failures("wrong_total", q.failing_rows(wide, wrong), "o_custkey"))
        .unionByName(
            failures(
                "no_primary",
                q.group_without(lines, "l_orderkey", F.col("l_linenumber") == 1),
                "l_orderkey",
            )
        )
        .unionByName(
            failures("negative", q.failing_rows(customer, q.min_value("c_acctbal", 0)), "c_custkey")
        )
        .unionByName(failures("rank_gap", q.rank_gaps(ranked), "max_rank"))
        .unionByName(failures("top_tier", q.failing_rows(ranked, top), "c_custkey"))
    )


@query(
    """
    SELECT event_type,
           max(ts) AS newest,
           CAST(epoch_us(TIMESTAMP '2024-02-10') - epoch_us(max(ts)) AS DOUBLE) / 1000000 AS age_seconds,
           CASE WHEN TIMESTAMP '2024-02-10' - max(ts) > INTERVAL 30 DAY THEN 'error'
                WHEN TIMESTAMP '2024-02-10' - max(ts) > INTERVAL 9 DAY THEN 'warn' ELSE 'pass' END AS status
    FROM (SELECT 'all' AS event_type, ts FROM events
          UNION ALL SELECT 'old', ts FROM events WHERE ts < TIMESTAMP '2024-01-05') GROUP BY event_type
    """
)
def source_freshness(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    limits = (datetime(2024, 2, 10), timedelta(days=9), timedelta(days=30))
    old = events.where("ts < TIMESTAMP_NTZ '2024-01-05'")
    reports = [
        q.freshness(df, "ts", *limits).select(F.lit(name).alias("event_type"), "*")
        for name, df in (("all", events), ("old", old))
    ]
    return reports[0].unionByName(reports[1])


@query(
    """
    SELECT 'orders' AS "table", count(*) AS source_rows, count(*) AS copied_rows, 'OK' AS status FROM orders
    UNION ALL SELECT 'customer', count(*), count(*), 'OK' FROM customer
    UNION ALL SELECT 'nothing', 0, 0, 'SKIPPED'
    """
)
def reconcile_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tables exported to Parquet, counts compared; an empty one is skipped."""
    orders = table(spark, folder, "orders")
    frames = {
        "orders": orders,
        "customer": table(spark, folder, "customer"),
        "nothing": orders.where(F.lit(False)),
    }
    return archive.export_archive(spark, frames, fresh_path(spark, "archive"))


@query(
    """
    SELECT 'supplier' AS "table", count(*) AS source_rows, count(*) AS copied_rows, 'OK' AS status FROM supplier
    UNION ALL SELECT 'part', count(*), count(*), 'OK' FROM part
    """
)
def seed_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tables replaced from archived Parquet files, counts compared."""
    files = {name: f"{folder.rstrip('/')}/{name}.parquet" for name in ("supplier", "part")}
    return archive.seed_from_archive(spark, _database(spark), files)


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", '{dtype}' AS type, count(*) AS n_rows, "
        f"count(*) - count({name}) AS n_nulls, {low} AS low, {high} AS high FROM orders"
        for name, dtype, low, high in [
            (n, t, f"CAST(min({n}) AS VARCHAR)", f"CAST(max({n}) AS VARCHAR)")
            for n, t in (
                ("o_orderkey", "bigint"),
                ("o_custkey", "bigint"),
                ("o_orderstatus", "string"),
                ("o_totalprice", "double"),
                ("o_orderdate", "timestamp_ntz"),
                ("o_orderpriority", "string"),
            )
        ]
    )
)
def mart_profile(spark: SparkSession, folder: str) -> DataFrame:
    return column_profile(table(spark, folder, "orders"))


@query(
    """
    SELECT 'nation' AS "table", 3 AS n_columns, 'n_nationkey:int,n_name:string,n_regionkey:int' AS listed,
           (SELECT least(count(*), 5) FROM nation) AS n_samples
    UNION ALL
    SELECT 'region', 2, 'r_regionkey:int,r_name:string', (SELECT least(count(*), 5) FROM region)
    """
)
def schema_listing(spark: SparkSession, folder: str) -> DataFrame:
    """Columns of each table as a list of records, and how many sample rows it gives."""
    frames = {name: table(spark, folder, name) for name in ("nation", "region")}
    listed = table_columns(spark, frames)
    text = F.concat_ws(
        ",", F.transform("columns", lambda c: F.concat(c["column"], F.lit(":"), c["type"]))
    )
    samples = None
    for name, df in frames.items():
        counted = sample_rows(df).agg(
            F.lit(name).alias("table"), F.count(F.lit(1)).alias("n_samples")
        )
        samples = counted if samples is None else samples.unionByName(counted)
    return listed.join(samples, "table").select(
        "table", F.size("columns").alias("n_columns"), text.alias("listed"), "n_samples"
    )
