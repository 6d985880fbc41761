"""Windows, pages, sorts and set operations.

A result has no order once compared, so ordered operators also return each
row's position where the position is what matters.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhouse.operators import ordering, ranking, sets
from tallyhouse.settings import cut_lineage, scratch_path
from tallyhouse.sources.ordered import POSITION, OrderedCopy
from workload.registry import query
from workload.relations import (
    LATEST_ORDERS,
    REVISION,
    RUNS,
    SNAPSHOTS,
    STORAGE,
    orders,
    runs,
    snapshots,
    stamp,
    stamp_sql,
    storage,
    table,
    text,
)


def positioned(df):
    """Rows with their place in the given order. The rows are written once, in order."""
    placed = cut_lineage(df)
    return ranking.place_numbers(placed, "position")


@query(
    "w1_latest_revision",
    f"""SELECT customer_id, order_id, CAST(order_date AS VARCHAR) AS order_date, CAST(amount AS DOUBLE) AS amount, status FROM {LATEST_ORDERS}""",
)
def latest_revision(spark, sf):
    rows = ranking.latest_revision(orders(spark, sf), ["customer_id"], REVISION)
    return rows.select(
        "customer_id", "order_id", text("order_date").alias("order_date"), F.col("amount").cast("double").alias("amount"), "status"
    )


@query(
    "w2_with_match_count",
    "SELECT l_orderkey, l_linenumber, l_suppkey, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS match_count FROM lineitem",
)
def with_match_count(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return ranking.with_match_count(rows, ["l_orderkey", "l_linenumber"])


@query(
    "w3_current_version",
    f"SELECT job_id AS id, max(run_number) AS version, arg_max(status, run_number) AS status FROM {RUNS} GROUP BY job_id",
)
def current_version(spark, sf):
    versions = runs(spark, sf).select(F.col("job_id").alias("id"), F.col("run_number").alias("version"), "status")
    return ranking.current_version(versions, "id")


@query(
    "w4_latest_storage",
    f"""SELECT database_id, {stamp_sql('computed_ts')} AS computed_ts, active_bytes FROM {STORAGE}
    QUALIFY row_number() OVER (PARTITION BY database_id ORDER BY computed_ts DESC) = 1""",
)
def latest_storage(spark, sf):
    rows = ranking.latest_storage(storage(spark, sf))
    return rows.select("database_id", stamp("computed_ts").alias("computed_ts"), "active_bytes")


@query(
    "w5_storage_growth",
    f"""SELECT database_id, {stamp_sql('computed_ts')} AS computed_ts, active_bytes,
    lag(active_bytes) OVER w AS previous_active_bytes, active_bytes - lag(active_bytes) OVER w AS growth
    FROM {STORAGE} WINDOW w AS (PARTITION BY database_id ORDER BY computed_ts)""",
)
def storage_growth(spark, sf):
    rows = ranking.storage_growth(storage(spark, sf).select("database_id", "computed_ts", "active_bytes"))
    return rows.withColumn("computed_ts", stamp("computed_ts"))


PAGE = """SELECT job_id, run_number, status FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY run_number DESC) AS rn FROM {runs})
    WHERE rn > {skip} AND rn <= {last}"""


@query("w6_page_per_group", PAGE.format(runs=RUNS, skip=2, last=5))
def page_per_group(spark, sf):
    rows = runs(spark, sf).select("job_id", "run_number", "status")
    return ranking.page_per_group(rows, ["job_id"], [F.desc("run_number")], 3, 2)


@query("w6_deep_page_per_group", PAGE.format(runs=RUNS, skip=3, last=2003))
def deep_page_per_group(spark, sf):
    """A window too deep for a bounded prefix, cut from exact row numbers."""
    rows = runs(spark, sf).select("job_id", "run_number", "status")
    return ranking.page_per_group(rows, ["job_id"], [F.desc("run_number")], 2000, 3)


@query(
    "l1_page",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25 OFFSET 40",
)
def page(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return ordering.page(rows, [("o_totalprice", True), "o_orderkey"], 25, 40)


@query(
    "l1_deep_page",
    "SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey FROM lineitem ORDER BY l_orderkey, l_linenumber, l_suppkey, l_partkey LIMIT 3000 OFFSET 2500",
)
def deep_page(spark, sf):
    names = ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"]
    return ordering.page(table(spark, sf, "lineitem").select(*names), names, 3000, 2500)


LINE_KEYS = ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"]


@query(
    "l1_kept_order_page",
    "SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey FROM lineitem ORDER BY l_orderkey, l_linenumber, l_suppkey, l_partkey LIMIT 3000 OFFSET 2500",
)
def kept_order_page(spark, sf):
    """A page read from a sorted copy: only the blocks it lies in."""
    rows = table(spark, sf, "lineitem").select(*LINE_KEYS)
    return OrderedCopy(spark, scratch_path(spark, "ordered")).write(rows, LINE_KEYS, block_rows=5000).page(3000, 2500)


@query(
    "l1_kept_order_rows",
    """SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,
    row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_suppkey, l_partkey) AS position FROM lineitem""",
)
def kept_order_rows(spark, sf):
    """All lines with their positions in the kept order."""
    rows = table(spark, sf, "lineitem").select(*LINE_KEYS)
    copy = OrderedCopy(spark, scratch_path(spark, "ordered")).write(rows, LINE_KEYS, block_rows=5000)
    return copy.between(1, None).withColumnRenamed(POSITION, "position")


@query(
    "w6_kept_order_page",
    """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 400 OFFSET 100""",
)
def kept_group_page(spark, sf):
    """A page inside one of few, large keys, found through the index of keys."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    copy = OrderedCopy(spark, scratch_path(spark, "ordered"))
    return copy.write(rows, [("o_totalprice", True), "o_orderkey"], ["o_orderstatus"], block_rows=500).group_page(("F",), 400, 100)


@query(
    "l1_offset_only",
    "SELECT event_id, user_id FROM events ORDER BY event_id OFFSET 300",
)
def offset_only(spark, sf):
    return ordering.page(table(spark, sf, "events").select("event_id", "user_id"), ["event_id"], None, 300)


@query("l1_zero_limit", "SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 0 OFFSET 3")
def zero_limit(spark, sf):
    return ordering.page(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 0, 3)


@query("l2_order_by_all", "SELECT p_brand, p_type, p_partkey FROM part ORDER BY ALL LIMIT 50 OFFSET 10")
def order_by_all(spark, sf):
    return ordering.order_by_all(table(spark, sf, "part").select("p_brand", "p_type", "p_partkey"), 50, 10)


@query(
    "l2_order_by_all_rows",
    "SELECT p_brand, p_type, p_partkey, row_number() OVER (ORDER BY p_brand NULLS LAST, p_type NULLS LAST, p_partkey NULLS LAST) AS position FROM part",
)
def order_by_all_rows(spark, sf):
    return positioned(ordering.order_by_all(table(spark, sf, "part").select("p_brand", "p_type", "p_partkey")))


@query(
    "l3_stable_sort",
    """SELECT event_id, event_type, score, row_number() OVER (ORDER BY score DESC NULLS LAST, event_type ASC NULLS FIRST, CAST(event_id AS VARCHAR)) AS position
    FROM (SELECT event_id, event_type, CASE WHEN event_id % 5 <> 0 THEN CAST(floor(value) AS BIGINT) END AS score FROM events)""",
)
def stable_sort(spark, sf):
    """Descending numbers with nulls last; ties by the row's JSON, which starts with the id."""
    score = F.when(F.col("event_id") % 5 != 0, F.floor("value"))
    rows = table(spark, sf, "events").select("event_id", "event_type", score.alias("score"))
    return positioned(ordering.stable_sort(rows, [("score", True), "missing", "event_type"]))


@query(
    "l4_candidate_keys",
    f"""SELECT job_id, run_number, row_number() OVER (ORDER BY run_number DESC) AS position FROM {RUNS}""",
)
def candidate_keys(spark, sf):
    """Of several candidate version columns only the present one orders the rows."""
    rows = runs(spark, sf).select("job_id", "run_number")
    return positioned(ordering.stable_sort(rows, [("version_number", True), ("version", True), ("run_number", True)]))


@query("l5_newest_runs", f"SELECT job_id, run_number, status FROM {RUNS} ORDER BY run_number DESC LIMIT 50")
def newest_runs(spark, sf):
    return ordering.newest_runs(runs(spark, sf).select("job_id", "run_number", "status"))


@query("l5_newest_runs_offset", f"SELECT job_id, run_number FROM {RUNS} ORDER BY run_number DESC LIMIT 10 OFFSET 15")
def newest_runs_offset(spark, sf):
    return ordering.newest_runs(runs(spark, sf).select("job_id", "run_number"), 10, 15)


LINES = "(SELECT conv_id * 100 + turn AS line_number, text AS line FROM conversations)"


def lines(spark, sf):
    return table(spark, sf, "conversations").select((F.col("conv_id") * 100 + F.col("turn")).alias("line_number"), F.col("text").alias("line"))


@query("l6_log_tail", f"SELECT line_number, line FROM {LINES} ORDER BY line_number DESC LIMIT 100")
def log_tail(spark, sf):
    return ordering.log_window(lines(spark, sf))


@query("l6_log_tail_offset", f"SELECT * FROM (SELECT line_number FROM {LINES} ORDER BY line_number DESC LIMIT 100) ORDER BY line_number OFFSET 30")
def log_tail_offset(spark, sf):
    return ordering.log_window(lines(spark, sf), offset=30).select("line_number")


@query("l6_log_desc", f"SELECT line_number FROM {LINES} ORDER BY line_number DESC LIMIT 20 OFFSET 5")
def log_desc(spark, sf):
    return ordering.log_window(lines(spark, sf).select("line_number"), 20, 5, "desc")


OBJECT_KEYS = """(SELECT CASE WHEN page_id % 4 = 0 THEN 'folder' ELSE 'file' END AS type, split_part(url, '/', 3) || '-' || page_id AS name FROM pages)"""


@query(
    "l7_order_object_keys",
    f"""SELECT type, name, row_number() OVER (ORDER BY CASE WHEN type = 'folder' THEN name || '/' ELSE name END) AS position FROM {OBJECT_KEYS}""",
)
def order_object_keys(spark, sf):
    kind = F.when(F.col("page_id") % 4 == 0, "folder").otherwise("file")
    name = F.concat(F.split_part("url", F.lit("/"), F.lit(3)), F.lit("-"), text("page_id"))
    return positioned(ordering.order_object_keys(table(spark, sf, "pages").select(kind.alias("type"), name.alias("name"))))


FOLDED = """(SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END || (c_custkey // 2) AS name FROM customer)"""


@query(
    "l8_order_folded",
    f"SELECT name, row_number() OVER (ORDER BY lower(name), name) AS position FROM {FOLDED}",
)
def order_folded(spark, sf):
    key = F.col("c_custkey")
    half = text(((key - key % 2) / 2).cast("bigint"))
    segment = F.when(key % 2 == 0, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment"))
    rows = table(spark, sf, "customer").select(F.concat(segment, half).alias("name"))
    return positioned(ordering.order_folded(rows, ["name"]))


@query(
    "l9_sort_nested",
    """SELECT conv_id, turn // 100 AS block, string_agg(turn || ':' || role, ',' ORDER BY turn) AS turns, string_agg(role, ',' ORDER BY role) AS roles
    FROM (SELECT DISTINCT conv_id, turn, role FROM conversations) GROUP BY ALL""",
)
def sort_nested(spark, sf):
    """Conversations in blocks of a hundred turns, with turns and roles as sorted arrays."""
    block = ((F.col("turn") - F.col("turn") % 100) / 100).cast("bigint")
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role").distinct()
    grouped = turns.groupBy("conv_id", block.alias("block")).agg(
        F.collect_list(F.struct("turn", "role")).alias("turns"), F.collect_list("role").alias("roles")
    )
    rows = ordering.sort_nested(grouped, ["conv_id", "block"], {"turns": "turn"}, ["roles"])
    each = F.transform("turns", lambda t: F.concat(t["turn"].cast("string"), F.lit(":"), t["role"]))
    return rows.select("conv_id", "block", F.array_join(each, ",").alias("turns"), F.array_join("roles", ",").alias("roles"))


@query("l10_first_by_name", "SELECT p_name || p_partkey AS name, p_type FROM part WHERE upper(p_type) = 'ECONOMY' ORDER BY name LIMIT 1")
def first_by_name(spark, sf):
    rows = table(spark, sf, "part").select(F.concat("p_name", text("p_partkey")).alias("name"), "p_type")
    return ordering.first_by_name(rows, "name", "p_type", "economy")


@query(
    "x1_role_members",
    """SELECT 'nation_' || c_nationkey AS granted_to, 'u' || c_custkey AS member_name, 'user' AS member_type, c_name || '@example.com' AS email,
    c_acctbal < 0 AS is_service_account FROM customer UNION ALL SELECT 'nation_' || s_nationkey, 'sup_' || s_suppkey, 'role', NULL, NULL FROM supplier""",
)
def role_members(spark, sf):
    users = table(spark, sf, "customer").select(
        F.concat(F.lit("nation_"), text("c_nationkey")).alias("granted_to"),
        F.concat(F.lit("u"), text("c_custkey")).alias("username"),
        F.concat("c_name", F.lit("@example.com")).alias("email"),
        (F.col("c_acctbal") < 0).alias("is_service_account"),
        F.lit(None).cast("timestamp").alias("granted_at"),
    )
    roles = table(spark, sf, "supplier").select(
        F.concat(F.lit("nation_"), text("s_nationkey")).alias("granted_to"),
        F.concat(F.lit("sup_"), text("s_suppkey")).alias("role_name"),
        F.lit(None).cast("timestamp").alias("granted_at"),
    )
    return sets.role_members(users, roles).drop("granted_at")


@query(
    "x2_dedupe_first",
    """SELECT o_custkey AS id, o_orderkey AS first_order, o_orderstatus AS status FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1""",
)
def dedupe_first(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("first_order"), F.col("o_orderstatus").alias("status")
    )
    return sets.dedupe_first(rows, "id", ["first_order"])


@query(
    "x3_union_pages",
    "SELECT c_custkey AS id, c_name AS name, NULL AS note FROM customer UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM supplier",
)
def union_pages(spark, sf):
    first = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    second = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("supplier").alias("note")
    )
    return sets.union_pages([first, second])


@query("x3_pages_folder", "SELECT o_orderkey, o_custkey FROM orders")
def pages_folder(spark, sf):
    """Listing pages written as separate files and read back as one table."""
    path = scratch_path(spark, "pages")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    for page_number in range(3):
        rows.filter(F.col("o_orderkey") % 3 == page_number).write.parquet(f"{path}/page={page_number}")
    return spark.read.parquet(path).drop("page")


@query(
    "x4_set_diff",
    "SELECT c_custkey AS custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 300000",
)
def set_diff(spark, sf):
    expected = table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"))
    actual = table(spark, sf, "orders").filter("o_totalprice > 300000").select(F.col("o_custkey").alias("custkey"))
    return sets.set_diff(expected, actual, ["custkey"])


@query(
    "u9_snapshot_listing",
    f"""SELECT database_name, snapshot_id, {stamp_sql('created_ts')} AS created_ts, active_bytes FROM {SNAPSHOTS}
    WHERE lower(database_name) = 'db_7' ORDER BY database_name, created_ts, snapshot_id LIMIT 200 OFFSET 20""",
)
def snapshot_listing(spark, sf):
    from tallyhouse.operators.usage import snapshot_listing as listing

    rows = listing(snapshots(spark, sf), "DB_7", 200, 20)
    return rows.select("database_name", "snapshot_id", stamp("created_ts").alias("created_ts"), "active_bytes")
