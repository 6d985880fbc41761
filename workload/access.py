"""Policies, exposure, role graphs and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhouse.operators import policy, roles
from tallyhouse.operators.aggregates import all_true
from tallyhouse.settings import scratch_path
from workload.ranks import positioned
from workload.registry import query
from workload.relations import (
    AUDIENCES,
    CLOSURE,
    DAILY_USAGE,
    GRANTS,
    READERS,
    ROLE_EDGES,
    SHARES,
    TENANT_FACTS,
    WANTED_GRANTS,
    daily_usage,
    grants,
    joined,
    readers,
    role_edges,
    shares,
    table,
    tenant_facts,
    text,
    wanted_grants,
)

READER = policy.Session(user="svc_8", roles=frozenset({"usage_readers"}), context={"tenant": "view"})


def dated(df):
    return df.withColumn("usage_date", text("usage_date"))


@query(
    "v1_row_policy",
    f"""SELECT f.tenant_id, f.event_id, f.user_id FROM {TENANT_FACTS} AS f JOIN {READERS} AS r ON r.tenant_id = f.tenant_id
    WHERE r.reader_name = 'svc_8'""",
)
def row_policy(spark, sf):
    rows = policy.row_policy(tenant_facts(spark, sf), readers(spark, sf), READER)
    return rows.select("tenant_id", "event_id", "user_id")


@query(
    "v1_no_entitlement",
    f"SELECT f.tenant_id, f.event_id FROM {TENANT_FACTS} AS f JOIN {READERS} AS r ON r.tenant_id = f.tenant_id WHERE r.reader_name = 'nobody'",
)
def no_entitlement(spark, sf):
    session = policy.Session(user="nobody")
    return policy.row_policy(tenant_facts(spark, sf), readers(spark, sf), session).select("tenant_id", "event_id")


@query(
    "v2_mask_column",
    f"""SELECT u.tenant_id, CAST(u.usage_date AS VARCHAR) AS usage_date, u.event_count, CAST(NULL AS VARCHAR) AS contact_email
    FROM {DAILY_USAGE} AS u JOIN {READERS} AS r ON r.tenant_id = u.tenant_id WHERE r.reader_name = 'svc_8'""",
)
def mask_column(spark, sf):
    return dated(policy.secure_usage(daily_usage(spark, sf), readers(spark, sf), READER, "usage_pii_readers"))


@query(
    "v2_unmasked_column",
    f"""SELECT u.tenant_id, CAST(u.usage_date AS VARCHAR) AS usage_date, u.event_count, u.contact_email
    FROM {DAILY_USAGE} AS u JOIN {READERS} AS r ON r.tenant_id = u.tenant_id WHERE r.reader_name = 'svc_8'""",
)
def unmasked_column(spark, sf):
    return dated(policy.secure_usage(daily_usage(spark, sf), readers(spark, sf), READER, "usage_readers"))


@query("v3_context_policy", f"SELECT tenant_id, CAST(usage_date AS VARCHAR) AS usage_date, event_count FROM {DAILY_USAGE} WHERE tenant_id = 'view'")
def context_policy(spark, sf):
    rows = policy.context_policy(daily_usage(spark, sf), "tenant", READER, reader="svc_8")
    return dated(rows).select("tenant_id", "usage_date", "event_count")


@query("v3_missing_context", f"SELECT tenant_id, event_count FROM {DAILY_USAGE} WHERE tenant_id = NULL")
def missing_context(spark, sf):
    rows = policy.context_policy(daily_usage(spark, sf), "customer", READER, reader="svc_8")
    return rows.select("tenant_id", "event_count")


@query(
    "v4_row_predicate",
    "SELECT o_custkey AS tenant_id, o_orderkey, o_totalprice AS event_count FROM orders WHERE CAST(o_custkey AS VARCHAR) = '8' AND o_totalprice > 0",
)
def row_predicate(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("tenant_id"), "o_orderkey", F.col("o_totalprice").alias("event_count")
    )
    return policy.row_predicate(rows, policy.Session(user="8"))


CATALOG_TABLES = "(SELECT DISTINCT lang AS schema_name, source || '_' || (doc_id // 10) AS table_name FROM documents)"
SECURE_VIEWS = "(SELECT DISTINCT lang AS schema_name, source || '_' || (doc_id // 10) AS view_name FROM documents WHERE n_chars > 2000)"
EXPOSED = f"""(SELECT schema_name, table_name, max(v) AS has_secure_view FROM (
    SELECT schema_name, table_name, false AS v FROM {CATALOG_TABLES} WHERE schema_name IN ('en', 'fr.src3_7') OR schema_name || '.' || table_name IN ('en', 'fr.src3_7')
    UNION ALL SELECT schema_name, view_name, true FROM {SECURE_VIEWS}) GROUP BY ALL)"""
PATTERNS = ["en", "fr.src3_7"]


def catalog_tables(spark, sf):
    ten = text(((F.col("doc_id") - F.col("doc_id") % 10) / 10).cast("bigint"))
    name = F.concat("source", F.lit("_"), ten)
    return table(spark, sf, "documents").select(F.col("lang").alias("schema_name"), name.alias("table_name"), "n_chars")


def secure_views(spark, sf):
    rows = catalog_tables(spark, sf).filter("n_chars > 2000")
    return rows.select("schema_name", F.col("table_name").alias("view_name")).distinct()


@query("v5_exposed_tables", f"SELECT * FROM {EXPOSED}")
def exposed_tables(spark, sf):
    return policy.exposed_tables(catalog_tables(spark, sf), PATTERNS, secure_views(spark, sf))


@query("v5_views_only", f"SELECT schema_name, view_name AS table_name, true AS has_secure_view FROM {SECURE_VIEWS}")
def views_only(spark, sf):
    """An empty pattern list leaves only secure views visible."""
    return policy.exposed_tables(catalog_tables(spark, sf), [], secure_views(spark, sf))


@query("v6_unprotected_tables", f"SELECT schema_name, table_name FROM {EXPOSED} WHERE NOT has_secure_view")
def unprotected_tables(spark, sf):
    exposed = policy.exposed_tables(catalog_tables(spark, sf), PATTERNS, secure_views(spark, sf))
    return policy.unprotected_tables(exposed, secure_views(spark, sf))


@query(
    "v7_visible_counts",
    f"""SELECT c.reader_name, count(f.event_id) AS visible_rows FROM (SELECT DISTINCT 'svc_' || user_id AS reader_name FROM events) AS c
    LEFT JOIN {READERS} AS r ON r.reader_name = c.reader_name LEFT JOIN {TENANT_FACTS} AS f ON f.tenant_id = r.tenant_id GROUP BY c.reader_name""",
)
def visible_counts(spark, sf):
    consumers = table(spark, sf, "events").select(F.concat(F.lit("svc_"), text("user_id")).alias("reader_name"))
    return policy.visible_counts(tenant_facts(spark, sf), readers(spark, sf), consumers)


@query(
    "v8_policy_inventory",
    """SELECT lang AS schema_name, source || doc_id AS view_name, 'SELECT ' || n_chars AS sql, doc_id % 3 = 0 AS replaces_table,
    CASE WHEN doc_id % 2 = 0 THEN 'a,b' ELSE '' END AS columns FROM documents""",
)
def policy_inventory(spark, sf):
    rows = table(spark, sf, "documents").select(
        F.col("lang").alias("schema_name"),
        F.concat("source", text("doc_id")).alias("view_name"),
        F.concat(F.lit("SELECT "), text("n_chars")).alias("sql"),
        F.when(F.col("doc_id") % 3 == 0, True).alias("replaces_table"),
        F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("a"), F.lit("b"))).alias("columns"),
    )
    return policy.policy_inventory(rows).withColumn("columns", joined("columns"))


@query(
    "v9_route_by_tenant",
    "SELECT event_type AS tenant_id, count(*) AS row_count, count(DISTINCT event_id) AS events FROM events GROUP BY event_type",
)
def route_by_tenant(spark, sf):
    """Events written to a folder per tenant and read back."""
    path = scratch_path(spark, "tenants")
    rows = table(spark, sf, "events").select(F.col("event_type").alias("tenant_id"), "event_id", "ts")
    policy.route_by_tenant(rows, path, within=["event_id"])
    back = spark.read.parquet(path)
    per_event = back.groupBy("tenant_id", "event_id").agg(F.count("*").alias("n"))
    return per_event.groupBy("tenant_id").agg(F.sum("n").alias("row_count"), F.count("*").alias("events"))


@query(
    "v10_offboard",
    f"""SELECT 'fact' AS kind, tenant_id, count(*) AS row_count FROM {TENANT_FACTS} WHERE tenant_id <> 'click' GROUP BY ALL
    UNION ALL SELECT 'entitlement', tenant_id, count(*) FROM {READERS} WHERE tenant_id <> 'click' GROUP BY ALL""",
)
def offboard(spark, sf):
    facts, entitlements = policy.offboard(tenant_facts(spark, sf), readers(spark, sf), "click")
    kinds = [facts.select(F.lit("fact").alias("kind"), "tenant_id"), entitlements.select(F.lit("entitlement").alias("kind"), "tenant_id")]
    return kinds[0].unionByName(kinds[1]).groupBy("kind", "tenant_id").agg(F.count("*").alias("row_count"))


def teams(spark, sf):
    """A team per ten customers, with members, shares and maybe a platform role."""
    key = F.col("c_custkey")
    number = ((key - key % 10) / 10).cast("bigint")
    grouped = table(spark, sf, "customer").groupBy(F.concat(F.lit("team_"), text(number)).alias("team"), (number % 3).alias("n")).agg(
        F.collect_set("c_name").alias("members"), F.collect_set("c_mktsegment").alias("shares")
    )
    return grouped.select("team", "members", "shares", F.when(F.col("n") == 0, "builder").alias("platform_role"))


TEAM = "'team_' || (c_custkey // 10)"


@query("g1_memberships", f"SELECT {TEAM} || '/' || c_name AS edge, {TEAM} AS team, c_name AS member FROM customer")
def memberships(spark, sf):
    return roles.memberships(teams(spark, sf))


@query("g2_share_reads", f"SELECT DISTINCT {TEAM} || '/' || c_mktsegment AS edge, {TEAM} AS team, c_mktsegment AS share FROM customer")
def share_reads(spark, sf):
    return roles.share_reads(teams(spark, sf))


@query("g2_platform_roles", f"SELECT DISTINCT {TEAM} AS team, 'builder' AS platform_role FROM customer WHERE (c_custkey // 10) % 3 = 0")
def platform_roles(spark, sf):
    return roles.platform_roles(teams(spark, sf))


@query("g3_role_closure", f"{CLOSURE} SELECT * FROM closure")
def role_closure(spark, sf):
    return roles.role_closure(role_edges(spark, sf))


@query("g4_direct_grants", f"SELECT DISTINCT member_type, member_name, role_name FROM {ROLE_EDGES} WHERE lower(role_name) = 'nation_3'")
def direct_grants(spark, sf):
    closure = roles.role_closure(role_edges(spark, sf)).withColumn("is_direct", text("is_direct"))
    return roles.direct_grants(closure, "Nation_3").drop("is_direct")


@query("g5_share_audience", f"SELECT * FROM {AUDIENCES}")
def share_audience(spark, sf):
    return roles.share_audience(shares(spark, sf), grants(spark, sf))


def expected_audiences(spark, sf):
    """Expected audiences per share. Shares that expect nobody keep an empty list."""
    wanted = wanted_grants(spark, sf).select("share_name", roles.audience("grantee_type", "grantee_name").alias("a"))
    lists = wanted.groupBy("share_name").agg(F.collect_set("a").alias("audiences"))
    every = shares(spark, sf).select("share_name")
    return every.join(lists, "share_name", "left").withColumn(
        "audiences", F.coalesce("audiences", F.array().cast("array<string>"))
    )


def actual_audiences(spark, sf):
    rows = roles.share_audience(shares(spark, sf), grants(spark, sf))
    return rows.select("share_name", roles.audience("grantee_type", "grantee_name").alias("audience"))


SHARE_DIFF = f"""(SELECT coalesce(w.share_name, a.share_name) AS share_name, coalesce(w.audience, a.audience) AS audience,
    CASE WHEN a.audience IS NULL THEN 'missing' WHEN w.audience IS NULL THEN 'unexpected' ELSE 'matched' END AS status
    FROM (SELECT DISTINCT share_name, grantee_type || ':' || grantee_name AS audience FROM {WANTED_GRANTS}) AS w
    FULL OUTER JOIN (SELECT DISTINCT share_name, grantee_type || ':' || grantee_name AS audience FROM {AUDIENCES}) AS a
    ON w.share_name = a.share_name AND w.audience = a.audience)"""


@query("g6_share_differences", f"SELECT * FROM {SHARE_DIFF}")
def share_differences(spark, sf):
    return roles.share_differences(expected_audiences(spark, sf), actual_audiences(spark, sf))


@query(
    "g6_audit_shares",
    f"""WITH d AS (SELECT *, (row_number() OVER (PARTITION BY share_name ORDER BY audience) - 1) // 5 AS part FROM {SHARE_DIFF} WHERE status <> 'matched')
    SELECT s.share_name, coalesce(d.part, 0) AS part, coalesce(string_agg(CASE WHEN status = 'missing' THEN audience END, ',' ORDER BY audience), '') AS missing,
    coalesce(string_agg(CASE WHEN status = 'unexpected' THEN audience END, ',' ORDER BY audience), '') AS unexpected,
    count(d.share_name) = 0 AS compliant
    FROM (SELECT DISTINCT share_name FROM {SHARES}) AS s LEFT JOIN d ON d.share_name = s.share_name GROUP BY s.share_name, d.part""",
)
def audit_shares(spark, sf):
    audit = roles.audit_shares(expected_audiences(spark, sf), actual_audiences(spark, sf), part_size=5)
    return audit.withColumns({"missing": joined("missing"), "unexpected": joined("unexpected")})


ROLE_FACTS = f"""e AS (SELECT DISTINCT * FROM {ROLE_EDGES}),
expected(role_name, kind, item) AS (SELECT 'sup_' || s_suppkey, 'member', 'role:sup_' || (s_suppkey * 4 + 1) FROM supplier
    UNION SELECT 'sup_' || s_suppkey, 'role', 'nation_' || (s_nationkey - s_nationkey % 2) FROM supplier),
held(role_name, kind, item) AS (SELECT role_name, 'member', member_type || ':' || member_name FROM e WHERE role_name IN (SELECT role_name FROM expected)
    UNION SELECT member_name, 'role', role_name FROM closure WHERE member_type = 'role' AND is_direct AND member_name IN (SELECT role_name FROM expected)),
diff AS (SELECT coalesce(x.role_name, h.role_name) AS role_name, coalesce(x.kind, h.kind) AS kind, coalesce(x.item, h.item) AS item,
    CASE WHEN h.item IS NULL THEN 'missing' WHEN x.item IS NULL THEN 'unexpected' ELSE 'matched' END AS status
    FROM expected AS x FULL OUTER JOIN held AS h ON x.role_name = h.role_name AND x.kind = h.kind AND x.item = h.item
    UNION ALL SELECT member_name, 'inherited', role_name, 'inherited' FROM closure WHERE member_type = 'role' AND NOT is_direct AND member_name IN (SELECT role_name FROM expected))"""
ROLE_AUDIT = CLOSURE + ", " + ROLE_FACTS.replace("e AS (SELECT DISTINCT * FROM " + ROLE_EDGES + "),\n", "", 1)


def role_audit_inputs(spark, sf):
    """Expected members and roles of every supplier role, and what the graph holds."""
    edges = role_edges(spark, sf)
    key = F.col("s_suppkey")
    parity = F.col("s_nationkey") - F.col("s_nationkey") % 2
    expected = table(spark, sf, "supplier").select(
        F.concat(F.lit("sup_"), text(key)).alias("role_name"),
        F.array(F.concat(F.lit("role:sup_"), text(key * 4 + 1))).alias("members"),
        F.array(F.concat(F.lit("nation_"), text(parity))).alias("inherits"),
    )
    members = edges.select("role_name", roles.audience("member_type", "member_name").alias("member"))
    held = roles.role_closure(edges.filter("member_type = 'role'")).select(
        F.col("member_name").alias("role_name"), F.col("role_name").alias("holds"), text("is_direct").alias("is_direct")
    )
    return expected, members, held


@query("g7_role_differences", f"{ROLE_AUDIT} SELECT * FROM diff")
def role_differences(spark, sf):
    return roles.role_differences(*role_audit_inputs(spark, sf))


def listed(condition: str) -> str:
    return f"coalesce(string_agg(CASE WHEN {condition} THEN item END, ',' ORDER BY item), '')"


@query(
    "g7_audit_roles",
    f"""{ROLE_AUDIT}, v AS (SELECT role_name, bool_and(status IN ('matched', 'inherited')) AS compliant FROM diff GROUP BY role_name),
    n AS (SELECT *, (row_number() OVER (PARTITION BY role_name ORDER BY kind, item) - 1) // 2 AS part FROM diff WHERE status <> 'matched')
    SELECT v.role_name, coalesce(n.part, 0) AS part, {listed("kind = 'member' AND status = 'missing'")} AS missing_members,
    {listed("kind = 'member' AND status = 'unexpected'")} AS unexpected_members, {listed("kind = 'role' AND status = 'missing'")} AS missing_roles,
    {listed("kind = 'role' AND status = 'unexpected'")} AS unexpected_roles, {listed("status = 'inherited'")} AS inherited_roles,
    v.compliant FROM v LEFT JOIN n ON n.role_name = v.role_name GROUP BY v.role_name, n.part, v.compliant""",
)
def audit_roles(spark, sf):
    audit = roles.audit_roles(*role_audit_inputs(spark, sf), part_size=2)
    lists = [c for c in audit.columns if c not in ("role_name", "part", "compliant")]
    return audit.withColumns({c: joined(c) for c in lists})


@query("g7_compliant", f"SELECT coalesce(bool_and(status = 'matched'), true) AS compliant FROM {SHARE_DIFF}")
def compliant(spark, sf):
    rows = roles.share_differences(expected_audiences(spark, sf), actual_audiences(spark, sf))
    return rows.agg(all_true(F.col("status") == "matched").alias("compliant"))


@query(
    "g8_effective_readers",
    f"""{CLOSURE} SELECT DISTINCT a.share_name, c.member_name AS reader FROM {AUDIENCES} AS a JOIN closure AS c
    ON a.grantee_type = 'role' AND c.role_name = a.grantee_name AND c.member_type = 'user'
    UNION SELECT share_name, grantee_name FROM {AUDIENCES} WHERE grantee_type <> 'role'""",
)
def effective_readers(spark, sf):
    audiences = roles.share_audience(shares(spark, sf), grants(spark, sf))
    users = table(spark, sf, "customer").select(F.concat(F.lit("u"), text("c_custkey")).alias("user_name"))
    return roles.effective_readers(audiences, roles.role_closure(role_edges(spark, sf)), users)


@query(
    "g8_reader_counts",
    f"""{CLOSURE}, r AS (SELECT DISTINCT a.share_name, c.member_name AS reader FROM {AUDIENCES} AS a JOIN closure AS c
    ON a.grantee_type = 'role' AND c.role_name = a.grantee_name AND c.member_type = 'user'
    UNION SELECT share_name, grantee_name FROM {AUDIENCES} WHERE grantee_type = 'user')
    SELECT share_name, count(*) AS readers, false AS everybody FROM r GROUP BY share_name
    UNION ALL SELECT share_name, (SELECT count(*) FROM customer), true FROM {AUDIENCES} WHERE grantee_type IN ('organization', 'domain')""",
)
def reader_counts(spark, sf):
    """Readers per share, counted in bitmaps of user numbers."""
    audiences = roles.share_audience(shares(spark, sf), grants(spark, sf))
    users = table(spark, sf, "customer").select(F.concat(F.lit("u"), text("c_custkey")).alias("user_name"))
    return roles.reader_counts(audiences, role_edges(spark, sf), users)


@query(
    "g9_object_grantees",
    f"""SELECT grantee_name, grantee_type, privilege, row_number() OVER (ORDER BY lower(grantee_type), lower(grantee_name), grantee_name, lower(privilege),
    grantee_type, privilege) AS position FROM {GRANTS}""",
)
def object_grantees(spark, sf):
    return positioned(roles.object_grantees(grants(spark, sf)))


@query(
    "g10_list_users",
    """SELECT c_custkey AS id, c_name AS username, c_acctbal < 0 AS is_service_account,
    CASE WHEN c_mktsegment < 'nation_' || c_nationkey THEN c_mktsegment || ',nation_' || c_nationkey ELSE 'nation_' || c_nationkey || ',' || c_mktsegment END AS roles,
    row_number() OVER (ORDER BY c_name, c_custkey) AS position FROM customer WHERE c_acctbal >= 0 AND c_nationkey % 2 = 0""",
)
def list_users(spark, sf):
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("username"),
        (F.col("c_acctbal") < 0).alias("is_service_account"),
        (F.col("c_nationkey") % 2 == 1).alias("is_deprovisioned"),
        F.array(F.concat(F.lit("nation_"), text("c_nationkey")), F.col("c_mktsegment")).alias("roles"),
    )
    users = roles.list_users(rows, is_service_account=False, is_deprovisioned=False)
    return positioned(users.drop("is_deprovisioned")).withColumn("roles", joined("roles"))
