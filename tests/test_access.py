"""Policies, role closure and audits on the stated cases."""

import collections
import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from tallyhouse.operators import joins, policy, roles
from tallyhouse.operators.filters import (
    bridge_finish_time,
    check_reference,
    filter_by_reference,
    filter_optional,
    split_valid,
    typed_rows,
    usage_between,
)
from tallyhouse.operators.joins import entitled_rows

USAGE = [("acme", dt.date(2026, 1, 1), 42, "a@acme"), ("globex", dt.date(2026, 1, 1), 17, "g@globex")]


@pytest.fixture(scope="module")
def usage(spark):
    return spark.createDataFrame(USAGE, "tenant_id string, usage_date date, event_count bigint, contact_email string")


@pytest.fixture(scope="module")
def readers(spark):
    return spark.createDataFrame([("svc_reader_acme", "acme")], "reader_name string, tenant_id string")


def test_reader_sees_own_tenant_and_no_contact(usage, readers):
    session = policy.Session(user="svc_reader_acme")
    assert rows(policy.secure_usage(usage, readers, session, "usage_pii_readers")) == [("acme", dt.date(2026, 1, 1), 42, None)]
    pii = policy.Session(user="svc_reader_acme", roles=frozenset({"usage_pii_readers"}))
    assert rows(policy.secure_usage(usage, readers, pii, "usage_pii_readers"), "contact_email") == [("a@acme",)]


@pytest.mark.parametrize("user", ["svc_reader_globex", None])
def test_no_entitlement_gives_no_rows(usage, readers, user):
    assert policy.row_policy(usage, readers, policy.Session(user=user)).count() == 0


def test_repeated_entitlement(usage, readers):
    twice = readers.unionByName(readers)
    assert entitled_rows(usage, twice, "svc_reader_acme").count() == 2
    assert entitled_rows(usage, twice, "svc_reader_acme", once=True).count() == 1


def test_context_policy_fails_closed(spark, usage):
    with_null = usage.unionByName(spark.createDataFrame([(None, None, 1, None)], usage.schema))
    acme = policy.Session(user="svc_embed", context={"tenant": "acme"})
    assert rows(policy.context_policy(with_null, "tenant", acme, reader="svc_embed"), "tenant_id") == [("acme",)]
    assert policy.context_policy(with_null, "other", acme).count() == 0
    assert policy.context_policy(with_null, "tenant", acme, reader="svc_dashboard").count() == 0


def test_row_predicate(spark):
    data = spark.createDataFrame([("me", 1), ("me", 0), ("you", 5)], "tenant_id string, event_count int")
    assert rows(policy.row_predicate(data, policy.Session(user="me"))) == [("me", 1)]
    assert policy.row_predicate(data, policy.Session()).count() == 0


def test_exposure(spark):
    catalog = spark.createDataFrame([("app", "usage"), ("app", "plain"), ("policy", "readers")], "schema_name string, table_name string")
    views = spark.createDataFrame([("app", "usage")], "schema_name string, view_name string")
    seen = lambda patterns: rows(policy.exposed_tables(catalog, patterns, views))
    assert seen(None) == [("app", "plain", False), ("app", "usage", True), ("policy", "readers", False)]
    assert seen([]) == [("app", "usage", True)]
    assert seen(["app.plain"]) == [("app", "plain", False), ("app", "usage", True)]
    assert rows(policy.unprotected_tables(policy.exposed_tables(catalog, ["app"], views), views)) == [("app", "plain")]


@pytest.mark.parametrize("bad", [[None], [" "], [" a"], ["a,b"]])
def test_bad_patterns(bad):
    with pytest.raises(ValueError):
        policy.check_patterns(bad)


def test_quoted_comma_is_a_good_pattern():
    policy.check_patterns(['"a,b".t', "x" * 50_000])


def test_visible_counts_and_offboarding(usage, readers, spark):
    consumers = spark.createDataFrame([("svc_reader_acme",), ("svc_new",)], "reader_name string")
    assert rows(policy.visible_counts(usage, readers, consumers)) == [("svc_new", 0), ("svc_reader_acme", 1)]
    facts, entitlements = policy.offboard(usage, readers, "acme")
    assert rows(facts, "tenant_id") == [("globex",)] and entitlements.count() == 0


def test_routing(spark, usage, folder):
    policy.route_by_tenant(usage, f"{folder}/r")
    assert rows(spark.read.parquet(f"{folder}/r/tenant_id=acme"), "event_count") == [(42,)]


@pytest.mark.parametrize("start,end", [("2026-01-02", "2026-01-01"), ("2026-1-1", "2026-01-02"), (None, "2026-01-01"), ("2026-02-30", "2026-03-01")])
def test_bad_dates_are_rejected(usage, start, end):
    with pytest.raises(ValueError):
        usage_between(usage, start, end)


def test_usage_between_is_inclusive_text(usage):
    got = usage_between(usage.filter("tenant_id = 'acme'"), "2026-01-01", "2026-01-01").collect()
    assert [tuple(r) for r in got] == [("2026-01-01", "42")]


AUDIENCES = ("role:night shift", "user:night shift", "user:kim", "organization:EVERYONE", "domain:ANYONE")


def subsets(some):
    return [[a for k, a in enumerate(some) if n >> k & 1] for n in range(2 ** len(some))]


#: Every set of actual audiences against every set of expected ones, with what each side lacks.
CASES = {
    f"{i}/{j}": (held, wanted, sorted(set(wanted) - set(held)), sorted(set(held) - set(wanted)))
    for i, held in enumerate(subsets(AUDIENCES[:3])) for j, wanted in enumerate(subsets(AUDIENCES[1:]))
}


def test_share_audit_cases(spark):
    expected = spark.createDataFrame([(n, c[1]) for n, c in CASES.items()], "share_name string, audiences array<string>")
    actual = spark.createDataFrame(
        [(n, a) for n, c in CASES.items() for a in c[0]] + [("not audited", "user:x")], "share_name string, audience string"
    )
    audit = roles.audit_shares(expected, actual, part_size=9)
    want = sorted(((n, c[2], c[3], not c[2] and not c[3]) for n, c in CASES.items()), key=repr)
    assert rows(audit.drop("part")) == want
    assert rows(roles.compliant(audit)) == [(False,)]
    assert rows(roles.compliant(audit.filter("share_name = '0/0'"))) == [(True,)]


def role_case(spark, extra=False, direct="true"):
    expected = spark.createDataFrame([("crew", ["role:deck", "user:kim"], ["sailor"])], "role_name string, members array<string>, inherits array<string>")
    members = [("crew", "user:kim"), ("crew", "role:deck")] + ([("crew", "user:stowaway")] if extra else [])
    held = [("crew", "harbour", "false"), ("crew", "sailor", direct)]
    audit = roles.audit_roles(
        expected,
        spark.createDataFrame(members, "role_name string, member string"),
        spark.createDataFrame(held, "role_name string, holds string, is_direct string"),
        part_size=9,
    )
    return audit.drop("part")


def test_long_audit_lists_go_on_in_parts(spark):
    expected = spark.createDataFrame([("s", [f"user:{i:02d}" for i in range(7)])], "share_name string, audiences array<string>")
    actual = spark.createDataFrame([("s", "user:00"), ("s", "user:99")], "share_name string, audience string")
    audit = roles.audit_shares(expected, actual, part_size=3)
    assert [(r["part"], len(r["missing"]) + len(r["unexpected"]), r["compliant"]) for r in audit.collect()] == [
        (0, 3, False), (1, 3, False), (2, 1, False),
    ]
    assert [a for r in audit.collect() for a in r["missing"]] == [f"user:{i:02d}" for i in range(1, 7)]


def test_every_part_of_a_role_audit_says_whether_the_role_complies(spark):
    expected = spark.createDataFrame([("r", [], [])], "role_name string, members array<string>, inherits array<string>")
    members = spark.createDataFrame([("r", "user:new")], "role_name string, member string")
    held = spark.createDataFrame([("r", f"up{i}", "false") for i in range(3)], "role_name string, holds string, is_direct string")
    audit = roles.audit_roles(expected, members, held, part_size=2)
    assert rows(audit, "part", "inherited_roles", "compliant") == [(0, ["up0", "up1"], False), (1, ["up2"], False)]


def test_role_audit_cases(spark):
    assert rows(role_case(spark)) == [("crew", [], [], [], [], ["harbour"], True)]
    assert rows(role_case(spark, extra=True)) == [("crew", [], ["user:stowaway"], [], [], ["harbour"], False)]
    assert rows(role_case(spark, direct="false")) == [("crew", [], [], ["sailor"], [], ["harbour", "sailor"], False)]
    with pytest.raises(PySparkException, match="directness"):
        role_case(spark, direct=None).collect()


def test_closure_ends_on_cycles_and_keeps_directness(spark):
    edges = spark.createDataFrame(
        [("user", "u", "a"), ("user", "u", "c"), ("role", "a", "b"), ("role", "b", "c"), ("role", "c", "a"), ("role", "c", "c"), ("user", "v", "z")],
        "member_type string, member_name string, role_name string",
    )
    got = rows(roles.role_closure(edges.unionByName(edges)))
    assert got == [
        ("role", "a", "b", True), ("role", "a", "c", False), ("role", "b", "a", False), ("role", "b", "c", True),
        ("role", "c", "a", True), ("role", "c", "b", False),
        ("user", "u", "a", True), ("user", "u", "b", False), ("user", "u", "c", True), ("user", "v", "z", True),
    ]
    assert rows(roles.direct_grants(roles.role_closure(edges), "A"), "member_name") == [("c",), ("u",)]


def test_reader_counts_equal_the_listed_readers(spark):
    users = spark.createDataFrame([(f"u{i}",) for i in range(70_000)], "user_name string")
    edges = users.selectExpr("'user' AS member_type", "user_name AS member_name", "concat('r', crc32(user_name) % 5) AS role_name")
    more = [("role", "r0", "top"), ("role", "r1", "mid"), ("role", "mid", "top"), ("role", "top", "mid"), ("role", "empty", "top"), ("user", "guest", "r3"), ("user", "u5", "mid")]
    edges = edges.unionByName(spark.createDataFrame(more, edges.schema))
    audiences = spark.createDataFrame(
        [("a", "role", "top"), ("a", "user", "u5"), ("a", "user", "nobody"), ("b", "role", "r3"), ("b", "role", "empty"), ("c", "user", "u7"), ("c", "user", "u7"), ("d", "organization", "ENTIRE_ORGANIZATION")],
        "share_name string, grantee_type string, grantee_name string")
    listed = roles.effective_readers(audiences, roles.role_closure(edges), users).filter("share_name <> 'd'")
    want = {r[0]: r[1] for r in listed.groupBy("share_name").count().collect()}
    got = {r.share_name: (r.readers, r.everybody) for r in roles.reader_counts(audiences, edges, users).collect()}
    assert got == {**{k: (n, False) for k, n in want.items()}, "d": (70_000, True)}
    assert roles.reader_bitmaps(audiences, edges, users).count() <= 9


def readers_of(audiences, edges, users):
    """Plain readers: the roles of a user by a walk, then every grant."""
    up, users = {}, set(users)
    for kind, member, role in edges:
        up.setdefault((kind, member), set()).add(role)
    found = set()
    for name in users | {m for k, m, _ in edges if k == "user"}:
        held, todo = set(), list(up.get(("user", name), ()))
        while todo:
            role = todo.pop()
            if role not in held:
                held.add(role)
                todo += up.get(("role", role), ())
        found |= {(s, name) for s, kind, g in audiences if kind == "role" and g in held}
    found |= {(s, g) for s, kind, g in audiences if kind == "user" and g in users}
    return found, {(s, g) for s, kind, g in audiences if kind in ("organization", "domain")}


def graph_of_readers(n):
    draw = random.Random(n)
    users = [f"u{i}" for i in range(300)] + ["ALL_USERS"]
    edges = [("user", u, f"r{draw.randrange(12)}") for u in users for _ in range(draw.choice((0, 1, 1, 3)))]
    edges += [("role", f"r{draw.randrange(16)}", f"r{draw.randrange(16)}") for _ in range(14)] + [("user", "guest", "r1")]
    audiences = [(f"s{draw.randrange(40)}", "role", f"r{draw.randrange(18)}") for _ in range(70)]
    audiences += [(f"s{draw.randrange(45)}", "user", draw.choice([*users, "nobody", "guest"])) for _ in range(150)]
    audiences += [("s1", "domain", "ALL_USERS"), ("s50", "organization", "ENTIRE_ORGANIZATION"), (None, "role", "r1"), (None, "user", "u1"), (None, "user", "u2")]
    return audiences, edges, users


@pytest.mark.parametrize("n, chunk", [(1, 1_000), (2, 3), (3, 1)])
def test_readers_of_any_graph(spark, monkeypatch, n, chunk):
    monkeypatch.setattr(roles, "CHUNK_USERS", chunk)
    monkeypatch.setattr(roles, "TASK_READERS", 500 * chunk)
    audiences, edges, users = graph_of_readers(n)
    tables = (
        spark.createDataFrame(audiences, "share_name string, grantee_type string, grantee_name string"),
        spark.createDataFrame(edges, "member_type string, member_name string, role_name string"),
        spark.createDataFrame([(u,) for u in users], "user_name string"),
    )
    some, whole = readers_of(audiences, edges, users)
    got = [tuple(r) for r in roles.effective_readers(tables[0], roles.role_closure(tables[1]), tables[2]).collect()]
    assert len(got) == len(set(got)) and set(got) == some | whole
    counts = collections.Counter(s for s, _ in some)
    want = [(s, k, False) for s, k in counts.items()] + [(s, len(users), True) for s, _ in whole]
    assert rows(roles.reader_counts(*tables)) == sorted(want, key=repr)


def exchanged_names(df):
    """Exchanges after the names of users were unpacked."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    listed = next(i for i, line in enumerate(plan.splitlines()) if "explode(readers" in line)
    return [line for line in plan.splitlines()[:listed] if "Exchange" in line or "Aggregate" in line]


def test_listed_readers_are_not_shuffled(spark):
    """They were made distinct in a shuffle of a row per share and reader."""
    audiences, edges, users = graph_of_readers(4)
    listed = roles.effective_readers(
        spark.createDataFrame(audiences, "share_name string, grantee_type string, grantee_name string"),
        roles.role_closure(spark.createDataFrame(edges, "member_type string, member_name string, role_name string")),
        spark.createDataFrame([(u,) for u in users], "user_name string"))
    assert exchanged_names(listed) == []


@pytest.mark.parametrize("targets", [1, 12])
def test_chunks_of_shares_are_made_in_many_tasks(spark, monkeypatch, targets):
    """One task made the rows of all shares and chunks, as the tables they come from are small."""
    monkeypatch.setattr(roles, "CHUNK_USERS", 10)
    monkeypatch.setattr(roles, "TASK_CHUNKS", 500, raising=False)
    frame = type(spark.range(0))
    most, plain = [], frame.repartition

    def watched(df, number, *keys):
        if "share_name" in df.columns and "chunk" in keys:
            per_task = df.groupBy(F.spark_partition_id().alias("task")).count()
            most.append(per_task.agg(F.max("count"), F.sum("count")).first())
        return plain(df, number, *keys)

    monkeypatch.setattr(frame, "repartition", watched)
    users = [f"u{i}" for i in range(400)]
    edges = [("user", u, f"r{i % 20}") for i, u in enumerate(users)]
    edges += [("role", f"r{i}", f"t{i % targets}") for i in range(20)]
    audiences = [(f"s{i}", "role", f"t{i % targets}") for i in range(300)]
    listed = roles.effective_readers(
        spark.createDataFrame(audiences, "share_name string, grantee_type string, grantee_name string"),
        roles.role_closure(spark.createDataFrame(edges, "member_type string, member_name string, role_name string")),
        spark.createDataFrame([(u,) for u in users], "user_name string"))
    largest, every = most[0]
    assert every >= 900 and largest <= every * 2 // 3
    got = [tuple(r) for r in listed.collect()]
    assert len(got) == len(set(got)) and set(got) == readers_of(audiences, edges, users)[0]


def test_shares_of_equal_roles_share_their_bitmaps(spark):
    """A share had a row for each of the roles that lead to its own, with members or without."""
    users = spark.range(50).selectExpr("concat('u', id) AS user_name")
    edges = users.selectExpr("'user' AS member_type", "user_name AS member_name", "'r0' AS role_name")
    edges = edges.unionByName(spark.range(1, 200).selectExpr("'role' AS member_type", "concat('r', id) AS member_name", "'top' AS role_name"))
    edges = edges.unionByName(spark.createDataFrame([("role", "r0", "top")], edges.schema))
    audiences = spark.range(300).selectExpr("concat('s', id) AS share_name", "'role' AS grantee_type", "'top' AS grantee_name")
    shares, by_set, named = roles.reader_sets(audiences, edges, users)
    assert (shares.count(), by_set.count(), named.count()) == (300, 1, 0)
    assert rows(roles.reader_counts(audiences, edges, users), "readers", "everybody") == [(50, False)] * 300


def test_closure_of_a_long_chain_takes_few_rounds(spark):
    chain = [("role", f"r{i}", f"r{i + 1}") for i in range(40)]
    edges = spark.createDataFrame(chain, "member_type string, member_name string, role_name string")
    assert roles.role_closure(edges, max_rounds=7).count() == 40 * 41 // 2
    with pytest.raises(RuntimeError):
        roles.role_closure(edges, max_rounds=3)


def reachable(edges):
    onward = {}
    for a, b in edges:
        onward.setdefault(a, set()).add(b)
    out = set()
    for start in onward:
        seen, front = set(), [start]
        while front:
            for b in onward.get(front.pop(), ()):
                if b not in seen:
                    seen.add(b)
                    front.append(b)
        out |= {(start, b) for b in seen if b != start}
    return out


def graphs():
    rng = random.Random(5)
    ring = [(f"a{i}", f"a{(i + 1) % 23}") for i in range(23)]
    other = [(f"b{i}", f"b{(i + 1) % 9}") for i in range(9)]
    both_ways = [e for i in range(30) for e in ((f"c{i:02}", f"c{i + 1:02}"), (f"c{i + 1:02}", f"c{i:02}"))]
    yield ring + other + [("a3", "b2"), ("top", "a0"), ("b5", "leaf"), ("leaf", "end")]
    yield both_ways + [("c10", "x"), ("x", "y"), ("y", "x"), ("z", "c29")]
    yield [("hub", f"h{i}") for i in range(60)] + [(f"h{i}", "hub") for i in range(0, 60, 7)] + [("h1", "h1")]
    for nodes, links in ((12, 20), (25, 30), (40, 60)):
        yield [(f"n{rng.randrange(nodes)}", f"n{rng.randrange(nodes)}") for _ in range(links)]


@pytest.mark.parametrize("heavy", [None, 3])
def test_closure_equals_a_walk_on_graphs_with_cycles(spark, monkeypatch, heavy):
    if heavy:
        monkeypatch.setattr(joins, "BROADCAST_ROWS", heavy)
        monkeypatch.setattr(joins, "HEAVY_ROWS", heavy)
    for edges in list(graphs())[:: 2 if heavy else 1]:
        got = [tuple(r) for r in roles.role_paths(spark.createDataFrame(edges, "role string, holds string")).collect()]
        assert len(got) == len(set(got)) and set(got) == reachable(edges)
    assert roles.role_paths(spark.createDataFrame([], "role string, holds string")).count() == 0


def test_new_pairs_leave_known_pairs_where_they_lie(spark):
    known = spark.range(400).selectExpr("concat('r', id) AS role", "concat('s', id) AS holds").checkpoint()
    found = spark.range(300, 900).selectExpr("concat('r', id) AS role", "concat('s', id) AS holds")
    met = joins.sized_join(known, found, roles.PAIR, "left_semi")
    assert "Exchange hash" not in met._jdf.queryExecution().executedPlan().toString()
    for size in ((400, 4000), (joins.BROADCAST_ROWS + 1, 0)):
        assert roles.unknown_pairs(found.unionByName(found), known, size).count() == 500


def test_audience_and_effective_readers(spark):
    shares = spark.createDataFrame(
        [("s1", "RESTRICTED"), ("s2", "organization"), ("s3", "unrestricted")], "share_name string, access string"
    )
    grants = spark.createDataFrame(
        [("s1", "role", "a"), ("s1", "user", "w"), ("s1", "user", "gone"), ("s2", "user", "w")],
        "share_name string, grantee_type string, grantee_name string",
    )
    audience = roles.share_audience(shares, grants)
    assert rows(audience) == [
        ("s1", "role", "a"), ("s1", "user", "gone"), ("s1", "user", "w"),
        ("s2", "organization", "ENTIRE_ORGANIZATION"), ("s3", "domain", "ALL_USERS"),
    ]
    edges = spark.createDataFrame(
        [("user", "u", "b"), ("role", "b", "a")], "member_type string, member_name string, role_name string"
    )
    users = spark.createDataFrame([("u",), ("w",)], "user_name string")
    assert rows(roles.effective_readers(audience, roles.role_closure(edges), users)) == [
        ("s1", "u"), ("s1", "w"), ("s2", "ENTIRE_ORGANIZATION"), ("s3", "ALL_USERS"),
    ]


def test_teams(spark):
    teams = spark.createDataFrame(
        [("t1", ["m1", "m2"], ["s"], "builder"), ("t2", [], [], None)],
        "team string, members array<string>, shares array<string>, platform_role string",
    )
    assert rows(roles.memberships(teams)) == [("t1/m1", "t1", "m1"), ("t1/m2", "t1", "m2")]
    assert rows(roles.share_reads(teams)) == [("t1/s", "t1", "s")]
    assert rows(roles.platform_roles(teams)) == [("t1", "builder")]


def test_typed_rows_and_bridge(spark):
    data = spark.createDataFrame([(1, "x")], "id bigint, type string")
    assert rows(typed_rows(data, {"id": None, "kind": "type", "gone": None})) == [("1", "x", None)]
    old = spark.createDataFrame([("2026-11-03T10:00:00Z",)], "run_finished_ts string")
    new = spark.createDataFrame([("2026-11-03T09:59:00Z", "2026-11-03T10:05:00Z")], "start_time string, end_time string")
    assert rows(bridge_finish_time(old), "end_time") == [("2026-11-03T10:00:00Z",)]
    assert rows(bridge_finish_time(new), "run_finished_ts", "start_time") == [("2026-11-03T10:05:00Z", "2026-11-03T09:59:00Z")]
    running = spark.createDataFrame([(None, "2026-11-03T10:05:00Z")], "end_time string, run_finished_ts string")
    assert rows(bridge_finish_time(running)) == [(None, "2026-11-03T10:05:00Z")]
    values = spark.sql("SELECT TIMESTAMP_NTZ '2024-05-06 07:08:09.10' AS at, X'0AFF' AS raw, array(1, NULL) AS list, CAST(0.5 AS DECIMAL(9,3)) AS part")
    assert rows(typed_rows(values, dict.fromkeys(["at", "raw", "list", "part"]))) == [("2024-05-06T07:08:09.1Z", "0aff", "[1,null]", "0.5")]


def test_optional_flags_are_three_valued(spark):
    users = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, is_service_account boolean")
    assert filter_optional(users, is_service_account=None).count() == 3
    assert rows(filter_optional(users, is_service_account=False), "id") == [(2,)]


def test_references(spark):
    kind = "array<struct<type string, url string, schema string, table string, uuid string>>"
    data = spark.createDataFrame(
        [(1, [("catalog", "md:a", "s", "t", None)]), (2, [("guide", None, None, None, "u1")]), (3, None)], f"id int, references {kind}"
    )
    assert rows(filter_by_reference(data, {"type": "catalog", "url": "md:a"}), "id") == [(1,)]
    assert rows(filter_by_reference(data, {"type": "guide", "uuid": "u1"}), "id") == [(2,)]
    assert filter_by_reference(data, {}).count() == 3
    at = {"type": "catalog", "url": "md:a"}
    for good in ({"schema": "s"}, {"schema": "s", "table": "t", "column": "c"}, {"schema": "s", "macro": "m", "view": ""}):
        check_reference(at | good)
    wrong = ({"table": "t"}, {"schema": "s", "column": "c"}, {"schema": "s", "table": "t", "view": "v"}, {"url": "a"})
    for bad in ({"url": "md:a"}, {"type": "catalog"}, {"type": "guide"}, {"type": "page", "uuid": "u"}, *[at | w for w in wrong]):
        with pytest.raises(ValueError):
            check_reference(bad)


def test_split_valid(spark):
    data = spark.createDataFrame([(1, 5.0), (2, -1.0), (None, 2.0), (3, None)], "id int, amount double")
    valid, rejected = split_valid(data, {"id": F.col("id").isNotNull(), "amount": F.col("amount") >= 0})
    assert rows(valid) == [(1, 5.0)]
    assert rows(rejected, "reject_reason") == [("amount",), ("amount",), ("id",)]
