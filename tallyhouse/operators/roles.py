"""Role edges, closure, audits and effective readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.parse import text_flag
from tallyhouse.operators.aggregates import all_true
from tallyhouse.operators.filters import filter_optional
from tallyhouse.operators.joins import fits_broadcast, measured, same, sized_join
from tallyhouse.operators.ordering import order_folded
from tallyhouse.operators.ranking import in_parts, numbered_rows
from tallyhouse.operators.sets import differences
from tallyhouse.settings import cut_lineage

# Audiences that stand for everybody.
WHOLE_ORGANIZATION = ("organization", "ENTIRE_ORGANIZATION")
EVERYBODY = ("domain", "ALL_USERS")


def team_edges(teams: DataFrame, column: str, name: str) -> DataFrame:
    return teams.select(
        F.col("team"), F.explode(column).alias(name)
    ).select(F.concat_ws("/", "team", name).alias("edge"), "team", name).distinct()


def memberships(teams: DataFrame) -> DataFrame:
    """One ``team/member`` edge per member."""
    return team_edges(teams, "members", "member")


def share_reads(teams: DataFrame) -> DataFrame:
    """One ``team/share`` edge per share a team reads."""
    return team_edges(teams, "shares", "share")


def platform_roles(teams: DataFrame) -> DataFrame:
    """Teams that inherit a platform role."""
    return teams.filter(F.col("platform_role").isNotNull()).select("team", "platform_role")


PAIR = ["role", "holds"]


def _swapped(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("holds").alias("role"), F.col("role").alias("holds"))


def unknown_pairs(pairs: DataFrame, known: DataFrame, size: tuple[int, int]) -> DataFrame:
    """Distinct ``pairs`` that are not known. The smaller side is sent to the other one if it can be broadcast, so
    many known pairs stay where they lie."""
    pairs = pairs.distinct()
    if fits_broadcast(size):
        return sized_join(pairs, known, PAIR, "left_anti", size)
    pairs = cut_lineage(pairs)
    met = sized_join(known, pairs, PAIR, "left_semi", measured(pairs))
    return pairs.join(met, PAIR, "left_anti")


def mutual_roles(watched: DataFrame, pairs: DataFrame, size: tuple[int, int], turn: int) -> DataFrame:
    """``role, into``: roles that hold and are held by another one, which takes their place.

    Of all partners of a role the one of least hash is taken, with a new hash
    each turn, so that the roles of a long cycle fall together in few turns.
    """
    met = sized_join(pairs, _swapped(watched), PAIR, "left_semi", size)
    both = met.unionByName(_swapped(met))

    def rank(name: str) -> Column:
        return F.struct(F.xxhash64(F.lit(turn), name).alias("h"), F.col(name).alias("name"))

    lower = both.filter(rank("holds") < rank("role"))
    return lower.groupBy("role").agg(F.min(rank("holds")).alias("best")).select("role", F.col("best.name").alias("into"))


def _renamed(pairs: DataFrame, merged: DataFrame, size: tuple[int, int]) -> DataFrame:
    """Pairs under the names that stand for them now, and whether a name has changed."""
    for column in PAIR:
        names = merged.select(F.col("role").alias(column), F.col("into").alias(f"__{column}"))
        pairs = sized_join(pairs, names, [column], "left", size)
    return pairs.select(
        *(F.coalesce(f"__{c}", c).alias(c) for c in PAIR),
        (F.col("__role").isNotNull() | F.col("__holds").isNotNull()).alias("__changed"),
    )


def _followed(stands: DataFrame | None, merged: DataFrame, size: tuple[int, int]) -> DataFrame:
    """``node, top`` for every role whose place was taken, one more turn of ``merged`` applied."""
    new = merged.select(F.col("role").alias("node"), F.col("into").alias("top"))
    if stands is None:
        return new
    moved = sized_join(stands, merged.select(F.col("role").alias("top"), "into"), ["top"], "left", size)
    first = new.join(stands, "node", "left_anti")
    return moved.select("node", F.coalesce("into", "top").alias("top")).unionByName(first)


def _spread(paths: DataFrame, stands: DataFrame) -> DataFrame:
    """Pairs of the roles themselves from pairs of the names that stand for them."""
    tops = stands.select(F.col("top").alias("node")).distinct()
    own = tops.join(stands, "node", "left_anti").select("node", F.col("node").alias("top"))
    groups = cut_lineage(stands.unionByName(own))
    size = measured(groups)
    within = tops.select(F.col("node").alias("role"), F.col("node").alias("holds"))
    pairs = paths.unionByName(within)
    for column in PAIR:
        names = groups.select(F.col("top").alias(column), F.col("node").alias(f"__{column}"))
        pairs = sized_join(pairs, names, [column], "left", size)
    pairs = pairs.select(*(F.coalesce(f"__{c}", c).alias(c) for c in PAIR))
    return pairs.filter("role <> holds")


def role_paths(edges: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """All (role, holds) pairs of a role-to-role graph, cycles included.

    Each round joins the pairs found in the round before with all pairs known,
    so paths double in length and a deep graph takes few rounds. Roles that
    hold each other reach the same roles: as soon as two pairs show it, one
    takes the place of the other, and the rounds go on over the smaller graph;
    at the end every name is replaced by the roles it stands for. A round
    sends what it has found to the known pairs, which are not regrouped.
    Rounds are cut with a reliable checkpoint.
    """
    # All steps over two pairs of `known` are taken; a round takes those with one pair of `fresh`, or with two.
    fresh = cut_lineage(edges.select(*PAIR).filter("role <> holds").distinct())
    known, stands = fresh.limit(0), None
    found, rounds = measured(fresh), 0
    known_size, watched, watched_size = (0, 0), fresh, found
    while found[0]:
        rounds += 1
        if max_rounds is not None and rounds > max_rounds:
            raise RuntimeError(f"role graph is not complete after {max_rounds} rounds")
        merged = mutual_roles(watched, known.unionByName(fresh), watched_size, rounds)
        size = measured(merged)
        if size[0]:
            merged = cut_lineage(merged)
            stands = cut_lineage(_followed(stands, merged, size))
            before = cut_lineage(_renamed(known, merged, size))
            known = before.filter("NOT __changed").drop("__changed")
            moved = before.filter("__changed").unionByName(_renamed(fresh, merged, size)).drop("__changed")
            known_size = measured(known)
            fresh = cut_lineage(unknown_pairs(moved.filter("role <> holds"), known, known_size))
            found = measured(fresh)
        every = known.unionByName(fresh)
        after = fresh.select(F.col("role").alias("holds"), F.col("holds").alias("__end"))
        reached = sized_join(every, after, ["holds"], size=found).select("role", F.col("__end").alias("holds"))
        if stands is not None:  # where names fell together, steps from new pairs to known ones were not taken either
            ahead = fresh.select(F.col("role").alias("__start"), F.col("holds").alias("role"))
            more = sized_join(known, ahead, ["role"], size=found)
            reached = reached.unionByName(more.select(F.col("__start").alias("role"), "holds"))
        known_size = (known_size[0] + found[0], known_size[1] + found[1])
        onward = cut_lineage(unknown_pairs(reached.filter("role <> holds"), every, known_size))
        onward_size = measured(onward)
        watched, watched_size = onward, onward_size
        if size[0]:  # names may still be partners of each other
            watched, watched_size = onward.unionByName(fresh), (onward_size[0] + found[0], onward_size[1] + found[1])
        known, fresh, found = every, onward, onward_size
    return known if stands is None else _spread(known, stands)


def role_closure(edges: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """Every role each user or role holds, and whether directly.

    ``edges`` has ``member_type`` (user or role), ``member_name`` and
    ``role_name``. The graph of roles is expanded alone; members then join it
    once, so the many user edges take no part in the rounds.
    """
    named = edges.filter(F.col("member_name").isNotNull() & F.col("role_name").isNotNull())
    direct = named.select("member_type", "member_name", "role_name")
    graph = direct.filter("member_type = 'role'").select(
        F.col("member_name").alias("role"), F.col("role_name").alias("holds")
    )
    paths = role_paths(graph, max_rounds).select(F.col("role").alias("role_name"), F.col("holds").alias("__up"))
    inherited = sized_join(direct, paths, ["role_name"]).select(
        "member_type", "member_name", F.col("__up").alias("role_name"), F.lit(False).alias("is_direct")
    )
    itself = (F.col("member_type") == "role") & (F.col("member_name") == F.col("role_name"))
    return (
        direct.withColumn("is_direct", F.lit(True))
        .unionByName(inherited)
        .filter(~itself)
        .groupBy("member_type", "member_name", "role_name")
        .agg(F.max("is_direct").alias("is_direct"))
    )


def direct_grants(rows: DataFrame, role: str) -> DataFrame:
    """Direct rows of the named role, in any letter case."""
    return rows.filter(F.lower("role_name") == F.lower(F.lit(role))).filter(text_flag("is_direct"))


def share_audience(shares: DataFrame, grants: DataFrame) -> DataFrame:
    """Who can read each share: its grants, or one whole-audience row."""
    def everyone(mode: str, audience: tuple[str, str]) -> DataFrame:
        kind, name = audience
        return shares.filter(F.lower("access") == mode).select(
            "share_name", F.lit(kind).alias("grantee_type"), F.lit(name).alias("grantee_name")
        )

    restricted = shares.filter(F.lower("access") == "restricted").select("share_name").distinct()
    listed = grants.select("share_name", "grantee_type", "grantee_name")
    individual = sized_join(listed, restricted, ["share_name"], "left_semi")
    return (
        individual.unionByName(everyone("organization", WHOLE_ORGANIZATION))
        .unionByName(everyone("unrestricted", EVERYBODY))
        .select("share_name", "grantee_type", "grantee_name")
    )


def audience(kind: str | Column, name: str | Column) -> Column:
    return F.concat_ws(":", kind, name)


def share_differences(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """One row per audience of every audited share: matched, missing or unexpected.

    ``expected`` has ``share_name`` and ``audiences`` (an array, maybe empty);
    ``actual`` has ``share_name`` and ``audience``. Shares that nobody audits
    are left out.
    """
    wanted = expected.select("share_name", F.explode("audiences").alias("audience"))
    audited = expected.select("share_name").distinct()
    held = sized_join(actual.select("share_name", "audience"), audited, ["share_name"], "left_semi")
    return differences(wanted, held, ["share_name", "audience"])


def listed_when(condition: Column, value: str) -> Column:
    return F.sort_array(F.collect_list(F.when(condition, F.col(value))))


def audit_shares(expected: DataFrame, actual: DataFrame, *, part_size: int) -> DataFrame:
    """Missing and unexpected audiences per share, and whether it complies.

    Only differences enter the lists, ``part_size`` of them to a ``part``. Every
    part says whether the whole share complies. :func:`share_differences` is
    the same audit as one row per audience.
    """
    differing = cut_lineage(share_differences(expected, actual).filter("status <> 'matched'"))
    found = (
        in_parts(differing, ["share_name"], ["audience"], part_size)
        .groupBy("share_name", "part")
        .agg(
            listed_when(F.col("status") == "missing", "audience").alias("missing"),
            listed_when(F.col("status") == "unexpected", "audience").alias("unexpected"),
        )
    )
    none = F.array().cast("array<string>")
    return (
        expected.select("share_name")
        .distinct()
        .join(found, "share_name", "left")
        .select(
            "share_name",
            F.coalesce("part", F.lit(0)).cast("bigint").alias("part"),
            F.coalesce("missing", none).alias("missing"),
            F.coalesce("unexpected", none).alias("unexpected"),
            F.col("missing").isNull().alias("compliant"),
        )
        .orderBy("share_name", "part")
    )


def role_differences(expected: DataFrame, members: DataFrame, roles: DataFrame) -> DataFrame:
    """One row per audited fact of a role: its members, direct and inherited roles.

    A role row whose directness is unknown makes the query fail.
    """
    audited = expected.select("role_name").distinct()
    wanted = (
        expected.select("role_name", F.lit("member").alias("kind"), F.explode("members").alias("item"))
        .unionByName(expected.select("role_name", F.lit("role").alias("kind"), F.explode("inherits").alias("item")))
    )
    known = F.when(
        F.lower(F.col("is_direct").cast("string")).isin("true", "false"), F.lower(F.col("is_direct").cast("string"))
    ).otherwise(F.raise_error(F.lit("Cannot audit role inheritance: directness is not known")))
    holdings = roles.select("role_name", F.col("holds").alias("item"), known.alias("__direct"))
    held = members.select("role_name", F.lit("member").alias("kind"), F.col("member").alias("item")).unionByName(
        holdings.select(
            "role_name", F.when(F.col("__direct") == "true", "role").otherwise("inherited").alias("kind"), "item"
        )
    )
    held = sized_join(held, audited, ["role_name"], "left_semi")
    rows = differences(wanted, held, ["role_name", "kind", "item"])
    return rows.withColumn("status", F.when(F.col("kind") == "inherited", "inherited").otherwise(F.col("status")))


def audit_roles(
    expected: DataFrame, members: DataFrame, roles: DataFrame, *, part_size: int
) -> DataFrame:
    """Missing and unexpected members and direct roles per role, and its inherited roles.

    Lists are cut into parts as in :func:`audit_shares`, and every part says
    whether the whole role complies.
    """
    is_member, is_role = F.col("kind") == "member", F.col("kind") == "role"
    missing, extra = F.col("status") == "missing", F.col("status") == "unexpected"
    lists = {
        "missing_members": is_member & missing,
        "unexpected_members": is_member & extra,
        "missing_roles": is_role & missing,
        "unexpected_roles": is_role & extra,
        "inherited_roles": F.col("status") == "inherited",
    }
    differing = cut_lineage(role_differences(expected, members, roles).filter("status <> 'matched'"))
    found = (
        in_parts(differing, ["role_name"], ["kind", "item"], part_size)
        .groupBy("role_name", "part")
        .agg(*[listed_when(c, "item").alias(n) for n, c in lists.items()])
    )
    verdicts = differing.groupBy("role_name").agg(all_true(F.col("status") == "inherited").alias("compliant"))
    none = F.array().cast("array<string>")
    return (
        expected.select("role_name")
        .distinct()
        .join(found, "role_name", "left")
        .join(verdicts, "role_name", "left")
        .select(
            "role_name",
            F.coalesce("part", F.lit(0)).cast("bigint").alias("part"),
            *[F.coalesce(n, none).alias(n) for n in lists],
            F.coalesce("compliant", F.lit(True)).alias("compliant"),
        )
        .orderBy("role_name", "part")
    )


#: Users whose names travel in one row, the parts that the shares of such a row are dealt to, and readers per task.
CHUNK_USERS, SHARE_PARTS, TASK_READERS = 1_000, 16, 4_000_000

#: Rows of a share and a chunk of users that one task makes.
TASK_CHUNKS = 1_000_000


def with_set(rows: DataFrame, owner: str, item: str, name: str) -> DataFrame:
    """Distinct ``owner, item`` rows beside the ``name_a, name_b`` of the owner's set of items.

    Owners of equal sets have equal names: 128 bits, each the XOR of a hash of every item.
    """
    every = Window.partitionBy(owner)
    names = {f"{name}_a": F.xxhash64(item), f"{name}_b": F.xxhash64(F.lit(name), item)}
    return rows.select(owner, item).distinct().withColumns({n: F.bit_xor(h).over(every) for n, h in names.items()})


def in_tasks(rows: DataFrame, *keys: str) -> DataFrame:
    """Few rows that a join makes many of, in as many tasks as a shuffle has: adaptive execution would put them into one."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def effective_readers(audiences: DataFrame, closure: DataFrame, users: DataFrame) -> DataFrame:
    """Users who can read each share, through any chain of roles.

    A whole-audience share is readable by every user. That set is returned as
    one row with the audience name instead of one row per user.

    Users who hold the same granted roles are one class, and shares granted to
    the same roles one set. What a set reaches is found over classes; as each
    user has one class, its readers are listed by whole classes, each once, and
    the list is neither shuffled nor made distinct.
    """
    granted = audiences.filter("grantee_type = 'role'").select("share_name", F.col("grantee_name").alias("role"))
    granted = cut_lineage(with_set(granted, "share_name", "role", "set"))
    held = closure.filter("member_type = 'user'").select("role_name", "member_name").toDF("role", "reader")
    held = sized_join(held, granted.select("role").distinct(), ["role"], "left_semi")
    held = cut_lineage(with_set(held, "reader", "role", "class"))
    sets, classes = ["set_a", "set_b"], ["class_a", "class_b"]
    of_sets, of_classes = granted.select(*sets, "role").distinct(), held.select(*classes, "role").distinct()
    reached = cut_lineage(sized_join(in_tasks(of_sets, *sets), of_classes, ["role"]).select(*sets, *classes).distinct())
    shares, members = granted.select("share_name", *sets).distinct(), held.select("reader", *classes).distinct()

    named = audiences.filter("grantee_type = 'user'").select("share_name", F.col("grantee_name").alias("reader"))
    known = sized_join(named, users.select(F.col("user_name").alias("reader")).distinct(), ["reader"], "left_semi")
    whole = audiences.filter("grantee_type IN ('organization', 'domain')").select(
        "share_name", F.col("grantee_name").alias("reader")
    )
    listed = known.select("share_name", "reader").unionByName(whole).distinct()
    shared = shares.withColumnRenamed("share_name", "share")  # null is a name like any other
    listed = listed.join(shared, same(F.col("share_name"), F.col("share")), "left").join(members, "reader", "left")
    listed = listed.join(reached, [*sets, *classes], "left_anti")
    return class_readers(shares, reached, members).unionByName(listed.select("share_name", "reader"))


def class_readers(shares: DataFrame, reached: DataFrame, members: DataFrame) -> DataFrame:
    """``share_name, reader`` for all members of the classes that the set of a share reaches.

    Shares meet rows of many users, and are dealt by the number of readers they make.
    """
    classes = ["class_a", "class_b"]
    sizes = members.groupBy(*classes).agg(F.count("*").alias("users"), (F.count("*") / CHUNK_USERS).cast("int").alias("last"))
    sizes = cut_lineage(sizes)
    wanted, total = wanted_chunks(shares, sized_join(reached, sizes, classes))
    met = [*classes, "chunk", "part"]
    every_part = F.explode(F.sequence(F.lit(0), F.lit(SHARE_PARTS - 1))).alias("part")
    chunks = sized_join(members, sizes, classes).withColumn("chunk", F.pmod(F.xxhash64("reader"), F.col("last") + 1).cast("int"))
    chunks = chunks.groupBy(*classes, "chunk").agg(F.sort_array(F.collect_list("reader")).alias("readers")).select("*", every_part)
    wanted = wanted.withColumn("part", F.pmod(F.xxhash64("share_name"), F.lit(SHARE_PARTS)).cast("int"))
    tasks = 1 + total // TASK_READERS
    lists = wanted.select("share_name", *met).repartition(tasks, *met).join(chunks.repartition(tasks, *met), met)
    return lists.select("share_name", F.explode("readers").alias("reader"))


def wanted_chunks(shares: DataFrame, reached: DataFrame) -> tuple[DataFrame, int]:
    """``share_name, class_a, class_b, chunk`` for every chunk of users that a share lists, and how many readers they make.

    A few sets and classes make many rows, so tasks are dealt by the rows they
    make: the shares of a set go to as many deals as its rows fill tasks.
    """
    sets = ["set_a", "set_b"]
    chunks = F.col("last").cast("bigint") + 1
    per_set = reached.groupBy(*sets).agg(F.sum("users").alias("readers"), F.sum(chunks).alias("chunks"))
    per_set = per_set.join(shares.groupBy(*sets).agg(F.count("*").alias("shares")), sets)
    deals = (1 + F.col("shares") * F.col("chunks") / TASK_CHUNKS).cast("int").alias("deals")
    per_set = cut_lineage(per_set.select(*sets, deals, *((F.col("shares") * F.col(c)).alias(c) for c in ("readers", "chunks"))))
    total, rows = per_set.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("readers", "chunks"))).first()
    per_set, tasks, met = per_set.select(*sets, "deals"), 1 + rows // TASK_CHUNKS, [*sets, "deal"]
    dealt = sized_join(shares, per_set, sets).withColumn("deal", F.pmod(F.xxhash64("share_name"), "deals").cast("int"))
    copies = sized_join(reached, per_set, sets).withColumn("deal", F.explode(F.sequence(F.lit(0), F.col("deals") - 1)))
    wanted = dealt.drop("deals").repartition(tasks, *met).join(copies.drop("deals").repartition(tasks, *met), met)
    wanted = wanted.coalesce(tasks)  # joins take as many tasks as a shuffle has, each of which has a block for every task that lists
    every_chunk = F.explode(F.sequence(F.lit(0), "last")).alias("chunk")
    return wanted.select("share_name", "class_a", "class_b", every_chunk), total


def reader_sets(audiences: DataFrame, edges: DataFrame, users: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What reads a share, as bitmaps of user numbers: ``share_name, set`` of shares granted to roles, the bitmaps
    ``set, block, bits`` of the sets of roles, and ``share_name, block, bits`` of users granted by name.

    Users are numbered once. A role's own members are one bitmap per block;
    only roles that have members are followed to the granted ones, whose
    bitmaps are made once. Shares granted to the same roles share theirs.
    """
    members = edges.filter("member_type = 'user'").select(F.col("role_name").alias("role"), F.col("member_name").alias("reader"))
    members = members.filter("role IS NOT NULL AND reader IS NOT NULL").distinct()
    known = users.select(F.col("user_name").alias("reader")).filter("reader IS NOT NULL")
    numbers = numbered_rows(known.unionByName(members.select("reader")).distinct(), [], [F.col("reader").asc()], "number")

    def bits(rows: DataFrame, name: str) -> DataFrame:
        placed = sized_join(rows, numbers, ["reader"])
        block = F.bitmap_bucket_number("number").alias("block")
        return placed.groupBy(name, block).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))

    granted = audiences.filter("grantee_type = 'role'").select("share_name", F.col("grantee_name").alias("holds"))
    granted = cut_lineage(with_set(granted, "share_name", "holds", "set"))
    wanted = cut_lineage(granted.select("holds").distinct())
    own = cut_lineage(bits(members, "role"))
    graph = edges.filter("member_type = 'role' AND member_name IS NOT NULL AND role_name IS NOT NULL")
    paths = role_paths(graph.select(F.col("member_name").alias("role"), F.col("role_name").alias("holds")))
    paths = sized_join(paths, wanted, ["holds"], "left_semi").select("holds", "role")
    paths = paths.unionByName(wanted.select("holds", F.col("holds").alias("role"))).distinct()
    by_role = merged_bits(sized_join(paths, own, ["role"]), "holds")
    key = F.struct("set_a", "set_b").alias("set")
    of_sets = in_tasks(granted.select(key, "holds").distinct(), "set")
    by_set = merged_bits(sized_join(of_sets, cut_lineage(by_role), ["holds"]), "set")
    named = audiences.filter("grantee_type = 'user'").select("share_name", F.col("grantee_name").alias("reader"))
    named = sized_join(named, known.distinct(), ["reader"], "left_semi").distinct()
    return granted.select("share_name", key).distinct(), cut_lineage(by_set), cut_lineage(bits(named, "share_name"))


def merged_bits(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy(name, "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def reader_bitmaps(audiences: DataFrame, edges: DataFrame, users: DataFrame) -> DataFrame:
    """The readers of shares granted to roles and users: per share and block of user numbers one bitmap.

    A share costs rows for blocks, never one per reader; the closure of users is not made.
    """
    shares, by_set, named = reader_sets(audiences, edges, users)
    through = shares.join(by_set, "set").select("share_name", "block", "bits")
    return merged_bits(through.unionByName(named), "share_name")


def reader_counts(audiences: DataFrame, edges: DataFrame, users: DataFrame) -> DataFrame:
    """How many users can read each share: exactly as many as ``effective_readers`` lists, without listing them.

    The bitmaps of a set of roles are counted once for all its shares. Only
    in blocks where a share has users by name are the two put together.
    A share for everybody counts every user once and says so.
    """
    shares, by_set, named = reader_sets(audiences, edges, users)
    per_set = by_set.groupBy("set").agg(F.sum(F.bitmap_count("bits")).alias("n"))
    through = shares.join(per_set, "set").select("share_name", "n")
    shared = shares.withColumnRenamed("share_name", "share")  # null is a name like any other
    here = named.select("share_name", "block").join(shared, same(F.col("share_name"), F.col("share")))
    here = here.join(by_set, ["set", "block"]).select("share_name", "block", "bits")
    less = here.select("share_name", (-F.bitmap_count("bits")).alias("n"))
    more = merged_bits(named.unionByName(here), "share_name").select("share_name", F.bitmap_count("bits").alias("n"))
    some = through.unionByName(less).unionByName(more).groupBy("share_name").agg(F.sum("n").alias("readers")).filter("readers > 0")
    total = users.select(F.count_distinct("user_name")).first()[0]
    whole = audiences.filter("grantee_type IN ('organization', 'domain')").select("share_name").distinct()
    everybody = whole.select("share_name", F.lit(total).cast("bigint").alias("readers"), F.lit(True).alias("everybody"))
    return some.withColumn("everybody", F.lit(False)).unionByName(everybody)


def object_grantees(df: DataFrame) -> DataFrame:
    """Grants on an object by folded type, folded name, name and folded privilege; what is left ties by its own text."""
    rows = df.select("grantee_name", "grantee_type", "privilege")
    keys = [F.lower("grantee_type"), F.lower("grantee_name"), "grantee_name", F.lower("privilege"), "grantee_type", "privilege"]
    return rows.orderBy(*keys)


def list_users(
    df: DataFrame, is_service_account: bool | None = None, is_deprovisioned: bool | None = None
) -> DataFrame:
    """Users by name and id with sorted roles; an unset flag filters nothing."""
    rows = filter_optional(df, is_service_account=is_service_account, is_deprovisioned=is_deprovisioned)
    return rows.withColumn("roles", F.sort_array("roles")).orderBy("username", "id")


def compliant(audit: DataFrame, condition: str = "compliant") -> DataFrame:
    """Whether every audited row complies."""
    return audit.agg(all_true(F.col(condition)).alias("compliant"))
