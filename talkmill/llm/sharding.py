"""Balanced label propagation: linked documents gather in shards of equal row counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .common import col, running_sum, unused

#: Buckets in which rows are numbered apart from each other: 4096 and 16 shards give 65,536 totals at most.
BUCKETS = 4096
#: Strengths of pull, and hash buckets of each, in which moves between two shards are numbered: 65,536 totals for 16 shards.
PULLS, HASHES = 32, 8


def text_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) and 1."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def _bucket(*by: Column) -> Column:
    return F.pmod(F.xxhash64(*by, F.lit("bucket")), F.lit(BUCKETS)).cast("int")


def granted(asks: DataFrame, load: DataFrame, quota: list[int]) -> DataFrame | None:
    """asks (g, shard, to, n, pull) with m, how many of the n may move; null if none may.

    Between two shards as many may cross one way as the other, which leaves sizes as they are; beside that a shard takes in what its quota leaves room for. Requests are granted in the order of their pull, the last one in part. So no shard goes over its quota by a move. load: shard, load.
    """
    quotas = F.array(*map(F.lit, quota))
    load = load.select(F.col("shard").alias("to"), "load")
    want = common.written(asks.groupBy("shard", "to").agg(F.sum("n").alias("want")), "want")  # n_shards squared rows at most, as are the tables made of it
    back = want.select(F.col("shard").alias("to"), F.col("to").alias("shard"), F.col("want").alias("back"))
    allow = want.join(back, ["shard", "to"], "left").join(load, "to", "left").withColumn("even", F.least("want", F.coalesce("back", F.lit(0))))
    earlier = F.sum(F.col("want") - F.col("even")).over(Window.partitionBy("to").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    room = F.greatest(F.get(quotas, F.col("to")) - F.coalesce("load", F.lit(0)) - F.coalesce(earlier, F.lit(0)), F.lit(0))
    allow = common.written(allow.select("shard", "to", (F.col("even") + F.least(F.col("want") - F.col("even"), room)).alias("allow")), "allow")
    common.drop_written(want)
    if not allow.agg(F.sum("allow")).first()[0]:
        return None
    # strongest pull first, by powers of two; then by hash of the group
    rank = (F.lit(PULLS - 1) - F.least(F.greatest(F.floor(F.log2("pull")), F.lit(0)), F.lit(PULLS - 1))).cast("int") * HASHES + F.pmod(F.xxhash64("g"), F.lit(HASHES)).cast("int")
    asks = running_sum(asks.withColumn("bucket", rank), ["shard", "to"], "bucket", [F.col("g")], F.col("n"), "before").join(F.broadcast(allow), ["shard", "to"])
    return asks.withColumn("m", F.least(F.col("n"), F.greatest(F.col("allow") - F.col("before"), F.lit(0)))).where("m > 0")


def place_groups(held: DataFrame, quota: list[int], rounds: int) -> DataFrame:
    """held: (g, shard, n), how many members of group g lie in a shard. Returns the like after label propagation.

    A round: each group's members outside the shard that holds most of the group ask to move there (of equal shards, one that a hash of group and round picks, so that what could not move one way may move the other); in every second round, the shard that holds most of those with room, and only members of shards that hold less. granted() says how many may, those first whose group has most there already.
    """
    quotas = F.array(*map(F.lit, quota))
    idle = 0
    for i in range(rounds):
        if idle == 2:  # neither kind of round moves anything any more
            break
        load = held.groupBy("shard").agg(F.sum("n").alias("load"))
        rank = F.struct("n", F.xxhash64("g", "shard", F.lit(i)).alias("h"))
        seen = held
        if i % 2:  # for groups that are larger than a shard: next to those that are full
            seen = held.join(F.broadcast(load.where(F.col("load") < F.get(quotas, F.col("shard"))).select("shard")), "shard", "left_semi")
        best = seen.groupBy("g").agg(F.max(F.struct(rank.alias("r"), "shard")).alias("b")).select("g", F.col("b.shard").alias("to"), F.col("b.r").alias("r"), F.col("b.r.n").alias("pull"))
        asks = held.join(best, "g").where((F.col("shard") != F.col("to")) & (rank < F.col("r"))).drop("r")
        moved = granted(asks, load, quota)
        idle = 0 if moved is not None else idle + 1
        if moved is None:
            continue
        change = moved.select("g", F.col("to").alias("shard"), F.col("m").alias("n")).union(moved.select("g", "shard", -F.col("m")))
        following = common.written(held.union(change).groupBy("g", "shard").agg(F.sum("n").alias("n")).where("n > 0"), "held")
        common.drop_written(held)
        held = following
    return held


def place_links(held: DataFrame, links: DataFrame, quota: list[int], rounds: int) -> DataFrame:
    """held: (g, shard, n), where node g lies, with how many rows; links: (a, b, weight) between nodes, each once. Returns the like of held after label propagation.

    A round: each node sums the weights of its links by its neighbours' shards, and asks to move to the shard with most, if that is more than it has in its own. Only one half of the nodes, by a hash of node and round, may ask in a round, for two that are linked would else change places for ever. granted() says how many may, those first that gain most. A node with several rows moves with all of them or stays.
    Links meet the nodes' shards in joins by node; weights are summed where links are read, so that a node with very many links is no task of its own.
    """
    both = common.written(links.union(links.select("b", "a", "weight")).toDF("g", "other", "weight"), "both")
    idle = 0
    for i in range(rounds):
        if idle == 4:
            break
        at = held.select(F.col("g").alias("other"), "shard")
        votes = both.join(at, "other").groupBy("g", "shard").agg(F.sum("weight").alias("votes"))
        best = votes.groupBy("g").agg(F.max(F.struct("votes", F.xxhash64("g", "shard").alias("h"), "shard")).alias("b")).select("g", F.col("b.shard").alias("to"), F.col("b.votes").alias("most"))
        own = held.join(votes, ["g", "shard"], "left").select("g", "shard", "n", F.coalesce("votes", F.lit(0)).alias("own"))
        turn = F.pmod(F.xxhash64("g", F.lit(i // 2)), F.lit(2)) == i % 2
        asks = own.where(turn).join(best, "g").where((F.col("shard") != F.col("to")) & (F.col("most") > F.col("own"))).select("g", "shard", "to", "n", (1 + F.col("most") - F.col("own")).alias("pull"))
        moved = granted(asks, held.groupBy("shard").agg(F.sum("n").alias("load")), quota)
        idle = 0 if moved is not None else idle + 1
        if moved is None:
            continue
        moved = moved.where("m = n").select("g", F.col("to").alias("goes"))
        following = common.written(held.join(moved, "g", "left").select("g", F.coalesce("goes", "shard").alias("shard"), "n"), "held")
        common.drop_written(held)
        held = following
    common.drop_written(both)
    return held


def _key(*group: Column) -> Column:
    """One hash of all columns; each is written with its length, so that no two lists of values run together to the same text."""
    texts = [c.cast("string") for c in group]
    return F.xxhash64(F.concat(*(F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("null")) for c in texts)))


def shard_rows(docs: DataFrame, group: list[Column], *, links: DataFrame | None = None, n_shards: int = 16, rounds: int = 8, id_col: str = "doc_id") -> DataFrame:
    """docs with shard (int) and slot (long, from 0 in each shard without gaps). Row counts of shards are one apart at most; the first ones hold the extra rows.

    Rows with equal group columns are linked with each other. With links (a, b, weight), group is one column that a and b are values of, and documents are linked as these say: near duplicates, pages that cite each other. Links of a value with itself, to values that no row has and with a weight that isn't positive don't count; those that repeat add up.
    Rows start in a shard by hash of their group and, without links, their id; rounds of balanced label propagation (place_groups, place_links) move them where most of what they are linked with lies. Unlinked rows then fill each shard up to its quota.

    The rounds work on counts by (group, shard); members of one group and shard are alike. Which member goes where is settled by running numbers within the group. These, like slots, are found by sums within 4096 hash buckets and over buckets, so that no task gets a group or a shard whole: of a group, one gets its 4096 sums at most.
    A null id or group is a value like any other. Repeated rows are linked and each gets a slot. With fewer rows than shards some stay empty. An empty table gives no rows. Columns of docs named shard or slot give way.
    """
    own = [c for c in docs.columns if c.lower() not in {"shard", "slot"}]
    key, g, home, bucket, no, at = unused(docs, "s_key", "s_group", "s_home", "s_bucket", "s_no", "s_at")
    df = docs.select(*map(col, own), _key(*group).alias(g), col(id_col).alias(key))
    df = df.withColumn(home, F.pmod(F.xxhash64(g) if links is not None else F.xxhash64(key, g), F.lit(n_shards)).cast("int"))
    held = common.written(df.groupBy(F.col(g).alias("g"), F.col(home).alias("shard")).agg(F.count("*").alias("n")), "held")
    total = held.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    quota = [total // n_shards + (i < total % n_shards) for i in range(n_shards)]
    if links is None:
        sizes = held.groupBy("g").agg(F.sum("n").alias("size"))
        placed = place_groups(common.written(held.join(sizes.where("size > 1"), "g").select("g", "shard", "n"), "linked"), quota, rounds)
    else:
        kind = docs.select(group[0]).schema[0].dataType
        of = lambda c: F.when(F.col(c).isNotNull(), _key(F.col(c).cast(kind)))
        pairs = links.where("weight > 0").select(of("a").alias("a"), of("b").alias("b"), F.col("weight").cast("double").alias("weight")).where("a != b")
        pairs = pairs.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("weight").alias("weight"))
        for end in ("a", "b"):
            pairs = pairs.join(held.select(F.col("g").alias(end)), end, "left_semi")
        pairs = common.written(pairs.select("a", "b", "weight"), "links")
        nodes = pairs.select("a").union(pairs.select("b")).distinct().toDF("g")
        placed = place_links(common.written(held.join(nodes, "g", "left_semi"), "linked"), pairs, quota, rounds)

    # rows over a quota, which a shard can have by the hash alone, are let go and count as unlinked
    placed = running_sum(placed.withColumn("bucket", F.pmod(F.xxhash64("g", F.lit(1)), F.lit(BUCKETS)).cast("int")), ["shard"], "bucket", [F.col("g")], F.col("n"), "before")
    stays = F.least(F.col("n"), F.greatest(F.get(F.array(*map(F.lit, quota)), F.col("shard")) - F.col("before"), F.lit(0)))
    placed = common.written(placed.select("g", "shard", stays.alias("n")).where("n > 0"), "placed")
    loads = {r["shard"]: r["load"] for r in placed.groupBy("shard").agg(F.sum("n").alias("load")).collect()}  # n_shards rows at most

    # which member of a group goes where: its number in the group falls in the range of a shard
    ranges = placed.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("shard", "n"))).alias("parts"))  # n_shards parts at most
    ends = F.transform("parts", lambda x, i: F.struct(x["shard"].alias("shard"), F.aggregate(F.slice("parts", 1, i + 1), F.lit(0).cast("long"), lambda a, y: a + y["n"]).alias("end")))
    ranges = ranges.select(F.col("g").alias(key + "g"), ends.alias(at))
    df = df.withColumn(bucket, _bucket(F.col(key), F.col(g)))
    df = _numbered_in_group(df, g, bucket, key, no)
    df = df.join(ranges, F.col(g) == F.col(key + "g"), "left")
    mine = F.filter(at, lambda x: x["end"] > F.col(no))
    df = df.withColumn(at, F.get(mine, F.lit(0))["shard"])

    # the unlinked rows fill up what is left, in the order of their running number
    free = F.when(F.col(at).isNull(), 1).otherwise(0)
    df = running_sum(df.drop(no, key + "g"), [], bucket, [F.col(key), F.col(g)], free, no)
    until, least = 0, F.lit(n_shards - 1)
    choice = F
    for i in range(n_shards):
        until += quota[i] - loads.get(i, 0)
        choice = (F.when if choice is F else choice.when)(F.col(no) < until, F.lit(i))
    df = df.withColumn("shard", F.coalesce(F.col(at), choice.otherwise(least)).cast("int"))
    df = running_sum(df, ["shard"], bucket, [F.col(key), F.col(g)], F.lit(1), "slot")
    return df.select(*map(col, own), "shard", "slot")


def _numbered_in_group(df: DataFrame, g: str, bucket: str, key: str, no: str) -> DataFrame:
    """Adds no: the row's number in its group, from 0. Buckets' totals go by group here, so that the table of totals grows with the rows and is joined, not broadcast."""
    inner, before, k_g, k_b = unused(df, "n_inner", "n_before", "n_g", "n_b")
    totals = df.groupBy(F.col(g).alias(k_g), F.col(bucket).alias(k_b)).agg(F.count("*").alias("n"))
    totals = totals.withColumn(before, F.coalesce(F.sum("n").over(Window.partitionBy(k_g).orderBy(k_b).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    ranked = df.withColumn(inner, F.row_number().over(Window.partitionBy(g, bucket).orderBy(key)) - 1)
    out = ranked.join(totals, (F.col(g) == F.col(k_g)) & (F.col(bucket) == F.col(k_b)))
    return out.withColumn(no, (F.col(inner) + F.col(before)).cast("long")).drop(inner, before, k_g, k_b)


def cut_edges(placed: DataFrame, group: str) -> DataFrame:
    """One row: links between rows of equal group, and how many of them the shards cut."""
    n = placed.groupBy(group, "shard").agg(F.count("*").alias("n"))
    by = n.groupBy(group).agg(F.sum("n").alias("all"), F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("inside"))
    return by.agg(F.sum(F.col("all") * (F.col("all") - 1) / 2).alias("links"), F.sum(F.col("all") * (F.col("all") - 1) / 2 - F.col("inside")).alias("cut"))


def cut_links(placed: DataFrame, links: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row: the weight of the links (a, b, weight) between rows of placed, and how much of it the shards cut."""
    ends = links
    for end in ("a", "b"):
        ends = ends.join(placed.select(col(id_col).alias(end), F.col("shard").alias(f"shard_{end}")), end)
    return ends.agg(F.coalesce(F.sum("weight"), F.lit(0)).alias("links"), F.coalesce(F.sum(F.when(F.col("shard_a") != F.col("shard_b"), F.col("weight"))), F.lit(0)).alias("cut"))
