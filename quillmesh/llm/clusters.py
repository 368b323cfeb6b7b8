"""Grouping records into similarity clusters by Markov clustering, over sets of tokens.

Records with equal sets are one class. The similarity graph joins two classes whose Jaccard similarity is at least the threshold. Its
links are kept without listing all pairs of a group: the Jaccard distance is a metric, so classes within a small radius of a common
center are similar to each other, and such a ball is one node of the graph that stands for all links inside it. A prefix filter on the
rarest tokens finds every class that may be linked to a ball; the links of a class to a ball are told by its distance to the center, and
where the center is too far but a member may be near enough, the triangle inequality picks the pairs that are compared one by one. No
link between classes is left out of the graph because one of them has found another.

On this symmetric graph with loops the Markov process runs: the sparse flow matrix is squared, inflated, pruned and scaled until it
stands still. A ball of n records weighs as n equal records would, so the process on balls is the process on records with n equal rows
written once. The rows that attract flow are the clusters, and the members of strongest flow represent them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.operators.frequency import frequencies, join_salted
from quillmesh.session import Workspace

#: Distance to its center within which a class belongs to a ball; members of a ball have a distance of twice that at most.
RADIUS = 0.2
#: By how much the share of centers grows from round to round. A group is met first when it has about one to this many centers.
GROWTH = 16


def token_sets(features: DataFrame, key: str = "feature_id") -> DataFrame:
    """key, tokens: the sorted distinct tokens with a count above 0; rows without any and rows with a null key are left out. Tokens are
    64-bit hashes of their texts from here on: two tokens of one pair of sets fall together with a chance below one in 10^15."""
    present = F.map_filter("tokens", lambda _, n: n > 0)
    sets = features.where(f"`{key}` is not null").select(key, F.array_sort(F.transform(F.map_keys(present), lambda t: F.xxhash64(t))).alias("tokens"))
    return sets.where("size(tokens) > 0")


def classes_of(sets: DataFrame, key: str, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """(members, classes): members key, set_id; classes set_id, node, key (smallest key of the class), size, tokens, written. node is that key,
    but for all but one of the classes that share it, as rows may repeat a key with other tokens: these get a node of their own."""
    members = sets.select(key, F.md5(F.array_join(F.col("tokens"), ",")).alias("set_id"), "tokens")
    classes = members.groupBy("set_id").agg(F.min(key).alias("key"), F.count(F.lit(1)).alias("size"), F.first("tokens").alias("tokens"))
    classes = work.write(classes, "sets")
    shared = classes.groupBy("key").agg(F.min("set_id").alias("__first"), F.count(F.lit(1)).alias("__n")).where("__n > 1").select("key", "__first")
    own = F.xxhash64("set_id").cast(sets.schema[key].dataType)
    node = F.when(F.coalesce(F.col("set_id") == F.col("__first"), F.lit(True)), F.col("key")).otherwise(own)
    return members.select(key, "set_id"), work.write(classes.join(shared, "key", "left").select("set_id", node.alias("node"), "key", "size", "tokens"), "classes")


def rarest_first(classes: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """(ranked, df): node with its tokens, the rarest first, and each token's number of nodes; both written."""
    rows = classes.select("node", F.explode("tokens").alias("token"))
    freq = work.write(frequencies(rows, "token"), "df")
    # A class's tokens are those of one record, so the list is bounded by a record.
    ranked = join_salted(rows, freq, "token", freq, "df").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("ranked"))
    return work.write(ranked, "ranked"), freq


def prefix(ranked: DataFrame, threshold: float) -> DataFrame:
    """token, node: for each node its rarest tokens, as many as make sure that nodes of at least that similarity share one. Tokens of a
    single node are left out."""
    length = F.size("ranked") - F.ceil(F.size("ranked") * F.lit(threshold) - F.lit(1e-9)) + 1
    rows = ranked.select("node", F.explode(F.slice(F.col("ranked"), F.lit(1), length.cast("int"))).alias("t"))
    return rows.where("t.df > 1").select("t.token", "node")


def _jaccard(a: str, b: str) -> Column:
    shared = F.size(F.array_intersect(a, b))
    return shared / (F.size(a) + F.size(b) - shared)


def _compare(pairs: DataFrame, nodes: DataFrame, other: str) -> DataFrame:
    """pairs (node, other and more) with similarity. One center can be in a third of all pairs: while the nodes fit a broadcast the planner
    takes that, beyond it splits the skewed parts of the join."""
    pairs = pairs.join(nodes.select("node", F.col("tokens").alias("__a")), "node")
    pairs = pairs.join(nodes.select(F.col("node").alias(other), F.col("tokens").alias("__b")), other)
    return pairs.withColumn("similarity", _jaccard("__a", "__b")).drop("__a", "__b")


def balls(nodes: DataFrame, ranked: DataFrame, df: DataFrame, work: Workspace, radius: float = RADIUS) -> DataFrame:
    """node, ball, near: each node with the center of its ball and its similarity to it. nodes: node, tokens (written).

    In each round a share of the undecided nodes, chosen by a hash, are centers; of centers within the radius of each other the one of the
    lowest hash stays. Undecided nodes within the radius of a center join the nearest one. The share grows until in the last round all that are
    left are centers, so a group of any size is taken up by the few centers that meet it first, and nothing is left out.
    """
    rank = lambda c: F.pmod(F.xxhash64(F.lit(11), c), F.lit(1 << 31))
    total = df.agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
    keys = work.write(prefix(ranked, 1.0 - radius), "near0")
    left, parts = nodes.select("node"), []
    rounds = max(1, math.ceil(math.log(max(nodes.count(), 2), GROWTH)))
    for n in range(rounds):
        share = F.lit(int((1 << 31) * float(GROWTH) ** (n + 1 - rounds)))
        centers = keys.where(rank(F.col("node")) < share).select("token", F.col("node").alias("center"))
        pairs = join_salted(keys, centers, "token", df, "df", total).where("node <> center").select("node", "center").distinct()
        close = work.write(_compare(pairs, nodes, "center").where(F.col("similarity") >= 1.0 - radius), f"close{n}")
        # A center gives way to a center of a lower hash that is close to it.
        before = F.struct(rank(F.col("center")), F.col("center")) < F.struct(rank(F.col("node")), F.col("node"))
        yielding = close.where((rank(F.col("node")) < share) & before).select("node").distinct()
        staying = left.where(rank(F.col("node")) < share).join(yielding, "node", "left_anti")
        joined = close.join(staying.withColumnRenamed("node", "center"), "center", "left_semi").join(staying, "node", "left_anti")
        joined = joined.groupBy("node").agg(F.max(F.struct(F.col("similarity").alias("s"), (-rank(F.col("center"))).alias("r"), "center")).alias("b"))
        joined = joined.select("node", F.col("b.center").alias("ball"), F.col("b.s").alias("near"))
        if n == rounds - 1:
            # What gave way to a center that gave way itself is a ball of its own.
            decided = left.join(joined, "node", "left").select("node", F.coalesce("ball", "node").alias("ball"), F.coalesce("near", F.lit(1.0)).alias("near"))
        else:
            decided = staying.select("node", F.col("node").alias("ball"), F.lit(1.0).alias("near")).unionByName(joined)
        parts.append(work.write(decided, f"balls{n}"))
        left = left.join(parts[-1].select("node"), "node", "left_anti")
        if n < rounds - 1:
            keys = work.write(keys.join(parts[-1].select("node"), "node", "left_anti"), f"near{n + 1}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def links(nodes: DataFrame, ranked: DataFrame, df: DataFrame, placed: DataFrame, work: Workspace, threshold: float) -> DataFrame:
    """a, b, weight, records: the links between different balls, both ways, and the loops; weight is the mean similarity over all pairs of
    records, one of each ball, counting pairs below the threshold as 0; records is the number of b's.

    nodes: node, size, tokens; placed: node, ball, near. A node that is linked to a ball's center counts as linked to the ball with that
    similarity, from either side. Of the other pairs those that can reach the threshold - a member y of a ball is no nearer to x than the
    difference of their distances to its center - are compared one by one.
    """
    sized = work.write(placed.join(nodes.select("node", "size"), "node"), "sized")
    measures = F.sum("size").alias("records"), F.max(1.0 - F.col("near")).alias("radius"), (F.sum(F.col("near") * F.col("size")) / F.sum("size")).alias("inside")
    ball = work.write(sized.groupBy("ball").agg(*measures), "ball")
    keys = work.write(sized.select("node", "ball").join(prefix(ranked, threshold), "node"), "keys")
    there = keys.select("token", F.col("ball").alias("other")).distinct()
    tried = work.write(join_salted(keys, there, "token", df, "df").where("ball <> other").select("node", "ball", "other").distinct(), "tried")
    others = work.write(frequencies(tried, "other", "n").join(nodes.select(F.col("node").alias("other"), F.col("tokens").alias("__b")), "other"), "others")
    near = join_salted(tried, others, "other", others, "n").drop("n")
    near = near.join(nodes.select("node", "size", F.col("tokens").alias("__a")), "node").withColumn("similarity", _jaccard("__a", "__b")).drop("__a", "__b")
    near = near.join(sized.select("node", F.col("near").alias("own")), "node")
    near = near.join(ball.select(F.col("ball").alias("other"), F.col("radius").alias("reach")), "other")
    near = work.write(near.where((F.col("similarity") >= threshold) | ((F.col("reach") > 0) & (F.col("similarity") >= threshold - F.col("reach")))), "near")
    records = lambda c, name: ball.select(F.col("ball").alias(c), F.col("records").alias(name))
    star = near.where(F.col("similarity") >= threshold).groupBy(F.col("ball").alias("a"), F.col("other").alias("b")).agg(F.sum(F.col("similarity") * F.col("size")).alias("s"))
    one_way = star.join(records("a", "m"), "a").select("a", "b", (F.col("s") / F.col("m") / 2.0).alias("w"))
    # Pairs of members of which neither is linked to the other's center; d: distance to the other's center, o: to the own one.
    far = near.where(F.col("similarity") < threshold).select("node", "size", "ball", "other", (1.0 - F.col("similarity")).alias("d"), (1.0 - F.col("own")).alias("o"))
    here = far.withColumn("place", F.xxhash64("ball", "other"))
    if here.head(1):
        there = here.select(F.xxhash64("other", "ball").alias("place"), *(F.col(c).alias(f"peer_{c}") for c in ("node", "size", "ball", "other", "d", "o")))
        pairs = join_salted(here, there, "place", work.write(frequencies(here, "place", "n"), "places"), "n").where("ball = peer_other and other = peer_ball and ball < other")
        pairs = pairs.where((F.col("d") - F.col("peer_o") <= 1.0 - threshold) & (F.col("peer_d") - F.col("o") <= 1.0 - threshold))
        more = _compare(pairs.select("node", F.col("peer_node").alias("peer"), "ball", "other", "size", "peer_size"), nodes, "peer").where(F.col("similarity") >= threshold)
        more = more.groupBy("ball", "other").agg(F.sum(F.col("similarity") * F.col("size") * F.col("peer_size")).alias("s"))
        more = more.join(records("ball", "m"), "ball").join(records("other", "k"), "other").select(F.col("ball").alias("a"), F.col("other").alias("b"), (F.col("s") / F.col("m") / F.col("k")).alias("w"))
        one_way = one_way.unionByName(more)
    both = one_way.unionByName(one_way.select(F.col("b").alias("a"), F.col("a").alias("b"), "w")).groupBy("a", "b").agg(F.sum("w").alias("weight"))
    loops = ball.select(F.col("ball").alias("a"), F.col("ball").alias("b"), F.col("inside").alias("weight"))
    return work.write(both.unionByName(loops).join(records("b", "records"), "b"), "graph")


def markov(edges: DataFrame, work: Workspace, inflation: float = 2.0, prune: float = 1e-4, recover: int = 100, tolerance: float = 1e-2, rounds: int = 200) -> DataFrame:
    """node, cluster, flow: the row that attracts most of the flow of each node (of nearly equal ones, within a tenth, the smallest) and the flow
    a record of the node attracts.

    edges (written): a, b, weight, records - a link of a record of a to each of the records of b; both directions and loops (a = b) are
    included, weights are above 0, records is the number of equal records that b stands for. The columns of the flow matrix sum to 1; it is
    squared, raised to the inflation record by record, freed from entries below prune - the `recover` largest of a column stay however
    small they are - and scaled again, until no column changes by more than the tolerance in all. If it hasn't settled
    after so many rounds, an error says so. Rows are spread by column with frequent columns dealt out, entry by entry.
    """
    records = work.write(edges.select(F.col("b").alias("i"), "records").distinct(), "records")

    def scaled(m: DataFrame) -> DataFrame:
        return m.select("i", "j", (F.col("v") / F.sum("v").over(Window.partitionBy("j"))).alias("v"))

    flow = work.write(scaled(edges.select(F.col("b").alias("i"), F.col("a").alias("j"), (F.col("weight") * F.col("records")).alias("v"))), "flow0")
    entries = flow.count()
    for n in range(1, rounds + 1):
        left = flow.select(F.col("i").alias("k"), "j", F.col("v").alias("x"))
        square = join_salted(left, flow.select(F.col("j").alias("k"), "i", "v"), "k", frequencies(left, "k", "n"), "n", entries)
        square = square.groupBy("i", "j").agg(F.sum(F.col("x") * F.col("v")).alias("v")).join(records, "i")
        # What flows to each of the records of a node, raised, for all of them.
        raised = scaled(square.select("i", "j", (F.pow(F.col("v") / F.col("records"), F.lit(inflation)) * F.col("records")).alias("v")))
        order = Window.partitionBy("j").orderBy(F.round("v", 12).desc(), "i")
        kept = raised.withColumn("r", F.row_number().over(order)).where((F.col("v") >= prune) | (F.col("r") <= recover))
        new = work.write(scaled(kept), f"flow{n}")
        signed = new.select("i", "j", "v", F.lit(1).alias("one")).unionByName(flow.select("i", "j", (-F.col("v")).alias("v"), F.lit(0).alias("one")))
        moved = signed.groupBy("i", "j").agg(F.abs(F.sum("v")).alias("v"), F.sum("one").alias("one"))
        change, entries = moved.groupBy("j").agg(F.sum("v").alias("v"), F.sum("one").alias("one")).agg(F.max("v"), F.sum("one")).first()
        flow = new
        work.drop(f"flow{n - 1}")
        if change is None or change <= tolerance:
            break
    else:
        raise RuntimeError(f"the flow hasn't settled after {rounds} rounds; a column still changes by {change:.3g}")
    # Rows that attract nearly the same flow are one system of attractors; its smallest row names it.
    top = flow.withColumn("most", F.max("v").over(Window.partitionBy("j"))).where(F.col("v") >= 0.9 * F.col("most"))
    top = top.groupBy(F.col("j").alias("node")).agg(F.min("i").alias("cluster"))
    drawn = flow.join(records.select(F.col("i").alias("j"), F.col("records").alias("from")), "j").groupBy("i").agg(F.sum(F.col("v") * F.col("from")).alias("v"))
    drawn = drawn.join(records, "i").select(F.col("i").alias("node"), (F.col("v") / F.col("records")).alias("flow"))
    return top.join(drawn, "node", "left").fillna(0.0, "flow")


def cluster(features: DataFrame, key: str = "feature_id", threshold: float = 0.5, inflation: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """(members, classes): members key, root, size - root is the smallest key of the record's cluster, size the cluster's number of
    records - and classes node, key, root, size, weight, flow, tokens, one row for each distinct set, with its smallest key and the flow
    that a record of its ball attracts.

    Records without tokens are left out. Rows that repeat a key count as records of their own, with other tokens as well;
    clusters whose smallest key is the same by such rows share their root. Where similarity isn't transitive, a
    record goes where most of its flow does. An empty table gives empty results. threshold has to be at most 1 - 2 * RADIUS, so that the
    members of a ball are linked.
    """
    if threshold > 1 - 2 * RADIUS:
        raise ValueError(f"the threshold may be {1 - 2 * RADIUS} at most")
    spark = features.sparkSession
    work = Workspace(spark, "clusters")
    sets, classes = classes_of(token_sets(features, key), key, work)
    nodes = classes.select("node", "key", "size", "tokens")
    ranked, df = rarest_first(nodes, work)
    placed = balls(nodes, ranked, df, work)
    graph = links(nodes, ranked, df, placed, work, threshold)
    found = work.write(markov(graph, work, inflation).withColumnRenamed("node", "ball"), "found")
    in_ball = work.write(frequencies(placed, "ball", "n").join(found, "ball"), "in_ball")
    rooted = join_salted(placed.select("node", "ball"), in_ball, "ball", in_ball, "n").select("node", "cluster", "flow").join(nodes, "node")
    rooted = work.write(rooted, "rooted")
    sizes = rooted.groupBy("cluster").agg(F.min("key").alias("root"), F.sum("size").alias("weight"), F.count(F.lit(1)).alias("n"))
    sizes = work.write(sizes, "sizes")
    rooted = join_salted(rooted, sizes, "cluster", sizes, "n").select("node", "key", "root", "size", "weight", "flow", "tokens")
    rooted = work.write(rooted, "final")
    by_set = classes.select("set_id", "node", F.col("size").alias("n")).join(rooted.select("node", "root", "weight"), "node")
    by_set = work.write(by_set, "by_set")
    members = join_salted(sets, by_set, "set_id", by_set, "n").select(key, "root", F.col("weight").alias("size"))
    return members, rooted


def typical(classes: DataFrame, work: Workspace, k: int = 3) -> DataFrame:
    """root, size, typical: each cluster with its k members of strongest flow. The Markov process tells the flow of each ball; within a ball,
    whose members it doesn't tell apart, the member comes first to which one more step brings most flow: a step from the cluster's
    records over their tokens, which is the sum of its tokens' shares among the records over the root of their number. Of members with
    equal sets the smallest key stands for all."""
    rows = classes.select("node", "key", "root", "size", "weight", "flow", F.size("tokens").alias("n_tokens"), F.explode("tokens").alias("token"))
    rows = rows.withColumn("place", F.xxhash64("root", "token"))
    shares = rows.groupBy("place").agg((F.sum("size") / F.first("weight")).alias("share"), F.count(F.lit(1)).alias("n"))
    shares = work.write(shares, "shares")
    steps = join_salted(rows, shares, "place", shares, "n").groupBy("root", "node").agg((F.sum("share") / F.sqrt(F.first("n_tokens"))).alias("step"), F.first("weight").alias("weight"), F.first("flow").alias("flow"), F.first("key").alias("key"))
    order = Window.partitionBy("root").orderBy(F.round("flow", 4).desc(), F.round("step", 9).desc(), "key", "node")
    best = steps.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k)
    best = best.groupBy("root").agg(F.first("weight").alias("size"), F.array_sort(F.collect_list(F.struct("r", "key"))).alias("t"))
    return best.select(F.col("root").alias("root_id"), "size", F.col("t.key").alias("typical"))
