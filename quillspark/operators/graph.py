"""Graph operators on edge tables: closure, paths, degrees, components, communities."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def cut_lineage(df: DataFrame) -> DataFrame:
    """Written to ``spark.checkpoint.dir`` and read again; where that is unset, to a folder of our own if everything runs on this machine."""
    spark: SparkSession = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="quillspark-checkpoint-")
        spark.sparkContext.setCheckpointDir(base)
    path = f"{base.rstrip('/')}/graph-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def reachable(edges: DataFrame, start: list[str], max_depth: int | None = None) -> DataFrame:
    """(node, depth) of all nodes that ``edges`` (src, dst) lead to, cycles or not.

    A round joins the newest nodes with the edges and keeps what is new; each is stored,
    and the loop ends when none is.  Rounds are as many as the longest shortest path.
    """
    spark = edges.sparkSession
    dtype = edges.schema["src"].dataType.simpleString()
    seen = cut_lineage(spark.createDataFrame([(s, 0) for s in start], f"node {dtype}, depth int"))
    fresh, depth = seen, 0
    while max_depth is None or depth < max_depth:
        depth += 1
        found = edges.join(fresh, edges["src"] == fresh["node"]).select(F.col("dst").alias("node")).distinct().join(seen.select("node"), "node", "left_anti")
        fresh = cut_lineage(found.withColumn("depth", F.lit(depth)))
        if fresh.isEmpty():
            break
        seen = seen.unionByName(fresh)
    return seen


def shortest_path(edges: DataFrame, a, b) -> int | None:
    """Number of edges on a shortest path, null if there is none."""
    row = reachable(edges, [a]).where(F.col("node") == b).first()
    return row["depth"] if row else None


def degrees(edges: DataFrame) -> DataFrame:
    """(node, degree) of an undirected reading; both ends of each edge count."""
    return edges.select(F.explode(F.array("src", "dst")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))


def god_nodes(edges: DataFrame, n: int = 10) -> DataFrame:
    return degrees(edges).orderBy(F.desc("degree"), "node").limit(n)


def isolated(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes with at most one edge."""
    d = degrees(edges)
    return nodes.join(d, "node", "left").select("node", F.coalesce("degree", F.lit(0).cast("long")).alias("degree")).where("degree <= 1")


def dedupe(edges: DataFrame) -> DataFrame:
    """One edge per (src, dst, relation), the one of highest confidence."""
    return edges.groupBy("src", "dst", "relation").agg(F.max("confidence").alias("confidence"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): smallest node reachable, ignoring direction; large-star and small-star rounds, each stored."""
    now = cut_lineage(edges.where("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct())
    last = None
    for _ in range(max_rounds):
        both = now.union(now.select("v", "u").toDF("u", "v"))
        low = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        now = cut_lineage(small)
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == last:
            break
        last = seen
    else:
        raise RuntimeError(f"the components did not settle in {max_rounds} rounds")
    stars = now.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    return stars.union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()).union(edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct().join(now.select(F.explode(F.array("u", "v")).alias("node")).distinct(), "node", "left_anti").select("node", F.col("node").alias("component")))


def communities(edges: DataFrame, rounds: int = 5) -> DataFrame:
    """R4, a substitute of our own: label propagation over a fixed number of rounds; a node takes its neighbours' most frequent label, the least on a tie."""
    both = cut_lineage(edges.select("src", "dst").union(edges.select("dst", "src")).where("src <> dst").distinct())
    labels = both.select(F.col("src").alias("node")).distinct().withColumn("label", F.col("node"))
    for _ in range(rounds):
        votes = both.join(labels, both["dst"] == labels["node"]).groupBy("src", "label").agg(F.count("*").alias("n"))
        labels = cut_lineage(votes.groupBy("src").agg(F.min(F.struct((-F.col("n")).alias("n"), "label")).alias("best")).select(F.col("src").alias("node"), F.col("best.label").alias("label")))
    return labels


def cohesion(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Per community its nodes, inner edges and their share of the possible ones."""
    size = labels.groupBy("label").agg(F.count("*").alias("nodes"))
    pairs = edges.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).where("a <> b").distinct()
    a, b = labels.toDF("a", "la"), labels.toDF("b", "lb")
    inner = pairs.join(a, "a").join(b, "b").where("la = lb").groupBy(F.col("la").alias("label")).agg(F.count("*").alias("edges"))
    possible = F.col("nodes") * (F.col("nodes") - 1) / 2
    return size.join(inner, "label", "left").select("label", "nodes", F.coalesce("edges", F.lit(0).cast("long")).alias("edges"), F.round(F.when(possible > 0, F.coalesce("edges", F.lit(0)) / possible).otherwise(1.0), 4).alias("cohesion"))


def betweenness(edges: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """(node, betweenness) of the undirected graph, from shortest paths that start in ``sources`` (all nodes if None).

    Brandes' two passes by levels: forwards the number of shortest paths per (source,
    node), backwards each node's share of them.  Rows are sources x nodes reached, so
    a large graph is given a set of sources; the sum is then over that set.  The
    levels end with the longest shortest path.
    """
    both = cut_lineage(edges.select("src", "dst").union(edges.select("dst", "src")).where("src <> dst").distinct())
    nodes = both.select(F.col("src").alias("node")).distinct()
    start = (sources if sources is not None else nodes).select(F.col("node").alias("s"))
    fresh = cut_lineage(start.select("s", F.col("s").alias("node"), F.lit(1.0).alias("paths"), F.lit(0).alias("depth")))
    levels, seen = [fresh], fresh.select("s", "node")
    depth = 0
    while True:
        depth += 1
        step = fresh.join(both, fresh["node"] == both["src"]).groupBy("s", F.col("dst").alias("node")).agg(F.sum("paths").alias("paths"))
        fresh = cut_lineage(step.join(seen, ["s", "node"], "left_anti").withColumn("depth", F.lit(depth)))
        if fresh.isEmpty():
            break
        levels.append(fresh)
        seen = seen.union(fresh.select("s", "node"))
    share, out = levels[-1].select("s", "node", "paths", F.lit(0.0).alias("share")), []
    for above in reversed(levels[:-1]):
        out.append(share.select("s", "node", "share"))
        below = share.select("s", F.col("node").alias("far"), F.col("paths").alias("far_paths"), F.col("share").alias("far_share"))
        links = above.select("s", "node", "paths").join(both.select(F.col("src").alias("node"), F.col("dst").alias("far")), "node").join(below, ["s", "far"])
        gained = links.groupBy("s", "node").agg(F.sum(F.col("paths") / F.col("far_paths") * (1 + F.col("far_share"))).alias("share"))
        share = cut_lineage(above.select("s", "node", "paths").join(gained, ["s", "node"], "left").select("s", "node", "paths", F.coalesce("share", F.lit(0.0)).alias("share")))
    total = out[0] if out else share.select("s", "node", "share").where("false")
    for x in out[1:]:
        total = total.union(x)
    sums = total.where("s <> node").groupBy("node").agg(F.sum("share").alias("betweenness"))
    return nodes.join(sums, "node", "left").select("node", F.round(F.coalesce("betweenness", F.lit(0.0)) / 2, 6).alias("betweenness"))


def bridges(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Edges between communities."""
    a, b = labels.toDF("src", "src_label"), labels.toDF("dst", "dst_label")
    return edges.join(a, "src").join(b, "dst").where("src_label <> dst_label").select("src", "dst", "src_label", "dst_label")


def surprising(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Inferred similarity between nodes of different files."""
    a, b = nodes.select(F.col("node").alias("src"), F.col("file").alias("src_file")), nodes.select(F.col("node").alias("dst"), F.col("file").alias("dst_file"))
    return edges.where("confidence = 'INFERRED' AND relation = 'semantically_similar_to'").join(a, "src").join(b, "dst").where("src_file <> dst_file").select("src", "dst", "src_file", "dst_file")


def hyperedge_members(hyper: DataFrame) -> DataFrame:
    """R6."""
    return hyper.select("id", "relation", F.posexplode("nodes").alias("pos", "node"))


def topological_levels(items: DataFrame, needs: DataFrame) -> DataFrame:
    """(item, level); level 0 needs nothing, others one more than their latest need. ``needs``: item, needed. Items on a cycle get null."""
    done = cut_lineage(items.join(needs.select("item").distinct(), "item", "left_anti").select("item", F.lit(0).alias("level")))
    level = 0
    while True:
        level += 1
        waiting = items.join(done.select("item"), "item", "left_anti")
        blocked = needs.join(done.select(F.col("item").alias("needed")), "needed", "left_anti").select("item").distinct()
        ready = cut_lineage(waiting.join(blocked, "item", "left_anti").select("item", F.lit(level).alias("level")))
        if ready.isEmpty():
            break
        done = done.unionByName(ready)
    return items.select("item").join(done, "item", "left")


def changed(now: DataFrame, before: DataFrame) -> DataFrame:
    """(path, sha) that are new or different; only these are extracted again."""
    return now.join(before, ["path", "sha"], "left_anti")


def flatten_tree(nodes: DataFrame, max_depth: int = 10_000) -> DataFrame:
    """(id, depth, order) of a forest (id, parent, ord), depth first; order is the path of ordinals. A deeper one is an error."""
    level = nodes.where("parent IS NULL").select("id", F.lit(0).alias("depth"), F.array("ord").alias("order"))
    out, depth = level, 0
    while True:
        depth += 1
        level = cut_lineage(nodes.join(level.select(F.col("id").alias("parent"), F.col("order").alias("above")), "parent").select("id", F.lit(depth).alias("depth"), F.concat("above", F.array("ord")).alias("order")))
        if level.isEmpty():
            return out
        if depth > max_depth:
            raise RuntimeError(f"the forest has more than {max_depth} levels")
        out = out.unionByName(level)
