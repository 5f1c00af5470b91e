"""Graphs as tables: ``vertices(id)`` and simple undirected ``edges(src < dst)``.

Path operators work from sources in level-synchronous rounds of joins. Their tables have a
row for each reachable (source, vertex) pair, so callers give the sources that they need;
``petrel.operators.paths`` sums all-pairs measures over blocks of sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from petrel.functions.columns import LEAST_P, rounded
from petrel.operators.checkpoints import checkpointed, written
from petrel.operators.components import components as _components

#: Neighbours of a vertex in a row of the triangle search.
NEIGHBOUR_CHUNK = 4096


def thresholded(links: DataFrame, threshold: int) -> DataFrame:
    return links.where(F.col("score") >= threshold)


def simplified(links: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Undirected edges without loops and repetitions."""
    return links.select(F.least(src, dst).alias("src"), F.greatest(src, dst).alias("dst")).where("src <> dst").distinct()


def endpoints(edges: DataFrame) -> DataFrame:
    """(id, other) for both directions."""
    return edges.select(F.explode(F.array(F.struct(F.col("src").alias("id"), F.col("dst").alias("other")), F.struct(F.col("dst").alias("id"), F.col("src").alias("other")))).alias("e")).select("e.*")


def induced(links: DataFrame, ids: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame]:
    """(vertices, edges) of the ids at a threshold.

    A vertex is an id that has a link of that score to anything; it stays though its partners aren't among the ids.
    """
    strong = thresholded(links, threshold)
    vertices = endpoints(strong.select("src", "dst")).select("id").join(ids.select("id"), "id", "left_semi").distinct()
    mine = ids.select("id").distinct()
    edges = strong.join(mine.select(F.col("id").alias("src")), "src", "left_semi").join(mine.select(F.col("id").alias("dst")), "dst", "left_semi")
    return vertices, simplified(edges)


def require_edges(vertices: DataFrame, edges: DataFrame) -> None:
    if vertices.isEmpty() or edges.isEmpty():
        raise ValueError("the network has no vertex or no edge at this threshold")


def degrees(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    counted = endpoints(edges).groupBy("id").agg(F.count(F.lit(1)).alias("degree"))
    return vertices.join(counted, "id", "left").select("id", F.coalesce("degree", F.lit(0)).alias("degree"))


def degree_histogram(degree: DataFrame) -> DataFrame:
    """Vertices by degree, without isolated ones, and both logarithms."""
    return degree.where("degree > 0").groupBy("degree").agg(F.count(F.lit(1)).alias("n")).select("degree", "n", F.log10("degree").alias("log_degree"), F.log10("n").alias("log_n"))


def components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component): the component's least id; an isolated vertex is its own."""
    label = _components(edges, "src", "dst")
    return vertices.join(label, vertices["id"] == label["node"], "left").select("id", F.coalesce("label", "id").alias("component"))


def component_sizes(member: DataFrame) -> DataFrame:
    return member.groupBy("component").agg(F.count(F.lit(1)).alias("size"))


def largest_component(member: DataFrame) -> DataFrame:
    """Adds in_largest_component; of equal components the one of least id is largest."""
    first = component_sizes(member).orderBy(F.desc("size"), "component").limit(1).select("component", F.lit(True).alias("in_largest_component"))
    return member.join(F.broadcast(first), "component", "left").select("id", "component", F.coalesce("in_largest_component", F.lit(False)).alias("in_largest_component"))


def shortest_paths(vertices: DataFrame, edges: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """(s, t, d, sigma) for every vertex t reached from each source s, with the number of shortest paths; d = 0 included.

    Without sources all vertices are such, in one block; ``paths.all_pairs`` takes them in blocks of bounded size.
    """
    step = checkpointed(endpoints(edges).select(F.col("id").alias("a"), F.col("other").alias("b")))
    frontier = written((sources or vertices).select(F.col("id").alias("s"), F.col("id").alias("t"), F.lit(0).alias("d"), F.lit(1).cast("double").alias("sigma")))
    reached, before = frontier, frontier
    while True:
        # a neighbour of the frontier lies in it, in the level before it, or is new
        seen = frontier.union(before).select("s", "t")
        nxt = frontier.join(step, F.col("t") == F.col("a")).groupBy("s", F.col("b").alias("t")).agg((F.first("d") + 1).alias("d"), F.sum("sigma").alias("sigma"))
        before, frontier = frontier, written(nxt.join(seen, ["s", "t"], "left_anti").select("s", "t", "d", "sigma"))
        if frontier.isEmpty():
            return reached
        reached = reached.union(frontier)


def dependencies(edges: DataFrame, paths: DataFrame) -> DataFrame:
    """(id, betweenness, stress) over the ordered pairs that the paths' sources begin, by accumulation from the deepest level up.

    For a source, a vertex v depends on its successors w by sigma(v)/sigma(w) (1 + delta(w)), and
    1 + gamma(w) shortest paths lead on from v by w; rows are (source, edge) pairs, not triples of vertices.
    """
    depth = paths.agg(F.max("d")).first()[0] or 0
    step = checkpointed(endpoints(edges).select(F.col("id").alias("a"), F.col("other").alias("b")))
    paths = written(paths)
    none = paths.where("d < 0").select("s", "t", F.lit(0.0).alias("delta"), F.lit(0.0).alias("gamma"))
    below, done = none, none
    for d in range(depth, 0, -1):
        deep = paths.where(F.col("d") == d).join(below, ["s", "t"], "left").select(F.col("s").alias("ws"), F.col("t").alias("w"), F.col("sigma").alias("wsigma"), F.coalesce("delta", F.lit(0.0)).alias("wdelta"), F.coalesce("gamma", F.lit(0.0)).alias("wgamma"))
        upper = paths.where(F.col("d") == d - 1).select("s", "t", "sigma")
        by_edge = deep.join(step, F.col("w") == F.col("a")).join(upper, (F.col("ws") == F.col("s")) & (F.col("b") == F.col("t")))
        below = written(by_edge.groupBy("s", "t").agg(F.sum(F.col("sigma") / F.col("wsigma") * (1 + F.col("wdelta"))).alias("delta"), F.sum(1 + F.col("wgamma")).alias("gamma")))
        done = done.union(below)
    return done.where("s <> t").join(paths.select("s", "t", "sigma"), ["s", "t"]).groupBy(F.col("t").alias("id")).agg(F.sum("delta").alias("betweenness"), F.sum(F.col("sigma") * F.col("gamma")).alias("stress"))


def centrality(vertices: DataFrame, edges: DataFrame, paths: DataFrame) -> DataFrame:
    """(id, betweenness, stress) over unordered pairs, from the paths of all sources."""
    return halved(vertices, dependencies(edges, paths))


def halved(vertices: DataFrame, sums: DataFrame) -> DataFrame:
    """Sums over ordered pairs as those over unordered ones; a vertex on no path has 0."""
    half = lambda c: (F.coalesce(c, F.lit(0.0)) / 2).alias(c)
    return vertices.join(sums, "id", "left").select("id", half("betweenness"), half("stress"))


def normalised_betweenness(measured: DataFrame, n: int) -> DataFrame:
    pairs = (n - 1) * (n - 2) / 2
    return measured.withColumn("betweenness", F.col("betweenness") / pairs if pairs else F.lit(None).cast("double"))


def reach(paths: DataFrame) -> DataFrame:
    """(id, reached, total, inverse, eccentricity) of each source: vertices other than itself, sums of d and 1 / d, the greatest d."""
    return paths.where("d > 0").groupBy(F.col("s").alias("id")).agg(F.count(F.lit(1)).alias("reached"), F.sum("d").alias("total"), F.sum(1 / F.col("d")).alias("inverse"), F.max("d").alias("eccentricity"))


def distances(vertices: DataFrame, paths: DataFrame, n: int) -> DataFrame:
    """(id, closeness, harmonic_closeness, eccentricity) from the paths of all sources, normalised; an isolated vertex has no closeness."""
    return normalised_distances(vertices.join(reach(paths), "id", "left"), n)


def normalised_distances(reached: DataFrame, n: int) -> DataFrame:
    """The same from the rows of ``reach``, with nulls for an isolated vertex."""
    return reached.select("id", (F.col("reached") / F.col("total")).alias("closeness"), F.coalesce(F.col("inverse") / (n - 1 if n > 1 else None), F.lit(0.0)).alias("harmonic_closeness"), F.coalesce("eccentricity", F.lit(0)).alias("eccentricity"))


def triangles(edges: DataFrame, degree: DataFrame, chunk: int = NEIGHBOUR_CHUNK) -> DataFrame:
    """(x, y, z) of each triangle once, from intersected neighbour lists.

    Edges point to the end of higher degree, so lists are short: a graph of m edges has none above sqrt(2 m). Each edge
    x -> y meets the lists of its two ends, cut into chunks, by two joins; rows that move are edges and chunks, not
    wedges, and only what two lists share becomes rows.
    """
    a, b = degree.select(F.col("id").alias("src"), F.col("degree").alias("ds")), degree.select(F.col("id").alias("dst"), F.col("degree").alias("dd"))
    ranked = edges.join(a, "src").join(b, "dst")
    forward = F.struct("ds", "src") < F.struct("dd", "dst")
    out = checkpointed(ranked.select(F.when(forward, F.col("src")).otherwise(F.col("dst")).alias("x"), F.when(forward, F.col("dst")).otherwise(F.col("src")).alias("y")))
    whole = out.groupBy("x").agg(F.sort_array(F.collect_list("y")).alias("to"))
    # a chunk of every list holds the same range of its places, so a list is read in pieces of bounded size
    pieces = F.transform(F.sequence(F.lit(1), F.ceil(F.size("to") / chunk).cast("int")), lambda i: F.slice("to", (i - 1) * chunk + 1, chunk))
    lists = checkpointed(whole.select("x", F.explode(pieces).alias("to")))
    one = out.join(lists, "x")
    two = lists.select(F.col("x").alias("y"), F.col("to").alias("also"))
    # chunks whose ranges don't overlap share nothing
    met = one.join(two, "y").where((F.get("to", F.lit(0)) <= F.element_at("also", -1)) & (F.get("also", F.lit(0)) <= F.element_at("to", -1)))
    return met.select("x", "y", F.explode(F.array_intersect("to", "also")).alias("z"))


def clustering(degree: DataFrame, triangle: DataFrame) -> DataFrame:
    """(id, degree, triangles, local_clustering); below two neighbours it is 0."""
    counted = triangle.select(F.explode(F.array("x", "y", "z")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("triangles"))
    k = F.col("degree")
    return degree.join(counted, "id", "left").select("id", "degree", F.coalesce("triangles", F.lit(0)).alias("triangles")).withColumn("local_clustering", F.when(k < 2, F.lit(0.0)).otherwise(2 * F.col("triangles") / (k * (k - 1))))


def transitivity(clustered: DataFrame) -> DataFrame:
    """(triangles, triples, transitivity) of the graph; null without triples."""
    sums = clustered.agg(F.coalesce(F.sum("triangles"), F.lit(0)).alias("corners"), F.coalesce(F.sum(F.expr("degree * (degree - 1) div 2")), F.lit(0)).alias("triples"))
    return sums.select(F.expr("corners div 3").alias("triangles"), "triples", F.when(F.col("triples") > 0, F.col("corners") / F.col("triples")).alias("transitivity"))


def distance_summary(member: DataFrame, paths: DataFrame) -> DataFrame:
    """(vertices, mean_distance, diameter, radius) of the largest component; one vertex has no mean and 0 for both."""
    return summed_distances(member, reach(paths))


def summed_distances(member: DataFrame, reached: DataFrame) -> DataFrame:
    """The same from the rows of ``reach``."""
    far = member.where("in_largest_component").select("id").join(reached, "id", "left").select(F.coalesce("eccentricity", F.lit(0)).alias("e"), "total", "reached")
    return far.agg(F.count(F.lit(1)).alias("vertices"), (F.sum("total") / F.nullif(F.sum("reached"), F.lit(0))).alias("mean_distance"), F.max("e").alias("diameter"), F.min("e").alias("radius"))


def modularity(edges: DataFrame, partition: DataFrame) -> DataFrame:
    """(communities, modularity) of any partition (id, community): sum of L/m - (D/2m)^2."""
    m = edges.agg(F.count(F.lit(1)).alias("m"))
    p1, p2 = partition.select(F.col("id").alias("src"), F.col("community").alias("c1")), partition.select(F.col("id").alias("dst"), F.col("community").alias("c2"))
    both = edges.join(p1, "src").join(p2, "dst")
    inner = both.where("c1 = c2").groupBy(F.col("c1").alias("community")).agg(F.count(F.lit(1)).alias("inside"))
    ends = both.select(F.explode(F.array("c1", "c2")).alias("community")).groupBy("community").agg(F.count(F.lit(1)).alias("ends"))
    all_c = partition.select("community").distinct()
    by_c = all_c.join(inner, "community", "left").join(ends, "community", "left").join(F.broadcast(m))
    share = F.coalesce("inside", F.lit(0)) / F.col("m") - F.pow(F.coalesce("ends", F.lit(0)) / (2 * F.col("m")), F.lit(2))
    return by_c.agg(F.count(F.lit(1)).alias("communities"), F.sum(share).alias("modularity"))


def node_metrics(annotation: DataFrame, member: DataFrame, clustered: DataFrame, central: DataFrame, far: DataFrame, community: DataFrame) -> DataFrame:
    """The sixteen columns of the node table but the score; annotation: id, gene, pvalue, logFC."""
    joined = annotation.join(clustered.select("id", "degree", "local_clustering"), "id").join(central, "id").join(far, "id").join(member, "id").join(community, "id")
    return joined.select(
        "id", "gene", "pvalue", "logFC",
        F.abs("logFC").alias("abs_logFC"),
        (-F.log10(F.greatest("pvalue", F.lit(LEAST_P)))).alias("neg_log10_pvalue"),
        "degree", "betweenness", "closeness", "harmonic_closeness",
        F.col("stress").alias("stress_centrality"),
        "local_clustering", "component", "in_largest_component", "community",
    )


def sizes(vertices: DataFrame, edges: DataFrame, member: DataFrame) -> DataFrame:
    """One row of the counts of a graph: nodes, edges, components, largest_component_nodes and their largest_component_fraction."""
    one = vertices.agg(F.count(F.lit(1)).alias("nodes")).join(F.broadcast(edges.agg(F.count(F.lit(1)).alias("edges"))))
    one = one.join(F.broadcast(component_sizes(member).agg(F.count(F.lit(1)).alias("components"), F.max("size").alias("largest_component_nodes"))))
    return one.withColumn("largest_component_fraction", rounded(F.col("largest_component_nodes") / F.col("nodes"), 4))


def graph_summary(vertices: DataFrame, edges: DataFrame, member: DataFrame, clustered: DataFrame, distance: DataFrame, parts: DataFrame, threshold: int) -> DataFrame:
    """The fourteen (metric, value) rows; parts: communities, modularity."""
    one = (
        sizes(vertices, edges, member)
        .join(F.broadcast(clustered.agg(F.avg("degree").alias("mean_degree"))))
        .join(F.broadcast(transitivity(clustered).select("transitivity")))
        .join(F.broadcast(distance.select("mean_distance", "diameter", "radius")))
        .join(F.broadcast(parts))
    )
    d = lambda c: F.col(c).cast("double")
    # The metrics' names.
    rows = {
        "nodes": d("nodes"), "edges": d("edges"), "components": d("components"),
        "largest_component_nodes": d("largest_component_nodes"), "largest_component_fraction": d("largest_component_fraction"),
        "density": F.when(F.col("nodes") > 1, 2 * d("edges") / (d("nodes") * (d("nodes") - 1))),
        "average_degree": d("mean_degree"), "global_clustering": d("transitivity"),
        "average_shortest_path_lcc": d("mean_distance"), "diameter_lcc": d("diameter"), "radius_lcc": d("radius"),
        "louvain_communities": d("communities"), "louvain_modularity": d("modularity"), "string_score_threshold": F.lit(float(threshold)),
    }
    return one.select(F.explode(F.array(*(F.struct(F.lit(i).alias("position"), F.lit(k).alias("metric"), v.alias("value")) for i, (k, v) in enumerate(rows.items())))).alias("r")).select("r.*")
