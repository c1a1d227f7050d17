"""Tree ensembles as a table of nodes, and scoring with it as one built-in expression.

A node is a row: its tree and number, the feature and the cut it asks for, its two children, the value of a leaf and
the weight of its tree. Fitted boosted trees are read from the folder they were saved in. A committee is an ensemble of
its own kind: a one-cut tree per feature, whose cut is the feature's median and whose leaves are the shares of
positives on either side, all found by grouped aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.drift import unpivot
from tidemark.operators.running import exact_quantiles
from tidemark.operators.skew import join_group_values
from tidemark.session import materialized

NODES = (
    "tree int, node int, feature string, cut double, below int, above int, leaf double, weight double"
)
MEAN, LOGISTIC = "mean", "logistic"


def saved_nodes(spark: SparkSession, path: str, features: list[str]) -> DataFrame:
    """The nodes of boosted trees saved at ``path``."""
    rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    weights = spark.read.parquet(f"{path}/treesMetadata").select(F.col("_1").alias("treeID"), F.col("_3").alias("weight"))
    inner = F.col("leftChild") >= 0
    names = F.array(*[F.lit(f) for f in features])
    return rows.join(weights, "treeID").select(
        F.col("treeID").alias("tree"),
        F.col("id").alias("node"),
        F.when(inner, F.get(names, F.col("split.featureIndex"))).alias("feature"),
        F.when(inner, F.col("split.leftCategoriesOrThreshold")[0]).alias("cut"),
        F.when(inner, F.col("leftChild")).alias("below"),
        F.when(inner, F.col("rightChild")).alias("above"),
        F.when(~inner, F.col("prediction")).alias("leaf"),
        "weight",
    )


def committee(train: DataFrame, features: list[str], label: str = "label") -> DataFrame:
    """The nodes of a committee fitted on ``train``, and the ``gain`` of each tree.

    One pass for all medians, one for all leaves. Rows without a feature are left out of its tree; a side without
    rows has the share of the whole. ``gain`` is what the cut takes off the label's variance.
    """
    rows = unpivot(train, [label], features).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    rows = materialized(rows, "committee")
    cuts = exact_quantiles(rows, "value", [0.5], ["feature"], alias="q").select("feature", F.col("q")[0].alias("cut"))
    cuts = materialized(cuts, "medians")
    sides = join_group_values(rows, cuts, ["feature"], "medians")
    below, positive = F.col("value") <= F.col("cut"), F.col(label) == 1
    counts = sides.groupBy("feature").agg(
        F.first("cut").alias("cut"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(positive).alias("pos"),
        F.count_if(below).alias("n_below"),
        F.count_if(below & positive).alias("pos_below"),
    )
    share = lambda pos, n: pos.cast("double") / F.nullif(n.cast("double"), F.lit(0.0))
    whole = share(F.col("pos"), F.col("n"))
    low = F.coalesce(share(F.col("pos_below"), F.col("n_below")), whole)
    high = F.coalesce(share(F.col("pos") - F.col("pos_below"), F.col("n") - F.col("n_below")), whole)
    off = lambda leaf, n: n.cast("double") * (leaf - whole) * (leaf - whole)
    gain = (off(low, F.col("n_below")) + off(high, F.col("n") - F.col("n_below"))) / F.col("n").cast("double")
    numbers = F.create_map(*[x for i, f in enumerate(features) for x in (F.lit(f), F.lit(i))])
    none = lambda kind: F.lit(None).cast(kind)

    def node(number: int, feature: Column, cut: Column, below: Column, above: Column, leaf: Column) -> Column:
        parts = (F.lit(number), feature, cut, below, above, leaf)
        return F.struct(*[p.alias(c) for p, c in zip(parts, ("node", "feature", "cut", "below", "above", "leaf"))])

    root = node(0, F.col("feature"), F.col("cut"), F.lit(1), F.lit(2), none("double"))
    leaves = [node(i, none("string"), none("double"), none("int"), none("int"), leaf) for i, leaf in ((1, low), (2, high))]
    each = F.array(root, *leaves)
    return counts.select(F.element_at(numbers, F.col("feature")).alias("tree"), gain.alias("gain"), F.inline(each)).select(
        "tree", "node", "feature", "cut", "below", "above", "leaf", F.lit(1.0 / len(features)).alias("weight"), "gain"
    )


def score_column(nodes: DataFrame, link: str) -> Column:
    """The ensemble as one expression over the feature columns: nothing is looked up, no row leaves the engine.

    The nodes are a model, a few thousand rows whatever was scored or learned from, and are read once. A missing
    feature goes to the upper side, as every comparison with it fails.
    """
    found = {(r["tree"], r["node"]): r for r in nodes.select(*[c.split()[0] for c in NODES.split(", ")]).collect()}
    trees = sorted({tree for tree, _ in found})

    def walk(tree: int, number: int) -> Column:
        row = found[tree, number]
        if row["feature"] is None:
            return F.lit(float(row["leaf"]))
        low, high = walk(tree, row["below"]), walk(tree, row["above"])
        return F.when(F.col(row["feature"]) <= F.lit(float(row["cut"])), low).otherwise(high)

    total = F.lit(0.0)
    for tree in trees:
        total = total + F.lit(float(found[tree, 0]["weight"])) * walk(tree, 0)
    if link == MEAN:
        return total
    if link == LOGISTIC:
        return 1.0 / (1.0 + F.exp(-2.0 * total))
    raise ValueError(f"unknown link {link!r}")


def register_nodes(nodes: DataFrame, root: str, version: str, link: str, thresholds: tuple[float, float]) -> None:
    """Saves the nodes, then the card: a run that breaks off leaves a version that nobody can load."""
    nodes.select(*[c.split()[0] for c in NODES.split(", ")]).write.mode("overwrite").parquet(f"{root}/nodes/version={version}")
    low, high = (F.lit(float(t)) for t in thresholds)
    card = nodes.sparkSession.range(1).select(F.lit(link).alias("link"), low.alias("t_low"), high.alias("t_high"))
    card.write.mode("overwrite").parquet(f"{root}/node_cards/version={version}")


def load_nodes(spark: SparkSession, root: str, version: str) -> tuple[DataFrame, str, tuple[float, float]]:
    """The nodes, link and thresholds of a registered version."""
    card = spark.read.parquet(f"{root}/node_cards/version={version}").first()
    nodes = spark.read.schema(NODES).parquet(f"{root}/nodes/version={version}")
    return nodes, card["link"], (card["t_low"], card["t_high"])
