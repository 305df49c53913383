"""Per-campaign decision trees over conversion segments, grown for all campaigns at once.

One scan of the conversions reduces them to cells: (campaign, six features) with the number of
conversions and of high-revenue ones. A tree needs nothing else, so every later step works on
cells. Each level is a fixed piece of relational work for every campaign and node together:

    unpivot features -> count per (node, feature, value) -> running counts by value -> gini gain
    of splitting after each value -> best split per node -> route the cells.

Values split in sorted order ("up to this value" against the rest). Cells and the chosen splits
are written tables, so a level's plan does not contain the levels before it, and routing the cells
broadcasts the splits whenever their files are small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convlens.functions.expr import minute_start, money
from convlens.operators.median import grouped_median
from convlens.operators.patterns import clean_conversions
from convlens.runtime import cut

# Features in their order.
TREE_FEATURES = ["country_code", "device", "os", "browser", "connection_type", "isp"]
MIN_CAMPAIGN = 50  # conversions a campaign needs to be listed
FLOOR = 30  # below this no tree is grown even on request

def _count() -> Column:
    return F.count(F.lit(1))


def _eligible(n: Column, min_samples: int) -> Column:
    return n >= max(min_samples, FLOOR)


def high_revenue_label(conversions: DataFrame) -> DataFrame:
    """Each conversion with its campaign's median revenue and whether it earns more.

    The conversions, which may be a join, are read once and kept by three columns. The medians are one row per campaign variable. As a written table of known size they are
    broadcast when small; when not, a dominant campaign's partition is split.
    """
    rows = cut(clean_conversions(conversions, TREE_FEATURES).select("transaction_id", "custom_var_3", "revenue"))
    medians = cut(grouped_median(rows, ["custom_var_3"], "revenue").drop("n"))
    return rows.join(medians, "custom_var_3").select(
        "transaction_id",
        F.col("custom_var_3").alias("var3"),
        money("revenue").alias("revenue"),
        F.col("median").alias("median_revenue"),
        (money("revenue") > F.col("median")).cast("int").alias("high_revenue"),
    )


def label_encode(conversions: DataFrame, features: list[str] = TREE_FEATURES) -> DataFrame:
    """The code of every feature value: its position among the campaign's sorted values.

    Positions are taken over the distinct values, not over the conversions.
    """
    rows = clean_conversions(conversions, features)
    values = (
        rows.withColumnRenamed("custom_var_3", "var3")
        .select("var3", *features)
        .unpivot(["var3"], features, "feature", "value")
        .groupBy("var3", "feature", "value")
        .agg(_count().alias("conversions"))
    )
    order = Window.partitionBy("var3", "feature").orderBy("value")
    return values.withColumn("code", (F.row_number().over(order) - 1).cast("int"))


def segment_cells(
    conversions: DataFrame, *, min_samples: int = MIN_CAMPAIGN, var3: str | None = None
) -> DataFrame:
    """(var3, features) -> ``n`` conversions, ``h`` of them above the campaign's median."""
    rows = clean_conversions(conversions, TREE_FEATURES).withColumnRenamed("custom_var_3", "var3")
    if var3 is not None:
        rows = rows.filter(F.col("var3") == var3)
    amounts = rows.groupBy("var3", *TREE_FEATURES, "revenue").agg(_count().alias("n"))
    medians = cut(
        grouped_median(amounts, ["var3"], "revenue", weight="n")
        .filter(_eligible(F.col("n"), min_samples))
        .drop("n")
    )
    is_high = money("revenue") > F.col("median")
    return (
        amounts.join(medians, "var3")
        .groupBy("var3", *TREE_FEATURES)
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.when(is_high, F.col("n")).otherwise(F.lit(0))).cast("bigint").alias("h"),
        )
    )


def _gini(h: Column, n: Column) -> Column:
    """Gini impurity of a node times its size."""
    return F.lit(2.0) * h * (n - h) / n


def best_splits(cells: DataFrame, keys: list[str], *, min_leaf: int, min_split: int) -> DataFrame:
    """The best split of each (keys, node), where there is one.

    Equal gains (to nine places) resolve to the first feature name, then the lowest value.
    """
    node = [*keys, "node"]
    counts = (
        cells.select(*node, "n", "h", *TREE_FEATURES)
        .unpivot([*node, "n", "h"], TREE_FEATURES, "feature", "value")
        .groupBy(*node, "feature", "value")
        .agg(F.sum("n").alias("n"), F.sum("h").alias("h"))
    )
    # A window row is one distinct value of one feature in one node.
    whole = Window.partitionBy(*node, "feature")
    order = whole.orderBy("value")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    n, h = F.col("node_n"), F.col("node_h")
    nl, hl = F.col("left_n"), F.col("left_h")
    gain = _gini(h, n) - _gini(hl, nl) - _gini(h - hl, n - nl)
    found = F.struct(
        "feature",
        F.col("value").alias("split_value"),
        "next_value",
        "left_n",
        "left_h",
        "node_n",
        "node_h",
        "gain",
    )
    preference = F.struct(
        (-F.col("gain")).cast("decimal(30,9)").alias("g"), F.col("feature"), F.col("value")
    )
    return (
        counts.select(
            *node,
            "feature",
            "value",
            F.lead("value").over(order).alias("next_value"),
            F.sum("n").over(upto).alias("left_n"),
            F.sum("h").over(upto).alias("left_h"),
            F.sum("n").over(whole).alias("node_n"),
            F.sum("h").over(whole).alias("node_h"),
        )
        .filter((nl >= min_leaf) & (n - nl >= min_leaf) & (n >= min_split) & (h > 0) & (h < n))
        .withColumn("gain", gain)
        .filter(F.col("gain") > 1e-9)
        .groupBy(*node)
        .agg(F.min_by(found, preference).alias("_s"))
        .select(*node, "_s.*")
    )


def route(cells: DataFrame, splits: DataFrame, keys: list[str]) -> DataFrame:
    """Move each cell to its child node; cells of an unsplit node stay."""
    chosen = splits.select(*keys, "node", F.col("feature").alias("_f"), F.col("split_value").alias("_v"))
    value = F.lit(None).cast("string")
    for name in TREE_FEATURES:
        value = F.when(F.col("_f") == name, F.col(name)).otherwise(value)
    child = F.col("node") * 2 + F.when(value <= F.col("_v"), 0).otherwise(1)
    return cells.join(chosen, [*keys, "node"], "left").select(
        *[c for c in cells.columns if c != "node"],
        F.when(F.col("_f").isNull(), F.col("node")).otherwise(child).alias("node"),
    )


def grow(
    cells: DataFrame,
    keys: list[str],
    *,
    max_depth: int = 4,
    min_leaf: int = 10,
    min_split: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Trees for every ``keys`` group: the cells with their leaf, and all splits.

    ``max_depth`` rounds, whatever the number of groups. Node 1 is a root; node m has the
    children 2m and 2m + 1.
    """
    min_split = 2 * min_leaf if min_split is None else min_split
    assigned = cells.withColumn("node", F.lit(1))
    splits = None
    for depth in range(max_depth):
        # Nodes of earlier levels that found no split would find none again.
        level = cut(
            best_splits(
                assigned.filter(F.col("node") >= 2**depth),
                keys,
                min_leaf=min_leaf,
                min_split=min_split,
            )
        )
        assigned = route(assigned, level, keys)
        splits = level if splits is None else splits.unionByName(level)
    return assigned, splits


class SegmentTrees:
    """The grown trees of a set of conversions and the reports read from them."""

    def __init__(
        self,
        conversions: DataFrame,
        *,
        min_samples: int = MIN_CAMPAIGN,
        var3: str | None = None,
        max_depth: int = 4,
        min_leaf: int = 10,
    ):
        self.max_depth, self.min_leaf = max_depth, min_leaf
        self.cells = cut(segment_cells(conversions, min_samples=min_samples, var3=var3))
        self.leaves, self.splits = grow(
            self.cells, ["var3"], max_depth=max_depth, min_leaf=min_leaf
        )

    def nodes(self) -> DataFrame:
        """Every node: its counts and, unless it is a leaf, its split."""
        inner = self.splits.select(
            "var3",
            "node",
            F.col("node_n").alias("samples"),
            F.col("node_h").alias("high_count"),
            "feature",
            "split_value",
            "gain",
        )
        leaves = self.leaf_counts()
        return inner.unionByName(leaves, allowMissingColumns=True).withColumn(
            "is_leaf", F.col("feature").isNull()
        )

    def leaf_counts(self) -> DataFrame:
        return self.leaves.groupBy("var3", "node").agg(
            F.sum("n").alias("samples"), F.sum("h").alias("high_count")
        )

    def importance(self, *, top: int | None = None) -> DataFrame:
        """Share of the impurity decrease per feature; 0 for a feature never used."""
        gains = self.splits.groupBy("var3", "feature").agg(F.sum("gain").alias("_gain"))
        campaigns = self.cells.select("var3").distinct()
        every = campaigns.withColumn(
            "feature", F.explode(F.array(*[F.lit(f) for f in TREE_FEATURES]))
        )
        # Six rows per campaign from here on.
        total = F.sum("_gain").over(Window.partitionBy("var3"))
        share = F.coalesce(F.col("_gain") / F.nullif(total, F.lit(0.0)), F.lit(0.0))
        ranked = (
            every.join(gains, ["var3", "feature"], "left")
            .withColumn("importance", F.round(share.cast("decimal(20,9)"), 6).cast("double"))
            .withColumn(
                "feature_rank",
                F.row_number().over(
                    Window.partitionBy("var3").orderBy(F.desc("importance"), "feature")
                ),
            )
            .drop("_gain")
        )
        return ranked if top is None else ranked.filter(F.col("feature_rank") <= top)

    def _codes(self) -> DataFrame:
        """Sorted position of each feature value in its campaign."""
        values = (
            self.cells.select("var3", *TREE_FEATURES)
            .unpivot(["var3"], TREE_FEATURES, "feature", "value")
            .distinct()
        )
        group = Window.partitionBy("var3", "feature")
        return values.select(
            "*",
            (F.row_number().over(group.orderBy("value")) - 1).alias("code"),
            F.count(F.lit(1)).over(group).alias("classes"),
        )

    def conditions(self) -> DataFrame:
        """The condition that leads into each child node: (var3, child, condition).

        The cut lies half-way between the codes of the two values around it, rounded down, and
        the condition names the first three of *all* the campaign's values on its side, with dots
        if there are more.
        """
        codes = self._codes()
        lower = codes.select("var3", "feature", F.col("value").alias("split_value"), F.col("code").alias("_a"), "classes")
        upper = codes.select("var3", "feature", F.col("value").alias("next_value"), F.col("code").alias("_b"))
        cuts = (
            self.splits.select("var3", "node", "feature", "split_value", "next_value")
            .join(lower, ["var3", "feature", "split_value"])
            .join(upper, ["var3", "feature", "next_value"])
            .withColumn("_cut", F.expr("(_a + _b) div 2"))
        )
        left = cuts.select(
            "var3",
            "feature",
            (F.col("node") * 2).alias("child"),
            F.lit(0).cast("bigint").alias("_from"),
            F.col("_cut").alias("_to"),
        )
        right = cuts.select(
            "var3",
            "feature",
            (F.col("node") * 2 + 1).alias("child"),
            (F.col("_cut") + 1).alias("_from"),
            (F.col("classes") - 1).cast("bigint").alias("_to"),
        )
        shown = F.sequence(F.col("_from"), F.least(F.col("_to"), F.col("_from") + 2))
        named = (
            left.unionByName(right)
            .withColumn("code", F.explode(shown))
            .join(codes.select("var3", "feature", F.col("code").cast("bigint").alias("code"), "value"), ["var3", "feature", "code"])
            .groupBy("var3", "feature", "child", "_from", "_to")
            # At most three values.
            .agg(F.sort_array(F.collect_list(F.struct("code", "value"))).alias("_values"))
        )
        dots = F.when(F.col("_to") - F.col("_from") >= 3, "...").otherwise("")
        return named.select(
            "var3",
            "child",
            F.concat(
                "feature",
                F.lit(" IN ("),
                F.array_join(F.col("_values.value"), ", "),
                dots,
                F.lit(")"),
            ).alias("condition"),
        )

    def rules(
        self, *, good_above: float = 60, bad_below: float = 40, keep: int | None = 5
    ) -> DataFrame:
        """Leaves that are clearly good or bad, as rules; ``keep`` best of each per campaign."""
        # A leaf's path: the node itself and its ancestors below the root.
        depth = F.length(F.bin("node")) - 1
        path = (
            self.leaf_counts()
            .filter((F.col("node") > 1) & (F.col("samples") >= self.min_leaf))
            .withColumn("_up", F.explode(F.sequence(F.lit(0), depth - 1)))
            .withColumn("child", F.expr("shiftright(node, _up)"))
        )
        share = F.lit(100.0) * F.col("high_count") / F.col("samples")
        kind = F.when(share > good_above, "GOOD").when(share < bad_below, "BAD")
        rules = (
            path.join(self.conditions(), ["var3", "child"])
            .groupBy("var3", "node", "samples", "high_count")
            # At most max_depth conditions.
            .agg(F.sort_array(F.collect_list(F.struct("child", "condition"))).alias("_path"))
            .withColumn("type", kind)
            .filter(F.col("type").isNotNull())
            .select(
                "var3",
                "type",
                F.array_join(F.col("_path.condition"), " AND ").alias("rule"),
                share.alias("high_pct"),
                "samples",
                "high_count",
                (F.col("samples") - F.col("high_count")).alias("low_count"),
            )
        )
        strength = F.when(F.col("type") == "GOOD", -F.col("high_pct")).otherwise(F.col("high_pct"))
        order = Window.partitionBy("var3", "type").orderBy(strength, F.desc("samples"), "rule")
        ranked = rules.withColumn("rule_rank", F.row_number().over(order))
        return ranked if keep is None else ranked.filter(F.col("rule_rank") <= keep)


def segment_tree(conversions: DataFrame, **settings) -> DataFrame:
    return SegmentTrees(conversions, **settings).nodes()


def feature_importance(conversions: DataFrame, *, top: int = 3, **settings) -> DataFrame:
    return SegmentTrees(conversions, **settings).importance(top=top)


def segment_rules(conversions: DataFrame, *, keep: int | None = 5, **settings) -> DataFrame:
    return SegmentTrees(conversions, **settings).rules(keep=keep)


def numbered(
    rows: DataFrame, keys: list[str], at: str, row_id: str, *, bucket=minute_start
) -> DataFrame:
    """Number the rows of each ``keys`` group from 0 in (``at``, ``row_id``) order.

    No group is ordered in one task: a row's number is the size of its group's earlier time
    buckets, known from one row per bucket, plus its place in its own bucket. Rows without a time
    come first.
    """
    first = F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")
    placed = rows.withColumn("_bucket", F.coalesce(bucket(at), first))
    earlier = (
        Window.partitionBy(*keys)
        .orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        placed.groupBy(*keys, "_bucket")
        .agg(_count().alias("_size"))
        .select(
            *keys,
            "_bucket",
            F.coalesce(F.sum("_size").over(earlier), F.lit(0).cast("bigint")).alias("_start"),
        )
    )
    order = Window.partitionBy(*keys, "_bucket").orderBy(F.asc_nulls_first(at), row_id)
    return (
        placed.withColumn("_place", F.row_number().over(order))
        .join(starts, [*keys, "_bucket"])
        .withColumn("number", F.col("_start") + F.col("_place") - 1)
        .drop("_bucket", "_place", "_start")
    )


def tree_cv_accuracy(
    conversions: DataFrame,
    *,
    min_samples: int = MIN_CAMPAIGN,
    var3: str | None = None,
    max_depth: int = 4,
    min_leaf: int = 10,
    at: str = "postback_timestamp",
    row_id: str = "transaction_id",
) -> DataFrame:
    """Mean stratified k-fold accuracy of each campaign's tree, k = min(5, n // 10 + 1).

    Folds are dealt in time order within (campaign, label), so each holds its share of both labels.
    The trees of all folds grow together: the fold held out is one more group key of the cells.
    """
    rows = clean_conversions(conversions, TREE_FEATURES).withColumnRenamed("custom_var_3", "var3")
    if var3 is not None:
        rows = rows.filter(F.col("var3") == var3)
    medians = cut(
        grouped_median(rows, ["var3"], "revenue")
        .filter(_eligible(F.col("n"), min_samples))
        .select("var3", "median", F.expr("least(5, n div 10 + 1)").cast("int").alias("folds"))
    )
    labelled = rows.join(medians, "var3").select(
        "var3",
        "folds",
        *TREE_FEATURES,
        at,
        row_id,
        (money("revenue") > F.col("median")).cast("int").alias("label"),
    )
    fold = F.pmod(F.col("number"), F.col("folds")).cast("int")
    cells = cut(
        numbered(labelled, ["var3", "label"], at, row_id)
        .groupBy("var3", "folds", fold.alias("fold"), *TREE_FEATURES)
        .agg(_count().alias("n"), F.sum("label").alias("h"))
    )
    # Every cell takes part once per held-out fold: as a test row of its own, else for training.
    copies = cells.withColumn(
        "held_out", F.explode(F.sequence(F.lit(0), F.col("folds") - 1))
    )
    keys = ["var3", "held_out"]
    training = copies.filter(F.col("fold") != F.col("held_out"))
    testing = copies.filter(F.col("fold") == F.col("held_out")).withColumn("node", F.lit(1))
    leaves, splits = grow(
        training.drop("fold", "folds"), keys, max_depth=max_depth, min_leaf=min_leaf
    )
    for depth in range(max_depth):
        in_level = (F.col("node") >= 2**depth) & (F.col("node") < 2 ** (depth + 1))
        testing = route(testing, splits.filter(in_level), keys)
    verdict = leaves.groupBy(*keys, "node").agg(
        (F.sum("h") * 2 > F.sum("n")).alias("says_high")
    )
    right = F.when(F.col("says_high"), F.col("h")).otherwise(F.col("n") - F.col("h"))
    return (
        testing.join(verdict, [*keys, "node"])
        .groupBy(*keys)
        .agg((F.sum(right).cast("double") / F.sum("n")).alias("_accuracy"))
        .groupBy("var3")
        .agg(
            _count().cast("int").alias("folds"),
            F.round(F.avg("_accuracy").cast("decimal(20,9)"), 6).cast("double").alias("cv_accuracy"),
        )
    )


def ml_summary(
    conversions: DataFrame, *, min_samples: int = MIN_CAMPAIGN, limit: int = 5
) -> DataFrame:
    """Totals over the campaigns analysed, then the best and worst of them by mean revenue."""
    stats = (
        clean_conversions(conversions)
        .groupBy(F.col("custom_var_3").alias("var3"))
        .agg(_count().alias("conversions"), F.sum("revenue").alias("_r"))
        .filter(_eligible(F.col("conversions"), min_samples))
        .withColumn("avg_revenue", money("_r") / F.col("conversions").cast("double"))
    )
    columns = ["section", "var3", "campaigns", "conversions", "total_revenue", "avg_revenue"]

    def listed(section: str, rows: DataFrame) -> DataFrame:
        return rows.limit(limit).select(
            F.lit(section).alias("section"),
            "var3",
            F.lit(1).cast("bigint").alias("campaigns"),
            "conversions",
            money("_r").alias("total_revenue"),
            "avg_revenue",
        )

    totals = stats.agg(
        _count().alias("campaigns"), F.sum("conversions").alias("conversions"), F.sum("_r").alias("_r")
    ).select(
        F.lit("total").alias("section"),
        F.lit(None).cast("string").alias("var3"),
        "campaigns",
        "conversions",
        money("_r").alias("total_revenue"),
        (money("_r") / F.col("conversions").cast("double")).alias("avg_revenue"),
    )
    top = listed("top", stats.orderBy(F.desc("avg_revenue"), "var3"))
    bottom = listed("bottom", stats.orderBy(F.asc("avg_revenue"), F.desc("var3")))
    return totals.unionByName(top).unionByName(bottom).select(*columns)
