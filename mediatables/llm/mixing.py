"""Mixing sources to target weights by hierarchical budgeting.

The token budget flows down a domain - language - source tree. At each node
the children share their parent's budget by weight, none beyond what its
subtree can supply in ``max_epochs`` passes; what a child cannot supply goes
to its siblings first, and only what all of them cannot supply is left for
their parent's siblings. Sharing is one exact integer formula over a window
of siblings sorted by supply per weight, so nothing iterates.

A leaf with budget b and t tokens takes each document b div t times, and of
one more epoch, shuffled by a seeded hash, the longest prefix that stays
within b mod t tokens. The prefix is found by sums over hash buckets first
and by rows inside the one bucket where it ends, so no leaf is ever sorted
as a whole.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, text_of, written

LEAF = ["domain", "lang", "source"]
BUCKET_DOCS = 2048
MISSING = "(none)"


@dataclass(frozen=True)
class Mix:
    """Targets: weights by name, 1 where a name is not listed; 0 drops it."""

    domains: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "web": ("src0", "src1", "src2", "src3"),
        "reference": ("src4", "src5", "src6", "src7", "src8", "src9"),
    })
    other_domain: str = "forum"
    domain_weights: dict[str, int] = field(default_factory=lambda: {"web": 50, "reference": 30, "forum": 20})
    lang_weights: dict[str, int] = field(default_factory=lambda: {"en": 60, "de": 15, "fr": 15, "es": 10})
    source_weights: dict[str, int] = field(default_factory=dict)
    budget_percent: int = 80
    max_epochs: int = 2
    seed: int = 7


def _weight(column: Column, weights: dict[str, int]) -> Column:
    found = F.lit(1)
    for name, weight in weights.items():
        found = F.when(column == name, F.lit(weight)).otherwise(found)
    return found.cast("decimal(38,0)")


def _domain(source: Column, mix: Mix) -> Column:
    found = F.lit(mix.other_domain)
    for name, sources in mix.domains.items():
        found = F.when(source.isin(*sources), F.lit(name)).otherwise(found)
    return found


def _keys(mix: Mix, lang_col: str, source_col: str) -> list[Column]:
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(MISSING))
    source = F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit(MISSING))
    return [_domain(source, mix).alias("domain"), lang.alias("lang"), source.alias("source")]


def share(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Add ``alloc``: each node's part of its parent's ``budget``.

    ``nodes`` has decimal columns cap, weight and budget (equal among
    siblings). In order of cap per weight, a node is full if its cap is
    within its part of what those before it left.
    """
    ratio = F.when(F.col("weight") > 0, F.col("cap").cast("double") / F.col("weight").cast("double")).otherwise(0.0)
    siblings = Window.partitionBy(*parent)
    ranked = siblings.orderBy("ratio", name)
    before = ranked.rowsBetween(Window.unboundedPreceding, -1)
    onward = ranked.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    d = "decimal(38,0)"
    full = (nodes.withColumn("cap", F.when(F.col("weight") > 0, F.col("cap")).otherwise(F.lit(0).cast(d)))
            .withColumn("ratio", ratio)
            .withColumn("used", F.coalesce(F.sum("cap").over(before), F.lit(0)).cast(d))
            .withColumn("left_weight", F.sum("weight").over(onward).cast(d))
            .withColumn("full", F.expr("cap * left_weight <= weight * (budget - used)")))
    return (full.withColumn("taken", F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(siblings).cast(d))
            .withColumn("open", F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0)).over(siblings).cast(d))
            .withColumn("alloc", F.expr("CASE WHEN full THEN cap ELSE "
                                        "cast((budget - taken) * weight div nullif(open, 0) AS decimal(38,0)) END"))
            .drop("ratio", "used", "left_weight", "full", "taken", "open"))


def leaf_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """Budgets of leaves (domain, lang, source, tokens, n_docs), top down."""
    d = "decimal(38,0)"
    # A leaf below a node of weight 0 can take nothing, so no node counts on it.
    weighted = F.lit(True)
    for key, weights in zip(LEAF, (mix.domain_weights, mix.lang_weights, mix.source_weights)):
        weighted = weighted & (_weight(F.col(key), weights) > 0)
    capped = leaves.withColumn("cap", F.when(weighted, F.col("tokens") * mix.max_epochs).otherwise(0).cast(d))

    def level(keys: list[str], weights: dict[str, int], parents: DataFrame | None) -> DataFrame:
        sums = capped.groupBy(*keys).agg(F.sum("cap").cast(d).alias("cap"), F.sum("tokens").cast(d).alias("tokens"))
        if parents is None:  # the root's budget, over the few domains
            everything = Window.partitionBy()
            total = F.floor(F.sum("tokens").over(everything) * mix.budget_percent / 100).cast(d)
            budgeted = sums.withColumn("budget", F.least(total, F.sum("cap").over(everything).cast(d)))
        else:
            above = parents.select(*keys[:-1], F.col("alloc").alias("budget"))
            budgeted = sums.join(above, keys[:-1])
        return share(budgeted.withColumn("weight", _weight(F.col(keys[-1]), weights)), keys[:-1], keys[-1])

    domains = level(LEAF[:1], mix.domain_weights, None)
    langs = level(LEAF[:2], mix.lang_weights, domains)
    sources = level(LEAF, mix.source_weights, langs)
    return leaves.join(sources.select(*LEAF, F.coalesce(F.col("alloc").cast("long"), F.lit(0)).alias("budget")), LEAF)


def _order_key(mix: Mix, epoch: Column) -> Column:
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(MISSING))
    return F.md5(F.concat_ws(":", F.lit(str(mix.seed)), epoch.cast("string"), name))


def _bucket() -> Column:
    """Buckets in order of the key's first 32 bits."""
    return F.floor(F.conv(F.substring("h", 1, 8), 16, 10).cast("long") * F.col("n_buckets") / F.lit(1 << 32))


def plan(stats: DataFrame, mix: Mix) -> DataFrame:
    """Per leaf: budget, whole epochs, and where the last epoch's prefix ends.

    ``stats`` has domain, lang, source, doc_id and tokens for each document
    and is read three times; it should be a written table.
    """
    leaves = stats.groupBy(*LEAF).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n_docs"))
    t = F.nullif(F.col("tokens"), F.lit(0))
    budgets = written(
        leaf_budgets(leaves, mix).select(
            *LEAF, F.col("tokens").alias("leaf_tokens"), F.col("budget").alias("leaf_budget"),
            F.coalesce(F.floor(F.expr("budget div nullif(tokens, 0)")), F.lit(0)).alias("epochs"),
            F.coalesce(F.col("budget") % t, F.lit(0)).alias("rest"),
            F.greatest(F.lit(1), F.expr(f"n_docs div {BUCKET_DOCS}")).alias("n_buckets")), "mix-budgets")
    partial = budgets.where("rest > 0").select(*LEAF, "epochs", "rest", "n_buckets")
    keyed = (stats.join(partial, LEAF).withColumn("h", _order_key(mix, F.col("epochs")))
             .withColumn("bucket", _bucket()))
    sums = keyed.groupBy(*LEAF, "rest", "bucket").agg(F.sum("tokens").alias("n"))
    run = Window.partitionBy(*LEAF).orderBy("bucket")
    edge = (sums.withColumn("upto", F.sum("n").over(run)).where("upto > rest")
            .groupBy(*LEAF).agg(F.min(F.struct("bucket", (F.col("upto") - F.col("n")).alias("before"))).alias("e"))
            .select(*LEAF, "e.bucket", "e.before"))
    # Documents of one key, such as all without an id, are one row here.
    inside = keyed.join(edge, [*LEAF, "bucket"]).groupBy(*LEAF, "before", "rest", "h").agg(F.sum("tokens").alias("tokens"))
    rows = Window.partitionBy(*LEAF).orderBy("h").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (inside.withColumn("upto", F.col("before") + F.sum("tokens").over(rows)).where("upto <= rest")
           .groupBy(*LEAF).agg(F.max("h").alias("cut")))
    return written(budgets.join(edge.select(*LEAF, F.col("bucket").alias("edge")), LEAF, "left")
                   .join(cut, LEAF, "left"), "mix-plan")


def _copies() -> Column:
    """Whole epochs, and one more for documents within the last prefix."""
    b = F.col("bucket")
    extra = (F.col("rest") > 0) & ((b < F.col("edge")) | ((b == F.col("edge")) & (F.col("h") <= F.col("cut"))))
    return F.col("epochs") + F.when(extra, F.lit(1)).otherwise(F.lit(0))


def _stats(docs: DataFrame, mix: Mix, text_col: str, id_col: str, lang_col: str, source_col: str) -> DataFrame:
    return written(docs.select(
        *_keys(mix, lang_col, source_col), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("tokens")), "mix-stats")


def mix_counts(docs: DataFrame, mix: Mix = Mix(), text_col: str = "text", id_col: str = "doc_id",
               lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per document: its leaf, words, the leaf's words and budget,
    and how many times it is taken.

    Null text has no words; a null language or source is a name of its own;
    rows with the same id are taken alike; an empty table gives no rows;
    extra columns are ignored.
    """
    stats = _stats(docs, mix, text_col, id_col, lang_col, source_col)
    joined = (stats.join(plan(stats, mix), LEAF).withColumn("h", _order_key(mix, F.col("epochs")))
              .withColumn("bucket", _bucket()))
    return joined.select("doc_id", *LEAF, "tokens", "leaf_tokens", "leaf_budget",
                         _copies().cast("long").alias("copies"))


def mixed(docs: DataFrame, mix: Mix = Mix(), text_col: str = "text", id_col: str = "doc_id",
          lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``docs`` with each row as often as the mix takes it; all columns kept."""
    stats = _stats(docs, mix, text_col, id_col, lang_col, source_col)
    rows = docs.select(*_keys(mix, lang_col, source_col), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    joined = (rows.join(plan(stats, mix), LEAF).withColumn("h", _order_key(mix, F.col("epochs")))
              .withColumn("bucket", _bucket()).withColumn("copies", _copies().cast("int")))
    return joined.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")
