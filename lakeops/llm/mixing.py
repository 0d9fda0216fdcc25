"""Mixing sources to target weights, by hierarchical budgeting.

A token budget goes down a tree of domain, language and source. Each node
shares its budget among its children by their weights; a child whose subtree
holds less than its share gets what it holds, and its siblings share the
shortage by their weights. Only what all siblings together cannot take has made
their parent smaller, so a shortage is redistributed among siblings before
ancestors. A leaf holds its tokens once per epoch, up to ``max_epochs``.

A leaf with budget B and T tokens gives B div T whole epochs and the token-prefix
of B mod T tokens of the next one, in that epoch's seeded order (an MD5 of
seed, epoch and document id). The end of the prefix is found by counting tokens
by the order key's leading digits, two at a time, then ordering the few rows
that share all of them, so no leaf is ever sorted or held by one task. Tokens
are words (runs without ASCII white space).

Defined cases: NULL language or source is the leaf part ``none``; a NULL text
has no tokens; a NULL id is ordered as the text ``null``; rows that repeat an
id share its place in the order and start at the same token; nodes without
weight in the table weigh 1, nodes of weight 0 get nothing; budgets are
rounded down at every node, so less than one token per node is left over; an
empty table gives no rows; other columns are carried along by ``mixed``."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import WORD, written

LEVELS = ("domain", "lang", "source")
DIGITS, ROUNDS = 2, 3       # hex digits of the order key that a counting round settles, and rounds


def tokens_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def domain_of(source: Column) -> Column:
    """Four domains from the number that ends a source's name."""
    number = F.regexp_extract(source, "([0-9]+)$", 1).try_cast("bigint")
    return F.coalesce(F.concat(F.lit("domain"), (number % 4).cast("string")), F.lit("none"))


def with_leaf(docs: DataFrame) -> DataFrame:
    """Add the leaf's parts as ``_domain``, ``_lang`` and ``_source``."""
    return (docs.withColumn("_domain", domain_of(F.col("source")))
            .withColumn("_lang", F.coalesce("lang", F.lit("none")))
            .withColumn("_source", F.coalesce("source", F.lit("none"))))


def weight_of(level: str, weights: dict[str, dict[str, int]]) -> Column:
    """The weight of a node, from a small table of whole numbers."""
    own = weights.get(level, {})
    if not own:
        return F.lit(1)
    table = F.create_map(*chain.from_iterable((F.lit(k), F.lit(int(v))) for k, v in own.items()))
    return F.coalesce(table[F.col(f"_{level}")], F.lit(1))


def shared(nodes: DataFrame, parents: list[str]) -> DataFrame:
    """``nodes`` (parents, node, cap, weight, budget of the parent) with the
    budget replaced by the node's own. In the order of cap / weight the nodes
    are filled as long as the level that the rest could reach lies above them;
    whole numbers only."""
    big = "decimal(38,0)"
    by = Window.partitionBy(*parents)
    order = by.orderBy(F.col("cap") / F.col("weight"), F.col("cap")).rowsBetween(Window.unboundedPreceding, -1)
    cap, weight = F.col("cap").cast(big), F.col("weight").cast(big)
    full = cap * F.col("_from") <= weight * (F.col("budget").cast(big) - F.col("_before"))
    return (nodes.where("weight > 0")
            .withColumn("_before", F.coalesce(F.sum("cap").over(order), F.lit(0)).cast(big))
            .withColumn("_from", (F.sum("weight").over(by)
                                  - F.coalesce(F.sum("weight").over(order), F.lit(0))).cast(big))
            .withColumn("_full", full)
            .withColumn("_held", F.sum(F.when(F.col("_full"), F.col("cap")).otherwise(0)).over(by))
            .withColumn("_open", F.sum(F.when(F.col("_full"), 0).otherwise(F.col("weight"))).over(by))
            .withColumn("budget", F.when(F.col("_full"), F.col("cap")).otherwise(F.expr(
                f"cast(weight as {big}) * cast(budget - _held as {big}) div _open")).cast("long"))
            .drop("_before", "_from", "_full", "_held", "_open"))


def leaf_budgets(leaves: DataFrame, weights, target: tuple[int, int], max_epochs: int) -> DataFrame:
    """``leaves`` (_domain, _lang, _source, tokens) with ``budget``: the corpus'
    tokens times ``target`` (a fraction), at most what all leaves hold."""
    leaves = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    up, down = target
    root = leaves.agg(F.least(F.expr(f"sum(tokens) * {int(up)} div {int(down)}"), F.sum("cap")).alias("budget"))
    names, out = [f"_{x}" for x in LEVELS], root
    for i, level in enumerate(LEVELS):
        nodes = leaves.groupBy(*names[:i + 1]).agg(F.sum("cap").alias("cap"))
        nodes = nodes.withColumn("weight", weight_of(level, weights))
        nodes = nodes.join(out, names[:i]) if i else nodes.crossJoin(out)    # the root is one row
        out = shared(nodes, names[:i]).select(*names[:i + 1], "budget")
    return leaves.join(out, names).drop("cap")


def order_key(seed: str) -> Column:
    """The place of a row in its leaf's partial epoch."""
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    return F.md5(F.concat_ws(":", F.lit(seed), F.col("whole_epochs").cast("string"), doc))


def mixing_plan(rows: DataFrame, weights, target, max_epochs: int, seed: str) -> DataFrame:
    """A row per leaf: whole_epochs, rest (tokens of the partial epoch),
    cut_key (the last key of the prefix, NULL if there is none) and cut_before
    (tokens ahead of it). ``rows``: (doc_id, leaf parts, tokens), written."""
    leaf = [f"_{x}" for x in LEVELS]
    leaves = leaf_budgets(rows.groupBy(*leaf).agg(F.sum("tokens").alias("tokens")), weights, target, max_epochs)
    plan = written(leaves.select(
        *leaf, F.expr("if(tokens > 0, budget div tokens, 0)").alias("whole_epochs"),
        F.expr("if(tokens > 0, budget % tokens, 0)").alias("rest")), "leaf-budgets")
    near = (rows.join(plan.where("rest > 0"), leaf).withColumn("key", order_key(seed))
            .withColumn("before", F.lit(0).cast("long")))
    by = Window.partitionBy(*leaf).orderBy("digits").rowsBetween(Window.unboundedPreceding, -1)
    for r in range(ROUNDS):
        near = near.withColumn("digits", F.substring("key", r * DIGITS + 1, DIGITS))
        cut = (near.groupBy(*leaf, "digits", "rest", "before").agg(F.sum("tokens").alias("n"))
               .withColumn("here", F.col("before") + F.coalesce(F.sum("n").over(by), F.lit(0)))
               .where("here < rest and here + n >= rest").select(*leaf, "digits", "here"))
        near = (near.join(written(cut, "cut-digits"), [*leaf, "digits"])
                .withColumn("before", F.col("here")).drop("here", "digits"))
    keys = near.groupBy(*leaf, "key", "rest", "before").agg(F.sum("tokens").alias("n"))
    running = Window.partitionBy(*leaf).orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    cut = (keys.withColumn("at", F.col("before") + F.coalesce(F.sum("n").over(running), F.lit(0)))
           .where("at < rest").groupBy(*leaf)
           .agg(F.max("key").alias("cut_key"), F.max_by("at", "key").alias("cut_before")))
    return written(plan.join(cut, leaf, "left"), "mixing-plan")


def taken(df: DataFrame, plan: DataFrame, seed: str) -> DataFrame:
    """``df`` (doc_id, leaf parts, ...) with a row per chosen epoch: ``epoch``,
    ``_cut`` (its key is the prefix's last) and the plan's columns. The plan is
    small and written, so its size decides how it is joined."""
    leaf = [f"_{x}" for x in LEVELS]
    key = order_key(seed)
    partial = F.coalesce(key <= F.col("cut_key"), F.lit(False))
    last = F.col("whole_epochs") - F.when(partial, 0).otherwise(1)
    return (df.join(plan, leaf)
            .withColumn("_cut", F.coalesce(key == F.col("cut_key"), F.lit(False)))
            .withColumn("epoch", F.explode(F.when(last >= 0, F.sequence(F.lit(0).cast("long"), last))
                                           .otherwise(F.array().cast("array<bigint>")))))


def counted(docs: DataFrame) -> DataFrame:
    leaf = [f"_{x}" for x in LEVELS]
    return written(with_leaf(docs.select("doc_id", "lang", "source", tokens_of(F.col("text")).alias("tokens")))
                   .select("doc_id", *leaf, "tokens"), "token-counts")


# Production weights and target of the query and the pipeline.
WEIGHTS = {"domain": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1},
           "lang": {"en": 5, "de": 2, "fr": 2, "es": 1}}
TARGET, MAX_EPOCHS, SEED = (3, 5), 2, "mix"


def mixture(docs: DataFrame, weights=WEIGHTS, target=TARGET, max_epochs: int = MAX_EPOCHS,
            seed: str = SEED) -> DataFrame:
    """(doc_id, domain, lang, source, epoch, tokens, taken): every chosen
    document of every epoch, with the tokens that lie within its leaf's budget."""
    rows = counted(docs)
    out = taken(rows, mixing_plan(rows, weights, target, max_epochs, seed), seed)
    within = F.col("_cut") & (F.col("epoch") == F.col("whole_epochs"))
    return out.select("doc_id", *[F.col(f"_{x}").alias(x) for x in LEVELS], "epoch", "tokens",
                      F.when(within, F.least("tokens", F.col("rest") - F.col("cut_before")))
                      .otherwise(F.col("tokens")).alias("taken"))


def mixed(docs: DataFrame, weights=WEIGHTS, target=TARGET, max_epochs: int = MAX_EPOCHS,
          seed: str = SEED) -> DataFrame:
    """The chosen documents themselves, whole, once per chosen epoch, with the
    columns of ``docs``. No text is shuffled."""
    plan = mixing_plan(counted(docs), weights, target, max_epochs, seed)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    return taken(with_leaf(docs.select(row, "doc_id", "lang", "source")), plan, seed).select("_row.*")
