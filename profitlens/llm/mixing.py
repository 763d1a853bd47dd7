"""Mixing sources to target weights: budgets go down a tree of levels, token prefixes of seeded epochs fill the leaves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from profitlens.llm._common import WORD, join_on, staged

WIDE = "decimal(38,0)"
SLICE_DIGITS = 2  # a leaf's seeded order is cut into 16 ** 2 slices, and the slice in which its prefix ends
SLICE_STEPS = 3   # once more, so often: only a 16 ** 6th of a leaf is ordered row by row


def count_tokens(text: Column) -> Column:
    """Tokens of a whole text: its words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(children: DataFrame, parent: list[str]) -> DataFrame:
    """children: parent columns, ``budget`` (of the parent), ``weight`` (whole number), ``capacity``, any others.
    Adds ``share``: the budget in proportion to the weights; what a child can't take goes to its siblings in proportion
    to theirs, round by round, until it is used up or every sibling is full. Exact whole numbers (rounded down).

    Each round is an aggregate over the siblings, joined back, so siblings never have to meet in one task; a round that
    fills no further child is the last."""
    cur = staged(children.withColumn("full", F.col("weight") <= 0), "mix-round")
    while True:
        rest = cur.groupBy(*parent).agg(
            F.sum(F.when(F.col("full"), F.when(F.col("weight") > 0, F.col("capacity")).otherwise(0)).otherwise(0))
            .cast(WIDE).alias("__used"),
            F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0)).cast(WIDE).alias("__open"))
        both = join_on(cur, rest, parent)
        left = F.greatest(F.col("budget").cast(WIDE) - F.col("__used"), F.lit(0).cast(WIDE))
        # weights and token counts stay below 2^62, products are compared as decimals of 38 digits
        fills = ~F.col("full") & (F.col("capacity").cast("decimal(19,0)") * F.col("__open").cast("decimal(18,0)")
                                  <= left.cast("decimal(19,0)") * F.col("weight").cast("decimal(18,0)"))
        new = staged(both.withColumn("__fills", fills).withColumn("__left", left), "mix-round")
        if new.where("__fills").isEmpty():
            break
        cur = new.withColumn("full", F.col("full") | F.col("__fills")).select(*cur.columns)
    part = F.expr("(cast(__left as decimal(19,0)) * cast(weight as decimal(18,0))) div cast(__open as decimal(18,0))")
    return new.withColumn("share", F.when(F.col("weight") <= 0, 0).when(F.col("full"), F.col("capacity"))
                          .otherwise(part).cast("long")).drop("full", "__fills", "__left", "__used", "__open")


def tree_budgets(leaves: DataFrame, levels: list[str], weights: list[Column], budget: Column) -> DataFrame:
    """leaves: the level columns and ``capacity`` (tokens a leaf can give). Adds ``budget``: its share of the total.

    ``weights[i]`` is the weight, a whole number, of a node of level i among its siblings, as an expression over
    levels[: i + 1]. A budget goes down level by level; a node's capacity is that of the leaves below it, so a shortage
    is first made up by siblings, and by the siblings of an ancestor only when all below that ancestor is used up."""
    total = F.sum("capacity").cast("long").alias("capacity")
    leaves = staged(leaves.withColumn("__root", F.lit(0)), "mix-tree")  # a plain column: the join is one on a key
    parents = leaves.groupBy("__root").agg(total).select("__root", budget.cast("long").alias("budget"))
    for i, name in enumerate(levels):
        up, own = ["__root", *levels[:i]], ["__root", *levels[:i + 1]]
        nodes = leaves.groupBy(*own).agg(total).withColumn("weight", F.coalesce(weights[i].cast("long"), F.lit(0)))
        done = water_fill(join_on(nodes, parents, up), up)
        parents = done.select(*own, F.col("share").alias("budget"))
    return parents.drop("__root")


def mix(docs: DataFrame, levels: list[str], weights: list[Column], budget: Column, max_epochs: int = 2,
        seed: int = 7, others: tuple[str, ...] = ()) -> DataFrame:
    """docs: doc_id, tokens (long), the level columns and ``others``, which are kept. Returns a row for each document and epoch in the mix: doc_id,
    the levels, tokens, epoch (from 0) and take_tokens, the tokens used (fewer than tokens only for the last of a leaf).

    ``budget`` is an expression over ``capacity``, all tokens there are (for ``max_epochs`` epochs). A leaf's stream is
    its documents in the order of md5(seed:epoch:doc_id), epoch after epoch, at most ``max_epochs`` times; the mix takes
    the prefix of the stream that has the leaf's budget of tokens.
    The order is cut into slices by the hash: their sums give each slice's place in the stream, whole slices need no
    order, and the slice in which the prefix ends is cut again, until only a small part of it is ordered row by row. No
    leaf, however large, meets in one task.
    Null levels are nodes of their own; a null doc_id is ordered as an empty one; null tokens count as 0. Documents
    without tokens are never taken. Ties (repeated rows) are ordered by doc_id, then tokens, then ``others``. Empty table: no rows."""
    docs = docs.withColumn("tokens", F.coalesce("tokens", F.lit(0)).cast("long"))
    leaves = staged(docs.groupBy(*levels).agg(F.sum("tokens").alias("__size")), "mix-leaves")
    budgets = tree_budgets(leaves.withColumn("capacity", F.col("__size") * max_epochs), levels, weights, budget)
    plan = staged(join_on(leaves, budgets, levels).where("__size > 0").select(
        *levels, F.expr("budget div __size").cast("int").alias("__whole"),
        (F.col("budget") % F.col("__size")).alias("__rest")), "mix-plan")
    own = join_on(docs.where("tokens > 0").select("doc_id", *levels, "tokens", *others), plan, levels)
    whole = own.where("__whole > 0").select(
        "doc_id", *levels, "tokens", *others, F.explode(F.sequence(F.lit(0), F.col("__whole") - 1)).alias("epoch"),
        F.col("tokens").alias("take_tokens"))
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("__whole").cast("string"),
                              F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    cols = ["doc_id", *levels, "tokens", *others, F.col("__whole").alias("epoch"), "take_tokens"]
    out = whole
    part = own.where("__rest > 0").withColumn("__h", order)
    before = Window.partitionBy(*levels).orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    for step in range(SLICE_STEPS):
        part = part.withColumn("__s", F.substring("__h", 1 + step * SLICE_DIGITS, SLICE_DIGITS))
        slices = (part.groupBy(*levels, "__s").agg(F.sum("tokens").alias("__n"))  # at most 16 ** 2 rows a leaf
                  .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))))
        placed = join_on(part, slices, [*levels, "__s"]).where(F.col("__before") < F.col("__rest"))
        ends = F.col("__before") + F.col("__n") > F.col("__rest")
        out = out.unionByName(placed.where(~ends).withColumn("take_tokens", F.col("tokens")).select(*cols))
        part = placed.where(ends).withColumn("__rest", F.col("__rest") - F.col("__before")).drop(
            "__s", "__n", "__before")
        if step + 1 < SLICE_STEPS:
            part = staged(part, "mix-slice")  # one slice of a leaf
    running = (Window.partitionBy(*levels).orderBy("__h", "doc_id", "tokens", *others)
               .rowsBetween(Window.unboundedPreceding, -1))
    cut = (part.withColumn("__at", F.coalesce(F.sum("tokens").over(running), F.lit(0)))
           .where(F.col("__at") < F.col("__rest"))
           .withColumn("take_tokens", F.least(F.col("tokens"), F.col("__rest") - F.col("__at"))))
    return out.unionByName(cut.select(*cols))


# ---- the production mix of the tables: domains of sources, then languages, then sources

DOMAINS = ("web", "news", "books", "forum")
DOMAIN_WEIGHTS = {"web": 40, "books": 30, "news": 20, "forum": 10}
LANG_WEIGHTS = {"en": 50, "de": 20, "fr": 20, "es": 10}
OTHER_WEIGHT = 5
BUDGET_PCT = 50    # tokens of the mix, in percent of the corpus
MAX_EPOCHS = 3
LEVELS = ["domain", "lang", "source"]


def _by_name(col: str, table: dict[str, int]) -> Column:
    out = F.lit(OTHER_WEIGHT)
    for name, w in table.items():
        out = F.when(F.col(col) == name, w).otherwise(out)
    return out


def leaf_columns() -> list[Column]:
    """domain (by the source's number; ``other`` without one), lang and source; nulls become ``und``, ``unknown``."""
    number = F.regexp_extract(F.col("source").cast("string"), r"([0-9]{1,9})$", 1)
    known = F.element_at(F.array(*map(F.lit, DOMAINS)), (number.cast("int") % len(DOMAINS) + 1).cast("int"))
    return [F.when(F.coalesce(number, F.lit("")) == "", "other").otherwise(known).alias("domain"),
            F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
            F.coalesce(F.col("source").cast("string"), F.lit("unknown")).alias("source")]


def mix_documents(documents: DataFrame, budget_pct: int = BUDGET_PCT, max_epochs: int = MAX_EPOCHS,
                  seed: int = 7, others: tuple[str, ...] = ()) -> DataFrame:
    """The production mix of a documents table; see ``mix``."""
    docs = staged(documents.select("doc_id", *leaf_columns(), count_tokens(F.col("text")).alias("tokens"), *others), "mix-docs")
    weights = [_by_name("domain", DOMAIN_WEIGHTS), _by_name("lang", LANG_WEIGHTS), F.lit(1)]
    budget = F.expr(f"capacity div {max_epochs} * {budget_pct} div 100")
    return mix(docs, LEVELS, weights, budget, max_epochs, seed, others)


def apply_mix(documents: DataFrame, **options) -> DataFrame:
    """The documents of the production mix with all their columns, a row for each epoch. A leaf's last document is cut
    to its first tokens (joined by single spaces) and n_chars, if there, follows the text.

    The documents are written with a digest of the text and a number, which say what was taken: rows without an id, or
    with a repeated one, are documents of their own, so the mix keeps its budget. Rows of one id and number of tokens
    are ordered by the digest; those equal in it too are alike, and any of them comes first."""
    cols = documents.columns
    digest = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)
    own = staged(documents.withColumns({"__key": digest, "__row": F.monotonically_increasing_id()}), "mix-rows")
    taken = mix_documents(own, others=("__key", "__row"), **options).select(
        F.col("__row").alias("__own"), F.col("tokens").alias("__tokens"), F.col("take_tokens").alias("__take"))
    joined = own.join(taken, own["__row"] == taken["__own"])
    words = F.split(F.regexp_replace("text", r"^[\x20\x09-\x0D]+", ""), r"[\x20\x09-\x0D]+")
    text = F.when(F.col("__take") < F.col("__tokens"),
                  F.array_join(F.slice(words, F.lit(1), F.col("__take").cast("int")), " ")).otherwise(F.col("text"))
    joined = joined.withColumn("text", text)
    if "n_chars" in cols:
        kind: T.DataType = documents.schema["n_chars"].dataType
        joined = joined.withColumn("n_chars", F.length("text").cast(kind))
    return joined.select(*cols)
