"""Mixing sources to target weights by hierarchical budgeting.

Documents are leaves' contents in a domain-language-source tree.  A token
budget is split from the root down by the children's weights.  A child that
has too few tokens gets what it has, and its shortage goes to its siblings; a
node passes on to its own siblings only what none of its descendants can
take.  A leaf's budget is a prefix of its seeded epochs: each epoch orders the
leaf's documents by md5(seed:epoch:doc_id), and documents are taken while the
running token count stays within the budget.

The tree is small (one row a leaf) and is solved on the driver; per document
there is one aggregation by (leaf, key bucket) and a map-side filter.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filigree.llm.common import stored

TOKEN_RE = r"[^ \t\n\r]+"
#: Leaves up to which their table is broadcast; beyond it the join is left to the optimizer.
BROADCAST_LEAVES = 100_000


def split_budget(budget: int, children: Sequence[tuple[str, int, int]]) -> dict[str, int]:
    """Budget of each (name, weight, capacity); whole tokens, rounded down.

    No child gets more than its capacity; what it can't take is shared among
    the others by weight.  A weight of zero or less gets nothing.
    """
    out = {name: 0 for name, _, _ in children}
    left = sorted((c for c in children if c[1] > 0), key=lambda c: (c[2] / c[1], c[0]))
    weight = sum(c[1] for c in left)
    for i, (name, w, capacity) in enumerate(left):
        if capacity * weight > budget * w:
            for other, v, _ in left[i:]:
                out[other] = budget * v // weight
            break
        out[name] = capacity
        budget -= capacity
        weight -= w
    return out


def tree_budgets(tokens: Mapping[tuple[str, ...], int], weights: Mapping[str, int], budget: int, max_epochs: int) -> dict[tuple[str, ...], int]:
    """Budget of each leaf path; weights are by level-prefixed name ("0:web", "1:en"), 1 where absent."""
    depth = len(next(iter(tokens), ()))
    capacity: dict[tuple[str, ...], int] = {}
    children: dict[tuple[str, ...], set[tuple[str, ...]]] = {}

    def weight(path: tuple[str, ...]) -> int:
        return weights.get(f"{len(path) - 1}:{path[-1]}", 1)

    for level in range(depth, -1, -1):
        for leaf, n in tokens.items():
            path = leaf[:level]
            if level == depth:
                capacity[path] = n * max_epochs
            else:
                children.setdefault(path, set()).add(leaf[: level + 1])
        if level < depth:
            for path in {leaf[:level] for leaf in tokens}:
                capacity[path] = sum(capacity[c] for c in children[path] if weight(c) > 0)
    out = {(): min(budget, capacity.get((), 0))}
    for level in range(depth):
        for path in {leaf[:level] for leaf in tokens}:
            shares = split_budget(out[path], [(c[-1], weight(c), capacity[c]) for c in children[path]])
            out |= {(*path, name): share for name, share in shares.items()}
    return {leaf: out[leaf] for leaf in tokens}


def token_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(TOKEN_RE)), F.lit(0)).cast("bigint")


def _key(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def measured(docs: DataFrame, tree: Mapping[str, Column], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the tree's columns (null as '') and n_tokens, stored."""
    levels = [F.coalesce(c.cast("string"), F.lit("")).alias(name) for name, c in tree.items()]
    return stored(docs.select(F.col(doc_id).alias("doc_id"), *levels, token_count(text).alias("n_tokens")), "mixing")


def plan(rows: DataFrame, names: Sequence[str], weights: Mapping[str, int], share: tuple[int, int], max_epochs: int, seed: int) -> DataFrame:
    """One row a leaf: full epochs, and the bucket and key up to which the next epoch is taken."""
    spark = rows.sparkSession
    rows = rows.where("n_tokens > 0")
    totals = {tuple(r[n] for n in names): int(r["t"]) for r in rows.groupBy(*names).agg(F.sum("n_tokens").alias("t")).collect()}
    budget = sum(totals.values()) * share[0] // share[1]
    lines = []
    for leaf, n in tree_budgets(totals, weights, budget, max_epochs).items():
        full = min(n // totals[leaf], max_epochs)
        lines.append((*leaf, full, 0 if full == max_epochs else n - full * totals[leaf]))
    schema = ", ".join(f"`{n}` string" for n in names) + ", full_epochs int, rest bigint"
    leaves = spark.createDataFrame(lines, schema)
    keyed = _with_leaves(rows, leaves, names).withColumn("key", _key(seed, F.col("full_epochs") + 1, F.col("doc_id"))).withColumn("bucket", F.substring("key", 1, 3)).where("rest > 0")
    buckets = keyed.groupBy(*names, "bucket", "rest").agg(F.sum("n_tokens").alias("tokens"))
    upto = F.sum("tokens").over(Window.partitionBy(*names).orderBy("bucket"))
    edge = (
        buckets.withColumn("upto", upto)
        .where("upto > rest and upto - tokens <= rest")
        .select(*names, F.col("bucket").alias("edge"), (F.col("rest") - F.col("upto") + F.col("tokens")).alias("room"))
    )
    edge = stored(edge, "mixing-edge")
    inside = keyed.join(edge, [*names]).where("bucket = edge").withColumn("upto", F.sum("n_tokens").over(Window.partitionBy(*names).orderBy("key"))).where("upto <= room")
    last = inside.groupBy(*names).agg(F.max("key").alias("last_key"))
    return stored(leaves.join(edge.drop("room"), [*names], "left").join(last, [*names], "left"), "mixing-leaves")


def _with_leaves(rows: DataFrame, leaves: DataFrame, names: Sequence[str]) -> DataFrame:
    small = leaves.count() <= BROADCAST_LEAVES
    return rows.join(F.broadcast(leaves) if small else leaves, [*names])


def select(rows: DataFrame, leaves: DataFrame, names: Sequence[str], seed: int, doc_id: str = "doc_id") -> DataFrame:
    """rows, once for each epoch that takes them, with column epoch (from 1)."""
    key = _key(seed, F.col("full_epochs") + 1, F.col(doc_id))
    part = F.coalesce((F.substring(key, 1, 3) < F.col("edge")) | ((F.substring(key, 1, 3) == F.col("edge")) & (key <= F.col("last_key"))), F.lit(False))
    times = F.col("full_epochs") + part.cast("int")
    return _with_leaves(rows, leaves, names).withColumn("times", times).where("times > 0").withColumn("epoch", F.explode(F.sequence(F.lit(1), F.col("times")))).drop("times", "full_epochs", "rest", "edge", "last_key")


def mix(docs: DataFrame, tree: Mapping[str, Column], weights: Mapping[str, int], share: tuple[int, int] = (3, 4), max_epochs: int = 2, seed: int = 17, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with all their columns, once for each epoch that takes them.

    share is the budget as a fraction of all tokens.  Documents without a token
    are never taken.  A null tree value is the name ''.  Rows of equal doc_id
    share a key and are taken or left together.  An empty table gives an empty one.
    """
    columns = docs.columns
    inner = {f"__mix_{i}": c for i, c in enumerate(tree.values())}
    rows = measured(docs, inner, doc_id, text)
    leaves = plan(rows, [*inner], weights, share, max_epochs, seed)
    clean = docs.where(F.col(text).rlike(TOKEN_RE)).select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("__mix_row"),
        F.col(doc_id).alias("__mix_id"),
        *[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in inner.items()],
    )
    return select(clean, leaves, [*inner], seed, "__mix_id").select("__mix_row.*")


#: Production tree and weights of the documents table.
WEIGHTS = {"0:dom0": 4, "0:dom1": 3, "0:dom2": 2, "0:dom3": 1, "1:en": 5, "1:fr": 2, "1:de": 2, "1:es": 1}


def document_tree() -> dict[str, Column]:
    number = F.regexp_extract(F.coalesce(F.col("source"), F.lit("")), "([0-9]+)$", 1)
    domain = F.when(number == "", "other").otherwise(F.concat(F.lit("dom"), (F.expr("try_cast(regexp_extract(source, '([0-9]+)$', 1) as bigint)") % 4).cast("string")))
    return {"domain": domain, "language": F.col("lang"), "origin": F.col("source")}


def mixed_documents(docs: DataFrame, seed: int = 17) -> DataFrame:
    """doc_id, epoch, domain, language, origin and n_tokens of the mixture of the documents table."""
    tree = document_tree()
    rows = measured(docs, tree)
    leaves = plan(rows, [*tree], WEIGHTS, (3, 4), 2, seed)
    return select(rows.where("n_tokens > 0"), leaves, [*tree], seed).select("doc_id", "epoch", *tree, "n_tokens")


def _level_sql(level: int, names: list[str]) -> str:
    """Budgets of one level's nodes from those of the level above."""
    parent, node = ", ".join(names[:level]) or "1", ", ".join(names[: level + 1])
    weight = " ".join(f"when {names[level]} = '{k[2:]}' then {v}" for k, v in WEIGHTS.items() if k.startswith(f"{level}:"))
    weight = f"case {weight} else 1 end" if weight else "1"
    above = f"join b{level - 1} using ({', '.join(names[:level])})" if level else "cross join b_root"
    return f"""
n{level} as (select {node}, sum(cap) as cap, {weight}::hugeint as w from leaf group by {node}),
o{level} as (select *, budget - (sum(cap) over run - cap) as left_b, sum(w) over whole - (sum(w) over run - w) as left_w
  from n{level} {above} window whole as (partition by {parent}), run as (partition by {parent} order by cap::double / w::double, {names[level]} rows unbounded preceding)),
s{level} as (select *, cap * left_w <= left_b * w as sated from o{level}),
t{level} as (select *, max(case when not sated then left_b end) over (partition by {parent}) as bb, max(case when not sated then left_w end) over (partition by {parent}) as ww from s{level}),
b{level} as (select {node}, (case when sated then cap else (bb * w) // ww end)::hugeint as budget from t{level})"""


def mixed_sql(docs: str = "documents", seed: int = 17) -> str:
    """CTEs ending in mixed(doc_id, epoch, domain, language, origin, n_tokens)."""
    names = ["domain", "language", "origin"]
    return f"""
measured as (select doc_id, case when regexp_extract(coalesce(source, ''), '([0-9]+)$', 1) = '' then 'other'
    else 'dom' || (regexp_extract(source, '([0-9]+)$', 1)::bigint % 4)::varchar end as domain, coalesce(lang, '') as language, coalesce(source, '') as origin,
  len(regexp_extract_all(text, '{TOKEN_RE}'))::bigint as n_tokens from {docs} where regexp_matches(text, '{TOKEN_RE}')),
leaf as (select domain, language, origin, sum(n_tokens)::hugeint as tokens, sum(n_tokens)::hugeint * 2 as cap from measured group by all),
b_root as (select least(sum(tokens) * 3 // 4, sum(cap))::hugeint as budget from leaf),
{",".join(_level_sql(i, names) for i in range(3))},
chosen as (select domain, language, origin, tokens, least(budget // tokens, 2) as full_epochs, case when budget // tokens >= 2 then 0 else budget % tokens end as rest
  from leaf join b2 using (domain, language, origin)),
keyed as (select m.*, c.full_epochs, c.rest, md5('{seed}:' || (c.full_epochs + 1)::varchar || ':' || doc_id::varchar) as key
  from measured m join chosen c using (domain, language, origin)),
run as (select *, sum(n_tokens) over (partition by domain, language, origin order by key) <= rest as part from keyed),
mixed as (select doc_id, e::int as epoch, domain, language, origin, n_tokens from (
  select *, unnest(range(1, (full_epochs + part::int + 1)::bigint)) as e from run))"""
