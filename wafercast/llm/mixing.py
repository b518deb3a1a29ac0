"""Operator 6: mixing sources to target weights by hierarchical budgeting.

The tree is domain -> language -> source.  Weights are integers; a node's
share of its parent's token budget is its weight over its siblings' sum.

* Capacity of a leaf: its tokens times ``max_epochs``; of a node: the sum below.
* Budgets go down level by level.  A child that cannot use its share gets its
  capacity, and what it leaves is shared among its siblings by their weights;
  only what a whole family cannot use has gone, one level up, to the family's
  own siblings.  This is water-filling: children ordered by capacity / weight
  are full up to a point that a running sum finds, so no loop is needed.
  Shares are whole tokens; what rounding leaves goes to the first children.
* A leaf with budget b and T tokens takes b // T whole epochs and a prefix of
  one more: documents in the order of ``md5(seed|epoch|doc_id)`` while their
  running tokens fit.

Only (doc_id, language, source, tokens) is shuffled, no text.  The running
sum inside a leaf has two levels (sums of 4,096 hash buckets, then rows inside
a bucket), so a source with a third of all rows is no single task.

Edge cases: null language or source is the node ``none``; a node without a
given weight has ``default_weight``; documents without tokens are never
selected; a leaf whose first document is longer than its budget takes none;
repeated rows of a doc_id are neighbours in the order; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, read_table, shared_table, text_or_empty, without_listed

#: The first hex digit of md5(source) names the domain.
DOMAINS = (("0123", "web"), ("4567", "books"), ("89ab", "reference"), ("cdef", "forums"))


@dataclass(frozen=True)
class Mix:
    """Production parameters: the budget as a fraction of all tokens in
    thousandths, weights by node name, repeats allowed, seed."""

    budget_permille: int = 800
    max_epochs: int = 2
    seed: int = 17
    default_weight: int = 10
    domains: dict[str, int] = field(default_factory=lambda: {"web": 30, "books": 35, "reference": 25, "forums": 10})
    langs: dict[str, int] = field(default_factory=lambda: {"en": 50, "de": 20, "fr": 20, "es": 10})
    sources: dict[str, int] = field(default_factory=dict)


LEVELS = ("domain", "lang", "source")


def _case(col: str, values: dict[str, int], default: int) -> str:
    arms = "".join(f" when {col} = '{k}' then {v}" for k, v in values.items())
    return f"cast(case{arms} else {default} end as bigint)" if arms else f"cast({default} as bigint)"


def _domain(col: str) -> str:
    arms = " ".join(f"when substr(md5({col}), 1, 1) in ({', '.join(repr(c) for c in digits)}) then '{name}'"
                    for digits, name in DOMAINS)
    return f"case {arms} end"


def level_sql(table: str, parents: tuple[str, ...], node: str, weight: str, slash: str) -> str:
    """Budgets of the ``node``s of one level from their parents' budgets, in the
    words that Spark and DuckDB share; ``slash``: whole division."""
    by = f"partition by {', '.join(parents)}" if parents else "partition by 1"
    before = "rows between unbounded preceding and 1 preceding"
    keys = "".join(f"{p}, " for p in parents)
    return f"""
select {keys}{node}, cap, case when full_ = 1 then cap
    else (w * left_) {slash} wleft + case when row_number() over ({by}, full_ order by fill, {node})
         <= left_ - sum((w * left_) {slash} wleft) over ({by}, full_) then 1 else 0 end end as budget
from (
  select *, total - sum(case when full_ = 1 then cap else 0 end) over ({by}) as left_,
         greatest(1, sum(case when full_ = 1 then 0 else w end) over ({by})) as wleft
  from (
    select *, case when cap * (wall - coalesce(sum(w) over ({by} order by fill, {node} {before}), 0))
                   <= w * (total - coalesce(sum(cap) over ({by} order by fill, {node} {before}), 0))
              then 1 else 0 end as full_
    from (
      select *, cap / cast(w as double) as fill, sum(w) over ({by}) as wall
      from (select {keys}{node}, {weight} as w, cap, total from {table}) q0) q1) q2) q3"""


def leaf_budgets(rows: DataFrame, mix: Mix) -> DataFrame:
    """(domain, lang, source, tokens, budget): a row a leaf."""
    leaves = shared_table(rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0")
                          .withColumn("cap", (F.col("tokens") * mix.max_epochs).cast("bigint")), "leaves")
    weights = {"domain": mix.domains, "lang": mix.langs, "source": mix.sources}
    budget = leaves.agg(F.expr(f"least(sum(tokens) * {mix.budget_permille} div 1000, sum(cap))").alias("total"))
    for i, level in enumerate(LEVELS):
        parents = LEVELS[:i]
        nodes = leaves.groupBy(*LEVELS[:i + 1]).agg(F.sum("cap").cast("bigint").alias("cap"))
        nodes = nodes.crossJoin(F.broadcast(budget)) if not parents else nodes.join(
            budget.select(*parents, F.col("budget").alias("total")), list(parents))
        spark, view = rows.sparkSession, f"llm_mix_{level}"
        nodes.createOrReplaceTempView(view)
        budget = shared_table(spark.sql(level_sql(view, parents, level, _case(
            level, weights[level], mix.default_weight), "div")), "budget")
        spark.catalog.dropTempView(view)
    return leaves.join(budget.drop("cap"), list(LEVELS)).select(*LEVELS, "tokens", "budget")


def documents_with_tokens(docs: DataFrame) -> DataFrame:
    words = F.size(F.array_remove(F.split(text_or_empty(), SPACE + "+"), "")).cast("long")
    source = F.coalesce(F.col("source").cast("string"), F.lit("none"))
    return docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("none")).alias("lang"),
                       source.alias("source"), words.alias("n_tokens")).withColumn("domain", F.expr(_domain("source")))


def select_mix(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """A row per selected document and epoch: doc_id, domain, lang, source,
    epoch, n_tokens."""
    rows = shared_table(documents_with_tokens(docs), "mix")
    budgets = shared_table(leaf_budgets(rows, mix), "leaf_budgets")
    plan = budgets.select(*LEVELS, F.expr("budget div tokens").alias("whole"), F.expr("budget % tokens").alias("rest"))
    placed = rows.where("n_tokens > 0").join(plan, list(LEVELS))
    out = ["doc_id", *LEVELS, "epoch", "n_tokens"]
    whole = placed.where("whole > 0").withColumn("epoch", F.explode(F.expr("sequence(0, cast(whole as int) - 1)"))).select(*out)

    key = F.expr(f"md5(concat('{mix.seed}|', whole, '|', coalesce(cast(doc_id as string), '')))")
    part = placed.where("rest > 0").withColumn("key", key).withColumn("bucket", F.substring("key", 1, 3))
    leaf = ", ".join(LEVELS)
    sums = part.groupBy(*LEVELS, "bucket").agg(F.sum("n_tokens").alias("b")).withColumn("before", F.expr(
        f"coalesce(sum(b) over (partition by {leaf} order by bucket rows between unbounded preceding and 1 preceding), 0)"))
    run = (part.join(sums.drop("b"), [*LEVELS, "bucket"]).where("before < rest")
           .withColumn("upto", F.expr(f"before + sum(n_tokens) over (partition by {leaf}, bucket order by key, doc_id, n_tokens "
                                      "rows between unbounded preceding and current row)")))
    rest = run.where("upto <= rest").select("doc_id", *LEVELS, F.col("whole").cast("int").alias("epoch"), "n_tokens")
    return whole.unionByName(rest)


def keep_mix(docs: DataFrame, mix: Mix) -> DataFrame:
    """The rows of ``docs`` whose doc_id a mix without repeats selects; rows
    with a null doc_id are selected together, like rows that share an id."""
    if mix.max_epochs != 1:
        raise ValueError("rows are kept or not: max_epochs must be 1")
    chosen = select_mix(docs, mix).select(F.col("doc_id").alias("_x_id")).distinct()
    ids = docs.select("doc_id").distinct()
    gone = ids.join(chosen, ids["doc_id"].eqNullSafe(F.col("_x_id")), "left_anti")
    return without_listed(docs, "doc_id", shared_table(gone, "gone"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_mix(read_table(spark, sf_dir, "documents"))


def _oracle(mix: Mix = Mix()) -> str:
    weights = {"domain": mix.domains, "lang": mix.langs, "source": mix.sources}
    steps = []
    for i, level in enumerate(LEVELS):
        keys, parents = ", ".join(LEVELS[:i + 1]), LEVELS[:i]
        join = (f"join b_{LEVELS[i - 1]} using ({', '.join(parents)})" if parents else "cross join top")
        total = "budget as total" if parents else "total"
        steps.append(f"n_{level} as (select n.*, {total} from (select {keys}, sum(cap)::bigint as cap from leaves group by {keys}) n "
                     + (f"join (select {', '.join(parents)}, budget from b_{LEVELS[i - 1]}) using ({', '.join(parents)})" if parents else join) + "),\n"
                     f"b_{level} as ({level_sql(f'n_{level}', parents, level, _case(level, weights[level], mix.default_weight), '//')})")
    return rf"""
with d as (select doc_id, coalesce(lang, 'none') as lang, coalesce(source, 'none') as source,
  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as n_tokens from documents),
r as (select *, {_domain("source")} as domain from d),
leaves as (select domain, lang, source, sum(n_tokens)::bigint as tokens, (sum(n_tokens) * {mix.max_epochs})::bigint as cap
  from r group by all having sum(n_tokens) > 0),
top as (select least(sum(tokens)::bigint * {mix.budget_permille} // 1000, sum(cap)::bigint)::bigint as total from leaves),
{", ".join(steps)},
plan as (select domain, lang, source, (budget // tokens)::bigint as whole, (budget % tokens)::bigint as rest
  from leaves join b_source using (domain, lang, source)),
p as (select * from r join plan using (domain, lang, source) where n_tokens > 0),
ord as (select *, sum(n_tokens) over (partition by domain, lang, source
    order by md5('{mix.seed}|' || whole || '|' || doc_id), doc_id rows between unbounded preceding and current row) as upto from p)
select doc_id, domain, lang, source, e::int as epoch, n_tokens from p, range(0, whole) as t(e)
union all
select doc_id, domain, lang, source, whole::int as epoch, n_tokens from ord where upto <= rest
"""


ORACLE = _oracle()
