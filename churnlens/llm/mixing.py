"""Mixing sources to target weights by hierarchical budgets.

The tree is domain > language > source. A node's capacity is the tokens its
leaves hold times the allowed epochs. From the root down, a node's budget is
shared among its children by weight, none beyond its capacity: what a child
can't take goes to its siblings, and only when all of them are full is the node
itself short, which its own level has then already given to its siblings.

A leaf with budget b and a tokens a pass gets floor(b / a) whole epochs; of the
next epoch, a prefix in the order of md5(seed:epoch:id), up to and including
the row that reaches the budget. The prefix sum runs over buckets of that
order, then within the one bucket where the budget ends, so no window spans a
leaf. Budgets are computed on the table of leaves only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.common import written

LEVELS = ("domain", "lang", "source")
#: Rows a bucket of the prefix sum holds on average; digits of md5 that order buckets.
BUCKET, DIGITS = 4096, 8


def _weight(weights: Mapping[str, Mapping[str, float]], level: str) -> Column:
    table = weights.get(level, {})
    if not table:
        return F.lit(1.0)
    pairs = F.create_map(*[F.lit(x) for k, v in table.items() for x in (k, float(v))])
    return F.coalesce(F.element_at(pairs, F.col(level)), F.lit(0.0 if None in table else 1.0))


def fill(nodes: DataFrame, parent: list[str], budget: str, cap: str, weight: str, name: str) -> DataFrame:
    """``nodes`` with the column ``name``: each node's share of its parent's
    budget by weight, at most its capacity; shortages go to the siblings."""
    order = Window.partitionBy(*parent).orderBy(F.col(cap) / F.col(weight), *LEVELS)
    ahead = order.rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.col(budget) - F.coalesce(F.sum(cap).over(ahead), F.lit(0.0)))
             / (F.sum(weight).over(Window.partitionBy(*parent)) - F.coalesce(F.sum(weight).over(ahead), F.lit(0.0))))
    return (nodes.withColumn("level_", level)
            .withColumn(name, F.least(F.col(cap), F.col(weight) * F.max("level_").over(Window.partitionBy(*parent))))
            .drop("level_"))


def leaf_budgets(leaves: DataFrame, weights: Mapping, share: float, epochs: int) -> DataFrame:
    """domain, lang, source, tokens, n, budget (whole tokens) of each leaf."""
    part = leaves
    for level in LEVELS:
        part = part.withColumn(f"w_{level}", _weight(weights, level))
    usable = (F.col("w_domain") > 0) & (F.col("w_lang") > 0) & (F.col("w_source") > 0)
    part = part.withColumn("cap", F.when(usable, F.col("tokens") * float(epochs)).otherwise(0.0)).where("cap > 0")
    total = leaves.agg((F.sum("tokens") * float(share)).alias("b")).first()[0] or 0.0
    domains = part.groupBy("domain").agg(F.sum("cap").alias("cap"), F.first("w_domain").alias("w")).select(
        F.lit(0).alias("root"), "domain", F.lit("").alias("lang"), F.lit("").alias("source"), "cap", "w",
        F.lit(total).alias("b"))
    domains = fill(domains, ["root"], "b", "cap", "w", "got").select("domain", F.col("got").alias("b"))
    langs = part.groupBy("domain", "lang").agg(F.sum("cap").alias("cap"), F.first("w_lang").alias("w"))
    langs = fill(langs.join(domains, "domain").withColumn("source", F.lit("")), ["domain"], "b", "cap", "w", "got").select(
        "domain", "lang", F.col("got").alias("b"))
    got = fill(part.join(langs, ["domain", "lang"]), ["domain", "lang"], "b", "cap", "w_source", "got")
    return got.select(*LEVELS, "tokens", "n", F.floor(F.col("got") + 1e-6).cast("long").alias("budget"))


def mix(rows: DataFrame, weights: Mapping, share: float, epochs: int = 1, seed: int = 0) -> DataFrame:
    """id, epoch, domain, lang, source and tokens of every chosen row.

    ``rows`` has id, domain, lang, source and tokens. ``weights`` maps a level to
    {name: weight}; names not listed have weight 1 among their siblings. The
    budget is ``share`` of all tokens. Null names are the name 'none', null
    tokens 0; rows without tokens are chosen with the first whole or partial
    epoch in whose prefix they lie. Ties of the order fall to the id; rows that
    repeat an id are ordered by tokens. An empty table gives an empty result.
    """
    named = [F.coalesce(c, F.lit("none")).alias(c) for c in LEVELS]
    rows = written(rows.select("id", *named, F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens")), "leaf-rows")
    leaves = written(rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n")), "leaves")
    plan = written(leaf_budgets(leaves, weights, share, epochs).where("tokens > 0").select(
        *LEVELS, F.floor(F.col("budget") / F.col("tokens")).cast("int").alias("whole"),
        (F.col("budget") % F.col("tokens")).alias("rest"),
        F.ceil(F.col("n") / BUCKET).cast("long").alias("buckets")), "leaf-plan")
    mine = rows.join(plan, list(LEVELS))
    full = mine.where("whole > 0").select(
        "id", F.explode(F.sequence(F.lit(0), F.col("whole") - 1)).alias("epoch"), *LEVELS, "tokens")
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), F.coalesce(F.col("id").cast("string"), F.lit(""))))
    keyed = mine.where("rest > 0").withColumn("o", order).withColumn(
        "bucket", F.floor(F.conv(F.substring("o", 1, DIGITS), 16, 10).cast("long") * F.col("buckets") / 16 ** DIGITS).cast("long"))
    node = [*LEVELS, "bucket"]
    ahead = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = written(keyed.groupBy(*node, "rest").agg(F.sum("tokens").alias("sum")).select(
        *node, "rest", "sum", F.coalesce(F.sum("sum").over(ahead), F.lit(0)).alias("before")).where("before < rest")
        .select(*node, (F.col("before") + F.col("sum") <= F.col("rest")).alias("inside"), "before"), "bucket-sums")
    near = keyed.join(sums, node)
    within = Window.partitionBy(*node).orderBy("o", "id", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    some = (near.where("not inside").withColumn("b", F.col("before") + F.coalesce(F.sum("tokens").over(within), F.lit(0)))
            .where("b < rest"))
    pick = ["id", F.col("whole").alias("epoch"), *LEVELS, "tokens"]
    return full.union(near.where("inside").select(*pick)).union(some.select(*pick))


def document_rows(docs: DataFrame, tokens: Column) -> DataFrame:
    """Rows for ``mix``: the domain of a source is its number modulo 4."""
    number = F.regexp_extract("source", r"(\d+)$", 1)
    domain = F.when(number != "", F.concat(F.lit("d"), (F.substring(number, -9, 9).cast("long") % 4).cast("string")))
    return docs.select(F.col("doc_id").alias("id"), domain.alias("domain"), "lang", "source", tokens.alias("tokens"))


#: Target weights of the registered query; sources are equal within a language.
WEIGHTS = {"domain": {"d0": 1.0, "d1": 3.0, "d2": 2.0, "d3": 2.0},
           "lang": {"en": 5.0, "de": 2.0, "fr": 2.0, "es": 1.0}}


def _sql(share: float, epochs: int, seed: int) -> str:
    def filled(parent: str, rows: str, w: str) -> str:
        win = f"PARTITION BY {parent}"
        order = f"({win} ORDER BY cap / {w}, domain, lang, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        return f"""SELECT *, least(cap, {w} * max(lv) OVER ({win})) AS got FROM (SELECT *,
  (b - coalesce(sum(cap) OVER {order}, 0.0)) / (sum({w}) OVER ({win}) - coalesce(sum({w}) OVER {order}, 0.0)) AS lv
  FROM ({rows}) r0) r1"""

    def weight(level: str) -> str:
        cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in WEIGHTS.get(level, {}).items())
        return f"CAST(CASE {level} {cases} ELSE 1.0 END AS DOUBLE)" if cases else "CAST(1.0 AS DOUBLE)"

    return f"""
WITH r AS (SELECT doc_id AS id, CASE WHEN num = '' OR num IS NULL THEN 'none'
    ELSE 'd' || CAST(CAST(right(num, 9) AS BIGINT) % 4 AS VARCHAR) END AS domain,
    coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source, tokens
  FROM (SELECT doc_id, lang, source, regexp_extract(source, '([0-9]+)$', 1) AS num,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+')) AS BIGINT) AS tokens FROM documents) d),
leaf AS (SELECT *, tokens * CAST({epochs} AS DOUBLE) AS cap FROM (
  SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS tokens, {weight('domain')} AS w_domain,
    {weight('lang')} AS w_lang, {weight('source')} AS w_source FROM r GROUP BY domain, lang, source) x WHERE tokens > 0),
dom AS ({filled('root', f"SELECT 0 AS root, domain, '' AS lang, '' AS source, sum(cap) AS cap, any_value(w_domain) AS w, (SELECT sum(tokens) * CAST({share} AS DOUBLE) FROM leaf) AS b FROM leaf GROUP BY domain", 'w')}),
lng AS ({filled('domain', "SELECT leaf.domain, leaf.lang, '' AS source, sum(leaf.cap) AS cap, any_value(w_lang) AS w, any_value(dom.got) AS b FROM leaf JOIN dom USING (domain) GROUP BY leaf.domain, leaf.lang", 'w')}),
src AS ({filled('domain, lang', "SELECT leaf.*, lng.got AS b FROM leaf JOIN lng ON leaf.domain = lng.domain AND leaf.lang = lng.lang", 'w_source')}),
plan AS (SELECT domain, lang, source, CAST(floor(budget / tokens) AS INT) AS whole, budget % tokens AS rest
  FROM (SELECT *, CAST(floor(got + 0.000001) AS BIGINT) AS budget FROM src) y),
m AS (SELECT r.*, whole, rest FROM r JOIN plan USING (domain, lang, source)),
part AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source
    ORDER BY md5('{seed}:' || CAST(whole AS VARCHAR) || ':' || coalesce(CAST(id AS VARCHAR), '')), id, tokens
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM m)
SELECT id AS doc_id, CAST(epoch AS INT) AS epoch, domain, lang, source, tokens FROM (
  SELECT id, unnest(range(whole)) AS epoch, domain, lang, source, tokens FROM m
  UNION ALL SELECT id, whole, domain, lang, source, tokens FROM part WHERE before < rest) z"""


#: Production parameters of the registered query, and its DuckDB SQL.
PRODUCTION = {"share": 0.6, "epochs": 2, "seed": 17}
SQL = _sql(**PRODUCTION)
