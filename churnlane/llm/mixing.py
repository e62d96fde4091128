"""Mixing sources to target weights by hierarchical budgeting.

A token budget flows down a tree domain -> language -> source.  At each node
the children share it in proportion to their weights; a child that cannot use
its share (its leaves' tokens times ``max_epochs``) takes all it has, and what
is left over goes to its siblings.  Since a node's capacity is known before it
is given a share, a shortage moves to siblings first, and to the ancestor's
siblings only when the whole family is exhausted.

A leaf that is given A of its T tokens a pass gets A div T whole epochs, and of
the next epoch, in that epoch's seeded order, the shortest prefix that reaches
the rest (documents stay whole).  The prefix is found by three ever finer
counts over the leaf's order (never by sorting a leaf in one task), and comes
back as one order key a leaf, so the texts are never shuffled.

The tree is configuration: sources, languages and domains that it does not name
belong to its ``*`` entries, so the tables joined by broadcast have at most as
many rows as the tree has leaves.

Defined results: null source or language counts as unnamed; null and empty
texts have no tokens; zero weight gives nothing; rows of equal id are
neighbours in every epoch and are taken or left together; null ids are
neighbours of each other; empty tables and budgets of zero give empty tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnlane.llm.common import free_name, stage

TOKEN = "[^ \\t\\n\\x0B\\f\\r]+"
ANY = "*"


@dataclass(frozen=True)
class Domain:
    name: str
    weight: int
    languages: dict[str, int]      # ``*``: all others
    sources: dict[str, int]        # ``*``: all that no domain names


@dataclass(frozen=True)
class Mix:
    domains: tuple[Domain, ...]
    budget: tuple[int, int] = (1, 1)   # share of the tokens there are, as a fraction
    max_epochs: int = 4
    seed: int = 42

    def leaves(self) -> list[tuple]:
        return [(d.name, g, s, d.weight, a, b) for d in self.domains
                for g, a in d.languages.items() for s, b in d.sources.items()]


#: Weights of the registered query and the pipeline.
PRODUCTION = Mix((
    Domain("web", 5, {"en": 4, "de": 2, "fr": 2, ANY: 1}, {"src0": 2, **{f"src{i}": 1 for i in range(1, 8)}}),
    Domain("reference", 3, {"en": 3, "es": 1, ANY: 2}, {f"src{i}": i - 7 for i in range(8, 14)}),
    Domain("social", 2, {ANY: 1}, {**{f"src{i}": 1 for i in range(14, 20)}, ANY: 1}),
))


def _table(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A literal table of configuration rows."""
    values = [F.struct(*[F.lit(v).cast("long" if isinstance(v, int) else "string").alias(n) for v, n in zip(r, names)])
              for r in rows]
    return spark.range(1).select(F.inline(F.array(*values)))


def _with_leaf(rows: DataFrame, mix: Mix) -> DataFrame:
    """Adds domain, lang and source of the tree to rows with raw_source and raw_lang."""
    spark = rows.sparkSession
    owner = {s: d.name for d in mix.domains for s in d.sources}
    sources = _table(spark, [(s, d) for s, d in owner.items() if s != ANY] or [(None, None)], ["raw_source", "domain"])
    rows = rows.join(F.broadcast(sources), "raw_source", "left")
    rows = rows.withColumn("source", F.when(F.col("domain").isNull(), F.lit(ANY)).otherwise(F.col("raw_source")))
    rows = rows.withColumn("domain", F.coalesce("domain", F.lit(owner.get(ANY))))
    langs = _table(spark, [(d.name, g, g) for d in mix.domains for g in d.languages if g != ANY] or [(None, None, None)],
                   ["domain", "raw_lang", "lang"])
    return rows.join(F.broadcast(langs), ["domain", "raw_lang"], "left").withColumn("lang", F.coalesce("lang", F.lit(ANY)))


def share(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Adds ``given`` to children with weight, cap and their parent's ``budget``: integer water-filling.

    In order of capacity a weight, a child is full if its capacity is no more
    than its part of what the children before it left.  The others divide the
    rest by weight; tokens lost to rounding go one each to the first of them.
    """
    fill = Window.partitionBy(*parent).orderBy(F.col("cap") / F.col("weight"), name)
    whole = Window.partitionBy(*parent)
    so_far = fill.rowsBetween(Window.unboundedPreceding, -1)
    c = (children.filter("weight > 0")
         .withColumn("budget", F.least("budget", F.sum("cap").over(whole)))
         .withColumn("left", F.col("budget") - F.coalesce(F.sum("cap").over(so_far), F.lit(0)))
         .withColumn("heavy", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(so_far), F.lit(0)))
         .withColumn("full", F.col("cap") * F.col("heavy") <= F.col("weight") * F.col("left")))
    rest = F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(whole), F.lit(0))
    c = (c.withColumn("rest", rest)
         .withColumn("open", F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole))
         .withColumn("part", F.when(~F.col("full"), F.expr("weight * rest div open"))))
    lost = F.col("rest") - F.coalesce(F.sum("part").over(whole), F.lit(0))
    rank = F.row_number().over(Window.partitionBy(*parent, "full").orderBy(name))
    return (c.withColumn("extra", F.when(~F.col("full") & (rank <= lost), F.lit(1)).otherwise(F.lit(0)))
            .withColumn("given", F.when(F.col("full"), F.col("cap")).otherwise(F.col("part") + F.col("extra")))
            .drop("left", "heavy", "full", "rest", "open", "part", "extra", "budget"))


def allocate(tokens: DataFrame, mix: Mix) -> DataFrame:
    """Leaves' (domain, lang, source, tokens) -> adds ``given``; a row for every leaf of the tree that has tokens."""
    names = ["domain", "lang", "source", "w_domain", "w_lang", "w_source"]
    leaves = (_table(tokens.sparkSession, mix.leaves(), names).join(tokens, ["domain", "lang", "source"])
              .withColumn("cap", F.when((F.col("w_domain") > 0) & (F.col("w_lang") > 0) & (F.col("w_source") > 0),
                                        F.col("tokens") * mix.max_epochs).otherwise(F.lit(0))))
    total = tokens.agg(F.expr(f"coalesce(sum(tokens), 0) * {mix.budget[0]} div {mix.budget[1]}").alias("budget"))
    domains = (leaves.groupBy("domain").agg(F.first("w_domain").alias("weight"), F.sum("cap").alias("cap"))
               .withColumn("root", F.lit(0)).join(F.broadcast(total.withColumn("root", F.lit(0))), "root"))     # one row
    domains = share(domains, ["root"], "domain").select("domain", F.col("given").alias("budget"))
    langs = leaves.groupBy("domain", "lang").agg(F.first("w_lang").alias("weight"), F.sum("cap").alias("cap"))
    langs = share(langs.join(domains, "domain"), ["domain"], "lang").select("domain", "lang", F.col("given").alias("budget"))
    sources = leaves.select("domain", "lang", "source", "tokens", F.col("w_source").alias("weight"), "cap")
    return share(sources.join(langs, ["domain", "lang"]), ["domain", "lang"], "source").select(
        "domain", "lang", "source", "tokens", "given")


def order_key(seed: int, epoch: Column, id_: Column) -> Column:
    """Place of a row in a seeded epoch: a hash, as text in hex."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(id_.cast("string"), F.lit(""))))


def prefix_cuts(rows: DataFrame, leaves: DataFrame, mix: Mix) -> DataFrame:
    """Leaves with ``epochs`` (whole ones) and ``cut``: the last order key that the part of an epoch takes (or null)."""
    leaf = ["domain", "lang", "source"]
    plan = leaves.filter("given > 0").select(*leaf, F.expr("given div tokens").alias("epochs"), F.expr("given % tokens").alias("need"))
    plan = stage(plan, "mix-plan")
    keyed = (rows.join(F.broadcast(plan.filter("need > 0")), leaf)
             .select(*leaf, "tokens", order_key(mix.seed, F.col("epochs"), F.col("id")).alias("key")))
    want = plan.filter("need > 0").select(*leaf, "need", F.lit("").alias("at"))
    for digits in (3, 6, 32):      # 4,096 parts, 4,096 parts of one of them, then single keys
        inside = keyed.join(F.broadcast(want), leaf).filter(F.col("key").startswith(F.col("at")))
        parts = inside.groupBy(*leaf, F.substring("key", 1, digits).alias("part")).agg(
            F.sum("tokens").alias("n"), F.first("need").alias("need"))
        before = F.sum("n").over(Window.partitionBy(*leaf).orderBy("part")) - F.col("n")
        cut = parts.withColumn("before", before).filter("before < need")
        want = stage(cut.groupBy(*leaf).agg(F.max(F.struct("part", (F.col("need") - F.col("before")).alias("need"))).alias("m"))
                     .select(*leaf, "m.need", F.col("m.part").alias("at")), "mix-cut")
    return plan.join(want.select(*leaf, F.col("at").alias("cut")), leaf, "left").select(*leaf, "epochs", "cut")


def mix_sources(docs: DataFrame, mix: Mix = PRODUCTION, id_col: str = "doc_id", text_col: str = "text",
                lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Rows that the mix takes: ``row`` (the input row), id, domain, lang, source (of the tree), tokens, copies."""
    tokens = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(TOKEN)).cast("long")
    raw = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), tokens.alias("tokens"),
                      F.col(source_col).cast("string").alias("raw_source"), F.col(lang_col).cast("string").alias("raw_lang"))
    thin = stage(_with_leaf(raw.drop("row"), mix).select("id", "domain", "lang", "source", "tokens"), "mix-rows")
    leaf = ["domain", "lang", "source"]
    totals = stage(thin.groupBy(*leaf).agg(F.sum("tokens").alias("tokens")), "mix-leaves")
    cuts = stage(prefix_cuts(thin, allocate(totals.filter("tokens > 0"), mix), mix), "mix-cuts")
    part = F.coalesce(order_key(mix.seed, F.col("epochs"), F.col("id")) <= F.col("cut"), F.lit(False))
    return (_with_leaf(raw, mix).join(F.broadcast(cuts), leaf)
            .withColumn("copies", F.col("epochs") + part.cast("long")).filter("copies > 0")
            .select("row", "id", *leaf, "tokens", "copies"))


def mixed_rows(docs: DataFrame, mix: Mix = PRODUCTION, **columns) -> DataFrame:
    """The rows of ``docs`` that the mix takes, and how often: its columns and ``copies``."""
    return mix_sources(docs, mix, **columns).select("row.*", F.col("copies").alias(free_name(docs, "copies")))


def oracle(mix: Mix, table: str = "documents") -> str:
    """DuckDB SQL for doc_id, domain, lang, source, tokens, copies of ``mix_sources``."""
    tree = ", ".join("(%s)" % ", ".join(repr(v) for v in r) for r in mix.leaves())
    owner = {s: d.name for d in mix.domains for s in d.sources}
    domain_of = " ".join(f"WHEN source = '{s}' THEN '{d}'" for s, d in owner.items() if s != ANY)
    named = ", ".join(f"'{s}'" for s in owner if s != ANY)
    other = f"'{owner[ANY]}'" if ANY in owner else "NULL"
    lang_of = " OR ".join(f"(domain = '{d.name}' AND lang IN ({', '.join(repr(g) for g in d.languages if g != ANY)}))"
                          for d in mix.domains if set(d.languages) - {ANY})

    def level(source: str, parent: str, child: str, keep: str) -> str:
        p = f"PARTITION BY {parent}"
        return f"""(SELECT {keep}, CASE WHEN is_full THEN cap ELSE part + CASE WHEN rn <= rest - coalesce(sum(part) OVER ({p}), 0) THEN 1 ELSE 0 END END AS given
          FROM (SELECT *, CASE WHEN NOT is_full THEN (weight * rest) // open END AS part,
                  row_number() OVER (PARTITION BY {parent}, is_full ORDER BY {child}) AS rn
            FROM (SELECT *, b - coalesce(sum(CASE WHEN is_full THEN cap END) OVER ({p}), 0) AS rest,
                    sum(CASE WHEN NOT is_full THEN weight END) OVER ({p}) AS open
              FROM (SELECT *, cap * (sum(weight) OVER ({p}) - coalesce(sum(weight) OVER w, 0)) <= weight * (b - coalesce(sum(cap) OVER w, 0)) AS is_full
                FROM (SELECT *, least(budget, sum(cap) OVER ({p})) AS b FROM {source} WHERE weight > 0)
                WINDOW w AS ({p} ORDER BY cap / weight, {child} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))))"""
    return f"""
WITH tree(domain, lang, source, w_domain, w_lang, w_source) AS (VALUES {tree}),
placed AS (SELECT doc_id, text, lang, source, CASE {domain_of} ELSE {other} END AS domain FROM {table}),
docs AS (SELECT doc_id, domain, CASE WHEN {lang_of or 'false'} THEN lang ELSE '*' END AS lang,
    CASE WHEN source IN ({named or "''"}) THEN source ELSE '*' END AS source,
    len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) AS tokens FROM placed),
totals AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens FROM docs GROUP BY ALL HAVING sum(tokens) > 0),
leaves AS (SELECT *, CASE WHEN w_domain > 0 AND w_lang > 0 AND w_source > 0 THEN tokens * {mix.max_epochs} ELSE 0 END AS cap
    FROM tree JOIN totals USING (domain, lang, source)),
d0 AS (SELECT domain, 0 AS root, any_value(w_domain) AS weight, sum(cap)::BIGINT AS cap,
    (SELECT (sum(tokens) * {mix.budget[0]})::BIGINT // {mix.budget[1]} FROM totals) AS budget FROM leaves GROUP BY domain),
d1 AS (SELECT * FROM {level('d0', 'root', 'domain', 'domain')}),
l0 AS (SELECT domain, lang, any_value(w_lang) AS weight, sum(cap)::BIGINT AS cap, any_value(given) AS budget
    FROM leaves JOIN d1 USING (domain) GROUP BY domain, lang),
l1 AS (SELECT * FROM {level('l0', 'domain', 'lang', 'domain, lang')}),
s0 AS (SELECT domain, lang, source, tokens, w_source AS weight, cap, given AS budget FROM leaves JOIN l1 USING (domain, lang)),
s1 AS (SELECT * FROM {level('s0', 'domain, lang', 'source', 'domain, lang, source, tokens')}),
plan AS (SELECT domain, lang, source, (given // tokens)::BIGINT AS epochs, (given % tokens)::BIGINT AS need FROM s1 WHERE given > 0),
keyed AS (SELECT docs.*, epochs, need, md5('{mix.seed}:' || epochs || ':' || coalesce(doc_id::VARCHAR, '')) AS key
    FROM docs JOIN plan USING (domain, lang, source)),
placed2 AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY key
    RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP), 0) AS before FROM keyed)
SELECT doc_id, domain, lang, source, tokens::BIGINT AS tokens, (epochs + CASE WHEN before < need THEN 1 ELSE 0 END)::BIGINT AS copies
FROM placed2 WHERE epochs > 0 OR before < need"""
