"""Queries: exact trees kept as node tables, scoring by join, rank metrics (FIT-1, SCO-1, AGG-2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlane.operators.exact_tree import fit_exact, score_nodes
from churnlane.operators.metrics import classification_metrics, rank_metrics
from churnlane.operators.score import score_multi
from churnlane.operators.train import leaf_class_counts
from churnlane.operators.tree import fixed_tree
from churnlane.plans import common
from churnlane.plans.oracle_sql import BPZS, leaf_case
from churnlane.plans.registry import query
from churnlane.sources.tables import FEATURES, KEY, LABEL

DEEP = 7


def _grow(depth: int) -> str:
    """CTEs of the exact tree: for each level its rows ``r``, best cuts ``b`` and nodes ``n``."""
    sql = f",\nr0 AS MATERIALIZED (SELECT {KEY}, {', '.join(FEATURES)}, CASE WHEN {LABEL} = 'Yes' THEN 1 ELSE 0 END AS y, CAST(1 AS BIGINT) AS node FROM train)"
    for d in range(depth + 1):
        if d < depth:
            long = " UNION ALL ".join(f"SELECT node, {i} AS f, {c} AS x, y FROM r{d}" for i, c in enumerate(FEATURES))
            value = "CASE f " + " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(FEATURES)) + " END"
            sql += f""",
g{d} AS (SELECT node, f, x, sum(1 - y)::DOUBLE AS c0, sum(y)::DOUBLE AS c1 FROM ({long}) GROUP BY node, f, x),
w{d} AS (SELECT node, f, x, sum(c0) OVER run AS l0, sum(c1) OVER run AS l1, sum(c0) OVER grp AS a0, sum(c1) OVER grp AS a1,
    lead(x) OVER (PARTITION BY node, f ORDER BY x) AS nx FROM g{d}
    WINDOW run AS (PARTITION BY node, f ORDER BY x ROWS UNBOUNDED PRECEDING), grp AS (PARTITION BY node, f)),
s{d} AS (SELECT node, f, x, (x + nx) / 2 AS threshold, (a0 * a0 + a1 * a1) / (a0 + a1) AS whole,
    (l0 * l0 + l1 * l1) / (l0 + l1) + ((a0 - l0) * (a0 - l0) + (a1 - l1) * (a1 - l1)) / ((a0 - l0) + (a1 - l1)) AS gain
    FROM w{d} WHERE nx IS NOT NULL),
b{d} AS MATERIALIZED (SELECT node, f, threshold FROM s{d} WHERE gain > whole
    QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, x) = 1),
r{d + 1} AS MATERIALIZED (SELECT r.* EXCLUDE (node), node * 2 + CASE WHEN {value} > threshold THEN 1 ELSE 0 END AS node FROM r{d} r JOIN b{d} USING (node))"""
        cut = f"LEFT JOIN b{d} USING (node)" if d < depth else ""
        at = "f AS feature, threshold" if d < depth else "CAST(NULL AS INTEGER) AS feature, CAST(NULL AS DOUBLE) AS threshold"
        sql += f""",
n{d} AS (SELECT node, {at}, n_no, n_yes
    FROM (SELECT node, sum(1 - y)::BIGINT AS n_no, sum(y)::BIGINT AS n_yes FROM r{d} GROUP BY node) {cut})"""
    return sql + ",\nnodes AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT * FROM n{d}" for d in range(depth + 1)) + ")"


def _descend(rows: str, depth: int) -> str:
    """CTEs that move the rows of ``rows`` down the tree: ``leaf`` has each row and its leaf's counts."""
    value = "CASE feature " + " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(FEATURES)) + " END"
    sql = f",\nt0 AS (SELECT *, CAST(1 AS BIGINT) AS node FROM {rows})"
    for d in range(depth):
        sql += f""",
t{d + 1} AS (SELECT t.* EXCLUDE (node), CASE WHEN feature IS NULL THEN node ELSE node * 2 + CASE WHEN {value} > threshold THEN 1 ELSE 0 END END AS node
    FROM t{d} t JOIN nodes USING (node))"""
    return sql + f""",
leaf AS (SELECT t.*, CASE WHEN n_yes > n_no THEN 'Yes' ELSE 'No' END AS prediction, n_yes::DOUBLE / (n_no + n_yes) AS prob_Yes
    FROM t{depth} t JOIN nodes USING (node))"""


_RANKS = """q AS (SELECT prob_Yes AS s, sum(CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END)::HUGEINT AS pos,
    sum(CASE WHEN churn = 'Yes' THEN 0 ELSE 1 END)::HUGEINT AS neg FROM scored GROUP BY prob_Yes),
a AS (SELECT sum(pos) AS n_pos, sum(neg) AS n_neg, sum(pos * (2 * below + neg)) AS pairs,
    sum(-(pos::DOUBLE * ln(greatest(1e-15, least(1 - 1e-15, s))) + neg::DOUBLE * ln(1 - greatest(1e-15, least(1 - 1e-15, s))))) AS loss
    FROM (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM q))"""
_RANK_COLUMNS = """n_pos::BIGINT AS n_pos, n_neg::BIGINT AS n_neg,
    CASE WHEN n_pos > 0 AND n_neg > 0 THEN floor(pairs::DOUBLE / (2 * n_pos::DOUBLE * n_neg::DOUBLE) * 1000000) / 1000000 END AS auc,
    CASE WHEN n_pos + n_neg > 0 THEN round(loss / (n_pos + n_neg)::DOUBLE, 6) END AS log_loss"""


@query("fit_exact", f"""{BPZS}{_grow(3)}
SELECT node AS id, feature, threshold, n_no, n_yes FROM nodes""", "FIT-1 FIT-2")
def q_fit_exact(spark, sf):
    """A depth-3 tree with exact thresholds on the train side: its nodes, cuts and class counts."""
    train, _ = common.train_test(spark, sf)
    nodes, classes = fit_exact(train, FEATURES, LABEL, 3)
    n = lambda c: F.coalesce(F.get("counts", F.lit(classes.index(c))), F.lit(0)) if c in classes else F.lit(0)
    return nodes.select("id", "feature", "threshold", n("No").cast("long").alias("n_no"), n("Yes").cast("long").alias("n_yes"))


@query("score_node_table", f"""{BPZS}{_grow(DEEP)}{_descend('test', DEEP)}
SELECT customer_id, node AS leaf, prediction, prob_Yes AS prob_yes FROM leaf""", "SCO-1 SCO-3 FIT-1")
def q_score_node_table(spark, sf):
    """A deeper exact tree, kept as a table of nodes and never collected, scores the held-out rows by join:
    leaf, label and share of the positive class."""
    train, test = common.train_test(spark, sf, pinned=True)
    nodes, classes = fit_exact(train, FEATURES, LABEL, DEEP)
    out = score_nodes(test.select(KEY, *FEATURES), nodes, FEATURES, classes, levels=3, leaf="leaf", shares="shares")
    return out.select(KEY, "leaf", "prediction", F.get("shares", F.lit(list(classes).index("Yes"))).alias("prob_yes"))


@query("rank_metrics", f"""{BPZS},
lc AS (SELECT leaf, sum(CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END)::DOUBLE / count(*) AS prob_Yes
    FROM (SELECT {leaf_case()} AS leaf, churn FROM train) GROUP BY leaf),
scored AS (SELECT churn, prob_Yes FROM (SELECT {leaf_case()} AS leaf, churn FROM test) JOIN lc USING (leaf)),
{_RANKS}
SELECT (n_pos + n_neg)::BIGINT AS n, {_RANK_COLUMNS} FROM a""", "AGG-2")
def q_rank_metrics(spark, sf):
    """ROC AUC (ties by mid-rank) and log loss of the fixed tree's leaf shares on the held-out side."""
    train, test = common.train_test(spark, sf, pinned=True)
    tree = leaf_class_counts(fixed_tree(), train, LABEL)
    return rank_metrics(score_multi(test, tree), LABEL, "prob_Yes")


@query("exact_fit_metrics", f"""{BPZS}{_grow(3)}{_descend('train', 3)},
scored AS (SELECT churn, prediction, prob_Yes FROM leaf),
{_RANKS},
c AS (SELECT count(*) AS n, sum(CASE WHEN churn = prediction THEN 1 ELSE 0 END)::BIGINT AS ok,
    sum(CASE WHEN churn = 'Yes' AND prediction = 'Yes' THEN 1 ELSE 0 END)::BIGINT AS tp,
    sum(CASE WHEN prediction = 'Yes' THEN 1 ELSE 0 END)::BIGINT AS pred_pos, sum(CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END)::BIGINT AS act_pos FROM scored)
SELECT n, ok, tp, pred_pos, act_pos, CASE WHEN n > 0 THEN floor(ok::DOUBLE / n::DOUBLE * 1000000) / 1000000 END AS accuracy,
    CASE WHEN pred_pos > 0 THEN floor(tp::DOUBLE / pred_pos::DOUBLE * 1000000) / 1000000 END AS precision,
    CASE WHEN act_pos > 0 THEN floor(tp::DOUBLE / act_pos::DOUBLE * 1000000) / 1000000 END AS recall,
    CASE WHEN pred_pos + act_pos > 0 THEN floor((2 * tp)::DOUBLE / (pred_pos + act_pos)::DOUBLE * 1000000) / 1000000 END AS f1,
    {_RANK_COLUMNS} FROM c, a""", "AGG-2 FIT-1")
def q_exact_fit_metrics(spark, sf):
    """What is recorded after training: every metric of the exact tree on its own training rows."""
    train, _ = common.train_test(spark, sf, pinned=True)
    nodes, classes = fit_exact(train, FEATURES, LABEL, 3)
    scored = score_nodes(train, nodes, FEATURES, classes, shares="_shares")
    yes = F.get("_shares", F.lit(classes.index("Yes"))) if "Yes" in classes else F.lit(0.0)
    ranks = rank_metrics(scored.withColumn("_p", yes), LABEL, "_p").drop("n")
    return classification_metrics(scored, LABEL).crossJoin(ranks)      # one row each
