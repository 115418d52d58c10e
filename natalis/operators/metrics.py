"""Classification metrics from conditional counts: one scan, any number of groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from natalis.functions.columns import ratio
from natalis.operators.ordering import running_totals
from natalis.sources.store import cut_lineage


def outcome_counts(y: str = "y", pred: str = "y_pred") -> list[Column]:
    """The four cells. Missing cells are 0, so a group with one class only needs no special case."""
    truth, guess = F.col(y), F.col(pred)
    return [
        F.count_if((truth == 0) & (guess == 0)).alias("tn"),
        F.count_if((truth == 0) & (guess == 1)).alias("fp"),
        F.count_if((truth == 1) & (guess == 0)).alias("fn"),
        F.count_if((truth == 1) & (guess == 1)).alias("tp"),
    ]


def cell_counts(df: DataFrame, y: str = "y", pred: str = "y_pred", by: Sequence[str] = ()) -> DataFrame:
    cells = outcome_counts(y, pred)
    return df.groupBy(*by).agg(*cells) if by else df.agg(*cells)


def confusion_matrix(df: DataFrame, y: str = "y", pred: str = "y_pred") -> DataFrame:
    """Four rows (actual, predicted, n)."""
    cells = F.array(
        *[
            F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("n"))
            for a, p, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
        ]
    )
    return cell_counts(df, y, pred).select(F.explode(cells).alias("m")).select("m.*")


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def _per_class() -> dict[str, tuple[Column, Column, Column, Column]]:
    """precision, recall, F1 and support of both classes, 0 for an empty denominator."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    out = {}
    for name, hit, wrong, missed in (("0", tn, fn, fp), ("1", tp, fp, fn)):
        out[name] = (
            _zero(ratio(hit, hit + wrong)),
            _zero(ratio(hit, hit + missed)),
            _zero(ratio(2 * hit, 2 * hit + wrong + missed)),
            hit + missed,
        )
    return out


def _total() -> Column:
    return F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")


def classification_report(df: DataFrame, y: str = "y", pred: str = "y_pred") -> DataFrame:
    """Rows ``0``, ``1``, ``accuracy``, ``macro avg``, ``weighted avg``."""
    classes, n = _per_class(), _total()
    accuracy = _zero(ratio(F.col("tn") + F.col("tp"), n))
    rows = [(k, *v) for k, v in classes.items()]
    rows.append(("accuracy", accuracy, accuracy, accuracy, n))
    zero, one = classes["0"], classes["1"]
    rows.append(("macro avg", *[(zero[i] + one[i]) / 2 for i in range(3)], n))
    rows.append(
        ("weighted avg", *[_zero(ratio(zero[i] * zero[3] + one[i] * one[3], n)) for i in range(3)], n)
    )
    names = ("label", "precision", "recall", "f1", "support")
    table = F.array(
        *[F.struct(*[(F.lit(v) if isinstance(v, str) else v).alias(k) for k, v in zip(names, row)]) for row in rows]
    )
    return cell_counts(df, y, pred).select(F.explode(table).alias("r")).select("r.*")


def macro_scores(df: DataFrame, y: str = "y", pred: str = "y_pred") -> DataFrame:
    zero, one = _per_class().values()
    return cell_counts(df, y, pred).select(
        _zero(ratio(F.col("tn") + F.col("tp"), _total())).alias("accuracy"),
        *[((zero[i] + one[i]) / 2).alias(f"macro_{name}") for i, name in enumerate(("precision", "recall", "f1"))],
    )


def score_counts(df: DataFrame, y: str, score: str, by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Rows of each class per score; with ``weight`` a row stands for so many."""
    n = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    return df.groupBy(*by, F.col(score).cast("double").alias("threshold")).agg(
        *[F.sum(F.when(F.col(y) == k, n).otherwise(0)).alias(name) for name, k in (("pos", 1), ("neg", 0))]
    )


def _ranked_scores(
    df: DataFrame, y: str, score: str, by: Sequence[str], edges: Sequence[float] | None, weight: str | None = None
) -> DataFrame:
    """Distinct scores with the class counts above each and the class totals of their group."""
    by = list(by)
    counts = cut_lineage(score_counts(df, y, score, by, weight))  # the rows are read once; all that follows reads counts
    ranked = running_totals(counts, "threshold", {"pos_below": "pos", "neg_below": "neg"}, by=by, edges=edges)
    totals = counts.groupBy(*by).agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))
    if not by:
        placed = ranked.withColumns({c: totals.select(c).scalar() for c in ("all_pos", "all_neg")})
    else:
        same = None
        for k in by:
            test = F.col(f"r.{k}").eqNullSafe(F.col(f"t.{k}"))
            same = test if same is None else same & test
        placed = ranked.alias("r").join(totals.alias("t"), same, "inner").select("r.*", "t.all_pos", "t.all_neg")
    return placed.withColumns(
        {
            "pos_above": F.col("all_pos") - F.col("pos_below") - F.col("pos"),
            "neg_above": F.col("all_neg") - F.col("neg_below") - F.col("neg"),
        }
    )


def roc_points(
    df: DataFrame, y: str = "y", score: str = "score", by: Sequence[str] = (), edges: Sequence[float] | None = None
) -> DataFrame:
    """(fpr, tpr) for every distinct score taken as ``score >= threshold``, plus the origin (threshold NULL)."""
    ranked = _ranked_scores(df, y, score, by, edges)
    points = ranked.select(
        *by,
        "threshold",
        ratio(F.col("neg_above") + F.col("neg"), F.col("all_neg")).alias("fpr"),
        ratio(F.col("pos_above") + F.col("pos"), F.col("all_pos")).alias("tpr"),
    )
    zero, none = F.lit(0.0), F.lit(None).cast("double")
    origin = (df.select(*by).distinct() if by else df.sparkSession.range(1)).select(
        *by, none.alias("threshold"), zero.alias("fpr"), zero.alias("tpr")
    )
    return points.unionByName(origin)


def auc(
    df: DataFrame,
    y: str = "y",
    score: str = "score",
    by: Sequence[str] = (),
    edges: Sequence[float] | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Area under the ROC curve: trapezoids over distinct scores, so ties count one half."""
    ranked = _ranked_scores(df, y, score, by, edges, weight)
    area = F.sum(F.col("neg") * (F.col("pos_above") + F.col("pos") / 2))
    norm = F.max(F.col("all_pos")).cast("double") * F.max(F.col("all_neg"))
    grouped = ranked.groupBy(*by) if by else ranked.groupBy()
    return grouped.agg(ratio(area, norm).alias("auc"))


def split_sizes(df: DataFrame, split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(F.count("*").alias("n_rows"))
