"""Rates derived from confusion counts.

Every ratio follows the zero rule: a zero denominator gives 0.0. Counts are turned into doubles first,
because products of counts overflow a long on large tables and Spark raises on overflow and on x/0.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    n, d = numerator.cast("double"), denominator.cast("double")
    return F.when(d == 0, F.lit(0.0)).otherwise(F.try_divide(n, d))


def f_beta(precision: Column, recall: Column, beta: float = 1.0) -> Column:
    """F-beta with the denominator held above zero."""
    b2 = float(beta) * float(beta)
    weighted = F.lit(b2) * precision + recall
    return F.lit(1.0 + b2) * (precision * recall) / F.greatest(weighted, F.lit(1e-12))


def f_beta_or_null(precision: Column, recall: Column, beta: float = 1.0) -> Column:
    """F-beta that is undefined (NULL) where precision and recall are both zero."""
    b2 = float(beta) * float(beta)
    weighted = F.lit(b2) * precision + recall
    return F.try_divide(F.lit(1.0 + b2) * (precision * recall), F.when(weighted != 0, weighted))


def product_of_roots(a: Column, b: Column, c: Column, d: Column) -> Column:
    return F.sqrt(a) * F.sqrt(b) * F.sqrt(c) * F.sqrt(d)


@dataclass(frozen=True)
class Confusion:
    """The four counts of one threshold, as columns."""

    tp: Column
    fp: Column
    tn: Column
    fn: Column

    @classmethod
    def of(cls, prefix: str = "") -> "Confusion":
        return cls(*[F.col(prefix + c) for c in ("tp", "fp", "tn", "fn")])

    @property
    def total(self) -> Column:
        return self.tp + self.fp + self.tn + self.fn

    @property
    def precision(self) -> Column:
        return ratio(self.tp, self.tp + self.fp)

    @property
    def recall(self) -> Column:
        return ratio(self.tp, self.tp + self.fn)

    @property
    def f1(self) -> Column:
        """2TP / (2TP + FP + FN): the harmonic mean with the zero rule already in it."""
        return ratio(2 * self.tp, 2 * self.tp + self.fp + self.fn)

    @property
    def fpr(self) -> Column:
        return ratio(self.fp, self.fp + self.tn)

    @property
    def tnr(self) -> Column:
        return F.lit(1.0) - self.fpr

    @property
    def fnr(self) -> Column:
        return F.lit(1.0) - self.recall

    @property
    def balanced_accuracy(self) -> Column:
        return (self.recall + self.tnr) / 2.0

    @property
    def accuracy(self) -> Column:
        return ratio(self.tp + self.tn, self.total)

    @property
    def alerts(self) -> Column:
        return self.tp + self.fp

    def f_beta(self, beta: float) -> Column:
        return f_beta(self.precision, self.recall, beta)

    @property
    def mcc(self) -> Column:
        tp, fp, tn, fn = [c.cast("double") for c in (self.tp, self.fp, self.tn, self.fn)]
        margins = product_of_roots(tp + fp, tp + fn, tn + fp, tn + fn)
        return F.when(margins == 0, F.lit(0.0)).otherwise(F.try_divide(tp * tn - fp * fn, margins))

    def cost(self, fp_cost: float = 1.0, fn_cost: float = 20.0) -> Column:
        return self.fp * F.lit(float(fp_cost)) + self.fn * F.lit(float(fn_cost))

    def cost_per_row(self, fp_cost: float = 1.0, fn_cost: float = 20.0) -> Column:
        return ratio(self.cost(fp_cost, fn_cost), self.total)
