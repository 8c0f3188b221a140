"""Plain numpy statements of the metrics, for small inputs."""

import numpy as np


def counts(y, s, t):
    y, said = np.asarray(y), np.asarray(s) >= t
    return (int((said & (y == 1)).sum()), int((said & (y == 0)).sum()),
            int((~said & (y == 0)).sum()), int((~said & (y == 1)).sum()))


def div(a, b):
    return a / b if b else 0.0


def curve(y, s):
    """[(threshold, precision, recall, tp, fp, tn, fn)] ascending."""
    out = []
    for t in sorted(set(s)):
        tp, fp, tn, fn = counts(y, s, t)
        out.append((t, div(tp, tp + fp), div(tp, tp + fn), tp, fp, tn, fn))
    return out


def average_precision(y, s):
    if sum(y) == 0:
        return None
    total, last = 0.0, 0.0
    for _, p, r, *_ in sorted(curve(y, s), reverse=True):
        total += (r - last) * p
        last = r
    return total


def roc_auc(y, s):
    pos = [a for a, b in zip(s, y) if b == 1]
    neg = [a for a, b in zip(s, y) if b == 0]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def best(points, value, ok=lambda p: True):
    """Largest value, lowest threshold on ties; None when nothing qualifies."""
    fit = [p for p in points if ok(p) and value(p) is not None]
    return min(fit, key=lambda p: (-value(p), p[0])) if fit else None


def f_beta(p, beta, guarded):
    b2, pr, rc = beta * beta, p[1], p[2]
    den = b2 * pr + rc
    if guarded:
        return (1 + b2) * pr * rc / max(den, 1e-12)
    return None if den == 0 else (1 + b2) * (pr * rc) / den
