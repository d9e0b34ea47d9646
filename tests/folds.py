"""Plain sequential folds over one series, to check the distributed operators against."""

from __future__ import annotations

import math

import numpy as np


def moving_average(values, n):
    return [sum(values[max(0, t - n + 1) : t + 1]) / min(n, t + 1) for t in range(len(values))]


def step_levels(values, order):
    """``{level: {t: value}}``; the first reading is never a subtrahend."""
    levels = {0: dict(enumerate(values))}
    for i in range(1, order + 1):
        below = levels[i - 1]
        levels[i] = {t: below[t] - below[t - 1] for t in range(i + 1, len(values))}
    return levels


def season(values, width):
    return {t: values[t] - values[t - width] for t in range(2 * width, len(values))}


def lagged(hours, values, lag):
    """``{t: value}`` by a queue that gives a value back once ``lag`` hours have passed."""
    queue, out = [], {}
    for t, (hour, value) in enumerate(zip(hours, values)):
        if lag == 0:
            out[t] = value
        elif hour - lag >= hours[0]:
            out[t] = queue.pop(0)
        queue.append(value)
    return out


def arma_errors(values, ar, ma, c=0.0):
    """``[None, e1, e2, ..]``."""
    errors = []
    for t, value in enumerate(values):
        if t == 0:
            errors.append(None)
            continue
        prediction = c + sum(phi * values[t - 1 - i] for i, phi in enumerate(ar) if t - 1 - i >= 0)
        prediction -= sum(theta * errors[t - 1 - j] for j, theta in enumerate(ma) if t - 1 - j >= 1)
        errors.append(value - prediction)
    return errors


def float32(x):
    return float(np.float32(x))


def metrics(pairs, n, k):
    """``pairs`` of (actual, error)."""
    mse = sum(e * e for _, e in pairs) / len(pairs)
    maape = sum(math.atan2(abs(e), abs(y)) for y, e in pairs) / len(pairs)

    def ln(x):
        return math.log(x) if x else -math.inf

    return {
        "mse": mse,
        "maape": maape,
        "aic_mse": 2 * k - 2 * ln(mse),
        "aic_maape": 2 * k - 2 * ln(maape),
        "bic_mse": math.log(n) * k - 2 * ln(mse),
        "bic_maape": math.log(n) * k - 2 * ln(maape),
    }
