"""AR/MA prediction with given coefficients, after differencing and optional centring.

The error term refers to its own past, e_t = u_t + sum_j theta_j * e_(t-1-j), which no window can say. Each row block runs
the recursion by itself, from a state of zero:

* Where errors die away, the block begins some rows earlier (``memory``): what came before them has then shrunk below
  2**-80 of itself, far beyond the last digit. So it is one pass, like any other operator with a look-back.
* Where they die away slowly or not at all, the zero-state errors are kept, and by superposition the state that a block
  takes over from the one before adds a fixed weight of it to each row. The states come from the last errors of each
  block in a small pass per series, the weights from the powers of the recursion.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isochron.functions.values import as_float32
from isochron.operators.differencing import add_levels, first_rows_skipped
from isochron.operators.metrics import model_metrics
from isochron.operators.rows import (
    HALO_SHARE,
    ROWS_PER_BLOCK,
    block_size,
    in_row_block,
    index_rows,
    row_blocks,
    spread_over_blocks,
)


def coefficients(spec: str | Sequence[float] | None) -> list[float]:
    """``'0.9,0.1'``, a list, or ``None``/``''``/``'none'`` for no terms."""
    if spec is None:
        return []
    if isinstance(spec, str):
        if not spec.strip() or spec.strip().lower() == "none":
            return []
        return [float(c) for c in spec.split(",")]
    return [float(c) for c in spec]


def model_text(p: str, q: str, c: float, d: int, centered: bool) -> str:
    """Parameter text stored with the metrics."""
    parts = [
        f"arima_p={p}",
        f"arima_q={q}",
        f"arima_c={float(c)}",
        f"arima_d={d}",
        f"differencing=step,{d}",
        f"zero_transform={str(centered).lower()}",
    ]
    return " : ".join(parts).replace(",", ";")


def _spec_text(spec: str | Sequence[float] | None) -> str:
    if isinstance(spec, str):
        return spec
    return ",".join(str(c) for c in spec) if spec else "none"


def _checked(p: str | Sequence[float] | None, q: str | Sequence[float] | None) -> tuple[list[float], list[float]]:
    ar, ma = coefficients(p), coefficients(q)
    if len(ma) > len(ar):
        raise ValueError("number of error coefficients exceeds that of the lagged values")
    return ar, ma


def _values_to_model(blocked: DataFrame, d: int, centered: bool, requantize: bool) -> DataFrame:
    """Level ``d`` of row-blocked rows as ``y``, centred on its mean if asked for."""
    level = F.col(f"level_{d}")
    rows = add_levels(blocked, "step", d).filter(F.col("rn") >= first_rows_skipped("step", d, d))
    y: Column = as_float32(level) if requantize else level
    if centered:
        means = rows.groupBy("series").agg(
            F.avg(F.when(~F.col("is_copy"), level)).alias("mean"), F.max("row_block").alias("last_block")
        )
        rows = rows.join(spread_over_blocks(means, "last_block"), ["series", "row_block"])
        y = as_float32(y - F.col("mean")) if requantize else y - F.col("mean")
    return rows.select("series", "ts", "rn", "row_block", "is_copy", y.alias("y"))


def _without_ar(rows: DataFrame, ar: list[float], c: float, first: int) -> DataFrame:
    """Add ``u``, the value less its constant and AR part; NULL on the first row, which has no past."""
    predicted = F.lit(float(c))
    for i, phi in enumerate(ar):
        predicted = predicted + F.coalesce(F.lag("y", i + 1).over(in_row_block()), F.lit(0.0)) * phi
    return rows.withColumn("u", F.when(F.col("rn") > first, F.col("y") - predicted))


def _companion(ma: list[float]) -> np.ndarray:
    """Matrix that moves the state (e_t, e_(t-1), ..) one step on."""
    step = np.zeros((len(ma), len(ma)))
    step[0, :] = ma
    if len(ma) > 1:
        step[1:, :-1] = np.eye(len(ma) - 1)
    return step


FORGOTTEN = 2.0**-80


def memory(ma: list[float], longest: int) -> int | None:
    """Rows after which nothing of a state is left, or ``None`` if they are more than ``longest``."""
    step, power = _companion(ma), np.eye(len(ma))
    for rows in range(longest + 1):
        if np.abs(power).max(initial=0.0) <= FORGOTTEN:
            return rows
        power = power @ step
    return None


def _state_weights(ma: list[float], length: int) -> np.ndarray:
    """What each number of a block's starting state adds to its k-th error, for k = 0..length-1."""
    step = _companion(ma)
    rows, power = np.empty((length, len(ma))), np.eye(len(ma))
    with np.errstate(over="ignore", invalid="ignore"):
        for k in range(length):
            power = power @ step
            rows[k] = power[0]
    return rows


def _segmented_recursion(u: np.ndarray, carried: np.ndarray, position: np.ndarray, step: np.ndarray) -> np.ndarray:
    """States of s_i = step @ s_(i-1) + (u_i, 0, ..) within runs; ``carried`` is the state before the first row.

    ``position`` is the index of a row in its run. Doubling: after round r every row holds the
    effect of the last 2^r rows, so the work is log2(run) array operations.
    """
    states = np.zeros((len(u), step.shape[0]))
    states[:, 0] = u
    states[0] += step @ carried
    power, reach, longest = step, 1, int(position.max(initial=0))
    while reach <= longest:
        moved = states[:-reach] @ power.T
        states[reach:] += np.where((position[reach:] >= reach)[:, None], moved, 0.0)
        power, reach = power @ power, reach * 2
    return states


ERRORS = "series string, ts timestamp_ntz, row_block long, rn long, is_copy boolean, actual double, error double"


def _error_pass(ma: list[float]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Zero-state errors, for ``mapInArrow`` over rows sorted by (series, row_block, rn)."""
    step, order = _companion(ma), len(ma)
    names = [c.split()[0] for c in ERRORS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_state, last_rn = np.zeros(order), None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rn = batch.column("rn").to_numpy(zero_copy_only=False)
            begins = batch.column("is_first").to_numpy(zero_copy_only=False).astype(bool)
            follows = np.append(last_rn is not None and rn[0] == last_rn + 1, rn[1:] == rn[:-1] + 1)
            if not np.all(begins | follows):
                raise ValueError("a row block reached the error pass incomplete or out of order")
            u = pc.fill_null(batch.column("u"), 0.0).to_numpy(zero_copy_only=False)
            carried = np.zeros(order) if begins[0] else last_state  # the block may have begun in an earlier batch
            index = np.arange(len(rn))
            position = index - np.maximum.accumulate(np.where(begins, index, 0))
            states = _segmented_recursion(u, carried, position, step)
            last_state, last_rn = states[-1].copy(), rn[-1]
            predicted = pc.is_valid(batch.column("u")).to_numpy(zero_copy_only=False)
            error = pa.array(states[:, 0], mask=~predicted)
            kept = [batch.column(n) for n in names[:-2]]
            yield pa.RecordBatch.from_arrays([*kept, batch.column("y"), error], names=names)

    return run


def _carry_pass(ma: list[float], size: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Function per series: from the end states of its full blocks to the start states of their successors."""
    order = len(ma)
    over_block = np.linalg.matrix_power(_companion(ma), size)

    def run(ends: pd.DataFrame) -> pd.DataFrame:
        ends = ends.sort_values("row_block")
        carry = np.zeros(order)
        carries = np.empty((len(ends), order))
        for i, end in enumerate(ends[[f"end_{j}" for j in range(order)]].to_numpy()):
            carry = over_block @ carry + end
            carries[i] = carry
        out = pd.DataFrame({"series": ends["series"].to_numpy(), "row_block": ends["row_block"].to_numpy() + 1})
        return out.assign(**{f"carry_{j}": carries[:, j] for j in range(order)})

    return run


def _last_errors(order: int, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The last ``order`` zero-state errors of full blocks, for ``mapInArrow``: they are the block's end state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, rn = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("row_block", "rn"))
            back = (block + 1) * size - 1 - rn
            own = batch.filter(pa.array(back < order))
            error = pc.fill_null(own.column("error"), 0.0)
            yield pa.RecordBatch.from_arrays(
                [own.column("series"), own.column("row_block"), pa.array(back[back < order]), error],
                names=["series", "row_block", "back", "error"],
            )

    return run


def _with_carried(zero: DataFrame, ma: list[float], size: int) -> DataFrame:
    """Errors from zero-state errors: what the block before leaves behind is added, each row by its weight.

    Both uses of the rows read one exchange, so that nothing before it runs twice: neither of them lets a filter or a
    choice of columns pass below.
    """
    order = len(ma)
    rows = zero.repartition("series", "row_block")
    last = rows.mapInArrow(_last_errors(order, size), "series string, row_block long, back long, error double")
    ends = last.groupBy("series", "row_block").agg(
        *[F.max(F.when(F.col("back") == j, F.col("error"))).alias(f"end_{j}") for j in range(order)]
    )
    # One row per block: a series of hourly rows over years 1 to 9999 has at most ~28,600 of them. The last block of a
    # series may be full, too; nothing meets the state it leaves.
    full = ends.filter(F.col("end_0").isNotNull())
    carry_columns = ", ".join(f"carry_{j} double" for j in range(order))
    starts = full.groupBy("series").applyInPandas(_carry_pass(ma, size), f"series string, row_block bigint, {carry_columns}")
    weights = _state_weights(ma, size)
    table = zero.sparkSession.createDataFrame(
        pd.DataFrame({"k": np.arange(size), **{f"w_{j}": weights[:, j] for j in range(order)}})
    )
    weighed = rows.withColumn("k", F.col("rn") - F.col("row_block") * size).join(
        F.broadcast(table),  # one row per position in a block: its size is fixed
        "k",
    )
    added = sum((F.col(f"w_{j}") * F.col(f"carry_{j}") for j in range(1, order)), F.col("w_0") * F.col("carry_0"))
    whole = F.when(F.col("carry_0").isNull(), F.col("error")).otherwise(F.col("error") + added)
    joined = weighed.join(starts, ["series", "row_block"], "left").filter(~F.col("is_copy"))
    return joined.select("series", "ts", "actual", whole.alias("error"))


def arima_errors(
    df: DataFrame,
    p: str | Sequence[float] | None = "0.9,0.1",
    d: int = 1,
    q: str | Sequence[float] | None = "0.5",
    c: float = 0.0,
    centered: bool = False,
    requantize: bool = True,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """``series, ts, actual, error`` for every modelled row; the error of a series' first row is NULL.

    ``requantize`` narrows the differenced (and the centred) values to float32, as a store that
    keeps readings in that precision between the steps would.
    """
    ar, ma = _checked(p, q)
    if d < 0:
        raise ValueError("d must not be negative")
    back = d + len(ar)
    early = memory(ma, max(rows_per_block // HALO_SHARE - back, 0)) if ma else 0
    halo = back + (early or 0)
    size = block_size(halo, rows_per_block)
    first = first_rows_skipped("step", d, d)
    blocked = row_blocks(index_rows(df).select("series", "ts", "value", "rn"), halo, rows_per_block)
    rows = _without_ar(_values_to_model(blocked, d, centered, requantize), ar, c, first)
    if not ma:
        return rows.filter(~F.col("is_copy")).select("series", "ts", F.col("y").alias("actual"), F.col("u").alias("error"))
    begin = F.greatest(F.col("row_block") * size - (early or 0), F.lit(first))
    zero = (
        rows.filter(F.col("rn") >= begin)
        .select("*", (F.col("rn") == begin).alias("is_first"))
        .sortWithinPartitions("series", "row_block", "rn")
        .mapInArrow(_error_pass(ma), ERRORS)
    )
    if early is None:
        return _with_carried(zero, ma, size)
    return zero.filter(~F.col("is_copy")).select("series", "ts", "actual", "error")


def arima(df: DataFrame, **model) -> DataFrame:
    """Predictions from the second row on; see :func:`arima_errors` for the model parameters.

    Output: ``series, ts, actual, prediction, error, sq_error``, all in differenced space.
    """
    return arima_points(arima_errors(df, **model))


def arima_points(errors: DataFrame) -> DataFrame:
    error = F.col("error")
    return errors.filter(error.isNotNull()).select(
        "series",
        "ts",
        "actual",
        (F.col("actual") - error).alias("prediction"),
        "error",
        (error * error).alias("sq_error"),
    )


def model_size_and_text(
    p: str | Sequence[float] | None = "0.9,0.1",
    d: int = 1,
    q: str | Sequence[float] | None = "0.5",
    c: float = 0.0,
    centered: bool = False,
    **_: object,
) -> tuple[int, str]:
    """Number of model parameters (all coefficients and a non-zero constant) and their text."""
    ar, ma = _checked(p, q)
    text = model_text(_spec_text(p), _spec_text(q), c, d, centered)
    return len(ar) + len(ma) + (0 if c == 0 else 1), text


def arima_metrics(df: DataFrame, **model) -> DataFrame:
    """Model metrics per series."""
    k, params = model_size_and_text(**model)
    return model_metrics(arima_errors(df, **model), k, params)
