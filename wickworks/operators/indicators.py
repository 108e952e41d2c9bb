"""Moving averages, EMA recurrences, MACD and RSI over many series at once.

EMA (y0 = x0, yt = a*xt + (1-a)*y(t-1); a null input makes that row and every
later row null) is a first-order affine recurrence.  It is evaluated as a
*blocked affine scan* on the blocks of ``operators.scan``:

1. inside a block, with b = 1-a and k the row index in the block,
   ``L_k = b^k * sum_{j<=k} a*x_j*b^-j`` is a running-sum window (block size is
   bounded so b^-k stays finite);
2. each block is summarised by (n, S, Y): S = L at its last row, Y = its last
   value had the series started at the block; blocks combine associatively,
   ``S = S2 + b^n2*S1``, ``Y = S2 + b^n2*Y1``;
3. the carry C of a block (EMA value on the row before it, or the block's first
   input for the series' first block) comes from ``exclusive_carries``;
4. ``y_k = L_k + b^(k+1) * C``.

Nulls are carried as NaN through the arithmetic (NaN is sticky, exactly like the
null-propagating fold), and turned back into nulls at the end.

SMA over the last ``w`` rows (partial frames at the start) uses an in-block
``rowsBetween`` window plus the last ``w`` values of the earlier blocks, which
are a block state too (a bounded array).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wickworks.functions.numeric import nan_to_null
from wickworks.operators.scan import (
    add_blocks,
    after_initial,
    attach_carries,
    block_ends,
    block_window,
    exclusive_carries,
    levels_for,
    FoldPlan,
    materialize,
    safe_block_rows,
)
from wickworks.schema import (
    MACD_FAST,
    MACD_SIGNAL,
    MACD_SLOW,
    EMA_PERIOD,
    RSI_PERIOD,
    SERIES_KEY,
    SMA_WINDOW,
    TIMEFRAME_MS,
    ema_alpha,
    wilder_alpha,
)
from wickworks.session import scratch_path

NAN = float("nan")
_UNB = Window.unboundedPreceding


@dataclass(frozen=True)
class Ema:
    """One EMA channel: ``name`` = EMA(``source``) with smoothing ``alpha``."""

    name: str
    source: str
    alpha: float

    @property
    def beta(self) -> float:
        return 1.0 - self.alpha


def _nan_coded(c: str) -> Column:
    return F.when(F.col(c).isNull(), F.lit(NAN)).otherwise(F.col(c).cast("double"))


class _EmaChannels:
    def __init__(self, specs: Sequence[Ema], with_prev: bool = False):
        self.specs = list(specs)
        self.with_prev = with_prev

    def window_phases(self, wb: Window) -> list[dict[str, Column]]:
        run = wb.rowsBetween(_UNB, 0)
        kb = F.col("_kb")
        xs, local = {}, {}
        for e in self.specs:
            xs[f"_x_{e.name}"] = _nan_coded(e.source)
            x = F.col(f"_x_{e.name}")
            if e.beta == 0.0:
                # the recurrence forgets x but, as for any other alpha, not that a null was there
                lv = F.when(F.max(F.isnan(x)).over(run), F.lit(NAN)).otherwise(F.lit(e.alpha) * x)
            else:
                b = F.lit(e.beta)
                lv = F.pow(b, kb) * F.sum(F.lit(e.alpha) * x * F.pow(b, -kb)).over(run)
            local[f"_L_{e.name}"] = lv
            local[f"_f_{e.name}"] = F.first(x).over(run)
        lags = {f"_pL_{e.name}": F.lag(f"_L_{e.name}", 1).over(wb) for e in self.specs} if self.with_prev else {}
        return [xs, local, lags]

    def elem_aggs(self) -> list[Column]:
        out = []
        for e in self.specs:
            out.append(F.max_by(f"_L_{e.name}", "_kb").alias(f"_s_{e.name}"))
            out.append(F.min_by(f"_x_{e.name}", "_kb").alias(f"_fx_{e.name}"))
        return out

    def state_fields(self) -> list[Column]:
        out = []
        for e in self.specs:
            s = F.col(f"_s_{e.name}")
            out.append(s.alias(f"s_{e.name}"))
            out.append((s + F.pow(F.lit(e.beta), F.col("_n")) * F.col(f"_fx_{e.name}")).alias(f"y_{e.name}"))
        return out

    def combine_fields(self, a: str, b: str) -> list[str]:
        out = []
        for e in self.specs:
            decay = f"pow({e.beta!r}D, {b}.n)"
            out.append(f"'s_{e.name}', {b}.s_{e.name} + {decay} * {a}.s_{e.name}")
            out.append(f"'y_{e.name}', {b}.s_{e.name} + {decay} * {a}.y_{e.name}")
        return out

    def finalize_cols(self) -> dict[str, Column]:
        kb = F.col("_kb")
        c = F.col("_c")
        out = {}
        for e in self.specs:
            carry = F.coalesce(c[f"y_{e.name}"], F.col(f"_f_{e.name}"))
            b = F.lit(e.beta)
            y = F.col(f"_L_{e.name}") + F.pow(b, kb + 1) * carry
            # the series' first row is its input exactly (a*x + b*x can differ in the last bit)
            y = F.when(c.isNull() & (kb == 0), F.col(f"_x_{e.name}")).otherwise(y)
            out[e.name] = nan_to_null(y)
            if self.with_prev:
                prev = (
                    F.when(kb == 0, c[f"y_{e.name}"])
                    .when(c.isNull() & (kb == 1), F.col(f"_f_{e.name}"))
                    .otherwise(F.col(f"_pL_{e.name}") + F.pow(b, kb) * carry)
                )
                out[f"prev_{e.name}"] = nan_to_null(prev)
        return out

    def temp_cols(self) -> list[str]:
        out = []
        for e in self.specs:
            out += [f"_x_{e.name}", f"_L_{e.name}", f"_f_{e.name}", f"_pL_{e.name}"]
        return out


class _SmaChannel:
    """SMA over the last ``window`` rows, plus the previous row's SMA."""

    def __init__(self, name: str, source: str, window: int, with_prev: bool = False):
        self.name, self.source, self.w, self.with_prev = name, source, window, with_prev

    def window_phases(self, wb: Window) -> list[dict[str, Column]]:
        x = F.col(self.source)
        cur = wb.rowsBetween(-(self.w - 1), 0)
        cols = {"_sin": F.sum(x).over(cur), "_cin": F.count(x).over(cur)}
        if self.with_prev:
            prv = wb.rowsBetween(-self.w, -1)
            cols.update({"_sinp": F.sum(x).over(prv), "_cinp": F.count(x).over(prv)})
        cols["_nblk"] = F.count(F.lit(1)).over(wb.rowsBetween(_UNB, Window.unboundedFollowing))
        return [{}, cols, {}]

    def elem_aggs(self) -> list[Column]:
        tail_item = F.when(F.col("_kb") >= F.col("_nblk") - self.w, F.struct("_kb", F.col(self.source).alias("v")))
        return [F.transform(F.sort_array(F.collect_list(tail_item)), lambda t: t["v"]).alias("_tail")]

    def state_fields(self) -> list[Column]:
        return [F.col("_tail").alias("tail")]

    def _last(self, arr: Column, m: Column) -> Column:
        m = F.greatest(m, F.lit(0))
        return F.slice(arr, F.greatest(F.size(arr) - m + 1, F.lit(1)), m)

    def combine_fields(self, a: str, b: str) -> list[str]:
        w = self.w
        return [f"'tail', CASE WHEN size({b}.tail) >= {w} THEN {b}.tail ELSE "
                f"slice(concat({a}.tail, {b}.tail), greatest(size({a}.tail) + size({b}.tail) - {w} + 1, 1), {w}) END"]

    def carry_fields(self, c: Column) -> Column:
        """Adds ``suf`` to the carry: suf[j+1] = (sum, count) of the last j non-null tail values,
        so that each row reads its frame's older part with one array lookup."""
        init = F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("n"),
                        F.array(F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("n"))).alias("a"))

        def step(acc: Column, v: Column) -> Column:
            s2 = acc["s"] + F.coalesce(v, F.lit(0.0))
            n2 = acc["n"] + F.when(v.isNull(), 0).otherwise(1)
            return F.struct(s2.alias("s"), n2.alias("n"),
                            F.concat(acc["a"], F.array(F.struct(s2.alias("s"), n2.alias("n")))).alias("a"))

        suf = F.aggregate(F.reverse(F.coalesce(c["tail"], F.array().cast("array<double>"))), init, step)["a"]
        return c.withField("suf", suf)

    def _avg_with_tail(self, s_in: Column, c_in: Column, m: Column) -> Column:
        suf = F.col("_c")["suf"]
        m = F.least(F.greatest(m, F.lit(0)), F.size(suf) - 1)
        e = F.element_at(suf, m + 1)
        total_c = F.coalesce(c_in, F.lit(0)) + F.coalesce(e["n"], F.lit(0))
        total_s = F.coalesce(s_in, F.lit(0.0)) + F.coalesce(e["s"], F.lit(0.0))
        return F.when(total_c > 0, total_s / total_c)

    def finalize_cols(self) -> dict[str, Column]:
        kb = F.col("_kb")
        out = {self.name: self._avg_with_tail(F.col("_sin"), F.col("_cin"), F.lit(self.w) - (kb + 1))}
        if self.with_prev:
            out[f"prev_{self.name}"] = (
                F.when(kb == 0, F.when(F.col("_c").isNotNull(), self._avg_with_tail(F.lit(None), F.lit(0), F.lit(self.w))))
                .otherwise(self._avg_with_tail(F.col("_sinp"), F.col("_cinp"), F.lit(self.w) - kb))
            )
        return out

    def temp_cols(self) -> list[str]:
        return ["_sin", "_cin", "_sinp", "_cinp", "_nblk", "_tail"]


def _geo_cross(a9: float, b: float, b9: float, k: Column | str) -> str | Column:
    """sum_{j=0..k} a9 * b9^(k-j) * b^(j+1): how a carry-in C of an inner EMA (decay b)
    reaches an outer EMA (smoothing a9, decay b9) k rows into a block."""
    if isinstance(k, str):  # SQL text
        if b == b9:
            return f"({a9!r}D * ({k} + 1) * pow({b!r}D, {k} + 1))"
        return f"({a9 * b / (b - b9)!r}D * (pow({b!r}D, {k} + 1) - pow({b9!r}D, {k} + 1)))"
    if b == b9:
        return F.lit(a9) * (k + 1) * F.pow(F.lit(b), k + 1)
    return F.lit(a9 * b / (b - b9)) * (F.pow(F.lit(b), k + 1) - F.pow(F.lit(b9), k + 1))


class _SignalChannel:
    """EMA (smoothing ``alpha``) of fast EMA - slow EMA, in the same pass as the two EMAs.

    With carries C_f, C_s of the inner EMAs and C of the signal, row k of a block is
    ``Ls_k + P_f(k)*C_f - P_s(k)*C_s + b^(k+1)*C``, where Ls is the in-block EMA of the
    zero-carry MACD and P are closed-form geometric sums (``_geo_cross``)."""

    def __init__(self, name: str, fast: Ema, slow: Ema, alpha: float, with_prev: bool = False):
        self.name, self.fast, self.slow, self.alpha, self.with_prev = name, fast, slow, alpha, with_prev
        self.beta = 1.0 - alpha

    def window_phases(self, wb: Window) -> list[dict[str, Column]]:
        kb = F.col("_kb")
        b = F.lit(self.beta)
        m = F.col(f"_L_{self.fast.name}") - F.col(f"_L_{self.slow.name}")
        local = F.pow(b, kb) * F.sum(F.lit(self.alpha) * F.col("_Msig") * F.pow(b, -kb)).over(wb.rowsBetween(_UNB, 0))
        lag = {"_pLsig": F.lag("_Lsig", 1).over(wb)} if self.with_prev else {}
        return [{}, {}, {"_Msig": m}, {"_Lsig": local}, lag]

    def elem_aggs(self) -> list[Column]:
        return [F.max_by("_Lsig", "_kb").alias("_s_sig")]

    def state_fields(self) -> list[Column]:
        n1 = F.col("_n") - 1
        x0 = F.col(f"_fx_{self.fast.name}")
        pf = _geo_cross(self.alpha, self.fast.beta, self.beta, n1)
        ps = _geo_cross(self.alpha, self.slow.beta, self.beta, n1)
        return [F.col("_s_sig").alias("s_sig"), (F.col("_s_sig") + pf * x0 - ps * x0).alias("y_sig")]

    def combine_fields(self, a: str, b: str) -> list[str]:
        n1 = f"({b}.n - 1)"
        pf = _geo_cross(self.alpha, self.fast.beta, self.beta, n1)
        ps = _geo_cross(self.alpha, self.slow.beta, self.beta, n1)
        f, sl = self.fast.name, self.slow.name
        decay = f"pow({self.beta!r}D, {b}.n)"
        return [
            f"'s_sig', {b}.s_sig + {pf} * {a}.s_{f} - {ps} * {a}.s_{sl} + {decay} * {a}.s_sig",
            f"'y_sig', {b}.s_sig + {pf} * {a}.y_{f} - {ps} * {a}.y_{sl} + {decay} * {a}.y_sig",
        ]

    def _value(self, local: Column, k: Column) -> Column:
        c = F.col("_c")
        cf = F.coalesce(c[f"y_{self.fast.name}"], F.col(f"_f_{self.fast.name}"))
        cs = F.coalesce(c[f"y_{self.slow.name}"], F.col(f"_f_{self.slow.name}"))
        csig = F.coalesce(c["y_sig"], F.lit(0.0))
        pf = _geo_cross(self.alpha, self.fast.beta, self.beta, k)
        ps = _geo_cross(self.alpha, self.slow.beta, self.beta, k)
        return local + pf * cf - ps * cs + F.pow(F.lit(self.beta), k + 1) * csig

    def finalize_cols(self) -> dict[str, Column]:
        kb = F.col("_kb")
        c = F.col("_c")
        x0 = F.col(f"_f_{self.fast.name}")
        first = c.isNull() & (kb == 0)
        out = {self.name: nan_to_null(F.when(first, x0 - x0).otherwise(self._value(F.col("_Lsig"), kb)))}
        if self.with_prev:
            prev = (
                F.when(kb == 0, c["y_sig"])
                .when(c.isNull() & (kb == 1), x0 - x0)
                .otherwise(self._value(F.col("_pLsig"), kb - 1))
            )
            out[f"prev_{self.name}"] = nan_to_null(prev)
        return out

    def temp_cols(self) -> list[str]:
        return ["_Msig", "_Lsig", "_pLsig", "_s_sig"]


class _WilderChannel:
    """Wilder averages of gains and losses of ``close`` in the same pass as the EMAs.

    Inside a block the first row's gain is left out (it needs the previous block's
    last close); the combine adds it from the neighbours' last/first close, and the
    row finalisation adds it from the carry."""

    def __init__(self, alpha: float, first_x: str, source: str = "close"):
        self.alpha, self.beta, self.first_x, self.source = alpha, 1.0 - alpha, first_x, source

    def window_phases(self, wb: Window) -> list[dict[str, Column]]:
        kb = F.col("_kb")
        x = _nan_coded(self.source)
        lagx = F.col("_lagw")
        up = F.when(kb == 0, F.lit(0.0)).otherwise(F.greatest(x - lagx, F.lit(0.0)))
        down = F.when(kb == 0, F.lit(0.0)).otherwise(F.greatest(lagx - x, F.lit(0.0)))
        run = wb.rowsBetween(_UNB, 0)
        b = F.lit(self.beta)

        def local(col: str) -> Column:
            return F.pow(b, kb) * F.sum(F.lit(self.alpha) * F.col(col) * F.pow(b, -kb)).over(run)

        lag = F.lag(x, 1).over(wb)
        return [{}, {"_lagw": F.when(lag.isNull(), F.lit(NAN)).otherwise(lag)}, {"_gw": up, "_lw": down},
                {"_Lg": local("_gw"), "_Ll": local("_lw")}]

    def elem_aggs(self) -> list[Column]:
        return [F.max_by("_Lg", "_kb").alias("_s_g"), F.max_by("_Ll", "_kb").alias("_s_l")]

    def state_fields(self) -> list[Column]:
        return [F.col("_s_g").alias("s_g"), F.col("_s_g").alias("y_g"),
                F.col("_s_l").alias("s_l"), F.col("_s_l").alias("y_l"),
                F.col(f"_fx_{self.first_x}").alias("f_close")]

    def combine_fields(self, a: str, b: str) -> list[str]:
        last = f"coalesce({a}.last_{self.source}, double('NaN'))"
        g0 = f"greatest({b}.f_close - {last}, 0D)"
        l0 = f"greatest({last} - {b}.f_close, 0D)"
        head = f"pow({self.beta!r}D, {b}.n - 1)"
        decay = f"pow({self.beta!r}D, {b}.n)"
        out = []
        for v, d in (("g", g0), ("l", l0)):
            out.append(f"'s_{v}', {b}.s_{v} + {self.alpha!r}D * {d} * {head} + {decay} * {a}.s_{v}")
            out.append(f"'y_{v}', {b}.s_{v} + {self.alpha!r}D * {d} * {head} + {decay} * {a}.y_{v}")
        out.append(f"'f_close', {a}.f_close")
        return out

    def finalize_cols(self) -> dict[str, Column]:
        kb = F.col("_kb")
        c = F.col("_c")
        x0 = F.col(f"_f_{self.first_x}")
        last = F.coalesce(c[f"last_{self.source}"], F.lit(NAN))
        b = F.lit(self.beta)
        out = {}
        for v, col, d in (("g", "_Lg", x0 - last), ("l", "_Ll", last - x0)):
            head = F.when(c.isNull(), F.lit(0.0)).otherwise(F.greatest(d, F.lit(0.0)))
            carry = F.coalesce(c[f"y_{v}"], F.lit(0.0))
            val = F.col(col) + F.lit(self.alpha) * head * F.pow(b, kb) + F.pow(b, kb + 1) * carry
            out[f"_avg_{'gain' if v == 'g' else 'loss'}"] = nan_to_null(val)
        return out

    def temp_cols(self) -> list[str]:
        return ["_lagw", "_gw", "_lw", "_Lg", "_Ll", "_s_g", "_s_l"]


class _LastChannel:
    """Previous row's value of ``source`` (null on the series' first row)."""

    def __init__(self, source: str):
        self.source = source

    def window_phases(self, wb: Window) -> list[dict[str, Column]]:
        return [{}, {f"_lag_{self.source}": F.lag(self.source, 1).over(wb)}, {}]

    def elem_aggs(self) -> list[Column]:
        return [F.max_by(self.source, "_kb").alias(f"_last_{self.source}")]

    def state_fields(self) -> list[Column]:
        return [F.col(f"_last_{self.source}").alias(f"last_{self.source}")]

    def combine_fields(self, a: str, b: str) -> list[str]:
        return [f"'last_{self.source}', {b}.last_{self.source}"]

    def finalize_cols(self) -> dict[str, Column]:
        prev = F.when(F.col("_kb") == 0, F.col("_c")[f"last_{self.source}"]).otherwise(F.col(f"_lag_{self.source}"))
        return {f"prev_{self.source}": prev}

    def temp_cols(self) -> list[str]:
        return [f"_lag_{self.source}", f"_last_{self.source}"]


def _materialize(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, FoldPlan]:
    return materialize(df, keys)


def _levels(min_timeframe: str | None, block_rows: int) -> int:
    ms = TIMEFRAME_MS.get(min_timeframe or "1m", TIMEFRAME_MS["1m"])
    return levels_for(ms, block_rows)


def _scan_pass(
    blocked: DataFrame,
    keys: Sequence[str],
    channels: Sequence,
    levels: int,
    initial: DataFrame | None = None,
    with_ends: bool = False,
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Window stage, block states, carries, finalisation for a set of channels.

    ``initial``: states (keys, ``state``) that series go on from.  ``with_ends``:
    also returns the state after each block (``scan.block_ends``)."""
    wb = block_window(keys)
    df = blocked
    phases = [ch.window_phases(wb) for ch in channels]
    for i in range(max((len(ph) for ph in phases), default=0)):
        cols = {k: v for ph in phases if i < len(ph) for k, v in ph[i].items()}
        if cols:
            df = df.withColumns(cols)
    aggs = [F.count(F.lit(1)).alias("_n")]
    if with_ends:
        aggs.append(F.max("event_time").alias("last_time"))
    for ch in channels:
        aggs += ch.elem_aggs()
    elems = df.groupBy(*keys, "_bucket", "_sub").agg(*aggs)
    fields = [F.col("_n").alias("n")]
    for ch in channels:
        fields += ch.state_fields()
    ends = [F.col("last_time")] if with_ends else []
    elems = elems.select(*keys, "_bucket", "_sub", F.struct(*fields).alias("_st"), *ends)
    if with_ends:  # one row per block, read by the fold and for the ends
        elems = _written(elems, "block-states")

    def combine(a: str, b: str) -> str:
        out = [f"'n', {a}.n + {b}.n"]
        for ch in channels:
            out += ch.combine_fields(a, b)
        return "named_struct(" + ", ".join(out) + ")"

    carries = exclusive_carries(elems, keys, "_st", combine, levels)
    if initial is not None:
        carries = after_initial(carries, initial, keys, combine)
    if with_ends:
        carries = _written(carries, "block-carries")
        after = block_ends(elems, carries, keys, combine)
    finish = next((ch.carry_fields for ch in channels if hasattr(ch, "carry_fields")), None)
    df = attach_carries(df, carries, keys, finish)
    fin = {"_pos": F.coalesce(F.col("_c")["n"], F.lit(0)) + F.col("_kb")}
    for ch in channels:
        fin.update(ch.finalize_cols())
    df = df.withColumns(fin)
    drop = ["_c"]
    for ch in channels:
        drop += ch.temp_cols()
    df = df.drop(*[c for c in drop if c in df.columns])
    return (df, after) if with_ends else df


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _prepare(df: DataFrame, keys: Sequence[str], alphas: Sequence[float], timeframe_col: str | None,
             order_cols: Sequence[str] | None) -> tuple[DataFrame, FoldPlan]:
    """Blocked, materialized rows and the fold depth their bucket span needs."""
    block = safe_block_rows(alphas)
    order = list(order_cols or ["event_time"])
    return _materialize(add_blocks(df, keys, order, "event_time", timeframe_col, block), keys)


def ema(
    df: DataFrame,
    specs: Sequence[Ema],
    keys: Sequence[str] = SERIES_KEY,
    timeframe_col: str | None = "timeframe",
    order_cols: Sequence[str] | None = None,
    with_prev: bool = False,
    with_position: bool = False,
) -> DataFrame:
    """Adds one column per ``Ema`` spec (H1, P8 with free parameters)."""
    blocked, levels = _prepare(df, keys, [s.alpha for s in specs], timeframe_col, order_cols)
    out = _scan_pass(blocked, keys, [_EmaChannels(specs, with_prev)], levels)
    if with_position:
        out = out.withColumnRenamed("_pos", "idx")
    return out.drop("_bucket", "_sub", "_kb", "_pos")


def sma(
    df: DataFrame,
    source: str = "close",
    window: int = SMA_WINDOW,
    name: str | None = None,
    keys: Sequence[str] = SERIES_KEY,
    timeframe_col: str | None = "timeframe",
    with_prev: bool = False,
) -> DataFrame:
    """Mean of the current and up to ``window - 1`` preceding rows of the series."""
    name = name or f"sma_{window}"
    blocked, levels = _prepare(df, keys, [], timeframe_col, None)
    out = _scan_pass(blocked, keys, [_SmaChannel(name, source, window, with_prev)], levels)
    return out.drop("_bucket", "_sub", "_kb", "_pos")


def row_index(
    df: DataFrame,
    keys: Sequence[str] = SERIES_KEY,
    name: str = "idx",
    timeframe_col: str | None = "timeframe",
    order_cols: Sequence[str] | None = None,
) -> DataFrame:
    """0-based row position in event_time order within each series (G1)."""
    blocked, levels = _prepare(df, keys, [], timeframe_col, order_cols)
    out = _scan_pass(blocked, keys, [], levels)
    return out.withColumn(name, F.col("_pos").cast("int")).drop("_bucket", "_sub", "_kb", "_pos")


def indicators(
    df: DataFrame,
    keys: Sequence[str] = SERIES_KEY,
    sma_window: int = SMA_WINDOW,
    ema_period: int = EMA_PERIOD,
    macd_fast: int = MACD_FAST,
    macd_slow: int = MACD_SLOW,
    macd_signal: int = MACD_SIGNAL,
    rsi_period: int = RSI_PERIOD,
    timeframe_col: str | None = "timeframe",
    min_timeframe: str | None = None,
    keep_internal: bool = False,
    materialize: bool = True,
) -> DataFrame:
    """Gold indicators on candle rows: SMA, EMA, MACD/signal/histogram and RSI.

    One scan pass: EMA fast/slow/trend, SMA tail, previous close, the MACD signal
    line (an EMA of the EMA difference, composed in the same carries) and Wilder's
    gain/loss averages (the first gain of a block is fixed up from the carry).

    ``materialize`` writes the pass input once as a bucketed table (see
    ``scan.materialize``); the fold depth then follows the observed bucket span.
    Without it the depth is planned statically from ``min_timeframe``."""
    gold = _Gold(sma_window, ema_period, macd_fast, macd_slow, macd_signal, rsi_period)
    levels = _levels(min_timeframe, gold.block)
    blocked = add_blocks(df, keys, ["event_time"], "event_time", timeframe_col, gold.block)
    if materialize:
        blocked, levels = _materialize(blocked, keys)
    return gold.finished(_scan_pass(blocked, keys, gold.channels, levels), keep_internal)


def indicators_from(
    df: DataFrame,
    states: DataFrame | None = None,
    keys: Sequence[str] = SERIES_KEY,
    timeframe_col: str | None = "timeframe",
    per_month: bool = False,
    keep_internal: bool = False,
    **periods: int,
) -> tuple[DataFrame, DataFrame]:
    """Gold indicators of rows that go on from earlier ones, and the states to go on from later.

    ``states``: one row (keys, ``state``) per series that has earlier rows, all of
    them before its rows in ``df``; a series without one starts here.  Returns the
    rows as ``indicators`` does, equal to those of a computation over all rows, and
    (keys, ``_bucket``, ``_sub``, ``last_time``, ``state``): the state after each
    block, of which the last of a series (or of a month, with ``per_month``) is
    kept to go on from.  A state holds all channels: rows so far, EMAs, signal
    line, Wilder averages, last close and the last closes of the SMA.  ``periods``
    are those of ``indicators``, the same for all parts of a series."""
    gold = _Gold(**periods)
    blocked, levels = _materialize(add_blocks(df, keys, ["event_time"], "event_time", timeframe_col, gold.block, per_month), keys)
    rows, ends = _scan_pass(blocked, keys, gold.channels, levels, states, with_ends=True)
    return gold.finished(rows, keep_internal), ends


class _Gold:
    """The channels of the gold pass, and its finished columns."""

    def __init__(self, sma_window: int = SMA_WINDOW, ema_period: int = EMA_PERIOD, macd_fast: int = MACD_FAST,
                 macd_slow: int = MACD_SLOW, macd_signal: int = MACD_SIGNAL, rsi_period: int = RSI_PERIOD):
        self.sma_name, self.ema_name, self.rsi_name = f"sma_{sma_window}", f"ema_{ema_period}", f"rsi_{rsi_period}"
        a_fast, a_slow = ema_alpha(macd_fast), ema_alpha(macd_slow)
        a_sig, a_rsi, a_ema = ema_alpha(macd_signal), wilder_alpha(rsi_period), ema_alpha(ema_period)
        self.block = safe_block_rows([a_fast, a_slow, a_sig, a_rsi, a_ema])
        fast, slow = Ema("_ema_fast", "close", a_fast), Ema("_ema_slow", "close", a_slow)
        self.channels = [
            _EmaChannels([Ema(self.ema_name, "close", a_ema), fast, slow], with_prev=True),
            _SmaChannel(self.sma_name, "close", sma_window, with_prev=True),
            _LastChannel("close"),
            _SignalChannel("macd_signal", fast, slow, a_sig, with_prev=True),
            _WilderChannel(a_rsi, fast.name),
        ]

    def finished(self, rows: DataFrame, keep_internal: bool) -> DataFrame:
        gain, loss = F.col("_avg_gain"), F.col("_avg_loss")
        out = rows.withColumns({
            "macd": F.col("_ema_fast") - F.col("_ema_slow"),
            "prev_macd": F.col("prev__ema_fast") - F.col("prev__ema_slow"),
            self.rsi_name: F.when(F.col("_pos") == 0, F.lit(None).cast("double"))
            .when(loss == 0, F.lit(100.0))
            .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + gain / loss)),
            "idx": F.col("_pos").cast("int"),
        })
        out = out.withColumn("macd_hist", F.col("macd") - F.col("macd_signal"))
        internal = ["_delta", "_gain", "_loss", "_avg_gain", "_avg_loss", "_ema_fast", "_ema_slow",
                    "prev__ema_fast", "prev__ema_slow", "prev__avg_gain", "prev__avg_loss", "_pos_a", "_pos",
                    "_bucket", "_sub", "_kb"]
        out = out.drop(*[c for c in internal if c in out.columns])
        if not keep_internal:
            out = out.drop("idx", "prev_close", f"prev_{self.ema_name}", f"prev_{self.sma_name}", "prev_macd", "prev_macd_signal")
        return out
