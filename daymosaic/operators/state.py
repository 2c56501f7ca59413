"""Carrying a point's state from day to day.

The state for a day D of a run at date T is the latest one stored between
min(D - 1, T - 387) and D - 1; without one, the initial state is used. The same
rule is given in two forms: one for a run over few days, one for many.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymosaic.fixed_values import STATE_OLDEST


def oldest_state(date: Column, run_date: dt.date) -> Column:
    return F.least(F.date_sub(date, 1), F.lit(run_date - dt.timedelta(STATE_OLDEST)))


def latest_per_day(history: DataFrame, keys, order: str | None = None) -> DataFrame:
    """One state per key and day; of several, the one with the highest ``order``, else the highest hash.

    Aggregated before the shuffle: a key reaches its task with at most one row a
    day, however many rows it has.
    """
    rank = F.xxhash64("state") if order is None else F.col(order)
    return history.groupBy(*keys, "state_date").agg(F.max_by("state", rank).alias("state"))


def state_asof(
    requests: DataFrame, history: DataFrame, keys, dates: list[dt.date], run_date: dt.date,
    initial: Column, order: str | None = None,
) -> DataFrame:
    """State for each request; every state is compared with the few ``dates`` of the run.

    The best day is found on dates alone, by hash aggregation before the shuffle;
    the state of that day is then fetched by equality. ``requests`` has the
    keys and ``date``, one row each; their dates are among ``dates``. Its other
    columns stay, and ``initial`` may use them.
    """
    keys = list(keys)
    serves = F.filter(
        F.array(*[F.lit(d) for d in sorted(dates)]),
        lambda d: (F.col("state_date") < d) & (F.col("state_date") >= oldest_state(d, run_date)),
    )
    first = min(min(dates) - dt.timedelta(1), run_date - dt.timedelta(STATE_OLDEST))
    usable = history.where(F.col("state_date").between(F.lit(first), F.lit(max(dates) - dt.timedelta(1))))
    best = (
        usable.select(*keys, "state_date").withColumn("date", F.explode(serves))
        .groupBy(*keys, "date").agg(F.max("state_date").alias("state_date"))
    )
    found = best.join(latest_per_day(usable, keys, order), [*keys, "state_date"])
    return requests.join(found, [*keys, "date"], "left").select(
        *requests.columns, "state_date", F.coalesce("state", initial).alias("state")
    )


def state_asof_window(
    requests: DataFrame, history: DataFrame, keys, run_date: dt.date,
    initial: Column, order: str | None = None, dates: list[dt.date] | None = None,
) -> DataFrame:
    """The same for any number of days, without comparing every day with every state.

    Days inside the look-back are served by carrying the last state along each
    key's days; a key contributes at most one row a day of the look-back. An
    older day can only be served by the very day before it: an equality join.
    The contract is that of ``state_asof``; ``dates``, the requested days where
    they are known, leave out states that can serve none of them.
    """
    keys = list(keys)
    limit = run_date - dt.timedelta(STATE_OLDEST)
    edge = limit + dt.timedelta(1)
    is_recent = F.col("date") > F.lit(edge)
    near = history.where(F.col("state_date") >= F.lit(limit))
    far = history.where(F.col("state_date") <= F.lit(limit))
    if dates is not None:
        near = near.where(F.col("state_date") < F.lit(max(dates)))
        far = far.where(F.col("state_date").isin([d - dt.timedelta(1) for d in dates if d <= edge]))

    whole = F.struct(*requests.columns)
    states = latest_per_day(near, keys, order).select(
        *keys, F.col("state_date").alias("_day"), F.lit(1).alias("_kind"),
        F.struct("state_date", "state").alias("_carried"),
    )
    recent = requests.where(is_recent).select(
        *keys, F.col("date").alias("_day"), F.lit(0).alias("_kind"),
        F.lit(None).cast(states.schema["_carried"].dataType).alias("_carried"), whole.alias("_request"),
    )
    so_far = (
        Window.partitionBy(*keys).orderBy("_day", "_kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    served = (
        recent.unionByName(states, allowMissingColumns=True)
        .withColumn("_last", F.last("_carried", ignorenulls=True).over(so_far))
        .where(F.col("_kind") == 0)
        .select("_request.*", "_last.state_date", "_last.state")
    )
    if dates is None or min(dates) <= edge:
        before = latest_per_day(far, keys, order).withColumn("_before", F.col("state_date"))
        older = (
            requests.where(~is_recent).withColumn("_before", F.date_sub("date", 1))
            .join(before, [*keys, "_before"], "left")
            .select(*requests.columns, "state_date", "state")
        )
        served = served.unionByName(older)
    return served.select(*requests.columns, "state_date", F.coalesce("state", initial).alias("state"))


def states_of_days(
    points: DataFrame, history: DataFrame, keys, dates: list[dt.date], run_date: dt.date, initial: str,
    order: str | None = None, one_a_day: bool = False,
) -> DataFrame:
    """Each of ``points`` (one row a key) on each of ``dates``, with ``state_date`` and ``state``; ``initial`` is a column of theirs.

    A state serves the days up to the next one. So each state is given the asked days it serves, at most
    one state a day, and a key's states become one row, no longer than ``dates``. All of that happens in the partitions of
    the keys: a history that is bucketed by them and has ``one_a_day`` does not move, and the points move once.
    """
    keys, days = list(keys), sorted(set(dates))
    first = min(days[0] - dt.timedelta(1), run_date - dt.timedelta(STATE_OLDEST))
    usable = history.where(F.col("state_date").between(F.lit(first), F.lit(days[-1] - dt.timedelta(1))))
    daily = usable.select(*keys, "state_date", "state") if one_a_day else latest_per_day(usable, keys, order)
    following = F.lead("state_date").over(Window.partitionBy(*keys).orderBy("state_date"))
    serves = F.filter(F.array(*[F.lit(d) for d in days]), lambda d: (
        (F.col("state_date") < d) & (F.col("_next").isNull() | (d <= F.col("_next"))) & (F.col("state_date") >= oldest_state(d, run_date))))
    served = daily.withColumn("_next", following).withColumn("_day", F.explode(serves))
    by_key = served.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("_day", F.struct("state_date", "state")))).alias("_states"))
    others = [c for c in points.columns if c != initial]
    asked = points.withColumnRenamed(initial, "_initial").join(by_key.hint("shuffle_hash"), keys, "left").withColumn(
        "date", F.explode(F.array(*[F.lit(d) for d in days])))
    found = F.try_element_at("_states", F.col("date"))
    return asked.withColumn("_found", found).select(
        *others, "date", F.col("_found.state_date").alias("state_date"), F.coalesce("_found.state", F.col("_initial")).alias("state"))


def _clamped(c: Column, low: Column, high: Column) -> Column:
    return F.least(high, F.greatest(low, c))


def _step(shift: Column, low: Column, high: Column) -> Column:
    """The map ``S -> min(high, max(low, S + shift))``."""
    return F.struct(shift.alias("shift"), low.alias("low"), high.alias("high"))


def _after(first: Column, then: Column) -> Column:
    """``first`` followed by ``then``, which is again such a map."""
    return _step(first["shift"] + then["shift"], _clamped(first["low"] + then["shift"], then["low"], then["high"]),
                 _clamped(first["high"] + then["shift"], then["low"], then["high"]))


def _identity() -> Column:
    infinity = F.lit(float("inf"))
    return _step(F.lit(0.0), -infinity, infinity)


def daily_balance(forcing: DataFrame, keys, inflow: Column, demand: Column) -> DataFrame:
    """(keys, date, balance): the day's inflow less its demand, added up before anything moves."""
    zero = F.lit(0.0)
    return forcing.groupBy(*keys, "date").agg(
        (F.coalesce(F.sum(inflow), zero) - F.coalesce(F.sum(demand), zero)).alias("balance"))


def _by_year(daily: DataFrame, keys, capacity: float) -> DataFrame:
    """(keys, _year, _days, _fold): the days of a year in order, and what they do together."""
    full = F.lit(float(capacity))
    return daily.groupBy(*keys, F.year("date").alias("_year")).agg(
        F.sort_array(F.collect_list(F.struct("date", "balance"))).alias("_days")
    ).withColumn("_fold", F.aggregate(
        "_days", _identity(), lambda s, day: _after(s, _step(day["balance"], F.lit(0.0), full))))


def state_fold(
    forcing: DataFrame, keys, inflow: Column, demand: Column, capacity: float, initial: float
) -> DataFrame:
    """Final storage per key of a bucket stepped through its days in order.

    One step is ``S' = min(capacity, max(0, S + inflow - demand))`` with the day's
    totals. A run of steps is again a shift followed by a clamp, so each year of
    a key is folded on its own into (shift, low, high) and only those few triples
    are folded per key. No list has more than 366 entries.
    """
    keys = list(keys)
    years = _by_year(daily_balance(forcing, keys, inflow, demand), keys, capacity).select(
        *keys, "_year", F.size("_days").alias("_n"), "_fold")
    return (
        years.groupBy(*keys)
        .agg(F.sum("_n").alias("n_days"), F.sort_array(F.collect_list(F.struct("_year", "_fold"))).alias("_years"))
        .select(*keys, "n_days", F.aggregate(
            "_years", F.lit(float(initial)),
            lambda s, y: _clamped(s + y["_fold"]["shift"], y["_fold"]["low"], y["_fold"]["high"]),
        ).alias("storage"))
    )


def state_trajectory(
    forcing: DataFrame, keys, inflow: Column, demand: Column, capacity: float, initial: float
) -> DataFrame:
    """(keys, date, storage): the storage of the bucket at the end of each of its days.

    A prefix scan in two levels. Each year of a key is folded into one triple; the storages its years
    begin with follow from the triples before them, a few a key; then all years are stepped through from their own
    beginning, at the same time. Nothing but the triples is ordered across years, and there is no Python.
    """
    keys, full = list(keys), F.lit(float(capacity))
    years = _by_year(daily_balance(forcing, keys, inflow, demand), keys, capacity)
    # the few triples of a key, each with the ones before it
    earlier = F.collect_list("_fold").over(
        Window.partitionBy(*keys).orderBy("_year").rowsBetween(Window.unboundedPreceding, -1))
    begun = years.withColumn("_start", F.aggregate(
        earlier, F.lit(float(initial)), lambda s, f: _clamped(s + f["shift"], f["low"], f["high"])))
    # the storages after each day, one after the other in an array
    stepped = F.aggregate("_days", F.array(F.col("_start")), lambda s, day: F.concat(
        s, F.array(_clamped(F.element_at(s, -1) + day["balance"], F.lit(0.0), full))))
    course = F.arrays_zip(F.transform("_days", lambda d: d["date"]).alias("date"), F.slice(stepped, F.lit(2), F.size("_days")).alias("storage"))
    return begun.select(*keys, F.inline(course))


def fold_days_in_python(daily: DataFrame, keys, step, initial, schema: str) -> DataFrame:
    """Step a user's Python function through the days of each key, in order.

    ``daily`` has one row per key and day. ``step(state, row) -> (state, output)``
    gets each row as a dict; ``output`` is a dict of the columns of ``schema``
    beyond the keys and ``date``. Rows are partitioned and sorted by Spark and
    streamed through in batches: one state is held at a time, never a group.
    """
    import pandas as pd

    keys = list(keys)

    def run(batches):
        current, state = object(), None
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                key = tuple(row[k] for k in keys)
                if key != current:
                    current, state = key, initial
                state, output = step(state, row)
                out.append({**{k: row[k] for k in keys}, "date": row["date"], **output})
            if out:
                yield pd.DataFrame(out)

    return (
        daily.repartition(*keys).sortWithinPartitions(*keys, "date").mapInPandas(run, schema)
    )
