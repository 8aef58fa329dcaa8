"""Prior-only running and trailing metrics, whatever the keys.

"Prior" means strictly earlier in (time, id) order.  A trailing window of length ``w`` also keeps
the row that is exactly ``w`` old.  A SQL range frame re-aggregates its whole frame for every row,
so a busy key costs rows x frame.  Here each row instead enters the key's timeline once and leaves
it once:

* kind 0, at its own time: the row itself, adding its measures;
* kind 1, at time + w: its expiry for window ``w``, taking them off again.

Every metric is then one running total over (time, kind, id): linear, whatever the window length.
Distinct counts work the same way: a first pass per (key, value) marks the events at which a value
appears in or vanishes from the window, a second pass sums those marks per key.

Work is dealt by ranges of (key, time, id) that hold about equally many events, not by keys.  Cut
points are every so many events of a hash sample in that order, stored as a table; a key through
which cuts run falls into segments.  Totals of a key's earlier segments are pre-aggregated, summed
up in a tree, and enter each segment as one opening row (kind -1).  So no task holds more than a
range, whether a key is long, bursts at one instant or is one of very many, and the result is
exactly that of the uncut timeline.
"""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..workspace import fresh_folder

# Amounts run as whole 1/10000 units (no currency has finer minor units): adding and taking off
# leaves no residue, and totals up to 9e14 fit a long; beyond that the sum fails loudly.  So does an
# amount with finer digits: nothing is rounded away.
_UNITS = 10_000


def money(column: Column) -> Column:
    scaled = column.cast("double") * _UNITS
    whole = F.round(scaled)
    # what the binary form of a decimal number with four digits can be off by
    off = F.abs(scaled - whole) > F.greatest(F.lit(1e-6), F.abs(scaled) * 1e-14)
    return F.when(off, F.raise_error(F.concat(
        F.lit("amount finer than 1/10000: "), column.cast("string"))).cast("double")) \
        .otherwise(whole).cast("bigint")


def amount_of(units: Column) -> Column:
    return units / float(_UNITS)


_START = -(2 ** 62)  # before any time
_NULL_SPREAD = 1024  # rows without a key are spread, their results are fixed


SEGMENT_ROWS = 2_000_000  # events of a range, about
_SAMPLED = 16  # sampled events per range
_FAN = 256  # segments that one task of the tree sums up
BROADCAST_ROWS = 500_000  # cut points, or crowded keys: some 20 MB


@dataclass(frozen=True)
class Cuts:
    """Cut points (time, phase, id) of the keys through which any run: a stored table, or none.

    Where the cuts lie affects speed only, never results.
    """

    table: DataFrame | None = None
    points: int = 0
    longest: int = 0  # cut points of one key, at most

    def __bool__(self):
        return self.points > 0

    def beside(self, events: DataFrame, key: str, how: str) -> DataFrame:
        table = F.broadcast(self.table) if self.points <= BROADCAST_ROWS else self.table
        return events.join(table, key, how)

    def segment(self) -> Column:
        """How many of the key's cut points lie at or before the event: a binary search."""
        probe = F.struct("_at", "_phase", "_id")
        steps = [1 << b for b in reversed(range(self.longest.bit_length()))]
        return F.aggregate(
            F.array(*map(F.lit, steps)), F.lit(0),
            lambda found, step: F.when(F.get("_cuts", found + step - 1) <= probe, found + step)
            .otherwise(found))


NONE = Cuts()


def cut_points(rows: DataFrame, key: str, time: str, row_id: str, windows: dict,
               carry: list) -> Cuts:
    """Cut points of the events that ``rows`` unfold into.

    Sampled events are range-sorted; every so many of a range give a cut point, so the number of
    cut points follows the number of events and no key's events meet in one task.
    """
    size, kinds = SEGMENT_ROWS, 1 + len(windows)
    if rows.count() * kinds <= size:
        return NONE
    every = max(1, size // (_SAMPLED * kinds))
    sample = rows.where(F.col(key).isNotNull() & (F.pmod(F.xxhash64(row_id), F.lit(every)) == 0))
    order = [key, "_at", "_phase", "_id"]
    ranged = (_lay_out(sample, key, time, row_id, windows, carry, []).select(*order)
              .repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    points = (ranged.withColumn("_place", place)
              .where(F.col("_place") % max(2, size // every) == 0)
              .groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_at", "_phase", "_id")))
                                .alias("_cuts")))
    path = fresh_folder(rows.sparkSession, "cuts")
    points.write.parquet(path)
    table = rows.sparkSession.read.parquet(path)
    found = table.agg(F.sum(F.size("_cuts")), F.max(F.size("_cuts"))).first()
    return Cuts(table, found[0], found[1]) if found[0] else NONE


@dataclass
class Timeline:
    """Rows of one key unfolded into enter/leave events.

    :meth:`appearances` and :meth:`scan` say what is wanted; :meth:`fold` computes it in one
    exchange and returns to one row per input row.
    """

    events: DataFrame
    key: str
    windows: dict
    cuts: Cuts
    cut_events: DataFrame | None  # narrow events of the keys that are cut, for segment totals
    rows: list  # what the input row is put together from
    values: list = field(default_factory=list)  # (column, windows) whose presence is tracked
    sums: dict = field(default_factory=dict)
    marks: dict = field(default_factory=dict)
    lasts: dict = field(default_factory=dict)

    # -- what to compute ------------------------------------------------------------------------

    def appearances(self, value: str, windows: list) -> "Timeline":
        """Track, per window, where ``value`` appears (+1) or vanishes (-1) for the key.

        The mark ``_mark_<value>_<window>`` can be summed in :meth:`scan` or kept by :meth:`fold`.
        A missing value counts as one more value.  With window None the mark is 1 on the first row
        that ever carries the value.
        """
        self.values.append((value, windows))
        return self

    def scan(self, sums: dict, marks: dict | None = None, lasts: dict | None = None) -> "Timeline":
        """What :meth:`fold` adds as ``prior_<name>``, over the strictly earlier events of the key.

        sums:  name -> (value, window): prior total of the whole-number ``value``.
        marks: name -> (value column, window) or (value column, window, weight): how many values
               are present; with a weight, the sum of the weights of the values present.
        lasts: name -> column: the value on the key's immediately preceding row.
        """
        self.sums, self.marks, self.lasts = sums, marks or {}, lasts or {}
        return self

    # -- pieces ---------------------------------------------------------------------------------

    def _change(self, value: Column, window: str | None) -> Column:
        """+value when the row enters, -value when it leaves ``window`` (None: it never leaves)."""
        change = F.when(F.col("_kind") == 0, value)
        if window is not None:
            kind = 1 + list(self.windows).index(window)
            change = change.when(F.col("_kind") == kind, -value)
        return F.coalesce(change, F.lit(0)).cast("bigint")

    def _weight(self, name: str) -> Column:
        spec = self.marks[name]
        return spec[2] if len(spec) > 2 else F.lit(1)

    def _presence(self, value: str, windows: list) -> dict:
        return {f"n_{value}_{w}": self._change(F.lit(1), w) for w in windows}

    # -- openings of the segments of keys that are cut ------------------------------------------

    def _segment_totals(self, by: list, sums: dict, lasts: dict) -> DataFrame:
        """Totals per (key, segment), combined on the map side before the shuffle."""
        aggregates = [F.sum(change).alias(f"_d_{name}") for name, change in sums.items()]
        aggregates += [
            F.max(F.when(F.col("_kind") == 0, F.struct("_at", "_id", value.alias("v"))))
            .getField("v").alias(f"_l_{name}") for name, value in lasts.items()]
        return self.cut_events.groupBy(*by, "_segment").agg(*aggregates)

    @staticmethod
    def _before(totals: DataFrame, by: list, sums: list, lasts: list) -> DataFrame:
        """What each segment starts from: the totals of all earlier segments of its group.

        A tree of two levels: earlier segments of the same ``_FAN``, and all of the earlier ones.
        """
        totals = totals.withColumn("_fan", F.floor(F.col("_segment") / _FAN))

        def earlier(frame: DataFrame, within: list, order: str, to: str) -> DataFrame:
            over = (Window.partitionBy(*within).orderBy(order)
                    .rowsBetween(Window.unboundedPreceding, -1))
            columns = {f"_{to}_{n}": F.coalesce(F.sum(f"_d_{n}").over(over), F.lit(0))
                       for n in sums}
            columns |= {f"_{to}_{n}": F.last(f"_l_{n}", ignorenulls=True).over(over)
                        for n in lasts}
            return frame.withColumns(columns)

        near = earlier(totals, [*by, "_fan"], "_segment", "n")
        fans = totals.groupBy(*by, "_fan").agg(
            *[F.sum(f"_d_{n}").alias(f"_d_{n}") for n in sums],
            *[F.max_by(f"_l_{n}", F.when(F.col(f"_l_{n}").isNotNull(), F.col("_segment")))
              .alias(f"_l_{n}") for n in lasts])
        far = earlier(fans, by, "_fan", "f").select(
            *[F.col(c).alias(f"_by_{i}") for i, c in enumerate(by)], F.col("_fan").alias("_of"),
            *[f"_f_{n}" for n in [*sums, *lasts]])
        same = F.col("_fan") == F.col("_of")
        for i, c in enumerate(by):
            same &= F.col(c).eqNullSafe(F.col(f"_by_{i}"))
        opened = {f"_o_{n}": F.col(f"_n_{n}") + F.col(f"_f_{n}") for n in sums}
        opened |= {f"_o_{n}": F.coalesce(f"_n_{n}", f"_f_{n}") for n in lasts}
        return near.join(far, same).withColumns(opened).select(
            *totals.drop("_fan").columns, *opened)

    @staticmethod
    def _opening_rows(before: DataFrame, by: list, sums: list, lasts: list) -> DataFrame:
        return before.select(
            *by, "_segment", F.lit(_START).alias("_at"), F.lit(-1).alias("_phase"),
            F.lit(-1).alias("_kind"), *[F.col(f"_o_{n}").alias(f"_d_{n}") for n in sums],
            *[F.col(f"_o_{n}").alias(f"_l_{n}") for n in lasts])

    def _openings(self) -> list:
        """Opening rows of every pass, all from segment totals: no pass is computed twice.

        How many values are present when a segment starts follows from the totals per (key, value,
        segment): a value is present where its total so far is above zero.
        """
        rows, changes = [], {}
        for value, windows in self.values:
            by, sums = [self.key, value], self._presence(value, windows)
            before = self._before(self._segment_totals(by, sums, {}), by, list(sums), [])
            rows.append(self._opening_rows(before, by, list(sums), []))
            for window, name in zip(windows, sums):
                start = F.col(f"_o_{name}")
                end = start + F.col(f"_d_{name}")
                changes[value, window] = before.select(
                    *by, "_segment", ((end > 0).cast("bigint") - (start > 0).cast("bigint"))
                    .alias("_change"))
        by = [self.key]
        plain = {n: self._change(v, w) for n, (v, w) in self.sums.items()}
        totals = self._segment_totals(by, plain, self.lasts)
        for name, spec in self.marks.items():
            moved = changes[spec[0], spec[1]].groupBy(*by, "_segment").agg(
                F.sum(F.col("_change") * self._weight(name)).cast("bigint").alias(f"_d_{name}"))
            totals = totals.unionByName(moved, allowMissingColumns=True)
        names = [*self.sums, *self.marks]
        if self.marks:
            totals = totals.groupBy(*by, "_segment").agg(
                *[F.sum(f"_d_{n}").alias(f"_d_{n}") for n in names],
                *[F.first(f"_l_{n}", ignorenulls=True).alias(f"_l_{n}") for n in self.lasts])
        before = self._before(totals, by, names, list(self.lasts))
        rows.append(self._opening_rows(before, by, names, list(self.lasts)))
        return rows

    # -- computation ----------------------------------------------------------------------------

    def _prepared(self) -> DataFrame:
        """Events with their changes, plus the opening rows, grouped by one exchange.

        Changes follow from the kind of an event and what it carries, so they are worked out behind the
        exchange; only opening rows bring theirs along.
        """
        columns = {f"_d_{n}": self._change(v, w) for n, (v, w) in self.sums.items()}
        for value, windows in self.values:
            columns |= {f"_d_{n}": c for n, c in self._presence(value, windows).items()}
        columns |= {f"_l_{n}": F.when(F.col("_kind") == 0, v) for n, v in self.lasts.items()}
        events = self.events
        if self.cuts:
            for opening in self._openings():
                events = events.unionByName(opening, allowMissingColumns=True)
            columns = {n: F.when(F.col("_phase") < 0, F.col(n)).otherwise(c) for n, c in columns.items()}
        # Hash on key and segment once; every pass below only refines that grouping.
        return events.repartition(F.col(self.key), F.col("_segment")).withColumns(columns)

    def _over(self, *refinement: str):
        return (Window.partitionBy(self.key, "_segment", *refinement)
                .orderBy("_at", "_phase", "_id").rowsBetween(Window.unboundedPreceding, -1))

    def fold(self, keep: list | None = None) -> DataFrame:
        """One row per input row with ``prior_<name>`` for everything asked for.

        ``keep`` lists marks to keep as they are.  A row without key has no history.
        """
        events = self._prepared()
        for value, windows in self.values:
            names = self._presence(value, windows)
            counts = {f"_c_{n}": F.coalesce(F.sum(f"_d_{n}").over(self._over(value)), F.lit(0))
                      for n in names}
            marks = {}
            for window, name in zip(windows, names):
                count = F.col(f"_c_{name}")
                mark = F.when((F.col("_kind") == 0) & (count == 0), 1)
                if window is not None:
                    kind = 1 + list(self.windows).index(window)
                    mark = mark.when((F.col("_kind") == kind) & (count == 1), -1)
                marks[f"_mark_{value}_{window}"] = F.coalesce(mark, F.lit(0))
            events = events.withColumns(counts).withColumns(marks).drop(
                *counts, *[f"_d_{n}" for n in names])
        totals = {n: F.sum(f"_d_{n}") for n in self.sums}
        for name, spec in self.marks.items():
            change = (F.col(f"_mark_{spec[0]}_{spec[1]}") * self._weight(name)).cast("bigint")
            # opening rows already carry the sum of the marks before their segment
            totals[name] = F.sum(F.when(F.col("_phase") < 0, F.col(f"_d_{name}")).otherwise(change)
                                 if self.cuts else change)
        over = self._over()
        known = F.col(self.key).isNotNull()
        results = {f"prior_{n}": F.coalesce(total.over(over), F.lit(0))
                   for n, total in totals.items()}
        results |= {f"prior_{n}": F.last(f"_l_{n}", ignorenulls=True).over(over)
                    for n in self.lasts}
        if results:
            events = events.withColumns(results)
        out = [F.when(known, F.col(f"prior_{n}")).otherwise(F.lit(0)).alias(f"prior_{n}")
               for n in totals]
        out += [F.when(known, F.col(f"prior_{n}")).alias(f"prior_{n}") for n in self.lasts]
        return (events.where(F.col("_kind") == 0)
                .select(*self.rows, *out, *[F.col(mark) for mark in keep or []]))


def _lay_out(df: DataFrame, key: str, time: str, row_id: str, windows: dict, carry: list,
             payload: list) -> DataFrame:
    base = df.select(
        F.col(key), *[F.col(c) for c in carry], F.col(row_id).alias("_id"),
        F.unix_micros(F.col(time).cast("timestamp")).alias("_t"),
        *([F.struct(*[F.col(c) for c in payload]).alias("_row")] if payload else []))
    kinds, at = [F.lit(0)], F.when(F.col("_kind") == 0, F.col("_t"))
    for index, window in enumerate(windows.values(), start=1):
        length, matters = window if isinstance(window, tuple) else (window, None)
        kinds.append(F.lit(index) if matters is None else F.when(matters, F.lit(index)))
        at = at.when(F.col("_kind") == index, F.col("_t") + F.lit(int(length)))
    # a row that never counts in a window has no expiry there
    events = (base.withColumn("_kind", F.explode(F.array(*kinds))).where(F.col("_kind").isNotNull())
              if windows else base.withColumn("_kind", F.lit(0)))
    events = (events.withColumn("_at", at)
              .withColumn("_phase", F.when(F.col("_kind") == 0, 0).otherwise(1)).drop("_t"))
    if payload:
        events = events.withColumn("_row", F.when(F.col("_kind") == 0, F.col("_row")))
    return events


def unfold(df: DataFrame, key: str, time: str, row_id: str, windows: dict | None = None,
           carry: list | None = None, source: DataFrame | None = None) -> Timeline:
    """Lay the rows of every ``key`` out on a timeline.

    ``windows`` maps a name to a length in microseconds, or to (length, condition) when only the
    rows that meet the condition are ever counted in it: the others need no expiry.  ``carry`` lists
    the input columns that measures refer to: leaving events need them too; every other column
    travels only with the row itself, and none travels twice.  ``source`` may name a cheaper frame with the same rows (key,
    time, id and carried columns) from which cut points and segment totals are taken.
    """
    windows = windows or {}
    carry = [c for c in (carry or []) if c != key]
    source = df if source is None else source
    cuts = cut_points(source, key, time, row_id, windows, carry)
    beside = {**{c: c for c in [key, *carry]}, row_id: "_id"}
    payload = [c for c in df.columns if c not in beside]
    rows = [F.col(beside[c]).alias(c) if c in beside else F.col("_row").getField(c).alias(c) for c in df.columns]
    events = _lay_out(df, key, time, row_id, windows, carry, payload)
    spread = F.pmod(F.xxhash64("_id"), F.lit(_NULL_SPREAD)).cast("bigint")
    cut_events, segment = None, F.lit(0).cast("bigint")
    if cuts:
        segment = F.coalesce(cuts.segment(), F.lit(0)).cast("bigint")
        events = cuts.beside(events, key, "left")
        narrow = _lay_out(source, key, time, row_id, windows, carry, [])
        cut_events = cuts.beside(narrow, key, "inner").withColumn("_segment", segment).drop("_cuts")
    events = events.withColumn("_segment", F.when(F.col(key).isNull(), spread).otherwise(segment))
    return Timeline(events.drop("_cuts"), key, windows, cuts, cut_events, rows)


HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US


def hours(count) -> int:
    return int(count) * HOUR_US


def days(count) -> int:
    return int(count) * DAY_US
