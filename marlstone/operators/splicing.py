"""Type-2 histories whose batches may come in any order.

A late batch is spliced in: the version of a key that was valid at its time is
split there, versions that become alike are joined, and what came later stays.
For that a version lists the batches that showed it (``_observed``: their times
and the untracked columns they had), so that the part after a split opens at the
first batch that showed it again, with the columns that batch had.  The history
is the same whatever the order of the batches; their times must differ.

A key has at most one version a batch, so its versions are handled as one small
array: history and batch are shuffled once by key and no window is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.entities import OPEN_END
from marlstone.functions.rules import all_true, moment
from marlstone.operators.history import HistoryRules, first_load, union_columns

OBSERVED = "_observed"
SEEN_AT = "_at"  # time of an entry of OBSERVED


def observed_load(incoming: DataFrame, rules: HistoryRules, at=None) -> DataFrame:
    """``first_load`` with the list of observations that later splices need."""
    loose = _loose(incoming.columns, rules)
    entry = F.struct(moment(at).alias(SEEN_AT), *[F.col(f"`{c}`") for c in loose])
    return first_load(incoming, rules, at).withColumn(OBSERVED, F.array(entry))


def splice_batch(
    history: DataFrame, incoming: DataFrame, rules: HistoryRules, at=None, next_batch=None
) -> DataFrame:
    """The history after a batch of time ``at``, which may lie before batches that it has.

    ``history`` has the column ``_observed``; if ``at`` is later than all its batches, its current versions are enough.
    ``incoming`` has one record per key.  ``next_batch`` is the time of the first later batch, if any: where batches are
    complete (``closes_absent``), a key that only this batch has ends there.  Columns of one side only are NULL in
    rows from the other.
    """
    columns = union_columns(history.drop(OBSERVED), incoming, rules)
    grouped = (
        history.select(rules.key, _record(history, columns, rules, OBSERVED).alias("version"))
        .groupBy(rules.key)
        .agg(F.collect_list("version").alias("versions"))
    )
    arrived = incoming.select(rules.key, _record(incoming, columns, rules, None, at).alias("arrived"))
    paired = grouped.join(arrived, rules.key, "full_outer").withColumn("now", moment(at))
    empty = F.array().cast(paired.schema["versions"].dataType)
    repeated = F.exists("versions", lambda v: F.exists(v[OBSERVED], lambda o: o[SEEN_AT] == F.col("now")))
    clash = F.raise_error(F.concat(F.lit("the history has a batch of "), F.col("now").cast("string"), F.lit(" already")))
    placed = (
        paired.withColumn("versions", F.when(repeated, clash).otherwise(F.coalesce("versions", empty)))
        .withColumn("earlier", F.filter("versions", lambda v: _opened_at(v) < F.col("now")))
        .withColumn("later", F.filter("versions", lambda v: _opened_at(v) > F.col("now")))
        .withColumn("last", F.array_max(F.transform("earlier", _opened_at)))
        .withColumn("next", F.array_min(F.transform("later", _opened_at)))
        .withColumn("before", F.get(F.filter("earlier", lambda v: _opened_at(v) == F.col("last")), F.lit(0)))
        .withColumn("after", F.get(F.filter("later", lambda v: _opened_at(v) == F.col("next")), F.lit(0)))
    )
    splice = _Splice(columns, rules, next_batch)
    placed = splice.measured(placed)
    untouched = F.concat(
        F.filter("earlier", lambda v: _opened_at(v) < F.col("last")),
        F.filter("later", lambda v: _opened_at(v) > F.col("next")),
    )
    spliced = placed.select(F.inline(F.concat(untouched, splice.pieces())))
    own = [c for c in columns if c not in rules.validity_types()]
    return spliced.select(*[F.col(f"record.`{c}`" if c in own else f"`{c}`").alias(c) for c in columns], OBSERVED)


class _Splice:
    """The versions that take the place of the one before a batch and the one after it."""

    def __init__(self, columns: dict[str, str], rules: HistoryRules, next_batch):
        self.columns, self.rules, self.validity = columns, rules, rules.validity_types()
        self.next = moment(next_batch) if next_batch is not None else F.lit(None).cast("timestamp")

    def measured(self, placed: DataFrame) -> DataFrame:
        """Adds what decides on a key: is the batch inside a version, what it shows again, which neighbours are alike."""
        now, rules = F.col("now"), self.rules
        end = F.coalesce(F.col(f"before.{rules.valid_to}"), F.lit(OPEN_END).cast("timestamp"))
        after_at = _opened_at(F.col("after"))
        has_after, inside = F.col("after").isNotNull(), F.col("before").isNotNull() & (end > now)
        rest = F.size(F.col("right")) > 0
        free_end = self.next if rules.closes_absent else after_at
        return (
            placed.withColumn("left", F.filter(f"before.{OBSERVED}", lambda o: o[SEEN_AT] < now))
            .withColumn("right", F.filter(f"before.{OBSERVED}", lambda o: o[SEEN_AT] > now))
            .withColumn("inside", F.coalesce(inside, F.lit(False)))
            .withColumn("rest", F.coalesce(F.col("inside") & rest, F.lit(False)))
            .withColumn("like_before", self._alike("before"))
            .withColumn("like_after", has_after & self._alike("after"))
            # Does the version after the batch begin where one that opens now would end?
            .withColumn("meets", F.coalesce(has_after & (F.when(F.col("inside"), end).otherwise(free_end) == after_at), F.lit(False)))
            .withColumn("free_end", free_end)
        )

    def pieces(self) -> Column:
        now, before, after = F.col("now"), F.col("before"), F.col("after")
        ends_now = self._made("before", self._closed(now), F.col("left"))
        shown_again = F.get("right", F.lit(0))
        start = self._first_start(lambda c: self._shown(c, shown_again), shown_again[SEEN_AT])
        right = {
            "record": F.struct(*[self._shown(c, shown_again).alias(c) for c in self.columns if c not in self.validity]),
            **self._start(F.when(F.col("arrived").isNull(), start).otherwise(shown_again[SEEN_AT]), shown_again[SEEN_AT]),
        }
        right = self._made("before", right, F.col("right"))
        seen = F.concat("left", F.col(f"arrived.{OBSERVED}"), "right")
        confirmed = self._made("before", {}, seen)

        # A version that opens now: inside another one it starts at the batch, else as a first one.
        own_start = self._first_start(lambda c: F.col(f"arrived.record.{c}"), now)
        opens = self._start(F.when(F.col("inside"), now).otherwise(own_start), now)
        joined = {**opens, **self._validity_end("after")}
        joined = self._made("arrived", joined, F.concat(F.col(f"arrived.{OBSERVED}"), F.col(f"after.{OBSERVED}")))
        until_rest = self._made("arrived", {**opens, **self._closed(shown_again[SEEN_AT])}, F.col(f"arrived.{OBSERVED}"))
        like_old = self._made("arrived", {**opens, **self._validity_end("before")}, F.col(f"arrived.{OBSERVED}"))
        free = F.when(F.col("free_end").isNull(), self._made("arrived", {**opens, **self._still_open()}, F.col(f"arrived.{OBSERVED}")))
        free = free.otherwise(self._made("arrived", {**opens, **self._closed(F.col("free_end"))}, F.col(f"arrived.{OBSERVED}")))
        follows = self._made("after", self._start(_opened_at(after), _opened_at(after)), F.col(f"after.{OBSERVED}"))
        begins = self._first_start(lambda c: F.col(f"after.record.{c}"), _opened_at(after))
        begins = self._made("after", self._start(begins, _opened_at(after)), F.col(f"after.{OBSERVED}"))

        join_after = F.col("meets") & F.col("like_after")
        absent = F.col("arrived").isNull()
        gone = absent & F.lit(self.rules.closes_absent) & F.col("inside")
        as_is = F.array(before, after)
        made = (
            F.when(gone & F.col("rest"), F.array(ends_now, right, after))
            .when(gone & F.col("meets"), F.array(ends_now, begins))
            .when(gone, F.array(ends_now, after))
            .when(absent, as_is)
            .when(F.col("inside") & F.col("like_before"), F.array(confirmed, after))
            .when(F.col("rest"), F.array(ends_now, until_rest, right, after))
            .when(F.col("inside") & join_after, F.array(ends_now, joined))
            .when(F.col("inside"), F.array(ends_now, like_old, after))
            .when(join_after, F.array(before, joined))
            .when(F.col("meets"), F.array(before, free, follows))
            .otherwise(F.array(before, free, after))
        )
        return F.array_compact(made)

    def _alike(self, side: str) -> Column:
        return all_true(F.col(f"{side}.record.{c}").eqNullSafe(F.col(f"arrived.record.{c}")) for c in self.rules.tracked)

    def _made(self, source: str, values: dict[str, Column], observed: Column) -> Column:
        record = values.get("record", F.col(f"{source}.record")).alias("record")
        dates = [values.get(c, F.col(f"{source}.{c}")).cast(kind).alias(c) for c, kind in self.validity.items()]
        return F.struct(record, *dates, observed.alias(OBSERVED))

    def _shown(self, column: str, entry: Column) -> Column:
        return entry[column] if column in _loose(self.columns, self.rules) else F.col(f"before.record.`{column}`")

    def _first_start(self, value, opened: Column) -> Column:
        own = self.rules.first_valid_from
        return F.coalesce(value(own).cast("timestamp"), opened) if own else opened

    def _start(self, start: Column, opened: Column) -> dict[str, Column]:
        values = {self.rules.valid_from: start}
        if self.rules.updated_at:
            values[self.rules.updated_at] = opened
        return values

    def _closed(self, end: Column) -> dict[str, Column]:
        return {self.rules.valid_to: end, **self._flag(F.lit(False))}

    def _still_open(self) -> dict[str, Column]:
        return {self.rules.valid_to: F.lit(self.rules.open_end), **self._flag(F.lit(True))}

    def _validity_end(self, source: str) -> dict[str, Column]:
        flag = self.rules.current_flag
        return {self.rules.valid_to: F.col(f"{source}.{self.rules.valid_to}"), **self._flag(F.col(f"{source}.{flag}") if flag else None)}

    def _flag(self, value: Column | None) -> dict[str, Column]:
        return {self.rules.current_flag: value} if self.rules.current_flag else {}


def _opened_at(version: Column) -> Column:
    return F.get(version[OBSERVED], F.lit(0))[SEEN_AT]


def _loose(columns, rules: HistoryRules) -> list[str]:
    """Columns whose changes open no version."""
    return [c for c in columns if c not in {rules.key, *rules.tracked, *rules.validity_types(), OBSERVED}]


def _record(df: DataFrame, columns: dict[str, str], rules: HistoryRules, observed: str | None, at=None) -> Column:
    """A row with the columns of both sides and its observations: those it has, or itself as the only one."""

    def own(c: str) -> Column:
        return (F.col(f"`{c}`") if c in df.columns else F.lit(None)).cast(columns[c]).alias(c)

    loose = _loose(columns, rules)
    if observed is None:
        entries = F.array(F.struct(moment(at).alias(SEEN_AT), *[own(c) for c in loose]))
    else:
        had = set(df.schema[observed].dataType.elementType.names)

        def entry(o: Column) -> Column:
            values = [(o[c] if c in had else F.lit(None)).cast(columns[c]).alias(c) for c in loose]
            return F.struct(o[SEEN_AT].alias(SEEN_AT), *values)

        entries = F.transform(observed, entry)
    validity = rules.validity_types()
    record = F.struct(*[own(c) for c in columns if c not in validity]).alias("record")
    return F.struct(record, *[own(c) for c in validity], entries.alias(OBSERVED))
