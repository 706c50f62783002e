"""Metric views: named dimensions and measures over a star.

A view lists what can be asked; ``query`` turns one question into a DataFrame
plan and leaves the rest to Catalyst. What it decides itself is what Catalyst
cannot know:

* Joins are many-to-one by contract, so a dimension no expression mentions is
  not joined, and one that may be large is joined after the facts have been
  folded on their foreign key. A hot member then never crosses the shuffle
  more than once per map task.
* A relative-period flag is a span of days. Used as a filter it becomes date
  bounds the source pushes into its scan, and needs no join at all.
* Distinct counts fold to one row per (dimensions, member) first, each counted
  column on its own.
* Window measures aggregate to the window's grain before the window runs, so
  a window partition holds calendar periods, never fact rows. A distinct count
  that accumulates counts a member in the period where it is first seen.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.sources.star import Bounds

#: Sums and counts that a fold by member carries beside a distinct count.
FEW_PLAIN = 3

Source = Callable[[list[str], Bounds | None], DataFrame]
#: Measures at a grain of dimensions, given filters as columns and as texts.
Grained = Callable[[list["Dimension"], list[tuple[Column, str]]], DataFrame]


def snake(name: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_")


@dataclass(frozen=True)
class Dimension:
    name: str
    expr: str
    synonyms: tuple[str, ...] = ()
    #: The days a boolean flag stands for, when it is a span of days.
    span: Bounds | None = None
    display_name: str | None = None
    comment: str | None = None

    @property
    def column(self) -> str:
        return snake(self.name)


@dataclass(frozen=True)
class WindowOver:
    """One window clause; values reduce to the last along ``order``."""

    order: str
    cumulative: bool = False
    offset_months: int = 0


@dataclass(frozen=True)
class Measure:
    """``kind`` is sum, count, distinct or composed.

    ``expr`` is the summed or counted expression, or for a composed measure a
    formula over ``MEASURE(`Name`)`` terms.
    """

    name: str
    kind: str
    expr: str = ""
    where: str | None = None
    synonyms: tuple[str, ...] = ()
    format: str | None = None
    window: tuple[WindowOver, ...] = ()
    display_name: str | None = None
    comment: str | None = None

    @property
    def column(self) -> str:
        return snake(self.name)

    @property
    def parts(self) -> list[str]:
        return re.findall(r"MEASURE\(`([^`]+)`\)", self.expr) if self.kind == "composed" else []


@dataclass(frozen=True)
class Join:
    """A many-to-one left join: ``key`` is unique in ``table``."""

    name: str
    table: Callable[[], DataFrame]
    foreign: str
    key: str
    #: May exceed what fits a broadcast; joined after folding the facts.
    large: bool = False

    @property
    def parent(self) -> str:
        return self.foreign.split(".")[0]


def _references(texts: Iterable[str]) -> dict[str, list[str]]:
    """``alias.column`` mentions by alias, outside string literals."""
    found: dict[str, dict[str, None]] = {}
    for text in texts:
        for alias, column in re.findall(r"\b(\w+)\.(\w+)", re.sub(r"'[^']*'", "''", text)):
            found.setdefault(alias, {})[column] = None
    return {alias: list(columns) for alias, columns in found.items()}


@dataclass(frozen=True)
class MetricView:
    name: str
    source: Source
    dimensions: tuple[Dimension, ...]
    measures: tuple[Measure, ...]
    joins: tuple[Join, ...] = ()
    filter: str | None = None

    # -- names -------------------------------------------------------------

    def _find(self, kind: str, name: str):
        items = self.dimensions if kind == "dimension" else self.measures
        wanted = name.strip().lower()
        exact = [i for i in items if i.name.lower() == wanted]
        hits = exact or [i for i in items if wanted in (s.lower() for s in i.synonyms)]
        if len(hits) != 1:
            raise KeyError(f"{self.name} has {len(hits)} {kind}s called {name!r}")
        return hits[0]

    def dimension(self, name: str) -> Dimension:
        return self._find("dimension", name)

    def measure(self, name: str) -> Measure:
        return self._find("measure", name)

    def described(self) -> list[dict[str, str | None]]:
        """Every dimension and measure with its names, synonyms, format and comment."""
        return [
            {
                "kind": kind, "name": i.name, "display_name": i.display_name or i.name, "comment": i.comment,
                "format": getattr(i, "format", None), "synonyms": ", ".join(i.synonyms),
            }
            for kind, items in (("dimension", self.dimensions), ("measure", self.measures))
            for i in items
        ]

    def extended(self, dimensions: Iterable[Dimension] = (), measures: Iterable[Measure] = ()) -> MetricView:
        """The view with further expressions attached."""
        return replace(
            self, dimensions=(*self.dimensions, *dimensions), measures=(*self.measures, *measures)
        )

    def _closure(self, names: Iterable[str]) -> list[Measure]:
        """The measures asked for, each after the ones it is composed of."""
        ordered: dict[str, Measure] = {}

        def visit(measure: Measure, path: tuple[str, ...]) -> None:
            if measure.name in path:
                raise ValueError(f"measure {measure.name!r} is composed of itself")
            for part in measure.parts:
                visit(self.measure(part), (*path, measure.name))
            ordered.setdefault(measure.name, measure)

        for name in names:
            visit(self.measure(name), ())
        return list(ordered.values())

    # -- filters -----------------------------------------------------------

    def _predicate(self, text: str) -> tuple[str, list[Dimension]]:
        """A filter on dimension names as an expression, with its dimensions."""
        try:
            flag = self.dimension(text)
            return flag.expr, [flag]
        except KeyError:
            names = re.findall(r"`([^`]+)`", text)
            used = [self.dimension(n) for n in names]
            for name, dimension in zip(names, used):
                text = text.replace(f"`{name}`", f"({dimension.expr})")
            return text, used

    def _split_filters(self, where: Iterable[str]) -> tuple[list[str], Bounds | None]:
        """Expressions to evaluate, and the span the flags narrow to."""
        texts, span = [], None
        for item in where:
            expr, used = self._predicate(item)
            flag = used[0] if used and item.strip("` ").lower() == used[0].name.lower() else None
            if flag and flag.span:
                span = _both(span, flag.span)
            else:
                texts.append(expr)
        return texts, span

    # -- joins -------------------------------------------------------------

    def _needed(self, aliases: Iterable[str]) -> list[Join]:
        """Joins that provide ``aliases``, parents first."""
        by_name = {j.name: j for j in self.joins}
        wanted: dict[str, Join] = {}

        def add(alias: str) -> None:
            join = by_name.get(alias)
            if join and alias not in wanted:
                add(join.parent)
                wanted[alias] = join

        for alias in aliases:
            add(alias)
        return list(wanted.values())

    def _join(self, frame: DataFrame, joins: Iterable[Join], refs: dict[str, list[str]]) -> DataFrame:
        """Left-join the used columns only, each named ``alias__column``."""
        for join in joins:
            columns = dict.fromkeys((join.key, *refs.get(join.name, ())))
            table = join.table().select(*(F.col(c).alias(f"{join.name}__{c}") for c in columns))
            on = F.col(_flat(join.foreign)) == F.col(f"{join.name}__{join.key}")
            frame = frame.join(table, on, "left")
        return frame

    def _base(self, texts: list[str], span: Bounds | None, late: set[str]) -> tuple[DataFrame, dict]:
        refs = _references(texts)
        joins = self._needed(refs)
        for join in joins:
            refs.setdefault(join.parent, []).append(join.foreign.split(".")[1])
        columns = list(dict.fromkeys(refs.get("source", [])))
        base = self.source(columns, span)
        base = base.select(*(F.col(c).alias(f"source__{c}") for c in columns))
        if self.filter:
            base = base.where(F.expr(_flat(self.filter)))
        return self._join(base, [j for j in joins if j.name not in late], refs), refs

    # -- queries -----------------------------------------------------------

    def query(
        self,
        dimensions: Iterable[str] = (),
        measures: Iterable[str] = (),
        where: Iterable[str] = (),
        order_by: Iterable[str] = (),
        limit: int | None = None,
    ) -> DataFrame:
        """``SELECT dimensions, measures WHERE ... GROUP BY dimensions``.

        ``where`` items are flag dimensions by name, or predicates naming
        dimensions in backticks; all must hold. ``order_by`` names measures or
        dimensions, a leading ``-`` for descending.
        """
        dims = [self.dimension(d) for d in dimensions]
        asked = [self.measure(m) for m in measures]
        closure = self._closure(m.name for m in asked)
        leaves = [m for m in closure if m.kind != "composed"]
        if any(m.window for m in leaves):
            frame = self._windowed(dims, leaves, list(where))
        else:
            texts, span = self._split_filters(where)
            frame = self._aggregate(dims, leaves, texts, span)
        frame = frame.select(*(d.column for d in dims), *(self._typed(m).alias(m.column) for m in leaves))
        for measure in closure:
            if measure.kind == "composed":
                formula = re.sub(r"MEASURE\(`([^`]+)`\)", lambda m: self.measure(m[1]).column, measure.expr)
                frame = frame.withColumn(measure.column, F.expr(formula))
        frame = frame.select(*(F.col(i.column).alias(i.column, metadata=_described(i)) for i in [*dims, *asked]))
        return self._ordered(frame, dims, order_by, limit)

    def _typed(self, measure: Measure) -> Column:
        return F.col(measure.column).cast("double" if measure.kind == "sum" else "bigint")

    def _ordered(self, frame: DataFrame, dims: list[Dimension], order_by, limit) -> DataFrame:
        keys = []
        for name in order_by:
            known = self.dimensions + self.measures
            column = next(k.column for k in known if k.name.lower() == name.lstrip("-").lower())
            keys.append(F.desc(column) if name.startswith("-") else F.asc(column))
        if keys or limit:
            # The dimensions break ties, so a limit is repeatable.
            frame = frame.orderBy(*keys, *(d.column for d in dims))
        return frame.limit(limit) if limit else frame

    def _aggregate(
        self, dims: list[Dimension], leaves: list[Measure], filters: list[str], span: Bounds | None
    ) -> DataFrame:
        members = list(dict.fromkeys(m.expr for m in leaves if m.kind == "distinct"))
        plain = [m for m in leaves if m.kind != "distinct"]
        if len(members) > 1 or (members and len(plain) > FEW_PLAIN):
            return self._aggregate_by_member(dims, leaves, members, filters, span)
        fixed = [*filters, *(m.expr for m in leaves), *(m.where for m in leaves if m.where)]
        texts = [d.expr for d in dims] + fixed + ([self.filter] if self.filter else [])
        late = self._late_joins(dims, fixed, members) if leaves else []
        frame, refs = self._base(texts, span, {j.name for j in late})
        for text in filters:
            frame = frame.where(F.expr(_flat(text)))
        if not leaves:
            return frame.select(*_keys(dims)).distinct()
        if not (members or late):
            return frame.groupBy(*_keys(dims)).agg(*(_direct(m) for m in leaves))

        # Fold on (dimensions at hand, foreign keys still to join, member).
        late_names = {j.name for j in late}
        ready = [d for d in dims if not late_names & set(_references([d.expr]))]
        foreign = [F.col(_flat(j.foreign)) for j in late if j.parent == "source"]
        member = [F.expr(_flat(m)).alias("_member") for m in members]
        folded = frame.groupBy(*_keys(ready), *foreign, *member).agg(*(_partial(m) for m in leaves))
        if late:
            folded = self._join(folded, late, refs)
            rest = [F.expr(_flat(d.expr)).alias(d.column) for d in dims if d not in ready]
            folded = folded.select(*(d.column for d in ready), *rest, *(["_member"] if members else []),
                                   *(m.column for m in leaves))
            if members:
                folded = folded.groupBy(*(d.column for d in dims), "_member").agg(*(_merged(m) for m in leaves))
        return folded.groupBy(*(d.column for d in dims)).agg(*(_final(m) for m in leaves))

    def _aggregate_by_member(self, dims, leaves, members: list[str], filters, span) -> DataFrame:
        """Each counted column folds on its own: asking for several at once would
        send every row once for each. What needs no fold goes beside the first, or
        if that is more than a few, straight to the dimensions: a fold would keep
        all of it for every member."""
        plain = [m for m in leaves if m.kind != "distinct"]
        parts = [[m for m in leaves if m.kind == "distinct" and m.expr == member] for member in members]
        if len(plain) > FEW_PLAIN:
            parts.insert(0, plain)
        else:
            parts[0] = [*plain, *parts[0]]
        merged = None
        for part in parts:
            frame = self._aggregate(dims, part, filters, span)
            merged = frame if merged is None else merged.unionByName(frame, allowMissingColumns=True)
        return merged.groupBy(*(d.column for d in dims)).agg(*(F.max(m.column).alias(m.column) for m in leaves))

    def _late_joins(self, dims: list[Dimension], fixed: list[str], members: list[str]) -> list[Join]:
        """Large joins only dimensions use, with what hangs off them.

        Folding first pays when it shrinks the facts. Beside a distinct count
        it only does so on the counted column itself; folding on a second key
        as well would keep almost every row.
        """
        early = {j.name for j in self._needed(_references(fixed))}
        late: list[Join] = []
        for join in self._needed(_references(d.expr for d in dims)):
            hangs = join.parent in {j.name for j in late}
            starts = join.large and join.parent == "source" and members in ([], [join.foreign])
            if join.name not in early and (hangs or starts):
                late.append(join)
        return late

    # -- window measures ---------------------------------------------------

    def _windowed(self, dims: list[Dimension], leaves: list[Measure], where: list[str]) -> DataFrame:
        orders = list(dict.fromkeys(w.order for m in leaves for w in m.window))
        fields = [self.dimension(o) for o in orders]
        before, after = [], []
        for item in where:
            expr, used = self._predicate(item)
            (after if used and all(u in fields for u in used) else before).append(item)
        texts, span = self._split_filters(before)
        late = [(*self._on_columns(item), item) for item in after]
        counts = [m for m in leaves if m.kind == "distinct"]
        summed = [m for m in leaves if m.kind != "distinct"]

        grain = list(dict.fromkeys([*dims, *fields]))
        base = self._aggregate(grain, summed, texts, span) if summed else None
        parts = []
        for window, measures in _by_window(summed).items():
            parts.append(self._over(dims, window, measures, late, self._summed(base, measures)))
        for window, measures in _by_window(counts).items():
            # A count cannot be folded again, so it is taken at its own grain.
            if window:
                parts.append(self._over(dims, window, measures, late, self._counted_along(window, measures, texts, span)))
            else:
                parts.append(self._aggregate(dims, measures, *self._split_filters(where)))

        # Every part has one row per group, so max only lines the columns up.
        merged = parts[0]
        for part in parts[1:]:
            merged = merged.unionByName(part, allowMissingColumns=True)
        if len(parts) == 1:
            return merged
        return merged.groupBy(*(d.column for d in dims)).agg(*(F.max(m.column).alias(m.column) for m in leaves))

    def _on_columns(self, item: str) -> tuple[set[str], Column]:
        """A filter over the grain's columns, and which of them it reads."""
        used = {name: self.dimension(name).column for name in re.findall(r"`([^`]+)`", item)}
        for name, column in used.items():
            item = item.replace(f"`{name}`", column)
        return set(used.values()), F.expr(item)

    @staticmethod
    def _summed(base: DataFrame, measures: list[Measure]) -> Grained:
        """Sums and counts at a coarser grain than ``base``."""

        def at(keys: list[Dimension], early: list[tuple[Column, str]]) -> DataFrame:
            frame = base
            for predicate, _ in early:
                frame = frame.where(predicate)
            return frame.groupBy(*(k.column for k in keys)).agg(*(F.sum(m.column).alias(m.column) for m in measures))

        return at

    def _counted_along(
        self, window: tuple[WindowOver, ...], measures: list[Measure], texts: list[str], span: Bounds | None
    ) -> Grained:
        """Distinct counts whose sum along a cumulative order is the count so far:
        a member counts where it is first seen. Without such an order they are
        the plain counts of each group."""
        running = [self.dimension(w.order) for w in window if w.cumulative]

        def at(keys: list[Dimension], early: list[tuple[Column, str]]) -> DataFrame:
            more, narrower = self._split_filters(item for _, item in early)
            wanted, days = [*texts, *more], _both(span, narrower)
            if not running:
                return self._aggregate(keys, measures, wanted, days)
            (order,) = running
            held = [k for k in keys if k != order]
            exprs = [*wanted, *(k.expr for k in keys), *(m.expr for m in measures), *(m.where for m in measures if m.where)]
            frame, _ = self._base(exprs + ([self.filter] if self.filter else []), days, set())
            for text in wanted:
                frame = frame.where(F.expr(_flat(text)))
            parts = [frame.groupBy(*_keys(keys)).agg(*(F.lit(0).alias(m.column) for m in measures))]
            for member in dict.fromkeys(m.expr for m in measures):
                mine = [m for m in measures if m.expr == member]
                when = F.expr(_flat(order.expr))
                seen = [F.min(F.when(_counted(m).isNotNull(), when)).alias(m.column) for m in mine]
                first = frame.groupBy(*_keys(held), F.expr(_flat(member)).alias("_member")).agg(*seen)
                for m in mine:
                    counted = first.where(F.col(m.column).isNotNull())
                    counted = counted.groupBy(*(k.column for k in held), F.col(m.column).alias(order.column))
                    parts.append(counted.agg(F.count(F.lit(1)).alias(m.column)))
            merged = parts[0]
            for part in parts[1:]:
                merged = merged.unionByName(part, allowMissingColumns=True)
            return merged.groupBy(*(k.column for k in keys)).agg(*(F.sum(m.column).alias(m.column) for m in measures))

        return at

    def _over(
        self,
        dims: list[Dimension],
        window: tuple[WindowOver, ...],
        measures: list[Measure],
        late: list[tuple[set[str], Column, str]],
        grained: Grained,
    ) -> DataFrame:
        """The measures over one window; ``grained`` gives them at a grain, with
        the filters that cannot wait until after the window."""
        group = [d.column for d in dims]
        if not window:
            return grained(dims, [(predicate, item) for _, predicate, item in late])
        fields = [self.dimension(w.order) for w in window]
        own = [f.column for f in fields]
        plain = [c for c in group if c not in own]
        # Later filters read order fields, which this part may not window on.
        kept = {*plain, *own}
        keys = list(dict.fromkeys([*(d for d in dims if d.column in plain), *fields]))
        frame = grained(keys, [(predicate, item) for columns, predicate, item in late if not columns <= kept])

        held = [c for w, c in zip(window, own) if not w.cumulative and not w.offset_months]
        for over, column in zip(window, own):
            if over.cumulative:
                order = F.unix_date(F.col(column))
                spec = Window.partitionBy(*plain, *(c for c in held if c != column)).orderBy(order)
                spec = spec.rangeBetween(Window.unboundedPreceding, 0)
            elif over.offset_months:
                order = F.year(column) * 12 + F.month(column)
                spec = Window.partitionBy(*plain, *(c for c in held if c != column)).orderBy(order)
                spec = spec.rangeBetween(over.offset_months, over.offset_months)
            else:
                continue
            frame = frame.withColumns({m.column: F.sum(m.column).over(spec) for m in measures})
        for columns, predicate, _ in late:
            if columns <= kept:
                frame = frame.where(predicate)
        if set(own) <= set(group):
            return frame.select(*group, *(m.column for m in measures))
        last = F.struct(*own)
        return frame.groupBy(*group).agg(*(F.max_by(m.column, last).alias(m.column) for m in measures))


def _by_window(measures: Iterable[Measure]) -> dict[tuple[WindowOver, ...], list[Measure]]:
    groups: dict[tuple[WindowOver, ...], list[Measure]] = {}
    for measure in measures:
        groups.setdefault(measure.window, []).append(measure)
    return groups


def _both(a: Bounds | None, b: Bounds | None) -> Bounds | None:
    """The days in both spans."""
    return (max(a[0], b[0]), min(a[1], b[1])) if a and b else a or b


def _described(item: Dimension | Measure) -> dict[str, str]:
    """What a column says about itself; ``comment`` is where Spark looks for one."""
    said = {"format": getattr(item, "format", None), "display_name": item.display_name, "comment": item.comment}
    return {key: text for key, text in said.items() if text}


def _flat(text: str) -> str:
    """``alias.column`` as the ``alias__column`` the joined frame carries."""
    parts = re.split(r"('[^']*')", text)
    return "".join(p if p.startswith("'") else re.sub(r"\b([A-Za-z_]\w*)\.([A-Za-z_]\w*)", r"\1__\2", p) for p in parts)


def _keys(dims: Iterable[Dimension]) -> list[Column]:
    return [F.expr(_flat(d.expr)).alias(d.column) for d in dims]


def _counted(measure: Measure) -> Column:
    """The value a row brings, NULL when the measure's filter fails."""
    value = F.expr(_flat(measure.expr)) if measure.expr else F.lit(1)
    return F.when(F.expr(_flat(measure.where)), value) if measure.where else value


def _direct(measure: Measure) -> Column:
    total = {"sum": F.sum, "count": F.count}[measure.kind](_counted(measure))
    return total.alias(measure.column)


def _partial(measure: Measure) -> Column:
    if measure.kind == "distinct":
        return F.max(_counted(measure).isNotNull()).alias(measure.column)
    return _direct(measure)


def _merged(measure: Measure) -> Column:
    return (F.max if measure.kind == "distinct" else F.sum)(measure.column).alias(measure.column)


def _final(measure: Measure) -> Column:
    if measure.kind == "distinct":
        return F.count_if(F.col(measure.column)).alias(measure.column)
    return F.sum(measure.column).alias(measure.column)


def relationship_report(checks: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Whether each key is unique, as the views rely on.

    One aggregation over the stacked keys: rows, distinct keys and the most
    rows any key has.
    """
    stacked = None
    for name, (frame, key) in checks.items():
        part = frame.select(F.lit(name).alias("relationship"), F.col(key).cast("bigint").alias("key"))
        stacked = part if stacked is None else stacked.unionByName(part)
    per_key = stacked.groupBy("relationship", "key").agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy("relationship").agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.max("n").alias("most_matches"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, 1)), F.lit(0)).alias("violations"),
    )
