"""Filter context over a star model (E-14) and measures over two frames (K).

A report selects members of dimensions; the selection reaches the facts along the
model's relationships, from the one side to the many side, and back where the
relationship filters in both directions.  A fact whose key the dimension does not
hold belongs to the dimension's blank member: it stays when the selection accepts
nulls and shows up as a null group on an axis.  Selections become semi-joins on the
dimension's keys, so facts are never multiplied and the planner picks the join.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Relationship:
    """``many.many_col`` refers to ``one.one_col``; ``both``: facts filter the
    dimension too."""
    many: str
    many_col: str
    one: str
    one_col: str
    both: bool = False


@dataclass
class Model:
    tables: dict[str, DataFrame]
    relationships: list[Relationship] = field(default_factory=list)

    def select(self, filters: dict[str, Column]) -> dict[str, DataFrame]:
        """All tables in the context of the filters (table -> predicate)."""
        out, blank = dict(self.tables), {}
        for name, predicate in filters.items():
            out[name] = self.tables[name].where(predicate)
            blank[name] = _accepts_blank(self.tables[name], predicate)
        todo, seen = list(filters), set()
        while todo:
            name = todo.pop(0)
            for r in self.relationships:
                if r in seen:
                    continue
                if r.one == name:
                    out[r.many] = self._facts(out, r, blank.get(name))
                    other = r.many
                elif r.many == name and r.both:
                    keys = out[name].select(F.col(r.many_col).alias(r.one_col)).distinct()
                    out[r.one] = out[r.one].join(keys, r.one_col, "left_semi")
                    other = r.one
                else:
                    continue
                seen.add(r)
                todo.append(other)
        return out

    def _facts(self, out, r: Relationship, blank: Column | None) -> DataFrame:
        members = out[r.one].select(F.col(r.one_col).alias("__member")).where("__member is not null").distinct()
        facts = out[r.many]
        kept = facts.join(members, facts[r.many_col] == F.col("__member"), "left_semi")
        if blank is None:                                     # only keys were filtered: the blank member is not selected
            return kept
        known = self.tables[r.one].select(F.col(r.one_col).alias("__member")).where("__member is not null").distinct()
        strangers = facts.join(known, facts[r.many_col] == F.col("__member"), "left_anti").where(blank)
        return kept.unionByName(strangers)

    def axis(self, context: dict[str, DataFrame], fact: str, columns: dict[str, list[str]]) -> DataFrame:
        """Facts of a context with attributes of their dimensions (table ->
        columns); unmatched facts keep nulls."""
        df = context[fact]
        for table, cols in columns.items():
            r = next(r for r in self.relationships if r.many == fact and r.one == table)
            dim = self.tables[table].select(F.col(r.one_col).alias("__member"), *cols).where("__member is not null").dropDuplicates(["__member"])
            df = df.join(dim, df[r.many_col] == F.col("__member"), "left").drop("__member")
        return df


def _accepts_blank(table: DataFrame, predicate: Column) -> Column:
    """Whether a row of nulls passes the predicate, as a scalar subquery."""
    nothing = table.sparkSession.range(1).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema.fields))
    return nothing.select(F.coalesce(predicate, F.lit(False)).alias("ok")).scalar()


# ------------------------------------------------------------- measures ---

def divide(a: Column, b: Column) -> Column:
    return F.when(b.isNotNull() & (b != 0), a / b)


def share(selected: DataFrame, by: list[str], value: str = "value", scope: str = "selected", everything: DataFrame | None = None,
          within: tuple[str, ...] = ()) -> DataFrame:
    """``by..., value, share`` of the groups of a context.

    The divisor is the group itself (``scope="self"``: 1, or null for 0), the whole
    selection ("selected": ALLSELECTED) or the unfiltered frame ("all": ALL), each
    within the columns ``within`` of ``by``."""
    groups = selected.groupBy(*by).agg(F.sum(value).alias("value"))
    if scope == "self":
        return groups.withColumn("share", divide(F.col("value"), F.col("value")))
    base = selected if scope == "selected" else everything
    if not within:
        return groups.withColumn("share", divide(F.col("value"), base.agg(F.sum(value)).scalar()))
    totals = base.groupBy(*within).agg(F.sum(value).alias("__total"))
    return groups.join(totals, list(within), "left").withColumn("share", divide(F.col("value"), F.col("__total"))).drop("__total")


def latest_month(everything: DataFrame, col: str = "month") -> Column:
    """Latest Month: ignores every filter."""
    return everything.agg(F.max(col)).scalar()


def latest_value(everything: DataFrame, months: list | None = None, value: str = "value", col: str = "month") -> DataFrame:
    """Portfolio Value (Latest): one selected month is shown, several are summed,
    none means the latest of all."""
    wanted = F.col(col).isin(*months) if months else F.col(col) == latest_month(everything, col)
    return everything.where(wanted).agg(F.sum(value).alias("value"))
