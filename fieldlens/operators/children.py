"""Many child tables reduced to one row per key in one go.

A wide row is put together from child tables that repeat its key: texts to be
collapsed, counts, sums, extremes, first values.  Instead of one aggregation
(and shuffle) per child, the children of one key are stacked as tagged rows
(key, tag, text, measures) and reduced together: once by (key, tag, text), so
that a key with millions of repeated texts ships one row per different text
and all measures of a key combine to one row, then by key.  That is two
shuffles for any number of children (one if there is no text).  The first (or
only) one combines on the map side, so a hot key is not gathered; the second
carries each different text of a key once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.operators.collapse import text_run
from fieldlens.operators.dedup import order_key
from fieldlens.operators.packing import PackedOrder, pack_order


@dataclass(frozen=True)
class Text:
    """The child's values as one text, in value order; missing values are
    skipped, repeats kept unless ``distinct``.  ``value_fn`` is applied to
    each different value once."""
    value: str | Column
    sep: str = "|"
    distinct: bool = False
    value_fn: Callable[[Column], Column] | None = None


@dataclass(frozen=True)
class Measure:
    """A column reduced by a function that can be applied to its own results:
    ``F.sum``, ``F.min`` or ``F.max``."""
    value: str | Column
    fn: Callable[[Column], Column]


@dataclass(frozen=True)
class First:
    """Columns of the child's first row by ``order`` (missing last), which
    are order columns themselves: look up others by them afterwards.
    ``found_in``: frames to take the order's bounds from (``pack_order``)."""
    values: tuple[str, ...]
    order: tuple[str, ...]
    found_in: tuple[DataFrame, ...] = ()


@dataclass(frozen=True)
class Child:
    """Rows of a child table, their key, and what to make of them: name ->
    ``Text`` or ``Measure``, or ``First`` (whose columns keep their names)."""
    rows: DataFrame
    key: str | Column
    makes: dict[str, Text | Measure | First] = field(default_factory=dict)


def _c(x: str | Column) -> Column:
    return x if isinstance(x, Column) else F.col(f"`{x}`")


def count_rows(where: Column | None = None) -> Measure:
    """Number of rows (of those that meet ``where``), missing if none."""
    one = F.lit(1).cast("long")
    return Measure(one if where is None else F.when(where, one), F.sum)


def _stacked(child: Child, keys: list[Column], packed: dict[str, PackedOrder | None], tags: dict[str, int]) -> DataFrame:
    """A child's rows, one for each text, and one for all measures: apart from
    the texts, measures combine to one row a key before they travel."""
    texts = [(name, make) for name, make in child.makes.items() if isinstance(make, Text)]
    measures = [(name, make) for name, make in child.makes.items() if not isinstance(make, Text)]
    tagged = [F.struct(F.lit(tags[name]).alias("_tag"), _c(make.value).cast("string").alias("_text")) for name, make in texts]
    # the row without a text also stands for a key whose texts are all missing
    tagged.append(F.struct(F.lit(-1).alias("_tag"), F.lit(None).cast("string").alias("_text")))
    carried = []
    for name, make in measures:
        if isinstance(make, First):
            carried.append((name, packed[name].key() if packed[name] else order_key(make.order)))
        else:
            carried.append((name, _c(make.value)))
    # texts of one child are read in one pass over its rows
    rows = child.rows.select(*keys, *[c.alias(f"_in_{name}") for name, c in carried], F.explode(F.array(*tagged)).alias("_t"))
    leads = F.col("_t._tag") == -1
    rows = rows.where(F.col("_t._text").isNotNull() | leads) if texts else rows
    return rows.select(*rows.columns[:len(keys)], F.col("_t._tag").alias("_tag"), F.col("_t._text").alias("_text"),
                       *[F.when(leads, F.col(f"_in_{name}")).alias(name) for name, _ in carried])


def _joined(found: Column, make: Text) -> Column:
    """One text of the sorted (value, times) of a key; missing if there is none."""
    values = F.array_distinct(F.transform(found, lambda t: t["v"])) if make.distinct else \
        F.transform(found, lambda t: text_run(t["v"], t["n"], make.sep))
    return F.when(F.size(found) > 0, F.array_join(values, make.sep))


def reduce_children(key: str, children: list[Child]) -> DataFrame:
    """One row per key with every output of the children, missing where a key
    has no rows in a child (or no text, or nothing to sum).  A missing key is
    a key of its own."""
    return _reduced([key], [(child, [_c(child.key).alias(key)]) for child in children])


def _reduced(keys: list[str], keyed: list[tuple[Child, list[Column]]]) -> DataFrame:
    """``reduce_children`` for children with the columns of their keys."""
    children = [child for child, _ in keyed]
    makes = {name: make for child in children for name, make in child.makes.items()}
    packed = {name: pack_order(child.rows, list(make.order), make.found_in) for child in children for name, make in child.makes.items()
              if isinstance(make, First)}
    tags = {name: i for i, name in enumerate(makes)}
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                     [_stacked(child, columns, packed, tags) for child, columns in keyed])
    measures = {name: F.min if isinstance(make, First) else make.fn for name, make in makes.items() if not isinstance(make, Text)}
    texts = {name: make for name, make in makes.items() if isinstance(make, Text)}
    if texts:
        stacked = stacked.groupBy(*keys, "_tag", "_text").agg(F.count(F.lit(1)).alias("_n"), *[fn(F.col(m)).alias(m) for m, fn in measures.items()])
        changed = F.col("_text")
        for name, make in texts.items():
            if make.value_fn is not None:
                changed = F.when(F.col("_tag") == tags[name], make.value_fn(F.col("_text"))).otherwise(changed)
        # a key's texts are spread over the tasks: combining them once more
        # before they travel would only put a wide row around each
        stacked = stacked.withColumn("_text", changed).repartition(*keys)
    out = []
    if texts:
        each = F.when(F.col("_text").isNotNull(), F.struct("_tag", F.col("_text").alias("v"), F.col("_n").alias("n")))
        out.append(F.array_sort(F.collect_list(each)).alias("_texts"))
    wide = stacked.groupBy(*keys).agg(*out, *[fn(F.col(m)).alias(m) for m, fn in measures.items()])
    columns = [F.col(key) for key in keys]
    for name, make in makes.items():
        if isinstance(make, Text):
            columns.append(_joined(F.filter("_texts", lambda t: t["_tag"] == tags[name]), make).alias(name))
        elif not isinstance(make, First):
            columns.append(F.col(name))
        elif packed[name]:
            columns += [packed[name].column(F.col(name), v).alias(v) for v in make.values]
        else:
            columns += [F.col(f"{name}.v{make.order.index(v)}").alias(v) for v in make.values]
    return wide.select(*columns)


def attach_children(spine: DataFrame, key: str, children: list[Child]) -> DataFrame:
    """Left join of the reduced children to the rows of ``spine``.  A missing
    key matches a missing key; it is encoded on both sides, so the join keeps
    the partitioning of the reduction."""
    given = spine.schema[key].dataType
    zero = F.lit(0).cast(given) if given.simpleString() != "string" else F.lit("")

    def encoded(c: Column) -> list[Column]:
        return [F.coalesce(c.cast(given), zero).alias("_key"), c.isNull().alias("_missing")]

    wide = _reduced(["_key", "_missing"], [(c, encoded(_c(c.key))) for c in children])
    value, missing = encoded(F.col(f"`{key}`"))
    return spine.join(wide, (value == F.col("_key")) & (missing == F.col("_missing")), "left").drop("_key", "_missing")
