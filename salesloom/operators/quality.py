"""Data-quality jobs standing in for the keys a database would enforce.

* :func:`key_violations` -- keys that occur more than once (PRIMARY KEY /
  UNIQUE), with their count.
* :func:`fk_violations` -- rows whose foreign key has no match, for any number of keys
  in one scan of the rows.
* :func:`constraint_violations` -- values that repeat in a UNIQUE column or are longer
  than their column, for all columns in one aggregate.
* :func:`load_metrics` -- row counts per named table, computed by Spark.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.operators.joins import left_lookup
from salesloom.session import materialized


def key_violations(df: DataFrame, key_cols: Sequence[str], tasks: int | None = None) -> DataFrame:
    """``key_cols..., rows`` for every key value seen more than once.

    ``tasks``: the number that the rows are dealt to by key (see :func:`tasks_for`), for keys of which
    few repeat: partial counts save nothing there, and few well compressed bytes are many keys in memory."""
    if tasks:
        df = df.select(*key_cols).repartition(tasks, *key_cols)
    return (df.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("rows"))
            .where(F.col("rows") > 1))


def orphan_keys(rows: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """(key, value): the values of each key column of ``rows`` that its dimension lacks.

    The columns are unpivoted and made distinct together, so ``rows`` is scanned once; the
    dimensions' keys come together as well and one anti join finds what is left.  A NULL
    key is not a violation (SQL foreign keys accept NULL)."""
    names = F.array(*[F.lit(k) for k in dims])

    def pairs(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        # integers become text only once they are distinct: five keys of a row are two numbers each until then
        whole = all(df.schema[k].dataType.typeName() in ("byte", "short", "integer", "long") for k in keys)
        each = F.explode(F.array(*[F.struct(F.lit(list(dims).index(k)).alias("at"), F.col(k).cast("bigint" if whole else "string").alias("value"))
                                   for k in keys]))
        found = df.select(each.alias("p")).select("p.*").where(F.col("value").isNotNull()).distinct()
        return found.select(names[F.col("at")].alias("key"), F.col("value").cast("string").alias("value"))

    known = None
    for k, d in dims.items():
        part = pairs(d.select(k), [k])
        known = part if known is None else known.unionByName(part)
    return pairs(rows, list(dims)).join(known, ["key", "value"], "left_anti")


def fk_violations(rows: DataFrame, dims: Mapping[str, DataFrame], report: Sequence[str]) -> DataFrame:
    """``key`` and the ``report`` columns of every row whose ``key`` has no match.

    Rows are read a second time only if some value is an orphan: the orphans are written
    first, and without any the result is empty as it is."""
    found = materialized(orphan_keys(rows, dims))
    names = F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in dims])
    out = rows.select(*[F.col(c).alias(f"_{c}") for c in report], F.explode(names).alias("p"))
    if found.isEmpty():
        out = out.where(F.lit(False))      # folded to an empty relation: no second scan
    return (out.select("p.*", *[f"_{c}" for c in report]).join(found, ["key", "value"], "left_semi")
            .select("key", *[F.col(f"_{c}").alias(c) for c in report]))


def constraint_violations(df: DataFrame, unique: Sequence[str] = (), lengths: Mapping[str, int] | None = None) -> DataFrame:
    """(rule, column, value, rows): values that stand in several rows of a ``unique`` column
    (``repeated``; null does not count) and values of more than ``lengths[column]``
    characters (``too_long``), in one aggregate over the columns unpivoted."""
    lengths = dict(lengths or {})
    columns = list(dict.fromkeys([*unique, *lengths]))
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
    counted = (df.select(each.alias("p")).select("p.*").where(F.col("value").isNotNull())
               .groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows")))
    limit = F.lit(None).cast("int")
    for c, n in lengths.items():
        limit = F.when(F.col("column") == c, F.lit(n)).otherwise(limit)
    rules = F.array_compact(F.array(F.when(F.col("column").isin(list(unique)) & (F.col("rows") > 1), F.lit("repeated")),
                                    F.when(F.char_length("value") > limit, F.lit("too_long"))))
    return counted.select(F.explode(rules).alias("rule"), "column", "value", "rows")


def constrained(df: DataFrame, key: str, unique: Sequence[str] = (),
                lengths: Mapping[str, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept, rejects): the quarantining load of a dimension under these constraints.  Of rows with
    equal values in a ``unique`` column the one with the smallest ``key`` stays; rows with an
    over-long value go.  Rejects carry ``reject_reason``, the first of the rules in order of columns."""
    reason = F.lit(None).cast("string")
    for c, n in reversed(list((lengths or {}).items())):
        reason = F.when(F.char_length(c) > n, F.lit(f"too_long_{c}")).otherwise(reason)
    out = df.withColumn("reject_reason", reason)
    for c in unique:
        fits = F.col("reject_reason").isNull()
        first = out.where(fits & F.col(c).isNotNull()).groupBy(c).agg(F.min(key).alias("_first"))
        out = left_lookup(out, first, c) if dict(df.dtypes)[c] in ("bigint", "int") else out.join(first, c, "left")
        later = fits & F.col("_first").isNotNull() & (F.col(key) != F.col("_first"))
        out = out.withColumn("reject_reason", F.when(later, F.lit(f"repeated_{c}")).otherwise(F.col("reject_reason"))).drop("_first")
    out = materialized(out.select("reject_reason", *df.columns))
    return out.where("reject_reason IS NULL").drop("reject_reason"), out.where("reject_reason IS NOT NULL")


def load_metrics(named: Mapping[str, DataFrame]) -> DataFrame:
    """``source, rows``: one Spark count per table, unioned (no driver loop
    over data; the mapping itself is a handful of table names)."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("source"), "rows")
             for name, df in named.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
