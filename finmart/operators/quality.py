"""Declared-constraint checks and idempotent seeding for the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import FOREIGN_KEYS, GOLD, PRIMARY_KEYS


def primary_key_report(tables: dict[str, DataFrame],
                       keys: dict[str, list[str]] | None = None) -> DataFrame:
    """(table_name, key_columns, duplicate_keys, rows_in_duplicates) per table."""
    keys = keys or PRIMARY_KEYS
    out = None
    for name, cols in keys.items():
        if name not in tables:
            continue
        groups = tables[name].groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
        rep = groups.agg(
            F.count_if(F.col("n") > 1).cast("long").alias("duplicate_keys"),
            F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("long")
            .alias("rows_in_duplicates"))
        rep = rep.select(F.lit(name).alias("table_name"), F.lit(",".join(cols)).alias("key_columns"),
                         "duplicate_keys", "rows_in_duplicates")
        out = rep if out is None else out.unionByName(rep)
    return out


def foreign_key_report(tables: dict[str, DataFrame], relations=FOREIGN_KEYS) -> DataFrame:
    """(child, column, parent, orphan_rows): child rows whose key has no parent row.

    Each child table is scanned once: every parent key set (deduplicated, so a join
    never multiplies rows) is left-joined with a match flag, and one aggregate counts
    the unmatched rows per relation. A NULL key has no parent, as with NOT EXISTS.
    """
    by_child: dict[str, list] = {}
    for rel in relations:
        child, _, parent, _ = rel
        if child in tables and parent in tables:
            by_child.setdefault(child, []).append(rel)
    out = None
    for child, rels in by_child.items():
        df = tables[child].select(*dict.fromkeys(ccol for _, ccol, _, _ in rels))
        for i, (_, ccol, parent, pcol) in enumerate(rels):
            keys = (tables[parent].select(F.col(pcol).alias(ccol)).distinct()
                    .withColumn(f"_m{i}", F.lit(True)))
            df = df.join(keys, ccol, "left")
        counts = df.agg(*[F.count_if(F.col(f"_m{i}").isNull()).cast("long").alias(f"_o{i}")
                          for i in range(len(rels))])
        rows = F.array(*[F.struct(F.lit(child).alias("child_table"),
                                  F.lit(ccol).alias("child_column"),
                                  F.lit(parent).alias("parent_table"),
                                  F.col(f"_o{i}").alias("orphan_rows"))
                         for i, (_, ccol, parent, _) in enumerate(rels)])
        rep = counts.select(F.inline(rows))
        out = rep if out is None else out.unionByName(rep)
    return out


def table_counts(tables: dict[str, DataFrame], with_total: bool = True) -> DataFrame:
    """(table_name, row_count) per table plus a TOTAL row."""
    out = None
    for name, df in tables.items():
        c = df.agg(F.count(F.lit(1)).cast("long").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count")
        out = c if out is None else out.unionByName(c)
    if with_total:   # one scan a table: the counts are rolled up
        out = (out.rollup("table_name").agg(F.sum("row_count").cast("long").alias("row_count"))
               .select(F.coalesce("table_name", F.lit("TOTAL")).alias("table_name"), "row_count"))
    return out


def fingerprints(df: DataFrame, year: Column | None = None) -> DataFrame:
    """(year, row_count, high, low): an order-free fingerprint of a table's rows by year.

    Each row's 64-bit hash over all columns is summed as two halves, which cannot overflow below
    2^31 rows a year; a changed, lost or doubled row changes the sums whatever the row order."""
    columns = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in df.columns]
    h = F.xxhash64(*columns)
    return df.groupBy((F.lit(None).cast("int") if year is None else year).alias("year")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(F.shiftright(h, 32)).alias("high"),
        F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))).alias("low"))


def reconcile(left: dict[str, DataFrame], right: dict[str, DataFrame],
              names: tuple[str, str] = ("gold", "warehouse")) -> DataFrame:
    """(table_name, year, <left>_rows, <right>_rows, same): both sides of every table, facts by year of
    their date_key. A table or year that one side lacks has 0 rows there. Each table is read once."""
    out = None
    for table in dict.fromkeys([*left, *right]):
        sides = []
        for side, tables in zip(names, (left, right)):
            if table not in tables:
                continue
            df = tables[table]
            df = df.select(*sorted(df.columns))   # by name: column order is no difference
            year = F.floor(F.col("date_key") / 10000).cast("int") if table.startswith("fact") else None
            sides.append(fingerprints(df, year).withColumn("side", F.lit(side)))
        both = sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])

        def of(side: str, c: str) -> Column:
            return F.coalesce(F.sum(F.when(F.col("side") == side, F.col(c))), F.lit(0)).cast("long")
        a, b = names
        one = both.groupBy("year").agg(
            of(a, "row_count").alias(f"{a}_rows"), of(b, "row_count").alias(f"{b}_rows"),
            ((of(a, "high") == of(b, "high")) & (of(a, "low") == of(b, "low"))
             & (of(a, "row_count") == of(b, "row_count"))).alias("same")) \
            .select(F.lit(table).alias("table_name"), "year", f"{a}_rows", f"{b}_rows", "same")
        out = one if out is None else out.unionByName(one)
    return out


def enforced(batch: DataFrame, name: str, current: DataFrame | None = None,
             parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """The rows of a batch for Gold table ``name``, in a plan that fails on the first broken rule.

    Rules: columns declared not nullable hold values; no two rows of the batch share the primary key
    and none has a key that ``current`` holds; a foreign key is NULL or in its parent table. The
    checks ride on the pass that writes the rows: a broken rule raises in the task that meets it.
    """
    fields = GOLD[name].fields
    rows = batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
    keys = PRIMARY_KEYS[name]
    rules = [(F.col(f.name).isNull(), f"{name}.{f.name} is NULL") for f in fields if not f.nullable]
    rows = rows.groupBy(*keys).agg(   # one row a key, so repeated keys meet before they are written
        F.count(F.lit(1)).alias("__n"),
        *[F.first(f.name).alias(f.name) for f in fields if f.name not in keys])
    rules.append((F.col("__n") > 1, f"{name}: the batch repeats a key"))
    if current is not None:
        held = current.select(*keys).distinct().withColumn("__held", F.lit(True))
        rows = rows.join(held, keys, "left")
        rules.append((F.col("__held").isNotNull(), f"{name}: the table already holds a key"))
    for k, (child, column, parent, parent_key) in enumerate(FOREIGN_KEYS):
        if child == name and parents and parent in parents:
            known = parents[parent].select(F.col(parent_key).alias(column)).distinct() \
                .withColumn(f"__p{k}", F.lit(True))
            rows = rows.join(known, column, "left")
            rules.append((F.col(column).isNotNull() & F.col(f"__p{k}").isNull(),
                          f"{name}.{column} has no row in {parent}"))
    broken = F.coalesce(*[F.when(when, F.lit(text)) for when, text in rules])
    text = F.concat(broken, F.lit(", key "), F.to_json(F.struct(*keys)))
    first = fields[0]
    return rows.select(
        F.when(broken.isNotNull(), F.raise_error(text).cast(first.dataType))
        .otherwise(F.col(first.name)).alias(first.name), *[F.col(f.name) for f in fields[1:]])


def seed_missing_rows(target: DataFrame, seed: DataFrame, key: list[str]) -> DataFrame:
    """``INSERT … WHERE NOT EXISTS``: seed rows whose key is absent, appended to target."""
    missing = seed.join(target.select(*key), key, "left_anti")
    return target.unionByName(missing.select(*target.columns))
