"""Coverage, profiling and reconciliation aggregates; every one is a single conditional pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """Percentage, half rounded to even; 0 when the whole is 0."""
    share = F.try_divide(part.cast("double") * 100.0, whole.cast("double"))
    return F.bround(F.coalesce(share, F.lit(0.0)), digits)


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def coverage(
    df: DataFrame,
    by: Sequence[str],
    measures: dict[str, Column],
    sums: dict[str, Column] | None = None,
    percents: Sequence[str] | None = None,
    total: str = "n",
    keep_null_groups: bool = True,
) -> DataFrame:
    """Rows, rows meeting each condition, sums and percentages per group.

    ``measures`` maps a name ``x`` to a condition and gives ``n_x``; names in ``percents``
    (all by default) also give ``pct_x``. NULL is a group of its own unless told otherwise.
    """
    if not keep_null_groups:
        for c in by:
            df = df.filter(F.col(c).isNotNull())
    aggs = [F.count("*").alias(total)]
    aggs += [count_if(cond).alias(f"n_{name}") for name, cond in measures.items()]
    aggs += [F.sum(expr).alias(name) for name, expr in (sums or {}).items()]
    out = df.groupBy(*by).agg(*aggs)
    wanted = measures if percents is None else percents
    shares = {f"pct_{name}": percent(F.col(f"n_{name}"), F.col(total)) for name in wanted}
    return out.withColumns(shares) if shares else out


def phase_summary(df: DataFrame) -> DataFrame:
    """Phases, bills and multi-phase share per legislature."""
    out = df.groupBy("legislatura").agg(
        F.count("id_fase").alias("righe_totali"),
        F.countDistinct("id_ddl_interno").alias("ddl_unici_idddl"),
        count_if(F.col("is_prima_fase")).alias("prime_fasi"),
        count_if(F.col("ramo_origine") == "S").alias("ramo_S"),
        count_if(F.col("ramo_origine") == "C").alias("ramo_C"),
        count_if(F.col("has_testo_presentato")).alias("has_testo_pres"),
        count_if(F.col("has_emendamenti")).alias("has_emend"),
    )
    rows = F.col("righe_totali")
    return out.withColumns(
        {
            "fasi_per_ddl": F.bround(F.try_divide(rows.cast("double"), F.col("ddl_unici_idddl").cast("double")), 2),
            "pct_multifase": percent(rows - F.col("prime_fasi"), rows),
        }
    )


def pivot_counts(df: DataFrame, by: Sequence[str], on: str, values: Sequence[object], prefix: str) -> DataFrame:
    """Row counts, one column per value of ``on``, zero where there is none.

    Conditional counts over a given list of values need one aggregation and no extra job.
    """
    columns = [count_if(F.col(on) == F.lit(v)).alias(f"{prefix}{v}") for v in values]
    return df.groupBy(*by).agg(*columns)


def pivot_unique(df: DataFrame, keys: Sequence[str], on: str, values: Sequence[str], value: str) -> DataFrame:
    """One column per value of ``on``; fails when a cell would hold more than one row."""
    cells = []
    for v in values:
        hit = F.col(on) == F.lit(v)
        twice = F.raise_error(F.lit(f"more than one row for {on} = {v}"))
        cell = F.max(F.when(hit, F.col(value)))
        cells.append(F.when(count_if(hit) > 1, twice.cast(df.schema[value].dataType)).otherwise(cell).alias(v))
    return df.filter(F.col(on).isin(*values)).groupBy(*keys).agg(*cells)


def value_counts(df: DataFrame, cols: Sequence[str], count: str = "n") -> DataFrame:
    return df.groupBy(*cols).agg(F.count("*").alias(count))


def top_values(df: DataFrame, cols: Sequence[str], k: int, count: str = "n") -> DataFrame:
    """The k most frequent values; equal counts go by value."""
    return value_counts(df, cols, count).orderBy(F.col(count).desc(), *cols).limit(k)


def multiplicity(df: DataFrame, key: str, item: str | None = None) -> DataFrame:
    """How many keys have 1, 2, 3 … items."""
    per_key = df.groupBy(key).agg((F.count("*") if item is None else F.count(item)).alias("n_item"))
    return per_key.groupBy("n_item").agg(F.count("*").alias("n_chiavi"))


def bucket_label(c: Column, edges: Sequence[int] = (1, 3, 5, 10, 20)) -> Column:
    """``1``, ``2-3``, … and an open last bucket, by upper edges."""
    expr, low = None, 1
    for edge in edges:
        label = str(edge) if edge == low else f"{low}-{edge}"
        expr = F.when(c <= edge, label) if expr is None else expr.when(c <= edge, label)
        low = edge + 1
    return expr.otherwise(f"{low}+")


def histogram(df: DataFrame, count: str, edges: Sequence[int] = (1, 3, 5, 10, 20)) -> DataFrame:
    return df.groupBy(bucket_label(F.col(count), edges).alias("bucket")).agg(F.count("*").alias("n"))


def count_stats(df: DataFrame, count: str) -> DataFrame:
    """Rows, largest, mean and upper median.

    The median of the descending order at one half is the element at index n // 2 of the
    ascending one. Its buffer holds distinct counts, not rows.
    """
    median = F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {count} DESC)")
    return df.agg(
        F.count("*").alias("n"),
        F.max(count).alias("massimo"),
        F.bround(F.avg(count), 1).alias("media"),
        median.cast("bigint").alias("mediana"),
    )


def overlap(df: DataFrame, a: Column, b: Column, by: Sequence[str] = ()) -> DataFrame:
    """Total, A, B, both, only A, only B, none, and the shares of A and B."""
    out = df.groupBy(*by).agg(
        F.count("*").alias("n_tot"),
        count_if(a).alias("n_a"),
        count_if(b).alias("n_b"),
        count_if(a & b).alias("n_both"),
    )
    n_a, n_b, both, tot = (F.col(c) for c in ("n_a", "n_b", "n_both", "n_tot"))
    return out.withColumns(
        {
            "n_solo_a": n_a - both,
            "n_solo_b": n_b - both,
            "n_nessuno": tot - n_a - (n_b - both),
            "pct_a": percent(n_a, tot),
            "pct_b": percent(n_b, tot),
        }
    )


def reconcile(df: DataFrame, control: DataFrame, by: str, measure: str, expected: str) -> DataFrame:
    """Measured sum against a control total per group: gap and percentage covered."""
    measured = df.groupBy(by).agg(F.sum(measure).alias("n_misurato"))
    joined = control.select(by, F.col(expected).alias("n_atteso")).join(measured, by, "left")
    got = F.coalesce(F.col("n_misurato"), F.lit(0))
    return joined.select(
        by,
        "n_atteso",
        got.alias("n_misurato"),
        (F.col("n_atteso") - got).alias("gap"),
        percent(got, F.col("n_atteso")).alias("pct_cov"),
    )


def cross_tab(df: DataFrame, by: Sequence[str], measure: str, cells: dict[str, Column]) -> DataFrame:
    """Sum of a measure in each named cell."""
    sums = [F.sum(F.when(cond, F.col(measure)).otherwise(0)).alias(name) for name, cond in cells.items()]
    return df.groupBy(*by).agg(*sums)


def key_agreement(df: DataFrame, a: str, b: str) -> DataFrame:
    """How often ``b`` is missing, and how often it equals ``a``."""
    return df.agg(
        F.count("*").alias("n"),
        count_if(F.col(b).isNull()).alias("n_null"),
        percent(count_if(F.col(b).isNull()), F.count("*")).alias("pct_null"),
        count_if(F.col(a) == F.col(b)).alias("n_uguali"),
    )


def field_coverage(triples: DataFrame, groups: DataFrame, subject: str, group: str, values: Sequence[object]) -> DataFrame:
    """Distinct subjects having each predicate, one column per group value.

    (subject, predicate) pairs are made distinct first, so the join sees each once.
    """
    pairs = triples.select("p", F.col("s").alias(subject)).distinct()
    return pivot_counts(pairs.join(groups.select(subject, group), subject), ["p"], group, values, "n_")


def rich_acts(paths: DataFrame, kinds: Sequence[str], min_kinds: int, k: int) -> DataFrame:
    """Acts with the most kinds of documents, then the most XML files."""
    name = F.upper(F.col("kind"))
    per_act = (
        paths.filter(F.col("atto_id").isNotNull() & F.col("kind").isNotNull())
        .groupBy("atto_id")
        .agg(
            F.array_sort(F.collect_set(F.when(F.col("kind").isin(*kinds), F.col("kind")))).alias("interesting_dirs"),
            count_if(F.endswith(F.col("path"), F.lit(".akn.xml"))).alias("xml_files"),
            F.bool_or(name == "README.MD").alias("readme"),
        )
    )
    n_dirs = F.size("interesting_dirs")
    return per_act.filter(n_dirs >= min_kinds).orderBy(n_dirs.desc(), F.col("xml_files").desc(), "atto_id").limit(k)


def inventory(paths: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """One row per act with a flag for each kind of document."""
    flags = [F.coalesce(F.bool_or(F.col("kind") == k), F.lit(False)).alias(f"has_{k}") for k in kinds]
    return paths.filter(F.col("atto_id").isNotNull()).groupBy("legislatura", "atto_id").agg(*flags)


def inventory_summary(inv: DataFrame) -> DataFrame:
    """Acts, acts with amendments and processable acts per legislature, plus the grand total."""
    amended = F.col("has_emend") | F.col("has_emendc")
    return inv.rollup("legislatura").agg(
        F.count("*").alias("n_atti"),
        count_if(amended).alias("n_con_emendamenti"),
        count_if(amended & F.col("has_ddlpres")).alias("n_processabili"),
    )
