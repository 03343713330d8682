"""Category codes, target encodings and scaling.

Everything is fitted from one long count table (column, category, fold), so encoding many
columns for many folds reads the data once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe import config
from riskframe.functions.cleaning import category_text
from riskframe.operators.joins import lookup_join, pin_small
from riskframe.operators.rows import train_rows
from riskframe.session import cut_lineage

TOP_KEYS = 1_000          # frequent keys whose values are broadcast
TRACKED_KEYS = 10_000     # keys the sketch that finds them keeps count of


# --- vocabularies ----------------------------------------------------------

def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def vocabulary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct (column, category) texts, missing as its own category, in one pass."""
    cells = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), category_text(F.col(c)).alias("category"))
        for c in columns])))
    return cells.distinct()


def vocabulary_of_splits(train: DataFrame, test: DataFrame, columns: list[str]) -> DataFrame:
    """Categories of either side."""
    return vocabulary(train.select(*columns), columns).union(
        vocabulary(test.select(*columns), columns)).distinct()


def with_sentinel(vocab: DataFrame, label: str = config.UNSEEN_LABEL) -> DataFrame:
    """The vocabulary plus the sentinel once per column."""
    extra = vocab.select("column").distinct().withColumn("category", F.lit(label))
    return vocab.union(extra).distinct()


def rank_categories(vocab: DataFrame, by: list[str] = ("column",)) -> DataFrame:
    """`code` = position of `category` in sorted order within `by`, from 0.

    A small vocabulary is ranked by a window. A large one is range-partitioned by
    (by, category): position inside the partition plus what lies in earlier partitions.
    """
    by = list(by)
    small = pin_small(vocab)
    if small is not None:
        order = Window.partitionBy(*by).orderBy("category")
        return small.withColumn("code", (F.dense_rank().over(order) - 1).cast("int"))
    return rank_by_range(vocab, by)


def rank_by_range(vocab: DataFrame, by: list[str]) -> DataFrame:
    """Distributed form of `rank_categories`; (by, category) must be unique."""
    placed = vocab.repartitionByRange(*by, "category").sortWithinPartitions(*by, "category")
    # The id packs the partition in the upper bits and the position in the lower 33.
    placed = cut_lineage(placed.withColumn("_id", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_id", 33))
    # Rows per (by, partition): one row per partition and column, not per category.
    parts = placed.groupBy(*by, "_part").agg(
        F.count("*").alias("_size"), F.min("_id").alias("_first"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
    pinned = pin_small(parts.drop("_size"))
    parts = parts.drop("_size") if pinned is None else F.broadcast(pinned)
    ranked = placed.join(parts, [*by, "_part"])
    return ranked.withColumn(
        "code", (F.col("_before") + F.col("_id") - F.col("_first")).cast("int")
    ).drop("_part", "_id", "_first", "_before")


def _attach(df: DataFrame, table: DataFrame, small: bool, columns, value: str, suffix: str,
            missing_is_category: bool) -> DataFrame:
    """`{c}{suffix}`: `value` of the (column, category) row each cell of `c` points to."""
    def text(c):
        return category_text(F.col(c)) if missing_is_category else F.col(c).cast("string")

    if not small:
        return _attach_large(df, table, {c: text(c) for c in columns}, value, suffix)
    keys = {c: f"_k_{c}" for c in columns}
    df = df.withColumns({key: text(c) for c, key in keys.items()})
    for c, key in keys.items():
        lookup = table.filter(F.col("column") == c).select(
            F.col("category").alias(key), F.col(value).alias(f"{c}{suffix}"))
        df = lookup_join(df, lookup, key, pinned=True)
    return df.drop(*keys.values())


def frequent_keys(cells: DataFrame, most: int | None = None) -> DataFrame:
    """(_col, _key) of the most frequent cells of all columns, from one mergeable sketch.

    A key with more than 4/`TRACKED_KEYS` of the cells is never missed; at most `most` rows
    (`TOP_KEYS`).
    """
    most = TOP_KEYS if most is None else most
    name = F.concat_ws(":", F.col("_col").cast("string"), "_key")
    found = cells.select(name.alias("_name")).filter(F.col("_name").contains(":")).agg(
        F.expr(f"approx_top_k(_name, {most}, {TRACKED_KEYS})").alias("top"))
    item = F.col("t.item")
    keys = found.select(F.explode("top").alias("t")).select(
        F.substring_index(item, ":", 1).cast("int").alias("_col"),
        F.expr("substring(t.item, locate(':', t.item) + 1)").alias("_key"))
    return keys


def _attach_large(df: DataFrame, table: DataFrame, keys: dict, value: str, suffix: str) -> DataFrame:
    """The same for a table of any size, in two scans and one join whatever the number of columns.

    The cells of all columns are one long table. The values of its most frequent keys are broadcast;
    all other cells meet theirs in one shuffle, where no key has many of them, and return by row.
    """
    base = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()))
    cells = base.select("_row", F.inline(F.array(*[
        F.struct(F.lit(i).alias("_col"), key.alias("_key")) for i, key in enumerate(keys.values())])))
    named = table.select("column", F.col("category").alias("_key"), F.col(value).alias("_value")).join(
        F.broadcast(df.sparkSession.createDataFrame([(c, i) for i, c in enumerate(keys)], "column string, _col int")),
        "column").drop("column")
    # As many rows as the sketch has, at most.
    hot = pin_small(frequent_keys(cells).join(named, ["_col", "_key"], "left").withColumn("_hot", F.lit(True)), TOP_KEYS)
    marked = cells.filter(F.col("_key").isNotNull()).join(F.broadcast(hot), ["_col", "_key"], "left")
    cold = marked.filter(F.col("_hot").isNull()).select("_row", "_col", "_key").join(named, ["_col", "_key"])
    found = marked.filter("_hot").select("_row", "_col", "_value").unionByName(cold.select("_row", "_col", "_value"))
    wide = found.groupBy("_row").agg(*[
        F.first(F.when(F.col("_col") == i, F.col("_value")), ignorenulls=True).alias(f"{c}{suffix}")
        for i, c in enumerate(keys)])
    return base.join(wide, "_row", "left").drop("_row")


def _per_fold_default(df: DataFrame, columns, suffix: str, defaults: dict) -> DataFrame:
    """Fill missing arrays, and missing positions of arrays, from one array per column."""
    made = {}
    for c in columns:
        out, other = f"{c}{suffix}", defaults[c]
        made[out] = F.when(F.col(out).isNull(), other).otherwise(F.zip_with(
            out, other, lambda v, o: F.coalesce(v, o)))
    return df.withColumns(made)


def _code_columns(df: DataFrame, vocab: DataFrame, columns, suffix: str,
                  missing_is_category: bool = True) -> DataFrame:
    ranked, small = _materialised(rank_categories(vocab))
    return _attach(df, ranked, small, columns, "code", suffix, missing_is_category)


def label_encode(df: DataFrame, columns: list[str], suffix: str = "_code") -> DataFrame:
    """Codes by sorted order over the categories of train and test together."""
    return _code_columns(df, vocabulary(df, columns), columns, suffix)


def category_codes(df: DataFrame, columns: list[str], suffix: str = "_code") -> DataFrame:
    """Codes over the non-missing categories; missing is −1."""
    present = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category"))
        for c in columns]))).filter(F.col("category").isNotNull()).distinct()
    coded = _code_columns(df, present, columns, suffix, False)
    return coded.withColumns({
        f"{c}{suffix}": F.coalesce(F.col(f"{c}{suffix}"), F.lit(-1)) for c in columns})


# --- statistics per category and fold --------------------------------------

def fold_counts(train: DataFrame, columns: list[str], fold: str = "fold",
                target: str = config.TARGET) -> DataFrame:
    """Rows and target sum by (column, category, fold); a null category is kept.

    Combined before the shuffle, so a category of any size is one partial row per task.
    """
    cells = train.select(F.col(fold).alias("fold"), F.col(target).alias("_y"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category"))
        for c in columns])))
    return cells.groupBy("column", "category", "fold").agg(
        F.count("*").alias("n"), F.count("_y").alias("n_y"), F.sum("_y").alias("s"))


def _arrays_by_category(counts: DataFrame, k: int) -> DataFrame:
    """One row per (column, category): per-fold n, n_y and s with absent folds as zero."""
    def per_fold(value):
        return F.array(*[
            F.coalesce(F.sum(F.when(F.col("fold") == f, F.col(value))), F.lit(0))
            for f in range(k)])

    return counts.groupBy("column", "category").agg(
        per_fold("n").alias("n"), per_fold("n_y").alias("n_y"), per_fold("s").alias("s"))


def _outside(values: str, f: int):
    """Sum of an array without position f, free of subtraction error."""
    return F.aggregate(
        F.transform(values, lambda v, i: F.when(i == f, F.lit(0)).otherwise(v)),
        F.lit(0.0), lambda acc, v: acc + v.cast("double"))


def fold_table(df: DataFrame, columns: list[str], fold: str = "fold",
               target: str = config.TARGET) -> DataFrame:
    """`fold_counts` of the train rows, computed once: all per-fold encodings below can be
    fitted from it by passing it as `counts`."""
    return _materialised(fold_counts(train_rows(df), columns, fold, target))[0]


def fold_target_maps(counts: DataFrame, k: int = config.N_FOLDS) -> tuple[DataFrame, list[float]]:
    """Leave-fold-out target means and their defaults.

    Returns (column, category, te) where te[f] is the mean over the rows outside fold f,
    null where no such row exists, and the overall mean outside each fold.
    """
    arrays = _arrays_by_category(counts, k)
    maps = arrays.filter(F.col("category").isNotNull()).select(
        "column", "category", F.array(*[
            F.try_divide(_outside("s", f), _outside("n_y", f)) for f in range(k)]).alias("te"))
    # Every column sees the same rows, so any one column's sums give the overall means.
    sums = counts.groupBy("column", "fold").agg(
        F.sum("n_y").alias("n"), F.sum("s").alias("s")).collect()
    one = sums[0]["column"]
    defaults = []
    for f in range(k):
        others = [r for r in sums if r["column"] == one and r["fold"] != f]
        n, s = sum(r["n"] for r in others), sum(r["s"] or 0.0 for r in others)
        defaults.append(s / n if n else None)
    return maps, defaults


def add_fold_target_encoding(df: DataFrame, columns: list[str], k: int = config.N_FOLDS,
                             fold: str = "fold", target: str = config.TARGET,
                             suffix: str = "_te", counts: DataFrame | None = None) -> DataFrame:
    """`{c}_te`: array whose position f is the encoding fold model f must use.

    Train rows carry their fold in `fold`; test rows have it null. Nothing of fold f's own
    targets enters position f, so validation rows read position `fold`.
    """
    counts = fold_table(df, columns, fold, target) if counts is None else counts
    maps, defaults = fold_target_maps(counts.filter(F.col("column").isin(list(columns))), k)
    maps, small = _materialised(maps)
    fallback = F.array(*[F.lit(d).cast("double") for d in defaults])
    df = _attach(df, maps, small, columns, "te", suffix, missing_is_category=False)
    return _per_fold_default(df, columns, suffix, {c: fallback for c in columns})


def _materialised(table: DataFrame) -> tuple[DataFrame, bool]:
    """Small: pinned. Large: cut off from its inputs once, since every column reads it."""
    pinned = pin_small(table)
    return (cut_lineage(table), False) if pinned is None else (pinned, True)


def explode_folds(df: DataFrame, te_columns: list[str], k: int = config.N_FOLDS,
                  name: str = "model_fold") -> DataFrame:
    """One row per fold model with that model's encodings."""
    rows = F.array(*[
        F.struct(F.lit(f).alias(name), *[F.get(c, F.lit(f)).alias(c) for c in te_columns])
        for f in range(k)])
    rest = [c for c in df.columns if c not in te_columns]
    return df.select(*rest, F.inline(rows))


def add_target_encoding(df: DataFrame, columns: list[str], target: str = config.TARGET,
                        suffix: str = "_te") -> DataFrame:
    """Train-wide group means per category; null or unseen categories take the overall mean.

    Train rows see their own target here; use `add_fold_target_encoding` inside validation.
    """
    columns = [c for c in columns if c in df.columns]
    counts = fold_counts(train_rows(df).withColumn("_all", F.lit(0)), columns, "_all", target)
    sums, small = _materialised(counts)
    n, s = sums.filter(F.col("column") == columns[0]).agg(F.sum("n_y"), F.sum("s")).first()
    default = F.lit(s / n if n else None).cast("double")
    means = sums.filter(F.col("category").isNotNull()).withColumn(
        "te", F.try_divide("s", "n_y"))
    df = _attach(df, means, small, columns, "te", suffix, missing_is_category=False)
    return df.withColumns({f"{c}{suffix}": F.coalesce(F.col(f"{c}{suffix}"), default)
                           for c in columns})


# --- codes fitted on fold-train only ---------------------------------------

def _fold_vocabulary(counts: DataFrame, columns, k: int, as_text: bool) -> DataFrame:
    """(column, category, model_fold) for the categories found outside each fold."""
    mine = counts.filter(F.col("column").isin(list(columns)))
    if as_text:
        mine = mine.withColumn("category", category_text(F.col("category")))
    arrays = _arrays_by_category(mine, k).filter(F.col("category").isNotNull())
    present = F.array_compact(F.array(*[
        F.when(_outside("n", f) > 0, F.lit(f)) for f in range(k)]))
    return arrays.select("column", "category", F.explode(present).alias("model_fold"))


def _fold_code_arrays(df, ranked, columns, k, suffix, unseen, as_text) -> DataFrame:
    """Attach `{c}{suffix}`: array of one code per fold model."""
    per_fold = [F.max(F.when(F.col("model_fold") == f, F.col("code"))) for f in range(k)]
    arrays, small = _materialised(ranked.groupBy("column", "category").agg(
        F.array(*per_fold).alias("codes")))
    others = {} if unseen is None else {
        r["column"]: r["codes"] for r in arrays.filter(F.col("category") == unseen).collect()}
    df = _attach(df, arrays, small, columns, "codes", suffix, as_text)
    return _per_fold_default(df, columns, suffix, {
        c: F.array(*[F.lit(v).cast("int") for v in others.get(c, [None] * k)])
        for c in columns})


def add_fold_label_codes(df: DataFrame, columns: list[str], k: int = config.N_FOLDS,
                         fold: str = "fold", suffix: str = "_code", unseen: str = "sentinel",
                         counts: DataFrame | None = None) -> DataFrame:
    """Codes by sorted order over the categories outside fold f, plus the sentinel.

    Categories fold model f never saw take the sentinel's code, which lies in sorted
    position. `unseen="first"` leaves the sentinel out and maps them to code 0.
    """
    counts = fold_table(df, columns, fold) if counts is None else counts
    vocab = _fold_vocabulary(counts, columns, k, as_text=True)
    if unseen == "sentinel":
        folds = df.sparkSession.createDataFrame(
            [(c, config.UNSEEN_LABEL, f) for c in columns for f in range(k)], vocab.schema)
        vocab = vocab.union(folds).distinct()
    ranked = rank_categories(vocab, ["column", "model_fold"])
    if unseen == "sentinel":
        return _fold_code_arrays(df, ranked, columns, k, suffix, config.UNSEEN_LABEL, True)
    coded = _fold_code_arrays(df, ranked, columns, k, suffix, None, True)
    return coded.withColumns({
        f"{c}{suffix}": F.transform(f"{c}{suffix}", lambda v: F.coalesce(v, F.lit(0)))
        for c in columns})


def add_fold_native_codes(df: DataFrame, columns: list[str], k: int = config.N_FOLDS,
                          fold: str = "fold", suffix: str = "_code",
                          counts: DataFrame | None = None) -> DataFrame:
    """Codes over the non-missing categories outside fold f; missing and unseen are null."""
    counts = fold_table(df, columns, fold) if counts is None else counts
    ranked = rank_categories(_fold_vocabulary(counts, columns, k, as_text=False),
                             ["column", "model_fold"])
    return _fold_code_arrays(df, ranked, columns, k, suffix, None, False)


# --- scaling ---------------------------------------------------------------

def standardise(df: DataFrame, columns: list[str], fitted_on: DataFrame | None = None,
                suffix: str = "_std") -> DataFrame:
    """(x − mean)/population std, fitted on `fitted_on`; a constant column becomes 0."""
    source = df if fitted_on is None else fitted_on
    got = source.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(columns)
                       for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    return df.withColumns({
        f"{c}{suffix}": (F.col(c) - F.lit(got[f"m{i}"])) / F.lit(got[f"s{i}"] or 1.0)
        for i, c in enumerate(columns)})


def fill_medians(df: DataFrame, columns: list[str], fitted_on: DataFrame | None = None
                 ) -> DataFrame:
    """Missing values to the exact median of `fitted_on`, 0 where it has no value."""
    from riskframe.operators.quantiles import quantile_values

    medians = quantile_values(df if fitted_on is None else fitted_on, columns, [0.5])
    return df.withColumns({
        c: F.coalesce(F.col(c), F.lit(medians[c][0] if medians[c][0] is not None else 0.0))
        for c in columns})
