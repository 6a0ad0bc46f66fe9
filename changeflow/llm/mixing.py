"""Mix sources to target weights by subset-sum budget fitting.

A document's size is its number of words (runs outside space and 0x09-0x0D). Sources, in order of code points with null last, share all
words of the corpus by their weights; no target exceeds ``most`` times its source's size, and what is above is shared again by weight until
nothing is above. A source is taken ``floor(target / size)`` times as a whole; what is left of its target is a budget for one more copy of some documents.

The budget is filled from the source's histogram of sizes alone: all but ``PROGRAM_WORDS`` of it by the same share of every size (rounded
down) and then by the largest sizes, and the rest by a bounded-knapsack dynamic program over the documents that remain, which comes as near as
sizes allow. The histogram says how many documents of a size get one more copy; which ones, a seeded hash of the id decides.

Null texts have size 0. Documents of size 0 get the whole copies alone. Rows of equal ids are told apart by all their columns, and rows that are equal in all of them are equal candidates. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from changeflow.llm.common import find_words, slices, text_bytes, written

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
PROGRAM_WORDS = 1 << 14  # budget, about, that is left to the dynamic program
CELLS = 128  # hash cells of one level of the choice


def target_words(sizes: dict[str | None, int], weights: Sequence[float] = WEIGHTS, most: float = MOST) -> dict[str | None, float]:
    """Target words of every source, from the sources' sizes."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(names)}
    out, open_, left = {}, list(names), float(sum(sizes.values()))
    while open_:
        unit = left / sum(weight[s] for s in open_)
        above = [s for s in open_ if unit * weight[s] > most * sizes[s]]
        if not above:
            return out | {s: unit * weight[s] for s in open_}
        for s in above:
            out[s] = float(most * sizes[s])
            left -= out[s]
        open_ = [s for s in open_ if s not in set(above)]
        left = max(left, 0.0)
    return out


def fit_budget(sizes: np.ndarray, counts: np.ndarray, budget: int, program: int = PROGRAM_WORDS) -> np.ndarray:
    """How many documents of each size to take so that their words come to ``budget``, or as near below it as found."""
    sizes, counts = np.asarray(sizes, np.int64), np.asarray(counts, np.int64)
    total = int((sizes * counts).sum())
    if budget <= 0 or not total:
        return np.zeros(len(sizes), np.int64)
    if budget >= total:
        return np.where(sizes > 0, counts, 0)
    bulk = max(0, budget - program)
    take = np.array([c * bulk // total for c in counts.tolist()], np.int64) * (sizes > 0)
    left = budget - int((take * sizes).sum())
    for i in np.argsort(-sizes, kind="stable").tolist():
        if sizes[i] <= 0 or left <= program:
            break
        more = min(int(counts[i] - take[i]), (left - program) // int(sizes[i]))
        if more > 0:
            take[i] += more
            left -= more * int(sizes[i])
    # bounded knapsack: bit w of ``reach`` says that w words can be had; counts are split into powers of two
    reach, steps = 1, []
    mask = (1 << (left + 1)) - 1
    for i in np.random.default_rng(len(sizes)).permutation(len(sizes)).tolist():  # no size is preferred
        size, rest, part = int(sizes[i]), int(counts[i] - take[i]), 1
        if size <= 0 or size > left:
            continue
        rest = min(rest, left // size)
        while rest > 0 and not reach >> left & 1:
            k = min(part, rest)
            steps.append((reach, i, k, k * size))
            reach = (reach | reach << k * size) & mask
            rest, part = rest - k, part * 2
        if reach >> left & 1:
            break
    at = reach.bit_length() - 1
    for before, i, k, words in reversed(steps):
        if not before >> at & 1:
            take[i] += k
            at -= words
    return take


def _key(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source.cast("string")))


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns of a row, other than maps."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))])


def word_sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """(id, content, source_key, size, h): the narrow table that everything else works on; content is a hash of the whole row, h the seeded hash of the id."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = find_words(*text_bytes(batch.column("text")))[2]
            keep = ["id", "content", "source_key", "h"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(np.bincount(rows, minlength=batch.num_rows), pa.int64())], names=[*keep, "size"])

    text = F.col(text_col)
    narrow = docs.select(F.col(id_col).alias("id"), row_hash(docs).alias("content"), _key(F.col(source_col)).alias("source_key"), text.alias("text"), F.xxhash64(F.col(id_col), F.lit(seed)).alias("h"))
    return narrow.mapInArrow(count, f"id {narrow.schema['id'].dataType.simpleString()}, content long, source_key string, h long, size long")


def _first_by_hash(rows: DataFrame, wanted: DataFrame, level: int = 0, levels: int = 2) -> DataFrame:
    """rows (id, content, source_key, size, h) with ``more`` = 1 for the first ``need`` rows of (source_key, size) in order of hash cells.

    wanted: one row per (source_key, size) with ``need``. The cell in which the count is reached is found from counts per cell; only its rows go on to
    the next level, and only the rows of the last level's cell are ranked. So no task orders all rows of one size.
    """
    keys = ["source_key", "size", *(f"cell{k}" for k in range(level))]
    name = f"cell{level}"
    if level == levels:
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy("h", "id", "content"))
        ranked = rows.join(wanted, keys).withColumn("rank", rank)
        return ranked.select("id", "content", "source_key", "size", (F.col("rank") <= F.col("need")).cast("int").alias("more"))
    rows = rows.withColumn(name, F.pmod(F.shiftright("h", 7 * level), F.lit(CELLS)).cast("int"))
    counts = rows.join(wanted.select(*keys), keys, "left_semi").groupBy(*keys, name).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(*keys).orderBy(name)) - F.col("n")
    cut = counts.withColumn("before", before).join(wanted, keys).where("before < need and need <= before + n").select(*keys, F.col(name).alias("cut"), (F.col("need") - F.col("before")).alias("rest"))
    cut = written(cut, "mix-cut")
    placed = rows.join(cut, keys, "left")  # no cut: nothing is needed
    sure = placed.where(F.coalesce(F.col(name) != F.col("cut"), F.lit(True)))
    sure = sure.select("id", "content", "source_key", "size", F.coalesce((F.col(name) < F.col("cut")).cast("int"), F.lit(0)).alias("more"))
    edge = placed.where(F.col(name) == F.col("cut")).drop("cut", "rest")
    return sure.unionByName(_first_by_hash(edge, cut.select(*keys, F.col("cut").alias(name), F.col("rest").alias("need")), level + 1, levels))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[float] = WEIGHTS, most: int = MOST, seed: int = 17) -> DataFrame:
    """One row per row of ``docs``: id, content (hash of the row), size, source_size, target, copies, taken.

    The per-source totals, one row per source as in the list of weights, are the only thing that comes to the driver.
    """
    sized = written(word_sizes(docs, id_col, text_col, source_col, seed), "mix-sizes")
    histogram = written(sized.groupBy("source_key", "size").agg(F.count("*").alias("n")), "mix-histogram")
    totals = {r[0]: int(r[1]) for r in histogram.groupBy("source_key").agg(F.sum(F.col("size") * F.col("n"))).collect()}
    targets = {("n" if s is None else "s" + s): t for s, t in target_words({(None if k == "n" else k[1:]): v for k, v in totals.items()}, weights, most).items()}
    copies = {k: min(most, int(targets[k] // totals[k])) if totals[k] else 0 for k in totals}
    budgets = {k: round(targets[k]) - copies[k] * totals[k] if copies[k] < most else 0 for k in totals}

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        """One source's sizes: as many rows as there are different sizes."""
        key, pdf = pdf["source_key"].iloc[0], pdf.sort_values("size")  # rows arrive in any order, the plan must not
        return pdf[["source_key", "size"]].assign(need=fit_budget(pdf["size"].to_numpy(), pdf["n"].to_numpy(), budgets[key]))

    wanted = written(histogram.groupBy("source_key").applyInPandas(plan, "source_key string, size long, need long").where("need > 0"), "mix-wanted")
    chosen = _first_by_hash(sized, wanted)
    spark = docs.sparkSession
    sources = spark.createDataFrame([(k, totals[k], float(targets[k]), copies[k]) for k in sorted(totals)], "source_key string, source_size long, target double, whole int")
    out = chosen.join(sources, "source_key")
    count = F.col("whole") + F.col("more")
    return out.select(F.col("id").alias(id_col), "content", "size", "source_size", "target", count.alias("copies"), (F.col("size") * count).alias("taken"))


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs``, each as many times as the mix takes it. Rows that are equal in all columns count together."""
    columns, names = docs.columns, [f"c{i}" for i in range(len(docs.columns))]
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    mixed = mix(docs, id_col, text_col, **settings).groupBy(plain(id_col).alias("__id"), F.col("content").alias("__content")).agg(F.sum("copies").cast("int").alias("__copies"))
    rows = docs.toDF(*names)
    marked = rows.withColumns({"__id": plain(names[columns.index(id_col)]), "__content": row_hash(rows)})
    joined = marked.join(mixed.where("__copies > 0"), ["__id", "__content"]).dropDuplicates(["__id", "__content"])
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*names).toDF(*columns)
