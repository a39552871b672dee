"""Ordered folds: carried values, continued rows, clustered lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def carry_forward(df: DataFrame, part: list[str], order: list[Column], columns: list[str]) -> DataFrame:
    """Each column's last non-null value so far."""
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def carry_levels(df: DataFrame, part: list[str], order: list[Column], levels: list[str]) -> DataFrame:
    """Open headings: a value at one level closes all levels below it."""
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    group: list[str] = []
    for k, level in enumerate(levels):
        df = df.withColumn(f"_g{k}", F.count(level).over(w))
        group.append(f"_g{k}")
    for k, level in enumerate(levels):
        inner = Window.partitionBy(*part, *group[:k]).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        df = df.withColumn(f"_v{k}", F.last(level, ignorenulls=True).over(inner))
    for k, level in enumerate(levels):
        df = df.withColumn(level, F.col(f"_v{k}")).drop(f"_v{k}")
    return df.drop(*group)


def continuation_groups(df: DataFrame, part: list[str], order: list[Column], is_start: Column, name: str = "group_no") -> DataFrame:
    """Numbers groups that begin wherever ``is_start`` holds; rows before the first start are group 0."""
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(F.when(is_start, 1).otherwise(0)).over(w).cast("bigint"))


def joined_rows(df: DataFrame, part: list[str], group: str, order: list[str], texts: list[str], pages: str | None = None) -> DataFrame:
    """One row per group: texts end to end in order, and the pages that it spans."""
    packed = F.sort_array(F.collect_list(F.struct(*order, *(F.col(t).alias(f"_{t}") for t in texts))))

    def joined(t: str) -> Column:
        return F.array_join(F.filter(F.transform(packed, lambda x: x[f"_{t}"]), lambda s: s != ""), " ").alias(t)

    out = [joined(t) for t in texts]
    if pages:
        out.append(F.array_sort(F.collect_set(pages)).alias("pages"))
    return df.groupBy(*part, group).agg(*out)


def cluster_lines(words: DataFrame, part: list[str], starts: list[float], tolerance: float = 2.0) -> DataFrame:
    """Words (text, x0, top) of a page as lines of cells.

    A word joins a line if its top is within ``tolerance`` of the line's first
    word, so lines depend on the ones before them. Pages are dealt to tasks and
    sorted there, and a task folds its words as they stream by: what it holds is
    the line that is open, so a page may have any number of words. A word's
    column is the last start not right of it; words without a place are in no line.
    """
    names = [f"cell_{k}" for k in range(len(starts))]
    kinds = [words.schema[c].dataType.simpleString() for c in part]
    schema = ", ".join([f"{c} {t}" for c, t in zip(part, kinds, strict=True)] + ["line_no bigint", "top double"] + [f"{n} string" for n in names])
    rows = words.where("top IS NOT NULL AND x0 IS NOT NULL").select(*part, F.col("top").cast("double").alias("top"), F.col("x0").cast("double").alias("x0"), "text")
    dealt = rows.repartition(*part).sortWithinPartitions(*part, "top", "x0", "text")
    edges = np.sort(np.array(starts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        page, number, first, held = None, 0, 0.0, []

        def line() -> tuple:
            cells: list[list[str]] = [[] for _ in starts]
            for x, text in sorted(held, key=lambda w: w[0]):
                cells[max(int(np.searchsorted(edges, x, "right")) - 1, 0)].append(text or "")
            return *page, number, first, *(" ".join(c) for c in cells)

        for batch in batches:
            out = []
            keys = list(zip(*(batch.column(c).to_pylist() for c in part), strict=True)) if part else [()] * batch.num_rows
            tops, places, texts = np.asarray(batch.column("top")), batch.column("x0").to_pylist(), batch.column("text").to_pylist()
            at = 0
            while at < len(tops):
                if keys[at] != page or tops[at] - first > tolerance:
                    if page is not None:
                        out.append(line())
                    number = number + 1 if keys[at] == page else 0
                    page, first, held = keys[at], float(tops[at]), []
                # The words that belong to the open line: tops ascend within a page.
                end = at + 1
                while end < len(tops) and keys[end] == page and tops[end] - first <= tolerance:
                    end += 1
                held += zip(places[at:end], texts[at:end], strict=True)
                at = end
            if out:
                yield _batch(out, batch.schema)
            last = batch.schema
        if page is not None:
            yield _batch([line()], last)

    def _batch(lines: list[tuple], had: pa.Schema) -> pa.RecordBatch:
        types = [had.field(c).type for c in part] + [pa.int64(), pa.float64()] + [pa.string()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*lines, strict=True), types, strict=True)], names=[*part, "line_no", "top", *names])

    return dealt.mapInArrow(run, schema)
