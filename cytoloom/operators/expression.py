"""Normalised, quantised and encoded expression from the long count table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.codec import u32_hex, varint_hex, varint_length
from ..staging import staged

#: Places of cells that a task takes of a gene.
SEGMENT = 2**16


def library_size(cells: DataFrame, expression: DataFrame) -> DataFrame:
    """(cell_id, total) of every cell, 0 without counts."""
    sums = expression.groupBy("cell_id").agg(F.sum("count").alias("total"))
    return cells.select("cell_id").join(sums, "cell_id", "left").withColumn("total", F.coalesce("total", F.lit(0)))


def display_values(expression: DataFrame, scale_factor: float = 1e4) -> DataFrame:
    """(cell_id, gene_id, count, v): log of 1 plus the count over the cell's total, scaled. A total of 0 gives 0.

    One shuffle by cell: totals come from a window, not a join.
    """
    total = F.sum("count").over(Window.partitionBy("cell_id"))
    return expression.withColumn("total", total).withColumn("v", F.when(F.col("total") > 0, F.ln(1 + scale_factor * F.col("count") / F.col("total"))).otherwise(0.0)).drop("total")


def quantum() -> Column:
    """q of a value v whose gene has max_v at most."""
    q = F.greatest(F.lit(1.0), F.least(F.lit(255.0), F.rint(255.0 * F.col("v") / F.col("max_v"))))
    return F.when(F.col("max_v") > 0, q).otherwise(0.0).cast("int")


def quantised(values: DataFrame) -> DataFrame:
    """Adds max_v of the gene and q in 0..255; 0 is kept for genes without positive values.

    Gene maxima are aggregated map-side and joined back, so a gene that every cell has is
    not one task.
    """
    most = values.groupBy("gene_id").agg(F.max("v").alias("max_v"))
    return values.join(most, "gene_id").withColumn("q", quantum()).withColumn("max_v", F.greatest("max_v", F.lit(0.0)))


def detection(expression: DataFrame, genes: DataFrame) -> DataFrame:
    """(gene_id, nnz, max_count): cells that have the gene, 0 for genes without."""
    n = expression.groupBy("gene_id").agg(F.count("*").alias("nnz"), F.max("count").alias("max_count"))
    return genes.select("gene_id").join(n, "gene_id", "left").na.fill(0, ["nnz", "max_count"])


def deltas(quantised_: DataFrame, positions: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(gene_id, idx, delta, q): cell places of a gene in order and their differences, the first against 0. positions: (cell_id, idx).

    Only a segment of a gene's places is ordered in a task; the first difference of a
    segment is against the last place of the segments before, of which a gene has one row each.
    """
    rows = quantised_.join(positions.select("cell_id", "idx"), "cell_id").select("gene_id", "idx", "q", F.expr(f"cast(idx div {segment} as int)").alias("seg"))
    dealt = rows.repartition("gene_id", "seg")  # one exchange for both sides below
    last = dealt.groupBy("gene_id", "seg").agg(F.max("idx").alias("last"))
    before = last.select("gene_id", "seg", F.lag("last", 1, 0).over(Window.partitionBy("gene_id").orderBy("seg")).alias("before"))
    prior = F.lag("idx").over(Window.partitionBy("gene_id", "seg").orderBy("idx"))
    return dealt.withColumn("prior", prior).join(before, ["gene_id", "seg"]).select("gene_id", "idx", (F.col("idx") - F.coalesce("prior", "before")).alias("delta"), "q")


def quantised_deltas(values: DataFrame, positions: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """deltas(quantised(values), positions) with two exchanges of the values: by cell, as display_values() leaves them, and by gene and segment.

    A gene's greatest value is that of its segments, so it comes by the join that brings the
    place before a segment. All other sides have a row for each cell, or for each gene and segment.
    """
    rows = values.join(positions.select("cell_id", "idx"), "cell_id").select("gene_id", "idx", "v", F.expr(f"cast(idx div {segment} as int)").alias("seg"))
    dealt = rows.repartition("gene_id", "seg")  # both sides below read all its columns, so it is made once
    own = dealt.groupBy("gene_id", "seg").agg(F.max("idx").alias("last"), F.max("v").alias("most"))
    gene = Window.partitionBy("gene_id")
    facts = own.select("gene_id", "seg", F.lag("last", 1, 0).over(gene.orderBy("seg")).alias("before"), F.max("most").over(gene).alias("max_v"))
    prior = F.lag("idx").over(Window.partitionBy("gene_id", "seg").orderBy("idx"))
    return dealt.withColumn("prior", prior).join(facts, ["gene_id", "seg"]).select("gene_id", "idx", (F.col("idx") - F.coalesce("prior", "before")).alias("delta"), quantum().alias("q"))


def blob_sizes(deltas_: DataFrame, n_cells: int) -> DataFrame:
    """(gene_id, nnz, fmt, bytes): sparse if its codes and values are fewer than the cells, else dense; a header of five bytes."""
    sizes = deltas_.groupBy("gene_id").agg(F.count("*").alias("nnz"), F.sum(varint_length(F.col("delta"))).alias("codes"))
    sparse = F.col("codes") + F.col("nnz") < n_cells
    return sizes.select("gene_id", "nnz", F.when(sparse, 0).otherwise(1).alias("fmt"), (F.when(sparse, F.col("codes") + F.col("nnz")).otherwise(n_cells) + 5).alias("bytes"))


def blobs(deltas_: DataFrame, n_cells: int, segment: int = SEGMENT) -> DataFrame:
    """(gene_id, nnz, fmt, payload): format byte, count, then varint differences and values, or one value for every cell.

    A gene's bytes are made in segments of its places, each in a task of its own, which then
    follow one another: only the blob itself, one value of at most n_cells + 5 bytes, meets in one task.
    """
    deltas_ = staged(deltas_, "blob-deltas")  # read for the sizes and for the bytes
    sizes = blob_sizes(deltas_, n_cells).select("gene_id", "nnz", "fmt")
    rows = deltas_.join(sizes, "gene_id").withColumn("seg", F.expr(f"cast(idx div {segment} as int)"))
    parts = rows.groupBy("gene_id", "nnz", "fmt", "seg").agg(F.sort_array(F.collect_list(F.struct("idx", "delta", "q"))).alias("r"))
    byte = lambda q: F.lpad(F.hex(q.cast("long")), 2, "0")
    zeros = lambda n: F.repeat(F.lit("00"), n.cast("int"))
    first = F.col("seg").cast("long") * segment
    end = F.least(first + segment, F.lit(n_cells))
    gap = lambda x, i: F.when(i == 0, x["idx"] - first).otherwise(x["delta"] - 1)
    filled = F.concat(F.array_join(F.transform("r", lambda x, i: F.concat(zeros(gap(x, i)), byte(x["q"]))), ""), zeros(end - 1 - F.element_at("r", -1)["idx"]))
    codes = F.when(F.col("fmt") == 0, F.array_join(F.transform("r", lambda x: varint_hex(x["delta"])), "")).otherwise(filled)
    values = F.when(F.col("fmt") == 0, F.array_join(F.transform("r", lambda x: byte(x["q"])), "")).otherwise("")
    parts = parts.select("gene_id", "nnz", "fmt", F.struct("seg", codes.alias("codes"), values.alias("values")).alias("p"))
    whole = parts.groupBy("gene_id", "nnz", "fmt").agg(F.sort_array(F.collect_list("p")).alias("p"))
    sparse = F.concat(F.array_join(F.transform("p", lambda x: x["codes"]), ""), F.array_join(F.transform("p", lambda x: x["values"]), ""))
    # segments without the gene are zeros
    at = F.map_from_entries(F.transform("p", lambda x: F.struct(x["seg"], x["codes"])))
    every = F.sequence(F.lit(0), F.lit(max(0, (n_cells - 1) // segment)))
    dense = F.array_join(F.transform(every, lambda s: F.coalesce(F.element_at(at, s), zeros(F.least((s + 1) * segment, F.lit(n_cells)) - s * segment))), "")
    return whole.select("gene_id", "nnz", "fmt", F.unhex(F.concat(F.lpad(F.hex(F.col("fmt").cast("long")), 2, "0"), u32_hex(F.col("nnz")), F.when(F.col("fmt") == 0, sparse).otherwise(dense))).alias("payload"))


def decode_blob(payload: bytes, n_cells: int) -> tuple[list[int], list[int]]:
    """Places and values of a blob."""
    fmt, nnz, body = payload[0], int.from_bytes(payload[1:5], "little"), payload[5:]
    if fmt == 1:
        at = [i for i, q in enumerate(body) if q]
        return at, [body[i] for i in at]
    at, place, value, shift = [], 0, 0, 0
    for b in body[: len(body) - nnz]:
        value |= (b & 127) << shift
        shift += 7
        if b < 128:
            place += value
            at.append(place)
            value = shift = 0
    return at, list(body[len(body) - nnz :])
