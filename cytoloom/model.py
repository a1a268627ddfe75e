"""Canonical tables: strict ordered schemas, and the bundle that operators take."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_S, _D, _F, _I, _B = T.StringType(), T.DoubleType(), T.FloatType(), T.IntegerType(), T.BooleanType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in columns.items()])


CELLS = _schema(cell_id=_S, section_id=_S, core_id=_S, patient_id=_S, x_um=_D, y_um=_D, umap_x=_F, umap_y=_F, has_umap=_B, cluster_id=_S, n_transcripts=_I)
GENES = _schema(gene_id=_S, symbol=_S, panel=_S)
CLUSTERS = _schema(cluster_id=_S, label=_S, color=_S, order=T.ShortType(), n_cells=_I)
CORES = _schema(core_id=_S, section_id=_S, patient_id=_S, kind=_S, center_x_um=_D, center_y_um=_D, radius_um=_D, bbox_x0=_D, bbox_y0=_D, bbox_x1=_D, bbox_y1=_D)
SECTIONS = _schema(
    section_id=_S, he_image=_S, affine=T.ArrayType(_D), affine_source=T.ArrayType(_D), pixel_size=_D, he_pixel_size_um=_D,
    bounds_x0=_D, bounds_y0=_D, bounds_x1=_D, bounds_y1=_D,
)
#: Long form of the count matrix; zeros are absent.
EXPRESSION = _schema(cell_id=_S, gene_id=_S, count=_I)
SCHEMAS = {"cells": CELLS, "genes": GENES, "clusters": CLUSTERS, "cores": CORES, "sections": SECTIONS, "expression": EXPRESSION}


@dataclass(frozen=True)
class Record:
    """Provenance of a dataset."""

    name: str
    title: str = ""
    license: str = ""
    citation: str = ""
    provenance: dict = field(default_factory=dict)
    synthetic: bool = False
    visibility: str = "public"
    release: str = ""

    def __post_init__(self) -> None:
        if self.visibility not in ("public", "private"):
            raise ValueError(f"visibility {self.visibility!r} is neither public nor private")


@dataclass(frozen=True)
class Dataset:
    """Five tables and the counts, all lazy."""

    sections: DataFrame
    cores: DataFrame
    clusters: DataFrame
    genes: DataFrame
    cells: DataFrame
    expression: DataFrame
    record: Record = Record("unnamed")

    def having(self, **tables) -> Dataset:
        return replace(self, **tables)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df with the schema's columns, in its order and types; a missing column is an error, others go."""
    if missing := [f.name for f in schema if f.name not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema])
