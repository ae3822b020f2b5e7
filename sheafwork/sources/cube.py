"""SRC-10: JSON-stat2 cubes to long rows.

A cube document lists its dimensions (``id``), their sizes (``size``), a sparse
map from flat row-major index to number (``value``) and, per dimension, the
position of every label. Only cells that are present get touched: they are cut
into parts, spread and exploded, and their index is taken apart by the strides
of the dimensions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

#: Cells of one document that are decoded together.
PART_CELLS = 1 << 14

SCHEMA = (
    "id array<string>, size array<bigint>, value map<string,double>, "
    "dimension map<string,struct<category:struct<index:map<string,bigint>>>>, _corrupt string"
)


def read_cubes(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """One row per cube file, parsed, with its text, path and modification time."""
    return parse_documents(_documents(spark.read, path, pattern))


def stream_documents(spark: SparkSession, path: str, pattern: str = "*.json", max_files_per_trigger: int | None = None) -> DataFrame:
    """SRC-11: text, path and time of landed cube files as a stream; its checkpoint remembers the files."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _documents(reader, path, pattern)


def _documents(reader: DataFrameReader | DataStreamReader, path: str, pattern: str) -> DataFrame:
    files = reader.option("wholetext", True).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").text(path)
    return files.select(
        F.col("value").alias("document"), F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
    )


def parse_documents(documents: DataFrame) -> DataFrame:
    parsed = F.from_json("document", SCHEMA, {"columnNameOfCorruptRecord": "_corrupt"}).alias("c")
    return documents.select(parsed, "document", "source_file", "modified_at").select("c.*", "document", "source_file", "modified_at")


def split_documents(cubes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Whole documents, and a dead letter (text, path, time) for each broken one."""
    broken = F.col("_corrupt").isNotNull()
    for part in ("id", "size", "value", "dimension"):
        broken = broken | F.col(part).isNull()
    return cubes.filter(~broken).drop("_corrupt", "document"), cubes.filter(broken).select("document", "source_file", "modified_at")


def _strides(size: Column) -> Column:
    """Row-major strides: the product of the sizes to the right of each dimension."""
    one = F.lit(1).cast("bigint")
    return F.transform(
        size,
        lambda _, i: F.aggregate(F.slice(size, i + 2, F.size(size)), one, lambda a, s: a * s),
    )


def _labels(dim: str) -> Column:
    """Labels of one dimension as an array in position order."""
    entries = F.map_entries(F.col("dimension")[dim]["category"]["index"])
    by_position = F.array_sort(
        F.transform(entries, lambda e: F.struct(e["value"].alias("position"), e["key"].alias("label")))
    )
    return F.transform(by_position, lambda e: e["label"])


def decode(cubes: DataFrame, dims: Sequence[str], keep: Sequence[str] = (), part_cells: int = PART_CELLS) -> DataFrame:
    """One row per present, non-null cell: a column per dimension, ``value``, the path and columns to ``keep``.

    Strides and label arrays are worked out once per document. Its cells are cut
    into parts of ``part_cells`` or, if the document has more labels than that,
    of as many cells as it has labels, so that copied labels never outweigh the
    cells. The parts are spread over tasks before they are decoded: a document
    of any size ends up in as many tasks as its cells deserve.
    """
    at = {d: F.array_position("id", d).cast("int") for d in dims}
    ready = cubes.withColumn("stride", _strides(F.col("size"))).select(
        "source_file",
        *keep,
        F.map_entries("value").alias("_cells"),
        *[F.element_at("stride", at[d]).alias(f"_stride_{d}") for d in dims],
        *[F.element_at("size", at[d]).alias(f"_size_{d}") for d in dims],
        *[_labels(d).alias(f"_labels_{d}") for d in dims],
    )
    labels = sum((F.coalesce(F.size(f"_labels_{d}"), F.lit(0)) for d in dims), F.lit(0))
    step = F.greatest(F.lit(part_cells), labels)
    starts = F.sequence(F.lit(1), F.greatest(F.size("_cells"), F.lit(1)), step)
    cut = F.transform(starts, lambda start: F.slice("_cells", start, step))
    parts = ready.select("*", F.posexplode(cut).alias("_part", "_some")).drop("_cells")
    cells = parts.repartition("source_file", "_part").select("*", F.explode("_some").alias("_entry")).drop("_some", "_part")
    cells = cells.select("*", F.col("_entry.key").cast("bigint").alias("_cell"), F.col("_entry.value").alias("_number"))
    cells = cells.filter(F.col("_number").isNotNull())

    def label(d: str) -> Column:
        position = F.floor(F.col("_cell") / F.col(f"_stride_{d}")) % F.col(f"_size_{d}")
        return F.get(F.col(f"_labels_{d}"), position.cast("int"))

    return cells.select(*[label(d).alias(d) for d in dims], F.col("_number").alias("value"), "source_file", *keep)


def encode(panel: DataFrame, dims: Sequence[str], value: str, part: Column) -> DataFrame:
    """Long rows to cube documents, one per ``part``: the inverse of ``decode``.

    Returns (part, document) with the document as JSON text. Meant for
    fixtures and exports: the cells of a part must fit one document.
    """
    rows = panel.withColumn("_part", part)
    labelled = rows
    index_columns, size_columns = [], []
    for d in dims:
        # Positions per part: labels in order, counted from 0. The label lists
        # are as short as the dimension.
        found = rows.groupBy("_part").agg(F.array_sort(F.collect_set(d)).alias(f"_l_{d}"))
        labelled = labelled.join(found, "_part")
        index_columns.append((F.array_position(f"_l_{d}", F.col(d)) - 1).alias(f"_i_{d}"))
        size_columns.append(F.size(f"_l_{d}").cast("bigint"))
    stride = F.lit(1).cast("bigint")
    flat = F.lit(0).cast("bigint")
    for position, size in zip(reversed(index_columns), reversed(size_columns)):
        flat = flat + position * stride
        stride = stride * size
    cells = labelled.withColumns({"_flat": flat})
    dimension = F.map_from_entries(
        F.array(
            *[
                F.struct(
                    F.lit(d).alias("k"),
                    F.struct(
                        F.struct(
                            F.map_from_arrays(
                                F.first(f"_l_{d}"),
                                F.sequence(F.lit(0).cast("bigint"), F.first(F.size(f"_l_{d}").cast("bigint")) - 1),
                            ).alias("index")
                        ).alias("category")
                    ).alias("v"),
                )
                for d in dims
            ]
        )
    )
    document = F.to_json(
        F.struct(
            F.array(*[F.lit(d) for d in dims]).alias("id"),
            F.array(*[F.first(F.size(f"_l_{d}").cast("bigint")) for d in dims]).alias("size"),
            F.map_from_entries(F.collect_list(F.struct(F.col("_flat").cast("string"), F.col(value).cast("double")))).alias("value"),
            dimension.alias("dimension"),
        )
    )
    return cells.groupBy("_part").agg(document.alias("document"))
