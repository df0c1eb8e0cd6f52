"""Readers for JSON files that hold one array under a root key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lawloom.functions.structs import flatten


def _wrapper(roots: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(r, T.ArrayType(T.VariantType())) for r in roots])


def explode_root(
    documents: DataFrame,
    roots: Sequence[str],
    schema: T.StructType,
    require_root: bool = False,
    keep: Sequence[str] = (),
    spread: bool = False,
) -> DataFrame:
    """One row per object of the root array, with its position in `src_pos`.

    `documents` has one column of type array<variant> per root, so that an element
    has a type: those that are not objects are skipped, also texts that look like
    one. A field of the wrong type is null. A document without any root has no rows,
    or is an error with `require_root`. `spread` deals the elements out before they
    are parsed, for documents that are large files.
    """
    objects = root_elements(documents, roots, require_root, keep, spread)
    parsed = objects.select(*keep, "src_pos", F.from_json(F.to_json("_element"), schema).alias("_row"))
    return parsed.select(*keep, "src_pos", "_row.*")


def root_elements(
    documents: DataFrame, roots: Sequence[str], require_root: bool = False, keep: Sequence[str] = (), spread: bool = False
) -> DataFrame:
    """(keep, src_pos, _element): the objects of the root arrays as variants, see `explode_root`."""
    array = F.coalesce(*[F.col(r) for r in roots])
    if require_root:
        missing = F.raise_error(F.lit("JSON document has none of the expected root keys"))
        array = F.coalesce(array, missing)
    elements = documents.select(*keep, F.posexplode(array).alias("src_pos", "_element"))
    if spread:
        elements = elements.repartition(*keep, "src_pos")
    return elements.filter(F.schema_of_variant("_element").startswith("OBJECT"))


def explode_root_text(
    documents: DataFrame,
    text_column: str,
    schema: T.StructType,
    roots: Sequence[str] = ("dados",),
    require_root: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """`explode_root` for JSON documents held as texts in a column; bad JSON fails the job."""
    opened = F.from_json(text_column, _wrapper(roots), {"mode": "FAILFAST"})
    return explode_root(documents.select(*keep, opened.alias("_doc")).select(*keep, "_doc.*"), roots, schema, require_root, keep)


def _files(spark: SparkSession, path: str | list[str], roots: Sequence[str]) -> DataFrame:
    """(src_file, one array of variants per root) of whole JSON files; a malformed or missing file fails the job."""
    return (
        spark.read.schema(_wrapper(roots))
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .json(path)
        .select(F.col("_metadata.file_path").alias("src_file"), *roots)
    )


def read_root_json(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    roots: Sequence[str] = ("dados",),
    require_root: bool = False,
) -> DataFrame:
    """Read whole-file JSON; a missing path or a malformed file fails the job.

    Rows carry (`src_file`, `src_pos`), the order of the input. A multi-line file is
    opened by one task; its elements are dealt out before they are parsed. Large
    inputs should come as many files and be converted to Parquet once, or be read by
    `read_split_json`.
    """
    return explode_root(_files(spark, path, roots), roots, schema, require_root, keep=("src_file",), spread=True)


def stage_root_json(
    spark: SparkSession, path: str | list[str], folder: str, roots: Sequence[str] = ("dados",), require_root: bool = False
) -> None:
    """Write the objects under the root to `folder`, one to a line, so that later passes are parallel.

    The whole files are read in this pass only.
    """
    elements = root_elements(_files(spark, path, roots), roots, require_root, ("src_file",))
    line = F.to_json(F.struct("src_file", "src_pos", F.col("_element").alias("row")))
    elements.repartition("src_file", "src_pos").select(line.alias("value")).write.text(folder)


def read_staged_json(spark: SparkSession, folder: str, base: T.StructType) -> DataFrame:
    """`src_file`, `src_pos`, the columns of `base`, and after them every other field that a staged object has."""
    lines = spark.read.option("mode", "FAILFAST")
    found = lines.json(folder).schema
    row = found["row"].dataType if "row" in found.names else T.StructType()
    schema = T.StructType().add("src_file", T.StringType()).add("src_pos", T.IntegerType()).add("row", _with_others(base, row))
    return spark.read.schema(schema).json(folder).select("src_file", "src_pos", "row.*")


def _with_others(base: T.StructType, *found: T.DataType) -> T.StructType:
    """`base`, then the fields of the other structs that it lacks."""
    fields = {f.name: f for f in base.fields}
    for other in found:
        for field in other.fields if isinstance(other, T.StructType) else ():
            fields.setdefault(field.name, field)
    return T.StructType(list(fields.values()))


def root_schema(
    spark: SparkSession, path: str | list[str], base: T.StructType, roots: Sequence[str] = ("dados",)
) -> T.StructType:
    """`base` and, after it, every other field that objects under the root have, with inferred types."""
    found = spark.read.option("multiLine", True).option("mode", "FAILFAST").json(path).schema
    arrays = [found[root].dataType for root in roots if root in found.names]
    return _with_others(base, *[a.elementType for a in arrays if isinstance(a, T.ArrayType)])


def read_bills(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    sep: str = ".",
) -> DataFrame:
    """Bills under either root key, nested objects flattened to columns."""
    return flatten(
        read_root_json(spark, path, schema, roots=("dados", "proposicoes"), require_root=True), sep
    )
