"""Prepared bills to the rows of the authors and propositions tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawloom.functions.dates import parse_timestamp
from lawloom.operators.prepare import has_id


def unique_authors(bills: DataFrame, order_by: Sequence[str] = ("id",)) -> DataFrame:
    """One row per author id; name, party and state of its first occurrence.

    First means lowest (`order_by`, position in `autores`). The minimum is taken
    before the shuffle too, so an author on very many bills costs one row per task.
    """
    seen = bills.select(*order_by, F.posexplode("autores").alias("_pos", "_a")).filter(has_id(F.col("_a.idDeputadoAutor")))
    row = F.struct(
        F.col("_a.nomeAutor").alias("full_name"),
        F.col("_a.siglaPartidoAutor").alias("poli_party"),
        F.col("_a.siglaUFAutor").alias("uf"),
    )
    first = seen.groupBy(F.col("_a.idDeputadoAutor").alias("_id")).agg(
        F.min_by(row, F.struct(*order_by, "_pos")).alias("_first")
    )
    return first.select(F.col("_id").try_cast("int").alias("id"), "_first.*")


def distinct_author_ids(autores: str = "autores") -> Column:
    """Author ids of one bill in order of first occurrence, without null and 0."""
    return F.array_distinct(F.filter(F.col(autores).getField("idDeputadoAutor"), has_id)).cast("array<int>")


def proposition_rows(bills: DataFrame) -> DataFrame:
    """Rows of the propositions table; an id or date that does not fit its type is null."""
    return bills.select(
        F.col("id").try_cast("int").alias("id"),
        F.col("urlInteiroTeor").alias("url_full_text"),
        F.col("descricaoTipo").alias("proposition_type"),
        parse_timestamp(F.col("dataApresentacao")).alias("submission_date"),
        distinct_author_ids().alias("authors"),
    )
