"""Row types of the inputs, the model answers and the six result tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_STRING, _INT, _LONG, _DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _optional(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


def _required(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, False) for name, kind in columns.items()])


_BILL = _optional(
    id=_LONG, siglaTipo=_STRING, descricaoTipo=_STRING, dataApresentacao=_STRING, urlInteiroTeor=_STRING
)
RAW_BILL = T.StructType(
    _BILL.fields
    + _optional(
        ultimoStatus=_STRING,
        uriOrgaoNumerador=_STRING,
        uriPropAnterior=_STRING,
        uriPropPrincipal=_STRING,
        uriPropPosterior=_STRING,
    ).fields
)
AUTHOR_ENTRY = _optional(idDeputadoAutor=_LONG, nomeAutor=_STRING, siglaPartidoAutor=_STRING, siglaUFAutor=_STRING)
RAW_AUTHOR = T.StructType(_optional(idProposicao=_LONG).fields + AUTHOR_ENTRY.fields)
PREPARED_BILL = T.StructType(_BILL.fields + _optional(autores=T.ArrayType(AUTHOR_ENTRY)).fields)
CLEANED_BILL = T.StructType(PREPARED_BILL.fields + _optional(textoInteiroTeorLimpo=_STRING).fields)

LINES = _optional(doc_id=_LONG, page_no=_INT, page_height=_DOUBLE, line_no=_INT, y0=_DOUBLE, line=_STRING)
PAGES = _optional(doc_id=_LONG, page_no=_INT, page_height=_DOUBLE)

SUMMARY_ANSWER = _optional(
    text_summary=_STRING,
    main_theme=_STRING,
    entities=T.ArrayType(T.ArrayType(_STRING)),
    sentiment=_STRING,
    ideology=_STRING,
)
TOPIC_ANSWER = _optional(topic=_STRING)


@dataclass(frozen=True)
class Table:
    """A result table: its columns (all required) and its primary key."""

    name: str
    schema: T.StructType
    keys: tuple[str, ...]


PROPOSITIONS = Table(
    "propositions",
    _required(
        id=_INT,
        url_full_text=_STRING,
        proposition_type=_STRING,
        submission_date=T.TimestampNTZType(),
        authors=T.ArrayType(_INT),
    ),
    ("id",),
)
AUTHORS = Table("authors", _required(id=_INT, full_name=_STRING, poli_party=_STRING, uf=_STRING), ("id",))
WORD_CLOUD = Table("proposition_word_cloud", _required(id=_INT, word=_STRING, frequency=_INT), ("id", "word"))
SUMMARY = Table(
    "proposition_summary",
    _required(id=_INT, text_summary=_STRING, main_theme=_STRING, sentiment=_STRING, ideology=_STRING),
    ("id",),
)
ENTITIES = Table(
    "proposition_ner", _required(id=_INT, entity_type=_STRING, entity=_STRING), ("id", "entity_type", "entity")
)
TOPICS = Table("proposition_topics", _required(id=_LONG, topic=_STRING), ("id",))
TABLES = {t.name: t for t in (PROPOSITIONS, AUTHORS, WORD_CLOUD, SUMMARY, ENTITIES, TOPICS)}

#: What was last worked on, beside the result tables.
TEXT_DIGESTS = Table("text_digests", _required(id=_LONG, digest=_STRING), ("id",))
