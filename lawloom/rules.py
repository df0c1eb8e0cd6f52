"""Default rules. Every operator takes these as arguments; edit them per call."""

from __future__ import annotations

import datetime as dt

# --- fixed values: the results depend on exactly these ---------------------

VALID_TYPES = ("PL", "PEC", "PLP")
START_DATE = dt.date(2025, 2, 2)
END_DATE = dt.date(2025, 7, 17)

DROPPED_FIELDS = (
    "ultimoStatus",
    "uriOrgaoNumerador",
    "uriPropAnterior",
    "uriPropPrincipal",
    "uriPropPosterior",
)
AUTHOR_FIELDS = ("idDeputadoAutor", "nomeAutor", "siglaPartidoAutor", "siglaUFAutor")

TOP_FRACTION = 0.15
BOTTOM_FRACTION = 0.15
ANNEX_TOP_FRACTION = 0.30
# A line repeats when it is on at least 4 of 10 pages; kept as a ratio of whole
# numbers so that the comparison is exact.
REPEAT_RATIO = (4, 10)

BANNED_TERMS = (
    "câmara dos deputados",
    "gabinete do deputado",
    "gabinete do deputado federal",
    "assinado eletronicamente",
    "para verificar a assinatura",
    "@camara.leg.br",
    "praça dos três poderes",
    "cep 70160",
    "mesa",
    "deputado federal",
    "projeto de lei n",
    "projeto de lei nº",
    "gabinete",
)
STAMP_PATTERN = r"(\*|^)\s*cd\d{6,}\s*(\*|$)"
BILL_ID_PATTERN = r"^pl\s*n?[.ºo°]*\s*\d{1,6}[/-]\d{2,4}\z"

SENTIMENTS = (
    "extremamente-positivo",
    "positivo",
    "positivo-neutro",
    "neutro",
    "negativo-neutro",
    "negativo",
    "extremamente-negativo",
)
IDEOLOGIES = (
    "extrema-esquerda",
    "esquerda",
    "centro-esquerda",
    "centro",
    "centro-direita",
    "direita",
    "extrema-direita",
)
THEME_MAX_WORDS = 10
SUMMARY_MAX_WORDS = 50
TOPICS = (
    "Administração Pública",
    "Direitos Humanos e Minorias",
    "Segurança Pública",
    "Defesa Nacional",
    "Finanças e Orçamento",
    "Tributação e Reforma Tributária",
    "Saúde Pública",
    "Educação",
    "Previdência Social",
    "Assistência Social",
    "Trabalho e Emprego",
    "Desenvolvimento Regional",
    "Infraestrutura e Logística",
    "Transporte",
    "Energia e Recursos Naturais",
    "Meio Ambiente e Sustentabilidade",
    "Mudanças Climáticas",
    "Agricultura, Pecuária e Extrativismo",
    "Ciência, Tecnologia e Inovação",
    "Comunicações",
    "Proteção de Dados e Segurança Digital",
    "Regulação de Inteligência Artificial",
    "Cultura",
    "Esporte",
    "Habilitação",
    "Urbanismo",
    "Justiça e Sistema Judiciário",
    "Combate à Violência Doméstica",
    "Direitos das Pessoas com Deficiência",
    "Políticas para Povos Indígenas e Comunidades Tradicionais",
)

# Unicode classes: word characters, white space and line ends as the texts use
# them. Java's \w and \s are ASCII, so the classes are spelled out.
WORD_CLASS = r"\p{L}\p{N}_"
SPACE_CLASS = r"\t-\r\x1c-\x20\x85\p{Z}"
LINE_END_CLASS = r"\n\x0b\f\r\x1c-\x1e\x85\u2028\u2029"
LINE_END_PATTERN = rf"[{LINE_END_CLASS}](?:(?<=\r)\n)?"
LEADER_PATTERN = r"[_'.·•●◦▪▫⋅∙…]{3,}"
ANNEX_PATTERN = r"^ANEXO(\s+[IVXLCDM0-9]+)?(\s*[-–—:][^\n]*)?\z"
ANNEX_MAX_WORDS = 10
# --- end of fixed values ----------------------------------------------------
