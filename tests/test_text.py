from __future__ import annotations

import random
import re

import pytest

from lawloom import functions as lf

LEADERS = "_'.·•●◦▪▫⋅∙…"


@pytest.mark.parametrize(
    "line, expected",
    [
        ("a ....... b", "a b"),
        ("a..b", "a..b"),
        ("___", ""),
        ("  a \t b  ", "a b"),
        ("a…•·b", "a b"),
        (" x y　", "x y"),
        ("a\x1fb", "a b"),
    ],
)
def test_normalize_line(evaluate, line, expected):
    assert evaluate([line], lf.normalize_line) == [expected]


def test_normalize_line_on_random_text(evaluate):
    rng = random.Random(3)
    alphabet = LEADERS + "ab é,-\t  "
    lines = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(300)]
    expected = [re.sub(r"\s+", " ", re.sub(f"[{re.escape(LEADERS)}]{{3,}}", " ", s)).strip() for s in lines]
    assert evaluate(lines, lf.normalize_line) == expected


def test_page_number(evaluate):
    yes = ["3", "1234", "Página 3 de 10", "PÁGINA 3", "pagina 3", "3/25", "3 / 25", " 7 ", "página  2  DE  9"]
    no = ["12345", "p. 3", "3 de 10", "Página", "Página 3 de", "3/25/1", "a3", "3\n4", ""]
    assert evaluate(yes, lf.is_page_number) == [True] * len(yes)
    assert evaluate(no, lf.is_page_number) == [False] * len(no)


def test_boilerplate(evaluate):
    yes = [
        "CÂMARA DOS DEPUTADOS",
        "*CD257150518000*",
        "x *CD257150518000",
        "cd123456 *",
        "mesada",
        "PL 1234/2025",
        "pl nº 12-25",
        "Aßinado eletronicamente",
        "fulano@camara.leg.br",
        "CEP 70160-900",
    ]
    no = ["CD12345", "xCD257150518000", "", "PL 1234/2025 dispõe", "cd123456 x", "projeto de lei", "art. 1"]
    assert evaluate(yes, lf.is_boilerplate) == [True] * len(yes)
    assert evaluate(no, lf.is_boilerplate) == [False] * len(no)


def test_boilerplate_rules_are_arguments(evaluate):
    def only_foo(line):
        return lf.is_boilerplate(line, banned=["foo"], stamp_pattern=None, bill_id_pattern=None)

    assert evaluate(["a FOO b", "mesa", "PL 1/2025"], only_foo) == [True, False, False]
    nothing = evaluate(["mesa"], lambda c: lf.is_boilerplate(c, banned=[], stamp_pattern=None, bill_id_pattern=None))
    assert nothing == [False]


def test_annex_title(evaluate):
    yes = ["ANEXO", "ANEXO I", "ANEXO II - TABELA", "ANEXO 3: A", " ANEXO – X ", "ANEXO - 1 2 3 4 5 6 7 8"]
    no = [
        "ANEXO ÚNICO",
        "Anexo I",
        "ANEXO I - x.",
        "ANEXO I - X.",
        "ANEXO I - Tabela",
        "ANEXO - 1 2 3 4 5 6 7 8 9",
        "O ANEXO",
        "",
    ]
    assert evaluate(yes, lf.is_annex_title) == [True] * len(yes)
    assert evaluate(no, lf.is_annex_title) == [False] * len(no)


def test_tokenize(evaluate):
    def words(text):
        return lf.tokenize(text)

    got = evaluate(["Olá, mundo! a-b x² ção_1", None, "  ", "A b\x1cc"], words)
    assert [[w for w in row if w] for row in got] == [["olá", "mundo", "ab", "x²", "ção_1"], [], [], ["a", "b", "c"]]


def test_tokenize_on_random_text(evaluate):
    rng = random.Random(5)
    alphabet = "abZÉç_09 -,.;'²ªº\t\n  “”漢字–"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    expected = [re.sub(r"[^\w\s]", "", t.lower()).split() for t in texts]
    assert [[w for w in row if w] for row in evaluate(texts, lf.tokenize)] == expected


def test_split_lines_like_every_unicode_line_end(evaluate):
    text = "a\nb\r\nc\rd\x0be\x0cf\x1cg\x1dh\x1ei\x85j k l\r\n\nm"
    assert evaluate([text], lf.split_lines) == [text.splitlines()]


def test_strip_and_blanks(evaluate):
    assert evaluate([" \t a b　", ""], lf.strip) == ["a b", ""]
    assert evaluate(["", None, "x"], lf.null_if_blank) == [None, None, "x"]
    assert evaluate(["", None, "x"], lf.blank_if_null) == ["", "", "x"]
