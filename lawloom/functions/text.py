"""Text expressions. Plain Column functions: no UDF, usable in batch and stream."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lawloom import rules

# Testing the common ASCII characters first makes both patterns about twice as fast
# on prose; they match the same characters without it.
_NOT_WORD = f"[[^a-z ]&&[^{rules.WORD_CLASS}{rules.SPACE_CLASS}]]"
_LEADERS = rf"(?![\x00-&(-\-/-\^`-~]){rules.LEADER_PATTERN}"
_SPACES = f"[{rules.SPACE_CLASS}]+"
_EDGE_SPACES = f"^[{rules.SPACE_CLASS}]+|[{rules.SPACE_CLASS}]+\\z"


def _unicode_spaces(pattern: str) -> str:
    return pattern.replace(r"\s", f"[{rules.SPACE_CLASS}]").replace(r"\d", r"\p{Nd}")


def blank_if_null(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def null_if_blank(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def strip(text: Column) -> Column:
    """Trim Unicode white space on both sides."""
    return F.regexp_replace(text, _EDGE_SPACES, "")


def split_lines(text: Column) -> Column:
    """Split on every Unicode line end; empty pieces stay."""
    return F.split(text, rules.LINE_END_PATTERN)


def normalize_line(line: Column) -> Column:
    """Leader runs of three or more become a space, spaces collapse, ends are trimmed."""
    return F.trim(F.regexp_replace(drop_leaders(line), _SPACES, " "))


def drop_leaders(text: Column) -> Column:
    """Leader runs of three or more become a space."""
    return F.regexp_replace(text, _LEADERS, " ")


def split_collapsed_lines(text: Column) -> Column:
    """Split into lines with spaces collapsed; each line may keep one space at its ends.

    Spaces are rewritten only in texts that have a double or an unusual space.
    """
    inner = f"[{rules.SPACE_CLASS}]&&[^{rules.LINE_END_CLASS}]"
    uneven = text.contains("  ") | text.rlike(f"[[^ -~]&&{inner}]")
    return split_lines(F.when(uneven, F.regexp_replace(text, f"[{inner}]+", " ")).otherwise(text))


def fold_case(text: Column) -> Column:
    """Lower case plus the two full foldings that the rules can meet (ß, ſ)."""
    return F.replace(F.replace(F.lower(text), F.lit("ß"), F.lit("ss")), F.lit("ſ"), F.lit("s"))


def is_page_number(line: Column) -> Column:
    """``3``, ``3/25``, ``Página 3`` or ``página 3 de 10``, in any case."""
    n = r"\d{1,4}"
    whole = rf"(?iu)^\s*(?:{n}|p[áa]gina\s+{n}(?:\s+de\s+{n})?|{n}\s*/\s*{n})\s*\z"
    return line.rlike(_unicode_spaces(whole))


def is_boilerplate(
    line: Column,
    banned: Iterable[str] = rules.BANNED_TERMS,
    stamp_pattern: str | None = rules.STAMP_PATTERN,
    bill_id_pattern: str | None = rules.BILL_ID_PATTERN,
) -> Column:
    """The folded line holds a banned term, a protocol stamp, or is only a bill id."""
    terms = list(dict.fromkeys(banned))
    needed = [t for t in terms if not any(other != t and other in t for other in terms)]

    def any_rule(folded: Column) -> Column:
        tests = [folded.contains(term) for term in needed]
        if stamp_pattern:
            tests.append(folded.contains("cd") & folded.rlike(_unicode_spaces(stamp_pattern)))
        if bill_id_pattern:
            tests.append(folded.startswith("pl") & folded.rlike(_unicode_spaces(bill_id_pattern)))
        return reduce(Column.__or__, tests, F.lit(False))

    # The array of one holds the folded line, so that the tests share it.
    return F.exists(F.array(fold_case(line)), any_rule)


def is_annex_title(line: Column, max_words: int = rules.ANNEX_MAX_WORDS) -> Column:
    """A short upper-case ``ANEXO`` heading that is not a sentence."""
    has_word = line.contains("ANEXO")  # nearly every line stops here
    s = strip(line)
    letters = F.length(F.regexp_replace(s, r"\P{L}", ""))
    uppers = F.length(F.regexp_replace(s, r"\P{Lu}", ""))
    return (
        has_word
        & s.rlike(_unicode_spaces(rules.ANNEX_PATTERN))
        & ~s.endswith(".")
        & (F.size(F.split(s, _SPACES)) <= max_words)
        & (uppers * 10 >= letters * 9)
        & (s == F.upper(s))
    )


def tokenize(text: Column) -> Column:
    """Lower-case words; other characters are deleted, not replaced (``a-b`` → ``ab``).

    The array may hold empty strings at its ends: drop them after the explode,
    where the test is compiled, rather than with an array lambda here.
    """
    return F.split(F.regexp_replace(F.lower(blank_if_null(text)), _NOT_WORD, ""), _SPACES)
