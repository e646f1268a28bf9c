"""Column builders and the small amount of text handling that rule expressions need."""

from __future__ import annotations

import operator
import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# A quoted literal, a back-ticked name, or a bare word.
_TOKEN = re.compile(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`(?:[^`]|``)*`")
_STAR_ARGUMENT = re.compile(r"(?:^|[(,.])\s*\*")
_PLAIN_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*\Z")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sql_string(value: str) -> str:
    """``value`` as a SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def column(name: str) -> Column:
    """The column of exactly this name, dots and spaces included."""
    return F.col(quoted(name))


def is_plain_name(name: str) -> bool:
    return bool(_PLAIN_NAME.match(name))


def quote_references(text: str, name: str) -> str:
    """Back-tick every whole-word use of ``name`` outside literals and quoted names."""
    word = re.compile(rf"(?<![\w]){re.escape(name)}(?![\w])")

    def bare(part: str) -> str:
        return word.sub(lambda _: quoted(name), part)

    pieces, end = [], 0
    for token in _TOKEN.finditer(text):
        pieces += [bare(text[end : token.start()]), token.group()]
        end = token.end()
    return "".join(pieces) + bare(text[end:])


def may_read(text: str, names: Iterable[str]) -> bool:
    """True if the expression might read one of ``names``; never a false negative.

    A case-blind substring test, so it can say yes too often. The cost of that is one
    more projection, which the optimizer collapses again.
    """
    flat = text.replace("`", "").lower()
    return bool(_STAR_ARGUMENT.search(text)) or any(
        n.replace("`", "").lower() in flat for n in names
    )


def conjunction(predicates: Sequence[Column]) -> Column:
    return reduce(operator.and_, predicates) if predicates else F.lit(True)


def all_present(names: Sequence[str]) -> Column:
    """Every named column is not NULL."""
    return conjunction([column(n).isNotNull() for n in names])


def holds(predicate: Column) -> Column:
    """Two-valued predicate: NULL counts as false, as in a WHERE clause."""
    return F.coalesce(predicate, F.lit(False))


def balanced_sum(terms: Sequence[Column]) -> Column:
    """Sum as a tree of logarithmic depth, so that very wide tables stay plannable."""
    terms = list(terms)
    while len(terms) > 1:
        pairs = [a + b for a, b in zip(terms[::2], terms[1::2])]
        terms = pairs + terms[len(pairs) * 2 :]
    return terms[0]


def combination_literals(combination) -> list[Column]:
    return [
        F.lit(combination.source).alias("source"),
        F.lit(combination.lob).alias("lob"),
        F.lit(combination.domain).alias("domain"),
    ]
