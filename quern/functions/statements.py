"""Templates of SQL statements: what stays when literals and spelling are levelled out.

A statement is cut into tokens by one pattern and its tokens are put back together with
one blank between them, all inside the JVM.  Comments go; string, binary and number
literals, parameters and variables become ``?``; words and bracketed or quoted names are
in lower case, without brackets where the name needs none; the declaration list that
caches put in front of a parameterised statement goes; a sign before a literal goes; a
list of values counts as one whatever its length.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The parts of the pattern use neither look-around nor back references.
COMMENT = r"--[^\n]*|/\*[^*]*\*+(?:[^/*][^*]*\*+)*/"
STRING = r"[nN]?'(?:[^']|'')*'"
NAME = r"\[(?:[^\]]|\]\])*\]|\"(?:[^\"]|\"\")*\""
BINARY = r"0[xX][0-9a-fA-F]*"
NUMBER = r"(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
PARAMETER = r"@@?[\w@#$]+|\?"
WORD = r"[\p{L}_#][\p{L}\p{N}_@#$]*"
OPERATOR = r"<>|<=|>=|!=|!<|!>|[-+*/%&|^]=|\|\||::|[^\s]"
TOKEN = "|".join([COMMENT, STRING, NAME, BINARY, NUMBER, PARAMETER, WORD, OPERATOR])

_VALUE = f"(?:{STRING})|(?:{BINARY})|(?:{NUMBER})|(?:{PARAMETER})"
_PLAIN_NAME = r"[\[\"]([\p{L}_#][\p{L}\p{N}_@#$]*)[\]\"]"
_TYPE = r"[a-z_][\w.]*(?: \( [^()]* \))?(?: = \?)?(?: output| out| readonly)?"

#: Rewrites of the joined tokens, in order.
REWRITES = (
    # (@a int, @b varchar(20)) select … of a cached parameterised statement
    (rf"^\( \? {_TYPE}(?: , \? {_TYPE})* \) ([a-z;])", "$1"),
    # a sign that belongs to a literal
    (
        r"(^|[(,=<>+*/%-] |<= |>= |!= |\b(?:in|between|and|or|not|like|then|else|when|select"
        r"|values|return|top|by|case|set|on|where|having) )[-+] \?",
        "$1?",
    ),
    # lists of values, and rows of them
    (r"\bin \( \?(?: , \?)* \)", "in ( ?+ )"),
    (r"\bvalues \( \?(?: , \?)* \)(?: , \( \?(?: , \?)* \))*", "values ( ?+ )"),
    # separators at the end
    (r"(?: ;)+$", ""),
)


def tokens(statement: Column) -> Column:
    """Tokens of a statement, without its comments."""
    found = F.regexp_extract_all(statement, F.lit(f"({TOKEN})"), F.lit(1))
    return F.filter(found, lambda t: ~t.rlike(r"^(?:--|/\*)"))


def _is(token: Column, pattern: str) -> Column:
    return token.rlike(f"^(?:{pattern})$")


def _spelled(token: Column) -> Column:
    name = F.when(
        _is(token, _PLAIN_NAME), F.regexp_replace(token, f"^{_PLAIN_NAME}$", "$1")
    ).otherwise(token)
    return F.when(_is(token, _VALUE), F.lit("?")).otherwise(F.lower(name))


def literal_kinds(statement: Column) -> Column:
    """The kinds of a statement's literals and parameters, in order."""
    kinds = F.transform(
        tokens(statement),
        lambda t: F.when(_is(t, STRING), F.lit("text"))
        .when(_is(t, BINARY), F.lit("binary"))
        .when(_is(t, NUMBER), F.lit("number"))
        .when(_is(t, PARAMETER), F.lit("parameter")),
    )
    return F.array_compact(kinds)


def statement_template(statement: Column) -> Column:
    """The template of a statement; NULL has none."""
    spelled = F.array_join(F.transform(tokens(statement), _spelled), " ")
    rewritten = reduce(lambda text, r: F.regexp_replace(text, r[0], r[1]), REWRITES, spelled)
    return F.when(statement.isNotNull(), rewritten)
