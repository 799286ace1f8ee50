"""Column expressions for text: literal splits, right-trim, tokens, lines.

All of these are built-in Spark SQL expressions (JVM side, inside whole-stage
codegen); none is a Python UDF.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that Python's str.rstrip() removes (str.isspace()), derived by rule
# so the Spark expression trims exactly what the reference's rstrip trims.
PY_WHITESPACE: str = "".join(chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace())

# Universal-newline line breaks: "\r\n", "\r" and "\n" each end a line.
LINE_BREAK_REGEX = "\r\n|\r|\n"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


_REGEX_META = set(".$|()[]{}^?*+\\")


def literal_pattern(sep: str) -> str:
    """Java-regex that matches ``sep`` literally (Spark's split takes a regex).

    A single character is passed as itself (or backslash-escaped if it is a
    regex metacharacter): Java's ``String.split`` then splits without
    compiling a pattern for every row.
    """
    if len(sep) == 1 and not sep.isalnum():
        return "\\" + sep if sep in _REGEX_META else sep
    if len(sep) == 1:
        return sep
    if "\\E" in sep:
        return "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
    return "\\Q" + sep + "\\E"


def split_literal(c: str | Column, sep: str) -> Column:
    """Python ``str.split(sep)``: every separator splits, empty pieces are kept."""
    return F.split(_col(c), literal_pattern(sep), -1)


def _java_char_class(chars: str) -> str:
    return "[" + "".join(f"\\x{{{ord(ch):X}}}" for ch in chars) + "]"


def rstrip(c: str | Column) -> Column:
    """Python ``str.rstrip()`` (all trailing white space, not only blanks)."""
    return F.regexp_replace(_col(c), _java_char_class(PY_WHITESPACE) + "+\\z", "")


def words(c: str | Column) -> Column:
    """``text.split(' ')`` as an array (double blanks give empty words)."""
    return split_literal(c, " ")


def lower_words(c: str | Column) -> Column:
    """Words of the lower-cased text; equals lower-casing each word, since
    lower-casing never creates or removes a blank."""
    return split_literal(F.lower(_col(c)), " ")


def word_count(c: str | Column) -> Column:
    return F.size(words(c))


def lines(c: str | Column) -> Column:
    """Lines as ``readlines`` sees them: a final empty piece (text ending in a
    line break, or an empty text) is not a line."""
    parts = F.split(_col(c), LINE_BREAK_REGEX, -1)
    return F.when(F.element_at(parts, -1) == F.lit(""), F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def query_word_list(line: str | Column) -> Column:
    """Query words of one line: right-trim, split on blanks, lower-case, and
    drop repeats keeping the first occurrence (array_distinct keeps order)."""
    return F.array_distinct(F.transform(split_literal(rstrip(line), " "), lambda w: F.lower(w)))


def python_float_text(c: str | Column) -> Column:
    """A double as Python's ``repr`` writes it (the reference's output files).

    One cast gives digits that read back as the same double.  Some Java versions
    give more digits than needed, so while the two neighbours with one digit
    less are tried and one of them reads back, it is taken (the nearer one, of
    equally near ones the even one); the first length at which neither does
    ends it, which is at once for most values.  Then Python's notation:
    plain for decimal exponents in [-4, 16), ``d.ddde-05`` otherwise.  The steps
    are bound in lambdas, which keeps them out of the generated code.  Known limit:
    beyond 1e19 the last of 17 digits can be one off (a few in a million doubles).
    """
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    text = F.get(F.transform(F.transform(F.array(F.abs(x)), _java_digits), _shortest), 0)
    sign = F.when(F.startswith(x.cast("string"), F.lit("-")), F.lit("-")).otherwise(F.lit(""))
    return (F.when(x.isNull(), F.lit(None).cast("string"))
            .when(F.isnan(x), F.lit("nan"))
            .when(x == float("inf"), F.lit("inf"))
            .when(x == float("-inf"), F.lit("-inf"))
            .when(x == 0, F.concat(sign, F.lit("0.0")))
            .otherwise(F.concat(sign, text)))


def _java_digits(a: Column) -> Column:
    """``(value, digits, exp)`` of a positive double: ``d.ddd * 10^exp`` from its cast, or all
    digits of an integral one that a long (or two) can hold, whose cast may be rounded."""
    integral = (a >= float(1 << 53)) & (a < float(1 << 64))
    halved = (a / 2).cast("bigint").cast("decimal(20,0)")
    text = F.when(integral, (halved * 2).cast("decimal(20,0)").cast("string")).otherwise(a.cast("string"))
    whole = F.regexp_extract(text, r"^([0-9]+)", 1)
    fraction = F.regexp_extract(text, r"\.([0-9]+)", 1)
    shift = F.coalesce(F.regexp_extract(text, r"E(-?[0-9]+)$", 1).try_cast("int"), F.lit(0))
    raw = F.concat(whole, fraction)
    leading = F.length(raw) - F.length(F.ltrim(raw, F.lit("0")))
    return F.struct(a.alias("value"), F.trim(raw, F.lit("0")).alias("digits"),
                    (shift + F.length(whole) - 1 - leading).alias("exp"))


def _shortest(java: Column) -> Column:
    """The shortest text that reads back, in Python's notation."""
    value, digits, exp = java["value"], java["digits"], java["exp"]

    def state(best: Column, best_exp: Column, size: Column, done: Column) -> Column:
        return F.struct(best.alias("digits"), best_exp.cast("int").alias("exp"), size.cast("int").alias("size"), done.alias("done"))

    def step(acc: Column, _: Column) -> Column:
        size = acc["size"] - 1
        low = F.substring(digits, F.lit(1), size)
        high = (low.cast("decimal(20,0)") + 1).cast("decimal(20,0)").cast("string")
        rest = F.substring(digits, size + 1, F.lit(30))
        odd = F.substring(low, -1, 1).cast("int") % 2 == 1
        up = (rest > "5") | ((rest == "5") & odd)

        def reads(v: Column) -> Column:
            return F.concat(v, F.lit("e"), (exp - size + 1).cast("string")).cast("double") == value

        def taken(v: Column) -> Column:
            return state(v, exp + F.length(v) - size, size, F.lit(False))

        tried = (F.when(up & reads(high), taken(high)).when(reads(low), taken(low)).when(reads(high), taken(high))
                 .otherwise(state(acc["digits"], acc["exp"], size, F.lit(True))))
        return F.when(acc["done"] | (size < 1), acc).otherwise(tried)

    start = state(digits, exp, F.length(digits), F.lit(False))
    short = F.aggregate(F.sequence(F.lit(1), F.length(digits)), start, step)
    return F.get(F.transform(F.array(short), lambda s: _plain_notation(F.rtrim(s["digits"], F.lit("0")), s["exp"])), 0)


def _plain_notation(digits: Column, exp: Column) -> Column:
    """``0.d * 10^(exp + 1)`` as Python prints it."""
    n = F.length(digits)
    sci = F.concat(F.substring(digits, 1, 1),
                   F.when(n > 1, F.concat(F.lit("."), F.substring(digits, 2, 1 << 20))).otherwise(F.lit("")),
                   F.lit("e"), F.when(exp < 0, F.lit("-")).otherwise(F.lit("+")),
                   F.when(F.abs(exp) < 10, F.lit("0")).otherwise(F.lit("")), F.abs(exp).cast("string"))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exp - 1), digits)                     # -4 <= exp < 0
    int_part = F.rpad(F.substring(digits, F.lit(1), exp + 1), exp + 1, "0")
    frac = F.substring(digits, exp + 2, F.lit(1 << 20))
    large = F.concat(int_part, F.lit("."), F.when(frac == "", F.lit("0")).otherwise(frac))    # 0 <= exp < 16
    return (F.when((exp >= -4) & (exp < 0), small)
            .when((exp >= 0) & (exp < 16), large)
            .otherwise(sci))
