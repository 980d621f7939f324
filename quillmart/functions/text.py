"""Column expressions for cleaning raw text (all JVM-side, codegen-friendly).

Every function takes and returns a ``Column``; none is a Python UDF, so the
cleaning of a whole table stays inside whole-stage code generation.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmart.functions.fixed_values import (
    BANK_ACRONYMS,
    DEFAULT_COUNTRY,
    NULL_TOKENS,
    US_STATES,
)

DIGIT_RUN = r"\d+"


def reusable(fn):
    """Build an expression once per set of plain (name/number) arguments.

    A Column is an immutable, unresolved expression that any plan may reuse;
    building one costs a bridge call per expression node, and the pipeline
    rebuilds the same cleaning expressions for every query. Column arguments
    are not cached (they are not hashable)."""
    plain = (str, int, float, tuple, type(None))
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(*args, **kw):
        if not all(isinstance(a, plain) for a in (*args, *kw.values())):
            return fn(*args, **kw)
        key = (args, tuple(sorted(kw.items())))
        col = cache.get(key)
        if col is None:
            col = cache[key] = fn(*args, **kw)
        return col
    return wrapper


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


@reusable
def blank_to_null(c) -> Column:
    """Trimmed text; blank becomes NULL (the loader's empty-string null token)."""
    t = F.trim(_c(c))
    return F.when(t == "", F.lit(None)).otherwise(t)


@reusable
def first_int(c) -> Column:
    """First run of digits as a nullable int: '3PC' -> 3, 'none' -> NULL.

    ``regexp_substr`` gives NULL on no match (``regexp_extract`` would give
    '' and an ANSI cast of '' throws); ``try_cast`` turns overflow into NULL."""
    return F.regexp_substr(_c(c).cast("string"), F.lit(DIGIT_RUN)).try_cast("int")


@reusable
def percent_fraction(c) -> Column:
    """Percent text to a fraction: '10%%' -> 0.10, '1pct' -> 0.01,
    '12.5%' -> 0.12 (first digit run only). Overflow of decimal(5,4) -> NULL."""
    n = first_int(c).cast("decimal(10,0)")
    return (n / F.lit(100)).try_cast("decimal(5,4)")


@reusable
def digits_only(c) -> Column:
    """Keep digits only; nothing left -> NULL: '+1 (555) 01-02' -> '15550102'."""
    d = F.regexp_replace(_c(c), r"\D", "")
    return F.when(d == "", F.lit(None)).otherwise(d)


def _literal_map(d: dict) -> Column:
    items = []
    for k, v in d.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


@functools.cache
def _state_map() -> Column:
    # built once per process: the map literal takes ~100 bridge calls, and a
    # Column is an immutable expression any plan can reuse
    return _literal_map(US_STATES)


@reusable
def us_state_name(c) -> Column:
    """Two-letter US code -> state name; other text kept (trimmed); blank -> NULL."""
    t = blank_to_null(c)
    return F.coalesce(F.try_element_at(_state_map(), F.upper(t)), t)


@reusable
def default_country(c, default: str = DEFAULT_COUNTRY) -> Column:
    return F.coalesce(blank_to_null(c), F.lit(default))


DATE_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy", "yyyy/MM/dd", "dd-MM-yyyy")
TIMESTAMP_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "MM/dd/yyyy HH:mm:ss", "yyyy-MM-dd")


def _shape(fmt: str) -> str:
    """A loose regex of the text a datetime pattern can parse (pattern
    letters become digit runs, quoted text stays literal), used to skip
    hopeless parse attempts: a failed parse raises and catches an exception
    inside the JVM, which is slow."""
    import re as _re

    out, quoted, prev = [], False, None
    for ch in fmt:
        if ch == "'":
            quoted = not quoted
            prev = None
            continue
        if ch.isalpha() and not quoted:
            if prev != ch:
                out.append(r"\d+")
            prev = ch
            continue
        out.append(_re.escape(ch))
        prev = None
    return "^" + "".join(out) + "$"


def _guarded(t: Column, fmt: str, parse) -> Column:
    return F.when(t.rlike(_shape(fmt)), parse(t, fmt))


@reusable
def parse_date(c, formats=DATE_FORMATS) -> Column:
    """Tolerant date parse: the first format that fits wins, none -> NULL.
    Formats are tried per value (no format locked from the first row)."""
    t = blank_to_null(c)
    return F.coalesce(*[_guarded(t, f, lambda x, f: F.try_to_date(x, f)) for f in formats])


@reusable
def parse_timestamp(c, formats=TIMESTAMP_FORMATS) -> Column:
    """Tolerant wall-clock timestamp parse (TIMESTAMP_NTZ); none of the
    formats fits -> NULL. The text is read as UTC and its microseconds are
    counted from a zoneless epoch, so the session time zone plays no part."""
    t = blank_to_null(c)
    utc = F.coalesce(*[_guarded(t, f, lambda x, f: F.try_to_timestamp(F.concat(x, F.lit("Z")), F.lit(f + "X")))
                       for f in formats])
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(utc), epoch)


@reusable
def product_type(c) -> Column:
    """'home_decor' -> 'home decor', ' Toys ' -> 'toys', null tokens -> 'unknown'."""
    t = F.lower(F.trim(F.replace(_c(c), F.lit("_"), F.lit(" "))))
    return F.when(t.isNull() | t.isin(*NULL_TOKENS), F.lit("unknown")).otherwise(t)


@reusable
def title_case(c, missing: str = "Unknown") -> Column:
    """Title case that restarts after any non-letter ('front-end' ->
    'Front-End', "o'neil" -> "O'Neil"); blank/NULL -> 'Unknown'.

    ``initcap`` alone only restarts after spaces, so the text is split into
    letter / non-letter runs and each run is capitalised."""
    t = F.trim(_c(c))
    runs = F.regexp_extract_all(t, F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    titled = F.array_join(F.transform(runs, lambda w: F.initcap(w)), "")
    return F.when(t.isNull() | (t == ""), F.lit(missing)).otherwise(titled)


@reusable
def bank_name(c) -> Column:
    """Collapse spaces; known acronyms upper case, other words capitalised;
    blank/'nan' -> NULL."""
    t = blank_or_nan_to_null(c)
    words = F.split(t, r"\s+")
    fixed = F.transform(
        words,
        lambda w: F.when(F.upper(w).isin(*BANK_ACRONYMS), F.upper(w))
        .otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2))))),
    )
    return F.when(t.isNull(), F.lit(None)).otherwise(F.array_join(fixed, " "))


@reusable
def blank_or_nan_to_null(c) -> Column:
    """Trim; '' and 'nan' -> NULL."""
    t = F.trim(_c(c))
    return F.when(t.isNull() | (t == "") | (t == "nan"), F.lit(None)).otherwise(t)


@reusable
def to_money(c, precision: int = 10, scale: int = 2) -> Column:
    """Tolerant numeric parse into a decimal; junk or overflow -> NULL
    (half-up rounding: '9.999' -> 10.00)."""
    return blank_to_null(c).try_cast(f"decimal(38,10)").try_cast(f"decimal({precision},{scale})")


@reusable
def to_bool(c) -> Column:
    return blank_to_null(c).try_cast("boolean")
