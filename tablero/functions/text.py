"""String helpers: name/address composition and dialect INITCAP."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Alternating runs of letters/digits and of everything else.
_WORD_RUNS = r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def initcap_words(s: ColumnOrName) -> Column:
    """INITCAP where any non-alphanumeric character starts a new word
    ("garcia-lopez" -> "Garcia-Lopez"); Spark's initcap splits on spaces only.
    NULL stays NULL."""
    runs = F.regexp_extract_all(_c(s), F.lit(_WORD_RUNS), 1)
    capped = F.transform(runs, lambda x: F.concat(F.upper(F.substring(x, 1, 1)),
                                                  F.lower(F.substring(x, F.lit(2), F.length(x)))))
    return F.when(_c(s).isNotNull(), F.array_join(capped, ""))


def join_parts(*parts: ColumnOrName, sep: str = " ", null_as: str | None = None) -> Column:
    """``a || sep || b || ...`` with NULL propagation (``null_as=None``) or
    each part replaced by ``null_as`` first (the NVL style)."""
    cols = [_c(p) for p in parts]
    if null_as is not None:
        cols = [F.coalesce(c, F.lit(null_as)) for c in cols]
    out: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            out.append(F.lit(sep))
        out.append(c)
    return F.concat(*out)


def full_name(first: ColumnOrName, last: ColumnOrName, second_last: ColumnOrName,
              null_as: str | None = "", capitalize: bool = True) -> Column:
    """``INITCAP(NVL(first,x) || ' ' || NVL(last,x) || ' ' || NVL(second,x))``."""
    name = join_parts(first, last, second_last, null_as=null_as)
    return initcap_words(name) if capitalize else name


def prefixed(prefix: str, value: ColumnOrName) -> Column:
    """``'Piso ' + value``: NULL when value is NULL."""
    return F.concat(F.lit(prefix), _c(value).cast("string"))


def split_part(s: ColumnOrName, delimiter: str, n: int) -> Column:
    """SPLIT_PART: out-of-range part -> '', NULL -> NULL."""
    return F.split_part(_c(s), F.lit(delimiter), F.lit(n))
