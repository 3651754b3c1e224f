"""Text helpers: keys, masks and Brazilian number text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def pad_key(code: Column, kind: Column, bare_kind: str, width: int) -> Column:
    """The code as it is for one kind of place, zero-padded to ``width`` for all others."""
    return F.when(kind == bare_kind, code).otherwise(F.lpad(code.cast("string"), width, "0"))


def remap(col: Column, mapping: Mapping[str, str]) -> Column:
    """Replace listed codes and keep the others."""
    out = F
    for old, new in mapping.items():
        out = out.when(col == old, F.lit(new))
    return col if out is F else out.otherwise(col)


def strip_prefix(col: Column, prefixes: Sequence[str]) -> Column:
    """Cut the first matching prefix; text without any of them stays."""
    out = F
    for p in prefixes:
        out = out.when(col.startswith(p), F.substr(col, F.lit(len(p) + 1)))
    return col if out is F else out.otherwise(col)


def access_key(*parts: Column) -> Column:
    """Document key from its parts; NULL when a part is NULL."""
    return F.concat(*[p.cast("string") for p in parts])


def text_key(*parts: Column) -> Column:
    """Composite key in which a missing part counts as empty text."""
    return F.concat(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def mask_tax_id(col: Column) -> Column:
    """Fourteen digits to ``NN.NNN.NNN/NNNN-NN``."""
    cuts = ((1, 2, "."), (3, 3, "."), (6, 3, "/"), (9, 4, "-"), (13, 2, ""))
    pieces: list[Column] = []
    for start, size, sep in cuts:
        pieces += [F.substring(col, start, size), F.lit(sep)]
    return F.concat(*pieces)


def choose(cond: Column, when_true: Column, when_false: Column) -> Column:
    return F.when(cond, when_true).otherwise(when_false)


def comma_decimal(col: Column) -> Column:
    """Plain number text with a decimal comma and no grouping."""
    return F.replace(col.cast("string"), F.lit("."), F.lit(","))


def format_ptbr(col: Column, scale: int = 2) -> Column:
    """Brazilian number text: dot between thousands, comma before ``scale`` decimals."""
    fixed = col.cast(f"decimal(38,{scale})")
    return F.translate(F.format_number(fixed, scale), ",.", ".,")


def format_ptbr_compat(plain: Column, tail_by_width: bool = False) -> Column:
    """Group ready-made number text the way the original reports print it.

    ``plain`` is text with a decimal comma. Integer parts of 4 to 9 characters (a minus
    sign counts) are grouped; all other text passes unchanged. The decimals printed are
    the last two characters, or, with ``tail_by_width``, as many trailing characters as
    the integer part has less one. Both lose or double characters for some scales; use
    :func:`format_ptbr` unless the printed text itself has to agree.
    """
    width = F.instr(plain, ",") - 1
    lead = F.pmod(width - 1, F.lit(3)) + 1
    tail = F.right(plain, width - 1) if tail_by_width else F.right(plain, F.lit(2))
    head = F.left(plain, lead)
    first = F.substr(plain, lead + 1, F.lit(3))
    second = F.substr(plain, lead + 4, F.lit(3))
    short = F.concat(head, F.lit("."), first, F.lit(","), tail)
    long = F.concat(head, F.lit("."), first, F.lit("."), second, F.lit(","), tail)
    return F.when(width.between(4, 6), short).when(width.between(7, 9), long).otherwise(plain)
