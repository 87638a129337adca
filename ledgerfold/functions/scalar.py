"""Row-local expressions. All of them are native Spark columns, so they stay inside
whole-stage code generation and can be pushed through projections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# What stands for a missing code, and the labels of the share buckets.
MISSING_CODE = -999
SHARE_LABELS = ("Clean", "Mild", "Frequent")
SHARE_EDGES = (0.0, 0.2)

BITS_PER_WORD = 64


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag_int(c: Column | str) -> Column:
    """A boolean or 0/1 flag as int; null stays null."""
    return as_col(c).cast("boolean").cast("int")


def not_flag_int(c: Column | str) -> Column:
    return (~as_col(c).cast("boolean")).cast("int")


def any_flag_off(cols) -> Column:
    """1 when at least one flag is off, else 0 (a null flag counts as on)."""
    off = reduce(lambda a, b: a | b, [~as_col(c).cast("boolean") for c in cols])
    return F.when(off, 1).otherwise(0)


def safe_ratio(x: Column | str, y: Column | str) -> Column:
    """x / y as double; null when y is zero."""
    return as_col(x).cast("double") / F.nullif(as_col(y), F.lit(0))


def month_of(name: Column | str) -> Column:
    return F.regexp_extract(as_col(name), "[0-9]+", 0).cast("int")


def false_if_null(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False)).cast("int")


def in_values(x: Column | str, values) -> Column:
    """Membership, for a Python list or for an array column (fitted statistics)."""
    if isinstance(values, Column):
        return F.array_contains(values, as_col(x))
    return as_col(x).isin(list(values))


def entropy_term(p: Column | str) -> Column:
    return -as_col(p) * F.log(as_col(p))


def code_text(c: Column | str) -> Column:
    return F.coalesce(as_col(c).cast("int"), F.lit(MISSING_CODE)).cast("string")


def concat_codes(a: Column | str, b: Column | str, sep: str = "_") -> Column:
    return F.concat_ws(sep, code_text(a), code_text(b))


def bucket_label(x: Column | str, edges=SHARE_EDGES, labels=SHARE_LABELS) -> Column:
    """Label of the right-closed interval that holds x; a null gives 'nan'."""
    c = as_col(x)
    out = F.when(c <= edges[0], labels[0])
    for edge, label in zip(edges[1:], labels[1:]):
        out = out.when(c <= edge, label)
    return out.when(c > edges[-1], labels[-1]).otherwise("nan")


def row_mean(cols) -> Column:
    """Mean over columns, nulls skipped; null when every column is null."""
    cs = [as_col(c) for c in cols]
    total = reduce(lambda a, b: a + b, [F.coalesce(c.cast("double"), F.lit(0.0)) for c in cs])
    return total / F.nullif(count_present(cs).cast("double"), F.lit(0.0))


def count_present(cols) -> Column:
    return sum_of([f"int({t} IS NOT NULL)" for t in texts(cols)]) if named(cols) else \
        reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in cols])


def count_equal(cols, value: int) -> Column:
    """How many of the columns equal the code; nulls do not count."""
    return sum_of([f"int({t} <=> {int(value)})" for t in texts(cols)])


def named(cols) -> bool:
    return all(isinstance(c, str) for c in cols)


def texts(cols) -> list[str]:
    return [f"`{c}`" for c in cols]


def sum_of(terms) -> Column:
    """One expression text for wide sums: building it column by column costs a driver call each."""
    return F.expr(" + ".join(terms))


def at_least(x: Column | str, bound: float) -> Column:
    return false_if_null(as_col(x) >= bound)


def any_above(pairs) -> Column:
    """1 when some (column, bound) has column > bound; a null comparison is false."""
    conds = [F.coalesce(as_col(c) > b, F.lit(False)) for c, b in pairs]
    return reduce(lambda a, b: a | b, conds).cast("int")


def clip(x: Column | str, lo, hi) -> Column:
    c = as_col(x)
    return F.when(c < lo, F.lit(lo)).when(c > hi, F.lit(hi)).otherwise(c)


def to_category(x: Column | str) -> Column:
    return as_col(x).cast("string")


def code_bit(c: Column | str, word: int = 0, n_bins: int = BITS_PER_WORD) -> Column:
    """One-hot bit of a code in 0..n_bins-1 inside 64-bit word number ``word``.

    Distinct counts are bit_count(bit_or(bit)): the aggregation buffer has a fixed width, so
    the aggregate stays a code-generated hash aggregate whose map side combines a hot entity
    to one row. A code outside the declared range fails the job instead of being lost.
    """
    x = as_col(c).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), x - word * BITS_PER_WORD)
    here = (x >= word * BITS_PER_WORD) & (x < (word + 1) * BITS_PER_WORD)
    checked = F.when(here, bit).when(
        (x < 0) | (x >= n_bins),
        F.raise_error(F.concat(F.lit("code outside 0.."), F.lit(str(n_bins - 1)), F.lit(": "), x.cast("string"))),
    )
    return checked


def row_bits(cols, n_bins: int | None = None) -> Column:
    """Number of different codes among the columns of one row; of any codes, or of a declared range
    0..n_bins-1 by bit sets."""
    if n_bins is None:
        return F.size(F.array_distinct(F.array_compact(F.array(*cols))))
    xs = [f"int({t})" for t in texts(cols)]
    words = []
    for w in range((n_bins + BITS_PER_WORD - 1) // BITS_PER_WORD):
        bits = [f"coalesce(shiftleft(1L, {x} - {w * BITS_PER_WORD}), 0L)" for x in xs]
        if n_bins > BITS_PER_WORD:
            bits = [f"IF({x} DIV {BITS_PER_WORD} = {w}, {b}, 0L)" for x, b in zip(xs, bits)]
        words.append(f"bit_count({' | '.join(bits)})")
    lowest, highest = (f"{f}({', '.join(xs)})" if len(xs) > 1 else xs[0] for f in ("least", "greatest"))
    outside = f"raise_error('code outside 0..{n_bins - 1}')"
    return F.expr(f"CASE WHEN {lowest} < 0 OR {highest} >= {n_bins} THEN {outside} ELSE {' + '.join(words)} END")


def null_fraction(cols) -> Column:
    cs = list(cols)
    return (F.lit(len(cs)) - count_present(cs)).cast("double") / F.lit(float(len(cs)))
