"""Text, number, null, array, map and JSON columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def replace_text(value: Column | str, find: str, repl: str = "") -> Column:
    return F.replace(as_col(value).cast("string"), F.lit(find), F.lit(repl))


def without_commas(value: Column | str, repl: str = " ") -> Column:
    return replace_text(value, ",", repl)


def split_part(value: Column | str, sep: str, n: int) -> Column:
    """The n-th part (from 1), or the empty string if there is none."""
    return F.split_part(as_col(value), F.lit(sep), F.lit(n))


def text_part(value: Column | str, sep: str, n: int) -> Column:
    """As :func:`split_part`, but NULL if there is none, so that ``coalesce`` can fall back."""
    return F.nullif(split_part(value, sep, n), F.lit(""))


def try_number(value: Column | str, drop: str = "") -> Column:
    """A number after dropping a prefix, or NULL if what is left is no number."""
    text = replace_text(value, drop) if drop else as_col(value)
    return text.try_cast("long")


def safe_ratio(num: Column | str, den: Column | str, default: float | None = None) -> Column:
    """num / den as double; ``default`` (NULL unless given) where the denominator is zero."""
    ratio = F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))
    if default is None:
        return ratio
    return F.when(as_col(den) == 0, F.lit(float(default))).otherwise(ratio)


def label(value: Column | str, names: dict) -> Column:
    """Code to text; NULL for codes not listed."""
    value = as_col(value)
    cases = [(value == code, text) for code, text in names.items()]
    return reduce(lambda acc, c: acc.when(c[0], c[1]), cases[1:], F.when(cases[0][0], cases[0][1]))


def normalise(value: Column | str, names: dict[str, str], default: str | None = None) -> Column:
    """Replace listed values, keep the others, and use ``default`` for NULL."""
    value = as_col(value)
    kept = F.coalesce(label(value, names), value)
    return kept if default is None else F.coalesce(kept, F.lit(default))


def first_of(array: Column | str) -> Column:
    """Element 0, or NULL for an empty array."""
    return F.get(as_col(array), F.lit(0))


def json_path(text: Column | str, path: str) -> Column:
    return F.get_json_object(as_col(text), path)


def variant_path(text: Column | str, path: str, type_name: str) -> Column:
    return F.try_variant_get(F.try_parse_json(as_col(text)), path, type_name)


def bucket_cap(value: Column | str, cap: int) -> Column:
    """Values above ``cap`` fall in the last bucket."""
    return F.least(as_col(value), F.lit(cap))


def hash_bucket(key: Column | str, buckets: int, seed: int = 0) -> Column:
    """A stable bucket 0..buckets-1. md5 is the same in every engine, so the split can be checked."""
    return F.conv(F.substring(seeded_order(key, seed), 1, 8), 16, 10).cast("long") % buckets


def seeded_order(key: Column | str, seed: int = 0) -> Column:
    """A reproducible random ordering of keys."""
    return F.md5(F.concat(F.lit(f"{seed}:"), as_col(key).cast("string")))
