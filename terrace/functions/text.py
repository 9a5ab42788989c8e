"""Text cleaning, vocabulary and key functions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrace.functions.columns import ColumnLike, as_column


def clean_text(value: ColumnLike, placeholders: Sequence[str] = ()) -> Column:
    """Trimmed text; blank text and absence ``placeholders`` become null."""
    trimmed = F.trim(as_column(value))
    result = F.nullif(trimmed, F.lit(""))
    for placeholder in placeholders:
        result = F.nullif(result, F.lit(placeholder))
    return result


def clean_code(value: ColumnLike) -> Column:
    """Trimmed upper-case code."""
    return F.upper(F.trim(as_column(value)))


def recode(value: ColumnLike, names: Mapping[str, str], default: str | None = None) -> Column:
    """Replace known codes by their names; unknown or null codes give ``default``.

    A CASE chain stays inside generated code; dictionaries that grow with the
    data belong in a table joined on the code, see ``recode_join``.
    """
    code = as_column(value)
    chain = F
    for known, name in names.items():
        chain = chain.when(code == known, F.lit(name))
    return chain.otherwise(F.lit(default).cast("string"))


def recode_join(df, code: str, names, names_code: str, names_label: str, output: str):
    """Dictionary lookup for large dictionaries: left join with one row per code.

    A code that the dictionary repeats has its least label; rows of ``df`` never multiply.
    No broadcast hint: adaptive execution broadcasts the dictionary only when its
    measured size is under ``spark.sql.autoBroadcastJoinThreshold``.
    """
    lookup = names.groupBy(F.col(names_code).alias(code)).agg(F.min(names_label).alias(output))
    return df.join(lookup, code, "left")


def fold_accents(value: ColumnLike, accented: str, plain: str) -> Column:
    """Upper-case text without accents, so spellings of one word compare equal."""
    return F.translate(clean_code(value), accented, plain)


def title_prefix(value: ColumnLike, prefix: str, shown: str) -> Column:
    """Uniform casing for codes that start with ``prefix``; other values only trimmed.

    ``title_prefix(c, "TIPO ", "Tipo ")`` maps ``tipo ii-b`` to ``Tipo II-B``.
    """
    trimmed = F.trim(as_column(value))
    upper = F.upper(trimmed)
    rest = F.substr(upper, F.lit(len(prefix) + 1))
    return F.when(F.startswith(upper, F.lit(prefix)), F.concat(F.lit(shown), rest)).otherwise(trimmed)


def joined_key(*parts: ColumnLike, separator: str, missing: Sequence[str | None]) -> Column:
    """Composite key from trimmed parts.

    ``missing`` gives, per part, the text that stands for null; ``None`` leaves
    the part out of the key.
    """
    cleaned = [
        F.trim(as_column(part)) if stand_in is None else F.coalesce(F.trim(as_column(part)), F.lit(stand_in))
        for part, stand_in in zip(parts, missing, strict=True)
    ]
    return F.concat_ws(separator, *cleaned)


def slug_key(area: ColumnLike, kind: ColumnLike, slugs: Mapping[str, str], default: str) -> Column:
    """Derived join key such as ``ba-eolica`` from an area code and a kind."""
    return F.concat(F.lower(as_column(area)), F.lit("-"), recode(kind, slugs, default))
