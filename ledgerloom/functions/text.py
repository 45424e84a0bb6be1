"""Text expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


# Every character that counts as white space.
WHITE_SPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_SPACES = f"[{WHITE_SPACE}]+"


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends (plain `trim` removes spaces only)."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def is_blank(value: Column) -> Column:
    """Null or only white space."""
    return value.isNull() | (strip(value.cast("string")) == "")


def title_case(text: Column) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the others.

    `initcap` starts words after spaces only, so `on-hold` would become `On-hold`. Text with other
    non-letters is cut at every start of a letter run, and `initcap` works on the pieces.
    """
    pieces = F.split(text, r"(?<=\P{L})(?=\p{L})")
    by_piece = F.array_join(F.transform(pieces, F.initcap), "")
    return F.when(text.rlike(r"[^\p{L} ]"), by_piece).otherwise(F.initcap(text))


def normalise_label(text: Column) -> Column:
    """Strip, collapse inner white space, title case."""
    return title_case(F.regexp_replace(strip(text), _SPACES, " "))


def recode(value: Column, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """Look `value` up in a small literal mapping."""
    pairs = [F.lit(item) for pair in mapping.items() for item in pair]
    found = F.create_map(*pairs)[value]
    return found if default is None else F.coalesce(found, F.lit(default))


def name_to_mailbox(full_name: Column) -> Column:
    """`Ann-Marie  Poe` -> `annmarie.poe`: letters only, words joined with dots."""
    letters = F.regexp_replace(strip(F.lower(full_name)), f"[^a-z{WHITE_SPACE}]", "")
    return F.regexp_replace(letters, _SPACES, ".")


def audit_trail(labelled: Mapping[str, Column]) -> Column:
    """Join the labels whose condition holds with `;`, in the given order."""
    return F.concat_ws(";", *[F.when(hit, F.lit(label)) for label, hit in labelled.items()])
