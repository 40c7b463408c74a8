"""Scalar functions over names, missing values, chromosomes and sizes, as Column expressions where Spark has them."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Fixed value: what stands for a missing field, and what counts as missing.
MISSING, MISSING_FORMS = "NA", ("", "N/A", "-")


def stripped(x: Column) -> Column:
    """A string without any white space at its ends."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def normalise(x: Column) -> Column:
    """A field without white space around it; ``NA`` for null, empty, ``N/A`` and ``-``."""
    x = stripped(x)
    return F.when(x.isNull() | x.isin(*MISSING_FORMS), MISSING).otherwise(x)


def slug_ascii(x: Column) -> Column:
    """The slug of a name that holds only ASCII characters: runs of others than letters, digits and ``._+-`` become ``_``."""
    slug = F.regexp_replace(F.regexp_replace(stripped(x), r"[^A-Za-z0-9._+-]+", "_"), r"^[_.]+|[_.]+$", "")
    return F.when(slug.isNull() | (slug == ""), MISSING).otherwise(slug)


def slug_text(x: str | None) -> str:
    """The slug of any name: compatibility forms are taken apart and what isn't ASCII then is dropped."""
    ascii_only = unicodedata.normalize("NFKD", (x or "").strip()).encode("ascii", "ignore").decode()
    return re.sub(r"[^A-Za-z0-9._+-]+", "_", ascii_only).strip("_.") or MISSING


@F.pandas_udf(StringType())
def _slugs(x: pd.Series) -> pd.Series:
    return x.map(slug_text, na_action=None)


def slugify(x: Column) -> Column:
    """The slug of any name. Only names beyond ASCII need Python; Spark has no Unicode normalisation."""
    return F.when(x.isNull() | (F.octet_length(x) == F.length(x)), slug_ascii(x)).otherwise(_slugs(F.coalesce(x, F.lit(""))))


def group_path(*fields: Column) -> Column:
    """``org/class/.../name.bed`` of slugs; all fields of the grouping take part, the last names the file."""
    slugs = [slugify(f) for f in fields]
    return F.concat(F.concat_ws("/", *slugs), F.lit(".bed"))


def canonical(x: Column) -> Column:
    """The form in which an antigen's spellings agree: ``PERIOD`` is a dot, ``_`` a space, in lower case."""
    return F.lower(F.trim(F.translate(F.replace(x, F.lit("PERIOD"), F.lit(".")), "_", " ")))


def is_primary(chrom: Column) -> Column:
    """Whether a chromosome belongs to the primary assembly."""
    return chrom.rlike(r"^chr([0-9]+|X|Y|M|MT)$")


def log_weight(share: Column, least: float) -> Column:
    """ln(1 / share), the share held within [least, 1]."""
    return F.log(1.0 / F.greatest(F.least(share, F.lit(1.0)), F.lit(least)))


def parse_size(text: str) -> int:
    """Bytes of a size such as ``512M``."""
    m = re.fullmatch(r"\s*(\d+)\s*([KMGT]?)B?\s*", text.upper())
    if not m:
        raise ValueError(f"not a size: {text!r}")
    return int(m[1]) << (10 * " KMGT".index(m[2] or " "))


def check_release_id(text: str) -> str:
    """A release id, which names a folder: letters, digits, dots, underscores and dashes after a letter or digit."""
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", text):
        raise ValueError(f"not a release id: {text!r}")
    return text


def signal_file_parts(name: Column) -> Column:
    """threshold, antigen and tissue of a legacy signal file ``05.H3K27ac.AllCell.bed``; null if it isn't one."""
    pattern = r"^(\d+)\.(.+)\.([^.]+)\.bed$"
    parts = F.struct(*[F.regexp_extract(name, pattern, i).alias(x) for i, x in ((1, "threshold"), (2, "antigen"), (3, "tissue"))])
    return F.when(name.rlike(pattern), parts)
