"""CVE identifiers in free text.

Matching is case-sensitive and has no word boundary: a longer digit run is cut
after seven digits (``CVE-2020-12345678`` gives ``CVE-2020-1234567``).
``[0-9]`` is used rather than ``\\d`` so that only ASCII digits match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the identifier pattern.
CVE_PATTERN = "CVE-[0-9]{4}-[0-9]{4,7}"


def cve_tokens(text: Column | str) -> Column:
    """Distinct CVE identifiers in ``text`` as an array; NULL text gives NULL."""
    col = F.col(text) if isinstance(text, str) else text
    return F.array_distinct(F.regexp_extract_all(col, F.lit(CVE_PATTERN), F.lit(0)))


def explode_cves(df: DataFrame, text_col: str, out_col: str = "cve", keep: list[str] | None = None) -> DataFrame:
    """One row per distinct identifier per input row.

    Rows whose text is NULL or has no match produce nothing (F9).  ``explode``
    is a generator inside the same stage, so no shuffle happens here.
    """
    keep = keep if keep is not None else [c for c in df.columns if c != text_col]
    return df.select(*keep, F.explode(cve_tokens(text_col)).alias(out_col))
