"""Text expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from paylake.fixed import VPA_PATTERN, WORD_BREAKS

_BREAKS = r"\s" + re.escape(WORD_BREAKS)


def proper_case(c: Column) -> Column:
    """Capital first letter after white space or punctuation, lower case elsewhere.

    The built-in ``initcap`` starts words after spaces only, which is all that most names
    need; the others are cut into runs.
    """
    runs = F.regexp_extract_all(F.lower(c), F.lit(f"([^{_BREAKS}]+|[{_BREAKS}]+)"), F.lit(1))
    cased = F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), r.substr(F.lit(2), F.length(r))))
    return F.when(c.rlike(f"[{_BREAKS}&&[^ ]]"), F.array_join(cased, "")).otherwise(F.initcap(c))


def bank_handle(vpa: Column) -> Column:
    """What follows the last ``@``; the whole text where there is none, null for ``a@``."""
    return F.lower(F.trim(F.nullif(F.substring_index(vpa, "@", -1), F.lit(""))))


def is_valid_vpa(vpa: Column) -> Column:
    return vpa.rlike(VPA_PATTERN)
