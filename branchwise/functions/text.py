"""Scalar expressions of articles: normalization, ids, inputs, hashes."""

from __future__ import annotations

import hashlib
import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

NORMALIZATION_VERSION = "1"
SEPARATOR = "\x1f"


@F.pandas_udf(T.StringType())
def _composed(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def nfc(c: Column) -> Column:
    """Only text beyond ASCII goes through Python: ASCII is composed already."""
    plain = ~F.regexp(c, F.lit(r"[^\x00-\x7F]"))
    return F.when(plain, c).otherwise(_composed(F.when(~plain, c)))


def collapse_whitespace(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"[ \t\n\r\f]+", " "))


def strip_html(c: Column) -> Column:
    for pattern in (r"(?is)<(script|style)\b.*?</\1\s*>", r"(?s)<!--.*?-->", r"(?s)<[^>]*>"):
        c = F.regexp_replace(c, pattern, " ")
    return collapse_whitespace(c)


def normalize(c: Column, unicode_nfc: bool = True, whitespace: bool = True, html: bool = False) -> Column:
    c = nfc(c) if unicode_nfc else c
    c = strip_html(c) if html else c
    return collapse_whitespace(c) if whitespace else c


def article_id(headline: Column, date: Column, article: Column) -> Column:
    """From normalized parts; a missing part is empty."""
    parts = [F.coalesce(x.cast("string"), F.lit("")) for x in (headline, date, article)]
    return F.concat(F.lit("blbg_"), F.sha2(F.concat(parts[0], F.lit("\n"), parts[1], F.lit("\n"), parts[2]), 256))


def source_hash(*raw: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(F.concat(*[x for r in raw for x in (F.coalesce(r.cast("string"), F.lit("")), F.lit(SEPARATOR))]), 256))


def model_input(headline: Column, body: Column, separator: str, mode: str) -> Column:
    if mode == "headline_plus_lead":
        body = F.substring_index(body, "\n\n", 1)
    elif mode != "headline_plus_article":
        raise ValueError(f"input mode {mode!r} needs a column that articles do not have")
    return F.concat(F.coalesce(headline, F.lit("")), F.lit(separator), F.coalesce(body, F.lit("")))


def truncation(text: Column, max_chars: int) -> dict[str, Column]:
    long = F.length(text) > max_chars
    return {
        "input_text": F.substring(text, 1, max_chars), "original_chars": F.length(text).cast("int"), "submitted_chars": F.least(F.length(text), F.lit(max_chars)).cast("int"),
        "truncated": long, "truncation_strategy": F.when(long, F.lit("head")),
    }


def hash_score(article: Column, child: Column) -> Column:
    """A deterministic stand-in for a model's score, in [0, 1)."""
    return F.conv(F.substring(F.sha2(F.concat(article, F.lit(":"), child), 256), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def hashed(article: str, child: str) -> float:
    """hash_score of plain strings."""
    return int(hashlib.sha256(f"{article}:{child}".encode()).hexdigest()[:8], 16) / 4294967296


def prediction_key(*parts: Column) -> Column:
    return F.sha2(F.concat_ws(SEPARATOR, *parts), 256)
