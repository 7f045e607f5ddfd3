"""Text functions: label keys, cleaning, tokens, hashes, language hints.

Column expressions throughout; `label_key` alone needs Python for NFKC and case folding,
and takes Arrow batches."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Dashes that fold to "-".
DASHES = "‐‑‒–—―⁃−﹘﹣－֊"
#: Apostrophes that fold to "'".
APOSTROPHES = "‘’‚‛ʼ′＇"
#: Double quotes that fold to '"'.
QUOTES = "“”"
FOLDED = DASHES + APOSTROPHES + QUOTES
FOLDS_TO = "-" * len(DASHES) + "'" * len(APOSTROPHES) + '"' * len(QUOTES)
_FOLD = str.maketrans(FOLDED, FOLDS_TO)
_SPACE = re.compile(r"\s+")
#: Java's white space without the switch for Unicode is ASCII only.
EDGES = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
INNER = r"(?U)[\s\x1c-\x1f]+"


def label_key_of(text: str | None) -> str | None:
    """Comparison key of a label: compatibility form, plain dashes and quotes, folded case,
    single spaces."""
    if text is None:
        return None
    folded = unicodedata.normalize("NFKC", text).translate(_FOLD).casefold()
    return _SPACE.sub(" ", folded).strip()


def _key_batch(labels: pa.Array) -> pa.Array:
    some = pc.unique(labels).to_pylist()  # labels repeat
    keys = dict(zip(some, map(label_key_of, some), strict=True))
    return pa.array([keys[x] for x in labels.to_pylist()], pa.string())


def label_key(label: Column) -> Column:
    """label_key_of, one Arrow batch at a time."""
    udf = F.arrow_udf(_key_batch, "string")
    return udf(label)


def ascii_key(label: Column) -> Column:
    """The same key for labels of ASCII and the folded marks, inside generated code."""
    return F.trim(F.regexp_replace(F.lower(F.translate(label, FOLDED, FOLDS_TO)), INNER, " "))


def clean_optional(text: Column) -> Column:
    """Trimmed at both ends; blank is null; inner white space stays."""
    return F.nullif(F.regexp_replace(text, EDGES, F.lit("")), F.lit(""))


def split_labels(text: Column) -> Column:
    """Labels of a field with one a line, trimmed, blank ones dropped; null: none."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), r"[\r\n]+"), lambda x: F.regexp_replace(x, EDGES, ""))
    return F.filter(lines, lambda x: x != "")


def clean_text(text: Column) -> Column:
    """Tags become spaces, white space is collapsed, blank is null; entities stay."""
    plain = F.regexp_replace(F.regexp_replace(text, r"<[^>]+>", " "), INNER, " ")
    return F.nullif(F.trim(plain), F.lit(""))


def clean_strings(values: Column) -> Column:
    """clean_text of each element, nulls dropped; null array: empty."""
    return F.filter(F.transform(F.coalesce(values, F.array().cast("array<string>")), clean_text), lambda x: x.isNotNull())


def clean_map(values: Column) -> Column:
    """Values with single spaces; entries with null values go."""
    spaced = F.transform_values(values, lambda _, v: F.trim(F.regexp_replace(v, INNER, " ")))
    return F.map_filter(spaced, lambda _, v: v.isNotNull())


def date_of(extended: Column) -> Column:
    """Timestamp of {"$date": ...}; text without a zone is UTC."""
    return F.to_timestamp(extended["$date"])


def id_of_uri(uri: Column, kind: str = "occupation") -> Column:
    """Lower-case UUID at the end of an occupation's or skill's URI; null if malformed."""
    pattern = rf"(?i)^https?://\S+/{kind}/([0-9a-f]{{8}}(?:-[0-9a-f]{{4}}){{3}}-[0-9a-f]{{12}})$"
    return F.nullif(F.lower(F.regexp_extract(uri, pattern, 1)), F.lit(""))


def tokens(text: Column) -> Column:
    """Lower-cased runs of ASCII letters and digits, in order."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"([a-z0-9]+)"), F.lit(1))


def ratio_of(text: Column, chars: str) -> Column:
    """Share of the letters of a text that belong to a class of characters; null without
    letters."""
    letters = F.length(F.regexp_replace(text, r"\P{L}", ""))
    marked = F.length(F.regexp_replace(text, f"[^{chars}]", ""))
    return F.when(letters > 0, marked / letters)


def lang_hint(text: Column, chars: str, low: float = 0.02, high: float = 0.15, names: Sequence[str] = ("en", "mixed", "vi", "empty")) -> Column:
    """Language by the share of marked letters: above high, above low, else plain."""
    ratio = ratio_of(text, chars)
    plain, mixed, marked, empty = names
    return F.when(ratio.isNull(), empty).when(ratio > high, marked).when(ratio > low, mixed).otherwise(plain)


def consecutive_distinct(values: Column) -> Column:
    """Elements that differ from the one before."""
    return F.filter(values, lambda x, i: (i == 0) | ~x.eqNullSafe(F.get(values, i - 1)))


def content_hash(*columns: str) -> Column:
    """SHA-256 of the columns as JSON with sorted keys and nulls kept."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def sections(*parts: tuple[str, Column]) -> Column:
    """Lines "Header: body" of the bodies that aren't null or empty."""
    return F.concat_ws("\n", *[F.when(F.coalesce(body, F.lit("")) != "", F.concat(F.lit(f"{head}: "), body)) for head, body in parts])


def ordered_labels(*labels: Column) -> Column:
    """Distinct labels in order, blank and null ones dropped."""
    return F.array_distinct(F.filter(F.array(*labels), lambda x: x.isNotNull() & (F.trim(x) != "")))


def truncate_ids(ids: Column, special: Column, most: int) -> Column:
    """At most `most` ids; all special ids at the end stay, the rest from the front."""
    n = F.size(ids)
    tail = F.aggregate(F.reverse(ids), F.struct(F.lit(True).alias("on"), F.lit(0).alias("n")),
        lambda acc, x: F.struct((acc["on"] & F.array_contains(special, x)).alias("on"), (acc["n"] + F.when(acc["on"] & F.array_contains(special, x), 1).otherwise(0)).alias("n")))["n"]
    keep = F.least(tail, F.lit(most))
    cut = F.concat(F.slice(ids, F.lit(1), F.lit(most) - keep), F.slice(ids, n - keep + 1, keep))
    return F.when(n <= most, ids).otherwise(cut)
