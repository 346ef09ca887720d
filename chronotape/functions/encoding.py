"""Stable identities: canonical text, row digests, derived ids, named deterministic draws."""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

DRAW_BITS = 52


def canonical_row(columns: Sequence[str]) -> Column:
    """One row as JSON text, columns in the given order, nulls written out."""
    return F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"})


def row_digest(columns: Sequence[str]) -> Column:
    return F.sha2(canonical_row(columns), 256)


def derived_event_id(broker_event_id: Column, payload: Column) -> Column:
    """The broker's own id, or a digest of the payload where the broker gives none."""
    return F.coalesce(broker_event_id, F.sha2(payload, 256))


def client_order_id(strategy_version: str, instrument_id: str, decision_time: str, intent_hash: str) -> Column:
    """Same intent, same id: a retry cannot become a second order."""
    return row_digest([strategy_version, instrument_id, decision_time, intent_hash])


def draw(seed: int, stream: str, *keys: Column | str) -> Column:
    """Uniform integer below 2^52 that depends on (seed, stream, keys) only, never on partitioning."""
    if seed < 0 or not stream:
        raise ValueError("a draw needs a non-negative seed and a stream name")
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    text = F.concat_ws("|", F.lit(str(seed)), F.lit(stream), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, DRAW_BITS // 4), 16, 10).cast("bigint")


def stable_sample(df: DataFrame, fraction: float, seed: int, stream: str, *keys: str) -> DataFrame:
    """Keep a reproducible share of rows: a row's fate depends on its key alone. Adds no shuffle."""
    if not 0 <= fraction <= 1:
        raise ValueError(f"fraction must lie in [0, 1], got {fraction}")
    return df.where(draw(seed, stream, *keys) < int(fraction * 2**DRAW_BITS))


@F.pandas_udf(StringType())
def _nfc(text: pd.Series) -> pd.Series:
    return text.map(lambda value: unicodedata.normalize("NFC", value), na_action="ignore")


def normalize_text(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """NFC-normalise text columns in one scan, sending only values with non-ASCII text through Python.

    Spark has no built-in normalisation, and ASCII text is in normal form already. Each value that is
    not travels; in its place the others send a null.
    """
    converted = {}
    for name in columns:
        wide = F.when(F.col(name).rlike(r"[^\x00-\x7F]"), F.col(name))
        converted[name] = F.coalesce(_nfc(wide), F.col(name))
    return df.withColumns(converted)


def document_lines(document: Mapping[str, object]) -> list[str]:
    """A small nested document as sorted lines ``path<TAB>kind<TAB>value``, one per leaf.

    Equal documents give equal lines whatever the order of their keys. Path steps and texts are
    NFC-normalised and escaped, so a line can be read back in one way only. Whole numbers, texts, truth
    values and nulls are leaves; anything else, fractions included, is refused.
    """
    lines: list[str] = []
    pending: list[tuple[str, object]] = [("", document)]
    while pending:
        path, value = pending.pop()
        match value:
            case Mapping():
                lines.append(f"{path}\tmap\t{len(value)}")
                pending += [(f"{path}/{_escaped(key)}", inner) for key, inner in value.items()]
            case list() | tuple():
                lines.append(f"{path}\tlist\t{len(value)}")
                pending += [(f"{path}/{at}", inner) for at, inner in enumerate(value)]
            case str():
                lines.append(f"{path}\ttext\t{_escaped(value)}")
            case None | bool() | int():
                lines.append(f"{path}\t{type(value).__name__}\t{value}")
            case _:
                raise TypeError(f"{path or '/'}: a {type(value).__name__} cannot be part of a digest")
    return sorted(lines)


def _escaped(text: str) -> str:
    """NFC text without the characters that shape a line."""
    plain = unicodedata.normalize("NFC", text).replace("\\", "\\\\")
    return plain.replace("/", "\\s").replace("\t", "\\t").replace("\n", "\\n")


def document_digest(document: Mapping[str, object]) -> str:
    return hashlib.sha256("\n".join(document_lines(document)).encode()).hexdigest()
