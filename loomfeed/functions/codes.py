"""Identifier, code and flag normalisation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_column

# Identifiers that mean "none", per field.
PROVIDER_SENTINELS = ("-1", "NS", "NF")
CONTRACT_SENTINELS = ("-1", "OCN")
PLAN_SENTINELS = ("-1", "CT")
# Fixed value: the source system whose claim numbers carry no prefix.
RAW_NUMBER_SOURCES = ("610",)
# Claim status words and their codes.
CLAIM_STATUS = {"PAID": "P", "DENIED": "D", "OTHER": "O", "PENDED": ""}
# Adjust types.
ORIGINAL, ADJUSTMENT, BACKOUT, DELETE = "ORIGINAL", "ADJUSTMENT", "BACKOUT", "DELETE"
UPDATE_TYPES = (ORIGINAL, ADJUSTMENT, DELETE, BACKOUT)
UNKNOWN = "UNK"


def sentinel_default(
    value: Column | str,
    sentinels: Sequence[str] = PROVIDER_SENTINELS,
    default: str = "0",
    max_length: int | None = None,
    trim: bool = True,
    compare_trimmed: bool = False,
) -> Column:
    """``default`` for NULL and for the sentinels, else the value (trimmed, cut to length)."""
    raw = as_column(value)
    kept = F.trim(raw) if trim or max_length else raw
    kept = F.substring(kept, 1, max_length) if max_length else kept
    tested = F.trim(raw) if compare_trimmed else raw
    return F.when(raw.isNull() | tested.isin(*sentinels), F.lit(default)).otherwise(kept)


def sentinel_crosswalk(
    value: Column | str,
    revised: Column | str,
    sentinels: Sequence[str] = PROVIDER_SENTINELS,
    default: str = "0",
) -> Column:
    """``default`` for NULL and for the sentinels, else the crosswalk value or ``default``."""
    raw = as_column(value)
    absent = raw.isNull() | raw.isin(*sentinels)
    return F.when(absent, F.lit(default)).otherwise(F.coalesce(as_column(revised), F.lit(default)))


def composite_key(
    source: Column | str, number: Column | str, raw_sources: Sequence[str] = RAW_NUMBER_SOURCES
) -> Column:
    """``source-number``, or the bare number for a raw source; NULL in, NULL out."""
    source, number = as_column(source), as_column(number)
    joined = F.trim(F.concat(source.cast("string"), F.lit("-"), number))
    return F.when(source.isin(*raw_sources), number).otherwise(joined)


def original_claim_number(
    source: Column | str,
    number: Column | str,
    adjust_type: Column | str,
    raw_sources: Sequence[str] = RAW_NUMBER_SOURCES,
) -> Column:
    """The number a claim replaces; blank for originals, adjustments and NULL adjust types."""
    replaces = ~as_column(adjust_type).isin(ORIGINAL, ADJUSTMENT) & as_column(source).isNotNull()
    number = F.trim(composite_key(source, number, raw_sources))
    return F.when(replaces, number).otherwise(F.lit(""))


def map_codes(
    value: Column | str, codes: Mapping[str, str] = CLAIM_STATUS, default: str | None = None
) -> Column:
    """Word to code, ignoring case and outer spaces; anything else becomes ``default``."""
    word = F.trim(F.upper(as_column(value)))
    mapped = None
    for name, code in codes.items():
        mapped = F.when(word == name, code) if mapped is None else mapped.when(word == name, code)
    return mapped.otherwise(F.lit(default).cast("string"))


def adjust_type(
    value: Column | str, del_ind: Column | str, null_default: str | None = None
) -> Column:
    value = as_column(value)
    kept = F.coalesce(value, F.lit(null_default)) if null_default else value
    return F.when(as_column(del_ind) == 1, F.lit(DELETE)).otherwise(kept)


def published_adjust_type(value: Column | str, update_type: Column | str) -> Column:
    """A claim that changed since the last run is sent as an adjustment unless it is deleted."""
    value = as_column(value)
    changed = (as_column(update_type) == ADJUSTMENT) & ~value.eqNullSafe(DELETE)
    return F.when(changed, F.lit(ADJUSTMENT)).otherwise(value)


def diagnosis_slots(
    slots: int = 34,
    code: str = "icd_diag_cd_{n}",
    flag: str = "diag_code_{n}_poa",
    code_out: str = "ICD_DIAG_{n}",
    flag_out: str = "DIAG_CODE_{n}_POA",
    first_default: str | None = None,
) -> list[Column]:
    """Two columns per slot: the trimmed code, and present-on-admission Y/N where a code exists."""
    columns = []
    for n in range(1, slots + 1):
        raw = code.format(n=n)
        value = f"trim({raw})"
        if n == 1 and first_default:
            value = f"coalesce({value}, '{first_default}')"
        present = f"CASE WHEN {raw} IS NOT NULL THEN IF({flag.format(n=n)} = 'Y', 'Y', 'N') END"
        columns.append(F.expr(f"{value} AS {code_out.format(n=n)}"))
        columns.append(F.expr(f"{present} AS {flag_out.format(n=n)}"))
    return columns


def pad_code(value: Column | str, width: int = 4, keep: str = UNKNOWN, limit: int = 48) -> Column:
    """Left-pad with up to ``width - 1`` zeros and keep the last ``width`` characters."""
    value = as_column(value)
    padded = F.right(F.concat(F.lit("0" * (width - 1)), value), F.lit(width))
    return F.when(F.trim(value) == keep, F.substring(value, 1, limit)).otherwise(padded)


def yn_flag(value: Column | str) -> Column:
    value = as_column(value)
    return F.when(value.isin("Y", "N"), value)


def one_flag(value: Column | str) -> Column:
    """``Y`` when the value reads as the number 1, else ``N``; text that is no number is ``N``."""
    number = F.trim(as_column(value).cast("string")).try_cast("decimal(38,9)")
    return F.when(number == 1, "Y").otherwise("N")


def typed_default(value: Column | str, default: str, dtype: str) -> Column:
    """NULL default with the literal in the column's own type."""
    return F.coalesce(as_column(value), F.lit(default).cast(dtype))


def amount(value: Column | str, as_text: bool) -> Column:
    """Amounts are decimal(32,2) in the standard model and text in the extended one."""
    value = as_column(value)
    return value.cast("string") if as_text else value.try_cast("decimal(32,2)")
