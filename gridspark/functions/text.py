"""Names, ids and file keys as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridspark import vocab


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def series_id_parts(series_id: Column | str) -> Column:
    """`EBA.PGE-ALL.NG.COL.H` -> struct(source, dest, tag, time_code); NULL unless part 1 is `source-dest`."""
    parts = F.split(_c(series_id), r"\.")
    n = F.size(parts)
    pair = F.split(F.get(parts, F.lit(1)), "-")
    tag = F.when(n >= 3, F.array_join(F.slice(parts, 3, F.greatest(n - 3, F.lit(0))), "-"))
    return F.when(
        (n >= 3) & (F.size(pair) == 2),
        F.struct(F.get(pair, F.lit(0)).alias("source"), F.get(pair, F.lit(1)).alias("dest"),
                 tag.alias("tag"), F.get(parts, n - 1).alias("time_code")),
    )


def name_abbr_pairs(name: Column | str) -> Column:
    """Every `for X (ABBR)` then every `to X (ABBR)` in a series name, as array<struct<abbr, full_name>>."""
    name = _c(name)

    def pairs(word: str) -> Column:
        # fixed value: the pattern of a titled name with its abbreviation
        pattern = F.lit(word + r" ([\w\s\,\.\-]+) \((\w+)\)")
        return F.arrays_zip(
            F.regexp_extract_all(name, pattern, F.lit(2)).alias("abbr"),
            F.regexp_extract_all(name, pattern, F.lit(1)).alias("full_name"),
        )

    return F.concat(pairs("for"), pairs("to"))


def meta_name(name: Column | str) -> Column:
    """`Portland General Electric Company (PGE)` -> struct(abbr, full_name); NULL without an upper-case last word."""
    name = _c(name)
    words = F.regexp_extract_all(name, F.lit(r"(\w+)"), F.lit(1))
    abbr = F.element_at(words, -1)
    full = F.array_join(F.slice(words, 1, F.size(words) - 1), " ")
    return F.when(name.contains("(") & (F.size(words) > 0) & (abbr == F.upper(abbr)),
                  F.struct(abbr.alias("abbr"), full.alias("full_name")))


def name_level(name: Column | str, level: int) -> Column:
    """One level of `type : place : sector`, trimmed; NULL past the end."""
    return F.trim(F.get(F.split(_c(name), ":"), F.lit(level)))


def generation_label(name: Column | str) -> Column:
    """Fuel part of `Net generation : fuel : place : sector`, NULL when absent."""
    # fixed value: the label pattern
    label = F.regexp_extract(_c(name), r"Net generation : ([\s\w\(\)-]+):", 1)
    return F.nullif(F.trim(label), F.lit(""))


def station_file(year: Column, usaf: Column, wban: Column) -> Column:
    """`{usaf}-{wban padded to 5}-{year}.gz`; longer codes are kept whole."""
    wban = wban.cast("string")
    padded = F.when(F.length(wban) < 5, F.lpad(wban, 5, "0")).otherwise(wban)
    return F.concat(usaf.cast("string"), F.lit("-"), padded, F.lit("-"), year.cast("string"), F.lit(".gz"))


def forecast_dir(var: Column | str, day: Column | str) -> Column:
    return F.concat(F.lit("wmo/"), _c(var), F.lit("/"), F.date_format(_c(day), "yyyy/MM/dd"), F.lit("/"))


def forecast_prefix(var: Column | str) -> Column:
    out = F.lit(None).cast("string")
    for name, code in vocab.FORECAST_PREFIX.items():
        out = F.when(_c(var) == name, F.lit(code + vocab.FORECAST_LEVEL)).otherwise(out)
    return out


def forecast_day_state(day: Column | str, today: Column) -> Column:
    """NULL before the archive starts, false for the future, true when a file may exist."""
    day = _c(day)
    return F.when(day < F.lit(vocab.FORECAST_START).cast("date"), F.lit(None).cast("boolean")).otherwise(day <= today)


def strip_quotes(text: Column | str) -> Column:
    return F.translate(_c(text), "'\"", "")
