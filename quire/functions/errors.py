"""Classification of engine errors, and parsing of engine replies."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from quire.constants import PERMANENT_CODES, PERMANENT_HINTS, TRANSIENT_CODES, TRANSIENT_HINTS, TRANSIENT_STATUS


def _any(text: Column, hints: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for h in hints:
        out = out | text.contains(h)
    return out


def is_transient(code: Column, status: Column, message: Column) -> Column:
    """Whether a retry may help: by service code (permanent ones first), permanent hints, status, then transient hints.

    Hints are plain substrings of the message, so that a number anywhere in it counts.
    """
    code, text = F.coalesce(code, F.lit("")), F.lower(F.coalesce(message, F.lit("")))
    return (
        F.when(code.isin(*PERMANENT_CODES), False).when(code.isin(*TRANSIENT_CODES), True).when(_any(text, PERMANENT_HINTS), False)
        .when(status.isin(*TRANSIENT_STATUS) | status.between(500, 599), True).when(status.between(400, 499), False).otherwise(_any(text, TRANSIENT_HINTS))
    )


def backoff_ceiling(attempt: Column, base: float = 2.0, most: float = 30.0) -> Column:
    """Longest wait in seconds before a further attempt; the adapter multiplies it by a random 0.5 to 1."""
    return F.least(F.lit(most), F.pow(F.lit(base), attempt))


REPLY = "struct<error:string,error_kind:string,elements:array<struct<type:string,text:string,level:string,table:struct<rows:int,cols:int,header_rows:int,cells:array<struct<row:int,col:int,text:string,row_span:int,col_span:int>>>>>>"


def unfenced(reply: Column) -> Column:
    """reply without a code fence around it."""
    from quire.functions.text import strip

    return strip(F.regexp_replace(F.regexp_replace(strip(reply), r"^```[A-Za-z0-9_-]*\s*", ""), r"\s*```$", ""))


def parsed_reply(reply: Column, schema: str = REPLY) -> Column:
    """(value, error, raw_preview): the reply's JSON by schema, or invalid_json with its first 500 characters."""
    body = unfenced(reply)
    value = F.from_json(body, schema, {"mode": "PERMISSIVE"})
    whole = F.concat(F.lit("["), body, F.lit("]"))  # as the only item of a list, so that nothing may follow it
    valid = F.coalesce(F.try_parse_json(whole).isNotNull() & (F.json_array_length(whole) == 1), F.lit(False))
    return F.struct(F.when(valid, value).alias("value"), F.when(~valid, F.lit("invalid_json")).alias("error"), F.when(~valid, F.left(F.coalesce(reply, F.lit("")), F.lit(500))).alias("raw_preview"))
