"""Encrypted match payloads and the envelope, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.binding import let


def payload_key(last_modified: Column) -> Column:
    """16-character key derived from the payload's time in epoch milliseconds.

    ``#``, then 14 characters, then ``$``. The 14 are the time's digits read as hex and written
    in base 36, followed by (year + reversed year) * (day + reversed day) in base 24, padded
    with zeros or cut.
    """
    date = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(last_modified / 86_400_000).cast("int"))
    year, day = F.date_format(date, "yyyy"), F.date_format(date, "dd")
    total = (F.year(date) + F.reverse(year).cast("int")) * (
        F.dayofmonth(date) + F.reverse(day).cast("int")
    )
    digits = F.concat(
        F.lower(F.conv(last_modified.cast("string"), 16, 36)),
        F.lower(F.conv(total.cast("string"), 10, 24)),
    )
    return F.concat(F.lit("#"), F.rpad(digits, 14, "0"), F.lit("$"))


def decrypted_text(last_modified: Column, response: Column) -> Column:
    """Text of a base64 AES-CBC payload; NULL if it cannot be decrypted.

    The first vector is the upper-cased key. The cipher reads it from the head of its input.
    """
    encrypted = F.unbase64(response)
    plain = let(payload_key(last_modified), lambda key: F.try_aes_decrypt(
        F.concat(F.encode(F.upper(key), "UTF-8"), encrypted),
        F.encode(key, "UTF-8"), F.lit("CBC"), F.lit("PKCS"),
    ))
    return F.try_validate_utf8(plain.cast("string"))


def envelope(
    data: Column, retrieved_at: Column, source_url: Column | None = None, document: Column | None = None,
    part: Column | None = None,
) -> Column:
    """A document: when it was fetched (UTC wall clock) and what was fetched. Nulls are written out.

    A document in several parts names itself and the part in each of them.
    """
    stamp = F.date_format(retrieved_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    metadata = [stamp.alias("retrieved_at")]
    if source_url is not None:
        metadata.append(source_url.alias("source_url"))
    if document is not None:
        metadata += [document.alias("document"), part.alias("part")]
    return F.struct(F.struct(*metadata).alias("metadata"), data.alias("data"))


def document_text(document: Column, pretty: bool = False) -> Column:
    options = {"ignoreNullFields": "false"}
    if pretty:
        options["pretty"] = "true"
    return F.to_json(document, options)
