"""Reading loosely typed JSON values held as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.functions.columns import strip

BYTE_ORDER_MARK = "\ufeff"
#: Shorter texts are never above the size limit of a VARIANT, which is 16 MiB or more.
SMALL_TEXT = 1 << 24


def _plain(text: Column) -> Column:
    return F.ltrim(text, F.lit(BYTE_ORDER_MARK))


def is_too_large(text: Column, document: Column) -> Column:
    """Is the text JSON, and ``document``, its VARIANT, null because of its size alone?"""
    large = document.isNull() & (F.octet_length(text) > SMALL_TEXT)
    return large & F.get_json_object(_plain(text), "$").isNotNull()


def parse_small(text: Column) -> Column:
    """JSON text as VARIANT; text that is unreadable or too large is null. A byte order
    mark is skipped."""
    return F.try_parse_json(_plain(text))


def parse_parts(text: Column, document: Column, schema: str) -> Column:
    """Named members of a document that is too large for a VARIANT, else null.

    The text is read member by member: lists and maps of the schema become lists and maps
    of small VARIANTs, and neither the document nor its large members ever is one.
    """
    return F.when(is_too_large(text, document), F.from_json(_plain(text), schema))


def parse_document(text: Column, name: Column | None = None) -> Column:
    """JSON text as VARIANT; unreadable text is null. A byte order mark is skipped.

    Text that is JSON but too large for a VARIANT is not unreadable: it stops the job with
    the given name, or else with its first characters.
    """
    document = parse_small(text)
    shown = F.substring(_plain(text), 1, 80) if name is None else name
    message = F.concat(F.lit("JSON text above the size limit of a VARIANT: "), shown)
    return F.when(is_too_large(text, document), F.raise_error(message).cast("variant")).otherwise(document)


def field(document: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(document, f"$.{path}", kind)


def is_object(document: Column) -> Column:
    """Only a JSON object can be read as a struct."""
    return F.try_variant_get(document, "$", "struct<event_id:variant>").isNotNull()


def as_list(document: Column, path: str) -> Column:
    return F.try_variant_get(document, path, "array<variant>")


def as_map(document: Column, path: str) -> Column:
    return F.try_variant_get(document, path, "map<string,variant>")


def whole_number(document: Column, path: str) -> Column:
    """200, 200.7, "200" and true are whole numbers; "200.7", text and lists are not."""
    return field(document, path, "bigint")


def real_number(document: Column, path: str = "") -> Column:
    target = f"$.{path}" if path else "$"
    return F.try_variant_get(document, target, "double")


def present_text(document: Column, path: str) -> Column:
    """Trimmed text of a field; '' when it is missing, null, false, zero or blank."""
    text = field(document, path, "string")
    # Zero and false count as missing, the texts "0" and "false" do not.
    kind = F.schema_of_variant(field(document, path, "variant"))
    empty = text.isin("0", "0.0", "-0.0", "false") & (kind != "STRING")
    return F.coalesce(F.when(empty, F.lit("")).otherwise(strip(text)), F.lit(""))
