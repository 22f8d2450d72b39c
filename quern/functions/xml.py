"""Event documents: ``<event name=…><data name=…><value>…</value></data>…</event>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Only the parts that are read; attributes have the reader's ``_`` prefix.
EVENT_SCHEMA = "_name STRING, data ARRAY<STRUCT<_name: STRING, value: STRING>>"


def escape(text: Column) -> Column:
    """Replace the characters that XML reserves."""
    text = F.replace(text, F.lit("&"), F.lit("&amp;"))
    text = F.replace(text, F.lit("<"), F.lit("&lt;"))
    text = F.replace(text, F.lit(">"), F.lit("&gt;"))
    return F.replace(text, F.lit('"'), F.lit("&quot;"))


def event_xml(name: Column, fields: dict[str, Column]) -> Column:
    """Build one event document from escaped parts; NULL fields are left out."""
    nodes = [
        F.concat(
            F.lit(f'<data name="{field}"><value>'),
            value.cast("string"),
            F.lit("</value></data>"),
        )
        for field, value in fields.items()
    ]
    return F.concat_ws(
        "", F.concat(F.lit('<event name="'), name, F.lit('">')), *nodes,
        F.lit("</event>"),
    )


def parse_event(payload: Column) -> Column:
    """Parse a document once; a broken one gives a struct of NULLs."""
    return F.from_xml(payload, EVENT_SCHEMA, {"mode": "PERMISSIVE"})


def event_field(event: Column, name: str, kind: str = "string") -> Column:
    """First data node of that name, cast; NULL when the event has none."""
    place = F.array_position(event["data"]["_name"], name).cast("int")
    value = F.get(event["data"]["value"], place - 1)
    if kind == "binary":
        return F.unhex(value)
    return value if kind == "string" else value.try_cast(kind)
